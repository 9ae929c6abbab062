"""Token counts, the automaton and token files against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from provatab.llm import bpe, token_counts, token_files
from provatab.llm.tokenizer_files import default_path

WORDS, BYTES = default_path("word_bpe_49k.json"), default_path("byte_bpe_50k.json")
POOL = list("aaabcdefghiilmnoopqrstuvwxyz'éüñ0123.,!?-_<|>") + [" "] * 6 + ["<|endoftext|>", "<|startoftext|>", "Σ", "İ", "\n", "\t", "\x1c", "\x85", "　", "한", "日本", "👍"]


def texts():
    rng = random.Random(5)
    found = ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    return found + ["a" * n for n in range(50)] + ["ha" * n for n in range(30)] + ["x" * 2000, "the" * 900, "!" * 500, "ab" * 24, "ab" * 25]


def test_counts_are_the_librarys():
    library, own = Tokenizer.from_file(BYTES), token_counts.Counter(BYTES)
    asked = texts()
    assert own.count(asked) == [len(library.encode(t, add_special_tokens=False).ids) for t in asked]


def test_automaton_encodes_and_decodes_as_the_library():
    library, own = Tokenizer.from_file(WORDS), bpe.Encoder(WORDS)
    for t in texts():
        want = library.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == want, t
        assert bpe.decode(want, own.automaton.labels) == library.decode(want, skip_special_tokens=False)
        assert [i for w in bpe.files.words(t) for i in own.automaton._walk(w.encode())] == [i for w in bpe.files.words(t) for i in own.automaton.encode(w.encode())]


def test_arcs_are_what_the_gadgets_leave():
    """The whole automaton built arc by arc from a few merges equals the looked-up arcs."""
    merges = [(0, 1, 3), (0, 0, 4), (3, 2, 5), (4, 0, 6), (1, 2, 7), (3, 3, 8), (5, 7, 9)]
    vocab = {"a": 0, "b": 1, "c": 2, "ab": 3, "aa": 4, "abc": 5, "aaa": 6, "bc": 7, "abab": 8, "abcbc": 9}
    arcs = {(x, y) for x in range(3) for y in range(3)}
    for a, b, ab in merges:
        row = {y for x, y in arcs if x == b}
        if (a, b) in arcs:
            arcs = {(x, y) for x, y in arcs if (x, y) != (a, b)} | {(ab, y) for y in row}
            arcs |= {(x, ab) for x, y in arcs if y == a}
    own = bpe.Automaton(bpe.files.TokenizerFile(vocab, merges, {}, ""))
    assert {(x, y) for x in range(10) for y in range(10) if own.arc(x, y) and own._alone(x) and own._alone(y)} == {
        (x, y) for x, y in arcs if own._alone(x) and own._alone(y)
    }


def test_awkward_rows(awkward, empty):
    library, by = Tokenizer.from_file(WORDS), Tokenizer.from_file(BYTES)
    source = awkward.select("doc_id", "text").collect()
    ids = {(r.doc_id, r.text): library.encode(r.text or "", add_special_tokens=False).ids for r in source}
    coded = bpe.encode_documents(awkward, WORDS, decoded=True)
    assert coded.columns == [c for c in awkward.columns if c != "ids"] + ["ids", "decoded"]
    got = coded.collect()
    assert len(got) == len(source)
    assert all(r["ids"] == ids[r.doc_id, r.text] and r.decoded == library.decode(r["ids"], skip_special_tokens=False) for r in got)
    counted = token_counts.count_tokens(awkward, BYTES).collect()
    assert len(counted) == len(source)
    assert all(r.n_tokens == len(by.encode(r.text or "", add_special_tokens=False).ids) for r in counted)
    read = token_files.token_file_digests(awkward, WORDS).collect()
    at, want = 0, []
    for r in sorted(source, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or "")):
        own = [*ids[r.doc_id, r.text], 1]
        want.append((r.doc_id, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        at += len(own)
    assert sorted(map(tuple, read), key=lambda r: r[1]) == want
    for made in (bpe.encoding_digests(empty, WORDS), token_counts.token_counts(empty, BYTES), token_files.token_file_digests(empty, WORDS)):
        assert made.count() == 0


def test_digests(documents):
    library = Tokenizer.from_file(WORDS)
    for r in bpe.encoding_digests(documents, WORDS).join(documents, "doc_id").collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


@pytest.mark.parametrize("limit", [0, 1024])
def test_over_limit(documents, limit):
    rows = token_counts.token_counts(documents, BYTES, limit=limit).collect()
    assert all(r.over_limit == (r.n_tokens > limit) for r in rows) and len(rows) == documents.count()
