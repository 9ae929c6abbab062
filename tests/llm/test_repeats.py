import hashlib
from collections import Counter

import numpy as np
import pytest

from provatab.llm import repeats, suffixes
from provatab.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_suffix_arrays_against_sorting():
    rng = np.random.default_rng(0)
    for _ in range(300):
        parts = [rng.integers(0, rng.integers(1, 4), rng.integers(1, 12)) for _ in range(rng.integers(1, 6))]
        m = len(parts)
        t = np.concatenate([np.append(p + m, m - 1 - k) for k, p in enumerate(parts)])
        order = suffixes.suffix_array(t)
        assert order.tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())
        lengths, before = suffixes.common_prefixes(t, order)
        for i, j in zip(order[1:].tolist(), order[:-1].tolist()):
            k = 0
            while t[i + k] == t[j + k]:
                k += 1
            assert (lengths[i], before[i]) == (k, j)


def made_texts(seed):
    """Passages shared whole, in part, overlapping, inside a text, with changing surroundings."""
    rng = np.random.default_rng(seed)
    letters = list("ab é\n")
    passage = ["".join(rng.choice(letters, rng.integers(5, 80))) for _ in range(5)]
    out = []
    for i in range(60):
        t = "".join(rng.choice(letters, rng.integers(0, 60)))
        for _ in range(rng.integers(0, 4)):
            p = passage[rng.integers(0, 5)]
            a = rng.integers(0, len(p))
            t += p[a:] + "".join(rng.choice(letters, rng.integers(0, 9)))
        out.append((i, t))
    return [*out, (60, out[3][1]), (60, out[3][1]), (61, "a" * 300), (62, None), (63, "")]


@pytest.mark.parametrize("shard_bytes", [1 << 20, 400, 60])
def test_against_brute_force(spark, shard_bytes):
    """Also with groups too large for a shard, down to a window a piece."""
    rows = made_texts(shard_bytes)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(repeats.repeat_digests(docs, length=20, gram=8, shard_bytes=shard_bytes)) == plain(rows, 20)


def test_awkward_rows(spark, awkward, empty):
    rows = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    assert rows_of(repeats.repeat_digests(awkward)) == plain(rows, 200)
    assert repeats.repeat_digests(empty).collect() == []
    kept = {r["doc_id"]: bytes(r["kept"]) for r in repeats.without_repeats(awkward.where("doc_id in (3, 5, 7)")).collect()}
    assert kept == {3: b"   \n\t ", 5: b"", 7: b""}


def test_whole_table(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    got = QUERIES["op13_repeated_strings"](spark, SF)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert rows_of(got) == plain(rows, 200)
