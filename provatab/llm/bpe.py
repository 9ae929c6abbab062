"""BPE encoding and decoding with a tokenization automaton (operator 8).

The automaton reads tokens. It starts with one state and a loop for each base symbol, so that every
sequence of symbols is accepted. Each merge (a, b) -> ab adds a gadget, in rank order:

* the arc b out of the state that ``a`` leads to is removed: a is no longer followed by b;
* every state with an arc ``a`` (after that removal) gets an arc ``ab``;
* ``ab`` leads to a state with the arcs that the state of ``b`` had before the gadget.

A state is known by the token that led to it, and a new state differs from the one it was copied
from by removed arcs only. The compiled table therefore holds, for each token, the state and the arc
it was copied from and when, and the removed arcs with the merge that removed them. An arc is looked
up by following the copies back; looked-up arcs are kept in a dictionary.

A word has one path of arcs whose labels spell it, and that path is its encoding. Decoding emits the
labels of the arcs taken.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from provatab.llm import tokenizer_files as files
from provatab.llm.common import Kept, slices, texts_of

# Bytes of a word beyond which its beginnings aren't kept.
LONG = 48
# Entries a worker keeps, some 120 MB when all are full: encodings of words and of what stands between spaces (twice
# as many of each), paths of beginnings, and arcs. Text bytes encoded at once.
KEPT_WORDS, KEPT_PARTS, KEPT_PATHS, KEPT_ARCS, READ_BYTES = 150_000, 120_000, 150_000, 300_000, 1 << 20


class Automaton:
    """Deterministic: at each position of a word, one arc at most ends the path so far."""

    def __init__(self, data: files.TokenizerFile) -> None:
        size = max([*data.vocab.values(), *data.special.values()]) + 1
        self.born = [-1] * size
        self.row_of = list(range(size))
        self.column_of = list(range(size))
        self.removed: dict[int, int] = {}
        self.size = size
        for time, (a, b, ab) in enumerate(data.merges):
            self.removed.setdefault(a * size + b, time)
            self.born[ab], self.row_of[ab], self.column_of[ab] = time, b, a
        self.arcs: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}
        letters = files.byte_letters()
        back = {ord(c): b for b, c in letters.items()}
        self.labels = [""] * size
        self.inner: dict[bytes, int] = {}
        self.last: dict[bytes, int] = {}
        end = data.word_end
        for token, i in data.vocab.items():
            self.labels[i] = token
            closes = bool(end) and token.endswith(end)
            spelled = token[: len(token) - len(end)] if closes else token
            (self.last if closes or not end else self.inner)[bytes(back[ord(c)] for c in spelled)] = i
        if not end:
            self.inner = self.last
        for text, i in data.special.items():
            self.labels[i] = text
        self.paths: dict[bytes, tuple[int, ...]] = {}
        self.ends_inner: dict[bytes, int] = {}
        self.ends_last: dict[bytes, int] = {}
        for table, ends in ((self.inner, self.ends_inner), (self.last, self.ends_last)):
            for spelled in table:
                ends[spelled[-4:]] = max(len(spelled), ends.get(spelled[-4:], 0))
        # Length of the longest label by its first four bytes; without an entry a label has three at most.
        self.reach: dict[bytes, int] = {}
        for spelled in [*self.inner, *self.last]:
            self.reach[spelled[:4]] = max(len(spelled), self.reach.get(spelled[:4], 0))

    def arc(self, state: int, label: int) -> bool:
        """Whether the state of token ``state`` has an arc ``label`` after all gadgets."""
        key = state * self.size + label
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) >= KEPT_ARCS:
                self.arcs.clear()
            known = self.arcs[key] = self._arc(state, label)
        return known

    def _arc(self, state: int, label: int, before: int = 1 << 62) -> bool:
        """The same after the gadgets of all merges before ``before``."""
        born = self.born
        while True:
            gone = self.removed.get(state * self.size + label)
            if gone is not None and gone < before:
                return False
            if born[state] < 0 and born[label] < 0:
                return True
            if born[label] > born[state]:
                before, label = min(before, born[label] + 1), self.column_of[label]
            else:
                before, state = born[state], self.row_of[state]

    def encode(self, word: bytes) -> tuple[int, ...]:
        """Ids of a word: the only path of arcs that spells it."""
        if len(word) > LONG:
            return self._walk(word)
        try:
            return self._path(word, self.last, self.ends_last)
        except LookupError:
            return self._walk(word)

    def _path(self, word: bytes, table: dict[bytes, int], ends: dict[bytes, int]) -> tuple[int, ...]:
        """Path of a short word, from the kept paths of its beginnings."""
        n = len(word)
        arcs, size, paths = self.arcs, self.size, self.paths
        for begin in range(max(0, n - ends.get(word[-4:], 3)), n):
            token = table.get(word[begin:])
            if token is None:
                continue
            if not begin:
                if self._alone(token):
                    return (token,)
                continue
            head = paths.get(word[:begin])
            if head is None:
                if len(paths) >= KEPT_PATHS:
                    paths.clear()
                head = paths[word[:begin]] = self._path(word[:begin], self.inner, self.ends_inner)
            key = head[-1] * size + token
            there = arcs.get(key)
            if self.arc(head[-1], token) if there is None else there:
                return (*head, token)
        raise LookupError(word)

    def _walk(self, word: bytes) -> tuple[int, ...]:
        """Path of a word of any length.

        Longest labels are tried first. A position is reached by one path only, so one that leads nowhere is
        not entered again and the work is linear in the word.
        """
        n = len(word)
        inner, last, reach, arcs, size = self.inner, self.last, self.reach, self.arcs, self.size
        path: list[int] = []
        begins: list[int] = []
        dead: set[int] = set()
        state = begin = 0
        end = min(n, reach.get(word[:4], 3))
        while True:
            while end > begin:
                token = (last if end == n else inner).get(word[begin:end])
                if token is not None and end not in dead:
                    if not begin:
                        if self._alone(token):
                            break
                    else:
                        there = arcs.get(state * size + token)
                        if self.arc(state, token) if there is None else there:
                            break
                end -= 1
            if end > begin:
                path.append(token)
                if end == n:
                    return tuple(path)
                begins.append(begin)
                state, begin = token, end
            else:
                dead.add(begin)
                path.pop()
                state, end, begin = path[-1] if path else 0, begin - 1, begins.pop()
                continue
            end = min(n, begin + reach.get(word[begin : begin + 4], 3))

    def _alone(self, token: int) -> bool:
        """Whether the token's own spelling leads to it: its parts must follow each other when it is made."""
        known = self.alone.get(token)
        if known is None:
            a, b, born = self.column_of[token], self.row_of[token], self.born[token]
            known = born < 0 or self._alone(a) and self._alone(b) and self._arc(a, b, born)
            self.alone[token] = known
        return known


@functools.lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    return Automaton(files.load(path))


class Encoder:
    """Ids of whole texts. White space always ends a word, so what stands between spaces is encoded once and kept."""

    def __init__(self, path: str) -> None:
        self.automaton = automaton(path)
        self.special = files.load(path).special
        self.cutter = files.special_cutter(path)
        self.kept = Kept(KEPT_PARTS, self.part)
        self.kept_words = Kept(KEPT_WORDS, lambda w: self.automaton.encode(w.encode()))

    def part(self, part: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable([self.kept_words[w] for w in files.part_words(part)]))

    def plain(self, text: str) -> Iterator[int]:
        return chain.from_iterable(map(self.kept.__getitem__, text.replace("\n", " ").split(" ")))

    def encode(self, text: str) -> list[int]:
        if self.cutter is None or "<" not in text or not self.cutter.search(text):
            return list(self.plain(text))
        ids, at = [], 0
        for m in self.cutter.finditer(text):
            ids += self.plain(text[at : m.start()])
            ids.append(self.special[m.group()])
            at = m.end()
        return ids + list(self.plain(text[at:]))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def decode(ids: list[int], labels: list[str]) -> str:
    """Labels of the arcs taken, joined by one space, as a file without a decoder of its own asks for."""
    return " ".join([labels[i] for i in ids])


def encode_documents(docs: DataFrame, path: str, *, column: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` plus ``ids`` (array of int) and, if asked for, ``decoded`` (the text decoded from those ids).

    Every whole text is encoded; null and empty texts have no ids and decode to an empty text. Columns of those
    names are replaced. Rows are worked on one by one: no shuffle, repeated rows stay, order of columns stays.
    """
    kept = docs.drop("ids", "decoded")
    added = "ids array<int>" + ", decoded string" * decoded
    schema = ", ".join([*(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kept.schema), added])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in slices(batches, column, READ_BYTES):
            ids = [e.encode(t) for t in texts_of(batch, column)]
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
            if decoded:
                columns["decoded"] = pa.array([decode(i, e.automaton.labels) for i in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    return kept.mapInArrow(work, schema)


def encoding_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: how many ids, and digests of the ids and of the text decoded from them.

    Made where the text is encoded, so neither ids nor decoded texts leave the worker. Null and empty texts have no
    ids and decode to an empty text; repeated rows stay; other columns are not read.
    """
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        labels = e.automaton.labels
        numbers = [str(i) for i in range(len(labels))]
        for batch in slices(batches, "text", READ_BYTES):
            counts, coded, decoded = [], [], []
            for text in texts_of(batch):
                ids = e.encode(text)
                counts.append(len(ids))
                coded.append(hashlib.sha256(" ".join([numbers[i] for i in ids]).encode()).hexdigest())
                decoded.append(hashlib.sha256(decode(ids, labels).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())], names=names)

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
