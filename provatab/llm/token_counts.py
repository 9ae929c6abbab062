"""Token counts by rank-synchronous array merging (operator 3).

Pre-tokens are held as one ragged numpy array of symbols. In each round every sequence finds its
pair of lowest rank and merges all its occurrences, all sequences at once; sequences without a
mergeable pair leave the array. What counts is how many symbols survive.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provatab.llm import tokenizer_files as files
from provatab.llm.common import Kept, slices, texts_of

# Counts a worker keeps, twice of each kind; symbols merged at once.
KEPT, SYMBOLS = 200_000, 2_000_000
# White space that meets white space or an end of the text: its pieces depend on what stands around them.
_LOOSE = re.compile(r"\s\s|^\s|\s\Z")


class Merges:
    """Ranks of symbol pairs in an open-addressing table, looked up for whole arrays."""

    def __init__(self, data: files.TokenizerFile) -> None:
        letters = files.byte_letters()
        self.of_byte = np.array([data.vocab[letters[b]] for b in range(256)], np.int64)
        self.made = np.array([m[2] for m in data.merges], np.int64)
        self.none = len(data.merges)
        bits = max(4, (4 * max(1, self.none)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, self.none, np.int64)
        self.probes = 1
        for rank, (a, b, _) in enumerate(data.merges):
            key = a << 32 | b
            at, n = int(self._slots(np.array([key]))[0]), 1
            while self.keys[at] >= 0 and self.keys[at] != key:
                at, n = (at + 1) & self.mask, n + 1
            if self.keys[at] < 0:
                self.keys[at], self.ranks[at] = key, rank
            self.probes = max(self.probes, n)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a << 32 | b
        at = self._slots(keys)
        out = np.where(self.keys[at] == keys, self.ranks[at], self.none)
        open_ = np.flatnonzero((out == self.none) & (self.keys[at] >= 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & self.mask
            found = self.keys[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[(found >= 0) & ~hit]
        return out

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Surviving symbols of each piece."""
        counts = np.zeros(len(pieces), np.int64)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        at = 0
        while at < len(pieces):  # runs of about SYMBOLS symbols
            ends = np.cumsum(sizes[at:])
            n = max(1, int(np.searchsorted(ends, SYMBOLS, "right")))
            counts[at : at + n] = self._merged(b"".join(pieces[at : at + n]), sizes[at : at + n])
            at += n
        return counts

    def _merged(self, spelled: bytes, sizes: np.ndarray) -> np.ndarray:
        counts = sizes.copy()
        symbols = self.of_byte[np.frombuffer(spelled, np.uint8)]
        owner = np.repeat(np.arange(len(sizes)), sizes)
        while len(symbols) > 1:
            inside = owner[1:] == owner[:-1]
            ranks = np.full(len(symbols), self.none, np.int64)  # of the pair that begins at a symbol
            first = np.flatnonzero(inside)
            ranks[first] = self.rank(symbols[first], symbols[first + 1])
            starts = np.flatnonzero(np.concatenate(([True], ~inside)))
            lowest = np.minimum.reduceat(ranks, starts)
            lengths = np.diff(np.append(starts, len(symbols)))
            going = lowest < self.none
            counts[owner[starts]] = lengths
            if not going.any():
                break
            per_symbol = np.repeat(np.where(going, lowest, -1), lengths)
            merge = ranks == per_symbol
            # Occurrences may overlap where both symbols are equal: every second of a run counts, from its left.
            overlaps = np.flatnonzero(merge[1:] & merge[:-1])
            if len(overlaps):
                index = np.flatnonzero(merge)
                new_run = np.concatenate(([True], np.diff(index) > 1))
                run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(index)), 0))
                merge[index[(np.arange(len(index)) - run_start) % 2 == 1]] = False
            keep = np.repeat(going, lengths)
            keep[1:] &= ~merge[:-1]
            symbols[merge] = self.made[per_symbol[merge]]
            symbols, owner = symbols[keep], owner[keep]
            if len(symbols):
                left = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
                counts[owner[left]] = np.diff(np.append(left, len(owner)))
        return counts


@functools.lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(files.load(path))


class Counter:
    """Tokens of whole texts. A text without loose white space falls into parts at its spaces, whose counts are kept."""

    def __init__(self, path: str) -> None:
        self.merges = merges(path)
        self.cutter = files.special_cutter(path)
        self.pieces, self.parts, self.firsts = Kept(KEPT), Kept(KEPT), Kept(KEPT)

    def fill(self, kept: Kept, asked: set[str], pieces_of) -> dict[str, int]:
        """Counts of all that is asked for; what isn't kept is made in one go."""
        known, new = {}, []
        for key in asked:
            n = kept.get(key) or kept.recall(key)
            if n is None:
                new.append(key)
            else:
                known[key] = n
        if new:
            cut = [pieces_of(k) for k in new]
            flat = list({p for c in cut for p in c})
            fresh = dict(zip(flat, self.merges.count([p.encode() for p in flat]).tolist(), strict=True))
            for key, c in zip(new, cut, strict=True):
                known[key] = sum([fresh[p] for p in c])
                kept.put(key, known[key])
        return known

    def count(self, texts: list[str]) -> list[int]:
        tight, loose, specials = [], [], [0] * len(texts)
        for i, text in enumerate(texts):
            bits = [text]
            if self.cutter is not None and "<" in text:
                bits = self.cutter.split(text)
                specials[i] = len(bits) - 1
            for bit in bits:
                if bit:
                    (loose if _LOOSE.search(bit) else tight).append((i, bit))
        cut = [(i, bit.split(" ")) for i, bit in tight]
        first = self.fill(self.firsts, {p[0] for _, p in cut}, files.byte_pieces)
        part = self.fill(self.parts, {x for _, p in cut for x in p[1:]}, lambda p: files.byte_pieces(" " + p))
        whole = [(i, files.byte_pieces(bit)) for i, bit in loose]
        piece = self.fill(self.pieces, {x for _, p in whole for x in p}, lambda p: [p])
        for i, p in cut:
            specials[i] += first[p[0]] + sum(map(part.__getitem__, p[1:]))
        for i, p in whole:
            specials[i] += sum(map(piece.__getitem__, p))
        return specials


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, *, column: str = "text") -> DataFrame:
    """``docs`` plus ``n_tokens``: tokens of each whole text, special strings counted as one.

    Null and empty texts have none. A column ``n_tokens`` is replaced; rows are worked on one by one, so repeated
    rows stay and nothing is shuffled.
    """
    kept = docs.drop("n_tokens")
    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kept.schema]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in slices(batches, column):
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            columns["n_tokens"] = pa.array(c.count(texts_of(batch, column)), pa.int64())
            yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    return kept.mapInArrow(work, ", ".join([*fields, "n_tokens long"]))


def token_counts(docs: DataFrame, path: str, *, limit: int = 1024) -> DataFrame:
    """Per document: bytes, tokens, and whether it has more than ``limit`` tokens."""
    return count_tokens(docs.select("doc_id", "text"), path).select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
