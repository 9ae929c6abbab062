"""Quality classifier: hashed word n-gram logistic regression with FTRL updates (operator 2).

Tokens are runs of letters, digits or bytes beyond ASCII, and runs of other signs; white space parts them. Unigrams
and bigrams of tokens are hashed into a fixed number of buckets, and a bigram of two equal tokens has a bucket of its
own besides. All of a block of texts is hashed at once with array operations: a token's hash is a difference of
running polynomial sums. A text's value in a bucket is its share of the text's n-grams, scaled.

Weights come from follow-the-regularised-leader (FTRL-proximal) updates over a bounded sample of labelled rows. A
score is the sparse dot product of a text's values with the weights, through the logistic function.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provatab.llm.common import bytes_of, free_name, held_out, slices

# Buckets as a power of two, labelled rows learned from (half of each label at most), passes, bytes hashed at once.
BITS, ROWS, PASSES, BLOCK = 18, 6_000, 2, 1 << 20
SCALE = 8.0
_POWER = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _kinds() -> np.ndarray:
    """0: white space, 1: letters and digits and bytes beyond ASCII, 2: other signs."""
    kinds = np.full(256, 2, np.uint8)
    kinds[[ord(c) for c in " \t\n\x0b\x0c\r"]] = 0
    kinds[[i for i in range(128) if chr(i).isalnum()]] = 1
    kinds[128:] = 1
    return kinds


KINDS = _kinds()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_POWER), -1, 1 << 64))
    return (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, x)]), dtype=np.uint64) for x in (_POWER, inverse))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


class Hasher:
    """N-gram buckets of texts; the tables of powers are made once for a block."""

    def __init__(self, bits: int = BITS) -> None:
        self.bits = bits
        self.up, self.down = _powers(BLOCK)

    def tokens(self, text: bytes) -> np.ndarray:
        """Token hashes of one text, in order. Longer texts go in blocks that end where a token ends, if one does."""
        found, at = [], 0
        while at < len(text):
            stop = min(len(text), at + BLOCK)
            if stop < len(text):
                cut = max(text.rfind(b" ", at, stop), text.rfind(b"\n", at, stop))
                stop = cut if cut > at else stop
            found.append(self._tokens(np.frombuffer(text, np.uint8, stop - at, at)))
            at = stop
        return np.concatenate(found) if found else np.zeros(0, np.uint64)

    def _tokens(self, data: np.ndarray) -> np.ndarray:
        kinds = KINDS[data]
        edges = np.flatnonzero(np.diff(kinds)) + 1
        starts = np.concatenate([[0], edges])
        stops = np.append(edges, len(data))
        solid = kinds[starts] > 0
        starts, stops = starts[solid], stops[solid]
        sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], dtype=np.uint64)])
        return _mixed((sums[stops] - sums[starts]) * self.down[starts])

    def buckets(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the n-grams of all texts one after the other, and where each text's begin (n + 1 places)."""
        shift, out, ends = np.uint64(64 - self.bits), [], [0]
        run, size = [], 0

        def close() -> None:
            nonlocal run, size
            if not run:
                return
            # Texts joined by a line break: no token and no kept bigram crosses it.
            lengths = np.array([len(t) + 1 for t in run])
            text = b"\n".join(run)
            if len(run) == 1:
                hashes, owner = self.tokens(text), None
            else:
                data = np.frombuffer(text, np.uint8)
                hashes = self._tokens(data)
                kinds = KINDS[data]
                begin = np.flatnonzero((kinds > 0) & (np.diff(kinds, prepend=np.uint8(0)) != 0))
                owner = np.searchsorted(np.cumsum(lengths), begin, "right")
            inside = np.ones(max(0, len(hashes) - 1), bool) if owner is None else owner[1:] == owner[:-1]
            pair = _mixed(hashes[:-1] * np.uint64(3) + hashes[1:])[inside]
            equal = (hashes[:-1] == hashes[1:])[inside]
            same = np.full(int(equal.sum()), _mixed(np.array([7], np.uint64))[0])
            own = np.zeros(len(hashes), np.int64) if owner is None else owner
            left = own[:-1][inside]
            all_ = np.concatenate([hashes, pair, same])
            of = np.concatenate([own, left, left[equal]])
            order = np.argsort(of, kind="stable")
            out.append((all_[order] >> shift).astype(np.int32))
            ends.extend((ends[-1] + np.cumsum(np.bincount(of, minlength=len(run)))).tolist())
            run, size = [], 0

        for t in texts:
            if run and size + len(t) + 1 > BLOCK:
                close()
            run.append(t)
            size += len(t) + 1
            if size > BLOCK:
                close()
        close()
        return (np.concatenate(out) if out else np.zeros(0, np.int32)), np.array(ends, np.int64)


@dataclass
class Ftrl:
    """Logistic regression by FTRL-proximal updates, one row at a time."""

    size: int
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 1.0

    def __post_init__(self) -> None:
        self.z, self.n = np.zeros(self.size), np.zeros(self.size)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def update(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        """``at`` holds distinct places."""
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
        g = (p - label) * values
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, *, folds: int, fold: int, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents to learn from, half of each label at most: ``doc_id``, ``text``, ``y``.

    Taken by a hash of the id among rows outside the held-out fold. Labels other than 0 and 1 don't count; where labels
    of an id disagree the larger counts. The ids are chosen first, so only the sample's texts are gathered.
    """
    usable = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), folds, fold))
    one = usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    hashed = one.withColumn("_h", F.xxhash64("doc_id"))
    halves = [hashed.where(F.col("y") == y).orderBy("_h", "doc_id").limit(rows // 2) for y in (0, 1)]
    picked = halves[0].unionByName(halves[1]).select(F.col("doc_id").alias("_id"), "y")
    # At most ``rows`` ids.
    own = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id"))
    return own.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", *, folds: int = 3, fold: int = 1, rows: int = ROWS, bits: int = BITS) -> np.ndarray:
    """Weights of all buckets, the last one being the constant. Without rows of both labels all are zero.

    The executors hash the sample; the driver gets the buckets of ``rows`` texts at most and updates in the order of a
    hash, so the weights don't depend on partitions.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(bits)
        for batch in slices(batches, "text"):
            flat, ends = hasher.buckets(bytes_of(batch))
            at, values = [], []
            for a, b in zip(ends, ends[1:]):
                places, counts = np.unique(flat[a:b], return_counts=True)
                at.append(places.astype(np.int32).tobytes())
                values.append((counts * (SCALE / max(1, b - a))).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(at, pa.binary()), pa.array(values, pa.binary())], names=["doc_id", "y", "at", "values"])

    sample = labelled_sample(docs, labels, label, folds=folds, fold=fold, rows=rows)
    got = sample.mapInArrow(hashed, f"doc_id {dict(docs.dtypes)['doc_id']}, y int, at binary, values binary")
    model = Ftrl((1 << bits) + 1)
    rows_ = got.orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").select("y", "at", "values").toArrow().to_pylist()
    if len({r["y"] for r in rows_}) < 2:
        return np.zeros(model.size)
    for _ in range(PASSES):
        for r in rows_:
            at = np.append(np.frombuffer(r["at"], np.int32), 1 << bits)
            model.update(at, np.append(np.frombuffer(r["values"], np.float32), 1.0).astype(np.float64), r["y"])
    return model.weights()


def score(docs: DataFrame, weights: np.ndarray, *, name: str = "score") -> DataFrame:
    """``docs`` plus the score of each whole text, 0 to 1; a null or empty text has the constant's score."""
    bits = (len(weights) - 1).bit_length() - 1
    kept = docs.drop(name)
    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kept.schema]
    packed = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))  # 1 MB at 18 bits

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, w = Hasher(bits), packed.value
        for batch in slices(batches, "text"):
            flat, ends = hasher.buckets(bytes_of(batch))
            sums = np.concatenate([[0.0], np.cumsum(w[flat], dtype=np.float64)])
            sizes = np.maximum(1, np.diff(ends))
            margin = (sums[ends[1:]] - sums[ends[:-1]]) * SCALE / sizes + float(w[-1])
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            columns[name] = pa.array(1 / (1 + np.exp(-np.clip(margin, -500, 500))))
            yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    return kept.mapInArrow(work, ", ".join([*fields, f"`{name}` double"]))


def quality_scores(docs: DataFrame, labels: DataFrame, *, folds: int = 3, fold: int = 1) -> DataFrame:
    """Per document: whether it was held out, its score, and the label predicted at 0.5."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels, folds=folds, fold=fold))
    return scored.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, *, folds: int = 3, fold: int = 1) -> DataFrame:
    """``docs`` without those predicted to be of low quality."""
    name = free_name(docs, "_score")
    scored = score(docs, train(docs, labels, folds=folds, fold=fold), name=name)
    return scored.where(F.col(name) >= 0.5).drop(name)
