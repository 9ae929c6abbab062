"""Removal of long repeated byte strings through suffix arrays of shards (operator 13).

A string of ``length`` bytes is a window. Of the shorter grams in a window the one of the least hash is its anchor, so
equal windows have equal anchors, at the same place. Anchors that stand in one place only belong to no repeat. For the
others, the neighbourhood of the anchor, which holds all windows it stands for, goes to the shard of its hash, once
for equal neighbourhoods. A shard's neighbourhoods, parted by separators, get a suffix array by induced sorting and
common prefixes in text order: a window recurs if its suffix shares ``length`` bytes with one next to it in order.

Neighbourhoods of an anchor that are too many for a shard are cut into shorter ones that stand for fewer windows;
what all windows of a piece have in common then decides on the shard too. The last cut leaves one window a piece.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provatab.cluster import broadcast_if_small
from provatab.llm.common import bytes_of, slices, written
from provatab.llm.suffixes import common_prefixes, suffix_array

# Bytes of a gram; text bytes scanned at once; bytes of a group beyond which it is cut (shards are a quarter of that on
# average, where array sorts are cheapest); windows a piece stands for after each cut.
GRAM, SCAN_BYTES, SHARD_BYTES, CUTS = 64, 1 << 20, 1 << 20, (32, 8, 1)
# Repeated anchors (a long each) up to which they are sent to the tasks that look for them.
SENT_ANCHORS = 2_000_000
# Odd multipliers that spread numbers over 64 bits, and the inverse of the first.
SPREAD, MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
UNSPREAD = pow(SPREAD, -1, 1 << 64)


@functools.lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def _anchors(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the windows of each text, in order: text number, hash, place, first window, number of windows."""
    sizes = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer(b"".join(texts), np.uint8)
    n = len(codes)
    if n < length:
        return (np.zeros(0, np.int64),) * 5
    # Hash of a gram: its values times powers of an odd number, as a difference of running sums, mixed.
    spread = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(MIX)
    spread = (spread ^ (spread >> np.uint64(31))) * np.uint64(SPREAD)
    wide = 1 << (n - 1).bit_length()  # powers are kept for a few sizes
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread[codes] * _powers(SPREAD, wide)[:n])])
    h = (sums[gram:] - sums[:-gram]) * _powers(UNSPREAD, wide)[: n - gram + 1]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(MIX)
    h ^= h >> np.uint64(29)
    # Least hash of each window, the leftmost of equal ones, by doubling the reach of the minimum.
    least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    wide, reach = length - gram + 1, 1
    while reach * 2 <= wide:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < wide:
        least = np.minimum(least[: len(least) - (wide - reach)], least[wide - reach :])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), np.maximum(sizes - length + 1, 0))
    inside = np.arange(len(owner)) - (np.cumsum(np.maximum(sizes - length + 1, 0)) - np.maximum(sizes - length + 1, 0))[owner]
    place = place[starts[owner] + inside] - starts[owner]
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])])) if len(owner) else owner
    owner_, place_ = owner[new], place[new]
    return owner_, h[starts[owner_] + place_].view(np.int64), place_, inside[new], np.diff(np.append(new, len(owner)))


def keys(text: Column) -> list[Column]:
    """Two longs that stand for a text."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(text, F.lit(13)).alias("k2")]


def _texts(docs: DataFrame, length: int) -> DataFrame:
    """``k1``, ``k2`` and ``text`` of the texts that hold a window."""
    return docs.where(F.octet_length("text") >= length).select(*keys(F.col("text")), "text")


def repeated_anchors(texts: DataFrame, length: int, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """``(anchors, repeated)``: distinct ``hash`` of each text with its keys, and those that stand in several places."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SCAN_BYTES):
            owner, h, *_ = _anchors(bytes_of(batch), length, gram)
            order = np.lexsort((h, owner))
            owner, h = owner[order], h[order]
            first = np.ones(len(h), bool)
            first[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
            again = np.append(~first[1:], False)[first] if len(h) else first
            owner, h = owner[first], h[first]
            k1, k2 = (batch.column(c).to_numpy()[owner] for c in ("k1", "k2"))
            # A gram that a text holds twice bears two marks, as do the grams of two texts.
            for marks, rows in ((k1 ^ (k2 << 1), slice(None)), (~(k1 ^ (k2 << 1)), again)):
                if len(h[rows]):
                    own = isinstance(rows, slice)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[rows]), pa.array(marks[rows]), pa.array(k1[rows]), pa.array(k2[rows]), pa.array([own] * len(h[rows]))],
                        names=["hash", "mark", "k1", "k2", "own"],
                    )

    found = texts.mapInArrow(work, "hash long, mark long, k1 long, k2 long, own boolean")
    repeated = found.groupBy("hash").agg(F.min("mark").alias("a"), F.max("mark").alias("b")).where("a < b").select("hash")
    return found.where("own").select("hash", "k1", "k2"), repeated


PIECES = "g long, seg binary, k1 long, k2 long, at int, off int"


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    g, seg, k1, k2, at, off = zip(*rows) if rows else ((),) * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(g, pa.int64()), pa.array(seg, pa.binary()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(at, pa.int32()), pa.array(off, pa.int32())],
        names=["g", "seg", "k1", "k2", "at", "off"],
    )


def pieces(candidates: DataFrame, length: int, gram: int = GRAM) -> DataFrame:
    """Neighbourhoods of the repeated anchors of each candidate: group ``g``, bytes ``seg``, the text's keys, the
    place ``at`` of the first window, and ``off``, how far beyond it the anchor stands."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SCAN_BYTES):
            texts, wanted = bytes_of(batch), [set(x) for x in batch.column("hashes").to_pylist()]
            k1, k2 = batch.column("k1").to_pylist(), batch.column("k2").to_pylist()
            found = zip(*(x.tolist() for x in _anchors(texts, length, gram)))
            rows = [(h, texts[o][at : at + n + length - 1], k1[o], k2[o], at, p - at) for o, h, p, at, n in found if h in wanted[o]]
            for k in range(0, len(rows), 1 << 14):
                yield _piece_batch(rows[k : k + (1 << 14)])

    return candidates.mapInArrow(work, PIECES)


def cut(found: DataFrame, windows: int, length: int) -> DataFrame:
    """Pieces that stand for at most ``windows`` windows each; what these have in common becomes part of the group."""
    windows = min(windows, length)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                n, place, first = len(r["seg"]) - length + 1, r["off"], 0
                while first < n:
                    block = (place - first) // windows
                    end = place - block * windows  # last window any piece of this block can have
                    last, core = min(n - 1, end), r["seg"][end : end - windows + 1 + length]
                    g = xxhash.xxh64_intdigest(core, r["g"] + block & 0xFFFFFFFFFFFFFFFF)
                    rows.append((g - (1 << 64) if g >> 63 else g, r["seg"][first : last + length], r["k1"], r["k2"], r["at"] + first, place - first))
                    first = last + 1
            yield _piece_batch(rows)

    return found.mapInArrow(work, PIECES)


def recurring(segs: list[bytes], many: list[bool], length: int) -> list[list[int]]:
    """Of each neighbourhood, the stretches of windows (first, one beyond the last, and so on) that recur."""
    m = len(segs)
    sizes = np.array([len(s) for s in segs])
    ends = np.cumsum(sizes + 1) - 1
    t = np.frombuffer(b"\0".join([*segs, b""]), np.uint8).astype(np.int64) + m
    t[ends] = np.arange(m - 1, -1, -1)
    lengths, before = common_prefixes(t, suffix_array(t))
    again = lengths >= length
    again[before[again]] = True
    starts = ends - sizes
    for k in np.flatnonzero(many).tolist():
        again[starts[k] : ends[k] - length + 1] = True
    edges = np.flatnonzero(np.diff(np.concatenate([[0], again.view(np.int8), [0]])))
    owner = np.searchsorted(ends, edges[::2], "right")
    out: list[list[int]] = [[] for _ in segs]
    for k, a, b in zip(owner.tolist(), edges[::2].tolist(), edges[1::2].tolist()):
        out[k] += [a - int(starts[k]), b - int(starts[k])]
    return out


def repeated_windows(found: DataFrame, length: int, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``k1``, ``k2``, ``at`` and ``windows`` (stretches counted from ``at``) of the pieces with a recurring window."""
    done = None
    for windows in (*CUTS, None):
        distinct = written(found.groupBy("g", "seg").agg((F.count(F.lit(1)) > 1).alias("many")), "repeat-pieces")
        hot = distinct.groupBy("g").agg(F.sum(F.octet_length("seg")).alias("size")).where(F.col("size") > shard_bytes).select("g")
        hot = written(hot, "repeat-hot") if windows else hot.limit(0)
        some = bool(windows) and not hot.isEmpty()
        if some:
            hot = broadcast_if_small(hot)
            distinct = distinct.join(hot, "g", "left_anti")
        own = _in_shards(distinct, length, shard_bytes)
        refs = found.join(hot, "g", "left_anti") if some else found
        refs = refs.select("g", F.xxhash64("seg").alias("s"), "k1", "k2", "at")
        own = refs.join(own, ["g", "s"]).select("k1", "k2", "at", "windows")
        done = own if done is None else done.unionByName(own)
        if not some:
            return done
        found = written(cut(found.join(hot, "g"), windows, length), "repeat-cuts")
    return done


def _in_shards(distinct: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    size = distinct.agg(F.sum(F.octet_length("seg").cast("long"))).first()[0] or 0
    shards = int(4 * size // shard_bytes) + 1

    def work(table: pa.Table) -> pa.Table:
        segs = [s or b"" for s in table.column("seg").to_pylist()]
        found = recurring(segs, table.column("many").to_pylist(), length)
        hit = [k for k, x in enumerate(found) if x]
        return pa.table({"g": table.column("g").take(pa.array(hit, pa.int64())), "s": table.column("s").take(pa.array(hit, pa.int64())), "windows": pa.array([found[k] for k in hit], pa.list_(pa.int32()))})

    own = distinct.select("g", "seg", "many", F.xxhash64("seg").alias("s"), F.pmod(F.xxhash64("g"), F.lit(shards)).alias("shard"))
    return own.groupBy("shard").applyInArrow(work, "g long, s long, windows array<int>")


def _spans(places: list[dict], length: int) -> list[tuple[int, int]]:
    """Byte spans the windows cover, joined where they touch or overlap."""
    own = sorted((p["at"] + a, p["at"] + b - 1 + length) for p in places for a, b in zip(p["windows"][::2], p["windows"][1::2]))
    out: list[tuple[int, int]] = []
    for a, b in own:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def repeated_spans(docs: DataFrame, *, length: int = 200, gram: int = GRAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Distinct texts of ``docs`` that hold a repeated window: keys ``k1`` and ``k2``, ``spans`` (array of ``start, stop``
    in bytes, maximal and in order) and ``kept``, the bytes outside them.

    Repeats inside a text count, and so do those between different texts; a text that several rows have is taken once
    here (see :func:`without_repeats`).
    """
    texts = _texts(docs, length)
    anchors, repeated = repeated_anchors(texts, length, min(gram, length))
    repeated = broadcast_if_small(written(repeated, "repeat-anchors"), SENT_ANCHORS)
    held = anchors.join(repeated, "hash").groupBy("k1", "k2").agg(F.collect_set("hash").alias("hashes"))
    candidates = texts.groupBy("k1", "k2").agg(F.first("text").alias("text")).join(held, ["k1", "k2"])
    candidates = written(candidates, "repeat-texts")
    places = repeated_windows(pieces(candidates, length, min(gram, length)), length, shard_bytes)
    places = places.groupBy("k1", "k2").agg(F.collect_list(F.struct("at", "windows")).alias("places"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in slices(batches, "text"):
            spans, kept = [], []
            for text, own in zip(bytes_of(batch), batch.column("places").to_pylist()):
                spans.append(_spans(own, length))
                edges = [0, *(x for s in spans[-1] for x in s), len(text)]
                kept.append(b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2])]))
            listed = pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], kind)
            yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), listed, pa.array(kept, pa.binary())], names=["k1", "k2", "spans", "kept"])

    joined = candidates.join(places, ["k1", "k2"]).select("k1", "k2", "text", "places")
    return joined.mapInArrow(work, "k1 long, k2 long, spans array<struct<start: bigint, stop: bigint>>, kept binary")


def without_repeats(docs: DataFrame, *, length: int = 200, gram: int = GRAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (binary), its text as UTF-8
    bytes without every byte that a string of ``length`` bytes covers which also starts anywhere else.

    Null and empty texts, and those shorter than ``length``, stay whole (null as empty). A text that several rows
    have, repeated rows included, is removed whole from each of them. A null id stays null; other columns are not
    read; an empty table gives no rows. Cuts may part the bytes of a character, so ``kept`` is binary.
    """
    found = repeated_spans(docs, length=length, gram=gram, shard_bytes=shard_bytes)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return _by_row(docs, found.select("k1", "k2", removed.alias("n_removed"), F.size("spans").alias("n_spans"), "kept"), length, F.to_binary("text", F.lit("utf-8")), F.lit("").cast("binary"), "kept")


def _by_row(docs: DataFrame, found: DataFrame, length: int, whole: Column, nothing: Column, name: str) -> DataFrame:
    """``found`` (a row per text with spans) and whole removal of texts that several rows have, row by row."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), *keys(F.col("text")), whole.alias("_whole"))
    copies = rows.where(F.col("n_bytes") >= length).groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("copies"), F.max("n_bytes").alias("_all")).where("copies > 1")
    told = found.join(copies.drop("copies"), ["k1", "k2"], "full")
    gone = F.col("_all").isNotNull()
    told = told.select(
        "k1",
        "k2",
        F.coalesce("_all", "n_removed").alias("n_removed"),
        F.when(gone, 1).otherwise(F.col("n_spans")).alias("n_spans"),
        F.when(gone, nothing).otherwise(F.col(name)).alias(name),
    )
    # Written, so that the join reads two plain shuffles and the rows of a text with many copies can be split.
    told = broadcast_if_small(written(told, "repeat-told"))
    return rows.join(told, ["k1", "k2"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce(F.col(name), F.col("_whole")).alias(name),
    )


def repeat_digests(docs: DataFrame, *, length: int = 200, gram: int = GRAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` (see :func:`without_repeats`)."""
    found = repeated_spans(docs, length=length, gram=gram, shard_bytes=shard_bytes)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    found = found.select("k1", "k2", removed.alias("n_removed"), F.size("spans").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
    return _by_row(docs, found, length, F.sha2("text", 256), F.sha2(F.lit(""), 256), "kept_sha256")
