"""Near-duplicates by SimHash with deletion-variant signatures (operator 6).

Fingerprints link at ``distance`` or fewer differing bits. The 64 bits are cut into the fewest segments of which one
must differ by one bit at most (three for a distance of 4). Each distinct fingerprint is indexed under every segment
with one bit taken out; two fingerprints whose segment differs by at most one bit share the variant without that bit.
Fingerprints that meet under a variant are verified on all 64 bits.

A group of thousands of near copies meets whole under some variants. Its links are not written out as pairs: each
meeting gives a forest that joins what its links join, so components stay the same. A large meeting is dealt into
blocks, and each two blocks meet in a task of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provatab.cluster import broadcast_if_small, shuffled
from provatab.llm.common import LOWERED, bytes_of, slices, text_key, written

# Fixed value: seed of the shingle hash. Shingles counted at once; fingerprints in a block of a large meeting.
SEED, SHINGLES, BLOCK = 42, 1 << 15, 1024


def fingerprint(text: bytes, width: int = 4) -> int:
    """64-bit majority of the XXH64 of all shingles of ``width`` words, repeats included; 0 without words."""
    words = text.translate(LOWERED).split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    stops = ends[min(width, len(words)) - 1 :].tolist()
    digest, counts = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES):
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + SHINGLES], stops[at : at + SHINGLES])])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, *, width: int = 4) -> DataFrame:
    """``doc_id``, ``_text_key`` and ``fingerprint`` (its 64 bits as a signed long) of each row; null is an empty text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            prints = np.array([fingerprint(t, width) for t in bytes_of(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_text_key"), pa.array(prints)], names=["doc_id", "_text_key", "fingerprint"])

    own = docs.select("doc_id", "text", text_key(F.col("text")).alias("_text_key"))
    return own.mapInArrow(work, f"doc_id {dict(docs.dtypes)['doc_id']}, _text_key long, fingerprint long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def segments(distance: int) -> list[tuple[int, int]]:
    """First bit and size of the fewest segments of which one differs by one bit at most."""
    n = distance // 2 + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def variants(prints: DataFrame, distance: int) -> DataFrame:
    """``bit``, ``rest`` and ``fingerprint``: each segment without each of its bits in turn."""
    keys = []
    for first, size in segments(distance):
        segment = ((1 << size) - 1) << first
        keys += [(bit, _signed(segment & ~(1 << bit))) for bit in range(first, first + size)]
    cut = [F.struct(F.lit(bit).alias("bit"), F.col("fingerprint").bitwiseAND(F.lit(mask)).alias("rest")) for bit, mask in keys]
    return prints.select("fingerprint", F.explode(F.array(*cut)).alias("v")).select("v.bit", "v.rest", "fingerprint")


def _forest(prints: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Links that join what all links within ``distance`` join: each print is entered once."""
    left = np.ones(len(prints), bool)
    for root in range(len(prints)):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue:
            at = queue.pop()
            free = np.flatnonzero(left)
            if not len(free):
                return
            near = free[np.bitwise_count(prints[free] ^ prints[at]) <= distance]
            left[near] = False
            for x in near.tolist():
                yield at, x
            queue += near.tolist()


def links(prints: DataFrame, *, distance: int = 4, block: int = BLOCK) -> DataFrame:
    """Links ``a`` < ``b`` between distinct fingerprints that join all that lie within ``distance``."""
    keyed = variants(prints, distance)
    sizes = keyed.groupBy("bit", "rest").agg(F.count(F.lit(1)).alias("n"), F.min("fingerprint").alias("a"), F.max("fingerprint").alias("b")).where(F.col("n") > 1)
    sizes = written(sizes, "simhash-meetings")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    pairs = sizes.where((F.col("n") == 2) & close).select("a", "b")
    large = sizes.where(F.col("n") > 2).select("bit", "rest", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    met = shuffled(keyed).join(large, ["bit", "rest"])
    own = F.pmod(F.xxhash64("fingerprint", F.lit(7)), F.col("blocks")).cast("int")
    dealt = (
        met.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("bit", "rest", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fingerprint")
        .repartition("bit", "rest", "i", "j")
        .sortWithinPartitions("bit", "rest", "i", "j", "fingerprint")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A meeting has two blocks at most, so the one that is being read fits in memory.
        carried, key = np.zeros(0, np.uint64), None
        for batch in chain((b for b in batches if b.num_rows), [None]):
            out: list[tuple[int, int]] = []
            if batch is None:
                runs = [(None, np.zeros(0, np.uint64))]
            else:
                columns = [batch.column(c).to_numpy() for c in ("bit", "rest", "i", "j")]
                prints_ = batch.column("fingerprint").to_numpy().view(np.uint64)
                changed = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
                runs = [(tuple(c[a] for c in columns), prints_[a:b]) for a, b in zip([0, *changed], [*changed, len(prints_)])]
            for k, own_ in runs:
                if k == key:
                    carried = np.concatenate([carried, own_])
                    continue
                out += [(int(carried[x]), int(carried[y])) for x, y in _forest(carried, distance)]
                key, carried = k, own_
            if out:
                ends = np.array(out, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ends.min(axis=1)), pa.array(ends.max(axis=1))], names=["a", "b"])

    return pairs.unionByName(dealt.mapInArrow(work, "a long, b long")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of an edge ``a`` < ``b``.

    Alternates two steps until the edges stay: all larger neighbours of a node move to its smallest one, then each
    node and its smaller neighbours move to the smallest of them. Components end as stars after a number of rounds
    that grows with the logarithm of their size; each round is written out.
    """
    edges = written(edges, "simhash-edges")
    known = None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(least, "b")
        small = joined.select(F.col("m").alias("a"), F.col("a").alias("b")).where("a < b").unionByName(joined.select(F.col("m").alias("a"), "b")).distinct()
        edges = written(small, "simhash-edges")
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == known:
            break
        known = mark
    nodes = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return nodes.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def near_duplicates(docs: DataFrame, *, width: int = 4, distance: int = 4) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``_text_key``, ``fingerprint`` (long), ``root`` (a fingerprint that names the
    component) and ``component_id``, the smallest id reachable by links.

    Null and empty texts have fingerprint 0 and link like any other. Rows without an id get the component of their
    fingerprint; it is null where no row of the component has an id.
    """
    prints = written(fingerprints(docs, width=width), "simhash-prints")
    distinct = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(links(distinct.select("fingerprint"), distance=distance))
    rooted = distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    rooted = written(rooted, "simhash-roots")
    least = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-least")
    classes = rooted.join(least, "root").select("fingerprint", "root", "component_id")
    return prints.join(classes, "fingerprint").select("doc_id", "_text_key", "fingerprint", "root", "component_id")


def component_rows(docs: DataFrame, *, width: int = 4, distance: int = 4) -> DataFrame:
    """Per row: ``doc_id``, the fingerprint as 16 lower-case hexadecimal digits, ``component_id``."""
    found = near_duplicates(docs, width=width, distance=distance)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, *, width: int = 4, distance: int = 4) -> DataFrame:
    """``docs`` with one row of each component."""
    return keep_heads(docs, near_duplicates(docs, width=width, distance=distance))


def keep_heads(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with one row of each ``root`` of ``found``: the one of the smallest id (rows without one come last), of
    equal ids the one whose text hashes smallest, of equal rows any one."""
    found = written(found, "copies-classes")
    rows = found.groupBy("root", "doc_id", "_text_key").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_text_key")
    # Written, so that the join below reads two plain shuffles and a large component can be split.
    heads = written(found.groupBy("root").agg(F.min(order).alias("head")), "simhash-heads")
    marked = rows.join(heads, "root").withColumn("stays", order == F.col("head"))
    keys = [F.col("doc_id").alias("__id"), F.col("_text_key").alias("__key")]
    # Rows that go, and rows that stay of which there are several.
    marked = written(marked.where(~F.col("stays") | (F.col("n") > 1)).select(*keys, "stays"), "simhash-marked")
    key = text_key(docs["text"])

    def joined(side: DataFrame, how: str) -> DataFrame:
        side = broadcast_if_small(side, 200_000)
        return docs.join(side, docs["doc_id"].eqNullSafe(side["__id"]) & (key == side["__key"]), how)

    kept = joined(marked.select("__id", "__key"), "left_anti")
    again = marked.where("stays").select("__id", "__key")
    return kept if again.isEmpty() else kept.unionByName(joined(again, "left_semi").dropDuplicates(["doc_id", "text"]))
