"""Removal of lines that many documents share (operator 5).

Each document gives its distinct line keys once, as (hash, document, places). The hashes are range-partitioned and
sorted by document and place within a hash; a pass over the sorted rows meets each hash's documents one after the
other and counts first occurrences. The range key holds the document too, so a hash that a third of all documents
share spreads over many partitions; a hash cut by a border is settled by adding up the counts from both sides.
What comes back is a compressed bitmap of kept lines per document, never text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provatab.cluster import broadcast_if_small
from provatab.llm.common import LOWER, LOWERED, SPACES, UPPER, bytes_of, free_name, slices, text_key, written

_SPACES = SPACES.encode()
# Places of lines whose hash is settled, of lines of a hash at a partition's border, and that hash's count there.
DROP, OPEN, COUNT = 0, 1, 2


def line_keys(docs: DataFrame, *, min_chars: int = 1) -> DataFrame:
    """Distinct keys of each row of ``docs``: ``hash``, ``doc_id``, ``_text_key``, ``places`` (packed line numbers).

    A key is the line without white space at its ends, A-Z lower-cased; keys below ``min_chars`` code points have
    no row.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            rows, hashes, places = [], [], []
            for row, text in enumerate(bytes_of(batch)):
                found: dict[bytes, list[int]] = {}
                for place, line in enumerate(text.translate(LOWERED).split(b"\n")):
                    key = line.strip(_SPACES)
                    if len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars):
                        found.setdefault(xxhash.xxh3_128_digest(key), []).append(place)
                rows += [row] * len(found)
                hashes += found
                places += [np.array(p, "<u4").tobytes() for p in found.values()]
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.binary()), batch.column("doc_id").take(at), batch.column("_text_key").take(at), pa.array(places, pa.binary())],
                names=["hash", "doc_id", "_text_key", "places"],
            )

    own = docs.select("doc_id", "text", text_key(F.col("text")).alias("_text_key"))
    return own.mapInArrow(work, f"hash binary, doc_id {dict(docs.dtypes)['doc_id']}, _text_key long, places binary")


def shared_lines(docs: DataFrame, *, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Places of lines whose key at least ``min_docs`` documents have: ``doc_id``, ``_text_key``, ``places``.

    Documents are told apart by ``doc_id``: rows that share one (or have none) count once.
    """
    id_type = dict(docs.dtypes)["doc_id"]
    ranged = line_keys(docs, min_chars=min_chars).repartitionByRange("hash", "doc_id").sortWithinPartitions("hash", "doc_id", "_text_key")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of the run of one hash that is being read: whether it is the partition's first, documents so far, last
        # document, and rows held back while the documents are too few.
        current, first, count, last_doc = None, True, 0, None
        held: list[pa.RecordBatch] = []

        def rows(batch: pa.RecordBatch, kind: int) -> pa.RecordBatch:
            n = batch.num_rows
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, kind, np.int32)), *[batch.column(c) for c in ("hash", "doc_id", "_text_key", "places")], pa.nulls(n, pa.int64())],
                names=["kind", "hash", "doc_id", "_text_key", "places", "n"],
            )

        def close(border: bool) -> Iterator[pa.RecordBatch]:
            """End of a run; at a border its count goes to the other side, and so do rows that are held back."""
            if border and current is not None:
                if count < min_docs:
                    yield from (rows(b, OPEN) for b in held)
                one = rows(pa.RecordBatch.from_pylist([{"hash": current}], schema_read), COUNT)
                yield one.set_column(5, "n", pa.array([count], pa.int64()))

        schema_read = None
        for batch in batches:
            if not batch.num_rows:
                continue
            schema_read = batch.schema
            hashes = batch.column("hash").to_pylist()
            docs_ = batch.column("doc_id").to_pylist()
            n = len(hashes)
            # Beginnings of runs of one hash within the batch.
            starts = [0, *[i for i in range(1, n) if hashes[i] != hashes[i - 1]], n]
            settled: list[np.ndarray] = []
            for a, b in zip(starts, starts[1:]):
                if hashes[a] != current:
                    if current is not None:
                        yield from close(first)
                        first = False
                    current, count, last_doc, held = hashes[a], 0, None, []
                was = count
                for i in range(a, b):
                    if count == 0 or docs_[i] != last_doc:
                        count, last_doc = count + 1, docs_[i]
                if count >= min_docs:
                    if was < min_docs and held:
                        yield from (rows(h, DROP) for h in held)
                        held = []
                    settled.append(np.arange(a, b))
                elif first or b == n:
                    held.append(batch.slice(a, b - a))
            if settled:
                yield rows(batch.take(pa.array(np.concatenate(settled))), DROP)
        yield from close(True)

    schema = f"kind int, hash binary, doc_id {id_type}, _text_key long, places binary, n long"
    passed = written(ranged.mapInArrow(stream, schema), "line-runs")
    # Two hashes at most for each partition, and fewer than min_docs documents of each: settled by their sums.
    frequent = passed.where(F.col("kind") == COUNT).groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs)
    late = passed.where(F.col("kind") == OPEN).join(broadcast_if_small(frequent.select("hash")), "hash", "left_semi")
    columns = ["doc_id", "_text_key", "places"]
    return passed.where(F.col("kind") == DROP).select(*columns).unionByName(late.select(*columns))


def keep_bitmaps(docs: DataFrame, *, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Per document that loses lines: ``doc_id``, ``_text_key``, ``n_dropped`` and ``dropped``, a deflated bitmap with a
    bit for each line up to the last dropped one (1: the line goes, lowest bit first); lines beyond it stay.

    Documents without a row keep every line. Rows of equal id and text share one bitmap.
    """
    id_type = dict(docs.dtypes)["doc_id"]
    # The places of one document only: at most its number of lines.
    gathered = shared_lines(docs, min_docs=min_docs, min_chars=min_chars).groupBy("doc_id", "_text_key").agg(F.collect_list("places").alias("places"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, counts = [], []
            for packed in batch.column("places").to_pylist():
                places = np.unique(np.frombuffer(b"".join(packed), "<u4"))
                mask = np.zeros(int(places[-1]) + 1, bool)
                mask[places] = True
                bits.append(zlib.compress(np.packbits(mask, bitorder="little").tobytes(), 1))
                counts.append(len(places))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_text_key"), pa.array(counts, pa.int64()), pa.array(bits, pa.binary())],
                names=["doc_id", "_text_key", "n_dropped", "dropped"],
            )

    return gathered.mapInArrow(work, f"doc_id {id_type}, _text_key long, n_dropped long, dropped binary")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with the kept lines as ``text`` and new columns ``n_lines`` (before) and ``n_dropped``.

    A text whose lines are all kept stays as it is; null stays null unless lines go. A document that loses all its
    lines has an empty text. Other columns stay; ones called ``n_lines`` or ``n_dropped`` are replaced.
    """
    own = docs.drop("n_lines", "n_dropped")
    bits, key = free_name(own, "_bits"), free_name(own, "_key")
    keyed = own.withColumn(key, text_key(F.col("text")))
    marks = bitmaps.select(F.col("doc_id").alias("_id"), F.col("_text_key").alias("_of"), F.col("dropped").alias(bits))
    same = keyed["doc_id"].eqNullSafe(marks["_id"]) & (keyed[key] == marks["_of"])
    joined = keyed.join(marks, same, "left").select(*[keyed[c] for c in own.columns], marks[bits])
    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.drop("n_lines", "n_dropped").schema]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts, lines, dropped = batch.column("text").to_pylist(), [], []
            for i, marks_ in enumerate(batch.column(bits).to_pylist()):
                text = texts[i] or ""
                lines.append(text.count("\n") + 1)
                dropped.append(0)
                if marks_ is not None:
                    mask = np.unpackbits(np.frombuffer(zlib.decompress(marks_), np.uint8), bitorder="little").tolist()
                    cut = text.split("\n")
                    kept = [x for x, gone in zip(cut, mask) if not gone] + cut[len(mask) :]
                    texts[i] = "\n".join(kept)
                    dropped[-1] = len(cut) - len(kept)
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names) if n != bits}
            columns |= {"text": pa.array(texts, pa.string()), "n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())}
            yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    return joined.mapInArrow(work, ", ".join([*fields, "n_lines long, n_dropped long"]))


def drop_shared_lines(docs: DataFrame, *, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` without the lines that at least ``min_docs`` documents have; see ``apply_bitmaps``."""
    return apply_bitmaps(docs, keep_bitmaps(docs, min_docs=min_docs, min_chars=min_chars))


def line_digests(docs: DataFrame, *, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Per document: lines before dropping, lines dropped, digest of what stays."""
    done = drop_shared_lines(docs.select("doc_id", "text"), min_docs=min_docs, min_chars=min_chars)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL = f"""
with lines as (
  select doc_id, coalesce(text, '') as text, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place
  from documents
),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') as key
  from lines
),
shared as (select key from keyed where length(key) >= 1 group by key having count(distinct doc_id) >= 10)
select doc_id, count(*) as n_lines, count(*) filter (shared.key is not null) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by place) filter (shared.key is null), '')) as kept_sha256
from keyed left join shared using (key)
group by doc_id
"""
