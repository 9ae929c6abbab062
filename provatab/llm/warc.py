"""WARC archives with an index first (operator 4).

Writing: each task writes its records, one gzip member each, into archives of its own in the shared folder, and
returns an index row per record: archive, offset, length, URL, digest. The index is a Parquet table; it names only
archives of tasks that succeeded, so a lost executor leaves at most files that nothing names.

Reading: selected index rows are grouped by archive and sorted by offset; neighbouring byte ranges are coalesced into
one read each, and the records are parsed from it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provatab.cluster import broadcast_if_small
from provatab.llm.common import bytes_of, shared_folder, slices, written

# Bytes after which a task begins its next archive; gap and size up to which ranges are read at once.
ARCHIVE_BYTES, GAP, RANGE_BYTES = 256 << 20, 64 << 10, 8 << 20
# Record fields of the format, and the profile of a revisit by equal payload.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode("ascii")


def payload_digests(pages: DataFrame) -> DataFrame:
    """``pages`` plus ``payload_digest`` (bare upper-case base32 SHA-1) and ``payload_bytes``; a null payload is empty."""
    kept = pages.drop("payload_digest", "payload_bytes")
    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kept.schema]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            payloads = bytes_of(batch, "html")
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            columns["payload_digest"] = pa.array([base32(hashlib.sha1(p).digest()) for p in payloads], pa.string())
            columns["payload_bytes"] = pa.array([len(p) for p in payloads], pa.int64())
            yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    return kept.mapInArrow(work, ", ".join([*fields, "payload_digest string, payload_bytes long"]))


def with_record_types(pages: DataFrame, *, min_bytes: int = 0) -> DataFrame:
    """``payload_digests`` plus ``refers_to``: the page a revisit repeats, null for responses.

    Of equal payloads of at least ``min_bytes`` bytes the largest ``page_id`` is the response. Rows without an id are
    responses, and so is each row of a repeated id that is the largest. Only digests that occur again are joined.
    """
    digests = payload_digests(pages.select("page_id", "html"))
    large = digests.where((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
    again = large.groupBy("payload_digest").agg(F.max("page_id").alias("_target"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    again = broadcast_if_small(written(again.select("payload_digest", "_target"), "warc-repeated"), 100_000)
    joined = payload_digests(pages.drop("refers_to")).join(again, "payload_digest", "left")
    revisit = (F.col("page_id") < F.col("_target")) & (F.col("payload_bytes") >= min_bytes)
    return joined.withColumn("refers_to", F.when(revisit, F.col("_target"))).drop("_target")


def record(page_id: str, url: str, payload: bytes, digest: str, size: int, refers_to: str | None) -> bytes:
    """A response with its payload, or a revisit, whose block is empty and whose headers tell the full payload."""
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(size)),
    ]
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
        payload = b""
    head += [("Content-Type", "text/html"), ("Content-Length", str(len(payload)))]
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head)
    return VERSION + b"\r\n" + lines + b"\r\n" + payload + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.decode().split(": ", 1) if ": " in x.decode() else (x.decode().rstrip(":"), "") for x in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


INDEX = "archive string, offset long, length long, page_id {id}, url string, digest string"


def write_archives(pages: DataFrame, *, min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write a record per row of ``pages`` and return the index, a table of ``archive``, ``offset``, ``length`` (of the
    compressed record), ``page_id``, ``url`` and ``digest``. A null URL is written as an empty one."""
    folder = folder or shared_folder(pages.sparkSession, "warc")
    id_type = dict(pages.dtypes)["page_id"]
    rows = with_record_types(pages.select("page_id", "url", "html"), min_bytes=min_bytes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = pafs.FileSystem.from_uri(folder)
        out, name, offset = None, "", 0
        for batch in slices(batches, "html"):
            columns = [batch.column(c) for c in ("page_id", "url", "payload_digest", "payload_bytes", "refers_to")]
            index = []
            for payload, page, url, digest, size, target in zip(bytes_of(batch, "html"), *[c.to_pylist() for c in columns], strict=True):
                if out is None or offset >= ARCHIVE_BYTES:
                    if out is None:
                        fs.create_dir(at, recursive=True)
                    else:
                        out.close()
                    name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{at}/{name}", compression=None)
                text = None if target is None else str(target)
                data = _gzip(record("" if page is None else str(page), url or "", payload, digest, size, text))
                out.write(data)
                index.append((f"{folder.rstrip('/')}/{name}", offset, len(data)))
                offset += len(data)
            names, offsets, lengths = zip(*index, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), columns[0], columns[1], columns[2]],
                names=["archive", "offset", "length", "page_id", "url", "digest"],
            )
        if out is not None:
            out.close()

    return written(rows.mapInArrow(work, INDEX.format(id=id_type)), "warc-index")


def coalesced(ranges: list[tuple[int, int]], gap: int = GAP, most: int = RANGE_BYTES) -> Iterator[tuple[int, int, list[int]]]:
    """Sorted (offset, length) as reads (offset, length, places): ranges at most ``gap`` apart share a read of about
    ``most`` bytes at most."""
    begin = end = None
    own: list[int] = []
    for i, (offset, length) in enumerate(ranges):
        if own and (offset - end > gap or offset + length - begin > most):
            yield begin, end - begin, own
            own = []
        if not own:
            begin = end = offset
        end = max(end, offset + length)
        own.append(i)
    if own:
        yield begin, end - begin, own


RECORDS = "page_id {id}, url string, record_type string, payload_digest string, payload_bytes long, refers_to {id}, payload binary"


def read_records(index: DataFrame, selected: Column | None = None, *, verify: bool = True) -> DataFrame:
    """Records of the index rows that ``selected`` picks (all without it), read by coalesced byte ranges.

    ``payload`` is the stored block: empty for revisits, whose digest and length come from their headers. With
    ``verify`` a stored payload must have the digest of the index, else the read fails.
    """
    id_type = dict(index.dtypes)["page_id"]
    picked = index if selected is None else index.where(selected)
    # An archive is of bounded size; records of one archive are read in order by one task.
    ordered = picked.repartition("archive").sortWithinPartitions("archive", "offset")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, name = None, None
        for batch in batches:
            rows = batch.to_pylist()
            starts = [i for i in range(len(rows)) if i == 0 or rows[i]["archive"] != rows[i - 1]["archive"]]
            for a, b in zip(starts, [*starts[1:], len(rows)]):
                if rows[a]["archive"] != name:
                    if opened is not None:
                        opened.close()
                    name = rows[a]["archive"]
                    fs, at = pafs.FileSystem.from_uri(name)
                    opened = fs.open_input_file(at)
                for offset, length, places in coalesced([(r["offset"], r["length"]) for r in rows[a:b]]):
                    block, out = opened.read_at(length, offset), []
                    for r in (rows[a + p] for p in places):
                        fields, payload = parse(zlib.decompress(block[r["offset"] - offset : r["offset"] - offset + r["length"]], 31))
                        kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response" and verify and base32(hashlib.sha1(payload).digest()) != r["digest"]:
                            raise ValueError(f"digest of {r['page_id']} in {name} differs")
                        size = len(payload) if kind == "response" else int(fields["X-Payload-Length"])
                        target = fields.get("WARC-Refers-To", "").removeprefix("<urn:page:").removesuffix(">") or None
                        out.append((r["page_id"], r["url"], kind, digest, size, target, payload))
                    page, url, kind, digest, size, target, payload = map(list, zip(*out, strict=True))
                    id_arrow = batch.schema.field("page_id").type
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(page, id_arrow), pa.array(url, pa.string()), pa.array(kind), pa.array(digest), pa.array(size, pa.int64()),
                         pa.array(target, pa.string()).cast(id_arrow), pa.array(payload, pa.binary())],
                        names=["page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload"],
                    )
        if opened is not None:
            opened.close()

    return ordered.mapInArrow(work, RECORDS.format(id=id_type))


def round_trip(pages: DataFrame, *, min_bytes: int = 0) -> DataFrame:
    """Per page, from its record read back: bytes and digest of the payload, kind of record, and what it refers to."""
    read = read_records(write_archives(pages, min_bytes=min_bytes))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_BASE32 = "".join(
    f" || ('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + ((('0x' || hex[{5 * g + 1}:{5 * g + 5}])::bigint >> {s}) & 31)::int])" for g in range(8) for s in (15, 10, 5, 0)
)
SQL = f"""
with p as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as hex from pages),
d as (select page_id, payload_bytes, ''{_BASE32} as payload_digest from p),
t as (select *, max(page_id) over (partition by payload_digest) as target from d)
select page_id, payload_bytes, payload_digest, case when page_id < target then 'revisit' else 'response' end as record_type,
       case when page_id < target then target end as refers_to
from t
"""
