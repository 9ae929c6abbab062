"""Token ids as flat binary files with 64-bit document offsets (operator 10).

A part is three files: ``.ids`` (flat little-endian unsigned integers, 16 bits wide if every id fits, else 32),
``.offsets`` (n + 1 unsigned 64-bit counts of ids before each document of the part) and ``.docs`` (the document ids,
an Arrow stream). The manifest has a row per part, in ascending order of the documents; a part's base, the number of
ids in the parts before it, is a prefix sum over the manifest. Parts are memory-mapped where the folder is mounted.

A task writes its part under a new name and the manifest, a Parquet table, names what successful tasks wrote, so a
lost executor leaves at most a file that nothing names.
"""

from __future__ import annotations

import functools
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provatab.cluster import running_totals
from provatab.llm import tokenizer_files as files
from provatab.llm.common import Kept, shared_folder, slices, texts_of, written

# Encodings a worker keeps, of words and of what stands between spaces, twice each; bytes read at once.
KEPT, READ_BYTES = 250_000, 4 << 20
PARTS = "part int, path string, width int, n_docs long, n_tokens long"


class Encoder:
    """Ids by the tokenizers library, as packed integers. White space ends a word, so the library sees each word once."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = files.load(path).special
        self.cutter = files.special_cutter(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.letters = files.byte_letters()
        self.parts, self.words = Kept(KEPT, self.part), Kept(KEPT, self.word)

    def packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.width == 2 else 'I'}", *ids)

    def word(self, word: str) -> bytes:
        """A single word goes to the library's merge model: it is normalised and split already."""
        plain = word.isascii() and word.isprintable()
        spelled = word if plain else "".join([self.letters[b] for b in word.encode()])
        return self.packed([t.id for t in self.tokenizer.model.tokenize(spelled)])

    def part(self, part: str) -> bytes:
        return b"".join([self.words[w] for w in files.part_words(part)])

    def plain(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, text.replace("\n", " ").split(" ")))

    def encode(self, text: str) -> bytes:
        """Packed ids of a text."""
        if self.cutter is None or "<" not in text or not self.cutter.search(text):
            return self.plain(text)
        coded, at = [], 0
        for m in self.cutter.finditer(text):
            coded += [self.plain(text[at : m.start()]), self.packed([self.special[m.group()]])]
            at = m.end()
        return b"".join([*coded, self.plain(text[at:])])


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def write_token_files(docs: DataFrame, path: str, *, end_id: int = 1, folder: str | None = None) -> DataFrame:
    """Encode every whole text, append ``end_id``, write the parts, and return the manifest with bases.

    Documents are ordered by ``doc_id`` (null first), then by text, so repeated ids have a defined order. A null or
    empty text is its end id alone. An empty table has no parts.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "token-files")
    ordered = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, stem = encoder(path), f"{uuid.uuid4().hex}"
        end, counts, ids, out = e.packed([end_id]), [], [], None
        fs, at = pafs.FileSystem.from_uri(folder)
        for batch in slices(batches, "text"):
            if out is None:
                fs.create_dir(at, recursive=True)
                out = fs.open_output_stream(f"{at}/{stem}.ids")
            coded = [e.encode(t) for t in texts_of(batch)]
            out.write(b"".join([x + end for x in coded]))
            counts.append(np.array([len(x) // e.width + 1 for x in coded], np.uint64))
            ids.append(pa.RecordBatch.from_arrays([batch.column(0)], names=["doc_id"]))
        if out is None:
            return
        out.close()
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype("<u8")
        with fs.open_output_stream(f"{at}/{stem}.offsets") as f:
            f.write(offsets.tobytes())
        with fs.open_output_stream(f"{at}/{stem}.docs") as f, pa.ipc.new_stream(f, ids[0].schema) as stream:
            for x in ids:
                stream.write_batch(x)
        row = [TaskContext.get().partitionId(), f"{folder.rstrip('/')}/{stem}", e.width, len(offsets) - 1, int(offsets[-1])]
        yield pa.RecordBatch.from_pylist([dict(zip(("part", "path", "width", "n_docs", "n_tokens"), row, strict=True))], MANIFEST)

    manifest = written(ordered.mapInArrow(work, PARTS), "token-manifest")
    totals = running_totals(manifest.withColumn("_to", F.col("n_tokens")), [], "part", {"_to": F.col("n_tokens")})
    return totals.select("part", "path", "width", "n_docs", "n_tokens", (F.col("_to") - F.col("n_tokens")).alias("base"))


MANIFEST = pa.schema([("part", pa.int32()), ("path", pa.string()), ("width", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])


def _flat(uri: str, kind: str) -> np.ndarray:
    """A flat file as an array: memory-mapped where the folder is mounted, else read."""
    if urlparse(uri).scheme in ("", "file"):
        return np.memmap(urlparse(uri).path, kind, "r")
    fs, at = pafs.FileSystem.from_uri(uri)
    with fs.open_input_file(at) as f:
        return np.frombuffer(f.read_buffer(), kind)


def read_token_files(manifest: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Documents of the parts: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids`` (binary,
    little-endian unsigned 32-bit integers)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                ids, offsets = _flat(part["path"] + ".ids", f"<u{part['width']}"), _flat(part["path"] + ".offsets", "<u8")
                fs, at = pafs.FileSystem.from_uri(part["path"] + ".docs")
                with fs.open_input_stream(at) as f:
                    docs = pa.ipc.open_stream(f).read_all().column("doc_id").combine_chunks()
                start = 0
                while start < len(docs):  # documents of about READ_BYTES at once
                    stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + READ_BYTES // 4, "right")) - 1)
                    to = offsets[start : stop + 1].astype(np.int64)
                    flat = np.asarray(ids[to[0] : to[-1]]).astype("<u4").tobytes()
                    cut = ((to - to[0]) * 4).tolist()
                    yield pa.RecordBatch.from_arrays(
                        [docs.slice(start, stop - start), pa.array(to[:-1] + part["base"]), pa.array(np.diff(to)),
                         pa.array([flat[a:b] for a, b in zip(cut, cut[1:])], pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )
                    start = stop

    parts = manifest.repartition("part")
    return parts.mapInArrow(work, f"doc_id {id_type}, start long, n_tokens long, ids binary")


def token_file_digests(docs: DataFrame, path: str) -> DataFrame:
    """Write the files, read them back, and give each document's place, length and checksum."""
    manifest = write_token_files(docs, path)
    read = read_token_files(manifest, dict(docs.dtypes)["doc_id"])
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
