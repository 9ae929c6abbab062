"""WARC round trip, nearest neighbours by recall, the pipeline, and queries with SQL."""

import base64
import gzip
import hashlib
import pathlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from provatab.llm import neighbours, queries, warc
from provatab.llm.common import shared_folder

SF = "/root/testdata/sf0.001"


def test_round_trip(spark):
    rows = [
        (1, "http://a/", "same"), (2, "http://b/\r\nX: y", "same"), (3, None, "same"), (4, "u", ""), (5, "u", None), (6, "ü", "é" * 9), (7, "u", "x\r\n\r\ny"),
        (None, "n", "same"), (8, "long", "z" * 3_000_000), (9, "u", "twice"), (9, "u", "twice"), (10, "u", "twice"),
    ]
    pages = spark.createDataFrame([(*r, "e") for r in rows], "page_id long, url string, html string, digest string")
    for least in (0, 5):
        got = sorted(map(tuple, warc.round_trip(pages, min_bytes=least).collect()), key=repr)
        want = []
        for i, _, html in rows:
            data = (html or "").encode()
            top = max((j for j, _, h in rows if j is not None and (h or "") == (html or "")), default=None)
            again = i is not None and len(data) >= least and i < top
            want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", top if again else None))
        assert got == sorted(want, key=repr)
    assert warc.round_trip(pages.where(F.lit(False))).count() == 0


def test_archives_are_gzip_members_and_selected_reads_give_texts(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    folder = shared_folder(spark, "warc-test")
    index = warc.write_archives(pages, folder=folder)
    assert sum(r.n for r in index.groupBy("archive").agg(F.count(F.lit(1)).alias("n")).collect()) == pages.count()
    archive = index.select("archive").first()[0]
    whole = gzip.decompress(pathlib.Path(archive.removeprefix("file://")).read_bytes())
    assert whole.startswith(b"WARC/1.1\r\n")
    some = warc.read_records(index, F.col("page_id") % 3 == 0).join(pages, "page_id").collect()
    assert len(some) == pages.where("page_id % 3 = 0").count()
    assert all(bytes(r.payload).decode() == r.html for r in some if r.record_type == "response")


def test_ranges_are_coalesced():
    ranges = [(0, 10), (10, 5), (40, 5), (1000, 7), (1007, 100)]
    assert list(warc.coalesced(ranges, gap=30, most=100)) == [(0, 45, [0, 1, 2]), (1000, 7, [3]), (1007, 100, [4])]


def exact(ids, x, q, k):
    s = (x * x[q]).sum(axis=1)
    s[q] = -np.inf
    order = np.lexsort((ids, -s))[: min(k, len(ids) - 1)]
    return [int(ids[i]) for i in order], [float(s[i]) for i in order]


def test_recall_and_scores(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = sorted((r.vec_id, r.embedding) for r in table.collect())
    ids, x = np.array([i for i, _ in rows]), np.array([e for _, e in rows], float)
    got = {}
    for r in neighbours.nearest(table, every=20, k=20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score, r["rank"]))
    assert set(got) == {int(i) for i in ids if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        want, scores = exact(ids, x, list(ids).index(q), 20)
        hits += len(set(want) & {v for v, *_ in found})
        assert [r for *_, r in found] == list(range(1, 21)) and all(s == (x[list(ids).index(v)] * x[list(ids).index(q)]).sum() for v, s, _ in found)
    assert hits / (20 * len(got)) >= 0.9


def test_vectors_that_take_no_part_and_ties(spark, monkeypatch):
    rng = np.random.default_rng(2)
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    hot = rng.standard_normal(6)
    vectors = [(i, [float(v) for v in (hot if i % 3 == 0 else rng.standard_normal(6) * 3)]) for i in range(600)]
    nan, inf = float("nan"), float("inf")
    odd = [(601, None), (602, [0.0] * 6), (603, [1.0, None] * 3), (604, [nan] * 6), (605, [inf] + [0.0] * 5), (606, []), (607, [1.0, 2.0]), (None, [1.0] * 6), (20, vectors[20][1])]
    df = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>")
    ids, x = np.arange(600), np.array([v for _, v in vectors])
    got = {}
    for r in neighbours.nearest(df, every=20, k=7, confidence=0.999999).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == {q: list(zip(*exact(ids, x, q, 7))) for q in range(0, 600, 20)}
    few = spark.createDataFrame([(0, [1.0, 0.0]), (20, [1.0, 1.0]), (21, [0.5, 0.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r["rank"], r.vec_id) for r in neighbours.nearest(few).orderBy("query_id", "rank").collect()] == [(0, 1, 20), (0, 2, 21), (20, 1, 0), (20, 2, 21)]
    assert neighbours.nearest(few.limit(1)).count() == 0 and neighbours.nearest(few.where(F.lit(False))).count() == 0


def test_chi_square():
    assert abs(neighbours.chi_square(15.507, 8) - 0.95) < 1e-4 and abs(neighbours.chi_square_quantile(0.9, 8) - 13.3616) < 1e-3


def test_pipeline_stages(spark, awkward, empty):
    docs, seen = awkward.withColumn("n_chars", F.length("text").cast("long")), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and out.schema == docs.schema or [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        seen.append(out.count())
    assert seen[0] > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_pipeline_runs_over_documents(spark):
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0 < len(rows) < 200
    assert len({r.doc_id for r in rows}) == len(rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_with_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    cursor = duck.execute(queries.ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*columns).collect()))) == sorted(map(repr, cursor.fetchall()))
