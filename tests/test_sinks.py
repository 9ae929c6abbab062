"""Promotion, upserts and incremental ingest on small folders."""

import json

import pytest
from pyspark.sql import functions as F

from provatab.sources import readers, writers
from provatab.streaming import ingest


def test_promotion_counts_and_refuses_overwrite(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"x": 1}, {"x": 2}]))
    target = str(tmp_path / "out")
    assert writers.promote_to_parquet(spark, str(tmp_path / "a.json"), target, schema="x int") == 2
    with pytest.raises(Exception):
        writers.promote_to_parquet(spark, str(tmp_path / "a.json"), target, schema="x int")


def test_upsert_is_idempotent(spark):
    base = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, o int")
    batch = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "k int, v string, o int")
    once = writers.upsert(base, batch, ["k"], F.col("o"))
    twice = writers.upsert(once, batch, ["k"], F.col("o"))
    want = [(1, "a"), (2, "d"), (3, "e")]
    assert sorted((r.k, r.v) for r in once.collect()) == want == sorted((r.k, r.v) for r in twice.collect())


def test_new_manifests_are_handed_over_once(spark, tmp_path):
    source, state = tmp_path / "in", str(tmp_path / "state")
    source.mkdir()
    (source / "a.json").write_text(json.dumps({"document_id": "d1"}))
    seen = []

    def keep(batch, _):
        seen.extend(r.document_id for r in batch.select("document_id").collect())

    ingest.ingest_new(ingest.new_manifests(spark, str(source)), state, keep)
    (source / "b.json").write_text(json.dumps({"document_id": "d2"}))
    ingest.ingest_new(ingest.new_manifests(spark, str(source)), state, keep)
    assert seen == ["d1", "d2"]


def test_one_whole_value_per_file(spark, tmp_path):
    cases = {
        '{"k":1}': (1, None), ' {"k":2}\n': (2, None), '{"k":1}\n{"k":2}': (None, "not_json"), '{"k":3} junk }': (None, "not_json"), '[{"k":1}]': (None, "not_object"),
        '{"k":4}] [7': (None, "not_json"), '{"k":5}, 0': (None, "not_json"), " ": (None, "not_json"), "7": (None, "not_object"), '{"k":"x"}': (None, None),
    }
    for n, text in enumerate(cases):
        (tmp_path / f"{n}.json").write_text(text)
    rows = readers.read_artifacts(spark, str(tmp_path), "k int").collect()
    got = {int(r.source_key.rsplit("/", 1)[1].split(".")[0]): (r.k, r.problem) for r in rows}
    assert [got[n] for n in range(len(cases))] == list(cases.values())


def test_one_whole_list_per_file(spark, tmp_path):
    for n, text in enumerate(['[{"k":1}, 7, {"k":2}]', '[{"k":1}] tail ]', "[]", '{"k":1}', "[{]"]):
        (tmp_path / f"{n}.json").write_text(text)
    rows = readers.read_artifacts(spark, str(tmp_path), "k int", shape="list").collect()
    got = sorted((r.source_key[-6], r.k or 0, r.problem or "") for r in rows)
    assert got == [("0", 0, "not_object"), ("0", 1, ""), ("0", 2, ""), ("1", 0, "not_json"), ("3", 0, "not_list"), ("4", 0, "not_json")]


def test_one_whole_object_per_line(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k":1}\n\n \t\n{"k":2}{"k":3}\n{"k":4} x }\n[1]\n {"k":"5"} \n{"k":6')
    rows = readers.read_jsonl(spark, str(tmp_path), "k int", problems=True).collect()
    assert sorted((r.k or 0, r.problem or "") for r in rows) == [(0, "not_json"), (0, "not_json"), (0, "not_json"), (0, "not_object"), (1, ""), (5, "")]
    assert sorted(r.k for r in readers.read_jsonl(spark, str(tmp_path), "k int").collect()) == [1, 5]
    assert readers.read_jsonl(spark, str(tmp_path / "none"), "k int", problems=True).columns == ["k", "source_key", "problem"]


def test_published_again(spark, tmp_path):
    path, schema = str(tmp_path / "out"), "entity string, document_id string, execution_id string, x int"

    def rows(*of):
        return spark.createDataFrame([("e", d, "r", x) for d, x in of], schema)

    writers.publish_run(rows(("a", 1), ("b", 1)), rows(("a", 2)), rows(("a", 3), ("b", 3)), path)
    writers.publish_run(rows(("a", 4)), rows(), rows(), path)
    writers.publish_run(rows(), rows(), rows(), path, runs=rows(("c", 0)))

    def read(name):
        return sorted((r.document_id, r.x) for r in writers.published(spark, path, name).collect())

    assert read("validation") == [("a", 4), ("b", 1)]
    assert read("resolved") == [] and read("audit") == [("b", 3)]
    writers.publish_run(rows(), rows(), rows(), path, runs=rows(("b", 0)))
    assert read("validation") == [("a", 4)] and read("audit") == []
