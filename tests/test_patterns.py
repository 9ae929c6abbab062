"""A bad pattern in one mapping leaves that mapping unresolved and all others alone."""

from pyspark.sql import functions as F

from provatab.operators import resolve


def test_unsound_patterns_are_null(spark):
    rows = [("(", 1), ("a(b)c", 1), ("a(b)c", 2), (r"\(x\)", 1), (r"[(](y)", 1), (r"[(]y", 1), ("(?:z)", 1), ("(?<n>z)", 1), ("*", 0), ("ok", 0), (None, 0)]
    got = spark.createDataFrame(rows, "p string, g int").select(resolve.sound_pattern(F.col("p"), F.col("g")).alias("s"), resolve.sound_pattern(F.col("p")).alias("t")).collect()
    assert [r.s for r in got] == [None, "a(b)c", None, None, r"[(](y)", None, None, "(?<n>z)", None, "ok", None]
    assert [r.t for r in got] == [None if p in ("(", "*") else p for p, _ in rows]


def test_one_bad_pattern_does_not_stop_the_others(spark):
    fields = spark.createDataFrame(
        [("d", 1, 1, "a", None, "b1", "(", 1, "texto"), ("d", 1, 1, "b", None, "b1", "n (\\d+)", 1, "texto"), ("d", 1, 1, "c", None, "b1", "n \\d+", 3, "texto")],
        "document_id string, ord int, record int, path string, fixed string, block_id string, padrao string, grupo int, tipo string",
    )
    blocks = spark.createDataFrame([("d", "b1", "n 42")], "document_id string, block_id string, text string")
    got = {r.path: r.value for r in resolve.block_records(fields, blocks).collect()}
    assert got == {"a": None, "b": "42", "c": None}


def test_an_ambiguous_version_is_a_problem_of_its_own_identity(spark):
    from provatab.operators import selection

    rows = [("a", "c/v1.2.0/x.json"), ("a", "c/v1.10.0/x.json"), ("b", "c/v2.0.0/x.json"), ("b", "c/v2.0.0/y.json")]
    found = selection.highest_version(spark.createDataFrame(rows, "domain string, object_key string"), ["domain"], "object_key")
    assert {r.domain: (r.object_key, r.problem) for r in found.collect()} == {"a": ("c/v1.10.0/x.json", None), "b": (None, "ambiguous_version")}
