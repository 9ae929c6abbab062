"""Scalar rules on published vectors, plus round-trip properties."""

import uuid
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from provatab.functions import numbers, paths, periods, text

NUMBERS = [
    ("1.234", "unidades", 1234.0),
    ("R$ 1,5 mi", None, 1500000.0),
    ("(50,4)", None, -50.4),
    ("(794.123)", None, -794123.0),
    ("(3,1%)", None, -3.1),
    ("(1.234)", "unidades", -1234.0),
    ("-50,4", None, -50.4),
    ("3,49x", None, 3.49),
    ("1.5X", None, 1.5),
    ("(1,2x)", None, -1.2),
    ("2T 2026", None, None),
    ("(vazio)", None, None),
    ("n.a", None, None),
    ("3,49 vezes", None, None),
    ("8.001", None, 8001.0),
    ("2.646,8", None, 2646.8),
    ("330,8", None, 330.8),
    ("1T26", None, None),
    ("1,5", "total", 15.0),
    ("1,234,567.89", None, 1234567.89),
    ("1.234.567", None, 1234567.0),
    ("12,345", None, 12345.0),
    ("12,345", "pct", 12.345),
    ("1.234,5%", None, 1234.5),
    ("1,234.5%", None, 1234.5),
    ("2 bi", None, 2e9),
    ("7 mil", "unidades", 7.0),
    ("-", None, None),
    ("", None, None),
    (None, None, None),
    ("1-2", None, None),
    ("US$ 5", None, None),
]


def test_published_numbers(spark):
    df = spark.createDataFrame([(i, t, c or "") for i, (t, c, _) in enumerate(NUMBERS)], "i int, t string, c string")
    out = df.withColumn("v", numbers.number_of(F.col("t"), column=F.col("c")))
    got = {r.i: r.v for r in out.collect()}
    for i, (t, c, want) in enumerate(NUMBERS):
        assert got[i] == (pytest.approx(want) if want is not None else None), (t, c)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_extraction_side_numbers_ignore_accounting_marks(spark):
    df = spark.createDataFrame([("(50,4)",), ("3,49x",), ("50,4",)], "t string")
    got = [r.v for r in df.withColumn("v", numbers.number_of(F.col("t"), published=False)).collect()]
    assert got == [50.4, None, 50.4]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-(10**11), 10**11), min_size=1, max_size=200))
def test_render_then_parse_is_identity(spark, cents):
    df = spark.createDataFrame([(c, Decimal(c) / 100) for c in cents], "c bigint, d decimal(18,2)")
    shown = F.translate(F.format_number("d", 2), ",.", ".,")
    out = df.withColumn("v", numbers.number_of(shown))
    assert out.where(F.round(F.col("v") * 100) != F.col("c")).count() == 0


PERIODS = [
    *[(t, ("trimestre", 2026, 1)) for t in ("1T26", "1T2026", "2026-Q1", "Q1 2026", "1º T26", "1º tri/2026", "T1 26")],
    ("4T25*", ("trimestre", 2025, 4)),
    ("2T26 (a)", ("trimestre", 2026, 2)),
    ("2T26¹", ("trimestre", 2026, 2)),
    ("1S26", ("semestre", 2026, 1)),
    ("H1 2026", ("semestre", 2026, 1)),
    ("mar/26", ("mes", 2026, 3)),
    ("03/2026", ("mes", 2026, 3)),
    ("dez-25", ("mes", 2025, 12)),
    ("2025", ("ano", 2025, 1)),
    *[(t, None) for t in ("1T26 UDM*", "%T/T", "Consolidado 2T26", "Total", "5T26", "13/2026", "T", "", None)],
]


def test_period_labels(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(PERIODS)], "i int, t string")
    got = {r.i: r.period and tuple(r.period) for r in df.withColumn("period", periods.period_of(F.col("t"))).collect()}
    assert got == {i: want for i, (_, want) in enumerate(PERIODS)}


def test_period_arithmetic(spark):
    df = spark.createDataFrame([("1T26",), ("01/2026",)], "t string").withColumn("period", periods.period_of(F.col("t")))
    p = F.col("period")
    rows = df.select(
        periods.period_label(periods.step_back(p, 1)).alias("a"),
        periods.period_label(periods.step_back(p, 5)).alias("b"),
        periods.period_label(periods.same_period_last_year(p)).alias("c"),
        periods.period_label(periods.step_back(periods.step_back(p, 3), -3)).alias("d"),
        periods.period_label(periods.step_back(p, 2)).alias("e"),
    ).collect()
    assert tuple(rows[0]) == ("4T25", "4T24", "1T25", "1T26", "3T25")
    assert tuple(rows[1]) == ("12/2025", "08/2025", "01/2025", "01/2026", "11/2025")


def test_stable_id_is_uuid5(spark):
    parts = [("doc", "section", 3, "lançamentos"), ("x", None, 0, "")]
    df = spark.createDataFrame(parts, "a string, b string, c int, d string")
    got = [r.i for r in df.select(text.stable_id(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("i")).collect()]
    want = [str(uuid.uuid5(uuid.NAMESPACE_URL, "||".join(str(p) for p in row if p is not None))) for row in parts]
    assert got == want


def test_text_keys(spark):
    df = spark.createDataFrame([("  Lançamentos  1º  TRI½ ﬁm ",), ("R$ / Água-Viva __ ",), ("%%%",)], "t string")
    rows = df.select(
        text.normalize_text(F.col("t")).alias("a"), text.normalize_term(F.col("t")).alias("b"), text.slugify(F.col("t")).alias("c")
    ).collect()
    assert rows[0].a == "lancamentos 1o tri12 fim"
    assert rows[0].b == "lancamentos1otri12fim"
    assert rows[1].c == "r_agua_viva"
    assert rows[2].c == "untitled"


def test_titles_and_roles(spark):
    cases = [
        ("RESUMO 2T26", "text", "title"),
        ("Vendas Brutas", "text", "title"),
        ("Vendas brutas", "text", "paragraph"),
        ("vendas", "section_header", "title"),
        ("Nota explicativa do período", "text", "note"),
        ("Endereço da sede:", "text", "field_label"),
        ("Cidade da obra: São Paulo", "text", "field"),
        ("um item", "list_item", "list_item"),
        ("x" * 201, "text", "narrative"),
        ("123 456", "text", "paragraph"),
    ]
    df = spark.createDataFrame([(i, t, b) for i, (t, b, _) in enumerate(cases)], "i int, t string, b string")
    got = {r.i: r.r for r in df.select("i", text.block_role(F.col("t"), F.col("b")).alias("r")).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(cases)}


def test_unique_names(spark):
    df = spark.createDataFrame([(["Total", "total", "", "Total "],)], "n array<string>")
    assert df.select(text.unique_names(F.col("n")).alias("u")).first().u == ["total", "total_2", "column_3", "total_3"]


def test_paths(spark):
    df = spark.createDataFrame([("itens[periodo.rotulo=Jan].valor",), ("a.b.c",), ("a..b",), ("a[x].b",)], "p string")
    rows = df.select(
        paths.path_segments(F.col("p")).alias("s"), paths.plain_path(F.col("p")).alias("n"), paths.path_selectors(F.col("p")).alias("k")
    ).collect()
    assert [tuple(x) for x in rows[0].s] == [("itens", "periodo.rotulo", "Jan"), ("valor", None, None)]
    assert rows[0].n == "itens.valor" and rows[0].k == ["periodo.rotulo=Jan"]
    assert [x.field for x in rows[1].s] == ["a", "b", "c"]
    assert rows[2].s is None and rows[3].s is None
