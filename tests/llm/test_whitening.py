import math

import numpy as np
import pytest

from provatab.llm import whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, n string, component string, _v string, size string"


def plain(vectors, components=8):
    """Rows by exact sums and a library eigensolver: id -> (n, deviation, {component: |whitened|}, explained)."""
    xs = [(i, [math.floor(1024 * c) + 100_000 for c in v]) for i, v in vectors]
    n = len(xs)
    sums = [sum(col) for col in zip(*(x for _, x in xs))]
    y = np.array([[a - s / n for a, s in zip(x, sums)] for _, x in xs])
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > values[0] * 1e-12).sum()))
    w = y @ axes[:, :k] / np.sqrt(values[:k])
    return [
        (i, c + 1, n, sum((n * a - s) ** 2 for a, s in zip(x, sums)), w[r, c], values[c] / values.sum())
        for r, (i, x) in enumerate(xs)
        for c in range(k)
    ]


def test_factor_and_rotations():
    rng = np.random.default_rng(3)
    for size, rank in ((1, 1), (5, 5), (8, 3), (33, 33)):
        half = rng.normal(size=(size, rank)) * np.logspace(0, 5, rank)
        scatter = half @ half.T
        factor, order = whitening.pivoted_cholesky(scatter)
        assert factor.shape[1] == rank
        assert np.allclose(factor @ factor.T, scatter[np.ix_(order, order)], rtol=1e-10, atol=1e-12 * scatter.max())
        assert np.allclose(factor[:rank], np.tril(factor[:rank]))
        values, axes = whitening.principal_axes(scatter)
        assert np.allclose(values, np.linalg.eigvalsh(scatter)[::-1][:rank], rtol=1e-9, atol=1e-14 * values[0])
        assert np.allclose(axes.T @ axes, np.eye(rank), atol=1e-9)


def same(rows, wanted):
    rows = sorted(rows, key=lambda r: (r["vec_id"], r["component"], r["deviation"]))
    wanted = sorted(wanted, key=lambda r: (r[0], r[1], r[3]))
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"]) for r in rows] == [w[:4] for w in wanted]
    signs = {}
    for r, w in zip(rows, wanted):
        if abs(w[4]) > 1e-3:
            sign = signs.setdefault(r["component"], np.sign(r["whitened"] * w[4]))
            assert r["whitened"] == pytest.approx(sign * w[4], rel=1e-8, abs=1e-9)
        assert r["explained"] == pytest.approx(w[5], rel=1e-9)
        assert r["identity_error"] < 1e-6


def test_against_library(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, (rng.normal(size=12) * np.linspace(1, 3, 12)).tolist()) for i in range(300)]
    vectors += vectors[:5]  # repeated rows
    bad = [(900, None), (901, []), (902, [1.0, None] * 6), (903, [float("nan")] * 12), (904, [float("-inf")] + [0.0] * 11)]
    rows = [(i, v, "x", None, "y", "z") for i, v in vectors + bad]
    same(whitening.component_rows(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect(), plain(vectors))


def test_lengths_ranks_and_long_numbers(spark):
    flat = [(i, [float(i), 2.0 * i]) for i in range(4)]  # rank one
    equal = [(10 + i, [1.0, 2.0, 3.0]) for i in range(3)]  # rank nought: no component
    huge = [(20, [1e300]), (21, [-1e300]), (22, [0.5])]
    far = [(30 + i, [1e7 * i, 1.0, 1.0, 1.0]) for i in range(3)]
    rows = spark.createDataFrame([(i, v, *[None] * 4) for i, v in flat + equal + huge + far], SCHEMA)
    got = whitening.component_rows(rows).collect()
    same([r for r in got if r["vec_id"] < 10], plain(flat))
    assert not [r for r in got if 10 <= r["vec_id"] < 20]
    assert {r["vec_id"]: r["deviation"] for r in got if 20 <= r["vec_id"] < 30} == {20: None, 21: None, 22: 101_025**2}
    assert {r["vec_id"]: r["deviation"] for r in got if r["vec_id"] >= 30} == {x[0]: d if d < 2**63 else None for x, d in zip(far, (r[3] for r in plain(far)))}
    assert whitening.component_rows(rows.limit(0)).collect() == []
    single = whitening.component_rows(rows.where("vec_id = 1")).collect()
    assert single == []


def test_whole_table(spark):
    from provatab.llm.queries import QUERIES

    got = QUERIES["op11_whitened_embeddings"](spark, SF)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    table = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    same(got.collect(), plain([(r[0], r[1]) for r in table]))
