import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest

from provatab.llm import periodic


def plain_runs(w):
    codes = {}
    w = np.array([codes.setdefault(x, len(codes)) for x in w], np.int32)
    found = {}
    for q in range(1, len(w) // 4 + 1):
        breaks = np.concatenate([[-1], np.flatnonzero(w[:-q] != w[q:]), [len(w) - q]])
        for k in np.flatnonzero(np.diff(breaks) - 1 + q >= max(6, 4 * q)).tolist():
            found.setdefault((int(breaks[k]) + 1, int(breaks[k + 1]) + q), q)
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def random_texts(seed, count):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(count):
        w = rng.integers(0, rng.integers(1, 6), rng.integers(0, 60))
        for _ in range(rng.integers(0, 3)):
            unit = rng.integers(0, 4, rng.integers(1, 9))
            unit = np.tile(unit, rng.integers(1, 8))[: rng.integers(1, 60)]
            w = np.concatenate([w, unit, rng.integers(0, 4, rng.integers(0, 5))])
        out.append(w.astype(np.int64))
    return out


@pytest.mark.parametrize("places", [1 << 20, 40])
def test_runs_against_brute_force(monkeypatch, places):
    """Also with few candidates at once, where places of known runs are left out."""
    monkeypatch.setattr(periodic, "PLACES", places)
    texts = random_texts(places, 400) + [np.zeros(n, np.int64) for n in (0, 1, 5, 6, 7, 500)] + [np.tile(np.arange(2), 300)]
    assert periodic.all_runs(texts) == [plain_runs(t.tolist()) for t in texts]


def test_extensions_against_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(6):
        words = np.concatenate([rng.integers(0, 3, 40), np.tile(rng.integers(0, 3, 4), 12), rng.integers(0, 2, 30)])
        symbols = np.concatenate([[100], words, [101], words[::-1], [102]])
        levels = periodic.recompressed(symbols, symbols >= 100)
        assert len(levels[-1].symbols) == 5
        back = [level.mirrored() for level in levels]
        i, j = (x.ravel() for x in np.meshgrid(np.arange(len(symbols)), np.arange(len(symbols))))
        i, j = i[i != j], j[i != j]
        for views, seen in ((levels, symbols), (back, symbols[::-1])):
            wanted = []
            for a, b in zip(i.tolist(), j.tolist()):
                k = 0
                while max(a, b) + k < len(seen) and seen[a + k] == seen[b + k]:
                    k += 1
                wanted.append(k)
            assert periodic.extensions(views, i, j).tolist() == wanted


def test_grammar_is_small():
    words = np.tile(np.arange(7), 3000)
    symbols = np.concatenate([[1 << 30], words, [(1 << 30) + 1]])
    levels = periodic.recompressed(symbols, symbols >= 1 << 30)
    assert sum(len(np.unique(level.symbols)) for level in levels) < 200


def test_awkward_rows(spark, awkward, empty):
    long_run = "a b c " * 4000
    more = spark.createDataFrame([(i, t) for i, t in enumerate(["x x x x x x", "x x x x x", long_run, "p q p q p q p q p r r r r r r r", long_run + "d"])], "doc_id long, text string")
    docs = awkward.unionByName(more, allowMissingColumns=True)
    got = sorted(map(tuple, periodic.run_digests(docs).collect()), key=repr)
    assert got == sorted((plain_row(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()), key=repr)
    assert periodic.run_digests(empty).collect() == []
    rows = {r["doc_id"]: r for r in periodic.run_rows(more).collect()}
    assert rows[3]["text"] == "p q r" and [tuple(x) for x in rows[3]["runs"]] == [(0, 9, 2), (9, 7, 1)]


def test_table_against_brute_force(spark, documents):
    docs = documents.where("length(text) < 3000")
    got = sorted(map(tuple, periodic.run_digests(docs).collect()))
    assert got == sorted(plain_row(r["doc_id"], r["text"]) for r in docs.collect())
    assert any(r[1] for r in got)
