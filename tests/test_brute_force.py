"""Operators SQL cannot express, against plain sequential walks on small fixtures."""

import random
import re

from pyspark.sql import functions as F

from provatab.operators import compare, evidence, matching
from provatab.cluster import last_before, neighbours, ordinals, exact_quantile


def plain_values(text):
    taken = []
    for kind, pattern in evidence.VALUE_PATTERNS:
        for m in re.finditer(pattern, text, re.IGNORECASE):
            if not any(m.start() < e and m.end() > s for _, s, e, _ in taken):
                taken.append((kind, m.start(), m.end(), m.group(0)))
    return sorted((s, e, k) for k, s, e, _ in taken)


TEXTS = [
    "Receita de R$ 1.234,5 milhões no 2T26, margem de 12,5% e 300 unidades",
    "Cresceu -3,1% ▲ para US$ 5 bi em 2025; FY 26 traz 1.000 m² e 7 dias",
    "sem número algum", "v1.2.3-beta 4/5 10 20,5 e 100.000", "Água a 5 km, 12 anos; 3 milhão", "50%50 €7 £8,0 1234567",
]


def test_typed_values_match_a_plain_walk(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    got = {}
    for r in evidence.detect_values(df, "t").collect():
        got.setdefault(r.i, []).append((r.start, r.end, r.kind_hint))
    for i, t in enumerate(TEXTS):
        assert sorted(got.get(i, [])) == plain_values(t), t


def test_chunked_scans_match_plain_loops(spark):
    rng = random.Random(7)
    rows = [(k, i, rng.choice([None, i])) for k in "ab" for i in sorted(rng.sample(range(200), 60))]
    df = spark.createDataFrame(rows, "k string, o int, v int")
    seen = {(r.k, r.o): (r.last, r.rn, r.p and r.p.o, r.n and r.n.o) for r in neighbours(
        ordinals(last_before(df, ["k"], "o", {"last": F.col("v")}, chunk=16), ["k"], "o", chunk=16), ["k"], "o", ["o"], prev="p", next="n", chunk=16).collect()}
    for k in "ab":
        mine = [(o, val) for kk, o, val in rows if kk == k]
        last = None
        for n, (o, val) in enumerate(mine):
            before = mine[n - 1][0] if n else None
            after = mine[n + 1][0] if n + 1 < len(mine) else None
            assert seen[(k, o)] == (last, n + 1, before, after)
            last = val if val is not None else last


def test_exact_quantile(spark):
    values = [float(i % 37) for i in range(501)]
    df = spark.createDataFrame([("g", x) for x in values], "g string, v double")
    ordered, at = sorted(values), 0.95 * 500
    want = ordered[int(at)] + (ordered[int(at) + 1] - ordered[int(at)]) * (at - int(at))
    assert exact_quantile(df, ["g"], "v", 0.95, "q").first().q == want


def plain_candidates(texts, min_chars):
    usable = [(i, t) for i, t in enumerate(texts) if t and (len(t) >= min_chars or plain_values(t))]
    covered, seen, out = set(), set(), []
    for n, (i, t) in enumerate(usable):
        if i in covered or not plain_values(t):
            continue
        window = usable[max(0, n - 1) : n + 2]
        context = " ".join(x for _, x in window)
        if len(context) < min_chars or context in seen:
            continue
        seen.add(context)
        out.append((i, context))
        covered.update(j for j, x in window if plain_values(x))
    return out


def test_text_candidates_match_a_sequential_walk(spark):
    rng = random.Random(3)
    words = ["vendas de 5%", "sem valor nenhum aqui dito", "lucro R$ 7", "abc", "margem de 12,5% no período inteiro"]
    sections = {f"s{k}": [rng.choice(words) for _ in range(40)] for k in range(4)}
    rows = [("d", s, i, f"{s}-{i}", t) for s, texts in sections.items() for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "document_id string, section_id string, order_index int, block_id string, text string").withColumns(
        {"page_number": F.lit(1), "section_title": F.lit("Título"), "role_hint": F.lit("paragraph")}
    )
    got = {(r.section_id, r.block_id): r.context_text for r in evidence.text_candidates(df, evidence.CandidateConfig(max_per_section=1000), chunk=8).collect()}
    want = {(s, f"{s}-{i}"): c for s, texts in sections.items() for i, c in plain_candidates(texts, 40)}
    assert got == want


def test_literal_matches_agree_both_ways(spark):
    texts = spark.createDataFrame([(i, t.lower()) for i, t in enumerate(TEXTS)], "i int, text string")
    terms = spark.createDataFrame([("5",), ("mil",), ("unidades",), ("nada",), ("á",), ("tra",)], "term string")
    few = {tuple(r) for r in matching.literal_matches(texts, terms, ["i"]).collect()}
    many = {tuple(r) for r in matching.literal_matches(texts, terms, ["i"], few=0).collect()}
    want = {(i, t) for i, x in enumerate(TEXTS) for t in ("5", "mil", "unidades", "nada", "á", "tra") if t in x.lower()}
    assert few == many == want


def test_table_pairs_match_union_find(spark):
    rng = random.Random(11)
    old = {f"o{n:02d}": [f"r{rng.randrange(40)}" for _ in range(rng.randrange(1, 7))] for n in range(14)}
    new = {f"n{n:02d}": [f"r{rng.randrange(40)}" for _ in range(rng.randrange(1, 7))] for n in range(14)}
    new["n98"], old["o98"] = list(old["o00"]), list(old["o00"])
    parent = {**{("old", k): ("old", k) for k in old}, **{("new", k): ("new", k) for k in new}}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    left, free_new = [], sorted(new)
    pairs = set()
    for a in sorted(old):
        twin = next((b for b in free_new if new[b] == old[a]), None)
        if twin is None:
            left.append(a)
        else:
            free_new.remove(twin)
            pairs.add(frozenset({("old", a), ("new", twin)}))
    for a in left:
        for b in free_new:
            x, y = set(old[a]), set(new[b])
            if len(x & y) * 2 >= min(len(x), len(y)) and x & y:
                parent[find(("old", a))] = find(("new", b))
    groups = {}
    for node in [("old", a) for a in left] + [("new", b) for b in free_new]:
        groups.setdefault(find(node), set()).add(node)
    want = {frozenset(g) for g in groups.values()} | pairs

    def frames(tables):
        t = spark.createDataFrame([("d", k, "t", ["h"]) for k in tables], "document_id string, table_id string, title string, header array<string>")
        r = spark.createDataFrame([("d", k, i, [x]) for k, v in tables.items() for i, x in enumerate(v)], "document_id string, table_id string, row_index int, cells array<string>")
        return t, r

    (ot, orr), (nt, nr) = frames(old), frames(new)
    got = {}
    for r in compare.pair_tables(ot, nt, orr, nr).collect():
        got.setdefault(r.group, set()).add((r.side, r.table_id))
    assert {frozenset(g) for g in got.values()} == want
