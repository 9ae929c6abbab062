"""Chains of references: long ones, forks, cycles and dangling ends, against a plain walk."""

import random

from pyspark.sql import functions as F

from provatab.cluster import follow_pointers
from provatab.operators import evidence, resolve


def test_pointers_against_a_walk(spark):
    rng = random.Random(5)
    rows = []
    for d in range(6):
        n = 120
        for i in range(n):
            to = rng.choice([None, i - 1 if i else None, rng.randrange(n), n + 5])
            rows.append((f"d{d}", i, to, f"v{i}" if rng.random() < 0.1 else None))
    rows += [("long", i, i - 1, None) for i in range(1, 3000)] + [("long", 0, None, "end")]
    rows += [("cycle", i, (i + 1) % 7, None) for i in range(7)] + [("cycle", 9, 3, None)]
    at = {(d, i): (to, v) for d, i, to, v in rows}

    def walk(d, i):
        seen = set()
        while (d, i) in at and i not in seen:
            seen.add(i)
            to, v = at[d, i]
            if v is not None:
                return v
            i = to
        return None

    got = follow_pointers(spark.createDataFrame(rows, "d string, i int, to int, v string"), ["d"], "i", "to", "v").collect()
    assert {(r.d, r.i): r.v for r in got} == {(d, i): walk(d, i) for d, i, _, _ in rows}


def test_derived_fields_follow_earlier_mappings(spark):
    rows = [("a", 1, "x", "valor_fixo", "1", None), ("a", 2, "y", "campo_derivado", None, "x"), ("a", 3, "z", "campo_derivado", None, "y")]
    rows += [("a", 4, "late", "campo_derivado", None, "w"), ("a", 5, "w", "valor_fixo", "2", None), ("a", 6, "none", "campo_derivado", None, "nowhere"), ("a", 7, "self", "campo_derivado", None, "self")]
    schema = "document_id string, ord int, mapping_path string, tipo_origem string, valor_fixo string, campo_origem string"
    mappings = spark.createDataFrame(rows, schema).withColumns({"arquivo_origem": F.lit(None).cast("string"), "obrigatorio": F.lit(True)})
    got = resolve.derived_fields(mappings, resolve.fixed_values(mappings)).collect()
    assert {r.mapping_path: r.valor_resolvido for r in got} == {"y": "1", "z": "1", "late": None, "none": None, "self": None}


def test_blocks_find_sections_through_their_ancestors(spark):
    sections = spark.createDataFrame([("a", "s1", 0, "#s", ["#c"]), ("a", "s2", 1, None, [])], "document_id string, section_id string, order_index int, self_ref string, child_refs array<string>")
    blocks = [("a", "b0", 0, "#0", "#s", None), ("a", "c", 1, "#c", None, None)]
    blocks += [("a", f"b{i}", i + 2, f"#{i}", f"#{i - 1}", None) for i in range(1, 400)]
    blocks += [("a", "own", 500, "#own", None, "s2"), ("a", "under", 501, "#u", "#own", None), ("a", "x", 502, "#x", "#y", None), ("a", "y", 503, "#y", "#x", None), ("a", "lost", 504, None, "#gone", "s2")]
    df = spark.createDataFrame(blocks, "document_id string, block_id string, order_index int, self_ref string, parent_ref string, section_id string")
    got = {r.block_id: r.case_section_id for r in evidence.resolve_block_sections(df, sections).collect()}
    assert all(got[f"b{i}"] == "s1" for i in range(400))
    assert {k: got[k] for k in ("c", "own", "under", "x", "y", "lost")} == {"c": "s1", "own": "s2", "under": "s2", "x": None, "y": None, "lost": "s2"}


def test_nested_walks_have_no_depth_limit(spark):
    from provatab.operators.contract import contract_nodes
    from provatab.operators.selection import walk_json

    deep = 34
    payload = '{"k": [' * deep + "1" + "]}" * deep
    rows = walk_json(spark.createDataFrame([("a", payload), ("b", "7"), ("c", None)], "id string, j string"), "j").collect()
    assert sorted(len(r.path) for r in rows) == sorted(len("$" + ".k[0]" * n) for n in range(deep)) and {r.id for r in rows} == {"a"}
    contract = '{"schema_saida": ' + '{"k": ' * deep + '"string"' + "}" * deep + "}"
    nodes = contract_nodes(spark.createDataFrame([("d", "v1", contract)], "domain string, version string, contract string")).collect()
    assert sorted(r.path.count(".") for r in nodes) == list(range(deep))
