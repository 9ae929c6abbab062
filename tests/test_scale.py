"""Work is dealt out by the rows it makes, and large groups meet no single task or array."""

import re

from pyspark.sql import functions as F

from provatab import cluster
from provatab.functions import text
from provatab.operators import columns
from provatab.operators import compare as cp
from provatab.operators import contract as ct
from provatab.operators import evidence as ev
from provatab.operators import publish as pb
from provatab.operators import series as sr
from provatab.operators import tables as tb
from provatab.plans import q_compare, q_contract, q_evidence, q_repair, q_resolve, q_sources, views
from provatab.plans.all_queries import QUERIES

SF = "/root/testdata/sf0.01"


def largest_partition(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_rows_made_of_few_keys_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(cluster, "MADE_ROWS", 1000)
    made = q_resolve.supplier_mappings(spark, SF).select("document_id", "ord", "mapping_path")
    assert made.count() == 168 * q_resolve.suppliers(spark, SF).count()
    assert largest_partition(made) <= 4 * 1000
    headers = views.period_headers(spark, SF)
    assert headers.count() == 29 * views.period_tables(spark, SF).count()
    assert largest_partition(headers) <= 4 * 1000


def rows(df):
    return sorted(map(str, df.collect()))


def test_crowded_pages_give_the_sections_of_others(spark, monkeypatch):
    items = views.items(spark, "/root/testdata/sf0.001")
    items = items.withColumn("page_number", F.when(F.col("page_number") % 5 != 0, F.col("page_number")))
    sections = ev.build_sections(items)
    for kwargs in ({}, {"by_order": False}, {"closest_above": True}):
        got = []
        for most in (64, 1, 0):
            monkeypatch.setattr(ev, "PAGE_SECTIONS", most)
            got.append(rows(ev.nearest_section(items, sections, **kwargs).select("document_id", "order_index", "section_id")))
        assert got[0] == got[1] == got[2]


def test_repeated_metrics_keep_their_first_row(spark):
    none = F.lit(None)
    items = spark.createDataFrame([("d", 0, "VENDAS", 1), ("d", 1, "Vendas 7", 1), ("d", 1, "Vendas 7", 1), ("e", 3, "Vendas 8", 1)], "document_id string, order_index int, text string, level int")
    items = items.select(
        "*", F.lit("text").alias("label"), F.lit(1).alias("page_number"), none.cast("struct<page_number:int,left:double,top:double,right:double,bottom:double,coord_origin:string>").alias("bbox"),
        none.cast("string").alias("self_ref"), none.cast("string").alias("parent_ref"), F.expr("cast(array() as array<string>)").alias("child_refs"),
    )
    found = ev.extract_metrics(items, ev.build_sections(items))
    assert rows(found.select("document_id", "order_index", "label_raw", "value_numeric", "section_title")) == rows(
        spark.createDataFrame([("d", 1, "Vendas", 7.0, "Vendas 7"), ("e", 3, "Vendas", 8.0, "Vendas 8")], "document_id string, order_index int, label_raw string, value_numeric double, section_title string")
    )


def test_report_items_number_the_lines_of_orders_once(spark):
    """Metrics read items that are made once; before, the orders were numbered again for titles, values and sections."""
    plan = QUERIES["d11_metrics"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    assert "l_orderkey" not in plan and "lineitem" not in plan


def test_names_in_rows_are_numbered_as_in_arrays(spark):
    names = ["Total", "", "total", None, "Ano 1", "TOTAL", "ano_1", "column_2"] * 5
    listed = spark.createDataFrame([("k", names), ("l", names[3:])], "k string, names array<string>")
    want = listed.select("k", F.posexplode(text.unique_names(F.col("names"))).alias("column_index", "name"))
    placed = listed.select("k", F.posexplode("names").alias("at", "n")).withColumn("at", F.col("at") * 70_000)
    assert rows(columns.unique_name_rows(placed, ["k"], "at", "n")) == rows(want)


def test_no_name_meets_an_array_of_all_names(spark):
    plan = QUERIES["n10_unique_names"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan


def test_scans_are_the_same_in_one_chunk_and_in_many(spark):
    df = spark.range(60).select((F.col("id") % 4).alias("k"), F.col("id").alias("at"), F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"))
    for current in (False, True):
        got = [rows(cluster.last_before(df, ["k"], "at", {"v": F.col("v")}, include_current=current, chunk=c)) for c in (1000, 5)]
        assert got[0] == got[1]
    got = [rows(cluster.neighbours(df, ["k"], "at", ["at", "v"], prev="p", next="n", chunk=c)) for c in (1000, 5)]
    assert got[0] == got[1]


def test_proposed_keys_are_dealt_out_and_paths_parsed_once(spark, monkeypatch):
    monkeypatch.setattr(cluster, "MADE_ROWS", 1000)
    made = q_contract.proposed(spark, SF)
    assert made.count() > 4000 and largest_partition(made) <= 1000
    plan = ct.key_filters(made).select("key_filters")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_bar_charts_are_not_held_against_the_rule_for_series(spark):
    """Nor are their cells sent out whole to the few bytes of the charts."""
    cells = spark.range(100).selectExpr("string(id % 9) as document_id", "'t' as table_id", "int(id) as row_index", "1 as column_index", "'5' as value_raw")
    charts = cells.select("document_id", "table_id").distinct().withColumns({"chart_type": F.lit("bar_chart"), "chart_title": F.lit("c")})
    headers = charts.select("document_id", "table_id", F.lit(1).alias("column_index"), F.lit("h").alias("header"))
    out = sr.chart_points(cells, headers, charts)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == 100 and "to_json" not in plan and "strategy=merge" in plan


def test_pages_are_written_by_all_cores(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(q_sources, "_shared_folder", lambda spark: str(tmp_path))
    assert QUERIES["s1_json_artifacts"](spark, SF).count() == spark.read.parquet(f"{SF}/pages.parquet").count()
    assert len({f.name.split("-")[1] for f in (tmp_path / "pages").glob("part-*")}) > 2


def test_lists_of_bulletins_are_shuffled_once_by_rows(spark, monkeypatch):
    monkeypatch.setattr(cluster, "KEYED_ROWS", 1000)
    df = QUERIES["x1_bulletin_tables"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ENSURE_REQUIREMENTS" not in plan and "REPARTITION_BY_NUM" in plan
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey")
    assert largest_partition(cluster.clustered(lines, "l_orderkey")) <= 2 * 1000


def test_values_and_evidence_meet_in_one_group(spark):
    """Nor does any group of the query shuffle narrow rows again; a value with a null in its key is never proven."""
    plan = QUERIES["x4_export_preflight"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "ENSURE_REQUIREMENTS" not in plan
    listed = [("d", "F", "1T24", 1.0), ("d", "F", "1T24", 1.0), ("d", None, "1T24", 2.0), ("d", "F", None, 3.0), ("d", "F", "2T24", 4.0), ("d", "F", "3T24", 5.0)]
    values = spark.createDataFrame(listed, "document_id string, operation string, periodo string, valor double")
    page = F.when(F.col("valor") != 4, 1)
    audit = values.select("*", page.alias("page_number"), F.when(F.col("valor") != 5, True).alias("has_bbox"))
    runs = spark.createDataFrame([("d", "compativel", 0, "s3")], "document_id string, status string, failed int, source_uri string")
    got = sorted((r.problem, r.detail) for r in pb.export_preflight(values, audit, runs).collect())
    without = [("value_without_evidence", x) for x in ("1T24/2.0", "F/2T24/4.0", "F/3.0", "F/3T24/5.0")]
    assert got == [("evidence_without_place", "F/2T24/4.0"), *without]


def test_other_plain_headers_are_cut_at_once(spark, monkeypatch):
    """A run of tables with a header each takes one round; a data header between two equal ones still joins them."""
    written = []
    monkeypatch.setattr(tb, "checkpointed", lambda df: written.append(1) or cluster.checkpointed(df))
    names = [["Item", f"Ano {i // 2}", "Valor"] for i in range(12)]
    names[5] = ["VGV", "123456", "77777"]
    names[4] = names[6] = names[3]
    none = F.lit(None)
    tables = spark.createDataFrame([("d", i, i, n, 0 if i == 4 else 2) for i, n in enumerate(names)], "document_id string, order_index int, page_number int, header array<string>, row_count int").select(
        "*", none.cast("array<string>").alias("first_row"), none.cast("string").alias("section_id"), none.cast("string").alias("section_slug"),
        none.cast("struct<page_number:int,left:double,top:double,right:double,bottom:double,coord_origin:string>").alias("bbox"),
    )
    heads = spark.createDataFrame([], "document_id string, order_index int, page_number int")
    got = {r.order_index: r.merged_order for r in tb.merge_plan(tables, heads).collect()}
    rounds = len(written)
    monkeypatch.setattr(tb, "_cut_early", lambda here, before: F.lit(False))
    assert got == {r.order_index: r.merged_order for r in tb.merge_plan(tables, heads).collect()}
    # Two writes, and two more for each round: the data header takes two rounds, and the others none.
    assert rounds <= 6 < len(written) - rounds


def test_rounds_of_candidates_carry_no_texts(spark, monkeypatch):
    written = []
    monkeypatch.setattr(ev, "checkpointed", lambda df: written.append(df.columns) or cluster.checkpointed(df))
    texts = ["Vendas de 12 mil unidades no trimestre que passou agora"] * 6 + ["Texto sem valor algum que passa de quarenta letras aqui"] * 3
    blocks = spark.createDataFrame([("d", f"b{i}", i, 1, "s", "t", x, "paragraph") for i, x in enumerate(texts * 2)], "document_id string, block_id string, order_index int, page_number int, section_id string, section_title string, text string, role_hint string")
    assert ev.text_candidates(blocks).count() > 0
    assert sum("context_text" in columns for columns in written) == 1 < len(written)


def plans_kept(monkeypatch):
    """Optimized plans of what ``evidence`` keeps as tables, as text."""
    kept, keep = [], ev.checkpointed

    def noted(df):
        kept.append(df._jdf.queryExecution().optimizedPlan().toString())
        return keep(df)

    monkeypatch.setattr(ev, "checkpointed", noted)
    return kept


def test_titles_and_roles_are_worked_out_once(spark, monkeypatch):
    items = views.items(spark, "/root/testdata/sf0.001")
    kept = plans_kept(monkeypatch)
    ev.build_blocks(items, ev.build_sections(items))
    sections, blocks = kept[:2]
    assert sections.count("translate(") == 1
    assert blocks.count("regexp_replace(coalesce(") + blocks.count("regexp_replace(text") == 1


def test_fast_patterns_give_the_plain_rules(spark):
    texts = ["", " ", "  ", " a", "a  b", "a\tb", "a \t b ", " é x", "x  y", "é ü  ö", "A - B/C", "--a!!_b__", "!", "a ! b", "«Ação» (1,5%)", "日本 語", "_", "a\nb\r\nc", "~ ! ~"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.normalize_space(F.col("t")), text.slugify(F.col("t"))).collect()

    def slug(t):
        folded = t.strip(" ").lower().translate(str.maketrans(text.SLUG_FROM, text.SLUG_TO))
        return re.sub("_+", "_", re.sub("[^a-z0-9_]+", "", folded)).strip("_") or "untitled"

    assert [tuple(r) for r in got] == [(t, re.sub(text.SPACE + "+", " ", t).strip(" "), slug(t)) for t in texts]


def test_titles_do_not_travel_where_only_ids_are_asked(spark):
    items = views.items(spark, "/root/testdata/sf0.001")
    sections = ev.build_sections(items)
    for place in (ev.attach_section, ev.nearest_section):
        slim = place(items, sections, titles=False)
        assert rows(slim) == rows(place(items, sections).select(*slim.columns))
    for name in ("d3_nearest_section", "d3_closest_above", "d4_attached_section"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "struct(id" in plan and "title, title_raw" not in plan


def test_rows_of_tables_are_hashed_ahead_of_joins(spark, monkeypatch):
    """No cells are shuffled to the tables that are still free, and every row set is made once."""
    old, new, old_rows, new_rows = q_compare.extractions(spark, "/root/testdata/sf0.001")
    kept, keep = [], cp.checkpointed

    def noted(df):
        kept.append((df.columns, df._jdf.queryExecution().optimizedPlan().toString()))
        return keep(df)

    monkeypatch.setattr(cp, "checkpointed", noted)
    cp.pair_tables(old, new, old_rows, new_rows)
    sets = [plan for columns, plan in kept if columns == ["document_id", "table_id", "row_hash"]]
    assert len(sets) == 2
    assert all(plan.index("LeftSemi") < plan.index("sha2(") for plan in sets)


def test_trailing_sum_reads_only_the_cells_it_adds_up(spark, monkeypatch):
    """Columns of the sum are picked ahead, so that no other cells are read as numbers or meet their labels."""
    kept, keep = [], sr.checkpointed

    def noted(df):
        kept.append(keep(df))
        return kept[-1]

    monkeypatch.setattr(sr, "checkpointed", noted)
    out = QUERIES["d21_trailing_sum"](spark, SF)
    assert out.count() > 0
    (used,) = kept
    assert used.groupBy("document_id", "table_id", "section_id").count().agg(F.max("count")).first()[0] <= 4


def unsized_joins(df):
    """Joins of the optimized plan that Spark may turn into a broadcast by its own estimate."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.splitlines() if re.search(r"\bJoin [A-Z]", line) and "strategy=" not in line]


def test_cells_and_headers_are_not_sent_out_by_estimate(spark):
    """Mappings and headers are exploded from a few keys, so Spark took them for small tables."""
    for name in ("f8_resolved_cells", "f8p_projected_cells"):
        assert unsized_joins(QUERIES[name](spark, SF)) == []
    # Runs meet their counts, which Spark sizes after the shuffle.
    assert len(unsized_joins(QUERIES["f16_run_summary"](spark, SF))) == 1


def test_series_do_not_send_out_tables_by_estimate(spark):
    assert unsized_joins(QUERIES["d19_total_over_time"](spark, SF)) == []
    # Only documents with native points, read as they are, may be sent out.
    assert all("LeftAnti" in join for join in unsized_joins(QUERIES["d23_native_first"](spark, SF)))


def test_parts_are_not_sent_out_to_the_lines(spark, monkeypatch):
    """Of the parts mostly the keys are used, a small share of the file by Spark's estimate but a row for each part."""
    kept, keep = [], cluster.checkpointed

    def noted(df):
        kept.append(df._jdf.queryExecution().optimizedPlan().toString())
        return keep(df)

    monkeypatch.setattr(q_repair, "checkpointed", noted, raising=False)
    plan = QUERIES["g6_selection_checks"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert len(kept) == 1 and kept[0].count("strategy=merge") == 1
    assert "p_partkey" not in plan


def test_blocks_of_cases_are_made_once(spark, monkeypatch):
    """With one role a text; what stands below the cases is a table of blocks, and positions are read from it ahead."""
    kept, keep = [], cluster.checkpointed

    def noted(df):
        kept.append((df.columns, df._jdf.queryExecution().optimizedPlan().toString()))
        return keep(df)

    monkeypatch.setattr(q_evidence, "checkpointed", noted)
    df = QUERIES["d12_cases"](spark, "/root/testdata/sf0.001")
    (plan,) = [plan for columns, plan in kept if "role_hint" in columns]
    assert plan.count("field_label") == 1
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # Sections meet blocks and cases; a text is cleaned once for its key and value.
    assert plan.count("Join ") == 2 and plan.count("regexp_replace(coalesce(text") == 1


def test_positions_read_ahead_give_the_same_scans(spark):
    df = spark.range(60).select((F.col("id") % 4).alias("k"), F.col("id").alias("at"), F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"))
    few, many = df.where("at < 40"), df.unionByName(df.where("at = 59").withColumn("at", F.lit(900).cast("long")))
    for chunk in (1000, 50, 5):
        for ahead in (df, many):
            got = cluster.neighbours(few, ["k"], "at", ["v"], prev="p", next="n", chunk=chunk, positions=ahead)
            assert rows(got) == rows(cluster.neighbours(few, ["k"], "at", ["v"], prev="p", next="n", chunk=1000))
            got = cluster.last_before(few, ["k"], "at", {"v": F.col("v")}, chunk=chunk, positions=ahead)
            assert rows(got) == rows(cluster.last_before(few, ["k"], "at", {"v": F.col("v")}, chunk=1000))
