"""Extraction against extraction, and extraction against the page text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provatab.cluster import checkpointed

SIDES = ("old", "new")
# Number shape, how many pages back a table may start, page flag thresholds.
NUMBER = "(?<![\\d.,])(?:\\d{1,3}(?:\\.\\d{3})+(?:,\\d+)?|\\d+,\\d+)(?![\\d]|[.,]\\d)"
PAGES_BACK, MIN_NUMBERS, MIN_OUTSIDE = 3, 15, 10


def table_prints(rows: DataFrame) -> DataFrame:
    """One row per table: its rows in order and as a set, as hashes of bounded size.

    ``rows`` has ``document_id, table_id, row_index, cells``. A row is hashed alone; the ordered
    print is a sum over (position, row) hashes, so a long table is never collected.
    """
    row = F.sha2(F.to_json("cells"), 256)
    hashed = rows.select("document_id", "table_id", "row_index", row.alias("row_hash"))
    return hashed.groupBy("document_id", "table_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.xxhash64("row_index", "row_hash").cast("decimal(38,0)")).alias("_p1"),
        F.sum(F.xxhash64(F.reverse("row_hash"), F.col("row_index") + 1).cast("decimal(38,0)")).alias("_p2"),
    ).select("document_id", "table_id", "n_rows", F.concat_ws(":", F.col("n_rows").cast("string"), F.col("_p1").cast("string"), F.col("_p2").cast("string")).alias("print"))


def _with_print(tables: DataFrame, rows: DataFrame) -> DataFrame:
    return tables.join(table_prints(rows), ["document_id", "table_id"], "left").select(
        "document_id", "table_id", "title", F.to_json("header").alias("header"),
        F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows"), F.coalesce("print", F.lit("0")).alias("print"),
    )


def _row_sets(rows: DataFrame, free: DataFrame) -> DataFrame:
    # Hashed ahead of the join, so that no cells are shuffled, and kept: every step of the search reads the hashes.
    hashed = rows.select("document_id", "table_id", F.unhex(F.sha2(F.to_json("cells"), 256)).alias("row_hash"))
    return checkpointed(hashed.join(free.select("document_id", "table_id"), ["document_id", "table_id"], "left_semi").distinct())


def _edges(old_rows: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Pairs of a document's tables that share half of the rows of the smaller one.

    A pair that shares half of the smaller set meets in one of the rarest rows of that set (half
    of it, and one more), so only those are joined with all rows of the other side. Rows many
    tables repeat are the common ones and drop out, without losing a pair.
    """
    doc = ["document_id"]
    sizes = [r.groupBy(*doc, "table_id").agg(F.count(F.lit(1)).alias("size")) for r in (old_rows, new_rows)]
    often = old_rows.unionByName(new_rows).groupBy(*doc, "row_hash").agg(F.count(F.lit(1)).alias("_df"))

    def prefix(rows: DataFrame, size: DataFrame) -> DataFrame:
        # Position by rarity through counts per (table, rarity), then a rank inside equal rarity.
        placed = rows.join(often, [*doc, "row_hash"]).join(size, [*doc, "table_id"])
        w = Window.partitionBy(*doc, "table_id").orderBy("_df", "row_hash")
        keep = F.col("size") - F.ceil(F.col("size") / 2) + 1
        return placed.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= keep).select(*doc, "table_id", "row_hash", "size")

    (old_size, new_size) = sizes
    old_all, new_all = old_rows.join(old_size, [*doc, "table_id"]), new_rows.join(new_size, [*doc, "table_id"])

    def meet(left: DataFrame, right: DataFrame) -> DataFrame:
        a = left.select(*doc, "row_hash", F.col("table_id").alias("old_id"), F.col("size").alias("_a"))
        b = right.select(*doc, "row_hash", F.col("table_id").alias("new_id"), F.col("size").alias("_b"))
        return a.join(b, [*doc, "row_hash"])

    small_old = meet(prefix(old_rows, old_size), new_all).where("_a <= _b")
    small_new = meet(old_all, prefix(new_rows, new_size)).where("_b <= _a")
    pairs = small_old.unionByName(small_new).select(*doc, "old_id", "new_id", F.least("_a", "_b").alias("_least")).distinct()
    shared = (
        pairs.join(old_rows.withColumnRenamed("table_id", "old_id"), [*doc, "old_id"])
        .join(new_rows.withColumnRenamed("table_id", "new_id"), [*doc, "new_id", "row_hash"])
        .groupBy(*doc, "old_id", "new_id", "_least")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return shared.where(F.col("_n") * 2 >= F.col("_least")).select(*doc, "old_id", "new_id")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Smallest node id of the connected component of each node, inside a document.

    Labels move to the smallest neighbour and then jump to the label of their label, so long
    chains need logarithmic rounds. Each round is written out; it ends when nothing changed.
    """
    doc = ["document_id"]
    both = edges.select(*doc, F.col("a").alias("node"), F.col("b").alias("_to")).unionByName(edges.select(*doc, F.col("b").alias("node"), F.col("a").alias("_to"))).distinct()
    both = checkpointed(both)
    labels = checkpointed(nodes.select(*doc, "node", F.col("node").alias("label")))
    while True:
        near = both.join(labels.select(*doc, F.col("node").alias("_to"), F.col("label").alias("_l")), [*doc, "_to"]).groupBy(*doc, "node").agg(F.min("_l").alias("_near"))
        lower = labels.join(near, [*doc, "node"], "left").select(*doc, "node", "label", F.least("label", "_near").alias("_new"))
        # A node's old label learns the smallest label seen by any node that carries it.
        hooks = lower.groupBy(*doc, F.col("label").alias("_root")).agg(F.min("_new").alias("_hook"))
        hooked = lower.join(hooks.withColumnRenamed("_root", "label"), [*doc, "label"]).select(
            *doc, "node", "label", F.least("_new", "_hook").alias("_new")
        )
        jump = hooked.select(*doc, F.col("node").alias("_new"), F.col("_new").alias("_far"))
        moved = checkpointed(hooked.join(jump, [*doc, "_new"], "left").select(*doc, "node", "label", F.least("_new", F.coalesce("_far", "_new")).alias("_new")))
        if moved.where("_new <> label").isEmpty():
            return moved.select(*doc, "node", "label")
        labels = moved.select(*doc, "node", F.col("_new").alias("label"))


def pair_tables(old: DataFrame, new: DataFrame, old_rows: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Group every table of both extractions: ``(document_id, side, table_id, group)``.

    Equal tables (rows in order, and header) pair one to one in table order; the rest forms
    components of tables that share half of the rows of the smaller one.
    """
    doc = ["document_id"]
    # One row per table, read by every step below.
    a, b = checkpointed(_with_print(old, old_rows)), checkpointed(_with_print(new, new_rows))
    twin = Window.partitionBy(*doc, "print", "header").orderBy("table_id")
    a, b = a.withColumn("_k", F.row_number().over(twin)), b.withColumn("_k", F.row_number().over(twin))
    exact = a.select(*doc, "print", "header", "_k", F.col("table_id").alias("old_id")).join(
        b.select(*doc, "print", "header", "_k", F.col("table_id").alias("new_id")), [*doc, "print", "header", "_k"]
    )
    free_a = a.join(exact.select(*doc, F.col("old_id").alias("table_id")), [*doc, "table_id"], "left_anti")
    free_b = b.join(exact.select(*doc, F.col("new_id").alias("table_id")), [*doc, "table_id"], "left_anti")
    free_a, free_b = checkpointed(free_a), checkpointed(free_b)
    edges = _edges(_row_sets(old_rows, free_a), _row_sets(new_rows, free_b)).select(
        *doc, F.concat(F.lit("a:"), "old_id").alias("a"), F.concat(F.lit("b:"), "new_id").alias("b")
    )
    nodes = free_a.select(*doc, F.concat(F.lit("a:"), "table_id").alias("node")).unionByName(free_b.select(*doc, F.concat(F.lit("b:"), "table_id").alias("node")))
    grouped = components(nodes, edges).select(
        *doc, F.when(F.col("node").startswith("a:"), "old").otherwise("new").alias("side"), F.expr("substring(node, 3)").alias("table_id"), F.col("label").alias("group")
    )
    pairs = exact.select(*doc, F.concat(F.lit("="), "old_id").alias("group"), F.explode(F.array(F.struct(F.lit("old").alias("side"), F.col("old_id").alias("table_id")), F.struct(F.lit("new").alias("side"), F.col("new_id").alias("table_id")))).alias("_s"))
    return grouped.unionByName(pairs.select(*doc, "_s.side", "_s.table_id", "group"))


def classify_pairs(groups: DataFrame, old: DataFrame, new: DataFrame, old_rows: DataFrame, new_rows: DataFrame) -> DataFrame:
    """What happened to each group of tables."""
    prints = _with_print(old, old_rows).withColumn("side", F.lit("old")).unionByName(_with_print(new, new_rows).withColumn("side", F.lit("new")))
    joined = groups.join(prints, ["document_id", "side", "table_id"])

    def one(side: str, col: str):
        return F.max(F.when(F.col("side") == side, F.coalesce(col, F.lit(""))))

    n = joined.groupBy("document_id", "group").agg(
        F.count_if(F.col("side") == "old").alias("n_old"), F.count_if(F.col("side") == "new").alias("n_new"),
        *[one(s, c).alias(f"_{s}_{c}") for s in SIDES for c in ("title", "header", "print")],
    )

    def same(c: str):
        return F.col(f"_old_{c}") == F.col(f"_new_{c}")

    old_n, new_n = F.col("n_old"), F.col("n_new")
    kind = (
        F.when(new_n == 0, "sumiu")
        .when(old_n == 0, "nova")
        .when((old_n == 1) & (new_n == 1) & same("print") & same("header") & same("title"), "idêntica")
        .when((old_n == 1) & (new_n == 1) & same("print") & same("header"), "só título")
        .when((old_n == 1) & (new_n == 1) & same("print"), "cabeçalho mudou")
        .when((old_n == 1) & (new_n == 1), "conteúdo mudou")
        .when(old_n == 1, F.concat(F.lit("separada em "), new_n.cast("string")))
        .when(new_n == 1, F.concat(F.lit("fundida de "), old_n.cast("string")))
        .otherwise(F.concat(F.lit("reorganizada ("), old_n.cast("string"), F.lit(" → "), new_n.cast("string"), F.lit(")")))
    )
    return n.select("document_id", "group", "n_old", "n_new", kind.alias("kind"))


def partition_proof(groups: DataFrame, old: DataFrame, new: DataFrame, old_rows: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Rows lost and invented per group, not counting rows that became headers or came from
    them, and headers gained and dropped. Multisets are signed counts per row."""
    def lines(rows: DataFrame, side: str, what: str, body: str) -> DataFrame:
        return rows.select("document_id", F.lit(side).alias("side"), "table_id", F.lit(what).alias("what"), F.sha2(F.to_json(body), 256).alias("line"))

    all_ = (
        lines(old_rows, "old", "d", "cells").unionByName(lines(new_rows, "new", "d", "cells"))
        .unionByName(lines(old, "old", "h", "header")).unionByName(lines(new, "new", "h", "header"))
    )

    def count(side: str, what: str):
        return F.count_if((F.col("side") == side) & (F.col("what") == what))

    n = groups.join(all_, ["document_id", "side", "table_id"]).groupBy("document_id", "group", "line").agg(
        count("old", "d").alias("da"), count("new", "d").alias("dn"), count("old", "h").alias("ha"), count("new", "h").alias("hn")
    )

    def over(left: str, right: str, less: str):
        # Counter difference keeps positives at each step.
        first = F.greatest(F.col(left) - F.col(right), F.lit(0))
        return F.sum(F.greatest(first - F.col(less), F.lit(0)))

    return n.groupBy("document_id", "group").agg(
        over("da", "dn", "hn").alias("lost"), over("dn", "da", "ha").alias("invented"),
        over("hn", "ha", "da").alias("headers_gained"), over("ha", "hn", "dn").alias("headers_dropped"),
    )


def change_summary(classes: DataFrame, other_counts: DataFrame | None = None) -> DataFrame:
    """Changed groups per document and kind, and other artefacts whose number changed."""
    label = F.regexp_replace("kind", " \\(?\\d.*$", "")
    changed = classes.where("kind <> 'idêntica'").groupBy("document_id", label.alias("what")).agg(F.count(F.lit(1)).alias("n"))
    if other_counts is None:
        return changed
    moved = other_counts.where("not (old_n <=> new_n)").select(
        "document_id", F.col("artifact").alias("what"), (F.coalesce("new_n", F.lit(0)) - F.coalesce("old_n", F.lit(0))).alias("n")
    )
    return changed.unionByName(moved)


# --- numeric coverage -------------------------------------------------------------------------


def number_tokens(texts: DataFrame, keys: list[str], col: str = "text") -> DataFrame:
    """Distinct numbers a text prints."""
    found = F.regexp_extract_all(F.col(col), F.lit(f"({NUMBER})"), F.lit(1))
    return texts.select(*keys, F.explode(F.array_distinct(found)).alias("token")).distinct()


def _digits(text: str):
    return F.regexp_replace(F.regexp_replace(F.trim(text), "\\.0$", ""), "\\D", "")


def numeric_coverage(pages: DataFrame, tables: DataFrame, texts: DataFrame, charts: DataFrame) -> DataFrame:
    """Where the extraction holds each number of a page.

    ``pages``, ``tables`` and ``texts`` have ``document_id, page, text``; a table counts for its
    first page and the three after. ``charts`` has ``document_id, page, value``. The best place
    wins: table, text, chart, another page, absent. All joins are on document, page and token.
    """
    ids = ["document_id", "page", "token"]
    shown = number_tokens(pages, ["document_id", "page"])
    in_table = number_tokens(tables, ["document_id", "page"])
    reach = in_table.select("document_id", "token", F.explode(F.sequence(F.col("page"), F.col("page") + PAGES_BACK)).alias("page")).select(*ids).distinct()
    in_text = number_tokens(texts, ["document_id", "page"])
    drawn = charts.select("document_id", "page", _digits("value").alias("_d")).distinct()
    anywhere = in_table.unionByName(in_text).select("document_id", "token").distinct()
    drawn_anywhere = drawn.select("document_id", "_d").distinct()
    yes = F.lit(True)
    joined = (
        shown.withColumn("_d", _digits("token"))
        .join(reach.withColumn("_t", yes), ids, "left")
        .join(in_text.select(*ids).withColumn("_x", yes), ids, "left")
        .join(drawn.withColumn("_c", yes), ["document_id", "page", "_d"], "left")
        .join(anywhere.withColumn("_a", yes), ["document_id", "token"], "left")
        .join(drawn_anywhere.withColumn("_e", yes), ["document_id", "_d"], "left")
    )
    place = F.when(F.col("_t"), "tabela").when(F.col("_x"), "texto").when(F.col("_c"), "grafico").when(F.col("_a") | F.col("_e"), "outra pagina").otherwise("ausente")
    return joined.select(*ids, place.alias("place"))


def flag_pages(coverage: DataFrame) -> DataFrame:
    """Numbers per place and page; flagged when many and mostly outside tables."""
    n = coverage.groupBy("document_id", "page").agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("place") == p).alias(p.replace(" ", "_")) for p in ("tabela", "texto", "grafico", "outra pagina", "ausente")],
    )
    return n.withColumn("flagged", (F.col("total") >= MIN_NUMBERS) & (F.col("total") - F.col("tabela") >= MIN_OUTSIDE))


def coverage_totals(pages: DataFrame) -> DataFrame:
    """Flagged pages and the numbers on them, per document."""
    places = ("tabela", "texto", "grafico", "outra_pagina", "ausente")
    return pages.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("n_pages"), F.count_if("flagged").alias("n_flagged"),
        *[F.sum(F.when(F.col("flagged"), F.col(p)).otherwise(0)).alias(p) for p in places],
    )
