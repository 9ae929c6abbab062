"""Tables as cells: grids, typed rows, header repair, fragment merging, structure, inventory
(D5-D10, D18, D24-D28, G7).

A table is ``(document_id, table_id)`` with a header array; its cells are rows
``(document_id, table_id, row_index, column_index, value_raw)``. Work on single columns or rows
of a table groups by (table, column) or (table, row), never by document.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provatab.cluster import CHUNK, checkpointed, last_before, neighbours, ordinals, running_totals, shuffled
from provatab.functions import numbers, periods
from provatab.functions import text as tx
from provatab.operators.columns import typed_cells
from provatab.operators.matching import literal_matches

TABLE = ["document_id", "table_id"]
TOTAL_LABELS = ("total", "total geral", "geral")


# --- grids and cells --------------------------------------------------------------------------


def explode_cells(tables: DataFrame, rows: str = "rows") -> DataFrame:
    """Cells of grids, white space collapsed."""
    lines = tables.select(*TABLE, F.posexplode(rows).alias("row_index", "_line"))
    return lines.select(*TABLE, "row_index", F.posexplode("_line").alias("column_index", "_v")).select(
        *TABLE, "row_index", "column_index", tx.normalize_space(F.col("_v")).alias("value_raw")
    )


def header_cells(tables: DataFrame, header: str = "schema") -> DataFrame:
    """One row per header: raw text and the normalised column name. Equal header rows are named once."""
    raw = F.col(header)
    named = tables.select(raw.alias("_raw")).distinct().withColumn("_names", tx.unique_names(F.col("_raw")))
    met = tables.select(*TABLE, raw.alias("_own")).join(named, F.col("_own") == F.col("_raw"))
    names = met.select(*TABLE, F.arrays_zip(F.col("_raw").alias("raw"), F.col("_names").alias("name")).alias("_h"))
    # An outer explode, because Spark would test the size of an inner one's array in a filter and compute all names again.
    return names.select(*TABLE, F.posexplode_outer("_h").alias("column_index", "_c")).where("column_index is not null").select(
        *TABLE, "column_index", F.col("_c.raw").alias("header"), F.col("_c.name").alias("column_name")
    )


def pivot_grid(cells: DataFrame, tables: DataFrame) -> DataFrame:
    """One row per table row with its cells as an array of the table's width, blanks filled.

    ``tables`` has ``row_count`` and ``column_count``; cells outside are ignored.
    """
    inside = cells.join(tables.select(*TABLE, "row_count", "column_count"), TABLE).where(
        "row_index >= 0 and row_index < row_count and column_index >= 0 and column_index < column_count"
    )
    filled = inside.groupBy(*TABLE, "row_index", "column_count").agg(
        F.map_from_entries(F.collect_list(F.struct("column_index", "value_raw"))).alias("_m")
    )
    width = F.transform(F.sequence(F.lit(0), F.col("column_count") - 1), lambda i: F.coalesce(F.try_element_at("_m", i), F.lit("")))
    return filled.select(*TABLE, "row_index", width.alias("cells"))


def chart_grids(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First row becomes the header when any of it is non-blank; returns (headers, body cells)."""
    first = cells.where("row_index = 0")
    titled = first.groupBy(*TABLE).agg(F.bool_or(F.trim("value_raw") != "").alias("_titled"))
    marked = cells.join(titled, TABLE, "left").withColumn("_titled", F.coalesce("_titled", F.lit(False)))
    headers = marked.where("row_index = 0").select(
        *TABLE, "column_index", F.when(F.col("_titled"), F.col("value_raw")).otherwise(F.col("column_index").cast("string")).alias("header")
    )
    body = marked.where("not _titled or row_index > 0").select(
        *TABLE, F.when(F.col("_titled"), F.col("row_index") - 1).otherwise(F.col("row_index")).alias("row_index"), "column_index", "value_raw"
    )
    return headers, body


def melt_rows(cells: DataFrame, headers: DataFrame, source_kind: str = "table") -> DataFrame:
    """One typed row per table row: texts in ``attributes``, parsed numbers in ``measures``.

    A parsed cell keeps its text as ``<column>__raw``. The aggregate holds one table row.
    """
    typed = typed_cells(cells, headers)
    dimension = (F.col("semantics") == "dimension") | (F.col("value_raw") == "")
    read = typed.select(*TABLE, "row_index", "column_name", "value_raw", F.when(~dimension, F.col("value_num")).alias("_n"))
    text = F.struct(F.when(F.col("_n").isNull(), F.col("column_name")).otherwise(F.concat("column_name", F.lit("__raw"))).alias("key"), F.col("value_raw").alias("value"))
    number = F.when(F.col("_n").isNotNull(), F.struct(F.col("column_name").alias("key"), F.col("_n").alias("value")))
    rows = read.groupBy(*TABLE, "row_index").agg(
        F.map_from_entries(F.sort_array(F.collect_list(text))).alias("attributes"), F.map_from_entries(F.sort_array(F.collect_list(number))).alias("measures")
    )
    return rows.select(
        tx.stable_id(F.col("document_id"), F.lit(source_kind), F.col("table_id"), F.col("row_index")).alias("record_id"),
        "document_id", F.lit(source_kind).alias("source_kind"), F.col("table_id").alias("source_id"), "row_index",
        F.lit(f"{source_kind}_row").alias("grain"), "attributes", "measures",
    )


# --- header propagation -----------------------------------------------------------------------


def _clean(header: Column) -> Column:
    return F.transform(header, lambda h: tx.normalize_space(h))


def columns_are_generic(header: Column) -> Column:
    flags = F.transform(header, lambda h, i: numbers.generic_header(h, i))
    return F.forall(flags, lambda f: f)


def _filled(header: Column) -> Column:
    return F.filter(header, lambda h: h != "")


def looks_like_header(header: Column) -> Column:
    filled = _filled(header)
    data = F.size(F.filter(filled, lambda h: numbers.looks_like_data(h)))
    words = F.size(F.filter(filled, lambda h: h.rlike("\\p{L}")))
    n = F.size(filled)
    return (n >= 3) & (words >= F.greatest(F.lit(3), n - 1)) & (data <= 1)


def header_is_data(header: Column) -> Column:
    filled = _filled(header)
    data = F.size(F.filter(filled, lambda h: numbers.looks_like_data(h)))
    n = F.size(filled)
    return (n > 0) & (data >= F.greatest(F.lit(2), F.floor(n / 3).cast("int")))


def propagate_headers(tables: DataFrame, *, chunk: int = CHUNK) -> DataFrame:
    """A generic or data-like header takes the latest usable one of the same title and width.

    Adds the corrected ``header`` and ``header_row``: the old header, where it was data and
    becomes the first row of the table.
    """
    cleaned = tables.withColumn("header", _clean(F.col("header"))).withColumns(
        {
            "_title": F.coalesce("title_canonical", F.lit("table")),
            "_width": F.size("header"),
            "_generic": columns_are_generic(F.col("header")),
            "_data": header_is_data(F.col("header")),
        }
    )
    usable = ~F.col("_generic") & ~F.col("_data") & looks_like_header(F.col("header"))
    carried = last_before(
        cleaned.withColumn("_usable", usable), ["document_id", "_title", "_width"], "order_index",
        {"_known": F.when(F.col("_usable"), F.col("header"))}, chunk=chunk,
    )
    fix = ~F.col("_usable") & F.col("_known").isNotNull()
    return carried.select(
        *[c for c in tables.columns if c != "header"],
        F.when(fix & (F.col("_generic") | F.col("_data")), F.col("_known")).otherwise(F.col("header")).alias("header"),
        F.when(fix & ~F.col("_generic") & F.col("_data"), F.col("header")).alias("header_row"),
    )


# --- fragment merging -------------------------------------------------------------------------

# How far edges of one table may drift, and the share of the narrower width both must cover.
EDGE_DRIFT, SHARED_WIDTH = 28.0, 0.85


def _lined_up(low: Column, high: Column, left: Column, right: Column) -> Column:
    """Edges of a fragment against those of a table; unknown edges always line up."""
    narrow = F.least(F.greatest(high - low, F.lit(1.0)), F.greatest(right - left, F.lit(1.0)))
    shared = F.greatest(F.least(high, right) - F.greatest(low, left), F.lit(0.0)) / narrow
    close = (F.abs(low - left) <= EDGE_DRIFT) & (F.abs(high - right) <= EDGE_DRIFT) & (shared >= SHARED_WIDTH)
    return F.coalesce(close, F.lit(True))


def _cut_early(here: Column, before: Column) -> Column:
    """True where two neighbours have different headers and both are plain.

    Only a fragment whose columns are generic or data may change the header of a table, or stand between two that have
    the same. Every other change parts them in any run, so it is cut ahead and not in a round of its own.
    """
    plain = ~(here["_generic"] | here["_data"] | before["_generic"] | before["_data"])
    return plain & (here["_print"] != before["_print"])


def _fragment_facts(tables: DataFrame, sections: DataFrame, chunk: int) -> DataFrame:
    """A record per fragment, with ``cut`` where nothing can join it to the one before: another width, a page
    missed, a heading between them on their page, or another header where neither says that rows may have been read as
    columns."""
    clean = tables.withColumns({"header": _clean(F.col("header")), "first_row": _clean(F.col("first_row")), "order_index": F.col("order_index").cast("long")})
    heads = sections.select("document_id", F.col("order_index").cast("long").alias("order_index"), "page_number", F.lit(True).alias("_head"))
    both = clean.select("document_id", "order_index", "page_number", F.lit(False).alias("_head")).unionByName(heads)
    headed = last_before(
        both, ["document_id"], "order_index", {"_heading": F.when(F.col("_head"), F.struct("order_index", "page_number"))}, chunk=chunk
    ).where("not _head")
    placed = clean.join(headed.select("document_id", "order_index", "_heading"), ["document_id", "order_index"])
    told = placed.withColumns(
        {
            "_width": F.size("header"),
            "_print": F.xxhash64("header"),
            "_generic": columns_are_generic(F.col("header")),
            "_data": header_is_data(F.col("header")),
        }
    )
    around = neighbours(
        told, ["document_id"], "order_index", ["order_index", "page_number", "_width", "_print", "_generic", "_data"], prev="_p", chunk=chunk
    )
    fact = ("_print", "_generic", "_data")
    renamed = _cut_early(F.struct(*fact), F.struct(*[F.col(f"_p.{c}").alias(c) for c in fact]))
    step = F.col("page_number") - F.col("_p.page_number")
    parted = (step == 0) & (F.col("_heading.page_number") == F.col("page_number")) & (F.col("_heading.order_index") > F.col("_p.order_index"))
    joined = (F.col("_p._width") == F.col("_width")) & F.coalesce(step.between(0, 1), F.lit(True)) & ~F.coalesce(parted | renamed, F.lit(False))
    edges = F.when(F.col("bbox").isNotNull(), F.struct(F.col("bbox.page_number").alias("page"), F.col("bbox.left").alias("low"), F.col("bbox.right").alias("high")))
    return around.select(
        "document_id", "order_index", "header", "first_row", F.col("row_count").cast("long").alias("row_count"), edges.alias("edges"),
        F.when(F.col("section_id").isNotNull(), F.struct("section_id", "section_slug")).alias("section"),
        F.col("_generic").alias("generic"), looks_like_header(F.col("header")).alias("is_header"), F.col("_data").alias("is_data"),
        (~F.coalesce(joined, F.lit(False))).alias("cut"),
    )


def _judged(facts: DataFrame, chunk: int) -> DataFrame:
    """Each fragment against the table that all fragments of its run before it form.

    ``run`` names the run by its first fragment. Of a run: the header it opens with, the first fragment with another
    one (the pivot), the rows and the only row before the pivot, the edges known first and the section known first.
    ``fails`` marks fragments that can't join; what is said behind a failure holds after the run is cut there.
    """
    key = ["document_id", "run"]
    order, rows = F.col("order_index"), F.col("row_count")
    runs = running_totals(facts, ["document_id"], "order_index", {"run": F.when(F.col("cut"), 1).otherwise(0).cast("long")}, chunk=chunk).select(*facts.columns, "run")
    known = F.when(F.col("section").isNotNull(), order)
    opening = runs.groupBy(*key).agg(
        F.min(order).alias("lead"),
        F.min_by(F.struct("header", "generic", "is_header"), order).alias("_of_h"),
        F.min_by(F.struct(order.alias("at"), F.col("edges.page").alias("page")), F.when(F.col("edges").isNotNull(), order)).alias("_base"),
        F.min_by("section", known).alias("_first_section"),
        F.min(known).alias("_from"),
    )
    opened = runs.join(opening, key).withColumn("_h", F.col("_of_h.header"))
    # Edges: those known first, widened by the fragments of their page.
    on_base = F.col("_base").isNotNull() & F.col("edges").isNotNull() & F.col("edges.page").eqNullSafe(F.col("_base.page"))
    second = opened.groupBy(*key).agg(
        F.min(F.when(F.col("header") != F.col("_h"), order)).alias("_pivot"),
        F.min(F.when(on_base, F.col("edges.low"))).alias("_page_low"),
        F.max(F.when(on_base, F.col("edges.high"))).alias("_page_high"),
    )
    opened = opened.join(second, key)
    ahead = F.col("_pivot").isNull() | (order < F.col("_pivot"))
    before = opened.groupBy(*key).agg(
        F.coalesce(F.sum(F.when(ahead, rows)), F.lit(0)).alias("_rows"),
        F.min_by("first_row", F.when(ahead & (rows > 0), order)).alias("_only"),
        F.min_by(F.struct("generic", "is_data", "section"), F.when(order == F.col("_pivot"), order)).alias("_p"),
    )
    upto = Window.partitionBy(*key, "_on").orderBy("order_index").rowsBetween(Window.unboundedPreceding, -1)
    # Those on the page of the first edges are one page's tables; the others are spread by their position.
    spread = opened.withColumn("_on", F.when(on_base, F.lit(-1).cast("long")).otherwise(F.floor(order / chunk)))
    near = spread.withColumns({"_low": F.min("edges.low").over(upto), "_high": F.max("edges.high").over(upto)})
    all_ = near.join(before, key)
    on_page = F.col("edges.page").eqNullSafe(F.col("_base.page"))
    low, high = (F.when(on_page, F.col(f"_{n}")).otherwise(F.col(f"_page_{n}")) for n in ("low", "high"))
    aligned = (order <= F.coalesce(F.col("_base.at"), order)) | F.col("edges").isNull() | _lined_up(low, high, F.col("edges.low"), F.col("edges.high"))
    same = lambda a, b: a.isNull() | b.isNull() | (a["section_id"] == b["section_id"]) | F.coalesce(a["section_slug"] == b["section_slug"], F.lit(False))
    left = F.when(F.col("_from") < order, F.col("_first_section"))
    promoted = F.col("_of_h.generic") & (F.col("_rows") == 1) & F.coalesce(looks_like_header(F.col("_only")), F.lit(False)) & (F.col("_p.generic") | F.col("_p.is_data"))
    demotes = ~F.col("_p.generic") & F.col("_p.is_data")
    header_only = (F.col("_rows") == 0) & ~F.col("_of_h.generic") & F.col("_of_h.is_header") & F.col("_p.is_data")
    at_pivot = F.coalesce(order == F.col("_pivot"), F.lit(False))
    behind = F.coalesce(order > F.col("_pivot"), F.lit(False))
    header = F.when(F.coalesce(promoted, F.lit(False)), F.col("_only")).otherwise(F.col("_h"))
    fits = F.when(at_pivot, F.coalesce((promoted | header_only) & same(left, F.col("section")), F.lit(False))).when(behind, F.col("header") == header).otherwise(True)
    return all_.select(
        *facts.columns, "run", "lead", "_pivot", header.alias("merged_header"), (F.col("_pivot").isNotNull() & F.coalesce(promoted, F.lit(False))).alias("promoted"),
        (at_pivot & demotes).alias("demoted"), (at_pivot | behind).alias("late"), ((order > F.col("lead")) & ~(aligned & fits)).alias("fails"),
    )


def merge_plan(tables: DataFrame, sections: DataFrame, *, chunk: int = CHUNK) -> DataFrame:
    """Which table fragments are one table, and where the rows of each go.

    A fragment continues the table before it when its edges line up and it has the table's header; a table that is so
    far only a header (as its single row under generic columns, or as columns without rows) also takes a fragment whose
    columns are generic or data. Every fragment is judged at once against the run before it; runs are cut at their
    first failure, and judged again until none fails. Rounds follow the number of failures in one run; each is
    aggregates and window scans, so a run may be of any length.
    """
    facts = checkpointed(_fragment_facts(tables, sections, chunk))
    while True:
        judged = checkpointed(_judged(facts, chunk))
        failed = judged.where("fails").groupBy("document_id", "run").agg(F.min("order_index").alias("order_index")).withColumn("_again", F.lit(True)).drop("run")
        if failed.isEmpty():
            break
        again = facts.join(failed, ["document_id", "order_index"], "left")
        facts = checkpointed(again.withColumn("cut", F.col("cut") | F.col("_again").isNotNull()).select(*facts.columns))
    above = F.col("row_count") + F.when(F.col("demoted"), 1).otherwise(0)
    placed = running_totals(judged, ["document_id", "run"], "order_index", {"_to": above}, chunk=chunk)
    # A promoted row leaves the rows of the fragments behind it one place higher.
    offset = F.col("_to") - above - F.when(F.col("promoted") & F.col("late"), 1).otherwise(0)
    return placed.select(
        "document_id", "order_index", F.col("lead").alias("merged_order"), (F.col("promoted") & ~F.col("late")).alias("drop_first"),
        F.col("demoted").alias("header_as_row"), offset.cast("long").alias("row_offset"), F.col("merged_header").alias("header"),
    )


def merge_fragments(tables: DataFrame, cells: DataFrame, plan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Apply a merge plan; returns (tables, cells) keyed by the merged table."""
    ids = tables.select("document_id", "table_id", F.col("order_index").cast("long").alias("order_index"))
    steps = plan.join(ids, ["document_id", "order_index"])
    leaders = ids.select("document_id", F.col("order_index").alias("merged_order"), F.col("table_id").alias("merged_id"))
    steps = steps.join(leaders, ["document_id", "merged_order"])
    moved = cells.join(steps, ["document_id", "table_id"]).where("not (drop_first and row_index = 0)")
    shift = F.col("row_offset") + F.when(F.col("header_as_row"), 1).otherwise(0) - F.when(F.col("drop_first"), 1).otherwise(0)
    rows = moved.select(
        "document_id", F.col("merged_id").alias("table_id"), (F.col("row_index") + shift).cast("int").alias("row_index"), "column_index", "value_raw"
    )
    old = tables.select("document_id", "table_id", F.col("header").alias("_old"))
    demoted = (
        steps.where("header_as_row")
        .join(old, ["document_id", "table_id"])
        .select("document_id", F.col("merged_id").alias("table_id"), F.col("row_offset").cast("int").alias("row_index"), F.posexplode("_old").alias("column_index", "value_raw"))
    )
    merged = steps.groupBy("document_id", F.col("merged_id").alias("table_id")).agg(
        F.max_by("header", "order_index").alias("header"), F.count(F.lit(1)).alias("n_fragments")
    )
    return merged, rows.unionByName(demoted)


# --- structure --------------------------------------------------------------------------------


def dimension_column(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """First column with fewer numbers than half of its filled cells, else column 0."""
    typed = typed_cells(cells.where(F.trim("value_raw") != ""), shuffled(headers))
    per_column = typed.groupBy(*TABLE, "column_index").agg(
        F.count(F.lit(1)).alias("n"), F.count("value_num").alias("n_num")
    )
    return per_column.groupBy(*TABLE).agg(
        F.coalesce(F.min(F.when(F.col("n_num") < F.col("n") / 2, F.col("column_index"))), F.lit(0)).alias("dimension")
    )


def period_columns(headers: DataFrame) -> DataFrame:
    """Columns whose header is a period, with their sort key; unknown keys go last."""
    key = periods.chart_period_key(F.col("header"))
    last = F.struct(F.lit(9999).alias("year"), F.lit(99).alias("quarter"))
    return headers.where(periods.is_chart_period(F.col("header"))).select(*TABLE, "column_index", "header", F.coalesce(key, last).alias("period_key"))


def total_row(cells: DataFrame, dimension: DataFrame) -> DataFrame:
    """First row whose label says it is the total."""
    labels = cells.join(shuffled(dimension), TABLE).where("column_index = dimension")
    label = F.lower(tx.normalize_space(F.col("value_raw")))
    return labels.where(label.isin(*TOTAL_LABELS)).groupBy(*TABLE).agg(F.min("row_index").alias("total_row"))


def _label_column(cells: DataFrame) -> DataFrame:
    filled = cells.where(F.trim("value_raw") != "")
    share = filled.groupBy(*TABLE, "column_index").agg(
        F.avg(F.when(numbers.looks_numeric(F.col("value_raw")), 0.0).otherwise(1.0)).alias("words")
    )
    return share.groupBy(*TABLE).agg(
        F.coalesce(F.min(F.when(F.col("words") >= 0.6, F.col("column_index"))), F.lit(0)).alias("label_column")
    )


def table_structure(cells: DataFrame, tables: DataFrame) -> DataFrame:
    """Per table the label column, the header and whether it was read.

    ``tables`` has ``header``. A generic header is replaced by the first row when that row reads
    like one: at least two other cells, at most one of them numeric, none without a letter or
    digit. The label column is then chosen without that row.
    """
    trimmed = cells.withColumn("value_raw", F.trim("value_raw"))
    width = trimmed.groupBy(*TABLE).agg(F.max("column_index").alias("_w"))
    base = tables.select(*TABLE, F.transform("header", lambda h: F.trim(F.coalesce(h, F.lit("")))).alias("header")).join(width, TABLE, "left")
    generic = F.forall("header", lambda h: tx.normalize_text(h).rlike("^(column_\\d+|\\d+)?$"))
    base = base.withColumn("_generic", generic).join(_label_column(trimmed), TABLE, "left")
    first = trimmed.where("row_index = 0").join(base.select(*TABLE, "label_column"), TABLE)
    other = (F.col("column_index") != F.col("label_column")) & (F.col("value_raw") != "")
    head = first.groupBy(*TABLE).agg(
        F.count_if(other).alias("_n"),
        F.count_if(other & numbers.looks_numeric(F.col("value_raw"))).alias("_num"),
        F.count_if(other & ~F.col("value_raw").rlike("[\\p{L}\\p{N}]")).alias("_mute"),
        F.transform(F.array_sort(F.collect_list(F.struct("column_index", "value_raw"))), lambda c: c["value_raw"]).alias("_row"),
    )
    without_first = _label_column(trimmed.where("row_index > 0")).withColumnRenamed("label_column", "_below")
    joined = base.join(head, TABLE, "left").join(without_first, TABLE, "left")
    promote = F.coalesce(F.col("_generic") & (F.col("_n") >= 2) & (F.col("_num") <= 1) & (F.col("_mute") == 0), F.lit(False))
    wide = F.greatest(F.size("header"), F.coalesce(F.col("_w") + 1, F.lit(0)))
    padded = F.concat("header", F.array_repeat(F.lit(""), (wide - F.size("header")).cast("int")))
    return joined.select(
        *TABLE,
        F.when(promote, F.coalesce("_below", F.lit(0))).otherwise(F.coalesce("label_column", F.lit(0))).alias("label_column"),
        F.when(promote, F.col("_row")).otherwise(padded).alias("header"),
        promote.alias("first_row_is_header"),
        (promote | ~F.col("_generic")).alias("header_read"),
    )


def row_labels(cells: DataFrame, structure: DataFrame) -> DataFrame:
    """Data rows with their label and how many other cells are filled or numeric."""
    joined = cells.withColumn("value_raw", F.trim("value_raw")).join(
        structure.select(*TABLE, "label_column", "first_row_is_header"), TABLE
    ).where("not (first_row_is_header and row_index = 0)")
    other = (F.col("column_index") != F.col("label_column")) & (F.col("value_raw") != "")
    return joined.groupBy(*TABLE, "row_index").agg(
        F.max(F.when(F.col("column_index") == F.col("label_column"), F.col("value_raw"))).alias("label"),
        F.count_if(other).alias("n_filled"),
        F.count_if(other & numbers.looks_numeric(F.col("value_raw"))).alias("n_numeric"),
    )


def segments(labels: DataFrame, *, chunk: int = CHUNK) -> DataFrame:
    """Row ranges under titles, which are rows that hold nothing but a label."""
    titles = labels.where("label <> '' and n_filled = 0")
    ends = labels.groupBy(*TABLE).agg(F.max("row_index").alias("_last"))
    after = neighbours(titles, TABLE, "row_index", ["row_index"], next="_n", chunk=chunk).join(ends, TABLE)
    end = F.coalesce(F.col("_n.row_index") - 1, F.col("_last"))
    return after.where(end >= F.col("row_index") + 1).select(
        *TABLE, F.col("label").alias("title"), (F.col("row_index") + 1).alias("first_row"), end.alias("last_row")
    )


# --- inventory and windows --------------------------------------------------------------------


def inventory(evidence: Mapping[str, DataFrame], samples: int = 5, *, shown: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """One summary row per table, chart or collection.

    Each input has ``document_id, artifact, ord, label, page_number``. Samples are the first
    distinct labels, whole (``shown`` cuts what is listed, after they were told apart); the rest
    are cut by position before anything is collected.
    """
    key = ["document_id", "artifact"]
    parts = []
    for kind, rows in evidence.items():
        counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n_records"), F.min("page_number").alias("first_page"))
        named = rows.select(*key, "ord", tx.compact_text(F.col("label")).alias("label")).where("label is not null")
        firsts = named.groupBy(*key, "label").agg(F.min("ord").alias("ord"))
        head = ordinals(firsts, key, "ord", "_rn", chunk=chunk).where(F.col("_rn") <= samples)
        listed = head.groupBy(*key).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("ord", "label"))), lambda s: tx.compact_text(s["label"], shown)).alias("samples")
        )
        parts.append(
            counts.join(listed, key, "left").select(
                F.lit(kind).alias("kind"), *key, "n_records", "first_page",
                F.coalesce("samples", F.expr("cast(array() as array<string>)")).alias("samples"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def grouped_sources(rows: DataFrame, key: Sequence[str], position: str, *, chunk: int = CHUNK) -> DataFrame:
    """Rows numbered within their source (table rows by source, points by chart), order kept."""
    return ordinals(rows, key, position, "member", chunk=chunk)


def row_windows(rows: DataFrame, *, whole: int | None = None, chars: int | None = None, window: int = 12) -> DataFrame:
    """Rows shown of each table: all of them, or of a table above ``whole`` rows or ``chars``
    characters (both off by default) windows at start, middle and end.

    ``rows`` has ``row_index`` (dense from 0) and ``cells``. The size of a table is the length of
    its rows written as JSON. A row inside two windows is shown in both.
    """
    if whole is None and chars is None:
        return rows.withColumns({"mode": F.lit("completo"), "window_start": F.lit(0).cast("long")})
    spaced = F.length(F.to_json("cells")) + F.size("cells") - 1
    size = rows.groupBy(*TABLE).agg(F.count(F.lit(1)).alias("_n"), (F.sum(spaced) + 2 * F.count(F.lit(1))).alias("_c"))
    n, r = F.col("_n"), F.col("row_index")
    small = F.lit(True) if whole is None else n <= whole
    small = small if chars is None else small & (F.col("_c") <= chars)
    last = F.greatest(F.lit(0).cast("long"), n - window)
    starts = F.array_distinct(F.array(F.lit(0).cast("long"), F.floor(last / 2).cast("long"), last))
    shown = F.when(small, F.array(F.lit(0).cast("long"))).otherwise(
        F.filter(starts, lambda s: (r >= s) & (r < s + window))
    )
    mode = F.when(small, "completo").otherwise("janelas_deterministicas")
    return rows.join(size, TABLE).select(*rows.columns, mode.alias("mode"), F.explode(shown).alias("window_start"))


def chunk_records(rows: DataFrame, size: int = 40, limit: int | None = None) -> DataFrame:
    """Records in chunks of ``size`` by their dense position ``ord``; only the first ``limit`` chunks if given."""
    chunked = rows.withColumn("chunk", F.floor(F.col("ord") / size).cast("int"))
    return chunked if limit is None else chunked.where(F.col("chunk") < limit)


def anchor_hits(lines: DataFrame, anchors: DataFrame, limit: int | None = None) -> DataFrame:
    """First line of each file that literally holds each anchor, accents and case apart.

    With ``limit`` at most that many anchors are reported per file, in the order they are met (by
    line, then by their own order); a line is searched as the text it is, JSON or not.
    """
    keyed = lines.select("document_id", "line", tx.normalize_text(F.col("text")).alias("text"))
    wanted = anchors.select("document_id", "anchor", "ord", tx.normalize_text(F.col("anchor")).alias("term")).where("term <> ''")
    hits = literal_matches(keyed, wanted, ["document_id", "line"], scope=["document_id"])
    # An anchor written twice is one; its first spelling stays.
    firsts = hits.groupBy("document_id", "term").agg(F.min("line").alias("line"))
    named = firsts.join(wanted.groupBy("document_id", "term").agg(F.min(F.struct("ord", "anchor")).alias("_a")), ["document_id", "term"])
    met = named.select("document_id", F.col("_a.anchor").alias("anchor"), "line", F.col("_a.ord").alias("_ord"))
    if limit is not None:
        order = Window.partitionBy("document_id").orderBy("line", "_ord")
        met = met.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= limit).drop("_rn")
    return met.drop("_ord")
