"""Chart points and series derived from tables.

A table here is long: ``(document_id, table_id, row_index, column_index, value_raw)`` with a
``header`` per column. Each derived series is a join of cells with the few columns it uses.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provatab.cluster import checkpointed, shuffled
from provatab.functions import numbers, periods
from provatab.functions import text as tx
from provatab.operators.tables import TABLE, TOTAL_LABELS, dimension_column, period_columns, total_row

# Words in a section title that make it a chart section, and columns never a measure.
SECTION_MARKERS = ("comparativo", "comparison", "evolucao", "evolução", "acumulado", "accumulated", "annual", "anual")
NON_MEASURES = (
    "percentage",
    "percent",
    "pct",
    "ratio",
    "share",
    "variacao",
    "variação",
    "variation",
    "change",
    "delta",
)
TEMPORAL = "(?i)(?:jan|fev|mar|abr|mai|jun|jul|ago|set|out|nov|dez|\\d+t\\s*\\d{4}|\\d{4})"


def valid_line_charts(cells: DataFrame) -> DataFrame:
    """Charts whose first column is mostly temporal and whose other columns do not repeat.

    Rows are compared by the hash of their values, so the count is a plain aggregate.
    """
    rows = cells.groupBy(*TABLE, "row_index").agg(
        F.max(F.when(F.col("column_index") == 0, F.col("value_raw"))).alias("_first"),
        F.count_if(F.col("column_index") > 0).alias("_w"),
        F.to_json(
            F.array_sort(F.collect_list(F.when(F.col("column_index") > 0, F.struct("column_index", tx.normalize_space(F.col("value_raw")).alias("v")))))
        ).alias("_rest"),
    )
    kept = rows.groupBy(*TABLE, "_rest").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(tx.normalize_space(F.col("_first")).rlike(TEMPORAL)).alias("_hits"),
        F.max("_w").alias("_w"),
    )
    stats = kept.groupBy(*TABLE).agg(
        F.sum("_n").alias("n_rows"), F.sum("_hits").alias("n_temporal"), F.count(F.lit(1)).alias("n_distinct"), F.max("_w").alias("_w")
    )
    temporal = F.col("n_temporal") >= F.greatest(F.lit(2), F.floor(F.col("n_rows") / 2))
    repeated = (F.col("n_rows") - F.col("n_distinct")) / F.col("n_rows")
    return stats.where((F.col("_w") >= 1) & temporal & ((F.col("n_rows") <= 1) | (repeated <= 0.5))).select(
        *TABLE, "n_rows", "n_temporal", "n_distinct"
    )


def chart_points(cells: DataFrame, headers: DataFrame, charts: DataFrame) -> DataFrame:
    """One point per chart row: the first cell names the series, the header of the second
    column the category, and the first number after the first cell is the value.

    ``charts`` has ``chart_type`` and ``chart_title``. A line chart that is no valid series keeps
    its points under a snapshot title, without a category.
    """
    # Only line charts are held against the rule for series.
    lines = charts.where(F.lower("chart_type").contains("line")).select(*TABLE)
    good = valid_line_charts(cells.join(lines, TABLE, "left_semi")).select(*TABLE, F.lit(True).alias("_ok"))
    category = headers.where("column_index = 1").select(*TABLE, tx.normalize_space(F.col("header")).alias("_category"))
    used = charts.join(good, TABLE, "left").join(category, TABLE, "left")
    width = cells.groupBy(*TABLE).agg(F.max("column_index").alias("_w"))
    # Merged, since sent out whole the cells would all meet the few bytes of the charts in one task.
    placed = cells.hint("merge").join(used.join(width, TABLE), TABLE)
    number = numbers.number_of(F.col("value_raw"), column=F.coalesce("_category", F.lit("")), published=False)
    valued = placed.withColumn(
        "_n", F.when((F.col("column_index") > 0) | (F.col("_w") == 0), number)
    )
    hit = F.struct(F.col("_n").alias("n"), tx.normalize_space(F.col("value_raw")).alias("t"))
    rows = valued.groupBy(*charts.columns, "_ok", "_category", "row_index").agg(
        F.max(F.when(F.col("column_index") == 0, tx.normalize_space(F.col("value_raw")))).alias("series_name"),
        F.min_by(hit, F.when(F.col("_n").isNotNull(), F.col("column_index"))).alias("_hit"),
    )
    snapshot = F.lower("chart_type").contains("line") & F.col("_ok").isNull()
    snapshot = F.coalesce(snapshot, F.lit(False))
    return rows.select(
        *[c for c in charts.columns if c != "chart_title"],
        F.when(snapshot, "Line chart snapshot").otherwise(F.col("chart_title")).alias("chart_title"),
        "row_index", "series_name", F.when(~snapshot, F.col("_category")).alias("category_name"),
        F.col("_hit.n").alias("value_numeric"), F.col("_hit.t").alias("value_text"),
    )


def chart_titles(charts: DataFrame) -> DataFrame:
    """A specific section title wins; a bar chart else takes "measure | periods or dimension".

    ``charts`` has ``section_title``, ``chart_type`` and the ``header`` array.
    """
    header = F.transform("header", lambda h: tx.normalize_space(h))
    rest = F.slice(header, F.lit(2), F.greatest(F.size(header) - 1, F.lit(0)))
    measure = F.get(
        F.filter(rest, lambda h: (h != "") & ~F.lower(h).isin(*NON_MEASURES) & ~periods.is_chart_period(h)), F.lit(0)
    )
    named = F.filter(rest, lambda h: periods.is_chart_period(h))
    lead = F.nullif(F.get(header, F.lit(0)), F.lit(""))
    span = F.concat(F.lit(" | "), F.get(named, F.lit(0)), F.lit(" x "), F.get(named, F.lit(1)))
    lowered = F.lower(tx.normalize_space(F.col("section_title")))
    specific = lowered.contains(" vs ") | lowered.contains(" x ") | lowered.contains(" versus ")
    staged = charts.withColumns({"_m": measure, "_d": lead, "_s": F.when(F.size(named) >= 2, span)})
    built = F.coalesce(
        F.concat("_m", "_s"), F.concat("_d", "_s"), F.concat("_m", F.lit(" | "), "_d"), F.col("_m"), F.col("_d")
    )
    bar = F.lower(F.coalesce("chart_type", F.lit(""))).contains("bar") & (F.size("header") > 0)
    title = F.when(F.coalesce(specific, F.lit(False)), F.col("section_title")).when(bar, F.coalesce(built, "section_title")).otherwise(
        F.col("section_title")
    )
    return staged.withColumn("chart_title", title).drop("_m", "_d", "_s").withColumn("chart_title_canonical", tx.slugify(F.col("chart_title")))


# --- series derived from tables ---------------------------------------------------------------


def route_sections(sections: DataFrame) -> DataFrame:
    """Sections whose title asks for a derived series, and which one.

    ``periods`` are the quarters and years the title names, in order.
    """
    clean = tx.normalize_space(F.col("title_raw"))
    low = F.lower(clean)
    named = periods.period_tokens(F.col("title_raw"))
    marked = low.rlike("|".join(SECTION_MARKERS))
    figure = ~low.contains("comparativo") & low.rlike("(?U)\\d[\\d.,]*\\s*(?:unidades?|%)\\b")
    route = (
        F.when(low.rlike("acumulado|accumulated|12m|12 meses"), "accumulated")
        .when(low.rlike("anual|annual"), "annual_total")
        .otherwise("comparison")
    )
    return sections.where(~figure & (marked | (F.size(named) >= 2))).select(
        "document_id", "section_id", F.col("title_raw").alias("chart_title"), route.alias("route"), named.alias("periods")
    )


def _usable(cells: DataFrame, headers: DataFrame):
    """Tables with at least two period columns, their label cells and typed period cells."""
    columns = period_columns(headers)
    counted = columns.groupBy(*TABLE).agg(F.count(F.lit(1)).alias("_n")).where("_n >= 2").select(*TABLE)
    columns = columns.join(shuffled(counted), TABLE)
    dimension = dimension_column(cells, headers).join(shuffled(counted), TABLE)
    label = tx.normalize_space(F.col("value_raw"))
    labels = (
        cells.join(shuffled(dimension), TABLE).where("column_index = dimension").select(*TABLE, "row_index", label.alias("category"))
    )
    body = labels.where((F.col("category") != "") & ~F.lower("category").isin(*TOTAL_LABELS))
    return columns, dimension, body, _values(cells, columns)


def _values(cells: DataFrame, columns: DataFrame) -> DataFrame:
    """Typed cells of those columns, with all that ``columns`` says of them."""
    number = numbers.number_of(F.col("value_raw"), column=F.col("header"))
    told = [c for c in columns.columns if c not in (*TABLE, "column_index")]
    return cells.join(shuffled(columns), [*TABLE, "column_index"]).select(
        *TABLE, "row_index", "column_index", *told, F.col("value_raw").alias("value_text"), number.alias("value")
    )


def _total_cells(cells: DataFrame, dimension: DataFrame, values: DataFrame) -> DataFrame:
    total = total_row(cells, dimension).withColumnRenamed("total_row", "row_index")
    return values.join(shuffled(total), [*TABLE, "row_index"])


_OUT = ["document_id", "table_id", "section_id", "chart_type", "series_name", "category_name", "value", "value_text"]


def total_over_time(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """The total row of each table with two or more period columns, one point per period."""
    _, dimension, _, values = _usable(cells, headers)
    points = _total_cells(cells, dimension, values).where("value is not null or value_text <> ''")
    return points.select(
        *TABLE, F.lit(None).cast("string").alias("section_id"), F.lit("total_timeseries").alias("chart_type"),
        F.lit(None).cast("string").alias("series_name"), F.col("header").alias("category_name"), "value", "value_text",
    )


def period_comparison(cells: DataFrame, headers: DataFrame, sections: DataFrame) -> DataFrame:
    """The first two periods a section title names that the table has, by category."""
    _, _, body, values = _usable(cells, headers)
    asked = sections.where("route = 'comparison'").select(
        "document_id", "section_id", F.posexplode("periods").alias("pos", "header")
    )
    held = values.select(*TABLE, "header").distinct().join(shuffled(asked), ["document_id", "header"])
    w = Window.partitionBy(*TABLE, "section_id").orderBy("pos")
    ranked = held.withColumn("_rn", F.row_number().over(w)).withColumn(
        "_n", F.count(F.lit(1)).over(Window.partitionBy(*TABLE, "section_id"))
    )
    two = ranked.where("_rn <= 2 and _n >= 2").select(*TABLE, "section_id", "header")
    points = values.join(shuffled(two), [*TABLE, "header"]).join(shuffled(body), [*TABLE, "row_index"])
    return points.where("value is not null or value_text <> ''").select(
        *TABLE, "section_id", F.lit("period_comparison").alias("chart_type"), F.col("header").alias("series_name"),
        F.col("category").alias("category_name"), "value", "value_text",
    )


def _ranked_columns(columns: DataFrame) -> DataFrame:
    # Column counts per table are small: one row per period column, not per cell.
    w = Window.partitionBy(*TABLE).orderBy("period_key", "column_index")
    return columns.withColumn("_at", F.row_number().over(w))


def trailing_sum(cells: DataFrame, headers: DataFrame, sections: DataFrame, periods_kept: int = 4) -> DataFrame:
    """Sum of the last four periods up to the one the title names (or the last four)."""
    columns, _, body, _ = _usable(cells, headers)
    asked = sections.where("route = 'accumulated'").select(
        "document_id", "section_id", periods.chart_period_key(F.try_element_at("periods", F.lit(-1))).alias("_until")
    )
    unknown = F.col("period_key.year") == 9999
    eligible = _ranked_columns(columns).join(shuffled(asked), "document_id").where(
        F.col("_until").isNull() | (~unknown & (F.col("period_key") <= F.col("_until")))
    )
    back = Window.partitionBy(*TABLE, "section_id").orderBy(F.col("_at").desc())
    # A row per summed column; only their cells are read as numbers and meet their labels.
    ranked = eligible.withColumn("_rn", F.row_number().over(back)).where(F.col("_rn") <= periods_kept)
    used = checkpointed(ranked.select(*TABLE, "section_id", "column_index", "header", "_at"))
    names = used.groupBy(*TABLE, "section_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "header"))), lambda s: s["header"]), " + ").alias("series_name")
    )
    summed = (
        _values(cells, used.drop("_at"))
        .join(shuffled(body), [*TABLE, "row_index"])
        .groupBy(*TABLE, "section_id", "row_index", "category")
        .agg(F.sum("value").alias("value"))
        .where("value is not null")
    )
    return summed.join(shuffled(names), [*TABLE, "section_id"]).select(
        *TABLE, "section_id", F.lit("accumulated").alias("chart_type"), "series_name", F.col("category").alias("category_name"), "value",
        _number_text("value").alias("value_text"),
    )


def _number_text(col: str):
    whole = F.col(col) == F.floor(col)
    return F.when(whole, F.col(col).cast("decimal(38,0)").cast("string")).otherwise(F.col(col).cast("string"))


def annual_totals(cells: DataFrame, headers: DataFrame, sections: DataFrame) -> DataFrame:
    """Total row summed per year, for tables with two or more years of several periods."""
    columns, dimension, _, values = _usable(cells, headers)
    keyed = columns.where("period_key.year between 1 and 9998").withColumn("year", F.col("period_key.year"))
    years = keyed.groupBy(*TABLE, "year").agg(
        F.count(F.lit(1)).alias("_n"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("period_key", "column_index", "header"))), lambda s: s["header"]), " + ").alias(
            "series_name"
        ),
    ).where("_n > 1")
    enough = years.groupBy(*TABLE).agg(F.count(F.lit(1)).alias("_y")).where("_y >= 2").select(*TABLE)
    totals = _total_cells(cells, dimension, values).withColumn("year", F.col("period_key.year"))
    summed = totals.groupBy(*TABLE, "year").agg(F.sum("value").alias("value")).where("value is not null")
    asked = sections.where("route = 'annual_total'").select("document_id", "section_id")
    return summed.join(shuffled(years), [*TABLE, "year"]).join(shuffled(enough), TABLE).join(shuffled(asked), "document_id").select(
        *TABLE, "section_id", F.lit("annual_total").alias("chart_type"), "series_name", F.col("year").cast("string").alias("category_name"),
        "value", _number_text("value").alias("value_text"),
    )


def derived_series(cells: DataFrame, headers: DataFrame, sections: DataFrame, native: DataFrame | None = None) -> DataFrame:
    """Every derived series; documents with native chart points get none."""
    routed = route_sections(sections)
    parts = [
        total_over_time(cells, headers),
        period_comparison(cells, headers, routed),
        trailing_sum(cells, headers, routed),
        annual_totals(cells, headers, routed),
    ]
    out = reduce(DataFrame.unionByName, [p.select(*_OUT) for p in parts])
    return out if native is None else out.join(native.select("document_id").distinct(), "document_id", "left_anti")
