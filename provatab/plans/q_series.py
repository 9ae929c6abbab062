"""Supplier tables as charts and derived series."""

from pyspark.sql import functions as F

from provatab.operators import series as sr
from provatab.operators.tables import header_cells
from provatab.plans import views as v
from provatab.plans.registry import query

PERIOD = f"with {v.PERIOD_SQL}"


def _sections(spark, sf):
    """Section titles per supplier that ask for each kind of series, and some that do not."""
    titles = ("Comparativo 1T1998 x 3T1997", "Acumulado até 2T1999", "Total anual de vendas", "Vendas de 120 unidades em 1T1998", "Resumo", "Lucro 4T1996 e 4T1997")
    docs = v.period_tables(spark, sf).select("document_id").distinct()
    return docs.select("document_id", F.posexplode(F.array(*[F.lit(t) for t in titles])).alias("n", "title_raw")).select(
        "document_id", F.concat(F.lit("s"), F.col("n").cast("string")).alias("section_id"), "title_raw"
    )


def _shown(df, *cols):
    return df.select(*cols, F.round(F.col("value") * 100).cast("bigint").alias("cents"))


@query(
    "d16_chart_points",
    f"""with {v.ORDER_ROWS_SQL}, n as (select l_orderkey, count(*) as n, count(distinct (l_quantity, l_extendedprice, l_discount, l_tax)) as d from lineitem group by 1)
 select cast(o.l_orderkey as varchar) as document_id, row_index, 'Item ' || l_partkey as series_name, case when l_linenumber >= 0 then 'Total unidades' end as category_name, cast(l_quantity as bigint) as value, 'Chart' as title
 from olines o join n using (l_orderkey)""",
)
def _(spark, sf):


    cells = v.order_cells(spark, sf)
    docs = cells.select("document_id", "table_id").distinct()
    headers = header_cells(docs.withColumn("schema", F.array(*[F.lit(h) for h in v.ORDER_HEADER])))
    charts = docs.withColumns({"chart_type": F.lit("bar_chart"), "chart_title": F.lit("Chart")})
    out = sr.chart_points(cells, headers, charts)
    return out.select("document_id", "row_index", "series_name", "category_name", F.col("value_numeric").cast("bigint").alias("value"), F.col("chart_title").alias("title"))


@query(
    "d16_line_charts",
    """with t as (select user_id, ts, row_number() over (partition by user_id order by event_id) as r, event_type, value from events),
 x as (select user_id, count(*) as n_rows, count(*) filter (where event_type <> 'error') as n_temporal, count(distinct floor(value)) as n_distinct from t group by 1)
 select cast(user_id as varchar) as document_id, n_rows, n_temporal, n_distinct from x where n_temporal >= greatest(2, n_rows // 2) and (n_rows <= 1 or (n_rows - n_distinct) / n_rows <= 0.5)""",
)
def _(spark, sf):
    e = v.table(spark, sf, "events")
    day = F.when(F.col("event_type") == "error", "sem data").otherwise(F.date_format("ts", "MMM yyyy"))
    cells = e.select(
        F.col("user_id").cast("string").alias("document_id"), F.lit("c").alias("table_id"), F.col("event_id").alias("row_index"),
        F.posexplode(F.array(day, F.floor("value").cast("int").cast("string"))).alias("column_index", "value_raw"),
    )
    return sr.valid_line_charts(cells).select("document_id", "n_rows", "n_temporal", "n_distinct")


@query(
    "d17_chart_titles",
    """select s_suppkey, case s_suppkey % 4 when 0 then 'Vendas x Metas' when 1 then 'VGV | 1T2026 x 4T2025' when 2 then 'VGV | Região' else 'Seção livre' end as chart_title from supplier""",
)
def _(spark, sf):
    s = v.table(spark, sf, "supplier")
    m = F.col("s_suppkey") % 4
    header = F.when(m == 1, F.array(F.lit("Região"), F.lit("variação"), F.lit("1T2026"), F.lit("4T2025"), F.lit("VGV"))).otherwise(F.array(F.lit("Região"), F.lit(" VGV ")))
    charts = s.select(
        "s_suppkey", header.alias("header"), F.when(m == 0, "Vendas x Metas").when(m == 3, "Seção livre").otherwise("Outra").alias("section_title"),
        F.when(m == 3, "line_chart").otherwise("bar_chart").alias("chart_type"),
    )
    return sr.chart_titles(charts).select("s_suppkey", "chart_title")


@query("d19_total_over_time", f"{PERIOD} select document_id, table_id, header as category_name, cents from cells where row_index = 3")
def _(spark, sf):
    return _shown(sr.total_over_time(v.period_cells(spark, sf), v.period_headers(spark, sf)), "document_id", "table_id", "category_name")


_LABEL = "case row_index when 0 then 'Vendas Contratadas Brutas' when 1 then 'Vendas Líquidas 100%' else 'Número de Unidades' end"


@query(
    "d20_period_comparison",
    f"""{PERIOD}, a as (select unnest(['s0', 's0', 's5', 's5']) as section_id, unnest(['1T1998', '3T1997', '4T1996', '4T1997']) as header),
 h as (select c.document_id, c.table_id, a.section_id, count(distinct a.header) as n from cells c join a using (header) group by 1, 2, 3 having count(distinct a.header) = 2)
 select c.document_id, c.table_id, h.section_id, c.header as series_name, {_LABEL} as category_name, c.cents from cells c join h using (document_id, table_id) join a on a.section_id = h.section_id and a.header = c.header where row_index < 3""",
)
def _(spark, sf):
    out = sr.period_comparison(v.period_cells(spark, sf), v.period_headers(spark, sf), sr.route_sections(_sections(spark, sf)))
    return _shown(out, "document_id", "table_id", "section_id", "series_name", "category_name")


@query(
    "d21_trailing_sum",
    f"""{PERIOD} select document_id, table_id, 's1' as section_id, '3T1998 + 4T1998 + 1T1999 + 2T1999' as series_name, {_LABEL} as category_name, cast(sum(cents) as bigint) as cents
 from cells where row_index < 3 and header in ('3T1998', '4T1998', '1T1999', '2T1999') group by 1, 2, row_index""",
)
def _(spark, sf):
    out = sr.trailing_sum(v.period_cells(spark, sf), v.period_headers(spark, sf), sr.route_sections(_sections(spark, sf)))
    return _shown(out, "document_id", "table_id", "section_id", "series_name", "category_name")


@query(
    "d22_annual_totals",
    f"{PERIOD} select document_id, table_id, 's2' as section_id, cast(yr as varchar) as category_name, cast(sum(cents) as bigint) as cents from cells where row_index = 3 group by 1, 2, yr",
)
def _(spark, sf):
    out = sr.annual_totals(v.period_cells(spark, sf), v.period_headers(spark, sf), sr.route_sections(_sections(spark, sf)))
    return _shown(out, "document_id", "table_id", "section_id", "category_name")


@query(
    "d23_section_routes",
    """select document_id, unnest(['s0', 's1', 's2', 's5']) as section_id, unnest(['comparison', 'accumulated', 'annual_total', 'comparison']) as route, unnest(['1T1998,3T1997', '2T1999', '', '4T1996,4T1997']) as periods from (select distinct cast(l_suppkey as varchar) as document_id from lineitem)""",
)
def _(spark, sf):
    out = sr.route_sections(_sections(spark, sf))
    return out.select("document_id", "section_id", "route", F.array_join("periods", ",").alias("periods"))


@query(
    "d23_native_first",
    f"{PERIOD} select chart_type, count(*) as n from (select document_id, 'total_timeseries' as chart_type from cells where row_index = 3 union all select document_id, 'annual_total' from (select distinct document_id, table_id, yr from cells)) where cast(document_id as bigint) % 2 = 1 group by 1",
)
def _(spark, sf):
    native = v.table(spark, sf, "supplier").where("s_suppkey % 2 = 0").select(F.col("s_suppkey").cast("string").alias("document_id"))
    out = sr.derived_series(v.period_cells(spark, sf), v.period_headers(spark, sf), _sections(spark, sf), native)
    return out.where("chart_type in ('total_timeseries', 'annual_total')").groupBy("chart_type").agg(F.count(F.lit(1)).alias("n"))
