"""Tables per order and per supplier: grids, typed rows, headers, structure, windows (D5-D10,
D18, D24-D28, G7)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from provatab.cluster import ordinals

from provatab.operators import tables as tb
from provatab.plans import views as v
from provatab.plans.registry import query

ORDER = f"with {v.ORDER_ROWS_SQL}"
PERIOD = f"with {v.PERIOD_SQL}"


def _grids(spark, sf):
    """Document lines in tables of five rows; the words of a line are its cells."""
    items = v.items(spark, sf)
    return items.select("document_id", F.floor(F.col("order_index") / 5).cast("string").alias("table_id"), (F.col("order_index") % 5).alias("row_index"), F.split("text", " ").alias("cells"))


@query(
    "d5_exploded_cells",
    """with l as (select cast(doc_id as varchar) as document_id, unnest(string_split(text, chr(10))) as line, cast(generate_subscripts(string_split(text, chr(10)), 1) - 1 as integer) as row_index from documents),
 c as (select document_id, row_index, cast(generate_subscripts(string_split(line, ' '), 1) - 1 as integer) as column_index, unnest(string_split(line, ' ')) as w from l)
 select document_id, row_index, count(*) as n_cells, cast(sum(length(trim(regexp_replace(w, '\\s+', ' ', 'g'))) * (column_index + 1)) as bigint) as weight from c group by 1, 2""",
)
def _(spark, sf):
    d = v.table(spark, sf, "documents")
    grids = d.select(F.col("doc_id").cast("string").alias("document_id"), F.lit("t").alias("table_id"), F.transform(F.split("text", "\n"), lambda x: F.split(x, " ")).alias("rows"))
    out = tb.explode_cells(grids)
    return out.groupBy("document_id", "row_index").agg(F.count(F.lit(1)).alias("n_cells"), F.sum(F.length("value_raw").cast("bigint") * (F.col("column_index") + 1)).alias("weight"))


@query(
    "d6_pivoted_grid",
    f"{PERIOD}, r as (select distinct document_id, table_id, row_index from cells), g as (select r.*, q.c from r, (select unnest(range(0, 29)) as c) q) select g.document_id, g.table_id, g.row_index, string_agg(coalesce(cast(k.cents as varchar), ''), ';' order by g.c) as shown from g left join cells k on k.document_id = g.document_id and k.table_id = g.table_id and k.row_index = g.row_index and k.column_index = g.c group by 1, 2, 3",
)
def _(spark, sf):
    cells = v.period_amounts(spark, sf).select("document_id", "table_id", "row_index", "column_index", F.col("cents").cast("string").alias("value_raw"))
    size = v.period_tables(spark, sf).select("document_id", "table_id", F.lit(4).alias("row_count"), F.lit(29).alias("column_count"))
    out = tb.pivot_grid(cells, size)
    return out.select("document_id", "table_id", "row_index", F.array_join("cells", ";").alias("shown"))


@query(
    "d7_chart_headers",
    f"""{ORDER} select cast(l_orderkey as varchar) as document_id, 1 as column_index, cast(cast(l_quantity as integer) as varchar) as header, (select count(*) - 1 from lineitem k where k.l_orderkey = olines.l_orderkey) as n_body from olines where row_index = 0""",
)
def _(spark, sf):
    cells = v.order_cells(spark, sf).where("column_index = 1")
    headers, body = tb.chart_grids(cells)
    n = body.groupBy("document_id").agg(F.count(F.lit(1)).alias("n_body"))
    return headers.join(n, "document_id", "left").select("document_id", "column_index", "header", F.coalesce("n_body", F.lit(0).cast("bigint")).alias("n_body"))


@query(
    "d8_melted_rows",
    f"""{ORDER} select cast(l_orderkey as varchar) as document_id, row_index, 'Item ' || l_partkey as item, cast(l_quantity as integer) || '' as raw_units, cast(l_quantity as bigint) * 100 as units, cast(round(l_extendedprice * 100) as bigint) as valor,
 cast(round(l_discount * 100) as bigint) * 100 as desconto, -cast(round(l_tax * 100) as bigint) as imposto from olines""",
)
def _(spark, sf):
    cells = v.order_cells(spark, sf)
    header = F.array(*[F.lit(h) for h in v.ORDER_HEADER])
    names = tb.header_cells(cells.select("document_id", "table_id").distinct().withColumn("schema", header))
    out = tb.melt_rows(cells, names)

    def m(name):
        return F.round(F.try_element_at("measures", F.lit(name)) * 100).cast("bigint")

    return out.select(
        "document_id", "row_index", F.try_element_at("attributes", F.lit("item")).alias("item"), F.try_element_at("attributes", F.lit("total_unidades__raw")).alias("raw_units"),
        m("total_unidades").alias("units"), m("valor").alias("valor"), m("desconto_percentual").alias("desconto"), m("imposto").alias("imposto"),
    )


def _event_tables(spark, sf):
    """Events of a user as a run of tables: purchases print a header, clicks a data row as one,
    the rest generic headers."""
    e = v.table(spark, sf, "events")
    named = F.array(F.lit("Indicador"), F.concat(F.lit("Trimestre "), F.col("event_id").cast("string")), F.lit("Variação"), F.lit("Nota"))
    data = F.array(F.lit("VGV"), F.lit("123456"), F.lit("77777"), (F.col("event_id") + 10000).cast("string"))
    generic = F.array(F.lit("0"), F.lit("column_2"), F.lit(""), F.lit("3"))
    return e.select(
        F.col("user_id").cast("string").alias("document_id"), F.col("event_id").cast("string").alias("table_id"), F.col("event_id").cast("int").alias("order_index"),
        F.lit("vendas").alias("title_canonical"), F.when(F.col("event_type") == "purchase", named).when(F.col("event_type") == "click", data).otherwise(generic).alias("header"), "event_type",
    )


@query(
    "d9_propagated_headers",
    """select cast(user_id as varchar) as document_id, cast(event_id as varchar) as table_id,
 case when event_type = 'purchase' then 'Trimestre ' || event_id when p is not null then 'Trimestre ' || p when event_type = 'click' then '123456' else 'column_2' end as second,
 event_type = 'click' and p is not null as header_was_row
 from (select *, max(case when event_type = 'purchase' then event_id end) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding) as p from events)""",
)
def _(spark, sf):
    out = tb.propagate_headers(_event_tables(spark, sf))
    return out.select("document_id", "table_id", F.col("header")[1].alias("second"), F.col("header_row").isNotNull().alias("header_was_row"))


def _fragments(spark, sf):
    """Each supplier's quarters as one-column-block fragments on consecutive pages: same header
    within a year, so a year is one table; a heading opens every other year."""
    c = v.period_amounts(spark, sf).where("table_id = 'vendas'")
    key = (F.col("column_index") - 1).cast("int")
    year = F.floor(key / 4).cast("int")
    cells = c.select(
        "document_id", F.col("column_index").cast("string").alias("table_id"), "row_index", F.explode(F.array(F.struct(F.lit(0).alias("i"), F.col("row_index").cast("string").alias("t")), F.struct(F.lit(1).alias("i"), F.col("cents").cast("string").alias("t")))).alias("_c")
    ).select("document_id", "table_id", "row_index", F.col("_c.i").alias("column_index"), F.col("_c.t").alias("value_raw"))
    # Rows are renumbered densely inside each fragment.


    w = Window.partitionBy("document_id", "table_id", "column_index").orderBy("row_index")
    cells = cells.withColumn("row_index", (F.row_number().over(w) - 1).cast("int"))
    tables = c.groupBy("document_id", "column_index").agg(F.count(F.lit(1)).alias("row_count")).select(
        "document_id", F.col("column_index").cast("string").alias("table_id"), (F.col("column_index") * 2).alias("order_index"), key.alias("page_number"), "row_count",
        F.array(F.lit("Linha"), F.concat(F.lit("Ano "), year.cast("string"))).alias("header"), F.lit(None).cast("array<string>").alias("first_row"),
        F.lit(None).cast("string").alias("section_id"), F.lit(None).cast("string").alias("section_slug"),
        F.lit(None).cast("struct<page_number:int,left:double,top:double,right:double,bottom:double,coord_origin:string>").alias("bbox"),
    )
    return tables, cells


@query(
    "d10_merged_fragments",
    """with q as (select distinct l_suppkey, (year(l_shipdate) - 1995) * 4 + quarter(l_shipdate) as c, l_returnflag as f from lineitem where l_linestatus = 'F'),
 r as (select l_suppkey, c, count(*) + 1 as n from q group by 1, 2), g as (select *, (c - 1) // 4 as y, lag(c) over (partition by l_suppkey order by c) as p from r),
 k as (select *, sum(case when p is null or c - p > 1 or (p - 1) // 4 <> y then 1 else 0 end) over (partition by l_suppkey order by c) as island from g)
 select cast(l_suppkey as varchar) as document_id, cast(min(c) as varchar) as table_id, count(*) as n_fragments, cast(sum(n) as bigint) as n_rows from k group by l_suppkey, island""",
)
def _(spark, sf):
    tables, cells = _fragments(spark, sf)
    plan = tb.merge_plan(tables, spark.createDataFrame([], "document_id string, order_index int, page_number int"))
    merged, moved = tb.merge_fragments(tables, cells, plan)
    n = moved.where("column_index = 0").groupBy("document_id", "table_id").agg(F.count_distinct("row_index").alias("n_rows"))
    return merged.join(n, ["document_id", "table_id"]).select("document_id", "table_id", "n_fragments", "n_rows")


@query(
    "d18_dimension_and_totals",
    f"{PERIOD}, t as (select document_id, table_id, count(distinct header) as n_periods from cells group by 1, 2) select document_id, table_id, 0 as dimension, 3 as total_row, cast(28 as bigint) as n_periods from t",
)
def _(spark, sf):
    cells, headers = v.period_cells(spark, sf), v.period_headers(spark, sf)
    dim = tb.dimension_column(cells, headers)
    n = tb.period_columns(headers).groupBy("document_id", "table_id").agg(F.count(F.lit(1)).alias("n_periods"))
    return dim.join(tb.total_row(cells, dim), tb.TABLE).join(n, tb.TABLE)


@query(
    "d24_inventory",
    f"""with {v.ITEMS_SQL}, s as (select document_id, min(order_index) as ord, c as label from (select *, {v.CLEAN.format(t='text')} as c from items) where c <> '' group by 1, 3),
 n as (select document_id, string_agg(label, '|' order by ord) as samples from (select * from s qualify row_number() over (partition by document_id order by ord) <= 5) group by 1)
 select 'blocks' as kind, document_id, 'blocks' as artifact, count(*) as n_records, 1 as first_page, any_value(coalesce(samples, '')) as samples from items left join n using (document_id) group by 2
 union all select 'table', cast(l_orderkey as varchar), 'itens', count(*), null, string_agg(distinct 'x', '') from lineitem group by 2""",
)
def _(spark, sf):
    blocks = v.items(spark, sf).select("document_id", F.lit("blocks").alias("artifact"), F.col("order_index").alias("ord"), F.col("text").alias("label"), "page_number")
    rows = v.order_cells(spark, sf).where("column_index = 0").select("document_id", F.col("table_id").alias("artifact"), F.col("row_index").alias("ord"), F.lit("x").alias("label"), F.lit(None).cast("int").alias("page_number"))
    out = tb.inventory({"blocks": blocks, "table": rows})
    return out.withColumn("samples", F.array_join("samples", "|"))


@query(
    "d25_grouped_sources",
    "select event_type as chart_id, event_id, cast(row_number() over (partition by event_type order by event_id) as bigint) as member from events",
)
def _(spark, sf):
    e = v.table(spark, sf, "events").select(F.col("event_type").alias("chart_id"), "event_id")
    return tb.grouped_sources(e, ["chart_id"], "event_id", chunk=1000)


@query(
    "d26_row_windows",
    "select cast(user_id as varchar) as document_id, cast(row_number() over (partition by user_id order by event_id) - 1 as integer) as row_index, 'completo' as mode, cast(0 as bigint) as window_start from events",
)
def _(spark, sf):
    w = Window.partitionBy("user_id").orderBy("event_id")
    e = v.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("document_id"), F.lit("t").alias("table_id"), (F.row_number().over(w) - 1).cast("int").alias("row_index"),
        F.array("event_type", F.col("event_id").cast("string")).alias("cells"),
    )
    return tb.row_windows(e).select("document_id", "row_index", "mode", "window_start")


@query(
    "d27_record_chunks",
    "select cast(user_id as varchar) as document_id, cast(r // 40 as integer) as chunk, count(*) as n from (select user_id, row_number() over (partition by user_id order by event_id) - 1 as r from events) group by 1, 2",
)
def _(spark, sf):
    e = v.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("document_id"), "event_id")


    numbered = ordinals(e, ["document_id"], "event_id", "rn").withColumn("ord", F.col("rn") - 1)
    return tb.chunk_records(numbered).groupBy("document_id", "chunk").agg(F.count(F.lit(1)).alias("n"))


@query(
    "d28_anchor_hits",
    """with l as (select cast(doc_id as varchar) as document_id, lang, unnest(string_split(text, chr(10))) as t, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line from documents),
 k as (select *, lower(trim(regexp_replace(regexp_replace(strip_accents(t), '[^\\x00-\\x7F]', '', 'g'), '\\s+', ' ', 'g'))) as x from l),
 a as (select doc_id, unnest(['élle', 'THE', lang || ' zz', 'Ment']) as anchor from documents),
 n as (select cast(doc_id as varchar) as document_id, anchor, lower(strip_accents(anchor)) as y from a)
 select n.document_id, anchor, cast(min(line) as integer) as line from n join k on k.document_id = n.document_id and contains(k.x, n.y) group by 1, 2""",
)
def _(spark, sf):
    d = v.table(spark, sf, "documents")
    anchors = d.select(
        F.col("doc_id").cast("string").alias("document_id"), F.posexplode(F.array(F.lit("élle"), F.lit("THE"), F.concat("lang", F.lit(" zz")), F.lit("Ment"))).alias("ord", "anchor")
    )
    lines = v.items(spark, sf).select("document_id", F.col("order_index").alias("line"), "text")
    return tb.anchor_hits(lines, anchors).select("document_id", "anchor", "line")


@query(
    "g7_table_structure",
    f"{PERIOD}, t as (select distinct document_id, table_id from cells) select document_id, table_id, 0 as label_column, '1T1995' as second, table_id = 'lancamentos' as first_row_is_header, true as header_read from t",
)
def _(spark, sf):
    cells, tables = structure_inputs(spark, sf)
    out = tb.table_structure(cells, tables)
    return out.select("document_id", "table_id", "label_column", F.col("header")[1].alias("second"), "first_row_is_header", "header_read")


def structure_inputs(spark, sf):
    """One table of each supplier prints its header, the other hides it in its first row."""
    cells, tables = v.period_cells(spark, sf), v.period_tables(spark, sf)
    hidden = F.col("table_id") == "lancamentos"
    moved = cells.withColumn("row_index", F.when(hidden, F.col("row_index") + 1).otherwise(F.col("row_index")))
    first = tables.where(hidden).select("document_id", "table_id", F.lit(0).alias("row_index"), F.posexplode("header").alias("column_index", "value_raw"))
    generic = F.transform("header", lambda h, i: F.concat(F.lit("column_"), (i + 1).cast("string")))
    return moved.unionByName(first), tables.withColumn("header", F.when(hidden, generic).otherwise(F.col("header")))


@query(
    "g7_segments",
    """with r as (select user_id, event_type, cast(row_number() over (partition by user_id order by event_id) - 1 as integer) as i from events), t as (select user_id, i, lead(i) over (partition by user_id order by i) as nx from r where event_type = 'signup'), m as (select user_id, max(i) as last from r group by 1)
 select cast(t.user_id as varchar) as document_id, 'Bloco ' || i as title, i + 1 as first_row, coalesce(nx - 1, last) as last_row from t join m on m.user_id = t.user_id where coalesce(nx - 1, last) >= i + 1""",
)
def _(spark, sf):


    e = v.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("document_id"), F.lit("t").alias("table_id"), "event_id", "event_type")
    rows = ordinals(e, ["document_id", "table_id"], "event_id", "rn").withColumn("row_index", (F.col("rn") - 1).cast("int"))
    title = F.col("event_type") == "signup"
    labels = rows.select("document_id", "table_id", "row_index", F.concat(F.lit("Bloco "), F.col("row_index").cast("string")).alias("label"), F.when(title, 0).otherwise(2).alias("n_filled"), F.when(title, 0).otherwise(1).alias("n_numeric"))
    return tb.segments(labels).select("document_id", "title", "first_row", "last_row")
