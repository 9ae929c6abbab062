"""The driver's tables seen as evidence, in Spark and (for checking) in SQL.

* orders are runs, customers their entities; events are scores and call marks;
* the lines of ``documents`` are document items and blocks;
* ``lineitem`` gives two kinds of tables: one per order with a row per line, and two per
  supplier with a row per indicator and a column per quarter, numbers rendered as pt-BR text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from provatab.cluster import checkpointed, dealt

FIRST_YEAR, LAST_YEAR = 1995, 2001


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Input for heavy per-row work: dealt out to all cores when it comes in fewer splits than
    there are, as one small file does. A large table has more splits and is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def ptbr(cents: Column) -> Column:
    """Whole cents as pt-BR text: ``1.234.567,89``."""
    return F.translate(F.format_number(cents.cast("decimal(28,0)") / F.lit(100).cast("decimal(4,0)"), 2), ",.", ".,")


def cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("long")


# --- runs -------------------------------------------------------------------------------------


def runs(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderpriority").alias("domain"),
        F.col("o_custkey").cast("string").alias("entity"),
        F.col("o_orderkey").cast("string").alias("document_id"),
        F.concat(F.lit("run__"), F.col("o_orderkey").cast("string")).alias("execution_id"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_orderstatus").alias("run_status"),
        F.col("o_totalprice").alias("price"),
    )


RUNS_SQL = """runs as (select o_orderpriority as domain, cast(o_custkey as varchar) as entity, cast(o_orderkey as varchar) as document_id,
 'run__' || o_orderkey as execution_id, o_orderkey as seq, o_orderdate as ts, o_orderstatus as run_status, o_totalprice as price from orders)"""


# --- document items ---------------------------------------------------------------------------


def items(spark: SparkSession, sf: str) -> DataFrame:
    d = spread(table(spark, sf, "documents").select("doc_id", "text", "source"))
    lines = d.select(F.col("doc_id").cast("string").alias("document_id"), "source", F.posexplode(F.split("text", "\n")).alias("order_index", "text"))
    n, p = F.length("text"), F.col("order_index")
    left = ((n % 3) * 100).cast("double")
    top = (700 - (p % 6) * 100).cast("double")
    return lines.select(
        "document_id", "order_index", "text", "source",
        F.when(p % 7 == 0, "section_header").when(p % 5 == 3, "list_item").otherwise("text").alias("label"),
        (n % 5).alias("level"),
        (F.floor(p / 6) + 1).cast("int").alias("page_number"),
        F.when(
            n % 11 != 0,
            F.struct(
                (F.floor(p / 6) + 1).cast("int").alias("page_number"), left.alias("left"), top.alias("top"),
                (left + 150 + n % 50).alias("right"), (top - 20).alias("bottom"), F.lit("BOTTOMLEFT").alias("coord_origin"),
            ),
        ).alias("bbox"),
        F.concat(F.lit("#/"), p.cast("string")).alias("self_ref"),
        F.when(p % 11 == 5, F.concat(F.lit("#/"), (p - 1).cast("string"))).alias("parent_ref"),
        F.when(p % 13 == 0, F.array(F.concat(F.lit("#/"), (p + 2).cast("string")))).otherwise(F.expr("cast(array() as array<string>)")).alias("child_refs"),
    )


ITEMS_SQL = """lines as (select cast(doc_id as varchar) as document_id, source, unnest(string_split(text, chr(10))) as text,
 cast(generate_subscripts(string_split(text, chr(10)), 1) - 1 as integer) as order_index from documents),
items as (select document_id, order_index, text, source,
 case when order_index % 7 = 0 then 'section_header' when order_index % 5 = 3 then 'list_item' else 'text' end as label,
 cast(length(text) % 5 as integer) as level, cast(order_index // 6 + 1 as integer) as page_number,
 length(text) % 11 <> 0 as has_box, cast((length(text) % 3) * 100 as double) as b_left, cast(700 - (order_index % 6) * 100 as double) as b_top,
 cast((length(text) % 3) * 100 + 150 + length(text) % 50 as double) as b_right, cast(700 - (order_index % 6) * 100 - 20 as double) as b_bottom,
 '#/' || order_index as self_ref, case when order_index % 11 = 5 then '#/' || (order_index - 1) end as parent_ref,
 case when order_index % 13 = 0 then '#/' || (order_index + 2) end as child_ref from lines)"""

_TITLE_PREFIXES = ["comparativo", "resumo", "lancamentos", "lançamentos", "indicadores", "overview", "summary", "analysis", "appendix", "section"]
CLEAN = "trim(regexp_replace({t}, '\\s+', ' ', 'g'))"
# Title rule in plain SQL: label, prefix, or upper/title case in at most 14 words.
ROLES_SQL = (
    """clean as (select *, """ + CLEAN.format(t="text") + """ as c from items),
titled as (select *, c <> '' and (label = 'section_header' or (length(c) <= 140 and (""" + " or ".join(f"lower(c) like '{p}%'" for p in _TITLE_PREFIXES) + """))
 or (length(c) <= 120 and len(string_split(c, ' ')) <= 14 and regexp_matches(c, '[\\p{Lu}\\p{Ll}]')
     and (upper(c) = c or not regexp_matches(c, '(^|[^\\p{Lu}\\p{Ll}\\p{Lt}])\\p{Ll}|[\\p{Lu}\\p{Ll}\\p{Lt}]\\p{Lu}')))) as is_title from clean),
roled as (select *, case when c = '' then 'empty' when is_title then 'title'
 when lower(c) like 'nota%' or lower(c) like 'observacao%' or lower(c) like 'observação%' then 'note'
 when label = 'list_item' then 'list_item'
 when instr(c, ':') between 2 and 81 and trim(substr(c, instr(c, ':') + 1)) = '' then 'field_label'
 when instr(c, ':') between 2 and 81 then 'field'
 when instr(c, ':') > 0 and substr(c, instr(c, ':') + 1) <> '' and length(c) > 160 then 'narrative'
 when length(c) > 200 then 'narrative' else 'paragraph' end as role from titled)"""
)


# --- tables per order -------------------------------------------------------------------------


def order_cells(spark: SparkSession, sf: str) -> DataFrame:
    """One table per order, one row per line: label, quantity, value, discount, tax as text."""
    l = table(spark, sf, "lineitem")
    # An order has a handful of lines; this only numbers the rows of the stand-in table.
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    row = F.row_number().over(w) - 1
    texts = F.array(
        F.concat(F.lit("Item "), F.col("l_partkey").cast("string")),
        F.col("l_quantity").cast("int").cast("string"),
        F.concat(F.lit("R$ "), ptbr(cents(F.col("l_extendedprice")))),
        F.concat(cents(F.col("l_discount")).cast("string"), F.lit("%")),
        F.concat(F.lit("("), F.translate(F.format_number(F.col("l_tax").cast("decimal(8,2)"), 2), ".", ","), F.lit(")")),
    )
    return (
        l.withColumn("row_index", row.cast("int"))
        .select(F.col("l_orderkey").cast("string").alias("document_id"), F.lit("itens").alias("table_id"), "row_index", F.posexplode(texts).alias("column_index", "value_raw"))
    )


ORDER_HEADER = ("Item", "Total unidades", "Valor", "Desconto percentual", "Imposto")
ORDER_ROWS_SQL = """olines as (select *, cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) - 1 as integer) as row_index from lineitem)"""


# --- tables per supplier ----------------------------------------------------------------------

LABELS = {"A": "Vendas Contratadas Brutas", "N": "Vendas Líquidas 100%", "R": "Número de Unidades"}
TOTAL = "Total"
TABLES = {"F": "vendas", "O": "lancamentos"}


def period_amounts(spark: SparkSession, sf: str) -> DataFrame:
    """Cents per (supplier, status, flag or total, quarter): partial sums before one shuffle."""
    l = table(spark, sf, "lineitem")
    base = l.select(
        F.col("l_suppkey").cast("string").alias("document_id"), "l_linestatus", "l_returnflag",
        ((F.year("l_shipdate") - FIRST_YEAR) * 4 + F.quarter("l_shipdate")).cast("int").alias("column_index"),
        cents(F.col("l_extendedprice")).alias("c"),
    )
    by_flag = base.groupBy("document_id", "l_linestatus", "l_returnflag", "column_index").agg(F.sum("c").alias("cents"))
    total = by_flag.groupBy("document_id", "l_linestatus", F.lit("T").alias("l_returnflag"), "column_index").agg(F.sum("cents").alias("cents"))
    row = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).when(F.col("l_returnflag") == "R", 2).otherwise(3)
    name = F.when(F.col("l_linestatus") == "F", "vendas").otherwise("lancamentos")
    return by_flag.unionByName(total).select("document_id", name.alias("table_id"), row.alias("row_index"), "column_index", "cents")


def period_cells(spark: SparkSession, sf: str) -> DataFrame:
    # A cell stands for thousands of lines and is read several times: added up once.
    amounts = checkpointed(period_amounts(spark, sf))
    label = F.when(F.col("row_index") == 0, LABELS["A"]).when(F.col("row_index") == 1, LABELS["N"]).when(F.col("row_index") == 2, LABELS["R"]).otherwise(TOTAL)
    labels = amounts.select("document_id", "table_id", "row_index").distinct().select(
        "document_id", "table_id", "row_index", F.lit(0).alias("column_index"), label.alias("value_raw")
    )
    return amounts.select("document_id", "table_id", "row_index", "column_index", ptbr(F.col("cents")).alias("value_raw")).unionByName(labels)


def quarter_labels() -> list[str]:
    return [f"{q}T{y}" for y in range(FIRST_YEAR, LAST_YEAR + 1) for q in range(1, 5)]


def period_tables(spark: SparkSession, sf: str) -> DataFrame:
    header = F.array(F.lit("Indicador"), *[F.lit(q) for q in quarter_labels()])
    docs = table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("document_id"), "l_linestatus").distinct()
    docs = dealt(docs, len(quarter_labels()) + 1)
    name = F.when(F.col("l_linestatus") == "F", "vendas").otherwise("lancamentos")
    return docs.select("document_id", name.alias("table_id"), F.initcap(name).alias("name"), header.alias("header"))


def period_headers(spark: SparkSession, sf: str) -> DataFrame:
    return period_tables(spark, sf).select("document_id", "table_id", F.posexplode("header").alias("column_index", "header")).withColumn("column_name", F.lower("header"))


PERIOD_SQL = """amounts as (select cast(l_suppkey as varchar) as document_id, case when l_linestatus = 'F' then 'vendas' else 'lancamentos' end as table_id,
 case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as row_index,
 cast((year(l_shipdate) - 1995) * 4 + quarter(l_shipdate) as integer) as column_index,
 cast(sum(cast(round(l_extendedprice * 100) as bigint)) as bigint) as cents from lineitem group by 1, 2, 3, 4),
amounts4 as (select * from amounts union all select document_id, table_id, 3, column_index, cast(sum(cents) as bigint) from amounts group by 1, 2, 4),
cells as (select *, ((column_index - 1) % 4 + 1) || 'T' || (1995 + (column_index - 1) // 4) as header,
 1995 + (column_index - 1) // 4 as yr, (column_index - 1) % 4 + 1 as qr from amounts4)"""
