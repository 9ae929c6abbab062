"""Document lines as tables of two extractions, and their numbers."""

from pyspark.sql import functions as F

from provatab.operators import compare as cp
from provatab.plans import views as v
from provatab.plans.registry import query


def extractions(spark, sf):
    """The same lines cut into tables of six (old) and, in every second document, of four or of
    six with another title (new)."""
    items = v.items(spark, sf).where("text <> ''")
    doc, pos = F.col("document_id").cast("bigint"), F.col("order_index")
    old = items.select("document_id", F.format_string("t%05d", F.floor(pos / 6)).alias("table_id"), pos.alias("row_index"), F.array("text").alias("cells"))
    width = F.when(doc % 2 == 0, 4).otherwise(6)
    new = items.select("document_id", F.format_string("t%05d", F.floor(pos / width)).alias("table_id"), pos.alias("row_index"), F.array("text").alias("cells"))

    def tables(rows, title):
        return rows.select("document_id", "table_id").distinct().select("*", title.alias("title"), F.array(F.lit("linha")).alias("header"))

    return tables(old, F.lit("a")), tables(new, F.when(F.col("document_id").cast("bigint") % 3 == 0, "b").otherwise("a")), old, new


def _groups(spark, sf):
    old, new, old_rows, new_rows = extractions(spark, sf)
    return cp.pair_tables(old, new, old_rows, new_rows), old, new, old_rows, new_rows


@query("e27_paired_tables")
def _(spark, sf):
    """Checked against a union-find on small fixtures in the tests."""
    return _groups(spark, sf)[0]


@query("e28_classified_pairs")
def _(spark, sf):
    return cp.classify_pairs(*_groups(spark, sf))


@query("e29_partition_proof", "with l as (select doc_id, unnest(string_split(text, chr(10))) as t from documents) select cast(doc_id as varchar) as document_id, cast(0 as bigint) as lost, cast(0 as bigint) as invented from l where t <> '' group by 1")
def _(spark, sf):
    """The lines of a document are cut differently, never lost."""
    old, new, old_rows, new_rows = extractions(spark, sf)
    both = old.select("document_id", F.lit("old").alias("side"), "table_id").unionByName(new.select("document_id", F.lit("new").alias("side"), "table_id"))
    proof = cp.partition_proof(both.withColumn("group", F.lit("all")), old, new, old_rows, new_rows)
    return proof.select("document_id", "lost", "invented")


@query("e30_change_summary")
def _(spark, sf):
    return cp.change_summary(cp.classify_pairs(*_groups(spark, sf)))


def _pages(spark, sf):
    """Orders as pages of customers' reports: the page prints every line's value, the tables hold
    those of flag A, the text those of flag N, charts the rest of status F."""
    l, o = v.table(spark, sf, "lineitem"), v.table(spark, sf, "orders")
    j = l.join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    shown = F.regexp_replace(v.ptbr(v.cents(F.col("l_extendedprice"))), "^([0-9]{3}),", "0.$1,")
    rows = j.select(F.col("o_custkey").cast("string").alias("document_id"), (F.col("o_orderkey") % 20 + 1).cast("int").alias("page"), F.concat(F.lit("valor "), shown, F.lit(" no período")).alias("text"), shown.alias("value"), "l_returnflag", "l_linestatus")
    return rows


_PAGES = """p as (select cast(o_custkey as varchar) as document_id, cast(o_orderkey % 20 + 1 as integer) as page, cast(round(l_extendedprice * 100) as bigint) as token, l_returnflag as f, l_linestatus as s from lineitem join orders on o_orderkey = l_orderkey),
u as (select distinct document_id, page, token from p), t as (select distinct document_id, unnest([page, page + 1, page + 2, page + 3]) as page, token from p where f = 'A'), x as (select distinct document_id, page, token from p where f = 'N'), g as (select distinct document_id, page, token from p where f = 'R' and s = 'F'),
a as (select distinct document_id, token from p where f <> 'R' or s = 'F'),
cov as (select u.*, case when t.token is not null then 'tabela' when x.token is not null then 'texto' when g.token is not null then 'grafico' when a.token is not null then 'outra pagina' else 'ausente' end as place from u
 left join t using (document_id, page, token) left join x using (document_id, page, token) left join g using (document_id, page, token) left join a using (document_id, token))"""


def _coverage(spark, sf):
    rows = _pages(spark, sf)
    flag = F.col("l_returnflag")
    return cp.numeric_coverage(rows, rows.where(flag == "A"), rows.where(flag == "N"), rows.where((flag == "R") & (F.col("l_linestatus") == "F")))


@query("e31_numeric_coverage", f"with {_PAGES} select document_id, page, place, count(*) as n from cov group by 1, 2, 3")
def _(spark, sf):
    return _coverage(spark, sf).groupBy("document_id", "page", "place").agg(F.count(F.lit(1)).alias("n"))


@query("e32_flagged_pages", f"with {_PAGES} select document_id, page, count(*) as total, count(*) filter (where place = 'ausente') as ausente, count(*) >= 15 and count(*) filter (where place <> 'tabela') >= 10 as flagged from cov group by 1, 2")
def _(spark, sf):
    return cp.flag_pages(_coverage(spark, sf)).select("document_id", "page", "total", "ausente", "flagged")
