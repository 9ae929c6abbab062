"""Keys, artefact groups, upserts, routed sinks and audits."""

import tempfile
import uuid

from pyspark.sql import functions as F

from provatab.plans import views as v
from provatab.plans.registry import query
from provatab.sources import readers, schemas, writers


def _shared_folder(spark) -> str:
    """A new folder under the one the cluster names; a local one only in local sessions."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    return tempfile.mkdtemp(prefix="spark-")


@query(
    "s1_json_artifacts",
    """select case when page_id % 10 > 4 then page_id end as page_id, case when page_id % 10 > 4 then url end as url, case when page_id % 10 > 4 then html end as html,
 case page_id % 10 when 0 then 'not_object' when 1 then 'not_json' when 2 then 'not_json' when 3 then 'not_json' when 4 then 'not_object' end as problem from pages""",
)
def _(spark, sf):
    folder = _shared_folder(spark) + "/pages"
    own = F.to_json(F.struct("page_id", "url", "html"))
    # A file per page: whole objects, and by the id a list, text behind the value, two values, an end that looks whole, a number.
    bad = {0: F.concat(F.lit("["), own, F.lit("]")), 1: F.concat(own, F.lit(" and more }")), 2: F.concat(own, F.lit("\n"), own), 3: F.concat(own, F.lit("] [7")), 4: F.lit(" 12 ")}
    value = F.concat(F.lit("\n\t"), own, F.lit(" \n"))
    for k, text in bad.items():
        value = F.when(F.col("page_id") % 10 == k, text).otherwise(value)
    v.spread(v.table(spark, sf, "pages")).select(value.alias("value")).write.option("maxRecordsPerFile", 1).text(folder)
    return readers.read_artifacts(spark, folder, "page_id bigint, url string, html string").drop("source_key")


@query(
    "s2_jsonl_scan",
    """select case when event_type <> 'error' and event_id % 7 <> 0 then event_id end as event_id, case when event_type <> 'error' and event_id % 7 <> 0 then event_type end as event_type,
 case when event_type <> 'error' and event_id % 7 <> 0 and event_id % 5 <> 1 then cast(event_id % 100 as bigint) end as size,
 case when event_type = 'error' and value > 10 then 'not_object' when event_type = 'error' or event_id % 7 = 0 then 'not_json' end as problem from events""",
)
def _(spark, sf):
    folder = _shared_folder(spark) + "/events"
    e = v.table(spark, sf, "events")
    # Objects behind a tab, with a number as text, and with a field that isn't a number: all valid lines. Every seventh holds two values or text behind one.
    size = F.when(F.col("event_id") % 5 == 1, F.lit('"many"')).when(F.col("event_id") % 5 == 2, F.concat(F.lit('"'), (F.col("event_id") % 100).cast("string"), F.lit('"'))).otherwise((F.col("event_id") % 100).cast("string"))
    valid = F.concat(F.when(F.col("event_id") % 3 == 0, F.lit("\t")).otherwise(F.lit("")), F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "event_type": "'), "event_type", F.lit('", "size": '), size, F.lit("}"))
    two = F.when(F.col("event_id") % 2 == 0, F.concat(valid, valid)).otherwise(F.concat(valid, F.lit(" junk }")))
    line = F.when(F.col("event_type") == "error", F.when(F.col("value") > 10, "[1, 2]").otherwise('{"event_id": broken')).when(F.col("event_id") % 7 == 0, two).otherwise(valid)
    e.select(F.explode(F.array(line, F.lit(" "))).alias("value")).write.text(folder)
    return readers.read_jsonl(spark, folder, "event_id bigint, event_type string, size bigint", problems=True).drop("source_key")


@query(
    "s3_strict_lists",
    """select case when conv_id % 5 > 1 then conv_id end as conv_id, case when conv_id % 5 > 1 then turn end as turn, case when conv_id % 5 > 1 then text end as text, cast(null as varchar) as problem from conversations where conv_id % 5 > 1
 union all select null, null, null, case conv_id % 5 when 0 then 'not_list' else 'not_json' end from (select distinct conv_id from conversations where conv_id % 5 < 2)
 union all select null, null, null, 'not_object' from (select distinct conv_id from conversations where conv_id % 5 > 1)""",
)
def _(spark, sf):
    folder = _shared_folder(spark) + "/lists"
    # A file per conversation (its turns are one artefact), with a stray number in its list; some hold an object, some text behind the list.
    rows = v.table(spark, sf, "conversations").groupBy("conv_id").agg(F.to_json(F.collect_list(F.struct("conv_id", "turn", "text"))).alias("all"))
    listed = F.concat(F.lit("[7, "), F.expr("substring(all, 2)"))
    value = F.when(F.col("conv_id") % 5 == 0, F.concat(F.lit('{"all": '), "all", F.lit("}"))).when(F.col("conv_id") % 5 == 1, F.concat(listed, F.lit(" tail ]"))).otherwise(listed)
    rows.select(value.alias("value")).write.option("maxRecordsPerFile", 1).text(folder)
    return readers.read_artifacts(spark, folder, "conv_id bigint, turn bigint, text string", shape="list").drop("source_key")


_KEYS = """keys as (select 'fallback/' || o_orderpriority || '/e' || o_custkey || '/document_id=' || o_orderkey || '/execution_id=x' || (o_orderkey % 3) || '/' || f as object_key,
 o_orderpriority as domain, 'e' || o_custkey as entity, cast(o_orderkey as varchar) as document_id, 'x' || (o_orderkey % 3) as execution_id, f
 from orders, (values ('selecao/entrada_llm_selecao_artefatos_tentativa_1.json'), ('selecao/resposta_llm_selecao_artefatos_tentativa_1.json'), ('erro_llm_layout.json'), ('manifesto.json')) t(f))"""


def _keys(spark, sf):
    names = ("selecao/entrada_llm_selecao_artefatos_tentativa_1.json", "selecao/resposta_llm_selecao_artefatos_tentativa_1.json", "erro_llm_layout.json", "manifesto.json")
    o = v.table(spark, sf, "orders").withColumn("name", F.explode(F.array(*[F.lit(n) for n in names])))
    return o.select(
        F.concat(
            F.lit("fallback/"), "o_orderpriority", F.lit("/e"), F.col("o_custkey").cast("string"), F.lit("/document_id="), F.col("o_orderkey").cast("string"),
            F.lit("/execution_id=x"), (F.col("o_orderkey") % 3).cast("string"), F.lit("/"), "name",
        ).alias("object_key")
    )


@query("s4_path_keys", f"with {_KEYS} select object_key, document_id, execution_id, domain as entity from keys")
def _(spark, sf):
    return readers.with_path_keys(_keys(spark, sf), marker="fallback")


@query(
    "s5_artifact_groups",
    f"with {_KEYS} select domain, entity, document_id, execution_id, count(*) as n_artifacts, min(object_key) as first_key, max(object_key) as last_key from keys group by 1, 2, 3, 4",
)
def _(spark, sf):
    return readers.group_artifacts(_keys(spark, sf))


@query(
    "s6_attempt_index",
    f"""with {_KEYS} select document_id, 'selecao_artefatos' as stage, 1 as attempt, max(case when f like '%entrada%' then object_key end) as entrada_llm, max(case when f like '%resposta%' then object_key end) as resposta_llm,
 null::varchar as erro_llm from keys where f like 'selecao/%' group by 1
 union all select document_id, 'layout', 0, null, null, object_key from keys where f like 'erro%'""",
)
def _(spark, sf):
    keyed = readers.with_path_keys(_keys(spark, sf))
    return readers.attempt_index(keyed, by=["document_id"])


@query("s7_promoted_rows", "select event_type, count(*) as n, cast(sum(event_id) as bigint) as ids from events group by 1")
def _(spark, sf):
    folder = _shared_folder(spark)
    v.table(spark, sf, "events").select("event_id", "event_type", "props").write.json(f"{folder}/raw")
    schema = "event_id bigint, event_type string, props string"
    writers.promote_to_parquet(spark, f"{folder}/raw", f"{folder}/stage", schema=schema, lines=True)
    out = spark.read.parquet(f"{folder}/stage")
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query(
    "s8_upsert",
    """with b as (select user_id, event_type, max_by(event_id, (ts, event_id)) as event_id from events where ts < timestamp '2024-01-16' group by 1, 2),
 n as (select user_id, event_type, max_by(event_id, (ts, event_id)) as event_id from events where ts >= timestamp '2024-01-16' group by 1, 2)
 select user_id, event_type, coalesce(n.event_id, b.event_id) as event_id from b full join n using (user_id, event_type)""",
)
def _(spark, sf):
    e = v.table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    keys, order = ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]
    empty = e.where("false")
    first = writers.upsert(empty, e.where(F.col("ts") < cut), keys, order)
    return writers.upsert(first, e.where(F.col("ts") >= cut), keys, order).drop("ts")


@query("s9_routed_sink", "select event_type as metric, cast(user_id as integer) as company, count(*) as n from events group by 1, 2")
def _(spark, sf):
    folder = _shared_folder(spark) + "/routed"
    e = v.table(spark, sf, "events").select(F.col("event_type").alias("metric"), F.col("user_id").alias("company"), "value")
    writers.write_routed(e, folder, ["metric"])
    out = spark.read.parquet(folder)
    return out.groupBy("metric", F.col("company").cast("int").alias("company")).agg(F.count(F.lit(1)).alias("n"))


@query("s10_flat_tables", "select o_orderkey, o_orderstatus, o_totalprice, c_mktsegment from orders left join customer on o_custkey = c_custkey")
def _(spark, sf):
    folder = _shared_folder(spark)
    o = v.table(spark, sf, "orders")
    flat = {
        "runs": o.select("o_orderkey", "o_orderstatus", "o_custkey"),
        "amounts": o.select("o_orderkey", "o_totalprice"),
        "holders": v.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"),
    }
    writers.write_tables(flat, folder)
    back = {name: spark.read.parquet(f"{folder}/{name}") for name in flat}
    return back["runs"].join(back["amounts"], "o_orderkey").join(back["holders"], "o_custkey", "left").drop("o_custkey")


@query(
    "s12_persisted_bundle",
    """select cast(c_custkey as varchar) as document_id, 'profiles' as collection, count(*) as record_count, count(*) as n_stored from customer group by 1
 union all select cast(o_custkey as varchar), 'orders', count(*), count(*) from orders group by 1""",
)
def _(spark, sf):
    folder = _shared_folder(spark)
    bundle = {
        "profiles": v.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("document_id"), "c_name"),
        "orders": v.table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("document_id"), "o_orderkey", "o_totalprice"),
    }
    writers.persist_bundle(bundle, folder)
    stored = [spark.read.parquet(f"{folder}/{n}").groupBy("document_id").agg(F.count(F.lit(1)).alias("n_stored")).withColumn("collection", F.lit(n)) for n in bundle]
    stats = spark.read.parquet(f"{folder}/collection_stats").drop("fields")
    return stats.join(stored[0].unionByName(stored[1]), ["document_id", "collection"])


@query(
    "s11_published_runs",
    """select o_orderstatus as entity, case when o_orderkey % 2 = 0 then 'x' else 'y' end as execution_id, cast(sum(o_orderkey) as bigint) as sum_validation,
 cast(sum(case when o_orderkey % 2 = 1 or o_orderkey % 3 = 0 then o_orderkey end) as bigint) as sum_resolved, cast(sum(case when o_orderkey % 2 = 1 then o_orderkey end) as bigint) as sum_audit from orders group by 1, 2""",
)
def _(spark, sf):
    folder = _shared_folder(spark)
    r = v.runs(spark, sf).select(
        F.col("run_status").alias("entity"), F.date_format("ts", "yyyy").alias("document_id"), F.when(F.col("seq") % 2 == 0, "x").otherwise("y").alias("execution_id"), "seq", "price",
    )
    # Each run is published by itself, and one of them again: with fewer rows, and without any audit.
    for run in ("x", "y", "x again"):
        own = r.where(F.col("execution_id") == run[0])
        again = run.endswith("again")
        writers.publish_run(own.drop("price"), own.where("seq % 3 = 0") if again else own, own.drop("price").where(F.lit(not again)), folder)
    keys = ["entity", "execution_id"]
    sums = [writers.published(spark, folder, t).groupBy(*keys).agg(F.sum("seq").alias(f"sum_{t}")) for t in ("validation", "resolved", "audit")]
    return sums[0].join(sums[1], keys, "left").join(sums[2], keys, "left")


@query(
    "s12_collection_stats",
    """select cast(l_orderkey as varchar) as document_id, 'rows' as collection, count(*) as record_count, 'document_id,l_linenumber' as fields from lineitem group by 1
 union all select cast(o_orderkey as varchar), 'runs', count(*), 'document_id,seq' from orders group by 1""",
)
def _(spark, sf):
    rows = v.table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("document_id"), "l_linenumber")
    return writers.collection_stats({"rows": rows, "runs": v.runs(spark, sf).select("document_id", "seq")})


_URI_KINDS = {"tables": "/tables/", "charts": "/charts/", "blocks": "/blocks/", "text_candidates": "/text_candidates/"}


def manifests_with_uris(spark, sf):
    """Manifest per order: its URIs name a table per line and a few text artefacts."""
    o, l = v.table(spark, sf, "orders"), v.table(spark, sf, "lineitem")
    n = l.groupBy("l_orderkey").agg(F.count(F.lit(1)).cast("int").alias("n"))
    joined = o.join(n, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("n", F.coalesce("n", F.lit(0)))
    tables = F.when(F.col("n") > 0, F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: F.concat(F.lit("s3/x/tables/t"), i.cast("string")))).otherwise(
        F.expr("cast(array() as array<string>)")
    )
    text = F.when(F.col("o_orderstatus") == "F", F.array(F.lit("s3/x/blocks/b"), F.lit("s3/x/text_candidates/c"))).otherwise(F.array(F.lit("s3/x/outro")))
    return joined.select(F.col("o_orderkey").cast("string").alias("document_id"), F.concat(tables, text).alias("artifact_uris"))


MANIFEST_SQL = """uris as (select cast(o_orderkey as varchar) as document_id, kind from (
 select l_orderkey as o_orderkey, 'tables' as kind from lineitem where l_orderkey in (select o_orderkey from orders)
 union all select o_orderkey, unnest(case when o_orderstatus = 'F' then ['blocks', 'text_candidates'] else [null] end) from orders))"""


@query("s13_artifact_uris", f"with {MANIFEST_SQL} select document_id, kind, count(*) as n from uris group by 1, 2")
def _(spark, sf):
    out = readers.artifact_uris(manifests_with_uris(spark, sf), _URI_KINDS)
    return out.groupBy("document_id", "kind").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s14_key_audit",
    """select 'lineitem' as "table", 'unique' as rule, 'l_orderkey,l_linenumber' as columns, l_orderkey || '|' || l_linenumber as key, count(*) as n from lineitem group by l_orderkey, l_linenumber having count(*) > 1
 union all select 'events', 'reference', 'user_id', cast(user_id as varchar), count(*) from events where user_id not in (select s_suppkey from supplier) group by user_id""",
)
def _(spark, sf):
    tables = {n: v.table(spark, sf, n) for n in ("lineitem", "events", "supplier")}
    return schemas.audit_keys(
        tables, unique={"lineitem": [["l_orderkey", "l_linenumber"]], "supplier": [["s_suppkey"]]}, foreign={"events": {"user_id": ("supplier", "s_suppkey")}}
    )


@query("s15_bronze_rows", "select l_orderkey, count(*) as n from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus = 'F' group by 1")
def _(spark, sf):
    l = v.table(spark, sf, "lineitem")
    checks = v.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.when(F.col("o_orderstatus") == "F", "compativel").otherwise("incompativel").alias("validation_status")
    )
    return writers.bronze_rows(l, checks, ["l_orderkey"]).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
