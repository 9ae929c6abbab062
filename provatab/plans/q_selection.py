"""Orders as runs: pending sets, duplicates, latest-per-key, versions, batches."""

from pyspark.sql import functions as F

from provatab.functions.periods import disclosure_window
from provatab.operators import selection as sel
from provatab.plans import views as v
from provatab.plans.registry import query

RUNS = f"with {v.RUNS_SQL}"


@query("p1_pending_documents", f"{RUNS} select domain, entity, document_id from runs where run_status <> 'F'")
def _(spark, sf):
    r = v.runs(spark, sf)
    return sel.pending(r, r.where("run_status = 'F'"), ["document_id"]).select("domain", "entity", "document_id")


@query(
    "p1_unknown_requests",
    "select cast(l_suppkey * 1000 as varchar) as document_id from lineitem group by 1 having count(*) filter (where l_suppkey * 1000 in (select o_orderkey from orders)) = 0",
)
def _(spark, sf):
    asked = v.table(spark, sf, "lineitem").select((F.col("l_suppkey") * 1000).cast("string").alias("document_id"))
    return sel.unknown_requests(v.runs(spark, sf), asked, ["document_id"])


@query(
    "p2_content_identity",
    """select doc_id, sha256(text) as sha256, substr(sha256(text), 1, 32) as document_id,
 case when doc_id = min(doc_id) over (partition by text) then 'novo' else 'duplicado' end as status from documents""",
)
def _(spark, sf):
    d = v.table(spark, sf, "documents").select("doc_id", "text")
    return sel.flag_duplicates(d, F.col("text"), F.col("doc_id")).drop("text")


@query(
    "p3_keep_first",
    f"{RUNS} select entity, domain, document_id from runs qualify row_number() over (partition by entity, domain order by ts, seq) = 1",
)
def _(spark, sf):
    r = v.runs(spark, sf)
    return sel.keep_first(r, ["entity", "domain"], [F.col("ts"), F.col("seq")]).select("entity", "domain", "document_id")


@query("p4_distinct_in_order", f"{RUNS} select entity, min(seq) as seq from runs group by entity")
def _(spark, sf):
    return sel.distinct_in_order(v.runs(spark, sf), "entity", "seq")


@query(
    "p5_latest_run",
    f"{RUNS} select domain, entity, document_id, execution_id from runs qualify row_number() over (partition by domain, entity order by ts desc, execution_id desc) = 1",
)
def _(spark, sf):
    r = v.runs(spark, sf)
    return sel.latest_per_key(r, ["domain", "entity"], [F.col("ts"), F.col("execution_id")]).select("domain", "entity", "document_id", "execution_id")


@query(
    "p6_latest_unresolved",
    f"""{RUNS} select * from (select domain, entity, document_id, run_status from runs
 qualify row_number() over (partition by domain, entity order by ts desc, execution_id desc) = 1) where run_status <> 'F'""",
)
def _(spark, sf):
    r = v.runs(spark, sf)
    done = r.where("run_status = 'F'")
    return sel.latest_unresolved(r, done, ["domain", "entity"], ["document_id"], [F.col("ts"), F.col("execution_id")]).select("domain", "entity", "document_id", "run_status")


@query(
    "p7_run_completeness",
    """select cast(o_orderkey as varchar) as document_id,
 o_orderstatus = 'F' and o_totalprice < 400000 and not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_linestatus = 'O' and l_returnflag = 'R') as complete
 from orders""",
)
def _(spark, sf):
    l = v.table(spark, sf, "lineitem")
    audits = l.select(
        F.col("l_orderkey").cast("string").alias("document_id"), (F.col("l_returnflag") == "R").alias("obrigatorio"),
        F.when(F.col("l_linestatus") == "F", "resolvido").otherwise("nao_resolvido").alias("status_resolucao"),
    )
    summaries = v.runs(spark, sf).select(
        "document_id", F.when(F.col("run_status") == "F", "compativel").otherwise("incompativel").alias("validation_status"),
        F.when(F.col("price") < 400000, 0).otherwise(1).alias("failed"),
    )
    return sel.run_completeness(audits, summaries, ["document_id"])


@query(
    "p8_latest_for_period",
    f"""{RUNS} select entity, document_id from runs where year(ts) = 1998
 qualify row_number() over (partition by entity order by ts desc, seq asc) = 1""",
)
def _(spark, sf):
    r = v.runs(spark, sf)
    return sel.latest_for_period(r, F.year("ts").cast("string"), "1998", ["entity"], "ts", "seq").select("entity", "document_id")


@query(
    "p9_latest_per_month",
    f"""{RUNS} select strftime(ts, '%Y-%m') as label, document_id from runs where month(ts) <> 12
 qualify row_number() over (partition by strftime(ts, '%Y-%m') order by price desc, seq asc) = 1""",
)
def _(spark, sf):
    r = v.runs(spark, sf)
    label = F.when(F.month("ts") == 12, F.date_format("ts", "yyyy/MM")).otherwise(F.date_format("ts", "yyyy-MM"))
    return sel.latest_per_month(r.withColumn("label", label), "label", "price", "seq").select("label", "document_id")


_VERSIONS = """vs as (select p_brand as domain, p_size % 4 as major, length(p_name) as minor, p_size as patch,
 'contratos/' || p_brand || '/v' || (p_size % 4) || '.' || length(p_name) || '.' || p_size || '/c.json' as k from part)"""


def _versions(spark, sf):
    p = v.table(spark, sf, "part")
    return p.select(
        F.col("p_brand").alias("domain"),
        F.concat(
            F.lit("contratos/"), "p_brand", F.lit("/v"), (F.col("p_size") % 4).cast("string"), F.lit("."), F.length("p_name").cast("string"), F.lit("."),
            F.col("p_size").cast("string"), F.lit("/c.json"),
        ).alias("object_key"),
    )


@query(
    "p10_highest_version",
    f"with {_VERSIONS} select distinct domain, k as object_key from vs qualify row_number() over (partition by domain order by major desc, minor desc, patch desc, k) = 1",
)
def _(spark, sf):
    return sel.highest_version(_versions(spark, sf).distinct(), ["domain"], "object_key").select("domain", "object_key")


@query(
    "p11_next_version",
    f"""with {_VERSIONS} select domain, 'v' || major || '.' || (minor + 1) || '.0' as next_version from vs
 qualify row_number() over (partition by domain order by major desc, minor desc, patch desc) = 1""",
)
def _(spark, sf):
    return sel.next_minor_version(_versions(spark, sf), ["domain"], "object_key")


@query(
    "p12_prefer_rerun",
    f"""{RUNS}, x as (select *, entity || '_' || seq || case when seq % 3 = 0 then '__r2' else '' end as run_id from runs)
 select entity, domain, run_id from x qualify not bool_or(run_id like '%\\_\\_r2' escape '\\') over (partition by entity, domain) or run_id like '%\\_\\_r2' escape '\\'""",
)
def _(spark, sf):
    r = v.runs(spark, sf).withColumn(
        "run_id", F.concat("entity", F.lit("_"), F.col("seq").cast("string"), F.when(F.col("seq") % 3 == 0, "__r2").otherwise(""))
    )
    return sel.prefer_rerun(r, ["entity", "domain"], "run_id").select("entity", "domain", "run_id")


@query(
    "p13_admitted_traces",
    "select event_id, event_type as name from events where event_type <> 'click' or value > 20",
)
def _(spark, sf):
    e = v.table(spark, sf, "events").select(
        "event_id", "event_type", F.when(F.col("event_type") == "click", "resolucao").otherwise(F.col("event_type")).alias("name"),
        F.when(F.col("value") > 20, "revalidacao_layout_candidato").alias("mode"),
    )
    return sel.admit_traces(e, "resolucao").select("event_id", F.col("event_type").alias("name"))


@query(
    "p14_disclosure_windows",
    f"""{RUNS}, w as (select *, case when month(ts) in (4, 5) then 1 when month(ts) in (7, 8) then 2 when month(ts) in (10, 11) then 3 when month(ts) in (2, 3) then 4 end as q from runs)
 select cast(case when q = 4 then year(ts) - 1 else year(ts) end as integer) as ano, q as trimestre, count(*) as n from w where q is not null group by 1, 2""",
)
def _(spark, sf):
    w = v.runs(spark, sf).withColumn("w", disclosure_window(F.col("ts"))).where("w is not null")
    return w.groupBy(F.col("w.ano").alias("ano"), F.col("w.trimestre").alias("trimestre")).agg(F.count(F.lit(1)).alias("n"))


def _window_docs(spark, sf):
    r = v.runs(spark, sf)
    shown = F.concat(F.lit("Prévia Operacional "), F.quarter("ts").cast("string"), F.lit("T"), F.date_format("ts", "yy"))
    return r.select(
        "document_id", "seq",
        F.when(F.col("seq") % 3 == 0, shown).otherwise("Relatório").alias("title"),
        F.when(F.col("seq") % 3 == 1, F.quarter("ts")).alias("quarter"), F.when(F.col("seq") % 3 == 1, F.year("ts")).alias("year"),
        F.when(F.col("seq") % 3 == 2, F.col("ts")).alias("reference"),
        F.when(F.col("seq") % 4 == 0, F.lit("http://x/doc.PDF")).otherwise(F.lit("http://x/page")).alias("url"),
        F.when(F.col("seq") % 5 == 0, "application/pdf").alias("mime"),
    )


@query("p15_documents_in_window", f"{RUNS} select document_id from runs where year(ts) = 1998 and quarter(ts) = 2")
def _(spark, sf):
    day = F.lit("1998-08-10").cast("date")
    return sel.in_window(_window_docs(spark, sf), day, text="title", quarter="quarter", year="year", reference="reference").select("document_id")


@query(
    "p16_candidate_documents",
    f"{RUNS} select document_id from runs where year(ts) = 1998 and quarter(ts) = 2 and seq % 3 = 0 and (seq % 4 = 0 or seq % 5 = 0)",
)
def _(spark, sf):
    day = F.lit("1998-08-10").cast("date")
    out = sel.candidate_documents(
        _window_docs(spark, sf), day, ["prévia operacional"], url="url", mime="mime", text="title", quarter="quarter", year="year", reference="reference"
    )
    return out.select("document_id")


@query(
    "p17_walk_json",
    """select event_id, '$' as path, event_type as tag from events
 union all select event_id, '$.a[0]', null from events union all select event_id, '$.a[1].b', null from events union all select event_id, '$.a[1]', null from events""",
)
def _(spark, sf):
    e = v.table(spark, sf, "events").select(
        "event_id",
        F.concat(F.lit('{"tag":"'), "event_type", F.lit('","a":['), "props", F.lit(',{"b":{"c":1}}]}')).alias("payload"),
    )
    out = sel.walk_json(e, "payload")
    return out.select("event_id", "path", F.get_json_object("object", "$.tag").alias("tag"))


@query("p18_runs_newest_first", f"{RUNS} select document_id, strftime(ts, '%Y-%m-%d') as day from runs where entity = '7'")
def _(spark, sf):
    out = sel.list_runs(v.runs(spark, sf), "ts", entity=F.col("entity") == "7")
    return out.select("document_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))


@query(
    "p19_versions_listed",
    f"""with {_VERSIONS} select domain, 'v' || major || '.' || minor || '.' || patch as version, cast(row_number() over (partition by domain order by major desc, minor desc, patch desc) as integer) as position
 from (select distinct domain, major, minor, patch from vs)""",
)
def _(spark, sf):
    return sel.list_versions(_versions(spark, sf), "domain", "object_key")


def _results(spark, sf):
    return v.runs(spark, sf).select(
        "domain", "entity", "document_id", (F.col("run_status") == "P").alias("layout_alterado"),
        F.when(F.col("price") > 300000, "revalidacao_layout_candidato").alias("modo_execucao"),
    )


@query(
    "p20_batch_summary",
    f"{RUNS} select domain, count(*) as processed_count, count(*) filter (where run_status = 'P') as layout_changed_count, count(*) filter (where run_status = 'P') > 0 as layout_alterado from runs group by domain",
)
def _(spark, sf):
    return sel.batch_summary(_results(spark, sf), ["domain"])


@query("p20_repair_requests", f"{RUNS} select domain, entity, document_id from runs where run_status = 'P' and price <= 300000")
def _(spark, sf):
    return sel.repair_requests(_results(spark, sf)).select("domain", "entity", "document_id")


@query(
    "p21_recover_batch",
    f"""{RUNS}
 select entity, document_id, not bool_or(seq % 4 = 0) over (partition by domain, entity) as missing_manifest from runs where seq % 2 = 0""",
)
def _(spark, sf):
    r = v.runs(spark, sf)
    run_id = F.concat(F.lit("dag_x__"), F.when(F.col("seq") % 2 == 0, F.concat(F.lit("rel__"), "domain", F.lit("__"), "entity")).otherwise("manual"))
    one = r.select("domain", "entity", "document_id", "execution_id", F.col("ts").alias("started"), F.concat(run_id, F.lit("")).alias("run_id"), "seq")
    again = one.withColumn("started", F.col("started") + F.expr("interval 1 day"))
    configs = one.select(F.col("document_id").alias("_d"), "run_id", F.when(F.col("seq") % 4 == 0, F.concat(F.lit("m/"), "document_id")).alias("manifest_key"))
    # Configs are per run id; runs of one entity share it here, so keep the best of them.
    per_run = configs.groupBy("run_id").agg(F.max("manifest_key").alias("manifest_key"))
    out = sel.recover_batch(one.unionByName(again), per_run, "rel")
    return out.select("entity", "document_id", "missing_manifest")


@query(
    "p22_lineage_edges",
    "select distinct cast(l_orderkey as varchar) as source, cast(l_suppkey as varchar) as target from lineitem where not exists (select 1 from lineitem k where k.l_returnflag = 'R' and k.l_orderkey = lineitem.l_orderkey and k.l_suppkey = lineitem.l_suppkey)",
)
def _(spark, sf):
    l = v.table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("source"), F.col("l_suppkey").cast("string").alias("target"), "l_returnflag")
    return sel.lineage_edges(l, l.where("l_returnflag = 'R'").distinct())


@query(
    "p23_newest_extraction",
    """select cast(c_custkey as varchar) as entity, max_by(o_orderkey, (o_orderdate, o_orderkey)) as newest from customer left join orders on o_custkey = c_custkey and o_orderstatus = 'F' group by 1""",
)
def _(spark, sf):
    files = v.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("entity"))
    done = v.runs(spark, sf).where("run_status = 'F'").select("entity", "ts", "seq")
    newest, missing = sel.newest_extraction(done, files, "entity", [F.col("ts"), F.col("seq")])
    return newest.select("entity", F.col("seq").alias("newest")).unionByName(missing.select("entity", F.lit(None).cast("bigint").alias("newest")))


@query(
    "p23_short_name_clashes",
    "select substr(c_name, 10, 7) as short, count(distinct c_custkey) as n from customer group by 1 having count(distinct c_custkey) > 1",
)
def _(spark, sf):
    c = v.table(spark, sf, "customer")
    return sel.short_name_clashes(c, "c_custkey", F.substring("c_name", 10, 7))


@query(
    "p24_normalized_identity",
    f"""{RUNS} select document_id, lower(domain) as domain, case when seq % 3 = 0 then 'ent ' || entity else entity end as entity,
 case when seq % 2 = 0 then '1T' || year(ts) else 'sem_periodo' end as period_label,
 cast(case when seq % 2 = 0 and year(ts) >= 2000 then year(ts) else 0 end as integer) as reference_year from runs""",
)
def _(spark, sf):
    r = v.runs(spark, sf)
    named = F.when(F.col("seq") % 3 == 0, F.concat(F.lit("  ENT "), "entity")).otherwise(" ")
    label = F.when(F.col("seq") % 2 == 0, F.concat(F.lit("1T"), F.year("ts").cast("string")))
    out = sel.normalize_identity(r, entity=[named, F.col("entity")], period=[label], domain=[F.lit(""), F.col("domain")])
    return out.select("document_id", "domain", "entity", "period_label", "reference_year")


@query(
    "p25_detection_summary",
    f"""{RUNS} select domain, count(*) as candidates_count, count(*) filter (where run_status = 'F') as downloaded_count, count(*) filter (where run_status = 'P') as duplicate_count,
 count(*) filter (where price > 200000) as queued_for_extraction_count, count(*) filter (where price > 350000) as extracted_count from runs group by domain""",
)
def _(spark, sf):
    d = v.runs(spark, sf).select(
        "domain", F.when(F.col("run_status") == "F", "novo").when(F.col("run_status") == "P", "duplicado").alias("status"),
        (F.col("price") > 200000).alias("queued"), F.when(F.col("price") > 350000, "concluida").alias("extraction_status"),
    )
    return sel.detection_summary(d, ["domain"])
