"""Orders with nested lines as resolved rows to publish."""

from pyspark.sql import functions as F

from provatab.cluster import clustered
from provatab.operators import publish as pb
from provatab.plans import views as v
from provatab.plans.registry import query


def _bulletins(spark, sf):
    """A bulletin per order: each list of it holds the lines of the order."""
    l = v.table(spark, sf, "lineitem")
    # The lines of one order, a handful. They stay where their order is for all that is grouped by it later.
    lines = clustered(l.withColumn("document_id", F.col("l_orderkey").cast("string")), "document_id").groupBy("document_id").agg(F.collect_list(F.struct("l_shipdate", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus")).alias("x"))

    def items(**fields):
        return F.transform("x", lambda r: F.struct(*[f(r).alias(n) for n, f in fields.items()]))

    year, month = (lambda r: F.year(r["l_shipdate"])), (lambda r: F.month(r["l_shipdate"]))
    q, p = (lambda r: r["l_quantity"]), (lambda r: r["l_extendedprice"])
    return lines.select(
        F.lit("2026-01").alias("competencia_referencia"), "document_id", F.lit("e").alias("execution_id"), F.lit("k").alias("source_object_key"),
        F.struct(
            items(ano=year, mes=month, unidades_financiadas=q, volume_financiado_milhoes=p).alias("serie_mensal_sbpe"), items(ano=year, unidades_financiadas=q, volume_financiado_milhoes=p).alias("serie_historica_anual"),
            items(modalidade=lambda r: r["l_returnflag"], instituicao_financeira=lambda r: r["l_linestatus"], volume_mensal_milhoes=p, unidades_mensais=q, volume_acumulado_ano_milhoes=p, unidades_acumuladas_ano=q).alias("por_modalidade_e_instituicao"),
        ).alias("financiamentos_imobiliarios"),
        F.struct(items(ano=year, mes=month, saldo_milhoes=p).alias("saldos_mensais"), items(ano=year, mes=month, captacao_liquida_milhoes=q).alias("captacoes_liquidas_mensais")).alias("poupanca_sbpe"),
        F.struct(
            items(periodo=lambda r: F.struct(r["l_returnflag"].alias("rotulo_publicado"), r["l_linestatus"].alias("tipo_periodo")), volume_financiado_bilhoes=p, unidades_financiadas_mil=q).alias("observacoes")
        ).alias("recursos_livres"),
    )


@query(
    "x1_bulletin_tables",
    f"""select cast(l_orderkey as varchar) as document_id, t as "table", count(*) as n from lineitem, (select unnest({list(pb.BULLETIN)!r}) as t) group by 1, 2""",
)
def _(spark, sf):
    tables = pb.bulletin_tables(_bulletins(spark, sf))
    out = None
    for name, rows in tables.items():
        part = rows.groupBy("document_id").agg(F.count(F.lit(1)).alias("n")).select("document_id", F.lit(name).alias("table"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "x1_free_resources",
    "select l_returnflag as periodo_rotulo, l_linestatus as tipo_periodo, cast(sum(cast(l_quantity as bigint)) as bigint) as unidades, count(*) as n from lineitem group by 1, 2",
)
def _(spark, sf):
    rows = pb.bulletin_tables(_bulletins(spark, sf))["recursos_livres"]
    return rows.groupBy("periodo_rotulo", "tipo_periodo").agg(F.sum(F.col("unidades_financiadas_mil").cast("bigint")).alias("unidades"), F.count(F.lit(1)).alias("n"))


@query(
    "x2_metric_rows",
    """select metric as metric_name, cast(l_orderkey as varchar) as document_id, quarter(l_shipdate) || 'T' || strftime(l_shipdate, '%y') as periodo_valor, cast(sum(cast(l_quantity as bigint)) as bigint) as valor, count(*) as n
 from lineitem, (select unnest(['lancamentos', 'vendas']) as metric) where (metric = 'vendas') = (l_linestatus = 'F') and l_returnflag <> 'R' group by 1, 2, 3""",
)
def _(spark, sf):
    l = v.table(spark, sf, "lineitem")
    entry = F.struct(
        F.concat(F.quarter("l_shipdate").cast("string"), F.lit("T"), F.date_format("l_shipdate", "yy"), F.lit(" (a)")).alias("periodo"),
        F.when(F.col("l_returnflag") == "R", "semestre").otherwise("trimestre").alias("escopo_periodo"), F.col("l_quantity").alias("valor"),
    )
    # The lines of one order, a handful.
    per = l.groupBy("l_orderkey").agg(*[F.collect_list(F.when(F.col("l_linestatus") == s, entry)).alias(m) for m, s in (("vendas", "F"), ("lancamentos", "O"))])

    def metric(m):
        return F.struct(F.lit("u").alias("indicador"), F.lit("unidades").alias("unidade"), F.array(F.struct(F.lit(None).cast("string").alias("empresa"), F.col(m).alias("valores"))).alias("dados")).alias(m)

    rows = per.select(F.col("l_orderkey").cast("string").alias("document_id"), F.lit("e").alias("execution_id"), F.lit("k").alias("source_object_key"), F.lit("c").alias("company_slug"), F.lit("2T26 (a)").alias("periodo_referencia"), metric("vendas"), metric("lancamentos"))
    out = pb.metric_rows(rows, ["lancamentos", "vendas"])
    return out.groupBy("metric_name", "document_id", "periodo_valor").agg(F.sum(F.col("valor").cast("bigint")).alias("valor"), F.count(F.lit(1)).alias("n"))


@query("x3_export_rows", "select cast(l_orderkey as varchar) as document_id, l_returnflag as periodo, case l_returnflag when 'A' then 'referencia' when 'N' then 'anterior' end as papel_periodo, count(*) as n from lineitem group by 1, 2, 3")
def _(spark, sf):
    rows = v.table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("document_id"), F.col("l_returnflag").alias("periodo"))
    roles = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(r).alias("role"), F.lit(label).alias("label")) for i, r, label in ((0, "referencia", "A"), (1, "anterior", "N"), (2, "repetido", "A"))])
    periods = rows.select("document_id").distinct().select("document_id", F.explode(roles).alias("s")).select("document_id", "s.*")
    return pb.export_rows(rows, periods).groupBy("document_id", "periodo", "papel_periodo").agg(F.count(F.lit(1)).alias("n"))


@query(
    "x4_export_preflight",
    """with p as (select distinct l_orderkey as k, l_linestatus as o, l_returnflag as p, l_quantity as q from lineitem), ev as (select distinct l_orderkey as k, l_linestatus as o, l_returnflag as p, l_quantity as q from lineitem where l_linenumber <> 3)
 select cast(o_orderkey as varchar) as document_id, 'not_compatible' as problem, 1 as n from orders where o_orderstatus = 'P' union all select cast(o_orderkey as varchar), 'source_missing', 1 from orders where o_orderkey % 50 = 0
 union all select cast(k as varchar), 'value_without_evidence', count(*) from p anti join ev using (k, o, p, q) group by 1
 union all select cast(l_orderkey as varchar), 'evidence_without_place', count(distinct (l_linestatus, l_returnflag, l_quantity)) from lineitem where l_linenumber = 3 group by 1""",
)
def _(spark, sf):
    l = v.table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("document_id"), F.col("l_linestatus").alias("operation"), F.col("l_returnflag").alias("periodo"), F.col("l_quantity").alias("valor"), "l_linenumber")
    runs = v.runs(spark, sf).select("document_id", F.when(F.col("run_status") == "P", "incompativel").otherwise("compativel").alias("status"), F.lit(0).alias("failed"), F.when(F.col("seq") % 50 != 0, "s3").alias("source_uri"))
    # Lines and runs of an order lie together for all groups below.
    n = l.count()
    l, runs = clustered(l, "document_id", rows=n), clustered(runs, "document_id", rows=n)
    audit = l.select("*", F.when(F.col("l_linenumber") != 3, 1).alias("page_number"), F.lit(True).alias("has_bbox"))
    out = pb.export_preflight(l, audit, runs)
    return out.groupBy("document_id", "problem").agg(F.count(F.lit(1)).alias("n"))


@query(
    "x5_resolution_manifests",
    """select cast(o_orderkey as varchar) as document_id, case when o_orderkey % 5 > 1 then 'm/' || o_orderkey end as manifest_key,
 case o_orderkey % 5 when 0 then 'no_manifest' when 1 then 'several_manifests' end as problem from orders""",
)
def _(spark, sf):
    r = v.runs(spark, sf)
    keys = r.select("entity", "document_id", "execution_id")
    # One manifest a run, none for every fifth, two for the one after it.
    many = F.when(F.col("seq") % 5 == 0, 0).when(F.col("seq") % 5 == 1, 2).otherwise(1)
    manifests = r.where(many > 0).select("entity", "document_id", "execution_id", F.explode(F.sequence(F.lit(1), many)).alias("n"))
    manifests = manifests.withColumn("manifest_key", F.concat(F.lit("m/"), "document_id"))
    return pb.manifest_of(keys, manifests).select("document_id", "manifest_key", "problem")
