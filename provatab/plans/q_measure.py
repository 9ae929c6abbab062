"""Scores over labels, events and calls."""

from pyspark.sql import functions as F

from provatab.cluster import first_per_key
from provatab.operators import contract as ct
from provatab.operators import measure as ms
from provatab.operators import resolve as rs
from provatab.plans import q_contract, views as v
from provatab.plans.q_repair import candidate_mappings, supplier_roles
from provatab.plans.q_resolve import rule_results, suppliers
from provatab.plans.q_sources import MANIFEST_SQL, _URI_KINDS, manifests_with_uris
from provatab.plans.registry import query
from provatab.sources.readers import artifact_uris

RUNS = f"with {v.RUNS_SQL}"


def _r(x, y):
    return f"case when {y} > 0 then round({x} / {y}, 6) else 0.0 end"


@query(
    "e1_set_metrics",
    f"""with f as (select distinct source, lang, d.doc_id from documents d where n_chars > 1500), e as (select source, lang, doc_id from documents join labels using (doc_id) where quality = 1),
 n as (select source, lang, count(*) filter (where f.doc_id is not null and e.doc_id is not null) as hits, count(f.doc_id) as found, count(e.doc_id) as expected from f full join e using (source, lang, doc_id) group by 1, 2 having count(e.doc_id) > 0),
 s as (select *, {_r('hits', 'found')} as precision, {_r('hits', 'expected')} as recall from n)
 select source, lang, hits, found, expected, precision, recall, case when precision + recall > 0 then round(2 * precision * recall / (precision + recall), 6) else 0.0 end as f1, case when hits = found and hits = expected then 1.0::double else 0.0 end as exact from s""",
)
def _(spark, sf):
    d, l = v.table(spark, sf, "documents"), v.table(spark, sf, "labels")
    found = d.where("n_chars > 1500").select("source", "lang", "doc_id")
    expected = d.join(l.where("quality = 1"), "doc_id").select("source", "lang", "doc_id")
    return ms.set_metrics(found, expected, ["source", "lang"], ["doc_id"])


@query(
    "e2_mapping_accuracy",
    f"""with x as (select l_orderkey as k, l_partkey || '-' || l_linenumber as p, l_returnflag as a, l_linestatus as b, l_quantity as q, l_discount as d from lineitem qualify row_number() over (partition by l_orderkey, l_partkey, l_linenumber order by l_extendedprice) = 1)
 select cast(k as varchar) as document_id, count(*) as common, {_r("count(*) filter (where a <> 'R')", 'count(*)')} as kind_accuracy, case when count(*) filter (where a <> 'N') > 0 then {_r("count(*) filter (where a <> 'N' and b = 'F')", "count(*) filter (where a <> 'N')")} end as file_accuracy,
 {_r("count(*) filter (where q > 10)", 'count(*)')} as instruction_accuracy from x where d < 0.09 group by 1""",
)
def _(spark, sf):


    l = v.table(spark, sf, "lineitem").withColumn("mapping_path", F.concat_ws("-", "l_partkey", "l_linenumber"))
    l = first_per_key(l, ["l_orderkey", "mapping_path"], F.col("l_extendedprice"))
    doc = F.col("l_orderkey").cast("string").alias("document_id")
    kind = F.when(F.col("l_returnflag") == "N", "valor_fixo").otherwise("celula_de_tabela")
    found = l.where("l_discount < 0.09").select(
        doc, "mapping_path", F.when(F.col("l_returnflag") == "R", "outra").otherwise(kind).alias("tipo_origem"), F.when(F.col("l_linestatus") == "F", "t1").otherwise("t2").alias("arquivo_origem"),
        F.concat(F.lit('{"b": 1, "a": '), F.when(F.col("l_quantity") > 10, "2").otherwise("3"), F.lit("}")).alias("instruction"),
    )
    expected = l.select(doc, "mapping_path", kind.alias("tipo_origem"), F.lit("t1").alias("arquivo_origem"), F.lit('{"a":2,"b":1}').alias("instruction"))
    return ms.mapping_accuracy(found, expected, ["document_id"])


@query("e3_validity", "select cast(o_orderkey as varchar) as document_id, case when exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R') then 0.0::double else 1.0 end as valid from orders where o_orderstatus <> 'P'")
def _(spark, sf):
    broken = v.table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").cast("string").alias("document_id"))
    return ms.validity(v.runs(spark, sf).select("document_id", (F.col("run_status") != "P").alias("checkable")), broken)


def _flat(spark, sf):
    f = ct.flatten_contracts(q_contract.contracts(spark, sf).where("domain = 'BUILDING'"))
    return f


@query(
    "e4_structure_metrics",
    f"""with {q_contract.TARGETS}, {q_contract.PROPOSED}, n as (select document_id, cast(document_id as bigint) as k from newest),
 m as (select document_id, k % 7 = 0 as odd, k % 9 = 0 as bare, 2 + case when k % 3 = 0 then 2 else 0 end + case when k % 5 = 0 then 1 else 0 end as keys, k from n)
 select document_id, name, value from (select document_id, unnest(['assinatura_f1_array_sem_filtro', 'assinatura_f1_paths_fora_do_permitido', 'assinatura_f1_filtro_chave_declarada', 'assinatura_f1_filtro_seletor_igual_ao_contrato', 'assinatura_f1_filtro_papel_literal', 'assinatura_f1_entidades_no_candidato', 'assinatura_f1_cobertura_obrigatorios', 'assinatura_f1_cobertura_opcionais', 'assinatura_f1_estrutura_valida']) as name,
 unnest([case when bare then 1.0 else 0.0 end, case when odd then 1.0 else 0.0 end, 1.0, 1.0, 0.0, case when k % 5 = 0 then 2.0 else 1.0 end, case when k % 3 = 0 then 1.0 else 0.5 end, case when k % 5 = 0 then 0.25 else 0.0 end, case when odd or bare then 0.0 else 1.0 end])::double as value from m)""",
)
def _(spark, sf):
    f = _flat(spark, sf)
    return ms.structure_metrics(q_contract.proposed(spark, sf), f["paths"], f["keys"], f["requirements"])


@query(
    "e5_target_metrics",
    f"""with {q_contract.NEWEST}, n as (select document_id, cast(document_id as bigint) as k from newest), m as (select document_id, case when k % 3 = 0 then 1.0 else 0.5 end as cov, (k % 5 = 0)::int + (k % 7 = 0)::int + (k % 9 = 0)::int as odd, 2 + 2 * (k % 3 = 0)::int + (k % 9 = 0)::int as good, (k % 5 = 0)::int as bad from n)
 select document_id, unnest(['assinatura_f1_entradas_obrigatorias_cobertas', 'assinatura_f1_chaves_fora_das_esperadas', 'assinatura_f1_contexto_irmao_presente', 'assinatura_f1_filtro_valor_identidade_correto']) as name, unnest([round(cov, 6)::double, odd::double, 1.0::double, round(good / (good + bad), 6)::double]) as value from m""",
)
def _(spark, sf):
    out = ms.target_metrics(q_contract.targets(spark, sf), q_contract.proposed(spark, sf))
    return out.withColumn("value", F.round("value", 6))


@query(
    "e6_selection_metrics",
    """with c as (select distinct l_orderkey as k, l_partkey as a, l_returnflag as r from lineitem where l_linestatus = 'F'), g as (select distinct l_orderkey as k, l_partkey as a, l_returnflag as r from lineitem where l_quantity > 20),
 b as (select distinct k, r from c semi join g using (k, r)), ca as (select distinct k, a from c where k in (select k from b)), ga as (select distinct g.k, g.a from g semi join b using (k, r)),
 n as (select coalesce(ca.k, ga.k) as k, count(ca.a) as nc, count(ga.a) as ng, count(*) filter (where ca.a is not null and ga.a is not null) as nh from ca full join ga on ca.k = ga.k and ca.a = ga.a group by 1), p as (select k, count(*) / count(distinct r) as mean from c semi join b using (k, r) group by 1)
 select cast(k as varchar) as document_id, unnest(['assinatura_f0_selecao_precisao', 'assinatura_f0_selecao_revocacao', 'assinatura_f0_selecao_artefatos_por_requisito']) as name, round(unnest([nh / nc, nh / ng, mean]), 6) as value from n join p using (k)""",
)
def _(spark, sf):
    l = v.table(spark, sf, "lineitem")
    row = [F.col("l_orderkey").cast("string").alias("document_id"), F.col("l_returnflag").alias("requirement"), F.col("l_partkey").cast("string").alias("artifact")]
    out = ms.selection_metrics(l.where("l_linestatus = 'F'").select(*row), l.where("l_quantity > 20").select(*row))
    return out.withColumn("value", F.round("value", 6))


@query(
    "e7_role_metrics",
    "with d as (select distinct cast(l_suppkey as varchar) as document_id, l_suppkey % 4 as q from lineitem where l_linestatus = 'F') select document_id, unnest(['assinatura_f2_estrutura_tabela_lida', 'assinatura_f2_papel_coluna_origem_contrato', 'assinatura_f2_papel_coluna_correto']) as name, unnest([1.0, 1.0, case when q = 1 then 1.0 else 0.0 end])::double as value from d",
)
def _(spark, sf):
    structure, roles = supplier_roles(spark, sf)
    gold = v.period_tables(spark, sf).where("table_id = 'vendas'").select("document_id", "table_id")
    anchors = gold.select("*", F.lit("papel_periodo").alias("selector"), F.lit("periodo_referencia").alias("role"), F.lit(14).alias("column_index"))
    return ms.role_metrics(structure, roles, gold, anchors)


@query(
    "e8_anchoring_metrics",
    f"""with {q_contract.NEWEST}, n as (select document_id, cast(document_id as bigint) as k from newest)
 select document_id, unnest(['assinatura_f3_arquivo_origem_correto', 'assinatura_f3_rotulo_linha_correto', 'assinatura_f3_indice_coluna_correto', 'assinatura_f3_ausencia_falso_negativo', 'assinatura_f3_ausencia_falso_positivo', 'assinatura_f3_ausencia_declarada']) as name,
 unnest([0.5, case when k % 6 <> 1 then 0.5 else 0.0 end, case when k % 8 <> 1 then 0.5 else 0.0 end, 1.0, case when k % 3 = 0 then 1.0 else 0.0 end, 1.0])::double as value from n""",
)
def _(spark, sf):
    ids = q_contract.identities(spark, sf).select("document_id", F.lower(F.col("identity")["entidade"]).alias("e"))
    own = F.array_sort(F.array(F.concat(F.lit("empresa="), "e"), F.lit("papel_periodo=periodo_referencia")))
    other = F.array_sort(F.array(F.concat(F.lit("empresa="), "e"), F.lit("papel_periodo=mesmo_periodo_ano_anterior")))
    path = F.lit("balancos.vendas.dados.valores.valor").alias("requirement")
    place = [F.lit("vendas").alias("arquivo_origem"), F.lit("VENDAS").alias("rotulo_linha"), F.lit(3).alias("indice_linha"), F.lit(1).alias("indice_coluna")]
    gold = ids.select("document_id", path, own.alias("selectors"), *place).unionByName(ids.select("document_id", path, other.alias("selectors"), *place))
    absences = ids.select("document_id", F.lit("balancos.lancamentos.dados.valores.valor").alias("requirement"), F.array(F.lit("papel_periodo=periodo_referencia")).alias("selectors"))
    declared = ids.select("document_id", F.lit("x").alias("path"))
    return ms.anchoring_metrics(candidate_mappings(spark, sf).withColumn("ord", F.lit(1)), gold, absences, declared)


@query(
    "e9_extraction_metrics",
    f"""with {MANIFEST_SQL}, n as (select document_id, count(*) as a, count(*) filter (where kind = 'tables') as t, count(*) filter (where kind in ('blocks', 'text_candidates')) as x, count(*) filter (where kind = 'blocks') as b from uris group by 1)
 select document_id, unnest(['extracao_artefatos_total', 'extracao_tabelas_detectadas', 'extracao_evidencias_textuais', 'extracao_ok']) as name, unnest([a, t, x, (t > 0 or b > 0)::int])::double as value from n""",
)
def _(spark, sf):
    manifests = manifests_with_uris(spark, sf)
    return ms.extraction_metrics(artifact_uris(manifests, _URI_KINDS), manifests, ["document_id"])


@query(
    "e10_validation_metrics",
    f"""with {v.PERIOD_SQL}, docs as (select distinct cast(l_suppkey as varchar) as document_id from lineitem), k as (select d.document_id, 7 as t, cast(exists (select 1 from cells c where c.document_id = d.document_id and c.table_id = 'vendas') as int) * 2 + (cast(d.document_id as bigint) % 2)
  + cast(exists (select 1 from cells c where c.document_id = d.document_id and c.table_id = 'vendas' and c.row_index = 2) as int) + cast(exists (select 1 from cells c where c.document_id = d.document_id and c.table_id = 'vendas' and c.row_index = 0 and c.column_index = 3) as int) as p from docs d)
 select document_id, unnest(['validacao_regras_total', 'validacao_taxa_aprovacao_regras', 'validacao_regras_reprovadas', 'validacao_cobertura_de_regras']) as name, unnest([7.0, round(p / 7, 6), 7.0 - p, 1.0])::double as value from k""",
)
def _(spark, sf):
    return ms.validation_metrics(rs.compatibility(rule_results(spark, sf), suppliers(spark, sf)), ["document_id"])


@query(
    "e11_resolution_metrics",
    f"""with n as (select cast(l_orderkey as varchar) as document_id, count(*) as a, count(*) filter (where l_linestatus = 'F') as d, count(*) filter (where l_returnflag = 'R') as q, count(*) filter (where l_returnflag = 'R' and l_linestatus = 'F') as qd, count(*) filter (where l_linenumber = 1) as lit,
  count(*) filter (where l_quantity > 10) as cells, count(*) filter (where l_quantity > 30) as syn from lineitem group by 1)
 select * from (select document_id, unnest(['resolucao_campos_mapeados', 'resolucao_cobertura_campos', 'resolucao_campos_obrigatorios', 'resolucao_campos_nao_resolvidos', 'resolucao_cobertura_obs', 'resolucao_cobertura_obrigatorios', 'resolucao_linha_por_sinonimo']) as name,
 unnest([a, {_r('d', 'a')}, q, a - d, {_r('(d - lit)', '(a - lit)')}, case when q > 0 then {_r('qd', 'q')} end, case when cells > 0 then {_r('syn', 'cells')} end])::double as value from n) where value is not null""",
)
def _(spark, sf):
    l = v.table(spark, sf, "lineitem")
    audit = l.select(
        F.col("l_orderkey").cast("string").alias("document_id"), F.when(F.col("l_linestatus") == "F", "resolvido").otherwise("erro").alias("status_resolucao"),
        (F.col("l_returnflag") == "R").alias("obrigatorio"), (F.col("l_linenumber") == 1).alias("literal"), F.when(F.col("l_quantity") > 10, F.col("l_quantity") > 30).alias("linha_por_sinonimo"),
    )
    return ms.resolution_metrics(audit, ["document_id"])


def _calls(spark, sf):
    c = v.table(spark, sf, "conversations")
    return c.select(
        F.col("conv_id").cast("string").alias("document_id"), F.col("role").alias("stage"), F.col("turn").alias("attempt"), (F.length("text") > 200).alias("ok"), F.length("text").alias("total_tokens")
    )


@query(
    "e12_stage_metrics",
    """with n as (select cast(conv_id as varchar) as document_id, role as stage, count(*) as n, bool_or(length(text) > 200) as ok, sum(length(text)) as t from conversations group by 1, 2)
 select * from (select document_id, stage, unnest(['llm_tentativas', 'llm_acerto_1a_tentativa', 'llm_etapa_sucesso', 'llm_tokens_total']) as name, unnest([n, (ok and n <= 1)::int, ok::int, case when t > 0 then t end])::double as value from n) where value is not null""",
)
def _(spark, sf):
    return ms.stage_metrics(_calls(spark, sf), ["document_id"])


@query("e14_selection_quality", f"""with n as (select o_custkey, count(*) as n, count(*) filter (where o_orderstatus = 'F') as k from orders group by 1) select cast(o_custkey as varchar) as document_id, unnest(['selecao_evidencia_especifica', 'selecao_evidencia_descartada']) as name, unnest([{_r('k', 'n')}, n - k])::double as value from n""")
def _(spark, sf):
    r = v.runs(spark, sf).select(F.col("entity").alias("document_id"), (F.col("run_status") == "F").alias("kept"))
    return ms.selection_quality(r, ["document_id"])


@query(
    "e14_table_read_metrics",
    "select document_id, unnest(['estrutura_tabela_lida', 'papel_coluna_origem_contrato']) as name, 1.0::double as value from (select distinct cast(l_suppkey as varchar) as document_id from lineitem)",
)
def _(spark, sf):
    return ms.table_read_metrics(*supplier_roles(spark, sf))


@query(
    "e15_repair_metrics",
    """select * from (select cast(o_orderkey as varchar) as document_id, unnest(['fallback_tentativas_llm_total', 'fallback_candidato_valido', 'revalidacao_aprovada', 'revalidacao_regras_executadas', 'revalidacao_gate_efetivo', 'publicacao_realizada', 'fallback_tokens_total']) as name,
 unnest([o_orderkey % 5, (o_orderstatus <> 'P')::int, (o_orderstatus = 'F')::int, o_orderkey % 3, (o_orderstatus = 'F' and o_orderkey % 3 > 0 and o_orderkey % 2 = 0)::int, (o_orderstatus = 'F' and o_orderkey % 2 = 0)::int, case when o_orderkey % 4 > 0 then o_orderkey % 4 * 100 end])::double as value from orders) where value is not null""",
)
def _(spark, sf):
    s, k = F.col("run_status"), F.col("seq")
    runs = v.runs(spark, sf).select(
        "document_id", (k % 5).alias("attempts"), (s != "P").alias("candidate_valid"), (s == "F").alias("approved"), (k % 3).alias("rules_total"), F.when(k % 2 == 0, k % 3).otherwise(-1).alias("rules_passed"),
        ((s == "F") & (k % 2 == 0)).alias("published"), (k % 4 * 100).alias("total_tokens"),
    )
    return ms.repair_metrics(runs, ["document_id"])


@query(
    "e16_transition_metrics",
    "select cast(o_orderkey as varchar) as document_id, 'transicao_extracao_para_resolucao' as name, (o_orderstatus = 'F')::int::double as value from orders union all select cast(o_orderkey as varchar), 'transicao_extracao_para_resolucao_delta_cobertura', round(o_orderkey / 7, 6) from orders where o_orderkey % 3 = 0",
)
def _(spark, sf):
    h = v.runs(spark, sf).select("document_id", F.lit("extracao").alias("origin"), F.lit("resolucao").alias("target"), (F.col("run_status") == "F").alias("enabled"), F.when(F.col("seq") % 3 == 0, F.col("seq") / 7).alias("coverage_delta"))
    return ms.transition_metrics(h, ["document_id"])


@query(
    "e17_end_to_end_metrics",
    """select * from (select cast(o_orderkey as varchar) as document_id, unnest(['e2e_sucesso', 'e2e_autonomia_deterministica', 'e2e_apto_para_bronze', 'e2e_duracao_segundos', 'e2e_tokens_llm', 'e2e_cobertura_final']) as name,
 unnest([(o_orderstatus <> 'P')::int, (o_orderkey % 2 = 1)::int, (o_orderstatus = 'F')::int, case when o_orderkey % 3 = 0 then o_orderkey % 1000 end, case when o_orderkey % 2 = 0 and o_orderkey > 0 then o_orderkey end, case when o_orderkey % 5 = 0 then round(o_orderkey % 100 / 100, 6) end])::double as value from orders) where value is not null""",
)
def _(spark, sf):
    s, k = F.col("run_status"), F.col("seq")
    runs = v.runs(spark, sf).select(
        "document_id", (s != "P").alias("success"), (k % 2 == 0).alias("used_model"), (s == "F").alias("ready"), F.when(k % 3 == 0, (k % 1000).cast("double")).alias("seconds"),
        F.when(k % 2 == 0, k).otherwise(0).alias("total_tokens"), F.when(k % 5 == 0, (k % 100) / 100).alias("coverage"),
    )
    return ms.end_to_end_metrics(runs, ["document_id"])


@query(
    "e18_run_spans",
    "select cast(user_id as varchar) as document_id, round(epoch(max(ts)) - epoch(min(ts)), 3) as seconds, count(*) as n_marks, count(distinct event_type) as n_stages from events group by 1",
)
def _(spark, sf):
    marks = v.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("document_id"), F.col("event_type").alias("stage"), F.col("ts").cast("timestamp").alias("ts"))
    runs, _ = ms.run_spans(marks, ["document_id"])
    return runs.select("document_id", F.round("seconds", 3).alias("seconds"), "n_marks", F.col("n_stages"))


def _scores(spark, sf):
    """Events as scores of weekly releases: the user is the document, the day the execution."""
    e = v.table(spark, sf, "events")
    names = F.create_map(*[F.lit(x) for x in ("view", "e2e_sucesso", "click", "llm_tokens_total", "purchase", "avaliacao_revocacao", "signup", "qualquer", "error", "status")])
    week = F.floor((F.dayofmonth("ts") - 1) / 15).cast("string")
    run = F.concat_ws("/", F.concat(F.lit("w"), week), F.col("user_id").cast("string"))
    scores = e.select(run.alias("run_id"), names[F.col("event_type")].alias("name"), "value", F.when(F.col("event_type") == "error", "CATEGORICAL").otherwise("NUMERIC").alias("data_type"))
    runs = e.select(run.alias("run_id"), F.concat(F.lit("w"), week).alias("release"), F.col("user_id").cast("string").alias("document_id"), F.lit("fallback").alias("stage"), F.lit("x").alias("execution_id")).distinct()
    return scores, runs


_NAMES = "case event_type when 'view' then 'e2e_sucesso' when 'click' then 'llm_tokens_total' when 'purchase' then 'avaliacao_revocacao' when 'signup' then 'qualquer' end"


@query("e19_mean_scores", f"select 'w' || ((day(ts) - 1) // 15) as release, {_NAMES} as name, round(avg(value), 6) as mean, count(*) as n from events where event_type <> 'error' group by 1, 2")
def _(spark, sf):
    scores, runs = _scores(spark, sf)
    return ms.mean_scores(scores, runs).withColumn("mean", F.round("mean", 6))


_COMPARED = f"""s as (select 'w' || ((day(ts) - 1) // 15) as r, user_id, {_NAMES} as name, value from events where event_type <> 'error'), c as (select user_id from (select distinct user_id, (day(ts) - 1) // 15 as w from events) where w in (0, 1) group by 1 having count(*) = 2),
m as (select name, avg(value) filter (where r = 'w0') as a, avg(value) filter (where r = 'w1') as b from s semi join c using (user_id) group by 1),
j as (select *, (b - a) / greatest(abs(a), 1e-9) as rel, case name when 'e2e_sucesso' then 1 when 'avaliacao_revocacao' then 1 when 'llm_tokens_total' then -1 else 0 end as dir from m),
k as (select *, case when b - a is null then 'ausente' when abs(rel) <= 0.01 then 'estavel' when dir = 0 then 'neutra' when dir * (b - a) > 0 then 'melhorou' else 'regrediu' end as status from j)"""


@query("e20_compared_releases", f"with {_COMPARED} select name, round(a, 6) as base_mean, round(b, 6) as new_mean, name = 'avaliacao_revocacao' as guard, status from k")
def _(spark, sf):
    scores, runs = _scores(spark, sf)
    out = ms.compare_releases(scores, runs, "w0", "w1")
    return out.select("name", F.round("base_mean", 6).alias("base_mean"), F.round("new_mean", 6).alias("new_mean"), "guard", "status")


@query("e20_release_verdict", f"with {_COMPARED} select cast(case when count(*) filter (where status = 'regrediu' and name = 'avaliacao_revocacao') > 0 then 2 when count(*) filter (where status = 'regrediu') > 0 then 1 else 0 end as integer) as code, count(*) filter (where status = 'regrediu') as regressed, count(*) filter (where status = 'melhorou') as improved from k")
def _(spark, sf):
    scores, runs = _scores(spark, sf)
    return ms.release_verdict(ms.compare_releases(scores, runs, "w0", "w1"))


@query("e21_stage_averages", "select event_type || '@' || case when user_id % 2 = 0 then 'primeira_tentativa' else 'final' end as metric, round(avg(value), 6) as mean, count(*) as n from events group by 1")
def _(spark, sf):
    e = v.table(spark, sf, "events").select(F.col("event_type").alias("name"), F.when(F.col("user_id") % 2 == 0, "primeira_tentativa").alias("stage"), "value")
    return ms.stage_averages(e).withColumn("mean", F.round("mean", 6))


@query(
    "e22_picked_attempts",
    """select cast(conv_id as varchar) as document_id, role as stage, min(turn) as first_turn, coalesce(max(turn) filter (where length(text) > 200), max(turn)) as final_turn, count(*) as attempts from conversations group by 1, 2""",
)
def _(spark, sf):
    out = ms.pick_attempts(_calls(spark, sf), ["document_id", "stage"], F.col("attempt"), ~F.col("ok"), ["attempt"])
    return out.select("document_id", "stage", F.col("first.attempt").alias("first_turn"), F.col("final.attempt").alias("final_turn"), "attempts")


@query("e22_merged_maps", "select cast(conv_id as varchar) as document_id, role as path, cast(max(turn) as varchar) as value from conversations group by 1, 2")
def _(spark, sf):
    c = v.table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("document_id"), "turn", F.create_map("role", F.col("turn").cast("string")).alias("m"))
    return ms.merged_maps(c, ["document_id"], F.col("turn"), "m")


@query("e23_daily_average", "select strftime(ts, '%Y-%m-%d') as day, event_type as name, round(avg(value), 6) as measure from events group by 1, 2")
def _(spark, sf):
    out = ms.dashboard(v.table(spark, sf, "events").withColumn("name", F.col("event_type")), grain="day")
    return out.select(F.date_format("bucket", "yyyy-MM-dd").alias("day"), "name", F.round("measure", 6).alias("measure"))


@query("e23_p95_latency", "select event_type as name, round(quantile_cont(value, 0.95), 9) as measure from events group by 1")
def _(spark, sf):
    out = ms.dashboard(v.table(spark, sf, "events").withColumn("name", F.col("event_type")), agg="p95")
    return out.withColumn("measure", F.round("measure", 9))


@query("e23_top_users", "select user_id, count(*) as measure from events group by 1 order by 2 desc, 1 limit 10")
def _(spark, sf):
    return ms.dashboard(v.table(spark, sf, "events"), dims=["user_id"], agg="count", top=10)


def _repair_runs(spark, sf):
    s, k = F.col("run_status"), F.col("seq")
    return v.runs(spark, sf).select(
        "domain", "entity", "document_id", "execution_id", (s == "F").alias("has_publication"), (k % 2 == 0).alias("has_resolved"), (k % 3 == 0).alias("has_selection"), (k % 5 != 0).alias("has_selection_input"),
        (s != "P").alias("has_candidate"), (k % 7 != 0).alias("has_candidate_input"), (s == "F").alias("approved"), F.col("ts"), F.col("seq"),
    )


_ITEMS = """items as (select 'e2e' as dataset, cast(o_orderkey as varchar) as document_id, o_orderstatus as s from orders where o_orderstatus = 'F' and o_orderkey % 2 = 0 union all select 'selecao', cast(o_orderkey as varchar), o_orderstatus from orders where o_orderkey % 3 = 0 and o_orderkey % 5 <> 0
 union all select 'candidato', cast(o_orderkey as varchar), o_orderstatus from orders where o_orderstatus <> 'P' and o_orderkey % 7 <> 0 union all select 'transicao', cast(o_orderkey as varchar), o_orderstatus from orders where o_orderstatus <> 'P')"""


@query("e24_regression_items", f"with {_ITEMS} select dataset, document_id, case when s = 'F' then 'aprovado' else 'reprovado' end as label from items")
def _(spark, sf):
    return ms.regression_items(_repair_runs(spark, sf)).select("dataset", "document_id", "label")


@query("e25_linked_runs", f"with {_ITEMS}, n as (select dataset, count(*) as n from items group by 1) select 'r' || (cast(document_id as bigint) % 2) as release, dataset, count(*) as n_linked, round(count(*) / any_value(n), 6) as ratio from items join n using (dataset) where cast(document_id as bigint) % 11 <> 0 group by 1, 2")
def _(spark, sf):
    r = _repair_runs(spark, sf)
    keyed = r.where("seq % 11 <> 0").select(F.concat(F.lit("r"), (F.col("seq") % 2).cast("string")).alias("release"), "document_id", "execution_id", F.concat("execution_id", F.lit("a")).alias("run_id"), F.col("ts").alias("started"))
    again = keyed.withColumn("run_id", F.concat("run_id", F.lit("b")))
    _, hits = ms.link_runs(ms.regression_items(r), keyed.unionByName(again))
    return hits.select("release", "dataset", "n_linked", "ratio")
