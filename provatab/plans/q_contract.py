"""A contract of a few fields, applied to every customer or supplier document.

The contract is text that people write; its relations are joined to documents from the tables.
"""

import json

from pyspark.sql import functions as F

from provatab.cluster import dealt
from provatab.operators import contract as ct
from provatab.plans import views as v
from provatab.plans.registry import query

ROLES = {
    "periodo_referencia": {"descricao": "referência", "derivacao": {"origem": "identidade_documento.periodo"}},
    "periodo_anterior": {"descricao": "anterior", "derivacao": {"relacao": "anterior", "passo": 1}},
    "mesmo_periodo_ano_anterior": {"descricao": "um ano antes", "derivacao": {"relacao": "mesmo_periodo_ano_anterior"}},
}
_OBS = [
    {"seletores": {"papel_periodo": r}, "campos_contexto_obrigatorios": ["periodo"], **({} if i == 0 else {"obrigatorio": False})} for i, r in enumerate(ROLES)
]
CONTRACT = {
    "tipo_documento": "contrato_semantico",
    "versao": "1.2.0",
    "contrato_semantico": {
        "requisitos_mapeamento": {
            "papeis": {"papel_periodo": ROLES},
            "campos_obrigatorios": [
                {"path": f"balancos.{g}.dados.valores.valor", "evidencia_esperada": {"valor": "celula_de_tabela"}, "observacoes_obrigatorias": _OBS}
                for g in ("vendas", "lancamentos")
            ],
        },
        "chaves_de_item": {
            **{f"balancos.{g}.dados": {"chave": "empresa", "origem_valor": "identidade_documento", "atributo_identidade": "entidade"} for g in ("vendas", "lancamentos")},
            **{f"balancos.{g}.dados.valores": {"chave": "papel_periodo", "origem_valor": "seletor_observacao"} for g in ("vendas", "lancamentos")},
        },
        "derivacoes": [
            {"destino": "fonte", "origem": {"tipo": "manifesto", "campo": "fonte"}},
            {"destino": "periodo_referencia", "origem": {"tipo": "observacao", "campo": "periodo", "seletor": {"papel_periodo": "periodo_referencia"}}},
        ],
    },
    "schema_saida": {
        "balancos": {
            g: {
                "dados": [{"empresa": "string", "valores": [{"escopo_periodo": "trimestre", "papel_periodo": "string", "periodo": "string", "valor": "number | null"}]}],
                "unidade": "unidades",
            }
            for g in ("vendas", "lancamentos")
        },
        "fonte": "string",
        "periodo_referencia": "string",
        "observacao": "string | null",
    },
}
PATHS = sorted(
    [f"balancos.{g}{s}" for g in ("vendas", "lancamentos") for s in ("", ".dados", ".dados.empresa", ".dados.valores", ".dados.valores.escopo_periodo", ".dados.valores.papel_periodo", ".dados.valores.periodo", ".dados.valores.valor", ".unidade")]
    + ["balancos", "fonte", "periodo_referencia", "observacao"]
)


def contracts(spark, sf):
    """The contract under every market segment of the customers, as its own domain."""
    text = json.dumps(CONTRACT, ensure_ascii=False)
    return v.table(spark, sf, "customer").select(F.col("c_mktsegment").alias("domain")).distinct().select("domain", F.lit("1.2.0").alias("version"), F.lit(text).alias("contract"))


def identities(spark, sf):
    """Customer documents: the entity is the customer, the period that of its newest order."""
    o = v.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("d"))
    c = v.table(spark, sf, "customer").join(o, "c_custkey")
    label = F.concat(F.quarter("d").cast("string"), F.lit("T"), F.date_format("d", "yyyy"))
    return c.select(
        F.col("c_mktsegment").alias("domain"), F.lit("1.2.0").alias("version"), F.col("c_custkey").cast("string").alias("document_id"),
        F.create_map(F.lit("entidade"), F.col("c_name"), F.lit("periodo"), label).alias("identity"),
    )


SEG = "seg as (select distinct c_mktsegment as domain from customer)"
NEWEST = "newest as (select c_mktsegment as domain, cast(c_custkey as varchar) as document_id, c_name, max(o_orderdate) as d from customer join orders on o_custkey = c_custkey group by all)"


@query("c1_paths", f"with {SEG} select domain, unnest({PATHS!r}) as path from seg")
def _(spark, sf):
    return ct.contract_nodes(contracts(spark, sf)).select("domain", "path")


@query("c2_arrays", f"with {SEG} select domain, unnest({[p for p in PATHS if p.endswith(('.dados', '.valores'))]!r}) as path from seg")
def _(spark, sf):
    return ct.contract_nodes(contracts(spark, sf)).where("is_array").select("domain", "path")


@query(
    "c3_literals",
    f"with {SEG} select domain, unnest({[p for p in PATHS if p.endswith(('.unidade', '.escopo_periodo'))]!r}) as path, unnest({['trimestre' if p.endswith('periodo') else 'unidades' for p in PATHS if p.endswith(('.unidade', '.escopo_periodo'))]!r}) as literal from seg",
)
def _(spark, sf):
    return ct.contract_nodes(contracts(spark, sf)).where("literal is not null").select("domain", "path", "literal")


@query("c6_requirements", f"""with {SEG}, r as (select unnest({list(ROLES)!r}) as role, unnest([true, false, false]) as required), g as (select unnest(['vendas', 'lancamentos']) as g) select domain, 'balancos.' || g || '.dados.valores.valor' as path, role, required, 'periodo' as context from seg, r, g""")
def _(spark, sf):
    r = ct.requirements(contracts(spark, sf))
    return r.select("domain", "path", F.try_element_at("selectors", F.lit("papel_periodo")).alias("role"), "required", F.array_join("context_fields", ",").alias("context"))


@query("c7_roles", f"with {SEG} select domain, 'papel_periodo' as selector, unnest({list(ROLES)!r}) as role, unnest([null, 'anterior', 'mesmo_periodo_ano_anterior']) as relation from seg")
def _(spark, sf):
    return ct.roles(contracts(spark, sf)).select("domain", "selector", "role", "relation")


@query("c8_item_keys", f"with {SEG}, g as (select unnest(['vendas', 'lancamentos']) as g) select domain, 'balancos.' || g || '.dados' as array_path, 'empresa' as item_key, 'identidade_documento' as key_origin from seg, g union all select domain, 'balancos.' || g || '.dados.valores', 'papel_periodo', 'seletor_observacao' from seg, g")
def _(spark, sf):
    return ct.item_keys(contracts(spark, sf)).select("domain", "array_path", "item_key", "key_origin")


@query("c9_derivations", f"with {SEG} select domain, unnest(['fonte', 'periodo_referencia']) as target, unnest(['manifesto', 'observacao']) as origin from seg")
def _(spark, sf):
    return ct.derivations(contracts(spark, sf)).select("domain", "target", "origin")


@query(
    "c9_contract_violations",
    f"with {SEG} select domain, unnest(['role_undeclared', 'item_key_not_an_array', 'requirement_outside_schema', 'context_outside_schema', 'derivation_outside_schema']) as rule, unnest(['papel_periodo=outro', 'balancos', 'balancos.x', 'balancos.zz', 'nada']) as detail from seg",
)
def _(spark, sf):
    broken = json.loads(json.dumps(CONTRACT))
    sem = broken["contrato_semantico"]
    sem["requisitos_mapeamento"]["campos_obrigatorios"].append({"path": "balancos.x", "observacoes_obrigatorias": [{"seletores": {"papel_periodo": "outro"}, "campos_contexto_obrigatorios": ["zz"]}]})
    sem["chaves_de_item"]["balancos"] = "empresa"
    sem["derivacoes"].append({"destino": "nada", "origem": {"tipo": "contrato", "campo": "versao"}})
    wrong = contracts(spark, sf).withColumn("contract", F.lit(json.dumps(broken, ensure_ascii=False)))
    return ct.flatten_contracts(wrong)["violations"].select("domain", "rule", "detail")


@query("c5_overlaid_literals", """select cast(c_custkey as varchar) as document_id, path, value, count(*) as n from customer, (values ('balancos.vendas.dados.valores.valor', '1', 1), ('balancos.vendas.dados.valores.valor', '2', 1), ('balancos.vendas.dados.valores.escopo_periodo', 'trimestre', 2), ('balancos.vendas.unidade', 'unidades', 1), ('balancos.vendas.observado', 'x', 1)) t(path, value, k), range(k) group by 1, 2, 3""")
def _(spark, sf):
    c = v.table(spark, sf, "customer")
    base = c.select(F.col("c_mktsegment").alias("domain"), F.lit("1.2.0").alias("version"), F.col("c_custkey").cast("string").alias("document_id"))
    entries = F.array(*[
        F.struct(F.lit(i).alias("item"), F.lit(p).alias("path"), F.lit(val).alias("value"))
        for i, p, val in (("a", "balancos.vendas.dados.valores.valor", "1"), ("b", "balancos.vendas.dados.valores.valor", "2"), ("a", "balancos.vendas.dados.valores.escopo_periodo", "errado"), ("", "balancos.vendas.observado", "x"))
    ])
    leaves = base.select("*", F.explode(entries).alias("e")).select("domain", "version", "document_id", "e.item", "e.path", "e.value")
    out = ct.overlay_literals(leaves, ct.contract_nodes(contracts(spark, sf)))
    return out.groupBy("document_id", "path", "value").agg(F.count(F.lit(1)).alias("n"))


@query(
    "c10_derived_fields",
    f"""with {NEWEST} select document_id, 'fonte' as target, case when cast(document_id as bigint) % 2 = 0 then c_name end as value, case when cast(document_id as bigint) % 2 = 0 then 'derivado' else 'sem_origem' end as status from newest
 union all select document_id, 'periodo_referencia', case when n = 1 then p end, case when n > 1 then 'divergente' else 'preservado' end from (select cast(o_custkey as varchar) as document_id, count(distinct o_orderpriority) as n, min(o_orderpriority) as p from orders group by 1)""",
)
def _(spark, sf):
    ids = identities(spark, sf)
    leaves = ids.select("domain", "version", "document_id", F.explode(F.array(F.lit("fonte"), F.lit("periodo_referencia"))).alias("path")).select(
        "domain", "version", "document_id", F.lit("").alias("item"), "path", F.when(F.col("path") == "periodo_referencia", "já lido").alias("value")
    )
    sources = ids.where("cast(document_id as bigint) % 2 = 0").select("document_id", F.lit("manifesto").alias("origin"), F.lit("fonte").alias("field"), F.col("identity")["entidade"].alias("value"))
    obs = v.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("document_id"), F.lit("periodo").alias("field"), F.array(F.lit("papel_periodo=periodo_referencia")).alias("selectors"), F.col("o_orderpriority").alias("value")
    )
    return ct.apply_derivations(leaves, ct.derivations(contracts(spark, sf)), sources, obs).select("document_id", "target", "value", "status")


def targets(spark, sf):
    f = ct.flatten_contracts(contracts(spark, sf))
    return ct.enumerate_targets(f["paths"], f["requirements"], f["keys"], f["derivations"], dealt(identities(spark, sf), len(PATHS)))


TARGETS = f"""{NEWEST}, rl as (select unnest({list(ROLES)!r}) as role, unnest([true, false, false]) as required), gg as (select unnest(['vendas', 'lancamentos']) as g), lf as (select unnest(['valor', 'periodo']) as leaf, unnest(['valor', 'contexto']) as target_role),
targets as (select document_id, 'balancos.' || g || '.dados[empresa=' || c_name || '].valores[papel_periodo=' || role || '].' || leaf as target, target_role, required, role, g, leaf, c_name from newest, rl, gg, lf
 union all select document_id, 'observacao', 'livre', false, null, null, 'observacao', c_name from newest)"""


@query("c12_targets", f"with {TARGETS} select document_id, target, target_role, required from targets")
def _(spark, sf):
    return targets(spark, sf).select("document_id", "target", "target_role", "required")


def proposed(spark, sf):
    """Proposed mapping keys: every customer maps its reference values; some also foreign or
    unknown keys, and only every third the second group."""
    ids = dealt(identities(spark, sf).select("document_id", F.col("identity")["entidade"].alias("e")), len(PATHS))
    n = F.col("document_id").cast("bigint")

    def key(group, role, leaf, entity=None):
        who = F.col("e") if entity is None else F.lit(entity)
        return F.concat(F.lit(f"balancos.{group}.dados[empresa="), who, F.lit(f"].valores[papel_periodo={role}].{leaf}"))

    keys = F.array(
        key("vendas", "periodo_referencia", "valor"), key("vendas", "periodo_referencia", "periodo"),
        F.when(n % 3 == 0, key("lancamentos", "periodo_referencia", "valor")), F.when(n % 3 == 0, key("lancamentos", "periodo_referencia", "periodo")),
        F.when(n % 5 == 0, key("vendas", "periodo_anterior", "valor", "Outra")), F.when(n % 7 == 0, F.lit("balancos.nada")), F.when(n % 4 == 0, F.lit("observacao")),
        F.when(n % 9 == 0, F.concat(F.lit("balancos.vendas.dados[empresa="), "e", F.lit("].valores.valor"))),
    )
    return ids.select("document_id", F.explode(F.array_compact(keys)).alias("mapping_path"))


PROPOSED = """proposed as (select document_id, unnest(list_filter([
 'balancos.vendas.dados[empresa=' || c_name || '].valores[papel_periodo=periodo_referencia].valor', 'balancos.vendas.dados[empresa=' || c_name || '].valores[papel_periodo=periodo_referencia].periodo',
 case when cast(document_id as bigint) % 3 = 0 then 'balancos.lancamentos.dados[empresa=' || c_name || '].valores[papel_periodo=periodo_referencia].valor' end, case when cast(document_id as bigint) % 3 = 0 then 'balancos.lancamentos.dados[empresa=' || c_name || '].valores[papel_periodo=periodo_referencia].periodo' end,
 case when cast(document_id as bigint) % 5 = 0 then 'balancos.vendas.dados[empresa=Outra].valores[papel_periodo=periodo_anterior].valor' end, case when cast(document_id as bigint) % 7 = 0 then 'balancos.nada' end,
 case when cast(document_id as bigint) % 4 = 0 then 'observacao' end, case when cast(document_id as bigint) % 9 = 0 then 'balancos.vendas.dados[empresa=' || c_name || '].valores.valor' end], lambda x: x is not null)) as mapping_path from newest)"""


@query(
    "c13_matched_targets",
    f"""with {TARGETS}, {PROPOSED} select p.document_id, 'matched' as kind, mapping_path as key from proposed p join targets t on t.document_id = p.document_id and t.target = p.mapping_path
 union all select p.document_id, 'unexpected', mapping_path from proposed p anti join targets t on t.document_id = p.document_id and t.target = p.mapping_path
 union all select t.document_id, 'missing', target from targets t anti join proposed p on t.document_id = p.document_id and t.target = p.mapping_path where required""",
)
def _(spark, sf):
    matched, unexpected, missing = ct.match_targets(targets(spark, sf), proposed(spark, sf))
    return (
        matched.select("document_id", F.lit("matched").alias("kind"), F.col("mapping_path").alias("key"))
        .unionByName(unexpected.select("document_id", F.lit("unexpected").alias("kind"), F.col("mapping_path").alias("key")))
        .unionByName(missing.select("document_id", F.lit("missing").alias("kind"), F.col("target").alias("key")))
    )


@query("c14_mapping_units", f"with {SEG} select domain, 'balancos' as root, 'balancos' as unit, cast(2 as bigint) as n_requirements from seg")
def _(spark, sf):
    return ct.mapping_units(ct.requirements(contracts(spark, sf))).select("domain", "root", "unit", "n_requirements")


@query(
    "c15_scoped_contract",
    f"""with {SEG}, g as (select unnest(['vendas', 'lancamentos']) as g) select domain, 'paths' as part, 'balancos.' || g || '.dados.valores.' || l as item from seg, g, (select unnest(['valor', 'periodo']) as l)
 union all select domain, 'arrays', 'balancos.' || g || '.dados' || l from seg, g, (select unnest(['', '.valores']) as l) union all select domain, 'keys', 'balancos.' || g || '.dados' || l from seg, g, (select unnest(['', '.valores']) as l)
 union all select domain, 'roles', unnest({list(ROLES)!r}) from seg""",
)
def _(spark, sf):
    f = ct.flatten_contracts(contracts(spark, sf))
    scoped = ct.scope_contract(f["paths"], f["requirements"], f["keys"], f["roles"])
    named = {"paths": "path", "arrays": "path", "keys": "array_path", "roles": "role"}
    out = None
    for part, column in named.items():
        rows = scoped[part].select("domain", F.lit(part).alias("part"), F.col(column).alias("item"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("c16_mappable_targets", f"with {SEG}, g as (select unnest(['vendas', 'lancamentos']) as g) select domain, 'balancos.' || g || '.dados.valores.valor' as path, 'balancos.' || g || '.dados,balancos.' || g || '.dados.valores' as arrays from seg, g")
def _(spark, sf):
    f = ct.flatten_contracts(contracts(spark, sf))
    return ct.mappable_targets(f["requirements"], f["paths"]).select("domain", "path", F.array_join("arrays", ",").alias("arrays"))


@query(
    "c17_admission",
    """select p_brand as domain, '1.' || length(p_name) || '.' || p_size as version, unnest(case p_size % 4 when 0 then ['version_differs'] when 1 then ['wrong_type'] when 2 then ['already_published'] else ['unreadable', 'wrong_type', 'not_semver', 'version_differs', 'semantics_missing', 'schema_missing'] end) as rule from (select distinct p_brand, length(p_name) as ln, p_size, min(p_name) as p_name from part group by all)""",
)
def _(spark, sf):
    p = v.table(spark, sf, "part").select(F.col("p_brand").alias("domain"), F.length("p_name").alias("ln"), "p_size").distinct()
    version = F.concat(F.lit("1."), F.col("ln").cast("string"), F.lit("."), F.col("p_size").cast("string"))
    m = F.col("p_size") % 4
    head = F.concat(F.lit('{"tipo_documento":"'), F.when(m == 1, "outro").otherwise("contrato_semantico"), F.lit('","versao":"'), F.when(m == 0, "9.9.9").otherwise(version))
    text = F.when(m == 3, "{").otherwise(F.concat(head, F.lit('","contrato_semantico":{"a":1},"schema_saida":{"b":"string"}}')))
    new = p.select("domain", version.alias("version"), text.alias("contract"), m.alias("m"))
    return ct.admission_violations(new, new.where("m = 2")).select("domain", "version", "rule")


@query(
    "c18_expected_periods",
    f"""with {NEWEST}, p as (select document_id, year(d) * 4 + quarter(d) - 1 as a from newest), s as (select document_id, a, unnest({list(ROLES)!r}) as role, unnest([0, 1, 4]) as back from p)
 select document_id, role, cast((a - back) // 4 as integer) as ano, cast((a - back) % 4 + 1 as integer) as indice from s""",
)
def _(spark, sf):
    out = ct.expected_periods(ct.roles(contracts(spark, sf)), identities(spark, sf))
    return out.select("document_id", "role", "period.ano", "period.indice")
