"""Failure classes, search terms, evidence choice, anchors and candidate checks."""




from pyspark.sql import functions as F

from provatab.cluster import checkpointed, shuffled
from provatab.operators import contract as ct
from provatab.operators import repair as rp
from provatab.operators import tables as tb
from provatab.operators.selection import next_minor_version
from provatab.plans import q_contract, views as v
from provatab.plans.q_resolve import mapping, suppliers
from provatab.plans.q_tables import structure_inputs
from provatab.plans.registry import query

PERIOD = f"with {v.PERIOD_SQL}"
NORMAL = "lower(trim(regexp_replace(regexp_replace(strip_accents({t}), '[^\\x00-\\x7F]', '', 'g'), '\\s+', ' ', 'g')))"


@query(
    "g1_failure_scopes",
    """with r as (select l_orderkey as k, count(*) filter (where l_returnflag = 'R') as rejected, count(*) filter (where l_returnflag = 'R' and l_linenumber = 1) as tot,
  count(*) filter (where l_returnflag = 'R' and l_linenumber in (2, 3)) as par, count(*) filter (where l_linestatus = 'O' and l_quantity > 40) as open_required from lineitem group by 1)
 select cast(o_orderkey as varchar) as document_id, case when o_orderstatus = 'P' and o_orderkey % 4 = 0 then 'nao_aplicavel' when o_orderstatus = 'P' then 'falha_nao_suportada_para_fallback_automatico' when coalesce(tot, 0) > 0 or coalesce(rejected, 0) >= 3 or coalesce(open_required, 0) > 2 then 'regeneracao_total_mapeamento'
  when coalesce(par, 0) > 0 or coalesce(open_required, 0) between 1 and 2 then 'correcao_parcial_mapeamento' else 'falha_nao_suportada_para_fallback_automatico' end as scope from orders left join r on k = o_orderkey""",
)
def _(spark, sf):
    l = v.table(spark, sf, "lineitem")
    doc = F.col("l_orderkey").cast("string").alias("document_id")
    n = F.col("l_linenumber")
    rules = l.select(
        doc, F.when(F.col("l_returnflag") == "R", "reprovada").otherwise("aprovada").alias("status"),
        F.when(n == 1, "arquivo_existe").when(n == 2, "linha_existe_em_tabela").when(n == 3, "perfil_colunas_periodo_existe_em_tabela").otherwise("outra").alias("tipo_teste"), F.lit(False).alias("profile_open"),
    )
    audit = l.select(doc, (F.col("l_quantity") > 40).alias("obrigatorio"), F.when(F.col("l_linestatus") == "O", "nao_resolvido").otherwise("resolvido").alias("status_resolucao"))
    runs = v.runs(spark, sf).select("document_id", F.when((F.col("run_status") == "P") & (F.col("seq") % 4 == 0), "compativel").when(F.col("run_status") == "P", "outro").otherwise("incompativel").alias("status"))
    return rp.classify_failures(runs, rules, audit).select("document_id", "scope")


def _vocabulary(spark, sf):
    rows = [("metric", "vendas", "vendas", "vendas"), ("indicator", "vendas", "liquidas", "Vendas Líquidas"), ("indicator", "lancamentos", "unidades", "Unidades Lançadas"), ("metric", "lancamentos", "lancamentos", "lancamentos"), ("entity", "papel", "periodo_referencia", "trimestre atual")]
    words = spark.createDataFrame(rows, "kind string, metric string, name string, term string")
    return q_contract.contracts(spark, sf).select("domain", "version").crossJoin(F.broadcast(words))


@query(
    "g3_search_terms",
    f"""with {q_contract.SEG}, t as (select unnest(['vendas', 'vendas', 'lancamentos', 'lancamentos', 'vendas', 'lancamentos']) as g, unnest(['vendas', 'vendas liquidas', 'lancamentos', 'unidades lancadas', 'trimestre atual', 'trimestre atual']) as term,
 unnest(['metrica:vendas', 'indicador:liquidas', 'metrica:lancamentos', 'indicador:unidades', 'entidade:papel', 'entidade:papel']) as origin) select domain, 'balancos.' || g || '.dados.valores.valor' as path, term, origin from seg, t""",
)
def _(spark, sf):
    return rp.search_terms(ct.requirements(q_contract.contracts(spark, sf)), _vocabulary(spark, sf)).select("domain", "path", "term", "origin")


def _benchmark_terms(spark, sf):
    """The longest word of every benchmark passage is a search term of one of three requirements."""
    b = v.table(spark, sf, "benchmark").select("item_id", F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("term")).where("length(term) >= 3")
    longest = b.groupBy("item_id").agg(F.max_by("term", F.struct(F.length("term"), "term")).alias("term"))
    return longest.select(F.concat(F.lit("req"), (F.col("item_id") % 3).cast("string")).alias("path"), "term").distinct()


def _document_artifacts(spark, sf):
    d = v.table(spark, sf, "documents")
    return d.select(
        F.lit("lote").alias("document_id"), F.col("doc_id").cast("string").alias("artifact"), F.when(F.col("doc_id") % 4 == 0, F.col("text")).otherwise(F.substring_index("text", "\n", 2)).alias("summary"), (F.col("doc_id") % 4 == 0).alias("complete"),
        F.when(F.col("doc_id") % 7 != 1, F.col("text")).alias("full_text"),
    )


_TERMS = """w as (select item_id, unnest(string_split_regex(lower(text), '[^a-z]+')) as term from benchmark), terms as (select distinct 'req' || (item_id % 3) as path, arg_max(term, (length(term), term)) as term from w where length(term) >= 3 group by item_id),
art as (select cast(doc_id as varchar) as artifact, doc_id % 4 = 0 as complete, doc_id % 7 <> 1 as readable, """ + NORMAL.format(t="(case when doc_id % 4 = 0 then text else array_to_string(string_split(text, chr(10))[1:2], chr(10)) end)") + """ as s, """ + NORMAL.format(t="text") + """ as f from documents)"""


@query(
    "g4_prefiltered_evidence",
    f"""with {_TERMS}, hs as (select artifact, path, string_agg(term, ',' order by term) as terms from art join terms on contains(s, term) group by 1, 2),
 hf as (select artifact, path, string_agg(term, ',' order by term) as terms from art join terms on contains(f, term) where not complete and readable group by 1, 2)
 select artifact, path, 'termo_casado' as reason, 'resumo' as source, terms from hs union all select artifact, path, 'termo_casado', 'artefato_completo', terms from hf anti join hs using (artifact, path)
 union all select artifact, path, 'amostra_incompleta', null, '' from (select artifact, path from art, (select distinct path from terms) where not complete and not readable) anti join hs using (artifact, path)""",
)
def _(spark, sf):
    out = rp.prefilter(_benchmark_terms(spark, sf), _document_artifacts(spark, sf))
    return out.select("artifact", "path", "reason", "source", F.array_join("terms", ",").alias("terms"))


@query(
    "g5_pruned_evidence",
    """with a as (select o_custkey, count(distinct case when o_orderstatus = 'F' then 'a' when o_orderstatus = 'O' then 'b' end) as have from orders group by 1) select cast(o_orderkey as varchar) as artifact, o_orderstatus in ('F', 'O') or have < 2 as kept from orders join a using (o_custkey)""",
)
def _(spark, sf):
    r = v.runs(spark, sf)
    s = F.col("run_status")
    anchors = r.select(F.col("entity").alias("document_id"), F.lit("u").alias("unit"), F.col("document_id").alias("artifact"), F.when(s == "F", "Margem-Financeira Gerencial").when(s == "O", "Lucro Líquido").otherwise("Qualidade").alias("anchor"))
    terms = spark.createDataFrame([("u", "margem", "margem financeira"), ("u", "lucro", "lucro líquido"), ("u", "x", "ab")], "unit string, indicator string, term string")
    required = spark.createDataFrame([("u", "margem"), ("u", "lucro")], "unit string, indicator string")
    return rp.prune_evidence(anchors, terms, required).select("artifact", "kept")


@query(
    "g6_selection_checks",
    """with s as (select l_orderkey as k, l_partkey as a, l_linenumber as n, p_name from lineitem join part on p_partkey = l_partkey)
 select cast(k as varchar) as document_id, 'outside_inventory' as rule, count(distinct a) as n from s where a % 10 = 3 group by 1
 union all select cast(k as varchar), 'too_many', 1 from s group by 1 having count(distinct a) > 5
 union all select cast(k as varchar), 'field_outside_contract', 1 from s where n = 7 group by 1
 union all select cast(k as varchar), 'anchor_missing', count(*) from s where n = 2 group by 1
 union all select cast(k as varchar), 'required_uncovered', 1 from s group by 1 having count(*) filter (where n = 1) = 0""",
)
def _(spark, sf):
    # Read many times: lines meet the parts once, and not as a table that is sent out.
    l = v.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber").join(shuffled(v.table(spark, sf, "part").select("p_partkey", "p_name")), F.col("l_partkey") == F.col("p_partkey"))
    l = checkpointed(l.drop("p_partkey"))
    doc, art, n = F.col("l_orderkey").cast("string").alias("document_id"), F.col("l_partkey").cast("string").alias("artifact"), F.col("l_linenumber")
    selection = l.select(doc, art, F.when(n == 7, "z").when(n == 1, "req").otherwise("opt").alias("path"), F.when(n == 2, "ausente no texto").otherwise(F.upper(F.substring("p_name", 2, 4))).alias("anchor"))
    inventory = l.where("l_partkey % 10 <> 3").select(doc, art).distinct()
    texts = l.select(doc, art, F.col("p_name").alias("full_text")).distinct()
    fields = spark.createDataFrame([("req",), ("opt",)], "path string")
    candidates = selection.where("false").select("document_id", "path", "artifact")
    out = rp.check_selection(selection, inventory, texts, fields.where("path = 'req'"), candidates, fields, 5)
    return out.groupBy("document_id", "rule").agg(F.count(F.lit(1)).alias("n"))


def supplier_identities(spark, sf):
    s = suppliers(spark, sf)
    q = F.col("document_id").cast("bigint") % 4 + 1
    return s.select(
        F.lit("d").alias("domain"), F.lit("1").alias("version"), "document_id",
        F.create_map(F.lit("entidade"), F.concat(F.lit("Fornecedor "), "document_id"), F.lit("periodo"), F.concat(q.cast("string"), F.lit("T1998"))).alias("identity"),
    )


def supplier_roles(spark, sf):
    role = ct.roles(q_contract.contracts(spark, sf)).drop("domain", "version").distinct().withColumns({"domain": F.lit("d"), "version": F.lit("1")})
    structure = tb.table_structure(*structure_inputs(spark, sf))
    return structure, rp.column_roles(structure, ct.expected_periods(role, supplier_identities(spark, sf)))


@query(
    "g8_column_roles",
    f"""{PERIOD}, t as (select distinct document_id, table_id, cast(document_id as bigint) % 4 as q from cells), r as (select unnest({list(q_contract.ROLES)!r}) as role, unnest([0, 1, 4]) as back)
 select document_id, table_id, role, 'resolvido' as verdict, cast(12 + q + 1 - back as integer) as column_index, ((12 + q - back) % 4 + 1) || 'T' || (1995 + (12 + q - back) // 4) as column_header from t, r""",
)
def _(spark, sf):
    return supplier_roles(spark, sf)[1].select("document_id", "table_id", "role", "verdict", "column_index", "column_header")


def _group_terms(spark):
    rows = [("vendas", "title", "vendas"), ("lancamentos", "title", "lançamentos"), ("vendas", "row", "vendas contratadas"), ("vendas", "row", "vendas líquidas"), ("lancamentos", "row", "unidades")]
    return spark.createDataFrame(rows, "metric string, use string, term string")


@query(
    "g9_table_groups",
    f"""{PERIOD}, t as (select document_id, table_id, count(distinct row_index) filter (where row_index in (0, 1)) as v, count(distinct row_index) filter (where row_index = 2) as u from amounts group by 1, 2)
 select document_id, table_id, case when cast(document_id as bigint) % 2 = 0 then table_id when v > u then 'vendas' else 'lancamentos' end as metric from t where cast(document_id as bigint) % 2 = 0 or v <> u""",
)
def _(spark, sf):
    tables = v.period_tables(spark, sf).withColumn("name", F.when(F.col("document_id").cast("bigint") % 2 == 0, F.col("name")).otherwise("Tabela 3"))
    cells = v.period_cells(spark, sf)
    structure = tb.table_structure(cells, tables)
    return rp.table_groups(tables, tb.row_labels(cells, structure), _group_terms(spark))


def _anchors(spark, sf):
    cells, tables = v.period_cells(spark, sf), v.period_tables(spark, sf)
    labels = tb.row_labels(cells, tb.table_structure(cells, tables))
    groups = tables.select("document_id", "table_id", F.col("table_id").alias("metric"))
    asks = F.array(
        F.struct(F.lit("a").alias("request"), F.lit("vendas").alias("metric"), F.lit("vendas contratadas").alias("term")),
        F.struct(F.lit("b").alias("request"), F.lit("lancamentos").alias("metric"), F.lit("número de unidades").alias("term")),
        F.struct(F.lit("c").alias("request"), F.lit(None).cast("string").alias("metric"), F.lit("vendas líquidas").alias("term")),
        F.struct(F.lit("d").alias("request"), F.lit("vendas").alias("metric"), F.lit("vendas líquidas").alias("term")),
    )
    docs = suppliers(spark, sf)
    asked = docs.select("document_id", F.explode(asks).alias("s")).select("document_id", "s.*")
    who = docs.select("document_id", F.when(F.col("document_id").cast("bigint") % 2 == 0, "Unidades").otherwise("Nenhuma").alias("entity"))
    return rp.row_anchors(labels, groups, asked, who)


@query(
    "g10_row_anchors",
    f"""{PERIOD}, p as (select distinct document_id, table_id, row_index from amounts), e as (select document_id, cast(document_id as bigint) % 2 = 0 as ent from (select distinct document_id from amounts)),
 h as (select p.document_id, 'a' as request, p.table_id, case when ent and exists (select 1 from p z where z.document_id = p.document_id and z.table_id = p.table_id and z.row_index = 2) then 2 else 0 end as row_index from p join e using (document_id) where table_id = 'vendas' and row_index = 0
 union all select document_id, 'b', table_id, 2 from p where table_id = 'lancamentos' and row_index = 2
 union all select p.document_id, x.r, p.table_id, case when ent and exists (select 1 from p z where z.document_id = p.document_id and z.table_id = p.table_id and z.row_index = 2) then 2 else 1 end from p join e using (document_id), (values ('c'), ('d')) x(r) where row_index = 1 and (x.r = 'c' or table_id = 'vendas'))
 select document_id, request, min(table_id) as table_id, min(row_index) as row_index from h group by 1, 2 having count(*) = 1""",
)
def _(spark, sf):
    return _anchors(spark, sf).select("document_id", "request", "table_id", "row_index")


@query(
    "g11_attached_anchors",
    f"""{PERIOD}, d as (select distinct document_id, cast(document_id as bigint) % 4 as q from amounts), k as (select distinct document_id from amounts where table_id = 'lancamentos' and row_index = 2)
 select d.document_id, t as target, case when t = 'b1' and k.document_id is not null then 2 end as row_index, case when t = 'b1' and k.document_id is not null then cast(12 + q + 1 as integer) end as column_index from d left join k using (document_id), (values ('b1'), ('b2')) x(t)""",
)
def _(spark, sf):
    entries = F.array(*[F.struct(F.lit(t).alias("target"), F.lit("b").alias("request"), F.lit(r).alias("target_role"), F.lit("item").alias("array_mode")) for t, r in (("b1", "valor"), ("b2", "contexto"))])
    targets = suppliers(spark, sf).select("document_id", F.explode(entries).alias("e")).select("document_id", "e.*", F.create_map(F.lit("papel_periodo"), F.lit("periodo_referencia")).alias("selectors"))
    _, roles = supplier_roles(spark, sf)
    return rp.attach_anchors(targets, _anchors(spark, sf), roles).select("document_id", "target", "row_index", "column_index")


def candidate_mappings(spark, sf):
    keys = q_contract.proposed(spark, sf)
    m = mapping(keys, 1, F.col("mapping_path"), "celula_de_tabela", "vendas", valor_aceito=F.when(F.col("document_id").cast("bigint") % 6 != 1, "Vendas"), indice_coluna_esperado=F.when(F.col("document_id").cast("bigint") % 8 != 1, 1))
    ids = q_contract.identities(spark, sf).select("document_id", "domain", "version")
    return m.join(ids, "document_id")


@query(
    "g12_candidate_checks",
    f"""with {q_contract.TARGETS}, {q_contract.PROPOSED}, n as (select *, cast(document_id as bigint) as k from newest)
 select document_id, rule, count(*) as n from (
 select document_id, 'path_outside_schema' as rule from proposed where mapping_path = 'balancos.nada'
 union all select document_id, 'array_without_selector' from proposed where mapping_path like '%.valores.valor'
 union all select document_id, 'column_index_missing' from proposed where cast(document_id as bigint) % 8 = 1 union all select document_id, 'row_label_missing' from proposed where cast(document_id as bigint) % 6 = 1
 union all select document_id, 'scope_not_allowed' from n where k % 10 = 0 union all select document_id, 'lineage' from n where k % 11 = 0 union all select document_id, 'final_value' from n where k % 13 = 0
 union all select p.document_id, 'unexpected_key' from proposed p anti join targets t on t.document_id = p.document_id and t.target = p.mapping_path
 union all select t.document_id, 'required_not_covered' from targets t anti join proposed p on t.document_id = p.document_id and t.target = p.mapping_path where required) group by 1, 2""",
)
def _(spark, sf):
    ids = q_contract.identities(spark, sf)
    k = F.col("document_id").cast("bigint")
    candidates = ids.select(
        "document_id", F.when(k % 10 == 0, rp.TOTAL).otherwise(rp.PARTIAL).alias("scope"), F.lit(rp.PARTIAL).alias("allowed_scope"),
        F.when(k % 11 == 0, "outro").otherwise(F.col("document_id")).alias("candidate_document"), F.lit("e").alias("candidate_execution"), F.lit("e").alias("execution_id"),
        F.lit("b").alias("candidate_base"), F.lit("b").alias("base_key"), F.expr("cast(array() as array<string>)").alias("extra_sections"),
        F.when(k % 13 == 0, '{"valor_final": 1}').otherwise('{"a": "valor_final"}').alias("payload"),
    )
    f = ct.flatten_contracts(q_contract.contracts(spark, sf))
    out = rp.check_candidates(candidates, candidate_mappings(spark, sf), f["paths"], f["keys"], targets=q_contract.targets(spark, sf))
    return out.groupBy("document_id", "rule").agg(F.count(F.lit(1)).alias("n"))


@query(
    "g13_required_absences",
    f"with {q_contract.NEWEST} select document_id, unnest(['balancos.lancamentos.dados.valores.valor', 'balancos.outro']) as path, unnest(['undeclared', 'invalid']) as problem from newest where cast(document_id as bigint) % 3 <> 0 union all select document_id, 'balancos.outro', 'invalid' from newest where cast(document_id as bigint) % 3 = 0",
)
def _(spark, sf):
    reqs = _one_contract(spark, sf)
    missing = rp.missing_observations(reqs, q_contract.proposed(spark, sf), required=True)
    declared = q_contract.identities(spark, sf).select("document_id", F.lit("balancos.outro").alias("path"), F.expr("cast(array() as array<string>)").alias("selectors"))
    return rp.absence_check(missing, declared).select("document_id", "path", "problem")


def _one_contract(spark, sf):
    """Requirements of the contract text once; every domain here carries the same one."""
    first = q_contract.contracts(spark, sf).groupBy("version").agg(F.min("domain").alias("domain"), F.min("contract").alias("contract"))
    return ct.requirements(first)


@query(
    "g14_optional_gaps",
    f"with {q_contract.NEWEST} select document_id, cast(case when cast(document_id as bigint) % 5 = 0 then 7 else 8 end as bigint) as n_gaps, cast(0 as bigint) as n_orphans from newest",
)
def _(spark, sf):
    mapped = q_contract.proposed(spark, sf)
    gaps = rp.missing_observations(_one_contract(spark, sf), mapped, required=False)
    orphans = rp.orphan_context(gaps, mapped).groupBy("document_id").agg(F.count(F.lit(1)).alias("n_orphans"))
    n = gaps.groupBy("document_id").agg(F.count(F.lit(1)).alias("n_gaps"))
    return n.join(orphans, "document_id", "left").select("document_id", "n_gaps", F.coalesce("n_orphans", F.lit(0).cast("bigint")).alias("n_orphans"))


@query(
    "g15_merged_fragments",
    "select 'merged' as kind, count(*) as n from (select l_orderkey, l_partkey from lineitem group by 1, 2 having count(*) = 1) union all select 'clash', count(*) from (select l_orderkey, l_partkey from lineitem group by 1, 2 having count(*) > 1)",
)
def _(spark, sf):
    l = v.table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("document_id"), F.col("l_partkey").cast("string").alias("mapping_path"), F.col("l_suppkey").alias("unit"))
    merged, clash = rp.merge_fragments(l)
    return merged.agg(F.count(F.lit(1)).alias("n")).select(F.lit("merged").alias("kind"), "n").unionByName(clash.agg(F.count(F.lit(1)).alias("n")).select(F.lit("clash").alias("kind"), "n"))


@query(
    "g16_fragment_scope",
    f"with {q_contract.NEWEST} select document_id, unnest(['balancos.vendas.dados[empresa=x]', 'fonte']) as mapping_path, unnest(['incompleto', 'fora']) as problem from newest",
)
def _(spark, sf):
    keys = F.array(*[F.lit(k) for k in ("balancos.vendas.dados[empresa=x]", "fonte", "balancos.vendas.dados[empresa=x].valores[papel_periodo=y].valor")])
    m = q_contract.identities(spark, sf).select("document_id", F.lit("balancos").alias("root"), F.explode(keys).alias("mapping_path"))
    units = ct.unit_paths(_one_contract(spark, sf)).select("root", "path").distinct()
    return rp.fragment_scope(m, units).select("document_id", "mapping_path", "problem")


@query(
    "g17_revalidation_gate",
    """with a as (select l_orderkey as k, count(*) filter (where l_returnflag = 'R' and l_linestatus = 'O') as n from lineitem group by 1) select cast(o_orderkey as varchar) as document_id, o_orderstatus = 'F' and coalesce(n, 0) = 0 as approved,
 case when n is null then 'AUDITORIA_REVALIDACAO_AUSENTE' when n > 0 then 'OBRIGATORIOS_NAO_RESOLVIDOS_NA_REVALIDACAO' end as alert from orders left join a on k = o_orderkey""",
)
def _(spark, sf):
    l = v.table(spark, sf, "lineitem")
    audit = l.select(F.col("l_orderkey").cast("string").alias("document_id"), (F.col("l_returnflag") == "R").alias("obrigatorio"), F.when(F.col("l_linestatus") == "F", "resolvido").otherwise("erro").alias("status_resolucao"))
    checks = v.runs(spark, sf).select("document_id", F.when(F.col("run_status") == "F", "compativel").otherwise("incompativel").alias("status"))
    return rp.revalidation_gate(checks, audit).select("document_id", "approved", "alert")


@query(
    "g18_published_layouts",
    """with n as (select o_custkey, o_orderpriority as item, max(o_orderkey) as k from orders where o_orderdate >= timestamp '2000-01-01' group by 1, 2), b as (select o_custkey, o_orderpriority as item, max(o_orderkey) as k from orders where o_orderdate < timestamp '2000-01-01' and o_custkey in (select o_custkey from n) group by 1, 2)
 select cast(o_custkey as varchar) as entity, coalesce(n.item, b.item) as item, coalesce(n.k, b.k) as body, 'v1.' || (o_custkey % 5 + 1) || '.0' as version from n full join b using (o_custkey, item)""",
)
def _(spark, sf):


    o = v.table(spark, sf, "orders")
    keyed = o.select(F.lit("d").alias("domain"), F.col("o_custkey").cast("string").alias("entity"), F.lit("mapeamento").alias("section"), F.col("o_orderpriority").alias("item"), "o_orderkey", "o_orderdate", "o_custkey")
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    by = ["domain", "entity", "section", "item"]
    old = keyed.where(F.col("o_orderdate") < cut).groupBy(*by).agg(F.max("o_orderkey").alias("body"))
    new = keyed.where(F.col("o_orderdate") >= cut).groupBy(*by).agg(F.max("o_orderkey").alias("body"))
    stored = keyed.select("domain", "entity", F.concat(F.lit("layouts/v1."), (F.col("o_custkey") % 5).cast("string"), F.lit(".0/l.json")).alias("k")).distinct()
    rows, _ = rp.publish_layouts(old, new, next_minor_version(stored, ["domain", "entity"], "k"))
    return rows.select("entity", "item", "body", "version")
