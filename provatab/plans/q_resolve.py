"""Layout mappings of every supplier against its tables, and of orders and documents."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provatab.cluster import dealt
from provatab.operators import assemble as asm
from provatab.operators import resolve as rs
from provatab.operators.contract import contract_nodes
from provatab.plans import views as v
from provatab.plans.registry import query

PERIOD = f"with {v.PERIOD_SQL}"
_COLUMNS = {
    "valor_fixo": "string", "campo_origem": "string", "caminho_json": "string", "block_id": "string", "padrao": "string", "coluna_rotulo": "int", "valor_aceito": "string",
    "indice_linha_esperado": "int", "indice_coluna_esperado": "int", "escopo_periodo": "string",
}


def mapping(df, ord_, path, kind, file=None, required=True, **fields):
    """One mapping per row of ``df`` (documents)."""
    values = {c: F.lit(None).cast(t) for c, t in _COLUMNS.items()}
    values.update({c: (x if not isinstance(x, (str, int)) else F.lit(x)).cast(_COLUMNS[c]) for c, x in fields.items()})
    return df.select(
        "document_id", F.lit(ord_).alias("ord"), (F.lit(path) if isinstance(path, str) else path).alias("mapping_path"), F.lit(kind).alias("tipo_origem"),
        (F.lit(file).cast("string") if file is None or isinstance(file, str) else file).alias("arquivo_origem"), F.lit(required).alias("obrigatorio"), *[x.alias(c) for c, x in values.items()],
    )


def suppliers(spark, sf):
    return v.table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("document_id")).distinct()


def synonyms(spark):
    rows = [
        ("i1", "indicator", "numero_de_unidades", "vendas", t) for t in ("numero_de_unidades", "Número de Unidades", "unidades vendidas")
    ] + [("i2", "indicator", "vendas_brutas", "vendas", t) for t in ("vendas_brutas", "Vendas Contratadas Brutas", "VGV bruto")]
    return spark.createDataFrame(rows, "group_id string, kind string, name string, metric string, term string")


def supplier_mappings(spark, sf):
    """Cells of every quarter for three indicators in two tables: by exact label, by synonym in
    the label, and by a selector of the path that names the indicator."""
    docs = dealt(suppliers(spark, sf), 28 * 2 * 3)
    grid = docs.select("document_id", F.explode(F.sequence(F.lit(1), F.lit(28))).alias("c"), F.lit(0).alias("z"))
    grid = grid.select("*", F.explode(F.array(F.lit("vendas"), F.lit("lancamentos"))).alias("t"))
    asks = (("Vendas Líquidas 100%", "liquidas", 1), ("unidades vendidas", "unidades", 2), ("nada", "vendas_brutas", 0))
    parts = [
        mapping(
            grid.withColumn("ord", F.lit(0)), 0, F.concat(F.lit(f"g[indicador={name}].valores[q="), F.col("c").cast("string"), F.lit("].valor")), "celula_de_tabela", F.col("t"),
            valor_aceito=label, coluna_rotulo=0, indice_coluna_esperado=F.col("c"),
        ).withColumn("ord", F.col("indice_coluna_esperado") * 10 + row + F.when(F.col("arquivo_origem") == "vendas", 1000).otherwise(0))
        for label, name, row in asks
    ]
    return reduce(DataFrame.unionByName, parts)


_ASKED = """asked as (select document_id, table_id, row_index, column_index from (select distinct cast(l_suppkey as varchar) as document_id from lineitem), (select unnest(['vendas', 'lancamentos']) as table_id), (select unnest([0, 1, 2]) as row_index), (select unnest(range(1, 29)) as column_index))"""


@query(
    "f8_resolved_cells",
    f"""{PERIOD}, {_ASKED} select a.document_id, a.table_id, cast(a.row_index as integer) as row_index, ((a.column_index - 1) % 4 + 1) || 'T' || (1995 + (a.column_index - 1) // 4) as period, c.cents, case when cents is null then 'nao_resolvido' else 'resolvido' end as status, a.row_index <> 1 as by_synonym
 from asked a left join cells c using (document_id, table_id, row_index, column_index)
 where exists (select 1 from cells k where k.document_id = a.document_id and k.table_id = a.table_id and k.row_index = a.row_index)""",
)
def _(spark, sf):
    """Published value of each indicator and quarter of every supplier, with its audit status."""
    found = rs.table_cells(supplier_mappings(spark, sf), v.period_cells(spark, sf), v.period_headers(spark, sf), synonyms(spark))
    return found.where("row_index is not null").select(
        "document_id", F.col("arquivo_origem").alias("table_id"), "row_index", F.col("periodo").alias("period"), F.round(F.col("valor") * 100).cast("bigint").alias("cents"),
        F.when(F.col("valor").isNull(), "nao_resolvido").otherwise("resolvido").alias("status"), "by_synonym",
    )


@query(
    "f8p_projected_cells",
    f"{PERIOD}, {_ASKED} select a.document_id, case when c.cents is null then 'nao_resolvido' else 'resolvido' end as status, count(*) as n from asked a left join cells c using (document_id, table_id, row_index, column_index) group by 1, 2",
)
def _(spark, sf):
    found = rs.table_cells(supplier_mappings(spark, sf), v.period_cells(spark, sf), v.period_headers(spark, sf), synonyms(spark))
    types = spark.createDataFrame([("g.valores.valor", "number | null")], "path string, descriptor string")
    out = rs.project_cells(found, types)
    return out.groupBy("document_id", F.col("status_resolucao").alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "f2_fixed_values",
    "select distinct cast(l_suppkey as varchar) as document_id, case when l_suppkey % 2 = 0 then 'unidades' end as value, 'resolvido' as status from lineitem",
)
def _(spark, sf):
    m = mapping(suppliers(spark, sf), 1, "unidade", "valor_fixo", valor_fixo=F.when(F.col("document_id").cast("bigint") % 2 == 0, "unidades"))
    return rs.fixed_values(m).select("document_id", F.col("valor_resolvido").alias("value"), F.col("status_resolucao").alias("status"))


@query(
    "f3_derived_fields",
    """with d as (select distinct cast(l_suppkey as varchar) as document_id from lineitem) select document_id, unnest([2, 3, 4, 5]) as ord, unnest(['v' || document_id, 'v' || document_id, 'v' || document_id, null]) as value from d""",
)
def _(spark, sf):
    docs = suppliers(spark, sf)
    base = mapping(docs, 1, "a", "valor_fixo", valor_fixo=F.concat(F.lit("v"), "document_id"))
    chain = [mapping(docs, i, p, "campo_derivado", campo_origem=o) for i, p, o in ((2, "b", "a"), (3, "c", "b"), (4, "d", "c"), (5, "e", "z"))]
    out = rs.derived_fields(reduce(DataFrame.unionByName, chain), rs.fixed_values(base))
    return out.select("document_id", "ord", F.col("valor_resolvido").alias("value"))


@query("f4_json_fields", "select cast(event_id as varchar) as document_id, json_extract_string(props, '$.k') as value, 'resolvido' as status from events")
def _(spark, sf):
    e = v.table(spark, sf, "events")
    docs = e.select(F.col("event_id").cast("string").alias("document_id"))
    artifacts = e.select(F.col("event_id").cast("string").alias("document_id"), F.lit("p.json").alias("arquivo_origem"), F.concat(F.lit('{"a":'), "props", F.lit("}")).alias("payload"))
    out = rs.json_fields(mapping(docs, 1, "k", "campo_json", "p.json", caminho_json="a.k"), artifacts)
    return out.select("document_id", F.col("valor_resolvido").alias("value"), F.col("status_resolucao").alias("status"))


@query(
    "f5_text_block_patterns",
    f"with {v.ITEMS_SQL}, h as (select document_id, arg_min(regexp_extract(text, '[aeiou]{{3,}}[a-z]*'), order_index) as val from items where regexp_matches(text, '[aeiou]{{3,}}[a-z]*') group by 1) select d.document_id, val as value from (select distinct document_id from items) d left join h using (document_id)",
)
def _(spark, sf):
    items = v.items(spark, sf)
    docs = items.select("document_id").distinct()
    blocks = items.select("document_id", F.col("self_ref").alias("block_id"), "order_index", "text")
    out = rs.text_blocks(mapping(docs, 1, "x", "bloco_textual", padrao="[aeiou]{3,}[a-z]*"), blocks)
    return out.select("document_id", F.col("valor_resolvido").alias("value"))


@query(
    "f6_block_records",
    """select cast(l_orderkey as varchar) as document_id, l_linenumber as record, sum(cast(round(l_extendedprice * 100) as bigint))::bigint as cents, count(*) as n, 'BRL' as moeda from lineitem group by 1, 2""",
)
def _(spark, sf):
    l = v.table(spark, sf, "lineitem").withColumn("block_id", F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").cast("string"), "l_shipdate"))
    doc = F.col("l_orderkey").cast("string").alias("document_id")
    blocks = l.select(doc, "block_id", F.concat(F.lit("receita de R$ "), v.ptbr(v.cents(F.col("l_extendedprice"))), F.lit(" no item")).alias("text"))
    spec = F.array(
        F.struct(F.lit("valor").alias("path"), F.lit(None).cast("string").alias("fixed"), F.lit("R\\$ ([\\d.,]+)").alias("padrao"), F.lit(1).alias("grupo"), F.lit("numero").alias("tipo")),
        F.struct(F.lit("moeda").alias("path"), F.lit("BRL").alias("fixed"), F.lit("x").alias("padrao"), F.lit(0).alias("grupo"), F.lit("texto").alias("tipo")),
    )
    fields = l.select(doc, F.lit(1).alias("ord"), F.col("l_linenumber").alias("record"), "block_id", F.explode(spec).alias("s")).select("document_id", "ord", "record", "block_id", "s.*")
    out = rs.block_records(fields, blocks)
    return out.groupBy("document_id", "record").agg(
        F.sum(F.when(F.col("path") == "valor", F.round(F.col("value").cast("double") * 100).cast("bigint"))).alias("cents"), F.count_if(F.col("path") == "valor").alias("n"),
        F.max(F.when(F.col("path") == "moeda", F.col("value"))).alias("moeda"),
    )


@query(
    "f7_table_headers",
    "with d as (select distinct cast(l_suppkey as varchar) as document_id from lineitem where l_linestatus = 'F') select document_id, unnest([1, 2]) as ord, unnest(['4T1995', null]) as value, unnest(['resolvido', 'nao_resolvido']) as status from d",
)
def _(spark, sf):
    docs = v.period_tables(spark, sf).where("table_id = 'vendas'").select("document_id")
    m = mapping(docs, 1, "p", "cabecalho_de_tabela", "vendas", indice_coluna_esperado=4).unionByName(mapping(docs, 2, "q", "cabecalho_de_tabela", "vendas", indice_coluna_esperado=77))
    return rs.table_headers(m, v.period_headers(spark, sf)).select("document_id", "ord", F.col("valor_resolvido").alias("value"), F.col("status_resolucao").alias("status"))


@query(
    "f9_table_rows",
    """with n as (select l_orderkey, count(*) as n from lineitem group by 1) select cast(l_orderkey as varchar) as document_id, r as row_index, cast(r as varchar) as posicao, cast(cast(q as bigint) as varchar) as quantidade, 'seg' as segmento from (
 select l_orderkey, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) - 1 as r, l_quantity as q from lineitem) join n using (l_orderkey) where r >= 1 and n > 1""",
)
def _(spark, sf):
    cells = v.order_cells(spark, sf)
    sizes = cells.where("column_index = 0").groupBy("document_id", "table_id").agg(F.count(F.lit(1)).cast("int").alias("row_count"))
    none = F.lit(None).cast("int")
    seg = sizes.select("document_id", F.lit(1).alias("ord"), F.lit(0).alias("source_ord"), F.lit(0).alias("segment"), "table_id", F.lit(1).alias("first_row"), none.alias("last_row"), F.create_map(F.lit("segmento"), F.lit("seg")).alias("fixed"))
    spec = F.array(*[F.struct(F.lit(p).alias("path"), F.lit(t).alias("tipo"), F.lit(c).alias("column_index")) for p, t, c in (("posicao", "posicao", -1), ("quantidade", "numero", 1))])
    fields = sizes.select("document_id", F.lit(1).alias("ord"), F.lit(0).alias("segment"), F.explode(spec).alias("s")).select("document_id", "ord", "segment", "s.*", F.expr("cast(map() as map<string,string>)").alias("replacements"))
    out = rs.table_row_records(seg, fields, cells, sizes)

    def pick(p):
        return F.max(F.when(F.col("path") == p, F.col("value")))

    return out.groupBy("document_id", "row_index").agg(pick("posicao").alias("posicao"), pick("quantidade").cast("double").cast("bigint").cast("string").alias("quantidade"), pick("segmento").alias("segmento")).withColumn("row_index", F.col("row_index").cast("bigint"))


@query(
    "f10_rows_of_tables",
    f"{PERIOD}, t as (select document_id, table_id, count(distinct row_index) as n from amounts group by 1, 2) select document_id, case table_id when 'vendas' then 0 else 1 end as source_ord, cast(sum(least(n, 3)) as bigint) as n_rows from t where n = 3 group by 1, 2",
)
def _(spark, sf):
    cells = v.period_cells(spark, sf)
    n = cells.where("column_index = 0").groupBy("document_id", "table_id").agg(F.count(F.lit(1)).cast("int").alias("row_count"))
    order = F.when(F.col("table_id") == "vendas", 0).otherwise(1)
    seg = n.select("document_id", F.lit(1).alias("ord"), order.alias("source_ord"), order.alias("segment"), "table_id", F.lit(0).alias("first_row"), F.lit(2).alias("last_row"), F.create_map(F.lit("modalidade"), F.col("table_id")).alias("fixed"))
    fields = n.select("document_id", F.lit(1).alias("ord"), order.alias("segment"), F.lit("rotulo").alias("path"), F.lit("texto").alias("tipo"), F.lit(0).alias("column_index"), F.create_map(F.lit("Número de Unidades"), F.lit("Unidades")).alias("replacements"))
    out = rs.table_row_records(seg, fields, cells, n)
    full = out.where("path = 'rotulo' and value is not null")
    counted = full.groupBy("document_id", "source_ord").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where("n_rows = 3")


@query(
    "f11_joined_records",
    """select cast(o_orderkey as varchar) as document_id, c_name as cliente, cast(sum(l_quantity) as bigint) as quantidade, case when o_orderkey % 10 = 7 then 'sete' else 'comum' end as classe, cast(null as varchar) as problem from orders join customer on o_custkey = c_custkey join lineitem on l_orderkey = o_orderkey where o_orderkey % 11 > 0 group by o_orderkey, c_name
 union all select cast(o_orderkey as varchar), null, null, null, case when o_orderkey % 2 = 0 then 'repeated_key:estado,repeated_key:pedidos' else 'repeated_key:estado' end from orders where o_orderkey % 11 = 0""",
)
def _(spark, sf):
    o, c, l = (v.table(spark, sf, t) for t in ("orders", "customer", "lineitem"))
    key = F.col("o_orderkey").cast("string")
    a = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(key.alias("document_id"), key.alias("key"), F.col("c_name").alias("cliente"))
    b = l.groupBy("l_orderkey").agg(F.sum("l_quantity").cast("bigint").alias("quantidade")).select(F.col("l_orderkey").cast("string").alias("document_id"), F.col("l_orderkey").cast("string").alias("key"), "quantidade")
    d = o.select(key.alias("document_id"), F.when(F.col("o_orderkey") >= 0, key).alias("key"), F.col("o_orderstatus").alias("status"))
    # Every eleventh key is there twice in one source, and if even in two.
    a = a.unionByName(a.where(F.col("key").cast("bigint") % 22 == 0))
    d = d.unionByName(d.where(F.col("key").cast("bigint") % 11 == 0))
    out = rs.joined_records({"pedidos": a, "linhas": b, "estado": d}, {"classe": "comum"}, {"7$": {"classe": "sete"}})
    return out.select("document_id", "cliente", "quantidade", "classe", "problem")


@query(
    "f12_row_lookup",
    f"{PERIOD}, t as (select document_id, table_id, row_index from amounts group by 1, 2, 3) select document_id, table_id, case when bool_or(row_index = 1) then 1 else min(row_index) end as row_index from t where row_index in (0, 1) group by 1, 2",
)
def _(spark, sf):
    tables = v.period_tables(spark, sf)
    asked = tables.select(
        "document_id", F.when(F.col("table_id") == "vendas", 1).otherwise(2).alias("ord"), "table_id", F.lit(0).alias("coluna_rotulo"), F.lit("Vendas Contratadas Brutas").alias("valor_aceito"), F.lit(1).alias("indice_linha_esperado")
    )
    labels = asked.select("document_id", "ord", F.explode(F.array(F.lit("vendas contratadas brutas"), F.lit("vendas liquidas 100%"))).alias("label"))
    return rs.lookup_rows(asked, labels, v.period_cells(spark, sf)).select("document_id", "table_id", "row_index")


@query(
    "f13_expanded_labels",
    "select distinct cast(l_suppkey as varchar) as document_id, unnest(['unidades vendidas', 'numero_de_unidades', 'numero de unidades']) as label from lineitem",
)
def _(spark, sf):
    m = mapping(suppliers(spark, sf), 1, "a.b", "celula_de_tabela", "vendas", valor_aceito="Unidades  VENDIDAS")
    return rs.expand_labels(m, synonyms(spark)).select("document_id", "label")


@query("f14_literal_first", "select distinct cast(l_suppkey as varchar) as document_id, 'unidades' as value, cast(1 as bigint) as rest from lineitem")
def _(spark, sf):
    docs = suppliers(spark, sf)
    m = mapping(docs, 1, "g[x=1].unidade", "valor_fixo", valor_fixo="errado").unionByName(mapping(docs, 2, "g[x=1].valor", "valor_fixo", valor_fixo="1"))
    nodes = spark.createDataFrame([("g.unidade", "unidades")], "path string, literal string")
    nodes = nodes.withColumns({"domain": F.lit("d"), "version": F.lit("v1.0.0")})
    won, rest = rs.literal_first(m, nodes)
    n = rest.groupBy("document_id").agg(F.count(F.lit(1)).alias("rest"))
    return won.select("document_id", F.col("valor_resolvido").alias("value")).join(n, "document_id")


def supplier_audit(spark, sf):
    found = rs.table_cells(supplier_mappings(spark, sf), v.period_cells(spark, sf), v.period_headers(spark, sf), synonyms(spark))
    types = spark.createDataFrame([("g.valores.valor", "number | null")], "path string, descriptor string")
    return rs.project_cells(found, types)


@query(
    "f1_dispatch",
    """with d as (select distinct l_suppkey as k from lineitem where l_linestatus = 'F'), t as (select unnest(['valor_fixo', 'campo_derivado', 'adivinhar', 'cabecalho_de_tabela', 'linhas_de_tabela', 'cabecalho_de_tabela', 'celula_de_tabela', 'bloco_textual']) as tipo_origem, unnest(['resolvido', 'resolvido', 'nao_suportado', 'resolvido', 'nao_resolvido', 'erro', 'erro', 'erro']) as status)
 select tipo_origem, status, count(*) as n from d, t group by 1, 2""",
)
def _(spark, sf):
    docs = v.period_tables(spark, sf).where("table_id = 'vendas'").select("document_id")
    parts = [
        mapping(docs, 1, "a", "valor_fixo", valor_fixo="1"), mapping(docs, 2, "b", "campo_derivado", campo_origem="a"), mapping(docs, 3, "c", "adivinhar"),
        mapping(docs, 4, "d", "cabecalho_de_tabela", "vendas", indice_coluna_esperado=1), mapping(docs, 5, "e", "linhas_de_tabela", "vendas"),
        mapping(docs, 6, "f", "cabecalho_de_tabela", "nenhuma", indice_coluna_esperado=1), mapping(docs, 7, "h", "celula_de_tabela", valor_aceito="x", indice_coluna_esperado=1),
        mapping(docs, 8, "i", "bloco_textual", padrao="(["),
    ]
    records = docs.select("document_id", F.lit(5).alias("ord"), F.lit(0).alias("n"))
    out = rs.resolve_mappings(reduce(DataFrame.unionByName, parts), {"headers": v.period_headers(spark, sf)}, records=records)
    return out.groupBy("tipo_origem", F.col("status_resolucao").alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "f15_output_rows",
    "with d as (select distinct cast(l_suppkey as varchar) as document_id from lineitem) select document_id, 'g.valores' as array_path, 'empresa=x/papel=ref' as item, cast(3 as bigint) as n_fields, '5' as valor, '2T26' as periodo from d union all select document_id, '', '', 1, null, null from d",
)
def _(spark, sf):
    docs = suppliers(spark, sf)
    base = "g[empresa=x].valores[papel=ref]"
    rows = ((1, f"{base}.periodo", "1T26"), (2, f"{base}.valor", "4"), (3, f"{base}.periodo", "2T26"), (4, "g[empresa=x].valores[periodo=2T26].escopo", "t"), (5, f"{base}.valor", "5"), (6, "fonte", "f"), (7, "zzz", "0"))
    audit = reduce(DataFrame.unionByName, [rs.fixed_values(mapping(docs, i, p, "valor_fixo", valor_fixo=val)) for i, p, val in rows])
    nodes = spark.createDataFrame([("g.valores.periodo",), ("g.valores.valor",), ("g.valores.escopo",), ("fonte",)], "path string")
    out = rs.assemble_rows(rs.output_leaves(audit, nodes))
    return out.select("document_id", "array_path", "item", F.cardinality("fields").cast("bigint").alias("n_fields"), F.try_element_at("fields", F.lit("valor")).alias("valor"), F.try_element_at("fields", F.lit("periodo")).alias("periodo"))


_ORDER_CONTRACT = """{"schema_saida": {"cliente": "string", "fonte": {"moeda": "BRL", "nota": "string | null", "sistema": {"nome": "string"}}, "pedidos": [
 {"id": "string", "estado": "string", "total": "number | null", "chave": "string", "linhas": [{"n": "string", "qtd": "number", "modo": "string | null", "unidade": "pecas"}]}]}}"""


def order_mappings(spark, sf):
    """Per customer: fields of its orders and their lines, orders named by id, by status and by a field they hold."""
    orders = v.table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("document_id"), "o_orderkey", "o_orderstatus", F.floor(F.col("o_totalprice")).cast("bigint").cast("string").alias("total"))
    item = F.concat(F.lit("pedidos[id="), F.col("o_orderkey").cast("string"), F.lit("]"))
    held = F.concat(F.lit("pedidos[chave=k"), F.col("o_orderkey").cast("string"), F.lit("]"))
    lines = v.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").cast("string").alias("qtd"), "l_returnflag")
    lines = lines.groupBy("l_orderkey", "l_linenumber").agg(F.min("qtd").alias("qtd"), F.min("l_returnflag").alias("l_returnflag"))
    lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    line = F.concat(F.when(F.col("l_linenumber") % 2 == 0, held).otherwise(item), F.lit(".linhas[n="), F.col("l_linenumber").cast("string"), F.lit("]"))
    at, seq = F.col("o_orderkey") * 100, F.col("l_linenumber") * 3

    def rows(df, ord_, path, value, keep=F.lit(True)):
        return df.where(keep).select("document_id", ord_.cast("bigint").alias("ord"), path.alias("mapping_path"), value.alias("valor_resolvido"))

    docs = orders.select("document_id").distinct()
    parts = [
        rows(docs, F.lit(1), F.lit("cliente"), F.concat(F.lit('c "'), F.col("document_id"), F.lit('"'))),
        rows(docs, F.lit(2), F.lit("fonte.sistema.nome"), F.lit("erp"), F.col("document_id").cast("bigint") % 3 == 0),
        rows(docs, F.lit(3), F.lit("fora.do.contrato"), F.lit("x")),
        rows(orders, at, F.concat(item, F.lit(".total")), F.lit("0")),
        rows(orders, at + 1, F.concat(item, F.lit(".total")), F.col("total")),
        rows(orders, at + 2, F.concat(item, F.lit(".chave")), F.concat(F.lit("k"), F.col("o_orderkey").cast("string"))),
        rows(orders, at + 3, F.concat(held, F.lit(".estado")), F.col("o_orderstatus")),
        rows(orders, at + 90, held, F.concat(F.lit('{"extra": {"par": true}, "estado": "'), F.col("o_orderstatus"), F.lit('*"}')), F.col("o_orderkey") % 2 == 0),
        rows(lines, at + 10 + seq, F.concat(line, F.lit(".qtd")), F.col("qtd")),
        rows(lines, at + 11 + seq, F.concat(line, F.lit(".modo")), F.col("l_returnflag"), F.col("l_returnflag") != "A"),
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("status_resolucao", F.lit("resolvido")), docs


@query(
    "f15_nested_rows",
    """with o as (select cast(o_custkey as varchar) as document_id, o_orderkey as k, o_orderstatus as s, cast(floor(o_totalprice) as bigint) as total from orders),
 l as (select l_orderkey as k, l_linenumber as n, min(cast(cast(l_quantity as bigint) as varchar)) as qtd, min(l_returnflag) as modo from lineitem group by 1, 2),
 linhas as (select k, string_agg('{"modo":' || case when modo = 'A' then 'null' else '"' || modo || '"' end || ',"n":"' || n || '","qtd":' || qtd || ',"unidade":"pecas"}', ',' order by n) as t from l group by 1),
 pedidos as (select document_id, string_agg('{"chave":"k' || k || '","estado":"' || s || case when k % 2 = 0 then '*' else '' end || '"' || case when k % 2 = 0 then ',"extra":{"par":true}' else '' end
  || ',"id":"' || k || '","linhas":[' || coalesce(t, '') || '],"total":' || total || '}', ',' order by k) as t from o left join linhas using (k) group by 1)
 select document_id, '{"cliente":"c \\"' || document_id || '\\"","fonte":{"moeda":"BRL","nota":null,"sistema":{"nome":' || case when cast(document_id as bigint) % 3 = 0 then '"erp"' else 'null' end || '}},"pedidos":[' || t || ']}' as output from pedidos""",
)
def _(spark, sf):
    audit, docs = order_mappings(spark, sf)
    contracts = spark.createDataFrame([("pedidos", "v1.0.0", _ORDER_CONTRACT)], "domain string, version string, contract string")
    docs = docs.withColumns({"domain": F.lit("pedidos"), "version": F.lit("v1.0.0")})
    return asm.nested_rows(audit, docs, contract_nodes(contracts))


@query(
    "f16_run_summary",
    f"{PERIOD}, {_ASKED} select a.document_id, count(c.cents) as resolved, count(*) - count(c.cents) as failed from asked a left join cells c using (document_id, table_id, row_index, column_index) group by 1",
)
def _(spark, sf):
    return rs.run_summary(supplier_audit(spark, sf), suppliers(spark, sf))


def supplier_rules(spark, sf):
    """Seven rules per supplier, one of each kind and some that fail."""
    docs = suppliers(spark, sf)
    none = F.lit(None)

    def rule(rule_id, kind, file, code, **f):
        return docs.select(
            "document_id", F.lit(rule_id).alias("rule_id"), F.lit(kind).alias("tipo_teste"), F.lit(code).alias("codigo_falha"), F.lit(file).alias("arquivo_origem"),
            f.get("aceitos", none).cast("array<string>").alias("valores_aceitos"), f.get("paginas", none).cast("array<int>").alias("paginas_aceitas"),
            F.lit(0).alias("coluna_rotulo"), F.lit(f.get("linha")).cast("int").alias("indice_linha_esperado"), F.lit(f.get("coluna")).cast("int").alias("indice_coluna_esperado"),
            f.get("colunas", none).cast("array<struct<indice:int,padrao:string>>").alias("colunas_esperadas"),
        )

    columns = F.array(F.struct(F.lit(1), F.lit("[1-4]T[0-9]{4}")), F.struct(F.lit(2), F.lit("^2T")))
    return reduce(
        DataFrame.unionByName,
        [
            rule("r1", "arquivo_existe", "vendas", "SEM_VENDAS"), rule("r2", "arquivo_existe", "outra", "SEM_OUTRA"),
            rule("r3", "secao_existe", "sections", "SEM_SECAO", aceitos=F.array(F.lit("resumo"), F.lit("vendas")), paginas=F.array(F.lit(1))),
            rule("r4", "linha_existe_em_tabela", "vendas", "SEM_LINHA", aceitos=F.array(F.lit("unidades vendidas"))),
            rule("r5", "perfil_colunas_periodo_existe_em_tabela", "vendas", "SEM_PERIODO", colunas=columns),
            rule("r6", "valor_normalizavel", "vendas", "SEM_VALOR", aceitos=F.array(F.lit("Vendas Contratadas Brutas")), coluna=3), rule("r7", "outra_regra", "vendas", "DESCONHECIDA"),
        ],
    )


def rule_results(spark, sf):
    tables = v.period_tables(spark, sf)
    sections = suppliers(spark, sf).select("document_id", F.lit("resumo").alias("title_canonical"), (F.col("document_id").cast("bigint") % 2).cast("int").alias("page_number"))
    evidence = {"artifacts": tables.select("document_id", F.col("table_id").alias("arquivo_origem")), "sections": sections, "cells": v.period_cells(spark, sf), "headers": v.period_headers(spark, sf)}
    return rs.check_rules(supplier_rules(spark, sf), evidence, synonyms(spark))


_RULES = """docs as (select distinct cast(l_suppkey as varchar) as document_id from lineitem),
verdicts as (select d.document_id, r.rule_id, r.kind, case r.rule_id when 'r1' then exists (select 1 from cells c where c.document_id = d.document_id and c.table_id = 'vendas') when 'r2' then false
 when 'r3' then cast(d.document_id as bigint) % 2 = 1 when 'r4' then exists (select 1 from cells c where c.document_id = d.document_id and c.table_id = 'vendas' and c.row_index = 2)
 when 'r5' then exists (select 1 from cells c where c.document_id = d.document_id and c.table_id = 'vendas') when 'r6' then exists (select 1 from cells c where c.document_id = d.document_id and c.table_id = 'vendas' and c.row_index = 0 and c.column_index = 3) else false end as ok
 from docs d, (select unnest(['r1', 'r2', 'r3', 'r4', 'r5', 'r6', 'r7']) as rule_id, unnest(['arquivo_existe', 'arquivo_existe', 'secao_existe', 'linha_existe_em_tabela', 'perfil_colunas_periodo_existe_em_tabela', 'valor_normalizavel', 'outra_regra']) as kind) r)"""


@query("f17_rule_verdicts", f"{PERIOD}, {_RULES} select document_id, rule_id, case when ok then 'aprovada' else 'reprovada' end as status from verdicts")
def _(spark, sf):
    """One verdict per rule."""
    return rule_results(spark, sf).select("document_id", "rule_id", "status")


@query(
    "f22_compatibility",
    f"{PERIOD}, {_RULES} select document_id, case when count(*) filter (where not ok) = 0 then 'compativel' else 'incompativel' end as status, count(*) as rules_total, count(*) filter (where ok) as rules_passed from verdicts group by 1 union all select 'sem_regras', 'compativel', 0, 0",
)
def _(spark, sf):
    runs = suppliers(spark, sf).unionByName(suppliers(spark, sf).limit(1).select(F.lit("sem_regras").alias("document_id")))
    return rs.compatibility(rule_results(spark, sf), runs).select("document_id", "status", "rules_total", "rules_passed")


@query(
    "f23_missing_layouts",
    "select cast(o_orderkey as varchar) as document_id, 'layout_signature_ausente' as status from orders where o_custkey not in (select o_custkey from orders where o_orderstatus = 'F') and o_totalprice < 200000",
)
def _(spark, sf):
    r = v.runs(spark, sf).withColumn("domain", F.lit("d"))
    current = r.where("run_status = 'F'").select("domain", "entity")
    runs = r.withColumns({"layout_override": F.lit(None).cast("string"), "mode": F.when(F.col("price") >= 200000, "revalidacao_layout_candidato")})
    return rs.missing_layout(runs, current).select("document_id", F.col("status_compatibilidade").alias("status"))


@query(
    "f24_chosen_contracts",
    "select cast(o_orderkey as varchar) as document_id, case when o_orderkey % 10 = 0 then 'override' else 'active/' || o_orderpriority end as contract, true as differs from orders",
)
def _(spark, sf):
    r = v.runs(spark, sf).withColumns({"contract_override": F.when(F.col("seq") % 10 == 0, "override"), "contract_uri": F.lit("historic")})
    active = r.select("domain", F.concat(F.lit("active/"), "domain").alias("contract_uri")).distinct()
    return rs.choose_contract(r, active).select("document_id", F.col("chosen_contract").alias("contract"), F.col("differs_from_historic").alias("differs"))
