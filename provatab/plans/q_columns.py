"""Column clean-up jobs over rendered and natural text."""

from pyspark.sql import functions as F

from provatab.functions import numbers, paths, periods, text
from provatab.operators import columns as col
from provatab.plans import views as v
from provatab.plans.registry import query


@query(
    "n1_parsed_renderings",
    """with x as (select l_returnflag, cast(round(l_extendedprice * 100) as bigint) as c, cast(l_quantity as bigint) as q, cast(round(l_discount * 100) as bigint) as d from lineitem)
 select l_returnflag, unnest(['ptbr', 'money', 'english', 'negative', 'ratio', 'mil', 'percent', 'thousands']) as kind, count(*) as n,
 unnest([sum(c), sum(c), sum(c), -sum(c), sum(c), sum(q) * 100000, sum(d) * 100, sum(c // 100) * 100])::bigint as total from x group by 1""",
)
def _(spark, sf):
    """Every rendering of an amount parses back to it."""
    l = v.spread(v.table(spark, sf, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice", "l_discount"))
    c = v.cents(F.col("l_extendedprice"))
    plain = v.ptbr(c)
    whole = F.translate(F.format_number(F.floor(c / 100), 0), ",", ".")
    shown = {
        "ptbr": plain,
        "money": F.concat(F.lit("R$ "), plain),
        "english": F.format_number(c.cast("decimal(28,0)") / F.lit(100).cast("decimal(4,0)"), 2),
        "negative": F.concat(F.lit("("), plain, F.lit(")")),
        "ratio": F.concat(plain, F.lit("x")),
        "mil": F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(" mil")),
        "percent": F.concat(v.cents(F.col("l_discount")).cast("string"), F.lit(",0%")),
        "thousands": whole,
    }
    cells = l.select("l_returnflag", F.explode(F.create_map(*[x for k, t in shown.items() for x in (F.lit(k), t)])).alias("kind", "value_raw"))
    parsed = cells.withColumn("v", numbers.number_of(F.col("value_raw")))
    return parsed.groupBy("l_returnflag", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("v") * 100).cast("bigint")).alias("total"))


@query(
    "j1_typed_cells",
    f"""with {v.ORDER_ROWS_SQL}, c as (select l_returnflag as f, unnest(['item', 'total_unidades', 'valor', 'desconto_percentual', 'imposto']) as column_name,
 unnest([null, cast(l_quantity as bigint) * 100, cast(round(l_extendedprice * 100) as bigint), cast(round(l_discount * 100) as bigint) * 100, -cast(round(l_tax * 100) as bigint)]) as x,
 unnest([false, true, false, true, true]) as is_numeric, unnest(['unknown', 'measure_integer', 'unknown', 'measure_percent', 'unknown']) as semantics from olines)
 select column_name, is_numeric, semantics, count(*) as n, count(x) as n_value, cast(sum(x) as bigint) as total from c group by 1, 2, 3""",
)
def _(spark, sf):
    cells = v.order_cells(spark, sf)
    names = F.array(*[F.lit(n) for n in ("item", "total_unidades", "valor", "desconto_percentual", "imposto")])
    out = col.typed_cells(cells.withColumn("column_name", F.get(names, F.col("column_index"))))
    return out.groupBy("column_name", "is_numeric", "semantics").agg(
        F.count(F.lit(1)).alias("n"), F.count("value_num").alias("n_value"), F.sum(F.round(F.col("value_num") * 100).cast("bigint")).alias("total")
    )


@query(
    "n6_extraction_side_numbers",
    "select l_returnflag, cast(sum(cast(round(l_tax * 100) as bigint)) as bigint) as total, cast(0 as bigint) as ratios from lineitem group by 1",
)
def _(spark, sf):
    l = v.table(spark, sf, "lineitem")
    shown = F.translate(F.format_number(F.col("l_tax").cast("decimal(8,2)"), 2), ".", ",")
    wrapped = numbers.number_of(F.concat(F.lit("("), shown, F.lit(")")), published=False)
    ratio = numbers.number_of(F.concat(shown, F.lit("x")), published=False)
    return l.groupBy("l_returnflag").agg(F.sum(F.round(wrapped * 100).cast("bigint")).alias("total"), F.count(ratio).alias("ratios"))


_ASCII = "regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g')"


@query("n7_normalized_lines", f"with {v.ITEMS_SQL} select document_id, order_index, lower(trim(regexp_replace({_ASCII}, '\\s+', ' ', 'g'))) as key from items")
def _(spark, sf):
    return col.normalize_labels(v.items(spark, sf), "text", "text").select("document_id", "order_index", "key")


@query("n8_normalized_terms", f"with {v.ITEMS_SQL} select document_id, order_index, regexp_replace(lower(strip_accents(text)), '[^0-9a-z]+', '', 'g') as key from items")
def _(spark, sf):
    return col.normalize_labels(v.items(spark, sf), "text", "term").select("document_id", "order_index", "key")


@query(
    "n9_slugs",
    f"""with {v.ITEMS_SQL}, s as (select document_id, order_index, trim(regexp_replace(regexp_replace(translate(lower(trim(text)), 'áàãâäéêëíïóôõöúüç/- ', 'aaaaaeeeiioooouuc___'), '[^a-z0-9_]+', '', 'g'), '_+', '_', 'g'), '_') as k from items)
 select document_id, order_index, case when k = '' then 'untitled' else k end as key from s""",
)
def _(spark, sf):
    return col.normalize_labels(v.items(spark, sf), "text", "slug").select("document_id", "order_index", "key")


@query(
    "n10_unique_names",
    """with n as (select p_brand, list(p_type order by p_partkey) as names from part group by 1), e as (select p_brand, unnest(names) as nm, generate_subscripts(names, 1) as i from n),
 r as (select p_brand, i, lower(nm) as base, row_number() over (partition by p_brand, lower(nm) order by i) as k from e)
 select p_brand, cast(i - 1 as integer) as column_index, case when k = 1 then base else base || '_' || k end as name from r""",
)
def _(spark, sf):
    p = v.table(spark, sf, "part")
    return col.unique_name_rows(p, ["p_brand"], "p_partkey", "p_type")


@query("n11_stable_ids")
def _(spark, sf):
    """Name-based UUIDs; checked against the standard library in the tests."""
    return col.with_stable_id(v.items(spark, sf), ["document_id", F.lit("block"), "page_number", "order_index", F.substring("text", 1, 120)]).select(
        "document_id", "order_index", "id"
    )


@query(
    "n12_unit_hints",
    """select l_returnflag, unit, count(*) as n from (select l_returnflag, case l_linenumber % 5 when 0 then 'currency_brl' when 1 then 'billions' when 2 then 'millions' when 3 then 'percent' end as unit from lineitem) group by 1, 2""",
)
def _(spark, sf):
    l = v.table(spark, sf, "lineitem")
    m = F.col("l_linenumber") % 5
    q = F.col("l_quantity").cast("string")
    shown = F.when(m == 0, F.concat(F.lit("r$ "), q)).when(m == 1, F.concat(q, F.lit(" BI"))).when(m == 2, F.concat(q, F.lit(" million %"))).when(m == 3, F.concat(q, F.lit("%"))).otherwise(q)
    return l.groupBy("l_returnflag", text.unit_hint(shown).alias("unit")).agg(F.count(F.lit(1)).alias("n"))


@query("j4_block_roles", f"with {v.ITEMS_SQL}, {v.ROLES_SQL} select document_id, order_index, role from roled")
def _(spark, sf):
    return col.classify_blocks(v.items(spark, sf)).select("document_id", "order_index", "role")


@query(
    "n15_visual_artifacts",
    f"""with {v.ITEMS_SQL}, c as (select *, {v.CLEAN.format(t='text')} as c from items)
 select document_id, order_index from c where c = '' or (not regexp_matches(c, '\\p{{L}}') and (length(c) <= 12 or length(regexp_replace(c, '[\\d\\s]', '', 'g')) >= greatest(1, length(c) // 4)))""",
)
def _(spark, sf):
    return v.items(spark, sf).where(text.is_visual_artifact(F.col("text"))).select("document_id", "order_index")


@query(
    "n16_label_value_metrics",
    """select cast(l_orderkey as varchar) as document_id, 'Item ' || l_partkey || ' receita' as label, cast(round(l_extendedprice * 100) as bigint) as cents, count(*) as n from lineitem group by 1, 2, 3""",
)
def _(spark, sf):
    l = v.table(spark, sf, "lineitem")
    shown = F.concat(F.lit("Item "), F.col("l_partkey").cast("string"), F.lit(" receita: R$ "), v.ptbr(v.cents(F.col("l_extendedprice"))))
    m = l.select(F.col("l_orderkey").cast("string").alias("document_id"), col.metric_of(shown).alias("m"))
    return m.groupBy("document_id", F.col("m.label").alias("label"), F.round(F.col("m.value_numeric") * 100).cast("bigint").alias("cents")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "j5_periods",
    """with x as (select year(o_orderdate) as y, quarter(o_orderdate) as q, count(*) as n from orders group by 1, 2)
 select 'trimestre' as escopo, cast(y as integer) as ano, cast(q as integer) as indice, case when q = 1 then '4T' || lpad(cast((y - 1) % 100 as varchar), 2, '0') else (q - 1) || 'T' || lpad(cast(y % 100 as varchar), 2, '0') end as prev,
 q || 'T' || lpad(cast((y - 1) % 100 as varchar), 2, '0') as last_year, n from x""",
)
def _(spark, sf):
    o = v.table(spark, sf, "orders")
    d = F.col("o_orderdate")
    q, y = F.quarter(d).cast("string"), F.year(d).cast("string")
    spelled = F.when(F.col("o_orderkey") % 4 == 0, F.concat(q, F.lit("T"), y)).when(F.col("o_orderkey") % 4 == 1, F.concat(y, F.lit("-Q"), q)).when(
        F.col("o_orderkey") % 4 == 2, F.concat(q, F.lit("º tri/"), y, F.lit(" (a)"))
    ).otherwise(F.concat(F.lit("T"), q, F.lit(" "), y, F.lit("*")))
    out = col.resolve_periods(o.select(spelled.alias("label")), "label")
    return out.groupBy(
        F.col("period.escopo").alias("escopo"), F.col("period.ano").alias("ano"), F.col("period.indice").alias("indice"),
        periods.period_label(F.col("period_prev")).alias("prev"), periods.period_label(F.col("period_last_year")).alias("last_year"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "n21_derived_periods",
    """with x as (select distinct year(o_orderdate) * 12 + month(o_orderdate) - 1 as a from orders), s as (select a, unnest([0, 1, 2, 14]) as k from x)
 select cast(a as bigint) as reference, cast(k as integer) as step, lpad(cast((a - k) % 12 + 1 as varchar), 2, '0') || '/' || ((a - k) // 12) as derived from s""",
)
def _(spark, sf):
    o = v.table(spark, sf, "orders").select((F.year("o_orderdate").cast("bigint") * 12 + F.month("o_orderdate") - 1).alias("reference"), F.date_format("o_orderdate", "MM/yyyy").alias("label")).distinct()
    p = o.withColumn("p", periods.period_of(F.col("label"))).withColumn("step", F.explode(F.array(*[F.lit(k) for k in (0, 1, 2, 14)])))
    relation = F.when(F.col("step") == 0, "").otherwise("anterior")
    back = p.withColumn("d", periods.derive_period(F.col("p"), F.lit("identidade_documento.periodo"), relation, F.col("step")))
    return back.select("reference", "step", periods.period_label(F.col("d")).alias("derived"))


@query(
    "n22_period_tokens",
    "select token, count(*) as n from (select unnest([quarter(o_orderdate) || 'T ' || year(o_orderdate), cast(year(o_orderdate) - 1 as varchar)]) as token from orders) group by 1",
)
def _(spark, sf):
    d = F.col("o_orderdate")
    title = F.concat(F.lit("Vendas "), F.quarter(d).cast("string"), F.lit("t "), F.year(d).cast("string"), F.lit(" x "), (F.year(d) - 1).cast("string"), F.lit(", 12345"))
    o = v.table(spark, sf, "orders").select(F.explode(periods.period_tokens(title)).alias("token"))
    return o.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query(
    "n23_loader_labels",
    "select quarter(o_orderdate) || 'T' || strftime(o_orderdate, '%y') as label, count(*) as n from orders group by 1",
)
def _(spark, sf):
    d = F.col("o_orderdate")
    shown = F.concat(F.quarter(d).cast("string"), F.lit("T"), F.date_format(d, "yy"), F.lit(" (a)"))
    return v.table(spark, sf, "orders").groupBy(periods.loader_period(shown).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "j6_path_segments",
    """with e as (select event_id, event_type, cast(user_id as varchar) as u from events)
 select event_id, 0 as pos, 'grupo' as field, null::varchar as key, null::varchar as value from e union all select event_id, 1, 'dados', 'empresa', 'e.' || u from e
 union all select event_id, 2, 'valores', 'periodo.rotulo', event_type from e union all select event_id, 3, 'valor', null, null from e""",
)
def _(spark, sf):
    e = v.table(spark, sf, "events")
    path = F.concat(F.lit("grupo.dados[empresa=e."), F.col("user_id").cast("string"), F.lit("].valores[periodo.rotulo="), "event_type", F.lit("].valor"))
    return col.explode_paths(e.select("event_id", path.alias("mapping_path"))).select("event_id", "pos", "field", "key", "value")


@query("n25_nested_values", "select event_id, json_extract_string(props, '$.k') as k, null::varchar as missing from events")
def _(spark, sf):
    e = v.table(spark, sf, "events")
    nested = F.concat(F.lit('{"a":'), "props", F.lit("}"))
    return e.select("event_id", paths.json_at(nested, F.lit("a.k")).alias("k"), paths.json_at(nested, "a.z").alias("missing"))


@query(
    "n27_compact_texts",
    f"with c as (select doc_id, {v.CLEAN.format(t='text')} as c from documents) select doc_id, case when c <> '' then c end as shown from c",
)
def _(spark, sf):
    return v.table(spark, sf, "documents").select("doc_id", text.compact_text(F.col("text")).alias("shown"))


@query(
    "n28_execution_times",
    "select o_orderkey, case when o_orderkey % 3 < 2 then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') end as at from orders",
)
def _(spark, sf):
    d = F.col("o_orderdate")
    name = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("run__"), F.date_format(d, "yyyyMMdd'T'HHmmss'Z'"))).when(
        F.col("o_orderkey") % 3 == 1, F.concat(F.lit("manual__"), F.date_format(d, "yyyy-MM-dd'T'HH_mm_ss"), F.lit(".123456"))
    ).otherwise("sem_data")
    return v.table(spark, sf, "orders").select("o_orderkey", F.date_format(periods.execution_time(name), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(
    "n29_clean_facts",
    "select event_id, 1 as n_facts, event_type as first_text, least(1.0, greatest(0.0, value / 10)) as confidence from events",
)
def _(spark, sf):
    e = v.table(spark, sf, "events")
    facts = F.concat(F.lit('[{"raw_text":" '), "event_type", F.lit(' ","value":"1"},{"raw_text":"  "},{"metric":"m"}]'))
    out = col.clean_records(e.select("event_id", facts.alias("facts"), (F.col("value") / 10).cast("string").alias("confidence")), facts="facts", confidence="confidence")
    return out.select("event_id", F.size("facts").alias("n_facts"), F.col("facts")[0]["raw_text"].alias("first_text"), "confidence")


@query(
    "n30_substitutions",
    "select case c_mktsegment when 'BUILDING' then 'Obras' when 'MACHINERY' then null else c_mktsegment end as segment, count(*) as n from customer group by 1",
)
def _(spark, sf):
    c = v.table(spark, sf, "customer").withColumn("segment", F.col("c_mktsegment"))
    out = col.clean_records(c, {"segment": {"BUILDING": "Obras", "MACHINERY": " "}})
    return out.groupBy("segment").agg(F.count(F.lit(1)).alias("n"))
