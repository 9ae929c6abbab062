"""Layout mappings joined to evidence: values, audit rows, rules and output rows.

A mapping is a row ``(document_id, ord, mapping_path, tipo_origem, arquivo_origem, obrigatorio)``
with the columns its origin kind uses: ``valor_fixo``, ``campo_origem``, ``caminho_json``,
``block_id``, ``padrao``, ``coluna_rotulo``, ``valor_aceito``, ``indice_linha_esperado``,
``indice_coluna_esperado``, ``escopo_periodo``. ``arquivo_origem`` is the ``table_id`` of tables.
All documents resolve in one job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provatab.cluster import broadcast_if_small, checkpointed, first_per_key, follow_pointers, shuffled
from provatab.functions import numbers, paths
from provatab.functions import text as tx
from provatab.operators.contract import CONTRACT

MAPPING = ["document_id", "ord"]
TABLE = ["document_id", "table_id"]
# Pattern of a quarter, and the kinds of origin a mapping may name.
DEFAULT_PATTERN = "[1-4]T[0-9]{2}"
KINDS = (
    "valor_fixo",
    "campo_derivado",
    "campo_json",
    "bloco_textual",
    "registros_de_blocos_textuais",
    "cabecalho_de_tabela",
    "celula_de_tabela",
    "linhas_de_tabela",
    "linhas_de_tabelas",
    "juncao_de_registros_json",
)


def _of(mappings: DataFrame, kind: str) -> DataFrame:
    return mappings.where(F.col("tipo_origem") == kind)


def _audit(df: DataFrame, value: Column, *, resolved: Column | None = None, synonym: Column | None = None) -> DataFrame:
    done = value.isNotNull() if resolved is None else resolved
    return df.select(
        *MAPPING, "mapping_path", "tipo_origem", "arquivo_origem", "obrigatorio",
        F.when(done, "resolvido").otherwise("nao_resolvido").alias("status_resolucao"),
        value.cast("string").alias("valor_resolvido"),
        (F.lit(None) if synonym is None else synonym).cast("boolean").alias("linha_por_sinonimo"),
    )


# --- single-value origins ---------------------------------------------------------------------


def fixed_values(mappings: DataFrame) -> DataFrame:
    """always resolved, even when the fixed value is null."""
    return _audit(_of(mappings, "valor_fixo"), F.col("valor_fixo"), resolved=F.lit(True))


def derived_fields(mappings: DataFrame, resolved: DataFrame) -> DataFrame:
    """value of an earlier mapping path of the same document.

    References only point backwards. Chains are followed by doubling pointers, so a chain of n links takes about
    log2(n) rounds.
    """
    wanted = _of(mappings, "campo_derivado")
    asked = wanted.select(*MAPPING, F.col("campo_origem").alias("_ref"))
    known = resolved.select("document_id", F.col("mapping_path").alias("_ref"), F.col("ord").alias("_at"), F.col("valor_resolvido").alias("_v"))
    derived = wanted.select("document_id", F.col("mapping_path").alias("_ref"), F.col("ord").alias("_at"), F.lit(None).cast("string").alias("_v"))
    before = asked.join(known.unionByName(derived), ["document_id", "_ref"]).where(F.col("_at") < F.col("ord"))
    # Of several earlier mappings of a path the last one counts.
    last = before.groupBy(*MAPPING).agg(F.max_by(F.struct("_at", "_v"), "_at").alias("_p"))
    nodes = asked.join(last, MAPPING, "left").select(*MAPPING, F.col("_p._at").alias("_to"), F.col("_p._v").alias("_v"))
    values = follow_pointers(nodes, ["document_id"], "ord", "_to", "_v")
    return _audit(wanted.join(values, MAPPING, "left"), F.col("_v"))


def json_fields(mappings: DataFrame, artifacts: DataFrame) -> DataFrame:
    """field of a JSON artefact ``(document_id, arquivo_origem, payload)`` by dotted path."""
    joined = _of(mappings, "campo_json").join(artifacts, ["document_id", "arquivo_origem"], "left")
    return _audit(joined, paths.json_at(F.col("payload"), F.col("caminho_json")))


# Escaped signs and classes of a pattern, and brackets that capture (a name may follow).
_NOT_BRACKETS = r"\\.|\[(?:\\.|[^\]\\])*\]"
_CAPTURES = r"\((?!\?)|\(\?<(?![=!])"


def sound_pattern(pattern: Column, group: Column | None = None) -> Column:
    """The pattern, or null where it doesn't compile or has fewer groups than ``group``."""
    tried = F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), pattern)
    if group is None:
        return F.when(tried.isNotNull(), pattern)
    captures = F.size(F.regexp_extract_all(F.regexp_replace(pattern, _NOT_BRACKETS, ""), F.lit(_CAPTURES), F.lit(0)))
    return F.when(tried.isNotNull() & (captures >= F.coalesce(group, F.lit(0))), pattern)


def text_blocks(mappings: DataFrame, blocks: DataFrame) -> DataFrame:
    """first block in file order whose text matches the pattern; the match is the value.

    A pattern is read from the mapping, so it is applied per row. One that is no pattern finds
    nothing, and its mapping stays unresolved.
    """
    wanted = _of(mappings, "bloco_textual").withColumn("_p", sound_pattern(F.coalesce("padrao", F.lit(DEFAULT_PATTERN))))
    asked = wanted.select(*MAPPING, "_p", F.nullif(F.trim("block_id"), F.lit("")).alias("_b"))
    read = blocks.select("document_id", F.col("block_id").alias("_id"), "order_index", "text")
    named = asked.where("_b is not null").join(read.withColumnRenamed("_id", "_b"), ["document_id", "_b"])
    any_ = asked.where("_b is null").join(read, "document_id")
    found = named.select(*MAPPING, "_p", "order_index", "text").unionByName(any_.select(*MAPPING, "_p", "order_index", "text"))
    hits = found.where(F.expr("text rlike _p")).groupBy(*MAPPING).agg(
        F.min_by(F.expr("regexp_extract(text, _p, 0)"), "order_index").alias("_v")
    )
    return _audit(wanted.join(hits, MAPPING, "left"), F.col("_v"))


def block_records(fields: DataFrame, blocks: DataFrame) -> DataFrame:
    """records whose fields are captured from named blocks.

    ``fields`` has ``document_id, ord, record, path, fixed, block_id, padrao, grupo, tipo``. A
    field without its block or match, or whose pattern is none or lacks the group, is null and the
    record stays; fixed values come as given.
    """
    texts = blocks.select("document_id", "block_id", "text")
    joined = fields.join(texts, ["document_id", "block_id"], "left")
    joined = joined.withColumn("padrao", sound_pattern(F.col("padrao"), F.col("grupo")))
    got = F.when(F.expr("text rlike padrao"), F.expr("regexp_extract(text, padrao, grupo)"))
    number = numbers.number_of(got).cast("string")
    value = F.when(F.col("fixed").isNotNull(), F.col("fixed")).when(F.col("tipo") == "numero", number).otherwise(got)
    return joined.select(*MAPPING, "record", "path", value.alias("value"))


def table_headers(mappings: DataFrame, headers: DataFrame) -> DataFrame:
    """header of a column by index; out of range stays unresolved."""
    wanted = _of(mappings, "cabecalho_de_tabela")
    named = headers.select("document_id", F.col("table_id").alias("arquivo_origem"), F.col("column_index").alias("indice_coluna_esperado"), "header")
    return _audit(wanted.join(shuffled(named), ["document_id", "arquivo_origem", "indice_coluna_esperado"], "left"), F.col("header"))


# --- labels and cells -------------------------------------------------------------------------


def expand_labels(mappings: DataFrame, synonyms: DataFrame) -> DataFrame:
    """normalised labels each mapping accepts: its own, and the terms of every group that
    holds it or that a selector of its path names.

    ``synonyms`` has ``group_id, kind, name, metric, term`` with ``kind`` one of ``entity``,
    ``entity_value`` and ``indicator``; calculated metrics are left out when it is built.
    """
    own = mappings.select(*MAPPING, "mapping_path", tx.normalize_text(F.col("valor_aceito")).alias("label"))
    groups = synonyms.select("group_id", "kind", "name", "metric", tx.normalize_text(F.col("term")).alias("label"))
    members = groups.select("group_id", "label").distinct()
    by_label = own.join(broadcast_if_small(members), "label").select(*MAPPING, "group_id")
    values = F.transform(F.filter(paths.path_segments(F.col("mapping_path")), lambda s: s["key"].isNotNull()), lambda s: s["value"])
    named = own.select(*MAPPING, F.explode(values).alias("_sel")).distinct()
    indicators = groups.where("kind = 'indicator'").select("group_id", F.explode(F.array("name", "metric")).alias("_sel")).distinct()
    by_context = named.join(broadcast_if_small(indicators), "_sel").select(*MAPPING, "group_id")
    chosen = by_label.unionByName(by_context).distinct()
    expanded = chosen.join(broadcast_if_small(members), "group_id").select(*MAPPING, "label")
    return own.select(*MAPPING, "label").unionByName(expanded).distinct()


def lookup_rows(asked: DataFrame, labels: DataFrame, cells: DataFrame) -> DataFrame:
    """row each request means: the hinted row when its label is accepted, else the first
    row with the exact label, else the first with a synonym.

    ``asked`` has ``document_id, ord, table_id, coluna_rotulo, valor_aceito,
    indice_linha_esperado``; ``labels`` the accepted labels per request. One equi-join on
    (table, column, label) and one partial minimum.
    """
    wanted = asked.select(
        *MAPPING, "table_id", F.coalesce("coluna_rotulo", F.lit(0)).alias("column_index"), tx.normalize_text(F.col("valor_aceito")).alias("_exact"),
        F.col("indice_linha_esperado").alias("_hint"),
    ).join(shuffled(labels), MAPPING)
    columns = wanted.select(*TABLE, "column_index").distinct()
    printed = cells.join(shuffled(columns), [*TABLE, "column_index"], "left_semi").select(
        *TABLE, "column_index", "row_index", "value_raw", tx.normalize_text(F.col("value_raw")).alias("label")
    )
    tier = F.when(F.col("row_index") == F.col("_hint"), 0).when(F.col("label") == F.col("_exact"), 1).otherwise(2)
    return (
        shuffled(wanted).join(shuffled(printed), [*TABLE, "column_index", "label"])
        .groupBy(*MAPPING, "table_id", "_exact")
        .agg(F.min(F.struct(tier.alias("tier"), "row_index", "value_raw", "label")).alias("_r"))
        .select(*MAPPING, "table_id", "_r.row_index", F.col("_r.value_raw").alias("row_label"), (F.col("_r.label") != F.col("_exact")).alias("by_synonym"))
    )


def table_cells(mappings: DataFrame, cells: DataFrame, headers: DataFrame, synonyms: DataFrame) -> DataFrame:
    """F8: observation a cell holds: period (its header), scope, number, text and synonym flag."""
    wanted = _of(mappings, "celula_de_tabela").withColumn("table_id", F.col("arquivo_origem"))
    rows = lookup_rows(wanted, expand_labels(wanted, synonyms), cells).drop("table_id")
    at = wanted.join(shuffled(rows), MAPPING, "left").withColumn("column_index", F.col("indice_coluna_esperado"))
    found = at.join(shuffled(cells.select(*TABLE, "row_index", "column_index", "value_raw")), [*TABLE, "row_index", "column_index"], "left").join(
        shuffled(headers.select(*TABLE, "column_index", "header")), [*TABLE, "column_index"], "left"
    )
    return found.select(
        *mappings.columns, "row_index", F.col("header").alias("periodo"), "value_raw", numbers.number_of(F.col("value_raw")).alias("valor"),
        "row_label", F.coalesce("by_synonym", F.lit(False)).alias("by_synonym"),
    )


def project_cells(observed: DataFrame, leaf_types: DataFrame | None = None) -> DataFrame:
    """F8p: value of a cell mapping. With ``leaf_types`` (path, descriptor) a numeric leaf takes
    the number and any other the text; without, the last field names the part."""
    if leaf_types is not None:
        typed = observed.withColumn("path", paths.plain_path(F.col("mapping_path"))).join(
            broadcast_if_small(leaf_types.select("path", "descriptor")), "path", "left"
        )
        numeric = F.coalesce(F.col("descriptor").rlike("number|integer"), F.lit(False))
        value = F.when(numeric, F.col("valor").cast("string")).otherwise(F.col("value_raw"))
        return _audit(typed, value, synonym=F.col("by_synonym"))
    last = F.element_at(paths.path_segments(F.col("mapping_path")), -1)["field"]
    whole = F.to_json(F.struct("periodo", "escopo_periodo", "valor"), {"ignoreNullFields": "false"})
    value = (
        F.when(last == "valores", whole)
        .when(last == "periodo", F.col("periodo"))
        .when(last == "escopo_periodo", F.col("escopo_periodo"))
        .when(last == "valor", F.col("valor").cast("string"))
        .otherwise(F.col("value_raw"))
    )
    done = F.when(last == "valores", F.col("valor").isNotNull()).otherwise(value.isNotNull())
    return _audit(observed, value, resolved=done, synonym=F.col("by_synonym"))


# --- row origins ------------------------------------------------------------------------------


def table_row_records(segments: DataFrame, fields: DataFrame, cells: DataFrame, sizes: DataFrame) -> DataFrame:
    """rows of one or several tables as records, one output row per record field.

    ``segments`` has ``document_id, ord, source_ord, segment, table_id, first_row, last_row`` and
    ``fixed`` (a map of values the segment adds); ``fields`` has ``document_id, ord, segment,
    path, tipo, column_index, replacements``. Ranges are inclusive; an invalid one is skipped.
    """
    valid = segments.join(sizes.select(*TABLE, "row_count"), TABLE).select(
        *segments.columns, "row_count", F.coalesce("first_row", F.lit(0)).alias("_from"), F.coalesce("last_row", F.col("row_count") - 1).alias("_to")
    ).where("row_count > 0 and _from >= 0 and _to >= _from and _to < row_count")
    keys = [*MAPPING, "source_ord", "segment"]
    # Rows of a range exist even where a cell is missing.
    rows = valid.select(*keys, "table_id", "_from", "fixed", F.explode(F.sequence("_from", "_to")).alias("row_index"))
    asked = shuffled(rows).join(fields, [*MAPPING, "segment"])
    read = asked.join(shuffled(cells.select(*TABLE, "row_index", "column_index", "value_raw")), [*TABLE, "row_index", "column_index"], "left")
    cleaned = F.nullif(F.trim("value_raw"), F.lit(""))
    replaced = F.nullif(F.trim(F.coalesce(F.try_element_at("replacements", cleaned), cleaned)), F.lit(""))
    number = numbers.number_of(F.col("value_raw")).cast("string")
    value = (
        F.when(F.col("tipo") == "posicao", (F.col("row_index") - F.col("_from") + 1).cast("string")).when(F.col("tipo") == "numero", number).otherwise(replaced)
    )
    own = read.select(*keys, "row_index", "path", value.alias("value"))
    added = rows.select(*keys, "row_index", F.explode("fixed").alias("path", "value"))
    # A fixed value overwrites a read one of the same path.
    overwritten = added.select(*keys, "row_index", "path")
    return own.join(shuffled(overwritten), [*keys, "row_index", "path"], "left_anti").unionByName(added)


def joined_records(sources: dict[str, DataFrame], fixed: dict[str, str] | None = None, by_key: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """inner join of keyed record lists; null keys drop, a key that a source repeats is a problem.

    A repeated key gives one row whose ``problem`` names the sources that repeat it and whose values are null; all
    other rows, of that document too, have no problem. Each source has ``document_id``, ``key`` and its own value columns; where two share a column
    the later source wins. ``fixed`` adds constants, ``by_key`` maps a key pattern to constants,
    later rules last. The result is meant to be read in key order.
    """
    if len(sources) < 2:
        raise ValueError("a record join needs at least two sources")
    ids = ["document_id", "key"]
    single, problems = [], []
    for name, rows in sources.items():
        present = rows.where("key is not null").withColumn("key", F.col("key").cast("string"))
        values = [c for c in rows.columns if c not in ids]
        unique = present.groupBy(*ids).agg(F.first(F.struct(*values)).alias(f"_{name}"), F.count(F.lit(1)).alias("_n"))
        single.append(unique.where("_n = 1").drop("_n"))
        problems.append(unique.where("_n > 1").select(*ids, F.lit(f"repeated_key:{name}").alias("problem")))
    told = reduce(DataFrame.unionByName, problems).groupBy(*ids).agg(F.array_join(F.sort_array(F.collect_list("problem")), ",").alias("problem"))
    joined = reduce(lambda a, b: a.join(b, ids), single)
    columns: dict[str, Column] = {}
    for name, rows in sources.items():
        columns.update({c: F.col(f"_{name}")[c] for c in rows.columns if c not in ids})
    columns.update({path: F.lit(value) for path, value in (fixed or {}).items()})
    for pattern, values in (by_key or {}).items():
        for path, value in values.items():
            before = columns.get(path, F.lit(None).cast("string"))
            columns[path] = F.when(F.col("key").rlike(pattern), F.lit(value)).otherwise(before)
    good = joined.select(*ids, *[c.alias(name) for name, c in columns.items()], F.lit(None).cast("string").alias("problem"))
    return good.unionByName(told, allowMissingColumns=True)


# --- dispatch ---------------------------------------------------------------------------------


def literal_first(mappings: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """mappings of contract literals are answered by the contract; returns (audit, the rest)."""
    keyed = mappings.withColumn("_path", paths.plain_path(F.col("mapping_path")))
    literals = broadcast_if_small(nodes.where("literal is not null").select(*CONTRACT, F.col("path").alias("_path"), "literal"))
    by = [c for c in CONTRACT if c in mappings.columns] + ["_path"]
    literals = literals.select(*by, "literal")
    won = _audit(keyed.join(literals, by), F.col("literal"), resolved=F.lit(True))
    rest = keyed.join(literals, by, "left_anti").drop("_path")
    return won, rest


# Kinds that read one artefact by name.
_READS = ("campo_json", "cabecalho_de_tabela", "celula_de_tabela", "linhas_de_tabela")


def known_artifacts(evidence: dict[str, DataFrame]) -> DataFrame:
    """``document_id`` and ``arquivo_origem`` of the artefacts the evidence comes from."""
    none = F.lit(None).cast("string")
    parts = [e.select("document_id", F.col(c).alias("arquivo_origem")) for n, c in (("headers", "table_id"), ("cells", "table_id"), ("json", "arquivo_origem")) if (e := evidence.get(n)) is not None and c in e.columns]
    return reduce(DataFrame.unionByName, parts).distinct() if parts else next(iter(evidence.values())).select("document_id", none.alias("arquivo_origem")).limit(0)


def mapping_errors(mappings: DataFrame, artifacts: DataFrame) -> DataFrame:
    """``document_id``, ``ord`` and ``evidencia`` of the mappings whose artefact the document does not have, or whose
    pattern is none."""
    wanted = mappings.where(F.col("tipo_origem").isin(*_READS))
    missing = wanted.join(artifacts.select("document_id", "arquivo_origem"), ["document_id", "arquivo_origem"], "left_anti")
    unread = missing.select(*MAPPING, F.concat(F.lit("artefato nao encontrado: "), F.coalesce("arquivo_origem", F.lit(""))).alias("evidencia"))
    unsound = _of(mappings, "bloco_textual").where(F.col("padrao").isNotNull() & sound_pattern(F.col("padrao")).isNull())
    return unread.unionByName(unsound.select(*MAPPING, F.concat(F.lit("padrao invalido: "), "padrao").alias("evidencia")))


def resolve_mappings(
    mappings: DataFrame,
    evidence: dict[str, DataFrame],
    *,
    nodes: DataFrame | None = None,
    synonyms: DataFrame | None = None,
    records: DataFrame | None = None,
    artifacts: DataFrame | None = None,
) -> DataFrame:
    """audit row of every mapping, one branch per origin kind.

    ``evidence`` may hold ``cells``, ``headers``, ``blocks`` and ``json``. ``records`` are
    ``(document_id, ord, n)`` counts of the list-valued origins; an empty list is unresolved.
    A kind nobody supports gives ``nao_suportado``. A mapping whose artefact the document does not have, or whose pattern
    is none, gives ``erro`` and stops no other; ``artifacts`` (``document_id``, ``arquivo_origem``) names what there is, by default what the
    evidence comes from. Contract literals come before that.
    """
    parts = []
    rest = mappings
    if nodes is not None:
        won, rest = literal_first(mappings, nodes)
        parts.append(won)
    errors = mapping_errors(rest, known_artifacts(evidence) if artifacts is None else artifacts)
    parts.append(_audit(rest.join(errors, MAPPING), F.lit(None)).withColumn("status_resolucao", F.lit("erro")))
    rest = rest.join(errors, MAPPING, "left_anti")
    parts.append(fixed_values(rest))
    if "json" in evidence:
        parts.append(json_fields(rest, evidence["json"]))
    if "blocks" in evidence:
        parts.append(text_blocks(rest, evidence["blocks"]))
    if "headers" in evidence:
        parts.append(table_headers(rest, evidence["headers"]))
    if "cells" in evidence and synonyms is not None:
        types = None if nodes is None else nodes.where("descriptor is not null")
        parts.append(project_cells(table_cells(rest, evidence["cells"], evidence["headers"], synonyms), types))
    lists = rest.where(F.col("tipo_origem").isin("registros_de_blocos_textuais", "linhas_de_tabela", "linhas_de_tabelas", "juncao_de_registros_json"))
    if records is not None:
        parts.append(_audit(lists.join(records, MAPPING, "left"), F.col("n"), resolved=F.coalesce(F.col("n") > 0, F.lit(False))))
    unknown = rest.where(~F.coalesce(F.col("tipo_origem").isin(*KINDS), F.lit(False)))
    odd = _audit(unknown, F.lit(None)).withColumn("status_resolucao", F.lit("nao_suportado"))
    parts.append(odd)
    direct = reduce(DataFrame.unionByName, parts)
    derived = rest.where("tipo_origem = 'campo_derivado'")
    if derived.isEmpty():
        return direct
    direct = checkpointed(direct)
    return direct.unionByName(derived_fields(rest, direct))


# --- audit, output rows -----------------------------------------------------------------------


def run_summary(audit: DataFrame, runs: DataFrame | None = None, by: tuple[str, ...] = ("document_id",)) -> DataFrame:
    """F16: resolved and failed fields per run; runs without audit rows count zero."""
    done = F.count_if(F.col("status_resolucao") == "resolvido")
    counted = audit.groupBy(*by).agg(done.alias("resolved"), (F.count(F.lit(1)) - done).alias("failed"))
    if runs is None:
        return counted
    zero = F.lit(0).cast("long")
    return runs.select(*by).join(counted, list(by), "left").select(
        *by, F.coalesce("resolved", zero).alias("resolved"), F.coalesce("failed", zero).alias("failed")
    )


def output_leaves(audit: DataFrame, nodes: DataFrame) -> DataFrame:
    """leaves of the output row: ``(document_id, array_path, item, path, value, ord)``.

    ``item`` is the chain of selectors that finds the array item. Paths the contract does not
    have are ignored; when two mappings write a leaf, the later one stays. An item selected by a
    field value another item already holds is that item.
    """
    known = broadcast_if_small(nodes.select("path").distinct())
    done = audit.where("status_resolucao = 'resolvido'").withColumn("path", paths.plain_path(F.col("mapping_path")))
    done = done.join(known, "path", "left_semi")
    seg = paths.path_segments(F.col("mapping_path"))
    with_sel = F.filter(seg, lambda s: s["key"].isNotNull())
    item = F.array_join(F.transform(with_sel, lambda s: F.concat(s["key"], F.lit("="), s["value"])), "/")
    depth = F.array_max(F.transform(seg, lambda s, i: F.when(s["key"].isNotNull(), i + 1)))
    array_path = F.coalesce(F.array_join(F.slice(F.split("path", "\\."), F.lit(1), depth), "."), F.lit(""))
    last = F.element_at(with_sel, -1)
    rows = done.select(
        "document_id", "ord", array_path.alias("array_path"), item.alias("item"), "path", F.col("valor_resolvido").alias("value"),
        F.when(F.size(with_sel) > 0, last["key"]).alias("_k"), F.when(F.size(with_sel) > 0, last["value"]).alias("_v"),
    )
    items = rows.where("item <> ''").groupBy("document_id", "array_path", "item", "_k", "_v").agg(F.min("ord").alias("_first"))
    parent = F.regexp_replace("item", "/?[^/]*$", "")
    field = F.regexp_replace("path", "^.*\\.", "")
    held = rows.select("document_id", "array_path", F.col("item").alias("_same"), field.alias("_k"), F.col("value").alias("_v"), F.col("ord").alias("_at"), parent.alias("_p"))
    aliases = (
        items.withColumn("_p", parent)
        .join(held, ["document_id", "array_path", "_k", "_v", "_p"])
        .where((F.col("_same") != F.col("item")) & (F.col("_at") < F.col("_first")))
        .groupBy("document_id", "array_path", "item")
        .agg(F.min_by("_same", "_at").alias("_same"))
    )
    # Follow chains of aliases by doubling.
    while True:
        over = aliases.select("document_id", "array_path", F.col("item").alias("_same"), F.col("_same").alias("_far"))
        jumped = checkpointed(
            aliases.join(over, ["document_id", "array_path", "_same"], "left").select(
                "document_id", "array_path", "item", F.coalesce("_far", "_same").alias("_same"), F.col("_far").isNotNull().alias("_moved")
            )
        )
        aliases = jumped.drop("_moved")
        if jumped.where("_moved").isEmpty():
            break
    named = rows.join(aliases, ["document_id", "array_path", "item"], "left").withColumn("item", F.coalesce("_same", "item"))
    return first_per_key(named.select("document_id", "array_path", "item", "path", "value", "ord"), ["document_id", "array_path", "item", "path"], F.col("ord"), last=True)


def assemble_rows(leaves: DataFrame) -> DataFrame:
    """one record per array item (and one for the root), items in first-seen order.

    The record holds the fields of its item; nesting is by the selector chain of ``item``.
    """
    field = F.regexp_replace("path", "^.*\\.", "")
    return leaves.groupBy("document_id", "array_path", "item").agg(
        F.min("ord").alias("first_seen"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.when(F.col("array_path") == "", F.col("path")).otherwise(field).alias("k"), F.col("value").alias("v"))))).alias("fields"),
    )


# --- rules ------------------------------------------------------------------------------------

RULE = ["document_id", "rule_id"]


def _verdict(rules: DataFrame, passed: DataFrame) -> DataFrame:
    ok = passed.select(*RULE).distinct().withColumn("_ok", F.lit(True))
    return rules.join(ok, RULE, "left").select(
        *RULE, "tipo_teste", "codigo_falha", F.when(F.col("_ok"), "aprovada").otherwise("reprovada").alias("status")
    )


def rule_artifact_exists(rules: DataFrame, artifacts: DataFrame) -> DataFrame:
    """F17."""
    mine = rules.where("tipo_teste = 'arquivo_existe'")
    return _verdict(mine, mine.join(artifacts.select("document_id", "arquivo_origem"), ["document_id", "arquivo_origem"], "left_semi"))


def rule_section_exists(rules: DataFrame, sections: DataFrame) -> DataFrame:
    """a section with an accepted title, on an accepted page where pages are given."""
    mine = rules.where("tipo_teste = 'secao_existe'")
    titles = mine.select(*RULE, "paginas_aceitas", F.explode("valores_aceitos").alias("title_canonical"))
    page = F.coalesce(F.size("paginas_aceitas"), F.lit(0)) <= 0
    hit = titles.join(sections.select("document_id", "title_canonical", "page_number"), ["document_id", "title_canonical"]).where(
        page | F.array_contains("paginas_aceitas", F.col("page_number"))
    )
    return _verdict(mine, hit)


def _rule_rows(mine: DataFrame, cells: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Row a rule means. Each accepted value is a request; the best tier over all of them wins."""
    asked = mine.select(*RULE, "arquivo_origem", "coluna_rotulo", "indice_linha_esperado", F.posexplode("valores_aceitos").alias("_i", "valor_aceito"))
    asked = asked.select(
        F.col("document_id"), F.concat_ws("#", "rule_id", "_i").alias("ord"), "rule_id", F.lit("").alias("mapping_path"),
        F.col("arquivo_origem").alias("table_id"), "coluna_rotulo", "valor_aceito", "indice_linha_esperado",
    )
    labels = expand_labels(asked, synonyms)
    wanted = asked.select(*MAPPING, "rule_id", "table_id", F.coalesce("coluna_rotulo", F.lit(0)).alias("column_index"), tx.normalize_text(F.col("valor_aceito")).alias("_exact"), F.col("indice_linha_esperado").alias("_hint")).join(shuffled(labels), MAPPING)
    printed = cells.select(*TABLE, "column_index", "row_index", tx.normalize_text(F.col("value_raw")).alias("label"))
    tier = F.when(F.col("row_index") == F.col("_hint"), 0).when(F.col("label") == F.col("_exact"), 1).otherwise(2)
    return (
        shuffled(wanted).join(shuffled(printed), [*TABLE, "column_index", "label"])
        .groupBy(*RULE, "table_id")
        .agg(F.min(F.struct(tier.alias("t"), "row_index")).alias("_r"))
        .select(*RULE, "table_id", F.col("_r.row_index").alias("row_index"))
    )


def rule_row_exists(rules: DataFrame, cells: DataFrame, synonyms: DataFrame) -> DataFrame:
    """F19."""
    mine = rules.where("tipo_teste = 'linha_existe_em_tabela'")
    return _verdict(mine, _rule_rows(mine, cells, synonyms))


def rule_period_columns(rules: DataFrame, headers: DataFrame) -> DataFrame:
    """every expected column (``colunas_esperadas``: index, pattern) has a matching header."""
    mine = rules.where("tipo_teste = 'perfil_colunas_periodo_existe_em_tabela'")
    wanted = mine.select(*RULE, F.col("arquivo_origem").alias("table_id"), F.explode("colunas_esperadas").alias("_c")).select(
        *RULE, "table_id", F.col("_c.indice").alias("column_index"), F.col("_c.padrao").alias("_p")
    )
    seen = wanted.join(shuffled(headers.select(*TABLE, "column_index", "header")), [*TABLE, "column_index"], "left")
    fit = F.coalesce((F.col("header") != "") & F.expr("header rlike _p"), F.lit(False))
    good = seen.groupBy(*RULE).agg(F.bool_and(fit).alias("_all")).where("_all")
    # A table must exist; without expected columns its existence is enough.
    empty = mine.where("coalesce(size(colunas_esperadas), 0) <= 0").join(
        headers.select("document_id", F.col("table_id").alias("arquivo_origem")).distinct(), ["document_id", "arquivo_origem"], "left_semi"
    )
    return _verdict(mine, good.select(*RULE).unionByName(empty.select(*RULE)))


def rule_value_parses(rules: DataFrame, cells: DataFrame, synonyms: DataFrame) -> DataFrame:
    """the looked-up cell is a number. Labels are in column 0."""
    mine = rules.where("tipo_teste = 'valor_normalizavel'").withColumn("coluna_rotulo", F.lit(0))
    at = _rule_rows(mine, cells, synonyms).join(mine.select(*RULE, F.col("indice_coluna_esperado").alias("column_index")), RULE)
    read = at.join(cells.select(*TABLE, "row_index", "column_index", "value_raw"), [*TABLE, "row_index", "column_index"])
    return _verdict(mine, read.where(numbers.number_of(F.col("value_raw")).isNotNull()))


RULE_KINDS = ("arquivo_existe", "secao_existe", "linha_existe_em_tabela", "perfil_colunas_periodo_existe_em_tabela", "valor_normalizavel")


def check_rules(rules: DataFrame, evidence: dict[str, DataFrame], synonyms: DataFrame) -> DataFrame:
    """Verdict of every rule; a kind nobody knows is rejected."""
    odd = rules.where(~rules.tipo_teste.isin(*RULE_KINDS)).select(
        *RULE, "tipo_teste", "codigo_falha", F.lit("reprovada").alias("status")
    )
    return reduce(
        DataFrame.unionByName,
        [
            rule_artifact_exists(rules, evidence["artifacts"]),
            rule_section_exists(rules, evidence["sections"]),
            rule_row_exists(rules, evidence["cells"], synonyms),
            rule_period_columns(rules, evidence["headers"]),
            rule_value_parses(rules, evidence["cells"], synonyms),
            odd,
        ],
    )


def compatibility(results: DataFrame, runs: DataFrame) -> DataFrame:
    """compatible when no rule failed, also when there was none; alert codes sorted.

    Codes are few per run: the distinct failure codes of its rules.
    """
    failed = F.col("status") == "reprovada"
    counted = results.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("rules_total"), F.count_if(~failed).alias("rules_passed"),
        F.array_sort(F.collect_set(F.when(failed, F.coalesce("codigo_falha", F.lit("FALHA_DETERMINISTICA"))))).alias("alert_codes"),
    )
    zero = F.lit(0).cast("long")
    joined = runs.select("document_id").join(counted, "document_id", "left").select(
        "document_id", F.coalesce("rules_total", zero).alias("rules_total"), F.coalesce("rules_passed", zero).alias("rules_passed"),
        F.coalesce("alert_codes", F.expr("cast(array() as array<string>)")).alias("alert_codes"),
    )
    rejected = F.col("rules_total") - F.col("rules_passed")
    return joined.withColumn("rules_failed", rejected).withColumn("status", F.when(rejected == 0, "compativel").otherwise("incompativel"))


# --- loading ----------------------------------------------------------------------------------


def missing_layout(runs: DataFrame, current: DataFrame, keys: tuple[str, ...] = ("domain", "entity")) -> DataFrame:
    """runs without a current layout ask for its creation; overrides and revalidations do not."""
    asks = runs.where("layout_override is null and coalesce(mode, '') <> 'revalidacao_layout_candidato'")
    gone = asks.join(current.select(*keys).distinct(), list(keys), "left_anti")
    return gone.select(
        *runs.columns, F.lit(True).alias("layout_alterado"), F.lit("layout_signature_ausente").alias("status_compatibilidade"),
        F.lit("criacao_inicial_layout").alias("fallback_mode"),
    )


def choose_contract(runs: DataFrame, active: DataFrame, keys: tuple[str, ...] = ("domain",)) -> DataFrame:
    """an explicit override wins over the active highest version; the historic one is kept
    beside it. ``active`` has one ``contract_uri`` per key."""
    newest = active.select(*keys, F.col("contract_uri").alias("_active"))
    return runs.join(broadcast_if_small(newest), list(keys), "left").select(
        *runs.columns, F.coalesce("contract_override", "_active").alias("chosen_contract"),
        F.coalesce(F.col("contract_uri") != F.coalesce("contract_override", "_active"), F.lit(False)).alias("differs_from_historic"),
    )
