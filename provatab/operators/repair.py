"""Deterministic part of layout repair (G1-G18): what failed, which evidence may replace it, and
whether a proposed layout holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provatab.cluster import CHUNK, broadcast_if_small, checkpointed, running_totals, shuffled
from provatab.functions import paths, periods
from provatab.functions import text as tx
from provatab.operators.contract import CONTRACT, key_filters, match_targets
from provatab.operators.matching import literal_matches
from provatab.operators.tables import TABLE

# Repair scopes and key names a candidate must not hold.
NOT_FOR_REPAIR = "nao_aplicavel"
PARTIAL, TOTAL, CREATION, UNSUPPORTED = (
    "correcao_parcial_mapeamento",
    "regeneracao_total_mapeamento",
    "criacao_inicial_layout",
    "falha_nao_suportada_para_fallback_automatico",
)
FINAL_VALUE_KEYS = (
    "valor_resolvido",
    "valor_final",
    "valor_extraido",
    "schema_saida_resolvido",
    "dados_resolvidos",
    "resultado_resolvido",
)
PROTECTED_HEADERS = ("empresa", "entidade", "documento_origem")
MIN_TERM = 3


# --- classification ---------------------------------------------------------------------------


def classify_failures(runs: DataFrame, rules: DataFrame, audit: DataFrame) -> DataFrame:
    """G1: repair scope of each run.

    ``runs`` has ``document_id, status`` (a compatible run that asks is
    ``nao_aplicavel``, and stops no other), ``rules`` the rule
    verdicts with ``profile_open`` where a period profile was left unresolved.
    """
    bad = rules.where("status = 'reprovada'")
    kind = F.col("tipo_teste")
    profile = kind == "perfil_colunas_periodo_existe_em_tabela"
    total = kind.isin("arquivo_existe", "secao_existe") | (profile & F.col("profile_open"))
    partial = kind.isin("linha_existe_em_tabela", "valor_normalizavel") | (profile & ~F.col("profile_open"))
    per_rule = bad.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("rejected"), F.count_if(total).alias("_total"), F.count_if(partial).alias("_partial")
    )
    open_ = audit.where("obrigatorio and status_resolucao <> 'resolvido'").groupBy("document_id").agg(F.count(F.lit(1)).alias("open_required"))
    zero = F.lit(0).cast("long")
    joined = runs.join(per_rule, "document_id", "left").join(open_, "document_id", "left").select(
        "document_id", "status", *[F.coalesce(c, zero).alias(c) for c in ("rejected", "_total", "_partial", "open_required")]
    )
    broad = (F.col("_total") > 0) | (F.col("rejected") >= 3) | (F.col("open_required") > 2)
    narrow = (F.col("_partial") > 0) | F.col("open_required").between(1, 2)
    scope = (
        F.when(F.col("status") == "compativel", NOT_FOR_REPAIR)
        .when(F.col("status") != "incompativel", UNSUPPORTED)
        .when(broad, TOTAL)
        .when(narrow, PARTIAL)
        .otherwise(UNSUPPORTED)
    )
    return joined.select("document_id", "status", "rejected", "open_required", scope.alias("scope"))


# --- search terms and evidence ----------------------------------------------------------------


def search_terms(reqs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Terms that may show the evidence of a requirement: ``(contract, path, term, origin)``.

    ``vocabulary`` has ``kind, metric, name, term`` with ``kind`` one of ``metric``,
    ``indicator``, ``entity`` (``name`` is then a value of its domain). A metric group counts
    when a path segment names it or an observation selects one of its indicators; with selected
    indicators only those of the group count.
    """
    parts = reqs.select(*CONTRACT, "path", F.explode(F.split("path", "\\.")).alias("segment")).distinct()
    picked = reqs.select(*CONTRACT, "path", F.explode(F.map_values("selectors")).alias("name")).distinct()
    words = vocabulary.withColumn("term", tx.normalize_text(F.col("term"))).where(F.length("term") >= MIN_TERM)
    groups = words.where("kind in ('metric', 'indicator')")
    indicators = groups.where("kind = 'indicator'").select(*CONTRACT, "metric", "name").distinct()
    chosen = picked.join(indicators, [*CONTRACT, "name"]).select(*CONTRACT, "path", "metric", "name")
    in_path = (
        parts.withColumnRenamed("segment", "metric")
        .join(groups.select(*CONTRACT, "metric").distinct(), [*CONTRACT, "metric"])
        .select(*CONTRACT, "path", "metric")
    )
    used = in_path.unionByName(chosen.select(*CONTRACT, "path", "metric")).distinct()
    narrowed = chosen.select(*CONTRACT, "path", "metric").distinct().withColumn("_narrow", F.lit(True))
    reach = used.join(narrowed, [*CONTRACT, "path", "metric"], "left")
    metric_terms = reach.join(groups.where("kind = 'metric'"), [*CONTRACT, "metric"]).select(
        *CONTRACT, "path", "term", F.concat(F.lit("metrica:"), "metric").alias("origin")
    )
    words_of = reach.join(groups.where("kind = 'indicator'"), [*CONTRACT, "metric"])
    selected = chosen.select(*CONTRACT, "path", "metric", "name").withColumn("_sel", F.lit(True))
    indicator_terms = words_of.join(selected, [*CONTRACT, "path", "metric", "name"], "left").where("_narrow is null or _sel").select(
        *CONTRACT, "path", "term", F.concat(F.lit("indicador:"), "name").alias("origin")
    )
    entity_terms = picked.join(words.where("kind = 'entity'"), [*CONTRACT, "name"]).select(
        *CONTRACT, "path", "term", F.concat(F.lit("entidade:"), "metric").alias("origin")
    )
    guidance = reqs.select(*CONTRACT, "path", F.explode(F.concat(*[F.coalesce(F.col(f"guidance.{k}"), F.expr("cast(array() as array<string>)")) for k in ("termos", "ancoras", "rotulos")])).alias("term")).select(
        *CONTRACT, "path", tx.normalize_text(F.col("term")).alias("term"), F.lit("orientacao_origem").alias("origin")
    ).where(F.length("term") >= MIN_TERM)
    found = reduce(DataFrame.unionByName, [metric_terms, indicator_terms, entity_terms, guidance])
    return found.groupBy(*CONTRACT, "path", "term").agg(F.min("origin").alias("origin"))


def prefilter(terms: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Candidate artefacts per requirement with the terms met.

    ``terms`` has ``path, term``; ``artifacts`` has ``document_id, artifact, summary, complete,
    full_text`` (null when it cannot be read). A term in the summary decides; otherwise an
    artefact whose summary is incomplete is judged by its full text, and kept unread.
    Matching runs once over each text, whatever the number of requirements.
    """
    ids = ["document_id", "artifact"]
    short = artifacts.select(*ids, tx.normalize_text(F.col("summary")).alias("text"))
    long_ = artifacts.where("not complete and full_text is not null").select(*ids, tx.normalize_text(F.col("full_text")).alias("text"))
    small = broadcast_if_small(terms.select("path", "term").distinct())
    by_summary = literal_matches(short, terms, ids).join(small, "term").select(*ids, "path", "term")
    by_text = (
        literal_matches(long_, terms, ids).join(small, "term").select(*ids, "path", "term")
        .join(by_summary.select(*ids, "path").distinct(), [*ids, "path"], "left_anti")
    )
    met = by_summary.withColumn("source", F.lit("resumo")).unionByName(by_text.withColumn("source", F.lit("artefato_completo")))
    listed = met.groupBy(*ids, "path", "source").agg(F.array_sort(F.collect_set("term")).alias("terms")).select(
        *ids, "path", F.lit("termo_casado").alias("reason"), "source", "terms"
    )
    paths_ = broadcast_if_small(terms.select("path").distinct())
    unread = artifacts.where("not complete and full_text is null").select(*ids).crossJoin(paths_)
    kept = unread.join(by_summary.select(*ids, "path").distinct(), [*ids, "path"], "left_anti").select(
        *ids, "path", F.lit("amostra_incompleta").alias("reason"), F.lit(None).cast("string").alias("source"), F.expr("cast(array() as array<string>)").alias("terms")
    )
    return listed.unionByName(kept)


def prune_evidence(anchors: DataFrame, indicator_terms: DataFrame, required: DataFrame, by: tuple[str, ...] = ("document_id", "unit")) -> DataFrame:
    """Drop artefacts that anchor no indicator, only where the others cover all required ones.

    ``anchors`` has the keys, ``artifact`` and ``anchor`` (null for none), ``indicator_terms``
    ``unit, indicator, term``, ``required`` ``unit, indicator``. Returns ``artifact, kept``.
    """
    by = list(by)
    keyed = anchors.where("anchor is not null").select(*by, "artifact", "anchor", tx.normalize_term(F.col("anchor")).alias("text"))
    terms = indicator_terms.select("unit", "indicator", tx.normalize_term(F.col("term")).alias("term")).where(F.length("term") >= MIN_TERM)
    hits = literal_matches(keyed, terms, [*by, "artifact", "anchor"], scope=["unit"]).join(broadcast_if_small(terms), ["unit", "term"])
    named = hits.select(*by, "artifact", "indicator").distinct()
    needed = required.join(terms.select("unit", "indicator").distinct(), ["unit", "indicator"], "left_semi")
    asked = needed.groupBy("unit").agg(F.count_distinct("indicator").alias("_need"))
    covered = named.join(broadcast_if_small(needed), ["unit", "indicator"], "left_semi").groupBy(*by).agg(F.count_distinct("indicator").alias("_have"))
    specific = named.select(*by, "artifact").distinct().withColumn("_specific", F.lit(True))
    all_ = anchors.select(*by, "artifact").distinct()
    joined = all_.join(specific, [*by, "artifact"], "left").join(covered, by, "left").join(broadcast_if_small(asked), "unit", "left")
    safe = F.coalesce(F.col("_have") >= F.col("_need"), F.lit(False))
    return joined.select(*by, "artifact", (F.coalesce("_specific", F.lit(False)) | ~safe).alias("kept"))


def check_selection(
    selection: DataFrame, inventory: DataFrame, artifacts: DataFrame, required: DataFrame, candidates: DataFrame, fields: DataFrame, limit: int
) -> DataFrame:
    """Violations of a selection ``(document_id, artifact, path, anchor)``.

    Artefacts must be in the inventory, within the limit; fields in the contract; anchors
    literally in the artefact; artefacts among the candidates of the field where there are any;
    every required field covered.
    """
    picked = selection.select("document_id", "artifact").distinct()

    def row(df: DataFrame, rule: str, detail: Column) -> DataFrame:
        return df.select("document_id", F.lit(rule).alias("rule"), detail.alias("detail"))

    outside = row(picked.join(shuffled(inventory), ["document_id", "artifact"], "left_anti"), "outside_inventory", F.col("artifact"))
    many = picked.groupBy("document_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
    over = row(many, "too_many", F.col("n").cast("string"))
    cover = selection.select("document_id", "artifact", "path", "anchor").where("path is not null")
    unknown = row(cover.select("document_id", "path").distinct().join(broadcast_if_small(fields.select("path").distinct()), "path", "left_anti"), "field_outside_contract", F.col("path"))
    has_candidates = candidates.select("document_id", "path").distinct()
    foreign = row(
        cover.select("document_id", "artifact", "path").distinct()
        .join(has_candidates, ["document_id", "path"], "left_semi")
        .join(candidates.select("document_id", "path", "artifact"), ["document_id", "path", "artifact"], "left_anti"),
        "not_a_candidate", F.concat_ws(":", "path", "artifact"),
    )
    texts = artifacts.select("document_id", "artifact", tx.normalize_text(F.col("full_text")).alias("_t"))
    claimed = cover.where("anchor is not null").join(shuffled(texts), ["document_id", "artifact"], "left")
    missing = row(
        claimed.where(~F.coalesce(F.col("_t").contains(tx.normalize_text(F.col("anchor"))), F.lit(False))), "anchor_missing", F.concat_ws(":", "artifact", "anchor")
    )
    wanted = picked.select("document_id").distinct().crossJoin(broadcast_if_small(required.select("path").distinct()))
    uncovered = row(wanted.join(shuffled(cover.select("document_id", "path").distinct()), ["document_id", "path"], "left_anti"), "required_uncovered", F.col("path"))
    return reduce(DataFrame.unionByName, [outside, over, unknown, foreign, missing, uncovered])


# --- columns, groups and rows -----------------------------------------------------------------


def column_roles(structure: DataFrame, expected: DataFrame) -> DataFrame:
    """Column of each role per table: exactly one header that is the expected period.

    ``structure`` comes from ``table_structure``, ``expected`` from ``expected_periods``. The
    verdict is ``resolvido``, ``ambiguo`` or ``ausente``.
    """
    heads = structure.select(*TABLE, "label_column", F.posexplode("header").alias("column_index", "header")).where("column_index <> label_column")
    dated = heads.withColumn("period", periods.period_of(F.col("header"))).where("period is not null")
    per_period = dated.groupBy(*TABLE, "period").agg(F.count(F.lit(1)).alias("_n"), F.min("column_index").alias("_c"), F.min_by("header", "column_index").alias("_h"))
    asked = structure.select(*TABLE).join(expected.select("document_id", "selector", "role", "period"), "document_id")
    joined = asked.join(per_period, [*TABLE, "period"], "left")
    one = F.col("_n") == 1
    return joined.select(
        *TABLE, "selector", "role", F.when(one, "resolvido").when(F.col("_n") > 1, "ambiguo").otherwise("ausente").alias("verdict"),
        F.when(one, F.col("_c")).alias("column_index"), F.when(one, F.col("_h")).alias("column_header"),
    )


def table_groups(tables: DataFrame, labels: DataFrame, group_terms: DataFrame) -> DataFrame:
    """Metric group of a table: the only one its title names, else the majority of its row
    labels; a tie decides nothing.

    ``group_terms`` has ``metric, use, term`` with ``use`` ``title`` or ``row``.
    """
    terms = group_terms.select("metric", "use", tx.normalize_term(F.col("term")).alias("term")).where(F.length("term") >= MIN_TERM).distinct()
    titles, words = terms.where("use = 'title'"), terms.where("use = 'row'")
    named = tables.select(*TABLE, tx.normalize_term(F.col("name")).alias("text")).where("text <> ''")
    by_title = (
        literal_matches(named, titles, TABLE).join(broadcast_if_small(titles.select("term", "metric")), "term")
        .select(*TABLE, "metric").distinct()
        .groupBy(*TABLE).agg(F.count(F.lit(1)).alias("_n"), F.min("metric").alias("_m")).where("_n = 1")
        .select(*TABLE, F.col("_m").alias("_title"))
    )
    # Labels repeat across tables: each distinct one is matched once.
    keyed = labels.where("label <> ''").select(*TABLE, "row_index", tx.normalize_term(F.col("label")).alias("text"))
    distinct = keyed.select("text").distinct()
    meaning = literal_matches(distinct.withColumn("_k", F.col("text")), words, ["_k"]).join(broadcast_if_small(words.select("term", "metric")), "term").select(F.col("_k").alias("text"), "metric").distinct()
    votes = keyed.join(meaning, "text").groupBy(*TABLE, "metric").agg(F.count(F.lit(1)).alias("_v"))
    best = votes.groupBy(*TABLE).agg(F.max("_v").alias("_v"))
    winner = votes.join(best, [*TABLE, "_v"]).groupBy(*TABLE).agg(F.count(F.lit(1)).alias("_n"), F.min("metric").alias("_m")).where("_n = 1").select(*TABLE, F.col("_m").alias("_vote"))
    return tables.select(*TABLE).join(by_title, TABLE, "left").join(winner, TABLE, "left").select(*TABLE, F.coalesce("_title", "_vote").alias("metric")).where("metric is not null")


def row_anchors(
    labels: DataFrame, groups: DataFrame, asked: DataFrame, identities: DataFrame, *, chunk: int = CHUNK
) -> DataFrame:
    """The only row of a document that a requested indicator can mean.

    ``labels`` comes from ``row_labels``; ``asked`` has ``document_id, request, metric, term``
    (its synonyms); ``identities`` ``document_id, entity``. Rows hold a synonym in the label and
    a number beside it, in a table of the same group or of none. Where the rows that follow a
    category name the document's entity once, that row replaces it; named twice, neither counts.
    A request with one surviving row is anchored.
    """
    terms = asked.select("document_id", "request", "metric", tx.normalize_term(F.col("term")).alias("term")).where(F.length("term") >= MIN_TERM).distinct()
    keyed = labels.where("label <> ''").select(*TABLE, "row_index", "label", "n_numeric", tx.normalize_term(F.col("label")).alias("text"))
    vocabulary = terms.select("term").distinct()
    distinct = keyed.select("text").distinct().withColumn("_k", F.col("text"))
    meaning = literal_matches(distinct, vocabulary, ["_k"]).select(F.col("_k").alias("text"), "term")
    hits = (
        keyed.where("n_numeric > 0").join(meaning, "text").join(terms, ["document_id", "term"])
        .select(*TABLE, "row_index", "label", "text", "request", "metric").distinct()
    )
    grouped = hits.join(groups.withColumnRenamed("metric", "_group"), TABLE, "left").where("_group is null or metric is null or _group = metric")
    # Blocks of consecutive valued rows: a row without label or number breaks them.
    who = identities.select("document_id", tx.normalize_term(F.col("entity")).alias("_e")).where(F.length("_e") >= MIN_TERM)
    all_rows = labels.join(who, "document_id", "left").withColumn("text", tx.normalize_term(F.col("label")))
    solid = (F.col("label") != "") & (F.col("n_numeric") > 0)
    mine = solid & F.col("_e").isNotNull() & (F.col("text").contains(F.col("_e")) | F.col("_e").contains(F.col("text")))
    marked = all_rows.withColumns({"_solid": F.coalesce(solid, F.lit(False)), "_mine": F.coalesce(mine, F.lit(False)).cast("long")})
    counted = running_totals(
        marked.select(*TABLE, "row_index", "label", "_solid", "_mine", "_e", "text"), TABLE, "row_index",
        {"_block": F.when(F.col("_solid"), 0).otherwise(1).cast("long"), "_upto": F.col("_mine")}, chunk=chunk,
    )
    ends = counted.where("_solid").groupBy(*TABLE, "_block").agg(F.max("_upto").alias("_end"))
    names = counted.where("_mine = 1").select(
        *TABLE, "_block", F.col("_upto").alias("_next_nth"), F.col("row_index").alias("_child"), F.col("label").alias("_child_label")
    )
    at = grouped.join(counted.select(*TABLE, "row_index", "_block", "_upto", "_e"), [*TABLE, "row_index"]).join(ends, [*TABLE, "_block"], "left")
    later = F.coalesce("_end", "_upto") - F.col("_upto")
    is_category = F.col("_e").isNotNull() & ~F.coalesce(F.col("text").contains(F.col("_e")), F.lit(False))
    sized = at.withColumn("_later", F.when(is_category, later).otherwise(0)).where("_later <= 1")
    followed = sized.withColumn("_next_nth", F.col("_upto") + 1).join(names, [*TABLE, "_block", "_next_nth"], "left")
    swapped = F.col("_later") == 1
    rows = followed.select(
        "document_id", "request", "table_id", F.when(swapped, F.col("_child")).otherwise(F.col("row_index")).alias("row_index"),
        F.when(swapped, F.col("_child_label")).otherwise(F.col("label")).alias("row_label"),
    )
    return rows.groupBy("document_id", "request").agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct("table_id", "row_index", "row_label")).alias("_r")
    ).where("_n = 1").select("document_id", "request", "_r.table_id", "_r.row_index", "_r.row_label")


def attach_anchors(targets: DataFrame, anchors: DataFrame, roles: DataFrame) -> DataFrame:
    """Expected value entries with their anchored row, and the column their role has there.

    ``targets`` has ``document_id, target, request, target_role, array_mode, selectors``.
    """
    open_ = (F.col("target_role") == "valor") & (F.col("array_mode") == "item")
    keyed = targets.withColumn("_req", F.when(open_, F.col("request")))
    found = keyed.join(anchors.withColumnRenamed("request", "_req"), ["document_id", "_req"], "left")
    asked = found.where("table_id is not null").select("document_id", "target", "table_id", F.explode("selectors").alias("selector", "role"))
    placed = asked.join(roles.where("verdict = 'resolvido'").select(*TABLE, "selector", "role", "column_index", "column_header"), [*TABLE, "selector", "role"])
    first = placed.groupBy("document_id", "target").agg(F.min_by(F.struct("column_index", "column_header"), "selector").alias("_c"))
    return found.join(first, ["document_id", "target"], "left").select(
        *targets.columns, "table_id", "row_index", "row_label", F.col("_c.column_index").alias("column_index"), F.col("_c.column_header").alias("column_header")
    )


# --- candidate checks -------------------------------------------------------------------------


def _rule(df: DataFrame, rule: str, detail: Column | None = None) -> DataFrame:
    path = F.col("mapping_path") if "mapping_path" in df.columns else F.lit(None).cast("string")
    return df.select("document_id", F.lit(rule).alias("rule"), path.alias("mapping_path"), (F.lit(None) if detail is None else detail).cast("string").alias("detail"))


def check_candidates(
    candidates: DataFrame,
    mappings: DataFrame,
    nodes: DataFrame,
    keys: DataFrame,
    *,
    base: DataFrame | None = None,
    targets: DataFrame | None = None,
    anchors: DataFrame | None = None,
    roles: DataFrame | None = None,
    matched: DataFrame | None = None,
) -> DataFrame:
    """One row per broken rule; a candidate is valid when it has none.

    ``candidates`` has one row per document: ``scope, allowed_scope, candidate_document,
    candidate_execution, execution_id, candidate_base, base_key, extra_sections, payload``.
    ``mappings`` are the proposed mappings with the columns of ``resolve``.
    """
    by = [c for c in CONTRACT if c in mappings.columns]
    # Every rule reads them: paths are taken apart and targets made once.
    mappings = checkpointed(mappings)
    keyed = checkpointed(key_filters(mappings))
    targets = None if targets is None else checkpointed(targets)
    known = broadcast_if_small(nodes.select(*by, "path").distinct())
    literal = broadcast_if_small(nodes.where("literal is not null").select(*by, "path"))
    arrays = broadcast_if_small(nodes.where("is_array").select(*by, F.col("path").alias("array_path")))
    found = [
        _rule(keyed.join(literal, [*by, "path"], "left_semi"), "fixed_value_mapped"),
        _rule(keyed.where(F.col("mapping_path").rlike("\\[[^\\]]*=[^\\]]*&\\s*[A-Za-z_][A-Za-z0-9_.]*\\s*=")), "chained_filter"),
        _rule(keyed.where("not valid"), "path_unreadable"),
        _rule(keyed.where("valid").join(known, [*by, "path"], "left_anti"), "path_outside_schema"),
    ]
    crossed = keyed.where("valid").join(arrays, by or None) if by else keyed.where("valid").crossJoin(arrays)
    own = F.col("path") == F.col("array_path")
    inside = own | F.col("path").startswith(F.concat("array_path", F.lit(".")))
    whole = own & (F.col("tipo_origem") == "linhas_de_tabela")
    filtered = F.exists("key_filters", lambda f: f["array_path"] == F.col("array_path"))
    found.append(_rule(crossed.where(inside & ~whole & ~filtered), "array_without_selector", F.col("array_path")))
    used = keyed.where("valid").select("document_id", "mapping_path", *by, "path", F.explode("key_filters").alias("_f")).select(
        "document_id", "mapping_path", *by, "path", F.col("_f.array_path").alias("array_path"), F.col("_f.key").alias("key")
    )
    declared = used.join(broadcast_if_small(keys.select(*by, "array_path", "item_key")), [*by, "array_path"])
    found.append(_rule(declared.where("key <> item_key"), "wrong_item_key", F.concat_ws(":", "array_path", "key")))
    found.append(_rule(declared.where("key = item_key and path = array_path"), "ends_in_array", F.col("array_path")))
    c = candidates
    found += [
        _rule(c.where("coalesce(allowed_scope, '') <> '' and scope <> allowed_scope"), "scope_not_allowed", F.col("scope")),
        _rule(c.where("candidate_document <> document_id or candidate_execution <> execution_id"), "lineage"),
        _rule(c.where((F.col("scope") == CREATION) & F.col("candidate_base").isNotNull()), "creation_with_base"),
        _rule(c.where((F.col("scope") != CREATION) & ~F.coalesce(F.col("candidate_base") == F.col("base_key"), F.lit(False))), "base_differs"),
        _rule(c.where((F.col("scope") == PARTIAL) & (F.size("extra_sections") > 0)), "extra_sections"),
        _rule(c.where(F.arrays_overlap("extra_sections", F.array(*[F.lit(h) for h in PROTECTED_HEADERS]))), "protected_header"),
        _rule(c.where(F.col("payload").rlike('"(' + "|".join(FINAL_VALUE_KEYS) + ')"\\s*:')), "final_value"),
    ]
    table = F.col("tipo_origem").isin("cabecalho_de_tabela", "celula_de_tabela")
    found.append(_rule(mappings.where(table & F.col("indice_coluna_esperado").isNull()), "column_index_missing"))
    blank = F.coalesce(F.trim("valor_aceito"), F.lit("")) == ""
    found.append(_rule(mappings.where((F.col("tipo_origem") == "celula_de_tabela") & blank), "row_label_missing"))
    if base is not None:
        kept = base.join(candidates.where(F.col("scope") == PARTIAL).select("document_id"), "document_id", "left_semi")
        found.append(_rule(kept.join(mappings.select("document_id", "mapping_path"), ["document_id", "mapping_path"], "left_anti"), "base_mapping_lost"))
    if targets is not None:
        matched, unexpected, missing = match_targets(targets, mappings)
        if base is not None:
            partial = base.join(candidates.where(F.col("scope") == PARTIAL).select("document_id"), "document_id", "left_semi")
            unexpected = unexpected.join(partial.select("document_id", "mapping_path"), ["document_id", "mapping_path"], "left_anti")
        found += [_rule(unexpected, "unexpected_key"), _rule(missing, "required_not_covered", F.col("target"))]
    if matched is not None and anchors is not None:
        cells = mappings.where("tipo_origem = 'celula_de_tabela'").join(matched.select("document_id", "mapping_path", "target"), ["document_id", "mapping_path"])
        wrong = cells.join(anchors.select("document_id", "target", "table_id", "row_label"), ["document_id", "target"])
        same = tx.normalize_term(F.col("valor_aceito")) == tx.normalize_term(F.col("row_label"))
        file = F.coalesce(F.trim("arquivo_origem"), F.lit(""))
        found.append(_rule(wrong.where(~(F.coalesce(same, F.lit(False)) & ((file == "") | (file == F.col("table_id"))))), "row_differs_from_anchor", F.col("row_label")))
    if matched is not None and roles is not None and targets is not None:
        sel = targets.select("document_id", "target", F.explode("selectors").alias("selector", "role"))
        columns = (
            mappings.where(table).join(matched.select("document_id", "mapping_path", "target"), ["document_id", "mapping_path"])
            .join(sel, ["document_id", "target"])
            .join(roles.where("verdict = 'resolvido'").select("document_id", F.col("table_id").alias("arquivo_origem"), "selector", "role", "column_index"), ["document_id", "arquivo_origem", "selector", "role"])
        )
        found.append(_rule(columns.where("not (coalesce(indice_coluna_esperado, -1) = column_index)"), "column_differs_from_role", F.col("column_index")))
    return reduce(DataFrame.unionByName, found)


def _observed(reqs: DataFrame, mappings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Observations per document, and mapped paths with their selectors."""
    selectors = paths.path_selectors(F.col("mapping_path"))
    mapped = mappings.select("document_id", "mapping_path", paths.plain_path(F.col("mapping_path")).alias("path"), selectors.alias("sel"))
    docs = mappings.select("document_id").distinct()
    wanted = F.array_sort(F.transform(F.map_entries("selectors"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    none = F.expr("cast(array() as array<string>)")
    obs = docs.crossJoin(broadcast_if_small(reqs.select("ord", "obs", "path", "required", "context_fields", F.coalesce(wanted, none).alias("want"))))
    return obs, mapped


def _holds(has: str, want: str) -> Column:
    return F.size(F.array_except(want, has)) == 0


def missing_observations(reqs: DataFrame, mappings: DataFrame, required: bool) -> DataFrame:
    """``(document_id, path, selectors)`` of observations a candidate leaves open.

    A missing optional value takes its context fields with it; a present value needs each of
    them with its own selectors.
    """
    obs, mapped = _observed(reqs, mappings)
    obs = obs.where(F.col("required") == required)
    parent = F.regexp_replace("path", "\\.[^.]+$", "")
    ids = ["document_id", "ord", "obs"]
    key = [F.coalesce("obs", F.lit(-1)).alias("obs")]
    obs = obs.select("document_id", "ord", *key, "path", "context_fields", "want")
    value = obs.join(mapped.select("document_id", "path", "sel"), ["document_id", "path"]).where(_holds("sel", "want"))
    present = value.select(*ids, F.col("sel").alias("_vsel"))
    absent = obs.join(present.select(*ids).distinct(), ids, "left_anti")
    gone = absent.select("document_id", "path", F.col("want").alias("selectors"))
    if not required:
        side = absent.select("document_id", F.explode(F.transform("context_fields", lambda f: F.concat(parent, F.lit("."), f))).alias("path"), F.col("want").alias("selectors"))
        gone = gone.unionByName(side.select("document_id", "path", "selectors"))
    needed = obs.join(present.select(*ids).distinct(), ids, "left_semi").select(*ids, "want", F.explode(F.transform("context_fields", lambda f: F.concat(parent, F.lit("."), f))).alias("_ctx"))
    held = (
        needed.join(present, ids)
        .join(mapped.select("document_id", F.col("path").alias("_ctx"), F.col("sel").alias("_csel")), ["document_id", "_ctx"])
        .where(_holds("_csel", "_vsel"))
        .select(*ids, "_ctx").distinct()
    )
    open_context = needed.join(held, [*ids, "_ctx"], "left_anti").select("document_id", F.col("_ctx").alias("path"), F.col("want").alias("selectors"))
    return gone.unionByName(open_context)


def absence_check(missing: DataFrame, declared: DataFrame) -> DataFrame:
    """Declared absences against the missing ones: ``invalid`` and ``undeclared`` rows."""
    keys = ["document_id", "path", "selectors"]
    left, right = missing.select(*keys).distinct(), declared.select(*keys).distinct()
    return (
        right.join(left, keys, "left_anti").select(*keys, F.lit("invalid").alias("problem"))
        .unionByName(left.join(right, keys, "left_anti").select(*keys, F.lit("undeclared").alias("problem")))
    )


def orphan_context(missing: DataFrame, mappings: DataFrame) -> DataFrame:
    """Mapped context of observations without a value; these keys are removed."""
    sel = paths.path_selectors(F.col("mapping_path"))
    mapped = mappings.select("document_id", "mapping_path", paths.plain_path(F.col("mapping_path")).alias("path"), sel.alias("_sel"))
    hit = mapped.join(missing.select("document_id", "path", "selectors"), ["document_id", "path"]).where(_holds("_sel", "selectors"))
    return hit.select("document_id", "mapping_path").distinct()


def merge_fragments(fragments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One mapping set per document from its units, and the paths that collide (must be none)."""
    keys = ["document_id", "mapping_path"]
    clash = fragments.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return fragments.join(clash.select(*keys), keys, "left_anti"), clash


def fragment_scope(mappings: DataFrame, units: DataFrame) -> DataFrame:
    """Mappings of a unit that stop above its paths (``incompleto``) or leave it (``fora``).

    ``mappings`` has ``root`` (the unit), ``units`` its paths.
    """
    plain = mappings.withColumn("path", paths.plain_path(F.col("mapping_path")))
    mine = broadcast_if_small(units.select("root", F.col("path").alias("_u")))
    below = (F.col("path") == F.col("_u")) | F.col("path").startswith(F.concat("_u", F.lit(".")))
    above = F.col("_u").startswith(F.concat("path", F.lit(".")))
    judged = plain.join(mine, "root", "left").groupBy("document_id", "root", "mapping_path").agg(
        F.bool_or(F.coalesce(below, F.lit(False))).alias("_in"), F.bool_or(F.coalesce(above, F.lit(False))).alias("_up")
    )
    return judged.where("not _in").select("document_id", "root", "mapping_path", F.when(F.col("_up"), "incompleto").otherwise("fora").alias("problem"))


def revalidation_gate(validation: DataFrame, audit: DataFrame) -> DataFrame:
    """Approved when compatible and no required field is open; a missing audit only warns."""
    per_run = audit.groupBy("document_id").agg(F.count_if(F.col("obrigatorio") & (F.trim("status_resolucao") != "resolvido")).alias("_open"))
    joined = validation.join(per_run, "document_id", "left")
    alert = F.when(F.col("_open").isNull(), "AUDITORIA_REVALIDACAO_AUSENTE").when(F.col("_open") > 0, "OBRIGATORIOS_NAO_RESOLVIDOS_NA_REVALIDACAO")
    return joined.select(
        "document_id", "status", F.coalesce("_open", F.lit(0).cast("long")).alias("open_required"), alert.alias("alert"),
        ((F.col("status") == "compativel") & (F.coalesce("_open", F.lit(0)) == 0)).alias("approved"),
    )


def publish_layouts(base: DataFrame, approved: DataFrame, versions: DataFrame, keys: tuple[str, ...] = ("domain", "entity")) -> tuple[DataFrame, DataFrame]:
    """New layout rows (base sections not replaced, plus the approved ones) with their
    version, and the pointer rows to upsert.

    ``base`` and ``approved`` have the keys, ``section``, ``item`` and ``body``; ``versions``
    comes from ``next_minor_version``.
    """
    keys = list(keys)
    identity = [*keys, "section", "item"]
    touched = approved.select(*keys).distinct()
    kept = base.join(touched, keys, "left_semi").join(approved.select(*identity), identity, "left_anti")
    rows = kept.select(*identity, "body").unionByName(approved.select(*identity, "body"))
    numbered = rows.join(versions, keys, "left").withColumn("version", F.coalesce("next_version", F.lit("v1.0.0"))).drop("next_version")
    pointers = touched.join(versions, keys, "left").select(*keys, F.coalesce("next_version", F.lit("v1.0.0")).alias("current_version"))
    return numbered, pointers
