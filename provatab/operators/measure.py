"""Scores of runs, against gold data and between releases.

Metrics are rows ``(keys, name, value)``. A metric without a denominator has no row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provatab.cluster import broadcast_if_small, checkpointed, exact_quantile, first_per_key
from provatab.functions import paths
from provatab.functions import text as tx
from provatab.operators.contract import CONTRACT, key_filters, match_targets

NO_FILE_KINDS = ("valor_fixo", "campo_derivado")

# Metrics where more is better, where less is better, and those that may not regress.
HIGHER_IS_BETTER = (
    "e2e_sucesso",
    "e2e_autonomia_deterministica",
    "e2e_apto_para_bronze",
    "e2e_cobertura_final",
    "resolucao_cobertura_campos",
    "resolucao_cobertura_obrigatorios",
    "resolucao_cobertura_obs",
    "resolucao_cobertura_do_contrato",
    "validacao_taxa_aprovacao_regras",
    "validacao_cobertura_de_regras",
    "validacao_regras_total",
    "revalidacao_gate_efetivo",
    "revalidacao_regras_executadas",
    "llm_acerto_1a_tentativa",
    "llm_etapa_sucesso",
    "fallback_candidato_valido",
    "transicao_extracao_para_resolucao",
    "transicao_fallback_para_resolucao",
    "transicao_resolucao_para_bronze",
    "avaliacao_precisao",
    "avaliacao_revocacao",
    "avaliacao_f1",
    "avaliacao_igualdade_exata",
    "avaliacao_schema_valido",
    "avaliacao_candidato_valido",
    "avaliacao_acerto_tipo_origem",
    "avaliacao_acerto_arquivo_origem",
    "avaliacao_acerto_instrucao_origem",
    "selecao_evidencia_especifica",
    "selecao_prefiltro_reducao",
    "selecao_prefiltro_leitura_completa",
    "selecao_escolha_dentro_do_prefiltro",
    "estrutura_tabela_lida",
    "papel_coluna_origem_contrato",
    "assinatura_f0_selecao_precisao",
    "assinatura_f0_selecao_revocacao",
    "assinatura_f1_filtro_chave_declarada",
    "assinatura_f1_filtro_seletor_igual_ao_contrato",
    "assinatura_f1_cobertura_obrigatorios",
    "assinatura_f1_cobertura_opcionais",
    "assinatura_f1_estrutura_valida",
    "assinatura_f1_entradas_obrigatorias_cobertas",
    "assinatura_f1_contexto_irmao_presente",
    "assinatura_f1_filtro_valor_identidade_correto",
    "assinatura_f2_estrutura_tabela_lida",
    "assinatura_f2_papel_coluna_origem_contrato",
    "assinatura_f2_papel_coluna_correto",
    "assinatura_f3_arquivo_origem_correto",
    "assinatura_f3_rotulo_linha_correto",
    "assinatura_f3_indice_coluna_correto",
)
LOWER_IS_BETTER = (
    "e2e_tokens_llm",
    "e2e_duracao_segundos",
    "fallback_tokens_total",
    "fallback_tentativas_llm_total",
    "llm_tentativas",
    "llm_tokens_total",
    "resolucao_campos_nao_resolvidos",
    "validacao_regras_reprovadas",
    "transicao_resolucao_para_fallback",
    "selecao_evidencia_descartada",
    "selecao_candidatos_por_requisito",
    "assinatura_f0_selecao_artefatos_por_requisito",
    "assinatura_f1_array_sem_filtro",
    "assinatura_f1_paths_fora_do_permitido",
    "assinatura_f1_filtro_papel_literal",
    "assinatura_f1_chaves_fora_das_esperadas",
    "assinatura_f3_ausencia_falso_negativo",
    "assinatura_f3_ausencia_falso_positivo",
)
GUARDS = (
    "e2e_apto_para_bronze",
    "resolucao_cobertura_obrigatorios",
    "revalidacao_gate_efetivo",
    "validacao_cobertura_de_regras",
    "avaliacao_revocacao",
    "assinatura_f0_selecao_revocacao",
    "assinatura_f1_cobertura_obrigatorios",
    "assinatura_f3_arquivo_origem_correto",
)


def ratio(part: Column, whole: Column) -> Column:
    """Share in 0..1 rounded to 6; 0 for an empty whole."""
    return F.when(whole > 0, F.round(part / whole, 6)).otherwise(F.lit(0.0))


def metric_rows(wide: DataFrame, keys: Sequence[str], metrics: Mapping[str, Column]) -> DataFrame:
    """Long rows from one wide row per key; null values give no row."""
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), v.cast("double").alias("value")) for n, v in metrics.items()])
    return wide.select(*keys, F.explode(pairs).alias("_m")).select(*keys, "_m.name", "_m.value").where("value is not null")


# --- against a reference ----------------------------------------------------------------------


def set_metrics(found: DataFrame, expected: DataFrame, keys: Sequence[str], items: Sequence[str]) -> DataFrame:
    """Precision, recall, F1 and equality of two sets per key; keys without a reference give
    no row. One full join, one aggregate."""
    keys, items = list(keys), list(items)
    left = found.select(*keys, *items).distinct().withColumn("_f", F.lit(1))
    right = expected.select(*keys, *items).distinct().withColumn("_e", F.lit(1))
    n = left.join(right, [*keys, *items], "full").groupBy(*keys).agg(
        F.count(F.col("_f") + F.col("_e")).alias("hits"), F.count("_f").alias("found"), F.count("_e").alias("expected")
    ).where("expected > 0")
    scored = n.withColumns({"precision": ratio(F.col("hits"), F.col("found")), "recall": ratio(F.col("hits"), F.col("expected"))})
    total = F.col("precision") + F.col("recall")
    return scored.select(
        *keys, "hits", "found", "expected", "precision", "recall",
        F.when(total > 0, F.round(2 * F.col("precision") * F.col("recall") / total, 6)).otherwise(0.0).alias("f1"),
        F.when((F.col("hits") == F.col("found")) & (F.col("hits") == F.col("expected")), 1.0).otherwise(0.0).alias("exact"),
    )


def canonical_json(text: Column) -> Column:
    """Same text for the same JSON content, whatever its key order and null fields."""
    return F.to_json(F.try_parse_json(text))


def mapping_accuracy(found: DataFrame, expected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Share of common paths with the right origin kind, file and whole instruction.

    Both have ``mapping_path, tipo_origem, arquivo_origem, instruction`` (JSON). The file counts
    only where the reference reads one; keys without a common path give no row.
    """
    ids = [*keys, "mapping_path"]
    joined = found.alias("a").join(expected.alias("b"), ids)
    reads = ~F.coalesce(F.col("b.tipo_origem").isin(*NO_FILE_KINDS), F.lit(False)) & (F.coalesce("b.arquivo_origem", F.lit("")) != "")
    counted = joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("common"),
        F.count_if(F.col("a.tipo_origem").eqNullSafe(F.col("b.tipo_origem"))).alias("_k"),
        F.count_if(reads).alias("_files"),
        F.count_if(reads & F.col("a.arquivo_origem").eqNullSafe(F.col("b.arquivo_origem"))).alias("_f"),
        F.count_if(canonical_json(F.col("a.instruction")).eqNullSafe(canonical_json(F.col("b.instruction")))).alias("_i"),
    )
    return counted.select(
        *keys, "common", ratio(F.col("_k"), F.col("common")).alias("kind_accuracy"),
        F.when(F.col("_files") > 0, ratio(F.col("_f"), F.col("_files"))).alias("file_accuracy"), ratio(F.col("_i"), F.col("common")).alias("instruction_accuracy"),
    )


def validity(candidates: DataFrame, violations: DataFrame) -> DataFrame:
    """1 for a candidate no rule rejects, 0 otherwise; only where the context was checkable."""
    broken = violations.groupBy("document_id").agg(F.count(F.lit(1)).alias("_n"))
    return candidates.where("checkable").select("document_id").join(broken, "document_id", "left").select(
        "document_id", F.when(F.coalesce("_n", F.lit(0)) == 0, 1.0).otherwise(0.0).alias("valid")
    )


# --- phases of a layout -----------------------------------------------------------------------


def structure_metrics(mappings: DataFrame, nodes: DataFrame, keys: DataFrame, reqs: DataFrame) -> DataFrame:
    """Structure of a candidate's keys against the contract."""
    keyed = key_filters(mappings)
    docs = mappings.select("document_id").distinct()
    literal = nodes.where("literal is not null").select("path")
    allowed = broadcast_if_small(nodes.select("path").join(literal, "path", "left_anti").distinct())
    arrays = broadcast_if_small(nodes.where("is_array").select(F.col("path").alias("array_path")).distinct())
    outside = keyed.join(allowed, "path", "left_anti").groupBy("document_id").agg(F.count(F.lit(1)).alias("_outside"))
    has_filter = F.exists("key_filters", lambda f: f["array_path"] == F.col("array_path"))
    crossed = keyed.where("valid").crossJoin(arrays).where(F.col("path").startswith(F.concat("array_path", F.lit("."))) & ~has_filter)
    bare = crossed.groupBy("document_id").agg(F.count(F.lit(1)).alias("_bare"))
    used = keyed.where("valid").select("document_id", F.explode("key_filters").alias("_f")).select(
        "document_id", F.col("_f.array_path").alias("array_path"), F.col("_f.key").alias("key"), F.col("_f.value").alias("value")
    )
    values = broadcast_if_small(
        reqs.where("selectors is not null").select(F.explode("selectors").alias("key", "value")).distinct().withColumn("_known", F.lit(True))
    )
    declared = broadcast_if_small(keys.select("array_path", "item_key", "key_origin").distinct())
    judged = used.join(declared, "array_path", "left").join(values, ["key", "value"], "left")
    observed = F.col("key_origin") == "seletor_observacao"
    filters = judged.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("_filters"), F.count_if(F.col("key") == F.col("item_key")).alias("_key_ok"),
        F.count_if(observed).alias("_sel"), F.count_if(observed & F.col("_known")).alias("_sel_ok"),
        F.count_distinct(F.when(F.col("key_origin") == "identidade_documento", tx.normalize_text(F.col("value")))).alias("_entities"),
    )
    wanted = F.transform(F.map_entries("selectors"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    obs = broadcast_if_small(reqs.where("obs is not null").select("ord", "obs", "path", "required", wanted.alias("_want")))
    mapped = keyed.where("valid").select("document_id", F.col("path").alias("_p"), paths.path_selectors(F.col("mapping_path")).alias("_sel"))
    above = F.regexp_replace("path", "\\.[^.]+$", "")
    fits = (F.col("_p") == F.col("path")) | (F.col("_p") == above)
    met = mapped.join(obs, fits).where(F.size(F.array_except("_want", "_sel")) == 0).select("document_id", "ord", "obs", "required").distinct()
    coverage = met.groupBy("document_id").agg(F.count_if("required").alias("_req_ok"), F.count_if(~F.col("required")).alias("_opt_ok"))
    totals = reqs.where("obs is not null").agg(F.count_if("required").alias("_req"), F.count_if(~F.col("required")).alias("_opt"))
    flags = keys.agg((F.count(F.lit(1)) > 0).alias("_has_keys"), (F.count("key_origin") > 0).alias("_has_origins"))
    wide = docs
    for part in (outside, bare, filters, coverage):
        wide = wide.join(part, "document_id", "left")
    wide = wide.crossJoin(F.broadcast(totals)).crossJoin(F.broadcast(flags)).na.fill(0)
    c = F.col
    sound = (c("_bare") == 0) & (c("_outside") == 0) & (~c("_has_keys") | (c("_key_ok") == c("_filters"))) & (c("_sel_ok") == c("_sel"))
    return metric_rows(
        wide,
        ["document_id"],
        {
            "assinatura_f1_array_sem_filtro": c("_bare"),
            "assinatura_f1_paths_fora_do_permitido": c("_outside"),
            "assinatura_f1_filtro_chave_declarada": F.when(c("_has_keys") & (c("_filters") > 0), c("_key_ok") / c("_filters")),
            "assinatura_f1_filtro_seletor_igual_ao_contrato": F.when(c("_sel") > 0, c("_sel_ok") / c("_sel")),
            "assinatura_f1_filtro_papel_literal": F.when(c("_sel") > 0, c("_sel") - c("_sel_ok")),
            "assinatura_f1_entidades_no_candidato": F.when(c("_has_origins"), c("_entities")),
            "assinatura_f1_cobertura_obrigatorios": F.when(c("_req") > 0, c("_req_ok") / c("_req")),
            "assinatura_f1_cobertura_opcionais": F.when(c("_opt") > 0, c("_opt_ok") / c("_opt")),
            "assinatura_f1_estrutura_valida": sound.cast("double"),
        },
    )


def target_metrics(targets: DataFrame, mappings: DataFrame) -> DataFrame:
    """E5: coverage of the expected keys, keys outside them, context beside values, identity filters."""
    # Each is read by several sides below.
    targets, mappings = checkpointed(targets), checkpointed(mappings)
    matched, unexpected, missing = match_targets(targets, mappings)
    required = targets.where("required").groupBy("document_id").agg(F.count(F.lit(1)).alias("_req"))
    gone = missing.groupBy("document_id").agg(F.count(F.lit(1)).alias("_gone"))
    odd = unexpected.groupBy("document_id").agg(F.count(F.lit(1)).alias("_odd"))
    keyed = key_filters(mappings).select("document_id", "mapping_path", "key_filters")
    flat = F.array_sort(F.transform("key_filters", lambda f: F.concat_ws("=", f["array_path"], f["key"], f["value"])))
    got = matched.join(keyed, ["document_id", "mapping_path"]).select("document_id", "mapping_path", "target", flat.alias("_filters"))
    about = targets.select("document_id", "target", "requirement", "target_role", F.to_json("selectors").alias("_sel"))
    values = got.join(about.where("target_role = 'valor'"), ["document_id", "target"]).select("document_id", "mapping_path", "requirement", "_sel", "_filters")
    context = about.where("target_role = 'contexto'").select("document_id", "requirement", "_sel", F.col("target").alias("_ctx"))
    needed = values.join(context, ["document_id", "requirement", "_sel"])
    held = got.select("document_id", F.col("target").alias("_ctx"), "_filters").distinct().withColumn("_held", F.lit(True))
    per_value = needed.join(held, ["document_id", "_ctx", "_filters"], "left").groupBy("document_id", "mapping_path").agg(
        F.bool_and(F.coalesce("_held", F.lit(False))).alias("_all")
    )
    side = per_value.groupBy("document_id").agg(F.count(F.lit(1)).alias("_vals"), F.count_if("_all").alias("_vals_ok"))
    fixed = targets.select("document_id", F.explode("filters").alias("_f")).where("_f.origin = 'identidade_documento' and _f.value is not null")
    fixed = fixed.groupBy("document_id", F.col("_f.array_path").alias("array_path")).agg(F.max("_f.value").alias("_want"))
    used = keyed.select("document_id", F.explode("key_filters").alias("_f")).select("document_id", F.col("_f.array_path").alias("array_path"), F.col("_f.value").alias("_has"))
    same = used.join(fixed, ["document_id", "array_path"]).groupBy("document_id").agg(
        F.count(F.lit(1)).alias("_ids"), F.count_if(F.col("_has") == F.col("_want")).alias("_ids_ok")
    )
    wide = mappings.select("document_id").distinct()
    for part in (required, gone, odd, side, same):
        wide = wide.join(part, "document_id", "left")
    wide, c = wide.na.fill(0), F.col
    return metric_rows(
        wide,
        ["document_id"],
        {
            "assinatura_f1_entradas_obrigatorias_cobertas": F.when(c("_req") > 0, (c("_req") - c("_gone")) / c("_req")),
            "assinatura_f1_chaves_fora_das_esperadas": c("_odd"),
            "assinatura_f1_contexto_irmao_presente": F.when(c("_vals") > 0, c("_vals_ok") / c("_vals")),
            "assinatura_f1_filtro_valor_identidade_correto": F.when(c("_ids") > 0, c("_ids_ok") / c("_ids")),
        },
    )


def selection_metrics(selection: DataFrame, gold: DataFrame) -> DataFrame:
    """Precision and recall of chosen artefacts over the requirements both sides have, and
    the mean number of artefacts per covered requirement."""
    both = selection.select("document_id", "requirement").distinct().join(gold.select("document_id", "requirement").distinct(), ["document_id", "requirement"])
    docs = both.select("document_id").distinct()
    chosen = selection.select("document_id", "artifact").distinct().join(docs, "document_id", "left_semi").withColumn("_c", F.lit(1))
    wanted = gold.join(both, ["document_id", "requirement"], "left_semi").select("document_id", "artifact").distinct().withColumn("_e", F.lit(1))
    n = chosen.join(wanted, ["document_id", "artifact"], "full").groupBy("document_id").agg(
        F.count("_c").alias("_chosen"), F.count("_e").alias("_want"), F.count(F.col("_c") + F.col("_e")).alias("_hit")
    )
    per_req = selection.join(both, ["document_id", "requirement"], "left_semi").select("document_id", "requirement", "artifact").distinct()
    mean = per_req.groupBy("document_id").agg((F.count(F.lit(1)) / F.count_distinct("requirement")).alias("_mean"))
    c = F.col
    return metric_rows(
        n.join(mean, "document_id"),
        ["document_id"],
        {
            "assinatura_f0_selecao_precisao": F.when(c("_want") > 0, F.when(c("_chosen") > 0, c("_hit") / c("_chosen")).otherwise(0.0)),
            "assinatura_f0_selecao_revocacao": F.when(c("_want") > 0, c("_hit") / c("_want")),
            "assinatura_f0_selecao_artefatos_por_requisito": c("_mean"),
        },
    )


def role_metrics(structure: DataFrame, roles: DataFrame, gold_tables: DataFrame, gold_anchors: DataFrame) -> DataFrame:
    """Gold tables whose header was read; gold roles the contract resolved, and rightly.

    ``roles`` comes from ``column_roles``; ``gold_anchors`` has ``document_id, table_id, selector,
    role, column_index``.
    """
    tables = gold_tables.select("document_id", "table_id").distinct().join(structure, ["document_id", "table_id"])
    read = tables.groupBy("document_id").agg(F.count(F.lit(1)).alias("_tables"), F.count_if("header_read").alias("_read"))
    judged = gold_anchors.withColumnRenamed("column_index", "_gold").join(roles, ["document_id", "table_id", "selector", "role"])
    done = F.col("verdict") == "resolvido"
    n = judged.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("_all"), F.count_if(done).alias("_done"), F.count_if(done & (F.col("column_index") == F.col("_gold"))).alias("_right")
    )
    c = F.col
    return metric_rows(
        read.join(n, "document_id", "full").na.fill(0),
        ["document_id"],
        {
            "assinatura_f2_estrutura_tabela_lida": F.when(c("_tables") > 0, c("_read") / c("_tables")),
            "assinatura_f2_papel_coluna_origem_contrato": F.when(c("_all") > 0, c("_done") / c("_all")),
            "assinatura_f2_papel_coluna_correto": F.when(c("_done") > 0, c("_right") / c("_done")),
        },
    )


def anchoring_metrics(mappings: DataFrame, gold: DataFrame, absences: DataFrame, declared: DataFrame) -> DataFrame:
    """File, row and column of each gold observation; wrongly mapped and declared absences.

    ``gold`` has ``document_id, requirement, selectors`` (sorted normalised ``key=value``),
    ``arquivo_origem, rotulo_linha, indice_linha, indice_coluna``.
    """
    seg = F.filter(paths.path_segments(F.col("mapping_path")), lambda s: s["key"].isNotNull())
    sel = F.array_sort(F.transform(seg, lambda s: F.concat(s["key"], F.lit("="), tx.normalize_text(s["value"]))))
    mapped = mappings.select(
        "document_id", paths.plain_path(F.col("mapping_path")).alias("requirement"), sel.alias("selectors"), "ord",
        F.col("arquivo_origem").alias("_file"), tx.normalize_text(F.col("valor_aceito")).alias("_label"),
        F.col("indice_linha_esperado").alias("_row"), F.col("indice_coluna_esperado").alias("_col"),
    )
    ids = ["document_id", "requirement", "selectors"]
    mapped = first_per_key(mapped, ids, F.col("ord"), last=True).drop("ord").withColumn("_hit", F.lit(True))
    joined = gold.join(mapped, ids, "left")
    label = (F.col("_label") != "") & (F.col("_label") == tx.normalize_text(F.col("rotulo_linha")))
    right_row = label & (F.col("_row").isNull() | (F.col("_row") == F.col("indice_linha")))
    file = F.trim(F.coalesce("_file", F.lit("")), F.lit("/")) == F.trim(F.coalesce("arquivo_origem", F.lit("")), F.lit("/"))
    n = joined.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("_all"), F.count_if(F.col("_hit").isNull()).alias("_none"), F.count_if(F.col("_hit") & file).alias("_f"),
        F.count_if(F.col("_hit") & right_row).alias("_r"), F.count_if(F.col("_hit") & (F.col("_col") == F.col("indice_coluna"))).alias("_c"),
    )
    wrong = absences.withColumnRenamed("selectors", "_want").join(mapped, ["document_id", "requirement"], "left").groupBy("document_id", "requirement", "_want").agg(
        F.bool_or(F.coalesce(F.size(F.array_except("_want", "selectors")) == 0, F.lit(False))).alias("_mapped")
    )
    positives = wrong.groupBy("document_id").agg(F.count_if("_mapped").alias("_pos"))
    said = declared.distinct().groupBy("document_id").agg(F.count(F.lit(1)).alias("_said"))
    c = F.col
    wide = n.join(positives, "document_id", "full").join(said, "document_id", "left")
    return metric_rows(
        wide,
        ["document_id"],
        {
            "assinatura_f3_arquivo_origem_correto": c("_f") / c("_all"),
            "assinatura_f3_rotulo_linha_correto": c("_r") / c("_all"),
            "assinatura_f3_indice_coluna_correto": c("_c") / c("_all"),
            "assinatura_f3_ausencia_falso_negativo": c("_none"),
            "assinatura_f3_ausencia_falso_positivo": c("_pos"),
            "assinatura_f3_ausencia_declarada": F.when(c("_pos").isNotNull(), F.coalesce("_said", F.lit(0))),
        },
    )


# --- per run ----------------------------------------------------------------------------------


def extraction_metrics(artifacts: DataFrame, manifests: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Artefact, table and text-evidence counts of a manifest; ok with any table or block.

    ``artifacts`` are exploded URIs with ``kind``.
    """
    kind = F.col("kind")
    n = artifacts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_all"), F.count_if(kind == "tables").alias("_tables"), F.count_if(kind == "blocks").alias("_blocks"),
        F.count_if(kind.isin("blocks", "text_candidates")).alias("_texts"),
    )
    wide, c = manifests.select(*keys).join(n, list(keys), "left").na.fill(0), F.col
    return metric_rows(
        wide,
        keys,
        {
            "extracao_artefatos_total": c("_all"),
            "extracao_tabelas_detectadas": c("_tables"),
            "extracao_evidencias_textuais": c("_texts"),
            "extracao_ok": ((c("_tables") > 0) | (c("_blocks") > 0)).cast("double"),
        },
    )


def validation_metrics(compat: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rules run, approval rate, rejections and whether any rule ran at all."""
    c = F.col
    return metric_rows(
        compat,
        keys,
        {
            "validacao_regras_total": c("rules_total"),
            "validacao_taxa_aprovacao_regras": ratio(c("rules_passed"), c("rules_total")),
            "validacao_regras_reprovadas": c("rules_total") - c("rules_passed"),
            "validacao_cobertura_de_regras": (c("rules_total") > 0).cast("double"),
        },
    )


def resolution_metrics(audit: DataFrame, keys: Sequence[str], contract_leaves: DataFrame | None = None) -> DataFrame:
    """Coverage of all, required and observed fields, of the whole contract, and the share
    of cells found by synonym. ``literal`` marks fields the contract answered."""
    done = F.col("status_resolucao") == "resolvido"
    n = audit.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_all"), F.count_if(done).alias("_done"), F.count_if("obrigatorio").alias("_req"),
        F.count_if(F.col("obrigatorio") & done).alias("_req_done"), F.count_if("literal").alias("_lit"),
        F.count("linha_por_sinonimo").alias("_cells"), F.count_if("linha_por_sinonimo").alias("_syn"),
    )
    c = F.col
    if contract_leaves is not None:
        n = n.join(contract_leaves, [k for k in keys if k in contract_leaves.columns]) if set(keys) & set(contract_leaves.columns) else n.crossJoin(F.broadcast(contract_leaves))
    whole = ratio(c("_done") - c("_lit"), c("n_leaves")) if contract_leaves is not None else F.lit(None)
    return metric_rows(
        n,
        keys,
        {
            "resolucao_campos_mapeados": c("_all"),
            "resolucao_cobertura_campos": ratio(c("_done"), c("_all")),
            "resolucao_campos_obrigatorios": c("_req"),
            "resolucao_campos_nao_resolvidos": c("_all") - c("_done"),
            "resolucao_cobertura_obs": ratio(c("_done") - c("_lit"), c("_all") - c("_lit")),
            "resolucao_cobertura_obrigatorios": F.when(c("_req") > 0, ratio(c("_req_done"), c("_req"))),
            "resolucao_cobertura_do_contrato": whole,
            "resolucao_linha_por_sinonimo": F.when(c("_cells") > 0, ratio(c("_syn"), c("_cells"))),
        },
    )


def contract_leaves(nodes: DataFrame) -> DataFrame:
    """Number of fields a contract leaves to evidence."""
    return nodes.where("descriptor is not null").groupBy(*CONTRACT).agg(F.count(F.lit(1)).alias("n_leaves"))


def stage_metrics(calls: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attempts, first-try success, success and tokens of each call stage.

    ``calls`` has the keys, ``stage, attempt, ok, total_tokens``.
    """
    n = calls.groupBy(*keys, "stage").agg(
        F.count(F.lit(1)).alias("_n"), F.bool_or("ok").alias("_ok"), F.sum(F.coalesce("total_tokens", F.lit(0))).alias("_tokens")
    )
    c = F.col
    return metric_rows(
        n,
        [*keys, "stage"],
        {
            "llm_tentativas": c("_n"),
            "llm_acerto_1a_tentativa": (c("_ok") & (c("_n") <= 1)).cast("double"),
            "llm_etapa_sucesso": c("_ok").cast("double"),
            "llm_tokens_total": F.when(c("_tokens") > 0, c("_tokens")),
        },
    )


def prompt_fingerprint(name: Column, versions: Column, managed: Column) -> Column:
    """Identity of the exact versions used: ``set@1.4.2``, or ``set@codigo`` when none is managed."""
    return F.when(managed, F.concat(name, F.lit("@"), F.array_join(F.transform(versions, lambda v: F.coalesce(v, F.lit("0"))), "."))).otherwise(
        F.concat(name, F.lit("@codigo"))
    )


def selection_quality(pruned: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Share and number of artefacts pruning kept and dropped."""
    n = pruned.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.count_if("kept").alias("_k"))
    return metric_rows(
        n, keys, {"selecao_evidencia_especifica": ratio(F.col("_k"), F.col("_n")), "selecao_evidencia_descartada": F.col("_n") - F.col("_k")}
    )


def prefilter_metrics(candidates: DataFrame, inventory: DataFrame, keys: Sequence[str], selected: DataFrame | None = None) -> DataFrame:
    """Candidates per requirement, share of the inventory dispensed, share of undecided
    artefacts read in full, share of chosen artefacts the terms pointed at.

    ``candidates`` comes from ``prefilter``; ``inventory`` has ``artifact, complete, full_text``
    and ``n_requirements`` where some requirement has no candidate.
    """
    keys = list(keys)
    n = inventory.groupBy(*keys).agg(F.count(F.lit(1)).alias("_items"), F.max("n_requirements").alias("_reqs"))
    met = candidates.groupBy(*keys).agg(F.count_distinct("artifact", "path").alias("_pairs"), F.count_distinct("artifact").alias("_union"))
    undecided = candidates.select(*keys, "artifact", "path", "source").where("source = 'resumo'").groupBy(*keys, "artifact").agg(F.count_distinct("path").alias("_by"))
    open_ = inventory.where("not complete").join(undecided, [*keys, "artifact"], "left").where("coalesce(_by, 0) < n_requirements")
    read = open_.groupBy(*keys).agg(F.count("full_text").alias("_read"), F.count(F.lit(1)).alias("_open"))
    wide = n.join(met, keys, "left").join(read, keys, "left").na.fill(0)
    c = F.col
    metrics = {
        "selecao_candidatos_por_requisito": F.when(c("_reqs") > 0, c("_pairs") / c("_reqs")),
        "selecao_prefiltro_reducao": ratio(c("_items") - c("_union"), c("_items")),
        "selecao_prefiltro_leitura_completa": F.when(c("_open") > 0, ratio(c("_read"), c("_open"))),
    }
    if selected is not None:
        by_term = candidates.where("reason = 'termo_casado'").select(*keys, "artifact").distinct().withColumn("_t", F.lit(1))
        chosen = selected.join(by_term, [*keys, "artifact"], "left").groupBy(*keys).agg(F.count(F.lit(1)).alias("_chosen"), F.count("_t").alias("_in"))
        wide = wide.join(chosen, keys, "left").na.fill(0)
        metrics["selecao_escolha_dentro_do_prefiltro"] = F.when(c("_chosen") > 0, ratio(c("_in"), c("_chosen")))
    return metric_rows(wide, keys, metrics)


def table_read_metrics(structure: DataFrame, roles: DataFrame, keys: Sequence[str] = ("document_id",)) -> DataFrame:
    """Share of tables whose header was read, and of derivable roles that found one column."""
    read = structure.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.count_if("header_read").alias("_r"))
    done = roles.groupBy(*keys).agg(F.count(F.lit(1)).alias("_roles"), F.count_if(F.col("verdict") == "resolvido").alias("_done"))
    c = F.col
    return metric_rows(
        read.join(done, list(keys), "left").na.fill(0),
        keys,
        {
            "estrutura_tabela_lida": ratio(c("_r"), c("_n")),
            "papel_coluna_origem_contrato": F.when(c("_roles") > 0, ratio(c("_done"), c("_roles"))),
        },
    )


def repair_metrics(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Repair runs with the effective gate: approved, with rules, all of them passed.

    ``runs`` has ``attempts, candidate_valid, approved, rules_total, rules_passed, published,
    total_tokens``.
    """
    c = F.col
    effective = c("approved") & (c("rules_total") > 0) & (c("rules_passed") == c("rules_total"))
    return metric_rows(
        runs,
        keys,
        {
            "fallback_tentativas_llm_total": c("attempts"),
            "fallback_candidato_valido": c("candidate_valid").cast("double"),
            "revalidacao_aprovada": c("approved").cast("double"),
            "revalidacao_regras_executadas": c("rules_total"),
            "revalidacao_gate_efetivo": effective.cast("double"),
            "publicacao_realizada": c("published").cast("double"),
            "fallback_tokens_total": F.when(c("total_tokens") > 0, c("total_tokens")),
        },
    )


def transition_metrics(handoffs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whether a handoff between stages happened, and its coverage change where known.

    ``handoffs`` has ``origin, target, enabled, coverage_delta``.
    """
    name = F.concat(F.lit("transicao_"), "origin", F.lit("_para_"), "target")
    on = handoffs.select(*keys, name.alias("name"), F.coalesce("enabled", F.lit(False)).cast("double").alias("value"))
    delta = handoffs.where("coverage_delta is not null").select(
        *keys, F.concat(name, F.lit("_delta_cobertura")).alias("name"), F.round("coverage_delta", 6).alias("value")
    )
    return on.unionByName(delta)


def end_to_end_metrics(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Success, autonomy, readiness; duration, tokens and coverage only when known."""
    c = F.col
    return metric_rows(
        runs,
        keys,
        {
            "e2e_sucesso": c("success").cast("double"),
            "e2e_autonomia_deterministica": (~c("used_model")).cast("double"),
            "e2e_apto_para_bronze": c("ready").cast("double"),
            "e2e_duracao_segundos": F.round("seconds", 3),
            "e2e_tokens_llm": F.when(c("total_tokens") > 0, c("total_tokens")),
            "e2e_cobertura_final": F.round("coverage", 6),
        },
    )


def run_spans(marks: DataFrame, keys: Sequence[str], *, time: str = "ts", stage: str = "stage") -> tuple[DataFrame, DataFrame]:
    """Runs (first mark, last mark, seconds over all attempts) and their spans per stage."""
    seconds = (F.unix_micros("last_at") - F.unix_micros("first_at")) / 1e6
    span = marks.groupBy(*keys, stage).agg(F.min(time).alias("first_at"), F.max(time).alias("last_at"), F.count(F.lit(1)).alias("n_marks"))
    runs = span.groupBy(*keys).agg(
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"), F.sum("n_marks").alias("n_marks"), F.count(F.lit(1)).alias("n_stages")
    )
    return runs.withColumn("seconds", seconds), span.withColumn("seconds", seconds)


# --- releases ---------------------------------------------------------------------------------


def mean_scores(scores: DataFrame, runs: DataFrame, by: Sequence[str] = ("release",)) -> DataFrame:
    """Mean and count of each numeric metric over the chosen runs.

    ``scores`` has ``run_id, name, value, data_type``; ``runs`` has ``run_id`` and the grouping.
    Sums and counts are combined before the shuffle.
    """
    numeric = scores.where("data_type <> 'CATEGORICAL' and value is not null")
    return numeric.join(runs.select("run_id", *by), "run_id").groupBy(*by, "name").agg(F.avg("value").alias("mean"), F.count(F.lit(1)).alias("n"))


def directions(spark) -> DataFrame:
    """Direction and guard flag of the known metrics."""
    rows = [(n, 1, n in GUARDS) for n in HIGHER_IS_BETTER] + [(n, -1, n in GUARDS) for n in LOWER_IS_BETTER]
    return spark.createDataFrame(rows, "name string, direction int, guard boolean")


def compare_releases(
    scores: DataFrame, runs: DataFrame, base: str, new: str, *, tolerance: float = 0.01, direction: DataFrame | None = None, paired: bool = True
) -> DataFrame:
    """Each metric of two releases with its change and verdict.

    ``runs`` has ``run_id, release, document_id, stage, execution_id``. Only (document, stage,
    execution) present in both count when ``paired`` and there is any.
    """
    key = ["document_id", "stage", "execution_id"]
    chosen = runs.where(F.col("release").isin(base, new))
    if paired:
        keyed = chosen.where("coalesce(document_id, '') <> '' and coalesce(execution_id, '') <> ''")
        common = keyed.groupBy(*key).agg(F.count_distinct("release").alias("_n")).where("_n = 2").select(*key)
        # Without any common execution the releases are compared as a whole.
        any_ = F.broadcast(common.limit(1).agg(F.count(F.lit(1)).alias("_any")))
        marked = chosen.join(common.withColumn("_in", F.lit(True)), key, "left").crossJoin(any_)
        chosen = marked.where("_any = 0 or _in").select(*runs.columns)
    side = F.when(F.col("release") == base, "a").otherwise("b")
    means = mean_scores(scores, chosen.withColumn("_side", side), ["_side"])
    both = means.groupBy("name").agg(
        *[F.max(F.when(F.col("_side") == s, F.col(c))).alias(f"{t}_{c}") for s, t in (("a", "base"), ("b", "new")) for c in ("mean", "n")]
    )
    table = directions(scores.sparkSession) if direction is None else direction
    judged = both.join(F.broadcast(table), "name", "left")
    delta = F.col("new_mean") - F.col("base_mean")
    relative = delta / F.greatest(F.abs("base_mean"), F.lit(1e-9))
    sense = F.coalesce("direction", F.lit(0))
    status = (
        F.when(delta.isNull(), "ausente")
        .when(F.abs(relative) <= tolerance, "estavel")
        .when(sense == 0, "neutra")
        .when(sense * delta > 0, "melhorou")
        .otherwise("regrediu")
    )
    return judged.select(
        "name", "base_mean", "base_n", "new_mean", "new_n", delta.alias("delta"), relative.alias("relative"), F.coalesce("guard", F.lit(False)).alias("guard"), status.alias("status")
    )


def release_verdict(comparison: DataFrame) -> DataFrame:
    """2 when a guard regressed, 1 when only others did, else 0."""
    worse = F.col("status") == "regrediu"
    return comparison.agg(
        F.when(F.count_if(worse & F.col("guard")) > 0, 2).when(F.count_if(worse) > 0, 1).otherwise(0).alias("code"),
        F.count_if(worse).alias("regressed"), F.count_if(F.col("status") == "melhorou").alias("improved"),
    )


def stage_averages(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean over runs of each ``metric@stage``; booleans count as 1 and 0."""
    key = F.concat("name", F.lit("@"), F.coalesce("stage", F.lit("final")))
    return scores.where("value is not null").groupBy(*by, key.alias("metric")).agg(F.avg(F.col("value").cast("double")).alias("mean"), F.count(F.lit(1)).alias("n"))


def pick_attempts(calls: DataFrame, keys: Sequence[str], order: Sequence[Column] | Column, failed: Column, keep: Sequence[str]) -> DataFrame:
    """First call of each stage, and its final one: the last without error, else the last."""
    rank = F.struct(*order) if isinstance(order, (list, tuple)) else order
    row = F.struct(*keep)
    n = calls.withColumn("_bad", failed).groupBy(*keys).agg(
        F.min_by(row, rank).alias("first"), F.max_by(row, F.struct((~F.col("_bad")).alias("ok"), rank.alias("at"))).alias("final"),
        F.count(F.lit(1)).alias("attempts"), F.bool_or(~F.col("_bad")).alias("succeeded"),
    )
    return n


def merged_maps(calls: DataFrame, keys: Sequence[str], order: Column, mapping: str) -> DataFrame:
    """Per-stage maps put together as rows; the later call wins a path."""
    rows = calls.select(*keys, order.alias("_at"), F.explode(mapping).alias("path", "value"))
    return first_per_key(rows, [*keys, "path"], F.col("_at"), last=True).drop("_at")


# --- dashboards and datasets ------------------------------------------------------------------


def dashboard(
    scores: DataFrame, *, grain: str | None = None, time: str = "ts", dims: Sequence[str] = ("name",), agg: str = "avg", value: str = "value", top: int | None = None
) -> DataFrame:
    """A widget: ``avg``, ``sum``, ``count`` or exact ``p95`` of a metric over time and
    dimensions; ``top`` keeps the largest groups of the report."""
    staged = scores if grain is None else scores.withColumn("bucket", F.date_trunc(grain, F.col(time)))
    by = [*(["bucket"] if grain else []), *dims]
    if agg == "p95":
        out = exact_quantile(staged, by, value, 0.95, "measure")
    else:
        fn = {"avg": F.avg(value), "sum": F.sum(value), "count": F.count(F.lit(1))}[agg]
        out = staged.groupBy(*by).agg(fn.alias("measure"))
    return out if top is None else out.orderBy(F.col("measure").desc(), *by).limit(top)


def regression_items(runs: DataFrame) -> DataFrame:
    """Labelled items of the four datasets, each with its own admission rule.

    ``runs`` is one row per repair run with flags of the artefacts it has: ``has_publication,
    has_resolved, has_selection, has_selection_input, has_candidate, has_candidate_input`` and
    ``approved``.
    """
    sets = F.array(
        F.when(F.col("has_publication") & F.col("has_resolved"), F.struct(F.lit("e2e").alias("dataset"), F.concat_ws("::", F.lit("e2e"), "entity", "document_id").alias("item_id"))),
        F.when(F.col("has_selection") & F.col("has_selection_input"), F.struct(F.lit("selecao").alias("dataset"), F.concat_ws("::", F.lit("selecao"), "entity", "document_id", "execution_id").alias("item_id"))),
        F.when(F.col("has_candidate") & F.col("has_candidate_input"), F.struct(F.lit("candidato").alias("dataset"), F.concat_ws("::", F.lit("candidato"), "entity", "document_id", "execution_id").alias("item_id"))),
        F.when(F.col("has_candidate"), F.struct(F.lit("transicao").alias("dataset"), F.concat_ws("::", F.lit("transicao"), "entity", "document_id", "execution_id").alias("item_id"))),
    )
    label = F.when(F.coalesce("approved", F.lit(False)), "aprovado").otherwise("reprovado")
    return runs.select("domain", "entity", "document_id", "execution_id", label.alias("label"), F.explode(F.array_compact(sets)).alias("_i")).select(
        "_i.dataset", "_i.item_id", "domain", "entity", "document_id", "execution_id", "label"
    )


def link_runs(items: DataFrame, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items with the newest run of their (document, execution) per release, and the share
    of items each release links. Runs without both keys never link."""
    key = ["document_id", "execution_id"]
    usable = runs.where("coalesce(trim(document_id), '') <> '' and coalesce(trim(execution_id), '') <> ''")
    newest = first_per_key(usable.select("release", *key, "run_id", "started"), ["release", *key], [F.col("started"), F.col("run_id")], last=True)
    links = items.join(newest.select("release", *key, "run_id"), key)
    total = items.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_items"))
    hit = links.groupBy("release", "dataset").agg(F.count(F.lit(1)).alias("n_linked")).join(F.broadcast(total), "dataset")
    return links, hit.withColumn("ratio", ratio(F.col("n_linked"), F.col("n_items")))


def run_metrics(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Scores of all stages as one table with the stage they come from."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn("source", F.lit(name)) for name, df in parts.items()])
