"""Semantic contracts as relations, and what they ask of each document.

Contracts are written by people: few rows, many documents. They are flattened once and joined
to documents; a broadcast is offered only after counting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provatab.cluster import broadcast_if_small, checkpointed
from provatab.functions import paths, periods
from provatab.functions import text as tx

# The words of the contract language.
TYPE_WORDS = ("string", "number", "integer", "boolean", "object", "array", "null")
EVIDENCE_KINDS = (
    "valor_fixo",
    "campo_derivado",
    "campo_json",
    "bloco_textual",
    "registros_de_blocos_textuais",
    "cabecalho_de_tabela",
    "celula_de_tabela",
    "linhas_de_tabela",
    "juncao_de_registros_json",
)
KEY_ORIGINS = ("identidade_documento", "seletor_observacao", "evidencia")
DERIVATION_ORIGINS = ("contrato", "manifesto", "observacao")
PENDING_KEY, PENDING_VALUE = "<chave>", "<evidencia>"
FORBIDDEN_FILTER_VALUES = (PENDING_VALUE, PENDING_KEY, *KEY_ORIGINS)

CONTRACT = ["domain", "version"]
_REQUIREMENTS = (
    "array<struct<path:string,evidencia_esperada:map<string,string>,"
    "orientacao_origem:struct<termos:array<string>,ancoras:array<string>,rotulos:array<string>>,"
    "observacoes_obrigatorias:array<struct<seletores:map<string,string>,"
    "campos_contexto_obrigatorios:array<string>,obrigatorio:boolean>>>>"
)
_ROLES = "map<string,map<string,struct<descricao:string,derivacao:struct<origem:string,relacao:string,passo:int>>>>"
_DERIVATIONS = "array<struct<destino:string,origem:struct<tipo:string,campo:string,seletor:map<string,string>>>>"
_KEY_FULL = "struct<chave:string,origem_valor:string,atributo_identidade:string>"


def is_type_descriptor(text: Column) -> Column:
    """Whether a leaf of the output schema describes a field instead of fixing its value."""
    clean = F.lower(tx.normalize_space(text))
    return (clean != "") & (clean.contains("|") | clean.isin(*TYPE_WORDS))


def contract_nodes(contracts: DataFrame, contract: str = "contract") -> DataFrame:
    """Every path of the output schema with its kind and, for leaves, its literal.

    ``kind`` is ``object``, ``array``, ``literal`` or ``descriptor``. Only the first item of an
    array describes it.
    """
    spark = contracts.sparkSession
    root = F.try_variant_get(F.try_parse_json(contract), F.lit("$.schema_saida"), "variant")
    level = contracts.select(*CONTRACT, F.lit("").alias("path"), root.alias("node"), F.lit(False).alias("in_array"))
    found = None
    while True:
        kind = F.schema_of_variant("node")
        shape = F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array")
        text = F.try_variant_get("node", F.lit("$"), "string")
        leaf = F.when((kind == "STRING") & is_type_descriptor(text), "descriptor").otherwise("literal")
        here = level.select(
            *CONTRACT, "path", F.coalesce(shape, leaf).alias("kind"), F.when(shape.isNull(), text).alias("value"), "in_array"
        ).where("path <> ''")
        found = here if found is None else found.unionByName(here)
        dotted = F.when(F.col("path") == "", F.col("key")).otherwise(F.concat("path", F.lit("."), F.col("key")))
        level = checkpointed(
            level.where(kind.rlike("^(OBJECT|ARRAY)"))
            .withColumn("_array", kind.startswith("ARRAY"))
            .lateralJoin(spark.tvf.variant_explode(F.col("node").outer()))
            .where("key is not null or pos = 0")
            .select(
                *CONTRACT,
                F.when(F.col("_array"), F.col("path")).otherwise(dotted).alias("path"),
                F.col("value").alias("node"),
                F.col("_array").alias("in_array"),
            )
        )
        if level.isEmpty():
            break
    # A path under an array item repeats the array's own path; the array row stays. The relation is
    # a few hundred rows that every later join reads, so the levels are walked once.
    is_array = F.bool_or(F.col("kind") == "array")
    nodes = found.groupBy(*CONTRACT, "path").agg(
        is_array.alias("is_array"),
        F.min_by("kind", F.col("in_array").cast("int")).alias("kind"),
        F.max(F.when(F.col("kind") == "literal", F.col("value"))).alias("literal"),
        F.max(F.when(F.col("kind") == "descriptor", F.col("value"))).alias("descriptor"),
    )
    return checkpointed(nodes)


def _semantic(contract: str, path: str, schema: str) -> Column:
    return F.from_json(F.get_json_object(contract, "$.contrato_semantico." + path), schema)


def requirements(contracts: DataFrame, contract: str = "contract") -> DataFrame:
    """One row per required observation of a field; ``obs`` is null for whole collections."""
    fields = contracts.select(
        *CONTRACT, F.posexplode(_semantic(contract, "requisitos_mapeamento.campos_obrigatorios", _REQUIREMENTS)).alias("ord", "r")
    )
    return fields.select(
        *CONTRACT, "ord", F.trim("r.path").alias("path"), F.col("r.evidencia_esperada").alias("expected_evidence"),
        F.col("r.orientacao_origem").alias("guidance"), F.posexplode_outer("r.observacoes_obrigatorias").alias("obs", "o"),
    ).select(
        *CONTRACT, "ord", "path", "expected_evidence", "guidance", "obs", F.col("o.seletores").alias("selectors"),
        F.coalesce("o.campos_contexto_obrigatorios", F.expr("cast(array() as array<string>)")).alias("context_fields"),
        F.coalesce("o.obrigatorio", F.lit(True)).alias("required"),
    )


def roles(contracts: DataFrame, contract: str = "contract") -> DataFrame:
    """Roles a selector may play, with the derivation of their period."""
    declared = _semantic(contract, "requisitos_mapeamento.papeis", _ROLES)
    by_selector = contracts.select(*CONTRACT, F.explode(declared).alias("selector", "_r"))
    return by_selector.select(*CONTRACT, "selector", F.explode("_r").alias("role", "_d")).select(
        *CONTRACT, "selector", "role", F.col("_d.descricao").alias("description"), F.col("_d.derivacao.origem").alias("origin"),
        F.col("_d.derivacao.relacao").alias("relation"), F.col("_d.derivacao.passo").alias("step"),
        F.col("_d.derivacao").isNotNull().alias("is_derived"),
    )


def item_keys(contracts: DataFrame, contract: str = "contract") -> DataFrame:
    """Identifying field of each array and where its value comes from (short or full form)."""
    raw = F.from_json(F.get_json_object(contract, "$.contrato_semantico.chaves_de_item"), "map<string,string>")
    listed = contracts.select(*CONTRACT, F.explode(raw).alias("array_path", "_k"))
    full = F.from_json("_k", _KEY_FULL)
    wrapped = F.trim("_k").startswith("{")
    return listed.select(
        *CONTRACT, "array_path", F.when(wrapped, full["chave"]).otherwise(F.trim("_k")).alias("item_key"),
        F.when(wrapped, full["origem_valor"]).alias("key_origin"), F.when(wrapped, full["atributo_identidade"]).alias("identity_attribute"),
    )


def derivations(contracts: DataFrame, contract: str = "contract") -> DataFrame:
    """Fields the engine fills itself, in declared order."""
    listed = contracts.select(*CONTRACT, F.posexplode(_semantic(contract, "derivacoes", _DERIVATIONS)).alias("ord", "d"))
    return listed.select(
        *CONTRACT, "ord", F.col("d.destino").alias("target"), F.col("d.origem.tipo").alias("origin"), F.col("d.origem.campo").alias("field"),
        F.col("d.origem.seletor").alias("selectors"),
    )


def _violation(rule: str, detail: Column) -> list[Column]:
    return [F.lit(rule).alias("rule"), detail.alias("detail")]


def contract_violations(nodes: DataFrame, reqs: DataFrame, role: DataFrame, keys: DataFrame, derived: DataFrame) -> DataFrame:
    """C6-C9 checks: one row per inconsistency of a contract with its own schema."""
    known = nodes.select(*CONTRACT, "path")
    arrays = nodes.where("is_array").select(*CONTRACT, F.col("path").alias("array_path"))
    fields = reqs.select(*CONTRACT, "ord", "path").distinct()
    found = [
        fields.groupBy(*CONTRACT, "path").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*CONTRACT, *_violation("requirement_repeated", F.col("path"))),
        fields.join(known, [*CONTRACT, "path"], "left_anti").select(*CONTRACT, *_violation("requirement_outside_schema", F.col("path"))),
        reqs.where("obs is not null and (selectors is null or cardinality(selectors) = 0)").select(*CONTRACT, *_violation("observation_without_selector", F.col("path"))),
        reqs.select(*CONTRACT, F.explode("context_fields").alias("_f"), F.regexp_replace("path", "\\.[^.]+$", "").alias("_p"))
        .select(*CONTRACT, F.concat("_p", F.lit("."), "_f").alias("path")).distinct()
        .join(known, [*CONTRACT, "path"], "left_anti").select(*CONTRACT, *_violation("context_outside_schema", F.col("path"))),
        reqs.select(*CONTRACT, "path", F.explode("expected_evidence").alias("_f", "_k")).distinct()
        .where(~F.col("_k").isin(*EVIDENCE_KINDS)).select(*CONTRACT, *_violation("unknown_evidence_kind", F.concat_ws(":", "path", "_k"))),
    ]
    used = reqs.select(*CONTRACT, F.explode("selectors").alias("selector", "role")).distinct()
    governed = role.select(*CONTRACT, "selector").distinct()
    found += [
        governed.join(used, [*CONTRACT, "selector"], "left_anti").select(*CONTRACT, *_violation("role_selector_unused", F.col("selector"))),
        used.join(governed, [*CONTRACT, "selector"], "left_semi")
        .join(role.select(*CONTRACT, "selector", "role"), [*CONTRACT, "selector", "role"], "left_anti")
        .select(*CONTRACT, *_violation("role_undeclared", F.concat_ws("=", "selector", "role"))),
        role.where("coalesce(trim(description), '') = ''").select(*CONTRACT, *_violation("role_without_description", F.concat_ws(".", "selector", "role"))),
        keys.join(arrays, [*CONTRACT, "array_path"], "left_anti").select(*CONTRACT, *_violation("item_key_not_an_array", F.col("array_path"))),
        keys.where(F.col("key_origin").isNotNull() & ~F.col("key_origin").isin(*KEY_ORIGINS)).select(*CONTRACT, *_violation("item_key_origin_unknown", F.concat_ws(":", "array_path", "key_origin"))),
        keys.where("identity_attribute is not null and coalesce(key_origin, '') <> 'identidade_documento'").select(*CONTRACT, *_violation("identity_attribute_without_origin", F.col("array_path"))),
        derived.where(~F.coalesce(F.col("origin"), F.lit("")).isin(*DERIVATION_ORIGINS)).select(*CONTRACT, *_violation("derivation_origin_unknown", F.col("target"))),
        derived.where("length(target) - length(replace(target, '[*]', '')) > 3").select(*CONTRACT, *_violation("derivation_wildcards", F.col("target"))),
        derived.where("origin = 'observacao' and (selectors is null or cardinality(selectors) = 0)").select(*CONTRACT, *_violation("derivation_without_selector", F.col("target"))),
        derived.withColumn("path", F.replace("target", F.lit("[*]"), F.lit(""))).join(known, [*CONTRACT, "path"], "left_anti").select(*CONTRACT, *_violation("derivation_outside_schema", F.col("target"))),
    ]
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def flatten_contracts(contracts: DataFrame, contract: str = "contract") -> dict[str, DataFrame]:
    """All relations of the contracts, and their inconsistencies."""
    nodes = contract_nodes(contracts, contract)
    reqs, role = requirements(contracts, contract), roles(contracts, contract)
    keys, derived = item_keys(contracts, contract), derivations(contracts, contract)
    return {
        "paths": nodes,
        "arrays": nodes.where("is_array"),
        "literals": nodes.where("literal is not null"),
        "requirements": reqs,
        "roles": role,
        "keys": keys,
        "derivations": derived,
        "violations": contract_violations(nodes, reqs, role, keys, derived),
    }


def admission_violations(contracts: DataFrame, published: DataFrame, contract: str = "contract") -> DataFrame:
    """C17: a new contract must be of its type, carry the chosen version and domain, and not
    replace a published one."""
    def declared(field: str) -> Column:
        return F.get_json_object(contract, "$." + field)

    domain = F.lower(F.trim(F.coalesce(F.nullif(declared("dominio"), F.lit("")), declared("domain"), F.lit(""))))
    checks = {
        "unreadable": F.try_parse_json(contract).isNull(),
        "wrong_type": F.coalesce(declared("tipo_documento"), F.lit("")) != "contrato_semantico",
        "not_semver": ~F.coalesce(declared("versao"), F.lit("")).rlike("^v?\\d+\\.\\d+\\.\\d+$"),
        "version_differs": F.regexp_replace(F.coalesce(declared("versao"), F.lit("")), "^v", "") != F.regexp_replace("version", "^v", ""),
        "semantics_missing": ~F.coalesce(declared("contrato_semantico"), F.lit("")).startswith("{"),
        "schema_missing": F.coalesce(declared("schema_saida"), F.lit("{}")).isin("{}", "[]", "null", "") | declared("schema_saida").isNull(),
        "domain_differs": (domain != "") & (domain != F.col("domain")),
    }
    broken = F.array_compact(F.array(*[F.when(test, rule) for rule, test in checks.items()]))
    own = contracts.select(*CONTRACT, F.explode(broken).alias("rule"))
    again = contracts.select(*CONTRACT).join(published.select(*CONTRACT).distinct(), CONTRACT, "left_semi")
    return own.unionByName(again.select(*CONTRACT, F.lit("already_published").alias("rule")))


# --- literals and derivations over resolved rows ----------------------------------------------


def overlay_literals(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """Leaves of resolved rows with contract literals put back, in array items too.

    ``leaves`` are ``(domain, version, document_id, item, path, value)``; ``item`` identifies the
    array item a leaf is in. A literal under an array is written into every item of it.
    """
    literals = nodes.where("literal is not null").select(*CONTRACT, "path", "literal")
    parent = F.regexp_replace("path", "\\.?[^.]+$", "")
    items = leaves.select(*CONTRACT, "document_id", "item", parent.alias("_parent")).distinct()
    missing = (
        items.join(broadcast_if_small(literals.withColumn("_parent", parent)), [*CONTRACT, "_parent"])
        .select(*CONTRACT, "document_id", "item", "path", F.col("literal").alias("value"))
    )
    dynamic = leaves.join(broadcast_if_small(literals.select(*CONTRACT, "path")), [*CONTRACT, "path"], "left_anti")
    return dynamic.unionByName(missing)


def apply_derivations(leaves: DataFrame, declared: DataFrame, sources: DataFrame, observations: DataFrame) -> DataFrame:
    """Audit of each derivation per document, and the value to write.

    ``sources`` holds contract and manifest fields as ``(document_id, origin, field, value)``;
    ``observations`` the resolved mappings as ``(document_id, field, selectors, value)`` with
    sorted ``key=value`` selectors. One distinct observed value is the value, several disagree.
    Only null targets are written; ``[*]`` writes into every item.
    """
    docs = leaves.select(*CONTRACT, "document_id").distinct()
    wanted = docs.join(broadcast_if_small(declared), CONTRACT)
    plain = wanted.where("origin <> 'observacao'").join(
        sources.select("document_id", "origin", "field", F.nullif(F.trim("value"), F.lit("")).alias("value")),
        ["document_id", "origin", "field"],
        "left",
    )
    needed = F.transform(F.map_entries("selectors"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    seen = (
        wanted.where("origin = 'observacao'")
        .withColumn("_need", needed)
        .join(observations.select("document_id", "field", F.col("selectors").alias("_has"), F.trim("value").alias("_v")), ["document_id", "field"], "left")
        .withColumn("_v", F.when(F.size(F.array_except("_need", "_has")) == 0, F.nullif("_v", F.lit(""))))
        .groupBy(*CONTRACT, "document_id", "ord", "target", "origin", "field")
        .agg(F.count_distinct("_v").alias("_n"), F.min("_v").alias("value"))
    )
    shape = [*CONTRACT, "document_id", "ord", "target", "origin", "field"]
    valued = plain.select(*shape, "value", F.when(F.col("value").isNull(), 0).otherwise(1).cast("long").alias("_n")).unionByName(
        seen.select(*shape, "value", "_n")
    )
    target = valued.withColumn("path", F.replace("target", F.lit("[*]"), F.lit("")))
    free = leaves.where("value is null").groupBy("document_id", "path").agg(F.count(F.lit(1)).alias("_free"))
    status = (
        F.when(F.col("_n") > 1, "divergente")
        .when(F.col("_n") == 0, "sem_origem")
        .when(F.coalesce("_free", F.lit(0)) > 0, "derivado")
        .otherwise("preservado")
    )
    return target.join(free, ["document_id", "path"], "left").select(
        *shape, F.when(F.col("_n") == 1, F.col("value")).alias("value"), status.alias("status"),
        F.when(F.col("_n") == 1, F.coalesce("_free", F.lit(0).cast("long"))).otherwise(F.lit(0).cast("long")).alias("written"),
    )


# --- targets ----------------------------------------------------------------------------------


def _arrays_on(targets: DataFrame, keys: DataFrame, nodes: DataFrame) -> DataFrame:
    """Arrays a path crosses, outermost first, with their declared key."""
    arrays = nodes.where("is_array").select(*CONTRACT, F.col("path").alias("array_path"))
    described = arrays.join(keys, [*CONTRACT, "array_path"], "left")
    inside = F.col("path").startswith(F.concat("array_path", F.lit("."))) | (F.col("include_self") & (F.col("path") == F.col("array_path")))
    # Both sides come from one contract's text, which is what bounds them.
    return targets.join(described, CONTRACT).where(inside)


def enumerate_targets(
    nodes: DataFrame, reqs: DataFrame, keys: DataFrame, derived: DataFrame, identities: DataFrame
) -> DataFrame:
    """The closed list of mapping keys each document's layout must or may hold.

    ``identities`` has ``domain, version, document_id`` and an ``identity`` map. One row per
    value, context or free leaf, with the filters rendered per array; ``pending`` marks filters
    only the document can fill. ``problem`` is set where the contract or the identity cannot
    close a key.
    """
    literal = nodes.where("literal is not null").select(*CONTRACT, "path")
    allowed = nodes.join(literal, [*CONTRACT, "path"], "left_anti")
    no_sel = F.expr("cast(map() as map<string,string>)")
    base = reqs.withColumn("selectors", F.coalesce("selectors", no_sel)).withColumn("include_self", F.col("obs").isNotNull())
    arrays = nodes.where("is_array").select(*CONTRACT, "path", F.lit(True).alias("_arr"))
    values = base.join(arrays, [*CONTRACT, "path"], "left").select(
        *CONTRACT, "ord", "obs", F.col("path").alias("requirement"), "path", "selectors", "required", "include_self", F.lit("valor").alias("target_role"),
        F.when(F.col("_arr") & F.col("obs").isNull(), "colecao").otherwise("item").alias("array_mode"), F.lit(0).alias("part"),
    )
    parent = F.regexp_replace("path", "\\.[^.]+$", "")
    context = (
        base.select(*CONTRACT, "ord", "obs", F.col("path").alias("requirement"), parent.alias("_p"), "selectors", "required", "include_self", F.posexplode("context_fields").alias("_i", "_f"))
        .select(
            *CONTRACT, "ord", "obs", "requirement", F.concat("_p", F.lit("."), "_f").alias("path"), "selectors", "required", "include_self",
            F.lit("contexto").alias("target_role"), F.lit("item").alias("array_mode"), (F.col("_i") + 1).alias("part"),
        )
        .join(allowed.select(*CONTRACT, "path"), [*CONTRACT, "path"], "left_semi")
    )
    filled = values.unionByName(context)
    under = nodes.where("is_array").select(*CONTRACT, F.col("path").alias("_a"))
    filler = derived.select(*CONTRACT, F.replace("target", F.lit("[*]"), F.lit("")).alias("path")).distinct()
    leaves = allowed.where("kind = 'descriptor' and not is_array")
    in_array = leaves.join(under, CONTRACT).where(F.col("path").startswith(F.concat("_a", F.lit(".")))).select(*CONTRACT, "path").distinct()
    free = (
        leaves.join(in_array, [*CONTRACT, "path"], "left_anti")
        .join(filler, [*CONTRACT, "path"], "left_anti")
        .join(filled.select(*CONTRACT, "path").distinct(), [*CONTRACT, "path"], "left_anti")
        .select(
            *CONTRACT, F.lit(None).cast("int").alias("ord"), F.lit(None).cast("int").alias("obs"), F.col("path").alias("requirement"), "path",
            no_sel.alias("selectors"), F.lit(False).alias("required"), F.lit(False).alias("include_self"), F.lit("livre").alias("target_role"),
            F.lit("item").alias("array_mode"), F.lit(0).alias("part"),
        )
    )
    targets = filled.unionByName(free).withColumn(
        "target_id", F.concat_ws("|", F.coalesce(F.col("ord").cast("string"), F.lit("")), F.coalesce(F.col("obs").cast("string"), F.lit("")), "path")
    )
    # Context siblings take the filters of their observation's own path.
    probe = targets.withColumn("_path", F.col("path")).withColumn("path", F.when(F.col("target_role") == "contexto", F.col("requirement")).otherwise(F.col("path")))
    crossed = _arrays_on(probe, keys, nodes).select(
        *CONTRACT, "target_id", "array_path", "item_key", "key_origin", "identity_attribute", F.length("array_path").alias("_depth"), "selectors"
    )
    own = F.try_element_at("selectors", F.col("item_key"))
    undeclared = Window.partitionBy(*CONTRACT, "target_id", F.col("item_key").isNull()).orderBy(F.col("_depth").desc())
    declared_keys = F.collect_list("item_key").over(Window.partitionBy(*CONTRACT, "target_id"))
    left_over = F.array_except(F.map_keys("selectors"), F.col("_declared"))
    ranked = crossed.withColumn("_rank", F.row_number().over(undeclared)).withColumn("_declared", declared_keys).withColumn("_left", left_over)
    legacy = F.col("item_key").isNull() & (F.col("_rank") == 1) & (F.size("_left") == 1)
    filters = ranked.select(
        *CONTRACT, "target_id", "array_path", "_depth", "identity_attribute",
        F.when(legacy, F.get("_left", F.lit(0))).otherwise(F.col("item_key")).alias("key"),
        F.when(legacy, F.try_element_at("selectors", F.get("_left", F.lit(0)))).otherwise(own).alias("value"),
        F.when(legacy | own.isNotNull(), "seletor_observacao")
        .when(F.col("item_key").isNull(), F.lit(None).cast("string"))
        .otherwise(F.coalesce("key_origin", F.lit("evidencia"))).alias("origin"),
    )
    per_target = filters.groupBy(*CONTRACT, "target_id").agg(
        F.array_sort(F.collect_list(F.struct("_depth", "array_path", "key", "value", "origin", "identity_attribute"))).alias("_filters")
    )
    shaped = targets.join(per_target, [*CONTRACT, "target_id"], "left")
    per_document = identities.join(broadcast_if_small(shaped), CONTRACT)
    identity = F.col("identity")

    def fill(f: Column) -> Column:
        attribute = F.coalesce(
            f["identity_attribute"], F.when(F.map_contains_key(identity, F.coalesce(f["key"], F.lit(""))), f["key"]), F.lit("entidade")
        )
        value = F.when(f["origin"] == "identidade_documento", F.nullif(F.trim(F.try_element_at(identity, attribute)), F.lit("")))
        return F.struct(
            f["array_path"].alias("array_path"), f["key"].alias("key"), F.coalesce(f["value"], value).alias("value"), f["origin"].alias("origin")
        )

    none = F.expr("cast(array() as array<struct<array_path:string,key:string,value:string,origin:string>>)")
    filled_in = F.coalesce(F.transform("_filters", fill), none)
    parts = F.split("path", "\\.")

    def render(part: Column, i: Column) -> Column:
        prefix = F.array_join(F.slice(parts, F.lit(1), i + 1), ".")
        mine = F.get(F.filter("filters", lambda f: f["array_path"] == prefix), F.lit(0))
        shown = F.concat(
            F.lit("["), F.coalesce(mine["key"], F.lit(PENDING_KEY)), F.lit("="), F.coalesce(mine["value"], F.lit(PENDING_VALUE)), F.lit("]")
        )
        return F.concat(part, F.when(mine.isNotNull(), shown).otherwise(""))

    staged = per_document.withColumn("filters", filled_in)
    missing_identity = F.exists("filters", lambda f: (F.coalesce(f["origin"], F.lit("")) == "identidade_documento") & f["value"].isNull())
    missing_selector = F.exists("filters", lambda f: (F.coalesce(f["origin"], F.lit("")) == "seletor_observacao") & f["value"].isNull())
    return staged.select(
        *CONTRACT, "document_id", "requirement", "path", "selectors", "target_role", "required", "array_mode", "filters",
        F.struct("ord", "obs", "part").alias("position"),
        F.array_join(F.transform(parts, render), ".").alias("target"),
        F.exists("filters", lambda f: f["value"].isNull()).alias("pending"),
        F.when(missing_identity, "identity_missing").when(missing_selector, "selector_missing").alias("problem"),
    )


def repeated_targets(targets: DataFrame) -> DataFrame:
    """Keys a contract produces twice for a document; must be empty."""
    return targets.groupBy("document_id", "target").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def key_filters(mapping_keys: DataFrame, col: str = "mapping_path") -> DataFrame:
    """Mapping keys with their plain path and the filter of each array, outermost first."""
    def located(segments: Column) -> Column:
        def at(s: Column, i: Column) -> Column:
            prefix = F.array_join(F.transform(F.slice(segments, F.lit(1), i + 1), lambda x: x["field"]), ".")
            return F.struct(prefix.alias("array_path"), s["key"].alias("key"), s["value"].alias("value"))

        return F.filter(F.transform(segments, at), lambda f: f["key"].isNotNull())

    filters = tx.bound(paths.path_segments(F.col(col)), located)
    return mapping_keys.withColumns({"path": paths.plain_path(F.col(col)), "key_filters": filters, "valid": paths.is_valid_path(F.col(col))})


def match_targets(targets: DataFrame, mapping_keys: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Returns (matched keys with their target, unexpected keys, required targets without key).

    Keys meet targets on document and plain path. Where a target is pending, any real value for
    its key is an instance of it; the first target in contract order wins.
    """
    keyed = key_filters(mapping_keys)
    slim = targets.select("document_id", "path", "target", "requirement", "target_role", "required", "position", F.col("filters").alias("_f"))
    got, want = F.col("key_filters"), F.col("_f")
    same_arrays = (F.size(F.array_except(F.transform(want, lambda f: f["array_path"]), F.transform(got, lambda f: f["array_path"]))) == 0) & (
        F.size(want) == F.size(got)
    )

    def agrees(w: Column) -> Column:
        g = F.get(F.filter(got, lambda f: f["array_path"] == w["array_path"]), F.lit(0))
        fixed = (g["key"] == w["key"]) & (g["value"] == w["value"])
        open_ = (w["key"].isNull() | (g["key"] == w["key"])) & ~g["value"].isin(*FORBIDDEN_FILTER_VALUES) & (F.trim(g["value"]) != "")
        return F.coalesce(F.when(w["value"].isNull(), open_).otherwise(fixed), F.lit(False))

    pairs = keyed.where("valid").join(slim, ["document_id", "path"]).where(same_arrays & F.forall(want, agrees))
    ids = ["document_id", "mapping_path"]
    matched = pairs.groupBy(*ids).agg(
        F.min_by(F.struct("target", "requirement", "target_role", "required"), F.struct("position", "target")).alias("_t")
    ).select(*ids, "_t.target", "_t.requirement", "_t.target_role", "_t.required")
    unexpected = mapping_keys.join(matched.select(*ids), ids, "left_anti")
    missing = targets.where("required").join(matched.select("document_id", "target").distinct(), ["document_id", "target"], "left_anti")
    return matched, unexpected, missing


# --- units ------------------------------------------------------------------------------------


def mapping_units(reqs: DataFrame) -> DataFrame:
    """C14: requirements grouped by the first segment of their path, in declared order."""
    root = F.get(F.split("path", "\\."), F.lit(0))
    unit = F.trim(F.regexp_replace(F.lower("root"), "[^a-z0-9]+", "_"), F.lit("_"))
    return (
        reqs.select(*CONTRACT, "ord", "path", root.alias("root"))
        .distinct()
        .groupBy(*CONTRACT, "root")
        .agg(F.min("ord").alias("ord"), F.count_distinct("path").alias("n_requirements"))
        .withColumn("unit", F.when(unit == "", "unidade_mapeamento").otherwise(unit))
    )


def unit_paths(reqs: DataFrame) -> DataFrame:
    """Paths a unit maps: its requirements and the context fields next to them."""
    root = F.get(F.split("path", "\\."), F.lit(0))
    parent = F.regexp_replace("path", "\\.[^.]+$", "")
    own = reqs.select(*CONTRACT, root.alias("root"), "path")
    side = reqs.select(*CONTRACT, root.alias("root"), parent.alias("_p"), F.explode("context_fields").alias("_f")).select(
        *CONTRACT, "root", F.concat("_p", F.lit("."), "_f").alias("path")
    )
    return own.unionByName(side).distinct()


def scope_contract(nodes: DataFrame, reqs: DataFrame, keys: DataFrame, role: DataFrame) -> dict[str, DataFrame]:
    """Per unit the paths at or below its own, the arrays above them, their keys and the
    roles its observations use."""
    mine = unit_paths(reqs).withColumnRenamed("path", "_u")
    below = (F.col("path") == F.col("_u")) | F.col("path").startswith(F.concat("_u", F.lit(".")))
    above = (F.col("path") == F.col("_u")) | F.col("_u").startswith(F.concat("path", F.lit(".")))
    literal = nodes.where("literal is not null").select(*CONTRACT, "path")
    allowed = nodes.join(literal, [*CONTRACT, "path"], "left_anti")
    root = F.get(F.split("path", "\\."), F.lit(0))
    scoped_paths = allowed.join(mine, CONTRACT).where(below).select(*CONTRACT, "root", "path").distinct()
    scoped_arrays = nodes.where("is_array").join(mine, CONTRACT).where(above).select(*CONTRACT, "root", "path").distinct()
    used = reqs.select(*CONTRACT, root.alias("root"), F.explode("selectors").alias("selector", "_v")).select(*CONTRACT, "root", "selector").distinct()
    return {
        "paths": scoped_paths,
        "arrays": scoped_arrays,
        "keys": keys.join(scoped_arrays.withColumnRenamed("path", "array_path"), [*CONTRACT, "array_path"]),
        "roles": role.join(used, [*CONTRACT, "selector"]),
    }


def mappable_targets(reqs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Required paths with the arrays that enclose them."""
    arrays = nodes.where("is_array").select(*CONTRACT, F.col("path").alias("array_path"))
    fields = reqs.select(*CONTRACT, "path").distinct()
    inside = (F.col("path") == F.col("array_path")) | F.col("path").startswith(F.concat("array_path", F.lit(".")))
    found = fields.join(arrays, CONTRACT).where(inside)
    listed = found.groupBy(*CONTRACT, "path").agg(F.array_sort(F.collect_set("array_path")).alias("arrays"))
    return fields.join(listed, [*CONTRACT, "path"], "left").withColumn("arrays", F.coalesce("arrays", F.expr("cast(array() as array<string>)")))


def expected_periods(role: DataFrame, identities: DataFrame) -> DataFrame:
    """Period each role stands for in a document, from the attribute its selector anchors on.

    ``identities`` has ``domain, version, document_id`` and an ``identity`` map.
    """
    anchor = F.when(F.col("origin").startswith("identidade_documento."), F.substring_index("origin", ".", -1))
    anchors = role.where(anchor.isNotNull()).groupBy(*CONTRACT, "selector").agg(F.min(anchor).alias("_attribute"))
    anchored = role.where("is_derived").join(anchors, [*CONTRACT, "selector"])
    joined = identities.join(broadcast_if_small(anchored), CONTRACT)
    staged = joined.withColumn("_ref", periods.period_of(F.try_element_at("identity", F.col("_attribute"))))
    derived = periods.derive_period(F.col("_ref"), F.col("origin"), F.col("relation"), F.col("step"))
    return staged.withColumn("period", derived).where("period is not null").select(*CONTRACT, "document_id", "selector", "role", "period")
