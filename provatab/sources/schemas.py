"""Row types of the stored tables, and key audits over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BBOX = "struct<page_number:int,left:double,top:double,right:double,bottom:double,coord_origin:string>"


# Schemas are DDL text, which readers and writers take as it is.
TABLE_ARTIFACT = (
    "kind string, name string, schema array<string>, rows array<array<string>>, "
    "files struct<metadata:string,cells:string,normalized_rows:string>"
)
CELLS = "document_id string, table_id string, row_index int, column_index int, value_raw string"
SECTIONS = (
    "section_id string, document_id string, page_number int, title_raw string, title_canonical string, "
    "level_hint int, order_index int, parent_section_id string, self_ref string, parent_ref string, "
    f"child_refs array<string>, bbox {BBOX}"
)
BLOCKS = (
    "block_id string, document_id string, page_number int, section_id string, section_title string, "
    "parent_block_id string, order_index int, level_hint int, label_raw string, role_hint string, text string, "
    f"self_ref string, parent_ref string, child_refs array<string>, bbox {BBOX}"
)
CHART_POINTS = (
    "point_id string, document_id string, chart_id string, page_number int, section_id string, "
    "section_title string, chart_type string, chart_title_raw string, chart_title_canonical string, "
    "series_name string, category_name string, value_numeric double, value_text string, raw_row map<string,string>"
)
MANIFESTS = (
    "domain string, entity string, document_id string, execution_id string, manifest_key string, "
    "contract_uri string, artifact_uris array<string>"
)
AUDIT = (
    "domain string, entity string, document_id string, execution_id string, ord int, mapping_path string, "
    "tipo_origem string, arquivo_origem string, obrigatorio boolean, status_resolucao string, valor_resolvido string"
)

# The seven operational tables as (columns, unique keys, references).
OPERATIONAL = {
    "documentos": (
        "id bigint, document_id string, dominio string, entidade string, tipo_documento string, "
        "nome_arquivo_original string, bucket_origem string, object_key_origem string, checksum_sha256 string, "
        "tamanho_bytes bigint, data_documento date, data_ingestao timestamp, status_atual string",
        [["id"], ["document_id"]],
        {},
    ),
    "execucoes_pipeline": (
        "id bigint, execution_id string, document_id string, dag_origem string, versao_pipeline string, "
        "versao_contrato string, versao_layout_signature string, status_execucao string, "
        "fallback_acionado boolean, iniciado_em timestamp, finalizado_em timestamp, erro_resumido string",
        [["id"], ["execution_id"]],
        {"document_id": ("documentos", "document_id")},
    ),
    "artefatos_execucao": (
        "id bigint, execution_id string, tipo_artefato string, bucket_name string, object_key string, "
        "checksum_sha256 string, tamanho_bytes bigint, criado_em timestamp",
        [["id"]],
        {"execution_id": ("execucoes_pipeline", "execution_id")},
    ),
    "contratos_semanticos": (
        "id bigint, dominio string, nome_arquivo string, versao string, bucket_name string, object_key string, "
        "checksum_sha256 string, publicado_em timestamp, ativo boolean",
        [["id"], ["dominio", "nome_arquivo", "versao"]],
        {},
    ),
    "layout_signatures": (
        "id bigint, dominio string, entidade string, tipo_documento string, nome_arquivo string, versao string, "
        "bucket_name string, object_key string, checksum_sha256 string, publicado_em timestamp, ativo boolean",
        [["id"], ["dominio", "entidade", "tipo_documento", "versao"]],
        {},
    ),
    "validacoes_layout": (
        "id bigint, execution_id string, status_compatibilidade string, campos_obrigatorios_total int, "
        "campos_obrigatorios_resolvidos int, valores_esperados int, valores_resolvidos int, llm_necessaria boolean, "
        "fallback_acionado boolean, revisao_manual_recomendada boolean, criado_em timestamp",
        [["id"], ["execution_id"]],
        {"execution_id": ("execucoes_pipeline", "execution_id")},
    ),
    "fallback_execucoes": (
        "id bigint, execution_id string, motivo_principal string, codigo_falha string, escopo_correcao string, "
        "status_fallback string, revisao_humana_obrigatoria boolean, criado_em timestamp, finalizado_em timestamp",
        [["id"]],
        {"execution_id": ("execucoes_pipeline", "execution_id")},
    ),
}


def operational_schema(table: str) -> str:
    return OPERATIONAL[table][0]


def audit_keys(
    tables: Mapping[str, DataFrame],
    unique: Mapping[str, Sequence[Sequence[str]]] | None = None,
    foreign: Mapping[str, Mapping[str, tuple[str, str]]] | None = None,
) -> DataFrame:
    """One row per broken key: ``(table, rule, columns, key, n)``.

    Uniqueness is a count per key (partial aggregation); references are anti-joins on distinct
    keys. Without explicit rules those of the operational catalogue apply.
    """
    if unique is None:
        unique = {t: spec[1] for t, spec in OPERATIONAL.items() if t in tables}
    if foreign is None:
        foreign = {
            t: {c: ref for c, ref in spec[2].items() if ref[0] in tables} for t, spec in OPERATIONAL.items() if t in tables
        }
    found = []
    for table, keys in unique.items():
        for key in keys:
            shown = F.concat_ws("|", *[F.col(c).cast("string") for c in key])
            found.append(
                tables[table]
                .groupBy(*key)
                .agg(F.count(F.lit(1)).alias("n"))
                .where("n > 1")
                .select(
                    F.lit(table).alias("table"), F.lit("unique").alias("rule"), F.lit(",".join(key)).alias("columns"),
                    shown.alias("key"), "n",
                )
            )
    for table, references in foreign.items():
        for column, (other, target) in references.items():
            used = tables[table].where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            known = tables[other].select(F.col(target).alias(column)).distinct()
            found.append(
                used.join(known, column, "left_anti").select(
                    F.lit(table).alias("table"), F.lit("reference").alias("rule"), F.lit(column).alias("columns"),
                    F.col(column).cast("string").alias("key"), "n",
                )
            )
    return reduce(DataFrame.unionByName, found)
