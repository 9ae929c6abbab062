"""Resolved rows -> flat fact tables and guarded exports."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provatab.functions.periods import loader_period

# The six tables of the housing-credit bulletin: list in the nested row, columns.
BULLETIN = {
    "financiamentos_sbpe_mensal": (
        "financiamentos_imobiliarios.serie_mensal_sbpe",
        {"ano": "ano", "mes": "mes", "unidades_financiadas": "unidades_financiadas", "volume_financiado_milhoes": "volume_financiado_milhoes"},
    ),
    "financiamentos_historico_anual": (
        "financiamentos_imobiliarios.serie_historica_anual",
        {"ano": "ano", "unidades_financiadas": "unidades_financiadas", "volume_financiado_milhoes": "volume_financiado_milhoes"},
    ),
    "financiamentos_por_instituicao": (
        "financiamentos_imobiliarios.por_modalidade_e_instituicao",
        {
            "modalidade": "modalidade",
            "instituicao_financeira": "instituicao_financeira",
            "volume_mensal_milhoes": "volume_mensal_milhoes",
            "unidades_mensais": "unidades_mensais",
            "volume_acumulado_ano_milhoes": "volume_acumulado_ano_milhoes",
            "unidades_acumuladas_ano": "unidades_acumuladas_ano",
        },
    ),
    "poupanca_saldos_mensais": ("poupanca_sbpe.saldos_mensais", {"ano": "ano", "mes": "mes", "saldo_milhoes": "saldo_milhoes"}),
    "poupanca_captacoes_mensais": (
        "poupanca_sbpe.captacoes_liquidas_mensais",
        {"ano": "ano", "mes": "mes", "captacao_liquida_milhoes": "captacao_liquida_milhoes"},
    ),
    "recursos_livres": (
        "recursos_livres.observacoes",
        {
            "periodo_rotulo": "periodo.rotulo_publicado",
            "tipo_periodo": "periodo.tipo_periodo",
            "volume_financiado_bilhoes": "volume_financiado_bilhoes",
            "unidades_financiadas_mil": "unidades_financiadas_mil",
        },
    ),
}


def nested_tables(rows: DataFrame, layout: Mapping[str, tuple[str, Mapping[str, str]]], base: list[str]) -> dict[str, DataFrame]:
    """One flat table per declared list of a nested row, with the run columns of ``base``."""
    out = {}
    for name, (path, columns) in layout.items():
        listed = rows.select(*base, F.explode(F.col(path)).alias("_i")).where("_i is not null")
        out[name] = listed.select(*base, *[F.col(f"_i.{field}").alias(column) for column, field in columns.items()])
    return out


def bulletin_tables(rows: DataFrame, base: list[str] | None = None) -> dict[str, DataFrame]:
    """The six fact tables of a bulletin, with its reference month and run."""
    base = base or ["competencia_referencia", "document_id", "execution_id", "source_object_key"]
    return nested_tables(rows, BULLETIN, base)


def loader_label(label: Column) -> Column:
    """Quarter label without editorial notes; other labels stay as they are."""
    return F.coalesce(loader_period(label), F.trim(label))


def metric_rows(rows: DataFrame, metrics: list[str], *, scope: str = "trimestre") -> DataFrame:
    """Long metric rows of nested company rows, one scope only, labels cleaned.

    ``rows`` has a struct column per metric: ``indicador, unidade, dados[empresa, valores[periodo,
    escopo_periodo, valor]]``.
    """
    out = None
    for metric in metrics:
        entries = rows.select(
            "document_id", "execution_id", "source_object_key", "company_slug", loader_label(F.col("periodo_referencia")).alias("periodo_referencia"),
            F.lit(metric).alias("metric_name"), F.col(f"{metric}.indicador").alias("indicador"), F.col(f"{metric}.unidade").alias("unidade"),
            F.explode(f"{metric}.dados").alias("_d"),
        )
        values = entries.select("*", F.explode("_d.valores").alias("_v")).where(F.col("_v.escopo_periodo") == scope)
        part = values.select(
            "metric_name", F.coalesce("_d.empresa", "company_slug").alias("empresa_documento"), "periodo_referencia", "indicador", "unidade",
            loader_label(F.col("_v.periodo")).alias("periodo_valor"), F.col("_v.valor").alias("valor"), "document_id", "execution_id", "source_object_key",
        )
        out = part if out is None else out.unionByName(part)
    return out


def export_rows(rows: DataFrame, periods: DataFrame) -> DataFrame:
    """Rows with the role of their period, the first role that carries the label.

    ``periods`` has ``document_id, ord, role, label``; ``rows`` has ``document_id, periodo``.
    """
    first = periods.where("label is not null").groupBy("document_id", F.col("label").alias("periodo")).agg(F.min_by("role", "ord").alias("papel_periodo"))
    return rows.join(first, ["document_id", "periodo"], "left")


def export_preflight(rows: DataFrame, audit: DataFrame, runs: DataFrame) -> DataFrame:
    """Reasons not to export; nothing is written unless there are none.

    ``rows`` has ``document_id, operation, periodo, valor``; ``audit`` the same plus
    ``page_number, has_bbox``; ``runs`` has ``status, failed, source_uri``.
    """
    def problem(df: DataFrame, name: str, detail: Column) -> DataFrame:
        return df.select("document_id", F.lit(name).alias("problem"), detail.cast("string").alias("detail"))

    key = ["document_id", "operation", "periodo", "valor"]
    usable = audit.where("valor is not null and coalesce(periodo, '') <> ''")
    has_place = F.col("page_number").isNotNull() & F.col("has_bbox")
    # Values and their evidence meet in one group per value: what is shown, proven, and printed without a place.
    no = F.lit(False)
    marked = rows.select(*key, F.lit(True).alias("_shown"), no.alias("_proven"), no.alias("_bare")).unionByName(
        usable.select(*key, no.alias("_shown"), has_place.alias("_proven"), (~has_place).alias("_bare"))
    )
    # A value that lacks a part of its key is never proven.
    whole = reduce(and_, [F.col(k).isNotNull() for k in key])
    found = marked.groupBy(*key).agg(*[F.bool_or(c).alias(c) for c in ("_shown", "_proven", "_bare")])
    named = F.array_compact(
        F.array(
            F.when(F.col("_bare"), F.lit("evidence_without_place")),
            F.when(F.col("_shown") & ~(whole & F.coalesce("_proven", no)), F.lit("value_without_evidence")),
        )
    )
    what = F.concat_ws("/", "operation", "periodo", F.col("valor").cast("string"))
    out = problem(runs.where("status <> 'compativel' or failed > 0"), "not_compatible", F.col("status"))
    out = out.unionByName(problem(runs.where("coalesce(source_uri, '') = ''"), "source_missing", F.lit(None)))
    return out.unionByName(found.select("document_id", F.explode(named).alias("problem"), what.alias("detail")))


def manifest_of(resolutions: DataFrame, manifests: DataFrame) -> DataFrame:
    """The only manifest of each resolution in ``manifest_key``; ``problem`` says where there is none
    (``no_manifest``) or where there are several (``several_manifests``), and the key is null."""
    key = ["entity", "document_id", "execution_id"]
    found = manifests.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.min("manifest_key").alias("_k"))
    joined = resolutions.join(found, key, "left")
    problem = F.when(F.col("_n").isNull(), "no_manifest").when(F.col("_n") > 1, "several_manifests")
    return joined.select(*resolutions.columns, F.when(F.col("_n") == 1, F.col("_k")).alias("manifest_key"), problem.alias("problem"))
