"""Scans of stored artefacts and of the keys they are stored under."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CALL_KINDS = ("entrada_llm", "resposta_llm", "erro_llm")
RUN_KEY = "^fallback/([^/]+)/([^/]+)/document_id=([^/]+)/execution_id=([^/]+)/(.*)$"


def _variant_fields(value: str, fields) -> list[Column]:
    """Fields of a variant by name; one of another type is cast if it can be and null if not."""
    quoted = [(f, f.name.replace("\\", "\\\\").replace("'", "\\'")) for f in fields]
    return [F.try_variant_get(value, f"$['{name}']", f.dataType.simpleString()).alias(f.name) for f, name in quoted]


def _only_value(text: Column) -> Column:
    """The JSON value that makes up the whole text; null for no JSON, several values, or text behind one.

    The parser stops behind the first value. So the text becomes the first member of a list that ends in a digest of
    the text: only a whole value leaves that list with these two members.
    """
    digest = F.md5(text)
    both = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), digest, F.lit('"]'))), F.lit("$"), "array<variant>")
    whole = (F.size(both) == 2) & (F.try_variant_get(F.get(both, F.lit(1)), F.lit("$"), "string") == digest)
    return F.when(whole, F.get(both, F.lit(0)))


def _shape(value: Column) -> Column:
    """``object``, ``list`` or ``other``."""
    kind = F.schema_of_variant(value)
    return F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "list").otherwise("other")


def read_artifacts(spark: SparkSession, glob: str, schema: str, *, shape: str = "object") -> DataFrame:
    """S1 (``object``) and S3 (``list`` of objects): one JSON value per file and nothing else, of that shape only.

    Rows have the fields, ``source_key`` (the file) and ``problem``: null, or why the file or a
    member of its list was not taken (``not_json``, ``not_object``, ``not_list``). A bad file gives
    one problem row and stops no other; a file without any byte gives none, since Spark does not open it.
    """
    fields = spark.createDataFrame([], schema).schema.fields
    files = spark.read.text(glob, wholetext=True).select(_only_value(F.col("value")).alias("_v"), F.col("_metadata.file_path").alias("source_key"))
    told = files.withColumn("problem", F.when(F.col("_v").isNull(), "not_json").when(_shape(F.col("_v")) != shape, f"not_{shape}"))
    if shape == "list":
        members = F.when(F.col("problem").isNull(), F.try_variant_get("_v", F.lit("$"), "array<variant>"))
        told = told.select("source_key", F.col("problem").alias("_whole"), F.explode_outer(members).alias("_v")).where("_v is not null or _whole is not null")
        told = told.withColumn("problem", F.coalesce("_whole", F.when(_shape(F.col("_v")) != "object", "not_object")))
    told = told.withColumn("_v", F.when(F.col("problem").isNull(), F.col("_v")))
    return told.select(*_variant_fields("_v", fields), "source_key", "problem")


def read_jsonl(spark: SparkSession, glob: str, schema: str, *, problems: bool = False) -> DataFrame:
    """JSON lines, one object each and nothing behind it; blank lines are skipped, missing files are empty.

    Every object stays: a field of another type than asked for is cast if it can be and null if not. Other lines are
    skipped, or with ``problems`` stay as rows whose ``problem`` is ``not_json`` or ``not_object``.
    """
    fields = spark.createDataFrame([], schema).schema.fields
    try:
        # Lines are split first, so one bad line never hides its neighbours.
        lines = spark.read.text(glob).select("value", F.col("_metadata.file_path").alias("source_key"))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        none = spark.createDataFrame([], schema).withColumn("source_key", F.lit(None).cast("string"))
        return none.withColumn("problem", F.lit(None).cast("string")) if problems else none
    parsed = lines.where(F.trim(F.regexp_replace("value", r"\s+", " ")) != "").select(_only_value(F.col("value")).alias("_v"), "source_key")
    told = parsed.withColumn("problem", F.when(F.col("_v").isNull(), "not_json").when(_shape(F.col("_v")) != "object", "not_object"))
    told = told.withColumn("_v", F.when(F.col("problem").isNull(), F.col("_v")))
    if not problems:
        return told.where("problem is null").select(*_variant_fields("_v", fields), "source_key")
    return told.select(*_variant_fields("_v", fields), "source_key", "problem")


def key_part(key: Column, field: str) -> Column:
    """Value of ``field=value`` in a stored key; null when the key has none."""
    return F.nullif(F.regexp_extract(key, f"(?:^|/){field}=([^/]+)", 1), F.lit(""))


def entity_of(key: Column, marker: str = "resolucao") -> Column:
    return F.nullif(F.regexp_extract(key, f"(?:^|/){marker}/([^/]+)", 1), F.lit(""))


def with_path_keys(df: DataFrame, key: str = "object_key", marker: str = "resolucao") -> DataFrame:
    """Identity of a stored object from its key."""
    k = F.col(key)
    return df.withColumns(
        {
            "document_id": key_part(k, "document_id"),
            "execution_id": key_part(k, "execution_id"),
            "entity": entity_of(k, marker),
        }
    )


def group_artifacts(keys: DataFrame, key: str = "object_key") -> DataFrame:
    """Run artefacts as (domain, entity, document, execution) with their number and key span.

    The keys of a run stay rows of the input; an array of them per run would not be bounded.
    """
    k = F.col(key)
    names = ("domain", "entity", "document_id", "execution_id", "rest")
    parsed = keys.select(key, *[F.regexp_extract(k, RUN_KEY, i + 1).alias(n) for i, n in enumerate(names)])
    return (
        parsed.where(F.col("domain") != "")
        .groupBy(*names[:4])
        .agg(F.count(F.lit(1)).alias("n_artifacts"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))
    )


def attempt_index(keys: DataFrame, key: str = "object_key", by: Sequence[str] = ()) -> DataFrame:
    """Call artefacts as one row per (run, stage, attempt) with a column per artefact kind."""
    name = F.element_at(F.split(key, "/"), -1)
    pattern = f"^({'|'.join(CALL_KINDS)})_(.*?)(?:_tentativa_(\\d+))?(?:\\.json)?$"
    stage = F.regexp_extract(name, pattern, 2)
    parsed = keys.select(
        *by,
        F.col(key).alias("_key"),
        F.regexp_extract(name, pattern, 1).alias("kind"),
        stage.alias("stage"),
        F.coalesce(F.regexp_extract(name, pattern, 3).try_cast("int"), F.lit(0)).alias("attempt"),
    ).where("kind <> ''")
    return parsed.groupBy(*by, "stage", "attempt").agg(
        *[F.max(F.when(F.col("kind") == kind, F.col("_key"))).alias(kind) for kind in CALL_KINDS]
    )


def artifact_uris(manifests: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """One row per artefact URI of a manifest, with the kind its path fragment names."""
    kind = F.lit(None).cast("string")
    for name, fragment in reversed(list(kinds.items())):
        kind = F.when(F.col("uri").contains(fragment), name).otherwise(kind)
    keep = [c for c in manifests.columns if c != "artifact_uris"]
    return manifests.select(*keep, F.explode("artifact_uris").alias("uri")).withColumn("kind", kind)
