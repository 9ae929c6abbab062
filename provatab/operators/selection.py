"""What to process: pending sets, duplicates, latest-per-key, versions, batches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provatab.cluster import checkpointed, first_per_key
from provatab.functions.periods import disclosure_window
from provatab.functions.text import normalize_text

COMPATIBLE = "compativel"


# --- pending work and duplicates -------------------------------------------------------------


def pending(
    candidates: DataFrame,
    done: DataFrame,
    keys: Sequence[str],
    *,
    allowed: DataFrame | None = None,
    forced: bool = False,
) -> DataFrame:
    """Candidates without a finished run; ``allowed`` narrows them, ``forced`` keeps finished ones."""
    keys = list(keys)
    chosen = candidates if allowed is None else candidates.join(allowed.select(*keys).distinct(), keys, "left_semi")
    return chosen if forced else chosen.join(done.select(*keys).distinct(), keys, "left_anti")


def unknown_requests(candidates: DataFrame, allowed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Requested keys no candidate has; must be empty before the job starts."""
    keys = list(keys)
    return allowed.select(*keys).distinct().join(candidates.select(*keys), keys, "left_anti")


def flag_duplicates(df: DataFrame, content: Column, order: Column) -> DataFrame:
    """Content hash, the document id cut from it, and whether an earlier row had the content.

    The earliest row per hash comes from a partial aggregate, so a content copied a billion
    times costs one row per task, not one sort of a billion rows.
    """
    hashed = df.withColumn("sha256", F.sha2(content, 256)).withColumn("_at", order)
    firsts = hashed.groupBy("sha256").agg(F.min("_at").alias("_first"))
    return hashed.join(firsts, "sha256").select(
        *df.columns,
        "sha256",
        F.substring("sha256", 1, 32).alias("document_id"),
        F.when(F.col("_at") == F.col("_first"), "novo").otherwise("duplicado").alias("status"),
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | Column) -> DataFrame:
    """First row per key in the given order."""
    return first_per_key(df, list(keys), order)


def distinct_in_order(df: DataFrame, key: str, position: str) -> DataFrame:
    """Distinct keys with the position they first appear at; sort by it where order matters."""
    return df.groupBy(key).agg(F.min(position).alias(position))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | Column) -> DataFrame:
    """Latest row per key; rows with an incomplete key are dropped."""
    complete = df
    for key in keys:
        complete = complete.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    return first_per_key(complete, list(keys), order, last=True)


def latest_unresolved(runs: DataFrame, complete: DataFrame, keys: Sequence[str], run: Sequence[str], order) -> DataFrame:
    """The latest run per key, dropped (never replaced by an older one) when it is complete."""
    return latest_per_key(runs, keys, order).join(complete.select(*run).distinct(), list(run), "left_anti")


def run_completeness(audits: DataFrame, summaries: DataFrame, run: Sequence[str]) -> DataFrame:
    """complete = summary compatible, no failed mapping, no required item unresolved.

    ``summaries`` has ``validation_status`` and ``failed`` per run; a run without audit rows is
    complete when its summary is.
    """
    run = list(run)
    open_items = audits.groupBy(*run).agg(
        F.count_if(F.col("obrigatorio") & (F.coalesce(F.col("status_resolucao"), F.lit("")) != "resolvido")).alias("n_open")
    )
    complete = (
        (F.trim("validation_status") == COMPATIBLE)
        & (F.coalesce(F.col("failed"), F.lit(-1)) == 0)
        & (F.coalesce(F.col("n_open"), F.lit(0)) == 0)
    )
    return summaries.join(open_items, run, "left").select(
        *run, F.coalesce(complete, F.lit(False)).alias("complete")
    )


def latest_for_period(rows: DataFrame, period: Column, wanted: str, keys: Sequence[str], modified: str, seq: str) -> DataFrame:
    """Latest row per key among those of one reference period; on a tie the first seen stays."""
    return first_per_key(rows.where(period == wanted), list(keys), [F.col(modified), -F.col(seq)], last=True)


def latest_per_month(rows: DataFrame, label: str, modified: str, seq: str) -> DataFrame:
    """Latest row per ``AAAA-MM`` publication month; other labels are skipped."""
    valid = rows.where(F.col(label).rlike("^\\d{4}-(0[1-9]|1[0-2])$"))
    return first_per_key(valid, [label], [F.col(modified), -F.col(seq)], last=True)


# --- versions ---------------------------------------------------------------------------------


def version_of(key: Column) -> Column:
    """struct(major, minor, patch) of ``.../vX.Y.Z/...`` or a bare version; null otherwise."""
    pattern = "(?:^|/)v(\\d+)\\.(\\d+)\\.(\\d+)(?:/|$)"
    parts = [F.regexp_extract(key, pattern, i + 1).try_cast("int").alias(n) for i, n in enumerate(("major", "minor", "patch"))]
    return F.when(key.rlike(pattern), F.struct(*parts))


def highest_version(df: DataFrame, identity: Sequence[str], key: str, *, unique: bool = True) -> DataFrame:
    """P10: row with the highest version per identity. With ``unique`` an identity whose highest version several rows
    share has a null key and says so in ``problem``; it stops no other."""
    versioned = df.withColumn("version", version_of(F.col(key))).where(F.col("version").isNotNull())
    top = versioned.groupBy(*identity).agg(F.max("version").alias("version"))
    chosen = versioned.join(top, [*identity, "version"]).groupBy(*identity, "version").agg(
        F.min(key).alias(key), F.count(F.lit(1)).alias("_n")
    )
    if unique:
        chosen = chosen.withColumns({key: F.when(F.col("_n") == 1, F.col(key)), "problem": F.when(F.col("_n") > 1, "ambiguous_version")})
    return chosen.drop("_n")


def next_minor_version(df: DataFrame, identity: Sequence[str], key: str) -> DataFrame:
    """Version the next publication of each identity gets; ``v1.0.0`` when it has none."""
    top = df.groupBy(*identity).agg(F.max(version_of(F.col(key))).alias("v"))
    return top.select(
        *identity,
        F.when(F.col("v").isNull(), F.lit("v1.0.0"))
        .otherwise(F.format_string("v%d.%d.0", F.col("v.major"), F.col("v.minor") + 1))
        .alias("next_version"),
    )


# --- runs and traces --------------------------------------------------------------------------


def prefer_rerun(df: DataFrame, keys: Sequence[str], run: str, suffix: str = "__r2") -> DataFrame:
    """Where any run of a key is a re-run, keep only the re-runs."""
    again = F.col(run).endswith(suffix)
    marked = df.where(again).select(*keys).distinct().withColumn("_again", F.lit(True))
    return (
        df.join(marked, list(keys), "left")
        .where(F.col("_again").isNull() | again)
        .select(*df.columns)
    )


def admit_traces(df: DataFrame, resolution: str, name: str = "name", mode: str = "mode") -> DataFrame:
    """Drop traces named ``resolution``, except those that revalidate a candidate."""
    return df.where(
        (F.col(name) != resolution) | F.coalesce(F.col(mode) == "revalidacao_layout_candidato", F.lit(False))
    )


def in_window(docs: DataFrame, day: Column, *, text: str, quarter: str, year: str, reference: str) -> DataFrame:
    """Documents of the quarter disclosed around ``day``.

    A document belongs to the window when its text names the quarter, or its own quarter and
    year say so, or its reference date falls in it.
    """
    w = disclosure_window(day)
    staged = docs.withColumn("_w", w).where(F.col("_w").isNotNull())
    q, y = F.col("_w.trimestre"), F.col("_w.ano")
    two = F.lpad(F.pmod(y, F.lit(100)).cast("string"), 2, "0")
    label = normalize_text(F.col(text))
    named = label.contains(F.concat(q.cast("string"), F.lit("t"), two)) | label.contains(
        F.concat(q.cast("string"), F.lit("q"), two)
    )
    stated = F.coalesce((F.col(quarter) == q) & (F.col(year) == y), F.lit(False))
    dated = F.coalesce((F.quarter(reference) == q) & (F.year(reference) == y), F.lit(False))
    return staged.where(named | stated | dated).select(*docs.columns)


def looks_like_pdf(url: Column, mime: Column, also: Sequence[str] = ()) -> Column:
    """A PDF by extension or type, or by any of the address parts ``also``, for servers that show neither."""
    shown = normalize_text(F.concat_ws(" ", url, mime))
    return reduce(lambda found, part: found | shown.contains(part), also, shown.contains(".pdf") | shown.contains("application/pdf"))


def matches_keywords(text: Column, keywords: Sequence[str]) -> Column:
    key = normalize_text(text)
    hit = F.lit(False)
    for word in keywords:
        hit = hit | key.contains(normalize_text(F.lit(word)))
    return hit


def candidate_documents(docs: DataFrame, day: Column, keywords: Sequence[str], **columns: str) -> DataFrame:
    """PDF-like, named by a keyword, and inside the disclosure window."""
    url, mime = columns.pop("url"), columns.pop("mime")
    shaped = docs.where(
        looks_like_pdf(F.col(url), F.col(mime)) & matches_keywords(F.concat_ws(" ", columns["text"], url), keywords)
    )
    return in_window(shaped, day, **columns)


def walk_json(df: DataFrame, col: str) -> DataFrame:
    """Every object nested in a JSON column, with its path, at any depth.

    Variants are exploded level by level until no container is left; each level is written once and read by the next.
    """
    spark = df.sparkSession
    keep = [c for c in df.columns if c != col]
    level = checkpointed(df.select(*keep, F.lit("$").alias("path"), F.try_parse_json(col).alias("node")))
    found = None
    while True:
        kind = F.schema_of_variant("node")
        objects = level.where(kind.startswith("OBJECT")).select(*keep, "path", F.to_json("node").alias("object"))
        found = objects if found is None else found.unionByName(objects)
        step = F.when(F.col("key").isNull(), F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]"))).otherwise(
            F.concat(F.lit("."), F.col("key"))
        )
        level = checkpointed(
            level.where(kind.rlike("^(OBJECT|ARRAY)"))
            .lateralJoin(spark.tvf.variant_explode(F.col("node").outer()))
            .select(*keep, F.concat("path", step).alias("path"), F.col("value").alias("node"))
            .where(F.schema_of_variant("node").rlike("^(OBJECT|ARRAY)"))
        )
        if level.isEmpty():
            return found


def list_runs(runs: DataFrame, created: str, *, entity: Column | None = None) -> DataFrame:
    """Runs of an entity, newest first."""
    chosen = runs if entity is None else runs.where(entity)
    return chosen.orderBy(F.col(created).desc())


def list_versions(contracts: DataFrame, domain: str, key: str) -> DataFrame:
    """Contract versions per domain with their rank, newest first, compared as numbers."""
    versions = contracts.select(domain, version_of(F.col(key)).alias("version")).where("version is not null").distinct()
    w = Window.partitionBy(domain).orderBy(F.col("version").desc())
    return versions.select(
        domain,
        F.format_string("v%d.%d.%d", "version.major", "version.minor", "version.patch").alias("version"),
        F.row_number().over(w).alias("position"),
    )


# --- batches ----------------------------------------------------------------------------------


def batch_summary(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """P20: processed and changed counts of a batch."""
    changed = F.count_if(F.coalesce(F.col("layout_alterado"), F.lit(False)))
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("processed_count"),
        changed.alias("layout_changed_count"),
        (changed > 0).alias("layout_alterado"),
    )


def repair_requests(results: DataFrame, mode: str = "modo_execucao") -> DataFrame:
    """P20: changed runs become repair requests, unless the run itself revalidated a candidate."""
    revalidated = F.coalesce(F.trim(mode) == "revalidacao_layout_candidato", F.lit(False))
    return results.where(F.coalesce(F.col("layout_alterado"), F.lit(False)) & ~revalidated)


def recover_batch(runs: DataFrame, configs: DataFrame, release: str, *, manual: bool = False) -> DataFrame:
    """The runs of a release, one per (document, execution), with the config they started from.

    ``missing_manifest`` marks runs whose config names none. Runs outside the batch naming
    pattern are ignored unless ``manual``.
    """
    prefix = F.lit(f"{release}__")
    expected = F.concat(prefix, F.col("domain"), F.lit("__"), F.col("entity"))
    short = F.regexp_replace("run_id", "^[^_]+(?:_[^_]+)*?__(?=" + release + "__)", "")
    runs = runs.withColumn("_batch", short == expected)
    runs = runs if manual else runs.where("_batch")
    firsts = first_per_key(runs, ["document_id", "execution_id"], [F.col("started"), F.col("run_id")])
    joined = firsts.join(configs.select("run_id", "manifest_key"), "run_id", "left")
    missing = F.coalesce(F.trim("manifest_key"), F.lit("")) == ""
    return joined.select(*runs.drop("_batch").columns, "manifest_key", missing.alias("missing_manifest"))


def lineage_edges(links: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct (source, target) edges that are not recorded yet."""
    edges = links.select("source", "target").where("source is not null and target is not null").distinct()
    return edges if existing is None else edges.join(existing.select("source", "target"), ["source", "target"], "left_anti")


def newest_extraction(extractions: DataFrame, files: DataFrame, key: str, order) -> tuple[DataFrame, DataFrame]:
    """Newest extraction per source file, and the files that have none."""
    newest = latest_per_key(extractions, [key], order)
    return newest, files.join(newest.select(key), key, "left_anti")


def short_name_clashes(files: DataFrame, key: str, short: Column) -> DataFrame:
    """Short names shared by several files; must be empty."""
    return files.select(F.col(key), short.alias("short")).groupBy("short").agg(F.count_distinct(key).alias("n")).where("n > 1")


def first_filled(*values: Column) -> Column:
    """First value that is not blank, trimmed."""
    return F.coalesce(*[F.nullif(F.trim(v.cast("string")), F.lit("")) for v in values])


def normalize_identity(df: DataFrame, *, entity: Sequence[Column], period: Sequence[Column], domain: Sequence[Column]) -> DataFrame:
    """Identity from the manifest, else from the path, legacy names last; year read from the period."""
    label = F.coalesce(first_filled(*period), F.lit("sem_periodo"))
    year = F.coalesce(F.regexp_extract(label, "(20\\d{2})", 1).try_cast("int"), F.lit(0))
    return df.withColumns(
        {
            "domain": F.lower(first_filled(*domain)),
            "entity": F.lower(first_filled(*entity)),
            "period_label": label,
            "reference_year": year,
        }
    )


def detection_summary(documents: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """P25: counts of a detection run; the slim document list is a select on the same input."""
    return documents.groupBy(*by).agg(
        F.count(F.lit(1)).alias("candidates_count"),
        F.count_if(F.col("status") == "novo").alias("downloaded_count"),
        F.count_if(F.col("status") == "duplicado").alias("duplicate_count"),
        F.count_if(F.col("queued")).alias("queued_for_extraction_count"),
        F.count_if(F.col("extraction_status") == "concluida").alias("extracted_count"),
    )
