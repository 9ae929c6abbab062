"""Column clean-up jobs over whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provatab.cluster import ordinals
from provatab.functions import numbers, paths, periods, text


def typed_cells(cells: DataFrame, headers: DataFrame | None = None, keys: Sequence[str] = ("document_id", "table_id")) -> DataFrame:
    """Cells with the number they state and what their column promises.

    ``headers`` has one row per (keys, column_index) with ``column_name``; cells may carry the
    column already.
    """
    named = cells if headers is None else cells.join(headers, [*keys, "column_index"], "left")
    value = numbers.number_of(F.col("value_raw"), column=F.col("column_name"))
    return named.withColumns(
        {
            "value_num": value,
            "is_numeric": numbers.looks_numeric(F.col("value_raw")),
            "semantics": numbers.column_semantics(F.col("column_name")),
        }
    )


def normalize_labels(df: DataFrame, col: str, mode: str = "text", out: str = "key") -> DataFrame:
    """Comparison key of a label: ``text``, ``term`` (no separators), ``slug`` or ``compact``."""
    rule = {
        "text": text.normalize_text,
        "term": text.normalize_term,
        "slug": text.slugify,
        "compact": text.compact_text,
    }[mode]
    return df.withColumn(out, rule(F.col(col)))


def unique_name_rows(names: DataFrame, keys: Sequence[str], order: str, name: str, out: str = "name") -> DataFrame:
    """N10 for names in rows, however many a key has: ``column_index`` by ``order`` and the name made unique, as
    ``text.unique_names`` does within one array."""
    placed = ordinals(names.select(*keys, order, name), keys, order, "_at")
    clean = text.normalize_space(F.col(name))
    slug = text.slugify(F.when(clean == "", F.concat(F.lit("column_"), F.col("_at").cast("string"))).otherwise(clean))
    nth = ordinals(placed.withColumn("_slug", slug), [*keys, "_slug"], "_at", "_nth")
    full = F.when(F.col("_nth") > 1, F.concat("_slug", F.lit("_"), F.col("_nth").cast("string"))).otherwise(F.col("_slug"))
    return nth.select(*keys, (F.col("_at") - 1).cast("int").alias("column_index"), full.alias(out))


def with_stable_id(df: DataFrame, parts: Sequence[Column | str], out: str = "id") -> DataFrame:
    """Deterministic id of a row from its identifying parts."""
    return df.withColumn(out, text.stable_id(*[F.col(p) if isinstance(p, str) else p for p in parts]))


def classify_blocks(items: DataFrame) -> DataFrame:
    """Role, visual-mark flag, unit and label/value metric of each text item."""
    return items.withColumns(
        {
            "role": text.block_role(F.col("text"), F.col("label")),
            "is_artifact": text.is_visual_artifact(F.col("text")),
            "unit": text.unit_hint(F.col("text")),
            "metric": metric_of(F.col("text")),
        }
    )


_VALUE = "(?:R\\$\\s*)?[-+]?\\d[\\d.,]*(?:\\s*(?:bi|mi|mil|%))?"

def metric_of(raw: Column) -> Column:
    """struct(label, value_numeric, value_text) of a short text whose last number is its value."""
    marks = F.lit("\x02")

    def split_last(t: Column) -> Column:
        # Every match is fenced, so the pieces alternate: text, value, text, ..., value, text.
        return F.split(F.regexp_replace(t, f"(?i)({_VALUE})", "\x02$1\x02"), "\x02")

    def build(s: Column) -> Column:
        pieces, n = s["pieces"], F.size(s["pieces"])
        value = F.trim(F.get(pieces, n - 2))
        before = F.array_join(F.slice(pieces, F.lit(1), n - 2), "")
        label = text.normalize_space(
            F.regexp_replace(F.concat(before, F.get(pieces, n - 1)), "^[ :\\-|]+|[ :\\-|]+$", "")
        )
        return text.bound(
            F.struct(label.alias("label"), numbers.number_of(value, published=False).alias("value_numeric"), value.alias("value_text")),
            lambda m: F.when((m["label"] != "") & m["value_numeric"].isNotNull(), m),
        )

    def parse(t: Column) -> Column:
        usable = (t != "") & (F.length(t) <= 80) & ~t.rlike("^[\\d\\s/.,-]+$") & t.rlike("\\d") & ~t.contains(marks)
        return F.when(usable, text.bound(F.struct(split_last(t).alias("pieces")), build))

    return text.bound(text.normalize_space(raw), parse)


def resolve_periods(df: DataFrame, col: str, out: str = "period") -> DataFrame:
    """Period of a label, the one before, and the same one a year earlier."""
    staged = df.withColumn(out, periods.period_of(F.col(col)))
    return staged.withColumns(
        {
            f"{out}_prev": periods.step_back(F.col(out)),
            f"{out}_last_year": periods.same_period_last_year(F.col(out)),
        }
    )


def explode_paths(mappings: DataFrame, col: str = "mapping_path") -> DataFrame:
    """One row per segment of each mapping path; invalid paths give one row without a field."""
    segment = F.posexplode_outer(paths.path_segments(F.col(col)))
    return mappings.select("*", segment.alias("pos", "_segment")).select(
        *mappings.columns, "pos", "_segment.field", "_segment.key", "_segment.value"
    )


def substitute(value: Column, table: Mapping[str, str]) -> Column:
    """Exact replacements of cell text, blank results become null."""
    if not table:
        return F.nullif(F.trim(value), F.lit(""))
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.nullif(F.trim(F.coalesce(F.try_element_at(lookup, value), value)), F.lit(""))


FACT = "struct<metric:string,value:string,unit:string,qualifier:string,comparison:string,raw_text:string>"


def clean_facts(df: DataFrame, col: str, out: str = "facts", confidence: str | None = None) -> DataFrame:
    """Keep facts that quote literal text, confidence clamped to [0, 1]."""
    facts = F.from_json(F.col(col), f"array<{FACT}>")
    kept = F.filter(facts, lambda f: F.coalesce(F.trim(f["raw_text"]), F.lit("")) != "")
    trimmed = F.transform(kept, lambda f: f.withField("raw_text", F.trim(f["raw_text"])))
    cleaned = df.withColumn(out, F.coalesce(trimmed, F.expr(f"cast(array() as array<{FACT}>)")))
    if confidence:
        number = F.col(confidence).try_cast("double")
        clamped = F.when(number.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), number)))
        cleaned = cleaned.withColumn(confidence, clamped)
    return cleaned


def clean_records(
    df: DataFrame,
    substitutions: Mapping[str, Mapping[str, str]] | None = None,
    *,
    facts: str | None = None,
    confidence: str | None = None,
) -> DataFrame:
    """Text repairs per column, and fact clean-up."""
    for column, table in (substitutions or {}).items():
        df = df.withColumn(column, substitute(F.col(column), table))
    return clean_facts(df, facts, facts, confidence) if facts else df
