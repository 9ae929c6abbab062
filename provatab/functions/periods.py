"""Period labels as comparable structs (N19-N23, N28) and disclosure windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from provatab.functions.text import bound, fold_ascii, normalize_space

# Month abbreviations (pt, en), periods per year, superscripts that mark footnotes.
MONTHS = {
    "jan": 1, "fev": 2, "feb": 2, "mar": 3, "abr": 4, "apr": 4, "mai": 5, "may": 5,
    "jun": 6, "jul": 7, "ago": 8, "aug": 8, "set": 9, "sep": 9, "out": 10, "oct": 10,
    "nov": 11, "dez": 12, "dec": 12,
}
PER_YEAR = {"trimestre": 4, "semestre": 2, "mes": 12, "ano": 1}
SUPERSCRIPTS = "[¹²³⁴⁵⁶⁷⁸⁹⁰]+"
FOOTNOTES = "(\\s*\\([a-z0-9]{1,2}\\)|\\s*\\[[a-z0-9]{1,2}\\]|\\*+)+$"
# Accepted spellings as (scope, pattern, group of the index, group of the year).
YEAR = "(\\d{4}|\\d{2})"
SPELLINGS = (
    ("trimestre", "^([1-4])\\s*[°ºo]?\\s*(?:t|q|tri|trim|trimestre)\\s*[/\\-]?\\s*" + YEAR + "$", 1, 2),
    ("trimestre", "^(?:t|q)\\s*([1-4])\\s*[/\\-]?\\s*" + YEAR + "$", 1, 2),
    ("trimestre", "^" + YEAR + "\\s*[/\\-]?\\s*(?:t|q)\\s*([1-4])$", 2, 1),
    ("semestre", "^([1-2])\\s*[°ºo]?\\s*(?:s|sem|semestre|h)\\s*[/\\-]?\\s*" + YEAR + "$", 1, 2),
    ("semestre", "^(?:s|h)\\s*([1-2])\\s*[/\\-]?\\s*" + YEAR + "$", 1, 2),
    ("mes", "^([a-z]{3})[a-z]*\\s*[/\\-]?\\s*" + YEAR + "$", 1, 2),
    ("mes", "^(0?[1-9]|1[0-2])/(\\d{4})$", 1, 2),
    ("ano", "^()(\\d{4})$", 1, 2),
)


def strip_footnotes(label: Column) -> Column:
    clean = F.lower(normalize_space(fold_ascii(F.regexp_replace(F.coalesce(label, F.lit("")), SUPERSCRIPTS, ""))))
    return F.trim(F.regexp_replace(clean, FOOTNOTES, ""))


def make_period(scope: Column, year: Column, index: Column) -> Column:
    return F.struct(scope.alias("escopo"), year.cast("int").alias("ano"), index.cast("int").alias("indice"))


def _spelled(text: Column) -> Column:
    months = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])
    readings = []
    for scope, pattern, index_group, year_group in SPELLINGS:
        raw_index = F.regexp_extract(text, pattern, index_group)
        year = F.regexp_extract(text, pattern, year_group).try_cast("int")
        year = F.when(year < 100, year + 2000).otherwise(year)
        if pattern.startswith("^([a-z]{3})"):
            index = F.try_element_at(months, raw_index)
        elif scope == "ano":
            index = F.lit(1)
        else:
            index = raw_index.try_cast("int")
        readings.append(
            F.when(text.rlike(pattern) & index.isNotNull(), make_period(F.lit(scope), year, index))
        )
    return F.coalesce(*readings)


def period_of(label: Column) -> Column:
    """The period a whole label states, or null."""
    # Every accepted spelling holds a digit; the test spares other labels the patterns.
    return bound(strip_footnotes(label), lambda t: F.when(t.rlike("\\d"), _spelled(t)))


def per_year(scope: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in PER_YEAR.items() for x in pair])
    return F.try_element_at(table, scope)


def step_back(period: Column, steps: Column | int = 1) -> Column:
    """The period ``steps`` before, within the same scope."""
    steps = F.lit(steps) if isinstance(steps, int) else steps
    n = per_year(period["escopo"])
    absolute = period["ano"] * n + period["indice"] - 1 - steps
    return F.when(
        period.isNotNull(),
        make_period(period["escopo"], F.floor(absolute / n), F.pmod(absolute, n) + 1),
    )


def same_period_last_year(period: Column) -> Column:
    return F.when(period.isNotNull(), make_period(period["escopo"], period["ano"] - 1, period["indice"]))


def period_label(period: Column) -> Column:
    """Canonical label, for messages only."""
    short = F.lpad(F.pmod(period["ano"], F.lit(100)).cast("string"), 2, "0")
    index = period["indice"].cast("string")
    return (
        F.when(period["escopo"] == "trimestre", F.concat(index, F.lit("T"), short))
        .when(period["escopo"] == "semestre", F.concat(index, F.lit("S"), short))
        .when(period["escopo"] == "mes", F.concat(F.lpad(index, 2, "0"), F.lit("/"), period["ano"].cast("string")))
        .otherwise(period["ano"].cast("string"))
    )


def derive_period(reference: Column, origin: Column, relation: Column, step: Column) -> Column:
    """Apply a declared relation; an undeclared one derives nothing."""
    relation = F.trim(F.coalesce(relation, F.lit("")))
    step = F.coalesce(step, F.lit(1))
    back = (
        F.when((relation == "") & (F.coalesce(origin, F.lit("")) != ""), 0)
        .when((relation == "anterior") & (step >= 1), step)
        .when(relation == "mesmo_periodo_ano_anterior", per_year(reference["escopo"]))
    )
    return F.when(back.isNotNull(), step_back(reference, back))


def chart_period_key(label: Column) -> Column:
    """(year, quarter) of a column header, quarter 0 for a bare year; null otherwise."""
    clean = normalize_space(label)
    quarter = "(?i)^(\\d+)T\\s*(\\d{4})$"
    return F.when(
        clean.rlike(quarter),
        F.struct(
            F.regexp_extract(clean, quarter, 2).cast("int").alias("year"),
            F.regexp_extract(clean, quarter, 1).cast("int").alias("quarter"),
        ),
    ).when(clean.rlike("^\\d{4}$"), F.struct(clean.cast("int").alias("year"), F.lit(0).alias("quarter")))


def is_chart_period(label: Column) -> Column:
    """A header that names a quarter, a year or a month of a year."""
    return normalize_space(label).rlike(
        "(?i)^(?:\\d+T\\s*\\d{4}|\\d{4}|(?:jan|fev|mar|abr|mai|jun|jul|ago|set|out|nov|dez)\\s+\\d{4})$"
    )


def period_tokens(text: Column) -> Column:
    """Quarters and years named in a text, upper case, in order."""
    found = F.regexp_extract_all(normalize_space(text), F.lit("(?i)(\\b\\d+T\\s*\\d{4}\\b|\\b\\d{4}\\b)"), F.lit(1))
    return F.transform(found, lambda t: F.upper(t))


def loader_period(label: Column) -> Column:
    """Leading quarter label such as ``2T26``; null when there is none."""
    return F.nullif(F.regexp_extract(F.trim(label), "^([1-4]T\\d{2})\\b", 1), F.lit(""))


def execution_time(execution: Column) -> Column:
    """Time stamp carried by an execution id; null when it carries none."""
    dashed = F.regexp_extract(execution, "(\\d{4}-\\d{2}-\\d{2}T[\\d_]+)\\.\\d+", 1)
    compact = F.regexp_extract(execution, "(\\d{8}T\\d{6})Z", 1)
    return F.coalesce(
        F.try_to_timestamp(F.replace(dashed, F.lit("_"), F.lit(":")), F.lit("yyyy-MM-dd'T'HH:mm:ss")),
        F.try_to_timestamp(compact, F.lit("yyyyMMdd'T'HHmmss")),
    )


def disclosure_window(day: Column) -> Column:
    """(year, quarter) whose results are disclosed around a date; null between windows."""
    month, year = F.month(day), F.year(day)

    def window(y: Column, q: int) -> Column:
        return F.struct(y.cast("int").alias("ano"), F.lit(q).alias("trimestre"))

    return (
        F.when(month.isin(4, 5), window(year, 1))
        .when(month.isin(7, 8), window(year, 2))
        .when(month.isin(10, 11), window(year, 3))
        .when(month.isin(2, 3), window(year - 1, 4))
    )
