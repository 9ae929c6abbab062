"""Published number text -> double (N1-N6) and cell tests (N17, N18), without Python workers.

Everything is a column expression; nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from provatab.functions.text import bound, fold_compat, normalize_space

# Words that scale a number, and column-name hints.
SCALE_WORDS = "bi|billion|mi|million|mil"
INTEGER_HINTS = (
    "unidades",
    "total",
    "acumulado",
    "4t_",
    "3t_",
    "2t_",
    "1t_",
    "norte",
    "nordeste",
    "sudeste",
    "sul",
    "centro_oeste",
)
PERCENT_HINTS = ("percent", "variacao", "variação", "pct")
THOUSANDS = "^[-+]?\\d{1,3}(?:\\.\\d{3})+$"
RATIO = "^[-+]?[\\d.,]+\\s*[xX]$"
# Column names that are dimensions, or percentages, whatever they hold.
DIMENSION_NAMES = (
    "region",
    "regiao",
    "região",
    "region_name",
    "categoria",
    "category",
    "group",
    "segment",
    "label",
    "name",
    "serie",
    "series",
    "series_name",
    "period",
    "trimestre",
    "date",
    "data",
    "month",
    "mes",
    "ano",
    "year",
)
PERCENT_NAMES = ("percentage", "percent", "variacao", "variacao_percentual", "pct")


def _any_hint(name: Column, hints) -> Column:
    return name.rlike("|".join(hints))


def _decimal_point(text: Column) -> Column:
    """Mixed separators: the later one is the decimal mark."""
    comma_last = F.length(text) - F.instr(F.reverse(text), ",") > F.length(text) - F.instr(F.reverse(text), ".")
    return F.when(comma_last, F.translate(text, ",.", ".")).otherwise(F.replace(text, F.lit(","), F.lit("")))


def _comma_decimal(text: Column) -> Column:
    return F.translate(text, ",.", ".")


def _number(text: Column) -> Column:
    return text.try_cast("double")


def number_of(text: Column, *, column: Column | None = None, published: bool = True) -> Column:
    """The number a cell states, or null.

    ``column`` is the column name that hints at integers or percentages. ``published=False``
    gives the stricter extraction-side variant: no accounting parentheses, no ratio suffix.
    Every intermediate text is bound once, so filters and joins on the result stay small when
    the optimizer moves them.
    """
    flat = normalize_space(fold_compat(text.cast("string")) if published else text.cast("string"))
    full = bound(flat, (lambda t: _signed(t, column)) if published else (lambda t: _value(t, column)))
    # Digits and separators only: no mark, word or sign can occur.
    general = F.when(text.rlike("^-?[0-9.,]+$"), bound(text, lambda t: _general(t, column))).otherwise(full)
    # The usual forms, which mean the same in every column: few operations, all compiled. Money whose comma a column
    # of integers would read otherwise takes the long way there.
    money = _MONEY if not published else f"{_MONEY}|^\\({_MONEY[1:-1]}\\)$"
    amount = F.translate(F.translate(text, "R$ ()", ""), ",.", ".").try_cast("double")
    amount = F.when(text.startswith("("), -amount).otherwise(amount)
    if column is not None:
        amount = F.when(_holds_integers(F.lower(normalize_space(column))), general).otherwise(amount)
    return (
        F.when(text.rlike("^-?[0-9]+(\\.[0-9]{1,2})?$"), _number(text))
        .when(text.rlike("^-?[0-9]+(,[0-9]+)?%$"), _number(F.translate(text, ",%", ".")))
        .when(text.rlike(money), amount)
        .otherwise(general)
    )


_MONEY = "^(?:R\\$ ?)?-?[0-9]{1,3}(?:\\.[0-9]{3})*,[0-9]{1,2}$"


def _holds_integers(hint: Column) -> Column:
    return hint.rlike("^\\d+t_\\d{4}$") | _any_hint(hint, INTEGER_HINTS)


def _signed(t: Column, column: Column | None) -> Column:
    wrapped = t.rlike("^\\(.*\\d.*\\)$")
    inner = F.when(wrapped, F.trim(F.substr(t, F.lit(2), F.length(t) - 2))).otherwise(t)
    bare = bound(inner, lambda i: F.when(i.rlike(RATIO), F.trim(F.substr(i, F.lit(1), F.length(i) - 1))).otherwise(i))
    return bound(bare, lambda b: _value(b, column)) * F.when(wrapped, -1.0).otherwise(1.0)


def _value(t: Column, column: Column | None) -> Column:
    percent = bound(F.regexp_replace(t, "[^0-9,.\\-+]", ""), lambda p: _number(_percent(p)))
    worded = bound(
        F.replace(t, F.lit("R$"), F.lit(" ")),
        lambda u: F.when(~u.rlike("[A-Za-zÀ-ÿ]"), 1.0).otherwise(_scale(u)),
    )
    return F.coalesce(F.when(t.contains("%"), percent), _general(t, column, worded))


def _scale(words: Column) -> Column:
    """Multiplier the words of a cell state; null when any word is not a scale."""
    foreign = F.regexp_replace(
        words, f"(?i)(?<![A-Za-zÀ-ÿ])(?:{SCALE_WORDS})(?![A-Za-zÀ-ÿ])", ""
    ).rlike("[A-Za-zÀ-ÿ]")
    return (
        F.when(foreign, None)
        .when(words.rlike("(?i)\\b(?:bi|billion)\\b"), 1e9)
        .when(words.rlike("(?i)\\b(?:mi|million)\\b"), 1e6)
        .when(words.rlike("(?i)\\bmil\\b"), 1e3)
        .otherwise(1.0)
    )


def _general(t: Column, column: Column | None, scale: Column | None = None) -> Column:
    kept = t if scale is None else F.regexp_replace(t, "[^0-9,.\\-]", "")
    if column is None:
        number = bound(kept, lambda k: _number(_plain(k, None, None)))
        return number if scale is None else number * scale
    hint = F.lower(normalize_space(column))
    parts = F.struct(
        _holds_integers(hint).alias("whole"),
        _any_hint(hint, PERCENT_HINTS).alias("share"),
        F.regexp_replace(t, "[^0-9.\\-+]", "").alias("i"),
        kept.alias("k"),
        (F.lit(1.0) if scale is None else scale).alias("scale"),
    )
    return bound(
        parts,
        lambda s: F.when(
            s["scale"].isNotNull(),
            F.coalesce(
                F.when(s["whole"], _whole(s["i"])), _number(_plain(s["k"], s["whole"], s["share"])) * s["scale"]
            ),
        ),
    )


def _percent(p: Column) -> Column:
    return (
        F.when(p.contains(",") & p.contains("."), _decimal_point(p)).when(p.contains(","), _comma_decimal(p)).otherwise(p)
    )


def _whole(i: Column) -> Column:
    return F.when(i.rlike(THOUSANDS), F.replace(i, F.lit("."), F.lit("")).try_cast("double")).when(
        i.rlike("^[-+]?\\d+$"), i.try_cast("double")
    )


def _plain(k: Column, whole: Column | None, share: Column | None) -> Column:
    """Separators of a cell already reduced to digits, separators and minus signs."""
    whole = F.lit(False) if whole is None else whole
    short = k.rlike("^[^,]*,[^,]{1,2}$")
    decimal = short if share is None else (share | short)
    return (
        F.when(whole & k.rlike(THOUSANDS), F.replace(k, F.lit("."), F.lit("")))
        .when(k.contains(",") & k.contains("."), _decimal_point(k))
        .when(k.contains(","), F.when(decimal, _comma_decimal(k)).otherwise(F.replace(k, F.lit(","), F.lit(""))))
        .when(k.rlike(THOUSANDS) | k.rlike("\\..*\\."), F.replace(k, F.lit("."), F.lit("")))
        .otherwise(k)
    )


def column_semantics(name: Column) -> Column:
    """What a normalised column name promises about its cells."""
    low = F.lower(name)
    return (
        F.when(low.isin(*DIMENSION_NAMES), "dimension")
        .when(low.rlike("^\\d+t_\\d{4}$"), "measure_integer")
        .when(low.isin(*PERCENT_NAMES) | low.rlike("variacao|percent"), "measure_percent")
        .when(low.rlike("count|total|amount|value|volume|quantity|qty"), "measure_integer")
        .when(low.rlike("date|time|period|quarter|month|year"), "dimension")
        .otherwise("unknown")
    )


def looks_numeric(cell: Column) -> Column:
    """The cell is nothing but a number, a percentage or a dash."""
    tight = F.replace(F.trim(cell), F.lit(" "), F.lit(""))
    return tight.rlike("^[\\-+(]?\\s*[\\d.,]+\\s*(%|p\\.?p\\.?)?\\)?$|^[\\-–—]$")


def looks_like_data(cell: Column) -> Column:
    """An identifier or a long digit run, so not a header."""
    tight = F.regexp_replace(cell, "\\s+", "")
    digits = F.regexp_replace(tight, "\\D", "")
    return (cell != "") & (
        tight.rlike("(?i)[0-9a-f]{6,}-[0-9a-f-]{10,}") | digits.rlike("^\\d{4,}$") | tight.rlike("^\\d+$")
    )


def generic_header(cell: Column, index: Column) -> Column:
    """An empty, numbered or ``column_n`` header, as the extractor writes when it reads none."""
    return (cell == "") | (cell == index.cast("string")) | (
        cell == F.concat(F.lit("column_"), (index + 1).cast("string"))
    )
