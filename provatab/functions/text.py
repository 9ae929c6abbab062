"""Text keys, titles, roles and stable ids as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as the text rules count it.
SPACE = "[\\s\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
# Runs of it that become one blank. Letters and single blanks before them are passed over by a plain range test first.
UNEVEN = "(?! ?[!-~])" + SPACE + "+"
NON_ASCII = "[^\\x00-\\x7F]"

# Item labels that always mark a title, and title beginnings.
TITLE_LABELS = (
    "title",
    "document_title",
    "section_header",
    "section_header_level_1",
    "section_header_level_2",
    "section_header_level_3",
    "header",
)
TITLE_PREFIXES = (
    "comparativo",
    "resumo",
    "lancamentos",
    "lançamentos",
    "indicadores",
    "overview",
    "summary",
    "analysis",
    "appendix",
    "section",
)
NOTE_PREFIXES = ("nota", "notas do usuario", "observacao", "observação")
LIST_LABELS = ("list_item", "list", "listitem")
# Letters the slug rule folds, and what they become; common signs that go with all else a slug can't hold.
SLUG_FROM, SLUG_TO = "áàãâäéêëíïóôõöúüç/- ", "aaaaaeeeiioooouuc___"
SLUG_DROPPED = ".,;:!?()[]{}'\"%$&*+=<>|#@"


def bound(value: Column, body) -> Column:
    """``body`` over ``value`` computed once, whatever the optimizer inlines or pushes down.

    A chain of projections is not enough: a filter or join key on the last column is pushed
    through them and repeats every shared sub-expression.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _code_points():
    yield from range(0x80, 0x3000)
    yield from range(0xFB00, 0xFB07)
    yield from range(0xFF01, 0xFF5F)


@cache
def _fold_table(form: str, strip: bool) -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Single-character folds for ``translate`` and the few that become several characters."""
    source, target, wide = [], [], []
    for point in _code_points():
        char = chr(point)
        folded = unicodedata.normalize(form, char)
        if strip:
            folded = "".join(c for c in folded if not unicodedata.combining(c) and ord(c) < 128)
        if folded == char or not folded:
            continue
        if len(folded) == 1:
            source.append(char)
            target.append(folded)
        elif strip and point in range(0xBC, 0xBF) or point in (0x2026, 0x2122, *range(0xFB00, 0xFB07)):
            wide.append((char, folded))
    return "".join(source), "".join(target), tuple(wide)


def _folded(text: Column, form: str, strip: bool) -> Column:
    source, target, wide = _fold_table(form, strip)
    folded = F.translate(text, source, target)
    for char, replacement in wide:
        folded = F.replace(folded, F.lit(char), F.lit(replacement))
    if strip:
        folded = F.regexp_replace(folded, NON_ASCII, "")
    return F.when(text.rlike(NON_ASCII), folded).otherwise(text)


def fold_ascii(text: Column) -> Column:
    """Compatibility letters without accents; what has no ASCII form is dropped."""
    return _folded(text, "NFKD", True)


def fold_compat(text: Column) -> Column:
    """Compatibility forms (full-width, superscripts, no-break spaces), accents kept."""
    return _folded(text, "NFKC", False)


def normalize_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), UNEVEN, " "))


def normalize_text(text: Column) -> Column:
    """Comparison key of a label."""
    return F.lower(normalize_space(fold_ascii(F.coalesce(text, F.lit("")))))


def normalize_term(text: Column) -> Column:
    """Comparison key without any separator, so glued words still match."""
    return F.regexp_replace(F.lower(fold_ascii(F.coalesce(text, F.lit("")))), "[^0-9a-z]+", "")


def slugify(text: Column) -> Column:
    """Machine name of a title; ``untitled`` when nothing is left."""
    folded = F.translate(F.lower(F.trim(text)), SLUG_FROM + SLUG_DROPPED, SLUG_TO)
    squeezed = F.regexp_replace(F.regexp_replace(folded, "(?![a-z])[^a-z0-9_]+", ""), "__+", "_")
    return bound(F.trim(squeezed, F.lit("_")), lambda slug: F.when(slug == "", F.lit("untitled")).otherwise(slug))


def unique_names(names: Column) -> Column:
    """Header array -> slugs, the n-th repeat of a slug gets ``_n``."""
    slugs = F.transform(
        names,
        lambda n, i: slugify(
            F.when(normalize_space(n) == "", F.concat(F.lit("column_"), (i + 1).cast("string"))).otherwise(
                normalize_space(n)
            )
        ),
    )
    def numbered(all_: Column) -> Column:
        def name(s: Column, i: Column) -> Column:
            nth = F.size(F.filter(F.slice(all_, F.lit(1), i + 1), lambda x: x == s))
            return bound(nth, lambda n: F.when(n > 1, F.concat(s, F.lit("_"), n.cast("string"))).otherwise(s))

        return F.transform(all_, name)

    return bound(slugs, numbered)


def stable_id(*parts: Column) -> Column:
    """Name-based UUID (version 5, URL name space) over the non-null parts."""
    material = F.concat_ws("||", *[p.cast("string") for p in parts])
    name_space = F.unhex(F.lit("6ba7b8119dad11d180b400c04fd430c8"))
    digest = F.sha1(F.concat(name_space, F.encode(material, "UTF-8")))
    variant = F.lower(F.hex((F.conv(F.substring(digest, 17, 2), 16, 10).cast("int").bitwiseAND(63)).bitwiseOR(128)))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 19, 2)),
        F.substring(digest, 21, 12),
    )


def unit_hint(text: Column) -> Column:
    """First unit marker that applies."""
    return (
        F.when(text.rlike("(?i)R\\$"), "currency_brl")
        .when(text.rlike("(?i)\\b(?:bi|billion)\\b"), "billions")
        .when(text.rlike("(?i)\\b(?:mi|million)\\b"), "millions")
        .when(text.contains("%"), "percent")
    )


def is_title(text: Column, label: Column) -> Column:
    """N13. Title case is tested as: every letter run starts with a capital and continues in
    lower case, with at least one letter."""
    return bound(F.struct(normalize_space(text).alias("t"), label.alias("b")), lambda s: _titled(s["t"], s["b"]))


def _titled(clean: Column, label: Column) -> Column:
    prefixed = F.lower(clean).rlike("^(?:" + "|".join(TITLE_PREFIXES) + ")")
    cased = clean.rlike("[\\p{Lu}\\p{Ll}]")
    upper = F.upper(clean) == clean
    title = ~clean.rlike("(?<![\\p{Lu}\\p{Ll}\\p{Lt}])\\p{Ll}|(?<=[\\p{Lu}\\p{Ll}\\p{Lt}])\\p{Lu}")
    few = F.size(F.split(clean, " ")) <= 14
    return (clean != "") & (
        F.coalesce(label.isin(*TITLE_LABELS), F.lit(False))
        | ((F.length(clean) <= 140) & prefixed)
        # Words are counted last, as most texts are no titles.
        | ((F.length(clean) <= 120) & cased & (upper | title) & few)
    )


def _role(s: Column) -> Column:
    clean, colon = s["t"], F.instr(s["t"], ":")
    suffix = F.substr(clean, colon + 1, F.length(clean))
    keyed = (colon > 1) & (colon <= 81)
    return (
        F.when(clean == "", "empty")
        .when(_titled(clean, s["b"]), "title")
        .when(F.lower(clean).rlike("^(?:" + "|".join(NOTE_PREFIXES) + ")"), "note")
        .when(s["b"].isin(*LIST_LABELS), "list_item")
        .when(keyed & (F.trim(suffix) == ""), "field_label")
        .when(keyed, "field")
        .when((colon > 0) & (suffix != "") & (F.length(clean) > 160), "narrative")
        .when(F.length(clean) > 200, "narrative")
        .otherwise("paragraph")
    )


def _artifact(clean: Column) -> Column:
    symbols = F.length(F.regexp_replace(clean, "(?U)[\\d\\s]", ""))
    quarter = F.greatest(F.lit(1), F.floor(F.length(clean) / 4).cast("int"))
    return (
        F.when(clean == "", True)
        .when(clean.rlike("\\p{L}"), False)
        .when(F.length(clean) <= 12, True)
        .otherwise(symbols >= quarter)
    )


def block_role(text: Column, label: Column) -> Column:
    """Role of a text block."""
    return bound(F.struct(normalize_space(text).alias("t"), label.alias("b")), _role)


def is_visual_artifact(text: Column) -> Column:
    """A mark on the page rather than words."""
    return bound(normalize_space(text), _artifact)


def running_role(text: Column, label: Column, roles: Sequence[str]) -> Column:
    """N14 and N15 over one cleaned text: its role if that is one of ``roles`` and the text is no mark, else null."""

    def kept(s: Column) -> Column:
        return bound(_role(s), lambda r: F.when(r.isin(*roles) & ~_artifact(s["t"]), r))

    return bound(F.struct(normalize_space(text).alias("t"), label.alias("b")), kept)


def compact_text(text: Column, limit: int | None = None) -> Column:
    """One line, cut with an ellipsis beyond ``limit`` if given; null when empty."""
    clean = normalize_space(text)
    whole = F.when(clean != "", clean)
    if limit is None:
        return whole
    return F.when(F.length(clean) > limit, F.concat(F.substring(clean, 1, limit - 3), F.lit("..."))).otherwise(whole)


def key_value(text: Column) -> Column:
    """``Key: value`` -> struct(key, value); null when the text has no usable key."""

    def pair(clean: Column) -> Column:
        colon = F.instr(clean, ":")
        key = F.trim(F.substr(clean, F.lit(1), colon - 1))
        value = F.trim(F.substr(clean, colon + 1, F.length(clean)))
        return F.when((colon > 1) & (key != "") & (F.length(key) <= 100), F.struct(key.alias("key"), value.alias("value")))

    return bound(normalize_space(text), pair)
