"""Mapping paths ``list[key=value].field`` as arrays of segments (N24) and nested reads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VALID_PATH = "^[^\\[\\].]+(\\[[^=\\]\\[]+=[^\\]\\[]+\\])?(\\.[^\\[\\].]+(\\[[^=\\]\\[]+=[^\\]\\[]+\\])?)*$"
_DOT_OUTSIDE = "\\.(?![^\\[\\]]*\\])"


def is_valid_path(path: Column) -> Column:
    return F.trim(path).rlike(VALID_PATH)


def path_segments(path: Column) -> Column:
    """Array of struct(field, key, value); key and value are null without a selector."""
    parts = F.split(F.trim(path), _DOT_OUTSIDE)

    # A part of a valid path has at most one pair of brackets, with a key up to the first equals sign in it.
    def segment(part: Column) -> Column:
        inside = F.substring_index(F.substring_index(part, "[", -1), "]", 1)
        selected = F.contains(part, F.lit("["))
        return F.struct(
            F.trim(F.substring_index(part, "[", 1)).alias("field"),
            F.when(selected, F.trim(F.substring_index(inside, "=", 1))).alias("key"),
            F.when(selected, F.trim(F.substring(inside, F.instr(inside, "=") + 1, F.length(inside)))).alias("value"),
        )

    return F.when(is_valid_path(path), F.transform(parts, segment))


def plain_path(path: Column) -> Column:
    """Path without selectors."""
    return F.trim(F.regexp_replace(path, "\\[[^\\]]*\\]", ""))


def path_selectors(path: Column) -> Column:
    """Sorted ``array.key=value`` entries of a path; the selector set used to match targets."""
    segments = path_segments(path)
    with_sel = F.filter(segments, lambda s: s["key"].isNotNull())
    return F.array_sort(F.transform(with_sel, lambda s: F.concat(s["key"], F.lit("="), s["value"])))


def terminal_field(path: Column) -> Column:
    return F.element_at(F.split(plain_path(path), "\\."), -1)


def json_at(payload: Column, path: Column | str) -> Column:
    """Text of a nested field by dotted path; null when any step is missing."""
    if isinstance(path, str):
        return F.get_json_object(payload, "$." + path)
    return F.expr("null") if path is None else F.try_variant_get(
        F.try_parse_json(payload), F.concat(F.lit("$."), path), "string"
    )
