"""Terms literally contained in texts (shared by D28, G3-G6, G9, G10, F13)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes of a dictionary that travels to the texts as an automaton; beyond it the gram index is used. Terms of a scope
# that travel with its texts.
TERM_BYTES, SCOPE_TERMS = 1 << 20, 256


def _grams(text: Column, width: int) -> Column:
    cut = F.length(text) - (width - 1)
    return F.when(
        cut > 0,
        F.array_distinct(F.transform(F.sequence(F.lit(1), cut), lambda i: F.substring(text, i, F.lit(width)))),
    ).otherwise(F.expr("cast(array() as array<string>)"))


def _term_finder(terms: list[str]) -> Callable[[Column], Column]:
    """Arrow function: the distinct terms a text holds, in one pass over the text whatever their number.

    All a worker needs is inside, so it runs where this package is not installed.
    """

    def find(texts: pa.Array) -> pa.Array:
        import ahocorasick

        machine = ahocorasick.Automaton()
        for n, term in enumerate(terms):
            machine.add_word(term, n)
        machine.make_automaton()
        found = [None if t is None else [terms[n] for n in {n for _, n in machine.iter(t)}] for t in texts.to_pylist()]
        return pa.array(found, pa.list_(pa.string()))

    # Marked so that the optimizer does not repeat it in a filter.
    return F.arrow_udf(find, "array<string>").asNondeterministic()


def literal_matches(
    texts: DataFrame, terms: DataFrame, keys: Sequence[str], *, scope: Sequence[str] = (), few: int = TERM_BYTES
) -> DataFrame:
    """Pairs ``(keys, scope, term)`` where the text holds the term as it is written.

    ``texts`` has ``text``, ``terms`` has ``term``; both should carry the same normal form.
    ``scope`` columns must agree (a file and its own anchors). A dictionary of at most ``few`` bytes is compiled into an
    automaton that reads each text once; terms of a scope travel with its texts as a short list. Others meet the texts
    through character grams: each term is filed under the gram of it that fewest terms have, texts offer those grams
    of theirs that terms are filed under, and only pairs that share one are compared. All ways give the same pairs.
    """
    keys, scope = list(keys), list(scope)
    wanted = terms.select(*scope, "term").where("term <> ''").distinct()
    slim = texts.select(*dict.fromkeys([*keys, *scope]), "text")
    out = list(dict.fromkeys([*keys, *scope]))
    if not scope and (wanted.agg(F.sum(F.octet_length("term").cast("long"))).first()[0] or 0) <= few:
        known = [r["term"] for r in wanted.collect()]
        if not known:
            return slim.where(F.lit(False)).select(*out, F.lit("").alias("term"))
        held = slim.select(*out, _term_finder(known)(F.col("text")).alias("_held"))
        return held.select(*out, F.explode_outer("_held").alias("term")).where("term is not null")
    if scope and few and wanted.groupBy(*scope).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > SCOPE_TERMS).isEmpty():
        packed = wanted.groupBy(*scope).agg(F.collect_list("term").alias("_terms"))
        held = F.explode_outer(F.filter("_terms", lambda t: F.col("text").contains(t)))  # outer: an inner one computes its array twice
        return slim.join(packed, scope).select(*out, held.alias("term")).where("term is not null")
    # Two-character terms and shorter are their own gram; longer ones use three characters.
    sized = wanted.withColumn(
        "_g", F.when(F.length("term") >= 3, _grams(F.col("term"), 3)).otherwise(F.array("term"))
    )
    posted = sized.select(*scope, "term", F.explode("_g").alias("_gram"))
    rarity = posted.groupBy("_gram").agg(F.count(F.lit(1)).alias("_df"))
    filed = posted.join(rarity, "_gram").groupBy(*scope, "term").agg(F.min_by("_gram", F.struct("_df", "_gram")).alias("_gram"))
    text_grams = F.concat(_grams(F.col("text"), 3), _grams(F.col("text"), 2), _grams(F.col("text"), 1))
    offered = slim.select(*out, F.explode_outer(text_grams).alias("_gram")).join(filed.select("_gram").distinct(), "_gram", "left_semi")
    pairs = offered.join(filed, [*scope, "_gram"]).select(*out, "term")
    return pairs.join(slim, out).where(F.col("text").contains(F.col("term"))).select(*out, "term")
