"""Benchmark items inside documents by prefix-filter sketches (operator 7).

Only DataFrame functions. Each item has a sketch by its own size, which replaces partitions by size: ``class`` is only
reported and no join uses it. The sketch of an item with m shingles holds its k = m - ceil(threshold * m) + 1 smallest
shingle hashes: a document that contains at least ``threshold`` of the m shingles can miss k - 1 of them at most, so it has a hash of the sketch, whatever its own
size. (Sketches of one fixed length, as for sets of similar size, lose short items in long documents.) A document too
small for an item isn't paired with it. Documents that meet an item are verified on exact shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provatab.cluster import broadcast_if_small
from provatab.llm.common import text_key, written

# What stands between words: anything but letters and digits, so that punctuation and layout don't hide a passage.
BETWEEN = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; none for null and empty texts."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN), lambda w: w != "")


def _slices(found: Column, width: int, make) -> Column:
    """``make`` of each run of ``width`` words; of the whole sequence if it is shorter; none without words.

    The words are bound once as a lambda's argument, since an expression named inside another lambda would be computed
    again for each run.
    """

    def cut(w: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(w) - (width - 1), F.lit(1))), lambda _: F.size(w) > 0)
        return F.transform(starts, lambda i: make(F.slice(w, i, F.lit(width))))

    return F.transform(F.array(found), cut)[0]


def shingles(found: Column, width: int) -> Column:
    return _slices(found, width, lambda s: F.array_join(s, " "))


def shingle_hashes(found: Column, width: int) -> Column:
    return _slices(found, width, F.xxhash64)


def item_sketches(items: DataFrame, *, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """``item_id``, ``class``, ``needed`` (shingles a document must share), ``h``: the MinHash sketch, a row per hash.

    Items without words have no row. Rows that repeat an id are items of their own, told apart by their text.
    """
    own = items.select("item_id", text_key(F.col("text")).alias("_item_key"), F.array_distinct(shingle_hashes(words(F.col("text")), width)).alias("hashes")).distinct()
    m = F.size("hashes")
    needed = F.ceil(m * F.lit(threshold) - F.lit(1e-9)).cast("int")
    sized = own.where(m > 0).select("item_id", "_item_key", F.floor(F.log2(m)).cast("int").alias("class"), needed.alias("needed"), F.array_sort("hashes").alias("hashes"))
    sketch = F.slice("hashes", F.lit(1), F.size("hashes") - F.col("needed") + 1)
    return sized.select("item_id", "_item_key", "class", "needed", F.explode(sketch).alias("h"))


def candidates(docs: DataFrame, items: DataFrame, *, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """Pairs of a document and an item that share a hash of the item's sketch."""
    sketches = written(item_sketches(items, width=width, threshold=threshold), "item-sketches")
    # A document has no more shingles than its text has characters; one too small for an item isn't paired with it.
    own = docs.select("doc_id", text_key(F.col("text")).alias("_text_key"), shingle_hashes(words(F.col("text")), width).alias("hashes"))
    hashed = own.select("doc_id", "_text_key", F.size("hashes").alias("n"), F.explode("hashes").alias("h"))
    met = hashed.join(broadcast_if_small(sketches, 200_000), "h").where(F.col("n") >= F.col("needed"))
    return met.select("doc_id", "_text_key", "item_id", "_item_key").distinct()


def contained_items(docs: DataFrame, items: DataFrame, *, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_shared``, ``n_shingles``, ``containment``: each item of whose distinct shingles a
    document has at least ``threshold``.

    Texts are words lower-cased without what stands between them; shingles take ``width`` words, a shorter text is one
    shingle, a text without words matches nothing. Rows of equal id and text give one row; where rows of one id differ
    in text, their best match counts.
    """
    pairs = written(candidates(docs, items, width=width, threshold=threshold), "leak-candidates")
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("_text_key"), F.coalesce("text", F.lit("")).alias("text"))
    marked = broadcast_if_small(pairs.withColumnsRenamed({"doc_id": "_id", "_text_key": "_key"}), 100_000)
    met = keyed.join(marked, keyed["doc_id"].eqNullSafe(marked["_id"]) & (keyed["_text_key"] == marked["_key"]))
    asked = items.select(F.col("item_id").alias("_item"), text_key(F.col("text")).alias("_of"), F.array_distinct(shingles(words(F.col("text")), width)).alias("asked")).distinct()
    asked = broadcast_if_small(written(asked, "item-shingles"), 50_000)
    both = met.join(asked, met["item_id"].eqNullSafe(asked["_item"]) & (met["_item_key"] == asked["_of"]))
    shared = F.size(F.array_intersect("asked", shingles(words(F.col("text")), width)))
    found = both.select("doc_id", "item_id", shared.cast("long").alias("n_shared"), F.size("asked").cast("long").alias("n_shingles"))
    found = found.withColumn("containment", F.col("n_shared") / F.col("n_shingles")).where(F.col("n_shared") >= F.ceil(F.col("n_shingles") * F.lit(threshold) - F.lit(1e-9)))
    best = F.max(F.struct("containment", "n_shared", "n_shingles"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("_best")).select("doc_id", "item_id", "_best.n_shared", "_best.n_shingles", "_best.containment")


def without_leaks(docs: DataFrame, items: DataFrame, *, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """``docs`` without the documents that contain an item. Ids are compared null-safely."""
    leaks = contained_items(docs, items, width=width, threshold=threshold).select(F.col("doc_id").alias("_leak")).distinct()
    leaks = broadcast_if_small(written(leaks, "leaks"), 1_000_000)
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["_leak"]), "left_anti")


SQL = r"""
with doc_words as (
  select doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') as w from documents
),
item_words as (
  select item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') as w from benchmark
),
doc_shingles as (
  select distinct doc_id, unnest(list_transform(generate_series(1, greatest(len(w) - 4, 1)), lambda i: array_to_string(w[i:i + 4], ' '))) as s from doc_words where len(w) > 0
),
item_shingles as (
  select distinct item_id, unnest(list_transform(generate_series(1, greatest(len(w) - 4, 1)), lambda i: array_to_string(w[i:i + 4], ' '))) as s from item_words where len(w) > 0
),
sizes as (select item_id, count(*) as n_shingles from item_shingles group by item_id),
shared as (select doc_id, item_id, count(*) as n_shared from doc_shingles join item_shingles using (s) group by doc_id, item_id)
select doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles as containment
from shared join sizes using (item_id)
where n_shared >= ceil(n_shingles * 0.8 - 1e-9)
"""
