"""Periodic runs of words through recompression (operator 12).

The words of a block of documents stand in one sequence, a separator of its own between each two documents. Block
compression replaces every maximal repeat of a symbol by one symbol, pair compression every symbol of a left class
followed by one of a right class; both name equal things equally. In turn they shorten the sequence until every
document is a single symbol: a run-length grammar whose parse depends on what stands nearby alone.

Two places that go on alike are therefore parsed alike but for their edges. A longest-common-extension query climbs
while its two places agree, a symbol or block at most a level, and comes down again along the first difference. Reading
the grammar from its end gives extensions to the left.

A run of period q and exponent 4 holds a place of every grid of step 3q. Grid places whose word, and that of a
neighbour, recur q words later are candidates; their extensions in both directions are the exact ends of the run.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections import defaultdict
from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provatab.llm.common import bytes_of, slices

# Shortest run in words and least exponent; text bytes that share a grammar; candidate places looked at together.
SHORTEST, EXPONENT, BLOCK_BYTES, PLACES = 6, 4, 2 << 20, 1 << 20


class Level(NamedTuple):
    """A sequence of symbols and how the next level is made from it (nothing of it at the last one)."""

    symbols: np.ndarray
    parents: np.ndarray  # index in the next level
    heads: np.ndarray  # True where a symbol is the first child
    firsts: np.ndarray  # first child of each symbol of the next level, and the number of symbols here
    blocks: bool  # block compression, else pair compression

    def mirrored(self) -> Level:
        if not len(self.parents):
            return self._replace(symbols=self.symbols[::-1])
        last = len(self.symbols) - self.firsts[::-1]
        heads = np.zeros(len(self.symbols), bool)
        heads[last[:-1]] = True
        return Level(self.symbols[::-1], (len(self.firsts) - 2 - self.parents)[::-1], heads, last, self.blocks)


# Odd multipliers that spread numbers over 64 bits.
SPREAD, MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9


def _bits(symbols: np.ndarray, turn: int) -> np.ndarray:
    x = (symbols.astype(np.uint64) + np.uint64(turn * SPREAD % (1 << 64))) * np.uint64(MIX)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(SPREAD)
    return (x >> np.uint64(63)).astype(bool)


NOTHING = np.zeros(0, np.int64)


def recompressed(symbols: np.ndarray, fixed: np.ndarray) -> list[Level]:
    """Levels of the grammar of ``symbols`` (below 2**31), until no two that are not ``fixed`` stand side by side."""
    levels, fresh, turn = [], int(symbols.max(initial=0)) + 1, 0
    while True:
        inner = ~fixed[1:] & ~fixed[:-1]
        if not inner.any():
            return [*levels, Level(symbols, NOTHING, NOTHING, NOTHING, False)]
        same = (symbols[1:] == symbols[:-1]) & inner
        blocks = bool(same.any())
        if blocks:
            joined = same
        else:
            # A symbol's class is a bit of its hash in this turn; the better way round of the two classes is taken.
            turn += 1
            side = _bits(symbols, turn)
            there, back = inner & ~side[:-1] & side[1:], inner & side[:-1] & ~side[1:]
            joined = there if there.sum() >= back.sum() else back
            if not joined.any():
                continue
        heads = np.concatenate([[True], ~joined])
        at = np.flatnonzero(heads)
        firsts = np.append(at, len(symbols))
        sizes = np.diff(firsts)
        up = symbols[at]
        many = np.flatnonzero(sizes > 1)
        key = up[many] << 32 | (sizes[many] if blocks else symbols[at[many] + 1])
        names, named = np.unique(key, return_inverse=True)
        up[many] = fresh + named
        fresh += len(names)
        levels.append(Level(symbols, np.cumsum(heads) - 1, heads, firsts, blocks))
        symbols, fixed = up, fixed[at]


def extensions(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many symbols from ``i`` on equal those from ``j`` on; ``i`` and ``j`` differ."""
    a, b = i.copy(), j.copy()
    stopped: list[np.ndarray] = []
    climbing = np.arange(len(i))
    for level in levels[:-1]:
        x, y = a[climbing], b[climbing]
        loose = np.flatnonzero(~(level.heads[x] & level.heads[y]))
        differ = np.zeros(len(climbing), bool)
        if len(loose):
            u, v = x[loose], y[loose]
            equal = level.symbols[u] == level.symbols[v]
            step = equal.astype(np.int64)
            if level.blocks:
                left, right = level.firsts[level.parents[u] + 1] - u, level.firsts[level.parents[v] + 1] - v
                step *= np.minimum(left, right)
                equal &= left == right
            x[loose], y[loose] = u + step, v + step
            differ[loose] = ~equal
        a[climbing], b[climbing] = x, y
        stopped.append(climbing[differ])
        climbing = climbing[~differ]
        a[climbing], b[climbing] = level.parents[a[climbing]], level.parents[b[climbing]]
    for level, more in zip(levels[-2::-1], stopped[::-1]):
        x, y = level.firsts[a[climbing]], level.firsts[b[climbing]]
        step = (level.symbols[x] == level.symbols[y]).astype(np.int64)
        if level.blocks:
            step *= np.minimum(level.firsts[level.parents[x] + 1] - x, level.firsts[level.parents[y] + 1] - y)
        a[climbing], b[climbing] = x + step, y + step
        climbing = np.concatenate([climbing, more])
    return a - i


# --- candidates and runs ------------------------------------------------------------------------


def _shares(n: int) -> Iterator[tuple[int, int]]:
    """Ranges of periods whose grids over ``n`` words have about ``PLACES`` places together."""
    low = 1
    while low * EXPONENT <= n:
        high, places = low, 0
        while high * EXPONENT <= n and (high == low or places < PLACES):
            places += n // ((EXPONENT - 1) * high) + 1
            high += 1
        yield low, high
        low = high


def _grid(n: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods of the grids for periods ``low`` to ``high - 1`` over ``n`` words."""
    periods = np.arange(low, high)
    steps = np.maximum(SHORTEST, EXPONENT * periods) - periods
    counts = -(-(n - periods) // steps)
    q = np.repeat(periods, counts)
    return (np.arange(len(q)) - np.repeat(np.cumsum(counts) - counts, counts)) * np.repeat(steps, counts), q


_small_grid = functools.lru_cache(maxsize=256)(_grid)


def candidates(words: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Grid places of which the word and that before or after it recur a period later."""
    n = len(words)
    i, q = (_small_grid if n <= 2_000 else _grid)(n, low, high)
    hit = np.flatnonzero(words[i] == words[i + q])
    i, q = i[hit], q[hit]
    before = (i > 0) & (words[i - 1] == words[i - 1 + q])
    ahead = np.minimum(i + 1, n - 1 - q)
    near = before | ((ahead > i) & (words[ahead] == words[ahead + q]))
    return i[near], q[near]


def _outside(i: np.ndarray, q: np.ndarray, runs: dict[tuple[int, int], int], n: int) -> np.ndarray:
    """False for places whose extension is that of a known run: the run holds them and its period divides theirs."""
    holder = np.full(n, -1)
    known = sorted(((b, a, p) for (a, b), p in runs.items()))
    for k, (b, a, _) in enumerate(known):
        holder[a:b] = k
    ends, periods = np.array([x[0] for x in known]), np.array([x[2] for x in known])
    at = holder[i]
    return (at < 0) | (i + q >= ends[at]) | (q % periods[at] != 0)


def all_runs(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Runs ``(start, length, period)`` of each sequence of word numbers (below 2**30), by start, then period."""
    found: list[dict[tuple[int, int], int]] = [{} for _ in texts]
    first = {}
    for k, words in enumerate(texts):
        for low, high in itertools.islice(_shares(len(words)), 1):
            i, q = candidates(words, low, high)
            if len(i) or high * EXPONENT <= len(words):
                first[k] = (i, q, high)
    if first:
        parts, bases, at = [np.array([1 << 30])], {}, 1
        for k in first:
            bases[k] = at
            parts += [texts[k], np.array([(1 << 30) + len(bases)])]
            at += len(texts[k]) + 1
        symbols = np.concatenate(parts)
        forward = recompressed(symbols, symbols >= 1 << 30)
        backward = [level.mirrored() for level in forward]

        def extend(i: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            ahead = extensions(forward, i, i + q)
            behind = extensions(backward, len(symbols) - i, len(symbols) - i - q)
            return i - behind, i + q + ahead

        def keep(k: np.ndarray, i: np.ndarray, q: np.ndarray) -> None:
            base = np.array([bases[x] for x in k.tolist()], np.int64)
            start, stop = extend(i + base, q)
            good = stop - start >= np.maximum(SHORTEST, EXPONENT * q)
            for x, a, b, p in zip(k[good].tolist(), (start - base)[good].tolist(), (stop - base)[good].tolist(), q[good].tolist()):
                found[x][a, b] = min(p, found[x].get((a, b), p))

        counts = [len(i) for i, _, _ in first.values()]
        keep(np.repeat(np.array(list(first)), counts), np.concatenate([i for i, _, _ in first.values()]), np.concatenate([q for _, q, _ in first.values()]))
        for k in first:
            for low, high in itertools.islice(_shares(len(texts[k])), 1, None):
                i, q = candidates(texts[k], low, high)
                if found[k]:
                    new = _outside(i, q, found[k], len(texts[k]))
                    i, q = i[new], q[new]
                keep(np.full(len(i), k), i, q)
    return [sorted(((a, b - a, p) for (a, b), p in f.items()), key=lambda r: (r[0], r[2])) for f in found]


def repeated_order(n: int, seed: int | None) -> np.ndarray | None:
    """Word numbers of a text of ``n`` words that its seed makes periodic (None: it stays as it is)."""
    if not n or seed is None or seed % 10:
        return None
    g = seed // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


def run_rows(docs: DataFrame, *, planted: bool = False) -> DataFrame:
    """Per row: ``doc_id``, ``text`` (its words joined by one blank, without what repeats the first period of a run)
    and ``runs``, an array of ``start, length, period`` in word numbers, by start, then period.

    A null, empty or blank text has no words and no runs. Repeated rows each give their own; a null id stays null.
    With ``planted`` the words of every document whose crc32 of the id ends in 0 are made periodic first
    (:func:`repeated_order`); a row without an id is left as it is. Other columns are not read.
    """
    kind = dict(docs.dtypes)["doc_id"]
    seed = F.crc32(F.col("doc_id").cast("string")) if planted else F.lit(None).cast("long")
    runs_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BLOCK_BYTES):
            number = defaultdict(itertools.count().__next__)
            split, numbers = [], []
            for text, s in zip(bytes_of(batch), batch.column("_seed").to_pylist()):
                words = text.split()
                coded = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
                order = repeated_order(len(words), s)
                if order is not None:
                    words, coded = [words[k] for k in order.tolist()], coded[order]
                split.append(words)
                numbers.append(coded)
            runs = all_runs(numbers)
            kept = []
            for words, own in zip(split, runs):
                if own:
                    edge = np.zeros(len(words) + 1, np.int64)
                    for start, length, period in own:
                        edge[start + period] += 1
                        edge[start + length] -= 1
                    words = [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                kept.append(b" ".join(words))
            listed = [[{"start": a, "length": n, "period": p} for a, n, p in own] for own in runs]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(listed, runs_type)], names=["doc_id", "text", "runs"]
            )

    own = docs.select("doc_id", "text", seed.alias("_seed"))
    return own.mapInArrow(work, f"doc_id {kind}, text string, runs array<struct<start: bigint, length: bigint, period: bigint>>")


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest exact length over period; ties go to the smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def run_digests(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``n_runs``, ``start``, ``length``, ``period`` and ``exponent_milli`` of its strongest run
    (null without one), ``runs_sha256`` over all runs and ``collapsed_sha256`` over the words that stay.

    Nulls, empty texts and repeated rows as in :func:`run_rows`, with planted repeats.
    """
    found = run_rows(docs, planted=True)
    best = F.get(
        F.array_sort(
            "runs",
            lambda x, y: F.when(x["length"] * y["period"] != y["length"] * x["period"], F.signum(y["length"] * x["period"] - x["length"] * y["period"]))
            .when(x["start"] != y["start"], F.signum(x["start"] - y["start"]))
            .otherwise(F.signum(x["period"] - y["period"]))
            .cast("int"),
        ),
        F.lit(0),
    )
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    shown = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))
    return shown.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("best.length * 1000 div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )


SQL = r"""
WITH RECURSIVE split AS (
  SELECT row_number() OVER () AS r, doc_id, CAST(doc_id AS VARCHAR) AS s,
    coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), seeded AS (
  SELECT r, doc_id, w, len(w) AS n,
    xor(list_reduce(
      list_prepend(4294967295::UBIGINT, list_transform(range(1, length(s) + 1), lambda k: ascii(s[k])::UBIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
        lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)), 4294967295::UBIGINT)::BIGINT AS h
  FROM split
), placed AS (
  SELECT *, h % 10 = 0 AND n > 0 AS planted, CASE WHEN n > 0 THEN (h // 10) % n END AS a, h // 10 AS g FROM seeded
), numbered AS (
  SELECT r, n, planted, a, 1 + (n - a) // (3 + g % 8) AS p, w, unnest(range(0, n)) AS i FROM placed
), words AS (
  SELECT r, n, i, w[1 + CASE WHEN planted AND i >= a THEN a + (i - a) % p ELSE i END] AS v FROM numbered
), matches AS (
  SELECT x.r, y.i - x.i AS q, x.i FROM words x JOIN words y ON x.r = y.r AND x.v = y.v AND y.i > x.i AND (y.i - x.i) * 4 <= x.n
), islands AS (
  SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island
  FROM (SELECT *, count(*) OVER (PARTITION BY r, q) AS c FROM matches) WHERE c >= greatest(5, 3 * q)
), stretches AS (
  SELECT r, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY r, q, island HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (
  SELECT r, start, length, min(q) AS period FROM stretches GROUP BY r, start, length
), digests AS (
  SELECT r, count(*) AS n_runs, sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS runs_sha256
  FROM runs GROUP BY r
), best AS (
  SELECT r, start, length, period FROM runs
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY length::DOUBLE / period DESC, start, period) = 1
), dropped AS (
  SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs
), collapsed AS (
  SELECT r, sha256(string_agg(v, ' ' ORDER BY i)) AS collapsed_sha256 FROM words ANTI JOIN dropped USING (r, i) GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
  (1000 * length // period)::BIGINT AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256, coalesce(collapsed_sha256, sha256('')) AS collapsed_sha256
FROM split LEFT JOIN digests USING (r) LEFT JOIN best USING (r) LEFT JOIN collapsed USING (r)
"""
