"""Toxicity after noisy-channel deobfuscation (operator 1).

A token that may hide a word (signs or digits among its letters, letters repeated three times or more, single letters
spaced out) becomes a lattice: each sign may stand for some letters or for nothing, each run of a letter for one or two
of it. The Viterbi path under the channel's costs and a trigram model of letters, counted over all documents, is the
restored word. A doubled letter alone is decoded only where the shorter word is one that scores, since every other
decoding would score nothing.

What scores are beginnings of restored words and whole words. Labelled documents give the pieces of evidence: the one
that best tells toxic documents not yet explained comes first. A document's distinct words are then weighed by how much
more often toxic documents have a word of their piece, and all other words by how much less often, so a stray word
counts less in a long document than in a short one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provatab.cluster import broadcast_if_small
from provatab.llm.common import Kept, held_out, slices, texts_of, written
from provatab.llm.quality import labelled_sample

# Labelled rows learned from (half of each label at most), shortest and longest beginning of a word that is evidence,
# toxic documents that evidence needs (and the share of all of them), how many times as often toxic documents must
# have it, log likelihood ratio beyond chance, greatest weight of a word, words a worker keeps, twice.
ROWS, SHORT, LONG, LEAST, SHARE, TIMES, SURPRISE, MOST, KEPT = 8_000, 3, 8, 3, 0.004, 8.0, 16.0, 7.0, 200_000

# Fixed values of the channel: letters a sign may stand for, and costs (negative log probabilities) of standing for a
# letter, for nothing, of a letter written more often than meant, and of a doubled letter that is meant.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
    "*": "aeiou", "#": "aeiou",
}
SIGN, NOTHING, REPEATED, DOUBLE = 1.0, 12.0, 1.5, 0.7
# Letters of the model: none (edges of words), a to z, any other letter.
EDGE, OTHER, SIZE = 0, 27, 28

_CLASS = np.zeros(256, np.int64)
for _c in range(26):
    _CLASS[ord("a") + _c] = _CLASS[ord("A") + _c] = _c + 1
_CLASS[0xC0:] = OTHER  # first byte of a letter beyond ASCII
_AROUND = ".,;:!?¿¡\"'()[]{}<>«»“”‘’…*#%&~^=+/\\|_-$@"
_LETTER_RUN = re.compile(r"([^\W\d_])\1{2,}")
_DOUBLE = re.compile(r"([^\W\d_])\1")
_SPACED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")


def letter_model(docs: DataFrame) -> np.ndarray:
    """Costs (28, 28, 28) of a letter after two others, from trigram counts over all whole texts.

    Counts are added up by the executors; the driver gets one row for each trigram that occurs, 21,952 at most.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SIZE**3, np.int64)
        for batch in slices(batches, "text", 2 << 20):
            data = np.frombuffer("\n".join(texts_of(batch)).encode(), np.uint8)
            letters = _CLASS[data[(data < 0x80) | (data >= 0xC0)]]
            letters = np.concatenate([[EDGE, EDGE], letters, [EDGE]])
            # Words begin after two edges, however they are parted.
            letters = np.insert(letters, np.flatnonzero((letters[1:] == EDGE) & (letters[:-1] != EDGE)) + 1, EDGE)
            counts += np.bincount((letters[:-2] * SIZE + letters[1:-1]) * SIZE + letters[2:], minlength=SIZE**3)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["at", "n"])

    rows = docs.select("text").mapInArrow(work, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    counts = np.full(SIZE**3, 0.1)
    for r in rows:
        counts[r["at"]] += r["n"]
    counts = counts.reshape(SIZE, SIZE, SIZE)
    return -np.log(counts / counts.sum(axis=2, keepdims=True))


def _class_of(letter: str) -> int:
    return ord(letter) - 96 if "a" <= letter <= "z" else OTHER


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """Per sign or run of a letter, the letters it may stand for and what each costs."""
    out: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(token):
        c = token[i]
        j = i + 1
        while j < len(token) and token[j] == c:
            j += 1
        n = j - i
        if c.isalpha():
            # Ways to write the letter once, twice, and as it stands.
            ways = {c: 0.0 if n == 1 else REPEATED}
            if n > 1:
                ways[c * 2] = DOUBLE if n == 2 else REPEATED
            out.append(list(ways.items()))
        else:
            stands = [(x, SIGN) for x in STANDS_FOR.get(c, "")]
            doubled = [(x * 2, SIGN + DOUBLE) for x in STANDS_FOR.get(c, "")] if n > 1 else []
            # Marks that only part letters cost less than a digit that is left out.
            out.append([*stands, *doubled, ("", NOTHING if c in STANDS_FOR else 0.1)])
        i = j
    return out


def viterbi(token: str, costs: np.ndarray) -> str:
    """The cheapest word of the token's lattice under the channel and the letter model; ties to the smaller word."""
    best: dict[tuple[int, int], tuple[float, tuple]] = {(EDGE, EDGE): (0.0, ())}
    for ways in lattice(token):
        after: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (cost, path) in best.items():
            for text, own in ways:
                total, x, y = cost + own, a, b
                for letter in text:
                    k = _class_of(letter)
                    total += costs[x, y, k]
                    x, y = y, k
                state = (x, y)
                known = after.get(state)
                if known is None or total < known[0]:
                    after[state] = (total, (path, text) if text else path)
        best = after
    cost, path = min(((c + costs[a, b, EDGE], p) for (a, b), (c, p) in best.items()), key=lambda x: x[0])
    letters = []
    while path:
        path, text = path
        letters.append(text)
    return "".join(reversed(letters))


def squeezed(word: str) -> str:
    return _DOUBLE.sub(r"\1", _LETTER_RUN.sub(r"\1", word))


def bare(token: str) -> str:
    """Lower-cased without marks around it. A sign that can stand for a letter stays where it stands alone at an end."""
    word = token.lower().strip("﻿​")
    for _ in range(2):
        inner = word.strip(_AROUND)
        if not inner:
            return ""
        at = word.index(inner)
        before, behind = word[:at], word[at + len(inner) :]
        # One sign, next to the word, that isn't a usual mark of writing: part of the word ("$cum", "@ss").
        keep_before = before[-1:] if before[-1:] in "$@|+(" and before[-2:-1] != before[-1:] else ""
        keep_behind = behind[:1] if behind[:1] in "$@|+" and behind[1:2] != behind[:1] else ""
        word = keep_before + inner + keep_behind
        break
    return word


def hides(word: str) -> bool:
    """Whether the word may be another one in disguise: signs or digits among letters, or a letter three times."""
    if word.isalpha():
        return bool(_LETTER_RUN.search(word))
    return any(c.isalpha() for c in word) and any(not c.isalpha() and not c.isspace() for c in word)


def tokens(text: str) -> set[str]:
    """What stands between white space, and letters spaced out taken together."""
    found = set(text.split())
    if _SPACED.search(text):
        runs = {re.sub(r"\s", "", m.group()) for m in _SPACED.finditer(text)}
        # A word of one letter may stand before or behind a spaced word.
        found |= runs | {r[1:] for r in runs if len(r) > 4} | {r[:-1] for r in runs if len(r) > 4}
    return found


@dataclass
class Decoder:
    """Restored words of tokens; the longest tokens are cut at the marks that part words."""

    costs: np.ndarray
    kept: Kept = field(default_factory=lambda: Kept(KEPT))

    def restored(self, token: str) -> tuple[str, ...]:
        word = bare(token)
        if not word:
            return ()
        if not hides(word):
            return (word,)
        # Marks may part two words, part the letters of one, or stand for letters; digits at an end may be a number.
        readings = [word, re.sub(r"[^\w]|_", "", word), word.strip("0123456789"), *re.split(r"[-/.,;:|=_+]+", word)]
        found = [viterbi(r, self.costs) if hides(r) else r for r in dict.fromkeys(readings) if len(r) > 1 and any(map(str.isalpha, r))]
        return tuple(dict.fromkeys(w for w in found if w))


def evidence_of(word: str) -> list[str]:
    """Beginnings of a word, and the word with an end mark."""
    return [word[:k] for k in range(SHORT, min(LONG, len(word)) + 1)] + [word + "$"] if len(word) >= SHORT else []


@dataclass
class Evidence:
    """weights: of pieces; neutral: of any other word; prior: of a document."""

    weights: dict[str, float]
    neutral: float
    prior: float


def word_pieces(sample: DataFrame, costs: np.ndarray) -> DataFrame:
    """Per document and piece how many of its distinct restored words have it; the piece '' stands for all words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(costs)
        kept = Kept(KEPT // 4, lambda t: tuple((w, evidence_of(w)) for w in decoder.restored(t)))
        for batch in slices(batches, "text", 1 << 20):
            for i, text in enumerate(texts_of(batch)):
                words = {w: e for t in tokens(text) for w, e in kept[t]}
                found = Counter(x for e in words.values() for x in e)
                found[""] = len(words)
                n = len(found)
                row = pa.array([i] * n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(row), batch.column("y").take(row), pa.array(list(found)), pa.array(list(found.values()), pa.int64())],
                    names=["doc_id", "y", "piece", "n"],
                )

    return sample.mapInArrow(work, f"doc_id {dict(sample.dtypes)['doc_id']}, y int, piece string, n long")


def learn(docs: DataFrame, labels: DataFrame, costs: np.ndarray, *, folds: int = 5, fold: int = 0, rows: int = ROWS) -> Evidence:
    """Evidence from a bounded sample of labelled rows.

    Executors count the pieces over the sample; the driver gets those that enough toxic documents have and clean ones
    seldom have, with their toxic documents: no more than the sample has. Without rows of both labels nothing scores.
    """
    sample = written(labelled_sample(docs, labels, "toxic", folds=folds, fold=fold, rows=rows), "toxic-sample")
    toxic = F.col("y") == 1
    counted = word_pieces(sample, costs).groupBy("piece").agg(
        F.coalesce(F.sum(F.when(toxic, F.col("n"))), F.lit(0)).alias("t_words"),
        F.coalesce(F.sum(F.when(~toxic, F.col("n"))), F.lit(0)).alias("c_words"),
        F.count(F.when(toxic, 1)).alias("t_docs"),
        F.count(F.when(~toxic, 1)).alias("c_docs"),
    )
    counted = written(counted, "toxic-pieces")
    total = counted.where(F.col("piece") == "").first()
    if total is None or not total["t_docs"] or not total["c_docs"]:
        return Evidence({}, 0.0, -10.0)
    least = max(LEAST, int(SHARE * total["t_docs"]))
    rate = total["c_words"] / max(1, total["t_words"])
    strong = counted.where((F.col("piece") != "") & (F.col("t_docs") >= least) & (F.col("t_words") * rate >= (F.col("c_words") + 0.5) * TIMES))
    strong = written(strong, "toxic-strong")
    with_docs = word_pieces(sample.where(toxic), costs).join(broadcast_if_small(strong.select("piece"), 200_000), "piece")
    of = {}
    for r in with_docs.select("piece", "doc_id").toArrow().to_pylist():
        of.setdefault(r["piece"], set()).add(r["doc_id"])
    usable = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"), folds, fold)).groupBy("toxic").count()
    shares = {r["toxic"]: r["count"] for r in usable.collect()}
    return weighed([(r, of.get(r["piece"], set())) for r in strong.collect()], total, least, math.log(shares[1] / shares[0]))


def surprise(row, total) -> float:
    """Log likelihood ratio of the document counts of a piece against no relation with the label."""
    t, c, share = row["t_docs"], row["c_docs"], total["t_docs"] / (total["t_docs"] + total["c_docs"])
    return t * math.log(t / ((t + c) * share)) + (c * math.log(c / ((t + c) * (1 - share))) if c else 0.0)


def weighed(strong: list, total, least: int, prior: float) -> Evidence:
    """Pieces that can't be chance; then, for documents they leave unexplained, pieces by how large a share of the toxic documents they explain anew, less the share of clean ones that have them
    (of equals the longer, then the smaller), until none explains ``least`` more; and their weights."""
    # A beginning goes where a longer one holds for most of its documents and is as telling.
    own = {r["piece"]: (r["t_docs"], (r["t_words"] + 0.5) / (r["c_words"] + 0.5)) for r, _ in strong}
    vague = {q[:k] for q, (docs, ratio) in own.items() for k in range(SHORT, len(q)) if q[:k] in own and docs >= 0.7 * own[q[:k]][0] and ratio >= 0.999 * own[q[:k]][1]}
    strong = [x for x in strong if x[0]["piece"] not in vague]
    chosen = [r for r, _ in strong if surprise(r, total) >= SURPRISE]
    covered = {x for r, docs in strong if surprise(r, total) >= SURPRISE for x in docs}
    strong = [x for x in strong if surprise(x[0], total) < SURPRISE]
    left = {x for _, docs in strong for x in docs} - covered
    while strong:
        gain = [(len(docs & left) / total["t_docs"] - r["c_docs"] / total["c_docs"], len(r["piece"])) for r, docs in strong]
        best = min(range(len(strong)), key=lambda i: (-gain[i][0], -gain[i][1], strong[i][0]["piece"]))
        if len(strong[best][1] & left) < least or gain[best][0] <= 0:
            break
        row, docs = strong.pop(best)
        chosen.append(row)
        left -= docs
        strong = [x for x in strong if len(x[1] & left) >= least]
    t_all, c_all = total["t_words"] + 1, total["c_words"] + 1
    weights = {r["piece"]: min(MOST, math.log((r["t_words"] + 0.5) / t_all) - math.log((r["c_words"] + 0.5) / c_all)) for r in chosen}
    t_rest = 1 - sum(r["t_words"] for r in chosen) / t_all
    c_rest = 1 - sum(r["c_words"] for r in chosen) / c_all
    return Evidence(weights, math.log(max(t_rest, 0.1)) - math.log(max(c_rest, 0.1)), prior)


def score(docs: DataFrame, costs: np.ndarray, evidence: Evidence, *, restored: bool = False) -> DataFrame:
    """``docs`` plus ``score``, 0 to 1, and, if asked for, ``restored``: the distinct words that scored.

    Null and empty texts have the score of the prior. Other columns stay; ones of those names are replaced.
    """
    kept_columns = docs.drop("score", "restored")
    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kept_columns.schema]
    model = docs.sparkSession.sparkContext.broadcast((costs, evidence))  # 0.2 MB and the chosen pieces

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_costs, own = model.value
        decoder = Decoder(model_costs)
        # Pieces as they are, and with doubled letters taken once, for words that have doubled letters or were restored.
        exact = dict(sorted(own.weights.items()))
        single = {squeezed(p): w for p, w in exact.items()}

        def of_word(word: str, pieces: dict[str, float]) -> float:
            return max([pieces[e] for e in evidence_of(word) if e in pieces], default=0.0)

        def of_token(token: str) -> tuple[float, str]:
            best = (0.0, "")
            for word in decoder.restored(token):
                weight = of_word(word, exact)
                if not weight and (_DOUBLE.search(word) or hides(token)):
                    weight = of_word(squeezed(word), single)
                best = max(best, (weight, word))
            return best

        kept = Kept(KEPT, of_token)
        for batch in slices(batches, "text"):
            margins, words = [], []
            for text in texts_of(batch):
                found = tokens(text)
                distinct = {w: v for v, w in map(kept.__getitem__, found) if v}
                margins.append(own.prior + math.fsum(distinct.values()) + own.neutral * (len(found) - len(distinct)))
                words.append(sorted(distinct))
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            columns["score"] = pa.array(1 / (1 + np.exp(-np.clip(np.array(margins, float), -500, 500))))
            if restored:
                columns["restored"] = pa.array(words, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    return kept_columns.mapInArrow(work, ", ".join([*fields, "score double" + ", restored array<string>" * restored]))


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, folds: int = 5, fold: int = 0) -> DataFrame:
    """Per document: whether it was held out, its score, and the label predicted at 0.5."""
    costs = letter_model(docs)
    scored = score(docs.select("doc_id", "text"), costs, learn(docs, labels, costs, folds=folds, fold=fold))
    return scored.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
