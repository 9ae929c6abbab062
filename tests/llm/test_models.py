"""Classifiers by held-out accuracy and on awkward rows; decoding on disguised words."""

import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from provatab.llm import quality, toxicity
from provatab.llm.common import held_out

SF = "/root/testdata/sf0.01"


def accuracy(rows, label):
    return np.mean([r.predicted == r[label] for r in rows])


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    assert len(rows) > 50 and accuracy(rows, "quality") > 0.97


def test_quality_hashes_alike_in_any_block(monkeypatch):
    texts = [b"", b"one two two", "é ! one two".encode(), b"x " * 700, b"\n\n", b"y" * 900]
    small = quality.Hasher()
    flat, ends = small.buckets(texts)
    for i, t in enumerate(texts):
        alone, _ = quality.Hasher().buckets([t])
        assert sorted(flat[ends[i] : ends[i + 1]]) == sorted(alone)
    assert ends[1] == 0 and ends[2] - ends[1] == 3 + 2 + 1


def test_quality_of_awkward_rows(spark, awkward, empty, labels):
    odd = labels.unionByName(spark.createDataFrame([(None, 1, None), (1, None, 7), (2, 3, 1), (4, 0, 0), (4, 1, 1)], labels.schema))
    weights = quality.train(awkward, odd)
    rows = quality.score(awkward, weights).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.quality_scores(empty, labels).count() == 0
    assert quality.quality_scores(awkward, labels.where(F.lit(False))).where("score = 0.5").count() == len(rows)
    kept = quality.keep_good(awkward, odd)
    assert kept.columns == awkward.columns


def test_ftrl_learns_a_rule():
    rng, model = np.random.default_rng(1), quality.Ftrl(20)
    for _ in range(3000):
        x = rng.integers(0, 2, 20)
        at = np.flatnonzero(x)
        if len(at):
            model.update(at, np.ones(len(at)), int(x[3] and not x[5]))
    w = model.weights()
    assert w[3] == w.max() and w[5] == w.min()


def english_costs():
    counts = np.full((28, 28, 28), 0.1)
    words = "stupid idiot trash moron loser scum the and with that this from have idle tram more lose".split()
    for w in words:
        seq = [0, 0, *(ord(c) - 96 for c in w), 0]
        for a, b, c in zip(seq, seq[1:], seq[2:]):
            counts[a, b, c] += 5
    return -np.log(counts / counts.sum(axis=2, keepdims=True))


def test_disguises_are_decoded():
    decoder = toxicity.Decoder(english_costs())
    for token, word in {
        "1d10t": "idiot", "5tup1d": "stupid", "tr@sh!!": "trash", "m0r0n,": "moron", "l0$er": "loser", "s.c.u.m": "scum", "stuuuupid": "stupid",
        "$cum": "scum", "TRASH###": "trash", "i-d-i-o-t": "idiot", "tr*sh": "trash", "plain": "plain",
    }.items():
        assert word in decoder.restored(token), (token, decoder.restored(token))
    assert decoder.restored("***") == () and decoder.restored("2023") == ("2023",) and "idiot" in toxicity.tokens("see i d i o t here")
    assert "idiot" in toxicity.tokens("a i d i o t")


def plain_viterbi(token, costs):
    """Every path of the lattice."""
    paths = [("", 0.0)]
    for ways in toxicity.lattice(token):
        paths = [(p + t, c + own) for p, c in paths for t, own in ways]

    def total(p, c):
        seq = [0, 0, *(toxicity._class_of(x) for x in p), 0]
        return c + sum(costs[a, b, d] for a, b, d in zip(seq, seq[1:], seq[2:]))

    return min(total(p, c) for p, c in paths), {p: total(p, c) for p, c in paths}


def test_viterbi_is_the_cheapest_path():
    costs = english_costs()
    for token in ("1d10t", "st00p1d", "l0$$er", "|oo5er", "aab*b", "x1!1y"):
        best, all_ = plain_viterbi(token, costs)
        assert math.isclose(all_[toxicity.viterbi(token, costs)], best)


def test_toxicity(spark, awkward, empty):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.toxicity_scores(docs, labels).join(labels, "doc_id").collect()
    rows = [r for r in scored if r.held_out]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out for r in scored)
    assert accuracy(rows, "toxic") > 0.95 and np.mean([r.predicted for r in rows if r.toxic == 0]) < 0.05
    costs = toxicity.letter_model(docs)
    evidence = toxicity.learn(docs, labels, costs)
    bad = "Anarer ha the with of and 1d10t , onerst heha tr@sh and st.u.p.i.d ing thereonly"
    more = awkward.select("doc_id", "text").unionByName(spark.createDataFrame([(77, bad), (78, "Anarer ha the with of and onerst heha")], "doc_id long, text string"))
    got = {(r.doc_id, r.text): r for r in toxicity.score(more, costs, evidence, restored=True).collect()}
    assert got[77, bad].score > 0.5 and "trash" in got[77, bad].restored
    assert all(r.score < 0.5 and not r.restored for (i, _), r in got.items() if i != 77)
    assert toxicity.toxicity_scores(empty, labels).count() == 0
    assert toxicity.toxicity_scores(awkward, labels.where(F.lit(False))).where("predicted = 0").count() == awkward.count()


def test_held_out_rows(spark):
    df = spark.range(200).select(held_out(F.col("id"), 3, 1).alias("h"), "id")
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in df.collect())
