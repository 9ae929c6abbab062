"""Line dedup, SimHash components and benchmark containment against plain walks."""

import re
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from provatab.llm import decontamination, line_dedup, simhash

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def line_key(line):
    return line.translate(UPPER).strip(" \t\n\x0b\x0c\r")


def expected_lines(rows, least):
    of = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            of[line_key(x)].add(i)
    out = []
    for i, t in rows:
        kept = [x for x in (t or "").split("\n") if not line_key(x) or len(of[line_key(x)]) < least]
        out.append((i, len((t or "").split("\n")), len((t or "").split("\n")) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_lines(spark, awkward, empty):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    for least in (2, 10, 13):
        done = line_dedup.drop_shared_lines(awkward, min_docs=least)
        got = [(r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in done.collect()]
        assert sorted(got, key=repr) == expected_lines(rows, least)
        assert set(awkward.columns) <= set(done.columns)
    assert line_dedup.drop_shared_lines(empty).count() == 0


def test_a_hot_line_over_many_partitions(spark):
    """A third of all lines are one line, so its run is cut by many borders; rare lines sit at borders too."""
    rows = [(i, f"hot\nrare {i // 3}\npair {i // 9}\nten {i // 10}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in line_dedup.drop_shared_lines(docs, min_docs=10).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(got, key=repr) == expected_lines(rows, 10)


def plain_print(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=4):
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    flat = np.array(sorted(parent), np.uint64)
    for p in flat:
        for q in flat[np.bitwise_count(flat ^ p) <= distance]:
            parent[root(int(p))] = root(int(q))
    return {p: root(p) for p in parent}


def test_components(spark, awkward, empty, documents):
    for docs in (awkward, documents):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        prints = [plain_print(t) for _, t in rows]
        root = plain_components(prints)
        least = {}
        for (i, _), p in zip(rows, prints):
            if i is not None:
                least[root[p]] = min(i, least.get(root[p], i))
        want = sorted(((i, f"{p:016x}", least.get(root[p])) for (i, _), p in zip(rows, prints)), key=repr)
        assert sorted(map(tuple, simhash.component_rows(docs).collect()), key=repr) == want
        kept = simhash.keep_one(docs)
        assert kept.columns == docs.columns and kept.count() == len(set(root.values()))
    assert simhash.component_rows(empty).count() == 0


def test_forest_over_blocks_joins_what_all_pairs_join(spark):
    """A chain and a dense group, in meetings larger than a block."""
    rng = np.random.default_rng(3)
    base = int(rng.integers(1 << 62))
    dense = {base ^ sum(1 << int(b) for b in rng.choice(12, rng.integers(0, 5), replace=False)) for _ in range(300)}
    chain = [base ^ (((1 << (4 * k)) - 1) << 12) for k in range(1, 12)]
    prints = sorted(dense | set(chain) | {int(x) for x in rng.integers(1 << 62, size=200)})
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    got = {r.node: r.root for r in simhash.components(simhash.links(df, distance=4, block=16)).collect()}
    want = plain_components(prints)
    groups = lambda of: {frozenset(p for p in prints if of.get(p, p) == r) for r in {of.get(p, p) for p in prints}}
    assert groups(got) == groups(want)


def test_segments_differ_by_one_bit_at_most():
    for d in range(0, 9):
        cut = simhash.segments(d)
        assert sum(size for _, size in cut) == 64 and len(cut) * 2 > d and (len(cut) - 1) * 2 <= d


def plain_containment(docs, items):
    def shingles(text):
        words = re.findall(r"[^\W_]+", (text or "").lower())
        return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    out = {}
    for i, t in docs:
        own = shingles(t)
        for j, u in items:
            asked = shingles(u)
            n = len(asked & own)
            if asked and n * 5 >= 4 * len(asked):
                out[i, j] = max(out.get((i, j), (0.0, 0)), (n / len(asked), n))
    return sorted(((i, j, n, c) for (i, j), (c, n) in out.items()), key=repr)


def test_containment(spark, awkward, empty):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    more = [
        (100, "Noise, before it: " + text.upper() + " and noise behind"), (101, text.replace("sixteen", "other")), (102, text.replace("eight", "other")),
        (103, "four five six seven eight"), (104, "hello"), (104, text), (None, text),
    ]
    docs = awkward.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    rows = [(1, text), (1, text), (2, text + " extra"), (3, "hello"), (4, ""), (5, None), (None, text), (6, "four five six seven eight"), (7, "word1 of the long line 1 word2 of the long")]
    items = spark.createDataFrame(rows, "item_id long, text string")
    got = [(r.doc_id, r.item_id, r.n_shared, r.containment) for r in decontamination.contained_items(docs, items).collect()]
    want = plain_containment([(r.doc_id, r.text) for r in docs.collect()], rows)
    assert sorted(got, key=repr) == want
    leaks = {i for i, *_ in want}
    kept = decontamination.without_leaks(docs, items)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - leaks
    assert decontamination.contained_items(empty, items).count() == 0
    assert decontamination.contained_items(docs, items.where(F.lit(False))).count() == 0
    assert decontamination.without_leaks(docs, items.where(F.lit(False))).count() == docs.count()


def test_variants_are_not_sent_out_by_estimate(spark):
    """Spark's estimate has not the 64 variants that are made of each fingerprint, so it took them for a small table."""
    links = simhash.links(spark.range(300).select(F.col("id").alias("fingerprint")))
    plan = links._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=merge") == len(re.findall(r"\bJoin [A-Z]", plan)) == 1
