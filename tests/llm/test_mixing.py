import random

import pytest
from pyspark.sql import functions as F

from tidegrid.llm.mixing import by_length, mix_sources, source_targets, word_count


def water(sizes, weights=(1, 2, 3), cap=3):
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in stopped]
        left = total - sum(stopped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = {s: cap * sizes[s] for s in rest if share[s] > cap * sizes[s] * (1 + 1e-12)}
        if not over:
            return stopped | share
        stopped |= over


@pytest.mark.parametrize("seed", range(6))
def test_targets_equal_repeated_sharing(spark, seed):
    rng = random.Random(seed)
    names = [None, "a", "B", "é", "z", "aa", "", "ü", "c", "d"][: rng.randrange(1, 11)]
    sizes = {s: rng.choice([0, 1, 5, 1000, 40_000]) for s in names}
    rows = [(s, v) for s, v in sizes.items()] + [(s, None) for s in names]
    got = {r.source: r for r in source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    want = water(sizes)
    assert {s: r.source_size for s, r in got.items()} == sizes
    assert {s: r.target for s, r in got.items()} == pytest.approx(want)


def documents(spark, n=900):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "a", "a", "a", "b", None, "c"]), rng.choice([0, 1, 3, 9, 40, 300, 2000])) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, source string, size long")


def test_taken_words_meet_the_targets(spark):
    rows = mix_sources(documents(spark), ["doc_id"]).collect()
    assert len(rows) == 900
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    for group in by.values():
        target, rate = group[0].target, group[0].target / group[0].source_size
        assert target * 0.995 <= sum(r.copies * r.size for r in group) <= target * 1.005
        assert all(int(rate) <= r.copies <= min(3, int(rate) + 1) for r in group)
        assert all(r.source_size == sum(x.size for x in group) for r in group)


def test_a_large_document_may_take_the_place_of_others(spark):
    """Without the large document of source b its words can't be reached."""
    rows = [(i, "a", 10) for i in range(400)] + [(1000 + i, "b", 5) for i in range(100)] + [(2000, "b", 500), (3000, "c", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long")
    for seed in range(3):
        by = {}
        for r in mix_sources(docs, ["doc_id"], seed=seed).collect():
            by.setdefault(r.source, []).append(r)
        for group in by.values():
            whole = int(group[0].target / group[0].source_size)
            assert abs(sum(r.copies * r.size for r in group) - group[0].target) <= 5
            assert all(whole <= r.copies <= min(3, whole + 1) for r in group)


def test_reruns_agree_and_seeds_differ(spark):
    docs = documents(spark)

    def taken(df, **options):
        return {r.doc_id: r.copies for r in mix_sources(df, ["doc_id"], **options).collect()}

    first = taken(docs)
    assert taken(docs.repartition(7)) == first
    assert taken(docs, seed=1) != first


def test_inclusion_makes_documents_likelier(spark):
    docs = documents(spark, 2000).withColumn("likes", F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0)).where("size = 9")
    rows = mix_sources(docs, ["doc_id"], inclusion=F.col("likes")).collect()
    copies = {s: [sum(r.copies for r in rows if r.source == s and r.doc_id % 2 == k) for k in (0, 1)] for s in ("a", "b", "c")}
    assert all(odd <= even for even, odd in copies.values())
    assert any(2 * odd < even for even, odd in copies.values())


@pytest.mark.parametrize("seed", range(4))
def test_unequal_inclusion_meets_the_targets(spark, seed):
    """Also where the likeliest documents come as often as they may."""
    rng = random.Random(seed)
    rows = [(i, rng.choice("aaabcd"), rng.choice([1, 4, 20, 90, 700]), rng.choice([0.5, 1.0, 2.0, 16.0])) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long, likes double")
    by = {}
    for r in mix_sources(docs, ["doc_id"], inclusion=F.col("likes"), seed=seed).collect():
        by.setdefault(r.source, []).append(r)
    targets = water({s: sum(r.size for r in g) for s, g in by.items()})
    for source, group in by.items():
        assert group[0].target == pytest.approx(targets[source])
        assert abs(sum(r.copies * r.size for r in group) - targets[source]) <= max(0.005 * targets[source], 700)
        low, high = 0.0, 1e9
        for _ in range(200):
            rate = (low + high) / 2
            reached = sum(min(3, r.likes * rate) * r.size for r in group) >= targets[source]
            low, high = (low, rate) if reached else (rate, high)
        assert sum(int(min(3, r.likes * rate) + 1e-9) <= r.copies <= int(min(3, r.likes * rate) + 1) for r in group) >= len(group) - 3


def test_usual_lengths_are_likelier(spark):
    sizes = [1, 49, 50, 5_000, 5_001]
    got = spark.createDataFrame([(s,) for s in sizes], "size long").select(by_length(F.col("size")).alias("odds")).collect()
    assert [r.odds for r in got] == [1.0, 1.0, 2.0, 2.0, 1.0]


def test_order_of_the_sample_is_pareto(spark):
    """With one source half of which is taken, those of the smallest u / (1 - u) * (1 - p) / p are in."""
    docs = spark.createDataFrame([(i, "a", 1) for i in range(300)] + [(1000 + i, "b", 1) for i in range(300)], "doc_id long, source string, size long")
    rows = mix_sources(docs, ["doc_id"]).withColumn("u", F.shiftrightunsigned(F.xxhash64(F.lit(20240229), "doc_id"), 11))
    a = sorted((r.u, r.copies) for r in rows.where("source = 'a'").collect())
    assert [c for _, c in a] == [1] * 200 + [0] * 100


def test_odd_rows(spark):
    schema = "doc_id long, source string, size long, _size string, copies string"
    rows = [(None, None, None, "x", "y"), (None, None, 5, "x", "y"), (1, "", 0, None, None), (1, "", 0, None, None), (2, "s", 4, "p", "q"), (2, "s", 4, "p", "q")]
    got = mix_sources(spark.createDataFrame(rows, schema), ["doc_id"])
    assert sorted(got.columns) == sorted(["doc_id", "source", "size", "_size", "copies", "source_size", "target"])
    assert got.count() == 6 and {r["_size"] for r in got.collect()} == {"x", "p", None}
    assert mix_sources(spark.createDataFrame([], schema), ["doc_id"]).count() == 0


def test_words_are_runs_of_anything_but_spaces(spark):
    texts = ["", None, "a", " a\tb\n\x0bc\x0c\rd ", "no break", "ä ö", "x" * 50_000]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(word_count(F.col("t")).alias("n")).collect()
    assert [r.n for r in got] == [0, 0, 1, 4, 1, 2, 1]
