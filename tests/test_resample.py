import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from registered.inputs import HZ, SIGNALS
from registered.sql import RESAMPLED
from tests.oracle import over_series
from tidegrid.operators import series
from tidegrid.operators.resample import BLOCK_RANGE, grid_segments, resample_to_grid
from tidegrid.operators.series import split_series, with_row_index


def random_series(rng, sid):
    n = int(rng.integers(1, 120))
    kind = rng.integers(0, 4)
    t = np.sort(rng.uniform(0, 3, n)) + rng.uniform(-2, 1000)
    if kind == 0:
        t = np.round(t, 1)  # duplicate times
    if kind == 1:
        t = np.arange(n) * 0.01
    if kind == 2 and n > 10:
        t[n // 2 :] += 10  # a long hole
    a = rng.normal(size=n)
    b = rng.normal(size=n)
    a[rng.random(n) < 0.3] = np.nan
    b[rng.random(n) < 0.9] = np.nan
    return pd.DataFrame({"sid": sid, "t": t, "src": np.arange(n), "a": a, "b": b})


def on_grid(spark, df, split_rows=250_000, block_rows=16_384):
    got = resample_to_grid(df, ["sid"], "t", ["a", "b"], 50, tie=["src"], split_rows=split_rows, block_rows=block_rows)
    return got.toPandas().sort_values(["sid", "_k"], ignore_index=True)


@pytest.fixture(scope="module")
def many(spark):
    rng = np.random.default_rng(5)
    frames = [random_series(rng, s) for s in range(40)]
    df = spark.createDataFrame(pd.concat(frames))
    return frames, df, on_grid(spark, df)


def test_grid_and_lines_of_random_series(many):
    """Even steps from the first to the last time; every value on the line between its neighbours."""
    frames, _, got = many
    for f in frames:
        have = got[got.sid == f.sid.iloc[0]]
        f = f.sort_values(["t", "src"])
        first, last = f.t.iloc[0], f.t.iloc[-1]
        assert have._k.tolist() == list(range(len(have))) and abs(len(have) - 1 - (last - first) * 50) <= 0.5
        assert have.t.iloc[0] == first and (len(have) == 1 or have.t.iloc[-1] == last)
        assert np.allclose(np.diff(have.t), (last - first) / max(len(have) - 1, 1), atol=1e-9)
        for c in ("a", "b"):
            points = f[["t", c]].dropna()
            if f[c].count() < 2:
                assert have[c].isna().all()
                continue
            for x, y in zip(have.t, have[c]):
                left, right = points[points.t <= x].tail(1), points[points.t > x].head(1)
                if left.empty or right.empty:
                    assert y == (right if left.empty else left)[c].iloc[0]
                    continue
                share = (x - left.t.iloc[0]) / (right.t.iloc[0] - left.t.iloc[0])
                assert y == pytest.approx((1 - share) * left[c].iloc[0] + share * right[c].iloc[0], abs=1e-7)


@pytest.mark.parametrize("split_rows,block_rows", [(7, 16), (25, 5)])
def test_grid_does_not_change_with_blocks(spark, many, split_rows, block_rows):
    _, df, want = many
    pd.testing.assert_frame_equal(on_grid(spark, df, split_rows, block_rows), want)


def test_grid_equals_its_sql(spark):
    rng = np.random.default_rng(9)
    raw = pd.DataFrame({"shot_id": rng.integers(0, 5, 300), "time_s": rng.uniform(0, 90, 300) / HZ})
    for c in SIGNALS:
        raw[c] = np.where(rng.random(300) < 0.3, np.nan, rng.normal(size=300))
    got = resample_to_grid(spark.createDataFrame(raw), ["shot_id"], "time_s", SIGNALS, HZ).toPandas()
    want = over_series(raw, f"WITH {RESAMPLED} SELECT shot_id, k, x, signal, v FROM resampled")
    long = got.melt(["shot_id", "_k", "time_s"], SIGNALS, "signal", "value").merge(
        want, left_on=["shot_id", "_k", "signal"], right_on=["shot_id", "k", "signal"]
    )
    assert len(long) == len(want) == 4 * len(got)
    np.testing.assert_allclose(long.time_s, long.x, rtol=1e-12)
    np.testing.assert_allclose(long.value.astype(float), long.v.astype(float), rtol=0, atol=1e-9)


def test_uniform_spacing(spark):
    df = spark.createDataFrame(
        [(1, t, float(i)) for i, t in enumerate([0.0, 0.003, 0.007, 0.012, 0.020], 1)],
        "sid int, t double, x double",
    )
    got = resample_to_grid(df, ["sid"], "t", ["x"], 1000).toPandas().sort_values("_k")
    assert len(got) == 21
    gaps = np.diff(got.t)
    assert np.allclose(gaps, gaps[0])


def test_infinite_points_follow_interp(spark):
    t = np.array([0.0, 1.0, 2.0, 3.0])
    v = np.array([1.0, np.inf, 3.0, 4.0])
    df = spark.createDataFrame(pd.DataFrame({"sid": 1, "t": t, "v": v}))
    got = resample_to_grid(df, ["sid"], "t", ["v"], 2).toPandas().sort_values("_k")
    assert got.v.tolist() == [1.0, np.inf, np.inf, np.inf, 3.0, 3.5, 4.0]


def test_empty_and_null_time(spark):
    rows = [(1, None, 1.0), (1, float("inf"), 1.0), (1, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "sid int, t double, v double")
    assert resample_to_grid(df, ["sid"], "t", ["v"], 10).count() == 0


@pytest.mark.parametrize("split_rows", [250_000, 10, 3])
def test_row_index_of_bursty_and_tied_series(spark, split_rows):
    rng = np.random.default_rng(1)
    hot = pd.DataFrame({"sid": "hot", "t": np.r_[rng.uniform(0, 1e-6, 400), np.full(300, 5.0), [1e9]]})
    cold = pd.DataFrame({"sid": rng.choice(list("abc"), 30), "t": rng.uniform(0, 1, 30)})
    pdf = pd.concat([hot, cold], ignore_index=True)
    pdf["id"] = rng.permutation(len(pdf))
    pdf["v"] = np.where(pdf.id % 3 == 0, np.nan, 1.0)
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    got = with_row_index(df, ["sid"], ["t", "id"], count_valid=["v"], split_rows=split_rows).toPandas()
    pdf = pdf.sort_values(["sid", "t", "id"])
    pdf["_i"] = pdf.groupby("sid").cumcount()
    pdf["_valid_v"] = pdf.groupby("sid").v.transform("count")
    merged = got.merge(pdf, on="id")
    assert len(merged) == len(pdf)
    assert (merged._i_x == merged._i_y).all()
    assert (merged._valid_v_x == merged._valid_v_y).all()


def test_more_long_series_than_may_be_listed(spark, many, monkeypatch):
    def unlisted(df, max_rows=0):
        return df, None if df.limit(1).collect() else 0

    monkeypatch.setattr("tidegrid.operators.series.broadcast_if_small", unlisted)
    frames, df, want = many
    pd.testing.assert_frame_equal(on_grid(spark, df, 9, 32), want)
    indexed = with_row_index(df, ["sid"], ["t", "src"], count_valid=["a"], split_rows=9).toPandas()
    for f in frames:
        rows = indexed[indexed.sid == f.sid.iloc[0]].sort_values("src")
        assert rows._i.tolist() == list(range(len(f)))


def test_small_blocks_share_tasks(spark, monkeypatch):
    """Tasks follow the rows: 500 blocks are not 500 tasks."""
    written, write = [], series.materialize
    monkeypatch.setattr(series, "materialize", lambda *a: written.append(write(*a)) or written[-1])
    df = spark.range(4000).selectExpr("id % 3 AS sid", "id * 7919 % 4001 AS t", "id")
    cut, path = split_series(df, ["sid"], ["t", "id"], split_rows=8)
    assert len(written.pop().inputFiles()) <= 4
    sizes = cut.groupBy("sid", *path).agg(F.count("*").alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi")).collect()
    assert max(r.n for r in sizes) <= 8 and 500 <= len(sizes) <= 520
    blocks = sorted((r.sid, r[path[0]], r.lo, r.hi) for r in sizes)
    assert all(a[3] < b[2] for a, b in zip(blocks, blocks[1:]) if a[0] == b[0])  # blocks are in order
    numbered = with_row_index(df, ["sid"], ["t", "id"], split_rows=8).orderBy("sid", "t").collect()
    assert [r._i for r in numbered] == [i for n in (1334, 1333, 1333) for i in range(n)]


@pytest.mark.parametrize("kind,values", [
    ("double", [None, float("-inf"), float("inf"), float("nan"), 0.0, 1e300, 5e-324]),
    ("string", [None, "", "ä", "zz", "a" * 1000]),
    ("timestamp", [None, "2024-01-01", "1900-01-01"]),
    ("long", [None, -(2**63), 2**63 - 1, 7]),
])
def test_row_index_does_not_depend_on_splitting(spark, kind, values):
    """Missing, infinite and textual order values, and a series without a key."""
    rng = np.random.default_rng(2)
    rows = [(["hot", None, "cold"][int(k)], values[int(rng.integers(len(values)))], i)
            for i, k in enumerate(rng.choice(3, 900, p=[0.6, 0.3, 0.1]))]
    df = spark.createDataFrame([(k, None if v is None else str(v), i) for k, v, i in rows], "sid string, text string, id int")
    df = df.withColumn("v", F.col("text").cast(kind)).drop("text")
    whole, path = split_series(df, ["sid"], ["v", "id"])
    assert path == []
    cut, path = split_series(df, ["sid"], ["v", "id"], split_rows=20)
    assert path == ["_blk0"] and cut.count() == 900
    sizes = [r["count"] for r in cut.where("_blk0 is not null").groupBy("sid", "_blk0").count().collect()]
    assert max(sizes) <= 80
    indices = [
        {r.id: (r._i, r._valid_v) for r in with_row_index(df, ["sid"], ["v", "id"], count_valid=["v"], split_rows=n).collect()}
        for n in (250_000, 20)
    ]
    assert indices[0] == indices[1]


def test_a_hole_of_a_billion_points_is_named_in_short_arrays(spark):
    rows = spark.createDataFrame([(1, 0.0, 1.0), (1, 1e6, 2.0)], "sid long, t double, a double")
    segments = grid_segments(rows, ["sid"], "t", ["a"], 1000.0, halo=200)
    got = segments.agg(F.count("*"), F.min("_lo"), F.max("_hi"), F.sum(F.col("_hi") - F.col("_lo") + 1), F.count_distinct("_b")).first()
    blocks = 1_000_000_001 // 16_384 + 1
    assert got[1] == 0 and got[2] == 1_000_000_000 and got[4] == blocks
    assert got[0] == blocks + 1  # the last row stands in the last block and its halo
    assert 1_000_000_001 + 2 * 200 * (blocks - 1) == got[3]
    plan = segments._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode(sequence(") == 2 and str(BLOCK_RANGE) in plan
