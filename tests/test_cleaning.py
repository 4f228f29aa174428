from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from registered import cleaning
from registered.inputs import CLEANING, HZ, SIGNALS
from registered.sql import CLEANED
from tests.oracle import over_series
from tidegrid.config import CleaningConfig
from tidegrid.operators import series
from tidegrid.operators.clean import clean_series
from tidegrid.operators.impute import gap_islands, impute_short_gaps, merge_runs
from tidegrid.operators.outliers import detect_outliers

ENGINES = ["sql", "arrow"]


def frame(spark, **columns):
    pdf = pd.DataFrame({"sid": 1, **columns})
    pdf["i"] = np.arange(len(pdf))
    return spark.createDataFrame(pdf)


@pytest.mark.parametrize("engine", ENGINES)
def test_single_spike_in_ones(spark, engine):
    v = np.ones(1000)
    v[500] = 100.0
    got = detect_outliers(frame(spark, v=v), ["sid"], ["i"], "v", engine=engine, block_rows=128)
    assert [r.i for r in got.where("is_outlier").collect()] == [500]


@pytest.mark.parametrize("engine", ENGINES)
def test_gaussian_noise_is_kept(spark, engine):
    v = np.random.default_rng(0).normal(0, 1, 1000)
    got = detect_outliers(frame(spark, v=v), ["sid"], ["i"], "v", engine=engine)
    assert got.where("is_outlier").count() < 10


@pytest.mark.parametrize("window", [11, 10])
def test_mask_does_not_change_with_engine_or_blocks(spark, window):
    rng = np.random.default_rng(3)
    v = rng.standard_t(2, 600)
    v[rng.random(600) < 0.1] = np.nan
    v[[77, 300]] = np.inf, 1e6
    masks = {
        tuple(r.i for r in detect_outliers(df, ["sid"], ["i"], "v", 4.0, window, engine, split_rows, block_rows)
              .where("is_outlier").orderBy("i").collect())
        for df in [frame(spark, v=v)]
        for engine in ENGINES
        for split_rows, block_rows in ((250_000, 16_384), (40, 32))
    }
    assert len(masks) == 1
    found = masks.pop()
    assert len(found) > 5 and 300 in found and not np.isnan(v[list(found)]).any()


@pytest.mark.parametrize("valid,flagged", [(100, 0), (101, 1)])
def test_guard_needs_a_full_window(spark, valid, flagged):
    v = np.full(300, np.nan)
    v[:valid] = 1.0
    v[50] = 9.0
    for engine in ENGINES:
        got = detect_outliers(
            frame(spark, v=v), ["sid"], ["i"], "v", engine=engine, split_rows=20, block_rows=64
        )
        assert got.where("is_outlier").count() == flagged


def test_short_gap_is_filled(spark):
    df = frame(spark, v=[1.0, 2.0, np.nan, np.nan, 5.0, 6.0])
    got = impute_short_gaps(df, ["sid"], ["i"], ["v"], 10).orderBy("i").toPandas()
    assert got.v.tolist() == [1, 2, 3, 4, 5, 6]


def test_long_gap_stays(spark):
    df = frame(spark, v=[1.0] + [np.nan] * 50 + [2.0])
    got = impute_short_gaps(df, ["sid"], ["i"], ["v"], 10)
    assert got.where("v is null").count() == 50


def test_fill_by_hand_at_edges_and_inside(spark):
    n = None
    series = {
        "edges": ([n, n, 4.0, 6.0, n], [4.0, 4.0, 4.0, 6.0, 6.0]),
        "limit": ([0.0, n, n, n, 8.0, n, n, n, n, 1.0], [0.0, 2.0, 4.0, 6.0, 8.0, n, n, n, n, 1.0]),
        "empty": ([n, n], [n, n]),
        "nearly": ([n, n, n, n, 5.0], [n, n, n, n, 5.0]),
        "whole": ([7.0], [7.0]),
    }
    rows = [(name, i, v) for name, (values, _) in series.items() for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "sid string, i int, v double")
    for block_rows, split_rows in ((16_384, 250_000), (4, 1)):
        got = impute_short_gaps(df, ["sid"], ["i"], ["v"], 3, split_rows=split_rows, block_rows=block_rows)
        have = {name: [r.v for r in got.where(F.col("sid") == name).orderBy("i").collect()] for name in series}
        assert have == {name: want for name, (_, want) in series.items()}


@pytest.mark.parametrize("block_rows,split_rows", [(16_384, 250_000), (9, 15)])
def test_filled_values_lie_between_their_neighbours(spark, block_rows, split_rows):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(6, 200))
    for row in v[1:]:
        for a in rng.integers(0, 200, 8):
            row[a : a + rng.integers(1, 12)] = np.nan
    rows = [(s, i, None if np.isnan(x) else float(x)) for s, row in enumerate(v) for i, x in enumerate(row)]
    df = spark.createDataFrame(rows, "sid int, i int, v double")
    got = {
        (r.sid, r.i): r.v
        for r in impute_short_gaps(df, ["sid"], ["i"], ["v"], 5, split_rows=split_rows, block_rows=block_rows).collect()
    }
    for s, row in enumerate(v):
        valid = [-1, *np.flatnonzero(~np.isnan(row)), 200]
        for a, b in zip(valid, valid[1:]):
            ends = [row[x] for x in (a, b) if 0 <= x < 200]
            inner = [got[s, i] for i in range(a + 1, b)]
            if b - a - 1 > 5:
                assert inner == [None] * (b - a - 1)
            else:
                assert all(min(ends) <= x <= max(ends) for x in inner)
                steps = np.diff([x for x in [row[a], *inner, row[b]]]) if len(ends) == 2 else [0]
                assert np.allclose(steps, steps[0])
    assert all(got[s, i] == row[i] for s, row in enumerate(v) for i in range(200) if not np.isnan(row[i]))


@pytest.mark.parametrize("block_rows", [16_384, 7])
def test_gap_islands(spark, block_rows):
    v = np.ones(60)
    v[[0, 1, 10]] = np.nan
    v[20:45] = np.nan
    v[48:56] = np.nan
    v[59] = np.nan
    got = gap_islands(frame(spark, v=v), ["sid"], ["i"], "v", 8, block_rows=block_rows)
    rows = sorted((r.gap_start, r.gap_end, r.gap_rows, r.is_short) for r in got.collect())
    assert rows == [(0, 1, 2, True), (10, 10, 1, True), (20, 44, 25, False), (48, 55, 8, True), (59, 59, 1, True)]


def messy_recordings(n_sids=4):
    """Irregular times, spikes, dead sensors, random gaps and a plateau of wrong values."""
    rng = np.random.default_rng(11)
    frames = []
    for sid in range(n_sids):
        n = int(rng.integers(150, 500))
        f = pd.DataFrame({"shot_id": sid, "time_s": np.sort(rng.uniform(0, 300, n)) / HZ, "src": np.arange(n)})
        for c in SIGNALS:
            v = rng.normal(1, 0.1, n)
            v[rng.integers(0, n, 6)] = 40
            v[rng.random(n) < 0.1] = np.nan
            f[c] = np.nan if rng.random() < 0.2 else v
        f.loc[n // 3 : n // 3 + 20, "loop_voltage"] = 500.0
        frames.append(f)
    return pd.concat(frames, ignore_index=True)


@pytest.mark.parametrize(
    "engine,split_rows,block_rows",
    [("arrow", 250_000, 16_384), ("sql", 250_000, 16_384), ("arrow", 40, 64), ("sql", 40, 64)],
)
def test_clean_equals_its_sql(spark, engine, split_rows, block_rows):
    raw = messy_recordings()
    config = replace(CLEANING, engine=engine, split_rows=split_rows, block_rows=block_rows)
    got = clean_series(spark.createDataFrame(raw), ["shot_id"], config, ["src"]).toPandas()
    want = over_series(raw, f"WITH {CLEANED} SELECT * FROM cleaned")
    got, want = (x.sort_values(["shot_id", ix], ignore_index=True) for x, ix in ((got, "_k"), (want, "k")))
    assert len(got) == len(want) > 500 and want.outlier_mask.astype(bool).sum() > 10
    assert (got.outlier_mask == want.outlier_mask).all()
    for c in ["time_s", *SIGNALS]:
        np.testing.assert_allclose(got[c].to_numpy(float), want[c].to_numpy(float), rtol=0, atol=1e-9)


def test_extra_columns(spark):
    df = frame(spark, time_s=[0.0, 0.1, 0.2], electron_density=[1.0, 2.0, 3.0], aux=[0.0, 1.0, 2.0])
    config = CleaningConfig(target_sampling_hz=10)
    assert "aux" not in clean_series(df, ["sid"], config).columns
    kept = clean_series(df.drop("i"), ["sid"], config, keep_extra=True).orderBy("_k").toPandas()
    assert kept.aux.tolist() == [0.0, 1.0, 2.0]


def test_row_order_queries_cut_series_into_small_blocks(spark, monkeypatch):
    cut = []
    monkeypatch.setattr(cleaning, "table", lambda *_: spark.range(4000).selectExpr(
        "id AS event_id", "'a' AS event_type", "timestamp_micros(id * 7919 % 4001) AS ts", "double(id % 50) AS value"))
    monkeypatch.setattr(cleaning, "type_series", lambda *_: cleaning.table().select("event_type", "ts", "event_id"))
    split = series.split_series
    monkeypatch.setattr(series, "split_series", lambda *a: cut.append(split(*a)) or cut[-1])
    for query in (cleaning.row_order, cleaning.row_order_odd):
        assert sorted(r.row_index for r in query(spark, "").collect()) == list(range(4000))
        rows, path = cut.pop()
        assert rows.select(*path).distinct().count() >= 30


@pytest.mark.parametrize("seed", range(3))
def test_runs_are_merged_over_blocks_of_every_size(spark, seed):
    """Blocks of 4 rows, then of 12, 36 and the whole series."""
    rng = np.random.default_rng(seed)
    parts, want = [], []
    for sid in range(6):
        missing = rng.random(400) < (0.3, 0.9, 0.99, 1.0, 0.0, 0.7)[sid]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], missing.astype(int), [0]])))
        for start, end in edges.reshape(-1, 2):
            want.append((sid, int(start), int(end) - 1))
            cuts = [start, *[b for b in range(4 * (start // 4) + 4, end, 4)], end]
            parts += [(sid, int(a), int(b) - 1) for a, b in zip(cuts, cuts[1:])]
    runs = spark.createDataFrame(parts, "sid long, gap_start long, gap_end long").repartition(3)
    got = merge_runs(runs, ["sid"], 4, merged=3)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_a_dead_series_of_a_billion_rows_is_one_gap(spark):
    blocks = spark.range(61_036).selectExpr("1 AS sid", "id * 16384 AS gap_start", "least(id * 16384 + 16383, 999999999) AS gap_end")
    assert [tuple(r) for r in merge_runs(blocks, ["sid"], 16_384, merged=64).collect()] == [(1, 0, 999_999_999)]
