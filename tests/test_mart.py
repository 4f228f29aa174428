import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.test_enrichment import pulse
from tests.test_ingestion import write_shot
from tidegrid.config import SIGNAL_COLUMNS, MartConfig
from tidegrid.plans import ml, reports
from tidegrid.plans.build import build_mart
from tidegrid.sinks import mart as sink
from tidegrid.sources import mart as source
from tidegrid.sources.registry import CURRENT_UNITS, NAMING_SCHEMES


DIMENSION = "shot_id long, operator string, machine_config string, quality_flag string, overall_completeness double, declared_disruption boolean, disruption_detected boolean, disruption_time_detected_s double"


def meta_frame(spark):
    """Five recordings, two of them with a declared and detected event."""
    rows = [
        (1, "Mia", "A", "OK", 0.985, False, False, None),
        (2, "Noor", "B", "OK", 1.0, True, True, 0.5),
        (3, "Mia", "A", "OK", 0.99, False, False, None),
        (4, "Mia", "B", "OK", 0.995, True, True, 0.0),
        (5, "Noor", None, "DEGRADED", 0.95, False, False, None),
    ]
    table = spark.createDataFrame(rows, DIMENSION)
    sensors = {"plasma_current": 1.0, "density": 0.98, "temperature": 0.99, "vloop": 1.0}
    return table.withColumns({f"completeness_{s}": F.lit(v) for s, v in sensors.items()})


def signals_frame(spark, n=5, points=100):
    """Recordings 1 to ``n``, whose signals tell recording and point."""
    rows = spark.range(n * points).selectExpr(f"id div {points} + 1 AS shot_id", f"(id % {points}) / 64 AS time_s")
    return rows.withColumns({s: F.col("shot_id") * 10.0 + j + F.col("time_s") for j, s in enumerate(SIGNAL_COLUMNS)})


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("mart"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # show the spread
    paths = sink.write_mart(meta_frame(spark), signals_frame(spark), MartConfig(path, file_rows=10), "2026-01-01T00:00:00+00:00")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert all(os.path.exists(p) for p in paths.values())
    return path


def test_round_trip(spark, mart):
    back = source.read_metadata(spark, mart)
    assert back.columns == meta_frame(spark).columns and back.count() == 5
    facts = source.read_signals(spark, mart)
    assert facts.count() == 500 and dict(facts.dtypes)["shot_id"] == "bigint"


def test_one_directory_per_shot(mart):
    folders = [d for d in os.listdir(f"{mart}/signals") if d.startswith("shot_id=")]
    assert sorted(folders) == [f"shot_id={i}" for i in range(1, 6)]
    files = [f for f in os.listdir(f"{mart}/signals/shot_id=1") if f.endswith(".parquet")]
    assert len(files) > 1  # a long recording is written by several tasks


def test_pruned_read(spark, mart):
    facts = source.read_signals(spark, mart, [2, 4])
    assert {r.shot_id for r in facts.select("shot_id").distinct().collect()} == {2, 4}
    assert facts.count() == 200
    assert all("shot_id=2/" in f or "shot_id=4/" in f for f in facts.inputFiles())
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [shot_id" in plan
    assert source.read_signals(spark, mart, []).count() == 0
    assert source.read_signals(spark, mart, [2, 77]).count() == 100
    assert source.read_signals(spark, mart, range(2, 5000)).count() == 400


def test_shared_directories(spark, tmp_path):
    config = MartConfig(str(tmp_path), shots_per_directory=2)
    sink.write_mart(meta_frame(spark), signals_frame(spark), config)
    folders = sorted(d for d in os.listdir(tmp_path / "signals") if "=" in d)
    assert folders == ["shots_by_2=0", "shots_by_2=1", "shots_by_2=2"]
    facts = source.read_signals(spark, str(tmp_path), [2, 4])
    assert facts.count() == 200 and facts.columns == source.read_signals(spark, str(tmp_path)).columns
    assert not any("shots_by_2=0" in f for f in facts.inputFiles())
    assert source.read_signals(spark, str(tmp_path)).count() == 500
    assert source.read_signals(spark, str(tmp_path), [99]).count() == 0
    chosen = source.select_signals(spark, str(tmp_path), "quality_flag = 'OK' and declared_disruption")
    assert chosen.count() == 200
    assert "dynamicpruning" in chosen._jdf.queryExecution().toString().lower()
    assert source.read_manifest(spark, str(tmp_path))["tables"]["signals"]["partitioning"] == "shots_by_2"
    with pytest.raises(ValueError):
        sink.write_signals(signals_frame(spark), MartConfig(str(tmp_path), overwrite=False, shots_per_directory=2))


def test_dimension_driven_selection(spark, mart):
    for condition in ("quality_flag = 'OK' and declared_disruption", "declared_disruption"):
        facts = source.select_signals(spark, mart, condition)
        assert {r.shot_id for r in facts.select("shot_id").distinct().collect()} == {2, 4}
        assert "dynamicpruning" in facts._jdf.queryExecution().toString().lower()


def test_overwrite_modes(spark, tmp_path):
    config = MartConfig(str(tmp_path), compression="zstd", overwrite=False)
    sink.write_signals(signals_frame(spark, 3), config)
    sink.write_signals(signals_frame(spark, 5).where("shot_id = 2").limit(7), config)
    counts = {r.shot_id: r["count"] for r in source.read_signals(spark, str(tmp_path)).groupBy("shot_id").count().collect()}
    assert counts == {1: 100, 2: 7, 3: 100}
    sink.write_signals(signals_frame(spark, 1), MartConfig(str(tmp_path)))
    assert os.listdir(f"{tmp_path}/signals").count("shot_id=2") == 0


def test_manifest(spark, mart, tmp_path):
    m = source.read_manifest(spark, mart)
    assert m["statistics"]["total_shots"] == 5 and m["statistics"]["quality_flags"] == {"OK": 4, "DEGRADED": 1}
    assert m["statistics"]["disruption_rate_declared"] == 0.4 and m["created_at_utc"].startswith("2026")
    assert set(m["tables"]) == {"metadata", "signals"} and m["pipeline_version"]
    bare = sink.manifest(meta_frame(spark).select("shot_id").limit(0))
    assert bare["statistics"]["mean_completeness"] is None and bare["tables"]["metadata"]["columns"] == []


def test_size_and_views(spark, mart):
    assert source.mart_size_mb(spark, mart) > 0
    source.register_views(spark, mart)
    assert spark.sql("select count(*) from signals join metadata using (shot_id) where quality_flag = 'OK'").first()[0] == 400


def test_report_tables(spark, mart):
    meta, facts = source.read_metadata(spark, mart), source.read_signals(spark, mart)
    assert [tuple(r) for r in reports.flag_distribution(meta).collect()] == [("OK", 4), ("DEGRADED", 1)]
    assert {r.sensor: round(r.mean_completeness_pct, 6) for r in reports.sensor_completeness(meta).collect()}["density"] == 98.0
    rates = {r.machine_config: (r.n_events, r.n_shots, r.rate_pct) for r in reports.rate_by_group(meta).collect()}
    assert rates == {"A": (0, 2, 0.0), "B": (2, 2, 100.0)}
    bins = {r.bin: r.n for r in reports.completeness_histogram(meta).collect()}
    assert bins[30] == 1 and sum(bins.values()) == 5 and bins[1] == 1
    assert [tuple(r)[0] for r in reports.histogram(meta, F.lit(3.0)).collect()] == [1]
    assert reports.histogram(meta.limit(0), F.lit(3.0)).count() == 0


def test_shot_reports(spark, mart, tmp_path):
    meta, facts = source.read_metadata(spark, mart), source.read_signals(spark, mart)
    assert [r.shot_id for r in reports.event_markers(meta).collect()] == [2]
    detail = reports.shot_detail(facts, meta, 2)
    assert detail.count() == 400 and detail.first().event_time_s == 0.5
    assert reports.shot_detail(facts, meta, 4).first().event_time_s is None
    assert reports.shot_detail(facts, meta, 99).count() == 0
    rows = reports.comparison(facts, meta, [4, 1, 77]).collect()
    assert [r.shot_id for r in rows][::100] == [4, 1]
    assert rows[0].label == "Shot 4 (OK, disrupt)" and rows[0].colour == "#2ca02c"
    assert reports.default_shot(meta).first().shot_id == 2
    assert reports.default_shot(meta.withColumn("declared_disruption", F.lit(False))).first().shot_id == 1
    assert [r.shot_id for r in reports.first_disrupted(meta).collect()] == [2, 4]
    paths = reports.write_standard_reports(spark, mart, str(tmp_path))
    assert len(paths) == 6 and all(os.path.exists(p) for p in paths.values())


def test_build_from_raw(spark, tmp_path):
    """All layouts, one recording that is kept out, and a column beyond the canonical ones."""
    layouts = [(naming, unit) for naming in NAMING_SCHEMES for unit in CURRENT_UNITS]
    for sid, (naming, unit) in enumerate(layouts, 1):
        f = pulse(sid, falls_at=1.5 if sid in (2, 5) else None).drop(columns="shot_id")
        f["plasma_current_MA"] /= CURRENT_UNITS[unit]
        f.loc[700, "electron_density"] = -7e3
        f.columns = NAMING_SCHEMES[naming]
        f["probe"] = np.arange(len(f)) / 8
        write_shot(tmp_path / "raw", sid, naming, unit, ("csv", "json")[sid % 2], f, meta={"disruption": sid in (2, 5)})
    write_shot(tmp_path / "raw", 40, unit="kA", frame=f)
    path = str(tmp_path / "out")
    out = build_mart(spark, str(tmp_path / "raw"), MartConfig(path), processed_at="2026-01-01T00:00:00+00:00", extra_columns=["probe"])
    assert [r.error[:14] for r in out.errors.collect()] == ["unknown schema"]
    assert out.verification["n_shots"] == 6 and out.verification["sample_points"] == 3 * 3000
    assert out.verification["signal_columns"] == ["time_s", *SIGNAL_COLUMNS, "probe", "shot_id"]
    for r in source.read_metadata(spark, path).collect():
        falls = r.shot_id in (2, 5)
        assert r.declared_disruption == r.disruption_detected == falls
        assert r.disruption_time_detected_s == (1.5 if falls else None)
        assert r.quality_flag == "OK" and r.outliers_density >= 1 and abs(r.plasma_current_max_MA - 1.2) < 1e-3
    facts = source.read_signals(spark, path, [3])
    assert facts.agg(F.max("probe")).first()[0] == pytest.approx(2999 / 8)
    assert source.select_signals(spark, path, "declared_disruption").columns == facts.columns
    files = [f for f in os.listdir(f"{path}/signals/shot_id=3") if f.endswith(".parquet")]
    assert len(files) == 1


def test_named_columns_must_be_there(spark, mart):
    assert source.read_signals(spark, mart, [1], ["time_s"]).columns == ["time_s", "shot_id"]
    with pytest.raises(Exception, match="no_such"):
        source.read_signals(spark, mart, [1], ["no_such"])


def test_manifest_names_every_flag(spark):
    table = spark.range(450).selectExpr("id AS shot_id", "concat('flag', id % 150) AS quality_flag", "id < 28 AS declared_disruption")
    card = sink.manifest(table)
    assert card["statistics"]["quality_flags"] == {f"flag{i}": 3 for i in range(150)}
    sixteen = sink.manifest_statistics(spark.range(16).selectExpr("id = 3 AS declared_disruption")).first()
    assert sixteen.disruption_rate_declared == 0.062  # 0.0625 goes to the even digit


def test_long_ids_in_comparison(spark, mart):
    big = 3_000_000_000
    meta = meta_frame(spark).withColumn("shot_id", F.col("shot_id") + big)
    facts = signals_frame(spark).withColumn("shot_id", F.col("shot_id") + big)
    rows = reports.comparison(facts, meta, [big + 4, big + 1]).collect()
    assert [(r.shot_id, r.position) for r in rows][::100] == [(big + 4, 1), (big + 1, 2)]


def test_auc_equals_counting_pairs(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"g": rng.integers(0, 4, 600), "x": rng.choice([0.0, -1e9, 0.1, 0.1000001, 3, 1e12], 600) * rng.integers(1, 9, 600)})
    pdf["y"] = (rng.random(600) < 0.3) & (pdf.g != 2)
    pdf.loc[pdf.g == 3, "x"] = 7.0
    rows = [(int(r.g), float(r.x), bool(r.y)) for r in pdf.itertuples()] + [(0, None, True), (1, 5.0, None), (1, float("nan"), True)]
    got = {r.g: r for r in ml.rank_auc(spark.createDataFrame(rows, "g int, x double, y boolean"), F.col("y"), "x", "g", steps=5).collect()}
    for g, part in pdf.groupby("g"):
        high, low = part.x[part.y].to_numpy(), part.x[~part.y].to_numpy()
        assert (got[g].n_rows, got[g].n_positive) == (len(part), len(high))
        if len(high):
            wins = (high[:, None] > low).sum() + (high[:, None] == low).sum() / 2
            assert got[g].auc == pytest.approx(wins / (len(high) * len(low)), abs=1e-12)
        else:
            assert got[g].auc is None
    assert ml.cross_validate(spark.createDataFrame([], "y boolean, k long, a double"), "y", "k", ["a"]).count() == 0


def test_folds_and_classifier(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"shot_id": range(300), "y": rng.random(300) < 0.16})
    pdf["plasma_current_max_MA"] = rng.normal(0, 1, 300) + 3 * pdf.y
    pdf["electron_density_mean"] = rng.normal(0, 1, 300)
    df = spark.createDataFrame(pdf)
    folds = ml.stratified_folds(df, "y", "shot_id").toPandas()
    sizes = folds.groupby(["y", "fold"]).size().unstack()
    assert (sizes.max(axis=1) - sizes.min(axis=1)).max() <= 1
    features = ["plasma_current_max_MA", "electron_density_mean"]
    result = ml.cross_validate(df, "y", "shot_id", features, trees=10)
    summary = ml.summarize_folds(result).first()
    assert result.count() == 5 and summary.auc_mean > 0.9 and summary.auc_std < 0.1
    _, score = ml.train_event_classifier(df, "y", features, trees=10)
    scored = score(df).toPandas().merge(pdf)
    assert scored[scored.y].event_score.mean() > scored[~scored.y].event_score.mean()


def state_of(spark, path):
    """All that readers see of a mart."""
    return (
        sorted(map(tuple, source.read_metadata(spark, path).collect()), key=str),
        sorted(map(tuple, source.read_signals(spark, path).collect())),
        source.read_manifest(spark, path),
    )


def stored(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


@pytest.mark.parametrize("broken", ["signals", "manifest", "pointer"])
def test_a_failure_between_the_parts_leaves_the_old_mart(spark, tmp_path, monkeypatch, broken):
    path = str(tmp_path / "mart")
    config = MartConfig(path)
    sink.write_mart(meta_frame(spark), signals_frame(spark), config, "2026-01-01T00:00:00+00:00")
    before, files = state_of(spark, path), stored(path)

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    new_meta, new_facts = meta_frame(spark).where("shot_id < 3"), signals_frame(spark, 2, 30)
    with monkeypatch.context() as patch:
        if broken == "signals":
            new_facts = new_facts.withColumn("time_s", F.raise_error(F.lit("lost")).cast("double"))
        else:
            patch.setattr(sink, "manifest" if broken == "manifest" else "replace_text", fail)
        with pytest.raises(Exception, match="lost"):
            sink.write_mart(new_meta, new_facts, config, "2027-01-01T00:00:00+00:00")
    assert state_of(spark, path) == before
    assert len(stored(path)) > len(files)  # what the change has left is there, but not seen
    assert sink.vacuum(spark, config) > 0
    assert [f for f in stored(path) if not f.startswith(sink.FILE_LISTS)] == [f for f in files if not f.startswith(sink.FILE_LISTS)]

    sink.write_mart(meta_frame(spark).where("shot_id < 3"), signals_frame(spark, 2, 30), config, "2027-01-01T00:00:00+00:00")
    meta, facts, card = state_of(spark, path)
    assert len(meta) == 2 and len(facts) == 60 and card["created_at_utc"].startswith("2027")
    assert sorted(os.listdir(f"{path}/signals"))[-2:] == ["shot_id=1", "shot_id=2"]
    assert sink.vacuum(spark, config) == 0


def test_files_are_found_by_the_list_alone(spark, tmp_path):
    path = str(tmp_path)
    sink.write_mart(meta_frame(spark), signals_frame(spark), MartConfig(path))
    os.makedirs(f"{path}/signals/shot_id=6")
    stray = f"{path}/signals/shot_id=2/part-left-by-a-lost-writer.parquet"
    with open(stray, "wb") as f:
        f.write(b"not a table")
    assert source.read_signals(spark, path).count() == 500
    assert source.read_signals(spark, path, range(1, 5001)).count() == 500
    assert stray not in "".join(source.read_signals(spark, path, [2]).inputFiles())
    files = sink.read_files(spark, path, sink.read_current(spark, path), "signals").collect()
    assert {(r.min_id, r.max_id, r.directory) for r in files} == {(i, i, i) for i in range(1, 6)}
    assert sum(r.n_rows for r in files) == 500 and all(r.bytes > 0 for r in files)


def test_single_recordings_are_replaced_and_others_kept(spark, tmp_path):
    path = str(tmp_path)
    sink.write_mart(meta_frame(spark), signals_frame(spark), MartConfig(path))
    again = signals_frame(spark, 7, 10).where("shot_id in (3, 7)")
    sink.write_mart(meta_frame(spark), again, MartConfig(path, overwrite=False))
    counts = {r.shot_id: r["count"] for r in source.read_signals(spark, path).groupBy("shot_id").count().collect()}
    assert counts == {1: 100, 2: 100, 3: 10, 4: 100, 5: 100, 7: 10}
    assert len([f for f in os.listdir(f"{path}/signals/shot_id=3") if f.endswith(".parquet")]) == 1
    assert source.select_signals(spark, path, "shot_id = 3").count() == 10


def test_a_mart_without_a_list_is_read_and_taken_over(spark, tmp_path):
    path = str(tmp_path)
    signals_frame(spark).write.partitionBy("shot_id").parquet(f"{path}/signals")
    meta_frame(spark).write.parquet(f"{path}/metadata.parquet")
    assert source.read_signals(spark, path, [2, 4]).count() == 200 and source.read_metadata(spark, path).count() == 5
    sink.write_signals(signals_frame(spark, 2, 10).where("shot_id = 2"), MartConfig(path, overwrite=False))
    assert source.read_signals(spark, path).count() == 410 and source.read_metadata(spark, path).count() == 5
    sink.write_signals(signals_frame(spark, 1), MartConfig(path))
    assert source.read_signals(spark, path).count() == 100
    assert [d for d in os.listdir(f"{path}/signals") if "=" in d] == ["shot_id=1"]


@pytest.mark.parametrize("step", [1, 1000, -7])
def test_more_recordings_than_directories(spark, tmp_path, step):
    """Ranges of ids share directories; single recordings are replaced and read as before."""
    path, config = str(tmp_path), {"max_directories": 4}
    number = (F.col("shot_id") * step).alias("shot_id")
    facts = signals_frame(spark, 40, 6).withColumn("shot_id", number)
    meta = spark.range(1, 41).selectExpr(f"id * {step} AS shot_id", "id % 3 = 0 AS chosen")
    sink.write_mart(meta, facts, MartConfig(path, **config))
    folders = [d for d in os.listdir(f"{path}/signals") if "=" in d]
    assert len(folders) <= 6 and len(stored(f"{path}/signals")) <= 10
    assert source.read_manifest(spark, path)["tables"]["signals"]["partitioning"] == folders[0].split("=")[0]
    assert sorted(map(tuple, source.read_signals(spark, path).select(facts.columns).collect())) == sorted(map(tuple, facts.collect()))
    assert source.select_signals(spark, path, "chosen").count() == 13 * 6
    for some in ([5, 21], range(1, 41)):
        assert source.read_signals(spark, path, [i * step for i in some]).count() == 6 * len(some)

    again = signals_frame(spark, 43, 2).where("shot_id in (7, 9, 40, 43)").withColumn("shot_id", number)
    sink.write_signals(again.withColumn("extra", F.lit(1.5)), MartConfig(path, overwrite=False, **config))
    back = source.read_signals(spark, path)
    counts = {r.shot_id // step: (r.n, r.e) for r in back.groupBy("shot_id").agg(F.count("*").alias("n"), F.count("extra").alias("e")).collect()}
    assert counts == {i: (2, 2) if i in (7, 9, 40, 43) else (6, 0) for i in (*range(1, 41), 43)}
    kept = sorted(map(tuple, back.where(~F.col("shot_id").isin([i * step for i in (7, 9, 40, 43)])).select(facts.columns).collect()))
    assert kept == sorted(map(tuple, facts.where(~F.col("shot_id").isin([i * step for i in (7, 9, 40)])).collect()))
    assert {f"signals/{f}" for f in stored(f"{path}/signals")} == {r.file for r in sink.read_files(spark, path, sink.read_current(spark, path), "signals").collect()}

    sink.write_signals(signals_frame(spark, 3, 5), MartConfig(path, **config))
    assert sorted(d for d in os.listdir(f"{path}/signals") if "=" in d) == ["shot_id=1", "shot_id=2", "shot_id=3"]


def test_least_id_is_selected(spark, tmp_path):
    least = -(2**63)
    meta = spark.createDataFrame([(least, "OK"), (5, "OK")], "shot_id long, quality_flag string")
    facts = signals_frame(spark, 1, 3).withColumn("shot_id", F.lit(least))
    sink.write_mart(meta, facts, MartConfig(str(tmp_path)))
    assert source.select_signals(spark, str(tmp_path), "quality_flag = 'OK'").count() == 3


def test_a_build_leaves_no_scratch_behind(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    for sid in (1, 2):
        f = pulse(sid).drop(columns="shot_id")
        f.columns = NAMING_SCHEMES["canonical"]
        write_shot(tmp_path / "raw", sid, frame=f)
    before = set(os.listdir(shared))
    build_mart(spark, str(tmp_path / "raw"), MartConfig(str(tmp_path / "out")))
    assert set(os.listdir(shared)) == before
    with pytest.raises(Exception, match="no such codec|not available|nothing"):
        build_mart(spark, str(tmp_path / "raw"), MartConfig(str(tmp_path / "out"), compression="nothing"))
    assert set(os.listdir(shared)) == before
    assert source.read_metadata(spark, str(tmp_path / "out")).count() == 2
