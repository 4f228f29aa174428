import json
import os

import numpy as np
import pandas as pd
import pytest
import yaml

from tidegrid.sources import recordings as rec
from tidegrid.sources.registry import CANONICAL, CURRENT_UNITS, NAMING_SCHEMES, SourceRegistry


def write_shot(root, sid, naming="canonical", unit="MA", kind="csv", frame=None, name=None, meta=None, drop=(), indent=2):
    folder = os.path.join(str(root), name or f"shot_{sid:04d}")
    os.makedirs(folder)
    record = {
        "shot_id": sid, "duration_s": 2.0, "sampling_hz": 1000, "disruption": sid % 2 == 0,
        "disruption_time_s": 1.5 if sid % 2 == 0 else None, "file_format": kind, "current_unit": unit,
        "column_naming_scheme": naming, "operator": "Op1", "machine_config": "M1", **(meta or {}),
    }
    record = {k: v for k, v in record.items() if k not in drop}
    with open(f"{folder}/metadata.yaml", "w") as f:
        yaml.safe_dump(record, f, sort_keys=False)
    if frame is not None and kind == "csv":
        frame.to_csv(f"{folder}/signals.csv", index=False)
    if frame is not None and kind == "json":
        frame.to_json(f"{folder}/signals.json", orient="records", indent=indent)
    return folder


def raw_frame(naming, unit, n=20, seed=0):
    rng = np.random.default_rng(seed)
    v = [np.arange(n) * 0.1, rng.uniform(1, 2, n), rng.uniform(3, 5, n), rng.uniform(2, 3, n), rng.normal(0, 1, n)]
    v[2][3:6] = np.nan
    v[1] = v[1] / CURRENT_UNITS[unit]
    return pd.DataFrame(dict(zip(NAMING_SCHEMES[naming], v)))


def test_registry_defaults_and_resolution():
    registry = SourceRegistry.default()
    assert registry.canonical_columns["time"] == "time_s" and len(registry.schemas) == 6
    assert registry.resolve({"column_naming_scheme": "raw", "current_unit": "MA"}) == "raw_MA"
    assert registry.resolve({"column_naming_scheme": "verbose", "current_unit": "A"}) == "verbose_A"
    with pytest.raises(ValueError, match="insufficient metadata"):
        registry.resolve({"column_naming_scheme": "raw"})


def test_registry_from_yaml(tmp_path):
    doc = {
        "canonical_columns": {"time": "time_s", "flow": "flow_lps"},
        "schemas": {"lab_x": {"column_mapping": {"T": "time", "F": "flow"}, "expected_columns": ["T", "F"]}},
        "resolution": {"pattern": "{site}_{version}"},
    }
    path = tmp_path / "sources.yaml"
    path.write_text(yaml.safe_dump(doc, sort_keys=False))
    registry = SourceRegistry.from_yaml(str(path))
    assert registry.template_keys == ["site", "version"]
    assert registry.columns_of(registry.schemas["lab_x"])[1] == [("F", 1.0), ("flow", 1.0), ("flow_lps", 1.0)]


def test_apply_schema(spark):
    """Columns are picked by name, converted and put in canonical order."""
    df = spark.range(4).selectExpr(
        "id * 3 AS Vl", "'k' || id AS station", "CAST(id AS FLOAT) / 2 AS t", "(id + 1) * 250000 AS Ip",
        "CAST(id AS STRING) AS ne", "CAST('NaN' AS DOUBLE) AS Te",
    )
    got = rec.apply_schema(df, SourceRegistry.default(), "raw_A")
    assert got.columns == list(CANONICAL)
    assert [tuple(r) for r in got.orderBy("time_s").collect()] == [
        (i / 2, (i + 1) / 4, float(i), None, 3.0 * i) for i in range(4)
    ]
    assert rec.apply_schema(df, SourceRegistry.default(), "raw_A", keep_extra=True).columns == [*CANONICAL, "station"]
    with pytest.raises(ValueError, match="missing columns"):
        rec.apply_schema(df.drop("Te"), SourceRegistry.default(), "raw_A")


def test_one_csv_recording(spark, tmp_path):
    frame = pd.DataFrame({"t": [2.0, 0.5, 1.0], "Ip": [5e5, 2e6, 7.5e5], "ne": [1.0, None, 3.0], "Te": 6.0, "Vl": [-1, 0, 1]})
    out = rec.load_recording(spark, write_shot(tmp_path, 31, "raw", "A", frame=frame))
    assert out.signals.columns == ["shot_id", *CANONICAL, *rec.SOURCE_ORDER]
    rows = [tuple(r)[:6] for r in out.signals.orderBy("time_s").collect()]
    assert rows == [(31, 0.5, 2.0, None, 6.0, 0.0), (31, 1.0, 0.75, 3.0, 6.0, 1.0), (31, 2.0, 0.5, 1.0, 6.0, -1.0)]
    assert out.metadata.first().schema_applied == "raw_A"
    first, n = rec.preview(out, 2)
    assert n == 3 and [r.time_s for r in first.collect()] == [0.5, 1.0]


NOTES = ['a}b', '}', '{', '"}, {"', '\\"}', '}\\', "line\nend}", '}, {"x": 1', "]", "", "é}{é", '\\\\"}{']


NESTED = [{"gain": 1}, {}, [], [[{"}": "{"}, "]"], {"a": {"b": ["}, {", None]}}], {"x": {"y": {}}, "z": "\\"}, None, 3, [1, [2, [3]]]]


@pytest.mark.parametrize("indent", [None, 2, "lines"])
def test_json_text_may_hold_anything(spark, tmp_path, indent):
    """Braces, quotes and line ends inside texts, over many small tasks."""
    rows = [{"note": NOTES[i % len(NOTES)] * (1 + i % 5), "cal": NESTED[i % len(NESTED)], "time_s": i / 4, "plasma_current": 1.0, "electron_density": None,
             "electron_temperature": i, "loop_voltage": -i, "aux": i} for i in range(90)]
    folder = write_shot(tmp_path, 8, kind="json")
    text = "\n".join(map(json.dumps, rows)) if indent == "lines" else json.dumps(rows, indent=indent, ensure_ascii=False)
    with open(f"{folder}/signals.json", "w") as f:
        f.write(text)
    for size in ("128m", "2k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            out = rec.load_recording(spark, folder)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        got = out.signals.orderBy(*rec.SOURCE_ORDER).select("time_s", "electron_temperature").collect()
        assert [tuple(r) for r in got] == [(i / 4, float(i)) for i in range(90)], size


def test_one_bad_recording_raises(spark, tmp_path):
    folder = write_shot(tmp_path, 5, frame=raw_frame("canonical", "MA"), drop=["current_unit"])
    with pytest.raises(ValueError, match="insufficient metadata"):
        rec.load_recording(spark, folder)


def test_mixed_formats_schemas_and_errors(spark, tmp_path):
    expected, sid = {}, 0
    for naming in NAMING_SCHEMES:
        for unit in CURRENT_UNITS:
            for kind in ("csv", "json"):
                sid += 1
                frame = raw_frame(naming, unit, seed=sid)
                expected[sid] = raw_frame(naming, unit, seed=sid)
                if sid % 3 == 0:
                    frame = frame[frame.columns[::-1]]  # permuted header
                if sid % 4 == 0:
                    frame.insert(2, "note", 'te"xt},{"' if kind == "json" else "text}")  # extra column
                write_shot(tmp_path, sid, naming, unit, kind, frame, indent=[2, None][sid % 2])
    good = raw_frame("canonical", "MA")
    bad = {
        "shot_a": dict(sid=50, unit="kA", frame=good),
        "shot_b": dict(sid=51, kind="hdf5"),
        "shot_c": dict(sid=52, frame=None),
        "shot_d": dict(sid=53, frame=good[["time_s", "plasma_current"]]),
        "shot_e": dict(sid=54, frame=good.assign(plasma_current=["1.0"] * 19 + ["oops"])),
        "shot_f": dict(sid=55, frame=good, drop=["file_format"]),
        "shot_g": dict(sid=56, frame=good, drop=["shot_id"]),
        "shot_h": dict(sid=57, frame=good, meta={"current_unit": None}),
        "shot_i": dict(sid=58, kind="json", frame=good[["time_s"]]),
        "shot_j": dict(sid=59, frame=good, drop=["column_naming_scheme"]),
        "shot_l": dict(sid=61, frame=good.assign(time_s=np.nan)),
        "shot_o": dict(sid=64, frame=good.assign(time_s=[*good.time_s[:-1], np.inf])),
    }
    for name, spec in bad.items():
        write_shot(tmp_path, spec.pop("sid"), name=name, **spec)
    os.makedirs(tmp_path / "shot_k")
    good.to_csv(tmp_path / "shot_k" / "signals.csv", index=False)
    write_shot(tmp_path, 62, name="shot_m", frame=good)
    (tmp_path / "shot_m" / "metadata.yaml").write_text("a: [1\n")
    write_shot(tmp_path, 63, name="shot_n", kind="json", frame=None)
    (tmp_path / "shot_n" / "signals.json").write_text('[{"time_s": 0.0, "plasma_current": }]')
    write_shot(tmp_path, 1, name="shot_0000", frame=good)  # same id as shot_0001
    with open(tmp_path / "shot_0001" / "signals.csv", "a") as f:
        f.write("99.0,NA,null,NaN,n/a\n")

    out = rec.load_recordings(spark, str(tmp_path))
    got = out.signals.toPandas()
    assert set(got.shot_id) == set(expected)
    for s, frame in expected.items():
        have = got[(got.shot_id == s) & (got.time_s < 99)].sort_values("time_s")
        for j, c in enumerate(CANONICAL):
            want = frame.iloc[:, j].to_numpy(float)
            if c == "plasma_current_MA" and s in (3, 4, 7, 8, 11, 12):
                want = want * 1e-6
            np.testing.assert_allclose(have[c].to_numpy(float), want, rtol=1e-9, atol=1e-9)  # JSON keeps 10 digits
    extra = got[got.time_s == 99]
    assert len(extra) == 1 and extra.electron_density.isna().all()

    errors = {r.shot_dir.rsplit("/", 1)[1]: r.error for r in out.errors.collect()}
    texts = {
        "shot_a": "unknown schema canonical_kA", "shot_b": "unsupported file format: hdf5",
        "shot_c": "no data in signals.csv", "shot_d": "missing columns",
        "shot_e": "non-numeric text in plasma_current_MA", "shot_f": "no file_format",
        "shot_g": "shot_id", "shot_h": "has no value", "shot_i": "missing columns",
        "shot_j": "insufficient metadata", "shot_k": "metadata.yaml is missing",
        "shot_l": "row without a time", "shot_o": "row without a time", "shot_m": "not valid YAML", "shot_n": "malformed record",
        "shot_0000": "used by a later directory",
    }
    assert set(errors) == set(texts)
    for name, text in texts.items():
        assert text in errors[name], (name, errors[name])
    assert rec.error_sample(out.errors).count() == 5
    usage = {r.schema_applied: r.n_shots for r in rec.schema_usage(out.metadata).collect()}
    assert usage == {f"{n}_{u}": 2 for n in NAMING_SCHEMES for u in CURRENT_UNITS}
    assert rec.format_check(out.metadata).first().is_homogeneous is False
    summary = {(r.dimension, r.value): (r.n_shots, r.disruption_rate) for r in rec.dataset_summary(out.metadata).collect()}
    assert summary[("total", None)] == (12, 0.5) and summary[("file_format", "json")] == (6, 1.0)
    assert len(summary) == 8


def test_extra_column_and_no_recordings(spark, tmp_path):
    write_shot(tmp_path, 1, frame=raw_frame("canonical", "MA").assign(aux=3.0))
    out = rec.load_recordings(spark, str(tmp_path), extra_columns=["aux"])
    assert out.signals.agg({"aux": "sum"}).first()[0] == 60.0
    assert rec.format_check(out.metadata).first().is_homogeneous
    empty = rec.load_recordings(spark, str(tmp_path / "none"))
    assert empty.signals.count() == 0 and empty.errors.count() == 0


def test_headers_are_found_without_a_scan(spark, tmp_path):
    """The first line that is not blank, of files of any size, in odd encodings and folders of parts."""
    texts = {
        "shot_1": b"\xef\xbb\xbfa, b ,\"c\"\r\n1,2,3\r\n", "shot_2": b"\n  \n\r\nx,y\n" + b"1,2\n" * 200_000,
        "shot_3": b"only", "shot_4": b"", "shot_5": b" \n\n", "shot_6": b"p,q\r1,2\r", "shot 7%41": b"s,t\n",
        "shot_8": b"k" * 200_000 + b",l\n1,2\n",
    }
    for name, text in texts.items():
        os.makedirs(tmp_path / name)
        (tmp_path / name / "signals.csv").write_bytes(text)
    os.makedirs(tmp_path / "shot_9" / "signals.csv")
    (tmp_path / "shot_9" / "signals.csv" / "part-1.csv").write_bytes(b"u,v\n1,2\n")
    (tmp_path / "shot_9" / "signals.csv" / "part-0.csv").write_bytes(b"")
    path = f"{tmp_path}/shot*/signals.csv"
    headers = rec._csv_headers(spark, path)
    got = {r.shot_dir.rsplit("/", 1)[1]: r.found for r in headers.collect()}
    want = {
        "shot_1": ["a", "b", "c"], "shot_2": ["x", "y"], "shot_3": ["only"], "shot_6": ["p", "q"],
        "shot%207%2541": ["s", "t"], "shot_8": ["k" * 200_000, "l"], "shot_9": ["u", "v"],
    }
    assert got == want
    plan = headers._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan and "FileScan csv" not in plan and "content" not in plan
    scanned = rec._scanned_lines(spark, path).groupBy("shot_dir").agg({"value": "count"})
    assert {r.shot_dir.rsplit("/", 1)[1] for r in scanned.collect()} == set(want)
