import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegrid.sources import json_text as J

TEXTS = st.text(alphabet='ab{}[]",:\\ \n\té', max_size=12)
VALUES = st.recursive(
    st.none() | st.integers(-5, 5) | TEXTS,
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(TEXTS, inner, max_size=3),
    max_leaves=8,
)
RECORDS = st.lists(st.dictionaries(TEXTS, VALUES, max_size=4), min_size=1, max_size=6)


def written(records, indent):
    if indent == "lines":
        return "\n".join(json.dumps(r, ensure_ascii=False) for r in records)
    return json.dumps(records, indent=indent, ensure_ascii=False)


def through_splits(data, edges, stretch, monkeypatch):
    """The records of a file by way of all three steps, without Spark."""
    monkeypatch.setattr(J, "STRETCH_BYTES", stretch)
    pieces = data.split(b"}")
    if pieces[-1] == b"":
        pieces.pop()  # as a reader of lines has it
    starts, at = [], 0
    for p in pieces:
        starts.append(at)
        at += len(p) + 1
    bounds = sorted({0, *edges})
    landed = []
    for lo, hi in zip(bounds, [*bounds[1:], 1 << 60]):
        mine = [p for p, s in zip(pieces, starts) if lo <= s < hi]
        if mine:
            split = J._Split("d", "f", lo, len(bounds) == 1)
            for p in mine:
                landed += split.add(p)
            landed += split.flush(last=True)
    rows = [dict(zip(J._NAMES, r)) | {"at": i} for i, r in enumerate(landed)]
    out = [((r["source_block"], r["at"], 0), r["text"]) for r in rows if r["kind"] == J.RECORD]
    later = [r for r in rows if r["kind"] != J.RECORD]
    states = {}
    for batch in J._states(iter([J._batch([tuple(r[n] for n in J._NAMES) for r in later], J._NAMES, J._TYPES)])):
        for s in batch.to_pylist():
            states[s["source_block"], s["seq"]] = {**s, "state_base": s.pop("base")}
    owned = {}
    if later:
        import pyarrow as pa

        table = pa.Table.from_pylist([{**states[r["source_block"], r["seq"]], **r} for r in later])
        for batch in J._parts(iter(table.to_batches())):
            for p in batch.to_pylist():
                if p["owner_seq"] is None:
                    out.append(((p["source_block"], p["source_row"], 0), p["text"]))
                else:
                    owned.setdefault((p["owner_block"], p["owner_seq"]), []).append(p)
    for parts in owned.values():
        parts.sort(key=lambda p: (p["source_block"], p["place"], p["source_row"]))
        out.append(((parts[0]["source_block"], parts[0]["source_row"], 1), b"".join(p["text"] for p in parts)))
    return [text for _, text in sorted(out)]


@settings(max_examples=400, deadline=None)
@given(RECORDS, st.sampled_from([None, 2, "lines"]), st.sets(st.integers(1, 300), max_size=8), st.integers(1, 60), st.booleans())
def test_any_records_over_any_edges(records, indent, edges, stretch, end):
    with pytest.MonkeyPatch.context() as patch:
        text = written(records, indent) + ("\n" if end else "")
        got = through_splits(text.encode(), edges, stretch, patch)
    assert [json.loads(r) for r in got] == records


BROKEN = ['[{"a": 1}', '[{"a": 1}, x]', '{"a": 1} {"b"', '{"a": 1}} ', '["a", "b"]', '[1, 2]', '{"a": "1}', 'x', '"a"', '{"a": 1]', '[{"a": 1}, [2]]', '[{"a": [1}]}]']


@pytest.mark.parametrize("text", BROKEN)
@pytest.mark.parametrize("edges", [(), (4,), (2, 5, 8)])
def test_what_is_no_record_is_noticed(text, edges, monkeypatch):
    def fails(record):
        try:
            return not isinstance(json.loads(record), dict)
        except ValueError:
            return True

    assert any(map(fails, through_splits(text.encode(), edges, 5, monkeypatch)))


@pytest.mark.parametrize("text", ["", " \n", "[]", "[ ]\n", "﻿[]"])
def test_nothing_in_a_file(text, monkeypatch):
    assert through_splits(text.encode(), (), 100, monkeypatch) == []


def test_one_record_over_many_tasks(spark, tmp_path):
    """A record that is longer than several splits, between short ones, in files of several layouts."""
    rng = random.Random(1)
    long = {"t": "}{\"\\" * 900, "n": [{"k": "x" * rng.randrange(30)} for _ in range(60)]}
    for i, indent in enumerate([None, 2, "lines"]):
        (tmp_path / f"{i}.json").write_text(written([{"i": i}, long, {"i": -i}, long], indent))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        text = spark.read.option("lineSep", "}").text(str(tmp_path)).select("*", "_metadata")
        meta = F.col("_metadata")
        rows = J.read_records(text.select(
            F.regexp_extract(meta["file_path"], r"([^/]*)$", 1).alias("shot_dir"), meta["file_path"].alias("file"),
            meta["file_block_start"].alias("source_block"), F.lit(False).alias("whole"), "value",
        )).orderBy("shot_dir", "source_block", "source_row").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(rows) == 12 and all(r.record is not None for r in rows)
    for i in range(3):
        mine = [r.record for r in rows if r.shot_dir == f"{i}.json"]
        assert [mine[0], mine[2]] == [{"i": str(i)}, {"i": str(-i)}]
        for record in (mine[1], mine[3]):
            assert record["t"] == long["t"] and json.loads(record["n"]) == long["n"]
