import glob

import pytest

import corpus_pipeline as P

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not glob.glob(f"{SF}/*"), reason="no test data")


def test_stages_take_effect(spark, tmp_path):
    from tests.llm.test_decontamination import brute as contaminated
    from tests.llm.test_mixing import water
    from tests.llm.test_near_dedup import fingerprint, roots
    from tidegrid.llm import quality

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for name, stage in P.STAGES:
        stage(spark, seen[-1], SF).write.parquet(f"{tmp_path}/{name}")
        seen.append(spark.read.parquet(f"{tmp_path}/{name}"))
    rows = [sorted(map(tuple, d.select(columns).collect()), key=str) for d in seen]
    assert all(d.columns == columns for d in seen[:-1])
    raw, good, single, clean, mixed, placed = rows

    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    predicted = {r.doc_id: r.predicted for r in quality.scores(docs, model).collect()}
    assert good == [r for r in raw if predicted[r[0]]]

    prints = {r[0]: fingerprint(r[1]) for r in good}
    root = roots(set(prints.values()))
    first = {}
    for d in sorted(prints):
        first.setdefault(root[prints[d]], d)
    assert single == [r for r in good if r[0] in set(first.values())]

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {d for d, _ in contaminated([(r[0], r[1]) for r in single], items)}
    assert clean == [r for r in single if r[0] not in hit]

    size = {r: len(r[1].split()) for r in clean}
    total = {}
    for r in clean:
        total[r[3]] = total.get(r[3], 0) + size[r]
    assert set(mixed) <= set(clean)
    for source, target in water(total).items():
        taken = sum(size[r] for r in mixed if r[3] == source)
        largest = max((size[r] for r in clean if r[3] == source), default=0)
        assert abs(target - taken) <= largest
    assert all(mixed.count(r) <= 3 for r in set(mixed))

    assert placed == mixed
    slots = {}
    for r in seen[-1].collect():
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1

    whole = P.run(spark, SF)
    assert sorted(map(str, whole.collect())) == sorted(map(str, seen[-1].collect()))


def test_stages_take_odd_rows(spark):
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (1, "", "en", "", 0), (2, "word " * 60_000, "en", "a", 1),
        (2, "word " * 60_000, "en", "a", 1), (3, " \n", None, None, 2),
    ]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, size int, _doc string")
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        assert set(docs.columns) <= set(out.columns), name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        assert out.count() >= 1 or name == "quality_classifier"
