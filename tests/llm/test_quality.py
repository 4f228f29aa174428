import glob
import pickle
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.llm import quality as Q

SF = "/root/testdata/sf0.01"


def texts(seed, n, bad):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("wind", "stone", "river", "glass") for b in ("", "s", "ing", "ed")]
    junk = ["$$$", "click", "buy!!", "&&&", "###"]
    return [
        " ".join(rng.choice(vocabulary) + (rng.choice(junk) if bad and rng.random() < 0.6 else "") for _ in range(rng.randrange(20, 400)))
        for _ in range(n)
    ]


def labelled(spark, n=150):
    good, bad = texts(1, n, False), texts(2, n, True)
    docs = [(i, t) for i, t in enumerate(good + bad)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(i, int(i < n)) for i in range(2 * n)], "doc_id long, quality int"),
    )


def test_held_out_texts_are_told_apart(spark):
    docs, labels = labelled(spark)
    rows = Q.scores(docs, Q.fit(docs, labels)).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    out = [r for r in rows if r.held_out]
    assert len(out) > 30 and all(r.predicted == int(r.doc_id < 150) for r in out)


@pytest.mark.skipif(not glob.glob(f"{SF}/*"), reason="no test data")
def test_held_out_documents_of_the_driver(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = Q.scores(docs, Q.fit(docs, labels)).where("held_out").join(labels, "doc_id").collect()
    right = np.mean([r.predicted == r.quality for r in scored])
    ranks = [(a.score > b.score) + 0.5 * (a.score == b.score) for a in scored if a.quality for b in scored if not b.quality]
    assert right > 0.95 and np.mean(ranks) > 0.9


def test_the_score_is_the_calibrated_difference(spark):
    docs, labels = labelled(spark, 60)
    model = pickle.loads(pickle.dumps(Q.fit(docs, labels)))
    by = {r.doc_id: r.score for r in Q.scores(docs, model).collect()}
    bad, good = model._compressors()
    for r in docs.limit(20).collect():
        data = r.text.encode()
        parts = [data[i : i + Q.PIECE_BYTES] for i in range(0, len(data), Q.PIECE_BYTES)]
        b, g = (sum(len(c.compress(p)) for p in parts) for c in (bad, good))
        z = model.slope * (b - g + 64 * model.typical) / (len(data) + 64) + model.offset
        assert by[r.doc_id] == pytest.approx(1 / (1 + np.exp(-z)))
    assert model.slope > 0


def test_whole_texts_count():
    model = Q.CompressionClassifier(b"$$$ &&& ###" * 400, b"river stone glass" * 400, 1.0, 0.0)
    clean = "river stone glass " * 2000
    assert model.difference(clean + "$$$ &&& ### " * 9000) < model.difference(clean)
    assert model.difference("") == model.difference(None) == 0.0


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    docs, labels = labelled(spark, 60)
    other = labels.withColumn("quality", F.when(Q.fold("doc_id") == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    extra = docs.withColumn("score", F.lit("x")).withColumn("_text", F.lit(3)).withColumn("lang", F.lit(None).cast("string"))
    first = {r.doc_id: r.score for r in Q.scores(docs, Q.fit(docs, labels)).collect()}
    assert {r.doc_id: r.score for r in Q.scores(extra, Q.fit(extra, other)).collect()} == first


def test_odd_rows_and_labels(spark):
    rows = [(None, "a b"), (1, None), (2, ""), (3, "word " * 100_000), (3, "word " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(None, 1), (1, None), (2, 0), (3, 5)], "doc_id long, quality int")
    for known in (labels, labels.limit(0), spark.createDataFrame([(i, i % 2) for i in range(4)], "doc_id long, quality int")):
        model = Q.fit(docs, known)
        scored = Q.scores(docs, model).collect()
        assert len(scored) == 5 and all(0 <= r.score <= 1 for r in scored)
        assert len({r.score for r in scored if r.doc_id == 3}) == 1
    assert Q.scores(docs.limit(0), model).count() == 0
    assert Q.keep_good(docs, model).columns == docs.columns
