import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.llm import queries
from tidegrid.llm.sharding import Feistel, locate, shard_rows


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 16, 17, 1000, 65_537])
def test_feistel_is_a_permutation_with_an_inverse(n):
    x = np.arange(n)
    y = Feistel(n).forward(x)
    assert sorted(y.tolist()) == x.tolist()
    assert (Feistel(n).backward(y) == x).all()
    if n >= 1000:
        assert (y != Feistel(n, seed=1).forward(x)).mean() > 0.9
        assert abs(np.corrcoef(x, y)[0, 1]) < 0.1


def test_one_number_is_computable_alone():
    f = Feistel(10**12)
    for x in (0, 1, 10**12 - 1, 123_456_789_012):
        assert f.backward(f.forward([x]))[0] == x


def test_shards_are_level_and_slots_without_gaps(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 7, *range(50)]), rng.choice(["", None, "x", "ä" * 9]), i % 3) for i in range(403)]
    docs = spark.createDataFrame(rows, "doc_id long, _at string, slot int").withColumn("_doc", F.lit(1))
    got = shard_rows(docs.repartition(5), [F.col("doc_id"), F.col("_at")], 16).collect()
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(slots) == list(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sorted((r.doc_id, r["_at"], r["_doc"]) for r in got if r.doc_id and r["_at"]) == sorted(
        (d, t, 1) for d, t, _ in rows if d and t
    )


def test_places_depend_on_the_rows_alone_and_can_be_computed(spark):
    docs = spark.createDataFrame([(i * 3,) for i in range(500)], "doc_id long")
    runs = []
    for parts, shuffle in ((1, "2"), (9, "7")):
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
        runs.append({r.doc_id: (r.shard, r.slot) for r in shard_rows(docs.repartition(parts), [F.col("doc_id")], 7).collect()})
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert runs[0] == runs[1]
    permutation = Feistel(500).forward(np.arange(500))
    assert runs[0] == {i * 3: (int(permutation[i]) % 7, int(permutation[i]) // 7) for i in range(500)}
    assert all(locate(s, t, 500, 7) * 3 == d for d, (s, t) in list(runs[0].items())[:50])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert shard_rows(docs, [F.col("doc_id")]).count() == 0


def test_query_sizes_and_checksums(spark, tmp_path):
    texts = ["", None, "äöü", "plain", "plain", "x" * 100_000]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.shard_query(spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        assert (got[i].size, got[i].text_crc32, got[i].law, got[i].grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
