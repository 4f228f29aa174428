import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tests.oracle import compare, connect
from tidegrid.llm import filter_audit as A
from tidegrid.llm.queries import FILTER_AUDIT_SQL, filter_audit_query


def by_definition(masks, filters):
    """Steps of every order, by going through all rows of all masks."""
    rows = [(m, w) for m, ws in masks.items() for w in ws]
    out = {}
    for order in permutations(range(filters)):
        left, steps = list(rows), []
        for f in order:
            gone = [r for r in left if r[0] >> f & 1]
            left = [r for r in left if not r[0] >> f & 1]
            steps.append((f, len(left), len(gone), sum(w for _, w in gone)))
        out[order] = steps
    return out


@pytest.mark.parametrize("filters, seed", [(1, 0), (2, 1), (3, 2), (4, 3), (5, 4), (5, 5), (6, 6)])
def test_every_order_equals_its_definition(filters, seed):
    rng = random.Random(seed)
    masks = {m: [rng.randrange(2) for _ in range(rng.randrange(4))] for m in range(1 << filters) if rng.random() < 0.7}
    diagram = A.Diagram({m: (len(w), sum(w)) for m, w in masks.items()}, filters, 2)
    want, seen, before = by_definition(masks, filters), [], None
    for steps in diagram.orders():
        order = tuple(f for f, _, _ in steps)
        assert [(f, kept[0], *removed) for f, kept, removed in steps] == want[order]
        if before:
            moved = [i for i in range(filters) if order[i] != before[i]]
            assert len(moved) == 2 and moved[1] == moved[0] + 1
        before = order
        seen.append(order)
    assert sorted(seen) == sorted(want)


def test_equal_parts_of_a_diagram_are_shared():
    same = A.Diagram({m: (1,) for m in range(32)}, 5, 1)
    assert [len(level) for level in same.levels] == [1, 1, 1, 1, 1]
    for _ in same.orders():
        assert [len(level) for level in same.levels] == [1, 1, 1, 1, 1]
    parity = A.Diagram({m: (m.bit_count() % 2,) for m in range(32)}, 5, 1)
    for _ in parity.orders():
        assert [len(level) for level in parity.levels] == [1, 2, 2, 2, 2]


def brute(docs, labels):
    """Rows of the query by its definition, document by document."""
    first, good, toxic = {}, {}, {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    for doc_id, quality, bad in labels:
        good[doc_id] = good.get(doc_id, False) or quality == 1
        toxic[doc_id] = toxic.get(doc_id, False) or bad == 1
    parts = {}
    for doc_id, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search("[#$%&*|]", text)), "E": doc_id is not None and first[text] < doc_id,
        }
        known = doc_id is not None
        parts.setdefault(lang or "", []).append((fails, known and good.get(doc_id, False), known and toxic.get(doc_id, False)))
    out = []
    for part, rows in parts.items():
        shapley, steps = dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left = rows
            for i, f in enumerate(order):
                gone, left = [r for r in left if r[0][f]], [r for r in left if not r[0][f]]
                every = sum(r[0][f] for r in rows)
                alone = sum(r[0][f] and sum(r[0].values()) == 1 for r in rows)
                shapley[f] += len(gone)
                steps.append((f, (
                    part, "".join(order), i + 1, len(left), len(gone), every - len(gone), alone,
                    sum(r[1] for r in gone), sum(r[2] for r in gone),
                )))
        out += [(*s, shapley[f]) for f, s in steps]
    return sorted(out)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_odd_documents_equal_brute_force(spark):
    rng = random.Random(2)
    words = ["One", "TWO", "three#", "four", "Ä", "中文", "x|y", "the"] + [f"w{i}" for i in range(200)]
    texts = [None, "", " \n", "A", "É é", "word " * 100, "word " * 99, "a" * 300_000]
    texts += [" ".join(rng.choices(words, k=rng.randrange(60, 180))) for _ in range(150)]
    texts += [" ".join(rng.sample(words, rng.randrange(90, 200))) for _ in range(100)] + ["A" * 10 + "é" * 90, "A" * 11 + "é" * 89]
    docs = [(i * 7 % 1009, rng.choice(texts), rng.choice(["en", "de", None, "", "fr"])) for i in range(600)]
    docs += [(5, "copied", "en")] * 300 + [(4, "copied", "de"), (None, "copied", "en"), (None, None, None), (6, "copied", None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 900, 2)] + [(4, 0, 1), (4, 1, 0), (None, 1, 1)]
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, lang string, quality int, mask string")
    marks = spark.createDataFrame([(*m, "x") for m in labels], "doc_id long, quality int, toxic int, text string")
    got = A.audit_documents(frame.repartition(3), marks)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == brute(docs, labels)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert A.audit_documents(docs, labels).count() == 0
    one = spark.createDataFrame([(None, None, None)], docs.schema)
    got = A.audit_documents(one, labels).collect()
    assert sorted(map(tuple, got)) == brute([(None, None, None)], [])


def test_query_equals_its_sql_and_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = filter_audit_query(spark, sf)
    assert compare(got, connect(sf), FILTER_AUDIT_SQL) is None
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", "toxic").collect()
    assert sorted(map(tuple, got.collect())) == brute(docs, labels)


def test_other_filters_and_parts(spark):
    rows = spark.range(1000).selectExpr("id", "id % 3 AS part", "id AS mask")
    fails = {"x": F.col("id") % 2 == 0, "y": F.col("id") % 5 == 0, "z": F.when(F.col("id") > 10, F.lit(None)).otherwise(True)}
    got = A.audit(rows, F.col("part"), fails).collect()
    assert len(got) == 3 * 6 * 3 and got[0].asDict().keys() == set(COLUMNS) - {"good_lost", "toxic_lost"}
    last = {(r["part"], r["filter_order"]): r["kept"] for r in got if r["step"] == 3}
    assert {k[0]: v for k, v in last.items()} == {
        str(p): sum(i % 2 != 0 and i % 5 != 0 and i > 10 for i in range(p, 1000, 3)) for p in range(3)
    }
