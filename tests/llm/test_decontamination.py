import random
from collections import Counter

import numpy as np

from tidegrid.llm import decontamination as D


def words(text):
    for s in "\t\n\x0b\x0c\r":
        text = text.replace(s, " ")
    return [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split(" ") if w]


def shingles(ws):
    size = min(5, len(ws))
    return Counter(tuple(ws[i : i + size]) for i in range(len(ws) - size + 1))


def brute(docs, items):
    """Similarity of every item with every window of as many words."""
    out = {}
    for doc, text in docs:
        ws = words(text or "")
        for item, passage in items:
            ps = words(passage or "")
            if not ps or not ws:
                continue
            size, n = min(5, len(ps)), min(len(ps), len(ws))
            if n < size:
                continue
            own = Counter(tuple(ps[i : i + size]) for i in range(len(ps) - size + 1))
            if not own.keys() & {tuple(ws[i : i + size]) for i in range(len(ws) - size + 1)}:
                continue
            for s in range(len(ws) - n + 1):
                there = Counter(tuple(ws[s + i : s + i + size]) for i in range(n - size + 1))
                both = (own & there).total()
                similarity = both / (own | there).total()
                if similarity >= 0.8:
                    best = out.get((doc, item))
                    if best is None or similarity > best[1]:
                        out[doc, item] = (s, similarity)
    return out


def sample():
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(200)] + ["The", "über", "of"]

    def passage(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    items = [(i, passage(rng.choice([1, 3, 4, 5, 6, 20, 40, 90]))) for i in range(25)]
    items += [(100, ""), (101, None), (102, "same same same same same same same same"), (103, items[7][1]), (104, " \n")]
    docs = []
    for i in range(120):
        parts = [passage(rng.choice([0, 3, 50]))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            ws = (rng.choice(items)[1] or "x").split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                if ws:
                    ws[rng.randrange(len(ws))] = rng.choice(["changed", "w1"])
            cut = rng.choice([0, 0, 0, 2])
            parts += ["\n".join(ws[cut:]).upper() if rng.random() < 0.2 else "  ".join(ws[cut:]), passage(10)]
        docs.append((i, " ".join(parts)))
    docs += [(200, None), (201, ""), (202, " \t\n"), (203, "same " * 3000), (204, passage(30_000) + " " + items[3][1])]
    return docs, items


def test_matches_equal_brute_force(spark):
    docs, items = sample()
    found = D.find_items(
        spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, item_id int, _id string").repartition(3),
        spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, doc_id int"),
    ).collect()
    want = brute(docs, items)
    assert len(want) > 60
    assert {(r.doc_id, r.item_id): (r.start_word, round(r.similarity, 9)) for r in found} == {
        k: (s, round(v, 9)) for k, (s, v) in want.items()
    }
    assert len(found) == len(want) and all(r.distance <= D.RADIUS for r in found)


def test_items_may_come_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_ITEMS", 4)
    docs, items = sample()
    docs, items = docs[:30], items[:10]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert {(r.doc_id, r.item_id) for r in D.find_items(frame, bench).collect()} == set(want)
    left = D.drop_contaminated(frame, bench)
    assert {r.doc_id for r in left.collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_dropping_keeps_all_columns_and_rows(spark):
    docs = spark.createDataFrame(
        [(1, "one two three four five six seven", "k"), (2, "clean", "k"), (2, "clean", "k"), (None, None, None)],
        "doc_id long, text string, _matches string",
    )
    bench = spark.createDataFrame([(1, "two three four five six")], "item_id long, text string")
    left = D.drop_contaminated(docs, bench)
    assert left.columns == docs.columns and left.count() == 3
    assert D.drop_contaminated(docs.limit(0), bench).count() == 0
    assert D.drop_contaminated(docs, bench.limit(0)).count() == 4
    empty = D.find_items(docs, bench.limit(0))
    assert empty.columns == D.find_items(docs, bench).columns and empty.count() == 0


def test_the_index_returns_all_within_the_radius():
    rng = random.Random(6)
    items = D.Items([(i, " ".join(str(rng.random()) for _ in range(30))) for i in range(60)], 5, 19, 4, 0.8)
    prints = []
    for p in items.prints.tolist() * 8:
        for b in rng.sample(range(64), rng.randrange(30)):
            p ^= 1 << b
        prints.append(p)
    prints = np.array(prints, dtype=np.uint64)
    window, item, distance = items.within_radius(prints, np.full(len(prints), 30))
    want = {
        (w, i, (int(p) ^ int(q)).bit_count())
        for w, p in enumerate(prints) for i, q in enumerate(items.prints) if (int(p) ^ int(q)).bit_count() <= 19
    }
    assert set(zip(window.tolist(), item.tolist(), distance.tolist(), strict=True)) == want


def test_window_fingerprints_are_those_of_their_sets(monkeypatch):
    rng = np.random.default_rng(5)
    for spread in (3, 40, 10**6):
        own = D.T.mix(rng.integers(0, spread, 300).astype(np.uint64))
        seen = {}
        items = D.Items([(0, "a b c d e f")], 5, 19, 4, 0.8)

        def catch(prints, sizes):
            seen["prints"] = prints
            return np.zeros((3, 0), dtype=np.int64)

        monkeypatch.setattr(items, "within_radius", catch)
        for span in (1, 7, 60):
            window = np.arange(20, 300 - span - 30, 3)
            items._in_windows(own, D.earlier(own), window, span, 5, {})
            assert seen["prints"].tolist() == [int(D.fingerprint(own[w : w + span])) for w in window]


def test_results_come_through_the_fingerprints(monkeypatch):
    """Without near fingerprints only items of many repeats are found."""
    rng = random.Random(3)
    plain = " ".join(f"w{rng.randrange(9999)}" for _ in range(60))
    blank = "_ " * 50 + "x y z"
    items = D.Items([(1, plain), (2, blank)], 5, D.RADIUS, D.BLOCKS, 0.8)
    assert items.repeated.tolist() == [False, True]
    data = np.frombuffer(f"{plain} and {blank}".encode(), dtype=np.uint8)
    offsets = np.array([0, len(data)])
    assert {m[1] for m in items.matches(data, offsets)} == {1, 2}
    monkeypatch.setattr(items, "within_radius", lambda *_: np.zeros((3, 0), dtype=np.int64))
    assert {m[1] for m in items.matches(data, offsets)} == {2}


def test_few_are_beyond_the_radius():
    """Windows at the least similarity: their distances follow the stated mean and deviation."""
    rng = np.random.default_rng(8)
    far = []
    for n in (36, 90, 360):
        for _ in range(1500):
            shared = rng.integers(0, 2**63, n - n // 9).astype(np.uint64)
            a, b = (np.concatenate([shared, rng.integers(0, 2**63, n // 9).astype(np.uint64)]) for _ in range(2))
            far.append(int(D.fingerprint(D.T.mix(a)) ^ D.fingerprint(D.T.mix(b))).bit_count())
    assert 9 < np.mean(far) < 10.5 and np.mean(np.array(far) > D.RADIUS) < 0.002


def test_runs_of_equal_words_do_not_hide_a_long_item(spark):
    rng = random.Random(4)

    def passage(n):
        return [f"w{rng.randrange(5000)}" for _ in range(n)]

    docs, items = [], []
    for i, (size, run) in enumerate([(160, 12), (200, 15), (274, 25), (400, 30), (90, 60), (40, 25)] * 4):
        ws = passage(size)
        at = rng.randrange(size - run)
        blanks = [*ws[:at], *["_"] * run, *ws[at + run :]]
        pair = (ws, blanks) if i % 2 else (blanks, ws)
        items.append((i, " ".join(pair[0])))
        docs.append((i, " ".join(passage(20) + pair[1] + passage(rng.choice([0, 30])))))
    # Both have the run, which is most of their weight, and hardly a word besides.
    for i in range(100, 104):
        items.append((i, " ".join(["_"] * 100 + passage(4))))
        docs.append((i, " ".join(passage(9) + ["_"] * 104 + passage(3))))
    docs += [(200, "_ " * 500), (201, "_ " * 60 + " ".join(passage(5)))]
    want = brute(docs, items)
    assert len({d for d, _ in want}) >= 14
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = D.find_items(frame, bench).collect()
    assert {(r.doc_id, r.item_id): (r.start_word, round(r.similarity, 9)) for r in found} == {
        k: (s, round(v, 9)) for k, (s, v) in want.items()
    }
    assert len(found) == len(want) and any(r.distance > D.RADIUS for r in found)
    left = {r.doc_id for r in D.drop_contaminated(frame, bench).collect()}
    assert left == {d for d, _ in docs} - {d for d, _ in want}
