import hashlib
import random

import pyarrow as pa
import pytest

from tidegrid.llm import repeats as R

SCHEMA = "doc_id long, text string"


def brute(rows, size=100):
    """Removal by a set of all strings seen, document after document."""
    seen, out = set(), {}
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - size + 1):
            s = data[p : p + size]
            if s in seen:
                gone[p : p + size] = b"\1" * size
            seen.add(s)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def got(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def corpus(seed, passages=4, n=60):
    rng = random.Random(seed)

    def noise(k):
        return "".join(rng.choice("abcdefgh ñß\n") for _ in range(k))

    common = [noise(rng.choice([90, 100, 101, 130, 400, 900])) for _ in range(passages)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(4)):
            p = rng.choice(common)
            a = rng.choice([0, 0, rng.randrange(60)])
            parts += [noise(rng.choice([0, 1, 30, 200])), p[a : len(p) - rng.choice([0, 0, rng.randrange(40)])]]
        texts.append("".join(parts) + noise(rng.choice([0, 5, 150])))
    texts += [texts[3], texts[5], None, "", "x", "z" * 99, "z" * 100, "z" * 101, "z" * 5000, "ab" * 700, common[-1] * 3]
    texts += ["A" * 250 + "\0" * 120 + "B", "\0" * 240, noise(40) + "\0" * 130]
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", range(3))
def test_removal_equals_brute_force(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(R.remove_repeats(docs)) == brute(rows)


def test_crowded_cores_are_counted_instead_of_sorted(spark):
    rows = corpus(7)
    assert got(R.remove_repeats(spark.createDataFrame(rows, SCHEMA), sort_limit=1)) == brute(rows)


def test_long_texts_are_taken_in_ranges(monkeypatch):
    monkeypatch.setattr(R, "RANGE", 1000)
    monkeypatch.setattr(R.T, "slabs", lambda offsets: ((i, i + 1) for i in range(len(offsets) - 1)))
    texts = [t or "" for _, t in corpus(8, n=30)]
    texts.append("".join(texts))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["tid", "text"])
    windows = {}
    for out in R._anchor_batches(iter([batch]), 100, 32, True):
        for core, tid, packed in zip(*(out.column(c).to_pylist() for c in (0, 2, 3)), strict=True):
            place, first, last = R._unpack(packed)
            for p in range(first, last + 1):
                string = texts[tid].encode()[p : p + 100]
                assert (tid, p) not in windows and len(string) == 100
                windows[tid, p] = (string, core, place - p)
    assert len(windows) == sum(max(0, len(t.encode()) - 99) for t in texts)
    assert len({s for s, _, _ in windows.values()}) == len(set(windows.values()))


def test_order_of_documents(spark):
    """Ids decide, null ids are last, repeated rows are one document."""
    rng = random.Random(1)
    p = "".join(rng.choice("abcdefgh") for _ in range(300))
    rows = [(5, p), (3, p + "tail"), (None, p), (5, p), (3, p + "tail")]
    df = R.remove_repeats(spark.createDataFrame(rows, SCHEMA), keep_text=True)
    by = {(r.doc_id, r.n_bytes): (r.n_removed, r.n_spans, bytes(r.kept) if r.kept is not None else None) for r in df.collect()}
    assert df.count() == 5
    assert by[3, 304] == (0, 0, (p + "tail").encode())
    assert by[5, 300] == (300, 1, b"") and by[None, 300][:2] == (300, 1)


def test_extra_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "x" * 150, 1, 2)], SCHEMA + ", k long, tid long")
    assert got(R.remove_repeats(docs))[1][1:3] == (149, 1)
    assert R.remove_repeats(docs.limit(0)).count() == 0


def test_groups_hold_all_occurrences(spark):
    rows = corpus(4, n=30)
    corpus_ = R.Corpus(spark.createDataFrame(rows, SCHEMA))
    ids = {r.tid: r["first"]["id"] for r in corpus_.firsts.collect()}
    texts = {i: (t or "").encode() for i, t in rows}
    groups = {}
    for r in corpus_.repeat_groups().collect():
        groups.setdefault(r.repeat, (r.n_bytes, set()))[1].add((ids[r.tid], r.start))
    covered = {}
    for length, places in groups.values():
        strings = {texts[d][s : s + length] for d, s in places}
        assert length >= 100 and len(places) > 1 and len(strings) == 1 and len(strings.pop()) == length
        for d, s in places:
            for o in range(length - 99):
                covered.setdefault((d, s + o), set()).update((x, y + o) for x, y in places)
    where = {}
    for d in set(ids.values()):
        for p in range(len(texts[d]) - 99):
            where.setdefault(texts[d][p : p + 100], set()).add((d, p))
    for places in where.values():
        if len(places) > 1:
            assert all(places <= covered.get(x, set()) for x in places)


def test_groups_of_crowded_cores_are_the_same(spark):
    """Counted instead of sorted: the same maximal repeats, with the members of all classes."""
    rng = random.Random(11)

    def noise(k):
        return "".join(rng.choice("abcdefgh") for _ in range(k))

    phrase, ends = noise(140), [noise(30) for _ in range(3)]
    inner = phrase[20:125]
    texts = [noise(150) + rng.choice(ends) + rng.choice([phrase, inner]) + rng.choice(ends) + noise(150) for _ in range(12)]
    # One class of many equal contexts, which stand in different documents.
    texts += [noise(20 + i) + ends[0] + "x" * 40 + phrase + "y" * 40 + noise(130) for i in range(20)]
    rows = corpus(4, n=30)
    rows += [(len(rows) + i, t) for i, t in enumerate(texts)]
    found = []
    for limit in (R.SORT_LIMIT, 1):
        whole = R.Corpus(spark.createDataFrame(rows, SCHEMA), sort_limit=limit)
        ids = {r.tid: r["first"]["id"] for r in whole.firsts.collect()}
        found.append(sorted((r.repeat, r.n_bytes, ids[r.tid], r.start) for r in whole.repeat_groups().collect()))
    data = {i: (t or "").encode() for i, t in rows}
    assert found[1] == found[0] and len(found[0]) == len(set(found[0]))
    groups = {}
    for repeat, length, doc, start in found[1]:
        if "/" not in repeat:
            assert hashlib.md5(data[doc][start : start + length]).hexdigest() == repeat
            groups.setdefault((repeat, length), set()).add((doc, start))
    assert any(length > 100 and len(places) > 20 for (_, length), places in groups.items())


def test_intervals_are_maximal_and_complete():
    texts = [b"xabcabcabcy", b"qabcabcr", b"abcabc", b"zabcz"]
    found = R.suffix_intervals(texts, 3)
    owner, start = next(found)
    groups = {}
    for length, members in found:
        places = {(int(owner[m]), int(start[m])) for m in members}
        strings = {texts[o][s : s + length] for o, s in places}
        assert len(strings) == 1
        groups[strings.pop()] = places
    for s, places in groups.items():
        every = {(i, p) for i, t in enumerate(texts) for p in range(len(t) - 2) if t.startswith(s, p)}
        assert places == every
    assert {b"abc", b"abcabc"} <= set(groups) and b"bcabc" not in groups
