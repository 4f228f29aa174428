import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tidegrid.llm import near_dedup as N
from tidegrid.llm.graph import components

SPACES = " \t\n\x0b\x0c\r"


def fingerprint(text):
    """The definition, word by word."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for s in SPACES:
        lowered = lowered.replace(s, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(prints, distance=3):
    """Component of every fingerprint by comparing all pairs."""
    parent = {p: p for p in prints}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in combinations(parent, 2):
        if (a ^ b).bit_count() <= distance:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in parent}


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def sample():
    rng = random.Random(5)
    vocabulary = ["wind", "Öl", "river", "stone", "salt", "the", "of", "über", "night", "glass", "Moon"]
    texts = []
    for _ in range(60):
        n = rng.choice([0, 1, 2, 3, 4, 9, 60, 300])
        texts.append("".join(rng.choice(vocabulary) + rng.choice([" ", "  ", "\n", " \t", " ", "\r\n"]) for _ in range(n)))
    for t in texts[:30]:
        texts.append(t + rng.choice(["", " end", " of the"]))
    return [*texts, None, "", "\n \t", "x" * 200_000, "a b c d e f g " * 30_000]


def test_fingerprints_equal_the_definition(spark):
    texts = sample()
    got = N.near_duplicates(frame(spark, list(enumerate(texts)))).collect()
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == {i: fingerprint(t) for i, t in enumerate(texts)}


def test_components_equal_all_pairs(spark):
    texts = sample()
    texts += texts[:20]
    want_root = roots({fingerprint(t) for t in texts})
    least = {}
    for i, t in enumerate(texts):
        root = want_root[fingerprint(t)]
        least[root] = min(least.get(root, i), i)
    for limit in (N.RUN_LIMIT, 1):
        got = N.near_duplicates(frame(spark, list(enumerate(texts))), run_limit=limit).collect()
        assert {r.doc_id: r.component_id for r in got} == {
            i: least[want_root[fingerprint(t)]] for i, t in enumerate(texts)
        }


def clustered(rng, centres, each, bits):
    prints = set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(each):
            p = centre
            for b in rng.sample(range(64), rng.randrange(bits + 1)):
                p ^= 1 << b
            prints.add(p)
    return sorted(prints)


@pytest.mark.parametrize("limit", [N.RUN_LIMIT, 100])
@pytest.mark.parametrize("distance,segments", [(3, 8), (1, 4), (3, 5), (5, 12)])
def test_links_connect_what_all_pairs_connect(spark, limit, distance, segments):
    if limit == 100 and distance > 3:
        pytest.skip("neighbourhoods of this radius are too many for a test")
    prints = clustered(random.Random(distance), 6, 250, 3 if limit == 100 else 5)
    signed = [(p - 2**64 if p >> 63 else p,) for p in prints[:: 3 if limit == 100 else 1]]
    prints = [p[0] % 2**64 for p in signed]
    links = N.links(spark.createDataFrame(signed, "_fp long"), distance, segments, limit)
    rows = [(r.a % 2**64, r.b % 2**64) for r in links.collect()]
    assert all((a ^ b).bit_count() <= distance for a, b in rows)
    got = {r.node % 2**64: r.root for r in components(links).collect()}
    want = roots(prints, distance)
    groups, expected = {}, {}
    for p in prints:
        groups.setdefault(got.get(p, p - 2**64 if p >> 63 else p), set()).add(p)
        expected.setdefault(want[p], set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_every_pair_within_the_distance_passes_some_chain():
    rng = random.Random(1)
    for distance, segments in ((3, 8), (1, 2), (7, 16), (2, 64)):
        ring = N.Ring(distance, segments)
        for _ in range(300):
            differ = sum(1 << b for b in rng.sample(range(64), rng.randrange(distance + 1)))
            shared = [k for k, (_, mask) in enumerate(ring.keys) if not differ & mask]
            assert any(ring.linked(k, np.array([differ], np.uint64))[0] for k in shared)


def test_overlong_runs_may_span_batches():
    prints = np.arange(50, dtype=np.int64)
    key = np.zeros(50, dtype=np.int32)
    batches = [
        pa.RecordBatch.from_arrays([pa.array(key[s : s + 7]), pa.array(key[s : s + 7].astype(np.int64)), pa.array(prints[s : s + 7])], names=["k", "v", "p"])
        for s in range(0, 50, 7)
    ]
    out = pa.Table.from_batches(list(N._links_in_runs(N.Ring(3, 8), iter(batches), 10)))
    assert sorted(out["a"].to_pylist()) == list(range(50)) and out["b"].null_count == 50


def test_components_of_paths_stars_and_loops(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 260)]
    edges = spark.createDataFrame([*path, *star, (5, 5), (300, 299), (300, 299), (None, 4)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {i: 7 for i in [7, *range(200, 260)]} | {5: 5, 299: 299, 300: 299}
    assert components(edges.limit(0)).count() == 0


def test_deduplicate_keeps_the_first_of_each_group(spark):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [
        (4, long, "a", 1), (2, long, "b", 2), (2, long, "b", 2), (None, long, "c", 3),
        (9, "", "d", 4), (8, None, "e", 5), (None, "alone and only here", "f", 6), (None, "alone and only here", "f", 6),
        (2, "the same id with another text", "g", 7),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _fp string, _own_hash int")
    got = N.deduplicate(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [rows[1], rows[5], rows[6], rows[8]], key=str
    )
    assert N.deduplicate(docs.limit(0)).count() == 0
