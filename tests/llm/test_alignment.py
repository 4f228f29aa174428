import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidegrid.llm import alignment as A
from tidegrid.llm.text import text_bytes

LEFT = A.Side("byte_level", public_tokenizers.path("byte_bpe_50k.json"))
RIGHT = A.Side("pieces", public_tokenizers.path("piece_bpe_32k.model"))


def spellings():
    """Ids of whole texts and the bytes of each id, straight from the two libraries."""
    left = Tokenizer.from_file(LEFT.path)
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=RIGHT.path)
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in keep}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in keep)}

    def spell_left(i):
        return bytes(byte_of[c] for c in left.id_to_token(i))

    def spell_right(i):
        piece = right.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if right.is_byte(i) else piece.replace("▁", " ").encode()

    return left, right, spell_left, spell_right


def brute(rows):
    left, right, spell_left, spell_right = spellings()
    docs, held = [], Counter()
    for doc_id, text in rows:
        a = left.encode(" " + text, add_special_tokens=False).ids if text else []
        b = right.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        if not text or b"".join(map(spell_left, a)) != raw or b"".join(map(spell_right, b)) != raw:
            a, b = [], []
        groups, i, j, ends = [], 0, 0, [0, 0]
        while i < len(a):
            group = ([], [])
            while not group[0] or ends[0] != ends[1]:
                if not group[0] or ends[0] < ends[1]:
                    group[0].append(a[i])
                    ends[0] += len(spell_left(a[i]))
                    i += 1
                else:
                    group[1].append(b[j])
                    ends[1] += len(spell_right(b[j]))
                    j += 1
            groups.append(group)
        links = Counter((x, y) for g, h in groups for x in g for y in h)
        held.update(links.keys())
        docs.append((doc_id, len(a), len(b), groups, links))
    highest = Counter()
    for (x, _), n in held.items():
        highest[x] = max(highest[x], n)
    out = []
    for doc_id, n_a, n_b, groups, links in docs:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((
            doc_id, n_a, n_b, len(groups), sum(links.values()),
            sum(n for p, n in links.items() if held[p] == highest[p[0]]), sum(n * held[p] for p, n in links.items()), text,
        ))
    return out, {(x, y): (n, n == highest[x]) for (x, y), n in held.items()}


def texts():
    rng = random.Random(8)
    out = [
        "", " ", "  ", "a", "a ", "a  ", " a", "\n", "a\n b", "▁", "a ▁b", "x▁", "<|endoftext|> </s> <s> <unk> <0x41>",
        "l'été — où ça ?", "a  b", "a　 b", "a\x1c b\x85 c\x7f d", "- " * 300, "-" * 3000, "ab" * 700, "\x00 \x00",
        "é ́x", "😀 👩‍👩‍👧 中文 字", "don't I'll 's", " \t \r\n  x", "=" * 77 + " " * 50 + "x",
    ]
    alphabet = "abcdeé中😀▁    \n\t.,'’-–019 AZß"
    out += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 70))) for _ in range(500)]
    words = ["the", "tokenization", "über", "naïve", "1234567", "foo_bar", "—", "don't", "x" * 40]
    out += [" ".join(rng.choice(words) for _ in range(rng.randrange(60))) for _ in range(100)]
    return out


def hashed(text):
    return hashlib.sha256(text.encode()).hexdigest() if text else ""


def test_results_equal_brute_force(spark):
    rows = [(i, t) for i, t in enumerate([*texts(), None, "word " * 40_000])] + [(None, "no id"), (3, "a"), (3, "a")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, docs int, pairs string")
    want, pairs = brute(rows)
    aligned = A.align(docs.repartition(3), LEFT, RIGHT)
    got = aligned.documents()
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert {(r.a, r.b): (r.n_docs, r.best) for r in aligned.pair_counts.collect()} == pairs


def test_query_equals_brute_force(spark):
    from tidegrid.llm.queries import alignment_query

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = [(*r[:-1], hashed(r[-1])) for r in brute(rows)[0]]
    got = alignment_query(spark, sf)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sum(r[4] for r in want) > 10_000


def test_units_are_cut_only_where_both_end_a_token():
    column = pa.array(texts())
    data, offsets = A.with_space(*text_bytes(column))
    starts = A.unit_starts(data, offsets)
    assert len(starts) > 2 * len(column)
    ends = [set(), set()]
    left, right, spell_left, spell_right = spellings()
    for text, lo in zip(column.to_pylist(), offsets):
        if not text or "▁" in text:
            continue
        for seen, ids, spell in ((ends[0], left.encode(" " + text).ids, spell_left), (ends[1], right.encode(text), spell_right)):
            at = int(lo)
            for i in ids:
                seen.add(at)
                at += len(spell(i))
    marked = [i for i, t in enumerate(column.to_pylist()) if "▁" in t]
    for s in starts.tolist():
        row = int((offsets <= s).sum()) - 1
        assert row in marked or (s in ends[0] and s in ends[1]), (s, row)


def test_long_runs_do_not_multiply(spark):
    text = "-" * 200_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = A.align(docs, LEFT, RIGHT, digest=True).documents().collect()
    (want,) = brute([(1, text)])[0]
    assert tuple(row) == (*want[:-1], hashed(want[-1]))


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, ""), (2, None)]])
def test_tables_without_tokens(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    aligned = A.align(docs, LEFT, RIGHT)
    assert sorted(map(tuple, aligned.documents().collect()), key=str) == sorted([(r[0], 0, 0, 0, 0, 0, 0, "") for r in rows], key=str)
    assert aligned.pair_counts.count() == 0


def test_text_ids(spark):
    docs = spark.createDataFrame([("x", "a b"), ("y", "")], "name string, body string")
    got = A.align(docs, LEFT, RIGHT, "name", "body").documents().collect()
    assert [(r["name"], r["n_groups"]) for r in sorted(got)] == [("x", 2), ("y", 0)]


def test_a_block_is_a_small_row():
    rng = random.Random(3)
    parts = ["ation", "ver", "schl", "é", "qu", "1", "-", "x", "ung", "mente", "'s", "😀"]
    vocabulary = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 6))) for _ in range(3000)]
    column = pa.array([" ".join(rng.choice(vocabulary) for _ in range(200)) for _ in range(420)] + ["", None])
    data, offsets = text_bytes(column)
    assert len(data) <= A.BLOCK_BYTES
    per_doc, links = A.align_slab(data, offsets, LEFT, RIGHT)
    per_doc["groups"] = pa.array([hashed(g) for g in per_doc["groups"].to_pylist()])
    block = A._block(pa.array(range(len(column))), per_doc, links)
    assert links.num_rows > 40_000 and block.num_rows == 1
    assert block.nbytes < 1 << 19  # larger arrays are never moved by the garbage collector
    held = block.column("pairs")[0].values.to_numpy()
    place, n = A.unpack_links(block.column("links")[0].as_py(), links.num_rows)
    assert (held[place] >> A.HELD_BITS).tolist() == links["pair"].to_pylist()
    assert n.tolist() == links["n"].to_pylist()
    counted = Counter(links["pair"].to_pylist())
    assert {int(h) >> A.HELD_BITS: int(h) & (1 << A.HELD_BITS) - 1 for h in held} == counted


@pytest.mark.parametrize("place, n", [([], []), ([0], [1]), ([5, 3, 2**32 - 1, 0], [1, 2**62, 7, 2**40])])
def test_links_are_packed_without_loss(place, n):
    packed = A.pack_links(np.array(place, dtype=np.uint32), np.array(n, dtype=np.int64))
    got = A.unpack_links(packed, len(place))
    assert [x.tolist() for x in got] == [place, n]
