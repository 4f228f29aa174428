import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidegrid.llm import elias_fano
from tidegrid.llm import token_files as T
from tidegrid.llm.text import text_bytes

PATH = public_tokenizers.path("word_bpe_49k.json")
END = 2


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=1500), st.sampled_from([1, 2**20, 2**38]))
def test_any_range_of_a_sequence_comes_back(values, shrink):
    values = np.sort(np.array(values, dtype=np.uint64) // np.uint64(shrink))
    coded, end = elias_fano.EliasFano.from_bytes(b"xyz" + elias_fano.EliasFano.encode(values).to_bytes() + b"rest", 3)
    assert len(coded) == len(values) and end > 3
    rng = random.Random(len(values))
    for _ in range(12):
        lo = rng.randrange(len(values) + 1)
        hi = rng.randrange(lo, len(values) + 1)
        assert (coded.select_range(lo, hi) == values[lo:hi]).all()
    assert all(coded.select(i) == values[i] for i in range(0, len(values), 97))


def test_size_is_near_the_least():
    lengths = np.random.default_rng(1).geometric(1 / 600, 200_000)
    values = np.cumsum(lengths)
    coded = elias_fano.EliasFano.encode(values)
    assert coded.bits / len(values) < 2.2 + np.log2(values[-1] / len(values)) < 13 < 64
    assert (coded.select_range(0, len(values)) == values).all()


def test_falling_values_and_ranges_outside_are_refused():
    with pytest.raises(ValueError):
        elias_fano.EliasFano.encode(np.array([3, 2]))
    with pytest.raises(IndexError):
        elias_fano.EliasFano.encode(np.array([3, 3])).select(2)


def texts():
    rng = random.Random(11)
    out = ["", " ", "Hello, World's <|endoftext|>x it's'll 12345", "É é ǅ ΑΣ ΑΣ. İ ﬁ", "a b　c\x0bd\x0ce\x1cf\x85g", "́ ́a", "!\x0b!", "J\u030cA\u030a I\u0307.x Ab.Cd,e;f!? .A. don't.'s it,'s Éa.B <|ENDOFTEXT|> ß.ß", "中文字 😀‍😀\x00\x7f"]
    alphabet = "abcABCJ\u030c'’s  \n\t\x0b\x0c\r  é́ß0123.,!?#<|>😀中ال"
    out += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(600)]
    return out


def test_words_alone_equal_whole_texts():
    tokenizer = Tokenizer.from_file(PATH)
    column = pa.array([*texts(), None])
    assert T.described(PATH) == (49408, True)
    plain = pa.array([t for t in column.to_pylist() if "<" not in (t or "")])
    for texts_of, lower in ((column, True), (column, False), (plain, True), (plain, True)):
        ids, counts = T.encode_texts(*text_bytes(texts_of), T.word_encoder(PATH), lower)
        want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts_of.to_pylist()]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def brute(rows):
    """Rows of the digest, of documents in the order of their ids (all different)."""
    tokenizer, out, start = Tokenizer.from_file(PATH), [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, END]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def digest(df):
    got = df.select("doc_id", "start", "n_tokens", F.crc32("ids")).collect()
    return sorted(map(tuple, got), key=lambda r: r[1])


def test_files_equal_brute_force(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.randrange(-(2**62), 2**62), t) for t in texts()] + [(None, "without an id"), (5, None), (6, "word " * 300_000)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, ids int, file string").repartition(5)
    manifest = T.write_tokens(docs, str(tmp_path / "t"), PATH, END)
    assert manifest.count() > 1 and manifest.agg(F.sum("docs")).first()[0] == len(rows)
    assert {r.width for r in manifest.collect()} == {2}
    assert digest(T.read_tokens(spark, str(tmp_path / "t"))) == brute(rows)


def test_query_equals_brute_force(spark):
    from tidegrid.llm.queries import token_files_query

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = token_files_query(spark, sf)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == brute(rows)


def test_repeated_rows_and_ids(spark, tmp_path):
    rows = [(7, "same text")] * 400 + [(7, "other"), (8, "same text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    T.write_tokens(docs, str(tmp_path / "a"), PATH, END)
    got = digest(T.read_tokens(spark, str(tmp_path / "a")))
    assert [r[0] for r in got] == [7] * 401 + [8]
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
    want = {r[3] for r in brute([(1, "same text"), (2, "other")])}
    assert {r[3] for r in got} == want and sum(r[3] == got[-1][3] for r in got) == 401
    T.write_tokens(docs.repartition(1), str(tmp_path / "b"), PATH, END)
    assert got == digest(T.read_tokens(spark, str(tmp_path / "b")))


def test_empty_table_and_single_documents(spark, tmp_path):
    for name, rows in {"none": [], "null": [(None, None)], "one": [(1, "")]}.items():
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        T.write_tokens(docs, str(tmp_path / name), PATH, END)
        assert digest(T.read_tokens(spark, str(tmp_path / name))) == brute(rows)


def test_files_of_a_lost_attempt_are_not_read(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    T.write_tokens(docs, str(tmp_path / "t"), PATH, END)
    lost = T.PartWriter(str(tmp_path / "t"), 0, 2)
    lost.write(pa.array([1]), np.array([9]), np.array([1]))
    lost.close()
    assert T.read_tokens(spark, str(tmp_path / "t")).count() == 50
