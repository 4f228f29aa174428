import os
import random

import pytest
from tokenizers import Tokenizer, models

from tidegrid.llm import token_counts as K

pytestmark = pytest.mark.skipif(not os.path.exists(K.VOCABULARY), reason="no vocabulary")


def tokenizer(vocabulary, byte_fallback=True):
    return Tokenizer(models.Unigram(vocabulary, 0, byte_fallback))


def counted(reference, text):
    return len(reference.encode(K.MARK + text.replace(" ", K.MARK), add_special_tokens=False).ids) if text else 0


def texts():
    rng = random.Random(4)
    alphabet = "etaoinshrd    \n\tÄöß▁, .;0123<>é中文😀́" + "\x00\x7f"
    out = ["", "a", " ", "  ", "▁", "\n", "hello world", "Hello  World ", "x" * 5000, "the quick brown fox " * 300, "<0x0A> <s> </s>"]
    out += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 80))) for _ in range(400)]
    words = ["the", "information", "tion", "ing", "unbelievable", "1234", "über", "naïve"]
    out += [" ".join(rng.choice(words) for _ in range(rng.randrange(40))) for _ in range(100)]
    return out


def test_counts_equal_the_tokenizer():
    vocabulary = K.read_vocabulary()
    counter, reference = K.UnigramCounter(vocabulary), tokenizer(vocabulary)
    assert counter.by_word
    for text in texts():
        assert counter.count(text)[0] == counted(reference, text), text


def test_words_alone_equal_the_whole_text():
    counter = K.UnigramCounter(K.read_vocabulary())
    for text in texts():
        if text:
            assert counter.count(text) == counter.solve(K.MARK + text.replace(" ", K.MARK))


@pytest.mark.parametrize("seed", range(5))
def test_ties_and_unknown_runs_without_byte_pieces(seed):
    rng = random.Random(seed)
    pieces = {"".join(rng.choice("ab▁") for _ in range(rng.randrange(1, 5))) for _ in range(14)}
    vocabulary = [("<unk>", 0.0)] + [(p, -float(rng.randrange(1, 6))) for p in sorted(pieces)]
    counter, reference = K.UnigramCounter(vocabulary), tokenizer(vocabulary, False)
    for _ in range(300):
        text = "".join(rng.choice("abbc d") for _ in range(rng.randrange(1, 15)))
        assert counter.count(text)[0] == counted(reference, text), (text, vocabulary)


def test_odd_rows(spark):
    rows = [(None, "a b", 1), (2**60 + 1, None, 2), (3, "", 3), (3, "", 3), (4, "word " * 50_000, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = K.count_tokens(docs, K.read_vocabulary())
    assert got.columns == ["doc_id", "n_tokens", "score"]
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append(r.n_tokens)
    assert by[None] == [2] and by[2**60 + 1] == [0] and by[3] == [0, 0] and by[4][0] >= 50_000
    assert K.count_tokens(docs.limit(0), K.read_vocabulary()).count() == 0


def test_the_memory_of_segments_is_bounded(monkeypatch):
    monkeypatch.setattr(K, "MEMO_SEGMENTS", 10)
    counter = K.UnigramCounter(K.read_vocabulary())
    text = " ".join(f"w{i}" for i in range(100))
    assert counter.count(text) == counter.solve(K.MARK + text.replace(" ", K.MARK))
    assert len(counter._memo) <= 10
