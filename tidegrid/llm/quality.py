"""Text quality by compression with dictionaries built from good and bad texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_BYTES = 2048
#: Labelled documents of each class that the dictionaries, and as many that the calibration, may use.
SAMPLE_DOCS = 4000
#: Pieces of these documents that the dictionaries of each class are built from.
SAMPLE_PIECES = 4000
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
THRESHOLD = 0.3
#: So many bytes of a typical text are added to each, as a few bytes alone say little.
PRIOR_BYTES = 64
FOLDS = 5


def fold(id_col: str):
    """CRC-32 of the id as text, modulo 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS


def pieces(text: str | None) -> list[bytes]:
    """The whole text in pieces of bounded size."""
    data = (text or "").encode()
    return [data[i : i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]


class CompressionClassifier:
    """Scores texts by how much smaller the dictionary of good ones makes them than that of bad ones."""

    def __init__(self, bad: bytes, good: bytes, slope: float = 0.0, offset: float = 0.0, typical: float = 0.0):
        self.dictionaries, self.slope, self.offset, self.typical = (bad, good), slope, offset, typical
        self._ready = None

    def __getstate__(self):
        return self.__dict__ | {"_ready": None}

    def _compressors(self):
        if self._ready is None:
            self._ready = []
            for content in self.dictionaries:
                kind = zstandard.DICT_TYPE_AUTO if content else zstandard.DICT_TYPE_RAWCONTENT
                dictionary = zstandard.ZstdCompressionDict(content, dict_type=kind) if content else None
                if dictionary is not None:
                    dictionary.precompute_compress(level=LEVEL)
                self._ready.append(
                    zstandard.ZstdCompressor(
                        level=LEVEL, dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False
                    )
                )
        return self._ready

    def gain(self, text: str | None) -> tuple[int, int]:
        """Bytes that the good dictionary saves over the bad one, and bytes of the whole text."""
        bad, good = self._compressors()
        parts = pieces(text)
        return sum(len(bad.compress(p)) - len(good.compress(p)) for p in parts), sum(map(len, parts))

    def normalised(self, gain, size):
        """Gain for each byte, with a prior of ``PRIOR_BYTES`` typical ones."""
        return (np.asarray(gain) + PRIOR_BYTES * self.typical) / (np.asarray(size) + PRIOR_BYTES)

    def difference(self, text: str | None) -> float:
        return float(self.normalised(*self.gain(text)))

    def probability(self, differences) -> np.ndarray:
        z = self.slope * np.asarray(differences, dtype=float) + self.offset
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def _dictionary(samples: list[bytes]) -> bytes:
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to select from
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps with a slight pull towards zero."""
    if not len(x) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return 0.0, float(np.log(share / (1 - share)))
    scale = float(np.abs(x).max()) or 1.0
    design = np.stack([x / scale, np.ones(len(x))], axis=1)
    beta = np.zeros(2)
    ridge = np.diag([1e-3, 1e-6])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -500, 500)))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + ridge
        step = np.linalg.solve(hessian, design.T @ (y - p) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-10:
            break
    return float(beta[0] / scale), float(beta[1])


def _sampled(labels: DataFrame, id_col: str, label_col: str, folds: tuple[int, ...], n: int) -> list:
    """Ids and labels of up to ``n`` labelled rows of each class, drawn by a hash of the id."""
    rows = labels.where(F.col(id_col).isNotNull() & fold(id_col).isin(*folds))
    drawn = []
    for label in (0, 1):
        one = rows.where(F.col(label_col) == label).select(F.col(id_col).alias("_id")).distinct()
        drawn += [(r["_id"], label) for r in one.orderBy(F.xxhash64("_id"), "_id").limit(n).collect()]
    return drawn


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_docs: int = SAMPLE_DOCS,
    sample_pieces: int = SAMPLE_PIECES,
) -> CompressionClassifier:
    """A classifier fitted on labelled documents whose fold is not 0; fold 0 is held out.

    Folds 1 and 2 give the dictionaries, folds 3 and 4 the calibration, each from at most
    ``sample_docs`` documents of either class. Null labels and ids are left out, labels other than 0
    and 1 ignored, and a document with both labels counts for both. Without labels of both classes
    every text gets the same score.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = dict(labels.dtypes)[id_col]

    def texts(folds: tuple[int, ...]) -> DataFrame:
        drawn = spark.createDataFrame(_sampled(labels, id_col, label_col, folds, sample_docs), f"_id {kind}, _label int")
        return rows.join(F.broadcast(drawn), "_id")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = batch.assign(piece=[pieces(t) for t in batch["_text"]]).explode("piece").dropna(subset=["piece"])
            yield parts[["_label", "piece"]]

    parts = texts((1, 2)).mapInPandas(cut, "_label int, piece binary").withColumn("_order", F.xxhash64("piece"))
    samples = []
    for label in (0, 1):
        drawn = parts.where(F.col("_label") == label).groupBy("_order").agg(F.any_value("piece").alias("piece"))
        samples.append([bytes(r.piece) for r in drawn.orderBy("_order").limit(sample_pieces).collect()])
    model = CompressionClassifier(_dictionary(samples[0]), _dictionary(samples[1]))

    @F.pandas_udf("gain long, size long")
    def measure(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.gain(t) for t in text], columns=["gain", "size"], dtype="int64")

    measured = texts((3, 4)).select("_label", measure("_text").alias("m"), F.xxhash64("_id", "_text").alias("_order"))
    rated = measured.orderBy("_order").limit(4 * sample_docs).collect()
    gain, size = (np.array([r.m[i] for r in rated], dtype=float) for i in (0, 1))
    model.typical = float(gain.sum() / max(size.sum(), 1))
    model.slope, model.offset = _calibrate(
        model.normalised(gain, size), np.array([r["_label"] for r in rated], dtype=float)
    )
    return model


def score_column(model: CompressionClassifier, text_col: str = "text"):
    """The calibrated score (0 to 1) of each whole text; null counts as empty."""

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(model.probability([model.difference(t) for t in text]), dtype=float)

    return score(F.col(text_col).cast("string"))


def scores(docs: DataFrame, model: CompressionClassifier, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(id, held_out, score, predicted)`` for every document; repeated rows are scored alike."""
    rows = docs.select(F.col(id_col).alias("_id"), score_column(model, text_col).alias("score"))
    return rows.select(
        F.col("_id").alias(id_col),
        (fold("_id") == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: CompressionClassifier, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are predicted to be good, with all their columns."""
    return docs.where(score_column(model, text_col) >= threshold)
