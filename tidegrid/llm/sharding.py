"""Shards and slots from a keyed permutation of global row numbers."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.ordering import in_order, row_numbers, wrapped
from tidegrid.llm.text import mix

SHARDS = 16
ROUNDS = 8
SEED = 20240229


class Feistel:
    """A permutation of 0 to ``n - 1``, computable either way for any single number.

    A number is split into two digits of bases near the square root of ``n``; each round adds a
    keyed hash of one digit to the other. The digits count a little beyond ``n``; numbers that
    end there walk on along their cycle until they are back inside.
    """

    def __init__(self, n: int, seed: int = SEED, rounds: int = ROUNDS):
        self.n, self.rounds = n, rounds
        self.high = max(1, math.isqrt(max(n - 1, 0)) + 1)
        self.low = max(1, -(-n // self.high))
        self.keys = mix(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        digits = [x // np.uint64(self.low), x % np.uint64(self.low)]
        bases = [np.uint64(self.high), np.uint64(self.low)]
        for i in reversed(range(self.rounds)) if back else range(self.rounds):
            to = i % 2
            step = mix(digits[1 - to] ^ self.keys[i]) % bases[to]
            digits[to] = (digits[to] + (bases[to] - step if back else step)) % bases[to]
        return digits[0] * bases[1] + digits[1]

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        x = self._once(np.asarray(x, dtype=np.uint64), back)
        while (outside := x >= self.n).any():
            x[outside] = self._once(x[outside], back)
        return x.astype(np.int64)

    def forward(self, x) -> np.ndarray:
        return self._walk(x, False)

    def backward(self, x) -> np.ndarray:
        return self._walk(x, True)


def shard_rows(docs: DataFrame, order: list[Column], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``docs`` in a reproducible shuffle, with ``shard`` (0 to ``shards - 1``) and ``slot``.

    Rows are numbered globally by ``order``; the permuted number divided by the number of shards
    gives the slot, its remainder the shard. Counts of shards differ by at most one and slots have
    no gaps. The same rows get the same places however they are partitioned; rows equal in ``order``
    are dealt the places of their numbers in any way. All columns stay; those named ``shard`` or
    ``slot`` are replaced. Nulls are ordered first. An empty table gives an empty result.
    """
    docs = docs.drop("shard", "slot")
    keys = [f"_key{i}" for i in range(len(order))]
    rows = docs.select(wrapped(docs), *[o.alias(k) for o, k in zip(order, keys, strict=True)])
    numbered, n = row_numbers(in_order(rows, [F.col(k) for k in keys], "_at"), "_at", "_row")
    permutation = Feistel(n, seed)

    @F.pandas_udf("long")
    def permuted(x: pd.Series) -> pd.Series:
        return pd.Series(permutation.forward(x.to_numpy()))

    placed = numbered.select("_doc", permuted("_row").alias("_place"))
    return placed.select(
        "_doc.*",
        F.expr(f"CAST(_place % {shards} AS INT)").alias("shard"),
        F.expr(f"_place DIV {shards}").alias("slot"),
    )


def locate(shard: int, slot: int, n: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """The global row number that stands at ``slot`` of ``shard``, out of ``n`` rows."""
    return int(Feistel(n, seed).backward([slot * shards + shard])[0])
