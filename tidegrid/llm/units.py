"""Token ids of texts, encoding each distinct unit (a stretch that no token crosses) only once."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa

#: By default, the units that are known are forgotten when they have so many characters in all.
MEMO_CHARS = 8 << 20


def units_at(data: np.ndarray, starts: np.ndarray) -> pa.LargeStringArray:
    """The stretches of UTF-8 ``data`` from each start to the next one, without a copy."""
    offsets = np.append(starts, len(data)).astype(np.int64)
    return pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))
    )


Lists = tuple[np.ndarray, np.ndarray]
Encode = Callable[[list[str]], Sequence[Sequence[int]]]


def flat(lists: Sequence[Sequence[int]]) -> Lists:
    """The numbers of all lists one after another, and the size of each list."""
    sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return np.fromiter(chain.from_iterable(lists), dtype=np.int32, count=int(sizes.sum())), sizes


def one_by_one(encode: Encode) -> Callable[[list[str]], Iterable[tuple[list[str], Lists]]]:
    return lambda units: [(units, flat(encode(units)))]


def together(
    encode: Encode,
    cut: Callable[[np.ndarray, list[str]], np.ndarray | None],
    group: int = 256,
) -> Callable[[list[str]], Iterable[tuple[list[str], Lists]]]:
    """Encodes units in groups, each as one string, which takes less time than as many short ones.

    ``cut`` tells behind how many of the ids of a group each unit ends, or nothing if they don't
    fall into that many units; then these are encoded one by one.
    """

    def run(units: list[str]) -> Iterable[tuple[list[str], Lists]]:
        groups = [units[i : i + group] for i in range(0, len(units), group)]
        for mine, ids in zip(groups, encode(["".join(g) for g in groups])):
            ids = np.asarray(ids, dtype=np.int32)
            ends = cut(ids, mine)
            yield mine, flat(encode(mine)) if ends is None else (ids, np.diff(ends, prepend=0))

    return run


class UnitEncoder:
    """The ids of units by one or several tokenizers; what was found lately is remembered.

    Each of ``encoders`` gives the ids of many strings, in parts of any size; the order of the strings is
    free but the same for all. The ids of remembered units stand one after another in one array for each tokenizer, so
    that those of a text are gathered by array operations, not one by one.
    """

    def __init__(self, *encoders: Callable[[list[str]], Iterable[tuple[list[str], Lists]]], memo_chars: int = MEMO_CHARS):
        self.encoders, self.memo_chars = encoders, memo_chars
        self.forget()

    def forget(self) -> None:
        self._memo: dict[str, int] = {}
        self._chars = 0
        self._ids = [np.zeros(0, dtype=np.int32)] * len(self.encoders)
        self._ends = [np.zeros(1, dtype=np.int64)] * len(self.encoders)

    def _learn(self, texts: list[str]) -> None:
        for side, encode in enumerate(self.encoders):
            ids, sizes, order = [self._ids[side]], [], []
            for units, (found, counts) in encode(texts):
                order += units
                ids.append(found)
                sizes.append(counts)
            self._ids[side] = np.concatenate(ids)
            ends = self._ends[side]
            self._ends[side] = np.concatenate([ends, ends[-1] + np.cumsum(np.concatenate(sizes))])
        first = len(self._memo)
        self._memo.update(zip(order, range(first, first + len(order))))
        self._chars += sum(map(len, texts))

    def ids(self, units: list[str]) -> list[pa.ListArray]:
        """The ids of each of the strings (no two alike), one list a string, for each tokenizer."""
        if self._chars > self.memo_chars:
            self.forget()
        at = np.fromiter((self._memo.get(u, -1) for u in units), dtype=np.int64, count=len(units))
        new = np.flatnonzero(at < 0)
        if len(new):
            fresh = [units[i] for i in new.tolist()]
            self._learn(fresh)
            at[new] = [self._memo[u] for u in fresh]
        places = pa.array(at)
        return [
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)).take(places)
            for ends, ids in zip(self._ends, self._ids)
        ]
