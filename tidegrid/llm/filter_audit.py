"""What each of several filters removes, in every order in which they may be applied.

Each row has a mask of the filters that it fails. Spark counts the masks of each part of the table;
whatever the size of a part, no more than ``2 ** filters`` rows of it are left. From these
a part's decision diagram is built, which carries the counts. Orders follow one another by swaps
of two adjacent levels, and the path of the rows that pass everything tells each order's steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Weights = tuple[int, ...]


class Diagram:
    """Counts of failure masks as a diagram with one level for each filter, in any order.

    A node stands for the rows that took the same way through the levels above, or other ways that leave
    the same counts: equal parts are shared. It has a child for the rows that pass its level's
    filter and one for those that fail it, and the sum of their counts. No level is left out on any path.
    """

    def __init__(self, masks: dict[int, Weights], filters: int, weights: int):
        self.order = list(range(filters))
        self.zero: Weights = (0,) * weights
        self.weight: list[Weights] = []
        self.children: list[tuple[int, int] | None] = []
        self.levels: list[dict[tuple[int, int], int]] = [{} for _ in range(filters)]
        self._leaves: dict[Weights, int] = {}
        self.root = self._built(masks, 0, 0)

    def _leaf(self, weight: Weights) -> int:
        if weight not in self._leaves:
            self._leaves[weight] = self._new(weight, None)
        return self._leaves[weight]

    def _new(self, weight: Weights, children: tuple[int, int] | None) -> int:
        self.weight.append(weight)
        self.children.append(children)
        return len(self.weight) - 1

    def _node(self, level: int, passing: int, failing: int) -> int:
        """The node of a level with these children, made only if there is none."""
        known = self.levels[level]
        if (passing, failing) not in known:
            weight = tuple(a + b for a, b in zip(self.weight[passing], self.weight[failing]))
            known[passing, failing] = self._new(weight, (passing, failing))
        return known[passing, failing]

    def _built(self, masks: dict[int, Weights], level: int, mask: int) -> int:
        if level == len(self.levels):
            return self._leaf(masks.get(mask, self.zero))
        passing = self._built(masks, level + 1, mask)
        return self._node(level, passing, self._built(masks, level + 1, mask | 1 << level))

    def swap(self, level: int) -> None:
        """Exchange the filters of a level and the next one. Nodes above keep their children.

        A node of the upper level stays the node of the same rows; only its children are made anew, of its grandchildren.
        """
        upper = self.levels[level]
        self.levels[level], self.levels[level + 1] = {}, {}
        for (passing, failing), node in upper.items():
            (pp, pf), (fp, ff) = self.children[passing], self.children[failing]
            pair = self._node(level + 1, pp, fp), self._node(level + 1, pf, ff)
            self.children[node] = pair
            self.levels[level][pair] = node
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> list[tuple[int, Weights, Weights]]:
        """(filter, kept, removed) of each level on the path of the rows that pass all before."""
        node, out = self.root, []
        for f in self.order:
            passing, failing = self.children[node]
            out.append((f, self.weight[passing], self.weight[failing]))
            node = passing
        return out

    def orders(self) -> Iterator[list[tuple[int, Weights, Weights]]]:
        """The steps of every order once, each one swap of adjacent levels from the one before."""
        yield self.steps()
        for level in adjacent_swaps(len(self.order)):
            self.swap(level)
            yield self.steps()


def adjacent_swaps(n: int) -> Iterator[int]:
    """Places whose exchange with the next one, one after another, runs through all orders of ``n``.

    The largest item sweeps through each order of the others, to and fro; between two sweeps
    it stands at an end, and the others make one move of their own.
    """
    if n < 2:
        return
    inner, down = adjacent_swaps(n - 1), True
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        move = next(inner, None)
        if move is None:
            return
        yield move + 1 if down else move
        down = not down


STEP = "filter_order string, step int, kept long, removed long, redundant long, unique_fails long, {lost}shapley long"


def audit_steps(masks: dict[int, Weights], names: list[str], weights: int) -> Iterator[tuple]:
    """``(order, step, kept, removed, redundant, unique fails, other weights removed..., shapley)``.

    What a filter removes as the first one is all it fails; as the last one, what it alone fails.
    """
    orders = list(Diagram(masks, len(names), weights).orders())
    fails, alone, total = ([0] * len(names) for _ in range(3))
    for steps in orders:
        for place, (f, _, removed) in enumerate(steps):
            total[f] += removed[0]
            if place == 0:
                fails[f] = removed[0]
            if place == len(names) - 1:
                alone[f] = removed[0]
    for steps in orders:
        order = "".join(names[f] for f, _, _ in steps)
        for place, (f, kept, removed) in enumerate(steps):
            yield (order, place + 1, kept[0], removed[0], fails[f] - removed[0], alone[f], *removed[1:], total[f])


def audit(
    rows: DataFrame, part: Column, fails: dict[str, Column], marks: dict[str, Column] | None = None
) -> DataFrame:
    """One row for each part, order of the filters and step in it.

    ``fails`` names the filters, by one letter each, and says whether a row fails them; null counts as passing. ``marks``
    names columns that count the removed rows of a kind, besides all of them. ``part`` (null:
    empty string) splits the table. Repeated rows count as often as they come. An empty table has no parts. Only the
    counts leave the tasks that read the rows, so that a part may hold any share of them.

    Columns: ``part, filter_order, step, kept, removed, redundant, unique_fails, <marks>, shapley``.
    ``redundant`` rows fail the step's filter but were removed before, ``unique_fails`` fail it alone, and
    ``shapley`` is what the filter removes, summed over all orders.
    """
    marks, names = marks or {}, list(fails)
    failed = [F.when(fail, 1 << i).otherwise(0) for i, fail in enumerate(fails.values())]
    flags = [F.coalesce(c, F.lit(False)).alias(f"flag{i}") for i, c in enumerate(marks.values())]
    kinds = [F.count_if(F.col(f"flag{i}")) for i in range(len(flags))]
    counted = (
        rows.select(F.coalesce(part.cast("string"), F.lit("")).alias("part"), sum(failed, F.lit(0)).alias("mask"), *flags)
        .groupBy("part", "mask")
        .agg(F.array(F.count("*"), *kinds).alias("weight"))
        .groupBy("part")
        .agg(F.collect_list(F.struct("mask", "weight")).alias("masks"))
    )
    lost, weights = "".join(f"`{name}` long, " for name in marks), 1 + len(marks)
    out_names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", *marks, "shapley"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                masks = {m["mask"]: tuple(m["weight"]) for m in row["masks"]}
                steps = list(audit_steps(masks, names, weights))
                columns = [pa.array([row["part"]] * len(steps)), *map(pa.array, zip(*steps))]
                columns[2] = columns[2].cast(pa.int32())
                yield pa.RecordBatch.from_arrays(columns, names=out_names)

    return counted.mapInArrow(run, f"part string, {STEP.format(lost=lost)}")


SPACES = r"[\x20\x09-\x0D]+"
SHOUTED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def document_fails(text: Column, repeated: Column) -> dict[str, Column]:
    """The five filters for documents: short, repetitive, shouted, with signs, and copied (``repeated``)."""
    words = F.array_remove(F.split(text, SPACES), "")
    return {
        "A": F.size(words) < 100,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
        "C": (F.length(text) - F.length(F.translate(text, SHOUTED, ""))) * 100 > F.length(text) * 10,
        "D": text.rlike("[#$%&*|]"),
        "E": repeated,
    }


def text_key(text: Column) -> Column:
    """Stands for a text where texts are compared: its 256-bit hash and its length."""
    return F.concat_ws("-", F.sha2(text, 256), F.octet_length(text))


def with_repeated(rows: DataFrame, id_col: str, key_col: str, name: str) -> DataFrame:
    """``rows`` with a column that says whether their key is that of a row with a smaller id.

    Rows without an id repeat nothing and are repeated by nothing. Rows meet the first id of
    their key by (key, id), so that a key that a large part of the table has is not gathered in one task.
    """
    known = rows.where(F.col(id_col).isNotNull())
    firsts = known.groupBy(F.col(key_col).alias("_key")).agg(F.min(id_col).alias("_first"))
    first = (F.col(key_col) == F.col("_key")) & (F.col(id_col) == F.col("_first"))
    repeated = F.col("_key").isNull() & F.col(id_col).isNotNull()
    return rows.join(firsts, first, "left").withColumn(name, repeated).drop("_key", "_first")


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """:func:`audit` of :func:`document_fails` by language, with the good and toxic documents lost.

    A null text is empty. A document is good (toxic) if any label of its id says so. Columns other
    than ``doc_id``, ``text``, ``lang``, and ``quality`` and ``toxic`` of the labels are ignored.
    Texts are read once; the masks, the key of a text and the ids are all that is shuffled.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    read = docs.select("doc_id", "lang", text.alias("text"))
    own = document_fails(F.col("text"), F.col("repeated"))
    masks = [fail.alias(f"fails_{f}") for f, fail in own.items() if f != "E"]
    narrow = read.select("doc_id", "lang", *masks, text_key(F.col("text")).alias("key"))
    flagged = with_repeated(narrow, "doc_id", "key", "fails_E")
    marked = labels.groupBy(F.col("doc_id").alias("labelled")).agg(
        F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic")
    )
    rows = flagged.join(marked, F.col("doc_id") == F.col("labelled"), "left")
    fails = {f: F.col(f"fails_{f}") for f in own}
    return audit(rows, F.col("lang"), fails, {"good_lost": F.col("good"), "toxic_lost": F.col("toxic")})
