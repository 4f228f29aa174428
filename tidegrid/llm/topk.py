"""Exact search for the highest inner products, by lower bounds from distances to pivots."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.ordering import in_order, row_numbers

TOP = 20
SCALE = 64
PIVOTS = 32
#: Candidates in a block and queries in a block, each a task's share of the work.
CANDIDATES = 8192
QUERIES = 256
#: Blocks of queries that meet a block of candidates in one task.
QUERY_BLOCKS = 8
#: Candidates evaluated first, before the others that their scores leave over, and queries whose
#: limits are worked out together.
STEP = 512
TOGETHER = 32
LONG = 2**63 - 1
EXACT = 2**52


def finite(vector: Column) -> Column:
    """Whether a vector is not null and holds finite numbers only."""
    real = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(real, F.lit(False))


def whole_numbers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Components times ``scale``, rounded down."""
    big = np.finfo(np.float64).max
    return np.clip(np.floor(np.asarray(values, dtype=np.float64) * scale), -big, big)


class Block:
    """Vectors of one length with their ids, places in the table, norms and distances to pivots."""

    def __init__(self, rows: np.ndarray, ids: list, vectors: np.ndarray, pivots: np.ndarray):
        self.rows, self.vectors = rows, vectors
        self.ids = np.array([LONG if i is None else i for i in ids], dtype=np.int64)
        self.norms = np.einsum("ij,ij->i", vectors, vectors)
        self.to_pivots = distances(vectors, pivots)


def choose_pivots(vectors: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` vectors, each the farthest from those chosen before."""
    chosen = [0][: len(vectors)]
    nearest = np.full(len(vectors), np.inf)
    while chosen and len(chosen) < min(n, len(vectors)):
        nearest = np.minimum(nearest, distances(vectors, vectors[chosen[-1:]])[:, 0])
        chosen.append(int(nearest.argmax()))
    return vectors[chosen]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        squares = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :] - 2 * (a @ b.T)
        return np.sqrt(np.maximum(squares, 0))


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of ``a`` with all of ``b``, limited to 64 bits.

    Doubles hold them exactly as long as the sums of the absolute products stay below 2**52.
    """
    reach = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if reach < EXACT:
        return (a @ b.T).astype(np.int64)
    big = np.array([[int(x) for x in r] for r in a], dtype=object).reshape(a.shape) @ np.array(
        [[int(x) for x in r] for r in b], dtype=object
    ).reshape(b.shape).T
    return np.clip(big, -LONG - 1, LONG).astype(np.int64).reshape(len(a), len(b))


def search(queries: Block, candidates: Block, top: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query index, candidate indices, scores) of the best candidates of each query, itself left out.

    For every pivot the distance of query and candidate is at least the difference of their distances
    to it. With both norms the largest of these lower bounds limits the inner product from above.
    Candidates of the highest limits are evaluated first, then those whose limits reach the score of
    the last place; no other can enter.
    """
    largest = max(float(x.norms.max(initial=0)) for x in (queries, candidates))
    exact = largest < EXACT  # then sums of products are whole numbers that doubles hold
    near, far = candidates.to_pivots.astype(np.float32).T.copy(), queries.to_pivots.astype(np.float32)
    for first in range(0, len(queries.rows), TOGETHER):
        here = slice(first, first + TOGETHER)
        apart = np.zeros((len(queries.rows[here]), len(candidates.rows)), dtype=np.float32)
        for p in range(len(near) if exact else 0):
            gap = near[p] - far[here, p, None]
            np.maximum(apart, np.abs(gap, out=gap), out=apart)
        # Rounding of the distances must not lower a limit; beyond 2**52 no candidate is left out.
        apart = apart.astype(np.float64)
        limits = (queries.norms[here, None] + candidates.norms - apart * apart) / 2 + (1e-5 * largest + 1)
        limits = limits if exact else np.full_like(apart, np.inf)
        for j, limit in enumerate(limits):
            i = first + j
            limit[candidates.rows == queries.rows[i]] = -np.inf
            rest, step = np.flatnonzero(limit > -np.inf), STEP
            at, best = np.empty(0, np.int64), np.empty(0, np.int64)
            while len(rest):
                more = np.arange(len(rest))
                if len(rest) > step:  # those of the highest limits
                    more = np.argpartition(-limit[rest], step - 1)[:step]
                chosen, rest, step = rest[more], np.delete(rest, more), len(limit)
                if not exact:
                    scores = exact_scores(queries.vectors[i : i + 1], candidates.vectors[chosen])[0]
                elif 4 * len(chosen) < len(limit):
                    scores = (candidates.vectors[chosen] @ queries.vectors[i]).astype(np.int64)
                else:  # reading all rows in place is cheaper than copying so many of them
                    scores = (candidates.vectors @ queries.vectors[i])[chosen].astype(np.int64)
                at, best = np.concatenate([at, chosen]), np.concatenate([best, scores])
                if len(best) > top:
                    enough = best >= np.partition(best, len(best) - top)[len(best) - top]
                    at, best = at[enough], best[enough]
                keep = np.lexsort((candidates.rows[at], candidates.ids[at], ~best))[:top]  # ~x falls as x rises
                at, best = at[keep], best[keep]
                if len(best) == top:
                    rest = rest[limit[rest] >= best[-1]]
            yield i, at, best


def _blocks(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Vectors of one length gathered in numbered blocks of bounded size, and the number of blocks."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out():
            at, ids, vectors = zip(*held, strict=True)
            content = whole_numbers(np.array(vectors, dtype=np.float64)).tobytes()
            columns = [[len(vectors[0])], [list(at)], [list(ids)], [content]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["dim", "rows", "ids", "content"]
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (len(held) == size or len(row[2]) != len(held[-1][2])):
                    yield out()
                    held = []
                held.append(row)
        if held:
            yield out()

    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
    blocks = rows.select("_at", F.col("id").cast("long"), "vector").mapInArrow(
        gather, "dim long, rows array<long>, ids array<long>, content binary"
    )
    return row_numbers(in_order(blocks, [F.col("dim"), F.col("rows")[0]], "_block_at"), "_block_at", "block")


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(max(n - 1, 0)).cast("long"))


def top_scores(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    top: int = TOP,
    pivots: int = PIVOTS,
    candidates: int = CANDIDATES,
    queries: int = QUERIES,
) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``top`` highest integer inner products of each query row.

    Components become ``floor(64 * x)``. Candidates of a query are all rows but its own, of as
    many components. Equal scores are ranked by id (null ids last), then in any way. Vectors that are null
    or hold null or non-finite components take no part. Repeated rows are queries and candidates of their
    own. Scores beyond 64 bits are limited to them. A null ``is_query`` is no query. Other columns
    are ignored.

    Every block of queries meets every block of candidates in one row of a task; each keeps its
    best, and the best of these are ranked.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(finite(F.col("vector")))
    ordered = in_order(rows, [F.size("vector"), F.col("id"), F.xxhash64("vector")], "_at")
    right, n_right = _blocks(ordered, candidates)
    left, n_left = _blocks(ordered.where("asks"), queries)
    groups = -(-n_left // QUERY_BLOCKS)
    parts = max(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_right * groups)
    asked = left.select(
        F.floor(F.col("block") / QUERY_BLOCKS).alias("group"), F.explode(_numbers(n_right)).alias("with"),
        *[F.col(c).alias(f"q_{c}") for c in ("dim", "rows", "ids", "content")],
    ).repartition(parts, "with", "group")
    offered = right.select(
        F.col("block").alias("with"), F.explode(_numbers(groups)).alias("group"),
        "dim", "rows", "ids", "content",
    ).repartition(parts, "with", "group")
    pairs = asked.join(offered, ["with", "group"]).where("q_dim = dim").drop("with", "group", "q_dim")

    def unpack(rows, ids, content, dim):
        vectors = np.frombuffer(content, dtype=np.float64).reshape(len(rows), dim)
        return np.array(rows, dtype=np.int64), ids, vectors

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(n)[r].as_py() for n in batch.schema.names}
                if block is None or block.rows[0] != row["rows"][0]:
                    places, ids, content = unpack(row["rows"], row["ids"], row["content"], row["dim"])
                    points = choose_pivots(content, pivots)
                    block, names = Block(places, ids, content, points), ids
                asking = Block(*unpack(row["q_rows"], row["q_ids"], row["q_content"], row["dim"]), points)
                found = [(i, a, s) for i, at, scores in search(asking, block, top) for a, s in zip(at.tolist(), scores.tolist(), strict=True)]
                which, at, scores = zip(*found, strict=True) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["q_rows"][i] for i in which], pa.int64()), pa.array([row["q_ids"][i] for i in which], pa.int64()),
                        pa.array([row["rows"][a] for a in at], pa.int64()), pa.array([names[a] for a in at], pa.int64()), pa.array(scores, pa.int64()),
                    ],
                    names=["query", "query_id", "row", "id", "score"],
                )

    schema = "query long, query_id long, row long, id long, score long"
    best = pairs.sortWithinPartitions(F.col("rows")[0]).mapInArrow(solve, schema)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row"))
    ranked = best.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
