"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.ordering import in_order, sum_before, wrapped
from tidegrid.llm.text import WORD
from tidegrid.session import broadcast_if_small, materialize

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
SEED = 20240229
#: Filling ends when what is missing is below this share of a source's target.
TOLERANCE = 0.0005
#: Inclusion is rounded to powers of two with exponents in steps of one over this.
ODDS_STEPS = 8
#: Words of documents that are twice as likely to be in a mix as shorter or longer ones.
USUAL_WORDS = (50, 5_000)


def word_count(text: Column) -> Column:
    """Number of words of a text as a long; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def by_length(size: Column) -> Column:
    """Inclusion measure: documents of a usual length are twice as likely as others."""
    return F.when(size.between(*USUAL_WORDS), 2.0).otherwise(1.0)


def inclusion_rates(classes: DataFrame, max_copies: int) -> DataFrame:
    """``(source, source_size, target, rate)`` from ``(source, source_size, target, odds, size)``, one row a source and odds.

    A document is to come ``least(max_copies, odds * rate)`` times, and these times its size are to add up to the target.
    The odds that reach the limit are the highest of a source; they are found by running sums.
    """
    falling = Window.partitionBy("source").orderBy(F.desc("odds"))
    above = falling.rowsBetween(Window.unboundedPreceding, -1)
    others = falling.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("target") - max_copies * F.coalesce(F.sum("size").over(above), F.lit(0))
    rate = left / F.nullif(F.sum(F.col("odds") * F.col("size")).over(others), F.lit(0.0))
    free = F.col("odds") * F.col("rate") <= max_copies
    rated = classes.withColumn("rate", rate)
    level = F.coalesce(F.max_by(F.when(free, F.col("rate")), F.when(free, F.col("odds"))), F.max(F.lit(max_copies) / F.col("odds")))
    return rated.groupBy("source").agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.coalesce(level, F.lit(0.0)).alias("rate")
    )


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES
) -> DataFrame:
    """``(source, source_size, target)`` for every source of ``sizes (source, size)``.

    Sources by code point, null last, have the weights in turn and share the sum of all sizes. No
    target exceeds ``max_copies`` times its source's size; the excess is shared by weight among
    the others. The sources that stop are those of the smallest limit for their weight: they are
    found by one running sum over the table of sources, which has one row for each.
    """
    totals = sizes.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("source_size"))
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_turn") % len(weights) + 1).cast("int"))
    weighed = totals.withColumn("_turn", F.row_number().over(turn) - 1).select(
        "source", "source_size", "_turn", weight.cast("long").alias("_weight"),
        (F.col("source_size") * max_copies).alias("_limit"),
    )
    by_limit = Window.orderBy(F.col("_limit") / F.col("_weight"), "_turn")
    others = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    share = weighed.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("_limit").over(others), F.lit(0))).alias("_left"),
        (F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(others), F.lit(0))).alias("_of"),
    ).withColumn("_stops", F.col("_limit") * F.col("_of") < F.col("_weight") * F.col("_left"))
    open_sources = F.when(~F.col("_stops"), F.struct("_limit", "_left", "_of"))
    level = F.min_by(open_sources, F.when(~F.col("_stops"), F.struct(F.col("_limit") / F.col("_weight"), "_turn")))
    return share.withColumn("_level", level.over(everything)).select(
        "source",
        "source_size",
        F.when(F.col("_stops"), F.col("_limit").cast("double"))
        .otherwise((F.col("_weight") * F.col("_level._left")).cast("double") / F.col("_level._of").cast("double"))
        .alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    keys: list[str],
    source_col: str = "source",
    size_col: str = "size",
    inclusion: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    seed: int = SEED,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` (of the source) and ``copies`` that the mix takes.

    Every document should come ``e = inclusion * rate`` times, at most ``max_copies`` times, with the
    ``rate`` of its source by which the sum of ``e * size`` is the target. Inclusion, a measure of any scale, is
    rounded to steps of about a twelfth, so that a source has few different ones. The whole part of ``e`` is certain. For the rest, the documents of a source
    are ranked by ``(u / (1 - u)) / (p / (1 - p))``, where ``p`` is the part of ``e`` that is
    left and ``u`` a random number made from ``keys`` and ``seed``; the first of them are taken
    as long as the source stays within its target. What is then missing is filled in the same order
    with the documents that still fit, until less than ``tolerance`` of the target is missing or
    none fits. If none does, the smallest one left goes in, and others that fit the excess go out,
    last ranks first, if that brings the source nearer to its target. Only whole documents are taken.

    Rows equal in ``keys`` are ranked in any way, so that reruns agree up to their order. A null
    source is a source of its own, a null size counts as 0, a null or negative inclusion as 0.
    Columns named like the result's are replaced. An empty table gives an empty result.
    """
    docs = docs.drop("source_size", "target", "copies")
    size = F.coalesce(F.col(size_col), F.lit(0)).cast("long")
    exact = F.lit(1.0) if inclusion is None else F.coalesce(inclusion.cast("double"), F.lit(0.0))
    step = F.round(F.log2(exact) * ODDS_STEPS) / ODDS_STEPS
    odds = F.when(exact > 0, F.pow(F.lit(2.0), step)).otherwise(0.0)
    h = F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])
    rows = docs.select(
        wrapped(docs), F.col(source_col).alias("_s"), size.alias("_size"), odds.alias("_odds"),
        ((F.shiftrightunsigned(h, 11) + 0.5) / float(1 << 53)).alias("_u"), h.alias("_h"),
    )
    rows = materialize(rows, "sized")  # sizes are worked out once
    classes = materialize(
        rows.groupBy(F.col("_s").alias("source"), F.col("_odds").alias("odds")).agg(F.sum("_size").alias("size")), "classes"
    )
    targets = source_targets(classes.select("source", "size"), weights, max_copies)
    of = F.col("source").eqNullSafe(F.col("_source"))
    sized = classes.withColumnRenamed("source", "_source").join(targets, of).drop("_source").where("odds > 0")
    plan = materialize(
        targets.select(F.col("source").alias("_of"), "source_size", "target").join(
            inclusion_rates(sized, max_copies).select("source", F.col("rate").alias("_rate")),
            F.col("_of").eqNullSafe(F.col("source")), "left",
        ).drop("source").na.fill(0.0, ["_rate"]), "targets",
    )
    expected = F.least(F.lit(float(max_copies)), F.col("_odds") * F.col("_rate"))
    planned = (
        rows.join(broadcast_if_small(plan)[0], F.col("_s").eqNullSafe(F.col("_of")))
        .withColumn("copies", F.floor(expected).cast("long"))
        .withColumn("_p", expected - F.col("copies"))
        .withColumn("_rank", (F.col("_u") / (1 - F.col("_u"))) * ((1 - F.col("_p")) / F.nullif("_p", F.lit(0.0))))
    )
    order = [F.col("_s").asc(), F.col("_rank").asc_nulls_last(), F.col("_h")]
    ordered = in_order(planned, order, "_at")
    state = ordered.select(
        "_at", "_s", "_size", "target", "copies",
        ((F.col("_p") > 0) & (F.col("_size") > 0)).alias("_out"), F.lit(False).alias("_in"),
    )
    state = _move(state, "_out", tolerance)
    # Where no document fits any more, the smallest left goes in and others that fit go out for it.
    least = F.min(F.when(F.col("_out"), F.struct("_size", "_at")))["_at"].alias("_chosen")
    last = _gaps(state, tolerance, least).where("_chosen IS NOT NULL").select("_chosen")
    last = materialize(last, "last")
    if not last.isEmpty():
        tried = _move(_taken(state, last, "_out"), "_in", tolerance)
        state = materialize(_nearer(state, tried), "state")
    counts = state.select(F.col("_at").alias("_row"), F.col("copies").alias("_copies"))
    return ordered.join(counts, F.col("_at") == F.col("_row")).select(
        "_doc.*", "source_size", "target", F.col("_copies").alias("copies")
    )


def _gaps(state: DataFrame, tolerance: float, *more: Column) -> DataFrame:
    """``(_of, _gap)`` of the sources from which more than ``tolerance`` of the target is missing.

    A negative gap is what a source has too much.
    """
    words = F.sum(F.col("copies") * F.col("_size"))
    sums = state.groupBy(F.col("_s").alias("_of")).agg((F.first("target") - words).alias("_gap"), F.first("target").alias("_t"), *more)
    return sums.where(F.abs("_gap") > F.lit(tolerance) * F.col("_t")).drop("_t")


def _taken(state: DataFrame, chosen: DataFrame, column: str) -> DataFrame:
    """``state`` after one copy of the rows ``_chosen`` has come in from ``_out`` or gone out of ``_in``."""
    picked = F.col("_chosen").isNotNull()
    step = F.lit(1 if column == "_out" else -1)
    moved = state.join(chosen, F.col("_at") == F.col("_chosen"), "left").select(
        "_at", "_s", "_size", "target",
        (F.col("copies") + F.when(picked, step).otherwise(0)).cast("long").alias("copies"),
        (F.col("_out") & ~picked if column == "_out" else F.col("_out")).alias("_out"),
        (F.col("_in") | picked if column == "_out" else F.col("_in") & ~picked).alias("_in"),
    )
    return materialize(moved, "state")


def _move(state: DataFrame, column: str, tolerance: float) -> DataFrame:
    """Rows move in, first ranks first, or out, last ranks first, as long as they fit the gaps."""
    adds = column == "_out"
    while True:
        gap = F.col("_gap") if adds else -F.col("_gap")
        short = materialize(_gaps(state, tolerance).select("_of", gap.alias("_gap")).where("_gap > 0"), "gaps")
        near = F.col("_s").eqNullSafe(F.col("_of")) & (F.col("_size") <= F.col("_gap"))
        fits = state.where(column).join(broadcast_if_small(short)[0], near).drop("_of")
        ranked = fits.withColumn("_rank", F.col("_at") if adds else -F.col("_at"))
        chosen = sum_before(ranked, "_rank", "_s", "_size", "_sum").where("_sum + _size <= _gap")
        chosen = materialize(chosen.select(F.col("_at").alias("_chosen")), "chosen")
        if chosen.isEmpty():
            return state
        state = _taken(state, chosen, column)


def _nearer(first: DataFrame, second: DataFrame) -> DataFrame:
    """For each source, of two states the one that is nearer to its target."""
    miss = F.abs(F.first("target") - F.sum(F.col("copies") * F.col("_size"))).alias("_miss")
    one, two = (x.groupBy(F.col("_s").alias(n)).agg(miss.alias(f"{n}_miss")) for x, n in ((first, "_a"), (second, "_b")))
    better = one.join(two, F.col("_a").eqNullSafe(F.col("_b"))).select("_a", (F.col("_b_miss") < F.col("_a_miss")).alias("_better"))
    copies = second.select(F.col("_at").alias("_row"), F.col("copies").alias("_tried"))
    joined = first.join(copies, F.col("_at") == F.col("_row"))
    joined = joined.join(broadcast_if_small(better)[0], F.col("_s").eqNullSafe(F.col("_a")))
    return joined.select("_at", F.when(F.col("_better"), F.col("_tried")).otherwise(F.col("copies")).alias("copies"))
