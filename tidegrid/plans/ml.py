"""Stratified cross-validation of an event classifier on the mart."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.operators.enrich import SENSORS
from tidegrid.operators.series import with_row_index
from tidegrid.session import materialize

# Declared and detected events are left out: they would give the label away.
MART_FEATURES = (
    "duration_effective_s",
    "n_samples_after_cleaning",
    "plasma_current_max_MA",
    "plasma_current_mean_MA",
    "electron_density_mean",
    "electron_temperature_mean",
    "overall_completeness",
    *[f"completeness_{short}" for short, _ in SENSORS],
    *[f"outliers_{short}" for short, _ in SENSORS],
)


def stratified_folds(
    df: DataFrame, label: str, row_id: str, k: int = 5, seed: int = 42
) -> DataFrame:
    """Add ``fold``: rows of each label in hash order, dealt out in turn.

    A label may hold most of the rows, so they are numbered in blocks of the hash.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string")))
    position = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    indexed = with_row_index(df.withColumn("_hash", position), [label], ["_hash", row_id])
    return indexed.withColumn("fold", (F.col("_i") % k).cast("int")).drop("_hash", "_i")


def cross_validate(
    df: DataFrame,
    label: str,
    row_id: str,
    features: Sequence[str] = MART_FEATURES,
    k: int = 5,
    seed: int = 42,
    trees: int = 50,
) -> DataFrame:
    """A random forest per fold; one row per fold with AUC, accuracy and row counts.

    The forests are fitted side by side, each on the other folds, and all folds are judged in one
    pass over their scored rows. A missing feature is replaced by the median of the folds that the forest is trained on.
    """
    rows = stratified_folds(df.where(F.col(label).isNotNull()), label, row_id, k, seed)
    rows = rows.select(
        F.col(label).cast("double").alias("label"),
        "fold",
        *[F.col(c).cast("double").alias(c) for c in features],
    )
    rows = materialize(rows, "folds")
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    forest = RandomForestClassifier(numTrees=trees, seed=seed)

    def judged(fold: int) -> DataFrame:
        train = rows.where(F.col("fold") != fold)
        typical = medians(train, features)
        model = forest.fit(assembler.transform(train.na.fill(typical)))
        scored = model.transform(assembler.transform(rows.where(F.col("fold") == fold).na.fill(typical)))
        score = F.get(vector_to_array("probability"), F.lit(1)).alias("score")
        return scored.select("fold", "label", score, (F.col("prediction") == F.col("label")).alias("right"))

    folds = [r.fold for r in rows.select("fold").distinct().orderBy("fold").collect()]
    if len(folds) < 2:
        return df.sparkSession.createDataFrame([], "fold int, n_rows bigint, n_positive bigint, auc double, accuracy double")
    with ThreadPoolExecutor(len(folds)) as pool:
        scored = reduce(DataFrame.unionByName, pool.map(inheritable_thread_target(judged), folds))
    scored = materialize(scored, "scored")
    right = scored.groupBy("fold").agg(F.avg(F.col("right").cast("int")).alias("accuracy"))
    return rank_auc(scored, F.col("label") == 1, "score", "fold").join(right, "fold").orderBy("fold")


def rank_auc(df: DataFrame, positive: Column, score: str, group: str, steps: int = 1024) -> DataFrame:
    """``(group, n_rows, n_positive, auc)``: the exact share of pairs of a positive and a negative row of a group in which the
    positive one has the higher score; ties count half. NULL without pairs. Rows without a score or label are left out.

    Equal scores are counted first. The scores of a group are then numbered in steps of their range, so that no task has to sort
    all of them.
    """
    rows = df.select(F.col(group).alias("g"), F.col(score).cast("double").alias("x"), positive.alias("p"))
    rows = rows.where("x is not null and p is not null and not isnan(x)")
    counts = rows.groupBy("g", "x").agg(F.count_if("p").alias("pos"), F.count_if(~F.col("p")).alias("neg"))
    edges = counts.groupBy("g").agg(F.min("x").alias("least"), F.max("x").alias("most"))
    place = (F.col("x") - F.col("least")) / F.nullif(F.col("most") - F.col("least"), F.lit(0.0))
    step = F.coalesce(F.least(F.floor(place * steps), F.lit(steps - 1)), F.lit(0))
    counts = counts.join(edges, "g").select("g", "x", "pos", "neg", step.alias("step"))
    by_step = counts.groupBy("g", "step").agg(F.sum("neg").alias("all"))
    lower = Window.partitionBy("g").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    before = by_step.select("g", "step", F.coalesce(F.sum("all").over(lower), F.lit(0)).alias("before"))
    inside = Window.partitionBy("g", "step").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(inside), F.lit(0)) + F.col("before") + F.col("neg") / 2
    won = counts.join(before, ["g", "step"]).withColumn("won", F.col("pos") * below)
    return won.groupBy(F.col("g").alias(group)).agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n_rows"),
        F.sum("pos").alias("n_positive"),
        (F.sum("won") / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))).alias("auc"),
    )


def medians(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Approximate median of every feature, 0 for one without values: what stands for a missing value."""
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5).alias(c) for c in features]).first()
    return {c: 0.0 if v is None else v for c, v in row.asDict().items()}


def summarize_folds(folds: DataFrame) -> DataFrame:
    return folds.agg(
        F.count(F.lit(1)).alias("n_folds"),
        F.avg("auc").alias("auc_mean"),
        F.stddev("auc").alias("auc_std"),
        F.avg("accuracy").alias("accuracy_mean"),
        F.stddev("accuracy").alias("accuracy_std"),
    )


def train_event_classifier(df: DataFrame, label: str = "declared_disruption",
                           features: Sequence[str] = MART_FEATURES, seed: int = 42, trees: int = 50):
    """Fit on all labelled recordings; returns the model and a function that scores a table."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    labelled = df.where(F.col(label).isNotNull()).withColumn("label", F.col(label).cast("double"))
    typical = medians(labelled, features)

    def assemble(table):
        doubles = table.withColumns({c: F.col(c).cast("double") for c in features})
        return assembler.transform(doubles.na.fill(typical))

    model = RandomForestClassifier(numTrees=trees, seed=seed).fit(assemble(labelled))

    def score(table):
        probability = F.get(vector_to_array("probability"), F.lit(1))
        return model.transform(assemble(table)).select("shot_id", probability.alias("event_score"))

    return model, score
