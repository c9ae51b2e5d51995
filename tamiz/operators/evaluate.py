"""Model evaluation: confusion counts, classification report, multiclass AUC, choice of the best model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.columns import TARGET, quoted, significant
from tamiz.functions.running import running_totals

# Names of the goodness measures, and of the summary rows of a report.
GOODNESS = {"weighted f1-score": "weighted avg", "macro f1-score": "macro avg"}
ACCURACY, MACRO, WEIGHTED = "accuracy", "macro avg", "weighted avg"


def confusion_matrix(
    predictions: DataFrame, label: str = TARGET, prediction: str = "predicted_value", by: Sequence[str] = ()
) -> DataFrame:
    """(by..., label, prediction, n); rows without a known label are left out."""
    known = predictions.where(quoted(label).isNotNull())
    return known.groupBy(
        *[quoted(b) for b in by], quoted(label).alias("label"), quoted(prediction).alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def classification_report(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., row, precision, recall, f1_score, support) from confusion counts.

    One row per class that occurs as label or prediction, then accuracy (the same value in every
    column), macro and weighted average. 0/0 counts as 0.
    """
    by = list(by)
    sides = F.array(
        F.struct(
            F.col("label").alias("class"),
            F.col("n").alias("support"),
            F.lit(0).cast("long").alias("claimed"),
            F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            F.lit(0).cast("long").alias("support"),
            F.col("n").alias("claimed"),
            F.lit(0).cast("long").alias("hits"),
        ),
    )
    keys = [quoted(b) for b in by]
    counts = (
        confusion.select(*keys, F.explode(sides).alias("s"))
        .groupBy(*keys, F.col("s.class").alias("class"))
        .agg(
            F.sum("s.support").alias("support"),
            F.sum("s.claimed").alias("claimed"),
            F.sum("s.hits").alias("hits"),
        )
    )

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(0.0)

    classes = counts.select(
        *keys,
        "class",
        "support",
        "hits",
        ratio(F.col("hits"), F.col("claimed")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("support") + F.col("claimed")).alias("f1_score"),
    )
    scores = ["precision", "recall", "f1_score"]
    totals = classes.groupBy(*keys).agg(
        F.sum("support").alias("n"),
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        *[F.avg(s).alias(f"macro_{s}") for s in scores],
        *[(F.sum(F.col(s) * F.col("support")) / F.sum("support")).alias(f"weighted_{s}") for s in scores],
    )

    def line(name, values, support):
        return F.struct(
            F.lit(name).alias("row"),
            *[v.alias(s) for s, v in zip(scores, values)],
            support.cast("double").alias("support"),
        )

    summary = F.array(
        line(ACCURACY, [F.col("accuracy")] * 3, F.col("accuracy")),
        line(MACRO, [F.col(f"macro_{s}") for s in scores], F.col("n")),
        line(WEIGHTED, [F.col(f"weighted_{s}") for s in scores], F.col("n")),
    )
    per_class = classes.select(
        *keys, F.col("class").cast("string").alias("row"), *scores, F.col("support").cast("double").alias("support")
    )
    return per_class.unionByName(totals.select(*keys, F.explode(summary).alias("l")).select(*keys, "l.*"))


def goodness(report: DataFrame, measure: str, by: Sequence[str] = ("model",)) -> DataFrame:
    """(by..., value): the chosen F1 average of each report."""
    if measure not in GOODNESS:
        raise ValueError(f"unknown measure '{measure}', one of {tuple(GOODNESS)}")
    rows = report.where(F.col("row") == GOODNESS[measure])
    return rows.select(*[quoted(b) for b in by], F.col("f1_score").alias("value"))


def best_model(scores: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row (name, value): highest score, the first in grid order on a tie; 'empty', 0.0 if none is above 0."""
    position = F.array_position(F.array(*[F.lit(n) for n in order]), F.col("model"))
    # Scores are compared at 12 decimals, as sums may differ in the last bit between runs.
    first = F.struct((-F.round("value", 12)).alias("v"), position.alias("p"), "model", "value")
    best = scores.where(F.round("value", 12) > 0).agg(F.min(first).alias("b"))
    return best.select(
        F.coalesce(F.col("b.model"), F.lit("empty")).alias("name"),
        F.coalesce(F.col("b.value"), F.lit(0.0)).alias("value"),
    )


def multiclass_auc(
    predictions: DataFrame, probabilities: Mapping[int, str], label: str = TARGET, digits: int = 12
) -> DataFrame:
    """One row (auc): mean over class pairs of (A(i|j) + A(j|i)) / 2 (Hand and Till, 2001).

    A(i|j) is the chance that a row of class i has a higher probability of i than a row of class j, ties
    counting one half; scores are compared at ``digits`` significant digits. Rows become counts per (class, score, label) before any ordering. Pairs with a
    class that has no rows are left out.
    """
    classes = sorted(probabilities)
    cells = F.array(
        *[
            F.struct(F.lit(c).cast("long").alias("of"), significant(quoted(probabilities[c]).cast("double"), digits).alias("score"))
            for c in classes
        ]
    )
    counts = (
        predictions.where(quoted(label).isNotNull())
        .select(quoted(label).alias("label"), F.explode(cells).alias("s"))
        .groupBy("s.of", "s.score")
        .agg(*[F.count(F.when(F.col("label") == c, 1)).alias(f"n_{c}") for c in classes])
    )
    names = [f"n_{c}" for c in classes]
    ranked = running_totals(counts, ["of"], "score", names)
    own = F.lit(0)
    for c in classes:
        own = F.when(F.col("of") == c, F.col(f"n_{c}")).otherwise(own)
    # Per class i: for each j the pairs won by i.
    won = ranked.withColumn("own", own).groupBy("of").agg(
        F.sum("own").alias("size"),
        *[F.sum(F.col("own") * (F.col(f"n_{c}_before") + F.col(f"n_{c}") / 2)).alias(f"w_{c}") for c in classes],
    )
    # As many rows as classes.
    all_rows = Window.partitionBy(F.lit(1))
    sizes = F.map_from_entries(F.collect_list(F.struct("of", "size")).over(all_rows))
    against = F.array(*[F.struct(F.lit(c).cast("long").alias("j"), F.col(f"w_{c}").alias("won")) for c in classes])
    n_pairs = F.col("size") * F.col("sizes")[F.col("a.j")]
    pairs = (
        won.withColumn("sizes", sizes)
        .select("of", "size", "sizes", F.explode(against).alias("a"))
        .where((F.col("of") != F.col("a.j")) & (n_pairs > 0))
        .select(F.try_divide(F.col("a.won"), n_pairs).alias("auc"))
    )
    return pairs.agg(F.avg("auc").alias("auc"))
