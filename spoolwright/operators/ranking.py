"""Ranks, normalisations and leaderboards over model summaries (one row for each model, so plain windows do)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoolwright.functions import scores
from spoolwright.operators.metrics import PLACES


def _all():
    """All rows: a summary has one for each model."""
    return Window.partitionBy()


def competition_ranks(models: DataFrame, better_high: str, better_low: str, weights: tuple[float, float] = (0.6, 0.4)) -> DataFrame:
    """The rows with rank_high, rank_low (ties share the lowest) and rank_blend. Rows with a null in either have no ranks."""
    ok = F.col(better_high).isNotNull() & F.col(better_low).isNotNull()
    part = Window.partitionBy(ok)
    high, low = F.rank().over(part.orderBy(F.desc(better_high))), F.rank().over(part.orderBy(F.asc(better_low)))
    out = models.withColumns({"rank_high": F.when(ok, high), "rank_low": F.when(ok, low)})
    return out.withColumn("rank_blend", F.round(weights[0] * F.col("rank_high") + weights[1] * F.col("rank_low"), PLACES))


def z_scores(models: DataFrame, *columns: str) -> DataFrame:
    """The rows with z_<column>: distance to the mean in population deviations; null stays null."""
    return models.withColumns({f"z_{c}": F.round((F.col(c) - F.avg(c).over(_all())) / (F.stddev_pop(c).over(_all()) + 1e-9), PLACES) for c in columns})


def min_max(column: str, constant: float) -> Column:
    """0 to 1 over all rows; the given value where all rows are equal."""
    low, high = F.min(column).over(_all()), F.max(column).over(_all())
    return F.when(F.col(column).isNull(), None).when(high > low, (F.col(column) - low) / (high - low)).otherwise(constant)


def pareto(models: DataFrame, cost: str, gain: str, name: str) -> DataFrame:
    """The rows that no cheaper or equally cheap row reaches in gain, by cost."""
    before = Window.orderBy(F.asc(cost), F.desc(gain), F.asc(name)).rowsBetween(Window.unboundedPreceding, -1)
    clean = models.where(F.col(cost).isNotNull() & F.col(gain).isNotNull())
    return clean.withColumn("__m", F.max(gain).over(before)).where("__m is null or " + gain + " > __m").drop("__m")


def leaderboard(registry: DataFrame, results: list[DataFrame], model: str, accuracy: str, speed: str, weights: tuple[float, float] = (0.8, 0.2), constant: float = 1.0) -> DataFrame:
    """The registry with all results joined, score (accuracy and speed normalised; one alone where the other is null) and position: best first, null last, ties by name."""
    rows = registry
    for r in results:
        rows = rows.join(r, model, "left")
    a, s = min_max(accuracy, constant), min_max(speed, constant)
    blend = F.when(a.isNull(), s).when(s.isNull(), a).otherwise(weights[0] * a + weights[1] * s)
    scored = rows.withColumn("score", F.round(blend, PLACES))
    return scored.withColumn("position", F.row_number().over(Window.orderBy(F.col("score").desc_nulls_last(), F.asc(model))))


def composite(models: DataFrame, weights: dict[str, float]) -> DataFrame:
    """The rows with composite: the weighted columns normalised over all rows, 0.5 where a column is constant; null where one is."""
    return models.withColumn("composite", F.round(sum(w * min_max(c, 0.5) for c, w in weights.items()), PLACES))


def severities(items: DataFrame) -> DataFrame:
    """The items with severity. Columns: wer_target, cer_target, confidence (may be null)."""
    return items.withColumn("severity", F.round(scores.severity(F.col("wer_target"), F.col("cer_target"), F.col("confidence")), PLACES))


def severity_by_target(items: DataFrame, target: str) -> DataFrame:
    """target, models, worst, mean, p90 (nearest rank)."""
    return items.groupBy(target).agg(F.count(F.lit(1)).alias("models"), F.max("severity").alias("worst"), F.round(F.avg("severity"), PLACES).alias("mean"), F.expr("percentile_disc(0.9) within group (order by severity)").alias("p90"))


def worst_item(items: DataFrame, *groups: str, by: str, tie: str) -> DataFrame:
    """The row with the greatest value of each group; the least tie value decides."""
    names = [c for c in items.columns if c not in groups]
    return items.groupBy(*groups).agg(F.max_by(F.struct(*names), F.struct(F.col(by), -F.col(tie))).alias("__s")).select(*groups, "__s.*")
