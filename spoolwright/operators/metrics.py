"""Aggregates of evaluation results: one row for each scored item and model goes in."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PLACES = 6


def _round(c: Column) -> Column:
    return F.round(c, PLACES)


def metric_record() -> list[Column]:
    """The aggregates of a result record: micro and macro error rates, win rate, mean margin, cap rate, count. Nulls are skipped, the win rate counts all items."""
    win = F.coalesce(F.col("wer_target") < F.col("wer_other"), F.lit(False)).cast("double")
    return [
        F.count(F.lit(1)).alias("items"),
        _round(F.avg("wer_target")).alias("wer_target"),
        _round(F.avg("wer_other")).alias("wer_other"),
        _round(F.avg("cer_target")).alias("cer_target"),
        _round(F.sum("word_edits") / F.nullif(F.sum("ref_words"), F.lit(0))).alias("wer_micro"),
        _round(F.avg(win)).alias("win_rate"),
        _round(F.avg(F.col("wer_other") - F.col("wer_target"))).alias("mean_margin"),
        _round(F.avg(F.col("capped").cast("double"))).alias("cap_rate"),
    ]


def full_record() -> list[Column]:
    """The whole result record: micro and macro rates against target and other, win rate, both mean margins, cap rate, count. No items give no row."""
    win = F.coalesce(F.col("wer_target") < F.col("wer_other"), F.lit(False)).cast("double")
    micro = lambda edits, length: _round(F.sum(edits) / F.nullif(F.sum(length), F.lit(0)))
    return [
        F.count(F.lit(1)).alias("samples"), micro("word_edits", "ref_words").alias("wer_micro_target"), micro("other_edits", "other_words").alias("wer_micro_other"), micro("char_edits", "ref_chars").alias("cer_micro_target"), micro("other_char_edits", "other_chars").alias("cer_micro_other"),
        *[_round(F.avg(f"{m}_{side}")).alias(f"{m}_macro_{side}") for m in ("wer", "cer") for side in ("target", "other")],
        _round(F.avg(win)).alias("win_rate"), _round(F.avg(F.col("wer_other") - F.col("wer_target"))).alias("margin_wer"), _round(F.avg(F.col("cer_other") - F.col("cer_target"))).alias("margin_cer"), _round(F.avg(F.col("capped").cast("double"))).alias("cap_rate"),
    ]


def condition_means(items: DataFrame, model: str, condition: str) -> DataFrame:
    """model, condition, mean win rate, error and margin; items without a condition are left out."""
    win = F.coalesce(F.col("wer_target") < F.col("wer_other"), F.lit(False)).cast("double")
    return items.where(F.col(condition).isNotNull()).groupBy(model, condition).agg(_round(F.avg(win)).alias("win"), _round(F.avg("wer_target")).alias("wer"), _round(F.avg(F.col("wer_other") - F.col("wer_target"))).alias("margin"))


def by_condition(items: DataFrame, model: str, condition: str) -> DataFrame:
    """The record of each model in each condition, and over all conditions (condition null, overall true), in one pass."""
    grouped = items.groupingSets([[model, condition], [model]], model, condition)
    return grouped.agg(*metric_record(), F.grouping(condition).cast("boolean").alias("overall"))


def stability(items: DataFrame, model: str, condition: str, value: str) -> DataFrame:
    """Mean, sample deviation, least and greatest of the condition means of each model."""
    means = items.where(F.col(condition).isNotNull()).groupBy(model, condition).agg(F.avg(value).alias("m"))
    return means.groupBy(model).agg(_round(F.avg("m")).alias("mean"), _round(F.stddev_samp("m")).alias("deviation"), _round(F.min("m")).alias("worst"), _round(F.max("m")).alias("best"))


def quantiles(items: DataFrame, group: str, value: str, shares: tuple[float, ...] = (0.1, 0.5, 0.9)) -> DataFrame:
    """group, and p10, p50, ...: linear quantiles of each group; null and NaN are skipped, a group of only these has nulls.

    The values are sorted once over all groups and the two places around each quantile are looked up, so no task holds a group.
    """
    from spoolwright.operators.order import ranked

    v = F.when(~F.isnan(value), F.col(value))
    rows = items.select(F.col(group).alias("__g"), v.alias("__v"))
    placed = ranked(rows.where("__v is not null"), "__g", "__v")
    sizes = placed.groupBy("__g").agg(F.min("pos").alias("__from"), F.count(F.lit(1)).alias("__n"))
    at = lambda p: (F.col("__n") - 1) * F.lit(p)
    places = [F.struct(F.lit(i).alias("i"), (F.col("__from") + F.floor(at(p)) + up).alias("pos"), (F.lit(up) + (1 - 2 * up) * (1 - (at(p) - F.floor(at(p))))).alias("w")) for i, p in enumerate(shares) for up in (0, 1)]
    wanted = sizes.select(F.explode(F.array(*places)).alias("x")).select("x.*").where("w > 0")
    found = placed.join(wanted, "pos").groupBy("__g").agg(*[_round(F.sum(F.when(F.col("i") == i, F.col("__v") * F.col("w")))).alias(f"p{int(100 * p)}") for i, p in enumerate(shares)])
    groups = rows.select(F.col("__g").alias("__all")).distinct()
    return groups.join(found, groups["__all"].eqNullSafe(found["__g"]), "left").drop("__g").withColumnRenamed("__all", group)


def pairwise_wins(items: DataFrame, key: str, model: str, value: str, models: list[str]) -> DataFrame:
    """a, b, items, wins, rate: how often model a is strictly below model b on the items of both. A model against itself has the rate 0.5 and no wins.

    The models are few: one row for each item holds all their values, so items meet by an aggregate instead of a self-join.
    """
    wide = items.groupBy(key).pivot(model, models).agg(F.avg(value))
    cells = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}`").alias("x"), F.col(f"`{b}`").alias("y")) for a in models for b in models]
    long = wide.select(F.explode(F.array(*cells)).alias("c")).select("c.*").where("x is not null and y is not null")
    return long.groupBy("a", "b").agg(F.count(F.lit(1)).alias("items"), F.sum((F.col("x") < F.col("y")).cast("long")).alias("wins"), _round(F.avg(F.when(F.col("a") == F.col("b"), 0.5).otherwise((F.col("x") < F.col("y")).cast("double")))).alias("rate"))


def ecdf(items: DataFrame, group: str, value: str) -> DataFrame:
    """group, value, share at or below, survival (above or equal) of each different value; groups of equal values are counted before they are ranked, and no task holds a group."""
    from spoolwright.lineage import cut
    from spoolwright.operators.lookup import joined_apart
    from spoolwright.operators.order import Laid

    counted = items.where(F.col(group).isNotNull() & F.col(value).isNotNull() & ~F.isnan(value)).groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    rows = cut(Laid(counted, group, value, label="ecdf").summed_before(before=F.col("n")).rows(), "ecdf-values")
    rows = joined_apart(rows, rows.groupBy(group).agg(F.sum("n").alias("all")), group)
    return rows.select(group, value, _round((F.col("before") + F.col("n")) / F.col("all")).alias("share"), _round(1 - F.col("before") / F.col("all")).alias("survival"))


def performance_profile(items: DataFrame, key: str, model: str, value: str, taus: list[float]) -> DataFrame:
    """model, tau, share of the items on which the model is within tau times the best (best above 0)."""
    best = items.where(F.col(value).isNotNull()).groupBy(key, model).agg(F.avg(value).alias("v"))
    ratio = best.withColumn("b", F.min("v").over(Window.partitionBy(key))).where("b > 0").withColumn("ratio", F.col("v") / F.col("b"))
    hits = [F.avg((F.col("ratio") <= t).cast("double")).alias(f"t{i}") for i, t in enumerate(taus)]
    wide = ratio.groupBy(model).agg(*hits)
    return wide.select(model, F.explode(F.array(*[F.struct(F.lit(float(t)).alias("tau"), _round(F.col(f"t{i}")).alias("share")) for i, t in enumerate(taus)])).alias("p")).select(model, "p.tau", "p.share")


def performance_curve(items: DataFrame, key: str, model: str, value: str, points: int = 120, least: float = 1.2, most: float = 6.0) -> DataFrame:
    """model, point, tau, share of the items on which the model is within tau times the best (best above 0), at so many taus from 1 to the 95th percentile of all ratios, which is held between least and most.

    Equal ratios of a model are counted first, so both the percentile and the curve come from that one small table.
    """
    from spoolwright.lineage import cut

    means = items.where(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(F.col(key).alias("__k"), model).agg(F.avg(value).alias("v"))
    ratio = means.withColumn("b", F.min("v").over(Window.partitionBy("__k"))).where("b > 0").withColumn("ratio", F.col("v") / F.col("b"))
    counted = cut(ratio.groupBy(model, "ratio").agg(F.count(F.lit(1)).alias("n")), "ratios")
    end = counted.agg(F.least(F.greatest(F.percentile("ratio", 0.95, F.col("n")), F.lit(float(least))), F.lit(float(most))).alias("end"))
    tau = lambda i: F.when(i == points - 1, F.col("end")).otherwise(1.0 + i * ((F.col("end") - 1.0) / (points - 1)))
    taus = end.select(F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(points - 1)), tau)).alias("point", "tau"))
    met = counted.crossJoin(F.broadcast(taus))  # as many rows as points
    share = F.sum(F.when(F.col("ratio") <= F.col("tau"), F.col("n")).otherwise(0)) / F.sum("n")
    return met.groupBy(model, "point", "tau").agg(_round(share).alias("share")).select(model, "point", _round(F.col("tau")).alias("tau"), "share")


def bootstrap_interval(items: DataFrame, group: str, key: str, value: str, draws: int = 1200, seed: int = 42) -> DataFrame:
    """group, n, mean, low, high: 95 % interval of the mean by resampling.

    The values of a group are dealt to 1000 blocks by their key's hash, and blocks are drawn with replacement, so no task
    needs a group's rows and the result is the same however the rows are laid out.
    """
    cells = items.where(F.col(value).isNotNull() & ~F.isnan(value)).withColumn("__b", F.pmod(F.xxhash64(key), F.lit(1000)))
    sums = cells.groupBy(group, "__b").agg(F.sum(F.col(value).cast("decimal(38,12)")).cast("double").alias("s"), F.count(F.lit(1)).alias("n"))
    kind = items.schema[group].dataType.simpleString()

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        rng = np.random.default_rng(seed)
        frame = frame.sort_values("__b")
        s, n = frame["s"].to_numpy(float), frame["n"].to_numpy(float)
        pick = rng.integers(0, len(s), (draws, len(s)))
        means = s[pick].sum(axis=1) / n[pick].sum(axis=1)
        low, high = np.percentile(means, [2.5, 97.5])
        return pd.DataFrame({group: [frame[group].iloc[0]], "n": [int(n.sum())], "mean": [s.sum() / n.sum()], "low": [low], "high": [high]})

    return sums.groupBy(group).applyInPandas(run, f"{group} {kind}, n long, mean double, low double, high double")


def summary(items: DataFrame, group: str, value: str) -> DataFrame:
    """Count, sum, mean, population deviation and quantiles of each group."""
    from spoolwright.lineage import cut

    kept = cut(items.select(group, F.when(~F.isnan(value), F.col(value)).alias(value)), "summary-values")  # read twice
    totals = kept.groupBy(F.col(group).alias("__g")).agg(F.count(value).alias("n"), _round(F.sum(value)).alias("total"), _round(F.avg(value)).alias("mean"), _round(F.stddev_pop(value)).alias("deviation"))
    at = quantiles(kept, group, value, (0.5, 0.75, 0.9, 0.95))
    return at.join(totals, at[group].eqNullSafe(totals["__g"])).drop("__g")


def content_signature(files: DataFrame, group: str, *parts: str) -> DataFrame:
    """group, files, signature: SHA-256 over the sorted lines of a group.

    Lines are hashed first, and hashes are joined in 65 536 cells, then the cells, so no group's lines are gathered at once.
    """
    line = F.sha2(F.concat_ws("|", *[F.col(p).cast("string") for p in parts]), 256)
    cells = files.select(group, line.alias("h")).withColumn("c", F.substring("h", 1, 4)).groupBy(group, "c").agg(F.sha2(F.concat_ws("", F.array_sort(F.collect_list("h"))), 256).alias("s"), F.count(F.lit(1)).alias("n"))
    return cells.groupBy(group).agg(F.sum("n").alias("files"), F.sha2(F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("c", "s"))), lambda x: x["s"])), 256).alias("signature"))


def payload(files: DataFrame, key: str, size: str) -> DataFrame:
    """rows, files (different keys), missing (rows without size), bytes of the different files."""
    per = files.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.max(size).alias("b"), F.sum(F.col(size).isNull().cast("long")).alias("m"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(key).alias("files"), F.coalesce(F.sum("m"), F.lit(0)).alias("missing"), F.coalesce(F.sum("b"), F.lit(0)).alias("bytes"))
