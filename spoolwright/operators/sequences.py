"""Operators that depend on row order. Those with a key look along each entity's rows, however many it has; those over a table use ranked positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoolwright.operators.order import Laid


def neighbour_changes(df: DataFrame, pos: str, value: str, first: int = 1000) -> DataFrame:
    """rows, same, changes, same_ratio over the first positions: how often a row has its predecessor's value."""
    w = Window.orderBy(pos)  # over at most `first` rows
    head = df.where(F.col(pos) < first).select(pos, value).withColumn("same", F.lag(value).over(w).eqNullSafe(F.col(value)) & F.lag(F.lit(1)).over(w).isNotNull())
    n, same = F.count(F.lit(1)), F.coalesce(F.sum(F.col("same").cast("long")), F.lit(0))
    return head.agg(n.alias("rows"), same.alias("same"), (F.greatest(n - 1, F.lit(0)) - same).alias("changes"), F.round(same / n, 6).alias("same_ratio"))


def position_windows(df: DataFrame, pos: str, flag: Column, size: int = 100) -> DataFrame:
    """window, rows, share of flagged rows in each run of positions; the last may be short."""
    return df.groupBy(F.floor(F.col(pos) / size).alias("window")).agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg(flag.cast("double")), 6).alias("share"))


def share_variance(windows: DataFrame) -> DataFrame:
    return windows.agg(F.round(F.var_pop("share"), 6).alias("variance"), F.count(F.lit(1)).alias("windows"))


def sequential_runs(df: DataFrame, group: str, pos: str, idx: str, above: float = 0.5) -> DataFrame:
    """group, rows, share of rows whose index follows the previous one's, sequential (share above the limit). The divisor is the number of rows."""
    step = Laid(df.select(group, pos, idx), group, pos).neighbour(__before=F.col(idx)).rows()
    share = F.coalesce(F.sum((F.col(idx) == F.col("__before") + 1).cast("long")), F.lit(0)) / F.count(F.lit(1))
    return step.groupBy(group).agg(F.count(F.lit(1)).alias("rows"), F.round(share, 6).alias("share"), (share > above).alias("sequential"))


def merged_within(df: DataFrame, key: str, start: str, end: str, gap: float, order: list[str], end_rule: str = "max") -> DataFrame:
    """Intervals joined where the next starts at most `gap` after the running end: key, start, end, n.

    end_rule 'max' keeps the furthest end, 'last' the end of the last interval.
    """
    laid = Laid(df, key, *order)
    laid = laid.greatest_before(__reach=F.col(end)) if end_rule == "max" else laid.neighbour(__reach=F.col(end))
    last = F.max(end) if end_rule == "max" else F.max_by(end, F.struct(*order))
    rows = laid.islands(F.col(start) - F.col("__reach") > gap, "__i").rows()
    return rows.groupBy(key, "__i").agg(F.min(start).alias(start), last.alias(end), F.count(F.lit(1)).alias("n")).drop("__i")


def short_merged(df: DataFrame, key: str, start: str, end: str, kind: str, order: list[str], least: float) -> DataFrame:
    """A row shorter than `least` joins the one before it, whatever its kind: key, kind and start of the first, end of the last."""
    rows = Laid(df, key, *order).islands(F.col(end) - F.col(start) >= least, "__i").rows()
    at = F.struct(*order)
    return rows.groupBy(key, "__i").agg(F.min_by(kind, at).alias(kind), F.min_by(start, at).alias(start), F.max_by(end, at).alias(end)).drop("__i")


def gap_to_next(df: DataFrame, key: str, start: str, end: str, order: list[str]) -> DataFrame:
    """The rows with gap: start of the next row minus own end, null where it isn't positive."""
    gap = F.col("__next") - F.col(end)
    return Laid(df, key, *order).neighbour(True, __next=F.col(start)).rows().withColumn("gap", F.when(gap > 0, gap)).drop("__next")


def complement(df: DataFrame, key: str, start: str, end: str, low: str, high: str) -> DataFrame:
    """What disjoint intervals leave of low..high of their key. df has low and high on each row."""
    rows = Laid(df, key, start).neighbour(True, __next=F.col(start)).neighbour(__before=F.col(start)).rows()
    after = F.struct(F.col(end).alias("from_ms"), F.coalesce("__next", F.col(high)).alias("to_ms"))
    lead_in = F.when(F.col("__before").isNull(), F.struct(F.col(low).alias("from_ms"), F.col(start).alias("to_ms")))
    return rows.select(key, F.explode(F.array_compact(F.array(after, lead_in))).alias("g")).select(key, "g.*").where("to_ms > from_ms")


def word_offsets(df: DataFrame, key: str, order: list[str], words: Column) -> DataFrame:
    """The rows with first_word, word_count: which words of the joined text each row owns."""
    return Laid(df.withColumn("word_count", words), key, *order).summed_before(first_word=F.col("word_count")).rows()


def numbered_copies(df: DataFrame, label: str, order: list[str], mark: str = "-", first: int = 1) -> DataFrame:
    """unique_label: the first of a label keeps it, the others get the mark and their number, which is `first` for the first."""
    rows = Laid(df, label, *order).summed_before(__n=F.lit(1)).rows()
    return rows.withColumn("unique_label", F.when(F.col("__n") == 0, F.col(label)).otherwise(F.concat(label, F.lit(mark), (F.col("__n") + first).cast("string")))).drop("__n")


def shards(df: DataFrame, pos: str, limit: int) -> DataFrame:
    """Folder number of each position, `limit` to a folder."""
    return df.withColumn("shard", F.floor(F.col(pos) / limit))


def threshold_runs(df: DataFrame, key: str, order: list[str], above: Column, seconds: str, least: float) -> DataFrame:
    """Runs of neighbouring rows above a threshold that together last at least `least`: key, rows, seconds, first."""
    laid = Laid(df.withColumn("__on", F.coalesce(above, F.lit(False))), key, *order).neighbour(__was=F.col("__on"))
    islands = laid.islands(~(F.col("__on") & F.col("__was")), "__i").rows().where("__on")
    runs = islands.groupBy(key, "__i").agg(F.count(F.lit(1)).alias("rows"), F.sum(seconds).alias("seconds"), F.min(order[0]).alias("first"))
    return runs.where(F.col("seconds") >= least).drop("__i")


def reached_at(df: DataFrame, key: str, order: list[str], seconds: str, need: float) -> DataFrame:
    """The first row of each key at which the running sum reaches the need: key, the order columns, reached."""
    rows = Laid(df, key, *order).summed_before(__sum=F.col(seconds)).rows().withColumn("reached", F.col("__sum") + F.coalesce(F.col(seconds), F.lit(0)))
    return rows.where(F.col("reached") >= need).groupBy(key).agg(F.min(F.struct(*order, "reached")).alias("r")).select(key, "r.*")
