"""Deterministic sampling, splitting, capping, ordering and set comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoolwright.functions.hashing import hash_order, in_share
from spoolwright.operators.order import ranked


def share_sample(df: DataFrame, key: str, share: float) -> DataFrame:
    """Rows whose key's hash bucket lies in the share: no shuffle, no count, and nested for growing shares."""
    return df.where(in_share(F.col(key).cast("string"), share))


def first_in_hash_order(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """n rows in hash order (a sampling operator: the limit is the feature)."""
    return df.orderBy(hash_order(seed, F.col(key)), key).limit(n)


def part_in_hash_order(df: DataFrame, key: str, part: float, seed: str) -> DataFrame:
    """max(1, int(n * part)) rows in hash order, whatever n."""
    placed = ranked(df.withColumn("__h", hash_order(seed, F.col(key))), "__h", key, name="__pos")
    n = placed.count()
    return placed.where(F.col("__pos") < max(1, int(n * part))).drop("__h", "__pos")


def cap_per_group(df: DataFrame, group: str, key: str, n: int, seed: str) -> DataFrame:
    """At most n rows of each group, in hash order. A first pass per group and hash cell keeps n rows of each cell, so a hot group is cut down by many tasks before it meets."""
    h = hash_order(seed, F.col(key))
    first = Window.partitionBy(group, "__cell").orderBy("__h", key)
    last = Window.partitionBy(group).orderBy("__h", key)
    cells = df.withColumn("__h", h).withColumn("__cell", F.pmod(F.xxhash64(key), F.lit(64)))
    few = cells.withColumn("__r", F.row_number().over(first)).where(F.col("__r") <= n)
    return few.withColumn("__r", F.row_number().over(last)).where(F.col("__r") <= n).drop("__h", "__cell", "__r")


def group_split(df: DataFrame, group: Column, test_share: float, seed: str) -> DataFrame:
    """The rows with in_test: max(1, round half even(groups * share)) whole groups, in hash order."""
    keyed = df.withColumn("__g", group)
    order = ranked(keyed.select("__g").distinct().withColumn("__h", hash_order(seed, F.col("__g"))), "__h", "__g", name="__pos")
    n = order.count()
    tests = order.where(F.col("__pos") < max(1, round(n * test_share))).select("__g", F.lit(True).alias("__t"))
    return keyed.join(tests, "__g", "left").withColumn("in_test", F.coalesce("__t", F.lit(False))).drop("__g", "__t")


def leaked_keys(train: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """Keys on both sides; a clean split has none."""
    return train.where(F.col(key).isNotNull()).select(key).intersect(test.select(key))


def capped_mix(private: DataFrame, public: DataFrame, key: str, ratio: float, seed: str) -> DataFrame:
    """All private rows, and public ones in hash order so that they are at most the ratio of the mix; scope tells which is which."""
    most = int(private.count() * ratio / (1 - ratio) + 1e-9)
    some = ranked(public.withColumn("__h", hash_order(seed, F.col(key))), "__h", key, name="__pos").where(F.col("__pos") < most).drop("__h", "__pos")
    return private.withColumn("scope", F.lit("private")).unionByName(some.withColumn("scope", F.lit("public")))


def top_targets(df: DataFrame, score: str, key: str, share: float, least: int = 1) -> DataFrame:
    """The best share (at least `least` rows): score descending with null last, key ascending."""
    placed = ranked(df, F.col(score).desc_nulls_last(), F.col(key).asc(), name="__pos")
    n = placed.count()
    return placed.where(F.col("__pos") < max(least, int(n * share))).drop("__pos")


def group_then_row_order(df: DataFrame, group: str, score: str, pos: str) -> DataFrame:
    """rank of every row: groups by their best score, rows of a group by score, both descending; ties by first position."""
    best = df.groupBy(group).agg(F.coalesce(F.max(score), F.lit(0.0)).alias("__best"), F.min(pos).alias("__first"))
    return ranked(df.join(best, group), F.desc("__best"), "__first", F.col(score).desc_nulls_last(), pos, name="rank").drop("__best", "__first")


def overlap_counts(sets: DataFrame, owner: str, key: str) -> DataFrame:
    """a, b, shared, smaller, percent for each pair of owners: sizes of intersections. Owners are few; keys may be many.

    One row for each key holds the set of its owners, so no pair of rows is ever formed.
    """
    owners = sets.where(F.col(key).isNotNull()).groupBy(key).agg(F.collect_set(owner).alias("o"))
    kinds = owners.groupBy(F.array_sort("o").alias("o")).agg(F.count(F.lit(1)).alias("n"))  # one row for each combination
    sizes = kinds.select(F.explode("o").alias("w"), "n").groupBy("w").agg(F.sum("n").alias("size"))
    pairs = kinds.select("n", F.explode("o").alias("a"), "o").select("n", "a", F.explode("o").alias("b")).where("a < b").groupBy("a", "b").agg(F.sum("n").alias("shared"))
    out = pairs.join(sizes.withColumnsRenamed({"w": "a", "size": "sa"}), "a").join(sizes.withColumnsRenamed({"w": "b", "size": "sb"}), "b")
    return out.select("a", "b", "shared", F.least("sa", "sb").alias("smaller"), F.round(100 * F.col("shared") / F.least("sa", "sb"), 6).alias("percent"))


def two_way_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """key, side: keys of only one of both."""
    left, right = a.select(key).distinct(), b.select(key).distinct()
    return left.join(right, key, "left_anti").withColumn("side", F.lit("left")).unionByName(right.join(left, key, "left_anti").withColumn("side", F.lit("right")))


def cursor_slice(df: DataFrame, pos: str, start: int, n: int, done: DataFrame, key: str, text: str) -> DataFrame:
    """The next n rows from a position on that have a text and are not done; the new pointer is one past the last position."""
    return df.where((F.col(pos) >= start) & (F.trim(F.coalesce(text, F.lit(""))) != "")).join(done.select(key).distinct(), key, "left_anti").orderBy(pos).limit(n)


def epoch_slice(df: DataFrame, key: str, seed: str, size: int, start: int, n: int) -> DataFrame:
    """key, epoch, at: the next n places of a cursor from `start` on. The rows are gone through in epochs of `size` rows each in hash order; a new epoch is shuffled anew (the steps are the feature).

    The plan is a function of seed, size and cursor alone, so a run that breaks off repeats the same rows.
    """
    epochs = range(start // size, (start + n - 1) // size + 1)
    parts = []
    for e in epochs:
        placed = ranked(df.select(F.col(key), hash_order(f"{seed}{e}", F.col(key)).alias("__h")), "__h", key, name="at").where(F.col("at") < size)
        parts.append(placed.select(key, F.lit(e).alias("epoch"), "at").where((F.col("at") + e * size >= start) & (F.col("at") + e * size < start + n)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
