"""Vectors as arrays of numbers: norms, cosine, centroids, nearest references."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: References that may be sent to every task: so many numbers at most; more are joined in blocks.
BROADCAST_NUMBERS = 4_000_000

#: Rows of a block, where all rows of two blocks are compared at once.
BLOCK = 2048


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Null where either has no length."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def centroid(df: DataFrame, group: str, vector: str) -> DataFrame:
    """group, n, centroid: mean of each dimension, scaled to length 1. Sums run per dimension, so no group's vectors are gathered."""
    long = df.where(F.col(vector).isNotNull()).select(group, F.posexplode(vector).alias("d", "x"))
    means = long.groupBy(group, "d").agg(F.avg(F.col("x").cast("double")).alias("m"), F.count(F.lit(1)).alias("n"))
    mean = means.groupBy(group).agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("d", "m"))), lambda s: s["m"]).alias("v"))
    return mean.select(group, "n", F.transform("v", lambda x: x / norm(F.col("v"))).alias("centroid"))


def scored_by(df: DataFrame, key: str, vector: str, reference: DataFrame, name: str, ref_vector: str) -> DataFrame:
    """key, name, score, runner_up: the reference with the greatest cosine for each row, and the second best score.

    All rows are held against a stated set of references. The set is broadcast if its size is proven small; otherwise it
    is dealt into blocks, and each row keeps the two best of every block before blocks are put together.
    """
    refs = reference.select(F.col(name).alias("__n"), F.col(ref_vector).alias("__v"))
    size = refs.agg(F.coalesce(F.sum(F.size("__v")), F.lit(0))).first()[0]
    blocks = -(-int(size) // BROADCAST_NUMBERS) or 1
    rows = df.select(key, F.col(vector).alias("__x"))
    best = lambda c: F.slice(F.reverse(F.array_sort(c)), 1, 2)
    lists = refs.withColumn("__b", F.pmod(F.xxhash64("__n"), F.lit(blocks))).groupBy("__b").agg(F.collect_list(F.struct("__n", "__v")).alias("__r"))
    met = rows.withColumn("__b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(F.broadcast(lists) if blocks == 1 else lists, "__b")
    kept = met.select(key, best(F.transform("__r", lambda r: F.struct(cosine(F.col("__x"), r["__v"]).alias("s"), r["__n"].alias("n")))).alias("t"))
    if blocks > 1:
        kept = kept.groupBy(key).agg(best(F.flatten(F.collect_list("t"))).alias("t"))
    return kept.select(key, F.get("t", F.lit(0))["n"].alias(name), F.round(F.get("t", F.lit(0))["s"], 6).alias("score"), F.round(F.get("t", F.lit(1))["s"], 6).alias("runner_up"))


def nearest_apart(df: DataFrame, key: str, vector: str, apart: str) -> DataFrame:
    """key, other_id, score: for every row, of all rows with another value of `apart`, the one with the greatest cosine (the least key of equals).

    Every pair of blocks is one product of matrices (Arrow batches) that serves both sides, and each row keeps its best of
    every block. Rows without a vector of any length, or without another row, have nulls. Null is a value of `apart`.
    """
    rows = df.select(F.col(key).alias("k"), F.col(apart).alias("a"), F.col(vector).alias("x"))
    blocks = max(-(-rows.count() // BLOCK), 1)
    dealt = rows.where("x is not null").withColumn("b", F.pmod(F.xxhash64("k"), F.lit(blocks)).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    paired = dealt.select(F.least("b", "o").alias("p"), F.greatest("b", "o").alias("q"), "b", "k", "a", "x")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("k")
        x = np.stack(frame["x"].map(lambda v: np.asarray(v, float)))
        size = np.linalg.norm(x, axis=1)
        frame, x, size = frame[size > 0], x[size > 0], size[size > 0]
        x, keys, group, b = x / size[:, None], frame["k"].to_numpy(), pd.factorize(frame["a"])[0], frame["b"].to_numpy()
        p, q = (b == frame["p"].to_numpy()), (b == frame["q"].to_numpy())
        out = [pd.DataFrame({"k": keys[:0], "n": keys[:0], "s": np.zeros(0)})]
        if p.any() and q.any():
            near = np.where(group[p][:, None] != group[q], x[p] @ x[q].T, -np.inf)
            for ours, theirs, s in ((p, q, near), (q, p, near.T)):
                at = s.argmax(1)
                out.append(pd.DataFrame({"k": keys[ours], "n": keys[theirs][at], "s": s[np.arange(len(s)), at]}))
        found = pd.concat(out)
        return found[np.isfinite(found["s"])]

    kind = df.schema[key].dataType.simpleString()
    found = paired.groupBy("p", "q").applyInPandas(run, f"k {kind}, n {kind}, s double")
    best = found.groupBy("k").agg(F.min(F.struct((-F.col("s")).alias("s"), "n")).alias("t"))
    return rows.select("k").join(best, "k", "left").select(F.col("k").alias(key), F.col("t.n").alias("other_id"), F.round(-F.col("t.s"), 6).alias("score"))
