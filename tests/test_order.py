"""Running values over a sorted table against plain Python, on partitions that cut through keys."""

import random

from pyspark.sql import functions as F

from spoolwright.operators.order import Laid


def test_laid_against_plain_loops(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", None, "zz"]), i, rng.choice([None, *range(-5, 9)])) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, i int, v int").repartition(7)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid = Laid(df, "k", "i")
        assert laid.df.select("__p").distinct().count() > 3
        got = laid.neighbour(prev=F.col("v")).neighbour(True, next=F.col("v")).summed_before(s=F.col("v")).greatest_before(g=F.col("v")).islands(F.col("v") > 5).rows().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == 3000
    by_row = {r.i: r for r in got}
    for key in {k for k, *_ in rows}:
        mine = sorted((i, v) for k, i, v in rows if k == key)
        total, most, heads, starts = 0, None, {}, 0
        for at, (i, v) in enumerate(mine):
            r = by_row[i]
            assert r.prev == (mine[at - 1][1] if at else None) and r.next == (mine[at + 1][1] if at + 1 < len(mine) else None)
            assert (r.s, r.g) == (total, most)
            if at == 0 or v is None or v > 5:
                starts += 1
            heads.setdefault(r.island, set()).add(starts)
            total += v or 0
            most = v if most is None or v is not None and v > most else most
        assert all(len(x) == 1 for x in heads.values()) and len(heads) == starts


def test_laid_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, i int")
    assert Laid(empty, "k", "i").neighbour(p=F.col("i")).summed_before(s=F.col("i")).islands(F.lit(False)).rows().collect() == []
