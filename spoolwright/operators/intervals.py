"""Intervals per entity: continuous periods, gaps, complements, interval joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoolwright.lineage import cut

#: Width of the time blocks into which an entity's intervals are dealt; an entity with very many rows is so merged by many tasks.
BLOCK_MS = 600_000


def whole_ms(seconds: Column) -> Column:
    """Seconds as whole milliseconds, rounded to nearest; null for null, NaN and infinite."""
    ok = seconds.isNotNull() & ~F.isnan(seconds) & (F.abs(seconds) < 1e12)
    return F.when(ok, F.round(seconds * 1000).cast("long"))


def valid_spans(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """keys, start_ms, end_ms of the rows that have a length. Rows with a null or NaN time, or end <= start, are ignored."""
    return (
        df.where(F.col(end) > F.col(start))
        .select(*keys, whole_ms(F.col(start)).alias("start_ms"), whole_ms(F.col(end)).alias("end_ms"))
        .where("start_ms is not null and end_ms > start_ms")
    )


def _attach(rows: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """rows with other's further columns; keys of null match each other."""
    right = other.withColumnsRenamed({c: f"{c}__r" for c in on})
    return rows.join(right, [rows[c].eqNullSafe(right[f"{c}__r"]) for c in on], "left").drop(*[f"{c}__r" for c in on])


def periods(spans: DataFrame, keys: list[str], block_ms: int = BLOCK_MS) -> DataFrame:
    """Continuous periods of intervals that overlap, nest or touch: keys, start_ms, end_ms, n (intervals in it).

    A null key is an entity of its own. Repeated rows count in n. An empty input gives an empty result.

    Each interval is a session of its own length, so session_window merges those that overlap, within one block of an
    entity at a time; no task ever holds more than a block. Periods that reach over a block's end are then joined by
    what the blocks before them carry: one row per block, whatever the number of intervals.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    bare = spans.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], "start_ms", "end_ms")
    # null keys must group together; session_window groups like groupBy, so they do
    in_block = (
        bare.select(*names, F.floor(F.col("start_ms") / block_ms).alias("__b"), F.timestamp_millis("start_ms").alias("__t"), (F.col("end_ms") - F.col("start_ms")).alias("__d"))
        .groupBy(*names, "__b", "__t", "__d")
        .agg(F.count(F.lit(1)).alias("__n"))
        .groupBy(*names, "__b", F.session_window("__t", F.concat(F.col("__d"), F.lit(" milliseconds"))).alias("__w"))
        .agg(F.sum("__n").alias("n"))
        .select(*names, "__b", F.unix_millis("__w.start").alias("s"), F.unix_millis("__w.end").alias("e"), "n")
    )
    in_block = cut(in_block, "block-periods")  # read three times below
    block = Window.partitionBy(*names, "__b").orderBy("s")
    entity = Window.partitionBy(*names).orderBy("__b")
    carried = (
        in_block.groupBy(*names, "__b")
        .agg(F.max("e").alias("e"))
        .select(*names, "__b", F.max("e").over(entity.rowsBetween(Window.unboundedPreceding, -1)).alias("carry_e"))
    )
    joined = _attach(in_block, carried, [*names, "__b"])
    # sessions of a block are apart, but may touch; what comes from earlier blocks may reach over several of them
    before = F.greatest(F.coalesce(F.col("carry_e"), F.lit(-(1 << 62))), F.coalesce(F.max("e").over(block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-(1 << 62))))
    heads = joined.withColumn("head", F.when(F.col("s") > before, F.col("s")))
    heads = heads.withColumn("own", F.last("head", ignorenulls=True).over(block.rowsBetween(Window.unboundedPreceding, 0)))
    last_head = (
        heads.groupBy(*names, "__b")
        .agg(F.max("head").alias("h"))
        .select(*names, "__b", F.last("h", ignorenulls=True).over(entity.rowsBetween(Window.unboundedPreceding, -1)).alias("carry_h"))
    )
    whole = _attach(heads, last_head, [*names, "__b"]).select(*names, "e", "n", F.coalesce("own", "carry_h").alias("start_ms"))
    done = whole.groupBy(*names, "start_ms").agg(F.max("e").alias("end_ms"), F.sum("n").alias("n"))
    return done.select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)], "start_ms", "end_ms", "n")


def gaps(merged: DataFrame, keys: list[str], block_ms: int = BLOCK_MS) -> DataFrame:
    """keys, start_ms, end_ms of the stretches between the end of a period and the start of the next of its entity.

    Takes the output of periods(). The next start is looked for in the period's own block and, past the block's last
    period, in the first start of the blocks after it, so no task holds all periods of an entity.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    rows = merged.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], "start_ms", "end_ms", F.floor(F.col("start_ms") / block_ms).alias("__b"))
    nexts = (
        rows.groupBy(*names, "__b")
        .agg(F.min("start_ms").alias("f"))
        .select(*names, "__b", F.lead("f").over(Window.partitionBy(*names).orderBy("__b")).alias("later"))
    )
    own = rows.withColumn("next", F.lead("start_ms").over(Window.partitionBy(*names, "__b").orderBy("start_ms")))
    both = _attach(own, nexts, [*names, "__b"]).select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)], F.col("end_ms").alias("start_ms"), F.coalesce("next", "later").alias("end_ms"))
    return both.where("end_ms is not null")


def merged_and_gaps(spans: DataFrame, keys: list[str], block_ms: int = BLOCK_MS) -> DataFrame:
    """keys, kind, start_ms, end_ms: every period formed of two or more intervals ('merged') and every gap between periods ('gap')."""
    found = cut(periods(spans, keys, block_ms), "periods")  # read three times below
    merged = found.where("n >= 2").select(*keys, F.lit("merged").alias("kind"), "start_ms", "end_ms")
    return merged.unionByName(gaps(found, keys, block_ms).select(*keys, F.lit("gap").alias("kind"), "start_ms", "end_ms"))


def detected_spans(audio: DataFrame, speech: DataFrame) -> DataFrame:
    """track, audio_path, start_ms, end_ms of the valid detections in both tables."""
    parts = [
        valid_spans(df, ["audio_path"], "start_time", "end_time").select(F.lit(track).alias("track"), "audio_path", "start_ms", "end_ms")
        for track, df in (("audio", audio), ("speech", speech))
    ]
    return parts[0].unionByName(parts[1])
