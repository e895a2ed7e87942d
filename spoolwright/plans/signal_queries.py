"""Queries on signals, alignments, clusters and run names. The vectors of `embeddings` stand for clips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoolwright.functions import audio, runs
from spoolwright.operators import alignment
from spoolwright.session import table


def _clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector with the one half the table on as its noise."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("x"))
    n = e.count()
    noise = e.select(F.pmod(F.col("vec_id") + n // 2, F.lit(max(n, 1))).alias("vec_id"), F.col("x").alias("noise"))
    return e.join(noise, "vec_id")


def signal_mixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noise mix, gain, reverb and ducking of every clip (NumPy on arrays, no SQL form)."""
    level = lambda c: F.round(F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, v: s + v * v) / F.size(c)), 6)
    c = _clips(spark, sf_dir)
    return c.select(
        "vec_id", level(audio.noise_mix("x", "noise", F.lit(5.0))).alias("mixed"), level(audio.gain("x", F.lit(6.0))).alias("gained"), level(audio.reverb("x", "noise", F.lit(0.3))).alias("reverberated"), level(audio.duck("x", "noise")).alias("ducked")
    )


def channel_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clips(spark, sf_dir).select("vec_id", audio.channel_plan("x", "noise").alias("plan"), F.round(audio.channel_score("x", "noise"), 6).alias("score"))


def speaker_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average-linkage clusters within each label, numbered over all by size (iterative, no SQL form)."""
    e = table(spark, sf_dir, "embeddings")
    made = alignment.clustered(e, "label", "vec_id", "embedding", 0.9)
    return alignment.global_ids(made, e.select("vec_id", F.lit(1.0).alias("seconds")), "label", "vec_id", "seconds")


def corrected_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of each recording against its text without repeated blanks and lower case (alignment, no SQL form)."""
    s = table(spark, sf_dir, "segment_refs").where("audio_path is not null").select("audio_path", "seg_key", "text")
    whole = s.groupBy("audio_path").agg(F.concat_ws(" ", F.transform(F.sort_array(F.collect_list(F.struct("seg_key", "text"))), lambda r: F.regexp_replace(F.lower(r["text"]), r"\bthe ", ""))).alias("whole"))
    return alignment.corrected_segments(s, "audio_path", "seg_key", "text", whole, "whole")


def run_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", runs.run_name(kind=F.lit("Training"), stage=F.col("p_type"), base=F.col("p_brand"), rows=F.col("p_size").cast("string"), id=F.col("p_partkey").cast("string")).alias("name"))
    return p.select("p_partkey", "name", runs.parsed(F.col("name"))["stage"].alias("stage"))


QUERIES = {f.__name__: f for f in (signal_mixes, channel_plans, speaker_clusters, corrected_segments, run_names)}

_TOKEN = "coalesce(nullif(regexp_replace(regexp_replace(lower(trim({c})), '[^a-z0-9.]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'na')"
ORACLES = {
    "run_names": f"""SELECT p_partkey, 'kind-train__stage-' || {_TOKEN.format(c='p_type')} || '__base-' || {_TOKEN.format(c='p_brand')} || '__method-na__adapter-na__quant-na__ctx-na__rows-' || p_size || '__id-' || p_partkey AS name, {_TOKEN.format(c='p_type')} AS stage FROM part""",
}
