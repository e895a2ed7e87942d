"""Streaming queries, drained over the tables as file streams, and round trips through the writers and readers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoolwright.lineage import shared_dir
from spoolwright.session import table
from spoolwright.sources import readers, writers
from spoolwright.streaming import operators as st


def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = st.file_stream(spark, f"{sf_dir}/events.parquet")
    out = e.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return st.drained(out, "tumbling", "complete").select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "event_type", "n")


def stream_context_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows only: those that the watermark has passed."""
    out = st.context_windows(st.file_stream(spark, f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "30 minutes", "2 hours", "1 hour", "event_type")
    return st.drained(out, "context").select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


def stream_speed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = st.file_stream(spark, f"{sf_dir}/audio_segments.parquet").where("not isnan(start_time) and not isnan(end_time) and end_time > start_time")
    return st.drained(st.speed_stats(s.withColumn("d", F.col("end_time") - F.col("start_time")), "is_speech", "d", "end_time"), "speed", "complete")


def stream_phrase_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.drained(st.word_totals(st.file_stream(spark, f"{sf_dir}/segment_refs.parquet"), "text"), "phrases", "complete")


def stream_stable_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of a recording as successive hypotheses (custom state)."""
    return st.drained(st.stable_prefix(st.file_stream(spark, f"{sf_dir}/segment_refs.parquet"), "audio_path", "idx", "text"), "prefix")


def _place(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/spoolwright/{label}-{uuid.uuid4().hex}"


def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest through JSON lines and a strict read."""
    rows = table(spark, sf_dir, "manifest_rows").select("row_id", "uid", "text", "core_start", "aug_meta")
    writers.write_jsonl(rows, path := _place(spark, "jsonl"))
    back = readers.read_jsonl(spark, path, rows.schema)
    return back.select("row_id", "uid", "text", "core_start", F.coalesce(F.size(F.map_keys("aug_meta")), F.lit(-1)).alias("entries"))


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "batch_map").select("map_id", "original_file", "start_sec", "gap_sec")
    rows.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path := _place(spark, "csv"))
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    return readers.typed(back, {"map_id": "bigint", "start_sec": "double", "gap_sec": "double"})


def split_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to two outputs in one pass, read back and counted."""
    writers.write_split(table(spark, sf_dir, "manifest_rows").select("row_id", "audio_path"), F.lower("audio_path").contains("__reverb__"), path := _place(spark, "split"))
    return spark.read.parquet(path).withColumn("side", F.col("side").cast("boolean")).groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.sum("row_id").alias("ids"))


def csv_grown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report that gets new columns with new rows."""
    t = table(spark, sf_dir, "batch_map")
    path = _place(spark, "grown")
    writers.append_csv(spark, t.where("gap_sec is null").select("map_id", "start_sec"), path)
    writers.append_csv(spark, t.where("gap_sec is not null").select("map_id", "gap_sec"), path)
    return writers.read_grown_csv(spark, path).agg(F.count(F.lit(1)).alias("n"), F.count("start_sec").alias("starts"), F.count("gap_sec").alias("gaps"))


QUERIES = {f.__name__: f for f in (stream_tumbling, stream_context_windows, stream_speed_stats, stream_phrase_totals, stream_stable_prefix, jsonl_round_trip, csv_round_trip, split_manifests, csv_grown)}

_BLANKS = r"[\s\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"

ORACLES = {
    "stream_context_windows": """WITH w AS (SELECT event_type, unnest([time_bucket(INTERVAL 30 MINUTES, ts), time_bucket(INTERVAL 30 MINUTES, ts) - INTERVAL 30 MINUTES, time_bucket(INTERVAL 30 MINUTES, ts) - INTERVAL 60 MINUTES, time_bucket(INTERVAL 30 MINUTES, ts) - INTERVAL 90 MINUTES]) AS start FROM events)
SELECT start, event_type, count(*) AS n FROM w WHERE start + INTERVAL 2 HOURS <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY ALL""",
    "stream_stable_prefix": f"""WITH t AS (SELECT audio_path AS key, idx::BIGINT AS seq, list_filter(string_split_regex(coalesce(text, ''), '{_BLANKS}'), lambda x: x <> '') AS w, row_number() OVER (PARTITION BY audio_path ORDER BY idx, text NULLS LAST) AS r FROM segment_refs WHERE audio_path IS NOT NULL),
p AS (SELECT *, coalesce(lag(w) OVER (PARTITION BY key ORDER BY r), []) AS v FROM t), s AS (SELECT *, coalesce(list_position(list_transform(range(1, least(len(v), len(w)) + 1), lambda i: v[i] = w[i]), false) - 1, least(len(v), len(w))) AS same FROM p),
d AS (SELECT *, coalesce(max(same) OVER (PARTITION BY key ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM s) SELECT key, seq, array_to_string(w[done + 1:same], ' ') AS words FROM d WHERE same > done""",
    "stream_tumbling": "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM events GROUP BY ALL",
    "stream_speed_stats": """WITH s AS (SELECT *, end_time - start_time AS d FROM audio_segments WHERE NOT isnan(start_time) AND NOT isnan(end_time) AND end_time > start_time)
SELECT is_speech, count(*) AS n, round(sum(d), 4) AS total, round(min(d), 4) AS least, round(max(d), 4) AS most, round(sum(d) / sum(end_time), 6) AS ratio FROM s GROUP BY is_speech""",
    "stream_phrase_totals": "SELECT lower(text) AS phrase, count(*) AS n, max(CASE WHEN text = '' THEN 0 ELSE len(string_split(text, ' ')) END)::INT AS words FROM segment_refs WHERE text IS NOT NULL GROUP BY 1",
    "jsonl_round_trip": "SELECT row_id, uid, text, core_start, CASE WHEN aug_meta IS NULL THEN -1 ELSE cardinality(aug_meta)::INT END AS entries FROM manifest_rows",
    "csv_round_trip": "SELECT map_id, original_file, start_sec, gap_sec FROM batch_map",
    "split_manifests": "SELECT contains(lower(audio_path), '__reverb__') AS side, count(*) AS n, CAST(sum(row_id) AS BIGINT) AS ids FROM manifest_rows WHERE audio_path IS NOT NULL GROUP BY 1",
    "csv_grown": "SELECT count(*) AS n, count(*) FILTER (gap_sec IS NULL) AS starts, count(gap_sec) AS gaps FROM batch_map",
}
