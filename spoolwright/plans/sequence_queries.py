"""Queries that depend on row order: neighbours, windows, islands, folds, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spoolwright.functions import scores
from spoolwright.operators import folds
from spoolwright.operators import sequences as sq
from spoolwright.operators.order import Laid, ranked
from spoolwright.session import table


def _placed(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents").select("doc_id", *columns), "doc_id")


def adjacent_same_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over the first 1000 positions, as the report is defined."""
    return sq.neighbour_changes(_placed(spark, sf_dir, "source"), "pos", "source", 1000)


def tumbling_mix_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sq.share_variance(sq.position_windows(_placed(spark, sf_dir, "lang"), "pos", F.coalesce(F.col("lang") == "en", F.lit(False))))


def tumbling_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sq.position_windows(_placed(spark, sf_dir, "lang"), "pos", F.coalesce(F.col("lang") == "en", F.lit(False)))


def sequential_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sq.sequential_runs(table(spark, sf_dir, "manifest_rows").where("source_audio is not null"), "source_audio", "row_id", "chunk_index")


_OK = "audio_path is not null and not isnan(start_time) and not isnan(end_time) and end_time > start_time"


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = lambda c: F.round(F.col(c) * 1000).cast("long")
    return table(spark, sf_dir, "audio_segments").where(_OK).select("segment_id", "audio_path", ms("start_time").alias("s"), ms("end_time").alias("e"), "is_speech", "avg_amplitude")


def merge_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sq.merged_within(_spans(spark, sf_dir), "audio_path", "s", "e", 250, ["s", "e", "segment_id"])


def merge_gaps_last_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other end rule: the end of the last interval counts, and only its end decides."""
    return sq.merged_within(_spans(spark, sf_dir), "audio_path", "s", "e", 250, ["s", "e", "segment_id"], "last")


def gap_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sq.gap_to_next(_spans(spark, sf_dir), "audio_path", "s", "e", ["s", "e", "segment_id"]).select("segment_id", "gap")


def silence_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What merged speech leaves of each recording's first to last second."""
    whole = _spans(spark, sf_dir).groupBy("audio_path").agg(F.lit(0).cast("long").alias("low"), (F.max("e") + 1000).alias("high"))
    merged = sq.merged_within(_spans(spark, sf_dir).where("is_speech"), "audio_path", "s", "e", 0, ["s", "e", "segment_id"]).join(whole, "audio_path")
    return sq.complement(merged, "audio_path", "s", "e", "low", "high")


def loud_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spans(spark, sf_dir).withColumn("ms", F.col("e") - F.col("s"))
    return sq.threshold_runs(rows, "audio_path", ["s", "e", "segment_id"], F.col("avg_amplitude") >= 0.1, "ms", 2000)


def presence_reached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the summed speech of a recording reaches ten seconds."""
    rows = _spans(spark, sf_dir).where("is_speech").withColumn("ms", F.col("e") - F.col("s"))
    return sq.reached_at(rows, "audio_path", ["s", "e", "segment_id"], "ms", 10_000).select("audio_path", "segment_id", "reached")


def numbered_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.element_at(F.split(F.lower("out_wav"), r"[\\/]"), -1)
    return sq.numbered_copies(table(spark, sf_dir, "cut_tasks").select("task_id", name.alias("name")), "name", ["task_id"]).select("task_id", "unique_label")


def dir_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sq.shards(_placed(spark, sf_dir), "pos", 300).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))


def batch_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance from each stretch of a packed file to the one before, next to the stored gap."""
    m = table(spark, sf_dir, "batch_map").where("end_sec > start_sec").select(F.lower("batch_file").alias("batch"), "map_id", "start_sec", "end_sec", "gap_sec")
    rows = Laid(m, "batch", "start_sec", "end_sec", "map_id").neighbour(before=F.col("end_sec")).rows()
    return rows.select("map_id", F.round(F.col("start_sec") - F.col("before"), 3).alias("measured"), "gap_sec")


def words_to_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detected words of each recording joined to segments (stateful fold)."""
    s = table(spark, sf_dir, "speech_segments").where(_OK)
    return folds.folded(s, "audio_path", ["start_time", "end_time", "segment_id"], {"start": F.col("start_time"), "end": F.col("end_time"), "word": F.coalesce("text", F.lit(""))}, lambda r: folds.words_to_segments(r, 0.6, 12.0), "start double, end double, text string, n int", lambda back: F.col("start_time") - back(F.col("end_time")) >= 0.6)


def chunk_builder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of each recording merged to chunks of at most 420 tokens, with their worst metrics and tier; chunks of tier 'drop' are left out (stateful fold, no SQL form). After a pause longer than a chunk may be nothing is merged.

    The table has no tokens and metrics of a recogniser: every four bytes begun count as a token, the compression ratio is
    that of the text, and the other two metrics are null.
    """
    s = table(spark, sf_dir, "segment_refs").where("audio_path is not null and not isnan(end_sec)")
    none = F.lit(None).cast("double")
    columns = {"start": F.col("start_sec"), "end": F.col("end_sec"), "text": F.col("text"), "tokens": F.ceil(F.octet_length(F.lower(F.trim("text"))) / 4), "no_speech": none, "logprob": none}

    def fold(rows: list[dict]) -> list[dict]:
        return folds.chunks_of_segments([r | {"ratio": folds.compression_ratio(r["text"])} for r in rows], 6.0, 1.0, 20.0, 420)

    kinds = "start double, end double, text string, n int, tokens long, no_speech double, logprob double, ratio double"
    chunks = folds.folded(s, "audio_path", ["idx", "seg_key"], columns, fold, kinds, lambda back: F.col("start_sec") - back(F.col("end_sec")) > 20.0)
    return chunks.withColumn("tier", scores.quality_tier(F.col("no_speech"), F.col("logprob"), F.col("ratio"))).where("tier <> 'drop'")


_CHARS = "coalesce(length(text), 0)"


def greedy_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each recording packed in order into bins of at most 60 000 characters and 40 documents (stateful fold)."""
    d = table(spark, sf_dir, "documents").where("recording_key is not null")
    return folds.folded(d, "recording_key", ["doc_id"], {"id": F.col("doc_id"), "size": F.expr(_CHARS).cast("double")}, lambda r: folds.greedy_packed(r, 60_000.0, 2.0, 40), "id long, bin int, offset double")


def largest_first_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each recording, largest first, into the least loaded bin (stateful fold, no SQL form)."""
    d = table(spark, sf_dir, "documents").where("recording_key is not null")
    return folds.folded(d, "recording_key", ["doc_id"], {"id": F.col("doc_id"), "size": F.expr(_CHARS).cast("double")}, lambda r: folds.least_loaded_packed(r, 60_000.0, 100), "id long, bin int")


def short_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short detections of each recording join the one before."""
    s = table(spark, sf_dir, "audio_segments").where(_OK).select("audio_path", F.col("start_time").alias("start"), F.col("end_time").alias("end"), "segment_id", F.coalesce(F.col("is_speech").cast("string"), F.lit("")).alias("kind"))
    return sq.short_merged(s, "audio_path", "start", "end", "kind", ["start", "end", "segment_id"], 0.3)


def ext_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return e.select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "event_type", "n", "total")


def ext_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy(F.window("ts", "2 hours", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return e.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


def ext_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return e.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


def ext_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the last view of its user before it: one sort of the union instead of a range join."""
    e = table(spark, sf_dir, "events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    seen = e.withColumn("view_id", F.last(F.when(F.col("event_type") == "view", F.col("event_id")), ignorenulls=True).over(w))
    return seen.where("event_type = 'purchase'").select("event_id", "view_id")


QUERIES = {
    f.__name__: f
    for f in (
        adjacent_same_ratio, tumbling_mix_variance, tumbling_mix, sequential_runs, merge_gaps, merge_gaps_last_end, gap_lengths, silence_complement, loud_runs, presence_reached, numbered_names, dir_shards, batch_gaps, words_to_segments,
        chunk_builder, greedy_pack, largest_first_pack, short_merge, ext_tumbling, ext_sliding, ext_session, ext_asof,
    )
}

_SPANS = """s AS (SELECT segment_id, audio_path, CAST(round(start_time * 1000) AS BIGINT) AS s, CAST(round(end_time * 1000) AS BIGINT) AS e, is_speech, avg_amplitude FROM audio_segments
    WHERE audio_path IS NOT NULL AND NOT isnan(start_time) AND NOT isnan(end_time) AND end_time > start_time)"""
_W = "OVER (PARTITION BY audio_path ORDER BY s, e, segment_id"
_POS = "p AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents)"

ORACLES = {
    "adjacent_same_ratio": f"""WITH {_POS}, f AS (SELECT pos, pos > 0 AND source IS NOT DISTINCT FROM lag(source) OVER (ORDER BY pos) AS same FROM p WHERE pos < 1000)
SELECT count(*) AS rows, CAST(sum(same::INT) AS BIGINT) AS same, CAST(count(*) - 1 - sum(same::INT) AS BIGINT) AS changes, round(sum(same::INT) / count(*), 6) AS same_ratio FROM f""",
    "tumbling_mix": f"WITH {_POS} SELECT pos // 100 AS \"window\", count(*) AS rows, round(avg(coalesce(lang = 'en', false)::INT), 6) AS share FROM p GROUP BY 1",
    "tumbling_mix_variance": f"WITH {_POS}, w AS (SELECT pos // 100 AS w, round(avg(coalesce(lang = 'en', false)::INT), 6) AS share FROM p GROUP BY 1) SELECT round(var_pop(share), 6) AS variance, count(*) AS windows FROM w",
    "sequential_runs": """WITH f AS (SELECT source_audio, coalesce(chunk_index = lag(chunk_index) OVER (PARTITION BY source_audio ORDER BY row_id) + 1, false)::INT AS nx FROM manifest_rows WHERE source_audio IS NOT NULL)
SELECT source_audio, count(*) AS rows, round(sum(nx) / count(*), 6) AS share, sum(nx) / count(*) > 0.5 AS sequential FROM f GROUP BY 1""",
    "merge_gaps": f"""WITH {_SPANS}, n AS (SELECT *, CASE WHEN s - max(e) {_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 250 THEN 0 ELSE 1 END AS nw FROM s),
g AS (SELECT *, sum(nw) {_W} ROWS UNBOUNDED PRECEDING) AS i FROM n) SELECT audio_path, min(s) AS s, max(e) AS e, count(*) AS n FROM g GROUP BY audio_path, i""",
    "merge_gaps_last_end": f"""WITH {_SPANS}, n AS (SELECT *, CASE WHEN s - lag(e) {_W}) <= 250 THEN 0 ELSE 1 END AS nw FROM s),
g AS (SELECT *, sum(nw) {_W} ROWS UNBOUNDED PRECEDING) AS i FROM n) SELECT audio_path, min(s) AS s, arg_max(e, (s, e, segment_id)) AS e, count(*) AS n FROM g GROUP BY audio_path, i""",
    "gap_lengths": f"WITH {_SPANS} SELECT segment_id, CASE WHEN lead(s) {_W}) - e > 0 THEN lead(s) {_W}) - e END AS gap FROM s",
    "silence_complement": f"""WITH {_SPANS}, w AS (SELECT audio_path, max(e) + 1000 AS high FROM s GROUP BY 1), v AS (SELECT * FROM s WHERE is_speech),
n AS (SELECT *, CASE WHEN s <= max(e) {_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS nw FROM v), g AS (SELECT *, sum(nw) {_W} ROWS UNBOUNDED PRECEDING) AS i FROM n),
m AS (SELECT audio_path, min(s) AS s, max(e) AS e, high FROM g JOIN w USING (audio_path) GROUP BY audio_path, i, high),
c AS (SELECT audio_path, e AS from_ms, coalesce(lead(s) OVER (PARTITION BY audio_path ORDER BY s), high) AS to_ms FROM m UNION ALL SELECT audio_path, 0, min(s) FROM m GROUP BY audio_path) SELECT * FROM c WHERE to_ms > from_ms""",
    "loud_runs": f"""WITH {_SPANS}, f AS (SELECT *, coalesce(avg_amplitude >= 0.1, false) AS o FROM s), i AS (SELECT *, CASE WHEN o AND coalesce(lag(o) {_W}), false) THEN 0 ELSE 1 END AS nw FROM f),
g AS (SELECT *, sum(nw) {_W} ROWS UNBOUNDED PRECEDING) AS i FROM i) SELECT audio_path, count(*) AS rows, CAST(sum(e - s) AS BIGINT) AS seconds, min(s) AS first FROM g WHERE o GROUP BY audio_path, i HAVING sum(e - s) >= 2000""",
    "presence_reached": f"""WITH {_SPANS}, r AS (SELECT *, CAST(sum(e - s) {_W} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS reached FROM s WHERE is_speech)
SELECT audio_path, segment_id, reached FROM (SELECT *, row_number() {_W}) AS k FROM r WHERE reached >= 10000) WHERE k = 1""",
    "numbered_names": r"""WITH n AS (SELECT task_id, list_last(string_split_regex(lower(out_wav), '[\\/]')) AS n FROM cut_tasks), r AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY task_id) AS k FROM n)
SELECT task_id, CASE WHEN k = 1 THEN n ELSE n || '-' || k END AS unique_label FROM r""",
    "dir_shards": f"WITH {_POS} SELECT pos // 300 AS shard, count(*) AS n, min(doc_id) AS first, max(doc_id) AS last FROM p GROUP BY 1",
    "batch_gaps": "SELECT map_id, round(start_sec - lag(end_sec) OVER (PARTITION BY lower(batch_file) ORDER BY start_sec, end_sec, map_id), 3) AS measured, gap_sec FROM batch_map WHERE end_sec > start_sec",
    "short_merge": """WITH s AS (SELECT audio_path, start_time AS s, end_time AS e, segment_id, coalesce(is_speech::VARCHAR, '') AS k FROM audio_segments WHERE audio_path IS NOT NULL AND NOT isnan(start_time) AND NOT isnan(end_time) AND end_time > start_time),
n AS (SELECT *, CASE WHEN e - s >= 0.3 OR lag(s) OVER (PARTITION BY audio_path ORDER BY s, e, segment_id) IS NULL THEN 1 ELSE 0 END AS nw FROM s), g AS (SELECT *, sum(nw) OVER (PARTITION BY audio_path ORDER BY s, e, segment_id ROWS UNBOUNDED PRECEDING) AS i FROM n)
SELECT audio_path, arg_min(k, (s, e, segment_id)) AS kind, arg_min(s, (s, e, segment_id)) AS start, arg_max(e, (s, e, segment_id)) AS "end" FROM g GROUP BY audio_path, i""",
    "words_to_segments": """WITH RECURSIVE s AS MATERIALIZED (SELECT audio_path AS p, start_time AS s, end_time AS e, coalesce(text, '') AS w, row_number() OVER (PARTITION BY audio_path ORDER BY start_time, end_time, segment_id) AS r
    FROM speech_segments WHERE audio_path IS NOT NULL AND NOT isnan(start_time) AND NOT isnan(end_time) AND end_time > start_time),
f(p, r, e, seg, part, b) AS (SELECT p, r, e, 0, 0, s FROM s WHERE r = 1 UNION ALL SELECT s.p, s.r, s.e, CASE WHEN s.s - f.e >= 0.6 OR f.e - f.b >= 12 THEN seg + 1 ELSE seg END, CASE WHEN s.s - f.e >= 0.6 THEN 0 WHEN f.e - f.b >= 12 THEN part + 1 ELSE part END,
    CASE WHEN s.s - f.e >= 0.6 OR f.e - f.b >= 12 THEN s.s ELSE f.b END FROM f JOIN s ON s.p = f.p AND s.r = f.r + 1)
SELECT p AS audio_path, part, any_value(b) AS start, arg_max(f.e, f.r) AS "end", string_agg(w, ' ' ORDER BY f.r) AS text, count(*)::INT AS n FROM f JOIN s USING (p, r) GROUP BY p, seg, part""",
    "greedy_pack": """WITH RECURSIVE d AS MATERIALIZED (SELECT recording_key AS k, doc_id, coalesce(length(text), 0)::DOUBLE AS z, row_number() OVER (PARTITION BY recording_key ORDER BY doc_id) - 1 AS r FROM documents WHERE recording_key IS NOT NULL),
f(k, r, doc_id, bin, used, n, o) AS (SELECT k, r, doc_id, 0, z, 1, 0.0::DOUBLE FROM d WHERE r % 10000 = 0 UNION ALL
    SELECT d.k, d.r, d.doc_id, CASE WHEN used + z + 2 > 60000 OR n >= 40 THEN bin + 1 ELSE bin END, CASE WHEN used + z + 2 > 60000 OR n >= 40 THEN z ELSE used + z + 2 END, CASE WHEN used + z + 2 > 60000 OR n >= 40 THEN 1 ELSE n + 1 END,
    CASE WHEN used + z + 2 > 60000 OR n >= 40 THEN 0 ELSE used + 2 END FROM f JOIN d ON d.k = f.k AND d.r = f.r + 1 WHERE d.r % 10000 <> 0)
SELECT k AS recording_key, r // 10000 AS stretch, (r % 10000)::INT AS part, doc_id AS id, bin, o AS offset FROM f""",
    "ext_tumbling": "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    "ext_sliding": "SELECT start, count(*) AS n FROM (SELECT unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS start FROM events) GROUP BY 1",
    "ext_session": """WITH n AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOURS THEN 0 ELSE 1 END AS nw FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), g AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS i FROM n)
SELECT user_id, min(ts) AS start, count(*) AS n FROM g GROUP BY user_id, i""",
    "ext_asof": """SELECT event_id, view_id FROM (SELECT event_id, event_type, last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS view_id FROM events)
WHERE event_type = 'purchase'""",
}
