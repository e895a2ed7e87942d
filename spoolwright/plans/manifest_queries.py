"""Queries on manifests: cut windows, path rewrites, versions of segments, interleaving, paired events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spoolwright.operators import manifests as mf
from spoolwright.session import table


def cut_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "cut_tasks").where("core_end > core_start and target_out_sec > 0 and not isnan(target_out_sec)")
    s, e, n = F.col("core_start"), F.col("core_end"), F.col("target_out_sec")
    low, high = mf.centred_window(s, e, n, e + 5.0)
    cut_low, cut_high = mf.padded_window(s, e, n)
    return t.select("task_id", *[F.round(c, 6).alias(a) for c, a in ((low, "plan_start"), (high, "plan_end"), (cut_low, "cut_start"), (cut_high, "cut_end"))])


def path_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed rows get the first original file of their batch as path."""
    first = table(spark, sf_dir, "batch_map").where("original_file is not null").groupBy("batch_file").agg(F.min("original_file").alias("to"))
    rows = table(spark, sf_dir, "manifest_rows").select("row_id", "audio_path")
    return mf.rewritten_paths(rows, "audio_path", first, "batch_file", "to")


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    s = table(spark, sf_dir, "segment_refs").where("audio_path is not null and idx is not null and seg_id is not null").groupBy("audio_path", "idx").agg(F.min(F.struct("seg_key", "seg_id", "start_sec", "end_sec", "text")).alias("s")).select("audio_path", "idx", "s.*")
    return s, s.where("text is not null and length(text) > 12")


def segment_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each recording's segments beside those that remain without the very short ones."""
    a, b = _versions(spark, sf_dir)
    again = b.withColumn("idx", F.row_number().over(Window.partitionBy("audio_path").orderBy("idx")) - 1)
    return mf.matched_segments(a.withColumn("idx", F.row_number().over(Window.partitionBy("audio_path").orderBy("idx")) - 1), again, "audio_path", "idx", "seg_key")


def repeated_segments_differ(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one recording and index whose times agree and whose texts don't."""
    s = table(spark, sf_dir, "segment_refs").where("audio_path is not null and not isnan(end_sec)")
    first = s.groupBy("audio_path", "idx").agg(F.min_by(F.struct("start_sec", "end_sec", "text"), "seg_key").alias("f")).select("audio_path", "idx", "f.*")
    return mf.shifted_segments(first, s.select("audio_path", "idx", "start_sec", "end_sec", "text"), ["audio_path", "idx"], "start_sec", "end_sec", "text", 0.25)


def correction_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conflicts between a base row's text and its augmented rows' texts."""
    r = table(spark, sf_dir, "manifest_rows")
    base = r.where("aug_stage = ''").groupBy("uid").agg(F.min_by("text", "row_id").alias("before"))
    return r.where("aug_stage <> ''").select("row_id", F.col("base_uid").alias("uid"), "text").join(base, "uid").select("row_id", F.array_join(mf.conflict_reasons(F.col("before"), F.col("text")), ";").alias("reasons"))


def balanced_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mf.interleaved(table(spark, sf_dir, "documents").select("doc_id", "lang"), F.col("lang") == "en", "doc_id", "mix").select("doc_id", "pos")


def paired_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's clicks with the next purchase."""
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_type")
    return mf.paired_events(e, "user_id", "ts", "event_type", "click", "purchase")


def argument_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changes in aug_meta from one row of a base uid to the next."""
    w = Window.partitionBy("base_uid").orderBy("row_id")
    r = table(spark, sf_dir, "manifest_rows").where("base_uid is not null and aug_stage <> ''").withColumn("old", F.lag("aug_meta").over(w)).where("old is not null")
    return r.select("row_id", F.explode(mf.argument_differences(F.col("old"), F.col("aug_meta"), ["seed"])).alias("name", "change"))


def nested_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts at any depth of JSON documents made of each recording's segments."""
    s = table(spark, sf_dir, "segment_refs").where("audio_path is not null and text is not null")
    docs = s.select("seg_key", F.to_json(F.struct(F.struct(F.array(F.struct("text", F.array(F.struct(F.col("lang").alias("word"))).alias("words"))).alias("segments")).alias("result"))).alias("json"))
    return mf.json_texts(docs, "seg_key", "json")


QUERIES = {f.__name__: f for f in (cut_windows, path_rewrite, segment_versions, repeated_segments_differ, correction_reasons, balanced_interleave, paired_events, argument_changes, nested_texts)}

_ASR = r"""trim(regexp_replace(regexp_replace(regexp_replace(lower({t}), '[‘’]', '''', 'g'), '[^a-z0-9\s'']+', ' ', 'g'), '\s+', ' ', 'g'))"""
_WORDS = r"list_filter(string_split_regex(lower(coalesce({t}, '')), '[^a-z0-9\-]+'), lambda w: w <> '')"

ORACLES = {
    "cut_windows": """WITH t AS (SELECT task_id, core_start AS s, core_end AS e, target_out_sec AS n, core_end + 5.0 AS total FROM cut_tasks WHERE core_end > core_start AND target_out_sec > 0 AND NOT isnan(target_out_sec)),
w AS (SELECT *, least(greatest((s + e) / 2 - n / 2, 0), greatest(total - n, 0)) AS low, greatest(s - greatest(n - (e - s), 0) / 2, 0) AS cl FROM t)
SELECT task_id, round(low, 6) AS plan_start, round(least(low + n, total), 6) AS plan_end, round(cl, 6) AS cut_start, round(greatest(cl + n, e), 6) AS cut_end FROM w""",
    "path_rewrite": """WITH b AS (SELECT batch_file, min(original_file) AS t FROM batch_map WHERE original_file IS NOT NULL GROUP BY 1)
SELECT row_id, coalesce(t, audio_path) AS audio_path, audio_path AS audio_path_original, t IS NOT NULL AS mapped FROM manifest_rows LEFT JOIN b ON batch_file = audio_path""",
    "segment_versions": """WITH s AS (SELECT audio_path, idx, min(seg_key) AS seg_key, arg_min(text, seg_key) AS text FROM segment_refs WHERE audio_path IS NOT NULL AND idx IS NOT NULL AND seg_id IS NOT NULL GROUP BY ALL),
s2 AS (SELECT s.audio_path, s.idx, s.seg_key, r.text FROM s JOIN segment_refs r USING (seg_key)),
a AS (SELECT *, CAST(row_number() OVER (PARTITION BY audio_path ORDER BY idx) - 1 AS INTEGER) AS p FROM s2), b AS (SELECT *, CAST(row_number() OVER (PARTITION BY audio_path ORDER BY idx) - 1 AS INTEGER) AS p FROM s2 WHERE text IS NOT NULL AND length(text) > 12),
n AS (SELECT audio_path, count(*) AS x, (SELECT count(*) FROM b WHERE b.audio_path = a.audio_path) AS y FROM a GROUP BY 1)
SELECT n.audio_path, CASE WHEN x = y THEN 'position' ELSE 'id' END AS how, l_pos, r_pos FROM n JOIN (
    SELECT a.audio_path AS d, a.p AS l_pos, b.p AS r_pos FROM a LEFT JOIN b ON a.seg_key = b.seg_key) j ON j.d = n.audio_path""",
    "repeated_segments_differ": f"""WITH s AS (SELECT * FROM segment_refs WHERE audio_path IS NOT NULL AND NOT isnan(end_sec)), f AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY audio_path, idx ORDER BY seg_key) = 1)
SELECT f.audio_path, f.idx, f.text, s.text AS other FROM f JOIN s ON s.audio_path = f.audio_path AND s.idx = f.idx WHERE abs(f.start_sec - s.start_sec) <= 0.25 AND abs(f.end_sec - s.end_sec) <= 0.25 AND {_ASR.format(t="f.text")} IS DISTINCT FROM {_ASR.format(t="s.text")}""",
    "correction_reasons": f"""WITH b AS (SELECT uid, text AS before FROM manifest_rows WHERE aug_stage = '' QUALIFY row_number() OVER (PARTITION BY uid ORDER BY row_id) = 1),
p AS (SELECT m.row_id, {_WORDS.format(t="before")} AS a, {_WORDS.format(t="m.text")} AS b FROM manifest_rows m JOIN b ON b.uid = m.base_uid WHERE m.aug_stage <> '')
SELECT row_id, concat_ws(';', CASE WHEN len(b) = 0 AND len(a) > 0 THEN 'became_empty' END, CASE WHEN len(a) <> len(b) THEN 'word_count_changed' END, CASE WHEN a <> b THEN 'word_tokens_changed' END) AS reasons FROM p""",
    "balanced_interleave": """WITH r AS (SELECT doc_id, coalesce(lang = 'en', false) AS c, row_number() OVER (PARTITION BY coalesce(lang = 'en', false) ORDER BY sha1('mix' || doc_id::VARCHAR), doc_id) - 1 AS r, count(*) OVER (PARTITION BY coalesce(lang = 'en', false)) AS n FROM documents)
SELECT doc_id, row_number() OVER (ORDER BY (r + 0.5::DOUBLE) / n, c, doc_id) - 1 AS pos FROM r""",
    "paired_events": """WITH e AS (SELECT user_id, ts, event_type, min(CASE WHEN event_type = 'purchase' THEN ts END) OVER (PARTITION BY user_id ORDER BY ts, CASE WHEN event_type = 'click' THEN 0 ELSE 1 END ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS t FROM events WHERE event_type IN ('click', 'purchase'))
SELECT user_id, ts AS start, t AS "end" FROM e WHERE event_type = 'click' AND t IS NOT NULL""",
    "argument_changes": """WITH r AS (SELECT row_id, aug_meta AS b, lag(aug_meta) OVER (PARTITION BY base_uid ORDER BY row_id) AS a FROM manifest_rows WHERE base_uid IS NOT NULL AND aug_stage <> ''),
k AS (SELECT row_id, a, b, unnest(list_distinct(list_concat(map_keys(a), coalesce(map_keys(b), [])))) AS name FROM r WHERE a IS NOT NULL)
SELECT row_id, name, coalesce(a[name], 'null') || ' -> ' || coalesce(b[name], 'null') AS change FROM k WHERE a[name] IS DISTINCT FROM b[name] AND name <> 'seed'""",
    "nested_texts": "SELECT seg_key, '$.result.segments[0].text' AS path, text FROM segment_refs WHERE audio_path IS NOT NULL AND text IS NOT NULL UNION ALL SELECT seg_key, '$.result.segments[0].words[0].word', lang FROM segment_refs WHERE audio_path IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL",
}
