"""Queries on keys, lookups, selections, splits and set comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spoolwright.functions import hashing, paths
from spoolwright.operators import lookup, selection, stages
from spoolwright.session import table


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "manifest_rows")


def path_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical file key, base name, and the part from chunks/ or recordings/ on."""
    roots = paths.root_pairs(table(spark, sf_dir, "path_roots"))
    keyed = _rows(spark, sf_dir).where("audio_path is not null").select("row_id", paths.file_key(F.col("audio_path"), roots).alias("file_key"))
    return keyed.select("row_id", "file_key", F.element_at(F.split("file_key", "/"), -1).alias("name"), paths.tail_from_marker(F.col("file_key"), ("/chunks/", "/recordings/")).alias("tail"))


def _group_key() -> Column:
    """The leak-safe group of a row: base uid, parent uid, transcript and index, source and index, else the file's uid or stem. Null for a row without any."""
    some = lambda c: F.nullif(F.trim(c), F.lit(""))
    index = F.format_string("%06d", "chunk_index")
    return F.coalesce(
        F.concat(F.lit("base:"), some("base_uid")), F.concat(F.lit("parent:"), some("parent_uid")), F.concat(F.lit("transcript:"), some("transcript_json"), F.lit(":"), index),
        F.concat(F.lit("source:"), some("source_audio"), F.lit(":"), index), F.concat(F.lit("uid:"), paths.uid_from_name(paths.base_name(F.col("audio_path")))), F.concat(F.lit("stem:"), paths.stem(F.col("audio_path"))),
    )


def group_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir).select("row_id", _group_key().alias("group_key"))


def uid_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base uids by digest where they are missing; uid defaults to it."""
    made = F.substring(F.sha1(hashing.base_uid_key(F.coalesce("source_audio", "audio_path", F.lit("")), F.coalesce("chunk_index", F.lit(0)), F.coalesce("core_start", F.lit(0.0)), F.coalesce("core_end", F.lit(0.0)))), 1, 16)
    base = F.coalesce(F.nullif("base_uid", F.lit("")), made)
    return _rows(spark, sf_dir).select("row_id", base.alias("base_uid"), F.coalesce(F.nullif("uid", F.lit("")), base).alias("uid"))


def blake_uids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BLAKE2b uids of all augmented rows (Arrow; no SQL form)."""
    key = hashing.aug_uid_key(F.coalesce("base_uid", F.lit("")), F.coalesce("aug_stage", F.lit("")), F.coalesce("aug_copy_idx", F.lit(0)))
    return _rows(spark, sf_dir).select("row_id", hashing.blake_uid(key).alias("blake_uid"))


def hash_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id").cast("string")
    return table(spark, sf_dir, "documents").select("doc_id", hashing.bucket(k).alias("bucket"), hashing.unsigned64(k).cast("string").alias("hash"), hashing.md5_seed(k).alias("seed"))


def share_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.share_sample(table(spark, sf_dir, "documents"), "doc_id", 0.3).select("doc_id")


def deterministic_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.cap_per_group(table(spark, sf_dir, "documents"), "source", "doc_id", 25, "cap").select("source", "doc_id")


def deterministic_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.part_in_hash_order(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0.1, "percent")


def seeded_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spoolwright.operators.order import ranked

    d = table(spark, sf_dir, "documents").select("doc_id", "source", hashing.hash_order("17", F.col("doc_id")).alias("h"))
    return ranked(d, "h", "doc_id").select("doc_id", "pos")


def group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the groups for test; a row that has no key is a group of its own."""
    keyed = _rows(spark, sf_dir).select("row_id", F.coalesce(_group_key(), F.concat(F.lit("row:"), F.col("row_id").cast("string"))).alias("g"))
    return selection.group_split(keyed, F.col("g"), 0.1, "13").select("row_id", "in_test")


def leak_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base uids in the train split as well as in the test split."""
    r = _rows(spark, sf_dir)
    return selection.leaked_keys(r.where("split_name = 'train'"), r.where("split_name = 'test'"), "base_uid")


def public_private_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return selection.capped_mix(d.where("lang = 'de'"), d.where("lang = 'en'"), "doc_id", 0.3, "17").select("doc_id", "scope")


def top_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.when(~F.isnan("confidence"), F.col("confidence"))
    return selection.top_targets(table(spark, sf_dir, "speech_segments").select("segment_id", c.alias("score")), "score", "segment_id", 0.05).select("segment_id", "score")


def group_then_row_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.when(~F.isnan("confidence"), F.col("confidence"))
    s = table(spark, sf_dir, "speech_segments").select("segment_id", "audio_path", c.alias("score"))
    return selection.group_then_row_order(s, "audio_path", "score", "segment_id").select("segment_id", "rank")


def _best_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.when(~F.isnan("confidence"), F.col("confidence"))
    return table(spark, sf_dir, "speech_segments").where("audio_path is not null").groupBy(F.lower("audio_path").alias("path")).agg(F.max(c).alias("score"))


def score_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for each manifest row: by its own path, else by its source's."""
    rows = _rows(spark, sf_dir).select("row_id", F.lower("audio_path").alias("a"), F.lower("source_audio").alias("s"))
    return lookup.by_first_key(rows, [F.col("a"), F.col("s")], _best_score(spark, sf_dir), "path", "score")


def name_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of a row's recording: by the whole path, else by its name where all rows of the name agree."""
    speech = table(spark, sf_dir, "speech_segments").where("audio_path is not null and lang is not null")
    langs = speech.groupBy(F.lower("audio_path").alias("path")).agg(F.min("lang").alias("language")).withColumn("name", F.element_at(F.split("path", r"\\"), -1))
    rows = table(spark, sf_dir, "segment_refs").select("seg_key", F.lower("audio_path").alias("path"), F.element_at(F.split(F.lower("audio_path"), r"[\\/]"), -1).alias("name"))
    return lookup.two_tier(rows, "path", "name", langs, "language", "seg_key")


def bottom_percent_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections above the value of the lowest tenth; NaN goes, ties at the limit go, null stays."""
    from spoolwright.operators.order import value_at

    s = table(spark, sf_dir, "speech_segments")
    limit = value_at(s, "confidence", 0.1)
    return s.where(F.col("confidence").isNull() | (~F.isnan("confidence") & (F.col("confidence") > F.lit(limit)))).select("segment_id")


def target_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest rows none of whose paths is among the tasks' files."""
    rows = _rows(spark, sf_dir).select("row_id", F.lower("audio_path").alias("a"), F.lower("source_audio").alias("s"))
    listed = table(spark, sf_dir, "cut_tasks").select(F.lower("audio_path").alias("k"))
    return lookup.without_any_key(rows, [F.col("a"), F.col("s")], listed, "k").select("row_id")


def target_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir).select("row_id", F.lower("audio_path").alias("a"), F.lower("source_audio").alias("s"))
    listed = table(spark, sf_dir, "cut_tasks").select(F.lower("audio_path").alias("k"))
    return lookup.with_any_key(rows, [F.col("a"), F.col("s")], listed, "k").select("row_id")


def incremental_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks whose file has no segments yet."""
    tasks = table(spark, sf_dir, "cut_tasks").select("task_id", F.lower("audio_path").alias("k"))
    return lookup.unseen(tasks, "k", table(spark, sf_dir, "segment_refs").select(F.lower("audio_path").alias("k"))).select("task_id")


def corrections_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of base rows replaced by that of their last augmented row."""
    r = _rows(spark, sf_dir)
    base = r.where("aug_stage = ''").select("row_id", "uid", "text")
    last = r.where("aug_stage <> '' and base_uid is not null and text is not null").select(F.col("base_uid").alias("uid"), "row_id", F.col("text").alias("new"))
    return lookup.corrected(base, "uid", "text", last, "row_id", "new").select("row_id", "text", "changed")


def correction_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _rows(spark, sf_dir).where("aug_stage <> '' and base_uid is not null and text is not null").select(F.col("base_uid").alias("uid"), "text")
    return lookup.conflicting_corrections(r, "uid", "text")


def map_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels of each rated document by rater, upserted from two halves of the ratings; raters of the first half win."""
    l = table(spark, sf_dir, "reading_labels").where("level is not null and rater is not null").groupBy("doc_id", "rater").agg(F.min("level").alias("lo"), F.max("level").alias("hi"))  # noqa: E741
    maps = lambda d, v: d.groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("rater", v)))).alias("m"))
    merged = lookup.upserted_map(maps(l.where("rater < 'rater_05'"), "lo"), maps(l, "hi"), "doc_id", "m")
    return merged.select("doc_id", F.explode("m").alias("rater", "level"))


def keep_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "segment_refs").where("audio_path is not null and text is not null").select("audio_path", "text", "seg_key")
    return lookup.longest_wins(r, "audio_path", "text", "seg_key")


def keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _rows(spark, sf_dir).select("uid", "row_id", "split_name")
    return lookup.first_wins(r, "uid", "row_id", "row_id", "split_name")


def span_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which stored segments contain the middle of a detection, per recording as stored."""
    ms = lambda c: F.round(F.col(c) * 1000).cast("long")
    points = table(spark, sf_dir, "speech_segments").where("audio_path is not null and not isnan(start_time) and not isnan(end_time) and end_time > start_time").select("segment_id", "audio_path", F.floor((ms("start_time") + ms("end_time")) / 2).alias("at"))
    spans = table(spark, sf_dir, "segment_refs").where("audio_path is not null and not isnan(end_sec) and end_sec > start_sec").select("seg_key", "audio_path", ms("start_sec").alias("s"), ms("end_sec").alias("e"))
    return lookup.containing_spans(points, spans, "audio_path", "at", "s", "e", 30_000).select("segment_id", "seg_key")


def clipped_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections of both tables that overlap, clipped to each other."""
    ms = lambda c: F.round(F.col(c) * 1000).cast("long")
    ok = "audio_path is not null and not isnan(start_time) and not isnan(end_time) and end_time > start_time"
    a = table(spark, sf_dir, "audio_segments").where(ok).select(F.col("segment_id").alias("audio_id"), "audio_path", ms("start_time").alias("l_start"), ms("end_time").alias("l_end"))
    b = table(spark, sf_dir, "speech_segments").where(ok).select(F.col("segment_id").alias("speech_id"), "audio_path", ms("start_time").alias("r_start"), ms("end_time").alias("r_end"))
    return lookup.overlapping_spans(a, b, "audio_path", 30_000).select("audio_id", "speech_id", "start_ms", "end_ms")


def condition_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every task under every condition of a fixed grid."""
    grid = [(s, o) for s in (-5.0, 0.0, 5.0) for o in (0.0, 0.5)]
    cells = F.array(*[F.struct(F.lit(s).alias("snr_db"), F.lit(o).alias("overlap"), F.lit(f"snr{s:+g}dB_ov{o:.2f}").alias("cond_id")) for s, o in grid])
    return table(spark, sf_dir, "cut_tasks").select("task_id", F.explode(cells).alias("c")).select("task_id", "c.*")


def hash_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each task with the task at the place its hash names, itself left out."""
    from spoolwright.operators.order import ranked

    placed = ranked(table(spark, sf_dir, "cut_tasks").select("task_id"), "task_id")
    n = placed.count() or 1
    wish = placed.select(F.col("task_id").alias("target"), F.pmod(F.conv(F.substring(F.sha1(F.concat(F.col("task_id").cast("string"), F.lit(":0"))), 1, 15), 16, 10).cast("long"), F.lit(n)).alias("pos"))
    return wish.join(placed.withColumnRenamed("task_id", "other"), "pos").where("target <> other").select("target", "other")


def overlap_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts shared between the splits of the manifest."""
    return selection.overlap_counts(table(spark, sf_dir, "manifest_rows").where("split_name is not null").select("split_name", "text"), "split_name", "text")


def two_way_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (table(spark, sf_dir, t).select(F.lower("audio_path").alias("k")).where("k is not null") for t in ("audio_segments", "speech_segments"))
    return selection.two_way_difference(a, b, "k")


def append_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables of detections as one, columns that a table lacks null."""
    both = table(spark, sf_dir, "audio_segments").withColumn("t", F.lit("audio")).unionByName(table(spark, sf_dir, "speech_segments").withColumn("t", F.lit("speech")), allowMissingColumns=True)
    return both.groupBy("t").agg(F.count(F.lit(1)).alias("n"), F.count("text").alias("texts"), F.count("avg_amplitude").alias("amplitudes"))


def cursor_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next 200 documents from a position on that are not rated yet (a cursor's step: the limit is the feature)."""
    return selection.cursor_slice(table(spark, sf_dir, "documents"), "doc_id", 300, 200, table(spark, sf_dir, "reading_labels"), "doc_id", "text").select("doc_id")


def augmented_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = stages.augmented(_rows(spark, sf_dir), "noise", 2, {"snr_db": F.lit(5)})
    return made.select("row_id", "parent_uid", "base_uid", "uid", "aug_stage", "aug_copy_idx", F.col("aug_meta")["snr_db"].alias("snr_db"))


QUERIES = {
    f.__name__: f
    for f in (
        path_keys, group_keys, uid_backfill, blake_uids, hash_buckets, share_sample, deterministic_cap, deterministic_percent, seeded_shuffle, group_split, leak_audit, public_private_cap, top_targets, group_then_row_order, score_lookup, name_lookup,
        bottom_percent_filter, target_anti, target_semi, incremental_anti, corrections_update, correction_conflicts, map_upsert, keep_longest, keep_first, span_lookup, clipped_spans, condition_grid, hash_pairing, overlap_matrix, two_way_diff,
        append_union, cursor_slice, augmented_rows,
    )
}

_B = chr(92)
_SLASHED = r"regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace({p}, '^\s+|\s+$', '', 'g')), '[\\/]+(?:\.[\\/]+)*', '/', 'g'), '^\./', ''), '/\.?$', '')"
_ROOTED = f"""regexp_replace({_SLASHED.format(p="audio_path")}, '^(?:' || (SELECT string_agg(regexp_escape({_SLASHED.format(p="root_path")}), '|' ORDER BY length(root_path) DESC) FROM path_roots) || ')(/|$)', (SELECT min(canonical_root) FROM path_roots) || '\\1')"""
_H15 = "('0x' || substr(sha1({k}), 1, 15))::BIGINT"
_ORDER = "sha1('{seed}' || {k}::VARCHAR)"
_SPEECH = "audio_path IS NOT NULL AND NOT isnan(start_time) AND NOT isnan(end_time) AND end_time > start_time"
_MS = "CAST(round({c} * 1000) AS BIGINT)"
_SCORE = "CASE WHEN NOT isnan(confidence) THEN confidence END"

_GROUPED = f"""r AS (SELECT *, printf('%06d', chunk_index) AS i, list_last(string_split({_SLASHED.format(p="audio_path")}, '/')) AS f FROM manifest_rows),
k AS (SELECT row_id, coalesce('base:' || nullif(trim(base_uid), ''), 'parent:' || nullif(trim(parent_uid), ''), 'transcript:' || nullif(trim(transcript_json), '') || ':' || i, 'source:' || nullif(trim(source_audio), '') || ':' || i,
    'uid:' || nullif(regexp_extract(f, '^([0-9a-f]{{8,40}})_[0-9a-f]{{8,40}}__', 1), ''), 'stem:' || regexp_replace(f, '\\.[a-z][a-z0-9]{{1,4}}$', '')) AS g FROM r)"""

ORACLES = {
    "path_keys": f"""WITH k AS (SELECT row_id, {_ROOTED} AS file_key FROM manifest_rows WHERE audio_path IS NOT NULL)
SELECT row_id, file_key, list_last(string_split(file_key, '/')) AS name, coalesce(CASE WHEN contains(file_key, '/chunks/') THEN substr(file_key, instr(file_key, '/chunks/')) END, CASE WHEN contains(file_key, '/recordings/') THEN substr(file_key, instr(file_key, '/recordings/')) END) AS tail FROM k""",
    "group_keys": f"""WITH {_GROUPED} SELECT row_id, g AS group_key FROM k""",
    "uid_backfill": """WITH b AS (SELECT row_id, uid, coalesce(nullif(base_uid, ''), substr(sha1(concat_ws('|', coalesce(source_audio, audio_path, ''), printf('%06d', coalesce(chunk_index, 0)), printf('%.3f', coalesce(core_start, 0)), printf('%.3f', coalesce(core_end, 0)))), 1, 16)) AS b FROM manifest_rows)
SELECT row_id, b AS base_uid, coalesce(nullif(uid, ''), b) AS uid FROM b""",
    "hash_buckets": f"""SELECT doc_id, {_H15.format(k="doc_id::VARCHAR")} % 10000 AS bucket, ('0x' || substr(sha1(doc_id::VARCHAR), 1, 16))::UBIGINT::VARCHAR AS hash,
    array_to_string(list_transform([8, 7, 6, 5, 4, 3, 2, 1], lambda i: substr(md5(doc_id::VARCHAR), 2 * i - 1, 2)), '') AS seed FROM documents""",
    "share_sample": f"SELECT doc_id FROM documents WHERE {_H15.format(k='doc_id::VARCHAR')} % 10000 < 3000",
    "deterministic_cap": f"SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY {_ORDER.format(seed='cap', k='doc_id')}, doc_id) <= 25",
    "deterministic_percent": f"SELECT doc_id FROM documents QUALIFY row_number() OVER (ORDER BY {_ORDER.format(seed='percent', k='doc_id')}, doc_id) <= greatest(1, floor(count(*) OVER () * 0.1))",
    "seeded_shuffle": f"SELECT doc_id, row_number() OVER (ORDER BY {_ORDER.format(seed='17', k='doc_id')}, doc_id) - 1 AS pos FROM documents",
    "group_split": f"""WITH {_GROUPED}, a AS (SELECT row_id, coalesce(g, 'row:' || row_id) AS g FROM k), g AS (SELECT DISTINCT g FROM a),
t AS (SELECT g, row_number() OVER (ORDER BY {_ORDER.format(seed='13', k='g')}, g) <= greatest(1, round_even(count(*) OVER () * 0.1, 0)) AS in_test FROM g) SELECT row_id, in_test FROM a JOIN t USING (g)""",
    "leak_audit": "SELECT base_uid FROM manifest_rows WHERE split_name = 'train' AND base_uid IS NOT NULL INTERSECT SELECT base_uid FROM manifest_rows WHERE split_name = 'test'",
    "public_private_cap": f"""WITH n AS (SELECT floor(count(*) * 0.3 / 0.7 + 1e-9) AS n FROM documents WHERE lang = 'de')
SELECT doc_id, 'private' AS scope FROM documents WHERE lang = 'de'
UNION ALL SELECT doc_id, 'public' FROM (SELECT doc_id, row_number() OVER (ORDER BY {_ORDER.format(seed='17', k='doc_id')}, doc_id) AS r FROM documents WHERE lang = 'en'), n WHERE r <= n""",
    "top_targets": f"WITH s AS (SELECT segment_id, {_SCORE} AS score FROM speech_segments) SELECT segment_id, score FROM s QUALIFY row_number() OVER (ORDER BY score DESC NULLS LAST, segment_id) <= greatest(1, floor(count(*) OVER () * 0.05))",
    "group_then_row_order": f"""WITH s AS (SELECT segment_id, audio_path, {_SCORE} AS score FROM speech_segments), b AS (SELECT audio_path, coalesce(max(score), 0) AS b, min(segment_id) AS f FROM s GROUP BY audio_path)
SELECT segment_id, row_number() OVER (ORDER BY b DESC, f, score DESC NULLS LAST, segment_id) - 1 AS rank FROM s JOIN b USING (audio_path)""",
    "score_lookup": f"""WITH t AS (SELECT lower(audio_path) AS path, max({_SCORE}) AS score FROM speech_segments WHERE audio_path IS NOT NULL GROUP BY 1)
SELECT row_id, CASE WHEN a.path IS NOT NULL THEN a.score ELSE s.score END AS score, CASE WHEN a.path IS NOT NULL THEN 0 WHEN s.path IS NOT NULL THEN 1 END AS hit
FROM manifest_rows m LEFT JOIN t a ON a.path = lower(m.audio_path) LEFT JOIN t s ON s.path = lower(m.source_audio)""",
    "name_lookup": rf"""WITH t AS (SELECT lower(audio_path) AS path, min(lang) AS language, list_last(string_split(lower(audio_path), '{_B}')) AS name FROM speech_segments WHERE audio_path IS NOT NULL AND lang IS NOT NULL GROUP BY ALL),
n AS (SELECT name, min(language) AS language FROM t GROUP BY name HAVING count(DISTINCT language) = 1),
r AS (SELECT seg_key, lower(audio_path) AS path, list_last(string_split_regex(lower(audio_path), '[\\/]')) AS name FROM segment_refs)
SELECT seg_key, coalesce(t.language, n.language) AS language, CASE WHEN t.language IS NOT NULL THEN 'exact' WHEN n.language IS NOT NULL THEN 'name' END AS tier FROM r LEFT JOIN t ON t.path = r.path LEFT JOIN n ON n.name = r.name""",
    "bottom_percent_filter": """WITH c AS (SELECT confidence AS v, row_number() OVER (ORDER BY confidence) AS r, count(*) OVER () AS n FROM speech_segments WHERE confidence IS NOT NULL AND NOT isnan(confidence)),
l AS (SELECT v FROM c WHERE r = greatest(floor(n * 0.1), 1)) SELECT segment_id FROM speech_segments WHERE confidence IS NULL OR (NOT isnan(confidence) AND confidence > (SELECT v FROM l))""",
    "target_anti": "WITH k AS (SELECT DISTINCT lower(audio_path) AS k FROM cut_tasks WHERE audio_path IS NOT NULL) SELECT row_id FROM manifest_rows WHERE NOT coalesce(lower(audio_path) IN (FROM k), false) AND NOT coalesce(lower(source_audio) IN (FROM k), false)",
    "target_semi": "WITH k AS (SELECT DISTINCT lower(audio_path) AS k FROM cut_tasks WHERE audio_path IS NOT NULL) SELECT row_id FROM manifest_rows WHERE coalesce(lower(audio_path) IN (FROM k), false) OR coalesce(lower(source_audio) IN (FROM k), false)",
    "incremental_anti": "SELECT task_id FROM cut_tasks t WHERE NOT EXISTS (SELECT 1 FROM segment_refs s WHERE lower(s.audio_path) = lower(t.audio_path))",
    "corrections_update": """WITH n AS (SELECT base_uid AS uid, arg_max(text, row_id) AS t FROM manifest_rows WHERE aug_stage <> '' AND base_uid IS NOT NULL AND text IS NOT NULL GROUP BY 1)
SELECT row_id, coalesce(t, text) AS text, t IS NOT NULL AND t IS DISTINCT FROM text AS changed FROM manifest_rows LEFT JOIN n USING (uid) WHERE aug_stage = ''""",
    "correction_conflicts": "SELECT base_uid AS uid, count(DISTINCT text) AS variants FROM manifest_rows WHERE aug_stage <> '' AND base_uid IS NOT NULL AND text IS NOT NULL GROUP BY 1 HAVING count(DISTINCT text) > 1",
    "map_upsert": "SELECT doc_id, rater, CASE WHEN rater < 'rater_05' THEN min(level) ELSE max(level) END AS level FROM reading_labels WHERE level IS NOT NULL AND rater IS NOT NULL GROUP BY doc_id, rater",
    "keep_longest": "SELECT audio_path, text FROM segment_refs WHERE audio_path IS NOT NULL AND text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY audio_path ORDER BY length(text) DESC, seg_key) = 1",
    "keep_first": "SELECT uid, row_id, split_name FROM manifest_rows QUALIFY row_number() OVER (PARTITION BY uid ORDER BY row_id) = 1",
    "span_lookup": f"""WITH p AS (SELECT segment_id, audio_path, ({_MS.format(c='start_time')} + {_MS.format(c='end_time')}) // 2 AS mid FROM speech_segments WHERE {_SPEECH}),
s AS (SELECT seg_key, audio_path, {_MS.format(c='start_sec')} AS s, {_MS.format(c='end_sec')} AS e FROM segment_refs WHERE audio_path IS NOT NULL AND NOT isnan(end_sec) AND end_sec > start_sec)
SELECT segment_id, seg_key FROM p JOIN s ON p.audio_path = s.audio_path AND s <= mid AND mid <= e""",
    "clipped_spans": f"""WITH a AS (SELECT segment_id AS audio_id, audio_path, {_MS.format(c='start_time')} AS s, {_MS.format(c='end_time')} AS e FROM audio_segments WHERE {_SPEECH}),
b AS (SELECT segment_id AS speech_id, audio_path, {_MS.format(c='start_time')} AS s, {_MS.format(c='end_time')} AS e FROM speech_segments WHERE {_SPEECH})
SELECT audio_id, speech_id, greatest(a.s, b.s) AS start_ms, least(a.e, b.e) AS end_ms FROM a JOIN b ON a.audio_path = b.audio_path AND a.s < b.e AND b.s < a.e AND a.e > a.s AND b.e > b.s""",
    "condition_grid": """SELECT task_id, snr_db, overlap, 'snr' || printf('%+d', snr_db::BIGINT) || 'dB_ov' || printf('%.2f', overlap) AS cond_id FROM cut_tasks, (SELECT unnest([-5.0, 0.0, 5.0])::DOUBLE AS snr_db), (SELECT unnest([0.0, 0.5])::DOUBLE AS overlap)""",
    "hash_pairing": f"""WITH p AS (SELECT task_id, row_number() OVER (ORDER BY task_id) - 1 AS pos, count(*) OVER () AS n FROM cut_tasks), w AS (SELECT task_id AS target, {_H15.format(k="task_id::VARCHAR || ':0'")} % n AS pos FROM p)
SELECT target, task_id AS other FROM w JOIN p USING (pos) WHERE target <> task_id""",
    "overlap_matrix": """WITH s AS (SELECT DISTINCT split_name AS o, text FROM manifest_rows WHERE split_name IS NOT NULL AND text IS NOT NULL), n AS (SELECT o, count(*) AS n FROM s GROUP BY o)
SELECT x.o AS a, y.o AS b, count(*) AS shared, least(any_value(p.n), any_value(q.n)) AS smaller, round(100.0 * count(*) / least(any_value(p.n), any_value(q.n)), 6) AS percent FROM s x JOIN s y ON x.text = y.text AND x.o < y.o JOIN n p ON p.o = x.o JOIN n q ON q.o = y.o GROUP BY 1, 2""",
    "two_way_diff": """WITH a AS (SELECT DISTINCT lower(audio_path) AS k FROM audio_segments WHERE audio_path IS NOT NULL), b AS (SELECT DISTINCT lower(audio_path) AS k FROM speech_segments WHERE audio_path IS NOT NULL)
SELECT k, 'left' AS side FROM a WHERE k NOT IN (FROM b) UNION ALL SELECT k, 'right' FROM b WHERE k NOT IN (FROM a)""",
    "append_union": "SELECT 'audio' AS t, count(*) AS n, 0::BIGINT AS texts, count(avg_amplitude) AS amplitudes FROM audio_segments UNION ALL SELECT 'speech', count(*), count(text), 0 FROM speech_segments",
    "cursor_slice": "SELECT doc_id FROM documents WHERE doc_id >= 300 AND trim(coalesce(text, '')) <> '' AND doc_id NOT IN (SELECT doc_id FROM reading_labels) ORDER BY doc_id LIMIT 200",
    "augmented_rows": """WITH b AS (SELECT row_id, uid, coalesce(nullif(base_uid, ''), uid) AS b, unnest([0, 1])::INTEGER AS c FROM manifest_rows WHERE coalesce(aug_stage, '') = '' AND (uid IS NULL OR coalesce(uid = base_uid, true)))
SELECT row_id, uid AS parent_uid, b AS base_uid, substr(sha1(concat_ws('|', b, 'noise', printf('copy%03d', c))), 1, 16) AS uid, 'noise' AS aug_stage, c AS aug_copy_idx, '5' AS snr_db FROM b""",
}
