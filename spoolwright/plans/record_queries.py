"""Queries on records: routing, validation, pairings, name matches, reports, sets, and the scores of single values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoolwright.functions import paths, runs, scores, text
from spoolwright.operators import edits, manifests, metrics, ranking, selection
from spoolwright.operators import records as rc
from spoolwright.operators import sequences as sq
from spoolwright.operators.order import ranked
from spoolwright.plans import metric_queries as mq
from spoolwright.plans.lookup_queries import _H15, _ROOTED, _SLASHED
from spoolwright.plans.signal_queries import _TOKEN
from spoolwright.session import table

_r6 = lambda c: F.round(c, 6)
_SPEECH = "audio_path is not null and not isnan(start_time) and not isnan(end_time) and end_time > start_time"


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "manifest_rows")


def chunk_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir).select("row_id", rc.chunk_index(F.col("chunk_index"), F.col("audio_path")).alias("chunk"))


def augmentation_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir).groupBy(rc.augmentation_label(F.col("audio_path")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def publish_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sq.shards(ranked(table(spark, sf_dir, "batch_map").where("original_file is not null").select("map_id", "original_file"), "map_id"), "pos", 500)
    return placed.select("map_id", rc.publish_path("data/", F.col("shard"), F.lower(F.trim("original_file"))).alias("path"))


def prediction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each item's map of predictions, by model, as rows with the margin. A model's last row of an item counts."""
    kept = mq._items(spark, sf_dir).groupBy("base_uid", "model").agg(F.max_by(F.struct("hyp", F.col("wer_target").cast("string").alias("t"), F.col("wer_other").cast("string").alias("o")), "row_id").alias("p"))
    items = kept.groupBy("base_uid").agg(F.map_from_entries(F.collect_list(F.struct("model", "p"))).alias("predictions"))  # a few models each
    long = items.select("base_uid", F.explode("predictions").alias("model", "p"))
    number = lambda c: F.col(f"p.{c}").try_cast("double")
    return long.select("base_uid", "model", F.length("p.hyp").alias("chars"), _r6(number("o") - number("t")).alias("margin"))


def model_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flat row for each model from its record of metrics."""
    m = mq._models(spark, sf_dir).select("model", F.struct("win_rate", "wer_target", "mean_margin").alias("metrics_overall"), F.round(F.col("speed") * 10_000_000).cast("long").alias("param_count"))
    return m.select("model", "metrics_overall.*", _r6(F.col("param_count") / 1e6).alias("params_m"))


def run_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run folder is, by the counts of what lies in it, and a name that no other has."""
    p = table(spark, sf_dir, "part").select("p_partkey", runs.run_kind(F.col("p_size") % 2, F.col("p_size") % 3, F.col("p_size") % 5).alias("kind"), "p_brand")
    named = p.withColumn("name", F.concat_ws("__", F.concat(F.lit("kind-"), "kind"), F.concat(F.lit("base-"), runs.token(F.col("p_brand")))))
    return sq.numbered_copies(named, "name", ["p_partkey"], "__u-").select("p_partkey", "kind", F.col("unique_label").alias("name"))


def useless_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = scores.numeric(F.col("confidence"))
    tier = scores.quality_tier(1 - c, c - 1, c * 3)
    use = lambda review: rc.is_useless(F.col("text"), tier, F.col("start_time"), F.col("end_time"), review)
    return table(spark, sf_dir, "speech_segments").select("segment_id", use(False).alias("useless"), use(True).alias("useless_or_review"))


def corrections_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections that change a base row's text: blank ones and those at least 0.95 alike are dropped (Arrow; no SQL form)."""
    r = _rows(spark, sf_dir)
    base = r.where("aug_stage = ''").groupBy("uid").agg(F.min_by("text", "row_id").alias("before"))
    both = r.where("aug_stage <> ''").select("row_id", F.col("base_uid").alias("uid"), F.col("text").alias("after")).join(base, "uid").where("trim(coalesce(after, '')) <> ''")
    return both.withColumn("ratio", edits.similarity("before", "after")).where("ratio < 0.95").select("row_id", _r6(F.col("ratio")).alias("ratio"))


def extreme_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks at the greatest target length and the least overlap; a null passes."""
    return rc.at_extremes(table(spark, sf_dir, "cut_tasks").select("task_id", "target_out_sec", "overlap_sec"), "target_out_sec", "overlap_sec").select("task_id")


def required_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _rows(spark, sf_dir).select(F.to_json(F.struct("uid", "audio_path", "text")).alias("line"))
    return rc.missing_keys(lines, "line", ["uid", "audio_path", "text"])


def publish_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", F.lower(F.regexp_replace("p_name", " ", "-")).alias("slug"), "p_name", F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("sub"))
    return p.select("p_partkey", F.array_join(rc.publish_issues(F.col("slug"), F.col("p_name"), F.col("sub")), ";").alias("issues"))


def enabled_backends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry's enabled models of one language mode, by backend."""
    s = table(spark, sf_dir, "supplier").select("s_name", text.flag(F.when(F.col("s_acctbal") > 0, "yes").otherwise("no")).alias("enabled"), F.when(F.col("s_suppkey") % 2 == 0, "en").otherwise("auto").alias("language_mode"), F.concat(F.lit("backend-"), (F.col("s_nationkey") % 3).cast("string")).alias("backend"))
    return rc.enabled_models(s, "en").groupBy("backend").agg(F.count(F.lit(1)).alias("models"), F.min("s_name").alias("first"))


def too_short_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.round(F.col("end_time") - F.col("start_time"), 3)
    decision, reason = rc.too_short(d, 1.0)
    return table(spark, sf_dir, "speech_segments").where(_SPEECH).select("segment_id", decision.alias("decision"), reason.isNotNull().alias("has_reason"))


def presence_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether loud speech makes up a fifth of a recording's speech and ten seconds at least."""
    s = table(spark, sf_dir, "audio_segments").where(_SPEECH).withColumn("sec", F.round(F.col("end_time") - F.col("start_time"), 3))
    return rc.presence(s, "audio_path", "sec", F.coalesce(F.col("is_speech"), F.lit(False)), F.coalesce(F.col("avg_amplitude") >= 0.1, F.lit(False)), 0.2, 10.0, 3)


def scored_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rc.scored_references(table(spark, sf_dir, "segment_refs"), "text").select("seg_key")


def run_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands of the include list without the excluded one; the first three (that is the feature)."""
    b = table(spark, sf_dir, "part").select(F.col("p_brand").alias("run")).distinct()
    return rc.selected_runs(b, "run", [f"Brand#{i}" for i in range(1, 8)], ["Brand#3"], 3)


def stem_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments whose recording's stem is among the stems of the packed originals, whatever folder and extension."""
    from spoolwright.operators import lookup

    s = table(spark, sf_dir, "segment_refs").where("audio_path is not null").select("seg_key", paths.stem(F.col("audio_path")).alias("s"))
    return lookup.with_any_key(s, [F.col("s")], table(spark, sf_dir, "batch_map").where("original_file is not null").select(paths.stem(F.col("original_file")).alias("k")), "k", "seg_key").select("seg_key")


def probe_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each task with two documents by hash; a document without a text gives way to the next that has one."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("i"), "text")
    return rc.paired_by_hash(table(spark, sf_dir, "cut_tasks").select(F.col("task_id").alias("i")), d, "i", F.trim("text") != "", 2, "s")


def round_robin_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rc.paired_in_turn(table(spark, sf_dir, "cut_tasks"), "task_id", 7)


def redraw_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rc.paired_with_redraw(table(spark, sf_dir, "cut_tasks"), "task_id")


def name_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recording of each task's output file, by its name."""
    names = table(spark, sf_dir, "speech_segments").where("audio_path is not null").select(paths.stem(F.col("audio_path")).alias("n"))
    tasks = table(spark, sf_dir, "cut_tasks").where("out_wav is not null").select("task_id", paths.stem(F.col("out_wav")).alias("s"))
    return rc.matched_names(tasks, "task_id", F.col("s"), names, "n")


def full_metric_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mq._items(spark, sf_dir).groupBy("model").agg(*metrics.full_record())


def metrics_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means by level of the augmentation (for the noise level) and by split (for the overlap)."""
    i = mq._items(spark, sf_dir).withColumn("level", F.round("confidence", 1))
    return i.groupingSets([["model", "level"], ["model", "cond"]], "model", "level", "cond").agg(F.count(F.lit(1)).alias("n"), _r6(F.avg("wer_target")).alias("wer_target"), F.grouping("cond").cast("boolean").alias("by_level"))


def condition_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.condition_means(mq._items(spark, sf_dir), "model", "cond")


def label_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds and mean vector of the first 20 vectors of each label."""
    m = manifests.first_rows_mean(table(spark, sf_dir, "embeddings").where("label is not null").withColumn("sec", F.lit(1.5)), "label", ["vec_id"], 20, "embedding", "sec")
    return m.select("label", "seconds", F.round(F.get("centroid", F.lit(0)), 4).alias("x0"), F.round(F.get("centroid", F.lit(1)), 4).alias("x1"))


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by status and by the prefix of their stage."""
    status = F.when(F.col("audio_path").isNull(), "error: no path").when(F.col("core_end") <= F.col("core_start"), "error: no length").otherwise("ok")
    return _rows(spark, sf_dir).groupBy(F.substring_index(status, ":", 1).alias("status"), F.substring_index("aug_stage", "_", 1).alias("stage")).agg(F.count(F.lit(1)).alias("n"))


def manifest_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rc.structure_report(_rows(spark, sf_dir), "source", F.coalesce("aug_stage", F.lit("")) != "")


def _speech_ms(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ms = lambda c: F.round(F.col(c) * 1000).cast("long")
    return table(spark, sf_dir, name).where(_SPEECH).withColumns({"s": ms("start_time"), "e": ms("end_time")})


def speech_pattern_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rc.speech_patterns(_speech_ms(spark, sf_dir, "speech_segments").select("audio_path", "s", "e", "segment_id", "confidence"), "audio_path", "s", "e", ["s", "e", "segment_id"], scores.numeric(F.col("confidence")))


def segment_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rc.energy_summary(_speech_ms(spark, sf_dir, "audio_segments"), "audio_path", F.col("e") - F.col("s"), F.coalesce(~F.col("is_speech"), F.lit(True)))


def efficiency_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mq._models(spark, sf_dir)
    return m.select("model", _r6(scores.efficiency(F.col("wer_target"), F.col("speed"), F.length("model"))).alias("efficiency"))


def model_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summed seconds of the items that a model has a prediction for; null for a model that has none."""
    wanted = spark.createDataFrame([(m,) for m in [*mq.STAGES, "absent"]], "model string")
    sums = mq._pairs(spark, sf_dir).groupBy("model").agg(F.round(F.sum("seconds"), 3).alias("seconds"))
    return wanted.join(sums, "model", "left")


def composite_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.composite(mq._models(spark, sf_dir), {"win_rate": 0.35, "mean_margin": 0.35, "speed": 0.20, "wer_other": 0.10}).select("model", "composite")


def order_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spoolwright.functions.hashing import hash_order

    d = table(spark, sf_dir, "documents").select("doc_id")
    return rc.order_changed(ranked(d, "doc_id"), ranked(d.withColumn("h", hash_order("17", F.col("doc_id"))), "h", "doc_id"), "pos", "doc_id")


def collision_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sq.numbered_copies(table(spark, sf_dir, "cut_tasks").select("task_id", paths.stem(F.col("audio_path")).alias("name")).where("name is not null"), "name", ["task_id"], "_", 0).select("task_id", "unique_label")


def moved_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return rc.moved_sample(d.where("lang = 'en'").select("doc_id"), d.where("lang = 'de'").select("doc_id"), "doc_id", 15, "move")


def holdout_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest rows that are no task's file, by path, name or stem."""
    from spoolwright.operators import lookup

    p = F.col("audio_path")
    rows = _rows(spark, sf_dir).where("audio_path is not null").select("row_id", F.lower(p).alias("p"), paths.base_name(p).alias("b"), paths.stem(p).alias("s"))
    o = F.col("out_wav")
    held = table(spark, sf_dir, "cut_tasks").where("out_wav is not null").select(F.explode(F.array(F.lower(o), paths.base_name(o), paths.stem(o))).alias("k"))
    return lookup.without_any_key(rows, [F.col("p"), F.col("b"), F.col("s")], held, "k").select("row_id")


def orphan_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output files of tasks that no manifest row names, whatever the case."""
    return table(spark, sf_dir, "cut_tasks").select(F.lower("out_wav").alias("file")).where("file is not null").subtract(_rows(spark, sf_dir).select(F.lower("audio_path")))


def folder_names_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names that stand among the packed originals and among the segments' recordings."""
    a = table(spark, sf_dir, "batch_map").select(paths.base_name(F.col("original_file")).alias("name"))
    return a.where("name is not null").intersect(table(spark, sf_dir, "segment_refs").select(paths.base_name(F.col("audio_path"))))


def processed_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (table(spark, sf_dir, t).select(F.lower("audio_path").alias("file")).where("file is not null") for t in ("cut_tasks", "speech_segments"))
    return a.union(b).distinct()


def ordered_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rc.ordered_distinct(table(spark, sf_dir, "documents"), "recording_key", "doc_id").select("recording_key", "first", "place")


def single_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of single values: levels, sizes, frames, factors, penalties."""
    a, d = F.col("avg_amplitude"), F.col("end_time") - F.col("start_time")
    words, refs = F.lit(7), F.length("audio_path") % 12
    penalty = scores.length_penalty(words, refs)
    columns = {
        "db": scores.rms_db(a), "gain": scores.gain_of_db(20 * a), "mb": scores.size_mb(d, 64.0), "penalty": penalty, "rtf": scores.real_time_factor(a, d),
        "severity": scores.severity(a, a / 2, F.lit(None).cast("double"), penalty, F.lit(0.25), F.lit(1.0)), "confidence": scores.confidence(F.col("max_amplitude") * 2),
    }
    kept = table(spark, sf_dir, "audio_segments").where(_SPEECH).where("avg_amplitude > 0 and not isnan(avg_amplitude) and max_amplitude >= 0 and not isnan(max_amplitude)")
    return kept.select("segment_id", *[F.round(c, 8).alias(n) for n, c in columns.items()], scores.context_size(d).alias("frames"), scores.colour_bin(a, F.lit(0.0), F.lit(0.5)).alias("bin"))


def score_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high = scores.spread_limits(F.round(F.log("confidence"), 6))
    s = table(spark, sf_dir, "speech_segments").where("confidence > 0 and not isnan(confidence) and audio_path is not null")
    return s.groupBy("audio_path").agg(F.round(low, 9).alias("low"), F.round(high, 9).alias("high"))


def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = paths.base_name(F.col("out_wav"))
    quoted = F.concat(F.lit(' "'), F.col("out_wav"), F.lit('" '))
    return table(spark, sf_dir, "cut_tasks").where("out_wav is not null").select("task_id", paths.base_recording_name(name, "__core").alias("base"), paths.strip_suffixes(name, r"__core\d+|-\d+").alias("stripped"), (paths.slashed(paths.unquoted(quoted)) == paths.slashed(F.col("out_wav"))).alias("same"), runs.token(name).alias("token"))


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "segment_refs").where("text is not null").select("seg_key", text.prompt("Reference:", F.col("text"), 40).alias("prompt"), text.short_model_name(F.col("audio_path")).isNotNull().alias("named"))


def nested_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents that hold them at the top, or else in their segments; their text; a setting with a default."""
    word = F.split(F.trim("text"), " ")
    s = table(spark, sf_dir, "segment_refs").where("text is not null").select("seg_key", F.when(F.col("idx") % 2 == 0, word).alias("words"), F.array(F.struct(word.alias("words"), F.col("text").alias("text")), F.struct(F.array(F.lit("end")).alias("words"), F.lit(" end ").alias("text"))).alias("segments"), F.to_json(F.struct(F.struct(F.col("lang").alias("lang")).alias("cfg"))).alias("cfg"))
    found = F.coalesce(F.when(F.size("words") > 0, F.col("words")), F.flatten(F.transform("segments", lambda x: x["words"])))
    rebuilt = F.array_join(F.filter(F.transform("segments", lambda x: F.trim(x["text"])), lambda t: t != ""), " ")
    return s.select("seg_key", F.size(found).alias("words"), rebuilt.alias("rebuilt"), F.coalesce(F.get_json_object("cfg", "$.cfg.lang"), F.lit("none")).alias("lang"))


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") % 4 != 0, F.split("p_name", " ")).alias("state"))
    return s.select("p_partkey", F.array_join(rc.appended_history(F.col("state"), F.lit("now"), 2), ",").alias("history"))


def comparison_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base text as original and an augmented row's as patched, against the base row's other speaker as reference."""
    p = mq._pairs(spark, sf_dir).where("other is not null")
    return rc.compared(p, "other", "ref", "hyp").select("row_id", "norm_match", _r6(F.col("wer_original")).alias("wer_original"), _r6(F.col("cer_patched")).alias("cer_patched"), "better")


def slim_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key, path, text and length of the rows with a path: by uid, else id, else the canonical path."""
    roots = paths.root_pairs(table(spark, sf_dir, "path_roots"))
    return _rows(spark, sf_dir).where("audio_path is not null").select(F.coalesce(F.nullif("uid", F.lit("")), paths.file_key(F.col("audio_path"), roots)).alias("key"), "audio_path", "text", F.round(F.col("core_end") - F.col("core_start"), 3).alias("seconds"))


def worklist_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash order of the documents, in epochs of 300: the rows of a cursor's second step of 200, which reaches into the second epoch."""
    return selection.epoch_slice(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", "epoch", 300, 200, 200)


QUERIES = {
    f.__name__: f
    for f in (
        chunk_indices, augmentation_labels, publish_paths, prediction_rows, model_summaries, run_folders, useless_segments, corrections_kept, extreme_conditions, required_keys, publish_checks, enabled_backends, too_short_routing, presence_decisions,
        scored_references, run_selection, stem_semi, probe_pairing, round_robin_pairing, redraw_pairing, name_matches, full_metric_record, metrics_by_level, condition_means, label_means, status_counts, manifest_structure, speech_pattern_summary,
        segment_energy, efficiency_ratio, model_seconds, composite_scores, order_changed, collision_suffixes, moved_sample, holdout_excluded, orphan_files, folder_names_shared, processed_union, ordered_sources, single_values, score_limits, path_parts,
        prompts, nested_words, run_history, comparison_records, slim_manifest, worklist_step,
    )
}
_BASE = "list_last(string_split(" + _SLASHED + ", '/'))"
_STEM = "regexp_replace(" + _BASE + r", '\.[a-z][a-z0-9]{{1,4}}$', '')"
_OK = "audio_path IS NOT NULL AND NOT isnan(start_time) AND NOT isnan(end_time) AND end_time > start_time"
_C = "CASE WHEN NOT isnan(confidence) THEN confidence END"
_MS = "audio_path, segment_id, CAST(round(start_time * 1000) AS BIGINT) AS s, CAST(round(end_time * 1000) AS BIGINT) AS e"
_I, _M, _P = mq._ITEMS, mq._MODELS, "p AS (SELECT task_id, row_number() OVER (ORDER BY task_id) - 1 AS pos, count(*) OVER () AS n FROM cut_tasks)"
_NORM = "CASE WHEN {c} IS NULL THEN NULL WHEN max({c}) OVER () > min({c}) OVER () THEN ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) ELSE 0.5 END"

ORACLES = {
    "chunk_indices": r"SELECT row_id, coalesce(chunk_index, nullif(regexp_extract(lower(audio_path), '(?:chunk|core)(\d+)', 1), '')::INT) AS chunk FROM manifest_rows",
    "augmentation_labels": "SELECT CASE WHEN audio_path IS NOT NULL THEN coalesce(list_filter(['reverb', 'noise_mix', 'voice_mix', 'tempo'], lambda x: contains(lower(audio_path), x))[1], 'original') END AS label, count(*) AS n FROM manifest_rows GROUP BY 1",
    "publish_paths": r"SELECT map_id, 'data/part-' || printf('%05d', (row_number() OVER (ORDER BY map_id) - 1) // 500) || '/' || regexp_replace(regexp_replace(lower(trim(original_file)), '\\+', '/', 'g'), '^/+', '') AS path FROM batch_map WHERE original_file IS NOT NULL",
    "prediction_rows": _I + "SELECT base_uid, model, length(hyp)::INT AS chars, round(wer_other - wer_target, 6) AS margin FROM items QUALIFY row_number() OVER (PARTITION BY base_uid, model ORDER BY row_id DESC) = 1",
    "model_summaries": _M + "SELECT model, win_rate, wer_target, mean_margin, round(round(speed * 10000000)::BIGINT / 1e6, 6) AS params_m FROM models",
    "run_folders": f"""WITH k AS (SELECT p_partkey, CASE WHEN p_size % 2 > 0 THEN 'train' WHEN p_size % 3 > 0 THEN 'eval' WHEN p_size % 5 > 0 THEN 'data' ELSE 'unknown' END AS kind, {_TOKEN.format(c='p_brand')} AS b FROM part),
n AS (SELECT *, 'kind-' || kind || '__base-' || b AS n, row_number() OVER (PARTITION BY kind, b ORDER BY p_partkey) AS i FROM k) SELECT p_partkey, kind, CASE WHEN i = 1 THEN n ELSE n || '__u-' || i END AS name FROM n""",
    "useless_segments": f"""WITH s AS (SELECT *, {_C} AS c FROM speech_segments), t AS (SELECT *, coalesce(1 - c >= 0.6 OR c - 1 < -0.6 OR c * 3 > 2.5, false) AS d, coalesce(1 - c >= 0.1 OR c - 1 <= -0.3 OR c * 3 >= 2, false) AS r,
    trim(coalesce(text, '')) IN ('', '.', '…') OR coalesce(isnan(start_time) OR isnan(end_time) OR end_time <= start_time, true) AS u FROM s) SELECT segment_id, u OR d AS useless, u OR d OR r AS useless_or_review FROM t""",
    "extreme_conditions": """WITH e AS (SELECT max(CASE WHEN NOT isnan(target_out_sec) THEN target_out_sec END) AS hi, min(CASE WHEN NOT isnan(overlap_sec) THEN overlap_sec END) AS lo FROM cut_tasks)
SELECT task_id FROM cut_tasks, e WHERE (target_out_sec IS NULL OR target_out_sec = hi) AND (overlap_sec IS NULL OR overlap_sec = lo)""",
    "required_keys": "WITH m AS (SELECT uid IS NULL OR audio_path IS NULL OR text IS NULL AS b FROM manifest_rows) SELECT count(*) AS rows, 0::BIGINT AS unreadable, count(*) FILTER (b) AS incomplete, count(*) > 0 AND count(*) FILTER (b) = 0 AS ok FROM m",
    "publish_checks": """WITH p AS (SELECT p_partkey, lower(replace(p_name, ' ', '-')) AS s, p_name AS t, concat_ws(' ', p_name, p_type, p_brand) AS u FROM part)
SELECT p_partkey, concat_ws(';', CASE WHEN NOT (regexp_full_match(s, '[a-z0-9]+(?:-[a-z0-9]+)*') AND length(s) BETWEEN 6 AND 50) THEN 'id' END, CASE WHEN NOT length(t) BETWEEN 6 AND 50 THEN 'title' END, CASE WHEN NOT length(u) BETWEEN 20 AND 80 THEN 'subtitle' END) AS issues FROM p""",
    "enabled_backends": "SELECT 'backend-' || (s_nationkey % 3) AS backend, count(*) AS models, min(s_name) AS first FROM supplier WHERE s_acctbal > 0 AND s_suppkey % 2 = 0 GROUP BY 1",
    "too_short_routing": f"SELECT segment_id, CASE WHEN round(end_time - start_time, 3) < 1 THEN 'OTHER' END AS decision, round(end_time - start_time, 3) < 1 AS has_reason FROM speech_segments WHERE {_OK}",
    "presence_decisions": f"""WITH s AS (SELECT audio_path, round(end_time - start_time, 3) AS x, coalesce(is_speech, false) AS v, coalesce(is_speech AND avg_amplitude >= 0.1, false) AS p FROM audio_segments WHERE {_OK}),
g AS (SELECT audio_path, round(coalesce(sum(x) FILTER (v), 0), 3) AS voiced, round(coalesce(sum(x) FILTER (p), 0), 3) AS present, count(*) FILTER (v) AS n FROM s GROUP BY 1) SELECT audio_path, voiced, present, present >= greatest(0.2 * voiced, 10) AND n >= 3 AS is_present FROM g""",
    "scored_references": "SELECT seg_key FROM segment_refs WHERE lower(trim(coalesce(text, ''))) NOT IN ('', 'ignore time segment in scoring')",
    "run_selection": "SELECT DISTINCT p_brand AS run FROM part WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#4', 'Brand#5', 'Brand#6', 'Brand#7') ORDER BY 1 LIMIT 3",
    "stem_semi": f"SELECT seg_key FROM segment_refs WHERE audio_path IS NOT NULL AND {_STEM.format(p='audio_path')} IN (SELECT {_STEM.format(p='original_file')} FROM batch_map WHERE original_file IS NOT NULL)",
    "probe_pairing": f"""WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos, count(*) OVER () AS n, coalesce(trim(text) <> '', false) AS ok FROM documents),
t AS (SELECT task_id AS target, k::INT AS k, {_H15.format(k="task_id::VARCHAR || ':' || k || ':s'")} % (SELECT count(*) FROM documents) AS pos FROM cut_tasks, range(2) r(k))
SELECT target, k, arg_min(doc_id, (o.pos - t.pos + n) % n) AS other FROM t JOIN o ON ok AND doc_id <> target AND (o.pos - t.pos + n) % n <= 24 GROUP BY 1, 2""",
    "round_robin_pairing": f"WITH {_P} SELECT a.task_id AS target, b.task_id AS other FROM p a JOIN p b ON b.pos = (a.pos + 7) % a.n AND a.task_id <> b.task_id",
    "redraw_pairing": f"""WITH {_P}, d AS (SELECT *, {_H15.format(k="task_id::VARCHAR || ':0'")} % n AS x, {_H15.format(k="task_id::VARCHAR || ':1'")} % n AS y FROM p)
SELECT d.task_id AS target, p.task_id AS other FROM d JOIN p ON p.pos = CASE WHEN x <> d.pos THEN x ELSE y END AND p.task_id <> d.task_id""",
    "name_matches": rf"""WITH n AS (SELECT DISTINCT {_STEM.format(p='audio_path')} AS n FROM speech_segments WHERE audio_path IS NOT NULL), f AS (SELECT substr(n, 1, 12) AS f, min(n) AS n FROM n WHERE length(n) >= 12 GROUP BY 1 HAVING count(*) = 1),
t AS (SELECT task_id, {_STEM.format(p='out_wav')} AS s FROM cut_tasks WHERE out_wav IS NOT NULL), b AS (SELECT *, regexp_replace(s, '(?:__(?:core|chunk)\d+(?:__[^_]+)?|_compact|_sent\d*)$', '') AS b FROM t)
SELECT task_id, coalesce(x.n, y.n, f.n) AS match, CASE WHEN x.n IS NOT NULL THEN 'exact' WHEN y.n IS NOT NULL THEN 'stripped' WHEN f.n IS NOT NULL THEN 'prefix' END AS tier FROM b LEFT JOIN n x ON x.n = s LEFT JOIN n y ON y.n = b LEFT JOIN f ON length(s) >= 12 AND f = substr(s, 1, 12)""",
    "full_metric_record": _I + """SELECT model, count(*) AS samples, round(sum(word_edits) / nullif(sum(ref_words), 0), 6) AS wer_micro_target, round(sum(other_edits) FILTER (other IS NOT NULL) / nullif(sum(other_words) FILTER (other IS NOT NULL), 0), 6) AS wer_micro_other,
    round(sum(char_edits) / nullif(sum(length(r)), 0), 6) AS cer_micro_target, round(sum(other_char_edits) FILTER (other IS NOT NULL) / nullif(sum(length(o)) FILTER (other IS NOT NULL), 0), 6) AS cer_micro_other,
    round(avg(wer_target), 6) AS wer_macro_target, round(avg(wer_other), 6) AS wer_macro_other, round(avg(cer_target), 6) AS cer_macro_target, round(avg(cer_other), 6) AS cer_macro_other,
    round(avg(coalesce(wer_target < wer_other, false)::INT), 6) AS win_rate, round(avg(wer_other - wer_target), 6) AS margin_wer, round(avg(cer_other - cer_target), 6) AS margin_cer, round(avg(capped::INT), 6) AS cap_rate FROM items GROUP BY model""",
    "metrics_by_level": _I + "SELECT model, level, cond, count(*) AS n, round(avg(wer_target), 6) AS wer_target, grouping(cond) = 1 AS by_level FROM (SELECT *, round(confidence, 1) AS level FROM items) GROUP BY GROUPING SETS ((model, level), (model, cond))",
    "condition_means": _I + "SELECT model, cond, round(avg(coalesce(wer_target < wer_other, false)::INT), 6) AS win, round(avg(wer_target), 6) AS wer, round(avg(wer_other - wer_target), 6) AS margin FROM items WHERE cond IS NOT NULL GROUP BY ALL",
    "label_means": """WITH f AS (SELECT * FROM embeddings WHERE label IS NOT NULL QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) <= 20), l AS (SELECT label, unnest(range(1, len(embedding) + 1)) AS d, unnest(embedding)::DOUBLE AS x FROM f),
m AS (SELECT label, d, avg(x) AS m FROM l GROUP BY ALL), s AS (SELECT label, sqrt(sum(m * m)) AS s, any_value(m) FILTER (d = 1) AS a, any_value(m) FILTER (d = 2) AS b FROM m GROUP BY label), n AS (SELECT label, count(*) * 1.5::DOUBLE AS seconds FROM f GROUP BY label)
SELECT label, seconds, round(a / s, 4) AS x0, round(b / s, 4) AS x1 FROM s JOIN n USING (label)""",
    "status_counts": "SELECT CASE WHEN audio_path IS NULL OR core_end <= core_start THEN 'error' ELSE 'ok' END AS status, split_part(aug_stage, '_', 1) AS stage, count(*) AS n FROM manifest_rows GROUP BY ALL",
    "manifest_structure": "SELECT source, count(*) AS rows, count(*) FILTER (coalesce(aug_stage, '') <> '') AS mixed, count(*) FILTER (coalesce(aug_stage, '') = '') AS original FROM manifest_rows GROUP BY source",
    "speech_pattern_summary": f"""WITH s AS (SELECT {_MS}, {_C} AS c FROM speech_segments WHERE {_OK}), g AS (SELECT *, lead(s) OVER (PARTITION BY audio_path ORDER BY s, e, segment_id) - e AS g FROM s)
SELECT audio_path, count(*) AS segments, round(avg(c), 6) AS confidence, greatest(coalesce(max(g), 0), 0) AS longest_gap, round(sum(e - s) / (max(e) - min(s)), 6) AS density FROM g GROUP BY 1""",
    "segment_energy": f"""WITH s AS (SELECT {_MS}, coalesce(NOT is_speech, true) AS q FROM audio_segments WHERE {_OK}), g AS (SELECT audio_path, count(*) AS segments, CAST(sum(e - s) AS BIGINT) AS total, CAST(coalesce(sum(e - s) FILTER (q), 0) AS BIGINT) AS silence FROM s GROUP BY 1)
SELECT *, round(100 * silence / nullif(total, 0), 4) AS percent FROM g""",
    "efficiency_ratio": _M + "SELECT model, CASE WHEN speed * length(model) > 0 THEN round(1 / (1 + greatest(wer_target, 0)) / (speed * length(model)), 6) END AS efficiency FROM models",
    "model_seconds": _I + f"SELECT m.model, round(s, 3) AS seconds FROM (SELECT unnest({[*mq.STAGES, 'absent']}) AS model) m LEFT JOIN (SELECT model, sum(seconds) AS s FROM p GROUP BY model) USING (model)",
    "composite_scores": _M + "SELECT model, round(" + " + ".join(f"{w} * ({_NORM.format(c=c)})" for c, w in (("win_rate", 0.35), ("mean_margin", 0.35), ("speed", 0.2), ("wer_other", 0.1))) + ", 6) AS composite FROM models",
    "order_changed": """WITH a AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS p FROM documents), b AS (SELECT doc_id, row_number() OVER (ORDER BY sha1('17' || doc_id::VARCHAR), doc_id) AS p FROM documents)
SELECT count(*) AS compared, count(*) FILTER (a.doc_id <> b.doc_id) AS differing, count(*) FILTER (a.doc_id <> b.doc_id) > 0 AS changed FROM a JOIN b USING (p) WHERE p <= 100""",
    "collision_suffixes": f"WITH n AS (SELECT task_id, {_STEM.format(p='audio_path')} AS n FROM cut_tasks WHERE audio_path IS NOT NULL), r AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY task_id) AS k FROM n) SELECT task_id, CASE WHEN k = 1 THEN n ELSE n || '_' || (k - 1) END AS unique_label FROM r",
    "moved_sample": "SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY sha1('move' || doc_id::VARCHAR), doc_id) <= 15 THEN 'target' ELSE 'source' END AS side FROM documents WHERE lang = 'en' UNION ALL SELECT doc_id, 'target' FROM documents WHERE lang = 'de'",
    "holdout_excluded": f"""WITH h AS (SELECT DISTINCT unnest([lower(out_wav), {_BASE.format(p='out_wav')}, {_STEM.format(p='out_wav')}]) AS k FROM cut_tasks WHERE out_wav IS NOT NULL)
SELECT row_id FROM manifest_rows WHERE audio_path IS NOT NULL AND lower(audio_path) NOT IN (FROM h) AND {_BASE.format(p='audio_path')} NOT IN (FROM h) AND {_STEM.format(p='audio_path')} NOT IN (FROM h)""",
    "orphan_files": "SELECT lower(out_wav) AS file FROM cut_tasks WHERE out_wav IS NOT NULL EXCEPT SELECT lower(audio_path) FROM manifest_rows",
    "folder_names_shared": f"SELECT {_BASE.format(p='original_file')} AS name FROM batch_map WHERE original_file IS NOT NULL INTERSECT SELECT {_BASE.format(p='audio_path')} FROM segment_refs",
    "processed_union": "SELECT lower(audio_path) AS file FROM cut_tasks WHERE audio_path IS NOT NULL UNION SELECT lower(audio_path) FROM speech_segments WHERE audio_path IS NOT NULL",
    "ordered_sources": "SELECT recording_key, min(doc_id) AS first, row_number() OVER (ORDER BY min(doc_id), recording_key) - 1 AS place FROM documents WHERE recording_key IS NOT NULL GROUP BY recording_key",
    "single_values": f"""WITH s AS (SELECT segment_id, avg_amplitude AS a, max_amplitude * 2 AS x, end_time - start_time AS d, length(audio_path) % 12 AS f FROM audio_segments WHERE {_OK} AND avg_amplitude > 0 AND NOT isnan(avg_amplitude) AND max_amplitude >= 0 AND NOT isnan(max_amplitude)), q AS (SELECT *, least(1.0::DOUBLE, abs(7 - f) / greatest(f, 1)) AS pen FROM s)
SELECT segment_id, round(20 * log10(greatest(a, 1e-10)), 8) AS db, round(pow(10.0::DOUBLE, 20 * a / 20), 8) AS gain, round(d * 64.0::DOUBLE * 1000 / 8 / 1000000, 8) AS mb, round(pen, 8) AS penalty, round(a / d, 8) AS rtf,
    round((0.7::DOUBLE * a + 0.3::DOUBLE * (a / 2)) * (1 + 0.4::DOUBLE * pen + 0.4::DOUBLE * 0.25 + 0.2::DOUBLE), 8) AS severity, round(least(greatest(CASE WHEN x < 0 THEN exp(x) WHEN x > 1 THEN x / 100 ELSE x END, 0), 1), 8) AS confidence,
    (ceil(ceil(d * 1500 / 30) / 16) * 16)::INT AS frames, least(floor(least(a, 0.5::DOUBLE) / 0.5::DOUBLE * 7), 6)::INT AS bin FROM q""",
    "score_limits": "WITH s AS (SELECT audio_path, round(ln(confidence), 6) AS v FROM speech_segments WHERE confidence > 0 AND NOT isnan(confidence) AND audio_path IS NOT NULL) SELECT audio_path, CASE WHEN count(*) >= 5 THEN round(quantile_cont(v, 0.05), 9) ELSE -2 END::DOUBLE AS low, CASE WHEN count(*) >= 5 THEN round(quantile_cont(v, 0.95), 9) ELSE 0 END::DOUBLE AS high FROM s GROUP BY 1",
    "path_parts": rf"""WITH n AS (SELECT task_id, {_BASE.format(p='out_wav')} AS n FROM cut_tasks WHERE out_wav IS NOT NULL)
SELECT task_id, split_part(n, '__core', 1) AS base, regexp_replace(n, '(?:__core\d+|-\d+)+((?:\.[A-Za-z0-9]+)?)$', '\1') AS stripped, true AS same, {_TOKEN.format(c='n')} AS token FROM n""",
    "prompts": "SELECT seg_key, regexp_replace('Reference: ' || substr(text, 1, 40), '^ +| +$', '', 'g') AS prompt, audio_path IS NOT NULL AS named FROM segment_refs WHERE text IS NOT NULL",
    "nested_words": """SELECT seg_key, (len(string_split(trim(text), ' ')) + CASE WHEN idx % 2 = 0 THEN 0 ELSE 1 END)::INT AS words, CASE WHEN trim(text) = '' THEN 'end' ELSE trim(text) || ' end' END AS rebuilt, coalesce(lang, 'none') AS lang FROM segment_refs WHERE text IS NOT NULL""",
    "run_history": "SELECT p_partkey, array_to_string(list_append(CASE WHEN p_size % 4 <> 0 THEN string_split(p_name, ' ') ELSE [] END, 'now')[-2:], ',') AS history FROM part",
    "comparison_records": _I + f""", w AS (SELECT row_id, r = h AS norm_match, CASE WHEN other_words > 0 THEN {mq._distance('o', 'r')} / other_words WHEN r <> '' THEN 1.0 ELSE 0.0 END AS wer_original, cer_other, wer_other FROM items WHERE other IS NOT NULL)
SELECT row_id, norm_match, round(wer_original, 6) AS wer_original, round(cer_other, 6) AS cer_patched, CASE WHEN wer_original - wer_other > 1e-9 THEN 'patched' WHEN wer_original - wer_other < -1e-9 THEN 'original' ELSE 'tie' END AS better FROM w""",
    "slim_manifest": f"SELECT coalesce(nullif(uid, ''), {_ROOTED}) AS key, audio_path, text, round(core_end - core_start, 3) AS seconds FROM manifest_rows WHERE audio_path IS NOT NULL",
    "worklist_step": """WITH e AS (SELECT doc_id, e::INT AS epoch, row_number() OVER (PARTITION BY e ORDER BY sha1('epoch' || e || doc_id::VARCHAR), doc_id) - 1 AS at FROM documents, range(2) r(e)) SELECT doc_id, epoch, e.at FROM e WHERE e.at < 300 AND e.at + epoch * 300 BETWEEN 200 AND 399""",
}
