"""Queries on evaluation results. Augmented rows stand for a recogniser's output on their base row's text: the stage is the model, the split the condition, the base row after it in its transcript the other speaker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spoolwright.functions import scores
from spoolwright.functions.text import asr_key, key_words
from spoolwright.operators import edits, metrics, ranking, vectors
from spoolwright.session import table

STAGES = ["freq", "gain", "noise", "others_mix", "reverb", "tempo"]


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "manifest_rows").select("row_id", "uid", "base_uid", "aug_stage", "split_name", "text", "transcript_json", "core_start", "core_end", F.col("aug_meta")["amount"].try_cast("double").alias("confidence"))
    first = rows.where("aug_stage = ''").groupBy("uid").agg(F.min_by(F.struct("row_id", "text", "transcript_json", "core_start", "core_end"), "row_id").alias("s")).select(F.col("uid").alias("base_uid"), "s.*")
    # a row without a transcript has no other speaker; the window spreads these over their uids
    first = first.withColumn("other", F.lead("text").over(Window.partitionBy(F.coalesce("transcript_json", F.concat(F.lit("\x01"), "base_uid"))).orderBy("row_id")))
    refs = first.select("base_uid", F.col("text").alias("ref"), (F.col("core_end") - F.col("core_start")).alias("seconds"), F.col("other"))
    return rows.where("aug_stage <> '' and base_uid is not null").select("row_id", "base_uid", F.col("aug_stage").alias("model"), F.col("split_name").alias("cond"), F.col("text").alias("hyp"), "confidence").join(refs, "base_uid")


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = edits.error_rates(_pairs(spark, sf_dir)).withColumnsRenamed({"wer": "wer_target", "cer": "cer_target", "word_edits": "target_edits", "ref_words": "target_words", "ref_chars": "target_chars", "char_edits": "target_char_edits"})
    both = edits.error_rates(target, "other", "hyp").withColumnsRenamed({"wer": "wer_other", "cer": "cer_other", "word_edits": "other_edits", "ref_words": "other_words", "ref_chars": "other_chars", "char_edits": "other_char_edits"})
    both = both.withColumns({c: F.when(F.col("other").isNotNull(), F.col(c)) for c in ("wer_other", "cer_other", "other_edits", "other_words", "other_chars", "other_char_edits")})
    return both.withColumnsRenamed({"target_edits": "word_edits", "target_words": "ref_words", "target_chars": "ref_chars", "target_char_edits": "char_edits"}).withColumn("capped", F.coalesce(F.length("hyp") >= 150, F.lit(False)))


def item_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    r6 = lambda c: F.round(c, 6).alias(c)
    return _items(spark, sf_dir).select("row_id", "ref_words", "word_edits", r6("wer_target"), r6("cer_target"), r6("wer_other"), "capped")


def first_words_wer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word edits of all words, however long the texts; the name is older than that."""
    n = lambda c: F.coalesce(asr_key(F.col(c)), F.lit(""))
    p = _pairs(spark, sf_dir).withColumns({"r": n("ref"), "h": n("hyp")}).where("r <> '' and h <> ''")
    return p.select("row_id", edits.word_edits("r", "h").alias("edits"))


def metrics_by_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.by_condition(_items(spark, sf_dir).where("cond is not null"), "model", "cond")


def metrics_by_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(spark, sf_dir).groupBy("model", scores.duration_bucket(F.col("seconds")).alias("bucket")).agg(*metrics.metric_record())


def stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.stability(_items(spark, sf_dir), "model", "cond", "wer_target")


def tail_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.quantiles(_items(spark, sf_dir), "model", "wer_other")


def prediction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.summary(_items(spark, sf_dir), "model", "cer_target")


def pairwise_win_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.pairwise_wins(_items(spark, sf_dir), "base_uid", "model", "wer_target", STAGES)


def performance_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.performance_profile(_items(spark, sf_dir), "base_uid", "model", "wer_other", [1.0, 1.1, 1.5, 2.0])


def performance_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole profile of the target error on 120 taus; performance_profile has four of the other speaker's error."""
    return metrics.performance_curve(_items(spark, sf_dir), "base_uid", "model", "wer_target")


def ecdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.ecdf(_items(spark, sf_dir).withColumn("w", F.round("wer_target", 6)), "model", "w")


def bootstrap_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """95 % intervals of the mean error by resampling (no SQL form)."""
    return metrics.bootstrap_interval(_items(spark, sf_dir), "model", "row_id", "wer_target")


def _models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(spark, sf_dir).groupBy("model").agg(*metrics.metric_record()).select("model", "win_rate", "wer_target", "wer_other", "mean_margin", F.round(F.col("items") / 10.0, 6).alias("speed"))


def condition_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.competition_ranks(_models(spark, sf_dir), "win_rate", "wer_target").select("model", "rank_high", "rank_low", "rank_blend")


def zscore_separation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.z_scores(_models(spark, sf_dir), "win_rate", "mean_margin").select("model", "z_win_rate", "z_mean_margin")


def pareto_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.pareto(_models(spark, sf_dir), "wer_target", "wer_other", "model").select("model", "wer_target", "wer_other")


def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _models(spark, sf_dir)
    registry = table(spark, sf_dir, "manifest_rows").where("aug_stage <> ''").select(F.col("aug_stage").alias("model")).distinct()
    return ranking.leaderboard(registry, [m.select("model", "win_rate"), m.where("model <> 'gain'").select("model", "speed")], "model", "win_rate", "speed").select("model", "win_rate", "speed", "score", "position")


def severity_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.severity_by_target(ranking.severities(_items(spark, sf_dir)), "base_uid")


def severity_worst(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ranking.severities(_items(spark, sf_dir)).select("model", "cond", "row_id", "severity").where("cond is not null")
    return ranking.worst_item(rows, "model", "cond", by="severity", tie="row_id")


def pivot_model_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(spark, sf_dir).groupBy("model").pivot("cond", ["test", "train", "validation"]).agg(F.round(F.avg("wer_target"), 6))


def fuzzy_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of the transcripts near a keyword."""
    words = table(spark, sf_dir, "segment_refs").select("seg_key", F.explode(F.array_distinct(key_words(F.col("text")))).alias("token"))
    keys = spark.createDataFrame([("bakery",), ("archive",), ("market",)], "keyword string")
    return edits.near_keywords(words, "token", keys, "keyword", 2)


def repeat_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split(F.lower("text"), " ")
    return table(spark, sf_dir, "segment_refs").where("text is not null").select("seg_key", F.round(scores.repeat_share(words, 2), 6).alias("bigrams"), F.round(scores.repeat_share(words, 3), 6).alias("trigrams"))


def multi_dim_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.groupingSets([["source", "lang"], ["source"], []], "source", "lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"), F.grouping_id().cast("int").alias("level"))


def payload_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.payload(table(spark, sf_dir, "documents"), "recording_key", "n_chars")


def content_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.content_signature(table(spark, sf_dir, "documents").where("source is not null"), "source", "doc_id", "n_chars")


def speaker_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.when(~F.isnan("duration"), F.col("duration"))
    return table(spark, sf_dir, "speech_segments").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(d), 3).alias("seconds"), F.round(F.avg(F.when(~F.isnan("confidence"), F.col("confidence"))), 6).alias("confidence"))


def speed_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = (F.unix_micros(F.col("ingested_at").cast("timestamp")) - F.unix_micros(F.col("detected_at").cast("timestamp"))) / 1e6
    rows = table(spark, sf_dir, "audio_segments").where("not isnan(duration) and duration > 0").select("is_speech", late.alias("wait"), "duration")
    return rows.groupBy("is_speech").agg(F.count(F.lit(1)).alias("n"), F.round(F.min("wait"), 3).alias("least"), F.round(F.max("wait"), 3).alias("most"), F.round(F.sum("wait") / F.sum("duration"), 4).alias("factor"))


def centroid_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine of every vector to the centroid of its label."""
    e = table(spark, sf_dir, "embeddings")
    mean = vectors.centroid(e, "label", "embedding")
    return e.join(mean, "label").select("vec_id", F.round(vectors.cosine(F.col("embedding"), F.col("centroid")), 4).alias("score"))


def max_sim_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector against the stated set of label centroids; max_sim_others has the single vectors."""
    e = table(spark, sf_dir, "embeddings")
    return vectors.scored_by(e, "vec_id", "embedding", vectors.centroid(e, "label", "embedding"), "label", "centroid").select("vec_id", "label", "score")


def max_sim_others(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector against all single vectors of the other labels: the nearest one and its cosine."""
    return vectors.nearest_apart(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")


QUERIES = {
    f.__name__: f
    for f in (
        item_scores, first_words_wer, metrics_by_condition, metrics_by_duration, stability, tail_quantiles, prediction_summary, pairwise_win_matrix, performance_profile, ecdf, bootstrap_ci, condition_ranks, zscore_separation, pareto_frontier,
        leaderboard, severity_rank, severity_worst, pivot_model_condition, fuzzy_keyword, repeat_shares, multi_dim_summary, payload_size, content_signature, speaker_totals, speed_totals, centroid_scores, max_sim_cohort,
        max_sim_others, performance_curve,
    )
}

_ASR = r"""trim(regexp_replace(regexp_replace(regexp_replace(lower({t}), '[‘’]', '''', 'g'), '[^a-z0-9\s'']+', ' ', 'g'), '\s+', ' ', 'g'))"""
_CODE = "array_to_string(list_transform(string_split({x}, ' '), lambda w: chr(list_position({d}, w)::INT)), '')"
_EDITS = "CASE WHEN {a} = '' OR {b} = '' THEN length(replace({a} || {b}, ' ', '')) * 0 + CASE WHEN {a} = '' AND {b} = '' THEN 0 ELSE len(string_split(trim({a} || {b}), ' ')) END ELSE levenshtein({ca}, {cb}) END"


def _distance(a: str, b: str) -> str:
    words = f"list_distinct(list_concat(string_split({a}, ' '), string_split({b}, ' ')))"
    return _EDITS.format(a=a, b=b, ca=_CODE.format(x=a, d=words), cb=_CODE.format(x=b, d=words))


_ITEMS = f"""WITH f AS (SELECT * FROM manifest_rows WHERE aug_stage = '' QUALIFY row_number() OVER (PARTITION BY uid ORDER BY row_id) = 1),
b AS (SELECT uid AS base_uid, text AS ref, core_end - core_start AS seconds, CASE WHEN transcript_json IS NOT NULL THEN lead(text) OVER (PARTITION BY transcript_json ORDER BY row_id) END AS other FROM f),
p AS (SELECT m.row_id, m.base_uid, m.aug_stage AS model, m.split_name AS cond, m.text AS hyp, TRY_CAST(m.aug_meta['amount'] AS DOUBLE) AS confidence, b.ref, b.seconds, b.other,
    coalesce({_ASR.format(t='b.ref')}, '') AS r, coalesce({_ASR.format(t='m.text')}, '') AS h, coalesce({_ASR.format(t='b.other')}, '') AS o
    FROM manifest_rows m JOIN b ON b.base_uid = m.base_uid WHERE m.aug_stage <> ''),
e AS (SELECT *, CASE WHEN r = '' THEN 0 ELSE len(string_split(r, ' ')) END AS ref_words, CASE WHEN o = '' THEN 0 ELSE len(string_split(o, ' ')) END AS other_words,
    {_distance('r', 'h')} AS word_edits, {_distance('o', 'h')} AS other_edits, levenshtein(r, h) AS char_edits, levenshtein(o, h) AS other_char_edits FROM p),
items AS (SELECT *, CASE WHEN ref_words > 0 THEN word_edits / ref_words WHEN h <> '' THEN 1.0 ELSE 0.0 END AS wer_target, CASE WHEN other IS NULL THEN NULL WHEN other_words > 0 THEN other_edits / other_words WHEN h <> '' THEN 1.0 ELSE 0.0 END AS wer_other,
    CASE WHEN r <> '' THEN char_edits / length(r) WHEN h <> '' THEN 1.0 ELSE 0.0 END AS cer_target, CASE WHEN other IS NULL THEN NULL WHEN o <> '' THEN other_char_edits / length(o) WHEN h <> '' THEN 1.0 ELSE 0.0 END AS cer_other, coalesce(length(hyp) >= 150, false) AS capped FROM e)
"""
_RECORD = """count(*) AS items, round(avg(wer_target), 6) AS wer_target, round(avg(wer_other), 6) AS wer_other, round(avg(cer_target), 6) AS cer_target, round(sum(word_edits) / nullif(sum(ref_words), 0), 6) AS wer_micro,
    round(avg(coalesce(wer_target < wer_other, false)::INT), 6) AS win_rate, round(avg(wer_other - wer_target), 6) AS mean_margin, round(avg(capped::INT), 6) AS cap_rate"""
_MODELS = _ITEMS + f", models AS (SELECT model, win_rate, wer_target, wer_other, mean_margin, round(items / 10.0, 6) AS speed FROM (SELECT model, {_RECORD} FROM items GROUP BY model))\n"
_SEVERITY = _ITEMS + ", sev AS (SELECT *, round(CASE WHEN confidence IS NOT NULL THEN (0.7 * wer_target + 0.3 * cer_target) * (1 + 0.5 * confidence) ELSE 0.7 * wer_target + 0.3 * cer_target END, 6) AS severity FROM items)\n"
_MEAN = """WITH l AS (SELECT label, unnest(range(1, len(embedding) + 1)) AS d, unnest(embedding)::DOUBLE AS x FROM embeddings), m AS (SELECT label, d, avg(x) AS m FROM l GROUP BY ALL),
c AS (SELECT label AS c_label, list(m ORDER BY d) AS c FROM m GROUP BY label), v AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)
"""

ORACLES = {
    "item_scores": _ITEMS + "SELECT row_id, ref_words::INT AS ref_words, word_edits::INT AS word_edits, round(wer_target, 6) AS wer_target, round(cer_target, 6) AS cer_target, round(wer_other, 6) AS wer_other, capped FROM items",
    "first_words_wer": _ITEMS + "SELECT row_id, word_edits::INT AS edits FROM items WHERE r <> '' AND h <> ''",
    "metrics_by_condition": _ITEMS + f"SELECT model, cond, {_RECORD}, grouping(cond)::BOOLEAN AS overall FROM items WHERE cond IS NOT NULL GROUP BY GROUPING SETS ((model, cond), (model))",
    "metrics_by_duration": _ITEMS + f"SELECT model, CASE WHEN coalesce(seconds, 0) < 1 THEN '0-1s' WHEN seconds < 2 THEN '1-2s' WHEN seconds < 5 THEN '2-5s' WHEN seconds < 10 THEN '5-10s' ELSE '10s+' END AS bucket, {_RECORD} FROM items GROUP BY 1, 2",
    "stability": _ITEMS + ", m AS (SELECT model, cond, avg(wer_target) AS m FROM items WHERE cond IS NOT NULL GROUP BY ALL) SELECT model, round(avg(m), 6) AS mean, round(stddev_samp(m), 6) AS deviation, round(min(m), 6) AS worst, round(max(m), 6) AS best FROM m GROUP BY model",
    "tail_quantiles": _ITEMS + "SELECT model, round(quantile_cont(wer_other, 0.1), 6) AS p10, round(quantile_cont(wer_other, 0.5), 6) AS p50, round(quantile_cont(wer_other, 0.9), 6) AS p90 FROM items GROUP BY model",
    "prediction_summary": _ITEMS + "SELECT model, count(cer_target) AS n, round(sum(cer_target), 6) AS total, round(avg(cer_target), 6) AS mean, round(stddev_pop(cer_target), 6) AS deviation, " + ", ".join(f"round(quantile_cont(cer_target, {p}), 6) AS p{int(100 * p)}" for p in (0.5, 0.75, 0.9, 0.95)) + " FROM items GROUP BY model",
    "pairwise_win_matrix": _ITEMS + ", v AS (SELECT base_uid, model, avg(wer_target) AS v FROM items GROUP BY ALL) SELECT x.model AS a, y.model AS b, count(*) AS items, CAST(sum((x.v < y.v)::INT) AS BIGINT) AS wins, round(avg(CASE WHEN x.model = y.model THEN 0.5 ELSE (x.v < y.v)::INT END), 6) AS rate FROM v x JOIN v y ON x.base_uid = y.base_uid GROUP BY 1, 2",
    "performance_profile": _ITEMS + ", v AS (SELECT base_uid, model, avg(wer_other) AS v FROM items GROUP BY ALL), r AS (SELECT model, v / b AS r FROM (SELECT *, min(v) OVER (PARTITION BY base_uid) AS b FROM v) WHERE b > 0) SELECT model, tau, round(avg((r <= tau)::INT), 6) AS share FROM r, (SELECT unnest([1.0, 1.1, 1.5, 2.0])::DOUBLE AS tau) GROUP BY ALL",
    "performance_curve": _ITEMS + """, v AS (SELECT base_uid, model, avg(wer_target) AS v FROM items GROUP BY ALL), r AS (SELECT model, v / b AS r FROM (SELECT *, min(v) OVER (PARTITION BY base_uid) AS b FROM v) WHERE b > 0),
m AS (SELECT least(greatest(quantile_cont(r, 0.95), 1.2), 6.0)::DOUBLE AS m FROM r), t AS (SELECT i::INT AS point, CASE WHEN i = 119 THEN m ELSE 1.0::DOUBLE + i * ((m - 1.0::DOUBLE) / 119) END AS tau FROM m, range(120) x(i))
SELECT model, point, round(tau, 6) AS tau, round(avg((r <= tau)::INT), 6) AS share FROM r, t GROUP BY model, point, tau""",
    "ecdf": _ITEMS + ", c AS (SELECT model, round(wer_target, 6) AS w, count(*) AS n FROM items GROUP BY ALL), u AS (SELECT *, sum(n) OVER (PARTITION BY model ORDER BY w) AS upto, sum(n) OVER (PARTITION BY model) AS al FROM c) SELECT model, w, round(upto / al, 6) AS share, round(1 - (upto - n) / al, 6) AS survival FROM u",
    "condition_ranks": _MODELS + "SELECT model, rank() OVER (ORDER BY win_rate DESC)::INT AS rank_high, rank() OVER (ORDER BY wer_target)::INT AS rank_low, round(0.6 * rank() OVER (ORDER BY win_rate DESC) + 0.4 * rank() OVER (ORDER BY wer_target), 6)::DOUBLE AS rank_blend FROM models",
    "zscore_separation": _MODELS + "SELECT model, round((win_rate - avg(win_rate) OVER ()) / (stddev_pop(win_rate) OVER () + 1e-9), 6) AS z_win_rate, round((mean_margin - avg(mean_margin) OVER ()) / (stddev_pop(mean_margin) OVER () + 1e-9), 6) AS z_mean_margin FROM models",
    "pareto_frontier": _MODELS + "SELECT model, wer_target, wer_other FROM (SELECT *, max(wer_other) OVER (ORDER BY wer_target, wer_other DESC, model ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM models) WHERE m IS NULL OR wer_other > m",
    "leaderboard": _MODELS + """, g AS (SELECT DISTINCT aug_stage AS model FROM manifest_rows WHERE aug_stage <> ''), j AS (SELECT g.model, m.win_rate, CASE WHEN g.model <> 'gain' THEN m.speed END AS speed FROM g LEFT JOIN models m USING (model)),
n AS (SELECT *, CASE WHEN win_rate IS NULL THEN NULL WHEN max(win_rate) OVER () > min(win_rate) OVER () THEN (win_rate - min(win_rate) OVER ()) / (max(win_rate) OVER () - min(win_rate) OVER ()) ELSE 1 END AS a,
    CASE WHEN speed IS NULL THEN NULL WHEN max(speed) OVER () > min(speed) OVER () THEN (speed - min(speed) OVER ()) / (max(speed) OVER () - min(speed) OVER ()) ELSE 1 END AS s FROM j),
k AS (SELECT *, round(CASE WHEN a IS NULL THEN s WHEN s IS NULL THEN a ELSE 0.8 * a + 0.2 * s END, 6) AS score FROM n) SELECT model, win_rate, speed, score, row_number() OVER (ORDER BY score DESC NULLS LAST, model)::INT AS position FROM k""",
    "severity_rank": _SEVERITY + "SELECT base_uid, count(*) AS models, max(severity) AS worst, round(avg(severity), 6) AS mean, quantile_disc(severity, 0.9) AS p90 FROM sev GROUP BY base_uid",
    "severity_worst": _SEVERITY + "SELECT model, cond, row_id, severity FROM sev WHERE cond IS NOT NULL QUALIFY row_number() OVER (PARTITION BY model, cond ORDER BY severity DESC, row_id) = 1",
    "pivot_model_condition": _ITEMS + "SELECT model, round(avg(wer_target) FILTER (cond = 'test'), 6) AS test, round(avg(wer_target) FILTER (cond = 'train'), 6) AS train, round(avg(wer_target) FILTER (cond = 'validation'), 6) AS validation FROM items GROUP BY model",
    "fuzzy_keyword": r"""WITH t AS (SELECT seg_key, unnest(list_distinct(list_filter(string_split_regex(lower(text), '[^a-z0-9\-]+'), lambda w: w <> ''))) AS token FROM segment_refs), k AS (SELECT unnest(['bakery', 'archive', 'market']) AS keyword)
SELECT token, seg_key, keyword FROM t, k WHERE levenshtein(token, keyword) <= 2""",
    "repeat_shares": """WITH w AS (SELECT seg_key, string_split(lower(text), ' ') AS w FROM segment_refs WHERE text IS NOT NULL), g AS (SELECT seg_key, w, list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i + 1], ' ')) AS b, list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) AS t FROM w)
SELECT seg_key, CASE WHEN len(w) >= 2 THEN round(1 - len(list_distinct(b)) / len(b), 6) ELSE 0.0 END AS bigrams, CASE WHEN len(w) >= 3 THEN round(1 - len(list_distinct(t)) / len(t), 6) ELSE 0.0 END AS trigrams FROM g""",
    "multi_dim_summary": "SELECT source, lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars, grouping_id(source, lang)::INT AS level FROM documents GROUP BY GROUPING SETS ((source, lang), (source), ())",
    "payload_size": "WITH p AS (SELECT recording_key, count(*) AS n, max(n_chars) AS b, sum((n_chars IS NULL)::INT) AS m FROM documents GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS rows, count(recording_key) AS files, CAST(sum(m) AS BIGINT) AS missing, CAST(sum(b) AS BIGINT) AS bytes FROM p",
    "content_signature": """WITH l AS (SELECT source, sha256(concat_ws('|', doc_id::VARCHAR, n_chars::VARCHAR)) AS h FROM documents WHERE source IS NOT NULL), c AS (SELECT source, substr(h, 1, 4) AS c, sha256(string_agg(h, '' ORDER BY h)) AS s, count(*) AS n FROM l GROUP BY 1, 2)
SELECT source, CAST(sum(n) AS BIGINT) AS files, sha256(string_agg(s, '' ORDER BY c, s)) AS signature FROM c GROUP BY source""",
    "speaker_totals": "SELECT lang, count(*) AS n, round(sum(CASE WHEN NOT isnan(duration) THEN duration END), 3) AS seconds, round(avg(CASE WHEN NOT isnan(confidence) THEN confidence END), 6) AS confidence FROM speech_segments GROUP BY lang",
    "speed_totals": "WITH r AS (SELECT is_speech, (epoch_us(ingested_at) - epoch_us(detected_at)) / 1e6 AS wait, duration FROM audio_segments WHERE NOT isnan(duration) AND duration > 0) SELECT is_speech, count(*) AS n, round(min(wait), 3) AS least, round(max(wait), 3) AS most, round(sum(wait) / sum(duration), 4) AS factor FROM r GROUP BY 1",
    "centroid_scores": _MEAN + "SELECT vec_id, round(list_cosine_similarity(v, c), 4) AS score FROM v JOIN c ON c_label = label",
    "max_sim_cohort": _MEAN + "SELECT vec_id, arg_max(c_label, s) AS label, round(max(s), 6) AS score FROM (SELECT vec_id, c_label, list_cosine_similarity(v, c) AS s FROM v, c) GROUP BY vec_id",
    "max_sim_others": """WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), s AS (SELECT x.vec_id, y.vec_id AS other_id, list_cosine_similarity(x.v, y.v) AS s FROM v x JOIN v y ON x.label IS DISTINCT FROM y.label),
b AS (SELECT * FROM s WHERE s IS NOT NULL AND NOT isnan(s) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, other_id) = 1) SELECT vec_id, other_id, round(s, 6) AS score FROM v LEFT JOIN b USING (vec_id)""",
}
