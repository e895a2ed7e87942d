"""Queries on texts: predicates, normal forms, quality rules, phrase counts, renderings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoolwright.functions import scores, text
from spoolwright.session import table
from spoolwright.sources import writers


def english_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.round(text.english_share(t), 6).alias("share"), F.round(text.foreign_share(t), 6).alias("foreign_share"), text.is_english(t).alias("kept"))


def english_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    low, foreign, script = text.english_share(t) < 0.7, text.foreign_share(t) > 0.3, t.rlike(f"[{text.FOREIGN_RANGES}]")
    rules = [("no_text", F.coalesce(F.length(F.trim(t)), F.lit(0)) == 0), ("script", script), ("foreign", foreign), ("low_share", low)]
    return table(spark, sf_dir, "documents").groupBy("lang", F.coalesce(scores.first_issue(rules), F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def silence_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with a silence token are dropped; here the markers of captions stand for them too."""
    t = F.col("text")
    return table(spark, sf_dir, "documents").where(~text.has_silence_token(t) & ~F.coalesce(t.contains("-->"), F.lit(False))).select("doc_id")


def substring_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to one of two sides by a path part; rows without a path to neither."""
    return table(spark, sf_dir, "manifest_rows").where("audio_path is not null").select("row_id", F.when(F.col("audio_path").contains("__reverb__"), "reverb").otherwise("rest").alias("side"))


def folder_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "manifest_rows").where(~F.coalesce(F.lower(F.replace("audio_path", F.lit("\\"), F.lit("/"))).contains("/batches/"), F.lit(False))).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections with numbers that stand for a recogniser's metrics."""
    c = scores.numeric(F.col("confidence"))
    return table(spark, sf_dir, "speech_segments").select("segment_id", (1 - c).alias("no_speech"), (c - 1).alias("logprob"), (c * 3).alias("ratio"))


def quality_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = [F.col(c) for c in ("no_speech", "logprob", "ratio")]
    drop, review = scores.quality_reasons(*a)
    return _metrics(spark, sf_dir).select("segment_id", scores.quality_tier(*a).alias("tier"), F.array_join(drop, ";").alias("drop_reasons"), F.array_join(review, ";").alias("review_reasons"))


def poison_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered rules on a manifest: the first that drops wins, all issues are reported."""
    d = F.col("end_sec") - F.col("start_sec")
    core = F.col("core_end") - F.col("core_start")
    rules = [("no_path", F.col("audio_path").isNull()), ("bad_rate", F.col("sr") != 16000), ("no_length", core <= 0), ("too_long", core > 30), ("packed_length", F.abs(d - core) > 1)]
    reports = [("very_short", core < 0.5), ("no_text", F.coalesce(F.trim("text"), F.lit("")) == "")]
    return table(spark, sf_dir, "manifest_rows").select("row_id", scores.first_issue(rules).alias("dropped_for"), F.array_join(scores.all_issues([*rules, *reports]), ";").alias("issues"))


def text_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return table(spark, sf_dir, "segment_refs").select("seg_key", text.phrase_key(t).alias("phrase"), text.asr_key(t).alias("asr"), text.collapsed(t).alias("collapsed"), F.size(text.key_words(t)).alias("key_words"))


def odd_signs_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "segment_refs").select("seg_key", text.without_odd_signs(F.col("text")).alias("clean"))


def odd_char_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "segment_refs").select("seg_key", F.explode(text.odd_characters(F.col("text"))).alias("sign"))
    return found.groupBy("sign").agg(F.count(F.lit(1)).alias("n"), F.min("seg_key").alias("first_key"))


def phrase_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "segment_refs").groupBy(text.phrase_key(F.col("text")).alias("phrase")).agg(F.count(F.lit(1)).alias("n")).where("phrase is not null and n > 1")


def frequent_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 most frequent phrases with at least 3 occurrences: the top-k report."""
    return phrase_counts(spark, sf_dir).where("n >= 3").orderBy(F.desc("n"), "phrase").limit(20)


def trivial_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a frequent phrase are dropped but for a deterministic tenth."""
    from spoolwright.functions.hashing import bucket

    rows = table(spark, sf_dir, "segment_refs").select("seg_key", text.phrase_key(F.col("text")).alias("phrase"))
    frequent = rows.groupBy("phrase").agg(F.count(F.lit(1)).alias("n")).where("n >= 5 and phrase <> ''").select("phrase", F.lit(True).alias("f"))
    kept = F.col("f").isNull() | (bucket(F.col("seg_key").cast("string"), 10) == 0)
    return rows.join(frequent, "phrase", "left").where(kept).select("seg_key")


def should_keep_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trivial segments stay by score: low ones go, high ones stay by hash, those between go."""
    from spoolwright.functions.hashing import in_share

    t, c = F.col("text"), scores.numeric(F.col("confidence"))
    trivial = text.is_trivial(t, ["hello", "thank you", "okay so", "bonjour", "merci"], ["(?:uh|um|mm|hmm)(?: (?:uh|um|mm|hmm))*"])
    score = scores.score_1_100(F.coalesce(c, F.lit(0.0)), F.lit(0.0), F.lit(1.0))
    keep = F.when(F.coalesce(text.phrase_key(t), F.lit("")) == "", False).when(~trivial, True).when(score >= 60, in_share(F.col("segment_id").cast("string"), 0.3)).otherwise(False)
    return table(spark, sf_dir, "speech_segments").select("segment_id", score.alias("score"), trivial.alias("trivial"), keep.alias("keep"))


def duration_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "audio_segments").groupBy(scores.duration_bucket(scores.numeric(F.col("duration"))).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("avg_amplitude"), 6).alias("amplitude"))


def number_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number words as digits, over whole texts."""
    return table(spark, sf_dir, "segment_refs").where("text is not null").select("seg_key", text.number_words(F.col("text")).alias("digits"))


def text_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose text is, but for case and blanks, nearly that of the row before it in its recording (Arrow; no SQL form)."""
    from pyspark.sql import Window

    from spoolwright.operators.edits import similarity

    w = Window.partitionBy("audio_path").orderBy("idx", "seg_key")
    rows = table(spark, sf_dir, "segment_refs").select("seg_key", "text", F.lag("text").over(w).alias("before")).where("text is not null and before is not null")
    return rows.select("seg_key", F.round(similarity("text", "before"), 6).alias("ratio"))


def flags_and_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("props")
    return table(spark, sf_dir, "events").select(
        "event_id", text.flag(F.substring(F.col("event_type"), 1, 1)).alias("flag"), F.size(text.float_list(F.concat_ws(";", F.col("value").cast("string"), F.lit("x, 2.5")))).alias("numbers"), text.slug(F.concat_ws(" ", "event_type", p), 32).alias("slug")
    )


def vtt_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    cues = table(spark, sf_dir, "segment_refs").where("audio_path is not null and not isnan(end_sec)").select("audio_path", F.col("start_sec").alias("start"), F.col("end_sec").alias("end"), "text")
    return writers.web_vtt(cues, "audio_path").select("audio_path", F.length("subtitles").cast("long").alias("chars"), F.md5("subtitles").alias("digest"))


def ass_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    cues = table(spark, sf_dir, "segment_refs").where("audio_path is not null and not isnan(end_sec)").select("audio_path", F.col("start_sec").alias("start"), F.col("end_sec").alias("end"), "text")
    return writers.ass(cues, "audio_path").select("audio_path", F.length("subtitles").cast("long").alias("chars"), F.md5("subtitles").alias("digest"))


def text_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of each recording from its segments, and which words of it each segment owns."""
    from spoolwright.operators.sequences import word_offsets

    rows = table(spark, sf_dir, "segment_refs").where("audio_path is not null").select("audio_path", "idx", "seg_key", text.collapsed(F.coalesce("text", F.lit(""))).alias("t"))
    n = F.when(F.col("t") == "", 0).otherwise(F.size(F.split("t", " ")))
    return word_offsets(rows, "audio_path", ["idx", "seg_key"], n).select("seg_key", "first_word", "word_count")


QUERIES = {
    f.__name__: f
    for f in (
        english_filter, english_reason, silence_drop, substring_split, folder_drop, quality_tier, poison_guard, text_forms, odd_signs_removed, odd_char_census, phrase_counts, frequent_phrases, trivial_drop, should_keep_segment,
        duration_buckets, number_words, text_similarity, flags_and_lists, vtt_render, ass_render, text_rebuild,
    )
}

_SHARE = r"""length(regexp_replace(lower(trim(text)), '[^a-z0-9.,!?;:''"()\-]', '', 'g'))::DOUBLE / nullif(length(lower(trim(text))), 0)"""
_FOREIGN = r"""length(regexp_replace(lower(trim(text)), '[\x00-\x7F]', '', 'g'))::DOUBLE / nullif(length(lower(trim(text))), 0)"""
_SCRIPT = "regexp_matches(text, '[\\x{0900}-\\x{097F}\\x{0600}-\\x{06FF}\\x{4E00}-\\x{9FFF}\\x{3040}-\\x{30FF}\\x{0400}-\\x{04FF}\\x{0E00}-\\x{0E7F}]')"
_PHRASE = r"trim(regexp_replace(lower(text), '[^\p{L}\p{N}_]+', ' ', 'g'))"
_ASR = r"""trim(regexp_replace(regexp_replace(regexp_replace(lower(text), '[‘’]', '''', 'g'), '[^a-z0-9\s'']+', ' ', 'g'), '\s+', ' ', 'g'))"""
_COLLAPSED = r"trim(regexp_replace(text, '[\s\x{A0}]+', ' ', 'g'))"
_BUCKET = "(('0x' || substr(sha1({k}::VARCHAR), 1, 15))::BIGINT % {n})"
_CONF = "CASE WHEN NOT isnan(confidence) THEN confidence END"
_CUES = """WITH s AS (SELECT audio_path, start_sec AS s, end_sec AS e, {text} AS t, {ticks_s} AS a, {ticks_e} AS b FROM segment_refs
    WHERE audio_path IS NOT NULL AND NOT isnan(end_sec) AND regexp_matches(text, '[\\p{{L}}\\p{{N}}]') AND end_sec > start_sec),
l AS (SELECT audio_path, s, e, {line} AS line FROM s),
o AS (SELECT audio_path, {head} || string_agg(line, {between} ORDER BY s, e, line) || chr(10) AS subtitles FROM l GROUP BY audio_path)
SELECT audio_path, length(subtitles) AS chars, md5(subtitles) AS digest FROM o"""
_VTT = "printf('%02d:%02d:%02d.%03d', {x} // 3600000, {x} // 60000 % 60, {x} // 1000 % 60, {x} % 1000)"
_ASS = "printf('%d:%02d:%02d.%02d', {x} // 360000, {x} // 6000 % 60, {x} // 100 % 60, {x} % 100)"

_NUMBERS = "[" + ", ".join(f"'{w}'" for w in [*text.UNITS, *text.TENS]) + "]"
_VALUES = "[" + ", ".join(str(n) for n in [*text.UNITS.values(), *text.TENS.values()]) + "]"
_STARTS = "|".join(sorted([*text.UNITS, *text.TENS, "hundred", *text.SCALES], key=len, reverse=True))
_RUN = rf"(?i)\b(?:{_STARTS})\b(?:[\s\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{202F}}\x{{205F}}\x{{3000}},-]+\b(?:{_STARTS}|and)\b)*"
_SUM = f"""list_reduce(list_transform(w, lambda x: {{'t': 0::BIGINT, 'p': 0::BIGINT, 'w': x}}), lambda a, x: CASE WHEN x.w = 'and' THEN a WHEN x.w = 'hundred' THEN {{'t': a.t, 'p': greatest(a.p, 1) * 100, 'w': ''}}
    WHEN x.w IN ('thousand', 'million', 'billion') THEN {{'t': a.t + greatest(a.p, 1) * CASE x.w WHEN 'thousand' THEN 1000 WHEN 'million' THEN 1000000 ELSE 1000000000 END, 'p': 0::BIGINT, 'w': ''}}
    ELSE {{'t': a.t, 'p': a.p + ({_VALUES})[list_position({_NUMBERS}, x.w)], 'w': ''}} END, {{'t': 0::BIGINT, 'p': 0::BIGINT, 'w': ''}})"""
_DIGITS = f"""WITH r AS (SELECT seg_key, text, string_split_regex(text, '{_RUN}') AS b, regexp_extract_all(text, '{_RUN}') AS m FROM segment_refs WHERE text IS NOT NULL),
k AS (SELECT seg_key, i, regexp_extract_all(lower(m[i]), '[a-z]+') AS w FROM r, unnest(range(1, len(m) + 1)) t(i)),
v AS (SELECT seg_key, list(CASE WHEN list_bool_and(list_transform(w, lambda x: coalesce(list_position({_NUMBERS}, x) BETWEEN 1 AND 10, false) OR x = 'oh')) THEN array_to_string(list_transform(w, lambda x: ({_VALUES})[list_position({_NUMBERS}, x)]), '')
    ELSE (({_SUM}).t + ({_SUM}).p)::VARCHAR END ORDER BY i) AS v FROM k GROUP BY seg_key)
SELECT seg_key, CASE WHEN v IS NULL THEN text ELSE array_to_string(list_transform(range(1, len(b) + 1), lambda i: b[i] || coalesce(v[i], '')), '') END AS digits FROM r LEFT JOIN v USING (seg_key)"""

ORACLES = {
    "number_words": _DIGITS,
    "english_filter": f"SELECT doc_id, round({_SHARE}, 6) AS share, round({_FOREIGN}, 6) AS foreign_share, coalesce({_SHARE} >= 0.7 AND {_FOREIGN} <= 0.3 AND NOT {_SCRIPT}, false) AS kept FROM documents",
    "english_reason": f"""SELECT lang, CASE WHEN coalesce(length(trim(text)), 0) = 0 THEN 'no_text' WHEN {_SCRIPT} THEN 'script' WHEN {_FOREIGN} > 0.3 THEN 'foreign' WHEN {_SHARE} < 0.7 THEN 'low_share' ELSE 'kept' END AS reason, count(*) AS n
FROM documents GROUP BY ALL""",
    "silence_drop": "SELECT doc_id FROM documents WHERE NOT coalesce(text LIKE '%<|nospeech|>%' OR text LIKE '%<|nocaptions|>%' OR text LIKE '%-->%', false)",
    "substring_split": "SELECT row_id, CASE WHEN contains(audio_path, '__reverb__') THEN 'reverb' ELSE 'rest' END AS side FROM manifest_rows WHERE audio_path IS NOT NULL",
    "folder_drop": "SELECT source, count(*) AS n FROM manifest_rows WHERE NOT coalesce(contains(lower(replace(audio_path, chr(92), '/')), '/batches/'), false) GROUP BY source",
    "quality_tier": f"""WITH c AS (SELECT segment_id, {_CONF} AS c FROM speech_segments), m AS (SELECT segment_id, 1 - c AS n, c - 1 AS l, c * 3 AS r FROM c)
SELECT segment_id, CASE WHEN n >= 0.6 OR l < -0.6 OR r > 2.5 THEN 'drop' WHEN n >= 0.1 OR l <= -0.3 OR r >= 2.0 THEN 'review' ELSE 'safe' END AS tier,
    concat_ws(';', CASE WHEN n >= 0.6 THEN 'no_speech_prob' END, CASE WHEN l < -0.6 THEN 'avg_logprob' END, CASE WHEN r > 2.5 THEN 'compression_ratio' END) AS drop_reasons,
    concat_ws(';', CASE WHEN n >= 0.1 THEN 'no_speech_prob' END, CASE WHEN l <= -0.3 THEN 'avg_logprob' END, CASE WHEN r >= 2.0 THEN 'compression_ratio' END) AS review_reasons FROM m""",
    "poison_guard": """WITH m AS (SELECT row_id, audio_path, sr, text, core_end - core_start AS core, end_sec - start_sec AS d FROM manifest_rows)
SELECT row_id, CASE WHEN audio_path IS NULL THEN 'no_path' WHEN sr <> 16000 THEN 'bad_rate' WHEN core <= 0 THEN 'no_length' WHEN core > 30 THEN 'too_long' WHEN abs(d - core) > 1 THEN 'packed_length' END AS dropped_for,
    concat_ws(';', CASE WHEN audio_path IS NULL THEN 'no_path' END, CASE WHEN sr <> 16000 THEN 'bad_rate' END, CASE WHEN core <= 0 THEN 'no_length' END, CASE WHEN core > 30 THEN 'too_long' END, CASE WHEN abs(d - core) > 1 THEN 'packed_length' END,
    CASE WHEN core < 0.5 THEN 'very_short' END, CASE WHEN coalesce(trim(text), '') = '' THEN 'no_text' END) AS issues FROM m""",
    "text_forms": rf"""SELECT seg_key, {_PHRASE} AS phrase, {_ASR} AS asr, {_COLLAPSED} AS collapsed, CAST(coalesce(len(list_filter(string_split_regex(lower(text), '[^a-z0-9\-]+'), lambda w: w <> '')), CASE WHEN text IS NULL THEN NULL ELSE 0 END) AS INTEGER) AS key_words FROM segment_refs""",
    "odd_signs_removed": r"""SELECT seg_key, trim(regexp_replace(regexp_replace(replace(translate(text, '‘’‚“”„–—' || chr(160), repeat(chr(39), 3) || repeat(chr(34), 3) || '--' || ' '), '…', '...'), '[\p{Cc}\p{Cf}]', '', 'g'), '[\s\x{A0}]+', ' ', 'g')) AS clean FROM segment_refs""",
    "odd_char_census": r"""SELECT sign, count(*) AS n, min(seg_key) AS first_key FROM (SELECT seg_key, unnest(regexp_extract_all(text, '[^\p{L}\p{M}\p{N}\p{P}\p{Z}\r\n\t$+<=>^`|~]')) AS sign FROM segment_refs) GROUP BY sign""",
    "phrase_counts": f"SELECT * FROM (SELECT {_PHRASE} AS phrase, count(*) AS n FROM segment_refs GROUP BY 1) WHERE phrase IS NOT NULL AND n > 1",
    "frequent_phrases": f"SELECT * FROM (SELECT {_PHRASE} AS phrase, count(*) AS n FROM segment_refs GROUP BY 1) WHERE phrase IS NOT NULL AND n >= 3 ORDER BY n DESC, phrase LIMIT 20",
    "trivial_drop": f"""WITH r AS (SELECT seg_key, {_PHRASE} AS phrase FROM segment_refs), f AS (SELECT phrase FROM r WHERE phrase <> '' GROUP BY phrase HAVING count(*) >= 5)
SELECT seg_key FROM r LEFT JOIN f USING (phrase) WHERE f.phrase IS NULL OR {_BUCKET.format(k="seg_key", n=10)} = 0""",
    "should_keep_segment": f"""WITH r AS (SELECT segment_id, {_PHRASE} AS p, CAST(round_even(least(greatest(coalesce({_CONF}, 0.0), 0.0), 1.0) * 99, 0) AS INTEGER) + 1 AS score FROM speech_segments),
t AS (SELECT *, coalesce(p <> '' AND (p IN ('hello', 'thank you', 'okay so', 'bonjour', 'merci') OR regexp_full_match(p, '(?:uh|um|mm|hmm)(?: (?:uh|um|mm|hmm))*')), false) AS trivial FROM r)
SELECT segment_id, score, trivial, CASE WHEN coalesce(p, '') = '' THEN false WHEN NOT trivial THEN true WHEN score >= 60 THEN {_BUCKET.format(k="segment_id", n=10000)} < 3000 ELSE false END AS keep FROM t""",
    "duration_buckets": """WITH a AS (SELECT coalesce(CASE WHEN NOT isnan(duration) THEN duration END, 0.0) AS d, avg_amplitude FROM audio_segments)
SELECT CASE WHEN d < 1 THEN '0-1s' WHEN d < 2 THEN '1-2s' WHEN d < 5 THEN '2-5s' WHEN d < 10 THEN '5-10s' ELSE '10s+' END AS bucket, count(*) AS n, round(avg(avg_amplitude), 6) AS amplitude FROM a GROUP BY 1""",
    "flags_and_lists": r"""SELECT event_id, substr(event_type, 1, 1) IN ('1', 't', 'y') AS flag, 2 AS numbers, CASE WHEN length(s) <= 32 THEN s ELSE substr(s, 1, 23) || '_' || substr(sha1(c), 1, 8) END AS slug FROM (
    SELECT event_id, event_type, c, coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(c, '[^A-Za-z0-9._\-]+', '_', 'g'), '_{2,}', '_', 'g'), '^[_.\-]+|[_.\-]+$', '', 'g'), ''), 'fallback') AS s FROM (SELECT event_id, event_type, concat_ws(' ', event_type, props) AS c FROM events))""",
    "vtt_render": _CUES.format(text="trim(text)", ticks_s="CAST(round_even(start_sec * 1000, 0) AS BIGINT)", ticks_e="CAST(round_even(end_sec * 1000, 0) AS BIGINT)", line=f"{_VTT.format(x='a')} || ' --> ' || {_VTT.format(x='b')} || chr(10) || t", head="'WEBVTT' || chr(10) || chr(10)", between="chr(10) || chr(10)"),
    "ass_render": _CUES.format(
        text="replace(replace(replace(replace(trim(text), chr(92), chr(92) || chr(92)), '{', chr(92) || '{'), '}', chr(92) || '}'), chr(10), chr(92) || 'N')",
        ticks_s="CAST(round_even(start_sec * 100, 0) AS BIGINT)", ticks_e="CAST(round_even(end_sec * 100, 0) AS BIGINT)",
        line=f"'Dialogue: 0,' || {_ASS.format(x='a')} || ',' || {_ASS.format(x='b')} || ',Default,,0,0,0,,' || t", head="'[Events]' || chr(10) || 'Format: Layer, Start, End, Style, Name, MarginL, MarginR, MarginV, Effect, Text' || chr(10)", between="chr(10)",
    ),
    "text_rebuild": rf"""WITH r AS (SELECT audio_path, idx, seg_key, trim(regexp_replace(coalesce(text, ''), '[\s\x{{A0}}]+', ' ', 'g')) AS t FROM segment_refs WHERE audio_path IS NOT NULL),
n AS (SELECT *, CAST(CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END AS INTEGER) AS word_count FROM r)
SELECT seg_key, CAST(coalesce(sum(word_count) OVER (PARTITION BY audio_path ORDER BY idx, seg_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_word, word_count FROM n""",
}
