"""Smaller operators on records: routing and validation, pairings, name matches, reports, set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoolwright.functions.text import USELESS_TEXTS, asr_key
from spoolwright.operators.edits import error_rates
from spoolwright.operators.order import Laid, ranked

# Augmentations in the order in which they name a row; reference texts that are no references; suffixes that
# cutting and compacting add to a file's stem; forms of a published id.
AUGMENTATIONS = ("reverb", "noise_mix", "voice_mix", "tempo")
NO_REFERENCE = ("", "ignore time segment in scoring")
STEM_SUFFIX = r"(?:__(?:core|chunk)\d+(?:__[^_]+)?|_compact|_sent\d*)$"
PUBLISHED_ID = r"^[a-z0-9]+(?:-[a-z0-9]+)*$"


def chunk_index(index: Column, path: Column) -> Column:
    """The index, else the number behind 'chunk' or 'core' in the path; null without either."""
    return F.coalesce(index, F.nullif(F.regexp_extract(F.lower(path), r"(?:chunk|core)(\d+)", 1), F.lit("")).cast("int"))


def augmentation_label(path: Column, names: tuple[str, ...] = AUGMENTATIONS) -> Column:
    """The first of the names that the path contains, else 'original'; null for a null path."""
    hit = F.coalesce(*[F.when(F.lower(path).contains(n), F.lit(n)) for n in names], F.lit("original"))
    return F.when(path.isNotNull(), hit)


def publish_path(root: str, part: Column, relative: Column) -> Column:
    """root/part-00000/relative with single slashes."""
    return F.concat(F.lit(root.rstrip("/") + "/"), F.format_string("part-%05d", part), F.lit("/"), F.regexp_replace(F.regexp_replace(relative, r"\\+", "/"), "^/+", ""))


def is_useless(text: Column, tier: Column, start: Column, end: Column, review_too: bool) -> Column:
    """Segments without a text or length, of tier 'drop', or of tier 'review' where these are left out too."""
    bad_tier = tier.isin("drop", "review") if review_too else tier == "drop"
    return F.coalesce(F.trim(text), F.lit("")).isin(*USELESS_TEXTS) | F.coalesce(bad_tier, F.lit(False)) | start.isNull() | end.isNull() | F.isnan(start) | F.isnan(end) | (end <= start)


def at_extremes(df: DataFrame, greatest: str, least: str) -> DataFrame:
    """The rows at the greatest value of one column and the least of another over the whole table. A null passes; a NaN is no value and doesn't."""
    clean = lambda c: F.when(~F.isnan(c), F.col(c))
    ends = df.agg(F.max(clean(greatest)).alias("__hi"), F.min(clean(least)).alias("__lo"))
    met = df.crossJoin(F.broadcast(ends))  # one row
    return met.where((F.col(greatest).isNull() | (F.col(greatest) == F.col("__hi"))) & (F.col(least).isNull() | (F.col(least) == F.col("__lo")))).drop("__hi", "__lo")


def missing_keys(lines: DataFrame, json: str, required: list[str]) -> DataFrame:
    """rows, unreadable, incomplete, ok of JSON lines: whether there is a row and every one is an object with all required keys."""
    keys = F.json_object_keys(json)
    bad = keys.isNull()
    lacks = ~bad & (F.size(F.array_except(F.array(*[F.lit(k) for k in required]), keys)) > 0)
    n = F.count(F.lit(1))
    return lines.agg(n.alias("rows"), F.coalesce(F.sum(bad.cast("long")), F.lit(0)).alias("unreadable"), F.coalesce(F.sum(lacks.cast("long")), F.lit(0)).alias("incomplete"), ((n > 0) & (F.coalesce(F.sum((bad | lacks).cast("long")), F.lit(0)) == 0)).alias("ok"))


def publish_issues(slug: Column, title: Column, subtitle: Column) -> Column:
    """What keeps a data set from being published, as an array: id (6 to 50 characters of the allowed form), title (6 to 50), subtitle (20 to 80). A null is an issue."""
    between = lambda c, low, high: F.coalesce(F.length(c).between(low, high), F.lit(False))
    return F.array_compact(F.array(F.when(~F.coalesce(slug.rlike(PUBLISHED_ID), F.lit(False)) | ~between(slug, 6, 50), "id"), F.when(~between(title, 6, 50), "title"), F.when(~between(subtitle, 20, 80), "subtitle")))


def enabled_models(models: DataFrame, language: str | None = None) -> DataFrame:
    """The enabled models, of the given language mode if one is given."""
    on = models.where("enabled")
    return on if language is None else on.where(F.col("language_mode") == language)


def too_short(seconds: Column, least: float) -> tuple[Column, Column]:
    """Decision and reason of a file that is too short to be told: OTHER; null for the others. A null or NaN length is none."""
    short = F.coalesce(seconds < least, F.lit(False)) & ~F.isnan(seconds)
    return F.when(short, "OTHER"), F.when(short, F.format_string(f"duration %.2f < {least:.2f}", seconds))


def presence(df: DataFrame, key: str, seconds: str, voiced: Column, present: Column, share: float, least: float, segments: int) -> DataFrame:
    """key, voiced, present, is_present: whether the present seconds reach the share of the voiced ones and the least; with fewer voiced segments than asked for never."""
    part = lambda flag: F.coalesce(F.sum(F.when(flag, F.col(seconds))), F.lit(0.0))
    sums = df.groupBy(key).agg(F.round(part(voiced), 3).alias("voiced"), F.round(part(voiced & present), 3).alias("present"), F.sum(voiced.cast("long")).alias("__n"))
    reached = (F.col("present") >= F.greatest(share * F.col("voiced"), F.lit(least))) & (F.coalesce("__n", F.lit(0)) >= segments)
    return sums.select(key, "voiced", "present", reached.alias("is_present"))


def scored_references(df: DataFrame, text: str) -> DataFrame:
    """The rows whose reference is one: neither null, blank nor the mark for stretches that aren't scored."""
    return df.where(~F.coalesce(F.lower(F.trim(text)), F.lit("")).isin(*NO_REFERENCE))


def model_family(name: Column) -> Column:
    low = F.lower(name)
    return F.when(low.contains("whisper"), "whisper").when(low.contains("moonshine"), "moonshine").otherwise("other")


def selected_runs(runs: DataFrame, name: str, include: list[str], exclude: list[str], first: int | None = None) -> DataFrame:
    """Runs of the include list (all if it is empty) without those of the exclude list, by name; the first n if n is given (that is the feature)."""
    some = runs.where(F.col(name).isin(include)) if include else runs
    some = some.where(~F.col(name).isin(exclude)) if exclude else some
    return some if first is None else some.orderBy(name).limit(first)


PROBES = 24
_BLOCK = 4096


def probed(others: DataFrame, ident: str, valid: Column) -> DataFrame:
    """n and, for each place, the first two valid others at it or at most PROBES places after it (wrapping round).

    Places are looked at in blocks with the next block's first places beside them, so no task has all others.
    """
    placed = ranked(others.select(F.col(ident).alias("__o"), F.coalesce(valid, F.lit(False)).alias("__ok")), "__o", name="pos")
    size = placed.groupBy().agg(F.count(F.lit(1)).alias("n"))
    rows = placed.crossJoin(F.broadcast(size))  # one row
    wrapped = rows.where(F.col("pos") < PROBES).withColumn("pos", F.col("pos") + F.col("n"))
    block = F.floor(F.col("pos") / _BLOCK)
    halo = F.when(F.col("pos") % _BLOCK < PROBES, block - 1)
    spread = rows.unionByName(wrapped).withColumn("__b", F.explode(F.array_compact(F.array(block, halo))))
    ahead = Window.partitionBy("__b").orderBy("pos").rowsBetween(0, PROBES)
    seen = spread.withColumn("next", F.slice(F.collect_list(F.when(F.col("__ok"), F.col("__o"))).over(ahead), 1, 2))
    return seen.where((F.floor(F.col("pos") / _BLOCK) == F.col("__b")) & (F.col("pos") < F.col("n"))).select("pos", "n", "next")


def paired_by_hash(targets: DataFrame, others: DataFrame, ident: str, valid: Column, per_target: int = 1, seed: str = "") -> DataFrame:
    """target, k, other: for each target and k the other at the place that its hash names, or the next valid one at most PROBES places on; never the target itself. A target without one has no row."""
    table = probed(others, ident, valid)
    n = others.count() or 1
    asked = targets.select(F.col(ident).alias("target")).where("target is not null").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(per_target - 1))))
    text = F.concat_ws(":", F.col("target").cast("string"), F.col("k").cast("string"), *([F.lit(seed)] if seed else []))
    place = F.pmod(F.conv(F.substring(F.sha1(text), 1, 15), 16, 10).cast("long"), F.lit(n)).alias("pos")
    met = asked.withColumn("pos", place).join(table, "pos")
    other = F.when(F.get("next", F.lit(0)) != F.col("target"), F.get("next", F.lit(0))).otherwise(F.get("next", F.lit(1)))
    return met.select("target", "k", other.alias("other")).where("other is not null")


def paired_in_turn(targets: DataFrame, ident: str, step: int = 1) -> DataFrame:
    """target, other: each with the one `step` places on, wrapping round; none where that is itself."""
    placed = ranked(targets.select(ident), ident)
    n = placed.count() or 1
    turned = placed.select(F.col(ident).alias("target"), F.pmod(F.col("pos") + step, F.lit(n)).alias("pos"))
    return turned.join(placed.withColumnRenamed(ident, "other"), "pos").where("target <> other").select("target", "other")


def paired_with_redraw(targets: DataFrame, ident: str) -> DataFrame:
    """target, other: the one at the place the hash names; a target that meets itself is drawn once more."""
    placed = ranked(targets.select(ident), ident)
    n = placed.count() or 1
    draw = lambda k: F.pmod(F.conv(F.substring(F.sha1(F.concat(F.col(ident).cast("string"), F.lit(f":{k}"))), 1, 15), 16, 10).cast("long"), F.lit(n))
    wish = placed.select(F.col(ident).alias("target"), F.when(draw(0) != F.col("pos"), draw(0)).otherwise(draw(1)).alias("pos"))
    return wish.join(placed.withColumnRenamed(ident, "other"), "pos").where("target <> other").select("target", "other")


def matched_names(audio: DataFrame, ident: str, stem: Column, names: DataFrame, name: str, prefix: int = 12) -> DataFrame:
    """ident, match, tier: the transcript of an audio file by its stem ('exact'), by the stem without what cutting adds ('stripped'), or by its first characters where only one name begins so ('prefix'). names: name, one row each."""
    bare = F.regexp_replace(stem, STEM_SUFFIX, "")
    keys = audio.select(ident, stem.alias("__s"), bare.alias("__b"), F.when(F.length(stem) >= prefix, F.substring(stem, 1, prefix)).alias("__p"))
    listed = names.select(F.col(name).alias("__n")).where("__n is not null").distinct()
    starts = listed.where(F.length("__n") >= prefix).groupBy(F.substring("__n", 1, prefix).alias("__p")).agg(F.min("__n").alias("m3"), F.count(F.lit(1)).alias("__c")).where("__c = 1").drop("__c")
    met = keys.join(listed.select(F.col("__n").alias("__s"), F.col("__n").alias("m1")), "__s", "left").join(listed.select(F.col("__n").alias("__b"), F.col("__n").alias("m2")), "__b", "left").join(starts, "__p", "left")
    tier = F.when(F.col("m1").isNotNull(), "exact").when(F.col("m2").isNotNull(), "stripped").when(F.col("m3").isNotNull(), "prefix")
    return met.select(ident, F.coalesce("m1", "m2", "m3").alias("match"), tier.alias("tier"))


def compared(pairs: DataFrame, reference: str, original: str, patched: str) -> DataFrame:
    """The pairs with norm_match (of original and patched), wer and cer of both against the reference, and which is better: patched, original or tie (within 1e-9)."""
    first = error_rates(pairs, reference, original).withColumnsRenamed({"wer": "wer_original", "cer": "cer_original"}).drop("ref_words", "word_edits", "ref_chars", "char_edits")
    both = error_rates(first, reference, patched).withColumnsRenamed({"wer": "wer_patched", "cer": "cer_patched"}).drop("ref_words", "word_edits", "ref_chars", "char_edits")
    gain = F.col("wer_original") - F.col("wer_patched")
    norm = lambda c: F.coalesce(asr_key(F.col(c)), F.lit(""))
    return both.withColumns({"norm_match": norm(original) == norm(patched), "better": F.when(gain > 1e-9, "patched").when(gain < -1e-9, "original").otherwise("tie")})


def structure_report(rows: DataFrame, group: str, mixed: Column) -> DataFrame:
    """group, rows, mixed, original: how many rows of each group there are, and how many of them augmentation has made."""
    return rows.groupBy(group).agg(F.count(F.lit(1)).alias("rows"), F.sum(mixed.cast("long")).alias("mixed"), F.sum((~mixed).cast("long")).alias("original"))


def speech_patterns(spans: DataFrame, key: str, start: str, end: str, order: list[str], confidence: Column) -> DataFrame:
    """key, segments, confidence (mean), longest_gap, density (spoken part of the stretch from the first start to the last end). Overlaps count twice."""
    rows = Laid(spans, key, *order).neighbour(True, __next=F.col(start)).rows()
    spoken = F.sum(F.col(end) - F.col(start))
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("segments"), F.round(F.avg(confidence), 6).alias("confidence"), F.greatest(F.max(F.col("__next") - F.col(end)), F.lit(0)).alias("longest_gap"), F.round(spoken / (F.max(end) - F.min(start)), 6).alias("density"))


def energy_summary(spans: DataFrame, key: str, length: Column, silent: Column) -> DataFrame:
    """key, segments, total, silence, percent of the total that is silent (null for no length)."""
    sums = spans.groupBy(key).agg(F.count(F.lit(1)).alias("segments"), F.sum(length).alias("total"), F.coalesce(F.sum(F.when(silent, length)), F.lit(0)).alias("silence"))
    return sums.withColumn("percent", F.round(100 * F.col("silence") / F.nullif("total", F.lit(0)), 4))


def moved_sample(source: DataFrame, target: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """Both tables with side ('source' or 'target') after n rows of the source, in hash order, have gone over to the target (the number is the feature)."""
    from spoolwright.functions.hashing import hash_order

    placed = ranked(source.withColumn("__h", hash_order(seed, F.col(key))), "__h", key, name="__pos")
    moved = placed.withColumn("side", F.when(F.col("__pos") < n, "target").otherwise("source")).drop("__h", "__pos")
    return moved.unionByName(target.withColumn("side", F.lit("target")))


def ordered_distinct(df: DataFrame, value: str, pos: str) -> DataFrame:
    """value, first, place (from 0): the different values in the order in which they first occur. A null is no value."""
    first = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(pos).alias("first"))
    return ranked(first, "first", value, name="place")


def order_changed(before: DataFrame, after: DataFrame, pos: str, value: str, first: int = 100) -> DataFrame:
    """compared, differing, changed: whether any of the first places holds another row than before (the report is over these)."""
    head = lambda d, name: d.where(F.col(pos) < first).select(pos, F.col(value).alias(name))
    both = head(before, "__a").join(head(after, "__b"), pos, "full_outer")
    n = F.coalesce(F.sum((~F.col("__a").eqNullSafe(F.col("__b"))).cast("long")), F.lit(0))
    return both.agg(F.count(F.lit(1)).alias("compared"), n.alias("differing"), (n > 0).alias("changed"))


def appended_history(state: Column, run: Column, most: int = 100) -> Column:
    """The run history with one more run at its end; the last `most` stay (that is the feature). A null history is empty."""
    grown = F.array_append(F.coalesce(state, F.array().cast("array<string>")), run)
    return F.slice(grown, F.greatest(F.size(grown) - most + 1, F.lit(1)), F.lit(most))


def parsed_overrides(pairs: list[str]) -> dict[str, str]:
    """key=value arguments; a later one wins, blanks are trimmed, anything else raises ValueError."""
    out: dict[str, str] = {}
    for pair in pairs:
        key, eq, value = pair.partition("=")
        if not eq or not key.strip():
            raise ValueError(f"not key=value: {pair}")
        out[key.strip()] = value.strip()
    return out
