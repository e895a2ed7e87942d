"""Quality rules, buckets and scores as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits of the quality tiers (drop, review), and edges of the duration buckets in seconds.
DROP = {"no_speech_prob": 0.60, "avg_logprob": -0.60, "compression_ratio": 2.50}
REVIEW = {"no_speech_prob": 0.10, "avg_logprob": -0.30, "compression_ratio": 2.00}
DURATIONS = ((1.0, "0-1s"), (2.0, "1-2s"), (5.0, "2-5s"), (10.0, "5-10s"))


def numeric(x: Column) -> Column:
    """NaN as null: a NaN compares as larger than any number."""
    return F.when(~F.isnan(x), x)


def quality_reasons(no_speech: Column, logprob: Column, ratio: Column) -> tuple[Column, Column]:
    """Reasons to drop and reasons to review, as arrays; a null metric gives none."""
    drop = F.array_compact(F.array(F.when(no_speech >= DROP["no_speech_prob"], F.lit("no_speech_prob")), F.when(logprob < DROP["avg_logprob"], F.lit("avg_logprob")), F.when(ratio > DROP["compression_ratio"], F.lit("compression_ratio"))))
    review = F.array_compact(F.array(F.when(no_speech >= REVIEW["no_speech_prob"], F.lit("no_speech_prob")), F.when(logprob <= REVIEW["avg_logprob"], F.lit("avg_logprob")), F.when(ratio >= REVIEW["compression_ratio"], F.lit("compression_ratio"))))
    return drop, review


def quality_tier(no_speech: Column, logprob: Column, ratio: Column) -> Column:
    drop, review = quality_reasons(no_speech, logprob, ratio)
    return F.when(F.size(drop) > 0, "drop").when(F.size(review) > 0, "review").otherwise("safe")


def duration_bucket(seconds: Column) -> Column:
    """Null counts as the shortest."""
    s = F.coalesce(seconds, F.lit(0.0))
    return reduce(lambda c, edge: c.when(s < edge[0], edge[1]), DURATIONS[1:], F.when(s < DURATIONS[0][0], DURATIONS[0][1])).otherwise("10s+")


def first_issue(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first rule that holds, null if none."""
    return F.coalesce(*[F.when(rule, F.lit(name)) for name, rule in rules])


def all_issues(rules: list[tuple[str, Column]]) -> Column:
    return F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules]))


def confidence(x: Column) -> Column:
    """A log probability, a percentage or a share as a share."""
    return F.least(F.greatest(F.when(x < 0, F.exp(x)).when(x > 1, x / 100.0).otherwise(x), F.lit(0.0)), F.lit(1.0))


def score_1_100(x: Column, low: Column, high: Column) -> Column:
    """Clamped linear score, rounded half to even; 50 where the limits are equal."""
    share = F.when(high > low, (F.least(F.greatest(x, low), high) - low) / (high - low)).otherwise(0.5)
    return (F.bround(share * 99) + 1).cast("int")


def severity(wer: Column, cer: Column, conf: Column, length: Column | None = None, repeat: Column | None = None, capped: Column | None = None) -> Column:
    """Error weighted up by the model's confidence, or without one by length, repetition and cap penalties."""
    base = 0.7 * wer + 0.3 * cer
    zero = F.lit(0.0)
    penalties = 1 + 0.4 * F.coalesce(zero if length is None else length, zero) + 0.4 * F.coalesce(zero if repeat is None else repeat, zero) + 0.2 * F.coalesce(zero if capped is None else capped, zero)
    return F.when(conf.isNotNull(), base * (1 + 0.5 * conf)).otherwise(base * penalties)


def length_penalty(hyp_words: Column, ref_words: Column) -> Column:
    return F.least(F.lit(1.0), F.abs(hyp_words - ref_words) / F.greatest(ref_words, F.lit(1)))


def repeat_share(words: Column, n: int) -> Column:
    """Part of the n-grams that repeat an earlier one; 0 for fewer than n words."""
    grams = F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.array_join(F.slice(words, i + 1, n), " "))
    return F.when(F.size(words) >= n, 1 - F.size(F.array_distinct(grams)) / F.size(grams)).otherwise(0.0)


def rms_db(rms: Column) -> Column:
    return 20 * F.log10(F.greatest(rms, F.lit(1e-10)))


def gain_of_db(db: Column) -> Column:
    return F.pow(F.lit(10.0), db / 20)


def size_mb(seconds: Column, kbps: float) -> Column:
    return seconds * kbps * 1000 / 8 / 1_000_000


def context_size(seconds: Column, per_30s: int = 1500, step: int = 16) -> Column:
    """Encoder frames for a duration, rounded up to a multiple of the step."""
    return (F.ceil(F.ceil(seconds * per_30s / 30) / step) * step).cast("int")


def real_time_factor(infer: Column, audio: Column) -> Column:
    return F.when(audio > 0, infer / audio)


# Shares between which a score is spread, and the limits taken where there are too few values.
SPREAD = (0.05, 0.95)
FEW_VALUES, FEW_LIMITS = 5, (-2.0, 0.0)


def spread_limits(values: Column) -> tuple[Column, Column]:
    """Aggregates: the 5th and the 95th percentile between which a score is spread; -2 and 0 for fewer than five values. For groups of bounded size (a recording's segments)."""
    n = F.count(values)
    return tuple(F.when(n >= FEW_VALUES, F.percentile(values, share)).otherwise(limit) for share, limit in zip(SPREAD, FEW_LIMITS, strict=True))


def colour_bin(x: Column, low: Column, high: Column, bins: int = 7) -> Column:
    """Bin (from 0) of a clamped linear score; the greatest value lies in the last."""
    share = F.when(high > low, (F.least(F.greatest(x, low), high) - low) / (high - low)).otherwise(0.5)
    return F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")


def efficiency(wer: Column, params: Column, latency: Column) -> Column:
    """Accuracy by cost: null where the cost is not above 0."""
    return F.when(params * latency > 0, 1 / (1 + F.greatest(wer, F.lit(0.0))) / (params * latency))
