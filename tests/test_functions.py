import pytest
from pyspark.sql import functions as F

from spoolwright.functions import hashing, scores, text


def one(spark, column):
    return spark.range(1).select(column).first()[0]


NUMBERS = {
    "twenty one cats": "21 cats", "oh four two": "042", "one hundred and five": "105", "two thousand three hundred": "2300", "rock and roll": "rock and roll", "": "", "five and dime": "5 dime",
    "twenty-one cats": "21 cats", "I have twenty, maybe thirty.": "I have 20, maybe 30.", "a  b\nc two": "a  b\nc 2", "Someone phoned; ONE, two-three!": "Someone phoned; 123!", "one\u00a0hundred": "100", "a million": "a 1000000",
    "three billion two million and six": "3002000006", "élevenone two_three": "élevenone two_three", "ten nine": "19", "zero": "0", "hundred thousand": "100000", "two.five": "2.5",
}


def test_number_words(spark):
    rows = spark.createDataFrame([*NUMBERS.items(), (None, None)], "t string, want string").select("t", "want", text.number_words(F.col("t")).alias("got")).collect()
    assert [(r.t, r.got) for r in rows if r.got != r.want] == []


def test_normal_forms(spark):
    assert one(spark, text.phrase_key(F.lit("  Hé, you_there! 9 "))) == "hé you_there 9"
    assert one(spark, text.asr_key(F.lit("It’s  <ok> – Yes"))) == "it's ok yes"
    assert one(spark, text.without_odd_signs(F.lit("“a”\u200b  b…"))) == '"a" b...'
    assert one(spark, text.slug(F.lit("voice mix, (v2) & extra"))) == "voice_mix_v2_extra"
    assert one(spark, text.slug(F.lit(",,,,"))) == "fallback"
    long = one(spark, text.slug(F.lit("A" * 400), 64))
    assert len(long) == 64 and long == one(spark, text.slug(F.lit("A" * 400), 64))
    assert one(spark, text.vtt_time(F.lit(3661.0005))) == "01:01:01.000"
    assert one(spark, text.ass_time(F.lit(59.999))) == "0:01:00.00"
    assert one(spark, text.float_list(F.lit("1, 2.5;x  -3"))) == [1.0, 2.5, -3.0]
    assert one(spark, text.flag(F.lit(" Yes "))) is True and one(spark, text.flag(F.lit("?"))) is False
    assert one(spark, text.ass_text(F.lit("a{b}\n"))) == "a\\{b\\}\\N"
    assert len(one(spark, text.short_model_name(F.lit("runs/" + "m" * 60)))) == 27


def test_quality_tier_limits(spark):
    rows = [(0.0, 0.0, 1.0, "safe"), (0.6, 0.0, 1.0, "drop"), (0.59, -0.6, 2.5, "review"), (None, None, None, "safe"), (0.1, 0.0, 1.0, "review"), (0.0, -0.61, 1.0, "drop")]
    df = spark.createDataFrame(rows, "n double, l double, r double, want string")
    assert all(r.got == r.want for r in df.select(scores.quality_tier(F.col("n"), F.col("l"), F.col("r")).alias("got"), "want").collect())


def test_buckets_are_nested(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    some = {r.k for r in df.where(hashing.in_share(F.col("k"), 0.3)).collect()}
    more = {r.k for r in df.where(hashing.in_share(F.col("k"), 0.5)).collect()}
    assert some < more and 0.25 < len(some) / 3000 < 0.35
    assert df.where(hashing.in_share(F.col("k"), 0)).count() == 0 and df.where(hashing.in_share(F.col("k"), 1)).count() == 3000


def test_scores(spark):
    assert one(spark, scores.duration_bucket(F.lit(None).cast("double"))) == "0-1s"
    assert one(spark, scores.score_1_100(F.lit(0.5), F.lit(0.0), F.lit(1.0))) == 51
    assert abs(one(spark, scores.severity(F.lit(1.0), F.lit(1.0), F.lit(1.0))) - 1.5) < 1e-12
    assert abs(one(spark, scores.repeat_share(F.split(F.lit("a b a b"), " "), 2)) - 1 / 3) < 1e-12
    assert one(spark, scores.context_size(F.lit(1.0))) == 64
