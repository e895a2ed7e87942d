import random

import pytest
from pyspark.sql import functions as F

from spoolwright.operators import edits, records, selection
from spoolwright.functions import paths, scores

NAN = float("nan")


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_labels_and_indices(spark):
    l, s = F.lit, F.lit(None).cast("string")  # noqa: E741
    assert one(spark, *[records.augmentation_label(x).alias(str(i)) for i, x in enumerate((l("a__TEMPO__reverb.wav"), l("x.wav"), s))]) == ("reverb", "original", None)
    none = F.lit(None).cast("int")
    assert one(spark, records.chunk_index(none, l("chunks/a__chunk0012.wav")).alias("a"), records.chunk_index(l(3), l("chunk9")).alias("b"), records.chunk_index(none, s).alias("c")) == (12, 3, None)
    assert one(spark, records.publish_path("root/", l(2), l("\\a\\b.wav")).alias("p")) == ("root/part-00002/a/b.wav",)
    assert one(spark, paths.unquoted(l(" '\"a b\"' ")).alias("p")) == ("a b",)


def test_publish_rules(spark):
    rows = [("good-name", "A title", "A subtitle of some length", ""), ("Bad_name", "A title", "A subtitle of some length", "id"), ("a-b", "tiny", "short", "id;title;subtitle"), (None, None, None, "id;title;subtitle"), ("x" * 51, "A title", "y" * 81, "id;subtitle"), ("double--dash", "A title", "A subtitle of some length", "id")]
    df = spark.createDataFrame(rows, "s string, t string, u string, want string")
    assert all(r.got == r.want for r in df.select(F.array_join(records.publish_issues(F.col("s"), F.col("t"), F.col("u")), ";").alias("got"), "want").collect())


def test_extremes_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 5.0, 0.0), (2, 5.0, None), (3, None, 0.0), (4, NAN, 0.0), (5, 4.0, 0.0), (6, 5.0, 1.0)], "i int, a double, b double")
    assert sorted(r.i for r in records.at_extremes(df, "a", "b").collect()) == [1, 2, 3]
    assert records.at_extremes(df.limit(0), "a", "b").collect() == []
    lines = spark.createDataFrame([('{"a": 1, "b": 2}',), ('{"a": null}',), ("{oops",), (None,)], "j string")
    assert tuple(records.missing_keys(lines, "j", ["a", "b"]).first()) == (4, 2, 1, False)
    assert tuple(records.missing_keys(lines.limit(0), "j", ["a"]).first()) == (0, 0, 0, False)
    assert records.ordered_distinct(df.limit(0), "a", "i").collect() == [] and records.moved_sample(df.limit(0).select("i"), df.select("i"), "i", 3, "x").count() == 6


@pytest.mark.parametrize("block", [4096, 40])
def test_probing_against_a_plain_loop(spark, monkeypatch, block):
    monkeypatch.setattr(records, "_BLOCK", block)
    rng = random.Random(block)
    valid = [rng.random() < 0.03 for _ in range(130)]
    others = spark.createDataFrame([(i * 3, v) for i, v in enumerate(valid)], "i long, ok boolean")
    targets = spark.createDataFrame([(i * 3,) for i in range(130)] + [(None,)], "i long")
    got = {(r.target, r.k): r.other for r in records.paired_by_hash(targets, others, "i", F.col("ok"), 2).collect()}
    import hashlib

    want = {}
    for t in range(130):
        for k in range(2):
            at = int(hashlib.sha1(f"{t * 3}:{k}".encode()).hexdigest()[:15], 16) % 130
            for step in range(25):
                p = (at + step) % 130
                if valid[p] and p != t:
                    want[(t * 3, k)] = p * 3
                    break
    assert got == want and len(want) < 260
    assert records.paired_in_turn(targets.limit(1), "i").count() == 0 and records.paired_with_redraw(targets.limit(0), "i").count() == 0


def test_name_matches(spark):
    a = spark.createDataFrame([(1, "memo one"), (2, "memo one__chunk0003__l"), (3, "long enough name of it"), (4, "shared start here"), (5, "none"), (6, None)], "i int, s string")
    n = spark.createDataFrame([("memo one",), ("memo one",), ("long enough n",), ("shared start a",), ("shared start b",), (None,)], "n string")
    got = {r.i: (r["match"], r.tier) for r in records.matched_names(a, "i", F.col("s"), n, "n").collect()}
    assert got == {1: ("memo one", "exact"), 2: ("memo one", "stripped"), 3: ("long enough n", "prefix"), 4: (None, None), 5: (None, None), 6: (None, None)}


def test_comparison_and_similarity(spark):
    df = spark.createDataFrame([("a b c d", "a b c x", "a b c d"), ("a b", "a b", "a x"), ("a b", "A, b!", "a b"), (None, None, "x")], "r string, o string, p string")
    assert [(r.norm_match, r.better) for r in records.compared(df, "r", "o", "p").collect()] == [(False, "patched"), (False, "original"), (True, "tie"), (False, "original")]
    alike = spark.createDataFrame([("Hello  there you", "hello there you"), ("abcd", "bcde"), ("", "x"), (None, None)], "a string, b string")
    assert [round(r[0], 4) for r in alike.select(edits.similarity("a", "b")).collect()] == [1.0, 0.75, 0.0, 1.0]


def test_single_scores(spark):
    l = lambda *x: [F.lit(v).cast("double") for v in x]  # noqa: E731,E741
    assert one(spark, *[scores.colour_bin(*l(x, 0.0, 1.0)).alias(str(i)) for i, x in enumerate((-1.0, 0.0, 0.5, 0.999, 1.0))], scores.colour_bin(*l(3.0, 1.0, 1.0)).alias("same")) == (0, 0, 3, 6, 6, 3)
    df = spark.createDataFrame([("few", 1.0), ("few", None), *(("many", float(i)) for i in range(101))], "g string, v double")
    low, high = scores.spread_limits(F.col("v"))
    assert {r.g: (r.low, r.high) for r in df.groupBy("g").agg(low.alias("low"), high.alias("high")).collect()} == {"few": (-2.0, 0.0), "many": (5.0, 95.0)}
    assert one(spark, scores.efficiency(*l(-0.5, 2.0, 0.5)).alias("a"), scores.efficiency(*l(1.0, 0.0, 1.0)).alias("b")) == (1.0, None)


def test_patterns_of_a_recording(spark):
    df = spark.createDataFrame([("a", 0, 10, 1.0), ("a", 20, 30, None), ("a", 25, 40, 0.5), ("b", 5, 6, None), (None, 0, 1, 0.1)], "k string, s long, e long, c double")
    got = {r.k: tuple(r)[1:] for r in records.speech_patterns(df, "k", "s", "e", ["s", "e"], F.col("c")).collect()}
    assert got == {"a": (3, 0.75, 10, 0.875), "b": (1, None, 0, 1.0), None: (1, 0.1, 0, 1.0)}
    e = {r.k: tuple(r)[1:] for r in records.energy_summary(df, "k", F.col("e") - F.col("s"), F.col("c").isNull()).collect()}
    assert e == {"a": (3, 35, 10, 28.5714), "b": (1, 1, 1, 100.0), None: (1, 1, 0, 0.0)}


def test_history_and_overrides(spark):
    assert records.parsed_overrides(["a=1", " b = x=y ", "a=2"]) == {"a": "2", "b": "x=y"}
    with pytest.raises(ValueError):
        records.parsed_overrides(["novalue"])
    runs = F.array(F.lit("x"), F.lit("y"))
    assert one(spark, records.appended_history(runs, F.lit("z"), 2).alias("a"), records.appended_history(F.lit(None).cast("array<string>"), F.lit("z")).alias("b")) == (["y", "z"], ["z"])


def test_epochs_cover_all_places_once(spark):
    df = spark.range(50)
    got = [r for start in range(0, 60, 20) for r in selection.epoch_slice(df, "id", "s", 30, start, 20).collect()]
    assert sorted((r.epoch, r["at"]) for r in got) == [(e, i) for e in range(2) for i in range(30)]
    assert all(len({r.id for r in got if r.epoch == e}) == 30 for e in range(2))
