from pyspark.sql import functions as F

from spoolwright.operators import manifests as mf


def test_windows(spark):
    df = spark.createDataFrame([(10.0, 12.0, 6.0, 100.0), (0.5, 1.5, 6.0, 100.0), (98.0, 99.0, 6.0, 100.0), (1.0, 9.0, 6.0, 4.0)], "s double, e double, n double, t double")
    low, high = mf.centred_window(F.col("s"), F.col("e"), F.col("n"), F.col("t"))
    assert [tuple(r) for r in df.select(low, high).collect()] == [(8.0, 14.0), (0.0, 6.0), (94.0, 100.0), (0.0, 4.0)]
    low, high = mf.padded_window(F.col("s"), F.col("e"), F.col("n"))
    assert [tuple(r) for r in df.select(low, high).collect()][::3] == [(8.0, 14.0), (1.0, 9.0)]


def test_segments_match_by_position_or_id(spark):
    a = spark.createDataFrame([("d", 0, 7), ("d", 1, 8), ("e", 0, 1), ("e", 1, None), ("f", 0, 1)], "doc string, pos int, id int")
    b = spark.createDataFrame([("d", 0, 9), ("d", 1, 7), ("e", 0, 1)], "doc string, pos int, id int")
    got = sorted(map(tuple, mf.matched_segments(a, b, "doc", "pos", "id").collect()), key=str)
    assert got == sorted([("d", "position", 0, 0), ("d", "position", 1, 1), ("e", "id", 0, 0), ("e", "id", 1, None), ("f", "id", 0, None)], key=str)


def test_conflicts(spark):
    df = spark.createDataFrame([("a b", ""), ("a b", "A, B!"), ("a b", "a c"), ("a", "a b"), (None, None)], "x string, y string")
    assert [r[0] for r in df.select(mf.conflict_reasons(F.col("x"), F.col("y"))).collect()] == [["became_empty", "word_count_changed", "word_tokens_changed"], [], ["word_tokens_changed"], ["word_count_changed", "word_tokens_changed"], []]


def test_interleaving_is_even(spark):
    got = mf.interleaved(spark.range(400).select("id", (F.col("id") < 100).alias("c")), F.col("c"), "id", "s").orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(400))
    assert all(20 <= sum(x.c for x in got[i : i + 100]) <= 30 for i in range(0, 301, 10))
    assert mf.interleaved(spark.range(0).select("id", F.lit(True).alias("c")), F.col("c"), "id", "s").count() == 0


def test_pairs_and_arguments(spark):
    e = spark.createDataFrame([("k", 1, "a"), ("k", 2, "a"), ("k", 2, "b"), ("k", 5, "a"), (None, 1, "a"), (None, 3, "b")], "k string, t int, kind string")
    assert sorted(map(tuple, mf.paired_events(e, "k", "t", "kind", "a", "b").collect()), key=str) == sorted([("k", 1, 2), ("k", 2, 2), (None, 1, 3)], key=str)
    df = spark.createDataFrame([({"a": "1", "b": "2", "seed": "1"}, {"a": "1", "b": "3", "c": "4", "seed": "2"}), (None, {"x": "1"})], "p map<string,string>, q map<string,string>")
    assert [r[0] for r in df.select(mf.argument_differences(F.col("p"), F.col("q"), ["seed"])).collect()] == [{"b": "2 -> 3", "c": "null -> 4"}, {"x": "null -> 1"}]


def test_texts_at_any_depth(spark):
    df = spark.createDataFrame([(1, '{"text": "a", "x": [{"word": "b"}, {"y": {"transcript": "c"}}], "z": 1}'), (2, "{bad"), (3, None)], "k int, j string")
    assert sorted(map(tuple, mf.json_texts(df, "k", "j").collect())) == [(1, "$.text", "a"), (1, "$.x[0].word", "b"), (1, "$.x[1].y.transcript", "c")]


def test_best_with_base(spark):
    m = spark.createDataFrame([("base", 0.1), ("a", 0.9), ("b", 0.5), ("c", None)], "m string, s double")
    assert [(r.m, r.place) for r in mf.best_with_base(m, "s", "m", "base", 2).orderBy("place").collect()] == [("base", 0), ("a", 1), ("b", 2)]


def test_path_rewrite_counts_unmapped(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, p string")
    got = mf.rewritten_paths(rows, "p", spark.createDataFrame([("a", "x")], "o string, n string"), "o", "n").orderBy("id").collect()
    assert [(r.p, r.p_original, r.mapped) for r in got] == [("x", "a", True), ("b", "b", False), (None, None, False)]
