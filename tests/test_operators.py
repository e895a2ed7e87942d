import numpy as np
import pytest
from pyspark.sql import functions as F

from spoolwright.operators import edits, folds, lookup, metrics, ranking, selection, sequences, stages, vectors
from spoolwright.operators.order import ranked, value_at


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_ranked_is_a_row_number(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"), "id").repartition(7)
    got = ranked(df, "v").collect()
    order = sorted(r.v for r in got)
    assert sorted((r.v, r.pos) for r in got) == list(zip(order, range(5000)))


def test_threshold_value(spark):
    df = spark.createDataFrame([(x,) for x in [5.0, 1.0, 3.0, float("nan"), None, 2.0, 4.0]], "v double")
    assert value_at(df, "v", 0.4) == 2.0 and value_at(df, "v", 0.0) == 1.0
    assert value_at(df.limit(0), "v", 0.5) is None


def test_lookup_keeps_nan_and_prefers_the_first_key(spark):
    r = spark.createDataFrame([(1, "a", "b"), (2, None, "b"), (3, "x", "n"), (4, None, None)], "row_id int, k1 string, k2 string")
    t = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("n", float("nan"))], "k string, v double")
    got = rows(lookup.by_first_key(r, [F.col("k1"), F.col("k2")], t, "k", "v"), "row_id")
    assert got[0] == (1, 1.0, 0) and got[1] == (2, 2.0, 1) and np.isnan(got[2][1]) and got[2][2] == 1 and got[3] == (4, None, None)


def test_two_tier_needs_agreement(spark):
    t = spark.createDataFrame([("p/a", "a", "X"), ("q/a", "a", "X"), ("p/b", "b", "X"), ("q/b", "b", "Y")], "path string, name string, v string")
    r = spark.createDataFrame([(1, "p/b", "b"), (2, "z/a", "a"), (3, "z/b", "b")], "row_id int, path string, name string")
    assert rows(lookup.two_tier(r, "path", "name", t, "v"), "row_id") == [(1, "X", "exact"), (2, "X", "name"), (3, None, None)]


def test_semi_join_with_an_empty_list_keeps_all(spark):
    r = spark.createDataFrame([(1, "a"), (2, None)], "row_id int, k string")
    none = spark.createDataFrame([], "k string")
    assert lookup.with_any_key(r, [F.col("k")], none, "k").count() == 2
    assert lookup.without_any_key(r, [F.col("k")], none, "k").count() == 2


def test_upsert_keeps_old_entries(spark):
    d = spark.createDataFrame([(1, {"a": 1})], "id int, m map<string,int>")
    s = spark.createDataFrame([(1, {"a": 9, "b": 2}), (2, {"c": 3})], "id int, m map<string,int>")
    assert {r.id: r.m for r in lookup.upserted_map(d, s, "id", "m").collect()} == {1: {"a": 1, "b": 2}, 2: {"c": 3}}


def test_overlapping_spans_once_each(spark):
    a = spark.createDataFrame([("k", 1, 0, 100), ("k", 2, 95, 300), ("k", 3, 5, 5)], "k string, a int, l_start long, l_end long")
    b = spark.createDataFrame([("k", 7, 50, 250), ("k", 8, 300, 310)], "k string, b int, r_start long, r_end long")
    got = rows(lookup.overlapping_spans(a, b, "k", 10).select("a", "b", "start_ms", "end_ms"), "a", "b")
    assert got == [(1, 7, 50, 100), (2, 7, 95, 250)]


def test_mix_ratio(spark):
    private, public = (spark.range(n).withColumnRenamed("id", "k") for n in (10, 100))
    got = selection.capped_mix(private, public, "k", 0.30, "17")
    assert got.where("scope = 'public'").count() == 4 and got.count() == 14
    assert rows(got, "scope", "k") == rows(selection.capped_mix(private.repartition(3), public.repartition(5), "k", 0.30, "17"), "scope", "k")


def test_group_split_keeps_groups_whole(spark):
    df = spark.range(1000).select("id", (F.col("id") % 37).cast("string").alias("g"))
    got = selection.group_split(df, F.col("g"), 0.1, "s")
    assert got.groupBy("g").agg(F.count_distinct("in_test").alias("n")).where("n > 1").count() == 0
    assert got.where("in_test").select("g").distinct().count() == 4


def test_cap_per_group(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") < 1500, "hot").otherwise("cold").alias("g"))
    assert {r.g: r["count"] for r in selection.cap_per_group(df, "g", "id", 30, "x").groupBy("g").count().collect()} == {"hot": 30, "cold": 30}


def test_end_rules(spark):
    df = spark.createDataFrame([("a", 0, 100), ("a", 10, 20), ("a", 60, 70)], "k string, s long, e long")
    assert rows(sequences.merged_within(df, "k", "s", "e", 0, ["s", "e"]), "s") == [("a", 0, 100, 3)]
    assert rows(sequences.merged_within(df, "k", "s", "e", 0, ["s", "e"], "last"), "s") == [("a", 0, 20, 2), ("a", 60, 70, 1)]


def test_folds():
    w = [{"word": x, "start": s, "end": e} for x, s, e in [("a", 0.0, 1.0), ("b", 1.2, 2.0), ("bad", 3.0, 3.0), ("c", 2.5, 3.0), ("d", 3.1, 3.2)]]
    assert [x["text"] for x in folds.words_to_segments(w, 0.5, 9.0)] == ["a b", "c d"]
    s = [{"start": 0.0, "end": 1.0, "text": "a", "logprob": -0.1}, {"start": 1.2, "end": 2.0, "text": ".", "logprob": -9.0}, {"start": 2.0, "end": 3.0, "text": "b", "logprob": -0.5}, {"start": 9.0, "end": 10.0, "text": "c", "logprob": None}]
    got = folds.chunks_of_segments(s, 5.0, 1.0, 20.0)
    assert [(x["text"], x["n"], x["logprob"]) for x in got] == [("a b", 2, -0.5), ("c", 1, None)]
    bins = folds.least_loaded_packed([{"id": i, "size": z} for i, z in zip("abcd", (70, 20, 60, 40))], 100, 10)
    load = {}
    for b in bins:
        load.setdefault(b["bin"], set()).add(b["id"])
    assert sorted(map(sorted, load.values())) == [["a", "b"], ["c", "d"]]
    assert [b["bin"] for b in folds.greedy_packed([{"id": i, "size": z} for i, z in enumerate((5, 5, 50, 1))], 10)] == [0, 0, 1, 2]


def test_chunks_end_at_the_token_cap():
    s = [{"start": float(i), "end": i + 1.0, "text": "w", "tokens": 200, "ratio": r} for i, r in enumerate((1.0, 2.7, None, 1.5))]
    got = folds.chunks_of_segments(s, 6.0, 1.0, 20.0, 420)
    assert [(x["n"], x["tokens"], x["ratio"]) for x in got] == [(2, 400, 2.7), (2, 400, 1.5)]
    assert [x["n"] for x in folds.chunks_of_segments(s, 6.0, 1.0, 20.0)] == [4]
    assert folds.compression_ratio(" ") is None and folds.compression_ratio("ab " * 200) > 10 > 2 > folds.compression_ratio("one two three")


def test_edits_against_plain_dp(spark):
    def plain(a, b):
        d = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            d, prev = [i], d
            for j, y in enumerate(b, 1):
                d.append(min(prev[j] + 1, d[-1] + 1, prev[j - 1] + (x != y)))
        return d[-1]

    rng = np.random.default_rng(1)
    pairs = [(" ".join(rng.choice(list("abcd"), rng.integers(0, 12))), " ".join(rng.choice(list("abcd"), rng.integers(0, 12)))) for _ in range(60)]
    df = spark.createDataFrame(pairs, "ref string, hyp string")
    for r in edits.error_rates(df).collect():
        assert r.word_edits == plain(r.ref.split(), r.hyp.split())
    empty = spark.createDataFrame([("", ""), ("", "x"), (None, "x y"), ("x", None)], "ref string, hyp string")
    assert [(r.wer, r.cer) for r in edits.error_rates(empty).collect()] == [(0.0, 0.0), (1.0, 1.0), (1.0, 1.0), (1.0, 1.0)]


def test_pareto_and_leaderboard(spark):
    m = spark.createDataFrame([("a", 1.0, 5.0), ("b", 1.0, 6.0), ("c", 2.0, 6.0), ("d", 3.0, 7.0), ("e", None, 9.0)], "model string, cost double, gain double")
    assert [r.model for r in ranking.pareto(m, "cost", "gain", "model").collect()] == ["b", "d"]
    board = ranking.leaderboard(m.select("model"), [m.select("model", "gain"), m.select("model", "cost")], "model", "gain", "cost").orderBy("position").collect()
    assert board[0].model == "e" and [r.position for r in board] == [1, 2, 3, 4, 5]


def test_profile_on_a_grid(spark):
    rng = np.random.default_rng(6)
    v = {m: rng.integers(1, 40, 50) / 10 * f for m, f in (("a", 1.0), ("b", 2.0), ("c", 3.0))}
    df = spark.createDataFrame([(i, m, float(x)) for m in v for i, x in enumerate(v[m])] + [(99, "a", 0.0), (99, "b", 1.0)], "i int, m string, v double")
    ratio = {m: v[m] / np.min(list(v.values()), axis=0) for m in v}
    for points, most in ((120, 6.0), (120, 100.0), (5, 1.3)):
        end = max(1.2, min(most, np.percentile(np.concatenate(list(ratio.values())), 95)))
        want = [(m, i, round(t, 6), round(float((ratio[m] <= t).mean()), 6)) for m in "abc" for i, t in enumerate(np.linspace(1.0, end, points))]
        assert np.allclose([r[1:] for r in rows(metrics.performance_curve(df, "i", "m", "v", points, most=most), "m", "point")], [w[1:] for w in want], atol=2e-6)
    assert metrics.performance_curve(df.where("i = 99"), "i", "m", "v").count() == 0


def test_bootstrap_covers_the_mean(spark):
    df = spark.range(4000).select("id", F.lit("m").alias("g"), (F.col("id") % 100 / 100.0).alias("v"))
    r = metrics.bootstrap_interval(df, "g", "id", "v").first()
    assert r.n == 4000 and r.low < r.mean < r.high and abs(r.mean - 0.495) < 1e-9
    assert metrics.bootstrap_interval(df.repartition(7, "v"), "g", "id", "v").first() == r


def test_quantiles_of_groups(spark):
    rng = np.random.default_rng(8)
    data = [(g, None if x > 0.95 else float("nan") if x > 0.9 else round(float(x), 2)) for g in ("a", "b", None) for x in rng.random(101)] + [("one", 3.0), ("none", None)]
    df = spark.createDataFrame(data, "g string, v double")
    shares = (0.0, 0.1, 0.5, 0.9, 1.0)
    for r in metrics.quantiles(df, "g", "v", shares).collect():
        own = [v for g, v in data if g == r.g and v is not None and v == v]
        assert [r[f"p{int(100 * p)}"] for p in shares] == [round(float(np.quantile(own, p)), 6) if own else None for p in shares]
    assert metrics.quantiles(df, "g", "v").count() == 5
    got = {r.g: r for r in metrics.summary(df, "g", "v").collect()}
    assert len(got) == 5 and got["none"].n == 0 and got["one"].p95 == 3.0


def test_group_split_share(spark):
    """Rows without a group are none together."""
    df = spark.range(5000).select("id", F.when(F.col("id") % 2 == 0, (F.col("id") % 300).cast("string")).alias("g"))
    got = selection.group_split(df, F.coalesce("g", F.concat(F.lit("row:"), F.col("id").cast("string"))), 0.1, "13")
    assert got.where("in_test").select(F.coalesce("g", F.concat(F.lit("row:"), F.col("id").cast("string")))).distinct().count() == 265
    assert 0.06 < got.where("in_test").count() / 5000 < 0.14
    assert got.where("g is not null").groupBy("g").agg(F.count_distinct("in_test").alias("n")).where("n > 1").count() == 0


def test_list_edits_within_a_band():
    rng = np.random.default_rng(3)
    lists = [rng.integers(1, 5, rng.integers(0, 30)) for _ in range(200)]
    flat = lambda x: (np.concatenate(x), np.r_[0, np.cumsum([len(v) for v in x])])
    a, b = lists[:100], lists[100:]
    full = edits.list_edits(*flat(a), *flat(b), np.full(100, 60))
    for most in (rng.integers(0, 12, 100), np.zeros(100, int)):
        got = edits.list_edits(*flat(a), *flat(b), most, cells=64)
        assert np.array_equal(got <= most, full <= most) and np.array_equal(got[full <= most], full[full <= most])


def test_vectors(spark):
    df = spark.createDataFrame([(1, "x", [1.0, 0.0]), (2, "x", [0.0, 1.0]), (3, "y", [0.0, 2.0]), (4, "y", None)], "id int, g string, v array<double>")
    c = {r.g: r.centroid for r in vectors.centroid(df, "g", "v").collect()}
    assert np.allclose(c["x"], [0.5**0.5] * 2) and np.allclose(c["y"], [0, 1])
    got = rows(vectors.scored_by(df.where("v is not null"), "id", "v", vectors.centroid(df, "g", "v"), "g", "centroid"), "id")
    assert [(i, g) for i, g, *_ in got] == [(1, "x"), (2, "y"), (3, "y")]


def test_nearest_of_the_others(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x, g = rng.normal(size=(60, 4)), [None if i % 4 == 0 else "ab"[i % 2] for i in range(60)]
    x[7] = 0
    df = spark.createDataFrame([*((i, g[i], x[i].tolist()) for i in range(60)), (60, "a", None)], "id int, g string, v array<double>")
    want = {7: (None, None), 60: (None, None)}
    for i in set(range(60)) - {7}:
        s, j = max((x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]), j) for j in range(60) if g[j] != g[i] and j != 7)
        want[i] = (j, round(s, 6))
    for block in (2048, 8):
        monkeypatch.setattr(vectors, "BLOCK", block)
        got = {r.id: (r.other_id, r.score) for r in vectors.nearest_apart(df, "id", "v", "g").collect()}
        assert got.keys() == want.keys() and all(got[i] == want[i] or got[i][0] == want[i][0] and abs(got[i][1] - want[i][1]) < 2e-6 for i in want)
    assert [r.other_id for r in vectors.nearest_apart(df.where("g = 'a'"), "id", "v", "g").collect()] == [None] * df.where("g = 'a'").count()


def test_stage_gate_and_appending(spark, tmp_path):
    sig = stages.signature({"limit": 1}, {"in": "a"})
    assert stages.should_run("s", sig, {}, True) and not stages.should_run("s", sig, {"s": sig}, True) and stages.should_run("s", stages.signature({"limit": 2}, {"in": "a"}), {"s": sig}, True)
    out, seen = f"file://{tmp_path}/out", f"file://{tmp_path}/seen"
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    assert stages.append_unseen(spark, df, "k", out, seen) == 2
    assert stages.append_unseen(spark, df, "k", out, seen) == 0
    assert stages.append_unseen(spark, spark.createDataFrame([("c", 9)], "k string, v int"), "k", out, seen) == 1


def test_a_broken_run_adds_nothing_twice(spark, tmp_path):
    out, seen = f"file://{tmp_path}/out", f"file://{tmp_path}/seen"
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, v int")
    assert stages.append_unseen(spark, df.where("k = 'a'"), "k", out, seen) == 1
    # rows written, keys not: what a run that breaks off leaves
    df.where("k = 'b'").write.mode("append").parquet(out)
    (tmp_path / "seen.pending").touch()
    assert stages.append_unseen(spark, df, "k", out, seen) == 0 and not (tmp_path / "seen.pending").exists()
    assert stages.append_unseen(spark, df, "k", out, seen) == 0 and spark.read.parquet(out).count() == 2


def test_spans_of_any_length(spark):
    rng = np.random.default_rng(4)
    spans = [(i, "k", int(s), int(s + rng.choice([1, 5, 300, 10**6, 10**15]))) for i, s in enumerate(rng.integers(-500, 2000, 60))]
    left = spark.createDataFrame(spans[:30], "a int, k string, l_start long, l_end long")
    right = spark.createDataFrame(spans[30:], "b int, k string, r_start long, r_end long")
    got = sorted((r.a, r.b, r.start_ms, r.end_ms) for r in lookup.overlapping_spans(left, right, "k", 10).collect())
    assert got == sorted((a, b, max(s, x), min(e, y)) for a, _, s, e in spans[:30] for b, _, x, y in spans[30:] if s < y and x < e)
    points = spark.createDataFrame([(i, "k", int(p)) for i, p in enumerate(rng.integers(-500, 3000, 50))], "i int, k string, p long")
    got = sorted((r.i, r.b) for r in lookup.containing_spans(points, right, "k", "p", "r_start", "r_end", 10).collect())
    assert got == sorted((r.i, b) for r in points.collect() for b, _, x, y in spans[30:] if x <= r.p <= y)


def test_hot_keys_joined_apart(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 10 < 3, "hot").when(F.col("id") % 10 == 9, None).otherwise(F.col("id").cast("string")).alias("k"))
    table = df.where("k is not null and (k = 'hot' or id % 4 = 0)").groupBy("k").agg(F.min("id").alias("v"))
    for how in ("inner", "left_semi"):
        assert sorted(map(tuple, lookup.joined_apart(df, table, "k", how).collect())) == sorted(map(tuple, df.join(table, "k", how).select(*lookup.joined_apart(df, table, "k", how).columns).collect()))


def test_keywords_are_bounded(spark):
    with pytest.raises(ValueError):
        edits.near_keywords(spark.range(1).select(F.lit("a").alias("t")), "t", spark.range(10_001).select(F.col("id").cast("string").alias("k")), "k", 1)
