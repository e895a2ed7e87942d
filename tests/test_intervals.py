import random

from spoolwright.operators import intervals as iv


def spans(spark, rows):
    return spark.createDataFrame(rows, "audio_path string, start_time double, end_time double, start_ms long")


def brute(rows):
    out, by = set(), {}
    for k, s, e in rows:
        by.setdefault(k, []).append((s, e))
    for k, x in by.items():
        x.sort()
        done = []
        for s, e in x:
            if done and s <= done[-1][1]:
                done[-1][1] = max(done[-1][1], e)
                done[-1][2] += 1
            else:
                done.append([s, e, 1])
        out |= {(k, "merged", s, e) for s, e, n in done if n > 1}
        out |= {(k, "gap", a[1], b[0]) for a, b in zip(done, done[1:])}
    return out


def found(df, block=iv.BLOCK_MS):
    return sorted(((r["k"], r["kind"], r["start_ms"], r["end_ms"]) for r in iv.merged_and_gaps(df, ["k"], block).collect()), key=str)


def test_blocks_of_any_width_agree_with_a_sweep(spark):
    rng = random.Random(5)
    rows = []
    for k in ("a", "b", None, ""):
        for _ in range(120):
            s = rng.randrange(0, 6000) * 10
            rows.append((k, s, s + rng.choice([10, 20, 100, 700, 5000])))
    rows += rows[:15]
    df = spark.createDataFrame(rows, "k string, start_ms long, end_ms long")
    want = sorted(brute(rows), key=str)
    for block in (100, 1000, 10**9):
        assert sorted(found(df, block), key=str) == want


def test_touching_nested_and_repeated(spark):
    df = spark.createDataFrame([("a", 0, 10), ("a", 10, 20), ("a", 30, 40), ("a", 30, 40), ("a", 50, 90), ("a", 60, 70), ("a", 95, 99)], "k string, start_ms long, end_ms long")
    assert found(df) == sorted([("a", "merged", 0, 20), ("a", "merged", 30, 40), ("a", "merged", 50, 90), ("a", "gap", 20, 30), ("a", "gap", 40, 50), ("a", "gap", 90, 95)], key=str)


def test_bad_times_are_ignored_and_noise_is_rounded(spark):
    nan = float("nan")
    rows = [("a", 1.0, 2.0, 9), ("a", 1.9999999, 3.0, 9), ("a", None, 4.0, 9), ("a", 4.0, nan, 9), ("a", nan, 5.0, 9), ("a", 9.0, 8.0, 9), ("a", 7.0, 7.0, 9), (None, 1.0, 2.0, 9), ("a", 1.0, float("inf"), 9)]
    got = sorted(map(tuple, iv.valid_spans(spans(spark, rows), ["audio_path"], "start_time", "end_time").collect()), key=str)
    assert got == sorted([("a", 1000, 2000), ("a", 2000, 3000), (None, 1000, 2000)], key=str)


def test_empty(spark):
    assert found(spark.createDataFrame([], "k string, start_ms long, end_ms long")) == []


def test_hot_entity_is_spread(spark):
    df = spark.range(20000).selectExpr("'hot' as k", "id * 1000 as start_ms", "id * 1000 + 1000 as end_ms")
    assert found(df) == [("hot", "merged", 0, 20000000)]
