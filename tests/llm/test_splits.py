import random

import pytest
from pyspark.sql import functions as F

from spoolwright.llm import splits

ROWS = "row_id long, uid string, base_uid string, aug_stage string, audio_path string, source_audio string, start_sec double, end_sec double, split_name string, node string, root string"


def tables(spark, rows, batches=(), roots=(("D:\\lab", "lab"), ("/mnt/lab", "lab"))):
    return (
        spark.createDataFrame([(*r, "clash", "clash") for r in rows], ROWS),
        spark.createDataFrame(list(batches), "original_file string, batch_file string, start_sec double, end_sec double, gap_sec double"),
        spark.createDataFrame(list(roots), "root_path string, canonical_root string"),
    )


def test_every_way_to_a_recording(spark):
    rows = [
        (1, "u1", "u1", "", None, "D:\\lab\\recordings\\f\\A 1.wav", None, None, "train"),
        (2, "u2", "u2", "", "/mnt/lab/chunks/F/a 1__chunk0003__L.wav", None, None, None, "test"),
        (3, "u3", "u3", "", "lab\\batches\\b.ogg", None, 10.0, 12.0000001, None),
        (4, "u4", "u2", "noise", "lab/aug/u2_u4__noise__copy00.wav", None, None, None, "train"),
        (5, "u5", None, "gain", "lab/aug/u4_u5__gain__copy00.wav", None, None, None, "train"),
        (6, "u6", "u6", "", None, None, None, None, "test"),
        (7, "u7", "u7", "", "lab/chunks/g/a 1__chunk0003.wav", None, None, None, "test"),
        (8, "u8", "none", "noise", None, None, None, None, "test"),
        (9, "u9", "u9", "", "lab/batches/b.ogg", None, 12.5, 13.0, "train"),
        (1, "u1", "u1", "", None, "D:\\lab\\recordings\\f\\A 1.wav", None, None, "train"),
    ]
    batches = [("D:\\lab\\recordings\\f\\a 1.MP3", "/mnt/lab/batches/B.ogg", 9.0, 12.0, None), ("lab/recordings/g/x.wav", "lab/batches/b.ogg", 12.5, 12.5, 1.0), (None, "lab/batches/b.ogg", 0.0, 100.0, 1.0)]
    got = sorted(r.row_id for r in splits.mixed_recordings(*tables(spark, rows, batches)).collect())
    assert got == [1, 1, 2, 3, 4, 5]


def test_forest_of_chains_stars_and_cycles(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(1, 200)] + [(1000, 1001 + i) for i in range(300)] + [(5000, 5001), (5001, 5002), (5002, 5000), (5000, 5001), (7, 7)]
    rng.shuffle(edges)
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    roots, tree = splits.spanning_forest(df)
    of = {r.node: r.root for r in roots.collect()}
    assert len(of) == 200 + 301 + 3
    assert len({of[i] for i in range(1, 201)}) == 1 and len({of[1000 + i] for i in range(301)}) == 1 and len({of[5000 + i] for i in range(3)}) == 1 and len(set(of.values())) == 3
    assert tree.count() == len(of) - 3


def test_empty(spark):
    assert splits.spanning_forest(spark.createDataFrame([], "a long, b long"))[0].count() == 0
    assert splits.mixed_recordings(*tables(spark, [])).count() == 0
    assert splits.grouped_splits(*tables(spark, [])).count() == 0


@pytest.mark.parametrize("giant", [0, 4000])
def test_shares_and_whole_groups(spark, giant):
    rng = random.Random(4)
    rows, n = [], 0
    for g in range(1500):
        for _ in range(giant if g == 0 and giant else rng.choice([1, 2, 3, 5, 9])):
            rows.append((n, f"u{n}", f"u{n}", "", None, f"lab/recordings/f/r{g}.wav", None, None, "train"))
            n += 1
    got = splits.grouped_splits(*tables(spark, rows)).cache()
    assert got.count() == n and got.groupBy("root").agg(F.count_distinct("split").alias("k")).where("k > 1").count() == 0
    share = {r.split: r["count"] / n for r in got.groupBy("split").count().collect()}
    assert abs(share["train"] - 0.8) < 0.01 and abs(share["validation"] - 0.1) < 0.01 and abs(share["test"] - 0.1) < 0.01
