import numpy as np
import pytest
from pyspark.sql import functions as F

from spoolwright.llm import containers


def check(df, capacity):
    rows = df.collect()
    load, parts = {}, {}
    for r in rows:
        load[r.container] = load.get(r.container, 0) + r.tokens
        parts.setdefault(r.container, []).append((r.first_token, r.tokens, r.position))
    assert max(load.values(), default=0) <= capacity
    for p in parts.values():
        p.sort(key=lambda x: (x[2]))
        assert [x[2] for x in p] == list(range(len(p)))
        at = 0
        for first, tokens, _ in p:
            assert first == at
            at += tokens
    return rows, load


@pytest.mark.parametrize("per_task", [50, 10**6])
def test_invariants(spark, per_task):
    rng = np.random.default_rng(1)
    sizes = np.r_[rng.integers(0, 60, 3000), rng.integers(100, 400, 40), np.zeros(200, int), [100, 200]].tolist()
    df = spark.createDataFrame([(i, int(s), "x") for i, s in enumerate(sizes)], "doc_id long, tokens long, item string").repartition(5)
    made = containers.packed(df, 100, per_task=per_task)
    rows, load = check(made, 100)
    total = {}
    for r in rows:
        total.setdefault(r.doc_id, []).append(r)
    assert {k: sum(r.tokens for r in v) for k, v in total.items()} == dict(enumerate(sizes))
    assert all(len(v) == max(1, -(-sizes[k] // 100)) for k, v in total.items())
    assert {r.doc_id for r in containers.cut_documents(made).collect()} == {k for k, s in enumerate(sizes) if s > 100}
    assert len(load) <= 1.02 * -(-sum(sizes) // 100) + 1


def test_nothing_fits_together(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(60).cast("long").alias("tokens"))
    assert len(check(containers.packed(df, 100, per_task=20), 100)[1]) == 500


def test_null_empty_and_repeated(spark):
    df = spark.createDataFrame([(1, None), (2, 0), (3, 5), (3, 5), (None, 7)], "doc_id long, tokens long")
    rows, load = check(containers.packed(df, 100), 100)
    assert len(rows) == 5 and len(load) == 1
    assert containers.packed(df.limit(0), 100).count() == 0
    assert containers.fill_report(containers.packed(df, 100), 100).first().waste == pytest.approx(0.83)


def test_best_fit():
    assert len(set(containers.best_fit(np.array([70, 20, 60, 40, 10]), 100).tolist())) == 2
