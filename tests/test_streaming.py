import pytest

from spoolwright.operators import stages
from spoolwright.streaming import operators as st


def test_agreed_words():
    state, fresh = st.agreed_words(([], 0), "a b".split())
    assert fresh == []
    state, fresh = st.agreed_words(state, "a b c".split())
    assert fresh == ["a", "b"]
    state, fresh = st.agreed_words(state, "a b d e".split())
    assert fresh == []
    _, fresh = st.agreed_words(state, "a b d e".split())
    assert fresh == ["d", "e"]


def test_stable_prefix_over_batches(spark, tmp_path):
    schema = "k string, i int, t string"
    for n, rows in enumerate([[("x", 0, "a b"), ("y", 0, "q")], [("x", 1, "a b c"), ("y", 1, None)], [("x", 2, "a b c d")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    del n
    stream = st.file_stream(spark, f"{tmp_path}/in")
    got = st.drained(st.stable_prefix(stream, "k", "i", "t"), "test")
    assert sorted(tuple(r) for r in got.collect()) == [("x", 1, "a b"), ("x", 2, "c")]


def test_append_once_over_runs(spark, tmp_path):
    folder = f"file://{tmp_path}"
    spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int").write.parquet(f"{folder}/in")

    def run():
        return st.append_once(st.file_stream(spark, f"{tmp_path}/in"), "k", f"{folder}/out", f"{folder}/seen", f"{folder}/cp")

    assert run() == 2 and run() == 0
    spark.createDataFrame([("b", 5), ("c", 3)], "k string, v int").write.mode("append").parquet(f"{folder}/in")
    assert run() == 1
    assert sorted(r.k for r in spark.read.parquet(f"{folder}/out").collect()) == ["a", "b", "c"]


def test_a_command_clears_the_state(spark, tmp_path):
    rows = [("x", 0, "a b"), ("x", 1, "a b"), ("x", 2, "STOP"), ("x", 3, "a b"), ("x", 4, "a b c")]
    spark.createDataFrame(rows, "k string, i int, t string").coalesce(1).write.parquet(f"file://{tmp_path}/in")
    got = st.drained(st.stable_prefix(st.file_stream(spark, f"{tmp_path}/in"), "k", "i", "t", reset="STOP"), "reset")
    assert sorted(tuple(r) for r in got.collect()) == [("x", 1, "a b"), ("x", 4, "a b")]


def test_state_of_other_work_is_refused(spark, tmp_path):
    folder = f"file://{tmp_path}"
    spark.createDataFrame([("a", 1)], "k string, v int").write.parquet(f"{folder}/in")
    run = lambda sig: st.append_once(st.file_stream(spark, f"{tmp_path}/in"), "k", f"{folder}/out", f"{folder}/seen", f"{folder}/cp", signature=sig)
    assert run("one") == 1 and run("one") == 0
    with pytest.raises(ValueError):
        run("two")
    assert stages.seeded(spark, f"{folder}/in", f"{folder}/copy") and not stages.seeded(spark, f"{folder}/in", f"{folder}/copy")
