"""Every core query against its SQL on the smallest tables."""

import os

import pytest

from spoolwright.plans import catalog
from spoolwright.plans.compare import differences, duck

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, con, name):
    assert differences(catalog.queries()[name](spark, SF), con, catalog.oracle_sql()[name]) == ""


def test_edits_after_the_first_words(spark, monkeypatch):
    from spoolwright.plans import metric_queries

    words = [f"w{i}" for i in range(90)]
    pairs = spark.createDataFrame([(1, " ".join(words), " ".join(words[:70] + ["x", "y"] + words[72:])), (2, " ".join(words), " ".join(words[:-5])), (3, "a", None)], "row_id int, ref string, hyp string")
    monkeypatch.setattr(metric_queries, "_pairs", lambda *_: pairs)
    assert {r.row_id: r.edits for r in metric_queries.first_words_wer(spark, SF).collect()} == {1: 2, 2: 5}


def test_chunks_have_a_tier(spark, tmp_path):
    from spoolwright.plans import sequence_queries

    dense = " ".join(f"{i}{chr(97 + i % 26)}q" for i in range(230))
    rows = [("a", 1, 1, 0.0, 1.0, dense), ("a", 2, 2, 1.0, 2.0, dense), ("a", 3, 3, 2.0, 3.0, "short"), ("b", 1, 4, 0.0, 1.0, "again " * 90), ("b", 2, 5, 9.0, 10.0, "plain")]
    spark.createDataFrame(rows, "audio_path string, idx int, seg_key long, start_sec double, end_sec double, text string").write.parquet(f"{tmp_path}/segment_refs.parquet")
    got = sequence_queries.chunk_builder(spark, str(tmp_path)).orderBy("audio_path", "start").collect()
    assert [(r.audio_path, r.n, r.tier != "drop", r.tokens <= 420) for r in got] == [("a", 1, True, True), ("a", 2, True, True), ("b", 1, True, True)]
    assert got[2].text == "plain" and got[2].tier == "safe"


def test_library_does_not_need_llm():
    import pathlib

    root = pathlib.Path(catalog.__file__).parent.parent
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert "spoolwright.llm" not in path.read_text()
