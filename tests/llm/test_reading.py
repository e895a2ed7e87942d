import random

import pytest

from spoolwright.llm import reading


def words_of(level, rng, n=120):
    own = [f"{'abcde'[level - 1]}{chr(97 + i)}{chr(97 + j)}" for i in range(10) for j in range(4)]
    near = [f"{'abcde'[min(4, level) - 1]}{chr(97 + i)}z" for i in range(6)]
    return " ".join(rng.choice(own if rng.random() < 0.7 else near) for _ in range(n))


def test_layout_is_taken_off():
    text = "WEBVTT\n\n00:00:01.046 --> 00:00:07.872\nHe said it.\n\n[13:18:39.025] INFO stage=12 rows=4 path=/x/y\r\n## Notes 19\nSPEAKER_02: Don’t go.\n- up, up 3 times\n12\n"
    assert reading.prose_words(text) == ["he", "said", "it", "don't", "go", "up", "up", "times"]
    assert reading.prose_words(None) == [] and reading.prose_words("") == []


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(400):
        level = 1 + i % 5
        docs.append((i, words_of(level, rng), level))
        if i < 150:
            labels.append((i, level if rng.random() < 0.9 else max(1, min(5, level + rng.choice([-1, 1]))), "r1"))
            if i % 3 == 0:
                labels += [(i, level, "r2"), (i, level, "r2"), (i, None, "r3")]
    docs += [(900, None, 0), (901, "", 0), (902, "ganz andere wörter " * 60, 0), (903, docs[0][1][:200], 0), (904, "WEBVTT\n" + "ab " * 20, 0)]
    return spark.createDataFrame([(a, b, c, "clash") for a, b, c in docs], "doc_id long, text string, truth int, level string"), spark.createDataFrame(labels, "doc_id long, level int, rater string")


def test_held_out_accuracy(tables):
    docs, labels = tables
    got = reading.levels(docs, reading.fitted(docs, labels)).join(docs.select("doc_id", "truth"), "doc_id").where("doc_id between 150 and 399").collect()
    assert sum(r.level == r.truth for r in got) / len(got) > 0.95 and all(r.english for r in got)


def test_cases(tables):
    docs, labels = tables
    scored = {r.doc_id: r for r in reading.levels(docs, reading.fitted(docs, labels)).collect()}
    assert scored[900].level is None and scored[900].words == 0 and not scored[900].english and scored[901].level is None
    assert not scored[902].english and scored[904].words == 20
    bands = {r.doc_id: r.band for r in reading.banded(reading.levels(docs, reading.fitted(docs, labels))).collect()}
    assert not {900, 901, 902, 903, 904} & bands.keys() and set(bands.values()) == {"easy", "demanding"}


def test_without_ratings_or_documents(tables):
    docs, labels = tables
    assert reading.levels(docs, reading.fitted(docs, labels.limit(0))).where("level is not null").count() == 0
    assert reading.levels(docs.limit(0), reading.fitted(docs, labels)).count() == 0


def test_ratings_are_bounded(tables):
    assert reading.rated(tables[1], 7).count() == 7
