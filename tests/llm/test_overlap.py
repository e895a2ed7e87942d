import random
from collections import Counter
from itertools import combinations

import pyarrow as pa
import pytest

from spoolwright.llm import overlap

SCHEMA = "row_id long, split_name string, source string, audio_path string, start_sec double, end_sec double, text string, train string, words string, d1 string"
ROOTS = [("D:\\lab", "lab"), ("/mnt/lab", "lab")]


def roots(spark):
    return spark.createDataFrame(ROOTS, "root_path string, canonical_root string")


def distance(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        d, prev = [i], d
        for j, y in enumerate(b, 1):
            d.append(min(prev[j] + 1, d[-1] + 1, prev[j - 1] + (x != y)))
    return d[-1]


def near(a, b):
    a, b = (x.lower().replace("'", "").split() for x in (a or "", b or ""))
    return min(len(a), len(b)) >= 8 and 20 * distance(a, b) <= 3 * max(len(a), len(b))


def table(spark, rows):
    return spark.createDataFrame([(i, s, "x", p, a, b, t, "clash", "clash", "clash") for i, s, p, a, b, t in rows], SCHEMA)


def found(spark, rows):
    got = overlap.overlapping_rows(table(spark, rows), roots(spark))
    return {(r.eval_id, r.train_id): r for r in got.collect()}


def chunks_of(texts, mask):
    c = overlap.chunked(overlap.records(pa.array(texts)), mask)
    return c, [Counter(zip(c.digest[a:b].tolist(), c.length[a:b].tolist())) for a, b in zip(c.begins, c.begins[1:])]


@pytest.mark.parametrize("mask", [0, 1, 3])
def test_edits_lose_no_more_chunks_than_said(mask):
    """Words of one and two bytes too, at which the window reaches into the words before."""
    rng = random.Random(mask)
    words = [*"abcde", "ab", "cd", "é", "日", "abc", "defg", "hijkl"]
    for _ in range(3000):
        t = [rng.choice(words) for _ in range(rng.randint(1, 40) if rng.random() < 0.8 else rng.randint(60, 90))]
        other = list(t)
        for _ in range(rng.randint(0, 7 if len(t) < 60 else 14)):
            at = rng.randrange(len(other) + 1)
            other[at : at + rng.randint(0, 1)] = rng.choice([[], [rng.choice(words)]])
        if not other or 20 * distance(t, other) > 3 * max(len(t), len(other)):
            continue
        c, (own, new) = chunks_of([" ".join(t), " ".join(other)], mask)
        shared = own & new
        assert (own - new).total() <= c.lost[0] and (new - own).total() <= c.lost[1]
        words_shared = sum(n * length for (_, length), n in shared.items())
        assert words_shared >= max(c.least) and words_shared == overlap.shared_words(*(chunks_of([" ".join(x)], mask)[0] for x in (t, other)))[0]


@pytest.mark.parametrize("longest", [30, 90])
def test_nothing_is_missed(spark, longest):
    """Random edits of few words, so that chunks are common and pairs lie on both sides of the limit."""
    rng = random.Random(longest)
    words = [f"w{i}" for i in range(25)]
    texts = [[rng.choice(words) for _ in range(rng.randint(7, longest))] for _ in range(12)]
    for _ in range(60):
        t = list(rng.choice(texts))
        for _ in range(rng.randint(0, max(1, len(t) // 6))):
            at = rng.randrange(len(t))
            t[at : at + rng.randint(0, 1)] = rng.choice([[], [rng.choice(words)]])
        texts.append(t)
    rows = [(i, rng.choice(["train", "validation", "test"]), None, None, None, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(1000 + r[0], *r[1:]) for r in rows[:10]]
    want = {(a[0], b[0]) if b[1] == "train" else (b[0], a[0]) for a, b in combinations(rows, 2) if (a[1] == "train") != (b[1] == "train") and near(a[5], b[5])}
    assert set(found(spark, rows)) == want and want


def test_text_cases(spark):
    base = "one two three four five six seven eight nine"
    rows = [
        (1, "train", None, None, None, base), (2, "test", None, None, None, "One, two; THREE four five six seven eight nine!"), (3, "test", None, None, None, "one two three four five six seven"), (4, None, None, None, None, base),
        (5, "validation", None, None, None, "ｏｎｅ two thr\u200bee fоur five six seven eight nine"), (6, "train", None, None, None, None), (7, "test", None, None, None, ""), (8, "test", None, None, None, "don't two three four five six seven eight nine"),
        (9, "test", None, None, None, "one two X four five six Y eight nine"), (None, "test", None, None, None, base),
    ]
    got = found(spark, rows)
    assert set(got) == {(2, 1), (5, 1), (8, 1)}
    assert got[(2, 1)].edits == 0 and got[(2, 1)].eval_overlap == 1.0
    assert got[(8, 1)].edits == 1 and abs(got[(8, 1)].eval_overlap - 7 / 9) < 1e-9  # the changed word lies in a chunk of two


def test_path_cases(spark):
    rows = [
        (1, "train", "D:\\lab\\a.wav", None, None, None), (2, "test", "/mnt/lab//A.wav ", None, None, None), (3, "test", "D:\\lab\\a.wav", 1.0, 2.0, None), (4, "train", "lab/a.wav", 1.0, 2.0, None),
        (5, "validation", None, 1.0, 2.0, None), (6, "train", None, 1.0, 2.0, None), (7, "test", "D:\\lab\\a.wav", 1.0, None, None), (8, "train", "D:\\lab\\a.wav", None, 1.0, None),
    ]
    assert set(found(spark, rows)) == {(2, 1), (3, 4)}


def test_copies_of_a_text_are_pairs_and_very_long_texts_work(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(i, "train" if i < 40 else "test", None, None, None, "a b c d e f g h i j") for i in range(60)]
    rows += [(100, "train", None, None, None, long), (101, "test", None, None, None, long.replace("w7 ", "x "))]
    got = found(spark, rows)
    assert len(got) == 40 * 20 + 1 and got[(101, 100)].edits == 1


def test_empty(spark):
    assert found(spark, []) == {}


def test_chunks_tile_the_records_and_are_cut_by_content():
    text = " ".join(f"word{i}" for i in range(200))
    c, (whole, tail, nothing) = chunks_of([text, "x " + text, ""], 7)
    assert c.length.sum() == 401 and c.begins[2] == c.begins[3] == len(c.digest)
    assert (whole & tail).total() >= whole.total() - 1


def test_report(spark):
    text = "one two three four five six seven eight nine ten"
    near_text = text.replace("ten", "eleven")
    rows = [
        (1, "train", "lab/a", None, None, text), (2, "train", "lab/a", None, None, near_text), (3, "test", "lab/a", None, None, text), (4, "train", "lab/b", None, None, text),
        (5, "test", "lab/c", None, None, None), (6, "validation", "lab/a", None, None, "other"), (7, "validation", None, None, None, near_text), (8, "validation", None, None, None, near_text), (9, "test", "lab/d", None, None, "no pair here"),
    ]
    pairs = found(spark, rows)
    got = {r.split_name: (r.pairs, r.rows) for r in overlap.overlap_report(table(spark, rows), roots(spark)).collect()}
    split = {r[0]: r[1] for r in rows}
    assert got == {s: (sum(split[e] == s for e, _ in pairs), len({e for e, _ in pairs if split[e] == s})) for s in ("test", "validation")}
    assert overlap.overlap_report(table(spark, []), roots(spark)).collect() == []
