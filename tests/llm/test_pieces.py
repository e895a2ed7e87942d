import random

import pytest

from spoolwright.llm import pieces

S = 1_000_000


def feasible(start, end, limit, overlap, ends):
    """By trying all ways."""
    marks = [*ends, end]
    todo, seen = [start], {start}
    while todo:
        p = todo.pop()
        for x in marks:
            if x > p and x - (p if p == start else p - overlap) <= limit and x not in seen:
                seen.add(x)
                todo.append(x)
    return end in seen


def test_kind_and_pieces_against_all_ways():
    rng = random.Random(1)
    natural = 0
    for _ in range(3000):
        end = rng.randint(11, 120)
        limit, overlap = rng.randint(1, 10), rng.choice([0, 0, 1, 2, 3, 9])
        ends = sorted(rng.sample(range(1, end), min(end - 1, rng.randint(0, 40))))
        levels = [rng.randint(1, 2) for _ in ends]
        got, out = pieces.packed(0, end, limit, overlap, ends, levels)
        ok = feasible(0, end, limit, overlap, ends)
        natural += ok
        assert got == ok
        assert out[0][0] == 0 and out[-1][1] == end and all(b - a <= limit for a, b, _ in out)
        assert all(x[1] < y[1] for x, y in zip(out, out[1:]))
        kept = overlap if ok or overlap < limit else limit // 2
        assert all(y[0] == max(0, x[1] - kept) for x, y in zip(out, out[1:]))
        assert {b for _, b, k in out if k in (1, 2)} <= set(ends) and all(levels[ends.index(b)] == k for _, b, k in out if k in (1, 2))
        assert [k for *_, k in out].count(0) == 1 and out[-1][2] == 0
        if ok:
            assert all(k != pieces.HARD for *_, k in out)
            # two neighbours never fit into one piece
            own = [0, *[b for _, b, _ in out]]
            assert all(own[i + 2] - own[i] > (limit if i == 0 else limit - overlap) for i in range(len(out) - 1))
    assert 300 < natural < 2700


@pytest.fixture(autouse=True)
def whole_steps(monkeypatch, request):
    """In the plain tests of packed() a step is one."""
    if "spark" not in request.fixturenames:
        monkeypatch.setattr(pieces, "SLACK_US", 1)


def test_sentences_are_preferred():
    at, level = [3 * S, 6 * S, 8 * S, 11 * S], [2, 1, 2, 1]
    natural, out = pieces.packed(0, 15 * S, 8 * S, 0, at, level)
    assert natural and [(b // S, pieces.KINDS[k]) for _, b, k in out] == [(6, "sentence"), (11, "sentence"), (15, "core_end")]
    # only the oversized sentence is opened
    natural, out = pieces.packed(0, 15 * S, 5 * S, 0, [2 * S, 4 * S, 9 * S, 10 * S], [2, 1, 2, 1])
    assert natural and [(b // S, pieces.KINDS[k]) for _, b, k in out] == [(4, "sentence"), (9, "segment"), (10, "sentence"), (15, "core_end")]


def test_an_overlap_above_half_of_the_limit_is_kept():
    for overlap in (6, 8, 9):
        natural, out = pieces.packed(0, 100, 10, overlap, [], [])
        assert not natural and all(y[0] == max(0, x[1] - overlap) and y[1] - y[0] <= 10 for x, y in zip(out, out[1:]))
    natural, out = pieces.packed(0, 20, 10, 7, [9, 12, 15, 18], [2] * 4)
    assert natural and [b for _, b, _ in out] == [9, 12, 15, 18, 20]


def test_table_cases(spark):
    nan = float("nan")
    tasks = spark.createDataFrame(
        [
            (1, "D:\\lab\\r.wav", 0.0, 20.0, 10.0, 0.0, "x"), (2, "LAB/r.wav", 0.0, 20.0, 10.0, 0.0, "x"), (3, "lab/r.wav", 0.0, 10.001, 10.0, 0.0, "x"), (4, "lab/r.wav", 0.0, 20.0, nan, 0.0, "x"), (5, "lab/r.wav", 0.0, 20.0, 0.0, 0.0, "x"),
            (6, "lab/r.wav", 20.0, 0.0, 5.0, 0.0, "x"), (7, "lab/r.wav", None, 20.0, 5.0, 0.0, "x"), (8, None, 0.0, 20.0, 15.0, None, "x"), (9, "lab/none.wav", 0.0, 20.0, 15.0, nan, "x"), (10, "lab/r.wav", 0.0, 20.0, 10.0, 1.0, "x"), (11, "lab/r.wav", 0.0, 20.0, 4.0, 4.0, "x"),
        ],
        "task_id long, audio_path string, core_start double, core_end double, target_out_sec double, overlap_sec double, at string",
    )
    refs = spark.createDataFrame(
        [("/mnt/lab/r.wav", 0.0, 10.0, "A."), ("/mnt/lab/r.wav", 0.0, 10.0, None), ("lab/r.wav", 5.0, nan, "b"), ("lab/r.wav", 9.0, 8.0, "c"), ("lab/r.wav", 1.0, None, ""), (None, 0.0, 5.0, "d")],
        "audio_path string, start_sec double, end_sec double, text string",
    )
    roots = spark.createDataFrame([("D:\\lab", "lab"), ("/mnt/lab", "lab")], "root_path string, canonical_root string")
    plans = pieces.cut_plans(tasks, refs, roots)
    assert {r.task_id: r.cut_kind for r in plans.collect()} == {1: "natural", 2: "natural", 8: "forced", 9: "forced", 10: "forced", 11: "forced"}
    got = [(r.task_id, r.piece, r.start_sec, r.end_sec, r.cut_at) for r in pieces.pieces(plans).where("task_id in (1, 8)").orderBy("task_id", "piece").collect()]
    assert got == [(1, 0, 0.0, 10.0, "sentence"), (1, 1, 10.0, 20.0, "core_end"), (8, 0, 0.0, 10.0, "hard"), (8, 1, 10.0, 20.0, "core_end")]
    # a core as long as times can be lies in few bins
    vast = spark.createDataFrame([(20, "lab/r.wav", 0.0, 9e11, 4.5e11, 0.0)], "task_id long, audio_path string, core_start double, core_end double, target_out_sec double, overlap_sec double")
    assert [(p.end_sec, p.cut_at) for r in pieces.cut_plans(vast, refs, roots).collect() for p in r.pieces] == [(10.0, "sentence"), (450000000005.0, "hard"), (9e11, "core_end")]
    assert pieces.cut_plans(tasks.limit(0), refs, roots).count() == 0 and pieces.cut_plans(tasks, refs.limit(0), roots).count() == 6
