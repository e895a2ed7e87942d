import numpy as np
from pyspark.sql import functions as F

from spoolwright import lineage
from spoolwright.functions import audio, runs
from spoolwright.operators import alignment


def test_ratio_of_a_mix():
    rng = np.random.default_rng(1)
    x, n = rng.normal(0, 0.05, 4000), rng.normal(0, 0.4, 900)
    added = audio.mixed_at(x, n, 10.0) - x
    assert abs(20 * np.log10(audio.rms(x) / audio.rms(added)) - 10) < 1e-6
    assert (audio.mixed_at(x, np.zeros(5), 10.0) == x).all() and len(audio.mixed_at(np.zeros(0), n, 1.0)) == 0


def test_gain_is_undone_by_the_peak():
    x = np.array([0.1, -0.2, 0.05])
    assert np.allclose(audio.gained(x, 6), audio.gained(x, -3)) and abs(np.abs(audio.gained(x, 6)).max() - audio.PEAK) < 1e-12


def test_reverb_of_an_impulse_is_the_response():
    x = np.zeros(64)
    x[0] = 1.0
    h = np.array([1.0, 0.5, 0.25])
    got = audio.reverberated(x, h, 1.0)
    assert np.allclose(got[:3] / got[0], h)


def test_runs_and_channels():
    x = np.r_[np.zeros(300), np.ones(600) * 0.5, np.zeros(300)]
    assert audio.energy_runs(x, 1000, 0.1, 0.03) == [(0.3, 0.9)]
    y = np.sin(np.arange(500) / 7)
    assert audio.stereo_plan(y, y) == "left" and audio.stereo_plan(y * 0, y) == "right" and audio.stereo_plan(y, np.cos(np.arange(500) / 3)) == "both"
    assert (np.abs(audio.ducked(y, y)) <= np.abs(y) + 1e-12).all()


def test_overlap_of_voices():
    out = audio.voices_mixed(np.ones(100) * 0.1, np.ones(50) * 0.1, 0.0, 0.5)
    assert len(out) == 100 and abs(out[75] / out[10] - 2) < 1e-6
    assert len(audio.voices_mixed(np.ones(100), np.ones(50), 0.0, 0.0)) == 150


def test_columns(spark):
    df = spark.createDataFrame([([0.5, -0.5], [0.1, 0.1]), (None, [0.1])], "x array<float>, n array<float>")
    got = [r[0] for r in df.select(audio.noise_mix("x", "n", F.lit(0.0))).collect()]
    assert len(got[0]) == 2 and got[1] is None


def test_slices():
    assert alignment.sliced_text(["a b", "c"], "A B C") == (["A B", "C"], "count")
    parts, way = alignment.sliced_text(["the cat sat", "on the mat", ""], "the big cat sat on the big mat")
    assert way == "words" and parts[0] == "the big cat sat" and parts[1] == "on the big mat" and parts[2] == ""
    assert alignment.sliced_text(["a"], "")[0] == [""] and alignment.sliced_text([], "")[0] == []


def test_clusters():
    v = np.array([[1, 0], [1, 0.1], [0, 1], [0.1, 1], [-1, 0]], float)
    assert alignment.average_linkage(v, 0.3).tolist() == [0, 0, 1, 1, 2]


def test_large_groups_have_the_same_clusters(spark, monkeypatch):
    rng = np.random.default_rng(3)
    mids = rng.normal(size=(9, 8))
    v = {g: (mids[rng.integers(0, 9, n)] + rng.normal(0, 0.6, (n, 8))) for g, n in (("a", 150), (None, 90), ("c", 12))}
    df = spark.createDataFrame([(g, i, x.tolist()) for g, m in v.items() for i, x in enumerate(m)], "g string, k int, v array<double>")
    for threshold in (0.15, 0.5, 3.0):
        want = {(g, i, int(c)) for g, m in v.items() for i, c in enumerate(alignment.average_linkage(m, threshold))}
        with monkeypatch.context() as small:
            small.setattr(alignment, "MAX_CLUSTERED", 20)
            small.setattr(alignment, "BLOCK", 32)
            assert {tuple(r) for r in alignment.clustered(df, "g", "k", "v", threshold).collect()} == want


def test_equal_vectors_of_a_large_group(spark, monkeypatch):
    rng = np.random.default_rng(7)
    m = np.concatenate([np.repeat(rng.normal(size=(3, 6)), 60, axis=0), rng.normal(size=(15, 6)), np.zeros((2, 6))])
    m = m[rng.permutation(len(m))]
    df = spark.createDataFrame([("a", i, x.tolist()) for i, x in enumerate(m)], "g string, k int, v array<double>")
    want = {("a", i, int(c)) for i, c in enumerate(alignment.average_linkage(m, 0.4))}
    monkeypatch.setattr(alignment, "MAX_CLUSTERED", 30)
    written = []
    monkeypatch.setattr("spoolwright.lineage.cut", lambda d, label, cut=lineage.cut: written.append(label) or cut(d, label))
    assert {tuple(r) for r in alignment.clustered(df, "g", "k", "v", 0.4).collect()} == want
    assert written.count("cluster-pairs") == 0


def test_closest_pairs_first():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(80, 5))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    parts = [[i] for i in range(80)]
    while True:
        d, i, j = min((1 - float(np.mean(u[p] @ u[q].T)), i, j) for i, p in enumerate(parts) for j, q in enumerate(parts) if i < j)
        if d > 0.6:
            break
        parts[i] += parts.pop(j)
    got = alignment.average_linkage(x, 0.6)
    assert {frozenset(p) for p in parts} == {frozenset(np.flatnonzero(got == c).tolist()) for c in set(got.tolist())}


def test_run_names(spark):
    name = runs.run_name(kind=F.lit("Evaluation"), stage=F.lit("19 c"), id=F.lit("x-1"))
    row = spark.range(1).select(name.alias("n"), runs.parsed(name).alias("p"), runs.parsed(F.lit("kind-a__stage-b")).alias("q"), runs.latest_epoch(F.array(F.lit("epoch_2"), F.lit("checkpoint-10"), F.lit("z"))).alias("e")).first()
    assert row.n.startswith("kind-eval__stage-19-c__base-na") and row.p.id == "x-1" and row.p.kind == "eval" and row.q is None and row.e == 10


def test_long_texts_are_aligned_in_little_memory(monkeypatch):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in rng.integers(0, 40, 4000)]
    kept = rng.random(4000) > 0.1
    at = alignment.word_alignment(words, [w for w, k in zip(words, kept) if k])
    want = np.r_[0, np.cumsum(kept)]
    assert np.abs(np.array(at) - want).max() <= 6 and (np.diff(at) >= 0).all()
    monkeypatch.setattr(alignment, "MAX_CELLS", 50)
    a, b = list("aabbaabbab"), list("abbaabbbab")
    small = alignment.word_alignment(a, b)
    assert (np.diff(small) >= 0).all() and small[-1] == len(b)
