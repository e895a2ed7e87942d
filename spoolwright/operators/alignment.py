"""Aligning a corrected text to timed segments, and grouping vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vectors of one group that are clustered in one task, with the distances between all held at once; larger groups are clustered in rounds.
MAX_CLUSTERED = 5000

#: Clusters of a block, where the distances between two blocks are held at once.
BLOCK = 2048


#: Cells of the distance table that are held at once; larger stretches are halved first.
MAX_CELLS = 1 << 22


def _last_row(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of all of x to every beginning of y."""
    step = np.arange(len(y) + 1, dtype=np.int32)
    row = step.copy()
    for i, w in enumerate(x, 1):
        cur = np.empty_like(row)
        cur[0] = i
        np.minimum(row[1:] + 1, row[:-1] + (y != w), out=cur[1:])
        row = np.minimum.accumulate(cur - step) + step
    return row


def _aligned(x: np.ndarray, y: np.ndarray, shift: int, out: np.ndarray, at: int) -> None:
    """Fills out[at:at + len(x)] for a stretch without anchors."""
    n, m = len(x), len(y)
    if n > 1 and (n + 1) * (m + 1) > MAX_CELLS:
        half = n // 2
        best = int(np.argmin(_last_row(x[:half], y) + _last_row(x[half:][::-1], y[::-1])[::-1]))
        _aligned(x[:half], y[:best], shift, out, at)
        _aligned(x[half:], y[best:], shift + best, out, at + half)
        return
    step = np.arange(m + 1, dtype=np.int32)
    table = [step.copy()]
    for i in range(1, n + 1):
        cur = np.empty(m + 1, np.int32)
        cur[0] = i
        np.minimum(table[-1][1:] + 1, table[-1][:-1] + (y != x[i - 1]), out=cur[1:])
        table.append(np.minimum.accumulate(cur - step) + step)
    j = m
    for i in range(n, 0, -1):
        diagonal = lambda: j and table[i][j] == table[i - 1][j - 1] + (x[i - 1] != y[j - 1])  # noqa: B023, E731
        while j and not diagonal() and table[i][j] == table[i][j - 1] + 1:
            j -= 1
        j -= bool(diagonal())
        out[at + i - 1] = shift + j


def _anchors(x: np.ndarray, y: np.ndarray, n: int = 3) -> list[tuple[int, int]]:
    """Places of runs of n words that occur once on both sides, in the longest order that both share."""
    from bisect import bisect_left

    def once(s: np.ndarray) -> dict[tuple, int]:
        seen: dict[tuple, int] = {}
        for i in range(len(s) - n + 1):
            k = tuple(s[i : i + n].tolist())
            seen[k] = -1 if k in seen else i
        return seen

    right = once(y)
    both = sorted((i, right[k]) for k, i in once(x).items() if i >= 0 and right.get(k, -1) >= 0)
    tails: list[int] = []
    where: list[int] = []
    before = [-1] * len(both)
    for k, (_, j) in enumerate(both):
        p = bisect_left(tails, j)
        before[k] = where[p - 1] if p else -1
        if p == len(tails):
            tails.append(j)
            where.append(k)
        else:
            tails[p], where[p] = j, k
    chain, k = [], where[-1] if where else -1
    while k >= 0:
        chain.append(both[k])
        k = before[k]
    return chain[::-1]


def word_alignment(a: list[str], b: list[str]) -> list[int]:
    """For each word of a the number of words of b that lie before it in an alignment of few edits, and len(b) at the end.

    Words around which both texts have the same unique run of three are fixed first; the stretches between are aligned
    at the least cost, in memory that is linear in their length where they are long.
    """
    number = {w: i for i, w in enumerate(dict.fromkeys(a + b))}
    x, y = (np.array([number[w] for w in s], np.int64) for s in (a, b))
    out = np.zeros(len(a) + 1, np.int64)
    i = j = 0
    for p, q in [*_anchors(x, y), (len(a), len(b))]:
        if p < i or q < j:  # inside the run of the anchor before
            continue
        _aligned(x[i:p], y[j:q], j, out, i)
        if p < len(a):
            out[p] = q
        i, j = p + 1, q + 1
    out[len(a)] = len(b)
    return out.tolist()


def sliced_text(segments: list[str], corrected: str) -> tuple[list[str], str]:
    """The corrected text cut along the segments, and by which way: 'count' where the number of words is the same, else 'words'."""
    words, parts = corrected.split(), [(s or "").split() for s in segments]
    sizes = [len(p) for p in parts]
    if sum(sizes) == len(words):
        ends = np.cumsum(sizes).tolist()
        way = "count"
    else:
        at = word_alignment([w.lower() for p in parts for w in p], [w.lower() for w in words])
        ends = [at[e] for e in np.cumsum(sizes).tolist()]
        if ends:
            ends[-1] = len(words)
        way = "words"
    begins = [0, *ends][: len(ends)]
    return [" ".join(words[s:e]) for s, e in zip(begins, ends, strict=True)], way


def corrected_segments(segments: DataFrame, key: str, pos: str, text: str, corrections: DataFrame, corrected: str) -> DataFrame:
    """key, pos, text, way: each document's segments with their part of its corrected text. Documents without a correction are left out; one document is aligned at a time."""
    lists = segments.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col(pos).alias("p"), F.coalesce(F.col(text), F.lit("")).alias("t")))).alias("s"))
    both = lists.join(corrections.where(F.col(corrected).isNotNull()).select(key, F.col(corrected).alias("c")), key)
    kinds = f"{key} {segments.schema[key].dataType.simpleString()}, out array<struct<pos:{segments.schema[pos].dataType.simpleString()},text:string>>, way string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            made = [([x["p"] for x in s], *sliced_text([x["t"] for x in s], c)) for s, c in zip(f["s"], f["c"], strict=True)]
            yield pd.DataFrame({key: f[key], "out": [[{"pos": p, "text": t} for p, t in zip(ps, ts, strict=True)] for ps, ts, _ in made], "way": [w for *_, w in made]})

    return both.mapInPandas(run, kinds).select(key, F.explode("out").alias("o"), "way").select(key, F.col("o.pos").alias(pos), F.col("o.text").alias(text), "way")


def _linked(far: np.ndarray, size: np.ndarray, threshold: float) -> np.ndarray:
    """For each place of a symmetric distance table the first place of its cluster; far and size are used up. The closest pair is found from the least distance of each row."""
    n = len(far)
    label, rows = np.arange(n), np.arange(n)
    near = far.argmin(1) if n else rows
    least = far[rows, near]
    for _ in range(n - 1):
        i = int(np.argmin(least))
        if not least[i] <= threshold:
            break
        i, j = sorted((i, int(near[i])))
        row = (far[i] * size[i] + far[j] * size[j]) / (size[i] + size[j])
        far[i], far[:, i] = row, row
        far[i, i] = np.inf
        far[j], far[:, j] = np.inf, np.inf
        size[i] += size[j]
        label[label == j] = i
        stale = (near == i) | (near == j)
        stale[[i, j]] = True
        closer = ~stale & ((far[:, i] < least) | (far[:, i] == least) & (i < near))
        near[closer], least[closer] = i, far[closer, i]
        again = np.flatnonzero(stale)
        near[again] = far[again].argmin(1)
        least[again] = far[again, near[again]]
    return label


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def _linked_means(means: np.ndarray, size: np.ndarray, threshold: float) -> np.ndarray:
    """_linked for clusters by the mean of their unit vectors: the mean cosine distance of two clusters is 1 less the product of their means."""
    far = means @ means.T
    np.subtract(1, far, out=far)
    np.fill_diagonal(far, np.inf)
    return _linked(far, size, threshold)


def average_linkage(vectors: np.ndarray, threshold: float) -> np.ndarray:
    """Cluster of each vector: the closest two clusters by mean cosine distance are joined while they are within the threshold. All distances are held at once; clustered() has no such bound."""
    if len(vectors) > MAX_CLUSTERED:
        raise ValueError(f"more than {MAX_CLUSTERED} vectors in one table of distances; clustered() takes larger groups")
    return np.unique(_linked_means(_unit(vectors), np.ones(len(vectors)), threshold), return_inverse=True)[1]


def _nearest(threshold: float):
    """Nearest clusters of two blocks within the threshold, both ways from one table, so that the distance of a pair is the same number on both sides."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        p, q = int(frame["p"].iloc[0]), int(frame["q"].iloc[0])
        left, right = frame[frame["b"] == p], frame[frame["b"] == q]
        if not len(left) or not len(right):
            return pd.DataFrame({"id": np.zeros(0, np.int64), "near": np.zeros(0, np.int64), "d": np.zeros(0)})
        x, y = (np.stack(f["s"].to_numpy()) / f["n"].to_numpy()[:, None] for f in (left, right))
        far = 1 - x @ y.T
        if p == q:
            far = np.minimum(far, far.T)
            np.fill_diagonal(far, np.inf)
        far[~(far <= threshold)] = np.inf
        a, b = left["id"].to_numpy(), right["id"].to_numpy()
        at = far.argmin(1)
        out = [pd.DataFrame({"id": a, "near": b[at], "d": far[np.arange(len(a)), at]})]
        if p != q:
            at = far.argmin(0)
            out.append(pd.DataFrame({"id": b, "near": a[at], "d": far[at, np.arange(len(b))]}))
        found = pd.concat(out)
        return found[np.isfinite(found["d"])]

    return run


def _clustered_in_rounds(rows: DataFrame, group: str, key: str, vector: str, threshold: float) -> DataFrame:
    """clustered() for groups of any size: in each round all pairs of clusters that are nearest to each other are joined.

    Average linkage never brings a joined pair closer to a third cluster than its nearer half was, so such pairs are
    joined by the plain method too, and a cluster without a neighbour within the threshold is final. Only the sum and the
    size of a cluster are kept; distances are worked out in blocks, and a group whose open clusters are no more than
    MAX_CLUSTERED is finished in one task. Where distances are exactly equal another of them may be joined first.
    """
    from spoolwright.lineage import cut
    from spoolwright.operators.order import ranked
    from spoolwright.operators.vectors import norm

    named = rows.select(F.col(group).alias("__group"), F.col(key).alias("__key"), F.col(vector).alias("v"))
    laid = cut(ranked(named, "__group", "__key", name="id"), "cluster-rows")
    first = laid.groupBy(F.col("__group").alias("__same")).agg(F.min("id").alias("g"))
    placed = laid.join(first, F.col("__group").eqNullSafe(F.col("__same"))).drop("__same")

    def start(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                yield pd.DataFrame({"g": f["g"], "id": f["id"], "n": f["m"].astype(float), "s": list(_unit(np.stack(f["v"].map(lambda v: np.asarray(v, float)))) * f["m"].to_numpy(float)[:, None])})

    kinds = "g long, id long, n double, s array<double>"
    # equal vectors are one cluster from the start: they are at distance 0, and as ties they would cost a round each
    length = norm(F.col("v"))
    alone = F.when((length > 0) & ~F.isnan(length) & F.lit(threshold >= 0), F.lit(-1).cast("long")).otherwise(F.col("id"))
    placed = placed.withColumn("alone", alone)
    equal = cut(placed.groupBy("g", "v", "alone").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("m")), "cluster-equal")
    live = cut(equal.select("g", F.col("first").alias("id"), "m", "v").mapInPandas(start, kinds), "clusters")
    members = cut(placed.join(equal, ["g", "v", "alone"]).select("g", "__group", "__key", F.col("first").alias("id")), "cluster-members")
    while True:
        counts = live.groupBy("g").agg(F.count(F.lit(1)).alias("m"))
        if counts.where(F.col("m") > MAX_CLUSTERED).isEmpty():
            break
        sized = live.join(counts, "g")
        busy = sized.where(F.col("m") > MAX_CLUSTERED).withColumn("k", F.ceil(F.col("m") / BLOCK))
        dealt = busy.withColumn("b", F.pmod(F.xxhash64("id"), F.col("k"))).withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
        paired = dealt.select("g", F.least("b", "x").alias("p"), F.greatest("b", "x").alias("q"), "b", "id", "n", "s")
        found = paired.groupBy("g", "p", "q").applyInPandas(_nearest(threshold), "id long, near long, d double")
        best = cut(found.groupBy("id").agg(F.min(F.struct("d", "near"))["near"].alias("near")), "cluster-nearest")
        other = best.select(F.col("id").alias("near"), F.col("near").alias("back"))
        pairs = cut(best.join(other, "near").where("back = id and id < near").select(F.col("near").alias("id"), F.col("id").alias("into")), "cluster-pairs")
        moved = busy.select("g", "id", "n", "s").join(best.select("id"), "id").join(pairs, "id", "left")
        sums = moved.groupBy("g", F.coalesce("into", "id").alias("c")).agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("id", "s"))).alias("t"))
        both = F.when(F.size("t") == 2, F.zip_with(F.col("t")[0]["s"], F.get("t", F.lit(1))["s"], lambda x, y: x + y)).otherwise(F.col("t")[0]["s"])
        live = cut(sums.select("g", F.col("c").alias("id"), "n", both.alias("s")).unionByName(sized.where(F.col("m") <= MAX_CLUSTERED).select("g", "id", "n", "s")), "clusters")
        members = cut(members.join(pairs, "id", "left").select("g", "__group", "__key", F.coalesce("into", "id").alias("id")), "cluster-members")

    def finish(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        size, ids = frame["n"].to_numpy(float).copy(), frame["id"].to_numpy()
        return pd.DataFrame({"id": ids, "root": ids[_linked_means(np.stack(frame["s"].to_numpy()) / size[:, None], size, threshold)]})

    roots = live.groupBy("g").applyInPandas(finish, "id long, root long")
    final = cut(members.join(roots, "id", "left").select("g", "__group", "__key", F.coalesce("root", "id").alias("root")), "cluster-roots")
    numbered = ranked(final.select("g", "root").distinct(), "g", "root")
    numbered = numbered.join(numbered.groupBy("g").agg(F.min("pos").alias("least")), "g").select("root", (F.col("pos") - F.col("least")).cast("int").alias("cluster"))
    return final.join(numbered, "root").select(F.col("__group").alias(group), F.col("__key").alias(key), "cluster")


def clustered(df: DataFrame, group: str, key: str, vector: str, threshold: float) -> DataFrame:
    """group, key, cluster: average-linkage clusters within each group (a recording's speakers). A group of at most MAX_CLUSTERED is one task; larger ones are clustered in rounds over blocks, to the same clusters."""
    kinds = f"{group} {df.schema[group].dataType.simpleString()}, {key} {df.schema[key].dataType.simpleString()}, cluster int"

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(key)
        return pd.DataFrame({group: frame[group], key: frame[key], "cluster": average_linkage(np.stack(frame[vector].map(lambda v: np.asarray(v, float))), threshold).astype(np.int32)})

    rows = df.where(F.col(vector).isNotNull()).select(group, key, vector)
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("__n"))
    large = sizes.where(F.col("__n") > MAX_CLUSTERED).select(F.col(group).alias("__group"))
    if large.isEmpty():
        return rows.groupBy(group).applyInPandas(run, kinds)
    same = F.col(group).eqNullSafe(F.col("__group"))
    return rows.join(large, same, "left_anti").groupBy(group).applyInPandas(run, kinds).unionByName(_clustered_in_rounds(rows.join(large, same, "left_semi"), group, key, vector, threshold))


def global_ids(clusters: DataFrame, seconds: DataFrame, group: str, key: str, amount: str) -> DataFrame:
    """group, cluster, seconds, global_id: clusters of all groups by their total, largest first, as G00, G01 and so on."""
    from spoolwright.operators.order import ranked

    totals = clusters.join(seconds.select(key, amount), key).groupBy(group, "cluster").agg(F.round(F.sum(amount), 3).alias("seconds"))
    placed = ranked(totals, F.desc("seconds"), group, "cluster")
    return placed.select(group, "cluster", "seconds", F.format_string("G%02d", "pos").alias("global_id"))
