"""Cutting oversized stretches of audio at natural boundaries, with overlap.

The boundaries inside a core are parsed into a tree: the core holds sentences (a segment whose text ends in closing
punctuation ends one), a sentence holds segments, a segment holds nothing. A node that fits into a piece is not opened.
An oversized one is: its children are packed first, and what they give is merged, sibling with sibling, as long as the
piece stays under the limit; so the tree is packed bottom-up, and cuts lie as high in it as they can. A task is
'natural' if the packed core has no piece over the limit. Otherwise the segments over it are cut in equal parts.

Times are whole microseconds inside, so float noise decides nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoolwright.functions.paths import file_key, root_pairs

#: A core counts as oversized when it is longer than the limit by more than this.
SLACK_US = 1000
#: Boundaries are looked up in bins of this length, or of a power of two of it, so that no core lies in more than MOST_BINS.
BIN_US = 30_000_000
MOST_BINS = 64
KINDS = ("core_end", "sentence", "segment", "hard")
HARD = 3
#: Fixed value: closing punctuation, with closing quotes or brackets after it.
SENTENCE_END = r"[.!?…。？！][\"'”’»)\]]*\s*$"


def micros(seconds: Column) -> Column:
    """Seconds as whole microseconds; null for null, NaN and infinite."""
    ok = seconds.isNotNull() & ~F.isnan(seconds) & (F.abs(seconds) < 1e12)
    return F.when(ok, F.round(seconds * 1_000_000).cast("long"))


def oversized(tasks: DataFrame, roots: list[tuple[str, str]]) -> DataFrame:
    """task_id, file, s, e, limit, overlap (microseconds) of the tasks that must be cut.

    Tasks with a null or NaN time or limit, core_end <= core_start or limit <= 0 are left out. A null, NaN or negative
    overlap counts as none. A null path is a file without boundaries.
    """
    overlap = F.greatest(F.coalesce(micros(F.col("overlap_sec")), F.lit(0)), F.lit(0))
    cols = tasks.select(
        "task_id", file_key(F.col("audio_path"), roots).alias("file"), micros(F.col("core_start")).alias("s"), micros(F.col("core_end")).alias("e"), micros(F.col("target_out_sec")).alias("limit"), overlap.alias("overlap")
    )
    return cols.where((F.col("limit") > 0) & (F.col("e") > F.col("s")) & (F.col("e") - F.col("s") > F.col("limit") + SLACK_US))


def boundaries(refs: DataFrame, roots: list[tuple[str, str]]) -> DataFrame:
    """file, at (microseconds), level (1 ends a sentence, 2 a segment): one row for each end of a valid segment, however often it is stored."""
    ok = F.col("end_sec").isNotNull() & ~F.isnan("end_sec") & (F.col("end_sec") > F.col("start_sec"))
    level = F.when(F.coalesce(F.col("text").rlike(SENTENCE_END), F.lit(False)), 1).otherwise(2)
    return refs.where(ok & F.col("audio_path").isNotNull()).select(file_key(F.col("audio_path"), roots).alias("file"), micros(F.col("end_sec")).alias("at"), level.alias("level")).groupBy("file", "at").agg(F.min("level").alias("level"))


def packed(start: int, end: int, limit: int, overlap: int, at: list[int], level: list[int]) -> tuple[bool, list[tuple[int, int, int]]]:
    """Whether all cuts are natural, and the pieces in order as (start, end, what the end is, as a place in KINDS).

    at, level: the boundaries strictly inside, in order. Each piece after the first starts `overlap` before the end of
    the one before it, but not before the core. An overlap that leaves less than SLACK_US of the limit, so that nothing
    could be told by pieces of it, is shortened to half of the limit; no task is natural with it.
    """
    marks, kinds = [start, *at, end], [0, *level, 0]
    deepest = max(level, default=0)

    def fits(a: int, b: int, over: int) -> bool:
        """The first piece has no overlap."""
        return b - a <= (limit if a == start else limit - over)

    def merged(parts: list[tuple[int, int, int]], over: int) -> list[tuple[int, int, int]]:
        out: list[tuple[int, int, int]] = []
        for part in parts:
            if out and fits(out[-1][0], part[1], over):
                out[-1] = (out[-1][0], part[1], part[2])
            else:
                out.append(part)
        return out

    def node(first: int, last: int, depth: int) -> list[tuple[int, int, int]]:
        """The parts that the subtree between two marks is packed into. One over the limit is a segment."""
        if last - first == 1 or fits(marks[first], marks[last], overlap):
            return [(marks[first], marks[last], kinds[last])]
        parts, begin = [], first
        for i in range(first + 1, last + 1):
            if i == last or kinds[i] <= depth + 1:
                parts += node(begin, i, min(depth + 1, deepest))
                begin = i
        return merged(parts, overlap)

    parts = node(0, len(marks) - 1, 0)
    natural = all(fits(a, b, overlap) for a, b, _ in parts)
    if not natural:
        if overlap > limit - SLACK_US:
            overlap = limit // 2
        room, opened = max(1, limit - overlap), []
        for a, b, kind in parts:
            size, space = b - a, limit if a == start else room
            n = 1 if size <= space else 1 - (space - size) // room
            space = -(-size // n) if size <= n * room else space  # equal parts, or a first one that makes use of having no overlap
            inner = [a + space + (size - space) * i // max(n - 1, 1) for i in range(n - 1)]
            opened += [(x, y, HARD) for x, y in zip([a, *inner], inner)] + [(inner[-1] if inner else a, b, kind)]
        parts = merged(opened, overlap)
    return natural, [(a if a == start else max(start, a - overlap), b, kind) for a, b, kind in parts]


def cut_plans(tasks: DataFrame, refs: DataFrame, roots: DataFrame) -> DataFrame:
    """task_id, cut_kind ('natural' or 'forced'), pieces (array of start_sec, end_sec, cut_at) of every task that must be cut.

    Tasks that agree in file, times, limit and overlap are planned once. Boundaries are looked up in bins of time, so
    neither a file with very many segments nor one with very many tasks meets in one place; the boundaries of one core
    do, as its pieces follow from one another. Empty tables give no rows.
    """
    pairs = root_pairs(roots)
    need = oversized(tasks, pairs)
    same = ["file", "s", "e", "limit", "overlap"]
    plans = need.groupBy(*same).agg(F.min("task_id").alias("plan"))
    # a longer core has wider bins; there are at most 60 widths
    wide = F.greatest(F.ceil(F.log2((F.col("e") - F.col("s")) / F.lit(float(BIN_US * (MOST_BINS - 1))))), F.lit(0)).cast("int")
    sized = plans.where("file is not null").withColumn("wide", wide)
    widths = sorted(r[0] for r in sized.select("wide").distinct().collect())
    bin_of = lambda c: F.floor(F.col(c) / (F.lit(BIN_US) * F.expr("shiftleft(1L, wide)")))
    bins = sized.withColumn("bin", F.explode(F.sequence(bin_of("s"), bin_of("e"))))
    ends = boundaries(refs, pairs).withColumn("wide", F.explode(F.lit(widths).cast("array<int>"))).withColumn("bin", bin_of("at"))
    inside = bins.join(ends, ["file", "wide", "bin"]).where("at > s and at < e").groupBy("plan").agg(F.sort_array(F.collect_list(F.struct("at", "level"))).alias("ends"))
    whole = plans.select("plan", "s", "e", "limit", "overlap").join(inside, "plan", "left")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, first, last, cut_at, size = [], [], [], [], [0]
            columns = [batch.column(i).to_pylist() for i in range(1, 5)]
            inner = [[[]] * batch.num_rows if (c := batch.column(i)).null_count == len(c) else c.to_pylist() for i in (5, 6)]
            for s, e, limit, overlap, at, level in zip(*columns, *inner, strict=True):
                natural, parts = packed(s, e, limit, overlap, at or [], level or [])
                kinds.append("natural" if natural else "forced")
                for a, b, kind in parts:
                    first.append(a)
                    last.append(b)
                    cut_at.append(kind)
                size.append(len(first))
            names = pa.array(KINDS).take(pa.array(cut_at, pa.int32()))
            rows = pa.StructArray.from_arrays([pa.array(np.array(first, float) / 1e6), pa.array(np.array(last, float) / 1e6), names], ["start_sec", "end_sec", "cut_at"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kinds, pa.string()), pa.ListArray.from_arrays(pa.array(size, pa.int32()), rows)], names=["plan", "cut_kind", "pieces"])

    made = whole.select("plan", "s", "e", "limit", "overlap", "ends.at", "ends.level").mapInArrow(pack, "plan long, cut_kind string, pieces array<struct<start_sec:double,end_sec:double,cut_at:string>>")
    keyed = plans.withColumnsRenamed({c: f"{c}__p" for c in same})
    members = need.join(keyed, [need[c].eqNullSafe(keyed[f"{c}__p"]) if c == "file" else need[c] == keyed[f"{c}__p"] for c in same]).select("task_id", "plan")
    return members.join(made, "plan").select("task_id", "cut_kind", "pieces")


def pieces(plans: DataFrame) -> DataFrame:
    """task_id, piece (from 0), start_sec, end_sec, cut_at ('sentence', 'segment', 'hard' or 'core_end')."""
    return plans.select("task_id", F.posexplode("pieces").alias("piece", "p")).select("task_id", "piece", "p.start_sec", "p.end_sec", "p.cut_at")
