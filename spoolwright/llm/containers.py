"""Filling containers of fixed capacity with documents.

Hierarchical residual packing: every task packs its items best-fit, the largest first; containers that are nearly full
are done; the underfull ones go on, as items of their own, into a round with fewer tasks, and so on until one task has
the rest or a round no longer helps. Only container ids and fills are shuffled, and no task gets more than PER_TASK of
them. Where a document lies follows from the written parent of each container, round by round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoolwright.lineage import cut

CAPACITY = 2048
#: A container is done when so much of it is filled.
NEARLY_FULL = 0.995
PER_TASK = 200_000
#: A round that merges away less than this part of the underfull containers is the last one.
LEAST_GAIN = 0.02


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container (from 0) of each item, largest first, each into the fullest container that has room.

    Items of size 0 are dealt out, at most `capacity` to a container.
    """
    order = np.argsort(-sizes, kind="stable")
    out = np.zeros(len(sizes), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r: a container with r left
    made = 0
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        if size <= 0:
            break
        fitting = open_rooms >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            at = room[left].pop()
            if not room[left]:
                open_rooms &= ~(1 << left)
        else:
            left, at = capacity, made
            made += 1
        out[i] = at
        left -= size
        if left:
            room[left].append(at)
            open_rooms |= 1 << left
    nothing = np.flatnonzero(sizes <= 0)
    out[nothing] = np.arange(len(nothing)) // capacity
    return out


def _round(items: DataFrame, capacity: int, full: float) -> DataFrame:
    """item, parent, at (tokens before it in the parent), nth (parts before it), fill, parts and done (of the parent). items: item, size, parts."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            table = pa.Table.from_batches(held)
            held.clear()
            item, size, parts = (table[c].to_numpy() for c in ("item", "size", "parts"))
            by_id = np.argsort(item, kind="stable")  # the order of arrival must not matter
            item, size, parts = item[by_id], size[by_id], parts[by_id]
            where = best_fit(size, capacity)
            order = np.lexsort((item, -size, where))
            item, size, parts, where = item[order], size[order], parts[order], where[order]
            first = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
            count = np.diff(np.r_[first, len(where)])
            spread = lambda x: np.repeat(x, count)
            before = lambda x: (np.cumsum(x) - x) - spread((np.cumsum(x) - x)[first])
            fill = np.add.reduceat(size, first)
            columns = {
                "item": item, "parent": spread(item[first]), "at": before(size), "nth": before(parts), "fill": spread(fill),
                "parts": spread(np.add.reduceat(parts, first)), "done": spread(fill >= full * capacity),
            }
            yield pa.RecordBatch.from_pydict(columns)

        held_rows = 0
        for batch in batches:
            if held_rows and held_rows + batch.num_rows > PER_TASK:
                yield from flush()
                held_rows = 0
            if batch.num_rows:
                held.append(batch)
                held_rows += batch.num_rows
        yield from flush()

    return items.select("item", "size", "parts").mapInArrow(pack, "item long, parent long, at long, nth long, fill long, parts long, done boolean")


def packed(counts: DataFrame, capacity: int = CAPACITY, full: float = NEARLY_FULL, per_task: int = PER_TASK) -> DataFrame:
    """doc_id, piece (from 0), pieces, tokens, container, first_token (of the piece in its container), position (its place among the container's parts).

    counts: doc_id, tokens. A document above the capacity is cut into full pieces and a rest, all others stay whole.
    Documents without tokens (null counts as none) lie in a container like others. Repeated rows are packed each by
    themselves. An empty table gives no rows. Items are numbered by partition and place, so another layout of the files
    may give other containers, as well filled.
    """
    tokens = F.coalesce(F.col("tokens"), F.lit(0)).cast("long")
    needed = F.greatest(F.ceil(tokens / capacity), F.lit(1)).cast("long")
    listed = counts.select("doc_id", tokens.alias("all"), needed.alias("pieces")).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    size = F.least(F.lit(capacity).cast("long"), F.col("all") - F.col("piece") * capacity)
    items = cut(listed.select("doc_id", "piece", "pieces", size.alias("size")).withColumn("item", F.monotonically_increasing_id()), "container-items")
    rest = items.where(F.col("size") < capacity).select("item", "size", F.lit(1).cast("long").alias("parts"))
    rounds: list[DataFrame] = []
    last = None
    while True:
        made = cut(_round(rest, capacity, full), "container-round")
        rounds.append(made)
        open_ = made.where("not done").select(F.col("parent").alias("item"), F.col("fill").alias("size"), "parts").distinct()
        left = open_.count()
        if left <= 1 or last == "final" or (last is not None and left > (1 - LEAST_GAIN) * last):
            break
        tasks = -(-left // per_task)
        last = "final" if tasks == 1 else left
        rest = open_.repartition(tasks, F.xxhash64(F.lit(len(rounds)), "item"))
    lying = items.join(rounds[0].select("item", F.col("parent").alias("container"), F.col("at").alias("first_token"), F.col("nth").alias("position")), "item", "left").select(
        "doc_id", "piece", "pieces", F.col("size").alias("tokens"), F.coalesce("container", "item").alias("container"), F.coalesce("first_token", F.lit(0)).alias("first_token"), F.coalesce("position", F.lit(0)).alias("position")
    )
    for made in rounds[1:]:
        up = made.select(F.col("item").alias("container"), "parent", "at", "nth")
        lying = lying.join(up, "container", "left").select(
            "doc_id", "piece", "pieces", "tokens", F.coalesce("parent", "container").alias("container"), (F.col("first_token") + F.coalesce("at", F.lit(0))).alias("first_token"), (F.col("position") + F.coalesce("nth", F.lit(0))).alias("position")
        )
    return lying


def cut_documents(lying: DataFrame) -> DataFrame:
    """doc_id of the documents that had to be cut."""
    return lying.where("pieces > 1 and piece = 0").select("doc_id")


def fill_report(lying: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """containers, tokens, waste (unused part of the containers' room)."""
    total = lying.groupBy("container").agg(F.sum("tokens").alias("t")).agg(F.count(F.lit(1)).alias("containers"), F.coalesce(F.sum("t"), F.lit(0)).alias("tokens"))
    return total.select("containers", "tokens", F.round(1 - F.col("tokens") / F.greatest(F.col("containers") * capacity, F.lit(1)), 6).alias("waste"))
