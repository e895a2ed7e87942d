"""Folds whose state no window frame expresses, one document at a time.

Each runs on a sorted array of one document's rows (a recording, a folder), or of a stretch of them between places where
the state starts anew, inside Arrow batches; no document waits for another, and only the columns that the fold needs are
gathered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoolwright.functions.text import USELESS_TEXTS
from spoolwright.operators.order import Laid


def folded(df: DataFrame, key: str, order: list[str], columns: dict[str, Column], fold: Callable[[list[dict]], list[dict]], result: str, breaks: Callable[[Callable[[Column], Column]], Column] | None = None, most: int = 10_000) -> DataFrame:
    """key, part and the fold's rows (DDL `result`) of each document.

    breaks: given a function that looks one row back, a condition under which the fold's state starts anew anyway. A
    document is then gathered stretch by stretch, however many rows it has, and part counts within a stretch. Without
    breaks a document is folded `most` rows at a time, each such stretch by itself, and its number (stretch, from 0) is
    given out too.
    """
    laid = Laid(df, key, *order)
    if breaks is not None:
        asked: list[Column] = []

        def back(c: Column) -> Column:
            asked.append(c)
            return F.col(f"__b{len(asked) - 1}")

        fresh = breaks(back)
        laid = laid.neighbour(**{f"__b{i}": c for i, c in enumerate(asked)}).islands(fresh, "stretch")
    else:
        laid = laid.summed_before(__n=F.lit(1))
        laid.df = laid.df.withColumn("stretch", F.floor(F.col("__n") / most))
    rows = laid.rows().select(F.col(key).alias("__key"), "stretch", F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *[c.alias(n) for n, c in columns.items()]).alias("r"))
    arrays = rows.groupBy("__key", "stretch").agg(F.sort_array(F.collect_list("r")).alias("rows"))
    kind = df.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = [fold([r.asDict() if hasattr(r, "asDict") else dict(r) for r in rows]) for rows in f["rows"]]
            yield pd.DataFrame({"__key": f["__key"], "stretch": f["stretch"], "out": out})

    made = arrays.mapInPandas(run, f"__key {kind}, stretch long, out array<struct<{result}>>")
    named = ["stretch"] if breaks is None else []
    return made.select(F.col("__key").alias(key), *named, F.posexplode("out").alias("part", "o")).select(key, *named, "part", "o.*")


def words_to_segments(words: list[dict], gap: float, longest: float) -> list[dict]:
    """Joins words (word, start, end in order) to segments; a gap of at least `gap` or a length of at least `longest` ends one."""
    out: list[dict] = []
    open_: list[dict] = []

    def close() -> None:
        if open_:
            out.append({"start": open_[0]["start"], "end": open_[-1]["end"], "text": " ".join(w["word"] for w in open_), "n": len(open_)})
            open_.clear()

    for w in words:
        if w["end"] is None or w["start"] is None or w["end"] <= w["start"]:
            continue
        if open_ and (w["start"] - open_[-1]["end"] >= gap or open_[-1]["end"] - open_[0]["start"] >= longest):
            close()
        open_.append(w)
    close()
    return out


def compression_ratio(text: str | None) -> float | None:
    """Bytes of a text by its bytes deflated, as recognisers report it; None for no text."""
    import zlib

    raw = (text or "").strip().encode()
    return len(raw) / len(zlib.compress(raw)) if raw else None


def chunks_of_segments(segments: list[dict], shortest: float, gap: float, longest: float, most_tokens: int | None = None) -> list[dict]:
    """Merges segments forward while the chunk is short, the pause small and the result not too long, in seconds and in tokens; the worst metrics count. A segment without tokens counts as none."""
    out: list[dict] = []
    worst = {"no_speech": max, "logprob": min, "ratio": max}
    for s in segments:
        if s["start"] is None or s["end"] is None or s["end"] <= s["start"] or (s["text"] or "").strip() in USELESS_TEXTS:
            continue
        last = out[-1] if out else None
        if last and last["end"] - last["start"] < shortest and s["start"] - last["end"] <= gap and s["end"] - last["start"] <= longest and (most_tokens is None or last["tokens"] + (s.get("tokens") or 0) <= most_tokens):
            last["end"] = max(last["end"], s["end"])
            last["text"] += " " + s["text"].strip()
            last["n"] += 1
            last["tokens"] += s.get("tokens") or 0
            for name, pick in worst.items():
                both = [x for x in (last.get(name), s.get(name)) if x is not None]
                last[name] = pick(both) if both else None
        else:
            out.append({"start": s["start"], "end": s["end"], "text": s["text"].strip(), "n": 1, "tokens": s.get("tokens") or 0, **{name: s.get(name) for name in worst}})
    return out


def greedy_packed(items: list[dict], most: float, gap: float = 0.0, count: int | None = None) -> list[dict]:
    """Bins of items (id, size) in order: a bin ends before its size with the gaps, or its count, would exceed the limit. A larger item is a bin of its own."""
    out: list[dict] = []
    used = n = bin_ = 0
    for i in items:
        more = i["size"] + (gap if n else 0)
        if n and (used + more > most or count is not None and n >= count):
            bin_, used, n, more = bin_ + 1, 0, 0, i["size"]
        out.append({"id": i["id"], "bin": bin_, "offset": float(used + (gap if n else 0))})
        used, n = used + more, n + 1
    return out


def least_loaded_packed(items: list[dict], most: float, count: int) -> list[dict]:
    """Largest first into the least loaded bin that has room under both limits, else a new bin."""
    import heapq

    out: list[dict] = []
    bins: list[tuple[float, int, int]] = []
    made = 0
    for i in sorted(items, key=lambda x: (-x["size"], x["id"])):
        aside = []
        while bins and (bins[0][0] + i["size"] > most or bins[0][2] >= count):
            if bins[0][0] + i["size"] > most and bins[0][2] < count:
                break  # the least loaded one has no room, so none has
            aside.append(heapq.heappop(bins))
        if bins and bins[0][0] + i["size"] <= most and bins[0][2] < count:
            load, at, n = heapq.heappop(bins)
        else:
            load, at, n, made = 0.0, made, 0, made + 1
        for b in aside:
            if b[2] < count:
                heapq.heappush(bins, b)
        heapq.heappush(bins, (load + i["size"], at, n + 1))
        out.append({"id": i["id"], "bin": at})
    return out
