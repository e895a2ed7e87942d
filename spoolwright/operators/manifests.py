"""Operators on manifests and transcripts: cut windows, rewritten paths, compared segments, conflicts, interleaving."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoolwright.functions.hashing import hash_order
from spoolwright.functions.text import asr_key, key_words
from spoolwright.operators.order import Laid, ranked


def centred_window(start: Column, end: Column, need: Column, total: Column) -> tuple[Column, Column]:
    """A window of `need` seconds around the middle of a core, moved to lie within 0..total; the whole file if that is shorter."""
    low = F.least(F.greatest((start + end) / 2 - need / 2, F.lit(0.0)), F.greatest(total - need, F.lit(0.0)))
    return low, F.least(low + need, total)


def padded_window(start: Column, end: Column, target: Column) -> tuple[Column, Column]:
    """A window of the target length that begins half of the padding before the core, never before 0, and never ends before the core does."""
    low = F.greatest(start - F.greatest(target - (end - start), F.lit(0.0)) / 2, F.lit(0.0))
    return low, F.greatest(low + target, end)


def rewritten_paths(rows: DataFrame, path: str, mapping: DataFrame, old: str, new: str) -> DataFrame:
    """The rows with the mapped path, the former one in <path>_original, and mapped (boolean). The mapping has one row for each old path."""
    m = mapping.select(F.col(old).alias(path), F.col(new).alias("__new"))
    joined = rows.join(m, path, "left").withColumn(f"{path}_original", F.col(path))
    return joined.withColumns({"mapped": F.col("__new").isNotNull(), path: F.coalesce("__new", path)}).drop("__new")


def matched_segments(left: DataFrame, right: DataFrame, doc: str, pos: str, ident: str) -> DataFrame:
    """doc, how ('position' where both sides of a document have as many segments, else 'id'), l_pos, r_pos: segments of two versions side by side; a side without a partner has null."""
    n = lambda d, name: d.groupBy(doc).agg(F.count(F.lit(1)).alias(name))
    sizes = n(left, "__l").join(n(right, "__r"), doc, "full_outer").select(doc, F.col("__l").eqNullSafe(F.col("__r")).alias("__same"))
    keyed = lambda d, name: d.join(sizes, doc).select(doc, "__same", F.when(F.col("__same"), F.col(pos)).otherwise(F.col(ident)).alias("__k"), F.col(pos).alias(name))
    a, b = keyed(left, "l_pos"), keyed(right, "r_pos")
    both = a.where("__k is not null").join(b.where("__k is not null"), [doc, "__same", "__k"], "full_outer").select(doc, "__same", "l_pos", "r_pos")
    none = F.lit(None).cast(left.schema[pos].dataType)
    alone = [d.where("__k is null").select(doc, "__same", *(["l_pos", none.alias("r_pos")] if c == "l_pos" else [none.alias("l_pos"), "r_pos"])) for d, c in ((a, "l_pos"), (b, "r_pos"))]
    return both.unionByName(alone[0]).unionByName(alone[1]).select(doc, F.when(F.col("__same"), "position").otherwise("id").alias("how"), "l_pos", "r_pos")


def shifted_segments(left: DataFrame, right: DataFrame, on: list[str], start: str, end: str, text: str, tolerance: float = 0.25) -> DataFrame:
    """The keys, both texts, where the times of two versions agree within the tolerance and their normal forms differ."""
    r = right.select(*on, F.col(start).alias("__s"), F.col(end).alias("__e"), F.col(text).alias("other"))
    near = (F.abs(F.col(start) - F.col("__s")) <= tolerance) & (F.abs(F.col(end) - F.col("__e")) <= tolerance)
    return left.join(r, on).where(near & ~asr_key(F.col(text)).eqNullSafe(asr_key(F.col("other")))).select(*on, text, "other")


def conflict_reasons(before: Column, after: Column) -> Column:
    """Why a corrected segment conflicts with its former text: became_empty, word_count_changed, word_tokens_changed."""
    a, b = key_words(F.coalesce(before, F.lit(""))), key_words(F.coalesce(after, F.lit("")))
    return F.array_compact(
        F.array(
            F.when((F.size(b) == 0) & (F.size(a) > 0), F.lit("became_empty")),
            F.when(F.size(a) != F.size(b), F.lit("word_count_changed")),
            F.when(F.array_join(a, " ") != F.array_join(b, " "), F.lit("word_tokens_changed")),
        )
    )


def interleaved(rows: DataFrame, is_first: Column, key: str, seed: str) -> DataFrame:
    """The rows with pos: both classes in hash order, laid into one another evenly in proportion to their sizes."""
    classes = rows.withColumns({"__c": F.coalesce(is_first, F.lit(False)), "__h": hash_order(seed, F.col(key))})
    sizes = {r["__c"]: r["n"] for r in classes.groupBy("__c").agg(F.count(F.lit(1)).alias("n")).collect()}
    placed = [ranked(classes.where(F.col("__c") == c), "__h", key, name="__r").withColumn("__at", (F.col("__r") + 0.5) / n) for c, n in sizes.items()]
    if not placed:
        return rows.withColumn("pos", F.lit(0).cast("long"))
    both = placed[0] if len(placed) == 1 else placed[0].unionByName(placed[1])
    return ranked(both, "__at", "__c", key).drop("__c", "__h", "__r", "__at")


def paired_events(events: DataFrame, key: str, at: str, kind: str, first: str, last: str) -> DataFrame:
    """key, start, end: each `first` event with the next `last` event of its key at or after it; without one it is left out."""
    marked = events.where(F.col(kind).isin(first, last)).select(key, F.col(at).alias("start"), F.when(F.col(kind) == first, 0).otherwise(1).alias("__k"))
    # looking ahead is looking back from the end: the least of the later ends is the nearest
    after = F.when(F.col("__k") == 1, F.col("start"))
    rows = Laid(marked, key, F.desc("start"), F.desc("__k")).least_before(end=after).rows()
    return rows.where("__k = 0 and end is not null").select(key, "start", "end")


def argument_differences(a: Column, b: Column, ignored: list[str]) -> Column:
    """Map of the names on which two argument maps differ, as 'old -> new'; a missing value is shown as null."""
    none = F.create_map().cast("map<string,string>")
    pairs = F.map_zip_with(F.coalesce(a, none), F.coalesce(b, none), lambda _, x, y: F.when(~x.eqNullSafe(y), F.concat(F.coalesce(x, F.lit("null")), F.lit(" -> "), F.coalesce(y, F.lit("null")))))
    return F.map_filter(pairs, lambda k, v: v.isNotNull() & ~k.isin(ignored))


def json_texts(documents: DataFrame, key: str, json: str, names: tuple[str, ...] = ("text", "word", "transcript")) -> DataFrame:
    """key, path, text: every string under one of the names at any depth of a JSON document (walked in Arrow batches); unreadable documents give no rows."""
    kind = documents.schema[key].dataType.simpleString()

    def walk(node, path: str) -> Iterator[tuple[str, str]]:
        if isinstance(node, dict):
            for k, v in node.items():
                if k in names and isinstance(v, str):
                    yield f"{path}.{k}", v
                else:
                    yield from walk(v, f"{path}.{k}")
        elif isinstance(node, list):
            for i, v in enumerate(node):
                yield from walk(v, f"{path}[{i}]")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json as parser

        for f in frames:
            out = []
            for k, text in zip(f["key"], f["json"], strict=True):
                try:
                    out += [(k, p, t) for p, t in walk(parser.loads(text or "null"), "$")]
                except (ValueError, RecursionError):
                    continue
            yield pd.DataFrame(out, columns=["key", "path", "text"])

    return documents.select(F.col(key).alias("key"), F.col(json).alias("json")).mapInPandas(run, f"key {kind}, path string, text string").withColumnRenamed("key", key)


def first_rows_mean(df: DataFrame, group: str, order: list[str], n: int, vector: str, seconds: str) -> DataFrame:
    """group, seconds, centroid of the first n rows of each group (a cap on the rows of a label: the limit is the feature)."""
    from spoolwright.operators.vectors import centroid

    head = Laid(df, group, *order).summed_before(__r=F.lit(1)).rows().where(F.col("__r") < n)
    total = head.groupBy(group).agg(F.round(F.sum(seconds), 3).alias("seconds"))
    return total.join(centroid(head, group, vector).drop("n"), group)


def best_with_base(models: DataFrame, score: str, name: str, base: str, n: int) -> DataFrame:
    """The base model and the n best others, with place (0 for the base). Models are few."""
    w = Window.orderBy((F.col(name) != base).cast("int"), F.col(score).desc_nulls_last(), F.asc(name))
    return models.withColumn("place", F.row_number().over(w) - F.lit(1)).where((F.col("place") <= n) | (F.col(name) == base))
