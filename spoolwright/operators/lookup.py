"""Lookups by prioritised keys, anti and semi joins, corrections, upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_first_key(rows: DataFrame, keys: list[Column], table: DataFrame, key: str, value: str, row_id: str = "row_id") -> DataFrame:
    """row_id, value, hit: the value of the first of the row's keys that the table has, and which key it was (null: none).

    The table must have one row for each key. Null keys match nothing; a NaN value is a value.
    """
    tried = rows.select(row_id, F.posexplode(F.array(*keys)).alias("hit", "k")).where("k is not null")
    found = tried.join(table.select(F.col(key).alias("k"), F.struct(F.col(value).alias("v")).alias("s")), "k").groupBy(row_id).agg(F.min_by("s", "hit").alias("s"), F.min("hit").alias("hit"))
    return rows.select(row_id).join(found, row_id, "left").select(row_id, F.col("s.v").alias(value), "hit")


def last_wins(table: DataFrame, key: str, order: str, *columns: str) -> DataFrame:
    """One row for each key: that with the greatest order value."""
    picked = table.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("s"))
    return picked.select(key, *[F.col("s")[c].alias(c) for c in columns])


def first_wins(table: DataFrame, key: str, order: str, *columns: str) -> DataFrame:
    picked = table.groupBy(key).agg(F.min_by(F.struct(*columns), order).alias("s"))
    return picked.select(key, *[F.col("s")[c].alias(c) for c in columns])


def longest_wins(table: DataFrame, key: str, text: str, tie: str) -> DataFrame:
    """The longest text of each key; the least tie value decides between equal lengths."""
    return table.groupBy(key).agg(F.max_by(text, F.struct(F.length(text), -F.col(tie))).alias(text))


def unanimous_names(table: DataFrame, name: str, value: str) -> DataFrame:
    """Value of the names on which all rows agree."""
    agreed = table.groupBy(name).agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(value).alias("n"), F.count(F.lit(1)).alias("all"))
    return agreed.where("lo = hi and n = all").select(name, F.col("lo").alias(value))


def two_tier(rows: DataFrame, exact: str, name: str, table: DataFrame, value: str, row_id: str = "row_id") -> DataFrame:
    """row_id, value, tier: by the exact key, else by the name where all rows of that name agree. table: exact, name, value."""
    first = table.groupBy(exact).agg(F.max(value).alias("v1"))
    second = unanimous_names(table, name, value).select(name, F.col(value).alias("v2"))
    joined = rows.select(row_id, exact, name).join(first, exact, "left").join(second, name, "left")
    return joined.select(row_id, F.coalesce("v1", "v2").alias(value), F.when(F.col("v1").isNotNull(), "exact").when(F.col("v2").isNotNull(), "name").alias("tier"))


def without_any_key(rows: DataFrame, keys: list[Column], listed: DataFrame, key: str, row_id: str = "row_id") -> DataFrame:
    """The rows none of whose keys is listed; only ids and keys are shuffled for that."""
    hit = rows.select(row_id, F.explode(F.array(*keys)).alias("k")).where("k is not null").join(listed.select(F.col(key).alias("k")).distinct(), "k", "left_semi").select(row_id).distinct()
    return rows.join(hit, row_id, "left_anti")


def with_any_key(rows: DataFrame, keys: list[Column], listed: DataFrame, key: str, row_id: str = "row_id") -> DataFrame:
    """The rows one of whose keys is listed; all rows where nothing is listed."""
    if listed.isEmpty():
        return rows
    hit = rows.select(row_id, F.explode(F.array(*keys)).alias("k")).where("k is not null").join(listed.select(F.col(key).alias("k")).distinct(), "k", "left_semi").select(row_id).distinct()
    return rows.join(hit, row_id, "left_semi")


def corrected(rows: DataFrame, key: str, text: str, corrections: DataFrame, order: str, new: str) -> DataFrame:
    """The rows with the text of the last correction of their key; changed tells whether it differs."""
    last = last_wins(corrections, key, order, new).withColumnRenamed(new, "__new")
    return rows.join(last, key, "left").withColumn("changed", F.coalesce(~F.col("__new").eqNullSafe(F.col(text)) & F.col("__new").isNotNull(), F.lit(False))).withColumn(text, F.coalesce("__new", text)).drop("__new")


def conflicting_corrections(corrections: DataFrame, key: str, new: str) -> DataFrame:
    """Keys with two or more different corrections, and how many."""
    return corrections.groupBy(key).agg(F.count_distinct(new).alias("variants")).where("variants > 1")


def upserted_map(dest: DataFrame, source: DataFrame, key: str, entries: str, allowed: list[str] | None = None) -> DataFrame:
    """Every key's map with the source's entries added where the destination has none of that name."""
    right = source.select(key, F.col(entries).alias("__s"))
    if allowed is not None:
        right = right.withColumn("__s", F.map_filter("__s", lambda k, _: k.isin(allowed)))
    none = F.create_map().cast(dest.schema[entries].dataType)
    both = dest.select(key, entries).join(right, key, "full_outer")
    old, new = F.coalesce(entries, none), F.coalesce("__s", none)
    return both.select(key, F.map_concat(old, F.map_filter(new, lambda k, _: ~F.array_contains(F.map_keys(old), k))).alias(entries))


def unseen(rows: DataFrame, key: str, seen: DataFrame) -> DataFrame:
    """The rows whose key has not been processed; a null key never has."""
    return rows.join(seen.select(key).distinct(), key, "left_anti")


#: A span lies in at most so many bins; a longer one has bins of a greater width, a power of two of the least.
MOST_BINS = 64


def _width(length: Column, least: int) -> Column:
    """The power of two by which the bins of a span of this length are wider than the least."""
    return F.greatest(F.ceil(F.log2(length / F.lit(float(least * (MOST_BINS - 1))))), F.lit(0)).cast("int")


def _bin(at: Column, least: int) -> Column:
    return F.floor(at / (F.lit(least) * F.expr("shiftleft(1L, __w)")))


def containing_spans(points: DataFrame, spans: DataFrame, on: str, at: str, start: str, end: str, bin_ms: int) -> DataFrame:
    """Interval join: points and the spans of the same key that contain them, by way of bins so that a key of very many rows is no single group, and so that no span, however long, is in many bins."""
    s = spans.where(F.col(end) >= F.col(start)).withColumn("__w", _width(F.col(end) - F.col(start) + 1, bin_ms))
    widths = sorted(r[0] for r in s.select("__w").distinct().collect())  # at most 60
    s = s.withColumn("__bin", F.explode(F.sequence(_bin(F.col(start), bin_ms), _bin(F.col(end), bin_ms))))
    p = points.withColumn("__w", F.explode(F.lit(widths).cast("array<int>"))).withColumn("__bin", _bin(F.col(at), bin_ms))
    return p.join(s, [on, "__w", "__bin"]).where((F.col(start) <= F.col(at)) & (F.col(at) <= F.col(end))).drop("__bin", "__w")


def overlapping_spans(left: DataFrame, right: DataFrame, on: str, bin_ms: int) -> DataFrame:
    """Interval join: pairs of the same key that overlap, clipped. left: on, l_start, l_end; right: on, r_start, r_end (whole numbers).

    A pair meets in bins of the wider one's width; where it shares several, it is taken in that where the later of both starts.
    """
    sides = [d.where(f"{x}_end > {x}_start").withColumn(f"__{x}", _width(F.col(f"{x}_end") - F.col(f"{x}_start"), bin_ms)) for d, x in ((left, "l"), (right, "r"))]
    widths = sorted({r[0] for d, x in zip(sides, "lr") for r in d.select(f"__{x}").distinct().collect()})  # at most 60

    def binned(d: DataFrame, x: str) -> DataFrame:
        wide = d.withColumn("__w", F.explode(F.filter(F.lit(widths).cast("array<int>"), lambda w: w >= F.col(f"__{x}"))))
        return wide.withColumn("__bin", F.explode(F.sequence(_bin(F.col(f"{x}_start"), bin_ms), _bin(F.col(f"{x}_end") - 1, bin_ms))))

    a, b = (binned(d, x) for d, x in zip(sides, "lr"))
    met = a.join(b, [on, "__w", "__bin"]).where("l_start < r_end and r_start < l_end and __w = greatest(__l, __r)")
    return met.where(F.col("__bin") == _bin(F.greatest("l_start", "r_start"), bin_ms)).drop("__bin", "__w", "__l", "__r").withColumns({"start_ms": F.greatest("l_start", "r_start"), "end_ms": F.least("l_end", "r_end")})


HOT = 1000


def joined_apart(rows: DataFrame, table: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """rows joined with a table of one row for each key, where some keys may have very many rows.

    Keys with more than one in HOT of all rows (there can't be more than HOT of them) are joined by a broadcast of their
    few table rows, so no task gathers a hot key; the others are joined by shuffle. how: inner or left_semi. The rows are
    counted by key first, so they should be written already. Null keys match nothing.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    total = rows.count()
    hot = [r[0] for r in counts.where(F.col("__n") * HOT > total).select(key).collect()]
    if not hot:
        return rows.join(table, key, how)
    is_hot = F.col(key).isin(hot)
    few = table.where(is_hot).limit(HOT)  # one row for each key
    return rows.where(is_hot).join(F.broadcast(few), key, how).unionByName(rows.where(~is_hot).join(table.where(~is_hot), key, how))
