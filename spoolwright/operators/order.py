"""Positions and running values over a whole table without one task for all rows, or for all rows of a key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoolwright.lineage import cut

_LOCAL = (1 << 33) - 1


def ranked(df: DataFrame, *order: Column | str, name: str = "pos") -> DataFrame:
    """The rows with their place (from 0) in the given order, which must be total.

    The range sort is written once, every partition counts its own rows, and the offsets of the partitions (one small
    row each) are added; a global row_number would put all rows in one task.
    """
    laid = cut(df.orderBy(*order).withColumn("__id", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("__id", 33).cast("int").alias("__p")
    sizes = laid.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("__p", (F.sum("n").over(Window.orderBy("__p")) - F.col("n")).alias("__start"))
    joined = laid.withColumn("__p", part).join(F.broadcast(starts), "__p")  # one row for each partition of the sort
    return joined.withColumn(name, F.col("__start") + F.col("__id").bitwiseAND(F.lit(_LOCAL))).drop("__id", "__p", "__start")


class Laid:
    """A table sorted by key and order, written once, in which rows look at those before them in their key.

    The range sort deals a key with very many rows to several partitions. Within a partition a window does the work; what
    a partition's first key has had in the partitions before it is added from one small row for each partition. So no
    task holds all rows of a key. A null key is a key. The order must be total within a key.
    """

    def __init__(self, df: DataFrame, key: str, *order: Column | str, label: str = "laid") -> None:
        self.key = key
        laid = cut(df.orderBy(F.asc(key), *order).withColumn("__id", F.monotonically_increasing_id()), label)
        self.df = laid.withColumn("__p", F.shiftright("__id", 33).cast("int"))

    def _carried(self, values: dict[str, Callable[[Column], Column]], inputs: dict[str, Column], merged: Callable[[str, Column], Column], latest: bool) -> DataFrame:
        """__p, and for each value what the partition's first key has from earlier (later, if not latest) partitions."""
        edge = F.max if latest else F.min
        ends = self.df.select("__p", "__id", F.col(self.key).alias("__k"), *[c.alias(n) for n, c in inputs.items()])
        per = ends.groupBy("__p", "__k").agg(F.min("__id").alias("__lo"), F.max("__id").alias("__hi"), *[make(F.col(n)).alias(n) for n, make in values.items()])
        # of each partition the key at its end gives, the key at its beginning takes (the other way round for looking ahead)
        w = Window.partitionBy("__p")
        marked = per.withColumns({"__gives": F.col("__hi" if latest else "__lo") == edge("__hi" if latest else "__lo").over(w), "__takes": F.col("__lo" if latest else "__hi") == (F.min("__lo") if latest else F.max("__hi")).over(w)})
        gives = marked.where("__gives").select("__p", "__k", F.lit(1 if latest else 0).alias("__t"), *values)
        takes = marked.where("__takes").select("__p", "__k", F.lit(0 if latest else 1).alias("__t"), *[F.lit(None).cast(marked.schema[n].dataType).alias(n) for n in values])
        along = Window.partitionBy("__k").orderBy("__p", "__t") if latest else Window.partitionBy("__k").orderBy(F.desc("__p"), F.desc("__t"))
        before = along.rowsBetween(Window.unboundedPreceding, -1)
        events = gives.unionByName(takes)
        asked = events.select("__p", "__t", F.col("__k"), *[merged(n, F.col(n)).over(before).alias(f"__c_{n}") for n in values])
        return asked.where(F.col("__t") == (0 if latest else 1)).select("__p", F.col("__k").alias("__ck"), *[f"__c_{n}" for n in values])

    def _with(self, local: dict[str, Column], carry: DataFrame, joined: Callable[[str, Column, Column], Column]) -> Laid:
        rows = self.df.withColumns({f"__l_{n}": c for n, c in local.items()}).join(F.broadcast(carry), "__p", "left")  # one row for each partition of the sort
        mine = F.col("__ck").eqNullSafe(F.col(self.key))
        out = rows.withColumns({n: joined(n, F.col(f"__l_{n}"), F.when(mine, F.col(f"__c_{n}"))) for n in local})
        new = object.__new__(Laid)
        new.key, new.df = self.key, out.drop("__ck", *[f"__l_{n}" for n in local], *[f"__c_{n}" for n in local])
        return new

    def _window(self, back: bool = True):
        w = Window.partitionBy("__p", self.key)
        return w.orderBy("__id") if back else w.orderBy(F.desc("__id"))

    def neighbour(self, ahead: bool = False, **columns: Column) -> Laid:
        """With the columns' values of the row before (or after); null for the first (or last) of a key."""
        w = self._window(not ahead)
        pick = F.min_by if ahead else F.max_by
        made = {n: (lambda c: pick(F.struct(c.alias("v")), F.col("__id"))) for n in columns}
        carry = self._carried(made, columns, lambda n, c: F.last(c, ignorenulls=True), latest=not ahead)
        local = {n: F.lag(F.struct(c.alias("v"))).over(w) for n, c in columns.items()}
        out = self._with(local, carry, lambda n, own, c: F.coalesce(own, c))
        out.df = out.df.withColumns({n: F.col(n)["v"] for n in columns})
        return out

    def summed_before(self, **columns: Column) -> Laid:
        """With the sums of the columns over the rows of the key before this one; 0 for the first."""
        carry = self._carried({n: F.sum for n in columns}, columns, lambda n, c: F.sum(c), latest=True)
        local = {n: F.sum(c).over(self._window().rowsBetween(Window.unboundedPreceding, -1)) for n, c in columns.items()}
        return self._with(local, carry, lambda n, own, c: F.coalesce(own, F.lit(0)) + F.coalesce(c, F.lit(0)))

    def greatest_before(self, **columns: Column) -> Laid:
        """With the greatest values of the columns in the rows of the key before this one; null for the first."""
        carry = self._carried({n: F.max for n in columns}, columns, lambda n, c: F.max(c), latest=True)
        local = {n: F.max(c).over(self._window().rowsBetween(Window.unboundedPreceding, -1)) for n, c in columns.items()}
        return self._with(local, carry, lambda n, own, c: F.greatest(own, c))

    def least_before(self, **columns: Column) -> Laid:
        """With the least values of the columns in the rows of the key before this one; null for the first."""
        carry = self._carried({n: F.min for n in columns}, columns, lambda n, c: F.min(c), latest=True)
        local = {n: F.min(c).over(self._window().rowsBetween(Window.unboundedPreceding, -1)) for n, c in columns.items()}
        return self._with(local, carry, lambda n, own, c: F.least(own, c))

    def islands(self, fresh: Column, name: str = "island") -> Laid:
        """With the number of the row at which the row's island begins: a row that is fresh, or the first of its key, begins one."""
        marked = object.__new__(Laid)
        marked.key, marked.df = self.key, self.df.withColumn("__head", F.when(F.coalesce(fresh, F.lit(True)), F.col("__id")))
        carry = marked._carried({name: F.max}, {name: F.col("__head")}, lambda n, c: F.max(c), latest=True)
        local = {name: F.max("__head").over(marked._window().rowsBetween(Window.unboundedPreceding, 0))}
        out = marked._with(local, carry, lambda n, own, c: F.coalesce(own, c))
        out.df = out.df.drop("__head")
        return out

    def rows(self) -> DataFrame:
        return self.df.drop("__id", "__p")


def value_at(df: DataFrame, column: str, share: float) -> float | None:
    """sorted[int(n * share) - 1], or the least value where that is no place; null and NaN are left out. None for an empty input."""
    clean = df.where(F.col(column).isNotNull() & ~F.isnan(column)).select(F.col(column).alias("v"))
    placed = ranked(clean, "v")
    n = placed.count()
    if not n:
        return None
    return placed.where(F.col("pos") == max(int(n * share) - 1, 0)).first()["v"]
