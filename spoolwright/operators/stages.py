"""Stages that run once for each key or configuration, and augmented rows."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spoolwright.lineage import cut, hadoop_path

REGISTRY: dict[str, Callable[[DataFrame], DataFrame]] = {}


def stage(name: str) -> Callable[[Callable[[DataFrame], DataFrame]], Callable[[DataFrame], DataFrame]]:
    """Registers a stage under a name; a second one of the name is refused."""

    def add(run: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"there is a stage {name} already")
        REGISTRY[name] = run
        return run

    return add


def run_stages(df: DataFrame, names: list[str]) -> DataFrame:
    """The stages one after the other, as one plan."""
    for name in names:
        df = REGISTRY[name](df)
    return df


def signature(config: dict, inputs: dict[str, str]) -> str:
    """Digest of a stage's configuration and of its inputs' signatures."""
    return hashlib.sha256(json.dumps({"config": config, "inputs": inputs}, sort_keys=True).encode()).hexdigest()


def should_run(name: str, sig: str, done: dict[str, str], outputs_present: bool, force: bool = False) -> bool:
    """A stage runs unless it is marked done with this signature and its outputs are there."""
    return force or not outputs_present or done.get(name) != sig


def append_unseen(spark: SparkSession, rows: DataFrame, key: str, out: str, seen: str) -> int:
    """Appends the rows whose key is in no earlier run, once each, and their keys; gives their number. Running it again adds nothing.

    Only keys are read, and only new rows and keys are written. A file beside `seen` marks a run under way; where an
    earlier run has left one, it broke off, and the keys in `out` count too.
    """
    files, pending = hadoop_path(spark, f"{seen}.pending")
    have = lambda path: (lambda f, p: f.exists(p))(*hadoop_path(spark, path))
    known = [spark.read.parquet(path).select(key) for path in ([seen, out] if files.exists(pending) else [seen]) if have(path)]
    fresh = rows.where(F.col(key).isNotNull()).dropDuplicates([key])
    for keys in known:
        fresh = fresh.join(keys.distinct(), key, "left_anti")
    files.create(pending, True).close()
    made = cut(fresh, "unseen-rows")
    made.write.mode("append").parquet(out)
    added = made.select(key)
    for keys in known[1:]:
        added = added.unionByName(keys).distinct()
    added.write.mode("append").parquet(seen)
    files.delete(pending, False)
    return made.count()


def seeded(spark: SparkSession, source: str, out: str) -> bool:
    """Copies a table to where a run goes on from, unless one is there already; tells whether it did."""
    files, where = hadoop_path(spark, out)
    if files.exists(where):
        return False
    spark.read.parquet(source).write.parquet(out)
    return True


def is_original(df: DataFrame) -> Column:
    """Rows that no augmentation has made."""
    return (F.coalesce("aug_stage", F.lit("")) == "") & (F.col("uid").isNull() | F.coalesce(F.col("uid") == F.col("base_uid"), F.lit(True)))


def augmented(rows: DataFrame, name: str, copies: int, meta: dict[str, Column]) -> DataFrame:
    """`copies` rows for each original one: uid, base_uid, parent_uid, aug_stage, aug_copy_idx, aug_meta (old entries, new ones win)."""
    fresh = F.create_map(*[x for k, v in meta.items() for x in (F.lit(k), v.cast("string"))]) if meta else F.create_map().cast("map<string,string>")
    old = F.coalesce("aug_meta", F.create_map().cast("map<string,string>"))
    kept = F.map_filter(old, lambda k, _: ~k.isin(list(meta)))
    base = F.coalesce(F.nullif("base_uid", F.lit("")), F.col("uid"))
    out = rows.where(is_original(rows)).withColumn("aug_copy_idx", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    uid = F.substring(F.sha1(F.concat_ws("|", base, F.lit(name), F.format_string("copy%03d", "aug_copy_idx"))), 1, 16)
    return out.withColumns({"parent_uid": F.col("uid"), "base_uid": base, "aug_stage": F.lit(name), "aug_meta": F.map_concat(kept, fresh), "uid": uid})
