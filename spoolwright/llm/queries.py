"""The queries of the training-data operators and, where SQL can say it, the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoolwright.llm import consistent, containers, encode, overlap, pieces, reading, splits
from spoolwright.llm.oracles import ORACLES
from spoolwright.session import table


def _overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.overlapping_rows(table(spark, sf_dir, "manifest_rows"), table(spark, sf_dir, "path_roots"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _overlaps(spark, sf_dir).select(F.least("eval_id", "train_id").alias("row_id_a"), F.greatest("eval_id", "train_id").alias("row_id_b"))


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs, rows and shared parts of each evaluation split and source."""
    return overlap.overlap_report(table(spark, sf_dir, "manifest_rows"), table(spark, sf_dir, "path_roots"))


_TEXTS = (("segment_refs", "seg_key"), ("manifest_rows", "row_id"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [consistent.changed_texts(table(spark, sf_dir, t), key, "text").select(F.lit(t).alias("tbl"), F.col("key").alias("row_key")) for t, key in _TEXTS]
    return parts[0].unionByName(parts[1])


def p4_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in its consistent form."""
    parts = [consistent.consistent_texts(table(spark, sf_dir, t), key, "text").select(F.lit(t).alias("tbl"), F.col("key").alias("row_key"), "consistent", "changed") for t, key in _TEXTS]
    return parts[0].unionByName(parts[1])


def _corpus(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(table(spark, sf_dir, t) for t in ("manifest_rows", "batch_map", "path_roots"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.mixed_recordings(*_corpus(spark, sf_dir))


def p3_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new split of every row."""
    return splits.grouped_splits(*_corpus(spark, sf_dir))


def _plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.cut_plans(*(table(spark, sf_dir, t) for t in ("cut_tasks", "segment_refs", "path_roots")))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plans(spark, sf_dir).select("task_id", "cut_kind")


def p5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.pieces(_plans(spark, sf_dir))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encoded(table(spark, sf_dir, "documents"))


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containers.packed(encode.token_counts(table(spark, sf_dir, "documents")))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containers.cut_documents(_packed(spark, sf_dir))


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Container and place of every document or piece of one."""
    return _packed(spark, sf_dir)


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containers.fill_report(_packed(spark, sf_dir))


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return reading.levels(documents, reading.fitted(documents, table(spark, sf_dir, "reading_labels")))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.banded(_levels(spark, sf_dir))


def p8_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _levels(spark, sf_dir)


def p8_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by source, language and level."""
    sources = table(spark, sf_dir, "documents").select("doc_id", "source")
    return _levels(spark, sf_dir).join(sources, "doc_id").groupBy("source", "english", "level").agg(F.count(F.lit(1)).alias("documents"), F.sum("words").alias("words"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (p1_found, p1_report, p3_found, p3_splits, p4_found, p4_texts, p5_found, p5_pieces, p6_ids, p7_found, p7_containers, p7_fill, p8_found, p8_levels, p8_profile)
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
