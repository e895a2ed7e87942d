"""Session and table access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "manifest_rows", "batch_map", "audio_segments", "speech_segments", "segment_refs", "cut_tasks", "reading_labels", "path_roots",
)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "spoolwright") -> SparkSession:
    """A single-machine session for tests and benchmarks. A cluster job brings its own session and settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = TABLES) -> dict[str, DataFrame]:
    """Registers every table as a temporary view, so spark.sql works on them, and returns the frames by name."""
    frames = {name: table(spark, sf_dir, name) for name in names}
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return frames
