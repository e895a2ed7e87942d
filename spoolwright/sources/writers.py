"""Writers: JSON lines, CSV reports with growing headers, split manifests, subtitles, leaderboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spoolwright.functions.text import ass_text, ass_time, vtt_time
from spoolwright.lineage import hadoop_path


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    """JSON lines; nulls are kept."""
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", False).json(path)


def write_split(df: DataFrame, flag: Column, path: str) -> None:
    """Both sides of a predicate in one pass, as folders side=true and side=false; a null goes to neither."""
    df.withColumn("side", flag).where("side is not null").write.mode("overwrite").partitionBy("side").parquet(path)


def _csv_parts(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """Folder and header of the parts of a grown CSV, in order; there is one for each different header."""
    files, where = hadoop_path(spark, path)
    names = sorted(str(x.getPath().getName()) for x in files.listStatus(where) if x.isDirectory()) if files.exists(where) else []
    return [(n, spark.read.option("header", True).csv(f"{path}/{n}").columns) for n in names]


def append_csv(spark: SparkSession, df: DataFrame, path: str) -> list[str]:
    """Appends the rows to a CSV that may get new columns: rows of a header that is there already go to its part, others begin a part. Nothing old is written again. Gives the united header."""
    parts = _csv_parts(spark, path)
    name = next((n for n, header in parts if header == df.columns), f"part-{len(parts):05d}")
    df.write.mode("append").option("header", True).option("escape", '"').csv(f"{path}/{name}")
    return list(dict.fromkeys(c for _, header in [*parts, (name, df.columns)] for c in header))


def read_grown_csv(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a CSV that append_csv has written, as strings; what a row lacks is null."""
    frames = [spark.read.option("header", True).option("escape", '"').csv(f"{path}/{n}") for n, _ in _csv_parts(spark, path)]
    if not frames:
        raise ValueError(f"no parts in {path}")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def rejected_report(df: DataFrame, reasons: Column, path: str) -> None:
    """One line for each row and reason, with the row's plain columns (a CSV holds no arrays, maps or structs)."""
    plain = [c for c, kind in df.dtypes if not kind.startswith(("array", "map", "struct"))]
    df.select(*plain, F.explode(reasons).alias("reason")).write.mode("overwrite").option("header", True).csv(path)


def write_leaderboard(board: DataFrame, path: str) -> None:
    """A few rows in their order, as one CSV and one JSON file."""
    ordered = board.orderBy("position").coalesce(1)
    ordered.write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    ordered.write.mode("overwrite").json(f"{path}/json")


def _cues(segments: DataFrame, key: str, line: Column, head: str, between: str) -> DataFrame:
    spoken = segments.where(F.col("text").rlike(r"[\p{L}\p{N}]") & (F.col("end") > F.col("start")))
    cues = spoken.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start", "end", line.alias("line")))).alias("c"))
    return cues.select(key, F.concat(F.lit(head), F.array_join(F.transform("c", lambda x: x["line"]), between), F.lit("\n")).alias("subtitles"))


def web_vtt(segments: DataFrame, key: str) -> DataFrame:
    """key, subtitles: one WebVTT text for each document, cues by time; cues without letters or digits are left out. segments: key, start, end, text (one file's cues)."""
    line = F.concat(vtt_time(F.col("start")), F.lit(" --> "), vtt_time(F.col("end")), F.lit("\n"), F.trim("text"))
    return _cues(segments, key, line, "WEBVTT\n\n", "\n\n")


def ass(segments: DataFrame, key: str) -> DataFrame:
    """key, subtitles: the event lines of an ASS file."""
    line = F.concat(F.lit("Dialogue: 0,"), ass_time(F.col("start")), F.lit(","), ass_time(F.col("end")), F.lit(",Default,,0,0,0,,"), ass_text(F.trim("text")))
    return _cues(segments, key, line, "[Events]\nFormat: Layer, Start, End, Style, Name, MarginL, MarginR, MarginV, Effect, Text\n", "\n")
