"""Readers: JSON lines in three error modes, JSON documents, CSV, inventories, markdown."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolwright.functions.text import FALSE_WORDS, TRUE_WORDS
from spoolwright.lineage import cut, hadoop_path

BAD = "_bad_line"


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, bad: str = "fail") -> DataFrame:
    """JSON lines. bad: 'fail' stops at a bad line, 'drop' leaves it out, 'keep' gives it as a row with _bad_line set. Blank lines are skipped in all modes."""
    if bad not in ("fail", "drop", "keep"):
        raise ValueError(bad)
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    reader = spark.read.option("mode", {"fail": "FAILFAST", "drop": "DROPMALFORMED", "keep": "PERMISSIVE"}[bad])
    if bad == "keep":
        kind = T.StructType([*kind.fields, T.StructField(BAD, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", BAD)
    return reader.schema(kind).json(path)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no (from 1), text of every line, blank ones too. Each file is numbered by itself.

    A large file is read in blocks: lines are numbered within their block, and each block's first number follows from the
    sizes of the blocks before it, one small row for each.
    """
    read = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"), F.col("value").alias("text"))
    lines = cut(read, "lines")
    blocks = lines.groupBy("__path", "__block").agg(F.min("__id").alias("__from"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__path").orderBy("__block")) - F.col("__n")
    numbered = lines.join(blocks.select("__path", "__block", "__from", before.alias("__before")), ["__path", "__block"])
    return numbered.select("file", (F.col("__before") + F.col("__id") - F.col("__from") + 1).alias("line_no"), F.regexp_replace("text", "\r$", "").alias("text"))


def first_lines(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The first n physical lines of each file; blank and bad ones count."""
    return numbered_lines(spark, path).where(F.col("line_no") <= n)


def read_csv(spark: SparkSession, path: str, required: list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with header. Missing required columns raise ValueError; lines that don't fit are read again without quotes, missing fields at their end as null; those with too many fields or a value that isn't of the schema's type are then dropped."""
    reader = spark.read.option("header", True)
    header = reader.csv(path).columns
    missing = [c for c in required if c not in header]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {path}")
    kind = T.StructType([T.StructField(c, T.StringType()) for c in header]) if schema is None else T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    marked = T.StructType([*kind.fields, T.StructField(BAD, T.StringType())])
    # without pruning, as else the fields of a line are not counted when only some columns are asked for
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD).option("columnPruning", False).option("enforceSchema", schema is None)
    fields = F.size(F.split(BAD, ",", -1))
    padded = F.concat(BAD, F.repeat(F.lit(","), F.greatest(len(kind) - fields, F.lit(0))))
    again = F.from_csv(padded, marked.toDDL(), {"quote": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})
    lines = reader.schema(marked).csv(path).withColumn("__again", F.when(F.col(BAD).isNotNull(), again)).where(F.col(BAD).isNull() | F.col("__again").isNotNull() & F.col("__again")[BAD].isNull())
    lines = lines.where(F.length(F.concat_ws("", F.col(f"`{kind.names[0]}`").cast("string"))) >= 0)  # always so; Spark refuses to read the bad lines alone, as a count would
    return lines.select(*[F.when(F.col(BAD).isNull(), F.col(f"`{c}`")).otherwise(F.col("__again")[c]).alias(c) for c in kind.names])


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Tolerant casts: what can't be cast is null."""
    return df.withColumns({c: F.trim(c).try_cast(t) for c, t in types.items()})


def read_models(spark: SparkSession, path: str, modes: tuple[str, ...] = ("en", "auto", "multilingual")) -> DataFrame:
    """The model registry: model_name, backend, model_ref, language_mode, enabled. An unknown language mode or flag raises when the row is read."""
    df = read_csv(spark, path, ["model_name", "backend", "model_ref", "language_mode", "enabled"])
    word = F.lower(F.trim("enabled"))
    enabled = F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False).otherwise(F.raise_error(F.concat(F.lit("enabled: "), F.coalesce("enabled", F.lit("null")))).cast("boolean"))
    mode = F.when(F.col("language_mode").isin(*modes), F.col("language_mode")).otherwise(F.raise_error(F.concat(F.lit("language_mode: "), F.coalesce("language_mode", F.lit("null")))).cast("string"))
    return df.withColumns({"enabled": enabled, "language_mode": mode})


SEGMENT = "start double, end double, text string, avg_logprob double, no_speech_prob double, compression_ratio double"


def read_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """file, path, segments of the JSON documents in a folder; segments from the first of the known places that has some."""
    s = f"array<struct<{SEGMENT}>>"
    places = ("response", "result", "data")
    schema = f"input_file struct<path:string>, groq_response struct<segments:{s}>, segments {s}, " + ", ".join(f"{p} struct<segments:{s}>" for p in places)
    docs = spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", "*.json").json(folder).select("*", F.col("_metadata.file_name").alias("file"))
    filled = lambda c: F.when(F.size(c) > 0, c)  # noqa: E731  (size of null is -1 or null)
    found = F.coalesce(filled(F.col("groq_response.segments")), filled(F.col("segments")), *[filled(F.col(f"{p}.segments")) for p in places])
    return docs.select("file", F.col("input_file.path").alias("path"), found.alias("segments"))


def segment_rows(transcripts: DataFrame) -> DataFrame:
    """file, pos and the fields of each segment; a document without segments has one row of nulls."""
    return transcripts.select("file", F.posexplode_outer("segments").alias("pos", "s")).select("file", "pos", "s.*")


def salvaged_json(spark: SparkSession, path: str) -> DataFrame:
    """file, pos, item (JSON) of the complete leading elements of JSON arrays that may be cut off."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        decoder = json.JSONDecoder()
        for f in frames:
            out = []
            for file, text in zip(f["file"], f["value"], strict=True):
                at, pos = text.find("[") + 1, 0
                while 0 < at < len(text):
                    while at < len(text) and text[at] in " \t\r\n,":
                        at += 1
                    try:
                        item, at = decoder.raw_decode(text, at)
                    except ValueError:
                        break
                    out.append((file, pos, json.dumps(item, ensure_ascii=False)))
                    pos += 1
            yield pd.DataFrame(out, columns=["file", "pos", "item"])

    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value").mapInPandas(run, "file string, pos int, item string")


def inventory(spark: SparkSession, root: str, extensions: tuple[str, ...] = (), exclude: tuple[str, ...] = ()) -> DataFrame:
    """path, bytes, modified of the files below a folder; the contents are not read. Paths that begin with an excluded prefix are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    if extensions:
        files = files.where(F.lower(F.substring_index("path", ".", -1)).isin(*[e.lower().lstrip(".") for e in extensions]))
    for prefix in exclude:
        files = files.where(~F.col("path").startswith(prefix))
    return files


def classified(path: Column, prefixes: dict[str, str], default: str = "included") -> Column:
    """The class of the first prefix that the path begins with."""
    return F.coalesce(*[F.when(path.startswith(p), F.lit(c)) for p, c in prefixes.items()], F.lit(default))


def section_handles(lines: DataFrame, heading: str) -> DataFrame:
    """handle, line_no: the owner/name handles of a markdown section (lower case, first mention), by its heading of second level.

    lines: file, line_no, text.
    """
    h2 = F.regexp_extract("text", r"^##\s+(.+?)\s*$", 1)
    within = Window.partitionBy("file").orderBy("line_no")
    carried = lines.withColumn("h", F.last(F.nullif(h2, F.lit("")), ignorenulls=True).over(within)).where(F.lower("h") == heading.lower())
    handles = carried.select("line_no", F.posexplode(F.regexp_extract_all(F.lower("text"), F.lit(r"\b([a-z0-9][a-z0-9_\-]*/[a-z0-9][a-z0-9._\-]*)"), 1)).alias("i", "handle"))
    return handles.groupBy("handle").agg(F.min(F.struct("line_no", "i")).alias("m")).select("handle", F.col("m.line_no").alias("line_no"))


def fresh_probes(files: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files with the cached duration, files that must be probed): a cache row holds while path, bytes and modified agree."""
    key = ["path", "bytes", "modified"]
    known = cache.select(*key, "duration").dropDuplicates(key)
    return files.join(known, key), files.join(known.select(*key), key, "left_anti")


def processed_files(spark: SparkSession, path: str) -> DataFrame:
    """file: the different entries of an output CSV, for a run that resumes. Column file where the first line names it, else the first column; a missing CSV gives none."""
    files, where = hadoop_path(spark, path)
    none = spark.createDataFrame([], "file string")
    if not files.exists(where):
        return none
    headed = "file" in (spark.read.text(path).first() or [""])[0].lower()
    rows = spark.read.option("header", headed).option("multiLine", True).option("escape", '"').csv(path)
    if headed and "file" not in rows.columns or not rows.columns:
        return none
    file = F.trim(F.col("file" if headed else rows.columns[0]))
    found = rows.select(file.alias("file")).where("file <> ''")
    return (found if headed else found.where(F.lower("file") != "file")).distinct()


def read_predictions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(file, key, item) and (file, run_args) of JSON documents of predictions: a list, or an object with items or samples.

    Items are keyed by mix_key or else key, the last of a key counts, and those without either are left out. Records of
    the run (__meta__, run_args) are lifted out, the last of a document counts. A document that is no JSON gives nothing.
    """

    def parsed(text: str) -> tuple[dict, dict | None]:
        import json

        try:
            data = json.loads(text)
        except ValueError:
            return {}, None
        meta, items = None, {}
        if isinstance(data, dict):
            meta = data.get("run_args") or data.get("__meta__")
            data = data.get("items") or data.get("samples") or []
        for x in data if isinstance(data, list) else []:
            if not isinstance(x, dict):
                continue
            if isinstance(x.get("__meta__"), dict):
                inner = x["__meta__"].get("run_args")
                meta = inner if isinstance(inner, dict) else x["__meta__"]
            elif "run_args" in x and "mix_key" not in x:
                meta = x["run_args"] if isinstance(x["run_args"], dict) else meta
            elif x.get("mix_key") or x.get("key"):
                items[str(x.get("mix_key") or x.get("key"))] = x
        return {k: json.dumps(v, ensure_ascii=False) for k, v in items.items()}, None if meta is None else json.dumps(meta, ensure_ascii=False)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for file, text in zip(f["file"], f["value"], strict=True):
                items, meta = parsed(text)
                out += [(file, k, v) for k, v in items.items()] + ([(file, None, meta)] if meta is not None else [])
            yield pd.DataFrame(out, columns=["file", "key", "item"], dtype=object)

    both = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value").mapInPandas(run, "file string, key string, item string")
    return both.where("key is not null"), both.where("key is null").select("file", F.col("item").alias("run_args"))


def taken(df: DataFrame, spec: str, key: str, text: str, audio: str, n: int, seed: str = "17") -> DataFrame:
    """n rows of each spec in hash order, then without those that lack text or audio; they count among the n."""
    from spoolwright.operators.selection import cap_per_group

    return cap_per_group(df, spec, key, n, seed).where((F.trim(F.coalesce(F.col(text), F.lit(""))) != "") & F.col(audio).isNotNull())
