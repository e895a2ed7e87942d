"""Queries that go through the readers and writers and back, and operators on what they give."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoolwright.functions import paths, runs, text
from spoolwright.operators import manifests, stages
from spoolwright.plans import metric_queries as mq
from spoolwright.plans.lookup_queries import _SLASHED
from spoolwright.plans.stream_queries import _place
from spoolwright.session import table
from spoolwright.sources import readers, writers


def jsonl_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with bad and blank ones between: what is dropped, what is kept with its line."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    line = F.when(F.col("doc_id") % 7 == 0, '{"doc_id": oops').when(F.col("doc_id") % 11 == 0, "").otherwise(F.to_json(F.struct("doc_id", "lang")))
    d.select(line.alias("value")).write.text(path := _place(spark, "lines"))
    dropped = readers.read_jsonl(spark, path, "doc_id long, lang string", "drop").agg(F.count("doc_id").alias("rows"), F.sum("doc_id").alias("ids"), F.count("lang").alias("langs"))
    kept = readers.read_jsonl(spark, path, "doc_id long, lang string", "keep").agg(F.count(readers.BAD).alias("bad"), F.count("doc_id").alias("good"))
    return dropped.crossJoin(kept)  # one row each


def jsonl_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    writers.write_jsonl(d.where("lang = 'en'"), path := _place(spark, "appended"))
    writers.write_jsonl(d.where("lang = 'de'"), path, append=True)
    return readers.read_jsonl(spark, path, d.schema).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"))


def numbered_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of text files, each at a place of its own; the first two of each file are its sample."""
    d = table(spark, sf_dir, "segment_refs").where("text is not null").select(F.regexp_replace("text", "[\\r\\n]+", " ").alias("value"))
    d.write.text(path := _place(spark, "text"))
    lines = readers.numbered_lines(spark, path)
    return lines.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("file", "line_no").alias("places"), F.sum(F.length("text")).alias("chars"))


def resumed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files that an output CSV has already."""
    done = table(spark, sf_dir, "batch_map").select(F.col("original_file").alias("file"), "start_sec")
    done.write.option("header", True).option("escape", '"').csv(path := _place(spark, "done"))
    return readers.processed_files(spark, path)


def model_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry through its CSV, with flags in words."""
    s = table(spark, sf_dir, "supplier")
    word = F.element_at(F.array(*[F.lit(w) for w in ("Yes", "off", "1", "FALSE", "t")]), (F.col("s_suppkey") % 5 + 1).cast("int"))
    mode = F.element_at(F.array(F.lit("en"), F.lit("auto"), F.lit("multilingual")), (F.col("s_suppkey") % 3 + 1).cast("int"))
    s.select(F.col("s_name").alias("model_name"), F.lit("b").alias("backend"), F.concat(F.lit("m/"), "s_name").alias("model_ref"), mode.alias("language_mode"), word.alias("enabled")).write.option("header", True).csv(path := _place(spark, "registry"))
    return readers.read_models(spark, path).select("model_name", "model_ref", "language_mode", "enabled")


def probe_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths of files from a cache that holds while path, size and time agree."""
    m = table(spark, sf_dir, "batch_map").where("original_file is not null and end_sec > start_sec")
    files = m.groupBy(F.col("original_file").alias("path")).agg(F.max("map_id").alias("bytes"), F.min("start_sec").alias("modified"))
    cache = files.where("bytes % 2 = 0").withColumns({"duration": F.lit(1.5), "modified": F.when(F.col("bytes") % 3 == 0, F.col("modified") + 1).otherwise(F.col("modified"))})
    hit, miss = readers.fresh_probes(files, cache)
    return hit.select("path", "duration").unionByName(miss.select("path", F.lit(None).cast("double").alias("duration")))


def section_handles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Handles below one heading of documents whose lines lie in a table."""
    p = table(spark, sf_dir, "part")
    line = F.when(F.col("p_size") % 10 == 0, "## Data sets ").when(F.col("p_size") % 10 == 5, "## Others").otherwise(F.concat(F.lit("- Owner/"), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("-"), (F.col("p_size") % 3).cast("string"), F.lit(" and more")))
    return readers.section_handles(p.select(F.col("p_brand").alias("file"), F.col("p_partkey").alias("line_no"), line.alias("text")), "data sets")


def path_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files by the first of the known beginnings of their path."""
    key = table(spark, sf_dir, "manifest_rows").where("audio_path is not null").select(paths.slashed(F.col("audio_path")).alias("p"))
    return key.groupBy(readers.classified(F.col("p"), {"d:/voice_lab/batches": "packed", "d:/voice_lab": "local", "/mnt": "mounted"}, "elsewhere").alias("class")).agg(F.count(F.lit(1)).alias("n"))


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV with a line for each row and reason, read back and counted."""
    t = table(spark, sf_dir, "cut_tasks").select("task_id", F.array_compact(F.array(F.when(F.col("audio_path").isNull(), "no_path"), F.when(F.col("core_end") <= F.col("core_start"), "no_length"), F.when(F.col("target_out_sec").isNull() | F.isnan("target_out_sec"), "no_target"))).alias("why"))
    writers.rejected_report(t, F.col("why"), path := _place(spark, "rejected"))
    return spark.read.option("header", True).csv(path).groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("task_id").cast("long")).alias("ids"))


def leaderboard_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaderboard through its JSON file."""
    writers.write_leaderboard(mq.leaderboard(spark, sf_dir), path := _place(spark, "board"))
    return spark.read.schema("model string, win_rate double, position int").json(f"{path}/json")


def top_with_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base model and the three best others."""
    return manifests.best_with_base(mq._models(spark, sf_dir), "win_rate", "model", "gain", 3).select("model", "win_rate", "place")


def first_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "manifest_rows").select("row_id", text.first_text(F.col("text"), F.col("transcript_json"), F.lit(" none ")).alias("first"))


def short_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "cut_tasks").where("out_wav is not null").select("task_id", text.short_model_name(F.col("out_wav"), 20).alias("short"))


def latest_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    names = F.array(F.concat(F.lit("epoch_"), F.col("p_size").cast("string")), F.lit("final"), F.concat(F.lit("checkpoint-"), (F.col("p_partkey") % 40).cast("string")))
    return p.select("p_partkey", runs.latest_epoch(names).alias("epoch"))


def seen_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings of documents over two runs, each once."""
    d = table(spark, sf_dir, "documents").select("recording_key", "lang")
    out, seen = _place(spark, "out"), _place(spark, "seen")
    added = [stages.append_unseen(spark, rows, "recording_key", out, seen) for rows in (d.where("lang = 'en'"), d)]
    return spark.read.parquet(out).select("recording_key", F.lit(sum(added)).cast("long").alias("added"))


def taken_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty rows of each source in hash order, without those that lack a text or path (the number is the feature)."""
    return readers.taken(table(spark, sf_dir, "manifest_rows"), "source", "row_id", "text", "audio_path", 20).select("source", "row_id")


def strict_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signs outside printable ASCII, and how often they occur."""
    found = table(spark, sf_dir, "segment_refs").select(F.explode(text.odd_characters(F.col("text"), True)).alias("sign"))
    return found.groupBy("sign").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        jsonl_modes, jsonl_appended, numbered_text, resumed_files, model_registry, probe_cache, section_handles, path_classes, rejected_rows, leaderboard_files, top_with_base, first_texts, short_names, latest_epochs, seen_once, taken_rows, strict_census,
    )
}

_PATH = _SLASHED.format(p="audio_path")
ORACLES = {
    "jsonl_modes": """WITH d AS (SELECT *, doc_id % 7 = 0 AS bad, doc_id % 7 <> 0 AND doc_id % 11 <> 0 AS ok FROM documents)
SELECT count(*) FILTER (ok) AS rows, CAST(sum(doc_id) FILTER (ok) AS BIGINT) AS ids, count(lang) FILTER (ok) AS langs, count(*) FILTER (bad) AS bad, count(*) FILTER (ok) AS good FROM d""",
    "jsonl_appended": "SELECT source, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM documents WHERE lang IN ('en', 'de') GROUP BY source",
    "numbered_text": r"SELECT count(*) AS n, count(*) AS places, CAST(sum(length(regexp_replace(text, '[\r\n]+', ' ', 'g'))) AS BIGINT) AS chars FROM segment_refs WHERE text IS NOT NULL",
    "resumed_files": "SELECT DISTINCT trim(original_file) AS file FROM batch_map WHERE trim(original_file) <> ''",
    "model_registry": "SELECT s_name AS model_name, 'm/' || s_name AS model_ref, (['en', 'auto', 'multilingual'])[s_suppkey % 3 + 1] AS language_mode, s_suppkey % 5 IN (0, 2, 4) AS enabled FROM supplier",
    "probe_cache": "SELECT original_file AS path, CASE WHEN max(map_id) % 2 = 0 AND max(map_id) % 3 <> 0 THEN 1.5::DOUBLE END AS duration FROM batch_map WHERE original_file IS NOT NULL AND end_sec > start_sec GROUP BY 1",
    "section_handles": """WITH l AS (SELECT p_brand AS f, p_partkey AS n, p_size % 10 AS k, 'owner/' || lower(replace(p_name, ' ', '-')) || '-' || (p_size % 3) AS h FROM part), c AS (SELECT *, last_value(CASE WHEN k IN (0, 5) THEN k END IGNORE NULLS) OVER (PARTITION BY f ORDER BY n) AS s FROM l)
SELECT h AS handle, min(n) AS line_no FROM c WHERE s = 0 AND k NOT IN (0, 5) GROUP BY h""",
    "path_classes": f"WITH p AS (SELECT {_PATH} AS p FROM manifest_rows WHERE audio_path IS NOT NULL) SELECT CASE WHEN starts_with(p, 'd:/voice_lab/batches') THEN 'packed' WHEN starts_with(p, 'd:/voice_lab') THEN 'local' WHEN starts_with(p, '/mnt') THEN 'mounted' ELSE 'elsewhere' END AS class, count(*) AS n FROM p GROUP BY 1",
    "rejected_rows": """WITH r AS (SELECT task_id, unnest(list_filter([CASE WHEN audio_path IS NULL THEN 'no_path' END, CASE WHEN core_end <= core_start THEN 'no_length' END, CASE WHEN target_out_sec IS NULL OR isnan(target_out_sec) THEN 'no_target' END], lambda x: x IS NOT NULL)) AS reason FROM cut_tasks)
SELECT reason, count(*) AS n, CAST(sum(task_id) AS BIGINT) AS ids FROM r GROUP BY 1""",
    "leaderboard_files": mq.ORACLES["leaderboard"].replace("SELECT model, win_rate, speed, score, row_number()", "SELECT model, win_rate, row_number()"),
    "top_with_base": mq._MODELS + "SELECT model, win_rate, CASE WHEN model = 'gain' THEN 0 ELSE row_number() OVER (PARTITION BY model = 'gain' ORDER BY win_rate DESC NULLS LAST, model) END::INT AS place FROM models QUALIFY place <= 3",
    "first_texts": r"SELECT row_id, coalesce(nullif(regexp_replace(text, '^\s+|\s+$', '', 'g'), ''), nullif(regexp_replace(transcript_json, '^\s+|\s+$', '', 'g'), ''), 'none') AS first FROM manifest_rows",
    "short_names": r"""WITH n AS (SELECT task_id, regexp_replace(list_last(string_split_regex(regexp_replace(out_wav, '[\\/]+$', ''), '[\\/]')), '[^A-Za-z0-9._\-]+', '_', 'g') AS n FROM cut_tasks WHERE out_wav IS NOT NULL)
SELECT task_id, CASE WHEN length(n) <= 20 THEN n ELSE left(n, 9) || '…' || right(n, 9) END AS short FROM n""",
    "latest_epochs": "SELECT p_partkey, greatest(p_size, p_partkey % 40)::INT AS epoch FROM part",
    "seen_once": "WITH k AS (SELECT DISTINCT recording_key FROM documents WHERE recording_key IS NOT NULL) SELECT recording_key, count(*) OVER () AS added FROM k",
    "strict_census": r"SELECT sign, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[^\x20-\x7E\r\n\t]')) AS sign FROM segment_refs) GROUP BY 1",
    "taken_rows": "SELECT source, row_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY sha1('17' || row_id::VARCHAR), row_id) AS k FROM manifest_rows) WHERE k <= 20 AND trim(coalesce(text, '')) <> '' AND audio_path IS NOT NULL",
}
