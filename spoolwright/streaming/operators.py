"""Streaming operators: windows with context, stable prefixes, running statistics, work done once for each key."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoolwright.lineage import hadoop_path, shared_dir
from spoolwright.operators.edits import word_count
from spoolwright.operators.stages import append_unseen


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A parquet file or folder as a stream; the schema is that of what lies there."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files, where = hadoop_path(spark, path)
    if files.getFileStatus(where).isDirectory():
        return reader.parquet(path)
    folder, name = path.rsplit("/", 1)
    return reader.option("pathGlobFilter", name).parquet(folder)


def context_windows(stream: DataFrame, ts: str, chunk: str, left: str, late: str, *keys: str) -> DataFrame:
    """Counts in windows of `left` that advance by `chunk`; rows later than `late` are left out of closed windows, whose state is dropped."""
    return stream.withWatermark(ts, late).groupBy(*keys, F.window(ts, left, chunk).alias("w")).agg(F.count(F.lit(1)).alias("n"))


def sessions(stream: DataFrame, ts: str, gap: str, late: str, *keys: str) -> DataFrame:
    return stream.withWatermark(ts, late).groupBy(*keys, F.session_window(ts, gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))


def once_per_key(stream: DataFrame, ts: str, late: str, *keys: str) -> DataFrame:
    """First row of each key within the lateness, with state bounded by it."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def speed_stats(stream: DataFrame, group: str, seconds: str, length: str) -> DataFrame:
    """Running totals, extremes and ratio of two measures, in complete mode."""
    return stream.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(seconds), 4).alias("total"), F.round(F.min(seconds), 4).alias("least"), F.round(F.max(seconds), 4).alias("most"), F.round(F.sum(seconds) / F.sum(length), 6).alias("ratio"))


def agreed_words(state: tuple[list[str], int], words: list[str]) -> tuple[tuple[list[str], int], list[str]]:
    """New state (last hypothesis, words committed) and the words to commit: those beyond the committed ones on which two hypotheses in a row agree."""
    before, done = state
    same = 0
    for a, b in zip(before, words, strict=False):
        if a != b:
            break
        same += 1
    fresh = words[done:same] if same > done else []
    return (words, max(done, same)), fresh


def stable_prefix(stream: DataFrame, key: str, seq: str, text: str, idle: int | None = None, reset: str | None = None) -> DataFrame:
    """key, seq, words: what becomes final with each hypothesis of a growing text. State is one hypothesis for each key.

    reset: a text that is a command: it clears its key's state, and what was not yet final is dropped.
    idle: milliseconds of processing time after which a silent key's rest is given out with seq null and its state dropped, for a stream that goes on (a run over what is there now would not end with it). None keeps
    the state for ever, which is for a fixed set of keys only.
    """
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def run(k: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        words, done = (list(state.get[0]), state.get[1]) if state.exists else ([], 0)
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"key": [k[0]], "seq": pd.array([None], "Int64"), "words": [" ".join(words[done:])]})
            return
        out = []
        for row in pd.concat(list(frames)).sort_values(["seq", "text"]).itertuples():
            if reset is not None and row.text == reset:
                words, done = [], 0
                continue
            (words, done), fresh = agreed_words((words, done), (row.text or "").split())
            if fresh:
                out.append((k[0], row.seq, " ".join(fresh)))
        state.update((words, done))
        if idle:
            state.setTimeoutDuration(idle)
        yield pd.DataFrame(out, columns=["key", "seq", "words"]).astype({"seq": "Int64"})

    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle else GroupStateTimeout.NoTimeout
    rows = stream.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(seq).cast("long").alias("seq"), F.col(text).alias("text"))
    return rows.groupBy("key").applyInPandasWithState(run, "key string, seq long, words string", "words array<string>, done int", "append", timeout)


def drained(result: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Runs a streaming frame over all that is there now and gives what it has put out; files and checkpoint lie in the shared folder."""
    import uuid

    spark = result.sparkSession
    place = f"{shared_dir(spark)}/spoolwright/stream-{label}-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(f"{place}/out")

    query = result.writeStream.outputMode(mode).option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True).foreachBatch(keep).start()
    query.awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{place}/out")


def same_signature(spark: SparkSession, checkpoint: str, signature: str) -> None:
    """Marks a checkpoint with the signature of the work that its state belongs to; raises ValueError where it bears another one."""
    files, place = hadoop_path(spark, f"{checkpoint}.signature")
    if not files.exists(place):
        out = files.create(place, False)
        out.write(bytearray(signature.encode()))
        out.close()
        return
    found = spark.read.text(f"{checkpoint}.signature", wholetext=True).first()[0]
    if found != signature:
        raise ValueError(f"{checkpoint} belongs to {found}, not to {signature}")


def append_once(stream: DataFrame, key: str, out: str, seen: str, checkpoint: str, work: Callable[[DataFrame], DataFrame] = lambda d: d, signature: str | None = None) -> int:
    """Works each key off once, over any number of runs: every batch drops the keys that are done, and the stream's checkpoint skips the files that are. Gives the rows added. With a signature, a checkpoint of other work is refused."""
    added = [0]
    if signature is not None:
        same_signature(stream.sparkSession, checkpoint, signature)

    def step(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            added[0] += append_unseen(batch.sparkSession, work(batch), key, out, seen)

    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(step).start()
    query.awaitTermination()
    return added[0]


def word_totals(stream: DataFrame, text: str) -> DataFrame:
    """Running counts of texts, for counting that goes on where it stopped."""
    return stream.where(F.col(text).isNotNull()).groupBy(F.lower(text).alias("phrase")).agg(F.count(F.lit(1)).alias("n"), F.max(word_count(F.col(text))).alias("words"))
