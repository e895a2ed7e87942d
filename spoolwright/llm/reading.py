"""Reading level of every document, by smoothed unigram models of the levels.

One word distribution is estimated for each level of the hand-rated documents, smoothed with that of all of them; a
document gets the level under which its words are likeliest. Layout is taken off first: cue times, log lines, headings
and speaker labels are no prose. A document is English if most of its words are known from the rated ones, whatever its
lang column says.

The model is fitted on at most MAX_RATED rated documents (the first in hash order), so what is sent to the tasks is
bounded; every document is scored by its whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVELS = (1, 2, 3, 4, 5)
BANDS = {1: "easy", 2: "easy", 4: "demanding", 5: "demanding"}
#: Rated documents used for fitting, and words kept of them, the most frequent first.
MAX_RATED = 20_000
MAX_WORDS = 300_000
MIN_WORDS = 80
#: Words in fewer rated documents count as unknown, for the level and for telling English (they are mostly names and slips).
LEAST_DOCUMENTS = 2
#: Part of a document's words that must be known for it to be English.
ENGLISH_SHARE = 0.5
#: Weight of the background distribution in each level's.
SMOOTHING = 0.05

# Lines that are no prose, and labels in front of prose.
MACHINE_LINE = re.compile(
    r"^(?:\s*(?:WEBVTT\b.*|NOTE\b\s*|STYLE\s*|\d+|#+\s.*|(?:\d+:)?\d+:\d\d[.,]\d+\s*-->.*|\[[\d:.,T\- ]+\]\s.*|\S*\w=\S+(?:\s+\S*=\S+)*)\s*)$", re.MULTILINE
)
LABEL = re.compile(r"^\s*(?:[-*•]\s+|(?:[A-Z]+_?\d+|SPEAKER\w*)\s*:\s*)+", re.MULTILINE)
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")


def prose_words(text: str | None) -> list[str]:
    """The words of the prose, lower case, contractions as one word."""
    if not text:
        return []
    text = text.replace("\r", "\n") if "\r" in text else text
    return WORD.findall(LABEL.sub("", MACHINE_LINE.sub("", text)).replace("’", "'").lower())


def rated(labels: DataFrame, most: int = MAX_RATED) -> DataFrame:
    """doc_id, level (median of its ratings, repeated rows once), at most `most` documents in hash order. Null and unknown levels are ignored."""
    once = labels.where(F.col("level").isin(*LEVELS)).dropDuplicates(["doc_id", "level", "rater"])
    return once.groupBy("doc_id").agg(F.expr("percentile(level, 0.5)").alias("level")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


class Model:
    """Log probabilities of the known words under each level; row 0 is for unknown words and weighs nothing."""

    def __init__(self, counts: dict[str, np.ndarray]) -> None:
        words = sorted(counts)
        table = np.array([counts[w] for w in words], float).reshape(len(words), len(LEVELS))
        whole = table.sum(axis=1) + 1e-9
        background = whole / whole.sum() if len(words) else whole
        level = table / np.maximum(table.sum(axis=0), 1)
        mixed = (1 - SMOOTHING) * level + SMOOTHING * background[:, None]
        self.weights = np.vstack([np.zeros(len(LEVELS)), np.log(mixed)]) if len(words) else np.zeros((1, len(LEVELS)))
        self.number = {w: i for i, w in enumerate(words, 1)}
        self.rated = table.sum(axis=0) > 0 if len(words) else np.zeros(len(LEVELS), bool)

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of prose, known words, and log likelihood by level of each text."""
        get, words, parts = self.number.get, np.zeros(len(texts), np.int64), []
        for i, text in enumerate(texts):
            found = prose_words(text)
            words[i] = len(found)
            parts.append(np.fromiter((get(w, 0) for w in found), np.int64, len(found)))
        at = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        total = np.vstack([np.zeros(len(LEVELS)), np.cumsum(self.weights[at], axis=0)]) if len(at) else np.zeros((1, len(LEVELS)))
        known = np.r_[0, np.cumsum(at > 0)]
        ends = np.cumsum(words)
        likely = total[ends] - total[ends - words]
        likely[:, ~self.rated] = -np.inf
        return words, known[ends] - known[ends - words], likely


def fitted(documents: DataFrame, labels: DataFrame, most: int = MAX_RATED) -> Model:
    """The model of the rated documents. Their number is bounded, so their ids are broadcast and no text is shuffled."""
    chosen = rated(labels, most)
    texts = documents.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "level")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, np.ndarray] = {}
        docs: Counter[str] = Counter()
        for batch in batches:
            for text, level in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                # a level between two counts for both, half each
                share = np.maximum(0, 1 - np.abs(np.array(LEVELS) - level))
                own = Counter(prose_words(text))
                docs.update(own.keys())
                for w, n in own.items():
                    words[w] = words.get(w, 0) + n * share
        yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array([docs[w] for w in words], pa.int64()), pa.array([x.tolist() for x in words.values()], pa.list_(pa.float64()))], names=["word", "docs", "n"])

    parts = texts.mapInArrow(count, "word string, docs long, n array<double>")
    sums = [F.sum(F.col("n")[i]).alias(f"n{i}") for i in range(len(LEVELS))]
    known = parts.groupBy("word").agg(F.sum("docs").alias("docs"), *sums).where(F.col("docs") >= LEAST_DOCUMENTS).orderBy(F.desc("docs"), "word").limit(MAX_WORDS)
    return Model({r["word"]: np.array([r[f"n{i}"] for i in range(len(LEVELS))]) for r in known.toLocalIterator()})


def levels(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, words (of prose), english (boolean), level (null without known words or a rated document), band ('easy', 'demanding' or null).

    One row for each row of documents. Null and empty texts have 0 words and no level.
    """
    spread = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                words, known, likely = spread.value.scores(part.column(1).to_pylist())
                level = np.array(LEVELS)[likely.argmax(axis=1)]
                none = (known == 0) | ~np.isfinite(likely.max(axis=1))
                english = known > ENGLISH_SHARE * words
                band = [None if no else BANDS.get(x) for x, no in zip(level.tolist(), none.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(words), pa.array(english & (words > 0)), pa.array(level.astype(np.int32), mask=none), pa.array(band, pa.string())], names=["doc_id", "words", "english", "level", "band"]
                )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, words long, english boolean, level int, band string")


def banded(scored: DataFrame, least_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, band of the English documents with enough prose at an easy or a demanding level."""
    return scored.where(F.col("english") & (F.col("words") >= least_words) & F.col("band").isNotNull()).select("doc_id", "band")
