"""Edit distances and error rates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolwright.functions.text import asr_key


def list_edits(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, most: np.ndarray, cells: int = 1 << 20) -> np.ndarray:
    """Edit distance of the i-th lists of numbers on both sides, for all i, as far as it is at most most[i]; more than that is given as some larger number. The numbers are above 0.

    a_starts, b_starts: where each list begins in the array, and the end. Only the cells within `most` of the diagonal are
    filled. Lists of similar width are computed together.
    """
    la, lb = np.diff(a_starts), np.diff(b_starts)
    out = most + 1
    order = np.flatnonzero(np.abs(la - lb) <= most)
    order = order[np.lexsort((la[order], lb[order], most[order]))]
    at = 0
    while at < len(order):
        rows = order[at : at + max(1, cells // int(max(lb[order[at]], 1) + 2 * most[order[at]] + 1))]
        rows = rows[most[rows] <= 2 * most[rows[0]] + 1]
        at += len(rows)
        k, width, height = int(most[rows].max()), int(lb[rows].max()), int(la[rows].max())
        # column c of the padded right side is item c - k, so that the band of row i is a slice
        right = np.zeros((len(rows), max(width, height) + 2 * k + 1), b.dtype)
        inside = np.arange(width) < lb[rows][:, None]
        right[:, k : k + width][inside] = b[(b_starts[rows][:, None] + np.arange(width))[inside]]
        band = np.arange(2 * k + 1, dtype=np.int64)
        far = np.int64(1 << 40)
        prev = np.broadcast_to(np.where(band >= k, band - k, far), (len(rows), 2 * k + 1)).copy()
        done = np.flatnonzero(la[rows] == 0)
        out[rows[done]] = lb[rows][done]
        for i in range(1, height + 1):
            left = a[np.minimum(a_starts[rows] + i - 1, max(len(a) - 1, 0))]
            column = band + i - k  # items of the right side used so far
            cur = prev + (right[:, i - 1 : i + 2 * k] != left[:, None])
            cur[:, :-1] = np.minimum(cur[:, :-1], prev[:, 1:] + 1)
            cur = np.where(column == 0, i, np.where(column < 0, far, cur))
            prev = np.minimum.accumulate(cur - band, axis=1) + band
            ends = np.flatnonzero(la[rows] == i)
            out[rows[ends]] = prev[ends, (lb - la)[rows][ends] + k]
    return out


@F.pandas_udf(T.IntegerType())
def word_edits(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Word edits between two normalised texts, a batch at a time (Spark's levenshtein knows characters only). Null for a null."""
    for refs, hyps in pairs:
        out = pd.Series(pd.NA, index=refs.index, dtype="Int32")
        both = refs.notna() & hyps.notna()
        out[both] = 0
        differ = both & (refs != hyps)
        if differ.any():
            sides = [[x.split() for x in side[differ]] for side in (refs, hyps)]
            starts = [np.r_[0, np.cumsum([len(x) for x in side])] for side in sides]
            number = pd.factorize(pd.Series([w for side in sides for x in side for w in x], dtype=object))[0] + 1
            a, b = number[: starts[0][-1]], number[starts[0][-1] :]
            # no list is further from another than its own or the other's length
            out[differ] = list_edits(a, starts[0], b, starts[1], np.maximum(np.diff(starts[0]), np.diff(starts[1])))
        yield out


def word_count(text: Column) -> Column:
    return F.when(text == "", 0).otherwise(F.size(F.split(text, " ")))


def rate(edits: Column, length: Column, hyp_length: Column) -> Column:
    """Edits by reference length; for an empty reference 0 if the hypothesis is empty too, else 1."""
    return F.when(length > 0, edits / length).otherwise(F.when(hyp_length > 0, 1.0).otherwise(0.0))


def error_rates(pairs: DataFrame, ref: str = "ref", hyp: str = "hyp", spaces: bool = True) -> DataFrame:
    """The pairs with ref_words, word_edits, wer, ref_chars, char_edits, cer, over the normalised texts. Nulls count as empty.

    spaces: whether blanks count as characters. Equal texts never reach Python.
    """
    norm = lambda c: F.coalesce(asr_key(F.col(c)), F.lit(""))
    squeeze = (lambda c: c) if spaces else (lambda c: F.replace(c, F.lit(" "), F.lit("")))
    rows = pairs.withColumns({"__r": norm(ref), "__h": norm(hyp)})
    rows = rows.withColumns({"ref_words": word_count(F.col("__r")), "__hw": word_count(F.col("__h")), "word_edits": word_edits("__r", "__h"), "__rc": squeeze(F.col("__r")), "__hc": squeeze(F.col("__h"))})
    rows = rows.withColumns({"ref_chars": F.length("__rc"), "char_edits": F.levenshtein("__rc", "__hc")})
    rows = rows.withColumns({"wer": rate(F.col("word_edits"), F.col("ref_words"), F.col("__hw")), "cer": rate(F.col("char_edits"), F.col("ref_chars"), F.length("__hc"))})
    return rows.drop("__r", "__h", "__hw", "__rc", "__hc")


def near_keywords(tokens: DataFrame, token: str, keywords: DataFrame, keyword: str, edits: int) -> DataFrame:
    """The rows joined with the keywords within the edits. Keywords are a short list of the caller's, refused above 10 000."""
    if keywords.limit(10_001).count() > 10_000:
        raise ValueError("more than 10 000 keywords")
    return tokens.join(F.broadcast(keywords), F.levenshtein(F.col(token), F.col(keyword), edits) >= 0)


@F.pandas_udf(T.DoubleType())
def similarity(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Ratio of matching blocks of two texts, lower case and blanks collapsed (Arrow batches)."""
    from difflib import SequenceMatcher

    norm = lambda s: " ".join((s or "").lower().split())
    for a, b in pairs:
        yield pd.Series([SequenceMatcher(None, norm(x), norm(y)).ratio() for x, y in zip(a, b, strict=True)])
