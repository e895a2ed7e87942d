"""The same or nearly the same records across splits.

Content-defined chunks of the normalised records are joined across the splits by their digests, the lengths of the
chunks that two records share are summed to overlap fractions, and a word edit distance confirms what is left.

A rolling hash runs over the bytes of a record's word list; a chunk ends at the word at whose end the hash, masked, is
zero, so chunks are cut by content and fall into step again after an edit. An edit changes the cuts whose window it
reaches and the chunks between them. How many chunks the tolerated number of edits can change at most is worked out
for every record from its own chunks ("lost"); all others return in any record that is near. Chunks are put in one global
order, rarest first, by counters over the whole corpus. Then two near records share at least two of their lost + 2 first
chunks, and pairs of these are the keys of the join. A record that has too few chunks for that goes on with chunks of
one word each, of which an edit changes one; a pair is missed by the longer chunks only if both of its records have too
few. So nothing is capped and no near pair is left out. Records of more than PAIR_WORDS words use single chunks of the
first lost + 1 as keys, because the pairs would be too many.

The counters are a table of SKETCH integers whatever the corpus, so it can be sent to all tasks; chunks that share a
counter only change the order, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoolwright.functions.paths import file_key, root_pairs
from spoolwright.lineage import cut
from spoolwright.llm.consistent import consistent_sql, duck_batches
from spoolwright.operators.edits import list_edits

TRAIN, EVALUATION = "train", ("validation", "test")
MIN_WORDS = 8
#: The tolerated edits, as a fraction of the longer list: 3/20.
EDITS = (3, 20)
#: Bytes in the window of the rolling hash. With three, it reaches past a word and the blank before it only at words of one byte.
WINDOW = 3
#: A chunk ends where the rolling hash has none of these bits: two words on average. Longer chunks would too often all be lost to 15 % of edits.
MASK = 1
SKETCH = 1 << 18
PAIR_WORDS = 64
BLANK = 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def word_lists(df: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """row_id, train (boolean), n, d1, d2 (digest of the word list), words (joined by blanks) of the rows with enough words. df: row_id, train, text."""
    listed = r"""list_filter(regexp_extract_all(replace(replace(lower(z), '''', ''), '’', ''), '[\pL\pN]+'), lambda w: w <> '')"""
    sql = f"""SELECT row_id, train, n::INTEGER AS n, (hash(words) >> 1)::BIGINT AS d1, (hash(words || '|') >> 1)::BIGINT AS d2, words
        FROM (SELECT row_id, train, len(l) AS n, array_to_string(l, ' ') AS words FROM (SELECT row_id, train, {listed} AS l FROM ({consistent_sql("batch", "text", "z")}) WHERE z IS NOT NULL))
        WHERE n >= {min_words}"""
    schema = pa.schema([("row_id", pa.int64()), ("train", pa.bool_()), ("n", pa.int32()), ("d1", pa.int64()), ("d2", pa.int64()), ("words", pa.string())])
    return df.select("row_id", "train", "text").mapInArrow(lambda it: duck_batches(it, sql, schema), "row_id long, train boolean, n int, d1 long, d2 long, words string")


def _mixed(a: np.ndarray, b: np.ndarray | int = 0) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (a ^ (np.asarray(b, np.uint64) * _ODD)) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) + np.asarray(b, np.uint64)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.r_[np.uint64(1), np.full(max(n - 1, 0), base)])


class Records(NamedTuple):
    """Word lists of several records, one after the other."""

    h: np.ndarray  # hash of each word
    starts: np.ndarray  # where the words of each record begin, and the end
    rolled: np.ndarray  # the rolling hash at each word's end
    reach: np.ndarray  # the last word at whose end the window still reaches this one


def records(texts: pa.Array | pa.ChunkedArray, window: int = WINDOW) -> Records:
    """The words (joined by blanks, none empty) of each text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    texts = texts.cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]] if at[-1] > at[0] else np.zeros(0, np.uint8)
    at = at - at[0]
    if not len(data):
        none = np.zeros(0, np.uint64)
        return Records(none, np.zeros(len(at), np.int64), none, np.zeros(0, np.int64))
    blank = data == BLANK
    final = np.zeros(len(data), bool)
    final[at[1:][at[1:] > at[:-1]] - 1] = True
    ends = np.flatnonzero(~blank & (np.r_[blank[1:], True] | final))
    begins = np.flatnonzero(~blank & np.r_[True, blank[:-1] | final[:-1]])
    starts = np.searchsorted(ends, at)
    count = np.diff(starts)
    own = np.repeat(at[:-1], count)
    with np.errstate(over="ignore"):
        letters = data.astype(np.uint64) + np.uint64(1)
        sums = np.r_[np.uint64(0), np.cumsum(letters * _powers(_ODD, len(data)))]
        h = _mixed((sums[ends + 1] - sums[begins]) * _powers(_BACK, len(data))[begins], 1)
        rolled = np.zeros(len(ends), np.uint64)
        for back in range(window):
            rolled = rolled * _ODD + np.where(ends - back >= own, letters[np.maximum(ends - back, 0)], np.uint64(0))
    reach = np.minimum(np.searchsorted(ends, ends + window - 1, side="right") - 1, np.repeat(starts[1:], count) - 1)
    return Records(h, starts, _mixed(rolled, 2) >> np.uint64(20), reach)


class Chunks(NamedTuple):
    """The chunks of several records, one after the other."""

    digest: np.ndarray
    length: np.ndarray  # in words
    begins: np.ndarray  # where the chunks of each record begin, and the end
    lost: np.ndarray  # for each record, how many of its chunks can be missing at most in a record within the tolerated edits
    least: np.ndarray  # for each record, the words that the others have together at least


def _largest(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Running sums of each owner's values, largest first, in one array with a zero in front."""
    return np.r_[0, np.cumsum(values[np.lexsort((-values, owner))])]


def chunked(r: Records, mask: int = MASK, edits: tuple[int, int] = EDITS) -> Chunks:
    """Cuts each record where the rolling hash has none of the mask's bits, and at its end. With a mask of 0 every word is a chunk."""
    num, den = edits
    n = np.diff(r.starts)
    owner, word = np.repeat(np.arange(len(n)), n), np.arange(len(r.h))
    ends = (r.rolled & np.uint64(mask)) == 0
    final = np.zeros(len(r.h), bool)
    final[r.starts[1:][n > 0] - 1] = True
    last = np.flatnonzero(ends | final)
    first = np.r_[0, last[:-1] + 1][: len(last)]
    begins = np.searchsorted(first, r.starts)
    length = last - first + 1
    with np.errstate(over="ignore"):
        place = word - np.repeat(first, length)
        digest = np.add.reduceat(r.h * _powers(_ODD, int(length.max()))[place], first) if len(first) else r.h
    digest = _mixed(digest, length.astype(np.uint64))
    if mask:
        nth = np.repeat(np.arange(len(first)), length)  # the chunk of each word
        after = (ends & ~final)[r.reach]  # the chunk behind the last cut in doubt begins elsewhere without it
        changed = nth[r.reach] - nth + 1 + after
        follower = np.minimum(word + 1, np.repeat(r.starts[1:], n) - 1)
        inserted = np.where(r.reach > word, nth[r.reach] - nth[follower] + 1 + after, 1)
    else:
        changed, inserted = np.ones(len(r.h), np.int64), np.zeros(len(r.h), np.int64)
    most, most_in = _largest(changed, owner), _largest(inserted, owner)
    upto = lambda sums, k: sums[r.starts[:-1] + np.clip(k, 0, n)] - sums[r.starts[:-1]]
    # of a long record every edit may be of the worst kind; an insertion loses no more than a change of the word behind it
    lost = np.where(n > PAIR_WORDS, upto(most, n * den // (den - num) * num // den), 0)
    short = np.minimum(n, PAIR_WORDS)
    for more in range(int(short.max(initial=0)) * num // (den - num) + 1):  # words by which the other record is longer; so many edits are insertions
        k = (n + more) * num // den
        lost = np.maximum(lost, np.where((n <= PAIR_WORDS) & (k >= more), upto(most, k - more) + upto(most_in, np.full(len(n), more)), 0))
    count = np.diff(begins)
    lost = np.minimum(lost, count)
    shortest = np.r_[0, np.cumsum(length[np.lexsort((length, np.repeat(np.arange(len(n)), count)))])]
    return Chunks(digest, length, begins, lost, shortest[begins[1:] - lost] - shortest[begins[:-1]])


def _tables(batches: Iterator[pa.RecordBatch], rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _counters(digests: np.ndarray, size: int) -> np.ndarray:
    return (digests & np.uint64(size - 1)).astype(np.int64)


def counted(reps: DataFrame, mask: int = MASK, size: int = SKETCH) -> np.ndarray:
    """How often the chunks, and the single words, of each counter occur in all records. Each task adds up its own part before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in _tables(batches):
            r = records(batch.column(0))
            for level in {mask, 0}:
                total += np.bincount(_counters(chunked(r, level).digest, size), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["at", "n"])

    rows = reps.select("words").mapInArrow(count, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size, np.int64)
    out[rows["at"].to_numpy().astype(np.int64)] = rows["n"].to_numpy().astype(np.int64)
    return out


def _ranked(c: Chunks, sketch: np.ndarray) -> np.ndarray:
    """Each record's chunks in the global order, rarest first. The i-th copy of a chunk in a record is a chunk of its own."""
    size = np.diff(c.begins)
    owner = np.repeat(np.arange(len(size)), size)
    h = c.digest[np.lexsort((c.digest, sketch[_counters(c.digest, len(sketch))], owner))]
    fresh = np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])] if len(h) else np.zeros(0, bool)
    run = np.arange(len(h)) - np.maximum.accumulate(np.where(fresh, np.arange(len(h)), 0))
    return _mixed(h, run.astype(np.uint64))


def keys(reps: DataFrame, sketch: np.ndarray, mask: int = MASK, edits: tuple[int, int] = EDITS, pair_words: int = PAIR_WORDS) -> DataFrame:
    """key, row_id, n, bits: the join keys of each record, and a bitmap of its words of which an edit can change two bits at most."""
    num, den = edits
    spread = reps.sparkSession.sparkContext.broadcast(sketch)
    levels = (mask, 0) if mask else (0,)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _tables(batches):
            ids, r = batch.column(0).to_numpy(), records(batch.column(1))
            n = np.diff(r.starts)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (r.h >> np.uint64(58)), r.starts[:-1])
            longest = n * den // (den - num)
            # pairs of chunks between records of at most pair_words, single ones where one of the two may be longer
            open_ = {2: n <= pair_words, 1: longest > pair_words}
            for level in levels:
                if not any(x.any() for x in open_.values()):
                    break
                c = chunked(r, level, edits)
                token, have = _ranked(c, spread.value), np.diff(c.begins)
                for joined, ok in open_.items():
                    take = np.minimum(c.lost + joined, have)
                    for p in np.unique(take[ok]):
                        rows = np.flatnonzero(ok & (take == p))
                        block = token[c.begins[rows][:, None] + np.arange(p)]
                        if joined == 2 and p > 1:
                            i, j = np.triu_indices(p, 1)
                            found = _mixed(block[:, i], level) + _mixed(block[:, j], 7)
                        else:
                            found = _mixed(block, 9 + 2 * joined + (level == 0))
                        each = found.shape[1]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(found.ravel().view(np.int64)), pa.array(np.repeat(ids[rows], each)), pa.array(np.repeat(n[rows], each).astype(np.int32)), pa.array(np.repeat(bits[rows], each).view(np.int64))],
                            names=["key", "row_id", "n", "bits"],
                        )
                    open_[joined] = ok & (have - c.lost < joined)

    return reps.select("row_id", "words").mapInArrow(emit, "key long, row_id long, n int, bits long")


def shared_words(a: Chunks, b: Chunks) -> np.ndarray:
    """Summed lengths of the chunks that the i-th records of both sides share (with their copies)."""
    rows = len(a.begins) - 1
    owner = np.r_[np.repeat(np.arange(rows), np.diff(a.begins)), np.repeat(np.arange(rows), np.diff(b.begins))]
    side = np.r_[np.ones(len(a.digest), np.int64), np.zeros(len(b.digest), np.int64)]
    h, length = np.r_[a.digest, b.digest], np.r_[a.length, b.length]
    if not len(h):
        return np.zeros(rows, np.int64)
    order = np.lexsort((h, owner))
    h, owner, side, length = h[order], owner[order], side[order], length[order]
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])])
    both = np.minimum(np.add.reduceat(side, first), np.add.reduceat(1 - side, first))
    return np.bincount(owner[first], weights=both * length[first], minlength=rows).astype(np.int64)


def near_classes(reps: DataFrame, mask: int = MASK, edits: tuple[int, int] = EDITS) -> DataFrame:
    """eval_id, train_id, edits, eval_overlap, train_overlap: classes of equal word lists of the two sides that are within the tolerated edits.

    The overlaps are the parts of the two records, in words, that lie in shared chunks. reps: row_id, train, n, words,
    one row for each class and side, already written (it is read several times).
    """
    num, den = edits
    sketch = counted(reps, mask)
    e, t = (keys(reps.where(side), sketch, mask, edits).alias(name) for side, name in (("not train", "e"), ("train", "t")))
    k = F.floor(F.greatest(F.col("e.n"), F.col("t.n")) * num / den)
    near = (F.abs(F.col("e.n") - F.col("t.n")) <= k) & (F.bit_count(F.col("e.bits").bitwiseXOR(F.col("t.bits"))) <= 2 * k)
    # merged, never broadcast: Spark takes the keys for as small as the records that they come from
    pairs = e.join(t.hint("merge"), (F.col("e.key") == F.col("t.key")) & near).select(F.col("e.row_id").alias("eval_id"), F.col("t.row_id").alias("train_id")).distinct()
    words = reps.select("row_id", "words")
    full = pairs.join(words.withColumnsRenamed({"row_id": "eval_id", "words": "a"}), "eval_id").join(words.withColumnsRenamed({"row_id": "train_id", "words": "b"}), "train_id")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _tables(batches):
            ra, rb = records(batch.column(2)), records(batch.column(3))
            na, nb = np.diff(ra.starts), np.diff(rb.starts)
            ca, cb = chunked(ra, mask, edits), chunked(rb, mask, edits)
            shared = shared_words(ca, cb)
            most = np.maximum(na, nb) * num // den
            # near records share at least what the edits can't reach; the others need no edit distance
            far = np.where(shared >= np.maximum(ca.least, cb.least), 0, most + 1)
            ask = np.flatnonzero(far == 0)
            some_a, some_b = (pa.array(batch.column(i)).take(pa.array(ask)) for i in (2, 3))
            sa, sb = records(some_a), records(some_b)
            far[ask] = list_edits(sa.h, sa.starts, sb.h, sb.starts, most[ask])
            keep = far <= most
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep)), pa.array(far[keep].astype(np.int32)), pa.array((shared / na)[keep]), pa.array((shared / nb)[keep])],
                names=["eval_id", "train_id", "edits", "eval_overlap", "train_overlap"],
            )

    return full.select("eval_id", "train_id", "a", "b").mapInArrow(check, "eval_id long, train_id long, edits int, eval_overlap double, train_overlap double")


def _sided(rows: DataFrame) -> DataFrame:
    """The rows of the three splits, with train (boolean). A row without an id can't be named in a pair and is left out."""
    return rows.where(F.col("row_id").isNotNull()).where(F.col("split_name").isin(TRAIN, *EVALUATION)).withColumn("train", F.col("split_name") == TRAIN)


def path_digests(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """row_id, train, d: the digest of the file and the stretch that a row names, the whole record as one chunk. Rows without a path are left out."""
    key = F.struct(file_key(F.col("audio_path"), root_pairs(roots)).alias("f"), *[(F.col(c) + 0.0).alias(c) for c in ("start_sec", "end_sec")])  # -0.0 is 0.0
    return cut(_sided(rows).where("audio_path is not null").select("row_id", "train", F.unhex(F.md5(F.to_json(key))).alias("d")), "path-digests")  # worked out once for a row


def path_pairs(marked: DataFrame) -> DataFrame:
    """eval_id, train_id of rows that name the same stretch of the same file. marked: path_digests()."""
    e, t = marked.where("not train").alias("e"), marked.where("train").alias("t")
    return e.join(t, F.col("e.d") == F.col("t.d")).select(F.col("e.row_id").alias("eval_id"), F.col("t.row_id").alias("train_id"))


def text_classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row_id, train, d1, d2 of every row with enough words), and (row_id, train, n, words, d1, d2: one row for each word list and side)."""
    texts = cut(word_lists(_sided(rows)), "word-lists")
    return texts, cut(texts.dropDuplicates(["d1", "d2", "train"]), "word-list-classes")


def overlapping_rows(rows: DataFrame, roots: DataFrame, mask: int = MASK) -> DataFrame:
    """eval_id, train_id, by_path, by_text, edits, eval_overlap, train_overlap: every pair of an evaluation row and a train row that are the same or nearly so.

    rows: manifest_rows. Null paths and null, empty or short texts match nothing that way; null or equal times match as
    equal. Repeated rows are rows of their own. Columns other than the used ones are ignored.
    """
    texts, reps = text_classes(rows)
    near = near_classes(reps, mask)
    name = reps.select("row_id", "d1", "d2")
    for side in ("eval", "train"):
        near = near.join(name.withColumnsRenamed({"row_id": f"{side}_id", "d1": f"{side}_d1", "d2": f"{side}_d2"}), f"{side}_id").drop(f"{side}_id")
    for side, only in (("eval", "not train"), ("train", "train")):
        members = texts.where(only).select(F.col("row_id").alias(f"{side}_id"), F.col("d1").alias(f"{side}_d1"), F.col("d2").alias(f"{side}_d2"))
        near = near.join(members, [f"{side}_d1", f"{side}_d2"])
    by_text = near.select("eval_id", "train_id", F.lit(False).alias("by_path"), F.lit(True).alias("by_text"), "edits", "eval_overlap", "train_overlap")
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("edits", "int"), ("eval_overlap", "double"), ("train_overlap", "double"))]
    by_path = path_pairs(path_digests(rows, roots)).select("eval_id", "train_id", F.lit(True).alias("by_path"), F.lit(False).alias("by_text"), *nothing)
    both = by_text.unionByName(by_path).groupBy("eval_id", "train_id")
    return both.agg(F.max("by_path").alias("by_path"), F.max("by_text").alias("by_text"), *[F.max(c).alias(c) for c in ("edits", "eval_overlap", "train_overlap")])


def overlap_report(rows: DataFrame, roots: DataFrame, mask: int = MASK) -> DataFrame:
    """split_name, source, pairs, rows, overlap: for each evaluation split and source how many pairs there are, how many rows are in one, and the mean over these of the part of the row that its best partner shares (a row found by its path counts whole). A null source is a group.

    Counted from the sizes of classes of equal word lists and equal paths; no pair of rows is formed.
    """
    texts, reps = text_classes(rows)
    near = cut(near_classes(reps, mask), "near-classes")
    named = reps.select(F.col("row_id").alias("class"), "d1", "d2", "train")
    of = texts.select("row_id", "train", "d1", "d2").join(named, ["d1", "d2", "train"]).select("row_id", "train", "class")
    of = cut(of, "row-classes")
    size = of.where("train").groupBy(F.col("class").alias("train_id")).agg(F.count(F.lit(1)).alias("size"))
    by_class = near.join(size, "train_id").groupBy(F.col("eval_id").alias("class")).agg(F.sum("size").alias("by_text"), F.max("eval_overlap").alias("overlap"))
    marked = path_digests(rows, roots)
    placed = cut(marked.join(of.select("row_id", "class"), "row_id", "left"), "row-paths")
    sizes = placed.where("train").groupBy("d", "class").agg(F.count(F.lit(1)).alias("size"))
    by_path = sizes.groupBy("d").agg(F.sum("size").alias("by_path"))
    # pairs that are found both ways count once: class and path of the one against class and path of the other
    kinds = placed.where("not train and class is not null").select("d", F.col("class").alias("eval_id")).distinct()
    twice = kinds.join(sizes.where("class is not null").withColumnRenamed("class", "train_id"), "d").join(near.select("eval_id", "train_id"), ["eval_id", "train_id"])
    twice = twice.groupBy("d", F.col("eval_id").alias("class")).agg(F.sum("size").alias("twice"))
    found = (
        rows.where(F.col("row_id").isNotNull() & F.col("split_name").isin(*EVALUATION)).select("row_id", "split_name", "source")
        .join(of.where("not train").select("row_id", F.col("class").alias("own")), "row_id", "left")
        .join(placed.where("not train").select("row_id", "d"), "row_id", "left")
        .join(by_class.withColumnRenamed("class", "own"), "own", "left")
        .join(by_path, "d", "left")
        .join(twice.withColumnRenamed("class", "own"), ["d", "own"], "left")
    )
    none = lambda c: F.coalesce(F.col(c), F.lit(0))
    counted_ = found.select("split_name", "source", (none("by_text") + none("by_path") - none("twice")).alias("n"), F.when(none("by_path") > 0, 1.0).otherwise(F.coalesce("overlap", F.lit(0.0))).alias("o")).where("n > 0")
    return counted_.groupBy("split_name", "source").agg(F.sum("n").alias("pairs"), F.count(F.lit(1)).alias("rows"), F.round(F.avg("o"), 4).alias("overlap"))
