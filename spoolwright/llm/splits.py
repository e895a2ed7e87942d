"""Splits that keep all rows of one original recording together.

Rows lead to their recording directly or by their base row, which may lead on. These links form a graph; Borůvka-style
contraction (every component takes its least edge, components along the taken edges become one) builds a spanning
forest, which is written to the shared folder round by round. The roots, with their sizes, are stratified by size band
and dealt to the splits systematically.

Nodes are 64-bit hashes of recording keys and uids. Two of n nodes share a hash with a chance of n * n / 2**65; such a
pair would only be kept together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoolwright.functions.paths import file_key, root_pairs, without_extension
from spoolwright.lineage import cut
from spoolwright.operators.intervals import whole_ms
from spoolwright.operators.lookup import containing_spans, joined_apart

SPLITS = (("train", 0.8), ("validation", 0.1), ("test", 0.1))
#: Stretches of a packed file are looked up in bins of this length.
BIN_MS = 60_000
#: Groups of more than one in so many of all rows are placed one by one; there can't be more of them than this number.
LARGE = 1000
#: Cells in which the ranks of the smaller groups of a size band are counted.
CELLS = 1024


def _node(kind: str, key: Column) -> Column:
    return F.when(key.isNotNull() & (key != ""), F.xxhash64(F.lit(kind), key))


def recording_nodes(rows: DataFrame, batch_map: DataFrame, roots: DataFrame) -> DataFrame:
    """row_id, split_name, uid_node, rec_node (of the recording, where the row leads to one directly), base_node (of the base uid of an augmented row without it).

    A recording is named by source_audio, else by audio_path under chunks/, else, for audio_path under batches/, by the
    stretch of batch_map that contains the row's. Where several do, the least key counts. Rows of batch_map without
    length are ignored, as are null and empty names.
    """
    pairs = root_pairs(roots)
    some = lambda c: F.nullif(c, F.lit(""))
    # in steps, so that no long expression is worked out more than once for a row
    keyed = rows.select(
        "row_id", "split_name", "uid", F.trim("base_uid").alias("base"), F.coalesce("aug_stage", F.lit("")).alias("stage"), whole_ms(F.col("start_sec")).alias("s"), whole_ms(F.col("end_sec")).alias("e"),
        file_key(F.col("audio_path"), pairs).alias("path"), without_extension(file_key(F.col("source_audio"), pairs)).alias("source"),
    )
    folder = F.regexp_extract("path", r"^(?:[^/]*/)*?(chunks|aug|batches)/", 1)
    known = keyed.withColumn("folder", F.coalesce(folder, F.lit("")))
    cut_from = F.when(F.col("folder") == "chunks", F.regexp_replace("path", r"(^|/)chunks/([^/]+)/(.+)__chunk\d+(?:__[^/]*?)?(?:\.[^./]*)?$", "$1recordings/$2/$3"))
    made_of = F.when(F.col("folder") == "aug", F.regexp_extract("path", r"(?:^|/)aug/([^/_]+)_[^/_]+__[^/]*$", 1))
    led = known.withColumns({"cut_from": cut_from, "made_of": made_of})
    recording = F.coalesce(some(F.col("source")), F.when(F.col("cut_from") != F.col("path"), F.col("cut_from")))
    augmented = (F.col("stage") != "") | (F.col("folder") == "aug") | F.coalesce(F.col("base") != F.col("uid"), F.lit(False))
    based = led.withColumns({"recording": recording, "base": F.when(augmented, F.coalesce(some(F.col("base")), some(F.col("made_of"))))})
    named = cut(
        based.select(
            "row_id", "split_name", _node("u", F.col("uid")).alias("uid_node"), _node("r", F.col("recording")).alias("rec_node"), F.when(~F.col("base").eqNullSafe(F.col("uid")), _node("u", F.col("base"))).alias("base_node"),
            F.when((F.col("folder") == "batches") & F.col("recording").isNull(), F.col("path")).alias("batch"), "s", "e",
        ),
        "row-keys",
    )
    packed, others = named.where("batch is not null"), named.where("batch is null")
    stretches = (
        batch_map.select(file_key(F.col("batch_file"), pairs).alias("batch"), _node("r", without_extension(file_key(F.col("original_file"), pairs))).alias("rec"), whole_ms(F.col("start_sec")).alias("ms"), whole_ms(F.col("end_sec")).alias("me"))
        .where("me > ms and rec is not null")
        .distinct()
    )
    within = containing_spans(packed.select("row_id", "batch", "s", "e"), stretches, "batch", "s", "ms", "me", BIN_MS).where("e <= me").groupBy("row_id").agg(F.min("rec").alias("rec"))
    columns = ["row_id", "split_name", "uid_node", "rec_node", "base_node"]
    found = cut(packed.drop("rec_node").join(within, "row_id", "left").withColumnRenamed("rec", "rec_node").select(*columns), "packed-rows")
    return others.select(*columns).unionByName(found).withColumn("base_node", F.when(F.col("rec_node").isNull(), F.col("base_node")))


def links(nodes: DataFrame) -> DataFrame:
    """a, b: from each uid that an augmented row needs to the recording or the further uid that its own rows lead to."""
    needed = nodes.where("base_node is not null").select(F.col("base_node").alias("uid_node")).distinct()
    return nodes.where("rec_node is not null or base_node is not null").join(needed, "uid_node", "left_semi").select(F.col("uid_node").alias("a"), F.coalesce("rec_node", "base_node").alias("b")).where("a <> b").distinct()


def spanning_forest(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, root) of every node of the edges, and (a, b) of the edges of the forest.

    edges: a, b (long), in any direction and repeated; rows with a null and loops are ignored. An empty table gives two
    empty ones. The root is the least node of the last component pair that met. Each round at least halves the
    components that still have edges, so the rounds grow as the logarithm of the longest chain.
    """
    clean = edges.where("a is not null and b is not null and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    # x and y: the components of the original ends a and b
    live = cut(clean.select("a", "b", F.col("a").alias("x"), F.col("b").alias("y"), F.xxhash64("a", "b").alias("w")), "forest-edges")
    steps, taken = [], []
    while not live.isEmpty():
        ends = live.select(F.col("x").alias("v"), F.col("y").alias("o"), "w", "a", "b").unionByName(live.select(F.col("y").alias("v"), F.col("x").alias("o"), "w", "a", "b"))
        least = cut(ends.groupBy("v").agg(F.min(F.struct("w", "a", "b", "o")).alias("m")).select("v", "m.o", "m.a", "m.b"), "forest-least")
        taken.append(least.select("a", "b"))
        # two components that took the same edge: the lesser one is the root of what hangs together now
        other = least.select(F.col("v").alias("o"), F.col("o").alias("back"))
        up = cut(least.select("v", "o").join(other, "o", "left").select("v", F.when((F.col("back") == F.col("v")) & (F.col("v") < F.col("o")), F.col("v")).otherwise(F.col("o")).alias("r")), "forest-up")
        while True:
            further = up.select(F.col("v").alias("r"), F.col("r").alias("rr"))
            jumped = cut(joined_apart(up, further, "r").select("v", F.col("rr").alias("r"), (F.col("rr") != F.col("r")).alias("moved")), "forest-jump")
            up = jumped.select("v", "r")
            if jumped.where("moved").isEmpty():
                break
        steps.append(up)
        for end in ("x", "y"):
            live = live.join(up.withColumnsRenamed({"v": end, "r": f"{end}r"}), end).drop(end).withColumnRenamed(f"{end}r", end)
        live = cut(live.where("x <> y"), "forest-edges")
    spark = edges.sparkSession
    if not steps:
        return spark.createDataFrame([], "node long, root long"), spark.createDataFrame([], "a long, b long")
    roots = steps[0].select(F.col("v").alias("node"), F.col("r").alias("root"))
    for up in steps[1:]:
        roots = roots.join(up.withColumnsRenamed({"v": "root", "r": "next"}), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    tree = taken[0]
    for more in taken[1:]:
        tree = tree.unionByName(more)
    return cut(roots, "forest"), cut(tree.distinct(), "forest-tree")


def grouped_rows(rows: DataFrame, batch_map: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row_id, split_name, node, leads: whether the row leads anywhere), and (node, root, recorded: whether its component holds a recording, rows, splits: those of its component's rows that lead there)."""
    nodes = recording_nodes(rows, batch_map, roots)
    forest, _ = spanning_forest(links(nodes))
    lead = F.coalesce("rec_node", "base_node")
    placed = nodes.select("row_id", "split_name", F.coalesce(lead, "uid_node", F.xxhash64(F.lit("row"), "row_id")).alias("node"), lead.isNotNull().alias("leads"), F.col("rec_node").isNotNull().alias("direct"))
    # one row for each node and split before anything of the size of the rows is shuffled
    summed = placed.groupBy("node", "split_name", "leads", "direct").agg(F.count(F.lit(1)).alias("n"))
    rooted = summed.join(forest, "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = rooted.groupBy("root").agg(F.max("direct").alias("recorded"), F.sum("n").alias("rows"), F.collect_set(F.when(F.col("leads"), F.col("split_name"))).alias("splits"))
    of = rooted.select("node", "root").distinct().join(groups, "root")
    return placed, cut(of, "row-groups")


def mixed_recordings(rows: DataFrame, batch_map: DataFrame, roots: DataFrame) -> DataFrame:
    """row_id of every row whose recording has rows with two or more different non-null splits. The row's own split may be null; rows that lead to no recording are left out; repeated rows count like others."""
    placed, groups = grouped_rows(rows, batch_map, roots)
    mixed = groups.where(F.col("recorded") & (F.size("splits") > 1)).select("node")
    return joined_apart(placed.where("leads"), mixed, "node", "left_semi").select("row_id")


def dealt_roots(groups: DataFrame, shares: tuple[tuple[str, float], ...] = SPLITS) -> DataFrame:
    """root, split: every group's split, so that the rows come as near to the shares as the groups allow.

    groups: root, rows. The few groups above a thousandth of all rows (LARGE at most can be) are placed on the driver,
    largest first, where most is missing. The others are dealt band by band (quarter powers of two of their size), in hash
    order, at the rates that fill what is missing.
    """
    total = groups.agg(F.sum("rows")).first()[0] or 0
    large = groups.where(F.col("rows") * LARGE > total).select("root", "rows").orderBy(F.desc("rows"), "root").limit(LARGE).collect()
    missing = {name: share * total for name, share in shares}
    fixed = []
    for g in large:
        name = max(missing, key=lambda s: (missing[s], s))
        missing[name] -= g.rows
        fixed.append((g.root, name))
    small = groups.where(F.col("rows") * LARGE <= total)
    want = {name: max(0.0, x) for name, x in missing.items()}
    whole = sum(want.values()) or 1.0
    banded = small.select("root", F.floor(4 * F.log2(F.col("rows"))).cast("int").alias("band"), F.xxhash64(F.lit("deal"), "root").alias("h")).withColumn("cell", F.pmod(F.col("h"), F.lit(CELLS)))
    before = banded.groupBy("band", "cell").agg(F.count(F.lit(1)).alias("n")).select("band", "cell", (F.sum("n").over(Window.partitionBy("band").orderBy("cell")) - F.col("n")).alias("before"))
    ranked = banded.join(before, ["band", "cell"]).select("root", "band", (F.col("before") + F.row_number().over(Window.partitionBy("band", "cell").orderBy("h", "root")) - 1).alias("rank"))
    # systematic: every split in turn takes its rate of the ranks that are left; each band starts at another point
    split, rank, left = F.lit(None).cast("string"), F.col("rank"), whole
    start = F.pmod(F.hash("band"), F.lit(1000)) / 1000.0
    for name, _ in shares[1:]:
        rate = want[name] / left if left > 0 else 0.0
        count = F.floor((rank + 1) * rate + start) - F.floor(start)
        prior = F.floor(rank * rate + start) - F.floor(start)
        split = F.when(split.isNull() & (count > prior), F.lit(name)).otherwise(split)
        rank, left = F.when(split.isNull(), rank - prior).otherwise(rank), left - want[name]
    dealt = ranked.select("root", F.coalesce(split, F.lit(shares[0][0])).alias("split"))
    return dealt.unionByName(groups.sparkSession.createDataFrame(fixed, "root long, split string")) if fixed else dealt


def grouped_splits(rows: DataFrame, batch_map: DataFrame, roots: DataFrame, shares: tuple[tuple[str, float], ...] = SPLITS) -> DataFrame:
    """row_id, root, split_name (the present one), split (the new one)."""
    placed, groups = grouped_rows(rows, batch_map, roots)
    dealt = cut(dealt_roots(groups.select("root", "rows").distinct(), shares), "dealt")
    of = groups.select("node", "root").join(dealt, "root")  # one row for each node; the rows are joined once
    return joined_apart(placed.select("row_id", "split_name", "node"), of, "node").select("row_id", "root", "split_name", "split")
