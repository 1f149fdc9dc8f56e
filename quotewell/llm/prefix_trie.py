"""The trie of conversation prefixes, with totals of every subtree by a depth-band rollup.

A node is a distinct sequence of first turns. Its key is the exclusive or of one hash per turn and
position, so a key of a prefix can be put together from parts: a conversation may lie in many
tasks. Bands are ``height`` levels deep. A node gives its values to its ancestors inside its band
and to the band's root; band roots are a trie of their own, with one level per band, and are rolled
up the same way; their completed totals then go to the nodes between them. A node is exploded to
at most ``height`` ancestors a round, and the rounds grow with the logarithm of the depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewell.llm.common import whole_text
from quotewell.sources.stages import Stages

HEIGHT = 8
RUN = 1024  # turns of one conversation that one window takes at once
KEY = ("depth", "k1", "k2")
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def ordered_turns(
    turns: DataFrame,
    stages: Stages,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv_id, pos, t1, t2, chars): place of each turn from 1, its hash, code points of its text.

    By turn, null first, then role and text; null role or text is empty. Equal rows are turns of
    their own. Rows without a conversation id are left out. Ids are integers. Rows are placed by
    range, so that the turns of one conversation may be spread over tasks.
    """
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        whole_text(role_col).alias("role"), whole_text(text_col).alias("text"),
    )
    whole = F.sha2(F.concat_ws(":", F.char_length("role").cast("string"), "role", "text"), 256)
    placed = stages.write(
        rows.repartitionByRange("conv_id", "turn", "role", "text")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", F.monotonically_increasing_id().alias("at"), whole.alias("hex"),
                F.char_length("text").cast("long").alias("chars")),
        "trie-turns",
    ).select("conv_id", "at", F.shiftright("at", 33).alias("part"), "chars",
             *[F.conv(F.substring("hex", start, 15), 16, 10).cast("long").alias(name)
               for name, start in (("t1", 1), ("t2", 17))])
    sizes = placed.groupBy("conv_id", "part").agg(F.count("*").alias("size"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = sizes.select("conv_id", "part",
                          F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("conv_id", "part").orderBy("at")
    return stages.write(
        placed.withColumn("row", F.row_number().over(inside)).join(starts, ["conv_id", "part"])
        .select("conv_id", (F.col("start") + F.col("row")).alias("pos"), "t1", "t2", "chars"),
        "trie-order",
    )


def conversation_sizes(turns: DataFrame) -> DataFrame:
    """(conv_id, size) of ordered turns."""
    return turns.groupBy("conv_id").agg(F.count("*").alias("size"))


def with_shared_heads(
    turns: DataFrame, base: Column, taken: Column, most: int, stages: Stages
) -> tuple[DataFrame, DataFrame]:
    """Ordered turns whose first ``taken`` are replaced by those of conversation ``base``.

    ``base`` and ``taken`` are expressions of ``conv_id``; ``taken`` is at most ``most``. A base
    with fewer turns gives all it has, an absent one none; the conversation's own turns follow
    after its first ``taken``. Returns the turns and the size of every conversation, which may be
    zero.
    """
    based = turns.withColumns({"base": base, "taken": taken})
    heads = stages.write(
        based.where((F.col("base") == F.col("conv_id")) & (F.col("pos") <= most))
        .select("base", "pos", "t1", "t2", "chars"),
        "trie-heads",
    )
    given = heads.groupBy("base").agg(F.count("*").alias("given"))
    shift = F.least("taken", F.coalesce("given", F.lit(0)))
    sizes = (
        conversation_sizes(turns).withColumns({"base": base, "taken": taken})
        .join(given, "base", "left")
    )
    own = (
        based.where("pos > taken").join(given, "base", "left")
        .select("conv_id", (F.col("pos") - F.col("taken") + shift).alias("pos"),
                "t1", "t2", "chars")
    )
    shared = (
        sizes.join(heads, "base").where("pos <= taken")
        .select("conv_id", "pos", "t1", "t2", "chars")
    )
    left = F.greatest(F.col("size") - F.col("taken"), F.lit(0))
    return (
        stages.write(own.unionByName(shared), "trie-rebuilt"),
        stages.write(sizes.select("conv_id", (shift + left).alias("size")), "trie-sizes"),
    )


def prefix_keys(turns: DataFrame, stages: Stages) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, chars): the node after each turn and the one before it."""
    hashed = turns.select(
        "conv_id", F.col("pos").alias("depth"), "chars",
        F.xxhash64("pos", "t1", "t2").alias("h1"), F.xxhash64("t2", "pos", "t1").alias("h2"),
        F.floor((F.col("pos") - 1) / RUN).cast("long").alias("run"),
    )
    runs = hashed.groupBy("conv_id", "run").agg(
        F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"))
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = runs.select("conv_id", "run", *[
        F.coalesce(F.bit_xor(name).over(before), F.lit(0).cast("long")).alias(name)
        for name in ("x1", "x2")])
    inside = Window.partitionBy("conv_id", "run").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, 0)
    summed = hashed.withColumns(
        {"s1": F.bit_xor("h1").over(inside), "s2": F.bit_xor("h2").over(inside)})
    keyed = summed.join(starts, ["conv_id", "run"]).select(
        "conv_id", "depth", "chars", "h1", "h2",
        F.col("s1").bitwiseXOR(F.col("x1")).alias("k1"),
        F.col("s2").bitwiseXOR(F.col("x2")).alias("k2"),
    )
    return stages.write(
        keyed.select("conv_id", "depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("h1")).alias("p1"),
                     F.col("k2").bitwiseXOR(F.col("h2")).alias("p2"), "chars"),
        "trie-paths",
    )


def subtree_totals(
    paths: DataFrame, values: DataFrame, sums: list[str], stages: Stages, height: int = HEIGHT
) -> DataFrame:
    """(depth, k1, k2) with the sums of ``values`` over each node's subtree.

    ``paths`` holds (conv_id, depth, k1, k2, p1, p2) for every turn; ``values`` one row per node,
    the root (0, 0, 0) among them. A band runs from its root, ``height`` levels below the last
    one, to the level above the next root.
    """
    band = F.floor((F.col("depth") - 1) / height).cast("long")
    above = Window.partitionBy("conv_id", "band").orderBy("depth")
    key = F.struct(*KEY)
    banded = paths.select(
        *KEY, "conv_id", band.alias("band"), "p1", "p2",
    ).select(
        *KEY, "conv_id",
        F.collect_list(key).over(above.rowsBetween(Window.unboundedPreceding, -1)).alias("up"),
        F.first(F.struct((F.col("band") * height).alias("depth"), F.col("p1").alias("k1"),
                         F.col("p2").alias("k2")))
        .over(above.rowsBetween(Window.unboundedPreceding, 0)).alias("top"),
    )
    # All paths through a node agree on what is above it.
    lines = stages.write(
        banded.groupBy(*KEY).agg(F.first("up").alias("up"), F.first("top").alias("top")),
        "trie-bands",
    )
    is_root = F.col("depth") % height == 0
    total = [F.sum(name).alias(name) for name in sums]

    def given(rows: DataFrame, receivers: Column) -> DataFrame:
        return rows.select(F.explode(receivers).alias("to"), *sums).select(
            *[F.col(f"to.{name}") for name in KEY], *sums)

    inner = values.where(~is_root).join(lines, list(KEY))
    inside = stages.write(
        given(inner, F.concat("up", F.array("top", key)))
        .unionByName(values.where(is_root).select(*KEY, *sums))
        .groupBy(*KEY).agg(*total),
        "trie-inside",
    )
    deep = paths.where(is_root)
    if deep.isEmpty():
        return inside
    tops = lines.where(is_root).select(*KEY, "top")
    level = (F.col("depth") / height).cast("long").alias("depth")
    contracted = stages.write(
        deep.select(*KEY, "conv_id").join(tops, list(KEY))
        .select("conv_id", level, "k1", "k2", F.col("top.k1").alias("p1"),
                F.col("top.k2").alias("p2")),
        "trie-roots",
    )
    done = subtree_totals(
        contracted, inside.where(is_root).select(level, "k1", "k2", *sums), sums, stages, height
    ).select((F.col("depth") * height).alias("depth"), "k1", "k2", *sums)
    below = done.join(lines.where(is_root), list(KEY))
    return stages.write(
        given(below, F.col("up")).unionByName(inside.where(~is_root))
        .groupBy(*KEY).agg(*total).unionByName(done),
        "trie-totals",
    )


def _same_before(*columns: np.ndarray) -> np.ndarray:
    """Whether each row has the key of the row before it."""
    same = np.ones(len(columns[0]), bool)
    same[:1] = False
    for column in columns:
        same[1:] &= column[1:] == column[:-1]
    return same


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one key in each batch as comma-joined ids, with the first id."""
    for batch in batches:
        *key, ids = (column.to_numpy() for column in batch.columns)
        if not len(ids):
            continue
        starts = np.flatnonzero(~_same_before(*key))
        texts = [",".join(map(str, part.tolist())) for part in np.split(ids, starts[1:])]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(column[starts]) for column in (*key, ids)), pa.array(texts, pa.string())],
            names=[*KEY, "conv_id", "ids"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per key of rows sorted by key and first id."""
    now, state = None, None

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=[*KEY, "ends_sha256"],
        )

    for batch in batches:
        rows = []
        *key, _, texts = (column.to_pylist() for column in batch.columns)
        for found, text in zip(zip(*key, strict=True), texts, strict=True):
            if found != now:
                if now is not None:
                    rows.append((*now, state.hexdigest()))
                now, state = found, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
        yield made(rows)
    if now is not None:
        yield made([(*now, state.hexdigest())])


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256): digest of the conversations that end at each node.

    Ids are dealt by range and joined to lists where they lie, so that a node with many ends sends
    few rows on; the lists of a node are then digested one after the other, none held.
    """
    order = [*KEY, "conv_id"]
    lists = (
        ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(_lists, "depth long, k1 long, k2 long, conv_id long, ids string")
    )
    return lists.repartition(*KEY).sortWithinPartitions(*order).mapInArrow(
        _digests, "depth long, k1 long, k2 long, ends_sha256 string")


def prefix_trie(
    turns: DataFrame, sizes: DataFrame, stages: Stages, height: int = HEIGHT
) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    ``turns`` are ordered turns (conv_id, pos, t1, t2, chars), ``sizes`` has one row per
    conversation with its number of turns, zero included. ``conv_id`` is the smallest member;
    the root has depth 0 and no parent. Without conversations the result is empty. Turns count as
    equal by 120 bits of a SHA-256 of role and text, prefixes by 128 bits. A band has at least
    two levels.
    """
    if height < 2:
        raise ValueError("the height of a band is at least 2")
    paths = prefix_keys(turns, stages)
    root = sizes.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where(
        "n_convs > 0")
    zero = F.lit(0).cast("long")
    nodes = stages.write(
        paths.groupBy(*KEY, "p1", "p2")
        .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
             F.max("chars").alias("chars"))
        .unionByName(root.select(
            *[zero.alias(name) for name in (*KEY, "p1", "p2")], "conv_id", "n_convs",
            zero.alias("chars"))),
        "trie-nodes",
    )
    kids = (
        nodes.where("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"),
                 F.col("p2").alias("k2"))
        .agg(F.count("*").alias("n_children"))
    )
    counted = stages.write(
        nodes.join(kids, list(KEY), "left").withColumns({
            "n_children": F.coalesce("n_children", zero),
            "n_leaves": F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long"),
            "saved_tokens": (F.col("n_convs") - 1) * F.col("chars"),
        }),
        "trie-counted",
    )
    sums = ["n_leaves", "saved_tokens"]
    totals = subtree_totals(paths, counted.select(*KEY, *sums), sums, stages, height)
    last = sizes.where("size > 0").select("conv_id", F.col("size").alias("depth"))
    ends = paths.join(last, ["conv_id", "depth"]).select(*KEY, "conv_id").unionByName(
        sizes.where("size = 0").select(*[zero.alias(name) for name in KEY], "conv_id"))
    digests = stages.write(end_digests(ends), "trie-ends")
    # The root is the parent of every first turn: it is known without a join.
    parents = nodes.where("depth > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"))
    top = counted.where("depth <= 1").withColumn(
        "parent_conv_id", F.when(F.col("depth") == 1, root.select("conv_id").scalar()))
    placed = top.unionByName(
        counted.where("depth > 1").join(parents, ["depth", "p1", "p2"]))
    return (
        placed.drop(*sums).join(totals, list(KEY)).join(digests, list(KEY), "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *sums,
                F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))
    )
