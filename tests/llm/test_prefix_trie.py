"""The trie of conversation prefixes on odd rows, against brute force."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quotewell.llm import prefix_trie


def brute_force(conversations: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    members: dict[tuple, list[int]] = {}
    for conv, turns in conversations.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(conv)
    children: dict[tuple, int] = {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, ids in members.items():
        own = (len(ids) - 1) * len(node[-1][1]) if node else 0
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += node not in children
            saved[node[:depth]] += own
    ends: dict[tuple, list[int]] = {}
    for conv, turns in conversations.items():
        ends.setdefault(tuple(turns), []).append(conv)
    return sorted(
        (min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids),
         children.get(node, 0), leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest())
        for node, ids in members.items()
    )


def grouped(rows: list[tuple]) -> dict[int, list[tuple[str, str]]]:
    found: dict[int, list[tuple]] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            key = (turn is not None, turn or 0, role or "", text or "")
            found.setdefault(conv, []).append(key)
    return {conv: [key[2:] for key in sorted(keys)] for conv, keys in found.items()}


def trie(spark, stages, rows, height=prefix_trie.HEIGHT, extra=False):
    schema = "conv_id long, turn long, role string, text string"
    if extra:
        schema += ", depth string, k1 int, chars string, size int, at string"
        rows = [(*row, "d", 1, "c", 2, "a") for row in rows]
    turns = prefix_trie.ordered_turns(spark.createDataFrame(rows, schema), stages)
    made = prefix_trie.prefix_trie(
        turns, prefix_trie.conversation_sizes(turns), stages, height=height)
    return sorted(map(tuple, made.collect()), key=lambda r: (r[0], r[1]))


ODD = [
    (1, 0, "user", "a"), (1, 1, "bot", "bb"), (1, 1, "bot", "bb"), (1, None, None, None),
    (2, None, "", ""), (2, 5, "user", "a"), (2, 9, "bot", "bb"), (-3, 0, "us", "era"),
    (-3, 1, "user", "a"), (4, 0, "use", "ra"), (None, 0, "user", "lost"), (10, 0, "user", "a"),
    (7, 0, "user", "é" * 5000), (8, 0, "user", "é" * 5000),
]


def test_odd_rows(spark, stages):
    assert trie(spark, stages, ODD, extra=True) == brute_force(grouped(ODD))


def test_empty(spark, stages):
    assert trie(spark, stages, []) == []


@pytest.mark.parametrize("height", [1, 2, 3, 8])
def test_bands_of_every_height(spark, stages, height):
    if height == 1:
        with pytest.raises(ValueError, match="height"):
            trie(spark, stages, ODD, height=1)
        return
    rng = random.Random(height)
    rows = []
    for conv in range(60):
        length = rng.choice([1, 2, 5, 9, 17, 30])
        stop = rng.randrange(length + 1)
        rows += [(conv, t, "user", "x" * (t % 4) if t < stop else rng.choice("pq"))
                 for t in range(length)]
    assert trie(spark, stages, rows, height) == brute_force(grouped(rows))


def test_a_long_conversation_lies_in_many_runs(spark, stages):
    rows = [(1, t, "user", "w") for t in range(2 * prefix_trie.RUN + 5)]
    rows += [(2, t, "user", "w") for t in range(prefix_trie.RUN + 1)]
    found = trie(spark, stages, rows)
    assert len(found) == 2 * prefix_trie.RUN + 6
    by_depth = {r[1]: r for r in found}
    assert by_depth[0][3:7] == (2, 1, 1, prefix_trie.RUN + 1)
    for depth in (1, 500, prefix_trie.RUN + 1, prefix_trie.RUN + 2, 2 * prefix_trie.RUN + 5):
        both = depth <= prefix_trie.RUN + 1
        assert by_depth[depth][3] == (2 if both else 1)
        assert by_depth[depth][6] == max(0, prefix_trie.RUN + 2 - depth)


def test_many_ends_are_digested_in_order(spark):
    ids = list(range(25_000))
    ends = spark.createDataFrame([(1, 5, 6, i) for i in ids] + [(1, 5, 7, 3)],
                                 "depth long, k1 long, k2 long, conv_id long")
    found = {r.k2: r.ends_sha256 for r in prefix_trie.end_digests(ends.repartition(7)).collect()}
    assert found == {6: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     7: hashlib.sha256(b"3").hexdigest()}


def test_shared_heads(spark, stages):
    rows = [(100, t, "user", f"h{t}") for t in range(3)]
    rows += [(101, t, "user", f"a{t}") for t in range(6)] + [(102, 0, "user", "b0")]
    rows += [(250, 0, "user", "c0"), (250, 1, "user", "c1")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = prefix_trie.ordered_turns(frame, stages)
    conv = F.col("conv_id")
    made, sizes = prefix_trie.with_shared_heads(
        turns, base=conv - conv % 100, taken=F.lit(4), most=5, stages=stages)
    # 100 keeps its three turns; 101 takes three and goes on with its fifth; 102 has only the
    # head's; 250 has no head and loses its own.
    assert {(r.conv_id, r.size) for r in sizes.collect()} == {(100, 3), (101, 5), (102, 3), (250, 0)}
    known = {(r.t1, r.t2): r for r in turns.collect()}
    found = sorted((r.conv_id, r.pos, known[r.t1, r.t2].conv_id, known[r.t1, r.t2].pos)
                   for r in made.collect())
    assert found == [
        (100, 1, 100, 1), (100, 2, 100, 2), (100, 3, 100, 3),
        (101, 1, 100, 1), (101, 2, 100, 2), (101, 3, 100, 3), (101, 4, 101, 5), (101, 5, 101, 6),
        (102, 1, 100, 1), (102, 2, 100, 2), (102, 3, 100, 3),
    ]
    nodes = {(r.conv_id, r.depth): r for r in
             prefix_trie.prefix_trie(made, sizes, stages).collect()}
    assert nodes[100, 0].n_convs == 4 and nodes[100, 1].n_convs == 3
    assert nodes[100, 0].ends_sha256 == hashlib.sha256(b"250").hexdigest()
