"""The conversation trie against a plain Python one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from aerolake.llm.conversation_trie import conversation_trie, subtree_totals

SCHEMA = "conv_id long, turn long, role string, text string, depth string, n_convs string, conv long"


def by_hand(rows):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    rebuilt = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 9
        base = sorted(convs.get(c - c % 5, []), key=lambda t: t[:2])
        rebuilt[c] = tuple(t[2:] for t in base[:h] + sorted(convs[c], key=lambda t: t[:2])[h:])
    members = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    kids, leaves, saved, out = defaultdict(int), defaultdict(int), defaultdict(int), {}
    for p in members:
        kids[p[:-1]] += bool(p)
    for p in sorted(members, key=len, reverse=True):
        saved[p] += (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        leaves[p] += not kids[p]
        if p:
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
        ended = ",".join(str(c) for c in members[p] if rebuilt[c] == p)
        parent = members[p[:-1]][0] if p else None
        out[members[p][0], len(p)] = (parent, len(members[p]), kids[p], leaves[p], saved[p], hashlib.sha256(ended.encode()).hexdigest())
    return out


def told(df):
    rows = df.collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.fixture(scope="module")
def conversations():
    """Shared starts, copies, long ones, missing bases, turnless ones, nulls, repeated rows and clashing columns."""
    rng = random.Random(31)
    rows = []
    for c in range(0, 160):
        if c % 20 == 5:
            continue
        n = rng.choice([1, 2, 3, 6, 9, 14])
        for t in range(n):
            rows.append((c, t or None, rng.choice(["user", None]) if c % 3 else "user", f"{t} {rng.choice('ab')}é" if c % 4 else f"same {t}", "x", "y", 7))
    rows += [(1000 + 5 * k, t, "user", f"same {t}", "x", "y", 7) for k in range(60) for t in range(4)]
    rows += [(2000, t, "user", f"line {t}", "x", "y", 7) for t in range(700)]
    rows += [(2001, t, "user", f"line {t}" if t < 650 else "else", "x", "y", 7) for t in range(690)]
    rows += [(3000, 1, "user", "again", "x", "y", 7)] * 12 + [(3007, 1, None, None, "x", "y", 7), (None, 1, "user", "nobody", "x", "y", 7)]
    return rows


def test_trie_matches_plain_python(spark, conversations):
    df = spark.createDataFrame(conversations, SCHEMA).repartition(5)
    want = by_hand(conversations)
    assert told(conversation_trie(df, ids_a_row=8)) == want
    assert max(d for _, d in want) >= 690 and any(v[1] > 50 and v[0] is not None for v in want.values())


def test_a_conversation_spread_over_many_chunks(spark, conversations):
    rows = [r for r in conversations if r[0] == 2000] + [(2003, 0, "user", "short", "x", "y", 7), (2003, 1, None, "end", "x", "y", 7)]
    assert told(conversation_trie(spark.createDataFrame(rows, SCHEMA))) == by_hand(rows)


def test_empty_table(spark):
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_contraction_of_random_trees(spark, seed):
    """Trees of chains, stars and bushes, given by name and parent only."""
    rng = random.Random(seed)
    nodes = [(0, 0, None)]
    for i in range(1, 400):
        name, depth, _ = nodes[-1] if rng.random() < 0.8 else rng.choice(nodes[: 1 + rng.randrange(len(nodes))])
        nodes.append((i, depth + 1, name))
    value = {n: rng.randrange(100) for n, _, _ in nodes}
    kids = defaultdict(list)
    for n, _, p in nodes:
        kids[p].append(n)
    want = {}
    for n, d, _ in sorted(nodes, key=lambda x: -x[1]):
        below = [want[k, d + 1] for k in kids[n]]
        want[n, d] = (sum(x for x, _ in below) or 1, value[n] + sum(y for _, y in below))
    rows = []
    for n, d, p in nodes:
        xor = 0
        for k in kids[n]:
            xor ^= k
        rows.append((n, d, p, value[n], len(kids[n]), xor if kids[n] else None, d + 1 if kids[n] else None))
    tree = spark.createDataFrame(rows, "conv long, depth long, parent long, saved long, kids long, kid_conv long, kid_depth long")
    assert {(r.conv, r.depth): (r.leaves, r.saved) for r in subtree_totals(tree).collect()} == want


def test_no_text_is_shuffled(spark):
    df = spark.range(50).select(F.col("id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("r").alias("role"), F.concat(F.lit("t"), (F.col("id") % 7).cast("string")).alias("text"))
    assert "text" not in conversation_trie(df)._jdf.queryExecution().executedPlan().toString()
