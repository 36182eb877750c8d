"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

Each distinct sequence of first d turns (role, text) of the rebuilt conversations is a
node of depth d; the root, depth 0, has all conversations.  A node is named by its
smallest member and its depth, which no other node shares.

Rebuilding.  Turns are reduced to two 64-bit hashes and the text's bytes before anything
is moved; texts are never shuffled.  Turns are ordered by (turn, hashes), null first,
and range-partitioned in this order: the stretch of a conversation in one partition is
a chunk, so a conversation with a third of all turns is many chunks.  Positions and
prefix hashes are cumulated within a chunk, and each chunk adds what the chunks before
it hold.  A prefix hash is the sum of its turns' hashes over (depth, turn), in four sums
of 32-bit halves with the depth.

Contraction.  Every node starts with its own value; the total of a subtree is wanted.  In
each round the leaves are raked: a leaf's value is its total, and is added to its parent.
In the same round unary nodes (one child left) are compressed: an independent set of
them, chosen by a bit of the depth (later rounds: of a hash), is taken out, and the
child hangs under the grandparent by an edge that carries the value.  So long chains
halve and a round is one aggregation and one join of what is left; a parent knows the
only child left from the exclusive or of its children's names.  What a compressed node
needs to know later is one row: its total is a constant plus the total of the child it
had.  Re-expansion follows these rows by pointer doubling to a raked node.

Scale: no text in any shuffle; groups are pre-aggregated; nothing is collected.  Joins
on a parent's or a chain end's name have one row a key on one side, so Spark can split
the other.  The ids of the conversations that end in a node are joined in rows of at
most ``ids_a_row`` ids, and hashed as a stream, since a node may end any number of them.

Null roles and texts are empty; null turns come first; equal turn numbers are ordered by
the hashes of (role, text), and repeated rows are turns of their own.  Rows with a null
``conv_id`` have no conversation to be part of and are left out.  An empty table gives no
rows, not even a root.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.session import stored, use_package_on_workers
from aerolake.storage import discard, fresh_path

SUMS = ("a_low", "a_high", "b_low", "b_high")
NODE = ("depth", *SUMS)
#: conversations that share the first turns of the smallest of them
FAMILY = 5
#: turns shared, at most: the checksum's remainder goes up to one less
SHARES = 9


def _halves(depth: Column, f1: Column, f2: Column) -> list[Column]:
    """Four 32-bit numbers from two 64-bit hashes of a turn at a depth."""
    low = F.lit(0xFFFFFFFF)
    a, b = F.xxhash64(depth.cast("long"), f1, f2), F.xxhash64(F.lit("b"), depth.cast("long"), f2, f1)
    halves = (a.bitwiseAND(low), F.shiftrightunsigned(a, 32), b.bitwiseAND(low), F.shiftrightunsigned(b, 32))
    return [h.alias(s) for h, s in zip(halves, SUMS)]


def _added(columns: tuple[str, ...], window: object) -> list[Column]:
    return [F.sum(c).over(window).alias(c) for c in columns]


def chunked_turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, turn, two hashes, bytes, a last tie-break and the chunk of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        F.xxhash64(role, text).alias("f1"),
        F.xxhash64(F.lit("b"), text, role).alias("f2"),
        F.octet_length(text).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("tie"),
    )
    order = [F.col("conv"), *_in_order()]
    return stored(turns.repartitionByRange(*order).withColumn("chunk", F.spark_partition_id()), "trie-turns")


def _in_order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("f1"), F.col("f2"), F.col("tie")]


def rebuilt_prefixes(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, sums, bytes, own hashes) of every prefix of every rebuilt conversation, and (conv, length)."""
    shared = F.crc32(F.col("conv").cast("string")) % SHARES
    first = turns.where(F.col("conv") % FAMILY == 0).withColumn("nth", F.row_number().over(Window.partitionBy("conv").orderBy(*_in_order())))
    heads = first.where(F.col("nth") < SHARES).groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(F.struct("nth", "f1", "f2", "bytes"))).alias("head"))
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = turns.groupBy("conv", "chunk").agg(F.count("*").alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    chunks = chunks.withColumn("base", F.col("conv") - F.pmod("conv", F.lit(FAMILY))).join(heads, "base", "left").withColumn("shared", shared)
    head = F.slice(F.coalesce("head", F.array().cast("array<struct<nth:int,f1:bigint,f2:bigint,bytes:bigint>>")), F.lit(1), F.col("shared").cast("int"))
    chunks = stored(chunks.select("conv", "chunk", "n", "offset", "shared", head.alias("head")), "trie-chunks")
    whole = chunks.groupBy("conv").agg(F.max("shared").alias("shared"), F.sum("n").alias("n"), F.max("head").alias("head"))
    lengths = whole.select("conv", (F.size("head") + F.greatest(F.col("n") - F.col("shared"), F.lit(0))).cast("long").alias("length"))

    copied = whole.select("conv", F.explode("head").alias("t")).select("conv", F.col("t.nth").cast("long").alias("depth"), "t.f1", "t.f2", "t.bytes")
    upto = Window.partitionBy("conv").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    copied = copied.select("conv", "depth", "bytes", *_halves(F.col("depth"), F.col("f1"), F.col("f2")))
    copied = copied.select("conv", "depth", "bytes", *[F.col(s).alias(f"own_{s}") for s in SUMS], *_added(SUMS, upto))
    copied = stored(copied, "trie-heads")

    inner = Window.partitionBy("conv", "chunk")
    placed = turns.withColumn("nth", F.row_number().over(inner.orderBy(*_in_order()))).join(chunks.select("conv", "chunk", "offset", "shared", F.size("head").alias("taken")), ["conv", "chunk"])
    placed = placed.withColumn("position", F.col("offset") + F.col("nth")).where("position > shared")
    placed = placed.withColumn("depth", F.col("position") - F.col("shared") + F.col("taken"))
    placed = placed.select("conv", "chunk", "depth", "bytes", *_halves(F.col("depth"), F.col("f1"), F.col("f2")))
    within = inner.orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    own = stored(placed.select("conv", "chunk", "depth", "bytes", *[F.col(s).alias(f"own_{s}") for s in SUMS], *_added(SUMS, within)), "trie-own")
    # sums only grow within a chunk, and a conversation's copied head comes before its first chunk
    held = own.groupBy("conv", "chunk").agg(*[F.max(s).alias(s) for s in SUMS])
    held = held.unionByName(copied.groupBy("conv").agg(F.lit(-1).alias("chunk"), *[F.max(s).alias(s) for s in SUMS]))
    before = held.select("conv", "chunk", *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"before_{s}") for s in SUMS]).where("chunk >= 0")
    columns = ["conv", "depth", "bytes", *[f"own_{s}" for s in SUMS]]
    own = own.join(before, ["conv", "chunk"]).select(*columns, *[(F.col(s) + F.col(f"before_{s}")).alias(s) for s in SUMS])
    return own.unionByName(copied.select(*own.columns)), lengths


def trie_nodes(prefixes: DataFrame, lengths: DataFrame) -> DataFrame:
    """conv, depth, parent, n_convs, bytes, sums, and of the children left: their number and the exclusive or of their names."""
    root = lengths.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv")).where("n_convs > 0")
    root = root.select(F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(s) for s in SUMS], "n_convs", "conv", F.lit(0).cast("long").alias("bytes"), *[F.lit(None).cast("long").alias(f"up_{s}") for s in SUMS])
    nodes = prefixes.groupBy(*NODE).agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv"), F.max("bytes").alias("bytes"), *[F.max(F.col(s) - F.col(f"own_{s}")).alias(f"up_{s}") for s in SUMS])
    nodes = stored(nodes.unionByName(root), "trie-nodes")
    parents = nodes.select(F.col("conv").alias("parent"), (F.col("depth") + 1).alias("depth"), *[F.col(s).alias(f"up_{s}") for s in SUMS])
    nodes = stored(nodes.join(parents, ["depth", *[f"up_{s}" for s in SUMS]], "left").select("conv", "parent", "n_convs", "bytes", *NODE), "trie-parents")
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("kids"), F.expr("bit_xor(conv)").alias("kid_conv"), F.max("depth").alias("kid_depth"))
    return nodes.join(children, ["conv", "depth"], "left").withColumn("kids", F.coalesce("kids", F.lit(0)))


STATE = "conv long, depth long, up_conv long, up_depth long, leaves long, saved long, edge_leaves long, edge_saved long, kids long, kid_conv long, kid_depth long, gone string, over_conv long, over_depth long, more_leaves long, more_saved long"


def _chosen(conv: str, depth: str, turn: int, bits: int) -> Column:
    """A bit of a node's name that changes from round to round."""
    if turn < bits:
        return F.shiftrightunsigned(depth, turn).bitwiseAND(F.lit(1)) == 1
    return F.xxhash64(F.col(conv), F.col(depth), F.lit(turn)).bitwiseAND(F.lit(1)) == 1


def _told(state: DataFrame) -> DataFrame:
    """What the nodes removed in a round tell those around them, one row for each that is told anything."""
    none = F.lit(None).cast("long")
    raked = state.where("gone = 'raked' AND up_conv IS NOT NULL").select(
        F.col("up_conv").alias("conv"), F.col("up_depth").alias("depth"), F.lit(1).alias("fewer"),
        (F.col("leaves") + F.col("edge_leaves")).alias("add_leaves"), (F.col("saved") + F.col("edge_saved")).alias("add_saved"),
        F.col("conv").alias("x_conv"), F.col("depth").alias("x_depth"),
        *[none.alias(c) for c in ("new_conv", "new_depth", "from_conv", "from_depth", "from_leaves", "from_saved", "from_edge_leaves", "from_edge_saved")],
    )
    shrunk = state.where("gone = 'compressed'")
    zero = F.lit(0).cast("long")
    up = shrunk.select(
        F.col("up_conv").alias("conv"), F.col("up_depth").alias("depth"), F.lit(0).alias("fewer"), zero.alias("add_leaves"), zero.alias("add_saved"),
        F.col("conv").bitwiseXOR(F.col("kid_conv")).alias("x_conv"), F.col("depth").bitwiseXOR(F.col("kid_depth")).alias("x_depth"),
        *[none.alias(c) for c in ("new_conv", "new_depth", "from_conv", "from_depth", "from_leaves", "from_saved", "from_edge_leaves", "from_edge_saved")],
    )
    down = shrunk.select(
        F.col("kid_conv").alias("conv"), F.col("kid_depth").alias("depth"), F.lit(0).alias("fewer"), zero.alias("add_leaves"), zero.alias("add_saved"), zero.alias("x_conv"), zero.alias("x_depth"),
        F.col("up_conv").alias("new_conv"), F.col("up_depth").alias("new_depth"), F.col("conv").alias("from_conv"), F.col("depth").alias("from_depth"),
        F.col("leaves").alias("from_leaves"), F.col("saved").alias("from_saved"), F.col("edge_leaves").alias("from_edge_leaves"), F.col("edge_saved").alias("from_edge_saved"),
    )
    summed = [F.sum(c).alias(c) for c in ("fewer", "add_leaves", "add_saved")] + [F.expr(f"bit_xor({c})").alias(c) for c in ("x_conv", "x_depth")]
    only = [F.max(c).alias(c) for c in down.columns if c.startswith(("new_", "from_"))]
    return raked.unionByName(up).unionByName(down).groupBy("conv", "depth").agg(*summed, *only)


def _round(state: DataFrame, turn: int, bits: int) -> DataFrame:
    """The nodes left after a round's news, with those marked that this round removes."""
    news = state.where("gone IS NULL").drop("gone", "over_conv", "over_depth", "more_leaves", "more_saved").join(_told(state), ["conv", "depth"], "left")
    add = lambda c, *more: sum((F.coalesce(m, F.lit(0)) for m in more), F.col(c))
    now = news.select(
        "conv", "depth",
        F.coalesce("new_conv", "up_conv").alias("up_conv"), F.coalesce("new_depth", "up_depth").alias("up_depth"),
        add("leaves", "add_leaves").alias("leaves"), add("saved", "add_saved").alias("saved"),
        add("edge_leaves", "from_leaves", "from_edge_leaves").alias("edge_leaves"), add("edge_saved", "from_saved", "from_edge_saved").alias("edge_saved"),
        (F.col("kids") - F.coalesce("fewer", F.lit(0))).alias("kids"),
        F.col("kid_conv").bitwiseXOR(F.coalesce("x_conv", F.lit(0))).alias("kid_conv"), F.col("kid_depth").bitwiseXOR(F.coalesce("x_depth", F.lit(0))).alias("kid_depth"),
        F.col("from_conv").alias("over_conv"), F.col("from_depth").alias("over_depth"),
        (F.col("from_leaves") + F.col("edge_leaves")).alias("more_leaves"), (F.col("from_saved") + F.col("edge_saved")).alias("more_saved"),
    )
    return _marked(now, turn, bits)


def _marked(now: DataFrame, turn: int, bits: int) -> DataFrame:
    """Mark the leaves to rake and the unary nodes to compress; never a node and its only child together."""
    compressed = (F.col("kids") == 1) & F.col("up_conv").isNotNull() & _chosen("conv", "depth", turn, bits) & ~_chosen("kid_conv", "kid_depth", turn, bits)
    waits = F.coalesce(_chosen("up_conv", "up_depth", turn, bits) & ~_chosen("conv", "depth", turn, bits), F.lit(False)) & (F.col("up_depth") > 0)
    raked = (F.col("kids") == 0) & ~F.coalesce(waits, F.lit(False))
    gone = F.when(raked, F.lit("raked")).when(compressed, F.lit("compressed"))
    return now.withColumn("gone", gone).select(*[c.split()[0] for c in STATE.split(", ")])


def subtree_totals(nodes: DataFrame) -> DataFrame:
    """conv, depth, leaves and saved of every subtree of a tree.

    ``nodes``: conv and depth (a node's name), parent (conv of the parent, one level up;
    null for the root), saved (the node's value), kids, kid_conv and kid_depth (of its
    children: number and exclusive or of conv; their depth).
    """
    spark = nodes.sparkSession
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    # the exclusive or of as many equal depths is that depth or 0
    start = nodes.select(
        "conv", "depth", F.col("parent").alias("up_conv"), F.when(F.col("parent").isNotNull(), F.col("depth") - 1).alias("up_depth"),
        F.when(F.col("kids") == 0, 1).otherwise(0).cast("long").alias("leaves"), "saved", zero.alias("edge_leaves"), zero.alias("edge_saved"),
        "kids", F.coalesce("kid_conv", zero).alias("kid_conv"), F.when(F.col("kids") % 2 == 1, F.col("kid_depth")).otherwise(zero).alias("kid_depth"),
        none.alias("over_conv"), none.alias("over_depth"), none.alias("more_leaves"), none.alias("more_saved"),
    )
    bits = int(nodes.agg(F.max("depth")).first()[0] or 0).bit_length()
    paths, turn = [], 0

    def kept(state: DataFrame) -> DataFrame:
        paths.append(fresh_path(spark, "trie-round"))
        state.write.parquet(paths[-1])
        return spark.read.schema(STATE).parquet(paths[-1])

    state = kept(_marked(start, turn, bits))
    while state.where("gone IS NULL").limit(1).count():
        turn += 1
        state = kept(_round(state, turn, bits))
    rounds = spark.read.schema(STATE).parquet(*paths)
    totals = rounds.where("gone = 'raked'").select("conv", "depth", "leaves", "saved")
    # a compressed node's total: what it held, and the total of the node that took its place, of a later round
    later = stored(rounds.where("over_conv IS NOT NULL").select(F.col("over_conv").alias("conv"), F.col("over_depth").alias("depth"), F.col("conv").alias("to_conv"), F.col("depth").alias("to_depth"), F.col("more_leaves").alias("leaves"), F.col("more_saved").alias("saved")), "trie-later")
    for _ in range(ceil(log2(max(turn, 1)))):
        far = later.select(F.col("conv").alias("to_conv"), F.col("depth").alias("to_depth"), F.col("to_conv").alias("far_conv"), F.col("to_depth").alias("far_depth"), F.col("leaves").alias("far_leaves"), F.col("saved").alias("far_saved"))
        on = later.join(far, ["to_conv", "to_depth"], "left")
        later = stored(
            on.select(
                "conv", "depth", F.coalesce("far_conv", "to_conv").alias("to_conv"), F.coalesce("far_depth", "to_depth").alias("to_depth"),
                (F.col("leaves") + F.coalesce("far_leaves", zero)).alias("leaves"), (F.col("saved") + F.coalesce("far_saved", zero)).alias("saved"),
            ), "trie-later",
        )
    ends = totals.select(F.col("conv").alias("to_conv"), F.col("depth").alias("to_depth"), F.col("leaves").alias("end_leaves"), F.col("saved").alias("end_saved"))
    expanded = later.join(ends, ["to_conv", "to_depth"]).select("conv", "depth", (F.col("leaves") + F.col("end_leaves")).alias("leaves"), (F.col("saved") + F.col("end_saved")).alias("saved"))
    whole = stored(totals.unionByName(expanded), "trie-totals")
    for path in paths:
        discard(spark, path)
    return whole


def ended_digests(prefixes: DataFrame, lengths: DataFrame, ids_a_row: int = 4096) -> DataFrame:
    """Depth, sums and the digest of the ids, in order, of the conversations that end in a node."""
    ended = prefixes.join(lengths.withColumnRenamed("length", "depth"), ["conv", "depth"]).select("conv", *NODE)
    root = lengths.where("length = 0").select("conv", *[F.lit(0).cast("long").alias(c) for c in NODE])
    part = F.floor(F.col("conv") / ids_a_row).alias("part")
    parts = ended.unionByName(root).groupBy(*NODE, part).agg(F.array_join(F.sort_array(F.collect_list("conv")), ",").alias("ids"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            out = []
            for *node, ids in zip(*[batch.column(i).to_pylist() for i in range(len(NODE) + 1)]):
                if node != key:
                    if key is not None:
                        out.append((*key, digest.hexdigest()))
                    key, digest = node, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _rows(out)
        if key is not None:
            yield _rows([(*key, digest.hexdigest())])

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * len(NODE) + [pa.string()]
        return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], [*NODE, "digest"])

    in_order = parts.repartition(*NODE).sortWithinPartitions(*NODE, "part").select(*NODE, "ids")
    return in_order.mapInArrow(digests, ", ".join(f"{c} long" for c in NODE) + ", digest string")


def conversation_trie(
    conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", ids_a_row: int = 4096
) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A conversation c is rebuilt from the first h turns of conversation c - c mod 5 and its
    own turns after the first h, h being the CRC-32 of its decimal id, mod 9.
    """
    spark = conversations.sparkSession
    use_package_on_workers(spark)
    turns = chunked_turns(conversations, conv_col, turn_col, role_col, text_col)
    prefixes, lengths = rebuilt_prefixes(turns)
    prefixes, lengths = stored(prefixes, "trie-prefixes"), stored(lengths, "trie-lengths")
    nodes = stored(trie_nodes(prefixes, lengths).withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes")), "trie-named")
    totals = subtree_totals(nodes).withColumnsRenamed({"leaves": "n_leaves", "saved": "saved_tokens"})
    digests = ended_digests(prefixes, lengths, ids_a_row)
    found = nodes.drop("bytes", "saved").join(digests, list(NODE), "left").join(totals, ["conv", "depth"])
    return found.select(
        F.col("conv").alias(conv_col),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        F.col("kids").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("digest", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
