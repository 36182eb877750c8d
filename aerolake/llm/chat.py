"""Chat formatting with cumulative-snapshot collapse (DataFrame functions only).

Logs often hold a conversation several times, as it grew: each snapshot is a prefix of
the next.  Every prefix of a conversation gets a rolling hash over its turns; a
conversation whose whole hash is also the hash of a proper prefix of another one is
dropped by an anti-join, and of equal conversations the smallest ``conv_id`` is kept.
What is left, the maximal conversations, is rendered with role markers.

Turns are ordered by (turn, role, text), nulls first; exact repeats of a row count once.
The hash of a prefix is the sum of its turns' hashes, each over (position, role, text),
in two 64-bit hashes summed as 32-bit halves, with the number of turns: a set of sums
that only the same turns in the same order give.  Being sums, the prefixes come from
sums of segments: turns are dealt into segments of ``segment`` turn numbers, positions
and sums are cumulated within a segment, and each segment adds what the ones before it
hold.  So a conversation that holds a third of all turns is spread over many tasks.

Scale: prefixes are made distinct before the anti-join (a first turn shared by a third
of all conversations is one row), and so are whole hashes; the conversations themselves
join by ``conv_id``.  A rendered conversation comes in parts of one segment each, so no
row grows with the longest conversation.

Null roles and texts are kept apart from empty strings in the hash and rendered empty.
Null ``conv_id`` is one conversation.  An empty table gives an empty result.  Extra
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.session import stored

# Fixed values of the rendered format.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"

SUMS = ("a_low", "a_high", "b_low", "b_high")


def _halves(*parts: Column) -> list[Column]:
    """Four 32-bit numbers from two 64-bit hashes; nulls are hashed as such."""
    told = [F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts]
    a, b = F.xxhash64(*told), F.xxhash64(F.lit("b"), *told)
    return [a.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(a, 32), b.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(b, 32)]


def numbered_turns(conversations: DataFrame, *, segment: int = 64, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, segment, position (from 1), role, text and the sums of the prefix that ends with the turn."""
    turns = (
        conversations.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
        .distinct()
        .withColumn("segment", F.floor(F.col("turn") / segment))
    )
    inner = Window.partitionBy("conv", "segment")
    turns = turns.withColumn("nth", F.row_number().over(inner.orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())))
    turns = stored(turns, "chat-turns")
    earlier = Window.partitionBy("conv").orderBy(F.col("segment").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = turns.groupBy("conv", "segment").agg(F.count("*").alias("n")).select("conv", "segment", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"o.{c}")) for c in ("conv", "segment")]
    placed = turns.alias("t").join(offsets.alias("o"), same).select("t.*", (F.col("offset") + F.col("nth")).alias("position"))
    hashes = _halves(F.col("position"), F.col("role"), F.col("text"))
    hashed = stored(placed.select("conv", "segment", "position", "role", "text", *[h.alias(s) for h, s in zip(hashes, SUMS)]), "chat-hashed")
    before = hashed.groupBy("conv", "segment").agg(*[F.sum(s).alias(s) for s in SUMS]).select("conv", "segment", *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"before_{s}") for s in SUMS])
    upto = inner.orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    within = hashed.select("conv", "segment", "position", "role", "text", *[F.sum(s).over(upto).alias(s) for s in SUMS])
    return within.alias("t").join(before.alias("o"), same).select("t.conv", "t.segment", "position", "role", "text", *[(F.col(s) + F.col(f"before_{s}")).alias(s) for s in SUMS])


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv, n_turns and n_equal (conversations with the same turns) of the conversations to keep."""
    lengths = turns.groupBy("conv").agg(F.max("position").alias("n_turns"))
    ended = turns.alias("t").join(lengths.alias("l"), F.col("t.conv").eqNullSafe(F.col("l.conv"))).select("t.conv", "position", "n_turns", *SUMS)
    ended = stored(ended, "chat-prefixes")
    whole = ended.where("position = n_turns").groupBy("position", *SUMS).agg(F.min("conv").alias("conv"), F.count("*").alias("n_equal"))
    proper = ended.where("position < n_turns").select("position", *SUMS).distinct()
    return whole.join(proper, ["position", *SUMS], "left_anti").select("conv", F.col("position").alias("n_turns"), "n_equal")


def rendered(role: Column, text: Column) -> Column:
    """One turn between its markers."""
    return F.concat(F.lit(TURN_START), F.coalesce(role, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit(TURN_END))


def chat_documents(conversations: DataFrame, *, segment: int = 64, conv_col: str = "conv_id", **columns: str) -> DataFrame:
    """``conv_col``, segment, n_turns, n_equal and rendered text of the maximal conversations.

    Turns numbered below ``segment`` are segment 0, and so on: a conversation has one row
    for each ``segment`` turn numbers, to be read in order.
    """
    turns = stored(numbered_turns(conversations, segment=segment, conv_col=conv_col, **columns), "chat-numbered")
    kept = maximal_conversations(turns)
    same = F.col("t.conv").eqNullSafe(F.col("k.conv"))
    lines = turns.alias("t").join(kept.alias("k"), same).select("t.conv", "segment", "position", "n_turns", "n_equal", rendered(F.col("role"), F.col("text")).alias("line"))
    parts = lines.groupBy("conv", "segment", "n_turns", "n_equal").agg(F.sort_array(F.collect_list(F.struct("position", "line"))).alias("lines"))
    return parts.select(F.col("conv").alias(conv_col), "segment", "n_turns", "n_equal", F.concat_ws("", F.col("lines.line")).alias("text"))
