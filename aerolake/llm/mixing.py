"""Mixing sources to target weights by pivotal dependent rounding (DataFrame functions only).

A source's target is a number of words; each of its documents gets the expected number
of copies target / source size.  The whole part is taken as it is; the fractional parts
are rounded together.  Documents are dealt into blocks by hash; within a block they are
taken in hash order as (carried, next) pairs: the pair moves mass between its two
probabilities, in words, until one of them is 0 or 1, with the direction drawn from a
hash so that every expectation is kept.  The decided document leaves, the other is
carried on.  A block's last document is its residual.  Residuals go up a reduction tree,
a fan-in of blocks at a time, until one document per source is left; it is rounded
alone.  A source's taken words so differ from its target by less than one document.

Scale: only (id, source, size) rows move, never texts.  A source, however hot, is dealt
into blocks of about ``block`` rows, so no task sees a whole source; each level of the
tree has 1/``block`` of the rows of the one below.  Levels are written tables.  Exact
repeats of a row are counted first and spread again with a copy number, so they do not
meet in one block.  The table of sources is ordered in one task: it has one row a source.

The draw is a hash of the row's values and the seed: reruns agree.  Null text and texts
without words have size 0 and are taken 0 times.  Null is a source of its own, last.  An
empty table gives an empty result.  A source without words has target 0.  Extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.session import stored

WEIGHTS = (5, 2, 1)


def word_count(text: str) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, *, weights: Sequence[int] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """source, source_size, target.

    Sources in code-point order, null last, get the repeating ``weights``.  The targets
    add up to ``share`` of all words; none is above ``cap`` times its source: sources
    whose weight would take them there stop at the cap and the excess is shared among
    the others by weight.  With the sources sorted by cap / weight the capped ones are a
    prefix, so the common level per weight follows from running sums.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    ordered = by_source.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * F.lit(float(cap))).alias("top"))
    ordered = ordered.withColumn("ratio", F.col("top") / F.col("weight"))
    every = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = every.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    # the level if this source and all later ones were below their caps
    level = (F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("top").over(before), F.lit(0.0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levels = ordered.withColumn("level", level)
    # the first source that its level leaves below its cap sets the level for the rest
    final = F.first(F.when(F.col("level") <= F.col("ratio"), F.col("level")), ignorenulls=True).over(
        every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return levels.select(
        "source", "source_size", F.least(F.col("top"), F.coalesce(final, F.col("ratio")) * F.col("weight")).alias("target")
    )


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once."""
    return F.transform(F.array(value), then)[0]


def _draw(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def _pair(a: Column, b: Column, seed: int) -> Column:
    """One pivotal step: (decided, copy 0 or 1, the other with the words that are left).

    Of the pair's words together, a takes up to its size from b (``raised``) or gives up to
    what b can hold; the chances are such that both expectations stay.  Either one is
    then full (copy 1), or one is empty (copy 0).
    """

    def step(z: Column) -> Column:
        total, up, down = z["total"], z["up"], z["down"]
        raised = _draw(a["key"], b["key"], F.lit(seed)) * (up + down) < down
        full = F.when(raised, total >= a["size"]).otherwise(total >= b["size"])
        first = raised == full  # a is the one that is decided
        decided = F.when(first, a).otherwise(b)
        other = F.when(first, b).otherwise(a)
        left = F.when(full, total - decided["size"]).otherwise(total)
        return F.struct(
            F.struct(*[decided[c].alias(c) for c in ("key", "size", "words", "row")], full.cast("int").alias("copy")).alias("decided"),
            F.struct(other["key"].alias("key"), other["size"].alias("size"), F.greatest(F.lit(0.0), F.least(left, other["size"].cast("double"))).alias("words"), other["row"].alias("row")).alias("other"),
        )

    both = F.struct(
        (a["words"] + b["words"]).alias("total"),
        F.least(a["size"] - a["words"], b["words"]).alias("up"),
        F.least(a["words"], b["size"] - b["words"]).alias("down"),
    )
    return _let(both, step)


def _round_block(rows: Column, seed: int) -> Column:
    """Fold a block's rows pair by pair: struct of the residual ``carry`` and the decided rows ``out``."""

    def merge(state: Column, row: Column) -> Column:
        return _let(
            _pair(state["carry"], row, seed),
            lambda z: F.struct(z["other"].alias("carry"), F.concat(state["out"], F.array(z["decided"])).alias("out")),
        )

    none = F.filter(F.transform(rows, lambda r: F.struct(r["key"].alias("key"), r["size"].alias("size"), r["words"].alias("words"), r["row"].alias("row"), F.lit(0).alias("copy"))), lambda r: F.lit(False))
    return F.aggregate(F.slice(rows, 2, F.size(rows)), F.struct(rows[0].alias("carry"), none.alias("out")), merge)


def pivotal_mix(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    cap: float = 2.0,
    block: int = 64,
    seed: int = 17,
) -> DataFrame:
    """``id_col``, source, size, source_size, target, copies and taken (size * copies) of every row."""
    rows = documents.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"), F.xxhash64(text_col).alias("same")
    )
    # exact repeats of a row, however many, are counted before anything is grouped by them
    rows = stored(rows.groupBy("id", "source", "size", "same").agg(F.count("*").alias("n")), "mix-sizes")
    totals = rows.select("source", (F.col("size") * F.col("n")).alias("size"))
    counts = rows.where("size > 0").groupBy("source").agg(F.sum("n").alias("n_rows"))
    targets = source_targets(totals, weights=weights, share=share, cap=cap)
    targets = stored(
        targets.join(counts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").select(
            F.col("source").alias("of"), "source_size", "target", F.ceil(F.coalesce("n_rows", F.lit(0)) / block).alias("n_blocks")
        ),
        "mix-targets",
    )
    n_blocks = targets.agg(F.max("n_blocks")).first()[0] or 0
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # the nearest billionth, so that a ratio of 2 is 2 however its division was rounded
    rows = (
        rows.join(targets, rows["source"].eqNullSafe(targets["of"]))
        .withColumn("ratio", F.round(ratio, 9))
        .withColumn("whole", F.floor("ratio"))
        .withColumn("copy_no", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    )
    fraction = F.col("ratio") - F.col("whole")
    open_ = (F.col("size") > 0) & (fraction > 0)
    fields = ["id", "source", "size", "source_size", "target", "whole"]
    settled = rows.where(~open_).select(*fields, F.when(F.col("size") > 0, F.col("whole")).otherwise(0).alias("copies"))
    level = rows.where(open_).select(
        F.xxhash64(F.lit(seed), "id", "size", "same", "copy_no").alias("key"), "size", (fraction * F.col("size")).alias("words"), F.struct(*fields).alias("row"), "n_blocks"
    )
    level = level.withColumn("block", F.pmod(F.col("key"), F.col("n_blocks"))).drop("n_blocks")
    done = [settled]
    while True:
        blocks = level.groupBy(F.col("row.source").alias("source"), "block").agg(F.sort_array(F.collect_list(F.struct("key", "size", "words", "row"))).alias("rows"))
        rounded = stored(blocks.select("block", _round_block(F.col("rows"), seed).alias("r")), "mix-level")
        decided = rounded.select(F.explode("r.out").alias("d"))
        done.append(decided.select("d.row.*", (F.col("d.row.whole") + F.col("d.copy")).alias("copies")))
        if n_blocks <= 1:
            break
        n_blocks = -(-n_blocks // block)
        level = rounded.select("r.carry.*", F.floor(F.col("block") / block).alias("block"))
    last = (_draw(F.col("r.carry.key"), F.lit(seed)) * F.col("r.carry.size") < F.col("r.carry.words")).cast("int")
    done.append(rounded.select("r.carry.row.*", (F.col("r.carry.row.whole") + last).alias("copies")))
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result.select(
        F.col("id").alias(id_col), "source", "size", "source_size", "target", F.col("copies").cast("long").alias("copies"), (F.col("size") * F.col("copies")).cast("long").alias("taken")
    )
