"""Quality rules with host-level verdicts (DataFrame functions only).

Each text gets line, symbol and repetition counts and a base verdict.  Failures are
then summed by host (the ``source`` column), the host's failure rate is shrunk with a
beta prior fitted to all hosts by moments, and hosts whose shrunk rate exceeds
``max_rate`` fail as a whole: their verdict is joined back to their documents.

Scale: the per-text counts are array functions within a row, so texts are never
shuffled; the counts (a few numbers a row) are written once and read for both the host
sums and the join.  Host sums are partial aggregates, so a hot host is one row per task
before the shuffle.  The prior is a one-row aggregate over hosts.  Only failing hosts
are joined back; Spark broadcasts them if their measured size allows it and otherwise
splits a hot host's documents with its skew join.

Null text has no words and so fails the base rule; rows with a null host form one host.
Repeated rows are counted and judged row by row.  An empty table gives an empty result.
Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm.session import stored

# The characters between words, and the symbols that are counted.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    """Maximal runs of ``[^\\x20\\x09-\\x0D]`` in order."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def sorted_windows(words: str) -> Column:
    """(hash, position) of every 3-word window, sorted."""
    return F.expr(
        f"""sort_array(if(size({words}) < 4, array(), transform(sequence(0, size({words}) - 3),
              i -> named_struct('h', xxhash64({words}[i], {words}[i + 1], {words}[i + 2]), 'i', i))))"""
    )


def repeated_positions(windows: str) -> Column:
    """Positions, in order, of windows whose neighbour in hash order is equal."""
    return F.expr(
        f"""array_sort(transform(
              filter(
                transform({windows}, (x, k) -> named_struct('i', x.i, 'twice',
                  (k > 0 and {windows}[greatest(k - 1, 0)].h = x.h)
                  or (k + 1 < size({windows}) and {windows}[least(k + 1, size({windows}) - 1)].h = x.h))),
                x -> x.twice),
              x -> x.i))"""
    )


def covered_words(positions: str, width: int = 3) -> Column:
    """Number of words in the union of windows that start at sorted ``positions``."""
    return F.aggregate(
        positions,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda s, p: F.struct(
            (s["n"] + p + width - F.greatest(p.cast("long"), s["upto"])).alias("n"),
            (p + width).cast("long").alias("upto"),
        ),
        lambda s: s["n"],
    )


def base_rules(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    rows = documents.select(
        F.col(id_col).alias("id"),
        F.col(host_col).alias("host"),
        words_of(text).alias("words"),
        lines.alias("lines"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    rows = rows.withColumn("windows", sorted_windows("words")).withColumn("repeated", repeated_positions("windows"))
    counts = rows.select(
        "id",
        "host",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered_words("repeated").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counts.withColumn("base_failed", failed)


def host_rates(base: DataFrame, *, max_strength: float = 1000.0) -> DataFrame:
    """host, n, failed, and its failure rate shrunk to the mean of all with a beta prior.

    The prior's mean is the overall failure rate m and its strength, by moments from
    the hosts' rates, m (1 - m) / var - 1, kept within 1 and ``max_strength`` (which
    holds when the hosts do not differ).
    """
    hosts = base.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    prior = hosts.agg(
        (F.sum("failed") / F.sum("n")).alias("mean"),
        F.var_pop(F.col("failed") / F.col("n")).alias("var"),
    ).select(
        "mean",
        F.when(F.col("var") * (max_strength + 1) <= F.col("mean") * (1 - F.col("mean")), F.lit(max_strength))
        .otherwise(F.greatest(F.lit(1.0), F.col("mean") * (1 - F.col("mean")) / F.col("var") - 1))
        .alias("strength"),
    )
    # the prior is one row by construction
    return hosts.join(F.broadcast(prior)).select(
        "host", "n", "failed", ((F.col("failed") + F.col("strength") * F.col("mean")) / (F.col("n") + F.col("strength"))).alias("rate")
    )


def host_verdicts(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_rate: float = 0.5,
) -> DataFrame:
    """The base counts and verdict of every row, host_failed, and kept (neither the text nor its host fails)."""
    base = stored(base_rules(documents, id_col=id_col, text_col=text_col, host_col=host_col), "host-rules")
    failing = host_rates(base).where(F.col("rate") > max_rate).select(F.col("host").alias("bad"), F.lit(True).alias("host_failed"))
    judged = base.join(failing, base["host"].eqNullSafe(failing["bad"]), "left").withColumn("host_failed", F.coalesce("host_failed", F.lit(False)))
    return judged.select(
        F.col("id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"),
        "host_failed",
    )
