"""Removal of long passages that repeat across documents, by de Bruijn compaction.

Words are runs of ``[^\\x20\\x09-\\x0D]``.  A window of 50 words is an edge of the word
graph.  A word is removed if a window that covers it has a word sequence that also
starts in a document with a smaller id.  Windows are judged on the input.

1. Compaction.  Of the ``k``-mers in a window the one with the smallest hash is its
   anchor.  Consecutive windows of a document with the same anchor occurrence are one
   path, kept as (anchor hash, hash of all its words, source coordinates): about one row
   for 13 words, in one map pass.
2. Anchors that occur once are dropped.  Paths are grouped by (anchor, content): all but
   those of the smallest document are repeats as a whole, without branching.
3. Where an anchor has several contents the graph branches.  The first document's
   paths of each such content go back to their source coordinates and are expanded into
   windows; windows are grouped by (anchor, window hash), and those that also start in a
   smaller document are repeats.
4. The spans of 2 and 3 are joined to the documents by (id, text hash).

Equality is by two 64-bit hashes, of the anchor and of the whole path or window.

Scale: texts are shuffled twice, for branching paths and for the result; everything
else is rows of hashes and coordinates.  Groupings are partial aggregates, so an anchor
or passage shared by a third of all documents is one row per task before the shuffle;
joins back are equi-joins whose hot side Spark's skew join splits.  No pairs of
documents are made.  Steps are written tables; the shuffles before them are released.

A null text has no words; a null id is not smaller than another and loses nothing.
Rows that share an id are one document for the rule and are cut by their own text.
An empty table gives an empty result.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.session import free_finished_shuffles, stored, use_package_on_workers
from aerolake.llm.words import SPACED, SequenceHash, pieces, split_words, word_hashes

WINDOW = 50
K = 25


def first_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost minimum in each run of ``width`` values, by doubling."""
    best, at, span = values, np.arange(len(values), dtype=np.int64), 1

    def joined(gap: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(best) - gap
        right = best[gap:] < best[:n]
        return np.where(right, best[gap:], best[:n]), np.where(right, at[gap:], at[:n])

    while span * 2 <= width:
        best, at = joined(span)
        span *= 2
    if span < width:
        best, at = joined(width - span)
    return at


def anchored_paths(texts: pa.Array, window: int, k: int) -> tuple[np.ndarray, ...]:
    """Paths of the texts: text index, anchor hash, content hash, first window, number of windows."""
    words = split_words(texts, SPACED)
    n = len(words.starts)
    if n < window:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    sequence = SequenceHash(word_hashes(words))
    owner = words.owner
    begin = np.arange(n - k + 1)
    kmers = sequence.of(begin, begin + k)
    anchor = first_minimum(kmers, window - k + 1)
    whole = owner[: n - window + 1] == owner[window - 1 :]
    new = whole.copy()
    new[1:] &= ~whole[:-1] | (anchor[1:] != anchor[:-1])
    start = np.flatnonzero(new)
    upto = np.cumsum(whole)  # a path's windows follow each other
    count = np.diff(np.append(upto[start] - 1, upto[-1]))
    text = owner[start]
    content = sequence.of(start, start + count + window - 1)
    return text, kmers[anchor[start]].view(np.int64), content.view(np.int64), start - words.first[text], count


def repeated_spans(documents: DataFrame, *, id_col: str, text_col: str, window: int, k: int) -> DataFrame:
    """id, mark (text hash), start, end (in words) of what repeats a smaller document; spans may overlap."""
    spark = documents.sparkSession
    rows = documents.select(F.col(id_col).alias("id"), F.hash(text_col).alias("mark"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    kind = rows.schema["id"].dataType.simpleString()

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, 2):
            text, anchor, content, start, count = anchored_paths(piece.column(2), window, k)
            if len(text):
                take = pa.array(text)
                yield pa.record_batch(
                    [pa.array(anchor), pa.array(content), piece.column(0).take(take), piece.column(1).take(take), pa.array(start, pa.int32()), pa.array(count, pa.int32())],
                    ["anchor", "content", "id", "mark", "start", "windows"],
                )

    every = stored(rows.mapInArrow(paths, f"anchor long, content long, id {kind}, mark int, start int, windows int"), "dedup-paths")
    # aggregates are written before they are joined: Spark splits a hot key of a join only
    # when both sides come straight from a shuffle
    shared = stored(every.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "dedup-shared-anchors")
    common = stored(every.join(shared, "anchor", "left_semi"), "dedup-shared-paths")
    free_finished_shuffles(spark)
    contents = stored(common.groupBy("anchor", "content").agg(F.min("id").alias("first_id")), "dedup-contents")
    branching = common.groupBy("anchor").agg(F.min("content").alias("low"), F.max("content").alias("high")).select("anchor", (F.col("low") < F.col("high")).alias("branching"))
    branching = stored(branching, "dedup-branching")
    judged = stored(common.join(contents, ["anchor", "content"]).join(branching, "anchor").where("id > first_id or branching"), "dedup-judged")
    whole = judged.where("id > first_id").select("id", "mark", "start", (F.col("start") + F.col("windows") + window - 1).alias("end"))

    # copies of a row have the same paths: one of each is enough
    ends = judged.where("id = first_id").dropDuplicates(["id", "mark", "start"]).groupBy("id", "mark").agg(F.collect_list(F.struct("start", "windows", "anchor")).alias("paths"))

    def expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, 2, 1 << 20):
            words = split_words(piece.column(2), SPACED)
            sequence = SequenceHash(word_hashes(words))
            lists = piece.column(3)
            text = np.repeat(np.arange(piece.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            path = lists.flatten()
            start, count, anchor = (path.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            each = np.repeat(np.arange(len(start)), count)
            position = start[each] + np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
            at = words.first[text[each]] + position
            take = pa.array(text[each])
            yield pa.record_batch(
                [pa.array(anchor[each]), pa.array(sequence.of(at, at + window).view(np.int64)), piece.column(0).take(take), piece.column(1).take(take), pa.array(position, pa.int32())],
                ["anchor", "content", "id", "mark", "start"],
            )

    source = rows.join(ends, ["id", "mark"]).select("id", "mark", "text", "paths")
    windows = stored(source.mapInArrow(expanded, f"anchor long, content long, id {kind}, mark int, start int"), "dedup-windows")
    free_finished_shuffles(spark)
    firsts = windows.groupBy("anchor", "content").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id")).where("first_id < last_id").select("anchor", "content", "first_id")
    firsts = stored(firsts, "dedup-firsts")
    edges = windows.join(firsts, ["anchor", "content"]).where("id > first_id").select("id", "mark", "start", (F.col("start") + window).alias("end"))
    return stored(whole.unionByName(edges).distinct().groupBy("id", "mark").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "dedup-spans")


def without_repeats(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, k: int = K) -> DataFrame:
    """``id_col``, n_words, n_removed, spans (merged, in words) and text (kept words joined by a space) of every row."""
    spark = documents.sparkSession
    use_package_on_workers(spark)
    spans = repeated_spans(documents, id_col=id_col, text_col=text_col, window=window, k=k)
    free_finished_shuffles(spark)
    rows = documents.select(F.col(id_col).alias("id"), F.hash(text_col).alias("mark"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, 1):
            n_words, n_removed, merged, kept = [], [], [], []
            for text, found in zip(piece.column(1), piece.column(2)):
                words = (text.as_py() or "").encode().split()
                n_words.append(len(words))
                union: list[dict[str, int]] = []
                if found.is_valid:
                    pairs = found.values
                    start, end = (pairs.field(i).to_numpy(zero_copy_only=False) for i in range(2))
                    gone = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(gone, start, 1)
                    np.add.at(gone, end, -1)
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], np.cumsum(gone)[:-1] > 0, [False]]).astype(np.int8)))
                    union = [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]
                    for s in reversed(union):
                        del words[s["start"] : s["end"]]
                merged.append(union)
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.record_batch(
                [piece.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(merged, spans_type), pa.array(kept, pa.string())],
                ["id", "n_words", "n_removed", "spans", "text"],
            )

    # rows with a null id have no spans and find none: null equals nothing
    cuttable = rows.join(spans, ["id", "mark"], "left").select("id", "text", "spans")
    result = cuttable.mapInArrow(cut, f"id {kind}, n_words long, n_removed long, spans array<struct<start:int,end:int>>, text string")
    return result.select(F.col("id").alias(id_col), "n_words", "n_removed", "spans", F.col("text").alias("text"))
