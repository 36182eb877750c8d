"""Benchmark decontamination with an FM-index per training shard.

Words are maximal runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z.
The test phrases are every window of 13 consecutive words of an item; an item with
fewer words, but not none, is one phrase.  A shard is a slice of a partition's
documents.  Its index holds the words that occur in some phrase; all others are
separators.  A stretch between separators that is shorter than the shortest phrase
can hold no occurrence and is left out, so the index stays small and exact.  All
phrases are searched backward through the ranks of a wavelet matrix over the shard's
Burrows-Wheeler transform; each hit is located by stepping back to a sampled suffix
position; spans that overlap are merged.  A shard's texts are split and looked up a slice
at a time, and of its words only the symbols are held.

The work is map-only.  The phrases are broadcast in blocks of items of at most
``block_bytes`` of benchmark text: with one block there is no shuffle, with more each
block makes a pass and the spans of a document meet in one grouping.  An item of more
bytes than a block is a block of its own.

Null text has no words: 0 words, no spans, no items.  Null items and items without
words have no phrases.  Items with the same text all count; a repeated (item_id, text)
row counts once.  Repeated documents give repeated rows.  Extra columns are not read;
a carried text goes to the search and back once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.session import use_package_on_workers
from aerolake.llm.words import ALPHANUMERIC, SequenceHash, pieces, split_words, word_hashes

WINDOW = 13
SAMPLE = 8
#: bytes of text in a shard, and of those split at once; one longer text is handled alone
SHARD_BYTES = 4 << 20
SLICE_BYTES = 512 << 10


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit plane for each bit of a symbol."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits = bits
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for b in reversed(range(bits)):
            bit = ((symbols >> b) & 1).astype(bool)
            ones = np.zeros(len(symbols) + 1, dtype=np.int32 if len(symbols) < 1 << 31 else np.int64)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(symbols) - int(ones[-1]))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def rank(self, symbols: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before position ``upto``."""
        low, high = np.zeros_like(upto), upto
        for plane, b in enumerate(reversed(range(self.bits))):
            ones, zeros = self.ones[plane], self.zeros[plane]
            bit = ((symbols >> b) & 1).astype(bool)
            low1, high1 = ones[low], ones[high]
            low = np.where(bit, zeros + low1, low - low1)
            high = np.where(bit, zeros + high1, high - high1)
        return high - low


class ShardIndex:
    """FM-index over stretches of words; ``text`` has 0 for the separator that ends each stretch."""

    def __init__(self, text: np.ndarray, bits: int):
        n = len(text)
        separator = text == 0
        n_separators = int(separator.sum())
        # separators differ from one another, so a suffix is decided within its stretch
        rank = np.where(separator, np.cumsum(separator) - 1, text.astype(np.int64) + n_separators)
        reach = 1
        while True:
            following = np.zeros(n, dtype=np.int64)
            following[: max(0, n - reach)] = rank[reach:] + 1
            key = rank * np.int64(2 * n + int(text.max(initial=0)) + 2) + following
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank = np.empty(n, dtype=np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            if rank[order[-1]] == n - 1:
                break
            reach *= 2
        previous = text[order - 1]
        self.matrix = WaveletMatrix(previous, bits)
        self.previous = previous
        counts = np.bincount(text, minlength=1 << bits)
        self.before = np.cumsum(counts) - counts  # symbols smaller than each
        sampled = (order % SAMPLE == 0) | (previous == 0)
        self.sampled = sampled
        self.slot = np.cumsum(sampled) - 1
        self.positions = order[sampled]
        self.n = n

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each phrase; ``phrases`` is right-aligned."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.n, dtype=np.int64)
        alive = np.arange(len(phrases))
        for back in range(1, phrases.shape[1] + 1):
            alive = alive[(lengths[alive] >= back) & (high[alive] > low[alive])]
            if not len(alive):
                break
            symbol = phrases[alive, -back]
            ranks = self.matrix.rank(np.concatenate([symbol, symbol]), np.concatenate([low[alive], high[alive]]))
            low[alive] = self.before[symbol] + ranks[: len(alive)]
            high[alive] = self.before[symbol] + ranks[len(alive) :]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, by steps back to a sampled one."""
        rows = rows.copy()
        found = np.empty(len(rows), dtype=np.int64)
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            done = self.sampled[rows[open_]]
            found[open_[done]] = self.positions[self.slot[rows[open_[done]]]] + steps
            open_ = open_[~done]
            symbol = self.previous[rows[open_]].astype(np.int64)
            rows[open_] = self.before[symbol] + self.matrix.rank(symbol, rows[open_])
            steps += 1
        return found


class Phrases:
    """The distinct phrases of benchmark items, as symbols of their own vocabulary."""

    def __init__(self, item_ids: list[str], texts: list[str | None], window: int = WINDOW):
        words = split_words(pa.array(texts, pa.string()), ALPHANUMERIC, lower=True)
        hashes = word_hashes(words)
        self.vocabulary, symbols = np.unique(hashes, return_inverse=True)
        symbols = symbols + 1  # 0 is the separator
        sizes = np.diff(words.first)
        self.item_ids = list(dict.fromkeys(item_ids))
        number = {x: i for i, x in enumerate(self.item_ids)}
        items = np.array([number[x] for x in item_ids], dtype=np.int64)
        n_windows = np.where(sizes == 0, 0, np.maximum(1, sizes - window + 1))
        item = np.repeat(np.arange(len(sizes)), n_windows)
        start = words.first[:-1][item] + np.arange(len(item)) - (np.cumsum(n_windows) - n_windows)[item]
        length = np.minimum(sizes[item], window)
        rows = np.zeros((len(item), window), dtype=np.int32)  # fewer words than bytes of a block of items
        for back in range(1, window + 1):
            has = length >= back
            rows[has, -back] = symbols[start[has] + length[has] - back]
        rows, phrase = np.unique(rows, axis=0, return_inverse=True) if len(rows) else (rows, np.empty(0, np.int64))
        self.rows, self.lengths = rows, (rows > 0).sum(axis=1)
        self.bits = max(1, int(len(self.vocabulary)).bit_length())
        self.shortest = int(self.lengths.min(initial=window))
        # the items of each phrase: item_of[first_item[p]:first_item[p + 1]]
        pairs = np.unique(np.stack([phrase.reshape(-1), items[item]], axis=1), axis=0) if len(rows) else np.empty((0, 2), np.int64)
        self.first_item = np.searchsorted(pairs[:, 0], np.arange(len(rows) + 1))
        self.item_of = pairs[:, 1]

    def symbols(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The symbol of each word of the texts, 0 for words of no phrase, and the first word of each text (one entry more than texts)."""
        found, sizes = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for part in pieces(iter([pa.record_batch([texts], ["text"])]), 0, SLICE_BYTES):
            words = split_words(part.column(0), ALPHANUMERIC, lower=True)
            hashes = word_hashes(words)
            at = np.minimum(np.searchsorted(self.vocabulary, hashes), max(0, len(self.vocabulary) - 1))
            found.append(np.where(self.vocabulary[at] == hashes, at + 1, 0).astype(np.int32) if len(self.vocabulary) else np.zeros(len(at), np.int32))
            sizes.append(np.diff(words.first))
        return np.concatenate(found), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])

    def find(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word counts of the texts, merged spans (text, start, end) and pairs (text, item), each sorted."""
        symbols, first = self.symbols(texts)
        sizes = np.diff(first)
        none = sizes, np.empty((0, 3), np.int64), np.empty((0, 2), np.int64)
        if not len(self.rows) or not len(symbols):
            return none
        known = symbols > 0
        # stretches of known words within a text
        edge = np.zeros(len(known) + 1, dtype=bool)
        edge[first] = True
        padded = np.concatenate([[False], known, [False]])
        begins = np.flatnonzero(padded[1:-1] & (~padded[:-2] | edge[:-1]))
        finishes = np.flatnonzero(padded[1:-1] & (~padded[2:] | edge[1:])) + 1
        long = finishes - begins >= self.shortest
        begins, finishes = begins[long], finishes[long]
        if not len(begins):
            return none
        spans = finishes - begins + 1  # with the separator
        offset = np.cumsum(spans) - spans
        origin = np.arange(int(spans.sum())) - np.repeat(offset - begins, spans)
        text = symbols[np.minimum(origin, len(symbols) - 1)]
        text[offset + spans - 1] = 0
        index = ShardIndex(text, self.bits)
        low, high = index.search(self.rows, self.lengths)
        hits = high - low
        phrase = np.repeat(np.arange(len(hits)), hits)
        if not len(phrase):
            return none
        row = np.arange(len(phrase)) + np.repeat(low - (np.cumsum(hits) - hits), hits)
        start = origin[index.locate(row)]
        owner = np.searchsorted(first, start, side="right") - 1
        covered = np.zeros(len(known) + 1, dtype=np.int64)
        np.add.at(covered, start, 1)
        np.add.at(covered, start + self.lengths[phrase], -1)
        covered = np.concatenate([[False], np.cumsum(covered)[:-1] > 0, [False]])
        begins = np.flatnonzero(covered[1:-1] & (~covered[:-2] | edge[:-1]))
        finishes = np.flatnonzero(covered[1:-1] & (~covered[2:] | edge[1:])) + 1
        span_owner = np.searchsorted(first, begins, side="right") - 1
        base = first[span_owner]
        pairs = np.unique(np.stack([owner, phrase], axis=1), axis=0)
        counts = (self.first_item[1:] - self.first_item[:-1])[pairs[:, 1]]
        item = self.item_of[np.arange(counts.sum()) + np.repeat(self.first_item[pairs[:, 1]] - (np.cumsum(counts) - counts), counts)]
        pairs = np.unique(np.stack([np.repeat(pairs[:, 0], counts), item], axis=1), axis=0)
        return sizes, np.stack([span_owner, begins - base, finishes - base], axis=1), pairs


def _item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The benchmark's rows in blocks of at most ``block_bytes``, one block on the driver at a time."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).where("text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for b in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b)
        block, size = [], 0
        for r in part.orderBy("item", "text").toLocalIterator():
            if block and size + len(r.text) > 2 * block_bytes:
                yield block
                block, size = [], 0
            block.append((r.item, r.text))
            size += len(r.text)
        if block or n == 1:
            yield block


def contaminated_spans(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    carry: Sequence[str] = (),
    window: int = WINDOW,
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """Per document: ``id_col``, the ``carry`` columns, n_words, spans (array of start, end in words, merged), n_hit, item_ids (sorted strings)."""
    spark = documents.sparkSession
    use_package_on_workers(spark)
    # carried columns travel under numbers: their names may be anything; the text travels once
    travels = ["text" if c == text_col else f"k{i}" for i, c in enumerate(carry)]
    others = {k: c for c, k in zip(carry, travels) if k != "text"}
    carried = [*["text"] * ("text" in travels), *others]
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(k) for k, c in others.items()])
    kinds = "".join(f", {f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in carried)
    kind = rows.schema["id"].dataType.simpleString()
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def searched(block: list[tuple[str, str]], keyed: bool) -> DataFrame:
        phrases = spark.sparkContext.broadcast(Phrases([i for i, _ in block], [t for _, t in block], window))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mine = phrases.value
            for piece in pieces(batches, 1, SHARD_BYTES):
                sizes, spans, pairs = mine.find(piece.column(1))
                owners = np.arange(piece.num_rows + 1)
                found = pa.StructArray.from_arrays([pa.array(spans[:, 1], pa.int32()), pa.array(spans[:, 2], pa.int32())], ["start", "end"])
                items = pa.array([mine.item_ids[i] for i in pairs[:, 1]], pa.string())
                out = [
                    piece.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(spans[:, 0], owners), pa.int32()), found).cast(spans_type),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(pairs[:, 0], owners), pa.int32()), items),
                ]
                names = ["id", "n_words", "spans", "item_ids", *carried, *["key"] * keyed]
                yield pa.record_batch([*out, *piece.columns[1 if "text" in carried else 2 :]], names)

        schema = f"id {kind}, n_words long, spans array<struct<start:int,end:int>>, item_ids array<string>{kinds}"
        source = rows.withColumn("key", F.xxhash64("text", *others)) if keyed else rows
        return source.mapInArrow(search, schema + (", key long" if keyed else ""))

    blocks = _item_blocks(benchmark, item_col, item_text_col, block_bytes)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        found = searched(first, keyed=False)
    else:
        found, n = searched(first, keyed=True).unionByName(searched(second, keyed=True)), 2
        for block in blocks:
            found, n = found.unionByName(searched(block, keyed=True)), n + 1
        # exact repeats of a row meet in one group: as many rows come out as went in
        found = found.groupBy("id", "key").agg(
            F.min("n_words").alias("n_words"),
            *[F.first(k).alias(k) for k in carried],
            F.array_distinct(F.flatten(F.collect_set("spans"))).alias("spans"),
            F.array_distinct(F.flatten(F.collect_set("item_ids"))).alias("item_ids"),
            (F.count("*") / n).cast("int").alias("copies"),
        )
        found = found.withColumn("copies", F.explode(F.sequence(F.lit(1), "copies")))
        # spans of different blocks may overlap: merge them in order
        found = found.withColumn(
            "spans",
            F.expr(
                """aggregate(array_sort(spans), cast(array() as array<struct<start:int,end:int>>), (a, s) ->
                   if(size(a) > 0 and s.start < element_at(a, -1).end,
                      concat(slice(a, 1, size(a) - 1), array(struct(element_at(a, -1).start as start, greatest(element_at(a, -1).end, s.end) as end))),
                      concat(a, array(s))))"""
            ),
        )
    return found.select(
        F.col("id").alias(id_col),
        *[F.col(k).alias(c) for c, k in zip(carry, travels)],
        "n_words",
        "spans",
        F.expr("aggregate(spans, 0L, (a, s) -> a + s.end - s.start)").alias("n_hit"),
        F.array_sort("item_ids").alias("item_ids"),
    )


def contamination(documents: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", share: int = 20, **options) -> DataFrame:
    """``contaminated_spans`` with the verdict: contaminated if n_hit > 0 and ``share`` * n_hit >= n_words."""
    found = contaminated_spans(documents, benchmark, id_col=id_col, **options)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
