"""Token counts by heap-and-linked-list byte-pair merging.

``token_counts`` counts the tokens of whole texts for a byte-level BPE vocabulary with
word ends (the ``tokenizers`` JSON format: NFC, white space and lower-case
normalisation, a splitting pattern, merges within a piece).  A piece starts as a linked
list of its byte symbols, the last one marked as the word's end; a heap holds the
adjacent pairs that have a merge rank.  The lowest rank, leftmost first, is popped and
merged until none is left.  The count is the number of initial symbols less the number
of merges; no identifiers are made.  Counts of pieces are remembered per Python worker in
two generations of bounded size, which changes speed only.

Map-only: no shuffle, no state between rows.  Null text counts as empty, 0 tokens; a very
long text is one row's work, in memory as its list of pieces.  An empty table gives an
empty result.  Repeated rows give repeated rows; extra input columns are not read.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.session import use_package_on_workers
from aerolake.llm.word_pieces import byte_symbols, special_pattern, text_pieces

#: entries of each of the two generations of remembered pieces
REMEMBERED = 300_000


class PieceCounter:
    """Counts the tokens of texts for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(tuple(m.split(" ")) if isinstance(m, str) else m for m in model["merges"]):
            self.ranks[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.inner = [vocab.get(c) for c in byte_symbols()]
        self.final = [vocab.get(c + end) for c in byte_symbols()]
        self.special = special_pattern(spec)
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def merged(self, piece: str) -> int:
        """Initial symbols less merges of one piece."""
        data = piece.encode()
        symbols = [self.inner[b] for b in data[:-1]]
        symbols.append(self.final[data[-1]])
        symbols = [s for s in symbols if s is not None]
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        ranks, heap = self.ranks, []
        for i in range(n - 1):
            found = ranks.get((symbols[i], symbols[i + 1]))
            if found:
                heap.append((found[0], i, symbols[i], symbols[i + 1]))
        heapq.heapify(heap)
        merges = 0
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue  # one of the two was merged meanwhile
            new = ranks[left, right][1]
            merges += 1
            symbols[i], symbols[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                found = ranks.get((new, symbols[k]))
                if found:
                    heapq.heappush(heap, (found[0], i, new, symbols[k]))
            h = before[i]
            if h >= 0:
                found = ranks.get((symbols[h], new))
                if found:
                    heapq.heappush(heap, (found[0], h, symbols[h], new))
        return n - merges

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        young = self.young
        total = 0
        for piece in text_pieces(text):
            count = young.get(piece)
            if count is None:
                count = self.old.get(piece)
                if count is None:
                    count = self.merged(piece)
                if len(young) >= REMEMBERED:
                    self.old, self.young = young, {}
                    young = self.young
                young[piece] = count
            total += count
        return total

    def count(self, text: str | None) -> int:
        """Tokens of a text; each special string in it is one token."""
        if not text:
            return 0
        if self.special is None:
            return self.plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self.plain(p) for p in parts)


_counters: dict[str, PieceCounter] = {}


def counter(path: str) -> PieceCounter:
    """The worker's counter for a vocabulary file, loaded once."""
    if path not in _counters:
        _counters[path] = PieceCounter(path)
    return _counters[path]


def token_counts(
    documents: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048
) -> DataFrame:
    """``id_col``, n_bytes, n_tokens and over_limit (n_tokens > ``limit``) of every row.

    ``vocabulary`` is the path of the tokenizer file on the workers.
    """
    use_package_on_workers(documents.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = counter(vocabulary)
        for batch in batches:
            tokens = [bpe.count(t.as_py()) for t in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(tokens, pa.int64())], ["id", "n_bytes", "n_tokens"])

    rows = documents.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text_col).alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(counted, f"id {kind}, n_bytes long, n_tokens long").select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
