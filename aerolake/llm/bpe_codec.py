"""BPE encoding and decoding by speculation and verification.

``encoded`` gives the token ids of whole texts for a byte-level BPE vocabulary with word
ends, and the text that the ids decode to.  Each distinct piece of a slice of texts is
split greedily into the longest tokens of the vocabulary (the speculation).  All adjacent
pairs of all proposals are then tested together, as numpy arrays: two tokens are
compatible if merging by rank never joins symbols across the border between them.  A
proposal whose tokens can all be reached by merging and whose adjacent pairs are all
compatible is the BPE result; only the pieces that fail are merged exactly.

Why the test is enough: a first merge across a border in the whole piece happens between
two neighbouring tokens, and up to then each token's symbols have merged as they do
alone; so the same merge would happen when merging these two alone.  The test undoes the
merges of the two tokens from the latest to the first along the border; in each state the
pair at the border may have no rank below the merge undone last (ties go to the left).
This needs merges that only use symbols of lower rank, as training gives them; with a
vocabulary that has others, all pieces are merged exactly.

Map-only: no shuffle, no state between rows.  Results of pieces are remembered per Python
worker in two generations of bounded size, which changes speed only.  Texts are handled
in slices of about 1 MB of text, a longer text alone and whole; memory grows with the
longest text.  Null and empty texts have no ids and decode to an empty text.  Repeated
rows give repeated rows, an empty table an empty result; extra input columns are not read.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.session import use_package_on_workers
from aerolake.llm.word_pieces import byte_symbols, special_pattern, text_pieces
from aerolake.llm.words import pieces as slices

#: entries of each of the two generations of remembered pieces
REMEMBERED = 200_000
#: bytes of text handled at once
SLICE_BYTES = 1 << 20
#: bytes of the longest piece that is merged together with others
SHORT = 48
#: stands between pieces; symbols are characters up to 511
BETWEEN = chr(512)
NEVER = np.iinfo(np.int64).max


def _grouped(ids: np.ndarray, owner: np.ndarray, n: int) -> list[list[int]]:
    """The ids of each of n owners, in their order."""
    order = np.argsort(owner, kind="stable")
    ids, ends = ids[order].tolist(), np.cumsum(np.bincount(owner, minlength=n)).tolist()
    return [ids[a:b] for a, b in zip([0, *ends], ends)]


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = special_pattern(spec)
        self.special_ids = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: token for token, i in vocab.items()} | {i: token for token, i in self.special_ids.items()}
        symbols = byte_symbols()
        self.inner = [vocab.get(c) for c in symbols]
        self.final = [vocab.get(c + end) for c in symbols]
        if None in self.inner or None in self.final:
            raise ValueError("the vocabulary lacks symbols of some bytes")
        self._read_merges(vocab, model["merges"])
        self._read_tokens(vocab, end)
        self.young: dict[str, list[int]] = {}
        self.old: dict[str, list[int]] = {}

    def _read_merges(self, vocab: dict[str, int], merges: list) -> None:
        size = max(self.names) + 1
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        self.rank, self.left, self.right = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size, np.int64)
        proper = True
        for rank, merge in enumerate(merges):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            a, b, made = vocab[a], vocab[b], vocab[a + b]
            proper &= self.rank[made] < 0 and max(self.rank[a], self.rank[b]) < rank
            self.ranks[a, b] = (rank, made)
            self.rank[made], self.left[made], self.right[made] = rank, a, b
        self.made = np.array([made for _, made in self.ranks.values()], dtype=np.int64)
        pairs = np.array([(a << 32 | b, rank) for (a, b), (rank, _) in self.ranks.items()], dtype=np.int64).reshape(-1, 2)
        pairs = pairs[np.argsort(pairs[:, 0])]
        self.pair_keys, self.pair_ranks = np.append(pairs[:, 0], NEVER), np.append(pairs[:, 1], 0)
        made = np.flatnonzero(self.rank >= 0)
        #: tokens that merging their own symbols gives
        self.reached = np.full(size, proper)
        self.reached[made] &= self._kept_apart(self.left[made], self.right[made], last=False)
        for t in made[np.argsort(self.rank[made])].tolist():
            self.reached[t] &= self.reached[self.left[t]] and self.reached[self.right[t]]

    def _read_tokens(self, vocab: dict[str, int], end: str) -> None:
        """The trie of all tokens, written in symbols: a byte's character, 256 higher if it ends a word."""
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        self.trie = ahocorasick.Automaton()
        for token, i in vocab.items():
            ends = bool(end) and token.endswith(end) and (self.rank[i] >= 0 or i in self.final)
            data = [byte_of.get(c) for c in (token[: -len(end)] if ends else token)]
            if data and None not in data:
                data[-1] += 256 * bool(ends)
                self.trie.add_word("".join(map(chr, data)), i)
        self.trie.add_word(BETWEEN, -1)
        self.trie.make_automaton()

    def proposed(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest tokens of all pieces, and the piece that each is from."""
        text = BETWEEN.join(p[:-1].decode("latin-1") + chr(256 + p[-1]) for p in new)
        ids = np.fromiter((i for _, i in self.trie.iter_long(text)), dtype=np.int64)
        between = ids < 0
        return ids[~between], np.cumsum(between)[~between]

    def _kept_apart(self, left: np.ndarray, right: np.ndarray, last: bool = True) -> np.ndarray:
        """Whether merging the symbols of left[i] right[i] never joins across their border.

        With ``last`` False a merge of the two whole tokens is allowed.
        """
        apart = np.ones(len(left), dtype=bool)
        open_, a, b = np.arange(len(left)), left.copy(), right.copy()
        limit = np.full(len(left), NEVER if last else -1)
        while len(open_):
            key = a << 32 | b
            at = np.searchsorted(self.pair_keys, key)
            joined = (self.pair_keys[at] == key) & (2 * self.pair_ranks[at] < limit)
            apart[open_[joined]] = False
            rank_a, rank_b = self.rank[a], self.rank[b]
            on = ~joined & ((rank_a >= 0) | (rank_b >= 0))
            open_, a, b, rank_a, rank_b = open_[on], a[on], b[on], rank_a[on], rank_b[on]
            right_later = rank_b >= rank_a  # of equal ones the left is merged first
            limit = np.where(right_later, 2 * rank_b + 1, 2 * rank_a)
            a, b = np.where(right_later, a, self.right[a]), np.where(right_later, self.left[b], b)
        return apart

    def verified(self, ids: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Which of n proposals are the result of merging."""
        good = np.ones(n, dtype=bool)
        good[owner[~self.reached[ids]]] = False
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, where = np.unique(ids[inside] << 32 | ids[inside + 1], return_inverse=True)
        apart = self._kept_apart(pairs >> 32, pairs & 0xFFFFFFFF)
        good[owner[inside[~apart[where]]]] = False
        return good

    def symbols(self, data: bytes) -> list[int]:
        return [*map(self.inner.__getitem__, data[:-1]), self.final[data[-1]]]

    def merged(self, data: bytes) -> list[int]:
        """Exact merging of one piece: the adjacent pair of lowest rank first, of equal ones the leftmost."""
        ids = self.symbols(data)
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(self.ranks[p][0], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.ranks]
        heapq.heapify(queue)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # changed meanwhile
            made = self.ranks[a, b][1]
            ids[i], ids[j] = made, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n and (pair := (ids[x], ids[y])) in self.ranks:
                    heapq.heappush(queue, (self.ranks[pair][0], x, *pair))
        return [t for t in ids if t >= 0]

    def merged_together(self, pieces: list[bytes]) -> list[list[int]]:
        """Exact merging of many short pieces: each round merges the first pair of each piece."""
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        ids = np.fromiter(chain.from_iterable(map(self.symbols, pieces)), dtype=np.int64, count=int(sizes.sum()))
        owner = np.repeat(np.arange(len(pieces)), sizes)
        done_ids, done_owner = [], []
        while len(ids):
            key = np.append(ids[:-1] << 32 | ids[1:], -1)
            at = np.searchsorted(self.pair_keys, key)
            rank = np.where((self.pair_keys[at] == key) & (np.append(owner[1:], -1) == owner), self.pair_ranks[at], NEVER)
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(ids))))
            still = least < NEVER
            done_ids.append(ids[~still])
            done_owner.append(owner[~still])
            ids, owner, rank, least = ids[still], owner[still], rank[still], least[still]
            lowest = np.flatnonzero(rank == least)
            lowest = lowest[np.append(True, owner[lowest[1:]] != owner[lowest[:-1]])] if len(lowest) else lowest
            ids[lowest] = self.made[rank[lowest]]
            kept = np.ones(len(ids), dtype=bool)
            kept[lowest + 1] = False
            ids, owner = ids[kept], owner[kept]
        return _grouped(np.concatenate(done_ids or [ids]), np.concatenate(done_owner or [owner]), len(pieces))

    def learn(self, wanted: set[str]) -> dict[str, list[int]]:
        """Token ids of all the wanted pieces."""
        known, new = {}, []
        for p in wanted:
            found = self.young.get(p) or self.old.get(p)
            if found is None:
                new.append(p)
            else:
                known[p] = found
        data = [p.encode() for p in new]
        ids, owner = self.proposed(data)
        good = self.verified(ids, owner, len(new))
        known.update((p, x) for p, x, g in zip(new, _grouped(ids, owner, len(new)), good.tolist()) if g)
        failed = np.flatnonzero(~good).tolist()
        short = [i for i in failed if len(data[i]) <= SHORT]
        known.update(zip((new[i] for i in short), self.merged_together([data[i] for i in short])))
        known.update((new[i], self.merged(data[i])) for i in failed if len(data[i]) > SHORT)
        if len(self.young) + len(known) > REMEMBERED:
            self.old, self.young = self.young, {}
        if len(known) <= REMEMBERED:
            self.young.update(known)
        return known

    def encode_all(self, texts: list[str | None]) -> list[list[int]]:
        """Token ids of each text; special strings in it are their own tokens."""
        split = []  # of each text: lists of pieces, with special ids between them
        for text in texts:
            parts, at = [], 0
            for m in self.special.finditer(text or "") if self.special else ():
                parts += [text_pieces(text[at : m.start()]), self.special_ids[m[0]]]
                at = m.end()
            split.append([*parts, text_pieces((text or "")[at:])])
        known = self.learn({p for parts in split for part in parts if isinstance(part, list) for p in part})
        out = []
        for parts in split:
            ids: list[int] = []
            for part in parts:
                if isinstance(part, list):
                    ids.extend(chain.from_iterable(map(known.__getitem__, part)))
                else:
                    ids.append(part)
            out.append(ids)
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of token ids: this format has no decoder, so tokens stand apart by spaces."""
        return " ".join(map(self.names.__getitem__, ids))


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec for a vocabulary file, loaded once."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encoded(documents: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ids (array of int) and decoded (text) of every row.

    ``vocabulary`` is the path of the tokenizer file on the workers.
    """
    use_package_on_workers(documents.sparkSession)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(vocabulary)
        for batch in slices(batches, 1, SLICE_BYTES):
            ids = bpe.encode_all(batch.column(1).to_pylist())
            decoded = pa.array([bpe.decode(x) for x in ids], pa.string())
            flat = pa.array(np.fromiter(chain.from_iterable(ids), np.int32, sum(map(len, ids))))
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32))
            yield pa.record_batch([batch.column(0), pa.ListArray.from_arrays(offsets, flat), decoded], ["id", "ids", "decoded"])

    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(coded, f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)
