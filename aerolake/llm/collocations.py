"""Phrase collocation mining on a weighted de Bruijn graph.

A node is three consecutive words of a piece, an edge four: it goes from its first three
words to its last three, and weighs as much as it occurs.  Per language:

1. ``frequency_filter``: one pass counts words and word pairs in a fixed number of hashed
   counters, a second one grams of three and four words whose pairs all passed.  A counter is
   never below the true count, so a gram whose counter stays below ``min_count`` cannot be
   in a phrase that often.  A filter is 2**bits bits, whatever the input; a larger input
   needs more bits to be as selective, but never to be right.
2. ``longest_grams``: every word position gives the longest gram from it on, up to four
   words, that passes.  Four words are an edge; fewer correct for a run that ends there, with
   the piece or because no longer gram can be frequent.  These are counted within slices
   of text, then over all tasks.
3. ``phrase_counts``: a node's count is its flow, the weights of its outgoing edges, plus
   the runs that end in it; the counts of two words and one follow from it in the same
   way.  So each gram adds its weight to each of its beginnings, in one aggregation.
4. ``phrase_paths``: a node whose whole flow comes in by one edge and leaves by one edge
   is unary; edges linked by unary nodes are compacted to paths by pointer doubling.  A
   path is a phrase of any length with one weight, in rows of at most ``SEGMENT`` edges.
   The candidates of four words are the windows of the paths.
5. ``collocations`` cuts each candidate, looks its parts' counts up by a join, and scores.

Counts are exact for all phrases with ``min_count`` or more, and so are scores (products
in 38 digits).  Strings are compared by their UTF-8 bytes.

Scale: the texts are read three times, and only counters and passing grams are shuffled;
a task holds one byte a counter.  Hot words and phrases are aggregated before every shuffle; in joins one side has
one row a phrase, so Spark can split the other; the ranking keeps ``top`` rows a language
and task before the shuffle.  Texts are handled in slices of about 2 MB, a longer text
alone and whole; a path never is in one row.

Null texts are empty, null languages ``und``.  Repeated rows count again.  Ties in the
score go to the more frequent phrase, then to the smaller one.  Empty tables give no
rows.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.session import stored, use_package_on_workers
from aerolake.llm.words import Words, mixed, pieces, split_words, word_hashes

# Fixed values of the contract: bytes that end a piece, and those that part words.
ENDS = np.isin(np.arange(256), [*b".,;:!?", *range(0x0A, 0x0E)])
INSIDE = ~ENDS & ~np.isin(np.arange(256), [0x20, 0x09])

#: words of an edge
LONGEST = 4
#: counters of one block of the filter
BLOCK = 1 << 16
#: edges of one row of a path
SEGMENT = 1024
STEP = np.uint64(0x9E3779B97F4A7C15)


def _shifted(values: np.ndarray, k: int) -> np.ndarray:
    """The value k places on, 0 beyond the end."""
    return np.append(values[k:], np.zeros(min(k, len(values)), dtype=values.dtype))


class Slice:
    """Words of a slice of texts, the words that follow them in their piece, and their hashes per language."""

    def __init__(self, batch: pa.RecordBatch, bits: int):
        langs = batch.column(0).dictionary_encode()
        self.langs = langs.dictionary
        self.words: Words = split_words(batch.column(1), INSIDE, lower=True)
        owner = self.words.owner
        self.lang = langs.indices.to_numpy(zero_copy_only=False)[owner]
        ends = np.cumsum(ENDS[self.words.raw])[self.words.starts] if len(owner) else owner
        #: whether the next word is of the same piece
        self.linked = np.append((owner[1:] == owner[:-1]) & (ends[1:] == ends[:-1]), False)[: len(owner)]
        seeds = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in self.langs.to_pylist()], dtype=np.uint64)
        hashes = mixed(word_hashes(self.words) ^ seeds[self.lang]) if len(owner) else np.empty(0, np.uint64)
        shift = np.uint64(64 - bits)
        #: of each word, the counters of the grams of one to four words that begin with it
        self.at, grams = [], hashes
        for k in range(1, LONGEST + 1):
            self.at.append((grams >> shift).astype(np.int64))
            grams = mixed(grams * STEP + _shifted(hashes, k))

    def passing(self, filters: list[np.ndarray]) -> list[np.ndarray]:
        """Whether the gram of one to four words from each word on is in one piece and passes the filters.

        ``filters``: of words and pairs, and of longer grams; a filter that is not there lets all pass.
        """
        told = lambda f, at: (f[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
        out = [told(filters[0], self.at[0]) if filters else np.ones(len(self.lang), dtype=bool)]
        for k in range(1, LONGEST):
            both = out[-1] & _shifted(out[-1], 1)
            if k == 1:
                both &= self.linked
            some = filters[(k > 1)] if len(filters) > (k > 1) else None
            out.append(both & told(some, self.at[k]) if some is not None else both)
        return out

    def compact(self) -> tuple[np.ndarray, np.ndarray]:
        """All words joined by one space each, and where each begins (one more than words)."""
        sizes = self.words.ends - self.words.starts
        begins = np.append(0, np.cumsum(sizes + 1))
        source = np.arange(int(sizes.sum())) + np.repeat(self.words.starts - (np.cumsum(sizes) - sizes), sizes)
        text = np.full(int(begins[-1]), 0x20, dtype=np.uint8)
        text[np.arange(len(source)) + np.repeat(np.arange(len(sizes)), sizes)] = self.words.raw[source]
        return text, begins


def _slices(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[Slice]:
    return (Slice(b, bits) for b in pieces(batches, 1))


def _packed(counts: np.ndarray, dtype: np.dtype) -> bytes:
    """A block of counters: all of them, or the filled ones' places and values if that is shorter."""
    filled = np.flatnonzero(counts)
    if len(filled) * (2 + dtype.itemsize) < BLOCK * dtype.itemsize:
        return filled.astype(np.uint16).tobytes() + counts[filled].astype(dtype).tobytes()
    return counts.astype(dtype).tobytes()


def _add_packed(counts: np.ndarray, data: bytes, dtype: np.dtype, cap: int) -> None:
    if len(data) == BLOCK * dtype.itemsize:
        counts += np.frombuffer(data, dtype=dtype)
    else:
        n = len(data) // (2 + dtype.itemsize)
        counts[np.frombuffer(data[: 2 * n], dtype=np.uint16)] += np.frombuffer(data[2 * n :], dtype=dtype)  # places are distinct
    np.minimum(counts, cap, out=counts)


def frequency_filter(texts: DataFrame, min_count: int, bits: int, before: np.ndarray | None = None) -> np.ndarray:
    """2**bits bits: whether the counter of a gram reached ``min_count``. ``texts``: lang, text.

    Words and pairs are counted; with the filter ``before`` of these, the longer grams
    whose words and pairs pass it.
    """
    dtype = np.min_scalar_type(min_count)
    known = None if before is None else texts.sparkSession.sparkContext.broadcast(before)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, dtype=dtype)
        for s in _slices(batches, bits):
            passing = s.passing([] if known is None else [known.value])
            sizes = (0, 1) if known is None else range(2, LONGEST)
            places, more = np.unique(np.concatenate([s.at[k][passing[k]] for k in sizes]), return_counts=True)
            counts[places] = np.minimum(counts[places].astype(np.int64) + more, min_count)
        blocks = counts.reshape(-1, BLOCK)
        for k in np.flatnonzero(blocks.any(axis=1)).tolist():
            yield pa.record_batch([pa.array([k], pa.int32()), pa.array([_packed(blocks[k], dtype)], pa.binary())], ["block", "data"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                _add_packed(blocks.setdefault(k, np.zeros(BLOCK, dtype=np.uint32)), data, dtype, min_count)
        packed = [np.packbits(b >= min_count, bitorder="little").tobytes() for b in blocks.values()]
        yield pa.record_batch([pa.array(list(blocks), pa.int32()), pa.array(packed, pa.binary())], ["block", "data"])

    parts = texts.mapInArrow(counted, "block int, data binary").repartition("block").mapInArrow(merged, "block int, data binary")
    out = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for block, data in parts.collect():  # 2**bits bits in all
        out[block * (BLOCK // 8) : (block + 1) * (BLOCK // 8)] = np.frombuffer(data, dtype=np.uint8)
    return out


def longest_grams(texts: DataFrame, filters: list[np.ndarray], bits: int) -> DataFrame:
    """lang, words, phrase and count of the longest gram, up to four words, that passes, from every word on.

    The row of no words has the number of all words of its language.
    """
    told = texts.sparkSession.sparkContext.broadcast(filters)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _slices(batches, bits):
            if not len(s.lang):
                continue
            passing = s.passing(told.value)
            word, size = passing[0], np.sum(passing, axis=0)
            first = np.flatnonzero(word)
            size = size[first]
            text, begins = s.compact()
            starts = begins[first]
            lengths = begins[first + size] - 1 - starts
            offsets = np.append(0, np.cumsum(lengths))
            data = text[np.arange(int(offsets[-1])) + np.repeat(starts - offsets[:-1], lengths)]
            phrases = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))
            found = pa.table({"lang": s.lang[first], "words": size.astype(np.int32), "phrase": phrases})
            found = found.group_by(["lang", "words", "phrase"], use_threads=False).aggregate([([], "count_all")])
            totals = np.bincount(s.lang, minlength=len(s.langs))
            lang = np.concatenate([found["lang"].to_numpy(), np.arange(len(totals))])
            words = np.concatenate([found["words"].to_numpy(), np.zeros(len(totals), dtype=np.int32)])
            phrase = pa.concat_arrays([*found["phrase"].cast(pa.string()).chunks, pa.array([""] * len(totals))])
            count = np.concatenate([found["count_all"].to_numpy(), totals])
            yield pa.record_batch([s.langs.take(pa.array(lang)).cast(pa.string()), pa.array(words), phrase, pa.array(count)], ["lang", "words", "phrase", "n"])

    rows = texts.mapInArrow(grams, "lang string, words int, phrase string, n long")
    return rows.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))


def _first(phrase: Column, words: Column | int) -> Column:
    return F.call_function("substring_index", phrase, F.lit(" "), F.lit(words) if isinstance(words, int) else words)


def phrase_counts(grams: DataFrame, min_count: int) -> DataFrame:
    """lang, words, phrase and f of every phrase of one to four words with ``min_count`` occurrences or more."""
    begun = grams.where("words > 0").select("lang", "phrase", "n", F.explode(F.sequence(F.lit(1), F.col("words"))).alias("words"))
    flow = begun.groupBy("lang", "words", _first(F.col("phrase"), F.col("words")).alias("phrase")).agg(F.sum("n").alias("f"))
    return flow.where(F.col("f") >= min_count)


def phrase_paths(counts: DataFrame) -> DataFrame:
    """lang, head (the path's first four words), at (of the row's first edge), weight and path (its words) of the paths.

    ``counts``: of ``phrase_counts``, written.
    """
    edges = counts.where(F.col("words") == LONGEST).select("lang", F.col("phrase").alias("edge"), "f")
    none = F.lit(None).cast("struct<f:bigint,edge:string>")
    came = edges.select("lang", _first(F.col("edge"), -LONGEST + 1).alias("node"), F.struct("f", "edge").alias("into"), none.alias("out"), F.lit(None).cast("long").alias("flow"))
    left = edges.select("lang", _first(F.col("edge"), LONGEST - 1).alias("node"), none.alias("into"), F.struct("f", "edge").alias("out"), F.lit(None).cast("long").alias("flow"))
    nodes = counts.where(F.col("words") == LONGEST - 1).select("lang", F.col("phrase").alias("node"), none.alias("into"), none.alias("out"), F.col("f").alias("flow"))
    joints = came.unionByName(left).unionByName(nodes).groupBy("lang", "node").agg(F.max("into").alias("into"), F.max("out").alias("out"), F.max("flow").alias("flow"))
    links = joints.where("into.f = flow AND out.f = flow").select("lang", F.col("out.edge").alias("edge"), F.col("into.edge").alias("before"))
    chained = edges.join(links, ["lang", "edge"], "left").select("lang", "edge", "f", F.coalesce("before", "edge").alias("head"), F.col("before").isNotNull().cast("long").alias("at"), F.col("before").isNotNull().alias("open"))
    chained = stored(chained, "phrase-chains")
    # a closed ring cannot be unary all around: each piece's words enter it by a node that then has more flow
    while chained.where("open").limit(1).count():
        far = chained.select("lang", F.col("edge").alias("head"), F.col("head").alias("far"), F.col("at").alias("further"), F.col("open").alias("on"))
        moved = chained.where("open").join(far, ["lang", "head"], "left")
        chained = stored(moved.select("lang", "edge", "f", F.col("far").alias("head"), (F.col("at") + F.col("further")).alias("at"), F.col("on").alias("open")).unionByName(chained.where("NOT open")), "phrase-chains")
    part = F.floor(F.col("at") / SEGMENT).alias("part")
    rows = chained.groupBy("lang", "head", part).agg(F.max("f").alias("weight"), F.sort_array(F.collect_list(F.struct("at", "edge"))).alias("edges"))
    rest = F.transform(F.slice(F.col("edges.edge"), F.lit(2), F.lit(SEGMENT)), lambda e: _first(e, -1))
    return rows.select("lang", "head", F.col("edges")[0]["at"].alias("at"), "weight", F.concat(F.split(F.col("edges")[0]["edge"], " "), rest).alias("path"))


def candidates(counts: DataFrame, paths: DataFrame) -> DataFrame:
    """lang, words, phrase and a of the candidates: two and three words from the counts, four from the paths."""
    window = F.transform(F.sequence(F.lit(1), F.size("path") - (LONGEST - 1)), lambda i: F.array_join(F.slice("path", i, LONGEST), " "))
    four = paths.select("lang", F.lit(LONGEST).alias("words"), F.explode(window).alias("phrase"), F.col("weight").alias("a"))
    return counts.where(F.col("words").between(2, LONGEST - 1)).withColumnRenamed("f", "a").select(*four.columns).unionByName(four)


def _exact(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def collocations(
    documents: DataFrame, *, min_count: int = 30, top: int = 2000, inside: int = 80, bits: int = 26, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the ``top`` phrases of each language.

    ``inside``: a phrase is dropped if a longer candidate around it has this percentage of
    its occurrences.  ``bits``: a filter has 2**bits counters.
    """
    if not 16 <= bits <= 32 or min_count < 1:
        raise ValueError("bits must be from 16 to 32 and min_count at least 1")
    use_package_on_workers(documents.sparkSession)
    texts = documents.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    frequent = frequency_filter(texts, min_count, bits)
    filters = [frequent, frequency_filter(texts, min_count, bits, frequent)]
    grams = stored(longest_grams(texts, filters, bits), "phrase-grams")
    counts = stored(phrase_counts(grams, min_count), "phrase-counts")
    found = stored(candidates(counts, phrase_paths(counts)), "phrase-candidates")
    return ranked(found, counts, grams.where("words = 0").select("lang", "n"), top, inside)


def ranked(found: DataFrame, counts: DataFrame, totals: DataFrame, top: int, inside: int) -> DataFrame:
    """The candidates' best rows, from the counts of their parts and of the candidates around them."""
    cuts = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut")
    cut = found.select("lang", "phrase", "words", cuts)
    sides = cut.select("lang", "phrase", "cut", F.explode(F.array(F.struct(F.lit("l").alias("side"), _first(F.col("phrase"), F.col("cut")).alias("part")), F.struct(F.lit("r").alias("side"), _first(F.col("phrase"), F.col("cut") - F.col("words")).alias("part")))).alias("p"))
    sides = sides.select("lang", "phrase", "cut", "p.side", "p.part")
    looked = sides.join(counts.select("lang", F.col("phrase").alias("part"), "f"), ["lang", "part"]).select("lang", "phrase", F.concat("side", F.col("cut").cast("string")).alias("what"), F.col("f").alias("value"))
    around = found.where("words > 2").select("lang", "a", F.split("phrase", " ").alias("w"))
    inner = lambda k: F.transform(F.sequence(F.lit(1), F.size("w") - k + 1), lambda i: F.array_join(F.slice("w", i, k), " "))
    shorter = F.flatten(F.transform(F.sequence(F.lit(2), F.size("w") - 1), inner))
    around = around.select("lang", F.explode(shorter).alias("phrase"), F.lit("around").alias("what"), F.col("a").alias("value"))
    own = found.select("lang", "phrase", F.lit("a").alias("what"), F.col("a").alias("value"))
    names = ["a", "around", *[f"{side}{k}" for k in range(1, LONGEST) for side in "lr"]]
    told = looked.unionByName(around).unionByName(own).groupBy("lang", "phrase").agg(*[F.max(F.when(F.col("what") == name, F.col("value"))).alias(name) for name in names])
    told = told.where((F.col("around").isNull()) | (_exact(F.col("around")) * 100 < _exact(F.col("a")) * inside))
    score = lambda k: F.expr(f"(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l{k} as decimal(20,0)) + cast(r{k} as decimal(20,0)))")
    scored = [F.when(F.col(f"l{k}").isNotNull(), F.struct(score(k).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in range(1, LONGEST)]
    best = told.select("lang", "phrase", "a", F.array_min(F.filter(F.array(*scored), lambda s: s.isNotNull())).alias("best")).select("lang", "phrase", "a", "best.score", "best.l", "best.r")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    first = best.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
