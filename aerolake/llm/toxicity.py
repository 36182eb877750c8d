"""Toxicity by a learned lexicon, Levenshtein automata and context windows.

The lexicon is learned from labelled documents that are not held out: words, and stems
(word beginnings shared by several words), whose documents are labelled toxic more often
than chance allows for so many words (a likelihood ratio beyond 2 ln vocabulary).  The
words stand in a trie.  A word counts once for each pair of words around it, so that
copies of a passage do not make its words telling.  A text's word is looked up as it is and by its stem; otherwise
the Levenshtein automaton of the word (one edit, words of 4 letters or more) is run
against the trie, and the word with each two neighbouring letters swapped is looked up,
so that misspelled terms count too.  A near word that clean training texts use is no
misspelling.  Letters around one digit or masking sign ('id1ot', 'l*ser') are tried as
one word, unless a piece of it is a term.  Terms have letters only, so words with two
such signs are beyond one edit.

Around each hit a window tells quotation from abuse: open quotation marks or a
reporting word before the hit.  Exact, misspelled and quoted weights are summed by
document, and a logistic regression over the three sums gives the score.

Scale: the training rows are a sample of labelled ids of about ``sample_labels`` rows,
by hash; the sampled labels are small by that bound and broadcast, so texts are never
shuffled.  Word counts are partial aggregates.  The lexicon is bounded by the sample's
vocabulary.  Scoring is one map pass; looked-up words are remembered per worker in two
bounded generations, which changes speed only.

Null and empty texts get the score of a text without hits.  Null labels are not used; of
several labels of an id the highest counts.  Without labels of both kinds every score is
0.  Repeated rows give repeated rows; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.boosting import logistic
from aerolake.llm.session import stored, use_package_on_workers

WORD = re.compile(r"[^\W\d_]+")
MASKED = re.compile(r"(?<![^\W_])[^\W\d_]++[\d*@$!#%&+|][^\W\d_]++(?![^\W_])")
STEMS = range(4, 8)
FUZZY_LENGTH = 5
SHORT_FUZZY_LENGTH = 4
REMEMBERED = 300_000

# Quotation marks, and words that report what others say.
OPENING, CLOSING = "\"“„«‹‘", "\"”“»›’"
REPORTING = frozenset("said says called wrote quoted quote quoting word term sagte nannte schrieb zitat wort dit appelé écrit cité mot dijo llamó escribió cita palabra".split())


class Trie:
    """A lexicon of words with weights, searched for words of ``least`` letters or more."""

    def __init__(self, words: dict[str, float], least: int = FUZZY_LENGTH):
        self.words, self.least = words, least
        self.root: dict = {}
        for word, weight in words.items():
            node = self.root
            for letter in word:
                node = node.setdefault(letter, {})
            node[""] = weight
        # a word at distance 1 differs by one letter in length at most, and keeps the first
        # half of the lexicon word as its beginning or the second as its end
        long = [w for w in words if len(w) >= least - 1]
        lengths = [(w, n) for w in long for n in (len(w) - 1, len(w), len(w) + 1)]
        self.heads = {(w[: len(w) // 2], n) for w, n in lengths}
        self.tails = {(w[len(w) // 2 :], n) for w, n in lengths}
        self.head_sizes = sorted({len(h) for h, _ in self.heads})
        self.tail_sizes = sorted({len(t) for t, _ in self.tails})
        self.longest = max(map(len, long), default=-1) + 1

    def near(self, word: str) -> float:
        """The highest weight of a lexicon word within one edit; 0 if there is none.

        The states of the word's Levenshtein automaton after a trie path are two bit sets:
        the beginnings of the word that the path equals, and those it is within one edit
        of.  Paths without a state are cut off.
        """
        n = len(word)
        if n < self.least or n > self.longest:
            return 0.0
        if not any((word[:k], n) in self.heads for k in self.head_sizes) and not any((word[-k:], n) in self.tails for k in self.tail_sizes):
            return 0.0
        places: dict[str, int] = {}
        for i, letter in enumerate(word):
            places[letter] = places.get(letter, 0) | 2 << i
        whole, best = 1 << n, 0.0
        stack = [(self.root, 1, 3)]
        while stack:
            node, equal, near = stack.pop()
            for letter, child in node.items():
                if letter:
                    at = places.get(letter, 0)
                    same = equal << 1 & at
                    # the letter matches, is extra in the path, replaces one, or one of the word is missing
                    close = near << 1 & at | equal | equal << 1 | same << 1 | same
                    if close:
                        stack.append((child, same, close))
                elif near & whole:
                    best = max(best, child)
        return best

    def swapped(self, word: str) -> float:
        """The highest weight of a lexicon word that is the word with two neighbouring letters swapped; 0 if there is none."""
        if not self.least <= len(word) < self.longest:
            return 0.0
        return max((self.words.get(word[:i] + word[i + 1] + word[i] + word[i + 2 :], 0.0) for i in range(len(word) - 1)), default=0.0)

    def disguised(self, word: str) -> float:
        """The highest weight by an edit or a swap."""
        return max(self.near(word), self.swapped(word))


class Lexicon:
    """Weights of words, stems and near words."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], innocent: frozenset[str] = frozenset()):
        self.words, self.stems, self.innocent = words, stems, innocent
        self.trie = Trie(words, SHORT_FUZZY_LENGTH)
        self.young: dict[str, float] = {}
        self.old: dict[str, float] = {}

    def __getstate__(self) -> dict:
        return {"words": self.words, "stems": self.stems, "innocent": self.innocent}

    def __setstate__(self, state: dict) -> None:
        self.__init__(**state)

    def exact(self, word: str) -> float:
        weight = self.words.get(word, 0.0)
        for n in STEMS:
            if n <= len(word):
                weight = max(weight, self.stems.get(word[:n], 0.0))
        return weight

    def weight(self, word: str) -> float:
        """Positive for a term, negative for a misspelled one, 0 for other words."""
        found = self.young.get(word)
        if found is None:
            found = self.old.get(word)
            if found is None:
                found = self.exact(word)
                if not found and word not in self.innocent:
                    found = -self.trie.disguised(word)
            if len(self.young) >= REMEMBERED:
                self.old, self.young = self.young, {}
            self.young[word] = found
        return found

    def sums(self, text: str | None) -> tuple[float, float, float]:
        """Sums of weights: exact, misspelled, quoted."""
        if not text:
            return 0.0, 0.0, 0.0
        text = text.lower()
        hits = {w for w in set(WORD.findall(text)) if self.weight(w)}
        exact = fuzzy = quoted = 0.0
        if hits:
            for m in WORD.finditer(text):
                if m[0] in hits:
                    w = self.weight(m[0])
                    if quotation(text, m.start(), m.end()):
                        quoted += abs(w)
                    elif w > 0:
                        exact += w
                    else:
                        fuzzy -= w
        masked = {w for w in set(MASKED.findall(text)) if self.weight(w) and not any(p in hits for p in WORD.findall(w))}
        if masked:
            for m in MASKED.finditer(text):
                if m[0] in masked:
                    w = abs(self.weight(m[0]))
                    if quotation(text, m.start(), m.end()):
                        quoted += w
                    else:
                        fuzzy += w
        return exact, fuzzy, quoted


def quotation(text: str, start: int, end: int, window: int = 60) -> bool:
    """Whether a window around a hit shows it as another's words."""
    before, after = text[max(0, start - window) : start], text[end : end + window]
    line = before.rsplit("\n", 1)[-1]
    opened = any(line.count(o) > (line.count(c) if c != o else line.count(o) // 2 * 2) and c in after for o, c in zip(OPENING, CLOSING))
    return opened or any(w in REPORTING for w in WORD.findall(before)[-4:])


def design(sums: np.ndarray) -> np.ndarray:
    """Regressors of the three sums."""
    return np.column_stack([np.log1p(sums), np.ones(len(sums))])


def training_sample(documents: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, folds: int, fold: int, sample_labels: int) -> DataFrame:
    """text and toxic (0 or 1) of about ``sample_labels`` labelled rows outside the held-out fold."""
    key = F.col(id_col).cast("string")
    usable = labels.where(F.col(label_col).isNotNull() & (F.crc32(key) % folds != fold)).groupBy(id_col).agg((F.max(label_col) > 0).cast("int").alias("toxic"))
    usable = stored(usable, "toxicity-labels")
    chance = int(min(1.0, sample_labels / max(usable.count(), 1)) * (1 << 20))
    sample = usable.where(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < chance).select(F.col(id_col).alias("labelled"), "toxic")
    joined = documents.select(F.col(id_col), F.col(text_col).alias("text")).join(F.broadcast(sample), F.col(id_col) == F.col("labelled"))
    return stored(joined.select(F.coalesce("text", F.lit("")).alias("text"), "toxic"), "toxicity-sample")


def learned_lexicon(sample: DataFrame, share: float = 0.8, min_stem_words: int = 3) -> Lexicon:
    """Words and stems whose documents are toxic more often than chance explains."""

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                words, contexts, toxic = [], [], []
                for text, label in zip(batch.column(0)[at : at + 200], batch.column(1)[at : at + 200].to_pylist()):
                    found = WORD.findall(text.as_py().lower())
                    mine = set(zip(found, ["", *found], [*found[1:], ""]))
                    words += [w for w, _, _ in mine]
                    contexts += [f"{a} {b}" for _, a, b in mine]
                    toxic += [label] * len(mine)
                yield pa.record_batch([pa.array(words, pa.string()), pa.array(contexts, pa.string()), pa.array(toxic, pa.int32())], ["word", "context", "toxic"])

    # a word counts once for the pair of words around it, however often that passage is copied
    seen = sample.mapInArrow(words_of, "word string, context string, toxic int").where("length(word) <= 40")
    seen = seen.groupBy("word", F.xxhash64("context").alias("context")).agg(F.avg("toxic").alias("t"))
    stats = stored(seen.groupBy("word").agg(F.sum("t").alias("t"), (F.count("*") - F.sum("t")).alias("c")), "toxicity-words")
    totals = stats.agg(F.coalesce(F.sum("t"), F.lit(0.0)).alias("t"), F.coalesce(F.sum("c"), F.lit(0.0)).alias("c"), F.count("*").alias("n")).first()
    if not totals.t or not totals.c:
        return Lexicon({}, {})
    p = totals.t / (totals.t + totals.c)
    bar = 2 * math.log(max(totals.n, 2))
    ratio = 2 * (
        F.col("t") * F.log(F.col("t") / (F.col("t") + F.col("c")) / p)
        + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / (F.col("t") + F.col("c")) / (1 - p))).otherwise(0.0)
    )
    telling = (F.col("t") >= share * (F.col("t") + F.col("c"))) & (ratio > bar)
    weight = F.log((F.col("t") + 0.5) / (totals.t + 1)) - F.log((F.col("c") + 0.5) / (totals.c + 1))
    words = {r.word: r.w for r in stats.where("t > 0").where(telling).select("word", weight.alias("w")).collect()}
    beginnings = stats.where(f"length(word) >= {STEMS[0]}").select(F.explode(F.array(*[F.when(F.length("word") >= n, F.substring("word", 1, n)) for n in STEMS])).alias("stem"), "t", "c")
    beginnings = beginnings.where("stem is not null").groupBy("stem").agg(F.sum("t").alias("t"), F.sum("c").alias("c"), F.sum(F.when(F.col("t") > 0, 1).otherwise(0)).alias("n"))
    chosen = {r.stem: r.w for r in beginnings.where(f"t > 0 and n >= {min_stem_words}").where(telling).select("stem", weight.alias("w")).collect()}
    # what a shorter stem tells about as well is left out
    stems = {s: w for s, w in chosen.items() if not any(chosen.get(s[:n], 0.0) > w - 1 for n in STEMS if n < len(s))}
    words = {w: x for w, x in words.items() if not any(stems.get(w[:n], 0.0) > x - 1 for n in STEMS)}
    lexicon = Lexicon(words, stems)
    share_ = sample.sparkSession.sparkContext.broadcast(lexicon)

    def near_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = share_.value
        for batch in batches:
            yield batch.filter(pa.array([bool(mine.trie.disguised(w)) and not mine.exact(w) for w in batch.column(0).to_pylist()], pa.bool_()))

    innocent = stats.where("c > 0").select("word").mapInArrow(near_words, "word string").collect()
    return Lexicon(words, stems, frozenset(r.word for r in innocent))


def toxicity(
    documents: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    folds: int = 3,
    fold: int = 1,
    sample_labels: int = 30_000,
    threshold: float = 0.7,
) -> DataFrame:
    """``id_col``, held_out, score and predicted of every row, and the three sums of weights.

    Ids whose crc32 as text is ``fold`` modulo ``folds`` are held out: their labels are not used.
    """
    spark = documents.sparkSession
    use_package_on_workers(spark)
    sample = training_sample(documents, labels, id_col=id_col, text_col=text_col, label_col=label_col, folds=folds, fold=fold, sample_labels=sample_labels)
    lexicon = spark.sparkContext.broadcast(learned_lexicon(sample))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = lexicon.value
        for batch in batches:
            sums = np.array([mine.sums(t.as_py()) for t in batch.column(1)]).reshape(-1, 3)
            yield pa.record_batch([batch.column(0), *[pa.array(sums[:, i]) for i in range(3)]], ["id", "exact", "misspelled", "quoted"])

    three = "exact double, misspelled double, quoted double"
    rows = sorted(sample.select(F.col("toxic").alias("id"), "text").mapInArrow(summed, f"id int, {three}").collect())
    y = np.array([float(r.id) for r in rows])
    known = len(set(y)) == 2
    weights = logistic(design(np.array([[r.exact, r.misspelled, r.quoted] for r in rows])), y, 0.1) if known else np.zeros(4)
    source = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    found = source.mapInArrow(summed, f"id {kind}, {three}")
    logit = F.lit(float(weights[3]))
    for name, w in zip(("exact", "misspelled", "quoted"), weights):
        logit = logit + F.log1p(name) * F.lit(float(w))
    score = 1 / (1 + F.exp(-logit)) if known else F.lit(0.0)
    held = F.coalesce(F.crc32(F.col("id").cast("string")) % folds == fold, F.lit(False))
    scored = found.withColumn("held_out", held).withColumn("score", score)
    return scored.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "exact", "misspelled", "quoted")
