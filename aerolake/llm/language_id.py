"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1; a letter trigram is bound from its
letters' vectors, rotated by two, one and no places, by multiplication; a text's vector
bundles (adds) the vectors of its trigrams and a language's prototype those of its
training texts.  A document gets the language of the most similar prototype by cosine.
Both sides are centred on the mean of the prototypes' directions, which takes out what all
languages share.

Trigrams are taken around every letter of the lower-cased text; any run of other
characters counts as one blank.  Letters beyond a-z share 37 further vectors by code
point, so that any script has a profile.

Scale: training is one map pass; a task's counts are summed by language and bundled
into one vector per language and task, and the vectors are added by a grouping.  The
prototypes, one vector a language, are broadcast; more than ``max_languages`` learned
languages raise an error, which bounds them to ``max_languages`` * ``dimensions`` * 8
bytes.  Prediction is one map pass.  No text is shuffled.

Null texts and texts without letters get ``und`` with score 0; without any training
text so does every document.  Null languages are not learned.  Equal similarities go to
the language that sorts first.  Repeated rows give repeated rows; extra columns are
not read.  A kept text goes to the prediction and back once.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm.session import use_package_on_workers
from aerolake.llm.words import pieces

DIMENSIONS = 512
SLOTS = 64
UNDETERMINED = "und"
#: characters whose trigrams are counted at once; one longer text is handled alone
CHARACTERS = 1 << 18


@lru_cache(maxsize=1)
def letter_slots() -> np.ndarray:
    """Slot of each code point: 0 for anything but letters, 1 to 26 for a-z, 27 to 63 for others."""
    slots = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
    others = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == "L"]
    slots[others] = 27 + np.array(others) % 37
    slots[ord("a") : ord("z") + 1] = np.arange(1, 27)
    return slots


@lru_cache(maxsize=2)
def letter_vectors(dimensions: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The slots' vectors rotated by two, one and no places."""
    vectors = np.random.default_rng(97).integers(0, 2, (SLOTS, dimensions), dtype=np.int8) * 2 - 1
    vectors = vectors.astype(np.int8)
    return np.roll(vectors, 2, axis=1), np.roll(vectors, 1, axis=1), vectors


def bound(codes: np.ndarray, dimensions: int) -> np.ndarray:
    """Vectors of trigram codes."""
    two, one, none = letter_vectors(dimensions)
    return (two[codes >> 12] * one[(codes >> 6) & 63] * none[codes & 63]).astype(np.float32)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram codes of lower-cased texts and the index of the text each is from."""
    lowered = [t.lower() for t in texts]
    data = ("\n" + "\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass")
    slots = letter_slots()[np.frombuffer(data, dtype=np.uint32)].astype(np.int32)
    at = np.flatnonzero(slots)
    codes = (slots[at - 1] << 12) | (slots[at] << 6) | slots[at + 1]
    ends = np.cumsum([len(t) + 1 for t in lowered])
    return codes, np.searchsorted(ends, at - 1, side="right")


def counted(codes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, and how often each of ``n`` owners has each of them."""
    seen = np.zeros(SLOTS**3, dtype=np.int32)
    seen[codes] = 1
    distinct = np.flatnonzero(seen)
    seen[distinct] = np.arange(len(distinct))
    counts = np.bincount(owner * len(distinct) + seen[codes], minlength=n * len(distinct))
    return distinct, counts.reshape(n, len(distinct))


def strings(column: pa.Array) -> Iterator[str | None]:
    """The texts of a column, one string at a time."""
    return (t.as_py() for t in column)


def groups(texts: Iterable[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about ``CHARACTERS`` characters, at most 64, with the first one's index."""
    at, part, size = 0, [], 0
    for i, t in enumerate(texts):
        part.append(t or "")
        size += len(part[-1])
        if size >= CHARACTERS or len(part) == 64:
            yield at, part
            at, part, size = i + 1, [], 0
    if part:
        yield at, part


def prototypes(documents: DataFrame, *, text_col: str, lang_col: str, dimensions: int = DIMENSIONS, max_languages: int = 1000) -> dict[str, np.ndarray]:
    """The bundled vector of each language's texts."""
    use_package_on_workers(documents.sparkSession)

    def bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            languages = batch.column(1).to_pylist()
            for at, part in groups(strings(batch.column(0))):
                codes, owner = trigrams(part)
                mine = languages[at : at + len(part)]
                for language in set(mine):
                    of = np.array([x == language for x in mine])
                    found = np.bincount(codes[of[owner]], minlength=SLOTS**3)
                    counts[language] = counts[language] + found if language in counts else found
        for language, found in counts.items():
            codes = np.flatnonzero(found)
            total = np.zeros(dimensions)
            for a in range(0, len(codes), 4096):
                total += found[codes[a : a + 4096]] @ bound(codes[a : a + 4096], dimensions).astype(np.float64)
            yield pa.record_batch([pa.array([language] * dimensions), pa.array(range(dimensions), pa.int32()), pa.array(total)], ["lang", "place", "value"])

    learned = documents.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    # integer sums below 2**53: the same in any order
    sums = learned.mapInArrow(bundled, "lang string, place int, value double").groupBy("lang", "place").agg(F.sum("value").alias("value"))
    vectors = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("v")).select("lang", F.col("v.value").alias("v"))
    found = vectors.limit(max_languages + 1).collect()
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    return {r.lang: np.array(r.v) for r in sorted(found, key=lambda r: r.lang)}


def predicted_languages(documents: DataFrame, learned: dict[str, np.ndarray], *, text_col: str, keep: dict[str, Column | None], dimensions: int = DIMENSIONS) -> DataFrame:
    """The ``keep`` columns (name, expression; none: the text), lang_pred and score (cosine, at least 0) of every row."""
    spark = documents.sparkSession
    use_package_on_workers(spark)
    names = list(learned)
    directions = np.stack([v / (np.linalg.norm(v) or 1.0) for v in learned.values()]) if names else np.zeros((0, dimensions))
    centre = directions.mean(axis=0) if len(names) > 1 else np.zeros(dimensions)
    directions = directions - centre
    directions /= np.maximum(np.linalg.norm(directions, axis=1, keepdims=True), 1e-12)
    model = spark.sparkContext.broadcast((names, directions.astype(np.float32), centre.astype(np.float32)))
    # kept columns travel under numbers: their names may be anything; the text travels once
    travels = ["text" if c is None else f"k{i}" for i, c in enumerate(keep.values())]
    rows = documents.select(F.col(text_col).alias("text"), *[c.alias(k) for k, c in zip(travels, keep.values()) if c is not None])
    fields = rows.schema[0 if "text" in travels else 1 :]
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in fields)
    names_out = [f.name for f in fields]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, directions, centre = model.value
        for batch in batches:
            languages, scores = [], []
            for _, part in groups(strings(batch.column(0))):
                codes, owner = trigrams(part)
                if not len(codes) or not names:
                    languages += [UNDETERMINED] * len(part)
                    scores += [0.0] * len(part)
                    continue
                distinct, counts = counted(codes, owner, len(part))
                vectors = counts.astype(np.float32) @ bound(distinct, dimensions)
                size = np.linalg.norm(vectors, axis=1, keepdims=True)
                vectors = vectors / np.maximum(size, 1e-12) - centre
                vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
                cosines = vectors @ directions.T
                best = cosines.argmax(axis=1)
                some = counts.any(axis=1)
                languages += [names[b] if s else UNDETERMINED for b, s in zip(best, some)]
                scores += [float(min(1.0, max(0.0, c[b]))) if s else 0.0 for b, s, c in zip(best, some, cosines)]
            out = [*batch.columns[len(batch.columns) - len(names_out) :], pa.array(languages, pa.string()), pa.array(scores, pa.float64())]
            out = pa.record_batch(out, [*names_out, "lang_pred", "score"])
            yield from pieces(iter([out]), 0) if names_out[:1] == ["text"] else [out]

    found = rows.mapInArrow(predict, f"{schema}lang_pred string, score double")
    return found.select(*[F.col(t).alias(k) for k, t in zip(keep, travels)], "lang_pred", "score")


def identify_languages(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    carry: Sequence[str] = (),
    folds: int = 4,
    fold: int = 2,
    dimensions: int = DIMENSIONS,
) -> DataFrame:
    """``id_col``, the ``carry`` columns, held_out, lang_pred and score of every row.

    Rows whose crc32 of the id as text is ``fold`` modulo ``folds`` are held out: nothing is
    learned from them, nor from rows with a null id.
    """
    part = F.crc32(F.col(id_col).cast("string")) % folds
    learned = prototypes(documents.where(part != fold), text_col=text_col, lang_col=lang_col, dimensions=dimensions)
    keep = {id_col: F.col(id_col)} | {c: None if c == text_col else F.col(c) for c in carry} | {"held_out": F.coalesce(part == fold, F.lit(False))}
    return predicted_languages(documents, learned, text_col=text_col, keep=keep, dimensions=dimensions)
