"""Collocations against a plain Python count."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from aerolake.llm.collocations import candidates, collocations, frequency_filter, longest_grams, phrase_counts, phrase_paths
from aerolake.llm.session import stored

SCHEMA = "doc_id long, text string, lang string, phrase string, words string, a long, n long"
COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def split(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [p for p in (re.findall(r"[^\x20\x09]+", s) for s in re.split(r"[.,;:!?\x0A-\x0D]", text)) if p]


def counted(rows):
    n, f = Counter(), Counter()
    for _, text, lang, *_ in rows:
        for piece in split(text):
            n[lang or "und"] += len(piece)
            f.update((lang or "und", tuple(piece[i : i + k])) for k in range(1, 5) for i in range(len(piece) - k + 1))
    return n, f


def by_hand(rows, min_count, top):
    n, f = counted(rows)
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= min_count}
    dropped = set()
    for (lang, w), b in cand.items():
        for k in range(2, len(w)):
            dropped |= {(lang, w[i : i + k]) for i in range(len(w) - k + 1) if 100 * b >= 80 * cand[lang, w[i : i + k]]}
    out = []
    for (lang, w), a in cand.items():
        cuts = [(2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        if (lang, w) not in dropped:
            out.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    rank, rows = Counter(), []
    for lang, score, a, phrase, l, r in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            rows.append((lang, rank[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return rows


@pytest.fixture(scope="module")
def rows():
    """Repeated passages, repeated words, all separators, capitals, nulls, a long text and clashing columns."""
    rng = random.Random(17)
    words = [f"w{i}" for i in range(25)] + ["É", "É", "ÉTÉ", "straße", "the"]
    passage = " ".join(f"p{i}" for i in range(60))
    out = []
    for i in range(150):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", " ", "\t", "  ", ", ", ".", "\n", "?! ", "\x0b", "; "]) for _ in range(rng.randrange(60)))
        text = rng.choice([text, text.upper(), text + " " + passage, passage + " " + text, "la " * rng.randrange(9)])
        out.append((i, text, ["en", "fr", None, "und"][i % 4], "x", "y", 1, 2))
    out += [(900, None, "en", "x", "y", 1, 2), (901, "", None, "x", "y", 1, 2), (902, " .,;\t\n", "de", "x", "y", 1, 2), (None, passage, "fr", "x", "y", 1, 2)]
    return out + [out[3]] * 5 + [(903, "one of the long " * 3000, "en", "x", "y", 1, 2)]


@pytest.mark.parametrize("min_count, top, bits", [(5, 2000, 24), (300, 7, 16)])
def test_collocations_match_a_plain_count(spark, rows, min_count, top, bits):
    got = collocations(spark.createDataFrame(rows, SCHEMA).repartition(4), min_count=min_count, top=top, bits=bits)
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got.collect()) == by_hand(rows, min_count, top)


def test_counts_and_paths(spark, rows):
    texts = spark.createDataFrame(rows, SCHEMA).selectExpr("coalesce(lang, 'und') AS lang", "text")
    frequent = frequency_filter(texts, 5, 20)
    longer = frequency_filter(texts, 5, 20, frequent)
    assert len(frequent) == len(longer) == 2**20 // 8
    counts = stored(phrase_counts(longest_grams(texts, [frequent, longer], 20), 5), "t")
    _, f = counted(rows)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in counts.collect()} == {x: n for x, n in f.items() if n >= 5}
    paths = phrase_paths(counts)
    four = Counter({(r.lang, tuple(r.phrase.split(" "))): r.a for r in candidates(counts, paths).where("words = 4").collect()})
    assert four == {x: n for x, n in f.items() if n >= 5 and len(x[1]) == 4}
    longest = max(paths.collect(), key=lambda r: len(r.path))
    assert longest.path == [f"p{i}" for i in range(60)]  # the whole passage is one path


def test_a_filter_without_any_effect_changes_nothing(spark, rows):
    texts = spark.createDataFrame(rows, SCHEMA).selectExpr("coalesce(lang, 'und') AS lang", "text")
    _, f = counted(rows)
    kept = phrase_counts(longest_grams(texts, [np.full(2**16 // 8, 255, dtype=np.uint8)] * 2, 16), 5)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in kept.collect()} == {x: n for x, n in f.items() if n >= 5}


def test_empty_tables(spark):
    assert collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert collocations(spark.createDataFrame([(1, "once upon", "en", "x", "y", 1, 2)], SCHEMA)).count() == 0


def test_scores_beyond_64_bits(spark):
    from aerolake.llm.collocations import ranked

    a = 9_000_000_000_000
    counts = spark.createDataFrame([("en", 1, "a", a), ("en", 1, "b", a + 1), ("en", 2, "a b", a)], "lang string, words int, phrase string, f long")
    found = counts.where("words = 2").withColumnRenamed("f", "a")
    row = ranked(found, counts, counts.selectExpr("lang", "f AS n").limit(1), 10, 80).first()
    assert row.score == 2_000_000 * a // (2 * a + 1)
