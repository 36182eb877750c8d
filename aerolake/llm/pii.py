"""Personal data by candidate generators, boosted trees and calibrated thresholds.

High-recall generators propose spans of a text, which may overlap: e-mail addresses
(plain and spelled out), dotted quads, card-like and phone-like digit runs, loose digit
runs, social security numbers, and long tokens that mix letters and digits.  The base
kinds (email, ip, card, phone) that pass their checks are always selected.  A card or
phone run that fails is proposed as ``card_like`` or ``phone_like``, with its parts: the
stretches of whole digit groups with the digits of a card, and the beginnings with the
digits of a phone.  Loose digit runs are proposed with all their stretches of 7 to 19
digits, tokens with the parts between equals signs.  What touches a selected base span
is not proposed, as it cannot be selected.  All candidates of the added kinds are judged
by boosted trees over format features (lengths, shares of digits and letters, groups,
checksums, variety) and context features (neighbouring characters and words); each kind
has a threshold on the calibrated probability.

What is personal is learned from planted spans (``planting.py``), whose truth is known and is
no function of the features: values of each added kind, well formed or with a wrong digit,
are set into the corpus's own texts after words that tell of personal data, or of orders,
versions and the like, or after none.  Of the candidates that touch a plant, the plant
itself is right if it was planted as personal, every other one (its parts, other kinds
of the same characters) is wrong.  So a span that fails the strict check of its format
can be taken for its context, and one that passes it can be left.  Trees are fitted on a
fixed number of plants in snippets of a bounded sample of documents; the calibration
(Platt) and each kind's threshold come from plants in all documents and, so that few documents
are judged as many, from a fixed number in invented words.  A threshold is the
lowest step with the wanted precision among the plants and a calibrated probability of a
half, or of that probability alone where no step has the precision.  All added kinds go by
the trees at every size.  The precision is that among plants; texts have no other labels.

Scale: documents are read in three map-only passes, over the sample for the snippets, over
all for the counts and over all for the spans.  Only the counts are shuffled, a bounded
number of rows a task and on the driver (kinds x steps x 2).  ``sample_documents`` bounds
the sample (in expectation: ids are taken by hash) and so the snippets of at most 120
characters on the driver.

Offsets are code points, end exclusive.  Null texts have no spans.  Repeated rows give
repeated rows.  Extra columns are not read (``redacted`` keeps them).  An empty table gives
an empty one; texts of any length are read whole.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm.boosting import BoostedTrees
from aerolake.llm.planting import plant, prose, snippet
from aerolake.llm.session import use_package_on_workers
from aerolake.llm.words import pieces

#: the base kinds, then those the method adds, in the order in which ties are told
KINDS = ("email", "ip", "card", "phone", "ssn", "number", "secret", "mailtext", "card_like", "phone_like")
BASE = 4
CARD_LIKE, PHONE_LIKE = 8, 9
#: candidates that are scored at a time
BLOCK = 4096
#: raw scores are counted in this many steps a unit, to +-LIMIT
STEPS, LIMIT = 32, 16
#: plants that the trees are fitted on; plants a document, and in invented words, that calibrate them
FITTED_PLANTS, PLANTS, INVENTED_PLANTS = 6000, 3, 3000

# The base patterns and the added generators.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
NUMBER = re.compile(r"[0-9](?:[ ().-]{0,2}[0-9])+")
SECRET = re.compile(r"[A-Za-z0-9_+/=-]{16,}")
MAILTEXT = re.compile(r"(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63} ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z]{2,}")
KNOWN_TOKEN = re.compile(r"AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{20,}|xox[abps]-|sk[-_][0-9A-Za-z]{16,}")
NAMED_TOKEN = re.compile(r"(?:token|secret|passw(?:or)?d|api_?key|key)\W{1,5}\Z", re.I)
CONTEXT = (
    re.compile(r"mail|contact|write|@", re.I),
    re.compile(r"call|phone|tel|mobil|fax|ring", re.I),
    re.compile(r"card|visa|master|iban|account|konto|compte|cuenta|pay", re.I),
    re.compile(r"token|secret|passw|key|auth|ssn|social", re.I),
    re.compile(r"host|server|addr|ip\b|login|user", re.I),
)
#: words before a span, by what they tell of: mail, phone, payment, secret, person's number, and what is not personal
CUE = re.compile(
    r"(?<![^\W\d_])(?:(mail|e-mail|contact|write|schreib|[ée]cri|escrib)|(call|phone|tel|mobil|handy|fax|ring\b|llam|appel)"
    r"|(card|visa|master|iban|account|konto|karte|compte|carte|cuenta|tarjeta|pay)|(token|secret|passw|api.?key|key\b|auth|bearer|mot de passe|clave)"
    r"|(ssn|social|tax)|(order|invoice|item|ref\b|version|build|commit|sha|track|serial|isbn|total|part|file|batch|bestell|rechnung"
    r"|artikel|commande|facture|pedido|factura))",
    re.I,
)
CUES, NO_CUE = 6, 41.0
GROUP_BEFORE = re.compile(r"([0-9]+)[ ().-]{1,2}\Z")
GROUP_AFTER = re.compile(r"[ ().-]{1,2}([0-9]+)")
LAST_LETTERS = re.compile(r"[A-Za-z]*\Z")
DIGIT = re.compile(r"[0-9]")
GROUP = re.compile(r"[0-9]+")
TOKEN_PART = re.compile(r"[^=]{16,}")


@dataclass(slots=True)
class Candidate:
    kind: int
    start: int
    end: int
    passed: bool


def luhn(digits: str) -> bool:
    """The card checksum."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Address spans, found from each @ outward; never two for the same characters."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            out.append((start, done))
        at = text.find("@", max(at + 1, done))
    return out


def stretches(groups: list[tuple[int, int]], least: int, most: int) -> Iterator[tuple[int, int]]:
    """First and last index of neighbouring digit groups with ``least`` to ``most`` digits together; at most ``most`` a group."""
    for i in range(len(groups)):
        digits = 0
        for j in range(i, len(groups)):
            digits += groups[j][1] - groups[j][0]
            if digits > most:
                break
            if digits >= least:
                yield i, j


def card_parts(text: str, start: int, end: int) -> Iterator[Candidate]:
    """The parts of a failed card run; the checksum counts for groups as cards have them, of 4 digits or more but the last."""
    groups = [m.span() for m in GROUP.finditer(text, start, end)]
    for i, j in stretches(groups, 14, 19):
        if j - i + 1 < len(groups):
            shaped = all(b - a >= 4 for a, b in groups[i:j])
            yield Candidate(CARD_LIKE, groups[i][0], groups[j][1], shaped and luhn("".join(text[a:b] for a, b in groups[i : j + 1])))


def phone_parts(text: str, start: int, end: int) -> Iterator[Candidate]:
    """The beginnings of a failed phone run that have the digits of a phone."""
    digits = 0
    for m in GROUP.finditer(text, start, end):
        digits += m.end() - m.start()
        if digits > 15:
            break
        if digits >= 10 and m.end() < end:
            yield Candidate(PHONE_LIKE, start, m.end(), True)


def candidates(text: str) -> list[Candidate]:
    """All proposed spans; ``passed`` tells whether the strict check of the kind holds."""
    out = []
    if "@" in text:
        out += [Candidate(0, a, b, True) for a, b in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            out.append(Candidate(1, *m.span(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:4] or 0) <= 255 for p in m[0].split("."))))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(Candidate(2, *m.span(), True))
            elif len(digits) >= 7:
                out.append(Candidate(CARD_LIKE, *m.span(), False))
                out += card_parts(text, *m.span())
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(Candidate(3, *m.span(), True))
            else:
                out.append(Candidate(PHONE_LIKE, *m.span(), False))
                out += phone_parts(text, *m.span())
        for m in SSN.finditer(text):
            out.append(Candidate(4, *m.span(), m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000"))
        for m in NUMBER.finditer(text):
            groups = [g.span() for g in GROUP.finditer(text, *m.span())]
            for i, j in stretches(groups, 7, 19):
                a = groups[i][0]
                near = text[max(0, a - 30) : a]
                out.append(Candidate(5, a, groups[j][1], bool(CONTEXT[1].search(near) or CONTEXT[2].search(near))))
        for m in SECRET.finditer(text):
            parts = [p.span() for p in TOKEN_PART.finditer(text, *m.span())]
            for a, b in dict.fromkeys([m.span(), *parts]):
                token = text[a:b]
                if DIGIT.search(token) and re.search("[A-Za-z]", token):
                    out.append(Candidate(6, a, b, bool(KNOWN_TOKEN.match(token) or NAMED_TOKEN.search(text[max(0, a - 20) : a]))))
    if "at" in text:
        for m in MAILTEXT.finditer(text):
            start = m.start()
            while start > 0 and text[start - 1] in LOCAL:
                start -= 1
            if start < m.start():
                out.append(Candidate(7, start, m.end(), "(at)" in m[0] or "[at]" in m[0]))
    taken = _Taken([(c.start, c.end) for c in out if c.kind < BASE and c.passed])
    return [c for c in out if c.kind < BASE or taken.free(c.start, c.end)]


def features(text: str, c: Candidate) -> list[float]:
    """Format of a candidate, and what stands beside it."""
    span = text[c.start : c.end]
    before, after = text[max(0, c.start - 40) : c.start], text[c.end : c.end + 20]
    digits = sum(x.isdigit() for x in span)
    letters = sum(x.isalpha() for x in span)
    runs = GROUP.findall(span)
    near = [NO_CUE] * CUES
    for m in CUE.finditer(before):
        near[m.lastindex - 1] = float(len(before) - m.start())
    left, right = GROUP_BEFORE.search(before), GROUP_AFTER.match(after)
    return [
        *[float(c.kind == k) for k in range(BASE, len(KINDS))],
        float(c.end - c.start),
        digits / len(span),
        letters / len(span),
        sum(x.isupper() for x in span) / len(span),
        float(len(span) - digits - letters),
        float(len(runs)),
        float(max(map(len, runs), default=0)),
        float(len(runs[0]) if runs else 0),
        float(digits),
        len(set(span)) / len(span),
        float(len(LAST_LETTERS.search(span)[0])),
        float("(" in span or "[" in span),
        float(c.passed),
        float(14 <= digits <= 19 and luhn("".join(runs))),
        float(bool(KNOWN_TOKEN.match(span))),
        float(bool(before) and before[-1].isalnum()),
        float(bool(after) and after[0].isalnum()),
        float(len(left[1]) if left else 0),
        float(len(right[1]) if right else 0),
        float(before[-1:] in ("'", '"', "`")),
        float(before.rstrip(" '\"")[-1:] in ("=", ":")),
        *near,
        near[-1] - min(near[:-1]),
    ]


def scored(trees: BoostedTrees, text: str, found: list[Candidate]) -> Iterator[tuple[list[Candidate], np.ndarray]]:
    """The candidates in blocks, with their raw scores."""
    for i in range(0, len(found), BLOCK):
        block = found[i : i + BLOCK]
        yield block, trees.raw(np.array([features(text, c) for c in block]))


def examples(rng: random.Random, before: str, after: str) -> Iterator[tuple[int, bool, list[float]]]:
    """Kind, truth and features of the candidates that touch a plant between two pieces of text."""
    kind = rng.randrange(BASE, len(KINDS))
    text, personal, spans = plant(rng, KINDS[kind], before, after)
    first, last = min(a for a, _ in spans), max(b for _, b in spans)
    for c in candidates(text):
        if c.kind >= BASE and c.start < last and first < c.end:
            yield c.kind, personal and c.kind == kind and (c.start, c.end) in spans, features(text, c)


def steps(raw: np.ndarray) -> np.ndarray:
    """The step of each raw score."""
    return np.floor(np.clip(raw, -LIMIT, LIMIT) * STEPS).astype(np.int64)


@dataclass
class Judge:
    """Fitted and calibrated trees, and each kind's least step of the raw score."""

    trees: BoostedTrees
    thresholds: np.ndarray

    def spans(self, text: str | None) -> list[tuple[int, int, int, bool, float]]:
        """Selected (start, kind, end, base, score), ordered; an added span does not overlap a better one."""
        found = candidates(text) if text else []
        chosen = [(c.start, c.kind, c.end, True, 1.0) for c in found if c.kind < BASE and c.passed]
        rest = [c for c in found if c.kind >= BASE]
        if rest:
            ranked = []
            for block, raw in scored(self.trees, text, rest):
                good = steps(raw) >= self.thresholds[[c.kind for c in block]]
                ranked += [(float(p), c) for p, c, g in zip(self.trees.calibrated(raw), block, good) if g]
            # of equal scores the first, the longest and the most special
            ranked.sort(key=lambda x: (-x[0], x[1].start, -x[1].end, -x[1].kind))
            # ranked spans go in unless a chosen one overlaps; kept apart by start
            taken = _Taken([(a, b) for a, _, b, _, _ in chosen])
            for s, c in ranked:
                if taken.add(c.start, c.end):
                    chosen.append((c.start, c.kind, c.end, False, s))
        return sorted(chosen)


class _Taken:
    """Disjoint intervals with logarithmic tests for overlap."""

    def __init__(self, spans: list[tuple[int, int]]):
        import bisect

        self.bisect = bisect
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def free(self, a: int, b: int) -> bool:
        i = self.bisect.bisect_left(self.starts, b)
        return not i or self.ends[i - 1] <= a

    def add(self, a: int, b: int) -> bool:
        if not self.free(a, b):
            return False
        i = self.bisect.bisect_left(self.starts, b)
        self.starts.insert(i, a)
        self.ends.insert(i, b)
        return True


def snippets(documents: DataFrame, *, id_col: str, text_col: str, sample_documents: int) -> list[tuple[str, str]]:
    """Pieces of text around one place of each of about ``sample_documents`` documents, in order."""
    n = documents.count()
    chance = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 20))
    rows = documents.where(chance < int(min(1.0, sample_documents / max(n, 1)) * (1 << 20))).select(F.col(text_col).alias("text")).where("text is not null")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = [snippet(random.Random(seed_of(t)), t) for t in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array([c[i] for c in cuts], pa.string()) for i in (0, 1)], ["before", "after"])

    return sorted((r.before, r.after) for r in rows.mapInArrow(cut, "before string, after string").collect())


def seed_of(text: str) -> int:
    """The seed of a document's plants, the same wherever and whenever it is read."""
    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


def fitted_trees(around: list[tuple[str, str]]) -> BoostedTrees:
    """Trees of a fixed number of plants, every other one in a snippet, the rest in invented words."""
    rng, found = random.Random(0), []
    for i in range(FITTED_PLANTS):
        before, after = rng.choice(around) if around and i % 2 else (prose(rng, 6), prose(rng, 4))
        found += examples(rng, before, after)
    return BoostedTrees(rounds=60, depth=4).fit(np.array([x for _, _, x in found]), np.array([float(y) for _, y, _ in found]))


def counted_steps(trees: BoostedTrees, found: list[tuple[int, bool, list[float]]]) -> Counter:
    """How many examples have each kind, step of the raw score and truth."""
    counts = Counter()
    for i in range(0, len(found), BLOCK):
        block = found[i : i + BLOCK]
        counts.update(zip((k for k, _, _ in block), steps(trees.raw(np.array([x for _, _, x in block]))).tolist(), (y for _, y, _ in block)))
    return counts


def score_counts(documents: DataFrame, trees: BoostedTrees, *, text_col: str) -> DataFrame:
    """Kind, step of the raw score, truth and n of the candidates at the plants of all documents."""
    shared = documents.sparkSession.sparkContext.broadcast(trees)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, counts, found = shared.value, Counter(), []
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                rng = random.Random(seed_of(text))
                for _ in range(PLANTS):
                    found += examples(rng, *snippet(rng, text))
                if len(found) >= BLOCK:
                    counts.update(counted_steps(mine, found))
                    found = []
        counts.update(counted_steps(mine, found))
        kinds, at, true = zip(*counts) if counts else ((), (), ())
        columns = [pa.array(kinds, pa.int32()), pa.array(at, pa.int64()), pa.array(true, pa.bool_()), pa.array(counts.values(), pa.int64())]
        yield pa.record_batch(columns, ["kind", "step", "true", "n"])

    rows = documents.select(F.col(text_col).alias("text")).where("text is not null").mapInArrow(counted, "kind int, step long, true boolean, n long")
    return rows.groupBy("kind", "step", "true").agg(F.sum("n").alias("n"))


def fitted_judge(documents: DataFrame, *, id_col: str, text_col: str, sample_documents: int = 20_000, precision: float = 0.95) -> Judge:
    """Trees of plants in a sample of about ``sample_documents`` documents; calibration and thresholds of plants in all."""
    use_package_on_workers(documents.sparkSession)
    trees = fitted_trees(snippets(documents, id_col=id_col, text_col=text_col, sample_documents=sample_documents))
    rng = random.Random(1)
    counts = counted_steps(trees, [e for _ in range(INVENTED_PLANTS) for e in examples(rng, prose(rng, 6), prose(rng, 4))])
    for r in score_counts(documents, trees, text_col=text_col).collect():
        counts[r.kind, r.step, r.true] += r.n
    found = sorted((k, -step, true, n) for (k, step, true), n in counts.items())
    step, true, n = (np.array([f[i] for f in found], dtype=float) for i in (1, 2, 3))
    trees.calibrate((0.5 - step) / STEPS, true, n)
    even = steps(np.array([-trees.shift / trees.slope]))[0] if trees.slope > 0 else 0
    judge = Judge(trees, np.full(len(KINDS), even, dtype=np.int64))
    for k in range(BASE, len(KINDS)):
        right = every = 0
        mine = [(-step, true, n) for kind, step, true, n in found if kind == k and -step >= even]
        for i, (step, true, n) in enumerate(mine):
            every, right = every + n, right + n * true
            last = i + 1 == len(mine) or mine[i + 1][0] < step  # a step is taken whole
            if last and right >= precision * every:
                judge.thresholds[k] = step
    return judge


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean,score:double>>"


def personal_data(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **fit: float) -> DataFrame:
    """``id_col`` and spans (kind, start, end, base, score) in order of every row."""
    spark = documents.sparkSession
    judge = spark.sparkContext.broadcast(fitted_judge(documents, id_col=id_col, text_col=text_col, **fit))
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = judge.value
        for batch in batches:
            spans = [[{"kind": KINDS[k], "start": a, "end": b, "base": base, "score": s} for a, k, b, base, s in mine.spans(t.as_py())] for t in batch.column(1)]
            shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())]))
            yield pa.record_batch([batch.column(0), pa.array(spans, shape)], ["id", "spans"])

    return rows.mapInArrow(find, f"id {kind}, spans {SPANS}").withColumnRenamed("id", id_col)


def told(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **fit: float) -> DataFrame:
    """The rows with each selected span of ``text_col`` replaced by its kind, as in ``<email>``; other columns stay.

    Overlapping spans are replaced as one, by the kind of the first.
    """
    spark = documents.sparkSession
    judge = spark.sparkContext.broadcast(fitted_judge(documents, id_col=id_col, text_col=text_col, **fit))
    place = documents.columns.index(text_col)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = judge.value
        for piece in pieces(batches, place):
            texts = []
            for text in piece.column(place).to_pylist():
                spans, parts, done = mine.spans(text), [], 0
                for a, k, b, _, _ in spans:
                    if a >= done:
                        parts += [text[done:a], f"<{KINDS[k]}>"]
                    done = max(done, b)
                texts.append("".join([*parts, text[done:]]) if spans else text)
            columns = list(piece.columns)
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=piece.schema.names)

    return documents.mapInArrow(replace, documents.schema)
