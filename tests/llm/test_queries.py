"""Registered queries against their SQL, and the pipeline's stages."""

import random
import re

import pytest

import corpus_pipeline
from aerolake.llm.oracle import oracle_queries
from aerolake.llm.pii import personal_data
from aerolake.llm.register import queries
from conftest import SF_SMALL
from oracle_compare import compare, duck


@pytest.mark.parametrize("name", sorted(oracle_queries()))
def test_query_matches_sql(spark, name):
    ok, told = compare(queries()[name](spark, SF_SMALL), duck(SF_SMALL), oracle_queries()[name])
    assert ok, told


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_SMALL).cache()
        assert kept.columns == columns, name
        assert 0 < kept.count() <= docs.count(), name
        docs = kept
    mixed = corpus_pipeline.mix(spark, docs, SF_SMALL)
    assert mixed.count() == docs.count()


def test_pipeline_takes_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_SMALL).count() == 0


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def kept_by_hand(docs, item):
    """Ids and texts after each of the first four stages, in plain Python."""
    left = {i: t for i, t in docs.items() if any(c.isalpha() for c in t or "")}
    yield dict(left)
    sets = {i: {tuple(words(t)[k : k + 5]) for k in range(len(words(t)) - 4)} for i, t in left.items()}
    group = {i: i for i in left}
    for i in sorted(left):
        for j in sorted(left):
            if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((group[i], group[j]))
                group = {k: a if g == b else g for k, g in group.items()}
    left = {i: t for i, t in left.items() if group[i] == i}
    yield dict(left)
    phrases = {tuple(item[k : k + 13]) for k in range(len(item) - 12)}

    def hits(w):
        return len({p for k in range(len(w) - 12) if tuple(w[k : k + 13]) in phrases for p in range(k, k + 13)})

    left = {i: t for i, t in left.items() if not 0 < hits(words(t)) or 20 * hits(words(t)) < len(words(t))}
    yield dict(left)
    for pattern, kind in ((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "email"), (r"\b[0-9]+(?:\.[0-9]+){3}", "ip")):
        left = {i: re.sub(pattern, f"<{kind}>", t) for i, t in left.items()}
    yield left


def test_pipeline_stages_match_plain_python(spark, tmp_path):
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(3000)]
    texts = [" ".join(rng.choices(vocabulary, k=80)) for _ in range(30)]
    item = rng.choices(vocabulary, k=20)
    near = words(texts[3])
    near[79] = "changed"
    texts += [None, "", " \n", "12 34 !", texts[2], " ".join(near), f"{texts[4][:200]} {' '.join(item)} {texts[5][:100]}"]
    texts += [" ".join(rng.choices(vocabulary, k=600) + item[:13]), f"{texts[6][:150]} me.you@site.org and 10.2.3.4 {texts[7][:150]}"]
    docs = dict(enumerate(texts))
    rows = [(i, t, ["en", "de"][i % 2], f"s{i % 3}", len(t or "")) for i, t in docs.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    table, sizes = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for (name, stage), want in zip(corpus_pipeline.STAGES, kept_by_hand(docs, item)):
        table = stage(spark, table, str(tmp_path)).cache()
        got = table.collect()
        assert {r.doc_id: r.text for r in got} == want and len(got) == len(want), name
        assert name != "pii" or all(r.n_chars == len(r.text) for r in got)
        sizes.append(len(want))
    assert sizes == [35, 33, 32, 32] and "<email> and <ip>" in want[38]
    mixed = {r.doc_id: r["size"] for r in corpus_pipeline.mix(spark, table, str(tmp_path)).collect()}
    assert mixed == {i: len(words(t)) for i, t in want.items()}


def test_base_spans_match_plain_regexes(spark):
    def luhn(digits):
        return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0

    def base(text):
        digits = [(m, re.sub(r"\D", "", m[0])) for m in re.finditer(r"[0-9](?:[ -]?[0-9])+", text)]
        out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", text)]
        out += [(m.start(), m.end(), "ip") for m in re.finditer(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}", text) if all(int(p) <= 255 for p in m[0].split("."))]
        out += [(m.start(), m.end(), "card") for m, d in digits if 14 <= len(d) <= 19 and luhn(d)]
        return sorted(out + [(m.start(), m.end(), "phone") for m in re.finditer(r"\+[0-9][ ().0-9-]+[0-9]", text) if 10 <= len(re.sub(r"\D", "", m[0])) <= 15])

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = {r.doc_id: base(r.text or "") for r in docs.collect()}
    got = {r.doc_id: sorted((s.start, s.end, s.kind) for s in r.spans if s.base) for r in personal_data(docs).collect()}
    assert got == want and any(want.values())


def test_columns_named_like_the_carried_ones(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(20)
    for c in ("_carried0", "_Carried_1", "item_ids", "lang_pred"):
        docs = docs.withColumn(c, docs.doc_id)
    for stage in (corpus_pipeline.language, corpus_pipeline.decontaminate):
        kept = stage(spark, docs, SF_SMALL)
        assert kept.columns == docs.columns and all(r["_carried0"] == r.doc_id == r["lang_pred"] for r in kept.collect())


def test_a_text_travels_to_the_workers_once(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(20)
    for stage in (corpus_pipeline.language, corpus_pipeline.decontaminate):
        plan = stage(spark, docs, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        sent = re.search(r"Project \[(.*)\]", plan[plan.index("MapInArrow") :])[1]
        assert len(re.findall(r"\btext#\d+(?: AS|,)", sent)) == 1, sent
