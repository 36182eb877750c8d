"""A training-corpus pipeline over ``documents``: five stages, each one operator.

1. language: documents without letters (und) go; of two or more learned languages one is always
   found for a text with letters, so unlearned languages and junk with letters stay.
2. near_duplicates: of each class of similar texts the document of the smallest id stays.
3. decontaminate: documents contaminated by the benchmark go.
4. pii: personal data in the texts is replaced by its kind; ``n_chars`` follows.
5. mix: the words that the mix takes of each document.

Each stage works on what the one before it kept, read back from Parquet.  All but the
last return the columns of documents.  Rows with a null id are never duplicates of
another; rows that share an id stay or go together.  Null and empty texts go in stage 1.
Extra columns of the documents are carried along to stage 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm.decontamination import contamination
from aerolake.llm.language_id import UNDETERMINED, identify_languages
from aerolake.llm.mixing import pivotal_mix
from aerolake.llm.ngram_join import similarity_classes
from aerolake.llm.pii import redacted
from aerolake.llm.session import stored


def _numbered(docs: DataFrame) -> tuple[dict[str, str], DataFrame]:
    """Second names of the columns that no column has, and the rows with these columns too."""
    prefix = "_carried"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    second = {c: f"{prefix}{i}" for i, c in enumerate(docs.columns)}
    return second, docs.select("*", *[F.col(f"`{c}`").alias(s) for c, s in second.items()])


def _original(rows: DataFrame, second: dict[str, str]) -> DataFrame:
    return rows.select(*[F.col(s).alias(c) for c, s in second.items()])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: all but null and letterless texts, and, with one learned language, those unlike it."""
    second, rows = _numbered(docs)
    found = identify_languages(rows, text_col=second.get("text", "text"), carry=list(second.values()))
    return _original(found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") > 0)), second)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts at a similarity of 0.8 or more."""
    classes = similarity_classes(docs)
    others = classes.where("doc_id <> class_id").select("doc_id")
    return docs.join(others, "doc_id", "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not contaminated by the benchmark."""
    second, rows = _numbered(docs)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination(rows, benchmark, text_col=second.get("text", "text"), carry=list(second.values()))
    return _original(found.where(~F.col("contaminated")), second)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced."""
    clean = redacted(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return pivotal_mix(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pii", pii),
    ("mix", mix),
]

#: the trained stages and the random rounding are not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
