"""Examples at plants are scored in blocks, so a task's memory does not follow its batch of texts."""

import pyarrow as pa

from aerolake.llm import pii
from aerolake.llm.boosting import BoostedTrees


def test_examples_of_a_batch_are_scored_in_blocks(spark, monkeypatch):
    texts = [f"some words before and after number {i}" for i in range(400)]
    documents = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    trees = pii.fitted_trees([])
    whole = {(r.kind, r.step, r.true): r.n for r in pii.score_counts(documents, trees, text_col="text").collect()}
    # the function of the tasks, run here on one batch of all texts
    tasks = []
    kind = type(documents)
    real = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda df, f, schema: tasks.append(f) or real(df, f, schema))
    pii.score_counts(documents, trees, text_col="text")
    sizes = []
    raw = BoostedTrees.raw
    monkeypatch.setattr(BoostedTrees, "raw", lambda self, x: sizes.append(len(x)) or raw(self, x))
    monkeypatch.setattr(pii, "BLOCK", 64)
    (out,) = tasks[0](iter([pa.record_batch([pa.array(texts)], ["text"])]))
    assert {tuple(r[c] for c in ("kind", "step", "true")): r["n"] for r in out.to_pylist()} == whole
    assert sum(sizes) == sum(whole.values()) > 5 * 64 and max(sizes) <= 64
