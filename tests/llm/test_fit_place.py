import os

import numpy as np
import pytest

from tidelog.llm import toxicity


def _labelled(spark, documents):
    rows = [(i, f"plain words {'grumblork' if i % 2 else 'nice'} again. Number {i} came by.", "a") for i in range(1, 80)]
    return rows, documents(rows), spark.createDataFrame([(i, i % 2) for i in range(1, 80)], "doc_id long, toxic int")


def test_the_fit_runs_in_a_task(spark, documents, monkeypatch):
    """Not in the driver's process, which holds neither the sample nor what the fit makes of it."""
    _, docs, labels = _labelled(spark, documents)
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels, prior=None: (os.getpid(), len(texts)))
    pid, n = toxicity.fit_on(docs, labels)
    assert pid != os.getpid() and n == labels.where(~toxicity.held_out(labels["doc_id"])).count()


def test_a_fit_in_a_task_equals_one_in_place(spark, documents):
    rows, docs, labels = _labelled(spark, documents)
    fold = labels.where(~toxicity.held_out(labels["doc_id"])).selectExpr("doc_id", "toxic", "md5(cast(doc_id AS string)) AS place").collect()
    text = {i: t for i, t, _ in rows}
    fold.sort(key=lambda r: r["place"])
    here = toxicity.fit([text[r["doc_id"]] for r in fold], [r["toxic"] for r in fold], prior=np.mean([r["toxic"] for r in fold]))
    there = toxicity.fit_on(docs, labels)
    assert there.kernel.landmarks == here.kernel.landmarks and np.allclose(there.table, here.table)
    assert np.allclose(there.doc_weights, here.doc_weights) and np.allclose(there.over, here.over)


def test_unusable_labels_warn_on_the_driver(spark, documents):
    _, docs, labels = _labelled(spark, documents)
    with pytest.warns(UserWarning, match="every score is 0"):
        assert toxicity.fit_on(docs, labels.where("toxic = 1")) is None
