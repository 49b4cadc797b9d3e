from __future__ import annotations

import random

import pytest

from tidemark.llm import perplexity as px


def test_threshold_is_the_quantile_itself(spark):
    random.seed(4)
    words = "the cat sat on a mat while rain fell over old town roofs and nobody spoke".split()
    clean = [(i, " ".join(random.choice(words) for _ in range(30)), "en") for i in range(200)]
    docs = spark.createDataFrame(clean, "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(200)], "doc_id long")
    out = {r.doc_id: r for r in px.classify(docs, trusted).collect()}
    held = [r[0] for r in spark.range(200).where("pmod(xxhash64('held out', id), 5) = 0").collect()]
    values = sorted(out[i].perplexity for i in held)
    right = values[-(-99 * len(values) // 100) - 1]
    assert all(r.threshold == pytest.approx(right) and r.kept == (r.perplexity <= right) for r in out.values())
