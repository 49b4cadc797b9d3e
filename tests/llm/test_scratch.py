import os

import corpus_pipeline
from test_pipeline import folder  # noqa: F401
from tidemark.llm import near_dedup as nd
from tidemark.session import shared_root


def tables(spark):
    return set(os.listdir(shared_root(spark)))


def kinds(names):
    return sorted(n.rsplit("-", 1)[0] for n in names)


def test_classes_leave_only_what_they_read(spark, documents):
    words = " ".join(f"w{i}" for i in range(60))
    docs = documents([(i, f"{words} tail{i % 7}") for i in range(40)] + [(90, None), (91, "other words")])
    before = tables(spark)
    got = nd.near_classes(docs)
    assert kinds(tables(spark) - before) == ["classes", "stands"]
    assert {r["doc_id"]: r["class_id"] for r in got.collect()} == {**dict.fromkeys(range(40), 0), 90: 90, 91: 91}


def test_pipeline_leaves_its_last_input(spark, folder):  # noqa: F811
    before = tables(spark)
    rows = corpus_pipeline.run(spark, folder[0])
    left = kinds(tables(spark) - before)
    assert not {"quality_rules", "line_dedup", "near_dedup", "stands", "classes", "labels"} & set(left)
    assert "substring_dedup" in left and rows.count() > 0
