import os

import pytest

from tidemark.session import drop_scratch, durable, scratch_path, scratch_scope, shared_root


def tables(spark):
    return set(os.listdir(shared_root(spark)))


def test_a_scope_leaves_what_was_named_before_it(spark):
    before = tables(spark)
    path = scratch_path(spark, "kept")
    with scratch_scope(spark):
        first = durable(spark.range(5))
        with scratch_scope(spark):
            inner = durable(first.where("id > 1"))
            assert inner.count() == 3
        assert first.count() == 5 and len(tables(spark) - before) == 1
        kept = durable(first.where("id > 2"), path)
    assert tables(spark) - before == {os.path.basename(path)}
    assert kept.count() == 2
    drop_scratch(spark, [path])
    assert tables(spark) == before


def test_a_scope_ends_after_an_error_and_a_table_may_go_earlier(spark):
    before = tables(spark)
    with pytest.raises(KeyError), scratch_scope(spark):
        path = scratch_path(spark, "early")
        durable(spark.range(3), path)
        drop_scratch(spark, [path])
        durable(spark.range(2))
        raise KeyError
    assert tables(spark) == before
    durable(spark.range(1))
    assert len(tables(spark) - before) == 1
