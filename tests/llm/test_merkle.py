from __future__ import annotations

from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(*values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree_of(leaves):
    """Root and, for each leaf, the levels' siblings, by plain lists."""
    proofs, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for i, a in enumerate(at):
            run = level[a // 8 * 8 : a // 8 * 8 + 8]
            proofs[i] += ["".join(run[: a % 8]), "".join(run[a % 8 + 1 :])]
        level, at = [h(*level[i : i + 8]) for i in range(0, len(level), 8)], [a // 8 for a in at]
    return (level[0] if level else None), proofs


def folded(leaf, proof):
    for left, right in zip(proof[::2], proof[1::2]):
        leaf = h(left, leaf, right)
    return leaf


def expected(rows):
    groups = defaultdict(list)
    for i, t, lang in rows:
        groups[lang].append((i is not None, i or 0, leaf_of(i, t), i, t))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for held in groups.values():
        held.sort(key=lambda x: x[:3])
    trees = [tree_of([x[2] for x in groups[n]]) for n in names]
    root, tops = tree_of([t[0] for t in trees])
    out = []
    for name, (subroot, proofs), top in zip(names, trees, tops, strict=True):
        for (_, _, leaf, i, t), proof in zip(groups[name], proofs, strict=True):
            path = proof + top
            changed = leaf_of(i, None if t is None else t.lower()) if i is not None and i % 3 == 0 else None
            out.append((i, name, leaf, changed, subroot, root, path, folded(changed or leaf, path)))
    return sorted(out, key=repr)


def found(frame, **more):
    done = merkle.manifest(
        frame, ["doc_id", "text"], changes={"text": F.lower("text")}, where=F.col("doc_id") % 3 == 0, **more
    )
    return sorted([(r.doc_id, r.tree, r.leaf, r.changed_leaf, r.subroot, r.root, list(r.path), r.version_root) for r in done.collect()], key=repr)


@pytest.mark.parametrize("block_levels", [1, 2, 4])
def test_against_plain_lists(spark, block_levels, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 40)
    rows = [((1 << 60) + i, f"Text {i} é", lang) for lang, n in (("en", 70), ("de", 9), ("fr", 8), ("", 1), (None, 65)) for i in range(n)]
    rows += [(None, "No number", "en"), (None, "No number", "en"), (None, None, None), ((1 << 60) + 2, "again", "en"), ((1 << 60) + 2, "again", "en"), (7, "", "zz"), (9, None, "zz")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"at": F.lit(1), "digest": F.lit("x")})
    assert found(frame, block_levels=block_levels) == expected(rows)


def test_one_row_and_none(spark):
    schema = "doc_id long, text string, lang string"
    assert found(spark.createDataFrame([], schema)) == []
    ((_, _, leaf, changed, subroot, root, path, version),) = found(spark.createDataFrame([(3, "A", "en")], schema))
    assert leaf == subroot == root and path == [] and version == changed == leaf_of(3, "a")


def test_versions_share_what_they_do_not_change():
    leaves = [h(str(i)) for i in range(64)]
    tree = merkle.Versions(leaves, 2, 8)
    before = len(tree.children)
    other = tree.replaced(tree.first, 20, h("new"))
    assert len(tree.children) == before + 3  # a leaf and its two ancestors
    old, new = tree.children[tree.first], tree.children[other]
    assert [a == b for a, b in zip(old, new)] == [True, True, False, True, True, True, True, True]
    third = tree.replaced(other, 63, h("more"))
    expect = list(leaves)
    expect[20], expect[63] = h("new"), h("more")
    assert tree.digests[third] == tree_of(expect)[0] and tree.digests[tree.first] == tree_of(leaves)[0]
