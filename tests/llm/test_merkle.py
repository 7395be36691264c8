"""The Merkle manifest against a plain recursion."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import odd_docs
from tillweave.llm import merkle


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _tree(digests, arity):
    """The root, and of each leaf the digests before and after it on every level."""
    paths = [[] for _ in digests]
    level, owners = digests, [[i] for i in range(len(digests))]
    while len(level) > 1:
        runs = [range(i, min(i + arity, len(level))) for i in range(0, len(level), arity)]
        for run in runs:
            for k in run:
                sides = ("".join(level[j] for j in run if j < k), "".join(level[j] for j in run if j > k))
                for leaf in owners[k]:
                    paths[leaf].append(sides)
        owners = [[x for k in run for x in owners[k]] for run in runs]
        level = [_h("".join(level[k] for k in run)) for run in runs]
    return level[0], paths


def _want(rows, fields, group, arity):
    groups = {}
    for row in rows:
        groups.setdefault(row[group], []).append((row["doc_id"], _h("".join(_field(row[f]) for f in fields))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made = {}
    for name in names:
        groups[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        made[name] = _tree([d for _, d in groups[name]], arity)
    root, upper = _tree([made[n][0] for n in names], arity)
    return root, [
        (name, rank, doc_id, digest, made[name][0], made[name][1][rank] + upper[at])
        for at, name in enumerate(names)
        for rank, (doc_id, digest) in enumerate(groups[name])
    ]


def _got(df):
    return [
        (r.grp, r["rank"], r.id, r.digest, r.subroot, [tuple(s) for s in r.path])
        for r in df.select("grp", "rank", "id", "digest", "subroot", "path").collect()
    ]


@pytest.mark.parametrize("arity", [2, 3])
def test_proofs_of_odd_rows(spark, arity):
    docs = odd_docs(spark).withColumn("digest", F.lit("x")).withColumn("height", F.lit(1))
    fields = ("doc_id", "source", "lang", "text")
    made = merkle.manifest(docs, fields, arity=arity)
    root, want = _want(docs.collect(), fields, "source", arity)
    assert made.root() == root
    assert sorted(map(repr, _got(made.proofs()))) == sorted(map(repr, want))


def test_a_hot_group_and_a_lone_leaf(spark):
    rows = [(i, "hot" if i else None, f"t{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    fields = ("doc_id", "source", "text")
    received = merkle.leaf_digest([F.col("doc_id"), F.col("source"), F.replace("text", F.lit("t7"), F.lit(""))])
    made = merkle.manifest(docs, fields, carry={"received": received})
    root, want = _want(docs.collect(), fields, "source", 3)
    checked = merkle.checked(made, "received")
    assert sorted(map(repr, _got(checked))) == sorted(map(repr, want))
    assert {r.id for r in checked.where("NOT verified").collect()} == {7}
    assert all(r.root == root for r in checked.collect())
    # Every node's interval is covered by its children's, none missing.
    nodes = made.groups.nodes().where("grp = 'hot'").collect()
    for level in range(1, max(n.level for n in nodes) + 1):
        mine = sorted((n.lo, n.hi) for n in nodes if n.level == level)
        assert mine[0][0] == 0 and mine[-1][1] == 39
        assert all(a[1] == b[0] for a, b in zip(mine, mine[1:]))


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(5, None, "")], "doc_id long, source string, text string")
    fields = ("doc_id", "source", "text")
    made = merkle.manifest(one, fields)
    assert made.root() == _h("1:5-0:")
    assert [r.path for r in made.proofs().collect()] == [[]]
    none = merkle.manifest(one.limit(0), fields)
    assert none.root() is None and none.proofs().collect() == []
    assert merkle.checked(none, "digest").collect() == []
