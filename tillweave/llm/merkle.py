"""Merkle manifest of a dataset: nested intervals of leaf ranks, proofs, and their check.

The rows of a group (a source) are leaves, ranked by their id.  A node carries
the interval of leaf ranks that it covers: a leaf covers one rank, and a parent
covers the intervals of up to ``arity`` consecutive nodes.  The roots of all
groups, ordered by group, are the leaves of one more tree, whose root stands for
the dataset.

Levels are built from below, one grouping each, with a ``1 / arity`` of the rows
of the level before.  Ancestors are attached from above: the nodes of a level
meet the parents of their level's bucket whose interval contains theirs, and
what is left of the parent's interval without the node's own is covered by its
siblings.  A node hands the siblings of all its ancestors down, so a leaf learns
its whole proof from its parent, and no leaf is joined once per level.

All rows travel under (group, place of the parent in its level), a few rows per
key, so a group that holds most of the rows is spread like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillweave.llm.tables import stored
from tillweave.operators.positions import number_rows

ARITY = 3

_PATH = "array<struct<before:string,after:string>>"


def digest(value: Column) -> Column:
    """Lowercase hex SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(value.cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    counted = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(counted, F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    """The digest of a row: that of its fields, one after another."""
    return digest(F.concat(*[field(c) for c in columns]))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to with the siblings of its proof."""
    return F.aggregate(path, leaf, lambda held, s: digest(F.concat(s["before"], held, s["after"])))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings of a proof, level by level and left to right."""
    return digest(F.concat_ws("", F.transform(path, lambda s: F.concat(s["before"], s["after"]))))


@dataclass(frozen=True)
class Tree:
    """``levels[k]`` holds the nodes of height k: (grp, lo, hi, digest, height, children).

    ``lo`` and ``hi`` bound the leaf ranks that a node covers, ``height`` is its
    group's.  ``children`` (lo, hi, digest) is missing on level 0, which has the
    leaves' own ``extra`` instead; level 1 has it within its children.
    """

    levels: list[DataFrame]
    arity: int

    def _run(self, lo: Column, level: int) -> Column:
        """The first rank of a node's parent: its bucket on the level above."""
        return lo - lo % F.lit(self.arity ** (level + 1))

    def nodes(self) -> DataFrame:
        """Every node of every level: (grp, level, lo, hi, digest)."""
        tables = [
            df.select("grp", F.lit(k).alias("level"), "lo", "hi", "digest")
            for k, df in enumerate(self.levels)
        ]
        result = tables[0]
        for other in tables[1:]:
            result = result.unionByName(other)
        return result

    def roots(self) -> DataFrame:
        """(grp, height, digest) of each group's root."""
        tops = [
            df.where(F.col("height") == k).select("grp", "height", "digest")
            for k, df in enumerate(self.levels)
        ]
        result = tops[0]
        for other in tops[1:]:
            result = result.unionByName(other)
        return result

    def paths(self, above: DataFrame) -> DataFrame:
        """(grp, lo, digest, extra, path, top) of each leaf.

        ``above`` holds (grp, height, path, top) of each group's root.
        A path lists, from the leaf upwards, the digests before and after the
        node within its run; ``top`` is the digest of the group's root.
        """
        held = self._rooted(len(self.levels) - 1, above)
        for level in range(len(self.levels) - 2, -1, -1):
            parents = self.levels[level + 1].select(
                F.col("grp").alias("_grp"), F.col("lo").alias("_lo"), "children"
            )
            # A level's parents are told apart by the first rank of their interval.
            met = held.join(
                parents, held["grp"].eqNullSafe(parents["_grp"]) & (held["lo"] == parents["_lo"])
            )
            one = met.select("grp", "path", "top", "children", F.explode("children").alias("node"))
            # What the parent's interval has before and after the node's own.
            before = F.filter("children", lambda c: c["hi"] <= F.col("node.lo"))
            after = F.filter("children", lambda c: c["lo"] >= F.col("node.hi"))
            sides = F.struct(_joined(before).alias("before"), _joined(after).alias("after"))
            below = one.select(
                "grp",
                F.col("node.lo").alias("lo"),
                *_own(level, "node."),
                F.concat(F.array(sides), "path").alias("path"),
                "top",
            )
            held = below.unionByName(self._rooted(level, above))
        return held

    def _rooted(self, level: int, above: DataFrame) -> DataFrame:
        """The roots among the nodes of a level; a root's interval begins at 0."""
        tops = above.where(F.col("height") == level).select(
            "grp", F.lit(0).cast("bigint").alias("lo"), "path", "top"
        )
        if level:
            return tops
        lone = self.levels[0].where(F.col("height") == 0)
        lone = lone.select(F.col("grp").alias("_grp"), *_own(0))
        return tops.join(lone, tops["grp"].eqNullSafe(lone["_grp"])).drop("_grp")


def _own(level: int, of: str = "") -> list[Column]:
    """What only leaves take along."""
    return [F.col(f"{of}digest").alias("digest"), F.col(f"{of}extra").alias("extra")] if level == 0 else []


def _joined(children: Column) -> Column:
    return F.concat_ws("", F.transform(children, lambda c: c["digest"]))


def tree(leaves: DataFrame, arity: int = ARITY) -> Tree:
    """The tree of each group of ``leaves``: (grp, rank, digest, extra), ranks from 0 without gaps.

    ``arity`` consecutive nodes become one while a group has several; the last
    run of a level may be shorter, even one node.  A lone leaf is its root.  The
    number of levels is the logarithm of the largest group.
    """
    if arity < 2:
        raise ValueError("a parent takes two nodes at least")
    sizes = leaves.groupBy("grp").agg(F.count("*").alias("n"))
    height, most = F.lit(0), sizes.agg(F.max("n")).first()[0] or 0
    top = 0
    while arity**top < most:
        height = height + (F.col("n") > arity**top).cast("int")
        top += 1
    heights = stored(
        sizes.select(F.col("grp").alias("_grp"), height.cast("int").alias("height")),
        "merkle-heights",
    )
    level = leaves.join(heights, leaves["grp"].eqNullSafe(heights["_grp"])).select(
        "grp",
        F.col("rank").alias("lo"),
        (F.col("rank") + 1).alias("hi"),
        "digest",
        "height",
        "extra",
    )
    result = Tree([level], arity)
    for k in range(top):
        node = F.struct("lo", "hi", "digest", *(["extra"] if k == 0 else []))
        runs = (
            result.levels[k]
            .where(F.col("height") > k)
            .groupBy("grp", result._run(F.col("lo"), k).alias("_run"))
            # At most ``arity`` nodes a run.
            .agg(
                F.sort_array(F.collect_list(node)).alias("children"),
                F.first("height").alias("height"),
            )
        )
        result.levels.append(
            stored(
                runs.select(
                    "grp",
                    F.col("children")[0]["lo"].alias("lo"),
                    F.element_at("children", -1)["hi"].alias("hi"),
                    digest(_joined(F.col("children"))).alias("digest"),
                    "height",
                    "children",
                ),
                f"merkle-level-{k + 1}",
            )
        )
    return result


@dataclass(frozen=True)
class Manifest:
    """The trees of the groups and the tree over their roots."""

    groups: Tree
    whole: Tree

    def root(self) -> str | None:
        """The root of the dataset; null if it has no row."""
        top = self.whole.roots().first()
        return top.digest if top else None

    def proofs(self) -> DataFrame:
        """Per leaf: grp, rank, digest, what was carried, path to the dataset's root, subroot."""
        top = self.whole.roots().select(
            "grp", "height", F.array().cast(_PATH).alias("path"), F.col("digest").alias("top")
        )
        # The leaves of the upper tree are the roots of the groups.
        above = self.whole.paths(top).select(
            F.col("extra.name").alias("grp"),
            F.col("extra.height").alias("height"),
            "path",
            F.col("digest").alias("top"),
        )
        above = stored(above, "merkle-above")
        return self.groups.paths(above).select(
            "grp", F.col("lo").alias("rank"), "digest", "extra.*", "path", F.col("top").alias("subroot")
        )


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "source",
    order: str = "doc_id",
    carry: Mapping[str, Column] | None = None,
    arity: int = ARITY,
) -> Manifest:
    """Digest every row of ``docs`` and build the trees over them.

    Leaves carry ``order`` as ``id`` and the columns of ``carry``.  They ascend
    by id, null first; rows of one id ascend by digest, so equal rows change
    nothing by their order.  A null group is a group of its own, the first.  A
    null field counts as ``-``, an empty text as ``0:``; long texts are digested
    whole.  An empty table has no node and no root.  Other columns of ``docs``
    are not looked at.
    """
    carried = dict(carry or {})
    rows = docs.select(
        F.col(group).cast("string").alias("grp"),
        F.col(order).alias("id"),
        leaf_digest([F.col(c) for c in fields]).alias("digest"),
        *[c.alias(name) for name, c in carried.items()],
    )
    numbered = number_rows(rows, ["id", "digest", *carried], "rank", ["grp"])
    extra = F.struct("id", *carried)
    groups = tree(numbered.select("grp", "rank", "digest", extra.alias("extra")), arity)
    # One row per group from here on; in UTF-8 byte order, null first.
    tops = number_rows(groups.roots(), ["grp"], "rank")
    of = F.struct(F.col("grp").alias("name"), "height")
    whole = tree(tops.select(F.lit("").alias("grp"), "rank", "digest", of.alias("extra")), arity)
    return Manifest(groups, whole)


def checked(made: Manifest, received: str) -> DataFrame:
    """Every leaf with its proof and whether the digest in column ``received`` leads to the root.

    The columns of ``Manifest.proofs``, root, folded_root and verified.
    """
    return (
        made.proofs()
        .withColumn("root", F.lit(made.root()).cast("string"))
        .withColumn("folded_root", fold(F.col(received), F.col("path")))
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )
