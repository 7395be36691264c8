"""Mixing sources to target weights with hash-threshold histograms.

Every document gets a 60-bit hash of its id and source.  A source that is to
give ``target`` words takes each document ``floor(target / size)`` times and
those below a hash threshold once more.  The threshold is found from sums of
words by source and leading hash bits: the bucket in which the running sum
passes the budget is refined by the next bits, and only the documents of that
one bucket are looked at again.  Nothing is sorted but the few buckets of a
source, and the mix itself is a filter on the hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillweave.llm.tables import stored

#: Bits of each level of the histogram; together the 60 bits of a hash.
LEVELS = (12, 24, 24)
HASH_BITS = sum(LEVELS)


def text_size(text: Column) -> Column:
    """Words of ``[^\\x20\\x09-\\x0D]``; null has none."""
    spaces = [" ", "\t", "\n", "\x0b", "\x0c", "\r"]
    pieces = F.size(F.split(text, r"[\x20\x09-\x0D]+"))
    # Splitting leaves an empty piece before leading and after trailing spaces.
    outer = F.substring(text, 1, 1).isin(spaces).cast("int") + F.substring(text, -1, 1).isin(
        spaces
    ).cast("int")
    return F.when(F.length(text) > 0, pieces - outer).otherwise(0).cast("bigint")


def document_hash(*columns: Column) -> Column:
    """The leading 60 bits of an MD5, which other engines can compute as well."""
    text = F.concat_ws(
        "|", *[F.coalesce(c.cast("string"), F.lit("\\N")) for c in columns]
    )
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[float], share: float, most: float
) -> DataFrame:
    """Target words per source: ``sizes`` holds (source, source_size), one row per source.

    Sources in code point order, null last, weigh ``weights``, repeating.
    ``share`` times all words is dealt by weight; no target exceeds ``most``
    times its source, and the excess is dealt again by weight.  The dealing has
    a closed form: with sources ordered by size over weight, those at their
    bound are a prefix, and the rest share what is left by weight.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.col("_rank") - 1) % len(weights) + 1).cast("int"),
    )
    weighed = sizes.withColumn("_rank", F.row_number().over(order)).withColumn("weight", weight)
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), "_rank")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    cap = F.col("source_size") * F.lit(float(most))
    dealt = (
        weighed.withColumn("_total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("_spent", F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
        .withColumn("_left", F.sum("weight").over(onward))
        # What a unit of weight gets if this source and all later ones are below their bound.
        .withColumn("_level", (F.col("_total") - F.col("_spent")) / F.col("_left"))
        .withColumn("_free", cap >= F.col("weight") * F.col("_level"))
    )
    level = F.min(F.when(F.col("_free"), F.struct("_rank2", "_level"))).over(everything)["_level"]
    return (
        dealt.withColumn("_rank2", F.row_number().over(by_room))
        .withColumn("_unit", level)
        .select(
            "source",
            "source_size",
            F.when(F.col("_unit").isNull(), cap)
            .otherwise(F.least(cap, F.col("weight") * F.col("_unit")))
            .alias("target"),
        )
    )


def _same_source(left: DataFrame, right: DataFrame) -> Column:
    return left["source"].eqNullSafe(right["_source"])


def hash_thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per source the hash below which a document is taken once more.

    ``sized`` holds (source, size, hash), ``budgets`` (source, budget).  The
    documents below the threshold come as near to the budget as whole hash
    values allow: the value in which the sum passes the budget is taken if that
    brings the sum nearer.  Documents of one hash value stay together.
    """
    state = budgets.select(
        F.col("source").alias("_source"),
        F.col("budget").cast("double").alias("_budget"),
        F.lit(0).cast("bigint").alias("_prefix"),
        F.lit(0).cast("bigint").alias("_below"),
    )
    used = 0
    for bits in LEVELS:
        used += bits
        rest = HASH_BITS - used
        inside = sized.join(
            state,
            _same_source(sized, state)
            & (F.shiftright(sized["hash"], rest + bits) == state["_prefix"]),
        )
        histogram = inside.groupBy(
            "_source", "_budget", "_below", F.shiftright("hash", rest).alias("_bucket")
        ).agg(F.sum("size").alias("_words"))
        running = Window.partitionBy("_source").orderBy("_bucket")
        total = F.col("_below") + F.sum("_words").over(running)
        # Only a source whose budget takes all its words has no such bucket, and drops out.
        state = (
            histogram.withColumn("_with", total)
            .where(F.col("_with") > F.col("_budget"))
            .groupBy("_source", "_budget")
            .agg(F.min(F.struct("_bucket", "_words", "_with")).alias("_at"))
            .select(
                "_source",
                "_budget",
                F.col("_at._bucket").alias("_prefix"),
                (F.col("_at._with") - F.col("_at._words")).alias("_below"),
                F.col("_at._with").alias("_with"),
            )
        )
        if rest:
            state = stored(state.drop("_with"), "mix-level")
    nearer = F.col("_with") - F.col("_budget") < F.col("_budget") - F.col("_below")
    found = state.select(
        "_source", (F.col("_prefix") + nearer.cast("bigint")).alias("_threshold")
    )
    return budgets.join(found, _same_source(budgets, found), "left").select(
        "source", F.coalesce("_threshold", F.lit(1 << HASH_BITS)).alias("threshold")
    )


def _sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, hash) of every row, stored."""
    return stored(
        docs.select(
            "doc_id",
            "source",
            text_size(F.col("text")).alias("size"),
            document_hash(F.col("doc_id"), F.col("source")).alias("hash"),
        ),
        "mix-sizes",
    )


def source_rules(
    sized: DataFrame, weights: Sequence[float], share: float, most: float
) -> DataFrame:
    """Per source: _source, source_size, target, whole copies of each row, and the hash threshold."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    targets = stored(
        source_targets(sums, weights, share, most)
        .withColumn("whole", whole.cast("bigint"))
        .withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")),
        "mix-targets",
    )
    open_budgets = targets.where("budget > 0").select("source", "budget")
    cut = hash_thresholds(sized, open_budgets).select(
        F.col("source").alias("_cut_source"), "threshold"
    )
    return stored(
        targets.join(cut, targets["source"].eqNullSafe(cut["_cut_source"]), "left").select(
            F.col("source").alias("_source"),
            "source_size",
            "target",
            "whole",
            F.coalesce("threshold", F.lit(0).cast("bigint")).alias("threshold"),
        ),
        "mix-rules",
    )


def copies_taken(
    docs: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """Per row of ``docs``: doc_id, source, size, hash, source_size, target, copies.

    ``docs`` needs doc_id, text and source.  A null text has size 0, a null
    source is a source of its own, null ids share a hash per source.  Rows that
    repeat an id within a source have one hash and are taken alike.  A source
    without words has target 0 and gives nothing.  No row gets more than
    ``ceil(most)`` copies.  An empty table gives an empty result.
    """
    sized = _sized(docs)
    rules = source_rules(sized, weights, share, most)
    copies = F.col("whole") + (F.col("hash") < F.col("threshold")).cast("bigint")
    return sized.join(rules, _same_source(sized, rules)).select(
        "doc_id", "source", "size", "hash", "source_size", "target", copies.alias("copies")
    )


def mixed(
    docs: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; columns as given.

    A filter on the hash: the rows meet one rule per source and are not shuffled
    while the stored rules are small enough to send.  Nulls, repeated rows and
    sources without words as in ``copies_taken``; texts of any length stay
    whole; other columns, whatever their names, are kept; an empty table gives
    an empty result.
    """
    rules = source_rules(_sized(docs), weights, share, most)
    rows = docs.select(
        F.struct("*").alias("_row"),
        F.col("source").alias("source"),
        document_hash(F.col("doc_id"), F.col("source")).alias("hash"),
    )
    copies = F.col("whole") + (F.col("hash") < F.col("threshold")).cast("bigint")
    return (
        rows.join(rules, _same_source(rows, rules))
        .where(copies > 0)
        .select("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), copies)))
        .select("_row.*")
    )
