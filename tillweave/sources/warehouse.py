"""Full-refresh load of a star and SQL over it."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave import schema as S
from tillweave.operators import dealing
from tillweave.operators import star as D
from tillweave.operators.star import Star
from tillweave.session import remove_folder

TABLES = ("orders", "restaurants", "products", "customers")


#: Chains whose files a task of the load keeps open at a time; beyond, its lines are sorted by chain.
OPEN_CHAINS = 4
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_POINTER = "version string, loaded timestamp, metrics map<string, bigint>"


def write_star(
    spark: SparkSession, lines: DataFrame, folder: str, mixed_chains: bool = False
) -> Star:
    """Load merged lines as a new version of the star and make it the current one.

    The lines are cast to the declared schema, computed and written once,
    partitioned by chain, which the per-chain reports prune on.  Where each feed
    is a chain, a task holds one chain and writes one file, and no line is sorted
    for it.  ``mixed_chains``
    says that tasks hold many: the lines are then dealt out by chain first, large
    chains to several tasks.  Rows, nulls by column and lines without known money
    are then counted in the stored lines, in one aggregation, as counting some
    thirty things of every row on its way to the files costs more than the files
    do.  The dimensions are read from the stored lines too, with only the columns
    each needs.  A version that breaks the
    load contract is removed; a failure midway leaves the version before it in
    place.
    """
    version = f"{folder}/versions/{uuid.uuid4().hex}"
    kept = [c for c in (*S.LINE_COLUMNS, *S.BOOKKEEPING) if c in lines.columns]
    typed = lines.select(*[F.col(c).cast(S.STORED_FIELDS[c]).alias(c) for c in kept])
    dealt = typed.hint("rebalance", "chain") if mixed_chains else typed
    before = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, OPEN_CHAINS)
    try:
        dealt.write.partitionBy("chain").option("compression", "zstd").parquet(f"{version}/orders")
    finally:
        spark.conf.set(_WRITERS, before)
    stored = _orders(spark, version)
    metrics = _counted(stored, kept)
    many = metrics["rows"] >= dealing.FROM_ROWS
    buyers = ("customer_id", "gender", "has_children", "chain", *S.BOOKKEEPING)
    dimensions = {
        "restaurants": D.restaurant_dimension(stored),
        "products": D.product_dimension(stored),
        "customers": D.customer_dimension(
            _dealt(stored.select(*buyers), "customer_id", f"{version}/dealt") if many else stored
        ),
    }
    for name, df in dimensions.items():
        df.write.parquet(f"{version}/{name}")
    remove_folder(spark, f"{version}/dealt")
    broken = _broken(read_version(spark, version), metrics)
    if broken:
        remove_folder(spark, version)
        raise ValueError("; ".join(broken))
    counts = F.create_map(*[F.lit(x) for pair in metrics.items() for x in pair])
    pointer = spark.range(1).select(
        F.lit(version).alias("version"),
        F.now().alias("loaded"),
        counts.cast("map<string, bigint>").alias("metrics"),
    )
    pointer.coalesce(1).write.mode("append").parquet(f"{folder}/current")
    return read_version(spark, version)


def _dealt(lines: DataFrame, key: str, folder: str) -> DataFrame:
    """Lines dealt out by a key of which tasks hold too few lines each to combine them, else as they are."""
    apart = [c for c in lines.columns if c != S.ROW_ORDINAL]
    return dealing.dealt(lines, [key], folder) if dealing.spread(lines, [key], apart).deals() else lines


def _counted(lines: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Rows, lines without known money and nulls by column."""
    return lines.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(_unknown_money(columns)).alias("unknown_money"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns],
    ).first().asDict()


def _unknown_money(columns: Sequence[str]) -> Column:
    return F.greatest(F.lit(False), *[F.col(c).isNull() for c in S.MONEY_COLUMNS if c in columns])


def _broken(star: Star, metrics: Mapping[str, int]) -> list[str]:
    """The rules of the load contract that a version breaks which was derived from its own lines.

    Money was counted with the nulls.  A line whose keys are known has its
    dimension rows, as those are the groups of these very lines, so only lines
    of unknown keys have to be looked for.
    """
    said = []
    if metrics["unknown_money"]:
        said.append(f"orders known money: {metrics['unknown_money']}")
    rules = [_unique_key(star, table) for table in S.TABLE_KEYS]
    for table, keys in S.TABLE_KEYS.items():
        if any(metrics[f"nulls_{k}"] for k in keys):
            rules.append(_finds(star, table))
    found = _together(rules).where("violations > 0").collect()
    return said + [f"{r.table_name} {r.rule}: {r.violations}" for r in found]


def load_log(spark: SparkSession, folder: str) -> DataFrame:
    """What was counted at each load: (version, loaded, metric, value)."""
    current = spark.read.schema(_POINTER).parquet(f"{folder}/current")
    return current.select("version", "loaded", F.explode("metrics").alias("metric", "value"))


def drop_old_versions(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Remove all versions but the ``keep`` loaded last; the folders removed.

    The current version always stays, and so does a load that is still going on.
    Frames that read a removed version are then of no use.
    """
    if keep < 1:
        raise ValueError("the current version has to stay")
    current = spark.read.schema(_POINTER).parquet(f"{folder}/current")
    # One row per load.
    versions = [r.version for r in current.orderBy(F.desc("loaded"), "version").collect()]
    old = versions[keep:]
    for version in old:
        remove_folder(spark, version)
    return old


def _orders(spark: SparkSession, version: str) -> DataFrame:
    """The stored lines with location and row order, under the declared types."""
    found = spark.read.parquet(f"{version}/orders").columns
    fields = {c: t for c, t in S.STORED_FIELDS.items() if c in found}
    return spark.read.schema(S.struct_of(fields)).parquet(f"{version}/orders").select(*fields)


def read_version(spark: SparkSession, version: str) -> Star:
    names = [n for n in TABLES if n != "orders"]
    tables = {name: spark.read.parquet(f"{version}/{name}") for name in names}
    orders = _orders(spark, version)
    fact = [c for c in S.FACT_COLUMNS if c in orders.columns]
    return Star(**tables, orders=orders.select(*fact), lines=orders)


def read_star(spark: SparkSession, folder: str) -> Star:
    """The current version: the one loaded last."""
    current = spark.read.schema(_POINTER).parquet(f"{folder}/current")
    return read_version(spark, current.orderBy(F.desc("loaded")).first().version)


def _rule(table: str, rule: str, violations: DataFrame) -> DataFrame:
    return violations.select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "violations"
    )


def _together(rules: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), rules)


def _unique_key(star: Star, table: str) -> DataFrame:
    copies = getattr(star, table).groupBy(*S.TABLE_KEYS[table]).count()
    return _rule(table, "unique key", copies.agg(F.count_if(F.col("count") > 1).alias("violations")))


def _finds(star: Star, table: str) -> DataFrame:
    """Lines without a row in a dimension; counted per key first, so the join sees keys and not lines."""
    keys = S.TABLE_KEYS[table]
    used = star.orders.groupBy(*keys).count()
    known = getattr(star, table).select(*[F.col(k).alias(f"_{k}") for k in keys])
    match = F.lit(True)
    for k in keys:
        match = match & used[k].eqNullSafe(known[f"_{k}"])
    lost = used.join(known, match, "left_anti")
    total = lost.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("violations"))
    return _rule("orders", f"finds its {table}", total)


def load_check(star: Star) -> DataFrame:
    """Violations of the load contract: (table_name, rule, violations), one row per rule.

    Keys of the dimensions are unique, money is known, and every line finds its
    dimension rows.  Each table is read once per rule that concerns it; for
    tables that came from elsewhere, as ``write_star`` knows most of this already.
    """
    unknown = star.orders.agg(F.count_if(_unknown_money(star.orders.columns)).alias("violations"))
    return _together(
        [
            *[_unique_key(star, table) for table in S.TABLE_KEYS],
            _rule("orders", "known money", unknown),
            *[_finds(star, table) for table in S.TABLE_KEYS],
        ]
    )


def star_counts(star: Star) -> DataFrame:
    """Row count of each table."""
    counts = [
        getattr(star, name).agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table_name"), "rows"
        )
        for name in TABLES
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def append_log(audit: DataFrame, folder: str, run_id: str | None = None) -> str:
    """Add the rows of one run to the audit log, under the run's id and the time; the id."""
    run = run_id or uuid.uuid4().hex
    stamped = audit.withColumns({"run_id": F.lit(run), "logged_at": F.now()})
    stamped.write.mode("append").parquet(folder)
    return run


def query(spark: SparkSession, sql: str, star: Star) -> DataFrame:
    """SQL over the star's tables, named in braces: `SELECT ... FROM {orders}`."""
    tables = {n: getattr(star, n) for n in TABLES if getattr(star, n) is not None}
    return spark.sql(sql, **{n: t for n, t in tables.items() if "{" + n + "}" in sql})
