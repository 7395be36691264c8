"""Grouped reports described as data.

`ReportSpec` says what to group by and measure; `run_report` declares the
plan.  Reports that need the location of a restaurant, or a bare column that
is not grouped by, first aggregate the order lines down to (dimensions,
restaurant id, ...) and only then join or regroup.  The join therefore sees
aggregated rows, not the order lines, and a hot restaurant has already been
combined on the map side.  Reports that count distinct orders by location are
the exception: there the first aggregation would not shrink anything.

A star may bring cubes.  A report whose keys, filters and measures one of them
holds is answered from its cells and sets, with the same rows and no line read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillweave import schema as S
from tillweave.functions import numbers as N
from tillweave.operators.cube import Cube
from tillweave.operators.distinct_sets import count_members
from tillweave.operators.filters import keep_known, keep_selected
from tillweave.operators.star import Star

SUM, AVG, MIN, MAX, COUNT, DISTINCT = "sum", "avg", "min", "max", "count", "count_distinct"


@dataclass(frozen=True)
class Measure:
    """One output column; `exact` leaves a money total as a decimal."""

    name: str
    kind: str
    column: str | None = None
    divisor: int = 1
    digits: int | None = None
    mode: str = N.HALF_UP
    exact: bool = False


@dataclass(frozen=True)
class ReportSpec:
    """`carry` maps output names to columns shown but not grouped by (least value)."""

    dims: tuple[str, ...]
    measures: tuple[Measure, ...]
    not_null: tuple[str, ...] = ()
    only: tuple[tuple[str, object], ...] = ()
    carry: tuple[tuple[str, str], ...] = ()
    order: tuple[str, ...] = ()
    limit: int | None = None
    keep_null_keys: bool = True

    def with_limit(self, n: int) -> ReportSpec:
        return replace(self, limit=n)

    def located(self) -> bool:
        return any(d in S.LOCATION_COLUMNS for d in self.dims)

    def columns(self, selection: Mapping[str, Sequence] | None = None) -> set[str]:
        """Fact and location columns the report reads."""
        used = {*self.dims, *self.not_null, *(c for c, _ in self.only)}
        used |= {c for _, c in self.carry} | {m.column for m in self.measures if m.column}
        used |= {c for c, chosen in (selection or {}).items() if chosen}
        if self.located():
            used |= {"restaurant_id"}
        return used


def _output(measure: Measure, dtype: T.DataType | None, total: Column, rows: Column) -> Column:
    """Scale, round and surface an aggregated total."""
    if measure.kind in (COUNT, DISTINCT):
        return total.cast("bigint")
    if measure.kind == AVG:
        value = total.cast("double") / rows
        if measure.divisor != 1:
            value = value / measure.divisor
        return value if measure.digits is None else N.round_double(value, measure.digits, measure.mode)
    if measure.column not in S.MONEY_COLUMNS:
        return total
    if measure.exact:
        return N.scaled_total(total, N.money_scale(dtype), measure.divisor)
    if measure.digits is None:
        value = total.cast("double")
        return value / measure.divisor if measure.divisor != 1 else value
    scaled = N.scaled_total(total, N.money_scale(dtype), measure.divisor)
    return N.round_decimal(scaled, measure.digits, measure.mode).cast("double")


def _sum(column: str, dtype: T.DataType) -> Column:
    if column in S.MONEY_COLUMNS:
        return N.exact_sum(F.col(column), dtype)
    return F.sum(column)


def _distinct(column: str, rsd: float | None) -> Column:
    return F.count_distinct(column) if rsd is None else F.approx_count_distinct(column, rsd)


def _one_step(lines: DataFrame, spec: ReportSpec, rsd: float | None) -> DataFrame:
    types = {f.name: f.dataType for f in lines.schema.fields}
    aggregates = []
    for m in spec.measures:
        dtype = types.get(m.column) if m.column else None
        rows = F.count(m.column) if m.column else None
        if m.kind == COUNT:
            total = F.count("*")
        elif m.kind == DISTINCT:
            total = _distinct(m.column, rsd)
        elif m.kind in (MIN, MAX):
            pick = F.min if m.kind == MIN else F.max
            total = pick(m.column)
        else:
            total = _sum(m.column, dtype)
        aggregates.append(_output(m, dtype, total, rows).alias(m.name))
    return lines.groupBy(*spec.dims).agg(*aggregates)


def _distinct_measures(spec: ReportSpec) -> int:
    return sum(m.kind == DISTINCT for m in spec.measures)


def _split_distinct(lines: DataFrame, spec: ReportSpec) -> DataFrame:
    """Plain measures in one aggregate, each distinct count in a narrow one of its own.

    Several distinct counts in one aggregate would repeat every wide line once
    per count.  Each count reads the group keys and its own column only.
    """
    counted = [m for m in spec.measures if m.kind == DISTINCT]
    plain = replace(spec, measures=tuple(m for m in spec.measures if m.kind != DISTINCT))
    result = _one_step(lines, plain, None)
    for m in counted:
        pairs = lines.select(*spec.dims, m.column).distinct()
        count = pairs.groupBy(*spec.dims).agg(F.count(m.column).alias(m.name))
        match = reduce(
            lambda a, b: a & b, [result[d].eqNullSafe(count[d]) for d in spec.dims]
        )
        kept = [result[c] for c in result.columns]
        result = result.join(count, match).select(*kept, count[m.name])
    return result.select(*spec.dims, *[m.name for m in spec.measures])


def _two_step(lines: DataFrame, spec: ReportSpec, places: DataFrame | None) -> DataFrame:
    """Aggregate to fine keys, attach the location, regroup to the report's keys."""
    types = {f.name: f.dataType for f in lines.schema.fields}
    near = [d for d in spec.dims if d not in S.LOCATION_COLUMNS]
    counted = [m.column for m in spec.measures if m.kind == DISTINCT]
    site = ["restaurant_id"] if places is not None else []
    fine_keys = list(dict.fromkeys([*near, *(c for _, c in spec.carry), *counted, *site]))

    fine, final = [F.count("*").alias("_rows")], []
    for i, m in enumerate(spec.measures):
        dtype = types.get(m.column) if m.column else None
        partial, seen = f"_p{i}", f"_n{i}"
        if m.kind == COUNT:
            total = F.sum("_rows")
        elif m.kind == DISTINCT:
            total = F.count_distinct(m.column)
        elif m.kind in (MIN, MAX):
            pick = F.min if m.kind == MIN else F.max
            fine.append(pick(m.column).alias(partial))
            total = pick(partial)
        else:
            fine.append(_sum(m.column, dtype).alias(partial))
            total = F.sum(partial)
        rows = None
        if m.kind == AVG:
            fine.append(F.count(m.column).alias(seen))
            rows = F.sum(seen)
        final.append(_output(m, dtype, total, rows).alias(m.name))
    carried = [F.min(column).alias(name) for name, column in spec.carry]

    grouped = lines.groupBy(*fine_keys).agg(*fine)
    if places is not None:
        grouped = grouped.join(places, "restaurant_id")
    if not spec.keep_null_keys:
        grouped = keep_known(grouped, spec.dims)
    return grouped.groupBy(*spec.dims).agg(*carried, *final)


def _answering(
    spec: ReportSpec, star: Star, selection: Mapping[str, Sequence]
) -> Cube | None:
    """The star's first cube that holds all the report asks for."""
    used = {*spec.dims, *spec.not_null, *(c for c, _ in spec.only), *(c for _, c in spec.carry)}
    used |= {c for c, chosen in selection.items() if chosen}
    for cube in star.cubes:
        known = set(cube.keys)
        if "restaurant_id" in known and star.restaurants is not None:
            known |= set(S.LOCATION_COLUMNS) & set(spec.dims)
        counted = {m.column for m in spec.measures if m.kind == DISTINCT}
        summed = {m.column for m in spec.measures if m.kind not in (DISTINCT, COUNT)}
        if (
            used <= known
            and summed <= set(cube.types)
            and counted <= set(cube.keys) | set(cube.sets)
        ):
            return cube
    return None


def _from_cube(
    spec: ReportSpec, cube: Cube, star: Star, selection: Mapping[str, Sequence]
) -> DataFrame:
    """The report from a cube's cells and sets.

    Totals and distinct counts meet in a union, not a join, as most of them are
    a row or a few: each part brings its own columns and the last grouping
    takes what is known.
    """
    wanted = [d for d in spec.dims if d in S.LOCATION_COLUMNS]
    near = [d for d in spec.dims if d not in wanted]

    def narrowed(part: DataFrame) -> DataFrame:
        part = keep_known(keep_selected(part, selection), spec.not_null)
        for column, value in spec.only:
            part = part.where(F.col(column) == F.lit(value))
        if not spec.keep_null_keys:
            part = keep_known(part, near)
        if wanted:
            part = part.join(star.restaurants.select("restaurant_id", *wanted), "restaurant_id")
            if not spec.keep_null_keys:
                part = keep_known(part, wanted)
        return part

    cells = narrowed(cube.cells)
    read, final, counts = {"rows"}, [], []
    for i, m in enumerate(spec.measures):
        dtype, rows = cube.types.get(m.column), None
        if m.kind == COUNT:
            total = F.coalesce(F.sum("rows"), F.lit(0))
        elif m.kind == DISTINCT:
            name = f"_d{i}"
            total = F.coalesce(F.sum(name), F.lit(0))
            if m.column in cube.keys:
                values = cells.select(*spec.dims, F.col(m.column).alias("_value")).distinct()
                counts.append(values.groupBy(*spec.dims).agg(F.count("_value").alias(name)))
            else:
                counts.append(count_members(narrowed(cube.sets[m.column]), spec.dims, name))
        else:
            merge, kept = {MIN: (F.min, "min"), MAX: (F.max, "max")}.get(m.kind, (F.sum, "sum"))
            total = merge(f"{kept}_{m.column}")
            read.add(f"{kept}_{m.column}")
            if m.kind == AVG:
                rows = F.sum(f"n_{m.column}")
                read.add(f"n_{m.column}")
        final.append(_output(m, dtype, total, rows).alias(m.name))
    carried = [F.min(column).alias(name) for name, column in spec.carry]
    shown = list(dict.fromkeys([*spec.dims, *(c for _, c in spec.carry)]))
    parts = cells.select(*shown, *sorted(read))
    for count in counts:
        parts = parts.unionByName(count, allowMissingColumns=True)
    return parts.groupBy(*spec.dims).agg(*carried, *final)


def ordering(order: Sequence[str], dims: Sequence[str]) -> list[Column]:
    """Sort columns (`-name` descending), ties broken by the group keys ascending."""
    named = [F.desc(o[1:]) if o.startswith("-") else F.asc(o) for o in order]
    taken = {o.lstrip("-+") for o in order}
    return named + [F.asc(d) for d in dims if d not in taken]


def run_report(
    spec: ReportSpec,
    star: Star,
    selection: Mapping[str, Sequence] | None = None,
    limit: int | None = None,
    approx_distinct: float | None = None,
) -> DataFrame:
    """The report over one dataset, after an optional multi-select filter.

    Distinct counts are exact.  A relative error in `approx_distinct` trades
    that for a sketch, which spares the extra rows that several exact distinct
    counts cost; restaurants by location are always counted exactly.  A cube of
    the star that can answer the report is read in place of its lines.
    """
    cube = _answering(spec, star, selection or {}) if approx_distinct is None else None
    if cube is not None:
        result = _from_cube(spec, cube, star, selection or {})
    else:
        result = _from_lines(spec, star, selection, approx_distinct)

    n = limit if limit is not None else spec.limit
    if spec.order:
        result = result.orderBy(*ordering(spec.order, spec.dims))
    return result if n is None else result.limit(n)


def _from_lines(
    spec: ReportSpec,
    star: Star,
    selection: Mapping[str, Sequence] | None,
    approx_distinct: float | None,
) -> DataFrame:
    lines = keep_selected(star.orders, selection or {})
    lines = keep_known(lines, spec.not_null)
    for column, value in spec.only:
        lines = lines.where(F.col(column) == F.lit(value))
    near = [d for d in spec.dims if d not in S.LOCATION_COLUMNS]
    if not spec.keep_null_keys:
        lines = keep_known(lines, near)

    if spec.located():
        wanted = [d for d in spec.dims if d in S.LOCATION_COLUMNS]
        places = star.restaurants.select("restaurant_id", *wanted)
        if any(m.kind == DISTINCT and m.column != "restaurant_id" for m in spec.measures):
            # Grouping by restaurant and, say, order number first would shuffle
            # almost every line once more than joining first does.
            located = lines.join(places, "restaurant_id")
            if not spec.keep_null_keys:
                located = keep_known(located, wanted)
            return _one_step(located, spec, approx_distinct)
        return _two_step(lines, spec, places)
    if spec.carry:
        return _two_step(lines, spec, None)
    if spec.dims and approx_distinct is None and _distinct_measures(spec) > 1:
        return _split_distinct(lines, spec)
    return _one_step(lines, spec, approx_distinct)
