"""Types of text columns: the least type that holds every value, and the least that holds two types.

Two chains meet in text: whole numbers are decimals are doubles, and days are
points in time; truth values and, below everything, nothing but nulls stand
alone.  What a value is, is decided by its form, so any engine decides alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The forms of values, as fixed patterns.
PATTERNS = {
    "whole": "^[+-]?[0-9]{1,18}$",
    "exact": "^[+-]?[0-9]{1,20}([.][0-9]{1,18})?$",
    "float": "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$",
    "day": "^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$",
    "time": "^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])"
    "([ T]([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]([.][0-9]{1,6})?)?$",
    "truth": "^([tT]rue|[fF]alse|TRUE|FALSE)$",
}
#: From the narrowest type of each chain upwards.
CHAINS = (("truth",), ("whole", "exact", "float"), ("day", "time"))


def is_form(value: Column, form: str) -> Column:
    """Whether a text has the form; a day must be one of the calendar."""
    fits = value.rlike(PATTERNS[form])
    if form in ("day", "time"):
        fits = fits & F.substring(value, 1, 10).try_cast("date").isNotNull()
    return fits


def form_of(value: Column) -> Column:
    """The narrowest form that a text has, as its place in ``PATTERNS`` from 0; null for none.

    Each form of a chain is one of the wider ones as well, and the chains tell
    themselves by their first sign, so a value is tried against few patterns.
    """
    places = {form: i for i, form in enumerate(PATTERNS)}
    first = F.substring(value, 1, 1)

    def least(forms: Sequence[str]) -> Column:
        found = F.lit(None).cast("int")
        for form in reversed(forms):
            found = F.when(is_form(value, form), F.lit(places[form])).otherwise(found)
        return found

    digit = first.between("0", "9")
    truth, number, moment = CHAINS
    # A day goes on with a dash behind four signs, as few numbers do.
    dashed = digit & (F.substring(value, 5, 1) == "-")
    return (
        F.when(dashed, F.coalesce(least(moment), least(number)))
        .when(digit | first.isin("+", "-", "."), least(number))
        .when(first.isin("t", "T", "f", "F"), least(truth))
    )


def _holding(form: str) -> list[int]:
    """Places of the forms whose values all have ``form``: itself and the narrower ones of its chain."""
    chain = next(c for c in CHAINS if form in c)
    return [list(PATTERNS).index(f) for f in chain[: chain.index(form) + 1]]


def text_profile(df: DataFrame) -> DataFrame:
    """One row per column of texts: how many values have which form; one pass over ``df``.

    Columns: position, column, values, nulls, whole_digits and scale (the most
    before and behind the point of an exact number), and a count per form.  The
    form of a value is found once and then counted.
    """
    forms = df.select(
        *[F.col(f"`{name}`").alias(f"_v{i}") for i, name in enumerate(df.columns)],
        *[form_of(F.col(f"`{name}`")).alias(f"_f{i}") for i, name in enumerate(df.columns)],
    )
    one = []
    for position, name in enumerate(df.columns):
        value, form_no = F.col(f"_v{position}"), F.col(f"_f{position}")
        exact = F.when(form_no.isin(_holding("exact")), F.ltrim(value, F.lit("+-")))
        one.append(
            F.struct(
                F.lit(position).alias("position"),
                F.lit(name).alias("column"),
                F.count(value).alias("values"),
                F.count_if(value.isNull()).alias("nulls"),
                F.max(F.length(F.substring_index(exact, ".", 1))).alias("whole_digits"),
                F.max(
                    F.when(F.contains(exact, F.lit(".")), F.length(F.substring_index(exact, ".", -1)))
                ).alias("scale"),
                *[
                    F.count_if(form_no.isin(_holding(form))).alias(f"n_{form}")
                    for form in PATTERNS
                ],
            )
        )
    # A single row of one struct per column, turned into rows.
    return forms.agg(F.array(*one).alias("found")).select(F.inline("found"))


def chosen_type(profile: DataFrame) -> DataFrame:
    """The profile with ``type``, and ``conflicts``: values that stand against a narrower type.

    A column gets the least type that all its values have; with no value it
    stays text.  Conflicts counts, for a column of a wider type than most of its
    values need, the values that are not of that narrower type.
    """
    values, filled = F.col("values"), F.col("values") > 0
    places = F.coalesce("scale", F.lit(0))
    decimal = F.concat(
        F.lit("decimal("), (F.coalesce("whole_digits", F.lit(1)) + places).cast("string"),
        F.lit(","), places.cast("string"), F.lit(")"),
    )
    names = {
        "truth": F.lit("boolean"), "whole": F.lit("bigint"), "exact": decimal,
        "float": F.lit("double"), "day": F.lit("date"), "time": F.lit("timestamp"),
    }
    kind, least = F.lit("string"), F.lit(0)
    for chain in reversed(CHAINS):
        for form in reversed(chain):
            whole = filled & (F.col(f"n_{form}") == values)
            kind = F.when(whole, names[form]).otherwise(kind)
    for chain in CHAINS:
        for form in chain:
            most = (F.col(f"n_{form}") * 2 > values) & (F.col(f"n_{form}") < values)
            least = F.greatest(least, F.when(most, values - F.col(f"n_{form}")).otherwise(0))
    return profile.withColumns({"type": kind, "conflicts": least})


_NUMBERS = (T.IntegerType, T.LongType, T.DecimalType, T.FloatType, T.DoubleType)


def join_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, _NUMBERS) and isinstance(b, _NUMBERS):
        floats = (T.FloatType, T.DoubleType)
        if isinstance(a, floats) or isinstance(b, floats):
            return T.DoubleType()
        (p, s), (q, r) = (_digits(x) for x in (a, b))
        if s == r == 0 and not isinstance(a, T.DecimalType) and not isinstance(b, T.DecimalType):
            return T.LongType()
        whole, scale = max(p - s, q - r), max(s, r)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def _digits(kind: T.DataType) -> tuple[int, int]:
    if isinstance(kind, T.DecimalType):
        return kind.precision, kind.scale
    return (10, 0) if isinstance(kind, T.IntegerType) else (19, 0)


def widened(frames: Sequence[DataFrame]) -> list[DataFrame]:
    """The frames with every shared column cast to the least type that holds all its types."""
    kinds: dict[str, list[T.DataType]] = {}
    for df in frames:
        for f in df.schema.fields:
            kinds.setdefault(f.name, []).append(f.dataType)
    common = {name: reduce(join_types, found) for name, found in kinds.items()}
    out = []
    for df in frames:
        casts = {
            f.name: F.col(f"`{f.name}`").cast(common[f.name])
            for f in df.schema.fields
            if f.dataType != common[f.name]
        }
        out.append(df.withColumns(casts) if casts else df)
    return out
