"""Reading raw feeds and optional files, and the CSV sink."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillweave import schema as S
from tillweave.operators.positions import number_in_file_order
from tillweave.operators.type_lattice import chosen_type, text_profile

#: How a null is written; a text that equals it cannot be told from a null.
NULL_MARK = "\\N"

# Quotes are doubled, line ends stay inside quotes, spaces and empty texts are kept.
_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": NULL_MARK,
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

#: Lines of a written CSV file.  A file whose quoted fields hold line ends is read by one task.
FILE_LINES = 250_000


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """The column names in the first line; only that line is read."""
    return spark.read.options(**_CSV, inferSchema="false").csv(path).columns


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, line_ends: bool = False
) -> DataFrame:
    """CSV whose header names its columns, under the types of ``schema``.

    Columns are found by name, in whatever order the header has them; others
    are left out.  A missing column, a file whose header differs from the first
    file's and a value that does not fit are errors.  Files are split between
    tasks, unless ``line_ends`` says that quoted fields may hold line ends.
    """
    header = csv_header(spark, path)
    missing = [n for n in schema.names if n not in header]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}; the header has {', '.join(header)}")
    found = T.StructType([schema[n] if n in schema.names else T.StructField(n, T.StringType()) for n in header])
    return _typed_csv(spark, path, found, line_ends).select(*[F.col(f"`{n}`") for n in schema.names])


def _typed_csv(
    spark: SparkSession, path: str, schema: T.StructType, line_ends: bool
) -> DataFrame:
    options = {**_CSV, "mode": "FAILFAST", "enforceSchema": "false", "multiLine": str(line_ends).lower()}
    return spark.read.options(**options).schema(schema).csv(path)


def csv_profile(spark: SparkSession, path: str, line_ends: bool = False) -> DataFrame:
    """What type each column of a CSV holds, see ``chosen_type``; one pass over the file.

    Empty fields count as nulls.
    """
    texts = T.StructType([T.StructField(n, T.StringType()) for n in csv_header(spark, path)])
    df = _typed_csv(spark, path, texts, line_ends)
    return chosen_type(text_profile(df.select(*[F.nullif(F.col(f"`{n}`"), F.lit("")).alias(n) for n in df.columns])))


def read_csv_inferred(spark: SparkSession, path: str, line_ends: bool = False) -> DataFrame:
    """CSV with a header, each column under the least type that holds all its values.

    The file is read twice, once for the types; see ``csv_profile``.  Empty
    fields are nulls.  Columns of nothing but nulls are text.
    """
    rows = csv_profile(spark, path, line_ends).orderBy("position").collect()  # one row per column
    texts = T.StructType([T.StructField(r.column, T.StringType()) for r in rows])
    df = _typed_csv(spark, path, texts, line_ends)
    return df.select(
        *[F.nullif(F.col(f"`{r.column}`"), F.lit("")).cast(r.type).alias(r.column) for r in rows]
    )


def write_csv(df: DataFrame, path: str) -> None:
    """CSV that `read_csv` reads back unchanged; a text equal to the null mark is an error.

    A task writes several files, none of more than ``FILE_LINES`` lines, so that
    reading does not depend on how much a task had to write.
    """
    checked = {
        f.name: F.when(
            F.col(f.name) == NULL_MARK, F.raise_error(F.lit(f"null mark as text in {f.name}"))
        ).otherwise(F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType)
    }
    options = {**_CSV, "emptyValue": '""', "maxRecordsPerFile": str(FILE_LINES)}
    df.withColumns(checked).write.mode("overwrite").options(**options).csv(path)


def read_feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    line_ends: bool = False,
) -> DataFrame:
    """One raw feed, parquet or CSV, with each row's place in the feed.

    Parquet rows without such a column are numbered by file and place in the
    file.  CSV rows have no known place, so a CSV feed must bring the column.
    """
    if fmt == "csv":
        feed = read_csv(spark, path, schema, line_ends)
    else:
        feed = spark.read.schema(schema).format(fmt).load(path)
    if S.ROW_ORDINAL in feed.columns:
        return feed
    if fmt != "parquet":
        raise ValueError(f"a {fmt} feed needs the column {S.ROW_ORDINAL}")
    return number_in_file_order(feed, S.ROW_ORDINAL)


def read_optional_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The file if it is there, otherwise an empty frame of the same schema."""
    try:
        return read_csv(spark, path, schema)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
