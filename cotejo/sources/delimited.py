"""Delimited text files."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cotejo.functions.dates import parse_date
from cotejo.sources import storage

# Names under which the encodings are known elsewhere -> names Spark accepts.
ENCODINGS = {
    "latin1": "ISO-8859-1",
    "utf8": "UTF-8",
    "utf-8-sig": "UTF-8",
    "utf16": "UTF-16",
    "utf-16": "UTF-16",
}
BYTE_ORDER_MARK = "\ufeff"
# Files that the driver opens at a time to read their first line.
OPEN_FILES = 16


def spark_encoding(name: str) -> str:
    return ENCODINGS.get(name.lower(), name)


def text_schema(columns: Sequence[str], types: Mapping[str, str] | None = None) -> T.StructType:
    """Schema with the named columns in file order, text unless ``types`` says otherwise."""
    types = types or {}
    return T.StructType(
        [T.StructField(c, T._parse_datatype_string(types.get(c, "string"))) for c in columns]
    )


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = ";",
    encoding: str = "utf8",
    columns: Sequence[str] | None = None,
    header: bool = True,
) -> DataFrame:
    """Read delimited text with a declared schema; nothing is inferred.

    ``columns`` is the projection: the reader parses only these. Files in two-byte encodings
    are read whole (``multiLine``), because a line break cannot be found in them bytewise;
    all others are split into partitions.
    """
    name = spark_encoding(encoding)
    reader = (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", header)
        .option("encoding", name)
        # A header that names other columns, or another order, is an error; see read_by_header.
        .option("enforceSchema", False)
    )
    if name.upper().startswith("UTF-16") or name.upper().startswith("UTF-32"):
        reader = reader.option("multiLine", True)
    df = reader.csv(path)
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df


def first_lines(spark: SparkSession, paths: Sequence[str], encoding: str = "utf8") -> list[str]:
    """First line of each file, "" where there is none.

    The driver opens the files through Spark's own file system, several at a time, and reads one
    buffer of each; no job is started.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    charset = spark_encoding(encoding)

    def first(path: str) -> str:
        where = jvm.org.apache.hadoop.fs.Path(path)
        stream = where.getFileSystem(conf).open(where)
        try:
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, charset))
            return reader.readLine() or ""
        finally:
            stream.close()

    with ThreadPool(OPEN_FILES) as pool:
        return pool.map(first, paths)


def read_by_header(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType,
    sep: str = ";",
    encoding: str = "utf8",
    file_column: str | None = None,
) -> DataFrame:
    """Read files whose headers may order the columns differently or have further ones.

    Files with the same header are read together, each layout by a schema of its own; columns
    are then taken by name, and one that a layout lacks is null. Files without a line give no
    rows. ``file_column`` adds the name of the file.
    """
    layouts: dict[tuple[str, ...], list[str]] = {}
    for path, line in zip(paths, first_lines(spark, paths, encoding)):
        names = next(csv.reader([line.replace(BYTE_ORDER_MARK, "")], delimiter=sep), [])
        if names:
            layouts.setdefault(tuple(n.strip() for n in names), []).append(path)
    types = {f.name: f.dataType for f in schema}
    charset = spark_encoding(encoding)
    extra = [F.col("_metadata.file_name").alias(file_column)] if file_column else []

    def read(names: tuple[str, ...], files: list[str]) -> DataFrame:
        # Of columns with one name the first counts.
        own = T.StructType(
            [T.StructField(n if n not in names[:i] else f"__{i}", types.get(n, T.StringType())) for i, n in enumerate(names)]
        )
        df = (
            spark.read.schema(own)
            .option("sep", sep)
            .option("header", True)
            .option("enforceSchema", True)
            .option("encoding", charset)
            .option("multiLine", charset.upper().startswith(("UTF-16", "UTF-32")))
            .csv(files)
        )
        return df.select(
            *[F.col(f"`{f.name}`") if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in schema],
            *extra,
        )

    if not layouts:
        columns = [*schema.fields, *([T.StructField(file_column, T.StringType())] if file_column else [])]
        return spark.createDataFrame([], T.StructType(columns))
    return reduce(DataFrame.unionByName, [read(names, files) for names, files in layouts.items()])


def read_folder(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = "|",
    encoding: str = "utf8",
    file_column: str = "source_file",
) -> DataFrame:
    """Read every file of a folder as one table, with the file's name as a column.

    Files may order their columns differently, have further ones or lack some: they are read by
    their headers, one read per layout. Hidden files are left out, as Spark's readers do.
    """
    files = [f"{path.rstrip('/')}/{n}" for n in storage.names(spark, path) if not n.startswith(("_", "."))]
    return read_by_header(spark, files, schema, sep, encoding, file_column)


def unify_dates(
    df: DataFrame,
    column: str,
    formats: Sequence[str] = ("yyyyMMdd", "yyyy-MM-dd"),
    drop_when: Column | None = None,
) -> DataFrame:
    """Bring the date text of differently formatted files to one date column; rows that meet
    ``drop_when`` (a rule for one file) are dropped."""
    df = df.withColumn(column, parse_date(column, formats))
    return df if drop_when is None else df.filter(~F.coalesce(drop_when, F.lit(False)))


def strip_marks(df: DataFrame) -> DataFrame:
    """Column names without a byte order mark and outer blanks."""
    return df.toDF(*[c.replace(BYTE_ORDER_MARK, "").strip() for c in df.columns])


def write_delimited(
    df: DataFrame, path: str, sep: str = ",", encoding: str = "utf8", mode: str = "overwrite"
) -> None:
    """Write delimited text, one file per partition."""
    (
        df.write.mode(mode)
        .option("sep", sep)
        .option("header", True)
        .option("encoding", spark_encoding(encoding))
        .csv(path)
    )


def write_outputs(frames: Mapping[str, DataFrame], root: str, mode: str = "overwrite") -> dict[str, str]:
    """Write the named results of one run, each as a Parquet folder under ``root``."""
    paths = {name: f"{root.rstrip('/')}/{name}" for name in frames}
    for name, df in frames.items():
        df.write.mode(mode).parquet(paths[name])
    return paths


def read_or_empty(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A Parquet table, or an empty one with the same columns when it does not exist yet."""
    if not storage.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
