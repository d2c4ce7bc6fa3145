"""CSV, JSON and Parquet readers with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import POSITION
from ..schemas import KPIS, PROCESSED, RAW, REPORTS


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system its scheme names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_csv(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """A CSV file with header, quotes and UTF-8 text (with or without BOM).

    Columns are taken by name, in whatever order the header has them, and others are ignored. All
    files of a folder must share one header. ``strict`` fails on malformed rows instead of reading nulls.
    """
    wanted = T.StructType.fromDDL(schema)
    options = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8", "dateFormat": "yyyy-MM-dd"}
    mode = "FAILFAST" if strict else "PERMISSIVE"
    types = {f.name: f.dataType for f in wanted}
    header = spark.read.options(**options).csv(path).columns  # reads the first line only
    found = [name.lstrip("\ufeff").strip() for name in header]
    missing = [name for name in types if name not in found]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    wide = {name: T.DecimalType(24, 4) if isinstance(kind, T.IntegralType) else kind for name, kind in types.items()}
    actual = T.StructType([T.StructField(name, wide.get(name, T.StringType())) for name in found])
    rows = spark.read.options(**options, mode=mode, enforceSchema=False).schema(actual).csv(path)
    return rows.select(*[_whole(name, kind, strict) if name in types and wide[name] != kind else F.col(f"`{name}`") for name, kind in types.items()])


def _whole(name: str, kind: T.DataType, strict: bool) -> Column:
    """A decimal column as whole numbers, so that 2 and 2.0 are the same; a fraction fails, or is null if not ``strict``."""
    value = F.col(f"`{name}`")
    refused = F.raise_error(F.concat(F.lit(f"{name} is not a whole number: "), value.cast("string"))).cast(kind) if strict else F.lit(None).cast(kind)
    return F.when(value.isNull() | (value == F.floor(value)), value.cast(kind)).otherwise(refused).alias(name)


def read_quarantined(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects) of a CSV file with header: no malformed row stops the load and none is lost.

    Rejects have file, line (the raw text) and reason: "open quote", "number of columns", or the first
    column whose text is not of its type. Columns are taken by name, as in ``read_csv``; good rows keep their
    file position. A value cannot hold a line break.
    """
    wanted = T.StructType.fromDDL(schema)
    options = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}
    header = spark.read.options(**options).csv(path).columns
    found = [name.lstrip("\ufeff").strip() for name in header]
    missing = [f.name for f in wanted if f.name not in found]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    lines = with_file_position(spark.read.text(path)).select("value", F.col("_metadata.file_path").alias("file"), POSITION)
    kinds = ", ".join(f"`{name}` STRING" for name in found) + ", `_malformed` STRING"
    parse = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}
    parsed = lines.select("*", F.from_csv("value", kinds, parse).alias("r"))
    names = F.array(*[F.regexp_replace(F.trim(F.col(f"r.`{name}`")), "^\ufeff", "") for name in found])
    parsed = parsed.filter((F.trim("value") != "") & ~F.coalesce(names == F.array(*map(F.lit, found)), F.lit(False)))
    tests = [
        F.when(F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1, "open quote"),
        F.when(F.col("r._malformed").isNotNull(), "number of columns"),
    ]
    columns = []
    for f in wanted:
        text = F.col(f"r.`{f.name}`")
        value = text.try_cast(f.dataType)
        if isinstance(f.dataType, T.IntegralType):
            number = text.try_cast(T.DecimalType(24, 4))
            value = F.when(number == F.floor(number), number.try_cast(f.dataType))
        columns.append(value.alias(f.name))
        tests.append(F.when(text.isNotNull() & value.isNull(), f"{f.name}: not {f.dataType.simpleString()}"))
    parsed = parsed.withColumn("reason", F.coalesce(*tests))
    good = parsed.filter("reason IS NULL").select(*columns, POSITION)
    return good, parsed.filter("reason IS NOT NULL").select("file", F.col("value").alias("line"), "reason")


def load_quarantined(spark: SparkSession, path: str, schema: str, good_path: str, rejects_path: str, most: float = 0.01) -> DataFrame:
    """Write good rows and rejects of a CSV file as Parquet; returns the good ones, in no order and without position.

    More rejects than the share ``most`` of all rows fail the load, after the rejects were written and before any good row is.
    """
    good, rejects = read_quarantined(spark, path, schema)
    rejects.write.mode("overwrite").parquet(rejects_path)
    bad = spark.read.parquet(rejects_path).count()
    total = bad + good.count()
    if bad > most * total:
        raise ValueError(f"{path}: {bad} of {total} rows are malformed, see {rejects_path}")
    good.drop(POSITION).write.mode("overwrite").parquet(good_path)
    return spark.read.schema(schema).parquet(good_path)


def read_untyped(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A CSV file as text columns; cast later with ``cast_schema`` or ``cast_with_rejects``."""
    return read_csv(spark, path, ", ".join(f"`{c}` STRING" for c in columns))


def with_file_position(df: DataFrame) -> DataFrame:
    """Adds where a row stands in its source files, so that "first" can mean file order.

    Must come right after the read. Row ids grow within a file split, and splits are told apart
    by file and start offset.
    """
    place = F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("row")
    )
    return df.select("*", place.alias(POSITION))


def read_raw(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five raw tables of ``folder``, each row with its file position."""
    tables = {}
    for name, schema in RAW.items():
        df = read_csv(spark, f"{folder}/{name}_raw.csv", schema)
        tables[name] = with_file_position(df)
    return tables


def read_processed(
    spark: SparkSession, folder: str, names: Sequence[str] = tuple(PROCESSED), fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """Processed tables as written by ``write_tables``."""
    tables = {}
    for name in names:
        if fmt == "parquet":
            tables[name] = spark.read.schema(PROCESSED[name]).parquet(f"{folder}/{name}")
        else:
            tables[name] = read_csv(spark, f"{folder}/{name}", PROCESSED[name])
    return tables


def read_report(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_csv(spark, f"{folder}/{name}", REPORTS[name])


def read_kpis(spark: SparkSession, path: str) -> DataFrame:
    """The key figures, one JSON object, as one row."""
    return spark.read.schema(KPIS).option("multiLine", True).json(path)


def read_optional(
    spark: SparkSession, path: str, schema: str, required: bool = False, fmt: str = "csv"
) -> DataFrame:
    """The file, or an empty frame of the same schema (an error if ``required``) when it is missing."""
    if exists(spark, path):
        if fmt == "csv":
            return read_csv(spark, path, schema)
        return spark.read.schema(schema).format(fmt).load(path)
    if required:
        raise FileNotFoundError(path)
    return spark.createDataFrame([], schema)


def load_csv_table(spark: SparkSession, path: str, schema: str, table: str, mode: str = "overwrite") -> DataFrame:
    """Load a CSV file into a table, columns matched by name, failing on malformed rows."""
    read_csv(spark, path, schema).write.mode(mode).saveAsTable(table)
    return spark.table(table)
