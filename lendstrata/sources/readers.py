"""Table readers. All are lazy apart from reading a CSV header for its column names."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendstrata.operators.application import fix_anomalies
from lendstrata.sources.schemas import FILES, TABLES
from lendstrata.sources.sinks import materialize, sink_parquet

#: Columns of the parsed table that hold a line that doesn't fit, and its file.
REJECTED, _FILE = "_rejected_line", "_rejected_file"


def csv_schema(spark: SparkSession, path: str, known: dict[str, T.DataType], infer: bool = False) -> T.StructType:
    """Schema in file order: the given types where known, text elsewhere. Only the header line is read.

    With ``infer`` the types of unlisted columns are inferred, which reads the whole file once more.
    """
    columns = spark.read.option("header", True).csv(path).columns
    if infer and not set(columns) <= known.keys():
        guessed = spark.read.csv(path, header=True, inferSchema=True).schema
        return T.StructType([T.StructField(f.name, known.get(f.name, f.dataType)) for f in guessed.fields])
    return T.StructType([T.StructField(c, known.get(c, T.StringType())) for c in columns])


def scan_csv_typed(
    spark: SparkSession, path: str, table: str, schema: T.StructType | None = None, infer: bool = False
) -> DataFrame:
    """One typed table from CSV; NaN texts become missing."""
    schema = schema or csv_schema(spark, path, TABLES[table], infer)
    df = spark.read.csv(path, header=True, schema=schema, nullValue="", mode="FAILFAST")
    return nan_to_null(df)


class TooManyRejects(ValueError):
    """More lines than allowed don't fit their table's types."""


@dataclass
class Parsed:
    """The rows of a CSV that fit its types, and the lines that don't: (table_name, file, line)."""

    rows: DataFrame
    rejects: DataFrame
    rejected: int


def scan_csv_lenient(
    spark: SparkSession,
    path: str,
    table: str,
    schema: T.StructType | None = None,
    infer: bool = False,
    allowed: int | None = None,
) -> Parsed:
    """Like ``scan_csv_typed``, with lines that have a bad cell or another number of cells set apart as they came.

    The file is parsed once, into a stored table from which both sides are read; the rejects are counted on the way. More than
    ``allowed`` end the scan with an error that shows some of them.
    """
    schema = schema or csv_schema(spark, path, TABLES[table], infer)
    read = spark.read.schema(schema.add(REJECTED, T.StringType()) if REJECTED not in schema.names else schema)
    raw = read.csv(path, header=True, nullValue="", mode="PERMISSIVE", columnNameOfCorruptRecord=REJECTED)
    seen = Observation(f"rejects-{uuid.uuid4().hex}")
    counted = raw.select("*", F.col("_metadata.file_path").alias(_FILE)).observe(seen, F.count(REJECTED).alias("rejected"))
    stored = materialize(counted, "parsed")
    bad = stored.where(F.col(REJECTED).isNotNull()).select(F.lit(table).alias("table_name"), F.col(_FILE).alias("file"), F.col(REJECTED).alias("line"))
    rejected = seen.get["rejected"]
    if allowed is not None and rejected > allowed:
        some = "; ".join(r["line"] for r in bad.orderBy("file", "line").limit(3).collect())
        raise TooManyRejects(f"{rejected} lines of {table} don't fit its types, {allowed} are allowed: {some}")
    return Parsed(nan_to_null(stored.where(F.col(REJECTED).isNull()).drop(REJECTED, _FILE)), bad, rejected)


def nan_to_null(df: DataFrame) -> DataFrame:
    """No NaN past the boundary: aggregates treat it as a value, not as missing."""
    return df.select(
        [
            F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def load_tables(
    spark: SparkSession,
    folder: str,
    files: dict[str, str] | None = None,
    clean: bool = True,
    infer: bool = False,
    allowed_rejects: int | None = None,
) -> dict[str, DataFrame]:
    """All eight inputs by name; the two application tables come with their anomalies cleaned.

    ``files`` names other CSV files, or Parquet tables by their ``.parquet`` ending. With ``infer`` the test table takes
    the types inferred from the train table. A line that doesn't fit its table's types ends the job; with ``allowed_rejects`` up to that many
    of each table are set apart, in the table ``rejects``.
    """
    tables: dict[str, DataFrame] = {}
    rejects: list[DataFrame] = []

    def scan(name: str, path: str, schema: T.StructType | None = None) -> DataFrame:
        if allowed_rejects is None:
            return scan_csv_typed(spark, path, name, schema, infer)
        parsed = scan_csv_lenient(spark, path, name, schema, infer, allowed_rejects)
        rejects.append(parsed.rejects)
        return parsed.rows

    for name, file in {**FILES, **(files or {})}.items():
        path = f"{folder}/{file}"
        if file.endswith(".parquet"):
            tables[name] = scan_parquet(spark, path)
        elif infer and name == "application_test":
            trained = {f.name: f.dataType for f in tables["application_train"].schema.fields}
            tables[name] = scan(name, path, csv_schema(spark, path, trained))
        else:
            tables[name] = scan(name, path)
    if clean:
        for name in ("application_train", "application_test"):
            tables[name] = fix_anomalies(tables[name])
    if allowed_rejects is not None:
        none = spark.createDataFrame([], "table_name string, file string, line string")
        tables["rejects"] = reduce(DataFrame.unionByName, rejects, none)
    return tables


def convert_tables(spark: SparkSession, csv_folder: str, parquet_folder: str) -> dict[str, str]:
    """Store the raw CSV inputs as typed Parquet once; returns the ``files`` to load them by.

    Worth it for large inputs: later scans read only the columns they use, and the passes that look
    for hot keys read a single one.
    """
    files = {name: f"{name}.parquet" for name in FILES}
    for name, df in load_tables(spark, csv_folder, clean=False).items():
        sink_parquet(df, f"{parquet_folder}/{files[name]}")
    return files


def scan_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan; a column list is pushed into the read schema."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df
