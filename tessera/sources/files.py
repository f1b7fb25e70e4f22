"""Readers: CSV, Parquet, JSON and SQLite tables, and catalogs of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tessera.functions import names

PDF_LEAST_BYTES = 10_240


def csv(spark: SparkSession, path, encoding: str = "UTF-8", columns: list[str] | None = None) -> DataFrame:
    """All columns as text; a byte order mark leaves the first header."""
    reader = spark.read.option("header", True).option("encoding", encoding).option("multiLine", True).option("escape", '"')
    df = reader.schema(StructType([StructField(c, StringType()) for c in columns])).csv(path) if columns else reader.csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def csv_folder(spark: SparkSession, path: str) -> DataFrame:
    """All CSV files of a folder with file name, week and year; an empty folder fails."""
    df = csv(spark, f"{path.rstrip('/')}/*.csv").withColumn("SourceFile", F.col("_metadata.file_name"))
    week, year = names.file_week(F.col("SourceFile"))
    return df.withColumns({"WeekNumber": week, "Year": year})


def filled_tables(spark: SparkSession, path: str, rows: int = 2, columns: int = 3) -> DataFrame:
    """Rows of a folder's table files of more than ``rows`` rows and ``columns``
    columns, with the file's name; files share one header."""
    df = csv(spark, f"{path.rstrip('/')}/*.csv").withColumn("SourceFile", F.col("_metadata.file_name"))
    if len(df.columns) - 1 <= columns:
        return df.limit(0)
    return df.join(df.groupBy("SourceFile").agg(F.count("*").alias("_n")).filter(F.col("_n") > rows).drop("_n"), "SourceFile", "left_semi")


def rule_csv(spark: SparkSession, path: str) -> DataFrame:
    return names.rename_headers(csv(spark, path))


def parquet_logs(spark: SparkSession, path: str) -> DataFrame:
    """All run files as one table; columns that some files lack are null."""
    return spark.read.option("mergeSchema", True).parquet(path)


def json_lines(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A row per line; malformed lines go."""
    reader = spark.read.option("mode", "DROPMALFORMED")
    return (reader.schema(schema) if schema else reader).json(path)


def json_array(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def json_folder(spark: SparkSession, path: str) -> DataFrame:
    """Files of JSON arrays as one table, each row tagged with its document's name."""
    df = json_array(spark, f"{path.rstrip('/')}/*.json").withColumn("_f", F.col("_metadata.file_name"))
    return df.withColumn("SourceFile", F.concat(F.regexp_replace("_f", r"\.json$", ""), F.lit(".pdf"))).drop("_f")


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, name, bytes, modified) of files, without reading their content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def extraction_catalog(files: DataFrame) -> DataFrame:
    """CSV files outside archive folders with week, year, model and run, newest first."""
    week, year, model, run = names.extraction_file(F.col("name"))
    out = files.filter(F.lower("name").endswith(".csv") & ~F.col("path").contains("/archive/"))
    return out.select("path", "name", week.alias("week"), year.alias("year"), model.alias("model"), run.alias("run_id")).orderBy(F.desc("year"), F.desc("week"), F.desc("run_id"))


def newest_extractions(catalog: DataFrame, weeks: list[int] | None = None, year: int | None = None, model: str | None = None) -> DataFrame:
    """The newest run per week, year and model; a filter that is None lets all pass."""
    out = catalog if weeks is None else catalog.filter(F.col("week").isin(weeks))
    out = out if year is None else out.filter(F.col("year") == year)
    out = out if model is None else out.filter(F.col("model") == model)
    return out.groupBy("year", "week", "model").agg(F.max_by("path", F.struct("run_id", "path")).alias("path"), F.max("run_id").alias("run_id"))


def load_extractions(spark: SparkSession, catalog: DataFrame, **wanted) -> DataFrame:
    """The newest files' rows with week, year and file name; none is an error."""
    files = newest_extractions(catalog, **wanted)
    paths = [r["path"] for r in files.select("path").collect()]  # a file a week and model
    if not paths:
        raise FileNotFoundError(f"no extraction matches {wanted}")
    df = csv(spark, paths).withColumn("SourceFile", F.col("_metadata.file_name"))
    week, year, _, _ = names.extraction_file(F.col("SourceFile"))
    known = {"WeekNumber": week, "Year": year}
    return df.withColumns({k: v for k, v in known.items() if k not in df.columns})


def valid_pdfs(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    good = (F.col("length") >= PDF_LEAST_BYTES) & (F.substring("content", 1, 4) == F.lit(b"%PDF"))
    return files.select("path", F.col("length").alias("bytes"), F.coalesce(good, F.lit(False)).alias("valid"))


def unprocessed(wanted: DataFrame, done: DataFrame, key: str = "name") -> DataFrame:
    return wanted.join(done.select(key).distinct(), key, "left_anti")


class SQLiteSource(DataSource):
    """``spark.read.format("sqlite").option("path", file).option("table", name)``,
    split by ranges of rowid; ``partitions`` says into how many."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> StructType:
        import sqlite3

        kinds = {"INTEGER": LongType(), "REAL": DoubleType(), "BOOLEAN": LongType()}
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as db:
            rows = db.execute("SELECT name, type FROM pragma_table_info(?)", (self.options["table"],)).fetchall()
        if not rows:
            raise ValueError(f"no table {self.options['table']}")
        return StructType([StructField(n, kinds.get((t or "").upper(), StringType())) for n, t in rows])

    def reader(self, schema: StructType) -> DataSourceReader:
        return SQLiteReader(self.options, schema)


class SQLiteReader(DataSourceReader):
    def __init__(self, options, schema: StructType):
        self.path, self.table = options["path"], options["table"]
        self.parts, self.schema = int(options.get("partitions", "4")), schema

    def _quoted(self, name: str) -> str:
        return '"' + name.replace('"', '""') + '"'

    def partitions(self):
        import sqlite3

        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {self._quoted(self.table)}").fetchone()
        if low is None:
            return [InputPartition((0, -1))]
        step = -(-(high - low + 1) // self.parts)
        return [InputPartition((a, min(a + step - 1, high))) for a in range(low, high + 1, step)]

    def read(self, partition):
        import sqlite3

        columns = ", ".join(self._quoted(f.name) for f in self.schema.fields)
        casts = [{"bigint": int, "double": float, "string": str}[f.dataType.simpleString()] for f in self.schema.fields]
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            for row in db.execute(f"SELECT {columns} FROM {self._quoted(self.table)} WHERE rowid BETWEEN ? AND ?", partition.value):
                yield tuple(None if v is None else k(v) for k, v in zip(casts, row))


def sqlite(spark: SparkSession, path: str, table: str, partitions: int = 4) -> DataFrame:
    spark.dataSource.register(SQLiteSource)
    return spark.read.format("sqlite").option("path", path).option("table", table).option("partitions", partitions).load()
