"""JSON and CSV exports, and report bundles as one CSV directory per tab.

Every writer writes from the executors. A sorted report keeps its order across
part files, in file-name order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmetrics.plans.bundles import Report
from shelfmetrics.sinks import digests
from shelfmetrics.sources.tables import CSV_TEXT

NULL_TEXT = "null"


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines of all rows."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> int:
    """CSV export, blanks and all; returns the number of rows, counted while they are written."""
    counted = Observation("written")
    (
        df.observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .options(**CSV_TEXT)
        .option("header", header)
        .csv(path)
    )
    return counted.get["rows"]


class ExportMismatch(RuntimeError):
    """An export whose files do not hold the rows that were written."""


#: Times with all their digits.
_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
#: Stands for an empty cell in a CSV export, where a missing one is empty.
_EMPTY = "\x00"


def read_export(spark: SparkSession, path: str, schema: T.StructType, kind: str) -> DataFrame:
    """The rows of a verified export, in their types."""
    if kind == "json":
        return spark.read.options(**_TIMES).option("mode", "FAILFAST").schema(schema).json(path)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    reader = spark.read.options(**CSV_TEXT).option("mode", "FAILFAST").option("emptyValue", _EMPTY)
    df = reader.csv(path, schema=texts, header=True, multiLine=True)

    def value(field: T.StructField) -> Column:
        cell = F.col(f"`{field.name}`")
        return F.when(cell == _EMPTY, "").otherwise(cell).cast(field.dataType).alias(field.name)

    return df.select(*[value(f) for f in schema.fields])


def export(df: DataFrame, path: str, kind: str) -> int:
    """Export all rows as JSON lines or CSV, compare the files with what went into them, and return
    the number of rows.

    The digest of the rows is taken while they are written; that of the files is taken by reading
    them back in the table's types, so it also tells a value that the format cannot hold. CSV holds
    flat columns only.
    """
    if kind not in ("json", "csv"):
        raise ValueError(kind)
    rows, seen = digests.watched(df)
    if kind == "json":
        rows.write.mode("overwrite").options(**_TIMES).option("ignoreNullFields", "false").json(path)
    else:
        cells = rows.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) for f in df.schema.fields])
        cells.write.mode("overwrite").options(**CSV_TEXT).option("header", True).csv(path)
    written = digests.observed(seen)
    found = digests.content_digest(read_export(df.sparkSession, path, df.schema, kind))
    if found != written:
        raise ExportMismatch(f"{path}: {written[0]} rows written, {found[0]} found, or other values")
    return written[0]


def _text(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    text = value.cast("string")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        # Plain digits, since spreadsheets do not want 1.25E7.
        digits = value.try_cast("decimal(38,17)").cast("string")
        plain = F.when(digits.cast("double") == value, F.regexp_replace(digits, r"\.?0+$", ""))
        text = F.coalesce(plain, text)
    return F.coalesce(text, F.lit(NULL_TEXT))


def sheet_values(df: DataFrame, header: list[str] | None = None) -> DataFrame:
    """Every value as text, NULL spelled out; ``header`` renames columns by position."""
    names = header or df.columns
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} header cells for {len(df.columns)} columns")
    return df.select(
        *[_text(field).alias(name) for field, name in zip(df.schema.fields, names, strict=True)]
    )


def write_tab(df: DataFrame, path: str, header: list[str] | None = None) -> int:
    """One spreadsheet tab. Without a ``header`` the first line is already data."""
    return write_csv(sheet_values(df, header), path, header=header is not None)


def report_stamp(
    spark: SparkSession, report: Report, generated_at: str, rows: dict[str, int]
) -> DataFrame:
    """When the report was made, for which period, and what its tabs hold."""
    lines = [
        (report.name, generated_at, report.period, tab, report.titles[tab], count)
        for tab, count in rows.items()
    ]
    schema = "report string, generated_at string, period string, tab string, title string, rows long"
    return spark.createDataFrame(lines, schema)


def write_report(report: Report, path: str, generated_at: str) -> dict[str, int]:
    """Write all tabs below ``path`` and a ``stamp`` next to them; returns rows per tab.

    An older stamp goes first, so that a run that fails leaves no stamp beside mixed tabs.
    """
    spark = next(iter(report.tabs.values())).sparkSession
    stamp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/stamp")
    stamp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(stamp, True)
    rows = {
        tab: write_tab(df, f"{path}/{tab}", report.headers.get(tab))
        for tab, df in report.tabs.items()
    }
    write_csv(report_stamp(spark, report, generated_at, rows), f"{path}/stamp")
    return rows
