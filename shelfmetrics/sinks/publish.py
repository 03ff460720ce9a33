"""Reports that appear at once: staged tabs, receipts, and one manifest that commits them.

    <path>/runs/<run>/<tab>/         a tab as a sheet (CSV)
    <path>/runs/<run>/<tab>.json     its receipt: rows and digest, once it is whole
    <path>/manifests/<number>.json   what a reader goes by

A run is known by the report, its period, its stamp and the state of its inputs, so the same job,
started again after it was lost, finds its own folder. Tabs with a receipt that the files still
agree with are kept, others are written anew. Readers see the report before or the whole new one:
they take the manifest of the highest number, and a manifest is created by one rename.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmetrics.plans.bundles import Report
from shelfmetrics.sinks import digests, shared_files
from shelfmetrics.sinks.files import NULL_TEXT, sheet_values
from shelfmetrics.sources.tables import CSV_TEXT

#: Stands for an empty cell in a staged tab, where a missing one is spelled out.
_EMPTY = "\x00"


class Damaged(RuntimeError):
    """Files that do not hold what was written."""


@dataclass
class Publication:
    """A committed report: its manifest, and its tabs as they were before they became sheets."""

    manifest: dict
    report: Report


def run_name(report: Report, generated_at: str, inputs: str = "") -> str:
    known = json.dumps([report.name, report.period, generated_at, inputs])
    return hashlib.sha256(known.encode()).hexdigest()[:16]


def _read_sheet(spark: SparkSession, path: str, width: int) -> DataFrame:
    schema = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(width)])
    reader = spark.read.options(**CSV_TEXT).option("mode", "FAILFAST").option("emptyValue", _EMPTY)
    df = reader.csv(path, schema=schema, header=True, multiLine=True)
    return df.select(*[F.when(F.col(c) != _EMPTY, F.col(c)).otherwise("").alias(c) for c in df.columns])


def _stage(df: DataFrame, path: str, header: list[str]) -> dict:
    """Write a tab and compare the files with what went into them."""
    seen_rows, seen = digests.watched(sheet_values(df).toDF(*[f"c{k}" for k in range(len(header))]))
    named = seen_rows.toDF(*header)
    named.write.mode("overwrite").options(**CSV_TEXT).option("header", True).csv(path)
    rows, digest = digests.observed(seen)
    if digests.content_digest(_read_sheet(df.sparkSession, path, len(header))) != (rows, digest):
        raise Damaged(f"{path} does not hold the rows that were written")
    return {"rows": rows, "digest": digest}


def publish(report: Report, path: str, generated_at: str, inputs: str = "") -> dict:
    """Stage all tabs, commit them, and return the manifest.

    `inputs` names the state of the tables read (versions, dates): tabs of an unfinished run are
    kept only for the same one. A run that is committed already is not repeated.
    """
    spark = next(iter(report.tabs.values())).sparkSession
    run = run_name(report, generated_at, inputs)
    for number in reversed(_numbers(spark, path)):
        manifest = _manifest(spark, path, number)
        if manifest["run"] == run:
            return manifest
    tabs = {}
    for tab, df in report.tabs.items():
        folder = f"{path}/runs/{run}/{tab}"
        header = report.headers.get(tab, df.columns)
        kinds = [f.dataType.simpleString() for f in df.schema.fields]
        receipt = _receipt(spark, folder, len(header))
        if receipt is None:
            shared_files.delete(spark, f"{folder}.json")
            receipt = _stage(df, folder, header)
            shared_files.create_text(spark, f"{folder}.json", json.dumps(receipt))
        tabs[tab] = receipt | {
            "title": report.titles[tab], "header": header, "key": report.keys.get(tab, []),
            "columns": [list(x) for x in zip(df.columns, kinds, strict=True)],
            "named": tab in report.headers,
        }
    manifest = {
        "run": run, "name": report.name, "period": report.period, "generated_at": generated_at,
        "inputs": inputs, "tabs": tabs,
    }
    while True:
        number = max(_numbers(spark, path), default=0) + 1
        text = json.dumps(manifest | {"number": number}, ensure_ascii=False)
        if shared_files.create_text(spark, f"{path}/manifests/{number:08d}.json", text):
            return manifest | {"number": number}


def _receipt(spark: SparkSession, folder: str, width: int) -> dict | None:
    """A staged tab's receipt, if there is one and the files agree with it."""
    if not shared_files.exists(spark, f"{folder}.json"):
        return None
    receipt = json.loads(shared_files.read_text(spark, f"{folder}.json"))
    found = digests.content_digest(_read_sheet(spark, folder, width))
    return receipt if found == (receipt["rows"], receipt["digest"]) else None


def _numbers(spark: SparkSession, path: str) -> list[int]:
    found = shared_files.names(spark, f"{path}/manifests")
    return [int(n.removesuffix(".json")) for n in found if n.endswith(".json")]


def _manifest(spark: SparkSession, path: str, number: int) -> dict:
    return json.loads(shared_files.read_text(spark, f"{path}/manifests/{number:08d}.json"))


def _value(k: int, kind: str) -> Column:
    cell = F.col(f"c{k}")
    return F.when(cell != NULL_TEXT, cell).cast(kind)


def read_published(spark: SparkSession, path: str, number: int | None = None) -> Publication:
    """The last committed report, or that of a number; fails where files and manifest differ.

    A cell `null` is NULL, as sheets spell it.
    """
    numbers = _numbers(spark, path)
    if not numbers:
        raise FileNotFoundError(f"nothing is published at {path}")
    manifest = _manifest(spark, path, max(numbers) if number is None else number)
    tabs = {}
    for tab, told in manifest["tabs"].items():
        sheet = _read_sheet(spark, f"{path}/runs/{manifest['run']}/{tab}", len(told["header"]))
        if digests.content_digest(sheet) != (told["rows"], told["digest"]):
            raise Damaged(f"tab {tab} is not what manifest {manifest['number']} names")
        columns = [_value(k, kind).alias(name) for k, (name, kind) in enumerate(told["columns"])]
        tabs[tab] = sheet.select(*columns)
    told = manifest["tabs"]
    report = Report(
        name=manifest["name"],
        period=manifest["period"],
        tabs=tabs,
        titles={tab: t["title"] for tab, t in told.items()},
        headers={tab: t["header"] for tab, t in told.items() if t["named"]},
        keys={tab: t["key"] for tab, t in told.items()},
    )
    return Publication(manifest, report)


def stamp_cells(spark: SparkSession, manifest: dict) -> DataFrame:
    """When the report was made, for which period, and what its tabs hold, as cells of a tab."""
    rows = [
        ("stamp", json.dumps([tab], ensure_ascii=False), header, text, None)
        for tab, told in manifest["tabs"].items()
        for header, text in (
            ("report", manifest["name"]), ("generated_at", manifest["generated_at"]),
            ("period", manifest["period"]), ("title", told["title"]), ("rows", str(told["rows"])),
        )
    ]
    return spark.createDataFrame(rows, "tab string, row_key string, header string, text string, number double")


def sweep(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Drop runs that none of the last `keep` manifests names, finished or not; returns them.

    Not while a run of this report is under way.
    """
    numbers = sorted(_numbers(spark, path))
    old, kept = numbers[:-keep] if keep else numbers, numbers[-keep:] if keep else []
    named = {_manifest(spark, path, n)["run"] for n in kept}
    gone = [run for run in shared_files.names(spark, f"{path}/runs") if run not in named]
    for n in old:
        shared_files.delete(spark, f"{path}/manifests/{n:08d}.json")
    for run in gone:
        shared_files.delete(spark, f"{path}/runs/{run}")
    return gone
