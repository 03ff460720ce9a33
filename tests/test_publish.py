"""Publications: all tabs at once, restart after a lost run, damage, and order-free digests."""

import json
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rows import AS_OF, ad_campaigns, back, inventory, orders
from shelfmetrics.plans import bundles
from shelfmetrics.sinks import digests, files, publish, shared_files

STAMP = "2026-03-20 09:00:00"


@pytest.fixture
def report(spark):
    lines = orders(
        spark, dict(order_date=back(1), quantity=10), dict(order_date=back(2), channel='a "b", c'),
        dict(order_date=back(365), category=None),
    )
    return bundles.monthly_business_report(
        lines, inventory(spark, {}, dict(sku="two\nlines")), ad_campaigns(spark, {}), "2026-03", AS_OF, 1000,
        share=False,
    )


def cells(report) -> list:
    return sorted(map(str, bundles.tab_cells(report).collect()))


def test_published_report_reads_back_with_every_cell(spark, tmp_path, report):
    manifest = publish.publish(report, str(tmp_path), STAMP)
    found = publish.read_published(spark, str(tmp_path))
    assert found.manifest == manifest and manifest["number"] == 1
    assert cells(found.report) == cells(report)
    assert [found.report.tabs[t].dtypes for t in report.tabs] == [df.dtypes for df in report.tabs.values()]
    assert (found.report.period, found.report.titles) == (report.period, report.titles)
    assert {t: x["rows"] for t, x in manifest["tabs"].items()} == {t: df.count() for t, df in report.tabs.items()}
    stamp = publish.stamp_cells(spark, manifest).collect()
    assert {r.text for r in stamp if r.header == "generated_at"} == {STAMP}
    # the same run again is the same publication
    assert publish.publish(report, str(tmp_path), STAMP) == manifest
    assert shared_files.names(spark, f"{tmp_path}/manifests") == ["00000001.json"]


class Killed(BaseException):
    pass


def killed_after(monkeypatch, tabs: int, half: bool = False):
    """Let a run die once so many tabs are staged; with half, in the midst of the next one."""
    real, done = publish._stage, []

    def stage(df, path, header):
        if len(done) == tabs:
            if half:
                df.limit(1).write.mode("overwrite").csv(path)
            raise Killed
        done.append(path.rsplit("/", 1)[-1])
        return real(df, path, header)

    monkeypatch.setattr(publish, "_stage", stage)
    return done


@pytest.mark.parametrize("half", [False, True])
def test_a_lost_run_leaves_the_old_report_and_goes_on_where_it_was(spark, tmp_path, report, monkeypatch, half):
    old = bundles.daily_sales_report(orders(spark, {}), AS_OF)
    publish.publish(old, str(tmp_path), "earlier")
    with monkeypatch.context() as patched:
        staged = killed_after(patched, 3, half)
        with pytest.raises(Killed):
            publish.publish(report, str(tmp_path), STAMP)
    assert len(staged) == 3
    seen = publish.read_published(spark, str(tmp_path))
    assert seen.manifest["name"] == "daily_sales" and cells(seen.report) == cells(old)
    with monkeypatch.context() as patched:
        again = killed_after(patched, 99)
        publish.publish(report, str(tmp_path), STAMP)
    assert again == list(report.tabs)[3:]
    assert cells(publish.read_published(spark, str(tmp_path)).report) == cells(report)
    assert cells(publish.read_published(spark, str(tmp_path), 1).report) == cells(old)


def test_other_inputs_are_another_run(spark, tmp_path, report, monkeypatch):
    with monkeypatch.context() as patched:
        killed_after(patched, 2)
        with pytest.raises(Killed):
            publish.publish(report, str(tmp_path), STAMP, inputs="v1")
    with monkeypatch.context() as patched:
        again = killed_after(patched, 99)
        publish.publish(report, str(tmp_path), STAMP, inputs="v2")
    assert again == list(report.tabs)
    lost = publish.run_name(report, STAMP, "v1")
    assert publish.sweep(spark, str(tmp_path)) == [lost]
    assert cells(publish.read_published(spark, str(tmp_path)).report) == cells(report)


def test_damage_is_seen(spark, tmp_path, report):
    manifest = publish.publish(report, str(tmp_path), STAMP)
    folder = f"{tmp_path}/runs/{manifest['run']}/top_sellers"
    part = next(f"{folder}/{f}" for f in os.listdir(folder) if f.startswith("part-") and os.path.getsize(f"{folder}/{f}"))
    text = open(part, encoding="utf-8").read()
    open(part, "w", encoding="utf-8").write(text.replace("1", "2"))
    os.remove(f"{folder}/.{os.path.basename(part)}.crc")
    with pytest.raises(publish.Damaged, match="top_sellers"):
        publish.read_published(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, f"{tmp_path}/nothing")


def test_one_of_two_writers_is_first(spark, tmp_path):
    path = f"{tmp_path}/folder/x.json"
    assert shared_files.create_text(spark, path, "é 1")
    assert not shared_files.create_text(spark, path, "2")
    assert shared_files.read_text(spark, path) == "é 1"
    assert shared_files.names(spark, f"{tmp_path}/folder") == ["x.json"]


def test_a_manifest_that_another_run_took_is_not_overwritten(spark, tmp_path, report, monkeypatch):
    daily = bundles.daily_sales_report(orders(spark, {}), AS_OF)
    real = publish.shared_files.create_text
    raced = []

    def create(spark, path, text):
        if "/manifests/" in path and not raced:
            raced.append(real(spark, path, json.dumps({"run": "other", "number": 1, "tabs": {}})))
        return real(spark, path, text)

    monkeypatch.setattr(publish.shared_files, "create_text", create)
    assert publish.publish(daily, str(tmp_path), STAMP)["number"] == 2
    assert publish._numbers(spark, str(tmp_path)) == [1, 2]


def test_digest_goes_by_content_not_by_order(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(9), rng.choice(["a", None, ""]), rng.random()) for _ in range(300)]
    schema = "a long, b string, c double"

    def digest(rows, parts=3):
        return digests.content_digest(spark.createDataFrame(rows, schema).repartition(parts))

    assert digest(rows) == digest(rows[::-1], 7)
    assert digest(rows) != digest([*rows[1:], rows[1]])
    assert digest([(1, None, 2.0)]) != digest([(1, "", 2.0)])
    assert digest([(None, "1", None)])[1] != digest([(1, None, None)])[1]
    assert digest(rows) != digest([*rows, rows[0]])
    assert digest([])[0] == 0


def test_exports_hold_every_value_or_fail(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 'say "hi",\nok', 1e-300, Decimal("1.50"), True, None), (2, "", -0.1, None, False, b"x"), (3, None, 1e25, None, None, b"")],
        "a long, b string, c double, d decimal(9,2), e boolean, f binary",
    ).withColumn("t", F.timestamp_micros(F.col("a") * 1234567)).repartition(2)
    flat = df.drop("f")
    for kind, own in (("json", df), ("csv", flat)):
        assert files.export(own, f"{tmp_path}/{kind}", kind) == 3
        got = files.read_export(spark, f"{tmp_path}/{kind}", own.schema, kind)
        assert got.dtypes == own.dtypes
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, own.collect()))
        assert files.export(own.limit(0), f"{tmp_path}/{kind}0", kind) == 0
    with pytest.raises(ValueError):
        files.export(df, f"{tmp_path}/x", "xml")


def test_export_notices_lost_rows(spark, tmp_path, monkeypatch):
    real = files.read_export
    monkeypatch.setattr(files, "read_export", lambda *a: real(*a).limit(5))
    with pytest.raises(files.ExportMismatch):
        files.export(spark.range(9), f"{tmp_path}/x", "json")
