"""Files, paged stores, sinks and streams."""

import datetime
import json
import zipfile

import pytest

from claimloom.sources import config, files, paged, sinks
from claimloom.streaming import arrivals


def test_headers():
    cols = ["Nr", "OEM  Name", "Land", "Pattern-Vorschlag"]
    assert files.resolve_column(cols, "oem", "name") == "OEM  Name" and files.resolve_column(cols, "x", default="y") == "y"
    assert files.pick_column(cols, ["land", "oem"]) == "Land" and files.pick_column(cols, ["pattern"]) == "Pattern-Vorschlag" and files.pick_column([], ["a"]) is None
    assert files.find_header([["x"], ["", "Land"]], ["land"]) == 1 and files.find_header([], ["a"]) is None
    assert config.deep_merge({"a": {"b": 1, "c": [1]}, "d": 2}, {"a": {"c": [2]}, "e": 3}) == {"a": {"b": 1, "c": [2]}, "d": 2, "e": 3}


def test_csv_json_xlsx(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿name,note\n"x","a\nb"\n', encoding="utf-8")
    assert files.read_csv(spark, str(tmp_path / "a.csv")).collect()[0].asDict() == {"name": "x", "note": "a\nb"}
    (tmp_path / "a.json").write_text(json.dumps([{"v": {"name": "In"}, "n": 1}]))
    assert files.read_records(spark, str(tmp_path / "a.json")).first().v == "In"
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>OEM</t></si><si><r><t>Fal</t></r><r><t>ko</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>Land</t></is></c></row><row><c r="A2" t="s"><v>1</v></c><c r="C2"><v>5</v></c></row><row><c r="A3" t="s"><v>1</v></c></row></sheetData></worksheet>')
    spark.dataSource.register(files.XlsxSource)
    got = spark.read.format("xlsx").option("path", str(tmp_path / "a.xlsx")).load()
    assert got.columns == ["OEM", "c1", "Land"] and [tuple(r) for r in got.collect()] == [("Falko", "", "5"), ("Falko", "", "")]


def test_pattern_and_rule_rows(spark):
    p = spark.createDataFrame([("P1 a", 1), ("P1 b", 2), ("x", 3), (None, 4)], "c string, n int")
    assert [(r.code, r.n) for r in files.pattern_rows(p, "c", "n").collect()] == [("P1", 2)]
    r = spark.createDataFrame([("Ausschluss", "Rad, Boot", "", "aktiv"), ("Text only", "P3 und P7", "", "Aktiv"), ("Ausschluss", "nie", "", "alt")], "signal string, descr string, relevance string, status string")
    x = files.rules_of(r).first()
    assert (x.excluded, x.text_only, x.n_rules) == (["boot", "rad"], ["P3", "P7"], 2)


def test_paged_store(spark):
    src = paged.paged_source("store_a", "id int", lambda page, size: [(page * size + i,) for i in range(size if page < 3 else 1)], pages=20, page_size=4, per_partition=2)
    spark.dataSource.register(src)
    # a short page ends its partition; ranges beyond the end give the store's own answer
    assert spark.read.format("store_a").load().where("id < 13").count() == 13
    # a store with more pages than stated is no shorter table
    full = paged.paged_source("store_b", "id int", lambda page, size: [(page * size + i,) for i in range(size)], pages=3, page_size=4, per_partition=2)
    spark.dataSource.register(full)
    with pytest.raises(Exception, match="more than 3 pages"):
        spark.read.format("store_b").load().count()


def test_retries():
    slept, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise sinks.TransientError
        return "ok"

    assert sinks.with_retry(flaky, sleep=slept.append) == "ok" and slept == [0.5, 1.0]
    with pytest.raises(ValueError):
        sinks.with_retry(lambda: (_ for _ in ()).throw(ValueError()), sleep=slept.append)


def test_batched_sink(spark, tmp_path):
    out = str(tmp_path)

    def send(batch):
        if any(r["id"] == 13 for r in batch):
            raise ValueError
        open(f"{out}/{batch[0]['id']}", "w").write(str(len(batch)))

    assert sinks.write_batches(spark.range(25).coalesce(1), send, size=10, loud=False) == 10
    with pytest.raises(RuntimeError, match="10 rows"):
        sinks.write_batches(spark.range(25).coalesce(1), send, size=10)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["0", "20"]


def test_runs(spark, tmp_path):
    assert sinks.run_id(datetime.datetime(2026, 1, 2, 3, 4), "v3") == "20260102-0304-v3"
    df = spark.range(2)
    sinks.write_csv(df, str(tmp_path / "c"), ["id", "missing"])
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    sinks.append_log(df, str(tmp_path / "l"))
    sinks.append_log(df, str(tmp_path / "l"))
    assert spark.read.parquet(str(tmp_path / "l")).count() == 4
    sinks.snapshot(df, str(tmp_path / "s"), "r", "v3", "before")
    assert spark.read.json(str(tmp_path / "s")).first().suffix == "before"
    assert json.loads(sinks.run_summary("r", "v3", 2))["records"] == 2


def test_streams(spark, tmp_path):
    t = datetime.datetime(2026, 1, 1)
    rows = [(i, t + datetime.timedelta(minutes=20 * i), "a" if i % 2 else "b", 1.0, f"https://x.test/{i % 3}.jpg") for i in range(12)]
    df = spark.createDataFrame(rows, "id int, ts timestamp, k string, v double, url string")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = arrivals.windowed_metrics(stream, "ts", "k", "v").writeStream.format("memory").queryName("w").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select sum(n) from w").first()[0] == 12 and spark.table("w").count() == 8
    q = arrivals.run_batches(arrivals.new_addresses(stream, "url", "ts"), str(tmp_path / "out"), str(tmp_path / "ck"), lambda b: b.select("id", "url_key"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
