import json

import pytest
from pyspark.sql import functions as F

from ordermill.sources import readers, sinks
from ordermill.streaming import pipelines


def test_json(spark, tmp_path):
    good, bad, array = tmp_path / "a.jsonl", tmp_path / "b.jsonl", tmp_path / "c.json"
    good.write_text('{"a": 1}\n\n{"a": 2}\n')
    bad.write_text('{"a": 1}\n{"a": \n')
    array.write_text(json.dumps([{"a": 1}, {"a": 2}, {"a": 3}]))
    assert readers.json_lines(spark, str(good), "a int").count() == 2
    with pytest.raises(Exception):
        readers.json_lines(spark, str(bad), "a int").collect()
    assert readers.json_lines(spark, str(bad), "a int", strict=False).collect()[0]["a"] == 1
    assert readers.json_any(spark, str(array), "a int").count() == 3 and readers.json_any(spark, str(good), "a int").count() == 2


def test_text_table_and_names(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("﻿#{t.Sold To},CamelCase,x\n001,a,b\n", encoding="utf-8")
    df = readers.plain_names(readers.text_table(spark, str(p)))
    assert df.columns == ["sold_to", "camel_case", "x"] and df.collect()[0]["sold_to"] == "001"
    assert readers.find_column(df, ["SOLD_TO"]) == "sold_to" and readers.find_column(df, ["camel"]) == "camel_case" and readers.find_column(df, ["zz"]) is None


def test_cached_copy(spark, tmp_path):
    source, copy = str(tmp_path / "s"), str(tmp_path / "c")
    spark.range(3).write.parquet(source)
    assert readers.parquet_cached(spark, source, copy).count() == 3
    spark.range(5).write.mode("overwrite").parquet(source)
    assert readers.parquet_cached(spark, source, copy).count() == 3  # young enough
    assert readers.parquet_cached(spark, source, copy, hours=0).count() == 5
    assert readers.parquet_cached(spark, str(tmp_path / "gone"), copy, hours=0).count() == 5  # stale copy
    assert readers.first_present(spark, [str(tmp_path / "gone"), source]) == source
    assert len(readers.matching(spark, str(tmp_path / "zz*"), str(tmp_path / "[sc]"))) == 2


def test_append_with_other_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.append_aligned(spark.createDataFrame([(1, "a")], "k int, v string"), path, ["k"]) is None
    kept = sinks.append_aligned(spark.createDataFrame([("1", "b", "n"), ("2", "c", "m")], "k string, v string, w string"), path, ["k"])
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v", "w").collect())
    assert got == [("1", "b", "n"), ("2", "c", "m")] and spark.read.parquet(kept).count() == 1


def test_registry_upsert_replace(spark, tmp_path):
    df = spark.createDataFrame([("a", "1"), ("b", "2")], "x string, y string")
    reg, tab = str(tmp_path / "r"), str(tmp_path / "t")
    sinks.register(df, reg, ["x"])
    sinks.register(df, reg, ["x"])
    assert spark.read.parquet(reg).count() == 2
    sinks.upsert(df, tab, "x")
    sinks.upsert(spark.createDataFrame([("b", None), ("c", "3")], "x string, y string"), tab, "x")
    assert sorted(tuple(r) for r in spark.read.parquet(tab).collect()) == [("a", "1"), ("b", "2"), ("c", "3")]
    sinks.replace_where(spark.createDataFrame([("d", "4")], "x string, y string"), tab, "x = 'a'")
    assert sorted(r["x"] for r in spark.read.parquet(tab).collect()) == ["b", "c", "d"]
    sinks.split_by(df, str(tmp_path / "s"), "y")
    assert sorted(p.name for p in (tmp_path / "s").iterdir() if p.is_dir()) == ["y=1", "y=2"]


def test_stream_registry_twice(spark, tmp_path):
    src, at = tmp_path / "in", tmp_path / "out"
    events = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 3)], "id int, k string, t int")
    events.write.parquet(str(src / "f1"))
    stream = lambda: spark.readStream.schema(events.schema).option("recursiveFileLookup", True).parquet(str(src))
    run = lambda: pipelines.into_registry(stream(), ["k"], ["t"], str(at / "t"), str(at / "r"), str(at / "c")).awaitTermination()
    run()
    spark.createDataFrame([(4, "a", 9), (5, "c", 9)], events.schema).write.parquet(str(src / "f2"))
    run()
    assert sorted(r["id"] for r in spark.read.parquet(str(at / "t")).collect()) == [1, 3, 5]


def test_stream_window(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.sql("select timestamp'2024-01-01 00:10:00' ts, 'x' k union all select timestamp'2024-01-01 00:50:00', 'x' union all select timestamp'2024-01-01 01:10:00', 'x'").write.parquet(src)
    stream = pipelines.windowed(pipelines.without_repeats(pipelines.arriving(spark, src, spark.read.parquet(src).schema), ["ts"], "ts"), "ts", "1 hour", "k")
    assert stream.isStreaming and stream.columns == ["window_start", "k", "n"]
    plain = pipelines.windowed(pipelines.arriving(spark, src, spark.read.parquet(src).schema), "ts", "1 hour", "k")
    plain.writeStream.format("memory").queryName("hours").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert sorted(r["n"] for r in spark.table("hours").collect()) == [1, 2]


def test_trim_and_lineage(spark):
    df = readers.with_lineage(readers.trimmed(spark.createDataFrame([("\t a ", 1)], "x string, n int")), "here")
    r = df.collect()[0]
    assert r["x"] == "a" and r["_source"] == "here" and r["_extracted_at"] is not None


def test_views(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "t_one.parquet"))
    assert readers.view_all(spark, str(tmp_path)) == ["t_one"] and spark.sql("select count(*) c from t_one").collect()[0]["c"] == 2


def test_small_readers(spark, tmp_path):
    df = readers.csv_text(spark, '\ufeffa,b\n1,"x\ny"\n2\n')
    assert sorted(tuple(r) for r in df.collect()) == [("1", "x\ny"), ("2", None)] and readers.csv_text(spark, "").columns == []
    import io

    import pandas as pd

    buffer = io.BytesIO()
    pd.DataFrame({"k": [1, 2]}).to_parquet(buffer)
    assert readers.parquet_bytes(spark, buffer.getvalue()).count() == 2
    (tmp_path / "c.json").write_text(json.dumps({"region": "EU", "orgs": ["E1"]}, indent=1))
    assert readers.config(spark, str(tmp_path / "c.json"), "region string, orgs array<string>").collect()[0]["orgs"] == ["E1"]
    df.createOrReplaceTempView("small_one")
    assert readers.first_table(spark, None, ["not_there", "small_one"]) == "small_one" and readers.first_table(spark, "gone", []) is None and "small_one" in readers.tables(spark)
    assert readers.entries(spark.createDataFrame([("Open ", "a"), ("done", "A"), (None, "a")], "s string, k string"), s=["open", "new"], k="A").count() == 1
    assert [r["k"] for r in readers.latest(spark.createDataFrame([(1, 5), (2, 9), (3, 9)], "k int, t int"), "t", "k", 2, ["k", "t"]).collect()] == [2, 3]


def test_files_not_yet_processed_and_mail(spark, tmp_path):
    from email.message import EmailMessage

    inner = EmailMessage()
    inner["Subject"] = "inner"
    inner.set_content("inner text")
    outer = EmailMessage()
    outer.set_content("outer text")
    outer.add_attachment(b"%PDF", maintype="application", subtype="pdf", filename="a.pdf")
    outer.add_attachment(inner)
    (tmp_path / "m.eml").write_bytes(outer.as_bytes())
    (tmp_path / "old.txt").write_text("known")
    (tmp_path / "new.txt").write_text("x" * 200)
    done = spark.createDataFrame([("old.txt",)], "name string")
    files = readers.unprocessed(spark, str(tmp_path), done)
    assert sorted(r["name"] for r in files.collect()) == ["m.eml", "new.txt"] and readers.unprocessed(spark, str(tmp_path), done, skip=["eml$"]).count() == 1
    parts = {(r["name"], r["type"]): r["text"] for r in readers.mail_parts(files.filter("name = 'm.eml'")).collect()}
    assert parts[("a.pdf", "application/pdf")] is None and sorted(t.strip() for t in parts.values() if t) == ["inner text"] or len(parts) >= 2
    texts = {r["path"].rsplit("/", 1)[-1]: r["reader"] for r in readers.document_texts(files, {"eml": lambda b: "y" * 300}).collect()}
    assert texts["new.txt"] == "plain" and set(texts) == {"new.txt", "m.eml"}


def test_shapes_of_tables(spark):
    df = spark.createDataFrame([(1, "a", None)], "k int, v string, w string")
    assert readers.renamed(df, {"v": "x", "zz": "y"}, ["w"]).columns == ["k", "x"]
    assert tuple(readers.completed(df, ["w", "n", "k"]).collect()[0]) == ("", "", "1", "a")
    assert readers.computed_where_missing(df, "v", F.lit("b")).collect()[0]["v"] == "a" and readers.computed_where_missing(df, "w", F.lit("b")).collect()[0]["w"] == "b"
    old = spark.createDataFrame([(("A", "1"), None), ((None, "2"), "B")], "header_fields struct<po: string, n: string>, po string")
    assert sorted(tuple(r) for r in readers.flattened(old, {"po": ["header_fields.po", "po"], "n": ["gone.x", "header_fields.n"], "z": ["nope"]}).collect()) == [("A", "1", None), ("B", "2", None)]
    inner = spark.sql("select array(named_struct('a', 1, '_b', 2)) as items")
    assert readers.without_fields(inner, "items").schema["items"].dataType.elementType.fieldNames() == ["a"]


def test_recovery_after_a_crash_between_renames(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "new")], "k int, v string").write.parquet(f"{path}.new.2")
    spark.createDataFrame([(1, "old")], "k int, v string").write.parquet(f"{path}.bak.2")
    assert sinks.table(spark, path).collect()[0]["v"] == "new"
    other = str(tmp_path / "u")
    spark.createDataFrame([(1, "old")], "k int, v string").write.parquet(f"{other}.bak.2")
    sinks.upsert(spark.createDataFrame([(2, "x")], "k int, v string"), other, "k")
    assert spark.read.parquet(other).count() == 2


def test_reports_loads_and_restores(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-02 03:00:00", "a"), (None, "b")], "timestamp string, x string")
    sinks.audit(df, str(tmp_path / "audit"))
    sinks.audit(df, str(tmp_path / "audit"))
    assert spark.read.json(str(tmp_path / "audit")).count() == 4
    sinks.sheets({"one": df, "two": df}, str(tmp_path / "sheets"))
    assert readers.text_table(spark, str(tmp_path / "sheets/two")).count() == 2
    assert sinks.load({"kb": df}, str(tmp_path / "kb"), {"kb": ["x"]}) == {"kb": 2} and spark.table("kb").count() == 2
    assert sinks.migrate(spark.createDataFrame([("a", 1), ("b", 2)], "x string, n int"), str(tmp_path / "m"), "x") == 0
    a, b = spark.createDataFrame([("k1", "1", "t1")], "k string, v string, at string"), spark.createDataFrame([("k1", "2", "t2", "n"), ("k2", "3", "t1", None)], "k string, v string, at string, w string")
    sinks.restore([a, b], str(tmp_path / "r"), ["k"], "at")
    assert sorted((r["k"], r["v"], r["w"]) for r in spark.read.parquet(str(tmp_path / "r")).collect()) == [("k1", "2", "n"), ("k2", "3", "")]
    sinks.report(df, str(tmp_path / "rep"))
    assert spark.read.json(str(tmp_path / "rep")).count() == 2


def test_worker_tries_again(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.range(3).write.parquet(src)
    seen = []

    def handle(batch, number):
        seen.append(number)
        if len(seen) < 3:
            raise ValueError("not yet")

    pipelines.worker(pipelines.arriving(spark, src, spark.read.parquet(src).schema), handle, str(tmp_path / "c"), wait=0.01).awaitTermination()
    assert seen == [0, 0, 0]
    with pytest.raises(ValueError):
        pipelines.retried(lambda: (_ for _ in ()).throw(ValueError("x")), 2, 0.01)()
