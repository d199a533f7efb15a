"""Readers. Schemas are given, not inferred; what is probed is file names, on the driver."""

from __future__ import annotations

import email
import email.policy
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions.text import squeezed
from ordermill.sources import files


def json_lines(spark: SparkSession, path: str | list[str], schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """One record per line; blank lines are skipped. A malformed line fails (strict) or is dropped."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def json_any(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """An array of records or one record per line, told by the first character."""
    first = spark.read.text(path, wholetext=False).filter(F.trim("value") != "").limit(1).collect()
    array = bool(first) and first[0]["value"].lstrip().startswith("[")
    return spark.read.schema(schema).option("multiLine", array).json(path)


def text_table(spark: SparkSession, path: str | list[str], columns: list[str] | None = None, separator: str = ",") -> DataFrame:
    """CSV with every column as text; a byte-order mark in the header is removed."""
    df = spark.read.option("header", True).option("sep", separator).option("inferSchema", False).option("quote", '"').option("escape", '"').csv(path)
    df = df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])
    return df.select(*columns) if columns else df


def parquet_cached(spark: SparkSession, source: str, copy: str, hours: float = 24.0) -> DataFrame:
    """A local copy of a table if it is younger than hours, else the source; if that can't be read, the stale copy.

    A fresh read is written to copy beside the old one and takes its place when complete.
    """
    marker = f"{copy}/_SUCCESS"
    if files.age_seconds(spark, marker) < hours * 3600:
        return spark.read.parquet(copy)
    fresh = f"{copy}.{time.time_ns()}"
    try:
        spark.read.parquet(source).write.parquet(fresh)
    except Exception:
        if files.exists(spark, marker):
            return spark.read.parquet(copy)
        raise
    if files.exists(spark, copy):
        files.rename(spark, copy, f"{copy}.old.{time.time_ns()}")
    files.rename(spark, fresh, copy)
    return spark.read.parquet(copy)


def first_present(spark: SparkSession, paths: list[str], least_bytes: int = 3) -> str | None:
    """The first path that exists and isn't trivial, on whatever file system."""
    return next((p for p in paths if files.exists(spark, p) and (files.is_folder(spark, p) or files.size(spark, p) >= least_bytes)), None)


def matching(spark: SparkSession, pattern: str, otherwise: str | None = None) -> list[str]:
    return files.matching(spark, pattern) or (files.matching(spark, otherwise) if otherwise else [])


def csv_text(spark: SparkSession, text: str, separator: str = ",") -> DataFrame:
    """A CSV answer of a service as a table of text columns; lines inside quotes stay in their row."""
    import csv
    import io

    rows = [r for r in csv.reader(io.StringIO(text.lstrip("\ufeff")), delimiter=separator) if r]
    names = [c.strip() for c in rows[0]] if rows else []
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    return spark.createDataFrame([tuple((r + [None] * len(names))[: len(names)]) for r in rows[1:]], schema)


def parquet_bytes(spark: SparkSession, data: bytes) -> DataFrame:
    """A Parquet file that came as bytes: a message or answer, so of a driver's size; larger ones are read by path."""
    import io

    import pyarrow.parquet as pq

    return spark.createDataFrame(pq.read_table(io.BytesIO(data)))


def database(spark: SparkSession, url: str, query: str, key: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 16, **options: str) -> DataFrame:
    """A query of a relational database; with key and bounds in parallel ranges, else in one task."""
    r = spark.read.format("jdbc").option("url", url).options(**options)
    if key and bounds:
        return r.option("dbtable", f"({query}) q").option("partitionColumn", key).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", parts).load()
    return r.option("query", query).load()


def config(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A small JSON document over several lines; an object of objects gives one row each, by its name in column 'name'."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def first_table(spark: SparkSession, pinned: str | None, candidates: list[str]) -> str | None:
    """The pinned table if the catalog has it, else the first candidate that it has."""
    return next((t for t in [pinned, *candidates] if t and spark.catalog.tableExists(t)), None)


def tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


def entries(df: DataFrame, **wanted: str | list[str]) -> DataFrame:
    """Rows whose columns hold one of the wanted values, case and blanks at the ends aside."""
    for c, v in wanted.items():
        values = [v] if isinstance(v, str) else v
        df = df.filter(F.lower(F.trim(c)).isin(*[x.strip().lower() for x in values]))
    return df


def latest(df: DataFrame, time_column: str, key: str, n: int, columns: list[str]) -> DataFrame:
    """The n latest rows: the first page of a mailbox or log."""
    return df.select(*columns).orderBy(F.desc(time_column), key).limit(n)


def unprocessed(spark: SparkSession, folder: str, done: DataFrame, name: str = "name", pattern: str = "*", skip: list[str] | None = None) -> DataFrame:
    """name, path, length, content of a folder's files that `done` (name) doesn't list; skip are patterns of names."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    df = df.withColumn(name, F.element_at(F.split("path", "/"), -1))
    for s in skip or []:
        df = df.filter(~F.col(name).rlike(s))
    return df.join(done.select(name).distinct(), name, "left_anti").select(name, "path", "length", "content")


def mail_parts(files_: DataFrame, deepest: int = 5) -> DataFrame:
    """path, part, name, type, text, content: parts of messages as files (path, content), attached messages unpacked too.

    part is the way to it ('2.1'); text is set for text parts, content for others. What can't be read as a message gives
    no row.
    """

    def walk(m, at: str, depth: int) -> Iterator[tuple]:
        for i, p in enumerate(m.iter_parts() if m.is_multipart() else [m], 1):
            where = f"{at}.{i}" if at else str(i)
            if p.get_content_type() == "message/rfc822" and depth < deepest:
                yield from walk(p.get_content(), where, depth + 1)
            elif p.is_multipart():
                yield from walk(p, where, depth)
            else:
                raw = p.get_payload(decode=True) or b""
                is_text = p.get_content_maintype() == "text" and not p.is_attachment()
                yield where, p.get_filename(), p.get_content_type(), raw.decode(p.get_content_charset() or "utf-8", "replace") if is_text else None, None if is_text else raw

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(path, *r) for path, c in zip(pdf["path"], pdf["content"]) for r in walk(email.message_from_bytes(bytes(c), policy=email.policy.default), "", 1)]
            yield pd.DataFrame(rows, columns=["path", "part", "name", "type", "text", "content"])

    return files_.select("path", "content").mapInPandas(run, "path string, part string, name string, type string, text string, content binary")


def document_texts(files_: DataFrame, others: dict[str, Callable[[bytes], str | None]] | None = None, least: int = 100) -> DataFrame:
    """path, text, reader: the text of files (path, content). Plain text is read here; others has a function for each
    extension, tried in its order (a scan's reader can follow a text layer's as 'pdf', 'pdf+'); the first answer of
    `least` characters counts, else the longest."""
    known = others or {}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, c in zip(pdf["path"], pdf["content"]):
                kind = path.rsplit(".", 1)[-1].lower()
                answers = [("plain", bytes(c).decode("utf-8", "replace"))] if kind in ("txt", "csv", "eml") else []
                for name, f in known.items():
                    if name.rstrip("+") == kind and not any(len(t) >= least for _, t in answers):
                        answers.append((name, f(bytes(c)) or ""))
                good = [a for a in answers if len(a[1]) >= least] or sorted(answers, key=lambda a: -len(a[1]))
                if good:
                    rows.append((path, good[0][1], good[0][0]))
            yield pd.DataFrame(rows, columns=["path", "text", "reader"])

    return files_.select("path", "content").mapInPandas(run, "path string, text string, reader string")


def renamed(df: DataFrame, names: dict[str, str], drop: list[str] | None = None) -> DataFrame:
    """Columns by a map of names (those that exist); the others stay, the listed ones go."""
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns}).drop(*(drop or []))


def completed(df: DataFrame, columns: list[str], default: str = "") -> DataFrame:
    """All of columns as text, in order: missing ones and NULLs get the default; others stay behind them."""
    have = [F.coalesce(F.col(c).cast("string"), F.lit(default)).alias(c) if c in df.columns else F.lit(default).alias(c) for c in columns]
    return df.select(*have, *[c for c in df.columns if c not in columns])


def computed_where_missing(df: DataFrame, column: str, value) -> DataFrame:
    """value as column, if that doesn't exist or holds nothing in any row; else the table as it is."""
    if column in df.columns and df.filter(F.trim(F.coalesce(F.col(column).cast("string"), F.lit(""))) != "").limit(1).count():
        return df
    return df.withColumn(column, value)


def flattened(records: DataFrame, paths: dict[str, list[str]]) -> DataFrame:
    """One column for each name, from the first of its paths that is filled: old and new layouts of nested records alike.
    Paths that a record's schema lacks are passed over."""
    def has(path: str) -> bool:
        kind = records.schema
        for part in path.split("."):
            if not isinstance(kind, T.StructType) or part not in kind.fieldNames():
                return False
            kind = kind[part].dataType
        return True

    out = []
    for name, ways in paths.items():
        found = [F.nullif(F.trim(F.col(w).cast("string")), F.lit("")) for w in ways if has(w)]
        out.append((F.coalesce(*found) if found else F.lit(None).cast("string")).alias(name))
    return records.select(*out)


def without_fields(df: DataFrame, array: str, prefix: str = "_") -> DataFrame:
    """The structs of an array column without the fields whose names begin with prefix."""
    inner = [f for f in df.schema[array].dataType.elementType.fieldNames() if f.startswith(prefix)]
    return df.withColumn(array, F.transform(array, lambda x: x.dropFields(*inner))) if inner else df


def find_column(df: DataFrame, candidates: list[str]) -> str | None:
    """A column by exact name, else ignoring case, else by a part of its name."""
    lower = {c.lower(): c for c in reversed(df.columns)}
    for test in (lambda c: c if c in df.columns else None, lambda c: lower.get(c.lower()), lambda c: next((x for x in df.columns if c.lower() in x.lower()), None)):
        for c in candidates:
            if hit := test(c):
                return hit
    return None


def plain_names(df: DataFrame, upper: bool = False) -> DataFrame:
    """'#{table.Column Name}' -> column_name (or COLUMN_NAME); a name that comes twice gets a number."""
    names: list[str] = []
    for c in df.columns:
        n = re.sub(r"^#?\{(?:[^.}]*\.)?(.*)\}$", r"\1", c.strip())
        n = re.sub(r"\W+", "_", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", n)).strip("_").lower()
        k, m = n, 2
        while k in names:
            k, m = f"{n}_{m}", m + 1
        names.append(k)
    return df.toDF(*[n.upper() if upper else n for n in names])


def trimmed(df: DataFrame) -> DataFrame:
    """All text columns without white space at their ends."""
    return df.withColumns({f.name: squeezed(F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)})


def with_lineage(df: DataFrame, source: str) -> DataFrame:
    return df.withColumns({"_extracted_at": F.current_timestamp(), "_source": F.lit(source)})


def view_all(spark: SparkSession, folder: str) -> list[str]:
    """Every Parquet table of a folder as a temporary view; their names."""
    found = []
    for p in files.matching(spark, f"{folder}/*.parquet"):
        name = p.rstrip("/").rsplit("/", 1)[-1].removesuffix(".parquet")
        spark.read.parquet(p).createOrReplaceTempView(name)
        found.append(name)
    return found
