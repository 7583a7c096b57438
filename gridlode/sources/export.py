"""Files for readers outside Spark, and their distributed counterparts."""

from __future__ import annotations

import csv
import datetime
import json
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlode.functions.values import json_text


def plain(value):
    """A value as JSON has it: rows as objects, dates in ISO form."""
    if hasattr(value, "asDict"):
        return {k: plain(v) for k, v in value.asDict().items()}
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def _opened(path: str):
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    return open(path, "w", encoding="utf-8", newline="")


def write_json(df: DataFrame, path: str) -> None:
    """One JSON array, written row by row."""
    with _opened(path) as out:
        out.write("[")
        for n, row in enumerate(df.toLocalIterator()):
            out.write((",\n" if n else "\n") + json.dumps(plain(row), ensure_ascii=False, indent=2))
        out.write("\n]\n" if out.tell() > 1 else "]\n")


def write_csv(df: DataFrame, path: str) -> None:
    """A header and rows, lists and objects as JSON; nothing at all for an empty table."""
    with _opened(path) as out:
        writer = None
        for row in df.toLocalIterator():
            if writer is None:
                writer = csv.writer(out)
                writer.writerow(df.columns)
            writer.writerow([json.dumps(plain(v), ensure_ascii=False) if isinstance(v, (list, dict)) or hasattr(v, "asDict") else plain(v) for v in row])


def write_review_csv(rows: DataFrame, path: str) -> None:
    """The review file; its header is always there."""
    from gridlode.operators.quality import review_rows

    found = review_rows(rows)
    with _opened(path) as out:
        writer = csv.writer(out)
        writer.writerow(found.columns)
        for row in found.toLocalIterator():
            writer.writerow(row)


def report_text(report: dict) -> str:
    return json.dumps(plain(report), ensure_ascii=False, indent=2)


def write_report(report: dict, path: str) -> None:
    with _opened(path) as out:
        out.write(report_text(report))


def payload(df: DataFrame, name: str = "payload") -> DataFrame:
    """df with a column that holds each row as compact JSON, nulls kept."""
    return df.withColumn(name, F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))


def json_lines(df: DataFrame, path: str) -> None:
    """The distributed form of write_json(), an object a line."""
    df.write.option("ignoreNullFields", "false").json(path)


def json_lists(df: DataFrame, path: str) -> None:
    """The distributed form of write_json(), a list a file: each task writes its rows as one JSON array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = "["
        for batch in batches:
            rows = [f"{',' if n or lead != '[' else lead}{text}" for n, text in enumerate(batch.column(0).to_pylist())]
            lead = "," if rows else lead
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if lead == "[" else "]"])], ["value"])

    payload(df, "_row").select("_row").mapInArrow(run, "value string").write.text(path)


def cell_text(name: str, kind: str) -> Column:
    """A nested value as JSON; lists have a space after each comma, as in write_csv()."""
    if not kind.startswith("array<") or kind.startswith(("array<array", "array<map", "array<struct")):
        return F.to_json(name)
    items = F.transform(name, lambda x: F.coalesce(json_text(x, kind[6:-1]), F.lit("null")))
    return F.when(F.col(name).isNotNull(), F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]")))


def csv_folder(df: DataFrame, path: str) -> None:
    """The distributed form of write_csv()."""
    nested = {c: kind for c, kind in df.dtypes if kind.startswith(("array", "map", "struct"))}
    df.select(*(cell_text(c, nested[c]).alias(c) if c in nested else F.col(c) for c in df.columns)).write.option("header", True).option("escape", '"').csv(path)
