"""Files in and out: document trees, record CSVs, JSON documents, the page cache."""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean, confidence

#: The CSV's headers and the columns they name, in order. The first is a running number.
HEADERS = {"项目名称": "project_name", "项目编号": "project_code", "标段编号": "lot_code", "标段名称": "lot_name", "企业名称": "company_name", "是否中标": "award_status", "排名": "rank", "资料类别": "category",
           "来源文件": "source_path", "来源页码": "source_pages", "提取方式": "extraction_method", "证据": "evidence", "置信度": "confidence", "复核状态": "review_status", "生成时间": "generated_at"}
NUMBER = "序号"


def document_tree(spark: SparkSession, folder: str, content: bool = False) -> DataFrame:
    """All PDF files below a folder, any case of the ending. Without content only names, times and lengths are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.[pP][dD][fF]").load(folder)
    return files if content else files.drop("content")


def content_hash(files: DataFrame) -> DataFrame:
    return files.withColumn("sha256", F.sha2("content", 256))


def read_pages(files: DataFrame, reader, schema: str) -> DataFrame:
    """Pages by an injected reader: a function from (path, bytes) to rows. A file that fails becomes one row with ``error``."""
    fields = T._parse_datatype_string(schema)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, data in zip(frame.path, frame.content, strict=True):
                try:
                    rows += list(reader(path, data))
                except Exception as problem:  # a broken file is data, not a failure of the job
                    rows.append({"doc_path": path, "error": f"{type(problem).__name__}: {problem}"})
            yield pd.DataFrame(rows, columns=fields.names)

    return files.select("path", "content").mapInPandas(run, fields)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records from a CSV with a byte order mark. A header that lacks a column is an error; texts are stripped, the confidence is held to 0..1."""
    raw = spark.read.csv(path, header=True, encoding="UTF-8", multiLine=True, escape='"')
    if missing := [h for h in HEADERS if h not in raw.columns]:
        raise ValueError(f"missing columns: {missing}")
    return raw.select(*[(confidence(F.col(h)) if name == "confidence" else clean(F.col(h))).alias(name) for h, name in HEADERS.items()])


def write_records(records: DataFrame, path: str, order: str = "ord") -> None:
    """One CSV file with byte order mark, header and running numbers, written row by row on the driver; the header even without rows.

    For results that people open; write_record_parts writes tables of any size.
    """
    with open(path, "w", encoding="utf-8-sig", newline="") as out:
        writer = csv.writer(out)
        writer.writerow([NUMBER, *HEADERS])
        for i, row in enumerate(records.orderBy(order).select(*HEADERS.values()).toLocalIterator(), 1):
            writer.writerow([i, *(f"{v:.4f}" if name == "confidence" else v or "" for name, v in zip(HEADERS.values(), row, strict=True))])


def write_record_parts(records: DataFrame, folder: str) -> None:
    """Records of any number as CSV parts in a folder for each category, written by the executors; headers as in write_records, without numbers."""
    names = {v: k for k, v in HEADERS.items()}
    out = records.select(F.col("category").alias("part"), *[(F.format_string("%.4f", v) if v == "confidence" else F.coalesce(F.col(v), F.lit(""))).alias(names[v]) for v in HEADERS.values()])
    out.write.mode("overwrite").partitionBy("part").option("header", True).option("escape", '"').csv(folder)


def write_by_category(records: DataFrame, folder: str, categories, order: str = "ord") -> None:
    """A CSV for each category, empty ones too."""
    for name in categories:
        write_records(records.where(F.col("category") == name), f"{folder}/{name}.csv", order)


def write_json(payload: dict, path: str) -> None:
    with open(path, "w", encoding="utf-8") as out:
        json.dump(payload, out, ensure_ascii=False, indent=2)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Documents of a known shape; one that doesn't fit is an error."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def cached(pages: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hits, misses) by file hash, page, resolution and profile."""
    key = ["sha256", "page_number", "dpi", "profile"]
    return pages.join(cache.dropDuplicates(key), key), pages.join(cache, key, "left_anti")


def add_to_cache(pages: DataFrame, path: str) -> None:
    """Append by the commit protocol: a failed job leaves nothing half written."""
    pages.write.mode("append").partitionBy("profile").parquet(path)


def to_csv_text(rows: list[tuple]) -> str:
    out = io.StringIO()
    csv.writer(out).writerows(rows)
    return out.getvalue()
