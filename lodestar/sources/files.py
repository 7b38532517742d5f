"""Sources and sinks: tables found by their headers, typed scans, JSON lines, guarded writes, hashes."""

from __future__ import annotations

import csv
import json
import posixpath
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Columns by which each raw table is known. Fixed values.
SIGNATURES: dict[str, frozenset[str]] = {
    "search": frozenset({"talentNo", "ks", "c0", "d0", "search_time", "empStr"}),
    "browse": frozenset({"organNo", "employeeNo", "dateIn", "talentNo"}),
    "apply": frozenset({"LogTitle", "empNo", "empName", "talentNo", "datein"}),
    "cities": frozenset({"CodeNo", "CodeNameA", "CodeNameB", "CodeNameC", "CodeType", "CodeArea", "CodeZip"}),
    "duties": frozenset({"CodeNo", "CodeNameA", "CodeNameB", "CodeNameC", "CodeDescript", "CodeAlike", "CodeDefinition", "CodeNameEN"}),
}


#: Columns of the table of jobs, by logical names. Fixed values.
JOB_COLUMNS: dict[str, str] = {
    "job_id": "職缺編號",
    "title": "職務名稱",
    "description": "職務內容",
    "salary_text": "薪資",
    "salary_min": "薪資下限",
    "salary_max": "薪資上限",
    "duty_major": "職務大類",
    "duty_middle": "職務中類",
    "duty_minor": "職務小類",
    "job_type": "職缺屬性",
    "work_hours": "工時",
    "work_hours_description": "工時說明",
    "location_code": "工作城市",
    "education": "學歷需求",
    "experience": "工作經驗需求",
    "computer_skills": "電腦技能資料",
    "certifications": "專業證照",
    "work_skills": "工作技能",
    "additional_requirements": "附加條件",
    "company_id": "廠商編號",
    "industry_major": "產業大類",
    "industry_middle": "產業中類",
    "industry_minor": "產業小類",
    "last_modified_at": "職缺最後修改時間",
}


def signatures(job_columns: Mapping[str, str] = JOB_COLUMNS) -> dict[str, frozenset[str]]:
    """All six tables."""
    return {**SIGNATURES, "jobs": frozenset(job_columns.values())}


def header(spark: SparkSession, path: str) -> list[str]:
    """The columns of a CSV file, without a byte order mark; an empty file is an error."""
    line = spark.read.text(path).limit(1).first()
    if line is None or not line.value.strip("﻿ "):
        raise ValueError(f"{path} is empty")
    return [c.strip() for c in next(csv.reader([line.value.lstrip("﻿")], skipinitialspace=True))]


def discover(spark: SparkSession, paths: list[str], signatures: Mapping[str, frozenset[str]] = SIGNATURES) -> dict[str, str]:
    """Which file is which table, by the columns that its header has; two files for one table are an error."""
    found: dict[str, str] = {}
    for path in sorted(paths):
        columns = set(header(spark, path))
        for name, signature in signatures.items():
            if signature <= columns:
                if name in found:
                    raise ValueError(f"{found[name]} and {path} are both {name}")
                found[name] = path
    missing = sorted(set(signatures) - set(found))
    if missing:
        raise ValueError(f"no file for {', '.join(missing)}")
    return found


def scan_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings; short rows are filled with nulls."""
    return spark.read.csv(path, header=True, inferSchema=False, mode="PERMISSIVE", multiLine=True, quote='"', escape='"')


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else scan_csv(spark, path)


def register_views(spark: SparkSession, tables: Mapping[str, str]) -> None:
    for name, path in tables.items():
        scan_csv(spark, path).createOrReplaceTempView(f"raw_{name}")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value) of text files, lines from 1. Large files are read in blocks; a line's number is its place in its block and
    the lines of the blocks before, of which only counts move."""
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    counts = rows.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("file", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("file", "_block").orderBy("_at"))
    return rows.withColumn("_place", place).join(starts, ["file", "_block"]).select("file", (F.col("_before") + F.col("_place")).alias("line"), "value")


def write_jsonl(df: DataFrame, path: str, overwrite: bool = False) -> None:
    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})).write.mode("overwrite" if overwrite else "error").text(path)


def listed(spark: SparkSession, folder: str, suffix: str = ".csv") -> list[tuple[str, int]]:
    """Paths and sizes of the files of a folder, wherever Spark can read it."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(folder)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [(f.getPath().toString(), f.getLen()) for f in files.listStatus(where) if f.isFile()]
    return sorted(f for f in found if f[0].lower().endswith(suffix))


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    held, where = _at(spark, path)
    return held.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """A file or a folder with all that it holds."""
    held, where = _at(spark, path)
    held.delete(where, True)


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """One small file, wherever Spark can write."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, overwrite)
    try:
        out.write(text.encode())
    finally:
        out.close()


def write_json(spark: SparkSession, path: str, value: object, overwrite: bool = False) -> None:
    write_text(spark, path, json.dumps(value, ensure_ascii=False, indent=2, default=str), overwrite)


def guard(target: str, inputs: list[str]) -> None:
    """Refuse to overwrite the root, an input, a folder that holds one, or a folder inside one."""
    norm = lambda p: posixpath.normpath(p.removeprefix("file:")).rstrip("/")
    t = norm(target)
    if not t or t == ".":
        raise ValueError("refusing to write to the root")
    for i in map(norm, inputs):
        if t == i or t.startswith(i + "/") or i.startswith(t + "/"):
            raise ValueError(f"{target} and the input {i} overlap")


def write_parquet(df: DataFrame, path: str, inputs: list[str], overwrite: bool = False, order: list[str] | None = None) -> None:
    """ZSTD Parquet, sorted within files if an order is given."""
    guard(path, inputs)
    (df.sortWithinPartitions(*order) if order else df).write.mode("overwrite" if overwrite else "error").option("compression", "zstd").parquet(path)


def write_csv(df: DataFrame, path: str, overwrite: bool = False) -> None:
    df.write.mode("overwrite" if overwrite else "error").option("header", True).csv(path)


#: Type names of the bulk loader's headers. Fixed values.
LOADER = {"boolean": "Bool", "int": "Long", "bigint": "Long", "double": "Double", "float": "Double"}


def loader_frame(df: DataFrame, kind: str) -> DataFrame:
    """Headers of a graph store's bulk loader: ~id, ~label, ~from, ~to and name:Type; nulls are empty."""
    marks = {"node_id": "~id", "edge_id": "~id", "label": "~label", "from_id": "~from", "to_id": "~to"}
    if kind not in ("node", "edge"):
        raise ValueError("kind is node or edge")
    cols = [F.coalesce(F.col(f.name).cast("string"), F.lit("")).alias(marks.get(f.name, f"{f.name}:{LOADER.get(f.dataType.simpleString(), 'String')}")) for f in df.schema]
    return df.select(*cols)


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def stable_hash(value: object) -> str:
    import hashlib

    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def load_yaml(text: str) -> dict:
    import yaml

    value = yaml.safe_load(text)
    if not isinstance(value, dict):
        raise ValueError("a mapping is wanted")
    return value
