"""Sources and sinks: bounded binary scans, OCR tables, batch plans, create-once artifacts."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirewise.storage import commit_exclusively, hadoop_path

# The twelve columns of an OCR table, and the fields of a batch plan.
OCR_COLUMNS = "level int, page_num int, block_num int, par_num int, line_num int, word_num int, left int, top int, width int, height int, conf double, text string"
PLAN = "schema_version int, items array<struct<source_id:string,pdf_path:string,output_directory:string,sha256:string,byte_size:bigint,locator:string>>"


def binary_files(spark: SparkSession, folder: str, pattern: str = "*.pdf", most_bytes: int = 512_000_000, most_files: int = 10_000) -> DataFrame:
    """(path, byte_size, sha256, has_header) of the files below a folder. A file above most_bytes or more than most_files raise
    an error, none is dropped."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    count, large, one = files.select(F.count("path"), F.count(F.when(F.col("length") > most_bytes, 1)), F.min(F.when(F.col("length") > most_bytes, F.col("path")))).first()
    if count > most_files:
        raise ValueError(f"{count} files; the limit is {most_files}")
    if large:
        raise ValueError(f"{large} files above {most_bytes} bytes, among them {one}")
    return files.select("path", F.col("length").alias("byte_size"), F.sha2("content", 256).alias("sha256"), (F.hex(F.substring("content", 1, 5)) == "255044462D").alias("has_header"))


def ocr_table(spark: SparkSession, path: str) -> DataFrame:
    """Words of OCR tables (level 5, not blank), read by a fixed schema; a row that doesn't fit raises an error."""
    rows = spark.read.option("sep", "\t").option("header", "true").option("mode", "FAILFAST").option("quote", "").schema(OCR_COLUMNS).csv(path)
    return rows.where((F.col("level") == 5) & (F.trim("text") != ""))


def ocr_lines(words: DataFrame) -> DataFrame:
    """Lines of OCR words: joined text, box around them, the mean confidence if every word has one (-1 counts as none)."""
    conf = F.when(F.col("conf") >= 0, F.col("conf"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word_num", "text"))), lambda x: x["text"]), " ")
    return words.groupBy("page_num", "block_num", "par_num", "line_num").agg(
        text.alias("text"), F.min("left").alias("x0"), F.min("top").alias("y0"), F.max(F.col("left") + F.col("width")).alias("x1"), F.max(F.col("top") + F.col("height")).alias("y1"),
        F.when(F.count(conf) == F.count("*"), F.avg(conf)).alias("confidence"),
    )


def batch_plan(spark: SparkSession, path: str, most: int = 256) -> DataFrame:
    """Items of batch plans: strict JSON, at most `most` items a plan, ids and paths unique; anything else raises an error."""
    plans = spark.read.option("mode", "FAILFAST").option("multiLine", "true").schema(PLAN).json(path)
    sized = plans.select(F.when(F.size("items") <= most, F.col("items")).otherwise(F.raise_error(F.lit("too many items in a plan"))).alias("items"))
    items = sized.select(F.explode("items").alias("x")).select("x.*")
    twice = items.groupBy("source_id").count().where("count > 1").union(items.groupBy("pdf_path").count().where("count > 1"))
    if twice.limit(1).count():
        raise ValueError("source_id and pdf_path must be unique")
    return items


def publish_once(df: DataFrame, path: str) -> str:
    """Publish artifacts unless they are there: `created`, or `unchanged` if the same rows are; other rows raise an error.

    The rows are written to a folder of their own below path, then `current.json` names it in one exclusive step: a crash leaves nothing that a
    reader or the next call sees, and of two publishers that race the second compares itself with the first.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    current, fs = hadoop_path(spark, f"{path}/current.json")
    if not fs.exists(current):
        part = f"data-{uuid.uuid4().hex}"
        df.write.parquet(f"{path}/{part}")
        if commit_exclusively(spark, f"{path}/{part}/manifest.json", f"{path}/current.json", json.dumps({"data": part})):
            return "created"
        fs.delete(hadoop_path(spark, f"{path}/{part}")[0], True)
    old = published(spark, path).select(*df.columns)
    if df.exceptAll(old).limit(1).count() or old.exceptAll(df).limit(1).count():
        raise ValueError(f"{path} holds other rows")
    return "unchanged"


def published(spark: SparkSession, path: str) -> DataFrame:
    """The rows that `publish_once` has published at path."""
    named = json.loads(spark.read.text(f"{path.rstrip('/')}/current.json").first().value)
    return spark.read.option("pathGlobFilter", "*.parquet").parquet(f"{path.rstrip('/')}/{named['data']}")


def schema_problems(df: DataFrame, expected: dict[str, str]) -> list[str]:
    """What a table lacks to be ready: columns that are missing or of another type. Looks at metadata only."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return sorted([f"missing {c}" for c in expected if c not in have] + [f"type of {c}: {have[c]}" for c, t in expected.items() if c in have and have[c] != t])
