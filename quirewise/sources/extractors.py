"""Extractors: files to pages and blocks. The renderer is the caller's; plain text is read here."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BLOCKS = "source string, page_index int, ordinal int, text string"


class Extractor(ABC):
    """One file's bytes to its pages: lists of blocks of text."""

    @abstractmethod
    def pages(self, content: bytes) -> Iterator[list[str]]: ...


class PlainText(Extractor):
    """UTF-8 text: a form feed ends a page, a blank line a block."""

    def pages(self, content: bytes) -> Iterator[list[str]]:
        for page in content.decode("utf-8", "replace").split("\f"):
            yield [b for b in page.split("\n\n") if b.strip()]


def extracted(files: DataFrame, extractor: Extractor) -> DataFrame:
    """Blocks (source, page_index, ordinal, text) of files (source, content). A page without blocks has one row with a null text, so every page is there;
    a null content has no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for source, content in zip(batch.column("source").to_pylist(), batch.column("content").to_pylist()):
                for n, blocks in enumerate(extractor.pages(content)) if content is not None else ():
                    rows += [(source, n, k, b) for k, b in enumerate(blocks)] or [(source, n, 0, None)]
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.int32(), pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, ["source", "page_index", "ordinal", "text"])

    return files.select("source", "content").mapInArrow(run, BLOCKS)


def page_evidence(blocks: DataFrame, low: int = 40) -> DataFrame:
    """(source, page_index, blocks, chars, quality, warning): by page the characters, min(1, chars / 1000) and a warning below `low` of them."""
    chars = F.sum(F.coalesce(F.length("text"), F.lit(0))).cast("bigint")
    x = blocks.groupBy("source", "page_index").agg(F.count("text").alias("blocks"), chars.alias("chars"))
    return x.select("*", F.round(F.least(F.lit(1.0), F.col("chars") / 1000.0), 6).alias("quality"), F.when(F.col("chars") < low, "low_text_page").alias("warning"))


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, folder: str, most_files: int):
        self.folder, self.most_files = folder, most_files

    def partitions(self) -> list[_File]:
        from pathlib import Path

        found = sorted(str(p) for p in Path(self.folder).rglob("*.txt") if p.is_file() and not p.is_symlink())
        if len(found) > self.most_files:
            raise ValueError(f"{len(found)} files; the limit is {self.most_files}")
        return [_File(p) for p in found]

    def read(self, partition: _File) -> Iterator[tuple]:
        with open(partition.path, "rb") as f:
            for n, blocks in enumerate(PlainText().pages(f.read())):
                for k, b in enumerate(blocks):
                    yield partition.path, n, k, b


class PagedText(DataSource):
    """spark.dataSource.register(PagedText); spark.read.format("paged_text").option("path", folder): blocks of the text files below a mounted folder, one
    partition a file."""

    @classmethod
    def name(cls) -> str:
        return "paged_text"

    def schema(self) -> str:
        return BLOCKS

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], int(self.options.get("most_files", 10_000)))
