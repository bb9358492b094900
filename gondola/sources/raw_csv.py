"""Pipe-delimited raw files to all-text frames.

Fields are split on the separator without quoting, a missing tail gives nulls,
surplus fields are dropped, undecodable bytes become the replacement character, and
"", "NULL" and "null" mean missing.
"""

from __future__ import annotations

import re
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.functions import blank_to_null
from gondola.schema import raw_columns

SEPARATOR = "|"
BOM = "﻿"


def clean_header(name: str) -> str:
    return name.lstrip(BOM).strip()


def read_raw_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Files that share one header line, columns named by it.

    Spark takes the column names from one file; a file with another header fails the
    read instead of mixing up columns. Use ``read_by_name`` for mixed headers.
    """
    df = (
        spark.read.option("sep", SEPARATOR)
        .option("header", True)
        .option("quote", "")
        .option("enforceSchema", False)
        .csv(paths)
    )
    named = df.toDF(*[clean_header(c) for c in df.columns])
    return named.select(*[blank_to_null(F.col(c)).alias(c) for c in named.columns])


def _split(line: Column) -> Column:
    return F.split(line, r"\|", -1)


def layout(header: str, table: str) -> list[int]:
    """Field index of each table column in a file with this header line, -1 when absent."""
    names = [clean_header(name) for name in header.split(SEPARATOR)]
    return [names.index(c) if c in names else -1 for c in raw_columns(table)]


def parse_lines(lines: DataFrame, table: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Data lines to the table's columns, matched by name through the layout of their file.

    ``lines``: layout (field index per table column), line. Absent columns become null,
    columns outside the contract are dropped. Files may order and omit columns as they
    like, all in one pass and without a read per header variant.
    """
    fields = lines.withColumn("_fields", _split(F.col("line")))

    def value(position: int, name: str) -> Column:
        text = F.get(F.col("_fields"), F.get(F.col("layout"), F.lit(position)))
        return blank_to_null(text).alias(name)

    return fields.select(*keep, *[value(i, name) for i, name in enumerate(raw_columns(table))])


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file that is not blank; None without one. Reads no further than that line."""
    jvm = spark._jvm
    hadoop = spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
    stream = where.getFileSystem(hadoop).open(where)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(hadoop).getCodec(where)
        content = codec.createInputStream(stream) if codec else stream
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(content, "UTF-8"))
        while (line := lines.readLine()) is not None:
            if line.strip():
                return line
        return None
    finally:
        stream.close()


def header_index(spark: SparkSession, files: list[str], threads: int = 32) -> dict[str, str]:
    """The header of every file that has one: one bounded read a file, many at a time."""
    with ThreadPoolExecutor(threads) as pool:
        found = pool.map(lambda path: first_line(spark, path), files)
        # The source writes a local file's address with one slash.
        return {re.sub("^file:///", "file:/", path): line for path, line in zip(files, found) if line is not None}


def read_by_name(spark: SparkSession, paths: str | list[str], table: str, keep_path: bool = False) -> DataFrame:
    """Files of one table with any mix of headers, aligned to its columns by name.

    The header is a file's first line that is not blank, whatever it says, and every later line is data.
    Headers are read first, a line a file. The data are one text scan that Spark splits as it likes: the
    source drops the header where a file starts, and each line is taken apart by the layout of its file. The
    commonest layout needs no lookup, the files of the others are literals of the plan. There is no
    Python worker and no shuffle, and one large file is read by many tasks.
    A file whose header names no column of the table raises ValueError; files without lines have no rows.
    """
    lines = (
        spark.read.schema("line string")
        .option("header", True)  # dropped at a file's start only, unread: the schema is given
        .option("lineSep", "\n")
        .option("sep", "\ufffe")  # a code point no text has: the line is one field
        .option("quote", "")
        .csv(paths)
    )
    layouts = {}
    for path, header in header_index(spark, lines.inputFiles()).items():
        layouts[path] = tuple(layout(header, table))
        if max(layouts[path]) < 0:
            raise ValueError(f"{path}: the first line names no column of {table}")
    by_use = [positions for positions, _ in Counter(layouts.values()).most_common()] or [tuple(range(len(raw_columns(table))))]
    path = F.col("_metadata.file_path")
    chosen = F.array(*map(F.lit, by_use[0]))
    for positions in by_use[1:]:
        files = [p for p, used in layouts.items() if used == positions]
        chosen = F.when(path.isin(files), F.array(*map(F.lit, positions))).otherwise(chosen)
    text = lines.select(path.alias("path"), chosen.alias("layout"), F.rtrim(F.col("line"), F.lit("\r")).alias("line"))
    text = text.filter(F.length(F.btrim("line", F.lit(" \t\r\n"))) > 0)
    return parse_lines(text, table, keep=("path",) if keep_path else ())
