"""Nested archives: a master ZIP holds child ZIPs, each with three delimited files.

Masters come from Spark's ``binaryFile`` source (path, content). Python is only used
to open ZIP containers: masters are split to children, children are spread over the
cluster, and each task streams its members as bounded batches of text lines.
"""

from __future__ import annotations

import io
import lzma
import zipfile
import zlib
from collections.abc import Iterator
from fnmatch import fnmatch

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from gondola.schema import RAW_TABLES
from gondola.sources.raw_csv import layout, parse_lines

OK, MALFORMED = "ok", "malformed"
LINES_PER_BATCH = 20_000
_EMPTY_MASTER = "master"

_CHILDREN = pa.schema(
    [("package", pa.string()), ("child", pa.string()), ("ordinal", pa.int32()), ("content", pa.binary())]
)
_STATUS = pa.schema(
    [("package", pa.string()), ("child", pa.string()), ("ordinal", pa.int32()), ("status", pa.string())]
)
_LINES = pa.schema(
    [
        ("package", pa.string()),
        ("child", pa.string()),
        ("table", pa.string()),
        ("layout", pa.list_(pa.int32())),
        ("line_no", pa.int64()),
        ("line", pa.string()),
    ]
)


def read_masters(spark: SparkSession, paths: str | list[str], glob: str = "*.zip") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(paths)


def split_masters(masters: DataFrame, child_glob: str = "*.zip", spread: int | None = None) -> DataFrame:
    """One row per child ZIP, found at any depth of the master, spread by its name.

    A master that cannot be opened gives one child without content. ``spread`` is the
    number of tasks children go to, the session's shuffle partitions by default; given
    as a number it is kept, since small archives unpack to much larger text.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, content in _pairs(batches, "path", "content"):
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as master:
                    names = [n for n in master.namelist() if fnmatch(n.rsplit("/", 1)[-1], child_glob)]
                    for ordinal, name in enumerate(names):
                        yield _batch(_CHILDREN, [path], [name], [ordinal], [_content(master, name)])
            except _UNREADABLE:
                yield _batch(_CHILDREN, [path], [_EMPTY_MASTER], [0], [b""])

    children = masters.select("path", "content").mapInArrow(split, from_arrow_schema(_CHILDREN))
    tasks = spread or int(masters.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return children.repartition(tasks, "package", "child")


def _content(master: zipfile.ZipFile, name: str) -> bytes:
    """A child's bytes; none when the master is damaged there."""
    try:
        return master.read(name)
    except _UNREADABLE:
        return b""


def _pairs(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        columns = [batch.column(n) for n in names]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in columns)


def _batch(schema: pa.Schema, *columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


# What zipfile raises for damaged, truncated, encrypted or unsupported content.
_UNREADABLE = (zipfile.BadZipFile, zlib.error, lzma.LZMAError, EOFError, OSError, RuntimeError, ValueError)


def _open_child(content: bytes) -> tuple[zipfile.ZipFile | None, dict[str, str]]:
    """The archive and the readable member of each table; no archive when it is broken.

    A member counts only if it can be read to its end with the right checksum, so no line
    of a damaged one is handed on.
    """
    try:
        archive = zipfile.ZipFile(io.BytesIO(content))
        names = archive.namelist()
    except _UNREADABLE:
        return None, {}
    members = {}
    for table in RAW_TABLES:
        found = next((n for n in names if n.endswith(f"{table}.csv")), None)
        if found is not None and _intact(archive, found):
            members[table] = found
    return archive, members


def _intact(archive: zipfile.ZipFile, name: str) -> bool:
    try:
        with archive.open(name) as member:
            while member.read(1 << 20):
                pass
    except _UNREADABLE:
        return False
    return True


def child_status(children: DataFrame) -> DataFrame:
    """Whether each child opens and has all three tables, undamaged."""

    def status(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for package, child, ordinal, content in _pairs(batches, "package", "child", "ordinal", "content"):
            complete = len(_open_child(content)[1]) == len(RAW_TABLES)
            yield _batch(_STATUS, [package], [child], [ordinal], [OK if complete else MALFORMED])

    return children.mapInArrow(status, from_arrow_schema(_STATUS))


def member_lines(
    children: DataFrame, tables: tuple[str, ...] = RAW_TABLES, complete_only: bool = True
) -> DataFrame:
    """Data lines of the children with the column layout of their file.

    Children that lack a table are left out unless ``complete_only`` is off. Members are
    decoded as a stream and handed on in batches that may span children, so memory is
    one batch of lines.
    """

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple] = []
        for package, child, content in _pairs(batches, "package", "child", "content"):
            archive, members = _open_child(content)
            if archive is None or (complete_only and len(members) < len(RAW_TABLES)):
                continue
            with archive:
                for table in [t for t in tables if t in members]:
                    with archive.open(members[table]) as raw:
                        for numbered in _data_lines(raw, table):
                            pending.append((package, child, table, *numbered))
                            if len(pending) >= LINES_PER_BATCH:
                                yield _batch(_LINES, *zip(*pending))
                                pending = []
        if pending:
            yield _batch(_LINES, *zip(*pending))

    return children.select("package", "child", "content").mapInArrow(lines, from_arrow_schema(_LINES))


def _data_lines(raw, table: str) -> Iterator[tuple[list[int], int, str]]:
    """(layout, line number, line) of each data line of one member."""
    text = io.TextIOWrapper(raw, encoding="utf-8-sig", errors="replace")
    columns = layout(text.readline().rstrip("\n"), table)
    for number, line in enumerate(text, start=1):
        if line.strip():
            yield columns, number, line.rstrip("\n")


def table_rows(lines: DataFrame, table: str, keep: tuple[str, ...] = ("package", "child")) -> DataFrame:
    """Lines of one table as its raw columns, whatever the header of each child."""
    return parse_lines(lines.filter(F.col("table") == table), table, keep)
