"""Which bronze folders are live: one small file per version, the highest version counts.

Data are written under ``<table>/commit=<id>/year=/month=/day=`` and never moved. A commit is the appearance
of the next version file, whatever number of days and tables it changes; readers list the live folders
of the version they find. Before that moment nothing a reader sees has changed, so a failed
write leaves every day as it was. One writer commits at a time; a second one finds its version taken and fails.
Folders that neither of the last two versions names are deleted, so a reader of the version before has its files.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from gondola.folders import Folder

Live = dict[tuple[str, str], str]  # (table, day folder) -> commit
_FILE = re.compile(r"v(\d{12})")


def _folder(spark: SparkSession, bronze: str) -> Folder:
    return Folder(spark, f"{bronze}/_manifests")


def _versions(spark: SparkSession, bronze: str) -> list[int]:
    names = map(_FILE.fullmatch, _folder(spark, bronze).children())
    return sorted(int(m[1]) for m in names if m)


def _read(spark: SparkSession, bronze: str, version: int) -> Live:
    lines = _folder(spark, bronze).child(f"v{version:012d}").read_text().splitlines()
    return {(table, day): commit for table, day, commit in (line.split("\t") for line in lines)}


def live(spark: SparkSession, bronze: str) -> Live | None:
    """The live folders; None where no version was ever written."""
    versions = _versions(spark, bronze)
    return _read(spark, bronze, versions[-1]) if versions else None


def live_paths(spark: SparkSession, path: str, first: str = "", last: str = "~") -> list[str] | None:
    """Folders of a table (``<bronze>/<table>``) with first <= day folder <= last; None without a manifest."""
    bronze, table = path.rstrip("/").rsplit("/", 1)
    found = live(spark, bronze)
    if found is None:
        return None
    return [f"{path}/commit={c}/{day}" for (t, day), c in sorted(found.items()) if t == table and first <= day <= last]


def commit(spark: SparkSession, bronze: str, changes: Live) -> Live:
    """Makes the changes live, all at once; returns what is live."""
    versions = _versions(spark, bronze)
    history = [_read(spark, bronze, v) for v in versions[-2:]]
    now = (history[-1] if history else {}) | changes
    version = versions[-1] + 1 if versions else 1
    text = "".join(f"{table}\t{day}\t{commit}\n" for (table, day), commit in sorted(now.items()))
    _folder(spark, bronze).child(f"v{version:012d}").write_text(text)
    if len(history) == 2:  # nothing below matters for what readers see
        for key, old in history[0].items():
            if old not in (history[1].get(key), now.get(key)):
                Folder(spark, f"{bronze}/{key[0]}/commit={old}").child(key[1]).delete()
    for old_version in versions[:-1]:
        _folder(spark, bronze).child(f"v{old_version:012d}").delete()
    return now
