"""Current dimensions kept up to date from the snapshots that changed.

The state of a dimension holds, per key, the best row of its two newest snapshot dates and whether older dates
have the key too. A run compares the files of every snapshot date with those of the last run and reads only the
dates that are new, reloaded or withdrawn: their rows leave the state, what they hold now is merged in, and the
second row takes the place of a first one that went. Only a key that lost both rows, and has older ones, is looked
up in its history again.

A version of the state is a folder of rows and one small file that names the snapshot files it has seen; the
file appears last, so a failed run leaves the version before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gondola.folders import Folder
from gondola.operators.latest import latest_per_key
from gondola.plans.sinks import date_folders
from gondola.schema import DATE

MORE = "_more"  # older dates have the key, too
Seen = dict[str, str]  # date -> digest of its files


def snapshot_files(spark: SparkSession, path: str) -> Seen:
    """A digest of the file names of every date. Every write of a date gives its files new names."""
    table = Folder(spark, path)
    dates = [d for d in date_folders(table) if d[:1].isdigit()]
    names = {d: [n for n in table.child(f"{DATE}={d}").children() if n[0] not in "._"] for d in dates}
    return {d: hashlib.sha256("\n".join(files).encode()).hexdigest() for d, files in names.items() if files}


def _dates(values: Sequence[str]) -> list[date]:
    return [date.fromisoformat(d) for d in values]


def _best_of_dates(snapshots: DataFrame, keys: Sequence[str], count: int) -> DataFrame:
    """The best row of each of the newest ``count`` dates of a key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(DATE).desc_nulls_last()))
    best = latest_per_key(snapshots, [*keys, DATE], [])
    return best.withColumn("_rank", rank).filter(F.col("_rank") <= count).drop("_rank")


def merged(state: DataFrame, fresh: DataFrame, keys: Sequence[str], changed: Sequence[date]) -> DataFrame:
    """The state after the rows of the changed dates went and ``fresh``, what those dates hold now, came.

    Two rows a key at most, with MORE. A key of which nothing is known any more, though older dates have it, comes as
    one row with a null date.
    """
    gone = F.col(DATE).isin(list(changed)) if changed else F.lit(False)
    rows = state.withColumn("_gone", gone).withColumn("_new", F.lit(False))
    rows = rows.unionByName(fresh.withColumns({MORE: F.lit(False), "_gone": F.lit(False), "_new": F.lit(True)}))
    key = Window.partitionBy(*keys)
    rows = rows.withColumns(
        {
            "_deep": F.max(MORE).over(key),
            "_floor": F.min(F.when(~F.col("_gone") & ~F.col("_new"), F.col(DATE))).over(key),
        }
    )
    # Older dates that the state does not hold lie under its oldest row: what is fresh counts from there on.
    sure = ~F.col("_gone") & (~F.col("_new") | ~F.col("_deep") | F.coalesce(F.col(DATE) >= F.col("_floor"), F.lit(False)))
    rows = rows.withColumn("_sure", sure)
    place = F.row_number().over(key.orderBy(F.col("_sure").desc(), F.col(DATE).desc_nulls_last()))
    rows = rows.withColumns(
        {"_place": place, "_present": F.count_if(~F.col("_gone")).over(key), "_known": F.count_if("_sure").over(key)}
    )
    lost = (F.col("_place") == 1) & (F.col("_known") == 0) & F.col("_deep")
    kept = rows.filter((F.col("_sure") & (F.col("_place") <= 2)) | lost)
    names = [*fresh.columns]
    unknown = F.col("_known") == 0
    return kept.select(
        *(F.when(~unknown, F.col(c)).alias(c) if c == DATE else F.col(c) for c in names),
        (F.col("_deep") | (F.col("_present") > F.least("_known", F.lit(2)))).alias(MORE),
    )


def _refilled(state: DataFrame, snapshots: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state with the lost keys looked up in the whole history."""
    lost = state.filter(F.col(DATE).isNull()).select(*(F.col(k).alias(f"_{k}") for k in keys))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    found = _best_of_dates(snapshots.join(lost, same, "left_semi"), keys, 3)
    nothing = state.limit(0)
    return state.filter(F.col(DATE).isNotNull()).unionByName(merged(nothing, found, keys, []))


def _version(folder: Folder) -> tuple[int, Seen]:
    versions = [n for n in folder.child("versions").children() if n.startswith("v") and n[1:].isdigit()]
    if not versions:
        return 0, {}
    lines = folder.child("versions", versions[-1]).read_text().splitlines()
    return int(versions[-1][1:]), dict(line.split("\t") for line in lines)


def maintain(
    spark: SparkSession, snapshots: str, schema: T.StructType, keys: Sequence[str], state_path: str, full: bool = False
) -> DataFrame:
    """The newest row per key of the snapshot table, like ``dims.current``, from the dates that changed.

    ``full`` forgets the state first.
    """
    folder, data = Folder(spark, state_path), lambda v: f"{state_path}/rows-{v:012d}"
    version, seen = _version(folder)
    stored = T.StructType([*schema.fields, T.StructField(MORE, T.BooleanType())])
    if full:
        seen = {}
    now = snapshot_files(spark, snapshots)
    changed = sorted(d for d in now.keys() | seen.keys() if now.get(d) != seen.get(d))
    if changed or not version:
        start = spark.read.schema(stored).parquet(data(version)) if seen else spark.createDataFrame([], stored)
        days = _dates(d for d in changed if d in now)
        read = spark.read.schema(schema).parquet(snapshots) if days else spark.createDataFrame([], schema)
        rows = merged(start, _best_of_dates(read.filter(F.col(DATE).isin(days)), keys, 3), keys, _dates(changed))
        Folder(spark, data(version + 1)).delete()  # of a run that failed
        rows.write.option("compression", "zstd").parquet(data(version + 1))
        written = spark.read.schema(stored).parquet(data(version + 1))
        if not written.filter(F.col(DATE).isNull()).isEmpty():
            history = spark.read.schema(schema).parquet(snapshots).filter(F.col(DATE).isin(_dates(now)))
            Folder(spark, data(version + 2)).delete()
            _refilled(written, history, keys).write.option("compression", "zstd").parquet(data(version + 2))
            version += 1
        text = "".join(f"{d}\t{digest}\n" for d, digest in sorted(now.items()))
        folder.child("versions", f"v{version + 1:012d}").write_text(text)
        version += 1
        for name in folder.children():
            if name.startswith("rows-") and int(name[5:]) < version:
                folder.child(name).delete()
        for name in folder.child("versions").children():
            if name[1:].isdigit() and int(name[1:]) < version:
                folder.child("versions", name).delete()
    rows = spark.read.schema(stored).parquet(data(version)).drop(MORE)
    return latest_per_key(rows, keys, [DATE])
