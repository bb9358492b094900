"""New bronze price files to silver, as a stream."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gondola.folders import Folder
from gondola.operators import clean, integrity, silver
from gondola.plans.models import table_path
from gondola.plans.sinks import SUCCESS, upsert
from gondola.schema import DATE, STORE_KEYS, raw_schema, silver_schema
from gondola.session import scratch_dir
from gondola.sources.tables import DAY_PARTS

FACT_KEYS = (DATE, *STORE_KEYS, "id_producto")


def price_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Bronze price files under ``path`` (year=/month=/day=) as they arrive."""
    schema = raw_schema("productos")
    for part in DAY_PARTS:
        schema = schema.add(part, T.StringType())
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).withColumn(DATE, F.concat_ws("-", *DAY_PARTS).cast("date"))


def ledger_path(root: str, checkpoint: str) -> str:
    """Where the batches of a stream are recorded; a stream is known by its checkpoint."""
    return f"{root}/audit/stream/{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"


LEDGER = "lote long, leidas long, cargadas long, fecha_vigencia date, filas long"


def load_batch(batch: DataFrame, root: str, batch_id: int = 0, ledger: str | None = None) -> None:
    """One micro-batch into the silver fact: cleaned, checked against the stores, upserted.

    The upsert writes the batch and only the files that hold one of its keys, so late rows cost what they are. A
    batch that the ledger has is a replay and is left out; one that failed before its record was written is
    upserted again, which leaves the same rows. A later batch for a date adds to it instead of replacing it.
    Rows that repeat a key within a batch all stay, as in a daily load; the deduplicated quotes pick among them.
    """
    spark = batch.sparkSession
    record = f"{ledger}/lote={batch_id:09d}" if ledger else None
    if record and Folder(spark, f"{record}/{SUCCESS}").exists():
        return
    stores = (
        spark.read.schema(silver_schema("dim_sucursales"))
        .parquet(table_path(root, "dim_sucursales"))
        .select(DATE, *STORE_KEYS)
    )
    read, kept = Observation(f"read-{uuid.uuid4().hex}"), Observation(f"kept-{uuid.uuid4().hex}")
    rows = clean.clean_productos(batch.observe(read, F.count(F.lit(1)).alias("n")))
    typed = silver.to_silver_precios(silver.stamp(rows, scraped_at=silver.run_time()))
    matched = integrity.keep_matching(typed, stores, STORE_KEYS, spare_uncovered=True)
    stage = Folder(spark, scratch_dir(spark, "stream-batch"))
    try:
        matched.observe(kept, F.count(F.lit(1)).alias("n")).write.parquet(stage.path)  # computed once, counted once
        staged = spark.read.schema(matched.schema).parquet(stage.path)
        upsert(staged, table_path(root, "precios"), FACT_KEYS, "precios")
        if record:
            per_day = staged.groupBy(DATE).agg(F.count("*").alias("filas"))
            counts = [F.lit(batch_id).cast("long").alias("lote"), F.lit(read.get["n"]).alias("leidas"), F.lit(kept.get["n"]).alias("cargadas")]
            per_day.select(*counts, DATE, "filas").coalesce(1).write.mode("overwrite").parquet(record)
    finally:
        stage.delete()


def loaded_batches(spark: SparkSession, root: str, checkpoint: str) -> DataFrame:
    """Rows read and loaded by each batch of a stream, and per date."""
    folder = Folder(spark, ledger_path(root, checkpoint))
    names = [f"{folder.path}/{n}" for n in folder.children() if n.startswith("lote=")]
    return spark.read.schema(LEDGER).parquet(*names) if names else spark.createDataFrame([], LEDGER)


def stream_ingest(
    spark: SparkSession, path: str, root: str, checkpoint: str, files_per_trigger: int | None = None
) -> StreamingQuery:
    """Processes what has arrived and stops; run it again for what comes later."""
    ledger = ledger_path(root, checkpoint)
    return (
        price_stream(spark, path, files_per_trigger)
        .writeStream.foreachBatch(lambda batch, batch_id: load_batch(batch, root, batch_id, ledger))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
