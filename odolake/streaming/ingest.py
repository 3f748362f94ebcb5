"""Incremental layer refresh: each run takes only what no earlier run has taken.

A layer is a folder with ``batches``, one folder of files per attempt at a batch, and ``manifests``, one small file per
finished batch that names its folder. A batch is there when its manifest is, so readers see whole batches only, on any
file system on which a single file appears at once; no folder is renamed. What a failed attempt leaves is named nowhere.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery


def new_files(spark: SparkSession, path: str, fmt: str, schema, archive: str | None = None, **options) -> DataFrame:
    """File stream over a folder. With ``archive`` the files of finished batches move there."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path)


def _files(spark: SparkSession, path: str):
    """Hadoop file system and path: small files are read and written by the driver through Spark's own settings."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def _manifest(target: str, batch_id: int) -> str:
    return f"{target.rstrip('/')}/manifests/{batch_id:012d}.json"


def published(spark: SparkSession, target: str, batch_id: int) -> bool:
    files, path = _files(spark, _manifest(target, batch_id))
    return files.exists(path)


def publish(result: DataFrame, target: str, batch_id: int) -> None:
    """Write a batch and then its manifest. A batch that has its manifest stays as it is."""
    spark = result.sparkSession
    if published(spark, target, batch_id):
        return
    folder = f"batches/batch={batch_id}-{uuid.uuid4().hex}"
    result.write.parquet(f"{target.rstrip('/')}/{folder}")
    # A name with a leading dot is read by nobody; giving one file its final name is a single step.
    final = _manifest(target, batch_id)
    files, pending = _files(spark, f"{target.rstrip('/')}/manifests/.{uuid.uuid4().hex}")
    out = files.create(pending, True)
    out.write(bytearray((json.dumps({"batch": batch_id, "folder": folder}) + "\n").encode()))
    out.close()
    if not files.rename(pending, spark._jvm.org.apache.hadoop.fs.Path(final)):
        if not published(spark, target, batch_id):
            raise OSError(f"manifest {final} could not be written")


def _opened(spark: SparkSession, target: str, lines: list[str], schema) -> DataFrame:
    folders = [f"{target.rstrip('/')}/{json.loads(line)['folder']}" for line in sorted(lines)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def _schema(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_batches(spark: SparkSession, target: str, schema: str | T.StructType | None = None) -> DataFrame:
    """All finished batches of a layer; an empty table if there is none and ``schema`` is given.

    The driver reads one line per batch.
    """
    files, folder = _files(spark, f"{target.rstrip('/')}/manifests")
    lines: list[str] = []
    if files.exists(folder):
        lines = [r.value for r in spark.read.text(folder.toString()).collect()]
    if schema is None and lines:
        schema = spark.read.parquet(f"{target.rstrip('/')}/{json.loads(max(lines))['folder']}").schema
    return _opened(spark, target, lines, _schema(schema))


def new_batches(spark: SparkSession, target: str) -> DataFrame:
    """Stream of the manifests of a layer, for ``refresh`` with ``layer``."""
    files, folder = _files(spark, f"{target.rstrip('/')}/manifests")
    files.mkdirs(folder)  # the layer may have no batch yet
    return new_files(spark, f"{target.rstrip('/')}/manifests", "text", "value string", pathGlobFilter="*.json")


def refresh(
    stream: DataFrame,
    outputs: dict[str, Callable[[DataFrame], DataFrame]],
    checkpoint: str,
    layer: tuple[str, str | T.StructType] | None = None,
) -> StreamingQuery:
    """Process all that is new with batch functions; ``outputs`` maps a target layer to its function.

    ``stream`` is a stream of files, or of the manifests of a layer (``new_batches``); then ``layer`` gives the folder and
    schema of that layer, and functions get the rows of its new batches. A batch that is run again after a failure keeps
    the outputs that have their manifest, which the next layer may have read already, and writes the others. Targets
    belong to one checkpoint: with a new checkpoint, start with new targets.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        open_outputs = {t: f for t, f in outputs.items() if not published(spark, t, batch_id)}
        if layer is not None:
            folder, schema = layer
            batch = _opened(spark, folder, [r.value for r in batch.collect()], _schema(schema))
        keep = len(open_outputs) > 1
        if keep:
            batch = batch.persist()
        try:
            for target, transform in open_outputs.items():
                publish(transform(batch), target, batch_id)
        finally:
            if keep:
                batch.unpersist()

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
