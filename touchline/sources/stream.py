"""Streaming sources."""

from __future__ import annotations

import time as clock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_stream(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    schema: StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """A stream of any format on the class path.

    A broker: ``read_stream(spark, "kafka", **{"kafka.bootstrap.servers": ..., "subscribe": ...})``.
    Files: ``read_stream(spark, "parquet", folder, schema)``; ``pathGlobFilter`` picks some of them.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def replay(rows: DataFrame, time: str, path: str, fmt: str = "parquet", each: int = 1_000_000) -> None:
    """Write ``rows`` as they would have come: files of about ``each`` rows, one after another in ``time``.

    Rows of equal time share a file. Read with ``maxFilesPerTrigger`` 1, no row is older than one of a micro-batch
    before, so that a watermark drops none, and the state holds the windows that a file or two leave open, however
    many there are. File streams go by the files' times of modification, which are therefore set here.
    """
    spark = rows.sparkSession
    count = max(1, -(-rows.count() // each))
    ranges = rows.repartitionByRange(count, time)
    (ranges.select("value") if fmt == "text" else ranges).write.format(fmt).save(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # Names are numbered by range; a second apart, for file systems that keep no less.
    parts = sorted((f.getPath() for f in files.listStatus(folder) if f.getPath().getName().startswith("part-")), key=str)
    first = (int(clock.time()) - len(parts)) * 1000
    for i, part in enumerate(parts):
        files.setTimes(part, first + i * 1000, -1)
