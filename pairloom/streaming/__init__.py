"""Streaming forms of the log operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.logs import latest


def compact_log(stream: DataFrame, keys: list[str], order: list[str], path: str, checkpoint: str, buckets: int = 16) -> StreamingQuery:
    """Keeps the last record of each key in a Parquet table of versions, partitioned by a hash of the key.

    A batch is merged with the last version's buckets that it touches; the other buckets are carried over as they are. A version is
    written whole before its number is the greatest, so a batch that is run again gives the same table; versions before the
    last are removed once the new one stands. Read the table with `compacted`.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        jvm = spark.sparkContext._jvm
        where = lambda n: f"{path}/v{n}"
        system = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        exists = lambda n: system.exists(jvm.org.apache.hadoop.fs.Path(f"{where(n)}/_SUCCESS"))
        rows = batch.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).persist()
        try:
            touched = [r[0] for r in rows.select("bucket").distinct().collect()]
            if number and exists(number - 1):
                old = spark.read.schema(rows.schema).parquet(where(number - 1))
                new = latest(rows.unionByName(old.where(F.col("bucket").isin(touched))), ["bucket", *keys], order).select(rows.columns)
                new = new.unionByName(old.where(~F.col("bucket").isin(touched)))
            else:
                new = latest(rows, ["bucket", *keys], order).select(rows.columns)
            new.write.mode("overwrite").partitionBy("bucket").parquet(where(number))
        finally:
            rows.unpersist()
        for old_number in range(number - 2, max(-1, number - 8), -1):  # the last but one stays for a batch that is run again
            system.delete(jvm.org.apache.hadoop.fs.Path(where(old_number)), True)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def compacted(spark, path: str) -> DataFrame:
    """The greatest whole version of a compacted table."""
    jvm = spark.sparkContext._jvm
    system = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath().getName() for s in system.listStatus(jvm.org.apache.hadoop.fs.Path(path))]
    whole = [int(n[1:]) for n in found if n[:1] == "v" and n[1:].isdigit() and system.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return spark.read.parquet(f"{path}/v{max(whole)}").drop("bucket")


def day_counts(stream: DataFrame, time: str, late: str = "10 days") -> DataFrame:
    """day, n: counts per day as a time window, so that the watermark closes days and drops their state (append mode works)."""
    stream = stream.withColumn(time, F.col(time).cast("timestamp"))
    return stream.withWatermark(time, late).groupBy(F.window(time, "1 day")).agg(F.count("*").alias("n")).select(F.col("window.start").alias("day"), "n")


def month_counts(days: DataFrame, months: int = 3, day: str = "day", n: str = "n") -> DataFrame:
    """window_start, n: sums per calendar window of `months` months of closed days (a table of `day_counts`)."""
    month = F.trunc(F.col(day), "month")
    start = F.add_months(month, -F.pmod(F.month(month) - 1, F.lit(months))).cast("timestamp")
    return days.groupBy(start.alias("window_start")).agg(F.sum(n).alias("n"))
