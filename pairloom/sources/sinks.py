"""Sinks: tables with provenance headers and sidecars, merges, bounded chunks."""

from __future__ import annotations

import hashlib
import json
import os
import platform
import sys
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, header: dict[str, str], order: list[str]) -> str:
    """One sorted csv file with # key=value lines before the header row; for published tables of modest size.

    Rows stream through the driver one partition at a time; nothing is held.
    """
    import csv

    temporary = f"{path}.part"
    with open(temporary, "w", encoding="utf-8", newline="") as f:
        for k, v in header.items():
            f.write(f"# {k}={v}\n")
        out = csv.writer(f)
        out.writerow(df.columns)
        for row in df.orderBy(*order).toLocalIterator():
            out.writerow(["" if v is None else v for v in row])
    os.replace(temporary, path)
    return path


def provenance(inputs: list[str]) -> dict:
    """What a sidecar states: the inputs with sizes and hashes, the arguments and the versions."""

    def describe(p: str) -> dict:
        h = hashlib.sha256()
        with open(p, "rb") as f:
            while block := f.read(1 << 20):
                h.update(block)
        return {"path": p, "bytes": os.path.getsize(p), "sha256": h.hexdigest()}

    import pyspark

    return {"written": datetime.now(timezone.utc).isoformat(timespec="seconds"), "inputs": [describe(p) for p in inputs], "argv": sys.argv, "python": platform.python_version(), "pyspark": pyspark.__version__}


def write_sidecar(path: str, record: dict) -> str:
    """path.provenance.json, replaced in one step."""
    target = f"{path}.provenance.json"
    with open(f"{target}.part", "w", encoding="utf-8") as f:
        json.dump(record, f, indent=2, default=str)
    os.replace(f"{target}.part", target)
    return target


def write_table(df: DataFrame, path: str, rows_per_file: int | None = None, partition_by: list[str] | None = None) -> None:
    out = df.write.mode("overwrite")
    if rows_per_file:
        out = out.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        out = out.partitionBy(*partition_by)
    out.parquet(path)


def merge_codes(old: DataFrame, new: DataFrame, a: str = "acc_a", b: str = "acc_b", codes: str = "codes") -> DataFrame:
    """Old and new rows as one per unordered pair, with the sorted union of their comma lists; no self pairs."""
    both = old.unionByName(new).where(F.col(a) != F.col(b))
    each = both.select(F.least(a, b).alias(a), F.greatest(a, b).alias(b), F.explode(F.split(codes, ",")).alias("code")).where("code <> ''")
    return each.groupBy(a, b).agg(F.array_join(F.sort_array(F.collect_set("code")), ",").alias(codes))


def chunked_requests(rows: DataFrame, key: str, size: str, most_bytes: int, most_rows: int, shards: int = 64) -> DataFrame:
    """Adds shard and chunk: rows of a shard in order of the key, a chunk closed before a row would pass either limit.

    A row above the byte limit is a chunk of its own. Rows of size 0 or null carry no request: they take the chunk that is
    open and count for neither limit. Each shard is cut greedily over its sorted rows, which stream through in Arrow batches, so a task
    holds one batch and four numbers.
    """
    import pyarrow as pa

    names = rows.columns
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", shard int, chunk int"
    place = names.index(size)

    def run(batches):
        shard = chunk = held = count = None
        for piece in batches:
            out = []
            for s, n in zip(piece.column(len(names)).to_pylist(), piece.column(place).to_pylist()):
                if s != shard:
                    shard, chunk, held, count = s, 0, 0, 0
                if n:
                    if count and (count >= most_rows or held + n > most_bytes):
                        chunk, held, count = chunk + 1, 0, 0
                    held, count = held + n, count + 1
                out.append(chunk)
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(out, pa.int32())], names=[*names, "shard", "chunk"])

    sharded = rows.withColumn("shard", F.pmod(F.xxhash64(key), F.lit(shards)).cast("int"))
    rest = [c for c in names if c != key]
    return sharded.repartition(shards, "shard").sortWithinPartitions("shard", key, *rest[:1]).mapInArrow(run, schema)


def with_metadata(df: DataFrame, metadata: dict[str, dict[str, str]]) -> DataFrame:
    """Columns with key-value metadata, which Spark keeps in the Parquet footer and gives back in the schema."""
    return df.select(*(F.col(c).alias(c, metadata=metadata[c]) if c in metadata else F.col(c) for c in df.columns))


def dated_name(prefix: str, date: str, suffix: str) -> str:
    """The name that readers.latest_version finds."""
    return f"{prefix}{date}{suffix}"


def fingerprint(values: dict) -> str:
    """Twelve hex digits that change with any value that affects an answer."""
    return hashlib.sha256(json.dumps(values, sort_keys=True, default=str).encode()).hexdigest()[:12]


def bind_run(folder: str, settings: dict) -> dict:
    """A run folder's manifest: written once, in one step; an error if it was written for other settings."""
    path = os.path.join(folder, "manifest.json")
    new = {"fingerprint": fingerprint(settings), "settings": settings}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            old = json.load(f)
        if old["fingerprint"] != new["fingerprint"]:
            raise ValueError(f"{folder} belongs to run {old['fingerprint']}, not {new['fingerprint']}")
        return old
    os.makedirs(folder, exist_ok=True)
    with open(f"{path}.part", "w", encoding="utf-8") as f:
        json.dump(new, f, indent=2, default=str)
    os.replace(f"{path}.part", path)
    return new
