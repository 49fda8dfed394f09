"""Exact top-k search over 64-bit binary codes by incremental multi-index hashing.

A code is cut into four 16-bit segments, each with its own table. Two codes at distance d
agree in some segment up to d // 4 bits (pigeonhole), so after the segments 0..j were searched at radius r
and the others at r - 1, every code within distance 4r + j has been seen. A query's radius grows segment by
segment until its kth verified distance is within what is covered: the result is exact.

Equal codes are one entry that keeps its k smallest ids (no more of them can be in any result). The table is
split into blocks of bounded size and the queries too; each pair of blocks is one unit of work.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._spark import cut

SEGMENTS, BITS = 4, 16
BLOCK, QUERY_BLOCK = 1 << 16, 512
U64 = np.uint64


def sign_code(embedding: str | Column) -> Column:
    """Bit i is set where component i is zero or more (null counts as less), for the first 64 components; null for a null or empty vector."""
    e = F.col(embedding) if isinstance(embedding, str) else embedding
    bits = F.transform(F.slice(e, 1, 64), lambda x, i: F.when(x >= 0, F.expr("1L")).otherwise(F.expr("0L")))
    packed = F.aggregate(F.zip_with(bits, F.transform(F.sequence(F.lit(0), F.size(bits) - 1), lambda i: i), lambda b, i: F.call_function("shiftleft", b, i)), F.expr("0L"), lambda a, b: a.bitwiseOR(b))
    return F.when(F.size(e) > 0, packed)


@functools.lru_cache(maxsize=BITS + 1)
def masks(radius: int) -> np.ndarray:
    every = np.arange(1 << BITS, dtype=np.uint32)
    return every[np.bitwise_count(every) == radius].astype(np.int64)


class MultiIndex:
    """The segment tables of a block of distinct codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order, self.first = [], []
        for s in range(SEGMENTS):
            part = self.segment(codes, s)
            self.order.append(np.argsort(part, kind="stable"))
            self.first.append(np.concatenate(([0], np.cumsum(np.bincount(part, minlength=1 << BITS)))))

    @staticmethod
    def segment(codes, s: int):
        return ((codes >> U64(BITS * s)) & U64((1 << BITS) - 1)).astype(np.int64)

    def search(self, code: np.uint64, k: int, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entries, distances) of every code up to the kth distance; copies: how many ids an entry stands for."""
        seen = np.zeros(len(self.codes), bool)
        entries, distances = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        within = np.zeros(65, np.int64)
        for radius in range(BITS + 1):
            for s in range(SEGMENTS):
                value = int(self.segment(code, s)) ^ masks(radius)
                a, n = self.first[s][value], np.diff(self.first[s])[value] if radius > 2 else self.first[s][value + 1] - self.first[s][value]
                total = int(n.sum())
                if total:
                    at = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(total)
                    found = self.order[s][at]
                    found = found[~seen[found]]
                    seen[found] = True
                    d = np.bitwise_count(self.codes[found] ^ code).astype(np.int64)
                    entries.append(found)
                    distances.append(d)
                    within += np.bincount(d, weights=copies[found], minlength=65).astype(np.int64)
                covered = SEGMENTS * radius + s
                if within[: covered + 1].sum() >= k:
                    break
            else:
                continue
            break
        found, d = np.concatenate(entries), np.concatenate(distances)
        enough = np.flatnonzero(np.cumsum(within) >= k)
        near = d <= (enough[0] if len(enough) else 64)
        return found[near], d[near]


_ROW = pa.schema([("query_id", pa.int64()), ("neighbor_id", pa.int64()), ("distance", pa.int32())])


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in batches:
            for row in piece.to_pylist():
                codes = np.frombuffer(row["codes"], np.int64).view(U64)
                sizes = np.frombuffer(row["sizes"], np.int64)
                ids, first = np.frombuffer(row["ids"], np.int64), np.concatenate(([0], np.cumsum(sizes)))
                index = MultiIndex(codes)
                out: tuple[list, list, list] = ([], [], [])
                for query, code in zip(row["query_ids"], row["query_codes"]):
                    entries, d = index.search(np.array(code, np.int64).view(U64)[()], k, sizes)
                    n = sizes[entries]
                    own = ids[np.arange(int(n.sum())) + np.repeat(first[entries] - (np.cumsum(n) - n), n)]
                    far = np.repeat(d, n)
                    best = np.lexsort((own, far))[:k]
                    out[0].extend([query] * len(best))
                    out[1].extend(own[best].tolist())
                    out[2].extend(far[best].tolist())
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, _ROW)], schema=_ROW)

    return run


_BLOCK = pa.schema([("block", pa.int32()), ("codes", pa.binary()), ("sizes", pa.binary()), ("ids", pa.binary())])


def _pack(table: pa.Table) -> pa.Table:
    ids = pa.concat_arrays(table.column("ids").chunks)
    raw = [np.asarray(x, dtype=np.int64).tobytes() for x in (table.column("code"), ids.value_lengths(), ids.flatten())]
    return pa.table([[table.column("block")[0].as_py()], *([r] for r in raw)], schema=_BLOCK)


def top_k(codes: DataFrame, queries: DataFrame, k: int = 10, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), neighbor_id, distance: the k nearest rows of `codes` (id, code), ties by smaller id.

    Rows with a null id or code are neither found nor queries; rows that repeat an id with one code count once, with several codes
    once for each; queries (id, code) with a repeated id and code are asked once. Fewer than k rows give as many as
    there are, an empty table none. A query that is itself in `codes` finds itself.
    """
    codes = codes.select("id", "code").where("id is not null and code is not null").distinct()
    least = codes.withColumn("n", F.row_number().over(Window.partitionBy("code").orderBy("id"))).where(F.col("n") <= k)
    entries = cut(least.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    queries = cut(queries.select("id", "code").where("id is not null and code is not null").distinct())
    n_blocks, n_query_blocks = max(1, -(-entries.count() // block)), max(1, -(-queries.count() // query_block))
    blocks = entries.withColumn("block", F.pmod(F.xxhash64("code"), F.lit(n_blocks)).cast("int")).groupBy("block").applyInArrow(_pack, "block int, codes binary, sizes binary, ids binary")
    asked = queries.groupBy(F.pmod(F.xxhash64("id"), F.lit(n_query_blocks)).cast("int").alias("q")).agg(F.collect_list(F.struct("id", "code")).alias("rows"))
    asked = asked.select("q", F.col("rows.id").alias("query_ids"), F.col("rows.code").alias("query_codes"))
    work = blocks.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(n_query_blocks - 1)))).join(asked.hint("shuffle_hash"), "q")
    found = work.select("codes", "sizes", "ids", "query_ids", "query_codes").mapInArrow(_search(k), "query_id long, neighbor_id long, distance int")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "neighbor_id"))
    return found.distinct().withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "neighbor_id", "distance")


ORACLE = """with e as (select vec_id as id, list_sum([case when embedding[i] >= 0 then (1::hugeint << (i - 1)) else 0::hugeint end for i in range(1, 65)])::hugeint as code from embeddings),
    p as (select q.id as query_id, e.id as neighbor_id, bit_count(xor(q.code, e.code))::int as distance from e as q, e where q.id % 50 = 0)
    select query_id, neighbor_id, distance, "rank" from (select *, row_number() over (partition by query_id order by distance, neighbor_id)::int as "rank" from p) where "rank" <= 10"""
