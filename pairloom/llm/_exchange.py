"""Ask-and-answer exchange: chunks of documents ask keyed questions of the whole corpus and get the answers back.

A chunk (some MB of whole texts) sends a bucket one packed array of distinct keys, if it has any for it, so there are never more
messages than keys; a bucket sees the keys of all chunks, and replies to each in the order asked. Texts are dealt once by chunk; replies are dealt by the same
partitioner, so putting them beside their texts is a narrow union. Keys repeated within a chunk are sent once: a
key that all documents share costs a bucket one entry for each chunk. RDDs are used because the DataFrame API cannot
read the same shuffle files twice (statistics first, then replies) or keep texts in place
across such rounds. Lost files are made anew from the input by lineage.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 16 << 20


class Chunk:
    """Whole texts as one buffer; ids of None are kept apart in `known`."""

    def __init__(self, part: int, number: int, ids: list, texts: list):
        self.part, self.number = part, number
        self.known = np.array([i is not None for i in ids], bool)
        self.ids = np.array([i if i is not None else 0 for i in ids], np.int64)
        raw = [(t or "").encode() for t in texts]
        self.offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
        self.raw = b"".join(raw)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"raw": zlib.compress(self.raw, 1)}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state | {"raw": zlib.decompress(state["raw"])}

    @property
    def data(self) -> np.ndarray:
        return np.frombuffer(self.raw, np.uint8)


def _same(key: int) -> int:
    return key


class Texts:
    """The chunks of docs (doc_id, text), each in a partition of its own as far as `parts` goes; build makes a chunk of its rows."""

    def __init__(self, docs: DataFrame, size: int = CHUNK_BYTES, build: Callable = Chunk):
        def run(part: int, rows: Iterator) -> Iterator:
            ids, texts, held, number = [], [], 0, 0
            for doc_id, text in rows:
                ids.append(doc_id)
                texts.append(text)
                held += len(text or "") + 8
                if held >= size:
                    yield build(part, number, ids, texts)
                    ids, texts, held, number = [], [], 0, number + 1
            if ids:
                yield build(part, number, ids, texts)

        self.bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        rows = docs.rdd
        self.sources = rows.getNumPartitions()
        each = max(1, -(-3 * self.bytes // (2 * size * self.sources)))
        self.parts = self.sources * each
        key = lambda part, number: part * each + number % each
        self.dealt = rows.mapPartitionsWithIndex(run).map(lambda c: (key(c.part, c.number), (c.part, c.number, -1, 0, c))).partitionBy(self.parts, _same)
        self.key = key

    def beside(self, *answers: RDD) -> RDD:
        """(chunk, [replies of the buckets asked, in their order] for each of the answers)."""

        turns = range(len(answers))

        def gather(rows: Iterator) -> Iterator:
            chunks: dict[tuple, Chunk] = {}
            replies: dict[tuple, list] = {}
            for _, (part, number, turn, bucket, value) in rows:
                if turn < 0:
                    chunks[part, number] = value
                else:
                    replies.setdefault((part, number), [[] for _ in turns])[turn].append((bucket, value))
            for at in sorted(chunks):
                lists = replies.pop(at, [[] for _ in turns])
                yield (chunks.pop(at), *([out for _, out in sorted(x, key=lambda y: y[0])] for x in lists))

        return (self.dealt.context.union([self.dealt, *answers]) if answers else self.dealt).mapPartitions(gather)


def ask(elements: RDD, question: Callable, buckets: int) -> RDD:
    """(bucket, (part, number, payload)), one partition for each bucket. question(*element) gives (bucket, payload) of each bucket asked."""

    def run(rows: Iterator) -> Iterator:
        for element in rows:
            chunk = element[0]
            for bucket, payload in question(*element):
                yield bucket, (chunk.part, chunk.number, payload)

    return elements.mapPartitions(run).partitionBy(buckets, _same)


def statistics(asked: RDD, of_bucket: Callable) -> list:
    """of_bucket(payloads) of every bucket, on the driver: small things only."""

    def run(rows: Iterator) -> Iterator:
        if payloads := [v[2] for _, v in rows]:
            yield of_bucket(payloads)

    return asked.mapPartitions(run).collect()


def answer(asked: RDD, texts: Texts, reply: Callable, turn: int = 0) -> RDD:
    """The replies of all buckets, dealt as the texts are; reply(payloads, bucket) gives one reply for each payload.

    turn: the place of these answers among those put beside the texts.
    """
    key = texts.key

    def run(rows: Iterator) -> Iterator:
        rows = [(bucket, *v) for bucket, v in rows]
        rows.sort(key=lambda r: r[:3])
        if rows:
            for (bucket, part, number, _), out in zip(rows, reply([r[3] for r in rows], rows[0][0])):
                yield key(part, number), (part, number, turn, bucket, out)

    return asked.mapPartitions(run).partitionBy(texts.parts, _same)


def squeeze(raw: bytes) -> bytes:
    return pa.compress(raw, codec="zstd", asbytes=True)


def unsqueeze(raw: bytes, size: int) -> bytes:
    return pa.decompress(raw, decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def planes(x: np.ndarray) -> tuple[int, int, bytes]:
    """Whole numbers from 0 on, packed: their bytes plane by plane, the low ones first, up to the last that is not all zero."""
    width = max(1, -(-int(x.max()).bit_length() // 8)) if len(x) else 1
    x = x.astype(np.uint64 if width > 4 else np.uint32)
    return len(x), width, squeeze(b"".join((x >> x.dtype.type(8 * k)).astype(np.uint8).tobytes() for k in range(width)))


def counts(packed: tuple[int, int, bytes]) -> np.ndarray:
    n, width, raw = packed
    out = np.zeros((n, 8), np.uint8)
    for k, plane in enumerate(np.frombuffer(unsqueeze(raw, n * width), np.uint8).reshape(width, n)):
        out[:, k] = plane
    return out.view("<i8").reshape(n).astype(np.int64, copy=False)


def kinds(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of one of each value in ascending order, kind of each); where value and place fit one number, a plain sort of those, which is several times faster."""
    n = len(x)
    low = n.bit_length()
    if n and int(x.max()).bit_length() + low <= 63:
        mixed = np.sort(x.astype(np.int64) << low | np.arange(n))
        order, ranked = mixed & ((1 << low) - 1), mixed >> low
    else:
        order = np.argsort(x)
        ranked = x[order]
    new = np.ones(n, bool)
    new[1:] = ranked[1:] != ranked[:-1]
    kind = np.empty(n, np.int64)
    kind[order] = np.cumsum(new) - 1
    return order[new], kind


def filled(cut: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, begin, end) of the buckets that have rows; cut says where each begins."""
    return [(i, a, b) for i, (a, b) in enumerate(zip(cut.tolist(), cut[1:].tolist())) if b > a]


LOW = np.uint64((1 << 48) - 1)


def narrow(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The low 48 bits of hashes in six bytes each."""
    return (x & np.uint64(0xFFFFFFFF)).astype(np.uint32), (x >> np.uint64(32) & np.uint64(0xFFFF)).astype(np.uint16)


def wide(parts: list) -> np.ndarray:
    return np.concatenate([p[0] for p in parts]).astype(np.uint64) | np.concatenate([p[1] for p in parts]).astype(np.uint64) << np.uint64(32)


def by_bucket(bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(order that groups rows by bucket and keeps theirs, where each bucket begins)."""
    order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")  # 16 bits are sorted by radix
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))
