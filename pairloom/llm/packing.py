"""Best-fit-decreasing packing of token sequences into fixed windows.

Overlong documents are first cut into full windows. The remainders of a task are
taken in decreasing length; a segment tree over remaining capacities finds the tightest
open window that still takes one, in log2(window) steps. Tasks pack on their own, so there is no
shuffle. A task tokenises some MB of text at a time and emits full windows at once; of a remainder it keeps five numbers and,
where the ids are part of the result, the ids in one flat buffer. What is kept is packed and emitted whenever it
reaches `held_ids` ids or HELD_ROWS remainders, so a task's memory does not grow with its partition.

Tokens come from a byte-level BPE. Splitting a text before a single space that follows a visible
character never changes its tokens, so a chunk's distinct pieces are tokenised once and its ids gathered.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import batch, chunks
from ._text import flat, prefix_hashes, range_hashes

WINDOW = 1024
END_ID = 0
_CHUNK = 2 << 20
#: Remainders that are packed together at most, and ids of theirs; ids in a record batch.
HELD_ROWS, HELD_IDS, BATCH_IDS = 1 << 18, 8 << 20, 1 << 18
#: The pre-tokenizer's published pattern (fixed value).
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class WindowTree:
    """Open windows by remaining capacity; `best(n)` gives the tightest one with room for n."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, which: int) -> None:
        self.open[capacity].append(which)
        node = capacity + self.size
        while node:
            self.count[node] += 1
            node >>= 1

    def best(self, need: int) -> tuple[int, int] | None:
        """(window, its capacity), removed from the tree; None if none has room."""
        node = need + self.size
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node <<= 1
                if not self.count[node]:
                    node += 1
        capacity = node - self.size
        which = self.open[capacity].pop()
        while node:
            self.count[node] -= 1
            node >>= 1
        return which, capacity


def best_fit_decreasing(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(window number, offset in it) of each item; every length is 1..window."""
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, made = WindowTree(window), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        if found := tree.best(n):
            which, room = found
        else:
            which, room, made = made, window, made + 1
        where[i], offset[i] = which, window - room
        if room > n:
            tree.add(room - n, which)
    return where, offset


@functools.lru_cache(maxsize=4)
def _encoder(path: str):
    """(whole-text tokenizer, fast encoder of ordinary text or None, bytes per id, special strings)."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    spec = json.load(open(path, encoding="utf-8"))
    special = [t["content"].encode() for t in spec.get("added_tokens", [])]
    byte_level = lambda x: bool(x) and x.get("type") == "ByteLevel" and not x.get("add_prefix_space")
    model = spec["model"]
    if model.get("type") != "BPE" or not byte_level(spec.get("pre_tokenizer")) or spec.get("normalizer") or model.get("dropout") or model.get("end_of_word_suffix"):
        return whole, None, None, special
    import tiktoken

    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    to_byte = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    added = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(to_byte[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
    order = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if order != sorted(order):  # ids don't follow the merges
        return whole, None, None, special
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, i in ranks.items():
        sizes[i] = len(token)
    return whole, tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes, special


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start .. start+length-1 of each range, one after another."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


def token_ids(data: np.ndarray, offsets: np.ndarray, path: str, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """(ids, first): ids of each text followed by end_id; special tokens in a text count as such."""
    whole, fast, sizes, special = _encoder(path)
    n = len(offsets) - 1
    raw = data.tobytes()
    odd: dict[int, np.ndarray] = {}
    if fast is None:
        odd = dict.fromkeys(range(n))
    for mark in special:
        at = raw.find(mark)
        while at >= 0:
            odd[int(np.searchsorted(offsets, at, "right")) - 1] = None
            at = raw.find(mark, at + 1)
    for i in odd:
        odd[i] = np.array(whole.encode(raw[offsets[i] : offsets[i + 1]].decode(), add_special_tokens=False).ids, np.uint32)
    lengths = np.diff(offsets)
    easy = lengths > 0
    easy[list(odd)] = False
    # ASCII visible, or the second byte of a letter of U+00C0..U+00FF
    visible = (data > 32) & (data < 127)
    visible[1:] |= (data[1:] >= 128) & (data[:-1] == 0xC3)
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (data[1:] == 32) & visible[:-1]
    texts = np.flatnonzero(easy)
    cut[offsets[:-1][lengths > 0]] = True
    starts = np.flatnonzero(cut[:-1])
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    text = np.searchsorted(offsets, starts, "right") - 1
    mine = easy[text]
    starts, ends, text = starts[mine], ends[mine], text[mine]
    key = range_hashes(prefix_hashes(data), starts, ends) ^ (ends - starts).astype(np.uint64)
    _, one, which = np.unique(key, return_index=True, return_inverse=True)
    a, b = starts[one], ends[one]
    plain = (data[a] == 32) & visible[b - 1] if len(one) else np.zeros(0, bool)
    tokens, at, count = [], np.zeros(len(one), np.int64), np.zeros(len(one), np.int64)
    inner = np.flatnonzero(plain)
    made = 0
    if len(inner):
        joined = data[_spread(a[inner], b[inner] - a[inner])].tobytes().decode()
        ids = np.asarray(fast.encode_to_numpy(joined, disallowed_special=()), np.uint32)
        token_at = np.cumsum(sizes[ids]) - sizes[ids]
        bounds = np.searchsorted(token_at, np.concatenate(([0], np.cumsum(b[inner] - a[inner]))))
        at[inner], count[inner] = bounds[:-1], np.diff(bounds)
        tokens.append(ids)
        made = len(ids)
    for i in np.flatnonzero(~plain).tolist():
        ids = fast.encode_ordinary(raw[a[i] : b[i]].decode())
        at[i], count[i] = made, len(ids)
        tokens.append(np.array(ids, np.uint32))
        made += len(ids)
    pool = np.concatenate(tokens) if tokens else np.zeros(0, np.uint32)
    per_piece = count[which] if len(which) else count
    totals = np.bincount(text, weights=per_piece, minlength=n).astype(np.int64) if len(text) else np.zeros(n, np.int64)
    for i, ids in odd.items():
        totals[i] = len(ids)
    first = np.concatenate(([0], np.cumsum(totals + 1)))
    out = np.full(int(first[-1]), end_id, np.uint32)
    if len(texts):
        out[_spread(first[texts], totals[texts])] = pool[_spread(at[which], per_piece)]
    for i, ids in odd.items():
        out[first[i] : first[i] + len(ids)] = ids
    return out, first


def _rows_at(columns: list, rows: np.ndarray) -> list:
    return [c.take(pa.array(rows)) if isinstance(c, pa.Array) else c[rows] for c in columns]


def _batches(schema: pa.Schema, columns: list, ids: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Record batches of the rows; where the schema has ids, row i has ids[at[i] : at[i] + length]."""
    length, low = columns[2], 0
    ends = np.cumsum(length)
    while low < len(length):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + BATCH_IDS, "right")))
        part = [c.slice(low, high - low) if isinstance(c, pa.Array) else c[low:high] for c in columns]
        if len(schema) > len(columns):
            own = ids[_spread(at[low:high], length[low:high])].view(np.int32)
            part.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(length[low:high]))), pa.int32()), pa.array(own)))
        yield batch(schema, *part)
        low = high


class _Remainders:
    """What is left of documents behind their full windows: flat columns, and one buffer of ids where they are asked for."""

    def __init__(self, with_ids: bool, most_ids: int = HELD_IDS):
        self.with_ids, self.most_ids = with_ids, most_ids
        self.clear()

    def clear(self) -> None:
        self.rows, self.ids, self.n, self.n_ids = [], [], 0, 0

    def add(self, rows: list, ids: np.ndarray, at: np.ndarray) -> None:
        self.rows.append(rows)
        self.n += len(at)
        self.n_ids += int(rows[2].sum())
        if self.with_ids:
            self.ids.append(ids[_spread(at, rows[2])])

    def full(self) -> bool:
        return self.n >= HELD_ROWS or self.with_ids and self.n_ids >= self.most_ids

    def packed(self, window: int, first: int) -> tuple[int, list, np.ndarray, np.ndarray]:
        """(windows made, columns in order of the windows, ids, where each row's ids begin); nothing is held then."""
        if not self.n:
            return 0, [pa.array([], pa.int64()), *[np.zeros(0, np.int64)] * 6], np.zeros(0, np.uint32), np.zeros(0, np.int64)
        rows = [pa.concat_arrays(x) if isinstance(x[0], pa.Array) else np.concatenate(x) for x in zip(*self.rows)]
        ids = np.concatenate(self.ids) if self.with_ids else np.zeros(0, np.uint32)
        self.clear()
        which, offset = best_fit_decreasing(rows[2], window)
        order = np.lexsort((offset, which))
        at = (np.cumsum(rows[2]) - rows[2])[order]
        return int(which.max()) + 1, [*_rows_at(rows, order), first + which[order], offset[order]], ids, at


_ROW = pa.schema([(k, pa.int64()) for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False, held_ids: int = HELD_IDS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids if asked).

    Each document's ids, closed by end_id, are cut into full windows and one remainder; a full window is a sequence
    of its own, remainders share sequences. A null or empty text is the single id end_id. Rows that
    share a doc_id (or have a null one) are packed as separate documents. Within a sequence offsets have
    no gaps; what is left behind the last piece is padding. Other columns of docs are ignored.
    """
    schema = pa.schema([*_ROW, ("ids", pa.list_(pa.int32()))]) if with_ids else _ROW

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 40, 0
        left = _Remainders(with_ids, held_ids)
        for piece in chunks(batches, size=_CHUNK):
            ids, first = token_ids(*flat(piece.column(1)), tokenizer, end_id)
            sizes = np.diff(first)
            pieces = -(-sizes // window)
            doc = np.repeat(np.arange(len(sizes)), pieces)
            start = _spread(np.zeros(len(sizes), np.int64), pieces) * window
            length = np.minimum(window, sizes[doc] - start)
            at = first[doc] + start
            raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
            crc = np.fromiter((zlib.crc32(raw[4 * x : 4 * (x + y)]) for x, y in zip(at.tolist(), length.tolist())), np.int64, len(doc))
            full = length == window
            n = int(full.sum())
            rows = [piece.column(0).take(pa.array(doc)), start, length, crc, sizes[doc]]
            yield from _batches(schema, [*_rows_at(rows, np.flatnonzero(full)), base + made + np.arange(n), np.zeros(n, np.int64)], ids, at[full])
            made += n
            left.add(_rows_at(rows, np.flatnonzero(~full)), ids, at[~full])
            if left.full():
                more, columns, held, where = left.packed(window, base + made)
                made += more
                yield from _batches(schema, columns, held, where)
        more, columns, held, where = left.packed(window, base + made)
        yield from _batches(schema, columns, held, where)

    out = ", ".join(f"`{f.name}` long" for f in _ROW) + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, out)
