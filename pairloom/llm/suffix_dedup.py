"""Exact removal of repeated byte strings by a hash-compared suffix sort.

Every string of `size` bytes holds the same anchor wherever it stands: the least hash of its 20-byte substrings (winnowing).
Two exchanges decide what is removed:

1. Each chunk asks, for its distinct (anchor, surroundings), whether the same surroundings stand in a document
   with a smaller id (then all of it goes), and whether the anchor has other surroundings at all.
2. Where it has, the first document's surroundings are sent once, and the suffixes of all surroundings of an anchor are sorted
   by mergesort. Prefix polynomial hashes make the hash of any range two gathers, so two suffixes are compared
   by binary search for their common extension. Neighbours that seem to share `size` bytes are verified on the
   bytes; each class of equal strings learns its smallest document.

A string in any number of documents costs an exchange one entry a chunk, its surroundings one entry in all. The surroundings of an
anchor that has more than `split` of them are not sorted together: each of their strings goes to a bucket by its own hash, where equal
strings meet, so no task grows with what one anchor has. The first exchange compares by hashes of 48 bits of the anchor and 48
of the surroundings; the second, which judges single strings, verifies bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._exchange import Texts, answer, ask, by_bucket, filled, narrow, wide
from ._text import BYTE_VALUE, U64, mix, powers, prefix_hashes, range_hashes

SIZE, GRAM = 50, 20
SHIFTS = SIZE - GRAM + 1  # anchors of a string, and strings around an anchor
LEFT, RIGHT = SIZE - GRAM, SIZE
WIDE = LEFT + RIGHT
CHUNK_BYTES, BLOCK_BYTES, BUCKET_BYTES = 8 << 20, 1 << 20, 8 << 20
SPLIT = 1 << 14  # surroundings of an anchor that are sorted together at most


def _slide(x: np.ndarray, width: int, least) -> np.ndarray:
    """least (np.minimum or np.maximum) of each `width` neighbours, by doubling."""
    span = 1
    while span * 2 <= width:
        x = least(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return least(x[: len(x) - rest], x[rest:]) if rest else x


class Anchors:
    """Anchors of a chunk's texts with their surroundings, and the distinct ones by bucket."""

    def __init__(self, chunk, buckets: int):
        self.data, self.offsets = chunk.data, chunk.offsets
        parts = []
        at, n = 0, len(chunk.ids)
        while at < n:
            stop = max(at + 1, int(np.searchsorted(self.offsets, self.offsets[at] + BLOCK_BYTES, "right")) - 1)
            parts.append(self._block(at, min(stop, n), chunk.known))
            at = min(stop, n)
        self.doc, self.at, self.left, self.right, self.hash, around, self.own = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 4 + (np.zeros(0, U64),) * 3
        ids = chunk.ids[self.doc]
        _, one, self.which = np.unique(self.hash ^ mix(around), return_index=True, return_inverse=True)
        least = np.full(len(one), np.iinfo(np.int64).max)
        np.minimum.at(least, self.which, ids)
        order, self.cut = by_bucket(((self.hash[one] >> U64(48)) % U64(buckets)).astype(np.int64), buckets)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.which, self.one, self.first_id = place[self.which], one[order], least[order]
        self.around, self.ids = around, ids

    def _block(self, a: int, b: int, known: np.ndarray):
        base, end = int(self.offsets[a]), int(self.offsets[b])
        data, n = self.data[base:end], end - base
        nothing = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, U64),) * 3
        if n < SIZE:
            return nothing
        prefix = prefix_hashes(data)
        inverse = powers(n + 1, inverse=True)
        gram = mix((prefix[GRAM:] - prefix[:-GRAM]) * inverse[: n - GRAM + 1]) | U64(1)
        least = _slide(gram, SHIFTS, np.minimum)  # of each string
        inside = np.zeros(n + 1, np.int32)
        starts, ends = self.offsets[a:b] - base, self.offsets[a + 1 : b + 1] - base
        use = (ends - starts >= SIZE) & known[a:b]
        inside[starts[use]] += 1
        np.add.at(inside, ends[use] - SIZE + 1, -1)
        least[np.cumsum(inside[: len(least)]) <= 0] = 0
        padded = np.zeros(len(least) + 2 * (SHIFTS - 1), U64)
        padded[SHIFTS - 1 : SHIFTS - 1 + len(least)] = least
        at = np.flatnonzero(_slide(padded, SHIFTS, np.maximum)[: len(gram)] == gram)
        doc = np.searchsorted(self.offsets[a : b + 1] - base, at, "right") - 1
        left = np.minimum(at - starts[doc], LEFT)
        right = np.minimum(ends[doc] - at, RIGHT)
        around = range_hashes(prefix, at - left, at + right) + ((left << 8) + right).astype(U64)
        # bit o: the string that begins o bytes into the surroundings has this anchor as its least
        around_at = np.lib.stride_tricks.sliding_window_view(padded, SHIFTS)
        bits = np.zeros((len(at), 32), bool)
        bits[:, :SHIFTS] = around_at[at] == gram[at, None]
        own = np.packbits(bits, axis=1, bitorder="little").view("<u4")[:, 0].astype(U64)
        return doc + a, at + base, left, right, gram[at], around, own

    def surroundings(self, anchor: np.ndarray) -> np.ndarray:
        """(anchors x WIDE) bytes, the anchor at LEFT, zeros outside the text."""
        shift = np.arange(-LEFT, RIGHT)
        place = self.at[anchor][:, None] + shift
        out = self.data[np.clip(place, 0, len(self.data) - 1)]
        out[(shift < -self.left[anchor][:, None]) | (shift >= self.right[anchor][:, None])] = 0
        return out


def ask_anchors(buckets: int):
    def question(chunk):
        x = Anchors(chunk, buckets)
        for bucket, a, b in filled(x.cut):
            one = x.one[a:b]
            yield bucket, (narrow(x.hash[one]), narrow(mix(x.around[one])), x.first_id[a:b])

    return question


def reply_anchors(split: int):
    """For each: 1 if its surroundings stand in a document with a smaller id, plus 2 if the anchor has others, plus 4 if it has more than `split`."""

    def reply(payloads, _bucket):
        anchor, around, ids = wide([p[0] for p in payloads]), wide([p[1] for p in payloads]), np.concatenate([p[2] for p in payloads])
        order = np.lexsort((around, anchor))
        a, c = anchor[order], around[order]
        new_anchor = np.append(True, a[1:] != a[:-1])
        new = new_anchor | np.append(True, c[1:] != c[:-1])
        first = np.flatnonzero(new)
        smaller = np.minimum.reduceat(ids[order], first)[np.cumsum(new) - 1] < ids[order]
        kinds = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_anchor))[np.cumsum(new_anchor) - 1]
        out = np.empty(len(a), np.uint8)
        out[order] = smaller + 2 * (kinds > 1).astype(np.uint8) + 4 * (kinds > split).astype(np.uint8)
        return np.split(out, np.cumsum([len(p[2]) for p in payloads])[:-1])

    return reply


def _judged(x: Anchors, reply: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct anchor, bits of its strings, where each bucket begins) of what the second exchange is asked, by bucket."""
    plain, often = np.flatnonzero(reply == 2), np.flatnonzero(reply == 6)
    parts = [(plain, x.own[x.one[plain]], np.searchsorted(x.cut, plain, "right") - 1)]
    for o in range(SHIFTS if len(often) else 0):
        which = often[(x.own[x.one[often]] >> U64(o) & U64(1)).astype(bool)]
        strings = x.data[(x.at[x.one[which]] - LEFT + o)[:, None] + np.arange(SIZE)]
        bucket = mix((BYTE_VALUE[strings] * powers(SIZE)).sum(axis=1, dtype=U64)) % U64(buckets)
        parts.append((which, np.full(len(which), 1 << o, U64), bucket.astype(np.int64)))
    which, own, bucket = (np.concatenate(p) for p in zip(*parts))
    order, cut = by_bucket(bucket, buckets)
    return which[order], own[order], cut


def ask_surroundings(buckets: int):
    def question(chunk, replies):
        x = Anchors(chunk, buckets)
        which, own, cut = _judged(x, np.concatenate(replies) if replies else np.zeros(0, np.uint8), buckets)
        for bucket, a, b in filled(cut):
            one = x.one[which[a:b]]
            yield bucket, (narrow(x.hash[one]), x.left[one].astype(np.uint8), x.right[one].astype(np.uint8), x.surroundings(one), x.first_id[which[a:b]], own[a:b].astype(np.uint32))

    return question


class SuffixSort:
    """Mergesort of suffixes of one text within groups, comparing by prefix hashes; only `size` bytes count."""

    def __init__(self, text: np.ndarray, size: int):
        self.text, self.size = text, size
        self.prefix, self.inverse = prefix_hashes(text), powers(len(text) + 1, inverse=True)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes a and b, at most size, by binary search over hashes."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.size)
        for _ in range(self.size.bit_length()):
            middle = (low + high + 1) >> 1
            same = (self.prefix[a + middle] - self.prefix[a]) * self.inverse[a] == (self.prefix[b + middle] - self.prefix[b]) * self.inverse[b]
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def paired(self, suffixes: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Whether another suffix of the group has the same hash of `size` bytes; one without is a class of its own and needs no sorting."""
        key = mix((self.prefix[suffixes + self.size] - self.prefix[suffixes]) * self.inverse[suffixes] + group.astype(U64))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        out = np.zeros(len(key), bool)
        out[order[1:][same]] = True
        out[order[:-1][same]] = True
        return out

    def after(self, a: np.ndarray, b: np.ndarray, ties: bool) -> np.ndarray:
        """Whether suffix a sorts behind suffix b; equal ones as `ties` says."""
        n = self.common(a, b)
        equal = n >= self.size
        x, y = self.text[np.where(equal, a, a + n)], self.text[np.where(equal, b, b + n)]
        return np.where(equal, ties, x > y)

    def sort(self, suffixes: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of the suffixes by (group, bytes); group is ascending. Merges runs of 1, 2, 4, .. of each group, all at once."""
        n = len(suffixes)
        order = np.arange(n)
        begin = np.searchsorted(group, group, "left")
        stop = np.searchsorted(group, group, "right")
        most = int((stop - begin).max()) if n else 0
        width = 1
        while width < most:
            run = np.arange(n) - begin
            busy = np.flatnonzero(stop - begin > width)
            mine = run[busy] // width
            own = begin[busy] + mine * width
            right = (mine & 1).astype(bool)
            other = np.where(right, own - width, own + width)
            lo = np.minimum(other, stop[busy])
            hi = np.minimum(other + width, stop[busy])
            first = lo.copy()
            me = suffixes[order[busy]]
            while True:  # rank in the neighbour run: a left run's suffix goes before equal ones, a right run's behind
                open_ = np.flatnonzero(lo < hi)
                if not len(open_):
                    break
                middle = (lo[open_] + hi[open_]) >> 1
                there = suffixes[order[middle]]
                behind = np.empty(len(open_), bool)
                r = right[open_]
                behind[r] = self.after(me[open_][r], there[r], True)
                behind[~r] = self.after(me[open_][~r], there[~r], False)
                lo[open_] = np.where(behind, middle + 1, lo[open_])
                hi[open_] = np.where(behind, hi[open_], middle)
            target = np.where(right, own - width, own) + (busy - own) + (lo - first)
            merged = order.copy()
            merged[target] = order[busy]
            order = merged
            width *= 2
        return order

    def classes(self, suffixes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order, class number by order): suffixes of a class are in one group and equal in `size` bytes, as verified."""
        order = self.sort(suffixes, group)
        s, g = suffixes[order], group[order]
        new = np.ones(len(s), bool)
        near = np.flatnonzero(g[1:] == g[:-1]) + 1 if len(s) else np.zeros(0, np.int64)
        near = near[self.common(s[near - 1], s[near]) >= self.size]
        span = np.arange(self.size)
        for at in range(0, len(near), 1 << 16):
            part = near[at : at + (1 << 16)]
            new[part] = (self.text[s[part - 1][:, None] + span] != self.text[s[part][:, None] + span]).any(axis=1)
        return order, np.cumsum(new) - 1


def reply_surroundings(payloads, _bucket):
    """For each: bit o is set if the string that begins o bytes into the surroundings stands in a document with a smaller id."""
    anchor = wide([p[0] for p in payloads])
    left, right = (np.concatenate([p[i] for p in payloads]).astype(np.int64) for i in (1, 2))
    ids, own_strings = (np.concatenate([p[i] for p in payloads]) for i in (4, 5))
    out = np.zeros(len(anchor), np.uint32)
    order = np.argsort(anchor, kind="stable")
    if len(order):
        text = np.concatenate([p[3] for p in payloads])[order].ravel()
        suffixes = SuffixSort(text, SIZE)
        _, group = np.unique(anchor[order], return_inverse=True)
        for o in range(SHIFTS):
            whole = np.flatnonzero((o >= LEFT - left[order]) & (right[order] >= SIZE - LEFT + o) & (own_strings[order] >> np.uint32(o) & np.uint32(1)).astype(bool))
            whole = whole[suffixes.paired(whole * WIDE + o, group[whole])]
            if not len(whole):
                continue
            sorted_, of = suffixes.classes(whole * WIDE + o, group[whole])
            own = ids[order[whole[sorted_]]]
            begin = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            smaller = np.minimum.reduceat(own, begin)[of] < own
            out[order[whole[sorted_[smaller]]]] |= np.uint32(1 << o)
    return np.split(out, np.cumsum([len(p[4]) for p in payloads])[:-1])


def cut_chunk(element, buckets: int):
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of a chunk."""
    chunk, replies, masks = element
    x = Anchors(chunk, buckets)
    gone = np.zeros(len(x.data) + 1, np.int32)

    def remove(starts, ends):
        np.add.at(gone, starts, 1)
        np.add.at(gone, ends, -1)

    if len(x.one):
        reply = np.concatenate(replies)
        mask = np.zeros(len(reply), np.uint32)
        if masks:
            which, _, _ = _judged(x, reply, buckets)
            np.bitwise_or.at(mask, which, np.concatenate(masks))
        later = x.ids > x.first_id[x.which]
        whole = np.flatnonzero(later | (reply[x.which] & 1).astype(bool))
        remove(x.at[whole] - x.left[whole], x.at[whole] + x.right[whole])
        some = np.flatnonzero(~later & (mask[x.which] > 0))
        for o in range(SHIFTS):
            hit = some[(mask[x.which[some]] >> np.uint32(o) & np.uint32(1)).astype(bool)]
            remove(x.at[hit] - LEFT + o, x.at[hit] - LEFT + o + SIZE)
    removed = np.cumsum(gone[:-1]) > 0
    begins = removed.copy()
    begins[1:] &= ~removed[:-1]
    inner = x.offsets[1:-1]
    inner = inner[inner < len(removed)]
    begins[inner] = removed[inner]
    total, spans = (np.concatenate(([0], np.cumsum(m))) for m in (removed, begins))
    for i, (a, b) in enumerate(zip(x.offsets.tolist(), x.offsets[1:].tolist())):
        kept = x.data[a:b] if total[a] == total[b] else x.data[a:b][~removed[a:b]]
        yield int(chunk.ids[i]) if chunk.known[i] else None, b - a, int(total[b] - total[a]), int(spans[b] - spans[a]), kept.tobytes()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_bytes: bool = False, bucket_bytes: int = BUCKET_BYTES, split: int = SPLIT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept bytes if asked), one row per row of docs.

    Null texts are empty; texts under 50 bytes are kept. Rows that share a doc_id do not remove one another's
    bytes, a null doc_id neither removes nor loses any. Strings are judged on the input. Other columns are ignored; an
    empty table gives an empty result. Memory: a task holds a chunk of about 8 MB with its anchors, or a bucket: the anchors of about `bucket_bytes` of text.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = Texts(docs, CHUNK_BYTES)
    buckets = max(8, -(-texts.bytes // bucket_bytes))
    judged = answer(ask(texts.beside(), ask_anchors(buckets), buckets), texts, reply_anchors(split), 0)
    masks = answer(ask(texts.beside(judged), ask_surroundings(buckets), buckets), texts, reply_surroundings, 1)

    def rows(element):
        for doc_id, size, removed, spans, kept in cut_chunk(element, buckets):
            yield (doc_id, size, removed, spans, hashlib.sha256(kept).hexdigest(), *((kept,) if with_bytes else ()))

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_bytes else "")
    return docs.sparkSession.createDataFrame(texts.beside(judged, masks).flatMap(rows), schema, verifySchema=False)


#: Every 50-byte string of every document, in hexadecimal.
ORACLE = """with h as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
    starts as (select doc_id, p, substr(h, 2 * p - 1, 100) as s from h, unnest(range(1, length(h) // 2 - 48)) as r(p)),
    firsts as (select s, min(doc_id) as least from starts group by s having count(*) > 1),
    hit as (select doc_id, p, lag(p) over w as before, lead(p) over w as after from starts join firsts using (s) where least < doc_id window w as (partition by doc_id order by p)),
    runs as (select doc_id, p as a, lag(p) over (partition by doc_id order by p) as prior from hit where before is null or p - before > 50),
    stops as (select doc_id, p + 50 as z from hit where after is null or after - p > 50),
    removed as (select doc_id, sum(least(50, coalesce(after - p, 50))) as n_removed from hit group by doc_id),
    edges as (select doc_id, 1 as edge, true as opens from h union all select doc_id, z, true from stops union all select doc_id, a, false from runs union all select doc_id, length(h) // 2 + 1, false from h),
    pieces as (select doc_id, edge as a, lead(edge) over (partition by doc_id order by edge, opens desc) as z, opens from edges),
    kept as (select doc_id, string_agg(substr(h, 2 * a - 1, 2 * (z - a)), '' order by a) as k from pieces join h using (doc_id) where opens and z is not null group by doc_id)
    select doc_id, cast(length(h) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n, 0) as n_spans, sha256(unhex(coalesce(k, ''))) as kept_sha256
    from h left join removed using (doc_id) left join (select doc_id, count(*) as n from runs group by doc_id) using (doc_id) left join kept using (doc_id)"""
