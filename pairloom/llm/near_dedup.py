"""MinHash near-duplicate detection with SuperMinHash signatures.

Shingle sets of five words are sketched by SuperMinHash: element e proposes, in round
j, the value j + r(e, j) for one slot of its own random permutation, so the slots of
one element hold correlated ranks (0.., 1.., 2..) and the estimate varies less than
with independent hashes. A document stops as soon as every slot is below the next
round's values; long documents stop after one or two rounds.

Banding finds candidates, which are confirmed on the full shingle sets. Documents with the same words in the same order
(by sha256) collapse to one representative first. Links are found in two steps: every
member of a bucket is compared with the bucket's smallest member; the components so far are
joined by union-find; then only members of a bucket that still lie in different components are compared.
That comparison is exact: each member keeps how its full set differs from the bucket's smallest member, and the difference
of two members is the symmetric difference of those two small sets. Parity sketches spare most of the work without losing a link:
the bits in which two sets' sketches differ are never more than the elements in which the sets do. It is a join condition,
so only links become rows, and a bucket is dealt over several keys by its size.

Frequent bands: their statistics are combined on the map side and then over SALTS keys, so that no task reads a row of every
partition for one band. In the joins on bands and nodes a frequent key has one row on the other side; Spark's adaptive skew
handling splits such keys. Frequent texts never meet in one task: their first documents are joined by digest and id, and their classes are broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import batch, chunks, cut, int_lists
from ._text import LOWER, SPACE, U64, flat, mix, owner, words
from .components import connected_components

SHINGLE = 5
SLOTS = 100
#: 64-bit words of a parity sketch; keys that a frequent band's statistics go through; members of a bucket that are a key of their own.
PARITY_WORDS, SALTS, GROUP = 8, 16, 512
#: Texts that more than one in OFTEN documents share are at most OFTEN: their classes are broadcast.
OFTEN = 1000
_STEP = U64(0x9E3779B97F4A7C15)


def shingle_sets(found: tuple, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): sorted distinct shingle hashes of each text, one text after another, from what `words` gives."""
    _, _, hashes, first = found
    counts = np.diff(first)
    m = max(0, len(hashes) - size + 1)
    rolled = np.zeros(m, U64)
    for i in range(size):
        rolled *= _STEP
        rolled += hashes[i : i + m]
    rolled = mix(rolled)
    sets = []
    for at, n in zip(first[:-1].tolist(), counts.tolist()):
        if n >= size:
            own = np.sort(rolled[at : at + n - size + 1])
            sets.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif n:
            whole = U64(n)
            for h in hashes[at : at + n]:
                whole = U64((int(whole) * int(_STEP) + int(h)) & 0xFFFFFFFFFFFFFFFF)
            sets.append(mix(np.array([whole], U64)))
        else:
            sets.append(np.zeros(0, U64))
    lengths = np.fromiter((len(s) for s in sets), np.int64, len(sets))
    return (np.concatenate(sets) if sets else np.zeros(0, U64)), np.concatenate(([0], np.cumsum(lengths)))


def superminhash(values: np.ndarray, first: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Signatures (texts x slots): round number in the high 32 bits, rank within it in the low."""
    n = len(first) - 1
    none = U64(0xFFFFFFFFFFFFFFFF)
    signature = np.full(n * slots, none, U64)
    doc = owner(first)

    def draw(elements: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray]:
        x = mix(elements + U64((j + 1) * int(_STEP) & 0xFFFFFFFFFFFFFFFF))
        return (x >> U64(32)) | U64(j << 32), ((x & U64(0xFFFFFFFF)) * U64(slots - j) >> U64(32)).astype(np.int64) + j

    rank, slot = draw(values, 0)
    np.minimum.at(signature, doc * slots + slot, rank)
    highest = signature.reshape(n, slots).max(axis=1) if n else np.zeros(0, U64)
    alive = (highest >= U64(1 << 32)) & (np.diff(first) > 0)
    mine = alive[doc]
    values, doc = values[mine], doc[mine]
    order = np.tile(np.arange(slots, dtype=np.uint8), (len(values), 1))
    for j in range(slots):
        if not len(values):
            break
        at = np.arange(len(values))
        rank, k = draw(values, j)
        here, there = order[at, j], order[at, k]
        order[at, k] = here
        order[:, j] = there
        if j:
            np.minimum.at(signature, doc * slots + there, rank)
            done = signature.reshape(n, slots).max(axis=1) < U64((j + 1) << 32)
            keep = ~done[doc]
            if not keep.all():
                values, doc, order = values[keep], doc[keep], order[keep]
    return signature.reshape(n, slots)


def rows_for(percent: int, slots: int = SLOTS, miss: float = 1e-5) -> int:
    """The most rows a band may have so that a pair at the threshold is missed by all bands in at most `miss` of cases."""
    return max([1, *(r for r in range(2, 20) if (1 - (percent / 100) ** r) ** (slots // r) <= miss)])


def band_keys(signature: np.ndarray, rows: int = 5) -> np.ndarray:
    """(texts x bands) 64-bit keys; the band's number is part of the key."""
    n, slots = signature.shape
    bands = slots // rows
    keys = np.tile(np.arange(bands, dtype=U64), (n, 1))
    for i in range(rows):
        keys *= _STEP
        keys += signature[:, i : bands * rows : rows]
        keys = mix(keys)
    return keys


def parities(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(texts x PARITY_WORDS) 64-bit words: each element flips one of their bits."""
    n, bits = len(first) - 1, 64 * PARITY_WORDS
    flipped = np.bincount(owner(first) * bits + (mix(values ^ U64(3)) % U64(bits)).astype(np.int64), minlength=n * bits) & 1
    return np.packbits(flipped.astype(np.uint8).reshape(n, bits), axis=1, bitorder="little").view("<u8").reshape(n, PARITY_WORDS)


def digests(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> list[bytes]:
    """sha256 of each text's lower-cased words with a space between."""
    lower, cut = LOWER[data], np.zeros(len(data) + 1, np.int32)
    np.add.at(cut, starts, 1)
    np.add.at(cut, ends, -1)
    keep = np.cumsum(cut[:-1]) > 0
    after = ends[ends < len(data)]
    gap = after[SPACE[data[after]]]
    lower[gap], keep[gap] = 32, True
    at = np.concatenate(([0], np.cumsum(keep)))[offsets]
    raw = lower[keep].tobytes()
    return [hashlib.sha256(raw[a:b].rstrip(b" ")).digest() for a, b in zip(at.tolist(), at[1:].tolist())]


_SKETCH = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64())), ("parity", pa.list_(pa.int64()))])
_SETS = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("items", pa.list_(pa.int64()))])


def _sketch(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches):
            data, offsets = flat(piece.column(1))
            found = words(data, offsets)
            values, first = shingle_sets(found)
            lists = [int_lists(x.ravel(), np.arange(len(x) + 1) * x.shape[1]) for x in (band_keys(superminhash(values, first), rows), parities(values, first))]
            yield batch(_SKETCH, piece.column(0), np.diff(first), digests(data, offsets, found[0], found[1], found[3]), *lists)

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in chunks(batches):
        data, offsets = flat(piece.column(1))
        found = words(data, offsets)
        values, first = shingle_sets(found)
        yield batch(_SETS, piece.column(0), digests(data, offsets, found[0], found[1], found[3]), int_lists(values, first))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of pairs (u, v) whose full sets reach the similarity."""
    left, right = sets.select(F.col("doc_id").alias("u"), F.col("items").alias("x")), sets.select(F.col("doc_id").alias("v"), F.col("items").alias("y"))
    both = pairs.join(left, "u").join(right, "v").select("u", "v", F.size("x").alias("nx"), F.size("y").alias("ny"), F.size(F.array_intersect("x", "y")).alias("both"))
    return both.where(F.col("both") * 100 >= (F.col("nx") + F.col("ny") - F.col("both")) * percent).select("u", "v")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of `docs`.

    Null and empty texts (or texts without words) have the empty set: linked with nothing, component of their own. Texts
    of one to four words have one shingle, their whole word sequence. Rows that share a doc_id are one document, whose
    text with the least digest (of those with words) stands for all in comparisons; each row counts its own shingles. A null doc_id is never linked: component_id is null and kept is true. Other columns of docs are ignored.
    Memory: a task holds about one MB of text and one sketch per document of it.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketch = cut(docs.mapInArrow(_sketch(rows_for(percent)), "doc_id long, n long, digest binary, bands array<long>, parity array<long>"))
    full = sketch.where("n > 0 and doc_id is not null")
    chosen = full.groupBy("doc_id").agg(F.min("digest").alias("digest"))
    same = chosen.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    reps = full.join(same.select("digest", F.col("rep").alias("doc_id")), ["digest", "doc_id"]).select(F.col("doc_id").alias("rep"), "n", "bands", "parity").dropDuplicates(["rep"])
    postings = reps.select("rep", "n", F.explode("bands").alias("band"))
    members = cut(postings.join(_pivots(postings), "band"))
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    every = docs.join(wanted, "doc_id", "left_semi").mapInArrow(_sets, "doc_id long, digest binary, items array<long>").where("size(items) > 0")
    sets = cut(every.groupBy("doc_id").agg(F.min_by("items", "digest").alias("items")))
    stars = members.where("rep > pivot").groupBy("rep").agg(F.min("pivot").alias("v")).withColumnRenamed("rep", "u")
    links = cut(_confirm(stars, sets, percent))
    found = connected_components(links)
    more = _between(members, found, sets, reps.select("rep", "parity"), percent)
    final = connected_components(links.unionByName(more))
    often = F.col("copies") * OFTEN > chosen.agg(F.count("*")).scalar()
    class_of = lambda texts: texts.join(final, texts.rep == final.node, "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    frequent = same.where(often)
    rare = chosen.join(F.broadcast(frequent.select("digest")), "digest", "left_anti").join(class_of(same.where(~often)), "digest")
    classes = chosen.join(F.broadcast(class_of(frequent)), "digest").unionByName(rare)
    linked = full.select("doc_id", F.col("n").alias("n_shingles")).join(classes.select("doc_id", "component_id"), "doc_id")
    alone = sketch.where("n = 0 or doc_id is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _pivots(postings: DataFrame) -> DataFrame:
    """band, pivot: the smallest member of each band that has several."""
    salted = postings.groupBy("band", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).alias("salt")).agg(F.min("rep").alias("pivot"), F.count("*").alias("size"))
    return salted.groupBy("band").agg(F.min("pivot").alias("pivot"), F.sum("size").alias("size")).where("size > 1").select("band", "pivot")


def _between(members: DataFrame, found: DataFrame, sets: DataFrame, parity: DataFrame, percent: int) -> DataFrame:
    """(u, v): the links between members of a bucket that the components `found` so far keep apart."""
    known = members.join(found, members.rep == found.node, "left").select("band", "pivot", "rep", "n", F.coalesce("component", "rep").alias("c"))
    spread = known.groupBy("band", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).alias("salt")).agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
    apart = spread.groupBy("band").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo < hi").select("band")
    open_ = cut(known.join(apart, "band").select("pivot", "rep", "n", "c").distinct())
    items = [sets.select(F.col("doc_id").alias(k), F.col("items").alias(f"{k}_items")) for k in ("rep", "pivot")]
    unlike = F.array_union(F.array_except("rep_items", "pivot_items"), F.array_except("pivot_items", "rep_items"))
    parts = open_.groupBy("pivot").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts"))
    rows = open_.join(parts, "pivot").join(items[0], "rep").join(items[1], "pivot").select("pivot", "parts", "rep", "n", "c", unlike.alias("unlike"))
    rows = cut(rows.join(parity, "rep"))
    columns = lambda side, end: [F.col("rep").alias(end), F.col("n").alias(f"n{end}"), F.col("c").alias(f"c{end}"), F.col("unlike").alias(f"d{end}"), *(F.col("parity")[i].alias(f"{side}{i}") for i in range(PARITY_WORDS))]
    x = rows.select("pivot", F.expr("cast(pmod(xxhash64(rep), parts) as int)").alias("part"), *columns("x", "u"))
    y = rows.select("pivot", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), *columns("y", "v"))
    # linked: the sets differ in at most (nu + nv) * (100 - percent) / (100 + percent) elements
    most = f"(nu + nv) * {100 - percent}"
    at_least = " + ".join(f"bit_count(x{i} ^ y{i})" for i in range(PARITY_WORDS))
    differ = "(size(du) + size(dv) - 2 * size(array_intersect(du, dv)))"
    linked = F.expr(f"v < u and cv <> cu and abs(nu - nv) * {100 + percent} <= {most} and abs(size(du) - size(dv)) * {100 + percent} <= {most} and ({at_least}) * {100 + percent} <= {most} and {differ} * {100 + percent} <= {most}")
    return x.join(y, (x["pivot"] == y["pivot"]) & (x["part"] == y["part"]) & linked).select("u", "v")


def keep_one(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of docs, with all their columns, but one row of each class: that of its smallest doc_id.

    Rows with a null doc_id stay. Where several rows share a kept doc_id, one of them stays: the one with the least text (null first).
    The ids that go are materialised, so that the joins that find them and the one that moves the texts are not one plan, whose
    stages the driver would plan and run at once.
    """
    gone = cut(near_duplicates(docs, percent=percent).where("not kept").select("doc_id").distinct())
    kept = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    twice = cut(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if twice.isEmpty():
        return kept
    rest = [c for c in docs.columns if c != "doc_id"]
    row = F.struct(*(F.col(c) for c in rest))
    one = kept.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(row, F.struct("text", F.xxhash64(*rest))).alias("row")).select("doc_id", "row.*")
    return kept.join(twice, "doc_id", "left_anti").select(docs.columns).unionByName(one.select(docs.columns))


#: Exact similarities of all pairs that share a shingle, then components, for near_duplicates at 85 percent.
ORACLE = """with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \\t\\n\\x0B\\f\\r]+') as w from documents),
    s as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as shingle from w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as r(i) where len(w) > 0),
    sizes as (select doc_id, count(*) as n from s group by doc_id),
    classes as (select doc_id, min(doc_id) over (partition by md5(string_agg(shingle, chr(10) order by shingle))) as rep from s group by doc_id),
    rs as (select s.* from s join classes using (doc_id) where doc_id = rep),
    common as (select a.doc_id as u, b.doc_id as v, count(*) as shared from rs a join rs b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
    links as (select u, v from common join sizes x on x.doc_id = u join sizes y on y.doc_id = v where 100 * shared >= 85 * (x.n + y.n - shared)),
    ends as (select u, v from links union all select v, u from links),
    reach as (select rep as node, rep as least from classes where doc_id = rep union select v, least from reach join ends on u = node where least < v),
    found as (select node, min(least) as least from reach group by node)
    select d.doc_id, coalesce(n, 0) as n_shingles, coalesce(least, d.doc_id) as component_id, coalesce(least, d.doc_id) = d.doc_id as kept
    from documents d left join sizes using (doc_id) left join classes using (doc_id) left join found on node = rep"""
