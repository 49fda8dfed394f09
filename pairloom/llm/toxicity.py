"""Toxicity by a factorization machine over hashed terms.

Terms are a text's distinct words and their first four, five and six bytes (inflected stems), hashed into
buckets. The buckets that tell the classes apart on the training sample (chi-square) become the machine's
features, and so do its most frequent buckets, whatever they tell on their own: a mention of a group may matter only beside
an insult. The machine learns a weight for each and, through factor vectors, one for each pair, which a sum of
weights cannot express. Fitting uses a bounded sample, whose terms are counted by Spark: the driver gets those of the chosen
buckets only, at most sample x (TERMS + FREQUENT) numbers. Scoring is one pass over all texts without a shuffle, with the
bounded model sent to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._labels import labelled_sample
from ._spark import batch, chunks, cut
from ._text import LOWER, U64, flat, mix, owner, prefix_hashes, range_hashes, words

BUCKETS = 1 << 20
SAMPLE = 12000
TERMS, FREQUENT = 4000, 500
LEAST, CHANCE = 4, 10.8  # texts of a term; chi-square that one in a thousand reaches by chance
_MARKS = np.zeros(256, bool)
_MARKS[list(b".,;:!?*#$%&\"')(|")] = True


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every term occurrence, not yet distinct."""
    starts, ends, _, first = words(data, offsets)
    for _ in range(4):  # punctuation behind a word
        trim = (ends - starts > 1) & _MARKS[data[ends - 1]] if len(ends) else np.zeros(0, bool)
        if not trim.any():
            break
        ends = ends - trim
    prefix = prefix_hashes(LOWER[data])
    doc, out_doc, out = owner(first), [], []
    for salt, size in enumerate((0, 4, 5, 6)):
        use = ends - starts > size
        a, b = starts[use], ends[use]
        h = mix(range_hashes(prefix, a, np.minimum(b, a + size) if size else b) + U64(salt + 1))
        out_doc.append(doc[use])
        out.append((h & U64(BUCKETS - 1)).astype(np.int64))
    return np.concatenate(out_doc), np.concatenate(out)


class FactorizationMachine:
    """Degree-two factorization machine with logistic loss on sets of features, fitted by AdaGrad."""

    def __init__(self, features: int, rank: int = 8, epochs: int = 40, rate: float = 0.1, ridge: float = 1e-5, seed: int = 3):
        r = np.random.default_rng(seed)
        self.bias, self.w, self.v = 0.0, np.zeros(features), r.normal(0, 0.05, (features, rank))
        self.epochs, self.rate, self.ridge, self.rng = epochs, rate, ridge, r

    def raw(self, doc: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        """Scores of n texts from distinct (text, feature) pairs."""
        linear = np.bincount(doc, weights=self.w[feature], minlength=n)
        own = self.v[feature]
        pairs = np.zeros(n)
        for f in range(self.v.shape[1]):
            pairs += np.bincount(doc, weights=own[:, f], minlength=n) ** 2 - np.bincount(doc, weights=own[:, f] ** 2, minlength=n)
        return self.bias + linear + 0.5 * pairs

    def fit(self, doc: np.ndarray, feature: np.ndarray, y: np.ndarray, size: int = 256) -> FactorizationMachine:
        n = len(y)
        if not n:
            return self
        order = np.argsort(doc, kind="stable")
        doc, feature = doc[order], feature[order]
        first = np.searchsorted(doc, np.arange(n + 1))
        rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.bias = float(np.log(rate / (1 - rate)))
        gb, gw, gv = 1e-8, np.full(len(self.w), 1e-8), np.full(self.v.shape, 1e-8)
        for _ in range(self.epochs):
            shuffled = self.rng.permutation(n)
            for at in range(0, n, size):
                rows = shuffled[at : at + size]
                lengths = first[rows + 1] - first[rows]
                take = np.arange(int(lengths.sum())) + np.repeat(first[rows] - (np.cumsum(lengths) - lengths), lengths)
                d, f = np.repeat(np.arange(len(rows)), lengths), feature[take]
                own = self.v[f]
                some = np.flatnonzero(lengths)
                sums, squares = np.zeros((len(rows), self.v.shape[1])), np.zeros((len(rows), self.v.shape[1]))
                if len(some):
                    begin = (np.cumsum(lengths) - lengths)[some]
                    sums[some], squares[some] = np.add.reduceat(own, begin), np.add.reduceat(own**2, begin)
                z = self.bias + np.bincount(d, weights=self.w[f], minlength=len(rows)) + 0.5 * (sums**2 - squares).sum(axis=1)
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / len(rows)
                g = error.sum()
                gb += g * g
                self.bias -= self.rate * g / np.sqrt(gb)
                touched, place = np.unique(f, return_inverse=True)
                dw = np.bincount(place, weights=error[d], minlength=len(touched)) + self.ridge * self.w[touched]
                dv = self.ridge * self.v[touched]
                if len(touched):
                    by = np.argsort(place, kind="stable")
                    dv += np.add.reduceat((error[d][:, None] * (sums[d] - own))[by], np.searchsorted(place[by], np.arange(len(touched))))
                gw[touched] += dw**2
                gv[touched] += dv**2
                self.w[touched] -= self.rate * dw / np.sqrt(gw[touched])
                self.v[touched] -= self.rate * dv / np.sqrt(gv[touched])
        return self


def _distinct(doc: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique(doc.astype(np.int64) << 32 | feature.astype(np.int64))
    return key >> 32, key & 0xFFFFFFFF


class ToxicityModel:
    """Feature table (bucket -> feature or -1) and the machine on it."""

    def __init__(self, chosen: np.ndarray, doc: np.ndarray, bucket: np.ndarray, y: np.ndarray):
        """chosen: the buckets that are features; doc, bucket: the terms of the sample, whose labels are y."""
        self.table = np.full(BUCKETS, -1, np.int32)
        self.table[chosen] = np.arange(len(chosen))
        feature = self.table[bucket]
        mine = feature >= 0
        self.machine = FactorizationMachine(len(chosen)).fit(*_distinct(doc[mine], feature[mine]), y)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        doc, bucket = terms(data, offsets)
        feature = self.table[bucket]
        mine = feature >= 0
        raw = self.machine.raw(*_distinct(doc[mine], feature[mine]), len(offsets) - 1)
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


_TERMS = pa.schema([("target", pa.int32()), ("buckets", pa.list_(pa.int32()))])


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", sample: int = SAMPLE, learn: str = "true") -> ToxicityModel:
    """The model fitted on at most `sample` labelled documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches):
            doc, bucket = _distinct(*terms(*flat(piece.column(1))))
            first = np.searchsorted(doc, np.arange(piece.num_rows + 1))
            yield batch(_TERMS, piece.column(2), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(bucket, pa.int32())))

    rows = cut(labelled_sample(docs, labels, target, sample, learn).mapInArrow(run, "target int, buckets array<int>"))
    n, positive = rows.agg(F.count("*"), F.coalesce(F.sum("target"), F.lit(0))).first()
    seen = rows.select("target", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("seen"), F.sum("target").alias("toxic")).where(f"seen >= {LEAST}")
    share = positive / max(n, 1)
    chi = f"power(toxic - seen * {share}D, 2) / greatest(seen * {share}D * (1 - seen / {max(n, 1)}D), 1e-9D)"
    told = seen.withColumn("chi", F.expr(chi)).where(f"chi >= {CHANCE}").orderBy(F.desc("chi"), "bucket").limit(TERMS)
    often = seen.orderBy(F.desc("seen"), "bucket").limit(FREQUENT)
    chosen = np.unique(np.array([r["bucket"] for r in told.select("bucket").union(often.select("bucket")).collect()], np.int64))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in batches:
            lists = piece.column(1)
            flat_, lengths = np.asarray(lists.flatten()), np.asarray(lists.value_lengths(), dtype=np.int64)
            mine = np.isin(flat_, chosen)
            first = np.concatenate(([0], np.cumsum(np.bincount(np.repeat(np.arange(len(lengths)), lengths)[mine], minlength=len(lengths)))))
            yield batch(_TERMS, piece.column(0), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(flat_[mine], pa.int32())))

    rows = rows.mapInArrow(keep, "target int, buckets array<int>").toArrow()
    lists = pa.concat_arrays(rows.column("buckets").chunks) if rows.num_rows else pa.array([], pa.list_(pa.int32()))
    bucket = np.asarray(lists.flatten(), dtype=np.int64)
    doc = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths(), dtype=np.int64)) if len(lists) else np.zeros(0, np.int64)
    return ToxicityModel(chosen, doc, bucket, np.asarray(rows.column("target"), dtype=float))


_ROW = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) of every row. Null and empty texts get the score of a text without known terms.

    Repeated rows get equal scores each; a null doc_id is kept; other columns are ignored. Without
    any usable label the score is the machine's initial one.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches):
            yield batch(_ROW, piece.column(0), sent.value.scores(*flat(piece.column(1))))

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted: learnt from labels of rows whose crc32(doc_id as text) mod 3 is not 1."""
    model = fit(docs, labels, learn="crc32(cast(doc_id as string)) % 3 <> 1")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return score(docs, model).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
