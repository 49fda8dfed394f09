"""Quality by ordinal cumulative-link regression on graded ratings.

P(grade >= j) = logistic(w.x - t_j) with one weight vector for all grades and ordered thresholds
t_1 < t_2 < ..., so a text gets an expected grade and the probability of reaching a grade. Features are
hashed: the share of each word, of each word shape (runs of upper case, lower case, digits and each mark)
and of each pair of neighbouring shapes, and how much the text repeats itself.

Weights are fitted on a bounded sample of rated documents; scoring is one pass over all
texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._labels import labelled_sample
from ._spark import batch, chunks
from ._text import U64, flat, mix, owner, prefix_hashes, range_hashes, words

SHAPES, WORDS = 1 << 13, 1 << 13
BUCKETS = SHAPES + WORDS
SAMPLE = 12000
#: Features of the sample that a step of the fit takes at a time: what the driver holds besides the sample grows with it.
BLOCK = 1 << 17
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123], _CLASS[128:] = ord("0"), ord("A"), ord("a"), ord("a")


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket, value), sorted by text; a bucket occurs once in a text."""
    n = len(offsets) - 1
    starts, ends, hashes, first = words(data, offsets)
    doc, count = owner(first), np.diff(first)
    kinds = _CLASS[data]
    keep = np.zeros(len(data), bool)
    if len(starts):
        keep[1:] = kinds[1:] != kinds[:-1]
        keep[starts] = True
    at = np.concatenate(([0], np.cumsum(keep)))
    shape = mix(range_hashes(prefix_hashes(kinds[keep]), at[starts], at[ends])) if len(starts) else hashes
    key = [(doc, shape & U64(SHAPES // 2 - 1)), (doc, (hashes >> U64(20)) % U64(WORDS) + U64(SHAPES))]
    same = doc[1:] == doc[:-1] if len(doc) else np.zeros(0, bool)
    pair = mix(shape[:-1] * U64(3) + shape[1:])[same]
    key.append((doc[:-1][same], (pair & U64(SHAPES // 4 - 1)) + U64(SHAPES // 2)))
    d = np.concatenate([k for k, _ in key])
    b = np.concatenate([v for _, v in key]).astype(np.int64)
    packed, times = np.unique(d * BUCKETS + b, return_counts=True)
    d, b = packed // BUCKETS, packed % BUCKETS
    value = times / np.maximum(count[d], 1)
    # how often a word repeats its neighbour, how many words are new, how long the text is, in tenths
    again = np.bincount(doc[:-1][same], weights=(hashes[1:] == hashes[:-1])[same], minlength=n) if len(doc) else np.zeros(n)
    order = np.lexsort((hashes, doc))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    distinct = np.bincount(doc[order], weights=fresh, minlength=n) if len(doc) else np.zeros(n)
    top = SHAPES * 3 // 4
    tenths = [np.ceil(10 * again / np.maximum(count, 1)), 16 + np.ceil(10 * distinct / np.maximum(count, 1)), 32 + np.minimum(15, np.log2(count + 1).astype(int))]
    every = np.arange(n)
    d = np.concatenate([d, every, every, every])
    b = np.concatenate([b, *(top + t.astype(np.int64) for t in tenths)])
    value = np.concatenate([value, np.ones(3 * n)])
    order = np.argsort(d, kind="stable")
    return d[order], b[order], value[order]


class CumulativeLink:
    """Proportional-odds regression, fitted by Adam on the mean log-likelihood with a ridge on the weights."""

    def __init__(self, grades: int, steps: int = 400, rate: float = 0.1, ridge: float = 1e-5):
        self.grades, self.steps, self.rate, self.ridge = grades, steps, rate, ridge
        self.w, self.thresholds = np.zeros(BUCKETS), np.linspace(-1, 1, grades - 1) if grades > 2 else np.zeros(grades - 1)

    def fit(self, doc: np.ndarray, bucket: np.ndarray, value: np.ndarray, grade: np.ndarray) -> CumulativeLink:
        """Integers and floats of any width; sums are of float64."""
        n = len(grade)
        blocks = [slice(at, at + BLOCK) for at in range(0, len(doc), BLOCK)]
        if not n:
            return self
        # thresholds: the first, then logarithms of the steps between them
        share = np.array([np.clip((grade >= j).mean(), 1e-3, 1 - 1e-3) for j in range(1, self.grades)])
        t = np.log((1 - share) / share)
        free = np.concatenate((t[:1], np.log(np.maximum(np.diff(t), 1e-2))))
        params = np.concatenate((self.w, free))
        m, v = np.zeros_like(params), np.zeros_like(params)
        rows = np.arange(n)
        for step in range(1, self.steps + 1):
            w, free = params[:BUCKETS], params[BUCKETS:]
            t = free[0] + np.concatenate(([0], np.cumsum(np.exp(free[1:]))))
            z = np.zeros(n)
            for b in blocks:
                z += np.bincount(doc[b], weights=w[bucket[b]] * value[b], minlength=n)
            tail = np.ones((n, self.grades + 1))
            tail[:, 1:-1] = 1 / (1 + np.exp(-np.clip(z[:, None] - t, -30, 30)))
            tail[:, -1] = 0
            upper, lower = tail[rows, grade], tail[rows, grade + 1]
            p = np.maximum(upper - lower, 1e-9)
            du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
            dz = (dl - du) / n
            g = np.empty_like(params)
            g[:BUCKETS] = self.ridge * w
            for b in blocks:
                g[:BUCKETS] += np.bincount(bucket[b], weights=dz[doc[b]] * value[b], minlength=BUCKETS)
            dt = np.array([(np.where(grade == j, du, 0) - np.where(grade == j - 1, dl, 0)).sum() / n for j in range(1, self.grades)])
            g[BUCKETS] = dt.sum()
            for k in range(1, self.grades - 1):
                g[BUCKETS + k] = dt[k:].sum() * np.exp(free[k])
            m = 0.9 * m + 0.1 * g
            v = 0.999 * v + 0.001 * g * g
            params = params - self.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        self.w, free = params[:BUCKETS], params[BUCKETS:]
        self.thresholds = free[0] + np.concatenate(([0], np.cumsum(np.exp(free[1:]))))
        return self

    def tails(self, doc: np.ndarray, bucket: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """(texts x grades-1): the probability of reaching grade 1, 2, .."""
        z = np.bincount(doc, weights=self.w[bucket] * value, minlength=n)
        return 1 / (1 + np.exp(-np.clip(z[:, None] - self.thresholds, -30, 30)))


_FEATURES = pa.schema([("target", pa.int32()), ("buckets", pa.list_(pa.int32())), ("values", pa.list_(pa.float32()))])


def fit(docs: DataFrame, ratings: DataFrame, target: str = "grade", grades: int = 3, sample: int = SAMPLE) -> CumulativeLink:
    """The model fitted on at most `sample` documents with ratings 0 .. grades-1 (their features come to the driver)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches):
            doc, bucket, value = features(*flat(piece.column(1)))
            first = pa.array(np.searchsorted(doc, np.arange(piece.num_rows + 1)), pa.int32())
            yield batch(_FEATURES, piece.column(2), pa.ListArray.from_arrays(first, pa.array(bucket, pa.int32())), pa.ListArray.from_arrays(first, pa.array(value, pa.float32())))

    rows = labelled_sample(docs, ratings, target, sample).mapInArrow(run, "target int, buckets array<int>, values array<float>").toArrow()
    model = CumulativeLink(grades)
    if not rows.num_rows:
        return model
    grade = np.clip(np.asarray(rows.column("target"), dtype=np.int64), 0, grades - 1)
    lengths = np.concatenate([np.asarray(x.value_lengths()) for x in rows.column("buckets").chunks])
    # one column at a time leaves the table, so that the driver holds the sample about once
    lists = []
    for k in ("buckets", "values"):
        lists.append(np.concatenate([np.asarray(x.flatten()) for x in rows.column(k).chunks]))
        rows = rows.drop_columns(k)
    return model.fit(np.repeat(np.arange(len(grade), dtype=np.int32), lengths), *lists, grade)


_ROW = pa.schema([("doc_id", pa.int64()), ("expected_grade", pa.float64()), ("tail_probability", pa.float64())])


def score(docs: DataFrame, model: CumulativeLink, at_least: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, expected_grade, tail_probability (of reaching grade `at_least`) of every row.

    Null and empty texts have no shapes and get what such texts were rated. Repeated rows get equal scores each, a
    null doc_id is kept, other columns are ignored; without ratings every text gets the same score.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches):
            tails = sent.value.tails(*features(*flat(piece.column(1))), piece.num_rows)
            yield batch(_ROW, piece.column(0), tails.sum(axis=1), tails[:, at_least - 1])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, expected_grade double, tail_probability double")


def keep_good(docs: DataFrame, model: CumulativeLink, at_least: int = 1, keep_at: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, whose texts reach grade `at_least` with probability keep_at."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches, text=at):
            tails = sent.value.tails(*features(*flat(piece.column(at))), piece.num_rows)
            yield piece.filter(pa.array(tails[:, at_least - 1] >= keep_at))

    return docs.mapInArrow(run, docs.schema)


def graded(labels: DataFrame) -> DataFrame:
    """doc_id, grade of the labels: 0 low quality, 1 good but toxic, 2 good. Rows without a quality label are left out."""
    return labels.where("quality is not null").select("doc_id", F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2).alias("grade"))


def select(docs: DataFrame, labels: DataFrame, keep_at: float = 0.5) -> DataFrame:
    """doc_id, expected_grade, tail_probability, kept: kept if grade 1 is reached with probability keep_at."""
    out = score(docs, fit(docs, graded(labels)))
    return out.withColumn("kept", F.col("tail_probability") >= keep_at)
