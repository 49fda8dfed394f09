"""Katz backoff language model: Good-Turing discounted trigrams over bigrams over unigrams with half a count added.

P(w | g h) = c*(ghw) / c(gh) if the trigram was seen in training, else alpha(gh) P(w | h), and P(w | h) is made in the same way from
bigrams and unigrams. alpha is what discounting left of a history's mass, divided by the shorter history's mass of the words
not seen after it: each distribution sums to one exactly. P(w) = (c(w) + 1/2) / (N + (V + 1)/2) leaves a share for one unknown word.

Counts live in tables that are partitioned by a trigram's middle word h. All trigrams around h give c(ghw), c(gh), and summed over g
also c(hw) and c(h): one table has what the recursion needs, but for c(w), which comes with the question. A frequent h
is split by g. Its pairs (h, w) then have no table of their own and are counted in one before, split by w.

The exchange runs in three rounds over the same chunks of documents:
1. Words, as strings (compared by their bytes, so no two words are ever one), get a number and their count.
2. Pairs of the frequent h get their count.
3. Distinct trigrams get their count, their history's and, if unseen, the backed-off probability.

The driver gets counts of counts, the corpus totals, and some sums for each split h: those with more than a quarter of a bucket's
tokens, so at most four times the buckets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._exchange import Texts, answer, ask, by_bucket, counts, filled, kinds, planes, squeeze, statistics, unsqueeze
from ._text import LOWER, U64, crc32_of_ids, flat, mix, owner, prefix_hashes, range_hashes, words

END, START = b" ", b"\t"  # no word holds a space
CHUNK_BYTES = 8 << 20
BLOCK_BYTES = 1 << 20  # texts are cut into words so many bytes at a time
BUCKET_BYTES = 6 << 20  # of text for each bucket
SPLIT = 1000  # words with fewer tokens are never split
MOST = 5  # counts above are not discounted


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


def distinct_strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one string of each kind, kind of each string); equal hashes are verified on the bytes, strings that differ get kinds of their own."""
    one, kind = kinds(hashes >> U64(len(hashes).bit_length() + 1))
    first, size = starts[one][kind], ends - starts
    odd = size != (ends - starts)[one][kind]
    same = np.flatnonzero(~odd & (first != starts))
    for at in range(0, len(same), 1 << 18):
        rows = same[at : at + (1 << 18)]
        unlike = data[_spread(starts[rows], size[rows])] != data[_spread(first[rows], size[rows])]
        if unlike.any():
            odd[rows[np.repeat(np.arange(len(rows)), size[rows])[unlike]]] = True
    if odd.any():
        own: dict[bytes, int] = {}
        more = []
        for i in np.flatnonzero(odd).tolist():
            text = data[starts[i] : ends[i]].tobytes()
            if text not in own:
                own[text] = len(one) + len(more)
                more.append(i)
            kind[i] = own[text]
        one = np.concatenate((one, more))
    return one, kind


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As `words`, in blocks of whole texts, so that only the result grows with the chunk."""
    parts, first, at, n = [], [np.zeros(1, np.int64)], 0, len(offsets) - 1
    while at < n:
        stop = min(n, max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, "right")) - 1))
        low = offsets[at]
        starts, ends, hashes, own = words(data[low : offsets[stop]], offsets[at : stop + 1] - low)
        parts.append((starts + low, ends + low, hashes))
        first.append(own[1:] + first[-1][-1])
        at = stop
    return (*(np.concatenate(x) for x in zip(*parts)), np.concatenate(first)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64), first[0])


class Tokens:
    """A chunk's documents as token numbers, most frequent first, and the tokens' strings."""

    def __init__(self, part: int, number: int, ids: list, texts: list):
        self.part, self.number = part, number
        self.known = np.array([i is not None for i in ids], bool)
        self.ids = np.array([i if i is not None else 0 for i in ids], np.int64)
        data, offsets = flat(pa.array(texts, pa.string()))
        starts, ends, hashes, first = _words(data, offsets)
        data = LOWER[data]
        one, kind = distinct_strings(data, starts, ends, hashes)
        size = (ends - starts)[one]
        n = len(self.ids)
        tokens = np.full(len(kind) + n, len(one))
        tokens[np.arange(len(kind)) + owner(first)] = kind
        times = np.bincount(tokens, minlength=len(one) + 2)
        times[len(one) + 1] = n  # START has no token of its own
        order = np.argsort(-times, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.end, self.start = int(rank[-2]), int(rank[-1])
        raw = np.concatenate((data[_spread(starts[one], size)], np.frombuffer(END + START, np.uint8)))
        size = np.append(size, (1, 1))
        self.lengths = planes(size[order])
        self.strings = squeeze(raw[_spread((np.cumsum(size) - size)[order], size[order])].tobytes())
        self.tokens = planes(rank[tokens])
        self.first = first + np.arange(n + 1)

    def trained(self) -> np.ndarray:
        return self.known & (crc32_of_ids(self.ids) % 5 != 1)

    def training_counts(self) -> np.ndarray:
        """Of each distinct token; that of START is the number of documents."""
        train = self.trained()
        out = np.bincount(counts(self.tokens), weights=np.repeat(train, np.diff(self.first)), minlength=self.lengths[0]).astype(np.int64)
        out[self.start] = train.sum()
        return out


def _strings(packed: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, hashes) of (lengths, strings) lists."""
    sizes = [counts(x) for x, _ in packed]
    size = np.concatenate(sizes)
    data = np.frombuffer(b"".join(unsqueeze(raw, int(n.sum())) for n, (_, raw) in zip(sizes, packed)), np.uint8)
    ends = np.cumsum(size)
    return data, ends - size, ends, mix(range_hashes(prefix_hashes(data), ends - size, ends))


def _word_buckets(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    return by_bucket(((hashes >> U64(40)) % U64(buckets)).astype(np.int64), buckets)


def ask_words(buckets: int):
    def question(chunk):
        data, starts, ends, hashes = _strings([(chunk.lengths, chunk.strings)])
        order, cut = _word_buckets(hashes, buckets)
        times = chunk.training_counts()
        for bucket, a, b in filled(cut):
            own = order[a:b]
            size = (ends - starts)[own]
            yield bucket, (planes(size), squeeze(data[_spread(starts[own], size)].tobytes()), planes(times[own]))

    return question


def _totals(payloads) -> tuple[np.ndarray, np.ndarray, int]:
    """(kind of each string asked, training count of each kind, kind of START or -1)."""
    data, starts, ends, hashes = _strings([(x, raw) for x, raw, _ in payloads])
    one, kind = distinct_strings(data, starts, ends, hashes)
    total = np.bincount(kind, weights=np.concatenate([counts(c) for _, _, c in payloads]), minlength=len(one)).astype(np.int64)
    start = np.flatnonzero((ends[one] - starts[one] == 1) & (data[starts[one]] == START[0]))
    return kind, total, int(start[0]) if len(start) else -1


def word_statistics(payloads) -> tuple[int, int]:
    _, total, start = _totals(payloads)
    total = np.delete(total, start) if start >= 0 else total
    return int(total.sum()), int((total > 0).sum())


def reply_words(buckets: int):
    """For each its number (the more frequent a word, the smaller) and its training count."""

    def reply(payloads, bucket):
        kind, total, _ = _totals(payloads)
        number = np.empty(len(total), np.int64)
        number[np.argsort(-total, kind="stable")] = np.arange(len(total)) * buckets + bucket
        cuts = np.cumsum([x[0] for x, _, _ in payloads])[:-1]
        return [(planes(a), planes(b)) for a, b in zip(np.split(number[kind], cuts), np.split(total[kind], cuts))]

    return reply


class Numbered:
    """A chunk's tokens by the words' numbers, with the word before each, and its pairs (h2, w) of split h2 by bucket.

    A word stands for its place among the chunk's words in order of their numbers.
    """

    def __init__(self, chunk: Tokens, replies: list, buckets: int, hot: int):
        _, _, _, hashes = _strings([(chunk.lengths, chunk.strings)])
        order, _ = _word_buckets(hashes, buckets)
        number, count = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        number[order], count[order] = (np.concatenate([counts(r[i]) for r in replies]) for i in (0, 1))
        by_number = np.argsort(number)
        place = np.empty_like(by_number)
        place[by_number] = np.arange(len(place))
        self.number, self.count, self.first = number[by_number], count[by_number], chunk.first
        self.tokens = place[counts(chunk.tokens)]
        self.start = place[chunk.start]
        self.before = np.empty_like(self.tokens)
        self.before[1:] = self.tokens[:-1]
        self.before[self.first[:-1]] = self.start
        self.trained = np.repeat(chunk.trained(), np.diff(self.first))
        self.spot = mix(self.number.astype(U64))
        self.parts = (1 + self.count // hot).astype(U64)
        self.often = self.count >= hot
        d = len(order)
        mine = np.flatnonzero(self.often[self.before])
        pairs = self.before[mine] * d + self.tokens[mine]
        one, of = kinds(pairs)
        pair = pairs[one]
        self.pair_key, self.pair_h, self.pair_w = pair, pair // d, pair % d
        self.pair_times = np.bincount(of, weights=self.trained[mine], minlength=len(pair)).astype(np.int64)
        bucket = ((self.spot[self.pair_h] >> U64(8)) + self.spot[self.pair_w] % self.parts[self.pair_h]) % U64(buckets)
        self.pair_order, self.pair_cut = by_bucket(bucket.astype(np.int64), buckets)


class Trigrams(Numbered):
    """The distinct trigrams (h1, h2, w) of a chunk by bucket, then by number of h2, h1 and w."""

    def __init__(self, chunk: Tokens, replies: list, buckets: int, hot: int):
        super().__init__(chunk, replies, buckets, hot)
        first, h2 = self.first, self.before
        h1 = np.empty_like(h2)
        h1[2:] = self.tokens[:-2]
        h1[first[:-1]] = self.start
        second = first[:-1] + 1
        h1[second[second < first[1:]]] = self.start
        d = len(self.number)
        one, of = kinds(h2 * d + h1)
        h1, h2 = h1[one], h2[one]
        key = of * d + self.tokens
        one, which = kinds(key)
        of, self.w = np.divmod(key[one], d)
        self.h2, self.h1 = h2[of], h1[of]
        del h1, h2, key, of
        self.times = np.bincount(which, weights=self.trained, minlength=len(self.w)).astype(np.int64)
        bucket = ((self.spot[self.h2] >> U64(8)) + self.spot[self.h1] % self.parts[self.h2]) % U64(buckets)
        order, self.cut = by_bucket(bucket.astype(np.int64), buckets)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.which = place[which]
        self.h2, self.h1, self.w, self.times = self.h2[order], self.h1[order], self.w[order], self.times[order]
        self.split = self.often[self.h2]
        # histories: runs of one (h1, h2) in a bucket
        self.begins = np.ones(len(order), bool)
        self.begins[1:] = (self.h2[1:] != self.h2[:-1]) | (self.h1[1:] != self.h1[:-1])
        self.begins[self.cut[:-1][self.cut[:-1] < len(order)]] = True

    def pair_counts(self, replies: list) -> np.ndarray:
        """Corpus count of (h2, w) of each trigram whose h2 is split, in their order."""
        out = np.zeros(len(self.pair_key), np.int64)
        if len(out):
            out[self.pair_order] = np.concatenate([counts(r) for r in replies])
        return out[np.searchsorted(self.pair_key, self.h2[self.split] * len(self.number) + self.w[self.split])]


def ask_pairs(buckets: int, hot: int):
    def question(chunk, replies):
        t = Numbered(chunk, replies, buckets, hot)
        for bucket, a, b in filled(t.pair_cut):
            own = t.pair_order[a:b]
            h, w = t.pair_h[own], t.pair_w[own]
            yield bucket, (planes(t.number[h]), planes(t.number[w]), planes(t.pair_times[own]), planes(t.count[w]))

    return question


def _keys(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """np.unique of the pairs: (place of one of each, kind of each, kinds' a)."""
    if len(a) and (int(a.max()) + 1) * (int(b.max()) + 1) >> 62:
        a_, b_ = (np.unique(x, return_inverse=True)[1] for x in (a, b))
    else:
        a_, b_ = a, b
    one, kind = kinds(a_ * (int(b_.max()) + 1 if len(b_) else 1) + b_)
    return one, kind, a[one]


def _counts_of_counts(total: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(total, MOST + 2), minlength=MOST + 3)[: MOST + 2]


def _pair_table(payloads):
    h, w, times, cw = (np.concatenate([counts(p[i]) for p in payloads]) for i in range(4))
    one, kind, h = _keys(h, w)
    return h, cw[one], kind, np.bincount(kind, weights=times, minlength=len(one)).astype(np.int64)


def pair_statistics(n: int, v: int):
    """Counts of counts, and for each split h its pairs by count, larger counts and unigram mass."""

    def of_bucket(payloads):
        h, cw, _, total = _pair_table(payloads)
        histories, of = np.unique(h, return_inverse=True)
        by = lambda weights: np.bincount(of, weights=weights, minlength=len(histories))
        unigram = np.where(total > 0, (cw + 0.5) / (n + 0.5 * (v + 1)), 0.0)
        return _counts_of_counts(total), histories, np.array([by(total == r) for r in range(1, MOST + 1)] + [by(np.where(total > MOST, total, 0)), by(unigram)])

    return of_bucket


def reply_pairs(payloads, _bucket):
    _, _, kind, total = _pair_table(payloads)
    return [planes(x) for x in np.split(total[kind], np.cumsum([p[0][0] for p in payloads])[:-1])]


def ask_trigrams(buckets: int, hot: int):
    def question(chunk, replies, pair_replies):
        t = Trigrams(chunk, replies, buckets, hot)
        pair = np.zeros(len(t.w), np.int64)
        pair[t.split] = t.pair_counts(pair_replies)
        for bucket, a, b in filled(t.cut):
            begin = np.flatnonzero(t.begins[a:b]) + a
            w = t.w[a:b]
            yield bucket, (planes(t.number[t.h2[begin]]), planes(t.number[t.h1[begin]]), planes(np.diff(np.append(begin, b))), planes(t.number[w]), planes(t.times[a:b]), planes(t.count[w]), np.packbits(t.split[begin]), planes(pair[a:b][t.split[a:b]]))

    return question


class Table:
    """A bucket's counts: distinct trigrams, their histories (h1, h2), and the pairs (h2, w) of the h2 that are not split."""

    def __init__(self, payloads):
        h2, h1, run, w, times, cw = (np.concatenate([counts(p[i]) for p in payloads]) for i in range(6))
        self.sizes = [(p[0][0], p[3][0]) for p in payloads]
        split = np.concatenate([np.unpackbits(p[6], count=p[0][0]) for p in payloads]).astype(bool)
        one, self.asked_history, self.h2 = _keys(h2, h1)
        self.run, self.split = run, split[one]
        history = np.repeat(self.asked_history, run)
        pair = np.zeros(len(w), np.int64)
        pair[np.repeat(split, run)] = np.concatenate([counts(p[7]) for p in payloads])
        first, self.asked, self.history = _keys(history, w)
        del history, h1
        self.total = np.bincount(self.asked, weights=times, minlength=len(first)).astype(np.int64)
        self.cw = cw[first]
        new = np.ones(len(self.h2), bool)
        new[1:] = self.h2[1:] != self.h2[:-1]
        self.words, self.of = self.h2[new], np.cumsum(new) - 1  # the distinct h2, ascending, and each history's
        one, self.pair, self.pair_of = _keys(self.of[self.history], w[first])
        self.pair_total = np.bincount(self.pair, weights=self.total, minlength=len(one)).astype(np.int64)
        self.pair_cw, self.pair_split = self.cw[one], self.split[self.history[one]]
        self.pair_count = np.where(self.split[self.history], pair[first], self.pair_total[self.pair])


def trigram_statistics(payloads):
    """Counts of counts of trigrams, and of the pairs of h2 that are not split."""
    t = Table(payloads)
    return _counts_of_counts(t.total), _counts_of_counts(t.pair_total[~t.pair_split])


def good_turing(counts: np.ndarray) -> np.ndarray:
    """Factors for counts 0..MOST (Katz's form); where the counts of counts don't allow it, those of absolute discounting."""
    n = counts.astype(float)
    spare = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    plain = np.array([1.0] + [1 - min(max(spare, 0.1), 0.9) / r for r in range(1, MOST + 1)])
    if n[1] <= 0 or (n[1 : MOST + 2] <= 0).any():
        return plain
    common = (MOST + 1) * n[MOST + 1] / n[1]
    if common >= 1:
        return plain
    d = np.array([1.0] + [((r + 1) * n[r + 1] / (n[r] * r) - common) / (1 - common) for r in range(1, MOST + 1)])
    return d if (d[1:] > 0).all() and (d[1:] < 1).all() else plain


def _discounted(total: np.ndarray, factors: np.ndarray) -> np.ndarray:
    return total * np.where(total <= MOST, factors[np.minimum(total, MOST)], 1.0)


def _left(kept: np.ndarray, lower: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(divisor, alpha) of histories: one is added to the count of a history that discounting left nothing. lower: the shorter history's mass of the words seen."""
    divisor = np.where(kept >= count - 1e-9, count + 1, count).astype(float)
    return divisor, (1 - kept / divisor) / np.maximum(1 - lower, 1e-300)


class Model:
    """What the buckets need to know of the corpus to evaluate their tables."""

    def __init__(self, n: int, v: int, pairs: np.ndarray, trigrams: np.ndarray, sums: dict[int, np.ndarray]):
        self.n, self.v, self.pairs, self.trigrams = n, v, pairs, trigrams
        self.frequent: dict[int, tuple[float, float]] = {}
        for h, s in sums.items():
            few = s[:MOST] * np.arange(1, MOST + 1)
            kept, count = few @ pairs[1:] + s[MOST], few.sum() + s[MOST]
            self.frequent[h] = tuple(float(x[0]) for x in _left(np.array([kept]), np.array([s[MOST + 1]]), np.array([count])))

    def unigram(self, count: np.ndarray) -> np.ndarray:
        return (count + 0.5) / (self.n + 0.5 * (self.v + 1))

    def evaluate(self, t: Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(probability of each distinct trigram, divisor and count of each history)."""
        # of h2 alone
        words_, of, pair_of = t.words, t.of, t.pair_of
        by = lambda place, weights, n: np.bincount(place, weights=weights, minlength=n)
        kept, lower = by(pair_of, _discounted(t.pair_total, self.pairs), len(words_)), by(pair_of, np.where(t.pair_total > 0, self.unigram(t.pair_cw), 0.0), len(words_))
        divisor, alpha = _left(kept, lower, by(pair_of, t.pair_total, len(words_)))
        for i in np.unique(of[t.split]).tolist():
            divisor[i], alpha[i] = self.frequent[int(words_[i])]
        h2 = of[t.history]
        shorter = np.where(t.pair_count > 0, _discounted(t.pair_count, self.pairs) / divisor[h2], alpha[h2] * self.unigram(t.cw))
        # of (h1, h2)
        n = len(t.h2)
        count = by(t.history, t.total, n)
        divisor, alpha = _left(by(t.history, _discounted(t.total, self.trigrams), n), by(t.history, np.where(t.total > 0, shorter, 0.0), n), count)
        return np.where(t.total > 0, _discounted(t.total, self.trigrams) / divisor[t.history], alpha[t.history] * shorter), divisor, count.astype(np.int64)


def reply_trigrams(model: Model):
    """For each: the counts, those of the histories, whether one was added to them, and the probabilities of the unseen."""

    def reply(payloads, _bucket):
        t = Table(payloads)
        p, divisor, count = model.evaluate(t)
        total, p = t.total[t.asked], p[t.asked]
        out, at, at_h = [], 0, 0
        for n_h, size in t.sizes:
            h, own = t.asked_history[at_h : at_h + n_h], slice(at, at + size)
            out.append((planes(total[own]), planes(count[h]), np.packbits(divisor[h] > count[h]), p[own][total[own] == 0]))
            at, at_h = at + size, at_h + n_h
        return out

    return reply


def score_chunk(element, model: Model, buckets: int, hot: int):
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of a chunk."""
    chunk, word_replies, _, answers = element
    t = Trigrams(chunk, word_replies, buckets, hot)
    total, history = (np.concatenate([counts(a[i]) for a in answers]) for i in (0, 1))
    added = np.concatenate([np.unpackbits(a[2], count=a[1][0]) for a in answers])
    divisor = (history + added)[np.cumsum(t.begins) - 1]
    p = np.empty(len(total))
    seen = total > 0
    p[seen] = _discounted(total[seen], model.trigrams) / divisor[seen]
    p[~seen] = np.concatenate([a[3] for a in answers])
    unigram, trigram = np.log10(model.unigram(t.count)), np.log10(p)
    doc = owner(t.first)
    sums = lambda x: np.bincount(doc, weights=x, minlength=len(chunk.ids)).tolist()
    held = chunk.known & ~chunk.trained()
    ids = [i if k else None for i, k in zip(chunk.ids.tolist(), chunk.known.tolist())]
    return list(zip(ids, held.tolist(), np.diff(t.first).tolist(), map(int, sums(t.count[t.tokens] > 0)), [model.n] * len(ids), sums(unigram[t.tokens]), sums(trigram[t.which])))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES, split: int = SPLIT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per row of docs.

    Learns from rows whose crc32(doc_id as text) mod 5 is not 1 and scores all. Null and empty texts are one end token. A
    null doc_id is scored but not learnt from, and not held out; repeated rows count and are scored each. Other columns are
    ignored. With nothing to learn from, every token has the unknown word's probability; an empty table gives an empty result.
    Memory: a task holds a chunk of about 8 MB (or one longer text) with its trigrams, or a bucket's: `bucket_bytes` of text for each.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = Texts(docs, CHUNK_BYTES, Tokens)
    buckets = max(8, -(-texts.bytes // bucket_bytes))
    asked = ask(texts.beside(), ask_words(buckets), buckets)
    found = statistics(asked, word_statistics)
    n, v = sum(x for x, _ in found), sum(y for _, y in found)
    hot = max(split, n // (4 * buckets))
    known = answer(asked, texts, reply_words(buckets), 0)
    pairs = ask(texts.beside(known), ask_pairs(buckets, hot), buckets)
    sums: dict[int, np.ndarray] = {}
    of_pairs = np.zeros(MOST + 2, np.int64)
    for counted, histories, parts in statistics(pairs, pair_statistics(n, v)):
        of_pairs = of_pairs + counted
        for h, s in zip(histories.tolist(), parts.T):
            sums[h] = sums.get(h, 0) + s
    paired = answer(pairs, texts, reply_pairs, 1)
    trigrams = ask(texts.beside(known, paired), ask_trigrams(buckets, hot), buckets)
    found = statistics(trigrams, trigram_statistics)
    of_trigrams = sum((x for x, _ in found), np.zeros(MOST + 2, np.int64))
    of_pairs = sum((y for _, y in found), of_pairs)
    model = Model(n, v, good_turing(of_pairs), good_turing(of_trigrams), sums)
    answers = answer(trigrams, texts, reply_trigrams(model), 2)
    scored = texts.beside(known, paired, answers).flatMap(lambda e: score_chunk(e, model, buckets, hot))
    return docs.sparkSession.createDataFrame(scored, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double", verifySchema=False)
