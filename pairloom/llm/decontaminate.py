"""Benchmark decontamination by latent semantic retrieval.

Documents and benchmark items are cut into passages of 32 words, 16 words apart. Passages are TF-IDF vectors over
the benchmark's vocabulary without stop words, with document frequencies from all passages of the corpus. A randomised
SVD of that matrix (Gaussian sketch, then one power iteration, each a pass over all passages whose partial products
A'(A W) are summed in two levels) gives a latent space in which each passage is compared with every item by cosine.
A space of bounded rank loses some copies, so an exact lexical route adds every text that can pass the verification: an
inverted index of each item's rarer words (LEXICAL of its word occurrences) gives the occurrences a text can hold at most.
Candidates of either route are verified on the words themselves, at each passage: the longest common subsequence of the item
with the text around the passage and, for paraphrases, whether the item's answer stands there.

The items are the stated query set: they are taken in blocks, so what is sent to the tasks is bounded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import batch, chunks
from ._text import U64, flat, words

STRIDE = 16  # a passage is two strides
RANK = 128
COSINE = 0.3
#: A passage with few of the item's words can point the same way; it must also reach this share of the item's length.
REACH = 0.25
#: Share of an item passage's known words that a candidate must have; alignment costs a passage up to a quarter of an item's.
SHARED = 0.75 * 0.4
#: A word in a larger share of passages is a stop word.
STOP = 0.002
#: Share of an item's words in common order that alone shows a copy, and the share that does so together with the answer.
COPY, PARAPHRASE = 0.6, 0.4
ANSWER_WORDS, ANSWER_SHARE = 5, 0.8
#: Share of an item's word occurrences, rarest words first, in the lexical index. A text that lacks more than 1 - COPY of the item's
#: occurrences (1 - PARAPHRASE with the answer) cannot pass, so over 1 - PARAPHRASE no such text is lost; the rest only selects.
LEXICAL = 0.75
#: Cells of texts by items that the lexical route counts at a time.
CELLS = 1 << 22
#: Items of a block, and their words at most: what is sent, summed up and collected has a row for each distinct word.
ITEMS, ITEM_WORDS = 20000, 1 << 17
SPAN = 256


def lcs_length(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, 64 and more cells of a row at a time in one integer."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        if m := where.get(x):
            u = row & m
            row = (row + u | row - u) & full
    return len(a) - row.bit_count()


def _find(vocabulary: np.ndarray, bits: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, numbers) of the hashes that stand in the sorted vocabulary; bits has their first 20 bits."""
    maybe = np.flatnonzero(bits[(hashes >> U64(44)).astype(np.int64)])
    at = np.searchsorted(vocabulary, hashes[maybe])
    at[at == len(vocabulary)] = 0
    right = vocabulary[at] == hashes[maybe]
    return maybe[right], at[right]


def _distinct(key: np.ndarray) -> np.ndarray:
    """The sorted distinct values; sorts in place."""
    key.sort()
    return key[np.append(True, key[1:] != key[:-1])] if len(key) else key


class Index:
    """Inverted index of word lists: for each word the lists that hold it, with its occurrences there."""

    def __init__(self, lists: list[np.ndarray]):
        word = np.concatenate(lists) if lists else np.zeros(0, U64)
        self.vocabulary, number = np.unique(word, return_inverse=True)
        width = max(1, len(lists))
        key, count = np.unique(number * width + np.repeat(np.arange(len(lists)), [len(x) for x in lists]), return_counts=True)
        self.item, self.count = key % width, count.astype(float)
        self.first = np.searchsorted(key // width, np.arange(len(self.vocabulary) + 1))

    def among(self, words: np.ndarray) -> Index:
        """From now on, words are numbers in `words` (sorted, with all of the lists' words)."""
        self.own = np.full(len(words), -1)
        self.own[np.searchsorted(words, self.vocabulary)] = np.arange(len(self.vocabulary))
        return self

    def counts(self, text: np.ndarray, number: np.ndarray, texts: int, n: int) -> np.ndarray:
        """For each text and each of n lists, text by text: the list's occurrences of words of the text; text, number: where each known word stands and which it is."""
        word = self.own[number]
        mine = np.flatnonzero(word >= 0)
        wide = max(1, len(self.vocabulary))
        key = _distinct(text[mine] * wide + word[mine])
        doc, word = key // wide, key % wide
        length = self.first[word + 1] - self.first[word] if len(word) else word
        take = np.arange(int(length.sum())) + np.repeat(self.first[word] - (np.cumsum(length) - length), length) if len(word) else word
        return np.bincount(np.repeat(doc, length) * n + self.item[take], weights=self.count[take], minlength=texts * n)


class Items:
    """A block of benchmark items: word hashes, vocabulary and, once known, weights and latent space."""

    def __init__(self, ids: list, texts: list[str], answers: list[str | None]):
        _, _, h, first = words(*flat(pa.array(texts, pa.string())))
        _, _, ah, afirst = words(*flat(pa.array([a or "" for a in answers], pa.string())))
        keep = [i for i in range(len(ids)) if first[i + 1] > first[i]]
        self.ids = [ids[i] for i in keep]
        self.words = [h[first[i] : first[i + 1]] for i in keep]
        self.answers = [ah[afirst[i] : afirst[i + 1]] for i in keep]
        self._know(np.unique(np.concatenate(self.words)) if keep else np.zeros(0, U64))
        self.all_words, self.all_bits = self.vocabulary, self.bits
        self.numbers = [np.searchsorted(self.vocabulary, w) for w in self.words]
        self.space: np.ndarray | None = None

    def _know(self, vocabulary: np.ndarray) -> None:
        self.vocabulary = vocabulary
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(vocabulary >> U64(44)).astype(np.int64)] = True
        self.idf = np.ones(len(vocabulary))

    def weigh(self, seen: np.ndarray, passages: int) -> None:
        """Sets the weights and forgets stop words: those in more than STOP of all passages, unless they are
        among the rarer half of an item's words (an item that a third of the corpus repeats has only frequent ones)."""
        keep = seen <= STOP * passages
        self._index(seen)
        for w in self.words:
            known = np.searchsorted(self.vocabulary, np.unique(w))
            keep[known[np.argsort(seen[known], kind="stable")[: max(8, len(known) // 2)]]] = True
        self._know(self.vocabulary[keep])
        self.idf = np.log((1 + passages) / (1 + seen[keep])) + 1

    def _index(self, seen: np.ndarray) -> None:
        """The lexical index: each item's rarer words; held has an item's occurrences there."""
        self.size, rare = np.array([len(w) for w in self.words], np.int64), []
        for w, at in zip(self.words, self.numbers):
            own, n = np.unique(at, return_counts=True)
            own = own[np.argsort(seen[own], kind="stable")]
            n = np.bincount(at)[own]
            rare.append(w[np.isin(at, own[: np.searchsorted(np.cumsum(n), LEXICAL * len(w)) + 1])])
        self.held, self.index = np.array([len(w) for w in rare], float), Index(rare)

    def lexical(self, text: np.ndarray, number: np.ndarray, texts: int) -> Iterator[tuple[int, int, bool]]:
        """(text, item, whether the answer stands in the text) of every pair that the verification can accept; text: that of each known word, ascending (here, sections)."""
        n, step = len(self.size), max(1, CELLS // len(self.size))
        asked = np.array([len(x) or 1 for x in self.answers], float)
        for low in range(0, texts, step):
            x, y = np.searchsorted(text, (low, low + step))
            most, answers = (i.counts(text[x:y] - low, number[x:y], min(step, texts - low), n) for i in (self.index, self.answer_index))
            found = np.flatnonzero(most)
            i = found % n
            lacks, answer = self.held[i] - most[found], answers[found] / asked[i] >= ANSWER_SHARE
            may = lacks <= np.where(answer, 1 - PARAPHRASE, 1 - COPY) * self.size[i] + 1e-6
            yield from zip((found[may] // n + low).tolist(), i[may].tolist(), answer[may].tolist())

    def known(self, w: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocabulary, w), len(self.vocabulary) - 1)
        return at[self.vocabulary[at] == w]

    def shared(self, passages: np.ndarray, mine: np.ndarray, stride: np.ndarray, word: np.ndarray) -> np.ndarray:
        """How many known words of each stride in `mine` stand in the item passage beside it."""
        first = np.searchsorted(stride, mine)
        size = np.searchsorted(stride, mine, "right") - first
        of = np.repeat(np.arange(len(mine)), size)
        at = np.arange(len(of)) + np.repeat(first - (np.cumsum(size) - size), size)
        key = passages[of] * len(self.vocabulary) + word[at]
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.bincount(of[self.keys[place] == key], minlength=len(mine))

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, vocabulary numbers) of the known words."""
        return _find(self.vocabulary, self.bits, hashes)

    def finish(self, space: np.ndarray) -> Items:
        """Sets the space, and with it the items' own passages and answer words."""
        self.space, idf = space, self.idf
        vectors, item, own = [], [], []
        for i, w in enumerate(self.words):
            for a in range(0, max(1, len(w) - STRIDE), STRIDE):
                known = np.concatenate([np.unique(self.known(w[x : x + STRIDE])) for x in (a, a + STRIDE)])  # a word once in a stride, as in texts
                own.append(np.unique(known))
                vectors.append((space[known] * idf[known, None]).sum(axis=0))
                item.append(i)
            if not len(self.answers[i]):  # no answer column: the rarest words stand for it
                known = self.known(np.unique(w))
                self.answers[i] = self.vocabulary[known[np.argsort(-idf[known], kind="stable")[:ANSWER_WORDS]]]
        told = np.unique(np.concatenate([self.all_words, *self.answers])) if self.answers else self.all_words
        self.numbers = [np.searchsorted(told, w) for w in self.words]
        self.all_words, self.all_bits = told, np.zeros(1 << 20, bool)
        self.all_bits[(told >> U64(44)).astype(np.int64)] = True
        self.index, self.answer_index = self.index.among(told), Index(self.answers).among(told)
        self.number_of = np.full(len(told), -1)  # in the vocabulary of the space
        self.number_of[np.searchsorted(told, self.vocabulary)] = np.arange(len(self.vocabulary))
        z = np.array(vectors, np.float32).reshape(len(item), space.shape[1])
        self.length = np.maximum(np.linalg.norm(z, axis=1), 1e-9)
        self.vectors = (z / self.length[:, None]).T
        self.item_of = np.array(item, np.int64)
        self.known_words = np.array([len(k) for k in own], np.int64)
        self.keys = np.concatenate([i * len(self.vocabulary) + k for i, k in enumerate(own)]) if own else np.zeros(0, np.int64)
        return self


def _strides(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, one past the last, text number) of each stride of each text."""
    count = -(-np.diff(first) // STRIDE)
    doc = np.repeat(np.arange(len(count)), count)
    before = np.cumsum(count) - count
    start = first[doc] + STRIDE * (np.arange(len(doc)) - before[doc])
    return start, np.minimum(start + STRIDE, first[doc + 1]), doc


def _pairs_of(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passages as (stride, next stride of the text or -1): a text's last stride is a passage only if it is its only one."""
    n = len(doc)
    follows = np.zeros(n, bool)
    if n:
        follows[:-1] = doc[1:] == doc[:-1]
    alone = ~follows & np.append(True, doc[1:] != doc[:-1])[:n] if n else follows
    a = np.flatnonzero(follows | alone)
    return a, np.where(follows[a], a + 1, -1)


def _stride_words(at: np.ndarray, word: np.ndarray, starts: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """(stride, word number below wide) of the known words, which stand at `at`: a word once in a stride, by stride."""
    key = _distinct((np.searchsorted(starts, at, "right") - 1) * wide + word)
    return key // wide, key % wide


def _sums(rows: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """np.add.reduceat(rows, begin, axis=0) in whole rows, which it halves until each group has one; may change rows."""
    size = np.diff(np.append(begin, len(rows)))
    while len(size) and size.max() > 1:
        place = np.arange(len(rows)) - np.repeat(np.cumsum(size) - size, size)
        odd = np.flatnonzero(place & 1)
        rows[odd - 1] += rows[odd]
        rows, size = rows[place & 1 == 0], (size + 1) // 2
    return rows


def _stride_sums(stride: np.ndarray, word: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The strides with words, and the sum of the table's rows over the words of each."""
    begin = np.flatnonzero(np.append(True, stride[1:] != stride[:-1])) if len(stride) else stride
    return stride[begin], _sums(table[word], begin)


def _count(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        wide = max(1, len(items.vocabulary))
        total, passages = np.zeros(len(items.vocabulary), np.int64), 0
        for piece in chunks(batches):
            _, _, hashes, first = words(*flat(piece.column(1)))
            start, end, doc = _strides(first)
            a, b = _pairs_of(doc)
            stride, word = _stride_words(*items.lookup(hashes), start, wide)
            within = np.zeros(len(start), np.int64)  # passages that a stride is part of
            within[a] += 1
            within[b[b >= 0]] += 1
            total += np.bincount(word, weights=within[stride], minlength=len(total)).astype(np.int64)
            # a word of both strides of a passage was counted twice
            follows = np.zeros(len(start), bool)
            follows[a] = b >= 0
            key = stride * wide + word
            mine = np.flatnonzero(follows[stride])
            at = np.searchsorted(key, key[mine] + wide)
            at[at == len(key)] = 0
            total -= np.bincount(word[mine[key[at] == key[mine] + wide]], minlength=len(total))
            passages += len(a)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(hit, -1), pa.int32()), pa.array(np.append(total[hit], passages), pa.int64())], names=["word", "n"])

    return run


def _product(sent, groups: int):
    """Each task's A'(A W), in slices of SPAN rows: those rows whose word the task has seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        weights = items.idf.astype(np.float32)
        table = (items.space * items.idf[:, None]).astype(np.float32)
        out = np.zeros(items.space.shape, np.float64)
        for piece in chunks(batches):
            _, _, hashes, first = words(*flat(piece.column(1)))
            start, end, doc = _strides(first)
            stride, word = _stride_words(*items.lookup(hashes), start, max(1, len(items.vocabulary)))
            if not len(stride):
                continue
            a, b = _pairs_of(doc)
            mine, sums = _stride_sums(stride, word, table)
            square = np.bincount(stride, weights=items.idf[word] ** 2, minlength=len(start))
            norm = square[a]
            norm[b >= 0] += square[b[b >= 0]]
            # rows of A have length one, so the norm counts twice; by the first stride of each passage
            ahead, alone = np.zeros(len(start) + 1, np.float32), np.zeros(len(start), np.float32)
            ahead[a[b >= 0]] = 1 / np.maximum(norm[b >= 0], 1e-9)
            alone[a[b < 0]] = 1 / np.maximum(norm[b < 0], 1e-9)
            # a stride gets the sums of the passages it is part of: its own, and those of the strides beside it
            back = sums * (ahead[mine] + ahead[mine - 1] + alone[mine])[:, None]
            beside = np.flatnonzero(mine[1:] == mine[:-1] + 1)
            share = ahead[mine[beside]][:, None]
            back[beside] += share * sums[beside + 1]
            back[beside + 1] += share * sums[beside]
            order = np.argsort(word, kind="stable")
            grouped, begin = np.unique(word[order], return_index=True)
            out[grouped] += _sums(back[np.searchsorted(mine, stride)[order]], begin)
        out *= weights[:, None]
        part = TaskContext.get().partitionId()
        seen = out.any(axis=1)
        for low in range(0, len(out), SPAN):
            own = np.flatnonzero(seen[low : low + SPAN])
            if len(own):
                yield pa.RecordBatch.from_arrays([pa.array([low // SPAN], pa.int32()), pa.array([part % groups], pa.int32()), pa.array([own.astype(np.int32).tobytes()], pa.binary()), pa.array([out[low + own].tobytes()], pa.binary())], schema=_PART)

    return run


_PART = pa.schema([("slice", pa.int32()), ("part", pa.int32()), ("words", pa.binary()), ("rows", pa.binary())])


def _summed(parts: pa.Table) -> pa.Table:
    """One row that adds up the rows of a slice, a word at a time; a group has at most the square root of all tasks' parts."""
    total = None
    for at, rows in zip(parts.column("words"), parts.column("rows")):
        at, rows = np.frombuffer(at.as_py(), np.int32), np.frombuffer(rows.as_py(), np.float64)
        rows = rows.reshape(len(at), -1)
        if total is None:
            total, seen = np.zeros((SPAN, rows.shape[1])), np.zeros(SPAN, bool)
        total[at] += rows
        seen[at] = True
    own = np.flatnonzero(seen)
    return pa.table([[parts.column("slice")[0].as_py()], [parts.column("part")[0].as_py()], [own.astype(np.int32).tobytes()], [total[own].tobytes()]], schema=_PART)


def _multiply(docs: DataFrame, items: Items, groups: int) -> np.ndarray:
    """A'(A W) for W = items.space over all passages; the driver gets a vocabulary x rank matrix, which the block's words bound."""
    sent = docs.sparkSession.sparkContext.broadcast(items)
    shape = "slice int, part int, words binary, rows binary"
    parts = docs.mapInArrow(_product(sent, groups), shape).groupBy("slice", "part").applyInArrow(_summed, shape).groupBy("slice").applyInArrow(_summed, shape)
    out = np.zeros(items.space.shape)
    for r in parts.collect():
        at = r["slice"] * SPAN + np.frombuffer(bytes(r["words"]), np.int32)
        out[at] = np.frombuffer(bytes(r["rows"]), np.float64).reshape(len(at), -1)
    return out


_ROW = pa.schema([("doc_id", pa.int64()), ("item", pa.int32()), ("cosine", pa.float64()), ("common", pa.float64()), ("answer", pa.bool_())])


def _sections(first: np.ndarray, step: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, one past the last) of sections of each text: `step` words and `reach` more; a text of up to step + reach words is one."""
    size = np.diff(first)
    count = np.where(size > step + reach, -(-size // step), 1)
    text = np.repeat(np.arange(len(size)), count)
    begin = first[text] + step * (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count))
    return text, begin, np.where(count[text] > 1, np.minimum(begin + step + reach, first[text + 1]), first[text + 1])


def _retrieve(sent, cosine: float):
    """Finds candidates by both routes and verifies them, a section of a text and an item at a time.

    A passage is judged with as many words before and behind it as the item has. That window begins in one
    section's first `step` words and, as `reach` is the longest window, lies in the section.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        table = (items.space * items.idf[:, None]).astype(np.float32)
        known = [w.tolist() for w in items.numbers]
        counted = [np.unique(w, return_counts=True) for w in items.numbers]
        local = np.full(len(items.all_words), -1)
        enough = REACH * items.length
        fewest = max(1, math.ceil(SHARED * int(items.known_words.min())))
        reach = 2 * STRIDE + 2 * int(items.size.max())
        step = max(512, 2 * reach)
        for piece in chunks(batches):
            _, _, hashes, first = words(*flat(piece.column(1)))
            start, end, of = _strides(first)
            place, number = _find(items.all_words, items.all_bits, hashes)
            own = np.flatnonzero(items.number_of[number] >= 0)
            stride, word = _stride_words(place[own], items.number_of[number[own]], start, max(1, len(items.vocabulary)))
            mine, sums = _stride_sums(stride, word, table)
            sums = np.concatenate((sums, np.zeros((1, sums.shape[1]), sums.dtype)))
            row = np.full(len(start) + 1, len(mine))  # of a stride's sum; without words (or at -1, without a stride), the last
            row[mine] = np.arange(len(mine))
            held = np.bincount(stride, minlength=len(start) + 1)
            a, b = _pairs_of(of)
            doc = of[a]
            latent = lambda p: sums[row[a[p]]] + sums[row[b[p]]]
            begins, ends = start[a], end[np.where(b >= 0, b, a)]
            full = np.flatnonzero(held[a] + held[b] >= fewest)  # the others share too few words with any item
            text, low, high = _sections(first, step, reach)
            section_of = np.searchsorted(text, np.arange(len(first)))  # a text's first section
            many = np.diff(section_of) > 1
            wanted: dict[tuple[int, int], bool] = {}  # (section, item): whether the answer may stand there
            for at in range(0, len(full), 4096):
                z = latent(full[at : at + 4096])
                least = np.maximum(cosine * np.linalg.norm(z, axis=1), 1e-9)
                near = z @ items.vectors  # how far the passage reaches along the item
                p, q = np.divmod(np.flatnonzero(near >= np.maximum(least[:, None], enough)), near.shape[1])
                p = full[at + p]
                both = items.shared(q, a[p], stride, word) + np.where(b[p] >= 0, items.shared(q, b[p], stride, word), 0)
                real = both >= SHARED * items.known_words[q]
                p, q = p[real], items.item_of[q[real]]
                begin = np.maximum(begins[p] - items.size[q] - first[doc[p]], 0)
                wanted.update(dict.fromkeys(zip((section_of[doc[p]] + np.where(many[doc[p]], begin // step, 0)).tolist(), q.tolist()), True))
            spans = np.searchsorted(place, np.stack((low, high))).T
            size = spans[:, 1] - spans[:, 0]
            inside = np.arange(int(size.sum())) + np.repeat(spans[:, 0] - (np.cumsum(size) - size), size)
            for k, i, answer in items.lexical(np.repeat(np.arange(len(size)), size), number[inside], len(size)):
                wanted[k, i] = wanted.get((k, i), False) or answer
            spans = spans.tolist()
            passages = np.searchsorted(doc, np.arange(len(first)))
            best: dict[tuple[int, int], tuple] = {}
            for k, i in sorted(wanted):
                d, n, (x, y) = int(text[k]), len(known[i]), spans[k]
                own, times = counted[i]
                local[own] = np.arange(len(own))
                word_of = local[number[x:y]]
                local[own] = -1
                mine = np.flatnonzero(word_of >= 0)
                rows = np.arange(passages[d], passages[d + 1])
                lo, hi = np.maximum(begins[rows] - n, first[d]), np.minimum(ends[rows] + n, first[d + 1])
                if many[d]:
                    here = (lo >= low[k]) & (lo < low[k] + step)
                    rows, lo, hi = rows[here], lo[here], hi[here]
                before = np.zeros((len(mine) + 1, len(own)), np.int32)
                before[np.arange(1, len(mine) + 1), word_of[mine]] = 1
                before = np.cumsum(before, axis=0, dtype=np.int32)
                left, right = np.searchsorted(place[x:y][mine], lo), np.searchsorted(place[x:y][mine], hi)
                holds = np.minimum(before[right] - before[left], times).sum(axis=1)  # no subsequence is longer
                least_share = PARAPHRASE if wanted[k, i] else COPY
                done = set()
                for j in np.argsort(-holds, kind="stable").tolist():
                    if holds[j] / n < least_share or (d, i) in best and holds[j] / n <= best[d, i][1]:
                        break
                    if (window := (int(lo[j]), int(hi[j]))) in done:
                        continue
                    done.add(window)
                    answer = wanted[k, i] and bool(np.isin(items.answers[i], hashes[slice(*window)]).mean() >= ANSWER_SHARE)
                    if holds[j] / n < COPY and not answer:
                        continue
                    common = lcs_length(known[i], number[x:y][mine[left[j] : right[j]]].tolist()) / n
                    if (common >= COPY or common >= PARAPHRASE and answer) and common > best.get((d, i), (0, 0))[1]:
                        best[d, i] = 0.0, common, answer
            for d, i in best:
                rows = np.arange(passages[d], passages[d + 1])
                z = latent(rows)
                near = (z @ items.vectors[:, items.item_of == i]).max(axis=1) / np.maximum(np.linalg.norm(z, axis=1), 1e-9)
                best[d, i] = float(near.max()), *best[d, i][1:]
            ids = piece.column(0).to_pylist()
            yield batch(_ROW, [ids[d] for d, _ in best], [i for _, i in best], *(list(x) for x in (zip(*best.values()) if best else ((), (), ()))))

    return run


def _of_block(docs: DataFrame, items: Items, rank: int, cosine: float, seed: int = 5) -> DataFrame:
    spark = docs.sparkSession
    groups = math.isqrt(docs.rdd.getNumPartitions()) + 1
    counted = docs.mapInArrow(_count(spark.sparkContext.broadcast(items)), "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    n = {r["word"]: r["n"] for r in counted}
    seen = np.array([n.get(i, 0) for i in range(len(items.vocabulary))], float)
    items.weigh(seen, n.get(-1, 0))
    rank = min(rank, len(items.vocabulary))
    items.space = np.random.default_rng(seed).normal(size=(len(items.vocabulary), rank))
    # items are passages too, so their directions are in the space even if no document has them
    column = [items.known(w) for w in items.words]
    weights = [items.idf[c] / max(np.linalg.norm(items.idf[c]), 1e-9) for c in column]
    for _ in range(2):
        product = _multiply(docs, items, groups)
        for c, v in zip(column, weights):
            np.add.at(product, c, v[:, None] * (v @ items.space[c]))
        basis, values, _ = np.linalg.svd(product, full_matrices=False)
        items.space = basis
    items.finish(basis.astype(np.float32))
    return docs.mapInArrow(_retrieve(spark.sparkContext.broadcast(items), cosine), "doc_id long, item int, cosine double, common double, answer boolean")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", answer: str | None = None, rank: int = RANK, cosine: float = COSINE, block: int = ITEMS) -> DataFrame:
    """doc_id, item_id, cosine, common, answer: one row for each document and benchmark item it contains.

    common is the longest common subsequence as a share of the item's words. Null or empty texts and items, and items without
    words, match nothing; rows with a null doc_id are not reported. Repeated documents or items are found as one. Other columns are ignored;
    an empty table on either side gives an empty result. The lexical route finds whatever the verification accepts, so the
    rows and all columns but cosine do not depend on which items share a block.
    """
    spark: SparkSession = docs.sparkSession
    docs = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = spark.createDataFrame([], "doc_id long, item_id long, cosine double, common double, answer boolean")
    chosen = benchmark.where(F.col(item_id).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text"), (F.col(answer) if answer else F.lit(None)).cast("string").alias("answer"))

    def blocks() -> Iterator[list]:
        rows: list = []
        held = 0
        for r in chosen.toLocalIterator():
            size = len(r["text"].split()) + 1
            if rows and (len(rows) == block or held + size > ITEM_WORDS):
                yield rows
                rows, held = [], 0
            rows.append(r)
            held += size
        if rows:
            yield rows

    for rows in blocks():
        items = Items([r["id"] for r in rows], [r["text"] for r in rows], [r["answer"] for r in rows])
        if not items.ids:
            continue
        ids = spark.createDataFrame(list(enumerate(items.ids)), "item int, item_id long")
        hits = _of_block(docs, items, rank, cosine)
        found = found.unionByName(hits.join(F.broadcast(ids), "item").select("doc_id", "item_id", "cosine", "common", "answer"))
    return found.groupBy("doc_id", "item_id").agg(F.max("cosine").alias("cosine"), F.max("common").alias("common"), F.bool_or("answer").alias("answer"))
