import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from pairloom.llm import _text, decontaminate, hamming, packing, pii, suffix_dedup
from tests.llm import brute

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB \t\né漢.\x0b\xa0", max_size=30)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    data, offsets = _text.flat(pa.array(texts, pa.string()))
    starts, ends, hashes, first = _text.words(data, offsets)
    for i, t in enumerate(texts):
        got = [_text.LOWER[data[a:b]].tobytes().decode() for a, b in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]])]
        assert got == brute.words(t)
    by = {}
    for a, b, h in zip(starts, ends, hashes):
        assert by.setdefault(int(h), _text.LOWER[data[a:b]].tobytes()) == _text.LOWER[data[a:b]].tobytes()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(["a", "B", " ", "  ", "\n", "é", "1", "'s", "漢", "😀", "\x1c", "\x85", "\xa0", "<|endoftext|>", "$$"]), max_size=20).map("".join)), max_size=6))
def test_tokens_are_the_tokenizers(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    ids, first = packing.token_ids(*_text.flat(pa.array(texts, pa.string())), path)
    for i, t in enumerate(texts):
        assert ids[first[i] : first[i + 1]].tolist() == [*whole.encode(t or "", add_special_tokens=False).ids, 0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_best_fit_takes_the_tightest_window(lengths):
    where, offset = packing.best_fit_decreasing(np.array(lengths, np.int64), 64)
    rooms = []  # plain form: scan all windows
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [r for r in rooms if r >= lengths[i]]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - lengths[i])
        else:
            rooms.append(64 - lengths[i])
    assert len(set(where.tolist())) == len(rooms)
    fill = np.zeros(len(rooms), int)
    np.add.at(fill, where, lengths)
    assert sorted(64 - fill) == sorted(rooms)
    for w in set(where.tolist()):
        at = 0
        for i in sorted(np.flatnonzero(where == w), key=lambda i: offset[i]):
            assert offset[i] == at
            at += lengths[i]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=8, max_size=8).map(lambda b: bytes(x % 2 + 97 for x in b)), min_size=1, max_size=40), st.data())
def test_suffix_sort(pieces, data):
    text = np.frombuffer(b"".join(pieces), np.uint8)
    group = np.sort(np.array(data.draw(st.lists(st.integers(0, 3), min_size=len(pieces), max_size=len(pieces)))))
    starts = np.arange(len(pieces)) * 8
    order, classes = suffix_dedup.SuffixSort(text, 8).classes(starts, group)
    keys = [(int(group[i]), pieces[i]) for i in order]
    assert keys == sorted(keys)
    assert len(set(classes.tolist())) == len(set(keys))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=80), st.lists(st.integers(0, 4), max_size=80))
def test_common_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    assert decontaminate.lcs_length(a, b) == row[-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=60, unique=True), st.integers(0, 2**64 - 1), st.integers(1, 12))
def test_multi_index_is_exact(codes, query, k):
    codes = np.array(codes, np.uint64)
    found, d = hamming.MultiIndex(codes).search(np.uint64(query), k, np.ones(len(codes), np.int64))
    far = np.bitwise_count(codes ^ np.uint64(query)).astype(int)
    limit = np.sort(far)[min(k, len(codes)) - 1]
    assert sorted(found.tolist()) == np.flatnonzero(far <= limit).tolist()
    assert (far[found] == d).all()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a@.b-é9+", max_size=30))
def test_emails_match_the_pattern(text):
    import re

    assert pii.emails(text) == [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
