"""Plain-Python forms of the operators' contracts."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from math import log10

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text):
    return WORD.findall(lower(text))


def repeats(rows, size=50):
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256)."""
    first, out = {}, {}
    rows = [(i, (t or "").encode()) for i, t in rows]
    for i, b in rows:
        for k in range(len(b) - size + 1):
            first[b[k : k + size]] = min(first.get(b[k : k + size], i), i)
    for i, b in rows:
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if first[b[k : k + size]] < i:
                gone[k : k + size] = b"\1" * size
        kept = bytes(x for x, y in zip(b, gone) if not y)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def near(rows, percent):
    """doc_id -> (n_shingles, component_id)."""
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in sets.items():
        for j, both in Counter(j for x in s for j in where[x] if j < i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def discounts(counts):
    """Good-Turing factors d[r] = ((r+1) n[r+1] / (r n[r]) - k) / (1 - k), k = 6 n[6] / n[1], for r = 1..5; else 1 - D / r, D = n1 / (n1 + 2 n2) within 0.1 and 0.9."""
    n = Counter(counts)
    part = min(max(n[1] / (n[1] + 2 * n[2]), 0.1), 0.9) if n[1] else 0.5
    plain = {r: 1 - part / r for r in range(1, 6)}
    if not all(n[r] for r in range(1, 7)) or 6 * n[6] >= n[1]:
        return plain
    k = 6 * n[6] / n[1]
    d = {r: ((r + 1) * n[r + 1] / (r * n[r]) - k) / (1 - k) for r in range(1, 6)}
    return d if all(0 < x < 1 for x in d.values()) else plain


def katz(rows, checked=40):
    """doc_id -> (n_tokens, n_known, train_tokens, base_score, score): trigrams over bigrams over unigrams, by recursion on the history."""
    tokens = lambda t: [*words(t), None]
    grams = {1: Counter(), 2: Counter(), 3: Counter()}
    for i, t in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 5 != 1:
            padded = [0, 0, *tokens(t)]
            for k in range(2, len(padded)):
                for order in grams:
                    grams[order][tuple(padded[k - order + 1 : k + 1])] += 1
    n, v = sum(grams[1].values()), len(grams[1])
    d = {order: discounts(grams[order].values()) for order in (2, 3)}
    after = defaultdict(list)
    for order in (2, 3):
        for g, c in grams[order].items():
            after[g[:-1]].append((g[-1], c))
    state = {}

    def left(history):
        """(divisor, alpha)."""
        if history not in state:
            found = after[history]
            kept, count = sum(c * d[len(history) + 1].get(c, 1) for _, c in found), sum(c for _, c in found)
            divisor = count + 1 if kept >= count - 1e-9 else count
            state[history] = divisor, (1 - kept / divisor) / (1 - sum(p(w, history[1:]) for w, _ in found))
        return state[history]

    def p(w, history):
        if not history:
            return (grams[1][w,] + 0.5) / (n + 0.5 * (v + 1))
        if history not in after:
            return p(w, history[1:])
        c = grams[len(history) + 1][(*history, w)]
        return c * d[len(history) + 1].get(c, 1) / left(history)[0] if c else left(history)[1] * p(w, history[1:])

    for history in sorted(after, key=str)[:: max(1, len(after) // checked)]:  # each distribution sums to one, with one unknown word
        assert abs(sum(p(w, history) for (w,) in grams[1]) + p("never seen", history) - 1) < 1e-9
    out = {}
    for i, t in rows:
        padded = [0, 0, *tokens(t)]
        scores = [(log10(p(w, ())), log10(p(w, (padded[k], padded[k + 1])))) for k, w in enumerate(padded[2:])]
        out[i] = (len(scores), sum(grams[1][w,] > 0 for w in padded[2:]), n, sum(a for a, _ in scores), sum(b for _, b in scores))
    return out


SECRET = {
    "assign": (re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), 2, 12),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile("[0-9a-f]+"), 0, 16),
}


def secrets(text):
    """(counts, sha256) of the base spans."""
    found = [(m.start(), o, k, m.end()) for o, (k, (p, g, least)) in enumerate(SECRET.items()) for m in p.finditer(text or "") if len(m.group(g)) >= least]
    joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))
    return tuple(sum(k == x for _, _, x, _ in found) for k in SECRET), hashlib.sha256(joined.encode()).hexdigest()


PERSONAL = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def _personal(kind, match):
    digits = [int(c) for c in match if c in "0123456789"]
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        doubled = [d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def personal(text):
    """(counts, joined base spans)."""
    found = [(kind, m.start(), m.end()) for kind, p in PERSONAL.items() for m in p.finditer(text or "") if _personal(kind, m.group())]
    return tuple(sum(k == kind for k, _, _ in found) for kind in PERSONAL), ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def best_fit(lengths, window):
    """How full each window is: longest first, into the fullest window with room, by looking at all of them."""
    fill = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, x in enumerate(fill) if x + n <= window]
        if fits:
            fill[max(fits, key=lambda k: fill[k])] += n
        else:
            fill.append(n)
    return sorted(fill)


def common(a, b):
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def contaminated(texts, items):
    """(doc, item) -> share: every item against every passage of 32 words, 16 apart, with as many words around it as the item has."""
    out = {}
    for d, text in texts:
        w = words(text)
        strides = [(a, min(a + 16, len(w))) for a in range(0, len(w), 16)]
        passages = [(x[0], y[1]) for x, y in zip(strides, strides[1:])] or strides
        for i, item, answer in items:
            own, asked = words(item), words(answer)
            for a, b in passages if own else ():
                window = w[max(0, a - len(own)) : b + len(own)]
                share = common(own, window) / len(own)
                answered = bool(asked) and sum(x in set(window) for x in asked) / len(asked) >= 0.8
                if share >= 0.6 or share >= 0.4 and answered:
                    out[d, i] = max(share, out.get((d, i), 0))
    return out


def _mixed(x):
    full = (1 << 64) - 1
    x ^= x >> 32
    for _ in range(2):
        x = x * 0xD6E8FEB86659FD93 & full
        x ^= x >> 32
    return x


def polynomial(raw):
    """Sum of a fixed odd-looking number for each byte times a base to its place, modulo 2**64; not yet mixed."""
    full = (1 << 64) - 1
    return sum((((b + 1) * 0xD6E8FEB86659FD93 & full) ^ 0xA0761D6478BD642F) * pow(0x9E3779B97F4A7C15, k, 1 << 64) for k, b in enumerate(raw)) & full


def tails(text, model):
    """Probability of reaching each grade: shares of hashed words, shapes and pairs of shapes, and three counts in steps."""
    import math

    raw = [m.group().encode() for m in WORD.finditer(text or "")]
    low = [lower(w.decode()).encode() for w in raw]
    kind = lambda b: ord("0") if 48 <= b < 58 else ord("A") if 65 <= b < 91 else ord("a") if 97 <= b < 123 or b >= 128 else b
    shapes = []
    for w in raw:
        k = [kind(b) for b in w]
        shapes.append(_mixed(polynomial([x for i, x in enumerate(k) if i == 0 or x != k[i - 1]])))
    n, full = len(raw), (1 << 64) - 1
    z = 0.0
    for s, w in zip(shapes, low):
        z += (model.w[s & 4095] + model.w[8192 + (_mixed(polynomial(w)) >> 20) % 8192]) / n
    for a, b in zip(shapes, shapes[1:]):
        z += model.w[4096 + (_mixed((a * 3 + b) & full) & 2047)] / n
    again = sum(a == b for a, b in zip(low, low[1:]))
    for t in (math.ceil(10 * again / max(n, 1)), 16 + math.ceil(10 * len(set(low)) / max(n, 1)), 32 + min(15, int(math.log2(n + 1)))):
        z += model.w[6144 + t]
    return [1 / (1 + math.exp(-(z - t))) for t in model.thresholds]


def toxicity(text, model):
    """Logistic of a bias, a weight for each feature and the product of the factors of each pair of features."""
    import math

    buckets = set()
    for w in words(text):
        raw = w.encode()
        for _ in range(4):
            if len(raw) > 1 and raw[-1:] in b".,;:!?*#$%&\"')(|":
                raw = raw[:-1]
        for salt, size in enumerate((0, 4, 5, 6)):
            if len(raw) > size:
                buckets.add(_mixed((polynomial(raw[:size] if size else raw) + salt + 1) & ((1 << 64) - 1)) & ((1 << 20) - 1))
    own = sorted({int(model.table[b]) for b in buckets} - {-1})
    m = model.machine
    z = m.bias + sum(m.w[i] for i in own) + sum(float(m.v[i] @ m.v[j]) for k, i in enumerate(own) for j in own[:k])
    return 1 / (1 + math.exp(-max(-30, min(30, z))))
