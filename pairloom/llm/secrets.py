"""Secret scanning with a trigram inverted index, in DataFrame functions only.

Each rule's regular expression is compiled to a Boolean query over lower-case trigrams that any match must
contain. The index keeps, for the rules' trigrams, postings in blocks of 65,536 ids;
a block's lists are intersected and united by the query, and only candidate texts meet the regular expression.
Rules without mandatory trigrams (hex runs) scan every text. Positions are code points: the running sums of the
lengths of what `split` leaves between matches and of the matches. Sums and maxima run by doubling, so a text's cost
grows with its length and, but for a logarithm, with its matches.

The candidates are a narrow table (an id and a bit for each rule). It is counted: up to FEW rows are sent to the scan of the
texts, which then are not shuffled; beyond that the texts are joined by a shuffle.
"""

from __future__ import annotations

import re._constants as C
import re._parser as parser
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._spark import cut

BLOCK = 1 << 16
FEW = 1 << 19
#: Code points of a piece of a text that is put together anew.
PIECE = 4096


def either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join([*map(either_case, ("password", "passwd", "secret", "token")), f"{either_case('api')}_?{either_case('key')}"])
#: name -> (regular expression, group whose length counts, least length). Base rules first, in the order of ties.
BASE = {
    "assign": (f"({_NAMES})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    "access": ("AKIA[A-Z0-9]+", 0, 18),
    "hex": ("[0-9a-f]{16,}", 0, 16),
}
ADDED = {
    "pem": ("-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 0),
    "forge": ("gh[opsru]_[A-Za-z0-9]{36,}", 0, 0),
    "chat": ("xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    "jwt": ("eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]+", 0, 0),
    "payment": ("sk_live_[A-Za-z0-9]{16,}", 0, 0),
    "login": ("[a-z]{2,10}://[A-Za-z0-9._-]+:[A-Za-z0-9._!%-]{6,}@", 0, 0),
}
RULES = BASE | ADDED
#: A private key's end; where a text's key has none, its body ends at a line break (perhaps written as \n) before what is no key line.
KEY_END = "-----END [A-Z ]{0,20}PRIVATE KEY-----"
KEY_BREAK = r"(?:[\r\n]|\\[rn])(?![ \t]*(?:[\r\n]|\\[rn]|[A-Za-z0-9-]+: |[A-Za-z0-9+/=]{16,}|[A-Za-z0-9+/=]+[ \t]*(?:[\r\n\\]|$)))"

# A query is True (no condition), a trigram, ("and", [...]) or ("or", [...]).


def _join(kind: str, parts: list):
    if kind == "and":
        parts = [p for p in parts if p is not True]
        return True if not parts else parts[0] if len(parts) == 1 else ("and", parts)
    if any(p is True for p in parts) or not parts:
        return True
    terms = [frozenset(p[1]) if p[0] == "and" and all(isinstance(x, str) for x in p[1]) else frozenset([p]) if isinstance(p, str) else None for p in parts]
    parts = [p for i, (p, t) in enumerate(zip(parts, terms)) if t is None or not any(o is not None and (o < t or o == t and j < i) for j, o in enumerate(terms))]  # A or (A and B) is A
    return parts[0] if len(parts) == 1 else ("or", parts)


def _of_strings(strings: set[str]):
    return _join("or", [True if len(s) < 3 else _join("and", sorted({s[i : i + 3] for i in range(len(s) - 2)})) for s in sorted(strings)])


def _walk(nodes, most: int = 64):
    """(every string the nodes can match, lower-cased, or None; query)."""
    exact: set[str] | None = {""}
    run, parts = {""}, []

    def flush():
        nonlocal run, exact
        parts.append(_of_strings(run))
        run, exact = {""}, None

    for op, arg in nodes:
        own: set[str] | None = None
        query = True
        if op is C.LITERAL:
            own = {chr(arg).lower()}
        elif op is C.IN and all(k is C.LITERAL for k, _ in arg):
            own = {chr(v).lower() for _, v in arg}
        elif op is C.SUBPATTERN:
            own, query = _walk(arg[3])
        elif op is C.BRANCH:
            kinds = [_walk(x) for x in arg[1]]
            own = set().union(*(s for s, _ in kinds)) if all(s is not None for s, _ in kinds) else None
            query = _join("or", [q for _, q in kinds])
        elif op is C.MAX_REPEAT:
            least, greatest, inner = arg
            strings, inside = _walk(inner)
            if strings is not None and greatest == 1:
                own = strings | {""} if least == 0 else strings
            elif strings is not None and least == greatest and least <= 8:
                own = reduce(lambda s, _: {a + b for a in s for b in strings}, range(least), {""})
            elif least and strings is not None and len(strings) * len(run) <= most:
                run = {a + b for a in run for b in strings}  # once for certain, then unknown
                flush()
                continue
            elif least:
                query = inside
        if own is not None and len(own) * len(run) <= most:
            run = {a + b for a in run for b in own}
        else:
            flush()
            parts.append(query if own is None else _of_strings(own))
    if exact is not None:
        return run, _of_strings(run)
    parts.append(_of_strings(run))
    return None, _join("and", parts)


def trigram_query(pattern: str):
    """The Boolean query over lower-case trigrams that every text with a match satisfies."""
    return _walk(parser.parse(pattern))[1]


def trigrams_of(query) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


def _evaluate(query, lists: str = "lists") -> Column:
    if isinstance(query, str):
        return F.coalesce(F.col(lists)[query], F.array().cast("array<bigint>"))
    parts = [_evaluate(q, lists) for q in query[1]]
    return reduce(F.array_intersect if query[0] == "and" else F.array_union, parts)


def candidates(docs: DataFrame, rules: dict = RULES) -> DataFrame:
    """doc_id, rules: the rules whose trigram query a text satisfies, out of those that have one, as bits by their place in `rules`."""
    queries = {name: q for name, (pattern, _, _) in rules.items() if (q := trigram_query(pattern)) is not True}
    wanted = sorted(set().union(*map(trigrams_of, queries.values())))
    low = docs.where("doc_id is not null and text is not null").select("doc_id", F.lower("text").alias("low"))
    present = low.select("doc_id", F.explode(F.filter(F.array(*map(F.lit, wanted)), lambda t: F.contains(F.col("low"), t))).alias("trigram"))
    postings = present.groupBy(F.floor(F.col("doc_id") / BLOCK).alias("block"), "trigram").agg(F.collect_set("doc_id").alias("ids"))
    blocks = postings.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "ids"))).alias("lists"))
    bits = F.create_map(*(F.lit(x) for i, name in enumerate(rules) for x in (name, 1 << i))).cast("map<string, bigint>")
    hits = blocks.select(F.explode(F.array(*(F.struct(F.lit(name).alias("rule"), _evaluate(q).alias("ids")) for name, q in queries.items()))).alias("hit"))
    return hits.select("hit.rule", F.explode("hit.ids").alias("doc_id")).groupBy("doc_id").agg(F.bit_or(F.element_at(bits, F.col("rule"))).alias("rules"))


def running(values: str, step: str) -> Column:
    """The array of `step` (an SQL expression of a, b that is associative) over all values up to each, in log2(size) passes."""
    return F.expr(
        f"""aggregate(sequence(0, 30), {values}, (p, k) -> if(size(p) > shiftleft(1, k),
            concat(slice(p, 1, shiftleft(1, k)), zip_with(slice(p, 1, size(p) - shiftleft(1, k)), slice(p, shiftleft(1, k) + 1, size(p) - shiftleft(1, k)), (a, b) -> {step})), p))"""
    )


SPANS = "array<struct<start: bigint, kind: int, end: bigint, name: string>>"


def _found(rule: str, order: int, ends: str, matches: str, counted: str, least: int) -> Column:
    """Array of (start, kind, end, name) of one rule's matches; `ends` holds where each ends.

    Columns are arguments of the array functions, never captured in their lambdas, where the optimizer could put their making.
    """
    sized = f"zip_with({matches}, {counted}, (m, c) -> named_struct('n', char_length(m), 'c', char_length(c)))"
    spans = f"zip_with({ends}, {sized}, (e, x) -> named_struct('start', e - x.n, 'kind', {order}, 'end', e, 'name', '{rule}', 'c', x.c))"
    return F.expr(f"transform(filter({spans}, s -> s.c >= {least}), s -> named_struct('start', s.start, 'kind', s.kind, 'end', s.end, 'name', s.name))")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: dict = RULES, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, the columns in `keep`, and found: array of (start, kind, end, name) sorted by start, then rule order.

    Null texts count as empty and have no spans; a null doc_id cannot be in the index, so its text meets every
    rule. Rows that share a doc_id share its candidate rules and are each scanned on their own text. Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *(F.col(c).alias(f"kept_{c}") for c in keep))
    indexed = [n for n, (p, _, _) in rules.items() if trigram_query(p) is not True]
    near = cut(candidates(docs, rules).withColumnRenamed("rules", "rules_"))
    out = docs.join(F.broadcast(near) if near.count() <= FEW else near, "doc_id", "left")
    wanted = {n: F.coalesce(F.col("rules_").bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.lit(False)) | F.col("doc_id").isNull() if n in indexed else F.lit(True) for i, n in enumerate(rules)}
    nothing = F.array().cast("array<string>")
    kept = [F.col(f"kept_{c}") for c in keep]
    cols = []
    for n, (pattern, group, _) in rules.items():
        hit = wanted[n] & F.col("text").rlike(pattern)
        cols += [F.when(hit, F.split("text", pattern, -1)).otherwise(nothing).alias(f"between_{n}"), F.when(hit, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(nothing).alias(f"match_{n}")]
        if group:
            cols.append(F.when(hit, F.regexp_extract_all("text", F.lit(pattern), F.lit(group))).otherwise(nothing).alias(f"group_{n}"))
    out = out.select("doc_id", "text", *kept, *cols)
    sizes = [F.expr(f"zip_with(slice(between_{n}, 1, size(match_{n})), match_{n}, (b, m) -> cast(char_length(b) + char_length(m) as bigint))").alias(f"size_{n}") for n in rules]
    lists = [c for n, (_, group, _) in rules.items() for c in ((f"match_{n}", f"group_{n}") if group else (f"match_{n}",))]
    out = out.select("doc_id", "text", *kept, *lists, *sizes)
    found = [
        F.when(F.size(f"match_{n}") > 0, _found(n, i, f"ends_{n}", f"match_{n}", f"group_{n}" if g else f"match_{n}", least)).otherwise(F.expr(f"cast(array() as {SPANS})"))
        for i, (n, (_, g, least)) in enumerate(rules.items())
    ]
    out = out.select("doc_id", "text", *kept, *lists, *(running(f"size_{n}", "a + b").alias(f"ends_{n}") for n in rules))
    return out.select("doc_id", "text", *(F.col(f"kept_{c}").alias(c) for c in keep), F.array_sort(F.concat(*found)).alias("found"))


def _written(found: str) -> Column:
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string"))))


def report(scanned: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of a scan."""
    base = F.filter("found", lambda s: s["kind"] < len(BASE))
    counts = [F.expr(f"cast(size(filter(found, s -> s.kind = {i})) as bigint)").alias(f"n_{n}") for i, n in enumerate(BASE)]
    return scanned.select("doc_id", *counts, base.alias("base"), "found").select("doc_id", *(f"n_{n}" for n in BASE), F.sha2(_written("base"), 256).alias("base_sha256"), _written("found").alias("spans"))


def _body(end: Column) -> Column:
    """How many characters behind a private key's header belong to the key: up to its END line or, without one, the key lines."""
    own = F.substring_index(F.substring(F.col("text"), (end + 1).cast("int"), F.lit(2147483647)), "-----BEGIN ", 1)
    stop = F.regexp_extract(own, KEY_END, 0)
    size = lambda pattern: F.char_length(F.split(own, pattern, 2)[0])
    return F.when(stop != "", size(KEY_END) + F.char_length(stop)).when(own.rlike(r"^[ \t]*(?:[\r\n]|\\[rn])"), size(KEY_BREAK)).otherwise(0).cast("long")


def _between(a: str, b: str) -> str:
    """SQL for the code points a .. b-1 of the text, put together from its `pieces`."""
    return f"""case when {b} <= {a} then '' when {a} div {PIECE} = {b} div {PIECE} then substring(get(pieces, cast({a} div {PIECE} as int)), cast({a} % {PIECE} + 1 as int), cast({b} - {a} as int))
        else concat(substring(get(pieces, cast({a} div {PIECE} as int)), cast({a} % {PIECE} + 1 as int), {PIECE}),
            array_join(slice(pieces, cast({a} div {PIECE} + 2 as int), cast({b} div {PIECE} - {a} div {PIECE} - 1 as int)), ''), coalesce(substring(get(pieces, cast({b} div {PIECE} as int)), 1, cast({b} % {PIECE} as int)), '')) end"""


def redact(scanned: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The scan's rows with their text redacted, without `found`: every span (overlapping ones merged) is replaced by `mark`.

    The scan reports a private key by its header; here its span runs on through the body and the END line.
    """
    found = F.transform("found", lambda s: F.when(s["name"] == "pem", s.withField("end", s["end"] + _body(s["end"]))).otherwise(s))
    pieces = F.when(F.size("found") > 0, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)))
    names = [c for c in scanned.columns if c not in ("text", "found")]
    out = scanned.select(*names, "text", found.alias("spans_"), pieces.alias("pieces"), F.char_length("text").cast("long").alias("size_"))
    out = out.withColumn("far", F.expr("transform(spans_, s -> s.end)")).withColumn("far", running("far", "greatest(a, b)"))
    parts = F.expr(f"""transform(spans_, (s, i) -> if(s.start >= coalesce(get(far, i - 1), 0), concat({_between("coalesce(get(far, i - 1), 0L)", "s.start")}, '{mark}'), ''))""")
    new = F.when(F.size("spans_") == 0, F.col("text")).otherwise(F.concat(F.array_join(parts, ""), F.expr(_between("element_at(far, -1)", "size_"))))
    return out.withColumn("text", new).select([c for c in scanned.columns if c != "found"])


def oracle() -> str:
    """DuckDB SQL for report(scan(documents)): every regular expression meets every text."""
    parts = []
    for i, (name, (pattern, group, least)) in enumerate(RULES.items()):
        p = pattern.replace("'", "''")
        parts.append(f"""select doc_id, '{name}' as name, {i} as kind, j, g, coalesce(list_sum([length(x) for x in b[1:j]]), 0) + coalesce(list_sum([length(x) for x in m[1:j-1]]), 0) as s, length(m[j]) as n from
            (select doc_id, m, b, unnest(range(1, len(m) + 1)) as j, unnest(g) as g from (select doc_id, regexp_extract_all(t, '{p}', 0) as m, string_split_regex(t, '{p}') as b, regexp_extract_all(t, '{p}', {group}) as g from docs)) where length(g) >= {least}""")
    return f"""with docs as (select doc_id, coalesce(text, '') as t from documents),
        hits as ({' union all '.join(parts)}),
        named as (select doc_id, kind, s, name || ':' || cast(s as bigint) || ':' || cast(s + n as bigint) as w from hits),
        per as (select doc_id, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex,
            coalesce(string_agg(w, ',' order by s, kind) filter (kind < {len(BASE)}), '') as base, string_agg(w, ',' order by s, kind) as spans from named group by doc_id)
        select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from docs left join per using (doc_id)"""
