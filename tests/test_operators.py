import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.functions import cues, names
from pairloom import functions as E
from pairloom.operators import assemble, leakage, logs, matching, pairs, scoring, structure, texts


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_nan_fails_every_bound(spark):
    df = spark.createDataFrame([("x", float("nan")), ("y", 300.0), ("z", None)], "id string, area double")
    assert rows(pairs.quality_filter(df, at_least={"area": 200.0}), "id") == [("y",)]


def test_canonical_carries_sides(spark):
    df = spark.createDataFrame([("B", "A", 1, 2), ("A", "B", 3, 4)], "acc_a string, acc_b string, va int, vb int")
    assert rows(pairs.canonical(df, carried={"va": "vb"}), "acc_a", "acc_b", "va", "vb") == [("A", "B", 2, 1), ("A", "B", 3, 4)]


def test_any_true_truth_table(spark):
    values = [True, False, None]
    df = spark.createDataFrame(list(itertools.product(values, values)), "x boolean, y boolean")
    got = {(r.x, r.y): r.z for r in df.withColumn("z", leakage.any_true("x", "y")).collect()}
    for x, y in got:
        want = True if x or y else False if x is False or y is False else None
        assert got[x, y] is want


def test_clean_and_leaked(spark):
    values = [True, False, None]
    df = spark.createDataFrame([(t, x, y) for t in ("positive", "negative") for x in values for y in values], "type string, date_leaked boolean, homolog_leaked boolean")
    for r in df.withColumns({"clean": leakage.clean(), "leaked": leakage.leaked()}).collect():
        if r.type == "positive":
            assert r.clean == (r.date_leaked is False and r.homolog_leaked is False)
        else:
            assert r.clean == (r.date_leaked is False and r.homolog_leaked is not True)


def test_first_reason_wins(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    got = assemble.first_reason(df, {"small": "x < 3", "positive": "x > 0"})
    assert [r.drop_reason for r in got.collect()] == ["small", "positive", ""]


def test_selected_count_uses_doubles(spark):
    df = spark.createDataFrame([(2, 2), (100, 300), (400, 300), (1, 1)], "a long, b long")
    assert [r[0] for r in df.select(E.selected_count("a", "b", 0.25, 70)).collect()] == [1, 25, 70, 1]


def test_worked_score(spark):
    table = spark.createDataFrame([(0, 1, 4.0, 0.9), (0, 2, 3.0, 0.5), (1, 2, 2.0, 0.2), (3, 3, 5.0, 0.7), (2, 4, 1.0, 0.1)], "feature_i long, feature_j long, count double, npmi double")
    feats = spark.createDataFrame([("A", 0, 0), ("A", 0, 3), ("A", 1, 2), ("A", 1, 5), ("B", 0, 1), ("B", 0, 4), ("B", 1, 3), ("B", 1, 5)], "protein string, residue long, feature long")
    asked = spark.createDataFrame([("p", "A", "B"), ("q", "A", "C")], "pair_id string, id_a string, id_b string")
    got = {r.pair_id: r for r in scoring.score_pairs(asked, feats, scoring.symmetric(table), rho=1.0).collect()}
    assert got["p"].score == pytest.approx(0.8) and got["p"].n_selected == 2 and got["p"].n_positive == 2
    assert got["q"].status == "missing_features_b" and got["q"].score != got["q"].score
    assert scoring.symmetric(table, 2.5).count() == 5


def test_verdicts_are_conservative(spark):
    df = spark.createDataFrame([("k", 1, True), ("k", 2, False), ("k", 3, False), ("m", 1, True), ("m", 2, True)], "k string, n int, usable boolean")
    got = {r.k: (r.n, r.usable, r.n_dropped) for r in logs.dedup_verdicts(df, ["k"], "usable", ["n"]).collect()}
    assert got == {"k": (2, False, 2), "m": (1, True, 1)}


def test_later_errors_do_not_displace_successes(spark):
    df = spark.createDataFrame([("k", 1, True), ("k", 2, False), ("m", 1, False), ("m", 2, False)], "k string, n int, ok boolean")
    assert rows(logs.merge_runs(df, ["k"], ["n"], F.col("ok")), "k", "n") == [("k", 1), ("m", 2)]
    assert rows(logs.latest(df, ["k"], ["n"]), "k", "n") == [("k", 2), ("m", 2)]


def test_match_sizes_against_brute_force():
    r = random.Random(1)
    for _ in range(200):
        a = sorted(r.randint(0, 30) for _ in range(r.randint(1, 4)))
        b = sorted(r.randint(0, 30) for _ in range(r.randint(1, 5)))
        got = matching.match_sizes(np.array(a, float), np.array(b, float))
        used = [j for j in got if j >= 0]
        assert len(set(used)) == len(used) == min(len(a), len(b))
        cost = sum(abs(a[i] - b[j]) for i, j in enumerate(got) if j >= 0)
        small, large = (a, b) if len(a) <= len(b) else (b, a)
        assert cost == min(sum(abs(x - y) for x, y in zip(small, p)) for p in itertools.permutations(large, len(small)))


def test_hungarian_against_brute_force():
    r = np.random.default_rng(2)
    for _ in range(100):
        n = int(r.integers(1, 5))
        cost = r.integers(0, 20, (n, int(r.integers(n, 6)))).astype(float)
        got = matching.hungarian(cost)
        assert len(set(got)) == n
        assert cost[np.arange(n), got].sum() == min(cost[np.arange(n), list(p)].sum() for p in itertools.permutations(range(cost.shape[1]), n))


def test_names_and_sentences(spark):
    df = spark.createDataFrame([(" TNF-α/ß2 ", "See Fig. 2 for e.g. A. Smith et al. in 0.5 units. Next one! 3 more.")], "n string, t string")
    r = df.select(E.name_key("n").alias("k"), E.surface_forms("n").alias("f"), cues.sentences("t").alias("s")).first()
    assert r.k == "tnfalphass2" and r.f == ["tnfalphass2", "tnfalpha", "ss2"]
    assert r.s == ["See Fig. 2 for e.g. A. Smith et al. in 0.5 units.", "Next one!", "3 more."]


def test_windows_and_budget(spark):
    df = spark.createDataFrame([("d", i, t) for i, t in enumerate(["aaaa", "cue b", "cccc", "dddd", "eeee"])], "k string, i int, text string")
    cued = texts.with_cue(df, "cue")
    assert rows(texts.cue_window(cued, "k", "i"), "i") == [(0,), (1,), (2,)]
    assert rows(texts.running_budget(df, "k", "i", 11), "i", "text") == [(0, "aaaa"), (1, "cue b"), (2, "cc")]


def test_two_sided_needs_distinct_accessions(spark):
    asked = spark.createDataFrame([("A", "B"), ("A", "C")], "acc_a string, acc_b string")
    index = spark.createDataFrame([("A", 1, ["X"]), ("B", 1, ["X"]), ("C", 1, ["Y"])], "acc string, entry int, matches array<string>")
    assert rows(leakage.two_sided_homologs(asked, index), "acc_a", "acc_b", "homolog_entry") == [("A", "C", 1)]


def test_sentences_and_cues(spark):
    texts_ = [
        "After the knockout of X. The band reappeared.", "J. B. Smith saw it. It holds, i.e. 3 of 4.", "", None,
        "APPL1 bound Rab5 with a Kd of 0.5 uM but not Rab4. Next.", "binding was observed not with lipids, sugars or salts", "We did not find it. Proteins interact.",
        "Rab5 failed to interact with Rab4.", "There was no detectable binding.",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts_)], "i int, t string")
    got = {r.i: r for r in df.select("i", cues.sentences("t").alias("s"), cues.has_cue("t").alias("c"), cues.cue_families("t").alias("f")).collect()}
    assert got[0].s == ["After the knockout of X.", "The band reappeared."]
    assert got[1].s == ["J. B. Smith saw it.", "It holds, i.e. 3 of 4."]
    assert got[2].s == [] and got[3].s is None and not got[3].c
    assert got[4].c and "elliptical_exclusion" in got[4].f and not got[5].c and not got[6].c
    assert got[7].f == ["failed_assay"] and "explicit_no_interaction" in got[8].f


def test_written_names():
    assert names.split_names("Main name (First (inner) one) (EC 1.2.3.4) (Second)") == ["Main name", "First (inner) one", "Second"]
    assert names.split_names("") == [] and names.split_names("a (b (c") == ["a"]
    assert names.fold(" A\u2013B &amp; 5\u00d73 \u2248 \ufb01n ") == "a-b & 5x3 ~ fin" and names.unescape("a\\u00e9\\\\u0041") == "aéA"
    assert names.definitions("the dipeptidyl peptidase 4 (DPP4) of human (Fig. 2) and (P < 0.05)") == [("DPP4", "dipeptidyl peptidase 4")]
    assert names.definitions("nothing here matches (XYZ)") == [] and names.long_form("heat shock protein", "HSP") == "heat shock protein"
    assert names.variants("human N. benthamiana protein kinase A")[0] == "human N. benthamiana protein kinase A"
    assert names.variants("human SKP1 protein") == ["human SKP1 protein", "SKP1 protein", "SKP1"]


def test_name_keys_fold_case(spark):
    df = spark.createDataFrame([("Straße ﬁx ΣΑΣ ſ",), (None,)], "n string")
    assert [r[0] for r in df.select(E.name_key("n")).collect()] == ["strassefixsigmaalphasigmas", None]


def test_species_prefixes(spark):
    df = spark.createDataFrame([(n,) for n in ("AtCGL160", "hRAB5", "Rab5p", "hR1", "ZzABC", None)], "n string")
    m = lambda **kw: F.create_map(*(x for k, v in kw.items() for x in (F.lit(k), F.array(F.lit(v)))))
    got = df.select("n", names.species_prefix("n", m(at=1), m(h=2, y=3)).alias("s")).collect()
    assert [(r.s.rule, r.s.rest, r.s.taxa) if r.s else None for r in got] == [("two_letter", "CGL160", [1]), ("one_letter", "RAB5", [2]), ("yeast_p_suffix", "Rab5", [3]), None, None, None]


def test_guards():
    from pairloom.operators import papers

    with pytest.raises(ValueError):
        papers.same_source({"sha": "a"}, {"sha": "b"})
    papers.same_source({"sha": "a"}, {"sha": "a"})


def test_sampled_arms(spark):
    assigned = spark.createDataFrame([("T", "U", "substituted")], "reference string, candidate string, mode string")
    wanted = spark.createDataFrame([("T", "positive", "a", 10.0), ("T", "negative", "b", 5.0), ("Z", "positive", "c", 1.0)], "target string, type string, partner string, size double")
    offered = spark.createDataFrame([("U", "positive", "x", 11.0), ("U", "positive", "y", 30.0), ("U", "negative", "z", 6.0)], "target string, type string, partner string, size double")
    got = {(r.reference, r.type): r for r in matching.sampled_arms(assigned, wanted, offered).collect()}
    assert set(got) == {("T", "positive"), ("T", "negative")} and got["T", "positive"].difference == 1.0
    assert matching.arm(spark.createDataFrame([("T", 3)], "target string, n int"), wanted, "leaked").count() == 2


def test_ks_distance_by_ranges(spark):
    rng = np.random.default_rng(5)
    rows = [(float(x), bool(f)) for x, f in zip(rng.normal(size=3000).round(2), rng.random(3000) < 0.3)]
    df = spark.createDataFrame([*rows, (None, True)], "x double, f boolean")
    first, second = (np.sort([x for x, f in rows if f == side]) for side in (True, False))
    at = np.unique([x for x, _ in rows])
    want = np.abs(np.searchsorted(first, at, "right") / len(first) - np.searchsorted(second, at, "right") / len(second)).max()
    for ranges in (2, 256):
        got = matching.ks_distance(df, "x", "f", ranges).first()
        assert abs(got.d - want) < 1e-12 and (got.n_first, got.n_second) == (len(first), len(second))
    assert tuple(matching.ks_distance(df.limit(0), "x", "f").first()) == (None, 0, 0)
    assert matching.ks_distance(df.where("f"), "x", "f").first().d is None


def test_least_distances_of_large_and_small_chains(spark):
    r = np.random.default_rng(3)
    sizes = {("e", "a"): 400, ("e", "b"): 300, ("e", "c"): 5, ("e", "d"): 1, ("e", "flat"): 90, ("f", "a"): 64, ("f", "b"): 65, ("g", "a"): 2, ("g", "b"): 1, ("h", "a"): 70}
    points = {k: r.normal(10 * i, 15, (n, 3)) for i, (k, n) in enumerate(sizes.items())}
    points["e", "flat"][:, 2] = 7.0
    points["g", "b"][0] = points["g", "a"][1]
    rows = [(e, c, *map(float, p), 1) for (e, c), x in points.items() for p in x]
    odd = [("e", "a", None, 0.0, 0.0, 1), ("e", "b", float("nan"), 10.0, 10.0, 1), (None, "a", 0.0, 0.0, 0.0, 1), ("e", None, 0.0, 0.0, 0.0, 1), ("e", "none", None, None, None, 1)]
    df = spark.createDataFrame(rows + odd + rows[:50], "entry string, chain string, x double, y double, z double, n int")
    got = {(x.entry, x.chain_a, x.chain_b): x.distance for x in structure.min_distances(df).collect()}
    want = {(e, c, d): np.sqrt(((points[e, c][:, None] - points[f, d][None]) ** 2).sum(2)).min() for e, c in points for f, d in points if e == f and c < d}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert structure.min_distances(df.limit(0)).count() == 0


def test_hits_expand_without_sending_the_result_on(spark):
    from pairloom.operators import chains

    hits = spark.createDataFrame([("q", "R"), ("q", "R"), ("q", "S"), ("p", "S"), (None, "R"), ("p", None), ("p", "gone")], "query string, target string")
    of = spark.createDataFrame([("R", 1, 0), ("S", 1, 0), ("S", 1, 0), ("S", 2, 0), ("T", 3, 0), (None, 4, 0), ("R", None, 0)], "representative string, entry int, chain int")
    acc = spark.createDataFrame([(1, 0, "A"), (1, 0, "B"), (1, 0, "B"), (2, 0, None), (3, 0, "C"), (4, 0, "D")], "entry int, chain int, acc string")
    found = chains.hits_to_chains(hits, of, acc)
    want = {(q, 1, 0, a) for q in ("q", "p", None) for a in "AB"} | {("q", 2, 0, None), ("p", 2, 0, None)}
    assert len(found.collect()) == len(want) and {tuple(r) for r in found.collect()} == want
    # nothing is aggregated, and so exchanged, after the join that expands
    top = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert [x.split()[0] for x in top[:2]] == ["Project", "+-"] and "Join Inner" in top[1]


def test_transport_against_brute_force():
    r = np.random.default_rng(4)
    for _ in range(150):
        supply = r.integers(1, 4, int(r.integers(1, 4)))
        demand = r.integers(1, 4, int(r.integers(1, 5)))
        demand[-1] += max(0, supply.sum() - demand.sum())
        cost = r.integers(0, 15, (len(supply), len(demand))).astype(float)
        got = matching.transport(lambda i: cost[i], supply, demand)
        assert [sum(x for i, _, x in got if i == k) for k in range(len(supply))] == supply.tolist()
        assert all(sum(x for _, j, x in got if j == k) <= d for k, d in enumerate(demand)) and all(x > 0 for *_, x in got)
        whole = np.repeat(np.repeat(cost, supply, 0), demand, 1)
        assert sum(cost[i, j] * x for i, j, x in got) == whole[np.arange(len(whole)), matching.hungarian(whole)].sum()


def test_assigned_targets_cost_the_least(spark):
    r = np.random.default_rng(6)
    schema = "target string, size double, n long"
    for n_ref, n_cand in ((40, 70), (70, 40), (30, 30), (5, 0), (0, 5)):
        side = lambda name, k, low: [(f"{name}{i:03}", float(r.integers(0, 12)) / 2 if i % 11 else None, int(r.integers(low, low + 6)) if i % 13 != 5 else None) for i in range(k)]
        ref, cand = side("r", n_ref, 2), side("c", n_cand, 0)
        if n_ref and n_cand:
            ref, cand = [*ref, ("both", 1.0, 3), ("nan", float("nan"), 4)], [*cand, ("both", 9.0, 1)]
        found = matching.assign_targets(spark.createDataFrame(ref, schema), spark.createDataFrame(cand, schema), 3.0).collect()
        of = {x[0]: x[1:] for x in ref + cand}
        cost = lambda a, b: 1e12 if None in (*a, *b) or a[0] != a[0] else abs(a[0] - b[0]) + 3.0 * max(0, a[1] - b[1])
        assert [(x.reference, x.candidate) for x in found if x.mode == "paired"] == ([("both", "both")] if n_ref and n_cand else [])
        subs = [(x.reference, x.candidate) for x in found if x.mode == "substituted"]
        a, b = ([x for x in side_ if x[0] != "both"] for side_ in (ref, cand))
        assert len(subs) == min(len(a), len(b)) == len({x for x, _ in subs}) == len({x for _, x in subs})
        assert {x for x, _ in subs} <= {x[0] for x in a} and {x for _, x in subs} <= {x[0] for x in b}
        if subs:
            matrix = np.array([[cost(x[1:], y[1:]) for y in b] for x in a])
            matrix = matrix if len(a) <= len(b) else matrix.T
            assert sum(cost(of[x], of[y]) for x, y in subs) == matrix[np.arange(len(matrix)), matching.hungarian(matrix)].sum()


def test_assignment_of_many_targets(spark):
    """A matrix of all references by all candidates would take 3.2 GB here."""
    many = lambda name, k, n: spark.range(k).selectExpr(f"'{name}' || id as target", "cast(id % 150 as double) * 5 as size", f"cast({n} as long) as n")
    found = matching.assign_targets(many("r", 10_000, "id % 23"), many("c", 40_000, "40 + id % 31"))
    gap = found.selectExpr("abs(cast(substr(reference, 2) as int) % 150 - cast(substr(candidate, 2) as int) % 150) as gap", "reference", "candidate")
    assert tuple(gap.agg(F.count("*"), F.max("gap"), F.count_distinct("reference"), F.count_distinct("candidate")).first()) == (10_000, 0, 10_000, 10_000)
