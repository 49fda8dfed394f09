import pytest

from pairloom.plans import catalogue
from tests import oracle


@pytest.fixture(scope="module")
def con(small):
    return oracle.connect(small)


@pytest.mark.parametrize("name", [n for n in catalogue.QUERIES if n in catalogue.ORACLE_SQL])
def test_query_matches_its_sql(spark, small, con, name):
    oracle.same(catalogue.QUERIES[name](spark, small), con, catalogue.ORACLE_SQL[name])


@pytest.mark.parametrize("name", [n for n in catalogue.QUERIES if n not in catalogue.ORACLE_SQL])
def test_query_runs(spark, small, name):
    assert catalogue.QUERIES[name](spark, small).count() >= 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_global_assignment_sees_all_targets(spark, small, con):
    con.execute("create or replace temp view sized_ as with " + ", ".join([*catalogue.V.ASSEMBLED, catalogue.LENGTHS, catalogue.SIZED]) + " select * from sized where combined is not null")
    side = lambda kind, least: {t for (t,) in con.execute(f"select target from sized_ where type = '{kind}' group by target having count(*) >= {least}").fetchall()}
    reference, candidates = side("negative", 8), side("positive", 40)
    got = catalogue.QUERIES["match_global_assignment"](spark, small).collect()
    assert {r.reference for r in got if r.mode == "paired"} == reference & candidates
    assert len(got) == len(reference & candidates) + min(len(reference - candidates), len(candidates - reference)) > 9


def test_assignment_costs_are_least(spark, small):
    """The one-dimensional matching against a global least-cost assignment of each target's partners."""
    import numpy as np

    from pairloom.operators import matching

    d = small
    rows = catalogue.M.within_cap(catalogue._sized(spark, d), 1420).where("sources in ('a', 'b')").select("target", "partner", "sources", "combined").collect()
    got = {}
    for r in catalogue.QUERIES["match_partners_1d"](spark, d).collect():
        got[r.target] = got.get(r.target, 0.0) + (r.difference or 0.0)
    checked = 0
    for t in sorted(got)[:40]:
        a, b = (np.array(sorted(r.combined for r in rows if r.target == t and r.sources == s), float) for s in "ab")
        small_, large = (a, b) if len(a) <= len(b) else (b, a)
        if len(small_):
            cost = np.abs(small_[:, None] - large[None, :])
            assert abs(cost[np.arange(len(small_)), matching.hungarian(cost)].sum() - got[t]) < 1e-6
            checked += 1
    assert checked > 5


@pytest.mark.parametrize("name", ["score_npmi_table", "score_symmetrise", "score_min_count", "score_topk_features"])
def test_components_at_the_bound_and_unknown_residues(spark, tmp_path, name):
    """The float nearest to 0.15 is not above 0.15 for SQL, and a null vec_id is no residue."""
    import duckdb
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute  # noqa: F401
    import pyarrow.parquet as pq

    r = np.random.default_rng(9)
    vectors = r.normal(0, 0.15, (300, 8)).astype(np.float32)
    vectors[r.random(vectors.shape) < 0.2] = np.float32(0.15)
    ids = [None if i % 29 == 7 else i for i in range(300)]
    table = pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(vectors.tolist(), pa.list_(pa.float32())), "label": pa.array([i % 5 for i in range(300)], pa.int32())})
    table = table.filter(pa.compute.is_valid(table["vec_id"])) if name == "score_topk_features" else table  # its order says nothing of nulls
    pq.write_table(table, tmp_path / "embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet'")
    oracle.same(catalogue.QUERIES[name](spark, str(tmp_path)), con, catalogue.ORACLE_SQL[name])


@pytest.mark.parametrize("name", ["match_global_assignment", "match_global_modes"])
def test_global_assignment_sizes_edges_once(spark, small, name):
    """Both arms, their kinds and their targets come from one pass over the directed edges and their lengths."""
    import re

    df = catalogue.QUERIES[name](spark, small)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"Generate explode\(array\(struct\(target", plan)) == 1
