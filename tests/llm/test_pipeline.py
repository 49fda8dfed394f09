import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pairloom.llm import quality, queries
from tests.llm import brute


def test_stages_against_brute_force(spark, small, tmp_path):
    docs = queries.table(spark, small, "documents")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "secrets", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, small).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = {r.doc_id: r for r in docs.collect()}
        if name == "packing":
            assert set(after) == set(before)
            continue
        assert docs.columns == columns
        if name == "quality":
            model = quality.fit(queries.table(spark, small, "documents"), quality.graded(queries.table(spark, small, "labels")))
            kept = {r.doc_id for r in quality.score(queries.table(spark, small, "documents"), model).where("tail_probability >= 0.5").collect()}
            assert set(after) == kept and len(kept) < len(before)
        elif name == "near_dedup":
            classes = brute.near([(i, r.text) for i, r in before.items()], 80)
            assert set(after) == {i for i, (_, c) in classes.items() if c == i}
        elif name == "decontamination":
            flat = lambda t: " ".join(brute.words(t))
            items = [flat(r.text) for r in queries.table(spark, small, "benchmark").collect()]
            assert set(after) == {i for i, r in before.items() if not any(x in flat(r.text) for x in items)}
        else:
            assert set(after) == set(before)
            for i, r in after.items():
                assert sum(brute.secrets(r.text)[0]) == 0 and (sum(brute.secrets(before[i].text)[0]) > 0 or r == before[i] or "[secret]" in r.text) and r.n_chars == len(r.text)


def test_run(spark, small):
    assert corpus_pipeline.run(spark, small).count() > 0


@pytest.mark.parametrize("n", range(5))
def test_stages_take_empty_tables(spark, small, n):
    docs = queries.table(spark, small, "documents").limit(0)
    assert corpus_pipeline.STAGES[n][1](spark, docs, small).count() == 0


def test_stages_take_nulls_long_and_repeated_rows_and_clashing_columns(spark, small, tmp_path):
    docs = queries.table(spark, small, "documents")
    first = docs.orderBy("doc_id").first()
    plain = " ".join(f"{first.text.split()[i % 7]}{i * 7919 % 3001}" for i in range(400))
    secret = "the deploy note says password = 'abcdefghijkl' and nothing else of interest to anyone here"
    of = lambda i, text: (i, text, first.source, first.lang, None if text is None else len(text))
    odd = [of(10**6, None), of(10**6 + 1, ""), of(10**6 + 2, plain), of(10**6 + 2, plain), of(10**6 + 3, plain), of(None, plain), of(None, None), of(10**6 + 4, secret), of(10**6 + 5, "é " * 300_000), (10**6 + 6, "a few words", None, None, None)]
    added = spark.createDataFrame(odd, "doc_id long, text string, source string, lang string, n_chars long").select(*(F.col(c).cast(docs.schema[c].dataType) for c in docs.columns))
    docs = docs.unionByName(added).withColumns({c: F.lit(7) for c in ("kept", "n", "spans", "score", "band", "component_id", "rep", "words")})
    columns, odd_ids = docs.columns, {r[0] for r in odd}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        stage(spark, docs, small).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            ids = {}
            for r in docs.collect():
                ids[r.doc_id] = ids.get(r.doc_id, 0) + r.length
            assert set(ids) == {r.doc_id for r in before}
            continue
        after = docs.collect()
        assert docs.columns == columns and all(r.words == 7 and r.kept == 7 for r in after)
        assert len(after) <= len(before) and {r.doc_id for r in after} <= {r.doc_id for r in before}
        mine = [r for r in after if r.doc_id in odd_ids]
        if name == "near_dedup":
            known = [r.doc_id for r in after if r.doc_id is not None]
            assert len(known) == len(set(known)) and sum(r.text == plain and r.doc_id is not None for r in mine) == min(1, sum(r.text == plain and r.doc_id is not None for r in before))
            assert sum(r.doc_id is None for r in after) == sum(r.doc_id is None for r in before)
        if name == "secrets":
            assert len(after) == len(before) and not any("abcdefghijkl" in (r.text or "") for r in mine)
