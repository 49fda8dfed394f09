import gzip
import json

import pytest
from pyspark.sql import functions as F

from pairloom.operators import structure
from pairloom.sources import markup, readers, require_columns, sinks, structures


def test_pair_files_and_lists(spark, tmp_path):
    p = tmp_path / "x.tsv"
    p.write_text("# c\nB\tA\nA\tB\nC\tC\n")
    assert sorted(tuple(r) for r in readers.pair_file(spark, str(p)).collect()) == [("A", "B"), ("C", "C")]
    q = tmp_path / "l.csv"
    q.write_text("id_a,id_b,label\nA,B,1\nC,D,0\n")
    assert [r.pair_id for r in readers.pair_list(spark, str(q)).collect()] == ["pair_0", "pair_1"]
    q.write_text("pair_id,id_a,id_b\nx,A,B\nx,C,D\n")
    with pytest.raises(ValueError, match="repeated"):
        readers.pair_list(spark, str(q))
    with pytest.raises(ValueError, match="missing"):
        require_columns(spark.range(1), "nope")


def test_interactions(spark, tmp_path):
    line = lambda a, b, neg: "\t".join(["x", "y", f"uniprotkb:{a}", f"uniprotkb:{b}", *["-"] * 31, neg])
    p = tmp_path / "d.txt"
    p.write_text("\n".join(["#h", line("P12345", "O00001", "false"), line("O00001", "P12345-2", "-"), line("P12345", "Q99999", "true"), "short\tline"]))
    assert [tuple(r) for r in readers.interactions(spark, str(p)).collect()] == [("O00001", "P12345")]


def test_fasta(spark, tmp_path):
    p = tmp_path / "s.fa"
    p.write_text(">1abc_A mol:protein length:40\n" + "ac" * 20 + "\n>1abc_B mol:na\n" + "A" * 40 + "\n>2xyz_A mol:protein\n" + "AC" * 10 + "\n" + "AC" * 10 + "\n>3 mol:protein\nACD\n")
    got = readers.collapsed_sequences(readers.fasta(spark, str(p))).collect()
    assert [(r.representative, r.members) for r in got] == [("1abc_A", ["1abc_A", "2xyz_A"])]


def test_run_log_last_wins(spark, tmp_path):
    for i, name in enumerate(("a.jsonl", "b.jsonl")):
        (tmp_path / name).write_text("".join(json.dumps({"k": k, "v": i * 10 + k}) + "\n" for k in (1, 2, 1)) + "not json\n")
    got = readers.run_log(spark, str(tmp_path), "k long, v long", ["k"]).where("k is not null").collect()
    assert sorted((r.k, r.v) for r in got) == [(1, 11), (2, 12)]


def test_association_header(spark, tmp_path):
    p = tmp_path / "n.csv"
    p.write_text("# codebook_size=32\nfeature_i,feature_j,count,npmi\n0,1,10,0.8\n")
    table, size = readers.association_file(spark, str(p))
    assert size == 32 and table.count() == 1
    p.write_text("feature_i,feature_j,count,npmi\n")
    with pytest.raises(ValueError):
        readers.association_file(spark, str(p))


def test_versions():
    names = ["t_2024-01-02.csv", "t_2025-03-01.csv", "t_notadate!.csv"]
    assert readers.latest_version(names, "t_", ".csv") == "t_2025-03-01.csv"
    assert readers.latest_version([], "t_", ".csv", "2020-01-01") == "t_2020-01-01.csv"


def test_markup(spark):
    html = "<html><script>x</script><h2>Results</h2><p>One &amp; <b>two</b></p><nav>menu</nav><p>Three</p></html>"
    assert markup.parse(html) == [("Results", "h2", "Results"), ("Results", "p", "One & two"), ("Results", "p", "Three")]
    df = spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")
    assert markup.blocks(df).count() == 3


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, None)], "n int, s string")
    path = sinks.write_csv(df, str(tmp_path / "o.csv"), {"version": "1"}, ["n"])
    assert open(path).read() == "# version=1\nn,s\n1,\n2,b\n"
    side = json.load(open(sinks.write_sidecar(path, sinks.provenance([path]))))
    assert len(side["inputs"][0]["sha256"]) == 64
    old = spark.createDataFrame([("B", "A", "1,2")], "acc_a string, acc_b string, codes string")
    new = spark.createDataFrame([("A", "B", "2,3"), ("C", "C", "4")], "acc_a string, acc_b string, codes string")
    assert [tuple(r) for r in sinks.merge_codes(old, new).collect()] == [("A", "B", "1,2,3")]


def test_chunks_are_greedy(spark):
    import random

    r = random.Random(3)
    rows = [(i, r.choice([0, 6, 6, 30, 80, 150, None])) for i in range(400)]
    got = sinks.chunked_requests(spark.createDataFrame(rows, "id long, size int").repartition(5), "id", "size", 100, 7, shards=3).collect()
    assert len(got) == 400
    for shard in range(3):
        chunk = held = count = 0
        for x in sorted((x for x in got if x.shard == shard), key=lambda x: x.id):
            if x["size"]:
                if count and (count == 7 or held + x["size"] > 100):
                    chunk, held, count = chunk + 1, 0, 0
                held, count = held + x["size"], count + 1
            assert x.chunk == chunk


def test_headers_with_a_mark_inside(spark, tmp_path):
    path = tmp_path / "s.fa"
    path.write_text(">1abc_A mol:protein 5'->3' thing\n" + "acdef" * 8 + "\n>sp|P12345|NAME mol:protein\n" + "ACD\nEFG" * 9 + "\n>short mol:protein\nAC\n")
    got = {r.id: r for r in readers.fasta(spark, str(path)).collect()}
    assert set(got) == {"1abc_A", "sp|P12345|NAME"} and got["1abc_A"].sequence == "ACDEF" * 8 and "5'->3'" in got["1abc_A"].header
    assert {r.id for r in readers.fasta_ids(spark, str(path)).collect()} == {"1abc_A", "P12345", "short"}


def test_ordinals_without_a_window(spark):
    df = readers.with_ordinal(spark.range(0, 100, 1, 7), "n")
    assert sorted((r.id, r.n) for r in df.collect()) == [(i, i) for i in range(100)]


def test_statistics_and_feature_space(spark, tmp_path):
    write = lambda rows, name: (spark.createDataFrame(rows, "feature long, max double, idf double").write.parquet(str(tmp_path / name)), str(tmp_path / name))[1]
    assert readers.statistics(spark, write([(0, 2.0, 0.0), (1, 3.0, 1.5)], "good")).count() == 2
    for i, bad in enumerate([[(0, 1.0, 2.0), (1, 1.0, 3.0)], [(0, 0.0, 2.0)], [(0, 2.0, float("nan"))], [(0, 2.0, 3.0), (0, 2.0, 3.0)], []]):
        with pytest.raises(ValueError):
            readers.statistics(spark, write(bad, f"bad{i}"))
    assert readers.same_feature_space({"a": "1"}, {"a": 1, "b": 2}, ["a", "b"]) == ["b"]
    with pytest.raises(ValueError):
        readers.same_feature_space({"a": "1"}, {"a": 2}, ["a"])


def test_reviewed_entries(spark, tmp_path):
    path = tmp_path / "e.tsv"
    path.write_text("Entry\tName\tProtein\tGene\tOrganism\tId\tOrtho\tEgg\nP1\tA_X\tMain\tg\tHomo\t9606\t\t\nP2\tB_Y\tOther\th\tVirus\t10\t\t\n")
    rows = readers.reviewed_entries(spark, str(path), spark.createDataFrame([("P2",)], "accession string"), "2026_02")
    assert {r.accession: r.is_viral for r in rows.collect()} == {"P1": False, "P2": True} and readers.one_release(rows) == "2026_02"
    path.write_text("Entry\tName\n")
    with pytest.raises(ValueError):
        readers.reviewed_entries(spark, str(path), rows.select("accession"), "x")


def test_articles_and_residues(spark):
    xml = """<article><front><abstract><p>Short  summary.</p></abstract></front><body>
        <sec><title>1. Results and Discussion</title><p>One <italic>two</italic><fig><label>Fig 1</label><caption><p>A caption.</p></caption></fig> three.</p><sec><title>Binding of X</title><list><list-item><p>Four.</p></list-item></list></sec></sec>
        <sec sec-type="ack"><title>Thanks</title><p>No.</p></sec></body><back><ref-list><p>No.</p></ref-list></back></article>"""
    got = [(b[2], b[3], b[4]) for b in markup.jats(xml)]
    assert got == [("abstract", "paragraph", "Short summary."), ("results_and_discussion", "paragraph", "One two three."), ("results_and_discussion", "figure_caption", "Fig 1 A caption."), ("results_and_discussion", "paragraph", "Four.")]
    df = spark.createDataFrame([("p", xml), ("q", "<broken"), ("r", None)], "paper_id string, xml string")
    assert markup.article_blocks(df).count() == 4
    entry = '<e xmlns="u"><residue><crossRefDb dbSource="PDB" dbChainId="A" dbResNum="12B"/><crossRefDb dbSource="UniProt" dbAccessionId="P1" dbResNum="7"/></residue><residue><crossRefDb dbSource="PDB" dbChainId="A" dbResNum="null"/><crossRefDb dbSource="UniProt" dbAccessionId="P1" dbResNum="8"/></residue></e>'
    assert [tuple(r)[1:] for r in markup.residue_maps(spark.createDataFrame([("e", entry)], "entry string, xml string")).collect()] == [("A", 12, "B", "P1", 7)]


def test_runs_and_metadata(spark, tmp_path):
    folder = str(tmp_path / "run")
    assert sinks.bind_run(folder, {"a": 1}) == sinks.bind_run(folder, {"a": 1})
    with pytest.raises(ValueError):
        sinks.bind_run(folder, {"a": 2})
    path = str(tmp_path / "m")
    sinks.with_metadata(spark.range(3), {"id": {"unit": "row"}}).write.parquet(path)
    assert spark.read.parquet(path).schema["id"].metadata == {"unit": "row"}
    assert readers.latest_version([sinks.dated_name("t_", "2026-01-02", ".csv"), sinks.dated_name("t_", "2025-01-02", ".csv")], "t_", ".csv") == "t_2026-01-02.csv"
    assert readers.feature_files([path], spark) and all(x.endswith(".parquet") for x in readers.feature_files([path], spark))


def test_tables_of_entries(spark, tmp_path):
    (tmp_path / "c.csv").write_text("# 2026\nPDB,CHAIN,SP_PRIMARY,RES_BEG\n1ABC,A,P1,1\n")
    assert [tuple(r) for r in readers.chain_map(spark, str(tmp_path / "c.csv")).collect()] == [("1abc", "A", "P1", "1")]
    (tmp_path / "d.csv").write_text("entry_id,release_date\n1ABC,2020-02-03\n2XYZ,?\n")
    assert {r.entry: str(r.release_date) for r in readers.release_dates(spark, str(tmp_path / "d.csv")).collect()} == {"1abc": "2020-02-03", "2xyz": "None"}
    import gzip

    for n, text in (("w1.csv.gz", "pdb_id,area\n1ABC,5.0\n"), ("w2.csv.gz", "pdb_id,area\n"), ("w3.csv.gz", "")):
        with gzip.open(tmp_path / n, "wt") as f:
            f.write(text)
    assert [tuple(r) for r in readers.interfaces(spark, str(tmp_path / "w*.csv.gz"), "pdb_id string, area double").collect()] == [("1abc", 5.0)]
    spark.createDataFrame([("p", "x"), ("q", "y")], "paper_id string, text string").write.parquet(str(tmp_path / "t"))
    assert readers.texts_of(spark, str(tmp_path / "t"), spark.createDataFrame([("q",), ("q",)], "paper_id string")).count() == 1


def test_structures(spark, tmp_path):
    line = "{:6}{:>5} {:^4}{:1}{:>3} {:1}{:>4}{:1}   {:8.3f}{:8.3f}{:8.3f}{:6.2f}".format
    atoms = [
        line("ATOM", 1, "CA", "", "ALA", "A", 5, "", 0, 0, 0, 1), line("ATOM", 2, "CB", "A", "ALA", "A", 5, "", 1, 0, 0, 0.4), line("ATOM", 3, "CB", "B", "ALA", "A", 5, "", 2, 0, 0, 0.6),
        line("ATOM", 4, "CA", "", "GLY", "B", -1, "C", 2, 3, 4, 1), line("HETATM", 5, "CA", "", "CA", "B", 9, "", 2, 0, 0, 1),
    ]
    (tmp_path / "1ABC.pdb").write_text("\n".join(["HEADER", "MODEL        1", *atoms, "ENDMDL", "MODEL        2", line("ATOM", 1, "CB", "", "ALA", "C", 1, "", 0, 0, 0, 1), "ENDMDL"]))
    fields = "group_PDB id label_atom_id label_alt_id label_comp_id label_asym_id label_seq_id pdbx_PDB_ins_code Cartn_x Cartn_y Cartn_z occupancy auth_seq_id auth_asym_id pdbx_PDB_model_num".split()
    loop = ["data_2xyz", "loop_", *(f"_atom_site.{f} " for f in fields), "ATOM 1 \"CA\" . GLY A 1 ? 0.0 0.0 0.0 1.00 7 X 1", "ATOM 2 CB . LEU B 1 ? 0.0 6.0", "8.0 1.00 8 'Y' 1", "HETATM 3 O . HOH C . ? 1 1 1 1.00 9 Y 1", "#", "loop_", "_other.a", "1"]
    (tmp_path / "2xyz.cif.gz").write_bytes(gzip.compress("\n".join(loop).encode()))
    (tmp_path / "bad.pdb").write_text("ATOM  no numbers here at all, and a line that is long enough to be cut up")
    (tmp_path / "cut.cif.gz").write_bytes(gzip.compress(b"x" * 1000)[:20])
    (tmp_path / "empty.pdb").write_text("")
    (tmp_path / "huge.pdb").write_text("\n".join(atoms * 20))
    rows = structures.structures(spark, str(tmp_path), 4000)
    assert {r.entry: r.n for r in rows.groupBy("entry").agg(F.count("*").alias("n")).collect()} == {"1abc": 6, "2xyz": 3}
    points = structures.residue_points(rows)
    assert sorted(tuple(r) for r in points.collect()) == [("1abc", "A", 2.0, 0.0, 0.0), ("1abc", "B", 2.0, 3.0, 4.0), ("2xyz", "X", 0.0, 0.0, 0.0), ("2xyz", "Y", 0.0, 6.0, 8.0)]
    assert sorted(tuple(r) for r in structure.min_distances(points).collect()) == [("1abc", "A", "B", 5.0), ("2xyz", "X", "Y", 10.0)]
