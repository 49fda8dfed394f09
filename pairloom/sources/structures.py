"""Structure files to rows: one file is one record, parsed in Arrow batches; unreadable files give no rows."""

from __future__ import annotations

import gzip
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ATOMS = "model int, chain string, residue int, icode string, name string, atom string, altloc string, het boolean, occupancy double, x double, y double, z double"
#: A value of the dictionary format: quoted (the quote ends before white space) or plain.
_VALUE = re.compile(r"'(?:[^']|'(?=\S))*'(?=\s|$)|\"(?:[^\"]|\"(?=\S))*\"(?=\s|$)|\S+")


def _bare(value: str) -> str:
    if value in (".", "?"):
        return ""
    return value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"" else value


def column_atoms(text: str) -> list[tuple]:
    """ATOMS rows of the format of fixed columns; without MODEL records all atoms are of model 1."""
    out, model = [], 1
    for line in text.splitlines():
        kind = line[:6]
        if kind == "MODEL ":
            model = int(line[10:14])
        elif kind in ("ATOM  ", "HETATM"):
            place = [float(line[a : a + 8]) for a in (30, 38, 46)]
            out.append((model, line[21].strip(), int(line[22:26]), line[26].strip(), line[17:20].strip(), line[12:16].strip(), line[16].strip(), kind == "HETATM", float(line[54:60].strip() or 1), *place))
    return out


def dictionary_atoms(text: str) -> list[tuple]:
    """ATOMS rows of the atom_site loop of the dictionary format; the author's chain and residue names go first."""
    names: list[str] = []
    values: list[str] = []
    for line in text.splitlines():
        line = line.rstrip()
        if line.startswith("_atom_site."):
            names.append(line.split()[0].removeprefix("_atom_site."))
        elif names:
            if line.startswith(("#", "_", "loop_", "data_")):
                break
            values += map(_bare, _VALUE.findall(line))
    if not names:
        return []
    columns = {n: values[i :: len(names)] for i, n in enumerate(names)}
    n = len(values) // len(names)
    of = lambda *options, default="": next((columns[o] for o in options if o in columns), [default] * n)
    rows = zip(
        of("pdbx_PDB_model_num", default="1"), of("auth_asym_id", "label_asym_id"), of("auth_seq_id", "label_seq_id"), of("pdbx_PDB_ins_code"), of("auth_comp_id", "label_comp_id"),
        of("auth_atom_id", "label_atom_id"), of("label_alt_id"), of("group_PDB", default="ATOM"), of("occupancy", default="1"), of("Cartn_x"), of("Cartn_y"), of("Cartn_z"),
    )
    return [(int(m or 1), c, int(r), i, name, atom, alt, group == "HETATM", float(o or 1), float(x), float(y), float(z)) for m, c, r, i, name, atom, alt, group, o, x, y, z in rows if r]


def atoms_of(raw: bytes) -> list[tuple]:
    """ATOMS rows of a file's bytes (gzipped or not), or none where it can't be read."""
    try:
        text = (gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw).decode("utf-8", "replace")
        return dictionary_atoms(text) if re.search(r"^_atom_site\.", text, re.M) else column_atoms(text)
    except (ValueError, IndexError, OSError, EOFError, zlib.error):
        return []


def structures(spark: SparkSession, path: str, most_bytes: int = 50_000_000) -> DataFrame:
    """entry and ATOMS: the atoms of all structure files under a path or pattern.

    entry is the file's name up to its first dot, in lower case. Files above `most_bytes` are left out before they are read, and files
    that can't be parsed give no rows. A task holds a few files at a time.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where(F.col("length") <= most_bytes)
    named = files.select(F.lower(F.regexp_extract("path", r"([^/.]+)[^/]*$", 1)).alias("entry"), "content")
    columns = ["entry", *(c.split()[0] for c in ATOMS.split(", "))]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for entry, raw in zip(frame["entry"], frame["content"]):
                yield pd.DataFrame([(entry, *a) for a in atoms_of(raw)], columns=columns)

    return named.mapInPandas(run, f"entry string, {ATOMS}")


def residue_points(atoms: DataFrame) -> DataFrame:
    """entry, chain, x, y, z: one point for each residue of an entry's first model, for `structure.min_distances`.

    The point is the beta carbon, or the alpha carbon of glycine and of residues without one. Hetero atoms are left out; of alternate
    places the one with the greatest occupancy counts, then the first by name.
    """
    first = atoms.groupBy("entry").agg(F.min("model").alias("model"))
    carbons = atoms.where("not het and (atom = 'CA' or (atom = 'CB' and name <> 'GLY'))").join(first, ["entry", "model"])
    order = Window.partitionBy("entry", "chain", "residue", "icode").orderBy(F.col("atom").desc(), F.col("occupancy").desc(), "altloc", "x", "y", "z")
    return carbons.withColumn("_r", F.row_number().over(order)).where("_r = 1").select("entry", "chain", "x", "y", "z")
