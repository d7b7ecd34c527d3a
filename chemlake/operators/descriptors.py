"""Computed descriptors of molecules: masses, polar surface, logP and refractivity by atom types, donors, acceptors, bonds.

Atom types are rows of a table of patterns; the first that an atom fits decides.  Everything is an expression over a
molecule's atoms; a table's distinct molecules are dealt to all cores and joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chemlake.functions.canonical_smiles import canonical_smiles
from chemlake.functions.inchi import molecule_of_inchi
from chemlake.functions.patterns import first_of, pattern_count
from chemlake.functions.smiles import WEIGHTS, molecule
from chemlake.operators.spread import distinct_rows

# Masses of the most common isotopes.
ISOTOPES = {"H": 1.00782503207, "B": 11.0093054, "C": 12.0, "N": 14.0030740048, "O": 15.99491461956, "F": 18.99840322, "Na": 22.9897692809, "Si": 27.9769265325, "P": 30.97376163, "S": 31.972071, "Cl": 34.96885268, "K": 38.96370668, "Br": 78.9183371, "I": 126.904473}

# Published contributions to logP and molar refractivity (Wildman and Crippen 1999), by type; patterns in order of priority.
CRIPPEN = """
C1 0.1441 2.503 [CH4] [CH3]C [CH2](C)C
C2 0.0 2.433 [CH](C)(C)C [C](C)(C)(C)C
C3 -0.2035 2.753 [CH3][N,O,P,S,F,Cl,Br,I] [CH2X4]([N,O,P,S,F,Cl,Br,I])[A;!#1]
C4 -0.2051 2.731 [CH1X4]([N,O,P,S,F,Cl,Br,I])([A;!#1])[A;!#1] [CH0X4]([N,O,P,S,F,Cl,Br,I])([A;!#1])([A;!#1])[A;!#1]
C5 -0.2783 5.007 [C]=[!C;A;!#1]
C6 0.1551 3.513 [CH2]=C [CH1](=C)[A;!#1] [CH0](=C)([A;!#1])[A;!#1] [C](=C)=C
C7 0.0017 3.888 [CX2]#[A;!#1]
C8 0.08452 2.464 [CH3]c
C9 -0.1444 2.412 [CH3]a
C10 -0.0516 2.488 [CH2X4]a
C11 0.1193 2.582 [CH1X4]a
C12 -0.0967 2.576 [CH0X4]a
C13 -0.5443 4.041 [cH0]-[A;!C;!N;!O;!S;!F;!Cl;!Br;!I;!#1]
C14 0.0 3.257 [c][#9]
C15 0.245 3.853 [c][#17]
C16 0.198 2.673 [c][#35]
C17 0.0 3.135 [c][#53]
C18 0.1581 3.35 [cH1]
C19 0.2955 4.346 [c](:a)(:a):a
C20 0.2713 3.904 [c](:a)(:a)-a
C21 0.136 3.509 [c](:a)(:a)-C
C22 0.4619 4.067 [c](:a)(:a)-N
C23 0.5437 3.853 [c](:a)(:a)-O
C24 0.1893 2.673 [c](:a)(:a)-S
C25 -0.8186 3.135 [c](:a)(:a)=[C,N,O]
C26 0.264 4.305 [C](=C)(a)[A;!#1] [C](=C)(c)a [CH1](=C)a [C]=c
C27 0.2148 2.693 [CX4][A;!C;!N;!O;!P;!S;!F;!Cl;!Br;!I;!#1]
CS 0.08129 3.243 [#6]
N1 -1.019 2.262 [NH2+0][A;!#1]
N2 -0.7096 2.173 [NH1+0]([A;!#1])[A;!#1]
N3 -1.027 2.827 [NH2+0]a
N4 -0.5188 3.0 [NH1+0](*)a
N5 0.08387 1.757 [NH1+0]=*
N6 0.1836 2.428 [N+0](=*)*
N7 -0.3187 1.839 [N+0]([A;!#1])([A;!#1])[A;!#1]
N8 -0.4458 2.819 [N+0](a)(*)[A;!#1] [N+0](a)(a)a
N9 0.01508 1.725 [N+0]#[A;!#1]
N10 -1.95 0.0 [H3,H2,H1;N;+,+2,+3]
N11 -0.3239 2.202 [n+0]
N12 -1.119 0.0 [n;+,+2,+3]
N13 -0.3396 0.2604 [NH0;+,+2,+3]([A;!#1])([A;!#1])([A;!#1])[A;!#1] [NH0;+,+2,+3](=[A;!#1])([A;!#1])* [NH0;+,+2,+3](=[#6])=[#7]
N14 0.2887 3.359 [N;+,+2,+3]#[A;!#1] [N;-,-2,-3] [N;+,+2,+3](=[N;-,-2,-3])=N
NS -0.4806 2.134 [#7]
O1 0.1552 1.08 [o]
O2 -0.2893 0.8238 [O;H1,H2]
O3 -0.0684 1.085 [O]([A;!#1])[A;!#1]
O4 -0.4195 1.182 [O](a)*
O5 0.0335 3.367 [O]=[#7,#8] [OX1;-,-2,-3][#7]
O6 -0.3339 0.7774 [OX1;-,-2][#16] [O+0]=[#16+0]
O12 -1.326 0.0 [O-]C(=O)
O7 -1.189 0.0 [OX1;-,-2,-3][!#1;!N;!S]
O8 0.1788 3.135 [O]=c
O9 -0.1526 0.0 [O]=[CH1]C [O]=C(C)[A;!#1] [O]=[CH1][N,O] [O]=[CH2] [O]=[CX2]=O
O10 0.1129 0.2215 [O]=[CH1]c [O]=C([C,c])a [O]=C(c)[A;!#1]
O11 0.4833 0.389 [O]=C([!#1;!#6])[!#1;!#6]
OS -0.1188 0.6865 [#8]
F 0.4202 1.108 [#9+0]
Cl 0.6895 5.853 [#17+0]
Br 0.8456 8.927 [#35+0]
I 0.8857 14.02 [#53+0]
Hal -2.996 0.0 [#9,#17,#35,#53]
P 0.8612 6.92 [#15]
S2 -0.0024 7.365 [S;-,-2,+,+2,+3] [S+0]=[N,O,P,S]
S1 0.6482 7.591 [S]
S3 0.6237 6.691 [s]
"""
#: Elements that no type is for.
OTHER_ELEMENT = ("-0.3808", "5.754")
# The same of hydrogens: on carbon, on hydroxyls of acids and enols, on nitrogen, on other hydroxyls and elements.
HYDROGENS = {"C": ("0.1230", "1.057"), "acid": ("0.2980", "1.805"), "N": ("0.2142", "0.9627"), "else": ("-0.2677", "1.395")}

# Published contributions to the polar surface (Ertl 2000): element, charge, hydrogens, then single, double, triple and aromatic
# bonds to heavy atoms; two values: outside and inside a ring of three.
SURFACE = """
N 0 0 0 0 1 0 23.79 23.79
N 0 1 0 1 0 0 23.85 23.85
N 0 2 1 0 0 0 26.02 26.02
N 1 2 0 1 0 0 25.59 25.59
N 1 3 1 0 0 0 27.64 27.64
N 0 0 1 1 0 0 12.36 12.36
N 0 0 0 1 1 0 13.6 13.6
N 0 1 2 0 0 0 12.03 21.94
N 1 0 1 0 1 0 4.36 4.36
N 1 1 1 1 0 0 13.97 13.97
N 1 2 2 0 0 0 16.61 16.61
N 0 0 0 0 0 2 12.89 12.89
N 0 1 0 0 0 2 15.79 15.79
N 1 1 0 0 0 2 14.14 14.14
N 0 0 3 0 0 0 3.24 3.01
N 0 0 1 2 0 0 11.68 11.68
N 1 0 2 1 0 0 3.01 3.01
N 1 1 3 0 0 0 4.44 4.44
N 0 0 1 0 0 2 4.93 4.93
N 0 0 0 1 0 2 8.39 8.39
N 0 0 0 0 0 3 4.41 4.41
N 1 0 0 0 0 3 4.1 4.1
N 1 0 1 0 0 2 3.88 3.88
N 1 0 4 0 0 0 0.0 0.0
O 0 0 0 1 0 0 17.07 17.07
O 0 1 1 0 0 0 20.23 20.23
O -1 0 1 0 0 0 23.06 23.06
O 0 0 2 0 0 0 9.23 12.53
O 0 0 0 0 0 2 13.14 13.14
"""

# Patterns of donors and acceptors of hydrogen bonds, and of bonds that turn.
DONOR = "[$([N;!H0;v3]),$([N;!H0;+1;v4]),$([O,S;H1;+0]),$([n;H1;+0])]"
ACCEPTOR = "[$([O,S;H1;v2]-[!$(*=[O,N,P,S])]),$([O,S;H0;v2]),$([O,S;-]),$([N;v3;!$(N-*=!@[O,N,P,S])]),$([nH0,o,s;+0])]"
TURNING = (
    "[!$(*#*)&!D1&!$(C(F)(F)F)&!$(C(Cl)(Cl)Cl)&!$(C(Br)(Br)Br)&!$(C([CH3])([CH3])[CH3])&!$([CD3](=[N,O,S])-!@[#7,O,S!D1])&!$([#7,O,S!D1]-!@[CD3]=[N,O,S])&!$([CD3](=[N+])-!@[#7!D1])&!$([#7!D1]-!@[CD3]=[N+])]"
    "-,:;!@[!$(*#*)&!D1&!$(C(F)(F)F)&!$(C(Cl)(Cl)Cl)&!$(C(Br)(Br)Br)&!$(C([CH3])([CH3])[CH3])]"
)


def _weights(table: dict[str, float]) -> str:
    """SQL: the sum of the table's weights over all atoms and their hydrogens; null where an element is not in it."""
    cases = " ".join(f"WHEN '{z}' THEN {w!r}D" for z, w in table.items())
    return f"aggregate(molecule.atoms, 0D, (s, a) -> s + a.h * {table['H']!r}D + CASE a.z {cases} END)"


def weight() -> Column:
    """The molecular weight of the column molecule."""
    return F.round(F.expr(f"CASE WHEN molecule IS NOT NULL THEN {_weights(WEIGHTS)} END"), 3)


def _types() -> str:
    """SQL: struct<p, m> of each atom and its hydrogens."""
    pair = lambda p, m: f"named_struct('p', {p}D, 'm', {m}D)"
    by_element: dict[str, list[tuple[str, str]]] = {}
    for line in CRIPPEN.split("\n"):
        if line:
            kind, p, m, *patterns = line.split()
            for element in ("F", "Cl", "Br", "I") if kind == "Hal" else ("C", "N", "O", "F", "Cl", "Br", "I", "P", "S")[_place(kind) : _place(kind) + 1]:
                by_element.setdefault(element, []).extend((x, pair(p, m)) for x in patterns)
    heavy = "CASE a.z " + " ".join(f"WHEN '{z}' THEN {first_of(rows)}" for z, rows in by_element.items()) + f" ELSE {pair(*OTHER_ELEMENT)} END"
    hydroxyl = first_of([("O[CX4,c]", "'else'"), ("OC=[#6,#7,O,S]", "'acid'"), ("O[O,S]", "'acid'"), ("O[#7]", "'N'")])
    kind = f"CASE a.z WHEN 'C' THEN 'C' WHEN 'N' THEN 'N' WHEN 'O' THEN coalesce({hydroxyl}, 'else') ELSE 'else' END"
    light = "CASE " + " ".join(f"WHEN {kind} = '{k}' THEN {pair(*v)}" for k, v in HYDROGENS.items()) + " END"
    return f"transform(molecule.atoms, (a, i) -> struct({heavy} AS heavy, CASE WHEN a.h > 0 THEN {light} END AS light, a.h AS h))"


def _place(kind: str) -> int:
    return ("C", "N", "O", "F", "Cl", "Br", "I", "P", "S").index(kind if kind in ("Cl", "Br") else kind[0])


def _surface() -> str:
    """SQL: the polar surface of nitrogens and oxygens; environments of no row get what their bonds and hydrogens suggest."""
    number = lambda order: f"size(filter(a.n, b -> b.o = {order}))"
    key = f"concat_ws(' ', a.z, a.q, a.h, {number(1)}, {number(2)}, {number(3)}, {number(4)})"
    small = "exists(molecule.rings, r -> size(r) = 3 AND array_contains(r, i))"
    cases = []
    for row in SURFACE.strip().split("\n"):
        *environment, plain, ringed = row.split()
        value = f"{plain}D" if plain == ringed else f"IF({small}, {ringed}D, {plain}D)"
        cases.append(f"WHEN '{' '.join(environment)}' THEN {value}")
    rest = "IF(a.z = 'N', greatest(0D, 30.5D - size(a.n) * 8.2D + a.h * 1.5D), greatest(0D, 28.5D - size(a.n) * 8.6D + a.h * 1.5D))"
    each = f"transform(molecule.atoms, (a, i) -> CASE WHEN a.z IN ('N', 'O') THEN CASE {key} {' '.join(cases)} ELSE {rest} END ELSE 0D END)"
    return f"aggregate({each}, 0D, (s, v) -> s + v)"


DESCRIPTORS = ("smiles", "mw", "exact_mass", "clogp", "tpsa", "hbd", "hba", "rot_bonds", "ring_count", "fraction_csp3", "molar_refractivity")


def describe(df: DataFrame, smiles: str = "smiles", inchi: str | None = None) -> DataFrame:
    """df with computed_<descriptor> and source_<descriptor> (computed) of each of DESCRIPTORS.

    The molecule is that of the SMILES, or where this is none that of the InChI.  Cells that are no molecule, null or
    empty have nulls; so has a mass where an element's weight is not known.  Columns of these names are replaced.
    Each distinct pair of texts is described once.
    """
    text = F.trim(F.split_part(F.col(smiles), F.lit("|"), F.lit(1)))
    other = F.trim(F.col(inchi)) if inchi else F.lit("")
    read = molecule(F.col("_text"))
    if inchi:
        read = F.coalesce(read, molecule_of_inchi(F.col("_other")))
    kept = [c for c in df.columns if c not in {f"{p}_{d}" for d in DESCRIPTORS for p in ("computed", "source")}]
    carbons = "size(filter(molecule.atoms, a -> a.z = 'C'))"
    saturated = "size(filter(molecule.atoms, a -> a.z = 'C' AND size(a.n) + a.h = 4))"
    out: dict[str, Column] = {
        "smiles": canonical_smiles(F.col("_d.molecule")),
        "mw": F.round(F.col("_d.mw"), 3),
        "exact_mass": F.round(F.col("_d.exact"), 6),
        "clogp": F.round(F.col("_d.sums.p"), 6),
        "tpsa": F.round(F.col("_d.surface"), 4),
        "hbd": F.col("_d.donors"),
        "hba": F.col("_d.acceptors"),
        "rot_bonds": F.col("_d.turning"),
        "ring_count": F.col("_d.rings"),
        "fraction_csp3": F.round(F.col("_d.sp3"), 6),
        "molar_refractivity": F.round(F.col("_d.sums.m"), 6),
    }
    rows = df.select(F.struct(*[F.col(c) for c in kept]).alias("_row"), F.coalesce(text, F.lit("")).alias("_text"), F.coalesce(other, F.lit("")).alias("_other"))
    typed = distinct_rows(rows, "_text", "_other").withColumn("molecule", read).withColumn("_types", F.expr(_types()))
    sums = "aggregate(_types, named_struct('p', 0D, 'm', 0D), (s, t) -> named_struct('p', s.p + t.heavy.p + coalesce(t.h * t.light.p, 0D), 'm', s.m + t.heavy.m + coalesce(t.h * t.light.m, 0D)))"
    found = typed.select(
        "_text", "_other",
        F.struct(
            F.col("molecule"), F.expr(_weights(WEIGHTS)).alias("mw"), F.expr(_weights(ISOTOPES)).alias("exact"), F.expr(sums).alias("sums"), F.expr(_surface()).alias("surface"),
            pattern_count(DONOR).alias("donors"), pattern_count(ACCEPTOR).alias("acceptors"), pattern_count(TURNING).alias("turning"), F.expr("size(molecule.rings)").alias("rings"),
            F.expr(f"IF({carbons} > 0, {saturated} / {carbons}, 0D)").alias("sp3"),
        ).alias("_d"),
    )
    known = F.col("_d.molecule").isNotNull()
    shown = [F.when(known, c).alias(f"computed_{d}") for d, c in out.items()]
    described = found.select("_text", "_other", *shown, *[F.when(known & out[d].isNotNull(), F.lit("computed")).alias(f"source_{d}") for d in DESCRIPTORS])
    return rows.join(described, ["_text", "_other"]).select("_row.*", *[c for c in described.columns if c not in ("_text", "_other")])
