"""What is published of the molecules of the registered queries, for their SQL; no module under test is used here."""

from __future__ import annotations

import re

# Of each molecule a SMILES, the InChI and its key, the canonical text here, the formula, then logP, molar refractivity, polar surface,
# donors, acceptors, turning bonds, rings, and carbons with four neighbours of all carbons.
STRUCTURES = """
OCC | InChI=1S/C2H6O/c1-2-3/h3H,2H2,1H3 | LFQSCWFLJHTTHZ-UHFFFAOYSA-N | CCO | C2H6O | -0.0014 12.7598 20.23 1 1 0 0 2/2
OC(C)=O | InChI=1S/C2H4O2/c1-2(3)4/h1H3,(H,3,4) | QTBSBXVTEAMEQO-UHFFFAOYSA-N | CC(=O)O | C2H4O2 | 0.0909 13.3098 37.3 1 1 0 0 1/2
C1=CC=CC=C1 | InChI=1S/C6H6/c1-2-4-6-5-3-1/h1-6H | UHOVQNZJYSORNB-UHFFFAOYSA-N | c1ccccc1 | C6H6 | 1.6866 26.442 0.0 0 0 0 1 0/6
c1ccccc1O | InChI=1S/C6H6O/c7-6-4-2-1-3-5-6/h1-5,7H | ISWSIDIOOBJBQZ-UHFFFAOYSA-N | Oc1ccccc1 | C6H6O | 1.3922 28.1068 20.23 1 1 0 1 0/6
OC(=O)c1ccccc1OC(C)=O | InChI=1S/C9H8O4/c1-6(10)13-8-5-3-2-4-7(8)9(11)12/h2-5H,1H3,(H,11,12) | BSYNRYMUTXBXSQ-UHFFFAOYSA-N | CC(=O)Oc1c(C(=O)O)cccc1 | C9H8O4 | 1.3101 44.7103 63.6 1 3 2 1 1/9
CN1C=NC2=C1C(=O)N(C)C(=O)N2C | InChI=1S/C8H10N4O2/c1-10-4-9-6-5(10)7(13)12(3)8(14)11(6)2/h4H,1-3H3 | RYYVLZVUVIJVGH-UHFFFAOYSA-N | Cn1c(=O)c2c(ncn2C)n(C)c1=O | C8H10N4O2 | -1.0293 51.196 61.82 0 6 0 2 3/8
Oc1ccc(NC(C)=O)cc1 | InChI=1S/C8H9NO2/c1-6(10)9-7-2-4-8(11)5-3-7/h2-5,11H,1H3,(H,9,10) | RZVAJINKPMORJF-UHFFFAOYSA-N | CC(=O)Nc1ccc(O)cc1 | C8H9NO2 | 1.3506 42.4105 49.33 2 2 1 1 1/8
OC(=O)C(C)c1ccc(CC(C)C)cc1 | InChI=1S/C13H18O2/c1-9(2)8-11-4-6-12(7-5-11)10(3)13(14)15/h4-7,9-10H,8H2,1-3H3,(H,14,15) | HEFNNWSXXWATRW-UHFFFAOYSA-N | CC(C)Cc1ccc(C(C)C(=O)O)cc1 | C13H18O2 | 3.0732 61.0348 37.3 1 1 4 1 6/13
CS(=O)C | InChI=1S/C2H6OS/c1-4(2)3/h1-2H3 | IAZDPXIOMUYVGZ-UHFFFAOYSA-N | CS(C)=O | C2H6OS | -0.0053 19.9904 17.07 0 1 0 0 2/2
n1ccccc1 | InChI=1S/C5H5N/c1-2-4-6-5-3-1/h1-5H | JUJWROOIHBZHMG-UHFFFAOYSA-N | c1ccncc1 | C5H5N | 1.0816 24.237 12.89 0 1 0 1 0/5
c1ccccc1N | InChI=1S/C6H7N/c7-6-4-2-1-3-5-6/h1-5H,7H2 | PAYRUJLWNCNPSJ-UHFFFAOYSA-N | Nc1ccccc1 | C6H7N | 1.2688 30.8544 26.02 1 1 0 1 0/6
[O-][N+](=O)c1ccccc1 | InChI=1S/C6H5NO2/c8-7(9)6-4-2-1-3-5-6/h1-5H | LQNUZADURLCDLV-UHFFFAOYSA-N | [O-][N+](=O)c1ccccc1 | C6H5NO2 | 1.5948 33.0964 43.14 0 2 1 1 0/6
C1CCCCC1 | InChI=1S/C6H12/c1-2-4-6-5-3-1/h1-6H2 | XDTMQSROBMDMFD-UHFFFAOYSA-N | C1CCCCC1 | C6H12 | 2.3406 27.702 0.0 0 0 0 1 6/6
CCOC(C)=O | InChI=1S/C4H8O2/c1-3-6-4(2)5/h3H2,1-2H3 | XEKOWRVHYACXOJ-UHFFFAOYSA-N | CC(=O)OCC | C4H8O2 | 0.5694 22.307 26.3 0 2 1 0 3/4
N#CC | InChI=1S/C2H3N/c1-2-3/h1H3 | WEVYAHXRMPXWCK-UHFFFAOYSA-N | CC#N | C2H3N | 0.52988 11.287 23.79 0 1 0 0 1/2
"""
# Mean and most common masses of the elements in them.
MEAN = {"C": 12.011, "H": 1.008, "N": 14.007, "O": 15.999, "S": 32.06}
COMMON = {"C": 12.0, "H": 1.00782503207, "N": 14.0030740048, "O": 15.99491461956, "S": 31.972071}

# Molecules and the patterns that were found in them by hand, once where no number stands.
MOTIFS = """
CCO | OH
Oc1ccccc1 | OH
OCC(O)CO | OH=3
CC(=O)O | CarboxylicAcid
OC(=O)CC(=O)O | CarboxylicAcid=2
CCC=O | Aldehyde
O=Cc1ccccc1 | Aldehyde
C=O |
CC(=O)C | Ketone
CC(=O)CC(C)=O | Ketone=2
CC(=O)OC | Ester
O=C1CCCO1 | Ester Ether_Ring
C=CC(=O)OC | Ester AcrylateEster
C=C(C)C(=O)OC | Ester MethacrylateEster Isoprenyl
COC | Ether Ether_Aliphatic
C1CO1 | Ether Ether_Ring
C1COCCO1 | Ether=2 Ether_Ring=2
COc1ccccc1 | Ether Ether_Mixed ArylOAlkylEther
c1ccc(Oc2ccccc2)cc1 | Ether Ether_Aromatic DiarylEther
CC#N | Nitrile
N#CCC#N | Nitrile=2
c1ccncc1 | Pyridine
c1ccc2ncccc2c1 | Pyridine
c1nccs1 | Thiazole
c1ccc2[nH]ccc2c1 | Indole
o1cccc1 | Furan
s1cccc1 | Thiophene
c1cc(-c2cccs2)sc1 | Thiophene=2
CC(C)=CCCC(C)=CCO | Isoprenyl=2 OH
C=C(C)C=C | Isoprenyl
CC(=C)C1CCC(C)=CC1 | Isoprenyl=2
not a smiles |
"""


def _parted(text: str) -> list[list[str]]:
    return [[part.strip() for part in line.split("|")] for line in text.strip().split("\n")]


SPELLINGS = [(row[0], row[1]) for row in _parted(STRUCTURES)]
MOTIF_MOLECULES = [row[0] for row in _parted(MOTIFS)]


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def structures_sql() -> str:
    """VALUES (k, smiles, inchi, inchi_key, canonical, mw, exact_mass, clogp, molar_refractivity, tpsa, hbd, hba, rot_bonds, ring_count, fraction_csp3)."""
    rows = []
    for k, (smiles, inchi, key, canonical, formula, numbers) in enumerate(_parted(STRUCTURES)):
        atoms = [(z, int(n or 1)) for z, n in re.findall(r"([A-Z][a-z]?)(\d*)", formula)]
        masses = [f"round({sum(table[z] * n for z, n in atoms)!r}, {digits})" for table, digits in ((MEAN, 3), (COMMON, 6))]
        *values, share = numbers.split()
        one, all_ = share.split("/")
        rows.append(f"({k}, {', '.join(map(_quoted, (smiles, inchi, key, canonical)))}, {', '.join(f'{m}::DOUBLE' for m in masses)}, {', '.join(f'{v}::DOUBLE' for v in values[:3])}, {', '.join(values[3:])}, round({one}::DOUBLE / {all_}, 6))")
    return f"(VALUES {', '.join(rows)}) s(k, smiles, inchi, inchi_key, canonical, mw, exact_mass, clogp, molar_refractivity, tpsa, hbd, hba, rot_bonds, ring_count, fraction_csp3)"


def motifs_sql() -> str:
    """VALUES (k, pattern, n)."""
    rows = []
    for k, (_, found) in enumerate(_parted(MOTIFS)):
        for word in found.split():
            name, _, n = word.partition("=")
            rows.append(f"({k}, {_quoted(name)}, {n or 1})")
    return f"(VALUES {', '.join(rows)}) m(k, pattern, n)"
