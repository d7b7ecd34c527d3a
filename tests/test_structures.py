"""Patterns, descriptors, canonical texts, InChI and its key."""

import random
from itertools import combinations, permutations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chemlake.functions import patterns
from chemlake.functions.canonical_smiles import write
from chemlake.functions.inchi import read_inchi
from chemlake.functions.inchikey import inchikey
from chemlake.functions.smiles import assembled, molecule, molecule_of
from chemlake.operators import descriptors, structures
from chemlake.operators.molecules import FEATURES, annotate
from tests.test_molecules import CASES

# SMILES and InChI of the same molecules.
SAME = {
    "CCO": "C2H6O/c1-2-3/h3H,2H2,1H3", "CC(=O)O": "C2H4O2/c1-2(3)4/h1H3,(H,3,4)", "c1ccccc1": "C6H6/c1-2-4-6-5-3-1/h1-6H", "C": "CH4/h1H4", "O": "H2O/h1H2", "[H][H]": "H2/h1H",
    "CC(=O)Oc1ccccc1C(=O)O": "C9H8O4/c1-6(10)13-8-5-3-2-4-7(8)9(11)12/h2-5H,1H3,(H,11,12)", "Cn1cnc2c1c(=O)n(C)c(=O)n2C": "C8H10N4O2/c1-10-4-9-6-5(10)7(13)12(3)8(14)11(6)2/h4H,1-3H3",
    "C[N+](=O)[O-]": "CH3NO2/c1-2(3)4/h1H3", "CC(=O)[O-]": "C2H4O2/c1-2(3)4/h1H3,(H,3,4)/p-1", "C[NH3+]": "CH5N/c1-2/h2H2,1H3/p+1", "CC(=O)Nc1ccc(O)cc1": "C8H9NO2/c1-6(10)9-7-2-4-8(11)5-3-7/h2-5,11H,1H3,(H,9,10)",
    "c1ccncc1": "C5H5N/c1-2-4-6-5-3-1/h1-5H", "c1ccc2[nH]ccc2c1": "C8H7N/c1-2-4-8-7(3-1)5-6-9-8/h1-6,9H", "CC(C)Cc1ccc(cc1)C(C)C(=O)O": "C13H18O2/c1-9(2)8-11-4-6-12(7-5-11)10(3)13(14)15/h4-7,9-10H,8H2,1-3H3,(H,14,15)",
    "CS(C)=O": "C2H6OS/c1-4(2)3/h1-2H3", "CS(=O)(=O)C": "C2H6O2S/c1-5(2,3)4/h1-2H3", "CC#N": "C2H3N/c1-2-3/h1H3", "C=C(C)C=C": "C5H8/c1-4-5(2)3/h4H,1-2H2,3H3", "NC(=O)N": "CH4N2O/c2-1(3)4/h(H4,2,3,4)",
    "CN1CCCC1c1cccnc1": "C10H14N2/c1-12-7-3-5-10(12)9-4-2-6-11-8-9/h2,4,6,8,10H,3,5,7H2,1H3/t10-/m0/s1", "OC1C(O)C(O)OC(CO)C1O": "C6H12O6/c7-1-2-3(8)4(9)5(10)6(11)12-2/h2-11H,1H2/t2-,3-,4+,5-,6?/m1/s1",
    "[Na+].[Cl-]": "ClH.Na/h1H;/q;+1/p-1", "C1CO1": "C2H4O/c1-2-3-1/h1-2H2", "ClCCl": "CH2Cl2/c2-1-3/h1H2", "Oc1ccc(Cl)cc1": "C6H5ClO/c7-5-1-3-6(8)4-2-5/h1-4,8H", "c1cscn1": "C3H3NS/c1-2-5-3-4-1/h1-3H",
    "OS(=O)(=O)O": "H2O4S/c1-5(2,3)4/h(H2,1,2,3,4)", "C[N+](C)(C)C": "C4H12N/c1-5(2,3)4/h1-4H3/q+1", "O=[N+]([O-])c1ccccc1": "C6H5NO2/c8-7(9)6-4-2-1-3-5-6/h1-5H", "CC(N)C(=O)O": "C3H7NO2/c1-2(4)3(5)6/h2H,4H2,1H3,(H,5,6)", "CN=C=O": "C2H3NO/c1-3-2-4/h1H3",
}
# Published keys.
KEYS = {
    "CH4/h1H4": "VNWKTOKETHGBQD-UHFFFAOYSA-N", "C2H6O/c1-2-3/h3H,2H2,1H3": "LFQSCWFLJHTTHZ-UHFFFAOYSA-N", "H2O/h1H2": "XLYOFNOQVPJJNP-UHFFFAOYSA-N", "C8H10N4O2/c1-10-4-9-6-5(10)7(13)12(3)8(14)11(6)2/h4H,1-3H3": "RYYVLZVUVIJVGH-UHFFFAOYSA-N",
    "C3H7NO2/c1-2(4)3(5)6/h2H,4H2,1H3,(H,5,6)/t2-/m0/s1": "QNAYBMKLOCPYGJ-REOHCLBHSA-N", "C2H4O2/c1-2(3)4/h1H3,(H,3,4)/p-1": "QTBSBXVTEAMEQO-UHFFFAOYSA-M", "C4H4O4/c5-3(6)1-2-4(7)8/h1-2H,(H,5,6)(H,7,8)/b2-1+": "VZCYOOQTPOCHFL-OWOJBTEDSA-N",
    "CH5N/c1-2/h2H2,1H3/p+1": "BAVYZALUXZFZLV-UHFFFAOYSA-O", "C10H14N2/c1-12-7-3-5-10(12)9-4-2-6-11-8-9/h2,4,6,8,10H,3,5,7H2,1H3/t10-/m0/s1": "SNICXCGAKADSCV-JTQLQIEISA-N",
}
RINGS = ["C12C3C4C1C5C2C3C45", "C1CC2CC1CC2", "C(c1ccccc1)(c1ccccc1)c1ccccc1", "c1ccc(-c2ccccc2)cc1", "OC1C(O)C(O)C(O)C(O)C1O", "C1CCC2(CC1)CCCCC2", "C1=CC2=CC3=CC=CC=C3C=C2C=C1", "C12C3C1C23", "C1CC3CC1CC2CC3C2", "[Na+].[Cl-].CCO", "CC(C)(C)C(C)(C)C", "C" + "(c1ccccc1)C" * 6]


def renumbered(atoms, r):
    order = r.sample(range(len(atoms)), len(atoms))
    place = {old: new for new, old in enumerate(order)}
    out = [{**atoms[i], "n": [{**n, "j": place[n["j"]]} for n in atoms[i]["n"]]} for i in order]
    for a in out:
        r.shuffle(a["n"])
    return out


@pytest.mark.parametrize("smiles", [*SAME, *RINGS])
def test_canonical_text_is_one_for_all_numberings(smiles):
    r, atoms = random.Random(1), molecule_of(smiles)["atoms"]
    text = write(atoms)
    assert {write(renumbered(atoms, r)) for _ in range(12)} == {text}
    assert write(molecule_of(text)["atoms"]) == text


def test_different_molecules_have_different_texts():
    """Pairs that refinement alone cannot tell apart, and isomers."""
    many = ["C1CCC2CCCCC2C1", "C1CCCC1C1CCCC1", "C1CC1C1CC1", "C1CCCCC1", "CC(C)CC", "CCCCC", "CC(C)(C)C", "Cc1ccccc1C", "Cc1cccc(C)c1", "Cc1ccc(C)cc1", "C1CC2CCC1CC2", "C1CC2CC1CCC2", "C12C3C4C1C5C2C3C45", "C1C2C3C1C1C2C31"]
    texts = [write(molecule_of(s)["atoms"]) for s in many]
    assert len(set(texts)) == len(many)


@pytest.mark.parametrize("smiles", SAME)
def test_inchi_gives_the_molecule_of_the_smiles(smiles):
    found = assembled(read_inchi("InChI=1S/" + SAME[smiles]))
    assert write(found["atoms"]) == write(molecule_of(smiles)["atoms"])


@pytest.mark.parametrize("bad", [None, "", "InChI=", "InChI=1S/", "C2H6O", "InChI=1S/C9/h(", "InChI=1S/C2H9/c1-2", "InChI=1S/CH4/q+9", "InChI=1S/C2H6/c1-2/h1-2H2"])
def test_no_inchi(bad):
    assert read_inchi(bad) is None or assembled(read_inchi(bad)) is None


def test_features_are_the_same_from_inchi_and_smiles(spark):
    texts = [(s, write(assembled(read_inchi("InChI=1S/" + i))["atoms"])) for s, i in SAME.items()]
    counts = [f for f in FEATURES if not f.endswith("Audit")]
    one = {r.s: r for r in annotate(spark.createDataFrame(texts, "s string, t string"), "s").collect()}
    two = {r.s: r for r in annotate(spark.createDataFrame(texts, "s string, t string"), "t").collect()}
    known = lambda rows: {s: [round(r[f], 6) if isinstance(r[f], float) else r[f] for f in counts] for s, r in rows.items()}  # noqa: E731  weights add up in another order
    assert known(one) == known(two) and len(one) == len(SAME)


def test_published_keys(spark):
    rows = [(f"InChI=1S/{i}", k) for i, k in KEYS.items()] + [(None, None), ("", None), ("InChI=1S/", None), ("x", None)]
    out = spark.createDataFrame(rows, "i string, k string").select("k", inchikey(F.col("i")).alias("got")).collect()
    assert [r.got for r in out] == [r.k for r in out]
    other = spark.createDataFrame([("InChI=1/CH4/h1H4",)], "i string").select(inchikey(F.col("i")).alias("got")).first().got
    assert other == "VNWKTOKETHGBQD-UHFFFAOYNA-N"


def laid(atoms, wanted, bonds):
    """Sets of atoms that a pattern of elements and bonds fits, by trying every choice."""
    found = set()
    for some in combinations(range(len(atoms)), len(wanted)):
        for order in permutations(some):
            if all(atoms[i]["z"] == z for i, z in zip(order, wanted, strict=True)) and all(any(n["j"] == order[b] and n["o"] == o for n in atoms[order[a]]["n"]) for a, b, o in bonds):
                found.add(some)
    return len(found)


def test_patterns_equal_brute_force(spark):
    shapes = {"[#6]-[#6]-[#6]": ("CCC", [(0, 1, 1), (1, 2, 1)]), "[#6]1-[#6]-[#6]1": ("CCC", [(0, 1, 1), (1, 2, 1), (0, 2, 1)]), "[#6](-[#6])(-[#6])-[#8]": ("CCCO", [(0, 1, 1), (0, 2, 1), (0, 3, 1)]), "[#6]=[#8]": ("CO", [(0, 1, 2)]), "[#6]:[#6]:[#7]": ("CCN", [(0, 1, 4), (1, 2, 4)])}
    texts = ["CC(C)(C)O", "C1CC1C", "C1CC1C1CC1", "CC(=O)CC(C)=O", "c1ccncc1", "OC1CC1O", "CC(C)CC(C)O", "O", "C"]
    read = spark.createDataFrame([(t,) for t in texts], "s string").withColumn("molecule", molecule(F.col("s")))
    for r in read.select("s", *[patterns.pattern_count(p).alias(str(k)) for k, p in enumerate(shapes)]).collect():
        for k, (elements, bonds) in enumerate(shapes.values()):
            assert r[str(k)] == laid(molecule_of(r.s)["atoms"], elements, bonds), (r.s, elements)


def test_pattern_conditions(spark):
    cases = {"[!C]": ("CCO", 1), "[C,O]": ("CCO", 3), "[C;!$(CO)]": ("CCO", 1), "[H3]": ("CCO", 1), "[CX4H2]": ("CCO", 1), "[+]": ("C[NH3+]", 1), "[O-]": ("CC([O-])=O", 1), "[R]": ("C1CC1C", 3), "C~C": ("C=CC#C", 3), "C!@C": ("C1CC1C", 1), "C=,#C": ("C=CC#C", 2), "[v4]": ("C=O", 1), "[$(C=O),$(C#N)]": ("N#CC=O", 2), "a": ("Cc1ccccc1", 6), "A": ("Cc1ccccc1", 1), "*": ("CO", 2), "Cl": ("CCl", 1), "[!#6;!#1]": ("CCBr", 1), "[D3]": ("CC(C)C", 1)}
    for pattern, (smiles, n) in cases.items():
        assert spark.createDataFrame([(smiles,)], "s string").withColumn("molecule", molecule(F.col("s"))).select(patterns.pattern_count(pattern).alias("n")).first().n == n, pattern
    for bad in ("", "C(", "[C", "C1CC", "[$(C]", "[Zz]", "?"):
        with pytest.raises(ValueError):
            patterns.pattern_count(bad)


def test_patterns_equal_the_features(spark):
    """Where both exist, the counts of patterns are those of the hand-written features, on every molecule of the tests."""
    pairs = {"Aldehyde": "AldehydeCount", "Nitrile": "NitrileCount", "Pyridine": "PyridineCount", "Thiazole": "ThiazoleCount", "Furan": "FuranCount", "Thiophene": "ThiopheneCount", "Indole": "IndoleCount", "AcrylateEster": "AcrylateEsterCount", "MethacrylateEster": "MethacrylateEsterCount", "CarboxylicAcid": "CarboxylicAcidCount", "Isoprenyl": "TerpeneLikeUnitCount", "Ether_Ring": "EtherRingCount", "DiarylEther": "DiarylEtherCount"}
    rows = annotate(spark.createDataFrame([(s,) for s in CASES], "smiles string")).withColumn("molecule", molecule(F.col("smiles"))).where("molecule IS NOT NULL")
    out = rows.select("smiles", *pairs.values(), *[patterns.pattern_count(structures.PATTERNS[p]).alias(p) for p in pairs]).collect()
    wrong = [(r.smiles, p) for r in out for p, f in pairs.items() if r[p] != r[f]]
    assert not wrong and len(out) > 60


def test_completed_structures(spark):
    ethanol = "InChI=1S/C2H6O/c1-2-3/h3H,2H2,1H3"
    rows = [(1, "OCC|x|", ethanol), (2, "C(", ethanol), (3, None, f" {ethanol} "), (4, "C(", "LFQSCWFLJHTTHZ"), (5, None, None), (6, "", "InChI=1S/x"), (7, "C", ethanol), (8, "OCC", None), (8, "OCC", None)]
    out = {r.i: tuple(r)[1:] for r in structures.complete_structures(spark.createDataFrame([(*x, 9) for x in rows], "i int, smiles string, inchi string, mw int")).collect()}
    whole = ("CCO", ethanol, "LFQSCWFLJHTTHZ-UHFFFAOYSA-N", 46.069)
    assert out == {
        1: (*whole, ""), 2: (*whole, "smiles_parse_failed"), 3: (*whole, ""), 4: ("C(", "LFQSCWFLJHTTHZ", "", None, "smiles_parse_failed"), 5: ("", "", "", None, "inchi_not_attempted_not_inchi"),
        6: ("", "InChI=1S/x", "", None, "inchi_parse_failed"), 7: ("C", "", "", 16.043, ""), 8: ("CCO", "", "", 46.069, ""),
    }


def test_descriptors_of_no_molecule_and_feeding_the_final_fields(spark):
    from chemlake.operators.properties import final_fields

    rows = descriptors.describe(spark.createDataFrame([(1, "CCO", 5.0), (2, None, 5.0), (3, "C(", 5.0), (4, "[Fe]", 5.0)], "i int, smiles string, computed_tpsa double"))
    out = {r.i: r for r in final_fields(rows).collect()}
    assert (out[1].computed_tpsa, out[1].final_tpsa, out[1].source_tpsa, out[1].final_clogp, out[1].final_smiles) == (20.23, "20.23", "computed", "-0.0014", "CCO") or (out[1].final_tpsa, out[1].source_tpsa) == (20.23, "computed")
    assert all(out[i].computed_tpsa is None and out[i].final_smiles is None and out[i].source_tpsa is None for i in (2, 3))
    assert out[4].computed_mw is None and out[4].source_mw is None and out[4].computed_hbd == 0


def read_texts(monkeypatch, module, tmp_path, names):
    """Files of a line for each text that the readers `names` of a module are given."""
    def noted(name):
        real = getattr(module, name)
        log = str(tmp_path / name)

        def reader(c):
            @F.arrow_udf("string")
            def note(texts: pa.Array) -> pa.Array:
                with open(log, "a") as f:
                    f.writelines(f"{t}\n" for t in texts.to_pylist() if t)
                return texts

            return real(note(c))

        return reader

    for name in names:
        monkeypatch.setattr(module, name, noted(name))
    return lambda name: (tmp_path / name).read_text().split()


@pytest.mark.parametrize("kind", ["completed", "described", "counted"])
def test_equal_texts_are_read_once_and_no_row_is_lost(spark, tmp_path, monkeypatch, kind):
    texts = [("CCO", ""), ("COC", None), (None, "InChI=1S/CH4/h1H4"), ("C(C", None), (None, None)]
    rows = spark.createDataFrame([(i, *texts[i % 5]) for i in range(200)], "i int, smiles string, inchi string")
    module = descriptors if kind == "described" else structures
    log = read_texts(monkeypatch, module, tmp_path, ["molecule"])
    run = {"completed": structures.complete_structures, "described": lambda d: descriptors.describe(d, inchi="inchi"), "counted": structures.count_patterns}[kind]
    found = run(rows).collect()
    assert sorted(log("molecule")) == ["C(C", "CCO", "COC"]
    # a molecule may hold several patterns
    places = {r.i for r in found} if kind == "counted" else [r.i for r in found]
    assert sorted(places) == [i for i in range(200) if kind != "counted" or i % 5 < 2]
