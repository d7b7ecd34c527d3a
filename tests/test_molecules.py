"""Functional groups of known molecules."""

import pytest
from pyspark.sql import functions as F

from chemlake.functions.smiles import clean_smiles, molecule_of
from chemlake.operators.molecules import FEATURES, annotate

CASES = {
    "CCO": {"Valid": 1, "PrimaryAlcoholCount": 1, "TotalAlcoholCount": 1, "PhenolCount": 0},
    "CC(C)O": {"SecondaryAlcoholCount": 1}, "CC(C)(C)O": {"TertiaryAlcoholCount": 1},
    "COC(=O)c1ccccc1N=C(C)O": {"OximeCount": 1, "TotalAlcoholCount": 0},
    "CCC=O": {"AldehydeCount": 1, "ArylAldehydeCount": 0, "CyclicAliphaticAldehydeCount": 0, "AlphaBetaUnsaturatedAldehydeCount": 0},
    "O=CC=CC": {"AldehydeCount": 1, "AlphaBetaUnsaturatedAldehydeCount": 1, "ArylAldehydeCount": 0},
    "O=Cc1ccccc1": {"AldehydeCount": 1, "ArylAldehydeCount": 1, "AlphaBetaUnsaturatedAldehydeCount": 1, "CyclicAliphaticAldehydeCount": 0},
    "O=CC1CCCCC1": {"AldehydeCount": 1, "CyclicAliphaticAldehydeCount": 1},
    "O=C1CCCCCCCCCCC1": {"MacroMusks_Total": 1, "MacroMusks_Ketones": 1, "MacroMusks_Lactones": 0},
    "Oc1ccc(Cl)cc1": {"HalogenAtomCount_Cl": 1, "HalogenAtomCount_Total": 1, "HalogenatedCarbonCount_Cl": 1, "PhenolCount": 1, "HalogenatedPhenolCount": 1, "HalogenatedArylCarbonCount_Cl": 1},
    "CS(=O)(=O)C": {"SulfoneCount": 1, "SulfoxideCount": 0}, "CS(C)=O": {"SulfoneCount": 0, "SulfoxideCount": 1},
    "NOT_A_SMILES": {"Valid": 0, "CarbonAtomCount": 0}, "o1cccc1": {"FuranCount": 1}, "c1ccncc1": {"PyridineCount": 1}, "s1cccc1": {"ThiopheneCount": 1}, "c1nccs1": {"ThiazoleCount": 1},
    "C[N+](=O)[O-]": {"NitroGroupCount": 1, "AmineCount_Total": 0}, "Cc1c([N+](=O)[O-])cc([N+](=O)[O-])cc1[N+](=O)[O-]": {"NitroGroupCount": 3}, "CN=O": {"NitroGroupCount": 0, "ImineCount": 0},
    "NO": {"TotalAlcoholCount": 0}, "OP(=O)(O)O": {"TotalAlcoholCount": 0}, "CC(=O)O": {"TotalAlcoholCount": 0, "CarboxylicAcidCount": 1}, "[O-]c1ccccc1": {"PhenolCount": 0},
    "CCOC": {"TotalAlcoholCount": 0, "EtherCount_Total": 1, "EtherCount_Acyclic": 1}, "C1CO1": {"EtherCount_Cyclic": 1, "EpoxideCount": 1}, "COc1ccccc1": {"ArylOAlkylEtherCount": 1}, "c1ccc(Oc2ccccc2)cc1": {"DiarylEtherCount": 1},
    "CC(=O)C": {"KetoneCount": 1, "TotalAlcoholCount": 0}, "CC(=O)OC": {"EsterCount_Total": 1, "LactoneCount": 0, "EtherCount_Total": 0}, "O=C1CCCO1": {"LactoneCount": 1},
    "CN": {"AmineCount_Primary": 1}, "CNC": {"AmineCount_Secondary": 1}, "CN(C)C": {"AmineCount_Tertiary": 1, "AmineCount_Total": 1}, "C[NH3+]": {"AmineCount_Primary": 1}, "CC(=O)N": {"AmineCount_Total": 0, "AmideCount_Total": 1},
    "O=C1CCCN1": {"LactamCount": 1}, "NC(=O)N": {"UreaCount": 1, "AmideCount_Total": 0}, "COC(=O)N": {"UrethaneCount": 1}, "CN=C=O": {"IsocyanateCount": 1, "ImineCount": 0}, "CC=NC": {"ImineCount": 1}, "CC#N": {"NitrileCount": 1},
    "CS": {"ThiolCount": 1, "AliphaticThiolCount": 1}, "Sc1ccccc1": {"ThiophenolCount": 1}, "CSSC": {"DisulfideCount": 1}, "CSC": {"ThioetherCount": 1}, "CC(=O)SC": {"ThioesterCount": 1, "ThioetherCount": 0},
    "C=CCO": {"AllylicAlcoholCount": 1, "PrimaryAlcoholCount": 1}, "OCc1ccccc1": {"BenzylicAlcoholCount": 1}, "C#CCO": {"PropargylicAlcoholCount": 1}, "C=CO": {"EnolicOHCount": 1, "TotalAlcoholCount": 1, "PrimaryAlcoholCount": 0, "AlcoholAudit": "enol@O2-C1"},
    "CC(O)C(C)=O": {"AlphaHydroxyCarbonylCount": 1, "TotalAlcoholCount": 1, "SecondaryAlcoholCount": 0}, "COC(C)OC": {"AcetalCount": 1}, "COC(C)(C)OC": {"KetalCount": 1}, "COC(OC)OC": {"OrthoesterCount": 1}, "COC(C)O": {"HemiacetalCount": 1}, "COC(C)(C)O": {"HemiketalCount": 1},
    "C1=CC=CC=C1O": {"PhenolCount": 1, "NumAromaticAtoms": 6, "NumAromaticRings": 1}, "C=C(C)C=C": {"NumAlkeneBonds": 2, "IsPureHydrocarbon": 1, "IsFullySaturated": 0}, "C#C": {"NumAlkyneBonds": 1},
    "CCC(C)C=O": {"AldehydeCount_AlphaSubstituted": 1, "AldehydeCount_BetaSubstituted": 0}, "CC(C)CC=O": {"AldehydeCount_BetaSubstituted": 1, "AldehydeCount_NoAlphaBetaSub": 0, "AldehydeAudit": "ald@C4:betaSub:acyclic"},
    "CCCC=O": {"AldehydeCount_NoAlphaBetaSub": 1, "AldehydeCount_BetaSubstituted": 0}, "O=CC1CCCCC1C": {"CyclicAldehyde_BetaSubCount_1": 1, "CyclicAldehyde_BetaSubstitutedCount": 1, "CyclicAldehyde_BetaSubCount_0": 0},
    "COC(=O)CC(=O)OC": {"MalonateDiesterCount": 1, "MalonateLikeCount": 1}, "OC(=O)CC(=O)OC": {"MalonateHalfEsterCount": 1}, "OC(=O)CC(=O)O": {"MalonicAcidCount": 1},
    "C=CC(=O)OC": {"AcrylateEsterCount": 1, "MethacrylateEsterCount": 0}, "C=C(C)C(=O)OC": {"MethacrylateEsterCount": 1, "AcrylateEsterCount": 0},
    "Cc1ccccc1S": {"Thiophenol_OrthoCount": 1, "Thiophenol_MetaCount": 0}, "Cc1cccc(S)c1": {"Thiophenol_MetaCount": 1, "Thiophenol_OrthoCount": 0}, "Cc1ccc(S)cc1": {"Thiophenol_ParaCount": 1, "Thiophenol_OrthoCount": 0},
    "Oc1ccccc1Br": {"HalogenatedPhenolCount_Br": 1, "HalogenatedPhenolCount_Cl": 0}, "c1ccc2[nH]ccc2c1": {"IndoleCount": 1, "AmineCount_Total": 0}, "CC(C)=CCC": {"TerpeneLikeUnitCount": 1, "IsTerpeneHydrocarbon": 1},
    "OCCCO": {"OneThreeDiolCount": 1, "Vicinal12DiolCount": 0, "AlcoholAudit": "primary@O0-C1; primary@O4-C3"}, "CCOCC": {"EtherAliphaticCount": 1, "EtherRingCount": 0}, "C1CCOC1": {"EtherRingCount": 1, "EtherAliphaticCount": 0},
    "CC([O-])=O": {"CarboxylicAcidCount_Fragment": 1, "CarboxylicAcidCount": 0}, "C1CCCCC1": {"NumAliphaticRings": 1, "IsHydrocarbonAliphatic": 1, "HydrocarbonRingCount": 1},
    "OCCO": {"IsPolyol": 1, "TotalAlcoholCount": 2, "Vicinal12DiolCount": 1}, "c1ccc2ccccc2c1": {"NumRingsTotal": 2, "NumAromaticRings": 2, "CarbonAtomCount": 10}, "Cc1ccccc1O": {"AlkylPhenolCount": 1}, "ClCC(F)F": {"HalogenatedAlkylCarbonCount_Cl": 1, "HalogenAtomCount_F": 2, "HalogenatedCarbonCount": 2},
}


@pytest.fixture(scope="module")
def features(spark):
    rows = annotate(spark.createDataFrame([(s,) for s in CASES], "smiles string")).collect()
    return {r.smiles: r.asDict() for r in rows}


@pytest.mark.parametrize("smiles", CASES)
def test_counts(features, smiles):
    assert {k: features[smiles][k] for k in CASES[smiles]} == CASES[smiles]


def test_weights_and_schema(features):
    assert features["CCO"]["MolecularWeight"] == pytest.approx(46.07, abs=0.01)
    assert features["CS"]["HighImpactSummary"] == "T1:1; T2:0"
    assert set(features["NOT_A_SMILES"]) == set(features["CCO"]) and features["NOT_A_SMILES"]["HighImpactSummary"] == "T1:0; T2:0"


@pytest.mark.parametrize("bad", ["", "C(", "C1CC", "C)", "[C", "C=", "Xx", None, "cccc", "CN(C)(C)(C)C"])
def test_no_molecules(bad):
    assert molecule_of(bad) is None


def test_cleaning(spark):
    rows = [("CCO.[Na]", "CCO"), (" CC ", "CC"), ("[Na].Cl", "[Na]"), ("C.CC", "CC"), ("", ""), (None, ""), ("&nbsp;", ""), ("NBSP", ""), ("C=C\t\n", "C=C"), ("C\nC", "CC"), ("C&lt;C", "C<C"), ("CC&#46;O", "CC"), ("[Cl-].[Na+].CCO", "CCO")]
    rows += [("CCO.CCOC", "CCOC"), ("CCO.NOT_A_SMILES", "CCO"), ("not_smiles.bad", "not_smiles"), ("OS(=O)(=O)O.[Cu]", "OS(=O)(=O)O"), ("..", "")]
    out = spark.createDataFrame(rows, "raw string, want string").select(clean_smiles(F.col("raw")).alias("got"), "want").collect()
    assert [r.got for r in out] == [r.want for r in out]


def test_null_and_repeated_rows(spark):
    out = annotate(spark.createDataFrame([(1, None, 5), (2, "CCO", 5), (2, "CCO", 5)], "i int, smiles string, Valid int")).collect()
    assert sorted((r.i, r.Valid, r.PrimaryAlcoholCount) for r in out) == [(1, 0, 0), (2, 1, 1), (2, 1, 1)]


def test_features_are_the_schema(spark):
    assert [c for c in annotate(spark.createDataFrame([("C",)], "smiles string")).columns if c != "smiles"] == FEATURES and len(set(FEATURES)) == len(FEATURES)
