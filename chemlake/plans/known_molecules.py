"""What is known of the molecules of the registered query, for its SQL: counted by hand, or by rule and gone over by hand; no module under test is used here."""

from __future__ import annotations

import re

# Of each molecule its formula, share of sp3 carbons, features that are not 0 (1 where no number stands), and audits.
KNOWN = {
    "CCO": ("C2H6O", "2/2", "PrimaryAlcoholCount", {"AlcoholAudit": "primary@O2-C1"}),
    "CC(C)O": ("C3H8O", "3/3", "SecondaryAlcoholCount", {"AlcoholAudit": "secondary@O3-C1"}),
    "CC(C)(C)O": ("C4H10O", "4/4", "TertiaryAlcoholCount", {"AlcoholAudit": "tertiary@O4-C1"}),
    "Oc1ccccc1": ("C6H6O", "0/6", "PhenolCount NumUnsaturatedBonds_All=6 NumUnsaturatedBonds=6 *6", {"AlcoholAudit": "phenol@O0-C1"}),
    "CCC=O": ("C3H6O", "2/3", "AldehydeCount AldehydeCount_NoAlphaBetaSub NumUnsaturatedBonds_All", {"AldehydeAudit": "ald@C2:noAlphaBetaSub:acyclic"}),
    "O=CC=CC": ("C4H6O", "1/4", "AldehydeCount AlphaBetaUnsaturatedAldehydeCount AldehydeCount_NoAlphaBetaSub NumUnsaturatedBonds_All=2 NumUnsaturatedBonds NumAlkeneBonds", {"AldehydeAudit": "ald@C1:noAlphaBetaSub:acyclic:ab-unsat"}),
    "O=Cc1ccccc1": ("C7H6O", "0/7", "AldehydeCount ArylAldehydeCount AlphaBetaUnsaturatedAldehydeCount NumUnsaturatedBonds_All=7 NumUnsaturatedBonds=6 *6", {"AldehydeAudit": "ald@C1:aryl:ab-unsat"}),
    "CC(=O)C": ("C3H6O", "2/3", "KetoneCount NumUnsaturatedBonds_All", {}),
    "CC(=O)OC": ("C3H6O2", "2/3", "EsterCount_Total EsterCount_Open NumUnsaturatedBonds_All", {}),
    "O=C1CCCO1": ("C4H6O2", "3/4", "EsterCount_Total LactoneCount NumUnsaturatedBonds_All NumRingsTotal NumAliphaticRings EtherRingCount", {}),
    "CC(=O)O": ("C2H4O2", "1/2", "CarboxylicAcidCount CarboxylicAcidCount_Fragment NumUnsaturatedBonds_All", {}),
    "CSSC": ("C2H6S2", "2/2", "DisulfideCount", {}),
    "CS(=O)(=O)C": ("C2H6O2S", "2/2", "SulfoneCount NumUnsaturatedBonds_All=2", {}),
    "CS(C)=O": ("C2H6OS", "2/2", "SulfoxideCount NumUnsaturatedBonds_All", {}),
    "C[N+](=O)[O-]": ("CH3NO2", "1/1", "NitroGroupCount NumUnsaturatedBonds_All", {}),
    "CC#N": ("C2H3N", "1/2", "NitrileCount NumUnsaturatedBonds_All", {}),
    "CN": ("CH5N", "1/1", "AmineCount_Primary", {}),
    "CNC": ("C2H7N", "2/2", "AmineCount_Secondary", {}),
    "CN(C)C": ("C3H9N", "3/3", "AmineCount_Tertiary", {}),
    "c1ccncc1": ("C5H5N", "0/5", "PyridineCount NumUnsaturatedBonds_All=6 NumUnsaturatedBonds=4 *6", {}),
    "o1cccc1": ("C4H4O", "0/4", "FuranCount NumUnsaturatedBonds_All=5 NumUnsaturatedBonds=3 *5", {}),
    "s1cccc1": ("C4H4S", "0/4", "ThiopheneCount ThioetherCount NumUnsaturatedBonds_All=5 NumUnsaturatedBonds=3 *5", {}),
    "C1CO1": ("C2H4O", "2/2", "EtherCount_Total EtherCount_Cyclic EpoxideCount NumRingsTotal NumAliphaticRings EtherRingCount", {}),
    "COC": ("C2H6O", "2/2", "EtherCount_Total EtherCount_Acyclic EtherAliphaticCount", {}),
    "COc1ccccc1": ("C7H8O", "1/7", "EtherCount_Total EtherCount_Acyclic ArylOAlkylEtherCount EtherMixedCount NumUnsaturatedBonds_All=6 NumUnsaturatedBonds=6 *6", {}),
    "ClCCl": ("CH2Cl2", "1/1", "HalogenAtomCount_Total=2 HalogenAtomCount_Cl=2 HalogenatedCarbonCount HalogenatedCarbonCount_Cl HalogenatedAlkylCarbonCount_Cl", {}),
    "Oc1ccc(Cl)cc1": ("C6H5OCl", "0/6", "PhenolCount HalogenAtomCount_Total HalogenAtomCount_Cl HalogenatedCarbonCount HalogenatedCarbonCount_Cl HalogenatedArylCarbonCount_Cl HalogenatedPhenolCount HalogenatedPhenolCount_Cl NumUnsaturatedBonds_All=6 NumUnsaturatedBonds=6 *6", {"AlcoholAudit": "phenol@O0-C1"}),
    "O=C1CCCCCCCCCCC1": ("C12H22O", "11/12", "KetoneCount MacroMusks_Ketones NumUnsaturatedBonds_All NumRingsTotal NumAliphaticRings", {}),
    "C=C(C)C=C": ("C5H8", "1/5", "NumUnsaturatedBonds_All=2 NumUnsaturatedBonds=2 NumAlkeneBonds=2 IsPureHydrocarbon IsHydrocarbonAliphatic TerpeneLikeUnitCount IsTerpeneHydrocarbon", {}),
    "CC(C)=NO": ("C3H7NO", "2/3", "OximeCount NumUnsaturatedBonds_All", {}),
    "OCCO": ("C2H6O2", "2/2", "PrimaryAlcoholCount=2 Vicinal12DiolCount IsPolyol", {"AlcoholAudit": "primary@O0-C1; primary@O3-C2"}),
    "OCCCO": ("C3H8O2", "3/3", "PrimaryAlcoholCount=2 OneThreeDiolCount IsPolyol", {"AlcoholAudit": "primary@O0-C1; primary@O4-C3"}),
    "COC(C)OC": ("C4H10O2", "4/4", "AcetalCount EtherCount_Total=2 EtherCount_Acyclic=2 EtherAliphaticCount=2", {}),
    "COC(C)(C)OC": ("C5H12O2", "5/5", "KetalCount EtherCount_Total=2 EtherCount_Acyclic=2 EtherAliphaticCount=2", {}),
    "COC(OC)OC": ("C4H10O3", "4/4", "OrthoesterCount EtherCount_Total=3 EtherCount_Acyclic=3 EtherAliphaticCount=3", {}),
    "COC(C)O": ("C3H8O2", "3/3", "PrimaryAlcoholCount HemiacetalCount EtherCount_Total EtherCount_Acyclic EtherAliphaticCount", {"AlcoholAudit": "hemiacetal@O4-C2; primary@O4-C2"}),
    "COC(C)(C)O": ("C4H10O2", "4/4", "SecondaryAlcoholCount HemiketalCount EtherCount_Total EtherCount_Acyclic EtherAliphaticCount", {"AlcoholAudit": "hemiketal@O5-C2; secondary@O5-C2"}),
    "C=CO": ("C2H4O", "0/2", "EnolicOHCount NumUnsaturatedBonds_All NumUnsaturatedBonds NumAlkeneBonds", {"AlcoholAudit": "enol@O2-C1"}),
    "CC(O)C(C)=O": ("C4H8O2", "3/4", "AlphaHydroxyCarbonylCount KetoneCount NumUnsaturatedBonds_All", {"AlcoholAudit": "alpha2carbonyl@O2-C1"}),
    "Cc1ccccc1O": ("C7H8O", "1/7", "PhenolCount AlkylPhenolCount NumUnsaturatedBonds_All=6 NumUnsaturatedBonds=6 *6", {"AlcoholAudit": "phenol@O7-C6"}),
    "COC(=O)CC(=O)OC": ("C5H8O4", "3/5", "EsterCount_Total=2 NumUnsaturatedBonds_All=2 MalonateDiesterCount MalonateLikeCount EsterCount_Open=2", {}),
    "OC(=O)CC(=O)OC": ("C4H6O4", "2/4", "EsterCount_Total CarboxylicAcidCount NumUnsaturatedBonds_All=2 MalonateHalfEsterCount MalonateLikeCount CarboxylicAcidCount_Fragment EsterCount_Open", {}),
    "OC(=O)CC(=O)O": ("C3H4O4", "1/3", "CarboxylicAcidCount=2 NumUnsaturatedBonds_All=2 MalonicAcidCount MalonateLikeCount CarboxylicAcidCount_Fragment=2", {}),
    "CC=NC": ("C3H7N", "2/3", "ImineCount NumUnsaturatedBonds_All", {}),
    "CC(=O)N": ("C2H5NO", "1/2", "AmideCount_Total NumUnsaturatedBonds_All", {}),
    "O=C1CCCN1": ("C4H7NO", "3/4", "AmideCount_Total LactamCount NumRingsTotal NumUnsaturatedBonds_All NumAliphaticRings", {}),
    "NC(=O)N": ("CH4N2O", "0/1", "UreaCount NumUnsaturatedBonds_All", {}),
    "COC(=O)N": ("C2H5NO2", "1/2", "EsterCount_Total UrethaneCount NumUnsaturatedBonds_All EsterCount_Open", {}),
    "CN=C=O": ("C2H3NO", "1/2", "IsocyanateCount NumUnsaturatedBonds_All=2", {}),
    "CS": ("CH4S", "1/1", "ThiolCount AliphaticThiolCount", {}),
    "Sc1ccccc1": ("C6H6S", "0/6", "ThiolCount ThiophenolCount NumUnsaturatedBonds_All=6 NumUnsaturatedBonds=6 *6", {}),
    "CC(=O)SC": ("C3H6OS", "2/3", "ThioesterCount NumUnsaturatedBonds_All", {}),
    "CSC": ("C2H6S", "2/2", "ThioetherCount", {}),
    "Cc1ccccc1S": ("C7H8S", "1/7", "ThiolCount ThiophenolCount NumUnsaturatedBonds_All=6 NumUnsaturatedBonds=6 Thiophenol_OrthoCount *6", {}),
    "Cc1cccc(S)c1": ("C7H8S", "1/7", "ThiolCount ThiophenolCount NumUnsaturatedBonds_All=6 NumUnsaturatedBonds=6 Thiophenol_MetaCount *6", {}),
    "Cc1ccc(S)cc1": ("C7H8S", "1/7", "ThiolCount ThiophenolCount NumUnsaturatedBonds_All=6 NumUnsaturatedBonds=6 Thiophenol_ParaCount *6", {}),
    "C=CCO": ("C3H6O", "1/3", "PrimaryAlcoholCount AllylicAlcoholCount NumUnsaturatedBonds_All NumUnsaturatedBonds NumAlkeneBonds", {"AlcoholAudit": "primary@O3-C2"}),
    "OCc1ccccc1": ("C7H8O", "1/7", "PrimaryAlcoholCount BenzylicAlcoholCount NumUnsaturatedBonds_All=6 NumUnsaturatedBonds=6 *6", {"AlcoholAudit": "primary@O0-C1"}),
    "C#CCO": ("C3H4O", "1/3", "PrimaryAlcoholCount PropargylicAlcoholCount NumUnsaturatedBonds_All NumUnsaturatedBonds NumAlkyneBonds", {"AlcoholAudit": "primary@O3-C2"}),
    "c1nccs1": ("C3H3NS", "0/3", "ThioetherCount ThiazoleCount NumUnsaturatedBonds_All=5 NumUnsaturatedBonds *5", {}),
    "c1ccc2[nH]ccc2c1": ("C8H7N", "0/8", "NumAromaticAtoms=9 NumRingsTotal=2 NumAromaticRings=2 NumUnsaturatedBonds_All=10 NumUnsaturatedBonds=8 IndoleCount", {}),
    "c1ccc(Oc2ccccc2)cc1": ("C12H10O", "0/12", "EtherCount_Total EtherCount_Acyclic DiarylEtherCount NumAromaticAtoms=12 NumRingsTotal=2 NumAromaticRings=2 NumUnsaturatedBonds_All=12 NumUnsaturatedBonds=12 EtherAromaticCount", {}),
    "O=CC1CCCCC1": ("C7H12O", "6/7", "AldehydeCount CyclicAliphaticAldehydeCount NumRingsTotal NumUnsaturatedBonds_All CyclicAldehyde_BetaSubCount_0 CyclicAldehyde_NonBetaSubstitutedCount NumAliphaticRings", {"AldehydeAudit": "ald@C1:cyclicBetaSub=0:cyclic-aliph"}),
    "O=CC1CCCCC1C": ("C8H14O", "7/8", "AldehydeCount CyclicAliphaticAldehydeCount NumRingsTotal NumUnsaturatedBonds_All CyclicAldehyde_BetaSubCount_1 CyclicAldehyde_BetaSubstitutedCount NumAliphaticRings", {"AldehydeAudit": "ald@C1:cyclicBetaSub=1:cyclic-aliph"}),
    "CC1CCCC(C)C1C=O": ("C9H16O", "8/9", "AldehydeCount CyclicAliphaticAldehydeCount NumRingsTotal NumUnsaturatedBonds_All CyclicAldehyde_BetaSubCount_2 CyclicAldehyde_BetaSubstitutedCount NumAliphaticRings", {"AldehydeAudit": "ald@C8:cyclicBetaSub=2:cyclic-aliph"}),
    "CCC(C)C=O": ("C5H10O", "4/5", "AldehydeCount NumUnsaturatedBonds_All AldehydeCount_AlphaSubstituted", {"AldehydeAudit": "ald@C4:alphaSub:acyclic"}),
    "CC(C)CC=O": ("C5H10O", "4/5", "AldehydeCount NumUnsaturatedBonds_All AldehydeCount_BetaSubstituted", {"AldehydeAudit": "ald@C4:betaSub:acyclic"}),
    "C=CC(=O)OC": ("C4H6O2", "1/4", "EsterCount_Total NumUnsaturatedBonds_All=2 NumUnsaturatedBonds NumAlkeneBonds AcrylateEsterCount EsterCount_Open", {}),
    "C=C(C)C(=O)OC": ("C5H8O2", "2/5", "EsterCount_Total NumUnsaturatedBonds_All=2 NumUnsaturatedBonds NumAlkeneBonds MethacrylateEsterCount TerpeneLikeUnitCount EsterCount_Open", {}),
    "c1ccc2ccccc2c1": ("C10H8", "0/10", "NumAromaticAtoms=10 NumRingsTotal=2 NumAromaticRings=2 NumUnsaturatedBonds_All=11 NumUnsaturatedBonds=11 IsPureHydrocarbon HydrocarbonRingCount=2 IsHydrocarbonAromatic", {}),
    "C1CCCCC1": ("C6H12", "6/6", "NumRingsTotal IsPureHydrocarbon NumAliphaticRings HydrocarbonRingCount IsHydrocarbonAliphatic", {}),
    "CF": ("CH3F", "1/1", "HalogenAtomCount_Total HalogenatedCarbonCount HalogenAtomCount_F HalogenatedCarbonCount_F HalogenatedAlkylCarbonCount_F", {}),
    "CBr": ("CH3Br", "1/1", "HalogenAtomCount_Total HalogenatedCarbonCount HalogenAtomCount_Br HalogenatedCarbonCount_Br HalogenatedAlkylCarbonCount_Br", {}),
    "CI": ("CH3I", "1/1", "HalogenAtomCount_Total HalogenatedCarbonCount HalogenAtomCount_I HalogenatedCarbonCount_I HalogenatedAlkylCarbonCount_I", {}),
    "Fc1ccccc1": ("C6H5F", "0/6", "HalogenAtomCount_Total HalogenatedCarbonCount NumUnsaturatedBonds_All=6 NumUnsaturatedBonds=6 HalogenAtomCount_F HalogenatedCarbonCount_F HalogenatedArylCarbonCount_F *6", {}),
    "Brc1ccccc1": ("C6H5Br", "0/6", "HalogenAtomCount_Total HalogenatedCarbonCount NumUnsaturatedBonds_All=6 NumUnsaturatedBonds=6 HalogenAtomCount_Br HalogenatedCarbonCount_Br HalogenatedArylCarbonCount_Br *6", {}),
    "Ic1ccccc1": ("C6H5I", "0/6", "HalogenAtomCount_Total HalogenatedCarbonCount NumUnsaturatedBonds_All=6 NumUnsaturatedBonds=6 HalogenAtomCount_I HalogenatedCarbonCount_I HalogenatedArylCarbonCount_I *6", {}),
    "Oc1ccccc1F": ("C6H5FO", "0/6", "PhenolCount HalogenAtomCount_Total HalogenatedCarbonCount HalogenatedPhenolCount NumUnsaturatedBonds_All=6 NumUnsaturatedBonds=6 HalogenatedPhenolCount_F HalogenAtomCount_F HalogenatedCarbonCount_F HalogenatedArylCarbonCount_F *6", {"AlcoholAudit": "phenol@O0-C1"}),
    "Oc1ccccc1Br": ("C6H5BrO", "0/6", "PhenolCount HalogenAtomCount_Total HalogenatedCarbonCount HalogenatedPhenolCount NumUnsaturatedBonds_All=6 NumUnsaturatedBonds=6 HalogenatedPhenolCount_Br HalogenAtomCount_Br HalogenatedCarbonCount_Br HalogenatedArylCarbonCount_Br *6", {"AlcoholAudit": "phenol@O0-C1"}),
    "Oc1ccccc1I": ("C6H5IO", "0/6", "PhenolCount HalogenAtomCount_Total HalogenatedCarbonCount HalogenatedPhenolCount NumUnsaturatedBonds_All=6 NumUnsaturatedBonds=6 HalogenatedPhenolCount_I HalogenAtomCount_I HalogenatedCarbonCount_I HalogenatedArylCarbonCount_I *6", {"AlcoholAudit": "phenol@O0-C1"}),
    "C#C": ("C2H2", "0/2", "NumUnsaturatedBonds_All NumUnsaturatedBonds NumAlkyneBonds IsPureHydrocarbon IsHydrocarbonAliphatic", {}),
    "O=C1CCCCCCCCCCCO1": ("C12H22O2", "11/12", "EsterCount_Total LactoneCount NumRingsTotal NumUnsaturatedBonds_All MacroMusks_Lactones NumAliphaticRings EtherRingCount", {}),
    "CC(C)OC(C)C": ("C6H14O", "6/6", "EtherCount_Total EtherCount_Acyclic EtherAliphaticCount", {}),
}
# Mean masses of the elements in them, and what totals add up.
WEIGHTS = {"H": 1.008, "C": 12.011, "N": 14.007, "O": 15.999, "F": 18.998, "S": 32.06, "Cl": 35.45, "Br": 79.904, "I": 126.904}
TOTALS = {
    "TotalAlcoholCount": "PrimaryAlcoholCount SecondaryAlcoholCount TertiaryAlcoholCount PhenolCount AlphaHydroxyCarbonylCount EnolicOHCount",
    "EtherCount": "EtherCount_Total",
    "NitrileFragmentCount": "NitrileCount",
    "AmineCount_Total": "AmineCount_Primary AmineCount_Secondary AmineCount_Tertiary",
    "MacroMusks_Total": "MacroMusks_Ketones MacroMusks_Lactones",
    "TotalSulfurGroupCount": "ThiolCount ThiophenolCount AliphaticThiolCount DisulfideCount ThioesterCount ThioetherCount SulfoxideCount SulfoneCount",
    "TotalNitrogenGroupCount": "AmineCount_Total NitrileCount NitroGroupCount PyridineCount ThiazoleCount",
    "HighImpactTier1Count": "ThiophenolCount AliphaticThiolCount DisulfideCount SulfoxideCount SulfoneCount HalogenatedPhenolCount HalogenatedCarbonCount NitroGroupCount AlphaBetaUnsaturatedAldehydeCount",
    "HighImpactTier2Count": "EnolicOHCount ThioetherCount MalonateLikeCount AldehydeCount_AlphaSubstituted AldehydeCount_BetaSubstituted PhenolCount Thiophenol_OrthoCount Thiophenol_MetaCount Thiophenol_ParaCount NitrileCount",
}


def _counts(formula: str) -> dict[str, int]:
    return {element: int(n or 1) for element, n in re.findall(r"([A-Z][a-z]?)(\d*)", formula)}


def features(smiles: str) -> dict[str, int | float | str]:
    """All features of a known molecule that are not 0 or ''; totals and what the formula says are added up by rule."""
    formula, sp3, counted, audits = KNOWN[smiles]
    atoms, out = _counts(formula), {"Valid": 1}
    for word in counted.split():
        if word[0] == "*":  # one aromatic ring of so many atoms
            out |= {"NumAromaticAtoms": int(word[1:]), "NumRingsTotal": 1, "NumAromaticRings": 1}
        else:
            name, _, n = word.partition("=")
            out[name] = int(n or 1)
    out |= {"CarbonAtomCount": atoms.get("C", 0), "TotalNitrogenAtomCount": atoms.get("N", 0), "TotalSulfurAtomCount": atoms.get("S", 0)}
    for _ in range(2):  # totals of totals
        for name, parts in TOTALS.items():
            out[name] = sum(out.get(p, 0) for p in parts.split())
    one, all_ = map(int, sp3.split("/"))
    out |= {"MolecularWeight": round(sum(WEIGHTS[e] * n for e, n in atoms.items()), 3), "FractionCSP3": round(one / all_, 6)}
    out |= {"IsFullySaturated": int(out.get("NumUnsaturatedBonds", 0) == 0), "HighImpactSummary": f"T1:{out['HighImpactTier1Count']}; T2:{out['HighImpactTier2Count']}"}
    return {k: v for k, v in (out | audits).items() if v}
