"""Counts of functional groups and other features of molecules, as expressions over atoms and bonds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chemlake.functions import sql_text as S
from chemlake.functions.sql_text import Text
from chemlake.functions.smiles import WEIGHTS, clean_smiles, molecule

HALOGENS = ("F", "Cl", "Br", "I")
SINGLE, DOUBLE, TRIPLE, AROMATIC = 1, 2, 3, 4


class Groups:
    """Expressions over a molecule's atoms and rings; atoms and neighbours are structs (see functions.smiles).

    What many features ask of an atom is a field of it by the time they do (see `marked`).
    """

    def __init__(self, atoms: Text, rings: Text):
        self.atoms, self.rings = atoms, rings

    def atom(self, n: Text) -> Text:
        """The atom that a neighbour is."""
        return S.get(self.atoms, n["j"])

    def count(self, where) -> Text:
        return S.size(S.filter(self.atoms, where))

    def pairs(self, where) -> Text:
        """Bonds (atom, neighbour) in either direction that fulfil a condition."""
        return S.aggregate(S.transform(self.atoms, lambda a: S.size(S.filter(a["n"], lambda n: where(a, n)))), S.lit(0), lambda x, y: x + y)

    @staticmethod
    def has(a: Text, order: int, element: str) -> Text:
        return S.exists(a["n"], lambda n: (n["o"] == order) & (n["z"] == element))

    @staticmethod
    def number(a: Text, order: int, element: str) -> Text:
        return S.size(S.filter(a["n"], lambda n: (n["o"] == order) & (n["z"] == element)))

    @staticmethod
    def carbonyl(a: Text) -> Text:
        return a["carbonyl"]

    @staticmethod
    def near_carbonyl(a: Text) -> Text:
        """A carbon neighbour is C=O."""
        return a["near_carbonyl"]

    @staticmethod
    def sp3(a: Text) -> Text:
        return a["sp3"]

    @staticmethod
    def carbons(a: Text) -> Text:
        return a["carbons"]

    @staticmethod
    def hydroxyl(o: Text) -> Text:
        return o["hydroxyl"]

    def host(self, o: Text) -> Text:
        """The atom that holds a hydroxyl."""
        return self.atom(S.get(o["n"], S.lit(0)))

    def oxime(self, o: Text) -> Text:
        """A hydroxyl on N=C, or on C=N."""
        c = self.host(o)
        return ((c["z"] == "N") & self.has(c, DOUBLE, "C")) | ((c["z"] == "C") & self.has(c, DOUBLE, "N"))

    @staticmethod
    def alcohol_site(o: Text) -> Text:
        """A hydroxyl on carbon that is no acid and no oxime."""
        return o["site"]

    @staticmethod
    def enolic(o: Text) -> Text:
        return o["enolic"]

    @staticmethod
    def alpha_hydroxy(o: Text) -> Text:
        return o["alpha_hydroxy"]

    def beside(self, c: Text, order: int) -> Text:
        """An sp3 carbon next to a carbon with such a bond to carbon."""
        return self.sp3(c) & S.exists(c["n"], lambda n: (n["z"] == "C") & self.has(self.atom(n), order, "C"))

    def alkoxy(self, n: Text) -> Text:
        """A neighbour that is the oxygen of an ether-like C-O-C."""
        o = self.atom(n)
        return (n["z"] == "O") & (n["o"] == SINGLE) & (o["h"] == 0) & (self.carbons(o) == 2)

    @staticmethod
    def ether(o: Text) -> Text:
        return o["ether"]

    @staticmethod
    def ester(c: Text) -> Text:
        """C(=O)-O-C that is no anhydride."""
        return c["ester"]

    def lactone(self, c: Text) -> Text:
        return self.ester(c) & S.exists(c["n"], lambda n: self.alkoxy(n) & n["r"])

    def acyl_nitrogen(self, c: Text, nitrogen: int, oxygen: int) -> Text:
        """A carbonyl carbon with so many single-bonded nitrogens and oxygens."""
        return self.carbonyl(c) & (self.number(c, SINGLE, "N") == nitrogen) & (self.number(c, SINGLE, "O") == oxygen)

    @staticmethod
    def amine(n: Text) -> Text:
        return n["amine"]

    def amine_of(self, degree: int):
        return lambda n: self.amine(n) & (S.size(n["n"]) == degree) & (n["h"] == 3 - degree + n["q"])

    @staticmethod
    def aldehyde(c: Text) -> Text:
        return c["aldehyde"]

    def aldehyde_alpha(self, c: Text) -> Text:
        return self.atom(S.get(S.filter(c["n"], lambda n: n["z"] == "C"), S.lit(0)))

    def thiol(self, s: Text) -> Text:
        return (s["z"] == "S") & (s["h"] == 1) & (S.size(s["n"]) == 1) & (self.carbons(s) == 1)

    def ring_of(self, elements: dict[str, int], size: int) -> Text:
        """Aromatic rings of a size with so many of each element (the rest carbon)."""
        def fits(ring: Text) -> Text:
            members = S.transform(ring, lambda i: S.get(self.atoms, i))
            found = S.forall(members, lambda m: m["a"]) & (S.size(ring) == size)
            for element, n in (elements | {"C": size - sum(elements.values())}).items():
                found &= S.size(S.filter(members, _is(element))) == n
            return found

        return S.size(S.filter(self.rings, fits))


def _is(element: str):
    return lambda m: m["z"] == element


# Marks of atoms, in steps: each step looks at neighbours' marks of the steps before.
_FIELDS = ("z", "q", "h", "a", "r", "n")
_MARKS = (
    {
        "carbonyl": lambda g, a: (a["z"] == "C") & g.has(a, DOUBLE, "O"),
        "sp3": lambda g, a: ~a["a"] & S.forall(a["n"], lambda n: n["o"] == SINGLE),
        "carbons": lambda g, a: S.size(S.filter(a["n"], lambda n: n["z"] == "C")),
        "hydroxyl": lambda g, a: (a["z"] == "O") & (a["h"] == 1) & (a["q"] == 0) & (S.size(a["n"]) == 1),
    },
    {
        "near_carbonyl": lambda g, a: S.exists(a["n"], lambda n: g.carbonyl(g.atom(n))),
        "ether": lambda g, o: (o["z"] == "O") & (S.size(o["n"]) == 2) & (g.carbons(o) == 2) & ~o["a"] & ~S.exists(o["n"], lambda n: g.carbonyl(g.atom(n))),
        "ester": lambda g, c: g.carbonyl(c) & S.exists(c["n"], lambda n: g.alkoxy(n) & (S.size(S.filter(g.atom(n)["n"], lambda m: g.carbonyl(g.atom(m)))) == 1)),
        "amine": lambda g, n: (n["z"] == "N") & ~n["a"] & S.forall(n["n"], lambda m: m["o"] == SINGLE) & n["q"].isin(0, 1)
        & ~S.exists(n["n"], lambda m: ((m["z"] == "C") & (g.carbonyl(g.atom(m)) | g.has(g.atom(m), DOUBLE, "S"))) | ((m["z"] == "S") & (g.number(g.atom(m), DOUBLE, "O") >= 2))),
        "aldehyde": lambda g, c: g.carbonyl(c) & (c["h"] == 1) & (g.carbons(c) == 1),
    },
    {
        "site": lambda g, o: g.hydroxyl(o) & (g.host(o)["z"] == "C") & ~g.carbonyl(g.host(o)) & ~g.oxime(o),
        "enolic": lambda g, o: S.coalesce(g.has(g.host(o), DOUBLE, "C"), S.lit(False)),
        "alpha_hydroxy": lambda g, o: S.coalesce(g.sp3(g.host(o)) & g.near_carbonyl(g.host(o)), S.lit(False)),
    },
)


def marked(each: DataFrame) -> DataFrame:
    """each (_m) with _atoms, which have their marks as fields, and _rings; a projection for each step."""
    out, fields = each.withColumns({"_atoms": F.col("_m.atoms"), "_rings": F.col("_m.rings")}), [*_FIELDS]
    for marks in _MARKS:
        g = Groups(S.col("_atoms"), S.col("_rings"))
        step = lambda a: S.struct(*[a[f].alias(f) for f in fields], *[mark(g, a).alias(name) for name, mark in marks.items()])  # noqa: B023, E731
        out = out.withColumn("_atoms", F.expr(str(S.transform(S.col("_atoms"), step))))
        fields += [*marks]
    return out


def feature_columns(atoms: Text, rings: Text) -> dict[str, Text]:
    """Features of a molecule by name."""
    g = Groups(atoms, rings)
    site = g.alcohol_site
    degree = lambda low, high: lambda o: site(o) & ~g.enolic(o) & ~g.alpha_hydroxy(o) & ~g.host(o)["a"] & g.carbons(g.host(o)).between(low, high)
    tagged = lambda where: g.count(lambda o: site(o) & ~g.enolic(o) & where(g.host(o)))
    hemi = lambda hydrogens: g.count(lambda o: site(o) & ~g.enolic(o) & ~g.alpha_hydroxy(o) & g.sp3(g.host(o)) & S.exists(g.host(o)["n"], g.alkoxy) & (g.host(o)["h"] >= 1 if hydrogens else g.host(o)["h"] == 0))
    oxygens = lambda n, hydrogens: g.count(lambda c: (c["z"] == "C") & g.sp3(c) & (S.size(S.filter(c["n"], g.alkoxy)) == n) & (c["h"] >= 1 if hydrogens else c["h"] == 0))
    halogen = lambda c: S.exists(c["n"], lambda n: n["z"].isin(*HALOGENS))
    double_o = lambda n: lambda s: (s["z"] == "S") & (g.number(s, DOUBLE, "O") == n) & (g.carbons(s) >= 2)
    acid = lambda c: g.carbonyl(c) & S.exists(c["n"], lambda n: (n["z"] == "O") & (n["o"] == SINGLE) & (g.atom(n)["h"] == 1))
    imine = lambda n: (n["z"] == "N") & ~n["a"] & ~S.exists(n["n"], lambda m: m["z"] == "O") & ~S.exists(n["n"], lambda m: g.carbonyl(g.atom(m)))
    arom_alpha = lambda c: g.aldehyde_alpha(c)["a"]
    weight = S.create_map(*[S.lit(x) for pair in WEIGHTS.items() for x in pair])
    f: dict[str, Text] = {
        "PrimaryAlcoholCount": g.count(degree(0, 1)), "SecondaryAlcoholCount": g.count(degree(2, 2)), "TertiaryAlcoholCount": g.count(degree(3, 4)),
        "PhenolCount": g.count(lambda o: site(o) & g.host(o)["a"]), "EnolicOHCount": g.count(lambda o: site(o) & g.enolic(o)),
        "AlphaHydroxyCarbonylCount": g.count(lambda o: site(o) & ~g.enolic(o) & g.alpha_hydroxy(o)), "OximeCount": g.count(lambda o: g.hydroxyl(o) & g.oxime(o)),
        "AllylicAlcoholCount": tagged(lambda c: g.beside(c, DOUBLE)), "PropargylicAlcoholCount": tagged(lambda c: g.beside(c, TRIPLE)),
        "BenzylicAlcoholCount": tagged(lambda c: g.sp3(c) & S.exists(c["n"], lambda n: (n["z"] == "C") & g.atom(n)["a"])),
        "HemiacetalCount": hemi(True), "HemiketalCount": hemi(False), "AcetalCount": oxygens(2, True), "KetalCount": oxygens(2, False), "OrthoesterCount": g.count(lambda c: (c["z"] == "C") & g.sp3(c) & (S.size(S.filter(c["n"], g.alkoxy)) == 3)),
        "AldehydeCount": g.count(g.aldehyde), "ArylAldehydeCount": g.count(lambda c: g.aldehyde(c) & arom_alpha(c)),
        "CyclicAliphaticAldehydeCount": g.count(lambda c: g.aldehyde(c) & ~arom_alpha(c) & g.aldehyde_alpha(c)["r"]),
        "AlphaBetaUnsaturatedAldehydeCount": g.count(lambda c: g.aldehyde(c) & (arom_alpha(c) | g.has(g.aldehyde_alpha(c), DOUBLE, "C"))),
        "EtherCount_Total": g.count(g.ether), "EtherCount_Cyclic": g.count(lambda o: g.ether(o) & o["r"]), "EtherCount_Acyclic": g.count(lambda o: g.ether(o) & ~o["r"]),
        "EpoxideCount": S.size(S.filter(g.rings, lambda r: (S.size(r) == 3) & S.exists(r, lambda i: g.ether(S.get(g.atoms, i))))),
        "ArylOAlkylEtherCount": g.count(lambda o: (o["z"] == "O") & ~o["a"] & (S.size(o["n"]) == 2) & S.exists(o["n"], lambda n: g.atom(n)["a"]) & S.exists(o["n"], lambda n: (n["z"] == "C") & g.sp3(g.atom(n)))),
        "DiarylEtherCount": g.count(lambda o: (o["z"] == "O") & ~o["a"] & (S.size(o["n"]) == 2) & S.forall(o["n"], lambda n: (n["z"] == "C") & g.atom(n)["a"])),
        "KetoneCount": g.count(lambda c: g.carbonyl(c) & (g.carbons(c) == 2)), "EsterCount_Total": g.count(g.ester), "LactoneCount": g.count(g.lactone), "CarboxylicAcidCount": g.count(acid),
        "ThiolCount": g.count(g.thiol), "ThiophenolCount": g.count(lambda s: g.thiol(s) & g.host(s)["a"]), "AliphaticThiolCount": g.count(lambda s: g.thiol(s) & ~g.host(s)["a"]),
        "DisulfideCount": (g.pairs(lambda a, n: (a["z"] == "S") & (n["z"] == "S")) / 2).cast("int"),
        "ThioesterCount": g.count(lambda s: (s["z"] == "S") & (S.size(s["n"]) == 2) & S.exists(s["n"], lambda n: g.carbonyl(g.atom(n)))),
        "ThioetherCount": g.count(lambda s: (s["z"] == "S") & (S.size(s["n"]) == 2) & (g.carbons(s) == 2) & ~S.exists(s["n"], lambda n: g.carbonyl(g.atom(n)))),
        "SulfoxideCount": g.count(double_o(1)), "SulfoneCount": g.count(double_o(2)),
        "HalogenAtomCount_Total": g.count(lambda a: a["z"].isin(*HALOGENS)), "HalogenatedCarbonCount": g.count(lambda c: (c["z"] == "C") & halogen(c)),
        "HalogenatedPhenolCount": g.count(lambda o: (o["z"] == "O") & S.exists(o["n"], lambda n: (n["z"] == "C") & g.atom(n)["a"] & S.exists(g.rings, lambda r: S.array_contains(r, n["j"]) & S.forall(r, lambda i: S.get(g.atoms, i)["a"]) & S.exists(r, lambda i: halogen(S.get(g.atoms, i)))))),
        "AlkylPhenolCount": g.count(lambda o: (o["z"] == "O") & S.exists(o["n"], lambda n: (n["z"] == "C") & g.atom(n)["a"] & S.exists(g.rings, lambda r: S.array_contains(r, n["j"]) & S.exists(r, lambda i: S.get(g.atoms, i)["a"] & S.exists(S.get(g.atoms, i)["n"], lambda m: (m["z"] == "C") & ~g.atom(m)["a"]))))),
        "PyridineCount": g.ring_of({"N": 1}, 6), "FuranCount": g.ring_of({"O": 1}, 5), "ThiopheneCount": g.ring_of({"S": 1}, 5), "ThiazoleCount": g.ring_of({"S": 1, "N": 1}, 5),
        "NitroGroupCount": g.count(lambda n: (n["z"] == "N") & (n["q"] == 1) & g.has(n, DOUBLE, "O") & S.exists(n["n"], lambda m: (m["z"] == "O") & (m["o"] == SINGLE) & (g.atom(m)["q"] == -1))),
        "ImineCount": g.count(lambda n: imine(n) & S.exists(n["n"], lambda m: (m["z"] == "C") & (m["o"] == DOUBLE) & ~g.carbonyl(g.atom(m)))),
        "AmideCount_Total": g.count(lambda c: g.acyl_nitrogen(c, 1, 0)), "LactamCount": g.count(lambda c: g.acyl_nitrogen(c, 1, 0) & S.exists(c["n"], lambda n: (n["z"] == "N") & n["r"])),
        "UreaCount": g.count(lambda c: g.acyl_nitrogen(c, 2, 0)), "UrethaneCount": g.count(lambda c: g.acyl_nitrogen(c, 1, 1)),
        "IsocyanateCount": g.count(lambda c: g.carbonyl(c) & g.has(c, DOUBLE, "N")), "NitrileCount": g.count(lambda c: (c["z"] == "C") & g.has(c, TRIPLE, "N")),
        "AmineCount_Primary": g.count(g.amine_of(1)), "AmineCount_Secondary": g.count(g.amine_of(2)), "AmineCount_Tertiary": g.count(g.amine_of(3)),
        "NumAromaticAtoms": g.count(lambda a: a["a"]), "NumRingsTotal": S.size(g.rings), "NumAromaticRings": S.size(S.filter(g.rings, lambda r: S.forall(r, lambda i: S.get(g.atoms, i)["a"]))),
        "NumUnsaturatedBonds_All": (g.pairs(lambda a, n: n["o"] > SINGLE) / 2).cast("int"), "NumUnsaturatedBonds": (g.pairs(lambda a, n: (a["z"] == "C") & (n["z"] == "C") & (n["o"] > SINGLE)) / 2).cast("int"),
        "NumAlkeneBonds": (g.pairs(lambda a, n: (a["z"] == "C") & (n["z"] == "C") & (n["o"] == DOUBLE)) / 2).cast("int"), "NumAlkyneBonds": (g.pairs(lambda a, n: (a["z"] == "C") & (n["z"] == "C") & (n["o"] == TRIPLE)) / 2).cast("int"),
        "CarbonAtomCount": g.count(lambda a: a["z"] == "C"), "IsPureHydrocarbon": S.forall(g.atoms, lambda a: a["z"].isin("C", "H")).cast("int"),
        "TotalNitrogenAtomCount": g.count(lambda a: a["z"] == "N"), "TotalSulfurAtomCount": g.count(lambda a: a["z"] == "S"),
        "MacroMusks_Ketones": S.size(S.filter(g.rings, lambda r: (S.size(r) >= 12) & S.exists(r, lambda i: g.carbonyl(S.get(g.atoms, i)) & (g.carbons(S.get(g.atoms, i)) == 2)))),
        "MacroMusks_Lactones": S.size(S.filter(g.rings, lambda r: (S.size(r) >= 12) & S.exists(r, lambda i: g.lactone(S.get(g.atoms, i))))),
        "MolecularWeight": S.aggregate(S.transform(g.atoms, lambda a: S.coalesce(S.try_element_at(weight, a["z"]), S.lit(0.0)) + a["h"] * WEIGHTS["H"]), S.lit(0.0), lambda x, y: x + y),
        "FractionCSP3": S.coalesce(g.count(lambda a: (a["z"] == "C") & g.sp3(a)) / S.nullif(g.count(lambda a: a["z"] == "C"), S.lit(0)), S.lit(0.0)),
    }
    f |= _aldehyde_columns(g) | _ester_columns(g) | _thiophenol_columns(g) | _alcohol_columns(g) | _ring_columns(g)
    for x in HALOGENS:
        f[f"HalogenatedPhenolCount_{x}"] = g.count(_on_aromatic_ring(g, _beside(x)))
        f[f"HalogenAtomCount_{x}"] = g.count(_is(x))
        f[f"HalogenatedCarbonCount_{x}"] = g.count(_halogenated(x, None))
        f[f"HalogenatedArylCarbonCount_{x}"] = g.count(_halogenated(x, True))
        f[f"HalogenatedAlkylCarbonCount_{x}"] = g.count(_halogenated(x, False))
    return f


def _beside(element: str):
    return lambda c: S.exists(c["n"], _is(element))


def _on_aromatic_ring(g: Groups, where):
    """Oxygens on an aromatic ring of which some atom fulfils a condition."""
    ring_fits = lambda n: S.exists(g.rings, lambda r: S.array_contains(r, n["j"]) & S.forall(r, lambda i: S.get(g.atoms, i)["a"]) & S.exists(r, lambda i: where(S.get(g.atoms, i))))
    return lambda o: (o["z"] == "O") & S.exists(o["n"], lambda n: (n["z"] == "C") & g.atom(n)["a"] & ring_fits(n))


def _aldehyde_columns(g: Groups) -> dict[str, Text]:
    """Substitution beside the aldehyde carbon; beta positions of rings by their further substituents."""
    single = lambda a: S.filter(a["n"], lambda n: (n["o"] == SINGLE) & (n["z"] == "C"))
    alpha_branched = lambda c: S.size(single(g.aldehyde_alpha(c))) >= 3
    # a beta carbon has the alpha carbon and two more; the aldehyde's own carbon is a carbonyl and so left out
    beta = lambda c: S.exists(g.aldehyde_alpha(c)["n"], lambda n: (n["z"] == "C") & ~g.carbonyl(g.atom(n)) & (S.size(single(g.atom(n))) - S.when(n["o"] == SINGLE, 1).otherwise(0) >= 2))
    ring_beta = lambda c: S.least(S.size(S.filter(g.aldehyde_alpha(c)["n"], lambda n: g.atom(n)["r"] & (S.size(g.atom(n)["n"]) > 2))), S.lit(2))
    open_chain = lambda where: g.count(lambda c: g.aldehyde(c) & ~g.aldehyde_alpha(c)["r"] & where(c))
    cyclic = lambda low, high: g.count(lambda c: g.aldehyde(c) & g.aldehyde_alpha(c)["r"] & ~g.aldehyde_alpha(c)["a"] & ring_beta(c).between(low, high))

    def audit(c: Text, i: Text) -> Text:
        alpha = g.aldehyde_alpha(c)
        tags = S.array(
            S.concat(S.lit("ald@C"), i.cast("string")),
            S.when(~alpha["r"], S.when(alpha_branched(c), "alphaSub").when(beta(c), "betaSub").otherwise("noAlphaBetaSub")),
            S.when(alpha["r"] & ~alpha["a"], S.concat(S.lit("cyclicBetaSub="), ring_beta(c).cast("string"))),
            S.when(alpha["a"], "aryl").when(alpha["r"], "cyclic-aliph").otherwise("acyclic"),
            S.when(alpha["a"] | g.has(alpha, DOUBLE, "C"), "ab-unsat"),
        )
        return S.when(g.aldehyde(c), S.array_join(S.array_compact(tags), ":"))

    return {
        "AldehydeCount_AlphaSubstituted": open_chain(alpha_branched), "AldehydeCount_BetaSubstituted": open_chain(lambda c: ~alpha_branched(c) & beta(c)),
        "AldehydeCount_NoAlphaBetaSub": open_chain(lambda c: ~alpha_branched(c) & ~beta(c)), "CyclicAldehyde_BetaSubCount_0": cyclic(0, 0), "CyclicAldehyde_BetaSubCount_1": cyclic(1, 1),
        "CyclicAldehyde_BetaSubCount_2": cyclic(2, 2), "CyclicAldehyde_BetaSubstitutedCount": cyclic(1, 2), "CyclicAldehyde_NonBetaSubstitutedCount": cyclic(0, 0),
        "AldehydeAudit": S.array_join(S.transform(g.atoms, audit), "; "),
    }


def _ester_columns(g: Groups) -> dict[str, Text]:
    """Sides of malonates, acrylates, and acids with their anions."""
    acid = lambda c: g.carbonyl(c) & S.exists(c["n"], lambda n: (n["z"] == "O") & (n["o"] == SINGLE) & (g.atom(n)["h"] >= 1))
    ester = lambda c: g.carbonyl(c) & ~acid(c) & S.exists(c["n"], g.alkoxy)
    sides = lambda c, kind: S.size(S.filter(c["n"], lambda n: (n["z"] == "C") & (n["o"] == SINGLE) & kind(g.atom(n))))
    centre = lambda acids, esters: g.count(lambda c: (c["z"] == "C") & (sides(c, acid) == acids) & (sides(c, ester) == esters))
    # an ester whose carbonyl stands on a carbon with a double bond
    vinyl = lambda where: g.count(lambda c: g.carbonyl(c) & S.exists(c["n"], g.alkoxy) & S.exists(c["n"], lambda n: (n["z"] == "C") & where(g.atom(n))))
    hydrogens = lambda a, n: S.exists(a["n"], lambda m: (m["o"] == DOUBLE) & (m["z"] == "C") & (g.atom(m)["h"] == n))
    diester, half, both = centre(0, 2), centre(1, 1), centre(2, 0)
    return {
        "MalonateDiesterCount": diester, "MalonateHalfEsterCount": half, "MalonicAcidCount": both, "MalonateLikeCount": diester + half + both,
        "AcrylateEsterCount": vinyl(lambda a: (a["h"] == 1) & hydrogens(a, 2)), "MethacrylateEsterCount": vinyl(lambda a: g.has(a, DOUBLE, "C") & (g.number(a, SINGLE, "C") == 2)),
        "CarboxylicAcidCount_Fragment": g.count(lambda c: g.carbonyl(c) & (g.carbons(c) >= 1) & S.exists(c["n"], lambda n: (n["z"] == "O") & (n["o"] == SINGLE) & ((g.atom(n)["h"] == 1) | (g.atom(n)["q"] == -1)))),
    }


def _thiophenol_columns(g: Groups) -> dict[str, Text]:
    """Thiophenols by where their ring is substituted: ortho before meta before para."""
    def at(r: Text, c: Text, step: int) -> Text:
        """A substituent outside the ring, `step` places from the carbon, either way."""
        place = lambda d: S.get(r, S.pmod(S.array_position(r, c) - 1 + d, S.size(r)).cast("int"))
        outside = lambda i: S.exists(S.get(g.atoms, i)["n"], lambda n: ~S.array_contains(r, n["j"]))
        return outside(place(step)) | outside(place(-step))

    def found(s: Text, where) -> Text:
        c = S.get(s["n"], S.lit(0))["j"]
        ring = S.get(S.filter(g.rings, lambda r: S.array_contains(r, c)), S.lit(0))
        return (s["z"] == "S") & (s["h"] >= 1) & (S.size(s["n"]) == 1) & S.coalesce(g.host(s)["a"] & where(ring, c), S.lit(False))

    return {
        "Thiophenol_OrthoCount": g.count(lambda s: found(s, lambda r, c: at(r, c, 1))), "Thiophenol_MetaCount": g.count(lambda s: found(s, lambda r, c: ~at(r, c, 1) & at(r, c, 2))),
        "Thiophenol_ParaCount": g.count(lambda s: found(s, lambda r, c: ~at(r, c, 1) & ~at(r, c, 2) & (S.size(r) >= 6) & at(r, c, 3))),
    }


def _alcohol_columns(g: Groups) -> dict[str, Text]:
    """Diols, and what each hydroxyl is."""
    sites = S.filter(S.transform(g.atoms, lambda o: S.when(g.alcohol_site(o), S.get(o["n"], S.lit(0))["j"])), lambda j: j.isNotNull())
    near = lambda j: S.transform(S.get(g.atoms, j)["n"], lambda n: n["j"])
    bonded = lambda a, b: S.array_contains(near(a), b)
    through = lambda a, b: S.exists(S.get(g.atoms, a)["n"], lambda n: (n["z"] == "C") & S.array_contains(near(n["j"]), b))
    pairs = lambda where: S.aggregate(S.transform(sites, lambda a, i: S.size(S.filter(sites, lambda b, k: (k > i) & where(a, b)))), S.lit(0), lambda x, y: x + y)

    def label(o: Text, i: Text) -> Text:
        c, j = g.host(o), S.get(o["n"], S.lit(0))["j"].cast("string")
        place = S.concat(S.lit("@O"), i.cast("string"), S.lit("-C"), j)
        hemi = g.sp3(c) & S.exists(c["n"], g.alkoxy)
        carbons = g.carbons(c)
        kind = S.when(g.alpha_hydroxy(o), "alpha2carbonyl").when(c["a"], "phenol").when(carbons <= 1, "primary").when(carbons == 2, "secondary").otherwise("tertiary")
        nitrogen = S.get(S.filter(c["n"], lambda n: (n["z"] == "N") & (n["o"] == DOUBLE)), S.lit(0))["j"].cast("string")
        oxime = S.when(g.hydroxyl(o) & g.oxime(o) & (c["z"] == "C"), S.concat(S.lit("oxime@O"), i.cast("string"), S.lit("-N"), nitrogen, S.lit("-C"), j))
        enol = S.when(g.enolic(o), S.concat(S.lit("enol"), place))
        marked = S.when(hemi, S.concat(S.when(c["h"] >= 1, "hemiacetal").otherwise("hemiketal"), place))
        return S.when(g.alcohol_site(o), S.when(enol.isNotNull(), enol).otherwise(S.concat_ws("; ", marked, S.concat(kind, place)))).otherwise(oxime)

    return {"Vicinal12DiolCount": pairs(bonded), "OneThreeDiolCount": pairs(lambda a, b: ~bonded(a, b) & through(a, b)), "AlcoholAudit": S.array_join(S.transform(g.atoms, label), "; ")}


def _ring_columns(g: Groups) -> dict[str, Text]:
    """Fused rings, isoprene-like units, and kinds of ethers."""
    aromatic = lambda r: S.forall(r, lambda i: S.get(g.atoms, i)["a"])
    nitrogens = lambda r: S.size(S.filter(r, lambda i: S.get(g.atoms, i)["z"] == "N"))
    carbons_only = lambda r: S.forall(r, lambda i: S.get(g.atoms, i)["z"] == "C")
    indole = lambda r: (S.size(r) == 5) & aromatic(r) & (nitrogens(r) == 1) & S.exists(g.rings, lambda q: (S.size(q) == 6) & aromatic(q) & carbons_only(q) & (S.size(S.array_intersect(r, q)) == 2))
    # of C=C(C)C: for each end of a double bond, pairs of its other carbons
    others = lambda a: g.number(a, SINGLE, "C") - S.size(S.filter(a["n"], lambda n: (n["o"] == SINGLE) & (n["z"] == "C") & g.atom(n)["a"]))
    units = lambda a: S.when((a["z"] == "C") & ~a["a"], g.number(a, DOUBLE, "C") * others(a) * (others(a) - 1) / 2).otherwise(0)
    two = lambda o: (o["z"] == "O") & ~o["a"] & (S.size(o["n"]) == 2)
    free = lambda n: (n["z"] == "C") & g.sp3(g.atom(n)) & ~g.atom(n)["r"]
    aryl = lambda n: (n["z"] == "C") & g.atom(n)["a"]
    pure = S.forall(g.atoms, lambda a: a["z"].isin("C", "H"))
    some_aromatic = S.exists(g.atoms, lambda a: a["a"])
    terpene = S.aggregate(S.transform(g.atoms, units), S.lit(0.0), lambda x, y: x + y).cast("int")
    ring_count = S.size(g.rings)
    return {
        "IndoleCount": S.size(S.filter(g.rings, indole)), "TerpeneLikeUnitCount": terpene, "IsTerpeneHydrocarbon": (pure & (terpene >= 1)).cast("int"),
        "NumAliphaticRings": S.size(S.filter(g.rings, lambda r: ~aromatic(r))), "HydrocarbonRingCount": S.when(pure, ring_count).otherwise(0),
        "IsHydrocarbonAromatic": (pure & some_aromatic).cast("int"), "IsHydrocarbonAliphatic": (pure & ~some_aromatic).cast("int"),
        "EtherAliphaticCount": g.count(lambda o: two(o) & ~o["r"] & S.forall(o["n"], free)), "EtherAromaticCount": g.count(lambda o: two(o) & S.forall(o["n"], aryl)),
        "EtherMixedCount": g.count(lambda o: two(o) & S.exists(o["n"], aryl) & S.exists(o["n"], free)), "EtherRingCount": g.count(lambda o: two(o) & o["r"]),
    }


def _halogenated(element: str, aromatic: bool | None):
    def where(c: Text) -> Text:
        held = (c["z"] == "C") & S.exists(c["n"], _is(element))
        return held if aromatic is None else held & (c["a"] == aromatic)

    return where


# What the totals and the two tiers of strong odorants add up.
TOTALS = {
    "TotalAlcoholCount": ("PrimaryAlcoholCount", "SecondaryAlcoholCount", "TertiaryAlcoholCount", "PhenolCount", "AlphaHydroxyCarbonylCount", "EnolicOHCount"),
    "EtherCount": ("EtherCount_Total",),
    "NitrileFragmentCount": ("NitrileCount",),
    "AmineCount_Total": ("AmineCount_Primary", "AmineCount_Secondary", "AmineCount_Tertiary"),
    "MacroMusks_Total": ("MacroMusks_Ketones", "MacroMusks_Lactones"),
    "TotalSulfurGroupCount": ("ThiolCount", "ThiophenolCount", "AliphaticThiolCount", "DisulfideCount", "ThioesterCount", "ThioetherCount", "SulfoxideCount", "SulfoneCount"),
    "TotalNitrogenGroupCount": ("AmineCount_Total", "NitrileCount", "NitroGroupCount", "PyridineCount", "ThiazoleCount"),
    "HighImpactTier1Count": ("ThiophenolCount", "AliphaticThiolCount", "DisulfideCount", "SulfoxideCount", "SulfoneCount", "HalogenatedPhenolCount", "HalogenatedCarbonCount", "NitroGroupCount", "AlphaBetaUnsaturatedAldehydeCount"),
    "HighImpactTier2Count": ("EnolicOHCount", "ThioetherCount", "MalonateLikeCount", "AldehydeCount_AlphaSubstituted", "AldehydeCount_BetaSubstituted", "PhenolCount", "Thiophenol_OrthoCount", "Thiophenol_MetaCount", "Thiophenol_ParaCount", "NitrileCount"),
}


# Version of the features, and their names.
SCHEMA_VERSION = 1
FEATURES = (
    "Valid PrimaryAlcoholCount SecondaryAlcoholCount TertiaryAlcoholCount PhenolCount EnolicOHCount AlphaHydroxyCarbonylCount OximeCount "
    "AllylicAlcoholCount PropargylicAlcoholCount BenzylicAlcoholCount HemiacetalCount HemiketalCount AcetalCount KetalCount OrthoesterCount "
    "AldehydeCount ArylAldehydeCount CyclicAliphaticAldehydeCount AlphaBetaUnsaturatedAldehydeCount EtherCount_Total EtherCount_Cyclic "
    "EtherCount_Acyclic EpoxideCount ArylOAlkylEtherCount DiarylEtherCount KetoneCount EsterCount_Total LactoneCount CarboxylicAcidCount ThiolCount "
    "ThiophenolCount AliphaticThiolCount DisulfideCount ThioesterCount ThioetherCount SulfoxideCount SulfoneCount HalogenAtomCount_Total "
    "HalogenatedCarbonCount HalogenatedPhenolCount AlkylPhenolCount PyridineCount FuranCount ThiopheneCount ThiazoleCount NitroGroupCount ImineCount "
    "AmideCount_Total LactamCount UreaCount UrethaneCount IsocyanateCount NitrileCount AmineCount_Primary AmineCount_Secondary AmineCount_Tertiary "
    "NumAromaticAtoms NumRingsTotal NumAromaticRings NumUnsaturatedBonds_All NumUnsaturatedBonds NumAlkeneBonds NumAlkyneBonds CarbonAtomCount "
    "IsPureHydrocarbon TotalNitrogenAtomCount TotalSulfurAtomCount MacroMusks_Ketones MacroMusks_Lactones MolecularWeight FractionCSP3 "
    "AldehydeCount_AlphaSubstituted AldehydeCount_BetaSubstituted AldehydeCount_NoAlphaBetaSub CyclicAldehyde_BetaSubCount_0 "
    "CyclicAldehyde_BetaSubCount_1 CyclicAldehyde_BetaSubCount_2 CyclicAldehyde_BetaSubstitutedCount CyclicAldehyde_NonBetaSubstitutedCount "
    "AldehydeAudit MalonateDiesterCount MalonateHalfEsterCount MalonicAcidCount MalonateLikeCount AcrylateEsterCount MethacrylateEsterCount "
    "CarboxylicAcidCount_Fragment Thiophenol_OrthoCount Thiophenol_MetaCount Thiophenol_ParaCount Vicinal12DiolCount OneThreeDiolCount AlcoholAudit "
    "IndoleCount TerpeneLikeUnitCount IsTerpeneHydrocarbon NumAliphaticRings HydrocarbonRingCount IsHydrocarbonAromatic IsHydrocarbonAliphatic "
    "EtherAliphaticCount EtherAromaticCount EtherMixedCount EtherRingCount HalogenatedPhenolCount_F HalogenAtomCount_F HalogenatedCarbonCount_F "
    "HalogenatedArylCarbonCount_F HalogenatedAlkylCarbonCount_F HalogenatedPhenolCount_Cl HalogenAtomCount_Cl HalogenatedCarbonCount_Cl "
    "HalogenatedArylCarbonCount_Cl HalogenatedAlkylCarbonCount_Cl HalogenatedPhenolCount_Br HalogenAtomCount_Br HalogenatedCarbonCount_Br "
    "HalogenatedArylCarbonCount_Br HalogenatedAlkylCarbonCount_Br HalogenatedPhenolCount_I HalogenAtomCount_I HalogenatedCarbonCount_I "
    "HalogenatedArylCarbonCount_I HalogenatedAlkylCarbonCount_I EsterCount_Open TotalAlcoholCount EtherCount NitrileFragmentCount AmineCount_Total "
    "MacroMusks_Total TotalSulfurGroupCount HighImpactTier1Count HighImpactTier2Count TotalNitrogenGroupCount IsPolyol IsFullySaturated "
    "HighImpactSummary"
).split()


def annotate(rows: DataFrame, smiles: str = "smiles") -> DataFrame:
    """rows with the features of their molecules; a SMILES that is none gives Valid 0 and zeros.

    Each distinct SMILES is read once; counting stays on the JVM. Columns of rows with a feature's name are replaced.
    """
    each = rows.select(F.col(smiles).alias("_s")).where("_s IS NOT NULL").distinct().withColumn("_m", molecule(F.col("_s")))
    features = feature_columns(S.col("_atoms"), S.col("_rings"))
    counted = marked(each).selectExpr("_s", "CAST(_m IS NOT NULL AS INT) AS Valid", *[f"{S.coalesce(c, '' if n.endswith('Audit') else 0)} AS {n}" for n, c in features.items()])
    # totals of totals come in their own step
    totals = {name: " + ".join(parts) for name, parts in TOTALS.items()} | {"EsterCount_Open": "EsterCount_Total - LactoneCount"}
    later = {n for n, parts in TOTALS.items() if any(p in TOTALS for p in parts)}
    counted = counted.selectExpr("*", *[f"{c} AS {n}" for n, c in totals.items() if n not in later])
    flags = {
        "IsPolyol": "CAST(TotalAlcoholCount >= 2 AS INT)",
        "IsFullySaturated": "CAST(NumUnsaturatedBonds = 0 AND Valid = 1 AS INT)",
        "HighImpactSummary": "format_string('T1:%d; T2:%d', HighImpactTier1Count, HighImpactTier2Count)",
    }
    counted = counted.selectExpr("*", *[f"{totals[n]} AS {n}" for n in later], *[f"{c} AS {n}" for n, c in flags.items()])
    kept = [c for c in rows.columns if c not in FEATURES]
    joined = rows.select(*kept).join(counted, F.col(smiles) == F.col("_s"), "left")
    empty = lambda n: "'T1:0; T2:0'" if n == "HighImpactSummary" else "''" if n.endswith("Audit") else "0"
    return joined.select(*kept, *[F.expr(f"coalesce({n}, {empty(n)}) AS {n}") for n in FEATURES])


def annotate_cleaned(rows: DataFrame, raw: str = "smiles") -> DataFrame:
    return annotate(rows.withColumn(raw, clean_smiles(F.col(raw))), raw)


def rejected(rows: DataFrame, smiles: str = "smiles") -> DataFrame:
    """rows without a molecule, and why: empty (null, blank, or what stands for nothing) or invalid."""
    each = rows.withColumn("_clean", clean_smiles(F.trim(F.coalesce(F.col(smiles), F.lit("")))))
    reason = F.when(F.col("_clean") == "", "empty").when(molecule(F.col("_clean")).isNull(), "invalid")
    return each.withColumn("reason", reason).where("reason IS NOT NULL").drop("_clean")
