"""InChI texts to the same molecules as SMILES give: formula, bonds, hydrogens and charge; stereo and isotopes are passed over.

The text names no bond orders: they are what the atoms' valences leave open, found by giving the atom with the fewest
choices its bond first.  Mobile hydrogens go where that succeeds.
"""

from __future__ import annotations

import re
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from chemlake.functions.smiles import ARROW_MOLECULE, MOLECULE, assembled

# Valences of neutral atoms in the order in which they are tried; atoms of other elements take the bonds that they have.
VALENCES = {"H": (1,), "B": (3,), "C": (4,), "N": (3, 5), "O": (2,), "F": (1,), "Si": (4,), "P": (3, 5), "S": (2, 4, 6), "Cl": (1, 3, 5, 7), "Br": (1, 3, 5), "I": (1, 3, 5, 7), "Se": (2, 4, 6)}
#: Elements on which a positive or a negative charge is looked for, likely ones first, and the bonds that it adds.
POSITIVE, NEGATIVE = {"N": 1, "P": 1, "S": 1, "O": 1, "C": -1}, {"O": -1, "S": -1, "N": -1, "C": -1, "F": -1, "Cl": -1, "Br": -1, "I": -1, "B": 1}


def _parts(layer: str, n: int) -> list[str]:
    """A layer's text for each of n components; 2*x stands for x twice."""
    out: list[str] = []
    for part in layer.split(";"):
        m = re.match(r"(\d+)\*(.*)", part)
        out += [m[2]] * int(m[1]) if m else [part]
    return (out + [""] * n)[:n]


def _formula(text: str) -> tuple[list[str], int]:
    """(heavy atoms in order, hydrogens); hydrogen alone is its own atom."""
    atoms, hydrogens = [], 0
    for element, number in re.findall(r"([A-Z][a-z]?)(\d*)", text):
        if element == "H":
            hydrogens = int(number or 1)
        else:
            atoms += [element] * int(number or 1)
    return atoms, hydrogens


def _bonds(text: str) -> set[tuple[int, int]]:
    bonds, stack, last = set(), [], None
    for token in re.findall(r"\d+|[-(),]", text):
        if token == "(":
            stack.append(last)
        elif token == ",":
            last = stack[-1]
        elif token == ")":
            last = stack.pop()
        elif token != "-":
            here = int(token) - 1
            if last is not None:
                bonds.add((min(here, last), max(here, last)))
            last = here
    return bonds


def _places(text: str) -> list[int]:
    """1-3,5 as 0, 1, 2, 4."""
    out = []
    for part in filter(None, text.split(",")):
        begin, _, end = part.partition("-")
        out += range(int(begin) - 1, int(end or begin))
    return out


def _hydrogens(text: str, n: int) -> tuple[list[int], list[tuple[int, list[int]]]]:
    """(hydrogens of each atom, mobile ones as (number, atoms that share them))."""
    fixed, mobile = [0] * n, []
    for number, places in re.findall(r"\(H(\d*)-?,([\d,-]+)\)", text):
        mobile.append((int(number or 1), _places(places)))
    for places, number in re.findall(r"([\d,-]+)H(\d*)", re.sub(r"\(.*?\)", "", text)):
        for i in _places(places.strip(",")):
            fixed[i] = int(number or 1)
    return fixed, mobile


def _spread(mobile: list[tuple[int, list[int]]], room: list[int], at: int = 0):
    """Every way to give the mobile hydrogens to their atoms, within what these have room for, first ones first."""
    if at == len(mobile):
        yield {}
        return
    number, places = mobile[at]
    for some in _shared(number, places, room):
        for rest in _spread(mobile, room, at + 1):
            yield {**rest, **some}


def _shared(number: int, places: list[int], room: list[int]):
    if not places:
        if not number:
            yield {}
        return
    for n in range(min(number, room[places[0]]), -1, -1):
        for rest in _shared(number - n, places[1:], room):
            yield {places[0]: n, **rest} if n else rest


def _orders(n: int, bonds: set[tuple[int, int]], open_bonds: list[int]) -> dict[tuple[int, int], int] | None:
    """Orders of the bonds that use up exactly what each atom has open beyond single bonds; None if there are none."""
    near: list[list[int]] = [[] for _ in range(n)]
    for i, j in bonds:
        near[i].append(j)
        near[j].append(i)
    order, left = dict.fromkeys(bonds, 1), list(open_bonds)
    if min(left, default=0) < 0 or sum(left) % 2:
        return None
    trail: list[tuple[tuple[int, int], list]] = []
    while True:
        choices = {i: [j for j in near[i] if left[j] and order[min(i, j), max(i, j)] < 3] for i in range(n) if left[i]}
        if not choices:
            return order
        i = min(choices, key=lambda k: (len(choices[k]), k))
        following = iter([(min(i, j), max(i, j)) for j in choices[i]])
        # the next choice here, or else of the ones before
        while (pair := next(following, None)) is None:
            if not trail:
                return None
            undone, following = trail.pop()
            order[undone] -= 1
            left[undone[0]] += 1
            left[undone[1]] += 1
        trail.append((pair, following))
        order[pair] += 1
        left[pair[0]] -= 1
        left[pair[1]] -= 1


def _raised(elements: list[str], used: list[int]):
    """The atoms' valences: the least that hold what is bonded, then more and more of the higher ones."""
    options = [[v for v in VALENCES.get(z, (used[i],)) if v >= used[i]] for i, z in enumerate(elements)]
    if not all(options):
        return
    least = [o[0] for o in options]
    yield least
    several = [(i, v) for i, o in enumerate(options) for v in o[1:]]
    for size in range(1, len(several) + 1):
        for some in combinations(several, size):
            if len({i for i, _ in some}) == size:
                out = list(least)
                for i, v in some:
                    out[i] = v
                yield out


def _component(formula: str, connected: str, hydrogens: str, charge: int, protons: int):
    """(atoms, bonds) of one component; None if its layers disagree or no bond orders fit."""
    elements, total = _formula(formula)
    if not elements:
        return ([["H", charge + protons, 0, False] for _ in range(max(1, total))], {(0, 1): 1} if total == 2 else {}) if total in (1, 2) else None
    n, bonds = len(elements), _bonds(connected)
    fixed, mobile = _hydrogens(hydrogens, n)
    if not hydrogens and n == 1:
        fixed[0] = total
    if sum(fixed) + sum(k for k, _ in mobile) != total:
        return None
    degree = [sum(i in b for b in bonds) for i in range(n)]
    # nitrogens take hydrogens before other elements do
    mobile = [(k, sorted(places, key=lambda i: (elements[i] != "N", i))) for k, places in mobile]
    for given in _spread(mobile, [max(0, VALENCES.get(z, (0,))[0] - degree[i]) for i, z in enumerate(elements)]):
        count = [fixed[i] + given.get(i, 0) for i in range(n)]
        for charged in _charges(elements, count, degree, charge, protons):
            h, q = charged
            used = [degree[i] + h[i] for i in range(n)]
            shift = [(POSITIVE.get(z, 0) if q[i] > 0 else NEGATIVE.get(z, 0) if q[i] < 0 else 0) * abs(q[i]) for i, z in enumerate(elements)]
            for valences in _raised(elements, [max(0, u - s) for u, s in zip(used, shift, strict=True)]):
                order = _orders(n, bonds, [v + s - u for v, s, u in zip(valences, shift, used, strict=True)])
                if order is not None:
                    return _parted([[z, q[i], h[i], False] for i, z in enumerate(elements)], order)
    return None


def _charges(elements, count, degree, charge: int, protons: int):
    """(hydrogens, charges): protons that were taken or given, then what charge is left, on one atom each."""
    n = len(elements)
    base = (list(count), [0] * n)
    states = [base]
    for _ in range(abs(protons)):
        if protons > 0:
            states = [([h + (k == i) for k, h in enumerate(hs)], [q + (k == i) for k, q in enumerate(qs)]) for hs, qs in states for i in range(n) if elements[i] in ("N", "O", "S", "P") and not qs[i]]
        else:
            order = sorted((i for i in range(n) if elements[i] in NEGATIVE), key=lambda i: (list(NEGATIVE).index(elements[i]), i))
            states = [([h - (k == i) for k, h in enumerate(hs)], [q - (k == i) for k, q in enumerate(qs)]) for hs, qs in states for i in order if hs[i] and not qs[i]]
    for _ in range(abs(charge)):
        sign = 1 if charge > 0 else -1
        ranked = list(POSITIVE if sign > 0 else NEGATIVE)
        likely = sorted((i for i in range(n) if elements[i] in ranked or elements[i] not in VALENCES), key=lambda i: (ranked.index(elements[i]) if elements[i] in ranked else -1, i)) or list(range(n))
        states = [(hs, [q + sign * (k == i) for k, q in enumerate(qs)]) for hs, qs in states for i in likely if n == 1 or not qs[i]]
    yield from states


def _parted(atoms: list[list], order: dict[tuple[int, int], int]):
    """Nitrogens of five bonds as pairs of charges, as SMILES write them."""
    for i, atom in enumerate(atoms):
        mine = [p for p in order if i in p]
        if atom[0] == "N" and atom[1] == 0 and sum(order[p] for p in mine) + atom[2] == 5:
            other = lambda p: p[0] + p[1] - i  # noqa: B023, E731
            outer = [p for p in mine if order[p] > 1 and atoms[other(p)][0] in ("O", "S", "N", "C") and atoms[other(p)][1] == 0]
            if outer:
                p = min(outer, key=lambda p: (("O", "S", "N", "C").index(atoms[other(p)][0]), sum(other(p) in b for b in order), -other(p)))
                order[p] -= 1
                atom[1] += 1
                atoms[other(p)][1] -= 1
    return atoms, order


def read_inchi(text: str | None):
    """(atoms, bonds) of an InChI; None if it is not one."""
    m = re.match(r"InChI=1S?/([^/]+)((?:/.*)?)$", text or "")
    if not m:
        return None
    layers: dict[str, str] = {}
    for layer in filter(None, m[2].split("/")):
        if layer[0] in "fr":  # layers of fixed hydrogens and reconnected metals say it all again
            break
        layers.setdefault(layer[0], layer[1:])
    formulas: list[str] = []
    for part in m[1].split("."):
        several = re.match(r"(\d+)(?=[A-Z])", part)
        formulas += [part[several.end() :]] * int(several[1]) if several else [part]
    n = len(formulas)
    connected, hydrogens, charges = (_parts(layers.get(k, ""), n) for k in "chq")
    protons = int(layers.get("p") or 0)
    atoms, bonds = [], {}
    for k, formula in enumerate(formulas):
        tried = [protons, 0] if protons else [0]
        found = None
        for given in tried:
            found = found or _component(formula, connected[k], hydrogens[k], int(charges[k] or 0), given)
            if found and given:
                protons = 0
        if not found:
            return None
        start = len(atoms)
        atoms += found[0]
        bonds |= {(i + start, j + start): o for (i, j), o in found[1].items()}
    return None if protons else (atoms, bonds)


def molecule_of_inchi(inchi: Column) -> Column:
    """The molecule of an InChI; null if it is not one."""

    @F.arrow_udf(MOLECULE)
    def parse(texts: pa.Array) -> pa.Array:
        return pa.array([assembled(read_inchi(t.as_py())) for t in texts], ARROW_MOLECULE)

    return parse(inchi)
