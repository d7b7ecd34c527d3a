"""Substructure patterns as SQL: a pattern text becomes an expression over a molecule's atoms (see functions.smiles).

The reader knows a bracket's elements (C, c, #6), *, A, a, H, X, D, v, R and charges, recursive $(...), the bonds - = # : ~ @
(none: single or aromatic), both with !, &, comma and semicolon, branches and ring closures.  What it makes is a chain of array
functions: the places of the first atom, then for each further atom the neighbours of one before it that fit.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numbers of elements as patterns write them, and what a bond mark allows.
ELEMENTS = {1: "H", 5: "B", 6: "C", 7: "N", 8: "O", 9: "F", 14: "Si", 15: "P", 16: "S", 17: "Cl", 34: "Se", 35: "Br", 53: "I"}
BONDS = {"": "{x}.o IN (1, 4)", "-": "{x}.o = 1", "=": "{x}.o = 2", "#": "{x}.o = 3", ":": "{x}.o = 4", "~": "true", "@": "{x}.r"}

_PLAIN = re.compile(r"Br|Cl|[BCNOPSFIAbcnopsa*]")
_BOND = re.compile(r"[-=#:~@!,;&]+")
_PRIMITIVE = re.compile(r"#(\d+)|([HXDRv])(\d*)|([+-])(\d*)|(Br|Cl|Si|Se|Na|[BCNOFPSIKbcnops])|([Aa*])")


@dataclass
class Pattern:
    """Atoms as their conditions' texts; bonds: of each atom but the first the one it hangs on; closures: other bonds."""

    atoms: list[str] = field(default_factory=list)
    bonds: list[tuple[int, str]] = field(default_factory=list)
    closures: dict[int, list[tuple[int, str]]] = field(default_factory=dict)


def _closing(text: str, at: int, pair: str) -> int:
    """The place of the bracket that closes the one at `at`."""
    depth = 0
    for k in range(at, len(text)):
        depth += (text[k] == pair[0]) - (text[k] == pair[1])
        if not depth:
            return k
    raise ValueError(f"no end of {text[at:]!r}")


def read(text: str) -> Pattern:
    out, stack, rings = Pattern(), [], {}
    last, bond, at = None, "", 0
    while at < len(text):
        c = text[at]
        if c == "(":
            stack.append(last)
        elif c == ")":
            last = stack.pop()
        elif m := _BOND.match(text, at):
            bond, at = m[0], m.end() - 1
        elif c.isdigit():
            if c in rings:
                other, mark = rings.pop(c)
                out.closures.setdefault(last, []).append((other, bond or mark))
            else:
                rings[c] = last, bond
            bond = ""
        else:
            if c == "[":
                end = _closing(text, at, "[]")
                condition = text[at + 1 : end]
                at = end
            elif m := _PLAIN.match(text, at):
                condition, at = m[0], m.end() - 1
            else:
                raise ValueError(f"not a pattern: {text!r}")
            out.atoms.append(condition)
            if last is not None:
                out.bonds.append((last, bond))
            last, bond = len(out.atoms) - 1, ""
        at += 1
    if stack or rings or not out.atoms:
        raise ValueError(f"not a whole pattern: {text!r}")
    return out


def bond_sql(mark: str, x: str) -> str:
    """Whether the bond of neighbour `x` fulfils a bond's marks."""
    for sign, word in ((";", " AND "), (",", " OR "), ("&", " AND ")):
        if sign in mark:
            return "(" + word.join(bond_sql(part, x) for part in mark.split(sign)) + ")"
    if not mark:
        return BONDS[""].format(x=x)
    said = [BONDS[c].format(x=x) if not negative else f"NOT ({BONDS[c].format(x=x)})" for negative, c in re.findall(r"(!?)([-=#:~@])", mark)]
    return "(" + " AND ".join(said) + ")"


class Sql:
    """SQL of patterns; each lambda's variables have names of their own."""

    def __init__(self, atoms: str):
        self.atoms, self.numbers = atoms, count()

    def _name(self) -> str:
        return f"v{next(self.numbers)}"

    def atom(self, condition: str, a: str, i: str) -> str:
        """Whether atom `a`, at place `i`, fulfils a bracket's condition."""
        for mark, word in ((";", " AND "), (",", " OR ")):
            if len(parts := self._split(condition, mark)) > 1:
                return "(" + word.join(self.atom(p, a, i) for p in parts) + ")"
        said, at = [], 0
        while at < len(condition):
            if condition[at] == "&":
                at += 1
                continue
            negative = condition[at] == "!"
            at += negative
            if condition.startswith("$(", at):
                end = _closing(condition, at + 1, "()")
                text, at = self.rooted(read(condition[at + 2 : end]), i), end + 1
            else:
                m = _PRIMITIVE.match(condition, at)
                if not m:
                    raise ValueError(f"not a condition: {condition!r}")
                text, at = self._primitive(m, a), m.end()
            said.append(f"NOT ({text})" if negative else f"({text})")
        return "(" + " AND ".join(said) + ")"

    @staticmethod
    def _split(text: str, mark: str) -> list[str]:
        parts, depth, start = [], 0, 0
        for k, c in enumerate(text):
            depth += (c == "(") - (c == ")")
            if c == mark and not depth:
                parts.append(text[start:k])
                start = k + 1
        return [*parts, text[start:]]

    @staticmethod
    def _primitive(m: re.Match, a: str) -> str:
        number, letter, amount, sign, charge, element, kind = m.groups()
        if number:
            return f"{a}.z = '{ELEMENTS[int(number)]}'" if number != "0" else "false"
        if letter:
            n = amount or "1"
            valence = f"{a}.h + aggregate({a}.n, 0D, (s, b) -> s + IF(b.o = 4, 1.5D, CAST(b.o AS DOUBLE))) = {n}"
            return {"v": valence, "H": f"{a}.h = {n}", "X": f"size({a}.n) + {a}.h = {n}", "D": f"size({a}.n) = {n}", "R": f"{a}.r" if amount != "0" else f"NOT {a}.r"}[letter]
        if sign:
            return f"{a}.q = {sign}{charge or 1}"
        if element:
            return f"{a}.z = '{element.capitalize()}' AND {'' if element[0].islower() else 'NOT '}{a}.a"
        return {"A": f"NOT {a}.a", "a": f"{a}.a", "*": "true"}[kind]

    def _grown(self, pattern: Pattern, matches: str, k: int) -> str:
        """Matches of the first k atoms, each with every neighbour that can be atom k."""
        parent, mark = pattern.bonds[k - 1]
        m, x, y = self._name(), self._name(), self._name()
        near, there = f"get({self.atoms}, get({m}, {parent})).n", f"get({self.atoms}, {x}.j)"
        said = [bond_sql(mark, x), f"NOT array_contains({m}, {x}.j)", self.atom(pattern.atoms[k], there, f"{x}.j")]
        for other, closing in pattern.closures.get(k, ()):
            said.append(f"exists({there}.n, {y} -> {y}.j = get({m}, {other}) AND {bond_sql(closing, y)})")
        return f"flatten(transform({matches}, {m} -> transform(filter({near}, {x} -> {' AND '.join(said)}), {x} -> array_append({m}, {x}.j))))"

    def matches(self, pattern: Pattern) -> str:
        """array<array<int>>: every way to lay the pattern on the atoms."""
        a, i = self._name(), self._name()
        # places of the atoms that can be the first one
        found = f"filter(transform({self.atoms}, ({a}, {i}) -> CASE WHEN {self.atom(pattern.atoms[0], a, i)} THEN array({i}) END), {i} -> {i} IS NOT NULL)"
        for k in range(1, len(pattern.atoms)):
            found = self._grown(pattern, found, k)
        return found

    def rooted(self, pattern: Pattern, i: str) -> str:
        """Whether the pattern can be laid on the atoms with its first one at place i."""
        first = self.atom(pattern.atoms[0], f"get({self.atoms}, {i})", i)
        if len(pattern.atoms) == 1:
            return first
        if len(pattern.atoms) == 2 and not pattern.closures:
            x = self._name()
            return f"{first} AND exists(get({self.atoms}, {i}).n, {x} -> {bond_sql(pattern.bonds[0][1], x)} AND {self.atom(pattern.atoms[1], f'get({self.atoms}, {x}.j)', f'{x}.j')})"
        found = f"array(array({i}))"
        for k in range(1, len(pattern.atoms)):
            found = self._grown(pattern, found, k)
        return f"CASE WHEN {first} THEN size({found}) > 0 ELSE false END"


def pattern_count(pattern: str, molecule: str = "molecule") -> Column:
    """How many different sets of atoms the pattern can be laid on; null for no molecule."""
    sql, shape = Sql(f"{molecule}.atoms"), read(pattern)
    found = sql.matches(shape)
    if len(shape.atoms) > 1:
        found = f"array_distinct(transform({found}, m -> array_sort(m)))"
    return F.expr(f"CASE WHEN {molecule} IS NOT NULL THEN size({found}) END")


def first_of(patterns: list[tuple[str, str]], atom: str = "a", place: str = "i", molecule: str = "molecule") -> str:
    """SQL: the value of the first pattern (pattern, SQL value) whose first atom can be this atom, else null."""
    sql = Sql(f"{molecule}.atoms")
    return "CASE " + " ".join(f"WHEN {sql.rooted(read(p), place)} THEN {value}" for p, value in patterns) + " END"
