"""One SMILES for each molecule, whatever the spelling or numbering it came with.

Atoms are ranked by what they are, then again and again by the ranks around them.  Ties that are left in rings are
broken by trying each atom of the first tied class and keeping the smallest numbering; an atom that gives the same
numbering as one before it is its image and is not followed.  Other ties lie in branches, where any choice gives the same
text.  Stereo and isotopes are not part of a molecule here, so they are not written.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from chemlake.functions.smiles import VALENCES

_MARKS = {1: "", 2: "=", 3: "#", 4: ""}


def _dense(keys: list) -> list[int]:
    """Each key as the number of smaller ones."""
    ordered, rank = sorted(keys), {}
    for k, key in enumerate(ordered):
        rank.setdefault(key, k)
    return [rank[k] for k in keys]


def _refined(ranks: list[int], near: list[list[tuple[int, int]]]) -> list[int]:
    while True:
        following = _dense([(r, tuple(sorted((ranks[j], o) for j, o in near[i]))) for i, r in enumerate(ranks)])
        if following == ranks:
            return ranks
        ranks = following


def _tied(ranks: list[int], atoms: list[int]) -> list[int]:
    """The atoms of the first class of which several are among `atoms`."""
    classes: dict[int, list[int]] = {}
    for i in atoms:
        classes.setdefault(ranks[i], []).append(i)
    return next((classes[r] for r in sorted(classes) if len(classes[r]) > 1), [])


def _single_out(ranks: list[int], i: int, near) -> list[int]:
    return _refined(_dense([(r, k != i) for k, r in enumerate(ranks)]), near)


def _numbering(ranks: list[int], near) -> list:
    """The molecule under a numbering: what each place is bonded to."""
    places = sorted(range(len(ranks)), key=ranks.__getitem__)
    return [sorted((ranks[j], o) for j, o in near[i]) for i in places]


def _greedy(ranks: list[int], near, atoms: list[int]) -> list[int]:
    while tied := _tied(ranks, atoms):
        ranks = _single_out(ranks, tied[0], near)
    return ranks


def _least(ranks: list[int], near, ringed: list[int], everything: list[int]) -> tuple[list, list[int]]:
    tied = _tied(ranks, ringed)
    if not tied:
        done = _greedy(ranks, near, everything)
        return _numbering(done, near), done
    best, seen = None, []
    for i in tied:
        started = _single_out(ranks, i, near)
        shape = _numbering(_greedy(_greedy(started, near, ringed), near, everything), near)
        if shape in seen:
            continue
        seen.append(shape)
        found = _least(started, near, ringed, everything)
        if best is None or found[0] < best[0]:
            best = found
    return best


def canonical_ranks(atoms: list[dict]) -> list[int]:
    """A number of its own for each atom, the same for the same molecule."""
    near = [[(n["j"], n["o"]) for n in a["n"]] for a in atoms]
    first = _dense([(len(a["n"]) != 1, a["z"] != "C", a["z"], a["q"], a["h"], a["a"], a["r"], len(a["n"])) for a in atoms])
    everything = list(range(len(atoms)))
    return _least(_refined(first, near), near, [i for i in everything if atoms[i]["r"]], everything)[1]


def _symbol(a: dict) -> str:
    z = a["z"].lower() if a["a"] else a["z"]
    if a["q"] == 0 and a["z"] in VALENCES and not (a["a"] and a["z"] not in ("B", "C", "N", "O", "P", "S")):
        used = int(sum(1.5 if n["o"] == 4 else n["o"] for n in a["n"]))
        fitting = next((v for v in VALENCES[a["z"]] if v >= used), None)
        understood = 0 if a["a"] and a["z"] not in ("B", "C") else max(0, (fitting or used) - used)
        if (fitting or a["a"]) and understood == a["h"]:
            return z
    hydrogens = "" if not a["h"] else "H" if a["h"] == 1 else f"H{a['h']}"
    charge = "" if not a["q"] else ("+" if a["q"] > 0 else "-") + (str(abs(a["q"])) if abs(a["q"]) > 1 else "")
    return f"[{z}{hydrogens}{charge}]"


def write(atoms: list[dict]) -> str:
    """The canonical SMILES; parts that are not bonded stand in the order of their texts."""
    ranks = canonical_ranks(atoms)
    near = [sorted(a["n"], key=lambda n: ranks[n["j"]]) for a in atoms]
    order = sorted(range(len(atoms)), key=ranks.__getitem__)
    seen: set[int] = set()
    return ".".join(sorted(_part(start, atoms, near, seen) for start in order if start not in seen))


def _part(start: int, atoms: list[dict], near: list[list[dict]], seen: set[int]) -> str:
    # a walk in depth finds the tree; the other bonds close rings
    tree: dict[int, list[dict]] = {}
    closing: dict[int, list[tuple[int, int]]] = {}
    stack, walked = [(start, -1, iter(near[start]))], {start}
    while stack:
        i, parent, rest = stack[-1]
        for n in rest:
            j = n["j"]
            if j not in walked:
                walked.add(j)
                tree.setdefault(i, []).append(n)
                stack.append((j, i, iter(near[j])))
                break
            if j != parent and (j, n["o"]) not in closing.get(i, []):
                closing.setdefault(i, []).append((j, n["o"]))
                closing.setdefault(j, []).append((i, n["o"]))
        else:
            stack.pop()
    seen |= walked
    digits: dict[tuple[int, int], int] = {}
    free = list(range(99, 0, -1))
    out: list[str] = []

    def mark(i: int, j: int, o: int) -> str:
        return "-" if o == 1 and atoms[i]["a"] and atoms[j]["a"] else _MARKS[o]

    todo: list = [(start, "")]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.append(item)
            continue
        i, before = item
        out.append(before + _symbol(atoms[i]))
        ended = []
        for j, o in closing.get(i, []):
            pair = (min(i, j), max(i, j))
            if pair in digits:
                d = digits.pop(pair)
                ended.append(d)
                out.append(str(d) if d < 10 else f"%{d}")
            else:
                digits[pair] = d = free.pop()
                out.append(mark(i, j, o) + (str(d) if d < 10 else f"%{d}"))
        free += sorted(ended, reverse=True)
        free.sort(reverse=True)
        following = tree.get(i, [])
        for k, n in enumerate(reversed(following)):
            step = (n["j"], mark(i, n["j"], n["o"]))
            if k:  # all but the last one in brackets
                todo += [")", step, "("]
            else:
                todo.append(step)
    return "".join(out)


def canonical_smiles(molecule: Column) -> Column:
    """The canonical SMILES of a molecule; null for none."""

    @F.arrow_udf("string")
    def spell(molecules: pa.Array) -> pa.Array:
        return pa.array([write(m["atoms"]) if m else None for m in molecules.to_pylist()], pa.string())

    return spell(molecule)
