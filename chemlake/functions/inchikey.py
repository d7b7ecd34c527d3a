"""InChIKeys of InChI texts, as expressions: hashes of the skeleton and of the rest, written in letters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Groups of three letters that stand for no number are those that begin with E and those from TAA to TTV.
_LEFT_OUT = ((4 * 26 * 26, 26 * 26), (19 * 26 * 26, 19 * 26 + 22))
#: Letters of the number of protons that were added (after N) or taken (before N).
_PROTONS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _letters(number: Column, size: int) -> Column:
    places = [F.floor(number / 26**k) % 26 for k in range(size - 1, -1, -1)]
    return F.concat(*[F.char((p + 65).cast("long")) for p in places])


def _triple(number: Column) -> Column:
    for first, width in _LEFT_OUT:
        number = F.when(number >= first, number + width).otherwise(number)
    return _letters(number, 3)


def _bits(digest: Column, begin: int, size: int) -> Column:
    """Bits of a hex digest read from its first byte on, lowest bit first."""
    first, last = begin // 8, (begin + size - 1) // 8
    little = F.concat(*[F.substring(digest, 2 * k + 1, 2) for k in range(last, first - 1, -1)])
    return F.shiftright(F.conv(little, 16, 10).cast("long"), begin % 8).bitwiseAND(F.lit((1 << size) - 1))


def inchikey(inchi: Column) -> Column:
    """The InChIKey of an InChI; null for what is none.

    Formula, connections, hydrogens and charge make the first block, other layers the second; protons are its last letter.
    Of texts with layers of fixed hydrogens or reconnected metals the key is that of what stands before these.
    """
    text = F.trim(inchi)
    standard = F.startswith(text, F.lit("InChI=1S/"))
    layers = F.split(F.regexp_replace(F.regexp_extract(text, r"^InChI=1S?/(.*)$", 1), "/[fr].*$", ""), "/")
    rest = F.slice(layers, 2, F.greatest(F.size(layers) - 1, F.lit(0)))
    major = F.concat(F.slice(layers, 1, 1), F.filter(rest, lambda x: F.rlike(x, F.lit("^[chq]"))))
    minor = F.array_join(F.transform(F.filter(rest, lambda x: ~F.rlike(x, F.lit("^[chqp]"))), lambda x: F.concat(F.lit("/"), x)), "")
    protons = F.coalesce(F.regexp_extract(text, r"/p([+-]\d+)", 1).try_cast("int"), F.lit(0))
    one, two = F.sha2(F.array_join(major, "/"), 256), F.sha2(F.when(F.length(minor) < 255, F.concat(minor, minor)).otherwise(minor), 256)
    block = lambda digest, triples: F.concat(*[_triple(_bits(digest, 14 * k, 14)) for k in range(triples)], _letters(_bits(digest, 14 * triples, 9), 2))
    letter = F.when(F.abs(protons) <= 12, F.substring(F.lit(_PROTONS), protons + 14, F.lit(1))).otherwise("A")
    key = F.concat(block(one, 4), F.lit("-"), block(two, 2), F.when(standard, "S").otherwise("N"), F.lit("A-"), letter)
    return F.when(F.rlike(text, F.lit(r"^InChI=1S?/.")), key)
