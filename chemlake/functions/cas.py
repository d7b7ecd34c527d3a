"""CAS registry numbers: four dialects, and the pieces of the repair ladder.

The dialects differ in the length of the head, in leading zeros and in whether the check digit is part of validity, so each
has functions of its own.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chemlake.functions.sql_text import api
from chemlake.functions.text import squeeze

# Shapes of numbers and dates, and what parts the numbers of a cell.
SHAPE = r"^\d{1,7}-\d{2}-\d$"
INNER = r"\d{1,7}-\d{2}-\d"
PARTED = r"[\\/;,\r\n\t ]+"
YEAR_FIRST = r"^(\d{2,7})-(\d{2})-(\d{2})(?:\s+\d{2}:\d{2}:\d{2})?$"
SLASHED = r"^(\d{1,2})/(\d{1,2})/(\d{2,7})(?:\s+\d{2}:\d{2}:\d{2})?$"
# Digits next to each digit on the number row or the number pad.
NEIGHBOURS = {
    "0": "29",
    "1": "24",
    "2": "0135",
    "3": "246",
    "4": "1357",
    "5": "2468",
    "6": "3579",
    "7": "468",
    "8": "579",
    "9": "068",
}


def _weighted(digits: Column, first: int) -> Column:
    """Digits from the right, times first, first + 1 and so on, summed."""
    x = api(digits)
    each = x.filter(x.split(x.reverse(digits), ""), lambda d: d != "")
    return x.aggregate(x.transform(each, lambda d, i: (x.ascii(d) - 48) * (i + first)), x.lit(0), lambda a, b: a + b)


def check_digit(body: Column) -> Column:
    """The check digit that the other digits ask for."""
    x = api(body)
    return x.pmod(_weighted(body, 1), x.lit(10))


def checksum_holds(cas: Column) -> Column:
    """The last digit, which itself counts nothing, is what the others ask for."""
    x = api(cas)
    digits = x.regexp_replace(cas, "[^0-9]", "")
    return x.pmod(_weighted(digits, 0), x.lit(10)) == x.ascii(x.right(digits, x.lit(1))) - 48


def valid(c: Column) -> Column:
    """Cleaner's dialect: 1-7, 2 and 1 digits, not all zero, and the checksum."""
    x = api(c)
    t = x.trim(c)
    return x.coalesce(x.rlike(t, x.lit(SHAPE)) & (x.translate(t, "0-", "") != "") & checksum_holds(t), x.lit(False))


def all_zero(c: Column) -> Column:
    """There are digits, and all are zero."""
    x = api(c)
    return x.rlike(x.regexp_replace(x.coalesce(c, x.lit("")), "[^0-9]", ""), x.lit("^0+$"))


def tokens(cell: Column) -> Column:
    """The numbers of a cell in order; a no-break space parts two CAS numbers only; a pipe parts nothing."""
    x = api(cell)
    spaced = x.regexp_replace(x.coalesce(cell, x.lit("")), rf"({INNER})\x{{00A0}}({INNER})", "$1 $2")
    return x.filter(x.transform(x.split(spaced, PARTED), lambda t: x.regexp_replace(t, r"(?U)^\s+|\s+$", "")), lambda t: t != "")


def slash_tokens(cell: Column) -> Column:
    """The candidates of a cell that only slashes part."""
    spaced = F.translate(F.coalesce(cell, F.lit("")), "\u00a0\\", " /")
    return F.filter(F.transform(F.split(spaced, "/"), lambda t: F.trim(t)), lambda t: t != "")


def date_like(c: Column) -> Column:
    x = api(c)
    t = squeeze(c)
    return x.rlike(t, x.lit(YEAR_FIRST)) | x.rlike(t, x.lit(SLASHED))


def from_date(c: Column) -> Column:
    """The valid number that a spreadsheet turned into a date; null if there is none.

    Only days 01-09 come from a single check digit. Slashed dates are tried month first, then day first.
    """
    x = api(c)
    t = squeeze(c)
    part = lambda pattern, k: x.regexp_extract(t, pattern, k)
    a, b = part(SLASHED, 1), part(SLASHED, 2)
    is_month, is_day = x.lit("^(0?[1-9]|1[0-2])$"), x.lit("^0?[1-9]$")
    slashed = lambda month, day: x.when(x.rlike(month, is_month) & x.rlike(day, is_day), x.concat_ws("-", part(SLASHED, 3), x.lpad(month, 2, "0"), x.right(day, x.lit(1))))
    hyphened = x.when(x.rlike(part(YEAR_FIRST, 3), x.lit("^0[1-9]$")), x.concat_ws("-", part(YEAR_FIRST, 1), part(YEAR_FIRST, 2), x.right(part(YEAR_FIRST, 3), x.lit(1))))
    # a text has one of the two shapes at most
    one, two = x.coalesce(hyphened, slashed(a, b)), slashed(b, a)
    return x.when(date_like(c), x.when(valid(one), one).when(valid(two), two))


def from_digits(digits: Column) -> Column:
    """5 to 10 digits with dashes put in, if that is valid."""
    x = api(digits)
    number = x.concat_ws("-", x.substring(digits, x.lit(1), x.length(digits) - 3), x.substring(digits, x.length(digits) - 2, x.lit(2)), x.right(digits, x.lit(1)))
    return x.when(x.rlike(digits, x.lit(r"^\d{5,10}$")) & valid(number), number)


def with_check_digit(c: Column) -> Column:
    """A number that lacks its check digit, with it."""
    x = api(c)
    t = x.trim(c)
    number = x.concat(t, x.lit("-"), check_digit(x.regexp_replace(t, "-", "")).cast("string"))
    return x.when(x.rlike(t, x.lit(r"^\d{2,7}-\d{2}$")) & valid(number), number)


def swaps(c: Column) -> Column:
    """All texts with two neighbouring characters swapped, each once, in order."""
    x = api(c)
    t = x.replace(x.trim(c), x.lit(" "), x.lit(""))
    at = lambda i: x.concat(x.substring(t, x.lit(1), i - 1), x.substring(t, i + 1, x.lit(1)), x.substring(t, i, x.lit(1)), x.substring(t, i + 2, x.length(t)))
    return x.when(x.length(t) > 1, x.array_distinct(x.transform(x.sequence(x.lit(1), x.length(t) - 1), at))).otherwise(x.array().cast("array<string>"))


def neighbour_digits(c: Column) -> Column:
    """All texts with one digit replaced by a neighbouring one, each once, in order."""
    x = api(c)
    t = x.replace(x.trim(c), x.lit(" "), x.lit(""))
    near = x.create_map(*[v for d, ns in NEIGHBOURS.items() for v in (x.lit(d), x.array(*[x.lit(n) for n in ns]))])
    none = x.array().cast("array<string>")
    at = lambda i: x.transform(x.coalesce(x.try_element_at(near, x.substring(t, i, x.lit(1))), none), lambda d: x.concat(x.substring(t, x.lit(1), i - 1), d, x.substring(t, i + 1, x.length(t))))
    return x.when(x.length(t) > 0, x.array_distinct(x.flatten(x.transform(x.sequence(x.lit(1), x.length(t)), at)))).otherwise(none)


def _head(c: Column) -> Column:
    """Digits without leading zeros; all zeros are 0."""
    return F.regexp_replace(c, "^0+(?=.)", "")


def resolver_cas(c: Column) -> Column:
    """Resolver's dialect: struct<cas, warnings>; cas is null where no number can be made out."""
    text = F.trim(c)
    s = F.regexp_replace(text, "[^0-9-]", "")
    digits, parts = F.regexp_replace(s, "-", ""), F.split(s, "-")
    cut = F.concat_ws("-", _head(F.substring(digits, F.lit(1), F.length(digits) - 3)), F.substring(digits, F.length(digits) - 2, F.lit(2)), F.right(digits, F.lit(1)))
    three = F.size(parts) == 3
    whole = three & F.rlike(s, F.lit(r"^\d+-\d+-\d+$"))
    padded = F.when(F.length(F.get(parts, F.lit(1))) < 2, F.lpad(F.get(parts, F.lit(1)), 2, "0")).otherwise(F.get(parts, F.lit(1)))
    joined = F.concat_ws("-", _head(F.get(parts, F.lit(0))), padded, F.get(parts, F.lit(2)))
    enough = F.length(digits) >= 4
    number = F.when(s.contains("-"), F.when(whole, joined).when(~three & enough, cut)).when(enough, cut)
    warn = lambda condition, said: F.when(condition, F.lit(said))
    warnings = F.array_compact(
        F.array(
            warn(s != text, "removed illegal characters"),
            warn(s.contains("-") & ~three, "repositioned dashes"),
            warn(~s.contains("-"), "added dashes"),
            warn(whole & (F.length(F.get(parts, F.lit(1))) < 2), "padded middle block"),
            warn(whole & (joined != c), "general normalization applied"),
        )
    )
    return F.struct(number.alias("cas"), F.when(number.isNotNull(), F.array_join(warnings, "; ")).alias("warnings"))


def resolver_valid(c: Column) -> Column:
    """Whether the resolver's dialect makes out a number whose checksum holds."""
    n = resolver_cas(c)["cas"]
    return F.coalesce(F.rlike(n, F.lit(SHAPE)) & checksum_holds(n), F.lit(False))


def property_cas(c: Column) -> Column:
    """Property tables' dialect: any head, leading zeros stay, regrouped where need be; null unless the checksum holds."""
    s = F.regexp_replace(F.trim(c), "[^0-9-]", "")
    digits = F.regexp_replace(s, "-", "")
    cut = F.concat_ws("-", F.substring(digits, F.lit(1), F.length(digits) - 3), F.substring(digits, F.length(digits) - 2, F.lit(2)), F.right(digits, F.lit(1)))
    number = F.when(F.rlike(s, F.lit(r"^\d{2,7}-\d{2}-\d$")), s).when(F.length(digits) >= 3, cut)
    return F.when(F.rlike(number, F.lit(r"^\d+-\d+-\d$")) & checksum_holds(number), number)


def ingest_cas(c: Column) -> Column:
    """Ingest's dialect: spaces around dashes go, leading zeros go, the checksum is not looked at."""
    shape = r"^\s*([0-9]{2,7})\s*-\s*([0-9]{2})\s*-\s*([0-9])\s*$"
    return F.when(F.rlike(c, F.lit(shape)), F.concat_ws("-", _head(F.regexp_extract(c, shape, 1)), F.regexp_extract(c, shape, 2), F.regexp_extract(c, shape, 3)))


def ingest_checksum_holds(c: Column) -> Column:
    """The checksum; a head of one digit is no number in this dialect."""
    return F.coalesce(F.rlike(c, F.lit(r"^\s*[0-9]{2,7}\s*-\s*[0-9]{2}\s*-\s*[0-9]\s*$")) & checksum_holds(c), F.lit(False))


def numbers_in(text: Column) -> Column:
    """Sorted distinct numbers in a text, in ingest's dialect."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\b(\d{2,7}-\d{2}-\d)\b"), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(found, ingest_cas)))
