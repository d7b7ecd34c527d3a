"""Numbers with units, estimates, and numbers in foreign notation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a unit is worth, by its normal spelling.
NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
PRESSURE = {"pa": 1.0, "kpa": 1e3, "mpa": 1e6, "bar": 1e5, "mbar": 1e2, "atm": 101325.0, "torr": 133.322368, "mmhg": 133.322368}
DENSITY = {"g/ml": 1.0, "g/cm3": 1.0, "g/cc": 1.0, "kg/m3": 0.001, "mg/ml": 0.001}
SOLUBILITY = {"mg/l": 1.0, "g/l": 1000.0, "mg/ml": 1000.0, "ug/ml": 1.0, "ng/ml": 0.001, "g/ml": 1_000_000.0}
MOLAR = {"mol/l": 1.0, "m": 1.0, "molar": 1.0, "mmol/l": 1e3, "mmolar": 1e3, "mm": 1e3, "umol/l": 1e6, "umolar": 1e6, "um": 1e6}
OLD_TORR = 133.322
#: Temperatures in Celsius: what is taken off, and what the rest is multiplied and divided by, in this order.
KELVIN, FAHRENHEIT, AS_IS = (273.15, 1.0, 1.0), (32.0, 5.0, 9.0), (0.0, 1.0, 1.0)
PROVIDER = {
    **{u: (0.0, worth, 1.0) for u, worth in (PRESSURE | {"pascal": 1.0, "pascals": 1.0, "millibar": 100.0, "torr": OLD_TORR, "mmhg": OLD_TORR}).items()},
    **dict.fromkeys(("k", "kelvin"), KELVIN), **dict.fromkeys(("f", "°f", "fahrenheit"), FAHRENHEIT), **dict.fromkeys(("c", "°c", "celsius"), AS_IS),
}


def is_missing(c: Column) -> Column:
    t = c.cast("string")
    return t.isNull() | (F.trim(t) == "") | (F.lower(F.trim(t)) == "nan")


def as_number(c: Column) -> Column:
    """A number's text as double; null for anything else, also nan, inf and suffixed numbers."""
    t = F.trim(c.cast("string"))
    return F.when(F.rlike(t, F.lit(f"^{NUMBER}$")), t.try_cast("double"))


def log10_positive(x: Column) -> Column:
    """The logarithm of a double; null unless it is positive."""
    return F.when(x > 0, F.log10(x))


def safe_log10(c: Column) -> Column:
    """The same of a number in text."""
    return log10_positive(as_number(c))


def normal_unit(u: Column) -> Column:
    return F.translate(F.lower(u), "μµ °", "uu")


def split_units(rows: DataFrame, *columns: str) -> DataFrame:
    """rows with number and unit of texts '<number> <unit>' in <column>_number and <column>_unit; both null if the text is
    something else. Each text is looked at once however often its parts are used; they are generated, which puts what comes
    before into a method of its own: the JVM compiles none of more than 8,000 bytes."""
    shape = rf"^\s*({NUMBER})\s*([^0-9\s].*?)?\s*$"
    out = {}
    for c in columns:
        t = F.col(c).cast("string")
        out[f"{c}_number"] = F.nullif(F.regexp_extract(t, shape, 1), F.lit("")).try_cast("double")
        out[f"{c}_unit"] = F.nullif(F.trim(F.regexp_extract(t, shape, 2)), F.lit(""))
    made = rows.withColumn("_split", F.explode_outer(F.array(F.struct(*[part.alias(name) for name, part in out.items()]))))
    return made.withColumns({name: F.col("_split")[name] for name in out}).drop("_split")


def _worth(table: dict[str, float], unit: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), unit)


def _steps(table: dict[str, tuple[float, float, float]], unit: Column) -> Column:
    """struct<minus, times, over>; null for a unit that the table does not have."""
    steps = {u: F.struct(*[F.lit(x).alias(n) for n, x in zip(("minus", "times", "over"), s, strict=True)]) for u, s in table.items()}
    return F.try_element_at(F.create_map(*[x for u, s in steps.items() for x in (F.lit(u), s)]), unit)


def _stepped(value: Column, steps: Column) -> Column:
    return F.coalesce((value - steps["minus"]) * steps["times"] / steps["over"], value)


def _struct(value: Column, warning: Column) -> Column:
    return F.struct(value.alias("value"), warning.alias("warning"))


def _converted(number: Column, unit: Column, table: dict[str, float], what: str) -> Column:
    worth = _worth(table, normal_unit(unit))
    strange = unit.isNotNull() & worth.isNull()
    return _struct(number * F.coalesce(worth, F.lit(1.0)), F.when(strange, F.concat(F.lit(f"Unit conversion: unsupported {what} unit '"), unit, F.lit("' (kept raw numeric)"))))


def to_pascal(number: Column, unit: Column) -> Column:
    """struct<value, warning>; without a unit the number is taken to be pascal."""
    return _converted(number, unit, PRESSURE, "pressure")


def to_g_ml(number: Column, unit: Column) -> Column:
    """struct<value, warning>; without a unit the number is taken to be g/mL."""
    return _converted(number, unit, DENSITY, "density")


def to_celsius(number: Column, unit: Column) -> Column:
    """struct<value, warning>; without a unit the number is taken to be Celsius."""
    v, u = number, normal_unit(unit)
    value = F.when(u.isin("k", "degk"), v - 273.15).when(u.isin("f", "degf"), (v - 32.0) * 5.0 / 9.0).otherwise(v)
    strange = u.isNotNull() & ~u.isin("c", "degc", "k", "degk", "f", "degf")
    return _struct(value, F.when(strange, F.concat(F.lit("Unit conversion: unsupported temperature unit '"), unit, F.lit("' (kept raw numeric)"))))


def to_mg_l(number: Column, unit: Column, weight: Column) -> Column:
    """struct<value, warning>; molar units need the molecular weight, ppm counts as mg/L with a warning."""
    v, u = number, normal_unit(unit)
    mass, molar = _worth(SOLUBILITY, u), _worth(MOLAR, u)
    value = F.when(mass.isNotNull(), v * mass).when(molar.isNotNull() & weight.isNotNull(), v / molar * weight * 1000.0).otherwise(v)
    said = (
        F.when(u.isNull() | mass.isNotNull(), F.lit(None).cast("string"))
        .when(u == "ppm", "Unit conversion: treated ppm as mg/L (aqueous approximation)")
        .when(molar.isNotNull(), F.when(weight.isNull(), F.concat(F.lit("Unit conversion: solubility '"), unit, F.lit("' requires MW (missing); kept raw numeric"))))
        .otherwise(F.concat(F.lit("Unit conversion: unsupported solubility unit '"), unit, F.lit("' (kept raw numeric)")))
    )
    return _struct(value, said)


def strict_pascal(value: Column, unit: Column) -> Column:
    """struct<value, warning>: a unit is needed, and an unknown one gives no value (older torr)."""
    worth = _worth(PRESSURE | {"torr": OLD_TORR, "mmhg": OLD_TORR}, normal_unit(unit))
    said = F.when(is_missing(unit), "pressure without unit").when(worth.isNull(), F.concat(F.lit("pressure unit not supported: "), unit))
    return _struct(as_number(value) * worth, said)


def strict_g_ml(value: Column, unit: Column) -> Column:
    """The same for density; without a unit only values between 0 and 5 stand."""
    v, worth = as_number(value), _worth(DENSITY, normal_unit(unit))
    plain = F.when((v > 0) & (v < 5), v)
    return _struct(F.when(is_missing(unit), plain).otherwise(v * worth), F.when(is_missing(unit) & plain.isNull(), "density without unit").when(~is_missing(unit) & worth.isNull(), F.concat(F.lit("density unit not supported: "), unit)))


def strict_mg_l(value: Column, unit: Column) -> Column:
    """The same for solubility: no ranges, no percentages, ppm as mg/L and ppb as a thousandth of it."""
    worth = _worth(SOLUBILITY | {"ppm": 1.0, "ppb": 0.001}, normal_unit(unit))
    said = F.when(as_number(value).isNull(), "solubility is no single number").when(is_missing(unit), "solubility without unit").when(worth.isNull(), F.concat(F.lit("solubility unit not supported: "), unit))
    return _struct(as_number(value) * worth, said)


def vaporisation_heat(value: Column, unit: Column) -> Column:
    """kJ/mol; kcal/mol are converted, other units give no value."""
    worth = _worth({"kj/mol": 1.0, "kcal/mol": 4.184}, normal_unit(unit))
    return _struct(as_number(value) * worth, F.when(worth.isNull(), "heat of vaporization unit not supported"))


def refractive_index(c: Column) -> Column:
    """A number between 1.0 and 2.2, or the mean of a range of two; else null."""
    ends = F.transform(F.regexp_extract_all(c.cast("string"), F.lit(r"(\d+(?:\.\d+)?)"), F.lit(1)), lambda x: x.try_cast("double"))
    mean = F.when(F.rlike(c.cast("string"), F.lit(r"^\s*\d+(\.\d+)?\s*-\s*\d+(\.\d+)?\s*$")), (F.get(ends, F.lit(0)) + F.get(ends, F.lit(1))) / 2).otherwise(F.get(ends, F.lit(0)))
    return F.when((mean > 1.0) & (mean < 2.2), mean)


def temperature_in(text: Column) -> Column:
    """The temperature in Celsius that a text names ('at 20 C', '298 K'), one in Celsius first; null if none."""
    low, number = F.lower(text), r"(\d+(?:\.\d+)?)\s*"
    celsius, kelvin = (F.nullif(F.regexp_extract(low, number + unit, 1), F.lit("")).try_cast("double") for unit in ("(?:°?c|celsius)", r"k\b"))
    return F.coalesce(celsius, kelvin - 273.15)


def first_celsius(text: Column) -> Column:
    """The first number of a text in Celsius: kelvin (K, k) and Fahrenheit (F, fahrenheit) are converted, all else counts as Celsius."""
    shape = r"([-+]?\d+(?:\.\d+)?)\s*([Kk]|°?C|°?F|fahrenheit|celsius)?"
    v = F.nullif(F.regexp_extract(text, shape, 1), F.lit("")).try_cast("double")
    u = F.replace(F.lower(F.regexp_extract(text, shape, 2)), F.lit("°"), F.lit(""))
    return _stepped(v, _steps({"k": KELVIN, "f": FAHRENHEIT, "fahrenheit": FAHRENHEIT}, u))


def provider_unit(value: Column, unit: Column) -> Column:
    """struct<value, warning>: temperatures in Celsius and pressures in pascal by their unit's name (older torr); a value
    without unit, or of another unit, stays with a warning."""
    steps = _steps(PROVIDER, F.lower(F.trim(unit)))
    strange = F.concat(F.lit("Unknown unit '"), unit, F.lit("' from provider; value kept unconverted."))
    said = F.when(unit.isNull(), "Missing unit for provider property; value kept raw.").when(steps.isNull(), strange)
    return _struct(_stepped(value, steps), F.when(value.isNotNull(), said))


def quantity_mpa05(c: Column) -> Column:
    """A number, or the number of a text like Quantity[17., Sqrt["Megapascals"]]."""
    inner = F.regexp_extract(c.cast("string"), rf"Quantity\[\s*({NUMBER})", 1)
    return F.coalesce(as_number(c), F.when(inner != "", inner.try_cast("double")))


def power_notation(c: Column) -> Column:
    """1.1&times;10<sup>&#8722;6</sup> as a double; plain numbers too."""
    t = F.replace(F.replace(F.replace(c, F.lit("&times;"), F.lit("x")), F.lit("&#8722;"), F.lit("-")), F.lit("×"), F.lit("x"))
    t = F.regexp_replace(F.replace(t, F.lit("−"), F.lit("-")), r"</?sup>|\s", "")
    shape = r"^([-+]?\d*\.?\d+)x10\^?([-+]?\d+)$"
    fits = F.rlike(t, F.lit(shape))
    return F.when(fits, F.concat_ws("e", F.regexp_extract(t, shape, 1), F.regexp_extract(t, shape, 2)).try_cast("double")).otherwise(as_number(t))


def guess_density(weight: Column, logp: Column) -> Column:
    base = F.when(logp > 3, 0.80).when(logp > 1, 0.95).otherwise(1.15)
    return F.when(weight.isNotNull() & logp.isNotNull(), F.bround(base * (1 + (weight - 100) / 1500), 3))


def guess_vapour_pressure(boiling: Column) -> Column:
    return F.when(boiling.isNotNull(), F.bround(F.pow(F.lit(10.0), 8 - 2000 / (boiling + 273.15 - 50)), 2))


def guess_solubility(logp: Column) -> Column:
    return F.when(logp < 0, 1e5).when(logp < 1, 1e4).when(logp < 3, 1e3).when(logp < 5, 100.0).when(logp.isNotNull(), 1.0)


def guess_boiling_point(weight: Column, rings: Column) -> Column:
    return F.when(weight.isNotNull() & rings.isNotNull(), F.bround(weight * 0.6 + rings * 25.0, 1))
