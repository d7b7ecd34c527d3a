"""Units: conversions against plain Python, and the sizes of the methods that their queries are compiled to."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from chemlake.functions import units

#: Bytes beyond which the JVM does not compile a method.
HUGE = 8_000


@pytest.mark.parametrize("name", ["provider_units", "unit_conversion", "canonical_rows"])
def test_methods_are_small_enough_to_be_compiled(spark, name):
    plan = __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
    stages = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$").codegenStringSeq(plan)
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    assert sizes and max(sizes) <= HUGE


def test_every_unit_of_a_provider_equals_plain_python(spark):
    worth = {"pa": 1.0, "pascal": 1.0, "pascals": 1.0, "kpa": 1e3, "mpa": 1e6, "bar": 1e5, "mbar": 1e2, "millibar": 1e2, "atm": 101325.0, "torr": 133.322, "mmhg": 133.322}
    kelvin, fahrenheit, celsius = ("k", "kelvin"), ("f", "°f", "fahrenheit"), ("c", "°c", "celsius")
    changed = {u: lambda v, w=w: v * w for u, w in worth.items()} | dict.fromkeys(kelvin, lambda v: v - 273.15) | dict.fromkeys(fahrenheit, lambda v: (v - 32.0) * 5.0 / 9.0) | dict.fromkeys(celsius, lambda v: v)
    names = [*changed, *(u.upper() for u in changed), *(f" {u} " for u in changed), "furlong", "", None]
    rows = [(v, u) for u in names for v in (None, 0.0, -40.0, 0.1, 98.6, 1e300, float("inf"))]
    got = spark.createDataFrame(rows, "v double, u string").select("v", "u", units.provider_unit(F.col("v"), F.col("u")).alias("p")).collect()
    for v, u, p in got:
        key = None if u is None else u.strip().lower()
        said = "Missing unit for provider property; value kept raw." if u is None else None if key in changed else f"Unknown unit '{u}' from provider; value kept unconverted."
        assert (p["value"], p["warning"]) == ((None, None) if v is None else (changed.get(key, lambda v: v)(v), said)), (v, u)
    assert len(got) == len(rows)


def test_first_temperature_of_a_text_in_celsius(spark):
    texts = {"212 °F": 100.0, "212F": 100.0, "50 fahrenheit": 10.0, "300 K": 300 - 273.15, "300k": 300 - 273.15, "20 °C": 20.0, "20 celsius": 20.0, "-5": -5.0, "7 X": 7.0, "none": None, "": None, None: None}
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", units.first_celsius(F.col("t"))).collect()
    assert {t: v for t, v in got} == texts


def test_split_keeps_rows_and_other_columns(spark):
    rows = [(1, "5 kPa", "20 °C"), (2, None, ""), (3, "x", "1e3"), (3, "x", "1e3")]
    got = units.split_units(spark.createDataFrame(rows, "key int, p string, t string"), "p", "t")
    assert got.columns == ["key", "p", "t", "p_number", "p_unit", "t_number", "t_unit"]
    assert sorted(tuple(r)[:1] + tuple(r)[3:] for r in got.collect()) == [(1, 5.0, "kPa", 20.0, "°C"), (2, None, None, None, None), (3, None, None, 1000.0, None), (3, None, None, 1000.0, None)]
