"""Properties out of a provider's nested answers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chemlake.functions import units

# Properties, and the words that their entries' names hold.
PROPERTIES = {
    "boiling_point_c": ("boiling",),
    "melting_point_c": ("melting",),
    "flash_point_c": ("flash",),
    "autoignition_temp_c": ("autoignition",),
    "critical_temp_c": ("critical temperature",),
    "vapor_pressure_pa": ("vapor pressure",),
    "critical_pressure_pa": ("critical pressure",),
    "density_g_ml": ("density",),
    "refractive_index": ("refractive index",),
    "water_solubility_mg_l": ("water solubility", "aqueous solubility"),
    "logp": ("logp", "log p"),
    "heat_of_vaporization_kj_mol": ("heat of vaporization",),
}


_ENTRY = "struct<name:string,value:string,unit:string,text:string>"
_FOUND = f"struct<path:array<int>,entry:{_ENTRY}>"


def _list(variant: str, path: str) -> str:
    return f"coalesce(try_variant_get({variant}, '{path}', 'array<variant>'), array())"


def _entry(e: str) -> str:
    """SQL: an entry's number (the first one of a list) with its unit, else its text, else its first marked-up text."""
    is_number = lambda v: f"schema_of_variant({v}) RLIKE '^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)'"
    as_text = lambda v: f"CAST(try_variant_get({v}, '$', 'double') AS STRING)"
    value = f"variant_get({e}, '$.Value')"
    first = f"get(filter(transform({_list(e, '$.Value.Number')}, n -> IF({is_number('n')}, {as_text('n')}, NULL)), n -> n IS NOT NULL), 0)"
    single = f"try_variant_get({e}, '$.Value.Number', 'string')"
    plain = f"coalesce(try_variant_get({e}, '$.Value.String', 'string'), try_variant_get({e}, '$.Value.StringWithMarkup[0].String', 'string'))"
    number = f"CASE WHEN schema_of_variant(variant_get({e}, '$.Value.Number')) LIKE 'ARRAY%' THEN {first} WHEN {is_number(f"variant_get({e}, '$.Value.Number')")} THEN {as_text(f"variant_get({e}, '$.Value.Number')")} ELSE {single} END"
    has, unit = f"try_variant_get({e}, '$.Value.Number', 'variant') IS NOT NULL", f"try_variant_get({e}, '$.Value.Unit', 'string')"
    fields = f"'name', lower(try_variant_get({e}, '$.Name', 'string')), 'value', IF({has}, {number}, {plain}), 'unit', IF({has}, {unit}, NULL), 'text', IF({has}, concat_ws(' ', {number}, {unit}), {plain})"
    return f"IF(schema_of_variant({value}) LIKE 'OBJECT%', named_struct({fields}), NULL)"


def _walked(answer: str, sections: str) -> str:
    """SQL: the entries of sections and of all sections in them, at any depth, each section's own before those of its sections.

    A step reads the entries of the sections that are open and opens theirs; there are no more levels than places where
    the answer names sections.  Paths give the order.
    """
    opened = f"transform({sections}, (s, k) -> named_struct('path', array(1, k), 'section', s))"
    entries = f"flatten(transform(w.open, o -> transform({_list('o.section', '$.Information')}, (e, k) -> named_struct('path', concat(o.path, array(0, k)), 'entry', {_entry('e')}))))"
    deeper = f"flatten(transform(w.open, o -> transform({_list('o.section', '$.Section')}, (s, k) -> named_struct('path', concat(o.path, array(1, k)), 'section', s))))"
    step = f"IF(size(w.open) = 0, w, named_struct('done', concat(w.done, {entries}), 'open', {deeper}))"
    walk = f"""aggregate(sequence(1, greatest(1, regexp_count({answer}, '"Section"'))), named_struct('done', CAST(array() AS array<{_FOUND}>), 'open', {opened}), (w, i) -> {step}, w -> w.done)"""
    return f"transform(array_sort({walk}, (a, b) -> CASE WHEN a.path < b.path THEN -1 WHEN a.path > b.path THEN 1 ELSE 0 END), f -> f.entry)"


def information(answers: DataFrame, answer: str, out: str) -> DataFrame:
    """answers with `out`, array<struct<name, value, unit, text>>: an answer's entries in depth-first order, those without value left out.

    Entries are those of Record's sections, at any depth, or where there are none those of the first compound's sections.
    Of an entry the number (the first one of a list) with its unit counts, else the text, else the first marked-up text.
    An answer that is null, no JSON or of another shape has no entries.
    """
    read = answers.withColumn("_json", F.expr(f"try_parse_json(CAST({answer} AS STRING))"))
    record = read.withColumn(out, F.expr(f"filter({_walked(answer, _list('_json', '$.Record.Section'))}, e -> e IS NOT NULL)"))
    # the other shape is walked only where the first one holds no entry at all
    compound = f"filter({_walked(answer, _list('_json', '$.PC_Compounds[0].Section'))}, e -> e IS NOT NULL)"
    both = record.withColumn(out, F.expr(f"IF(size({out}) > 0 OR _json IS NULL, {out}, {compound})"))
    return both.withColumn(out, F.expr(f"coalesce(filter({out}, e -> e.value IS NOT NULL), CAST(array() AS array<{_ENTRY}>))")).drop("_json")


def _normal(prop: str, e: Column) -> Column:
    """struct<value, warning> of an entry."""
    plain = lambda v: F.struct(v.alias("value"), F.lit(None).cast("string").alias("warning"))
    if prop.endswith("_c"):
        return plain(units.first_celsius(e["text"]))
    if prop.endswith("_pa"):
        return units.strict_pascal(e["value"], e["unit"])
    if prop == "density_g_ml":
        return units.strict_g_ml(e["value"], e["unit"])
    if prop == "water_solubility_mg_l":
        return units.strict_mg_l(e["value"], e["unit"])
    if prop == "heat_of_vaporization_kj_mol":
        return units.vaporisation_heat(e["value"], e["unit"])
    return plain(units.refractive_index(e["value"]) if prop == "refractive_index" else units.as_number(e["value"]))


def properties(answers: DataFrame, answer: str = "answer") -> DataFrame:
    """answers with experimental_<property>, source_<property> and experimental_<property>_temperature_c of each property, and warnings.

    The first entry counts whose name holds one of a property's words; its source is named even if its unit gives no value.
    """
    out = information(answers, answer, "_found")
    first = lambda words: F.get(F.filter("_found", lambda e: F.rlike(e["name"], F.lit("|".join(map(re.escape, words))))), F.lit(0))
    firsts = {p: first(words) for p, words in PROPERTIES.items()}
    out = out.withColumns({f"_{p}": e for p, e in firsts.items()})
    shown, said = {}, []
    for p in PROPERTIES:
        e = F.col(f"_{p}")
        normal = F.when(e.isNotNull(), _normal(p, e))
        said.append(normal["warning"])
        shown |= {f"experimental_{p}": normal["value"], f"source_{p}": F.when(e.isNotNull(), "pubchem"), f"experimental_{p}_temperature_c": units.temperature_in(e["text"])}
    none = F.when(F.size("_found") == 0, "no usable entries in the answer")
    return out.withColumns(shown | {"warnings": F.array_join(F.array_compact(F.array(none, *said)), "; ")}).drop("_found", *[f"_{p}" for p in PROPERTIES])
