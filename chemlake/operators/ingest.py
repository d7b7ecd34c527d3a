"""Public pages: classes, names, tables, numbers, and entities made of them."""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chemlake.functions import cas
from chemlake.functions.text import entity_name, squeeze

# Words of titles of pages about groups, names that name nothing, and the columns of the list table.
GROUP_WORDS = "mixture|family|group|class"
SYMBOLS = ("alpha", "beta", "gamma", "delta", "epsilon", "(r)", "(s)", "r", "s")
LIST_COLUMNS = ("CAS", "Principal name")


def title(html: Column) -> Column:
    return F.when(F.rlike(html, F.lit("(?is)<title[^>]*>.*?</title>")), F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)))


def page_class(html: Column) -> Column:
    """GROUP for pages without title or about several substances, else MATERIAL."""
    t = title(html)
    return F.when(t.isNull() | (t == "") | F.rlike(F.lower(t), F.lit(GROUP_WORDS)), "GROUP").otherwise("MATERIAL")


def page_name(html: Column) -> Column:
    """The title up to its first dash."""
    return squeeze(F.substring_index(title(html), "-", 1))


def synonyms(html: Column) -> Column:
    """Sorted distinct synonyms: what follows the colon after a bold 'Synonyms', parted by commas."""
    text = F.regexp_extract(html, r"(?is)<b>\s*Synonyms[^<]*</b>\s*:?\s*([^<]*)", 1)
    named = F.filter(F.transform(F.split(F.regexp_replace(text, r"^\s*:", ""), ","), lambda s: F.trim(s)), lambda s: s != "")
    return F.array_sort(F.array_distinct(named))


def last_page(html: Column) -> Column:
    """y of 'Page x of y'; 1 if there is none."""
    return F.coalesce(F.regexp_extract(html, r"(?i)Page\s+\d+\s+of\s+(\d+)", 1).try_cast("int"), F.lit(1))


def component_config(html: Column, key: str) -> Column:
    """A value of the JSON attribute s-config or data-config of a component."""
    raw = F.regexp_extract(html, r"(?:s|data)-config=[\"'](\{.*?\})[\"']", 1)
    return F.get_json_object(F.replace(F.replace(raw, F.lit("&quot;"), F.lit('"')), F.lit("&amp;"), F.lit("&")), f"$.{key}")


def table_rows(html: Column) -> Column:
    """array<array<string>>: cells of the first table that has the columns of the list."""
    cells = re.compile(r"<t[dh][^>]*>(.*?)(?=</t[dh]>|<t[dh]|</tr>|$)", re.S | re.I)

    @F.arrow_udf("array<array<string>>")
    def rows(pages: pa.Array) -> pa.Array:
        out = []
        for page in pages.to_pylist():
            found: list[list[str]] = []
            for table in re.findall(r"<table.*?(?:</table>|\Z)", page or "", re.S | re.I):
                lines = [[" ".join(unescape(re.sub(r"<[^>]*>", " ", c)).split()) for c in cells.findall(line)] for line in re.split(r"<tr[^>]*>", table, flags=re.I)[1:]]
                if lines and all(any(c in head for head in lines[0]) for c in LIST_COLUMNS):
                    found = [(line + [""] * 3)[:3] for line in lines[1:] if line]
                    break
            out.append(found)
        return pa.array(out, pa.list_(pa.list_(pa.string())))

    return F.when(F.coalesce(F.lower(html).contains("<table"), F.lit(False)), rows(html)).otherwise(F.array().cast("array<array<string>>"))


def listed_substances(pages: DataFrame) -> DataFrame:
    """(cas_raw, cas, cas_ok, principal_name, category, source_url, retrieved_at) of the rows of list pages."""
    cell = lambda i: F.get("r", F.lit(i))
    rows = pages.select("url", "retrieved_at", F.explode(table_rows(F.col("html"))).alias("r"))
    number = cas.ingest_cas(cell(0))
    return rows.select(cell(0).alias("cas_raw"), number.alias("cas"), F.when(number.isNotNull(), cas.ingest_checksum_holds(number)).alias("cas_ok"), squeeze(cell(1)).alias("principal_name"), squeeze(cell(2)).alias("category"), F.col("url").alias("source_url"), "retrieved_at")


def by_number(rows: DataFrame) -> DataFrame:
    """One row per number: sorted distinct names, categories and addresses, the latest retrieval, any good checksum."""
    texts = lambda c: F.array_sort(F.collect_set(F.when(F.col(c) != "", F.col(c))))
    return rows.where("cas IS NOT NULL").groupBy("cas").agg(texts("principal_name").alias("names"), texts("category").alias("categories"), texts("source_url").alias("urls"), F.max("retrieved_at").alias("retrieved_at"), F.bool_or("cas_ok").alias("cas_ok"))


def discover(pages: DataFrame, reference: DataFrame) -> DataFrame:
    """(page_id, cas, route) of pages (page_id, status, html): not_found, group, no_cas, reference, candidate.

    A number of the reference list is no candidate; pages without number give one row without it.
    """
    seen = pages.withColumn("numbers", cas.numbers_in(F.col("html"))).withColumn(
        "route", F.when(F.col("status") == 404, "not_found").when(page_class(F.col("html")) == "GROUP", "group").when(F.size("numbers") == 0, "no_cas")
    )
    routed = seen.where("route IS NOT NULL").select("page_id", F.lit(None).cast("string").alias("cas"), "route")
    found = seen.where("route IS NULL").select("page_id", F.explode("numbers").alias("cas"))
    known = found.join(reference.select("cas").distinct().withColumn("known", F.lit(True)), "cas", "left")
    return routed.unionByName(known.select("page_id", "cas", F.when(F.col("known"), "reference").otherwise("candidate").alias("route")))


def usable_name(name: Column) -> Column:
    """struct<name, confidence>: no name for symbols, short texts and numbers; medium where a comma and number end it."""
    t = squeeze(name)
    bad = F.lower(t).isin(*SYMBOLS) | (F.length(t) < 5) | F.rlike(t, F.lit(r"^[\d-]+$"))
    return F.struct(F.when(~bad, t).alias("name"), F.when(bad, "low").when(F.rlike(t, F.lit(r",\s*\d+$")), "medium").otherwise("high").alias("confidence"))


def entity_class(count: Column, name: Column) -> Column:
    low = F.lower(F.coalesce(name, F.lit("")))
    return F.when(count > 1, "stereo_family").when(F.rlike(low, F.lit("reaction product|acetal")), "reaction_product").when(F.rlike(low, F.lit("oil|terpen")), "mixture_like").when(count == 1, "monomer").otherwise("unknown")


def entities(rows: DataFrame) -> DataFrame:
    """One row per page id of rows (rw_id, cas, name, discovered_at, _row): numbers, first usable name, class, first time."""
    named = rows.withColumn("usable", usable_name(F.col("name")))
    ok = F.col("usable.name").isNotNull()
    grouped = named.groupBy("rw_id").agg(F.array_sort(F.collect_set("cas")).alias("cas_list"), F.min_by(F.when(ok, F.col("usable.name")), F.when(ok, F.col("_row"))).alias("name"), F.min("discovered_at").alias("discovered_at"))
    return grouped.withColumn("entity_class", entity_class(F.size("cas_list"), F.col("name")))


def shadows(found: DataFrame, reference: DataFrame) -> DataFrame:
    """entities with shadowed: a number or the normal name is in the reference (cas, name); with the shared numbers."""
    numbers = found.select("rw_id", F.explode("cas_list").alias("cas")).join(reference.select("cas").distinct(), "cas", "left_semi").groupBy("rw_id").agg(F.array_sort(F.collect_set("cas")).alias("shared"))
    names = reference.select(entity_name(F.col("name")).alias("_n")).where("_n <> ''").distinct().withColumn("_hit", F.lit(True))
    out = found.join(numbers, "rw_id", "left").withColumn("_n", entity_name(F.col("name"))).join(names, "_n", "left")
    return out.withColumns({"shared": F.coalesce("shared", F.array().cast("array<string>")), "shadowed": F.col("shared").isNotNull() | F.coalesce("_hit", F.lit(False))}).drop("_n", "_hit")


def json_value(infos: Column, keywords: list[str]) -> Column:
    """The first value among array<struct<name, number, text>> whose name holds a keyword and that has a value."""
    wanted = F.filter(infos, lambda i: F.rlike(F.lower(i["name"]), F.lit("|".join(re.escape(k.lower()) for k in keywords))) & (i["number"].isNotNull() | i["text"].isNotNull()))
    first = F.get(wanted, F.lit(0))
    return F.coalesce(first["number"].cast("string"), first["text"])


def cache_key(method: Column, url: Column, params: Column) -> Column:
    """Digest of a request: method, address, and parameters (a map) in order."""
    parts = F.array_sort(F.transform(F.map_entries(params), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return F.sha2(F.concat_ws(" | ", F.upper(method), url, F.array_join(parts, "&")), 256)


def missing_requests(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """Requests (method, url, params) with their key that the cache (cache_key) does not hold, each once."""
    keyed = requests.withColumn("cache_key", cache_key(F.col("method"), F.col("url"), F.col("params")))
    return keyed.join(cache.select("cache_key").distinct(), "cache_key", "left_anti").dropDuplicates(["cache_key"])


def discover_until_empty(pages: DataFrame, reference: DataFrame, start: int, width: int, empty: int = 2) -> tuple[DataFrame, int]:
    """(routes of the pages from `start` on, first id not looked at): windows of ids until `empty` in a row have no candidate.

    What comes to the driver is one count per window.
    """
    at, nothing, found = start, 0, None
    last = pages.agg(F.max("page_id")).first()[0]
    while nothing < empty and last is not None and at <= last:
        window = discover(pages.where((F.col("page_id") >= at) & (F.col("page_id") < at + width)), reference)
        nothing = 0 if window.where("route = 'candidate'").limit(1).count() else nothing + 1
        at += width
    found = discover(pages.where((F.col("page_id") >= start) & (F.col("page_id") < at)), reference)
    return found, at
