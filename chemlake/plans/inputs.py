"""Inputs of the registered queries, derived from the driver's tables by SQL that Spark and DuckDB both take.

{table} stands for a table; Spark gets the DataFrame there, DuckDB the view of that name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chemlake.operators.spread import spread


def _digit_sum(body: str) -> str:
    return " + ".join(f"(CAST(floor({body} / {10**i}) AS BIGINT) % 10) * {i + 1}" for i in range(10))


def number(key: str) -> str:
    """A valid CAS number made of a key."""
    body = f"(({key} + 50) * 100 + {key} % 100)"
    return f"(CAST({key} + 50 AS STRING) || '-' || lpad(CAST({key} % 100 AS STRING), 2, '0') || '-' || CAST(({_digit_sum(body)}) % 10 AS STRING))"


def inchikey(key: str) -> str:
    """A well-formed InChIKey made of a key."""
    letters = f"upper(translate(md5(CAST({key} AS STRING)), '0123456789', 'ghijklmnop'))"
    return f"(substr({letters}, 1, 14) || '-' || substr({letters}, 15, 10) || '-' || substr({letters}, 25, 1))"


#: part with its valid number and that of the next key.
_PART = f"""(SELECT p_partkey, CAST(p_brand AS STRING) AS p_brand, CAST(p_name AS STRING) AS p_name, CAST(p_partkey + 50 AS STRING) AS head, {number("p_partkey")} AS num, {number("(p_partkey + 1)")} AS nxt FROM {{part}})"""
_SPOILT = f"""(SELECT p_partkey, p_brand, p_name, nxt, CASE p_partkey % 7 WHEN 0 THEN num WHEN 1 THEN substr(head, 2, 1) || substr(head, 1, 1) || substr(num, 3)
    WHEN 2 THEN substr(num, 1, length(num) - 2) WHEN 3 THEN replace(num, '-', '') WHEN 4 THEN substr(num, 1, length(num) - 1) || '0' || substr(num, length(num))
    WHEN 5 THEN '0-00-0' ELSE CASE p_partkey % 3 WHEN 0 THEN substr(head, 2, 1) || substr(head, 1, 1) || substr(num, 3, length(num) - 3) || '0' || substr(num, length(num))
    WHEN 1 THEN translate(substr(num, 1, 1), '123456789', '456789876') || substr(num, 2) ELSE p_brand END END AS dirty FROM {_PART} q)"""

#: Customer cells: row, cas, code, name.
CELLS = f"""SELECT p_partkey AS row, CASE p_partkey % 3 WHEN 0 THEN dirty WHEN 1 THEN dirty || ' / ' || nxt ELSE dirty || ';0-00-0' END AS cas, p_brand AS code, p_name AS name FROM {_SPOILT} r"""

#: Single raw numbers: key, raw.
RAW = f"""SELECT p_partkey AS key, CASE WHEN p_partkey % 11 = 0 THEN '00' || dirty WHEN p_partkey % 11 = 1 THEN ' ' || dirty || ' ' ELSE dirty END AS raw FROM {_SPOILT} r"""

_STATUS = "CASE o_orderkey % 9 WHEN 0 THEN 'invalid' WHEN 1 THEN 'mixture' WHEN 2 THEN 'strange' ELSE 'valid' END"
#: Registry rows to merge: _row, the registry's columns.
INCOMING = f"""SELECT o_orderkey AS _row, CAST(o_orderkey AS STRING) AS cas_input,
    CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE {number("(o_custkey % 97)")} END AS cas_number_normalized, {_STATUS} AS cas_status,
    CASE WHEN o_orderkey % 9 = 1 THEN '' ELSE {inchikey("(o_custkey % 97 + CASE WHEN o_orderkey % 31 = 0 THEN 1000 ELSE 0 END)")} END AS inchi_key,
    CASE WHEN o_orderkey % 4 = 0 THEN 'InChI=' || CAST(o_orderkey % 5 AS STRING) ELSE '' END AS inchi, '' AS smiles,
    CASE WHEN o_orderkey % 2 = 0 THEN 'pubchem' ELSE 'cactus' END AS resolver_source, CAST(o_orderkey % 101 AS DOUBLE) / 100 AS resolver_confidence,
    '2024-01-' || lpad(CAST(o_orderkey % 28 + 1 AS STRING), 2, '0') AS resolution_timestamp_utc, 'e' || CAST(o_orderkey % 3 AS STRING) AS evidence,
    CASE WHEN o_orderkey % 5 = 0 THEN 'n' || CAST(o_orderkey % 4 AS STRING) ELSE '' END AS notes, CASE WHEN o_orderkey % 9 = 1 THEN 'kind ' || CAST(o_orderkey % 2 AS STRING) ELSE '' END AS mixture_type
    FROM {{orders}}"""
#: Registry rows that are there before.
KNOWN = f"""SELECT CAST(s_suppkey AS STRING) AS cas_input, {number("s_suppkey")} AS cas_number_normalized, CASE s_suppkey % 7 WHEN 1 THEN 'ambiguous' WHEN 2 THEN 'mixture' WHEN 3 THEN 'uvcb' ELSE 'valid' END AS cas_status,
    CASE WHEN s_suppkey % 7 = 2 OR s_suppkey % 11 = 0 THEN '' ELSE {inchikey("s_suppkey")} END AS inchi_key,
    CASE WHEN s_suppkey % 2 = 0 THEN 'InChI=known' ELSE '' END AS inchi, 'CCO' AS smiles, 'table' AS resolver_source, CAST(0.5 AS DOUBLE) AS resolver_confidence,
    '2024-01-15' AS resolution_timestamp_utc, 'seed' AS evidence, '' AS notes, '' AS mixture_type FROM {{supplier}}"""

#: Property rows: _row, key (some invalid, some twice), and columns of several tools.
PROPERTIES = f"""SELECT c_custkey AS _row, CASE WHEN c_custkey % 17 = 0 THEN 'bad' ELSE {inchikey("(c_custkey % 300)")} END AS inchi_key,
    CASE WHEN c_custkey % 3 = 0 THEN CAST(NULL AS STRING) ELSE 'InChI=' || CAST(c_custkey AS STRING) END AS inchi, CASE WHEN c_custkey % 4 = 0 THEN CAST(NULL AS STRING) ELSE c_mktsegment END AS smiles,
    CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END AS computed_mw, CASE WHEN c_custkey % 7 = 0 THEN CAST(0.0 AS DOUBLE) END AS experimental_logp, CAST(c_custkey % 3 AS INT) AS alcohol_count FROM {{customer}}"""

#: Rows of a few keys, with times of which some are equal, missing or no times.
REPEATED = f"""SELECT c_custkey AS _row, {inchikey("(c_custkey % 40)")} AS inchi_key, CASE WHEN c_custkey % 3 > 0 THEN c_name END AS name_preferred, CASE WHEN c_custkey % 5 = 0 THEN c_acctbal END AS computed_mw, CASE WHEN c_custkey % 7 < 3 THEN c_mktsegment END AS smiles,
    CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'soon' ELSE '2024-03-' || lpad(CAST(c_custkey % 4 + 1 AS STRING), 2, '0') END AS timestamp_updated, 'x' AS my_inchi, 'y' AS "InChIKey2", 'z' AS final_inchi FROM {{customer}}"""

#: What customers have seen: customer_id, cas_number_normalized, timestamp_seen_utc, code, name, cas_validity.
SEEN = f"""SELECT 'c' || CAST(o_custkey % 11 AS STRING) AS customer_id, {number("(o_orderkey % 211)")} AS cas_number_normalized, CAST(o_orderdate AS STRING) AS timestamp_seen_utc,
    CAST(o_orderkey AS STRING) AS code, o_orderpriority AS name, CASE WHEN o_orderkey % 6 = 0 THEN 'invalid (original: x)' ELSE 'valid' END AS cas_validity FROM {{orders}}"""

#: Values with units: key, value texts, weight.
MEASURED = """SELECT l_orderkey * 8 + l_linenumber AS key, CAST(CAST(l_quantity AS INT) AS STRING) || CASE l_partkey % 10 WHEN 0 THEN '' WHEN 1 THEN ' Pa' WHEN 2 THEN ' kPa' WHEN 3 THEN ' bar' WHEN 4 THEN ' mmHg'
    WHEN 5 THEN ' furlong' WHEN 6 THEN ' atm' WHEN 7 THEN ' torr' WHEN 8 THEN ' mbar' ELSE ' MPa' END AS pressure,
    CAST(CAST(l_quantity AS INT) AS STRING) || CASE l_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN ' K' WHEN 2 THEN ' F' WHEN 3 THEN ' C' ELSE ' X' END AS temperature,
    CAST(CAST(l_quantity AS INT) AS STRING) || CASE l_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN ' g/mL' WHEN 2 THEN ' kg/m3' WHEN 3 THEN ' mg/mL' ELSE ' stone' END AS density,
    CAST(CAST(l_quantity AS INT) AS STRING) || CASE l_partkey % 7 WHEN 0 THEN '' WHEN 1 THEN ' g/L' WHEN 2 THEN ' ppm' WHEN 3 THEN ' mol/L' WHEN 4 THEN ' mM' WHEN 5 THEN ' ug/mL' ELSE ' cup' END AS solubility,
    CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE l_extendedprice / 100 END AS weight FROM {lineitem}"""

#: Wide property rows: what the canonical row is made of.
WIDE = f"""SELECT p_partkey AS _row, CASE WHEN p_partkey % 19 = 0 THEN '' ELSE {inchikey("(p_partkey % 400)")} END AS final_inchikey, {number("p_partkey")} AS "CAS_ID", p_name AS normalized_input,
    CASE WHEN p_partkey % 2 = 0 THEN 'name' ELSE 'cas' END AS identifier_type, CAST(p_size AS STRING) AS final_mw, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS STRING) END AS final_logp, '2.5' AS final_clogp,
    CAST(p_size AS STRING) || CASE WHEN p_partkey % 2 = 0 THEN ' kPa' ELSE ' ell' END AS final_vapor_pressure_pa, CAST(p_size AS STRING) || ' K' AS final_boiling_point_c, '0.9' AS final_density_g_ml,
    CASE WHEN p_partkey % 2 = 0 THEN '25.5' ELSE '20' END AS experimental_density_g_ml_temperature_c, CASE p_partkey % 3 WHEN 0 THEN '25' WHEN 1 THEN '' ELSE '37' END AS experimental_vapor_pressure_pa_temperature_c, CASE WHEN p_partkey % 4 = 0 THEN 'pubchem' ELSE 'computed' END AS source_mw,
    CASE WHEN p_partkey % 5 = 0 THEN 'PubChem' ELSE 'fallback' END AS source_density_g_ml, 'pubchem' AS source_logp, 'computed' AS source_clogp,
    '2024-02-' || lpad(CAST(p_partkey % 28 + 1 AS STRING), 2, '0') AS timestamp FROM {{part}}"""


#: Pages with numbers, "Page x of y" and names of groups.
PAGES = f"""SELECT page_id, replace(html, '<title>', CASE WHEN page_id % 6 = 0 THEN '<title>Family of ' ELSE '<title>' END) || CASE page_id % 4 WHEN 0 THEN '' WHEN 1 THEN ' <p>CAS ' || {number("(page_id % 60)")} || ', ' || {number("(page_id % 7)")} || '</p>'
    ELSE ' <p>0' || {number("(page_id % 60)")} || ' and ' || {number("(page_id % 60)")} || '. page 2  of ' || CAST(page_id % 9 + 2 AS STRING) || '</p>' END AS html FROM {{pages}}"""

#: Cells of SMILES: two chains, one of them with oxygen at its end, salts, unreadable parts, references and what stands for nothing.
SMILES = """SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN repeat('C', CAST(p_partkey % 9 + 1 AS INT)) || '.' || repeat('C', p_size % 9 + 1) || 'O' WHEN 1 THEN '[Na+].' || repeat('C', CAST(p_partkey % 9 + 1 AS INT)) || '.[Cl-]'
    WHEN 2 THEN 'OS(=O)(=O)O.[Cu].no_smiles_at_all' WHEN 3 THEN ' ' || repeat('C', p_size % 9 + 1) || '&#46;O' || chr(10) WHEN 4 THEN CASE p_partkey % 4 WHEN 0 THEN '&nbsp;' ELSE 'nbsp' END
    ELSE 'bad_' || repeat('x', p_size % 9) || '.' || repeat('y', CAST(p_partkey % 9 + 1 AS INT)) || '_z' END AS raw FROM {part}"""

#: A provider's answers: entries at two depths of sections and at fourteen, with numbers, lists of them, texts and marked-up texts; some of the second shape.
ANSWERS = """SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN translate('<"Fault":1>', '<>', chr(123) || chr(125))
WHEN p_partkey % 10 = 1 THEN translate('<"PC_Compounds":[<"Section":[<"Section":[<"Information":[<"Name":"Melting Point","Value":<"String":"' || CAST(p_size AS STRING) || ' C">>]>]>]>]>', '<>', chr(123) || chr(125)) ELSE translate('<"Record":<"Section":[<"Information":[<"Name":"Other">,<"Name":"Boiling Point","Value":<"Number":[' || CAST(p_size + 300 AS STRING) || ',1],"Unit":"K">>],
"Section":[<"Information":[<"Name":"Boiling Point","Value":<"Number":1,"Unit":"C">>,<"Name":"Vapor Pressure","Value":<"Number":' || CAST(p_size AS STRING) || ',"Unit":"' || CASE p_partkey % 3 WHEN 0 THEN 'kPa' WHEN 1 THEN 'mmHg' ELSE 'ell' END || '">>]>,
<"Information":[<"Name":"Density","Value":<"String":"' || CAST(p_size % 9 AS STRING) || '">>,<"Name":"Refractive Index","Value":<"StringWithMarkup":[<"String":"1.4' || CAST(p_size % 9 AS STRING) || ' at 20 C">]>>,<"Name":"XLogP (log P)","Value":<"Number":' || CAST(p_size AS STRING) || '.5>>]>,' || repeat('<"Section":[', 12)
|| '<"Information":[<"Name":"Aqueous Solubility","Value":<"Number":[null,"n",' || CAST(p_size AS STRING) || '],"Unit":"' || CASE p_partkey % 3 WHEN 0 THEN 'mg/L' WHEN 1 THEN 'g/L' ELSE 'cup' END || '">>,<"Name":"Heat of Vaporization","Value":<"Number":' || CAST(p_size AS STRING)
|| ',"Unit":"' || CASE p_partkey % 3 WHEN 0 THEN 'kJ/mol' WHEN 1 THEN 'kcal/mol' ELSE 'J' END || '">>]>' || repeat(']>', 12) || ']>]>>', '<>', chr(123) || chr(125)) END AS answer FROM {part}"""


def spark_sql(text: str) -> str:
    return text.replace('"CAS_ID"', "CAS_ID").replace('"InChIKey2"', "InChIKey2")


def derive(spark: SparkSession, sf_dir: str, text: str, heavy: bool = False) -> DataFrame:
    """A derived input as a DataFrame; heavy: rows that much is made of, dealt to all cores however few files they come in."""
    names = [t for t in ("part", "orders", "supplier", "customer", "lineitem", "events", "pages", "documents") if "{" + t + "}" in text]
    read = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    return spark.sql(spark_sql(text), **{n: spread(read(n)) if heavy else read(n) for n in names})


def duck(text: str) -> str:
    """The same text for DuckDB."""
    for n in ("part", "orders", "supplier", "customer", "lineitem", "events", "pages", "documents"):
        text = text.replace("{" + n + "}", n)
    return text
