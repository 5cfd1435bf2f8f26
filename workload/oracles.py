"""SQL over the given tables that must give the rows of the query of the same name."""

from __future__ import annotations

from workload.bins_sql import bin_table_sql, bins_ctes, edges_ctes, values_sql
from workload.tables import CLEAN_SQL, MICRODATA_SQL, NAMES, TOTAL, names_sql, units_sql

ORACLES: dict[str, str] = {}

CATEGORY_VALUES = {
    "estado": ["F", "O", "p"],
    "prioridad": ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"],
    "segmento": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
}
DICTIONARY = [
    ("estado-F", "Estado-Final "),
    ("estado-O", "Estado-Abierto"),
    ("estado-p", "Estado-L''curso"),
    ("prioridad-1-URGENT", "Prioridad-1"),
    ("prioridad-2-HIGH", "Prioridad-2"),
    ("prioridad-3-MEDIUM", "Prioridad-3"),
]


def melted_sql(ids: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {ids}, '{v}' AS variable, {v} AS value FROM m WHERE {v} IS NOT NULL" for v in CATEGORY_VALUES
    )


def median_sql(value: str, ids: str, source: str, name: str) -> str:
    """Middle value, or half the sum of the two middle values."""
    return f"""
SELECT {ids}, (sum(x) FILTER (place IN ((n - 1) // 2, n // 2)))
              / (count(*) FILTER (place IN ((n - 1) // 2, n // 2))) AS "{name}"
FROM (SELECT {ids}, {value} AS x, row_number() OVER (PARTITION BY {ids} ORDER BY {value}) - 1 AS place,
             count(*) OVER (PARTITION BY {ids}) AS n
      FROM {source} WHERE {value} IS NOT NULL) GROUP BY {ids}"""


KNOWN = f"m AS MATERIALIZED ({CLEAN_SQL}), known AS (SELECT * FROM m WHERE ent IS NOT NULL AND mun IS NOT NULL)"
COUNT_COLUMNS = {
    f"{v}-{value}": f"count(*) FILTER ({v} = '{value}')" for v, values in CATEGORY_VALUES.items() for value in values
}
ANY_CATEGORY = "count(estado) + count(prioridad) + count(segmento) > 0"

ORACLES["missing_texts"] = """
SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, nullif(o_orderpriority, '5-LOW') AS priority FROM orders"""

ORACLES["microdata_file_scan"] = f"""
SELECT folio, ent, mun, estado, prioridad, segmento, trim(precio) AS precio, trim(saldo) AS saldo, nota FROM (
  SELECT folio, nullif(trim(ent, ' ' || chr(9)), '') AS ent, nullif(trim(mun, ' ' || chr(9)), '') AS mun,
         nullif(trim(estado, ' ' || chr(9)), '') AS estado, nullif(trim(prioridad, ' ' || chr(9)), '') AS prioridad,
         segmento, precio, saldo, nota FROM ({MICRODATA_SQL}))"""

ORACLES["scale_file_scan"] = f"""
SELECT unidad, "{TOTAL}" AS total, "suma::o_totalprice" AS suma FROM ({units_sql("mun")})"""

ORACLES["document_metadata_scan"] = "SELECT doc_id, lang, text FROM documents"

ORACLES["blank_to_null_cells"] = f"""
SELECT folio, CASE WHEN NOT regexp_full_match(estado, '\\s*') THEN estado END AS estado,
       CASE WHEN NOT regexp_full_match(prioridad, '\\s*') THEN prioridad END AS prioridad, segmento
FROM ({MICRODATA_SQL})"""

ORACLES["strip_strings"] = f"""
SELECT folio, ent, regexp_replace(mun, '^\\s+|\\s+$', '', 'g') AS mun,
       regexp_replace(estado, '^\\s+|\\s+$', '', 'g') AS estado, trim(saldo) AS saldo FROM ({MICRODATA_SQL})"""

ORACLES["zero_pad"] = """
SELECT c_custkey, lpad(c_nationkey::VARCHAR, 3, '0') AS nation,
       CASE WHEN floor(c_acctbal) < 0 THEN '-' || lpad((-floor(c_acctbal))::BIGINT::VARCHAR, 5, '0')
            ELSE lpad(floor(c_acctbal)::BIGINT::VARCHAR, 6, '0') END AS balance,
       c_name AS name FROM customer"""

ORACLES["typed_cast"] = f"""
SELECT folio::BIGINT AS folio, estado, precio::DOUBLE AS precio, trim(saldo)::DOUBLE AS saldo FROM ({MICRODATA_SQL})"""

BLANKS = f"""
SELECT folio, ent, mun, estado, CASE WHEN NOT regexp_full_match(prioridad, '\\s*') THEN prioridad END AS prioridad,
       segmento, precio, saldo, nota FROM ({MICRODATA_SQL})"""

ORACLES["rename_alias"] = f"""
SELECT folio AS "Folio", estado AS "Estado", precio AS "Precio", nota FROM ({BLANKS})"""
ORACLES["exclude_by_class"] = f"SELECT folio, estado, prioridad, segmento FROM ({BLANKS})"
ORACLES["select_regex"] = f"SELECT folio, estado, prioridad, segmento, precio, saldo, nota FROM ({BLANKS})"
ORACLES["select_by_class"] = f"SELECT folio, estado, prioridad, segmento FROM ({BLANKS})"
ORACLES["select_combined"] = f"SELECT ent, folio, mun, precio, prioridad FROM ({BLANKS})"

ORACLES["total_count"] = f"WITH {KNOWN} SELECT ent, mun, count(*) AS total FROM known GROUP BY ent, mun"
ORACLES["melt_categories"] = f"WITH {KNOWN} {melted_sql('folio')}"
ORACLES["categorical_counts_long"] = f"""
WITH {KNOWN} SELECT ent, mun, variable, value, count(*) AS n FROM ({melted_sql("ent, mun")})
WHERE ent IS NOT NULL AND mun IS NOT NULL GROUP BY ent, mun, variable, value"""
ORACLES["categorical_counts_wide"] = f"""
WITH {KNOWN} SELECT ent, mun, {", ".join(f'{sql} AS "{code}"' for code, sql in COUNT_COLUMNS.items())}
FROM known GROUP BY ent, mun HAVING {ANY_CATEGORY}"""
ORACLES["observed_domain"] = f"""
WITH {KNOWN} SELECT DISTINCT variable, value FROM ({melted_sql("ent, mun")})
WHERE ent IS NOT NULL AND mun IS NOT NULL"""
def exact_sum_sql(value: str, bits: int = 64) -> str:
    """Sum of doubles as integers of 128 bits, rounded once: exact for multiples of 2 ** -bits."""
    return f"sum(({value} * {float(2**bits)!r})::HUGEINT)::DOUBLE / {float(2**bits)!r}"


ORACLES["numeric_sum"] = f"""
WITH {KNOWN} SELECT ent, mun, coalesce({exact_sum_sql("precio")}, 0) AS "suma::precio",
       coalesce({exact_sum_sql("saldo")}, 0) AS "suma::saldo" FROM known GROUP BY ent, mun"""
ORACLES["integer_sum"] = """
SELECT l_returnflag, l_linestatus, sum(l_suppkey)::BIGINT AS "suma::l_suppkey", sum(l_linenumber)::BIGINT AS "suma::l_linenumber",
       sum(l_orderkey * 1000000007::BIGINT + l_partkey)::BIGINT AS "suma::texto"
FROM lineitem GROUP BY l_returnflag, l_linestatus"""
ORACLES["numeric_mean"] = f"""
WITH {KNOWN} SELECT ent, mun, {exact_sum_sql("precio")} / count(precio) AS "media::precio",
       {exact_sum_sql("saldo")} / count(saldo) AS "media::saldo" FROM known GROUP BY ent, mun"""
SIGNED = "CASE WHEN l_suppkey % 2 = 0 THEN l_extendedprice ELSE -l_extendedprice END"
BIG = "l_orderkey * 1000000007::BIGINT + l_partkey"
ORACLES["numeric_long_exact"] = f"""
SELECT l_returnflag, l_linestatus, 'suma::entero' AS code, sum({BIG})::BIGINT::DOUBLE AS value, sum({BIG})::BIGINT AS whole
FROM lineitem GROUP BY l_returnflag, l_linestatus
UNION ALL SELECT l_returnflag, l_linestatus, 'suma::saldo', {exact_sum_sql(SIGNED)}, NULL FROM lineitem GROUP BY l_returnflag, l_linestatus"""
APART = "CASE l_linenumber % 3 WHEN 0 THEN 1e20 WHEN 1 THEN 1e0 ELSE 1e-20 END"
# The largest terms are multiples of 1 and decide the sum down to its last bit, far above 2 ** -20.
ORACLES["numeric_sum_spread"] = f"""
SELECT l_returnflag, count(*) AS "{TOTAL}", {exact_sum_sql(SIGNED)} AS "suma::saldo",
       {exact_sum_sql(f"l_discount * {APART}", 20)} AS "suma::disperso", {exact_sum_sql(SIGNED)} / count(*) AS "media::saldo",
       sum({BIG})::DOUBLE / count(*) AS "media::entero"
FROM lineitem GROUP BY l_returnflag"""

MEDIANS = f"""
places AS (SELECT DISTINCT ent, mun FROM known),
mp AS ({median_sql("precio", "ent, mun", "known", "mediana::precio")}),
ms AS ({median_sql("saldo", "ent, mun", "known", "mediana::saldo")})"""
ORACLES["numeric_median"] = f"""
WITH {KNOWN}, {MEDIANS}
SELECT ent, mun, "mediana::precio", "mediana::saldo"
FROM places LEFT JOIN mp USING (ent, mun) LEFT JOIN ms USING (ent, mun)"""
ORACLES["numeric_median_few_groups"] = median_sql("l_extendedprice", "l_returnflag", "lineitem", "median")
ORACLES["numeric_long"] = f"""
WITH {KNOWN}, {MEDIANS}
SELECT ent, mun, 'mediana::precio' AS code, "mediana::precio" AS value FROM mp
UNION ALL SELECT ent, mun, 'mediana::saldo', "mediana::saldo" FROM ms"""
ORACLES["numeric_gate"] = f"""
WITH m AS ({CLEAN_SQL}), c AS (
  SELECT 'precio' AS variable, count(*) FILTER (precio IS NULL AND false) AS rejected FROM m
  UNION ALL SELECT 'saldo', 0
  UNION ALL SELECT 'nota', count(*) FILTER (NOT regexp_full_match(nota, '[+-]?[0-9]+(\\.[0-9]*)?')) FROM m
  UNION ALL SELECT 'estado', count(estado) FROM m)
SELECT variable, rejected::BIGINT AS rejected, rejected = 0 AS passes FROM c"""

WIDE = f"""
{KNOWN}, {MEDIANS},
counts AS (SELECT ent, mun, count(*) AS "{TOTAL}",
                  {", ".join(f'{sql} AS "{code}"' for code, sql in COUNT_COLUMNS.items())}
           FROM known GROUP BY ent, mun HAVING {ANY_CATEGORY}),
means AS (SELECT ent, mun, {exact_sum_sql("precio")} / count(precio) AS "media::precio" FROM known GROUP BY ent, mun),
wide AS (SELECT counts.*, "media::precio", "mediana::precio"
         FROM counts LEFT JOIN means USING (ent, mun) LEFT JOIN mp USING (ent, mun))"""
WIDE_CODES = [TOTAL, *COUNT_COLUMNS, "media::precio", "mediana::precio"]
ORACLES["joined_aggregates"] = f"WITH {WIDE} SELECT * FROM wide"
ORACLES["joined_aggregates_long"] = f"WITH {WIDE} " + " UNION ALL ".join(
    f"SELECT ent, mun, '{c}' AS code, \"{c}\"::DOUBLE AS value FROM wide WHERE \"{c}\" IS NOT NULL" for c in WIDE_CODES
)

ORACLES["aggregates_long"] = f"WITH {WIDE} " + " UNION ALL ".join(
    f"SELECT ent, mun, '{c}' AS code, \"{c}\"::DOUBLE AS value FROM wide WHERE \"{c}\" "
    + ("<> 0" if c in COUNT_COLUMNS else "IS NOT NULL")
    for c in WIDE_CODES
)

ORACLES["ratio"] = f"""
SELECT unidad, "o_orderstatus-F"::DOUBLE / nullif("o_orderstatus-O"::DOUBLE, 0) AS value FROM ({units_sql("cus")})"""

ORACLES["quantile_edges"] = f"""
WITH {edges_ctes("SELECT o_orderpriority AS request, 'all' AS scale, o_totalprice AS x FROM orders", 10)}
SELECT request AS o_orderpriority, (row_number() OVER (PARTITION BY request ORDER BY edge) - 1)::INTEGER AS i, edge
FROM (SELECT DISTINCT request, edge FROM quantiles)"""

URGENT = values_sql({"cus": "wide"}, [(None, "max::urgente")])
ORACLES["quantile_bins"] = f"""
WITH wide AS ({units_sql("cus")}), {bins_ctes(URGENT, 10)}
SELECT m.unit AS unidad, m.x AS value, m.bin::INTEGER AS bin, g.interval_text AS "interval"
FROM members m LEFT JOIN grid g ON g.request = m.request AND g.scale = m.scale AND g.bin = m.bin"""

FREQUENCY_CODES = ["o_orderstatus-F", TOTAL, "max::c_acctbal"]
FREQUENCY = [(b, c) for b in (TOTAL, None) for c in FREQUENCY_CODES]
ORACLES["bin_frequencies"] = f"""
WITH wide AS ({units_sql("cus")}), {bins_ctes(values_sql({"cus": "wide"}, FREQUENCY), 20)},
asked AS (SELECT * FROM (VALUES {", ".join(f"({n}, '{c}')" for n, (_, c) in enumerate(FREQUENCY))}) AS t(request, code))
SELECT d.request, code, d.bin::INTEGER AS bin, count(m.unit) AS units
FROM described d JOIN asked USING (request)
LEFT JOIN members m ON m.request = d.request AND m.scale = d.scale AND m.bin = d.bin
GROUP BY d.request, code, d.bin"""


def labels_sql(x: str, as_percent: str) -> str:
    values = f"SELECT l_linenumber AS request, 'all' AS scale, {as_percent} AS as_percent, '' AS unit, {x} AS x FROM lineitem"
    return f"""
WITH {bins_ctes(values, 7)}
SELECT request AS line, bin::INTEGER AS bin, lower AS "left", upper AS "right", interval_text AS "interval" FROM grid"""


ORACLES["interval_labels"] = labels_sql("l_extendedprice * l_discount", "false")
ORACLES["percent_labels"] = labels_sql("l_tax / l_quantity", "true")
ORACLES["number_texts"] = """
SELECT l_orderkey, l_linenumber, (l_discount / 4096e0)::VARCHAR AS small, (l_extendedprice * 128e0)::VARCHAR AS large,
       (round_even((l_tax - l_discount) * 100e0 * 10e0, 0) / 10e0)::VARCHAR AS share,
       (l_extendedprice * 1e14 / 7e0)::VARCHAR AS huge, ((l_tax + l_quantity) * 1e-320)::VARCHAR AS tiny FROM lineitem"""

ORACLES["cells_per_bin"] = bin_table_sql({"cus": units_sql("cus")}, [(None, "max::c_acctbal")], 4, names_sql())

ORACLES["bin_parts"] = f"""
WITH wide AS ({units_sql("cus")}), {bins_ctes(values_sql({"cus": "wide"}, [(None, "max::urgente")]), 4)},
numbered AS (SELECT bin, unit, (row_number() OVER (PARTITION BY bin ORDER BY unit) - 1) // 7 AS part FROM members)
SELECT 'max::precio urgente' AS name, 'max::urgente' AS code, d.bin, coalesce(part, 0)::BIGINT AS part,
       interval_text AS interval_cus, '{{' || coalesce(string_agg(unit, ',' ORDER BY unit), '') || '}}' AS cells_cus
FROM described d LEFT JOIN numbered r ON r.bin = d.bin GROUP BY d.bin, part, interval_text"""

MEMBERS = [(None, "max::urgente"), (TOTAL, "o_orderstatus-P")]
ORACLES["bin_members"] = f"""
WITH wide_cus AS ({units_sql("cus")}), wide_mun AS ({units_sql("mun")}),
{bins_ctes(values_sql({"cus": "wide_cus", "mun": "wide_mun"}, MEMBERS), 5)},
asked AS (SELECT * FROM (VALUES (0, NULL::VARCHAR, 'max::urgente'), (1, '{TOTAL}', 'o_orderstatus-P')) AS t(request, base, code)),
named AS (SELECT * FROM ({names_sql()}) AS t(code, name))
SELECT base, name, code, m.scale, m.bin::INTEGER AS bin, interval_text AS "interval", m.unit AS unidad, m.x AS value
FROM members m JOIN asked ON asked.request = m.request JOIN named USING (code)
LEFT JOIN described d ON d.request = m.request AND d.scale = m.scale AND d.bin = m.bin"""


def cus_table_sql(requests: list[tuple[str | None, str]], q: int, keep_request: bool = False) -> str:
    return bin_table_sql({"cus": units_sql("cus")}, requests, q, names_sql(), keep_request=keep_request)


ORACLES["process_variable"] = cus_table_sql([(TOTAL, "suma::o_totalprice")], 10)
ORACLES["process_list"] = cus_table_sql(
    [(TOTAL, "o_orderstatus-F"), (TOTAL, "o_orderstatus-O"), (None, TOTAL), (None, "max::urgente")], 10, True
)
ORACLES["process_regex"] = cus_table_sql([(None, code) for code in sorted(dict(NAMES))], 10)
ORACLES["process_multiscale"] = bin_table_sql(
    {level: units_sql(level) for level in ("cus", "mun", "ent")},
    [(None, "max::urgente"), (None, "fijo"), (TOTAL, "o_orderstatus-O")],
    6,
    names_sql(),
)
ORACLES["long_scale_bins"] = ORACLES["process_regex"]
ORACLES["long_scale_shares"] = ORACLES["process_multiscale"]
ORACLES["long_scale_counts"] = ORACLES["bin_frequencies"]
STACKED = bin_table_sql(
    {"mun": units_sql("mun")},
    [*[(TOTAL, f"o_orderstatus-{s}") for s in "FOP"], (None, "o_orderstatus-F"), (None, "max::urgente")],
    5,
    names_sql(),
)
ORACLES["staged_load"] = bin_table_sql(
    {"mun": units_sql("mun")}, [(None, "max::urgente"), (None, "fijo"), (TOTAL, "o_orderstatus-O")], 5, names_sql()
)
ORACLES["concat_results"] = STACKED
ORACLES["bin_table_file_scan"] = STACKED
ORACLES["duplicate_bins"] = f"""
SELECT code, bin, count(*) AS rows FROM ({STACKED}) GROUP BY code, bin HAVING count(*) > 1"""

ORACLES["usable_values"] = f"WITH wide AS ({units_sql('mun')}) " + " UNION ALL ".join(
    f"SELECT unidad, '{c}' AS code, \"{c}\"::DOUBLE AS value FROM wide"
    for c in (TOTAL, "o_orderstatus-F", "o_orderstatus-O", "o_orderstatus-P", "suma::o_totalprice")
)
ORACLES["missing_in_dictionary"] = f"""
WITH {KNOWN} SELECT DISTINCT variable || '-' || value AS code FROM ({melted_sql("ent, mun")})
WHERE ent IS NOT NULL AND mun IS NOT NULL
  AND variable || '-' || value NOT IN ({", ".join(f"'{code}'" for code, _ in DICTIONARY)})"""

PART = "SELECT 'v' || p_partkey AS var, p_name, p_brand, p_size, p_type FROM part"
CATEGORICAL_PART = f"""
SELECT var || '-' || p_brand AS variable, p_name || '-L''' AS traduccion FROM ({PART}) WHERE p_size > 5
UNION ALL SELECT var || '-' || p_size, p_name || '-' || p_type || ' ' FROM ({PART}) WHERE p_size > 5"""
ORACLES["list_literals"] = f"""
SELECT var, 0 AS i, p_brand AS value FROM ({PART}) WHERE p_size > 5
UNION ALL SELECT var, 1, p_size::VARCHAR FROM ({PART}) WHERE p_size > 5
UNION ALL SELECT var, 2, 'None' FROM ({PART}) WHERE p_size > 5"""
ORACLES["literal_edge_cases"] = """
SELECT p_partkey, 0 AS i, 'a, None, ' || p_brand AS value, 'item' AS key FROM part
UNION ALL SELECT p_partkey, 1, 'True: ' || p_size || ']', 'item' FROM part
UNION ALL SELECT p_partkey, 2, p_size::VARCHAR, 'item' FROM part
UNION ALL SELECT p_partkey, 3, 'None', 'item' FROM part
UNION ALL SELECT p_partkey, 4, chr(92) || 'xe1', 'item' FROM part
UNION ALL SELECT p_partkey, 5, 'á', 'item' FROM part
UNION ALL SELECT p_partkey, 0, 'uno: None, ' || p_type, p_size::VARCHAR FROM part
UNION ALL SELECT p_partkey, 1, 'l''otro', '-1' FROM part
UNION ALL SELECT p_partkey, 2, 'False', 'k, 2: x' FROM part"""
ORACLES["dictionary_last_wins"] = """
SELECT 'v' || p_partkey AS code, CASE WHEN p_partkey % 2 = 0 THEN repeat(p_name, 5) ELSE p_name END AS name FROM part"""
ORACLES["metadata_first_wins"] = """
SELECT 'suma::v' || p_partkey AS variable, 'suma::' || p_name AS traduccion FROM part"""
ORACLES["catalog_dictionary"] = """
WITH last AS (SELECT p_brand, p_size, arg_max(CASE WHEN p_brand NOT LIKE '%1' THEN p_type ELSE p_name END, p_partkey) AS label
              FROM part GROUP BY p_brand, p_size)
SELECT 'v' || n_nationkey || '-' || p_size AS variable, n_name || '-' || label AS traduccion
FROM nation JOIN last ON upper(p_brand) = 'BRAND#' || (n_regionkey + 1) || (n_nationkey % 5 + 1)"""
ORACLES["dictionary_categorical"] = CATEGORICAL_PART
ORACLES["dictionary_file_scan"] = CATEGORICAL_PART
ORACLES["dictionary_numeric"] = f"""
SELECT 'media::' || var AS variable, 'media::' || p_name AS traduccion FROM ({PART})"""
ORACLES["dictionary_merge"] = f"""
SELECT '{TOTAL}' AS variable, '{TOTAL}' AS traduccion, 0 AS part
UNION ALL SELECT 'suma::' || var, 'suma::' || CASE WHEN contains(upper(p_name), 'RING') THEN upper(p_name) ELSE p_name END, 1
FROM ({PART})
UNION ALL SELECT variable, traduccion, 2 FROM ({CATEGORICAL_PART})"""
ORACLES["named_codes"] = f"""
WITH {KNOWN}, d AS (SELECT * FROM (VALUES {", ".join(f"('{c}', '{n}')" for c, n in DICTIONARY)}) AS t(code, name)),
c AS (SELECT ent, mun, variable || '-' || value AS code, count(*) AS n FROM ({melted_sql("ent, mun")})
      WHERE ent IS NOT NULL AND mun IS NOT NULL GROUP BY ALL)
SELECT ent, mun, code, n, name FROM c JOIN d USING (code)"""

ORACLES["catalog_lookup"] = """
WITH lists AS (
  SELECT o_custkey, '[' || string_agg('''' || o_orderkey || '''', ', ' ORDER BY o_orderkey) || ']' AS claves,
         '[' || string_agg(CASE WHEN o_custkey >= 500 THEN '''' || o_orderpriority || ''''
                                WHEN o_custkey >= 100 THEN '"' || o_orderstatus || '''s"' END,
                           ', ' ORDER BY o_orderkey) || ']' AS valores
  FROM orders GROUP BY o_custkey)
SELECT c_name AS var, 'CATALOGO CLIENTE ' || c_custkey AS fuente, coalesce(valores, '[]') AS valores,
       coalesce(claves, '[]') AS claves
FROM customer LEFT JOIN lists ON o_custkey = c_custkey"""
ORACLES["catalog_lookup_pages"] = """
WITH placed AS (SELECT *, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 7 AS page FROM orders),
lists AS (
  SELECT o_custkey, page, '[' || string_agg('''' || o_orderkey || '''', ', ' ORDER BY o_orderkey) || ']' AS claves,
         '[' || string_agg(CASE WHEN o_custkey >= 500 THEN '''' || o_orderpriority || ''''
                                WHEN o_custkey >= 100 THEN '"' || o_orderstatus || '''s"' END,
                           ', ' ORDER BY o_orderkey) || ']' AS valores
  FROM placed GROUP BY o_custkey, page)
SELECT c_name AS var, 'CATALOGO CLIENTE ' || c_custkey AS fuente, coalesce(page, 0)::BIGINT AS page,
       coalesce(valores, '[]') AS valores, coalesce(claves, '[]') AS claves
FROM customer LEFT JOIN lists ON o_custkey = c_custkey"""

ORACLES["normalize_names"] = """
SELECT p_partkey, 'Cat Arbol ' || p_name || '_' || p_brand || ' Nandu' AS source,
       'CATALOGO ' || upper(p_type) || ' CAT E' AS catalog FROM part"""
ORACLES["fold_accents"] = "SELECT doc_id, strip_accents(text) AS folded FROM documents"
ORACLES["options_to_lists"] = """
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'municipio' ELSE p_name END AS var,
       CASE WHEN p_type = 'PROMO' THEN 'options' ELSE 'abierta' END AS var_type,
       CASE WHEN p_size < 15 THEN '[]' ELSE '[''1'', ''k' || p_size || ''', ''x'']' END AS posibles_valores_alias,
       CASE WHEN p_size < 15 THEN '[]' ELSE '[''Sí'', ''' || p_type || ''', None]' END AS posibles_valores,
       'str' AS dtype, CASE WHEN p_size >= 15 THEN 'k' || p_size END AS second_option FROM part"""

REGISTRY_NAMES = [(TOTAL, TOTAL), *DICTIONARY, ("media::precio", "media::Precio"), ("mediana::precio", "mediana::Precio")]
REGISTRY_REQUESTS = [(None, code) for code, _ in REGISTRY_NAMES]
ORACLES["registry_run"] = bin_table_sql(
    {"mun": f"WITH {WIDE} SELECT ent || mun AS unidad, * FROM wide"},
    REGISTRY_REQUESTS,
    10,
    "VALUES " + ", ".join(f"('{c}', '{n}')" for c, n in REGISTRY_NAMES),
)

ORACLES["registry_files_long"] = ORACLES["registry_run"]

EVENT_NAMES = {"click": "Clic", "error": "Error", "purchase": "Compra", "view": "Vista"}
SURVEY_WIDE = f"""
WITH e AS (SELECT lpad(user_id::VARCHAR, greatest(4, length(user_id::VARCHAR))::INTEGER, '0') AS unidad, event_type, value FROM events),
md AS ({median_sql("value", "unidad", "e", "mediana::value")}),
c AS (SELECT unidad, count(*) AS "{TOTAL}", {exact_sum_sql("value")} / count(value) AS "media::value",
             {", ".join(f"count(*) FILTER (event_type = '{v}') AS \"event_type-{v}\"" for v in EVENT_NAMES)}
      FROM e GROUP BY unidad)
SELECT c.*, "mediana::value" FROM c LEFT JOIN md USING (unidad)"""
SURVEY_NAMES = [(f"event_type-{v}", f"Evento-{n}") for v, n in EVENT_NAMES.items()]
ORACLES["survey_run"] = bin_table_sql(
    {"geo": SURVEY_WIDE},
    [*[(TOTAL, code) for code, _ in SURVEY_NAMES], (None, TOTAL), (None, "media::value"), (None, "mediana::value")],
    4,
    "VALUES "
    + ", ".join(f"('{c}', '{n}')" for c, n in [*SURVEY_NAMES, (TOTAL, TOTAL), ("media::value", "media::Valor"), ("mediana::value", "mediana::Valor")]),
)
