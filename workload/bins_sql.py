"""SQL for quantile bins, written independently of the library: window ranks and list functions."""

from __future__ import annotations


def levels_sql(q: int) -> str:
    rows = [f"({i}, {((i * (1 / q)) * 100 / 100)!r}::DOUBLE)" for i in range(q)] + [f"({q}, 1e0)"]
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") AS levels(i, p)"


def edges_ctes(values: str, q: int) -> str:
    """CTEs ``v`` (request, scale, unit, x, ...), ``quantiles`` and ``edges`` (request, scale, edges)."""
    return f"""
v AS ({values}),
ranked AS (
  SELECT request, scale, x, row_number() OVER (PARTITION BY request, scale ORDER BY x) - 1 AS place,
         count(*) OVER (PARTITION BY request, scale) AS n
  FROM v WHERE x IS NOT NULL),
targets AS (
  SELECT request, scale, n, i, p * (n - 1)::DOUBLE AS r
  FROM (SELECT DISTINCT request, scale, n FROM ranked) CROSS JOIN ({levels_sql(q)})),
sought AS (
  SELECT request, scale, i, r, unnest([0, 1]) AS side, least(floor(r)::BIGINT + unnest([0, 1]), n - 1) AS place
  FROM targets),
corners AS (
  SELECT s.request, s.scale, s.i, max(x) FILTER (side = 0) AS a, max(x) FILTER (side = 1) AS b, s.r - floor(s.r) AS f
  FROM sought s JOIN ranked k ON k.request = s.request AND k.scale = s.scale AND k.place = s.place
  GROUP BY s.request, s.scale, s.i, s.r),
quantiles AS (
  SELECT request, scale, i, CASE WHEN f < 0.5e0 THEN a + (b - a) * f ELSE b - (b - a) * (1e0 - f) END AS edge
  FROM corners),
edges AS (
  SELECT request, scale, list_sort(list_distinct(list(edge))) AS edges FROM quantiles GROUP BY request, scale)"""


def _rounded(value: str, decimals: str) -> str:
    digits = f"CASE WHEN abs({value}) >= 1 THEN {decimals} ELSE -floor(log10(abs({value}))) - 1 + {decimals} END"
    power = f"pow(10e0, ({digits})::DOUBLE)"
    return f"CASE WHEN {value} = 0 THEN {value} ELSE round_even({value} * {power}, 0) / {power} END"


def bins_ctes(values: str, q: int) -> str:
    """Also ``members`` (v with bin) and ``grid`` (request, scale, bin, lower, upper, interval).

    ``values`` must give request, scale, as_percent, unit, x.
    """
    percent = "round_even({0} * 100e0 * 10e0, 0) / 10e0"
    return f"""{edges_ctes(values, q)},
members AS (
  SELECT v.*, coalesce(len(e.edges), 1) - 1 AS k,
         CASE WHEN x IS NULL OR coalesce(len(e.edges), 1) = 1 THEN coalesce(len(e.edges), 1)
              ELSE greatest(1, len(list_filter(e.edges, lambda edge: edge < x))) END AS bin
  FROM v LEFT JOIN edges e ON e.request = v.request AND e.scale = v.scale),
spread AS (SELECT request, scale, edges, len(edges) AS size, unnest(edges) AS edge FROM edges),
tried AS (
  SELECT request, scale, size, d, count(DISTINCT {_rounded("edge", "d")}) AS kept
  FROM spread CROSS JOIN (SELECT unnest(range(3, 20)) AS d) GROUP BY request, scale, size, d),
decimals AS (
  SELECT request, scale, coalesce(min(d) FILTER (kept = size), 3) AS d FROM tried GROUP BY request, scale),
sides AS (
  SELECT e.request, e.scale, d, unnest(range(1, len(edges))) AS bin, edges
  FROM edges e JOIN decimals USING (request, scale)),
pairs AS (SELECT request, scale, d, bin, edges[bin] AS lower, edges[bin + 1] AS upper FROM sides),
shown AS (
  SELECT request, scale, bin, lower, upper,
         {_rounded("lower", "d")} - CASE WHEN bin = 1 THEN pow(10e0, -d::DOUBLE) ELSE 0e0 END AS low,
         {_rounded("upper", "d")} AS high
  FROM pairs),
grid AS (
  SELECT s.request, s.scale, bin, lower, upper,
         CASE WHEN as_percent THEN ({percent.format("low")})::VARCHAR || '%:' || ({percent.format("high")})::VARCHAR || '%'
              ELSE low::VARCHAR || ':' || high::VARCHAR END AS interval_text
  FROM shown s JOIN (SELECT DISTINCT request, scale, as_percent FROM v) USING (request, scale)),
described AS (
  SELECT request, scale, bin, interval_text FROM grid
  UNION ALL
  SELECT DISTINCT request, scale, bin, 'Sin clasificar' FROM members WHERE bin = k + 1 ),
listed AS (
  SELECT request, scale, bin, string_agg(unit, ',' ORDER BY unit) AS units FROM members GROUP BY request, scale, bin),
bins AS (
  SELECT d.request, d.scale, d.bin, interval_text, '{{' || coalesce(units, '') || '}}' AS cells
  FROM described d LEFT JOIN listed l ON l.request = d.request AND l.scale = d.scale AND l.bin = d.bin)"""


def values_sql(tables: dict[str, str], requests: list[tuple[str | None, str]], present: dict[str, set[str]] | None = None) -> str:
    """request, scale, as_percent, unit, x of every request in every scale that has its columns."""
    parts = []
    for scale, sql in tables.items():
        for number, (base, code) in enumerate(requests):
            if present is not None and not {code, *([base] if base else [])} <= present[scale]:
                continue
            x = f'"{code}"::DOUBLE' + (f' / nullif("{base}"::DOUBLE, 0)' if base else "")
            parts.append(
                f"SELECT {number} AS request, '{scale}' AS scale, {'true' if base else 'false'} AS as_percent, "
                f"unidad AS unit, {x} AS x FROM {sql}"
            )
    return " UNION ALL ".join(parts)


def bin_table_sql(
    with_tables: dict[str, str], requests: list[tuple[str | None, str]], q: int, names: str,
    present: dict[str, set[str]] | None = None, keep_request: bool = False,
) -> str:
    """Whole bin table, one interval and one cells column per scale; no bin of these tables needs a second part."""
    aliases = {scale: f"wide_{scale}" for scale in with_tables}
    wides = ", ".join(f"{aliases[s]} AS MATERIALIZED ({sql})" for s, sql in with_tables.items())
    asked = "VALUES " + ", ".join(f"({n}, {repr(b) if b else 'NULL::VARCHAR'}, '{c}')" for n, (b, c) in enumerate(requests))
    columns = ", ".join(
        f"max(interval_text) FILTER (scale = '{s}') AS interval_{s}, max(cells) FILTER (scale = '{s}') AS cells_{s}"
        for s in with_tables
    )
    outer = ", ".join(f"interval_{s}, cells_{s}" for s in with_tables)
    extra = "b.request, base, " if keep_request else ""
    return f"""
WITH {wides}, {bins_ctes(values_sql(aliases, requests, present), q)},
asked AS (SELECT * FROM ({asked}) AS t(request, base, code)),
named AS (SELECT * FROM ({names}) AS t(code, name)),
aligned AS (SELECT request, bin, {columns} FROM bins GROUP BY request, bin)
SELECT {extra}name, asked.code AS code, bin, 0::BIGINT AS part, {outer}
FROM aligned b JOIN asked ON asked.request = b.request JOIN named ON named.code = asked.code
"""
