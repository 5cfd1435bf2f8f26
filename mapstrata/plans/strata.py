"""Aggregates per scale, wide or long, to quantile bins with the units in each of them.

All requested variables of all scales are cut in one plan; nothing loops over variables.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mapstrata.functions.numbers import finite_or_fail, is_numeric_type
from mapstrata.operators import binning, cells, translate
from mapstrata.operators.columns import compiled
from mapstrata.operators.joins import joined_with_few
from mapstrata.plans.long_scale import LongScale, gathered, spread
from mapstrata.plans.spec import expect, expect_texts, load_spec, required
from mapstrata.session import case_sensitive_names, column, cut_lineage, exact_names, local_table, quoted, removed
from mapstrata.sinks.files import write_table
from mapstrata.sources import read_long_scale, read_translations, staged_scale

log = logging.getLogger(__name__)

DEFAULT_BINS = 10

@dataclass(frozen=True)
class Request:
    """Cut ``code``, divided by ``base`` unless that is None."""

    base: str | None
    code: str


class Stratifier:
    """Scale tables, names of their codes, and what must not be cut.

    A scale is a wide table, or a ``LongScale`` for any number of codes: these are never columns, so plans do not grow with
    them. Its codes and their names are on the driver, as the column names of a wide table are.
    """

    def __init__(
        self,
        scales: dict[str, DataFrame | LongScale],
        dictionary: DataFrame,
        names_column: str,
        alias_column: str,
        ids: list[str],
        excluded: list[str] | None = None,
        excluded_regex: list[str] | None = None,
        unit_counts: dict[str, int] | None = None,
    ) -> None:
        """``unit_counts``: units per scale where they are known."""
        expect(scales, dict, "scales")
        for scale, table in scales.items():
            expect(scale, str, "every key of scales")
            expect(table, (DataFrame, LongScale), "every value of scales")
        expect(dictionary, DataFrame, "dictionary")
        for name in (names_column, alias_column):
            expect(name, str, "the columns of the dictionary")
            if name not in dictionary.columns:
                raise ValueError(f"the dictionary has no column {name}")
        expect_texts(ids, "ids")
        for scale, table in scales.items():
            for name in ids:
                if name not in (table.table if isinstance(table, LongScale) else table).columns:
                    raise ValueError(f"scale {scale} has no id column {name}")
        patterns = expect_texts(excluded_regex if excluded_regex is not None else [], "excluded_regex")
        for pattern in patterns:
            compiled(pattern)

        self.scales = scales
        self.sparkSession = dictionary.sparkSession
        self.ids = ids
        self._unit_counts = dict(unit_counts or {})
        self._gathered: dict[tuple, DataFrame] = {}
        self._columns = {
            scale: [*ids, *table.codes()] if isinstance(table, LongScale) else table.columns for scale, table in scales.items()
        }
        self._present = {scale: set(names) for scale, names in self._columns.items()}
        self.names = self._names_of_columns(dictionary, alias_column, names_column)
        present = {name for names in self._columns.values() for name in names}
        self.missing_in_dictionary = sorted(present - set(self.names))
        banned = set(expect_texts(excluded if excluded is not None else [], "excluded")) | set(ids)
        for pattern in patterns:
            banned.update(name for name in present if compiled(pattern).search(name))
        self.excluded = sorted(banned | set(self.missing_in_dictionary))
        self._excluded_names = set(self.excluded)
        self._numbers = {
            scale: self._present[scale] - set(ids)
            if isinstance(table, LongScale)
            else {f.name for f in table.schema if is_numeric_type(f.dataType)}
            for scale, table in scales.items()
        }
        if self.missing_in_dictionary:
            log.warning("columns without a dictionary entry: %s", self.missing_in_dictionary)

    def _names_of_columns(self, dictionary: DataFrame, alias_column: str, names_column: str) -> dict[str, str]:
        """Names of existing columns only, so at most one entry per column reaches the driver."""
        present = sorted({name for names in self._columns.values() for name in names})
        wanted = local_table(self.sparkSession, ["code"], [(name,) for name in present])
        names = translate.last_names(dictionary, alias_column, names_column).join(F.broadcast(wanted), "code", "left_semi")
        return {row["code"]: row["name"] for row in names.collect()}

    # Checks

    def _check_scales(self, scales: list[str]) -> None:
        expect_texts(scales, "scales")
        for scale in scales:
            if scale not in self.scales:
                raise ValueError(f"there is no table for scale {scale}")

    def _check_not_excluded(self, name: str) -> None:
        if name in self._excluded_names:
            raise ValueError(f"variable {name} is excluded")

    def _check_request(self, scales: list[str], request: Request) -> None:
        """The variable and its base exist in at least one scale each, and are numbers there."""
        expect(request.code, str, "a variable")
        self._check_not_excluded(request.code)
        if request.base is not None:
            expect(request.base, str, "a base")
            self._check_not_excluded(request.base)
        for name in filter(None, (request.code, request.base)):
            holding = [scale for scale in scales if name in self._present[scale]]
            if not holding:
                raise ValueError(f"variable {name} is in none of the scales")
            if not all(name in self._numbers[scale] for scale in holding):
                raise TypeError(f"variable {name} is not numeric")

    def _check_in_scale(self, scale: str, request: Request) -> None:
        expect(scale, str, "scale")
        self._check_scales([scale])
        for name in filter(None, (request.code, request.base)):
            expect(name, str, "a variable")
            if name not in self._present[scale]:
                raise ValueError(f"scale {scale} has no variable {name}")
        self._check_request([scale], request)

    # Values

    def _value(self, request: Request) -> str:
        """SQL of the variable, divided by its base; zero denominators give null in any ANSI mode."""
        code = f"cast({quoted(request.code)} AS double)"
        if request.base is None:
            return code
        base = f"cast({quoted(request.base)} AS double)"
        return f"CASE WHEN {base} <> 0D THEN {code} / {base} END"

    def _asked(self, scale: str, requests: list[Request]) -> list[tuple[int, str | None, str]]:
        """Number, base and code of the requests that a scale can answer."""
        present = self._present[scale]
        return [(n, r.base, r.code) for n, r in enumerate(requests) if r.code in present and (r.base is None or r.base in present)]

    def _table(self, scale: str, requests: list[Request]) -> DataFrame:
        """One row per unit: a wide scale as it is, of a long one what is asked for, written once for all steps of a cut."""
        table = self.scales[scale]
        if isinstance(table, DataFrame):
            return table
        key = (scale, tuple(requests))
        if key not in self._gathered:
            self._gathered = {k: v for k, v in self._gathered.items() if k[1] == key[1]}
            self._gathered[key] = cut_lineage(gathered(table, self.ids, self._asked(scale, requests)))
            self._unit_counts[scale] = self._gathered[key].count()
        return self._gathered[key]

    def _values(self, table: DataFrame, scale: str, requests: list[Request], kept: list[str]) -> DataFrame:
        """One row per unit and request that this scale can answer, from the rows of ``_table``."""
        if isinstance(self.scales[scale], LongScale):
            each = spread(table, self.scales[scale], self._asked(scale, requests), kept)
            number = F.when(~F.isnan("x"), F.col("x"))
            return each.select(
                F.lit(scale).alias("scale"), *[column(c) for c in kept], "request", "as_percent", finite_or_fail(number).alias("x")
            )
        return self._wide_values(table, scale, requests, kept)

    def _wide_values(self, table: DataFrame, scale: str, requests: list[Request], kept: list[str]) -> DataFrame:
        """The base is in the same row, so no join is needed to divide by it.

        With a thousand requests this expression decides how long planning takes: the row becomes
        one array of plain quotients, and everything else about a value is done after it is spread.
        """
        asked = [(number, requests[number]) for number, _, _ in self._asked(scale, requests)]
        if not asked:
            numbers, shares, values = "array(0)", "array(false)", "cast(array() AS array<double>)"
        else:
            numbers = f"array({', '.join(str(number) for number, _ in asked)})"
            shares = f"array({', '.join('false' if request.base is None else 'true' for _, request in asked)})"
            values = f"array({', '.join(self._value(request) for _, request in asked)})"
        spread = table.select(*[column(c) for c in kept], F.expr(f"posexplode({values})").alias("_i", "_x"))
        number = F.when(~F.isnan("_x"), F.col("_x"))
        return spread.select(
            F.lit(scale).alias("scale"),
            *[column(c) for c in kept],
            F.expr(f"get({numbers}, _i)").alias("request"),
            F.expr(f"get({shares}, _i)").alias("as_percent"),
            finite_or_fail(number).alias("x"),
        )

    @exact_names
    def normalize(self, scale: str, code: str, base: str | None = None) -> DataFrame:
        """ids and ``value``: the variable, divided by its base if there is one."""
        self._check_in_scale(scale, Request(base, code))
        if isinstance(self.scales[scale], LongScale):
            asked = [Request(base, code)]
            each = spread(self._table(scale, asked), self.scales[scale], self._asked(scale, asked), self.ids)
            return each.select(*[column(i) for i in self.ids], F.when(~F.isnan("x"), F.col("x")).alias("value"))
        value = F.expr(self._value(Request(base, code)))
        return self.scales[scale].select(
            *[column(i) for i in self.ids], F.when(~F.isnan(value), value).alias("value")
        )

    # Bins

    def _units(self, scale: str) -> int:
        """Units of a scale, counted once; no variable has more values than that."""
        if scale not in self._unit_counts:
            table = self.scales[scale]
            rows = table.table.select(*[column(i) for i in self.ids]).distinct() if isinstance(table, LongScale) else table
            self._unit_counts[scale] = rows.count()
        return self._unit_counts[scale]

    def _edges(self, scales: list[str], requests: list[Request], q: int) -> DataFrame:
        """One row per scale and request. Labels and memberships both start from these few rows, so
        they are written once instead of being worked out in both branches."""
        values = [self._values(self._table(s, requests), s, requests, []) for s in scales]
        keys = ["scale", "request", "as_percent"]
        most_rows = max(self._units(s) for s in scales)
        edges = binning.quantile_edges(reduce(DataFrame.unionByName, values), keys, "x", q, most_rows)
        return cut_lineage(edges)

    def _members(self, scales: list[str], requests: list[Request], edges: DataFrame, q: int, sliced: bool) -> DataFrame:
        """Every unit of every request with its bin, and its label where ``edges`` has ``labels``. A request has one row
        per unit of a scale, so beyond the broadcast its edges are repeated per salt and no key gathers a scale."""
        extra = ["slice"] if sliced else []
        rows = [
            self._values(
                cells.sliced_by_unit(self._table(s, requests), self.ids, self._units(s)) if sliced else self._table(s, requests),
                s,
                requests,
                [*self.ids, *extra],
            )
            for s in scales
        ]
        labelled = [c for c in ("labels",) if c in edges.columns]
        limits = edges.select("scale", "request", "edges", *labelled)
        each = reduce(DataFrame.unionByName, rows)
        # 8 bytes per edge and a row overhead, per scale and request.
        size = len(scales) * len(requests) * (8 * (q + 1) + 100 + (64 * q if labelled else 0))
        found = joined_with_few(each, limits, ["scale", "request"], [column(i) for i in self.ids], "left", size)
        intervals = binning.interval_count(F.col("edges"))
        return found.select(
            "scale",
            "request",
            *[column(i) for i in self.ids],
            *extra,
            "x",
            binning.bin_number(F.col("x"), F.col("edges")).alias("bin"),
            (F.col("x").isNull() | (intervals == 0)).alias("unclassified"),
            *labelled,
        )

    @exact_names
    def categorize(self, scale: str, code: str, base: str | None = None, q: int = DEFAULT_BINS) -> DataFrame:
        """ids, ``value``, ``bin`` and ``interval`` of every unit; no interval where unclassified."""
        self._check_in_scale(scale, Request(base, code))
        binning.check_bins(q)
        return self._described_members([scale], [Request(base, code)], q).select(
            *[column(i) for i in self.ids], F.col("x").alias("value"), "bin", "interval"
        )

    def _described_members(self, scales: list[str], requests: list[Request], q: int) -> DataFrame:
        edges = self._edges(scales, requests, q)
        grid = binning.bin_grid(edges, ["scale", "request"], F.col("as_percent")).select(
            "scale", "request", "bin", "interval"
        )
        labels = grid.groupBy("scale", "request").agg(
            F.sort_array(F.collect_list(F.struct("bin", "interval"))).alias("labels")
        )
        edges = cut_lineage(edges.join(labels, ["scale", "request"], "left"))
        members = self._members(scales, requests, edges, q, sliced=False)
        return members.withColumn("interval", F.get("labels", F.col("bin") - 1)["interval"]).drop("labels")

    @exact_names
    def members(self, scales: list[str], requests: list[Request], q: int = DEFAULT_BINS) -> DataFrame:
        """Long form of any size: base, name, code, scale, bin, interval, ids, value; one row per unit."""
        self._check_scales(scales)
        binning.check_bins(q)
        for request in requests:
            self._check_request(scales, request)
        rows = self._described_members(scales, requests, q)
        return rows.join(F.broadcast(self._request_table(requests)), "request").select(
            "base",
            "name",
            "code",
            "scale",
            "bin",
            F.when(F.col("unclassified"), binning.UNCLASSIFIED).otherwise(F.col("interval")).alias("interval"),
            *[column(i) for i in self.ids],
            F.col("x").alias("value"),
        )

    def _request_table(self, requests: list[Request]) -> DataFrame:
        """One row per request, as long as the list the caller passed."""
        rows = [(n, r.base, self.names[r.code], r.code) for n, r in enumerate(requests)]
        columns = ["request", "base", "name", "code"]
        return local_table(self.sparkSession, columns, rows).withColumn("request", F.col("request").cast("int"))

    @exact_names
    def cut(
        self,
        scales: list[str],
        requests: list[Request],
        q: int = DEFAULT_BINS,
        units_per_part: int = cells.UNITS_PER_PART,
    ) -> DataFrame:
        """request, base, name, code, bin, part and, per scale, the interval and its units.

        Part 0 of a bin lists its first ``units_per_part`` units in id order, part 1 the next ones, and so
        on, for scales of any size. A scale with fewer bins or parts than another has nulls in the last ones.
        """
        self._check_scales(scales)
        binning.check_bins(q)
        cells.check_units_per_part(units_per_part)
        for request in requests:
            self._check_request(scales, request)
        names = F.broadcast(self._request_table(requests))
        edges = self._edges(scales, requests, q)
        grid = binning.bin_grid(edges, ["scale", "request"], F.col("as_percent")).select(
            "scale", "request", "bin", "interval"
        )
        keys = ["scale", "request", "bin", "unclassified"]
        slices = cells.units_by_slice(self._members(scales, requests, edges, q, sliced=True), keys, self.ids)
        most_units = max(self._units(s) for s in scales)
        pieces = cells.cells_by_part(slices, keys, units_per_part, most_units)
        if most_units > units_per_part:
            # Part 0 gets its interval from the grid below, the others from here.
            size = len(scales) * len(requests) * q * 100
            pieces = joined_with_few(pieces, grid, ["scale", "request", "bin"], [F.col("part")], "left", size)
        else:
            pieces = pieces.withColumn("interval", F.lit(None).cast("string"))
        interval = F.when(F.col("unclassified"), binning.UNCLASSIFIED).otherwise(F.col("interval"))
        listed = pieces.select("scale", "request", "bin", "part", interval.alias("interval"), "slice", "cells")
        rows = listed.unionByName(grid.withColumn("part", F.lit(0).cast("bigint")), allowMissingColumns=True)
        per_scale: list[Column] = []
        for scale in scales:
            here = F.col("scale") == scale
            interval = F.max(F.when(here, F.col("interval")))
            members_here = cells.joined_slices("slice", F.col("cells"), here & F.col("cells").isNotNull())
            per_scale += [
                interval.alias(f"interval_{scale}"),
                F.when(interval.isNotNull(), members_here).alias(f"cells_{scale}"),
            ]
        return (
            rows.groupBy("request", "bin", "part")
            .agg(*per_scale)
            .join(names, "request")
            .select(
                "request", "base", "name", "code", "bin", "part",
                *[column(f"{kind}_{scale}") for scale in scales for kind in ("interval", "cells")],
            )
        )

    @exact_names
    def bin_counts(self, scales: list[str], requests: list[Request], q: int = DEFAULT_BINS) -> DataFrame:
        """request, base, name, code, scale, bin, interval, units: how many units every interval holds, also empty
        ones. Units are counted before the shuffle and never listed."""
        self._check_scales(scales)
        binning.check_bins(q)
        for request in requests:
            self._check_request(scales, request)
        edges = self._edges(scales, requests, q)
        grid = binning.bin_grid(edges, ["scale", "request"], F.col("as_percent")).select(
            "scale", "request", "bin", "interval", F.lit(0).cast("bigint").alias("units")
        )
        counted = (
            self._members(scales, requests, edges, q, sliced=False)
            .groupBy("scale", "request", "bin", "unclassified")
            .agg(F.count(F.lit(1)).alias("units"))
            .select("scale", "request", "bin", F.expr(f"if(unclassified, '{binning.UNCLASSIFIED}', null)").alias("interval"), "units")
        )
        return (
            counted.unionByName(grid)
            .groupBy("request", "scale", "bin")
            .agg(F.max("interval").alias("interval"), F.sum("units").alias("units"))
            .join(F.broadcast(self._request_table(requests)), "request")
            .select("request", "base", "name", "code", "scale", "bin", "interval", "units")
        )

    # Requests

    def _check_bases(self, chosen: dict, what: str) -> None:
        expect(chosen, dict, what)
        if not chosen:
            raise ValueError(f"{what} has no entries")
        for base in chosen:
            expect(base, (str, type(None)), f"every key of {what}")

    def _usable(self, name: str | None) -> bool:
        if name is not None and name in self._excluded_names:
            log.warning("%s is excluded and not processed", name)
            return False
        return True

    def requests_from_lists(self, scales: list[str], chosen: dict[str | None, list[str]]) -> list[Request]:
        """Listed variables per base, without excluded bases and variables."""
        self._check_scales(scales)
        self._check_bases(chosen, "the lists of variables")
        requests = []
        for base, codes in chosen.items():
            expect_texts(codes, "a list of variables")
            if self._usable(base):
                requests += [Request(base, code) for code in codes if self._usable(code)]
        return requests

    def requests_from_regex(self, scales: list[str], chosen: dict[str | None, str]) -> list[Request]:
        """Columns of any scale that match, per base, sorted by name."""
        self._check_scales(scales)
        self._check_bases(chosen, "the expressions")
        requests = []
        for base, pattern in chosen.items():
            compiled(pattern)  # also of a base that is not processed
            if not self._usable(base):
                continue
            matcher = compiled(pattern)
            matches = {c for scale in scales for c in self._columns[scale] if matcher.search(c)}
            if not matches:
                log.warning("%s matches no variable", pattern)
            requests += [Request(base, code) for code in sorted(matches) if self._usable(code)]
        return requests

    # ``units_per_part`` as in ``cut``.

    def process_variable(
        self,
        scales: list[str],
        code: str,
        base: str | None = None,
        q: int = DEFAULT_BINS,
        units_per_part: int = cells.UNITS_PER_PART,
    ) -> DataFrame:
        expect(scales, list, "scales")
        return bin_table(self.cut(scales, [Request(base, code)], q, units_per_part))

    def process_list(
        self,
        scales: list[str],
        chosen: dict[str | None, list[str]],
        q: int = DEFAULT_BINS,
        units_per_part: int = cells.UNITS_PER_PART,
    ) -> DataFrame:
        """Bins of all listed variables, with their ``request`` number and ``base``."""
        binning.check_bins(q)
        return self.cut(scales, self.requests_from_lists(scales, chosen), q, units_per_part)

    def process_regex(
        self,
        scales: list[str],
        chosen: dict[str | None, str],
        q: int = DEFAULT_BINS,
        units_per_part: int = cells.UNITS_PER_PART,
    ) -> DataFrame:
        binning.check_bins(q)
        return self.cut(scales, self.requests_from_regex(scales, chosen), q, units_per_part)


def bin_table(cut: DataFrame) -> DataFrame:
    """name, code, bin, part and the interval and cells of each scale."""
    return cut.drop("request", "base")


def duplicated_bins(bins: DataFrame) -> DataFrame:
    """Pairs of code and bin that occur more than once, with their number of rows; further parts of a bin do not count."""
    first = bins.filter("part = 0") if "part" in bins.columns else bins
    return first.groupBy("code", "bin").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def _with_no_base_last(chosen: dict[str, object]) -> dict[str | None, object]:
    """The key ``"None"`` stands for no base and comes last."""
    named = {base: value for base, value in chosen.items() if base != "None"}
    return {**named, None: chosen["None"]} if "None" in chosen else named


def run_stratification(spark: SparkSession, spec: dict | str, write: bool = True) -> DataFrame:
    """Read scales and dictionary, cut the requested variables in one job and write the bin table."""
    spec = load_spec(spec)
    paths = required(spec, "rutas_csv_escalas", dict)
    dictionary_path = required(spec, "ruta_csv_diccionario_traducciones", str)
    names_column = required(spec, "columna_diccionario_traducciones_nombres", str)
    alias_column = required(spec, "columna_diccionario_traducciones_alias", str)
    ids = expect_texts(required(spec, "variables_identificadoras"), "variables_identificadoras")
    by_list, by_regex = spec.get("variables_a_procesar_list"), spec.get("variables_a_procesar_regex")
    if by_list is None and by_regex is None:
        raise ValueError("the specification needs variables_a_procesar_list or variables_a_procesar_regex")
    q = required(spec, "q")
    binning.check_bins(q)
    output = required(spec, "ruta_csv_salida", str)

    units_per_part = spec.get("unidades_por_parte", cells.UNITS_PER_PART)
    copies: list[str] = []
    with case_sensitive_names(spark):
        try:
            scales, counts = _read_scales(spark, paths, ids, spec, copies)
            dictionary = read_translations(spark, dictionary_path, names_column, alias_column, positions=True)
            stratifier = Stratifier(
                scales, dictionary, names_column, alias_column, ids,
                spec.get("variables_excluidas_list", []), spec.get("variables_excluidas_regex", []), counts,
            )
            requests: list[Request] = []
            if by_regex:
                requests += stratifier.requests_from_regex(list(scales), _with_no_base_last(by_regex))
            if by_list:
                requests += stratifier.requests_from_lists(list(scales), _with_no_base_last(by_list))
            result = stratifier.cut(list(scales), requests, q, units_per_part)
            if copies:  # they go with the run, so what comes back must not need them
                result = cut_lineage(result)
        finally:
            for copy in copies:
                removed(spark, copy)
        if len(set(requests)) < len(requests) or len({r.code for r in requests}) < len(requests):
            log.warning("some variables are cut more than once; see duplicated_bins()")
        if write:
            write_table(bin_table(result.orderBy("request", "bin", "part")), output)
    return result


def _read_scales(
    spark: SparkSession, paths: dict[str, str], ids: list[str], spec: dict, copies: list[str]
) -> tuple[dict[str, DataFrame | LongScale], dict[str, int]]:
    """Scale tables, and the units of those that were counted while they were copied; adds the folders of the copies."""
    multiline, scales, counts = spec.get("multilinea", True), {}, {}
    for scale, path in paths.items():
        if spec.get("forma_larga", False):
            scales[scale] = LongScale(read_long_scale(spark, path, ids))
            continue
        scales[scale], rows, copy = staged_scale(spark, path, ids, multiline)
        if copy is not None:
            copies.append(copy)
            counts[scale] = rows
    return scales, counts
