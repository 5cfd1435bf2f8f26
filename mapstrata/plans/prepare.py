"""Microdata and metadata to one row of aggregates per geographic unit."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from mapstrata.operators import aggregate, casts, cleaning, columns, gate, translate
from mapstrata.plans.spec import existing, expect, expect_texts, load_spec, required, required_column
from mapstrata.session import case_sensitive_names, column, cut_lineage, exact_names, removed, written_once
from mapstrata.sinks.files import write_dictionary, write_table, write_units
from mapstrata.sinks.versions import new_version, publish
from mapstrata.sources import read_metadata, read_microdata

log = logging.getLogger(__name__)

# Kinds of variables in a specification.
CATEGORICAL, NUMERIC = "categorico", "numerico"


@dataclass(frozen=True)
class Preparation:
    """Microdata with its metadata. Every step gives a new object, nothing is changed in place."""

    df: DataFrame
    metadata: DataFrame
    names_column: str
    values_column: str

    def __post_init__(self) -> None:
        expect(self.df, DataFrame, "df")
        expect(self.metadata, DataFrame, "metadata")
        expect(self.names_column, str, "names_column")
        expect(self.values_column, str, "values_column")
        object.__setattr__(self, "df", columns.drop_index_column(self.df))
        object.__setattr__(self, "metadata", columns.drop_index_column(self.metadata))

    def blanks_to_null(self) -> Preparation:
        return replace(self, df=cleaning.blanks_to_null(self.df))

    def rename_to_alias(self, alias_column: str) -> Preparation:
        expect(alias_column, str, "alias_column")
        return replace(self, df=columns.rename_to_alias(self.df, self.metadata, self.names_column, alias_column))

    def convert_types(self, types_column: str) -> Preparation:
        expect(types_column, str, "types_column")
        return replace(self, df=casts.convert_types(self.df, self.metadata, self.names_column, types_column))

    def exclude_variables(self, class_column: str, values: list) -> Preparation:
        expect(class_column, str, "class_column")
        expect(values, list, "values")
        kept = columns.exclude_by_class(self.df, self.metadata, self.names_column, class_column, values)
        return replace(self, df=kept)

    def select_variables(
        self, listed: list[str], patterns: list[str], class_column: str | None = None, values: list | None = None
    ) -> list[str]:
        return columns.select_variables(
            self.df, listed, patterns, self.metadata, self.names_column, class_column, values
        )

    def group_totals(self, ids: list[str]) -> DataFrame:
        expect(ids, list, "ids")
        return aggregate.total_counts(self.df, ids)

    def group_categorical(self, ids: list[str], variables: list[str]) -> DataFrame:
        expect(ids, list, "ids")
        expect(variables, list, "variables")
        return aggregate.categorical_wide(self.df, ids, variables)

    def count_categories(self, ids: list[str], variables: list[str]) -> DataFrame:
        """The same counts in long form, for any number of observed values."""
        expect(ids, list, "ids")
        expect(variables, list, "variables")
        return aggregate.categorical_counts(self.df, ids, variables)

    def group_numeric(self, ids: list[str], variables: list[str], operation: str) -> DataFrame:
        expect(ids, list, "ids")
        expect(variables, list, "variables")
        return aggregate.numeric_wide(self.df, ids, variables, operation)

    def categorical_dictionary(
        self, variables: list[str] | None, alias_column: str, value_alias_column: str
    ) -> DataFrame:
        expect(variables, (list, type(None)), "variables")
        expect(alias_column, str, "alias_column")
        expect(value_alias_column, str, "value_alias_column")
        return translate.categorical_dictionary(
            self.metadata, self.names_column, self.values_column, alias_column, value_alias_column, variables
        )

    def numeric_dictionary(self, variables: list[str] | None, alias_column: str, operation: str) -> DataFrame:
        expect(variables, (list, type(None)), "variables")
        expect(alias_column, str, "alias_column")
        expect(operation, str, "operation")
        return translate.numeric_dictionary(self.metadata, self.names_column, alias_column, operation, variables)

    def total_dictionary(self) -> DataFrame:
        return translate.total_dictionary(self.metadata)


@dataclass(frozen=True)
class Block:
    """Variables to aggregate in one way; ``operation`` is None for categorical ones."""

    variables: list[str]
    operation: str | None


@dataclass(frozen=True)
class Prepared:
    """Aggregates (wide, or long where the specification says ``forma_larga``), their dictionary, and the variables
    left out as not numeric."""

    wide: DataFrame
    dictionary: DataFrame
    skipped: list[str] = field(default_factory=list)


def resolve_block(preparation: Preparation, block: dict) -> Block:
    """One entry of ``variables_a_agrupar`` with its selectors applied to the columns."""
    expect(block, dict, "every element of variables_a_agrupar")
    kind = required(block, "tipo_variables")
    listed = expect_texts(required(block, "variables_a_agrupar_list"), "variables_a_agrupar_list")
    patterns = expect_texts(required(block, "variables_a_agrupar_regex"), "variables_a_agrupar_regex")
    by_class = block.get("variables_a_agrupar_clasificacion_metadatos")
    if kind not in (CATEGORICAL, NUMERIC):
        raise ValueError(f"tipo_variables must be {CATEGORICAL} or {NUMERIC}")
    operation = required(block, "operacion") if kind == NUMERIC else None
    if operation is not None:
        aggregate.check_operation(operation)
    for name in listed:
        existing(name, preparation.df.columns)
    class_column = values = None
    if by_class is not None:
        class_column = required_column(by_class, "columna_metadatos_filtro", preparation.metadata.columns)
        values = required(by_class, "valores", list)
    return Block(preparation.select_variables(listed, patterns, class_column, values), operation)


def _aggregated(
    preparation: Preparation, ids: list[str], blocks: list[Block], checked: gate.Gate | None
) -> tuple[DataFrame, DataFrame | None, list[str]]:
    """Totals and numeric aggregates per unit, counts of all categorical blocks, and the variables that failed the gate.

    The microdata is read once for the gate of all numeric variables, unless the write of the table has checked them, once for
    totals and integer sums, once each for other sums and medians and once for all categorical blocks.
    """
    df = preparation.df
    numeric = [b for b in blocks if b.operation is not None]
    pairs = [(b.operation, v) for b in numeric for v in b.variables if v not in ids]
    if len(set(pairs)) < len(pairs):
        raise ValueError("the same operation is asked for twice on one variable")
    candidates = list(dict.fromkeys(v for _, v in pairs))
    checked = checked or gate.passed_gate(df, candidates)
    skipped = [v for v in candidates if v not in checked.passed]
    for variable in skipped:
        log.warning("%s holds values that are not numbers and is not aggregated", variable)

    by_operation: dict[str, list[str]] = {}
    for operation, variable in pairs:
        if variable in checked.passed:
            by_operation.setdefault(operation, []).append(variable)
    base = aggregate.numeric_blocks(
        df, ids, by_operation, with_total=True, most_rows=checked.rows, integers=checked.integers
    )
    categories = [v for block in blocks if block.operation is None for v in block.variables if v not in ids]
    if len(set(categories)) < len(categories):
        raise ValueError("two blocks give columns of the same name")
    counts = None
    if any(block.operation is None for block in blocks):
        counts = cut_lineage(aggregate.categorical_counts(df, ids, categories))
    return base, counts, skipped


def _categorical(blocks: list[Block]) -> list[list[str]]:
    return [block.variables for block in blocks if block.operation is None]


@exact_names
def _joined_blocks(base: DataFrame, counts: DataFrame | None, ids: list[str], blocks: list[Block]) -> DataFrame:
    if counts is None:
        joined, codes = base, {}
    else:
        pairs = aggregate.ordered_codes(counts)
        units = aggregate.units_with_all(counts, ids, _categorical(blocks))
        joined = aggregate.joined_on_units([base, aggregate.widened_counts(counts, ids, list(pairs)), units], ids)
        codes = pairs
    order = [aggregate.TOTAL_CODE]
    for block in blocks:
        if block.operation is None:
            order += [code for code, variable in codes.items() if variable in block.variables]
        else:
            made = [aggregate.numeric_code(block.operation, v) for v in block.variables]
            order += [code for code in made if code in base.columns]
    if len(set(order)) < len(order):
        raise ValueError("two blocks give columns of the same name")
    return columns.project(joined, [*ids, *order])


def aggregate_blocks(
    preparation: Preparation, ids: list[str], blocks: list[Block], checked: gate.Gate | None = None
) -> tuple[DataFrame, list[str]]:
    """All blocks joined on the units, one column per code, with the variables that failed the numeric gate, which is read
    from the table unless it is given."""
    base, counts, skipped = _aggregated(preparation, ids, blocks, checked)
    return _joined_blocks(base, counts, ids, blocks), skipped


def aggregate_blocks_long(
    preparation: Preparation, ids: list[str], blocks: list[Block], exact: bool = False, checked: gate.Gate | None = None
) -> tuple[DataFrame, list[str]]:
    """The same values as ids, code, value, for any number of observed categories: no code becomes a column, so a
    count of zero has no row. With ``exact`` also ``whole``, counts and integer sums as they are."""
    base, counts, skipped = _aggregated(preparation, ids, blocks, checked)
    long = aggregate.lengthened(base, ids, [c for c in base.columns if c not in ids], exact)
    if counts is not None:
        units = aggregate.units_with_all(counts, ids, _categorical(blocks))
        long = long.unionByName(aggregate.long_counts(counts, ids, exact)).join(units, ids, "left_semi")
    return long, skipped


def block_dictionaries(
    preparation: Preparation, blocks: list[Block], alias_column: str, value_alias_column: str
) -> DataFrame:
    parts = [preparation.total_dictionary()]
    for block in blocks:
        if block.operation is None:
            parts.append(preparation.categorical_dictionary(block.variables, alias_column, value_alias_column))
        else:
            parts.append(preparation.numeric_dictionary(block.variables, alias_column, block.operation))
    return translate.merged_dictionaries(parts)


def staged(df: DataFrame) -> DataFrame:
    """Delimited microdata written once as Parquet in the shared folder: later passes read only
    the columns they need, in splits, instead of parsing every line again."""
    return written_once(df, "microdata")[0]


def run_preparation(spark: SparkSession, spec: dict | str, write: bool = True) -> Prepared:
    """Read, clean, aggregate and translate as specified, and write both results. With ``carpeta_salida`` their paths are names in
    that folder, and readers of ``carpeta_salida#name`` get both of one run, also if a later run ends between them."""
    spec = load_spec(spec)
    data_path = required(spec, "ruta_csv_dataset", str)
    metadata_path = required(spec, "ruta_csv_metadatos", str)
    wide_path = required(spec, "ruta_salida_dataset", str)
    dictionary_path = required(spec, "ruta_salida_diccionario_traducciones", str)
    ids = expect_texts(required(spec, "variables_identificadoras_list"), "variables_identificadoras_list")
    block_specs = required(spec, "variables_a_agrupar", list)
    folder = spec.get("carpeta_salida")
    expect(folder, (str, type(None)), "carpeta_salida")

    with case_sensitive_names(spark):
        df = read_microdata(spark, data_path, multiline=spec.get("multilinea", True))
        metadata = read_metadata(spark, metadata_path, positions=True)
        names_column = required_column(spec, "columna_metadatos_nombres", metadata.columns)
        values_column = required_column(spec, "columna_metadatos_posibles_valores", metadata.columns)
        alias_column = required_column(spec, "columna_metadatos_alias", metadata.columns, names_column)
        value_alias_column = required_column(
            spec, "columna_metadatos_posibles_valores_alias", metadata.columns, values_column
        )
        for name in ids:
            existing(name, df.columns)

        preparation = Preparation(df, metadata, names_column, values_column).blanks_to_null()
        if spec.get("columna_metadatos_tipos") is not None:
            preparation = preparation.convert_types(
                required_column(spec, "columna_metadatos_tipos", metadata.columns)
            )
        if spec.get("columna_metadatos_filtro_excluir") is not None:
            preparation = preparation.exclude_variables(
                required_column(spec, "columna_metadatos_filtro_excluir", metadata.columns),
                required(spec, "valores_a_excluir", list),
            )
        blocks = [resolve_block(preparation, block) for block in block_specs]
        needed = [*ids, *(v for block in blocks for v in block.variables)]
        narrow, copy, checked = columns.project(preparation.df, needed), None, None
        long = spec.get("forma_larga", False)
        try:
            if not data_path.rstrip("/").endswith(".parquet"):
                numeric = [v for block in blocks if block.operation is not None for v in block.variables if v not in ids]
                observed, outcome = gate.watched(narrow, list(dict.fromkeys(numeric)))
                narrow, copy = written_once(observed, "microdata")
                checked = outcome()
            preparation = replace(preparation, df=narrow)
            if long:
                wide, skipped = aggregate_blocks_long(preparation, ids, blocks, exact=True, checked=checked)
            else:
                wide, skipped = aggregate_blocks(preparation, ids, blocks, checked)
            # the copy of the microdata goes with the run, so what comes back must not need it
            wide = cut_lineage(wide)
        finally:
            if copy is not None:
                removed(spark, copy)
        dictionary = block_dictionaries(preparation, blocks, alias_column, value_alias_column)
        if write:
            version = None
            if folder is not None:
                version = new_version(folder)
                names = [wide_path, dictionary_path]
                wide_path, dictionary_path = f"{version}/{wide_path}", f"{version}/{dictionary_path}"
            if long:
                write_table(wide.orderBy(*[column(i) for i in ids], "code"), wide_path)
            else:
                write_units(wide, ids, wide_path)
            write_dictionary(dictionary, dictionary_path)
            if version is not None:
                publish(folder, version, names)
    return Prepared(wide, dictionary, skipped)
