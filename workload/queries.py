"""One callable per operator: (spark, folder of the tables) -> DataFrame over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapstrata.functions.literals import list_from_text, options_from_text
from mapstrata.functions.numbers import float_text, percent
from mapstrata.functions.text import (
    accents_folded,
    catalog_name_normalized,
    missing_to_null,
    source_name_normalized,
)
from mapstrata.operators import aggregate, binning, casts, cleaning, columns, gate, metadata, translate
from mapstrata.operators.order_stats import medians
from mapstrata.plans.long_scale import LongScale
from mapstrata.plans.prepare import (
    Block,
    Preparation,
    aggregate_blocks,
    aggregate_blocks_long,
    block_dictionaries,
    resolve_block,
    run_preparation,
    staged,
)
from mapstrata.plans.strata import Request, Stratifier, bin_table, duplicated_bins, run_stratification
from mapstrata.session import checkpoint_folder, column, cut_lineage, local_table
from mapstrata.sinks import staged as staged_files
from mapstrata.sinks.files import write_dictionary, write_table, write_units
from mapstrata.sources import read_bin_table, read_catalogs, read_metadata, read_microdata, read_scale, read_translations
from workload.tables import TOTAL, microdata, names, table, units

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

IDS = ["ent", "mun"]
CATEGORIES = ["estado", "prioridad", "segmento"]
BINS = 10


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def described(spark: SparkSession) -> DataFrame:
    """Metadata of the microdata columns."""
    rows = [
        ("folio", "Folio", "id", "string", "[]", "[]"),
        ("ent", "Entidad", "geo", "str", "[]", "[]"),
        ("mun", "Municipio", "geo", "string", "[]", "[]"),
        ("estado", "Estado", "options", "string", "['F', 'O', 'p']", "['Final ', 'Abierto', \"L'curso\"]"),
        ("prioridad", "Prioridad", "options", "object", "['1-URGENT', '2-HIGH', '3-MEDIUM']", "[1, 2, 3]"),
        ("segmento", "Segmento", "options", "category", "[]", "[]"),
        ("precio", "Precio", "abierta", "float64", "[]", "[]"),
        ("saldo", "Saldo", "abierta", "Float", "[]", "[]"),
        ("ausente", "Ausente", "options", "string", "[]", "[]"),
    ]
    return local_table(spark, ["var", "alias", "clase", "tipo", "valores", "etiquetas"], rows)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.blanks_to_null(microdata(spark, sf_dir))


def prepared(spark: SparkSession, sf_dir: str, *passes_over: str) -> Preparation:
    """Cleaned microdata; the columns that several passes read are written once, as the pipeline does."""
    preparation = Preparation(microdata(spark, sf_dir), described(spark), "var", "valores").blanks_to_null()
    if passes_over:
        return replace(preparation, df=staged(columns.project(preparation.df, passes_over)))
    return preparation


def stratifier(spark: SparkSession, sf_dir: str, *levels: str, **options: list[str]) -> Stratifier:
    """Scale tables are written before they are cut, as a pipeline would have them on disk."""
    scales = {level: cut_lineage(units(spark, sf_dir, level)) for level in levels}
    return Stratifier(scales, names(spark), "traduccion", "variable", ["unidad"], **options)


def work_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


# Sources and cleaning


@query
def missing_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "P", "NA").otherwise(F.col("o_orderstatus"))
    priority = F.when(F.col("o_orderpriority") == "5-LOW", "null").otherwise(F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", missing_to_null(status).alias("status"), missing_to_null(priority).alias("priority")
    )


@query
def microdata_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "microdata")
    write_table(microdata(spark, sf_dir), path)
    return cleaning.strip_text(cleaning.blanks_to_null(read_microdata(spark, path)))


@query
def scale_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "scale")
    wide = units(spark, sf_dir, "mun").select("unidad", TOTAL, "suma::o_totalprice")
    write_units(wide, ["unidad"], path)
    return read_scale(spark, path, ["unidad"]).select(
        "unidad", column(TOTAL).cast("bigint").alias("total"), column("suma::o_totalprice").alias("suma")
    )


@query
def document_metadata_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks and quotes survive a delimited file."""
    path = work_path(spark, "documents")
    write_table(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), path)
    return read_metadata(spark, path).select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "text")


@query
def blank_to_null_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir).select("folio", *CATEGORIES)


@query
def strip_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.strip_text(microdata(spark, sf_dir)).select("folio", *IDS, "estado", "saldo")


@query
def zero_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_nationkey").cast("string").alias("nation"),
        F.floor("c_acctbal").cast("string").alias("balance"),
        F.col("c_name").alias("name"),
    )
    return cleaning.pad_columns(rows, {"nation": 3, "balance": 6, "name": 5})


@query
def typed_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = microdata(spark, sf_dir).select("folio", "estado", "precio", "saldo")
    types = [("folio", "Int64"), ("estado", "str"), ("precio", "float"), ("saldo", "float64")]
    declared = local_table(spark, ["var", "tipo"], types)
    return casts.convert_types(cleaning.blanks_to_null(rows), declared, "var", "tipo")


# Columns


@query
def rename_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, sf_dir).rename_to_alias("alias").df.select("Folio", "Estado", "Precio", "nota")


@query
def exclude_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, sf_dir).exclude_variables("clase", ["geo", "abierta"]).df


@query
def select_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = cleaned(spark, sf_dir)
    return columns.project(df, columns.columns_by_regex(df, "^(?!ent)(?!mun).*o"))


@query
def select_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    preparation = prepared(spark, sf_dir)
    return columns.project(preparation.df, ["folio", *preparation.select_variables([], [], "clase", ["options"])])


@query
def select_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    preparation = prepared(spark, sf_dir)
    return columns.project(preparation.df, preparation.select_variables(["folio"], ["^pr"], "clase", ["geo"]))


# Aggregates


@query
def total_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, sf_dir).group_totals(IDS).withColumnRenamed(TOTAL, "total")


@query
def melt_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.melted(cleaned(spark, sf_dir), ["folio"], [*CATEGORIES, "folio"])


@query
def categorical_counts_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, sf_dir).count_categories(IDS, [*CATEGORIES, "mun"])


@query
def categorical_counts_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, sf_dir).group_categorical(IDS, CATEGORIES)


@query
def observed_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.observed_values(prepared(spark, sf_dir).count_categories(IDS, CATEGORIES))


@query
def numeric_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, sf_dir).group_numeric(IDS, ["precio", "saldo", "nota"], "suma")


@query
def integer_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact sums beyond what a double holds, of typed and of text columns."""
    big = F.col("l_orderkey") * 1_000_000_007 + F.col("l_partkey")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_suppkey", "l_linenumber",
        F.concat(F.lit(" "), big.cast("string")).alias("texto"),
    )
    return aggregate.numeric_wide(rows, ["l_returnflag", "l_linestatus"], ["l_suppkey", "l_linenumber", "texto"], "suma")


@query
def numeric_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, sf_dir).group_numeric(IDS, ["precio", "saldo"], "media")


@query
def numeric_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    preparation = prepared(spark, sf_dir, *IDS, "precio", "saldo")
    return preparation.group_numeric(IDS, ["precio", "saldo", "ent"], "mediana")


@query
def numeric_median_few_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three groups hold the whole table, so none fits in one task at scale."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    return medians(rows, ["l_returnflag"], "l_extendedprice").withColumnRenamed("_median", "median")


@query
def numeric_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    preparation = prepared(spark, sf_dir, *IDS, "precio", "saldo")
    return aggregate.numeric_long(preparation.df, IDS, ["precio", "saldo"], "mediana")


def big_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integers whose sums no double holds, and numbers between 1e-20 and 1e20."""
    apart = F.element_at(F.array(F.lit(1e20), F.lit(1.0), F.lit(1e-20)), (F.col("l_linenumber") % 3 + 1).cast("int"))
    return table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        "l_linestatus",
        (F.col("l_orderkey") * 1_000_000_007 + F.col("l_partkey")).alias("entero"),
        F.when(F.col("l_suppkey") % 2 == 0, F.col("l_extendedprice")).otherwise(-F.col("l_extendedprice")).alias("saldo"),
        (F.col("l_discount") * apart).alias("disperso"),
    )


@query
def numeric_long_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums in long form, integers also as they are."""
    return aggregate.numeric_long(big_numbers(spark, sf_dir), ["l_returnflag", "l_linestatus"], ["entero", "saldo"], "suma", exact=True)


@query
def numeric_sum_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums and means of numbers of both signs, and of numbers 40 orders of magnitude apart."""
    blocks = {"suma": ["saldo", "disperso"], "media": ["saldo", "entero"]}
    return aggregate.numeric_blocks(big_numbers(spark, sf_dir), ["l_returnflag"], blocks, with_total=True, integers=frozenset(["entero"]))


@query
def numeric_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = ["precio", "saldo", "nota", "estado"]
    counts = gate.non_numeric_counts(cleaned(spark, sf_dir), candidates)
    return counts.select("variable", "rejected", (F.col("rejected") == 0).alias("passes"))


REGISTRY_BLOCKS = [
    {
        "tipo_variables": "categorico",
        "variables_a_agrupar_list": [],
        "variables_a_agrupar_regex": ["^(?!folio)(?!precio)(?!saldo)(?!nota).*"],
    },
    *(
        {
            "tipo_variables": "numerico",
            "operacion": operation,
            "variables_a_agrupar_list": ["precio", "nota"],
            "variables_a_agrupar_regex": [],
        }
        for operation in ("media", "mediana")
    ),
]


def registry_wide(spark: SparkSession, sf_dir: str) -> tuple[Preparation, list[Block], DataFrame]:
    preparation = prepared(spark, sf_dir, *IDS, *CATEGORIES, "precio", "nota", "folio")
    blocks = [resolve_block(preparation, block) for block in REGISTRY_BLOCKS]
    return preparation, blocks, aggregate_blocks(preparation, IDS, blocks)[0]


@query
def joined_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry_wide(spark, sf_dir)[2]


@query
def joined_aggregates_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = registry_wide(spark, sf_dir)[2]
    return aggregate.lengthened(wide, IDS, [c for c in wide.columns if c not in IDS])


@query
def aggregates_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks joined on the units without any code becoming a column; zero counts have no row."""
    preparation = prepared(spark, sf_dir, *IDS, *CATEGORIES, "precio", "nota", "folio")
    blocks = [resolve_block(preparation, block) for block in REGISTRY_BLOCKS]
    return aggregate_blocks_long(preparation, IDS, blocks)[0]


# Bins


@query
def ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratifier(spark, sf_dir, "cus").normalize("cus", "o_orderstatus-F", "o_orderstatus-O")


@query
def quantile_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice")
    edges = binning.quantile_edges(rows, ["o_orderpriority"], "o_totalprice", BINS)
    return edges.select("o_orderpriority", F.posexplode("edges").alias("i", "edge"))


@query
def quantile_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratifier(spark, sf_dir, "cus").categorize("cus", "max::urgente", q=BINS)


@query
def bin_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of every interval, also of empty ones."""
    codes = ["o_orderstatus-F", TOTAL, "max::c_acctbal"]
    strata = stratifier(spark, sf_dir, "cus")
    requests = strata.requests_from_lists(["cus"], {TOTAL: codes, None: codes})
    return strata.bin_counts(["cus"], requests, 20).select("request", "code", "bin", "units")


@query
def interval_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("line"), (F.col("l_extendedprice") * F.col("l_discount")).alias("x")
    )
    edges = binning.quantile_edges(rows, ["line"], "x", 7)
    return binning.bin_grid(edges, ["line"], F.lit(False))


@query
def percent_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("line"), (F.col("l_tax") / F.col("l_quantity")).alias("x")
    )
    edges = binning.quantile_edges(rows, ["line"], "x", 7)
    return binning.bin_grid(edges, ["line"], F.lit(True))


@query
def number_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    small = F.col("l_discount") / 4096
    large = F.col("l_extendedprice") * 128
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        float_text(small).alias("small"),
        float_text(large).alias("large"),
        float_text(percent(F.col("l_tax") - F.col("l_discount"))).alias("share"),
        float_text(F.col("l_extendedprice") * 1e14 / 7).alias("huge"),
        float_text((F.col("l_tax") + F.col("l_quantity")) * 1e-320).alias("tiny"),
    )


@query
def cells_per_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratifier(spark, sf_dir, "cus").process_variable(["cus"], "max::c_acctbal", q=4)


@query
def bin_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins whose units take several rows."""
    return stratifier(spark, sf_dir, "cus").process_variable(["cus"], "max::urgente", q=4, units_per_part=7)


@query
def bin_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = [Request(None, "max::urgente"), Request(TOTAL, "o_orderstatus-P")]
    return stratifier(spark, sf_dir, "cus", "mun").members(["cus", "mun"], requests, 5)


@query
def process_variable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratifier(spark, sf_dir, "cus").process_variable(["cus"], "suma::o_totalprice", TOTAL, BINS)


@query
def process_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = {
        TOTAL: ["o_orderstatus-F", "o_orderstatus-O", "sin_nombre"],
        "sin_nombre": ["o_orderstatus-F"],
        None: [TOTAL, "max::urgente"],
    }
    return stratifier(spark, sf_dir, "cus").process_list(["cus"], chosen, BINS)


@query
def process_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_table(stratifier(spark, sf_dir, "cus").process_regex(["cus"], {None: "^.*"}, BINS))


@query
def process_multiscale(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = {None: ["max::urgente", "fijo"], TOTAL: ["o_orderstatus-O"]}
    levels = ["cus", "mun", "ent"]
    return bin_table(stratifier(spark, sf_dir, *levels).process_list(levels, chosen, 6))


def long_scale(spark: SparkSession, sf_dir: str, level: str) -> LongScale:
    """The same aggregates as rows of unit, code and value, counts of zero and missing maxima having none."""
    wide = units(spark, sf_dir, level)
    long = aggregate.lengthened(wide, ["unidad"], [c for c in wide.columns if c != "unidad"])
    return LongScale(cut_lineage(long.where("value <> 0")), r"^(suma|media|mediana|max)::")


@query
def long_scale_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No code is a column."""
    scales = {"cus": long_scale(spark, sf_dir, "cus")}
    strata = Stratifier(scales, names(spark), "traduccion", "variable", ["unidad"])
    return bin_table(strata.process_regex(["cus"], {None: "^.*"}, BINS))


@query
def long_scale_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long scales beside a wide one, with a base that is a code of each."""
    scales = {
        "cus": long_scale(spark, sf_dir, "cus"),
        "mun": long_scale(spark, sf_dir, "mun"),
        "ent": cut_lineage(units(spark, sf_dir, "ent")),
    }
    strata = Stratifier(scales, names(spark), "traduccion", "variable", ["unidad"])
    chosen = {None: ["max::urgente", "fijo"], TOTAL: ["o_orderstatus-O"]}
    return bin_table(strata.process_list(list(scales), chosen, 6))


@query
def long_scale_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units per interval of quotients on a long scale, also of empty intervals."""
    codes = ["o_orderstatus-F", TOTAL, "max::c_acctbal"]
    strata = Stratifier({"cus": long_scale(spark, sf_dir, "cus")}, names(spark), "traduccion", "variable", ["unidad"])
    requests = strata.requests_from_lists(["cus"], {TOTAL: codes, None: codes})
    return strata.bin_counts(["cus"], requests, 20).select("request", "code", "bin", "units")


def stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches of expressions, then lists, as one job."""
    strata = stratifier(spark, sf_dir, "mun")
    requests = strata.requests_from_regex(["mun"], {TOTAL: "^o_order"})
    requests += strata.requests_from_lists(["mun"], {None: ["o_orderstatus-F", "max::urgente"]})
    return bin_table(strata.cut(["mun"], requests, 5))


@query
def concat_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stacked(spark, sf_dir)


@query
def duplicate_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicated_bins(stacked(spark, sf_dir))


@query
def staged_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of places added in two loads. A third one, in which a task fails after others have staged their rows, leaves none."""
    folder = work_path(spark, "loads")
    strata = stratifier(spark, sf_dir, "mun")
    bins = cut_lineage(bin_table(strata.process_list(["mun"], {None: ["max::urgente", "fijo"], TOTAL: ["o_orderstatus-O"]}, 5)))
    doubtful = F.when(F.col("bin") == 3, F.raise_error(F.lit("a task fails"))).otherwise(F.col("name"))
    try:
        staged_files.staged_load(bins.repartition(5, "bin").withColumn("name", doubtful), folder)
    except Exception:  # noqa: BLE001
        staged_files.staged_load(bins.where("bin <= 2"), folder)
        staged_files.staged_load(bins.where("bin > 2"), folder)
    return staged_files.read_loads(spark, folder)


@query
def bin_table_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "bins")
    write_table(stacked(spark, sf_dir), path)
    return read_bin_table(spark, path)


@query
def usable_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that remain after listed, matched, unnamed and id columns are excluded."""
    strata = stratifier(spark, sf_dir, "mun", excluded=["fijo"], excluded_regex=["^max::"])
    wide = strata.scales["mun"]
    return aggregate.lengthened(wide, ["unidad"], [c for c in wide.columns if c not in strata.excluded])


@query
def missing_in_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = prepared(spark, sf_dir).count_categories(IDS, CATEGORIES)
    codes = counts.select(aggregate.value_code().alias("code"))
    dictionary = prepared(spark, sf_dir).categorical_dictionary(None, "alias", "etiquetas")
    return translate.codes_without_name(codes, dictionary, "variable")


# Metadata and dictionaries


def part_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One variable per part, with list texts as metadata holds them."""
    values = F.concat(F.lit("['"), F.col("p_brand"), F.lit("', "), F.col("p_size").cast("string"), F.lit(", None]"))
    labels = F.concat(F.lit('["L\'"'), F.lit(", '"), F.col("p_type"), F.lit(" ']"))
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("v"), F.col("p_partkey").cast("string")).alias("var"),
        F.col("p_name").alias("alias"),
        F.when(F.col("p_size") > 5, values).otherwise("[]").alias("valores"),
        labels.alias("etiquetas"),
    )


@query
def list_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = part_metadata(spark, sf_dir)
    return rows.select("var", F.posexplode(list_from_text(F.col("valores"))).alias("i", "value"))


@query
def literal_edge_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and punctuation inside quotes, number keys, and backslashes."""
    size = F.col("p_size").cast("string")
    listed = F.concat(
        F.lit("['a, None, "), F.col("p_brand"), F.lit("', 'True: "), size, F.lit("]', "), size, F.lit(", None, '\\\\xe1', '\\xe1']")
    )
    options = F.concat(
        F.lit("{'n': None, 'options': {"), size, F.lit(": 'uno: None, "), F.col("p_type"), F.lit("', -1: \"l'otro\", 'k, 2: x': 'False'}}")
    )
    rows = table(spark, sf_dir, "part")
    items = rows.select("p_partkey", F.posexplode(list_from_text(listed)).alias("i", "value")).withColumn("key", F.lit("item"))
    pairs = rows.select("p_partkey", F.posexplode(options_from_text(options)).alias("i", "key", "value"))
    return items.unionByName(pairs)


def as_several_files(rows: DataFrame, path: str) -> None:
    """Rows in the order of ``n``, then ``variable``, over files of which the later ones are the larger ones."""
    ordered = rows.repartitionByRange(4, "n", "variable").sortWithinPartitions("n", "variable")
    write_table(ordered.drop("n"), path)


def named_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part with its name, then those of even keys again with longer names."""
    named = table(spark, sf_dir, "part").select(
        F.concat(F.lit("v"), F.col("p_partkey").cast("string")).alias("variable"), "p_partkey", F.col("p_name").alias("traduccion")
    )
    again = named.filter("p_partkey % 2 = 0").withColumn("traduccion", F.repeat("traduccion", 5))
    return named.withColumn("n", F.lit(0)).unionByName(again.withColumn("n", F.lit(1))).drop("p_partkey")


@query
def dictionary_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "dictionary")
    as_several_files(named_twice(spark, sf_dir), path)
    dictionary = read_translations(spark, path, "traduccion", "variable", positions=True)
    return translate.last_names(dictionary, "variable", "traduccion")


@query
def metadata_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_path(spark, 'metadata')}.parquet"
    as_several_files(named_twice(spark, sf_dir), path)
    return translate.numeric_dictionary(read_metadata(spark, path, positions=True), "variable", "traduccion", "suma")


@query
def dictionary_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return translate.categorical_dictionary(part_metadata(spark, sf_dir), "var", "valores", "alias", "etiquetas")


@query
def dictionary_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return translate.numeric_dictionary(part_metadata(spark, sf_dir), "var", "alias", "media")


@query
def dictionary_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = part_metadata(spark, sf_dir)
    again = rows.withColumn("alias", F.upper("alias")).filter(F.col("alias").contains("RING"))
    parts = [
        translate.total_dictionary(rows),
        translate.numeric_dictionary(rows, "var", "alias", "suma"),
        translate.categorical_dictionary(rows, "var", "valores", "alias", "etiquetas"),
        translate.numeric_dictionary(again, "var", "alias", "suma"),
    ]
    return translate.merged_dictionaries(parts)


@query
def dictionary_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "dictionary")
    parts = [translate.categorical_dictionary(part_metadata(spark, sf_dir), "var", "valores", "alias", "etiquetas")]
    write_dictionary(translate.merged_dictionaries(parts), path)
    return read_translations(spark, path, "traduccion", "variable")


@query
def named_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = prepared(spark, sf_dir).count_categories(IDS, CATEGORIES)
    coded = counts.select(*IDS, aggregate.value_code().alias("code"), "n")
    dictionary = prepared(spark, sf_dir).categorical_dictionary(CATEGORIES, "alias", "etiquetas")
    return translate.named(coded, translate.last_names(dictionary, "variable", "traduccion"))


def customer_catalogs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Variables, one per customer, and one catalogue per customer with orders; some have both label columns, one or none."""
    orders = table(spark, sf_dir, "orders")
    catalogs = orders.select(
        F.concat(F.lit("Cat Cliénte "), F.col("o_custkey").cast("string")).alias("catalog"),
        F.col("o_orderkey").alias("pos"),
        F.col("o_orderkey").cast("string").alias("clave"),
        F.when(F.col("o_custkey") >= 500, F.col("o_orderpriority")).alias("clasificacion"),
        F.when(F.col("o_custkey") >= 100, F.concat("o_orderstatus", F.lit("'s"))).alias("descripcion"),
    )
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("var"),
        F.concat(F.lit(" CATÁLOGO: CLIENTE "), F.col("c_custkey").cast("string"), F.lit(":")).alias("fuente"),
    )
    return rows, catalogs


@query
def catalog_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, catalogs = customer_catalogs(spark, sf_dir)
    found = metadata.with_catalog_values(rows, "fuente", catalogs)
    return found.select("var", "fuente", column(metadata.LABELS).alias("valores"), column(metadata.KEYS).alias("claves"))


@query
def catalog_lookup_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lists, seven entries to a row."""
    rows, catalogs = customer_catalogs(spark, sf_dir)
    found = metadata.with_catalog_values(rows, "fuente", catalogs, entries_per_page=7)
    return found.select("var", "fuente", "page", column(metadata.LABELS).alias("valores"), column(metadata.KEYS).alias("claves"))


@query
def catalog_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue files to the dictionary of all variables that point to them: one catalogue per brand, in which a size
    may have several parts, the last one counting."""
    path = work_path(spark, "catalogs")
    part = table(spark, sf_dir, "part")
    write_table(
        part.select(
            F.concat(F.lit("Cat "), F.col("p_brand")).alias("catalog"),
            F.col("p_partkey").alias("pos"),
            F.col("p_size").cast("string").alias("clave"),
            F.when(F.substring("p_brand", -1, 1) != "1", F.col("p_type")).alias("clasificacion"),
            F.col("p_name").alias("descripcion"),
        ),
        path,
    )
    variables = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("v"), F.col("n_nationkey").cast("string")).alias("var"),
        F.col("n_name").alias("alias"),
        F.concat(
            F.lit(" CATÁLOGO: BRAND#"), (F.col("n_regionkey") + 1).cast("string"), (F.col("n_nationkey") % 5 + 1).cast("string"), F.lit(":")
        ).alias("fuente"),
    )
    return metadata.catalog_dictionary(variables, "var", "alias", "fuente", read_catalogs(spark, path))


@query
def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit("  Cat Árbol: "), F.col("p_name"), F.lit("  _ "), F.col("p_brand"), F.lit(" Ñandú "))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        source_name_normalized(raw).alias("source"),
        catalog_name_normalized(F.concat(F.lit("Cat "), F.col("p_type"), F.lit(" cat é"))).alias("catalog"),
    )


@query
def fold_accents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts in four languages."""
    return table(spark, sf_dir, "documents").select("doc_id", accents_folded(F.col("text")).alias("folded"))


@query
def options_to_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    options = F.concat(
        F.lit("{'options': {'1': 'Sí', 'k"), size, F.lit("': '"), F.col("p_type"), F.lit("', 'x': None}, 'n': True}")
    )
    values = (
        F.when(F.col("p_size") < 10, F.lit("{'type': 'int'}"))
        .when(F.col("p_size") < 15, F.lit("{'options': {}}"))
        .otherwise(options)
    )
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey"),
        F.when(F.col("p_type") == "PROMO", "municipio").otherwise(F.col("p_name")).alias("var"),
        F.lit("abierta").alias("var_type"),
        values.alias("values"),
    )
    return metadata.with_option_lists(rows).select(
        "p_partkey", "var", "var_type", metadata.SURVEY_KEYS, metadata.SURVEY_LABELS, "dtype",
        F.get(F.map_keys("options"), F.lit(1)).alias("second_option"),
    )


# Whole pipelines


@query
def registry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Microdata to wide aggregates and dictionary to the bins of every translated code."""
    preparation, blocks, wide = registry_wide(spark, sf_dir)
    dictionary = block_dictionaries(preparation, blocks, "alias", "etiquetas")
    strata = Stratifier({"mun": cut_lineage(wide)}, dictionary, "traduccion", "variable", IDS)
    return bin_table(strata.process_regex(["mun"], {None: "^.*"}, BINS))


@query
def registry_files_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from specifications and files, aggregates and scale in long form."""
    folder = work_path(spark, "registry")
    write_table(microdata(spark, sf_dir), f"{folder}/microdata")
    write_table(described(spark).coalesce(1), f"{folder}/metadata")
    run_preparation(
        spark,
        {
            "ruta_csv_dataset": f"{folder}/microdata",
            "ruta_csv_metadatos": f"{folder}/metadata",
            "ruta_salida_dataset": f"{folder}/aggregates",
            "ruta_salida_diccionario_traducciones": f"{folder}/dictionary",
            "columna_metadatos_nombres": "var",
            "columna_metadatos_posibles_valores": "valores",
            "columna_metadatos_alias": "alias",
            "columna_metadatos_posibles_valores_alias": "etiquetas",
            "variables_identificadoras_list": IDS,
            "variables_a_agrupar": REGISTRY_BLOCKS,
            "forma_larga": True,
        },
    )
    result = run_stratification(
        spark,
        {
            "rutas_csv_escalas": {"mun": f"{folder}/aggregates"},
            "ruta_csv_diccionario_traducciones": f"{folder}/dictionary",
            "columna_diccionario_traducciones_nombres": "traduccion",
            "columna_diccionario_traducciones_alias": "variable",
            "variables_identificadoras": IDS,
            "variables_a_procesar_regex": {"None": "^.*"},
            "q": BINS,
            "ruta_csv_salida": f"{folder}/bins",
            "forma_larga": True,
        },
    )
    return bin_table(result)


def survey_blocks() -> list[dict]:
    by_class = {"variables_a_agrupar_list": [], "variables_a_agrupar_regex": []}
    return [
        {
            **by_class,
            "tipo_variables": "categorico",
            "variables_a_agrupar_clasificacion_metadatos": {"columna_metadatos_filtro": "clase", "valores": ["options"]},
        },
        *(
            {
                **by_class,
                "tipo_variables": "numerico",
                "operacion": operation,
                "variables_a_agrupar_clasificacion_metadatos": {"columna_metadatos_filtro": "clase", "valores": ["abierta"]},
            }
            for operation in ("media", "mediana")
        ),
    ]


@query
def survey_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a household survey: variables chosen by metadata class, shares of the row count."""
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("municipio"), "event_type", F.col("value").cast("string").alias("value")
    )
    described_rows = [
        ("event_type", "Evento", "options", "['click', 'error', 'purchase', 'view']", "['Clic', 'Error', 'Compra', 'Vista']"),
        ("value", "Valor", "abierta", "[]", "[]"),
    ]
    described_events = local_table(spark, ["var", "alias", "clase", "valores", "etiquetas"], described_rows)
    padded = cleaning.pad_columns(rows, {"municipio": 4})
    preparation = Preparation(padded, described_events, "var", "valores").blanks_to_null()
    blocks = [resolve_block(preparation, block) for block in survey_blocks()]
    wide, _ = aggregate_blocks(preparation, ["municipio"], blocks)
    dictionary = block_dictionaries(preparation, blocks, "alias", "etiquetas")
    strata = Stratifier({"geo": cut_lineage(wide)}, dictionary, "traduccion", "variable", ["municipio"])
    requests = strata.requests_from_regex(["geo"], {TOTAL: "^event_type", None: "^(media|mediana|conteo)"})
    return bin_table(strata.cut(["geo"], requests, 4))
