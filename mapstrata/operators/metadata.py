"""Preparation of metadata tables: catalogues looked up by name, survey options spread to lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mapstrata.functions.literals import list_to_text, options_from_text
from mapstrata.functions.text import catalog_name_normalized, source_name_normalized
from mapstrata.operators.joins import joined_with_few
from mapstrata.operators.translate import first_description
from mapstrata.session import column, cut_lineage

# Columns that the prepared metadata gets.
LABELS, KEYS = "POSIBLES VALORES", "POSIBLES VALORES ALIAS"
SURVEY_KEYS, SURVEY_LABELS = "posibles_valores_alias", "posibles_valores"


def catalog_lists(catalogs: DataFrame) -> DataFrame:
    """catalog, labels, keys: arrays in catalogue order.

    Labels come from ``clasificacion`` if the catalogue has that column, else from
    ``descripcion``, else there are none. The array per catalogue is the result itself, stored as
    one metadata cell, so a catalogue is as large as one list of category values; ``catalog_pages`` has no such limit.
    """
    entry = F.struct("pos", "clave", "clasificacion", "descripcion")
    gathered = catalogs.groupBy(catalog_name_normalized(F.col("catalog")).alias("catalog")).agg(
        F.sort_array(F.collect_list(entry)).alias("entries"),
        F.count("clasificacion").alias("classified"),
        F.count("descripcion").alias("described"),
    )
    return gathered.select(
        "catalog",
        F.when(F.col("classified") > 0, F.transform("entries", lambda e: e["clasificacion"]))
        .when(F.col("described") > 0, F.transform("entries", lambda e: e["descripcion"]))
        .otherwise(F.array().cast("array<string>"))
        .alias("labels"),
        F.transform("entries", lambda e: e["clave"]).alias("keys"),
    )


def catalog_pages(catalogs: DataFrame, entries_per_page: int) -> DataFrame:
    """catalog, ``page``, labels, keys: the lists of ``catalog_lists`` cut in pages of so many entries, for catalogues of any size.

    Entries are dealt to slices of their order, which are written, since a second evaluation might draw other limits. An entry's
    rank is its place in its slice plus the entries of the slices before it, summed from one count per slice.
    """
    if isinstance(entries_per_page, bool) or not isinstance(entries_per_page, int):
        raise TypeError("the number of entries per page must be an int")
    if entries_per_page < 1:
        raise ValueError("the number of entries per page must be at least 1")
    order = ["pos", "clave", "clasificacion", "descripcion"]
    parts = int(catalogs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = catalogs.select(catalog_name_normalized(F.col("catalog")).alias("catalog"), *order)
    dealt = rows.repartitionByRange(parts, "catalog", *order).withColumn("slice", F.spark_partition_id())
    dealt = cut_lineage(dealt)
    held = dealt.groupBy("catalog", "slice").agg(
        F.count(F.lit(1)).alias("held"),
        (F.count("clasificacion") > 0).alias("classified"),
        (F.count("descripcion") > 0).alias("described"),
    )
    whole = Window.partitionBy("catalog")
    earlier = whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = held.select(
        "catalog",
        "slice",
        F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"),
        F.bool_or("classified").over(whole).alias("classified"),
        F.bool_or("described").over(whole).alias("described"),
    )
    within = Window.partitionBy("catalog", "slice").orderBy(*order)
    placed = dealt.withColumn("place", F.row_number().over(within) - 1)
    ranked = joined_with_few(placed, slices, ["catalog", "slice"], [F.col("place")]).withColumn("rank", F.col("before") + F.col("place"))
    label = F.when(F.col("classified"), F.col("clasificacion")).otherwise(F.col("descripcion"))
    entry = F.struct("rank", "clave", label.alias("label"))
    pages = ranked.groupBy("catalog", F.floor(F.col("rank") / entries_per_page).alias("page")).agg(
        F.sort_array(F.collect_list(entry)).alias("entries"), F.bool_or(F.col("classified") | F.col("described")).alias("labelled")
    )
    return pages.select(
        "catalog",
        "page",
        F.when(F.col("labelled"), F.transform("entries", lambda e: e["label"])).otherwise(F.array().cast("array<string>")).alias("labels"),
        F.transform("entries", lambda e: e["clave"]).alias("keys"),
    )


def with_catalog_values(
    metadata: DataFrame, source_column: str, catalogs: DataFrame, entries_per_page: int | None = None
) -> DataFrame:
    """Metadata with cleaned source names and the value lists of the catalogue each row points to,
    empty for rows that point to none. With ``entries_per_page`` a column ``page`` and one row per page, so that no cell grows
    with a catalogue."""
    cleaned = metadata.withColumn(source_column, source_name_normalized(column(source_column)))
    paged = entries_per_page is not None
    lists = catalog_pages(catalogs, entries_per_page) if paged else catalog_lists(catalogs)
    lists = lists.withColumnRenamed("catalog", source_column)
    nothing = F.array().cast("array<string>")
    page = [F.coalesce("page", F.lit(0)).alias("page")] if paged else []
    return (
        cleaned.join(lists, source_column, "left")
        .withColumn(LABELS, list_to_text(F.coalesce("labels", nothing)))
        .withColumn(KEYS, list_to_text(F.coalesce("keys", nothing)))
        .select(*[column(c) for c in metadata.columns], *page, column(LABELS), column(KEYS))
    )


def catalog_dictionary(
    metadata: DataFrame, names_column: str, alias_column: str, source_column: str, catalogs: DataFrame
) -> DataFrame:
    """``variable-key`` to ``alias-label`` of every variable and catalogue row its source points to, as
    ``with_catalog_values`` and the categorical dictionary give it, but never holding a catalogue as one list.

    Only the first metadata row of a variable counts, and the last row of a key in its catalogue.
    """
    described = first_description(metadata, names_column).select(
        column(names_column).alias("name"),
        column(alias_column).alias("alias"),
        source_name_normalized(column(source_column)).alias("catalog"),
    )
    rows = catalogs.withColumn("catalog", catalog_name_normalized(F.col("catalog")))
    filled = rows.groupBy("catalog").agg(
        (F.count("clasificacion") > 0).alias("classified"), (F.count("descripcion") > 0).alias("described")
    )
    labelled = joined_with_few(rows, filled, ["catalog"], [F.col("pos")]).filter(F.col("classified") | F.col("described"))
    label = F.when(F.col("classified"), F.col("clasificacion")).otherwise(F.col("descripcion"))
    last = labelled.groupBy("catalog", F.coalesce("clave", F.lit("None")).alias("key")).agg(
        F.max_by(F.coalesce(label, F.lit("None")), F.struct("pos", "clasificacion", "descripcion")).alias("label")
    )
    return joined_with_few(last, described, ["catalog"], [F.col("key")]).select(
        F.concat_ws("-", "name", "key").alias("variable"), F.concat_ws("-", "alias", "label").alias("traduccion")
    )


def with_option_lists(
    metadata: DataFrame, values_column: str = "values", names_column: str = "var", types_column: str = "var_type",
    option_variables: tuple[str, ...] = ("municipio",),
) -> DataFrame:
    """Survey metadata with the options of each variable as key list, value list and map.

    ``option_variables`` are given the type ``options`` whatever was declared; every variable is
    stored as text.
    """
    options = options_from_text(column(values_column))
    nothing = F.array().cast("array<string>")
    return (
        metadata.withColumn("options", options)
        .withColumn(SURVEY_KEYS, list_to_text(F.coalesce(F.map_keys("options"), nothing)))
        .withColumn(SURVEY_LABELS, list_to_text(F.coalesce(F.map_values("options"), nothing)))
        .withColumn(
            types_column,
            F.when(column(names_column).isin(*option_variables), "options").otherwise(column(types_column)),
        )
        .withColumn("dtype", F.lit("str"))
    )
