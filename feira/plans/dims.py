"""Dimension builders. None of them has surrogate ids yet (see operators.keys)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.functions import calendar, clean
from feira.operators.dedup import keep_first
from feira.operators.sizing import Limits, table_sizes
from feira.operators.skew import hot_keys, spread_join
from feira.schema import DIM_DATA, ROW_SEQ


def customers(raw: dict[str, DataFrame], limits: Limits = Limits()) -> DataFrame:
    """customer_unique_id, cidade, estado: first row per customer."""
    kept = keep_first(raw["clientes"], "customer_unique_id", ["customer_city", "customer_state"])
    return kept.select(
        "customer_unique_id",
        clean.blank_to_null(F.col("customer_city")).alias("cidade"),
        clean.blank_to_null(F.col("customer_state")).alias("estado"),
    )


def products(raw: dict[str, DataFrame], limits: Limits = Limits()) -> DataFrame:
    """product_id, categoria, categoria_en: first row per product, translated.

    Product categories are trimmed, translation keys are not. Both sides are
    reduced to one row per key before they meet, so a repeated translation
    cannot multiply products. One category may hold a third of the products, so
    the translation is broadcast once measured small, else its hot keys spread.
    """
    kept = keep_first(raw["produtos"], "product_id", ["product_category_name"]).select(
        "product_id", clean.strip(F.col("product_category_name")).alias("categoria")
    )
    translation = keep_first(
        raw["traducao"], "product_category_name", ["product_category_name_english"]
    ).select(
        F.col("product_category_name").alias("categoria"),
        F.col("product_category_name_english").alias("_english"),
    )
    category = F.col("categoria")
    size = table_sizes({"traducao": raw["traducao"].drop(ROW_SEQ)})["traducao"]
    if size.bytes <= limits.max_broadcast_bytes:
        named = kept.join(F.broadcast(translation), "categoria", "left")
    else:
        hot = hot_keys(kept, "categoria", kept.count(), limits.min_hot_rows)
        named = spread_join(kept, translation, hot, "left", "product_id")
    return named.select(
        "product_id",
        clean.named_category(category).alias("categoria"),
        clean.blank_to_null(clean.translated_category(category, F.col("_english"))).alias(
            "categoria_en"
        ),
    )


def sellers(raw: dict[str, DataFrame], limits: Limits = Limits()) -> DataFrame:
    """seller_id, cidade, estado: first row per seller."""
    kept = keep_first(raw["vendedores"], "seller_id", ["seller_city", "seller_state"])
    return kept.select(
        "seller_id",
        clean.blank_to_null(F.col("seller_city")).alias("cidade"),
        clean.blank_to_null(F.col("seller_state")).alias("estado"),
    )


def calendar_days(facts: DataFrame) -> DataFrame:
    """dim_data: the days that occur as a purchase or delivery date in `facts`.

    One scan of the two key columns; duplicates go away on the map side.
    """
    key = F.explode(F.array("id_data_compra", "id_data_entrega"))
    days = (
        facts.select(key.alias("id_data"))
        .filter(F.col("id_data").isNotNull())
        .distinct()
        .withColumn("data", clean.date_from_key(F.col("id_data")))
    )
    date = F.col("data")
    attributes = {
        "id_data": F.col("id_data"),
        "data": date,
        "dia": F.dayofmonth(date),
        "mes": F.month(date),
        "nome_mes": calendar.month_name(date),
        "trimestre": F.quarter(date),
        "ano": F.year(date),
        "dia_semana_num": calendar.weekday_number(date),
        "dia_semana_nome": calendar.weekday_name(date),
        "fim_de_semana": calendar.is_weekend(date),
    }
    return days.select(*[attributes[f.name].cast(f.dataType).alias(f.name) for f in DIM_DATA])
