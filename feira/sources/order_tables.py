"""Raw inputs derived from generic order tables.

Maps region/nation/customer/supplier/part/orders/lineitem tables to the eight
raw text inputs, with the defects the cleaning rules are for: blank, padded and
unreadable dates, missing numbers, repeated customers with differing cities,
keys unknown to their tables, ties, and categories without a translation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.schema import RAW_COLUMNS, ROW_SEQ
from feira.sources.local_rows import local_frame


# Tables whose rows are at the place that they have in the given files; nothing depends on
# the order of their `row_seq`.
IN_FILE_ORDER = ("pedidos", "itens")


def _text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def _cents(column: str) -> Column:
    return F.col(column).cast("decimal(12,2)")


def _file_position() -> Column:
    """Differs between all rows of a table; nothing depends on its order."""
    return F.xxhash64("_metadata.file_path", "_metadata.row_index")


def _line_position() -> Column:
    """Unique within an order while suppliers stay below 1,000.

    Beyond that two lines may share a position; such ties are settled by content.
    """
    return (
        F.col("l_partkey") * 100000 + F.col("l_suppkey") * 100 + F.col("l_quantity").cast("int")
    )


def _orders(orders: DataFrame) -> DataFrame:
    key, status, priority = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    day = F.col("o_orderdate").cast("date")
    return orders.select(
        _text(key).alias("order_id"),
        F.concat(_text("o_custkey"), F.lit("-"), _text(key % 3)).alias("customer_id"),
        F.when(status == "F", "delivered")
        .when(status == "O", "shipped")
        .when(priority == "1-URGENT", "canceled")
        .when(priority == "2-HIGH", "unavailable")
        .when(priority == "5-LOW", "")
        .otherwise("delivered")
        .alias("order_status"),
        F.when(key % 97 == 0, "")
        .when(key % 89 == 0, _text(day))
        .when(key % 83 == 0, "not a date")
        .otherwise(F.concat(F.lit(" "), _text(day), F.lit(" 10:11:12 ")))
        .alias("order_purchase_timestamp"),
        F.when(key % 11 == 0, "")
        .otherwise(
            F.concat(
                _text(F.date_add(day, (key * 7 % 40 - 3).cast("int"))),
                F.lit(" 23:59:59"),
            )
        )
        .alias("order_delivered_customer_date"),
        _file_position().alias(ROW_SEQ),
    )


def _items(lineitem: DataFrame) -> DataFrame:
    quantity = F.col("l_quantity")
    freight = (_cents("l_extendedprice") * F.col("l_tax").cast("decimal(4,2)")).cast(
        "decimal(12,2)"
    )
    return lineitem.select(
        _text("l_orderkey").alias("order_id"),
        _text("l_partkey").alias("product_id"),
        _text("l_suppkey").alias("seller_id"),
        _text(_cents("l_extendedprice")).alias("price"),
        F.when(quantity == 13, "-")
        .when(quantity == 17, "")
        .when(quantity == 19, "nan")
        .otherwise(_text(freight))
        .alias("freight_value"),
        _file_position().alias(ROW_SEQ),
    )


def _customers(customer: DataFrame) -> DataFrame:
    key, nation, copy = F.col("c_custkey"), F.col("c_nationkey"), F.col("k")
    copies = customer.select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k"))
    return copies.filter(~((key % 40 == 7) & (copy == 2))).select(
        F.concat(_text(key), F.lit("-"), _text(copy)).alias("customer_id"),
        _text(key).alias("customer_unique_id"),
        F.when(key % 50 == 0, "")
        .otherwise(F.concat(F.col("c_mktsegment"), F.lit(" "), _text(copy)))
        .alias("customer_city"),
        F.when(nation == 24, "").otherwise(_text((nation + copy) % 25 + 10)).alias("customer_state"),
        (key * 3 + copy).alias(ROW_SEQ),
    )


def _products(part: DataFrame) -> DataFrame:
    size = F.col("p_size")
    return part.filter(F.col("p_partkey") % 101 != 100).select(
        _text("p_partkey").alias("product_id"),
        F.when(size % 10 == 0, "  ")
        .when(size == 7, "pc_gamer")
        .otherwise(F.concat(F.lower("p_type"), F.lit(" ")))
        .alias("product_category_name"),
        F.col("p_partkey").alias(ROW_SEQ),
    )


def _sellers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    key = F.col("s_suppkey")
    return (
        supplier.filter(key % 37 != 36)
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            _text(key).alias("seller_id"),
            F.when(key % 10 == 0, "").otherwise(F.col("n_name")).alias("seller_city"),
            _text(F.col("s_nationkey") + 10).alias("seller_state"),
            key.alias(ROW_SEQ),
        )
    )


def _reviews(lineitem: DataFrame) -> DataFrame:
    quantity = F.col("l_quantity")
    return lineitem.filter(F.col("l_linenumber").isin(1, 2, 7)).select(
        _text("l_orderkey").alias("order_id"),
        F.when(quantity == 50, "x")
        .otherwise(_text(quantity.cast("int") % 5 + 1))
        .alias("review_score"),
        F.when(F.col("l_linenumber") == 7, "")
        .otherwise(F.concat(_text(F.col("l_shipdate").cast("date")), F.lit(" 08:00:00")))
        .alias("review_answer_timestamp"),
        _line_position().alias(ROW_SEQ),
    )


def _payments(lineitem: DataFrame) -> DataFrame:
    flag = F.col("l_returnflag")
    return lineitem.filter(F.col("l_orderkey") % 19 != 0).select(
        _text("l_orderkey").alias("order_id"),
        F.when(flag == "A", "credit_card")
        .when(flag == "N", "boleto")
        .otherwise("voucher")
        .alias("payment_type"),
        F.when(F.col("l_linenumber") == 6, "n/a")
        .otherwise(_text(F.col("l_linenumber") - 1))
        .alias("payment_installments"),
        F.when(F.col("l_quantity") > 40, "bad")
        .otherwise(_text(_cents("l_extendedprice")))
        .alias("payment_value"),
        _line_position().alias(ROW_SEQ),
    )


def _translation(spark: SparkSession) -> DataFrame:
    pairs = [
        ("economy", "Economy"),
        ("medium", "Medium"),
        ("small", "Small"),
        ("large", ""),
        ("promo", "Promo"),
    ]
    rows = [(name, english, n) for n, (name, english) in enumerate(pairs)]
    schema = T.StructType(
        [
            T.StructField("product_category_name", T.StringType()),
            T.StructField("product_category_name_english", T.StringType()),
            T.StructField(ROW_SEQ, T.LongType()),
        ]
    )
    return local_frame(spark, rows, schema)


def raw_from_order_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The eight raw tables, lazily, from the parquet tables in `sf_dir`."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    lineitem = table("lineitem")
    raw = {
        "pedidos": _orders(table("orders")),
        "itens": _items(lineitem),
        "clientes": _customers(table("customer")),
        "produtos": _products(table("part")),
        "vendedores": _sellers(table("supplier"), table("nation")),
        "avaliacoes": _reviews(lineitem),
        "pagamentos": _payments(lineitem),
        "traducao": _translation(spark),
    }
    return {name: df.select(*RAW_COLUMNS[name], ROW_SEQ) for name, df in raw.items()}
