"""Table contracts: raw inputs (all text) and the five star tables."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: names of the raw inputs and of their columns -------------
RAW_COLUMNS = {
    "pedidos": (
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_delivered_customer_date",
    ),
    "itens": ("order_id", "product_id", "seller_id", "price", "freight_value"),
    "clientes": ("customer_id", "customer_unique_id", "customer_city", "customer_state"),
    "produtos": ("product_id", "product_category_name"),
    "vendedores": ("seller_id", "seller_city", "seller_state"),
    "avaliacoes": ("order_id", "review_score", "review_answer_timestamp"),
    "pagamentos": ("order_id", "payment_type", "payment_installments", "payment_value"),
    "traducao": ("product_category_name", "product_category_name_english"),
}

# Position of a raw row in its file. Every raw table carries it, because
# "first row wins" and tie-breaks need an explicit order in Spark.
ROW_SEQ = "row_seq"

MONEY = T.DecimalType(12, 2)
# The contract stores the paid value as MONEY too. The sum of an order's payments
# is kept wider, so that a sum beyond the contract is found by the range rule.
MONEY_SUM = T.DecimalType(18, 2)
MONEY_LIMIT = 10**10

DIM_DATA = T.StructType(
    [
        T.StructField("id_data", T.IntegerType()),
        T.StructField("data", T.DateType()),
        T.StructField("dia", T.ShortType()),
        T.StructField("mes", T.ShortType()),
        T.StructField("nome_mes", T.StringType()),
        T.StructField("trimestre", T.ShortType()),
        T.StructField("ano", T.ShortType()),
        T.StructField("dia_semana_num", T.ShortType()),
        T.StructField("dia_semana_nome", T.StringType()),
        T.StructField("fim_de_semana", T.BooleanType()),
    ]
)

DIM_CLIENTE = T.StructType(
    [
        T.StructField("id_cliente", T.LongType()),
        T.StructField("customer_unique_id", T.StringType()),
        T.StructField("cidade", T.StringType()),
        T.StructField("estado", T.StringType()),
    ]
)

DIM_PRODUTO = T.StructType(
    [
        T.StructField("id_produto", T.LongType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("categoria", T.StringType()),
        T.StructField("categoria_en", T.StringType()),
    ]
)

DIM_VENDEDOR = T.StructType(
    [
        T.StructField("id_vendedor", T.LongType()),
        T.StructField("seller_id", T.StringType()),
        T.StructField("cidade", T.StringType()),
        T.StructField("estado", T.StringType()),
    ]
)

# The four counters of the fact are SMALLINT in the contract. They are stored
# wider so that an oversized value (an order with 40,000 items) is kept and
# reported by the range rule instead of being lost.
FATO_PEDIDO = T.StructType(
    [
        T.StructField("id_fato", T.LongType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("id_data_compra", T.IntegerType()),
        T.StructField("id_data_entrega", T.IntegerType()),
        T.StructField("id_cliente", T.LongType()),
        T.StructField("id_produto", T.LongType()),
        T.StructField("id_vendedor", T.LongType()),
        T.StructField("status_pedido", T.StringType()),
        T.StructField("valor_produto", MONEY),
        T.StructField("valor_frete", MONEY),
        T.StructField("valor_total", MONEY),
        T.StructField("tipo_pagamento", T.StringType()),
        T.StructField("parcelas", T.LongType()),
        T.StructField("valor_pago", MONEY_SUM),
        T.StructField("nota_avaliacao", T.LongType()),
        T.StructField("qtd_itens", T.LongType()),
        T.StructField("dias_para_entrega", T.IntegerType()),
    ]
)

# Purchase month (yyyymm): the directory the fact is partitioned by.
FACT_PARTITION = "mes_compra"
# The customer's state, stored with the fact: the state slicer and the reports by
# state read it there. A reload rebuilds it together with the dimension.
FACT_STATE = "estado_cliente"

MONEY_TOTAL = T.DecimalType(22, 2)
# One row per order, as its item rows describe it, with the sums of these. An order_id
# that stands for several orders has a row for each. Derived from the fact by the load.
ORDER_COLUMNS = (
    "order_id",
    "id_data_compra",
    "id_data_entrega",
    "id_cliente",
    "status_pedido",
    "tipo_pagamento",
    "valor_pago",
    "nota_avaliacao",
    "dias_para_entrega",
    FACT_STATE,
    FACT_PARTITION,
)
_ORDER_SUMS = (
    T.StructField("itens", T.LongType()),
    T.StructField("soma_produto", MONEY_TOTAL),
    T.StructField("itens_produto", T.LongType()),
    T.StructField("soma_frete", MONEY_TOTAL),
    T.StructField("soma_total", MONEY_TOTAL),
)
_PHYSICAL = {
    FACT_STATE: T.StructField(FACT_STATE, T.StringType()),
    FACT_PARTITION: T.StructField(FACT_PARTITION, T.IntegerType()),
}
RESUMO_PEDIDO = T.StructType(
    [
        *[_PHYSICAL.get(c) or FATO_PEDIDO[c] for c in ORDER_COLUMNS if c != FACT_PARTITION],
        *_ORDER_SUMS,
        _PHYSICAL[FACT_PARTITION],
    ]
)
SUMMARY = "resumo_pedido"

STAR_TABLES = {
    "dim_data": DIM_DATA,
    "dim_cliente": DIM_CLIENTE,
    "dim_produto": DIM_PRODUTO,
    "dim_vendedor": DIM_VENDEDOR,
    "fato_pedido": FATO_PEDIDO,
}

PRIMARY_KEYS = {
    "dim_data": "id_data",
    "dim_cliente": "id_cliente",
    "dim_produto": "id_produto",
    "dim_vendedor": "id_vendedor",
    "fato_pedido": "id_fato",
}

NATURAL_KEYS = {
    "dim_cliente": "customer_unique_id",
    "dim_produto": "product_id",
    "dim_vendedor": "seller_id",
}

FOREIGN_KEYS = (
    ("id_data_compra", "dim_data", "id_data"),
    ("id_data_entrega", "dim_data", "id_data"),
    ("id_cliente", "dim_cliente", "id_cliente"),
    ("id_produto", "dim_produto", "id_produto"),
    ("id_vendedor", "dim_vendedor", "id_vendedor"),
)

NOT_NULL = {
    "dim_data": tuple(DIM_DATA.fieldNames()),
    "dim_cliente": ("id_cliente", "customer_unique_id"),
    "dim_produto": ("id_produto", "product_id"),
    "dim_vendedor": ("id_vendedor", "seller_id"),
    "fato_pedido": (
        "id_fato",
        "order_id",
        "id_data_compra",
        "id_cliente",
        "id_produto",
        "id_vendedor",
        "valor_produto",
        "qtd_itens",
    ),
}

# What files are compressed with; about two thirds of the size that Spark's default makes.
COMPRESSION = "zstd"

MAX_LENGTH = {
    "dim_data": {"nome_mes": 15, "dia_semana_nome": 15},
    "dim_cliente": {"customer_unique_id": 50, "cidade": 100, "estado": 2},
    "dim_produto": {"product_id": 50, "categoria": 100, "categoria_en": 100},
    "dim_vendedor": {"seller_id": 50, "cidade": 100, "estado": 2},
    "fato_pedido": {"order_id": 50, "status_pedido": 30, "tipo_pagamento": 30},
}

SMALLINT_RANGE = (-32768, 32767)
SMALLINT_COLUMNS = {
    "fato_pedido": ("parcelas", "nota_avaliacao", "qtd_itens", "dias_para_entrega"),
}
