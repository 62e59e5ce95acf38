"""Independent SQL for every registered query: one DuckDB statement each.

Each statement starts from the given tables: raw inputs as CTEs, then the star
with natural keys instead of surrogate ids, then the report. Latest and largest
rows come from row_number(), averages and shares from integer arithmetic.
"""

from __future__ import annotations

RAW = """
raw_pedidos AS (
SELECT CAST(o_orderkey AS VARCHAR(50)) AS order_id,
       CAST(o_custkey AS VARCHAR(50)) || '-' || CAST(o_orderkey % 3 AS VARCHAR(5)) AS customer_id,
       CASE WHEN o_orderstatus = 'F' THEN 'delivered'
            WHEN o_orderstatus = 'O' THEN 'shipped'
            WHEN o_orderpriority = '1-URGENT' THEN 'canceled'
            WHEN o_orderpriority = '2-HIGH' THEN 'unavailable'
            WHEN o_orderpriority = '5-LOW' THEN ''
            ELSE 'delivered' END AS order_status,
       CASE WHEN o_orderkey % 97 = 0 THEN ''
            WHEN o_orderkey % 89 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10))
            WHEN o_orderkey % 83 = 0 THEN 'not a date'
            ELSE ' ' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) || ' 10:11:12 ' END
            AS order_purchase_timestamp,
       CASE WHEN o_orderkey % 11 = 0 THEN ''
            ELSE CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey * 7 % 40 - 3 AS INT) AS VARCHAR(10))
                 || ' 23:59:59' END AS order_delivered_customer_date
FROM orders),
raw_itens AS (
SELECT CAST(l_orderkey AS VARCHAR(50)) AS order_id,
       CAST(l_partkey AS VARCHAR(50)) AS product_id,
       CAST(l_suppkey AS VARCHAR(50)) AS seller_id,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR(20)) AS price,
       CASE WHEN l_quantity = 13 THEN '-'
            WHEN l_quantity = 17 THEN ''
            WHEN l_quantity = 19 THEN 'nan'
            ELSE CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2))
                 AS DECIMAL(12,2)) AS VARCHAR(20)) END AS freight_value
FROM lineitem),
raw_clientes AS (
SELECT CAST(c_custkey AS VARCHAR(50)) || '-' || CAST(k AS VARCHAR(5)) AS customer_id,
       CAST(c_custkey AS VARCHAR(50)) AS customer_unique_id,
       CASE WHEN c_custkey % 50 = 0 THEN '' ELSE c_mktsegment || ' ' || CAST(k AS VARCHAR(5)) END
            AS customer_city,
       CASE WHEN c_nationkey = 24 THEN '' ELSE CAST((c_nationkey + k) % 25 + 10 AS VARCHAR(2)) END
            AS customer_state,
       c_custkey * 3 + k AS row_seq
FROM (SELECT *, unnest([0, 1, 2]) AS k FROM customer)
WHERE NOT (c_custkey % 40 = 7 AND k = 2)),
raw_produtos AS (
SELECT CAST(p_partkey AS VARCHAR(50)) AS product_id,
       CASE WHEN p_size % 10 = 0 THEN '  '
            WHEN p_size = 7 THEN 'pc_gamer'
            ELSE lower(p_type) || ' ' END AS product_category_name,
       p_partkey AS row_seq
FROM part WHERE p_partkey % 101 <> 100),
raw_vendedores AS (
SELECT CAST(s_suppkey AS VARCHAR(50)) AS seller_id,
       CASE WHEN s_suppkey % 10 = 0 THEN '' ELSE n_name END AS seller_city,
       CAST(s_nationkey + 10 AS VARCHAR(2)) AS seller_state,
       s_suppkey AS row_seq
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 37 <> 36),
raw_avaliacoes AS (
SELECT CAST(l_orderkey AS VARCHAR(50)) AS order_id,
       CASE WHEN l_quantity = 50 THEN 'x' ELSE CAST(CAST(l_quantity AS INT) % 5 + 1 AS VARCHAR(5)) END
            AS review_score,
       CASE WHEN l_linenumber = 7 THEN ''
            ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR(10)) || ' 08:00:00' END
            AS review_answer_timestamp,
       l_partkey * 100000 + l_suppkey * 100 + CAST(l_quantity AS INT) AS row_seq
FROM lineitem WHERE l_linenumber IN (1, 2, 7)),
raw_pagamentos AS (
SELECT CAST(l_orderkey AS VARCHAR(50)) AS order_id,
       CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' ELSE 'voucher' END
            AS payment_type,
       CASE WHEN l_linenumber = 6 THEN 'n/a' ELSE CAST(l_linenumber - 1 AS VARCHAR(5)) END
            AS payment_installments,
       CASE WHEN l_quantity > 40 THEN 'bad'
            ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR(20)) END AS payment_value,
       l_partkey * 100000 + l_suppkey * 100 + CAST(l_quantity AS INT) AS row_seq
FROM lineitem WHERE l_orderkey % 19 <> 0),
raw_traducao AS (
SELECT 'economy' AS product_category_name, 'Economy' AS product_category_name_english
UNION ALL SELECT 'medium', 'Medium' UNION ALL SELECT 'small', 'Small'
UNION ALL SELECT 'large', '' UNION ALL SELECT 'promo', 'Promo')"""


def _date(text: str) -> str:
    return (
        f"CASE WHEN regexp_full_match(trim({text}), "
        r"'\d{4}-\d{1,2}-\d{1,2}( +\d{1,2}:\d{1,2}:\d{1,2})?') "
        f"THEN TRY_CAST(split_part(trim({text}), ' ', 1) AS DATE) END"
    )


def _number(text: str) -> str:
    return f"TRY_CAST(trim({text}) AS DECIMAL(18,2))"


def _day_key(date: str) -> str:
    return f"CAST(year({date}) * 10000 + month({date}) * 100 + day({date}) AS BIGINT)"


def ratio(numerator: str, denominator: str, digits: int) -> str:
    """Quotient rounded half away from zero; both inputs whole once the numerator is scaled."""
    scale = 10**digits
    above, below = (f"abs(CAST(({x}) AS HUGEINT))" for x in (f"({numerator}) * {scale}", denominator))
    sign = f"(CASE WHEN (({numerator}) < 0) <> (({denominator}) < 0) THEN -1 ELSE 1 END)"
    return (
        f"(CASE WHEN ({denominator}) <> 0 THEN {sign} * CAST((2 * {above} + {below})"
        f" // (2 * {below}) AS DOUBLE) / {scale} END)"
    )


def mean(column: str, digits: int) -> str:
    return ratio(f"sum({column})", f"count({column})", digits)


def share(part: str, total: str) -> str:
    """Percentage with two digits; both sides in cents."""
    return ratio(f"100 * CAST(({part}) * 100 AS HUGEINT)", f"CAST(({total}) * 100 AS HUGEINT)", 2)


STAR = f"""
pedidos AS (
SELECT order_id, customer_id, nullif(order_status, '') AS status_pedido,
       {_date("order_purchase_timestamp")} AS data_compra,
       {_date("order_delivered_customer_date")} AS data_entrega
FROM raw_pedidos),
dono AS (
SELECT customer_id, customer_unique_id FROM raw_clientes
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY row_seq DESC) = 1),
dim_cliente AS (
SELECT customer_unique_id, nullif(customer_city, '') AS cidade, nullif(customer_state, '') AS estado
FROM raw_clientes
QUALIFY row_number() OVER (PARTITION BY customer_unique_id ORDER BY row_seq) = 1),
dim_produto AS (
SELECT product_id,
       CASE WHEN nome = '' THEN 'uncategorized' ELSE nome END AS categoria,
       CASE WHEN trim(coalesce(product_category_name_english, '')) <> '' THEN product_category_name_english
            WHEN nome = 'pc_gamer' THEN 'PC Gamer'
            WHEN nome = 'portateis_cozinha_e_preparadores_de_alimentos'
                 THEN 'Portable Kitchen & Food Processors'
            WHEN nome = '' THEN 'Uncategorized'
            ELSE nome END AS categoria_en
FROM (SELECT product_id, row_seq, trim(product_category_name) AS nome FROM raw_produtos) p
LEFT JOIN raw_traducao t ON t.product_category_name = p.nome
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY row_seq) = 1),
dim_vendedor AS (
SELECT seller_id, nullif(seller_city, '') AS cidade, nullif(seller_state, '') AS estado
FROM raw_vendedores
QUALIFY row_number() OVER (PARTITION BY seller_id ORDER BY row_seq) = 1),
avaliacao AS (
SELECT order_id, CAST(trunc({_number("review_score")}) AS BIGINT) AS nota
FROM raw_avaliacoes
QUALIFY row_number() OVER (PARTITION BY order_id
        ORDER BY {_date("review_answer_timestamp")} DESC NULLS LAST, row_seq, nota NULLS FIRST) = 1),
pagamento_linha AS (
SELECT order_id, payment_type, row_seq,
       coalesce({_number("payment_value")}, 0) AS valor,
       CASE WHEN coalesce({_number("payment_installments")}, 0) = 0 THEN 1
            ELSE {_number("payment_installments")} END AS vezes
FROM raw_pagamentos),
pagamento_tipo AS (
SELECT order_id, payment_type FROM pagamento_linha
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY valor DESC, row_seq, payment_type) = 1),
pagamento AS (
SELECT s.order_id, t.payment_type AS tipo_pagamento, s.parcelas, s.valor_pago
FROM (SELECT order_id, CAST(trunc(max(vezes)) AS BIGINT) AS parcelas, sum(valor) AS valor_pago
      FROM pagamento_linha GROUP BY order_id) s
JOIN pagamento_tipo t ON t.order_id = s.order_id),
qtd AS (SELECT order_id, count(*) AS qtd_itens FROM raw_itens GROUP BY order_id),
juntos AS (
SELECT i.order_id, p.data_compra, p.data_entrega, p.status_pedido,
       c.customer_unique_id, c.estado AS estado_cliente,
       d.product_id, d.categoria, d.categoria_en,
       v.seller_id, v.cidade AS cidade_vendedor, v.estado AS estado_vendedor,
       i.valor_produto, i.valor_frete, i.valor_produto + i.valor_frete AS valor_total,
       g.tipo_pagamento, g.parcelas, g.valor_pago, a.nota AS nota_avaliacao, q.qtd_itens,
       CASE WHEN p.data_entrega >= p.data_compra
            THEN date_diff('day', p.data_compra, p.data_entrega) END AS dias_para_entrega
FROM (SELECT order_id, product_id, seller_id,
             CAST({_number("price")} AS DECIMAL(12,2)) AS valor_produto,
             CAST({_number("freight_value")} AS DECIMAL(12,2)) AS valor_frete
      FROM raw_itens) i
JOIN pedidos p ON p.order_id = i.order_id AND p.data_compra IS NOT NULL
LEFT JOIN dono o ON o.customer_id = p.customer_id
LEFT JOIN dim_cliente c ON c.customer_unique_id = o.customer_unique_id
LEFT JOIN dim_produto d ON d.product_id = i.product_id
LEFT JOIN dim_vendedor v ON v.seller_id = i.seller_id
LEFT JOIN avaliacao a ON a.order_id = i.order_id
LEFT JOIN pagamento g ON g.order_id = i.order_id
LEFT JOIN qtd q ON q.order_id = i.order_id),
aceitos AS (
SELECT * FROM juntos
WHERE customer_unique_id IS NOT NULL AND product_id IS NOT NULL AND seller_id IS NOT NULL
  AND valor_produto IS NOT NULL),
dias AS (
SELECT data_compra AS data FROM juntos
UNION SELECT data_entrega FROM juntos WHERE data_entrega IS NOT NULL),
dim_data AS (
SELECT {_day_key("data")} AS id_data, data,
       day(data) AS dia, month(data) AS mes, (month(data) - 1) // 3 + 1 AS trimestre,
       year(data) AS ano, isodow(data) - 1 AS dia_semana_num,
       -- fixed values: month and weekday names
       ['Janeiro', 'Fevereiro', 'Março', 'Abril', 'Maio', 'Junho', 'Julho', 'Agosto', 'Setembro',
        'Outubro', 'Novembro', 'Dezembro'][month(data)] AS nome_mes,
       ['Segunda-feira', 'Terça-feira', 'Quarta-feira', 'Quinta-feira', 'Sexta-feira', 'Sábado',
        'Domingo'][isodow(data)] AS dia_semana_nome,
       isodow(data) >= 6 AS fim_de_semana
FROM dias)"""

ALL_FACTS = "fato AS (SELECT * FROM aceitos)"
ACTIVE = "status_pedido NOT IN ('canceled', 'unavailable')"


def sliced_facts(date_from: str, date_to: str, states: tuple[str | None, ...]) -> str:
    return (
        f"fato AS (SELECT * FROM aceitos WHERE data_compra BETWEEN DATE '{date_from}' "
        f"AND DATE '{date_to}' AND {in_states(states)})"
    )


def in_states(states: tuple[str | None, ...]) -> str:
    listed = ", ".join(f"'{s}'" for s in states if s is not None)
    blank = " OR estado_cliente IS NULL" if None in states else ""
    return f"(estado_cliente IN ({listed}){blank})"


def _statement(body: str, facts: str = ALL_FACTS) -> str:
    return f"WITH {RAW.strip()},\n{STAR.strip()},\n{facts}\n{body.strip()}"


def _big(column: str, name: str | None = None) -> str:
    return f"CAST({column} AS BIGINT) AS {name or column}"


def _dbl(column: str, name: str | None = None) -> str:
    return f"CAST({column} AS DOUBLE) AS {name or column}"


ORDERS = _big("count(DISTINCT order_id)", "qtd_pedidos")

ROW_COUNTS = """
SELECT 'dim_data' AS tabela, count(*) AS total FROM dim_data
UNION ALL SELECT 'dim_cliente', count(*) FROM dim_cliente
UNION ALL SELECT 'dim_produto', count(*) FROM dim_produto
UNION ALL SELECT 'dim_vendedor', count(*) FROM dim_vendedor
UNION ALL SELECT 'fato_pedido', count(*) FROM fato"""

REPORTS = {
    "row_counts": ROW_COUNTS,
    "revenue_by_month": f"""
SELECT {_big("ano")}, {_big("mes")}, nome_mes, {ORDERS},
       {_dbl("sum(valor_produto)", "receita_produtos")}, {_dbl("sum(valor_frete)", "receita_frete")},
       {_dbl("sum(valor_total)", "faturamento_total")},
       {mean("valor_produto", 2)} AS ticket_medio_produto
FROM fato JOIN dim_data d ON d.data = fato.data_compra
WHERE {ACTIVE} GROUP BY ano, mes, nome_mes ORDER BY ano, mes""",
    "top_categories": f"""
, por_categoria AS (
SELECT categoria_en AS categoria, count(*) AS qtd_itens, count(DISTINCT order_id) AS qtd_pedidos,
       sum(valor_produto) AS faturamento, {mean("valor_produto", 2)} AS ticket_medio
FROM fato WHERE {ACTIVE} GROUP BY categoria_en)
SELECT categoria, {_big("qtd_itens")}, {_big("qtd_pedidos")}, {_dbl("faturamento")}, ticket_medio,
       {share("faturamento", "(SELECT sum(faturamento) FROM por_categoria)")} AS pct_total
FROM por_categoria ORDER BY por_categoria.faturamento DESC, categoria LIMIT 10""",
    "orders_by_status": f"""
, por_status AS (
SELECT status_pedido, count(DISTINCT order_id) AS n FROM fato GROUP BY status_pedido)
SELECT status_pedido, {_big("n", "qtd_pedidos")},
       {share("n", "(SELECT sum(n) FROM por_status)")} AS pct
FROM por_status ORDER BY n DESC, status_pedido""",
    "review_distribution": f"""
, por_nota AS (
SELECT nota_avaliacao, count(*) AS n FROM fato WHERE nota_avaliacao IS NOT NULL GROUP BY nota_avaliacao)
SELECT {_big("nota_avaliacao")}, {_big("n", "qtd")},
       {share("n", "(SELECT sum(n) FROM por_nota)")} AS pct
FROM por_nota ORDER BY nota_avaliacao""",
    "review_mean": f"""
SELECT {mean("nota_avaliacao", 2)} AS nota_media FROM fato WHERE nota_avaliacao IS NOT NULL""",
    "delivery_by_state": f"""
SELECT estado_cliente AS estado, {_big("count(DISTINCT order_id)", "pedidos_entregues")},
       {mean("dias_para_entrega", 1)} AS prazo_medio_dias,
       {_big("min(dias_para_entrega)", "prazo_minimo")}, {_big("max(dias_para_entrega)", "prazo_maximo")}
FROM fato WHERE status_pedido = 'delivered' AND dias_para_entrega IS NOT NULL
GROUP BY estado_cliente ORDER BY prazo_medio_dias DESC, estado""",
    "top_states": f"""
SELECT estado_cliente AS estado, {_big("count(DISTINCT customer_unique_id)", "qtd_clientes")}, {ORDERS},
       {_dbl("sum(valor_total)", "faturamento_total")}, {mean("valor_produto", 2)} AS ticket_medio
FROM fato WHERE {ACTIVE} GROUP BY estado_cliente
ORDER BY sum(valor_total) DESC NULLS FIRST, estado LIMIT 10""",
    "top_sellers": f"""
SELECT seller_id, cidade_vendedor, estado_vendedor, {ORDERS},
       {_dbl("sum(valor_produto)", "faturamento")}, {mean("nota_avaliacao", 2)} AS nota_media,
       {mean("dias_para_entrega", 1)} AS prazo_medio_dias
FROM fato WHERE {ACTIVE} GROUP BY seller_id, cidade_vendedor, estado_vendedor
ORDER BY sum(valor_produto) DESC, seller_id LIMIT 10""",
    "orders_by_weekday": f"""
SELECT {_big("dia_semana_num")}, dia_semana_nome, {ORDERS}, {mean("valor_produto", 2)} AS ticket_medio
FROM fato JOIN dim_data d ON d.data = fato.data_compra
GROUP BY dia_semana_num, dia_semana_nome ORDER BY dia_semana_num""",
    "score_vs_delivery": f"""
SELECT {_big("nota_avaliacao")}, {_big("count(*)", "qtd_pedidos")},
       {mean("dias_para_entrega", 1)} AS prazo_medio_dias, {mean("valor_produto", 2)} AS ticket_medio
FROM fato WHERE nota_avaliacao IS NOT NULL AND dias_para_entrega IS NOT NULL
  AND status_pedido = 'delivered'
GROUP BY nota_avaliacao ORDER BY nota_avaliacao""",
    "revenue_by_quarter": f"""
SELECT {_big("ano")}, {_big("trimestre")}, {ORDERS},
       {_dbl("sum(valor_total)", "faturamento_total")}, {mean("valor_produto", 2)} AS ticket_medio
FROM fato JOIN dim_data d ON d.data = fato.data_compra
WHERE {ACTIVE} GROUP BY ano, trimestre ORDER BY ano, trimestre""",
    "payment_methods": f"""
, por_tipo AS (
SELECT tipo_pagamento, count(DISTINCT order_id) AS n, sum(valor_pago) AS pago,
       {mean("valor_pago", 2)} AS ticket_medio
FROM fato WHERE tipo_pagamento IS NOT NULL GROUP BY tipo_pagamento)
SELECT tipo_pagamento, {_big("n", "qtd_pedidos")}, {_dbl("pago", "valor_total_pago")}, ticket_medio,
       {share("n", "(SELECT sum(n) FROM por_tipo)")} AS pct_pedidos
FROM por_tipo ORDER BY n DESC, tipo_pagamento""",
    "card_installments": f"""
SELECT {_big("parcelas")}, {_big("count(*)", "qtd_itens")}, {mean("valor_pago", 2)} AS ticket_medio
FROM fato WHERE tipo_pagamento = 'credit_card' AND parcelas IS NOT NULL
GROUP BY parcelas ORDER BY parcelas""",
}

DASHBOARD = {
    "kpi_cards": f"""
SELECT {_big("count(DISTINCT order_id)", "total_pedidos")},
       {_dbl(f"sum(valor_total) FILTER (WHERE {ACTIVE})", "faturamento_total")},
       {ratio(f"sum(valor_produto) FILTER (WHERE {ACTIVE})",
              f"count(valor_produto) FILTER (WHERE {ACTIVE})", 2)} AS ticket_medio,
       {mean("nota_avaliacao", 2)} AS nota_media,
       {share("count(DISTINCT order_id) FILTER (WHERE status_pedido = 'delivered')",
              "count(DISTINCT order_id)")} AS taxa_entrega
FROM fato""",
    "top_categories_total": f"""
SELECT categoria, {_dbl("sum(valor_total)", "faturamento_total")}
FROM fato WHERE {ACTIVE} GROUP BY categoria
ORDER BY sum(valor_total) DESC NULLS FIRST, categoria LIMIT 10""",
    "category_share_top5": f"""
, por_categoria AS (
SELECT categoria, sum(valor_total) AS total,
       row_number() OVER (ORDER BY sum(valor_total) DESC NULLS FIRST, categoria) AS lugar
FROM fato WHERE {ACTIVE} GROUP BY categoria)
SELECT CASE WHEN lugar <= 5 THEN categoria ELSE 'Outros' END AS categoria,
       {_big("least(lugar, 6)", "posicao")}, {_dbl("sum(total)", "faturamento_total")},
       {share("sum(total)", "(SELECT sum(total) FROM por_categoria)")} AS pct
FROM por_categoria GROUP BY 1, 2 ORDER BY posicao""",
    "ticket_by_category": f"""
SELECT categoria, {mean("valor_produto", 2)} AS ticket_medio
FROM fato WHERE {ACTIVE} GROUP BY categoria ORDER BY ticket_medio DESC, categoria""",
    "revenue_by_state": f"""
SELECT estado_cliente AS estado, {_dbl("sum(valor_total)", "faturamento_total")}
FROM fato WHERE {ACTIVE} GROUP BY estado_cliente
ORDER BY sum(valor_total) DESC NULLS FIRST, estado""",
    "role_dates": f"""
SELECT 'compra' AS papel, {_big("ano")}, {_big("mes")}, {_big("count(*)", "qtd_itens")}, {ORDERS}
FROM fato JOIN dim_data d ON d.data = fato.data_compra GROUP BY ano, mes
UNION ALL
SELECT 'entrega', {_big("ano")}, {_big("mes")}, {_big("count(*)", "qtd_itens")}, {ORDERS}
FROM fato LEFT JOIN dim_data d ON d.data = fato.data_entrega GROUP BY ano, mes""",
}

STAR_PIECES = {
    "dim_date": f"""
SELECT id_data, CAST(data AS VARCHAR) AS data, {_big("dia")}, {_big("mes")}, nome_mes,
       {_big("trimestre")}, {_big("ano")}, {_big("dia_semana_num")}, dia_semana_nome, fim_de_semana
FROM dim_data""",
    "dim_customer": "SELECT customer_unique_id, cidade, estado FROM dim_cliente",
    "dim_product": "SELECT product_id, categoria, categoria_en FROM dim_produto",
    "dim_seller": "SELECT seller_id, cidade, estado FROM dim_vendedor",
    "fact_rows": f"""
SELECT order_id, {_day_key("data_compra")} AS id_data_compra, {_day_key("data_entrega")} AS id_data_entrega,
       customer_unique_id, product_id, seller_id, status_pedido, {_dbl("valor_produto")},
       {_dbl("valor_frete")}, {_dbl("valor_total")}, tipo_pagamento, {_big("parcelas")},
       {_dbl("valor_pago")}, {_big("nota_avaliacao")}, {_big("qtd_itens")}, {_big("dias_para_entrega")}
FROM fato""",
    "clean_orders": """
SELECT order_id, customer_id, status_pedido, CAST(data_compra AS VARCHAR) AS data_compra,
       CAST(data_entrega AS VARCHAR) AS data_entrega,
       CASE WHEN data_entrega >= data_compra THEN date_diff('day', data_compra, data_entrega) END
           AS dias_para_entrega
FROM pedidos WHERE data_compra IS NOT NULL""",
    "clean_items": f"""
SELECT order_id, product_id, seller_id, {_dbl(_number("price"), "valor_produto")},
       {_dbl(_number("freight_value"), "valor_frete")},
       {_dbl(f"{_number('price')} + {_number('freight_value')}", "valor_total")}
FROM raw_itens""",
    "customer_owner": "SELECT customer_id, customer_unique_id FROM dono",
    "seller_append": """
SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, n_name AS cidade,
       CAST(s_nationkey + 10 AS VARCHAR) AS estado
FROM supplier JOIN nation ON s_nationkey = n_nationkey
WHERE CAST(s_suppkey AS VARCHAR) NOT IN (SELECT seller_id FROM dim_vendedor)""",
    "latest_review": f"SELECT order_id, {_big('nota', 'review_score')} FROM avaliacao",
    "order_payment": f"""
SELECT order_id, tipo_pagamento, {_big("parcelas")}, {_dbl("valor_pago")} FROM pagamento""",
    "items_per_order": f"SELECT order_id, {_big('qtd_itens')} FROM qtd",
    "reject_reasons": """
SELECT 'no_purchase_date' AS reason, count(*) AS rows FROM pedidos WHERE data_compra IS NULL
UNION ALL SELECT 'unknown_customer', count(*) FROM juntos WHERE customer_unique_id IS NULL
UNION ALL SELECT 'unknown_product', count(*) FROM juntos WHERE product_id IS NULL
UNION ALL SELECT 'unknown_seller', count(*) FROM juntos WHERE seller_id IS NULL
UNION ALL SELECT 'no_price', count(*) FROM juntos WHERE valor_produto IS NULL""",
    "surrogate_key_props": """
SELECT "table", n AS rows, CAST(1 AS BIGINT) AS smallest, n AS largest, n AS distinct_ids
FROM (SELECT 'dim_cliente' AS "table", count(*) AS n FROM dim_cliente
      UNION ALL SELECT 'dim_produto', count(*) FROM dim_produto
      UNION ALL SELECT 'dim_vendedor', count(*) FROM dim_vendedor
      UNION ALL SELECT 'fato_pedido', count(*) FROM fato)""",
}
STAR_PIECES["csv_round_trip"] = STAR_PIECES["fact_rows"]
STAR_PIECES["fact_rows_appended"] = STAR_PIECES["fact_rows"]
STAR_PIECES["seller_append_published"] = f"""
, todos AS (
    SELECT seller_id, cidade, estado, FALSE AS added, TRUE AS old_id FROM dim_vendedor
    UNION ALL SELECT seller_id, cidade, estado, TRUE, FALSE FROM ({STAR_PIECES["seller_append"].strip()})
)
SELECT *, (SELECT count(*) FROM todos) AS largest_id,
       -- without a new seller nothing is published
       CAST(1 + (SELECT max(CAST(added AS INTEGER)) FROM todos) AS BIGINT) AS versions
FROM todos"""


def _row_rule(table: str, source: str, rule: str, condition: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, '{table}' AS \"table\", "
        f"CAST(coalesce(sum(CASE WHEN {condition} THEN 1 ELSE 0 END), 0) AS BIGINT) AS violations "
        f"FROM {source}"
    )


def _unique(table: str, source: str, rule: str, key: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, '{table}' AS \"table\", "
        f"CAST(count(*) - count(DISTINCT {key}) AS BIGINT) AS violations FROM {source}"
    )


def _orphans(rule: str, key: str, source: str, dim_key: str) -> str:
    return (
        f"SELECT 'foreign_key {rule}' AS rule, 'fato_pedido' AS \"table\", "
        f"CAST(count(*) AS BIGINT) AS violations FROM fato WHERE {key} IS NOT NULL "
        f"AND {key} NOT IN (SELECT {dim_key} FROM {source})"
    )


def _longer(**limits: int) -> str:
    return " OR ".join(f"length({c}) > {n}" for c, n in limits.items())


def _quality(names: dict[str, str] = {}, repeated_fact: str = "order_id IS NULL") -> str:
    """Rules over the star; `names` gives other sources, `repeated_fact` tells copied rows."""
    dims = {
        "dim_cliente": "customer_unique_id",
        "dim_produto": "product_id",
        "dim_vendedor": "seller_id",
    }
    parts = [
        _unique("dim_data", names.get("dim_data", "dim_data"), "primary_key", "id_data"),
        # ids are made by numbering the rows, so the row itself stands for its id
        _row_rule("fato_pedido", "fato", "primary_key", repeated_fact),
    ]
    for table, key in dims.items():
        parts.append(_unique(table, names.get(table, table), "primary_key", key))
        parts.append(_unique(table, names.get(table, table), "natural_key", key))
    parts += [
        _orphans("id_data_compra", "data_compra", names.get("dim_data", "dim_data"), "data"),
        _orphans("id_data_entrega", "data_entrega", names.get("dim_data", "dim_data"), "data"),
        _orphans("id_cliente", "customer_unique_id", "dim_cliente", "customer_unique_id"),
        _orphans("id_produto", "product_id", "dim_produto", "product_id"),
        _orphans("id_vendedor", "seller_id", "dim_vendedor", "seller_id"),
        _row_rule(
            "dim_data",
            "dim_data",
            "not_null",
            "id_data IS NULL OR data IS NULL OR nome_mes IS NULL OR dia_semana_nome IS NULL",
        ),
        _row_rule("dim_cliente", "dim_cliente", "not_null", "customer_unique_id IS NULL"),
        _row_rule("dim_produto", "dim_produto", "not_null", "product_id IS NULL"),
        _row_rule("dim_vendedor", "dim_vendedor", "not_null", "seller_id IS NULL"),
        _row_rule(
            "fato_pedido",
            "fato",
            "not_null",
            "order_id IS NULL OR data_compra IS NULL OR customer_unique_id IS NULL "
            "OR product_id IS NULL OR seller_id IS NULL OR valor_produto IS NULL OR qtd_itens IS NULL",
        ),
        _row_rule(
            "dim_data", "dim_data", "text_length", _longer(nome_mes=15, dia_semana_nome=15)
        ),
        _row_rule(
            "dim_cliente",
            names.get("dim_cliente", "dim_cliente"),
            "text_length",
            _longer(customer_unique_id=50, cidade=100, estado=2),
        ),
        _row_rule(
            "dim_produto",
            "dim_produto",
            "text_length",
            _longer(product_id=50, categoria=100, categoria_en=100),
        ),
        _row_rule(
            "dim_vendedor", "dim_vendedor", "text_length", _longer(seller_id=50, cidade=100, estado=2)
        ),
        _row_rule(
            "fato_pedido",
            "fato",
            "text_length",
            _longer(order_id=50, status_pedido=30, tipo_pagamento=30),
        ),
        _row_rule(
            "fato_pedido",
            "fato",
            "smallint_range",
            " OR ".join(
                f"{c} NOT BETWEEN -32768 AND 32767"
                for c in ("parcelas", "nota_avaliacao", "qtd_itens", "dias_para_entrega")
            ),
        ),
        _row_rule("fato_pedido", "fato", "numeric_range valor_pago", "abs(valor_pago) >= 10000000000"),
    ]
    return "\nUNION ALL ".join(parts)


def _raw_quality() -> str:
    def unreadable(column: str, parsed: str) -> str:
        text = f"trim({column})"
        return f"lower({text}) NOT IN ('', 'nan', 'none', '-') AND {parsed} IS NULL"

    parts = [
        _unique(table, f"raw_{table}", f"repeated {key}", key)
        for table, key in (
            ("pedidos", "order_id"),
            ("clientes", "customer_id"),
            ("produtos", "product_id"),
            ("vendedores", "seller_id"),
        )
    ]
    for table, columns in {
        "pedidos": {"order_purchase_timestamp": _date, "order_delivered_customer_date": _date},
        "itens": {"price": _number, "freight_value": _number},
        "avaliacoes": {"review_score": _number, "review_answer_timestamp": _date},
        "pagamentos": {"payment_installments": _number, "payment_value": _number},
    }.items():
        for column, parse in columns.items():
            condition = unreadable(column, parse(column))
            parts.append(_row_rule(table, f"raw_{table}", f"unreadable {column}", condition))
    return "\nUNION ALL ".join(parts)


def _metrics() -> str:
    raw = ("pedidos", "itens", "clientes", "produtos", "vendedores", "avaliacoes", "pagamentos", "traducao")
    parts = [f"SELECT 'raw' AS stage, '{t}' AS \"table\", count(*) AS rows FROM raw_{t}" for t in raw]
    parts.append(f"SELECT 'reject', reason, rows FROM ({STAR_PIECES['reject_reasons'].strip()})")
    parts.append("SELECT 'joined', 'itens', count(*) FROM juntos")
    parts.append(
        "SELECT 'skipped', 'fato_pedido', (SELECT count(*) FROM juntos) - (SELECT count(*) FROM fato)"
    )
    parts.append(f"SELECT 'star', tabela, total FROM ({ROW_COUNTS.strip()})")
    return "\nUNION ALL ".join(parts)


def _when(n: int, rest: int, value: str, column: str, key: str = "order_id") -> str:
    return f"CASE WHEN CAST({key} AS BIGINT) % {n} = {rest} THEN {value} ELSE {column} END AS {column}"


LONG_TEXT = "repeat('x', 120)"
# The defects of checks.planted.broken_star.
BROKEN_FACTS = f"""
estragos AS (
SELECT * REPLACE ({_when(50, 7, "NULL", "valor_produto")}, {_when(60, 11, "'-1'", "product_id")},
                  {_when(70, 13, "10000000005.00", "valor_pago")}, {_when(40, 3, "40000", "qtd_itens")},
                  {_when(80, 9, LONG_TEXT, "status_pedido")})
FROM aceitos),
fato AS (
SELECT *, false AS repetida FROM estragos
UNION ALL SELECT *, true FROM estragos WHERE CAST(order_id AS BIGINT) % 90 = 21),
vendedores_estragados AS (
SELECT * FROM dim_vendedor
UNION ALL SELECT * FROM dim_vendedor WHERE CAST(seller_id AS BIGINT) % 5 = 0),
clientes_estragados AS (
SELECT * REPLACE ({_when(10, 3, LONG_TEXT, "cidade", "customer_unique_id")}) FROM dim_cliente),
dias_estragados AS (SELECT * FROM dim_data WHERE dia <> 28)"""
BROKEN_NAMES = {
    "dim_data": "dias_estragados",
    "dim_cliente": "clientes_estragados",
    "dim_vendedor": "vendedores_estragados",
}


def _ranges() -> str:
    """Counts of checks.planted.wide_numbers, from the rows it plants in."""

    def planted(rule: str, table: str, *where: tuple[int, int]) -> str:
        hit = " OR ".join(f"CAST(order_id AS BIGINT) % {n} = {rest}" for n, rest in where)
        return _row_rule(table, f"raw_{table}", f"numeric_range {rule}", hit or "false")

    # where the price is planted wide the total is too, unless the freight is missing
    total = _row_rule(
        "itens",
        "raw_itens",
        "numeric_range valor_total",
        "CAST(order_id AS BIGINT) % 30 = 1 OR (CAST(order_id AS BIGINT) % 30 = 2 "
        f"AND {_number('freight_value')} IS NOT NULL)",
    )
    return "\nUNION ALL ".join(
        [
            planted("price", "itens", (30, 2)),
            planted("freight_value", "itens", (30, 3)),
            total,
            planted("payment_value", "pagamentos", (30, 4)),
            planted("payment_installments", "pagamentos", (30, 6)),
            planted("review_score", "avaliacoes", (30, 7)),
        ]
    )


def _times(factor: int) -> str:
    columns = ", ".join(f"{c} * {factor} AS {c}" for c in ("valor_produto", "valor_frete", "valor_total"))
    return f"fato AS (SELECT * REPLACE ({columns}) FROM aceitos)"


def planted_statements(
    slicer: tuple[str, str, tuple[str, ...]],
    blank: tuple[str | None, ...],
    delivered: tuple[str, str],
) -> dict[str, str]:
    """Statements over planted defects, chained slicers, a blank state and delivery dates."""
    between = " AND ".join(f"DATE '{day}'" for day in delivered)
    no_type = f"fato AS (SELECT * REPLACE ({_when(13, 0, 'NULL', 'tipo_pagamento')}) FROM aceitos)"
    return {
        "quality_rules_planted": _join(_quality(BROKEN_NAMES, "repetida"), BROKEN_FACTS.strip()),
        "range_rules_planted": _join(_ranges(), ALL_FACTS),
        "payment_methods_planted": _join(REPORTS["payment_methods"], no_type),
        "category_share_zero_total": _join(DASHBOARD["category_share_top5"], _times(0)),
        "top_categories_refunds": _join(REPORTS["top_categories"], _times(-1)),
        "revenue_by_state_blank": _join(
            DASHBOARD["revenue_by_state"], f"fato AS (SELECT * FROM aceitos WHERE {in_states(blank)})"
        ),
        "kpi_cards_chained": _join(DASHBOARD["kpi_cards"], sliced_facts(*slicer)),
        "role_dates_delivered": _join(
            DASHBOARD["role_dates"],
            f"fato AS (SELECT * FROM aceitos WHERE data_entrega BETWEEN {between})",
        ),
    }


def statements(slicer: tuple[str, str, tuple[str, ...]], sliced: tuple[str, ...]) -> dict[str, str]:
    """Statement per query name; `sliced` names get a `_sliced` twin."""
    bodies = REPORTS | DASHBOARD | STAR_PIECES
    bodies |= {
        "quality_rules": _quality(),
        "raw_quality": _raw_quality(),
        "load_metrics": _metrics(),
    }
    result = {}
    for name, body in bodies.items():
        result[name] = _join(body, ALL_FACTS)
    for name in sliced:
        result[f"{name}_sliced"] = _join(bodies[name], sliced_facts(*slicer))
    return result


def _join(body: str, facts: str) -> str:
    body = body.strip()
    if body.startswith(","):
        return _statement(body[1:].strip(), facts + ",")
    return _statement(body, facts)
