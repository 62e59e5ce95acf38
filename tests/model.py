"""The load worked out row by row in plain Python, for small inputs only."""

from __future__ import annotations

import datetime
import re
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

CENT = Decimal("0.01")
# A translation table that must agree.
TRANSLATED_BY_HAND = {
    "pc_gamer": "PC Gamer",
    "portateis_cozinha_e_preparadores_de_alimentos": "Portable Kitchen & Food Processors",
    "": "Uncategorized",
}


CALENDAR_CELL = re.compile(r"(?P<y>[0-9]{4})-(?P<m>[0-9]{1,2})-(?P<d>[0-9]{1,2})(?P<time>\s+[0-9:]+)?")
CLOCK = re.compile(r"\s+(?:[01]?[0-9]|2[0-3]):[0-5]?[0-9]:[0-5]?[0-9]")


def day(text):
    """A calendar date, with or without a time of day behind it."""
    cell = CALENDAR_CELL.fullmatch(text.strip())
    if not cell or (cell["time"] and not CLOCK.fullmatch(cell["time"])):
        return None
    year, month, number_of_day = int(cell["y"]), int(cell["m"]), int(cell["d"])
    if not (1 <= month <= 12 and year):
        return None
    first = datetime.date(year, month, 1)
    found = first + datetime.timedelta(days=number_of_day - 1)
    return found if number_of_day and found.month == month else None


def number(text):
    if not re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", text.strip()):
        return None
    try:
        return Decimal(text.strip())
    except InvalidOperation:
        return None


def cents(value):
    return None if value is None else value.quantize(CENT, ROUND_HALF_UP)


def key(date):
    return None if date is None else date.year * 10000 + date.month * 100 + date.day


def load(raw):
    """(fact rows with natural keys, reject reasons, dims, calendar keys) from lists of dicts."""
    owner = {r["customer_id"]: r["customer_unique_id"] for r in raw["clientes"]}
    customers, products, sellers = {}, {}, {}
    for r in raw["clientes"]:
        customers.setdefault(
            r["customer_unique_id"], (r["customer_city"] or None, r["customer_state"] or None)
        )
    english = {}
    for r in raw["traducao"]:
        english.setdefault(r["product_category_name"], r["product_category_name_english"])
    for r in raw["produtos"]:
        name = r["product_category_name"].strip()
        text = english.get(name, "")
        if not text.strip():
            text = TRANSLATED_BY_HAND.get(name, name)
        products.setdefault(r["product_id"], (name or "uncategorized", text or None))
    for r in raw["vendedores"]:
        sellers.setdefault(r["seller_id"], (r["seller_city"] or None, r["seller_state"] or None))

    review = {}
    for r in raw["avaliacoes"]:
        date = day(r["review_answer_timestamp"]) or datetime.date.min
        best = review.get(r["order_id"])
        if best is None or date > best[0]:
            review[r["order_id"]] = (date, number(r["review_score"]))

    payments = defaultdict(list)
    for r in raw["pagamentos"]:
        value = number(r["payment_value"]) or Decimal(0)
        times = number(r["payment_installments"]) or Decimal(0)
        payments[r["order_id"]].append((value, r["payment_type"], times or Decimal(1)))

    item_count = Counter(r["order_id"] for r in raw["itens"])
    orders = defaultdict(list)
    reasons = Counter()
    for r in raw["pedidos"]:
        if day(r["order_purchase_timestamp"]) is None:
            reasons["no_purchase_date"] += 1
        else:
            orders[r["order_id"]].append(r)

    facts, days = [], set()
    for item in raw["itens"]:
        for order in orders[item["order_id"]]:
            bought = day(order["order_purchase_timestamp"])
            delivered = day(order["order_delivered_customer_date"])
            days |= {d for d in (bought, delivered) if d}
            price, freight = number(item["price"]), number(item["freight_value"])
            unique = owner.get(order["customer_id"])
            bad = []
            if unique is None:
                bad.append("unknown_customer")
            if item["product_id"] not in products:
                bad.append("unknown_product")
            if item["seller_id"] not in sellers:
                bad.append("unknown_seller")
            if price is None:
                bad.append("no_price")
            if bad:
                reasons.update(bad)
                continue
            paid = payments.get(item["order_id"])
            kind = times = value = None
            if paid:
                top = max(p[0] for p in paid)
                kind = next(p[1] for p in paid if p[0] == top) or None
                times = int(max(p[2] for p in paid))
                value = cents(sum(p[0] for p in paid))
            score = review.get(item["order_id"], (None, None))[1]
            waited = (delivered - bought).days if delivered else None
            facts.append(
                {
                    "order_id": item["order_id"],
                    "id_data_compra": key(bought),
                    "id_data_entrega": key(delivered),
                    "customer_unique_id": unique,
                    "product_id": item["product_id"],
                    "seller_id": item["seller_id"],
                    "status_pedido": order["order_status"] or None,
                    "valor_produto": cents(price),
                    "valor_frete": cents(freight),
                    "valor_total": None if freight is None else cents(price + freight),
                    "tipo_pagamento": kind,
                    "parcelas": times,
                    "valor_pago": value,
                    "nota_avaliacao": None if score is None else int(score),
                    "qtd_itens": item_count[item["order_id"]],
                    "dias_para_entrega": None if waited is None or waited < 0 else waited,
                }
            )
    dims = {"dim_cliente": customers, "dim_produto": products, "dim_vendedor": sellers}
    return facts, reasons, dims, {key(d) for d in days}
