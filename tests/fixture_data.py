"""The ten-order test fixture: ten delivered single-item orders in January 2024.

Order ``i`` (1..10): customer ``c{i}`` → person ``u{i}``; product p1/p2/p3 by
cycle, seller s1/s2 alternating, price 100/150/200 and freight 10/15/20 by
cycle; one payment (credit card for i ≤ 7, boleto after) of 110/165/220 by
cycle; one review with score 5/4/3 by cycle; purchased 2024-01-i 10:00,
delivered two days later, estimated five days later.
"""

from __future__ import annotations

from commerce_marts.sources.schemas import RAW_SCHEMAS

STATES = ["SP", "SP", "RJ", "RJ", "MG", "MG", "SP", "RJ", "SP", "MG"]
CITY = {"SP": "sao paulo", "RJ": "rio de janeiro", "MG": "belo horizonte"}


def _ts(day: int, hm: str) -> str:
    return f"2024-01-{day:02d} {hm}:00"


def ten_order_rows():
    orders, customers, items, payments, reviews = [], [], [], [], []
    for i in range(1, 11):
        oid = f"o{i}"
        orders.append((oid, f"c{i}", "delivered", _ts(i, "10:00"), _ts(i, "10:05"),
                       _ts(i, "15:00"), _ts(i + 2, "10:00"), _ts(i + 5, "00:00")))
        st = STATES[i - 1]
        customers.append((f"c{i}", f"u{i}", str(99 + i), CITY[st], st))
        k = (i - 1) % 3
        items.append((oid, 1, f"p{k + 1}", "s1" if i % 2 else "s2", _ts(i, "12:00"),
                      [100.0, 150.0, 200.0][k], [10.0, 15.0, 20.0][k]))
        payments.append((oid, 1, "credit_card" if i <= 7 else "boleto", 1,
                         [110.0, 165.0, 220.0][k]))
        reviews.append((f"r{i}", oid, [5, 4, 3][k], None, None, None, None))
    products = [("p1", "perfumaria", 10, 100, 1, 100.0, 10.0, 10.0, 10.0),
                ("p2", "artes", 10, 100, 1, 200.0, 10.0, 10.0, 10.0),
                ("p3", "esporte_lazer", 10, 100, 1, 300.0, 10.0, 10.0, 10.0)]
    translation = [("perfumaria", "perfumery"), ("artes", "arts"),
                   ("esporte_lazer", "sports_leisure")]
    sellers = [("s1", "1000", "sao paulo", "SP"), ("s2", "2000", "curitiba", "PR")]
    geolocation = [(z, -23.5, -46.6, "sao paulo", "SP") for z in ("100", "101", "102", "123",
                                                                  "456")]
    return {"orders": orders, "customers": customers, "order_items": items,
            "order_payments": payments, "order_reviews": reviews, "products": products,
            "category_translation": translation, "sellers": sellers,
            "geolocation": geolocation}


def frames(spark, rows: dict) -> dict:
    return {name: spark.createDataFrame(data, RAW_SCHEMAS[name]) for name, data in rows.items()}


def ten_order_sources(spark):
    return frames(spark, ten_order_rows())
