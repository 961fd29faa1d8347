"""Small rows for the retail tests."""

import datetime as dt
from decimal import Decimal

SF = "/root/testdata/sf0.001"


def day(text):
    return dt.date.fromisoformat(text)


def money(text):
    return Decimal(text)


SALES = ("transaction_id BIGINT, date DATE, store_id INT, product_id INT, customer_id INT, quantity INT, "
         "unit_price DECIMAL(10,2), discount_applied BOOLEAN, discount_percent INT, total_amount DECIMAL(12,2)")


def sale(tid, date, store=1, product=1, customer=1, qty=1, amount="10.00", pct=0):
    return (tid, day(date), store, product, customer, qty, money(amount) / max(qty, 1), pct > 0, pct, money(amount))
