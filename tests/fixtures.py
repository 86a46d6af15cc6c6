"""Small source tables built by hand."""

import datetime as dt

from uptake import schemas

CALENDAR = [dt.date(2025 + (6 + i) // 12, (6 + i) % 12 + 1, 1) for i in range(12)]


def d(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


class Book:
    """Collects rows and turns them into the six source frames."""

    def __init__(self, spark):
        self.spark = spark
        self.rows = {name: [] for name in schemas.RAW}
        self._n = 0

    def _next(self, letter: str) -> str:
        self._n += 1
        return f"{letter}{self._n:05d}"

    def customer(self, cust_id, segment="Enterprise", region="AMER", profile="normal"):
        self.rows["customers"].append((cust_id, f"Name {cust_id}", region, segment, profile))

    def product(self, product_id, platform="sase", model="Model A"):
        number = len(self.rows["products"]) + 1
        self.rows["products"].append((product_id, f"{model} SKU-{number:04d}", platform, "seats"))

    def feature(self, feature_id, product_id, floor=20, deep=80):
        self.rows["features"].append((feature_id, f"Feature {feature_id}", "", product_id, floor, deep))

    def contract(self, cust_id, product_id, start="2025-07-01", end=None, licence=100, arr=1000.0, expansion=False):
        start = d(start)
        end = d(end) if end else start.replace(year=start.year + 1)
        key = self._next("E")
        row = (key, product_id, cust_id, licence, licence, arr / licence if licence else 0.0, arr, start, end, expansion)
        self.rows["entitlements"].append(row)
        return key

    def use(self, contract, cust_id, product_id, months, units, licence=100):
        for month, amount in zip(months, units, strict=False):
            self.rows["consumption"].append(
                (self._next("U"), contract, cust_id, product_id, month, float(amount), licence)
            )

    def events(self, contract, cust_id, product_id, feature_id, months, counts):
        for month, count in zip(months, counts, strict=False):
            self.rows["feature_adoption"].append(
                (self._next("A"), cust_id, contract, product_id, feature_id, month, int(count))
            )

    def raw(self):
        return {name: self.spark.createDataFrame(rows, schemas.RAW[name]) for name, rows in self.rows.items()}


def one_sku(spark, ratios, start="2025-07-01", features=True, events=None, months=None, licence=100, arr=1000.0):
    """One customer with one product and the given utilization per month."""
    book = Book(spark)
    book.customer("C1")
    book.product("P1")
    if features:
        book.feature("F1", "P1")
    key = book.contract("C1", "P1", start=start, licence=licence, arr=arr)
    months = months or CALENDAR
    book.use(key, "C1", "P1", months, [r * 100 for r in ratios], licence)
    if events is not None:
        book.events(key, "C1", "P1", "F1", months, events)
    return book


def mart_rows(spark, book, **options):
    from uptake.plans.marts import customer_sku_month

    rows = customer_sku_month(book.raw(), **options).collect()
    return sorted(rows, key=lambda r: (r["cust_id"], r["product_id"], r["month"]))
