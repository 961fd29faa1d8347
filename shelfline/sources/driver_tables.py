"""Maps the order / line item tables to the retail star schema of ``schemas.py``.

The operators know only the retail schema; this adapter is the one place that knows the other
tables. Derived dimensions use plain integer arithmetic so that SQL engines agree on every value.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = ["Supermarket", "Hypermarket", "Express", "Online"]
CONDITIONS = ["Clear", "Cloudy", "Fog", "Hot", "Rain", "Snow", "Storm", "Windy"]
EPOCH = "1995-01-01"


def pick(values: list[str], index: Column) -> Column:
    """The element of a short fixed list at a 0-based index."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


@dataclass(frozen=True)
class DriverTables:
    """Lazy retail views over one data directory."""

    spark: SparkSession
    path: str

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    def _sales_base(self) -> DataFrame:
        percent = F.round(F.col("l_discount") * 100).cast("int")
        # Exact decimal product: engines round ties of a double product differently.
        # Up to 18 digits a decimal is stored as one long.
        amount = (F.col("l_extendedprice").cast("decimal(12,2)")
                  * (F.lit(100) - percent).cast("decimal(3,0)")
                  * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,4)")
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("transaction_id"),
            F.col("l_shipdate").cast("date").alias("date"),
            F.col("l_suppkey").alias("store_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
            (F.col("l_discount") > 0).alias("discount_applied"),
            percent.alias("discount_percent"),
            amount.alias("total_amount"))

    @property
    def sales(self) -> DataFrame:
        """Fact without the customer: no join with orders is paid for."""
        return self._sales_base()

    @property
    def customer_sales(self) -> DataFrame:
        """Fact with the nullable customer id (low priority orders count as anonymous)."""
        orders = self.raw("orders").select(
            F.col("o_orderkey").alias("transaction_id"),
            F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("customer_id"))
        return self._sales_base().join(orders, "transaction_id")

    @property
    def order_sales(self) -> DataFrame:
        """One row per order with a unique key, as the upsert target and stream source need it."""
        percent = F.col("o_custkey") % 11
        return self.raw("orders").select(
            F.col("o_orderkey").alias("transaction_id"),
            F.col("o_orderdate").cast("date").alias("date"),
            F.col("o_custkey").alias("customer_id"),
            (F.col("o_orderkey") % 50 + 1).cast("int").alias("quantity"),
            percent.cast("int").alias("discount_percent"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
            F.col("o_orderstatus").alias("status"))

    @property
    def stores(self) -> DataFrame:
        nation = self.raw("nation").join(
            self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        key = F.col("s_suppkey")
        return self.raw("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
            key.alias("store_id"), F.col("s_name").alias("store_name"), F.col("r_name").alias("region"),
            pick(FORMATS, key % 4).alias("store_format"),
            (5000 + (key * 7919) % 145000).cast("int").alias("size_sqft"),
            F.date_add(F.lit("1990-01-01").cast("date"), ((key * 37) % 1800).cast("int")).alias("open_date"))

    @property
    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"), F.col("p_brand").alias("subcategory"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
            (F.col("p_retailprice").cast("decimal(10,2)") * F.lit("0.60").cast("decimal(3,2)")).alias("unit_cost"),
            (F.col("p_size") <= 12).alias("is_perishable"))

    @property
    def customers(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").cast("decimal(12,2)").alias("lifetime_value"))

    @property
    def date_bounds(self) -> DataFrame:
        return self.sales.agg(F.min("date").alias("start_date"), F.max("date").alias("end_date"))

    @property
    def calendar(self) -> DataFrame:
        from shelfline.functions.calendar import calendar_dimension
        return calendar_dimension(self.date_bounds)

    @staticmethod
    def _weather(pairs: DataFrame) -> DataFrame:
        d = F.datediff("date", F.lit(EPOCH))
        s = F.col("store_id").cast("int")
        wet = (d * 11 + s * 5) % 100
        high = (20 + (d * 7 + s * 13) % 80).cast("int")
        return pairs.select(
            "date", "store_id", high.alias("temp_high_f"),
            (high - 5 - (d + s * 3) % 20).cast("int").alias("temp_low_f"),
            F.when(wet < 60, F.lit(0)).otherwise(wet - 59).cast("decimal(5,0)").alias("wet"),
            (30 + (d * 3 + s * 17) % 65).cast("int").alias("humidity_percent"),
            pick(CONDITIONS, (d * 5 + s * 3) % 8).alias("conditions"),
        ).withColumn("precipitation_inches",
                     (F.col("wet") * F.lit("0.05").cast("decimal(3,2)")).cast("decimal(5,2)")).drop("wet")

    @staticmethod
    def _promotions(sales: DataFrame, least: int) -> DataFrame:
        runs = (sales.where(F.col("discount_percent") >= least)
                .groupBy("store_id", "product_id", F.col("date").alias("start_date"))
                .agg(F.max("discount_percent").alias("discount_percent")))
        return runs.select("store_id", "product_id", "discount_percent", "start_date",
                           F.date_add("start_date", (F.col("product_id") % 14).cast("int")).alias("end_date"))

    @property
    def weather(self) -> DataFrame:
        return self._weather(self.sales.select("date", "store_id").distinct())

    @property
    def promotions(self) -> DataFrame:
        return self._promotions(self.sales, 8)

    # Forecast grain: (region, brand) series have a sale on most days, (store, product) pairs do not.

    @property
    def series_sales(self) -> DataFrame:
        """Fact at forecast grain: ``store_id`` is the region key, ``product_id`` the brand number."""
        nation = self.raw("nation").select("n_nationkey", F.col("n_regionkey").alias("store_id"))
        store = self.raw("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("_store"), "store_id")
        product = self.raw("part").select(
            F.col("p_partkey").alias("_product"), self._brand().alias("product_id"))
        fact = self._sales_base().withColumnsRenamed({"store_id": "_store", "product_id": "_product"})
        return fact.join(store, "_store").join(product, "_product").drop("_store", "_product")

    @staticmethod
    def _brand() -> Column:
        return F.substring_index("p_brand", "#", -1).cast("int")

    @property
    def series_stores(self) -> DataFrame:
        key = F.col("r_regionkey")
        return self.raw("region").select(
            key.alias("store_id"), F.col("r_name").alias("region"), pick(FORMATS, key % 4).alias("store_format"),
            (20000 + key * 7919).cast("int").alias("size_sqft"))

    @property
    def series_products(self) -> DataFrame:
        return self.raw("part").groupBy(self._brand().alias("product_id")).agg(
            F.min("p_type").alias("category"), F.min("p_brand").alias("subcategory"),
            F.min("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
            (F.min("p_size") <= 1).alias("is_perishable"))

    @property
    def series_weather(self) -> DataFrame:
        return self._weather(self.series_sales.select("date", "store_id").distinct())

    @property
    def series_promotions(self) -> DataFrame:
        return self._promotions(self.series_sales, 10)
