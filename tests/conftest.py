import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from retail_rows import SALES, SF, day, money  # noqa: E402
from shelfline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from shelfline.sources.driver_tables import DriverTables
    return DriverTables(spark, SF)


@pytest.fixture(scope="session")
def make_sales(spark):
    return lambda rows: spark.createDataFrame(rows, SALES)


@pytest.fixture(scope="session")
def stores(spark):
    rows = [(1, "One", "North", "Supermarket", 50000, day("2020-01-01")), (2, "Two", "South", "Hypermarket", 80000, day("2019-06-15")),
            (3, "Three", "East", "Express", 15000, day("2021-03-01"))]
    return spark.createDataFrame(rows, "store_id INT, store_name STRING, region STRING, store_format STRING, size_sqft INT, open_date DATE")


@pytest.fixture(scope="session")
def products(spark):
    rows = [(1, "Cola", "Beverages", "Soda", "A", money("2.99"), money("1.50"), False),
            (2, "Milk", "Dairy", "Fresh", "B", money("4.99"), money("2.50"), True),
            (3, "Chips", "Snacks", "Salty", "C", money("3.49"), money("1.75"), False)]
    return spark.createDataFrame(rows, "product_id INT, product_name STRING, category STRING, subcategory STRING, brand STRING, "
                                       "unit_price DECIMAL(10,2), unit_cost DECIMAL(10,2), is_perishable BOOLEAN")
