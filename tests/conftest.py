import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

RUN_TS = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def run_ts():
    return RUN_TS


@pytest.fixture
def food(spark):
    """Nine foods with gaps in three columns."""
    rows = [
        (0, "Apple Honeycrisp raw", None, "Low", None, 52), (1, "Banana medium", "Fruit", None, 62, 89),
        (2, "Chicken breast grilled skinless", None, "Low", None, 165), (3, "Broccoli steamed", None, None, 15, 34),
        (4, "Quinoa cooked", None, None, 53, 120), (5, "Greek yogurt plain", "Dairy", None, None, 59),
        (6, "Salmon Atlantic baked", None, "Low", None, 206), (7, "White rice cooked", "Grain", "Low", 73, 130),
        (8, "Avocado raw", None, None, 15, 160),
    ]
    return spark.createDataFrame(
        rows, "row_id bigint, food_name string, category string, fodmap_level string, glycemic_index int, calories_per_100g int")


@pytest.fixture
def demo(spark):
    rows = [
        (0, "Acme Corp", None, 12.5, 50.0, 2010.0), (1, "TechStart Inc", "Software", None, 25.0, 2018.0),
        (2, None, "Manufacturing", 45.2, None, 1995.0), (3, "Global Solutions", None, None, 200.0, None),
        (4, None, "Healthcare", 8.7, None, 2020.0),
    ]
    return spark.createDataFrame(
        rows, "row_id bigint, company_name string, industry string, revenue_millions double, "
              "employee_count double, founded_year double")
