"""Comma-separated files with a declared schema applied by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, StringType, StructField, StructType


def read_csv_by_position(spark: SparkSession, path: str, schema: StructType,
                         header: bool = True, sep: str = ",") -> DataFrame:
    """Read CSV with ``schema``; the header line is skipped, not matched.

    Spark's default ``enforceSchema=true`` binds columns by position, so a
    header that names a column differently (``international_plan`` versus the
    schema's ``intl_plan``) still loads. No schema inference pass is run.
    """
    return (spark.read.schema(schema)
            .option("header", header).option("sep", sep)
            .option("enforceSchema", True).option("mode", "PERMISSIVE")
            .csv(path))


def _schema(columns: list[tuple[str, str]]) -> StructType:
    types = {"string": StringType(), "double": DoubleType()}
    return StructType([StructField(n, types[t], True) for n, t in columns])


# The churn table layout, in file order (21 columns).
CHURN_COLUMNS = [
    ("state", "string"), ("account_length", "double"), ("area_code", "string"),
    ("phone_number", "string"), ("intl_plan", "string"), ("voice_mail_plan", "string"),
    ("number_vmail_messages", "double"), ("total_day_minutes", "double"),
    ("total_day_calls", "double"), ("total_day_charge", "double"),
    ("total_eve_minutes", "double"), ("total_eve_calls", "double"),
    ("total_eve_charge", "double"), ("total_night_minutes", "double"),
    ("total_night_calls", "double"), ("total_night_charge", "double"),
    ("total_intl_minutes", "double"), ("total_intl_calls", "double"),
    ("total_intl_charge", "double"), ("number_customer_service_calls", "double"),
    ("churned", "string"),
]

# The product-flag table layout, in file order (13 columns).
PRODUCT_COLUMNS = [
    ("category_title", "string"), ("price", "double"),
    ("characteristic_1", "string"), ("characteristic_2", "string"),
    ("characteristic_3", "string"), ("characteristic_4", "string"),
    ("characteristic_5", "string"), ("characteristic_6", "string"),
    ("characteristic_7", "string"), ("characteristic_8", "string"),
    ("characteristic_9", "string"), ("characteristic_10", "string"),
    ("flag", "string"),
]

CHURN_SCHEMA = _schema(CHURN_COLUMNS)
PRODUCT_SCHEMA = _schema(PRODUCT_COLUMNS)
