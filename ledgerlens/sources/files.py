"""CSV report sink / reader and the test-parameter CSV source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PARAMETER_SCHEMA = ("test_id int, facility_used_by_id string, report_group_id string, "
                    "facility_lender string, period string, group_by string, description string")


def write_report_csv(df: DataFrame, path: str) -> None:
    """Quoted CSV with a header; one file per partition (no funnel through
    a single task)."""
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path)


def read_report_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def read_test_parameters(spark: SparkSession, path: str) -> DataFrame:
    """Parameter rows; the text ``NULL`` means null."""
    return (spark.read.option("header", True).option("nullValue", "NULL")
            .schema(PARAMETER_SCHEMA).csv(path))
