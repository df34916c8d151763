"""Schemas of the store and the export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The export's columns, in order, all strings.
EXPORT_COLUMNS = (
    "country_name", "country_code", "country_dial_code", "city_name", "company_name", "company_type",
    "company_logo", "company_about", "title", "description", "job_type", "category", "sub_category",
    "role_family", "application_url", "posted_at", "min_experience", "max_experience", "qualification",
    "min_salary", "max_salary", "salary_period", "salary_currency",
)
#: The least columns of a store row, besides the export's.
STORE_COLUMNS = ("source", "job_id", "posted_date", "scraped_at", "skills", "needs_review", "jd_too_short")

VERDICT = T.StructType([
    T.StructField("in_scope", T.BooleanType()), T.StructField("category", T.StringType()), T.StructField("sub_category", T.StringType()),
    T.StructField("sub_category_basis", T.StringType()), T.StructField("role_family", T.StringType()), T.StructField("needs_review", T.BooleanType()),
    T.StructField("vetoed_by", T.StringType()), T.StructField("all_families", T.StringType()), T.StructField("family_scores", T.StringType()),
    T.StructField("family_confidence", T.StringType()), T.StructField("matched_in", T.StringType()),
])


def strings(columns: tuple[str, ...] = EXPORT_COLUMNS) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def pin(df: DataFrame, columns: tuple[str, ...], fill: str = "") -> DataFrame:
    """Exactly these columns in this order; missing ones are filled."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(fill).alias(c) for c in columns])
