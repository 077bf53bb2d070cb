"""Row types, allowed values and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: One normalised row of a store file; missing columns read as null.
STAGING = T.StructType(
    [
        T.StructField("store", T.StringType()), T.StructField("store_product_id", T.StringType()), T.StructField("title", T.StringType()),
        T.StructField("vendor", T.StringType()), T.StructField("product_type", T.StringType()), T.StructField("sku", T.StringType()),
        T.StructField("price", T.DoubleType()), T.StructField("available", T.BooleanType()), T.StructField("image_url", T.StringType()),
        T.StructField("product_url", T.StringType()), T.StructField("mpn", T.StringType()), T.StructField("mpn_root", T.StringType()),
        T.StructField("ean", T.StringType()), T.StructField("identifier_source", T.StringType()), T.StructField("scraped_at", T.StringType()),
    ]
)
IDENTIFIER_SOURCES = ("sku", "api", "title_regex", "none")
MATCH_METHODS = ("ean", "mpn_root", "mpn", "model_code", "title", "unmatched")


def require(df: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """The rows, failing on the first value that is not allowed."""
    value = F.col(column)
    bad = F.concat(F.lit(f"{column}: value not allowed: "), F.coalesce(value, F.lit("null")))
    return df.withColumn(column, F.when(value.isin(*allowed), value).otherwise(F.raise_error(bad).cast("string")))


def blank(value: Column) -> Column:
    """Null or only spaces."""
    return F.trim(F.coalesce(value, F.lit(""))) == ""
