"""The published user view, as a DataFrame function and as a SQL view.

The SQL view is the same statement a warehouse would hold; the caller's
privilege is an argument because identity is resolved outside Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.masking import email_sql, mask_email, mask_phone, phone_sql

VIEW_COLUMNS = ("user_id", "email", "phone", "city", "signup_date", "effective_start", "effective_end", "is_current")


def user_view(dim_user: DataFrame, privileged: bool = False) -> DataFrame:
    """PII masked unless the caller is privileged; the name is never exposed."""
    email = F.col("email") if privileged else mask_email("email")
    phone = F.col("phone") if privileged else mask_phone("phone")
    cols = {"email": email.alias("email"), "phone": phone.alias("phone")}
    return dim_user.select(*[cols.get(c, F.col(c)) for c in VIEW_COLUMNS])


def create_user_view(spark: SparkSession, source_view: str, view_name: str, privileged: bool = False) -> DataFrame:
    """``CREATE OR REPLACE TEMP VIEW`` over a registered dimension view; returns
    ``spark.table(view_name)``."""
    email, phone = ("email", "phone") if privileged else (email_sql("email"), phone_sql("phone"))
    spark.sql(
        f"CREATE OR REPLACE TEMP VIEW {view_name} AS SELECT user_id, {email} AS email, {phone} AS phone, "
        f"city, signup_date, effective_start, effective_end, is_current FROM {source_view}"
    )
    return spark.table(view_name)
