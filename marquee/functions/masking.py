"""PII masking expressions for the user dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the mask pattern of the published view, over line breaks as well
EMAIL_PATTERN = r"(?s)(^.).*(@.*$)"
EMAIL_REPLACEMENT = "$1***$2"
PHONE_PREFIX = "******"
FULL_MASK_EMAIL = "***"


def email_sql(col: str) -> str:
    """First character, ``***``, then ``@domain``. Whatever the pattern does
    not match as a whole is masked whole, never shown."""
    return (
        f"CASE WHEN {col} IS NULL THEN NULL WHEN {col} RLIKE '{EMAIL_PATTERN}' "
        f"THEN regexp_replace({col}, '{EMAIL_PATTERN}', '{EMAIL_REPLACEMENT}') ELSE '{FULL_MASK_EMAIL}' END"
    )


def phone_sql(col: str) -> str:
    """``******`` plus the last four characters; four or fewer are masked whole."""
    return (
        f"CASE WHEN {col} IS NULL THEN NULL WHEN length({col}) > 4 "
        f"THEN concat('{PHONE_PREFIX}', right({col}, 4)) ELSE '{PHONE_PREFIX}' END"
    )


def mask_email(col: str) -> Column:
    return F.expr(email_sql(col))


def mask_phone(col: str) -> Column:
    return F.expr(phone_sql(col))
