"""Keyed tokens in place of personal values.

A token is a SHA-256 of a secret salt and the value, so equal values have equal
tokens in every table made with one salt, and joins on tokens are joins on the
values; without the salt a token can't be looked up by hashing guesses. The
salt has a version that stands in front of the token, so tokens of two salts
are never taken for equal ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Salt:
    version: str
    secret: str

    def __repr__(self) -> str:  # the secret stays out of logs
        return f"Salt({self.version!r})"


def token(value: Column, salt: Salt) -> Column:
    """NULL stays NULL. The two lengths in front keep salt and value apart."""
    text = value.cast("string")
    keyed = F.concat(F.lit(f"{len(salt.secret)}:{salt.secret}:"), F.length(text).cast("string"), F.lit(":"), text)
    return F.concat(F.lit(f"{salt.version}."), F.sha2(keyed, 256))


def tokenized(df: DataFrame, columns: Mapping[str, str], salt: Salt, drop: Sequence[str] = ()) -> DataFrame:
    """``columns`` (column -> name of its token) replaced by tokens, the columns
    of ``drop`` left out; no raw value of either remains."""
    kept = [c for c in df.columns if c not in columns and c not in drop]
    return df.select(*[token(F.col(c), salt).alias(name) for c, name in columns.items()], *kept)


def rotation(values: DataFrame, column: str, old: Salt, new: Salt) -> DataFrame:
    """old_token and new_token of every different value: what re-keys tables
    that hold tokens only."""
    distinct = values.select(F.col(column).alias("v")).where("v IS NOT NULL").distinct()
    return distinct.select(token(F.col("v"), old).alias("old_token"), token(F.col("v"), new).alias("new_token"))


def rotated(df: DataFrame, column: str, tokens: DataFrame) -> DataFrame:
    """``df`` with the tokens of ``column`` replaced by those of ``rotation``. A
    token that isn't in it fails the job: it could be joined to nothing."""
    pairs = tokens.select(F.col("old_token").alias(column), "new_token")
    joined = df.join(pairs, column, "left")
    unknown = F.raise_error(F.concat(F.lit("token without a successor: "), F.col(column))).cast("string")
    fresh = F.when(F.col(column).isNull(), F.lit(None)).otherwise(F.coalesce("new_token", unknown))
    return joined.withColumn(column, fresh).select(*df.columns)
