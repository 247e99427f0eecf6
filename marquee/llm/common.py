"""Helpers shared by the training-data operators."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import TABLE_OPTIONS, run_folder

#: a word is a run of anything but the ASCII white space characters
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor.

    A driver that only put the repository on its own ``sys.path`` would leave
    the workers without it; ``addPyFile`` sends a zip of the package once per
    application.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.dirname(package)
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, base))
    path = os.path.join(tempfile.mkdtemp(prefix="marquee-py-"), "marquee_package.zip")
    with open(path, "wb") as f:
        f.write(data.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to a fresh folder in the shared store and read it back.

    This cuts the lineage: a lost executor costs the tasks that were running,
    not what has been written.
    """
    spark = df.sparkSession
    folder = run_folder(spark, purpose)
    df.write.options(**TABLE_OPTIONS).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def word_count(text: Column) -> Column:
    """Number of words of a text; NULL counts as no words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[dict[str, list]]:
    """The columns of each run of equal keys, for rows sorted by key."""
    held: dict[str, list] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        keys = np.array(columns[key])
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            part = {n: c[a:b] for n, c in columns.items()}
            if held and held[key][-1] == part[key][0]:
                for n, c in part.items():
                    held[n].extend(c)
            else:
                if held:
                    yield held
                held = part
    if held:
        yield held
