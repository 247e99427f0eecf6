"""Approximate nearest neighbours with a permutation index.

A bounded sample of the vectors gives ``PIVOTS`` pivots. A vector is
represented by its ``PREFIX`` nearest pivots in order (by default all of them:
with fewer, close clusters of vectors lose recall). Vectors are split into
blocks by hash; a block keeps an inverted file per pivot, which holds the
pivot's place in each vector's order (``PREFIX`` where it is not among them).
A query reads the files of its own nearest pivots and adds up how far each
pivot's place is from its place in the query's order: Spearman's footrule of
the two orders (Chavez, Figueroa and Navarro 2008). The nearest share of the
block by footrule is ranked again by the exact measure on the original vectors.

Nearness is the largest inner product. Vectors get one more component that
makes all their lengths equal, so order by distance is order by inner product.

Every vector is indexed. Queries and vectors meet block by block, so a task
holds one block of each. Equal vectors are one entry, with their ``k + 1``
smallest ids: ties go to smaller ids, so no other can be among the results.

Edge cases: vectors that are NULL, zero, of another than the most frequent
length, or that hold NULL or non-finite components take no part, nor do rows
without id; rows that repeat id and vector count once; a table with fewer than
``PIVOTS`` vectors has as many pivots as vectors; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.llm.common import ship_package, stage

PIVOTS = 128
PREFIX = 128
#: share of a block that is ranked again, and the least number
RERANKED, LEAST_RERANKED = 0.25, 256
VECTORS_IN_BLOCK = 8192
QUERIES_IN_BLOCK = 16_384


def _usable(name: str, vector: str) -> str:
    v = f"cast({vector} as array<double>)"
    fine = "x is not null and not isnan(x) and abs(x) < double('infinity')"
    return f"{name} is not null and {vector} is not null and forall({v}, x -> {fine}) and exists({v}, x -> x <> 0)"


class Block:
    """Vectors of one block with the inverted files of their orders."""

    def __init__(self, vectors: np.ndarray, pivots: np.ndarray, longest: float) -> None:
        self.vectors = vectors
        extra = np.sqrt(np.maximum(longest**2 - np.einsum("ij,ij->i", vectors, vectors), 0))
        lifted = np.concatenate([vectors, extra[:, None]], 1)
        self.pivots, self.prefix = pivots, min(PREFIX, len(pivots))
        order = self.order(lifted)
        self.files = np.full((len(pivots), len(vectors)), self.prefix, np.int16)
        for place in range(self.prefix):
            self.files[order[:, place], np.arange(len(vectors))] = place
        self.reranked = min(len(vectors), max(LEAST_RERANKED, int(np.ceil(RERANKED * len(vectors)))))

    def order(self, lifted: np.ndarray) -> np.ndarray:
        near = lifted @ self.pivots.T
        return np.argsort(-near, axis=1, kind="stable")[:, : self.prefix]

    def search(self, query: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The n nearest found, with their inner products."""
        mine = self.order(np.concatenate([query, [0.0]])[None])[0]
        footrule = np.abs(self.files[mine] - np.arange(self.prefix, dtype=np.int16)[:, None]).sum(0, dtype=np.int32)
        if self.reranked < len(footrule):
            candidates = np.argpartition(footrule, self.reranked - 1)[: self.reranked]
        else:
            candidates = np.arange(len(footrule))
        scores = np.einsum("ij,j->i", self.vectors[candidates], query)
        best = np.argsort(-scores, kind="stable")[:n] if n >= len(scores) else np.flatnonzero(scores >= np.partition(scores, -n)[-n])
        return candidates[best], scores[best]


def search(
    table: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding", every: int = 20, pivots: int = PIVOTS
) -> DataFrame:
    """For each row whose key is divisible by ``every`` its ``k`` nearest of
    all other rows: query_id, rank, vec_id, score."""
    spark = table.sparkSession
    ship_package(spark)
    rows = table.where(_usable(f"`{key}`", f"`{vector}`")).select(
        F.col(key).cast("long").alias("id"),
        # +0.0 makes a zero of either sign the same vector
        F.transform(F.col(vector).cast("array<double>"), lambda x: x + F.lit(0.0)).alias("v"),
    )
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dimensions = usual[0]["d"] if usual else 0
    rows = rows.where(F.size("v") == dimensions).distinct()
    ranked = rows.withColumn("place", F.row_number().over(W.partitionBy("v").orderBy("id"))).where(F.col("place") <= k + 1)
    vectors = stage(
        ranked.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("name", F.xxhash64("v")), "vectors"
    )
    asking = stage(
        rows.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), "v", F.xxhash64("v").alias("name")), "asking"
    )
    facts = vectors.agg(F.count("*").alias("n"), F.max(F.expr("aggregate(v, 0D, (a, x) -> a + x * x)")).alias("m")).first()
    longest = float(np.sqrt(facts["m"] or 0))
    sample = vectors.orderBy(F.xxhash64("name"), "v").select("v").limit(pivots).collect()
    chosen = np.array([r["v"] for r in sample], np.float64).reshape(len(sample), dimensions)
    extra = np.sqrt(np.maximum(longest**2 - (chosen**2).sum(1), 0))
    chosen = np.concatenate([chosen, extra[:, None]], 1)
    n_queries = asking.select("v").distinct().count()
    v_blocks = max(1, -(-facts["n"] // VECTORS_IN_BLOCK))
    q_blocks = max(1, -(-n_queries // QUERIES_IN_BLOCK))

    def block(column: str, n: int):
        return F.pmod(F.xxhash64(column, F.lit(n)), F.lit(n).cast("long"))

    def every_block(n: int):
        return F.explode(F.expr(f"sequence(0L, {n - 1}L)"))

    held = vectors.select(
        block("name", v_blocks).alias("i"), every_block(q_blocks).alias("j"), "name", "v", "ids"
    )
    asked = asking.select("name", "v").distinct().select(
        every_block(v_blocks).alias("i"), block("name", q_blocks).alias("j"), "name", "v"
    )

    def meet(queries: pa.Table, members: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if queries.num_rows and members.num_rows:
            # the order of the rows must not depend on the shuffle
            members = members.sort_by("name")
            v = _matrix(members["v"], dimensions)
            ids = members["ids"].to_pylist()
            index = Block(v, chosen, longest)
            for name, q in zip(queries["name"].to_pylist(), _matrix(queries["v"], dimensions)):
                found, scores = index.search(q, k + 1)
                rows = sorted((-s, i) for at, s in zip(found.tolist(), scores.tolist()) for i in ids[at])
                out.extend((name, i, -s) for s, i in rows[: k + 1])
        columns = list(zip(*out)) or [[], [], []]
        types = [pa.int64(), pa.int64(), pa.float64()]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("name", "vec_id", "score"), columns, types)})

    found = (
        asked.groupBy("i", "j").cogroup(held.groupBy("i", "j"))
        .applyInArrow(lambda a, b: meet(a, b), "name long, vec_id long, score double")
    )
    order = [F.desc("score"), F.asc("vec_id")]
    best = found.withColumn("place", F.row_number().over(W.partitionBy("name").orderBy(*order))).where(F.col("place") <= k + 1)
    answers = asking.select("query_id", "name").join(best.drop("place"), "name").where("vec_id <> query_id")
    place = F.row_number().over(W.partitionBy("query_id").orderBy(*order))
    return answers.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _matrix(column: pa.ChunkedArray, dimensions: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if column.num_chunks else pa.array([], pa.float64())
    return flat.to_numpy().reshape(-1, dimensions)


def exact(table: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding", every: int = 20) -> dict[int, list[int]]:
    """Brute force on the driver, to measure recall on small tables."""
    rows = sorted((r[0], r[1]) for r in table.where(_usable(f"`{key}`", f"`{vector}`")).select(key, vector).collect())
    ids, v = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = np.einsum("ij,j->i", v, v[i])
        s[i] = -np.inf
        order = np.lexsort((ids, -s))[: min(k, len(ids) - 1)]
        out[int(ids[i])] = ids[order].tolist()
    return out
