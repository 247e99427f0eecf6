"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words. A document's expected number of copies
is its source's target over its source's size. The whole part of that is
taken for certain; for the rest the documents of a source are ranked by

    (u / (1 - u)) / (p / (1 - p))

(random odds over inclusion odds, the Pareto order sampling of Rosen 1997) and
taken in that order until the source's remaining words are reached. ``u``
comes from the MD5 of the document's key, so reruns agree. ``p`` grows with
the square root of a document's words (whole number; ``by_length``) and with
``weight``, and is scaled so that a source's expected words are its remaining
words. So long documents are decided early and the cut falls among short ones.

Everything is DataFrame expressions. No source is ever sorted as a whole: the
rank axis is cut into buckets, the words of each (source, bucket) are summed,
and only in the one bucket of each source that the cut falls into are ranks
ordered, rows of equal rank as one group. Of a group that the cut divides the
first rows as written are taken, found by counts over stretches of them.

Edge cases: NULL text has size 0; NULL source is a source of its own, last in
order; an empty table or a source without words gets target 0 and no copies;
rows without key draw by their text; rows that agree in key and size share one
draw, but the cut may divide them; other columns are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from marquee.llm.common import stage, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEAT = 2
BUCKETS = 4096
SEED = 17
#: rows in a stretch of equal ranks: 2 to the power of this
_STRETCH = 12


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT
) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) each.

    Targets share ``share`` times all words by weight, no target above
    ``max_repeat`` times its source's size; what is above goes to the others
    by weight. In ascending order of size per weight a source is at its limit
    exactly if an equal share of what the smaller ones leave would reach it, so
    one pass of running sums settles all rounds of re-sharing. These windows
    run over one row per source.
    """
    in_order = W.orderBy(F.col("source").asc_nulls_last())
    by_ratio = W.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    return (
        sizes.withColumn("weight", F.get(cycle, (F.row_number().over(in_order) - 1) % len(weights)))
        .withColumn("limit", F.col("source_size") * F.lit(float(max_repeat)))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("at_limit", F.col("left") >= F.col("ratio") * F.sum("weight").over(after))
        .withColumn("spent", F.sum(F.when(F.col("at_limit"), F.col("limit"))).over(everything))
        .withColumn("open_weight", F.sum(F.when(~F.col("at_limit"), F.col("weight"))).over(everything))
        .withColumn(
            "target",
            F.when(F.col("at_limit"), F.col("limit")).otherwise(
                (F.col("total") - F.coalesce("spent", F.lit(0.0))) / F.col("open_weight") * F.col("weight")
            ),
        )
        .select("source", "source_size", "target")
    )


def _draw(key: Column, text: Column, seed: int) -> Column:
    """Uniform in (0, 1): the first 52 bits of an MD5."""
    named = F.coalesce(key.cast("string"), F.concat(F.lit("text:"), F.coalesce(text, F.lit(""))))
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), named)), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def _rank(u: Column, p: Column) -> Column:
    """Pareto rank mapped from [0, inf) to [0, 1): q / (1 + q)."""
    a, b = u * (1 - p), (1 - u) * p
    return F.when(a + b > 0, a / (a + b)).otherwise(F.lit(1.0))


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weight: str | None = None,
    by_length: bool = True,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    max_repeat: int = MAX_REPEAT,
    seed: int = SEED,
    buckets: int = BUCKETS,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per document: its key (and the columns of ``keep``), ``size``,
    ``source_size``, ``target``, ``copies``, ``taken`` = copies x size, and
    ``p``, the inclusion probability of the copy that is drawn for.

    ``weight`` names a positive column that scales a document's inclusion
    probability against the word-weighted mean of its source.
    """
    mine = [
        F.col(key).alias("_key"),
        F.col(source).alias("_source"),
        word_count(F.col(text)).alias("_size"),
        _draw(F.col(key), F.col(text), seed).alias("_u"),
        (F.coalesce(F.col(weight).cast("double"), F.lit(1.0)) if weight else F.lit(1)).alias("_weight"),
        F.monotonically_increasing_id().alias("_row"),
    ]
    if keep is not None:
        mine.append(F.struct(*keep).alias("_kept"))
    sized = stage(docs.select(*mine), "mix-sizes")
    w = F.floor(F.sqrt("_size")) * F.col("_weight") if by_length else F.col("_weight")
    # whole numbers add up to the same in any order
    weighted = w * F.col("_size") if weight else (w * F.col("_size")).cast("decimal(38,0)")
    per_source = sized.groupBy(F.col("_source").alias("source")).agg(
        F.sum("_size").alias("source_size"), F.sum(weighted).cast("double").alias("weighted")
    )
    per_source = stage(per_source, "mix-sources")
    plan = (
        source_targets(per_source.select("source", "source_size"), weights, share, max_repeat)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("rest", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
        .join(per_source.selectExpr("source s2", "weighted"), F.col("source").eqNullSafe(F.col("s2")))
        .selectExpr(
            "source p_source", "source_size", "target", "whole", "rest",
            "if(weighted > 0, rest / weighted, 0D) p_scale",
        )
    )
    plan = stage(plan, "mix-plan")

    def ranked(df: DataFrame, p: DataFrame) -> DataFrame:
        return (
            df.join(p, F.col("_source").eqNullSafe(F.col("p_source")), "left")
            .withColumn("_p", F.least(F.col("p_scale") * w, F.lit(1.0)))
            .withColumn("_rank", _rank(F.col("_u"), F.col("_p")))
            .withColumn("_bucket", F.least(F.floor(F.col("_rank") * buckets), F.lit(buckets - 1)))
        )

    some = ranked(sized.where("_size > 0"), plan)
    by_bucket = some.groupBy("_source", "_bucket").agg(F.sum("_size").alias("words"), F.first("rest").alias("rest"))
    running = W.partitionBy("_source").orderBy("_bucket")
    # the bucket in which a source's remaining words are reached
    cut = (
        by_bucket.withColumn("upto", F.sum("words").over(running))
        .where("upto >= rest and upto - words < rest")
        .selectExpr("_source c_source", "_bucket cut_bucket", "upto - words as words_before")
    )
    cut = stage(cut, "mix-cuts")
    at = ["_rank", "_key", "_size"]
    inside = W.partitionBy("_source").orderBy(*at).rowsBetween(W.unboundedPreceding, -1)
    # in the cut bucket a row is taken if that brings the sum nearer to the target
    last = stage(
        some.join(cut, F.col("_source").eqNullSafe(F.col("c_source")) & (F.col("_bucket") == F.col("cut_bucket")))
        .groupBy("_source", *at).agg(F.count("*").alias("n"), F.first("words_before").alias("b"), F.first("rest").alias("rest"))
        .withColumn("before", F.col("b") + F.coalesce(F.sum(F.col("n") * F.col("_size")).over(inside), F.lit(0)))
        .withColumn("taken_of_n", F.least(F.floor((F.col("rest") - F.col("before")) / F.col("_size") + F.lit(0.5)), F.col("n")))
        .where("taken_of_n > 0")
        .groupBy(F.col("_source").alias("l_source"))
        .agg(F.max(F.struct(*at)).alias("last_taken"), F.max_by(F.struct("taken_of_n", "n"), F.struct(*at)).alias("of")),
        "mix-last",
    )
    # of rows that tie where the cut divides them: the stretch, then the row
    tied = (
        some.join(last.where("of.taken_of_n < of.n"), F.col("_source").eqNullSafe(F.col("l_source")))
        .where(F.struct(*at).eqNullSafe(F.col("last_taken")))
        .select("l_source", "_row", F.shiftright("_row", _STRETCH).alias("stretch"), F.col("of.taken_of_n").alias("m"))
    )
    so_far = W.partitionBy("l_source").orderBy("stretch")
    stretch = (
        tied.groupBy("l_source", "stretch", "m").agg(F.count("*").alias("rows"))
        .withColumn("upto", F.sum("rows").over(so_far))
        .where("upto >= m and upto - rows < m")
        .selectExpr("l_source s_source", "stretch s_stretch", "m - (upto - rows) as place")
    )
    row = (
        tied.join(stretch, F.col("l_source").eqNullSafe(F.col("s_source")) & (F.col("stretch") == F.col("s_stretch")))
        .withColumn("nth", F.row_number().over(W.partitionBy("l_source").orderBy("_row")))
        .where("nth = place")
        .selectExpr("l_source r_source", "_row last_row")
    )
    decided = stage(
        plan.join(cut, F.col("p_source").eqNullSafe(F.col("c_source")), "left")
        .join(last, F.col("p_source").eqNullSafe(F.col("l_source")), "left")
        .join(row, F.col("p_source").eqNullSafe(F.col("r_source")), "left")
        .drop("c_source", "l_source", "r_source", "words_before", "of"),
        "mix-decided",
    )
    place = F.struct(*at)
    extra = (
        F.when(F.col("rest") <= 0, 0)
        # no cut: rounding left the sum of all words a hair under the rest
        .when(F.col("cut_bucket").isNull() | (F.col("_bucket") < F.col("cut_bucket")), 1)
        .when(F.col("_bucket") > F.col("cut_bucket"), 0)
        .when(place < F.col("last_taken"), 1)
        .when(place.eqNullSafe(F.col("last_taken")) & (F.col("_row") <= F.coalesce("last_row", "_row")), 1)
        .otherwise(0)
    )
    out = ranked(sized, decided).withColumn(
        "_copies", F.when(F.col("_size") > 0, F.col("whole") + extra).otherwise(F.lit(0)).cast("long")
    )
    shown = [F.col("_key").alias(key)] if keep is None else [F.col(f"_kept.`{c}`").alias(c) for c in keep]
    return out.select(
        *shown,
        F.col("_size").alias("size"),
        "source_size",
        "target",
        F.least(F.col("_copies"), F.lit(max_repeat)).alias("copies"),
        (F.least(F.col("_copies"), F.lit(max_repeat)) * F.col("_size")).alias("taken"),
        F.when((F.col("_size") > 0) & (F.col("rest") > 0), F.col("_p")).otherwise(F.lit(0.0)).alias("p"),
    )


def repeat_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # apart from the mix's own columns
    options = {"key": "doc_id", "text": "text", "source": "source"} | options
    options |= {o: names[options[o]] for o in ("key", "text", "source", "weight") if options.get(o)}
    mixed = mix(docs.toDF(*names.values()), keep=list(names.values()), **options)
    each = mixed.where("copies > 0").withColumn("_n", F.explode(F.expr("array_repeat(0, cast(copies as int))")))
    return each.select(*[F.col(n).alias(c) for c, n in names.items()])


#: the registered query in DuckDB's SQL, by rounds of re-sharing written as one
#: pass, and a running sum over each whole source in place of rank buckets
ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST(sum(CAST(floor(sqrt(size)) AS BIGINT) * size) AS DOUBLE) AS weighted,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM sized GROUP BY source
),
ratios AS (SELECT *, source_size * 2.0::DOUBLE AS most, source_size * 2.0::DOUBLE / weight AS ratio FROM sources),
limits AS (
  SELECT *, sum(source_size) OVER () * 1.5::DOUBLE
            - coalesce(sum(most) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            >= ratio * sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS at_limit
  FROM ratios
),
targets AS (
  SELECT source, source_size, weighted,
         CASE WHEN at_limit THEN most ELSE
           (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(most) FILTER (at_limit) OVER (), 0))
           / sum(weight) FILTER (NOT at_limit) OVER () * weight END AS target
  FROM limits
),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
         greatest(target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size, 0) AS rest
  FROM targets
),
odds AS (
  SELECT s.doc_id, s.size, t.*,
         (CAST(CAST('0x' || left(md5('17:' || coalesce(CAST(s.doc_id AS VARCHAR), 'text:' || coalesce(s.text, ''))), 13) AS BIGINT) AS DOUBLE)
          + 0.5) / 4503599627370496.0::DOUBLE AS u,
         CASE WHEN weighted > 0 THEN least(rest / weighted * floor(sqrt(s.size)), 1.0::DOUBLE) ELSE 0.0::DOUBLE END AS p
  FROM sized s JOIN plan t ON s.source IS NOT DISTINCT FROM t.source
),
ranks AS (
  SELECT *, CASE WHEN u * (1 - p) + (1 - u) * p > 0 THEN u * (1 - p) / (u * (1 - p) + (1 - u) * p) ELSE 1 END AS q FROM odds
),
sums AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY q, doc_id NULLS FIRST, size
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) - size / 2.0::DOUBLE AS middle
  FROM ranks WHERE size > 0
  UNION ALL SELECT *, NULL FROM ranks WHERE size = 0
)
SELECT doc_id, size, source_size, target,
       CAST(least(CASE WHEN size > 0 THEN whole + CASE WHEN rest > 0 AND middle <= rest THEN 1 ELSE 0 END ELSE 0 END, 2) AS BIGINT) AS copies,
       CAST(least(CASE WHEN size > 0 THEN whole + CASE WHEN rest > 0 AND middle <= rest THEN 1 ELSE 0 END ELSE 0 END, 2) * size AS BIGINT) AS taken,
       CASE WHEN size > 0 AND rest > 0 THEN p ELSE 0.0::DOUBLE END AS p
FROM sums
"""
