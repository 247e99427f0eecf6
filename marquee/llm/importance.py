"""Drawing documents whose word features look like a target's.

A text's features are its runs of one and two words; a feature's bucket is the
CRC-32 of its bytes modulo a number of buckets. Counting the buckets over the
corpus and over the target gives every bucket a gain, the scaled logarithm of
how much commoner it is in the target; a document's weight is the mean gain of
its features. Adding Gumbel noise from a hash of the document's key and taking
the highest scores draws without replacement, each document in proportion to
the exponential of its weight.

Which bucket a feature falls into is found by a head-tail vocabulary. The head
is what occurs often: for its words the CRC state after the word is broadcast,
for its pairs the finished bucket. A word outside the head takes the CRC of its
own bytes, and a pair outside the head goes on from the state of its first
word. Both ways give the same bucket, so the head decides only what a task
has to compute; how it is chosen (lossy counting, ``HEAD_WORDS`` and
``HEAD_PAIRS`` at most) never shows in a result.

Texts are read twice, to choose the head and to find the buckets. What goes on
from there is two bytes a feature, written to the shared folder.

Edge cases: a NULL or wordless text has no features and weight 0, takes noise
like any other and isn't drawn; a NULL key is hashed as an empty one and comes
last among equal scores; rows that agree in key and text are documents of their
own, with equal scores and ranks one after the other; an empty corpus gives no
rows and an empty target makes all gains follow the corpus alone.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from marquee.llm.common import ship_package, stage
from marquee.llm.words import release, words_of

BUCKETS = 10_000
#: bounds of the broadcast head; everything else takes the direct way
HEAD_WORDS = 1 << 16
HEAD_PAIRS = 1 << 17
#: slots of the pair table; of pairs that meet in one the commonest has it
_SLOTS = 1 << 19
#: words that are looked up together
_WORDS_AT_ONCE = 1 << 18


def _byte_step() -> np.ndarray:
    """CRC-32's table: what one byte does to an all-zero register."""
    register = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        register = np.where(register & 1, (register >> 1) ^ np.uint32(0xEDB88320), register >> 1)
    return register


_STEP = _byte_step()


def after_space(state: np.ndarray) -> np.ndarray:
    """CRC-32 of bytes and one space, from the CRC-32 of the bytes."""
    register = ~state
    return ~(_STEP[(register ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (register >> np.uint32(8)))


def _slot(key: np.ndarray) -> np.ndarray:
    """Where a pair's key stands in the pair table."""
    mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)).astype(np.int64) & (_SLOTS - 1)


class Head:
    """CRC states of frequent words and buckets of frequent pairs."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int) -> None:
        """Both lists commonest first; pairs of other words than ``words`` are left out."""
        self.buckets = buckets
        self.index = {w: i for i, w in enumerate(words)}
        self.state = np.array([zlib.crc32(w) for w in words], np.uint32)
        known = [(self.index[a], self.index[b]) for a, b in pairs if a in self.index and b in self.index]
        known.reverse()  # the last to be written keeps its slot
        a, b = np.array(known, np.int64).reshape(-1, 2).T
        key = a * len(words) + b
        self.pair_key = np.full(_SLOTS, -1, np.int64)
        self.pair_bucket = np.zeros(_SLOTS, np.uint16 if buckets <= 1 << 16 else np.uint32)
        direct = [zlib.crc32(words[j], s) % buckets for j, s in zip(b.tolist(), after_space(self.state[a]).tolist())]
        slot = _slot(key)
        self.pair_key[slot] = key
        self.pair_bucket[slot] = np.array(direct, self.pair_bucket.dtype)

    def find(self, words: list[bytes], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the words, and of the pairs of each word with the one
        before it. ``starts`` are the places where a document begins; the pair
        found there is no feature."""
        n = len(words)
        ids = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, n)
        tail = np.flatnonzero(ids < 0)
        state = self.state[ids] if len(self.state) else np.zeros(n, np.uint32)
        state[tail] = np.fromiter(map(zlib.crc32, map(words.__getitem__, tail.tolist())), np.uint32, len(tail))
        single = state % np.uint32(self.buckets)

        pair = np.zeros(n, np.int64)
        key = ids[:-1] * len(self.state) + ids[1:]
        slot = _slot(key)
        hit = (self.pair_key[slot] == key) & (ids[:-1] >= 0) & (ids[1:] >= 0)
        pair[1:][hit] = self.pair_bucket[slot[hit]]
        direct = np.ones(n, bool)
        direct[1:] = ~hit
        direct[starts] = False
        direct[0] = False
        direct = np.flatnonzero(direct)
        before = after_space(state[direct - 1]).tolist()
        pair[direct] = np.fromiter(
            map(zlib.crc32, map(words.__getitem__, direct.tolist()), before), np.int64, len(direct)
        ) % self.buckets
        return single, pair


def _fewer(counts: Counter, most: int) -> Counter:
    """The commonest entries, ``most`` at most."""
    if len(counts) <= most:
        return counts
    values = np.fromiter(counts.values(), np.int64, len(counts))
    least = np.partition(values, -most)[-most]
    return Counter({k: v for k, v in counts.items() if v > least})


def choose_head(texts: DataFrame, buckets: int, words: int = HEAD_WORDS, pairs: int = HEAD_PAIRS) -> Head:
    """The head of a frame with one column, the text: every task keeps what is
    frequent among its own words by lossy counting, Spark adds the tasks up, and
    the commonest reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single: Counter = Counter()
        double: Counter = Counter()
        for batch in batches:
            for found in words_of(batch.column(0)):
                single.update(found)
                double.update(zip(found, found[1:]))
                if len(single) > 4 * words:
                    single = _fewer(single, words)
                if len(double) > 4 * pairs:
                    double = _fewer(double, pairs)
        single, double = _fewer(single, words), _fewer(double, pairs)
        release()
        first = [*single, *(a for a, _ in double)]
        second = [*repeat(None, len(single)), *(b for _, b in double)]
        yield pa.record_batch({
            "a": pa.array(first, pa.binary()), "b": pa.array(second, pa.binary()),
            "n": pa.array([*single.values(), *double.values()], pa.int64()),
        })

    counted = texts.mapInArrow(count, "a binary, b binary, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    counted = stage(counted, "importance-head")

    def top(rows: DataFrame, most: int) -> list:
        """The commonest, ``most`` at most, commonest first: whole steps of an
        eighth of a power of two, so that nothing else reaches the driver."""
        rows = rows.withColumn("step", F.floor(8 * F.log2("n")))
        room, least = most, None
        for size in rows.groupBy("step").count().orderBy(F.desc("step")).collect():  # 504 rows at most
            room -= size["count"]
            if room < 0:
                break
            least = size.step
        if least is None:
            return []
        return sorted(rows.where(F.col("step") >= least).collect(), key=lambda r: (-r.n, bytes(r.a), bytes(r.b or b"")))

    frequent = [bytes(r.a) for r in top(counted.where("b is null"), words)]
    together = [(bytes(r.a), bytes(r.b)) for r in top(counted.where("b is not null and n > 1"), pairs)]
    return Head(frequent, together, buckets)


def features(docs: DataFrame, text: Column, head: Head, kept: StructType, kept_columns: list[Column]) -> DataFrame:
    """``kept_columns`` (of schema ``kept``), n_words and ``buckets``: those of
    all features as little-endian unsigned integers, two bytes each if they fit."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(head)
    dtype = "<u2" if head.buckets <= 1 << 16 else "<u4"
    schema = StructType([*kept.fields, StructField("n_words", LongType()), StructField("buckets", BinaryType())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = shared.value
        for batch in batches:
            counts, data = [], []
            held: list[bytes] = []
            sizes: list[int] = []

            def flush() -> None:
                ends = np.cumsum(sizes)
                single, pair = head.find(held, ends[:-1]) if held else (np.empty(0), np.empty(0))
                for end, size in zip(ends.tolist(), sizes):
                    start = end - size
                    both = np.concatenate((single[start:end], pair[start + 1 : end]))
                    data.append(both.astype(dtype).tobytes())
                counts.extend(sizes)
                held.clear()
                sizes.clear()

            for found in words_of(batch.column(batch.num_columns - 1)):
                held += found
                sizes.append(len(found))
                if len(held) > _WORDS_AT_ONCE:
                    flush()
            flush()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(data, pa.binary())],
                names=schema.names,
            )

    return docs.select(*kept_columns, text.alias("_text")).mapInArrow(find, schema)


def _per_row(column: pa.Array, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column, and where each row's begin and end."""
    if column.null_count:
        raise ValueError("features are never NULL")
    width = np.dtype(dtype).itemsize
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32, len(column) + 1, 4 * column.offset) // width
    values = np.frombuffer(data, dtype, int(ends[-1])) if data is not None and ends[-1] else np.empty(0, dtype)
    return values, ends


def bucket_totals(found: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket: every task sends one row per bucket at most."""
    dtype = "<u2" if buckets <= 1 << 16 else "<u4"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            values, ends = _per_row(batch.column(0), dtype)
            total += np.bincount(values[ends[0] :], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.record_batch({"bucket": pa.array(used, pa.int64()), "n": pa.array(total[used])})

    rows = found.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in rows.collect():
        out[row.bucket] = row.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket 1000 times the logarithm of its smoothed share in the target
    over that in the corpus, rounded down."""
    buckets = len(corpus)
    all_corpus, all_target = int(corpus.sum()) + buckets, int(target.sum()) + buckets
    pairs = zip(target.tolist(), corpus.tolist())
    return np.array([floor(1000 * log((t + 1) * all_corpus / ((s + 1) * all_target))) for t, s in pairs], np.int64)


def weighted(found: DataFrame, gain: np.ndarray, key: str) -> DataFrame:
    """n_features and weight in place of the buckets."""
    dtype = "<u2" if len(gain) <= 1 << 16 else "<u4"
    fields = [f for f in found.schema.fields if f.name != "buckets"]
    schema = StructType([*fields, StructField("n_features", LongType()), StructField("weight", LongType())])
    shared = found.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            values, ends = _per_row(batch.column(batch.num_columns - 1), dtype)
            sums = np.concatenate(([0], np.cumsum(gain[values])))
            n = np.diff(ends).astype(np.int64)
            weight = (sums[ends[1:]] - sums[ends[:-1]]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n), pa.array(weight)], names=schema.names)

    rest = [f.name for f in fields]
    return found.select(*rest, "buckets").mapInArrow(weigh, schema)


def gumbel(key: Column, seed: int) -> Column:
    """Noise of a key, 1000 times a standard Gumbel variate rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.left(F.sha2(text, 256), F.lit(8)), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))


def ranked(scored: DataFrame, key: str, percent: int) -> DataFrame:
    """``rank`` 1, 2, 3... for the highest scores among the rows that are
    ``eligible``, ``percent`` of them, ties to the smaller key; NULL for others.

    Nothing is sorted as a whole. Scores are integers within the sum of two
    bounded ranges (gains lie within 1000 ln 2^64, noise within -3,200 and
    23,000), so there are less than 120,000 of them whatever the input; the
    rows before each are counted per score, and only rows of one score are
    ordered among themselves. The table of scores is broadcast.
    """
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    higher = W.orderBy(F.desc("_score")).rowsBetween(W.unboundedPreceding, -1)
    places = (
        scored.where("eligible").groupBy(F.col("score").alias("_score")).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_before", F.coalesce(F.sum("n").over(higher), F.lit(0)))
        .withColumn("_drawn", F.expr(f"({percent} * sum(n) over ()) div 100"))
        .where("_before < _drawn").drop("n")
    )
    placed = scored.join(F.broadcast(places), F.col("eligible") & (F.col("score") == F.col("_score")), "left")
    same_score = W.partitionBy("score").orderBy(F.col(key).asc_nulls_last(), "n_features", "weight")
    place = (F.col("_before") + F.row_number().over(same_score)).cast("long")
    high = placed.where("_before is not null").withColumn("rank", place)
    high = high.withColumn("rank", F.when(F.col("rank") <= F.col("_drawn"), F.col("rank")))
    rest = placed.where("_before is null").withColumn("rank", F.lit(None).cast("long"))
    return high.unionByName(rest).drop("_score", "_before", "_drawn", "eligible")


def draw(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = 25,
    min_words: int = 20,
    buckets: int = BUCKETS,
    seed: int = 7,
    head_words: int = HEAD_WORDS,
    head_pairs: int = HEAD_PAIRS,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per document: its key (with ``keep`` the named columns as a
    struct ``kept`` besides), n_words, n_features, weight, score and rank, which
    is NULL for documents that aren't drawn."""
    ship_package(docs.sparkSession)
    mine = [F.col(key).alias("_key"), *([F.struct(*keep).alias("_kept")] if keep else [])]
    head = choose_head(docs.select(F.col(text)), buckets, head_words, head_pairs)
    found = stage(features(docs, F.col(text), head, docs.select(*mine).schema, mine), "importance-features")
    wanted = bucket_totals(features(target, F.col(target_text), head, StructType([]), []), buckets)
    gain = gains(bucket_totals(found, buckets), wanted)
    scored = weighted(found, gain, "_key").withColumns({
        "score": F.col("weight") + gumbel(F.col("_key"), seed),
        "eligible": F.col("n_words") >= min_words,
    })
    out = ranked(stage(scored, "importance-scores"), "_key", percent)
    names = {"_key": key, "_kept": "kept"}
    return out.select(*[F.col(c).alias(names.get(c, c)) for c in out.columns])


def drawn(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents themselves, with all columns of ``docs``."""
    rows = draw(docs, target, keep=docs.columns, **options)
    return rows.where("rank is not null").select(*[F.col(f"kept.`{c}`").alias(c) for c in docs.columns])


#: the same in DuckDB. CRC-32 is folded over the bytes of every different feature
ORACLE_SQL = r"""
WITH step AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
texts AS (
  SELECT 'd' AS side, doc_id, row_number() OVER () AS row_no, text FROM documents
  UNION ALL SELECT 'b', NULL, row_number() OVER (), text FROM benchmark),
split AS (
  SELECT side, doc_id, row_no, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words FROM texts),
features AS (
  SELECT side, row_no, unnest(list_concat(words, list_transform(range(1, len(words)),
    lambda i: words[i] || ' ' || words[i + 1]))) AS feature FROM split),
counted AS (SELECT side, row_no, feature, count(*) AS n FROM features GROUP BY ALL),
hashed AS (
  SELECT feature, xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen(feature)),
      lambda j: (instr('0123456789ABCDEF', hex(feature)[2 * j + 1]) - 1) * 16
                + instr('0123456789ABCDEF', hex(feature)[2 * j + 2]) - 1)),
    lambda c, b: xor(c >> 8, step.t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM counted), step),
placed AS (SELECT side, row_no, bucket, sum(n) AS n FROM counted JOIN hashed USING (feature) GROUP BY ALL),
totals AS (
  SELECT bucket, sum(n) FILTER (side = 'd') AS s, sum(n) FILTER (side = 'b') AS t FROM placed GROUP BY bucket),
sums AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM totals),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (all_s + 10000) AS DOUBLE)
    / CAST((coalesce(s, 0) + 1) * (all_t + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM totals, sums),
weights AS (
  SELECT row_no, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / CAST(sum(n) AS DOUBLE)) AS BIGINT) AS weight
  FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row_no),
scored AS (
  SELECT doc_id, row_no, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
      (CAST(CAST('0x' || left(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 8) AS BIGINT) AS DOUBLE) + 0.5)
      / 4294967296.0))) AS BIGINT) AS score
  FROM split LEFT JOIN weights USING (row_no) WHERE side = 'd'),
placed_scores AS (
  SELECT row_no, row_number() OVER (ORDER BY score DESC, doc_id, n_features, weight) AS place,
    (25 * count(*) OVER ()) // 100 AS drawn FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank
FROM scored LEFT JOIN placed_scores USING (row_no)
"""
