"""Ranked lexical search by NRA ("no random access") over impact-sorted lists.

A document's score for an item is the sum over the item's terms of the term's
impact in it, an integer that grows with the term's count, falls with the
document's length and is scaled by the term's rarity. A posting list holds the
impacts of one term, highest first. NRA reads the lists of an item from the
top only; what has been read gives every document

* a lower bound, the sum of its impacts read so far, and
* an upper bound, that sum plus, for each list it hasn't been met in, the
  impact at which reading that list has stopped.

Reading goes on, always down the lists whose next impacts are highest, until
no document outside the best can reach them any more, ties included, and the
best themselves have one score instead of an interval. Documents that have
dropped out are passed over in what is read after that.

The corpus is turned once into rows of term ids and counts of the terms that
are asked for at all. Each task deals its rows into segments of a bounded
number of postings, sorts a segment's lists and answers every item on them; the
scores of the best so far are the bar that the task's next segment has to
reach. What a task hands on is its best per item, and those are ranked in two
levels. Items go in blocks of a bounded number of terms, which are broadcast.

Edge cases: a NULL or wordless text matches nothing and isn't counted among the
documents; an item without terms, or whose terms are nowhere, gives no rows;
rows that agree in key and text are documents of their own; a NULL key comes
after all others among equal scores; items that share an id are answered each;
a key of 2^63 - 1 is not told from NULL.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from marquee.llm.common import ship_package, stage
from marquee.llm.words import release, words_of

#: share of a document's length in its weight, in hundredths
LENGTH_SHARE = 50
#: postings of a segment; a single longer document is a segment of its own
SEGMENT_POSTINGS = 2_000_000
#: terms of the items that are broadcast together
BLOCK_TERMS = 2_000_000
#: tasks whose best are ranked together before the last ranking
FAN_IN = 1024
NO_KEY = (1 << 63) - 1


@dataclass
class Items:
    """A block of items: their terms as ids of one vocabulary."""

    ids: list
    terms: list[np.ndarray]
    index: dict[bytes, int]


def blocks(items: DataFrame, item_id: str, text: str, most: int = BLOCK_TERMS) -> Iterator[Items]:
    """The items in blocks of about ``most`` terms. They are the stated set of
    queries and come to the driver one block after the other."""
    block, size = Items([], [], {}), 0
    for row in items.select(F.col(item_id).alias("i"), F.encode(F.col(text), "utf-8").alias("t")).toLocalIterator():
        (words,) = words_of(pa.array([row.t], pa.binary()))
        found = {block.index.setdefault(w, len(block.index)) for w in words}
        block.ids.append(row.i)
        block.terms.append(np.array(sorted(found), np.int64))
        size += len(found)
        if size >= most:
            yield block
            block, size = Items([], [], {}), 0
    if block.ids:
        yield block


def term_rows(docs: DataFrame, key: str, text: str, index: dict[bytes, int]) -> DataFrame:
    """Per document its number of words and the ids and counts of those words
    that are in ``index``."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    step = len(index) + 1

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            sizes, terms, counts = [], [], []
            for words in words_of(batch.column(1)):
                ids = np.fromiter(map(index.get, words, repeat(step)), np.int64, len(words))
                found, n = np.unique(ids, return_counts=True)
                known = int(np.searchsorted(found, step))
                sizes.append(len(words))
                terms.append(found[:known].astype("<u4").tobytes())
                counts.append(n[:known].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())],
                names=["doc_id", "n", "terms", "counts"],
            )
        release()

    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("doc_id"), F.col(text))
    return rows.mapInArrow(find, "doc_id long, n long, terms binary, counts binary")


def document_counts(rows: DataFrame, terms: int) -> np.ndarray:
    """In how many documents each term stands."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4"), minlength=terms)
        used = np.flatnonzero(total)
        yield pa.record_batch({"term": pa.array(used, pa.int64()), "n": pa.array(total[used])})

    counted = rows.select("terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(terms, np.int64)
    for row in counted.collect():
        out[row.term] = row.n
    return out


def rarity(documents: int, counts: np.ndarray) -> np.ndarray:
    return np.array([floor(1000 * log((2 * documents + 2) / (2 * n + 1))) for n in counts.tolist()], np.int64)


class Segment:
    """Impact-sorted posting lists of some documents."""

    def __init__(self, keys: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
        """``keys``: of the documents; ``doc`` (place in ``keys``), ``term`` and
        ``impact``: one entry per posting."""
        order = np.lexsort((doc, -impact, term))
        self.keys, self.doc, self.impact = keys, doc[order], impact[order]
        self.terms, first = np.unique(term[order], return_index=True)
        self.bounds = np.append(first, len(term))
        self.read = 0

    def lists(self, terms: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        place = np.searchsorted(self.terms, terms)
        place = place[(place < len(self.terms)) & (self.terms[np.minimum(place, len(self.terms) - 1)] == terms)]
        spans = [slice(self.bounds[p], self.bounds[p + 1]) for p in place.tolist()]
        return [(self.doc[s], self.impact[s]) for s in spans]

    def best(self, terms: np.ndarray, k: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the documents that reach both ``bar`` and the
        k-th highest score here; those that tie with it are all among them."""
        lists = [(doc, impact) for doc, impact in self.lists(terms) if impact[0] > 0]
        lower = np.zeros(len(self.keys), np.int64)
        if not lists:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = [0] * len(lists)
        seen_doc: list[np.ndarray] = []
        seen_list: list[np.ndarray] = []
        candidates: np.ndarray | None = None  # None: any document may still turn up
        level = max(int(impact[0]) for _, impact in lists)
        while True:
            level = level // 2 if level > 1 else 0
            for i, (doc, impact) in enumerate(lists):
                # down to the level, in one stretch of sequential reading
                to = at[i] + int(np.searchsorted(-impact[at[i] :], -level, "left"))
                if to == at[i]:
                    continue
                docs, impacts = doc[at[i] : to], impact[at[i] : to]
                self.read += to - at[i]
                at[i] = to
                if candidates is not None:
                    still = candidates[docs]
                    docs, impacts = docs[still], impacts[still]
                lower[docs] += impacts  # a document stands in a list once
                seen_doc.append(docs)
                seen_list.append(np.full(len(docs), i))
            next_impact = np.array([int(impact[a]) if a < len(impact) else 0 for a, (_, impact) in zip(at, lists)])
            unseen = int(next_impact.sum())
            reach = max(bar, int(np.partition(lower, -k)[-k]) if len(lower) > k else 0, 1)
            if candidates is None and unseen >= reach:
                continue
            met = np.bincount(
                np.concatenate(seen_doc), next_impact[np.concatenate(seen_list)], len(lower)
            ).astype(np.int64) if seen_doc else np.zeros(len(lower), np.int64)
            upper = np.where(lower > 0, lower + unseen - met, 0)
            open_ = upper >= reach
            candidates = open_ if candidates is None else candidates & open_
            if not (candidates & (upper > lower)).any():
                found = np.flatnonzero(candidates)
                return found, lower[found]
            kept = [candidates[d] for d in seen_doc]
            seen_list = [s[m] for s, m in zip(seen_list, kept)]
            seen_doc = [d[m] for d, m in zip(seen_doc, kept)]


def segments(
    batches: Iterator[pa.RecordBatch], weight: np.ndarray, documents: int, words: int, postings: int
) -> Iterator[Segment]:
    """The segments of rows of ``term_rows``."""
    keys: list[np.ndarray] = []
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    n_docs = n_postings = 0

    def made() -> Segment:
        doc, term, impact = (np.concatenate(p) for p in zip(*parts))
        return Segment(np.concatenate(keys), doc, term, impact)

    for batch in batches:
        for low in range(0, batch.num_rows, 1024):
            part = batch.slice(low, 1024)
            found = part.column(2).to_pylist()
            n = part.column(1).to_numpy()
            length = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * documents) // max(words, 1)
            sizes = np.array([len(t) for t in found]) // 4
            term = np.frombuffer(b"".join(found), "<u4").astype(np.int64)
            count = np.frombuffer(b"".join(part.column(3).to_pylist()), "<u4").astype(np.int64)
            own = np.repeat(np.arange(part.num_rows), sizes)
            impact = weight[term] * ((1_000_000_000 * count) // (1000 * count + 20 * length[own]))
            keys.append(part.column(0).to_numpy())
            parts.append((own + n_docs, term, impact))
            n_docs, n_postings = n_docs + part.num_rows, n_postings + len(term)
            if n_postings >= postings:
                yield made()
                keys, parts, n_docs, n_postings = [], [], 0, 0
    if n_postings:
        yield made()


def search_rows(
    rows: DataFrame, block: Items, weight: np.ndarray, documents: int, words: int, k: int,
    postings: int = SEGMENT_POSTINGS,
) -> DataFrame:
    """The best ``k`` of every task for every item of the block."""
    shared = rows.sparkSession.sparkContext.broadcast((block.terms, weight))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weight = shared.value
        none = np.empty(0, np.int64)
        best = [(none, none) for _ in terms]
        for segment in segments(batches, weight, documents, words, postings):
            for i, wanted in enumerate(terms):
                key, score = best[i]
                found, scores = segment.best(wanted, k, int(score[-1]) if len(score) >= k else 1)
                if len(found):
                    key = np.concatenate((key, segment.keys[found]))
                    score = np.concatenate((score, scores))
                    order = np.lexsort((key, -score))[:k]
                    best[i] = key[order], score[order]
        item = np.repeat(np.arange(len(terms), dtype=np.int32), [len(s) for _, s in best])
        yield pa.record_batch({
            "item": pa.array(item),
            "doc_id": pa.array(np.concatenate([key for key, _ in best])),
            "score": pa.array(np.concatenate([score for _, score in best])),
            "task": pa.array(np.full(len(item), TaskContext.get().partitionId(), np.int32)),
        })
        release()

    return rows.mapInArrow(answer, "item int, doc_id long, score long, task int")


def search(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    k: int = 50,
    postings: int = SEGMENT_POSTINGS,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents per item,
    equal scores by ascending key."""
    spark = docs.sparkSession
    ship_package(spark)
    answers = [spark.createDataFrame([], items.select(F.col(item_id).alias("item_id")).schema)
               .selectExpr("item_id", "0 rank", "0L doc_id", "0L score")]
    for block in blocks(items, item_id, item_text, block_terms):
        rows = stage(term_rows(docs, key, text, block.index), "nra-terms")
        counted = rows.where("n > 0").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("words")).first()
        documents, words = counted.documents, counted.words or 0
        weight = rarity(documents, document_counts(rows, len(block.index)))
        found = search_rows(rows, block, weight, documents, words, k, postings)
        in_order = [F.desc("score"), F.asc("doc_id")]
        for level in (["item", F.floor(F.col("task") / FAN_IN)], ["item"]):
            place = F.row_number().over(W.partitionBy(*level).orderBy(*in_order))
            found = found.withColumn("rank", place).where(F.col("rank") <= k)
        schema = items.select(F.lit(0).alias("item"), F.col(item_id).alias("item_id")).schema
        names = spark.createDataFrame(list(enumerate(block.ids)), schema)
        named = found.join(names, "item")
        answers.append(stage(
            named.select("item_id", "rank", F.expr(f"nullif(doc_id, {NO_KEY}L)").alias("doc_id"), "score"), "nra-found"
        ))
    return reduce(DataFrame.unionByName, answers)


#: the same in DuckDB
ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, row_no, unnest(found) AS term FROM (
    SELECT doc_id, row_number() OVER () AS row_no, regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS found FROM documents)),
counts AS (SELECT doc_id, row_no, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT row_no, count(*) AS n FROM words GROUP BY row_no),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM lengths),
wanted AS (
  SELECT DISTINCT item_no, item_id, term FROM (
    SELECT item_id, item_no, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT item_id, row_number() OVER () AS item_no, text FROM benchmark))),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM counts, whole WHERE term IN (SELECT term FROM wanted) GROUP BY term, docs),
scored AS (
  SELECT item_no, item_id, row_no, doc_id, CAST(sum(w * ((1000000000 * tf)
    // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // len)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (row_no), whole GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE score > 0) WHERE rank <= 50
"""
