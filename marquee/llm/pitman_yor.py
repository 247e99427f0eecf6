"""Language-model scoring with a hierarchical Pitman-Yor model.

A token is drawn from the restaurant of its context, the two preceding words.
Its parent is the restaurant of the preceding word, whose parent is the word's
subclass (a hash of the word). Subclasses have their class (a hash of the
word's ending) as parent, classes have the root, and the root's dishes come
from a base measure that gives half its mass to the training vocabulary and
half to unseen words. The start of a text is a class of its own, and the first
word is drawn from it. A table of a restaurant is a customer of its parent
(Teh 2006). Any two words and any word that precede a token in the training data
have a restaurant, so their number grows with the input. A word that more than
``SPLIT`` tokens follow has several, by a hash of the word before it.

Word contexts. Tokens with their two preceding words are dealt to buckets by the
preceding word, so its restaurant and all those below it are seated in one task,
with live totals. In an opening sweep the classes are not known yet, and the
bucket's own word counts stand for them.

Classes. The tables of a word's contexts are gathered by word, and seated there:
all classes' customers of a word meet in one task, and tables couple only
entries of the same word. Their restaurant totals are as of the end of an
opening sweep over all words. Each bucket of contexts gets the seats of the
words that it asked for, and its sweeps follow, given the classes.

Seats. All customers of one (restaurant, word) leave and take their seats again
one after the other, given everyone else. The wait for the next new table is
drawn at once, so a dish costs steps by its tables, not by its customers; seats
drawn in that order are corrected to their posterior by the Metropolis-Hastings
rule. The dishes of a level are seated at once. Sweeps after the burn-in are
averaged, and probabilities come from the averaged customers and tables, whose
totals are those of the same averages, so that they add up to one:

    P(w | r) = (c_rw - d t_rw + (s + d t_r) P(w | parent)) / (s + c_r)

Scoring. A bucket of contexts has the tokens to score, too, and sends one sum
per document. Words travel as numbers if they are among the ``HOT_WORDS`` most
frequent ones, else as hashes: that changes what is sent, no result.

Words are told apart by 64-bit hashes.

Edge cases: NULL text is empty: one end token; an empty training set leaves
the base measure (and log10(1/1) = 0 for the base score); repeated rows are
counted and scored row by row; NULL keys count as the empty text for the
training split; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from functools import partial
from itertools import count, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import ship_package, stage
from marquee.llm.tokens import _Generations
from marquee.session import TABLE_OPTIONS, drop_shuffles, run_folder

HELD_OUT_MODULUS, HELD_OUT_REST = 7, 2
CLASSES = 32
SUBCLASSES = 2
#: restaurants: the root, the classes (the last one: start of a text), subclasses
ROOT, FIRST_CLASS, START = 0, 1, CLASSES
FIRST_SUBCLASS = CLASSES + 1
RESTAURANTS = FIRST_SUBCLASS + (CLASSES - 1) * SUBCLASSES
PARENTS = np.concatenate(
    [np.zeros(FIRST_SUBCLASS, np.int64), FIRST_CLASS + np.repeat(np.arange(CLASSES - 1), SUBCLASSES)]
)
#: words that travel as numbers
HOT_WORDS = 1 << 18
#: tokens after one word that one restaurant is for; a context's rows are one task's work
SPLIT = 1_000_000
BURN_IN, SAMPLES = 2, 4
STRENGTH = 1.0
END = np.uint64(0xE0D0E0D0E0D0E0D1)
SEED = 11
#: Spark's own limit (spark.sql.sources.bucketing.maxBuckets)
_MOST_BUCKETS = 100_000
#: distinct words a task holds before it passes its counts on
_VOCABULARY_COUNTED = 400_000
_VOCABULARY_AT_ONCE = 150_000
_TOKENS_AT_ONCE = 1_000_000
_TEXTS_AT_ONCE = 60_000


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only


def trains(key: str):
    """Whether a row is training data, from the checksum of its key as text."""
    rest = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % HELD_OUT_MODULUS
    return rest != HELD_OUT_REST


def _hashed(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words' hashes and the restaurants of what follows them."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    endings = np.fromiter((zlib.crc32(word[-3:]) for word in words), np.int64, len(words)) % (CLASSES - 1)
    restaurants = FIRST_SUBCLASS + endings * SUBCLASSES + (hashes % np.uint64(SUBCLASSES)).astype(np.int64)
    return hashes, restaurants.astype(np.uint8)


class _Reader:
    """Turns texts into (word index, restaurant) of every token."""

    def __init__(self) -> None:
        self.reset()

    def reset(self) -> None:
        #: words in order of appearance, with their index
        self.vocabulary: defaultdict[bytes, int] = defaultdict(count(1).__next__)
        self._hashes, self._contexts, self._done = np.array([END], np.uint64), np.array([START], np.uint8), 1

    @property
    def known(self) -> int:
        return len(self.vocabulary) + 1

    def _catch_up(self) -> None:
        if self._done < self.known:
            new = _hashed(list(islice(self.vocabulary, self._done - 1, None)))
            self._hashes = _appended(self._hashes, self._done, new[0])
            self._contexts = _appended(self._contexts, self._done, new[1])
            self._done = self.known

    @property
    def hashes(self) -> np.ndarray:
        self._catch_up()
        return self._hashes[: self.known]

    @property
    def contexts(self) -> np.ndarray:
        """The class of what follows each word; after an end, a text starts."""
        self._catch_up()
        return self._contexts[: self.known]

    def ids(self, text: str) -> np.ndarray:
        """0 is the end, i + 1 the i-th word of the vocabulary."""
        words = _words(text)
        ids = np.zeros(len(words) + 1, np.int32)
        ids[:-1] = np.fromiter(map(self.vocabulary.__getitem__, words), np.int32, len(words))
        return ids

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        ids = self.ids(text)
        restaurant = np.empty(len(ids), np.uint8)
        restaurant[0] = START
        restaurant[1:] = self.contexts[ids[:-1]]
        return ids, restaurant


def _appended(held: np.ndarray, used: int, new) -> np.ndarray:
    """``held`` with ``new`` after its first ``used`` values. It doubles when it
    is full, so a text costs no copy of what is known."""
    end = used + len(new)
    if end > len(held):
        held = np.concatenate([held[:used], np.empty(2 * end - used, held.dtype)])
    held[used:end] = new
    return held


def _by_bucket(words: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by bucket, and where each bucket begins."""
    bucket = (words >> np.uint64(20)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1).astype(np.uint64))


def _blobs(buckets: int, words: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    order, begins = _by_bucket(words, buckets)
    sorted_ = [c[order] for c in (words, *columns)]
    full = np.flatnonzero(begins[1:] > begins[:-1])
    data = {"bucket": pa.array(full, pa.int64())}
    for i, c in enumerate(sorted_):
        data[f"c{i}"] = pa.array([c[begins[b] : begins[b + 1]].tobytes() for b in full], pa.binary())
    if len(full):
        yield pa.record_batch(data)


def _joined(group: pa.Table, column: str, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(group[column].to_pylist()), dtype)


def _squeezed(a: np.ndarray) -> bytes:
    """Compressed byte by byte of its numbers: the first bytes of small ones are alike."""
    raw = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _loosened(data: bytes, dtype: str) -> np.ndarray:
    raw = np.frombuffer(_expanded(data[8:], int.from_bytes(data[:8], "little")), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).reshape(-1).view(dtype)


def _expanded(data: bytes, size: int) -> bytes:
    return pa.decompress(data, size, "zstd", asbytes=True) if size else b""


def _packed(a: np.ndarray) -> pa.Array:
    return pa.array([_squeezed(a)], pa.binary())


# --- counting -----------------------------------------------------------------


def _before(ids: np.ndarray, words: int) -> np.ndarray:
    """The ids that stand so many words before each token of texts one after the
    other, which end with 0; 0 where a text has not so many."""
    out = np.zeros_like(ids)
    out[words:] = ids[:-words]
    return out


def _count(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    _Generations.drop()
    seen, texts = Counter(), 0

    def flush() -> Iterator[pa.RecordBatch]:
        hashes, contexts = _hashed(list(seen))
        n = np.append(np.fromiter(seen.values(), np.int64, len(seen)), texts)
        hashes, contexts = np.append(hashes, END), np.append(contexts, np.uint8(START))
        # a token follows every word, and every start of a text
        masses = np.bincount(contexts, n, RESTAURANTS).astype(np.int64)
        for blobs in _blobs(buckets, hashes, contexts, n.astype(np.uint32)):
            of_all = [masses.tobytes(), *[None] * (blobs.num_rows - 1)]
            yield blobs.append_column("masses", pa.array(of_all, pa.binary()))

    for batch in batches:
        for value in batch.column(0):
            seen.update(_words(value.as_py()))
            texts += 1
            if len(seen) > _VOCABULARY_COUNTED or texts >= 1 << 30:
                yield from flush()
                seen, texts = Counter(), 0
    if texts:
        yield from flush()


_COUNTED = "bucket long, c0 binary, c1 binary, c2 binary, masses binary"


def _gather(group: pa.Table) -> pa.Table:
    """One bucket of words with their counts; one row."""
    words, restaurant, n = _joined(group, "c0", "<u8"), _joined(group, "c1", "u1"), _joined(group, "c2", "<u4")
    distinct, first, index = np.unique(words, return_index=True, return_inverse=True)
    total = np.bincount(index, n).astype(np.int64)
    distinct, restaurant, total = (x[total > 0] for x in (distinct, restaurant[first], total))
    masses = [np.frombuffer(x, np.int64) for x in group["masses"].to_pylist() if x is not None]
    return pa.table(
        {
            "bucket": group["bucket"].slice(0, 1),
            "words": _packed(distinct),
            "restaurant": _packed(restaurant),
            "n": _packed(total.astype(np.uint64)),
            "n_words": [len(distinct)],
            "n_tokens": [int(total.sum())],
            "masses": [np.sum(masses, axis=0).tolist() if masses else [0] * RESTAURANTS],
            "common": _packed(np.bincount(_size_class(total), minlength=256).astype(np.int64)),
        }
    )


def _size_class(counts: np.ndarray) -> np.ndarray:
    """Classes of counts, eight to a doubling."""
    return np.minimum(np.floor(np.log2(counts) * 8).astype(np.int64), 255)


_COUNTS = (
    "bucket long, words binary, restaurant binary, n binary, n_words long, n_tokens long, masses array<long>, common binary"
)


def _hot(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words seen ``least`` times, with their class and count."""
    for batch in batches:
        for row in batch.to_pylist():
            n = _loosened(row["n"], "<u8")
            some = n >= least
            columns = _loosened(row["words"], "<u8")[some], _loosened(row["restaurant"], "u1")[some], n[some]
            yield pa.record_batch({name: pa.array([c.tobytes()], pa.binary()) for name, c in zip(("words", "restaurant", "n"), columns)})


# --- dealing tokens to contexts -------------------------------------------------


class Coded:
    """What all tasks know of words: the numbers of frequent ones (0 is any
    other word, 1 the start of a text), their class as a context and their
    count, and where the contexts of every class lie among the buckets."""

    def __init__(self, words: np.ndarray, restaurant: np.ndarray, n: np.ndarray, masses: np.ndarray, log_total: float) -> None:
        order = np.lexsort((words, -n))  # small numbers for the commonest
        self.words = np.concatenate([np.zeros(2, np.uint64), words[order]])
        self.restaurant = np.concatenate([np.full(2, START, np.uint8), restaurant[order]])
        n = np.concatenate([np.zeros(2, np.int64), n[order]])
        self.parts = np.maximum(-(-n // SPLIT), 1)
        self.log_total = log_total
        self.base = np.where(np.arange(len(n)) > 1, np.log10(n + 1) - log_total, 0)
        self._by_hash = np.argsort(self.words[2:]) + 2
        self._hashes = self.words[self._by_hash]
        masses = np.where(np.arange(RESTAURANTS) < START, 0, masses + 1)
        self.masses = masses / masses.sum()
        self.begins = np.cumsum(self.masses) - self.masses

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self._hashes):
            return np.zeros(len(hashes), np.uint32)
        at = np.minimum(np.searchsorted(self._hashes, hashes), len(self._hashes) - 1)
        return np.where(self._hashes[at] == hashes, self._by_hash[at], 0).astype(np.uint32)

    def place(self, restaurant, hashes: np.ndarray, buckets: int) -> np.ndarray:
        """The bucket of a context: contexts of one class lie side by side, by
        their hash, each class on as many buckets as it has tokens."""
        share = ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.float64) / (1 << 24)
        return np.minimum(((self.begins[restaurant] + self.masses[restaurant] * share) * buckets).astype(np.int64), buckets - 1)


def _part(second: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Which of a word's restaurants is for the word before it."""
    return (second >> np.uint64(13)) % parts.astype(np.uint64)


def _deal(buckets: int, shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per chunk of texts its tokens with their two preceding words, as blobs by
    bucket of contexts, and a row on the texts, with the sums over hot words."""
    coded, reader = shared.value, _Reader()
    texts, keys, train, held = [], [], [], 0
    task, chunk = TaskContext.get().partitionId() << 32, 0

    def flush() -> Iterator[pa.RecordBatch]:
        ids, lengths = np.concatenate(texts), np.array([len(t) for t in texts])
        doc = np.repeat(np.arange(len(lengths)), lengths)
        hashes, contexts, code = reader.hashes, reader.contexts, coded.numbers(reader.hashes)
        first, second = _before(ids, 1), _before(ids, 2)
        starts = np.flatnonzero(first == 0)
        second[starts] = 0
        # as context, 0 is the start of a text
        parts, as_context, context_hash = coded.parts[code], code.copy(), hashes.copy()
        parts[0], as_context[0], context_hash[0] = 1, 1, 0
        bucket = coded.place(contexts, hashes, buckets)[first]
        bucket[starts] = coded.place(START, hashes[ids[starts]], buckets)
        split = np.flatnonzero(parts[first] > 1)
        if len(split):
            u = first[split]
            bucket[split] = coded.place(contexts[u], hashes[u] + _part(context_hash[second[split]], parts[u]), buckets)
        order = np.argsort(bucket.astype(np.uint16 if buckets <= 1 << 16 else np.int64), kind="stable")
        begins = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])
        ids, first, second, doc_of = ids[order], first[order], second[order], doc[order]
        step = np.diff(doc_of, prepend=0)
        full = np.flatnonzero(begins[1:] > begins[:-1])
        step[begins[full]] = doc_of[begins[full]]
        roles = code[ids], as_context[first], as_context[second]
        planes = np.empty((12, len(ids)), np.uint8)
        for i, role in enumerate(roles):
            planes[3 * i : 3 * i + 3] = role.view(np.uint8).reshape(-1, 4)[:, :3].T
        planes[9:11] = step.astype(np.uint16).view(np.uint8).reshape(-1, 2).T
        planes[11] = np.array(train, np.uint8)[doc_of]
        cold = [(role == 0) for role in roles]
        cold_begins = [np.concatenate([[0], np.cumsum(c)])[begins] for c in cold]
        cold_hashes = [hashes[x[c]] for x, c in zip((ids, first, second), cold)]
        cold_class = contexts[first[cold[1]]]
        data = {"bucket": [], "chunk": [], "n": [], "tokens": [], "cold": [], "docs": []}
        for b in full:
            begin, end = begins[b], begins[b + 1]
            of_b = [slice(x[b], x[b + 1]) for x in cold_begins]
            rare = b"".join([*[h[i].tobytes() for h, i in zip(cold_hashes, of_b)], cold_class[of_b[1]].tobytes()])
            row = (b, task + chunk, end - begin, pa.compress(planes[:, begin:end].tobytes(), "zstd", asbytes=True), rare, None)
            for column, value in zip(data.values(), row):
                column.append(value)
        begin = np.cumsum(lengths) - lengths
        ids = np.concatenate(texts)
        known, base = np.add.reduceat((code > 0)[ids].astype(np.int64), begin), np.add.reduceat(coded.base[code][ids], begin)
        empty = np.array([k is None for k in keys], np.uint8)
        key = np.array([0 if k is None else k for k in keys], np.int64)
        docs = b"".join(x.tobytes() for x in (key, base, lengths.astype(np.uint32), known.astype(np.uint32), empty))
        for column, value in zip(data.values(), ((task + chunk) % buckets, task + chunk, len(keys), None, None, docs)):
            column.append(value)
        yield pa.record_batch([pa.array(c, t) for c, t in zip(data.values(), _DEALT_TYPES)], names=list(data))

    for batch in batches:
        for key, value, trains_ in zip(*batch.columns):
            texts.append(reader.ids(value.as_py()))
            keys.append(key.as_py())
            train.append(trains_.as_py())
            held += len(texts[-1])
            if held > _TOKENS_AT_ONCE or len(reader.vocabulary) > _VOCABULARY_AT_ONCE or len(texts) >= _TEXTS_AT_ONCE:
                yield from flush()
                texts, keys, train, held, chunk = [], [], [], 0, chunk + 1
                reader.reset()
    if texts:
        yield from flush()


_DEALT = "bucket long, chunk long, n long, tokens binary, cold binary, docs binary"
_DEALT_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]

# --- seating ------------------------------------------------------------------


class Model:
    """What all tasks share: vocabulary size, discounts, restaurant totals."""

    def __init__(self, vocabulary: int, discount: float) -> None:
        self.vocabulary, self.discounts = vocabulary, np.full(RESTAURANTS, discount)
        self.settle([])

    def settle(self, rows: list) -> None:
        """Restaurant totals, from the totals of all buckets."""
        self.customers, self.tables = (
            np.sum([r[name] for r in rows], axis=0) if rows else np.zeros(RESTAURANTS)
            for name in ("all_customers", "all_tables")
        )

    def own(self, restaurant, customers, tables, parent_p):
        """Predictive probability of a dish from its counts and the parent's."""
        d = self.discounts[restaurant]
        seated = np.maximum(customers - d * tables, 0)
        return (seated + (STRENGTH + d * self.tables[restaurant]) * parent_p) / (STRENGTH + self.customers[restaurant])

    def base(self, known: np.ndarray) -> np.ndarray:
        return np.where(known, 0.5 / max(self.vocabulary, 1), 0.5)


class Seating:
    """All restaurants' customers and tables of the words of one bucket.

    Entries are ordered by (word, restaurant) and include every class that a
    word has a child in, and the root."""

    def __init__(self, entries: np.ndarray, restaurant: np.ndarray, customers: np.ndarray) -> None:
        word = np.repeat(np.arange(len(entries)), entries)
        restaurant = restaurant.astype(np.int64)
        key = word * RESTAURANTS + restaurant
        above = word * RESTAURANTS + PARENTS[restaurant]
        # subclasses bring their classes, classes the root
        keys = np.sort(np.concatenate([key, above, np.arange(len(entries)) * RESTAURANTS]))
        self.key = keys[np.flatnonzero(np.diff(keys, prepend=-1))]  # np.unique hashes, which is slower
        self.restaurant = self.key % RESTAURANTS
        self.parent = np.searchsorted(self.key, self.key - self.restaurant + PARENTS[self.restaurant])
        self.tokens = np.zeros(len(self.key))
        self.tokens[np.searchsorted(self.key, key)] = customers
        self.levels = [
            np.flatnonzero(self.restaurant >= FIRST_SUBCLASS),
            np.flatnonzero((self.restaurant >= FIRST_CLASS) & (self.restaurant < FIRST_SUBCLASS)),
            np.flatnonzero(self.restaurant == ROOT),
        ]
        self.customers, self.tables = self.tokens.copy(), np.zeros(len(self.key))
        for level in self.levels:  # one table each to begin with
            self.tables[level] = self.customers[level] > 0
            self._pass_up(level)
        self.seats = [Arrivals(self.customers[level]) for level in self.levels]

    def _pass_up(self, level: np.ndarray) -> None:
        """Tables of a level are the customers that its parents have besides tokens."""
        if len(level) and self.restaurant[level[0]] != ROOT:
            up = self.parent[level]
            np.add.at(self.customers, up, self.tables[level])

    def totals(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.bincount(self.restaurant, x, RESTAURANTS) for x in (self.customers, self.tables))

    def sweep(self, model: Model, rng: np.random.RandomState) -> None:
        for depth, level in enumerate(self.levels):
            if not len(level):
                continue
            # seats above as they are without the tables that leave
            p = model.base(np.ones(len(level), bool))
            chain, at = [], level
            while self.restaurant[at[0]] != ROOT:
                at = self.parent[at]
                chain.append(at)
            for i, up in enumerate(reversed(chain)):
                first = i == len(chain) - 1
                c = self.customers[up] - (self.tables[level] if first else 0)
                p = model.own(self.restaurant[up], np.maximum(c, 0), np.minimum(self.tables[up], np.maximum(c, 0)), p)
            r, old = self.restaurant[level], self.tables[level]
            new = self.seats[depth].sit_again(self.customers[level], model.tables[r] - old, model.discounts[r], p, rng)
            self.tables[level] = new
            if depth < 2:
                np.add.at(self.customers, self.parent[level], new - old)


class Arrivals:
    """Which customers opened the tables of every dish of a level.

    The customers of a dish are exchangeable, so they go by their order of
    arrival. The first opens a table; kept are, for every further table, the
    dish and the number of the customer who opened it."""

    def __init__(self, customers: np.ndarray) -> None:
        self.seated, self.drawn = customers.astype(np.int64), False
        self.dish = self.opener = np.zeros(0, np.int64)

    def sit_again(self, customers: np.ndarray, others: np.ndarray, discount: np.ndarray, parent_p: np.ndarray, rng) -> np.ndarray:
        """Tables after all customers of every dish left and took their seats
        again. ``others`` are a restaurant's tables that serve other dishes.

        Seats are drawn one customer after the other. Such a draw is blind to
        the customers still to come; it is taken, or the customers go back to
        the seats they had, by the Metropolis-Hastings rule, which leaves the
        posterior of the seats given everyone else as it is."""
        customers = customers.astype(np.int64)
        weights = STRENGTH + discount * np.maximum(others, 0), discount, parent_p
        # the parent's customers are tables of its children: some came or went
        stay = self.opener <= customers[self.dish]
        dish, opener = self.dish[stay], self.opener[stay]
        come = np.flatnonzero(customers > self.seated)
        if len(come):
            tables = 1 + np.bincount(dish, minlength=len(customers))[come]
            more = _arrive(customers, come, self.seated[come], tables, *weights, rng)
            dish, opener = np.concatenate([dish, more[0]]), np.concatenate([opener, more[1]])
        big = np.flatnonzero(customers > 2)
        one = np.ones(len(big), np.int64)
        new, new_opener = _arrive(customers, big, one, one, *weights, rng)
        # of two customers, the second opens a table or not
        two = np.flatnonzero(customers == 2)
        opens = (weights[0][two] + discount[two]) * parent_p[two]
        two = two[rng.random_sample(len(two)) * (opens + 1 - discount[two]) < opens]
        new, new_opener = np.concatenate([new, two]), np.concatenate([new_opener, np.full(len(two), 2)])
        # two customers' seats are exact as drawn; what stood before the first draw is no draw
        judged = np.flatnonzero(customers > (2 if self.drawn else np.inf))
        self.drawn = True
        gain = _log_choices(customers, judged, new, new_opener, *weights) - _log_choices(customers, judged, dish, opener, *weights)
        taken = np.ones(len(customers), bool)
        taken[judged] = np.log1p(-rng.random_sample(len(judged))) <= gain
        ours, theirs = taken[new], ~taken[dish]
        self.dish = np.concatenate([dish[theirs], new[ours]])
        self.opener = np.concatenate([opener[theirs], new_opener[ours]])
        self.seated = customers
        return (customers > 0) + np.bincount(self.dish, minlength=len(customers)).astype(float)


def _arrive(customers, dish, seated, tables, room, discount, parent_p, rng) -> tuple[np.ndarray, np.ndarray]:
    """The dishes and numbers of the customers who open tables, when those
    after the ``seated`` ones take seats one after the other: a new table has
    the weight (room + discount * tables) * parent_p, the dish's tables
    together the number seated less a discount per table.

    The wait for the next new table is drawn at once: while nobody opens one,
    a customer joins with chance a / (a + new), and a grows by one. That is
    the law of a geometric wait whose chance is drawn from Beta(new, a)."""
    dishes, openers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(dish):
        d = discount[dish]
        chance = rng.beta((room[dish] + d * tables) * parent_p[dish], seated - d * tables)
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            opener = seated + 1 + np.floor(np.log(rng.random_sample(len(dish))) / np.log1p(-chance))
        go = opener <= customers[dish]
        dish, seated, tables = dish[go], opener[go].astype(np.int64), tables[go] + 1
        dishes.append(dish)
        openers.append(seated)
    return np.concatenate(dishes), np.concatenate(openers)


def _log_choices(customers, judged, dish, opener, room, discount, parent_p) -> np.ndarray:
    """Per judged dish the log of the product, over its customers, of all the
    weights that a customer chose among: what a draw customer by customer
    divides the seats' joint weight by."""
    at = np.full(len(customers), -1)
    at[judged] = np.arange(len(judged))
    kept = at[dish] >= 0
    dish = np.concatenate([judged, dish[kept]])
    first = np.concatenate([np.ones(len(judged), np.int64), opener[kept]])
    order = np.argsort(dish, kind="stable")
    dish, first = dish[order], first[order]
    last = customers[dish]
    same = np.flatnonzero(dish[1:] == dish[:-1])
    last[same] = first[same + 1]
    begins = np.searchsorted(dish, judged)
    tables = np.arange(len(dish)) - begins[at[dish]] + 1
    d = discount[dish]
    other = (room[dish] + d * tables) * parent_p[dish] - d * tables
    return np.bincount(at[dish], _log_gamma(last + other) - _log_gamma(first + other), len(judged))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function, x > 0: Stirling's series at x + 8."""
    product, y = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6) * (x + 7), x + 8
    series = (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - (1 / 360 - 1 / (1260 * y * y)) / (y * y)) / y
    return series - np.log(product)


def _sit(model: Model, group: pa.RecordBatch, row: int) -> tuple[Seating, np.random.RandomState]:
    value = lambda name, dtype: _loosened(group.column(name)[row].as_py(), dtype)
    seating = Seating(value("entries", "u1").astype(np.int64), value("restaurant", "u1"), value("customers", "<u8"))
    return seating, np.random.RandomState(SEED + group.column("bucket")[row].as_py() % (1 << 31))


def _opening(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Restaurant totals after one sweep from the first seating."""
    for batch in batches:
        for row in range(batch.num_rows):
            seating, rng = _sit(model, batch, row)
            seating.sweep(model, rng)
            customers, tables = seating.totals()
            yield pa.record_batch({"all_customers": pa.array([customers.tolist()]), "all_tables": pa.array([tables.tolist()])})


def _gibbs(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Averaged customers and tables of every bucket."""
    for batch in batches:
        for row in range(batch.num_rows):
            seating, rng = _sit(model, batch, row)
            customers, tables = np.zeros(len(seating.key)), np.zeros(len(seating.key))
            for i in range(BURN_IN + SAMPLES):
                seating.sweep(model, rng)
                if i >= BURN_IN:
                    customers += seating.customers
                    tables += seating.tables
            n_words = int(seating.key[-1] // RESTAURANTS) + 1 if len(seating.key) else 0
            word = seating.key // RESTAURANTS
            count = np.bincount(word, seating.tokens, n_words)
            c, t = (np.bincount(seating.restaurant, x / SAMPLES, RESTAURANTS) for x in (customers, tables))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("bucket").slice(row, 1),
                    batch.column("words").slice(row, 1),
                    _packed(np.bincount(word, minlength=n_words).astype(np.uint8)),
                    _packed(seating.restaurant.astype(np.uint8)),
                    _packed(customers.astype(np.uint64)),
                    _packed(tables.astype(np.uint64)),
                    _packed(count.astype(np.uint64)),
                    pa.array([c.tolist()]),
                    pa.array([t.tolist()]),
                ],
                names=["bucket", "words", "entries", "restaurant", "customers", "tables", "n", "all_customers", "all_tables"],
            )


_SEATS = (
    "bucket long, words binary, entries binary, restaurant binary, customers binary, tables binary, n binary,"
    " all_customers array<double>, all_tables array<double>"
)

# --- probabilities --------------------------------------------------------------


class Seats:
    """The averaged seats of one bucket, for lookups."""

    def __init__(self, values) -> None:
        self.words = _loosened(values["words"], "<u8")
        entries = _loosened(values["entries"], "u1").astype(np.int64)
        self.n = _loosened(values["n"], "<u8").astype(np.int64)
        restaurant = _loosened(values["restaurant"], "u1")
        self.key = np.repeat(np.arange(len(entries)), entries) * RESTAURANTS + restaurant
        self.customers = _loosened(values["customers"], "<u8") / SAMPLES
        self.tables = _loosened(values["tables"], "<u8") / SAMPLES

    def find(self, words: np.ndarray) -> np.ndarray:
        """Index of each word, -1 if it isn't in the training data."""
        at = np.searchsorted(self.words, words)
        at[at == len(self.words)] = 0
        return np.where(self.words[at] == words, at, -1) if len(self.words) else np.full(len(words), -1)

    def asked(self, model: Model, index: np.ndarray, restaurant: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Customers and tables of words in classes, and the parents' probabilities."""
        order = np.argsort(index * RESTAURANTS + restaurant)  # lookups side by side
        index, restaurant = index[order], restaurant[order]
        p = model.own(ROOT, *self._counts(index, np.zeros_like(restaurant)), model.base(index >= 0))
        below = np.flatnonzero(restaurant != START)
        classes = PARENTS[restaurant[below]]
        p[below] = model.own(classes, *self._counts(index[below], classes), p[below])
        out = np.empty((3, len(order)))
        out[:, order] = *self._counts(index, restaurant), p
        return tuple(out)

    def _counts(self, index: np.ndarray, restaurant: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = index * RESTAURANTS + restaurant
        if not len(self.key):
            return np.zeros(len(key)), np.zeros(len(key))
        at = np.searchsorted(self.key, key)
        at[at == len(self.key)] = 0
        there = (self.key[at] == key) & (index >= 0)
        return np.where(there, self.customers[at], 0), np.where(there, self.tables[at], 0)

    def probabilities(self, model: Model, index: np.ndarray, restaurant: np.ndarray) -> np.ndarray:
        p = model.base(index >= 0)
        is_sub = restaurant >= FIRST_SUBCLASS
        classes = np.where(is_sub, PARENTS[restaurant], restaurant)
        for r, use in ((np.zeros_like(classes), None), (classes, classes > 0), (restaurant, is_sub)):
            c, t = self._counts(index, r)
            q = model.own(r, c, t, p)
            p = q if use is None else np.where(use, q, p)
        return p


# --- word contexts ----------------------------------------------------------------


class Contexts:
    """The restaurants of the preceding word and of the two preceding words, for
    the words of one bucket of contexts.

    A triple is a word in the restaurant of two words, a pair one in that of one
    word; a pair's customers are the tables of its triples. ``pair_of`` and
    ``context`` are the pair and the restaurant of every triple, ``restaurant``
    that of every pair. Words that are only to be scored have no customers."""

    def __init__(self, pair_of: np.ndarray, context: np.ndarray, customers: np.ndarray, restaurant: np.ndarray) -> None:
        self.pair_of, self.context, self.restaurant = pair_of, context, restaurant
        self.tokens = customers.astype(float)
        self.tables = [(customers > 0).astype(float), None]
        self.customers = np.bincount(pair_of, self.tables[0], len(restaurant))
        self.tables[1] = (self.customers > 0).astype(float)
        # a single customer has a table of its own, whatever happens
        self.several = [np.flatnonzero(customers > 1), np.flatnonzero(np.bincount(pair_of, customers, len(restaurant)) > 1)]
        self.seats = [Arrivals(self.tokens[self.several[0]]), Arrivals(self.customers[self.several[1]])]

    def singles(self) -> list[int]:
        """Triples, then pairs, with one and with two customers."""
        return [int((x == n).sum()) for x in (self.tokens, self.customers) for n in (1, 2)]

    def sweep(self, discounts: tuple[float, float], p: np.ndarray, without: np.ndarray, rng: np.random.RandomState) -> None:
        """``p`` are the classes' probabilities of every pair's word, ``without``
        those without the pair's own tables."""
        triples, pairs = self.several
        up, of = self.pair_of[triples], self.restaurant
        c, t = np.bincount(of, self.customers), np.bincount(of, self.tables[1])
        old, d = self.tables[0][triples], discounts[1]
        left = self.customers[up] - old
        parent_p = np.maximum(left - d * np.minimum(self.tables[1][up], left), 0) + (STRENGTH + d * t[of[up]]) * p[up]
        parent_p /= STRENGTH + c[of[up]] - old
        others = np.bincount(self.context, self.tables[0])[self.context[triples]] - old
        new = self.seats[0].sit_again(self.tokens[triples], others, np.full(len(old), discounts[0]), parent_p, rng)
        self.tables[0][triples] = new
        np.add.at(self.customers, up, new - old)
        old = self.tables[1][pairs]
        others = t[of[pairs]] - old
        self.tables[1][pairs] = self.seats[1].sit_again(self.customers[pairs], others, np.full(len(old), d), without[pairs], rng)

    def probabilities(self, discounts: tuple[float, float], p: np.ndarray, customers: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """Of every triple, from averaged seats."""
        for c, t, d, r, up in (
            (customers, tables[1], discounts[1], self.restaurant, slice(None)),
            (self.tokens, tables[0], discounts[0], self.context, self.pair_of),
        ):
            all_c, all_t = np.bincount(r, c), np.bincount(r, t)
            p = (np.maximum(c - d * t, 0) + (STRENGTH + d * all_t[r]) * p[up]) / (STRENGTH + all_c[r])
        return p


def _discount(once: int, twice: int) -> float:
    return min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)


def _runs(a: np.ndarray) -> np.ndarray:
    """Numbers of the runs of equal values."""
    return np.cumsum(np.diff(a, prepend=a[:1]) != 0)


def _contexts(shared, group: pa.Table) -> pa.Table:
    """The tokens of one bucket, in one row: triples, pairs, and the words of
    classes that it asks for with the tables that an opening sweep gives them.
    Rows on texts pass through."""
    coded, hot = shared.value, len(shared.value.words)
    rows = sorted((r for r in group.drop(["bucket", "docs"]).to_pylist() if r["tokens"] is not None), key=lambda r: r["chunk"])
    out = [r | {"bucket": group["bucket"][0].as_py()} for r in group.select(["chunk", "docs"]).to_pylist() if r["docs"] is not None]
    if rows:
        out.append({"bucket": group["bucket"][0].as_py()} | _arranged(coded, hot, rows, group["bucket"][0].as_py()))
    return pa.Table.from_pylist(out, schema=_CONTEXTS_SCHEMA)


def _arranged(coded: Coded, hot: int, rows: list[dict], bucket: int) -> dict:
    sizes = np.array([r["n"] for r in rows])
    planes = np.concatenate([np.frombuffer(_expanded(r["tokens"], 12 * r["n"]), np.uint8).reshape(12, -1) for r in rows], axis=1)
    roles = [planes[3 * i] | planes[3 * i + 1].astype(np.int64) << 8 | planes[3 * i + 2].astype(np.int64) << 16 for i in range(3)]
    steps, train = planes[9] | planes[10].astype(np.uint16) << 8, planes[11].astype(bool)
    del planes
    # words without a number are numbered here
    ends = np.cumsum(sizes)
    rare, classes = [[], [], []], []
    for r, begin, end in zip(rows, ends - sizes, ends):
        at = 0
        for i, role in enumerate(roles):
            n = int((role[begin:end] == 0).sum())
            rare[i].append(np.frombuffer(r["cold"], "<u8", n, at))
            at += 8 * n
        classes.append(np.frombuffer(r["cold"], "u1", len(rare[1][-1]), at))
    rare = [np.concatenate(x) for x in rare]
    names, number = np.unique(np.concatenate(rare), return_inverse=True)
    restaurant_of = np.concatenate([coded.restaurant, np.full(len(names), START, np.uint8)]).astype(np.int64)
    at = 0
    for i, role in enumerate(roles):
        mine = number[at : at + len(rare[i])]
        at += len(mine)
        if i == 1:
            restaurant_of[hot + mine] = np.concatenate(classes)
        role[role == 0] = hot + mine
    hashes, words = np.concatenate([coded.words, names]), hot + len(names)
    word, first, second = roles
    parts = np.concatenate([coded.parts, np.ones(len(names), np.int64)])
    most = int(parts.max())
    if most > 1:
        split = np.flatnonzero(parts[first] > 1)
        first = first * most
        first[split] += _part(hashes[second[split]], parts[first[split] // most]).astype(np.int64)
    if words * most * words < (1 << 63) // words:  # one sort tells triples and pairs
        triple, entry = np.unique((first * words + word) * words + second, return_inverse=True)
        of_pair, second_of = triple // words, triple % words
        pair_of = _runs(of_pair)
        pair = of_pair[np.flatnonzero(np.diff(pair_of, prepend=-1))]
    else:
        pair, of_pair = np.unique(first * words + word, return_inverse=True)
        triple, entry = np.unique(of_pair * words + second, return_inverse=True)
        pair_of, second_of = triple // words, triple % words
    del word, first, second, of_pair, roles, triple
    entry = entry.astype(np.uint32)
    word_of, first_of = pair % words, pair // words
    context = np.unique(first_of[pair_of] * words + second_of, return_inverse=True)[1].astype(np.int32)
    del second_of
    restaurant, start = _runs(first_of), first_of // most == 1
    customers = np.bincount(entry[train], minlength=len(pair_of))
    tokens = np.bincount(pair_of, customers, len(pair))
    customers[start[pair_of]] = 0  # first words are drawn from the class itself
    asked, of_asked = np.unique(restaurant_of[first_of // most] * words + word_of, return_inverse=True)
    seated = Contexts(pair_of, context, customers, restaurant)
    singles = seated.singles()
    # the opening sweep
    of_word = np.bincount(word_of, tokens, words)
    p = ((of_word + 0.5) / (of_word.sum() + 0.5 * words))[word_of]
    seated.sweep((_discount(*singles[:2]), _discount(*singles[2:])), p, p, np.random.RandomState(SEED + bucket % (1 << 31)))
    opened = np.where(start, tokens, seated.tables[1])
    return {
        "chunks": _squeezed(np.array([r["chunk"] for r in rows])),
        "sizes": _squeezed(sizes),
        "steps": _squeezed(steps),
        "entry": _squeezed(entry),
        "pair_of": _squeezed(np.diff(pair_of, prepend=0).astype(np.uint32)),
        "context": _squeezed(context.astype(np.uint32)),
        "customers": _squeezed(customers.astype(np.uint32)),
        "restaurant": _squeezed(np.diff(restaurant, prepend=0).astype(np.uint32)),
        "of_asked": _squeezed(of_asked.astype(np.uint32)),
        "opened": _squeezed(np.where(start, 0, opened).astype(np.uint32)),
        "words": _squeezed(hashes[asked % words]),
        "classes": _squeezed((asked // words).astype(np.uint8)),
        "rare": _squeezed((asked % words >= hot).astype(np.uint8)),
        "tables": _squeezed(np.bincount(of_asked, opened, len(asked)).astype(np.uint32)),
        "n": _squeezed(np.bincount(of_asked, tokens, len(asked)).astype(np.uint32)),
        "singles": singles,
    }


_ASKED = ("words", "classes", "tables", "n")
_KEPT = ("chunks", "sizes", "steps", "entry", "pair_of", "context", "customers", "restaurant", "of_asked", "opened", "rare")
_CONTEXTS = f"bucket long, chunk long, docs binary, {', '.join(f'{c} binary' for c in (*_KEPT, *_ASKED))}, singles array<long>"
_CONTEXTS_SCHEMA = pa.schema(
    [("bucket", pa.int64()), ("chunk", pa.int64()), ("docs", pa.binary()), *[(c, pa.binary()) for c in (*_KEPT, *_ASKED)],
     ("singles", pa.list_(pa.int64()))]
)

# --- classes: what the buckets of contexts ask for -----------------------------------


def _ask(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The asked words of a bucket of contexts, as blobs by bucket of words."""
    for batch in batches:
        for row in batch.to_pylist():
            words, classes, tables, n = (_loosened(row[c], t) for c, t in zip(_ASKED, ("<u8", "u1", "<u4", "<u4")))
            for blobs in _blobs(buckets, words, classes, tables, n):
                yield blobs.append_column("asker", pa.array([row["bucket"]] * blobs.num_rows, pa.int64()))


_QUESTIONS = "bucket long, c0 binary, c1 binary, c2 binary, c3 binary, asker long"


def _first_totals(word: np.ndarray, restaurant: np.ndarray, customers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What ``Seating(...).totals()`` are before any sweep: one table a dish.
    Entries are in the order of (word, restaurant) and have customers."""
    all_customers = np.bincount(restaurant, customers, RESTAURANTS)
    all_tables = np.bincount(restaurant, minlength=RESTAURANTS).astype(float)
    sub = restaurant >= FIRST_SUBCLASS
    above = (word * RESTAURANTS + PARENTS[restaurant])[sub]
    all_customers += np.bincount(PARENTS[restaurant[sub]], minlength=RESTAURANTS)
    all_tables += np.bincount(above[np.flatnonzero(np.diff(above, prepend=-1))] % RESTAURANTS, minlength=RESTAURANTS)
    all_customers[ROOT] += all_tables[FIRST_CLASS:FIRST_SUBCLASS].sum()
    all_tables[ROOT] += len(np.flatnonzero(np.diff(word, prepend=-1)))
    return all_customers, all_tables


def _answerable(group: pa.Table) -> pa.Table:
    """One bucket of words: the classes' customers, and who asked for what; one row."""
    group = group.sort_by("asker")
    words, classes = _joined(group, "c0", "<u8"), _joined(group, "c1", "u1").astype(np.int64)
    tables, n = _joined(group, "c2", "<u4"), _joined(group, "c3", "<u4")
    distinct, index = np.unique(words, return_inverse=True)
    total = np.bincount(index, n).astype(np.int64)
    known = total > 0
    place = np.where(known, np.cumsum(known) - 1, -1)[index]
    pair, at = np.unique(index * RESTAURANTS + classes, return_inverse=True)
    customers = np.bincount(at, tables).astype(np.int64)
    pair, customers = pair[customers > 0], customers[customers > 0]
    entries, restaurant = np.bincount(pair // RESTAURANTS, minlength=len(distinct))[known], pair % RESTAURANTS
    opening = _first_totals(pair // RESTAURANTS, restaurant, customers)
    return pa.table(
        {
            "bucket": group["bucket"].slice(0, 1),
            "words": _packed(distinct[known]),
            "entries": _packed(entries.astype(np.uint8)),
            "restaurant": _packed(restaurant.astype(np.uint8)),
            "customers": _packed(customers.astype(np.uint64)),
            "total": pa.array([_squeezed(total[known])], pa.binary()),
            "askers": [group["asker"].to_pylist()],
            "asks": [[len(x) for x in group["c1"].to_pylist()]],
            "place": pa.array([_squeezed(place.astype(np.int32))], pa.binary()),
            "classes": pa.array([_squeezed(classes.astype(np.uint8))], pa.binary()),
            "once": [int((customers == 1).sum())],
            "twice": [int((customers == 2).sum())],
            "all_customers": [opening[0].tolist()],
            "all_tables": [opening[1].tolist()],
        }
    )


_CARRIED = "total binary, askers array<long>, asks array<long>, place binary, classes binary"
_CLASSES = (
    f"bucket long, words binary, entries binary, restaurant binary, customers binary, {_CARRIED},"
    " once long, twice long, all_customers array<double>, all_tables array<double>"
)


def _seated(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Averaged seats of the classes, with who asked for what."""
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1)
            for seats in _gibbs(model, iter([one])):
                for name in ("total", "askers", "asks", "place", "classes"):
                    seats = seats.append_column(name, one.column(name))
                yield seats


def _answers(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """To each bucket of contexts, for the words it asked a bucket of words for:
    customers and tables in their class, the class's parent's probability, count."""
    for batch in batches:
        for row in batch.to_pylist():
            seats, index = Seats(row), _loosened(row["place"], "<i4").astype(np.int64)
            customers, tables, p = seats.asked(model, index, _loosened(row["classes"], "u1").astype(np.int64))
            total = _loosened(row["total"], "<i8")
            n = np.where(index >= 0, total[index], 0) if len(total) else np.zeros(len(index), np.int64)
            end = np.cumsum(row["asks"])
            columns = [np.rint(customers * SAMPLES).astype(np.uint32), np.rint(tables * SAMPLES).astype(np.uint32), p.astype("<f4"), n.astype(np.uint32)]
            data = {"bucket": pa.array(row["askers"], pa.int64()), "from": pa.array([row["bucket"]] * len(end), pa.int64())}
            for i, c in enumerate(columns):
                data[f"c{i}"] = pa.array([_squeezed(c[b:e]) for b, e in zip(end - row["asks"], end)], pa.binary())
            if len(end):
                yield pa.record_batch(data)


_ANSWERS = "bucket long, from long, c0 binary, c1 binary, c2 binary, c3 binary"

# --- scoring --------------------------------------------------------------------------


def _score(buckets: int, model: Model, discounts: tuple[float, float], log_total: float, held: pa.Table, answers: pa.Table) -> pa.Table:
    """Sums per text of one bucket's tokens, by chunk; rows on texts pass through."""
    rows = held.to_pylist()
    out = [{"chunk": r["chunk"], "docs": r["docs"]} for r in rows if r["docs"] is not None]
    for row in rows:
        if row["docs"] is None:
            out += _sums(buckets, model, discounts, log_total, row, answers.sort_by("from").to_pylist())
    return pa.Table.from_pylist(out, schema=_SUMS_SCHEMA)


def _sums(buckets: int, model: Model, discounts: tuple[float, float], log_total: float, row: dict, answers: list[dict]) -> list[dict]:
    get = lambda name, dtype="<u4": _loosened(row[name], dtype)
    order, _ = _by_bucket(get("words", "<u8"), buckets)
    seats = np.empty((4, len(order)))
    for i, dtype in enumerate(("<u4", "<u4", "<f4", "<u4")):
        seats[i][order] = np.concatenate([_loosened(a[f"c{i}"], dtype) for a in answers])
    customers, tables, parent_p, n = seats[0] / SAMPLES, seats[1] / SAMPLES, seats[2], seats[3]
    classes, of_asked, opened = get("classes", "u1").astype(np.int64), get("of_asked").astype(np.int64), get("opened")
    p = model.own(classes, customers, tables, parent_p)[of_asked]
    left = np.maximum(customers[of_asked] - opened, 0)
    without = model.own(classes[of_asked], left, np.minimum(tables[of_asked], left), parent_p[of_asked])
    del seats, customers, tables, parent_p, left, opened, classes
    seated = Contexts(np.cumsum(get("pair_of"), dtype=np.int32), get("context").view(np.int32), get("customers").astype(np.int64),
                      np.cumsum(get("restaurant"), dtype=np.int32))
    rng = np.random.RandomState((SEED + 1 + row["bucket"]) % (1 << 31))
    sums = [np.zeros(len(seated.customers)), np.zeros(len(seated.tokens)), np.zeros(len(seated.customers))]
    for i in range(BURN_IN + SAMPLES):
        seated.sweep(discounts, p, without, rng)
        if i >= BURN_IN:
            for total, x in zip(sums, (seated.customers, *seated.tables)):
                total += x
    sums = [x / SAMPLES for x in sums]
    logs = np.log10(seated.probabilities(discounts, p, sums[0], sums[1:]))
    # of a rare word, the count and what it adds to the base score
    base = np.log10(n + 1) - log_total
    rare = np.flatnonzero(get("rare", "u1")[of_asked[seated.pair_of]])
    is_rare = np.zeros(len(logs), bool)
    is_rare[rare] = True
    entry, steps = get("entry"), get("steps", "<u2")
    out, end = [], np.cumsum(get("sizes", "<i8"))
    for chunk, begin, end in zip(get("chunks", "<i8"), end - get("sizes", "<i8"), end):
        doc, entries = np.cumsum(steps[begin:end], dtype=np.int64), entry[begin:end]
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        few = is_rare[entries]
        asked = of_asked[seated.pair_of[entries[few]]]
        few_doc = doc[few]
        few_first = np.flatnonzero(np.diff(few_doc, prepend=-1))
        of = [np.add.reduceat(x[asked], few_first) if len(few_first) else np.zeros(0) for x in (base, (n > 0).astype(float))]
        out.append({
            "chunk": int(chunk), "doc": _squeezed(np.diff(doc[first], prepend=0).astype(np.uint16)),
            "score": np.add.reduceat(logs[entries], first).astype("<f4").tobytes(),
            "rare_doc": _squeezed(np.diff(few_doc[few_first], prepend=0).astype(np.uint16)),
            "rare_base": of[0].tobytes(), "rare_known": _squeezed(of[1].astype(np.uint32)),
        })
    return out


_SUMS = "chunk long, docs binary, doc binary, score binary, rare_doc binary, rare_base binary, rare_known binary"
_SUMS_SCHEMA = pa.schema([(c, pa.int64() if c == "chunk" else pa.binary()) for c in ("chunk", "docs", "doc", "score", "rare_doc", "rare_base", "rare_known")])


def _finish(group: pa.Table) -> pa.Table:
    """The texts of one chunk with the sums of all buckets."""
    rows = group.to_pylist()
    (docs,) = (r["docs"] for r in rows if r["docs"] is not None)
    n = len(docs) // 25
    key, base = np.frombuffer(docs, "<i8", n), np.frombuffer(docs, "<f8", n, 8 * n).copy()
    lengths, known = np.frombuffer(docs, "<u4", n, 16 * n), np.frombuffer(docs, "<u4", n, 20 * n).astype(np.int64)
    score = np.zeros(n)
    parts = [r for r in rows if r["docs"] is None]
    # in an order that doesn't depend on which bucket came first
    for r in sorted(parts, key=lambda r: (r["doc"], r["score"])):
        score[np.cumsum(_loosened(r["doc"], "<u2"), dtype=np.int64)] += np.frombuffer(r["score"], "<f4")
        doc = np.cumsum(_loosened(r["rare_doc"], "<u2"), dtype=np.int64)
        base[doc] += np.frombuffer(r["rare_base"], "<f8")
        known[doc] += _loosened(r["rare_known"], "<u4")
    null = np.frombuffer(docs, "u1", n, 24 * n).astype(bool)
    return pa.table({"key": pa.array(key, pa.int64(), mask=null), "n_tokens": lengths.astype(np.int64), "n_known": known, "base_score": base, "score": score})


def _stage_buckets(df: DataFrame, partitions: int, purpose: str) -> DataFrame:
    """As ``stage``, and what meets the table by ``bucket`` comes to it: rows that
    lie in so many partitions by ``bucket`` are not dealt again."""
    if partitions > _MOST_BUCKETS:
        return stage(df, purpose)
    folder = run_folder(df.sparkSession, purpose)
    name = "marquee_" + folder.rpartition("/")[2].replace("-", "_")
    writer = df.write.options(**TABLE_OPTIONS).bucketBy(partitions, "bucket").format("parquet").option("path", folder)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, held_out, n_tokens, n_known, train_tokens,
    base_score (add-one unigrams), score (this model's log10 probability)."""
    spark = docs.sparkSession
    ship_package(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = 2 * partitions  # the task of a partition takes one after the other
    texts = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), trains(key).alias("trains"))
    training = docs.where(trains(key)).select(F.coalesce(F.col(text), F.lit("")).alias("text"))

    counts = stage(training.mapInArrow(partial(_count, buckets), _COUNTED).groupBy("bucket").applyInArrow(_gather, _COUNTS), "words")
    facts = counts.select("n_words", "n_tokens", "masses", "common").collect()  # one row per bucket
    vocabulary, total = (sum(r[c] for r in facts) for c in ("n_words", "n_tokens"))
    common = sum((_loosened(r["common"], "<i8") for r in facts), np.zeros(256, np.int64))
    at_least = np.cumsum(common[::-1])[::-1]
    least = int(np.ceil(2 ** (np.argmax(at_least <= HOT_WORDS) / 8)))
    hot = counts.select("words", "restaurant", "n").mapInArrow(partial(_hot, least), "words binary, restaurant binary, n binary").collect()
    words, restaurant, n = (
        np.concatenate([np.frombuffer(r[c], t) for r in hot] or [np.zeros(0, t)])
        for c, t in (("words", "<u8"), ("restaurant", "u1"), ("n", "<i8"))
    )
    log_total = float(np.log10(total + vocabulary + 1))
    masses = np.sum([r["masses"] for r in facts], axis=0) if facts else np.zeros(RESTAURANTS)
    shared = spark.sparkContext.broadcast(Coded(words, restaurant, n, masses, log_total))

    dealt = texts.mapInArrow(partial(_deal, buckets, shared), _DEALT)
    contexts = dealt.groupBy("bucket").applyInArrow(lambda group: _contexts(shared, group), _CONTEXTS)
    contexts = _stage_buckets(contexts, partitions, "contexts")
    drop_shuffles(spark)
    tokens = contexts.where("docs is null")
    singles = [r["singles"] for r in tokens.select("singles").collect()]
    singles = np.sum(singles, axis=0) if singles else np.zeros(4)
    discounts = _discount(*singles[:2]), _discount(*singles[2:])

    questions = tokens.select("bucket", *_ASKED).mapInArrow(partial(_ask, buckets), _QUESTIONS)
    classes = stage(questions.groupBy("bucket").applyInArrow(_answerable, _CLASSES), "classes")
    drop_shuffles(spark)
    facts = classes.select("once", "twice", "all_customers", "all_tables").collect()
    model = Model(vocabulary, _discount(*(sum(r[c] for r in facts) for c in ("once", "twice"))))
    model.settle(facts)
    model.settle(classes.select("bucket", "entries", "restaurant", "customers")
                 .mapInArrow(partial(_opening, model), "all_customers array<double>, all_tables array<double>").collect())
    seats = stage(classes.mapInArrow(partial(_seated, model), f"{_SEATS}, {_CARRIED}"), "seats")
    model.settle(seats.select("all_customers", "all_tables").collect())

    answers = seats.mapInArrow(partial(_answers, model), _ANSWERS)
    sums = contexts.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(
        lambda held, answers: _score(buckets, model, discounts, log_total, held, answers), _SUMS
    )
    each = sums.groupBy("chunk").applyInArrow(_finish, "key long, n_tokens long, n_known long, base_score double, score double")
    return each.select(
        F.col("key").alias(key),
        (~trains("key")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
