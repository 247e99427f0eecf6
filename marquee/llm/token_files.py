"""Token-id files with a minimal perfect hash index.

Format. A shard is one binary file: the ids of its documents in ascending key
order, each document closed by the end id, as a raw stream of little-endian
unsigned integers (two bytes an id if the vocabulary fits, else four), and
after that a footer with the shard's index. Shards follow each other in
ascending key order by file name, so the payload of a corpus is the
concatenation of the payloads of its shards.

Spark's text sink writes the shards: one row per document, the end id as the
line separator. So task retries and the commit protocol are Spark's own, on any
file system that Spark writes to. They are read with the ``binaryFile`` source.

Index. The footer holds a minimal perfect hash over the shard's distinct keys
(levels of bit arrays, a key settles on the first level where nothing else
hits its bit; its slot is the rank of that bit, counted from the nearest of the
stored ranks), and per slot a 32-bit fingerprint of the key, its first row and
its number of rows. The keys themselves stand nowhere in the files. A key is
found by a fixed number of probes: hash, rank, fingerprint, row start. ``get``
reads just those bytes of one shard; ``lookup`` and ``read_token_files`` probe
many keys at once. Which shard may hold a key is told by the shards' first and
last keys (``manifest``). A key that was never written is mistaken for one that
was in one of 4 billion cases.

Edge cases: NULL text is the empty text, one end id; an empty table gives no
shard with payload; rows that repeat a key are kept next to each other, the
slot says how many; rows with NULL keys come first and have no slot.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import ship_package, stage
from marquee.llm.tokens import encoder, vocabulary
from marquee.sources import files

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
MAGIC = b"MQTOKIX2"
#: bits per key on a level
GAMMA = 2
LEVELS = 40
MAX_LOOKUP = 100_000
_ROWS_OUT = 4 << 20
#: footer: rows, rows without key, distinct keys, bytes an id, first and last key
_HEAD = struct.Struct("<QQQIqq")
_ENTRY = np.dtype([("print", "<u4"), ("row", "<u4"), ("copies", "<u4")])
#: bits between two stored ranks
_RANKED = 512


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix (the finaliser of splitmix64) of unsigned keys."""
    x = keys + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys with fingerprints."""

    def __init__(self, sizes: list[int], bits: np.ndarray) -> None:
        self.sizes, self.bits = sizes, bits
        self.rank = np.concatenate(([0], np.cumsum(bits))).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels, left = [], [], keys.view(np.uint64)
        while len(left):
            if len(sizes) == LEVELS:
                raise ValueError("keys are not distinct")
            size = max(8, GAMMA * len(left))
            at = (_mix(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            hits = np.bincount(at, minlength=size)
            sizes.append(size)
            levels.append(hits == 1)
            left = left[hits[at] != 1]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where no level has it. Foreign keys may get a
        slot; the fingerprint tells."""
        keys = keys.view(np.uint64)
        found = np.full(len(keys), -1, np.int64)
        open_, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = base + (_mix(keys[open_], level) % np.uint64(size)).astype(np.int64)
            hit = self.bits[at]
            found[open_[hit]] = self.rank[at[hit]]
            open_ = open_[~hit]
            base += size
        return found

    @staticmethod
    def fingerprints(keys: np.ndarray) -> np.ndarray:
        return (_mix(keys.view(np.uint64), 97) >> np.uint64(32)).astype("<u4")

    def to_bytes(self) -> bytes:
        """Levels' sizes, ranks before every block of bits, bits."""
        head = struct.pack("<I", len(self.sizes)) + np.array(self.sizes, "<u8").tobytes()
        return head + self.rank[:-1:_RANKED].astype("<u8").tobytes() + np.packbits(self.bits).tobytes()

    @classmethod
    def from_bytes(cls, data: memoryview) -> PerfectHash:
        (n,) = struct.unpack_from("<I", data, 0)
        sizes = [int(x) for x in np.frombuffer(data, "<u8", n, 4)]
        at = 4 + 8 * n + 8 * -(-sum(sizes) // _RANKED)
        packed = np.frombuffer(data, np.uint8, -(-sum(sizes) // 8), at)
        return cls(sizes, np.unpackbits(packed, count=sum(sizes)).astype(bool))

    @staticmethod
    def probe(key: np.ndarray, read: Callable[[int, int], bytes]) -> int:
        """Slot of one key, -1 if it has none, from stored bytes alone:
        ``read(at, n)`` gives n bytes of ``to_bytes()``."""
        (n,) = struct.unpack("<I", read(0, 4))
        sizes = [int(x) for x in np.frombuffer(read(4, 8 * n), "<u8")]
        ranks = 4 + 8 * n
        bits, base = ranks + 8 * -(-sum(sizes) // _RANKED), 0
        for level, size in enumerate(sizes):
            at = base + int(_mix(key.view(np.uint64), level)[0] % np.uint64(size))
            block, within = divmod(at, _RANKED)
            held = np.unpackbits(np.frombuffer(read(bits + block * _RANKED // 8, within // 8 + 1), np.uint8))
            if held[within]:
                (rank,) = struct.unpack("<Q", read(ranks + 8 * block, 8))
                return rank + int(held[:within].sum())
            base += size
        return -1


def _footer(keys: np.ndarray, nulls: int, lengths: np.ndarray, width: int) -> bytes:
    """keys: of the rows after the ``nulls`` rows without key, ascending."""
    distinct, first, copies = np.unique(keys, return_index=True, return_counts=True)
    table = PerfectHash.build(distinct)
    slot = table.slots(distinct)
    by_slot = np.empty(len(distinct), _ENTRY)
    by_slot["print"][slot] = PerfectHash.fingerprints(distinct)
    by_slot["row"][slot] = first + nulls
    by_slot["copies"][slot] = copies
    starts = np.concatenate(([0], np.cumsum(lengths))).astype("<u8")
    ends = (int(distinct[0]), int(distinct[-1])) if len(distinct) else (1, 0)
    body = _HEAD.pack(len(lengths), nulls, len(distinct), width, *ends)
    body += by_slot.tobytes() + starts.tobytes() + table.to_bytes()
    return body + struct.pack("<Q", len(body)) + MAGIC


class Index:
    """What a shard's footer says about its keys."""

    def __init__(self, body: memoryview) -> None:
        self.rows, self.nulls, distinct, self.width, self.first, self.last = _HEAD.unpack_from(body, 0)
        at = _HEAD.size
        self.entries = np.frombuffer(body, _ENTRY, distinct, at)
        at += self.entries.nbytes
        self.starts = np.frombuffer(body, "<u8", self.rows + 1, at)
        self.table = PerfectHash.from_bytes(body[at + 8 * (self.rows + 1) :])

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and number of rows per key; -1 and 0 if it isn't here."""
        keys = np.ascontiguousarray(keys, np.int64)
        slot = self.table.slots(keys)
        row, copies = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        ok = slot >= 0
        ok[ok] = self.entries["print"][slot[ok]] == PerfectHash.fingerprints(keys[ok])
        row[ok], copies[ok] = self.entries["row"][slot[ok]], self.entries["copies"][slot[ok]]
        return row, copies


class Shard:
    """A shard file in memory: its index and the ids of its documents."""

    def __init__(self, content: bytes) -> None:
        data = memoryview(content)
        # the last row's separator stands after the magic; two or four bytes
        tail = next((t for t in (2, 4) if bytes(data[-t - 8 : -t]) == MAGIC), None)
        if tail is None:
            raise ValueError("not a token shard")
        (size,) = struct.unpack_from("<Q", data, len(data) - tail - 16)
        self.footer = data[len(data) - tail - 16 - size : len(data) - tail - 16]
        self.index = Index(self.footer)
        self.payload = np.frombuffer(data, f"<u{self.index.width}", int(self.index.starts[-1]))

    def ids(self, row: int) -> np.ndarray:
        return self.payload[int(self.index.starts[row]) : int(self.index.starts[row + 1])]


def write_token_files(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    vocabulary_path: str | None = None,
    end_id: int = END_ID,
    shards: int | None = None,
) -> None:
    """Encode every whole text and write the shards to the folder ``path``.

    One range-partitioned shuffle of the texts; a task holds the keys and
    lengths of its own shard, never its payload. ``shards`` defaults to the
    session's number of shuffle partitions.
    """
    spark = docs.sparkSession
    ship_package(spark)
    vocabulary_path = vocabulary_path or vocabulary(VOCABULARY)
    dtype = encoder(vocabulary_path).dtype
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.repartitionByRange(shards, "key") if shards else rows.repartitionByRange("key")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary_path)
        keys, lengths, out, size = [], [], [], 0
        for batch in batches:
            keys.append(batch.column(0))
            for value in batch.column(1):
                ids = enc.encode(value.as_py())
                lengths.append(len(ids) // int(dtype[-1]) + 1)
                out.append(ids)
                size += len(ids)
                if size > _ROWS_OUT:
                    yield pa.record_batch({"value": pa.array(out, pa.binary())})
                    out, size = [], 0
        if lengths:
            column = pa.chunked_array(keys)
            nulls = column.null_count
            plain = column.slice(nulls).to_numpy().astype(np.int64)
            out.append(_footer(plain, nulls, np.array(lengths, np.int64), int(dtype[-1])))
            yield pa.record_batch({"value": pa.array(out, pa.binary())})

    # rows of one key stand in the order of their texts, so reruns write the same
    payload = rows.sortWithinPartitions("key", "text").mapInArrow(encode, "value binary")
    separator = np.array([end_id], dtype).tobytes().decode("latin-1")
    payload.select(F.col("value").cast("string")).write.option("encoding", "ISO-8859-1").option("lineSep", separator).text(path)


def _shards(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(paths).select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), "content")


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Shard]]:
    for batch in batches:
        for file, content in zip(batch.column(0), batch.column(1)):
            content = content.as_buffer()
            if content.size:
                yield file.as_py(), Shard(content)


def read_token_files(spark: SparkSession, path: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents of a folder of shards that have one of the ``keys``, and
    those written without a key: key, shard, start (ids before it in the whole
    corpus), n_tokens, ids_crc32 (of its ids as little-endian unsigned 32-bit
    integers).

    Every shard is read once, where Spark puts it; what is passed on is its
    footer and the checksum of every row. The keys go to the shard that may
    hold them and are found by its perfect hash. One row per shard (its name
    and range of keys) reaches the driver.
    """
    ship_package(spark)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, shard in _contents(batches):
            index = shard.index
            crc = [zlib.crc32(shard.ids(r).astype("<u4").tobytes()) for r in range(index.rows)]
            row = (file, index.first, index.last, int(index.starts[-1]), bytes(shard.footer), np.array(crc, "<u4").tobytes())
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            names = ["file", "first", "last", "ids", "footer", "crc"]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    footers = _shards(spark, path).mapInArrow(scan, "file string, first long, last long, ids long, footer binary, crc binary")
    footers = stage(footers, "token-footers")
    known = footers.select("file", "first", "last", "ids").collect()
    known.sort(key=lambda r: int(r["file"].split("-")[1]))  # part-<number>-...
    numbers = spark.createDataFrame(
        [(r["file"], i, int(n)) for i, (r, n) in enumerate(zip(known, np.cumsum([0, *(r["ids"] for r in known)])))],
        "file string, shard int, before long",
    )
    with_keys = [(i, r["first"], r["last"]) for i, r in enumerate(known) if r["first"] <= r["last"]]
    shard_of, first, last = (np.array(x, np.int64) for x in zip(*with_keys)) if with_keys else [np.zeros(0, np.int64)] * 3

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine = np.unique(batch.column(0).to_numpy(zero_copy_only=False))
            at = np.searchsorted(last, mine)
            fits = at < len(last)
            fits[fits] = first[at[fits]] <= mine[fits]
            yield pa.record_batch({"shard": pa.array(shard_of[at[fits]], pa.int32()), "key": pa.array(mine[fits], pa.int64())})

    asked = keys.select(F.col(key).cast("long").alias("key")).where("key is not null").mapInArrow(deal, "shard int, key long")

    def find(asked: pa.Table, footers: pa.Table) -> pa.Table:
        out: list[tuple[pa.Array, np.ndarray]] = []
        starts, crc, before, file = np.zeros(1, np.int64), np.zeros(0, np.int64), 0, None
        if footers.num_rows:
            row = footers.to_pylist()[0]
            index, crc = Index(memoryview(row["footer"])), np.frombuffer(row["crc"], "<u4").astype(np.int64)
            starts, before, file = index.starts.astype(np.int64), row["before"], row["file"]
            out.append((pa.nulls(index.nulls, pa.int64()), np.arange(index.nulls)))
            mine = np.unique(asked["key"].to_numpy())
            at, copies = index.find(mine)
            out.append((pa.array(np.repeat(mine, copies)), np.repeat(at, copies) + _within(copies)))
        rows = np.concatenate([np.zeros(0, np.int64), *[r for _, r in out]]).astype(np.int64)
        return pa.table(
            {
                "key": pa.concat_arrays([pa.array([], pa.int64()), *[k for k, _ in out]]),
                "shard": pa.array([file] * len(rows), pa.string()),
                "start": before + starts[rows],
                "n_tokens": starts[rows + 1] - starts[rows] if len(rows) else np.zeros(0, np.int64),
                "ids_crc32": crc[rows],
            }
        )

    held = footers.join(numbers, "file").select("shard", "file", "before", "footer", "crc")
    return (
        asked.groupBy("shard").cogroup(held.groupBy("shard"))
        .applyInArrow(lambda a, b: find(a, b), "key long, shard string, start long, n_tokens long, ids_crc32 long")
    )


def _within(counts: np.ndarray) -> np.ndarray:
    """0..n-1 for each n of counts."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, first, last, rows) of every shard that has keys. Written beside
    the shards when it is first asked for."""
    ship_package(spark)
    folder = f"{path}/_manifest"
    if "_SUCCESS" not in files.names(spark, folder):

        def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for file, shard in _contents(batches):
                i = shard.index
                if i.first <= i.last:
                    yield pa.record_batch({"file": [file], "first": [i.first], "last": [i.last], "rows": [i.rows]})

        found = _shards(spark, path).mapInArrow(heads, "file string, first long, last long, rows long")
        found.write.mode("overwrite").parquet(folder)
    return spark.read.schema("file string, first long, last long, rows long").parquet(folder)


def get(spark: SparkSession, path: str, key: int) -> list[np.ndarray]:
    """The ids of every row of one key, empty if it isn't there. Reads some
    bytes of one shard, as many for a large shard as for a small one."""
    wanted = np.array([key], np.int64)
    out = []
    for shard in manifest(spark, path).where(F.lit(key).between(F.col("first"), F.col("last"))).select("file").collect():
        with files.Opened(spark, f"{path}/{shard['file']}") as file:
            end = file.size
            tail = file.read(end - 20, 20)
            gap = next(t for t in (2, 4) if tail[20 - t - 8 : 20 - t] == MAGIC)
            (size,) = struct.unpack("<Q", file.read(end - gap - 16, 8))
            base = end - gap - 16 - size
            rows, _, distinct, width, _, _ = _HEAD.unpack(file.read(base, _HEAD.size))
            entries = base + _HEAD.size
            starts = entries + _ENTRY.itemsize * distinct
            table = starts + 8 * (rows + 1)
            slot = PerfectHash.probe(wanted, lambda at, n: file.read(table + at, n))  # noqa: B023
            if slot < 0:
                continue
            entry = np.frombuffer(file.read(entries + _ENTRY.itemsize * slot, _ENTRY.itemsize), _ENTRY)[0]
            if entry["print"] != PerfectHash.fingerprints(wanted)[0]:
                continue
            copies = int(entry["copies"])
            at = np.frombuffer(file.read(starts + 8 * int(entry["row"]), 8 * (copies + 1)), "<u8").astype(np.int64)
            out += [np.frombuffer(file.read(int(a) * width, int(b - a) * width), f"<u{width}") for a, b in zip(at, at[1:])]
    return out


def lookup(spark: SparkSession, path: str, keys: list[int]) -> DataFrame:
    """Keyed access for a stated list of keys (at most ``MAX_LOOKUP``): one row
    (key, copy, ids) per document found. Only shards whose range of keys holds
    one of them are read."""
    if len(keys) > MAX_LOOKUP:
        raise ValueError(f"at most {MAX_LOOKUP} keys at once")
    ship_package(spark)
    wants = np.unique(np.array(keys, np.int64))
    shards = [
        r["file"] for r in manifest(spark, path).collect()  # one row per shard
        if np.searchsorted(wants, r["first"]) < np.searchsorted(wants, r["last"], "right")
    ]
    if not shards:
        return spark.createDataFrame([], "key long, copy int, ids array<long>")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, shard in _contents(batches):
            first, copies = shard.index.find(wants)
            found = [(int(k), c, shard.ids(r + c).tolist()) for k, r, n in zip(wants, first, copies) for c in range(n)]
            if found:
                k, c, ids = zip(*found)
                types = [pa.int64(), pa.int32(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip((k, c, ids), types)], names=["key", "copy", "ids"]
                )

    return _shards(spark, [f"{path}/{f}" for f in shards]).mapInArrow(probe, "key long, copy int, ids array<long>")
