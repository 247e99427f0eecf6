"""Bounded-space online packing of token ids into fixed windows.

Every task keeps a fixed number of open windows. A document's ids are cut into
whole windows, and what is left over goes to the open window that it fills
best. If none has room, a new window is opened; if all are in use, the fullest
is emitted: its gap is filled with the head of the piece at hand if it is worth
a cut (``min_cut`` ids), else padded. At the end of its partition a task hands
its open windows on with their ids; these leftovers are merged by the same
method, ``FAN_IN`` partitions at a time, until one group is left. There the
windows still open are poured together, and the last one is cut at powers of
two, which need no padding.

Only leftovers carry ids between stages: at most ``windows * capacity`` ids per
partition, whatever the input.

Edge cases: NULL or empty text is one end id; an empty table gives no rows;
repeated rows are packed one by one; keys may be NULL; ties between windows go
to the older one; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import ship_package, stage
from marquee.llm.tokens import encoder, vocabulary

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 4096
END_ID = 2
WINDOWS = 16
MIN_CUT = 32
FAN_IN = 64
_ROWS_AT_ONCE = 1000

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
    " sequence_id long, offset long, sequence_tokens long, ids binary, task long"
)
_COLUMNS = [c.split()[0] for c in SCHEMA.split(",")]


class Packer:
    """The open windows of one task. A piece is (key, start, doc_tokens, ids);
    a window is [free, pieces]."""

    def __init__(self, task: int, capacity: int, windows: int, min_cut: int) -> None:
        self.task, self.capacity, self.windows, self.min_cut = task, capacity, windows, min_cut
        self.open: list[list] = []
        self.emitted = 0
        self.rows: list[tuple] = []

    def add(self, key, start: int, total: int, ids: np.ndarray) -> None:
        while len(ids) >= self.capacity:
            self._emit([(key, start, total, ids[: self.capacity])])
            start, ids = start + self.capacity, ids[self.capacity :]
        while len(ids):
            room = [w for w in self.open if w[0] >= len(ids)]
            if room:
                best = min(room, key=lambda w: w[0])
                best[0] -= len(ids)
                best[1].append((key, start, total, ids))
                if not best[0]:
                    self.open.remove(best)
                    self._emit(best[1])
                return
            if len(self.open) < self.windows:
                self.open.append([self.capacity - len(ids), [(key, start, total, ids)]])
                return
            fullest = min(self.open, key=lambda w: w[0])
            gap = fullest[0]
            if gap >= self.min_cut:
                fullest[1].append((key, start, total, ids[:gap]))
                start, ids = start + gap, ids[gap:]
            self.open.remove(fullest)
            self._emit(fullest[1])

    def _emit(self, pieces: list[tuple]) -> None:
        sequence = (self.task << 32) + self.emitted
        self.emitted += 1
        size = sum(len(p[3]) for p in pieces)
        offset = 0
        for key, start, total, ids in pieces:
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            self.rows.append((key, start, len(ids), crc, total, sequence, offset, size, None, self.task))
            offset += len(ids)

    def hand_on(self) -> None:
        """The open windows as leftovers: rows with ids and no sequence."""
        for _, pieces in self.open:
            for key, start, total, ids in pieces:
                self.rows.append((key, start, len(ids), None, total, None, None, None, ids.tobytes(), self.task))
        self.open = []

    def close(self) -> None:
        """Pour the open windows together; cut the last one at powers of two."""
        pieces = [p for _, window in sorted(self.open, key=lambda w: w[0]) for p in window]
        self.open = []
        left = sum(len(p[3]) for p in pieces)
        while left:
            size = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
            taken, need = [], size
            while need:
                key, start, total, ids = pieces.pop(0)
                taken.append((key, start, total, ids[:need]))
                if len(ids) > need:
                    pieces.insert(0, (key, start + need, total, ids[need:]))
                need -= len(taken[-1][3])
            self._emit(taken)
            left -= size

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows))
        self.rows = []
        types = [pa.binary() if c == "ids" else pa.int64() for c in _COLUMNS]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_COLUMNS)


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    vocabulary_path: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    windows: int = WINDOWS,
    min_cut: int = MIN_CUT,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, sequence_tokens. Texts are packed where they lie: the
    partitions of ``docs`` are not shuffled."""
    ship_package(docs.sparkSession)
    vocabulary_path = vocabulary_path or vocabulary(VOCABULARY)
    dtype = encoder(vocabulary_path).dtype
    end = np.array([end_id], dtype).tobytes()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary_path)
        packer = Packer(TaskContext.get().partitionId(), capacity, windows, min_cut)
        for batch in (b.slice(at, _ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, _ROWS_AT_ONCE)):
            for k, value in zip(batch.column(0), batch.column(1)):
                ids = np.frombuffer(enc.encode(value.as_py()) + end, dtype)
                packer.add(k.as_py(), 0, len(ids), ids)
            if packer.rows:
                yield packer.batch()
        packer.hand_on()
        if packer.rows:
            yield packer.batch()

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    done = stage(rows.mapInArrow(first, SCHEMA), "pack")
    packed = done.where("ids is null")
    left = done.where("ids is not null")
    tasks = (left.agg(F.max("task")).first()[0] or 0) + 1
    round_ = 0
    while True:
        round_ += 1
        groups = -(-tasks // fan_in)
        merged = stage(
            left.withColumn("to", F.floor(F.col("task") / fan_in))
            .groupBy("to")
            .applyInArrow(_merger(dtype, round_, groups == 1, capacity, windows, min_cut), SCHEMA),
            "pack-leftovers",
        )
        packed = packed.unionByName(merged.where("ids is null"))
        if groups == 1:
            return packed.drop("ids", "task")
        left, tasks = merged.where("ids is not null"), groups


def _merger(dtype: str, round_: int, last: bool, capacity: int, windows: int, min_cut: int):
    def merge(group: pa.Table) -> pa.Table:
        rows = sorted(
            group.select(["task", "doc_id", "start", "doc_tokens", "ids"]).to_pylist(),
            # largest first packs best; the rest makes the order independent of the shuffle
            key=lambda r: (-len(r["ids"]), r["task"], r["doc_id"] is None, r["doc_id"] or 0, r["start"], r["ids"]),
        )
        packer = Packer(group["to"][0].as_py(), capacity, windows, min_cut)
        packer.emitted = round_ << 27  # apart from the sequences of earlier rounds
        for r in rows:
            packer.add(r["doc_id"], r["start"], r["doc_tokens"], np.frombuffer(r["ids"], dtype))
        if last:
            packer.close()
        else:
            packer.hand_on()
        return pa.Table.from_batches([packer.batch()])

    return merge
