"""N-gram Jaccard join: links between documents whose word shingle sets agree.

Two documents link if 100 * |intersection| >= 75 * |union| of their sets of
5-word shingles. Under Jaccard distance this is a self-join of a metric space
with radius 1/4.

Pivots and cells. Unrelated documents all have distance exactly 1, so document
pivots can't divide the space as it is: every document would lie in the window
of every cell. The pivots of the first level are therefore the shingles
themselves, as sets of one, in one global order (rare ones first). A
document's cell is that of its first shingle. By the triangle inequality a
document without its first k shingles is at distance k / n from itself, so a
partner within 1/4 may lack at most n/4 of them: the document is replicated
to the cells of its first n - ceil(3n/4) + 1 shingles, its window. Every link
meets in at least one cell.

Recursion. A cell is joined by picking a document as pivot, taking everything
within its reach out of the cell, going on from those, and recursing into the
remainder, which no longer holds anything in reach of what was taken; so tight
groups take near to linear work. First with parity bitmaps (their Hamming
distance never exceeds the sets' symmetric difference, so nothing in reach is
missed), which leaves small groups of candidates; then, on the groups, with
the whole sets, exactly. Cells and groups over a size bound are split into
pairs of blocks that are joined alike.

Equal sets are one node throughout. Links between nodes are kept as spanning
edges of their groups, never as all pairs; a row's number of links is counted
where its group is joined. There a set is held as its difference from what most
of the group's sets have in common, so near copies compare by what they differ
in. Shingles and sets are known by 64-bit hashes.

The order of the pivots only steers how much meets in a cell, not the result:
the most common shingles of a sample of documents go last.

Edge cases: NULL text and texts without words have empty sets and link with
nothing; texts with fewer than five words have one shingle, the whole; rows
that repeat a key are judged row by row; a NULL key can't name a component (its
partners' keys can); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import by_key, ship_package, stage
from marquee.llm.components import components, star_edges
from marquee.llm.tokens import _Generations

SHINGLE = 5
#: similarity of at least 3/4
NUMERATOR, DENOMINATOR = 3, 4
#: common shingles: at least so many in one of SAMPLE documents, so many at most
SAMPLE, COMMON, MAX_COMMON = 16, 3, 500_000
#: documents of a cell, and shingles of a group, that one task joins at once
CELL_BLOCK, GROUP_SHINGLES = 8192, 4_000_000
#: keys that are broadcast; more are joined by shuffle
MAX_BROADCAST = 1_000_000
_POSTINGS_AT_ONCE = 1_000_000
#: texts whose sets a task holds at once
_TEXTS_AT_ONCE = 1000

_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64
)


_hashes = _Generations(xxhash.xxh3_64_intdigest, 200_000)


def shingles(text: str) -> np.ndarray:
    """The sorted set of a whole text's shingle hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    _hashes.trim()
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    if not len(h):
        return h
    if len(h) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes(), seed=len(h))], np.uint64)
    x = h[: len(h) - SHINGLE + 1] * _FACTORS[0]
    for i in range(1, SHINGLE):
        x += h[i : len(h) - SHINGLE + 1 + i] * _FACTORS[i]
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    x.sort()
    return x[np.concatenate(([True], x[1:] != x[:-1]))]


def _node(values: np.ndarray) -> int:
    """A set's hash, as a signed number."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(values.tobytes())).astype(np.int64))


def _window(values: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The first shingles of a set, one of which any partner must share."""
    n = len(values)
    need = n - -(-NUMERATOR * n // DENOMINATOR) + 1
    if len(common):
        at = np.searchsorted(common, values)
        at[at == len(common)] = 0
        is_common = common[at] == values
        if is_common.any():
            values = np.concatenate([values[~is_common], values[is_common]])
    return values[:need]


def _parity(values: np.ndarray) -> bytes:
    """Parity of the set's members in each of n to 2n classes by hash."""
    m = max(64, 1 << (len(values) - 1).bit_length())
    odd = np.bincount((values & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def _most_apart(sizes, size):
    """Largest symmetric difference at which sets of these sizes still link."""
    total = sizes + size
    # 4 i >= 3 (total - i)
    shared = -(-NUMERATOR * total // (NUMERATOR + DENOMINATOR))
    return total - 2 * shared


# --- sketches -----------------------------------------------------------------


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _TEXTS_AT_ONCE):
            yield batch.slice(at, _TEXTS_AT_ONCE)


def _sample(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _pieces(batches):
        sets = [shingles(v.as_py()) for v in batch.column(0)]
        if sets:
            yield from _dealt(buckets, values := np.concatenate(sets), values)


def _common(group: pa.Table) -> pa.Table:
    values, n = np.unique(np.frombuffer(b"".join(group["c0"].to_pylist()), "<u8"), return_counts=True)
    keep = n >= COMMON
    return pa.table({"shingle": values[keep].view(np.int64), "n": n[keep].astype(np.int64)})


def common_shingles(texts: DataFrame, buckets: int) -> np.ndarray:
    """At most ``MAX_COMMON`` shingles that many documents of a sample share."""
    some = texts.where(F.coalesce(F.xxhash64("key") % SAMPLE == 0, F.lit(False))).select("text")
    found = stage(
        some.mapInArrow(partial(_sample, buckets), "bucket long, c0 binary").groupBy("bucket").applyInArrow(_common, "shingle long, n long"),
        "common-shingles",
    )
    # one row per doubling of the count
    sizes = found.groupBy(F.floor(F.log2("n")).alias("k")).count().collect()
    least, kept = 1 << 62, 0
    for k, n in sorted(((r["k"], r["count"]) for r in sizes), reverse=True):
        kept += n
        if kept > MAX_COMMON:
            break
        least = 1 << k
    rows = found.where(F.col("n") >= least).select("shingle").collect()
    return np.sort(np.array([r["shingle"] for r in rows], np.int64).view(np.uint64))


def _sketch(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _pieces(batches):
        sets = [shingles(v.as_py()) for v in batch.column(1)]
        full = [bool(len(s)) for s in sets]
        yield pa.record_batch(
            {
                "key": batch.column(0),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "node": pa.array([_node(s) if f else None for s, f in zip(sets, full)], pa.int64()),
                "window": pa.array([_window(s, shared.value).tobytes() if f else None for s, f in zip(sets, full)], pa.binary()),
                "parity": pa.array([_parity(s) if f else None for s, f in zip(sets, full)], pa.binary()),
            }
        )


# --- cells ----------------------------------------------------------------------


def _dealt(buckets: int, shingle: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The columns, as blobs by bucket of their shingles."""
    bucket = (shingle >> np.uint64(20)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    begins = np.searchsorted(bucket[order], np.arange(buckets + 1).astype(np.uint64))
    full = np.flatnonzero(begins[1:] > begins[:-1])
    data = {"bucket": pa.array(full, pa.int64())}
    for i, c in enumerate(columns):
        c = c[order]
        data[f"c{i}"] = pa.array([c[begins[b] : begins[b + 1]].tobytes() for b in full], pa.binary())
    if len(full):
        yield pa.record_batch(data)


def _postings(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shingle, node) of every window, dealt by shingle; a task's repeated
    sets count once. Inside a bucket four bytes tell shingles apart: two that
    share them share a cell, which adds candidates and loses none."""
    _Generations.drop()
    seen, windows, nodes, held = set(), [], [], 0

    def dealt() -> Iterator[pa.RecordBatch]:
        shingle = np.concatenate(windows)
        yield from _dealt(buckets, shingle, (shingle >> np.uint64(32)).astype("<u4"), np.concatenate(nodes))

    for batch in batches:
        for node, window in zip(batch.column(0).to_pylist(), batch.column(1)):
            if node in seen:
                continue
            seen.add(node)
            window = np.frombuffer(window.as_buffer(), "<u8")
            windows.append(window)
            nodes.append(np.full(len(window), node, np.int64))
            held += len(window)
            if held > _POSTINGS_AT_ONCE:
                yield from dealt()
                windows, nodes, held = [], [], 0
    if held:
        yield from dealt()


def _cells(group: pa.Table) -> pa.Table:
    """The cells of a bucket that hold two nodes or more, equal ones once; too
    large ones as pairs of blocks."""
    _Generations.drop()
    shingle = np.frombuffer(b"".join(group["c0"].to_pylist()), "<u4")
    node = np.frombuffer(b"".join(group["c1"].to_pylist()), "<i8")
    order = np.lexsort((node, shingle))
    shingle, node = shingle[order], node[order]
    new = np.ones(len(node), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (node[1:] != node[:-1])
    shingle, node = shingle[new], node[new]
    begin = np.flatnonzero(np.concatenate(([True], shingle[1:] != shingle[:-1])))
    size = np.diff(np.concatenate((begin, [len(node)])))
    mixed = node.view(np.uint64) * _FACTORS[0]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _FACTORS[1]
    mixed ^= mixed >> np.uint64(32)
    sign = np.add.reduceat(mixed, begin) if len(begin) else mixed
    several = np.flatnonzero(size > 1)
    _, first = np.unique(sign[several], return_index=True)
    names, members = [], []
    for c in several[first]:
        nodes = node[begin[c] : begin[c] + size[c]]
        if size[c] <= CELL_BLOCK:
            names.append(int(sign[c].astype(np.int64)))
            members.append(nodes.tolist())
        else:
            blocks = np.array_split(nodes, -(-2 * size[c] // CELL_BLOCK))
            for i in range(len(blocks)):
                for j in range(i):
                    both = np.concatenate((blocks[i], blocks[j]))
                    names.append(_node(both))
                    members.append(both.tolist())
    return pa.table({"cell": pa.array(names, pa.int64()), "nodes": pa.array(members, pa.list_(pa.int64()))})


class _Parities:
    """Nodes of a cell by bitmap length, for distances to one of them."""

    def __init__(self, sizes: list[int], bitmaps: list[bytes]) -> None:
        self.sizes = np.array(sizes, np.int64)
        self.bitmaps = [np.frombuffer(b, np.uint64) for b in bitmaps]
        words = np.array([len(b) for b in self.bitmaps])
        self.stacks = {int(m): (np.flatnonzero(words == m), np.stack([self.bitmaps[i] for i in np.flatnonzero(words == m)])) for m in np.unique(words)}

    def reach(self, x: int, open_: np.ndarray) -> np.ndarray:
        """Open nodes that may link with x."""
        mine, out = self.bitmaps[x], []
        m = len(mine)
        for length in (m // 2, m, 2 * m):
            if length not in self.stacks:
                continue
            index, stack = self.stacks[length]
            use = open_[index]
            if not use.any():
                continue
            index, stack = index[use], stack[use]
            a = mine
            if length < m:
                a = mine[:length] ^ mine[length:]
            elif length > m:
                stack = stack[:, :m] ^ stack[:, m:]
            apart = np.bitwise_count(stack ^ a).sum(axis=1)
            out.append(index[apart <= _most_apart(self.sizes[index], self.sizes[x])])
        return np.concatenate(out) if out else np.zeros(0, np.int64)


def _search(n: int, reach) -> np.ndarray:
    """Labels of the components of n nodes: each node in turn is the pivot of
    what is still open."""
    labels, open_, label = np.full(n, -1), np.ones(n, bool), 0
    for start in range(n):
        if not open_[start]:
            continue
        open_[start] = False
        labels[start] = label
        queue = [start]
        while queue:
            near = reach(queue.pop(), open_)
            open_[near] = False
            labels[near] = label
            queue.extend(near.tolist())
        label += 1
    return labels


def _join_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning edges between the nodes of a cell that the bitmaps leave."""
    _Generations.drop()
    for columns in by_key(batches, "cell"):
        nodes, first = np.unique(np.array(columns["node"], np.int64), return_index=True)
        if len(nodes) > 1:
            p = _Parities([columns["n"][i] for i in first], [columns["parity"][i] for i in first])
            edges = star_edges(nodes, _search(len(nodes), p.reach))
            if edges.num_rows:
                yield edges


# --- groups ---------------------------------------------------------------------


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _pieces(batches):
        sets = [shingles(v.as_py()) for v in batch.column(0)]
        yield pa.record_batch(
            {
                "node": pa.array([_node(s) if len(s) else None for s in sets], pa.int64()),
                "members": pa.array([s.tobytes() for s in sets], pa.binary()),
            }
        )


class _Sets:
    """Whole sets of a group, for exact overlaps with one of them.

    With B, the members of more than half of the sets, and a set's difference
    from B: |x & y| = |B| - |B without x| - |B without y| + |the differences'
    intersection|."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(s) for s in sets])
        values, ids, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        usual = 2 * holders > len(sets)
        self.usual = int(usual.sum())
        places = np.flatnonzero(usual)
        place = np.cumsum(usual) - 1
        begin = np.concatenate(([0], np.cumsum(self.sizes)))
        # a last entry that is never marked, so that no difference is empty
        end = np.array([len(values)])
        self.differences, missing = [], []
        for i in range(len(sets)):
            own = ids[begin[i] : begin[i + 1]]
            is_usual = usual[own]
            lacks = np.ones(self.usual, bool)
            lacks[place[own[is_usual]]] = False
            missing.append(int(lacks.sum()))
            self.differences.append(np.concatenate((own[~is_usual], places[lacks], end)))
        self.missing = np.array(missing)
        self.mark = np.zeros(len(values) + 1, bool)
        self._hold(np.arange(len(sets)))

    def _hold(self, nodes: np.ndarray) -> None:
        self.held = nodes
        held = [self.differences[i] for i in nodes]
        self.held_ids = np.concatenate(held)
        self.held_begin = np.concatenate(([0], np.cumsum([len(d) for d in held])))[:-1]

    def linked(self, x: int) -> np.ndarray:
        """Which of the held sets link with x, itself included."""
        mine = self.differences[x][:-1]
        self.mark[mine] = True
        both = np.add.reduceat(self.mark[self.held_ids], self.held_begin, dtype=np.int64)
        self.mark[mine] = False
        shared = self.usual - self.missing[x] - self.missing[self.held] + both
        total = self.sizes[self.held] + self.sizes[x]
        return DENOMINATOR * shared >= NUMERATOR * (total - shared)

    def reach(self, x: int, open_: np.ndarray) -> np.ndarray:
        left = self.held[open_[self.held]]
        if not len(left):
            return left
        if 2 * len(left) < len(self.held):
            self._hold(left)
        return self.held[self.linked(x) & open_[self.held]]


class _Counted:
    """Reach over whole sets that counts every set's links on the way: all
    sets are compared with each one, also those that are taken already."""

    def __init__(self, sets: _Sets, rows: np.ndarray, block: np.ndarray, blocks: int) -> None:
        self.sets, self.rows, self.block = sets, rows, block
        self.links = np.zeros(len(rows), np.int64)
        # a block meets every other one; links inside it count beside the next
        distinct = set(block.tolist())
        self.inside = {b: len(distinct) == 1 or blocks <= 2 or (b + 1) % blocks in distinct for b in distinct}

    def reach(self, x: int, open_: np.ndarray) -> np.ndarray:
        linked = self.sets.linked(x)
        linked[x] = False
        counted = linked if self.inside[int(self.block[x])] else linked & (self.block != self.block[x])
        self.links[x] = self.rows[counted].sum()
        return np.flatnonzero(linked & open_)


def _join_groups(count: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact links inside each group: every linked node with the smallest of
    its component and, if wanted, its links (rows, not nodes)."""
    _Generations.drop()
    for columns in by_key(batches, "task"):
        nodes, first = np.unique(np.array(columns["node"], np.int64), return_index=True)
        if len(nodes) > 1:
            sets = _Sets([np.frombuffer(columns["members"][i], "<u8") for i in first])
            rows, block = (np.array([columns[c][i] for i in first], np.int64) for c in ("m", "block"))
            counted = _Counted(sets, rows, block, columns["blocks"][0])
            labels = _search(len(nodes), counted.reach if count else sets.reach)
            # nodes ascend, so a label's first is its smallest
            _, root, index, n = np.unique(labels, return_index=True, return_inverse=True, return_counts=True)
            several = n[index] > 1
            if several.any():
                found = {"a": nodes[several], "b": nodes[root[index]][several], "links": counted.links[several]}
                yield pa.record_batch({name: pa.array(c, pa.int64()) for name, c in found.items()})


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", count: bool = True) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id (smallest key
    reachable by links), n_links (other rows that it links with; only with
    ``count``, which compares all sets of a group), node (the hash of its set;
    NULL if it is empty) and component (the smallest node reachable)."""
    spark = docs.sparkSession
    ship_package(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    common = spark.sparkContext.broadcast(common_shingles(texts, buckets))
    sketch = stage(
        texts.mapInArrow(partial(_sketch, common), "key long, n long, node long, window binary, parity binary"), "sketches"
    )
    full = sketch.where("node is not null")

    cells = (
        full.select("node", "window").mapInArrow(partial(_postings, buckets), "bucket long, c0 binary, c1 binary")
        .groupBy("bucket").applyInArrow(_cells, "cell long, nodes array<long>")
    )
    # the same documents often meet in many cells
    cells = stage(cells.groupBy("cell").agg(F.first("nodes").alias("nodes")), "cells")
    nodes = full.groupBy("node").agg(
        F.min("key").alias("key"), F.first("n").alias("n"), F.first("parity").alias("parity"), F.count("*").alias("m")
    )
    meeting = cells.select("cell", F.explode("nodes").alias("node")).join(nodes.drop("key", "m"), "node")
    near = meeting.repartition("cell").sortWithinPartitions("cell").mapInArrow(_join_cells, "a long, b long")
    # written first: two Python steps in one task would keep twice the workers, and their memory
    groups = components(stage(near, "near"))

    grouped = stage(groups.join(nodes.drop("parity"), "node").select("node", "component", "key", "n", "m"), "groups")
    blocks = grouped.groupBy("component").agg(F.ceil(2 * F.sum("n") / GROUP_SHINGLES).alias("blocks"))
    facts = blocks.join(grouped, "component").agg(F.count("*").alias("nodes"), F.max("blocks").alias("blocks")).first()
    wanted = grouped.select(F.col("key").alias("wanted")).distinct()
    if facts["nodes"] <= MAX_BROADCAST:
        wanted = F.broadcast(wanted)
    sets = texts.join(wanted, F.col("key").eqNullSafe(F.col("wanted")), "left_semi").select("text")
    sets = sets.mapInArrow(_sets, "node long, members binary")
    # a group in one block is one task; else each node meets every block
    placed = grouped.join(blocks, "component").withColumn("block", F.expr("pmod(xxhash64(node), blocks)")).select(
        "node", "m", "block", "blocks",
        F.explode(
            F.expr(
                "if(blocks <= 2, array(component), transform(filter(sequence(0, blocks - 1), o -> o <> block),"
                " o -> xxhash64(component, least(o, block), greatest(o, block))))"
            )
        ).alias("task"),
    )
    links = stage(
        sets.join(placed, "node").repartition("task").sortWithinPartitions("task").mapInArrow(
            partial(_join_groups, count), "a long, b long, links long"
        ),
        "links",
    )
    if (facts["blocks"] or 0) > 2:
        linked = components(links.where("a <> b").select("a", "b"))
    else:  # every node is in one task, and named with its component there
        linked = links.selectExpr("a as node", "b as component")
    counts = links.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))

    named = linked.join(nodes.select("node", "key"), "node")
    smallest = named.groupBy("component").agg(F.min("key").alias("smallest"))
    linked = named.join(smallest, "component").join(counts, "node", "left")
    linked = linked.select(F.col("node").alias("linked"), "smallest", "component", "links")
    own = nodes.select(F.col("node").alias("own"), F.col("key").alias("own_key"), "m")
    n_links = F.coalesce("links", F.lit(0)) + F.coalesce(F.col("m") - 1, F.lit(0))
    rows = sketch.select("key", "n", "node")
    return (
        rows.join(own, F.col("node") == F.col("own"), "left").join(linked, F.col("node") == F.col("linked"), "left")
        .select(
            F.col("key").alias(key),
            F.col("n").alias("n_shingles"),
            F.coalesce("smallest", "own_key", "key").alias("component_id"),
            *([n_links.cast("long").alias("n_links")] if count else []),
            "node",
            F.coalesce("component", "node").alias("component"),
        )
    )


def first_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of every group of linked documents, that with the
    smallest key. Rows whose key stands on several rows are told apart by their
    sets, and those equal in both are one row; rows without a key stay unless
    they are linked to one with a key."""
    # names of its own, whatever the columns are called
    names = [f"c{i}" for i in range(len(docs.columns))]
    key_as, text_as = names[docs.columns.index(key)], names[docs.columns.index(text)]
    rows = docs.toDF(*names)
    found = stage(jaccard_components(rows, key_as, text_as, count=False).withColumnRenamed(key_as, "key"), "jaccard")
    several = found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1 or key is null")
    several = stage(several.select(F.col("key").alias("several")), "jaccard-repeated")
    gone = found.where(F.col("key") != F.col("component_id")).select(F.col("key").alias("gone")).distinct()
    gone = stage(gone, "jaccard-gone")

    def bounded(keys: DataFrame) -> DataFrame:
        return F.broadcast(keys) if keys.count() <= MAX_BROADCAST else keys

    own = F.col(key_as).cast("long")
    is_several = own.eqNullSafe(F.col("several"))
    single = rows.join(bounded(gone), own == F.col("gone"), "left_anti").join(bounded(several), is_several, "left_anti")

    repeated = rows.join(bounded(several), is_several, "left_semi")

    def with_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            sets = [shingles(v.as_py() or "") for v in batch.column(text_as)]
            yield batch.append_column("node", pa.array([_node(s) if len(s) else None for s in sets], pa.int64()))

    repeated = repeated.mapInArrow(with_nodes, T.StructType([*repeated.schema.fields, T.StructField("node", T.LongType())]))
    # one set of each key and component
    stay = found.where(F.col("key").eqNullSafe(F.col("component_id"))).join(several, F.col("key").eqNullSafe(F.col("several")), "left_semi")
    stay = stay.groupBy(F.col("key").alias("stay_key"), "component").agg(F.min("node").alias("stay_node")).drop("component")
    kept = repeated.join(stay, own.eqNullSafe(F.col("stay_key")) & F.col("node").eqNullSafe(F.col("stay_node")), "left_semi")
    first = kept.groupBy(own.alias("k"), "node").agg(F.min(F.struct(text_as, *[n for n in names if n != text_as])).alias("m"))
    out = single.unionByName(first.select(*[F.col(f"m.{n}").alias(n) for n in names]))
    return out.toDF(*docs.columns)


ORACLE_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), places AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM places
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * i >= 75 * (a.n + b.n - i)
), reached AS (
  SELECT x, y FROM links
  UNION
  SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles,
  least(d.doc_id, coalesce((SELECT min(y) FROM reached r WHERE r.x = d.doc_id), d.doc_id)) AS component_id,
  (SELECT count(*) FROM links l WHERE l.x = d.doc_id) AS n_links
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id
"""
