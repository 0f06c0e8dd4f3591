"""MinHash near-dedup with tensored banding, exact verification and union-find.

A document's set holds its distinct shingles of two words.  ``SKETCHES`` small collections of
``ROWS`` minhashes are made of it, and each pair of collections is a table's key: 13 * 2 = 26 minhashes serve
78 tables of 4 rows, where tables on their own would take 312.  Documents share a table if two of their
13 collections are equal; at a similarity of 0.8, each is with probability 0.8**2, so two are with probability 0.99996.

Documents with equal sets are one node.  Table keys with their nodes are put in order over all
tasks, so a key with very many nodes is spread over several.  A short run of one key gives the pairs whose
signatures agree in 12 of 26 rows (a pair of similarity 0.8 fails that with probability 0.00001).
A longer run, or one at the end of a task, is not expanded: each node is compared with the run's first,
the first ones of a key's parts with each other, and components that still meet in a run after that are compared tile by tile.
Which ones meet follows from the pairs with first nodes; runs with the same first node count as one.
Every pair is confirmed on the full sets before it is a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .textbatch import U64, Texts, bounds_of, mix, pieces, range_hash
from .workspace import Workspace

SHINGLE = 2
#: Sets link if 100 * intersection >= 80 * union.
PERCENT = 80
SKETCHES, ROWS = 13, 2
HASHES, TABLES = SKETCHES * ROWS, SKETCHES * (SKETCHES - 1) // 2
#: Rows of the signatures that have to agree for an exact comparison.
AGREE = 12
#: A run of more nodes is not expanded into pairs.
GROUP = 32
#: Pairs, and bytes of texts, that a task compares at a time; nodes and bytes of a tile.
PAIRS, PAIR_BYTES = 10_000, 4 << 20
TILE, TILE_BYTES = 1024, 8 << 20
#: Bytes of text of which minhashes are worked out at a time, so that the work arrays stay in the cache; entries of tables held at a time.
SIGNED_BYTES, HELD = 512 << 10, 1 << 18

_rng = np.random.default_rng(5)
_MULTIPLY = _rng.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)
_STEP = U64(0x9E3779B97F4A7C15)
SIGNED = "doc_id bigint, text_key bigint, n_shingles bigint, set_id binary, rows binary"
ENTRY = "key bigint, node bigint, s1 bigint, s2 bigint"
LABELLED = "key bigint, label bigint, n bigint"
FOUND = "key bigint, a bigint, b bigint, lead boolean, near boolean"


def shingles(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """128 bits (two columns) of each distinct shingle of each text, in order within a text, and the offsets by text.

    Words are parted by white space, so a sequence of words and its shingle joined by spaces name each other.
    """
    low = texts.lower()
    starts, ends, woff = low.words()
    words = np.diff(woff)
    count = np.where(words > 0, np.maximum(words - SHINGLE + 1, 1), 0)
    off = bounds_of(count)
    first = np.repeat(woff[:-1] - off[:-1], count) + np.arange(off[-1])
    length = np.repeat(np.minimum(words, SHINGLE), count)
    out = []
    for seed in (0, 1):
        h = np.append(range_hash(low.buf, starts, ends, seed), U64(0))
        state = mix(h[first] + length.astype(U64) * _STEP)
        for k in range(1, SHINGLE):
            more = length > k
            state[more] = mix((state[more] ^ h[first[more] + k]) * _STEP)
        out.append(state)
    return (*_distinct(out[0], out[1], off),)


def _distinct(h: np.ndarray, g: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (h, g) of each stretch, in order, and the offsets of what is left."""
    order = np.empty(len(h), np.int64)
    for s, e in zip(off[:-1].tolist(), off[1:].tolist()):
        order[s:e] = s + h[s:e].argsort()
    h, g = h[order], g[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    new[off[:-1][off[:-1] < len(h)]] = True
    if (~new[1:] & (g[1:] != g[:-1])).any():  # equal in 64 bits, but not in 128
        order = np.lexsort((g, h, np.repeat(np.arange(len(off) - 1), np.diff(off))))
        h, g = h[order], g[order]
        new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
        new[off[:-1][off[:-1] < len(h)]] = True
    return h[new], g[new], bounds_of(new)[off]


def minhashes(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The least hash of each row (rows) and set (columns); sets are not empty."""
    out, base = np.empty((HASHES, len(off) - 1), np.uint32), (h >> U64(32)).astype(np.uint32)
    moved = np.empty_like(base)
    for k in range(HASHES):
        np.multiply(base, _MULTIPLY[k], out=moved)
        moved += _ADD[k]
        out[k] = np.minimum.reduceat(moved, off[:-1])
    return out


def table_keys(rows: np.ndarray) -> np.ndarray:
    """Keys of all tables (rows) of each set (columns): every two of its small collections of minhashes."""
    sketch = np.empty((SKETCHES, rows.shape[1]), U64)
    for s in range(SKETCHES):
        key = np.full(rows.shape[1], U64(s))
        for row in rows[s * ROWS : (s + 1) * ROWS]:
            key = mix(key * _STEP + row.astype(U64))
        sketch[s] = key
    one, other = np.triu_indices(SKETCHES, 1)
    return mix((sketch[one] * _STEP) ^ sketch[other])


def signature(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four bits of each row, 16 rows in 64 bits."""
    out = np.zeros((2, rows.shape[1]), U64)
    for k, row in enumerate(rows):
        out[k // 16] |= (row & np.uint32(15)).astype(U64) << U64(4 * (k % 16))
    return out[0], out[1]


def agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Rows in which signatures agree, from the differences of their two parts."""
    total = np.uint8(0)
    for part in (x, y):
        part = part | part >> U64(1)
        part |= part >> U64(2)
        total = total + np.bitwise_count(part & U64(0x1111111111111111))
    return np.uint8(HASHES) - total


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, texts in pieces(batch.column("text"), SIGNED_BYTES):
            h, g, off = shingles(texts)
            n = np.diff(off)
            some = np.flatnonzero(n)
            sets: list[bytes | None] = [None] * len(n)
            rows: list[bytes | None] = [None] * len(n)
            if len(some):
                both = np.column_stack((h, g)).astype("<u8")
                least = np.ascontiguousarray(minhashes(h, np.append(off[:-1][some], off[-1])).T)
                for k, row in zip(some.tolist(), least):
                    sets[k], rows[k] = xxhash.xxh3_128_digest(both[off[k] : off[k + 1]]), row.tobytes()
            columns = [batch.column(c).slice(a, b - a) for c in ("doc_id", "text_key")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n, pa.int64()), pa.array(sets, pa.binary()), pa.array(rows, pa.binary())], names=[c.split()[0] for c in SIGNED.split(", ")]
            )


def _labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, label, n): how many nodes with a label have a table key; a task's nodes are counted together, HELD keys and more at a time.

    ``near_sets`` does without it: what meets follows from the pairs with first nodes.
    """
    held, size = [], 0

    def counted() -> pa.RecordBatch:
        key, label = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((label, key))
        key, label = key[order], label[order]
        at = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (label[1:] != label[:-1])))
        n = np.diff(np.append(at, len(key)))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (key[at], label[at], n)], names=[c.split()[0] for c in LABELLED.split(", ")])

    for batch in batches:
        if batch.num_rows:
            rows = np.frombuffer(b"".join(batch.column("rows").to_pylist()), np.uint32).reshape(-1, HASHES).T
            held.append((table_keys(rows).ravel().view(np.int64), np.tile(batch.column("label").to_numpy(), TABLES)))
            size += len(held[-1][0])
            if size >= HELD:
                yield counted()
                held, size = [], 0
    if held:
        yield counted()


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The table keys and the signature of each node."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.frombuffer(b"".join(batch.column("rows").to_pylist()), np.uint32).reshape(-1, HASHES).T
        columns = [table_keys(rows).ravel(), *(np.tile(x, TABLES) for x in (batch.column("node").to_numpy(), *signature(rows)))]
        yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in columns], names=[c.split()[0] for c in ENTRY.split(", ")])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of entries in order of key and node: agreeing pairs (a, b) of short runs; of other runs pairs of their first node with the rest
    (``lead``; ``near`` if they agree), and (key, a) for the first node a of a part that may not be all of its run."""

    def found(key, a, b, lead, near) -> pa.RecordBatch:
        key = pa.nulls(len(a), pa.int64()) if key is None else pa.array(key.view(np.int64))
        b = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b.view(np.int64))
        columns = [key, pa.array(a.view(np.int64)), b, pa.array(np.full(len(a), lead)), pa.array(near)]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in FOUND.split(", ")])

    def short(key, node, s1, s2) -> pa.RecordBatch | None:
        """All agreeing pairs of whole runs of at most GROUP nodes."""
        cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        end = np.repeat(np.append(cuts[1:], len(key)), np.diff(np.append(cuts, len(key))))
        at, a, b = np.arange(len(key)), [], []
        for step in range(1, GROUP):
            at = at[at + step < end[at]]
            if not len(at):
                break
            x = at[agreeing(s1[at] ^ s1[at + step], s2[at] ^ s2[at + step]) >= AGREE]
            a.append(node[x])
            b.append(node[x + step])
        a, b = (np.concatenate(x) if x else np.zeros(0, U64) for x in (a, b))
        return found(None, a, b, False, np.ones(len(a), bool)) if len(a) else None

    def open_run(cols, head, part: bool) -> tuple[list[pa.RecordBatch], tuple]:
        """A run, or part of one, that is not expanded; ``head`` is its first node in this task, if that was seen before."""
        key, node, s1, s2 = cols
        new = head is None
        head = (node[0], s1[0], s2[0]) if new else head
        near, rest = agreeing(s1 ^ head[1], s2 ^ head[2]) >= AGREE, node != head[0]
        out = [found(None, np.full(int(rest.sum()), head[0]), node[rest], True, near[rest])]
        return out + ([found(key[:1], node[:1], None, True, np.zeros(1, bool))] if new and part else []), head

    def whole_runs(held, cuts, size) -> Iterator[pa.RecordBatch]:
        """All runs but the last one."""
        ended = np.arange(len(size)) < len(size) - 1
        small = np.repeat((size > 1) & (size <= GROUP) & ended, size)
        if small.any():
            out = short(*(x[small] for x in held))
            if out is not None:
                yield out
        for k in np.flatnonzero((size > GROUP) & ended).tolist():
            yield from open_run([x[cuts[k] : cuts[k] + size[k]] for x in held], None, False)[0]

    held, head, key_open, first = None, None, None, True
    for batch in batches:
        cols = [batch.column(c).to_numpy(zero_copy_only=False).view(U64) for c in ("key", "node", "s1", "s2")]
        held = cols if held is None else [np.append(x, y) for x, y in zip(held, cols)]
        while len(held[0]):
            key = held[0]
            cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            size = np.diff(np.append(cuts, len(key)))
            if first:  # may have begun in the task before
                key_open, first = key[0], False
            if key_open is not None and key[0] == key_open:
                out, head = open_run([x[: size[0]] for x in held], head, True)
                yield from out
                held = [x[size[0] :] for x in held]
                continue
            key_open = head = None
            if len(key) < HELD:
                break
            yield from whole_runs(held, cuts, size)
            held = [x[cuts[-1] :] for x in held]
            if len(held[0]) >= HELD:  # longer than what is held
                key_open = held[0][0]
    if held is not None and len(held[0]):
        key = held[0]
        cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        yield from whole_runs(held, cuts, np.diff(np.append(cuts, len(key))))
        yield from open_run([x[cuts[-1] :] for x in held], None, True)[0]  # may go on in the next task


def _sets(texts: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    """The distinct shingles of each text, in order, as numbers that stand for the same shingle in all of ``texts``."""
    h, g, n = [], [], []
    for _, _, part in pieces(texts):
        x, y, off = shingles(part)
        h.append(x)
        g.append(y)
        n.append(np.diff(off))
    h, g, off = np.concatenate(h), np.concatenate(g), bounds_of(np.concatenate(n))
    order = h.argsort()
    clash = (h[order[1:]] == h[order[:-1]]) & (g[order[1:]] != g[order[:-1]])
    if clash.any():  # equal in 64 bits, but not in 128
        order = np.lexsort((g, h))
        new = np.append(True, (h[order[1:]] != h[order[:-1]]) | (g[order[1:]] != g[order[:-1]]))
        h = np.empty(len(h), U64)
        h[order] = np.cumsum(new).astype(U64)
    return [h[s:e] for s, e in zip(off[:-1].tolist(), off[1:].tolist())]


def _alike(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether the exact Jaccard similarity of two sets, each in order, reaches the threshold."""
    x, y = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(x) < PERCENT * len(y):  # too different in size
        return False
    shared = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * shared >= PERCENT * (len(x) + len(y) - shared)


class _Forest:
    def __init__(self, root: list[int]):
        self.root = root

    def of(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def join(self, x: int, y: int) -> None:
        self.root[self.of(y)] = self.of(x)


def _links(a: list[int], b: list[int]) -> pa.Table:
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _verified(_, pairs: pa.Table, members: pa.Table) -> pa.Table:
    """The pairs of a bucket that are links, as far as they connect anything."""
    if not members.num_rows:
        return _links([], [])
    place = {x: k for k, x in enumerate(members.column("node").to_pylist())}
    sets, forest, a, b = _sets(members.column("text").combine_chunks()), _Forest(list(range(len(place)))), [], []
    for x, y in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist()):
        i, j = place[x], place[y]
        if forest.of(i) != forest.of(j) and _alike(sets[i], sets[j]):
            forest.join(i, j)
            a.append(x)
            b.append(y)
    return _links(a, b)


def _tile(group: pa.Table) -> pa.Table:
    """Links that join components within a tile: all agreeing pairs of a row outside the tile's component with another row, unless connected by then."""
    node, labels = group.column("node").to_pylist(), group.column("label").to_pylist()
    rest = group.column("rest").to_numpy(zero_copy_only=False).astype(bool)
    rows = np.frombuffer(b"".join(group.column("rows").to_pylist()), np.uint32).reshape(-1, HASHES).T
    s1, s2 = signature(rows)
    sets, at = _sets(group.column("text").combine_chunks()), {}
    forest = _Forest([at.setdefault(label, k) for k, label in enumerate(labels)])
    a, b, others = [], [], np.flatnonzero(~rest)
    for x in np.flatnonzero(rest).tolist():
        for y in others[agreeing(s1[x] ^ s1[others], s2[x] ^ s2[others]) >= AGREE].tolist():
            if forest.of(x) != forest.of(y) and _alike(sets[x], sets[y]):
                forest.join(x, y)
                a.append(node[x])
                b.append(node[y])
    return _links(a, b)


def _compared(pairs: DataFrame, texts: DataFrame, work: Workspace, name: str) -> DataFrame:
    """Links among ``pairs`` (a, b, near: pairs with the same ``near`` are compared in one task)."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    buckets = max(1, -(-pairs.count() // PAIRS), -(-2 * size // PAIR_BYTES))
    pairs = pairs.select("a", "b", F.pmod(F.xxhash64("near"), F.lit(buckets)).alias("bucket"))
    members = pairs.select(F.col("bucket").alias("at"), F.explode(F.array("a", "b")).alias("node")).distinct().join(texts.select("node", "text"), "node")
    return work.put(pairs.groupBy("bucket").cogroup(members.groupBy("at")).applyInArrow(_verified, "a bigint, b bigint"), name)


def _connected(found: DataFrame, texts: DataFrame, work: Workspace) -> DataFrame:
    """(node, component) of nodes that are linked: first by pairs and runs' first nodes, then by what that leaves apart in runs that were not expanded."""
    parts = found.where("key is not null").select("key", F.col("a").alias("node"))
    first = parts.groupBy("key").agg(F.min("node").alias("a"))
    between = parts.join(first, "key").where("node <> a").select("a", F.col("node").alias("b"))
    pairs = found.where("near").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).unionByName(between).distinct()
    pairs = work.put(pairs, "pairs")
    # A node's pairs meet where those of its least partner do, unless that one has very many.
    least = pairs.groupBy("b").agg(F.min("a").alias("near"))
    wide = least.groupBy("near").agg(F.count("*").alias("n")).where(F.col("n") > GROUP).select("near", F.lit(True).alias("wide"))
    near = pairs.join(least.join(wide, "near", "left"), "b").select("a", "b", F.when(F.col("wide"), F.col("b")).otherwise(F.col("near")).alias("near"))
    label = work.put(components(_compared(work.put(near, "near"), texts, work, "links"), work, "connected"), "labels")

    # Runs that were not expanded and still hold several components: the nodes of such runs are compared with those of the run's
    # largest component, once for all the runs that two components meet in.  Runs with one first node are taken together, and so are the parts of a run.
    led = found.where("lead and b is not null").select("a", "b").distinct()
    later = led.join(between.distinct().withColumnsRenamed({"a": "first", "b": "a"}), "a").select(F.col("first").alias("a"), "b")
    led = work.put(led.unionByName(later).unionByName(between).distinct(), "led")
    crowd = led.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    crowd = crowd.join(label, "node", "left").select("node", F.coalesce("component", "node").alias("label"))
    crowd = work.put(crowd.join(texts, "node").select("node", "label", "text", "rows"), "crowd")
    sizes = crowd.groupBy("label").agg(F.count("*").alias("size"))
    runs = led.select("a", F.col("b").alias("node")).unionByName(led.select("a", F.col("a").alias("node")).distinct())
    runs = work.put(runs.join(crowd.select("node", "label"), "node").select("a", "label").distinct().join(sizes, "label"), "runs")
    main = runs.groupBy("a").agg(F.max(F.struct("size", "label"))["label"].alias("main"))
    meet = work.put(runs.join(main, "a").where("label <> main").select("main", "label").distinct(), "meet")
    inside = crowd.join(meet.select(F.col("main").alias("label")).distinct(), "label", "left_semi").withColumns({"main": F.col("label"), "outside": F.lit(False)})
    outside = crowd.join(meet, "label").withColumn("outside", F.lit(True))
    columns = ["main", "node", "label", "text", "rows", "outside"]
    open_ = work.put(inside.select(*columns).unionByName(outside.select(*columns)), "open")
    n = lambda which: F.greatest(F.ceil(F.sum(which.cast("int")) / TILE), F.ceil(F.sum(F.when(which, F.octet_length("text"))) / TILE_BYTES)).cast("int")
    sizes = open_.groupBy("main").agg(n(F.col("outside")).alias("rests"), n(F.lit(True)).alias("tiles"))
    tiled = open_.join(sizes, "main").withColumn("place", F.xxhash64("node", "main"))
    one = tiled.withColumns({"rest": F.lit(False), "y": F.pmod("place", "tiles"), "x": F.explode(F.sequence(F.lit(0), F.col("rests") - 1))})
    two = tiled.where("outside").withColumns({"rest": F.lit(True), "x": F.pmod("place", "rests"), "y": F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))})
    columns = ["main", "x", "y", "node", "label", "text", "rows", "rest"]
    tiles = work.put(one.select(*columns).unionByName(two.select(*columns)).groupBy("main", "x", "y").applyInArrow(_tile, "a bigint, b bigint"), "tiles")

    joined = tiles
    for side in ("a", "b"):
        joined = joined.join(label.withColumnsRenamed({"node": side, "component": f"of_{side}"}), side, "left")
    joined = joined.select(*(F.coalesce(f"of_{side}", side).alias(side) for side in ("a", "b")))
    over = components(joined, work, "over").select(F.col("node").alias("component"), F.col("component").alias("root"))
    moved = label.join(over, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    return moved.unionByName(over.join(label, over["component"] == label["node"], "left_anti").select(F.col("component").alias("node"), F.col("root").alias("component")))


def near_sets(docs: DataFrame) -> DataFrame:
    """One row per document: n_shingles, component_id (the smallest doc_id reachable by links) and kept (doc_id = component_id).

    A-Z are lower-cased; words are ``[^\\x20\\x09-\\x0D]+``.  A document's set holds its distinct
    shingles of two words; one word alone is a set of one; without words, or with a null
    text, the set is empty and links with nothing.  Sets link if 100 * intersection >= 80 * union.

    Rows without doc_id take no part: their component_id is null and they are kept.  Rows that share a doc_id have a row
    each and are different documents, though a component's smallest doc_id names it.  Equal sets are
    linked.  Whole texts are used, however long; a text has to fit in memory.  Other columns are ignored; an empty table gives an empty result.
    """
    work = Workspace(docs.sparkSession, "minhash")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text"))
    signed = work.put(docs.select("doc_id", "text_key", "text").mapInArrow(_signed, SIGNED), "signed")
    some = signed.where("doc_id is not null and set_id is not null")
    nodes = some.groupBy("set_id").agg(F.min(F.struct("doc_id", "text_key")).alias("first"), F.min("rows").alias("rows"))
    nodes = work.put(nodes.select(F.monotonically_increasing_id().alias("node"), "set_id", "first.doc_id", "first.text_key", "rows"), "nodes")

    entries = nodes.select("node", "rows").mapInArrow(_entries, ENTRY).repartitionByRange("key", "node").sortWithinPartitions("key", "node")
    found = work.put(entries.mapInArrow(_runs, FOUND), "found")
    named = found.select(F.explode(F.array("a", "b")).alias("node")).where("node is not null").distinct()
    asked = nodes.join(named, "node", "left_semi").select("node", "doc_id", "text_key", "rows")
    texts = work.put(docs.join(asked, ["doc_id", "text_key"]).select("node", "text", "rows").dropDuplicates(["node"]), "texts")
    found_in = _connected(found, texts, work)

    labelled = nodes.join(found_in, "node", "left").select("set_id", "doc_id", F.coalesce("component", "node").alias("component"))
    labelled = work.put(labelled, "labelled")
    least = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = labelled.join(least, "component").select("set_id", "component_id")
    full = signed.where("doc_id is not null and set_id is not null").join(named, "set_id")
    rest = signed.where("doc_id is null or set_id is null").withColumn("component_id", F.col("doc_id"))
    out = full.select("doc_id", "n_shingles", "component_id").unionByName(rest.select("doc_id", "n_shingles", "component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


#: The same with all pairs of texts that share a shingle, for small tables.
ORACLE = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 1 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM docs),
sized AS (SELECT doc_id, s, len(s) AS n FROM sets),
posted AS (SELECT doc_id, n, unnest(s) AS x FROM sized),
linked AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM posted a JOIN posted b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sized
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a),
least_of AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, s.n AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sized s JOIN least_of l ON s.doc_id = l.doc_id
"""
