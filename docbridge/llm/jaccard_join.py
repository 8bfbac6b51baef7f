"""N-gram Jaccard join over a prefix tree.

A text is the set of its distinct word shingles.  All sets are put in one global
order, rare shingles first, so that two sets with Jaccard likeness of at least t
must share one of the first n - ceil(t*n) + 1 shingles of each (its prefix).

1. Copies of a set are left to its row of least doc_id, of which a sketch tells each task
   without any text being moved (a few other rows may pass; they go by their set later).
   A merged sketch of all their shingles tells which may occur in two texts.  Shingles that
   occur once come first in the order; a set whose prefix holds nothing else can have
   no partner and is done without any shuffle.  Most texts end here.
2. The candidate sets that are left, one for each distinct set, post the repeated
   shingles of their prefix.  In each posting list one set is the probe for the others
   (a star, so a list of g sets gives g - 1 pairs, not g squared).
3. The partners of a probe lie in a prefix tree (``Trie``) over the global order.  The
   overlap with the probe is counted once for a start that many share, and a subtree is
   left whole as soon as what remains below it or of the probe is too short for the
   least overlap that any set there requires.
4. Linked sets fall into components.  Only lists that still hold two components go on,
   once more with another probe, then block by block: sets that share their commonest
   open shingle form blocks of bounded size, and for each two blocks that meet in a list the
   sets of the one probe the tree of the other.  A pair inside one component is not
   tried, as it cannot change the components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from . import common, sketch
from .graph import components
from .hashing import Runs, lower_ascii, mix, word_hashes, word_spans
from .repeats import counted

#: Least and most cells of the frequency sketch that only orders shingles (broadcast: 16 MB at most), and shingles of a cell between them.
FREQUENCY_BITS, MOST_FREQUENCY_BITS, CELL = 20, 24, 16
#: Rounds with one probe for each list, and sets of a block after them.
ROUNDS, BLOCK = 2, 256
#: Partners of a probe that one tree holds, and that meet in one task.
TREE, PARTNERS = 2048, 256
#: Shingles (8 bytes each) that pairs of blocks may deal out at once, if all sets together have fewer than half of that.
LOT = 1 << 25


def sets_of(raw: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, concatenated, and their offsets."""
    raw = lower_ascii(raw)
    starts, ends, first = word_spans(raw, offsets)
    words = np.diff(first)
    runs = Runs(word_hashes(raw, starts, ends), n)
    count = np.where(words > 0, np.maximum(words - n + 1, 1), 0)
    seg, place = common.within(count)
    at = first[seg] + place
    h = np.zeros(len(at), np.uint64)
    for width in range(1, n + 1):  # fewer than n words are one shingle
        some = np.flatnonzero(words[seg] == width) if width < n else np.flatnonzero(words[seg] >= n)
        h[some] = mix(runs.at(at[some], width) ^ np.uint64(width))
    out, sizes = [], np.zeros(len(words), np.int64)
    edge = np.concatenate([[0], np.cumsum(count)])
    for i in range(len(words)):
        own = np.unique(h[edge[i] : edge[i + 1]])
        out.append(own)
        sizes[i] = len(own)
    return (np.concatenate(out) if out else h), np.concatenate([[0], np.cumsum(sizes)])


def set_id(hashes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def shingle_sets(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, set: equal sets have equal ``set``; null for empty ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offs in common.text_steps(batches):
            h, edge = sets_of(raw, offs, n)
            size = np.diff(edge)
            ids = [set_id(h[a:b]) if b > a else None for a, b in zip(edge[:-1], edge[1:])]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(size), pa.array(ids, pa.int64())], ["doc_id", "n_shingles", "set"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "doc_id long, n_shingles long, set long")


def _prefix(size: np.ndarray, percent: int) -> np.ndarray:
    return size - -(-percent * size // 100) + 1


def _sets(rows: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    values = np.concatenate([x[2] for x in rows]).view(np.int64)
    offsets = np.concatenate([[0], np.cumsum([len(x[2]) for x in rows])]).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], ["set", "size", "shingles"])


def _least(rows: DataFrame) -> DataFrame:
    return common.checkpoint(rows.where("set is not null").groupBy("set").agg(F.min("doc_id").alias("least")))


def _row_keys(sets: pa.Array, doc_ids: pa.Array) -> np.ndarray:
    """One hash of each row's set and doc_id (null counts as 0)."""
    ids = pa.compute.fill_null(doc_ids, 0).to_numpy().view(np.uint64)
    return mix(sets.to_numpy().view(np.uint64) ^ mix(ids + np.uint64(1)))


def leaders(least: DataFrame) -> Broadcast:
    """Sketch of the rows (set, least doc_id) that stand for their set: it knows all of them, and a few other rows."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for b in batches:
            yield np.repeat(_row_keys(b.column(0), b.column(1)), 2)  # what occurs twice passes

    return sketch.build(least.select("set", "least"), keys, least.count())


def candidates(docs: DataFrame, n: int, percent: int, least: DataFrame | None = None) -> DataFrame:
    """set, size, shingles (those that may repeat, by hash) of each distinct set that may have a partner.

    ``least`` has each set with its least doc_id (made here if not given).  Copies of a set, in whatever tasks,
    are left to that row: else they would fill the sketch, and all their shingles travel.
    """
    if least is None:
        least = _least(common.checkpoint(shingle_sets(docs, n)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    lead = leaders(least)

    def led(rows: pa.RecordBatch, h: np.ndarray, edge: np.ndarray, seen: set[int]) -> list[tuple[int, int]]:
        """Place and id of the sets that their row stands for, each once in a task."""
        at = np.flatnonzero(np.diff(edge))
        ids = [set_id(h[edge[i] : edge[i + 1]]) for i in at]
        if not ids:
            return []
        own = lead.value.repeated(_row_keys(pa.array(ids, pa.int64()), rows.column(0).take(pa.array(at))))
        out = []
        for i, s in zip(at[own].tolist(), (s for s, x in zip(ids, own) if x)):
            if s not in seen:
                seen.add(s)
                out.append((i, s))
        return out

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        seen: set[int] = set()
        for rows, raw, offs in common.text_steps(batches):
            h, edge = sets_of(raw, offs, n)
            keep = [h[edge[i] : edge[i + 1]] for i, _ in led(rows, h, edge, seen)]
            if keep:
                yield np.concatenate(keep)

    units = texts.select(F.sum(F.octet_length("text"))).first()[0] or 0
    once = sketch.build_pieces(texts, keys, units / 12)  # 1 to 4 cells for each shingle: many of those that occur once must be known, not all

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
        """Shingles, sizes and ids of many sets at a time if the sketch has several pieces, as all are read for each lot."""
        most = sketch.HELD if len(once.parts) > 1 else 0
        held: list[np.ndarray] = []
        names: list[int] = []
        seen: set[int] = set()
        count = 0
        for rows, raw, offs in common.text_steps(batches):
            h, edge = sets_of(raw, offs, n)
            for i, s in led(rows, h, edge, seen):
                held.append(h[edge[i] : edge[i + 1]].copy())  # not a view of all that was read
                names.append(s)
                count += len(held[-1])
            if held and count >= most:
                yield np.concatenate(held), np.array([len(x) for x in held]), names
                held, names, count = [], [], 0
        if held:
            yield np.concatenate(held), np.array([len(x) for x in held]), names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, size, names in some(batches):
            edge = np.concatenate([[0], np.cumsum(size)])
            twice = once.repeated(h)
            total = np.concatenate([[0], np.cumsum(twice)])
            unique = size - (total[edge[1:]] - total[edge[:-1]])
            out: list[tuple[int, int, np.ndarray]] = []
            held = 0
            for i in np.flatnonzero(unique < _prefix(size, percent)):
                out.append((names[i], int(size[i]), h[edge[i] : edge[i + 1]][twice[edge[i] : edge[i + 1]]]))
                held += len(out[-1][2])
                if held >= common.STEP_BYTES // 8:
                    yield _sets(out)
                    out, held = [], 0
            if out:
                yield _sets(out)

    found = texts.mapInArrow(run, "set long, size long, shingles array<long>")
    out = common.checkpoint(found.groupBy("set").agg(F.any_value("size").alias("size"), F.any_value("shingles").alias("shingles")))
    once.unpersist()  # workers need not hold them in what follows
    lead.unpersist()
    return out


def frequencies(sets: DataFrame) -> Broadcast:
    """Rough frequency class of shingles, by hash cell; it only decides the global order."""
    parts = 16
    n = sets.select(F.sum(F.size("shingles"))).first()[0] or 0
    bits = min(MOST_FREQUENCY_BITS, max(FREQUENCY_BITS, (n // CELL).bit_length()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.uint32)
        for b in batches:
            at, times = np.unique(sketch.cells(b.column(0).flatten().to_numpy().view(np.uint64), 3, bits), return_counts=True)
            total[at] += times.astype(np.uint32)
        for p, own in enumerate(np.split(total, parts)):
            at = np.flatnonzero(own)  # a task of a large table touches few of the cells
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([at.astype(np.uint32).tobytes()], pa.binary()), pa.array([own[at].tobytes()], pa.binary())], ["part", "cells", "times"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for p, at, times in zip(*(c.to_pylist() for c in b.columns)):
                own = sums.setdefault(p, np.zeros((1 << bits) // parts, np.int64))
                own[np.frombuffer(at, np.uint32)] += np.frombuffer(times, np.uint32)
        for p, t in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([np.log2(np.maximum(t, 1)).astype(np.uint8).tobytes()], pa.binary())], ["part", "total"])

    merged = sets.select("shingles").mapInArrow(count, "part long, cells binary, times binary").repartition("part").mapInArrow(add, "part long, total binary")
    out = np.zeros(1 << bits, np.uint8)
    step = (1 << bits) // parts
    for r in merged.collect():  # 2**MOST_FREQUENCY_BITS bytes at most in all
        out[r["part"] * step : (r["part"] + 1) * step] = np.frombuffer(r["total"], np.uint8)
    return sets.sparkSession.sparkContext.broadcast(out)


def _ordered(col: pa.ListArray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of each row in the global order: ranks (class, then hash), row of each, offsets."""
    h = col.flatten().to_numpy().view(np.uint64)
    own = np.repeat(np.arange(len(col)), pa.compute.list_value_length(col).to_numpy())
    # the class takes the high bits, which orders by class and then by hash
    rank = (classes[sketch.cells(h, 3, len(classes).bit_length() - 1)].astype(np.uint64) << np.uint64(57)) | (mix(h) >> np.uint64(7))
    order = np.lexsort((rank, own))
    return rank[order], h[order], np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(col)))])


def postings(sets: DataFrame, order: Broadcast, percent: int) -> DataFrame:
    """shingle, set, size: the prefix of each candidate, without shingles that occur once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                rows = b.slice(lo, 512)
                _, h, edge = _ordered(rows.column(2), order.value)
                size = rows.column(1).to_numpy()
                take = np.minimum(_prefix(size, percent) - (size - np.diff(edge)), np.diff(edge))
                seg, place = common.within(take)
                own = pa.array(seg)
                yield pa.RecordBatch.from_arrays([pa.array(h[edge[seg] + place].view(np.int64)), rows.column(0).take(own), rows.column(1).take(own)], ["shingle", "set", "size"])

    return sets.select("set", "size", "shingles").mapInArrow(run, "shingle long, set long, size long")


class Node:
    """A shared run of ranks: places ``start`` to ``end`` of sequence ``of``; what ends there, and what lies below."""

    __slots__ = ("start", "end", "of", "below", "ends", "least", "most", "root")

    def __init__(self, start: int, end: int, of: int):
        self.start, self.end, self.of = start, end, of
        self.below: list[Node] = []
        self.ends: list[int] = []
        self.least, self.most = 1 << 62, 0  # smallest set and longest sequence in the subtree
        self.root: int | None = -1  # component that all sets of the subtree share, None if there are several

    def take(self, least: int, most: int, root: int | None, fresh: bool) -> None:
        self.root = root if fresh or self.root == root else None
        self.least, self.most = min(self.least, least), max(self.most, most)


class Trie:
    """Prefix tree of the sequences (ascending ranks of a set's shingles) added in sorted order."""

    def __init__(self, percent: int):
        self.percent = percent
        self.ranks: list[np.ndarray] = []
        self.sizes: list[int] = []
        self.roots: list[int] = []
        self.top = Node(0, 0, 0)
        self.path = [self.top]
        self.visited = 0

    def _close(self) -> None:
        node = self.path.pop()
        self.path[-1].take(node.least, node.most, node.root, self.path[-1].least == 1 << 62)

    def add(self, ranks: np.ndarray, size: int, root: int) -> None:
        i = len(self.ranks)
        before = self.ranks[-1] if self.ranks else ranks[:0]
        m = min(len(before), len(ranks))
        differ = np.flatnonzero(before[:m] != ranks[:m])
        shared = int(differ[0]) if len(differ) else m
        self.ranks.append(ranks)
        self.sizes.append(size)
        self.roots.append(root)
        while len(self.path) > 1 and self.path[-1].start >= shared:
            self._close()
        last = self.path[-1]
        if last.end > shared:  # the shared start becomes a node of its own above what was there
            lower = Node(shared, last.end, last.of)
            lower.below, lower.ends, lower.least, lower.most, lower.root = last.below, last.ends, last.least, last.most, last.root
            last.end, last.below, last.ends = shared, [lower], []
        if len(ranks) > shared:
            node = Node(shared, len(ranks), i)
            last.below.append(node)
            self.path.append(node)
        node = self.path[-1]
        node.take(size, len(ranks), root, node.least == 1 << 62)
        node.ends.append(i)

    def probe(self, probe: np.ndarray, size: int, mine: int | None = None, find: Callable[[int], int] = lambda r: r) -> Iterator[int]:
        """Places of the sequences whose likeness with ``probe`` suffices, less those of the component ``mine``."""
        while len(self.path) > 1:
            self._close()
        need = lambda n: -(-self.percent * (size + n) // (100 + self.percent))  # noqa: E731  percent * union <= 100 * overlap
        stack = [(self.top, 0, 0)]
        while stack:
            node, have, passed = stack.pop()
            self.visited += 1
            if have + min(node.most - node.start, len(probe) - passed) < need(node.least):
                continue  # no set below can reach its overlap
            if mine is not None and node.root is not None and node.least < 1 << 62 and find(node.root) == find(mine):
                continue
            if node.end > node.start:
                run = self.ranks[node.of][node.start : node.end]
                at = passed + np.searchsorted(probe[passed:], run)
                at, run_in = at[at < len(probe)], run[: int(np.count_nonzero(at < len(probe)))]
                have += int(np.count_nonzero(probe[at] == run_in))
                passed += int(np.searchsorted(probe[passed:], run[-1], "right"))
            for i in node.ends:
                if have >= need(self.sizes[i]) and (mine is None or find(self.roots[i]) != find(mine)):
                    yield i
            if have + min(node.most - node.end, len(probe) - passed) >= need(node.least):
                stack += [(n, have, passed) for n in reversed(node.below)]


def verify(pairs: DataFrame, sets: DataFrame, order: Broadcast, percent: int) -> DataFrame:
    """The pairs (probe, set) whose likeness reaches ``percent``, as edges a, b."""

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe, probe_id, probe_size = np.zeros(0, np.int64), None, 0
        tree, names = Trie(percent), []

        def linked() -> pa.RecordBatch:
            found = [names[k] for k in tree.probe(probe, probe_size)] if names else []
            return pa.RecordBatch.from_arrays([pa.array([probe_id] * len(found), pa.int64()), pa.array(found, pa.int64())], ["a", "b"])

        for b in batches:
            ids, kinds, members, sizes = (b.column(i).to_pylist() for i in (0, 2, 3, 4))
            values, edge = b.column(5).flatten().to_numpy(), np.concatenate([[0], np.cumsum(pa.compute.list_value_length(b.column(5)).to_numpy())])
            for i in range(b.num_rows):
                own = values[edge[i] : edge[i + 1]]
                if kinds[i] == 0 or len(names) == TREE:
                    yield linked()
                    tree, names = Trie(percent), []
                if kinds[i] == 0:
                    probe, probe_id, probe_size = own.copy(), ids[i], sizes[i]
                else:
                    tree.add(own.copy(), sizes[i], 0)
                    names.append(members[i])
        yield linked()

    tree = _tree(sets, order)
    parts = counted(pairs, "probe", F.ceil(F.count(F.lit(1)) / PARTNERS).alias("parts"))
    salt = F.pmod(F.xxhash64("set"), F.col("parts")).cast("int")
    pairs = common.checkpoint(pairs.join(parts.hint("merge"), "probe").select("probe", "set", salt.alias("salt")))
    partners = pairs.join(tree.hint("merge"), "set").select("probe", "salt", F.lit(1).alias("kind"), "set", "size", "ranks")
    probes = pairs.select("probe", "salt").distinct().join(tree.withColumnRenamed("set", "probe").hint("merge"), "probe").select("probe", "salt", F.lit(0).alias("kind"), F.col("probe").alias("set"), "size", "ranks")
    dealt = probes.unionAll(partners).repartition("probe", "salt").sortWithinPartitions("probe", "salt", "kind", "ranks")
    return dealt.mapInArrow(traverse, "a long, b long")


def _tree(sets: DataFrame, order: Broadcast) -> DataFrame:
    """set, size, ranks: the sets with their shingles as ranks in the global order."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                rows = b.slice(lo, 512)
                rank, _, edge = _ordered(rows.column(2), order.value)
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(rank.view(np.int64)))], ["set", "size", "ranks"])

    return sets.select("set", "size", "shingles").mapInArrow(sort, "set long, size long, ranks array<long>")


def verify_blocks(pairs: DataFrame, members: DataFrame, tree: DataFrame, percent: int) -> DataFrame:
    """Links (edges a, b) between the sets of each two blocks of ``pairs`` that differ in root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tree = None, Trie(percent)
        names: list[int] = []
        up: dict[int, int] = {}

        def root(v: int) -> int:
            while up.get(v, v) != v:
                up[v] = up.get(up[v], up[v])
                v = up[v]
            return v

        for b in batches:
            one, two, kinds, own, size, top = (b.column(i).to_pylist() for i in range(6))
            edge = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(b.column(6)).to_numpy())])
            values = b.column(6).flatten().to_numpy()
            found: list[tuple[int, int]] = []
            for i in range(b.num_rows):
                if (one[i], two[i]) != now:
                    now, tree, names, up = (one[i], two[i]), Trie(percent), [], {}
                ranks = values[edge[i] : edge[i + 1]]
                if kinds[i] == 0:
                    tree.add(ranks.copy(), size[i], top[i])
                    names.append(own[i])
                    continue
                for k in tree.probe(ranks, size[i], top[i], root):
                    found.append((own[i], names[k]))
                    up[root(tree.roots[k])] = root(top[i])
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

    full = common.checkpoint(members.join(tree.select("set", "ranks").hint("merge"), "set"))

    def between(pairs: DataFrame) -> DataFrame:
        sides = []
        for kind, side in ((0, "two"), (1, "one")):
            sides.append(pairs.withColumn("block", F.col(side)).join(full.hint("merge"), "block").select("one", "two", F.lit(kind).alias("kind"), "set", "size", "root", "ranks"))
        dealt = sides[0].unionAll(sides[1]).repartition("one", "two").sortWithinPartitions("one", "two", "kind", "ranks")
        return dealt.mapInArrow(run, "a long, b long")

    # a block travels to all that it meets: lots of pairs bound what lies on disk at once, all pairs are compared
    weight = common.checkpoint(counted(full, "block", F.sum(F.size("ranks")).alias("n")))
    held = weight.agg(F.sum("n")).first()[0] or 0
    ends = pairs.select(F.col("one").alias("block")).unionAll(pairs.select(F.col("two").alias("block")))
    moved = ends.join(weight.hint("merge"), "block").agg(F.sum("n")).first()[0] or 0
    lots = -(-moved // max(LOT, 2 * held))
    if lots <= 1:
        return between(pairs)
    lot = F.pmod(F.xxhash64("one", "two"), F.lit(lots))
    out = None
    for k in range(lots):
        new = common.checkpoint(between(pairs.where(lot == k)))
        out = new if out is None else out.unionAll(new)
    return out


def links(sets: DataFrame, percent: int) -> DataFrame:
    """node, root of the components of the candidate sets (sets without a link may lack)."""
    order = frequencies(sets)
    open_ = common.checkpoint(postings(sets, order, percent))
    edges = nodes = None
    for k in range(ROUNDS + 1):
        if nodes is None:
            mine = open_.withColumn("root", F.col("set"))
        else:
            roots = nodes.select(F.col("node").alias("set"), "root")
            mine = open_.drop("root").join(roots.hint("merge"), "set", "left").withColumn("root", F.coalesce("root", "set"))
        mixed = mine.groupBy("shingle").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("shingle")
        open_ = common.checkpoint(mine.join(common.checkpoint(mixed).hint("merge"), "shingle").select("shingle", "set", "size", "root"), open_)
        if open_.isEmpty():
            break
        if k < ROUNDS:
            pick = F.min(F.struct(F.xxhash64("set", F.lit(k)).alias("h"), F.col("set").alias("probe"), F.col("size").alias("probe_size"), F.col("root").alias("probe_root")))
            probes = common.checkpoint(open_.groupBy("shingle").agg(pick.alias("p")).select("shingle", "p.probe", "p.probe_size", "p.probe_root"))
            near = F.least("size", "probe_size") * 100 >= F.greatest("size", "probe_size") * percent
            pairs = open_.join(probes.hint("merge"), "shingle").where("root <> probe_root").where(near).select("probe", "set").distinct()
            new = verify(common.checkpoint(pairs, probes), sets, order, percent)
        else:
            new = _between_blocks(open_, sets, order, percent)
        edges = common.checkpoint(new if edges is None else edges.unionAll(new))
        nodes = components(edges)
    return components(sets.select(F.col("set").alias("a"), F.col("set").alias("b")).limit(0)) if nodes is None else nodes


def _between_blocks(open_: DataFrame, sets: DataFrame, order: Broadcast, percent: int) -> DataFrame:
    # sets go by their commonest open shingle, so that alike ones fill the same few blocks
    common_ = counted(open_, "shingle", F.count(F.lit(1)).alias("sets"))
    ranked = open_.join(common.checkpoint(common_).hint("merge"), "shingle")
    keys = common.checkpoint(ranked.groupBy("set").agg(F.max(F.struct("sets", "shingle")).getField("shingle").alias("key"), F.first("size").alias("size"), F.first("root").alias("root")))
    parts = counted(keys, "key", F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    block = F.xxhash64("key", F.pmod(F.xxhash64("set"), F.col("parts")))
    members = common.checkpoint(keys.join(parts.hint("merge"), "key").select(block.alias("block"), "set", "size", "root"), keys)
    met = open_.select("shingle", "set").join(members.hint("merge"), "set").groupBy("shingle", "block").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    met = common.checkpoint(met)
    one = met.select("shingle", F.col("block").alias("one"), F.col("lo").alias("lo1"), F.col("hi").alias("hi1"))
    two = met.select("shingle", F.col("block").alias("two"), "lo", "hi")
    pairs = one.join(two.hint("merge"), "shingle").where("one <= two and least(lo, lo1) <> greatest(hi, hi1)").select("one", "two").distinct()
    return verify_blocks(common.checkpoint(pairs, met), members, _tree(sets, order), percent)


def classes(docs: DataFrame, n: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, n_shingles, set), and of each set its least doc_id and its component (set, least, root)."""
    rows = common.checkpoint(shingle_sets(docs, n))
    least = _least(rows)
    sets = candidates(docs, n, percent, least)
    nodes = links(sets, percent).select(F.col("node").alias("set"), "root")
    return rows, common.checkpoint(least.join(nodes.hint("merge"), "set", "left").select("set", "least", F.coalesce("root", "set").alias("root")))


def join(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    A-Z is lowered; words are runs without ASCII white space; a text of fewer than n
    words is one shingle; a text without words (or null) has none, links with nothing
    and is its own component.  Rows link when ``100 * overlap >= percent * union``;
    component_id is the least doc_id reachable (null doc_ids aside), so equal texts and
    repeated rows share one.  Texts are whole, however long (a text is one step).  An
    empty table gives no rows; other columns are ignored.
    """
    rows, own = classes(docs, n, percent)
    of_root = counted(own, "root", F.min("least").alias("component_id"))
    by_set = common.checkpoint(own.join(of_root.hint("merge"), "root").select("set", "component_id"), own)
    out = rows.join(by_set.hint("merge"), "set", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def representatives(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs``, with all columns, less the near-copies: of each component the least doc_id stays.

    Texts without words have no near-copies and stay.  Of several rows with the least
    doc_id one stays, also where their texts differ; so does one of a component whose
    doc_ids are all null.  Components are told apart by their root, not by doc_id.
    """
    _, own = classes(docs, n, percent)
    firsts = own.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("none"), F.col("least").alias("doc_id"), F.col("set"))).alias("p"))
    keep = common.checkpoint(firsts.select("p.doc_id", "p.set"), own)
    d, s, r = ("__doc", "__set", "__place")
    key = F.col("doc_id").cast("long")

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids: list[int | None] = []
            for _, raw, offs in common.text_steps(iter([batch])):
                h, edge = sets_of(raw, offs, n)
                ids += [set_id(h[a:b]) if b > a else None for a, b in zip(edge[:-1], edge[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.int64())], [*batch.schema.names, s])

    tagged = common.map_rows(docs, tag, StructField(s, LongType()))
    empty = tagged.where(F.col(s).isNull()).drop(s)
    wanted = keep.select(F.col("doc_id").alias(d), F.col("set").alias(s))
    full = tagged.where(F.col(s).isNotNull()).withColumn(d, key)
    kept = full.join(wanted.hint("merge"), (full[d].eqNullSafe(wanted[d])) & (full[s] == wanted[s]), "left_semi")
    # repeated rows share doc_id and set, so few meet in a window, unless the table repeats one row
    first = F.row_number().over(Window.partitionBy(d, s).orderBy(F.lit(0)))
    return kept.withColumn(r, first).where(F.col(r) == 1).drop(d, s, r).unionAll(empty)
