"""Embedding near-dedup with an inverted multi-index.

Each half of the vectors has a codebook of its own; a cell of the index is a pair of
codes, and every vector lies in one.  A query walks the cells by multi-sequence
traversal: codes of each half in ascending order of a lower bound of the distance to
anything with that code, pairs of codes in ascending order of the sum.  It ends where
the target recall is reached: at the bound within which that share of the linked pairs
of the sample lies, and of vectors turned away from sampled ones by the widest angle
that still links.  What lies in the visited cells is verified exactly in double
precision, and each pair is looked for from one side, that of the smaller hash.

Vectors equal in every component are folded first.  Cells that share the first code lie
in blocks of bounded size; a query travels once to each block that holds a cell it
visits, as its components' own bytes, and there finds its cells by the codebooks anew.
A cell with more vectors than a block is dealt to several.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from . import common
from .graph import components
from .repeats import counted

#: Vectors that the codebooks are fitted on (those with the least hashes), and rounds.
SAMPLE, ROUNDS, PROBES = 8192, 10, 1024
#: Codes of a half: about the square root of the vectors over CELL_SIZE, within bounds.
CELL_SIZE, LEAST_CODES, MOST_CODES = 16, 4, 1024
#: Vectors of a block of cells (in double precision that many rows are held by a task).
BLOCK = 16_384
#: Queries that meet a block at a time.
STEP = 1024


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1 in double precision, whatever their scale."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def codebook(x: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """k-means centres of the rows of ``x``."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):
        near = ((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)).argmin(1)
        for c in range(len(centres)):
            own = x[near == c]
            if len(own):
                centres[c] = own.mean(0)
    return centres


def bounds(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of each row, and lower bounds of its squared distance to anything with each code.

    What has code c is nearer to c than to the row's own code, so it lies behind the
    plane between the two.
    """
    d = np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0)
    own = d.argmin(1)
    gap = np.sqrt(np.maximum(((centres[own][:, None] - centres[None]) ** 2).sum(2), 1e-300))
    plane = np.maximum(d - d[np.arange(len(x)), own][:, None], 0) / (2 * gap)
    plane[np.arange(len(x)), own] = 0
    return own, plane**2


def traverse(a: np.ndarray, b: np.ndarray, limit: float) -> list[tuple[int, int]]:
    """Pairs of codes in ascending order of a[i] + b[j], as long as that is at most ``limit``."""
    ia, ib = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    ia, ib = ia[a[ia] <= limit].tolist(), ib[b[ib] <= limit].tolist()
    out, heap, seen = [], [(0.0, 0, 0)] if ia and ib else [], {(0, 0)}
    if heap:
        heap = [(a[ia[0]] + b[ib[0]], 0, 0)]
    while heap:
        s, i, j = heapq.heappop(heap)
        if s > limit:
            break
        out.append((ia[i], ib[j]))
        for p in ((i + 1, j), (i, j + 1)):
            if p[0] < len(ia) and p[1] < len(ib) and p not in seen:
                seen.add(p)
                heapq.heappush(heap, (a[ia[p[0]]] + b[ib[p[1]]], *p))
    return out


def limit_for(x: np.ndarray, books: tuple[np.ndarray, np.ndarray], half: int, threshold: float, recall: float, seed: int = 1) -> float:
    """The bound up to which a walk must go for the target recall, from sampled unit vectors."""
    rng = np.random.default_rng(seed)
    some = x[rng.permutation(len(x))[:PROBES]]
    turn = rng.standard_normal(some.shape)
    turn -= (turn * some).sum(1, keepdims=True) * some
    turn /= np.maximum(np.sqrt((turn * turn).sum(1, keepdims=True)), 1e-12)
    sides = [(some, some * threshold + turn * np.sqrt(max(0.0, 1 - threshold**2)))]
    linked = []
    for lo in range(0, len(x), 512):
        i, j = np.nonzero(x[lo : lo + 512] @ x.T >= threshold)
        keep = i + lo != j
        linked.append(np.stack([i[keep] + lo, j[keep]], 1))
    pairs = np.concatenate(linked) if linked else np.zeros((0, 2), np.int64)
    if len(pairs):
        pairs = pairs[rng.permutation(len(pairs))[: 8 * PROBES]]
        sides.append((x[pairs[:, 0]], x[pairs[:, 1]]))
    most = 0.0
    for a, b in sides:
        need = []
        for lo in range(0, len(a), 256):
            total = np.zeros(len(a[lo : lo + 256]))
            for book, cut in ((books[0], slice(0, half)), (books[1], slice(half, None))):
                own, _ = bounds(b[lo : lo + 256, cut], book)
                total += bounds(a[lo : lo + 256, cut], book)[1][np.arange(len(total)), own]
            need.append(total)
        most = max(most, float(np.quantile(np.concatenate(need), recall)))
    return min(most, 2 - 2 * threshold) + 1e-9


def _rows(col: pa.Array, kind: str, dim: int) -> np.ndarray:
    """Unit vectors of a column of packed components."""
    return unit(np.frombuffer(b"".join(col.to_pylist()), kind).reshape(len(col), dim))


def near_duplicates(table: DataFrame, threshold: float = 0.95, recall: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of (vec_id, embedding).

    Rows link when their cosine is at least ``threshold``.  Null, empty or zero vectors
    and those with null or non-finite components link with nothing; nor do vectors of
    different lengths, each of which has an index of its own.  Repeated rows are vectors
    of their own.  component_id is the least vec_id reachable (null vec_ids aside, and
    null for a null vec_id without links); an empty table gives no rows; other columns,
    labels too, are ignored, whatever their names.
    """
    e = F.transform("embedding", lambda v: v.cast("double"))
    single = isinstance(t := table.schema["embedding"].dataType, ArrayType) and isinstance(t.elementType, FloatType)
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("e"), F.col("embedding") if single else e.alias("embedding"))
    finite = F.forall("e", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    valid = F.coalesce(finite & F.exists("e", lambda v: v != 0), F.lit(False))
    rows = rows.withColumn("v", F.when(valid, F.xxhash64("e"))).drop("e")
    folded = rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.any_value("embedding").alias("embedding"))
    folded = common.checkpoint(folded.withColumn("dim", F.size("embedding")))
    dims = [r["dim"] for r in folded.select("dim").distinct().collect()]  # one number for each length of vectors
    out = [_links(folded.where(F.col("dim") == d).drop("dim"), d, "<f4" if single else "<f8", threshold, recall) for d in dims]
    if not out:
        none = F.lit(None).cast("long")
        linked = folded.select("v", none.alias("others"), F.col("v").alias("root")).limit(0)
    else:
        linked = out[0]
        for o in out[1:]:
            linked = linked.unionAll(o)
    own = folded.select("v", "least", "n").join(linked.hint("merge"), "v", "left").select("v", "least", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("root", "v").alias("root"))
    own = common.checkpoint(own)
    of_root = counted(own, "root", F.min("least").alias("component_id"))
    per = own.join(of_root.hint("merge"), "root").select("v", "n_links", "component_id")
    done = rows.select("vec_id", "v").join(common.checkpoint(per).hint("merge"), "v", "left")
    done = done.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("v").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return done.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def layout(counts: np.ndarray, second: int, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of each cell (row-major over ``second`` codes); empty cells have none.

    Neighbouring cells of one first code share a block as long as they fit.
    """
    at, parts = np.zeros(len(counts), np.int64), -(-counts // block)
    now, filled, row = -1, block + 1, -1
    for c in np.flatnonzero(counts).tolist():
        if c // second != row or filled + counts[c] > block:
            row, now, filled = c // second, now + 1, 0
        at[c] = now
        filled += int(counts[c])
        now += int(parts[c]) - 1
    return at, parts


class Block:
    """Vectors of one block by their second code, and what is known of their links."""

    def __init__(self, names: np.ndarray, sizes: np.ndarray, x: np.ndarray, second: np.ndarray):
        order = np.argsort(second, kind="stable")
        self.names, self.sizes, self.x = names[order], sizes[order], x[order]
        self.codes, self.first = np.unique(second[order], return_index=True)
        self.first = np.append(self.first, len(order))
        self.others = np.zeros(len(order), np.int64)
        self.label = np.arange(len(order))  # least place reached so far

    def probe(self, names: np.ndarray, sizes: np.ndarray, x: np.ndarray, visits: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Links of queries with greater names here: query, a name of its component, rows linked."""
        q, m = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k, code in enumerate(self.codes.tolist()):
            rows = np.flatnonzero(visits[:, code])
            if len(rows):
                a, b = self.first[k], self.first[k + 1]
                near = (x[rows] @ self.x[a:b].T >= threshold) & (names[rows, None] < self.names[None, a:b])
                i, j = np.nonzero(near)
                q.append(rows[i])
                m.append(j + a)
        q, m = np.concatenate(q), np.concatenate(m)
        np.add.at(self.others, m, sizes[q])
        order = np.argsort(q, kind="stable")
        q, m = q[order], m[order]
        which, first = np.unique(q, return_index=True)
        total = np.add.reduceat(self.sizes[m], first) if len(q) else np.zeros(0, np.int64)
        low = np.zeros(len(which), np.int64)
        for i, hit in enumerate(np.split(m, first[1:]) if len(q) else []):
            labels = np.unique(self.label[hit])
            low[i] = labels[0]
            if len(labels) > 1:
                self.label[np.isin(self.label, labels[1:])] = labels[0]
        return names[which], self.names[low], total

    def own(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        some = np.flatnonzero(self.others)
        return self.names[some], self.names[self.label[some]], self.others[some]


def _links(folded: DataFrame, dim: int, kind: str, threshold: float, recall: float) -> DataFrame:
    """v, others (rows linked, without its own copies) and root of the folded vectors of one length."""
    spark = folded.sparkSession
    total = folded.count()
    sample = folded.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).select("embedding").toPandas()
    x = unit(np.array(sample["embedding"].tolist(), np.float64).reshape(len(sample), dim))
    k = int(np.clip(np.sqrt(total / CELL_SIZE), LEAST_CODES, MOST_CODES))
    half = dim // 2 if dim > 1 else 1
    pair = (codebook(x[:, :half], k), codebook(x[:, half:], k) if dim > half else np.zeros((1, 0)))
    books = spark.sparkContext.broadcast(pair)  # at most MOST_CODES centres of each half
    limit = limit_for(x, pair, half, threshold, recall)
    wide = len(pair[1])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Rows with their vectors, codes and bounds."""
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                flat = part.column(2).flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
                x = unit(flat.reshape(part.num_rows, dim))
                own1, far1 = bounds(x[:, :half], books.value[0])
                own2, far2 = bounds(x[:, half:], books.value[1])
                yield part, flat, own1 * wide + own2, far1, far2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)
        for _, _, cell, _, _ in parts(batches):
            seen = np.concatenate([seen, cell])
        cell, n = np.unique(seen, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n)], ["cell", "n"])

    vectors = folded.select("v", "n", "embedding")
    counts = np.zeros(len(pair[0]) * wide, np.int64)
    for r in vectors.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toLocalIterator():  # at most MOST_CODES squared
        counts[r["cell"]] = r["n"]
    blocks = spark.sparkContext.broadcast(layout(counts, wide))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The vector in its block (kind 0) and as a query in each block that it visits (kind 1)."""
        at, deal = blocks.value
        for part, flat, cell, far1, far2 in parts(batches):
            names = part.column(0).to_numpy()
            spread = (names.view(np.uint64) >> np.uint64(20)).astype(np.int64) % deal[cell]
            row, block = list(range(len(names))), (at[cell] + spread).tolist()
            for i in range(len(names)):
                seen: set[int] = set()
                for p, q in traverse(far1[i], far2[i], limit):
                    c = p * wide + q
                    if deal[c]:
                        seen.update(((p, b) for b in range(at[c], at[c] + deal[c])))
                row += [i] * len(seen)
                block += [b for _, b in seen]
            take = pa.array(row)
            width = dim * flat.itemsize
            raw = flat.reshape(-1, dim)[row].tobytes()
            packed = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(np.arange(0, (len(row) + 1) * width, width, dtype=np.int32)), pa.py_buffer(raw)])
            kinds = np.zeros(len(row), np.int32)
            kinds[len(names) :] = 1
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array(kinds), part.column(0).take(take), part.column(1).take(take), packed], ["block", "kind", "v", "n", "x"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per block: rows linked to each vector, and edges that join all that is linked."""
        now, block, members, first = None, None, [], 0

        def out(a: np.ndarray, b: np.ndarray, others: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(others)], ["a", "b", "others"])

        for b in batches:
            ids, kinds = b.column(0).to_numpy(), b.column(1).to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (kinds[1:] != kinds[:-1]), [True]]))
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if ids[i] != now:
                    if block is not None:
                        yield out(*block.own())
                    now, block, members = ids[i], None, []
                for lo in range(i, j, STEP):
                    part = b.slice(lo, min(j - lo, STEP))
                    names, sizes = part.column(2).to_numpy(), part.column(3).to_numpy()
                    x = _rows(part.column(4), kind, dim)
                    if kinds[i] == 0:
                        members.append((names.copy(), sizes.copy(), x))
                        continue
                    if not members and block is None:
                        continue
                    if block is None:
                        n, s, m = (np.concatenate(c) for c in zip(*members))
                        block, members = Block(n, s, m, bounds(m[:, half:], books.value[1])[0]), []
                        first = int(bounds(m[:1, :half], books.value[0])[0][0])  # all cells of a block share it
                    far1, far2 = bounds(x[:, :half], books.value[0])[1], bounds(x[:, half:], books.value[1])[1]
                    yield out(*block.probe(names, sizes, x, far1[:, first][:, None] + far2 <= limit, threshold))
        if block is not None:
            yield out(*block.own())

    indexed = vectors.mapInArrow(index, "block long, kind int, v long, n long, x binary")
    checked = indexed.repartition("block").sortWithinPartitions("block", "kind")
    found = common.checkpoint(checked.mapInArrow(verify, "a long, b long, others long"))
    nodes = components(found.select("a", "b"))
    others = found.groupBy("a").agg(F.sum("others").alias("others"))
    return others.join(nodes.select(F.col("node").alias("a"), "root").hint("merge"), "a", "left").select(F.col("a").alias("v"), "others", F.coalesce("root", "a").alias("root"))
