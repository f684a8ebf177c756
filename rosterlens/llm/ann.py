"""Approximate nearest neighbours with learned partitions.

Fit, on a bounded sample (at most ``SAMPLE_VECTORS`` vectors, picked by a hash of their ids; the distinct ones of moderate
size count): build the sample's neighbour graph, cut it into partitions of equal size with few edges between them (recursive
bisection along the principal direction, refined by swapping pairs of vertices), and train a small network that gives
the partitions' probabilities for a vector; a vertex's targets are its own and its neighbours' partitions. There is a
partition for some ``ROWS_PER_PARTITION`` rows, and ``2 ** LEVELS`` to ``2 ** MOST_LEVELS`` of them.

Index: every vector goes to its most probable partition, in packed blocks. Search: a query goes to its most probable
partitions, as many as reach the probability ``COVERAGE`` together; every block there is ranked by exact distance in
double precision. A query that finds fewer than ``k`` there searches all partitions. Blocks, not partitions, are the unit
of work: a partition's blocks are dealt to a task for ``BLOCKS_PER_TASK`` full ones, so a partition with any share
of the rows is split, and only its queries are copied; a task returns the ``k`` nearest of all blocks that a query meets there.

Defined results: vectors that are null, zero, of another dimension than most (the smaller of equally frequent ones) or
that hold null or non-finite components take no part, nor do null ids; finite components of any size do (a distance
beyond the doubles is infinite); a query never finds its own id; among rows that share an id the nearest counts, and as a
query the least vector; ties go to the smaller id; extra columns play no part; without vectors there are no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, sample_order

SAMPLE_VECTORS = 16384
#: Sampled vectors for each partition, but SAMPLE_LEAST at least.
SAMPLE_PER_PARTITION, SAMPLE_LEAST = 128, 4096
NEIGHBOURS = 10
ROWS_PER_PARTITION = 4096
LEVELS, MOST_LEVELS = 4, 7
#: A query goes to its most probable partitions until their probabilities reach this sum.
COVERAGE = 0.98
HIDDEN = 128
#: A sample of fewer distinct vectors is not cut: there is one partition.
LEAST_SAMPLE = 512
BLOCK = 2048
QUERY_BLOCK = 256
BLOCKS_PER_TASK = 4
#: Vectors measured exactly at a time, and neighbours that a task holds before it hands them on.
EXACT = 16384
HELD_ROWS = 2_000_000
#: So many tasks' leftovers of a partition are packed together.
TASKS_TOGETHER = 16
#: Components beyond this size are scaled before they are squared, and their vectors teach the network nothing.
MODERATE = 1e100
K = 10
QUERY_EVERY = 100


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the vectors that take part."""
    value = F.col("embedding")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = vectors.select(F.col("vec_id").cast("long"), value.cast("array<double>").alias("embedding")).where(F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False)))
    sizes = own.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return own.where(F.size("embedding") == (sizes.n if sizes else 0))


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of each row."""
    out = np.empty((len(x), k), np.int64)
    norms = (x**2).sum(axis=1)
    for i in range(0, len(x), 512):
        d = norms[i : i + 512, None] + norms - 2 * x[i : i + 512] @ x.T
        d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
        out[i : i + 512] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def bisect_graph(x: np.ndarray, graph: list[np.ndarray], rounds: int = 30) -> np.ndarray:
    """Two halves of equal size (up to one vertex) with few edges between them."""
    centred = x - x.mean(axis=0)
    direction = np.linalg.svd(centred, full_matrices=False)[2][0]
    side = np.zeros(len(x), bool)
    side[np.argsort(centred @ direction, kind="stable")[len(x) // 2 :]] = True
    rows, cols = np.repeat(np.arange(len(graph)), [len(g) for g in graph]), np.concatenate(graph)
    source, target = np.concatenate((rows, cols)), np.concatenate((cols, rows))

    def cut():
        return int((side[rows] != side[cols]).sum())

    best, best_cut = side.copy(), cut()
    for _ in range(rounds):
        other = np.bincount(source, side[target] != side[source], len(x))
        gain = 2 * other - np.bincount(source, minlength=len(x))
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        n = min(len(left), len(right))
        good = int((gain[left[:n]] + gain[right[:n]] > 0).sum())
        if not good:
            break
        swap = max(1, good // 2)  # all at once would undo each other
        side[left[:swap]], side[right[:swap]] = True, False
        if (now := cut()) < best_cut:
            best, best_cut = side.copy(), now
    return best


def partition_graph(x: np.ndarray, graph: np.ndarray, levels: int) -> np.ndarray:
    """Balanced partitions 0 to 2 ** levels - 1."""
    part = np.zeros(len(x), np.int64)
    for _ in range(levels):
        deeper = np.zeros(len(x), np.int64)
        for p in range(part.max() + 1):
            own = np.flatnonzero(part == p)
            number = np.full(len(x), -1)
            number[own] = np.arange(len(own))
            inner = [n[n >= 0] for n in number[graph[own]]]
            deeper[own] = 2 * p + bisect_graph(x[own], inner)
        part = deeper
    return part


@dataclass(frozen=True)
class Router:
    mean: np.ndarray
    scale: float
    layers: tuple[np.ndarray, ...]  # weights and biases of two layers

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        z = np.clip(np.clip(x, -MODERATE, MODERATE) - self.mean, -1e6 * self.scale, 1e6 * self.scale) / self.scale
        return np.maximum(z @ a + b, 0) @ c + d

    def probable(self, x: np.ndarray, coverage: float) -> np.ndarray:
        """For each row and partition, whether it is among the fewest that reach the coverage together (one at least)."""
        logits = self.logits(x)
        share = np.exp(logits - logits.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        order = np.argsort(-share, axis=1, kind="stable")
        share = np.take_along_axis(share, order, axis=1)
        taken = np.cumsum(share, axis=1) - share < coverage
        taken[:, 0] = True
        out = np.zeros(share.shape, bool)
        np.put_along_axis(out, order, taken, axis=1)
        return out


def train_router(x: np.ndarray, part: np.ndarray, graph: np.ndarray, rounds: int = 8, seed: int = 7) -> Router:
    """Adam on the cross-entropy with soft targets."""
    rng = np.random.default_rng(seed)
    parts = int(part.max()) + 1
    mean, scale = x.mean(axis=0), float(x.std()) or 1.0
    z = (x - mean) / scale
    near = part[graph]
    target = np.stack([(near == p).mean(axis=1) for p in range(parts)], axis=1) * 0.5
    target[np.arange(len(x)), part] += 0.5
    shapes = ((x.shape[1], HIDDEN), (HIDDEN,), (HIDDEN, parts), (parts,))
    layers = [rng.normal(0, (2 / s[0]) ** 0.5, s) if len(s) == 2 else np.zeros(s) for s in shapes]
    first, second, step = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes], 0
    for _ in range(rounds):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 128):
            at = order[i : i + 128]
            hidden = np.maximum(z[at] @ layers[0] + layers[1], 0)
            out = hidden @ layers[2] + layers[3]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            gap = (out / out.sum(axis=1, keepdims=True) - target[at]) / len(at)
            back = gap @ layers[2].T * (hidden > 0)
            grads = (z[at].T @ back, back.sum(axis=0), hidden.T @ gap, gap.sum(axis=0))
            step += 1
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g**2
                layers[k] -= 0.002 * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Router(mean, scale, tuple(layers))


def fit(sample: np.ndarray, levels: int = LEVELS) -> Router | None:
    """None for a sample too small to cut."""
    size = np.abs(sample).max(axis=1)
    sample = np.unique(sample[(size < MODERATE) & (size > 1 / MODERATE)], axis=0)
    if len(sample) < LEAST_SAMPLE:
        return None
    graph = neighbour_graph(sample, NEIGHBOURS)
    return train_router(sample, partition_graph(sample, graph, levels), graph)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _blocks(vectors: DataFrame, router: Router | None, coverage: float, size: int) -> DataFrame:
    """Vectors packed by partition: part, number, ids and vectors as bytes."""

    def rows(batches):
        held: dict[int, list] = {}
        number = TaskContext.get().partitionId()

        def pack(part, own):
            nonlocal number
            number += 1
            ids, x = np.concatenate([i for i, _ in own]), np.concatenate([v for _, v in own])
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()), "ids": pa.array([ids.tobytes()]), "x": pa.array([np.ascontiguousarray(x).tobytes()])})

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x = batch.column("vec_id").to_numpy(), _matrix(batch.column("embedding"))
            routes = router.probable(x, coverage) if router else np.ones((len(x), 1), bool)
            for part in np.flatnonzero(routes.any(axis=0)):
                own = routes[:, part]
                for at in np.array_split(np.flatnonzero(own), -(-int(own.sum()) // size)):
                    held.setdefault(int(part), []).append((ids[at], x[at]))
                    if sum(len(i) for i, _ in held[int(part)]) >= size:
                        yield pack(int(part), held.pop(int(part)))
        for part, own in held.items():
            yield pack(part, own)

    packed = vectors.select("vec_id", "embedding").mapInArrow(rows, "part int, number int, ids binary, x binary")
    return _full(packed.withColumn("near", F.floor(F.spark_partition_id() / TASKS_TOGETHER)), size)


def _full(blocks: DataFrame, size: int) -> DataFrame:
    """Fuller blocks: a task that packs its rows by partition leaves a part of a block for each, however many rows there are.
    Those of some tasks (``near``) meet, so that a partition with any share of the rows is many groups."""

    def rows(batches):
        held: dict[int, list] = {}
        number = TaskContext.get().partitionId()

        def pack(part, own):
            nonlocal number
            number += 1
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()), "ids": pa.array([b"".join(i for i, _ in own)]), "x": pa.array([b"".join(v for _, v in own)])})

        for batch in batches:
            for part, ids, x in zip(*(batch.column(c).to_pylist() for c in ("part", "ids", "x")), strict=True):
                held.setdefault(part, []).append((ids, x))
                if sum(len(i) for i, _ in held[part]) >= 8 * size:
                    yield pack(part, held.pop(part))
        for part, own in held.items():
            yield pack(part, own)

    return blocks.repartition("part", "near").drop("near").mapInArrow(rows, "part int, number int, ids binary, x binary")


def _distances(x: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances; where squares leave the doubles' range, of scaled differences."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        gap = x - query
        out = np.sqrt((gap**2).sum(axis=1))
        size = np.abs(gap).max(axis=1)
        odd = np.isfinite(size) & (size > 0) & ((size > MODERATE) | (size < 1 / MODERATE))
        if odd.any():
            out[odd] = size[odd] * np.sqrt(((gap[odd] / size[odd, None]) ** 2).sum(axis=1))
    return out


def _rough(x: np.ndarray, queries: np.ndarray, kind: type) -> tuple[np.ndarray, float]:
    """Squared distances of vectors with components up to 1, and by how much two of them may be out of order."""
    near, asked = x.astype(kind), queries.astype(kind)
    norms, own = (near**2).sum(axis=1), (asked**2).sum(axis=1)
    out = asked @ near.T
    out *= -2
    out += norms
    out += own[:, None]
    most = float(max(norms.max(), own.max()))
    return out, 8 * (x.shape[1] + 16) * float(np.finfo(kind).eps) * most


def nearest_in(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, ids and distances of the k nearest in a block, none beyond ``known`` (a distance for each query); ties to the
    smaller id, and of rows that share an id the nearest.

    A product of matrices, of vectors scaled to at most 1, finds the vectors that may be among them; these are measured exactly.
    Single precision does where it leaves few of them.
    """
    scale = float(2.0 ** np.frexp(max(np.abs(x).max(), np.abs(queries).max()))[1] / 2)
    near, asked = x / scale, queries / scale
    m = min(k * int(np.unique(ids, return_counts=True)[1].max()) + 1, len(ids))  # so many rows, the query's own aside, hold k ids
    for kind in (np.float32, np.float64):
        rough, slack = _rough(near, asked, kind)
        for i in np.flatnonzero(np.isin(ids, query_ids)):
            rough[query_ids == ids[i], i] = np.inf
        with np.errstate(over="ignore"):
            bound = np.full(len(queries), np.inf) if known is None else (known / scale) ** 2 * (1 + 1e-9)
        fresh = np.flatnonzero(np.isinf(bound))
        if len(fresh):
            bound[fresh] = np.partition(rough[fresh], m - 1, axis=1)[:, m - 1]
        most = np.minimum(np.nextafter((bound + slack).astype(kind), kind(np.inf)), np.finfo(kind).max)  # of the same kind, so nothing is cast
        at, place = np.divmod(np.flatnonzero(rough <= most[:, None]), len(ids))
        if len(at) <= 8 * m * len(queries):
            break
    found = [_distances(x[place[i : i + EXACT]], queries[at[i : i + EXACT]]) for i in range(0, len(at), EXACT)]
    return _first(at, ids[place], np.concatenate(found) if found else np.zeros(0), query_ids, k)


def _first(at: np.ndarray, ids: np.ndarray, score: np.ndarray, query_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest ids of each place in ``query_ids``, in order."""
    order = np.lexsort((score, ids, at))
    at, ids, score = at[order], ids[order], score[order]
    own = np.ones(len(at), bool)
    own[1:] = (at[1:] != at[:-1]) | (ids[1:] != ids[:-1])
    at, ids, score = at[own], ids[own], score[own]
    order = np.lexsort((ids, score, at))
    at, ids, score = at[order], ids[order], score[order]
    kept = np.arange(len(at)) - np.searchsorted(at, at) < k
    return query_ids[at[kept]], ids[kept], score[kept]


class _Best:
    """The k nearest so far of the queries that a task meets, by their block."""

    def __init__(self, k: int):
        self.k, self.rows, self.found = k, 0, {}

    def add(self, ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, queries: np.ndarray) -> None:
        """``query_ids`` are distinct and sorted."""
        key = query_ids.tobytes()
        old = self.found.get(key)
        known = np.full(len(query_ids), np.inf)
        if old is not None:
            asked, counts = np.unique(old[0], return_counts=True)
            full = counts == self.k
            known[np.searchsorted(query_ids, asked[full])] = old[2][(np.cumsum(counts) - 1)[full]]
        new = nearest_in(ids, x, query_ids, queries, self.k, known)
        if old is not None:
            new = _first(np.searchsorted(query_ids, np.concatenate((old[0], new[0]))), *(np.concatenate(c) for c in zip(old[1:], new[1:], strict=True)), query_ids, self.k)
        self.rows += len(new[0]) - (len(old[0]) if old is not None else 0)
        self.found[key] = new

    def take(self) -> list[pa.RecordBatch]:
        out = [pa.RecordBatch.from_arrays(list(map(pa.array, c)), ["query_id", "vec_id", "score"]) for c in self.found.values()]
        self.rows, self.found = 0, {}
        return out


def _search(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    sizes = candidates.groupBy("part").agg(F.sum(F.octet_length("ids") / 8).alias("rows")).collect()  # a row for each partition, 2 ** MOST_LEVELS at most
    tasks = F.create_map(*[F.lit(x) for r in sizes for x in (r["part"], math.ceil(r["rows"] / (BLOCK * BLOCKS_PER_TASK)))]) if sizes else F.create_map().cast("map<int,long>")
    salted = candidates.withColumn("salt", F.pmod(F.xxhash64("number", "ids"), tasks[F.col("part")]))
    asked = queries.withColumn("n", tasks[F.col("part")]).where("n is not null")  # a partition without rows has nothing to find
    asked = asked.select("part", F.col("ids").alias("query_ids"), F.col("x").alias("queries"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("salt"))
    pairs = salted.join(asked, ["part", "salt"]).select("ids", "x", "query_ids", "queries")

    def rows(batches):
        best = _Best(k)
        for batch in batches:
            for ids, x, query_ids, queries_ in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                ids, query_ids = np.frombuffer(ids, np.int64), np.frombuffer(query_ids, np.int64)
                order = np.argsort(query_ids)
                best.add(ids, np.frombuffer(x).reshape(len(ids), -1), query_ids[order], np.frombuffer(queries_).reshape(len(query_ids), -1)[order])
                if best.rows > HELD_ROWS:
                    yield from best.take()
        yield from best.take()

    found = pairs.mapInArrow(rows, "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def levels_for(rows: int) -> int:
    return min(MOST_LEVELS, max(LEVELS, math.ceil(math.log2(max(rows / ROWS_PER_PARTITION, 1)))))


def nearest(vectors: DataFrame, every: int = QUERY_EVERY, k: int = K, coverage: float = COVERAGE, sample_vectors: int = SAMPLE_VECTORS) -> DataFrame:
    """For each vector whose id is divisible by ``every``: query_id, rank, vec_id, score of its ``k`` nearest found."""
    own = usable(vectors)
    levels = levels_for(own.count())
    size = min(sample_vectors, max(SAMPLE_LEAST, SAMPLE_PER_PARTITION << levels))
    sample = own.orderBy(sample_order("vec_id"), "vec_id", "embedding").limit(size).select("embedding").toArrow()["embedding"]
    router = fit(_matrix(sample.combine_chunks()), levels) if len(sample) else None
    queries = own.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    candidates = materialize(_blocks(own, router, 0.0, BLOCK), "vectors")
    found = materialize(_search(candidates, _blocks(queries, router, coverage, QUERY_BLOCK), k), "nearest")
    full = found.groupBy("query_id").count().where(F.col("count") >= k).withColumnRenamed("query_id", "vec_id")
    short = materialize(queries.join(full, "vec_id", "left_anti"), "short")
    if router is None or short.isEmpty():
        return found
    again = _search(candidates, _blocks(short, router, 2.0, QUERY_BLOCK), k)
    return found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(again)
