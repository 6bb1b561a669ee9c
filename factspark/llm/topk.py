"""Exact top-k search by inner product as a Voronoi join.

With M the largest norm of the data, a vector x gets one more component
sqrt(M^2 - |x|^2) and a query gets zero; the highest inner products are then the smallest
distances, |q|^2 + M^2 - 2 q.x. Data and queries are dealt to the cells of pivots, and
cells of queries are put together to groups. The summaries of the cells (how far their
members lie from the pivot, and the nearest ones) bound how far the k nearest of any
query of a group can be; a vector goes only to groups that this bound lets it reach.
There, blocks of queries meet blocks of vectors, and the best of all blocks are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factspark.llm.blocks import prepare
from factspark.llm.components import stored

#: Pivots, queries in a block, vectors in a block, and scores held at once.
PIVOTS = 128
QUERY_BLOCK = 2048
VECTOR_BLOCK = 1 << 14
_SCORES = 4 << 20


def quantized(vectors: DataFrame, scale: int, id_column: str, vector_column: str) -> DataFrame:
    """``id`` and ``v``: floor(scale * x) of each component, as 64-bit integers end to end.

    Leaves out vectors that are null or hold a component that is null or not finite,
    and rows without an id.
    """
    prepare(vectors.sparkSession)
    named = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector_column}`").cast("array<double>").alias("x")
    )

    def sound(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    whole = named.filter(F.col("id").isNotNull() & F.col("x").isNotNull() & F.forall("x", sound))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("x")
            values = np.floor(scale * np.asarray(column.flatten())).astype("<i8")
            sizes = np.asarray(column.value_lengths()).astype(np.int64)
            edges = np.concatenate(([0], np.cumsum(sizes * 8))).astype(np.int32)
            packed = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(edges), pa.py_buffer(values)])
            yield pa.record_batch({"id": batch.column("id"), "v": packed})

    return whole.mapInArrow(pack, "id long, v binary")


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Packed vectors of one length as rows."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<i8").reshape(len(rows), -1)


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """All inner products as exact 64-bit integers."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * queries.shape[1]
    if most < 2**53:
        return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    return queries @ vectors.T


@dataclass(frozen=True)
class Cells:
    """Pivots of one vector length, with their added component."""

    pivots: np.ndarray
    added: np.ndarray
    norm: float

    @staticmethod
    def of(pivots: np.ndarray, norm: float) -> Cells:
        own = (pivots.astype(np.float64) ** 2).sum(1)
        return Cells(pivots.astype(np.float64), np.sqrt(np.maximum(norm - own, 0)), norm)

    def nearest(self, x: np.ndarray, query: bool) -> tuple[np.ndarray, np.ndarray]:
        """The nearest pivot of each row, and the distance to it."""
        x = x.astype(np.float64)
        own = (x**2).sum(1)
        added = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.norm - own, 0))
        squares = own[:, None] + (self.pivots**2).sum(1) - 2 * x @ self.pivots.T + (added[:, None] - self.added) ** 2
        cell = squares.argmin(1)
        return cell, np.sqrt(np.maximum(squares[np.arange(len(x)), cell], 0))

    def between(self) -> np.ndarray:
        squares = ((self.pivots[:, None] - self.pivots) ** 2).sum(2) + (self.added[:, None] - self.added) ** 2
        return np.sqrt(squares)


@dataclass(frozen=True)
class Plan:
    """Where queries and vectors of one length go."""

    cells: Cells
    group_of: np.ndarray
    blocks: np.ndarray
    #: For each cell of vectors and group: the least and the largest distance to the pivot that can matter.
    least: np.ndarray
    most: np.ndarray
    slices: int


def make_plan(cells: Cells, near: dict[int, list[float]], queries: dict[int, tuple[int, float]], k: int, vectors: int) -> Plan:
    """``near``: the k smallest distances in each cell of vectors; ``queries``: the number
    and the largest distance in each cell of queries; ``vectors``: how many there are."""
    n = len(cells.pivots)
    apart = cells.between()
    slack = 1e-6 * (1 + np.sqrt(cells.norm))
    used = sorted(queries)
    # Cells of queries are grouped along the order of their distance to the first pivot.
    total = sum(queries[i][0] for i in used)
    wanted = max(1, min(len(used), -(-total // QUERY_BLOCK)))
    group_of, filled, group = np.full(n, -1), 0, 0
    for i in sorted(used, key=lambda i: apart[0, i]):
        group_of[i] = min(group, wanted - 1)
        filled += queries[i][0]
        if filled * wanted >= total * (group + 1):
            group += 1
    groups = int(group_of.max()) + 1
    sizes = np.zeros(groups, np.int64)
    least, most = np.full((n, groups), np.inf), np.full((n, groups), -np.inf)
    for i in used:
        reach = queries[i][1]
        bounds = sorted(reach + apart[i, j] + d for j, ds in near.items() for d in ds)
        bound = bounds[k - 1] if len(bounds) >= k else np.inf
        g = group_of[i]
        sizes[g] += queries[i][0]
        least[:, g] = np.minimum(least[:, g], apart[i] - reach - bound - slack)
        most[:, g] = np.maximum(most[:, g], apart[i] + reach + bound + slack)
    return Plan(cells, group_of, np.maximum(1, -(-sizes // QUERY_BLOCK)), least, most, max(1, -(-vectors // VECTOR_BLOCK)))


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = np.array([len(v) // 8 for v in batch.column("v").to_pylist()], np.int64)
    for size in np.unique(sizes).tolist():
        yield size, batch.take(pa.array(np.flatnonzero(sizes == size)))


def top_k(
    vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """The ``k`` highest scores of each query: ``query_id, rank, vec_id, score``.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but the
    query's own (others with its id take part); the score is the inner product of
    floor(scale * x), ties go to the smaller id. Vectors that are null or hold a null or
    non-finite component, and rows without an id, take no part; vectors of different
    lengths don't meet. Equal vectors are searched once, and of many equal candidates
    the k + 1 smallest ids are enough. Repeated query rows give repeated results; an
    empty table gives none.
    """
    rows = stored(quantized(vectors, scale, id_column, vector_column), "vectors")
    size = F.length("v") / 8
    first = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    ids = rows.select("v", "id").withColumn("n", first).filter(F.col("n") <= k + 1)
    data = stored(ids.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "distinct-vectors")
    is_query = F.pmod("id", F.lit(every)) == 0
    queries = stored(rows.filter(is_query).select("v").distinct(), "distinct-queries")
    plans = _plans(data.withColumn("size", size.cast("int")), queries, k + 1)
    if not plans:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.col("id").alias("score")).limit(0)
    best = _solved(data, queries, plans, k + 1)
    merged = F.row_number().over(Window.partitionBy("v").orderBy(F.desc("score"), "id"))
    best = best.withColumn("n", merged).filter(F.col("n") <= k + 1)
    listed = F.sort_array(F.collect_list(F.struct("n", "id", "score")))
    best = best.groupBy("v").agg(listed.alias("best"), F.max("own").alias("own"))
    joined = rows.filter(is_query).withColumnRenamed("id", "query_id").join(best, "v")
    # The query's own row is one of those with its id and its own score, if it came this far.
    is_own = F.transform("best", lambda x: (x["id"] == F.col("query_id")) & (x["score"] == F.col("own")))
    own = F.array_position(is_own, True).cast("int")
    after = F.slice("best", own + 1, F.lit(k + 1))
    others = F.when(own > 0, F.concat(F.slice("best", F.lit(1), own - 1), after)).otherwise(F.col("best"))
    listed = joined.withColumn("others", F.slice(others, 1, k))
    listed = listed.select("query_id", F.posexplode("others").alias("place", "hit"))
    return listed.select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("hit")["id"].alias("vec_id"), F.col("hit")["score"].alias("score")
    )


def _plans(data: DataFrame, queries: DataFrame, k: int) -> dict[int, Plan]:
    """A plan for each vector length, from pivots and summaries of bounded size."""
    chosen = F.row_number().over(Window.partitionBy("size").orderBy(F.xxhash64("v"), "v"))
    pivots = data.withColumn("n", chosen).filter(F.col("n") <= PIVOTS).select("size", "v").collect()
    counts = {r["size"]: r["n"] for r in data.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    norms = {r["size"]: r["norm"] for r in _norms(data).groupBy("size").agg(F.max("norm").alias("norm")).collect()}
    by_size: dict[int, list[bytes]] = {}
    for r in pivots:
        by_size.setdefault(r["size"], []).append(bytes(r["v"]))
    cells = {s: Cells.of(np.frombuffer(b"".join(v), "<i8").reshape(len(v), s), norms[s]) for s, v in by_size.items()}
    placed = _placed(data.select("v"), cells, False)
    nearest = F.row_number().over(Window.partitionBy("size", "cell").orderBy("distance"))
    near: dict[int, dict[int, list[float]]] = {}
    for r in placed.withColumn("n", nearest).filter(F.col("n") <= k).collect():
        near.setdefault(r["size"], {}).setdefault(r["cell"], []).append(r["distance"])
    asked: dict[int, dict[int, tuple[int, float]]] = {}
    for r in _placed(queries, cells, True).groupBy("size", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("d")).collect():
        asked.setdefault(r["size"], {})[r["cell"]] = (r["n"], r["d"])
    return {s: make_plan(cells[s], near[s], asked[s], k, counts[s]) for s in asked}


def _norms(data: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, part in _by_length(batch):
                norm = float((matrix(part.column("v")).astype(np.float64) ** 2).sum(1).max(initial=0))
                yield pa.record_batch({"size": pa.array([size], pa.int32()), "norm": pa.array([norm])})

    return data.select("v").mapInArrow(run, "size int, norm double")


def _placed(rows: DataFrame, cells: dict[int, Cells], query: bool) -> DataFrame:
    """``size, cell, distance`` of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, part in _by_length(batch):
                if size in cells:
                    cell, distance = cells[size].nearest(matrix(part.column("v")), query)
                    yield pa.record_batch({
                        "size": pa.array(np.full(len(cell), size, np.int32)),
                        "cell": pa.array(cell.astype(np.int32)),
                        "distance": pa.array(distance),
                    })

    return rows.select("v").mapInArrow(run, "size int, cell int, distance double")


_KEY = "size int, team int, block int, slice int"


def _solved(data: DataFrame, queries: DataFrame, plans: dict[int, Plan], k: int) -> DataFrame:
    """The ``k`` best (``id``, ``score``) of each distinct query ``v`` in each slice of the data.

    ``own`` is the query's score with itself.
    """

    def key(size: int, team: np.ndarray, block: np.ndarray, part: np.ndarray) -> dict[str, pa.Array]:
        names = {"team": team, "block": block, "slice": part}
        return {"size": pa.array(np.full(len(team), size, np.int32))} | {n: pa.array(x.astype(np.int32)) for n, x in names.items()}

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, part in _by_length(batch):
                plan = plans[size]
                cell, _ = plan.cells.nearest(matrix(part.column("v")), True)
                team = plan.group_of[cell]
                block = _spread_by_hash(part.column("v"), 1) % plan.blocks[team]
                row = np.repeat(np.arange(len(cell)), plan.slices)
                yield pa.record_batch(key(size, team[row], block[row], np.tile(np.arange(plan.slices), len(cell))) | {"v": part.column("v").take(pa.array(row))})

    def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, part in _by_length(batch):
                if size not in plans:
                    continue
                plan = plans[size]
                cell, distance = plan.cells.nearest(matrix(part.column("v")), False)
                needed = (distance[:, None] >= plan.least[cell]) & (distance[:, None] <= plan.most[cell])
                row, team = np.nonzero(needed)
                copies = plan.blocks[team]
                row, team = np.repeat(row, copies), np.repeat(team, copies)
                block = np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)
                slice_ = _spread_by_hash(part.column("v"), 2)[row] % plan.slices
                took = part.take(pa.array(row))
                yield pa.record_batch(key(size, team, block, slice_) | {"v": took.column("v"), "ids": took.column("ids")})

    def solve(asked: pa.Table, offered: pa.Table) -> pa.Table:
        schema = pa.schema([("v", pa.binary()), ("id", pa.int64()), ("score", pa.int64()), ("own", pa.int64())])
        if not asked.num_rows or not offered.num_rows:
            return schema.empty_table()
        wanted = matrix(asked["v"])
        at, ids, scores = best_of(wanted, matrix(offered["v"]), offered["ids"].combine_chunks(), k)
        own = np.array([products(q[None, :], q[None, :])[0, 0] for q in wanted], np.int64)[at]
        found = {"v": asked["v"].take(pa.array(at)), "id": pa.array(ids), "score": pa.array(scores), "own": pa.array(own)}
        return pa.table(found).cast(schema)

    keys = ["size", "team", "block", "slice"]
    left = queries.select("v").mapInArrow(ask, f"{_KEY}, v binary").groupBy(*keys)
    right = data.select("v", "ids").mapInArrow(offer, f"{_KEY}, v binary, ids array<long>").groupBy(*keys)
    return left.cogroup(right).applyInArrow(solve, "v binary, id long, score long, own long")


def _spread_by_hash(column: pa.Array, seed: int) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh32_intdigest(v, seed) for v in column.to_pylist()], np.int64)


def best_of(queries: np.ndarray, vectors: np.ndarray, ids: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best (row of the query, id, score) of each query, ties to smaller ids.

    ``ids`` lists for each vector the ids that share it.
    """
    if isinstance(ids, pa.ChunkedArray):
        ids = pa.concat_arrays(ids.chunks)
    counts = np.asarray(ids.value_lengths()).astype(np.int64)
    flat = np.asarray(ids.flatten())
    begins = np.cumsum(counts) - counts
    held = (np.zeros(0, np.int64),) * 3
    step = max(1, _SCORES // len(queries))
    for first in range(0, len(vectors), step):
        scores = products(queries, vectors[first : first + step])
        wide = scores.shape[1]
        floor = np.partition(scores, wide - k, axis=1)[:, wide - k] if wide > k else np.full(len(queries), np.iinfo(np.int64).min)
        at, which = np.nonzero(scores >= floor[:, None])
        value, which = scores[at, which], which + first
        many = counts[which]
        place = np.repeat(begins[which] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        new = (np.repeat(at, many), flat[place], np.repeat(value, many))
        at, names, value = (np.concatenate(x) for x in zip(held, new, strict=True))
        order = np.lexsort((names, -value, at))
        at, names, value = at[order], names[order], value[order]
        head = np.searchsorted(at, at)
        keep = np.arange(len(at)) - head < k
        held = (at[keep], names[keep], value[keep])
    return held
