"""Exact top-k inner products by dual-tree search over cover trees.

Vectors are dealt to blocks around pivots, queries as well. A block is the top of a cover tree:
a centre and the radius that covers its vectors. No inner product of a query block and a data
block exceeds ``cq.cd + rq |cd| + rd |cq| + rq rd``. First each query block meets the data block
of its highest bound, which gives every query a kth score; then the pairs of blocks whose bound is
under the worst of their queries' kth scores are dropped, and the others meet. Where two blocks
meet, a cover tree of either is walked together: a pair of nodes is dropped by the same bound
against the worst kth score of the query node's members.

Pivots are a bounded sample by hash (``PIVOTS``); every vector is in a block, and a pivot with many
vectors, copies too, is split by hash into blocks of about ``VALUES`` components. Queries are a stated
set, met with all rows in blocks; theirs hold as many components and go on from one pivot to the next,
so few queries are one block. A pair of blocks that meets is shuffled in the narrowest integers that
hold it, so N vectors and Q queries of d components move about ``2 N Q d / VALUES`` vectors at most.
Results are exact integers.

Defined results: vectors that are null, empty, or hold nulls or non-finite values take no part; a
query's candidates are the vectors of its length, without its own id; ties go to the smaller id;
fewer candidates than k give fewer rows; repeated rows of an id are one candidate each; an empty
table gives an empty one. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.common import keep, ship

PIVOTS, VALUES, LEAF = 64, 1 << 20, 128
#: Room for rounding in bounds, which are computed in floating point.
ROUND = 1e-9


@dataclass
class Node:
    center: np.ndarray
    radius: float
    members: np.ndarray
    children: list[Node] = field(default_factory=list)
    norm: float = 0.0

    def __post_init__(self) -> None:
        self.norm = float(np.sqrt(self.center @ self.center))


def cover_tree(points: np.ndarray, members: np.ndarray | None = None) -> Node:
    """A cover tree: a node's children are a net of its members, farthest first, at half its radius or
    as near as ``LEAF`` children come, each taking the members that are nearest to it. Every node has
    the radius that really covers its members."""
    if members is None:
        members = np.arange(len(points))
    some = points[members]
    center = some[np.argmin(((some - some.mean(axis=0)) ** 2).sum(axis=1))]
    away = np.sqrt(((some - center) ** 2).sum(axis=1))
    node = Node(center, float(away.max()), members)
    if len(members) <= LEAF or node.radius == 0:
        return node
    nearest, owner, net = away.copy(), np.zeros(len(members), dtype=int), [0]
    while (far := int(nearest.argmax())) is not None and nearest[far] > node.radius / 2 and len(net) < LEAF:
        distance = np.sqrt(((some - some[far]) ** 2).sum(axis=1))
        closer = distance < nearest
        owner[closer], nearest[closer] = len(net), distance[closer]
        net.append(far)
    parts = [members[owner == i] for i in range(len(net))]
    node.children = [cover_tree(points, part) for part in parts if len(part)]
    if len(node.children) == 1:
        node.children = []
    return node


class Search:
    """The best ``k`` of some vectors for each query, both walked as trees."""

    def __init__(self, queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray,
                 k: int, floors: np.ndarray):
        self.queries, self.query_ids, self.vectors, self.ids, self.k = queries, query_ids, vectors, ids, k
        self.scores = [np.zeros(0, dtype=np.int64) for _ in query_ids]
        self.found = [np.zeros(0, dtype=np.int64) for _ in query_ids]
        self.worst = floors.astype(float)
        self.exact = _sums_fit(queries, vectors)

    def run(self) -> None:
        if len(self.queries) and len(self.vectors):
            self._meet(cover_tree(self.queries.astype(float)), [cover_tree(self.vectors.astype(float))])

    def _meet(self, query: Node, nodes: list[Node]) -> None:
        centers = np.stack([n.center for n in nodes])
        radii, norms = np.array([n.radius for n in nodes]), np.array([n.norm for n in nodes])
        bounds = centers @ query.center + query.radius * norms + radii * query.norm + radii * query.radius
        bounds += ROUND * (1 + np.abs(bounds) + query.norm * norms)
        for i in np.argsort(-bounds):
            node = nodes[i]
            if bounds[i] < self.worst[query.members].min():
                break
            if node.children and (not query.children or node.radius >= query.radius):
                self._meet(query, node.children)
            elif query.children:
                for child in query.children:
                    self._meet(child, [node])
            else:
                self._compare(query.members, node.members)

    def _compare(self, some: np.ndarray, members: np.ndarray) -> None:
        a, b = self.queries[some], self.vectors[members]
        scores = (a.astype(float) @ b.astype(float).T).astype(np.int64) if self.exact else a @ b.T
        enough = scores >= self.worst[some][:, None]
        for i in np.flatnonzero(enough.any(axis=1)):
            row, q = scores[i], some[i]
            take = np.flatnonzero(enough[i] & (self.ids[members] != self.query_ids[q]))
            s = np.concatenate([self.scores[q], row[take]])
            ids = np.concatenate([self.found[q], self.ids[members[take]]])
            best = np.lexsort((ids, -s))[:self.k]
            self.scores[q], self.found[q] = s[best], ids[best]
            if len(best) == self.k:
                self.worst[q] = max(self.worst[q], float(s[best[-1]]))


def _sums_fit(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether products' sums are exact in double precision."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    return most < 2 ** 53


def whole_vectors(embeddings: DataFrame, id_column: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """``vec_id``, ``dim`` and ``v``, the components as ``floor(scale * x)``; unusable rows left out."""
    value = F.transform(F.col(vector), lambda x: x.cast("double"))
    usable = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        embeddings.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & F.col(id_column).isNotNull())
        .where(F.coalesce(usable, F.lit(False)))
        .select(
            F.col(id_column).cast("bigint").alias("vec_id"), F.size(vector).alias("dim"),
            F.transform(value, lambda x: F.floor(x * scale).cast("bigint")).alias("v"))
    )


def matrix(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    column = table.column("v")
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy().reshape(table.num_rows, -1)


def dealt(vectors: DataFrame) -> DataFrame:
    """The vectors with the number of the nearest ``pivot``, of those of their length."""
    ship(vectors.sparkSession)
    chosen = (
        vectors.select("dim", "v", F.xxhash64("vec_id").alias("h"))
        .withColumn("place", F.row_number().over(Window.partitionBy("dim").orderBy("h")))
        .where(F.col("place") <= PIVOTS).orderBy("place").limit(PIVOTS).select("dim", "v").collect()
    )
    pivots: dict[int, np.ndarray] = {}
    for dim in {r[0] for r in chosen}:
        pivots[dim] = np.array([r[1] for r in chosen if r[0] == dim], dtype=float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            nearest = np.zeros(len(dims), dtype=np.int32)
            for dim in np.unique(dims):
                mine = np.flatnonzero(dims == dim)
                points = matrix(batch.take(pa.array(mine))).astype(float)
                centers = pivots.get(int(dim), np.zeros((1, dim)))
                nearest[mine] = ((centers ** 2).sum(axis=1) - 2 * points @ centers.T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest)], names=[*batch.schema.names, "pivot"])

    return vectors.mapInArrow(run, "vec_id bigint, dim int, v array<bigint>, pivot int")


BLOCKS = "block bigint, dim int, size int, center array<double>, radius double, ids binary, data binary"


def narrowest(points: np.ndarray) -> bytes:
    """The integers as bytes, in 2, 4 or 8 each."""
    low, high = points.min(initial=0), points.max(initial=0)
    kind = next(k for k in (np.int16, np.int32, np.int64) if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    return points.astype(kind).tobytes()


def widened(data: bytes, rows: int, dim: int) -> np.ndarray:
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[len(data) // (rows * dim)]
    return np.frombuffer(data, kind).reshape(rows, dim).astype(np.int64)


def packed(rows: DataFrame, across: bool = False) -> DataFrame:
    """One row for each block: its centre, radius, ids and vectors. Blocks ``across`` pivots go on from
    one to the next; others hold vectors of one pivot."""
    counts = rows.groupBy("dim", "pivot").agg(F.count("*").alias("n"))
    size = F.greatest(F.floor(F.lit(VALUES) / F.col("dim")), F.lit(1))
    place = F.pmod(F.xxhash64("vec_id"), F.col("n"))
    if across:  # at most PIVOTS counts a length are summed up
        before = Window.partitionBy("dim").orderBy("pivot").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
        part = F.floor((F.col("start") + place) / size)
    else:
        part = F.pmod(place, F.ceil(F.col("n") / size))
    dealt_rows = rows.join(keep(counts, "counts"), ["dim", "pivot"]).withColumn("part", part).drop("start")
    if across:
        dealt_rows = dealt_rows.withColumn("pivot", F.lit(0))

    def run(table: pa.Table) -> pa.Table:
        points = matrix(table)
        center = points.mean(axis=0)
        ids = table.column("vec_id").to_numpy()
        key = [int(table.column(c)[0].as_py()) for c in ("dim", "pivot", "part")]
        radius = float(np.sqrt(((points - center) ** 2).sum(axis=1)).max()) * (1 + 1e-12)
        return pa.table({
            "block": pa.array([(key[0] * PIVOTS + key[1]) << 32 | key[2]], pa.int64()),
            "dim": pa.array([key[0]], pa.int32()), "size": pa.array([len(ids)], pa.int32()),
            "center": pa.array([center.tolist()], pa.list_(pa.float64())), "radius": pa.array([radius], pa.float64()),
            "ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
            "data": pa.array([narrowest(points)], pa.binary()),
        })

    return dealt_rows.drop("n").groupBy("dim", "pivot", "part").applyInArrow(run, BLOCKS)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


FOUND = "query_block bigint, query_ids binary, floors binary, owners binary, vec_ids binary, scores binary, worst double"


def meet(pairs: DataFrame, k: int) -> DataFrame:
    """For each pair of blocks, what the search finds, and the queries' kth scores afterwards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                x = {n: c[row].as_py() for n, c in zip(batch.schema.names, batch.columns)}
                query_ids, ids = np.frombuffer(x["q_ids"], np.int64), np.frombuffer(x["ids"], np.int64)
                queries = widened(x["q_data"], len(query_ids), x["dim"])
                vectors = widened(x["data"], len(ids), x["dim"])
                floors = np.frombuffer(x["floors"]) if x["floors"] else np.full(len(query_ids), -np.inf)
                search = Search(queries, query_ids, vectors, ids, k, floors)
                search.run()
                owners = np.repeat(query_ids, [len(s) for s in search.scores])
                out = {
                    "query_block": pa.array([x["query_block"]], pa.int64()),
                    "query_ids": pa.array([x["q_ids"]], pa.binary()),
                    "floors": pa.array([search.worst.tobytes()], pa.binary()),
                    "owners": pa.array([owners.tobytes()], pa.binary()),
                    "vec_ids": pa.array([np.concatenate(search.found).tobytes()], pa.binary()),
                    "scores": pa.array([np.concatenate(search.scores).tobytes()], pa.binary()),
                    "worst": pa.array([float(search.worst.min())], pa.float64()),
                }
                yield pa.RecordBatch.from_pydict(out)

    return pairs.mapInArrow(run, FOUND)


def listed(found: DataFrame) -> DataFrame:
    """The results of ``meet`` as rows: ``query_id, vec_id, score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("owners", "vec_ids", "scores")
        for batch in batches:
            parts = [np.frombuffer(b"".join(batch.column(n).to_pylist()), np.int64) for n in names]
            yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts], names=["query_id", "vec_id", "score"])

    return found.select("owners", "vec_ids", "scores").mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")


def search(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """The ``k`` best of all ``vectors`` (see ``whole_vectors``) for those that are queries:
    ``query_id, rank, vec_id, score``."""
    rows = keep(dealt(vectors), "dealt")
    data = keep(packed(rows), "blocks")
    queries = keep(packed(rows.where(is_query), across=True), "query-blocks").withColumnsRenamed({
        "block": "query_block", "center": "q_center", "radius": "q_radius", "ids": "q_ids", "data": "q_data"})
    norm = lambda c: F.sqrt(dot(F.col(c), F.col(c)))
    bound = (
        dot(F.col("q_center"), F.col("center")) + F.col("q_radius") * norm("center")
        + F.col("radius") * norm("q_center") + F.col("radius") * F.col("q_radius")
    )
    bounds = keep(
        queries.select("query_block", "dim", "q_center", "q_radius")
        .join(data.select("block", "dim", "center", "radius"), "dim")
        .select("query_block", "block", (bound + ROUND * (1 + F.abs(bound) + norm("center") * norm("q_center"))).alias("bound")), "bounds")
    first = bounds.groupBy("query_block").agg(F.max_by("block", F.struct("bound", "block")).alias("block"))
    vectors_of = data.select("block", "dim", "ids", "data")
    queries_of = queries.select("query_block", "q_ids", "q_data")
    begun = keep(
        meet(first.join(queries_of, "query_block").join(vectors_of, "block").withColumn("floors", F.lit(None).cast("binary")), k), "begun")
    left = (
        bounds.join(begun.select("query_block", "floors", "worst"), "query_block")
        .where(F.col("bound") >= F.col("worst"))
        .join(first, ["query_block", "block"], "left_anti")
    )
    rest = meet(left.join(queries_of, "query_block").join(vectors_of, "block").repartition("query_block", "block"), k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        listed(begun).unionByName(listed(rest))
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
