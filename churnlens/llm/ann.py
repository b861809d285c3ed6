"""Approximate nearest neighbours with balanced posting lists.

Equal vectors are one point, with the smallest ids that a result can need.
Centroids are fitted by balanced k-means on a bounded sample; every point is
put on the list of its nearest centroid, and points near a boundary are
replicated to the lists of further centroids at a similar distance.  The
centroids form an in-memory neighbour graph, over which both points and
queries find their centroids by best-first search; a query keeps the lists
whose distance is within a ratio of its nearest one.  Long lists are split
into blocks, so no list, however common its vectors, meets in one task.

Inner products are turned into distances by one more coordinate,
sqrt(max norm^2 - norm^2), which is 0 for queries: the nearest point is then
the one with the largest inner product.  Scores are computed in double
precision on the original vectors.

Sizes: the sample has at most ``SAMPLE`` points and there are at most
``CENTROIDS`` centroids, so what is sent to the tasks is bounded.

Defined results: rows take no part if the id or the vector is null, the vector
is zero, holds a null or non-finite component, or has another length than most
vectors.  Repeated rows are one candidate; ties go to the smaller id; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import stored

SAMPLE, CENTROIDS = 65_536, 4_096
#: Points of a block of a list, and the lists within the ratio that a query may read whatever their share.
BLOCK, READ = 4_096, 16
#: A query reads lists until they have so many times the points it returns.
REACH = 4
#: Neighbours in the centroid graph.
DEGREE = 24


def usable(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, v array<double>)`` of the rows that take part."""
    v = F.col("v")
    rows = embeddings.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where("id is not null and v is not null")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.coalesce(sound, F.lit(False)) & F.exists(v, lambda x: x != 0))
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (usual["d"] if usual else 0))


def points(rows: DataFrame, most: int) -> DataFrame:
    """``(point, ids, v)``: distinct vectors with their ``most`` smallest ids; the point is the smallest."""

    def gather(batches):
        held: dict[bytes, list[int]] = {}

        def out():
            d = len(next(iter(held))) // 8
            flat = np.frombuffer(b"".join(held), np.float64)
            table = pa.RecordBatch.from_arrays([pa.array(list(held.values()), pa.list_(pa.int64())), pa.ListArray.from_arrays(pa.array(np.arange(len(held) + 1, dtype=np.int32) * d), pa.array(flat))], ["ids", "v"])
            held.clear()
            return table

        for b in batches:
            for i, v in zip(b.column("id").to_pylist(), b.column("v"), strict=True):
                key = (v.values.to_numpy() + 0.0).tobytes()
                ids = held.setdefault(key, [])
                if i not in ids:
                    ids.append(i)
                    if len(ids) > 4 * most:
                        ids[:] = sorted(ids)[:most]
            if len(held) > 50_000:
                yield out()
        if held:
            yield out()

    some = rows.select("id", "v").mapInArrow(gather, "ids array<long>, v array<double>")
    # a vector comes at most once from each task and flush, with a bounded list
    whole = some.groupBy("v").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, most).alias("ids"))
    return whole.select(F.element_at("ids", 1).alias("point"), "ids", "v")


def matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def lifted(v: np.ndarray, top: float) -> np.ndarray:
    """Vectors with the coordinate that makes their norms equal."""
    return np.hstack([v, np.sqrt(np.maximum(top * top - (v * v).sum(axis=1, keepdims=True), 0.0))])


def balanced_centroids(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """k-means whose assignment costs more for clusters above the mean size."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)]
    weight = np.zeros(k)
    for _ in range(rounds):
        near = np.empty(len(x), np.int64)
        scale = 0.0
        for a in range(0, len(x), 4096):
            d = (c * c).sum(axis=1) - 2 * x[a : a + 4096] @ c.T + (x[a : a + 4096] ** 2).sum(axis=1, keepdims=True)
            near[a : a + 4096] = (d + weight).argmin(axis=1)
            scale += d.min(axis=1).sum()
        size = np.bincount(near, minlength=k)
        weight += 0.1 * scale / len(x) * (size * k / len(x) - 1)
        total = np.stack([np.bincount(near, x[:, j], minlength=k) for j in range(x.shape[1])], axis=1)
        c = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], x[rng.choice(len(x), k)])
    return c


class Graph:
    """The centroids and their neighbour graph."""

    def __init__(self, centroids: np.ndarray):
        self.c = centroids
        k = len(centroids)
        self.norm = (centroids**2).sum(axis=1)
        degree = min(DEGREE, k - 1)
        order = np.empty((k, degree), np.int64)
        for a in range(0, k, 1024):
            d = self.norm - 2 * centroids[a : a + 1024] @ centroids.T
            d[np.arange(len(d)), a + np.arange(len(d))] = np.inf
            order[a : a + 1024] = np.argsort(d, axis=1, kind="stable")[:, :degree]
        links = [set(row.tolist()) for row in order]
        for i, row in enumerate(order):  # both ways, so that every centroid can be reached
            for j in row:
                links[j].add(i)
        # a ring through the sorted first coordinate keeps the graph in one piece
        ring = np.argsort(centroids[:, 0], kind="stable").tolist()
        for i, j in zip(ring, ring[1:] + ring[:1], strict=True):
            if i != j:
                links[i].add(j)
                links[j].add(i)
        self.next = [np.array(sorted(s), np.int64) for s in links]
        self.entry = int(((centroids - centroids.mean(axis=0)) ** 2).sum(axis=1).argmin()) if k else 0

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest centroids found for each row: ids and squared distances, nearest first."""
        import heapq

        beam = min(beam, len(self.c))
        ids, dist = np.empty((len(x), beam), np.int64), np.empty((len(x), beam))
        for row, q in enumerate(x):
            qq = float(q @ q)
            seen = np.zeros(len(self.c), bool)
            seen[self.entry] = True
            first = qq + self.norm[self.entry] - 2 * float(q @ self.c[self.entry])
            open_, best = [(first, self.entry)], [(-first, self.entry)]
            while open_:
                d, i = heapq.heappop(open_)
                if len(best) == beam and d > -best[0][0]:
                    break
                near = self.next[i]
                near = near[~seen[near]]
                if not len(near):
                    continue
                seen[near] = True
                ds = qq + self.norm[near] - 2 * (self.c[near] @ q)
                if len(best) == beam:
                    good = ds < -best[0][0]
                    near, ds = near[good], ds[good]
                for d, j in zip(ds.tolist(), near.tolist(), strict=True):
                    if len(best) < beam:
                        heapq.heappush(best, (-d, j))
                    elif d < -best[0][0]:
                        heapq.heapreplace(best, (-d, j))
                    else:
                        continue
                    heapq.heappush(open_, (d, j))
            own = sorted((-d, j) for d, j in best)
            ids[row], dist[row] = [j for _, j in own], [max(d, 0.0) for d, _ in own]
        return ids, dist


def nearest(
    embeddings: DataFrame,
    k: int = 20,
    query=lambda i: F.pmod(i, F.lit(20)) == 0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    replicas: int = 4,
    boundary: float = 1.25,
    probes: float = 0.25,
    ratio: float = 1.2,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` largest inner products found for each query row.

    ``replicas`` and ``boundary``: a point stands on the lists of at most so
    many centroids, those within ``boundary`` times its least distance.
    ``probes`` and ``ratio``: a query reads at most this share of the lists,
    (but ``READ``), those within ``ratio`` times its least distance; it goes on
    in the order of distance until the lists read have ``REACH * k`` points.
    """
    spark = embeddings.sparkSession
    rows = stored(usable(embeddings, id_col, vector_col), "ann-rows")
    index = stored(points(rows, k + 1), "ann-points")
    n, top = index.agg(F.count("*"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))).first()
    lists = max(1, min(CENTROIDS, round(n**0.5)))
    if n:
        sample = index.orderBy(F.xxhash64("point"), "point").limit(SAMPLE).select("v").toArrow()
        graph = Graph(balanced_centroids(lifted(matrix(sample.column("v")), top), lists))
    else:
        graph = Graph(np.zeros((1, 1)))
    sent = spark.sparkContext.broadcast(graph)

    def near(x: np.ndarray, beam: int, within: float, held: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, list and place of the lists within the distance ratio, and of those needed to meet ``REACH * k`` points."""
        ids, d = sent.value.search(x, max(beam, 8))
        good = d <= within * within * np.maximum(d[:, :1], 1e-12)
        good[:, beam:] = False
        if held is not None:
            before = np.cumsum(held[ids], axis=1) - held[ids]
            good |= before <= REACH * k
            short = np.flatnonzero(held[ids].sum(axis=1) <= REACH * k)
            if len(short) and ids.shape[1] < len(held):  # very small lists: all of them in order
                more, rest = near(x[short], len(held), within, held)[:2]
                row, at = np.nonzero(np.delete(good, short, axis=0))
                left = np.delete(np.arange(len(x)), short)
                return np.concatenate([left[row], short[more]]), np.concatenate([np.delete(ids, short, axis=0)[row, at], rest]), np.zeros(0)
        row, at = np.nonzero(good)
        return row, ids[row, at], at

    def post(batches):
        for b in batches:
            if b.num_rows:
                row, at, place = near(lifted(matrix(b.column("v")), top), replicas, boundary)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(place == 0), b.column("point").take(take), b.column("v").take(take)], ["list", "main", "point", "v"])

    def ask(batches):
        for b in batches:
            if b.num_rows:
                v = matrix(b.column("v"))
                row, at, _ = near(np.hstack([v, np.zeros((len(v), 1))]), min(lists, max(READ, round(lists * probes))), ratio, sizes.value)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(at), b.column("point").take(take), b.column("v").take(take)], ["list", "query", "q"])

    postings = stored(index.select("point", "v").mapInArrow(post, "list long, main boolean, point long, v array<double>"), "ann-lists")
    held = np.zeros(lists, np.int64)  # points of each list that have it as their nearest
    for r in postings.where("main").groupBy("list").count().collect():
        held[r["list"]] = r["count"]
    sizes = spark.sparkContext.broadcast(held)
    blocks = postings.groupBy("list").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("blocks"))
    askers = rows.where(query(F.col("id"))).select("v").distinct().join(index.select("v", "point"), "v")
    asked = askers.select("point", "v").mapInArrow(ask, "list long, query long, q array<double>")
    asked = asked.join(blocks, "list").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select("list", "block", "query", "q")
    dealt = postings.join(blocks, "list").select("list", F.pmod(F.xxhash64("point"), F.col("blocks")).alias("block"), "point", "v")

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query": [], "point": [], "score": []}
        if left.num_rows and right.num_rows:
            ids, v = left.column("point").to_numpy(), matrix(left.column("v"))
            asking, q = right.column("query").to_numpy(), matrix(right.column("q"))
            m = min(k + 1, len(ids))
            for a in range(0, len(q), 256):
                s = q[a : a + 256] @ v.T
                least = -np.partition(-s, m - 1, axis=1)[:, m - 1 : m]
                row, at = np.nonzero(s >= least - 1e-9 * np.abs(least))
                exact = (q[a + row] * v[at]).sum(axis=1)
                order = np.lexsort((ids[at], -exact, row))
                row, at, exact = row[order], at[order], exact[order]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                good = place < m
                out["query"].append(asking[a + row[good]])
                out["point"].append(ids[at[good]])
                out["score"].append(exact[good])
        return pa.table({c: np.concatenate(x) if x else np.zeros(0, np.int64 if c != "score" else float) for c, x in out.items()})

    met = dealt.groupBy("list", "block").cogroup(asked.groupBy("list", "block")).applyInArrow(best, "query long, point long, score double")
    found = met.groupBy("query", "point").agg(F.max("score").alias("score")).join(index.select("point", "ids"), "point")
    ranked = (
        found.select("query", "score", F.explode("ids").alias("id"))
        .groupBy("query")
        .agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("below"), "id"))), 1, k + 1).alias("found"))
    )
    queries = rows.where(query(F.col("id"))).select("id", "v").distinct().join(index.select("v", F.col("point").alias("query")), "v").select("id", "query").join(ranked, "query")
    own = queries.select(F.col("id").alias("query_id"), F.posexplode(F.slice(F.filter("found", lambda f: f["id"] != F.col("id")), 1, k)).alias("rank", "f"))
    return own.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("f.id").alias("vec_id"), (-F.col("f.below")).alias("score"))
