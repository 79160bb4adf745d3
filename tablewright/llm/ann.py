"""Approximate nearest neighbours: one navigable small-world graph per shard.

Vectors are dealt to shards by a hash of their id; the number of shards
follows the number of vectors, so a shard keeps its size.  A shard's graph is
hierarchical: the level of a node is drawn from a hash of its id, level 0
holds all nodes, and each level up about one in ``M`` of the one below.  Each
level is a flat array of neighbour numbers, ``M`` (level 0: ``2 M``) places
for each of its nodes.  Nodes are inserted in blocks that double up to
``BLOCK``: a block searches the graph built so far, its own nodes are
compared with each other, and links go both ways, thinned by the usual rule
(keep a neighbour only if it is nearer to the node than to every neighbour
kept before).

Graphs are written to the shared folder and searched from there: a query
goes down from the top level greedily and runs a beam search at level 0, and
the nearest of all shards are merged.  ``STEP`` queries walk in step, so a
step is a few array operations.  Queries come in blocks of ``QUERY_BLOCK``, and
a task holds one shard and one block, so a shard is sent once per block;
merging keeps the k best of each shard only.

Graphs are walked in single precision and nothing is decided by it: what a
shard hands on is ranked in double precision, and where a beam ends in the
middle of a tie, or found less of the shard than it could hold, the query is
compared with the whole shard.  The last pass computes the cosines of the
reported pairs on the original vectors.  Of vectors of the same direction one
is indexed, and the k + 1 smallest ids stand behind it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import keep_table, read_table
from tablewright.llm.minhash import mix

M, BEAM, BUILD_BEAM, SEEDS = 16, 160, 80, 4
SHARD_ROWS, BLOCK, QUERY_BLOCK, STEP = 4096, 256, 8192, 512
TIE = 1e-6  # cosines that single precision cannot tell apart
DIGITS = 13  # directions that agree in so many decimals are one


class Graph:
    """A hierarchical graph over the unit vectors ``x`` of one shard."""

    def __init__(self, x: np.ndarray, levels: np.ndarray, flat: list[np.ndarray] | None = None):
        self.x, self.levels = x, levels
        self.order = np.lexsort((np.arange(len(x)), -levels))  # top level first
        # place[l][i]: row of node i in the neighbour array of level l
        self.height = int(levels.max()) + 1 if len(x) else 0
        self.nodes = [np.flatnonzero(levels >= l) for l in range(self.height)]
        self.place = []
        for nodes in self.nodes:
            p = np.full(len(x), -1, np.int32)
            p[nodes] = np.arange(len(nodes))
            self.place.append(p)
        if flat is None:
            self.flat = [np.full((len(nodes), 2 * M if l == 0 else M), -1, np.int32)
                         for l, nodes in enumerate(self.nodes)]
            self._build()
        else:
            self.flat = [f.reshape(len(nodes), -1) for f, nodes in zip(flat, self.nodes)]

    def beam(self, q: np.ndarray, entry: np.ndarray, level: int, width: int):
        """Beam search of all queries in step: (nodes, cosines), best first; -1: none."""
        nq, n = len(q), len(self.x)
        place, flat = self.place[level], self.flat[level]
        ids = np.full((nq, width), -1, np.int32)
        sim = np.full((nq, width), -np.inf, np.float32)
        done = np.ones((nq, width), bool)
        seen = np.zeros((nq, n), bool)
        k = entry.shape[1]
        ids[:, :k] = entry
        sim[:, :k] = np.where(entry >= 0, np.einsum("qd,qkd->qk", q, self.x[entry]), -np.inf)
        done[:, :k] = entry < 0
        row, at = np.nonzero(entry >= 0)
        seen[row, entry[row, at]] = True
        best = np.argsort(-sim, 1, kind="stable")
        ids, sim, done = (np.take_along_axis(a, best, 1) for a in (ids, sim, done))
        live = np.arange(nq)
        while len(live):
            open_ = ~done[live]
            has = open_.any(1)
            live, open_ = live[has], open_[has]
            if not len(live):
                break
            # the two best nodes not yet expanded
            at = np.argsort(~open_, 1, kind="stable")[:, :2]
            ok = np.take_along_axis(open_, at, 1)
            node = np.where(ok, ids[live[:, None], at], -1)
            done[live[:, None], at] = True
            near = flat[place[np.maximum(node, 0)]]
            near = np.where(node[:, :, None] >= 0, near, -1).reshape(len(live), -1)
            near = np.where((near >= 0) & ~seen[live[:, None], np.maximum(near, 0)], near, -1)
            # the same node twice in a row counts once
            near = np.sort(near, 1)[:, ::-1]
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            row, at = np.nonzero(near >= 0)
            seen[live[row], near[row, at]] = True
            s = np.where(near >= 0, np.einsum("qd,qkd->qk", q[live], self.x[near]), -np.inf).astype(np.float32)
            ids2 = np.concatenate([ids[live], near], 1)
            sim2 = np.concatenate([sim[live], s], 1)
            done2 = np.concatenate([done[live], near < 0], 1)
            best = np.argsort(-sim2, 1, kind="stable")[:, :width]
            ids[live], sim[live], done[live] = (np.take_along_axis(a, best, 1) for a in (ids2, sim2, done2))
        return ids, sim

    def _entry(self, nq: int, level: int, started: int) -> np.ndarray:
        first = self.order[: min(SEEDS, started)]
        first = first[self.levels[first] >= level][:SEEDS]
        return np.tile(first.astype(np.int32), (nq, 1))

    def _thin(self, node: int, cand: np.ndarray, sim: np.ndarray, most: int) -> np.ndarray:
        """Neighbours of ``node`` out of ``cand`` (nearest first)."""
        if len(cand) <= most // 2:
            return cand
        cross = self.x[cand] @ self.x[cand].T
        keep: list[int] = []
        spare: list[int] = []
        for i in range(len(cand)):
            if len(keep) == most:
                break
            (keep if not keep or sim[i] > cross[i, keep].max() else spare).append(i)
        return cand[keep + spare[: most - len(keep)]]

    def _link(self, level: int, node: int, cand: np.ndarray, sim: np.ndarray) -> None:
        place, flat = self.place[level], self.flat[level]
        most = flat.shape[1]
        chosen = self._thin(node, cand, sim, most // 2)
        flat[place[node], : len(chosen)] = chosen
        for other in chosen:
            row = flat[place[other]]
            free = np.flatnonzero(row < 0)
            if len(free):
                row[free[0]] = node
            else:
                both = np.append(row, node)
                s = self.x[both] @ self.x[other]
                best = np.argsort(-s, kind="stable")
                kept = self._thin(int(other), both[best], s[best], most)
                row[:] = -1
                row[: len(kept)] = kept

    def _build(self) -> None:
        started = 0
        while started < len(self.order):
            block = self.order[started : started + max(1, min(BLOCK, started))]
            q = self.x[block]
            among = q @ q.T
            top = int(self.levels[block].max())
            entry = self._entry(len(block), self.height - 1, started) if started else None
            for level in range(self.height - 1, -1, -1):
                if started:
                    own = self._entry(len(block), level, started)
                    if entry is None or not entry.shape[1]:
                        entry = own
                    if not entry.shape[1]:
                        continue
                    ids, sim = self.beam(q, entry, level, BUILD_BEAM if level <= top else SEEDS)
                    entry = ids[:, :SEEDS]
                else:
                    ids = np.empty((len(block), 0), np.int32)
                    sim = np.empty((len(block), 0), np.float32)
                for i, node in enumerate(block):
                    if self.levels[node] < level:
                        continue
                    before = np.flatnonzero(self.levels[block[:i]] >= level)
                    cand = np.concatenate([ids[i][ids[i] >= 0], block[before]]).astype(np.int64)
                    s = np.concatenate([sim[i][ids[i] >= 0], among[i, before]])
                    if len(cand):
                        best = np.argsort(-s, kind="stable")[:BUILD_BEAM]
                        self._link(level, int(node), cand[best], s[best])
            started += len(block)

    def search(self, q: np.ndarray, width: int):
        """Nodes and cosines of the beam at level 0 for each query."""
        entry = self._entry(len(q), self.height - 1, len(self.order))
        for level in range(self.height - 1, 0, -1):
            entry = self.beam(q, entry, level, 2 * SEEDS)[0][:, :SEEDS]
        return self.beam(q, entry, 0, max(width, SEEDS))


def _levels(ids: np.ndarray) -> np.ndarray:
    u = (mix(ids.astype(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
    return np.minimum((-np.log(np.maximum(u, 1e-12)) / np.log(M)).astype(np.int64), 6)


def _matrix(column) -> np.ndarray:
    """Unit vectors, in double precision."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = np.asarray(values.flatten(), np.float64).reshape(len(values), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id``, ``v`` (array<double>) of the vectors that take part."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    return (df.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
            .where(F.col("id").isNotNull() & F.col("v").isNotNull() & fine & F.exists("v", lambda e: e != 0)))


def first_twins(vectors: DataFrame, most: int) -> DataFrame:
    """``id``, ``v``, ``rep``: of vectors of the same direction the ``most``
    smallest ids, and the smallest of them.  Ties go to smaller ids, so no
    other can be reported; Spark drops the rest of a large group before it is
    shuffled."""
    largest = F.array_max(F.transform("v", F.abs))
    scaled = vectors.withColumn("u", F.transform("v", lambda e: e / largest))
    norm = F.sqrt(F.aggregate("u", F.lit(0.0), lambda s, e: s + e * e))
    keyed = scaled.withColumn("norm", norm).withColumn(
        "way", F.transform("u", lambda e: F.floor(e / F.col("norm") * 10.0**DIGITS + 0.5)))
    twin = Window.partitionBy("way").orderBy("id")
    few = keyed.select("id", "v", "way").withColumn("nth", F.row_number().over(twin)).where(F.col("nth") <= most)
    return few.withColumn("rep", F.min("id").over(Window.partitionBy("way"))).drop("nth", "way")


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``id``, ``v`` to one row per shard: ids, levels, unit vectors and the
    flat neighbour arrays, all as bytes; written to the shared folder."""
    shards = max(1, -(-vectors.count() // shard_rows))

    def build(key, table):
        table = table.sort_by("id")
        ids = table.column("id").to_numpy().astype(np.int64)
        x = _matrix(table.column("v"))
        g = Graph(x.astype(np.float32), _levels(ids))
        return pa.Table.from_pydict(
            {"dim": [key[0].as_py()], "shard": [key[1].as_py()], "ids": [ids.tobytes()], "x": [x.tobytes()],
             "levels": [g.levels.astype(np.int8).tobytes()], "flat": [[f.tobytes() for f in g.flat]]},
            schema=pa.schema([("dim", pa.int64()), ("shard", pa.int64()), ("ids", pa.binary()), ("x", pa.binary()),
                              ("levels", pa.binary()), ("flat", pa.list_(pa.binary()))]))

    dealt = vectors.withColumns({"dim": F.size("v").cast("long"),
                                 "shard": F.pmod(F.xxhash64("id"), F.lit(shards)).cast("long")})
    graph = dealt.groupBy("dim", "shard").applyInArrow(
        build, "dim long, shard long, ids binary, x binary, levels binary, flat array<binary>")
    return keep_table(graph, "ann-index")


def _nearest_of_shard(g: Graph, x: np.ndarray, ids: np.ndarray, q: np.ndarray, own: np.ndarray, k: int, beam: int):
    """Query ids, ids and cosines of each query's ``2 k + 1`` nearest in a shard."""
    nodes, sims = g.search(q.astype(np.float32), beam)
    most = min(2 * k + 1, len(ids))
    # less than the beam could hold, or a tie that goes on where the beam ends
    short = (nodes >= 0).sum(1) < min(nodes.shape[1], len(ids))
    if nodes.shape[1] < len(ids):
        short |= sims[:, min(k, nodes.shape[1] - 1)] - sims[:, -1] <= TIE
    who, found, near = [], [], []

    def take(rows, at, cos):
        first = np.lexsort((ids[at], -np.round(cos, 12)), axis=-1)[:, :most]
        who.append(np.repeat(own[rows], most))
        found.append(np.take_along_axis(ids[at], first, 1).reshape(-1))
        near.append(np.take_along_axis(cos, first, 1).reshape(-1))

    rows = np.flatnonzero(~short)
    if len(rows):
        at = nodes[rows][:, : 4 * k + 2]  # a margin for what single precision confused
        take(rows, at, np.where(at >= 0, np.einsum("qd,qkd->qk", q[rows], x[at]), -np.inf))
    for at in range(0, int(short.sum()), 64):
        rows = np.flatnonzero(short)[at : at + 64]
        take(rows, np.broadcast_to(np.arange(len(ids)), (len(rows), len(ids))), q[rows] @ x.T)
    return np.concatenate(who), np.concatenate(found), np.concatenate(near)


def nearest(index: DataFrame, queries: DataFrame, twins: DataFrame, k: int, beam: int = BEAM) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest found, the
    query's own id aside, nearest first, ties to the smaller id.

    ``twins`` names for each indexed vector (``rep``) the ids that may be
    reported for it (``id``, ``v``).  Queries meet every shard in blocks of ``QUERY_BLOCK``: a stated query set
    against all rows."""
    # blocks of queries by a hash, of bounded expected size
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    dealt = queries.withColumns({"dim": F.size("v").cast("long"),
                                 "block": F.pmod(F.xxhash64("id", F.lit(7)), F.lit(blocks)).cast("long")})
    packed = dealt.groupBy("dim", "block").agg(F.collect_list(F.struct("id", "v")).alias("q"))
    packed = keep_table(packed, "ann-queries")
    numbers = index.select("dim", "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    numbers = numbers.withColumn("block", F.col("block").cast("long")).repartition("dim", "shard", "block")
    pairs = numbers.join(packed, ["dim", "block"]).join(index, ["dim", "shard"])

    def search(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                get = lambda c: one.column(one.schema.get_field_index(c))[0]
                ids = np.frombuffer(get("ids").as_py(), np.int64)
                x = np.frombuffer(get("x").as_py(), np.float64).reshape(len(ids), -1)
                g = Graph(x.astype(np.float32), np.frombuffer(get("levels").as_py(), np.int8).astype(np.int64),
                          [np.frombuffer(f, np.int32) for f in get("flat").as_py()])
                asked = get("q").values
                own = asked.field("id").to_numpy().astype(np.int64)
                q = _matrix(asked.field("v"))
                for at in range(0, len(q), STEP):
                    who, found, near = _nearest_of_shard(g, x, ids, q[at : at + STEP], own[at : at + STEP], k, beam)
                    yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(found), pa.array(near)],
                                                     names=["query_id", "vec_id", "near"])

    # one row at a time holds a graph: small batches keep a task's memory at a few shards
    found = pairs.select("q", "ids", "x", "levels", "flat").mapInArrow(
        search, "query_id long, vec_id long, near double")
    # the best of all shards; those that cannot be among them go before the shuffle
    by_near = Window.partitionBy("query_id").orderBy(F.desc(F.round("near", 12)), "vec_id")
    short = (found.withColumn("place", F.row_number().over(by_near)).where(F.col("place") <= 4 * k)
             .select("query_id", F.col("vec_id").alias("rep")))
    q = queries.select(F.col("id").alias("query_id"), F.col("v").alias("qv"))
    c = twins.select("rep", F.col("id").alias("vec_id"), F.col("v").alias("cv"))

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, e: s + e)

    exact = (short.join(c, "rep").where("vec_id != query_id").join(q, "query_id")
             .withColumn("score", dot("qv", "cv") / (F.sqrt(dot("qv", "qv")) * F.sqrt(dot("cv", "cv")))))
    ranked = exact.groupBy("query_id").agg(
        F.slice(F.array_sort(F.collect_set(F.struct((-F.col("score")).alias("far"), "vec_id"))), 1, k).alias("n"))
    return ranked.select("query_id", F.posexplode("n").alias("at", "n")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "n.vec_id", (-F.col("n.far")).alias("score"))


def nearest_neighbours(df: DataFrame, is_query, *, k: int = 5, id_col: str = "vec_id",
                       vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest of every row for which ``is_query`` holds, over all rows.

    Vectors that are null, empty, zero or hold null or non-finite components
    take no part, nor do rows without an id; vectors of another length than
    a query's are no candidates for it; of rows that repeat an id, the largest
    vector takes part; other columns are ignored; an empty table gives no rows.
    """
    vectors = usable(df, id_col, vector_col).groupBy("id").agg(F.max("v").alias("v"))
    vectors = keep_table(vectors, "ann-vectors")
    twins = keep_table(first_twins(vectors, k + 1), "ann-twins")
    return nearest(build_index(twins.where("id = rep")), vectors.where(is_query), twins, k)


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every vector whose id is divisible by 50."""
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
