"""Near duplicates by DartMinHash signatures, banded joins and verification.

Sketch.  Each element (a word shingle, or anything hashed to 64 bits) with
weight w owns the strip [0, w) of a plane whose other axis is rank.  Darts
fall on the plane by a Poisson process that depends on the element alone:
the plane is cut into fixed cells, by weight at 1, 2, 4, ... and by rank at
2**-6, 2**-5, ..., and the number, places and coordinates of the darts of a
cell come from a hash of (element, cell).  A set keeps, for each of the k
coordinates, the dart of least rank among those inside its elements' strips.
Two sets keep the same dart with a probability equal to their weighted
Jaccard similarity.  About k ln k + 2k darts fill all coordinates, however
many elements there are; a set throws rank cells from the bottom until no
coordinate is empty, so the cost is its elements plus its darts.

Join.  k = ``BANDS`` x ``ROWS`` coordinates are hashed in bands.  Texts with
the same shingle set are one node.  In a bucket (nodes that agree in a band)
every node is first paired with one centre, not with every other: the node of
least priority, the same order in all buckets, so that similar nodes share
their centres.  Pairs are verified on the shingle sets themselves and links
become components.  In buckets that still hold several components every pair of
nodes of different components is tested then, without a row per pair: nodes go
to blocks (by the centre of least priority among those of their buckets, which
a whole family shares but for a few; ``BLOCK`` nodes or ``ELEMENTS`` elements
at most on average), the sets of two blocks that share a bucket meet in one
group, and the overlaps of all their pairs are counted at once by matrix
products.  A block of one component only does not meet blocks of the same.  A
group gives a forest of the components it joins.  So a node is sent once per
block that its own block shares a bucket with, and no pair is left out.

A band misses a pair of similarity 0.8 with probability 1 - 0.8**ROWS; all
bands miss it with probability 3e-6 at the default 32 x 5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import keep_table, map_texts, read_table, text_or_empty

BANDS, ROWS = 32, 5
BLOCK, ELEMENTS = 512, 1 << 18  # nodes and elements of a block
WORDS, SIMILARITY = 5, 0.8
SALT = 8  # tasks that rows with the same key are dealt to
_BASE = 6  # the lowest rank cell is [0, 2**-_BASE)
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def _poisson(u: np.ndarray, area: float) -> np.ndarray:
    """Poisson counts with mean ``area`` from uniform numbers."""
    top = int(area + 12 * area**0.5 + 20)
    p = np.exp(-area + np.concatenate([[0.0], np.cumsum(np.log(area / np.arange(1, top)))]))
    return np.searchsorted(np.cumsum(p), u, side="right")


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> _U(11)).astype(np.float64) * 2.0**-53


def dart_minhash(elements: np.ndarray, weights: np.ndarray, sets: np.ndarray, n_sets: int, k: int) -> np.ndarray:
    """Signatures (n_sets, k) as uint64; ``sets`` says whose each element is.
    Sets without positive weight keep all ones."""
    empty = _U(0xFFFFFFFFFFFFFFFF)
    rank = np.full(n_sets * k, empty)  # least rank (high bits), then the dart's hash
    alive = np.bincount(sets[weights > 0], minlength=n_sets) > 0
    cell = 0
    with np.errstate(over="ignore"):
        while True:
            live = alive[sets] & (weights > 0)
            if not live.any():
                break
            e, w, s = elements[live], weights[live], sets[live]
            low, high = (0.0, 2.0**-_BASE) if cell == 0 else (2.0 ** (cell - 1 - _BASE), 2.0 ** (cell - _BASE))
            tall = 0
            while len(e):
                bottom, top = (0.0, 1.0) if tall == 0 else (2.0 ** (tall - 1), 2.0**tall)
                area = (top - bottom) * (high - low)
                seed = mix(e + _U((cell * 64 + tall + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
                count = _poisson(_unit(seed), area)
                hit = np.flatnonzero(count)
                n = count[hit]
                which = np.repeat(hit, n)
                nth = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
                dart = mix(seed[which] + (nth.astype(np.uint64) + _U(1)) * _U(0xD1342543DE82EF95))
                height = bottom + (top - bottom) * _unit(mix(dart ^ _U(0xA0761D6478BD642F)))
                inside = height < w[which]
                which, dart = which[inside], dart[inside]
                at = mix(dart ^ _U(0xE7037ED1A0B428DB))
                r = low + (high - low) * _unit(mix(dart ^ _U(0x8EBC6AF09C88C6E3)))
                # ranks grow with the cells: 40 bits of a monotone code, 24 bits that tell darts apart
                code = (r.astype(np.float32).view(np.uint32).astype(np.uint64) << _U(32)) | (dart >> _U(32))
                np.minimum.at(rank, s[which] * k + (at % _U(k)).astype(np.int64), code)
                more = w > top
                e, w, s = e[more], w[more], s[more]
                tall += 1
            alive &= (rank.reshape(n_sets, k) == empty).any(1)
            cell += 1
    return rank.reshape(n_sets, k)


class _Words(dict):
    """64-bit hashes of words; bounded."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return got


def shingles(text: str, words: int, table: _Words) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` lower-cased words; a
    text with fewer words is one run; a text without words has none."""
    parts = text.lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    h = np.array([table[w] for w in parts], np.uint64)
    n = max(len(h) - words + 1, 1)
    with np.errstate(over="ignore"):
        roll = np.full(n, min(len(h), words), np.uint64)
        for j in range(min(words, len(h))):
            roll = mix(roll * _U(0x9E3779B97F4A7C15) + h[j : j + n])
    return np.unique(roll)


def sketch(df: DataFrame, *, text_col: str = "text", words: int = WORDS, bands: int = BANDS,
           rows: int = ROWS) -> DataFrame:
    """``id``, ``key`` and ``text_col`` to ``id``, ``key``, ``node`` (128-bit hash of
    the shingle set; null without words) and ``bands`` (a hash per band)."""
    def work():
        table = _Words()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingles(t, words, table) for t in batch.column(1).to_pylist()]
            flat = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            sig = dart_minhash(flat, np.ones(len(flat)), owner, len(sets), bands * rows).reshape(-1, bands, rows)
            with np.errstate(over="ignore"):
                key = np.broadcast_to(np.arange(bands, dtype=np.uint64), sig.shape[:2])
                for j in range(rows):
                    key = mix(key * _U(0x9E3779B97F4A7C15) + sig[:, :, j])
            node = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands),
                                             pa.array(key.reshape(-1).view(np.int64)))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(node, pa.binary()), lists],
                names=["id", "key", "node", "bands"])
        return run

    return map_texts(df.select("id", text_col, "key"), "id long, key binary, node binary, bands array<long>", work)


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """``node``, ``text`` to ``node``, ``elements`` (sorted shingle hashes)."""
    def work():
        table = _Words()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingles(t, words, table).view(np.int64) for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))
            return pa.RecordBatch.from_arrays([batch.column(0), lists], names=["node", "elements"])
        return run

    return map_texts(texts, "node binary, elements array<long>", work)


def _pairs(of: DataFrame) -> DataFrame:
    """``node``, ``centre`` to distinct pairs ``a`` < ``b``."""
    return of.where("node != centre").select(
        F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sets have that Jaccard similarity."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("elements").alias("ea")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("elements").alias("eb")), "b")
            .select("a", "b", F.size("ea").alias("na"), F.size("eb").alias("nb"),
                    F.size(F.array_intersect("ea", "eb")).alias("both")))
    return both.where(F.col("both") >= similarity * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def _lookup(rows: DataFrame, key: str, table: DataFrame, spread: list[str], how: str) -> DataFrame:
    """``rows`` joined to ``table`` (one row a key, in its column ``at``) on
    ``key``, which many rows may share: they meet in ``SALT`` tasks, dealt by
    the columns ``spread``, and so do as many copies of the table's rows.  The
    small joins of many rounds are merged, not broadcast: a broadcast table takes
    a whole memory page of every executor until the driver's next clean-up."""
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64(*spread), F.lit(SALT)))
    copies = table.withColumn("copy", F.explode(F.array(*map(F.lit, range(SALT)))))
    copies = copies.hint("merge")
    return dealt.join(copies, (dealt[key] == copies["at"]) & (dealt["salt"] == copies["copy"]), how).drop("salt", "copy", "at")


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (least node of its component) from ``a``, ``b``.

    Rounds of hooking every node to the least root among its neighbours and
    then to its root's root; each round is written to the shared folder.
    Neither a node with many links nor a root of many nodes meets in one task."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = keep_table(both, "links")
    at = keep_table(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")),
                    "roots")
    while True:
        # the least root next door, for the node itself and for its root
        next_door = _lookup(both, "b", at.select(F.col("node").alias("at"), "root"), ["a"], "inner")
        # a node's own root meets those next door in the same sum, not in a join of its own
        own = at.select("node", "root", F.col("root").alias("near"))
        near = (next_door.select(F.col("a").alias("node"), F.lit(None).cast("binary").alias("root"), F.col("root").alias("near"))
                .union(own).groupBy("node").agg(F.max("root").alias("root"), F.min("near").alias("near")))
        hook = near.groupBy(F.col("root").alias("at")).agg(F.min("near").alias("to"))
        step = _lookup(near, "root", hook, ["node"], "left").select(
            "node", F.col("root").alias("was"), F.least("near", F.coalesce("to", "near")).alias("root"))
        # whoever is a root now was one before
        up = step.join(hook.select("at").hint("merge"), step.node == F.col("at")).select("at", F.col("root").alias("up"))
        done = keep_table(_lookup(step, "root", up, ["node"], "left").select(
            "node", "was", F.least("root", F.coalesce("up", "root")).alias("root")), "roots")
        if done.where(F.col("was") != F.col("root")).isEmpty():
            return done.select("node", "root")
        at = done.select("node", "root")


def _mixed(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``bucket``, ``centre``, ``node``, ``root``: the buckets that hold several
    components; of buckets with the same nodes, one."""
    if roots is None:
        members = members.withColumn("root", F.col("node"))
    else:
        members = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = members.groupBy("bucket").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y"),
    ).where("lo != hi")
    mixed = mixed.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket")
    return members.join(mixed, "bucket").select("bucket", "centre", "node", "root")


def _blocks(mixed: DataFrame, sizes: DataFrame) -> DataFrame:
    """``node``, ``root``, ``block``, ``only`` (the component, if a block has just one) and
    the node's ``buckets`` (one a band at most)."""
    # the centres of a family's buckets are few: those of its members that come first
    first = F.min(F.struct(F.xxhash64("centre").alias("p"), "centre"))["centre"]
    home = mixed.groupBy("node", "root").agg(first.alias("home"), F.collect_list("bucket").alias("buckets")).join(sizes, "node")
    cells = home.groupBy("home", "root").agg(F.count("*").alias("nodes"), F.sum("size").alias("elements"))
    cells = cells.withColumn("only", F.when(F.col("nodes") >= BLOCK, F.col("root")))
    # large components have their own blocks, the others of a bucket share theirs
    parts = cells.groupBy("home", "only").agg(F.greatest(
        F.ceil(F.sum("nodes") / BLOCK), F.ceil(F.sum("elements") / ELEMENTS)).alias("parts"))
    cells = cells.select("home", "root", "only").join(
        parts.withColumnsRenamed({"home": "h", "only": "o"}),
        (F.col("home") == F.col("h")) & F.col("only").eqNullSafe(F.col("o"))).select("home", "root", "only", "parts")
    return home.join(cells, ["home", "root"]).select(
        "node", "root", "only", "buckets", F.xxhash64("home", "only", F.pmod(F.xxhash64(F.lit(2), "node"), "parts")).alias("block"))


def _group_links(x: np.ndarray, y: np.ndarray, root: np.ndarray, sizes: np.ndarray, flat: np.ndarray,
                 similarity: float) -> list[tuple[int, int]]:
    """A forest of the ``root`` pairs that links between the sets marked in
    ``x`` and those marked in ``y`` join; ``flat`` holds the sets one after the other."""
    def open_pairs(left, right):
        na, nb = sizes[left][:, None], sizes[right][None, :]
        return (root[left][:, None] != root[right][None, :]) & (np.minimum(na, nb) >= similarity * np.maximum(na, nb))

    left, right = np.flatnonzero(x), np.flatnonzero(y)
    test = open_pairs(left, right)
    left, right, test = left[test.any(1)], right[test.any(0)], test[test.any(1)][:, test.any(0)]
    if not test.any():
        return []
    owner = np.repeat(np.arange(len(sizes)), sizes)
    used = np.zeros(len(sizes), bool)
    used[left] = used[right] = True
    flat, owner = flat[used[owner]], owner[used[owner]]
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    start = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    count = np.diff(np.r_[start, len(flat)])
    # elements of the same sets are one column, with their number as its weight
    name = mix(np.arange(1, len(sizes) + 1, dtype=np.uint64))
    with np.errstate(over="ignore"):
        pattern = np.add.reduceat(name[owner], start)
    start, count, pattern = start[count > 1], count[count > 1], pattern[count > 1]
    _, first, weight = np.unique(pattern, return_index=True, return_counts=True)
    kind = np.float32 if sizes.max() < 1 << 24 else np.float64  # whole numbers are exact
    both = np.zeros(test.shape, kind)
    for at in range(0, len(first), 2048):
        f = first[at : at + 2048]
        n = count[f]
        column = np.repeat(np.arange(len(f)), n)
        place = np.repeat(start[f], n) + np.arange(len(column)) - np.repeat(np.cumsum(n) - n, n)
        has = np.zeros((len(sizes), len(f)), kind)
        has[owner[place], column] = 1
        both += (has[left] * weight[at : at + 2048].astype(kind)) @ has[right].T
    both = both.astype(np.float64)
    link = test & (both >= similarity * (sizes[left][:, None] + sizes[right][None, :] - both))
    i, j = np.nonzero(link)
    a, b = root[left[i]], root[right[j]]
    up: dict[int, int] = {}

    def find(r):
        while up.get(r, r) != r:
            up[r] = r = up.get(up[r], up[r])
        return r

    out = []
    for r, t in np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0).tolist():
        if find(r) != find(t):
            up[find(t)] = find(r)
            out.append((r, t))
    return out


def _remaining_links(mixed: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``a``, ``b``: components that similar nodes of a ``mixed`` bucket join."""
    blocks = keep_table(_blocks(mixed, sets.select("node", F.size("elements").alias("size"))), "blocks")
    # blocks that share a bucket meet, whole; one component's own blocks need not
    # a block's nodes share most of their buckets: those are gathered first, so no row is made per node and bucket
    present = blocks.groupBy("block", "only").agg(F.array_distinct(F.flatten(F.collect_set("buckets"))).alias("buckets"))
    present = present.select(F.explode("buckets").alias("bucket"), "block", "only")
    other = present.select("bucket", F.col("block").alias("y"), F.col("only").alias("other"))
    pairs = present.join(other, "bucket").where(
        (F.col("block") <= F.col("y")) & (F.col("only").isNull() | F.col("other").isNull() | (F.col("only") != F.col("other"))))
    pairs = pairs.select(F.col("block").alias("x"), "y").distinct()
    sides = pairs.select("x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    met = blocks.drop("only", "buckets").join(sides, "block")
    groups = met.join(sets, "node").select("x", "y", "block", "root", "elements")

    def run(table: pa.Table) -> pa.Table:
        x, y, block = (table.column(c).to_numpy() for c in ("x", "y", "block"))
        names, root = np.unique(np.array(table.column("root").to_pylist(), object), return_inverse=True)
        elements = table.column("elements").combine_chunks()
        sizes = elements.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        found = _group_links(block == x, block == y, root, sizes, elements.flatten().to_numpy(), similarity)
        return pa.table({side: pa.array([names[f[k]] for f in found], pa.binary()) for k, side in enumerate("ab")})

    return groups.groupBy("x", "y").applyInArrow(run, "a binary, b binary").distinct()


def near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``df``: ``id_col``, ``class_id``, ``class_size``,
    ``kept`` and ``key`` (MD5 of the text).

    A class is a set of rows connected by links: texts whose sets of
    ``words``-word shingles (lower-cased, split at white space) have a Jaccard
    similarity of ``similarity`` or more.  ``class_id`` is the least
    identifier of the class (null ones aside) and ``kept`` marks the row that is
    least by identifier (nulls last), then by ``key``; of rows that repeat both, all.  A null text counts as empty; texts
    without words are alike only if they are the same text.  Other columns
    are ignored; an empty table gives no rows.
    """
    src = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col))
    src = src.withColumnRenamed(text_col, "text").withColumn("key", F.unhex(F.md5("text")))
    # one row stands for a node's text; with the id in it, copies do not meet in one task
    own = F.struct("key", F.coalesce("id", F.lit(-(1 << 63))).alias("id")).alias("rep")
    marked = keep_table(sketch(src, words=words, bands=bands, rows=rows), "sketch")
    # texts without words: their own text stands for the set, in the same 16 bytes
    marked = marked.withColumn("node", F.coalesce("node", "key"))
    nodes = keep_table(
        marked.where(F.col("node") != F.col("key")).groupBy("node").agg(F.min(own).alias("rep"), F.max("bands").alias("bands")),
        "nodes")
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    first = F.struct(F.xxhash64("node").alias("p"), "node")  # one order for all buckets
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.min(first)["node"].alias("centre")).where("n > 1")
    members = keep_table(buckets.join(shared.drop("n"), "bucket"), "buckets")
    pairs = keep_table(_pairs(members.select("node", "centre")), "pairs")
    # whoever shares a bucket is in a pair now: the sets of these nodes serve all rounds
    paired = members.select("node").distinct().join(nodes.select("node", "rep"), "node")
    texts = (src.select(own, "text").join(paired.hint("shuffle_hash"), "rep")
             .groupBy("node").agg(F.first("text").alias("text")))
    sets = keep_table(_sets(texts, words), "sets")
    found = keep_table(_similar(pairs, sets, similarity), "found")
    roots = None if found.isEmpty() else components(found)
    # what the centres did not join: every pair between components of a bucket
    mixed = keep_table(_mixed(members.select("bucket", "centre", "node"), roots), "mixed")
    found = keep_table(_remaining_links(mixed, sets, similarity), "found")
    if not found.isEmpty():
        merged = components(found)
        to = merged.select(F.col("node").alias("at"), F.col("root").alias("to"))
        if roots is None:
            roots = merged
        else:
            through = _lookup(roots, "root", to, ["node"], "left").select("node", F.coalesce("to", "root").alias("root"))
            roots = through.unionByName(merged.join(roots, "node", "left_anti"))
    placed = marked.select("id", "key", F.col("node").alias("root"))
    if roots is not None:
        at = roots.select(F.col("node").alias("at"), F.col("root").alias("to"))
        placed = _lookup(placed, "root", at, ["id", "key"], "left").select(
            "id", "key", F.coalesce("to", "root").alias("root"))
        placed = keep_table(placed, "placed")
    classes = placed.groupBy("root").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size"),
                                         F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first"))
    several = classes.where("class_size > 1").withColumn("r", F.col("root")).withColumnRenamed("root", "at")
    return _lookup(placed, "root", several, ["id", "key"], "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("r").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        F.when(F.col("r").isNull(), F.lit(True)).otherwise(
            F.col("id").eqNullSafe(F.col("first.id")) & (F.col("key") == F.col("first.key"))).alias("kept"),
        "key",
    )


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the class of its near duplicates."""
    return near_duplicates(read_table(spark, sf_dir, "documents")).drop("key")
