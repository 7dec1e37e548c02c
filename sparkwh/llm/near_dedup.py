"""Near-duplicate groups by fast similarity sketching, banding and exact verification.

1. Every text becomes its set of word shingles and a sketch: in round i every shingle falls into a hashed bin with the value
   i + hash; bins keep their smallest value. Once all bins are full nothing can change; rounds from the sketch size on put
   every shingle into bin i minus that size, so that no bin stays empty. Two sketches agree in a coordinate with the
   probability of their Jaccard similarity, and the number of agreements is concentrated as for independent ones.
2. Texts with equal sets are one class. Bands of coordinates bring similar classes together; inside a bucket, classes whose
   sketches agree well enough hang together. A large bucket is cut into parts, each with the bucket's smallest class; where
   that class does not reach all others, the whole bucket is spread over finer ones by further coordinates, so classes that
   share some boilerplate do not end up in one group. The connected groups are only tentative.
3. Every tentative group is cut into blocks of bounded size, the texts of its classes are read again, and all links are
   decided on the full sets. Within a block, classes that already hang together are not compared again. If a group
   has more than one block, every class outside the group's largest component is compared with the blocks that hold a class
   of one of its buckets, so no link between classes that share a bucket is missed.

Only ids, keys and sketches are shuffled for all classes; texts only for classes in a tentative group. Nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import stage
from .batches import grouped, mix, shingle_sets, signed, slices, text_bytes, tidy, verified_words, words
from .components import connected


@dataclass(frozen=True)
class NearParameters:
    """``shingle`` words per shingle; links need ``percent`` * union <= 100 * intersection.

    With 32 bands of 5 a pair at similarity 0.8 shares no bucket once in 300,000 cases. ``floor`` is the sketch similarity
    from which two classes of a bucket are grouped tentatively; at 160 coordinates it is over five standard deviations below
    0.8. ``bucket_rows`` and ``block_shingles`` bound what a task holds at a time. A bucket that needs finer ones gives
    every class ``finer`` of them, by ``finer_rows`` more coordinates each: of pairs at 0.8 all of whose buckets are of that
    kind, one in 200,000 shares none.
    """
    shingle: int = 2
    percent: int = 80
    bands: int = 32
    rows: int = 5
    floor: float = 0.62
    bucket_rows: int = 2_000
    block_shingles: int = 2_000_000
    finer: int = 12
    finer_rows: int = 4
    delegates: int = 16
    salts: int = 64

    @property
    def size(self) -> int:
        return self.bands * self.rows


def sketches(h: np.ndarray, row: np.ndarray, n_rows: int, size: int) -> np.ndarray:
    """Fast similarity sketches of the sets (``row``, ``h``): round and value of the smallest entry of every bin."""
    out = np.full((n_rows, size), np.iinfo(np.uint64).max, np.uint64)
    flat = out.ravel()
    for i in range(2 * size):
        if not len(h):
            break
        g = mix(h + np.uint64(0x9E3779B97F4A7C15 * (i + 1) & (1 << 64) - 1))
        value = (g >> np.uint64(32)) | np.uint64(i << 32)
        if i < size:
            bin_ = ((g & np.uint64(0xFFFFFFFF)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        else:
            bin_ = np.full(len(h), i - size)
        np.minimum.at(flat, row * size + bin_, value)
        full = out.max(1) != np.iinfo(np.uint64).max
        open_ = ~full[row]
        h, row = h[open_], row[open_]
    return out


def _sketched(p: NearParameters):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            data, offsets = text_bytes(batch.column(1))
            for i, j in slices(offsets):
                part, at = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                n = j - i
                h, row, count = shingle_sets(*words(part, at), p.shingle, n)
                coordinates = sketches(h, row, n, p.size)
                key = np.zeros((n, p.bands), np.uint64) + np.arange(1, p.bands + 1, dtype=np.uint64)
                for r in range(p.rows):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + coordinates[:, r::p.rows][:, :p.bands])
                sums = [np.zeros(n, np.uint64) for _ in range(2)]
                for k, total in enumerate(sums):
                    np.add.at(total, row, mix(h + np.uint64(k + 1)))
                small = (mix(coordinates) & np.uint64(255)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(i, n), pa.array(count.astype(np.int64)), pa.array(signed(sums[0])), pa.array(signed(sums[1])),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, n * p.bands + 1, p.bands, dtype=np.int32)),
                                             pa.array(signed(key).ravel())),
                    pa.array([s.tobytes() for s in small], pa.binary())], names=["doc_id", "n", "set_a", "set_b", "keys", "sketch"])
    return run


def _bucket_edges(p: NearParameters, last: bool):
    """Tentative edges (a, b) inside every (key, part) group of (key, part, rep, cut, sketch), in the order of ``rep``.

    If the bucket is ``cut``, its smallest class, the anchor, is in every part. A part that has classes which the anchor does
    not reach gives the key as well or, the ``last`` time, hangs them on the anchor unchecked.
    """
    least = p.size * (p.floor + (1 - p.floor) / 256)

    def run(batches):
        a, b, open_ = [], [], []
        for group in grouped(batches, 2):
            n, key, cut = group.num_rows, group.column(0)[0].as_py(), group.column(3)[0].as_py()
            reps = group.column(2).to_numpy()
            data, offsets = text_bytes(group.column(4))
            s = data.reshape(n, p.size)
            left = np.arange(n)
            while len(left) > (not cut):
                first, left = left[0], left[1:]
                if cut and first > 0:
                    if last:
                        a.append(reps[[first]])
                        b.append(reps[[0]])
                    elif not open_ or open_[-1] != key:
                        open_.append(key)
                queue = [first]
                while queue and len(left):
                    u = queue.pop()
                    near = (s[left] == s[u]).sum(1) >= least
                    found, left = left[near], left[~near]
                    a.append(reps[found])
                    b.append(np.full(len(found), reps[u]))
                    queue += found.tolist()
            if len(a) > 2_000:
                yield _edges(a, b, open_)
                a, b, open_ = [], [], []
        yield _edges(a, b, open_)
    return run


def _edges(a: list[np.ndarray], b: list[np.ndarray], keys: list[int] | None = None) -> pa.RecordBatch:
    """Edges (a, b); if there are ``keys``, a third column has them, in rows of their own."""
    join = lambda x: np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64)
    a, b = join(a), join(b)
    if keys is None:
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
    edge, none = pa.nulls(len(a), pa.int64()), pa.nulls(len(keys), pa.int64())
    columns = [(pa.array(a), none), (pa.array(b), none), (edge, pa.array(keys, pa.int64()))]
    return pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in columns], names=["a", "b", "key"])


def _tentative(keyed: DataFrame, sketched: DataFrame, p: NearParameters, last: bool) -> DataFrame:
    """``a, b, key``: what ``_bucket_edges`` gives for the buckets of ``keyed`` (``rep``, ``key``)."""
    shared = (keyed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / p.bucket_rows).cast("int").alias("parts"),
                                       F.count(F.lit(1)).alias("rows"), F.min("rep").alias("anchor")).where("rows > 1"))
    own = F.array(F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    part = F.when(F.col("rep") == F.col("anchor"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(own)
    buckets = (keyed.join(shared, "key").select("key", F.explode(part).alias("part"), "rep", (F.col("parts") > 1).alias("cut"))
               .join(sketched, "rep").select("key", "part", "rep", "cut", "sketch"))
    return (buckets.repartition("key", "part").sortWithinPartitions("key", "part", "rep")
            .mapInArrow(tidy(_bucket_edges(p, last)), "a long, b long, key long"))


def _finer(keyed: DataFrame, open_: DataFrame, sketched: DataFrame, p: NearParameters) -> DataFrame:
    """``rep, key``: the finer buckets of the classes of ``keyed`` (``rep``, ``band``, ``key``) in ``open_`` ones (``key``)."""
    def coordinate(t: int):
        """Coordinate of the ``t``-th step through those outside the band."""
        return F.substring("sketch", (F.col("band") * p.rows + p.rows + 13 * t % (p.size - p.rows)) % p.size + 1, F.lit(1))

    keys = [F.xxhash64("key", F.lit(j), *[coordinate(j * p.finer_rows + r) for r in range(p.finer_rows)]) for j in range(p.finer)]
    return keyed.join(open_, "key").join(sketched, "rep").select("rep", F.explode(F.array(*keys)).alias("key"))


class _Sets:
    """The shingle sets of a group of texts, and a postings index over those not yet placed. Words with equal fingerprints
    are known to be equal here: all words of the group have been compared byte by byte."""

    def __init__(self, texts, shingle: int):
        data, offsets = text_bytes(texts)
        n = len(offsets) - 1
        h, self.row, _ = shingle_sets(*verified_words(data, offsets), shingle, n)
        distinct, self.id = np.unique(h, return_inverse=True)
        self.n_ids, self.size = len(distinct), np.bincount(self.row, minlength=n)
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        self.index(np.ones(n, bool))

    def index(self, include: np.ndarray) -> None:
        use = include[self.row]
        ids, rows = self.id[use], self.row[use]
        order = np.argsort(ids, kind="stable")
        self.posting = rows[order]
        self.from_ = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=self.n_ids))])

    def overlaps(self, u: int) -> np.ndarray:
        """Shared shingles of row ``u`` with every indexed row."""
        ids = self.id[self.start[u]:self.start[u + 1]]
        a, size = self.from_[ids], self.from_[ids + 1] - self.from_[ids]
        done = np.cumsum(size) - size
        at = np.repeat(a - done, size) + np.arange(size.sum())
        return np.bincount(self.posting[at], minlength=len(self.size))

    def linked(self, u: int, percent: int) -> np.ndarray:
        both = self.overlaps(u)
        return (both > 0) & (100 * both >= percent * (self.size + self.size[u] - both))


def link_all(sets: _Sets, percent: int) -> np.ndarray:
    """For every row the smallest row of its component under exact links."""
    n = len(sets.size)
    root, left, indexed, remaining = np.arange(n), np.ones(n, bool), n, n
    for first in range(n):
        if not left[first]:
            continue
        left[first] = False
        remaining -= 1
        queue = [first]
        while queue and remaining:
            found = np.flatnonzero(sets.linked(queue.pop(), percent) & left)
            left[found], root[found] = False, first
            queue += found.tolist()
            remaining -= len(found)
            if remaining < indexed // 2:
                sets.index(left)
                indexed = remaining
    return root


def _block_links(p: NearParameters):
    """Exact components of every (cluster, block) of (cluster, block, rep, text): rep, root."""
    def run(batches):
        a, b = [], []
        for group in grouped(batches, 2):
            reps = group.column(2).to_numpy()
            reps, first = np.unique(reps, return_index=True)
            if len(reps) > 1:
                texts = group.column(3).combine_chunks()
                texts = texts if len(first) == group.num_rows and (np.diff(first) > 0).all() else texts.take(pa.array(first))
                root = link_all(_Sets(texts, p.shingle), p.percent)
                a.append(reps)
                b.append(reps[root])
            else:
                a.append(reps)
                b.append(reps)
            if len(a) > 2_000:
                yield _edges(a, b)
                a, b = [], []
        yield _edges(a, b)
    return run


def _cross_links(p: NearParameters):
    """Exact links between the queries and the members of every (cluster, block, task): one per pair of components."""
    def run(batches):
        for group in grouped(batches, 3):
            role, root = (group.column(k).to_numpy() for k in (3, 5))
            sets = _Sets(group.column(6).combine_chunks(), p.shingle)
            member = role == 0
            sets.index(member)
            a, b = [], []
            for u in np.flatnonzero(~member):
                met = np.unique(root[sets.linked(u, p.percent) & member])
                met = met[met != root[u]]
                a.append(np.full(len(met), root[u]))
                b.append(met)
            yield _edges(a, b)
    return run


def _exact_components(docs: DataFrame, clusters: DataFrame, keyed: DataFrame, p: NearParameters) -> DataFrame:
    """``rep``, ``root`` for the classes of ``clusters`` (``rep``, ``cluster``, ``n``) with the buckets ``keyed`` (``rep``, ``key``)."""
    per = clusters.groupBy("cluster").agg(F.ceil(F.sum("n") / p.block_shingles).cast("int").alias("blocks"))
    placed = stage(clusters.join(per, "cluster").withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")), "blocks")
    texts = docs.select(F.col("doc_id").alias("rep"), "text")
    inside = placed.join(texts, "rep").select("cluster", "block", "rep", "text")
    edges = stage(inside.repartition("cluster", "block").sortWithinPartitions("cluster", "block", "rep")
                  .mapInArrow(tidy(_block_links(p)), "a long, b long"), "links").toDF("rep", "root")
    large = placed.where("blocks > 1")
    if large.isEmpty():
        return edges
    large = stage(large.join(edges, "rep").join(texts, "rep"), "large")

    def cross(queries: DataFrame, met: DataFrame, roots: DataFrame) -> DataFrame:
        """Links of the queries with all members of the blocks that they meet: ``met`` has ``rep``, ``block``.

        The queries of a block are dealt over tasks, each of which has all members of it. Blocks that none meets are left out.
        """
        asked = queries.drop("block").join(met, "rep")
        tasks = asked.groupBy("cluster", "block").agg(F.ceil(F.sum("n") / p.block_shingles).cast("int").alias("tasks"))
        asked = asked.join(tasks, ["cluster", "block"]).withColumn("task", F.pmod(F.xxhash64("rep"), F.col("tasks")).cast("int"))
        there = roots.join(tasks, ["cluster", "block"]).withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)))
        rows = lambda df, role: df.select("cluster", "block", "task", F.lit(role).alias("role"), "rep", "root", "text")
        return (rows(asked, 1).unionByName(rows(there, 0)).repartition("cluster", "block", "task")
                .sortWithinPartitions("cluster", "block", "task", "role").mapInArrow(tidy(_cross_links(p)), "a long, b long"))

    # Some members of the largest component of every block meet all blocks; this joins the parts of a large component.
    sizes = large.groupBy("cluster", "block", "root").count()
    rank = Window.partitionBy("cluster", "block").orderBy(F.desc("count"), "root")
    main = sizes.withColumn("place", F.row_number().over(rank)).where("place = 1").select("cluster", "block", "root")
    some = Window.partitionBy("cluster", "block").orderBy(F.xxhash64("rep"))
    delegates = (large.join(main, ["cluster", "block", "root"]).select("rep", "cluster", "block")
                 .withColumn("place", F.row_number().over(some)).where(F.col("place") <= p.delegates).select("rep"))
    delegates = stage(large.join(delegates, "rep", "left_semi"), "delegates")
    every = (delegates.select("rep", F.col("block").alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
             .where("block <> own").drop("own"))
    own = large.select(F.col("rep").alias("a"), F.col("root").alias("b"))
    first = connected(own.unionByName(cross(delegates, every, large)))
    # Then everything outside the largest component of its group meets the blocks that hold a class of one of its buckets.
    now = stage(large.drop("root").join(first.toDF("rep", "root"), "rep"), "large")
    sizes = now.groupBy("cluster", "root").count()
    rank = Window.partitionBy("cluster").orderBy(F.desc("count"), "root")
    main = sizes.withColumn("place", F.row_number().over(rank)).where("place = 1").select("cluster", "root")
    outside = stage(now.join(main, ["cluster", "root"], "left_anti"), "outside")
    at = stage(keyed.join(now.select("rep", "cluster", "block"), "rep").groupBy("cluster", "key")
               .agg(F.collect_set("block").alias("blocks")).where(F.size("blocks") > 1), "at")
    met = (keyed.join(outside.select("rep", "cluster", F.col("block").alias("own")), "rep").join(at, ["cluster", "key"])
           .select("rep", "own", F.explode("blocks").alias("block")).where("block <> own").select("rep", "block").distinct())
    second = connected(now.select(F.col("rep").alias("a"), F.col("root").alias("b")).unionByName(cross(outside, met, now)))
    return edges.join(second.select(F.col("node").alias("rep")), "rep", "left_anti").unionByName(second.toDF("rep", "root"))


def near_groups(docs: DataFrame, p: NearParameters = NearParameters()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, class_id`` per row of ``docs`` (``doc_id``, ``text``; others are ignored).

    ``component_id`` is the smallest ``doc_id`` reachable over links, ``kept`` marks the row that has it, ``class_id`` is the
    smallest ``doc_id`` with the same shingle set. A NULL text, and one without words, has no shingles, is linked with
    nothing and kept. A row with NULL ``doc_id`` is never linked: its component is NULL and it is not kept. Repeated rows
    get equal rows. An empty table gives none.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    base = stage(rows.mapInArrow(tidy(_sketched(p)), "doc_id long, n long, set_a long, set_b long, keys array<long>, sketch binary"), "sketches")
    own_set = ["n", "set_a", "set_b"]
    # A set that a third of all documents share is dealt over many tasks by a salt, here and when results go back.
    base = base.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(p.salts)))
    usable = base.where("n > 0 and doc_id is not null")
    salted = stage(usable.groupBy(*own_set, "salt").agg(F.min("doc_id").alias("least")), "salted")
    class_of = salted.groupBy(*own_set).agg(F.min("least").alias("rep"))
    # The representative has its own keys and sketch; repeated rows of it are equal, so any one will do.
    reps = stage(class_of.select("rep", *own_set).join(
        usable.select(F.col("doc_id").alias("rep"), *own_set, "keys", "sketch"), ["rep", *own_set])
        .dropDuplicates(["rep", *own_set]).select("rep", "n", "keys", "sketch"), "classes")
    keyed, sketched = reps.select("rep", F.posexplode("keys").alias("band", "key")), reps.select("rep", "sketch")
    edges = stage(_tentative(keyed, sketched, p, False).distinct(), "tentative")
    open_ = edges.where("key is not null").select("key").distinct()
    keys, edges = keyed.select("rep", "key"), edges.where("key is null").select("a", "b")
    if not open_.isEmpty():
        finer = stage(_finer(keyed, open_, sketched, p), "finer")
        edges = edges.unionByName(_tentative(finer, sketched, p, True).select("a", "b")).distinct()
        keys = keys.join(open_, "key", "left_anti").select("rep", "key").unionByName(finer)
    clusters = stage(connected(edges).toDF("rep", "cluster").join(reps.select("rep", "n"), "rep"), "clusters")
    exact = _exact_components(rows.join(clusters.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi"), clusters, keys, p)
    component = class_of.join(exact, "rep", "left").select(
        *own_set, F.col("rep").alias("class_id"), F.coalesce("root", "rep").alias("component_id"))
    by_salt = salted.select(*own_set, "salt").join(component, own_set)
    linked = (base.where("n > 0").select("doc_id", *own_set, "salt").join(by_salt, [*own_set, "salt"], "left")
              .select("doc_id", "n", "component_id", "class_id"))
    alone = base.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"))
    none = F.col("doc_id").isNull()
    return linked.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(~none, F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
        F.when(~none, F.col("class_id")).alias("class_id"))
