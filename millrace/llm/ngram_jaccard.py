"""Jaccard join of word shingles in the metric space of their sets, exact."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm._common import materialize, per_worker, power_of_two, small_batches
from millrace.llm._components import components
from millrace.llm._shingles import WordHashes, set_key, shingles

#: Cells of the frequency sketch, a fixed size whatever the input's.
SKETCH = 1 << 20
CHUNK = 1 << 14
#: Buckets of a set's histogram: at least, and shingles for each beyond that.
BUCKETS, PER_BUCKET = 64, 4
#: Documents, and shingles, that one task joins at most (one document may have more).
MAX_DOCS, MAX_SHINGLES = 4096, 4_000_000
#: In a task, regions up to this size are joined without new pivots.
LEAF, PIVOTS = 192, 8

Batches = Iterator[pa.RecordBatch]


class Threshold:
    """Links by 100 * intersection >= percent * union, in whole numbers."""

    def __init__(self, percent: int):
        if not 0 < percent <= 100:
            raise ValueError("percent is from 1 to 100")
        self.percent = percent
        self.epsilon = 1 - percent / 100

    def prefix(self, n: int) -> int:
        """Of n ordered shingles, how many must hold one that a linked set has in its own prefix."""
        return n - -(-self.percent * n // 100) + 1

    def links(self, both: np.ndarray, total: np.ndarray) -> np.ndarray:
        """both: intersection sizes; total: sums of the set sizes."""
        return 100 * both >= self.percent * (total - both)

    def may_link(self, differ: np.ndarray, total: np.ndarray) -> np.ndarray:
        """differ: a lower bound of the symmetric difference."""
        return (100 - self.percent) * total >= (100 + self.percent) * differ


class Union:
    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return int(i)

    def join(self, i: int, others: np.ndarray) -> None:
        r = self.find(i)
        for j in others:
            s = self.find(int(j))
            if s != r:
                low, r = max(r, s), min(r, s)
                self.root[low] = r
        self.root[i] = r

    def flat(self) -> np.ndarray:
        while True:
            up = self.root[self.root]
            if (up == self.root).all():
                return self.root
            self.root = up


def histogram(s: np.ndarray) -> bytes:
    """How many shingles fall into each bucket, at most 255; a power of two of buckets that grows
    with the set. The L1 distance of two histograms bounds the symmetric difference of the sets
    from below, also after fold()."""
    buckets = max(BUCKETS, power_of_two(-(-len(s) // PER_BUCKET)))
    return np.minimum(np.bincount((s & (buckets - 1)).astype(np.int64), minlength=buckets), 255).astype(np.uint8).tobytes()


def fold(hist: bytes, buckets: int) -> np.ndarray:
    """A histogram in fewer buckets."""
    h = np.frombuffer(hist, np.uint8)
    return h.reshape(-1, buckets).sum(0, dtype=np.int32)


def join_histograms(hist: list[bytes], n: np.ndarray, at_least: Threshold, done: np.ndarray) -> np.ndarray:
    """A root per document such that documents that may link share it; those marked done
    share one root already and are not compared with each other."""
    order = np.argsort(n, kind="stable")
    size = n[order]
    u = Union(len(n))
    if done.any():
        first = np.flatnonzero(done[order])
        u.join(int(first[0]), first[1:])
    ends = np.searchsorted(size, size * 100 // at_least.percent, "right")
    i = 0
    while i < len(n):
        # documents with as many buckets as this one, then all larger ones that they may link to
        buckets = len(hist[order[i]])
        stop = i + 1
        while stop < len(n) and len(hist[order[stop]]) == buckets and stop - i < MAX_DOCS:
            stop += 1
        h = np.stack([fold(hist[k], buckets) for k in order[i : max(stop, int(ends[stop - 1]))]])
        for a in range(i, stop):
            root = u.flat()
            b = a + 1 + np.flatnonzero(root[a + 1 : ends[a]] != root[a])
            if len(b):
                b = b[at_least.may_link(np.abs(h[b - i] - h[a - i]).sum(1), size[b] + size[a])]
                u.join(a, b)
        i = stop
    out = np.empty(len(n), np.int64)
    out[order] = order[u.flat()]
    return out


class Sets:
    """The sets of one task with an inverted index, which gives a set's overlaps with all others."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = np.array([len(s) for s in sets], np.int64)
        values = np.concatenate(sets)
        _, ids = np.unique(values, return_inverse=True)
        self.ids = np.split(ids, np.cumsum(self.n)[:-1])
        doc = np.repeat(np.arange(len(sets)), self.n)
        order = np.argsort(ids, kind="stable")
        self.docs = doc[order]
        self.bounds = np.append(0, np.cumsum(np.bincount(ids)))

    def overlaps(self, i: int) -> np.ndarray:
        low, n = self.bounds[self.ids[i]], self.bounds[self.ids[i] + 1] - self.bounds[self.ids[i]]
        take = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.bincount(self.docs[take], minlength=len(self.n))


def metric_join(sets: Sets, at_least: Threshold, done: np.ndarray) -> np.ndarray:
    """A root per document such that linked documents share it, and others don't unless a path
    of links joins them.

    Pivots make Voronoi regions: a document belongs to the region of its nearest pivot and is
    copied into each region whose pivot is at most 2 epsilon further away, so by the triangle
    inequality two linked documents meet in the region of either one. Documents within epsilon of a
    pivot link to it. Regions are joined in the same way again, until they are small or pivots
    hardly part them (the copies made are half of the documents or more); then every document
    is compared with those it has no path to yet.
    """
    u = Union(len(sets.n))
    first = np.flatnonzero(done)
    if len(first):
        u.join(int(first[0]), first[1:])

    def link(i: int) -> np.ndarray:
        both = sets.overlaps(i)
        total = sets.n + sets.n[i]
        u.join(i, np.flatnonzero(at_least.links(both, total)))
        return 1 - both / np.maximum(1, total - both)

    def region(members: np.ndarray) -> None:
        root = u.flat()[members]
        if len(members) < 2 or (root == root[0]).all():
            return
        if len(members) > LEAF:
            pivots = members[np.linspace(0, len(members) - 1, PIVOTS).astype(int)]
            far = np.stack([link(int(p))[members] for p in pivots])
            window = far <= far.min(0) + 2 * at_least.epsilon + 1e-9
            parts = [members[w] for w in window if w.any()]
            if sum(map(len, parts)) <= 1.5 * len(members) and max(map(len, parts)) < len(members):
                for part in parts:
                    region(part)
                return
        for i in members:
            root = u.flat()[members]
            if (root == root[0]).all():
                return
            link(int(i))

    region(np.arange(len(sets.n)))
    return u.flat()


def _groups(batches: Batches, key: list[str]) -> Iterator[dict[str, list]]:
    """The columns of each group of rows, which come sorted by key."""
    held: dict[str, list] = {}
    last = None
    for b in batches:
        cols = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)}
        keys = list(zip(*(cols[k] for k in key), strict=True))
        start = 0
        for i in range(1, len(keys) + 1):
            if i < len(keys) and keys[i] == keys[i - 1]:
                continue
            part = {n: c[start:i] for n, c in cols.items()}
            if held and last == keys[start]:
                for n, c in part.items():
                    held[n] += c
            else:
                if held:
                    yield held
                held = part
            last, start = keys[start], i
    if held:
        yield held


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _sketch(n: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        cache, total = per_worker(("words",), WordHashes), np.zeros(SKETCH, np.int64)
        for b in batches:
            cells = [shingles(x, n, cache) & (SKETCH - 1) for x in b.column("_text").to_pylist()]
            if cells:
                total += np.bincount(np.concatenate(cells), minlength=SKETCH)
        if total.any():
            for i in range(0, SKETCH, CHUNK):
                yield pa.RecordBatch.from_arrays([pa.array([i // CHUNK], pa.int32()), pa.array([total[i : i + CHUNK].tobytes()], pa.binary())], ["chunk", "counts"])

    return run


def _sum_chunks(batches: Batches) -> Batches:
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for c, x in zip(b.column("chunk").to_pylist(), b.column("counts").to_pylist(), strict=True):
            total[c] = total.get(c, 0) + np.frombuffer(x, np.int64)
    for c, x in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([x.tobytes()], pa.binary())], ["chunk", "counts"])


def frequency_classes(text: DataFrame, n: int) -> np.ndarray:
    """For each cell of the sketch, 0 or, well above what chance puts there, the log of its count.

    All shingles of all rows count. Tasks send one array each, summed in two levels.
    """
    schema = "chunk int, counts binary"
    parts = text.select("_text").mapInArrow(_sketch(n), schema)
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(16))
    parts = parts.repartition(64, "chunk", salt).mapInArrow(_sum_chunks, schema)
    rows = parts.repartition(16, "chunk").mapInArrow(_sum_chunks, schema).collect()  # SKETCH numbers at most
    counts = np.zeros(SKETCH, np.int64)
    for r in rows:
        counts[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] += np.frombuffer(r["counts"], np.int64)
    mean = np.median(counts)
    return np.where(counts > mean + 8 * np.sqrt(mean) + 8, np.log2(np.maximum(counts, 1)).astype(np.int64) + 1, 0).astype(np.uint8)


def _describe(n: int, at_least: Threshold, classes: Callable[[], np.ndarray]) -> Callable[[Batches], Batches]:
    """Per document: its set's key, size and histogram, and the rarest shingles as its cells."""

    def run(batches: Batches) -> Batches:
        cache, order = per_worker(("words",), WordHashes), classes()
        for b in batches:
            keys, sizes, hist, cells, cold = [], [], [], [], []
            for x in b.column("_text").to_pylist():
                s = shingles(x, n, cache)
                keys.append(set_key(s))
                sizes.append(len(s))
                hist.append(histogram(s))
                k = at_least.prefix(len(s)) if len(s) else 0
                rank = order[s & (SKETCH - 1)]
                cells.append(s[np.argsort(rank, kind="stable")[:k]] if rank.any() else s[:k])
                cold.append(min(k, int((rank == 0).sum())))
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(hist, pa.binary()), pa.array(cells, pa.list_(pa.int64())), pa.array(cold, pa.int32())],
                ["_id", "key", "n", "hist", "cells", "cold"],
            )

    return run


def _sets(n: int) -> Callable[[Batches], Batches]:
    """The set of each wanted text; a text that isn't the wanted one of its identifier goes."""

    def run(batches: Batches) -> Batches:
        cache = per_worker(("words",), WordHashes)
        for b in batches:
            s = [shingles(x, n, cache) for x in b.column("_text").to_pylist()]
            same = pa.array([set_key(x) == k for x, k in zip(s, b.column("key").to_pylist(), strict=True)], pa.bool_())
            items = pa.array([x.tobytes() for x in s], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("region"), b.column("key"), b.column("n"), items], ["region", "key", "n", "items"]).filter(same)

    return run


def _candidates(percent: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        at_least = Threshold(percent)
        pairs: list[tuple[int, int]] = []
        for g in _groups(batches, ["region", "task"]):
            root = join_histograms(g["hist"], np.array(g["n"], np.int64), at_least, np.array(g["near"], bool))
            pairs += [(g["key"][r], k) for r, k in zip(root.tolist(), g["key"], strict=True) if g["key"][r] != k]
            if len(pairs) > 50_000:
                yield _edges(pairs)
                pairs = []
        yield _edges(pairs)

    return run


def _verified(percent: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        at_least = Threshold(percent)
        pairs: list[tuple[int, int]] = []
        for g in _groups(batches, ["region", "task"]):
            sets = Sets([np.frombuffer(x, np.int64) for x in g["items"]])
            root = metric_join(sets, at_least, np.array(g["near"], bool))
            pairs += [(g["key"][r], k) for r, k in zip(root.tolist(), g["key"], strict=True) if g["key"][r] != k]
        yield _edges(pairs)

    return run


def _near(percent: int, exact: bool) -> Callable[[Batches], Batches]:
    """Whether each member of a large region (may) link to the region's pivot, and how far it is."""

    def run(batches: Batches) -> Batches:
        at_least = Threshold(percent)
        for b in batches:
            near, ring = [], []
            for x, p, n, m in zip(b.column("own").to_pylist(), b.column("pivot").to_pylist(), b.column("n").to_pylist(), b.column("pivot_n").to_pylist(), strict=True):
                if exact:
                    both = len(np.intersect1d(np.frombuffer(x, np.int64), np.frombuffer(p, np.int64), assume_unique=True))
                    near.append(bool(at_least.links(np.int64(both), np.int64(n + m))))
                    far = 1 - both / max(1, n + m - both)
                    ring.append(int(far / max(at_least.epsilon, 1e-9) + 1e-9))
                else:
                    buckets = min(len(x), len(p))
                    differ = np.abs(fold(x, buckets) - fold(p, buckets)).sum()
                    near.append(bool(at_least.may_link(np.int64(differ), np.int64(n + m))))
                    ring.append(0)
            kept = ["region", "_pivot", "key", "n", "own"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(near, pa.bool_()), pa.array(ring, pa.int32())], [*kept, "near", "ring"])

    return run


def _sized(members: DataFrame, exact: bool) -> DataFrame:
    """Of each region of two members or more, whether one task can hold it, and its pivot: the
    member whose key is the region's, or the smallest."""
    here = F.max((F.col("key") == F.col("region")).cast("int"))
    total = F.sum("n") if exact else F.lit(0)
    size = members.groupBy("region").agg(F.count(F.lit(1)).alias("_docs"), total.alias("_sum"), F.when(here == 1, F.col("region")).otherwise(F.min("key")).alias("_pivot"))
    large = (F.col("_docs") > MAX_DOCS) | (F.col("_sum") > MAX_SHINGLES)
    return size.where("_docs > 1").select("region", "_pivot", large.alias("_large"))


def _whole(rows: DataFrame) -> DataFrame:
    """Regions that are one task each."""
    return rows.withColumn("task", F.lit(0).cast("long")).withColumn("near", F.lit(False))


def _blocks(large: DataFrame, pivots: DataFrame, own: str, percent: int, exact: bool) -> tuple[DataFrame, DataFrame]:
    """Tasks that compare all members of each large region that may link and have no path yet,
    and edges to pivots. large: region, _pivot, key, n, own. pivots: those of them with key = _pivot.

    Members within reach of their region's pivot are linked to it and are not compared with each
    other. The rest, the open ones, are cut into blocks; blocks meet in pairs, of which one is
    open, and by the triangle inequality only if their rings around the pivot touch.
    """
    blocks = lambda docs, total: F.greatest(F.ceil(docs / (MAX_DOCS // 2)), F.ceil(total / (MAX_SHINGLES // 2))).cast("int")
    pivots = pivots.select("region", F.col(own).alias("pivot"), F.col("n").alias("pivot_n")).dropDuplicates(["region"])
    seen = large.join(pivots, "region").select("region", "_pivot", "key", "n", F.col(own).alias("own"), "pivot", "pivot_n")
    seen = seen.mapInArrow(_near(percent, exact), "region long, _pivot long, key long, n long, own binary, near boolean, ring int")
    large = materialize(seen, "jaccard-near").withColumnRenamed("own", own)
    # rings are blocks of their own: (ring, open or near, part of it)
    count = large.groupBy("region", "ring", "near").agg(F.count(F.lit(1)).alias("_d"), F.sum("n").alias("_s"))
    count = count.withColumn("_parts", F.greatest(F.lit(1), blocks(F.col("_d"), F.col("_s") if exact else F.lit(0))))
    count = materialize(count, "jaccard-rings")
    others = F.array_sort(F.collect_list(F.struct(F.col("r2"), F.col("n2"), F.col("p2"))))
    two = count.select("region", F.col("ring").alias("r2"), F.col("near").alias("n2"), F.col("_parts").alias("p2"))
    meets = count.join(two, "region").where((F.abs(F.col("ring") - F.col("r2")) <= 1) & ~(F.col("near") & F.col("n2")))
    meets = meets.groupBy("region", "ring", "near").agg(F.first("_parts").alias("_parts"), others.alias("_others"))
    dealt = large.join(meets, ["region", "ring", "near"])
    dealt = dealt.withColumn("_part", F.pmod(F.xxhash64("key"), F.col("_parts")).cast("int"))
    name = lambda ring, near, part: F.concat_ws(":", ring.cast("string"), near.cast("string"), part.cast("string"))
    mine = name(F.col("ring"), F.col("near"), F.col("_part"))
    theirs = F.flatten(F.transform("_others", lambda o: F.transform(F.sequence(F.lit(0), o["p2"] - 1), lambda k: name(o["r2"], o["n2"], k))))
    dealt = dealt.withColumn("_other", F.explode(theirs)).withColumn("_mine", mine)
    task = F.xxhash64(F.least("_mine", "_other"), F.greatest("_mine", "_other"))
    star = large.where("near").select(F.col("_pivot").alias("a"), F.col("key").alias("b"))
    return dealt.withColumn("task", task), star


def _both(rows: DataFrame, own: str, percent: int, exact: bool) -> tuple[list[DataFrame], list[DataFrame]]:
    """Tasks and edges to pivots of regions of either kind. rows: as for _blocks(), and _large."""
    tasks, large = [_whole(rows.where("not _large"))], rows.where("_large")
    if large.isEmpty():
        return tasks, []
    part, star = _blocks(large, large.where("key = _pivot"), own, percent, exact)
    return [*tasks, part], [star]


def _joined(tasks: list[DataFrame], stars: list[DataFrame], own: str, percent: int, exact: bool) -> DataFrame:
    """Edges of all tasks and those to pivots."""
    cols = ["region", "task", "key", "n", "near", own]
    rows = tasks[0].select(*cols)
    for t in tasks[1:]:
        rows = rows.unionByName(t.select(*cols))
    rows = rows.repartition("region", "task").sortWithinPartitions("region", "task", "key")
    edges = rows.mapInArrow(_verified(percent) if exact else _candidates(percent), "a long, b long")
    for s in stars:
        edges = edges.unionByName(s)
    return edges


def jaccard_components(docs: DataFrame, words: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents linked by 100 * intersection >= percent * union of their word-shingle sets.

    Distances between sets that share nothing are all 1, so no choice of a few pivots parts a
    corpus. Pivots come from the sets' own rarest shingles: linked sets share one of their rarest
    (1 - percent / 100) n + 1 shingles, whatever the order of rarity (here a sketch of all
    shingles' counts, of fixed size). The document with the smallest key is the pivot of all that
    share such a shingle with it; a document lies in the regions of several pivots.

    1. Equal sets are one document. 2. Each region is joined on histograms, whose distance bounds
    the sets' distance from below; what may link is grouped. 3. The groups' sets are read again and
    each group is joined exactly and recursively by metric_join(). Regions and groups above
    MAX_DOCS or MAX_SHINGLES are split over tasks by rings around a pivot (see _blocks()). Paths, not
    pairs, are kept, so a group of copies costs a row per document. 4. Components of the links.

    Set sizes and links are exact but for collisions of 64-bit hashes. Texts without words (null,
    empty, white space) have no shingles and link with nothing; with fewer than `words` words the
    whole sequence is the one shingle. Repeated rows link to each other. Rows without identifier
    are documents too; a component's identifier is the smallest that is not null. An empty table
    gives no rows. Other input columns are ignored.

    Returns id_col, n_shingles long, component_id (the smallest id_col reachable, itself included).
    """
    spark = docs.sparkSession
    small_batches(spark)
    at_least = Threshold(percent)
    kind = dict(docs.dtypes)[id_col]
    text = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("_text"))
    classes = spark.sparkContext.broadcast(frequency_classes(text, words))  # SKETCH bytes
    described = text.mapInArrow(_describe(words, at_least, lambda: classes.value), f"_id {kind}, key long, n long, hist binary, cells array<long>, cold int")
    described = materialize(described, "jaccard-docs")
    full = described.where("n > 0")
    sets = materialize(full.groupBy("key").agg(F.min("_id").alias("_id"), F.first("n").alias("n"), F.first("hist").alias("hist")), "jaccard-sets")

    # regions: (pivot, document) for documents that share a cell. A cold cell has no more rows than
    # its cell of the sketch counts, about the sketch's mean; a hot one may have any number.
    cold = full.select("key", F.explode(F.slice("cells", F.lit(1), F.col("cold"))).alias("cell"))
    one = Window.partitionBy("cell")
    cold = cold.select("key", F.min("key").over(one).alias("region"), F.max("key").over(one).alias("_last")).where("region <> _last")
    hot = full.where(F.size("cells") > F.col("cold")).select("key", F.explode(F.slice("cells", F.col("cold") + 1, F.size("cells") - F.col("cold"))).alias("cell"))
    pivot = hot.groupBy("cell").agg(F.min("key").alias("region"), F.max("key").alias("_last")).where("region <> _last")
    hot = hot.join(pivot.drop("_last"), "cell")  # may be split where a cell is frequent
    members = cold.select("region", "key").unionByName(hot.select("region", "key")).distinct()
    members = materialize(members, "jaccard-members")
    members = members.join(materialize(_sized(members, False), "jaccard-regions"), "region")
    rows = members.join(sets.drop("_id"), "key")
    tasks, stars = _both(rows, "hist", percent, False)
    may = components(_joined(tasks, stars, "hist", percent, False))
    may = may.withColumnRenamed("label", "region").withColumnRenamed("node", "key")

    # the sets of what may link, from the documents' texts; what is wanted grows with the input, so
    # that join is the same at every size
    wanted = materialize(may.join(sets.drop("hist"), "key").withColumnRenamed("_id", "_wid"), "jaccard-wanted")
    rows = materialize(wanted.join(_sized(wanted, True), "region"), "jaccard-groups")

    def with_sets(part: DataFrame) -> DataFrame:
        """region, key, n, items of the wanted documents; a repeated row repeats its set."""
        return text.join(part, F.col("_id").eqNullSafe(F.col("_wid"))).select("_text", "region", "key", "n").mapInArrow(_sets(words), "region long, key long, n long, items binary")

    tasks, stars = [_whole(with_sets(rows.where("not _large").hint("merge")))], []
    large = materialize(rows.where("_large"), "jaccard-large-rows")  # few, so its join may need no shuffle of texts
    if not large.isEmpty():
        whose = large.select("region", "_pivot").distinct()
        members = with_sets(large).dropDuplicates(["region", "key"]).join(whose, "region")
        part, star = _blocks(members, with_sets(large.where("key = _pivot")), "items", percent, True)
        tasks, stars = [*tasks, part], [star]
    linked = components(_joined(tasks, stars, "items", percent, True))

    low = linked.join(sets.select("key", "_id"), linked["node"] == sets["key"]).select("node", "label", "_id")
    smallest = low.groupBy("label").agg(F.min("_id").alias("_low"))
    named = low.join(smallest, "label").select(F.col("node").alias("key"), "_low")
    own = sets.select("key", F.col("_id").alias("_own")).join(named, "key", "left").select("key", F.coalesce("_low", "_own").alias("_component"))
    return described.select("_id", "key", "n").join(own, "key", "left").select(
        F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("_component", "_id")).otherwise(F.col("_id")).alias("component_id")
    )
