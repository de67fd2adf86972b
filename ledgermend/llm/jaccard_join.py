"""N-gram Jaccard join on prefix trees.

Each document is the set of its distinct word shingles. Sets are ordered by one global order, rare
shingles first: the key of a shingle holds its frequency class in the high bits, from a table of
counts over all documents with a fixed number of slots, and its hash in the others. Sets that reach
the similarity share a shingle among their first ones (the prefix), so a document meets only
documents of its own prefix shingles:

1. Documents with equal sets are one class, of which the smallest doc_id goes on.
2. In each prefix shingle's group the smallest document is the probe of all others. A document
   follows the probe that it meets in most of its prefix, a third at least; documents joined by that are a
   cluster, however many copies of one text there are. This takes work in proportion to the rows.
3. Each follower is compared with its probe: the sets of a probe's followers are stored in tries over the ordered
   shingles, and the probe walks them: a walk counts overlaps once for all sets that share a path, and leaves a
   branch when the shingles that remain on either side cannot reach the similarity. What links is contracted, one row a
   document. Only clusters that this leaves in several parts go on: documents beside the largest part
   go in blocks of bounded size to one task for each pair of blocks, and the largest part to one task for each
   block, where sets meet through tries again. Only links that join components are returned.
4. Groups whose documents are in different clusters and components meet pair by pair where the lengths and
   the places of the shingle allow; a shingle that many texts have stands late in their orders and
   allows few. A pair's common prefix shingles are counted, and it is compared, again through tries, if
   they, with all that may follow the prefixes, can reach the similarity.

Steps 3 and 4 make the result exact. Links come from counted overlaps, never from an estimate.

The hashes have 58 bits: two different shingles of one pair of documents count as one with a
probability below 1e-8 for a thousand shingles each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermend.llm.components import components
from ledgermend.llm.shingling import mix, parts_of, shingle_hashes, shingle_sets
from ledgermend.llm.store import forget, written

SLOTS = 1 << 17
"""Counters of the frequency table; it is all that the driver sees of the shingles."""

CLASS_BITS = 6
BROADCAST_IDS = 1 << 20
"""Up to so many ids of candidates are broadcast to find their texts; more are joined by a shuffle."""

BLOCK_SHINGLES = 1 << 20
BLOCK_SETS = 512
"""Shingles and sets in one trie, about; larger groups are cut into blocks."""

NAMES = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("prefix", pa.list_(pa.int64()))]
)


def frequency_classes(texts: DataFrame, width: int) -> np.ndarray:
    """For each slot of shingle hashes, twice the binary logarithm of its count over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        for batch in parts_of(batches):
            hashes = shingle_hashes(batch["text"], width)
            counts += np.bincount((hashes & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS)
        slots = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(counts[slots])], ["slot", "rows"])

    counted = texts.select("text").mapInArrow(count, "slot long, rows long")
    classes = (
        counted.groupBy("slot")
        .agg(F.sum("rows").alias("rows"))
        .select(F.col("slot").cast("int"), F.floor(2 * F.log2(F.col("rows") + 1)).cast("int").alias("class"))
        .toArrow()
    )
    out = np.zeros(SLOTS, np.uint64)
    out[classes["slot"].to_numpy()] = np.minimum(classes["class"].to_numpy(), (1 << CLASS_BITS) - 1)
    return out


def ordered(shingles: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """A set's keys in the global order."""
    keys = classes[(shingles & np.uint64(SLOTS - 1)).astype(np.int64)] << np.uint64(64 - CLASS_BITS)
    return np.unique(keys | (shingles >> np.uint64(CLASS_BITS)))


def prefix_length(n: int, percent: int) -> int:
    """So many first keys that two sets of the similarity share one of them."""
    return n - -(-percent * n // 100) + 1 if n else 0


def _set_hashes(keys: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        first = mix(keys).sum(dtype=np.uint64)
        second = mix(keys ^ np.uint64(0x5DEECE66D1234567)).sum(dtype=np.uint64)
    return int(first.view(np.int64)), int(second.view(np.int64))


def documents_of(texts: DataFrame, width: int, percent: int, classes: np.ndarray) -> DataFrame:
    """(doc_id, n, h1, h2, prefix): set size, a 128-bit hash of the set, first keys in order."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            n, h1, h2, prefixes = [], [], [], []
            for shingles in shingle_sets(batch["text"], width):
                keys = ordered(shingles, classes)
                first, second = _set_hashes(keys)
                n.append(len(keys))
                h1.append(first)
                h2.append(second)
                prefixes.append(keys[: prefix_length(len(keys), percent)].view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            values = np.concatenate([*prefixes, np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].cast(pa.int64()), pa.array(n), pa.array(h1), pa.array(h2), pa.ListArray.from_arrays(offsets, values)],
                schema=NAMES,
            )

    found = texts.select("doc_id", "text").mapInArrow(rows, "doc_id long, n long, h1 long, h2 long, prefix array<long>")
    # Texts without words are classes of their own, also for the join of the result.
    empty = F.col("n") == 0
    return found.withColumns(
        {
            "h1": F.when(empty, F.xxhash64("doc_id")).otherwise(F.col("h1")),
            "h2": F.when(empty, F.coalesce("doc_id", F.lit(-1))).otherwise(F.col("h2")),
        }
    )


def sets_of(texts: DataFrame, width: int, classes: np.ndarray) -> DataFrame:
    """texts with n and keys, the whole ordered set as little-endian bytes, in place of the text."""
    others = [name for name in texts.columns if name != "text"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            sets = [ordered(s, classes) for s in shingle_sets(batch["text"], width)]
            made = [pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([*(batch[name] for name in others), *made], [*others, "n", "keys"])

    return texts.mapInArrow(rows, ", ".join(f"{name} long" for name in others) + ", n long, keys binary")


def reaches(overlap, n: int, m: int, percent: int):
    """Whether `overlap` common shingles of sets of n and m make the similarity."""
    return overlap * (100 + percent) >= percent * (n + m)


class Trie:
    """Ordered sets by their common beginnings; an edge holds all keys up to the next fork."""

    def __init__(self, sets: list[tuple[int, np.ndarray]]):
        self.root = self._node(sorted(sets, key=lambda s: s[1].astype(">u8").tobytes()), 0)

    @staticmethod
    def _node(sets: list[tuple[int, np.ndarray]], depth: int) -> tuple:
        """(edge, depth at its end, names that end there, children, shortest, longest), without recursion."""
        root = ([], 0, [], [], 0, 0)
        todo = [(sets, depth, root[3])]
        while todo:
            group, at, siblings = todo.pop()
            start = 0
            while start < len(group):
                if len(group[start][1]) == at:  # only an empty set
                    start += 1
                    continue
                head = group[start][1][at]
                end = start + 1
                while end < len(group) and group[end][1][at] == head:
                    end += 1
                first, last = group[start][1], group[end - 1][1]
                most = min(len(first), len(last))
                apart = np.flatnonzero(first[at:most] != last[at:most])
                to = at + int(apart[0]) if len(apart) else most
                sizes = [len(keys) for _, keys in group[start:end]]
                names = [name for name, keys in group[start:end] if len(keys) == to]
                node = (first[at:to], to, names, [], min(sizes), max(sizes))
                siblings.append(node)
                rest = [s for s in group[start:end] if len(s[1]) > to]
                if rest:
                    todo.append((rest, to, node[3]))
                start = end
        return root

    def linked(self, probe: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
        """(name, overlap) of each stored set that reaches the similarity with the probe."""
        n = len(probe)
        todo = [(child, 0) for child in self.root[3]]
        while todo:
            (edge, depth, names, children, shortest, longest), overlap = todo.pop()
            places = np.searchsorted(probe, edge)
            hit = places < n
            hit[hit] = probe[places[hit]] == edge[hit]
            overlap += int(np.count_nonzero(hit))
            left = n - int(places[-1]) - int(hit[-1])
            if names and reaches(overlap, n, depth, percent):
                yield from ((name, overlap) for name in names)
            # What a set of this branch can still add is bounded by both remaining lengths. A set
            # that ends just as the probe does has the best chance, or the next in length to it.
            most = overlap + min(left, longest - depth)
            if children and reaches(most, n, max(shortest, min(longest, depth + left)), percent):
                todo += ((child, overlap) for child in children)


def _blocks() -> Column:
    """How many blocks rows with a set size n make."""
    return F.greatest(F.floor(F.sum("n") / BLOCK_SHINGLES), F.floor(F.count("*") / BLOCK_SETS)) + 1


def followers(met: DataFrame, percent: int) -> DataFrame:
    """(x, y, nx, ny): each document y that shares much of its prefix with a probe, and the probe x that it shares most with.

    met has a row for each document of each prefix shingle's group: key, doc_id, n, at and probe.
    """
    strong = (
        met.where("not probe").alias("d").join(met.where("probe").alias("p"), "key")
        .where(_alike_in_length(percent, "d", "p"))
        .groupBy(F.col("p.doc_id").alias("x"), F.col("d.doc_id").alias("y"), F.col("p.n").alias("nx"), F.col("d.n").alias("ny"))
        .agg(F.count("*").alias("common"))
        .where(F.col("common") * 3 * 100 >= F.col("ny") * (100 - percent))
    )
    best = F.max(F.struct("common", (-F.col("x")).alias("low"), "nx", "ny")).alias("best")
    return written(strong.groupBy("y").agg(best).select((-F.col("best.low")).alias("x"), "y", "best.nx", "best.ny"), "followers")


def clusters(follows: DataFrame) -> DataFrame:
    """(doc_id, cluster, n) of the documents that follow a probe or are followed."""
    sizes = follows.select(F.col("x").alias("doc_id"), F.col("nx").alias("n")).union(follows.select("y", "ny")).groupBy("doc_id").agg(F.max("n").alias("n"))
    placed = components(follows.select("x", "y")).join(sizes.withColumnRenamed("doc_id", "node"), "node")
    return placed.select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"), "n")


def left_over(grouped: DataFrame, parts: DataFrame) -> DataFrame:
    """(doc_id, cluster, block, blocks) of the clusters that their probes' links leave in several parts.

    The largest part of a cluster is its block number `blocks`; all other documents are dealt to blocks 0 to blocks - 1.
    """
    named = grouped.join(parts.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("part", F.coalesce("component", "doc_id"))
    sizes = named.groupBy("cluster", "part").agg(F.count("*").alias("docs"))
    main = sizes.groupBy("cluster").agg(F.max(F.struct("docs", (-F.col("part")).alias("low"))).alias("main"), F.count("*").alias("parts")).where("parts > 1")
    told = named.join(main.select("cluster", (-F.col("main.low")).alias("main")), "cluster").withColumn("beside", F.col("part") != F.col("main"))
    volume = told.where("beside").groupBy("cluster").agg(_blocks().alias("blocks"))
    block = F.when(F.col("beside"), F.pmod(F.xxhash64("doc_id"), "blocks")).otherwise(F.col("blocks"))
    return told.join(volume, "cluster").select("doc_id", "cluster", block.alias("block"), "blocks")


def joined_in_clusters(members: DataFrame, percent: int) -> DataFrame:
    """Links (x, y) that join the sets of each cluster into components; members: sets with the columns of left_over.

    Each two blocks meet, and each block itself, but for the last one, whose documents are one part already.
    """
    last = F.when(F.col("block") == F.col("blocks"), F.col("blocks") - 1).otherwise(F.col("blocks"))
    meets = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last))).select(
        "cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "doc_id", "keys"
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sets = None, []

        def found() -> list[tuple[int, int]]:
            return _joining(key, sets, percent) if len(sets) > 1 else []

        for batch in batches:
            out: list[tuple[int, int]] = []
            columns = [batch[c].to_pylist() for c in ("cluster", "low", "high", "block", "doc_id")]
            for i, (cluster, low, high, block, doc_id) in enumerate(zip(*columns, strict=True)):
                if (cluster, low, high) != key:
                    out += found()
                    key, sets = (cluster, low, high), []
                sets.append((block, doc_id, np.frombuffer(batch["keys"][i].as_buffer(), np.uint64)))
            yield _pairs(out)
        yield _pairs(found())

    by = ("cluster", "low", "high")
    return meets.repartition(*by).sortWithinPartitions(*by, "doc_id").mapInArrow(check, "x long, y long")


def _joining(key: tuple[int, int, int], sets: list[tuple[int, int, np.ndarray]], percent: int) -> list[tuple[int, int]]:
    """Links between two blocks' sets, or of one block's, that each join two groups of earlier links."""
    _, low, high = key
    trie = Trie([(doc_id, keys) for block, doc_id, keys in sets if block == low])
    above = {doc_id: doc_id for _, doc_id, _ in sets}

    def top(doc_id: int) -> int:
        while above[doc_id] != doc_id:
            above[doc_id] = doc_id = above[above[doc_id]]
        return doc_id

    out = []
    for block, doc_id, keys in sets:
        if block == high:
            for other, _ in trie.linked(keys, percent):
                a, b = top(doc_id), top(other)
                if a != b:
                    above[a] = b
                    out.append((doc_id, other))
    return out


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose sets reach the similarity; x is the probe of a trie of its ys."""
    sized = pairs.join(sets.select(F.col("doc_id").alias("y"), "n", "keys"), "y")
    volume = sized.groupBy("x").agg(_blocks().alias("blocks"))
    stored = sized.join(volume, "x").select("x", F.pmod(F.xxhash64("y"), F.col("blocks")).alias("block"), F.lit(1).alias("role"), "y", "keys")
    probes = (
        volume.join(sets.select(F.col("doc_id").alias("x"), "keys"), "x")
        .select("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("role"), F.col("x").alias("y"), "keys")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, probing, members = None, [], []

        def found() -> Iterator[tuple[int, int]]:
            if probing and members:
                trie = Trie(members)
                for probe in probing:
                    yield from ((key[0], name) for name, _ in trie.linked(probe, percent))

        for batch in batches:
            out: list[tuple[int, int]] = []
            columns = [batch[c].to_pylist() for c in ("x", "block", "role", "y")]
            for i, (x, block, role, y) in enumerate(zip(*columns, strict=True)):
                if (x, block) != key:
                    out += found()
                    key, probing, members = (x, block), [], []
                keys = np.frombuffer(batch["keys"][i].as_buffer(), np.uint64)
                probing.append(keys) if role == 0 else members.append((y, keys))
            yield _pairs(out)
        yield _pairs(list(found()))

    grouped = probes.union(stored).repartition("x", "block").sortWithinPartitions("x", "block", "role")
    return grouped.mapInArrow(check, "x long, y long").distinct()


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())], ["x", "y"])


def _most(a: str, b: str) -> Column:
    """The largest overlap of two sets of which this is the first common shingle."""
    return 1 + F.least(F.col(f"{a}.n") - F.col(f"{a}.at"), F.col(f"{b}.n") - F.col(f"{b}.at"))


def _alike_in_length(percent: int, a: str, b: str) -> Column:
    return F.least(f"{a}.n", f"{b}.n") * 100 >= percent * F.greatest(f"{a}.n", f"{b}.n")


def _behind_prefix(percent: int, n: str) -> Column:
    """How many shingles of a set of n lie behind its prefix."""
    return F.ceil(F.col(n) * percent / 100) - 1


def jaccard_components(documents: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of documents (doc_id, text).

    Two documents link when 100 * intersection >= percent * union of their sets of `width`-word
    shingles. A shorter text has its whole word sequence as only shingle; null, empty and blank
    texts have no shingle, link with nothing and are their own component. component_id is the
    smallest doc_id reachable by links. Rows of one doc_id count as one document in links, and
    every row gets a result row. Rows without doc_id join the components of equal texts; without
    any, their component_id is null. Other columns are ignored.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    classes = frequency_classes(texts, width)
    docs = written(documents_of(texts, width, percent, classes), "sets")

    same = docs.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep"))
    reps = docs.join(same.where("n > 0").select(F.col("rep").alias("doc_id"), "n", "h1", "h2"), ["doc_id", "n", "h1", "h2"], "left_semi")
    posting = reps.select("doc_id", "n", F.posexplode("prefix").alias("at", "key")).selectExpr(
        "key", "doc_id", "cast(n as int) n", "at + 1 at"
    )
    # The smallest document of each group is its probe.
    groups = posting.groupBy("key").agg(F.count("*").alias("rows"), F.min("doc_id").alias("low")).where("rows > 1")
    met = written(
        posting.join(groups, "key").select("key", "doc_id", "n", "at", "rows", (F.col("doc_id") == F.col("low")).alias("probe")),
        "groups",
    )
    follows = followers(met, percent)
    grouped = written(clusters(follows), "clusters")
    members = written(sets_of(_texts_of(texts, grouped.select("doc_id")), width, classes), "members")
    links = written(verified(follows.select("x", "y"), members, percent), "links")
    rest = left_over(grouped, components(links))
    inner = written(joined_in_clusters(members.join(rest, "doc_id"), percent), "links")
    forget(follows, members)
    parts = components(links.union(inner))

    placed = written(
        met.join(parts.withColumnRenamed("node", "doc_id"), "doc_id", "left").join(grouped.select("doc_id", "cluster"), "doc_id", "left")
        .select("key", "doc_id", "n", "at", F.coalesce("component", "doc_id").alias("part"), F.coalesce("cluster", "doc_id").alias("cluster")),
        "placed",
    )
    open_keys = placed.groupBy("key").agg(F.min("cluster").alias("low"), F.max("cluster").alias("high")).where("low <> high").select("key")
    open_rows = placed.join(open_keys, "key", "left_semi")
    different = (F.col("a.doc_id") < F.col("b.doc_id")) & (F.col("a.part") != F.col("b.part")) & (F.col("a.cluster") != F.col("b.cluster"))
    met_twice = written(
        open_rows.alias("a").join(open_rows.alias("b"), "key")
        .where(different & _alike_in_length(percent, "a", "b") & reaches(_most("a", "b"), F.col("a.n"), F.col("b.n"), percent))
        .select(F.col("a.doc_id").alias("x"), F.col("b.doc_id").alias("y"), F.col("a.n").alias("n"), F.col("b.n").alias("m")).distinct(),
        "pairs",
    )
    # Beyond the prefix that ends first, only the rest of its set can be common.
    first_keys = docs.select("doc_id", "prefix")
    behind = F.greatest(_behind_prefix(percent, "n"), _behind_prefix(percent, "m"))
    common = F.size(F.array_intersect("of_x", "of_y"))
    more = written(
        met_twice.join(first_keys.select(F.col("doc_id").alias("x"), F.col("prefix").alias("of_x")), "x")
        .join(first_keys.select(F.col("doc_id").alias("y"), F.col("prefix").alias("of_y")), "y")
        .where(reaches(common + behind, F.col("n"), F.col("m"), percent))
        .select("x", "y").distinct(),
        "candidates",
    )
    if not more.isEmpty():
        wanted = more.select(F.col("x").alias("doc_id")).union(more.select("y")).distinct()
        sets = written(sets_of(_texts_of(texts, written(wanted, "wanted")), width, classes), "sets")
        outer = written(verified(more, sets, percent), "links")
        parts = components(links.union(inner).union(outer))
        forget(sets, outer)
    forget(met, grouped, links, inner, placed, met_twice, more)

    of_class = same.join(parts.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        "n", "h1", "h2", F.coalesce("component", "rep").alias("component_id")
    )
    return docs.join(of_class, ["n", "h1", "h2"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _texts_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of the wanted doc_ids, with wanted's columns; only few ids are broadcast."""
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    return texts.join(side, "doc_id")
