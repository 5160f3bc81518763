"""Exact Jaccard join of word-shingle sets and its connected components, by PartEnum signatures.

1. *Classes*: documents with equal shingle sets are one node from here on,
   named by a hash of the set (checked for collisions).
2. *Signatures* (``part_enum``): similar sets share one. A map over documents
   gathers blocks of signatures; each block sends every different signature
   once, with its smallest node, to the signature's bucket (so a signature that
   a third of all sets have is one entry per block there). A bucket finds the
   signatures of two nodes or more and tells each block their smallest node,
   the *pivot*; the block, brought to the same partitions by the same exchange,
   then lists its own nodes under the pivots.
3. *Verification*: all sets under a pivot meet in a task, which grows components
   from an inverted index of rare shingles and compares a set only while it is
   in none.
   Two sets with a common signature are both under its pivot, so no link is
   lost. Where the sets under one pivot have more than ``group_shingles``
   shingles they are dealt into chunks and every pair of chunks is a task.
   A task returns a forest of links, never all pairs.
4. *Components* of the forest by alternating large-star and small-star steps,
   each a join and a grouped minimum; nothing is collected.

Edge cases: texts without words have no set, link with nothing and are their
own component; null ids never name a component unless all its ids are null
(then it is null); repeated rows are copies; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vesseltrack.session import materialize, ship_package

from .bpe import pack, unpack
from .common import fresh, map_arrow
from .part_enum import PartEnum
from .shingles import shingles

PERCENT = 80
BLOCK_SIGNATURES = 2_000_000
BUCKET_SHINGLES = 500_000
GROUP_SHINGLES = 1_000_000
BROADCAST_NODES = 1_000_000
SPACES = " \t\n\x0b\x0c\r"  # between words, as shingles() splits


def node_of(a: np.ndarray, seed: int = 0) -> tuple[int, int]:
    """Name of a set, and a second hash that tells names of different sets apart."""
    h = hashlib.blake2b(a.tobytes(), digest_size=16, salt=seed.to_bytes(8, "little")).digest()
    return int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True)


def document_sets(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, n_shingles, node, check and the columns after doc_id and text; node is null for an empty set."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    more = docs.columns[2:]

    def run(batches):
        for b in batches:
            sets = [shingles(t.as_py()) for t in b.column(1)]
            names = [node_of(s, seed) if len(s) else (None, None) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in sets], type=pa.int64()), pa.array([n for n, _ in names], type=pa.int64()),
                 pa.array([c for _, c in names], type=pa.int64()), *b.columns[2:]], ["doc_id", "n_shingles", "node", "check", *more])

    schema = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in more)
    return map_arrow(docs, run, f"doc_id {kind}, n_shingles bigint, node bigint, check bigint{schema}")


def _pack64(a: np.ndarray) -> bytes:
    """64-bit numbers as two packed halves."""
    a = np.ascontiguousarray(a).view(np.uint64)
    low, high = pack((a & np.uint64(0xFFFFFFFF)).astype(np.uint32)), pack((a >> np.uint64(32)).astype(np.uint32))
    return len(low).to_bytes(8, "little") + low + high


def _unpack64(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:8], "little")
    return unpack(packed[8:8 + n]).astype(np.uint64) | unpack(packed[8 + n:]).astype(np.uint64) << np.uint64(32)


def _runs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and lengths of runs of equal numbers."""
    start = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1]))) if len(a) else np.zeros(0, dtype=np.int64)
    return start, np.diff(np.append(start, len(a)))


def _block_rows(nodes: list[int], signed: list[np.ndarray], block: int, buckets: int):
    """A block's signatures by bucket, then its own list of (signature, node)."""
    order = np.argsort(np.array(nodes, dtype=np.int64), kind="stable")  # the smallest node of a signature comes first
    nodes = np.array(nodes, dtype=np.int64)[order]
    signed = [signed[i] for i in order]
    sig = np.concatenate(signed)
    owner = np.repeat(np.arange(len(nodes)), [len(s) for s in signed])
    by = np.argsort(sig, kind="stable")
    sig, owner = sig[by], owner[by]
    start, length = _runs(sig)
    each = sig[start]  # ascending; a bucket is a range of signatures
    bucket = ((each >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    cut = np.append(_runs(bucket)[0], len(bucket))
    for lo, hi in zip(cut[:-1], cut[1:]):
        first = owner[start[lo:hi]]
        there, at = np.unique(first, return_inverse=True)
        yield {"route": -1 - int(bucket[lo]), "block": block, "a": _pack64(np.diff(each[lo:hi], prepend=np.uint64(0))),
               "b": pack(at * 2 + (length[lo:hi] > 1)), "c": _pack64(nodes[there])}
    yield {"route": block, "block": block, "a": pack(np.concatenate((cut[:-1], bucket[cut[:-1]]))), "b": pack(owner),
           "c": _pack64(nodes), "d": pack(length)}


def _signature_blocks(docs: DataFrame, percent: int, seed: int, buckets: int) -> DataFrame:
    def run(batches):
        enum, number = PartEnum(percent), 0
        schema = pa.schema([("route", pa.int64()), ("block", pa.int64()), *((c, pa.binary()) for c in "abcd")])
        nodes, signed, seen, size = [], [], set(), 0

        def out():
            for row in _block_rows(nodes, signed, (TaskContext.get().partitionId() << 24) | number, buckets):
                yield pa.RecordBatch.from_arrays([pa.array([row.get(f.name)], type=f.type) for f in schema], schema=schema)

        for b in batches:
            for t in b.column(0):
                a = shingles(t.as_py())
                s = enum.signatures(a)
                node = node_of(a, seed)[0] if len(s) else None
                if node is None or node in seen:
                    continue
                seen.add(node)
                nodes.append(node)
                signed.append(s)
                size += len(s)
                if size >= BLOCK_SIGNATURES:
                    yield from out()
                    nodes, signed, seen, size, number = [], [], set(), 0, number + 1
        if nodes:
            yield from out()

    return map_arrow(docs.select("text"), run, "route bigint, block bigint, a binary, b binary, c binary, d binary")


def _pivots(blocks: DataFrame) -> DataFrame:
    """Per block and bucket: the places of shared signatures in the block's list and their pivots. ``blocks`` are sorted by route."""
    def of_bucket(bucket, rows):
        sigs, nodes, many, source, place = [], [], [], [], []
        for i, (_, a, b, c) in enumerate(rows):
            s, at = np.cumsum(_unpack64(a), dtype=np.uint64), unpack(b)
            sigs.append(s)
            nodes.append(_unpack64(c).view(np.int64)[at >> 1])
            many.append((at & 1).astype(bool))
            source.append(np.full(len(s), i))
            place.append(np.arange(len(s)))
        sig = np.concatenate(sigs)
        by = np.argsort(sig, kind="stable")
        start, length = _runs(sig[by])
        node, many = np.concatenate(nodes)[by], np.concatenate(many)[by]
        low = np.minimum.reduceat(node, start)
        shared = (low != np.maximum.reduceat(node, start)) | np.logical_or.reduceat(many, start)
        keep = np.repeat(shared, length)
        src, plc, piv = np.concatenate(source)[by][keep], np.concatenate(place)[by][keep], np.repeat(low, length)[keep]
        for i in np.unique(src):
            mine = src == i
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows[i][0]], type=pa.int64()), pa.array([bucket], type=pa.int64()),
                 pa.array([pack(plc[mine])], type=pa.binary()), pa.array([_pack64(piv[mine])], type=pa.binary())],
                ["route", "bucket", "places", "pivots"])

    def run(batches):
        route, held = None, []  # one bucket at a time
        for b in batches:
            for r in b.to_pylist():
                if held and r["route"] != route:
                    yield from of_bucket(-1 - route, held)
                    held = []
                route = r["route"]
                if route < 0:
                    held.append((r["block"], r["a"], r["b"], r["c"]))
        if held:
            yield from of_bucket(-1 - route, held)

    return map_arrow(blocks, run, "route bigint, bucket bigint, places binary, pivots binary")


def _members(joined: DataFrame) -> DataFrame:
    """pivot, node: the nodes of each block under the pivots of their signatures, without repetition."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                if r["d"] is None or not r["parts"]:
                    continue
                cut = unpack(r["a"]).astype(np.int64)
                begin = dict(zip(cut[len(cut) // 2:].tolist(), cut[:len(cut) // 2].tolist()))
                owner, nodes, length = unpack(r["b"]), _unpack64(r["c"]).view(np.int64), unpack(r["d"]).astype(np.int64)
                start = np.cumsum(length) - length
                found = []
                for part in r["parts"]:
                    at = unpack(part["places"]).astype(np.int64) + begin[part["bucket"]]
                    n = length[at]
                    rows = np.repeat(start[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    found.append(np.stack((np.repeat(_unpack64(part["pivots"]).view(np.int64), n), nodes[owner[rows]])))
                pairs = np.unique(np.concatenate(found, axis=1), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["pivot", "node"])

    return map_arrow(joined, run, "pivot bigint, node bigint")


def candidate_groups(docs: DataFrame, percent: int, seed: int, shingles_in_all: int = 0) -> DataFrame:
    """pivot, node: nodes that share a signature are under a common pivot (which is under itself).

    The buckets follow the number of shingles, so one bucket's signatures fit a
    task whatever the input; a task goes through its buckets one by one.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * parts, -(-shingles_in_all // BUCKET_SHINGLES))  # several a task, so that tasks are alike
    blocks = _signature_blocks(docs, percent, seed, buckets).repartition(parts, "route")
    found = _pivots(blocks.sortWithinPartitions("route")).groupBy("route").agg(F.collect_list(F.struct("bucket", "places", "pivots")).alias("parts"))
    # both uses of ``blocks`` read all of its columns and rows, so that one exchange serves both
    return _members(blocks.join(found, "route", "left")).distinct()


def similar_links(sizes: np.ndarray, elements: np.ndarray, percent: int, budget: int = 4_000_000):
    """(i, j) of a forest that joins all sets whose similarity reaches the percentage.

    Rare elements come first in a set; two similar sets share one of the first
    ``size * (100 - percent) // 100 + 1`` of either, so only those are indexed. A
    component grows from one set: the sets still free that share such an element
    are compared, the similar ones join and are asked in their turn. What has
    joined is never compared again and leaves the index once the entries read in
    vain outnumber it; with no set left free the rest need not be asked.
    """
    m = len(sizes)
    owner = np.repeat(np.arange(m), sizes)
    by = np.argsort(elements, kind="stable")
    start, length = _runs(elements[by])
    rank = np.empty(len(start), dtype=np.int64)
    rank[np.argsort(length, kind="stable")] = np.arange(len(start))
    number = np.empty(len(elements), dtype=np.int64)
    number[by] = np.repeat(rank, length)
    number = number[np.lexsort((number, owner))]  # rare first within a set
    first = np.cumsum(sizes) - sizes
    head = sizes * (100 - percent) // 100 + 1
    heads = np.flatnonzero(np.arange(len(elements)) - np.repeat(first, sizes) < np.repeat(head, sizes))

    def index(free):
        at = heads[free[owner[heads]]]
        at = at[np.argsort(number[at], kind="stable")]
        return np.append(0, np.cumsum(np.bincount(number[at], minlength=len(start)))), owner[at]

    def rows(begin, n):
        return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())

    def parts(n):
        """Slices of about ``budget`` rows."""
        ends, lo = np.cumsum(n), 0
        while lo < len(n):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + budget, side="right")))
            yield slice(lo, hi)
            lo = hi

    free, left, mark, links = np.ones(m, dtype=bool), m, np.zeros(len(start), dtype=bool), []
    begin, holder = index(free)
    vain = 0
    for seed in range(m):
        if not free[seed]:
            continue
        free[seed], left, queue = False, left - 1, [seed]
        while queue and left:
            i = queue.pop()
            mine = number[first[i]:first[i] + sizes[i]]
            near = mine[:head[i]]
            n = begin[near + 1] - begin[near]
            seen = np.zeros(m, dtype=bool) if n.sum() > m else None
            some = []
            for part in parts(n):
                them = holder[rows(begin[near[part]], n[part])]
                vain += len(them)
                them = them[free[them]]
                vain -= len(them)
                if seen is not None:
                    seen[them] = True
                else:
                    some.append(them)
            them = np.flatnonzero(seen) if seen is not None else np.unique(np.concatenate(some))
            them = them[(100 * sizes[them] >= percent * sizes[i]) & (100 * sizes[i] >= percent * sizes[them])]
            mark[mine] = True
            for part in parts(sizes[them]):
                some = them[part]
                size = sizes[some]
                common = np.add.reduceat(mark[number[rows(first[some], size)]].astype(np.int64), np.cumsum(size) - size)
                joined = some[100 * common >= percent * (size + sizes[i] - common)]
                free[joined] = False
                left -= len(joined)
                links += [(i, j) for j in joined.tolist()]
                queue += joined.tolist()
            mark[mine] = False
            if vain > len(holder):
                begin, holder = index(free)
                vain = 0
    return links


def verified_links(groups: DataFrame, sets: DataFrame, percent: int, group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """u, v: a forest of links between nodes, from groups (pivot, node) and sets (node, n, elements)."""
    spark = groups.sparkSession
    ship_package(spark)
    sized = groups.join(sets.select("node", "n"), "node")
    total = sized.groupBy("pivot").agg(F.sum("n").alias("total"), F.count("*").alias("nodes")).where("nodes > 1")
    total = total.select("pivot", F.ceil(F.col("total") / group_shingles).cast("int").alias("chunks"))
    # a set of a large group goes to every pair of chunks that its own chunk is in
    mine = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    other = F.when(F.col("chunks") > 1, F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array(F.lit(0)))
    dealt = groups.join(total, "pivot").withColumn("mine", mine).withColumn("other", F.explode(other)).select(
        "node", "pivot", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))

    def verify(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        sizes = table.column("n").to_numpy()
        links = []
        if len(nodes) > 1:
            elements = np.concatenate([np.frombuffer(e.as_py(), dtype="<u8") for e in table.column("elements")])
            links = similar_links(sizes, elements, percent)
        return pa.table({"u": pa.array([nodes[i] for i, _ in links], type=pa.int64()),
                         "v": pa.array([nodes[j] for _, j in links], type=pa.int64())})

    return dealt.join(sets, "node").groupBy("pivot", "i", "j").applyInArrow(verify, "u bigint, v bigint").distinct()


def sets_of(docs: DataFrame, wanted: DataFrame, classes: DataFrame, seed: int, broadcast_nodes: int) -> DataFrame:
    """node, n, elements of the wanted nodes, from one document of each."""
    ids = classes.join(wanted, "node").select(F.col("rep").alias("wanted_id")).distinct()
    if wanted.limit(broadcast_nodes + 1).count() <= broadcast_nodes:
        ids = F.broadcast(ids)

    def run(batches):
        for b in batches:
            sets = [shingles(t.as_py()) for t in b.column(0)]
            sets = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([node_of(s, seed)[0] for s in sets], type=pa.int64()), pa.array([len(s) for s in sets], type=pa.int64()),
                 pa.array([s.astype("<u8").tobytes() for s in sets], type=pa.binary())], ["node", "n", "elements"])

    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi").select("text")
    # ids may repeat or be null: the node is taken from the text, and one row of each is enough
    return map_arrow(texts, run, "node bigint, n bigint, elements binary").join(wanted, "node", "left_semi").dropDuplicates(["node"])


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node that links (u, v) reach from each node that has one.

    Alternating steps until nothing changes. Large star: every larger neighbour
    of a node moves to the node's smallest neighbour; small star: every smaller
    neighbour, and the node itself, does.
    """
    edges = materialize(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).distinct()
        edges = materialize(small, "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 31))).first()
        if state == before:
            break
        before = state
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def linked_rows(docs: DataFrame, percent: int = PERCENT, group_shingles: int = GROUP_SHINGLES,
                broadcast_nodes: int = BROADCAST_NODES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, more): doc_id, n_shingles, root, component_id and the further columns.

    ``root`` is a node that names the component whatever its ids; it is null for
    texts without words.
    """
    more = docs.columns[2:]
    for seed in range(16):
        rows = materialize(document_sets(docs, seed), "shingle-sets")
        classes = rows.where("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("rep"), F.min("check").alias("lo"), F.max("check").alias("hi"), F.min("n_shingles").alias("n"))
        classes = materialize(classes, "shingle-classes")
        if classes.where("lo <> hi").isEmpty():
            break
    else:
        raise ValueError("set names collide")
    total = classes.agg(F.sum("n")).first()[0] or 0
    groups = materialize(candidate_groups(docs, percent, seed, total), "candidate-groups")
    wanted = groups.select("node").distinct()
    sets = materialize(sets_of(docs, wanted, classes, seed, broadcast_nodes), "candidate-sets")
    roots = components(verified_links(groups, sets, percent, group_shingles))
    named = classes.select("node", "rep").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_node = named.join(ids, "root").select("node", "root", "component_id")
    # texts without words stay out of the join: they would be one hot null key
    linked = rows.where("node is not null").join(of_node, "node").select("doc_id", "n_shingles", "root", "component_id", *more)
    alone = rows.where("node is null").select(
        "doc_id", "n_shingles", F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("component_id"), *more)
    return linked.unionByName(alone)


def jaccard_components(docs: DataFrame, percent: int = PERCENT, group_shingles: int = GROUP_SHINGLES,
                       broadcast_nodes: int = BROADCAST_NODES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id."""
    found = linked_rows(docs.select("doc_id", "text"), percent, group_shingles, broadcast_nodes)
    return found.select("doc_id", "n_shingles", "component_id")


def document_key(doc_id: Column, text: Column) -> Column:
    """Digest of an id and a text, either of which may be null."""
    name = doc_id.cast("string")
    named = F.when(doc_id.isNull(), F.lit("-")).otherwise(F.concat(F.length(name).cast("string"), F.lit(":"), name))
    return F.unhex(F.sha2(F.concat(named, F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), text))), 256))


def _hashable(df: DataFrame, name: str) -> Column:
    """A column, or its JSON where it holds a map, which has no hash."""
    column = F.col(f"`{name}`")
    return F.to_json(F.struct(column)) if "map<" in df.schema[name].dataType.simpleString() else column


def keep_one_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row for each group of linked documents: that of the smallest doc_id.

    Groups are told apart by their sets, not by ids: different texts under one
    id, or under null ids, stay as far as their own groups go. A null id is
    chosen only where its whole group has none. Under one id the choice among
    linked texts is by a digest. Documents without words all stay; rows that
    repeat such a text under the same id are one row, those with null ids are
    documents of their own.
    """
    keep, number, key = fresh(docs, "kept_id", "nth", "document_key")
    named = docs.withColumn(key, document_key(F.col("doc_id"), F.col("text")))
    no_words = F.length(F.translate(F.coalesce("text", F.lit("")), SPACES, "")) == 0
    unnamed = F.col("doc_id").isNull() & no_words
    found = linked_rows(named.where(~unnamed).select("doc_id", "text", F.col(key).alias("key")), percent)
    first = found.where("root is not null").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first")).select(F.col("first.key").alias(keep))
    first = first.unionByName(found.where("root is null").select(F.col("key").alias(keep)).distinct())
    rows = named.where(~unnamed).join(first, F.col(key) == F.col(keep), "left_semi")
    others = [c for c in docs.columns if c != "doc_id"]
    order = Window.partitionBy(key).orderBy(F.xxhash64(*[_hashable(docs, c) for c in others]))
    rows = rows.withColumn(number, F.row_number().over(order)).where(F.col(number) == 1)
    columns = [f"`{c}`" for c in docs.columns]
    return rows.select(*columns).unionByName(docs.where(unnamed).select(*columns))
