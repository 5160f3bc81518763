"""Prefix trie of conversations, built as a burst trie.

1. *Turn ids*: a turn (role, text) becomes 20 bytes, a digest and the UTF-8
   length of its text, so a conversation is a byte string in which a prefix of
   turns is a prefix of bytes. Rows are dealt by ranges of (conv_id, turn), so a
   conversation of very many turns is put in order and packed by several tasks.
2. *Distinct sequences*: equal rebuilt conversations become one row with their
   number, smallest id and the digest of their ids. Ids are packed into blocks
   by ranges of (sequence, id); one task then hashes a sequence's blocks one at
   a time.
3. *Bursting*: all sequences start in the container of the root. A container of
   more than ``most`` different sequences becomes a head, and its sequences move
   to the containers of their next turn, until none is too large: a round of one
   grouped count and one join with the few heads for each level (so as many
   rounds as the longest beginning that more than ``most`` sequences share).
4. *Sweep*: containers are dealt to tasks, sorted, and read once with a stack of
   open nodes. The heads are then summed from their children, level by level.

Edge cases: rows with a null conv_id belong to no conversation; null turns come
first, and turns of equal number are ordered by digest; a null role or text is
empty; repeated rows are turns of their own; a conversation left without turns
is a member of the root alone; an empty table has no nodes, not even a root. A
conversation's ids (20 bytes a turn) must fit a row.
"""

from __future__ import annotations

import hashlib
import itertools

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vesseltrack.operators.joins import maybe_broadcast
from vesseltrack.session import materialize

from .common import map_arrow

WIDTH = 20
BORROWED = 8  # most turns taken from another conversation
CONTAINER_SEQUENCES = 200
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_id() -> Column:
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    name = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    return F.concat(name, F.unhex(F.lpad(F.hex(F.octet_length(text).cast("long")), 8, "0")))


def prefix(seq: str, depth: int) -> Column:
    return F.substring(F.col(seq), 1, depth * WIDTH)


def prefix_key(seq: str, depth: int) -> Column:
    return F.unhex(F.md5(prefix(seq, depth)))


def _runs(column: pa.Array):
    """(first row, row after the last) of runs of equal values."""
    values = column.to_pylist()
    start = 0
    for i in range(1, len(values) + 1):
        if i == len(values) or values[i] != values[start]:
            yield start, i
            start = i


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and the turn ids of each conversation in order of its turns."""
    def pack(batches):
        for b in batches:
            first = list(_runs(b.column("conv_id")))
            ids = b.column("id").to_pylist()
            at = pa.array([s for s, _ in first], type=pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id").take(at), b.column("turn").take(at), b.column("id").take(at),
                 pa.array([b"".join(ids[s:e]) for s, e in first], type=pa.binary())], ["conv_id", "turn", "id", "ids"])

    def join(batches):
        conv, parts = None, []
        for b in batches:
            out, ids = [], b.column("ids").to_pylist()
            for c, x in zip(b.column("conv_id").to_pylist(), ids):
                if c != conv and parts:
                    out.append((conv, b"".join(parts)))
                    parts = []
                conv = c
                parts.append(x)
            yield _columns(out, ("conv_id", pa.int64()), ("ids", pa.binary()))
        if parts:
            yield _columns([(conv, b"".join(parts))], ("conv_id", pa.int64()), ("ids", pa.binary()))

    rows = turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), turn_id().alias("id"))
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("id")]
    packed = map_arrow(rows.repartitionByRange(*order).sortWithinPartitions(*order), pack, "conv_id long, turn long, id binary, ids binary")
    return map_arrow(packed.repartition("conv_id").sortWithinPartitions(*order), join, "conv_id long, ids binary")


def _columns(rows: list[tuple], *fields) -> pa.RecordBatch:
    parts = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(p, type=t) for p, (_, t) in zip(parts, fields)], [n for n, _ in fields])


def rebuild(convs: DataFrame) -> DataFrame:
    """conv_id and seq: the first h turns of conversation c-c%5, then its own after the first h; h = crc32(c) % 9."""
    bases = convs.select(F.col("conv_id").alias("base"), prefix("ids", BORROWED).alias("start"))
    own = convs.withColumn("base", F.expr("conv_id - conv_id % 5")).withColumn("h", F.expr("int(crc32(cast(conv_id as string)) % 9)"))
    return own.join(bases, "base", "left").select(
        "conv_id", F.expr(f"concat(substring(coalesce(start, X''), 1, h * {WIDTH}), substring(ids, h * {WIDTH} + 1))").alias("seq"))


def distinct_sequences(rebuilt: DataFrame) -> DataFrame:
    """seq, its smallest conv_id, the number of its conversations and the digest of their ids."""
    def pack(batches):
        for b in batches:
            first = list(_runs(b.column("key")))
            ids = b.column("conv_id").to_pylist()
            at = pa.array([s for s, _ in first], type=pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("key").take(at), b.column("seq").take(at), b.column("conv_id").take(at),
                 pa.array([e - s for s, e in first], type=pa.int64()),
                 pa.array([",".join(map(str, ids[s:e])) for s, e in first])], ["key", "seq", "conv_id", "n", "listed"])

    fields = (("seq", pa.binary()), ("conv_id", pa.int64()), ("n", pa.int64()), ("ends", pa.string()))

    def digest(batches):
        key = seq = low = None
        total, sha = 0, hashlib.sha256()
        for b in batches:
            out = []
            for k, s, c, n, listed in zip(*(b.column(i).to_pylist() for i in range(5))):
                if k != key:
                    if total:
                        out.append((seq, low, total, sha.hexdigest()))
                    key, seq, low, total, sha = k, s, c, 0, hashlib.sha256()
                sha.update((b"," if total else b"") + listed.encode())
                total += n
            yield _columns(out, *fields)
        if total:
            yield _columns([(seq, low, total, sha.hexdigest())], *fields)

    keyed = rebuilt.select(F.unhex(F.md5("seq")).alias("key"), "seq", "conv_id")
    packed = map_arrow(keyed.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id"), pack,
                       "key binary, seq binary, conv_id long, n long, listed string")
    return map_arrow(packed.repartition("key").sortWithinPartitions("key", "conv_id"), digest,
                     "seq binary, conv_id long, n long, ends string")


def burst(sequences: DataFrame, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """Sequences with the depth at which their container rests, and by level the sequences that end at a head."""
    resting, ending, depth = [], [], 0
    rest = materialize(sequences, "trie-sequences")
    while True:
        keyed = rest.withColumn("key", prefix_key("seq", depth))
        large = materialize(keyed.groupBy("key").count()
                            .where(F.col("count") > most).select("key", F.lit(True).alias("large")), "trie-heads")
        if large.isEmpty():
            resting.append(rest.withColumn("depth", F.lit(depth)))
            break
        marked = keyed.join(maybe_broadcast(large), "key", "left").drop("key")
        resting.append(marked.where(F.col("large").isNull()).drop("large").withColumn("depth", F.lit(depth)))
        ending.append(marked.where(F.col("large") & (F.length("seq") == depth * WIDTH)).drop("large"))
        rest = materialize(marked.where(F.col("large") & (F.length("seq") > depth * WIDTH)).drop("large"), "trie-burst")
        depth += 1
    out = resting[0]
    for df in resting[1:]:
        out = out.unionByName(df)
    return out, ending


class _Node:
    __slots__ = ("conv", "n", "children", "leaves", "saved", "ends", "size", "below")

    def __init__(self, conv, size):
        self.conv, self.n, self.children, self.leaves, self.saved = conv, 0, 0, 0, 0
        self.ends, self.size, self.below = NO_ENDS, size, []


def sweep(rows):
    """(container key, depth, seq, conv_id, n, ends) sorted by key and seq to node rows; a container's head comes with its prefix.

    ``stack[i]`` is the open node at depth ``top + i``. A node's row waits in its
    parent's ``below`` until the parent closes and its smallest member is known.
    """
    stack, top, last, key = [], 0, b"", None

    def close(keep):
        while len(stack) > keep:
            x, depth = stack.pop(), top + len(stack)
            x.leaves = x.leaves if x.children else 1
            x.saved += (x.n - 1) * x.size
            for row in x.below:
                row[2] = x.conv
                yield row
            row = [x.conv, depth, None, x.n, x.children, x.leaves, x.saved, x.ends, None]
            if stack:
                up = stack[-1]
                up.conv, up.n, up.children = min(up.conv, x.conv), up.n + x.n, up.children + 1
                up.leaves, up.saved = up.leaves + x.leaves, up.saved + x.saved
                up.below.append(row)
            else:
                row[8] = last[:top * WIDTH]
                yield row

    for k, depth, seq, conv, n, ends in rows:
        if k != key:
            yield from close(0)
            key, top = k, depth
            common = top
            stack.append(_Node(conv, int.from_bytes(seq[top * WIDTH - 4:top * WIDTH], "big") if top else 0))
        else:
            common, most = top, min(len(seq), len(last)) // WIDTH
            while common < most and seq[common * WIDTH:(common + 1) * WIDTH] == last[common * WIDTH:(common + 1) * WIDTH]:
                common += 1
            yield from close(common - top + 1)
        for d in range(common + 1, len(seq) // WIDTH + 1):
            stack.append(_Node(conv, int.from_bytes(seq[d * WIDTH - 4:d * WIDTH], "big")))
        x = stack[-1]
        x.conv, x.n, x.ends = min(x.conv, conv), x.n + n, ends
        last = seq
    yield from close(0)


def _swept(contained: DataFrame) -> DataFrame:
    kinds = [pa.int64()] * 7 + [pa.string(), pa.binary()]
    names = [f.split()[0] for f in NODE.split(", ")] + ["head"]

    def run(batches):
        rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(6))))
        nodes = sweep(rows)
        while some := list(itertools.islice(nodes, 10_000)):
            yield _columns(some, *zip(names, kinds))

    keyed = contained.select(F.unhex(F.md5(F.expr(f"substring(seq, 1, depth * {WIDTH})"))).alias("key"), "depth", "seq", "conv_id", "n", "ends")
    return map_arrow(keyed.repartition("key").sortWithinPartitions("key", "depth", "seq"), run, f"{NODE}, head binary")


def _summed_heads(children: DataFrame, ending: DataFrame, depth: int) -> DataFrame:
    """Node rows (with their prefix) of the heads of one level, from the nodes right below and the sequences that end there."""
    parts = children.select(prefix("head", depth).alias("head"), "conv_id", "n_convs", F.lit(1).cast("long").alias("one"), "n_leaves",
                            "saved_tokens", F.lit(None).cast("string").alias("ends")).unionByName(
        ending.select(F.col("seq").alias("head"), "conv_id", F.col("n").alias("n_convs"), F.lit(0).cast("long").alias("one"),
                      F.lit(0).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), "ends"))
    size = F.conv(F.hex(F.substring(F.col("head"), depth * WIDTH - 3, 4)), 16, 10).cast("long") if depth else F.lit(0).cast("long")
    return (parts.groupBy("head").agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("one").alias("n_children"),
                                      F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"), F.max("ends").alias("ends"))
            .select("conv_id", F.lit(depth).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
                    "n_leaves", (F.col("below") + (F.col("n_convs") - 1) * size).alias("saved_tokens"),
                    F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"), "head"))


def prefix_trie(turns: DataFrame, most: int = CONTAINER_SEQUENCES) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (conv_id, turn, role, text; further columns are not read).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256.
    """
    columns = [f.split()[0] for f in NODE.split(", ")]
    convs = materialize(conversations(turns.select("conv_id", "turn", "role", "text")), "trie-conversations")
    contained, ending = burst(distinct_sequences(rebuild(convs)), most)
    swept = materialize(_swept(contained), "trie-nodes")
    tops = swept.where(F.col("head").isNotNull())
    out, above = swept.where(F.col("head").isNull()).select(columns), None
    heads = {}
    for depth in reversed(range(len(ending))):
        children = tops.where(F.col("depth") == depth + 1)
        if depth + 1 in heads:
            children = children.unionByName(heads[depth + 1])
        heads[depth] = materialize(_summed_heads(children, ending[depth], depth), "trie-heads")
    for depth in range(len(ending) + 1):
        level = tops.where(F.col("depth") == depth)
        if depth in heads:
            level = level.unionByName(heads[depth])
        if depth:
            above = maybe_broadcast(heads[depth - 1].select(F.col("head").alias("up"), F.col("conv_id").alias("up_conv")))
            level = level.join(above, prefix("head", depth - 1) == F.col("up"), "left").withColumn("parent_conv_id", F.col("up_conv"))
        out = out.unionByName(level.select(columns))
    return out


# DuckDB has no crc32, so it is spelled out bit by bit; a turn is its length-delimited role and text.
ORACLE_TRIE = """
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT c, list(length(role)::VARCHAR || ':' || role || text ORDER BY i) AS seq,
         list(strlen(text) ORDER BY i) AS sizes,
         xor(4294967295, list_reduce(
           list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda a, x: list_reduce(list_concat([xor(a, x)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                 lambda b, y: xor(b >> 1, 3988292384 * (b & 1))))) % 9 AS h
  FROM t GROUP BY c),
r AS (
  SELECT o.c, list_concat(coalesce(b.seq, [])[1:o.h], o.seq[o.h + 1:]) AS seq,
         list_concat(coalesce(b.sizes, [])[1:o.h], o.sizes[o.h + 1:]) AS sizes
  FROM own o LEFT JOIN own b ON b.c = o.c - o.c % 5),
m AS (
  SELECT r.c, d.d, r.seq[1:d.d] AS p, CASE WHEN d.d > 0 THEN r.seq[1:d.d - 1] END AS up, coalesce(sizes[d.d], 0) AS size, len(seq) = d.d AS ends
  FROM r, unnest(range(len(seq) + 1)) d(d)),
n AS (
  SELECT p, d, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS own_saved,
         sha256(coalesce(string_agg(CASE WHEN ends THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256
  FROM m GROUP BY p, d),
k AS (SELECT up AS p, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
a AS (
  SELECT n.p[1:e.e] AS p, e.e AS d, sum(n.own_saved) AS saved_tokens, count(*) FILTER (WHERE k.n_children IS NULL) AS n_leaves
  FROM n LEFT JOIN k ON k.p = n.p AND k.d = n.d, unnest(range(n.d + 1)) e(e) GROUP BY ALL)
SELECT n.conv_id, n.d::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
       a.n_leaves, a.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN a ON a.p = n.p AND a.d = n.d LEFT JOIN k ON k.p = n.p AND k.d = n.d LEFT JOIN n u ON u.p = n.up AND u.d = n.d - 1
"""
