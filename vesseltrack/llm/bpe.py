"""Byte-level BPE by a global distinct-word shuffle.

1. A map over documents cuts whole texts into pre-tokens and gathers *blocks*
   of documents. A block is a list of its different words, dealt into buckets
   by word hash, and for each document the places of its words: numbers into
   that list, the frequent words first, packed.
2. Words move to their bucket (one shuffle). There each distinct word of the
   whole corpus is encoded once, and its ids go back to every block that asked.
3. A block's word ids are joined with its places, which the same first shuffle
   has brought to the block's partition already (Spark reuses that exchange),
   and documents are reassembled by position. Decoding looks the ids up in the
   token-byte table (at most 2^20 tokens, checked) and reassembles likewise.

Words are counted once per block before the shuffle, so a frequent word is one
small row part per block, not one per occurrence. The first map must give the
same rows when a lost task is run again, so its input should be a stored table.

Edge cases: null and empty texts have no tokens; repeated rows and null ids are
documents like any other (nothing is joined by id); an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import zlib
from array import array
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vesseltrack.session import ship_package

from .common import map_arrow
from .cuts import all_blanks_stable, pieces

BLOCK_CHARS = 4 << 20  # its pieces and places are in memory at once
MAX_VOCABULARY = 1 << 20
CACHE_WORDS = 1_000_000
BUCKETS_PER_PARTITION = 3


@lru_cache(maxsize=2)
def read_ranks(path: str) -> tuple[dict, list]:
    """Token bytes to id, and id to token bytes, of a .tiktoken file."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}
    if len(ranks) > MAX_VOCABULARY:
        raise ValueError(f"{len(ranks)} tokens; the table is copied to every task, {MAX_VOCABULARY} at most")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("a byte is no token: not a byte-level vocabulary")
    table = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        table[i] = token
    return ranks, table


def encode_word(word: bytes, ranks: dict) -> list[int]:
    """Ids of one pre-token: always the pair with the lowest rank is merged, the leftmost of equals first."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    if n > 48:
        return _encode_long(word, ranks)
    parts = [word[i:i + 1] for i in range(n)]
    get, none = ranks.get, len(ranks) + MAX_VOCABULARY
    pair = [get(a + b, none) for a, b in zip(parts, parts[1:])]
    while pair:
        low = min(pair)
        if low == none:
            break
        i = pair.index(low)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pair[i]
        if i:
            pair[i - 1] = get(parts[i - 1] + parts[i], none)
        if i < len(pair):
            pair[i] = get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _encode_long(word: bytes, ranks: dict) -> list[int]:
    """The same with a heap over linked parts, for words of any length."""
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # a part starts at its index; end 0: merged away
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (r := ranks.get(word[i:end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[j]))

    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not j or j >= n or end[j] != stop:
            continue  # one of the two has been merged since
        end[i], end[j] = stop, 0
        if stop < n:
            before[stop] = i
            offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[word[i:end[i]]] for i in range(n) if end[i]]


def pack(numbers: np.ndarray) -> bytes:
    """Non-negative 32-bit numbers, byte by byte plane, deflated: small numbers take little."""
    a = np.ascontiguousarray(numbers, dtype="<u4")
    return zlib.compress(a.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class _Numbers(dict):
    """Numbers texts as they come; ``put`` takes each new one, behind ``before``."""

    def __init__(self, into: list, before: str):
        self.into, self.before = into, before

    def __missing__(self, part: str) -> int:
        self[part] = n = len(self.into)
        self.into.append(self.before + part)
        return n


class Block:
    """Documents of a block while they come in: their pieces by number."""

    def __init__(self):
        self.pieces: list[str] = []
        self.whole, self.behind = _Numbers(self.pieces, ""), _Numbers(self.pieces, " ")
        self.ids, self.places, self.chars = [], [], 0

    def add(self, doc_id, text: str) -> None:
        self.ids.append(doc_id)
        self.chars += len(text)
        parts = text.split(" ")
        if all_blanks_stable(text):
            at = [self.whole[parts[0]], *map(self.behind.__getitem__, parts[1:])] if text else []
        else:
            at = list(map(self.whole.__getitem__, pieces(text)))
        self.places.append(np.array(at, dtype=np.uint32))

    def rows(self, block: int, pattern, buckets: int) -> Iterable[dict]:
        """The words by bucket, then the places. The block is used up: what is done with is let go before more is made."""
        self.whole.clear()
        self.behind.clear()
        words, each, of = {}, array("i"), array("i")
        for piece in self.pieces:
            found = pattern.findall(piece)
            each.append(len(found))
            of.extend([words.setdefault(w, len(words)) for w in found])
        self.pieces.clear()
        each, of = np.array(each, dtype=np.int32), np.array(of, dtype=np.int32)
        piece_n = np.array([len(p) for p in self.places])
        at = np.concatenate(self.places)
        self.places.clear()
        n = each[at]  # words of each piece that comes
        per_doc = np.add.reduceat(np.append(n, 0), np.minimum(np.cumsum(piece_n) - piece_n, len(n))) * (piece_n > 0)
        ends = np.cumsum(n, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        start = np.cumsum(each, dtype=np.int64) - each
        flat = np.repeat(start[at] - (ends - n), n)
        del at, n, ends
        flat += np.arange(total)
        flat = of[flat]
        order = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), dtype=np.uint32)
        rank[order] = np.arange(len(words))
        spelled = [w.encode("utf-8", "surrogatepass") for w in words]
        words.clear()
        spelled = [spelled[i] for i in order]
        bucket = np.array([zlib.crc32(w) % buckets for w in spelled], dtype=np.int64)
        by = np.argsort(bucket, kind="stable")  # within a bucket the frequent words first, as in the whole list
        edge = np.flatnonzero(np.diff(bucket[by], prepend=-1))
        for lo, hi in zip(edge, [*edge[1:], len(by)]):
            mine = [spelled[i] for i in by[lo:hi]]
            yield {"route": -1 - int(bucket[by[lo]]), "block": block, "a": pack(np.array([len(w) for w in mine])),
                   "b": zlib.compress(b"".join(mine), 1)}
        yield {"route": block, "block": block, "a": pack(rank[flat]), "b": pack(bucket), "c": pack(per_doc), "ids": self.ids}


def _blocks(docs: DataFrame, pattern: str, buckets: int) -> DataFrame:
    """Rows of words (negative route: their bucket) and of places (route: the block)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        split = regex.compile(pattern)
        block, number, schema = Block(), 0, None

        def out():
            for row in block.rows((TaskContext.get().partitionId() << 24) | number, split, buckets):
                yield pa.RecordBatch.from_arrays([pa.array([row.get(f.name)], type=f.type) for f in schema], schema=schema)

        for b in batches:
            schema = schema or pa.schema([("route", pa.int64()), ("block", pa.int64()), ("a", pa.binary()), ("b", pa.binary()),
                                          ("c", pa.binary()), ("ids", pa.list_(b.schema.field(0).type))])
            for doc_id, text in zip(b.column(0), b.column(1)):
                block.add(doc_id.as_py(), text.as_py() or "")
                if block.chars >= BLOCK_CHARS:
                    yield from out()
                    block, number = Block(), number + 1
        if block.ids:
            yield from out()

    return map_arrow(docs.select("doc_id", "text"), run,
                     f"route bigint, block bigint, a binary, b binary, c binary, ids array<{kind}>")


def _words(lengths: bytes, joined: bytes) -> list[bytes]:
    ends = np.cumsum(unpack(lengths), dtype=np.int64).tolist()
    joined = zlib.decompress(joined)
    return [joined[a:b] for a, b in zip([0, *ends], ends)]


def _encoded_words(blocks: DataFrame, path: str) -> DataFrame:
    """block, bucket, tokens of each word, their ids; each distinct word of a bucket is encoded once."""
    def run(batches):
        ranks, _ = read_ranks(path)
        known: dict[bytes, list[int]] = {}
        for b in batches:
            for i in range(b.num_rows):
                if b.column(0)[i].as_py() >= 0:
                    continue  # places: they are read by the join
                if len(known) > CACHE_WORDS:
                    known.clear()
                counts, ids = [], []
                for w in _words(b.column(2)[i].as_py(), b.column(3)[i].as_py()):
                    got = known.get(w)
                    if got is None:
                        got = known[w] = encode_word(w, ranks)
                    counts.append(len(got))
                    ids += got
                yield pa.RecordBatch.from_arrays(
                    [b.column(1).slice(i, 1), pa.array([-1 - b.column(0)[i].as_py()], type=pa.int64()),
                     pa.array([pack(np.array(counts))], type=pa.binary()), pa.array([pack(np.array(ids))], type=pa.binary())],
                    ["route", "bucket", "n", "tokens"])

    return map_arrow(blocks, run, "route bigint, bucket bigint, n binary, tokens binary")


def _reassembled(joined: DataFrame, path: str, finish, columns: str) -> DataFrame:
    """Rows of documents from (a, b, c, ids, parts): ``finish`` makes the columns after doc_id and n_tokens."""
    def run(batches):
        _, table = read_ranks(path)
        for b in batches:
            for r in range(b.num_rows):
                a, buckets, per_doc, ids, parts = (b.column(k)[r] for k in range(2, 7))
                if not per_doc.is_valid:
                    continue  # words
                bucket = unpack(buckets.as_py())
                words: list = [None] * len(bucket)
                for part in parts.as_py() or ():  # a block of empty texts has none
                    ends = np.cumsum(unpack(part["n"]), dtype=np.int64).tolist()
                    tokens = unpack(part["tokens"]).tolist()
                    for i, lo, hi in zip(np.flatnonzero(bucket == part["bucket"]).tolist(), [0, *ends], ends):
                        words[i] = tokens[lo:hi]
                places = unpack(a.as_py())
                count = np.array([len(w) for w in words], dtype=np.int64)
                use = finish(words, table)
                ends = np.cumsum(unpack(per_doc.as_py()), dtype=np.int64).tolist()
                n, made = [], []
                for lo, hi in zip([0, *ends], ends):
                    at = places[lo:hi]
                    n.append(int(count[at].sum()))
                    made.append(use(at.tolist()))
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array(n, type=pa.int64()), *(pa.array(c) for c in zip(*made))],
                    ["doc_id", "n_tokens", *(x.split()[0] for x in columns.split(", "))])

    kind = joined.schema["ids"].dataType.elementType.simpleString()
    return map_arrow(joined.select("route", "block", "a", "b", "c", "ids", "parts"), run, f"doc_id {kind}, n_tokens bigint, {columns}")


def _digests(words: list, table: list):
    """ids and decoded bytes of a document as digests; a word's ids are looked up in the token-byte table once."""
    text = [",".join(map(str, w)).encode() for w in words]
    raw = [b"".join([table[i] for i in w]) for w in words]

    def use(at: list):
        return (hashlib.sha256(b",".join(map(text.__getitem__, at))).hexdigest(),
                hashlib.sha256(b"".join(map(raw.__getitem__, at))).hexdigest())
    return use


def _token_ids(words: list, table: list):
    def use(at: list):
        return (pa.scalar([i for k in at for i in words[k]], type=pa.list_(pa.int32())),)
    return use


def _encode(docs: DataFrame, path: str, pattern: str, finish, columns: str) -> DataFrame:
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = _blocks(docs, pattern, BUCKETS_PER_PARTITION * parts).repartition(parts, "route")
    words = _encoded_words(blocks, path).groupBy("route").agg(F.collect_list(F.struct("bucket", "n", "tokens")).alias("parts"))
    # both uses of ``blocks`` read all of its columns and rows, so that one exchange serves both
    return _reassembled(blocks.join(words, "route", "left"), path, finish, columns)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_tokens, tokens array<int>."""
    return _encode(docs, path, pattern, _token_ids, "tokens array<int>")


def encode_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (decimal ids, comma-joined), decoded_sha256 (decoded bytes)."""
    return _encode(docs, path, pattern, _digests, "ids_sha256 string, decoded_sha256 string")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (tokens array<int> and other columns) with the decoded bytes in place of the ids.

    A join of all ids with the token-byte table, which is in every task: one
    vectorised lookup per batch, then the bytes are joined row by row. Null
    token lists decode to null; an unknown id is an error.
    """
    ship_package(encoded.sparkSession)
    at = encoded.columns.index("tokens")

    def run(batches):
        tokens = pa.array(read_ranks(path)[1], type=pa.large_binary())
        for b in batches:
            out = []
            for ids in b.column(at):
                out.append(None if not ids.is_valid else b"".join(tokens.take(ids.values).to_pylist()))
            yield pa.RecordBatch.from_arrays([c if i != at else pa.array(out, type=pa.binary()) for i, c in enumerate(b.columns)],
                                             b.schema.names)

    schema = ", ".join(f"`{f.name}` {'binary' if i == at else f.dataType.simpleString()}" for i, f in enumerate(encoded.schema.fields))
    return encoded.mapInArrow(run, schema)
