"""Token counts of whole texts, exactly as the tokenizer library gives them.

A text may be cut at a *stable boundary* (``cuts``): a blank between two visible
characters or, inside the chunks of long texts, also a place where a letter, a
number and a mark of punctuation meet. The tokens left and right of it are
independent.

* Texts up to ``long_chars``: cut at every stable boundary; a worker has each
  different piece counted by the library once and adds the counts up.
* Longer texts: overlapping chunks with offsets, dealt over the cluster as
  rows, so one huge document is the work of many tasks. Each chunk is encoded
  with offsets; neighbours are spliced at a stable boundary in their overlap
  at which both encodings start a token. Where an overlap has none, that
  document is cut again with eight times the overlap, in the end as a whole.

Edge cases: null and empty texts have no tokens; repeated rows are counted row
by row (long texts are followed by content hash, not by id, so null or repeated
ids do no harm); special strings in a text are handled as the library does by
default (they hold no blank, so no blank inside one is a cut; class borders are
used only with overlaps that hold the longest of them).
"""

from __future__ import annotations

import bisect
import json
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vesseltrack.session import materialize

from .common import map_arrow, text_bytes
from .cuts import all_blanks_stable, class_border, pieces, stable

LONG_CHARS = 32_768
CHUNK_CHARS = 16_384
OVERLAP_CHARS = 512
WIDEN = 8
TOKEN_LIMIT = 512
CACHE_PIECES = 200_000


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core for each task
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    pre = json.loads(tok.to_str())
    if pre["normalizer"] or (pre["pre_tokenizer"] or {}).get("type") != "ByteLevel" or pre["pre_tokenizer"]["add_prefix_space"]:
        raise ValueError("stable boundaries are proven for byte-level BPE without normalizer and prefix blank only")
    return tok


class PieceCounter:
    """Tokens of texts, each different piece encoded once as long as the cache has room."""

    def __init__(self, path: str):
        self.tok, self.known, self.after_blank = _tokenizer(path), {}, {}

    def __call__(self, texts: list[str]) -> list[int]:
        if len(self.known) > CACHE_PIECES:
            self.known.clear()
            self.after_blank.clear()
        # (pieces to look up as they are, pieces to look up behind a blank)
        cut = [(parts[:1], parts[1:]) if (parts := t.split(" ")) and all_blanks_stable(t) else (pieces(t), []) for t in texts]
        self._learn(self.known, {p for whole, _ in cut for p in whole}, "")
        self._learn(self.after_blank, set().union(*(rest for _, rest in cut)), " ")
        one, other = self.known.__getitem__, self.after_blank.__getitem__
        return [sum(map(one, whole)) + sum(map(other, rest)) for whole, rest in cut]

    def _learn(self, known: dict, found: set, before: str) -> None:
        new = list(found.difference(known))
        for at in range(0, len(new), 4096):
            part = new[at:at + 4096]
            for p, e in zip(part, self.tok.encode_batch_fast([before + p for p in part], add_special_tokens=False)):
                known[p] = len(e)


@lru_cache(maxsize=2)
def _counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def _groups(texts: list[str], most: int = 1 << 20):
    """Runs of texts with about ``most`` characters in all."""
    start = n = 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= most:
            yield texts[start:i + 1]
            start, n = i + 1, 0
    if start < len(texts):
        yield texts[start:]


def count_short(df: DataFrame, path: str) -> DataFrame:
    """``df`` (columns n_bytes, text and any number before) with n_tokens in place of text."""
    at = df.columns.index("text")

    def run(batches):
        for b in batches:
            texts = [t or "" for t in b.column(at).to_pylist()]
            n = [x for group in _groups(texts) for x in _counter(path)(group)]
            yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(n, type=pa.int64())],
                                             [*b.schema.names[:at], "n_tokens"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[:at])
    return map_arrow(df, run, f"{kept}, n_tokens bigint")


def chunks(text: str, size: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of chunks; each but the last runs ``overlap`` characters into the next."""
    if overlap >= len(text):
        return [(0, len(text))]
    size = max(size, overlap)
    starts = list(range(0, max(1, len(text) - overlap), size))
    return [(s, min(len(text), s + size + overlap) if i + 1 < len(starts) else len(text))
            for i, s in enumerate(starts)]


def longest_special(path: str) -> int:
    """Characters of the longest string that the library takes as one token wherever it stands."""
    return max((len(t["content"]) for t in json.loads(_tokenizer(path).to_str())["added_tokens"]), default=0)


def encode_chunks(parts: DataFrame, path: str, borders: bool = True) -> DataFrame:
    """One row per chunk: its stable token starts in its head and tail overlap, with the token numbers there.

    ``borders``: class borders count too. They may fall inside a special string, so
    the overlap must hold the longest of them: one of two neighbours then sees it
    whole and has no token start there.

    ``parts``: key, part, start, stop, head, text (``head``: characters shared with the chunk before).
    Result: key, part, n (tokens), and lists of (place in the document, tokens before it) for
    ``opens`` (in the shared head) and ``closes`` (in the shared tail).
    """
    pair = pa.list_(pa.struct([("at", pa.int64()), ("before", pa.int64())]))
    schema = pa.schema([("key", pa.string()), ("part", pa.int32()), ("n", pa.int64()), ("opens", pair), ("closes", pair)])

    def run(batches):
        for b in batches:
            rows = {f.name: [] for f in schema}
            for r in b.to_pylist():
                text, start = r["text"], r["start"]
                e = _tokenizer(path).encode(text, add_special_tokens=False)
                first = [a for a, _ in e.offsets]
                # one character can be several tokens with the same offset: the first of them counts

                def bounds(lo: int, hi: int) -> list[dict]:
                    out = []
                    for p in range(max(lo, 0), min(hi, len(text))):
                        if stable(text, p) or borders and class_border(text, p):
                            k = bisect.bisect_left(first, p)
                            if k < len(first) and first[k] == p:
                                out.append({"at": start + p, "before": k})
                    return out

                rows["key"].append(r["key"])
                rows["part"].append(r["part"])
                rows["n"].append(len(e))
                rows["opens"].append(bounds(0, r["head"]))
                rows["closes"].append(bounds(len(text) - r["tail"], len(text)) if r["tail"] else [])
            yield pa.RecordBatch.from_arrays([pa.array(rows[f.name], type=f.type) for f in schema], schema=schema)

    return map_arrow(parts, run, "key string, part int, n bigint, opens array<struct<at:bigint,before:bigint>>, "
                                 "closes array<struct<at:bigint,before:bigint>>")


def splice(encoded: DataFrame) -> DataFrame:
    """key, n_tokens (null where a pair of neighbours has no common boundary).

    Joins each chunk with the next by (key, part) and takes the first place in
    the overlap at which both start a token: left of it the left chunk's tokens
    count, from it on the right one's.
    """
    left = encoded.select("key", "part", "n", "closes")
    right = encoded.select("key", (F.col("part") - 1).alias("part"), F.col("opens").alias("r_opens"))
    both = left.join(right, ["key", "part"], "left")
    common = F.array_min(F.transform(
        F.filter("closes", lambda c: F.exists("r_opens", lambda o: o["at"] == c["at"])),
        lambda c: F.struct(c["at"].alias("at"), c["before"].alias("before"),
                           F.element_at(F.filter("r_opens", lambda o: o["at"] == c["at"]), 1)["before"].alias("skip"))))
    cut = both.withColumn("cut", common)
    last = F.col("r_opens").isNull()
    return cut.groupBy("key").agg(
        F.sum(F.when(last, F.col("n")).otherwise(F.col("cut")["before"] - F.col("cut")["skip"])).alias("s"),
        F.max(~last & F.col("cut").isNull()).alias("failed")).select(
        "key", F.when(~F.col("failed"), F.col("s")).alias("n_tokens"))


def count_long(texts: DataFrame, path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """key, n_tokens of long texts (columns key, text; keys differ)."""
    part = "key string, part int, start bigint, head bigint, tail bigint, text string"
    kind = pa.schema([("key", pa.string()), ("part", pa.int32()), ("start", pa.int64()), ("head", pa.int64()),
                      ("tail", pa.int64()), ("text", pa.string())])

    def cutter(width: int):
        def run(batches):
            for b in batches:
                for i in range(b.num_rows):
                    key, text = b.column(0)[i].as_py(), b.column(1)[i].as_py()
                    spans = chunks(text, chunk, width)
                    for k, (s, e) in enumerate(spans):  # a batch for each chunk: no copy of the whole text in overlaps
                        head = spans[k - 1][1] - s if k else 0
                        tail = e - spans[k + 1][0] if k + 1 < len(spans) else 0
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([v], type=f.type) for v, f in zip((key, k, s, head, tail, text[s:e]), kind)],
                            schema=kind)
        return run

    done, longest = None, longest_special(path)
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = overlap
    todo = texts
    while True:
        # a fixed number of parts: chunks are small to move and long to encode, so Spark would put too many into a task
        cut = map_arrow(todo, cutter(width), part).repartition(tasks, "key", "part")
        # encoded once and stored: the splice reads the few numbers of each chunk twice
        counted = materialize(splice(materialize(encode_chunks(cut, path, width >= longest), "token-chunks")), "token-splices")
        good = counted.where(F.col("n_tokens").isNotNull())
        done = good if done is None else done.unionByName(good)
        failed = counted.where(F.col("n_tokens").isNull()).select("key")
        if failed.isEmpty():
            return done
        todo, width = todo.join(failed, "key", "left_semi"), width * WIDEN


def count_tokens(docs: DataFrame, path: str, limit: int = TOKEN_LIMIT, long_chars: int = LONG_CHARS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens, over_limit."""
    base = docs.select("doc_id", text_bytes(F.col("text")).alias("n_bytes"), "text")
    is_long = F.coalesce(F.length("text"), F.lit(0)) > F.lit(long_chars)
    short = count_short(base.where(~is_long), path)
    big = base.where(is_long).withColumn("key", F.sha2("text", 256))
    big_counts = count_long(big.groupBy("key").agg(F.first("text").alias("text")), path)
    long = big.select("doc_id", "n_bytes", "key").join(big_counts, "key").select("doc_id", "n_bytes", "n_tokens")
    return short.unionByName(long).withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
