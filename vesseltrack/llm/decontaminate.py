"""Benchmark decontamination with a generalised suffix automaton.

The words of all test items (normalised: A-Z lower-cased, split at every other
ASCII character that is no digit or lower-case letter) form one automaton.
A document is streamed through it word by word; the state gives the longest
suffix of the words read that is a substring of some item. Ten matched words
are a *window*; an item of fewer words is one window as a whole. Words inside
a window are hit.

Scale: documents are read once, in a map without a shuffle. An automaton holds
at most ``max_words`` item words (a documented bound on what is broadcast);
larger item tables are dealt into groups, a long item in overlapping parts (of all but
one word of a window) that carry its id; each group's automaton is built in a
task and written to the shared checkpoint folder. The groups are then broadcast
one after the other, never two at a time; the hit spans and items that a pass
finds are written by digest of the text, and all passes are merged and joined
to the document rows at the end. The number of groups follows the item table,
not the documents.

Edge cases: null or wordless texts have no words and no hits; null or wordless
items have no windows; items with equal words are all reported; an item row
without item_id counts for hits and item numbers as the empty id; an empty
item table hits nothing; repeated document rows are judged row by row.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vesseltrack.session import materialize, ship_package

from .common import fresh, map_arrow, with_field

WINDOW = 10
MAX_WORDS = 200_000

# Every byte that is no word byte becomes a blank, A-Z become a-z; UTF-8 bytes over 0x7F are word bytes.
_FOLD = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20
              for c in range(256))
_WORD = re.compile(rb"[^\x20]+")


def normalised_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


class ItemAutomaton:
    """Generalised suffix automaton over item words, with the items of each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window, self.vocab = window, {}
        seqs = [(i, [self.vocab.setdefault(w, len(self.vocab)) for w in ws]) for i, ws in items if ws]
        self.size = max(1, len(self.vocab))
        self.length, self.link, self.next = [0], [-1], {}
        self._out: list[list[int]] = [[]]
        for _, seq in seqs:
            last = 0
            for w in seq:
                last = self._extend(last, w)
        del self._out
        self._annotate(seqs)

    def _add(self, length: int, link: int, like: int | None = None) -> int:
        s = len(self.length)
        self.length.append(length)
        self.link.append(link)
        self._out.append([])
        for w in self._out[like] if like is not None else ():
            self._go(s, w, self.next[like * self.size + w])
        return s

    def _go(self, s: int, w: int, to: int) -> None:
        if s * self.size + w not in self.next:
            self._out[s].append(w)
        self.next[s * self.size + w] = to

    def _extend(self, last: int, w: int) -> int:
        known = self.next.get(last * self.size + w)
        if known is not None:  # an earlier item already has this substring
            return known if self.length[known] == self.length[last] + 1 else self._split(last, w, known)
        cur, p = self._add(self.length[last] + 1, 0), last
        while p != -1 and p * self.size + w not in self.next:
            self._go(p, w, cur)
            p = self.link[p]
        if p != -1:
            q = self.next[p * self.size + w]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return cur

    def _split(self, p: int, w: int, q: int) -> int:
        """The state of q's substrings that are no longer than p's plus one word."""
        s = self._add(self.length[p] + 1, self.link[q], like=q)
        self.link[q] = s
        while p != -1 and self.next.get(p * self.size + w) == q:
            self.next[p * self.size + w] = s
            p = self.link[p]
        return s

    def _annotate(self, seqs: list[tuple[str, list[int]]]) -> None:
        """For each state: the state of its window-long suffix, that window's items, and the short items it ends with."""
        order = sorted(range(len(self.length)), key=self.length.__getitem__)
        self.full = [-1] * len(self.length)
        for s in order[1:]:
            if self.length[s] >= self.window:
                up = self.link[s]
                self.full[s] = s if self.length[up] < self.window else self.full[up]
        self.window_items: dict[int, set[str]] = {}
        self.short_at: dict[int, dict[int, set[str]]] = {}
        self.shortest = self.window
        for item, seq in seqs:
            s = 0
            for j, w in enumerate(seq):
                s = self.next[s * self.size + w]
                if j >= self.window - 1:
                    self.window_items.setdefault(self.full[s], set()).add(item)
            if len(seq) < self.window:
                self.short_at.setdefault(s, {}).setdefault(len(seq), set()).add(item)
                self.shortest = min(self.shortest, len(seq))
        self.short_up = [-1] * len(self.length)  # nearest state, itself included, at which a short item ends
        for s in order:
            self.short_up[s] = s if s in self.short_at else self.short_up[self.link[s]] if s else -1

    def stream(self, words: list[int]) -> Iterator[tuple[int, int, set[str]]]:
        """(first word, word after the last, items) of every window that occurs in known words."""
        s = matched = 0
        nxt, size, link, length = self.next, self.size, self.link, self.length
        for j, w in enumerate(words):
            while s and s * size + w not in nxt:
                s = link[s]
                matched = length[s]
            to = nxt.get(s * size + w)
            if to is None:
                continue
            s, matched = to, matched + 1
            if matched >= self.window:
                yield j + 1 - self.window, j + 1, self.window_items[self.full[s]]
            t = self.short_up[s]
            while t >= 0:
                for n, items in self.short_at[t].items():
                    if n <= matched:
                        yield j + 1 - n, j + 1, items
                t = self.short_up[link[t]] if t else -1

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words are hit, and the items with occurring windows."""
        hit, found = np.zeros(len(words), dtype=bool), set()
        if not self.vocab or not words:
            return hit, found
        ids = np.fromiter(map(self.vocab.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        edge = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False])).astype(np.int8)))
        for a, b in edge.reshape(-1, 2):  # a window has item words only, so it lies in one run of them
            if b - a >= self.shortest:
                for x, y, items in self.stream(ids[a:b].tolist()):
                    hit[a + x:a + y] = True
                    found |= items
        return hit, found


def item_parts(items: DataFrame, window: int, most: int) -> DataFrame:
    """item, text: as they are, or in parts of at most ``most`` words, every window whole in one of them."""
    def run(batches):
        for b in batches:
            rows = []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = normalised_words(text) if text and len(text) > most else []
                if len(words) <= most:
                    rows.append((item, text))
                else:
                    rows += [(item, b" ".join(words[k:k + most]).decode("utf-8", "surrogatepass"))
                             for k in range(0, len(words) - window + 1, most - window + 1)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=pa.string()) for i in (0, 1)], ["item", "text"])

    return map_arrow(items, run, "item string, text string")


def item_automata(benchmark: DataFrame, window: int = WINDOW, max_words: int = MAX_WORDS) -> tuple[DataFrame, int]:
    """part, blob: pickled automata of the item table, each over at most about ``max_words`` words; the number of parts."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text"))
    items = item_parts(items, window, max(2 * window, max_words // 8))  # parts small enough to be dealt evenly
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    groups = max(1, -(-chars // (2 * max_words)))  # a word and its gap are two characters at least

    def build(pdf):
        import pandas as pd
        built = ItemAutomaton([(i, normalised_words(t)) for i, t in zip(pdf["item"], pdf["text"])], window)
        return pd.DataFrame({"part": [pdf["part"].iloc[0]], "blob": [pickle.dumps(built)]})

    ship_package(benchmark.sparkSession)
    dealt = items.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(groups)))
    return dealt.groupBy("part").applyInPandas(build, "part bigint, blob binary"), groups


def group_hits(docs: DataFrame, text: str, blobs: DataFrame, groups: int) -> DataFrame:
    """digest, found: for each different text with hits, the hit spans and items by group; one group is held at a time."""
    spark = docs.sparkSession
    blobs = materialize(blobs, "item-automata")
    texts = docs.select(text_digest(F.col(f"`{text}`")).alias("digest"), F.col(f"`{text}`"))
    passes = None
    for part in range(groups):
        row = blobs.where(F.col("part") == part).select("blob").first()
        if row is None:
            continue
        held = spark.sparkContext.broadcast(pickle.loads(row.blob))

        def run(batches, held=held):
            for b in batches:
                rows = []
                for d, t in zip(b.column(0), b.column(1)):
                    hit, found = held.value.scan(normalised_words(t.as_py()))
                    if found:
                        rows.append((d.as_py(), np.packbits(hit).tobytes(), sorted(found)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], type=k) for i, k in enumerate((pa.binary(), pa.binary(), pa.list_(pa.string())))],
                    ["digest", "bits", "items"])

        one = map_arrow(texts, run, "digest binary, bits binary, items array<string>").dropDuplicates(["digest"])
        one = materialize(one, "group-hits")
        held.destroy()
        passes = one if passes is None else passes.unionByName(one)
    if passes is None:
        return spark.createDataFrame([], "digest binary, found array<struct<bits: binary, items: array<string>>>")
    return passes.groupBy("digest").agg(F.collect_list(F.struct("bits", "items")).alias("found"))


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def mark(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW,
         max_words: int = MAX_WORDS) -> tuple[DataFrame, str]:
    """``docs`` and the name of a new column ``struct(n_words, n_hit, items, clean)``.

    ``items`` are the sorted ids of items with occurring windows; ``clean`` is
    the text without its hit words (null where nothing was hit).
    """
    blobs, groups = item_automata(benchmark, window, max_words)
    out, digest, found_by = fresh(docs, "hits", "text_digest", "found")
    at, width = docs.columns.index(text), len(docs.columns)
    kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                      ("clean", pa.string())])
    if groups == 1:
        row, rows_in = blobs.select("blob").first(), docs
        held = docs.sparkSession.sparkContext.broadcast(pickle.loads(row.blob) if row else ItemAutomaton([], window))
    else:
        held = None
        merged = group_hits(docs, text, blobs, groups).select(F.col("digest").alias(digest), F.col("found").alias(found_by))
        rows_in = docs.join(merged, text_digest(F.col(f"`{text}`")) == F.col(digest), "left").select(
            *[f"`{c}`" for c in docs.columns], f"`{found_by}`")

    def run(batches):
        for b in batches:
            rows = []
            for i, t in enumerate(b.column(at)):
                t = t.as_py()
                words = normalised_words(t)
                if held is not None:
                    hit, found = held.value.scan(words)
                else:
                    hit, found = np.zeros(len(words), dtype=bool), set()
                    for g in b.column(width)[i].as_py() or ():
                        hit |= np.unpackbits(np.frombuffer(g["bits"], dtype=np.uint8), count=len(words)).astype(bool)
                        found |= set(g["items"])
                rows.append({"n_words": len(words), "n_hit": int(hit.sum()), "items": sorted(found),
                             "clean": without(t, hit) if found else None})
            yield pa.RecordBatch.from_arrays([*b.columns[:width], pa.array(rows, type=kind)], [*b.schema.names[:width], out])

    schema = with_field(docs, out, "n_words bigint, n_hit bigint, items array<string>, clean string")
    ship_package(docs.sparkSession)
    return rows_in.mapInArrow(run, schema), out


def without(text: str, hit: np.ndarray) -> str:
    """The text without its hit words and what stands between two hit words."""
    raw = text.encode("utf-8", "surrogatepass")
    spans = [m.span() for m in _WORD.finditer(raw.translate(_FOLD))]
    kept, at = [], 0
    edge = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
    for a, b in edge.reshape(-1, 2):
        kept.append(raw[at:spans[a][0]])
        at = spans[b - 1][1]
    return b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    marked, hits = mark(docs.select("doc_id", "text"), benchmark, window=window)
    h = F.col(hits)
    return marked.select("doc_id", h["n_words"].alias("n_words"), h["n_hit"].alias("n_hit"),
                         F.size(h["items"]).cast("long").alias("n_items"),
                         F.sha2(F.array_join(h["items"], ","), 256).alias("items_sha256"),
                         (h["n_hit"] > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, max_coverage: float = 0.5, min_span: int = 1,
                  window: int = WINDOW) -> DataFrame:
    """``docs`` without benchmark passages.

    A document of which more than ``max_coverage`` of the words are hit goes;
    from others the hit spans go when they have ``min_span`` hit words in all
    or more. ``n_chars``, where present, is brought up to date.
    """
    marked, hits = mark(docs, benchmark, window=window)
    h = F.col(f"`{hits}`")
    cut = h["n_hit"] >= F.lit(min_span)
    kept = marked.where((h["n_hit"] <= F.lit(max_coverage) * h["n_words"]) | ~cut)
    new = {"text": F.when(cut & h["clean"].isNotNull(), h["clean"]).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(cut & h["clean"].isNotNull(), F.length(h["clean"]).cast(docs.schema["n_chars"].dataType)
                                ).otherwise(F.col("n_chars"))
    return kept.withColumns(new).select(*[f"`{c}`" for c in docs.columns])


ORACLE_CONTAMINATION = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
iw AS (
  SELECT item, least(10, len(ws)) AS n, unnest(range(0, len(ws) - least(10, len(ws)) + 1)) AS k, ws FROM i WHERE len(ws) > 0),
win AS (SELECT DISTINCT item, n, list_slice(ws, k + 1, k + n) AS win FROM iw),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, ws, n, unnest(range(0, len(ws) - n + 1)) AS k FROM w JOIN sizes ON len(ws) >= n),
occ AS (SELECT doc_id, k, n, item FROM (SELECT doc_id, k, n, list_slice(ws, k + 1, k + n) AS win FROM dw) d JOIN win USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM occ) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
