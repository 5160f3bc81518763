"""Groups of spelling variants: words one error apart, found with bidirectional FM-indexes.

1. *Vocabulary*: runs of letters of all texts, counted in tasks before the shuffle.
2. *Shards*: words one error apart share the first or the second half of either.
   A key is the beginning (or, on the reversed word, the end) of a word, of 3 to 5
   letters by its length and no longer than its half; a word stands in the index
   under the keys that a word one letter shorter, equal or longer searches.
   Keys are dealt to buckets by hash; a task builds an index for every
   ``INDEX_WORDS`` words of its bucket (a word counts once for every 16 letters). A
   key with more words than that is cut into chunks, each with its own index, and
   its patterns are searched in all of them.
3. *Search* (``variant_index``): match one half exactly, extend over the other
   with one error. A word that shares both halves' keys is counted by the first
   search only. Tasks return one row per searched word: how many near words, and
   the most frequent.
4. *Roots*: forms are at least ten times as frequent, so a chain is short; pointers
   are doubled until none moves.

Edge cases: null texts have no words; a null doc_id counts as an empty one in the
name that decides deletions; repeated rows count again; an empty table gives no
rows; further columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vesseltrack.operators.joins import maybe_broadcast
from vesseltrack.session import materialize, ship_package

from .common import ASCII_LOWER, ASCII_UPPER, batch, map_arrow
from .variant_index import START, Index, near

MIN_LETTERS, MIN_COUNT, FORM_RATIO = 7, 2, 10
ONE_IN = 31  # runs that lose a letter
COUNTED_WORDS = 200_000  # kept by a task before it sends its counts on
BUCKET_WORDS, INDEX_WORDS = 12_000, 10_000
WORD_LETTERS = 16  # a longer word counts as several
LOWER = bytes.maketrans(ASCII_UPPER.encode(), ASCII_LOWER.encode())
RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % MIN_LETTERS)  # shorter runs give no word


def vocabulary(docs: DataFrame) -> DataFrame:
    """word and n, its occurrences in all texts (doc_id, text), of words long and frequent enough."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches):
        counts = Counter()
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not text:
                    continue
                name = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for w, n in Counter(RUN.findall(text.encode().translate(LOWER).decode())).items():
                    h = zlib.crc32(w.encode(), name)
                    if h % ONE_IN == 0:
                        w = w[:h % len(w)] + w[h % len(w) + 1:]
                        if len(w) < MIN_LETTERS:
                            continue
                    counts[w] += n
                if len(counts) > COUNTED_WORDS:
                    yield batch(schema, word=list(counts), n=list(counts.values()))
                    counts.clear()
        yield batch(schema, word=list(counts), n=list(counts.values()))

    parts = map_arrow(docs.select("doc_id", "text"), run, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def _key_letters(length):
    return F.when(length <= 8, 3).when(length <= 12, 4).otherwise(5)


def shards(words: DataFrame, bucket_words: int, index_words: int) -> DataFrame:
    """shard, key, word (reversed on the side of endings), n, side, indexed, searched: what every task holds."""
    size = F.char_length("word")
    sides = words.select("n", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("word")),
                                                F.struct(F.lit(1).alias("side"), F.reverse("word").alias("word")))).alias("s")).select("n", "s.*")
    own = _key_letters(size)
    keyed = sides.withColumn("letters", F.explode(F.array_distinct(F.array(_key_letters(size - 1), own, _key_letters(size + 1))))).select(
        "side", "word", "n", F.substring("word", F.lit(1), F.col("letters")).alias("key"), (F.col("letters") == own).alias("searched"))
    counted = materialize(keyed.groupBy("side", "key").agg(F.sum(F.ceil(F.char_length("word") / WORD_LETTERS)).alias("words")), "variant-keys")
    total = counted.agg(F.sum("words")).first()[0] or 0
    buckets = max(1, -(-total // bucket_words))
    hot = counted.where(F.col("words") > index_words).select("side", "key", F.ceil(F.col("words") / index_words).cast("int").alias("chunks"))
    dealt = keyed.join(maybe_broadcast(hot), ["side", "key"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    bucket, own_chunk = F.pmod(F.xxhash64("side", "key"), F.lit(buckets)), F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int")
    places = F.when(F.col("searched"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array(own_chunk))
    return (dealt.withColumn("chunk", F.explode(places))
            .select(F.when(F.col("chunks") > 1, F.xxhash64("side", "key", "chunk")).otherwise(bucket).alias("shard"), "key", "word", "n", "side",
                    (F.col("chunk") == own_chunk).alias("indexed"), "searched"))


FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())])


def _symbols(words: list[str]) -> tuple[list[np.ndarray], int]:
    """Each word as numbers above START, in an alphabet of the letters that occur."""
    text = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
    known, numbers = np.unique(text, return_inverse=True)
    return np.split(numbers + START + 1, np.cumsum([len(w) for w in words])[:-1]), len(known) + START + 1


def search(words: list[str], n: list[int], side: list[int], indexed: list[bool], searched: list[bool]):
    """(word, n_near, n and text of the most frequent near word) for the searched words of one index, by one side's search."""
    text = [i for i, x in enumerate(indexed) if x]
    asked = [i for i, x in enumerate(searched) if x]
    if not text or not asked:
        return
    coded, symbols = _symbols(words)
    # the side of endings holds the longer half, so that the two halves make up the word
    halves = np.array([(len(words[i]) + side[i]) // 2 for i in asked])
    pattern, hit = near(Index([coded[i] for i in text], symbols), [coded[i] for i in asked], halves)
    best = {}
    for p, w in zip(pattern.tolist(), hit.tolist()):
        i, j = asked[p], text[w]
        a, b = words[i], words[j]
        if side[i]:
            a, b = a[::-1], b[::-1]
            if b.startswith(a[:len(a) // 2]):
                continue  # counted by the search from the first half
        count, top = best.get(a, (0, None))
        own = (-n[j], b)
        best[a] = count + 1, own if top is None or own < top else top
    for a, (count, (minus, b)) in best.items():
        yield a, count, -minus, b


def near_words(words: DataFrame, bucket_words: int = BUCKET_WORDS, index_words: int = INDEX_WORDS) -> DataFrame:
    """word, n_near, near_n, near: of all words of (word, n) with near ones."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("side", "ascending"), ("key", "ascending")])
        side, key = table.column("side").to_pylist(), table.column("key").to_pylist()
        columns = [table.column(c).to_pylist() for c in ("word", "n", "side", "indexed", "searched")]
        out, lo, size = [], 0, 0
        for i in range(1, len(key) + 1):
            size += -(-len(columns[0][i - 1]) // WORD_LETTERS)
            # an index holds whole keys of one side: index_words words and those of one key at most
            if i == len(key) or side[i] != side[i - 1] or (key[i] != key[i - 1] and size >= index_words):
                out += search(*(c[lo:i] for c in columns))
                lo, size = i, 0
        return pa.Table.from_batches([batch(FOUND, **dict(zip(FOUND.names, zip(*out) if out else [()] * 4)))])

    ship_package(words.sparkSession)
    found = shards(words, bucket_words, index_words).groupBy("shard").applyInArrow(run, "word string, n_near bigint, near_n bigint, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.minus")).alias("near_n"), F.col("best.near").alias("near"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root: the last of the chain of forms (word, form) that begins at a word. Forms of forms must not form a ring."""
    reach = materialize(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        further = reach.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(reach.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                       F.col("next").isNotNull().alias("moved")), "variant-roots")
        if moved.where("moved").isEmpty():
            return moved.drop("moved")
        reach = moved.drop("moved")


def variants(docs: DataFrame, bucket_words: int = BUCKET_WORDS, index_words: int = INDEX_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the texts (doc_id, text)."""
    words = materialize(vocabulary(docs), "variant-words")
    linked = words.join(near_words(words, bucket_words, index_words), "word", "left")
    taken = F.col("near_n") >= FORM_RATIO * F.col("n")
    formed = materialize(linked.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                       F.when(taken, F.col("near")).alias("form"), F.when(taken, F.col("near_n")).alias("form_n")), "variant-forms")
    chains = roots(formed.where(F.col("form").isNotNull()))
    return formed.join(chains, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


# crc32 bit by bit over UTF-8 bytes, as DuckDB has none; near words meet under the strings that lack one letter.
ORACLE_VARIANTS = """
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents),
counted AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS name, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(range(1, strlen(name) + 1), lambda i: ('0x' || substr(hex(encode(name)), 2 * i - 1, 2))::BIGINT)),
    lambda a, x: list_reduce(list_concat([xor(a, x)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda b, y: xor(b >> 1, 3988292384 * (b & 1))))) AS h
  FROM counted),
v AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND sum(n) >= 2),
d AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS short FROM v, unnest(range(length(word))) u(i)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM d a JOIN d b ON a.short = b.short AND a.i = b.i AND a.word <> b.word
  UNION SELECT d.word, v.word, v.n FROM d JOIN v ON v.word = d.short
  UNION SELECT v.word, d.word, d.n FROM d JOIN v ON v.word = d.short),
best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS near_n, (list(near ORDER BY near_n DESC, encode(near)))[1] AS near FROM pairs GROUP BY word),
f AS (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 10 * v.n THEN b.near END AS form,
         CASE WHEN b.near_n >= 10 * v.n THEN b.near_n END AS form_n
  FROM v LEFT JOIN best b ON b.word = v.word),
chain AS (
  SELECT word, word AS root FROM f
  UNION ALL SELECT c.word, f.form FROM chain c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM f JOIN chain c ON c.word = f.word JOIN f last ON last.word = c.root AND last.form IS NULL
"""
