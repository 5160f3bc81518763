"""Spelling variants against plain Python, the index against pairwise comparison."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from vesseltrack.llm import spelling_variants as V
from vesseltrack.llm.variant_index import _suffix_order

from .helpers import ODD_TEXTS, documents


def one_error(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows):
    """(doc_id, text) rows to word -> (form, root, n, n_near, form_n)."""
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    form, count = {}, {}
    for w in n:
        close = [x for x in n if one_error(w, x)]
        count[w] = len(close)
        best = min(close, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], count[w], n[form[w]] if form[w] else None)
    return out


def result(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("letters", ["ab", "abé", "abcdefghijklmnopqrstuvwxyzÀÿ×"])
def test_searches_find_every_near_word_once(letters):
    rng = random.Random(len(letters))
    words = {"".join(rng.choice(letters) for _ in range(rng.choice((7, 8, 9, 12, 17, 40)))) for _ in range(120)}
    for w in list(words)[:60]:
        k = rng.randrange(len(w))
        words |= {w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1:]}
    words = sorted(w for w in words if len(w) >= 7)
    got = {}
    for side in (0, 1):
        shown = [w[::-1] if side else w for w in words]
        for w, count, n, best in V.search(shown, list(range(len(words))), [side] * len(words), [True] * len(words), [True] * len(words)):
            a, b = got.get(w, (0, (-1, "")))
            got[w] = a + count, max(b, (n, best))
    want = {w: [(i, x) for i, x in enumerate(words) if one_error(w, x)] for w in words}
    assert got == {w: (len(x), max(x)) for w, x in want.items() if x}


def test_suffix_order_of_long_equal_suffixes():
    strings = [[3] * 70, [3] * 69, [4] + [3] * 40, [3] * 16, [3] * 17, [3, 4] * 30]
    size = np.array([len(s) + 1 for s in strings])
    start = np.append(0, np.cumsum(size)[:-1])
    text = np.array([x for s in strings for x in [*s, 1]], dtype=np.uint16)
    flat = [(s + [1])[k:] for s in strings for k in range(len(s) + 1)]
    assert _suffix_order(text, np.repeat(start + size, size) - np.arange(len(text))).tolist() == sorted(range(len(flat)), key=lambda i: (flat[i], i))


def misspelt(seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(7, 14))) for _ in range(25)]
    texts = []
    for _ in range(150):
        text = []
        for _ in range(30):
            w = rng.choice(words[:rng.randrange(1, 26)])
            if rng.random() < 0.05:
                k = rng.randrange(len(w))
                w = rng.choice((w[:k] + w[k + 1:], w[:k] + "x" + w[k:], w[:k] + "ß" + w[k + 1:]))
            text.append(w.upper() if rng.random() < 0.1 else w)
        texts.append(rng.choice((" ", ", ", "\n")).join(text))
    return texts


@pytest.mark.parametrize("sizes", [(V.BUCKET_WORDS, V.INDEX_WORDS), (40, 12)])
def test_variants_equal_plain_python(spark, sizes):
    texts = misspelt() + ODD_TEXTS + ["y" * 3000 + " " + "y" * 3001] * 3
    want = plain(list(enumerate(texts)))
    assert any(v[0] and v[1] != v[0] for v in want.values()) or any(v[0] for v in want.values())
    assert result(V.variants(documents(spark, texts, extra=True), *sizes)) == want


def test_chain_of_forms_reaches_its_end(spark):
    rows = [(None, " ".join(["chainedwords"] * 2000 + ["chainedword"] * 180 + ["chaindword"] * 15)), (0, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(V.variants(df)) == plain(rows)
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)], "word string, form string")
    assert {r.root for r in V.roots(forms).collect()} == {"w11"}


def test_hot_beginning_is_cut_into_chunks(spark):
    rng = random.Random(2)
    words = sorted({"pre" + "".join(rng.choice("abc") for _ in range(rng.choice((4, 5)))) for _ in range(400)})
    df = spark.createDataFrame([(w, i + 2) for i, w in enumerate(words)], "word string, n long")
    placed = V.shards(df, 60, 30).where("indexed").groupBy("shard").count().collect()
    assert len(placed) > 10 and max(r["count"] for r in placed) < 150
    got = {r.word: (r.n_near, r.near_n, r.near) for r in V.near_words(df, 60, 30).collect()}
    n = {w: i + 2 for i, w in enumerate(words)}
    want = {w: [x for x in words if one_error(w, x)] for w in words}
    assert got == {w: (len(x), n[max(x, key=n.get)], max(x, key=n.get)) for w, x in want.items() if x}


def test_empty_and_repeated(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert V.variants(empty).collect() == []
    rows = [(1, "Repeated repeated")] * 4
    assert result(V.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == plain(rows)
