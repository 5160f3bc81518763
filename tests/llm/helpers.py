"""Plain Python versions of the operators and shared rows, for comparison."""

import math
import random
import re
from collections import Counter

import pandas as pd

ASCII = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

ODD_TEXTS = [None, "", " ", "\n\n \t", "a", "a b", "A  b", "a b c d e", "a b c d e f", "x" * 6000, "word " * 4000, " lead and trail ",
             "it's  don't   x y", "<|endoftext|> in text <|endoftext|>", "é漢😀   ​ x", "\r\nline\r\nline\r\n", "1234 5678 $$$ ### %%%"]


def documents(spark, texts, extra=False):
    """documents of texts; extra: columns whose names operators might use inside."""
    rows = [(i, t, "en", f"src{i % 3}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        from pyspark.sql import functions as F
        for name in ("score", "hits", "quality", "host_key", "host", "bad", "kept_id", "nth", "key", "node", "size", "n", "Kept"):
            df = df.withColumn(name, F.lit(f"own {name}"))
    return df


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not re.search(r"Python|Pandas|Arrow", plan)


def item_words(text):
    return (text or "").encode().translate(bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32
                                                 for c in range(256))).split()


def contamination(text, items, window=10):
    words, hit, found = item_words(text), set(), set()
    for item, t in items:
        ws = item_words(t)
        n = min(window, len(ws))
        wins = {tuple(ws[k:k + n]) for k in range(len(ws) - n + 1)} if n else set()
        for k in range(len(words) - n + 1 if n else 0):
            if tuple(words[k:k + n]) in wins:
                hit |= set(range(k, k + n))
                found.add(str(item))
    return len(words), hit, sorted(found)


def quality(text):
    text = text or ""
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    wins = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    twice = Counter(wins)
    rep = {p for i, w in enumerate(wins) if twice[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    m = {"n_words": len(ws), "word_chars": sum(map(len, ws)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
         "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(rep)}
    m["base_failed"] = m["n_words"] < 50 or 100 * len(rep) > 50 * len(ws)
    m["n_lines"] = len(lines)
    return m


def quality_verdicts(rows):
    """(doc_id, text, source) rows to doc_id -> kept."""
    measured = [(i, quality(t), s) for i, t, s in rows]
    fails = []
    for i, m, s in measured:
        n = m["n_words"]
        fails.append((i, s, [n < 50, 100 * m["n_repeat_words"] > 50 * n, 100 * m["n_symbols"] > 10 * n,
                             100 * m["n_dup_lines"] > 30 * m["n_lines"], n > 0 and not 3 * n <= m["word_chars"] <= 12 * n]))
    hosts = {}
    for _, s, f in fails:
        hosts.setdefault(s, []).append(f)
    granted = {}
    for r in range(2, 5):
        rates = {s: (sum(f[r] for f in fs), len(fs)) for s, fs in hosts.items()}
        m = sum(a / b for a, b in rates.values()) / max(1, len(rates))
        v = sum((a / b - m) ** 2 - m * (1 - m) / b for a, b in rates.values()) / max(1, len(rates))
        k = max(1.0, m * (1 - m) / v - 1) if v > 0 else 1e9 if 0 < m < 1 else 1.0
        for s, (a, b) in rates.items():
            granted[s, r] = math.floor(100 * (3 - 2 * min(1.0, 2 * (a + m * k) / (b + k)))) / 100
    out = {}
    for (i, m, s), (_, _, f) in zip(measured, fails):
        n = m["n_words"]
        far = (m["n_symbols"] > 0.1 * n * granted[s, 2] + 1e-9, m["n_dup_lines"] > 0.3 * m["n_lines"] * granted[s, 3] + 1e-9,
               n > 0 and (m["word_chars"] < 3 * n / granted[s, 4] - 1e-9 or m["word_chars"] > 12 * n * granted[s, 4] + 1e-9))
        out[i] = not (f[0] or f[1]) and not any(far)
    return out


def shingle_set(text):
    w = (text or "").encode().translate(ASCII).split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def jaccard_components(rows, percent=80):
    """(doc_id, text) rows with different ids to doc_id -> (n_shingles, component)."""
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(seed=3, groups=12, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    texts = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(4, 3 * words))]
        if rng.random() < 0.5:
            base += passage
        for _ in range(rng.randrange(1, 9)):
            t = list(base)
            for _ in range(rng.choice((0, 0, 1, 1, 2, 4))):
                t[rng.randrange(len(t))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                t = t[:-rng.randrange(1, 4)] or t
            texts.append(" ".join(t) if rng.random() < 0.9 else "  ".join(t).upper())
    return texts


def frame(df, key):
    return df.toPandas().sort_values(key).reset_index(drop=True) if key else pd.DataFrame(df.collect())
