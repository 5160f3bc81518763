"""Host-level quality rules, on DataFrame functions only.

Document rules are counted on whole texts: too few words, repeated 3-word
windows, symbols, repeated lines, odd mean word length. Failures are then
counted per host (``source``); a host's failure rate of a rule is shrunk with a
beta prior fitted to all hosts by moments (mean of the rates, and their variance
less what chance alone gives hosts of their sizes), so hosts with few documents
stay near the mean, and all do where they don't differ beyond chance.

The shrunk rate is the host's verdict: it sets how far its documents may pass
the limits of the symbol, line and word-length rules. From a rate of
``host_limit`` on nothing is tolerated; towards a rate of nought up to
``LENIENT`` times the limit is (a table or a poem from a host that is otherwise
sound). A document beyond what its host is granted goes. A document that fails
no rule always stays, and one that breaks a limit many times over goes whatever
its host.

Scale: one scan; counters per host are summed map-side (a hot host is a few
numbers per task); the only shuffles carry one row per host and task. Host
verdicts join back by broadcast where their number is within ``max_hosts`` (checked),
else by a shuffled join that Spark may split at hot hosts.

Edge cases: null and wordless texts have no words and fail the word minimum;
a null source is a host of its own; repeated rows count as often as they come;
an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vesseltrack.session import materialize

from .common import fresh

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MAX_SYMBOL_PERCENT = 10   # of words
MAX_DUP_LINE_PERCENT = 30  # of lines with a word
MEAN_WORD = (3, 12)
HOST_LIMIT = 0.5
LENIENT = 3
MAX_HOSTS = 100_000
RULES = ("few_words", "repeats", "symbols", "dup_lines", "word_length")


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    trimmed = F.trim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \t-\r]+"))


def repeated_words(ws: Column) -> Column:
    """Words inside 3-word windows that come twice or more, the first one included.

    Windows are compared by their 64-bit hashes of all three words, sorted with
    their places; equal neighbours mark repeated windows, whose places in order
    then cover 3 words each, less what the one before has covered.
    """
    n = F.size(ws)
    hashes = F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.xxhash64(F.get(ws, i - 1), F.get(ws, i), F.get(ws, i + 1)))

    def covered(hs: Column) -> Column:
        def places(s: Column) -> Column:
            same = lambda i, j: F.get(s, i)["h"] == F.get(s, j)["h"]
            marked = F.filter(s, lambda w, i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)))
            return F.sort_array(F.transform(marked, lambda w: w["i"]))
        def count(ps: Column) -> Column:
            return F.aggregate(ps, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
                               lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
                               lambda a: a["n"])
        pairs = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long")).otherwise(
            let(let(pairs, places), count))

    return F.when(n < 4, F.lit(0).cast("long")).otherwise(let(hashes, covered))


def measures(text: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines of a text column."""
    t = F.coalesce(text, F.lit(""))
    has_word = lambda line: F.length(F.translate(line, SPACES, "")) > 0
    lines = F.filter(F.split(t, "\n"), has_word)
    counted = let(words(t), lambda ws: F.struct(F.size(ws).cast("long").alias("n"), repeated_words(ws).alias("r")))
    dup = let(lines, lambda ls: F.struct((F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("d"), F.size(ls).cast("long").alias("n")))
    return {"counted": counted, "word_chars": F.length(F.translate(t, SPACES, "")).cast("long"),
            "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"), "lines": dup}


def failures(m: Column) -> dict[str, Column]:
    """Rule by rule, whether a document with these measures fails it."""
    n = m["n_words"]
    return {"few_words": n < MIN_WORDS,
            "repeats": 100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * n,
            "symbols": 100 * m["n_symbols"] > MAX_SYMBOL_PERCENT * n,
            "dup_lines": 100 * m["n_dup_lines"] > MAX_DUP_LINE_PERCENT * m["n_lines"],
            "word_length": (n > 0) & ((m["word_chars"] < MEAN_WORD[0] * n) | (m["word_chars"] > MEAN_WORD[1] * n))}


def with_measures(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """``docs`` and a struct column of measures and rule failures."""
    m = measures(F.col(f"`{text}`"))
    raw = F.struct(*[c.alias(k) for k, c in m.items()])
    flat = let(raw, lambda r: F.struct(
        r["counted"]["n"].alias("n_words"), r["word_chars"].alias("word_chars"), r["n_symbols"].alias("n_symbols"),
        r["lines"]["d"].alias("n_dup_lines"), r["lines"]["n"].alias("n_lines"), r["counted"]["r"].alias("n_repeat_words")))
    done = let(flat, lambda s: F.struct(*[s[k].alias(k) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")],
                                        *[c.alias(k) for k, c in failures(s).items()]))
    return docs.withColumn(name, done)


def beyond(m: Column, tolerance: Column) -> Column:
    """Whether a document passes a limit by more than its host is granted."""
    n = m["n_words"]
    return ((100 * 100 * m["n_symbols"] > MAX_SYMBOL_PERCENT * n * tolerance["symbols"])
            | (100 * 100 * m["n_dup_lines"] > MAX_DUP_LINE_PERCENT * m["n_lines"] * tolerance["dup_lines"])
            | ((n > 0) & ((m["word_chars"] * tolerance["word_length"] < 100 * MEAN_WORD[0] * n)
                          | (100 * m["word_chars"] > MEAN_WORD[1] * n * tolerance["word_length"]))))


def host_verdicts(measured: DataFrame, name: str, host: Column, host_limit: float = HOST_LIMIT) -> DataFrame:
    """One row per host: host, docs, and per rule its shrunk failure rate, its tolerance and whether that is none at all.

    Prior of a rule: Beta(a, b) with the mean m of the hosts' rates and their
    variance v less the mean of m (1 - m) / documents, a + b = m (1 - m) / v - 1,
    at least 1; the shrunk rate is (failures + a) / (documents + a + b). The
    tolerance is in hundredths: 100 keeps a limit as it is.
    """
    s = F.col(f"`{name}`")
    per = measured.groupBy(host.alias("host")).agg(
        F.count("*").alias("docs"), *[F.sum(s[r].cast("long")).alias(f"{r}_n") for r in RULES])
    moments = per.agg(F.avg(1 / F.col("docs")).alias("per_doc"), *[
        f(F.col(f"{r}_n") / F.col("docs")).alias(f"{r}_{k}") for r in RULES for k, f in (("m", F.avg), ("v", F.var_pop))])
    prior = moments.first()
    cols = []
    for r in RULES:
        m = prior[f"{r}_m"] or 0.0
        v = (prior[f"{r}_v"] or 0.0) - m * (1 - m) * (prior["per_doc"] or 0.0)
        weight = max(1.0, m * (1 - m) / v - 1) if v > 0 else 1e9 if 0 < m < 1 else 1.0
        rate = (F.col(f"{r}_n") + F.lit(m * weight)) / (F.col("docs") + F.lit(weight))
        tolerance = F.floor(100 * (1 + (LENIENT - 1) * (1 - F.least(F.lit(1.0), rate / host_limit)))).cast("long")
        cols += [rate.alias(f"{r}_rate"), tolerance.alias(f"{r}_tolerance"), (tolerance == 100).alias(f"{r}_bad")]
    return per.select("host", "docs", *cols)


def judged(docs: DataFrame, keep: list[str], host: str = "source", host_limit: float = HOST_LIMIT,
           max_hosts: int = MAX_HOSTS) -> tuple[DataFrame, str]:
    """The ``keep`` columns of ``docs`` and the name of a new struct column: measures, failures, base_failed, kept.

    The measured rows are written once to the shared checkpoint folder: the
    host counts and the verdicts on documents both read that copy.
    """
    name, key = fresh(docs, "quality", "host_key")
    quoted = [f"`{c}`" for c in keep]
    rows = with_measures(docs.withColumn(key, F.col(f"`{host}`")), name).select(*quoted, f"`{key}`", f"`{name}`")
    rows = materialize(rows, "quality-measures")
    s = F.col(f"`{name}`")
    verdicts = materialize(host_verdicts(rows, name, F.col(f"`{key}`"), host_limit), "host-verdicts")
    host_name, granted = fresh(rows, "host", "granted")
    verdict = verdicts.select(F.col("host").alias(host_name), F.struct(*[F.col(f"{r}_tolerance").alias(r) for r in RULES]).alias(granted))
    if verdicts.limit(max_hosts + 1).count() <= max_hosts:
        verdict = F.broadcast(verdict)
    both = rows.join(verdict, F.col(f"`{key}`").eqNullSafe(F.col(f"`{host_name}`")), "left")
    base = s["few_words"] | s["repeats"]
    out = both.withColumn(name, s.withField("base_failed", base).withField("kept", ~base & ~beyond(s, F.col(f"`{granted}`"))))
    return out.select(*quoted, f"`{name}`"), name


def quality(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    rows, name = judged(docs.select("doc_id", "text", "source"), ["doc_id"])
    s = F.col(name)
    return rows.select("doc_id", *[s[k].alias(k) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that a base rule or their host's verdict rejects."""
    rows, name = judged(docs, docs.columns)
    return rows.where(F.col(f"`{name}`")["kept"]).select(*[f"`{c}`" for c in docs.columns])


ORACLE_QUALITY = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
w AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS win FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM w) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS r FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
m AS (SELECT doc_id, source, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
             len(ls) AS n_lines, coalesce(r, 0) AS n_repeat_words FROM d LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < 50 AS r1, 100 * n_repeat_words > 50 * n_words AS r2, 100 * n_symbols > 10 * n_words AS r3,
             100 * n_dup_lines > 30 * n_lines AS r4, n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 12 * n_words) AS r5 FROM m),
c AS (SELECT coalesce(source, '') AS host, rule, count(*) AS docs, sum(CAST(bad AS INT)) AS n FROM (
        SELECT source, unnest(['1', '2', '3', '4', '5']) AS rule, unnest([r1, r2, r3, r4, r5]) AS bad FROM f) GROUP BY source, rule),
mo AS (SELECT rule, avg(n / docs) AS m, var_pop(n / docs) AS spread, avg(1 / docs) AS per_doc FROM c GROUP BY rule),
v AS (SELECT rule, m, spread - m * (1 - m) * per_doc AS v FROM mo),
pr AS (SELECT rule, m, CASE WHEN v > 0 THEN greatest(1.0, m * (1 - m) / v - 1) WHEN m > 0 AND m < 1 THEN 1e9 ELSE 1.0 END AS k FROM v),
g AS (SELECT host, rule, CAST(floor(100 * (1 + 2 * (1 - least(1.0, (n + m * k) / (docs + k) / 0.5)))) AS BIGINT) AS g FROM c JOIN pr USING (rule)),
h AS (SELECT host, max(g) FILTER (rule = '3') AS g3, max(g) FILTER (rule = '4') AS g4, max(g) FILTER (rule = '5') AS g5 FROM g GROUP BY host)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, r1 OR r2 AS base_failed,
       NOT (r1 OR r2) AND NOT (n_symbols * 1000 > n_words * g3 OR n_dup_lines * 10000 > 30 * n_lines * g4
                               OR n_words > 0 AND (word_chars * g5 < 300 * n_words OR word_chars * 100 > 12 * n_words * g5)) AS kept
FROM f JOIN h ON h.host = coalesce(f.source, '')
"""
