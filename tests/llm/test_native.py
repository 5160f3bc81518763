"""Quality rules, url rules and shards: DataFrame functions only, held against plain Python."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from vesseltrack.llm import quality_rules as Q
from vesseltrack.llm import ring_shards as RS
from vesseltrack.llm import url_rules as UR

from .helpers import ODD_TEXTS, documents, no_python, quality, quality_verdicts

KEYS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def prose(rng, n, repeat=0):
    words = [rng.choice("aa bb cc dd ee ff gg hh ii jj kk ll mm".split()) + str(rng.randrange(60)) for _ in range(n)]
    return " ".join(words + words[:repeat])


def quality_texts():
    rng = random.Random(2)
    texts = ODD_TEXTS + [prose(rng, n, r) for n in (49, 50, 51, 120) for r in (0, 2, 3, 4, 30, 60)]
    texts += ["same line\n" * 40, "\n".join(prose(rng, 6) for _ in range(30)) + "\n x \nx \n x ", "a b a b a b a", "a a a a a", "w " * 3000]
    return texts + [prose(rng, 80).replace(" ", "### ") for _ in range(12)]


def test_quality_measures_and_verdicts(spark):
    texts = quality_texts()
    docs = documents(spark, texts, extra=True)
    hot = docs.withColumn("source", F.when(F.col("doc_id") >= len(texts) - 12, "symbols.example").otherwise(F.col("source")))
    got = {r.doc_id: r for r in Q.quality(hot).collect()}
    kept = quality_verdicts([(r.doc_id, r.text, r.source) for r in hot.collect()])
    for i, t in enumerate(texts):
        want = quality(t)
        assert {k: got[i][k] for k in KEYS} == {k: want[k] for k in KEYS}, t
        assert got[i].kept == kept[i]
    bad = [i for i in got if i >= len(texts) - 12]
    assert not any(got[i].kept for i in bad) and not all(got[i].base_failed for i in bad)  # by their host's verdict
    assert no_python(Q.quality(hot))


def test_quality_keeps_columns_rows_and_shuffled_verdicts(spark):
    docs = documents(spark, quality_texts(), extra=True)
    twice = docs.unionByName(docs)
    out = Q.keep_good(twice)
    assert out.columns == docs.columns
    ids = sorted(r.doc_id for r in out.collect())
    kept = quality_verdicts([(r.doc_id, r.text, r.source) for r in docs.collect()])
    assert ids == sorted([i for i in kept if kept[i]] * 2)
    rows, name = Q.judged(docs, ["doc_id"], max_hosts=0)
    assert {r.doc_id for r in rows.where(F.col(name)["kept"]).collect()} == {i for i in kept if kept[i]}
    assert Q.quality(docs.limit(0)).count() == 0 and Q.keep_good(docs.limit(0)).count() == 0


def test_small_hosts_stay_near_the_mean(spark):
    rows = [("big", i < 10) for i in range(100)] + [("other", i < 12) for i in range(100)] + [("one", True)]
    fails = spark.createDataFrame(rows, "h string, x boolean").select("h", F.struct(*[F.col("x").alias(r) for r in Q.RULES]).alias("s"))
    got = {r.host: r for r in Q.host_verdicts(fails, "s", F.col("h")).collect()}
    assert got["one"].few_words_rate < 0.95 and got["big"].few_words_rate < 0.2 and not got["big"].few_words_bad


def url_verdict(url, rules, default="allow"):
    import re
    host = path = ""
    if url is not None and "://" in url:
        rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
        host, slash, path = rest.partition("/")
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path
    best = None
    for rule, verdict in rules:
        h, p = rule.split("/", 1)[0], "/" + rule.split("/", 1)[1]
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            key = (len(rule), -len(p), rule, verdict)
            best = max(best, key) if best else key
    return host, path, best and best[2], best[3] if best else default


def test_urls_against_brute_force(spark):
    rng = random.Random(4)
    labels, paths = ["a", "b", "net", "net-x", "org", "x1"], ["", "/", "/en/", "/en/a", "/de", "/de/x/y"]
    host = lambda n: ".".join(rng.choice(labels) for _ in range(rng.randrange(1, n)))
    rules = list({(host(4) + (rng.choice(paths) or "/"), rng.choice(("allow", "block"))) for _ in range(60)})
    rules = [(r, max(v for s, v in rules if s == r)) for r in {r for r, _ in rules}]
    urls = [f"http{rng.choice(('', 's'))}://{host(6)}{rng.choice(paths)}{rng.choice(('', '?q=/en/', '#://x'))}" for _ in range(500)]
    urls += [None, "", "no scheme", "://", "x://NET/en/?a#b", "http://a.net", "http://é.net/", "http://a..net/", "http://net:80/", "a://b://c/d"]
    pages = spark.createDataFrame([(i % 400, u) for i, u in enumerate(urls)], "page_id long, url string").withColumn("key", F.lit("own"))
    want = sorted(((i % 400, *url_verdict(u, rules)) for i, u in enumerate(urls)), key=str)
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    try:
        for ranges, broadcast_hosts in ((1, 100), (7, 0), (60, 0)):  # many ranges begin inside nested intervals, or at the end of one
            for n, v in zip(names, (str(ranges), "false")):
                spark.conf.set(n, v)
            got = UR.judge(pages, UR.rule_table(spark, rules), broadcast_hosts=broadcast_hosts)
            assert no_python(got)
            assert sorted(map(tuple, got.collect()), key=str) == want
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)


def test_rule_rows_do_not_multiply(spark, monkeypatch):
    """The swept table holds each rule's two ends once, and for each range no more than the labels of its first key."""
    rules = [(f"h{i}.example.net/", "block") for i in range(500)] + [("net/", "allow"), ("example.net/", "block")]
    pages = spark.createDataFrame([(i, f"http://x.h{i % 50}.example.net/p") for i in range(200)], "page_id long, url string")
    kept = {}
    real = UR.materialize
    monkeypatch.setattr(UR, "materialize", lambda df, name: kept.setdefault(name, real(df, name)))
    got = UR.judge(pages, UR.rule_table(spark, rules)).collect()
    assert {r.rule for r in got} == {f"h{i}.example.net/" for i in range(50)}
    assert kept["url-ranges"].count() == 2 * 502 + 50


def test_urls_without_rules_and_without_pages(spark):
    pages = spark.createDataFrame([(1, "http://a/b"), (None, None)], "page_id long, url string")
    none = spark.createDataFrame([], "rule string, verdict string")
    assert sorted(map(tuple, UR.judge(pages, none).collect()), key=str) == sorted([(1, "a", "/b", None, "allow"), (None, "", "", None, "allow")], key=str)
    assert UR.judge(pages.limit(0), UR.rule_table(spark)).count() == 0


def test_the_given_rules_run_without_python(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    from vesseltrack.llm.registry import QUERIES
    assert QUERIES["op7_url_filters"](spark, "/root/testdata/sf0.001").count() == pages.count()


@pytest.mark.parametrize("shards,n", [(16, 0), (16, 5), (16, 333), (3, 100)])
def test_shards_are_balanced_and_gapless(spark, shards, n):
    docs = documents(spark, (ODD_TEXTS * 40)[:n] or ["x"], extra=True).limit(n)
    got = RS.shard_rows(docs, shards=shards, cell_rows=7)
    rows = got.collect()
    assert len(rows) == n
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
        text = ((ODD_TEXTS * 40)[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 1, zlib.crc32(text), "rows", None)
    counts = [len(by.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_one_key_with_a_third_of_all_rows(spark):
    rows = [(7, "same text")] * 200 + [(None, None)] * 100 + [(i, f"t{i}") for i in range(300)]
    got = RS.shard_rows(spark.createDataFrame(rows, "doc_id long, text string"), cell_rows=5).groupBy("shard").count().collect()
    assert sum(r["count"] for r in got) == 600 and {r["count"] for r in got} <= {37, 38}


def test_few_rows_move(spark):
    docs = documents(spark, [f"text {i}" for i in range(2000)])
    more = documents(spark, [f"text {i}" for i in range(2020)])
    for slack, most in ((0.0, 0.06), (0.5, 0.02)):
        a = {r.doc_id: r.shard for r in RS.shard_rows(docs, slack=slack).collect()}
        b = {r.doc_id: r.shard for r in RS.shard_rows(more, slack=slack).collect()}
        assert sum(a[i] != b[i] for i in a) <= most * len(a)


def test_walk_keeps_to_the_bounds():
    places = [(10, 0), (20, 1), (30, 2), (40, 0)]
    taken = RS.walk(places, {0: 9, 1: 1, 3: 2}, [4, 4, 4])
    per = [sum(b - a for _, a, b, s, _ in taken if s == k) for k in range(3)]
    assert sum(per) == 12 and max(per) <= 4
    assert taken[0] == (0, 0, 4, 0, 0)  # home first


def test_a_host_with_failures_grants_its_documents_less(spark):
    """Two documents alike, with a tenth and a half of symbols to words: what differs is how their hosts' other documents do."""
    rng = random.Random(6)

    def noted(share):
        words = prose(rng, 100).split(" ")
        return " ".join(w + "#" if i < share * 100 else w for i, w in enumerate(words))

    rows = [("sound", noted(0)) for _ in range(60)] + [("failing", noted(0.6)) for _ in range(60)] + [("sound", noted(0.15)), ("failing", noted(0.15))]
    rows += [("sound", noted(0.9)), ("failing", noted(0.05))]
    docs = spark.createDataFrame([(i, t, h) for i, (h, t) in enumerate(rows)], "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in Q.quality(docs).collect()}
    assert kept == quality_verdicts([(i, t, h) for i, (h, t) in enumerate(rows)])
    assert [kept[i] for i in range(120, 124)] == [True, False, False, True]


def test_prior_without_the_noise_of_small_hosts(spark):
    """Hosts that differ by chance alone are all shrunk to the mean."""
    rng = random.Random(9)
    rows = [(f"h{h}", rng.random() < 0.3) for h in range(200) for _ in range(10)]
    fails = spark.createDataFrame(rows, "h string, x boolean").select("h", F.struct(*[F.col("x").alias(r) for r in Q.RULES]).alias("s"))
    rates = [r.symbols_rate for r in Q.host_verdicts(fails, "s", F.col("h")).collect()]
    assert max(rates) - min(rates) < 0.1  # unshrunk they lie between 0 and 0.7
