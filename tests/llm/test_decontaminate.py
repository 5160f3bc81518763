import random

import pytest

from vesseltrack.llm import decontaminate as D

from .helpers import ODD_TEXTS, contamination, documents, item_words


def texts_and_items(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(25)]
    run = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, run(rng.choice((3, 9, 10, 11, 25)))) for i in range(14)]
    items += [(90, items[0][1].upper()), (91, None), (92, "..."), (93, "w1"), (None, run(12)), (95, items[3][1] + " " + items[4][1])]
    texts = list(ODD_TEXTS)
    for _ in range(60):
        t = [run(rng.randrange(0, 12)).replace(" ", rng.choice((" ", ", ", "--", "\n")))]
        for _ in range(rng.randrange(0, 3)):
            words = rng.choice(items)[1] or ""
            cut = words.split()[rng.randrange(3):]
            t += [" ".join(cut).title(), run(rng.randrange(0, 5))]
        texts.append(" ".join(t))
    return texts, items


@pytest.mark.parametrize("max_words", [200_000, 40])
def test_windows_against_brute_force(spark, max_words):
    texts, items = texts_and_items()
    docs = documents(spark, texts, extra=True)
    bench = spark.createDataFrame(items, "item_id long, text string")
    marked, hits = D.mark(docs.unionByName(docs.limit(2)), bench, max_words=max_words)
    rows = marked.collect()
    assert hits == "_hits" and len(rows) == len(texts) + 2
    named = [("" if i is None else str(i), t) for i, t in items]
    for r in rows:
        n, hit, found = contamination(texts[r.doc_id], named)
        got = r[hits]
        assert (got.n_words, got.n_hit, got["items"]) == (n, len(hit), found)
        if found:
            words = item_words(texts[r.doc_id])
            assert item_words(got.clean) == [w for k, w in enumerate(words) if k not in hit]


def test_one_group_of_items_is_held_at_a_time(spark, monkeypatch):
    """Groups are broadcast one by one, and what several groups find in a text, or in its copies, comes together."""
    from pyspark import SparkContext
    live, most, made = set(), [0], SparkContext.broadcast

    def broadcast(self, value):
        held = made(self, value)
        live.add(id(held))
        most.append(len(live))
        gone = held.destroy
        held.destroy = lambda *a: (live.discard(id(held)), gone(*a))
        return held

    monkeypatch.setattr(SparkContext, "broadcast", broadcast)
    passages = [" ".join(f"p{k}x{i}" for i in range(12)) for k in range(6)]
    bench = spark.createDataFrame(list(enumerate(passages)), "item_id long, text string")
    whole = " and then ".join(passages)
    docs = documents(spark, [whole, whole, None, "", "no such words", passages[4]], extra=True)
    marked, hits = D.mark(docs, bench, max_words=40)
    rows = {r.doc_id: r[hits] for r in marked.collect()}
    assert max(most) == 1 and len(most) > 2
    assert [(rows[i].n_hit, rows[i]["items"]) for i in range(6)] == [(72, list("012345"))] * 2 + [(0, [])] * 3 + [(12, ["4"])]


def test_spans_go_and_mostly_copied_documents_go(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    texts = ["clean words here, nothing else", f"Before it, {passage.upper()}! After it. " + "more words " * 20, passage, None, "",
             " ".join(passage.split()[:9]) + " stays"]
    docs = documents(spark, texts, extra=True)
    got = {r.doc_id: r for r in D.decontaminate(docs, bench).collect()}
    assert set(got) == {0, 1, 3, 4, 5}
    assert got[1].text == "Before it, ! After it. " + "more words " * 20 and got[1].n_chars == len(got[1].text)
    assert all(got[i].text == texts[i] for i in (0, 3, 4, 5))
    assert D.decontaminate(docs, bench).columns == docs.columns
    assert D.decontaminate(docs, bench, min_span=13).count() == len(texts)


def test_empty_tables(spark):
    docs = documents(spark, ODD_TEXTS)
    none = spark.createDataFrame([], "item_id long, text string")
    got = D.contamination(docs, none)
    assert got.where("contaminated or n_hit > 0 or n_items > 0").count() == 0 and got.count() == len(ODD_TEXTS)
    assert D.contamination(docs.limit(0), none).count() == 0


def test_automaton_of_overlapping_items():
    a = D.ItemAutomaton([("x", b"a b a b a b a b a b a b".split()), ("y", b"b a b".split()), ("z", b"a".split())])
    hit, found = a.scan(b"q b a b q a b a b a b a b a b q".split())
    assert hit.tolist() == [False, True, True, True, False] + [True] * 10 + [False]
    assert found == {"x", "y", "z"}


def test_a_long_item_is_dealt_in_parts(spark):
    """One item of many words: no automaton holds it whole, no window is lost at a part's end, and it stays one item."""
    rng = random.Random(3)
    words = [f"w{rng.randrange(3000)}" for _ in range(6000)]
    items = [(7, " ".join(words)), (8, "a short one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    blobs, groups = D.item_automata(bench, max_words=800)
    import pickle
    sizes = [len(pickle.loads(r.blob).length) for r in blobs.collect()]
    assert groups > 5 and max(sizes) < 2 * 2500  # states: at most twice the words
    texts = [" ".join(words[k:k + 14]) for k in range(0, 5900, 41)] + [" ".join(words[k:k + 9]) for k in range(90, 200)] + ["a short one"]
    marked, hits = D.mark(documents(spark, texts), bench, max_words=800)
    for r in marked.collect():
        n, hit, found = contamination(texts[r.doc_id], [(str(i), t) for i, t in items])
        assert (r[hits].n_words, r[hits].n_hit, r[hits]["items"]) == (n, len(hit), found)
