"""Secret spans against a scanner without patterns; grammars by held-out values."""

import hashlib
import random
import string

import pytest

from vesseltrack.llm import secret_scan as S
from vesseltrack.llm.secret_grammar import ALPHABET, END, Automaton, _Tree

from .helpers import ODD_TEXTS, documents

VALUE = set(ALPHABET)
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")


def plain_base(text):
    """(kind, start, end) of base spans by walking the text."""
    text, out = text or "", []
    low = "".join(c.lower() if c.isascii() else c for c in text)

    def assigned(i):
        """(end, value) of an assignment that begins at i, trying names in order."""
        for name in NAMES:
            if not low.startswith(name, i):
                continue
            j = i + len(name)
            for quote in ((1, 0) if text[j:j + 1] in ("'", '"') and text[j:j + 1] else (0,)):
                k = j + quote
                while text[k:k + 1] == " ":
                    k += 1
                if text[k:k + 1] not in (":", "=") or not text[k:k + 1]:
                    continue
                k += 1
                while text[k:k + 1] == " ":
                    k += 1
                if text[k:k + 1] in ("'", '"') and text[k:k + 1]:
                    k += 1
                end = k
                while end < len(text) and text[end] in VALUE:
                    end += 1
                if end > k:
                    return end, text[k:end]
        return None

    def walk(kind, at, least):
        i = 0
        while i < len(text):
            found = at(i)
            if found is None:
                i += 1
                continue
            if len(found[1]) >= least:
                out.append((kind, i, found[0]))
            i = found[0]

    def run_of(letters, head=""):
        def at(i):
            if not text.startswith(head, i):
                return None
            j = i + len(head)
            while j < len(text) and text[j] in letters:
                j += 1
            return (j, text[i:j]) if j > i + len(head) else None
        return at

    walk("assign", assigned, 8)
    walk("access", run_of(set(string.ascii_uppercase + string.digits), "AKIA"), 16)
    walk("hex", run_of(set("0123456789abcdef")), 32)
    return sorted(out, key=lambda s: (s[1], S.KINDS.index(s[0])))


def secret_texts(seed=4, n=120):
    rng = random.Random(seed)
    texts = []

    def some(letters, k):
        return "".join(rng.choice(letters) for _ in range(k))

    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(6)):
            parts.append(rng.choice((
                lambda: rng.choice(("password", "PassWd", "secreT", "token", "api_key", "APIKEY", "api__key", "tokentoken")) + rng.choice(("", "'", '"', " "))
                + rng.choice((":", " = ", "=", "  :", ";")) + rng.choice(("", '"', "'", " ''")) + some(ALPHABET, rng.randrange(14)),
                lambda: "AKIA" + some(string.ascii_uppercase + string.digits, rng.choice((3, 11, 12, 16, 20))),
                lambda: some("0123456789abcdef", rng.choice((31, 32, 40, 64))),
                lambda: some("abcdefgh", rng.randrange(1, 9)),
                lambda: "ſecret=abcdefgh12 toKen=abcdefgh12 é漢😀",
            ))())
        texts.append(rng.choice((" ", ", ", "\n", "")).join(parts))
    return texts


def test_base_spans_equal_a_walk_over_the_text():
    for text in secret_texts(n=600) + ODD_TEXTS:
        got = [(S.KINDS[k], s, e) for s, k, e, _ in S.base_spans(text or "")]
        assert got == plain_base(text), text


def test_query_columns(spark):
    texts = secret_texts() + ODD_TEXTS
    got = {r.doc_id: r for r in S.secrets(documents(spark, texts, extra=True)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        base = plain_base(text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        r = got[i]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(b[0] == k for b in base) for k in S.RULES)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert ",".join(s for s in r.spans.split(",") if not s.startswith(S.ADDED)) == joined
        added = [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith(S.ADDED)]
        assert len(added) == r.n_grammar
        assert all(e <= s2 or e2 <= s for s, e in added for _, s2, e2 in base)


def words(rng, n):
    parts = ["er", "th", "ing", "on", "an", "re", "ation", "lich", "ver", "en", "st", "ou", "ment"]
    return sorted({"".join(rng.choice(parts) for _ in range(rng.randrange(6, 9))) for _ in range(n)})


def credentials(rng, n):
    made = {"access": lambda: "AKIA" + "".join(rng.choice(string.ascii_uppercase + string.digits) for _ in range(16)),
            "hex": lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40)),
            "assign": lambda: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(24))}
    return {kind: [make() for _ in range(n)] for kind, make in made.items()}


def test_held_out_formats_are_found_and_words_are_not(spark):
    """Learned from values that the rules label; judged on others that stand alone, too short for any rule."""
    rng = random.Random(8)
    labelled, plain = credentials(rng, 300), words(rng, 1500)
    texts = [f"token = {c} and {a} or {b}" for a, b, c in zip(*labelled.values())] + [" ".join(plain[i:i + 5]) + "." for i in range(0, 1000, 5)]
    grammars = S.fit(documents(spark, texts))
    unseen = credentials(rng, 300)
    for kind, values in {"hex": [v[:30] for v in unseen["hex"]], "assign": unseen["assign"]}.items():
        found = [len(grammars.spans(f"so {v}, then")[1]) for v in values]
        assert sum(found) >= 0.97 * len(found), kind
    assert sum(len(grammars.spans(f"the {w}.")[1]) for w in plain[1000:]) <= 2
    assert grammars.odds("AKIA" + "Q7" * 6) > S.MIN_ODDS
    numbers = ["".join(rng.choice(string.digits) for _ in range(16)) for _ in range(300)]
    grammars = S.fit(documents(spark, texts + [f"card {n}" for n in numbers[:150]]))  # numbers are ordinary once they occur
    assert sum(len(grammars.spans(n)[1]) for n in numbers[150:]) <= 3


def test_merging_keeps_different_states_apart_and_joins_alike_ones():
    rng = random.Random(1)
    loop = Automaton(["".join(rng.choice("ab") for _ in range(rng.randrange(1, 20))) for _ in range(2000)])
    assert loop.states <= 3
    fixed = Automaton(["xy" + "".join(rng.choice("ab") for _ in range(8)) for _ in range(500)])
    assert fixed.states >= 3  # the letters x and y each come once, in this order
    assert fixed.likelihood("xyabababab") > fixed.likelihood("abababxyab") + 8
    assert abs(sum(map(float, __import__("numpy").exp(fixed.log[0]))) - 1) < 1e-9 and fixed.log.shape[1] == END + 1


def test_folding_keeps_counts():
    tree = _Tree(["ab"] * 40 + ["b"] * 40 + ["aab"] * 40)
    states = tree.merged()
    assert sum(tree.ends[s] for s in states) == 120


def test_examples_are_the_smallest_hashes_of_all_tasks(spark):
    import zlib
    values = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(400)]
    texts = [f"{values[i % 400]}" for i in range(1200)]
    got = {r.value for r in S.examples(documents(spark, texts).repartition(7), 20).collect()}
    assert got == set(sorted(values, key=lambda v: (zlib.crc32(v.encode()), v))[:20])


@pytest.mark.parametrize("texts", [[], [None, "", "no credentials here at all"], ["AKIA" + "A1" * 20] * 3])
def test_few_or_no_examples(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = S.secrets(df).collect()
    assert len(rows) == len(texts) and sum(r.n_grammar for r in rows) == 0
    assert {r.base_sha256 for r in rows if not r.spans} <= {hashlib.sha256(b"").hexdigest()}


def test_long_text(spark):
    text = "word " * 200_000 + "password: abcdefgh1" + " x" * 100_000
    row = S.secrets(spark.createDataFrame([(None, text)], "doc_id long, text string")).first()
    assert (row.doc_id, row.n_assign, row.spans) == (None, 1, f"assign:1000000:{1000000 + 19}")


def test_registered_query_on_whole_texts(spark):
    from vesseltrack.llm.registry import QUERIES
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op11_secret_scan"](spark, sf).collect()}
    assert got.keys() == texts.keys()
    found = 0
    for i, text in texts.items():
        base = plain_base(text)
        found += len(base)
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
        assert got[i].n_assign == sum(k == "assign" for k, *_ in base)
    assert found > 20
