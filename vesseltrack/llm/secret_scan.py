"""Secrets in texts: three base rules, and formats inferred from what they find.

1. *Examples*: a map over all texts applies the base rules and keeps, in each
   task, the ``MAX_EXAMPLES`` values of smallest hash of each kind: assigned
   values, access keys, hex runs (the labelled credentials), and ordinary runs
   that no base span touches. The smallest of all tasks are an exact sample of the
   different values, however often one occurs. ``MAX_EXAMPLES`` and
   ``EXAMPLE_LETTERS`` bound only what the automata are fitted on.
2. *Grammars*: one task per kind merges the prefix tree of its examples into a
   probabilistic automaton (``secret_grammar``).
3. *Scan*: a map over all texts finds base spans, and scores every run of
   ``MIN_RUN`` letters or more that none of them touches: the log odds of its best
   credential format against ordinary runs. A run over ``MIN_ODDS`` in all and
   ``MIN_ODDS_LETTER`` a letter is added as a span of kind ``grammar``.

Edge cases: null and empty texts have no spans; without an example of a
credential nothing is added; without ordinary runs every letter is equally
likely in them; repeated rows are scanned row by row; an empty table gives no
rows. Texts are read whole and positions are code points.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vesseltrack.session import materialize, ship_package

from .common import batch, map_arrow
from .secret_grammar import ALPHABET, Automaton

# The base rules, the group that holds the value, and its least length.
RULES = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
ADDED = "grammar"
ORDINARY = "ordinary"
KINDS = (*RULES, ADDED)
_RULES = [(kind, re.compile(rule, re.ASCII), group, least) for kind, (rule, group, least) in RULES.items()]
MIN_RUN = 16
_RUN = re.compile("[A-Za-z0-9+/_.=-]{%d,}" % MIN_RUN)
MAX_EXAMPLES, EXAMPLE_LETTERS = 3_000, 128
MIN_ODDS, MIN_ODDS_LETTER = 12.0, 0.5


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, number of kind, end, value), sorted."""
    return sorted((m.start(), k, m.end(), m.group(group)) for k, (_, rule, group, least) in enumerate(_RULES)
                  for m in rule.finditer(text) if len(m.group(group)) >= least)


def other_runs(text: str, spans) -> list[tuple[int, int, str]]:
    """(start, end, run) of candidate runs that no span touches; dots at the ends are punctuation."""
    out, i, reach = [], 0, 0  # reach: the farthest end of the spans that begin before the run ends
    for m in _RUN.finditer(text):
        run = m.group().strip(".")
        if len(run) < MIN_RUN:
            continue
        start = m.start() + m.group().index(run)
        while i < len(spans) and spans[i][0] < start + len(run):
            reach = max(reach, spans[i][2])
            i += 1
        if reach <= start:
            out.append((start, start + len(run), run))
    return out


def examples(docs: DataFrame, most: int) -> DataFrame:
    """kind, value: at most ``most`` different values of each kind, those of smallest hash."""
    schema = pa.schema([("kind", pa.string()), ("value", pa.string()), ("hash", pa.int64())])

    def run(batches):
        kept = {kind: {} for kind in (*RULES, ORDINARY)}

        def put(kind, value):
            if len(value) <= EXAMPLE_LETTERS and value not in kept[kind]:
                some = kept[kind]
                some[value] = zlib.crc32(value.encode())
                if len(some) > 4 * most:
                    kept[kind] = dict(sorted(some.items(), key=lambda x: (x[1], x[0]))[:most])

        for b in batches:
            for text in b.column(0).to_pylist():
                if text:
                    spans = base_spans(text)
                    for _, k, _, value in spans:
                        put(_RULES[k][0], value)
                    for _, _, value in other_runs(text, spans):
                        put(ORDINARY, value)
        rows = [(kind, v, h) for kind, some in kept.items() for v, h in sorted(some.items(), key=lambda x: (x[1], x[0]))[:most]]
        yield batch(schema, **dict(zip(schema.names, zip(*rows) if rows else [()] * 3)))

    found = materialize(map_arrow(docs.select("text"), run, "kind string, value string, hash bigint").distinct(), "secret-examples")
    out = None
    for kind in (*RULES, ORDINARY):
        own = found.where(F.col("kind") == kind).orderBy("hash", "value").limit(most).select("kind", "value")
        out = own if out is None else out.unionAll(own)
    return out


class Grammars:
    """The fitted automata: of each credential kind that has examples, and of ordinary runs."""

    def __init__(self, by_kind: dict[str, Automaton]):
        self.ordinary = by_kind.pop(ORDINARY, None) or Automaton([])
        self.credentials = by_kind

    def odds(self, run: str) -> float:
        """Log odds of the likeliest credential format against an ordinary run."""
        best = max((a.likelihood(run) for a in self.credentials.values()), default=float("-inf"))
        return best - self.ordinary.likelihood(run)

    def spans(self, text: str) -> tuple[list, list]:
        """Base spans, and added ones as (start, end, odds)."""
        base, more = base_spans(text), []
        for start, end, run in other_runs(text, base):
            odds = self.odds(run)
            if odds >= max(MIN_ODDS, MIN_ODDS_LETTER * len(run)):
                more.append((start, end, odds))
        return base, more


def fit(docs: DataFrame, most: int = MAX_EXAMPLES) -> Grammars:
    """Automata of the credentials that the base rules label in the texts (column text)."""
    def learn(table: pa.Table) -> pa.Table:
        kind = table.column("kind")[0].as_py()
        return pa.table({"kind": [kind], "automaton": [pickle.dumps(Automaton(table.column("value").to_pylist()))]})

    ship_package(docs.sparkSession)
    rows = examples(docs, most).groupBy("kind").applyInArrow(learn, "kind string, automaton binary").collect()
    return Grammars({r.kind: pickle.loads(r.automaton) for r in rows})


FOUND = "array<struct<kind:string,start:bigint,end:bigint,odds:double>>"


def scan(docs: DataFrame, grammars: Grammars) -> DataFrame:
    """doc_id and secrets (all spans by start, then kind; odds of added ones) of every text (doc_id, text)."""
    found = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("odds", pa.float64())]))

    def run(batches):
        for b in batches:
            out = []
            for text in b.column(1).to_pylist():
                base, more = grammars.spans(text) if text else ((), ())
                spans = [(s, k, e, None) for s, k, e, _ in base] + [(s, len(_RULES), e, odds) for s, e, odds in more]
                out.append([{"kind": KINDS[k], "start": s, "end": e, "odds": o} for s, k, e, o in sorted(spans, key=lambda x: x[:3])])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, type=found)], ["doc_id", "secrets"])

    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, secrets {FOUND}")


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_grammar, base_sha256 and spans of every document."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["kind"] != ADDED)
    return scan(docs, fit(docs)).select("doc_id", *(number(kind) for kind in KINDS), F.sha2(joined(base), 256).alias("base_sha256"),
                                        joined("secrets").alias("spans"))
