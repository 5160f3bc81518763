"""Registered queries of the text operators, with DuckDB twins where SQL can express them."""

from __future__ import annotations

import public_tokenizers

from . import bpe as B
from . import burst_trie as BT
from . import decontaminate as D
from . import html_main as H
from . import ngram_join as N
from . import quality_rules as Q
from . import ring_shards as RS
from . import secret_scan as SS
from . import spelling_variants as V
from . import token_count as TC
from . import toxicity as X
from . import url_rules as UR
from . import warc as W
from .common import table

QUERIES, ORACLE = {}, {}


def op1_toxicity(spark, sf_dir):
    return X.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES["op1_toxicity"] = op1_toxicity


def op2_token_counts(spark, sf_dir):
    return TC.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES["op2_token_counts"] = op2_token_counts


def op3_byte_bpe(spark, sf_dir):
    return B.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                            public_tokenizers.PATTERN)


QUERIES["op3_byte_bpe"] = op3_byte_bpe


def op4_warc(spark, sf_dir):
    return W.round_trip(table(spark, sf_dir, "pages"))


QUERIES["op4_warc"] = op4_warc
ORACLE["op4_warc"] = W.ORACLE_ROUND_TRIP


def op5_html_extraction(spark, sf_dir):
    return H.extract(table(spark, sf_dir, "pages"))


QUERIES["op5_html_extraction"] = op5_html_extraction


def op6_quality_rules(spark, sf_dir):
    return Q.quality(table(spark, sf_dir, "documents"))


QUERIES["op6_quality_rules"] = op6_quality_rules
ORACLE["op6_quality_rules"] = Q.ORACLE_QUALITY


def op7_url_filters(spark, sf_dir):
    return UR.judge(table(spark, sf_dir, "pages"), UR.rule_table(spark))


def op8_sharding(spark, sf_dir):
    return RS.shard_rows(table(spark, sf_dir, "documents"))


QUERIES["op7_url_filters"] = op7_url_filters
ORACLE["op7_url_filters"] = UR.ORACLE_JUDGE
QUERIES["op8_sharding"] = op8_sharding


def op9_benchmark_decontamination(spark, sf_dir):
    return D.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES["op9_benchmark_decontamination"] = op9_benchmark_decontamination
ORACLE["op9_benchmark_decontamination"] = D.ORACLE_CONTAMINATION


def op10_ngram_jaccard_join(spark, sf_dir):
    return N.jaccard_components(table(spark, sf_dir, "documents"))


QUERIES["op10_ngram_jaccard_join"] = op10_ngram_jaccard_join


def op11_secret_scan(spark, sf_dir):
    return SS.secrets(table(spark, sf_dir, "documents"))


QUERIES["op11_secret_scan"] = op11_secret_scan


def op12_spelling_variants(spark, sf_dir):
    return V.variants(table(spark, sf_dir, "documents"))


QUERIES["op12_spelling_variants"] = op12_spelling_variants
ORACLE["op12_spelling_variants"] = V.ORACLE_VARIANTS


def op13_prefix_trie(spark, sf_dir):
    return BT.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES["op13_prefix_trie"] = op13_prefix_trie
ORACLE["op13_prefix_trie"] = BT.ORACLE_TRIE
