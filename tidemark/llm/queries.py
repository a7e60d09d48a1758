"""The registered queries of this subpackage and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import chat
from tidemark.llm.alignment import alignment
from tidemark.llm.common import read
from tidemark.llm.cotraining import cotraining
from tidemark.llm.decontamination import decontamination
from tidemark.llm.fill_in_middle import fill_in_middle, restored
from tidemark.llm.hmm import hmm_scores
from tidemark.llm.html_text import html_text
from tidemark.llm.mixing import mixing
from tidemark.llm.ngram_join import ngram_join
from tidemark.llm.oracles import ORACLES
from tidemark.llm.pii import find
from tidemark.llm.quality_rules import quality_rules
from tidemark.llm.token_counts import new_cache, token_counts
from tidemark.llm.warc import warc

TOKENIZER = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_pii(spark, sf_dir):
    return find(read(spark, sf_dir, "documents"))


def op2_lm_scoring(spark, sf_dir):
    return hmm_scores(read(spark, sf_dir, "documents"))


def op3_token_counts(spark, sf_dir):
    """Twice over one cache: the first run encodes all misses, the second finds every content stored."""
    docs, cache = read(spark, sf_dir, "documents"), new_cache(spark)
    token_counts(docs, tokenizer_path(), cache)
    return token_counts(docs, tokenizer_path(), cache)


def op4_warc(spark, sf_dir):
    return warc(read(spark, sf_dir, "pages"))


def op5_mixing(spark, sf_dir):
    return mixing(read(spark, sf_dir, "documents"))


def op6_quality_rules(spark, sf_dir):
    return quality_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_quality_classifier(spark, sf_dir):
    return cotraining(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_html_extraction(spark, sf_dir):
    return html_text(read(spark, sf_dir, "pages"))


def op9_ngram_join(spark, sf_dir):
    return ngram_join(read(spark, sf_dir, "documents"))


def op10_decontamination(spark, sf_dir):
    return decontamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op11_tokenizer_alignment(spark, sf_dir):
    return alignment(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path(), digest=True)


def op12_chat_formatting(spark, sf_dir):
    path = tokenizer_path("byte_bpe_50k.json")
    return chat.read_back(chat.formatted(chat.with_trap(read(spark, sf_dir, "conversations")), path), path)


def op13_fill_in_middle(spark, sf_dir):
    out = fill_in_middle(read(spark, sf_dir, "documents"))
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256")]
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES = {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
