"""Exact token counts through a digest cache (operator 3).

The cache is a table of (content digest, tokenizer digest, n_tokens).  A run

1. digests the normalised content of every text and the tokenizer file (SHA-256
   of the file, the library and its version),
2. joins the distinct digests, as narrow rows, to the stored counts of this
   tokenizer; those without one are misses,
3. moves the texts of misses, and only those (a filter of fixed size keeps the
   others where they are), drops repeats, encodes each distinct miss once and
   appends the counts to the cache,
4. joins all documents, as narrow rows, with the cache.

*Normalised* is what the tokenizer's own normaliser makes of a text, since its
count depends on nothing else.  The exception are special strings, which some
tokenizers look for before they normalise: a text that may have one counts under
its own bytes.

*Hot texts.*  Of a content with ``HOT`` copies or more, only the row of the least
hash of id and content sends its text, so a text that a third of all documents
share leaves one task, whatever the number of tasks that have it.

A run that is cut short leaves the cache as it was; a lost executor repeats its
tasks.

Defined results: a null text is the empty text (0 bytes, 0 tokens); very long
texts are encoded whole; repeated rows give repeated results; empty tables give
empty results; other columns play no role.  Counts need the tokenizer, so there
is no SQL for them.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import FILTER_BITS, binary, bitmap, may_have, shared_dir, staged, whole_text

LIMIT, HOT = 4096, 64
_CACHE = "content binary, tokenizer binary, n_tokens long"


def load(path: str):
    """(encode, normalise, digest) for a tokenizer file, which a worker loads once.

    ``encode`` takes a list of texts and gives their token counts; ``normalise``
    gives the bytes on which the count of a text depends.
    """
    state = os.stat(path)
    return _loaded(path, state.st_mtime_ns, state.st_size)


@lru_cache(maxsize=2)
def _loaded(path: str, *state: int):
    with open(path, "rb") as f:
        data = f.read()
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=data)
        name = f"sentencepiece {sentencepiece.__version__}"

        def encode(texts: list[str]) -> list[int]:
            return [len(x) for x in model.encode(texts, add_bos=False, add_eos=False, num_threads=1)]

        def normalise(text: str) -> bytes:
            return model.normalize(text).encode()
    else:
        import tokenizers

        model = tokenizers.Tokenizer.from_str(data.decode())
        model.no_truncation()
        model.no_padding()
        name = f"tokenizers {tokenizers.__version__}"
        special = [x.content.lower() for x in model.get_added_tokens_decoder().values()]

        def encode(texts: list[str]) -> list[int]:
            return [len(x.ids) for x in model.encode_batch(texts, add_special_tokens=False)]

        def normalise(text: str) -> bytes:
            low = text.lower()
            if model.normalizer is None or any(x in low for x in special):
                return b"\0" + text.encode()
            return b"\1" + model.normalizer.normalize_str(text).encode()

    return encode, normalise, hashlib.sha256(name.encode() + b"\0" + data).digest()


def _place(content: bytes, doc_id) -> int:
    return int.from_bytes(hashlib.blake2b(content + str(doc_id).encode(), digest_size=8).digest(), "big", signed=True)


def _key(content: bytes) -> int:
    return int.from_bytes(content[:8], "big", signed=True)


def _digests(tokenizer_path: str):
    def run(batches):
        _, normalise, _ = load(tokenizer_path)
        for batch in batches:
            texts = binary(batch, "text")
            content = [hashlib.sha256(normalise(x.decode())).digest() for x in texts]
            columns = [[len(x) for x in texts], [_key(c) for c in content], [_place(c, i) for c, i in zip(content, batch.column(0).to_pylist(), strict=True)]]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(content, pa.binary()), *(pa.array(x, pa.int64()) for x in columns)], names=["doc_id", "content", "n_bytes", "key", "place"])

    return run


def _texts(tokenizer_path: str, sought, hot, first):
    """(content, text) of the misses: repeats in a task are dropped, and of hot contents all rows but the first."""

    def run(batches):
        _, normalise, _ = load(tokenizer_path)
        seen: set[bytes] = set()
        for batch in batches:
            found = []
            for doc, raw in zip(batch.column(0).to_pylist(), binary(batch, "text"), strict=True):
                content = hashlib.sha256(normalise(raw.decode())).digest()
                if content not in seen:
                    key, place = (np.array([x], np.int64) for x in (_key(content), _place(content, doc)))
                    if may_have(sought.value, key)[0] and not (may_have(hot.value, key)[0] and not may_have(first.value, place)[0]):
                        seen.add(content)
                        found.append((content, raw.decode()))
            columns = list(zip(*found, strict=True)) if found else [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string())], names=["content", "text"])

    return run


def missing_texts(docs: DataFrame, digests: DataFrame, known: DataFrame, tokenizer_path: str, hot: int = HOT) -> DataFrame | None:
    """(content, text) of all contents that ``known`` lacks, some more than once; None if it has all."""
    spark = docs.sparkSession
    distinct = digests.groupBy("content", "key").agg(F.count("*").alias("copies"), F.min("place").alias("place"))
    misses = staged(distinct.join(known.select("content"), "content", "left_anti"), "token-misses")
    if misses.isEmpty():
        return None
    bit = F.col("key").bitwiseAND((1 << FILTER_BITS) - 1).alias("bit")
    many = misses.where(F.col("copies") >= hot)
    first = misses.select("place", bit).join(many.select(bit).distinct(), "bit", "left_semi")  # of all contents that the filter takes for hot
    filters = [spark.sparkContext.broadcast(x) for x in (bitmap(misses, "key"), bitmap(many, "key"), bitmap(first, "place"))]  # of fixed size
    return docs.select("doc_id", whole_text("text").alias("text")).mapInArrow(_texts(tokenizer_path, *filters), "content binary, text string")


def token_counts(docs: DataFrame, tokenizer_path: str, cache: str | None = None, limit: int = LIMIT, chunk_chars: int = 1 << 20, hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    ``cache`` is the folder of the cache table, made if it isn't there; without
    one, a run uses an empty cache of its own.  ``tokenizer_path`` must be
    readable on every executor.
    """
    spark = docs.sparkSession
    cache = cache or new_cache(spark)
    version = load(tokenizer_path)[2]
    spark.createDataFrame([], _CACHE).write.mode("append").parquet(cache)

    def known() -> DataFrame:
        return spark.read.schema(_CACHE).parquet(cache).where(F.col("tokenizer") == F.lit(version)).select("content", "n_tokens")

    def encode_misses(batches):
        encode = load(tokenizer_path)[0]
        for batch in batches:
            text, counts, start = batch.column(1).to_pylist(), [], 0
            while start < len(text):  # bounds the ids held at once, not the text
                end, size = start, 0
                while end < len(text) and (end == start or size < chunk_chars):
                    size += len(text[end])
                    end += 1
                counts += encode(text[start:end])
                start = end
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([version] * n, pa.binary()), pa.array(counts, pa.int64())], names=["content", "tokenizer", "n_tokens"])

    rows = docs.select("doc_id", whole_text("text").alias("text"))
    digests = staged(rows.mapInArrow(_digests(tokenizer_path), f"doc_id {dict(rows.dtypes)['doc_id']}, content binary, n_bytes long, key long, place long"), "token-digests")
    texts = missing_texts(docs, digests, known(), tokenizer_path, hot)
    if texts is not None:
        parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        dealt = texts.repartition(parts, "content")
        misses = dealt.join(known().select("content"), "content", "left_anti")  # dealt as the join needs it: texts move once
        misses.mapInArrow(lambda batches: encode_misses(_unseen(batches)), _CACHE).write.mode("append").parquet(cache)
    counts = staged(known().groupBy("content").agg(F.max("n_tokens").alias("n_tokens")), "token-counts")  # runs side by side may append a text twice
    return digests.join(counts, "content", "left").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def new_cache(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tidemark/token-cache-{uuid.uuid4().hex}"


def _unseen(batches):
    """Rows of a partition that holds all rows of its digests: the first of each."""
    seen: set[bytes] = set()
    for batch in batches:
        keep = []
        for k, digest in enumerate(batch.column(0).to_pylist()):
            if digest not in seen:
                seen.add(digest)
                keep.append(k)
        yield batch.take(pa.array(keep, pa.int64()))
