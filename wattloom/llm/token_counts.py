"""Token counts behind a digest cache.

A text is known by the SHA-256 of its normalised content (null is empty, nothing else changes: a
byte-level vocabulary tells all texts apart) and by the digest of the tokenizer's file. Counts are
stored under both; only distinct texts that the cache lacks are encoded, and then appended to it.

Nulls and empty texts count 0 tokens. Copies are encoded once. Without rows the result is empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import whole_text
from wattloom.llm.subwords import PlainWords

CACHE = "tokenizer string, digest binary, n_tokens bigint"
LIMIT = 512
MEMO = 500_000


class ChunkCounter:
    """Token counts of texts, encoding every distinct space-separated chunk about once.

    A byte-level pre-tokenizer never joins what a single space between two other characters
    parts, the space going with what follows. So a text is the sum of its chunks, as long as no
    chunk is empty, has white space at an end or may hold a special token; other texts are
    encoded whole. The memory of chunks is emptied when it is full.
    """

    def __init__(self, path: str, memo: int = MEMO):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = PlainWords(self.tokenizer, space=True, lower=False)
        self.memo: dict[str, int] = {}
        self.limit = memo
        self.encoded = 0

    def _encode(self, texts: list[str]) -> list[int]:
        self.encoded += len(texts)
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [len(e.ids) for e in found]

    def _learn(self, chunks: list[str]) -> None:
        others = []
        for chunk in set(chunks):
            ids = self.plain.ids(chunk)
            if ids is None:
                others.append(chunk)
            else:
                self.memo[chunk] = len(ids)
        self.memo.update(zip(others, self._encode([" " + c for c in others]), strict=True))

    @staticmethod
    def _local(chunk: str) -> bool:
        return bool(chunk) and not chunk[0].isspace() and not chunk[-1].isspace() and "<|" not in chunk

    def counts(self, texts: list[str]) -> list[int]:
        if len(self.memo) > self.limit:
            self.memo.clear()
        memo, out = self.memo, [0] * len(texts)
        later, misses, whole = [], [], []
        for i, text in enumerate(texts):
            if not text:
                continue
            head, *chunks = text.split(" ")
            missing = [c for c in chunks if c not in memo]
            if all(map(self._local, missing)) and self._local(head):
                misses.extend(missing)
                later.append((i, head, chunks))
            else:
                whole.append(i)
        self._learn(misses)
        heads = list({h for _, h, _ in later})
        first = dict(zip(heads, self._encode(heads), strict=True))
        for i, head, chunks in later:
            out[i] = first[head] + sum(map(memo.__getitem__, chunks))
        for i, n in zip(whole, self._encode([texts[i] for i in whole]), strict=True):
            out[i] = n
        return out


@lru_cache(maxsize=2)
def counter(path: str) -> ChunkCounter:
    return ChunkCounter(path)


def count_tokens(path: str):
    """A column function from text to its number of tokens."""

    @F.arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(counter(path).counts(texts.to_pylist()), pa.int64())

    return count


def file_digest(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


def text_digest(text) -> F.Column:
    return F.unhex(F.sha2(text, 256))


def fill_cache(docs: DataFrame, cache: str, tokenizer: str, text: str = "text") -> DataFrame:
    """Encodes the distinct texts that the cache at `cache` lacks, appends their counts to it, and
    returns this tokenizer's counts as (digest, n_tokens)."""
    spark, version = docs.sparkSession, file_digest(tokenizer)
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache)
    stored = spark.read.schema(CACHE).parquet(cache).filter(F.col("tokenizer") == version)
    content = whole_text(text)
    distinct = docs.select(text_digest(content).alias("digest"), content.alias("content"))
    distinct = distinct.groupBy("digest").agg(F.first("content").alias("content"))
    misses = distinct.join(stored.select("digest"), "digest", "left_anti")
    misses.select(
        F.lit(version).alias("tokenizer"), "digest", count_tokens(tokenizer)("content").alias("n_tokens")
    ).write.mode("append").parquet(cache)
    # Two runs at once may store a count twice.
    now = spark.read.schema(CACHE).parquet(cache).filter(F.col("tokenizer") == version)
    return now.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(
    docs: DataFrame, cache: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit for each row, repeated rows included."""
    counts, content = fill_cache(docs, cache, tokenizer, text), whole_text(text)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.octet_length(content).cast("bigint").alias("n_bytes"),
        text_digest(content).alias("digest"),
    )
    return rows.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
