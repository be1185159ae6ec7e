"""The operators' queries over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.llm import (
    alignment,
    byte_bpe,
    classifier,
    collocations,
    common,
    lines,
    mixing,
    packing,
    pages,
    rules,
    shards,
    simhash,
    token_counts,
    topk,
)
from wattloom.session import configure

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Query) -> Query:
        _queries[name] = lambda spark, sf_dir: build(common.prepare(configure(spark)), str(sf_dir))
        if sql:
            _sql[name] = sql
        return build

    return register


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_token_counts")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A cache of its own for each run, so that the whole table is encoded; jobs keep one.
    cache = common.scratch_path(spark, "token-cache")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), cache, tokenizer("byte_bpe_50k.json"))


@query("op4_best_fit_packing")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@query("op5_byte_shards")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op8_byte_bpe")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = tokenizer("byte_bpe_50k.tiktoken")
    return byte_bpe.round_trips(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


TOP_K = """
WITH vectors AS (
    SELECT vec_id, min(list_transform(embedding, lambda x: floor(64 * x::DOUBLE))) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    GROUP BY vec_id),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM vectors q JOIN vectors c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id
    WHERE q.vec_id % 20 = 0),
ranked AS (
    SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
        vec_id, score
    FROM scored)
SELECT * FROM ranked WHERE rank <= 20
"""


@query("op10_exact_top_k", TOP_K)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Written, as it is counted and then read twice.
    vectors = common.written(topk.integer_vectors(table(spark, sf_dir, "embeddings")), "vectors")
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0)


@query("op3_simhash_near_dedup")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op1_line_dedup")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.decisions_by_document(table(spark, sf_dir, "documents"))


@query("op6_risk_controlled_rules")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_ftrl_quality")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_page_wrappers")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_texts(table(spark, sf_dir, "pages"))


@query("op13_source_mixing")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mixed(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


COLLOCATIONS = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(string_split_regex(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
grams AS (
    SELECT lang, k AS words, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i+k-1], ' '))) AS phrase
    FROM worded, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k),
known AS (SELECT lang, words, phrase, count(*)::BIGINT AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
several AS (SELECT *, string_split(phrase, ' ') AS w FROM known WHERE words > 1),
dropped AS (
    SELECT DISTINCT s.lang, s.phrase FROM several s JOIN several t ON s.lang = t.lang AND t.words > s.words
        AND contains(' ' || t.phrase || ' ', ' ' || s.phrase || ' ') AND 100 * t.a >= 100 * s.a),
cuts AS (
    SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k+1:], ' ') AS tail
    FROM (SELECT *, unnest(range(1, words)) AS k FROM several ANTI JOIN dropped USING (lang, phrase))),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, h.a AS l, t.a AS r, n.n,
        ((1000::HUGEINT * c.a * n.n) // (h.a::HUGEINT * t.a))::BIGINT AS score
    FROM cuts c JOIN known h ON h.lang = c.lang AND h.phrase = c.head
        JOIN known t ON t.lang = c.lang AND t.phrase = c.tail JOIN totals n ON n.lang = c.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
        phrase, a, l, r, n, score
    FROM lowest)
SELECT * FROM ranked WHERE rank <= 2000
"""


@query("op11_phrase_collocations", COLLOCATIONS)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op12_tokenizer_alignment")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.aligned_documents(docs, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))
