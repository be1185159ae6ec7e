"""Cross-tokenizer alignment against the libraries and a plain comparison of byte ranges."""

import hashlib
from collections import Counter
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import SF_SMALL, rows
from wattloom.llm import alignment, queries
from wattloom.llm.alignment import Fragment, composed, fragment, start

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, row int, pairs string, digest int, nth int"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "  two  spaces ", "a\n b \n c", "don't  stop<|endoftext|> x <s>y</s> <unk>", "naïve café",
    "日本語 テスト　x", "日" * 300, "a▁b", "▁", "x" * 500, "\n\n\nx\t\ty ", "x\x1c y\x85 z  w", "\U0001f600\U0001f601 ok",
    "same", "same", "<0x41> b", "12345 6,789.0 --- ***", "﻿bom ​ zero", "ﬁ ① ²", "a\x00b c", "İ ß Σ", "1 2  3   4",
]


@lru_cache(maxsize=1)
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    return a, b, alignment.Vocabularies(A, B)


def plain_tokens(text):
    a, b, v = libraries()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    of_a, of_b = [v.a_bytes[i] for i in ids_a], [v.b_bytes[i] for i in ids_b]
    if not text or not b"".join(of_a) == b"".join(of_b) == (" " + text).encode():
        return [], []
    return alignment.tokens_of(ids_a, v.a_bytes, 0), alignment.tokens_of(ids_b, v.b_bytes, 0)


def plain(text):
    """Groups' text, and the links by comparing ranges."""
    a, b = plain_tokens(text)
    links, starts = [], lambda t: [0, *(end for _, end in t)]
    for (x, x_end), x_from in zip(a, starts(a), strict=False):
        for (y, y_end), y_from in zip(b, starts(b), strict=False):
            if x_from < y_end and y_from < x_end:
                links.append((x, y))
    cuts = sorted({e for _, e in a} & {e for _, e in b})
    groups = []
    for lo, hi in zip([0, *cuts], cuts, strict=False):
        sides = [",".join(str(i) for i, e in t if lo < e <= hi) for t in (a, b)]
        groups.append("|".join(sides))
    return len(a), len(b), groups, links


def expected(docs):
    found = [(d, *plain(t or "")) for d, t in docs]
    counts = Counter(p for *_, links in found for p in set(links))
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for d, n_a, n_b, groups, links in found:
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else ""
        best = sum(counts[p] == most[p[0]] for p in links)
        out.append((d, n_a, n_b, len(groups), len(links), best, sum(counts[p] for p in links), sha))
    return sorted(out, key=repr)


def odd_docs(spark):
    docs = [(i if i % 5 else None, t) for i, t in enumerate(ODD)]
    return docs, spark.createDataFrame([(d, t, 1, "p", 2, 3) for d, t in docs], SCHEMA)


@pytest.mark.parametrize("range_bytes,broadcast", [(65_536, 10**6), (10, 0), (1, 0)])
def test_odd_texts(spark, range_bytes, broadcast):
    """Whole, and in ranges of ten bytes; with the counts broadcast and joined by shuffle."""
    docs, frame = odd_docs(spark)
    found = alignment.aligned_documents(frame, A, B, range_bytes=range_bytes, broadcast_pairs=broadcast)
    assert found.columns == COLUMNS
    assert rows(found) == expected(docs)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter("length(text) < 4000")
    short = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows(alignment.aligned_documents(docs, A, B)) == expected(short)


def test_whole_table_and_ranges_agree(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    whole = queries.queries()["op12_tokenizer_alignment"](spark, SF_SMALL)
    assert whole.columns == COLUMNS
    cut = alignment.aligned_documents(docs, A, B, range_bytes=500, broadcast_pairs=0)
    assert rows(whole) == rows(cut)
    assert whole.count() == docs.count() and whole.filter("n_a > 0 AND n_best > 0").count() > 100


def test_one_very_long_text(spark):
    text = "Der Fluss, der 1,234 Meter fließt; don't\nstop now. " * 8000
    frame = spark.createDataFrame([(1, text), (2, "x"), (1, text)], "doc_id bigint, text string")
    texts = frame.filter("doc_id = 1").limit(1).select(F.lit("d").alias("digest"), "text")
    assert texts.mapInArrow(alignment._ranges(65_536), alignment.RANGES).count() > 5
    found = {r["doc_id"]: r for r in alignment.aligned_documents(frame, A, B).collect()}
    a, b = plain_tokens(text)
    whole = composed(start(), fragment(a, b))
    assert (found[1]["n_a"], found[1]["n_groups"], found[1]["n_links"]) == (len(a), whole.n_groups, whole.n_links)
    assert found[1]["groups_sha256"] == hashlib.sha256(";".join(whole.text).encode()).hexdigest()


def test_no_rows(spark):
    assert alignment.aligned_documents(spark.createDataFrame([], SCHEMA), A, B).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1), st.lists(st.integers(1, 4), min_size=1), st.data())
def test_composition_is_associative(of_a, of_b, data):
    """Cut the two token streams where one likes, bracket as one likes: always the same."""
    def tokens(lengths, total):
        out, at = [], 0
        for i, n in enumerate(lengths):
            at += n
            out.append((i, at))
        return [*out, (len(out), total)]

    total = max(sum(of_a), sum(of_b)) + 1
    a, b = tokens(of_a, total), tokens(of_b, total)
    n = data.draw(st.integers(1, 5))
    cut = lambda t: sorted(data.draw(st.lists(st.integers(0, len(t)), min_size=n - 1, max_size=n - 1)))
    at_a, at_b = [0, *cut(a), len(a)], [0, *cut(b), len(b)]
    # Cuts in line with each other: a range of the one side doesn't begin behind a later range of the other.
    parts = [fragment(a[at_a[i] : at_a[i + 1]], b[at_b[i] : at_b[i + 1]]) for i in range(n)]
    expected = composed(start(), fragment(a, b))

    def product(lo, hi):
        if hi - lo == 1:
            return parts[lo]
        mid = data.draw(st.integers(lo + 1, hi - 1))
        return composed(product(lo, mid), product(mid, hi))

    found = composed(start(), product(0, n))
    key = lambda f: (f.n_a, f.n_b, f.n_groups, f.n_links, f.pairs, f.text)
    assert key(found) == key(expected)
    assert alignment.loaded(alignment.dumped(found)) is not None


def test_chunks_are_the_text():
    for text in ODD:
        if text:
            assert " ".join(alignment.chunks_of(text)) == text
    assert alignment.chunks_of("a  b\n c") == ["a", " b\n c"]
    assert isinstance(composed(Fragment(), Fragment()), Fragment)


def test_batches_are_cut_by_bytes():
    texts = ["ab", "é" * 9, "", None, "x" * 50, "c", "d"]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(7)), "text": pa.array(texts, pa.string())})
    for size in (0, 1, 2, 20, 70, 1000):
        parts = list(alignment.slices(batch, size))
        assert [t for p in parts for t in p.column("text").to_pylist()] == texts
        assert all(p.num_rows == 1 or sum(len((t or "").encode()) for t in p.column("text").to_pylist()) <= size for p in parts)
    assert list(alignment.slices(batch.slice(0, 0))) == []
