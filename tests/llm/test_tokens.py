"""Token counts, byte-level BPE and packing against the tokenizers' own libraries."""

import gc
import hashlib
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.conftest import SF_SMALL, rows
from wattloom.llm import packing, queries, token_counts
from wattloom.llm.byte_bpe import Encoder, StreamDecoder, Transducer, decoded, load_ranks
from wattloom.llm.common import scratch_path

JSON = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN
SCHEMA = "doc_id bigint, text string, n_tokens string, digest int, _task int"
ODD = [
    None, "", " ", "  two  spaces ", "a\n b", "don't  stop<|endoftext|> x", "naïve café ÀÉÎ", "日本語 テスト　x",
    "x" * 5000, "\n\n\nx\t\ty ", "x\x1cy z\x85w", "\U0001f600\U0001f601 ok", "é İstanbul ΣΑΣ", "same", "same",
    "<|startoftext|>a b<|endoftext|>", "12345 6,789.0 --- ***", "﻿bom ​ zero",
]


@pytest.fixture(scope="module")
def encoder():
    return Encoder(RANKS, PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


def odd_docs(spark):
    return spark.createDataFrame([(i, t, "c", 1, 2) for i, t in enumerate(ODD)], SCHEMA)


def documents(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


def test_transducer_on_odd_texts(encoder, library):
    for text in ODD[1:]:
        assert encoder.encode(text) == library.encode_ordinary(text)
        assert encoder.encode(text) == library.encode_ordinary(text), "again, from memory"


@settings(max_examples=100, deadline=None)
@given(st.text())
def test_transducer_on_any_text(text):
    own = test_transducer_on_any_text.__dict__.setdefault("own", Encoder(RANKS, PATTERN))
    lib = test_transducer_on_any_text.__dict__.setdefault(
        "lib", tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
    )
    ids = own.encode(text)
    assert ids == lib.encode_ordinary(text)
    assert b"".join(decoded(ids, own.transducer.bytes_of, 1)).decode() == text


def test_transducer_forgets_and_goes_on(library):
    small = Transducer(RANKS, max_steps=50)
    for word in ["supercalifragilistic", "antidisestablishment", "zzzzqqqq", "thththerean"] * 3:
        assert small.encode(word.encode()) == library.encode_ordinary(word)


def test_decoder_never_cuts_a_character():
    parts = {i: bytes([b]) for i, b in enumerate("aé日😀".encode())}
    decoder, out = StreamDecoder(parts), []
    for i in range(len(parts)):
        out.append(decoder.feed([i]))
        out[-1].decode()
    assert b"".join([*out, decoder.close()]).decode() == "aé日😀"
    broken = {0: b"\xe6\x97", 1: b"a", 2: b"\xff"}
    decoder = StreamDecoder(broken)
    assert decoder.feed([0]) == b""
    assert decoder.feed([1, 2]) + decoder.close() == b"\xe6\x97a\xff"


def test_round_trips(spark, library):
    texts = documents(spark)
    found = queries.queries()["op8_byte_bpe"](spark, SF_SMALL).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_counts_are_the_librarys(spark):
    texts, library = documents(spark), Tokenizer.from_file(JSON)
    found = queries.queries()["op2_token_counts"](spark, SF_SMALL).collect()
    assert len(found) == len(texts)
    for r in found:
        n = len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 512)


def test_counts_of_odd_texts_and_the_cache(spark):
    cache, library = scratch_path(spark, "test-cache"), Tokenizer.from_file(JSON)
    docs = odd_docs(spark)
    want = sorted((i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(ODD))
    assert rows(token_counts.token_counts(docs, cache, JSON), "doc_id", "n_tokens") == sorted(want, key=repr)
    stored = spark.read.parquet(cache).count()
    assert stored == len({t or "" for t in ODD})
    assert rows(token_counts.token_counts(docs, cache, JSON), "doc_id", "n_tokens") == sorted(want, key=repr)
    assert spark.read.parquet(cache).count() == stored, "nothing was missing"
    token_counts.token_counts(docs, cache, WORDS).count()
    assert spark.read.parquet(cache).count() == 2 * stored, "another tokenizer has counts of its own"
    assert token_counts.token_counts(docs.limit(0), cache, JSON).count() == 0


def check_packing(found, texts, capacity=4096):
    library = Tokenizer.from_file(WORDS)
    by_doc, by_bin = {}, {}
    for r in found:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_bin.setdefault(r["sequence_id"], []).append(r)
    for doc, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        at = 0
        for nth, r in enumerate(sorted(by_doc[doc], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (nth, at)
            assert r["ids_crc32"] == zlib.crc32(ids[4 * at : 4 * (at + r["length"])])
            at += r["length"]
        assert 4 * at == len(ids) and nth + 1 == -(-at // capacity)
    for pieces in by_bin.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_bin), -(-sum(r["length"] for r in found) // capacity)


def test_packing_is_whole_and_tight(spark):
    bins, least = check_packing(queries.queries()["op4_best_fit_packing"](spark, SF_SMALL).collect(), documents(spark))
    assert bins <= least + 1


def test_packing_odd_texts(spark):
    check_packing(packing.pack(odd_docs(spark), WORDS).collect(), dict(enumerate(ODD)))
    check_packing(packing.pack(odd_docs(spark), WORDS, capacity=7).collect(), dict(enumerate(ODD)), 7)
    assert packing.pack(odd_docs(spark).limit(0), WORDS).count() == 0


def word_memories(batches):
    packing_there = sys.modules.get("wattloom.llm.packing")
    for _ in batches:
        held = [o for o in gc.get_objects() if packing_there and type(o) is packing_there.WordIds]
        yield pa.RecordBatch.from_pydict({"n": pa.array([len(held)], pa.int64())})


def test_packing_leaves_no_words_in_the_workers(spark):
    packing.pack(odd_docs(spark).repartition(8), WORDS).count()
    held = spark.range(0, 64, numPartitions=64).mapInArrow(word_memories, "n bigint").collect()
    assert len(held) >= 64 and sum(r["n"] for r in held) == 0


def remembered(encoder):
    return [word for held in vars(encoder).values() if isinstance(held, dict) for word in held]


def test_packing_remembers_words_within_bounds():
    encoder = packing.WordIds(WORDS)
    for i in range(900):
        encoder.ids(" ".join(f"w{i}x{j}" for j in range(1000)))
    assert packing.MEMO <= len(remembered(encoder)) <= 2 * packing.MEMO + 1000 <= 700_000
    encoder = packing.WordIds(WORDS, characters=10_000)
    for i in range(300):
        encoder.ids(f"{i:04}" * 50)
    assert sum(map(len, remembered(encoder))) <= 20_400


def test_packing_forgets_and_goes_on():
    texts = ["Three cats, two dogs", "naïve café ÀÉÎ three", "two x\x1cy z\x85w 日本語 three", "a b c d e f", "dogs café"]
    library = Tokenizer.from_file(WORDS)
    for small in (packing.WordIds(WORDS, 3), packing.WordIds(WORDS, 1000, 12)):
        for text in texts * 3:
            ids = library.encode(text, add_special_tokens=False).ids
            assert small.ids(text) == np.array(ids, "<u4").tobytes()
        assert len(remembered(small)) < len({w for text in texts for w in text.split(" ")})


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 40), max_size=12))
def test_plan_uses_every_piece_once(histogram):
    plan = packing.plan_bins(histogram, 30)
    used = {}
    for bin_, times in plan:
        assert sum(bin_) <= 30 and times > 0
        for n in bin_:
            used[n] = used.get(n, 0) + times
    assert used == histogram


def test_fullest_finds_the_best_sum():
    from itertools import combinations

    lengths = {13: 1, 11: 2, 7: 1, 5: 1, 3: 1}
    flat = [n for n, c in lengths.items() for _ in range(c)]
    for room in range(1, 40):
        best = max(s for k in range(len(flat) + 1) for c in combinations(flat, k) if (s := sum(c)) <= room)
        assert sum(packing.fullest(sorted(lengths, reverse=True), lengths, room)) == best
