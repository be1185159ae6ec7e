"""Phrase collocations against SQL and a plain count."""

import re
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from tests.conftest import SF, rows
from verification.compare import difference, duck, oracle_rows
from wattloom.llm import collocations, queries

SCHEMA = "doc_id bigint, text string, lang string, n int, mark string, content int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, least, most):
    counts, total = {}, Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, 6):
                for i in range(len(words) - n + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        kept = []
        for p, a in often.items():
            inside = any(
                b >= a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in often.items()
            )
            if not inside:
                cut = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                k = cut[1]
                kept.append((-cut[0], -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out, key=repr)


def check(spark, docs, least=3, most=2000, bits=64):
    frame = spark.createDataFrame([(i, t, lang, 1, "m", 2) for i, (t, lang) in enumerate(docs)], SCHEMA)
    expected = plain(docs, least, most)
    found = collocations.collocations(frame.repartition(5), least, most, bits=bits)
    assert rows(found) == expected
    return expected


def test_matches_sql(spark):
    columns, expected = oracle_rows(duck(SF), entry.oracle_sql()["op11_phrase_collocations"])
    assert len(expected) > 50
    assert difference(queries.queries()["op11_phrase_collocations"](spark, SF), columns, expected) is None


ODD = [
    (None, "en"), ("", "en"), (" \t ", None), ("a", "en"), ("New  York\tCity, new york! NEW YORK city", None),
    ("new york", "und"), ("x\x0by\x0cx y\rx y\nx y", "en"), ("É é É é É é", "fr"), ("日本 語 日本 語。日本 語", "ja"),
    ("a b a b a b a b", "en"), ("to be or not to be to be or not to be to be or not to be", "en"), ("b", "en"),
    ("tail", "en"), ("tail tail tail tail", ""), ("\U0001f600 ok \U0001f600 ok \U0001f600 ok", "en"),
]


@pytest.mark.parametrize("bits", [64, 8])
def test_odd_texts(spark, bits):
    """Also with fingerprints of eight bits, nearly all of which collide."""
    assert len(check(spark, ODD * 2, 3, bits=bits)) > 5


def test_a_hot_text_and_a_language_of_its_own(spark):
    docs = [("common words again and again, common words", "en")] * 400
    docs += [(f"row {i} of a table", "en") for i in range(200)] + [("common words", "de")] * 5
    check(spark, docs, 100)
    check(spark, docs, 100, most=2)


def test_long_texts_in_blocks_and_windows(spark, monkeypatch):
    text = " ".join(f"w{i % 7} v{i % 3}" for i in range(3000)) + " " + "long" * 100
    for name, value in (("BLOCK_BYTES", 64), ("WINDOW_WORDS", 9), ("COUNTED_AT_ONCE", 500), ("POINTED_AT_ONCE", 300)):
        monkeypatch.setattr(collocations, name, value)
    # In this process, as tasks have the constants of their own.
    mark, check_ = collocations.fingerprints()
    batch = pa.RecordBatch.from_pydict({
        "text": pa.array([text, "", "w1 v1"]), "seed": pa.array([1, 1, 2], pa.int64()), "content": pa.array([5, 6, 7], pa.int64()),
    })
    counted = Counter()
    for b in collocations._count(64)(iter([batch])):
        for m, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            counted[m] += n
    words = text.split()
    expected = Counter(words) + Counter(zip(words, words[1:], strict=False)) + Counter(["w1", "v1", ("w1", "v1")])
    assert sorted(counted.values()) == sorted([*(Counter(words) + Counter(zip(words, words[1:]))).values(), 1, 1, 1])
    assert sum(counted.values()) == sum(expected.values())


def test_long_text(spark):
    check(spark, [(" ".join(f"w{i % 7} v{i % 3}" for i in range(200_000)), "en"), ("z" * 3_000_000 + " z z z", "en")], 3)


def test_tasks_hold_their_rows_once(monkeypatch):
    """A task's arrays stay near the size of the rows it may hold; copies of them were three times that and more."""
    draw = np.random.default_rng(3)
    for name, value in (("COUNTED_AT_ONCE", 1_000_000), ("POINTED_AT_ONCE", 400_000), ("ROWS_A_BATCH", 20_000)):
        monkeypatch.setattr(collocations, name, value)
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 1 << 14)

    def batches():
        for i in range(500):
            text = " ".join(f"{x:x}" for x in draw.integers(0, 1 << 40, 2000))
            yield pa.RecordBatch.from_pydict({
                "text": pa.array([text]), "seed": pa.array([1], pa.int64()), "content": pa.array([i], pa.int64())
            })

    everything = SimpleNamespace(value=np.full(64, ~np.uint64(0)))
    for task, rows_, row in (
        (collocations._count(64), 500 * 3999, 8 * 1_000_000),
        (collocations._point(64, everything), 500 * (2000 * 5 - 10), 5 * 8 * 400_000),
    ):
        tracemalloc.start()
        assert sum(sum(b.column("n").to_pylist()) for b in task(batches())) == rows_
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 1.8 * row


def test_a_task_gives_one_row_a_phrase(monkeypatch):
    """Triples that aren't frequent, whose pairs are, aren't pointed at; the others are, once a task."""
    monkeypatch.setattr(collocations, "POINTED_AT_ONCE", 200)
    mark, _ = collocations.fingerprints()
    texts = ["a b c"] * 300 + ["b c a b"] * 300
    batches = [
        pa.RecordBatch.from_pydict({
            "text": pa.array(texts[i : i + 50]), "seed": pa.array([1] * 50, pa.int64()), "content": pa.array(range(50), pa.int64())
        })
        for i in range(0, 600, 50)
    ]
    often = pa.array(["a", "b", "c", "a b", "b c", "a b c"])
    words = collocations.Words(often)
    hashes, bitmap = mark.of_words(words.data, words.starts, words.ends), np.zeros(1 << 14, np.uint64)
    for first, n in ((0, 1), (1, 1), (2, 1), (3, 2), (5, 2), (7, 3)):
        found = mark.of_phrases(hashes[first : first + n], np.ones(n, np.uint64), n)
        last = np.uint64(len(bitmap) * 64 - 1)
        for k in range(collocations.PROBES):
            place = ((found & last) + (found >> np.uint64(32) | np.uint64(1)) * np.uint64(k)) & last
            bitmap[place >> np.uint64(6)] |= np.uint64(1) << (place & np.uint64(63))
    pointed = [n for b in collocations._point(64, SimpleNamespace(value=bitmap))(iter(batches)) for n in b.column("n").to_pylist()]
    # a, b, c, a b, b c, a b c; neither b c a nor c a b.
    assert sorted(pointed) == [300, 600, 600, 600, 600, 900]


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert collocations.collocations(none).count() == 0
    assert check(spark, [("a b c", "en")], 100) == []


def test_filter_never_misses(spark):
    marks = spark.range(50_000).selectExpr("xxhash64(id) AS mark")
    bitmap = collocations.frequent_filter(marks, 50_000)
    own = marks.toArrow().column(0).to_numpy().view("uint64")
    assert collocations.in_filter(bitmap, own).all()
    others = spark.range(50_000, 100_000).selectExpr("xxhash64(id) AS mark").toArrow().column(0).to_numpy().view("uint64")
    assert collocations.in_filter(bitmap, others).mean() < 0.02
