"""Source mixing against a plain version."""

import re

import pytest

from tests.conftest import SF_SMALL, rows
from wattloom.llm import mixing, queries

SCHEMA = "doc_id bigint, text string, source string, size int, content string, _at int"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight; whatever lies above a cap is shared anew until nothing does."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, full = dict.fromkeys(order, 0.0), set()
    left = float(sum(sizes.values()))
    while left > 1e-9 and len(full) < len(order):
        free = sum(w for s, w in weight.items() if s not in full)
        share, left = left / free, 0.0
        for s in [s for s in order if s not in full]:
            target[s] += share * weight[s]
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                full.add(s)
    return target


def check(found, docs, most=3):
    assert sorted((repr(r["doc_id"]), r["size"]) for r in found) == sorted((repr(d), words(t)) for d, t, _ in docs)
    sizes = {}
    for _, t, s in docs:
        sizes[s] = sizes.get(s, 0) + words(t)
    expected, taken = plain_targets(sizes, most=most), dict.fromkeys(sizes, 0)
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]], abs=1e-6)
        assert 0 <= r["taken"] <= most * r["size"]
        taken[r["source"]] += r["taken"]
        # Whole epochs for all, one more for those ahead of the cut.
        epochs = round(r["target"]) // max(r["source_size"], 1)
        assert epochs * r["size"] <= r["taken"] <= (epochs + 1) * r["size"]
    for s, n in taken.items():
        assert n == int(expected[s] + 0.5 + 1e-9)
    cut = [r for r in found if r["size"] and r["taken"] % r["size"]]
    assert len(cut) <= len(sizes), "one row at a cut"


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    found = mixing.mixed(docs).collect()
    check(found, [tuple(r) for r in docs.select("doc_id", "text", "source").collect()])
    again = queries.queries()["op13_source_mixing"](spark, SF_SMALL)
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    assert again.columns == columns
    assert rows(again) == rows(mixing.mixed(docs.repartition(7)), *columns), "reruns agree, however rows are dealt"


def odd():
    texts = [(1, None, "a"), (2, "", "a"), (3, " \t\n", None), (None, "x y z", "b"), (None, None, None)]
    texts += [(4, "same words here", "hot")] * 50 + [(i, "w " * i, "hot") for i in range(10, 60)]
    return texts + [(5, "é " * 30_000, "long"), (6, "one\x0btwo\x0cthree\xa0four", "é"), (7, "p q", "Z"), (8, "m " * 400, None)]


def test_odd_rows(spark):
    docs = odd()
    frame = spark.createDataFrame([(d, t, s, 1, "c", 2) for d, t, s in docs], SCHEMA)
    check(mixing.mixed(frame).collect(), docs)
    assert mixing.mixed(frame.limit(0)).count() == 0
    nothing = mixing.mixed(frame.filter("text IS NULL")).collect()
    assert {(r["target"], r["taken"]) for r in nothing} == {(0.0, 0)}


def test_hot_source_is_spread(spark):
    frame = spark.createDataFrame([(i, "a b c", "hot") for i in range(4000)], "doc_id bigint, text string, source string")
    summed = mixing.with_sums_before(
        frame.selectExpr("source", "doc_id", "3L AS size"), [frame["source"], frame["doc_id"]], {"before": "size"}
    )
    assert [r["before"] for r in summed.orderBy("doc_id").collect()] == list(range(0, 12000, 3))


def test_mixture_holds_what_was_taken(spark):
    docs = odd()
    frame = spark.createDataFrame([(d, t, s, 1, "c", 2) for d, t, s in docs], SCHEMA)
    out = mixing.mixture(frame)
    assert out.columns == frame.columns
    taken, held = {}, {}
    for r in mixing.mixed(frame).collect():
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for r in out.collect():
        held[r["source"]] = held.get(r["source"], 0) + words(r["text"])
    assert held == {s: n for s, n in taken.items() if n}
