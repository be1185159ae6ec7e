"""The classifier's held-out accuracy; the rules' counts, tails and guarantees."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, rows
from wattloom.llm import classifier, queries, rules

DOCS = "doc_id bigint, text string, lang string, _id int, _text string, n_words string, score int"
ODD = [
    (0, None, "en"), (1, "", "en"), (2, " \n\t", None), (3, "one two", "en"), (4, "w " * 30_000, "de"),
    (5, "a b c d e f g h " * 5, "en"), (5, "a b c d e f g h " * 5, "en"), (None, "no id " * 20, "en"),
    (6, "x\x0by\x1cz q # $ % <a> |\nl\nl\n l", "zz"), (7, "ÀÉ 日本 😀 " * 10, "fr"),
]


def odd(spark):
    return spark.createDataFrame([(*r, 1, "t", "n", 3) for r in ODD], DOCS)


def labels(spark, pairs=()):
    return spark.createDataFrame(list(pairs), "doc_id bigint, quality int, toxic int, _label int")


@pytest.fixture(scope="module")
def scored(spark):
    return queries.queries()["op7_ftrl_quality"](spark, SF).collect()


def test_held_out_accuracy(spark, scored):
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(r["predicted"], truth[r["doc_id"]]) for r in scored if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 50
    assert sum(p == t for p, t in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in scored)
    assert len(scored) == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_held_out_labels_are_never_read(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = spark.read.parquet(f"{SF}/labels.parquet")
    poisoned = known.withColumn(
        "quality", F.when(classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    assert np.array_equal(classifier.train(docs, known), classifier.train(docs, poisoned))


def test_the_sample_is_bounded(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = spark.read.parquet(f"{SF}/labels.parquet")
    few = classifier.train(docs, known, sample=20)
    assert 0 < np.count_nonzero(few) < np.count_nonzero(classifier.train(docs, known))


def test_scores_of_odd_texts(spark):
    found = classifier.scores(odd(spark), labels(spark)).collect()
    assert len(found) == len(ODD) and {r["score"] for r in found} == {0.5}
    trained = labels(spark, [(4, 0, 0, 0), (5, 1, 0, 0), (5, 1, 0, 0), (7, None, 0, 0), (None, 1, 0, 0)])
    found = classifier.scores(odd(spark), trained).collect()
    assert len(found) == len(ODD) and all(0 <= r["score"] <= 1 for r in found)
    assert classifier.scores(odd(spark).limit(0), trained).count() == 0
    kept = classifier.accepted(odd(spark), trained)
    assert kept.columns == odd(spark).columns and kept.count() <= len(ODD)


def test_ftrl_learns_a_line():
    draw = np.random.default_rng(1)
    model = classifier.FollowTheLeader(3)
    for _ in range(3000):
        x = draw.normal(size=3)
        model.learn(np.arange(3), x, int(2 * x[0] - x[1] > 0))
    w = model.weights()
    assert w[0] > 1 and w[1] < -0.5 and abs(w[2]) < 0.5


def test_ftrl_and_scores_match_plain_ones():
    """Plain dictionaries, one number at a time, on the same texts."""
    grams = classifier.Grams(12)
    texts = [("good words here, all fine 12", 1), ("BUY now BUY now BUY", 0), ("", 0), ("good good words", 1)] * 5
    model, z, n = classifier.FollowTheLeader(1 << 12), {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= classifier.L1:
            return 0.0
        pull = math.copysign(classifier.L1, z[i]) - z[i]
        return pull / ((classifier.SMOOTHING + math.sqrt(n[i])) / classifier.RATE + classifier.L2)

    for text, label in texts:
        vector = {}
        for slot, value in zip(*grams.features(text), strict=True):
            vector[int(slot)] = vector.get(int(slot), 0.0) + float(value)
        w = {i: weight(i) for i in vector}
        error = 1 / (1 + math.exp(-sum(w[i] * x for i, x in vector.items()))) - label
        for i, x in vector.items():
            grown = n.get(i, 0.0) + (error * x) ** 2
            z[i] = z.get(i, 0.0) + error * x - (math.sqrt(grown) - math.sqrt(n.get(i, 0.0))) / classifier.RATE * w[i]
            n[i] = grown
        model.learn(*classifier.merged(*grams.features(text)), label)
    learnt = model.weights()
    assert np.allclose(learnt, [weight(i) for i in range(1 << 12)])
    for text, _ in texts[:4]:
        slots, values = grams.features(text)
        assert math.isclose(learnt[slots] @ values, sum(weight(int(i)) * x for i, x in zip(slots, values, strict=True)), abs_tol=1e-9)


def test_the_sample_counts_documents(spark):
    known = labels(spark, [(i, i % 2, 0, 0) for i in range(40)])
    own = [(i, f"word{i % 2} text") for i in range(1, 40, 3) for _ in range(5)]
    docs = spark.createDataFrame(own, "doc_id bigint, text string")
    once = docs.dropDuplicates()
    for sample in (3, 40):
        assert np.array_equal(classifier.train(docs, known, sample=sample), classifier.train(once, known, sample=sample))
    assert np.count_nonzero(classifier.train(docs, known, sample=2)), "labels without a document take no place"


# --- rules --------------------------------------------------------------------------------------


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)
    )


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_counts_on_whole_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = queries.queries()["op6_risk_controlled_rules"](spark, SF).collect()
    assert len(found) == len(texts)
    for r in found:
        counts = plain_counts(texts[r["doc_id"]])
        assert tuple(r[c] for c in COUNTS) == counts
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_counts_of_odd_texts(spark):
    found = rules.verdicts(odd(spark), labels(spark)).select("doc_id", *COUNTS)
    assert rows(found) == sorted(((d, *plain_counts(t)) for d, t, _ in ODD), key=repr)
    assert rules.verdicts(odd(spark).limit(0), labels(spark)).count() == 0


def test_rows_of_odd_texts_are_kept_whole(spark):
    docs = odd(spark)
    kept = rules.kept_rows(docs, labels(spark))
    assert kept.columns == docs.columns
    fine = [d for d, t, _ in ODD if not ((c := plain_counts(t))[0] < 20 or 100 * c[4] > 30 * c[0])]
    assert rows(kept, "doc_id") == sorted(((d,) for d in fine), key=repr)


def test_binomial_tail(spark):
    cases = [(k, n, p) for n in (1, 7, 60, 900) for p in (0.0025, 0.05, 0.3) for k in {0, 1, n // 20, n // 3, n - 1, n}]
    df = spark.createDataFrame(cases, "k int, n int, p double")
    for r in df.withColumn("tail", rules.binomial_tail(F.col("k"), F.col("n"), F.col("p"))).collect():
        k, n, p = r["k"], r["n"], r["p"]
        want = math.fsum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert r["tail"] == pytest.approx(want, rel=1e-7, abs=1e-12)


def labelled(spark, n, bad_share):
    """Good documents without signs, bad ones with a third of them; one stratum large, one small."""
    big = spark.range(n).selectExpr(
        "'en' AS _stratum", f"int(id % {bad_share} > 0) AS _label", f"IF(id % {bad_share} = 0, 0.35, IF(id % 1000 = 1, 0.05, 0.0)) AS symbol_share"
    )
    small = spark.range(100).selectExpr("'xx' AS _stratum", "int(id % 2) AS _label", "IF(id % 2 = 0, 0.35, 0.0) AS symbol_share")
    both = big.union(small)
    return both.withColumns({m: F.lit(0.0) for m in rules.CUTOFFS if m != "symbol_share"})


def test_cutoffs_need_evidence(spark):
    found = {r["_stratum"]: r for r in rules.chosen_cutoffs(labelled(spark, 20_000, 10)).collect()}
    assert "xx" not in found, "a hundred labels can't certify a risk of a quarter percent"
    # 0.3 catches all bad documents; tighter cutoffs catch no more, so the loosest of them is taken.
    assert found["en"]["symbol_share"] == 0.3


def test_few_hundred_labels_certify_the_union(spark):
    strata = spark.createDataFrame([("de",), ("en",), ("fr",), ("xx",)], "_stratum string")
    each = strata.crossJoin(spark.range(1000)).filter("id < IF(_stratum = 'xx', 436, 437) OR id >= 980")
    measured = each.selectExpr("_stratum", "int(id < 980) AS _label", "IF(id < 980, 0.0, 0.35) AS symbol_share")
    measured = measured.withColumns({m: F.lit(0.0) for m in rules.CUTOFFS if m != "symbol_share"})
    found = {r["_stratum"]: r["symbol_share"] for r in rules.chosen_cutoffs(measured, 0.01, 0.05).collect()}
    assert found == {"de": 0.3, "en": 0.3, "fr": 0.3}, "437 labels do for a union risk of 1 %, 436 don't"


def test_the_union_of_rules_is_what_is_controlled(spark):
    # Each rule alone rejects 0.9 % of the good documents, both together 1.8 %.
    measured = spark.range(20_000).selectExpr(
        "'en' AS _stratum", "int(id >= 1000) AS _label", "CASE WHEN id < 1000 OR id % 1000 < 9 THEN 0.35 ELSE 0.0 END AS symbol_share",
        "CASE WHEN id < 1000 OR id % 1000 >= 991 THEN 35.0 ELSE 1.0 END AS word_length",
    ).withColumns({m: F.lit(0.0) for m in ("dup_line_share", "repeat_share")})
    found = rules.chosen_cutoffs(measured, 0.015).collect()
    assert [(r["symbol_share"], r["word_length"]) for r in found] == [(0.3, 40.0)]


def test_junk_that_passes_the_base_rules_is_rejected(spark):
    docs, known = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    truth = known.groupBy("doc_id").agg(F.min("quality").alias("label")).dropna()
    english = docs.filter("lang = 'en'").select("doc_id").distinct()
    found = rules.verdicts(docs, known, risk=0.05).filter("NOT base_failed").join(truth, "doc_id").join(english, "doc_id").collect()
    bad, good = ([r["kept"] for r in found if r["label"] == x] for x in (0, 1))
    assert len(bad) > 20 and bad.count(True) <= 0.1 * len(bad)
    assert good.count(False) <= 0.05 * len(good)


def test_guarantee_over_repeated_draws():
    """A cutoff that truly rejects too much is certified in at most `error` of the draws."""
    draw, risk, error, n = np.random.default_rng(4), 0.02, 0.05, 2000

    def tail(k):
        return math.fsum(math.comb(n, i) * risk**i * (1 - risk) ** (n - i) for i in range(k + 1))

    most = max(k for k in range(60) if tail(k) <= error)
    assert (draw.binomial(n, risk * 1.001, 4000) <= most).mean() <= error + 0.01
