"""The corpus pipeline stage by stage against plain versions, each over what the stage before it kept."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.test_dedup import plain_decisions, plain_fingerprint, sets_of
from tests.llm.test_quality import plain_counts
from tests.llm.test_tokens import check_packing
from wattloom.llm import classifier
from wattloom.llm.common import written


@pytest.fixture(scope="module")
def outputs(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumns(
        {"score": F.lit("s"), "_content": F.lit(1), "kept": F.lit(None).cast("boolean")}
    )
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF_SMALL), name))
    return out


def by_id(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_names_and_columns(outputs):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "quality_rules", "line_dedup", "near_dedup", "best_fit_packing"]
    assert all(df.dtypes == outputs[0].dtypes for df in outputs[:-1])


def test_classifier_stage(spark, outputs):
    weights = classifier.train(outputs[0], spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    grams = classifier.Grams()

    def score(text):
        slots, values = grams.features(text)
        return 1 / (1 + np.exp(-(weights[slots] @ values)))

    assert by_id(outputs[1]) == {d: t for d, t in by_id(outputs[0]).items() if score(t) >= 0.7}


def test_rules_stage(outputs):
    # Too few labels here for any cutoff: the base rules decide.
    def fine(text):
        n, _, _, _, repeated = plain_counts(text)
        return n >= 20 and 100 * repeated <= 30 * n

    assert by_id(outputs[2]) == {d: t for d, t in by_id(outputs[1]).items() if fine(t)}


def test_line_stage(outputs):
    before = by_id(outputs[2])
    gone = dict(plain_decisions(list(before.items())))
    want = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) for d, t in before.items()}
    assert by_id(outputs[3]) == want
    assert sum(map(len, gone.values())) > 0
    assert all(r["n_chars"] == len(r["text"]) for r in outputs[3].collect())


def test_near_stage(outputs):
    before = sorted(by_id(outputs[3]).items())
    prints = np.array([plain_fingerprint(t) for _, t in before], np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    roots = sets_of(len(before), zip(*np.where(np.triu(near, 1)), strict=True))
    assert by_id(outputs[4]) == {before[i][0]: before[i][1] for i in set(roots)}


def test_packing_stage_and_run(spark, outputs):
    found = outputs[5].collect()
    bins, least = check_packing(found, by_id(outputs[4]))
    assert bins <= least + 1
    keys = lambda rows: sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in rows)
    assert keys(corpus_pipeline.run(spark, SF_SMALL).collect()) == keys(found)


def test_no_rows_go_through_all_stages(spark, outputs):
    docs = outputs[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0
        docs = docs if "text" in docs.columns else outputs[0].limit(0)
