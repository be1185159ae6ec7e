"""Model versions of runs that overlap or die."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer

from wattloom.sources import models
from wattloom.sources.tables import Tables


@pytest.fixture
def store(spark, tmp_path):
    return Tables(spark, str(tmp_path))


def model_of(n):
    return PipelineModel([SQLTransformer(statement=f"SELECT {n} AS n FROM __THIS__")])


def number(store, version="latest"):
    return models.load(store, "m", version).transform(store.spark.range(1)).first()[0]


def test_a_run_that_dies_before_its_row_is_not_in_the_way(store):
    assert models.save(store, model_of(1), "m") == 1
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Tables, "append", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            models.save(store, model_of(2), "m")
    assert models.resolve(store, "m") == 1 and number(store) == 1, "readers see recorded versions only"
    assert models.save(store, model_of(3), "m") == 3
    assert (number(store), number(store, 1)) == (3, 1)


def test_a_folder_without_claim_or_row_is_kept(store):
    model_of(9).write().save(models._path(store, "m", 1))
    assert models.save(store, model_of(2), "m") == 2
    assert (number(store), number(store, 1)) == (2, 9)


def test_runs_that_start_together_get_versions_of_their_own(store):
    with ThreadPoolExecutor(4) as pool:
        claimed = list(pool.map(lambda _: models._claimed(store, "m"), range(8)))
    assert len(set(claimed)) == 8 and min(claimed) >= 1
    assert models.save(store, model_of(1), "m") == max(claimed) + 1
    assert models._claimed(store, "other") == 1
