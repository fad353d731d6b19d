import pytest

from flowgauge.catalog import model_queries
from flowgauge.operators import models
from flowgauge.plans import training

FOLDER = "/root/testdata/sf0.001"
TRAINERS = [(models, n) for n in ("train_forest", "train_boosted", "train_primary", "grid_search")] + [
    (training, n) for n in ("train", "quick_importance")]
QUERIES = ["forest", "boosted", "primary_model", "grid_search", "feature_importance", "stored_model", "stored_model_same", "classify",
           "probability_sums", "explain", "explain_first", "explain_sums", "detect", "quick_importance", "training_run", "forest_told", "boosted_told", "primary_told", "grid_told", "boosted_reload",
           "boosted_loss", "scoring_rate", "explaining_rate"]


class Called(Exception):
    pass


@pytest.mark.parametrize("name", QUERIES)
def test_queries_train_with_the_operators_own_values(spark, monkeypatch, name):
    """What a query hands over beside its rows and their order would replace a published value."""
    def trainer(of):
        def called(*args, **params):
            raise Called(args[2 if of is training else 1:], params)

        return called

    for of, what in TRAINERS:
        monkeypatch.setattr(of, what, trainer(of))
    with pytest.raises(Called) as seen:
        model_queries.QUERIES[name][0](spark, FOLDER)
    assert seen.value.args == ((), {})
