"""The registered model queries train with the library's own settings."""

import pytest

import __spark_entry__ as registry
from clickstrata.operators import boosting
from clickstrata.plans import modelling


class Seen(Exception):
    pass


@pytest.mark.parametrize("name", ["gbt_nodes", "gbt_scores", "feature_importance", "score_summary", "model_report"])
def test_full_settings(spark, sf_dir, monkeypatch, name):
    def train(train, validation=None, settings=None, **changes):
        used = boosting.replace(settings or boosting.Settings(), **changes)
        raise Seen(used.rounds, used.least_rows, used.patience, used.leaves, validation is not None)

    monkeypatch.setattr(boosting, "train_boosted", train)
    monkeypatch.setattr(modelling, "train_boosted", train)
    with pytest.raises(Seen) as seen:
        registry.queries()[name](spark, sf_dir)
    assert seen.value.args == (300, 100, 30, 63, True)
