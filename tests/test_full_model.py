"""The model queries fit the default model."""

import pytest

from transcript_quality import queries as Q
from transcript_quality.config import TrainingConfig
from transcript_quality.operators import model as ML


@pytest.mark.parametrize("name", ["gbt_metrics", "importance"])
def test_default_model(spark, monkeypatch, name):
    class Fitted(Exception):
        pass

    def fit(rows, cfg, *more, **named):
        raise Fitted(cfg)
    monkeypatch.setattr(ML, "fit", fit)
    with pytest.raises(Fitted) as e:
        getattr(Q, name)(spark, "/root/testdata/sf0.001")
    cfg = e.value.args[0]
    assert cfg == TrainingConfig() and (cfg.gbt.n_estimators, cfg.gbt.max_depth) == (100, 6)
