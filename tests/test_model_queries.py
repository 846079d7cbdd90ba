"""Model queries run the whole job of their model."""

from rarescan.plans import models, queries, training


def test_random_search_draws_from_the_whole_space(spark, monkeypatch):
    asked = []

    def search(df, spec, *rest, **more):
        asked.append(spec)
        return spec.candidates(queries.SETTINGS.seed)[0], 0.9, 0.0

    monkeypatch.setattr(training, "search", search)
    monkeypatch.setattr(queries, "applications", lambda *_: None)
    (row,) = queries.QUERIES["gbt_random_search"](spark, "nowhere").collect()
    assert tuple(row) == (60, True, True)
    (spec,) = asked
    assert spec == models.MODELS["xgb"]
    drawn = spec.candidates(queries.SETTINGS.seed)
    assert max(c["n_estimators"] for c in drawn) == 500 and max(c["max_depth"] for c in drawn) == 8
