import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cataloom.operators import learn

# Dried plant weights of a control and a treated group (Dobson,
# An Introduction to Generalized Linear Models, 1990, table 7.1).
CTL = [4.17, 5.58, 5.18, 6.11, 4.50, 4.61, 5.17, 4.53, 5.33, 5.14]
TRT = [4.81, 4.17, 4.41, 3.59, 5.87, 3.83, 6.03, 4.89, 4.32, 4.69]


@pytest.fixture(scope="module")
def plants(spark):
    return spark.createDataFrame([("Ctl", w) for w in CTL] + [("Trt", w) for w in TRT], "grp string, weight double")


def test_group_model_with_intercept(plants):
    fit = learn.fit_group_model(plants, "weight", "grp")
    assert fit.intercept == pytest.approx(5.032)
    assert fit.coefficients[0] == pytest.approx(-0.371)
    assert fit.r2 == pytest.approx(0.07308, abs=1e-4)


def test_group_model_without_intercept(plants):
    fit = learn.fit_group_model(plants, "weight", "grp", intercept=False)
    levels = learn.feature_levels(fit.model, plants, "grp")
    got = dict(zip(levels, fit.coefficients))
    assert got["Ctl"] == pytest.approx(5.032) and got["Trt"] == pytest.approx(4.661)


def test_model_save_load(plants, spark, scratch_dir):
    fit = learn.fit_group_model(plants, "weight", "grp")
    path = learn.save_model(fit, f"{scratch_dir}/model_d9")
    intercept, coefs = learn.model_coefficients(learn.load_model(path))
    assert intercept == pytest.approx(5.032) and coefs[0] == pytest.approx(-0.371)


def test_anova(plants):
    rows = {r.term: r for r in learn.one_way_anova(plants, "weight", "grp").collect()}
    assert rows["grp"].df == 1 and rows["Residuals"].df == 18
    assert rows["grp"].sum_sq == pytest.approx(0.6882, abs=1e-4)
    assert rows["Residuals"].sum_sq == pytest.approx(8.7292, abs=1e-4)
    assert rows["grp"].f_value == pytest.approx(1.419, abs=1e-3)
    assert rows["grp"].p_value == pytest.approx(0.249, abs=1e-3)


def test_f_survival_known_values():
    assert learn.f_survival(1.0, 1, 1) == pytest.approx(0.5, abs=1e-9)
    assert learn.f_survival(4.0, 2, 10) == pytest.approx(0.0530, abs=1e-4)


def test_kmeans_invariants(spark):
    rows = [(i, float(i % 7), float((i * 13) % 11)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    model, assigned = learn.kmeans(df, ["a", "b"], k=3, max_iter=20, id_cols=["id"])
    assert assigned.count() == 300
    centers = learn.cluster_centers(model, assigned).collect()
    assert sum(r["size"] for r in centers) == 300 and len(centers) == 3
    mean_a = sum(r[1] for r in rows) / 300
    mean_b = sum(r[2] for r in rows) / 300
    one_cluster_cost = sum((r[1] - mean_a) ** 2 + (r[2] - mean_b) ** 2 for r in rows)
    assert model.summary.trainingCost <= one_cluster_cost


def test_kmeans_array_column(spark):
    df = spark.createDataFrame([(i, [float(i % 2), float(i % 3)]) for i in range(50)], "id int, v array<float>")
    _, assigned = learn.kmeans(df, "v", k=2, max_iter=5, id_cols=["id"])
    assert assigned.count() == 50 and assigned.agg(F.countDistinct("cluster")).first()[0] == 2


def test_coefficient_table(plants):
    fit = learn.fit_group_model(plants, "weight", "grp")
    levels = learn.feature_levels(fit.model, plants, "grp")
    rows = {r[0]: r for r in learn.coefficient_table(fit, levels)}
    # R: (Intercept) 5.0320 se 0.2202 t 22.850; grpTrt -0.3710 se 0.3114 t -1.191 p 0.249
    assert rows["(Intercept)"][1] == pytest.approx(5.032) and rows["(Intercept)"][2] == pytest.approx(0.2202, abs=1e-4)
    assert rows["Trt"][1] == pytest.approx(-0.371) and rows["Trt"][2] == pytest.approx(0.3114, abs=1e-4)
    assert rows["Trt"][3] == pytest.approx(-1.191, abs=1e-3) and rows["Trt"][4] == pytest.approx(0.249, abs=1e-3)


def test_f_survival_keeps_digits_at_large_n():
    # limits for d2 -> infinity: chi-square tails
    import math

    assert learn.f_survival(1.0, 1, 1e12) == pytest.approx(math.erfc(math.sqrt(0.5)), rel=1e-8)
    assert learn.f_survival(1.0, 2, 1e12) == pytest.approx(math.exp(-1.0), rel=1e-8)
    three = math.erfc(math.sqrt(1.5)) + math.sqrt(6 / math.pi) * math.exp(-1.5)
    assert learn.f_survival(1.0, 3, 1e12) == pytest.approx(three, rel=1e-8)
    assert learn.f_survival(3.0, 2, 5000) == pytest.approx((1 + 6 / 5000) ** -2500, rel=1e-8)


@pytest.mark.parametrize("narrow", [0, 64])
def test_rounds_of_narrow_and_wide_points(spark, monkeypatch, narrow):
    """Rounds against the same rounds in numpy; narrow points are not sent as pickled objects."""
    monkeypatch.setattr(learn, "NARROW", narrow)
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(m, 1.0, (60, 3)) for m in (0.0, 6.0, 15.0)])
    data = spark.createDataFrame([(p.tolist(),) for p in points], "point array<double>").repartition(3)
    if narrow:
        monkeypatch.setattr(type(data), "rdd", property(lambda self: pytest.fail("rows go through Python objects")))
    at = points[[0, 1, 2]].copy()
    for turns in (1, 2, 30):
        want = at.copy()
        for _ in range(turns):
            place = ((points[:, None] - want[None]) ** 2).sum(axis=2).argmin(axis=1)
            want = np.array([points[place == i].mean(axis=0) if (place == i).any() else want[i] for i in range(3)])
        model = learn.fit_from(data, at.tolist(), turns)
        assert np.allclose(model.clusterCenters(), want, atol=1e-9)
        assert math.isclose(model.trainingCost, ((points[:, None] - want[None]) ** 2).sum(axis=2).min(axis=1).sum(), rel_tol=1e-9)
    far = learn.fit_from(data, [[0.0, 0.0, 0.0], [1e6, 1e6, 1e6]], 3).clusterCenters()
    assert np.allclose(far[0], points.mean(axis=0)) and far[1] == [1e6, 1e6, 1e6]  # no points: it stays
