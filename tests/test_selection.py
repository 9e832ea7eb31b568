import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.tuning import ParamGridBuilder

from quarry.operators import models, selection


def test_foreign_grid_raises():
    rfc = RandomForestClassifier()
    gbt = GBTClassifier()
    grid = ParamGridBuilder().addGrid(rfc.maxDepth, [3, 5]).build()
    with pytest.raises(ValueError):
        selection.validate_grid(Pipeline(stages=[gbt]), grid)
    selection.validate_grid(Pipeline(stages=[gbt]), selection.build_grid(gbt, {"maxDepth": [3]}))


def test_unknown_model_raises():
    with pytest.raises(ValueError):
        models.make_estimator("nope")
    assert models.make_estimator("linear_l1", 0.1).getElasticNetParam() == 1.0


def test_compare_table(spark):
    m = spark.createDataFrame([("A", "rmse", 0.4, 1.0), ("A", "rmse", 0.8, 2.0)],
                              "setting string, metric string, train_frac double, value double")
    t = selection.compare_table(m, ["setting", "metric"], "train_frac", values=[0.4, 0.8]).first()
    assert t["0.4"] == 1.0 and t["0.8"] == 2.0
