"""Models that look up their features: the recipe is saved, reloaded and rejoined."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tabforge.jobs import Namespace, score_latest_lookup, train_register_lookup
from tabforge.operators import lookup_model as L
from tabforge.session import scratch_path
from tabforge.sources import catalog
from tabforge.spec import FeatureSpec

SPEC = FeatureSpec(num=("quality", "own", "house_age"), cat=("style",), target="price", id_col="Id")
SCHEMA = "Id string, own double, note string, price double"


@pytest.fixture(scope="module")
def job(spark):
    ns = Namespace(schema="tf_lookup_model_test")
    spark.sql(f"DROP DATABASE IF EXISTS {ns.schema} CASCADE")
    spark.sql(f"CREATE DATABASE {ns.schema}")
    feats = spark.range(200).selectExpr("CAST(id AS STRING) AS Id", "CAST(id % 9 AS INT) AS quality",
                                        "concat('s', CAST(id % 4 AS STRING)) AS style", "CAST(1950 + id % 60 AS INT) AS built")
    catalog.create_feature_table(spark, ns.name("feats"), [("Id", "STRING"), ("quality", "INT"), ("style", "STRING"),
                                                           ("built", "INT")], "Id", [feats])
    rows = [(str(i), float(i % 7), "x", 100.0 * (i % 9) + (i % 60)) for i in range(240)]  # 40 of them without features
    train = spark.createDataFrame(rows, SCHEMA)
    run, version, met = train_register_lookup(
        spark, train, train.where("Id % 5 = 0"), SPEC,
        [L.TableLookup(table=ns.name("feats"), key="Id", features=["quality", "style", "built"])],
        [L.age_feature("built", as_of_year=2025)], {"n_estimators": 2, "max_depth": 3}, scratch_path(spark, "models"),
        "houses", ns, exclude=["note"])
    yield ns, train, version, {r.key: r.value for r in met.collect()}
    spark.sql(f"DROP DATABASE {ns.schema} CASCADE")


def test_recipe_is_saved_with_the_model(spark, job):
    ns, train, version, met = job
    assert version == 1 and set(met) == {"mse", "mae", "r2"} and met["r2"] > 0.7
    path = spark.table(ns.name(ns.versions)).first().path
    m = PipelineModel.load(path)
    assert L.recipe_text(m) == [f"lookup quality, style, built in {ns.name('feats')} by Id",
                                "house_age = house_age_of(built) as CAST(2025 - year_built AS INT)"]
    stored = {r.key: r.value for r in spark.table(ns.name(ns.params)).collect()}
    assert stored["recipe.0"] == L.recipe_text(m)[0]
    assert L.request_columns(train, SPEC, m) == ["Id", "own"]


def test_scores_in_another_session_from_keys(spark, job):
    ns, train, _, _ = job
    other = spark.newSession()  # no temporary function is defined there
    request = other.createDataFrame([("3", 3.0, 9), ("203", 3.0, 9), (None, 3.0, 9), ("3", None, 9)],
                                    "Id string, own double, quality int")  # a stale feature value is left out
    got = {(r.Id, i): r.prediction for i, r in enumerate(score_latest_lookup(other, "houses", request, "Id", ns).collect())}
    assert len(got) == 4 and all(v is not None for v in got.values())
    by = {k: v for k, v in got.items()}
    found = [v for (k, _), v in by.items() if k == "3"]
    missing = {v for (k, _), v in by.items() if k in ("203", None)}
    assert len(missing) == 1 and found[0] not in missing  # NULL and unmatched keys score alike
    cents = score_latest_lookup(other, "houses", request, "Id", ns, adjust_cents=True).collect()
    assert all(round(r.prediction, 2) == r.prediction for r in cents)


def test_training_and_scoring_assemble_alike(spark, job):
    ns, train, _, met = job
    scored = score_latest_lookup(spark, "houses", train.drop("price"), "Id", ns)
    part = scored.join(train.where("Id % 5 = 0"), "Id")
    mse = part.agg(F.avg((F.col("price") - F.col("prediction")) ** 2)).first()[0]
    assert mse == pytest.approx(met["mse"], rel=1e-12)


def test_features_are_those_of_the_table_now(spark, job):
    ns, train, _, _ = job
    request = train.where("Id = 8").select("Id", "own")
    before = score_latest_lookup(spark, "houses", request, "Id", ns).first().prediction
    newer = spark.table(ns.name("feats")).withColumn("quality", F.when(F.col("Id") == "8", 0).otherwise(F.col("quality")))
    catalog.save_table(newer, ns.name("feats"))
    after = score_latest_lookup(spark, "houses", request, "Id", ns).first().prediction
    assert after < before - 300


def test_refusals(spark, job):
    ns, train, _, _ = job
    with pytest.raises(ValueError, match="own"):
        score_latest_lookup(spark, "houses", train.select("Id"), "Id", ns)
    with pytest.raises(ValueError, match="no registered"):
        score_latest_lookup(spark, "flats", train, "Id", ns)
    look = L.TableLookup(table=ns.name("feats"), key="Id", features=["quality"])
    with pytest.raises(ValueError, match="already present"):
        look.transform(train.withColumn("quality", F.lit(1)))
    with pytest.raises(ValueError, match="already present"):
        L.age_feature("own", output="note", as_of_year=2025).transform(train)
    with pytest.raises(ValueError, match="invalid identifier"):
        L.TableLookup(table="feats; DROP TABLE x", key="Id", features=["quality"]).transform(train)
    with pytest.raises(ValueError, match="excluded"):
        L.fit_lookup_model(train.withColumn("style", F.lit("s")).withColumn("house_age", F.lit(1)), SPEC, [look],
                           exclude=["price"])


def test_outputs_can_be_renamed(spark, job):
    ns, train, _, _ = job
    look = L.TableLookup(table=ns.name("feats"), key="Id", features=["quality", "style"], outputs=["q", "s"])
    path = scratch_path(spark, "stage")
    look.save(path)
    out = L.TableLookup.load(path).transform(train.select("Id"))
    assert out.columns == ["Id", "q", "s"] and out.where("q IS NULL").count() == 40
