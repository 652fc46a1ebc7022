from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from checks.fixtures import Inputs
from checks.queries import tables
from ebbtide.operators import accounts
from ebbtide.plans import fetch, modelling, monitoring, training_set
from ebbtide.schemas import CUSTOMER, TARGET
from ebbtide.session import drop_stored, materialise

FOLDER = "/root/testdata/sf0.001"
FEW = ["NO_TRANSATION", "PRE_CLS_BAL"]  # the queries use all columns


def test_from_raw_tables_to_monitoring(spark, tmp_path):
    raw = tables(Inputs(spark, FOLDER))
    may = training_set.Observation(2001, 5)
    features, encoder = training_set.feature_table(raw, may, trailing_columns=FEW)
    assert features.count() == features.select(CUSTOMER).distinct().count() > 0
    assert {"No_of_Acc_Held", "GENDER_MALE", "PRE_CLS_BAL_l6m_std", TARGET} <= set(features.columns)
    assert not {"GENDER", "PROVINCE", "AVG_INCOME", "NO_TRANSATION_n1m"} & set(features.columns)

    settings = modelling.Preparation(iterations=3, depth=2, trees=10, contamination=0.1)
    sets = modelling.prepare_sets(features, settings)
    assert sets.train.columns == sets.test.columns and not {"YEAR", "MONTH", "CIF_CREATE"} & set(sets.columns)
    assert sets.train.join(sets.test, CUSTOMER, "left_semi").count() == 0
    spread = sets.train.agg(*[F.avg(c) for c in sets.columns]).first()
    assert all(abs(value) < 1e-9 for value in spread)

    choices = {"linear": (LogisticRegression(labelCol=TARGET, regParam=0.1), [{}])}
    trained, model, train_scores, test_scores = modelling.train_and_score(sets, choices=choices, folds=2)
    assert train_scores.count() == sets.train.count() and test_scores.count() == sets.test.count()

    path = str(tmp_path / "run")
    modelling.save_run(spark, path, model, "linear", sets, encoder, trained.leaderboard, {"month": "5"})
    run = modelling.load_run(spark, path)
    assert run.columns == sets.columns and run.encoder == encoder and run.scaling == sets.scaling
    assert run.tags == {"month": "5", "model": "linear"}
    june = training_set.Observation(2001, 6, new_data=True, monitoring=True)
    new, same = training_set.feature_table(raw, june, run.encoder, FEW)
    assert same is run.encoder
    scored = monitoring.score_new_data(path, new, monitoring=True)
    assert scored.count() == new.count()
    table = monitoring.monitor(scored, path).collect()
    assert {"accuracy", "f1_score_macro", "norm_macro_recall"} <= {r.metrics for r in table}

    july = training_set.Observation(2001, 7, new_data=True)
    unlabelled, _ = training_set.feature_table(raw, july, run.encoder, FEW)
    assert TARGET not in unlabelled.columns
    blind = monitoring.score_new_data(path, unlabelled, monitoring=False)
    assert TARGET not in blind.columns and blind.count() == unlabelled.count()


def test_stored_model_gives_the_same_scores(spark, tmp_path):
    rows = [(str(i), float(i % 7), float(i % 3), i % 2) for i in range(60)]
    train = spark.createDataFrame(rows, f"{CUSTOMER} string, a double, b double, {TARGET} int")
    scaling = modelling.fit_scaling(train, ["a", "b"])
    sets = modelling.PreparedSets(scaling.transform(train), scaling.transform(train), ["a", "b"], scaling)
    choices = {"linear": (LogisticRegression(labelCol=TARGET, regParam=0.1), [{}])}
    trained, model, _, before = modelling.train_and_score(sets, choices=choices)
    encoder = training_set.OneHot((("x", "1"), ("x", "é;")))
    modelling.save_run(spark, str(tmp_path), model, "linear", sets, encoder, trained.leaderboard)
    assert modelling.load_run(spark, str(tmp_path)).encoder == encoder
    after = monitoring.score_new_data(str(tmp_path), train, monitoring=True)
    assert sorted(after.collect()) == sorted(before.collect())


def test_newest_month(spark, tmp_path):
    for name in ("2021_12", "2022_04", "2022_4", "old"):
        (tmp_path / name).mkdir()
    moved = fetch.newest(spark, fetch.RawFolders(str(tmp_path), "", ""), training_set.Observation(2000, 1, 3))
    assert moved == training_set.Observation(2022, 4, 3)


def test_categories_are_those_of_the_training_customers(spark):
    raw = tables(Inputs(spark, FOLDER))
    customers = training_set.transform_demographics(raw)
    train, _ = training_set.split_by_hash(customers, 0.97, 42)
    _, encoder = training_set.feature_table(raw, training_set.Observation(2001, 5), trailing_columns=FEW, test_size=0.97)
    seen = {r[0] for r in train.select("OCCUPATION_GROUP").distinct().collect()}
    assert {v for c, v in encoder.categories if c == "OCCUPATION_GROUP"} == seen


def test_accounts_are_scanned_once(spark):
    raw = Inputs(spark, FOLDER).raw_account
    read = []

    def keep(df, name):
        read.append(df._jdf.queryExecution().optimizedPlan().toString().count("Relation"))
        return spark.createDataFrame(df.collect(), df.schema)

    steps = accounts.account_steps(accounts.clean_account_events(raw), keep=keep)
    last = steps["active_filled"]._jdf.queryExecution().optimizedPlan().toString()
    assert read == [1] and "Relation" not in last


def test_window_condition_reaches_the_scan(spark):
    raw = Inputs(spark, FOLDER).raw_transaction
    df = training_set.transactions_in_window(raw, training_set.Observation(2001, 1)).select(CUSTOMER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(YEAR,2000)" in plan and "LessThanOrEqual(YEAR,2001)" in plan
    assert "AMT_CREDIT" not in plan


def test_stored_tables_can_be_dropped(spark, monkeypatch, tmp_path):
    """Only the application's own folder goes; what is stored later has a new one."""
    monkeypatch.setattr("ebbtide.session._own", {})
    monkeypatch.setattr("ebbtide.session.shared_folder", lambda spark: str(tmp_path))
    (tmp_path / "theirs").mkdir()
    assert materialise(spark.range(5), "t").count() == 5
    assert len(list(tmp_path.iterdir())) == 2
    drop_stored(spark)
    drop_stored(spark)
    assert [p.name for p in tmp_path.iterdir()] == ["theirs"]
    assert materialise(spark.range(3), "t").count() == 3
