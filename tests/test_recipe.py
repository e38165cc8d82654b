"""The recipe compiler: a chain of steps means one assignment after another."""

import math
import random

from pyspark.sql import functions as F

from tabula.functions import scalars as X
from tabula.plans import loan
from tabula.plans.recipe import Recipe, Step, apply, levels, sentinel


def test_levels_are_few_and_keep_dependencies():
    add = lambda *c: sum(c[1:], c[0])
    steps = [Step("x", ["a"], add), Step("y", ["a"], add), Step("z", ["x", "y"], add), Step("a", ["b"], add), Step("w", ["a"], add)]
    assert [[s.name for s in g] for g in levels(steps)] == [["x", "y", "a"], ["z", "w"]]
    assert levels([]) == []
    assert len(levels(loan.R2.steps)) == 1 and len(levels(loan.R7.steps)) == 1
    assert sum(map(len, levels(loan.R8.steps))) == len(loan.R8.steps)


def test_random_chains_against_one_assignment_after_another(spark):
    rng = random.Random(4)
    for _ in range(8):
        names = ["a", "b", "c"]
        steps, row = [], {"a": 1.0, "b": 2.0, "c": 3.0}
        want = dict(row)
        for _ in range(10):
            name = rng.choice(names + ["d", "e", "f"])
            reads = [rng.choice(names) for _ in range(rng.randint(1, 2))]
            k = rng.randint(1, 5)
            steps.append(Step(name, reads, lambda *c, k=k: sum(c[1:], c[0]) * k - 1))
            want[name] = sum(want[r] for r in reads) * k - 1
            names = sorted(set(names) | {name})
        got = apply(spark.createDataFrame([row], "a double, b double, c double"), Recipe(steps=steps)).first().asDict()
        assert got == want


def test_filters_sentinels_and_drops(spark):
    rows = [(1, "a", 365243, 2.0), (2, "XNA", 5, 2.0), (3, None, 5, 2.0), (4, "b", None, 0.0), (5, "Unknown", 1, 1.0)]
    df = spark.createDataFrame(rows, "id int, kind string, days int, amount double")
    recipe = Recipe(exclude={"kind": ["XNA", "Unknown"]}, drop=["kind"]) + Recipe(
        steps=[sentinel("days", lambda c: c == 365243), Step("ratio", ["days", "amount"], X.ieee_divide), sentinel("amount", lambda c: c > 0, by="days")])
    got = [tuple(r) for r in apply(df, recipe).orderBy("id").collect()]
    assert got == [(1, None, 2.0, None), (4, None, 0.0, None)]


def test_a_sentinel_sees_what_the_one_before_it_nulled(spark):
    df = spark.createDataFrame([(-1.0, 5.0), (1.0, 6.0)], "atm double, all double")
    recipe = Recipe(steps=[sentinel("atm", lambda c: c < 0), sentinel("all", lambda c: c < 0, by="atm")])
    assert [tuple(r) for r in apply(df, recipe).collect()] == [(None, 5.0), (1.0, 6.0)]


def test_the_recipes_filters_and_sentinels_occur(spark):
    from tabula.plans.queries_recipe import application
    from tabula.sources.tables import load_tables
    t = load_tables(spark, "/root/testdata/sf0.01")
    raw, out = loan.applicants(t), application(t)
    assert out.count() < raw.count()
    for c, values in loan.TRAIN_FILTERS.items():
        assert raw.where(F.col(c).isin(values)).count() and not out.where((F.col("is_train") == 1) & F.col(c).isin(values)).count()
    assert raw.where("DAYS_LAST_PHONE_CHANGE = 0").count() and raw.where(f"DAYS_EMPLOYED = {loan.NO_DAY}").count()
    features = loan.bureau_features(t).agg(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in loan.BUREAU_DAYS],
                                           F.max("NEW_AMT_CREDIT_SUM_DEBT_DIVIDE_AMT_ANNUITY").alias("ratio")).first()
    assert all(features[c] for c in loan.BUREAU_DAYS) and (math.isinf(features.ratio) or math.isnan(features.ratio))
