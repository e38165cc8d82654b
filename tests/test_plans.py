"""Plan-quality checks: filters reach the parquet scan, projections prune columns."""

import contextlib
import io

from tests.conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_not_equal_filters_are_pushed_to_the_scan(spark):
    import __spark_entry__ as e
    plan = _plan(e.queries()["filter_not_equal"](spark, SF_SMALL))
    assert "Not(EqualTo(c_mktsegment,HOUSEHOLD))" in plan
    assert "Not(EqualTo(n_name,NATION_3))" in plan


def test_scans_read_only_needed_columns(spark):
    import __spark_entry__ as e
    plan = _plan(e.queries()["sentinel_null_out"](spark, SF_SMALL))
    schema = [l for l in plan.splitlines() if l.startswith("ReadSchema")]
    assert schema and all("l_shipdate" not in l and "l_returnflag" not in l for l in schema)


def test_bin_statistics_are_broadcast(spark):
    import __spark_entry__ as e
    plan = _plan(e.queries()["category_means_joinback"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan


def test_score_tables_share_one_derivation(spark):
    """Each of the seven score tables aggregated the orders anew, all in the tasks of one blend."""
    from tabula.plans.queries_model import score_tables
    from tabula.sources.tables import load_tables

    for scores in score_tables(load_tables(spark, "/root/testdata/sf0.001")).values():
        plan = scores._jdf.queryExecution().optimizedPlan().toString().split("InMemoryRelation")
        assert len(plan) == 2 and "Aggregate" not in plan[0]


def test_filtered_rollups_are_written_before_the_filter(spark, monkeypatch):
    """The near-zero-variance filter and the merge each computed the bureau and previous roll-ups anew."""
    from tabula.plans import pipeline as P
    from tabula.sources.tables import load_tables

    written, filtered = {}, []
    monkeypatch.setattr(P, "materialize", lambda df, name: written.setdefault(name, df.limit(1)))
    monkeypatch.setattr(P.selection, "drop_nzv", lambda df, cols: filtered.append(df) or df)
    t = load_tables(spark, "/root/testdata/sf0.001")
    P._bureau(t, P.PipelineConfig()), P._previous(t, P.PipelineConfig())
    assert list(written) == ["bureau-rollup", "previous-rollup"]
    assert all(a is b for a, b in zip(written.values(), filtered, strict=True))


def test_a_basis_column_is_one_literal(spark):
    """Scores of p columns put p literals for each component into the plan."""
    import numpy as np
    from pyspark.sql import functions as F
    from tabula.operators.reduce import _project

    x, basis = np.arange(50.0), np.linspace(-1, 1, 150).reshape(50, 3)
    out = _project(spark.createDataFrame([(x.tolist(),)], "x array<double>"), F.col("x"), basis, "PC", [])
    assert "array(" not in out._jdf.queryExecution().analyzed().toString()
    assert np.allclose(list(out.first()), x @ basis)
