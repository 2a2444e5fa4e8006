"""Plans with broadcasts off, as they are when nothing is small."""

import pytest

from stmtscope.operators import numbered_executions


@pytest.fixture()
def nothing_is_small(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")


def test_numbering_shuffles_the_rows_once(spark, tmp_path, nothing_is_small, capsys):
    rows = [(k % 3, k, k % 7 if k % 5 else None) for k in range(100)]
    folder = str(tmp_path / "facts")
    spark.createDataFrame(rows, "norm_id long, event_sequence long, duration long").write.parquet(folder)
    numbered = numbered_executions(spark.read.parquet(folder), "duration")
    assert numbered.count() == 100
    numbered.explain()
    plan = capsys.readouterr().out
    # The stored rows meet the counts of their ranges by a broadcast: no exchange of rows, no window.
    assert "BroadcastHashJoin" in plan and "Window" not in plan
    assert not any(" Exchange" in line for line in plan.splitlines())
