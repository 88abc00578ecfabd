"""Plan checks: built-in expressions only in batch paths, pruned scans."""
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

BATCH = [n for n in E.queries() if not n.startswith(("stream", "op")) or n == "orders_change_history"]
BATCH = [n for n in BATCH if n not in ("checkpoint_offsets", "sink_manifest", "pipeline", "silver_faithful", "silver_malformed")]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_in_batch_plans(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "FlatMapGroupsInPandas" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = E.queries()["cadence_thin"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan
