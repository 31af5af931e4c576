"""Operators marked native run without Python in any of their jobs."""

from __future__ import annotations

import pytest

from tests.conftest import SF_SMALL
from tidepool.llm import catalog, common


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op3_mix", "op4_licenses"])
def test_no_python_in_any_plan(spark, name, monkeypatch):
    plans = []
    pin = common.pin

    def noted(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return pin(df, label)

    for module in (catalog.exact_dedup, catalog.mix, catalog.licenses):
        monkeypatch.setattr(module, "pin", noted)
    plans.append(catalog.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 1
    for plan in plans:
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
