"""Physical-plan properties of the registered batch queries."""

import json

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tidepool.plans import registry

registry.load_all()

# Keys whose result is read back from a streaming sink or built from stream runs (their jobs ran already).
STREAM_KEYS = {k for k in registry.QUERIES if k.startswith("stream_")} | {"trend_leaderboard", "consumer_lag"}

# Single-partition windows are allowed only over tables bounded by construction.
BOUNDED_WINDOWS = {
    "panel_daily_trend": "one row per calendar day",
    "panel_label_share": "one row per sentiment label (3)",
    "topic_stats": "one row per topic partition",
    "vw_influencer_impact": "the n LIMIT survivors; per-partition offsets of the running count",
    "global_rank": "per-partition offset table",
    "global_ntile": "per-partition offset table",
    "dim_topics": "per-partition offset table",
    "partition_offsets": "per-partition offset table; one row per topic partition",
    "replay_range": "per-partition offset table; one row per topic partition",
    "alerts_batch": "per-partition offset table",
    "alerts_batch_global": "per-partition offset table",
    "hashtag_velocity": "per-partition offset table",
    "panel_top_hashtags": "per-partition offset table",
}


def _nodes(df):
    p = df._jdf.queryExecution().executedPlan()
    if p.nodeName() == "AdaptiveSparkPlan":
        p = p.initialPlan()
    return json.loads(p.toJSON())


def _unpartitioned_window(node):
    spec = node.get("partitionSpec") or []
    flat = [e for group in spec for e in (group if isinstance(group, list) else [group])]
    return all(e.get("class", "").endswith("Literal") for e in flat)


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for k, fn in registry.QUERIES.items():
        if k in STREAM_KEYS:
            continue
        out[k] = _nodes(fn(spark, SF_SMALL))
    return out


def test_no_python_in_batch_plans(plans):
    bad = {k for k, nodes in plans.items()
           if any(("Python" in n["class"] or "Pandas" in n["class"] or "ArrowEval" in n["class"]) for n in nodes)}
    assert not bad


def test_single_partition_windows_only_over_bounded_tables(plans):
    found = {k for k, nodes in plans.items()
             if any(n["class"].endswith("WindowExec") and _unpartitioned_window(n) for n in nodes)}
    assert found == set(BOUNDED_WINDOWS), (sorted(found - set(BOUNDED_WINDOWS)), sorted(set(BOUNDED_WINDOWS) - found))


def test_projection_reaches_the_scan(spark):
    df = E.queries()["scan_projection"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string,n_chars:bigint>" in plan, plan
