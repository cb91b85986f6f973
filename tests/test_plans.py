"""Physical-plan properties the scale design relies on."""

import contextlib
import io
import re

import pytest

from keelson.plans import catalog
from tests.conftest import SMALL

BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")
# Queries that fit models run jobs while being planned; their scoring plans are
# covered through score_batch / evaluate_model style queries below.
FITTING = {"train_logreg", "train_random_forest", "cross_validate", "cv_trials", "select_best_model",
           "train_single", "forest_importance"}


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - FITTING))
def test_no_cross_products_or_python_evaluation(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, SMALL))
    assert not [b for b in BANNED if b in plan], plan


def test_drift_pairs_push_predicates_and_share_scans(spark):
    base, _ = catalog.drift_long(spark, SMALL)
    plan = plan_of(base)
    scans = [ln for ln in plan.splitlines() if re.match(r"^\(\d+\) Scan parquet", ln)]
    assert len(scans) == 3  # orders, lineitem (three pairs), events
    assert "Or(Or(LessThan(l_quantity,30.0),EqualTo(l_returnflag,A)),EqualTo(l_quantity,7.0))" in plan
    assert "EqualTo(event_type,click)" in plan


@pytest.mark.parametrize("name", ["psi", "drift_report", "bin_shares", "feature_drift"])
def test_drift_plans_have_no_joins(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, SMALL))
    assert not [j for j in ("SortMergeJoin", "ShuffledHashJoin", "BroadcastHashJoin") if j in plan]


def test_test_split_filtered_before_the_fitted_transform(spark):
    plan = plan_of(catalog.test_scored(spark, SMALL))
    tree = plan.split("\n\n")[0]
    lines = [ln.strip(" +-*:") for ln in tree.splitlines()]
    ops = [ln.split(" (")[0].strip() for ln in lines if "(" in ln]
    # ... -> Filter -> ColumnarToRow -> Scan: the split predicate is applied to raw rows.
    assert ops[-3:] == ["Filter", "ColumnarToRow", "Scan parquet"], ops


def test_scan_prunes_columns(spark):
    plan = plan_of(catalog.QUERIES["count_rows"](spark, SMALL))
    assert "ReadSchema: struct<>" in plan or "ReadSchema: struct<o_" in plan
    plan = plan_of(catalog.QUERIES["contract_check"](spark, SMALL))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in plan


# randomSplit samples each split separately; bin_shares reports both sides of each pair; string_index_table reads
# rows of frequent and of rare values separately, so that only the rare ones are shuffled.
SCANS_TWICE = {"split_random", "bin_shares", "string_index_table"}


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - FITTING))
def test_each_input_table_scanned_once(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, SMALL))
    inputs = [loc for loc in re.findall(r"Location: \w+ \[([^\]]+)\]", plan) if "/testdata/" in loc]
    most = max((inputs.count(loc) for loc in set(inputs)), default=0)
    assert most <= (2 if name in SCANS_TWICE else 1), inputs
