"""What the plans look like: columns read, shuffles, joins."""

import re

import pytest
from conftest import TESTDATA

from meterloom.plans import stored  # noqa: F401 - adds its queries
from meterloom.plans.catalogue import QUERIES

SF = f"{TESTDATA}/sf0.001"


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


@pytest.mark.parametrize("name", ["q_gold_hourly", "q_feature_store", "q_profile_numeric", "q_coverage"])
def test_unused_columns_stay_unread(spark, name):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(spark, name))
    assert schemas and all("user_id" not in s for s in schemas)


@pytest.mark.parametrize("name, most", [("q_gold_hourly", 2), ("q_feature_store", 3), ("q_b2_b3_frames", 3), ("q_metrics", 4), ("q_state_dist", 2), ("q_gap_distribution", 2), ("q_multi_horizon", 3)])
def test_shuffles(spark, name, most):
    """Duplicates, hours and series are one shuffle each, and so is a report's grouping."""
    text = plan(spark, name)
    assert shuffles(text) <= most and "Join" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in ("q_kmeans", "q_models")))
def test_no_python(spark, name):
    assert not re.search("Python|Arrow|Pandas", plan(spark, name))


@pytest.mark.parametrize("name", ["q_state_classify", "q_gold_hourly", "q_feature_store", "q_b2_b3_frames", "q_metrics"])
def test_json_is_parsed_once(spark, name):
    """However often columns that come of it are used."""
    text = plan(spark, name)
    assert len(re.findall(r"Generate json_tuple", text)) == 1 and "get_json_object" not in text


def test_filters_reach_the_scan(spark, tmp_path):
    from meterloom.operators import baselines
    from meterloom.sources import write_layer

    write_layer(QUERIES["q_feature_store"](spark, SF), str(tmp_path / "f"), ("split", "district"))
    rows = baselines.aligned(spark.read.parquet(str(tmp_path / "f")), ("VAL",), guard=False)
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*split[^\]]*VAL", text) and re.search(r"PushedFilters: \[[^\]]*is_valid_forecast_instance", text)
