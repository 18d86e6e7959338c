"""Plan-shape checks: the physical plans are the ones we want at scale."""

import re

import pytest

from paths import SF_SMALL
from fundlens.plans import registry as E

EAGER = {"train_score", "grid_search", "model_reload"}  # fit models while building


def plan(df, mode="formatted"):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.mark.parametrize("name", sorted(set(E.queries()) - EAGER))
def test_no_cartesian_or_nested_loop_join(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_campaign_view_plan(spark):
    p = plan(E.queries()["campaign_prepare"](spark, SF_SMALL))
    # every part takes part: no key range on its scan
    assert "(p_partkey," not in p.replace("IsNotNull(p_partkey)", "")
    # column pruning: only the needed lineitem columns are read
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_shipdate:timestamp_ntz>" in p


def test_one_campaign_reads_one_key(spark):
    p = plan(E.queries()["one_campaign"](spark, SF_SMALL))
    assert "EqualTo(o_orderkey,1)" in p and "EqualTo(l_orderkey,1)" in p


def test_one_hot_does_not_shuffle_on_a_category(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(E.queries()["one_hot"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert not re.search(r"hashpartitioning\((country2|currency2)", p)


def test_word_count_is_partial_aggregate(spark):
    p = plan(E.queries()["word_count"](spark, SF_SMALL))
    assert "partial_count" in p
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def test_top_words_is_take_ordered(spark):
    p = plan(E.queries()["top_words"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_tokenisation_is_evaluated_once(spark):
    p = plan(E.queries()["term_counts"](spark, SF_SMALL))
    assert p.count("split(lower(text") == 1
    assert "INSET" in p  # stop words as a hash-set probe


def test_no_python_udf_outside_udf_query(spark):
    for name in sorted(set(E.queries()) - EAGER - {"udf_clean", "udf_types"}):
        p = plan(E.queries()[name](spark, SF_SMALL))
        assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p, name


def executed(node, seen):
    """Nodes that ran, by name: inside adaptive plans, once per exchange."""
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        return executed(node.executedPlan(), seen)
    if name.startswith("ReusedExchange"):
        return seen
    seen[name.strip()] = seen.get(name.strip(), 0) + 1
    if "QueryStage" in name:
        return executed(node.plan(), seen)
    children = node.children()
    for i in range(children.size()):
        executed(children.apply(i), seen)
    return seen


def test_tfidf_tokenises_once(spark):
    df = E.queries()["tfidf"](spark, SF_SMALL)
    df.collect()  # the final adaptive plan shows the runtime exchange reuse
    seen = executed(df._jdf.queryExecution().executedPlan(), {})
    assert sum(n for k, n in seen.items() if k.startswith("Generate")) == 1


@pytest.mark.parametrize("name", ["null_audit", "negative_prep_counts"])
def test_before_after_profiles_scan_once(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    scans = re.findall(r"Location: .*/(\w+)\.parquet", p)
    assert scans.count("lineitem") == 1 and scans.count("part") == 1


@pytest.mark.parametrize("name", ["campaign_prepare", "category_index"])
def test_campaigns_scan_orders_once(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    scans = re.findall(r"Location: .*/(\w+)\.parquet", p)
    assert all(scans.count(t) == 1 for t in ("orders", "customer", "lineitem", "part"))
