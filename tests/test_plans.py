"""Plan shapes that the scale design relies on (physical plans, before AQE)."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF001
from sparkcount.plans import catalog

# the library's own operators; the optional subpackage has its own tests
QUERIES = {k: f for k, f in E.queries().items() if k in catalog.queries()}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_and_no_pair_explosion(spark, name):
    p = plan(QUERIES[name](spark, SF001))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in p, (name, bad)


def test_edge_scan_reads_two_columns(spark):
    p = plan(QUERIES["triangle_count"](spark, SF001))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in p


TRIANGLES = ["triangle_count", "triangles_per_color", "approx_triangles_color_median", "triangles_per_partition",
             "exact_triangles_color"]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", TRIANGLES)
def test_no_exchange_has_a_row_per_wedge(spark, no_broadcast, name):
    """Between the exploded arrays and the aggregate over (t, w) nothing is shuffled:
    the rows stay where one exchange by t put them, one row per edge."""
    p = plan(QUERIES[name](spark, SF001)).split("Generate explode(ws")
    assert len(p) == 2
    above, below = p
    last = above.rindex("HashAggregate(keys=[")
    assert "Exchange" not in above[last:] and "salt" in above[last:]
    assert "REPARTITION_BY_NUM" in below.split("Exchange")[1]
    assert "Join" not in below.split("Generate explode(sequence")[0]


def test_replicated_plan_has_one_exchange_after_the_copy(spark, no_broadcast):
    p = plan(QUERIES["exact_triangles_color_replicated"](spark, SF001))
    above, below = p.split("Generate explode(ws")
    first = below.split("Exchange")[1]
    assert "REPARTITION_BY_NUM" in first and "hashpartitioning(g" in first
    # copies are made right below that exchange, and the group's counts right above
    assert "Generate explode(" in first.split("Join")[0]
    # of the exchanges above only the counts' way to the list of groups
    assert above.count("Exchange hashpartitioning") <= 4
    assert "g#" not in "".join(x.split(")")[0] for x in above.split("Exchange hashpartitioning(")[1:])


def test_stop_rule_filters_items_without_a_join(spark):
    p = plan(QUERIES["stream_cutoff"](spark, SF001))
    top = p.split("Subquery")[0]
    assert "Join" not in top and "Subquery subquery" in p


def test_estimates_are_made_in_the_row(spark):
    # the sketch arrives as one array: the items are neither joined nor shuffled
    # after their frequency table
    top = plan(QUERIES["sketch_estimates"](spark, SF001)).split("Subquery")[0]
    assert "Join" not in top and top.count("Exchange hashpartitioning") <= 1
    assert "Join" not in plan(QUERIES["top_k_error"](spark, SF001))


def test_word_count_aggregates_before_the_shuffle(spark):
    p = plan(QUERIES["word_count_salted_map"](spark, SF001))
    assert p.count("partial_count") >= 1 and p.count("partial_sum") >= 1


def test_salted_counts_shuffle_twice_and_partitioned_once(spark):
    assert plan(QUERIES["word_count_salted_map"](spark, SF001)).count("Exchange hashpartitioning") == 2
    assert plan(QUERIES["word_count_salted_group"](spark, SF001)).count("Exchange hashpartitioning") == 2
    p = plan(QUERIES["word_count_partitioned"](spark, SF001))
    # summed in the scan stage, then one exchange: not the plan of the one-round count
    assert p.count("Exchange hashpartitioning") == 1 and "MapInArrow" in p and "partial_sum" in p
    assert "MapInArrow" not in plan(QUERIES["word_count"](spark, SF001))


def test_distinct_word_count_runs_its_methods(spark):
    df = QUERIES["distinct_word_count"](spark, SF001)
    p = df._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("xxhash64") >= 2 and p.count("sum(n") >= 4


def test_triangles_orient_once(spark):
    df = QUERIES["triangle_count"](spark, SF001)
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    # the two degree joins and no other: triangles close in an aggregate
    assert sum(final.count(f"{k}Join") for k in ("SortMerge", "BroadcastHash", "ShuffledHash")) == 2


def test_sweep_limits_groups_below_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["sketch_accuracy_sweep"](spark, SF001))


def test_building_queries_leaves_no_temp_views(spark):
    before = {t.name for t in spark.catalog.listTables()}
    for name, f in QUERIES.items():
        if not name.endswith("_state") and not name.startswith("stream_"):  # those run a stream
            f(spark, SF001)
    assert {t.name for t in spark.catalog.listTables()} == before


COPIED = ["exact_triangles_color_replicated", "triangles_per_color_triple_replicated"]


def closing(p: str) -> str:
    """What happens between the exchange to ``t`` and the exploded arrays."""
    above, below = p.split("Generate explode(ws")
    return below.split("Exchange")[0]


@pytest.mark.parametrize("name", COPIED)
def test_copied_groups_close_without_a_row_per_wedge(spark, name):
    p = plan(QUERIES[name](spark, SF001))
    # what is exploded are ids that the node's own array holds too: triangles
    assert "array_intersect(ws" in closing(p) and "Window" in closing(p)
    first = p.split("Generate explode(ws")[1].split("Exchange")[1]
    # a group is dealt over tasks, and arrays are copied, not edges
    assert re.match(r" hashpartitioning\(g#\d+L?, n#\d+L?, salt#", first)
    assert "collect_list" not in first


@pytest.mark.parametrize("name", [*TRIANGLES, "triangles_per_color_triple", "triangle_report_exact"])
def test_triangles_close_without_a_row_per_wedge(spark, name):
    p = plan(QUERIES[name](spark, SF001))
    assert "array_intersect(ws" in closing(p) and "Window" in closing(p)
