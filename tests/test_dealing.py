"""Rows are dealt to tasks by the size of their input, with few sorts in each."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.operators import fundamentals as fm
from tidemark.operators.windows import dealt
from tidemark.queries_fundamentals import METRICS
from tidemark.sources.market import view

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tasks_grow_with_the_input(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(200_000, numPartitions=4).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x")).write.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    df = spark.read.parquet(path)
    many = dealt(df.where("id >= 0"), "id", mb=0.1)
    assert many.rdd.getNumPartitions() > 2 * cores and many.agg(F.sum("id")).first()[0] == sum(range(200_000))
    assert "RepartitionByExpression [id" in plan(dealt(df, "id", mb=1000)) and dealt(spark.range(9), "id").count() == 9


def test_histories_take_few_sorts(spark):
    df = fm.metric_events(view(spark, SF, "reports"), METRICS)
    df.collect()
    tree = df._jdf.queryExecution().executedPlan().toString()
    final = tree[: tree.index("Initial Plan")] if "Initial Plan" in tree else tree
    assert len(re.findall(r"\bWindow \[", final)) <= 6 and "inline(array(struct(role" not in final


def test_replays_ask_for_compared_dates_only(spark):
    text = plan(entry.queries()["pit_regression"](spark, SF))
    # below the windows of what is known: live and three replays, each with its universe's dates and their members'
    assert len(re.findall(r"Filter .*last_day\(.* IN \(", text)) >= 4


def test_insider_lines_are_dealt_before_they_are_added_up(spark):
    text = plan(entry.queries()["factor_insider_net_buy"](spark, SF))
    assert text.count("RepartitionByExpression [l_suppkey") == 2 and "RepartitionByExpression [security_id" in text
