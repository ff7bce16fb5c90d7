"""The daily job end to end on partitioned inputs."""

import datetime as dt
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from itemwise import RecConfig, run_recommendations, vector_job_config
from itemwise.functions import yesterday
from itemwise.sinks import ensure_table, overwrite_partition
from itemwise.sources import fixtures as fx
from itemwise.sources import read_dictionary, read_features

DAYS = (20231231, 20240101)


@pytest.fixture(scope="module")
def inputs(spark):
    """the sf0.001 feature table and dictionary copied under two days."""
    root = tempfile.mkdtemp(prefix="itemwise-job-")
    feats = fx.order_features(spark, SF_SMALL).withColumnRenamed("user_id", "imei")
    dic = fx.part_dictionary(spark, SF_SMALL)
    for day in DAYS:
        (feats.withColumn("stat_date", F.lit(day).cast("bigint"))
         .write.mode("append").partitionBy("stat_date").parquet(f"{root}/features"))
        (dic.withColumn("stat_date", F.lit(day).cast("bigint"))
         .write.mode("append").partitionBy("stat_date").parquet(f"{root}/items"))
    return root


def test_yesterday():
    assert yesterday(dt.date(2024, 1, 1)) == 20231231
    assert yesterday(dt.date(2024, 3, 1)) == 20240229


def test_day_filter_prunes_partitions(spark, inputs):
    df = read_features(spark, f"{inputs}/features", DAYS[0])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "stat_date" in plan
    assert df.count() == 150
    labels = read_dictionary(spark, f"{inputs}/items", DAYS[0])
    assert labels.where(F.col("column_index").isNull()).count() == 0


@pytest.mark.parametrize("layout", ["source_recom", "user_watched"])
def test_job_replaces_one_day(spark, inputs, layout):
    table = f"recs_{layout}_{uuid.uuid4().hex[:8]}"
    cfg = RecConfig(layout=layout, label="name" if layout == "user_watched" else "code")
    for day in DAYS:
        run_recommendations(spark, f"{inputs}/features", f"{inputs}/items", table, cfg, day)
    first = spark.table(table).where(F.col("stat_date") == DAYS[0]).count()
    run_recommendations(spark, f"{inputs}/features", f"{inputs}/items", table, cfg,
                        as_of=dt.date(2024, 1, 1))       # yesterday = DAYS[0] again
    counts = {r.stat_date: r["count"] for r in spark.table(table).groupBy("stat_date").count().collect()}
    assert counts == {DAYS[0]: first, DAYS[1]: 150}


def test_vector_job_layout(spark, inputs):
    table = f"recs_vec_{uuid.uuid4().hex[:8]}"
    # strict labels fail on this dictionary: some candidates have no id
    with pytest.raises(Exception, match="item without label"):
        run_recommendations(spark, f"{inputs}/features", f"{inputs}/items", table,
                            vector_job_config(), DAYS[1])
    run_recommendations(spark, f"{inputs}/features", f"{inputs}/items", table,
                        vector_job_config(missing_label="drop"), DAYS[1])
    rows = spark.table(table).collect()
    assert len(rows) == 150
    assert all(r.sim_items == "" or r.sim_items.endswith(", ") for r in rows)


def test_overwrite_keeps_other_days(spark):
    table = f"t_{uuid.uuid4().hex[:8]}"
    ensure_table(spark, table, [("a", "STRING")])
    one = spark.createDataFrame([("x",), ("y",)], "a string")
    overwrite_partition(one, table, 1)
    overwrite_partition(one, table, 2)
    overwrite_partition(one.limit(1), table, 1)
    got = sorted((r.a, r.stat_date) for r in spark.table(table).collect())
    assert got == [("x", 1), ("x", 2), ("y", 2)]


def _files(spark, table):
    return sorted(f.split("/_runs/")[-1] for f in spark.table(table).inputFiles())


def test_failed_rerun_keeps_the_day(spark):
    """Nothing of a day is touched before its new rows are complete."""
    table = f"t_{uuid.uuid4().hex[:8]}"
    ensure_table(spark, table, [("a", "STRING")])
    rows = spark.range(5).select(F.col("id").cast("string").alias("a"))
    for day in (1, 2):
        overwrite_partition(rows, table, day)
    before = _files(spark, table)
    broken = rows.withColumn("a", F.when(F.col("a") == "4", F.raise_error(F.lit("bad label")))
                             .otherwise("new"))
    with pytest.raises(Exception, match="bad label"):
        overwrite_partition(broken, table, 1)
    assert _files(spark, table) == before
    got = sorted((r.a, r.stat_date) for r in spark.table(table).collect())
    assert got == sorted((str(i), d) for i in range(5) for d in (1, 2))
    with pytest.raises(ValueError):
        overwrite_partition(rows.withColumnRenamed("a", "b"), table, 1)
    overwrite_partition(rows.limit(1), table, 1)
    assert spark.table(table).groupBy("stat_date").count().orderBy("stat_date").collect() == [
        (1, 1), (2, 5)]


def test_failed_job_keeps_the_day(spark, inputs):
    """A strict label that is missing costs the run, not the published day."""
    table = f"recs_{uuid.uuid4().hex[:8]}"
    args = (spark, f"{inputs}/features", f"{inputs}/items", table)
    run_recommendations(*args, vector_job_config(missing_label="drop"), DAYS[1])
    before = sorted(map(tuple, spark.table(table).collect()))
    with pytest.raises(Exception, match="item without label"):
        run_recommendations(*args, vector_job_config(), DAYS[1])
    assert sorted(map(tuple, spark.table(table).collect())) == before and len(before) == 150


def test_day_moves_in_one_step(spark):
    """The new folder is complete before the catalog points at it, readers of
    the old one can be spared, and an empty day is a day."""
    from itemwise.session import delete_path
    from itemwise.sinks import partition_location, publish_partition, stage_partition
    table = f"t_{uuid.uuid4().hex[:8]}"
    ensure_table(spark, table, [("a", "STRING"), ("n", "INT")])
    one = spark.createDataFrame([(7, "x")], "n long, a string")    # other order, other type
    assert partition_location(spark, table, 1) is None
    assert overwrite_partition(one, table, 1) is None
    staged = stage_partition(one.union(one), table, 1)
    assert spark.table(table).count() == 1
    old = publish_partition(spark, table, 1, staged)
    assert [tuple(r) for r in spark.table(table).collect()] == [("x", 7, 1)] * 2
    assert spark.read.parquet(old).count() == 1
    delete_path(spark, old)
    kept = overwrite_partition(one.limit(0), table, 1, keep_old=True)
    assert spark.table(table).count() == 0 and spark.read.parquet(kept).count() == 2
    assert partition_location(spark, table, 1) != kept


def test_command_line(spark, inputs):
    from itemwise.__main__ import main, parse_args
    table = f"recs_cli_{uuid.uuid4().hex[:8]}"
    args = ["--features", f"{inputs}/features", "--dictionary", f"{inputs}/items",
            "--table-out", table, "--stat-date", str(DAYS[1]), "--top-n", "5", "--top-k", "3",
            "--normalize", "false"]
    assert parse_args(args).normalize is False
    assert main(args, spark) == 0
    rows = spark.table(table).collect()
    assert len(rows) == 150 and {r.stat_date for r in rows} == {DAYS[1]}
    assert max(len(r.recom_id.split(",")) for r in rows if r.recom_id) <= 3


def test_materialized_tables_are_dropped(spark, inputs):
    import os
    from itemwise.plans.jobs import build_output
    from itemwise.session import drop_materialized
    feats = read_features(spark, f"{inputs}/features", DAYS[0])
    labels = read_dictionary(spark, f"{inputs}/items", DAYS[0])
    keep = []
    out = build_output(feats, labels, RecConfig(), keep=keep)
    # interactions, labels, history sizes, base, popularity, similarity, list counts and lists
    assert out.count() == 150 and len(keep) == 8
    folders = [df.inputFiles()[0].rsplit("/", 1)[0].replace("file:", "") for df in keep]
    assert all(os.path.isdir(f) for f in folders)
    for df in keep:
        drop_materialized(df)
    assert not any(os.path.exists(f) for f in folders)
