import os
import uuid

import pytest
from pyspark.sql import functions as F

from faresight.plans import io_queries, settings
from faresight.session import scratch_path
from faresight.sinks import files as sinks
from faresight.sources import files
from tests.conftest import SF_SMALL

PROPS = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def _pages(spark, pages):
    base = scratch_path(spark, "t-pages")
    local = base[len("file:"):] if base.startswith("file:") else base
    os.makedirs(local)
    for n, text in pages.items():
        with open(f"{local}/page_{n}.json", "w") as fh:
            fh.write(text)
    return base


def _read(spark, base, start=1):
    return sorted((r.page, r.id) for r in files.read_numbered_pages(spark, base, "id int", start).collect())


def test_pages_end_at_the_first_empty_one(spark):
    base = _pages(spark, {1: '[{"id": 1}, {"id": 2}]', 2: '[{"id": 3}]', 3: " [ ]\n", 4: '[{"id": 4}]', 10: '[{"id": 5}]'})
    assert _read(spark, base) == [(1, 1), (1, 2), (2, 3)]
    assert files.page_bounds(spark, base) == (1, 3)
    assert _read(spark, base, 4) == [(4, 4)]                # a missing page ends the data too
    assert _read(spark, base, 3) == [] and files.page_bounds(spark, base, 3) == (3, 3)
    assert _read(spark, base, 5) == [] and files.page_bounds(spark, base, 5) == (5, 5)
    assert _read(spark, base, 10) == [(10, 5)]


def test_pages_are_listed_and_looked_at_in_few_tasks(spark):
    base = scratch_path(spark, "t-pages")
    # 120 pages, the 70th empty, and one without a number
    value = F.when(F.col("id") == 70, "[]").otherwise(F.format_string('[{"id": %d}]', "id"))
    name = F.when(F.col("id") > 0, F.concat(F.lit("page_"), F.col("id"))).otherwise("page_none")
    sinks.write_pages(spark.range(121).select(name.alias("name"), value.alias("value")), base)
    spark.sparkContext.setJobGroup("pages", "pages")
    try:
        assert files.page_bounds(spark, base) == (1, 70)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("pages") for s in tracker.getJobInfo(j).stageIds}
    tasks = [i.numTasks for i in map(tracker.getStageInfo, stages) if i]
    assert tasks and max(tasks) < 100               # no task a page
    assert _read(spark, base) == [(i, i) for i in range(1, 70)]
    assert _read(spark, base, 71) == [(i, i) for i in range(71, 121)]
    assert files.read_json_pages(spark, base, "id int").count() == 120


@pytest.fixture()
def url(spark):
    try:
        spark._jvm.java.lang.Class.forName(PROPS["driver"])
    except Exception:  # noqa: BLE001
        pytest.skip("no embedded Derby driver on the classpath")
    return f"jdbc:derby:memory:ranges_{uuid.uuid4().hex[:8]};create=true"


def _table(spark, url, df):
    df.write.format("jdbc").mode("append").option("url", url).option("dbtable", "T").options(**PROPS).save()


def test_skewed_keys_are_read_in_even_partitions(spark, url):
    # 90 % of the rows in 1 % of the range, and rows without a key
    ids = spark.range(4000).select(F.when(F.col("id") < 3600, 500_000 + F.col("id") % 9000)
                                   .otherwise((F.col("id") - 3600) * 2500).cast("int").alias("ID"))
    _table(spark, url, ids.unionAll(spark.range(20).select(F.lit(None).cast("int").alias("ID"))))
    df = files.read_jdbc_even(spark, url, "SELECT ID FROM T", "ID", 8, PROPS)
    sizes = sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
    assert sum(sizes) == 4020 and 7 <= len(sizes) <= 9 and sizes[-1] <= 2 * 4000 / 8
    assert sorted(str(r.ID) for r in df.collect()) == sorted(
        [str(r.ID) for r in ids.collect()] + ["None"] * 20)


def test_even_ranges_of_few_values_and_of_none(spark, url):
    _table(spark, url, spark.range(300).select(F.when(F.col("id") < 290, 7).otherwise(F.col("id")).cast("int").alias("ID")))
    df = files.read_jdbc_even(spark, url, "SELECT ID FROM T", "ID", 4, PROPS)
    assert df.count() == 300                                # one value cannot be divided
    assert files.read_jdbc_even(spark, url, "SELECT ID FROM T WHERE ID < 0", "ID", 4, PROPS).count() == 0


def test_run_variables_reach_a_query(spark, monkeypatch):
    def before_day():
        return io_queries.recent_rides(spark, SF_SMALL).first()["before_day"]

    default = before_day()
    monkeypatch.setitem(settings.GIVEN, "days_back", 1)
    assert before_day() < default
    monkeypatch.delitem(settings.GIVEN, "days_back")
    monkeypatch.setenv("DAYS_BACK", "400")
    assert before_day() > default
