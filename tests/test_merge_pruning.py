import uuid

from pyspark.sql import functions as F

from faresight.sinks import merge, tables


def _ids(spark, lo, hi, copies=1):
    return spark.range(lo, hi).select(F.md5(F.col("id").cast("string")).alias(merge.ROW_ID), "id", F.explode(
        F.sequence(F.lit(1), F.lit(copies))).alias("copy"))


def _table(spark, lo, hi, buckets):
    name = f"pruned_{uuid.uuid4().hex[:8]}"
    if buckets:
        tables.save_bucketed(_ids(spark, lo, hi), name, merge.ROW_ID, buckets)
    else:
        _ids(spark, lo, hi).write.format("parquet").saveAsTable(name)
    return name


def _files_read(df):
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().collectLeaves().apply(0).metrics().apply("numFiles").value()


def test_a_small_batch_reads_its_buckets_only(spark):
    name = _table(spark, 0, 4000, 32)
    ids = _ids(spark, 0, 3).select(merge.ROW_ID).distinct()
    used = {r[0] for r in ids.select(F.pmod(F.hash(merge.ROW_ID), F.lit(32))).collect()}
    every = _files_read(spark.table(name).select(merge.ROW_ID))
    pruned = _files_read(merge.bucket_files(spark.table(name), sorted(used)).select(merge.ROW_ID))
    assert every >= 32 and pruned * 32 == every * len(used)
    assert merge.matched_ids(spark, ids, name).count() == 3


def test_merges_into_both_layouts(spark):
    for buckets in (8, 0):
        name = _table(spark, 0, 500, buckets)
        assert merge.merge_insert_only(spark, _ids(spark, 490, 510), name) == 10
        assert merge.merge_insert_only(spark, _ids(spark, 490, 510), name) == 0
        assert merge.merge_insert_only(spark, _ids(spark, 600, 602, copies=3), name) == 6      # copies in a batch are all kept
        assert merge.merge_insert_only(spark, _ids(spark, 700, 702, copies=3), name, dedupe_source=True) == 2
        assert merge.merge_insert_only(spark, _ids(spark, 0, 0), name) == 0
        nulls = spark.createDataFrame([(None, 1, 1), (None, 2, 1)], "unique_row_id string, id long, copy int")
        assert [merge.merge_insert_only(spark, nulls, name) for _ in range(2)] == [2, 2]       # an unknown id matches none
        assert spark.table(name).count() == 500 + 10 + 6 + 2 + 4


def test_the_bloom_filter_passes_few_others(spark):
    target = _ids(spark, 0, 20_000).select(merge.ROW_ID)
    ids = _ids(spark, 19_990, 20_010).select(merge.ROW_ID).distinct()
    left = merge.passing(target, ids, merge.ROW_ID)
    assert 10 <= left.count() <= 20
    assert ids.join(left, merge.ROW_ID, "left_semi").count() == 10


def test_a_hot_id_on_a_bucketed_target_is_one_question_and_is_split(spark):
    name = _table(spark, 0, 100, 4)
    hot = spark.range(30_000).select(F.md5(F.when(F.col("id") % 3 == 0, F.lit("new")).otherwise(F.col("id").cast("string")))
                                     .alias(merge.ROW_ID), "id", F.lit(1).alias("copy"))
    ids = hot.select(merge.ROW_ID).distinct()
    held = merge.matched_ids(spark, ids, name)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        new = merge.new_rows(merge._written(spark, hot, "t-hot"), merge._written(spark, held, "t-held"))
        new.collect()
        plan = new._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "skew=true" in plan
    assert merge.merge_insert_only(spark, hot, name) == 30_000 - 66
