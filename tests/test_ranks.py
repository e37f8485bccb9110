"""Ranks of groups that hold much of the rows."""

from pyspark.sql import functions as F

from folioloom.runtime import ranked


def test_hot_group_is_ranked_by_many_tasks(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"), F.pmod(F.hash("id"), F.lit(97)).alias("o"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table would be one partition
    try:
        got = ranked(df, ["g"], ["o", "id"], "place").collect()
        parts = [r["count"] for r in df.repartitionByRange("g", "o", "id").filter("g = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    groups = {}
    for r in got:
        groups.setdefault(r["g"], []).append((r["place"], r["o"], r["id"]))
    assert len(got) == 4000 and len(groups["hot"]) == 2000
    for rows in groups.values():
        rows.sort()
        assert [x[0] for x in rows] == list(range(1, len(rows) + 1)) and [x[1:] for x in rows] == sorted(x[1:] for x in rows)
    assert len(parts) > 1 and max(parts) < 1800
    assert ranked(df.filter("id < 0"), ["g"], ["o"], "place").count() == 0
