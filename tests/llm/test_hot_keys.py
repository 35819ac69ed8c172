"""A key that a third of all rows have does not gather in one task."""

import pytest
from pyspark.sql import functions as F

from vaultline.llm import common, lattice, url_rules


@pytest.fixture
def unaided(spark):
    """Without run-time help against skew and without broadcasts that are not asked for."""
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shares(frame):
    return [r["n"] for r in frame.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]


def test_join_spread(spark, unaided, tmp_path):
    rows = spark.range(6000).select(F.col("id"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 500).alias("k")).repartition(8)
    groups = rows.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") * 2)
    groups.write.parquet(str(tmp_path / "groups"))
    joined = common.join_spread(rows, spark.read.parquet(str(tmp_path / "groups")), ["k"], "n", 6000)
    assert sorted(joined.columns) == ["id", "k", "v"]
    assert joined.where("v = 2 * k").count() == 6000 and joined.select("id").distinct().count() == 6000
    assert max(shares(joined)) < 6000 / 4


def test_urls_without_a_host(spark, unaided):
    pages = spark.range(3000).select(
        F.col("id").alias("page_id"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("http://h"), F.col("id"), F.lit(".net/x"))).alias("url")
    ).repartition(8)
    rules = spark.createDataFrame([("net", "/", "block"), ("h7.net", "/", "allow")], "host string, path string, verdict string")
    judged = url_rules.judge(pages, rules)
    assert max(shares(judged)) < 3000 / 4
    kinds = {(r["host"] == "", r["rule"], r["verdict"]): r["count"] for r in
             judged.groupBy("host", "rule", "verdict").count().groupBy((F.col("host") == "").alias("host"), "rule", "verdict").agg(
                 F.sum("count").alias("count")).select(F.when(F.col("host"), "").otherwise("x").alias("host"), "rule", "verdict", "count").collect()}
    assert kinds == {(True, None, "allow"): 1000, (False, "net/", "block"): 1999, (False, "h7.net/", "allow"): 1}


def test_a_long_word_goes_to_the_frequent_ones(spark):
    word = b"w" * 500
    words = spark.createDataFrame([(word, 900, 0), (b"a", 5, 0), (b"b", 1, 0)], "word binary, trained long, others long")
    assert lattice._frequent_from(words, 1) == 6 and lattice._frequent_from(words, 2) == 2 and lattice._frequent_from(words, 3) == 1
    assert len(lattice._key(word)) == 17 and lattice._key(word)[0] == 0xFF
