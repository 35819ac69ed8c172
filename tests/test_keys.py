"""Key probes: broadcast and shuffle give the same answer, also with hot and missing keys."""

import re

import pytest
from pyspark.sql import functions as F

from vaultline.operators import keys as K
from vaultline.operators.tables import TABLES
from tests.helpers import judge, key_set, raw_frame, valid_row
from vaultline.operators import curation


def facts(spark, rows):
    frame = spark.createDataFrame(rows, "id long, fk long").repartition(4)
    return frame.withColumn(K.ROW_ID, F.monotonically_increasing_id())


@pytest.mark.parametrize("bound", ["1000000", "0"])
def test_members_with_hot_and_missing_keys(spark, setting, bound):
    setting(K.MAX_BROADCAST_KEYS_SETTING, bound)
    rows = [(i, 7) for i in range(400)] + [(1000 + i, None) for i in range(300)] + [(2000 + i, i) for i in range(300)]
    marked = K.mark_members(facts(spark, rows), "fk", key_set(spark, *range(0, 300, 7)), "known")
    assert marked.columns == ["id", "fk", K.ROW_ID, "known"]
    got = {r["id"]: r["known"] for r in marked.collect()}
    assert got == {i: fk is not None and fk % 7 == 0 for i, fk in rows}


def test_no_partition_receives_a_hot_key(spark, setting):
    setting(K.MAX_BROADCAST_KEYS_SETTING, "0")
    setting("spark.sql.adaptive.enabled", "false")
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = [(i, 7) for i in range(4000)] + [(10000 + i, None) for i in range(2000)] + [(20000 + i, i) for i in range(500)]
    marked = K.mark_members(facts(spark, rows), "fk", key_set(spark, *range(500)), "known")
    sizes = [r["n"] for r in marked.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == len(rows) and max(sizes) < len(rows) / 4
    assert marked.where("known").count() == 4500


def test_frequent_values_are_found(spark):
    rows = [(i, 5) for i in range(500)] + [(i, i) for i in range(1000, 1500)]
    assert 5 in K.frequent_values(facts(spark, rows), "fk")


def test_duplicates_of_every_kind(spark):
    table = TABLES["accounts"]
    ids = ["1", "1.0", "2", "x", "x", " x", "y", None, "", "3"]
    rows = [valid_row("accounts", account_id=i) for i in ids]
    frame = curation.parsed(raw_frame(spark, "accounts", rows), table)
    found = K.find_duplicates(frame, "key_account_id", "text_account_id")
    assert [r["key"] for r in found.numeric.frame.collect()] == [1] and found.numeric.rows == 1
    assert [r["key"] for r in found.textual.frame.collect()] == ["x"] and found.textual.rows == 1
    assert found.missing


@pytest.mark.parametrize("bound", ["1000000", "0"])
def test_duplicate_verdicts(spark, setting, bound):
    setting(K.MAX_BROADCAST_KEYS_SETTING, bound)
    ids = ["1", "1.0", "2", "x", "x", "y", None, ""]
    verdicts, _ = judge(spark, "accounts", [valid_row("accounts", account_id=i) for i in ids])
    said = ["Duplicate Account ID" in v[0] if v else False for v in sorted(verdicts, key=repr)]
    assert sum(said) == 6 and sum(v is None for v in verdicts) == 1


def test_small_parents_are_broadcast_and_rows_not_shuffled(spark):
    table = TABLES["transactions"]
    raw = raw_frame(spark, "transactions", [valid_row("transactions")])
    from tests.helpers import parents_of

    plan = curation.validated(raw, table, parents_of(spark, "transactions"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "Cartesian" not in plan


def test_large_parents_send_orphans_to_rows(spark, setting):
    frame = facts(spark, [(i, i % 50) for i in range(2000)] + [(5000, None)])
    parent = key_set(spark, *range(45))
    setting(K.MAX_BROADCAST_KEYS_SETTING, "10")
    marked = K.mark_orphans(frame, "fk", parent, "orphan")
    assert {r["id"] for r in marked.where("orphan").collect()} == {i for i in range(2000) if i % 50 >= 45} | {5000}
    assert "Exchange hashpartitioning" not in marked._jdf.queryExecution().executedPlan().toString()


def test_long_textual_keys_are_not_broadcast(spark):
    assert not K.KeySet(spark.range(3), 3, K.MAX_BROADCAST_TEXT + 1).fits()


def test_beyond_every_bound_shuffles_carry_no_readings(spark, setting):
    """Where rows are shuffled they are raw text, row id, keys and flags; numbers, dates and stripped texts are read afterwards."""
    setting(K.MAX_BROADCAST_KEYS_SETTING, "0")
    setting("spark.sql.adaptive.enabled", "false")
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.maxMetadataStringLength", "10000")
    setting("spark.sql.debug.maxToStringFields", "1000")
    rows = [valid_row("cards", card_id=str(3000 + i // 2), customer_id=str(1000 + i % 2)) for i in range(6)]
    parents = {"customers": key_set(spark, 1000), "accounts": key_set(spark, 10000)}
    frame = curation.judged(raw_frame(spark, "cards", rows), TABLES["cards"], parents)
    described = frame._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    exchanges = [part for part in described.split("\n\n") if re.match(r"\(\d+\) Exchange", part)]
    carried = [name for part in exchanges for name in re.findall(r"([a-z_]+)#\d+", part.split("Arguments")[0])]
    assert "raw_card_type" in carried and "key_customer_id" in carried
    assert not [name for name in carried if name.startswith(("text_", "num_", "time_"))]
    assert frame.where("is_bad").count() == 6
