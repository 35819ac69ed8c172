"""Keys beyond the bound are never broadcast by the size of their files; rows are judged on all cores, compiled."""

import re

from pyspark.sql import functions as F

from vaultline.operators import audit, curation
from vaultline.operators import keys as K
from vaultline.sources.scratch import keep
from vaultline.starbank.raw import RAW_SQL, base_table, raw_table
from vaultline.operators.tables import TABLES
from tests.helpers import judge, parents_of, raw_frame, valid_row


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_a_parent_beyond_the_bound_is_not_broadcast(spark, setting, monkeypatch):
    setting(K.MAX_BROADCAST_KEYS_SETTING, "10")
    parent = keep(spark.range(0, 400, 2).withColumnRenamed("id", "key"), "parent")
    rows = [(i, i) for i in range(100)] + [(1000 + i, 7) for i in range(300)] + [(2000 + i, None) for i in range(50)]
    child = spark.createDataFrame(rows, "id long, fk long").withColumn(K.ROW_ID, F.monotonically_increasing_id())
    plans = []
    monkeypatch.setattr(K, "keep", lambda frame, name, *by: plans.append((name, plan_of(frame))) or keep(frame, name, *by))
    marked = K.mark_orphans(child, "fk", K.KeySet(parent, 200), "orphan")
    assert [name for name, _ in plans] == ["counts", "orphans"]  # the child's keys are read once
    assert "BroadcastHashJoin" not in plans[1][1]
    assert {r["id"]: r["orphan"] for r in marked.collect()} == {i: fk is None or fk % 2 == 1 for i, fk in rows}
    assert "ShuffledHashJoin" in plan_of(marked)  # the members of frequent values may be broadcast, all others not


def test_the_audit_of_foreign_keys_broadcasts_no_parent(spark):
    tables = {
        "branches": spark.range(3).withColumnRenamed("id", "branch_id"),
        "employees": spark.createDataFrame([(1, 2), (2, 9), (3, None)], "employee_id long, branch_id long"),
    }
    found = audit.fk_audit(tables)
    assert "BroadcastHashJoin" not in plan_of(found)
    assert [(r["table_name"], r["orphan_count"]) for r in found.collect()] == [("employees", 1)]


def test_one_file_of_many_rows_is_judged_on_all_cores(spark, tmp_path):
    rows = [(i, f"Supplier#{i}", i % 25, float(i)) for i in range(500)]
    suppliers = spark.createDataFrame(rows, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")
    suppliers.coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    raw = raw_table(spark, str(tmp_path), "employees")
    assert raw.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    plain = spark.sql(RAW_SQL["employees"], supplier=base_table(spark, str(tmp_path), "supplier"))
    assert sorted(map(str, raw.collect())) == sorted(map(str, plain.collect()))


def test_a_session_at_the_default_limit_compiles_wide_rows(spark, setting):
    setting(curation.HUGE_METHODS, "65535")
    judge(spark, "branches", [valid_row("branches")])
    assert spark.conf.get(curation.HUGE_METHODS) == "8000"
    setting(curation.HUGE_METHODS, "4000")
    judge(spark, "branches", [valid_row("branches")])
    assert spark.conf.get(curation.HUGE_METHODS) == "4000"


def test_readings_and_verdicts_take_a_projection_each(spark, setting):
    ids = ["1", "1", "T1", "T1", None, "2", "3"]
    raw = raw_frame(spark, "transactions", [valid_row("transactions", transaction_id=i) for i in ids])
    judged = curation.judged(raw, TABLES["transactions"], parents_of(spark, "transactions"))
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"^[ :+-]*Project ", plan, re.M)) <= 9  # two of them of the three sets of keys that rows meet
    assert [r["is_bad"] for r in judged.orderBy(K.ROW_ID).collect()] == [True, True, True, True, True, False, False]
    setting(K.MAX_BROADCAST_KEYS_SETTING, "0")  # rows are shuffled: other projections, the same verdicts
    shuffled = curation.judged(raw, TABLES["transactions"], parents_of(spark, "transactions"))
    assert set(shuffled.columns) == set(judged.columns)
    assert [r["is_bad"] for r in shuffled.orderBy(K.ROW_ID).collect()] == [True, True, True, True, True, False, False]


def test_a_large_parent_of_close_keys_is_packed_and_rows_stay(spark, setting):
    setting(K.MAX_BROADCAST_KEYS_SETTING, "2000")
    parent = K.KeySet(keep(spark.range(-30_000, 30_000, 2).withColumnRenamed("id", "key"), "parent"), 30_000)
    keys = [None, -30_001, -30_000, -65, -64, -63, -2, -1, 0, 1, 63, 64, 126, 127, 29_998, 29_999, 30_000, 2**63 - 1, -(2**63)]
    child = spark.createDataFrame(list(enumerate(keys)), "id long, fk long").withColumn(K.ROW_ID, F.monotonically_increasing_id())
    assert not parent.fits() and parent.stays()
    marked = K.mark_orphans(child, "fk", parent, "orphan")
    plan = plan_of(marked)
    assert "BroadcastHashJoin" in plan and "ShuffledHashJoin" not in plan and "Exchange hashpartitioning" not in plan
    assert marked.columns == ["id", "fk", K.ROW_ID, "orphan"]
    known = {fk for fk in keys if fk is not None and -30_000 <= fk < 30_000 and fk % 2 == 0}
    assert {r["id"]: r["orphan"] for r in marked.collect()} == {i: fk not in known for i, fk in enumerate(keys)}


def test_a_large_parent_of_distant_keys_is_not_packed(spark, setting):
    setting(K.MAX_BROADCAST_KEYS_SETTING, "2000")
    parent = K.KeySet(keep(spark.range(12_000).select((F.col("id") * 1000).alias("key")), "parent"), 12_000)
    child = spark.createDataFrame([(1, 5000), (2, 5001), (3, None)], "id long, fk long").withColumn(K.ROW_ID, F.lit(0))
    assert not parent.stays()
    assert {r["id"] for r in K.mark_orphans(child, "fk", parent, "orphan").where("orphan").collect()} == {2, 3}


def test_splits_without_rows_do_not_count_as_spread(spark, setting, tmp_path):
    """A file of one row group is planned in many splits, of which one holds all rows."""
    rows = spark.range(200_000).select(
        F.col("id").alias("s_suppkey"), F.concat(F.lit("Supplier#"), F.col("id")).alias("s_name"),
        (F.col("id") % 25).cast("int").alias("s_nationkey"), F.rand(1).alias("s_acctbal"),
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    setting("spark.sql.files.maxPartitionBytes", "100k")
    setting("spark.sql.files.openCostInBytes", "1k")
    table = base_table(spark, str(tmp_path), "supplier")
    cores = spark.sparkContext.defaultParallelism
    assert table.rdd.getNumPartitions() >= cores
    dealt = raw_table(spark, str(tmp_path), "employees").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"))
    sizes = [r["n"] for r in dealt.collect()]
    assert sum(sizes) == 200_000 and len(sizes) >= cores and max(sizes) < 2 * 200_000 / cores


def test_lookups_are_compiled_apart_from_verdicts(spark):
    raw = raw_frame(spark, "transactions", [valid_row("transactions", transaction_id=i) for i in ("1", "1", "T", "T")])
    judged = curation.judged(raw, TABLES["transactions"], parents_of(spark, "transactions"))
    lines = [line for line in plan_of(judged).split("\n") if "Project" in line or "BroadcastHashJoin" in line]
    lookups = [i for i, line in enumerate(lines) if "BroadcastHashJoin" in line]
    assert any("exists(" in line and "*" not in line.split("Project")[0] for line in lines[: lookups[0]])
