"""What the replay, scoring and model jobs leave on disk."""

import time

from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from tarmac.operators.numbering import global_row_number
from tarmac.plans import q_ml, q_stream
from tarmac.session import SHUFFLE_CLEANUP, checkpoint_root, list_folder, remove_folder, shuffles_removed, work_dir
from tarmac.sources.fixtures import flights, stored_flights
from tarmac.streaming import jobs as J


def _shuffle_files(spark):
    held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum("shuffle_" in held.apply(i).getName() for i in range(held.size()))


def test_rows_numbered_in_a_folder_leave_no_checkpoint(spark):
    rows = spark.range(5000).select((F.col("id") % 71).alias("a"), (F.col("id") % 13).cast("string").alias("b"), "id").repartition(5)
    folder, root = work_dir(spark, "t_numbered"), checkpoint_root(spark)
    before = {n for n in list_folder(spark, root) if n.startswith("rdd-")}
    kept = global_row_number(rows, ["a", "b", "id"], folder=folder)
    assert {n for n in list_folder(spark, root) if n.startswith("rdd-")} <= before
    assert kept.exceptAll(global_row_number(rows, ["a", "b", "id"])).isEmpty() and kept.count() == 5000
    remove_folder(spark, folder)


def test_a_one_time_write_leaves_no_shuffle_files(spark):
    held, path = _shuffle_files(spark), work_dir(spark, "t_once")
    with shuffles_removed(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
        spark.range(1000).repartition(3, "id").write.parquet(path)
    for _ in range(100):  # they are removed in the background
        if _shuffle_files(spark) <= held:
            break
        time.sleep(0.1)
    assert _shuffle_files(spark) <= held
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false" and spark.read.parquet(path).count() == 1000
    remove_folder(spark, path)


def test_replay_files_are_compressed_and_their_numbering_is_gone(spark, monkeypatch):
    monkeypatch.setattr(q_stream, "ROWS_PER_FILE", 700)
    root = f"{checkpoint_root(spark)}/tarmac"
    before, path = set(list_folder(spark, root)), work_dir(spark, "t_replay")
    q_stream.write_replay(spark, stored_flights(spark, SF_SMALL), path)
    assert not [n for n in set(list_folder(spark, root)) - before if n.startswith("numbered")]
    n = flights(spark, SF_SMALL).count()
    folders = [f for f in list_folder(spark, path) if f.startswith("batch_id=")]
    files = [[x for x in list_folder(spark, f"{path}/{f}") if x.startswith("part-")] for f in folders]
    assert len(folders) == -(-n // 700) and all(len(f) == 1 and f[0].endswith(".csv.lz4") for f in files)
    remove_folder(spark, f"{path}/_SUCCESS")
    out = work_dir(spark, "t_replayed")
    J.run_append(J.normalise_stream(J.read_replay_stream(spark, path, max_files_per_trigger=len(folders))), out, work_dir(spark, "t_replay_ckpt"))
    assert spark.read.parquet(out).count() == n


def test_the_tagged_table_is_not_spilled(spark):
    level = q_ml.tagged_flights(spark, SF_SMALL).storageLevel
    assert level.useMemory and not level.useDisk


def test_the_fact_table_is_not_shuffled_for_a_small_supplier_table(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "3000")  # above suppliers and nations, below parts and orders
    plan = flights(own, SF_MID)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_orderkey" in plan and "hashpartitioning(l_partkey" in plan
    assert "hashpartitioning(l_suppkey" not in plan
