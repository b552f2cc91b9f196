import json
import pkgutil
import subprocess
import sys
import time
from types import SimpleNamespace
from unittest.mock import MagicMock

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import strata
from strata import cli, folders
from strata.operators.delta import compact_delta, upsert_delta
from strata.schemas import BRONZE, LOG, PAYLOAD, SILVER
from strata.sources import read_current, read_feed, read_file_log, read_kafka, read_kafka_tail
from strata.sources.log import kafka_options
from strata.streaming import run_bronze, run_publish


def test_declared_columns():
    assert len(BRONZE) == 7 and len(PAYLOAD) == 13 and len(SILVER) == 19
    assert len(PAYLOAD["meta"].dataType) == 5


def test_kafka_options():
    assert kafka_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1", "kafka.security.protocol": "PLAINTEXT", "subscribe": "t",
        "startingOffsets": "earliest", "failOnDataLoss": "true",
    }
    more = kafka_options("h:1", "t", start="latest", max_offsets=9, min_partitions=64, max_records_per_task=7)
    assert more["startingOffsets"] == "latest"
    assert more["maxOffsetsPerTrigger"] == "9" and more["minPartitions"] == "64"
    assert more["maxRecordsPerPartition"] == "7"


def test_missing_backends_are_errors(spark):
    for reader in (read_kafka, read_kafka_tail):
        with pytest.raises(AnalysisException):
            reader(spark, "h:1", "t")
    with pytest.raises(ImportError):
        upsert_delta(spark.range(1), "/nowhere")
    root = folders.scratch(spark)
    folders.make(spark, f"{root}/feed")
    with pytest.raises(AnalysisException):
        run_publish(read_feed(spark, f"{root}/feed"), f"{root}/checkpoint", topic="t", servers="h:1")


@pytest.fixture
def delta_table(monkeypatch):
    """Stands in for Delta Lake's ``DeltaTable``, to see what is asked of it."""
    table = MagicMock()
    monkeypatch.setitem(sys.modules, "delta", SimpleNamespace())
    monkeypatch.setitem(sys.modules, "delta.tables", SimpleNamespace(DeltaTable=table))
    return table


def test_delta_table_is_created_only_when_missing(delta_table):
    delta_table.isDeltaTable.return_value = False
    batch = MagicMock()
    upsert_delta(batch, "/t")
    batch.write.format.assert_called_once_with("delta")
    delta_table.forPath.assert_not_called()


def test_delta_merge_updates_and_inserts_all(delta_table):
    delta_table.isDeltaTable.return_value = True
    batch = MagicMock()
    upsert_delta(batch, "/t")
    batch.write.format.assert_not_called()
    merge = delta_table.forPath.return_value.alias.return_value.merge
    assert merge.call_args.args == (batch.alias.return_value, "t.meta_id = s.meta_id")
    merge.return_value.whenMatchedUpdateAll.assert_called_once_with()
    inserting = merge.return_value.whenMatchedUpdateAll.return_value.whenNotMatchedInsertAll
    inserting.return_value.execute.assert_called_once_with()


def test_delta_compaction(delta_table):
    compact_delta("spark", "/t")
    delta_table.forPath.assert_called_once_with("spark", "/t")
    delta_table.forPath.return_value.optimize.return_value.executeCompaction.assert_called_once_with()


def test_scratch_uses_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = folders.scratch(spark), folders.scratch(spark)
    assert first.startswith(shared) and first != second


def test_scratch_is_under_the_warehouse_where_no_folder_is_named():
    known = {"spark.sql.warehouse.dir": "hdfs:/warehouse"}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: known.get(name, default)))
    assert folders.scratch(session).startswith("hdfs:/warehouse/strata-")


def test_feed_to_state_through_the_command_line(spark):
    root = folders.scratch(spark)
    folders.make(spark, f"{root}/feed")
    with open(f"{root}/feed/1.txt", "w") as file:
        for i in range(8):
            payload = {"meta": {"id": f"k{i % 3}"}, "title": f"t{i}", "timestamp": 100 + i}
            file.write(f"event: message\ndata: {json.dumps(payload)}\n\n")
    assert cli.main(["publish", "--feed_path", f"{root}/feed", "--output_path", f"{root}/payloads",
                     "--max_files", "1", "--checkpoint", f"{root}/c0"]) == 0
    # A broker would number the records; here they are numbered in the order of the feed.
    payloads = sorted(spark.read.parquet(f"{root}/payloads").collect(), key=lambda r: json.loads(r.value)["timestamp"])
    records = [("t", 0, n, None, r.value.encode()) for n, r in enumerate(payloads)]
    spark.createDataFrame(records, LOG).write.parquet(f"{root}/arrived")
    assert cli.main(["capture", "--log_path", f"{root}/arrived", "--output_path", f"{root}/log",
                     "--checkpoint", f"{root}/c00"]) == 0
    assert cli.main(["tail", "--log_path", f"{root}/log", "--output_path", f"{root}/tail", "--checkpoint",
                     f"{root}/c3", "--drain"]) == 0
    assert cli.main(["bronze", "--log_path", f"{root}/log", "--landing_path", f"{root}/bronze",
                     "--checkpoint", f"{root}/c1"]) == 0
    assert cli.main(["silver", "--bronze_path", f"{root}/bronze", "--silver_landing_layer", f"{root}/silver",
                     "--checkpoint", f"{root}/c2", "--shuffle_partitions", "20"]) == 0
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    state = read_current(spark, f"{root}/silver").select("meta_id", "title", F.unix_seconds("kafka_timestamp"))
    assert sorted(tuple(r) for r in state.collect()) == [("k0", "t6", 106), ("k1", "t7", 107), ("k2", "t5", 105)]


def test_bronze_fails_before_a_batch_with_a_gap(spark):
    root = folders.scratch(spark)

    def job(offsets, flag="--check_gaps"):
        rows = spark.createDataFrame([("t", 0, o, None, b"x") for o in offsets], LOG)
        rows.write.mode("append").parquet(f"{root}/log")
        code = cli.main(["bronze", "--log_path", f"{root}/log", "--landing_path", f"{root}/b",
                         "--checkpoint", f"{root}/c", flag])
        return code, sorted(r.offset for r in spark.read.parquet(f"{root}/b").collect())

    assert job([0, 1, 2]) == (0, [0, 1, 2])
    assert job([3, 5]) == (1, [0, 1, 2])
    assert job([6]) == (1, [0, 1, 2])  # the batch is done again first
    assert job([], "--accept_gaps") == (0, [0, 1, 2, 3, 5, 6])
    assert job([4, 7, 7, 8]) == (0, [0, 1, 2, 3, 4, 5, 6, 7, 7, 8])  # late and repeated ones
    assert job([10])[0] == 1
    with pytest.raises(SystemExit):
        cli.main(["bronze", "--EXTERNAL_IP", "h:1", "--topic", "t", "--landing_path", "b", "--checkpoint", "c",
                  "--check_gaps"])


def test_failures_become_exit_codes(spark):
    root = folders.scratch(spark)
    assert cli.main(["bronze", "--EXTERNAL_IP", "h:1", "--topic", "t", "--landing_path", f"{root}/b",
                     "--checkpoint", f"{root}/c"]) == 1
    with pytest.raises(SystemExit):
        cli.main(["silver", "--bronze_path", "b"])
    with pytest.raises(SystemExit):
        cli.main(["bronze", "--EXTERNAL_IP", "h:1", "--landing_path", "b", "--checkpoint", "c"])


def test_every_module_can_be_imported_first():
    modules = [m.name for m in pkgutil.walk_packages(strata.__path__, "strata.")]
    assert "strata.sources.current" in modules
    clear = "[sys.modules.pop(n) for n in list(sys.modules) if n.startswith('strata')]"
    code = "import importlib, sys\n" + "\n".join(f"importlib.import_module({m!r}); {clear}" for m in modules)
    subprocess.run([sys.executable, "-c", code], check=True)
