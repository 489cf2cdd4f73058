import datetime

from inkspan.operators.files import latest
from inkspan.schemas import PARSE_STATE
from inkspan.streaming.state import StateTable, requests


def row(file_id, status, minute):
    return (file_id, None, None, None, None, None, None, status, None, None, None, datetime.datetime(2024, 1, 1, 0, minute))


def test_messages_in_batch_and_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text('{"data":[{"file_id":"1"},{"file_id":"2"}]}\n{"files":[{"file_id":"3"}]}\nnot json\n')
    batch = sorted(r["file_id"] for r in requests(spark.read.text(str(tmp_path / "in"))).collect())
    q = requests(spark.readStream.text(str(tmp_path / "in"))).writeStream.format("memory").queryName("found").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert batch == sorted(r["file_id"] for r in spark.table("found").collect()) == ["1", "2", "3"]


def test_state_merges_and_repeats_nothing(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "state"))
    first = spark.createDataFrame([row("a", 1, 1), row("b", 3, 1), row("a", 2, 2)], PARSE_STATE)
    table.merge(first, 0)
    second = spark.createDataFrame([row("a", 1, 9), row("b", 0, 3), row("c", 0, 1)], PARSE_STATE)
    for _ in range(2):  # a micro-batch that runs again
        table.merge(second, 1)
    assert {r["file_id"]: r["parse_status"] for r in table.read().collect()} == {"a": 2, "b": 0, "c": 0}
    assert latest(first, ["file_id"], [first["update_time"]]).count() == 2


def test_state_stream(spark, tmp_path):
    spark.createDataFrame([row("a", 1, 1), row("a", 3, 2)], PARSE_STATE).write.parquet(str(tmp_path / "changes"))
    table = StateTable(spark, str(tmp_path / "state"))
    table.sink(spark.readStream.schema(PARSE_STATE).parquet(str(tmp_path / "changes")), str(tmp_path / "ck")).awaitTermination(120)
    assert [(r["file_id"], r["parse_status"]) for r in table.read().collect()] == [("a", 3)]
