"""The status machine on a stream against the batch query: replays, late messages, restarts, timers."""

import datetime
import random
import time

import pytest

from inkspan.operators.files import FAILED, PROCESSING, SUCCESS, latest, upsert
from inkspan.schemas import PARSE_STATE
from inkspan.streaming import machine

COMPARED = ["file_id", "parse_status", "update_time", "file_url"]


@pytest.fixture
def store(spark):
    # Timers ask for batches without data for ever, which a stream that is to end must not have.
    mine = {"spark.sql.streaming.stateStore.providerClass": machine.PROVIDER, "spark.sql.streaming.noDataMicroBatches.enabled": "false", "spark.sql.shuffle.partitions": "2"}
    before = {k: spark.conf.get(k, None) for k in mine}
    for k, v in mine.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def change(file_id, status, minute, url=None):
    at = None if minute is None else datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minute)
    return (file_id, None, "pdf", None, url, None, None, status, None, None, None, at)


class Runs:
    """A stream over a folder of changes, run to its end as often as wanted, from one checkpoint."""

    def __init__(self, spark, path, patience):
        self.spark, self.path, self.patience, self.n = spark, path, patience, 0
        (path / "in").mkdir()

    def put(self, rows):
        self.spark.createDataFrame(rows, PARSE_STATE).coalesce(1).write.mode("append").parquet(str(self.path / "in"))

    def run(self, **source):
        changes = self.spark.readStream.schema(PARSE_STATE).options(maxFilesPerTrigger=1).parquet(str(self.path / "in"))
        out = machine.file_states(changes, self.patience)
        append = lambda df, i: df.write.mode("overwrite").parquet(str(self.path / f"out/batch={i}"))
        q = out.writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", str(self.path / "ck")).trigger(availableNow=True).start()
        assert q.awaitTermination(120)

    def emitted(self):
        return self.spark.read.parquet(str(self.path / "out")).drop("batch")

    def states(self):
        """The last state that went out for each file."""
        rows = self.spark.read.parquet(str(self.path / "out")).collect()
        newest = {}
        for r in sorted(rows, key=lambda r: r["batch"]):
            newest[r["file_id"]] = tuple(r[c] for c in COMPARED)
        return newest


def batch_state(spark, rows):
    none = spark.createDataFrame([], PARSE_STATE)
    return {r["file_id"]: tuple(r[c] for c in COMPARED) for r in upsert(none, spark.createDataFrame(rows, PARSE_STATE), keep_finished=True).collect()}


def test_stream_leaves_the_batch_state(spark, store, tmp_path):
    """Three runs with restarts between them: shuffled changes, replays, late ones and ties."""
    rng = random.Random(8)
    rows = [change(f"f{rng.randrange(12)}", rng.choice([0, PROCESSING, PROCESSING, SUCCESS, FAILED]), rng.choice([None, *range(30)]), rng.choice(["u", "v", None])) for _ in range(150)]
    runs = Runs(spark, tmp_path, datetime.timedelta(days=3))
    seen = []
    for part in (rows[:60], rows[60:100] + rows[:30], rows[100:] + rows[50:120]):
        runs.put(part[: len(part) // 2])
        runs.put(part[len(part) // 2 :] + [change(None, 1, 1)])
        seen += part
        runs.run()
        assert runs.states() == batch_state(spark, seen)
    # Each state went out once, and only replaced an older one.
    emitted = [tuple(r) for r in runs.emitted().collect()]
    assert len(emitted) == len(set(emitted)) and None not in {r[0] for r in emitted}
    before = runs.emitted().count()
    runs.put(rows)  # everything again changes nothing
    runs.run()
    assert runs.emitted().count() == before
    assert latest(spark.createDataFrame(rows, PARSE_STATE), ["file_id"], []).count() == 12


def test_files_left_in_processing_fail(spark, store, tmp_path):
    """A timer outlives a restart; a file that has moved on is left alone, and one that failed can finish."""
    patience = datetime.timedelta(seconds=1)
    runs = Runs(spark, tmp_path, patience)
    runs.put([change("stuck", PROCESSING, 1, "u"), change("done", PROCESSING, 1), change("late", PROCESSING, 1)])
    runs.run()
    runs.put([change("done", SUCCESS, 2)])
    time.sleep(1.5)
    runs.run()
    got = {k: v[1] for k, v in runs.states().items()}
    assert got["done"] == SUCCESS and got["stuck"] == FAILED and got["late"] == FAILED
    assert runs.states()["stuck"] == ("stuck", FAILED, datetime.datetime(2024, 1, 1, 0, 1) + patience, "u")
    runs.put([change("late", SUCCESS, 0), change("stuck", PROCESSING, 5)])
    runs.run()
    assert {k: v[1] for k, v in runs.states().items()} == {"done": SUCCESS, "late": SUCCESS, "stuck": PROCESSING}


def test_rank_is_the_order_of_the_batch_query():
    micros = lambda r: (*r[:-1], None if r[-1] is None else int(r[-1].timestamp() * 1_000_000))
    row = lambda *a: micros(change("x", *a))[1:]
    order = [row(1, None), row(1, 1), row(3, 2, None), row(3, 2, "a"), row(0, 7), row(SUCCESS, None), row(SUCCESS, 1)]
    assert sorted(order[::-1], key=machine.rank) == order
