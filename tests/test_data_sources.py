"""The page source reads what filters ask for; the object sink leaves all of a job's objects or none."""

import os

import pytest
from pyspark.sql import functions as F

from inkspan.sources import objects, pages


class FeedReader:
    """Text files whose pages end in form feeds; each page that is opened is noted in a folder."""

    def __init__(self, noted):
        self.noted = noted

    def files(self, path):
        return sorted(f for f in os.listdir(path) if not f.startswith("."))

    def count(self, path, name):
        with open(f"{path}/{name}") as f:
            return len(f.read().split("\f")) if os.path.getsize(f"{path}/{name}") else 0

    def pages(self, path, name, first, last):
        with open(f"{path}/{name}") as f:
            for k, text in enumerate(f.read().split("\f")):
                if first <= k < last:
                    open(f"{self.noted}/{name}-{k}", "w").close()
                    yield text.encode()


@pytest.fixture
def folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "noted").mkdir()
    for name, n in (("a.txt", 7), ("b.txt", 2), ("c.txt", 0), ("d.txt", 1)):
        (tmp_path / "in" / name).write_text("\f".join(f"{name} {k}" for k in range(n)))
    pages.register(spark, FeedReader(str(tmp_path / "noted")))
    before = spark.conf.get(pages.PUSHDOWN)
    spark.conf.set(pages.PUSHDOWN, "true")
    yield tmp_path
    spark.conf.set(pages.PUSHDOWN, before)


def read(spark, folder, where=None, size=3):
    df = spark.read.format("pages").option("path", str(folder / "in")).option("range", size).load()
    df = df.filter(where) if where else df
    rows = sorted((r["name"], r["page_id"], bytes(r["content"]).decode()) for r in df.collect())
    opened = sorted(os.listdir(folder / "noted"))
    for f in opened:
        os.remove(folder / "noted" / f)
    return rows, opened, df


def test_all_pages_in_ranges(spark, folder):
    rows, opened, df = read(spark, folder)
    want = [(n, k, f"{n} {k}") for n, c in (("a.txt", 7), ("b.txt", 2), ("d.txt", 1)) for k in range(c)]
    assert rows == want and len(opened) == 10 and df.rdd.getNumPartitions() == 5


@pytest.mark.parametrize(
    "where, asked",
    [
        ("page_id = 1", lambda n, k: k == 1), ("page_id > 1 and page_id <= 4", lambda n, k: 1 < k <= 4), ("page_id >= 6 and name = 'a.txt'", lambda n, k: k >= 6 and n == "a.txt"),
        ("name in ('b.txt', 'd.txt') and page_id < 1", lambda n, k: n in ("b.txt", "d.txt") and k < 1), ("page_id > 99", lambda n, k: False), ("page_id = 1 and page_id = 2", lambda n, k: False),
    ],
)
def test_filters_open_only_their_pages(spark, folder, where, asked):
    rows, opened, _ = read(spark, folder, where)
    want = [(n, k) for n, c in (("a.txt", 7), ("b.txt", 2), ("d.txt", 1)) for k in range(c) if asked(n, k)]
    assert [r[:2] for r in rows] == want and opened == sorted(f"{n}-{k}" for n, k in want)


def test_other_filters_stay_with_spark(spark, folder):
    rows, opened, _ = read(spark, folder, "page_id % 2 = 0 and page_id < 3 and content is not null")
    assert [r[:2] for r in rows] == [("a.txt", 0), ("a.txt", 2), ("b.txt", 0), ("d.txt", 0)]
    assert len(opened) == 6


def stored(root):
    return {os.path.relpath(f"{d}/{f}", root): open(f"{d}/{f}", "rb").read() for d, _, files in os.walk(root) for f in files}


def test_objects_are_written_once_by_name(spark, tmp_path):
    objects.register(spark, objects.FolderStore(str(tmp_path)))
    df = spark.range(40).select(F.concat(F.lit("doc/"), (F.col("id") % 30).cast("string"), F.lit(".json")).alias("name"), F.when(F.col("id") != 7, (F.col("id") % 30).cast("string")).cast("binary").alias("content"))
    for _ in range(2):  # again: the same objects
        df.repartition(5).write.format("objects").mode("append").save()
        assert stored(tmp_path) == {f"doc/{i}.json": b"" if i == 7 and stored(tmp_path)["doc/7.json"] == b"" else str(i).encode() for i in range(30)}
    spark.createDataFrame([], "name string, content binary").write.format("objects").mode("append").save()
    assert len(stored(tmp_path)) == 30


def test_a_task_that_fails_midway_leaves_nothing(spark, tmp_path):
    (tmp_path / "kept").write_bytes(b"old")
    objects.register(spark, objects.FolderStore(str(tmp_path)))
    rows = [("kept", bytearray(b"new"))] + [(f"x{i}", bytearray(b"y")) for i in range(20)] + [(None, bytearray(b"z"))]
    with pytest.raises(Exception, match="not an object's name"):
        spark.createDataFrame(rows, "name string, content binary").repartition(4).write.format("objects").mode("append").save()
    assert stored(tmp_path) == {"kept": b"old"}


def test_an_attempt_that_is_not_committed_leaves_no_object(tmp_path):
    """A lost executor's task runs again: what its first attempt put aside goes with the job."""
    from pyspark.sql import Row

    writer = objects._Writer(objects.FolderStore(str(tmp_path)))
    rows = [Row(name="a", content=b"1"), Row(name="b/c", content=b"2")]
    writer.write(iter(rows))
    again = writer.write(iter(rows))
    assert all(k.startswith(objects.ASIDE) for k in stored(tmp_path))
    writer.commit([again, None])
    assert stored(tmp_path) == {"a": b"1", "b/c": b"2"}
    for bad in ("../out", "_aside/x"):
        other = objects._Writer(objects.FolderStore(str(tmp_path)))
        with pytest.raises(ValueError):
            other.commit([other.write(iter([Row(name=bad, content=b"")]))])
        other.abort([])
    assert stored(tmp_path) == {"a": b"1", "b/c": b"2"}
