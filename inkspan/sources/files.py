"""Files as tables, and tables as files and objects.

Nothing here opens a path in Python on its own: Spark's readers, writers and file systems do, or a callable that the
caller gives (a fetcher, a converter, an uploader), which runs on executors and is retried by row. A
failure is a value in a column, never a failed task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.operators.files import content, file_type
from inkspan.schemas import CHARS, schema


#: Files of more bytes are not read for their kind alone; their first bytes are.
WHOLE = 64 << 20


def list_files(spark: SparkSession, path: str, pattern: str = "*", whole: int = WHOLE) -> DataFrame:
    """(path, name, kind, n_bytes) of a file's or folder's files, of any size; hidden ones are left out. No task reads more
    than files of up to `whole` bytes as Spark packs them. The first bytes of larger files, of which there are few for
    the bytes they hold, are read on the driver through the file system that Spark uses: one short read each."""
    df = _files(spark, path, pattern)
    size, name = F.col("length"), _name()
    small = df.filter(size <= whole).select("path", name.alias("name"), file_type(F.col("content")).alias("kind"), size.alias("n_bytes"))
    heads = [(r["path"], _head(spark, r["path"])) for r in df.filter(size > whole).select("path").toLocalIterator()]
    if not heads:
        return small
    kinds = F.broadcast(spark.createDataFrame(heads, "path string, head binary"))
    large = df.filter(size > whole).select("path", name.alias("name"), size.alias("n_bytes")).join(kinds, "path")
    return small.unionByName(large.select("path", "name", file_type(F.col("head")).alias("kind"), "n_bytes"))


def _head(spark: SparkSession, path: str, n: int = 8) -> bytes:
    """The first n bytes of a file."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(at)
    try:
        return bytes(b & 255 for b in (stream.read() for _ in range(n)) if b >= 0)
    finally:
        stream.close()


def _files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return df.filter(~_file_name().startswith("."))


def _file_name():
    return F.regexp_extract("path", r"([^/]+)$", 1)


def _name():
    return F.regexp_replace(_file_name(), r"\.[^.]*$", "")


def read_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, name, kind, content) of a file's or folder's files; hidden ones are left out. A file is one row, which a task
    holds whole and which Spark bounds at 2 GB; `list_files` has what can be said of files of any size."""
    return _files(spark, path, pattern).select("path", _name().alias("name"), file_type(F.col("content")).alias("kind"), "content")


def write_markdown(documents: DataFrame, path: str) -> None:
    """One text part of Markdown per task, documents whole."""
    documents.select(F.col("markdown").alias("value")).write.mode("overwrite").text(path)


def _with_retry(call: Callable, attempts: int, *args):
    for k in range(attempts):
        try:
            return call(*args), None
        except Exception as e:  # noqa: BLE001  the class goes into the table
            if k == attempts - 1:
                return None, type(e).__name__
    return None, "none"


def fetch(requests: DataFrame, fetcher: Callable[[str], bytes | None], attempts: int = 3) -> DataFrame:
    """requests (file_id, url, file_content) with content and error_class: fetched by url, else decoded."""

    def run(frames: Iterator):
        for f in frames:
            got = [_with_retry(fetcher, attempts, u) if u else (None, None) for u in f["url"]]
            yield f.assign(_bytes=[g[0] for g in got], _error=[g[1] for g in got])

    fields = "file_id string, url string, file_content string, _bytes binary, _error string"
    out = requests.select("file_id", "url", "file_content").mapInPandas(run, schema(fields))
    data, error = content(F.col("_bytes"), F.col("file_content"))
    return out.select("file_id", data.alias("content"), F.coalesce("_error", error).alias("error_class"))


def scan_chars(files: DataFrame, convert: Callable[[bytes], list[dict]]) -> DataFrame:
    """The glyphs of files (doc_id, content): `convert` gives a file's glyphs as rows without doc_id."""

    def run(frames: Iterator):
        import pandas as pd

        for f in frames:
            for doc_id, data in zip(f["doc_id"], f["content"], strict=True):
                rows, _ = _with_retry(convert, 1, data)
                if rows:
                    yield pd.DataFrame([{"doc_id": doc_id, **r} for r in rows], columns=CHARS.names)

    return files.select("doc_id", "content").mapInPandas(run, CHARS)


def upload(objects: DataFrame, uploader: Callable[[str, bytes], str], attempts: int = 3) -> DataFrame:
    """objects (name, content) with the url that the store gave, or an error class."""

    def run(frames: Iterator):
        for f in frames:
            got = [_with_retry(uploader, attempts, n, c) for n, c in zip(f["name"], f["content"], strict=True)]
            yield f[["name"]].assign(url=[g[0] for g in got], error_class=[g[1] for g in got])

    return objects.select("name", "content").mapInPandas(run, schema("name string, url string, error_class string"))


ANNOTATION = "filename string, split string, html string"


def annotations(lines: DataFrame, split: str, value: str = "value") -> DataFrame:
    """(filename, html) of one split, of JSON lines."""
    return lines.select(F.from_json(value, ANNOTATION).alias("r")).select("r.*").filter(F.col("split") == split).select("filename", "html")


def read_annotations(spark: SparkSession, path: str, split: str) -> DataFrame:
    """(filename, html) of one split of a JSON-lines file."""
    return annotations(spark.read.text(path), split)


def load_pages(spark: SparkSession, path: str, count: Callable[[str, bytes], int] | Callable[[str, int], int], first: int = 0, most: int | None = None, by_size: bool = False) -> DataFrame:
    """(path, name, kind, page_id) of a file's or folder's files, a row for each page in the range asked for: `count` gives a
    file's pages from its kind and content or, with `by_size`, from its kind and number of bytes, for files of any size
    (see `list_files`). Pictures have one page."""

    def run(frames: Iterator):
        for f in frames:
            n = [1 if k in ("png", "jpg", "gif") else _with_retry(count, 1, k, c)[0] or 0 for k, c in zip(f["kind"], f["n_bytes" if by_size else "content"], strict=True)]
            yield f[["path", "name", "kind"]].assign(n=n)

    files = list_files(spark, path) if by_size else read_files(spark, path)
    sized = files.mapInPandas(run, schema("path string, name string, kind string, n int"))
    last = F.col("n") - 1 if most is None else F.least(F.col("n"), F.lit(first + most)) - 1
    return sized.filter(last >= first).select("path", "name", "kind", F.explode(F.sequence(F.lit(first), last)).alias("page_id"))


def write_boxes(boxes: DataFrame, path: str) -> None:
    """Boxes with their labels as JSON lines for inspection, a document's together and in order."""
    boxes.repartition("doc_id").sortWithinPartitions("doc_id").write.mode("overwrite").json(path)
