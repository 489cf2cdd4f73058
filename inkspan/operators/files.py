"""Files, messages and the state of their processing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkspan.schemas import schema

FILE = "file_id string, url string, file_content string, file_name string"
ENVELOPE = schema(f"data array<struct<{FILE.replace(' string', ': string')}>>")
FILES = schema(f"files array<struct<{FILE.replace(' string', ': string')}>>")
# Registers by the first two parts of an object's name, any other name's, and that of examples.
REGISTERS = {"public/undefined": 0, "public/kg": 1, "private/doc": 2, "public/h5": 3, "public/built-in": 4, "private/attach": 5}
OTHER_REGISTER, EXAMPLES, EXAMPLES_REGISTER = 5, "public/built-in/examples", 2
# States of a file.
PREPARE, PROCESSING, SUCCESS, FAILED = 0, 1, 2, 3
#: Leading bytes by type.
SIGNATURES = {"pdf": "25504446", "png": "89504E47", "jpg": "FFD8FF", "gif": "47494638", "zip": "504B0304"}


def envelope_files(value: Column) -> Column:
    """The array of file requests in a message: {"data": [...]} or {"files": [...]}."""
    return F.coalesce(F.from_json(value, ENVELOPE)["data"], F.from_json(value, FILES)["files"])


def content(url_bytes: Column, encoded: Column) -> tuple[Column, Column]:
    """Bytes of a file and an error class: fetched ones, else decoded ones, else none."""
    found = F.coalesce(url_bytes, F.try_to_binary(encoded, F.lit("base64")))
    return found, F.when(found.isNull(), "file_url")


def file_type(data: Column, other: str = "other") -> Column:
    h = F.hex(F.substring(data, 1, 8))
    return F.coalesce(*[F.when(h.startswith(s), t) for t, s in SIGNATURES.items()], F.lit(other))


def backfill_fonts(glyphs: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """glyphs with the font of the last sample at or before each."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return glyphs.withColumn("font", F.last("font", True).over(w))


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The newest row of each key: partial maxima meet in one shuffle, so a key with many versions is no
    large group. Ties go by the whole row."""
    rest = [c for c in rows.columns if c not in keys]
    newest = F.max(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *rest)).alias("n")
    return rows.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"n.{c}").alias(c) for c in rest])


def upsert(state: DataFrame, changes: DataFrame, keys: Sequence[str] = ("file_id",), keep_finished: bool = False) -> DataFrame:
    """state with the newest change of each key: an insert, or an update of all columns where the key is there. With
    `keep_finished`, a finished file is not opened again, in whatever order changes come."""
    first = [(F.col("parse_status") == SUCCESS).cast("int")] if keep_finished else []
    return latest(state.unionByName(changes), keys, [*first, F.col("update_time")])


def gate(status: Column) -> Column:
    """What a request meets: `take` without a state or after a failure, or if only prepared; `done` after success;
    `repeated` while another works on it. (A state of 0 counts as none for an insert, see `taken`.)"""
    return F.when(F.coalesce(status, F.lit(PREPARE)).isin(PREPARE, FAILED), "take").when(status == SUCCESS, "done").otherwise("repeated")


def may_process(status: Column) -> Column:
    return gate(status) == "take"


def taken(requests: DataFrame, state: DataFrame) -> DataFrame:
    """requests (file_id, file_type, file_url, seen: the state that the caller has read) against the state table as it is
    now: `outcome` is inserted (no row), updated (the row still has the state that was read, so one row changes),
    conflict (another has changed it meanwhile), done or repeated; and the state that it leaves."""
    met = requests.join(state.select("file_id", F.col("parse_status").alias("now")), "file_id", "left")
    verdict = gate(F.col("seen"))
    take = F.when(F.col("now").isNull(), "inserted").when(F.col("now") == F.col("seen"), "updated").otherwise("conflict")
    outcome = F.when(verdict == "take", take).otherwise(verdict)
    return met.select(*requests.columns, outcome.alias("outcome"), F.when(outcome.isin("inserted", "updated"), PROCESSING).otherwise(F.col("now")).alias("parse_status"))


def object_register(name: Column) -> Column:
    """The register of an object's name: by its first two parts; examples have one of their own."""
    known = F.create_map(*[F.lit(x) for kv in REGISTERS.items() for x in kv])
    return F.when(name.startswith(EXAMPLES), EXAMPLES_REGISTER).otherwise(F.coalesce(F.try_element_at(known, F.substring_index(name, "/", 2)), F.lit(OTHER_REGISTER)))


def watermark_images(images: DataFrame, pages: DataFrame) -> DataFrame:
    """images (doc_id, page_id, w, h, bits, name) without those that occur as often as the document has
    pages (pages: doc_id, n_pages, page_w, page_h); images of the whole page stay."""
    key = ["doc_id", "w", "h", "bits", "name"]
    often = images.groupBy(*key).agg(F.count("*").alias("n")).join(pages, "doc_id")
    marks = often.filter((F.col("n") >= F.col("n_pages")) & ((F.col("w") < F.col("page_w")) | (F.col("h") < F.col("page_h")))).select(*key)
    return images.join(marks, key, "left_anti")
