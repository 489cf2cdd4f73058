"""Schemas of the stage tables, and fixed domains.

Coordinates carry their space in the table's documentation: page points unless a name says otherwise."""

from __future__ import annotations

from pyspark.sql import types as T

#: Layout classes by id, from 1.
LABELS = ("doc_title", "text_title", "text", "table", "figure", "table_title", "figure_title", "header", "footer", "footnote", "contents", "box", "formula")


_TYPES = {"long": T.LongType, "int": T.IntegerType, "double": T.DoubleType, "string": T.StringType, "boolean": T.BooleanType, "timestamp": T.TimestampType, "binary": T.BinaryType}


def _split(s: str) -> list[str]:
    """Parts of a list of fields, at commas outside brackets."""
    out, depth = [""], 0
    for c in s:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return [x.strip() for x in out]


def data_type(name: str) -> T.DataType:
    name = name.strip()
    if name.startswith("array<"):
        return T.ArrayType(data_type(name[6:-1]))
    if name.startswith("struct<"):
        return T.StructType([T.StructField(f.split(":")[0].strip(), data_type(f.split(":", 1)[1])) for f in _split(name[7:-1])])
    return _TYPES[name]()


def schema(ddl: str) -> T.StructType:
    """A schema from "name type, ..."; unlike Spark's own parser it needs no session."""
    return T.StructType([T.StructField(f.split(" ", 1)[0], data_type(f.split(" ", 1)[1])) for f in _split(ddl)])


_BOX = "x0 double, y0 double, x1 double, y1 double"
CHARS = schema(f"doc_id long, page_id int, char_idx int, char string, {_BOX}, font_name string, font_size double, font_weight int, font_flags int, rotation double")
PAGES = schema(f"doc_id long, page_id int, rotation int, {_BOX}, width double, height double")
SPANS = schema(f"doc_id long, page_id int, block_id int, line_id int, span_id string, text string, {_BOX}, font string, font_weight int, font_size double, rotation double, bold boolean, italic boolean")
LINES = schema(f"doc_id long, page_id int, block_id int, line_id int, {_BOX}")
BLOCKS = schema(f"doc_id long, page_id int, block_id int, block_type string, position int, html_code string, table_trust double, {_BOX}")
REGIONS = schema(f"doc_id long, page_id int, region_id int, label string, confidence double, {_BOX}, image_w int, image_h int")
ORDER_BOXES = schema(f"doc_id long, page_id int, idx int, position int, {_BOX}")
TEXT_LINES = schema("doc_id long, page_id int, line_idx int, polygon array<array<double>>, confidence double")
OCR_LINES = schema("doc_id long, page_id int, line_idx int, text string, confidence double, polygon array<array<double>>")
TABLE_CELLS = schema(f"doc_id long, page_id int, block_id int, cell_idx int, {_BOX}")
TABLE_TOKENS = schema("doc_id long, page_id int, block_id int, tok_idx int, token string")
TOC = schema("doc_id long, ord int, level int, title string, page_id int, is_closed boolean, n_kids int, view_mode int, view_pos array<double>")
ELEMENTS = schema(f"doc_id long, global_index int, page_id int, para_id int, attr string, text string, title_level int, slot int, informative boolean, leaf boolean, meta_name string, {_BOX}")
PARSE_STATE = schema(
    "file_id string, kg_id string, file_type string, file_name string, file_url string, language string, knowledge_type string, parse_status int, json_tree_url string, markdown_url string, feature string, update_time timestamp"
)


def checked(df, expected: T.StructType):
    """df with the expected columns, cast; a missing column raises."""
    missing = [f.name for f in expected if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are missing")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in expected])
