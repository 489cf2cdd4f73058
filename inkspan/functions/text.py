"""Text rules as column expressions. Character classes are written out, so that no engine's idea of
`\\s`, `\\w` or `\\d` decides a result."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters and their replacements, ranges, marks.
LIGATURES = {"ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl", "ﬁ": "fi", "ﬂ": "fl", "ﬆ": "st", "ﬅ": "st"}
HYPHEN = "\x02"
SPACE_LIKE = "\ufffe\ufeff\xa0"
BULLETS = "•●○■▪▫–—"
CHINESE = "\u4e00-\u9fff\u3400-\u4dbf\uf900-\ufaff\U00020000-\U0002a6df\U0002a700-\U0002b73f\U0002b740-\U0002b81f\U0002b820-\U0002ceaf\U0002ceb0-\U0002ebef\U0002f800-\U0002fa1f"
COMMON_CHINESE = "\u4e00-\u9fa5"
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CHINESE_PUNCTUATION = "。？，！：（）【】《》——“”‘’"
NO_SCRIPT = "&%$#_}{~^【】？～、，；：;:,。》><《￥`·()、"
FONT_FLAGS = {0: "fixed_pitch", 1: "serif", 2: "symbolic", 3: "script", 5: "non_symbolic", 6: "italic", 16: "all_cap", 17: "small_cap", 18: "bold", 19: "use_extern_attr"}
UNSUPPORTED_FONTS = (
    "FzBookMaker", "宋体", "ËÎÌå", "ËÎÌå-GBK-EUC-", "宋体-GBK-EUC-", "EU-BZ+Z", "STSong-Light", "NBCDEE+E-BZ", "B4+SimSun", "B6+SimSun",
    "AAAAAQ+FZFSK--GBK1-0", "AAAAAY+FZFSK--GBK1-0", "FHFDIG+E-BZ", "E-BZ-PK74818f", "E-HZ-PK7481d5", "E-BX-PK74818c",
)
INVALID = "\ufffd"
TEXT_LABELS = ("text", "footnote", "text_tile", "table_title", "figure_title")
TITLE_LABELS = ("doc_title", "text_title")


def quoted(chars: str) -> str:
    """Characters for use inside a bracket of a pattern."""
    return "".join("\\" + c if c in "\\]^-[&~#" else c for c in chars)


def strip(c: Column) -> Column:
    """Without outer white space."""
    return F.regexp_replace(c, r"^[\s\x0b]+|[\s\x0b]+$", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, r"[\s\x0b]+$", "")


def lstrip(c: Column) -> Column:
    return F.regexp_replace(c, r"^[\s\x0b]+", "")


def count(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern)).cast("long")


def clean_text(c: Column) -> Column:
    """Line ends and spaces made plain, control characters dropped (but the hyphen mark), ligatures spelt."""
    c = F.translate(F.replace(c, F.lit("\r\n"), F.lit("\n")), SPACE_LIKE + "\r", "   \n")
    c = F.regexp_replace(c, rf"[\p{{C}}&&[^{HYPHEN}\n\r\f\t ]]", "")
    return reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), LIGATURES.items(), c)


def keep_hyphens(c: Column) -> Column:
    return F.replace(c, F.lit(HYPHEN), F.lit("-\n"))


def join_hyphens(c: Column) -> Column:
    """Takes hyphen marks out: after one, line breaks go until a space, which becomes the line break."""
    start = F.struct(F.lit("").alias("out"), F.lit(False).alias("open"))

    def step(a: Column, ch: Column) -> Column:
        out = (
            F.when(ch == HYPHEN, a["out"]).when(a["open"] & ch.isin("\n", "\r"), a["out"])
            .when(a["open"] & ch.isin(" ", *SPACE_LIKE), F.concat(rstrip(a["out"]), F.lit("\n"))).otherwise(F.concat(a["out"], ch))
        )
        return F.struct(out.alias("out"), F.when(ch == HYPHEN, True).when(ch.isin(" ", *SPACE_LIKE), False).otherwise(a["open"]).alias("open"))

    return F.when(F.instr(c, HYPHEN) == 0, c).otherwise(F.aggregate(F.split(c, ""), start, step, lambda a: a["out"]))


def to_halfwidth(c: Column) -> Column:
    """Full-width ASCII forms but the last."""
    return F.translate(c, "".join(map(chr, range(0xFF01, 0xFF5E))), "".join(map(chr, range(0x21, 0x7E))))


def cleanup(c: Column) -> Column:
    c = F.regexp_replace(c, r"\n{3,}", "\n\n")
    c = F.regexp_replace(c, r"(\n[\s\x0b]){3,}", "\n\n")
    return F.replace(c, F.lit("\xa0"), F.lit(" "))


def replace_bullets(c: Column) -> Column:
    return F.regexp_replace(c, rf"(^|[\n ])[{BULLETS}]( )", "$1-$2")


def alphanum_ratio(c: Column) -> Column:
    """Letters and digits of what is neither space nor line feed; 1 if there is nothing."""
    kept = F.translate(c, " \n", "")
    return F.when(F.length(kept) == 0, 1.0).otherwise(F.try_divide(F.length(F.regexp_replace(kept, r"[^\p{L}\p{N}]", "")), F.length(kept)))


def is_bad_text(c: Column, spaces: float = 0.7, newlines: float = 0.6, alphanum: float = 0.3) -> Column:
    """Text that recognition should read again."""
    s, n = F.regexp_count(c, F.lit(r"[\s\x0b]+")), F.regexp_count(c, F.lit(r"\n+"))
    solid, unbroken = F.length(F.regexp_replace(c, r"[\s\x0b]+", "")), F.length(F.regexp_replace(c, r"\n+", ""))
    return (
        (F.length(c) == 0) | (F.try_divide(s, solid + s) > spaces) | (F.try_divide(n, unbroken + n) > newlines) | (alphanum_ratio(c) < alphanum)
        | (F.length(c) - F.length(F.translate(c, INVALID, "")) > F.greatest(F.lit(6.0), F.length(c) * 0.03))
    )


def low_code_share(c: Column) -> Column:
    """Share of characters with a code under 65; null for no text."""
    return F.try_divide(F.length(F.regexp_replace(c, r"[^\x00-\x40]", "")), F.length(c))


def replace_outer_digits(c: Column, by: str = "") -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"^[0-9]+", by), r"[0-9]+$", by)


def contains_chinese(c: Column) -> Column:
    return c.rlike("[\u4e00-\u9fff]")


def first_is_chinese(c: Column) -> Column:
    return c.rlike(f"^[{CHINESE}]")


def is_chinese_or_english(c: Column) -> Column:
    """One character's script, or other."""
    return F.when(c.rlike(f"^[{COMMON_CHINESE}]"), "chinese").when(c.rlike("^[A-Za-z]"), "english").otherwise("other")


def letters_only(c: Column) -> Column:
    return F.regexp_replace(c, f"[^{COMMON_CHINESE}a-zA-Z]", "")


def chinese_count(c: Column) -> Column:
    return F.length(F.regexp_replace(c, f"[^{COMMON_CHINESE}]", "")).cast("long")


def english_count(c: Column) -> Column:
    return F.length(F.regexp_replace(c, "[^A-Za-z]", "")).cast("long")


def is_punctuation(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit("")).rlike(f"^[{quoted(ASCII_PUNCTUATION + CHINESE_PUNCTUATION)} \\t\\n\\r\\f\\x0b]+$")


def escape_markdown(c: Column) -> Column:
    return F.replace(c, F.lit("#"), F.lit("\\#"))


def is_script(c: Column) -> Column:
    """Short text that may be a sub- or superscript."""
    return (
        (F.length(strip(c)) <= 9) & (F.length(F.regexp_replace(c, "[^A-Z]", "")) <= 3) & (F.length(F.regexp_replace(c, "[^a-z]", "")) <= 4) & ~is_punctuation(c)
        & ~c.rlike(f"[{COMMON_CHINESE}.]") & ~c.rlike(f"[{quoted(NO_SCRIPT)}]")
    )


def surround(c: Column, mark: str) -> Column:
    """mark around the text, inside its outer white space."""
    lead, tail = F.regexp_extract(c, r"^([\s\x0b]*)", 1), F.regexp_extract(c, r"([\s\x0b]*)$", 1)
    return F.concat(lead, F.lit(mark), strip(c), F.lit(mark), tail)


def title_case(c: Column) -> Column:
    """A capital after every non-letter, small letters elsewhere."""
    chars = F.split(F.lower(c), "")
    return F.array_join(F.transform(chars, lambda x, i: F.when((i == 0) | ~F.coalesce(F.get(chars, i - 1), F.lit("")).rlike(r"\p{L}"), F.upper(x)).otherwise(x)), "")


def block_markdown(c: Column, label: Column) -> Column:
    """Markdown of a block by its label."""
    plain = ~c.startswith("#")
    t = strip(c)
    formula = t.startswith("$$") & t.endswith("$$")
    return (
        F.when((label == "text_title") & plain, F.concat(F.lit("\n## "), title_case(t), F.lit("\n"))).when((label == "doc_title") & plain, F.concat(F.lit("# "), title_case(t), F.lit("\n")))
        .when(label == "table", F.concat(F.lit("\n"), c, F.lit("\n"))).when(label == "code", F.concat(F.lit("\n```\n"), c, F.lit("\n```\n")))
        .when(label.isin("text", "list_item"), escape_markdown(c)).when((label == "formula") & formula, F.concat(F.lit("\n"), t, F.lit("\n"))).otherwise(c)
    )


_SMALL, _HYPHENS = r"\p{Lo}\p{Ll}0-9", "\\-—¬"


def join_lines(a: Column, b: Column, label: Column) -> Column:
    """Two lines as one text: glued, spaced or set apart; the first rule that fits."""
    bare_a, bare_b = F.replace(a, F.lit("\n"), F.lit("")), F.replace(b, F.lit("\n"), F.lit(""))
    hyphen = (F.length(a) > 0) & a.rlike(rf"(?s)[{_SMALL}][{_HYPHENS}][\s\x0b]?$") & b.rlike(rf"^[\s\x0b]?[{_SMALL}]")
    chinese = bare_a.rlike(f"[{CHINESE}]$") & bare_b.rlike(f"^[{CHINESE}]")
    goes_on = a.rlike(rf"(?s)[{_SMALL}][,;(—\"'*]?[\s\x0b]?$") & b.rlike(r"^[\s\x0b]?[\p{L}0-9]")
    spaced = F.concat(rstrip(a), F.lit(" "), lstrip(b))
    return (
        F.when(hyphen, F.concat(rstrip(F.regexp_replace(a, rf"[{_HYPHENS}][\s\x0b]?$", "")), lstrip(b))).when(chinese, F.concat(rstrip(a), lstrip(b)))
        .when(label.isin(*TITLE_LABELS), spaced).when(goes_on, spaced)
        .when(label.isin(*TEXT_LABELS) & a.rlike(r"(?s)[。ๆ.?!][\s\x0b]?$"), F.concat(a, F.lit(" "), b)).when(label == "table", F.concat(a, F.lit("\n\n"), b)).otherwise(F.concat(a, F.lit(" "), b))
    )


def ends_sentence(c: Column) -> Column:
    return c.rlike(r"(?s)[。ๆ.?!？！][\s\x0b]?$")


def starts_list(c: Column) -> Column:
    return c.rlike(r"^([①②③④⑤⑥⑦⑧⑨⑩]|\([0-9]\)).")


def block_separator(label: Column, b: Column) -> Column:
    return F.concat(F.when(label == "text", "\n\n").otherwise("\n"), b)


def replace_dots(c: Column) -> Column:
    return F.regexp_replace(c, r"([\s\x0b]*\.[\s\x0b]*){4,}", " ")


def replace_newlines(c: Column) -> Column:
    return F.regexp_replace(strip(c), r"[\r\n]+", " ")


def font_flags(flags: Column) -> Column:
    names = F.array(*[F.when(flags.bitwiseAND(F.lit(1 << b)) > 0, n) for b, n in FONT_FLAGS.items()])
    return F.array_join(F.array_compact(names), "_")


def is_unsupported_font(name: Column) -> Column:
    return reduce(lambda a, b: a | b, [name.contains(f) for f in UNSUPPORTED_FONTS])


def utf16_ids(c: Column, offset: int = 3) -> Column:
    """UTF-16 code units of a text, each plus the offset. A text is read once, in one piece of memory: places in a
    string of characters cost as much as what stands before them."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        given = texts.is_valid().to_numpy(zero_copy_only=False)
        units = [t.encode("utf-16-le") for t in texts.fill_null("").to_pylist()]
        ends = np.concatenate([[0], np.cumsum([len(u) // 2 for u in units])]).astype(np.int32)
        values = np.frombuffer(b"".join(units), "<u2").astype(np.int32) + offset
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values), mask=pa.array(~given))

    return ids(c)


def byte_ids(c: Column, length: int, pad: int = 0, offset: int = 3) -> Column:
    """Ids of UTF-8 bytes, cut or padded to a length, with their mask."""
    h = F.hex(F.encode(c, "UTF-8"))
    n = F.least(F.lit(length), (F.length(h) / 2).cast("int"))
    ids = F.transform(F.regexp_extract_all(F.substring(h, 1, 2 * length), F.lit(".."), F.lit(0)), lambda b: F.conv(b, 16, 10).cast("int") + offset)
    rest = F.lit(length) - n
    return F.struct(F.concat(ids, F.array_repeat(F.lit(pad), rest)).alias("ids"), F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), rest)).alias("mask"), n.alias("length"))


# ---- formulas --------------------------------------------------------------------------------


def contains_math(c: Column) -> Column:
    return c.rlike(r"<math") | c.contains("$") | c.contains("\\[")


def remove_labels(c: Column) -> Column:
    """Without \\label, \\ref and \\cite groups."""
    return reduce(lambda x, n: F.regexp_replace(x, rf"\\{n}\{{[^}}]*\}}", ""), ("label", "ref", "cite"), c)


def latex_chunks(c: Column) -> Column:
    """Ordered chunks of a text, formulas ($$..$$, $..$) and what stands between them."""
    return F.filter(F.regexp_extract_all(c, F.lit(r"(?s)(\$\$.+?\$\$|\$[^$]+\$|[^$]+|\$)"), 1), lambda x: F.length(x) > 0)


def is_formula(c: Column) -> Column:
    return c.rlike(r"(?s)^\$.+\$$")


def strip_fences(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"^\$+", ""), r"\$+$", "")
