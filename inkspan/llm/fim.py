"""Fill-in-middle as relations: units of texts, requests for cuts, offsets.

A text's units are its matches, from left to right, of a word with the white space before it, or of white space
that ends the text. Documents to be cut are dealt out once, whole, each under a key of its own, with the two
ordinals after which they are cut. There units are exploded with positions and lengths, and requests with the
ordinal of the unit they ask for. A window sums lengths over a document's rows in the order of ordinals: a request
stands right behind its unit and so meets the sum up to it, which joins the two by ordinal in one sort, without a
second pass over units. An aggregate brings a document's offsets together; substrings make the output. As every
row has its own key, no source, doc_id or group of copies decides how many rows a task has. Documents that stay
as they are are not shuffled: their units are only counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkspan.llm.common import documents

UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
#: Marks of prefix, suffix and middle; a text that holds one of them is left plain.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Shares, of 100: documents that are cut, and of those the ones whose suffix comes first.
RATE, SPM = 50, 80


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers of a doc_id; a null counts as the empty string."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def requested(docs: DataFrame, text: Column, cuts: Column, kept: Column) -> DataFrame:
    """A row for each request of the rows of docs (`_key`, unique): _key, _which (its place in cuts), _end (code points of
    the first cut units) and, with the first request, _kept."""
    unit = lambda u: F.struct(F.lit(None).cast("long").alias("at"), F.length(u).alias("n"), F.lit(-1).alias("which"))
    request = lambda c, i: F.struct((c - 1).alias("at"), F.lit(0).alias("n"), i.alias("which"))
    both = F.concat(F.transform(F.regexp_extract_all(text, F.lit(UNIT), F.lit(0)), unit), F.transform(cuts, request))
    rows = docs.select("_key", kept.alias("_doc"), F.posexplode(both).alias("_place", "_x"))
    rows = rows.select("_key", F.coalesce("_x.at", "_place").alias("_ordinal"), F.col("_x.n").alias("_n"), F.col("_x.which").alias("_which"), F.when(F.col("_x.which") == 0, F.col("_doc")).alias("_kept"))
    upto = Window.partitionBy("_key").orderBy("_ordinal", "_which").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("_end", F.sum("_n").over(upto)).filter("_which >= 0").select("_key", "_which", "_end", "_kept")


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", name: str = "fim", rate: int = RATE, spm: int = SPM, seed: int = SEED) -> DataFrame:
    """docs with a struct `name`: n (units), form, prefix_chars, middle_chars (code points; null if plain), output.

    Each row by itself, with or without a doc_id; a null text is empty, an empty one plain; equal rows have equal
    results; an empty table gives none. Columns of docs are kept; one called `name` gives way."""
    own = [c for c in docs.columns if c != name]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"), *[h.alias(f"_h{i}") for i, h in enumerate(draws(F.col(f"`{doc_id}`"), seed))])
    t = F.coalesce(F.col("_row").getField(text), F.lit(""))
    cut = (F.col("_h2") % 100 < rate) & (t != "") & ~t.contains(PREFIX) & ~t.contains(SUFFIX) & ~t.contains(MIDDLE)
    n = F.regexp_count(t, F.lit(UNIT)).cast("long")

    def result(df: DataFrame, form: Column, a: Column, b: Column, output: Column) -> DataFrame:
        made = F.struct(F.col("_n").alias("n"), form.alias("form"), a.alias("prefix_chars"), b.alias("middle_chars"), output.alias("output"))
        return df.select(*[F.col("_row").getField(c).alias(c) for c in own], made.alias(name))

    null = F.lit(None).cast("long")
    plain = result(rows.filter(~cut).withColumn("_n", n), F.lit("plain"), null, null, t)

    at = [F.col("_h0") % (F.col("_n") + 1), F.col("_h1") % (F.col("_n") + 1)]
    dealt = (
        rows.filter(cut).withColumn("_n", n)
        .select(F.monotonically_increasing_id().alias("_key"), F.struct("_row", "_n", (F.col("_h3") % 100 < spm).alias("_spm")).alias("_doc"), F.array(F.least(*at), F.greatest(*at)).alias("_cuts"))
        .repartition("_key")
    )
    met = requested(dealt, F.col("_doc._row").getField(text), F.col("_cuts"), F.col("_doc"))
    end = lambda i: F.max(F.when(F.col("_which") == i, F.col("_end")))
    joined = met.groupBy("_key").agg(F.first("_kept", True).alias("_doc"), end(0).alias("_a"), end(1).alias("_b")).select("_doc.*", "_a", "_b")
    part = lambda start, length: F.substring(t, (start + 1).cast("int"), length.cast("int"))
    a, b = F.col("_a"), F.col("_b")
    prefix, middle, suffix = part(F.lit(0), a), part(a, b - a), part(b, F.length(t) - b)
    output = F.when(F.col("_spm"), F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)).otherwise(
        F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    )
    return plain.unionByName(result(joined, F.when(F.col("_spm"), F.lit("spm")).otherwise(F.lit("psm")), a, b - a, output))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of: its first marks are the ones put in, as the text holds none."""
    after = lambda s, mark: F.substring(s, (F.locate(mark, s) + len(mark)).cast("int"), F.length(s))
    before = lambda s, mark: F.substring_index(s, mark, 1)
    rest = after(output, MIDDLE)
    psm = F.concat(before(after(output, PREFIX), SUFFIX), rest, before(after(output, SUFFIX), MIDDLE))
    spm = F.concat(before(after(output, PREFIX), MIDDLE), rest, before(after(output, SUFFIX), PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, lengths and digests of every document's output, and of the text rebuilt from it."""
    out = fill_in_middle(documents(spark, sf_dir).select("doc_id", "text"))
    f = F.col("fim")
    sha = lambda s: F.sha2(s, 256)
    return out.select(
        "doc_id", f["n"].alias("n"), f["form"].alias("form"), f["prefix_chars"].alias("prefix_chars"), f["middle_chars"].alias("middle_chars"),
        sha(f["output"]).alias("output_sha256"), sha(restored(f["output"], f["form"])).alias("restored_sha256"),
    )


#: Units as lists, cut by slices. The restored text is the text.
SQL = r"""
with d as (select doc_id, coalesce(text, '') t, sha256('42:' || coalesce(doc_id::varchar, '')) s from documents),
u as (select doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') us,
        [('0x' || substr(s, 8 * i + 1, 8))::bigint for i in range(4)] h from d),
c as (select *, len(us)::bigint n, least(h[1] % (len(us) + 1), h[2] % (len(us) + 1)) a, greatest(h[1] % (len(us) + 1), h[2] % (len(us) + 1)) b,
        case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h[3] % 100 >= 50 then 'plain'
             when h[4] % 100 < 80 then 'spm' else 'psm' end form from u),
p as (select *, array_to_string(us[1:a], '') pre, array_to_string(us[a + 1:b], '') mid, array_to_string(us[b + 1:], '') suf from c)
select doc_id, n, form, case when form <> 'plain' then length(pre) end::bigint prefix_chars, case when form <> 'plain' then length(mid) end::bigint middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
         else '<S>' || suf || '<P>' || pre || '<M>' || mid end) output_sha256,
  sha256(t) restored_sha256 from p
"""
