"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one long whose bit i
says that rule i failed. A policy is a named, versioned set of rules, so applying or changing a policy is
a bitwise AND over stored longs, and an ablation counts, for each rule of a policy, the documents that no
other rule of it rejects: one pass of conditional sums, without reading a text again.

DataFrame functions only. A null text has no words; an empty table gives an empty ledger; documents
with equal texts get equal rows; further columns of the input are kept, and a clashing name is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.llm.common import WS, documents, n_words

#: Bit by rule. Bits are never reused: stored ledgers stay readable.
RULES = ("too_few_words", "repeated_words", "symbols", "duplicate_lines", "shouting", "word_length", "stretched")
#: Versions of the policy; `v1` is what the query and the pipeline apply.
POLICIES = {
    "base": ("too_few_words", "repeated_words"),
    "v1": ("too_few_words", "repeated_words", "symbols", "duplicate_lines", "shouting", "word_length", "stretched"),
}
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_text_lines", "n_upper", "n_letters", "n_marks")


def _count(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more. Distinct hashes prove distinct windows, so
    only texts with a repeat sort theirs; equality is then judged on the words themselves."""

    def covered(ws: Column) -> Column:
        windows = F.sort_array(F.transform(F.sequence(F.lit(1), F.size(ws) - 2), lambda i: F.struct(F.concat_ws(" ", F.slice(ws, i, 3)).alias("w"), i.alias("i"))))

        def marks(s: Column) -> Column:
            at = lambda j: F.get(s, j)["w"]  # noqa: E731  null beyond either end
            hit = F.filter(F.transform(s, lambda x, j: F.when(x["w"].eqNullSafe(at(j - 1)) | x["w"].eqNullSafe(at(j + 1)), x["i"])), lambda x: x.isNotNull())
            return F.size(F.array_distinct(F.flatten(F.transform(hit, lambda i: F.array(i, i + 1, i + 2)))))

        return F.get(F.transform(F.array(windows), marks), 0)

    def body(ws: Column) -> Column:
        n = F.size(ws)
        at = lambda i: F.get(ws, i)
        hashes = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2)))
        return F.when(n < 3, 0).when(F.size(F.array_distinct(hashes)) == n - 2, 0).otherwise(covered(ws))

    return F.get(F.transform(F.array(words), body), 0)


def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """df with the measurements and `failed_rules` (a long of failure bits). A column of df that has the name of one
    gives way to it; `apply_quality` keeps all of df's. Each row is judged by itself; a null text has no words."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.translate(x, WS, "")) > 0)
    out = df.withColumns(
        {
            "__words": n_words(t),
            "__lines": lines,
            "word_chars": F.length(F.translate(t, WS, "")).cast("long"),
            "n_symbols": _count(t, SYMBOLS),
            "n_marks": _count(t, "!"),
            "n_letters": F.length(F.regexp_replace(t, r"[^\p{L}]+", "")).cast("long"),
            "n_upper": F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")).cast("long"),
        }
    )
    out = out.withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "n_text_lines": F.size("__lines").cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "n_repeat_words": _repeat_words(F.col("__words")).cast("long"),
        }
    ).drop("__words", "__lines")
    c = F.col
    failures = {
        "too_few_words": c("n_words") < 50,
        "repeated_words": 100 * c("n_repeat_words") > 50 * c("n_words"),
        # Marks outside prose: more than half a mark a word.
        "symbols": 2 * c("n_symbols") > c("n_words"),
        "duplicate_lines": 2 * c("n_dup_lines") > c("n_text_lines"),
        "shouting": (c("n_letters") > 0) & (2 * c("n_upper") > c("n_letters")),
        "word_length": (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 25 * c("n_words")),
        "stretched": 2 * c("n_marks") > c("n_words"),
    }
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(failures[rule], F.lit(1 << i)).otherwise(0).cast("long"))
    return out.withColumn("failed_rules", bits)


def mask(policy: str | tuple[str, ...]) -> int:
    return sum(1 << RULES.index(r) for r in (POLICIES[policy] if isinstance(policy, str) else policy))


def passes(policy: str | tuple[str, ...], bits: str = "failed_rules") -> Column:
    return F.col(bits).bitwiseAND(F.lit(mask(policy))) == 0


def ablation(ledgers: DataFrame, policy: str = "v1", bits: str = "failed_rules") -> DataFrame:
    """For each rule of a policy: documents that fail it, and those that it alone rejects (kept without it).
    One aggregation of conditional counts over the bits."""
    m = mask(policy)
    rules = POLICIES[policy]
    hit = F.col(bits).bitwiseAND(F.lit(m))
    sums = [F.count_if(F.col(bits).bitwiseAND(F.lit(mask((r,)))) != 0).alias(f"f_{r}") for r in rules]
    sums += [F.count_if(hit == mask((r,))).alias(f"a_{r}") for r in rules]
    row = ledgers.agg(F.count("*").alias("n"), F.count_if(hit != 0).alias("rejected"), *sums)
    each = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"f_{r}").alias("failed"), F.col(f"a_{r}").alias("only_this")) for r in rules])
    return row.select(F.lit(policy).alias("policy"), "n", "rejected", F.explode(each).alias("e")).select("policy", "n", "rejected", "e.*")


def apply_quality(df: DataFrame, policy: str = "v1", text: str = "text") -> DataFrame:
    """Rows of df that the policy keeps, with df's columns."""
    own = [F.col("_row." + c).alias(c) for c in df.columns]
    wide = ledger(df.select(F.struct("*").alias("_row"), F.col(text).alias("_text")), "_text")
    return wide.filter(passes(policy)).select(*own)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents under policy v1."""
    out = ledger(documents(spark, sf_dir).select("doc_id", "text"))
    failed = ~passes("base")
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & passes("v1")).alias("kept"), "failed_rules"
    )


#: The same rows from DuckDB. Words and lines as lists; windows by position, one document at a time.
SQL = r"""
with d as (select doc_id, coalesce(text, '') t from documents),
w as (select doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) ls from d),
win as (select doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] k from (select doc_id, ws, unnest(range(1, len(ws) - 1)) i from w)),
rep as (select doc_id, i, count(*) over (partition by doc_id, k) n from win),
cov as (select doc_id, count(distinct p) c from (select doc_id, unnest([i, i+1, i+2]) p from rep where n > 1) group by 1),
m as (select w.doc_id, len(ws)::bigint n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::bigint word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint n_symbols,
        (length(t) - length(replace(t, '!', '')))::bigint n_marks,
        length(regexp_replace(t, '[^\pL]+', '', 'g'))::bigint n_letters,
        length(regexp_replace(t, '[^\p{Lu}]+', '', 'g'))::bigint n_upper,
        len(ls)::bigint n_text_lines, (len(ls) - len(list_distinct(ls)))::bigint n_dup_lines, coalesce(c, 0)::bigint n_repeat_words
      from w left join cov using (doc_id)),
f as (select *, (n_words < 50)::int + 2 * (100 * n_repeat_words > 50 * n_words)::int + 4 * (2 * n_symbols > n_words)::int
        + 8 * (2 * n_dup_lines > n_text_lines)::int + 16 * (n_letters > 0 and 2 * n_upper > n_letters)::int
        + 32 * (word_chars < 2 * n_words or word_chars > 25 * n_words)::int + 64 * (2 * n_marks > n_words)::int as bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (bits & 3) <> 0 base_failed, bits = 0 kept, bits::bigint failed_rules from f
"""
