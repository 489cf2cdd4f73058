import hashlib
import re

from pyspark.sql import functions as F

from inkspan.llm import fim
from tests.llm import data

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
COLUMNS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plainly(doc_id, text):
    """n, form, prefix, middle, output of one row."""
    t = text or ""
    units = UNIT.findall(t)
    assert "".join(units) == t
    digest = sha(f"42:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, t
    pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 80:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def odd():
    more = [" \t lead and trail \n ", "<P>a b", "x <S> y", "a<M>", "< P> <S <M", "<P", "M> <", "a\x0bb\x0cc\rd", "😀 𝒳 y z   w", "word"]
    return data.odd_rows() + [(10_000 + 50 * i + k, t, None, None, 0) for i, t in enumerate(more) for k in range(12)]


def test_op12(spark, tmp_path):
    rows = odd()
    df = spark.createDataFrame(rows, data.SCHEMA).repartition(3)
    got = fim.op12_fill_in_middle(spark, data.write(spark, tmp_path, df))
    assert got.columns == COLUMNS
    want = []
    for d, t, *_ in rows:
        n, form, pre, mid, out = plainly(d, t)
        want.append((d, n, form, pre, mid, sha(out), sha(t or "")))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_general_form(spark):
    """Columns of the input are kept, clashing names among them; other rates; outputs themselves."""
    rows = odd()
    df = spark.createDataFrame(rows, data.SCHEMA)
    for c in ("_row", "_key", "_n", "_cuts", "_text", "_a", "_h0", "n", "form", "fim", "a.b"):
        df = df.withColumn(c, F.lit(1))
    out = fim.fill_in_middle(df.repartition(2), rate=50, spm=80)
    assert out.columns == [c for c in df.columns if c != "fim"] + ["fim"]
    got = sorted(((r["doc_id"], *r["fim"]) for r in out.collect()), key=str)
    assert got == sorted(((d, *plainly(d, t)[:2], *plainly(d, t)[2:]) for d, t, *_ in rows), key=str)
    all_cut = fim.fill_in_middle(spark.createDataFrame(rows, data.SCHEMA), rate=100, spm=0, seed=7)
    back = all_cut.select("text", "fim.form", fim.restored(F.col("fim.output"), F.col("fim.form")).alias("r")).collect()
    assert all(r["r"] == (r["text"] or "") for r in back)
    assert all(r["form"] == "psm" for r in back if r["text"] and not re.search("<[PSM]>", r["text"]))


def test_empty_table(spark, tmp_path):
    assert fim.op12_fill_in_middle(spark, data.write(spark, tmp_path, data.empty(spark))).collect() == []
