"""Small fixtures with nulls, empty and long texts, ties and repeated rows."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n))


def texts():
    rng = random.Random(4)
    base = words(rng, 120)
    passage = words(rng, 60)
    line = words(rng, 30)

    def edit(t, k):
        w = t.split()
        for _ in range(k):
            w[rng.randrange(len(w))] = words(rng, 1)
        return " ".join(w)

    out = [base, base, edit(base, 1), edit(base, 2), edit(base, 5), edit(base, 9), edit(base, 14)]
    out += [words(rng, 80) + " " + passage + " " + words(rng, 50) for _ in range(3)]
    out += [words(rng, 40) + "\n" + line + "\n" + words(rng, 20), line + "\n\n" + line, edit(line, 1) + "\n" + words(rng, 60)]
    out += [None, "", " \t\n ", "a", "One two", "one TWO", "Was. " * 200, "x" * 5000, words(rng, 4000)]
    out += [f"{words(rng, 10)} mail a.b-1@mail.example.com or +1 (274) 555-9629, 4111 1111 1111 1111 at 10.0.0.255 {words(rng, 30)}" for _ in range(4)]
    out += ["café naïve ÉCOLE ß straße\r\nend\x0b.", "日本語 テキスト 😀 123", "$$$ %%% ### " * 30, base.upper(), "1.2.3.4.5 999.1.1.1 +12 4111111111111112 a@b a@b.c@d.e"]
    return out


def rows():
    return [(i, t, ["en", "de", "fr", "es", None][i % 5], "s0" if i % 3 else None, len(t) if t is not None else None) for i, t in enumerate(texts())]


def odd_rows(at=1 << 62):
    """Repeated rows (equal, and of equal ids with other texts), rows without an id, and ids near the largest."""
    base = rows()
    again = [base[0], base[0], base[4], base[7], (2, base[8][1], "en", "s", None), (11, None, None, None, None)]
    far = [(at + d, t, *rest) for d, t, *rest in base[:12]] + [((1 << 63) - 1, base[7][1], "en", "s", 0), (-(1 << 63), base[20][1], "en", "s", 0)]
    return base + again + far + [(None, base[0][1], None, None, None), (None, None, None, None, None)]


def one_each(rows):
    """The text that stands for each id."""
    out = {}
    for d, t, *_ in rows:
        if d is not None and (d not in out or out[d] is None or (t is not None and t.encode() < out[d].encode())):
            out[d] = t
    return out


def frame(spark, extra=False):
    df = spark.createDataFrame(rows(), SCHEMA)
    if extra:  # clashing names
        for c in ("item", "bucket", "n", "a", "b", "_row", "hashes", "score", "piece", "_lines", "_doc", "_gone", "_cuts", "_taken", "_maybe", "_bucket", "_left", "_key"):
            df = df.selectExpr("*", f"1 as {c}")
    return df.repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def write(spark, tmp_path, df):
    path = str(tmp_path)
    df.write.mode("overwrite").parquet(f"{path}/documents.parquet")
    return path
