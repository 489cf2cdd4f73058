import pandas as pd

from inkspan.operators import models
from inkspan.plans.document import convert
from inkspan.sources import files


def test_files_and_annotations(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.4 x")
    (tmp_path / ".hidden").write_bytes(b"x")
    (tmp_path / "b.txt").write_bytes(b"plain")
    assert {(r["name"], r["kind"]) for r in files.read_files(spark, str(tmp_path)).collect()} == {("a", "pdf"), ("b", "other")}
    p = tmp_path / "x.jsonl"
    p.write_text('{"filename":"f","split":"val","html":"<p>"}\n{"filename":"g","split":"train","html":"<q>"}\n')
    assert [tuple(r) for r in files.read_annotations(spark, str(p), "val").collect()] == [("f", "<p>")]


def test_large_files_are_listed_without_their_content(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name, head in (("sub/big one.pdf", b"%PDF-1.4"), ("100%25.gz", b"PK\x03\x04"), ("c.png", bytes.fromhex("89504E470D0A1A0A"))):
        with open(tmp_path / name, "wb") as f:
            f.write(head)
            if name != "c.png":
                f.truncate((1 << 31) + 5)  # more than a row holds
    (tmp_path / ".hidden").write_bytes(b"x")
    want = [("100%25", "zip", (1 << 31) + 5), ("big one", "pdf", (1 << 31) + 5), ("c", "png", 8)]
    assert sorted((r["name"], r["kind"], r["n_bytes"]) for r in files.list_files(spark, str(tmp_path)).collect()) == want
    every = files.list_files(spark, str(tmp_path), whole=-1)
    assert sorted((r["name"], r["kind"], r["n_bytes"]) for r in every.collect()) == want
    pages = files.load_pages(spark, str(tmp_path), lambda kind, n: 3 + n % 3, 1, 3, by_size=True)
    assert sorted((r["name"], r["page_id"]) for r in pages.collect()) == [("100%25", 1), ("100%25", 2), ("100%25", 3), ("big one", 1), ("big one", 2), ("big one", 3)]


def test_failures_are_rows(spark):
    df = spark.createDataFrame([("1", "good", None), ("2", "bad", None), ("3", None, "eHk="), ("4", None, None)], "file_id string, url string, file_content string")

    def fetcher(url):
        if url == "bad":
            raise ConnectionError
        return b"data"

    got = {r["file_id"]: (r["content"] and bytes(r["content"]), r["error_class"]) for r in files.fetch(df, fetcher).collect()}
    assert got == {"1": (b"data", None), "2": (None, "ConnectionError"), "3": (b"xy", None), "4": (None, "file_url")}
    objects = spark.createDataFrame([("kg/1", b"x")], "name string, content binary")
    assert files.upload(objects, lambda n, c: f"store/{n}").first()["url"] == "store/kg/1"
    docs = spark.createDataFrame([(1, b"ab")], "doc_id long, content binary")
    glyph = dict(page_id=0, x0=0.0, y0=0.0, x1=1.0, y1=1.0, font_name="f", font_size=1.0, font_weight=400, font_flags=0, rotation=0.0)
    assert files.scan_chars(docs, lambda b: [{**glyph, "char_idx": i, "char": chr(c)} for i, c in enumerate(b)]).count() == 2


def test_models_load_once_and_give_their_columns(spark):
    pages = spark.createDataFrame([(1, 0), (1, 1)], "doc_id long, page_id int")

    def predict(model, f):
        return pd.DataFrame([(d, p, 0, f"text {model}", 0.9, [[0.0, 0.0]] * 4) for d, p in zip(f["doc_id"], f["page_id"], strict=True)], columns=models.OUTPUTS["recognition"].names)

    assert [r["text"] for r in models.run_model(pages, "recognition", lambda: "m", predict).collect()] == ["text m"] * 2
    regions = spark.createDataFrame([(1, 0, 0, "x = y", 10), (1, 0, 1, "long text here", 10)], "doc_id long, page_id int, region_id int, text string, tokens int")
    found = spark.createDataFrame([(1, 0, 0, "x = y^2"), (1, 0, 1, "z")], "doc_id long, page_id int, region_id int, latex string")
    assert [(r["text"], r["replaced"]) for r in models.apply_formulas(found, regions).orderBy("region_id").collect()] == [("$$x = y^2$$", True), ("long text here", False)]
    assert models.repair_unicode(spark.createDataFrame([("é",)], "t string"), "t").first()["t"] == "é"


def test_document_pipeline(spark):
    lines, regions = [], []
    for p in range(3):
        for i, t in enumerate(["Running head", "A title" if p == 0 else "goes on here", ["first part of a", "and more of it", "last one."][p]]):
            lines.append((1, p, i, t, 0.0, 10.0 * i, 50.0, 10.0 * i + 8))
        regions += [(1, p, 0, "header", 0.0, 0.0, 60.0, 9.0), (1, p, 1, "doc_title" if p == 0 else "text", 0.0, 9.5, 60.0, 19.0), (1, p, 2, "text", 0.0, 19.5, 60.0, 30.0)]
    box = "x0 double, y0 double, x1 double, y1 double"
    toc = spark.createDataFrame([(1, 2, 0, 1, "a title"), (1, 2, 1, 1, "other")], "doc_id long, page_id int, ord int, level int, title string")
    made = convert(spark.createDataFrame(lines, f"doc_id long, page_id int, line_id int, line string, {box}"), spark.createDataFrame(regions, f"doc_id long, page_id int, region_id int, label string, {box}"), toc=toc)
    got = [(r["label"], r["text"], r["title_level"]) for r in made.elements.orderBy("global_index").collect()]
    md = made.markdown.first()["markdown"]
    assert got[0] == ("doc_title", "A title", 0) and "Running head" not in md and md.startswith("# A title")
    # A line on two of three pages is a running one.
    assert got[1:] == [("text", "first part of a and more of it last one.", -1)]
    assert [(r["language"], r["kind"]) for r in made.kinds.collect()] == [("garbage", "book")]
    ids = [r["global_index"] for r in made.elements.orderBy("global_index").collect()]
    assert [(r["id"], r["parent"]) for r in made.tree.orderBy("id").collect()] == [(ids[0], None), (ids[1], ids[0])]


def test_recognised_content_takes_the_place_of_lines(spark):
    box = "x0 double, y0 double, x1 double, y1 double"
    lines = spark.createDataFrame([(1, 0, 0, "a b", 0.0, 0.0, 50.0, 8.0), (1, 0, 1, "c d", 0.0, 10.0, 50.0, 18.0)], f"doc_id long, page_id int, line_id int, line string, {box}")
    regions = spark.createDataFrame([(1, 0, 0, "table", 0.0, 0.0, 60.0, 20.0)], f"doc_id long, page_id int, region_id int, label string, {box}")
    html = spark.createDataFrame([(1, 0, 0, "<table></table>")], "doc_id long, page_id int, region_id int, content string")
    assert [r["text"] for r in convert(lines, regions, html).elements.collect()] == ["<table></table>"]


def test_pages_of_files_in_a_range(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.4 five")
    (tmp_path / "b.png").write_bytes(bytes.fromhex("89504E470D0A"))
    pages = lambda *r: sorted((x["name"], x["page_id"]) for x in files.load_pages(spark, str(tmp_path), lambda kind, data: 5, *r).collect())
    assert pages() == [("a", i) for i in range(5)] + [("b", 0)] and pages(1, 2) == [("a", 1), ("a", 2)]


def test_models_of_one_seam_do_not_mix(spark):
    df = spark.createDataFrame([(1, 0)], "doc_id long, page_id int").coalesce(1)

    def predict(model, f):
        return pd.DataFrame([(d, p, 0, model, 0.9, [[0.0, 0.0]] * 4) for d, p in zip(f["doc_id"], f["page_id"], strict=True)], columns=models.OUTPUTS["recognition"].names)

    for name in (None, "first", "second"):
        assert models.run_model(df, "recognition", lambda name=name: f"m{name}", predict, name).first()["text"] == f"m{name}"


def test_text_is_mended():
    assert models.mended("cafÃ© naÃ¯ve â€œxâ€\x9d") == "café naïve “x”" and models.mended("ñó é plain") == "ñó é plain"
    assert models.mended("Ã\x83Â©") == "é"  # twice


def test_greedy_decoding():
    table = [[0, 5, 9, 1], [9, 9, 0, 1], [0, 0, 1, 9], [0, 0, 0, 9]]
    step = lambda seqs: [table[s[-1]] for s in seqs]
    assert models.greedy_decode(step, [[0], [1]], 5, 3) == [[0, 2, 3], [1, 0, 2, 3]]
    assert models.greedy_decode(step, [[0]], 4, 3, allowed=[1, 3], blocked=[3]) == [[0, 1, 1, 1]]
    assert models.greedy_decode(step, [[0, 1]], 2, 3) == [[0, 1]]


def test_scores_of_all_boxes_compete(spark):
    df = spark.createDataFrame([(1, 0, [0.9, 0.2]), (1, 1, [0.9, 0.5]), (2, 0, [0.1, 0.3])], "doc_id long, idx int, scores array<double>")
    got = [(r["doc_id"], r["idx"], r["label_id"], r["rank"]) for r in models.top_scores(df, ["doc_id"], "scores", 3).orderBy("doc_id", "rank").collect()]
    assert got == [(1, 0, 0, 1), (1, 1, 0, 2), (1, 1, 1, 3)]
