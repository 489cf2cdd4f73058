from corpus_pipeline import STAGES, best_fit_packing, run
from tests.llm import data


def test_stages_keep_the_columns_and_clean_documents(spark, tmp_path):
    path = data.write(spark, tmp_path, data.frame(spark))
    docs = spark.read.parquet(f"{path}/documents.parquet")
    names = docs.columns
    seen = [sorted(r["doc_id"] for r in docs.collect())]
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = stage(spark, docs, path)
        assert docs.columns == names
        docs.write.parquet(f"{path}/stage{k}")
        docs = spark.read.parquet(f"{path}/stage{k}")
        seen.append(sorted(r["doc_id"] for r in docs.collect()))
        assert set(seen[-1]) <= set(seen[-2])
    # Clean texts come through; copies, junk and texts without words do not.
    assert {0, 7, 8, 9} <= set(seen[-1]) and not {1, 13, 14, 19, 28} & set(seen[-1])
    assert not any("@mail" in r["text"] for r in docs.collect())
    packed = best_fit_packing(spark, docs, path).toPandas()
    assert set(packed["doc_id"]) == set(seen[-1])
    whole = run(spark, path).toPandas()
    assert sorted(whole["ids_crc32"]) == sorted(packed["ids_crc32"])


def test_pipeline_of_an_empty_table(spark, tmp_path):
    assert run(spark, data.write(spark, tmp_path, data.empty(spark))).count() == 0


def test_each_stage_equals_brute_force_on_its_own_input(spark, tmp_path):
    import duckdb

    from inkspan.llm import quality, tokens
    from tests.llm.test_dedup import brute, lines_of, shingles
    from tests.llm.test_text_models import base
    from tests.llm.test_tokens_and_packing import rows_of

    path = data.write(spark, tmp_path, data.frame(spark))
    texts = {d: t for d, t, *_ in data.rows()}
    stages, docs = dict(STAGES), spark.read.parquet(f"{path}/documents.parquet")

    def step(name):
        stages[name](spark, docs, path).write.parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{path}/documents.parquet/*.parquet'")
    kept = {r[0] for r in c.sql(f"select doc_id from ({quality.SQL}) where kept").fetchall()}
    docs = step("quality_rules")
    texts = {d: t for d, t in texts.items() if d in kept}
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == texts

    first = {}
    for d, i, x in sorted((d, i, x) for d, t in texts.items() for i, x in lines_of(t)):
        first.setdefault(x, (d, i))
    stands = brute({first[x]: {x} if len(x) < 8 else {x[k : k + 8] for k in range(len(x) - 7)} for x in first})
    want = {}
    for d, t in texts.items():
        gone = {i for i, x in lines_of(t) if stands[first[x]] != (d, i)}
        left = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
        if not gone or lines_of(left):
            want[d] = left
    docs = step("line_dedup")
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == want

    stands = brute({d: shingles(t, 5) for d, t in want.items()})
    docs = step("near_dedup")
    want = {d: t for d, t in want.items() if stands[d] == d}
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == want

    docs = step("pii_redaction")
    got = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(got) == set(want) and not any(base(t) for t in got.values())
    assert all(got[d] == t for d, t in want.items() if not any(x in t for x in "0123456789@(["))

    encode = tokens.Encoder()
    packed = step("best_fit_packing").collect()
    lengths = {d: len(encode(*rows_of([t]), 1)[0]) for d, t in got.items()}
    assert {d: sum(r["length"] for r in packed if r["doc_id"] == d) for d in got} == lengths and len({r["sequence_id"] for r in packed}) >= -(-sum(lengths.values()) // 4096)
