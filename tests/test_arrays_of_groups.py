"""Groups that Python sees are arrays of a row, many to a batch; a frame for each would cost more than its rows."""

import pytest

from inkspan.operators.relational import each_row
from inkspan.plans import registry
from inkspan.schemas import data_type

SF = "/root/testdata/sf0.001"
QUERIES = (
    "j14_contents_match", "j15_table_titles", "l01_document_markdown", "l01_document_pipeline", "l01_document_tree", "l01_whole_elements", "w08_stitched_paragraphs",
    "w10_chapter_names", "w11_repeated_chapters", "w12_title_levels", "w13_finished_titles", "w16_markdown_tree", "w18_cell_alignment",
)


@pytest.mark.parametrize("name", QUERIES)
def test_no_frame_per_group(spark, name):
    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in plan and "ArrowEvalPython" in plan


def test_each_row_over_several_steps(spark):
    double = each_row(lambda rows, k: [{"v": r["v"] * k} for r in rows], data_type("array<struct<v: int>>"), step=3)
    rows = [(i, None if i == 4 else [(j,) for j in range(i % 3)]) for i in range(10)]
    df = spark.createDataFrame(rows, "k int, a array<struct<v int>>".replace("v int", "v: int")).coalesce(1)
    got = dict(df.select("k", double("a", "k").alias("o")).collect())
    assert {k: None if o is None else [x["v"] for x in o] for k, o in got.items()} == {k: None if a is None else [v * k for (v,) in a] for k, a in rows}
    assert df.filter("k < 0").select(double("a", "k")).collect() == []


def test_lines_of_words_are_shuffled_before_words(spark):
    plan = registry.queries()["w07_merge_spans"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Generate") == 1


def test_a_page_of_spans_is_made_after_its_lines_have_met(spark):
    plan = registry.queries()["s13_structured_output"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
