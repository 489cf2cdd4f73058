"""What is made of a page is made once: before a plain explode Spark tests an array's size, and would make it for that too."""

import pytest

from inkspan.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["j19_hough_votes", "j19_ruled_lines", "j19_page_separators", "w01_segment_by_tree"])
def test_no_array_is_made_for_its_size(spark, name):
    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    filters = [x for x in plan.split("\n") if "Filter" in x]
    assert not any("lambda" in x for x in filters)
