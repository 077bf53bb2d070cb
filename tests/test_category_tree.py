"""Category trees of any depth."""

import pytest

from offerweave.sources import readers as rd


def test_deep_trees_and_cycles(spark):
    tree = lambda rows: spark.createDataFrame(rows, "id string, parent string, level string")
    deep = [("n0", None, "0")] + [(f"n{i}", f"n{i - 1}", "1") for i in range(1, 15)]
    assert [r.id for r in rd.leaf_categories(tree(deep)).collect()] == ["n14"]
    with pytest.raises(ValueError, match="levels"):
        rd.leaf_categories(tree(deep[:4]), 2)
    with pytest.raises(ValueError, match="below itself"):
        rd.leaf_categories(tree([("r", None, "0"), ("a", "r", "1"), ("b", "a", "1"), ("a", "b", "1")]))
