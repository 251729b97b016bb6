"""A closure is whole or an error."""

import pytest

from folioloom.operators import packages


def test_closure_is_never_cut(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(4)], "src int, dst int")
    root = spark.createDataFrame([(0,)], "root int")
    assert sorted(r["node"] for r in packages.closure(edges, root, rounds=4).collect()) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError, match="over 3 steps"):
        packages.closure(edges, root, rounds=3)
