"""Hierarchies of any depth: paths, ancestors, cycles."""

import random

import pytest
from pyspark.sql import functions as F

from bramble.operators.hierarchy import ancestors, flatten_hierarchy, paths
from bramble.sources.tables import Tables
from conftest import SF_SMALL


def _frame(spark, rows):
    return spark.createDataFrame(rows, "id long, parent_id long, level_text string")


def test_twenty_levels_and_wide_parents(spark):
    rnd = random.Random(2)
    parent = {0: None, **{i: i - 1 for i in range(1, 21)}}  # a chain of 21 nodes
    parent.update({100 + i: 20 for i in range(50)})  # many children at its end
    parent.update({200 + i: rnd.choice([None, 3, 17, 110, 999]) for i in range(40)})  # 999 is no node
    rows = [(i, p, f"n{i}") for i, p in parent.items()]
    want = {}
    for i in parent:
        chain = [i]
        while parent.get(chain[-1]) in parent:
            chain.append(parent[chain[-1]])
        want[i] = (chain[-1], len(chain) - 1, " > ".join(f"n{k}" for k in reversed(chain)))
    h = _frame(spark, rows + [(0, None, "n0"), (5, 4, "n5")])  # repeated rows
    assert {r.id: (r.root_id, r.depth, r.path) for r in paths(h).collect()} == want
    pairs = ancestors(h).collect()
    assert len(pairs) == len({(r.node, r.ancestor) for r in pairs}) == sum(d for _, d, _ in want.values())


@pytest.mark.parametrize("length", [1, 2, 3, 7, 16])
def test_cycles_are_reported(spark, length):
    rows = [(i, (i + 1) % length, "c") for i in range(length)] + [(50, 0, "into"), (60, None, "root"), (61, 60, "child")]
    with pytest.raises(ValueError, match="cycle"):
        ancestors(_frame(spark, rows))


def test_three_levels_are_one_case(spark):
    fx = Tables(spark, SF_SMALL).fixtures
    wide = {(r.category_name, r.segment_name, r.style_name) for r in flatten_hierarchy(fx.product_hierarchy).collect()}
    deep = paths(fx.product_hierarchy, sep="|").where("depth = 2")
    assert {tuple(r.path.split("|")) for r in deep.collect()} == wide


def test_odd_rows(spark):
    h = _frame(spark, [(1, None, None), (2, 1, "b"), (None, 1, "x"), (None, None, None)])
    assert {(r.id, r.root_id, r.depth, r.path) for r in paths(h).collect()} == {(1, 1, 0, ""), (2, 1, 1, "b")}
    assert paths(h.where(F.lit(False))).count() == 0
