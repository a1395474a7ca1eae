from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sieveline.llm.components import components


def union_find(pairs):
    parent = {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        for x in (a, b):
            if x is not None:
                parent.setdefault(x, x)
        if a is not None and b is not None:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in parent}


def run(spark, pairs, **kw):
    df = spark.createDataFrame(pairs, "a string, b string")
    return {r.node: r["group"] for r in components(df, "a", "b", "node", "group", **kw).collect()}


def test_chain_star_and_dirty_pairs(spark):
    chain = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(40)]
    star = [("hub", f"leaf{i}") for i in range(30)]
    dirty = [("x", None), (None, "y"), (None, None), ("z", "z"), ("q", "p"), ("p", "q"), ("p", "q")]
    pairs = chain + star + dirty
    assert run(spark, pairs, hot_degree=7) == union_find(pairs)


def test_no_pairs(spark):
    assert run(spark, []) == {}


def test_extra_columns_with_clashing_names(spark):
    df = spark.createDataFrame([("a", "b", "k", 1)], "a string, b string, group string, u int")
    assert {r.node: r["group"] for r in components(df, "a", "b", "node", "group").collect()} == {"a": "a", "b": "a"}


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcdefghijkl"), st.sampled_from("abcdefghijkl")), max_size=12))
def test_random_graphs(spark, pairs):
    assert run(spark, pairs) == union_find(pairs)
