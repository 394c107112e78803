"""As-of join against a plain search of every fact's versions."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators.asof import as_of_join

FACTS, VERSIONS = "k string, j long, at long, x string, k0 string", "k string, j long, since long, seq long, v string, gone boolean"


def expected(facts, versions, how="left"):
    out = []
    for k, j, at, x, k0 in facts:
        mine = sorted((s, q, v, g) for a, b, s, q, v, g in versions if None not in (a, b, s, k, j, at) and (a, b) == (k, j) and s <= at)
        v = None if not mine or mine[-1][3] else mine[-1][2]
        known = bool(mine) and not mine[-1][3]
        if how == "left" or known:
            out.append((k, j, at, x, k0, v))
    return sorted(out, key=repr)


def got(spark, facts, versions, tmp_path, **kw):
    out = as_of_join(spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS), ["k", "j"], "at", "since", ["v"],
                     seq=F.col("seq"), deleted=F.col("gone"), prefix="then_", scratch=str(tmp_path / "s"), **kw)
    assert out.columns == ["k", "j", "at", "x", "k0", "then_v"]
    return sorted(map(tuple, out.collect()), key=repr)


@pytest.mark.parametrize("partitions,how", [(1, "left"), (7, "left"), (40, "inner")])
def test_equal_to_searching_every_fact(spark, tmp_path, partitions, how):
    rng = random.Random(partitions)
    keys = [("a", 1), ("a", 2), ("b", 1), (None, 1), ("c", None), ("d", 9)]
    facts = [(*rng.choice(keys), rng.choice([None, *range(60)]), f"f{i % 40}", None) for i in range(300)]  # repeated facts stay
    versions = [(*rng.choice(keys[:-1]), rng.choice([None, *range(60)]), i, f"v{i}", rng.random() < 0.2) for i in range(120)]
    assert got(spark, facts, versions, tmp_path, partitions=partitions, how=how) == expected(facts, versions, how)


def test_a_key_with_most_rows_spans_ranges_without_versions(spark, tmp_path):
    """Versions of the hot key lie in its first ranges only: later ranges take them from the frame."""
    facts = [("hot", 1, 10 + i, f"f{i}", None) for i in range(400)] + [("z", 1, 5, "x", None), ("a", 1, 5, "y", None)]
    versions = [("hot", 1, 3, 0, "old", False), ("hot", 1, 12, 1, "new", False), ("a", 1, 1, 0, "A", False)]
    assert got(spark, facts, versions, tmp_path, partitions=16) == expected(facts, versions)
    (tmp_path / "2").mkdir()
    versions += [("hot", 1, 30, 2, None, True)]  # and then deleted
    rows = got(spark, facts, versions, tmp_path / "2", partitions=16)
    assert rows == expected(facts, versions) and sum(r[5] is None for r in rows if r[0] == "hot") == 380


def test_empty_sides_and_no_pairs_are_built(spark, tmp_path):
    assert got(spark, [], [("a", 1, 1, 1, "v", False)], tmp_path) == []
    (tmp_path / "2").mkdir()
    assert got(spark, [("a", 1, 1, "x", None)], [], tmp_path / "2") == [("a", 1, 1, "x", None, None)]
    (tmp_path / "3").mkdir()
    df = as_of_join(spark.createDataFrame([("a", 1, 1, "x", None)], FACTS), spark.createDataFrame([("a", 1, 1, 1, "v", False)], VERSIONS),
                    ["k", "j"], "at", "since", ["v"], scratch=str(tmp_path / "3" / "s"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Inner" not in plan and "Cross" not in plan
    with pytest.raises(ValueError):
        as_of_join(df, df, ["k"], "at", "at", ["x"], how="outer")
