"""Rules over several tables, profiles from sketches, measures over several levels."""

import random
from collections import Counter

from pyspark.sql import functions as F

from strata.operators import profile as P
from strata.operators.integrity import Reference, Unique, orphan_keys, violations
from strata.plans import gold as G


def test_orphans_repeats_nulls_and_a_hot_key(spark):
    child = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"p{i % 7}", "x" if i % 2 else None) for i in range(90)] + [(5, None, "y"), (None, "p1", "y")],
                                  "id long, ref string, kind string")
    parent = spark.createDataFrame([(f"p{i}",) for i in range(5)] + [(None,), ("p1",)], "name string")
    ref = Reference(("ref",), "parents", ("name",))
    assert {r.ref for r in orphan_keys(child, parent, ref).collect()} == {"hot", "p5", "p6"}
    out = violations(child, [ref, Unique(("id",))], {"parents": parent})
    assert out.columns == ["id", "ref", "kind", "rejection_reason", "rejected_field"]
    rows = out.collect()
    reasons = Counter(r.rejection_reason for r in rows)
    bad = [i for i in range(90) if i % 3 == 0 or i % 7 in (5, 6)]
    assert reasons == {"ref: no existe en parents": len(bad), "id: clave repetida": 2}
    only = violations(child, [Reference(("ref",), "parents", ("name",), F.col("kind") == "x")], {"parents": parent})
    assert only.count() == sum(i % 2 for i in bad)
    assert violations(child.limit(0), [ref], {"parents": parent}).count() == 0


def test_composite_references(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "x long, y string")
    parent = spark.createDataFrame([(1, "a")], "px long, py string")
    rows = violations(child, [Reference(("x", "y"), "p", ("px", "py"))], {"p": parent}).collect()
    assert [(r.x, r.y, r.rejected_field) for r in rows] == [(1, "b", "x")]


def test_profile_within_its_error_whatever_the_order_of_batches(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "b", None, "c" * 3]), str(rng.randint(0, 4000)) if rng.random() < 0.9 else "n/a") for i in range(20_000)]
    df = spark.createDataFrame(rows, "id long, s string, n string")
    found = []
    for name, order in (("one", [0, 1, 2, 3]), ("two", [3, 1, 1, 0, 2, 3])):
        path = str(tmp_path / name)
        for b in order:
            P.store(spark, path, df.where(F.col("id") % 4 == b), ["id", "s", "n"], b)
        found.append({r.column: r.asDict() for r in P.read_profile(spark, path).collect()})
    for prof in found:
        for i, c in enumerate(("id", "s", "n")):
            values = [r[i] for r in rows if r[i] is not None]
            assert (prof[c]["rows"], prof[c]["nulls"]) == (20_000, 20_000 - len(values))
            assert (prof[c]["least"], prof[c]["greatest"]) == (min(map(str, values)), max(map(str, values)))
            assert abs(prof[c]["approx_distinct"] - len(set(values))) <= 3 * 1.04 / 2 ** (P.LG_K / 2) * len(set(values))
        numbers = sorted(float(r[2]) for r in rows if r[2] != "n/a")
        for q in P.QUANTILES:
            x = found[0]["n"][f"p{int(q * 100)}"]
            below, upto = sum(v < x for v in numbers) / len(numbers), sum(v <= x for v in numbers) / len(numbers)
            assert below - 0.0165 <= q <= upto + 0.0165
        top = Counter(r[1] for r in rows if r[1]).most_common(1)[0]
        assert (prof["s"]["top_value"], prof["s"]["top_count"]) == top and prof["s"]["p50"] is None
        assert (prof["n"]["top_value"], prof["n"]["top_count"]) == ("n/a", sum(r[2] == "n/a" for r in rows))
    assert found[0]["id"]["approx_distinct"] == found[1]["id"]["approx_distinct"]
    assert P.read_profile(spark, str(tmp_path / "none")) is None


def test_rollup_tells_totals_from_nulls_and_combines_first(spark):
    rows = [(2024, m, ch, 1, a, 0, 0, r, 10.0) for m in (1, 2) for ch in ("web", None) for a, r in ((1, 0), (0, 1), (0, 0))]
    df = spark.createDataFrame(rows, "year int, month int, channel string, " + ", ".join(f"{m} int" for m in G.SUMMABLE) + ", amount double")
    out = G.measure_rollup(df, [["year", "month"], ["channel"], []])
    got = {(r.year, r.month, r.channel, r.level): (r.transaction_count, r.reverse_transaction_count, float(r.amount), round(r.reverse_rate, 4)) for r in out.collect()}
    assert got == {(2024, 1, None, 1): (6, 2, 60.0, 0.3333), (2024, 2, None, 1): (6, 2, 60.0, 0.3333), (None, None, "web", 6): (6, 2, 60.0, 0.3333),
                   (None, None, None, 6): (6, 2, 60.0, 0.3333), (None, None, None, 7): (12, 4, 120.0, 0.3333)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.rindex("Aggregate")  # sums are expanded, not rows


def test_violations_evaluate_their_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    child = spark.createDataFrame([(i % 40, f"p{i % 7}") for i in range(50)], "id long, ref string").mapInArrow(look, "id long, ref string")
    parent = spark.createDataFrame([("p1",)], "name string")
    rules = [Reference(("ref",), "parents", ("name",)), Unique(("id",)), Reference(("id",), "self", ("id",))]
    reasons = Counter(r.rejection_reason for r in violations(child, rules, {"parents": parent, "self": child}).collect())
    assert reasons == {"ref: no existe en parents": sum(i % 7 != 1 for i in range(50)), "id: clave repetida": 20}
    assert seen.value == 50


def test_values_are_counted_as_their_own_type(spark):
    rows = [(0.0, 7, "x"), (-0.0, 7, None), (-0.0, None, "7"), (float("nan"), 8, "x"), (None, 8, "x")]
    df = spark.createDataFrame(rows, "d double, n long, s string")
    want = Counter((c, str(v) if v == v else "NaN") for r in rows for c, v in zip("dns", r) if v is not None)
    out = P.counts(df, ["d", "n", "s"])
    assert {(r.column, r.value): r.n for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan  # no row per cell
    assert {r.column: (r.nulls, r.least) for r in P.summarise(df.withColumn("e", F.lit(None).cast("string")), ["d", "e"]).collect()} == {"d": (1, "-0.0"), "e": (5, None)}
