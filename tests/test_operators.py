"""Operators against brute force on small relations."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import rows
from occrisk.operators import keyed, ranking, relations
from occrisk.operators.expand import explode_codes
from occrisk.sources import notices


@pytest.fixture(scope="module")
def bonds():
    """Random (occupation, class, weight) rows; one occupation holds a third of them."""
    rng = random.Random(7)
    occupations = ["hot"] * 5 + [f"o{i}" for i in range(10)]
    return [(rng.choice(occupations), f"c{rng.randrange(8)}", rng.randrange(1, 5)) for _ in range(600)]


@pytest.mark.parametrize("mode", ["max_row", "sum"])
def test_dominant_key(spark, bonds, mode):
    weight = defaultdict(int)
    for occupation, klass, w in bonds:
        old = weight[occupation, klass]
        weight[occupation, klass] = max(old, w) if mode == "max_row" else old + w
    want = {}
    for (occupation, klass), w in sorted(weight.items()):
        if occupation not in want or w > want[occupation][1]:
            want[occupation] = (klass, w)
    df = spark.createDataFrame(bonds + [(None, "c0", 9), ("o1", None, 99)], "k string, p string, w bigint")
    got = {r["k"]: (r["p"], r["weight"]) for r in keyed.dominant_key(df, "k", "p", "w", mode).collect()}
    assert got == want


def test_attribution_drops_unmapped(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    mapping = spark.createDataFrame([("a", "X")], "k string, p string")
    assert rows(keyed.attribute(df, mapping, "k", "p")) == [("a", 1, "X")]


def test_first_per_key_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("a", 1, "y"), ("b", 5, "q")], "k string, o int, v string")
    assert rows(keyed.first_per_key(df, ["k"], [F.col("o")], ["v"])) == [("a", "y"), ("b", "q")]


def test_modes_keep_nulls_in_the_total(spark, bonds):
    data = [(k, p if i % 4 else None, "s") for i, (k, p, _) in enumerate(bonds)] + [("empty", None, None)]
    df = spark.createDataFrame(data, "k string, p string, s string")
    got = {
        r["k"]: (r["n"], r["p"] and tuple(r["p"]), r["s"] and tuple(r["s"]))
        for r in keyed.modes_per_group(df, "k", ["p", "s"], {"n": F.lit(1).cast("bigint")}).collect()
    }
    for key in {k for k, _, _ in data}:
        group = [(p, s) for k, p, s in data if k == key]
        best = []
        for i in (0, 1):
            counted = Counter(g[i] for g in group if g[i] is not None)
            best.append(min(((-n, v) for v, n in counted.items()), default=None))
        want = (len(group), *[b and (b[1], -b[0]) for b in best])
        assert got[key] == want


def test_global_rank_shares_ties_and_leaves_gaps(spark):
    df = spark.createDataFrame([("a", 5), ("b", 9), ("c", 5), ("d", 1)], "k string, v bigint")
    assert rows(ranking.global_rank(df, "v", "r").select("k", "r")) == [("a", 2), ("b", 1), ("c", 2), ("d", 4)]


def test_rank_in_group_of_a_hot_group(spark):
    """Ties, equal category prefixes and short codes in one group of many codes."""
    rng = random.Random(3)
    codes = sorted({"".join(rng.choice("ABC01.") for _ in range(rng.randrange(1, 7))) for _ in range(900)})
    data = [("hot", c, rng.choice([1, 1, 1, 2, 3, 50])) for c in codes] + [("cold", "A", 1), ("cold", "AA", 1)]
    df = spark.createDataFrame(data, "k string, code string, n bigint")
    ranked = ranking.rank_in_group(df, ["k"], "n", "code", "r", total="t").collect()
    got = {(r["k"], r["code"]): r["r"] for r in ranked}
    assert {(r["k"], r["t"]) for r in ranked} == {(k, sum(n for g, _, n in data if g == k)) for k in ("hot", "cold")}
    want = {}
    for key in ("hot", "cold"):
        group = sorted((-n, c) for k, c, n in data if k == key)
        want |= {(key, c): i for i, (_, c) in enumerate(group, 1)}
    assert got == want


def test_ranks_spread_any_group(spark):
    """One group, one count, one prefix: the rows still lie in ranges of similar size."""
    df = spark.range(40_000).selectExpr("'k' as k", "'J18' || lpad(cast(id as string), 6, '0') as code", "1 as n")
    sizes = [r["count"] for r in ranking._ranged(df, ["k", F.desc("n"), "code"]).groupBy("_part").count().collect()]
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 2 * min(sizes)
    ranked = ranking.rank_in_group(df, ["k"], "n", "code", "r", total="t")
    assert ranked.filter("r <> cast(substr(code, 4) as bigint) + 1 or t <> 40000").isEmpty()
    assert ranking.global_rank(spark.range(10_000), "id", "r").filter("r <> 10000 - id").isEmpty()


def test_nested_top_n(spark, bonds):
    cells = Counter((k, p, w) for k, p, w in bonds)
    data = [(p, k, str(w), n) for (k, p, w), n in cells.items()]
    df = spark.createDataFrame(data, "o string, i string, l string, n bigint")
    got = {
        (r["o"], r["i"], r["l"]): (r["ro"], r["ri"])
        for r in ranking.nested_top_n(df, "o", "i", "l", "n", 3, 2, "ro", "ri").collect()
    }
    want = {}
    for outer in {d[0] for d in data}:
        totals = Counter()
        for o, i, _, n in data:
            if o == outer:
                totals[i] += n
        for ro, (inner, _) in enumerate(sorted(totals.items(), key=lambda t: (-t[1], t[0]))[:3], 1):
            leaves = sorted(((-n, leaf) for o, i, leaf, n in data if (o, i) == (outer, inner)))[:2]
            for ri, (_, leaf) in enumerate(leaves, 1):
                want[outer, inner, leaf] = (ro, ri)
    assert got == want


def test_top_n_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = ranking.top_n(df, ["k"], [F.desc("id")], 2, "r")
    assert plan._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


@pytest.mark.parametrize(
    "right, want",
    [([], ["a", "b", None]), (["a"], ["b"]), (["a", None], []), (["z"], ["a", "b"])],
)
def test_null_aware_anti(spark, right, want):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    other = spark.createDataFrame([(v,) for v in right], "x string")
    got = [r[0] for r in relations.null_aware_anti(left, F.col("k"), other, "x").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    left.createOrReplaceTempView("l")
    other.createOrReplaceTempView("o")
    sql = [r[0] for r in spark.sql("select k from l where k not in (select x from o)").collect()]
    assert sorted(got, key=str) == sorted(sql, key=str)


def test_year_intersection(spark):
    a = spark.createDataFrame([(2018,), (2025,), (None,)], "ano int")
    b = spark.createDataFrame([(2020,), (2030,)], "ano int")
    far = spark.createDataFrame([(2040,)], "ano int")
    years = spark.range(2015, 2045).select(F.col("id").cast("int").alias("ano"))
    kept = years.filter(F.col("ano").between(*relations.year_intersection(a, b)))
    assert [r[0] for r in kept.collect()] == list(range(2020, 2026))
    assert years.filter(F.col("ano").between(*relations.year_intersection(a, far))).count() == 0


def test_prefix_fan_out(spark):
    df = spark.createDataFrame([("86305",), ("86306",), ("86305",), ("11111",)], "c string")
    assert rows(relations.prefix_fan_out(df, "c", 4)) == [("8630", 2)]


def test_match_rate_and_null_profile(spark):
    counted = spark.createDataFrame([("a", 3), ("x", 1), (None, 4)], "c string, n bigint")
    parent = spark.createDataFrame([("a",), ("a",), ("b",)], "p string")
    assert rows(relations.match_rate(counted, "c", "n", parent, "p")) == [(8, 4, 3, 75.0)]
    df = spark.createDataFrame([("a", None), ("b", None), (None, None), ("c", "d")], "x string, y string")
    assert rows(relations.null_profile(df, ["x", "y"])) == [(4, "x", 1, 25.0), (4, "y", 3, 75.0)]


def test_explode_codes(spark):
    df = spark.createDataFrame(
        [(1, "*A00", None, "*I10X*E149* *"), (2, " ", "*B", None)], "id int, a string, b string, m string"
    )
    got = rows(explode_codes(df, {"a": "A", "b": "B"}, {"m": "M"}, "*", "line", "code", ["id"]))
    assert got == [(1, "A", "*A00"), (1, "M", "E149"), (1, "M", "I10X"), (2, "B", "*B")]


def test_fixture_fails_every_source_predicate(layers):
    """Each predicate of the sources drops rows that all others keep, and every notice column is filled."""
    raw, _ = layers
    deaths, bonds = raw["sim_microdados"], raw["rais_microdados"]
    known, years = "ocupacao is not null", "ano between 1900 and 2100"
    for others, broken in [
        (f"{known} and {years}", "sigla_uf <> 'SP'"),
        (f"sigla_uf = 'SP' and {known}", f"not ({years})"),
        (f"sigla_uf = 'SP' and {years}", f"not ({known})"),
    ]:
        assert not deaths.filter(others).filter(broken).isEmpty()
    for others, broken in [("vinculo_ativo_3112 = '1'", f"not ({years})"), (years, "vinculo_ativo_3112 <> '1'")]:
        assert not bonds.filter(others).filter(broken).isEmpty()
    unified = notices.unify(raw["landed_records"], notices.manifest(raw["landed_headers"]))
    filled = unified.groupBy().agg(*[F.count(c).alias(c) for c in notices.NOTICE_COLUMNS]).first()
    assert all(filled[c] > 0 for c in notices.NOTICE_COLUMNS)
