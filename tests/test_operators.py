"""Selectors, interval joins, ranks and summaries on small tables."""

import random
from bisect import bisect_left, bisect_right

import pytest
from pyspark.sql import functions as F

from lexmill.operators import html, intervals, ranking, selectors, summaries


def test_selectors(spark):
    page = """<div id="a" class="x y"><p class="x">1<b>2</b></p><p lang="ko-KR">3</p><div class="x"><p title="t u">4</p><ul><li>5</li><li class="z">6<p>7</p></li></ul></div></div><p>8</p><p class="x">9</p>"""
    df = spark.createDataFrame([(page,), (None,), ("",)], "h string").select(html.parse(F.col("h")).alias("nodes"))
    #       0 div#a, 1 p.x, 2 b, 3 p[lang], 4 div.x, 5 p[title], 6 ul, 7 li, 8 li.z, 9 p, 10 p, 11 p.x
    want = {
        "*": list(range(12)), "p": [1, 3, 5, 9, 10, 11], ".x": [0, 1, 4, 11], "p.x": [1, 11], "#a": [0], "div#a.y > p": [1, 3], "div p": [1, 3, 5, 9], ".x .x p": [5, 9], "div > div > p": [5],
        "p + p": [3, 11], "p ~ p": [3, 11], "p + div": [4], "p ~ div": [4], "li p, b": [2, 9], "b, p.x, .x": [0, 1, 2, 4, 11], "[title]": [5], "[title~=u]": [5], "[title=u]": [], '[lang^="ko"]': [3], "[lang$=KR]": [3], "[lang*='-']": [3],
        "li:first-child": [7], "p:first-child": [1, 5, 9], "ul li:first-child + .z": [8], "[class*='']": [], "q": [], "div ul > p": [],
    }
    rows = df.select(*(F.transform(selectors.css(F.col("nodes"), s), lambda n: n["ord"]).alias(str(i)) for i, s in enumerate(want))).collect()
    for s, got in zip(want, rows[0], strict=True):
        assert got == want[s], s
    assert all(x == [] for r in rows[1:] for x in r)
    texts = df.select(selectors.text_from(F.col("nodes"), ".x p").alias("t"), selectors.rich_text(F.col("nodes"), "li").alias("r"), selectors.rich_text(F.col("nodes"), ".x > *").alias("all")).first()
    assert tuple(texts) == ("1 3 4 7", "5 67", "12 2 3 4 567 4 567")
    for bad in ("p..x", "p > > b", "", "p[", "a !"):
        with pytest.raises(ValueError, match="selector"):
            selectors.css(F.col("nodes"), bad)


def test_readiness(spark):
    listed = '<div id="resultTableDiv"><a onclick="lsReturnSearch(1)">x</a></div>'
    detail = lambda head, n: f'<h2>{head}</h2><div id="conScroll">{"가" * n}</div>'
    rows = [(listed, True, False), (listed.replace("lsReturn", "other"), False, False), (listed.replace("resultTableDiv", "b"), False, False), (detail("제목", 51), False, True), (detail("제목", 50), False, False), (detail(" 제 ", 90), False, False), ("", False, False), (None, False, False)]
    df = spark.createDataFrame([(r[0],) for r in rows], "h string").select(html.parse(F.col("h")).alias("n"))
    got = df.select(selectors.list_ready(F.col("n"), "lsReturnSearch"), selectors.detail_ready(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [r[1:] for r in rows]


@pytest.mark.parametrize("slice_rows", [20_000, 7])
def test_interval_join(spark, slice_rows):
    rng = random.Random(5)

    def some(n, seed):
        r = random.Random(seed)
        rows = [(i, r.choice("kl"), (s := r.randrange(-500, 500)), s + r.choice([0, 1, 1, 3, 20, 400, 100_000])) for i in range(n)]
        return rows + [(n + i, "k", 7, 9) for i in range(40)] + [(n + 40, "k", None, 5), (n + 41, None, 0, 10), (n + 42, "k", 10, 3)]

    a, b = some(150, 1), some(120, 2)
    left, right = (spark.createDataFrame(x, "id long, k string, s long, e long") for x in (a, b))
    for keys, unit in (([], 4), (["k"], 1), (["k"], 1000)):
        met = intervals.overlaps(left, right, ("s", "e"), ("s", "e"), unit, keys, slice_rows)
        got = sorted((r.left.id, r.right.id) for r in met.collect())
        ok = lambda x, y: None not in (x[2], x[3], y[2], y[3]) and x[2] < x[3] and y[2] < y[3] and x[2] < y[3] and y[2] < x[3]
        assert got == sorted((x[0], y[0]) for x in a for y in b if ok(x, y) and (not keys or (x[1] and x[1] == y[1])))
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan
    points = spark.createDataFrame([(i, rng.randrange(-600, 600)) for i in range(200)], "p long, at long")
    got = sorted((r.left.p, r.right.id) for r in intervals.holders(points, right, "at", ("s", "e"), 8).collect())
    assert got == sorted((p, y[0]) for p, at in ((r.p, r.at) for r in points.collect()) for y in b if None not in (y[2], y[3]) and y[2] <= at < y[3])
    assert intervals.overlaps(left.limit(0), right, ("s", "e"), ("s", "e"), 4).count() == 0


def test_ranks(spark):
    rng = random.Random(6)
    values = [rng.choice([1.5, 2.5, 2.5, 2.5, 9.0, -1.0, rng.random()]) for _ in range(800)] + [2.5] * 400
    order = sorted(values)
    got = ranking.ranked(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v double").repartition(6), "v").collect()
    dense = {v: k + 1 for k, v in enumerate(sorted(set(values)))}
    n = len(values)
    want = {i: (bisect_left(order, v) + 1, dense[v], bisect_left(order, v) / (n - 1), bisect_right(order, v) / n) for i, v in enumerate(values)}
    assert {r.i: (r["rank"], r.dense_rank, r.percent_rank, r.cume_dist) for r in got} == want
    nulls = ranking.ranked(spark.createDataFrame([(None,), (3,), (None,)], "v int"), "v").collect()
    assert sorted((str(r.v), r["rank"], r.dense_rank, r.percent_rank) for r in nulls) == [("3", 3, 2, 1.0), ("None", 1, 1, 0.0), ("None", 1, 1, 0.0)]
    assert ranking.ranked(spark.createDataFrame([(4,)], "v int"), "v").first()["percent_rank"] == 0.0 and ranking.ranked(spark.createDataFrame([], "v int"), "v").count() == 0


def test_merged_summaries_stay_within_their_bounds(spark):
    df = spark.range(200_000).select((F.col("id") % 40).alias("day"), F.pmod(F.xxhash64("id"), F.lit(50_000)).alias("user"), F.sqrt("id").alias("value"))
    stored = summaries.summarised(df, ["day"], "user", "value")
    one = summaries.merged(stored, []).select("n", "least", summaries.distinct_count(F.col("users")).alias("u"), *(summaries.quantile(F.col("values"), q).alias(f"q{i}") for i, q in enumerate((0.1, 0.5, 0.9))), summaries.rank_of(F.col("values"), F.lit(200.0)).alias("r")).first()
    exact = df.agg(F.count_distinct("user")).first()[0]
    assert one.n == 200_000 and one.least == 0.0 and abs(one.u - exact) < 0.025 * exact
    assert all(abs(x * x / 200_000 - q) < 0.0165 for x, q in ((one.q0, 0.1), (one.q1, 0.5), (one.q2, 0.9))) and abs(one.r - 0.2) < 0.0165
    rolled = summaries.merged(stored, ["day"], rollup=True)
    assert rolled.count() == 41 and rolled.where("day IS NULL").first()["n"] == 200_000


def test_interval_rows_are_shuffled_once_and_to_few_levels(spark):
    unit = 60_000_000
    spans = [(i, i * unit, i * unit + unit * 2**k + d) for i, (k, d) in enumerate((k, d) for k in range(13) for d in (-1, 0, 1))] + [(99, 0, 2**62), (100, -5, 2**61)]
    right = spark.createDataFrame(spans, "id long, s long, e long")
    assert intervals._levels(intervals._levelled(right.where("id < 99"), "right", "s", "e", unit), "right") == [0, 3, 6, 9, 12, 15]
    points = spark.createDataFrame([(i, i * unit // 7) for i in range(600)], "p long, at long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = intervals.holders(points, right, "at", ("s", "e"), unit)
        lines = met._jdf.queryExecution().executedPlan().toString().splitlines()
        assert sorted((r.left.p, r.right.id) for r in met.collect()) == sorted((p, i) for p in range(600) for i, s, e in spans if s <= p * unit // 7 < e)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    by = [(x, below) for x, below in zip(lines, lines[1:]) if "Exchange hashpartitioning" in x]
    assert sum("slice" in x for x, _ in by) == 4  # two sides of two joins
    assert all("slice" in x or "HashAggregate" in below for x, below in by)  # the others hold counts


def test_overlaps_shuffle_each_side_once_whatever_the_keys(spark):
    left = spark.createDataFrame([(i, "ab"[i % 2], i * 10, i * 10 + 3**(i % 12)) for i in range(300)], "id long, k string, s long, e long")
    right = spark.createDataFrame([(i, "abc"[i % 3], i * 7, i * 7 + 2**(i % 18)) for i in range(300)], "id long, k string, s long, e long")
    met = intervals.overlaps(left, right, ("s", "e"), ("s", "e"), 8, ["k"], 5)
    pairs = sorted((r.left.id, r.right.id) for r in met.collect())
    a, b = left.collect(), right.collect()
    assert pairs == sorted((x.id, y.id) for x in a for y in b if x.k == y.k and x.s < y.e and y.s < x.e)
    lines = met._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert sum("Join Inner" in x for x in lines) == 2 and sum("Join LeftOuter" in x and "rightHint=(strategy=broadcast)" in x for x in lines) == 4
