"""Groups that hold most rows: ranks, sums, ratios, crowded cells and long shapes."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from transit_engine.operators import presentation, serving
from transit_engine.operators.keyed import best_per_key
from transit_engine.operators.ranked import in_order
from transit_engine.operators.range_join import Reach, near_any, near_pairs

N = 20_000


def one_large_city(spark):
    """Nine tenths of the rows in one city, few distinct values, nulls among them."""
    city = F.when(F.col("id") % 10 > 0, "large").otherwise(F.concat(F.lit("c"), F.col("id") % 70))
    value = F.when(F.col("id") % 97 > 0, F.pmod(F.xxhash64("id"), F.lit(50)))
    return spark.range(N).select(city.alias("city"), value.alias("n"), F.col("id").cast("string").alias("name"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranks_and_sums_equal_the_window(spark):
    table = one_large_city(spark)
    ranked = in_order(table, ["city"], ["-n", "name"], "place", {"upto": F.coalesce("n", F.lit(0))}, stretches=8)
    table.createOrReplaceTempView("one_large_city")
    window = "OVER (PARTITION BY city ORDER BY n DESC NULLS LAST, name"
    expected = spark.sql(
        f"SELECT *, row_number() {window}) AS place, "
        f"sum(coalesce(n, 0)) {window} ROWS UNBOUNDED PRECEDING) AS upto FROM one_large_city"
    )
    names = ("city", "n", "name", "place", "upto")
    assert rows(ranked, *names) == rows(expected, *names)


def test_no_task_holds_a_city(spark):
    """The rows that a task of the last step works on: at most twice the median."""
    shares = presentation.share_of_total(one_large_city(spark), "n", ["-n", "name"], stretches=8)
    held = shares.groupBy(F.spark_partition_id()).count()
    stretches = in_order(one_large_city(spark), ["city"], ["-n", "name"], "place", stretches=8)
    text = plan(stretches)
    assert "hashpartitioning(city" in text and "_stretch" in text
    sizes = sorted(r["count"] for r in held.collect())
    # The window works on (city, stretch); no such group may hold more than its stretch.
    cut = one_large_city(spark).repartitionByRange(8, "city", F.col("n").desc_nulls_last(), "name")
    sizes = sorted(r["count"] for r in cut.groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]
    assert shares.where("city = 'large'").agg(F.max("share_end")).first()[0] == pytest.approx(1.0)


def test_shares_equal_the_window(spark):
    shares = presentation.share_of_total(one_large_city(spark), "n", ["-n", "name"], stretches=8)
    one_large_city(spark).createOrReplaceTempView("one_large_city")
    window = "sum(coalesce(n, 0)) OVER (PARTITION BY city"
    expected = spark.sql(f"""
        SELECT name, coalesce(n, 0) / {window}) AS share,
            {window} ORDER BY n DESC NULLS LAST, name ROWS UNBOUNDED PRECEDING) / {window}) AS share_end
        FROM one_large_city""")
    assert rows(shares, "name", F.round("share", 9), F.round("share_end", 9)) == rows(
        expected, "name", F.round("share", 9), F.round("share_end", 9)
    )


def test_limits_of_any_size(spark):
    table = one_large_city(spark)
    first = best_per_key(table, ["city"], ["-n", "name"], 5000, rank="place")
    assert first.where("city = 'large'").count() == 5000 and first.count() == 5000 + N // 10
    assert first.where("city = 'large'").agg(F.max("place")).first()[0] == 5000
    every = best_per_key(table, ["city"], ["-n", "name"], 1_000_000)
    assert every.count() == N
    text = plan(every)
    # Windows are over stretches of a city, never over a city.
    assert "_stretch" in text and "Window [row_number() windowspecdefinition(city#" in text
    for line in text.splitlines():
        if "windowspecdefinition" in line:
            assert "_stretch" in line
    same = best_per_key(table, ["city"], ["-n", "name"], 1000).select("name")
    assert rows(first.where("place <= 1000").select("name")) == rows(same)


def test_ratios_of_very_many_cities(spark):
    table = spark.range(60_000).select(
        F.concat(F.lit("c"), F.col("id") % 20_000).alias("city"), F.col("id").cast("double").alias("n")
    )
    rated = presentation.ratio_to_max(table, F.col("n"))
    told = rated.agg(F.count("*"), F.count_distinct("city"), F.count_if(F.col("ratio") == 1.0)).first()
    assert tuple(told) == (60_000, 20_000, 20_000)
    assert "Window" not in plan(rated)


BOX, RADIUS = (0.0045, 0.0061), 400.0


def crowd(spark, n, seed, names):
    rng = random.Random(seed)
    # Most rows in one cell, some around it, some equal.
    at = [(42.0 + rng.random() * 0.004, -71.0 + rng.random() * 0.005) for _ in range(n)]
    at += [(42.0 + rng.random() * 0.05, -71.0 + rng.random() * 0.05) for _ in range(n // 10)]
    at += at[:5]
    return at, spark.createDataFrame([("b", k if k < n else 0, *p) for k, p in enumerate(at)],
                                     f"city string, {', '.join(names)}")


@pytest.mark.parametrize("sizes", [(300, 40), (40, 300), (300, 300)])
def test_cells_crowded_on_either_side_or_both(spark, sizes):
    left, spread = crowd(spark, sizes[0], 1, ["l long", "stop_lat double", "stop_lon double"])
    right, fixed = crowd(spark, sizes[1], 2, ["r long", "lat double", "lon double"])
    at, reach = (["stop_lat", "stop_lon"], ["lat", "lon"]), Reach(RADIUS, BOX)
    plain = near_pairs(spread, fixed, *at, reach)
    split = near_pairs(spread, fixed, *at, reach, split_rows=50)
    assert "_fixed_part" not in plan(plain) and "_fixed_part" in plan(split)
    names = ("l", "r", "stop_lat", "lat")
    assert rows(split, *names) == rows(plain, *names)
    found = near_any(fixed, spread, at[1], at[0], reach, split_rows=50)
    assert rows(found, "r", "lat") == rows(near_any(fixed, spread, at[1], at[0], reach), "r", "lat")
    assert found.count() > sizes[1]


def test_each_side_is_shuffled_once(spark):
    _, spread = crowd(spark, 300, 1, ["l long", "stop_lat double", "stop_lon double"])
    _, fixed = crowd(spark, 300, 2, ["r long", "lat double", "lon double"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    # Both tables are beyond what is broadcast; the list of crowded cells is not.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "9000")
    try:
        pairs = near_pairs(
            spread, fixed, ["stop_lat", "stop_lon"], ["lat", "lon"], Reach(RADIUS, BOX), split_rows=50
        )
        text = plan(pairs)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2, text


def test_a_shape_of_a_million_points_in_pieces(spark):
    n = 1_000_000
    points = spark.range(n).select(
        F.lit("b").alias("city"), F.lit("r").alias("route_id"), F.lit("s").alias("shape_id"),
        F.col("id").cast("int").alias("shape_pt_sequence"), (F.col("id") * 1e-6).alias("shape_pt_lat"),
        (F.col("id") * 1e-6 + 1).alias("shape_pt_lon"),
    ).repartition(8, "shape_pt_sequence")
    pieces = serving.route_path_pieces(points, 1000, stretches=8)
    told = pieces.agg(F.count("*"), F.max(F.size("path")), F.sum(F.size("path") - 1), F.max("piece")).first()
    assert tuple(told) == (1001, 1000, n - 1, 1000)
    ends = pieces.select("piece", F.col("path")[0].alias("first"), F.element_at("path", -1).alias("last"))
    following = ends.select((F.col("piece") - 1).alias("piece"), F.col("first").alias("next"))
    assert ends.join(following, "piece").where(F.col("last") != F.col("next")).count() == 0


@pytest.mark.parametrize("count", [1, 2, 5, 6, 9, 10])
def test_pieces_join_to_the_same_line(spark, count):
    shape = spark.createDataFrame(
        [("b", "r", "s", k, float(k), float(-k)) for k in range(count)],
        "city string, route_id string, shape_id string, shape_pt_sequence int, shape_pt_lat double, shape_pt_lon double",
    )
    pieces = [r["path"] for r in serving.route_path_pieces(shape, 5).orderBy("piece").collect()]
    line = [p for k, path in enumerate(pieces) for p in path[min(k, 1):]]
    whole = [r["path"] for r in serving.route_paths(shape).collect()]
    assert [line] == whole if count > 1 else not pieces
    assert all(2 <= len(path) <= 5 for path in pieces)


def test_the_shuffles_of_a_step_leave_the_disks_with_it(spark):
    """They stayed until the driver's memory was tidied up, those of all steps beside each other."""
    from pathlib import Path

    from transit_engine.operators.ranked import freed, written

    def files():
        folders = [Path(str(f)) for f in spark._jsc.sc().env().blockManager().diskBlockManager().localDirs()]
        return {f.name for folder in folders for f in folder.rglob("shuffle_*.data")}

    def left(step):
        before = files()
        assert step(spark.range(50_000).groupBy(F.pmod(F.xxhash64("id"), F.lit(5_000))).count(), "x").count() == 5_000
        return files() - before

    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    # The count after a step has a shuffle of its own, of one row.
    kept, gone = len(left(written)), len(left(freed))
    assert gone < kept
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting


def test_only_groups_that_go_on_have_offsets(spark):
    """Every group of every stretch had a row, joined to all rows: as many as there are groups."""
    many = spark.range(20_000).select(F.floor(F.col("id") / 3).alias("g"), "id")
    ranked = in_order(many, ["g"], ["id"], "place", stretches=8)
    joined = [line for line in plan(ranked).splitlines() if "Join" in line]
    assert len(joined) == 1 and "BroadcastHashJoin" in joined[0], joined
    assert ranked.where("place != id % 3 + 1").count() == 0 and ranked.count() == 20_000
    nulls = spark.range(3_000).select(F.lit(None).cast("string").alias("g"), "id")
    assert in_order(nulls, ["g"], ["id"], "place", stretches=8).where("place != id + 1").count() == 0
