import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.numbers import hash_bucket, int_quotient
from tallyloom.operators.counting import (
    count_by,
    distinct_count_by,
    grouped_lists,
    histogram,
    integer_stats,
    rows_per_distinct,
    share_of_total,
)
from tallyloom.operators.custom import map_partitions_with_index, reduce_by_key, row_function
from tallyloom.operators.indexing import with_global_index
from tallyloom.operators.matching import block_pairs, bounded_pairs, difference, pair_space, without
from tallyloom.operators.ranking import largest, rating_title_order, smallest, top_by
from tallyloom.operators.sampling import sample_rows, sample_with_replacement, split_rows
from tallyloom.operators.unfolding import unfold


@pytest.fixture(scope="module")
def hot(spark):
    """A key that holds a third of the rows, with many equal rows."""
    rows = [("hot", i % 7) for i in range(2000)] + [(f"k{i % 90}", i) for i in range(4000)]
    return spark.createDataFrame(rows, "k string, v int").repartition(6)


def test_counting_literals(spark):
    # The list and its counts.
    repetitive = spark.createDataFrame([(x,) for x in [1, 2, 3, 1, 2, 3, 1, 2, 1, 2, 3, 3, 3, 4, 5, 4, 6]], "x int")
    assert {r.x: r.n for r in count_by(repetitive, "x").collect()} == {1: 4, 2: 4, 3: 5, 4: 2, 5: 1, 6: 1}
    numbers = spark.range(100000)
    assert numbers.agg(F.sum("id")).first()[0] == 4999950000
    assert numbers.filter("id % 7 = 0").agg(F.sum("id")).first()[0] == 714264285


def test_shares_and_quotients(spark, hot):
    shares = {r.k: r.share for r in share_of_total(count_by(hot, "k")).collect()}
    assert abs(shares["hot"] - 1 / 3) < 1e-12 and abs(sum(shares.values()) - 1) < 1e-9
    stats = integer_stats(spark.createDataFrame([(1,), (2,), (4,)], "x long"), "x").first()
    assert (stats.average, stats.minimum, stats.maximum) == (2, 1, 4)
    assert integer_stats(spark.range(0), "id").first().average is None
    big = spark.range(1).select(int_quotient(F.lit(2**62 + 1), F.lit(2)).alias("x"))
    assert big.first().x == 2**61
    assert distinct_count_by(hot, "k", "v", "n").filter("k = 'hot'").first().n == 7
    assert rows_per_distinct(hot, "k", "v", "n").filter("k = 'hot'").first().n == 2000 // 7


def test_histogram(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 1, 9, 10]] + [(None,)], "x double")
    assert {r.bin: r.n for r in histogram(df, "x", 10).collect() if r.n} == {0: 1, 1: 2, 9: 2}
    assert histogram(df, "x", 10).count() == 10
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert sum(r.n for r in histogram(flat, "x", 5).collect()) == 2


def test_grouped_lists_are_whole_and_bounded(hot):
    expected = defaultdict(list)
    for row in hot.collect():
        expected[row.k].append(row.v)
    lists = defaultdict(list)
    for row in grouped_lists(hot, "k", "v", 100).orderBy("k", "list_no").collect():
        assert len(row["items"]) <= 100
        lists[row.k] += row["items"]
    assert lists == {k: sorted(v) for k, v in expected.items()}


@pytest.mark.parametrize("partitions", [1, 7])
def test_global_index(hot, partitions):
    indexed = with_global_index(hot.repartition(partitions), "k", "v", name="i").orderBy("i").collect()
    assert [r.i for r in indexed] == list(range(6000))
    assert [(r.k, r.v) for r in indexed] == sorted((r.k, r.v) for r in hot.collect())


def test_global_index_cuts_a_hot_value(spark):
    same = spark.range(40000).select(F.lit(1).alias("x"))
    numbered = with_global_index(same, "x", name="i")
    assert sorted(r.i for r in numbered.collect()) == list(range(40000))


def test_top_is_a_prefix_of_the_sort(hot):
    counts = count_by(hot, "k")
    whole = sorted(((r.k, r.n) for r in counts.collect()), key=lambda r: (-r[1], r[0]))
    for parts in (1, 7):
        top = top_by(counts.repartition(parts), 10, "n", "k").collect()
        assert [(r.k, r.n) for r in top] == whole[:10]
    assert [r.v for r in smallest(hot.select("v"), 3, "v").collect()] == sorted(r.v for r in hot.collect())[:3]
    assert [r.v for r in largest(hot.select("v"), 3, "v").collect()] == [3999, 3998, 3997]


def test_rating_title_order_is_total(spark):
    rows = [(1.0, "alpha"), (2.0, "alpha"), (2.0, "beta"), (3.0, "alpha"), (1.0, "epsilon"), (1.0, "delta")]
    for shuffled in (rows, rows[::-1]):
        df = spark.createDataFrame(shuffled, "r double, t string").repartition(3)
        assert [tuple(x) for x in df.orderBy(*rating_title_order("r", "t")).collect()] == sorted(rows)
    near = spark.createDataFrame([(4.0625, "b"), (4.0624, "c"), (4.06249, "a")], "r double, t string")
    assert [x.t for x in near.orderBy(*rating_title_order("r", "t", True)).collect()] == ["c", "b", "a"]


def test_difference_keeps_left_repeats(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (2,), (3,), (None,)], "x int")
    right = spark.createDataFrame([(1,), (None,)], "x int")
    assert sorted(r.x for r in difference(left, right).collect()) == [2, 2, 3]
    assert sorted(r.x for r in without(left.na.drop(), right, "x").collect()) == [2, 2, 3]


def test_pair_space(spark):
    row = pair_space(spark.range(7), spark.range(5)).first()
    assert (row.left_rows, row.right_rows, row.pairs) == (7, 5, 35)


def test_block_pairs_equal_the_join(spark):
    left = spark.createDataFrame([("hot", i) for i in range(70)] + [("x", 100), ("l", 101)], "k string, a int")
    right = spark.createDataFrame([("hot", i) for i in range(45)] + [("x", 200), ("r", 201)], "k string, b int")
    found = Counter((r.a, r.b) for r in block_pairs(left, right, "k", "a", "b", 10).collect())
    assert found == Counter((r.a, r.b) for r in left.join(right, "k").collect())


@pytest.mark.parametrize(("least", "block"), [(0.5, 3), (0.05, 2000), (1e-9, 7)])
def test_bounded_pairs_equal_the_filtered_join(spark, least, block):
    rng = random.Random(int(least * 100))
    sides = []
    for side, n in (("l", 200), ("r", 120)):
        rows = [(rng.choice([0, 0, 0, 1, 2, 3, None]), i, rng.choice([1.0, 0.5, 1e-6, rng.random() + 1e-9])) for i in range(n)]
        sides.append(spark.createDataFrame(rows, f"k int, {side}_id int, {side}_bound double"))
    found = bounded_pairs(*sides, "k", "l_id", "r_id", "l_bound", "r_bound", least, block)
    wanted = sides[0].join(sides[1], "k").filter(F.col("l_bound") * F.col("r_bound") >= least)
    assert sorted(map(tuple, found.select(*wanted.columns).collect())) == sorted(map(tuple, wanted.collect()))


def test_samples(spark):
    df = spark.range(5000).withColumnRenamed("id", "key")
    first = sorted(r.key for r in sample_rows(df, "key", 100, 1).collect())
    assert len(set(first)) == 100
    assert first == sorted(r.key for r in sample_rows(df.repartition(7), "key", 100, 1).collect())
    assert first != sorted(r.key for r in sample_rows(df, "key", 100, 2).collect())
    assert sample_rows(df, "key", 9000, 1).count() == 5000

    drawn = sample_with_replacement(df, "key", 400, 3).collect()
    assert sorted(r.draw for r in drawn) == list(range(400))
    again = sample_with_replacement(df.repartition(3), "key", 400, 3).collect()
    assert sorted(map(tuple, drawn)) == sorted(map(tuple, again))
    few = sample_with_replacement(df.limit(5), "key", 100, 3).collect()
    assert len(few) == 100 and len({r.key for r in few}) == 5
    assert sample_with_replacement(df.filter("key < 0"), "key", 10, 3).count() == 0


@pytest.mark.parametrize("n", [1, 2, 999, 4999, 5000, 6000])
def test_large_samples_are_the_smallest_hashes(spark, n):
    df = spark.range(5000).repartition(6)
    direct = {r.id for r in sample_rows(df, "id", n, 4, merged=10_000).collect()}
    bounded = [r.id for r in sample_rows(df, "id", n, 4, merged=0).collect()]
    assert set(bounded) == direct and len(bounded) == min(n, 5000)


def test_a_large_sample_sorts_nothing_as_a_whole(spark):
    plan = sample_rows(spark.range(3_000_000), "id", 1_000_000, 1)
    assert plan.count() == 1_000_000
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in text and "TakeOrderedAndProject" in text


def test_split_is_disjoint_and_complete(spark):
    df = spark.range(20000).select((F.col("id") % 150).alias("u"), F.col("id").alias("i"))
    parts = [{(r.u, r.i) for r in part.collect()} for part in split_rows(df, ["u", "i"], [6, 2, 2], 0)]
    assert sum(map(len, parts)) == 20000 and len(set.union(*parts)) == 20000
    assert all(abs(len(part) / 20000 - share) < 0.02 for part, share in zip(parts, (0.6, 0.2, 0.2)))


def test_hash_bucket_takes_keys_of_any_type(spark):
    df = spark.createDataFrame([(2**62, "a"), (-(2**62), "é"), (0, None), (None, "")], "x long, y string")
    assert all(0 <= r.b < 10 for r in df.select(hash_bucket([F.col("x"), F.col("y")], 7, 10).alias("b")).collect())


@pytest.mark.parametrize("seed", [1, 2, 3, 10])
def test_splits_of_two_seeds_are_independent(spark, seed):
    df = spark.range(20000).select((F.col("id") % 150).alias("u"), F.col("id").alias("i"))
    both = split_rows(df, ["u", "i"], [6, 2, 2], 0)[0].join(split_rows(df, ["u", "i"], [6, 2, 2], seed)[0], ["u", "i"])
    assert abs(both.count() / 20000 - 0.36) < 0.02


def test_draws_have_one_plan_for_any_number(spark):
    df = spark.range(30000).withColumnRenamed("id", "key")

    def nodes(n):
        plan = sample_with_replacement(df, "key", n, 3)._jdf.queryExecution().optimizedPlan().toString()
        return [line.strip(" +-:").split(" ")[0] for line in plan.splitlines()]

    assert nodes(60) == nodes(1_000_000)
    drawn = sample_with_replacement(df, "key", 100_000, 3)
    assert drawn.count() == 100_000
    share = drawn.select("key").distinct().count() / 30000
    assert abs(share - (1 - 2.718281828 ** (-100_000 / 30000))) < 0.01


def test_unfold_drops_nothing_but_empty_arrays(spark):
    df = spark.createDataFrame([(1, ["a", "", "a"]), (2, []), (3, None)], "i int, xs array<string>")
    assert [tuple(r) for r in unfold(df, F.col("xs"), "x", "i").collect()] == [(1, "a"), (1, ""), (1, "a")]


def test_reduce_by_key(spark, hot):
    expected = Counter()
    for row in hot.collect():
        expected[row.k] += row.v
    assert {r.k: r.v for r in reduce_by_key(hot, "k", "v", lambda x, y: x + y).collect()} == expected
    pairs = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 5), (None, 6)], "k string, v int")
    assert {r.k: r.v for r in reduce_by_key(pairs, "k", "v", lambda x, y: x + y).collect()} == {"a": 3, "b": 1, None: 11}


def test_reduce_by_key_groups_as_sql_does(spark):
    rows = [(float("nan"), 1), (float("nan"), 2), (0.0, 4), (-0.0, 8), (None, 16), (None, 32), (1.5, 64)]
    df = spark.createDataFrame(rows, "k double, v int").repartition(4)
    got = sorted(r.v for r in reduce_by_key(df, "k", "v", lambda x, y: x + y).collect())
    assert got == sorted(r.v for r in df.groupBy("k").agg(F.sum("v").alias("v")).collect())


def test_python_functions(spark):
    words = spark.createDataFrame([("cat",), ("rat",), (None,)], "w string")
    plural = row_function(lambda word: word + "s", "string")
    assert [r.p for r in words.select(plural(F.col("w")).alias("p")).collect()] == ["cats", "rats", None]

    def numbered(index, batches):
        for batch in batches:
            yield batch.assign(part=index)

    df = spark.range(0, 8, 1, 4)
    rows = map_partitions_with_index(df, numbered, "id long, part int").collect()
    assert [r.part for r in sorted(rows)] == [0, 0, 1, 1, 2, 2, 3, 3]
