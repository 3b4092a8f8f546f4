"""Near names against all pairs, hostile blocks, and stages of cascades."""

import random
import time

import pytest
from pyspark.sql import functions as F

from annalist.operators import matching


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_no_pair_is_lost(spark, most):
    draw = random.Random(most)
    letters = "ab" if most > 1 else "abcé日"
    left = {"".join(draw.choice(letters) for _ in range(draw.randint(0, 11))) for _ in range(90)} | {"", "a", "ab"}
    right = set()
    for name in sorted(left):
        word = list(name)
        for _ in range(draw.randint(0, most + 1)):
            at = draw.randint(0, len(word))
            word[at : at + draw.randint(0, 1)] = [draw.choice(letters)] * draw.randint(0, 1)
        right.add("".join(word))
    df = lambda names: spark.createDataFrame([(n, 1) for n in names] + [(None, 1), (sorted(names)[0], 2)], "name string, n int")
    got = sorted(tuple(r) for r in matching.near_names(df(left), df(right), most).collect())
    assert got == sorted((a, b, d) for a in left for b in right if (d := edits(a, b)) <= most)


def test_one_block_of_all_rows_ends(spark):
    draw = random.Random(1)
    rows = [(n, "one", "common " + "".join(draw.choice("abcdefghij") for _ in range(12))) for n in range(8_000)]
    left = spark.createDataFrame(rows, "a int, brand string, title string")
    right = spark.createDataFrame([(n, "one", t[:-1] + "#") for n, _, t in rows], "b int, brand string, title string")
    began = time.perf_counter()
    found = matching.cascade(left, right, [matching.Stage("fuzzy", ("brand",), name="title", edits=1)], "a", "b").collect()
    assert len(found) == 8_000 and all(r["a"] == r["b"] and not r["sure"] for r in found) and time.perf_counter() - began < 90


def test_stages_take_what_is_left(spark):
    left = spark.createDataFrame([(1, "s1", "v9", "vw", "golf", 2010, 100.0), (2, None, "v2", "vw", "golf", 2010, 100.0), (3, None, None, "vw", "golf", 2010, 5_900.0), (4, None, None, "vw", "golf", 2010, None), (5, None, None, None, "golf", 2010, 100.0)], "l int, source_id string, vin string, make string, model string, year int, mileage double")
    right = spark.createDataFrame([(10, "s1", "v1", "x", "x", 1, 1.0), (11, "s2", "v2", "x", "x", 1, 1.0), (12, None, None, "vw", "golf", 2010, 6_900.0), (13, None, None, "vw", "golf", 2010, 4_899.0), (14, None, None, "vw", "golf", 2011, 5_900.0), (15, None, None, "vw", "golf", 2010, 6_900.0)], "r int, source_id string, vin string, make string, model string, year int, mileage double")
    got = sorted(tuple(r) for r in matching.cascade(left, right, matching.VEHICLES, "l", "r").collect())
    assert got == [(1, 10, "source_id", 0.0, True), (2, 11, "vin", 0.0, True), (3, 12, "make_model_year_mileage", 1000.0, False)]
    assert matching.cascade(left.where("false"), right, matching.PRODUCTS[:0] + matching.VEHICLES, "l", "r").collect() == []


def test_names_that_differ_in_digits_only_meet_near_ones(spark):
    names = spark.range(40_000).select(F.format_string("Customer#%09d", "id").alias("name"))
    pairs = matching.near_names(names, names, 1)
    began = time.perf_counter()
    assert pairs.count() == 40_000 + 2 * sum(1 for n in range(40_000) for m in nearby(n) if n < m < 40_000)
    assert time.perf_counter() - began < 60


def nearby(n):
    """Numbers of nine digits one edit away."""
    digits = f"{n:09d}"
    return {int(digits[:k] + c + digits[k + 1 :]) for k in range(9) for c in "0123456789" if c != digits[k]}


def test_nearest_value_of_a_large_block(spark):
    draw = random.Random(3)
    left = {n: draw.choice([None, draw.randint(0, 4_000)]) for n in range(400)}
    right = {n: draw.choice([None, 10 * draw.randint(0, 400)]) for n in range(300)}
    df = lambda rows, key: spark.createDataFrame([("k", n, v) for n, v in rows.items()], f"kind string, {key} int, v int")
    found = matching.cascade(df(left, "a"), df(right, "b"), [matching.Stage("near", ("kind",), near="v", within=7)], "a", "b")
    want = {a: min((abs(v - w), b) for b, w in right.items() if w is not None) for a, v in left.items() if v is not None}
    assert {r["a"]: (r["distance"], r["b"]) for r in found.collect()} == {a: m for a, m in want.items() if m[0] <= 7}
    # 40,000 rows of one block would meet 1.6 billion times
    many = spark.range(40_000).select(F.lit("k").alias("kind"), F.col("id").alias("a"), (F.col("id") / 40_000.0).alias("v"))
    began = time.perf_counter()
    assert matching.cascade(many, many.withColumnRenamed("a", "b"), [matching.Stage("near", ("kind",), near="v", within=1)], "a", "b").where("a = b and distance = 0").count() == 40_000
    assert time.perf_counter() - began < 30
