import random
import time

import pytest
from pyspark.sql import functions as F

from almanack.operators import bounded_broadcast, contains_join, nested_pair_join
from plans_text import executed_plan, plan

NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": -1,
    "spark__sql__adaptive__autoBroadcastJoinThreshold": -1,
}
# Adaptive execution takes a partition for skewed from a few hundred bytes on.
SMALL_SKEW = {
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": 2,
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10k",
}


def titles(spark, *rows):
    return spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "n int, title string")


def counties(spark, *rows):
    return spark.createDataFrame([*rows], "county string, state string")


def brute_force(texts, needles):
    return sorted(
        (n, c, s)
        for n, t in enumerate(texts)
        for c, s in needles
        if None not in (t, c, s) and c in t and s in t
    )


def matches(spark, texts, needles, **options):
    """By grams and by scan alike."""
    found = []
    for scan in (-1, 1 << 40):
        joined = contains_join(
            titles(spark, *texts),
            counties(spark, *needles),
            "title",
            ["county", "state"],
            max_scan=scan,
            **options,
        )
        assert joined.columns == ["n", "title", "county", "state"]
        found.append(sorted((r.n, r.county, r.state) for r in joined.collect()))
    assert found[0] == found[1]
    return found[0]


def test_contains_needs_both_needles(spark):
    texts = ["Rate: Cook County, IL (U)", "Rate: Cook County, MN (U)", "Rate: Lake County, IL (U)"]
    needles = [("Cook", "IL"), ("Cook", "MN"), ("Lake", "IL"), ("cook", "IL")]
    wanted = [(0, "Cook", "IL"), (1, "Cook", "MN"), (2, "Lake", "IL")]
    assert matches(spark, texts, needles) == wanted


def test_contains_one_name_inside_another(spark):
    texts = ["Van Buren, MI", "Buren, MI", "Buren Buren, MI"]
    needles = [("Buren", "MI"), ("Van Buren", "MI")]
    assert matches(spark, texts, needles) == brute_force(texts, needles)
    assert len(brute_force(texts, needles)) == 4


def test_contains_empty_and_null(spark):
    texts = ["Cook, IL", "", None]
    needles = [("", "IL"), ("", ""), (None, "IL"), ("Cook", None), ("IL", "IL")]
    assert matches(spark, texts, needles) == brute_force(texts, needles)


def test_contains_nothing_to_look_for(spark):
    assert matches(spark, ["Cook, IL"], []) == []


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_contains_like_brute_force(spark, limit):
    rnd = random.Random(5)

    def word(longest):
        return "".join(rnd.choice("abé ") for _ in range(rnd.randint(0, longest)))

    # A third of the texts and of the needles share one name.
    texts = [word(12) if i % 3 else "aab" + word(6) for i in range(300)]
    needles = list({(word(5) if i % 3 else "aab", word(3)) for i in range(60)})
    assert matches(spark, texts, needles, max_broadcast_bytes=limit) == brute_force(texts, needles)


def test_contains_looks_up_the_rarest_gram(spark):
    """Many states share a county's name, and many texts hold it."""
    texts = [f"Washington, {chr(65 + i % 26)}{i % 7}" for i in range(200)]
    needles = [("Washington", f"{chr(65 + i % 26)}{i // 26}") for i in range(520)]
    assert matches(spark, texts, needles) == brute_force(texts, needles)
    joined = contains_join(
        titles(spark, *texts), counties(spark, *needles), "title", ["county", "state"], max_scan=-1
    )
    text = plan(joined)
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_contains_with_many_lengths_in_long_texts(spark):
    """The plan does not grow with the number of different lengths."""
    rnd = random.Random(9)
    texts = ["".join(rnd.choices("ab c", k=1500)) for _ in range(12)]
    needles = [(texts[n % 12][n : 2 * n + 1], "b") for n in range(3, 400)]

    def shape(texts, needles):
        sides = titles(spark, *texts), counties(spark, *needles)
        return plan(contains_join(*sides, "title", ["county", "state"], max_scan=-1)).count("\n")

    assert shape(texts, needles) == shape("x", needles[:9])
    assert matches(spark, texts, needles) == brute_force(texts, needles)


def test_contains_of_repeated_texts_and_rows(spark):
    """Each left row meets each right row that fits, also where both repeat."""
    texts, needles = ["Cook, IL"] * 3 + ["Lake"], [("Cook", "IL")] * 2 + [("", "")]
    assert matches(spark, texts, needles, max_broadcast_bytes=1 << 20) == sorted(
        (n, c, s) for n, t in enumerate(texts) for c, s in needles if c in t and s in t
    )


def test_contains_of_letters_beyond_one_code_unit(spark):
    texts, needles = ["a😀bc", "😀", "b😀c", "é😀é"], [("😀b", "c"), ("😀", ""), ("é😀é", "é"), ("😀bc", "a😀")]
    assert matches(spark, texts, needles) == brute_force(texts, needles)


def test_contains_of_long_titles_costs_no_more_than_a_loop(spark):
    """Titles of 2,100 characters: twice the time of comparing all, at most, on the second run."""
    rnd = random.Random(3)
    rows = ["".join(rnd.choices("abcdefghij ", k=2100)) for _ in range(400)]
    needles = [("".join(rnd.choices("abcdefghij ", k=5)), "a") for _ in range(1500)]
    left, right = titles(spark, *rows).cache(), counties(spark, *needles).cache()
    loop = left.join(
        F.broadcast(right), F.contains("title", F.col("county")) & F.contains("title", F.col("state"))
    )
    sides = left, right, "title", ["county", "state"]
    forms = {
        "loop": lambda: loop,
        "chosen": lambda: contains_join(*sides),
        "grams": lambda: contains_join(*sides, max_scan=-1),
    }
    seconds, counts = {}, set()
    for name, form in forms.items():
        for _ in range(2):
            start = time.perf_counter()
            counts.add(form().count())
            seconds[name] = time.perf_counter() - start
    left.unpersist(), right.unpersist()
    assert len(counts) == 1
    assert min(seconds["chosen"], seconds["grams"]) <= 2 * seconds["loop"] + 0.5, seconds
    print(seconds)


def test_contains_with_one_and_with_three_needles(spark):
    texts = ["abcde", "abde", "xyz"]
    one = contains_join(titles(spark, *texts), counties(spark, ("bc", "")), "title", ["county"])
    assert [r.n for r in one.collect()] == [0]
    rows = [("a", "d", "e"), ("a", "c", "e"), ("x", "y", "q")]
    right = spark.createDataFrame(rows, "p string, q string, r string")
    three = contains_join(titles(spark, *texts), right, "title", ["p", "q", "r"])
    assert sorted((r.n, r.p, r.q, r.r) for r in three.collect()) == [
        (0, "a", "c", "e"),
        (0, "a", "d", "e"),
        (1, "a", "d", "e"),
    ]


def test_contains_rejects_columns_on_both_sides(spark):
    both = titles(spark, "x")
    with pytest.raises(ValueError, match="title"):
        contains_join(both, both, "title", ["title"])


def test_nested_pair(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "id int, x string")
    right = spark.createDataFrame([(2, "B"), (3, "C")], "id int, y string")
    pairs = nested_pair_join(left, right, "id", "id").collect()
    assert sorted((p._1.id, p._1.x, p._2.id, p._2.y) for p in pairs) == [
        (2, "b", 2, "B"),
        (2, "c", 2, "B"),
    ]


def test_broadcast_depends_on_the_measured_size(spark, settings):
    facts = spark.range(1000).select((F.col("id") % 10).alias("k"))
    names = spark.range(10).select(F.col("id").alias("k"), F.repeat(F.lit("é"), 50).alias("name"))
    size = 10 * (8 * (2 + 2) + 100)
    with settings(**NO_BROADCAST):
        assert "BroadcastHashJoin" in plan(facts.join(bounded_broadcast(names, size), "k"))
        assert "SortMergeJoin" in plan(facts.join(bounded_broadcast(names, size - 1), "k"))


def test_a_hot_key_is_split(spark, settings):
    """One key holds a third of the rows of a table too large to broadcast."""
    with settings(**NO_BROADCAST, **SMALL_SKEW):
        n = 60_000
        key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
        facts = spark.range(0, n, 1, 8).select(key.alias("k"), F.col("id").alias("fact"))
        names = spark.range(0, n, 1, 8).select(F.col("id").alias("k"), F.col("id").alias("name"))
        pairs = nested_pair_join(facts, bounded_broadcast(names, 0), "k", "k")
        assert "skew=true" in executed_plan(pairs)
        assert pairs.count() == n
