"""Sums of doubles against fractions of unlimited precision."""

import math
import random
from fractions import Fraction

import pytest

from mapstrata.operators import aggregate
from mapstrata.operators.exact_sums import exact_sums
from mapstrata.plans.prepare import Block, Preparation, aggregate_blocks_long


def nearest(fraction):
    try:
        return float(fraction)
    except OverflowError:
        return math.inf if fraction > 0 else -math.inf


def groups(seed):
    draw = random.Random(seed)
    out = {}
    for g in range(150):
        n, kind = draw.choice([1, 2, 3, 10, 200]), draw.randrange(6)
        if kind == 0:
            values = [draw.uniform(-1, 1) * 10 ** draw.uniform(-300, 300) for _ in range(n)]
        elif kind == 1:
            values = [round(draw.uniform(-1e6, 1e6), 2) for _ in range(n)]
        elif kind == 2:
            values = [draw.uniform(-1, 1) * 2 ** draw.uniform(-60, 60) for _ in range(n)]
        elif kind == 3:
            values = [math.ldexp(draw.randrange(1 << 53), draw.choice([-1074, -1060, -500, 0, 900])) * draw.choice([1, -1]) for _ in range(n)]
        elif kind == 4:  # all but a little cancels
            values = [draw.uniform(-1, 1) * 10 ** draw.uniform(-20, 20) for _ in range(n)]
            values += [-x for x in values[:-1]]
        else:  # at and beside the middle of two doubles
            values = [1.0, 2.0**-53, draw.choice([0.0, 2.0**-106, -(2.0**-106)]), draw.choice([0.0, 2.0**-53])]
        out[g] = values
    special = [[0.0, -0.0], [5e-324] * 7, [1e308, 1e308, -1e308], [1e308, 1e308], [2.0**53, 1.0, 1.0], [2.0**53, 1.0], [2.0**53 + 2, 1.0]]
    return out | {1000 + i: v for i, v in enumerate(special)}


@pytest.mark.parametrize("seed", [1, 2])
def test_nearest_double_of_the_exact_sum(spark, seed):
    held = groups(seed)
    rows = [(g, x) for g, values in held.items() for x in values]
    expected = {g: (nearest(sum(map(Fraction, v), Fraction(0))), len(v)) for g, v in held.items()}
    for parts in (1, 3, 7, 13):
        random.Random(parts).shuffle(rows)
        found = exact_sums(spark.createDataFrame(rows, "g int, x double").repartition(parts), ["g"], "x").collect()
        assert {r.g: (r.total, r.n) for r in found} == expected


def test_values_that_are_no_finite_numbers(spark):
    inf, nan = math.inf, math.nan
    held = {1: [inf, 1.0], 2: [-inf, 1e308], 3: [inf, -inf], 4: [nan, 1.5, None], 5: [nan, None]}
    rows = [(g, x) for g, values in held.items() for x in values]
    found = {r.g: (r.total, r.n) for r in exact_sums(spark.createDataFrame(rows, "g int, x double"), ["g"], "x").collect()}
    assert found.pop(3)[0] != found.get(3)
    assert found == {1: (inf, 2), 2: (-inf, 2), 4: (1.5, 1)}
    assert exact_sums(spark.createDataFrame([], "g int, x double"), ["g"], "x").count() == 0


def test_sums_and_means_do_not_depend_on_partitions(spark):
    draw = random.Random(5)
    rows = [(str(i % 3), draw.gauss(0, 1) * 10 ** draw.randrange(-8, 9), f"{draw.uniform(0, 9):.3f}") for i in range(20_000)]
    seen = set()
    for parts in (1, 3, 7, 13):
        draw.shuffle(rows)
        df = spark.createDataFrame(rows, "u string, a double, b string").repartition(parts)
        wide = aggregate.numeric_blocks(df, ["u"], {"suma": ["a", "b"], "media": ["b", "a"]}).orderBy("u").collect()
        seen.add(tuple(map(tuple, wide)))
    assert len(seen) == 1
    for row in seen.pop():
        a, b = ([float(r[c]) for r in rows if r[0] == row[0]] for c in (1, 2))
        assert row[1:] == (math.fsum(a), math.fsum(b), math.fsum(b) / len(b), math.fsum(a) / len(a))


def test_integers_in_long_form_are_exact(spark):
    df = spark.createDataFrame([("1", 9007199254740993, "0.5"), ("1", 2**60, "1"), ("2", 1, None)], "u string, a bigint, b string")
    found = {(r.u, r.code): (r.value, r.whole) for r in aggregate.numeric_long(df, ["u"], ["a", "b"], "suma", exact=True).collect()}
    total = 9007199254740993 + 2**60
    assert found == {
        ("1", "suma::a"): (float(total), total), ("2", "suma::a"): (1.0, 1), ("1", "suma::b"): (1.5, None), ("2", "suma::b"): (0.0, None),
    }
    means = aggregate.numeric_wide(df, ["u"], ["a"], "media").collect()
    assert {r.u: r["media::a"] for r in means} == {"1": float(total) / 2, "2": 1.0}


def test_integer_sums_beyond_64_bits(spark):
    """A column of sums is wider than 64 bits if one of them needs it, and only then."""
    big = 2**63 - 1
    rows = [("1", str(big), big, 1), ("1", "18446744073709551615", big, 2), ("2", "5", -big, 3), ("2", None, -2, 4), ("3", None, None, 5)]
    df = spark.createDataFrame(rows, "u string, a string, b bigint, c int")
    wide = aggregate.numeric_wide(df, ["u"], ["a", "b", "c"], "suma")
    assert [t for _, t in wide.dtypes] == ["string", "decimal(38,0)", "decimal(38,0)", "bigint"]
    found = {r.u: (r["suma::a"], r["suma::b"], r["suma::c"]) for r in wide.collect()}
    assert found == {"1": (big + 2**64 - 1, 2 * big, 3), "2": (5, -big - 2, 7), "3": (0, 0, 5)}
    edges = spark.createDataFrame([("1", big - 1), ("1", 1), ("2", -big), ("2", -1)], "u string, b bigint")
    fitting = aggregate.numeric_wide(edges, ["u"], ["b"], "suma")
    assert fitting.dtypes == [("u", "string"), ("suma::b", "bigint")]
    assert {r.u: r["suma::b"] for r in fitting.collect()} == {"1": big, "2": -big - 1}


def test_long_form_with_sums_beyond_64_bits(spark):
    """Counts and smaller sums stand beside sums that need more than 64 bits."""
    df = spark.createDataFrame([("1", "x", 2**62, 1), ("1", "y", 2**62, 2), ("1", "x", 2**62 + 1, 3)], "u string, v string, a bigint, b int")
    total = 3 * 2**62 + 1
    sums = aggregate.numeric_long(df, ["u"], ["a", "b"], "suma", exact=True)
    assert {r.code: (r.value, r.whole) for r in sums.collect()} == {"suma::a": (float(total), total), "suma::b": (6.0, 6)}
    metadata = spark.createDataFrame([("v", "[]")], "var string, valores string")
    blocks = [Block(["v"], None), Block(["a"], "suma")]
    long, _ = aggregate_blocks_long(Preparation(df, metadata, "var", "valores"), ["u"], blocks, exact=True)
    assert {r.code: r.whole for r in long.collect()} == {"conteo::total_datos": 3, "suma::a": total, "v-x": 2, "v-y": 1}
