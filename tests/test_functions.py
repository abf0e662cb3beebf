"""Hand-made cases of the column expressions."""

import math

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import arrays, numeric


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def column(spark, values, expression, kind="double"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_equal_width(spark):
    values = [0.0, 1.0, 10.0, 11.0, 20.0, 21.0, 90.0, 90.5, 95.0, 100.0]
    got = column(spark, values, lambda x: numeric.equal_width(x, F.lit(100.0), 10))
    assert got == [None, 0, 0, 1, 1, 2, 8, None, None, None]


def test_equal_width_step_is_at_least_one(spark):
    assert column(spark, [1.0, 2.0, 3.0], lambda x: numeric.equal_width(x, F.lit(3.0), 1000)) == [0, 1, None]


def test_round_even(spark):
    assert column(spark, [0.5, 1.5, 2.5, None], lambda x: numeric.round_even(x)) == [0.0, 2.0, 2.0, None]
    assert column(spark, [0.125, 0.375], lambda x: numeric.round_even(x, 2)) == [0.12, 0.38]


def test_truncate(spark):
    assert column(spark, [2.99999999999, -1.7, 3.2], lambda x: numeric.truncate(x)) == [3, -1, 3]


def test_guarded_ratio(spark):
    assert one(spark, numeric.guarded_ratio(F.lit(4), F.lit(2))) == 2
    assert one(spark, numeric.guarded_ratio(F.lit(4), F.lit(0))) == 4


def test_finite_or_zero(spark):
    values = [math.inf, -math.inf, math.nan, None, 1.5]
    assert column(spark, values, numeric.finite_or_zero) == [0, 0, 0, 0, 1.5]


def test_cut_points(spark):
    values = [184.0, 185.0, 999.0, 1000.0, 5838.0, 5839.0, None]
    got = column(spark, values, lambda x: numeric.cut_points(x, [185, 1000, 5839]))
    assert got == [1, 2, 2, 3, 3, 4, None]


@pytest.mark.parametrize(
    "ids, expected",
    [([1, 2, 3], [0, 0, 1, 2, 3]), ([1, 2, 3, 4, 5, 6], [2, 3, 4, 5, 6]), ([], [0] * 5), (None, [0] * 5)],
)
def test_pad_left(spark, ids, expected):
    assert column(spark, [ids], lambda x: arrays.pad_left(x, 5), "array<bigint>") == [expected]


def test_list_text_with_quotes_and_escapes(spark):
    lists = [["O'Reilly", "b"], ['say "x"', "b"], ["it's \"both\"", "back\\slash", "tab\tline\n", "\\n"], [], ["a, b]"]]
    got = column(spark, [repr(x) for x in lists] + [None, "[ ]"], arrays.parse_list_text, "string")
    assert got == [*lists, None, []]
    with pytest.raises(Exception, match="not a list"):
        column(spark, ["a, b"], arrays.parse_list_text, "string")


def test_bigrams(spark):
    values = [["a", "b", "c"], ["a"], []]
    got = column(spark, values, arrays.with_bigrams, "array<string>")
    assert got == [["a", "b", "c", "a b", "b c"], ["a"], []]


def test_words_and_lists(spark):
    assert one(spark, arrays.words(F.lit("Añb c_1, é!"))) == ["Añb", "c_1", "é"]
    assert one(spark, arrays.words(F.lit("a bc d"), arrays.LONG_WORD)) == ["bc"]
    assert one(spark, arrays.parse_list_text(F.lit("['x', 'y z']"))) == ["x", "y z"]
    assert one(spark, arrays.split_list(F.lit("a#b"))) == ["a", "b"]


def test_best_class_takes_the_first(spark):
    assert one(spark, arrays.best_class(F.array(*[F.lit(v) for v in (0.2, 0.5, 0.5)]))) == 2
