"""Edges of the scalar catalogue that the provided tables don't have."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from cadastra.functions import predicates as pr
from cadastra.functions import scalar as sc
from cadastra.functions.expressions import expression


@pytest.fixture(scope="module")
def one(spark):
    df = spark.createDataFrame([(None, "", "x", 0.0, 5.0, -7.0, "de LA cruz", "-42")], "n double, blank string, x string, zero double, five double, minus double, name string, signed string")
    return lambda *columns: tuple(df.select(*columns).first())


c = F.col


def test_numbers(one):
    texts = ["1d", " 12.5 ", "1e3", "", "abc", "+.5", "1,000", None]
    assert one(*(sc.to_numeric(F.lit(t).cast("string")) for t in texts)) == (None, 12.5, 1000.0, None, None, 0.5, None, None)
    assert one(*(sc.parse_currency(F.lit(t)) for t in ("$1,234.50", "(12)", " ( $3 ) ", "x"))) == (1234.5, -12.0, -3.0, None)
    assert one(*(sc.resolve_century(F.lit(y)) for y in (68, 69, 0, 1999))) == (2068.0, 1969.0, 2000.0, 1999.0)
    assert one(sc.UNARY["round"](F.lit(2.5)), sc.UNARY["round"](F.lit(3.5))) == (2.0, 4.0)


def test_division_never_raises(one):
    a, b, d, e = one(sc.divide(c("five"), c("zero")), sc.divide(c("minus"), c("zero")), sc.divide(c("zero"), c("zero")), sc.divide(c("n"), c("zero")))
    assert a == math.inf and b == -math.inf and math.isnan(d) and e is None
    assert one(sc.BINARY["mod"](c("minus"), F.lit(3.0)), sc.BINARY["mod"](c("five"), c("zero"))) == (2.0, None)


def test_nulls_across_columns(one):
    assert one(sc.row_sum(c("n"), c("five")), sc.row_sum(c("n"), c("n")), sc.row_mean(c("n"), c("five")), sc.first_stated(c("blank"), c("x"))) == (5.0, None, 5.0, "x")
    assert one(sc.compare("less_than", c("n"), 3), sc.compare("not_equal", c("n"), 3), sc.compare("equal", c("five"), 5)) == (0, 1, 1)
    assert one(sc.ACROSS["any_gt"](c("n"), c("five"), threshold=4), sc.ACROSS["all_gt"](c("n"), c("five"), threshold=4)) == (1, 0)


def test_text(one):
    s = F.lit("abcdef")
    assert one(sc.substring(s, 1, 3), sc.substring(s, -2), sc.substring(s, 4, 2), sc.substring(s, None, -1), sc.substring(s, 9)) == ("bc", "ef", "", "abcde", "")
    assert one(sc.title_smart(c("name")), sc.zfill(c("signed"), 5), sc.zfill(F.lit("123456"), 3)) == ("De la Cruz", "-0042", "123456")
    assert one(sc.split_take(F.lit("a|b|c"), "|", -1), sc.split_take(F.lit("a|b"), "|", 5), sc.concat([c("n"), c("x")], "-")) == ("c", None, "-x")
    assert one(sc.as_text(c("five"), "double"), sc.text_coalesce([c("blank"), F.lit(" "), F.lit("N/A"), c("x")], ("N/A",))) == ("5", "x")


def test_last_pattern_wins_first_rule_wins(one):
    assert one(sc.remap_pattern(F.lit("abc"), [("a", 1), ("ab", 2), ("c", 3)]), pr.ruleset(F.lit("abc"), [("B", "first"), ("a", "second")])) == (2, "first")
    assert one(sc.remap_conditional(F.lit("abc"), [("startswith", "a", 1), ("contains", "b", 2), ("in", ["z"], 3)]), sc.remap(F.lit("q"), {"a": 1}, 9)) == (2, 9)


def test_expressions(one):
    assert one(expression("({five} + 1) * 2 > 11 and not `zero` > 0"), expression("n.isna() | (x == 'y')"), expression("x.str.upper().isin(['X'])"), expression("five ** 2 - -1")) == (True, True, True, 26.0)
    with pytest.raises(ValueError):
        expression("__import__('os').system('x')")
    with pytest.raises((ValueError, SyntaxError)):
        expression("[i for i in x]")


def test_indicators_are_never_null(spark):
    df = spark.createDataFrame([(None, None), (3.0, "a + b")], "v double, t string")
    specs = [{"kind": "numeric_at_least", "column": "v", "value": 3}, {"kind": "has_token", "column": "t", "values": ["b"]}, {"kind": "in_set", "column": "t", "values": ["q"]}, {"kind": "all_of", "of": []}, {"kind": "none_of", "of": [{"kind": "not_null", "column": "gone"}]}]
    rows = df.select(*(pr.indicator(df, s) for s in specs)).collect()
    assert [tuple(r) for r in rows] == [(False, False, False, False, True), (True, True, False, False, True)]


def test_votes(spark):
    df = spark.createDataFrame([(1, "a"), (0, "a"), (0, "b")], "big int, text string")
    fires = lambda k, v, **o: {"name": k, "test": {"kind": "equals", "column": k, "value": v}, **o}
    decisions = [{"label": "A", "evidence": [fires("big", 1, insufficient_alone=True), fires("text", "a")]}, {"label": "B", "evidence": [fires("text", "a")]}, {"label": "C", "evidence": [fires("big", 0, require=True), fires("text", "b")], "min_score": 2}]
    out = [tuple(r) for r in pr.vote(df, decisions).select("winner", "winner_score", "runner_up", "evidence").collect()]
    assert out == [("A", 2.0, "B", "big+text"), ("A", 1.0, "B", "text"), ("C", 2.0, None, "big+text")]
    ballots = [("one", F.lit(None).cast("string"), 5.0), ("two", F.lit("p"), 1.0), ("three", F.lit("q"), 1.0)]
    assert tuple(pr.open_vote(df, ballots).select("winner", "score", "evidence").first()) == ("p", 1.0, "two")
    assert pr.open_vote(df, ballots, tiebreaker="three").first().winner == "q"
