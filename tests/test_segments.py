import datetime as dt
from decimal import Decimal

import pytest

from shelfmark.functions import measures, segments


def evaluate(spark, schema, values, expression):
    """Results of an expression over one column ``x``, in the order of the values."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {schema}")
    return [r.y for r in df.selectExpr("i", f"{expression} AS y").orderBy("i").collect()]


def test_min_age(spark):
    marks = ["1 1/2", "1 1/2+", "3 4/2", "1/2", "18+", " 6-12 ", "all ages", "", None, "2 1/0", "7"]
    assert evaluate(spark, "string", marks, segments.min_age("x")) == [1, 1, 5, 1, 18, 6, 0, 0, 0, 0, 7]


def test_rated(spark):
    marks = ["1 1/2", " 6-12 ", "all ages", "", None, "18+"]
    assert evaluate(spark, "string", marks, f"coalesce({segments.is_rated('x')}, false)") == [
        True, True, False, False, False, True,
    ]


def test_age_bands(spark):
    years = [0, 5, 6, 8, 9, 12, 13, 17, 18, 99, None]
    assert evaluate(spark, "int", years, segments.age_band("x")) == [
        "0-5", "0-5", "6-8", "6-8", "9-12", "9-12", "13-17", "13-17", "18+", "18+", None,
    ]
    assert evaluate(spark, "int", [12, 13, 17, 18, None], segments.audience_segment("x")) == [
        "kids", "adult_13_to_17", "adult_13_to_17", "adult_18_plus", "kids",
    ]


def test_price_bands(spark):
    prices = [Decimal(p) if p else None for p in ("0", "299.99", "300", "799.99", "800", "-1", None)]
    assert evaluate(spark, "decimal(18,2)", prices, segments.price_band("x")) == [
        None, "LPP", "MPP", "MPP", "HPP", None, None,
    ]
    assert evaluate(spark, "decimal(18,2)", prices[:1], segments.price_band("x", include_zero=True)) == ["LPP"]


def test_novelty(spark):
    days = [dt.date(2000, 12, 26), dt.date(2000, 12, 27), dt.date(2001, 5, 1), dt.date(2002, 1, 1), None]
    assert evaluate(spark, "date", days, segments.novelty_since("x", dt.date(2000, 12, 27))) == [
        "existing", "novelty", "novelty", "novelty", "existing",
    ]
    assert evaluate(spark, "date", days, segments.novelty_in_year("x", 2001)) == [
        "existing", "existing", "novelty", "existing", "existing",
    ]


def test_gap_buckets(spark):
    assert evaluate(spark, "int", [1, 49, 50, 99, 100, 949, 950, 999, 1000, 5000], segments.gap_bucket("x")) == [
        "<50", "<50", "50-100", "50-100", "100-150", "900-950", "950-1000", "950-1000", "1000+", "1000+",
    ]


@pytest.mark.parametrize("cap, last", [(5, "4"), (10, "9")])
def test_capped_labels(spark, cap, last):
    values = [0, cap - 1, cap, cap + 7, None]
    assert evaluate(spark, "bigint", values, segments.capped_count_label("x", cap)) == [
        "0", last, f"{cap}+", f"{cap}+", None,
    ]


def test_member_labels(spark):
    born = [dt.date(y, 7, 1) for y in (1984, 1983, 1976, 1975, 1945)] + [None]
    assert evaluate(spark, "date", born, segments.member_age_band("x", 2001)) == [
        "<18", "18-25", "18-25", "26-30", "56+", "age_unknown",
    ]
    assert evaluate(spark, "int", [0, 1, 2, 3, None], segments.gender_label("x")) == [
        "gender_unknown", "male", "female", None, None,
    ]


def test_canonical_member_id(spark):
    rows = [("CRM", "v", 7), ("DY", "v", None), ("ANON", "v", 7), (None, "v", 7), ("TM", None, None)]
    df = spark.createDataFrame(rows, "t string, v string, id bigint")
    expression = segments.canonical_member_id("t", "v", "id", ("CRM", "DY", "TM"))
    assert [r.m for r in df.selectExpr(f"{expression} AS m").collect()] == ["7", "v", None, None, None]


def test_line_split(spark):
    rows = [("A", "red key"), ("B", "red key"), ("B", "red car"), ("B", None), (None, "key")]
    df = spark.createDataFrame(rows, "line string, name string")
    split = segments.line_split("line", "name", "B", "key")
    assert [r.s for r in df.selectExpr(f"{split} AS s").collect()] == ["A", "B_WITH", "B_WITHOUT", None, None]


def test_measures(spark):
    rows = [(2.0, "10.00"), (-1.0, "4.00"), (-1.0, "-4.00"), (0.0, "99.00"), (None, "99.00"), (1.0, None)]
    df = spark.createDataFrame([(q, Decimal(a) if a else None) for q, a in rows], "q double, a decimal(18,2)")
    assert df.selectExpr(f"{measures.net_sales('q', 'a')} AS n").first().n == Decimal("2.00")
    row = spark.range(1).selectExpr(
        f"{measures.safe_ratio('1', '0')} AS zero",
        f"{measures.safe_ratio('1', '4')} AS quarter",
        f"{measures.growth('3', '2')} AS half_more",
        f"{measures.growth('3', 'NULL')} AS unknown",
        f"{measures.whole_ratio('3L', '4L')} AS whole",
        f"{measures.whole_ratio('4L', '4L')} AS one",
        f"{measures.whole_ratio('4L', '0L')} AS none",
    ).first()
    assert tuple(row) == (None, 0.25, 0.5, None, 0, 1, None)
