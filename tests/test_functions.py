import datetime as dt

import pytest
from pyspark.sql import functions as F

from fiscalweave.functions import measures as ms
from fiscalweave.functions import text as tx

def V():
    return F.col("v")


def apply(spark, values, column, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_names(spark):
    names = ["Doe, Jane", "  jane \u00a0 DOE ", "O'Neil J.", "Anne’s", None, ""]
    assert apply(spark, names, tx.normalize_name(V())) == [
        "doe jane", "jane doe", "oneil j", "annes", "", ""]
    assert apply(spark, names, tx.token_key(V())) == ["doe jane", "doe jane", "j oneil", "annes", "", ""]


def test_email_alias(spark):
    assert apply(spark, ["jane_doe@x.org", "plain", None, "a@b@c"], tx.email_alias(V())) == [
        "jane doe", None, None, "a"]


def test_week_labels(spark):
    labels = ["W40", "WK1", "wk 7", "W40 May 1-2", "", None, "QTD", "Week 3"]
    assert apply(spark, labels, tx.week_number(V())) == [40, 1, 7, 40, None, None, None, None]
    assert apply(spark, ["WK1", "W 40", "Wks", "Q T D"], tx.fold_label(V())) == [
        "w1", "w40", "wks", "qtd"]


def test_periods(spark):
    fy, qtr = tx.parse_period(V())
    texts = ["E2E FY27 Q1", "fy 2026 q 4", "no period"]
    assert apply(spark, texts, F.struct(fy, qtr)) == [(27, 1), (2026, 4), (None, None)]
    assert apply(spark, [2026, 26], tx.short_year(V()), "int") == [26, 26]
    nxt = F.struct(*tx.next_quarter(F.lit(26), V()))
    assert apply(spark, [3, 4], nxt, "int") == [(26, 4), (27, 1)]
    assert apply(spark, [2026], tx.period_label(V(), F.lit(4)), "int") == ["FY26 Q4"]


def test_date_ranges(spark):
    d = dt.date
    df = spark.createDataFrame([(d(2026, 5, 1), d(2026, 5, 2)), (d(2026, 5, 31), d(2026, 6, 6)),
                                (d(2026, 5, 1), None), (None, None)], "s date, e date")
    got = [r[0] for r in df.select(tx.date_range_label(F.col("s"), F.col("e"))).collect()]
    assert got == ["May 1-2", "May 31-Jun 6", "May 1", ""]
    assert apply(spark, [2, 7, None], tx.day_count_label(V()), "int") == ["2 days", "", ""]


def test_parse_number(spark):
    texts = ["1,020", "97%", "$ 3.5", "-4", ".5", "12abc", "n/a", "", None, "NaN", "1e3", "2d"]
    assert apply(spark, texts, tx.parse_number(V())) == [
        1020.0, 97.0, 3.5, -4.0, 0.5, None, None, None, None, None, 1000.0, None]


def test_formats(spark):
    texts = ["0.253", "1.999", "2", "97", "0", "25%", "-", "", None, "-0.5"]
    assert apply(spark, texts, tx.format_percent(V())) == [
        "25%", "200%", "2%", "97%", "0%", "25%", "-", "", "", "-50%"]
    texts = ["3.14159", "9.96", "12.5", "7", "1,020", "5%", "n/a", "-2.25", None]
    assert apply(spark, texts, tx.format_number(V())) == [
        "3.1", "10", "13", "7", "1,020", "5%", "n/a", "-2.2", ""]
    assert apply(spark, ["2.5", "7", "x.y", "-", None, "1,020.4"], tx.format_whole(V())) == [
        "3", "7", "x.y", "-", "", "1020"]
    texts = ["1234567", "$1,000", "2.5", "45%", " . ", None, "text "]
    assert apply(spark, texts, tx.format_thousands(V())) == [
        "1,234,567", "1,000", "2.5", "45%", "", "", "text"]


def test_signed(spark):
    assert apply(spark, [3, -3, 0, None], tx.signed(V()), "int") == ["+3", "-3", "0", None]
    assert apply(spark, [0], tx.signed(V(), zero="+0"), "int") == ["+0"]
    pairs = ["1,020", "99", "100", "x", "99.5", "98765532.1", "100.0000000001"]
    assert apply(spark, pairs, tx.signed_variance(V(), F.lit("100"))) == [
        "+920", "-1", "+0", "", "-0.5", "+98765432.1", "+0.0000000001"]


def test_relabel(spark):
    old, new = F.lit("FY26 Q4"), F.lit("FY27 Q1")
    labels = ["FY26 Q4 Sales", "FY26 Q3 Sales", "FY25  PKGs", "National"]
    assert apply(spark, labels, tx.relabel_period(V(), old, new))[0] == "FY27 Q1 Sales"
    assert apply(spark, labels, tx.names_other_period(V(), old, ["PKGs", "WSB"])) == [False, True, True, False]


BANDS = ["100", "99.9", "95", "94.9", "97%", "1,020", "-", "n/a", "N/A", "#DIV/0!", "", None, "0"]


def test_index_band(spark):
    want = ["green", "amber", "amber", "red", "amber", "green"] + ["none"] * 6 + ["red"]
    assert apply(spark, BANDS, ms.index_band(V())) == want
    assert apply(spark, ["0", "1"], ms.index_band(V(), zero_is_blank=True)) == ["none", "red"]


def test_rule_band_first_match_wins(spark):
    rules = [ms.BandRule("between", 90, "near", 110), ms.BandRule(">", 100, "high"),
             ms.BandRule("!=", 5, "other")]
    assert apply(spark, ["90", "110", "111", "5", "4", ""], ms.rule_band(V(), rules)) == [
        "near", "near", "high", "none", "other", "none"]
    assert apply(spark, ["96"], ms.rule_band(V(), [])) == ["amber"]
    with pytest.raises(ValueError):
        ms.BandRule("~", 1, "x").matches(V())


def test_safe_div_and_index(spark):
    assert apply(spark, [4, 0, None], ms.safe_div(F.lit(2), V()), "int") == [0.5, 0.0, 0.0]
    assert apply(spark, [4, 0, None], ms.index_to(F.lit(2), V()), "int") == [50.0, None, None]
