import datetime as dt

import pytest
from conftest import day
from pyspark.sql import functions as F

from loanlens.functions.values import WHITE_SPACE, full_days, instant, null_if_token, number, stripped, us_date, whole_number
from loanlens.schemas import NULL_TOKENS


def test_strip_covers_all_white_space_and_keeps_inner_blanks(one):
    texts = ["\ta b\n ", "\u00a0x\u00a0", "\u3000 \u2003y", "", "  ", None, "plain", "\x1cz\x85"]
    got = one("t string", [(t,) for t in texts], lambda d: stripped(d.t))
    assert got == ["a b", "x", "y", "", "", None, "plain", "z"]
    assert got == [t.strip() if t is not None else None for t in texts]


def test_null_tokens_are_matched_before_trimming(one):
    got = one("t string", [("#N/A",), ("NaN",), ("",), (" ",), (" NA",), ("none",), (None,)], lambda d: null_if_token(d.t))
    assert got == [None, None, None, " ", " NA", "none", None]


@pytest.mark.parametrize(
    "text, expected",
    [("1/7/2025", "2025-01-07"), ("01/07/2025", "2025-01-07"), ("12/31/2024", "2024-12-31"), ("2/29/2024", "2024-02-29"),
     ("13/7/2025", None), ("2/29/2025", None), ("00:00.0", None), ("", None), ("2025-01-07", None), (None, None)],
)
def test_us_date(one, text, expected):
    assert one("t string", [(text,)], lambda d: us_date(d.t)) == [day(expected) if expected else None]


def test_instants_with_and_without_offset(one):
    texts = ["1992-01-15T00:00:00+03:00", "1979-01-01 00:00:00", "2024-05-01T10:11:12.345Z", "12:30:00", "junk", None]
    got = one("t string", [(t,) for t in texts], lambda d: F.date_format(instant(d.t), "yyyy-MM-dd HH:mm:ss"))
    assert got == ["1992-01-14 21:00:00", "1979-01-01 00:00:00", "2024-05-01 10:11:12", None, None, None]


def test_numbers_survive_drift(one):
    texts = ["4", "4.0", " 4 ", "x", None, "0.5", "89.9", "-3.0"]
    assert one("t string", [(t,) for t in texts], lambda d: whole_number(d.t)) == [4, 4, 4, None, None, None, None, -3]
    assert one("t string", [("1.5",), ("-2",), ("#",)], lambda d: number(d.t)) == [1.5, -2.0, None]
    tokens = [(t,) for t in NULL_TOKENS]
    for parse in (number, whole_number, us_date):
        assert one("t string", tokens, lambda d: parse(d.t)) == [None] * len(tokens)


def test_days_are_floored_on_instants(one):
    """An offset birth date lies on the evening before in UTC, which is not a day more."""
    got = one(
        "a string, b date",
        [("1992-01-15T00:00:00+03:00", dt.date(2025, 12, 30)), ("1992-01-15 00:00:00", dt.date(2025, 12, 30)),
         ("2025-12-30 06:00:00", dt.date(2025, 12, 30))],
        lambda d: full_days(instant(d.a), d.b),
    )
    assert got == [12403, 12403, -1]


def test_white_space_goes_from_both_ends_only(one):
    texts = ["", " ", "a", "~", "é", "a é", "\x7f", "x\x7f", "\x00a", "a\x00", "\u200ba", "a\u200b", None, "loan-1"]
    texts += [t for w in WHITE_SPACE for t in (w, f"{w}a", f"a{w}", f"a{w}b", f"{w}{w} a{w}b {w}", f"é{w}", f"{w}~")]
    expected = [None if t is None else t.strip("".join(WHITE_SPACE)) for t in texts]
    assert one("t string", [(t,) for t in texts], lambda df: stripped(df.t)) == expected


def test_the_ends_of_a_text_are_taken_once(spark):
    """Cutting pieces off every value of every raw column took most of a trim's time."""
    rule = stripped(F.col("t"))._jc.toString()
    assert sum(rule.count(f"{cut}(") for cut in ("left", "right", "substring")) == 1
