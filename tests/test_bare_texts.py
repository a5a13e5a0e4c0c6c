"""Columns whose values have nothing to strip or to drop are read without looking for it; the values are the same."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from feedloom import functions as fn
from feedloom.functions.text import MISSING_WORDS, WHITESPACE, is_bare, strip, strip_text

INNER = ("a", "José", "É", "ana b", "NaN", "None", "NA", "na", "1", "-", "\x7f", "\x00", "x​", "日本", "Sim", "não", "OK")
NUMBERS = ("1", "24,00", "R$ 1.234,50", "1.234", "12.9", "-.5", ".5", "+7", "1e5", "5d", "1-2", "--", "9" * 20, "1,2,3", "٣", "NaN", "0,05")
MOMENTS = ("2026-01-05T09:05:00.1239-03:00", "2026-01-05", "2026-01-05 10:00:00", "2026", "x", "2026-13-01", "12:00")
# Every white space character at either end and at both.
TEXTS = (None, "", " ", "　", *INNER, *(f"{a}{t}{b}" for t in INNER[:5] for w in WHITESPACE for a, b in ((w, ""), ("", w), (w, w))))
READERS = {
    "strip": (strip_text, TEXTS),
    "text": (fn.clean_text, TEXTS),
    "text, not upper": (lambda c: fn.clean_text(c, upper=False), TEXTS),
    "text, no missing words": (lambda c: fn.clean_text(c, missing=()), TEXTS),
    "bool": (fn.to_bool, TEXTS),
    "float": (fn.to_float, (*TEXTS[:40], *NUMBERS, *(f" {n} " for n in NUMBERS))),
    "int": (fn.to_int, (*TEXTS[:40], *NUMBERS, *(f" {n} " for n in NUMBERS))),
    "date": (fn.to_utc_ms, (*TEXTS[:40], *MOMENTS, *(f"{w}{m}{w}" for m in MOMENTS[:3] for w in WHITESPACE))),
}


@pytest.mark.parametrize("kind", READERS)
def test_a_column_gives_what_an_expression_gives(column, kind):
    read, texts = READERS[kind]
    # An expression takes no shortcut.
    assert column(read, *texts) == column(lambda c: read(F.concat(F.col(c), F.lit(""))), *texts)


def test_bare_texts_are_those_that_stripping_leaves_alone(column):
    found = column(is_bare, *TEXTS)
    assert all(kept == text for bare, kept, text in zip(found, column(strip, *TEXTS), TEXTS, strict=True) if bare)
    assert found == [text and ("!" <= text[0] <= "~" and "!" <= text[-1] <= "~") if text != "" else False for text in TEXTS]


def test_columns_of_other_types_are_read_as_their_texts(column):
    assert column(fn.clean_text, 1, None, kind="bigint") == ["1", None]
    assert column(fn.to_int, 12.9, None, kind="double") == [12, None]


@pytest.mark.parametrize("kind", ["text", "bool", "date"])
def test_a_column_is_searched_for_white_space_only_if_it_is_not_bare(spark, kind):
    read, _ = READERS[kind]
    plan = spark.createDataFrame([("a",)], "c string").select(read("c").alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert -1 < plan.find("CASE WHEN") < plan.find("ELSE") < plan.find("trim(")
    assert plan.count("trim(") == 1


@pytest.mark.parametrize("kind", ["float", "int"])
def test_a_column_of_numerals_meets_no_pattern(spark, kind):
    read, _ = READERS[kind]
    plan = spark.createDataFrame([("1",)], "c string").select(read("c").alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert -1 < plan.find("ltrim(") < plan.find("regexp_replace(")


def test_missing_words_are_compared_before_upper_case_in_columns(column):
    assert column(fn.clean_text, *MISSING_WORDS, "NONE", "na", " None") == [None] * 4 + ["NONE", "NA", None]
