from __future__ import annotations

from datetime import datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom import functions as fn
from feedloom.functions.flags import ENTRY_WORDS, TICKET_WORDS
from feedloom.functions.text import ACCENTED, PLAIN


def test_clean_text_compares_missing_words_before_upper_case(column):
    assert column(fn.clean_text, " ana ", "", "NA", "na", "None", "NONE", "\t x\n", None) == [
        "ANA", None, None, "NA", None, "NONE", "X", None]


def test_strip_and_squash_take_unicode_spaces(column):
    assert column(fn.strip, " a b　", "\x1ca\x1f") == ["a b", "a"]
    assert column(fn.squash, " a  b\t\nc d ", "a b", "", None) == ["a b c d", "a b", "", None]


def test_unaccent(column):
    assert column(fn.normalize_text, " São João ", "Straße", "Œuvre æ", "plain", None, "naı̈f ŁÓDŹ") == [
        "SAO JOAO", "STRASSE", "OEUVRE AE", "PLAIN", "", "NAIF LODZ"]
    assert len(PLAIN) <= len(ACCENTED) and PLAIN.isascii()


def test_number_text_keeps_a_lone_dot_as_decimal_mark(column):
    assert column(fn.to_float, "R$ 1.234,50", "1.234", "12,5", "-3", "1-2", "abc", "", "NA", "1,234.56", None) == [
        1234.5, 1.234, 12.5, -3.0, None, None, None, None, 1.23456, None]


def test_plain_numbers_refuse_what_a_cast_would_take(column):
    assert column(lambda c: fn.to_float(c, ptbr=False), " 1.5 ", "5d", "NaN", "1e3", "1,5", "+2", ".5", "") == [
        1.5, None, None, 1000.0, None, 2.0, 0.5, None]
    assert column(lambda c: fn.to_int(c, ptbr=False), "12", "12.0", "12.5", "x", "9007199254740993", None) == [
        12, 12, None, None, 9007199254740993, None]
    assert column(fn.to_int, "1.234,99", "12.9", "7", "sem") == [1234, 12, 7, None]
    assert column(fn.to_number_or_null, "", "NONE", "NAN", "12", "1.5", "x") == [None, None, None, 12.0, 1.5, None]


def test_boolean_words(column):
    assert column(fn.to_bool, " Sim", "NÃO", "ok", "F", "talvez", "", None) == [True, False, True, False, None, None, None]
    assert column(lambda c: fn.to_bool(c, ENTRY_WORDS), "s", "N", "sim", "1") == [True, False, None, True]
    assert column(lambda c: fn.to_bool(c, TICKET_WORDS, default=False), "True", "1", None) == [True, False, False]


def test_dates(column):
    expected = datetime(2026, 1, 5, 9, 5)
    assert column(fn.parse_dt, "05/01/2026 09:05", "5/1/2026 9:5", "31/02/2026 09:05", "5/1/26 9:05", None) == [
        expected, expected, None, None, None]
    assert column(fn.to_utc_ms, "2026-01-05T09:05:00.1239-03:00", "2026-01-05", "x", None) == [
        "2026-01-05 12:05:00.123", "2026-01-05 00:00:00.000", None, None]


def test_document_sentinel_loses_and_regains_its_sign(column):
    assert column(fn.clean_document, "123.456.789-01", "-1", "1", "", None, "abc", "123456789012") == [
        "12345678901", "-1", "-1", "-1", "-1", "-1", "12345678901"]
    assert column(fn.is_document, "12345678901", "12345678901\n", "1234567890", "1234567890a", None) == [
        True, False, False, False, False]


def test_letters_only(column):
    assert column(fn.letters_only, "D'Ávila × 2º x", "a_b", None) == ["DÁvila   x", "ab", None]


def test_defaults_and_fallbacks(spark, column):
    assert column(lambda c: fn.default_text(c, "N"), "", None, " ", "a") == ["N", "N", " ", "a"]
    assert column(lambda c: fn.default_text(c, "N", blank=False), "", None) == ["", "N"]
    frame = spark.createDataFrame([(None, "b"), ("  ", "b"), ("a ", "b"), (None, " ")], "x string, y string")
    assert [r[0] for r in frame.select(fn.first_filled("x", "y")).collect()] == ["b", "b", "a ", None]
    assert [r[0] for r in frame.select(fn.full_name("x", "y")).collect()] == ["B", "B", "A  B", ""]


def test_channels(column):
    assert column(fn.map_channel, "(none)", " cpc ", "xCPCx", "Organic", "botão", "(Outro)", None, "not set") == [
        "SEM REFERENCIA", "MIDIA PAGA", "MIDIA PAGA", "ORGÂNICO", "NI", "(Outro)", None, "NOT SET"]


def test_classify_takes_the_first_rule(column):
    rules = [("A", ["CÃO+", "ESPACO"]), ("B", ["X"])]
    assert column(lambda c: fn.classify(c, rules, "C"), "espaço x", "x", None, "") == ["A", "B", "C", "C"]


def test_small_ones(column):
    assert column(lambda c: fn.after_sep(c, " X "), "A X B", "A X B X C", "A") == ["B", "B", ""]
    assert column(lambda c: fn.strip_prefix(c, "a.b"), "a.bc", "axbc", None) == ["c", "axbc", None]
    assert column(lambda c: fn.name_parts(c)["last_word"], "  ana  maria souza ", "só") == ["souza", "só"]
    assert column(lambda c: fn.label_year(F.lit("Copa"), F.to_date(c)), "2024-05-01", None) == ["Copa 2024", None]


@settings(max_examples=25, deadline=None)
@given(texts=st.lists(st.text(max_size=12), min_size=1, max_size=20))
def test_whitespace_rules_follow_python(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, c string")
    found = sorted(frame.select("i", fn.strip("c"), fn.squash("c")).collect())
    assert [r[1] for r in found] == [t.strip() for t in texts]
    assert [r[2] for r in found] == [" ".join(t.split()) for t in texts]
