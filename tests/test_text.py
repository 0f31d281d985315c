"""Cleansing rules: the literal cases, and Python's own answers on odd texts."""

import html
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulseledger.functions import cleanse, text


def apply(spark, rule, values, kind="string"):
    """The rule's results for the values, in order."""
    frame = spark.createDataFrame(list(enumerate(values)), f"n int, v {kind}")
    rows = frame.select("n", rule(F.col("v")).alias("r")).orderBy("n").collect()
    return [row.r for row in rows]


def name(drops):
    return lambda col: cleanse.name(col, drops)


CASES = [
    (name(cleanse.PERSON_NAME_DROPS), " john doe ", "John Doe"),
    (name(cleanse.PERSON_NAME_DROPS), "o'brien", "OBrien"),
    (name(cleanse.PERSON_NAME_DROPS), "josé  3", "Jos "),
    (name(cleanse.MIDDLE_NAME_DROPS), "anna-marie x.", "Anna-Marie X"),
    (name(cleanse.CITY_DROPS), "New York", "NewYork"),
    (name(cleanse.STREET_DROPS), "12-b oak ave., #3/4 (rear)", "12B Oak Ave. #3/4 Rear"),
    (name(cleanse.CONTACT_NAME_DROPS), "jane-ann (wife)/x", "JaneAnn (Wife)/X"),
    (name(cleanse.PERSON_NAME_DROPS), None, None),
    (cleanse.email, "  JOHN.DOE@EXAMPLE.COM  ", "john.doe@example.com"),
    (cleanse.email, "invalid-email", None),
    (cleanse.email, "a@b.co extra", None),
    (cleanse.state, "california", "CA"),
    (cleanse.state, "invalid-state", "INVALID-STATE"),
    (cleanse.state, "West Virginia", "VA"),
    (cleanse.state, "Arkansas", "AR"),
    (cleanse.state, " tx ", "TX"),
    (cleanse.state, "New  York", "NEW  YORK"),
    (cleanse.state, "Alaskan", "ALASKAN"),
    (cleanse.state, "Guam or Alabama", "AL"),
    (cleanse.state, None, None),
    (cleanse.beneficiary_id, " 1EG4-TE5-MK73 ", "1EG4TE5MK73"),
    (cleanse.beneficiary_id, "invalid-mbi", "INVALIDMBI"),
    (cleanse.beneficiary_id, "1EG4TE5MK73999", "1EG4TE5MK73"),
    (cleanse.diagnosis_codes, "E11.9", "E119"),
    (cleanse.diagnosis_codes, "I10, E11.9", "I10,E119"),
    (cleanse.diagnosis_codes, "|10", "|10"),
    (cleanse.diagnosis_codes, "none", ""),
    (cleanse.diagnosis_codes, None, ""),
    (cleanse.insurer, "kaiser health plan", "Kaiser"),
    (cleanse.insurer, "unknown insurance co", "Unknown Insurance Co"),
    (cleanse.insurer, "BCBS (Fed)", "BCBS Federal"),
    (cleanse.insurer, "blue card, cross town", "Blue Cross and Blue Shield of Florida"),
    (cleanse.insurer, "united american health", "United American"),
    (cleanse.insurer, "humannas", "Humannas"),
    (cleanse.insurer, None, None),
    (cleanse.insurance_id, " abc-123-xyz ", "ABC123XYZ"),
    (cleanse.insurance_id, "invalid-id", "INVALIDID"),
    (cleanse.insurance_id, "---", ""),
    (cleanse.insurance_id, "12AB34CD56EF78GH90IJ", "12AB34CD56EF78"),
    (cleanse.call_seconds, "1 days 02:30:00", 95400.0),
    (cleanse.call_seconds, "1 day, 2:30:00", 95400.0),
    (cleanse.call_seconds, "0:12:30", 750.0),
    (cleanse.call_seconds, None, 0.0),
    (cleanse.call_seconds, "", 0.0),
    (cleanse.call_seconds, "soon", None),
    (cleanse.note_type, "Initial Evaluation with APRN", "Initial Evaluation"),
    (cleanse.note_type, "Follow-up, Check-up", "Follow-up"),
    (cleanse.relationship, "wife", "Wife"),
    (cleanse.relationship, "unknown", None),
    (cleanse.relationship, "Grandson Tim", "Grandson"),
    (cleanse.relationship, "Bob (son / friend)", "Son"),
    (cleanse.race, "white", "White"),
    (cleanse.race, "unknown", "Unknown"),
    (cleanse.race, "african-american", "Black"),
    (cleanse.race, "native american", "Native American"),
    (cleanse.race, "african", "African"),
    (cleanse.weight_lbs, "150 lbs", 150),
    (cleanse.weight_lbs, "invalid-weight", None),
    (cleanse.weight_lbs, "5'8\"", None),
    (cleanse.weight_lbs, "1500", 150),
    (cleanse.weight_lbs, "95.0", 950),
    (cleanse.weight_lbs, "", 0),
    (cleanse.weight_lbs, None, 0),
    (cleanse.height_in, "5'8\"", 68),
    (cleanse.height_in, "invalid-height", None),
    (cleanse.height_in, "68", 816),
    (cleanse.height_in, "5 ft 10 in", 70),
    (cleanse.height_in, "150 lbs", None),
    (cleanse.height_in, "5 8 9", None),
    (cleanse.height_in, None, None),
    (cleanse.digits_only, "(123) 456-7890", "1234567890"),
    (cleanse.digits_only, None, ""),
    (cleanse.short_title, " iii ", "Iii"),
    (cleanse.short_title, "miss  piggy", "Miss  Piggy"),
    (cleanse.sex, "Male", "M"),
    (cleanse.sex, "female", "female"),
    (cleanse.member_status, "DO NOT CALL", "Do Not Call"),
    (cleanse.member_status, "On-Board", "Onboard"),
    (cleanse.member_status, "Active", "Active"),
    (cleanse.zip_base, "12345-6789", "12345"),
    (cleanse.zip_base, "", ""),
    (cleanse.plain_text, "<p>Note content</p>", "Note content"),
    (cleanse.plain_text, "&lt;b&gt;x &amp; y", "x & y"),
    (cleanse.plain_text, "a <b\n> c", "a <b\n> c"),
    (cleanse.plain_text, "caf&eacute; &#8364;5 &ampx", "café €5 &x"),
    (cleanse.plain_text, None, None),
    (cleanse.whole_number, "12", 12),
    (cleanse.whole_number, "x", None),
    (cleanse.device_code, "abc-123-xyz", "abc123xyz"),
]


def test_literal_cases(spark):
    """One job for all cases: each rule is a column over its own one-row input."""
    frame = spark.range(1)
    results = frame.select(
        *(rule(F.lit(value).cast("string")).alias(f"c{n}") for n, (rule, value, _) in enumerate(CASES))
    ).first()
    wrong = [
        (value, expected, results[n])
        for n, (_, value, expected) in enumerate(CASES)
        if results[n] != expected
    ]
    assert wrong == []


def test_rounding_is_half_even_on_the_scaled_value(spark):
    values = ["1.005", "0.125", "2.675", "99.999", "-1.015", "7", None, "x"]
    expected = [
        None if value is None or value == "x" else float(pd.Series([float(value)]).round(2)[0])
        for value in values
    ]
    assert apply(spark, cleanse.two_decimals, values) == expected


def test_flags_keep_both_polarities(spark):
    values = [True, False, None]
    assert apply(spark, cleanse.flag, values, "boolean") == [1, 0, None]
    assert apply(spark, lambda c: cleanse.flag(c, inverted=True), values, "boolean") == [0, 1, None]


def test_payer_fill(spark):
    rows = [
        (None, None, "12345"),
        (None, "9", "12345"),
        ("Kaiser", None, "12345"),
        (None, None, None),
        ("Medicare Part B", None, "777"),
    ]
    frame = spark.createDataFrame(rows, "p string, i string, m string")
    payer = cleanse.primary_payer(F.col("p"), F.col("i"), F.col("m"))
    filled = frame.select(payer.alias("p"), cleanse.primary_payer_id(payer, F.col("i"), F.col("m")).alias("i"))
    assert [tuple(row) for row in filled.collect()] == [
        ("Medicare Part B", "12345"),
        (None, "9"),
        ("Kaiser", None),
        (None, None),
        ("Medicare Part B", "777"),
    ]


def test_vendor(spark):
    rows = [
        ("Omron", "Omron Blood Pressure Monitor", "Omron"),
        ("Omron", "Tenovi Glucometer", "Tenovi"),
        ("Tenovi", "omron mini", "Omron"),
        (None, "Tenovi x", "Tenovi"),
        ("Tenovi", None, "Omron"),
    ]
    frame = spark.createDataFrame(rows, "v string, d string, e string")
    result = frame.select(cleanse.vendor(F.col("v"), F.col("d")).alias("r"), "e").collect()
    assert [row.r for row in result] == [row.e for row in result]


def test_staff_rules(spark):
    rows = [("NursePractitioner", 10.0, "x"), ("RegisteredNurse1", 10.0, "x"),
            ("AlertTeamMember5", 10.0, "x"), ("Someone", 10.0, "x"), (None, None, None)]
    frame = spark.createDataFrame(rows, "a string, s double, t string")
    result = frame.select(
        cleanse.staff_call_seconds(F.col("a"), F.col("s")).alias("s"),
        cleanse.staff_note_type(F.col("a"), F.col("t")).alias("t"),
    ).collect()
    assert [tuple(row) for row in result] == [
        (900.0, "Initial Evaluation"),
        (10.0, "Initial Evaluation"),
        (10.0, "Alert"),
        (10.0, "x"),
        (None, None),
    ]


def odd_texts(count=400, seed=7):
    alphabet = list("abzAZ019 '.-_/\t\n \u001c　éßıİªΣσ日ǆ😀&<>;|#()") + ["son", "New York", "&amp;"]
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 12))) for _ in range(count)]


def test_text_helpers_agree_with_python(spark):
    texts = odd_texts()
    assert apply(spark, text.trimmed, texts) == [t.strip() for t in texts]
    assert apply(spark, text.titled, texts) == [t.title() for t in texts]
    assert apply(spark, text.single_spaced, texts) == [re.sub(r"\s+", " ", t) for t in texts]
    assert apply(spark, text.digits, texts) == [re.sub(r"\D", "", t) for t in texts]
    assert apply(spark, cleanse.plain_text, texts) == [
        re.sub(r"<.*?>", "", html.unescape(t)) for t in texts
    ]


def test_keyword_search_agrees_with_a_plain_loop(spark):
    names = [("S", "son"), ("NY", "new york"), ("Y", "york"), ("B", "b-c")]
    pieces = ["son", "SON", "new york", "york", "b-c", "sons", " ", "-", "x", "new"]
    rng = random.Random(3)
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 6))) for _ in range(300)]

    def plain(value):
        for label, phrase in names:
            if re.search(rf"\b{re.escape(phrase)}\b", value.lower()):
                return label
        return None

    assert apply(spark, lambda c: text.keyword_name(c, names), texts) == [plain(t) for t in texts]
    kept = apply(spark, lambda c: text.keyword_name(c, names, keep_original=True), texts)
    assert kept == [plain(t) or t for t in texts]


def test_keyword_set_search_agrees_with_a_plain_loop(spark):
    sets = [("AB", [["a", "b"]]), ("C", [["c"], ["d", "a"]]), ("A", [["a"]])]
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["a", "b", "C", "d", "ab", "x", ""], k=rng.randint(0, 4))) for _ in range(300)]

    def plain(value):
        for label, options in sets:
            for words in options:
                if all(re.search(rf"\b{w}\b", value.lower()) for w in words):
                    return label
        return value

    found = apply(spark, lambda c: text.keyword_set_name(c, sets, keep_original=True), texts)
    assert found == [plain(t) for t in texts]


def test_keyword_that_begins_another_is_refused():
    with pytest.raises(ValueError):
        text.keyword_name(None, [("A", "new"), ("B", "new york")])


def test_first_match_and_recode(spark):
    assert apply(spark, lambda c: text.first_match(c, r"\d{3}-\d{2}-\d{4}"),
                 ["My SSN is 123-45-6789", "No SSN here", None]) == ["123-45-6789", None, None]
    assert apply(spark, lambda c: text.recode(c, [("a", "b")]), ["a", "c", None]) == ["b", "c", None]


def test_null_where_touches_strings_only(spark):
    frame = spark.createDataFrame([(1, "NaN", "banana"), (2, None, "nan")], "n int, `a b` string, c string")
    result = text.null_where(frame, cleanse.NAN_TEXT).orderBy("n").collect()
    assert [tuple(row) for row in result] == [(1, None, "banana"), (2, None, None)]
