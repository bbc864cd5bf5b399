"""Expression tables: ids, names, dates, payload text."""

import hashlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from rankloom.config import BASELINE, SCENARIO_OVERRIDES, override, scenarios
from rankloom.functions import games, ids, text
from rankloom.functions.strings import strip


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("raw,code", [
    ("Male", "M"), ("male", "M"), ("M", "M"), ("1", "M"), ("1.0", "M"), (" m ", "M"), ("Female", "F"), ("female", "F"),
    ("F", "F"), ("0", "F"), ("0.0", "F"), ("X", None), ("", None), (None, None)])
def test_gender(spark, raw, code):
    assert one(spark, ids.gender_code(F.lit(raw).cast("string"))) == code


@pytest.mark.parametrize("raw,age", [
    ("U10", 10), ("U11", 11), ("U18", 18), ("10", 10), ("u 12 boys", 12), ("U9", None), ("U19", None), ("none", None),
    ("99999999999999999999", None), (None, None)])
def test_age(spark, raw, age):
    assert one(spark, ids.age_number(F.lit(raw).cast("string"))) == age


@pytest.mark.parametrize("args", [
    ("FC Elite AZ", "AZ", "U10", "Male"), ("  fc elite az\t", "az", "10", "m"), ("Thunder SC", "TX", "U16", "Female")])
def test_team_id_is_a_hash_of_clean_parts(spark, args):
    name, state, age, gender = args
    clean = f"{name.strip().lower()}|{state.upper()}|{age.lstrip('U')}|{'M' if gender[0] in 'Mm' else 'F'}"
    expected = hashlib.sha1(clean.encode()).hexdigest()[:12]
    assert one(spark, ids.team_id(*[F.lit(a) for a in args])) == expected


def test_team_id_known_value(spark):
    assert one(spark, ids.team_id(F.lit("FC Elite AZ"), F.lit("AZ"), F.lit("U10"), F.lit("Male"))) == "f9e5c66ad375"


@pytest.mark.parametrize("args,reason", [
    (("", "AZ", "U10", "M"), "name"), (("A", "", "U10", "M"), "state_empty"), (("A", "ARIZONA", "U10", "M"), "state_length"),
    (("A", "AZ", "U9", "M"), "age"), (("A", "AZ", "U10", "X"), "gender"), ((None, "AZ", "U10", "M"), "name")])
def test_team_id_rejects(spark, args, reason):
    cols = [F.lit(a).cast("string") for a in args]
    assert one(spark, ids.team_id(*cols)) is None
    assert one(spark, ids.reject_reason(*cols)) == reason


def test_canonical_id(spark):
    assert one(spark, ids.canonical_id(F.lit(" 126693.0 "))) == "126693"
    assert one(spark, ids.canonical_id(F.lit("  "))) is None


@pytest.mark.parametrize("raw,name", [
    ("FC Elite AZ United Soccer Club", "az"), ("SC Premier Academy 2010", "2010"), ("Phoenix  Rising!! 16-B", "phoenix rising 16b"),
    ("", ""), (None, "")])
def test_normalized_name(spark, raw, name):
    assert one(spark, text.normalized_name(F.lit(raw).cast("string"))) == name


@pytest.mark.parametrize("raw,year,name", [
    ("FC Elite AZ 2010 Boys", "2010", "az boys"), ("Rush 12010", None, "rush 12010"), ("1999 Stars 2001", "1999", "stars")])
def test_name_with_year(spark, raw, year, name):
    assert one(spark, text.name_year(F.lit(raw))) == year
    assert one(spark, text.name_without_year(F.lit(raw))) == name


def test_jaccard(spark):
    assert one(spark, text.name_similarity(F.lit("Red Lion Stars"), F.lit("Stars red lion FC"))) == 1.0
    assert one(spark, text.name_similarity(F.lit("a b c"), F.lit("a b d"))) == 0.5
    assert one(spark, text.name_similarity(F.lit("FC"), F.lit("FC"))) == 0.0
    assert one(spark, text.name_similarity(F.lit(None).cast("string"), F.lit("x"))) == 0.0


def _ratio(a, b):
    a, b = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    row = [0] * (len(b) + 1)
    for ch in a:
        new = [0]
        for j, other in enumerate(b):
            new.append(row[j] + 1 if ch == other else max(row[j + 1], new[j]))
        row = new
    return 1.0 if not a and not b else 2 * row[-1] / (len(a) + len(b))


def test_token_sort_ratio_against_plain_python(spark):
    names = ["Red Lion", "lion red", "Red Lions SC", "", "é á ü", "aaaa bbbb " * 20, "x", "State 48 FC Avondale 16"]
    rows = [(a, b) for a in names for b in names]
    df = spark.createDataFrame(rows, "a string, b string").select("a", "b", text.token_sort_ratio(F.col("a"), F.col("b")).alias("s"))
    for r in df.collect():
        assert r["s"] == pytest.approx(_ratio(r["a"], r["b"]), abs=1e-12)


def test_redaction_masks_and_cuts(spark):
    raw = "see https://a.b/c for Mesa United and FC Rush FC ids 1234567 12345 at 2025-01-02T03:04:05.123Z end"
    assert one(spark, text.redact(F.lit(raw))) == (
        "see [URL_REDACTED][TEAM_NAME_REDACTED] ids [ID_REDACTED] 12345 at [TIMESTAMP_REDACTED] end")
    cut = one(spark, text.shortened(text.redact(F.lit("9 " * 600))))
    assert one(spark, text.redact(F.lit("9 " * 600))) == "9 " * 600
    assert len(cut) == 450 + len("... and more failures") and cut.endswith("more failures")


def test_word_ends_in_any_script(spark):
    import itertools
    import unicodedata
    inner = lambda c: c == "_" or unicodedata.category(c)[0] in "LMN"

    def plain(raw, allowed):
        runs = ["".join(g) for word, g in itertools.groupby(raw, inner) if word]
        return [w for w in runs if set(w) <= set(allowed)]
    around = ["", " ", "É", "ß", "京", "я", "²", "e\u0301", "\u0301", "_", "7", "-", "€", "\u00a0"]
    raws = [f"{a}{w}{b} {tail}" for a in around for b in around for w, tail in (("CA", "TX"), ("1234567", "x"))]
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    for r in df.select("raw", text.first_state(F.col("raw")).alias("state"), text.redact(F.col("raw")).alias("safe")).collect():
        states = [w for w in plain(r.raw.upper(), "ACTX") if w in ("CA", "TX")]
        assert r.state == (states[0] if states else "")
        ids = [w for w in plain(r.raw, "0123456789") if len(w) >= 6]
        assert r.safe == (r.raw.replace(ids[0], "[ID_REDACTED]") if ids else r.raw)


def test_redaction_equals_the_plain_pattern(spark):
    import re
    for raw in ["FC", "FC ", " FC", "FCFC", "x SC y SC z", "ab\ncd Club9Club", "Soccer", "aSoccer1 Academy", "no words"]:
        plain = re.sub(r"[A-Za-z\s]+(?:SC|FC|United|Academy|Club|Soccer|Futbol)", "[TEAM_NAME_REDACTED]", raw)
        assert one(spark, text.redact(F.lit(raw))) == plain


def test_strip_takes_all_white_space(spark):
    assert one(spark, strip(F.lit("\n\t a b\xa0\r\n"))) == "a b"


@pytest.mark.parametrize("raw,day", [
    ("2025-09-20", date(2025, 9, 20)), ("9/20/2025", date(2025, 9, 20)), ("09/20/25", date(2025, 9, 20)),
    ("09/20/99", date(1999, 9, 20)), ("2025-09-20T10:00:00", date(2025, 9, 20)), ("soon", None), ("", None)])
def test_flexible_date(spark, raw, day):
    assert one(spark, games.flexible_date(F.lit(raw))) == day


@pytest.mark.parametrize("raw,expected", [
    ("W 2-1 (H)", (2, 1, "H", "W")), ("l 0 : 3 (a)", (0, 3, "A", "L")), ("D 1-1", (1, 1, "H", "D")), ("", (None, None, "H", "U")),
    ("forfeit", (None, None, "H", "U"))])
def test_result_text(spark, raw, expected):
    assert tuple(one(spark, games.parse_result_text(F.lit(raw)))) == expected


def test_config_override():
    assert override(BASELINE, {"max_games": 20}).max_games == 20
    with pytest.raises(ValueError, match="unknown"):
        override(BASELINE, {"nope": 1})
    assert set(scenarios()) == set(SCENARIO_OVERRIDES) and len(scenarios()) == 13
