"""Team-name and page-text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankloom.functions import similarity
from rankloom.functions.strings import strip
from rankloom.schemas import NAME_STOPWORDS, US_STATES

# Month names as they appear on game pages.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
          "November", "December")
# Keyword groups for opponents that are not in the data, first hit wins.
MISSING_GROUPS = {
    "other_state": ("utah", "california", "nevada", "las vegas", "irvine"),
    "other_age": ("2015", "2017", "u9", "u11", "15b", "17b"),
    "other_gender": ("girls", "15g", "17g"),
}


def name_tokens(name: Column) -> Column:
    """Words of a team name: lower case, letters and digits only, filler words out."""
    plain = F.regexp_replace(F.lower(name), "[^a-z0-9\\s]", "")
    words = F.split(strip(F.regexp_replace(plain, "\\s+", " ")), " ")
    return F.filter(words, lambda w: (w != "") & ~w.isin(*NAME_STOPWORDS))


def normalized_name(name: Column) -> Column:
    return F.coalesce(F.array_join(name_tokens(name), " "), F.lit(""))


def name_year(name: Column) -> Column:
    """The first year from 1900 to 2099 that stands alone in the name, else null."""
    year = F.regexp_extract(name, r"\b((?:19|20)[0-9]{2})\b", 1)
    return F.when(year != "", year)


def name_without_year(name: Column) -> Column:
    return normalized_name(F.regexp_replace(name, r"\b(?:19|20)[0-9]{2}\b", ""))


def jaccard(a: Column, b: Column) -> Column:
    """Shared share of two word lists; 0 when either is empty or null."""
    left, right = F.array_distinct(a), F.array_distinct(b)
    score = F.size(F.array_intersect(left, right)) / F.size(F.array_union(left, right))
    return F.when((F.size(left) > 0) & (F.size(right) > 0), score).otherwise(0.0)


def trigrams(col: Column | str) -> Column:
    """Groups of three letters of the normalized name between blanks; empty for an empty name."""
    name = F.concat(F.lit(" "), normalized_name(col), F.lit(" "))
    groups = F.transform(F.sequence(F.lit(1), F.length(name) - 2), lambda i: F.substring(name, i, F.lit(3)))
    return F.when(F.length(name) > 2, groups).otherwise(F.array().cast("array<string>"))


def name_similarity(a: Column, b: Column) -> Column:
    return jaccard(name_tokens(a), name_tokens(b))


def likely_same(a: Column, b: Column, threshold: float = 0.7) -> Column:
    return name_similarity(a, b) >= threshold


def sorted_tokens(name: Column) -> Column:
    """Words of the name in order, joined by one blank (case is kept)."""
    words = F.split(strip(F.regexp_replace(name, "\\s+", " ")), " ")
    return F.array_join(F.array_sort(words), " ")


def token_sort_ratio(a: Column, b: Column) -> Column:
    """Similarity from 0 to 1 of two names regardless of word order; equal and empty ones are settled before they are compared."""
    x, y = sorted_tokens(a), sorted_tokens(b)
    settled = (x == y) | (x == "") | (y == "")
    compared = similarity.ratio(F.when(~settled, x), F.when(~settled, y))
    return F.when(x == y, 1.0).when(settled, 0.0).otherwise(compared)


def containment_score(a: Column, b: Column) -> Column:
    """Plain fallback: 1 when equal, 0.8 when one contains the other, else 0."""
    x, y = F.lower(strip(a)), F.lower(strip(b))
    return F.when(x == y, 1.0).when(F.contains(x, y) | F.contains(y, x), 0.8).otherwise(0.0)


def edit_similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length, from 0 to 1."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1.0 - F.levenshtein(a, b) / longest)


# A character of a word in any script, an accent with its letter: what \b takes for one depends on the version of Java.
WORD_CHAR = r"[\p{L}\p{M}\p{N}_]"

# Words that end a team-like name, and the marks put in place of masked text.
TEAM_WORDS = ("SC", "FC", "United", "Academy", "Club", "Soccer", "Futbol")
MASKS = {"url": "[URL_REDACTED]", "team": "[TEAM_NAME_REDACTED]", "id": "[ID_REDACTED]", "time": "[TIMESTAMP_REDACTED]"}


def redact(text: Column) -> Column:
    """Mask links, team-like names, long numbers and timestamps, in the whole text."""
    text = F.regexp_replace(text, r"https?://[^\s]+", MASKS["url"])
    # Letters and blanks up to the last team word of a stretch of them. The look-behind lets a match begin at the
    # start of a stretch only; without it the search retries from every letter, quadratic in long documents.
    text = F.regexp_replace(text, rf"(?<![A-Za-z\s])[A-Za-z\s]+(?:{'|'.join(TEAM_WORDS)})", MASKS["team"])
    text = F.regexp_replace(text, rf"(?<!{WORD_CHAR})[0-9]{{6,}}(?!{WORD_CHAR})", MASKS["id"])
    return F.regexp_replace(text, r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?Z?", MASKS["time"])


def shortened(text: Column, max_length: int = 500) -> Column:
    """A text for a report: cut if it is longer than ``max_length``, with a remark in place of the rest."""
    short = F.concat(F.substring(text, 1, max_length - 50), F.lit("... and more failures"))
    return F.when(F.length(text) > max_length, short).otherwise(text)


def first_number(text: Column) -> Column:
    """First whole number in the text, 0 if there is none."""
    digits = F.regexp_extract(text, "([0-9]+)", 1)
    return F.coalesce(digits.try_cast("long"), F.lit(0).cast("long"))


def first_state(text: Column) -> Column:
    """First two-letter word in the text that is a US state, else an empty string."""
    words = F.regexp_extract_all(F.upper(text), F.lit(rf"(?<!{WORD_CHAR})([A-Z]{{2}})(?!{WORD_CHAR})"), F.lit(1))
    valid = F.filter(words, lambda w: w.isin(*US_STATES))
    return F.coalesce(F.get(valid, F.lit(0)), F.lit(""))


def missing_reason(name: Column) -> Column:
    """Keyword group of an opponent name: other state, age or gender, else unknown."""
    text = F.lower(F.coalesce(name, F.lit("")))
    case = None
    for group, words in MISSING_GROUPS.items():
        test = text.rlike("|".join(words))
        case = F.when(test, group) if case is None else case.when(test, group)
    return case.otherwise("unknown")


def matches_team(name_col: Column, id_col: Column, term: str) -> Column:
    """A 12-character id matches the id; anything else is a case-blind name pattern."""
    if len(term) == 12 and term.replace("-", "").isalnum():
        return id_col == term
    return name_col.rlike("(?i)" + term)
