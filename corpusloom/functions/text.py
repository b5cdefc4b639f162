"""Text columns: cleaning, normalisation, hashing, counting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space (Unicode, also U+001C to U+001F), as a word character, as a mark to drop.
# White space is every separator and a few controls: few tests a character, so the expressions run fast.
WS = r"[\p{Z}\x09-\x0d\x1c-\x1f\x85]"
NOT_WS = r"[^\p{Z}\x09-\x0d\x1c-\x1f\x85]"
NOT_WORD = r"[^\p{L}\p{N}_]+"
ZERO_WIDTH = r"\ufeff\u200b-\u200d"
PICTOGRAPHS = r"\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}"
MARKS = r"\u064b-\u0652\u0670\u0640"
RECITATION_MARKS = r"\u06d6-\u06ed"
FOLD_FROM = "٠١٢٣٤٥٦٧٨٩آأإةى"
FOLD_TO = "0123456789اااهي"
SCRIPT = r"\u0600-\u06ff"


def nfc(text: Column, assume_nfc: bool = False) -> Column:
    """Canonical composition; can be skipped for sources known to be composed.

    Spark has no function for it, but the ICU library that its collations need: no text goes to Python. Results are
    those of ``unicodedata`` for all characters that its Unicode version has; newer ones are composed too.
    """
    composed = F.call_function("java_method", F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(False))
    return text if assume_nfc else F.when(text.isNotNull(), composed)


def squeeze(text: Column) -> Column:
    """Runs of white space become one space, none at the ends."""
    return F.trim(F.regexp_replace(text, WS + "+", " "))


def clean(text: Column) -> Column:
    """Ends stripped of white space, then of quotes; zero-width characters and pictographs dropped; white space squeezed."""
    text = F.regexp_replace(F.btrim(squeeze(text), F.lit("\"'")), f"[{ZERO_WIDTH}{PICTOGRAPHS}]+", "")
    return F.trim(F.regexp_replace(text, "  +", " "))


def normalize_light(text: Column, assume_nfc: bool = False) -> Column:
    """For hashing: marks and elongation dropped, letters kept as they are."""
    return F.regexp_replace(nfc(text, assume_nfc), f"[{MARKS}{RECITATION_MARKS}]+", "")


def text_hash(text: Column, assume_nfc: bool = False) -> Column:
    """12 hex digits of the SHA-1 of the lightly normalised, squeezed text."""
    return F.substring(F.sha1(F.encode(squeeze(normalize_light(text, assume_nfc)), "UTF-8")), 1, 12)


def normalize_for_comparison(text: Column, assume_nfc: bool = False) -> Column:
    """For error rates: marks dropped, digits and letter variants folded, all else but word characters to single spaces, lower case."""
    text = F.translate(F.regexp_replace(nfc(text, assume_nfc), f"[{MARKS}]+", ""), FOLD_FROM, FOLD_TO)
    return F.lower(F.trim(F.regexp_replace(text, NOT_WORD, " ")))


def word_count(text: Column) -> Column:
    """Runs of what is not white space; null for null."""
    return F.regexp_count(text, F.lit(NOT_WS + "+"))


def script_ratio(text: Column, script: str = SCRIPT) -> Column:
    """Share of the script among characters that are not white space; null where there are none."""
    return F.try_divide(F.length(F.regexp_replace(text, f"[^{script}]+", "")), F.length(F.regexp_replace(text, WS + "+", "")))


def looks_like_script(text: Column, least: float = 0.3, script: str = SCRIPT) -> Column:
    return F.coalesce(script_ratio(text, script) >= least, F.lit(False))
