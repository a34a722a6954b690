"""Text functions, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE_RANGES = r"[\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{F900}-\x{FAFF}\x{3000}-\x{303F}\x{FF00}-\x{FFEF}]"
HAN = r"[\x{4E00}-\x{9FFF}]"


# Signs that are no part of a subtitle's words; white space in any script.
SIGNS = "♪♫♬♩♭♮♯★☆■□●○▲▼◆◇►▻»«◄◅♦"
SPACE = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"


def normalise_line(text: Column) -> Column:
    """Tags and signs out, words broken by a hyphen at a line's end joined, white space collapsed, trimmed, lower case."""
    t = F.regexp_replace(text, r"<[^>]+>", "")
    t = F.regexp_replace(t, f"[{SIGNS}]", "")
    t = F.regexp_replace(t, rf"-{SPACE}*\n{SPACE}*", "")
    return F.lower(F.trim(F.regexp_replace(t, f"{SPACE}+", " ")))


def script_ratio(text: Column) -> Column:
    """Share of wide-script characters among those that are no white space; 0 for blank texts."""
    solid = F.length(F.regexp_replace(text, r"[ \t\r\n]", ""))
    return F.when(solid > 0, F.regexp_count(text, F.lit(WIDE_RANGES)) / solid).otherwise(F.lit(0.0))


def fits_screen(text: Column, lines: int = 3, per_line: int = 40, total: int = 140) -> Column:
    parts = F.split(text, "\n")
    return (F.size(parts) <= lines) & F.forall(parts, lambda x: F.length(x) <= per_line) & (F.length(text) <= total)


def cut_to_screen(text: Column, lines: int = 3, per_line: int = 40) -> Column:
    return F.array_join(F.transform(F.slice(F.split(text, "\n"), 1, lines), lambda x: F.substring(x, 1, per_line)), "\n")


def cut_to_length(text: Column, total: int = 140) -> Column:
    """The other form of the cut: the head of the whole text."""
    return F.substring(text, 1, total)


def episode_norm(no: Column) -> Column:
    """A number without leading zeros, anything else as it is."""
    return F.coalesce(no.try_cast("bigint").cast("string"), no)


def escape_markup(text: Column) -> Column:
    """Text as it may stand between tags and inside quoted attributes."""
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(sign), F.lit(name))
    return text


def name_tokens(name: Column, least: int = 3) -> Column:
    """The words of a name with at least ``least`` characters, lower case."""
    return F.filter(F.split(F.lower(name), f"{SPACE}+"), lambda t: F.length(t) >= least)


# An optional article or possessive, then two or more capitalised words.
TITLE_PHRASE = r"\b(?:as|becomes?)\s+(?:the\s+|a\s+|an\s+|his\s+|her\s+)?([A-Z][a-zA-Z]+(?:\s+[A-Z][a-zA-Z]+)+)"


def title_phrases(text: Column, tokens: Column) -> Column:
    """Titles of two to four words given in ``text`` (lower case), if it names someone by one of ``tokens``."""
    named = F.exists(tokens, lambda t: F.contains(F.lower(text), t))
    found = F.transform(F.regexp_extract_all(text, F.lit(TITLE_PHRASE), F.lit(1)), lambda p: F.lower(F.regexp_replace(p, r"\s+", " ")))
    fit = F.filter(found, lambda p: F.size(F.split(p, " ")).between(2, 4))
    return F.when(named, fit).otherwise(F.array().cast("array<string>"))


def clean_field(text: Column, limit: int) -> Column:
    """Line breaks to spaces, trimmed, cut to ``limit`` characters without a trailing space."""
    return F.rtrim(F.substring(F.trim(F.replace(text, F.lit("\n"), F.lit(" "))), 1, limit))


def file_name(text: Column, limit: int = 35) -> Column:
    return F.substring(F.trim(F.regexp_replace(text, r"[^\p{L}\p{N} _-]", "_")), 1, limit)


def strip_fence(text: Column) -> Column:
    """The inside of a fenced block, else the trimmed text."""
    inner = F.regexp_extract(text, r"(?s)^\s*```[a-z]*\n(.*?)\n?```\s*$", 1)
    return F.when(text.rlike(r"(?s)^\s*```[a-z]*\n.*```\s*$"), F.trim(inner)).otherwise(F.trim(text))


def drop_trailing_commas(text: Column) -> Column:
    return F.regexp_replace(text, r",\s*([}\]])", "$1")


def token_estimate(text: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(text) / 3).cast("int"))


def natural_key(text: Column, width: int = 12) -> Column:
    """Sort key: lower case, digit runs padded with zeros; longer runs of digits come after, in order of their length."""
    parts = F.regexp_extract_all(F.lower(text), F.lit(r"\d+|\D+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda x: F.when(~x.rlike(r"^\d"), x).when(F.length(x) <= width, F.lpad(x, width, "0")).otherwise(F.concat(F.lit("9" * width), F.lpad(F.length(x).cast("string"), 6, "0"), x))), "")


def human_count(n: Column) -> Column:
    return F.when(n >= 1_000_000, F.format_string("%.1fM", n / 1_000_000)).when(n >= 1000, F.format_string("%.1fK", n / 1000)).otherwise(n.cast("string"))


# Words that open a tension; endings that close one, in Han text also by the half-width mark.
SUSPENSE = r"[？?]\s*$|[….]{2,}\s*$|如果|否则|要么|不然|凭什么|难道|到底|究竟|你敢|怎么可能"
CLOSED_HAN, CLOSED = r"[。！!]\s*$", r"[。！]\s*$"


def opens_tension(text: Column) -> Column:
    return text.rlike(SUSPENSE)


def closes_tension(text: Column) -> Column:
    return F.when(text.rlike(HAN), text.rlike(CLOSED_HAN)).otherwise(text.rlike(CLOSED))


def has_cjk(text: Column, wide: bool = False) -> Column:
    """Whether a text holds any Han sign or, with ``wide``, any wide-script sign or mark."""
    return text.rlike(WIDE_RANGES if wide else HAN)
