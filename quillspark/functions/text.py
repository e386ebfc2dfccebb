"""Scalar text functions (Column -> Column), all JVM-side built-ins.

Each function has a DuckDB twin named ``<name>_sql`` that takes a SQL
expression string; the twins are used only to write oracle queries.
Regexes are written so that Java's engine and RE2 read them the same way
(no look-around, explicit whitespace class instead of ``\\s``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values. Whitespace = the characters Python's str.split() splits on;
# URL / mention / digit patterns are the reference's preprocessing rules.
# ---------------------------------------------------------------------------
WS = (
    r"\t\n\x0B\f\r\x1C-\x1F \x85\xA0\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WORD_RE = f"[^{WS}]+"
# The same words and edges for Java's engine, which tests a class with many parts part by part: common characters come
# first and a run is not tried again from its middle.
WORD_JVM = (
    r"(?:[!-~\xA1-\x{167F}]++|[\x00-\x08\x0E-\x1B\x7F-\x84\x86-\x9F]++"
    f"|(?=[\\x{{1680}}-\\x{{10FFFF}}])[^{WS}])++"
)
_WS_JVM = (
    r"(?:[\t-\r\x1C-\x20\x85\xA0]"
    r"|(?=[\x{1680}-\x{3000}])[\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}])"
)
EDGE_WS_JVM = f"^{_WS_JVM}++|(?<!{_WS_JVM}){_WS_JVM}++$"
URL_COUNT_RE = r"https?://"
URL_MASK_RE = f"((www\\.[^{WS}]+)|(https?://[^{WS}]+)|(http?://[^{WS}]+))"
HTTP_TAIL_RE = f"http[^{WS}]+"
MENTION_RE = f"@[^{WS}]+"
DIGIT_RE = r"[0-9]"
SPACE_BREAK_RE = r"( \n| \t)+"
BACKSLASH_LINK_RE = r"https:\\+([a-zA-Z0-9.]+)?"
ASCII_LETTERS_RE = r"[a-zA-Z]+"
NOT_ALNUM_SPACE_RE = f"[^\\p{{L}}\\p{{N}}{WS}]"
EDGE_WS_RE = f"^[{WS}]+|[{WS}]+$"
ALL_WS_RE = f"[{WS}]+"
# Tokens: links, @mentions / #tags, words (with inner apostrophes), single symbols.
TOKEN_RE = (
    f"(?:https?://|www\\.)[^{WS}]+"
    f"|[@#][\\p{{L}}\\p{{N}}_]+"
    f"|[\\p{{L}}\\p{{N}}]+(?:['’][\\p{{L}}\\p{{N}}]+)*"
    f"|[^\\p{{L}}\\p{{N}}{WS}]"
)
SENTENCE_RE = r"[^.!?]+(?:[.!?]+|$)"
PAIR_SEPARATOR = "$$$"
PAIR_SEPARATOR_ESCAPED = "&&&"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(s: str) -> Column:
    return F.lit(s)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# G1 -----------------------------------------------------------------------
def word_count(t) -> Column:
    """Words = runs of non-whitespace (Python ``len(s.split())``); NULL -> 0."""
    return F.coalesce(F.regexp_count(_c(t), _lit(WORD_JVM)), F.lit(0)).cast("bigint")


def word_count_sql(t: str) -> str:
    return f"CAST(coalesce(len(regexp_extract_all({t}, {_q(WORD_RE)})), 0) AS BIGINT)"


# G2 -----------------------------------------------------------------------
def url_count(t) -> Column:
    return F.coalesce(F.regexp_count(_c(t), _lit(URL_COUNT_RE)), F.lit(0)).cast("bigint")


def url_count_sql(t: str) -> str:
    return f"CAST(coalesce(len(regexp_extract_all({t}, {_q(URL_COUNT_RE)})), 0) AS BIGINT)"


# G3 / G4 ------------------------------------------------------------------
def mask_urls(t) -> Column:
    return F.regexp_replace(F.lower(_c(t)), URL_MASK_RE, " URL ")


def mask_urls_sql(t: str) -> str:
    return f"regexp_replace(lower({t}), {_q(URL_MASK_RE)}, ' URL ', 'g')"


def mask_tweet(t) -> Column:
    s = F.regexp_replace(_c(t), URL_MASK_RE, " URL ")
    s = F.regexp_replace(s, HTTP_TAIL_RE, "")
    return F.regexp_replace(s, MENTION_RE, "@USER")


def mask_tweet_sql(t: str) -> str:
    s = f"regexp_replace({t}, {_q(URL_MASK_RE)}, ' URL ', 'g')"
    s = f"regexp_replace({s}, {_q(HTTP_TAIL_RE)}, '', 'g')"
    return f"regexp_replace({s}, {_q(MENTION_RE)}, '@USER', 'g')"


# G5 / G6 / G7 -------------------------------------------------------------
def digits_to_zero(t) -> Column:
    s = F.regexp_replace(_c(t), DIGIT_RE, "0")
    s = F.regexp_replace(s, SPACE_BREAK_RE, "")
    return F.regexp_replace(s, BACKSLASH_LINK_RE, "@")


def digits_to_zero_sql(t: str) -> str:
    s = f"regexp_replace({t}, {_q(DIGIT_RE)}, '0', 'g')"
    s = f"regexp_replace({s}, {_q(SPACE_BREAK_RE)}, '', 'g')"
    return f"regexp_replace({s}, {_q(BACKSLASH_LINK_RE)}, '@', 'g')"


def mask_letters(t) -> Column:
    return F.regexp_replace(digits_to_zero(t), ASCII_LETTERS_RE, "*")


def mask_letters_sql(t: str) -> str:
    return f"regexp_replace({digits_to_zero_sql(t)}, {_q(ASCII_LETTERS_RE)}, '*', 'g')"


def keep_alnum_space(t) -> Column:
    return F.regexp_replace(digits_to_zero(t), NOT_ALNUM_SPACE_RE, "")


def keep_alnum_space_sql(t: str) -> str:
    return f"regexp_replace({digits_to_zero_sql(t)}, {_q(NOT_ALNUM_SPACE_RE)}, '', 'g')"


# strip / G21 --------------------------------------------------------------
def strip(t) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace."""
    return F.regexp_replace(_c(t), EDGE_WS_JVM, "")


def strip_sql(t: str) -> str:
    return f"regexp_replace({t}, {_q(EDGE_WS_RE)}, '', 'g')"


def non_space_chars(t) -> Column:
    return F.length(F.regexp_replace(F.coalesce(_c(t), F.lit("")), ALL_WS_RE, "")).cast("bigint")


def non_space_chars_sql(t: str) -> str:
    return f"CAST(length(regexp_replace(coalesce({t}, ''), {_q(ALL_WS_RE)}, '', 'g')) AS BIGINT)"


# G10 / G11 ----------------------------------------------------------------
def tokenize(t) -> Column:
    """Social-media style tokens; empty tokens cannot occur. NULL -> []."""
    return F.coalesce(F.regexp_extract_all(_c(t), _lit(TOKEN_RE), 0), F.array().cast("array<string>"))


def tokenize_sql(t: str) -> str:
    return f"coalesce(regexp_extract_all({t}, {_q(TOKEN_RE)}), []::VARCHAR[])"


def sentences(t) -> Column:
    """Sentences ending in . ! or ? (or the text end), trimmed, empties dropped."""
    parts = F.regexp_extract_all(F.coalesce(_c(t), F.lit("")), _lit(SENTENCE_RE), 0)
    return F.filter(F.transform(parts, lambda s: strip(s)), lambda s: s != "")


def sentences_sql(t: str) -> str:
    return (
        f"list_filter(list_transform(regexp_extract_all(coalesce({t}, ''), {_q(SENTENCE_RE)}), "
        f"lambda s: {strip_sql('s')}), lambda s: s <> '')"
    )


def tokenized_sentences(t) -> Column:
    """Each sentence re-tokenized and joined by one space."""
    return F.transform(sentences(t), lambda s: F.array_join(tokenize(s), " "))


def tokenized_sentences_sql(t: str) -> str:
    return f"list_transform({sentences_sql(t)}, lambda s: array_to_string({tokenize_sql('s')}, ' '))"


# G14 ----------------------------------------------------------------------
def escape_separator(t) -> Column:
    return F.replace(_c(t), F.lit(PAIR_SEPARATOR), F.lit(PAIR_SEPARATOR_ESCAPED))


def escape_separator_sql(t: str) -> str:
    return f"replace({t}, '{PAIR_SEPARATOR}', '{PAIR_SEPARATOR_ESCAPED}')"


# B9 / G16 / G17 -----------------------------------------------------------
def truncate(t, n: int) -> Column:
    return F.substring(_c(t), 1, n)


def truncate_sql(t: str, n: int) -> str:
    return f"substr({t}, 1, {n})"


def random_window(t, n: int, draw: Column) -> Column:
    """n chars from a keyed random start when the text is longer than n."""
    c = _c(t)
    ln = F.length(c)
    start = ((draw % (ln - n + 1)) + 1).cast("int")
    return F.when(ln > n, c.substr(start, F.lit(n))).otherwise(c)


def random_window_sql(t: str, n: int, draw_sql: str) -> str:
    return (
        f"CASE WHEN length({t}) > {n} THEN substr({t}, CAST(({draw_sql} % (length({t}) - {n} + 1)) + 1 AS BIGINT), {n}) "
        f"ELSE {t} END"
    )


# G19 / G20 ----------------------------------------------------------------
def render_prompt(template: str, text_a, text_b) -> Column:
    """Fill ``{text_a}`` and ``{text_b}`` in a template that must hold both."""
    if "{text_a}" not in template or "{text_b}" not in template:
        raise ValueError("template must contain {text_a} and {text_b}")
    # Split on the placeholders so that braces inside the texts are never re-read.
    head, rest = template.split("{text_a}", 1)
    if "{text_b}" in head:
        raise ValueError("{text_a} must come before {text_b}")
    mid, tail = rest.split("{text_b}", 1)
    return F.concat(F.lit(head), F.coalesce(_c(text_a), F.lit("")), F.lit(mid),
                    F.coalesce(_c(text_b), F.lit("")), F.lit(tail))


def render_prompt_sql(template: str, a: str, b: str) -> str:
    head, rest = template.split("{text_a}", 1)
    mid, tail = rest.split("{text_b}", 1)
    return f"concat({_q(head)}, coalesce({a}, ''), {_q(mid)}, coalesce({b}, ''), {_q(tail)})"
