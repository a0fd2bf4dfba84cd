"""Text expressions (all JVM-side, no Python on the executors).

Java regular expressions differ from Python's on Unicode (``\\s`` and ``\\d``
are ASCII-only in Java, and Spark's ``trim`` strips only the blank), so the
character classes below are built from Python's own definitions by rule and
written with ``\\x{HHHH}`` escapes, which Java and RE2 (DuckDB) both read.
"""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlink.functions.cols import c


def _as_col(x) -> Column:
    return c(x) if isinstance(x, str) else x


def _char_class(codepoints, negate: bool = False) -> str:
    cps = sorted(set(codepoints))
    parts, i = [], 0
    while i < len(cps):
        j = i
        while j + 1 < len(cps) and cps[j + 1] == cps[j] + 1:
            j += 1
        a, b = cps[i], cps[j]
        parts.append(f"\\x{{{a:04X}}}" if a == b else f"\\x{{{a:04X}}}-\\x{{{b:04X}}}")
        i = j + 1
    return "[" + ("^" if negate else "") + "".join(parts) + "]"


@functools.lru_cache(maxsize=None)
def whitespace_class() -> str:
    """Every character Python's ``str.isspace`` accepts, as a regex class."""
    return _char_class(cp for cp in range(0x10000) if chr(cp).isspace())


@functools.lru_cache(maxsize=None)
def ascii_whitespace_class() -> str:
    """ASCII characters Python's ``\\s`` matches (includes 0x1C-0x1F)."""
    return _char_class(cp for cp in range(0x80) if chr(cp).isspace())


DIGITS = r"\p{Nd}+"          # Unicode decimal digits, as Python's \d on str


def rstrip_unicode(col) -> Column:
    """strip trailing whitespace in Python's sense (tab, newline, NBSP...)."""
    return F.regexp_replace(_as_col(col), whitespace_class() + "+$", "")


def strip_unicode(col) -> Column:
    """strip both ends."""
    ws = whitespace_class()
    return F.regexp_replace(_as_col(col), f"^{ws}+|{ws}+$", "")


def remove_dots(col) -> Column:
    """remove the literal '.' (not a pattern)."""
    return F.replace(_as_col(col), F.lit("."), F.lit(""))


def strip_digits(col) -> Column:
    """remove runs of (Unicode) digits."""
    return F.regexp_replace(_as_col(col), DIGITS, "")


def combine_columns(cols: list) -> Column:
    """join with one blank; nulls become empty text (double blanks stay)."""
    return F.concat_ws(" ", *[F.coalesce(_as_col(x).cast("string"), F.lit("")) for x in cols])


def emphasize(col) -> Column:
    """``*text*``; null and empty text stay empty."""
    x = _as_col(col)
    return F.when(F.coalesce(x, F.lit("")) == "", F.lit("")).otherwise(F.concat(F.lit("*"), x, F.lit("*")))


def hierarchical_select(cols_general_to_specific: list) -> Column:
    """The most specific non-null level."""
    return F.coalesce(*[_as_col(x) for x in reversed(cols_general_to_specific)])


def concat_description(a, b, sep: str = ", ") -> Column:
    """Null-propagating ``a + sep + b``."""
    return F.concat(_as_col(a), F.lit(sep), _as_col(b))


def words(col) -> Column:
    """Whitespace-separated words of a text (empty text has none)."""
    ws = whitespace_class()
    t = F.regexp_replace(_as_col(col), f"^{ws}+|{ws}+$", "")
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, ws + "+"))


@functools.lru_cache(maxsize=None)
def _whitespace_chars() -> str:
    return "".join(chr(cp) for cp in range(0x10000) if chr(cp).isspace())


def word_count(col) -> Column:
    """Number of whitespace-separated words: every whitespace character becomes
    a blank (``translate``), then a split on one blank (no regex engine) and
    the empty pieces removed."""
    ws = _whitespace_chars()
    blanks = F.translate(_as_col(col), ws, " " * len(ws))
    return F.size(F.array_remove(F.split(blanks, " "), "")).cast("long")


def wrap_words(col, n: int, sep: str = "<br>") -> Column:
    """break a text into lines of ``n`` words joined by ``sep``.

    Linear in the text: whitespace runs become one blank, then every ``n``-th
    blank becomes ``sep`` in a single left-to-right regex pass."""
    ws = whitespace_class()
    t = F.regexp_replace(_as_col(col), f"^{ws}+|{ws}+$", "")
    t = F.regexp_replace(t, ws + "+", " ")
    if n <= 1:
        return F.regexp_replace(t, " ", sep)
    return F.regexp_replace(t, f"((?:[^ ]+ ){{{n - 1}}}[^ ]+) ", "$1" + sep)


def share_label(label, share) -> Column:
    """``label (33.3%)``, one decimal, half-even."""
    pct = F.bround(_as_col(share) * 100.0, 1)
    return F.concat(_as_col(label), F.lit(" ("), F.format_number(pct, 1), F.lit("%)"))


# --- F8: NFKD -> ASCII -> collapse blanks -> trim ------------------------------------

@functools.lru_cache(maxsize=None)
def _nfkd_ascii_tables():
    """Per code point ASCII image of the NFKD form, derived from unicodedata.

    NFKD only reorders combining marks (never ASCII), so the ASCII part of a
    text's NFKD equals the concatenation of the per-character ASCII images.
    """
    single_from, single_to, multi = [], [], []
    for cp in range(0x80, 0x110000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        d = unicodedata.normalize("NFKD", ch)
        if d == ch:
            continue
        a = d.encode("ascii", "ignore").decode("ascii")
        if len(a) == 1:
            single_from.append(ch)
            single_to.append(a)
        elif len(a) > 1:
            multi.append((ch, a))
    return "".join(single_from), "".join(single_to), tuple(multi)


def normalize_text(col) -> Column:
    """F8: fold to ASCII by NFKD, drop the rest, collapse whitespace, trim.

    One ``translate`` maps every character whose ASCII image is one character
    (and ASCII whitespace to a blank). Rows that still hold non-ASCII
    characters (a one-range test) are cut into ASCII runs and single other
    characters; only the latter are looked up in a literal map of the few
    hundred multi-character images (ligatures, fractions, ...), anything else
    is dropped. Blank runs collapse and the ends are trimmed by a split on one
    blank (no regex engine) and a join.
    """
    sfrom, sto, multi = _nfkd_ascii_tables()
    aws = "".join(chr(cp) for cp in range(0x80) if chr(cp).isspace() and cp != 32)
    x = F.translate(_as_col(col), sfrom + aws, sto + " " * len(aws))
    m = F.create_map(*[F.lit(v) for kv in multi for v in kv])
    parts = F.regexp_extract_all(x, F.lit(r"[^\x00-\x7F]|[\x00-\x7F]+"), 0)
    expanded = F.array_join(F.transform(parts, lambda t: F.when(F.ascii(t) < 128, t).otherwise(
        F.coalesce(F.try_element_at(m, t), F.lit("")))), "")
    x = F.when(x.rlike(r"[^\x00-\x7F]"), expanded).otherwise(x)
    return F.array_join(F.array_remove(F.split(x, " "), ""), " ")


def cut_text(col, n: int = 400) -> Column:
    """the first ``n`` characters."""
    return F.substring(_as_col(col), 1, n)


def newline_to_blank(col) -> Column:
    """newline -> one blank (literal replace)."""
    return F.replace(_as_col(col), F.lit("\n"), F.lit(" "))


def tokens(col, min_len: int = 1) -> Column:
    """Lower-cased letter runs of a text (for overlap and term statistics)."""
    t = F.split(F.lower(_as_col(col)), r"[^\p{L}]+")
    return F.filter(t, lambda s: F.length(s) >= min_len)


def token_rows(df, col, min_len: int = 1, name: str = "term", keep: list | None = None):
    """One row per lower-cased letter run of length >= ``min_len`` (exploded
    and filtered as rows, which stays in generated code)."""
    x = df.select(*(keep or []), F.explode(F.split(F.lower(_as_col(col)), r"[^\p{L}]+")).alias(name))
    return x.where(F.length(name) >= min_len)


def char_profile(col, alphabet: str = "abcdefghijklmnopqrstuvwxyz0123456789") -> Column:
    """Character-count vector over ``alphabet`` of the lower-cased text.

    A deterministic, dependency-free embedder: the same vector is computable in
    any SQL engine, so every stage downstream of it can be oracle-checked.
    """
    t = F.lower(_as_col(col))
    n = F.length(t)
    return F.array(*[(n - F.length(F.replace(t, F.lit(ch), F.lit("")))).cast("double")
                     for ch in alphabet])
