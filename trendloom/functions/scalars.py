"""Column helpers shared by every stage: rounding, stripping, hashing, case."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Characters that count as whitespace when text is split or stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a character class (valid in Java regex and in RE2).
WHITESPACE_CLASS = (
    r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# Punctuation that names and posts are normalised over. Colon, semicolon,
# double and curly quotes and $ + = < > are deliberately not members.
PUNCTUATION_CLASS = r"['.&,!?/\\()\[\]_*@#%^~`|-]"
# A run of both classes. Latin characters are listed one by one: Java looks those up in a table, ranges one after another.
_BREAK_RUN = (
    r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20\x85\xa0\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}" + PUNCTUATION_CLASS[1:] + "+"
)
# Spellings that win over title case, keyed by their lower-case form.
CANONICAL_NAMES = ["Samsung", "Lenovo", "Fujifilm", "CeraVe", "L'Oréal"]
# ----------------------------------------------------------------------------

_CASED = r"\p{IsUppercase}\p{IsLowercase}\p{Lt}"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def np_round(c: Column | str, digits: int) -> Column:
    """Half-even rounding of the scaled value; never yields -0.0."""
    scale = float(10**digits)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def micro(c: Column | str) -> Column:
    """A score in whole millionths. Integer sums do not depend on the order of tasks."""
    return F.rint(_col(c) * F.lit(1e6)).cast("bigint")


def micro_mean(total: Column, count: Column) -> Column:
    """Mean of a score from the sum of its ``micro`` values; null without values."""
    n = F.when(count > 0, count)
    return total / (n * F.lit(1e6))


def safe_ratio(num: Column | str, den: Column | str, if_zero: Column | float) -> Column:
    """num / den with a zero denominator replaced by ``if_zero`` (must be non-zero)."""
    d = _col(den)
    repl = if_zero if isinstance(if_zero, Column) else F.lit(float(if_zero))
    return _col(num) / F.when(d == 0, repl).otherwise(d)


def strip(c: Column | str) -> Column:
    """Remove leading and trailing Unicode whitespace (``trim`` knows only spaces)."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def or_empty(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def first_truthy(*cols: Column | str) -> Column:
    """First value that is neither null nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(_col(c), F.lit("")) for c in cols], F.lit(""))


def head(c: Column | str, n: int | None) -> Column:
    """The first ``n`` characters; the whole text where ``n`` is None."""
    return _col(c) if n is None else F.substring(_col(c), 1, n)


def norm_text(c: Column | str) -> Column:
    """Lower case, punctuation runs to one space, whitespace collapsed, stripped."""
    return F.trim(F.regexp_replace(F.lower(_col(c)), _BREAK_RUN, " "))


def tokens(c: Column | str) -> Column:
    """Whitespace tokens; an empty or blank text has none."""
    s = strip(c)
    return F.when(s == "", F.array().cast("array<string>")).otherwise(
        F.split(s, WHITESPACE_CLASS + "+")
    )


def norm_tokens(c: Column | str) -> Column:
    """``norm_text`` of every whitespace token, positions kept (may hold "").

    The punctuation class has no whitespace member, so normalising the whole
    text once and splitting at the original boundaries equals normalising each
    token. A newline marks the boundaries: no other newline is left by then.
    """
    stripped = strip(c)
    marked = F.regexp_replace(F.lower(stripped), WHITESPACE_CLASS + "+", "\n")
    spaced = F.regexp_replace(marked, PUNCTUATION_CLASS + "+", " ")
    parts = F.split(F.trim(F.regexp_replace(spaced, " ?\n ?", "\n")), "\n")
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(parts)


def title_case(c: Column | str) -> Column:
    """Capitalise every run of cased letters, also after digits ("3m" -> "3M")."""
    runs = F.regexp_extract_all(_col(c), F.lit(f"([{_CASED}]+|[^{_CASED}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def is_upper(c: Column) -> Column:
    return c.rlike(r"\p{IsUppercase}") & ~c.rlike(r"[\p{IsLowercase}\p{Lt}]")


def is_lower(c: Column) -> Column:
    return c.rlike(r"\p{IsLowercase}") & ~c.rlike(r"[\p{IsUppercase}\p{Lt}]")


def bare_name(c: Column | str) -> Column:
    """Punctuation deleted; empty just where ``display_name`` is."""
    return strip(F.regexp_replace(_col(c), PUNCTUATION_CLASS + "+", ""))


def display_name(c: Column | str) -> Column:
    """Presentable brand name: punctuation deleted, odd capitalisation repaired."""
    # a lambda's argument is computed once, an expression wherever it is named
    return F.get(F.transform(F.array(bare_name(c)), _spelled), F.lit(0))


def _spelled(b: Column) -> Column:
    titled = title_case(b)
    canonical = titled
    for name in CANONICAL_NAMES:
        canonical = F.when(F.lower(b) == name.lower(), F.lit(name)).otherwise(canonical)
    odd = F.substring(b, 2, 1_000_000).rlike(r"\p{IsUppercase}") & b.rlike(r"\p{IsLowercase}")
    return (
        F.when(b == "", F.lit(""))
        .when(b.rlike(r"\A[A-Z0-9]{2,6}\z"), b)
        .when(odd | is_upper(b), canonical)
        .when(is_lower(b), titled)
        .otherwise(b)
    )


def stable_hash(*cols: Column | str) -> Column:
    """First 24 hex digits of SHA-256 over the parts joined by two pipes."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]
    return F.substring(F.sha2(F.concat_ws("||", *parts), 256), 1, 24)


def json_numbers(**cols: Column | str) -> Column:
    """A flat JSON object of numbers, nulls kept, in keyword order."""
    parts = []
    for i, (key, c) in enumerate(cols.items()):
        lead = "{" if i == 0 else ", "
        parts += [F.lit(f'{lead}"{key}": '), F.coalesce(_col(c).cast("string"), F.lit("null"))]
    return F.concat(*parts, F.lit("}"))
