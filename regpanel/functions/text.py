"""Text functions: name sanitising, Latin->ASCII transliteration, first-only
replace, split helpers.  All are JVM-side expressions (no Python UDF); the
transliteration table is generated from Unicode decomposition data."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from regpanel.constants import BAND_RECODE, MISSING_TOKEN
from regpanel.functions.exprs import col

# Latin letters without a canonical decomposition and their
# ASCII spelling (single-letter targets), as in the Latin-ASCII transform.
_SINGLE_FIXED = {
    "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ħ": "h", "Ħ": "H",
    "ı": "i", "ŧ": "t", "Ŧ": "T", "ŀ": "l", "Ŀ": "L", "ð": "d", "Ð": "D", "ƒ": "f",
}
# Letters that expand to two ASCII letters.
_MULTI_FIXED = {
    "ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE",
    "þ": "th", "Þ": "TH", "ĳ": "ij", "Ĳ": "IJ",
}

# Signs and quotes of the Latin-ASCII transform.
_SIGNS_FIXED = {
    "º": "o", "ª": "a", "‘": "'", "’": "'", "‚": ",", "“": '"', "”": '"', "„": '"',
    "–": "-", "—": "-", "‐": "-", "¡": "!", "¿": "?", "×": "*", "÷": "/",
}

_RANGES = [(0x00C0, 0x024F), (0x1E00, 0x1EFF)]


def _build_translate_table() -> tuple[str, str]:
    """Rule: a letter in the Latin-1 Supplement / Extended-A/B / Extended
    Additional blocks maps to the ASCII base of its NFKD decomposition."""
    src, dst = list(_SIGNS_FIXED), list(_SIGNS_FIXED.values())
    for lo, hi in _RANGES:
        for cp in range(lo, hi + 1):
            ch = chr(cp)
            if ch in _MULTI_FIXED:
                continue
            if ch in _SINGLE_FIXED:
                src.append(ch)
                dst.append(_SINGLE_FIXED[ch])
                continue
            base = "".join(c for c in unicodedata.normalize("NFKD", ch)
                           if not unicodedata.combining(c))
            if len(base) == 1 and base.isascii() and base.isalpha():
                src.append(ch)
                dst.append(base)
    return "".join(src), "".join(dst)


_TR_FROM, _TR_TO = _build_translate_table()


_NON_ASCII = r"[^\x00-\x7F]"


def _translit(c: Column, multi: dict[str, str]) -> Column:
    out = c
    for k, v in multi.items():
        out = F.replace(out, F.lit(k), F.lit(v))
    out = F.regexp_replace(F.translate(out, _TR_FROM, _TR_TO), r"\p{M}", "")
    # pure-ASCII text (the common case) skips the whole chain
    return F.when(c.rlike(_NON_ASCII), out).otherwise(c)


def translit_ascii(x) -> Column:
    """Latin -> ASCII (stringi ``Latin-ASCII``), case preserved."""
    return _translit(col(x), _MULTI_FIXED)


def translit_lower(x) -> Column:
    """lower() then transliterate (lowering first also folds upper-case accents,
    so only the lower-case multi-letter forms need replacing)."""
    return _translit(F.lower(col(x)), {k: v for k, v in _MULTI_FIXED.items() if k == k.lower()})


def replace_first(x, pattern: str, replacement: str = "") -> Column:
    """stringr str_replace: only the first match is replaced."""
    repl = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(col(x), f"(?s)^(.*?)(?:{pattern})", "$1" + repl)


def replace_first_literal(x, needle: str, replacement: str = "") -> Column:
    """First occurrence of a literal ``needle`` replaced (one linear search,
    no regular expression)."""
    c = col(x)
    pos = F.instr(c, needle)
    tail = F.substr(c, pos + len(needle))
    head = F.substring(c, F.lit(1), pos - 1)
    return F.when(pos > 0, F.concat(head, F.lit(replacement), tail)).otherwise(c)


def sanitize(x) -> Column:
    """Name sanitiser: spaces -> '_', first '(' and first ')' removed,
    Latin -> ASCII, lower case."""
    c = F.replace(col(x), F.lit(" "), F.lit("_"))
    c = replace_first_literal(c, "(")
    c = replace_first_literal(c, ")")
    return translit_lower(c)  # == lower(translit_ascii(c)) for Latin letters


def split_nth(x, sep: str, n: int) -> Column:
    """str_split_i(x, sep, n): the n-th part (1-based), NULL when absent."""
    return F.nullif(F.split_part(col(x), F.lit(sep), F.lit(n)), F.lit(""))


def separate_code_name(x, sep: str = " ") -> tuple[Column, Column]:
    """tidyr separate(into=c(code, name), sep, extra="merge", fill="left")."""
    parts = F.split(col(x), re.escape(sep), 2)
    two = F.size(parts) == 2
    code = F.when(two, F.element_at(parts, 1))
    name = F.when(two, F.element_at(parts, 2)).otherwise(F.element_at(parts, 1))
    return code, name


def band_recode(x) -> Column:
    """Size-band labels: '-' -> ' a ', then 'GE' -> '+' (1-9 -> 1 a 9, GE10 -> +10)."""
    c = col(x)
    for a, b in BAND_RECODE:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def missing_token(x, token: str = MISSING_TOKEN) -> Column:
    """if_else(as.character(x) == token, NA, as.character(x))."""
    return F.nullif(col(x).cast("string"), F.lit(token))


# ---------------------------------------------------------------- Python twins
def sanitize_name(s: str | None) -> str | None:
    """Python twin of :func:`sanitize` for column names."""
    if s is None:
        return None
    s = s.replace(" ", "_").replace("(", "", 1).replace(")", "", 1)
    return ascii_name(s.lower())


_ASCII = str.maketrans({**dict(zip(_TR_FROM, _TR_TO, strict=True)), **_MULTI_FIXED})


def ascii_name(s: str) -> str:
    """Python twin of :func:`translit_ascii`, from the same table."""
    return "".join(c for c in s.translate(_ASCII) if not unicodedata.category(c).startswith("M"))


def clean_names(names: list[str | None]) -> list[str]:
    """janitor clean_names: snake_case ASCII, leading digit -> 'x' prefix,
    NULL -> 'na', empty -> 'x', duplicates get '_2', '_3', ..."""
    out, seen = [], {}
    for n in names:
        if n is None:
            base = "na"
        else:
            s = ascii_name(str(n))
            s = re.sub("['\"]", "", s)  # quotes leave no gap
            s = s.replace("%", "_percent_").replace("#", "_number_")
            s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
            s = re.sub(r"[^A-Za-z0-9]+", "_", s).strip("_").lower()
            base = s or "x"
            if base[0].isdigit():
                base = "x" + base
        k = seen.get(base, 0) + 1
        seen[base] = k
        out.append(base if k == 1 else f"{base}_{k}")
    return out
