"""Accent- and case-insensitive text keys."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower-case Latin letters and typographic marks without a Unicode
# decomposition, and their usual ASCII spelling.
UNDECOMPOSED = {
    "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ŋ": "ng",
    "ø": "o", "đ": "d", "ð": "d", "ħ": "h", "ı": "i", "ĸ": "k", "ł": "l", "ŧ": "t",
    "‘": "'", "’": "'", "ʼ": "'", "“": '"', "”": '"', "‐": "-", "‑": "-", "–": "-",
    " ": " ",
}

# Lower-case Greek after ELOT 743, letter by letter.
GREEK = {
    "α": "a", "β": "v", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "i", "θ": "th", "ι": "i", "κ": "k",
    "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t",
    "υ": "y", "φ": "f", "χ": "ch", "ψ": "ps", "ω": "o",
}
# Its groups of letters, longest first: a pattern and what it becomes.
GREEK_GROUPS = (
    (r"([αεη])[υύ](?=[θκξπσςτφχψ]|$|[^α-ωά-ώ])", "$1φ"),
    (r"([αεη])[υύ]", "$1β"),
    (r"ο[υύ]", "ou"),
    (r"γ(?=[γξχ])", "ν"),
    (r"(?<![α-ωά-ώ])μπ", "b"),
)
# Lower-case Cyrillic after ICAO Doc 9303 (letters of several languages as in Russian).
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "к": "k",
    "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f",
    "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "ie", "ы": "y", "ь": "", "э": "e",
    "ю": "iu", "я": "ia", "є": "ie", "і": "i", "ґ": "g", "ђ": "d", "ј": "j", "љ": "lj", "њ": "nj",
    "ћ": "c", "џ": "dz", "ѕ": "dz",
}

# Latin-1 Supplement, Latin Extended-A and -B, Latin Extended Additional.
_LATIN = [*range(0x00A0, 0x0250), *range(0x1E00, 0x1F00)]
_COMBINING = "".join(map(chr, range(0x0300, 0x0370)))


_OTHERS = [*range(0x0370, 0x0530), *range(0x1F00, 0x2000)]  # Greek, Cyrillic, Greek Extended


def _base(letter: str) -> str:
    return "".join(p for p in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(p))


def _spellings() -> dict[str, str]:
    """ASCII spelling of every accented lower-case Latin letter, by decomposition."""
    spelled = dict(UNDECOMPOSED)
    for letter in map(chr, _LATIN):
        base = _base(letter)
        if letter == letter.lower() != base and base.isascii() and base.isalnum():
            spelled.setdefault(letter, base)
    return spelled


def _other_spellings() -> dict[str, str]:
    """Spelling of Greek and Cyrillic letters and of their accented forms."""
    plain = GREEK | CYRILLIC
    accented = {chr(c): plain[_base(chr(c))] for c in _OTHERS if _base(chr(c)) in plain}
    return accented | plain


_SPELLINGS = _spellings()
_OTHER_SPELLINGS = _other_spellings()
_OTHER = "[\u0370-\u052f\u1f00-\u1fff]"


def _spelled(col: Column, spellings: dict[str, str], deleted: str = "") -> Column:
    """Single letters at once (marks in ``deleted`` go), then those that become several."""
    single = {k: v for k, v in spellings.items() if len(v) == 1}
    gone = deleted + "".join(k for k, v in spellings.items() if not v)
    col = F.translate(col, "".join(single) + gone, "".join(single.values()))
    for letter, letters in spellings.items():
        if len(letters) > 1:
            col = F.replace(col, F.lit(letter), F.lit(letters))
    return col


def _foreign(lowered: Column) -> Column:
    """Greek and Cyrillic in Latin letters: groups first, then letter by letter."""
    for pattern, letters in GREEK_GROUPS:
        lowered = F.regexp_replace(lowered, pattern, letters)
    return _spelled(lowered, _OTHER_SPELLINGS)


def fold(col: Column) -> Column:
    """Hashable join key, equal for names that differ only in case, accents or romanisation.

    Latin letters are spelled in ASCII, Greek and Cyrillic ones by their public romanisation;
    other scripts are only lower-cased.  Text that is ASCII already (as many bytes as
    characters) skips the transliteration, text without other scripts their part of it.
    """
    lowered = F.lower(col)
    latin = F.when(lowered.rlike(_OTHER), _foreign(lowered)).otherwise(lowered)
    spelled = _spelled(latin, _SPELLINGS, _COMBINING)
    return F.when(F.length(col) == F.octet_length(col), lowered).otherwise(spelled)
