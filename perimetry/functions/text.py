"""String rules as SQL text: blank trimming, identifier validity, years, numbers."""

from __future__ import annotations

import re
from functools import reduce

# Texts that stand for "no identifier", compared in lower case without outer blanks.
PLACEHOLDER_IDS = ("none", "nan", "", "null")

# Field names are alike if these replacements make them equal, once in lower case.
NAME_STEPS = ((r"^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""), (" ", "_"))


def strip(c: str) -> str:
    """Remove any leading and trailing white space, Unicode included (``trim`` removes blanks only)."""
    return rf"regexp_replace({c}, r'(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$', '')"


def is_valid_id(c: str) -> str:
    """True for text that is neither missing nor a placeholder. Never null."""
    words = ", ".join(f"'{w}'" for w in PLACEHOLDER_IDS)
    return f"coalesce(lower({strip(c)}) NOT IN ({words}), false)"


def is_given(c: str) -> str:
    """True unless the text is null, empty, ``0`` or not-a-number. Never null."""
    return f"coalesce(lower({c}) NOT IN ('', '0', 'nan'), false)"


def canonical_year(c: str) -> str:
    """``2003.0`` and ``2003`` are one year; anything else stays as it is."""
    return rf"regexp_replace({c}, r'^(-?\d+)\.0+$', '$1')"


def to_number(c: str) -> str:
    """Text to double; null where the text is not a plain decimal number."""
    plain = rf"rlike({strip(c)}, r'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$')"
    return f"CASE WHEN {plain} THEN try_cast({strip(c)} AS double) END"


def plain_name(name: str) -> str:
    """Spelling under which field names are compared."""
    return reduce(lambda text, step: re.sub(*step, text), NAME_STEPS, name.lower())


def normalize_name(c: str) -> str:
    """``plain_name`` of a column."""
    return reduce(lambda sql, step: f"regexp_replace({sql}, r'(?U){step[0]}', '{step[1]}')", NAME_STEPS, f"lower({c})")
