"""Data-quality column expressions (all builtin, JVM side, codegen friendly)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import AMOUNT_TYPE

# ---- fixed values (must equal the reference's behaviour) ------------------
# Date patterns, tried in this order; the first that parses wins.
CUSTOMER_DATE_PATTERNS = ("MM/dd/yyyy", "dd/MM/yyyy", "yyyy-MM-dd")
ACCOUNT_DATE_PATTERNS = ("MM/dd/yyyy", "dd/MM/yyyy", "MMM dd yyyy")
TRANSACTION_DATE_PATTERNS = ("MM/dd/yyyy", "dd/MM/yyyy", "MMM dd yyyy")
# Quality labels.
VALID_EFFECTIVE_DATE = "ValidDate"
INVALID_EFFECTIVE_DATE = "InvalidEffectiveDate"
VALID_OPEN_DATE = "ValidOpenDate"
INVALID_OPEN_DATE = "InvalidOpenDate"
# ---------------------------------------------------------------------------


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


_SHAPE = {"y": r"[+-]?\d+", "M": r"\d{1,2}", "d": r"\d{1,2}", "MMM": r"[A-Za-z]+",
          "H": r"\d{1,2}", "m": r"\d{1,2}", "s": r"\d{1,2}"}


def pattern_shape(pattern: str) -> str | None:
    """A permissive regex every text must match for ``pattern`` to parse it.

    Used only as a pre-check: texts of the wrong shape skip the datetime parser
    (whose failures are expensive); texts of the right shape are still parsed
    and validated by Spark.  ``None`` when the pattern has letters this helper
    does not know (then no pre-check is made).
    """
    import re
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        j = i
        while j < len(pattern) and pattern[j] == ch:
            j += 1
        run = pattern[i:j]
        if ch.isalpha():
            key = "MMM" if ch == "M" and len(run) >= 3 else ch
            if key not in _SHAPE:
                return None
            out.append(_SHAPE[key])
        else:
            out.append(re.escape(run))
        i = j
    return "^" + "".join(out) + "$"


def parse_date(c: Column | str, patterns: Sequence[str], trim: bool = False) -> Column:
    """First pattern that parses, else NULL.

    Patterns are strict (``1/5/2025`` does not match ``MM/dd/yyyy``) and an
    ambiguous text is read with the first pattern, so ``05/03/2025`` is May 3.
    """
    text = F.trim(_c(c)) if trim else _c(c)
    tries = []
    for p in patterns:
        shape = pattern_shape(p)
        parsed = F.try_to_date(text, p)
        tries.append(parsed if shape is None else F.when(text.rlike(shape), parsed))
    return F.coalesce(*tries)


def quality_label(parsed: Column | str, valid: str, invalid: str) -> Column:
    """Label from an already parsed value (parse once, flag from the result)."""
    return F.when(_c(parsed).isNull(), F.lit(invalid)).otherwise(F.lit(valid))


def parse_amount(c: Column | str, strict: bool = False) -> Column:
    """Thousands separators removed, text to DECIMAL(10,2) (half-up).

    ``strict=False`` gives NULL for unparsable text, ``strict=True`` raises
    like a plain ANSI cast.
    """
    cleaned = F.regexp_replace(_c(c), ",", "")
    return cleaned.cast(AMOUNT_TYPE) if strict else cleaned.try_cast(AMOUNT_TYPE)


def clean_name(c: Column | str) -> Column:
    """Removes every ``@``; blanks and case stay as they are."""
    return F.regexp_replace(_c(c), "@", "")


def title_trimmed(c: Column | str) -> Column:
    """Trim then title case (country)."""
    return F.initcap(F.trim(_c(c)))


def title_only(c: Column | str) -> Column:
    """Title case without trimming (currency: ``UGX `` becomes ``Ugx ``)."""
    return F.initcap(_c(c))


def to_flag(c: Column | str) -> Column:
    """Text flag (``0``/``1``/``true``/...) to BOOLEAN, bad text to NULL."""
    return _c(c).try_cast("boolean")


def to_int(c: Column | str) -> Column:
    return _c(c).try_cast("int")
