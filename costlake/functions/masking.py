"""PII masking as native column expressions (no Python UDF).

* e-mail: must be non-empty and contain ``@``; surrounding whitespace is
  stripped, the text lower-cased, the salt appended and the SHA-256 hex
  digest kept;
* phone: digits only, at least four, shown as ``XXX-XXX-`` + last four;
* ``is_masked``: e-mail token has no ``@`` and 64 characters, phone starts
  with ``XXX-XXX-``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from costlake.schemas import EMAIL_TOKEN_LENGTH, PHONE_MASK_PREFIX

# Leading/trailing whitespace as Python's str.strip() sees it (Unicode
# white space plus the ASCII separators 0x1C-0x1F).
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def check_salt(salt: str) -> str:
    if not salt:
        raise ValueError("Salt must not be empty")
    return salt


def email_is_valid(c: str | Column) -> Column:
    e = _col(c)
    return e.isNotNull() & (F.length(e) > 0) & F.contains(e, F.lit("@"))


def mask_email(c: str | Column, salt: str) -> Column:
    """Salted SHA-256 token of the normalised e-mail (no validity check)."""
    check_salt(salt)
    norm = F.lower(F.regexp_replace(_col(c), _EDGE_SPACE, ""))
    return F.sha2(F.concat(norm, F.lit(salt)), 256)


def phone_digits(c: str | Column) -> Column:
    return F.regexp_replace(_col(c), r"[^\p{Nd}]", "")


def phone_is_valid(c: str | Column) -> Column:
    return _col(c).isNotNull() & (F.length(phone_digits(c)) >= 4)


def redact_phone(c: str | Column) -> Column:
    d = phone_digits(c)
    return F.concat(F.lit(PHONE_MASK_PREFIX), F.substring(d, -4, 4))


def is_masked(c: str | Column, field_type: str) -> Column:
    v = _col(c)
    if field_type == "email":
        return ~F.contains(v, F.lit("@")) & (F.length(v) == EMAIL_TOKEN_LENGTH)
    if field_type == "phone":
        return F.startswith(v, F.lit(PHONE_MASK_PREFIX))
    return F.lit(False)
