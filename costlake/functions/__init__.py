"""Column expressions (pure, JVM-side, codegen-friendly)."""

from costlake.functions.dates import month_key, strict_date, week_key
from costlake.functions.masking import (
    email_is_valid, is_masked, mask_email, phone_digits, phone_is_valid, redact_phone,
)
from costlake.functions.money import (
    allocate_even, cost_or_zero, money, pct_change, round_money, to_double,
)

__all__ = [
    "allocate_even", "cost_or_zero", "email_is_valid", "is_masked", "mask_email",
    "money", "month_key", "pct_change", "phone_digits", "phone_is_valid",
    "redact_phone", "round_money", "strict_date", "to_double", "week_key",
]
