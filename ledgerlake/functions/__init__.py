from .clean import (ACCOUNT_DATE_PATTERNS, CUSTOMER_DATE_PATTERNS, TRANSACTION_DATE_PATTERNS,
                    clean_name, parse_amount, parse_date, quality_label, title_only,
                    title_trimmed, to_flag, to_int)
from .stats import half_up_share

__all__ = [
    "ACCOUNT_DATE_PATTERNS", "CUSTOMER_DATE_PATTERNS", "TRANSACTION_DATE_PATTERNS",
    "clean_name", "parse_amount", "parse_date", "quality_label", "title_only",
    "title_trimmed", "to_flag", "to_int", "half_up_share",
]
