from .exprs import (
    SUM_TYPE,
    band,
    compare_label,
    count_where,
    dec_round,
    dec_sum,
    exact_avg,
    flag,
    guard_zero,
    label_map,
    null_count,
    safe_div,
    share_pct,
    signed_sum,
    sum_where,
)
from .privacy import mask, mask_cpf, mask_email, mask_name, pseudonymize, resolve_salt, salted_sha256

__all__ = [
    "SUM_TYPE",
    "band", "compare_label", "count_where", "dec_round", "dec_sum", "exact_avg", "flag",
    "guard_zero", "label_map", "null_count", "safe_div", "share_pct", "signed_sum", "sum_where",
    "mask", "mask_cpf", "mask_email", "mask_name", "pseudonymize", "resolve_salt", "salted_sha256",
]
