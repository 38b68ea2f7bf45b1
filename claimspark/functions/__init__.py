"""Column expressions shared by the operators; all run inside codegen."""

from claimspark.functions.columns import (
    back_to_front_period,
    blank_to_null,
    cco_check,
    cco_code,
    critique_line,
    digits,
    hour_text,
    joined,
    lenient_time,
    money,
    number_text,
    payee,
    poison_sum,
    split_cco,
    text_number,
    verdict,
)

__all__ = [
    "back_to_front_period",
    "blank_to_null",
    "cco_check",
    "cco_code",
    "critique_line",
    "digits",
    "hour_text",
    "joined",
    "lenient_time",
    "money",
    "number_text",
    "payee",
    "poison_sum",
    "split_cco",
    "text_number",
    "verdict",
]
