from oreflow.functions.numbers import annual_salary, has_salary, saturating_int
from oreflow.functions.text import hashtags, jvm_hash, label_of, split_words, utf16_length
from oreflow.functions.priority import priority

__all__ = [
    "annual_salary",
    "has_salary",
    "hashtags",
    "jvm_hash",
    "label_of",
    "priority",
    "saturating_int",
    "split_words",
    "utf16_length",
]
