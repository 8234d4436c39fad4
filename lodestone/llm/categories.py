"""Category spellings: ``Open Qa``, ``open-qa``, ``openQA`` and ``open_qa: Some Entity`` name one category."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.llm.ledger import letters

# What separates a category from an entity label that follows it.
_SEPARATOR = r"\s*(?:[/>:|]|\s[-–—]+\s|[(\[])\s*"


def base_key(category: Column) -> Column:
    """Letters and digits of the category without its entity label; '' for null, empty and blank."""
    return letters(F.element_at(F.split(category, _SEPARATOR, 2), 1))


def entity_key(category: Column) -> Column:
    """Letters and digits of the entity label, or null where there is none."""
    key = letters(F.try_element_at(F.split(category, _SEPARATOR, 2), F.lit(2)))
    return F.when(key != "", key)
