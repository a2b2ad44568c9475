"""Prompt text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------------------
PROMPT_HEAD = "You are an AI assistant. Use the following context to answer the question.\n\nContext:\n"
PROMPT_MIDDLE = "\n\nQuestion:\n"
PROMPT_TAIL = "\n\nAnswer:"
CONTEXT_SEPARATOR = "\n\n"
# ------------------------------------------------------------------------------------------------


def build_prompt(context: Column, question: Column) -> Column:
    """Prompt of a context array and a question; null where there is no context."""
    joined = F.array_join(context, CONTEXT_SEPARATOR)
    return F.concat(F.lit(PROMPT_HEAD), joined, F.lit(PROMPT_MIDDLE), question, F.lit(PROMPT_TAIL))
