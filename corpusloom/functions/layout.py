"""Document and prompt layouts as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed
from .text import sanitize_text


def _text(c: Column | str) -> Column:
    return F.lit(c) if isinstance(c, str) else c


def default_if_empty(c: Column, default: str = fixed.DEFAULT_SYSTEM) -> Column:
    return F.when(c == "", F.lit(default)).otherwise(c)


def join_prompt(instruction: Column, extra: Column, sep: str) -> Column:
    """Instruction and optional input; a missing part counts as empty, the separator stays."""
    return F.concat(F.coalesce(instruction, F.lit("")), F.lit(sep), F.coalesce(extra, F.lit("")))


def fixed_system(kind: str) -> str:
    return fixed.CODE_SYSTEM if kind == "code" else ""


def format_instruct(system: Column | str, user: Column, assistant: Column) -> Column:
    """One instruction document, or ``''`` when the user or the assistant part is empty."""
    head = default_if_empty(sanitize_text(_text(system)))
    user, assistant = sanitize_text(user), sanitize_text(assistant)
    doc = F.concat(
        F.lit(fixed.DOC_OPEN + "System: "), head,
        F.lit("\n\n### User: "), user,
        F.lit("\n\n### Assistant: "), assistant,
        F.lit(fixed.DOC_CLOSE + "\n"),
    )
    return F.when((user == "") | (assistant == ""), F.lit("")).otherwise(doc)


def format_pretrain(c: Column, min_chars: int = fixed.MIN_TEXT_CHARS) -> Column:
    """One plain document, or ``''`` when fewer than ``min_chars`` code points remain."""
    clean = sanitize_text(c)
    doc = F.concat(F.lit(fixed.DOC_OPEN), clean, F.lit(fixed.DOC_CLOSE + "\n"))
    return F.when(F.length(clean) < min_chars, F.lit("")).otherwise(doc)


def render_chat_prompt(user: Column) -> Column:
    before, after = fixed.CHAT_PROMPT
    return F.concat(F.lit(before), user, F.lit(after))


def extract_answer(c: Column) -> Column:
    answer = F.substring_index(c, fixed.ANSWER_DELIMITER, -1)
    for ending in fixed.ANSWER_ENDINGS:
        answer = F.replace(answer, F.lit(ending), F.lit(""))
    return answer
