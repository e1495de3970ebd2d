"""Text built from record fields: prompts, markdown, completions, messages."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.scalars import as_column

# Fixed value: the system message of conversational training records.
DEFAULT_SYSTEM_PROMPT = (
    "You are an expert in python programming. "
    "Answer the user question concisely and accurately."
)


def required_text(value: Column | str, name: str) -> Column:
    """The value as text; a null stops the job and names the field."""
    failure = F.raise_error(F.lit(f"prompt field {name} is null")).cast("string")
    return F.coalesce(as_column(value).cast("string"), failure)


def render_prompt(template: str, **fields: Column | str) -> Column:
    """Fill ``{name}`` places of a template with columns.

    A place without a field and a field without a place are both errors, and a
    null value stops the job: a prompt is never null or half filled.
    """
    parts: list[Column] = []
    used: set[str] = set()
    for literal, name, spec, conversion in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is None:
            continue
        if not name or spec or conversion:
            raise ValueError(f"only plain named places are allowed in a template: {template!r}")
        if name not in fields:
            raise ValueError(f"the template names {name!r}, which was not given")
        used.add(name)
        parts.append(required_text(fields[name], name))
    unused = set(fields) - used
    if unused:
        raise ValueError(f"fields without a place in the template: {sorted(unused)}")
    return F.concat(*parts) if parts else F.lit("")


def problem_markdown(
    task_name: Column | str,
    problem_statement: Column | str,
    canonical_solution: Column | str,
    test_code: Column | str,
) -> Column:
    """A problem as four markdown sections, flush left, with a final newline."""
    lines = [
        F.concat(F.lit("## "), as_column(task_name)),
        F.lit("### Problem Statement"), as_column(problem_statement),
        F.lit("### Canonical Solution"), F.lit("```python"), as_column(canonical_solution),
        F.lit("```"),
        F.lit("### Test Code"), F.lit("```python"), as_column(test_code), F.lit("```"),
        F.lit(""),
    ]
    pieces = [p for line in lines for p in (line, F.lit("\n"))][:-1]
    return F.concat(*pieces)


def thinking_completion(reasoning: Column | str, answer: Column | str) -> Column:
    """Prompt/completion layout: tags on their own lines, blank line before the answer."""
    return F.concat(
        F.lit("<think>\n"), as_column(reasoning), F.lit("\n</think>\n\n"), as_column(answer)
    )


def thinking_message(reasoning: Column | str, answer: Column | str) -> Column:
    """Conversational layout: tags and answer without line breaks."""
    return F.concat(F.lit("<think>"), as_column(reasoning), F.lit("</think>"), as_column(answer))


def chat_messages(
    question: Column | str,
    reasoning: Column | str,
    answer: Column | str,
    system_prompt: str = DEFAULT_SYSTEM_PROMPT,
) -> Column:
    """System, user and assistant message, in that order."""
    turns = [
        ("system", F.lit(system_prompt)),
        ("user", as_column(question)),
        ("assistant", thinking_message(reasoning, answer)),
    ]
    return F.array(*[
        F.struct(F.lit(role).alias("role"), content.alias("content")) for role, content in turns
    ])
