"""Prompt texts built from columns.

A prompt is a template with named slots.  Only the slots are contract; the wording is
ours and callers may pass their own template.
"""

from __future__ import annotations

import hashlib
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from sqlloom.functions.text import col, strip

QUESTION = """You write realistic questions that a database user might ask. Reply with one plaintext block only.

Write {count} different questions for this schema:
{schema}

{samples}Every question must need exactly {joins} JOIN(s), unless the schema has too few tables.
Mix filters, sorting, grouping and aggregates. Do not repeat the samples.

{tone}

Answer in this form, one question per line:
```plaintext
<First Question>
<2nd Question>
```"""
SAMPLES = """Sample questions for style, each needing exactly {joins} JOIN(s):
{lines}

"""
TONE_SPECIFIC = "Name tables and columns of the schema and use values that could be stored in it."
TONE_GENERAL = "Keep the wording general; do not name tables, columns or values."
QUESTION_RETRY = """{prompt}

The answer before this one could not be read (try {attempt}).
Reply with a single ```plaintext``` block, one question per line, and nothing else."""

GROWTH = """You design SQLite databases. Reply with SQLite DDL only.

Add exactly {n_new} new tables to this schema. Write only the new CREATE TABLE and CREATE INDEX
statements, in the style of the schema and with valid references, inside one ```sqlite``` block.
Leave existing tables alone.

Schema:
{schema}
"""
REPAIR = """You design SQLite databases. Reply with SQLite DDL only.

These statements did not work: {error}
Write the {n_new} new tables again, as valid SQLite DDL in one ```sqlite``` block.
Leave existing tables alone.

Schema:
{schema}
"""

SQL = """You translate questions to SQLite. Reply with one statement in one sql block.

Question: {question}

Use only the tables and columns below. Prefer readable SQL; joins, subqueries and WITH are fine.

Schema:
{schema}
"""
JUDGE = """You compare SQL candidates for one task. Reply with the best one, unchanged, in one sql block.

Task: {question}

Schema:
{schema}

{candidates}
"""
CANDIDATE = """[candidate {number}]
```sql
{sql}
```"""

PARAPHRASE = """You reword questions without changing what they ask. Reply with one plaintext block only.

Question:
{question}

Query that answers it:
```sql
{query}
```

Give {count} other wordings that ask for the same result, one per line, in a ```plaintext``` block
without numbering or remarks."""
PARAPHRASE_RETRY = """{prompt}

The answer before this one could not be read (try {attempt}).
Reply with a single ```plaintext``` block holding only the new wordings, one per line."""


def templates_digest() -> str:
    """Changes whenever the wording of a prompt does."""
    texts = {n: v for n, v in globals().items() if n.isupper() and isinstance(v, str)}
    return hashlib.sha256(repr(sorted(texts.items())).encode()).hexdigest()


def render(template: str, **slots) -> Column:
    """The template with its slots filled by columns (by name or expression) or plain values."""
    parts = []
    for text, slot, _, _ in Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if slot:
            value = slots[slot]
            parts.append(value.cast("string") if isinstance(value, Column) else F.lit(str(value)))
    return F.concat(*parts)


def question_prompt(schema, examples, example_joins, target_joins, specific, count: int, template=QUESTION) -> Column:
    """Ask for questions on a schema.

    ``examples`` is an array of sample questions (may be empty); ``specific`` chooses
    between naming tables and staying general.
    """
    listed = F.array_join(F.transform(examples, lambda e: F.concat(F.lit("- "), e)), "\n")
    samples = F.when(F.size(examples) > 0, render(SAMPLES, joins=col(example_joins), lines=listed)).otherwise(F.lit(""))
    tone = F.when(col(specific), F.lit(TONE_SPECIFIC)).otherwise(F.lit(TONE_GENERAL))
    return render(template, count=count, schema=strip(schema), samples=samples, joins=col(target_joins), tone=tone)


def question_retry(prompt, attempt: int) -> Column:
    return render(QUESTION_RETRY, prompt=col(prompt), attempt=attempt)


def growth_prompt(schema, n_new, template=GROWTH) -> Column:
    return render(template, n_new=col(n_new), schema=col(schema))


def repair_prompt(schema, n_new, last_error, template=REPAIR) -> Column:
    return render(template, error=F.coalesce(col(last_error), F.lit("")), n_new=col(n_new), schema=col(schema))


def sql_prompt(question, compressed_schema, template=SQL) -> Column:
    return render(template, question=col(question), schema=col(compressed_schema))


def judge_prompt(question, compressed_schema, candidates, template=JUDGE) -> Column:
    """``candidates`` is an array of SQL texts in candidate order."""
    listed = F.transform(candidates, lambda c, i: render(CANDIDATE, number=i + 1, sql=strip(c)))
    return render(
        template, question=col(question), schema=col(compressed_schema), candidates=F.array_join(listed, "\n")
    )


def paraphrase_prompt(question, query, count: int, template=PARAPHRASE) -> Column:
    return render(template, question=strip(question), query=strip(query), count=count)


def paraphrase_retry(prompt, attempt: int) -> Column:
    return render(PARAPHRASE_RETRY, prompt=col(prompt), attempt=attempt)
