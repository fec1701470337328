"""Column -> Column expressions: plain text, SQL text, DDL text, model responses, prompts."""
