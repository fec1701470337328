"""Fixed values that results depend on: word lists, lookup tables, patterns and formats.

Everything here is data, not logic.  Patterns are in Java syntax; ``(?U)`` makes
``\\s``, ``\\w``, ``\\b`` and ``\\d`` follow Unicode.
"""

# SQL keywords reported by the command list, in no particular priority.
SQL_COMMANDS = (
    "WITH", "SELECT", "INSERT", "UPDATE", "DELETE",
    "CREATE", "ALTER", "DROP", "TRUNCATE",
    "UNION", "INTERSECT", "EXCEPT",
    "MERGE", "CALL",
)

# Statement kinds, tested in this order; anything else is OTHER.
STATEMENT_KINDS = ("SELECT", "INSERT", "UPDATE", "DELETE", "CREATE", "DROP", "ALTER")

# Words that end a stray line comment in flattened SQL.
COMMENT_STOP_WORDS = ("SELECT", "WITH", "INSERT", "UPDATE", "DELETE", "FROM", "JOIN")

# First words of table-level constraints, which are not columns.
TABLE_CONSTRAINT_WORDS = ("PRIMARY", "FOREIGN", "UNIQUE", "CHECK", "CONSTRAINT", "INDEX")

# Placeholder strings that mark a response as a copied template.
TEMPLATE_STRINGS = (
    "<First Question>",
    "<2nd Question>",
    "<Nth Question>",
    "```",
    "<3rd Question>",
    "<4th Question>",
    "<5th Question>",
    "plaintext",
    "<Second Question>",
    "<Fifth Question>",
    "<|Start of a new question|>",
)

# Column types accepted as they are (compared in lower case, whole string).
ACCEPTED_TYPES = (
    "NULL", "INTEGER", "REAL", "TEXT", "BLOB",
    "INT", "TINYINT", "SMALLINT", "MEDIUMINT", "BIGINT",
    "UNSIGNED BIG INT", "INT2", "INT8", "BOOLEAN", "BOOL",
    "CHARACTER", "CHAR", "NCHAR", "NATIVE CHARACTER", "VARCHAR",
    "NVARCHAR", "VARYING CHARACTER", "CLOB",
    "MEDIUMTEXT", "LONGTEXT", "TINYTEXT",
    "NUMERIC", "DECIMAL", "DOUBLE", "DOUBLE PRECISION", "FLOAT",
    "DATE", "DATETIME", "TIME", "TIMESTAMP",
)

# Names the DDL renderer puts in double quotes.
RENDER_QUOTED_NAMES = (
    "ABSTRACT", "ALIAS", "CHECK", "COLLATE", "COLUMN", "CONSTRAINT",
    "CREATE", "DATABASE", "DEFAULT", "DELETE", "DESC", "DISTINCT",
    "DROP", "EXCLUSIVE", "EXISTS", "INDEX", "INDEXED", "INHERIT",
    "JOIN", "KEY", "LIMIT", "MATCH", "NATURAL", "NOT", "PRIMARY",
    "REFERENCES", "SELECT", "TABLE", "TEMP", "TEMPORARY", "UNIQUE",
    "UPDATE", "USING", "VIEW", "TO", "AS", "COMMIT", "BUILD", "VALUES",
    "TRANSACTION", "ORDER", "OFFSET", "FETCH", "INSERT", "REPLACE",
    "INTO", "IS", "NULL", "LIKE", "GLOB", "REGEXP", "ESCAPE", "EXPLAIN",
    "FROM", "GROUP",
)

# SQLite reserved words, quoted by identifier quoting.
RESERVED_WORDS = tuple(
    """
    ABORT ACTION ADD AFTER ALL ALTER ANALYZE AND AS ASC ATTACH AUTOINCREMENT
    BEFORE BEGIN BETWEEN BY CASCADE CASE CAST CHECK COLLATE COLUMN COMMIT
    CONFLICT CONSTRAINT CREATE CROSS CURRENT_DATE CURRENT_TIME CURRENT_TIMESTAMP
    DATABASE DEFAULT DEFERRABLE DEFERRED DELETE DESC DETACH DISTINCT DROP EACH
    ELSE END ESCAPE EXCEPT EXCLUSIVE EXISTS EXPLAIN FAIL FOR FOREIGN FROM FULL
    GLOB GROUP HAVING IF IGNORE IMMEDIATE IN INDEX INDEXED INITIALLY INNER
    INSERT INSTEAD INTERSECT INTO IS ISNULL JOIN KEY LEFT LIKE LIMIT MATCH
    NATURAL NO NOT NOTNULL NULL OF OFFSET ON OR ORDER OUTER PLAN PRAGMA
    PRIMARY QUERY RAISE RECURSIVE REFERENCES REGEXP REINDEX RELEASE RENAME
    REPLACE RESTRICT RIGHT ROLLBACK ROW ROWS SAVEPOINT SELECT SET TABLE TEMP
    TEMPORARY THEN TO TRANSACTION TRIGGER UNION UNIQUE UPDATE USING VACUUM
    VALUES VIEW VIRTUAL WHEN WHERE WITH WITHOUT
    """.split()
)

# Foreign-key action spellings and their SQL form.
FOREIGN_KEY_ACTIONS = {
    "SetNull": "SET NULL",
    "Cascade": "CASCADE",
    "Restrict": "RESTRICT",
    "NoAction": "NO ACTION",
    "SetDefault": "SET DEFAULT",
}

# Spellings of true in a flag list (after trim and lower case).
TRUE_SPELLINGS = ("true", "1", "yes", "y")

# Join-count labels run from 0 to MAX_JOINS.
MAX_JOINS = 10

# Question length kept by enrichment, and the shortest query kept.
QUESTION_LENGTH = (20, 1024)
SHORTEST_QUERY = 20

# Answer used when an item has no usable candidate.
FALLBACK_SQL = "SELECT 1;"

# Origin marks of written records.
QUESTION_SOURCE = "semi-synthetic"
PARAPHRASE_TYPE = "question_paraphrase"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Comment in front of a quarantined text.
QUARANTINE_HEAD = "-- Execution failed: "

# Drop reasons of enrichment.
REASON_NO_SQL = "Error generating SQL"
REASON_ONLY_COMMENTS = "Only comments present"

# Patterns for counting and finding.
TOKEN_RUN = r"[A-Za-z0-9_%/*.+<>!=\\-]+"
JOIN_WORD = r"(?iU)\bjoin\b"
CREATE_TABLE = r"(?iU)\bCREATE\s+TABLE\b"
CREATE_TEMPORARY_TABLE = r"(?iU)\bCREATE\s+(?:TEMP|TEMPORARY\s+)?TABLE\b"
TABLE_BODY = (
    r"(?isU)CREATE\s+(?:TEMP|TEMPORARY\s+)?TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?"
    r"(?:\"[^\"]+\"|`[^`]+`|\[[^\]]+\]|[\w.]+)\s*\((.*?)\)\s*;"
)
TABLE_OR_INDEX_STATEMENT = r"(?isU)\b(CREATE\s+(?:TABLE|INDEX)\b.*?;)"
TABLE_STATEMENT = r"(?isU)(CREATE\s+TABLE(?:\s+IF\s+NOT\s+EXISTS)?.*?;)"
INDEX_STATEMENT = r"(?isU)(CREATE\s+(?:UNIQUE\s+)?INDEX(?:\s+IF\s+NOT\s+EXISTS)?.*?;)"
FOREIGN_KEY_WORDS = r"(?iU)\bFOREIGN\s+KEY\b|\bREFERENCES\b"
BLOCK_COMMENT = r"(?s)/\*.*?\*/"

# Fenced blocks in model responses.
SQL_FENCE = r"(?isU)```sql\b\s*(.*?)\s*```"
ANY_FENCE = r"(?sU)```+\s*(.*?)\s*```+"
SQL_FENCE_OPEN = r"(?isU)```sql\b.*"
SQLITE_FENCE = r"(?isU)```sqlite\s*(.*?)\s*```"
NAMED_FENCE = r"(?sU)```[\w-]*\s*(.*?)\s*```"
