"""Nested schema records, flat catalogs and compressed schema texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sqlloom.functions import ddl as D
from sqlloom.functions.text import computed

# DEFAULT_BARE tells that the default is a whole number or a truth value, which is rendered without quotes.
COLUMN = "struct<NAME:string,TYPE:string,NULLABLE:boolean,UNIQUE:boolean,DEFAULT:string,DEFAULT_BARE:boolean>"
FOREIGN_KEY = (
    "struct<COLUMNS:array<string>,FOREIGN_TABLE:string,REFERRED_COLUMNS:array<string>,"
    "ON_DELETE:string,ON_UPDATE:string>"
)
TABLE = (
    f"struct<TABLE_NAME:string,COLUMNS:array<{COLUMN}>,PRIMARY_KEY:array<string>,"
    f"FOREIGN_KEYS:array<{FOREIGN_KEY}>>"
)
# Fixed schema of nested schema records; never inferred.
RECORD = f"TABLES array<{TABLE}>"
# In JSON a default may be of any kind.
JSON_RECORD = RECORD.replace("DEFAULT:string,DEFAULT_BARE:boolean", "DEFAULT:variant")


def typed_defaults(tables) -> Column:
    """Tables parsed by ``JSON_RECORD`` in the form of ``RECORD``."""

    def column(c):
        kind = F.schema_of_variant(c["DEFAULT"])
        bare = (kind == "BIGINT") | (kind == "BOOLEAN")
        text = F.try_variant_get(c["DEFAULT"], "$", "string")
        return F.struct(
            c["NAME"].alias("NAME"), c["TYPE"].alias("TYPE"), c["NULLABLE"].alias("NULLABLE"), c["UNIQUE"].alias("UNIQUE"),
            F.when(kind != "VOID", text).alias("DEFAULT"), F.coalesce(bare, F.lit(False)).alias("DEFAULT_BARE"),
        )

    return F.transform(tables, lambda t: t.withField("COLUMNS", F.transform(t["COLUMNS"], column)))

# Spark types of declared column types, for users who build real tables.
SPARK_TYPES = {
    "bigint": "INT INTEGER TINYINT SMALLINT MEDIUMINT BIGINT INT2 INT8",
    "boolean": "BOOL BOOLEAN",
    "string": "CHARACTER CHAR NCHAR VARCHAR NVARCHAR TEXT CLOB MEDIUMTEXT LONGTEXT TINYTEXT TIME",
    "double": "REAL DOUBLE FLOAT",
    "decimal(38,18)": "NUMERIC DECIMAL",
    "date": "DATE",
    "timestamp": "DATETIME TIMESTAMP",
    "binary": "BLOB",
    "void": "NULL",
}


def spark_type(declared: str) -> str:
    """Spark type name for a declared column type; unknown types are strings."""
    words = declared.strip().upper()
    for several, one in (("UNSIGNED BIG INT", "BIGINT"), ("DOUBLE PRECISION", "DOUBLE"),
                         ("NATIVE CHARACTER", "CHAR"), ("VARYING CHARACTER", "VARCHAR")):
        words = words.replace(several, one)
    for name, declared_names in SPARK_TYPES.items():
        if words in declared_names.split():
            return name
    return "string"


def exploded_tables(records: DataFrame, key: str) -> DataFrame:
    """(key, table_no, table) for every table of a nested record; an empty record keeps one null row."""
    return records.select(key, F.posexplode_outer("TABLES").alias("table_no", "table"))


def exploded_columns(tables: DataFrame) -> DataFrame:
    """One row per column of every table."""
    kept = [c for c in tables.columns if c != "table"]
    return tables.select(
        *kept, F.col("table.TABLE_NAME").alias("table_name"),
        F.posexplode_outer("table.COLUMNS").alias("col_idx", "c"),
    ).select(
        *kept, "table_name", "col_idx",
        F.col("c.NAME").alias("col_name"), F.col("c.TYPE").alias("col_type"),
        F.col("c.NULLABLE").alias("nullable"), F.col("c.UNIQUE").alias("is_unique"),
        F.col("c.DEFAULT").alias("default_val"),
    )


def nested_tables(columns: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, table): flat catalog columns gathered into table records, column order kept.

    One group is the columns of one table.
    """
    bare = F.col("default_bare") if "default_bare" in columns.columns else F.lit(False)
    one = F.struct(
        "col_idx", F.col("col_name").alias("NAME"), F.col("col_type").alias("TYPE"),
        F.col("nullable").alias("NULLABLE"), F.col("is_unique").alias("UNIQUE"),
        F.col("default_val").alias("DEFAULT"), bare.alias("DEFAULT_BARE"),
    )
    ordered = F.transform(F.array_sort(F.collect_list(one)), lambda c: c.dropFields("col_idx"))
    table = F.struct(
        F.col("table_name").alias("TABLE_NAME"), F.col("_columns").alias("COLUMNS"),
        F.lit(None).cast("array<string>").alias("PRIMARY_KEY"),
        F.lit(None).cast(f"array<{FOREIGN_KEY}>").alias("FOREIGN_KEYS"),
    )
    return columns.groupBy(*keys, "table_name").agg(ordered.alias("_columns")).select(*keys, table.alias("table"))


def assembled(statements: DataFrame, key: str, order: str, text: str, name: str = "schema_sql") -> DataFrame:
    """(key, text): the statements of a schema in order, joined by blank lines.

    The result is one text per schema, so a schema must fit into one cell.
    """
    return statements.groupBy(key).agg(F.expr(f"listagg({text}, '\n\n') within group (order by {order})").alias(name))


def catalog_from_ddl(schemas: DataFrame, key: str, text: str) -> DataFrame:
    """(key, table_name, col_idx, col_name, col_type) from the tables that a schema text creates.

    Row-local: tables, then their column definitions, are exploded in place.  Of several
    definitions of a name, compared without case, the first counts.
    """
    named = computed(schemas.select(key, text), _t=D.create_tables(text))
    names = F.transform("_t", lambda t: F.lower(t["name"]))
    firsts = F.filter("_t", lambda t, i: F.array_position(F.col("_names"), F.lower(t["name"])) == i + 1)
    return (
        computed(named, _names=names)
        .select(key, F.explode(firsts).alias("_t"))
        .select(key, F.col("_t.name").alias("table_name"), D.column_definitions(F.col("_t.body")).alias("_d"))
        .select(key, "table_name", F.posexplode("_d").alias("col_idx", "_d"))
        .select(
            key, "table_name", "col_idx",
            D.definition_name(F.col("_d")).alias("col_name"), D.definition_type(F.col("_d")).alias("col_type"),
        )
    )


def compressed_schemas(catalog: DataFrame, key: str, max_columns: int = 8, name: str = "compressed") -> DataFrame:
    """(key, text): a line ``table(col:type, ...)`` per table, by table name.

    Only the columns that are shown are gathered.
    """
    shown = F.col("col_idx") < max_columns
    entry = F.struct("col_idx", F.concat("col_name", F.lit(":"), F.coalesce("col_type", F.lit(""))).alias("t"))
    lines = catalog.groupBy(key, "table_name").agg(
        F.array_sort(F.collect_list(F.when(shown, entry))).alias("_shown"),
        F.count(F.lit(1)).alias("_n"),
    ).select(
        key, "table_name",
        F.concat(
            "table_name", F.lit("("), F.array_join(F.col("_shown.t"), ", "),
            F.when(F.col("_n") > max_columns, F.lit(", ...")).otherwise(F.lit("")), F.lit(")"),
        ).alias("_line"),
    )
    return lines.groupBy(key).agg(
        F.expr("listagg(_line, '\n') within group (order by table_name)").alias(name)
    )


def table_columns(catalog: DataFrame, key: str) -> DataFrame:
    """(key, table_name, columns array) in column order."""
    return catalog.groupBy(key, "table_name").agg(
        F.array_sort(F.collect_list(F.struct("col_idx", "col_name"))).alias("_c")
    ).select(key, "table_name", F.col("_c.col_name").alias("columns"))

