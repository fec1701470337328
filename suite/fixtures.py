"""Input views that are derived from the given tables by SQL which Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# About fifteen tables a schema, whatever the number of tables.
SCHEMA_ID = "cast(floor(p_partkey/60)*4+(p_partkey*p_size)%4 as bigint)"

VIEWS = {
    "fx_tables": """
select """ + SCHEMA_ID + """ as schema_id, p_partkey as table_no,
 replace(p_name,' ','_')||'_'||cast(p_partkey as varchar(20)) as table_name,
 'CREATE TABLE '||replace(p_name,' ','_')||'_'||cast(p_partkey as varchar(20))||' ('||chr(10)
 ||'  id INTEGER NOT NULL,'||chr(10)||'  label TEXT DEFAULT ''a,b'','||chr(10)
 ||case when p_size%2=0 then '  price DECIMAL(10,2),'||chr(10) else '' end
 ||case when p_size%3=0 then '  parent_id INTEGER REFERENCES t0 (id) ON DELETE CASCADE,'||chr(10) else '' end
 ||case when p_size%5=0 then '  FOREIGN KEY (label) REFERENCES t1 (label),'||chr(10) else '' end
 ||'  PRIMARY KEY (id)'||chr(10)||');' as ddl
from part""",
    "fx_columns": """
select """ + SCHEMA_ID + """ as schema_id, p_partkey as table_no,
 replace(p_name,' ','_')||'_'||cast(p_partkey as varchar(20)) as table_name, c.col_idx,
 case c.col_idx when 0 then 'id' when 1 then 'order' when 2 then '2nd_label' else 'amount' end as col_name,
 case c.col_idx when 0 then 'INTEGER' when 1 then 'VARCHAR(255)' when 3 then 'DECIMAL' end as col_type,
 c.col_idx <> 0 as nullable, c.col_idx = 0 as is_unique,
 case c.col_idx when 1 then 'it''s' when 3 then '0' end as default_val
from part cross join (select 0 as col_idx union all select 1 union all select 2 union all select 3) c
where c.col_idx <= p_size%4""",
    "fx_triplets": """
select o_orderkey as rec_id,
 'Which '||lower(o_orderpriority)||' orders does customer '||cast(o_custkey as varchar(20))||' have?' as prompt,
 case o_orderkey%10 when 0 then 'SELECT 1;' when 1 then '-- nothing here' when 2 then ';'
 when 3 then 'SELECT a.x FROM t a JOIN u b ON a.id = b.id WHERE a.x >= '||cast(o_custkey as varchar(20))||';'
 when 4 then 'WITH c AS (SELECT id FROM t) SELECT c.id FROM c JOIN u ON u.id = c.id join v ON v.id = u.id;'
 when 5 then 'SELECT x -- pick x FROM t WHERE y = 1;'
 when 6 then 'INSERT INTO t (x) VALUES ('||cast(o_custkey as varchar(20))||');'
 when 7 then 'select x from t union select x from u;'
 when 8 then 'DELETE FROM t WHERE id = '||cast(o_orderkey as varchar(20))||';'
 else 'SELECT x, COUNT(*) FROM t GROUP BY x ORDER BY 2 DESC LIMIT 5;' end as sql_statement,
 case o_orderkey%3 when 0 then '' when 1 then 'CREATE TABLE t (id INT, x TEXT DEFAULT ''a,b'');'
 else 'CREATE TABLE t (id INT, x DECIMAL(5,2)); CREATE TABLE u (id INT, '||lower(o_orderpriority)||'_v TEXT, PRIMARY KEY (id));' end as schema
from orders""",
    "fx_questions": """
select (conv_id*1000+turn)*2 as row_idx, 'schema_'||cast(cast(floor(conv_id/4) as bigint) as varchar(20))||'.sql' as schema_file,
 replace(text,chr(10),' ') as question from conversations where role='user'
union all
select (conv_id*1000+turn)*2+1, 'schema_'||cast(cast(floor(conv_id/4) as bigint) as varchar(20))||'.sql',
 replace(text,chr(10),' ') from conversations where role='user' and conv_id%7=0""",
    "fx_examples": """
select replace(text,chr(10),' ') as nl_prompt,
 case when conv_id%17=0 then 'n/a' else cast(conv_id%13 as varchar(20)) end as num_joins
from conversations where role='assistant' and conv_id%13 not in (3,4,7)""",
    "fx_responses": """
select cast(floor(doc_id/4) as bigint) as item_id, doc_id%4 as attempt,
 case doc_id%6 when 0 then '```plaintext'||chr(10)||text||chr(10)||'```'
 when 1 then text when 2 then '1. '||replace(text, chr(10), chr(10)||'2) ')
 when 3 then '```plaintext'||chr(10)||'<First Question>'||chr(10)||'```' when 4 then ''
 else '```plaintext'||chr(10)||'draft'||chr(10)||'```'||chr(10)||'```plaintext'||chr(10)||text||chr(10)||'```' end as raw
from documents""",
    "fx_candidates": """
select cast(floor(o_orderkey/4) as bigint) as item_id, o_orderkey%4 as round_no,
 case o_orderkey%7 when 0 then 'no sql here'
 when 1 then '```sql'||chr(10)||'SELECT  id FROM t'||chr(10)||'```'
 when 2 then '```sql'||chr(10)||'select id from t;'||chr(10)||'```'
 when 3 then '```'||chr(10)||'SELECT nope FROM missing;'||chr(10)||'```'
 when 4 then '```sql'||chr(10)||'SELECT 1; SELECT 2;'||chr(10)||'```'
 when 5 then '```sql SELECT id FROM u; trailing'
 else 'Answer: SELECT COUNT(*) FROM t WHERE id = '||cast(o_custkey as varchar(20))||';' end as raw
from orders""",
    "fx_judge": """
select item_id, case item_id%4 when 0 then '```sql'||chr(10)||'SELECT id  FROM t;'||chr(10)||'```'
 when 1 then '```sql'||chr(10)||'SELECT x FROM elsewhere;'||chr(10)||'```'
 when 2 then '' else 'the first one' end as raw
from (select distinct cast(floor(o_orderkey/4) as bigint) as item_id from orders) i""",
    "fx_jsonl": """
select event_id as line_no,
 case when event_id%13=0 then '' when event_id%11=0 then substr(props,1,4) else props end as line
from events""",
    "fx_files": """
select case when doc_id%9=0 then '' else 'data/'||source end as path,
 case when doc_id%31=0 then '' when doc_id%29=0 then '/abs/doc_'||cast(doc_id as varchar(20))||'.sql'
 when doc_id%23=0 then 'doc_'||cast(doc_id as varchar(20))||'.Failed.sql'
 else 'doc_'||cast(doc_id as varchar(20))||'.sql' end as filename,
 doc_id%5 as n_tables
from documents""",
    "fx_marked": """
select 'schema_'||cast(s_suppkey as varchar(20))||'.sql' as file_name,
 case s_suppkey%6 when 0 then 'True' when 1 then 'yes' when 2 then '1' when 3 then ' y ' when 4 then 'false' else '' end as foreign_key
from supplier""",
}

# The same rows without a join, for Spark.
SPARK_VIEWS = {
    **VIEWS,
    "fx_columns": VIEWS["fx_columns"].replace(
        """from part cross join (select 0 as col_idx union all select 1 union all select 2 union all select 3) c
where c.col_idx <= p_size%4""",
        "from (select *, explode(sequence(0, p_size%4)) as col_idx from part) c",
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view over the tables in a folder."""
    for t in TABLES:
        if re.search(rf"\bfrom {t}\b", SPARK_VIEWS[name]):
            table(spark, sf_dir, t).createOrReplaceTempView(t)
    return spark.sql(SPARK_VIEWS[name])


def with_views(sql: str) -> str:
    """A DuckDB query with the views it names put in front as common table expressions.

    The query may start with a comma and more expressions of its own.
    """
    used = [f"{n} AS ({q.strip()})" for n, q in VIEWS.items() if re.search(rf"\b{n}\b", sql)]
    sql = sql.strip()
    if sql.startswith(","):
        return "WITH " + (", ".join(used) + sql if used else sql[1:])
    return ("WITH " + ", ".join(used) + " " if used else "") + sql
