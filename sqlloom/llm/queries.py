"""The registered queries of this subpackage and, where SQL can express them, their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sqlloom.llm import exact, jaccard, lines, mixing, packing, ppm, quality, records, simhash, spelling, substrings, toxicity, vectorcodes

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(_documents(spark, sf_dir))


def op2_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = records.tokenized(_documents(spark, sf_dir), tokenizer_path(WORD_TOKENIZER))
    return index.select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    kept = lines.dedup_lines(docs.select("doc_id", "text", F.length("text").alias("n_before")))
    # A line break goes with a removed line, so lengths tell whether anything was taken.
    return kept.select(
        "doc_id",
        (F.coalesce(F.length("text"), F.lit(0)) < F.col("n_before")).alias("changed"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    return toxicity.fit(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(_documents(spark, sf_dir), toxicity_model(spark, sf_dir))


def op5_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(_documents(spark, sf_dir))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.dedup_substrings(_documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), tokenizer_path(BYTE_TOKENIZER))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(_documents(spark, sf_dir))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size")).alias("taken"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(_documents(spark, sf_dir)).select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op10_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.scores(_documents(spark, sf_dir))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vectorcodes.compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digits = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    return codes.select(
        "vec_id", F.array_join(digits, "").alias("code"), "error", "label_error", F.lit(books.sha256() if books else None).alias("codebooks_sha256")
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_documents(spark, sf_dir))


def op13_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_groups(_documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash, op2_records, op3_lines, op4_toxicity, op5_exact, op6_substrings, op7_packing, op8_mixing, op9_quality, op10_ppm,
        op11_vector_codes, op12_spelling, op13_jaccard,
    )
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL_BLANKS = "' '||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
SQL_WORD = r"[^\x20\x09-\x0D]+"



def _codebook_sql() -> str:
    """All rounds of training, one after the other, and the last assignment."""

    def nearest(n):
        product = "list_inner_product"
        return f"""n{n} AS MATERIALIZED (SELECT a.vec_id, a.label, a.p, any_value(a.x) AS x,
 min({{'d': {product}(a.x, a.x) - 2 * {product}(a.x, b.x) + {product}(b.x, b.x), 'entry': b.entry}}) AS best
 FROM parts a JOIN b{n} b USING (p) GROUP BY ALL)"""

    rounds = ",\n".join(
        f"""{nearest(n)},
m{n} AS (SELECT p, entry, list(v ORDER BY i) AS x FROM (SELECT p, best.entry AS entry, i, floor(sum(x[i]) / count(*)) AS v
 FROM (SELECT p, best, x, unnest(range(1, len(x) + 1)) AS i FROM n{n}) GROUP BY ALL) GROUP BY ALL),
b{n + 1} AS MATERIALIZED (SELECT b.p, b.entry, coalesce(m.x, b.x) AS x FROM b{n} b LEFT JOIN m{n} m USING (p, entry))"""
        for n in range(vectorcodes.ROUNDS)
    )
    last = vectorcodes.ROUNDS
    return f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({vectorcodes.SCALE} * x::double)) AS v FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, label, p, v[p * len(v) // {vectorcodes.PARTS} + 1 : (p + 1) * len(v) // {vectorcodes.PARTS}] AS x
 FROM kept, (SELECT unnest(range({vectorcodes.PARTS})) AS p)),
b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS entry, x FROM parts QUALIFY entry < {vectorcodes.ENTRIES}),
{rounds},
{nearest(last)},
book AS (SELECT sha256(string_agg(cast(cast(v AS bigint) AS varchar), ',' ORDER BY p, entry, i)) AS codebooks_sha256
 FROM (SELECT p, entry, unnest(x) AS v, unnest(range(len(x))) AS i FROM b{last})),
coded AS (SELECT vec_id, label, string_agg(lower(printf('%02x', cast(best.entry AS int))), '' ORDER BY p) AS code, cast(sum(best.d) AS bigint) AS error
 FROM n{last} GROUP BY ALL)
SELECT vec_id, code, error, cast(sum(error) OVER (PARTITION BY label) AS bigint) AS label_error, codebooks_sha256 FROM coded, book"""


def _crc32_table() -> list[int]:
    def step(c):
        return c >> 1 ^ (0xEDB88320 if c & 1 else 0)

    found = []
    for c in range(256):
        for _ in range(8):
            c = step(c)
        found.append(c)
    return found


SPELLING_SQL = f"""
WITH RECURSIVE crc AS (SELECT {_crc32_table()}::bigint[] AS t),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), '{UPPER}', '{LOWER}') AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= {spelling.LEAST_LENGTH} GROUP BY ALL),
coded AS (SELECT *, hex(encode(coalesce(cast(doc_id AS varchar), '')||':'||run)) AS code FROM counted),
hashed AS (SELECT run, n, xor(list_reduce(list_transform(range(1, length(code), 2), lambda i: ('0x'||substr(code, i, 2))::bigint),
  lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295::bigint), 4294967295::bigint) AS h FROM coded, crc),
words AS (SELECT CASE WHEN h % {spelling.DELETE_ONE_IN} = 0 THEN substr(run, 1, h % length(run))||substr(run, h % length(run) + 2) ELSE run END AS word, sum(n) AS n
  FROM hashed GROUP BY 1),
vocabulary AS MATERIALIZED (SELECT word, cast(n AS bigint) AS n FROM words WHERE length(word) >= {spelling.LEAST_LENGTH} AND n >= {spelling.LEAST_COUNT}),
shorter AS (SELECT word, n, substr(word, 1, i - 1)||substr(word, i + 1) AS less, substr(word, 1, i - 1)||'*'||substr(word, i + 1) AS key
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)),
near AS (SELECT a.word, b.word AS other, b.n FROM shorter a JOIN shorter b USING (key) WHERE a.word <> b.word
  UNION SELECT s.word, v.word, v.n FROM shorter s JOIN vocabulary v ON s.less = v.word
  UNION SELECT v.word, s.word, s.n FROM shorter s JOIN vocabulary v ON s.less = v.word),
best AS (SELECT word, min({{'less': -n, 'other': other}}) AS b, count(*) AS n_near FROM near GROUP BY word),
forms AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= {spelling.RATIO} * v.n THEN b.other END AS form,
  CASE WHEN -b.less >= {spelling.RATIO} * v.n THEN -b.less END AS form_n FROM vocabulary v LEFT JOIN best USING (word)),
walk(word, here, onward) AS (SELECT word, word, form FROM forms UNION ALL SELECT w.word, f.word, f.form FROM walk w JOIN forms f ON w.onward = f.word)
SELECT f.word, f.form, w.here AS root, f.n, f.n_near, cast(f.form_n AS bigint) AS form_n FROM forms f JOIN walk w ON f.word = w.word AND w.onward IS NULL"""

JACCARD_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SQL_WORD}') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {jaccard.SHINGLE} THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - {jaccard.SHINGLE - 2}), lambda i: array_to_string(w[i : i + {jaccard.SHINGLE - 1}], ' ')) END) AS s FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM both_ JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * k >= {jaccard.PERCENT} * (x.n + y.n - k)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, to_) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, b FROM reach r JOIN ways ON r.to_ = a)
SELECT r.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(to_) AS component_id FROM reach r LEFT JOIN sizes USING (doc_id) GROUP BY r.doc_id"""

ORACLES = {
    "op3_lines": f"""
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
counted AS (SELECT doc_id, n, trim(line, {SQL_BLANKS}) AS x FROM lines WHERE trim(line, {SQL_BLANKS}) <> ''),
windows AS (SELECT doc_id, n, x AS a, lead(x, 1) OVER w AS b, lead(x, 2) OVER w AS c, lead(n, 1) OVER w AS n2, lead(n, 2) OVER w AS n3
 FROM counted WINDOW w AS (PARTITION BY doc_id ORDER BY n)),
turns AS (SELECT doc_id, n, n2, n3, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, n) AS turn FROM windows WHERE n3 IS NOT NULL),
removed AS (SELECT doc_id, n FROM turns WHERE turn > 1 UNION SELECT doc_id, n2 FROM turns WHERE turn > 1 UNION SELECT doc_id, n3 FROM turns WHERE turn > 1),
kept AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE r.n IS NULL), '') AS text, count(r.n) AS gone
 FROM lines LEFT JOIN removed r USING (doc_id, n) GROUP BY doc_id)
SELECT d.doc_id, coalesce(length(k.text), 0) < length(d.text) AS changed, CASE WHEN d.text IS NULL THEN NULL ELSE sha256(k.text) END AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)""",
    "op5_exact": f"""
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM d WINDOW same AS (PARTITION BY text_sha256)""",
    "op6_substrings": rf"""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '{SQL_WORD}')) AS w,
  generate_subscripts(regexp_extract_all(coalesce(text, ''), '{SQL_WORD}'), 1) AS n FROM documents),
windows AS (SELECT doc_id, n, string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS s,
  lead(n, 12) OVER (PARTITION BY doc_id ORDER BY n) AS last FROM w),
repeats AS (SELECT doc_id, n, doc_id > min(doc_id) OVER (PARTITION BY s) AS hit FROM windows WHERE last IS NOT NULL),
marked AS (SELECT w.doc_id, w.n, w.w, coalesce(bool_or(r.hit) OVER (PARTITION BY w.doc_id ORDER BY w.n ROWS BETWEEN 12 PRECEDING AND CURRENT ROW), false) AS gone
  FROM w LEFT JOIN repeats r ON r.doc_id = w.doc_id AND r.n = w.n),
sums AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, string_agg(w, ' ' ORDER BY n) FILTER (WHERE NOT gone) AS kept
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN sums USING (doc_id)""",
    "op8_mixing": rf"""
WITH sizes AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{SQL_WORD}')) AS size,
  md5('{mixing.SEED}:'||coalesce(cast(doc_id AS varchar), 'null')) AS draw FROM documents),
weighed AS (SELECT source, cast(sum(size) AS bigint) AS source_size, sum(size) * 2.0::double AS most,
  (list_value(5.0, 2.0, 1.0)[cast((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS int)])::double AS weight FROM sizes GROUP BY source),
leveled AS (SELECT *, (sum(source_size) OVER () * 1.5::double - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST
   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST
   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own_level FROM weighed),
level AS (SELECT arg_min(own_level, most / weight) AS level FROM leveled WHERE own_level * weight <= most),
targets AS (SELECT source, source_size, coalesce(least(most, weight * level), most) AS target FROM leveled, level),
placed AS (SELECT s.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
  coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY draw, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, cast(size AS bigint) AS size, source_size, target,
 cast((whole + CASE WHEN before + size / 2 <= target - whole * source_size THEN 1 ELSE 0 END) * size AS bigint) AS taken FROM placed""",
    "op9_quality": rf"""
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents),
split AS (SELECT *, regexp_extract_all(line, '{SQL_WORD}') AS words FROM lines),
judged AS (SELECT doc_id, n, words, len(words) AS k, row_number() OVER (PARTITION BY doc_id, line ORDER BY n) > 1 AS again,
  len(words) < {quality.SHORT_LINE} AND NOT list_contains([{", ".join("'" + c.replace("'", "''") + "'" for c in quality.CLOSING)}], right(words[-1], 1))
  OR 2 * len(list_filter(words, lambda w: regexp_matches(w, '{quality.MARKED_WORD}'))) >= len(words)
  OR 5 * len(list_filter(words, lambda w: regexp_matches(w, '{quality.SEPARATOR_WORD}'))) >= len(words)
  OR len(words) <= {quality.BOILERPLATE_WORDS} AND regexp_matches(lower(line), '{"|".join(quality.PHRASES)}') AS fails
  FROM split WHERE len(words) > 0),
by_line AS (SELECT doc_id, sum(k) AS n_words, count(*) FILTER (WHERE again) AS n_dup_lines, sum(k) FILTER (WHERE fails) AS lost FROM judged GROUP BY doc_id),
w AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '{SQL_WORD}')) AS w,
  generate_subscripts(regexp_extract_all(coalesce(text, ''), '{SQL_WORD}'), 1) AS n FROM documents),
windows AS (SELECT doc_id, n, w, string_agg(w, ' ') OVER five AS s, lead(n, 4) OVER (PARTITION BY doc_id ORDER BY n) AS last
  FROM w WINDOW five AS (PARTITION BY doc_id ORDER BY n ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
counted AS (SELECT doc_id, n, w, last IS NOT NULL AND count(last) OVER (PARTITION BY doc_id, s) > 1 AS hit FROM windows),
marked AS (SELECT doc_id, w, bool_or(hit) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS hit FROM counted),
by_word AS (SELECT doc_id, sum(length(w)) AS word_chars, count(*) FILTER (WHERE hit) AS n_repeat_words FROM marked GROUP BY doc_id),
together AS (SELECT d.doc_id, cast(coalesce(n_words, 0) AS bigint) AS n_words, cast(coalesce(word_chars, 0) AS bigint) AS word_chars,
  cast(length(coalesce(text, '')) - length(translate(coalesce(text, ''), '{quality.SYMBOLS}', '')) AS bigint) AS n_symbols,
  cast(coalesce(n_dup_lines, 0) AS bigint) AS n_dup_lines, cast(coalesce(n_repeat_words, 0) AS bigint) AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM documents d LEFT JOIN by_line USING (doc_id) LEFT JOIN by_word USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
 n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED_PERCENT} * n_words AS base_failed,
 NOT (n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED_PERCENT} * n_words) AND lost <= {quality.MOST_LOST} * n_words AS kept
FROM together""",
    "op11_vector_codes": _codebook_sql(),
    "op12_spelling": SPELLING_SQL,
    "op13_jaccard": JACCARD_SQL,
}
