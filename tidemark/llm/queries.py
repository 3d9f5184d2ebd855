"""A query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import documents
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.mixing import mixing
from tidemark.llm.order_minhash import edit_likeness
from tidemark.llm.packing import packed
from tidemark.llm.periodic import digests, periodic_runs, with_planted_runs
from tidemark.llm.ppm import lm_scores
from tidemark.llm.quality import FUNCTION_WORDS, ROUNDS, RULES, quality
from tidemark.llm.resampling import importance_resampling
from tidemark.llm.simhash import near_dedup
from tidemark.llm.token_files import read_tokens, write_tokens
from tidemark.llm.tokens import token_counts
from tidemark.llm.toxicity import toxicity
from tidemark.sources.staging import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), tokenizer_path())


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


ORACLE["op2_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS bytes
  FROM documents
), g AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY bytes) AS group_size
  FROM t WINDOW w AS (PARTITION BY bytes ORDER BY chars DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, keep_id = doc_id AS kept, sha256(bytes) AS text_sha256 FROM g
"""


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir))


def _quality_sql() -> str:
    """The figures, then every EM round as two steps over (pattern, rule, vote)."""
    blank, word = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"
    words = ", ".join(f"'{w}'" for w in FUNCTION_WORDS)

    def vote(value: str, bad: str, good: str) -> str:
        return f"CASE WHEN {value} {bad} THEN -1 WHEN {value} {good} THEN 1 ELSE 0 END"

    rules = {
        "function_words": vote("function_words", "< 0.08", "> 0.14"),
        "symbols": vote("symbols", "> 0.1", "< 0.01"),
        "repetition": vote("repetition", "> 0.2", "< 0.03"),
        "variety": vote("variety", "< 0.3", "> 0.6"),
        "capitals": vote("capitals", "> 0.3", "< 0.1"),
        "loudness": vote("loudness", "> 0.2", "< 0.02"),
        "lines": vote("lines", "> 0.3", "= 0"),
        "word_length": "CASE WHEN word_length < 2.5 OR word_length > 12 THEN -1 "
        "WHEN word_length BETWEEN 3.5 AND 7 THEN 1 ELSE 0 END",
    }
    assert list(rules) == RULES
    steps = [
        f"""t AS (SELECT doc_id, coalesce(text, '') AS text,
        list_filter(regexp_split_to_array(coalesce(text, ''), '{blank}'), lambda x: x <> '') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{word}')) AS lines
        FROM documents)""",
        f"""w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM t)""",
        """g AS (SELECT doc_id, i, word || ' ' || lead(word) OVER d || ' ' || lead(word, 2) OVER d || ' ' ||
        lead(word, 3) OVER d || ' ' || lead(word, 4) OVER d AS gram FROM w WINDOW d AS (PARTITION BY doc_id ORDER BY i))""",
        """again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g
        WHERE gram IS NOT NULL) WHERE n > 1)""",
        """r AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM again, range(5) AS o(k) GROUP BY doc_id)""",
        f"""f AS (SELECT t.doc_id, len(words) AS n_words,
        length(regexp_replace(text, '{blank}', '', 'g')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals,
        length(text) - length(regexp_replace(text, '[!?]', '', 'g')) AS n_loud,
        len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        len(list_distinct(words)) AS n_distinct,
        len(list_filter(words, lambda x: x IN ({words}))) AS n_function,
        coalesce(n_repeat_words, 0) AS n_repeat_words FROM t LEFT JOIN r ON r.doc_id = t.doc_id)""",
        """x AS (SELECT *, n_function / CASE WHEN n_words >= 20 THEN n_words END AS function_words,
        n_distinct / CASE WHEN n_words >= 20 THEN n_words END AS variety,
        n_symbols / nullif(n_words, 0) AS symbols, n_repeat_words / nullif(n_words, 0) AS repetition,
        n_loud / nullif(n_words, 0) AS loudness, word_chars / nullif(n_words, 0) AS word_length,
        n_capitals / nullif(word_chars, 0) AS capitals,
        n_dup_lines / CASE WHEN n_lines >= 2 THEN n_lines END AS lines FROM f)""",
        "v AS (SELECT doc_id, " + ", ".join(f"{sql} AS {name}" for name, sql in rules.items()) + " FROM x)",
        f"p AS (SELECT {', '.join(RULES)}, count(*) AS n FROM v GROUP BY ALL)",
        "pv AS (SELECT *, row_number() OVER (ORDER BY n, " + ", ".join(RULES) + ") AS pid FROM p)",
        "long AS ("
        + " UNION ALL ".join(f"SELECT pid, n, '{r}' AS rule, {r} AS vote FROM pv" for r in RULES)
        + ")",
        "g0 AS (SELECT pid, n, 1 / (1 + exp(-sum(CASE vote WHEN -1 THEN -4.0 WHEN 1 THEN 1.0 ELSE 0 END))) AS good "
        "FROM long GROUP BY pid, n)",
    ]
    for k in range(1, ROUNDS + 1):
        steps += [
            f"s{k} AS MATERIALIZED (SELECT sum(good * n) AS good_n, sum((1 - good) * n) AS bad_n FROM g{k - 1})",
            f"k{k} AS MATERIALIZED (SELECT rule, v AS vote, ln((coalesce(sum(good * l.n) FILTER (l.vote = v), 0) + 1) / "
            f"(any_value(good_n) + 3)) - ln((coalesce(sum((1 - good) * l.n) FILTER (l.vote = v), 0) + 1) / "
            f"(any_value(bad_n) + 3)) AS weight FROM long l JOIN g{k - 1} USING (pid), s{k}, "
            f"(VALUES (-1), (1)) AS o(v) GROUP BY rule, v)",
            f"g{k} AS MATERIALIZED (SELECT l.pid, l.n, "
            f"ln((any_value(good_n) + 1) / (any_value(bad_n) + 1)) + sum(coalesce(weight, 0)) AS odds, "
            f"1 / (1 + exp(-(ln((any_value(good_n) + 1) / (any_value(bad_n) + 1)) + sum(coalesce(weight, 0))))) AS good "
            f"FROM long l LEFT JOIN k{k} w ON w.rule = l.rule AND w.vote = l.vote, s{k} GROUP BY l.pid, l.n)",
        ]
    joined = " AND ".join(f"v.{r} = pv.{r}" for r in RULES)
    failed = "(n_words < 10 OR 100 * n_repeat_words > 20 * n_words)"
    return (
        "WITH "
        + ", ".join(steps)
        + f" SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {failed} AS base_failed, "
        + f"NOT {failed} AND odds >= 0 AS kept FROM f JOIN v ON v.doc_id = f.doc_id JOIN pv ON {joined} "
        + f"JOIN g{ROUNDS} AS last ON last.pid = pv.pid"
    )


ORACLE["op3_quality_rules"] = _quality_sql()


@query
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(documents(spark, sf_dir))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token_files")
    write_tokens(documents(spark, sf_dir), path, tokenizer_path())
    return read_tokens(spark, path, ids=False)


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir))


ORACLE["op7_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line_no FROM documents
), s AS (
  SELECT doc_id, line_no, list_sort(list_distinct(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'),
    lambda x: x <> ''))) AS words FROM l
), w AS (SELECT * FROM s WHERE len(words) > 0),
d AS (
  SELECT words, len(words) AS n, min((doc_id, line_no)) AS first, row_number() OVER (ORDER BY min((doc_id, line_no))) AS gid
  FROM w GROUP BY words
), t AS (SELECT gid, n, unnest(words) AS word FROM d),
pairs AS (
  SELECT a.gid AS a, b.gid AS b FROM t a JOIN t b ON a.word = b.word AND a.gid < b.gid
    AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
  GROUP BY a.gid, b.gid, a.n, b.n HAVING 9 * count(*) >= 4 * (a.n + b.n)
), r AS (
  SELECT w.doc_id, w.line_no, (w.doc_id, w.line_no) <> d.first OR d.gid IN (SELECT b FROM pairs) AS removed
  FROM w JOIN d ON w.words = d.words
)
SELECT x.doc_id, count(r.line_no) AS n_lines, count(*) FILTER (removed) AS n_removed,
  coalesce(string_agg(CAST(r.line_no AS VARCHAR), ',' ORDER BY r.line_no) FILTER (removed), '') AS removed
FROM documents x LEFT JOIN r ON r.doc_id = x.doc_id GROUP BY x.doc_id
"""


@query
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir))


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target weights by a temperature of two: a source's share follows the root of its size."""
    return mixing(documents(spark, sf_dir), temperature=2.0)


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir), tokenizer_path())


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(periodic_runs(with_planted_runs(documents(spark, sf_dir))))


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


# CRC32 by its polynomial, a byte at a time, for each different word.
ORACLE["op12_importance_resampling"] = r"""
WITH tab AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t
), cleaned AS (
  SELECT doc_id, true AS ours, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
  UNION ALL
  SELECT NULL, false, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), w AS (SELECT doc_id, ours, unnest(words) AS word FROM cleaned),
d AS (SELECT DISTINCT word, hex(encode(word)) AS h FROM w),
b AS (
  SELECT word, xor(4294967295, list_reduce([4294967295] || list_transform(range(length(h) // 2),
    lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) % 10000 AS bucket FROM d, tab
), n AS (
  SELECT bucket, count(*) FILTER (ours) AS s, count(*) FILTER (NOT ours) AS t FROM w JOIN b USING (word) GROUP BY bucket
), g AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM n)::DOUBLE + 10000)
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM n)::DOUBLE + 10000)))) AS BIGINT) AS gain FROM n
), x AS (
  SELECT w.doc_id, sum(gain) AS weight FROM w JOIN b USING (word) JOIN g USING (bucket) WHERE ours GROUP BY w.doc_id
), f AS (
  SELECT c.doc_id, len(words) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST('0x' || substr(sha256('2024:' || c.doc_id), 1, 8) AS BIGINT)::DOUBLE AS h
  FROM cleaned c LEFT JOIN x ON x.doc_id = c.doc_id WHERE ours
), y AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM f
), r AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM y WHERE n_features >= 20
)
SELECT y.doc_id, n_features, weight, score, rank FROM y LEFT JOIN
  (SELECT * FROM r WHERE rank <= 10 * (SELECT count(*) FROM r) // 100) AS k ON k.doc_id = y.doc_id
"""


@query
def op13_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_likeness(documents(spark, sf_dir))
