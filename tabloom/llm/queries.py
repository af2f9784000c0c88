"""The queries of this subpackage, and their SQL checks where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from tabloom.llm.chat import learn, recover_turns, transcript_lines
from tabloom.llm.common import fold, read_table
from tabloom.llm.conversation_repair import damage, repair, summarize
from tabloom.llm.decontaminate import find_leaks
from tabloom.llm.exact_dedup import find_copies
from tabloom.llm.language_id import identify
from tabloom.llm.line_dedup import remove_repeats
from tabloom.llm.minhash import near_groups
from tabloom.llm.packing import pack_documents
from tabloom.llm.periodic_runs import digest_runs, find_runs, with_loops
from tabloom.llm.quality import score_quality
from tabloom.llm.suffix_dedup import remove_repeated
from tabloom.llm.toxicity import score_toxicity
from tabloom.llm.url_filter import judge_urls, rules_frame

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

URL_RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_language_id(spark, folder):
    return identify(read_table(spark, folder, "documents"))


@query
def op2_line_dedup(spark, folder):
    cleaned = remove_repeats(read_table(spark, folder, "documents"))
    return cleaned.select("doc_id", "n_lines", "removed_lines", F.sha2("text", 256).alias("text_sha256"))


ORACLE["op2_line_dedup"] = """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
p AS (
  SELECT doc_id, no, lines[no] || chr(10) || lines[no + 1] AS body
  FROM (SELECT doc_id, lines, unnest(generate_series(1, len(lines) - 1)) AS no FROM l)),
r AS (
  SELECT doc_id, no
  FROM (SELECT doc_id, no, row_number() OVER (PARTITION BY body ORDER BY doc_id, no) AS place FROM p) WHERE place > 1),
g AS (SELECT doc_id, no, true AS gone FROM r UNION SELECT doc_id, no + 1, true FROM r),
x AS (SELECT doc_id, unnest(lines) AS line, unnest(generate_series(1, len(lines))) AS no FROM l),
a AS (
  SELECT doc_id, count(*) AS n_lines, count(gone) AS removed_lines,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (gone IS NULL), '')) AS text_sha256
  FROM x LEFT JOIN g USING (doc_id, no) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
  CAST(coalesce(removed_lines, 0) AS BIGINT) AS removed_lines, text_sha256
FROM documents LEFT JOIN a USING (doc_id)
"""


@query
def op2_passage_dedup(spark, folder):
    """The name of the last round's query for all repeated runs of two lines or more, which op2_line_dedup finds now."""
    return op2_line_dedup(spark, folder)


ORACLE["op2_passage_dedup"] = ORACLE["op2_line_dedup"]


@query
def op3_exact_dedup(spark, folder):
    return find_copies(read_table(spark, folder, "documents"), digest_all=True).drop("text_length")


ORACLE["op3_exact_dedup"] = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(body) AS text_sha256
FROM t WINDOW g AS (PARTITION BY body)
"""


@query
def op4_packing(spark, folder):
    return pack_documents(read_table(spark, folder, "documents"))


@query
def op5_toxicity(spark, folder):
    return score_toxicity(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


@query
def op6_minhash(spark, folder):
    return near_groups(read_table(spark, folder, "documents"))


ORACLE["op6_minhash"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN words ELSE words[n : n + 4] END AS shingle
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 4, least(len(words), 1)))) AS n FROM w)),
c AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS MATERIALIZED (
  SELECT a, b FROM p JOIN c x ON x.doc_id = a JOIN c y ON y.doc_id = b
  WHERE 100 * common >= 75 * (x.n + y.n - common)),
r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reached)
SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, g.component_id, d.doc_id = g.component_id AS kept
FROM documents d LEFT JOIN c USING (doc_id)
JOIN (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id) g USING (doc_id)
"""


@query
def op7_url_filter(spark, folder):
    return judge_urls(read_table(spark, folder, "pages"), rules_frame(spark, URL_RULES))


ORACLE["op7_url_filter"] = """
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
r(verdict, rule, rule_host, rule_path) AS (VALUES
  ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
  ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
m AS (
  SELECT page_id, host, path, rule, verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) AS place
  FROM p LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE place = 1
"""


@query
def op8_quality(spark, folder):
    return score_quality(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


@query
def op9_chat_format(spark, folder):
    """Learns from four fifths of the conversations, by the crc32 of their id, and parses them all."""
    lines = transcript_lines(read_table(spark, folder, "conversations"))
    return recover_turns(lines, learn(lines.where(fold(F.col("conv_id"), 5) != 0)))


@query
def op10_decontamination(spark, folder):
    """The documents that leak, each with the items it holds."""
    leaks = find_leaks(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
    return leaks.withColumn("similarity", F.round("similarity", 6))


ORACLE["op10_decontamination"] = """
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS words
  FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS words
  FROM benchmark),
gw AS (
  SELECT doc_id, n, array_to_string(words[n : n + 4], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 4)) AS n FROM w)),
gb AS (
  SELECT item_id, len(words) AS size, n, array_to_string(words[n : n + 4], ' ') AS gram
  FROM (SELECT item_id, words, unnest(generate_series(1, len(words) - 4)) AS n FROM b)),
wb AS (SELECT item_id, gram, count(*) AS weight FROM gb GROUP BY ALL),
starts AS (
  SELECT DISTINCT gw.doc_id, gb.item_id, gb.size, gw.n - gb.n + 1 AS lo
  FROM gw JOIN gb USING (gram)),
inside AS (
  SELECT s.doc_id, s.item_id, s.size, s.lo, gw.gram, count(*) AS weight
  FROM starts s JOIN gw ON gw.doc_id = s.doc_id AND gw.n BETWEEN s.lo AND s.lo + s.size - 5 GROUP BY ALL),
total AS (SELECT doc_id, item_id, lo, size, sum(weight) AS own FROM inside GROUP BY ALL),
common AS (
  SELECT i.doc_id, i.item_id, i.lo, sum(least(i.weight, wb.weight)) AS shared
  FROM inside i JOIN wb ON wb.item_id = i.item_id AND wb.gram = i.gram GROUP BY ALL)
SELECT doc_id, item_id, round(max(shared / CAST(own + size - 4 - shared AS DOUBLE)), 6) AS similarity
FROM total JOIN common USING (doc_id, item_id, lo)
WHERE shared >= 0.75 * (own + size - 4 - shared)
GROUP BY doc_id, item_id
"""


@query
def op11_conversation_repair(spark, folder):
    """Damages the conversations by the hash of their turns and repairs them."""
    damaged = damage(read_table(spark, folder, "conversations"))
    return summarize(repair(damaged, present=F.col("present")))


@query
def op12_suffix_dedup(spark, folder):
    found = remove_repeated(read_table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op13_periodic_runs(spark, folder):
    """Plants loops in a tenth of the documents, by the hash of their ids, and finds all runs."""
    return digest_runs(find_runs(with_loops(read_table(spark, folder, "documents"))))


@query
def pipeline(spark, folder):
    return corpus_pipeline.run(spark, folder)


if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
