"""Line deduplication: lines that many documents share are dropped everywhere.

Each whole text is split at ``\\n``; a line's key is the line with
``[\\x20\\x09-\\x0D]`` stripped at both ends and A-Z lower-cased.  The distinct
keys of every document are exploded as 128-bit hashes and counted with map-side
combining, so a line that a third of all documents hold is one partial row per
task.  The keys over the threshold go back to the documents as hashes only
(never as text): each document learns the set of its own shared keys, and its
lines are filtered in place, which keeps their positions without a sort.

A document is a row: repeated rows count as often as they occur.

Defined results: a null or empty text is one empty line; keys shorter than
``min_chars`` code points are never dropped (so at 1 empty lines stay); a
document whose lines are all dropped keeps the empty text; null ``doc_id`` rows
are kept like any other; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import maybe_broadcast, written

#: The white space stripped from a line's ends.
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(BLANKS)), UPPER, LOWER)


def _hash(key: Column) -> Column:
    return F.unhex(F.md5(key))


def drop_shared_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_text`` for every row of ``docs``."""
    if min_docs < 1 or min_chars < 0:
        raise ValueError("min_docs must be at least 1 and min_chars at least 0")
    d = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keys = F.filter(F.array_distinct(F.transform(F.split("text", "\n", -1), line_key)), lambda k: F.length(k) >= min_chars)
    # rows with the same id and text share their keys, so the pair names a row well enough
    ids = d.select("doc_id", F.unhex(F.md5("text")).alias("row"), F.explode(F.transform(keys, _hash)).alias("h"))
    ids = written(ids, "line_keys")
    shared = written(ids.groupBy("h").count().where(F.col("count") >= min_docs).select("h"), "shared_lines")
    hits = ids.join(maybe_broadcast(shared, 48), "h").groupBy(F.col("doc_id").alias("hit_id"), "row").agg(F.collect_set("h").alias("hits"))
    d = d.withColumn("row_", F.unhex(F.md5("text")))
    j = d.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("row_") == F.col("row")), "left")
    lines = F.split("text", "\n", -1)
    kept = F.when(F.col("hits").isNull(), lines).otherwise(F.filter(lines, lambda x: ~F.array_contains("hits", _hash(line_key(x)))))
    j = j.select("doc_id", F.size(lines).cast("long").alias("n_lines"), kept.alias("kept"))
    return j.select("doc_id", "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_dropped"), F.array_join("kept", "\n").alias("kept_text"))


ORACLE = r"""
WITH l AS (
  SELECT rowid AS r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), shared AS (
  SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10
), m AS (
  SELECT k.*, s.key IS NOT NULL AS gone FROM k LEFT JOIN shared s ON k.key = s.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""
