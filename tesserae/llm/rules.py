"""Quality rules: text statistics and lines that recur across a host's documents, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesserae.llm.common import WS, table
from tesserae.plans.materialize import materialize

_GAP = r"[ \t\n\x0B\f\r]+"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, however often a lambda in it refers to it."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _GAP))


def repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more, the first included; windows are told apart by a 64-bit hash."""

    def among(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = _let(placed, lambda p: F.filter(p, lambda x, i: (x["h"] == F.get(p, i - 1)["h"]) | (x["h"] == F.get(p, i + 1)["h"])))
        return _let(F.transform(twice, lambda x: x["i"]), lambda at: F.size(F.array_union(F.array_union(at, F.transform(at, lambda i: i + 1)), F.transform(at, lambda i: i + 2))))

    windows = _let(words, lambda w: F.transform(F.slice(w, 1, F.size(w) - 2), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))))
    counted = _let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(among(h)))
    return F.when(F.size(words) < 4, 0).otherwise(counted)


def text_statistics(text: Column) -> Column:
    """struct<n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words>, all long."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WS)) != "")

    def over(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeat_words(w).cast("long").alias("n_repeat_words"),
        )

    return _let(words_of(text), over)


def line_hash(line: Column, host: Column) -> Column:
    """64 bits of a host's line, lower-cased, with its white space evened out."""
    return F.xxhash64(host, F.regexp_replace(F.lower(F.btrim(line, F.lit(WS))), _GAP, " "))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", host_percent: int = 5, least_documents: int = 3, least_left: float = 0.8) -> DataFrame:
    """One row for each row of docs: doc_id, host, the statistics, base_failed, n_line_words (words in recurring lines), kept.

    A line recurs if more than host_percent of its host's documents have it, and more than
    least_documents. Lines that recur are taken out; a document of which less than least_left of the
    words remains is rejected, as is one that fails the base rules (under 50 words, or over half of
    them in repeated 3-word windows).

    Lines travel as hashes and numbers of words, written once; counting is a partial aggregation, and
    the recurring lines are joined back to the documents' lines, where Spark splits a hot line. No text
    is shuffled. Ids are of any type. Null texts count as empty, null hosts as one host. Documents are told
    apart by their ids: rows that share one, or have none, count once for a line and a host; repeated rows get the same verdict. Other columns are not read. No rows give
    no rows.
    """
    text, host = F.coalesce(F.col(text_col), F.lit("")), F.xxhash64(F.col(host_col))
    keys = [F.xxhash64(F.col(id_col), F.lit("id")).alias("_id"), F.xxhash64(F.col(host_col), text, F.col(id_col)).alias("_key")]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), host.alias("_host"), text.alias("_t"), *keys)
    lines = F.filter(F.split("_t", "\n"), lambda x: F.btrim(x, F.lit(WS)) != "")
    each = F.transform(lines, lambda x: F.struct(line_hash(x, F.col("host")).alias("line"), F.size(F.split(F.btrim(x, F.lit(WS)), _GAP)).alias("words")))
    # in order of hash a document's line is its first where the hash changes
    marked = _let(F.sort_array(each), lambda s: F.transform(s, lambda x, i: F.struct(x["line"].alias("line"), x["words"].alias("words"), (F.when(i == 0, True).otherwise(x["line"] != F.get(s, i - 1)["line"])).cast("int").alias("first"))))
    listed = materialize(rows.select("_id", "_key", "_host", F.explode(marked).alias("l")).select("_id", "_key", "_host", "l.*"), "rules-listed")
    hosts = rows.groupBy("_host").agg(F.count_distinct("_id").alias("documents"))
    often = listed.where("first = 1").groupBy("_host", "line").agg(F.count_distinct("_id").alias("n")).where(F.col("n") > least_documents)
    # written, so that the join below is between two plain exchanges, which Spark can split by a hot line, or a broadcast if its size allows
    recurring = materialize(often.join(hosts, "_host").where(100 * F.col("n") > host_percent * F.col("documents")).select("line"), "rules-lines")
    lost = listed.select("_id", "_key", "line", "words").join(recurring, "line").groupBy("_id", "_key").agg(F.sum("words").alias("_lost"))
    stats = rows.select("doc_id", "host", "_id", "_key", text_statistics(F.col("_t")).alias("s")).select("doc_id", "host", "_id", "_key", "s.*")
    joined = stats.join(lost, ["_id", "_key"], "left")
    # a row and its repetitions found their lost words together
    lost_each = F.coalesce(F.col("_lost") / F.count("*").over(Window.partitionBy("_id", "_key")), F.lit(0)).cast("long")
    joined = joined.withColumn("n_line_words", lost_each)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_line_words")
    return joined.select("doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "n_line_words", (~failed & (left >= least_left * F.col("n_words"))).alias("kept"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("host")


OP8_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t, list_filter(regexp_split_to_array(t, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '[ \t\n\x0B\f\r]+', '', 'g') <> '') AS l FROM d),
tri AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: {'i': i, 'k': array_to_string(list_slice(w, i, i + 2), ' ')})) AS x FROM w),
twice AS (SELECT doc_id, x.i AS i, count(*) OVER (PARTITION BY doc_id, x.k) AS n FROM tri),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice WHERE n > 1) GROUP BY doc_id),
ln AS (SELECT doc_id, source, lower(regexp_replace(trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), '[ \t\n\x0B\f\r]+', ' ', 'g')) AS k, len(list_filter(regexp_split_to_array(x, '[ \t\n\x0B\f\r]+'), lambda y: y <> '')) AS words
  FROM (SELECT doc_id, source, unnest(l) AS x FROM w)),
hosts AS (SELECT source, count(DISTINCT doc_id) AS documents FROM documents GROUP BY source),
freq AS (SELECT source, k FROM (SELECT source, k, count(DISTINCT doc_id) AS n FROM ln GROUP BY source, k) JOIN hosts USING (source) WHERE n > 3 AND 100 * n > 5 * documents),
lost AS (SELECT doc_id, sum(words) AS n FROM ln JOIN freq USING (source, k) GROUP BY doc_id),
s AS (SELECT w.doc_id, len(w.w) AS n_words, length(array_to_string(w.w, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
  len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(lost.n, 0) AS n_line_words
  FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed, n_line_words::BIGINT AS n_line_words, NOT base_failed AND n_words - n_line_words >= 0.8 * n_words AS kept FROM f
"""
