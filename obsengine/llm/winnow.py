"""Line deduplication by windows of line hashes (operator 9, native).

The lines of a text that have words are a sequence of hashes.  A window is the
shortest run of consecutive lines with at least ``min_words`` words that
begins (or ends) at a line; its smallest line hash is its fingerprint.  Any
run of that many words which two places share holds whole windows, equal in
both and with equal fingerprints, so none is missed.  Every window is kept:
the fingerprint selects none, so this is shingling and not winnowing.  Places are joined by
fingerprint and window content to the first one, the windows that begin and
those that end at a line extend a match to both of its sides, and every place
but the first is deleted.

DataFrame functions only.  What is shuffled are line hashes; a line's text is
read twice, once to hash it and once to cut it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, staged

MIN_WORDS = 50

# Fixed value: a word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def line_windows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The windows of all texts (doc_id, text_hash, text): doc_id, text_hash,
    first, last (line numbers), fingerprint, content."""
    lines = docs.select("doc_id", "text_hash", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.where(F.col("line").rlike(WORD)).select(
        "doc_id", "text_hash", "pos",
        F.xxhash64("line").alias("h"),
        F.regexp_count("line", F.lit(WORD)).cast("long").alias("words"),
    )
    # a row that occurs again is the same document
    lines = lines.repartition("doc_id", "text_hash").dropDuplicates(["doc_id", "text_hash", "pos"])
    text = Window.partitionBy("doc_id", "text_hash")
    upto = F.sum("words").over(text.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    lines = lines.withColumn("after", upto).withColumn("before", F.col("after") - F.col("words"))
    forward = text.orderBy("before").rangeBetween(0, min_words - 1)
    backward = text.orderBy("after").rangeBetween(-(min_words - 1), 0)

    def window(frame, first: Column, last: Column) -> Column:
        hashes = F.collect_list("h").over(frame)
        whole = F.sum("words").over(frame) >= min_words
        return F.when(
            whole,
            F.struct(
                first.alias("first"),
                last.alias("last"),
                F.array_min(hashes).alias("fingerprint"),
                F.xxhash64(hashes).alias("content"),
            ),
        )

    both = lines.select(
        "doc_id",
        "text_hash",
        window(forward, F.col("pos"), F.max("pos").over(forward)).alias("ahead"),
        window(backward, F.min("pos").over(backward), F.col("pos")).alias("behind"),
    )
    found = F.array_distinct(F.array_compact(F.array("ahead", "behind")))
    return both.select("doc_id", "text_hash", F.inline(found))


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_hash, runs): the merged runs of lines of each text that
    occur earlier, in an earlier text (by doc_id, then hash) or above."""
    windows = staged(line_windows(docs, min_words), "windows")
    place = F.struct("doc_id", "text_hash", "first")
    firsts = windows.groupBy("fingerprint", "content").agg(F.min(place).alias("origin"), F.count("*").alias("n"))
    later = windows.join(firsts.where("n > 1"), ["fingerprint", "content"]).where(place != F.col("origin"))
    spans = later.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("first", "last"))).alias("spans")
    )

    def merge(runs, span):
        tail = F.element_at(runs, -1)
        apart = (F.size(runs) == 0) | (F.try_element_at(runs, F.lit(-1))["last"] < span["first"] - 1)
        joined = F.struct(tail["first"].alias("first"), F.greatest(tail["last"], span["last"]).alias("last"))
        return F.when(apart, F.concat(runs, F.array(span))).otherwise(
            F.concat(F.slice(runs, 1, F.greatest(F.size(runs) - 1, F.lit(0))), F.array(joined))
        )

    empty = F.filter("spans", lambda s: F.lit(False))
    return spans.select("doc_id", "text_hash", F.aggregate("spans", empty, merge).alias("runs"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later repeated runs of lines cut from ``text``, and the
    numbers of lines before and of lines cut in ``n_lines`` and ``n_cut``.

    A run is cut if it has ``min_words`` words and occurs earlier; the blank
    lines inside go with it.  Shorter repeats stay.  A text that is left
    without words becomes empty.  NULL stays NULL with no lines; an empty
    text has one line.  Copies of one row (doc_id and text) are cut alike, as
    one document; texts without doc_id come first.  Text that repeats itself
    shrinks to its first period.  Every row is kept with its other columns; a
    column already called ``n_lines`` or ``n_cut`` stays and the new one gets
    an underscore.
    """
    n_lines, n_cut = free_name(docs.columns, "n_lines"), free_name(docs.columns, "n_cut")
    own = free_name(docs.columns, "text_hash")
    cut_doc, cut_hash, runs_, lines_, kept_ = (free_name(docs.columns, c) for c in ("_cut_doc", "_cut_hash", "_runs", "_lines", "_kept"))
    hashed = docs.withColumn(own, F.xxhash64("text"))
    runs = repeated_runs(hashed.select("doc_id", F.col(own).alias("text_hash"), "text"), min_words)
    runs = runs.select(F.col("doc_id").alias(cut_doc), F.col("text_hash").alias(cut_hash), F.col("runs").alias(runs_))
    on = F.col("doc_id").eqNullSafe(F.col(cut_doc)) & (F.col(own) == F.col(cut_hash))
    joined = hashed.join(runs, on, "left").withColumn(lines_, F.split("text", "\n"))
    inside = lambda i: F.exists(runs_, lambda r: (i >= r["first"]) & (i <= r["last"]))
    kept = F.when(F.col(runs_).isNull(), F.col(lines_)).otherwise(F.filter(lines_, lambda x, i: ~inside(i)))
    joined = joined.withColumn(kept_, kept)
    left = F.array_join(kept_, "\n")
    text = (
        F.when(F.col(runs_).isNull(), F.col("text"))
        .when(left.rlike(WORD), left)
        .otherwise(F.lit(""))
    )
    total = F.coalesce(F.size(lines_), F.lit(0)).cast("long")
    total = F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(total)
    cut = F.when(F.col(runs_).isNull(), F.lit(0).cast("long")).otherwise(
        (F.size(lines_) - F.size(kept_)).cast("long")
    )
    return joined.select(
        *(text.alias(c) if c == "text" else F.col(c) for c in docs.columns), total.alias(n_lines), cut.alias(n_cut)
    )


ORACLE = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents
), counted AS (
  SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n FROM lines
), placed AS (
  SELECT *, CAST(sum(n) OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS upto FROM counted WHERE n > 0
), ahead AS (
  SELECT doc_id, pos AS a, max(pos) OVER f AS b, list(line) OVER f AS run, sum(n) OVER f AS total
  FROM placed
  WINDOW f AS (PARTITION BY doc_id ORDER BY upto - n RANGE BETWEEN CURRENT ROW AND {MIN_WORDS - 1} FOLLOWING)
), behind AS (
  SELECT doc_id, min(pos) OVER f AS a, pos AS b, list(line) OVER f AS run, sum(n) OVER f AS total
  FROM placed
  WINDOW f AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN {MIN_WORDS - 1} PRECEDING AND CURRENT ROW)
), runs AS (
  SELECT * FROM ahead WHERE total >= {MIN_WORDS} UNION ALL SELECT * FROM behind WHERE total >= {MIN_WORDS}
), ranked AS (
  SELECT doc_id, a, b, min(struct_pack(d := doc_id, a := a)) OVER (PARTITION BY run) AS origin FROM runs
), cut AS (
  SELECT DISTINCT l.doc_id, l.pos FROM lines l JOIN ranked r
  ON l.doc_id = r.doc_id AND l.pos BETWEEN r.a AND r.b
  WHERE r.origin.d <> r.doc_id OR r.origin.a <> r.a
), left_over AS (
  SELECT l.doc_id, count(*) AS n_lines, count(c.pos) AS n_cut,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE c.pos IS NULL), '') AS text
  FROM lines l LEFT JOIN cut c ON l.doc_id = c.doc_id AND l.pos = c.pos
  GROUP BY l.doc_id
)
SELECT doc_id, n_lines, n_cut,
       CASE WHEN n_cut = 0 OR regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN text ELSE '' END AS text
FROM left_over
"""
