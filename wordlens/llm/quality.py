"""Quality rules: word counts of each document and the frequency of its lines on its host.

Lines are normalised (lower case, digits as 0, white space collapsed) and hashed.  For
every host (``source``) and line the different documents are counted; documents with
the same text count once, so copies do not make a page's own lines look like boilerplate.
Lines in more than ``line_share`` of a host's documents, and in more than
``line_documents``, are removed; a document that loses more than ``depleted_share`` of
its words that way is rejected, as is one that fails the base rules.

All of it is DataFrame and SQL functions.  Counts within a text stay in its row (a sorted
array of window hashes and their positions, by which the words of windows with equal
hashes are compared); what is shuffled is one hash per line, summed on the map side first.
The statistics are written once to the shared scratch folder.

Defined cases: a null text has no words and fails; a null host is a host of its own;
repeated rows are judged each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlens.llm.common import numbered, scratch, under_own_names, with_row_id

# the white space that separates words: \x20 and \x09-\x0D
SPACE = r"[\x20\x09-\x0D]+"
SPACE_IN_LINE = r"[\x20\x09\x0B-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"

# windows k and {o} have the same three words
SAME = "{o}.h = k.h and " + " and ".join(f"get(_w, {{o}}.i + {n}) = get(_w, k.i + {n})" for n in range(3))
BEFORE, AFTER = (SAME.format(o=f"get(_keys, j {d} 1)") for d in "-+")

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def word_statistics(numbered_docs: DataFrame) -> DataFrame:
    """Of rows with ``_rid``: ``_rid``, ``doc_id``, ``_host``, the base counts, ``_hash`` of the text, and per
    line with a word ``_lines`` (``at``: its number, ``h``: hash, ``w``: words)."""
    trimmed = F.btrim("_t", F.lit(SPACE_CHARS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))
    rows = numbered_docs.select(
        "_rid", "doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_host"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_t"))
    plain = F.regexp_replace(F.regexp_replace(F.lower("_t"), "[0-9]", "0"), SPACE_IN_LINE, " ")
    rows = rows.select("_rid", "doc_id", "_host", F.xxhash64("_t").alias("_hash"), words.alias("_w"),
                       F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_with_word"),
                       F.split(plain, "\n").alias("_plain"),
                       (F.length("_t") - F.length(F.regexp_replace("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"))
    # each step below names a column more than once inside a function, which keeps the
    # optimiser from computing it anew for every element
    rows = rows.select("_rid", "doc_id", "_host", "_hash", "n_symbols",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.size("_with_word") - F.size(F.array_distinct("_with_word"))).cast("long").alias("n_dup_lines"),
        F.expr("""filter(transform(_plain, (l, i) -> struct(i as at, xxhash64(btrim(l)) as h,
                  if(btrim(l) = '', 0, size(split(btrim(l), ' '))) as w)), x -> x.w > 0)""").alias("_lines"),
        "_w",
        F.expr("""if(size(_w) < 3, cast(array() as array<struct<h: bigint, i: int>>), sort_array(slice(transform(_w, (x, i) ->
                  struct(xxhash64(x, get(_w, i + 1), get(_w, i + 2)) as h, i as i)), 1, greatest(0, size(_w) - 2))))""").alias("_keys"))
    # where different windows share a hash, those of the same words are brought together
    rows = rows.select(*(c for c in rows.columns if c != "_keys"), F.expr(
        f"""if(exists(transform(_keys, (k, j) -> get(_keys, j - 1).h = k.h and not ({BEFORE})), x -> coalesce(x, false)),
              transform(sort_array(transform(_keys, k -> struct(k.h as h, get(_w, k.i) as a, get(_w, k.i + 1) as b, get(_w, k.i + 2) as c, k.i as i))),
                        k -> struct(k.h as h, k.i as i)), _keys)""").alias("_keys"))
    # windows whose words a neighbour in the sorted array shares, as places in the text
    rows = rows.select(*(c for c in rows.columns if c not in ("_keys", "_w")), F.expr(
        f"""sort_array(transform(filter(_keys, (k, j) -> coalesce({BEFORE}, false) or coalesce({AFTER}, false)),
             k -> cast(k.i as bigint)))""").alias("_places"))
    # three words from each such place, those of overlapping windows once
    covered = F.expr("""aggregate(transform(_places, (p, i) -> least(3L, coalesce(get(_places, i + 1) - p, 3L))),
                        0L, (a, x) -> a + x)""")
    return rows.withColumn("n_repeat_words", covered).select("_rid", "doc_id", "_host", "_hash", *STATS, "_lines")


def frequent_lines(stats: DataFrame, line_share: float, line_documents: int) -> DataFrame:
    """``_host`` and ``h`` of the lines in too many different documents of a host."""
    texts = stats.select("_host", "_hash", "_lines.h").distinct()
    each = texts.select("_host", "_hash", F.explode(F.array_distinct("h")).alias("h"))
    count = each.groupBy("_host", "h").agg(F.count("*").alias("n")).where(F.col("n") > line_documents)
    hosts = texts.groupBy(F.col("_host").alias("_of")).agg(F.count("*").alias("documents"))
    return count.join(hosts, F.col("_host") == F.col("_of")).where(F.col("n") > line_share * F.col("documents")).select("_host", "h")


def judge(docs: DataFrame, line_share: float = 0.1, line_documents: int = 20, depleted_share: float = 0.5,
          least_words: int = 50, repeat_percent: int = 50) -> DataFrame:
    """One row per document: base counts, ``base_failed``, ``removed_words``, ``removed``
    (numbers of its removed lines) and ``kept``, with ``_rid`` (see ``with_row_id``)."""
    return judge_numbered(with_row_id(docs), line_share, line_documents, depleted_share, least_words, repeat_percent)


def judge_numbered(numbered_docs: DataFrame, line_share: float = 0.1, line_documents: int = 20, depleted_share: float = 0.5,
                   least_words: int = 50, repeat_percent: int = 50) -> DataFrame:
    """``judge`` of rows that have their ``_rid``."""
    stats = scratch(word_statistics(numbered_docs), "quality")
    often = frequent_lines(stats, line_share, line_documents).select(F.col("_host").alias("_of"), F.col("h").alias("_h"))
    lines = stats.select("_rid", "_host", F.explode("_lines").alias("l")).select("_rid", "_host", "l.*")
    hit = lines.join(often, (F.col("_host") == F.col("_of")) & (F.col("h") == F.col("_h")))
    # at most a row's own lines are gathered
    lost = hit.groupBy(F.col("_rid").alias("_lost")).agg(F.sum("w").alias("_gone"), F.sort_array(F.collect_list("at")).alias("_at"))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    gone = F.coalesce("_gone", F.lit(0)).cast("long")
    return (stats.drop("_lines").join(lost, F.col("_rid") == F.col("_lost"), "left")
            .select("_rid", "doc_id", *STATS, failed.alias("base_failed"), gone.alias("removed_words"),
                    F.coalesce("_at", F.array().cast("array<int>")).alias("removed"),
                    (~failed & (gone <= depleted_share * F.col("n_words"))).alias("kept")))


@under_own_names
def clean(docs: DataFrame, **limits) -> DataFrame:
    """The kept documents without their removed lines, all columns as they are
    (``n_chars``, where there is one, counted again for changed texts)."""
    table = numbered(docs, "numbered")
    verdict = judge_numbered(table, **limits).where("kept").select(F.col("_rid").alias("_kept"), "removed")
    rows = table.join(verdict, F.col("_rid") == F.col("_kept"))
    text = F.expr("array_join(filter(split(text, '\n'), (l, i) -> not array_contains(removed, i)), '\n')")
    changed = F.size("removed") > 0
    out = rows.withColumn("text", F.when(changed, text).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
