"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The same contract as the Spark side: sentences are the ``\\n``-separated
lines of ``documents.text`` (numbered before empty ones are dropped), tokens
are the matches of the token pattern plus ``EOS``.  Positions are 0-based.
"""

from __future__ import annotations

from wordlens.plans import params as P

TOKEN_RE = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]"
# Java's (?U)\s, written out for RE2
UNICODE_WS = r"[\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _corpus(table: str = "documents", keys: str = "doc_id") -> str:
    return f"""
lines AS (
  SELECT {keys}, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS sent_no,
         unnest(string_split(text, chr(10))) AS line
  FROM {table}),
sent0 AS (
  SELECT {keys}, sent_no, list_append(regexp_extract_all(line, '{TOKEN_RE}'), 'EOS') AS t FROM lines),
sent AS (SELECT {keys}, sent_no, t, CAST(len(t) AS INTEGER) AS n_tokens FROM sent0 WHERE len(t) > 1),
tok AS (
  SELECT {keys}, sent_no, n_tokens, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS pos,
         unnest(t) AS surface FROM sent),
cls AS (
  SELECT *, pos = n_tokens - 1 AS is_eos,
         CASE WHEN pos = n_tokens - 1 THEN 'EOS'
              WHEN regexp_matches(surface, '^\\p{{L}}') THEN 'WORD'
              WHEN regexp_matches(surface, '^\\p{{N}}') THEN 'NUM'
              ELSE 'PUNCT' END AS f01
  FROM tok),
prof AS (
  SELECT doc_id, sent_no, n_tokens, surface AS term, CAST(min(pos) AS INTEGER) AS fp, count(*) AS tf
  FROM tok GROUP BY doc_id, sent_no, n_tokens, surface),
stats AS (
  SELECT term, count(*) AS "binary", CAST(sum(tf) AS BIGINT) AS count,
         count(*) / sum(tf) AS quote,
         sum(fp) / count(*) AS pos_index,
         sum(CASE WHEN n_tokens > 1 THEN fp * 100.0::DOUBLE / (n_tokens - 1) ELSE 0.0::DOUBLE END) / count(*) AS pct_index,
         min(struct_pack(d := doc_id, s := sent_no, p := fp)) AS first_seen
  FROM prof GROUP BY term),
nsent AS (SELECT count(*) AS n FROM sent)"""


def _with(body: str, corpus: str | None = None) -> str:
    return "WITH " + (corpus if corpus is not None else _corpus()) + "\n" + body


def _pct(pos: str, n: str) -> str:
    return f"(CASE WHEN {n} > 1 THEN {pos} * 100.0::DOUBLE / ({n} - 1) ELSE 0.0::DOUBLE END)"


def _positions_list(arr: str, word_sql: str) -> str:
    return f"[CAST(i - 1 AS INTEGER) for i in range(1, len({arr}) + 1) if {arr}[i] = {word_sql}]"


def _words_sql() -> str:
    return "[" + ", ".join(_lit(w) for w in P.WORDS) + "]"


def _stats_select(src: str = "stats") -> str:
    return ('SELECT term, "binary", count, quote, round(pos_index, 6) AS pos_index, '
            f"round(pct_index, 6) AS pct_index FROM {src}")


W = _lit(P.WORD)
p = P.REPORT_PERCENT

REPORT = f"""
report AS (
  SELECT CAST(row_number() OVER (ORDER BY "binary" DESC, first_seen) AS INTEGER) AS rank, s.*
  FROM stats s, nsent
  WHERE quote >= {p / 100.0!r}::DOUBLE AND "binary" > nsent.n * {float(p)!r}::DOUBLE / 100.0::DOUBLE)"""

# centring on the first occurrence of WORD: pos list per sentence
CENTRE = f"""
firsts AS (SELECT doc_id, sent_no, n_tokens, t, list_position(t, {W}) AS p1 FROM sent)"""


def _centre_sql(direction: int) -> str:
    if direction > 0:
        cut = "t[p1:]"
    elif direction == 0:
        cut = "t[:p1]"
    else:
        cut = "list_reverse(t[:p1])"
    return _with(f"""SELECT doc_id, sent_no,
  CASE WHEN p1 IS NULL OR p1 = 0 THEN '' ELSE array_to_string({cut}, ' ') END AS centred
FROM firsts""", _corpus() + "," + CENTRE)


SLOTS = f"""
cent AS (
  SELECT doc_id, sent_no, n_tokens, p1, t[p1:] AS c0,
         [CASE WHEN i = n_tokens THEN 'EOS'
               WHEN regexp_matches(t[i], '^\\p{{L}}') THEN 'WORD'
               WHEN regexp_matches(t[i], '^\\p{{N}}') THEN 'NUM' ELSE 'PUNCT' END
          for i in range(p1, n_tokens + 1)] AS c1
  FROM firsts WHERE p1 > 0),
slots AS (
  SELECT 0 AS level, CAST(generate_subscripts(c0, 1) - 1 AS INTEGER) AS rel_pos, doc_id, sent_no, unnest(c0) AS value FROM cent
  UNION ALL
  SELECT 1 AS level, CAST(generate_subscripts(c1, 1) - 1 AS INTEGER) AS rel_pos, doc_id, sent_no, unnest(c1) AS value FROM cent)"""



def _dist(words: str) -> str:
    return f"""
pl AS (
  SELECT doc_id, sent_no,
         [{_positions_list('t', 'w')} for w in {words}] AS P
  FROM sent),
cyc AS (SELECT doc_id, sent_no, [CASE WHEN len(x) > 0 THEN x ELSE [1000] END for x in P] AS F FROM pl),
fi AS (SELECT doc_id, sent_no, F, CAST(generate_subscripts(F, 1) - 1 AS INTEGER) AS i, unnest(F) AS Fi FROM cyc),
fij AS (SELECT doc_id, sent_no, F, i, Fi[1] AS first_i,
               CAST(generate_subscripts(F, 1) - 1 AS INTEGER) AS j, unnest(F) AS Fj FROM fi),
fijk AS (SELECT doc_id, sent_no, F, i, first_i, j, len(Fj) AS lj,
                CAST(generate_subscripts(Fj, 1) - 1 AS INTEGER) AS k, unnest(Fj) AS pj FROM fij)"""


def _analysed() -> str:
    """Analyser lines of every token, with the forms of ``params``, and fields 1, 2 and 29."""
    stars = ",*"
    forms = "".join(f" WHEN surface = {_lit(k)} THEN {_lit(v)}" for k, v in P.SYMBOL_FORMS.items())
    bad = ", ".join(_lit(k) for k in ("(", "="))
    return f"""
feats AS (
  SELECT *, CASE WHEN is_eos THEN NULL {forms}
                 WHEN f01 = 'WORD' THEN 'WORD{stars * 5},"' || surface || ',x"{stars * 22}'
                 WHEN f01 = 'NUM' THEN {_lit(P.SHORT_NUMERAL)}
                 ELSE f01 || '{stars * 28}' END AS feats,
         bool_or(surface IN ({bad}) AND NOT is_eos) OVER (PARTITION BY doc_id, sent_no) AS faulty
  FROM cls),
analysed AS (
  SELECT *, CASE WHEN is_eos THEN 'EOS' ELSE surface || chr(9) || feats END AS line,
         CASE WHEN is_eos THEN 'EOS' ELSE string_split(feats, ',')[1] END AS a1,
         CASE WHEN is_eos THEN 'EOS' ELSE string_split(feats, ',')[2] END AS a2,
         CASE WHEN is_eos THEN 'EOS' WHEN len(string_split(feats, ',')) < 29 THEN '' ELSE '*' END AS a29
  FROM feats)"""


ORACLE: dict[str, str] = {
    "sentences": _with("SELECT doc_id, sent_no, n_tokens FROM sent"),
    "tokens": _with("SELECT doc_id, sent_no, pos, n_tokens, is_eos, surface AS f00, f01 FROM cls"),
    "sentence_lengths": _with("SELECT conv_id, turn, sent_no, n_tokens FROM sent",
                              _corpus("conversations", "conv_id, turn")
                              .split(",\ncls AS")[0]),
    "corpus_shape": _with("SELECT count(*) AS n_sentences, coalesce(max(n_tokens), 0) AS max_x, "
                          "CAST(coalesce(sum(n_tokens), 0) AS BIGINT) AS n_tokens FROM sent"),
    "wordlist_no_eos": _with("SELECT doc_id, sent_no, array_to_string(t[:len(t) - 1], ' ') AS words FROM sent"),
    "whitespace_sentences": f"""
WITH u AS (
  SELECT doc_id, list_filter(regexp_split_to_array(text, '{UNICODE_WS}'), lambda x: x <> '') AS units
  FROM documents),
s AS (SELECT doc_id, CAST(generate_subscripts(units, 1) - 1 AS INTEGER) AS sent_no, unnest(units) AS unit FROM u),
t AS (SELECT doc_id, sent_no, CAST(len(regexp_extract_all(unit, '{TOKEN_RE}')) + 1 AS INTEGER) AS n_tokens FROM s)
SELECT doc_id, sent_no, n_tokens FROM t WHERE n_tokens > 1""",
    # keywords
    "term_counts": _with("SELECT doc_id, sent_no, term, tf FROM prof"),
    "vocabulary_index": _with("SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS idx FROM stats"),
    "word_occurrence": _with(f"SELECT doc_id, sent_no, CAST(len(list_filter(t, lambda x: x = {W})) AS BIGINT) AS tf FROM sent"),
    "keyword_stats": _with(_stats_select()),
    "keyword_filter": _with(_stats_select() + f" WHERE \"binary\" >= {P.FILTER_MIN_BINARY}"),
    "keyword_sorted": _with("SELECT CAST(row_number() OVER (ORDER BY \"binary\" DESC, first_seen) AS BIGINT) AS sort_rank, "
                            "term, \"binary\", count FROM stats"),
    "position_index": _with("SELECT term, round(pos_index, 6) AS pos_index FROM stats"),
    "position_index_pct": _with("SELECT term, round(pct_index, 6) AS pct_index FROM stats"),
    "keyword_report": _with("SELECT rank, term, \"binary\", count, quote, round(pos_index, 6) AS pos_index, "
                            "round(pct_index, 6) AS pct_index FROM report", _corpus() + "," + REPORT),
    "keyword_drilldown": _with(f"""SELECT r.rank, r.term, s.doc_id, s.sent_no,
  array_to_string([CAST(i - 1 AS INTEGER) for i in range(1, len(s.t) + 1) if s.t[i] = r.term], ',') AS positions
FROM sent s, (SELECT rank, term FROM report WHERE rank = {P.DRILL_RANK}) r""", _corpus() + "," + REPORT),
    "main_element": _with(f"""SELECT term, "binary", count, "binary" / count AS quote FROM (
  SELECT term, count(*) AS "binary", CAST(sum(tf) AS BIGINT) AS count FROM (
    SELECT doc_id, sent_no, surface AS term, count(*) AS tf FROM cls WHERE NOT is_eos GROUP BY ALL) GROUP BY term), nsent
WHERE "binary" >= nsent.n * {float(P.MAIN_SHARE)!r}::DOUBLE AND "binary" = count"""),
    "recentred_report": _with(f"""SELECT CAST(row_number() OVER (ORDER BY "binary" DESC, first_seen) AS INTEGER) AS rank,
  term, "binary", count, quote, pos_index, pct_index
FROM (
  SELECT term, count(*) AS "binary", CAST(sum(tf) AS BIGINT) AS count, count(*) / sum(tf) AS quote,
         round(sum(fp) / count(*), 6) AS pos_index,
         round(sum(CASE WHEN n > 1 THEN fp * 100.0::DOUBLE / (n - 1) ELSE 0.0::DOUBLE END) / count(*), 6) AS pct_index,
         min(struct_pack(d := doc_id, s := sent_no, p := fp)) AS first_seen
  FROM (
    SELECT doc_id, sent_no, n, value AS term, min(rel_pos) AS fp, count(*) AS tf
    FROM (SELECT doc_id, sent_no, rel_pos, value, count(*) OVER (PARTITION BY doc_id, sent_no) AS n
          FROM slots WHERE level = 0)
    GROUP BY doc_id, sent_no, n, value)
  GROUP BY term), nsent
WHERE quote >= {P.RECENTRED_REPORT_PERCENT / 100.0!r}::DOUBLE
  AND "binary" > nsent.n * {float(P.RECENTRED_REPORT_PERCENT)!r}::DOUBLE / 100.0::DOUBLE""",
                              _corpus() + "," + CENTRE + "," + SLOTS),
    "conversation_report": _with(f"""SELECT CAST(row_number() OVER (ORDER BY "binary" DESC, first_seen) AS INTEGER) AS rank,
  term, "binary", count, quote, round(pos_index, 6) AS pos_index
FROM (
  SELECT term, count(*) AS "binary", CAST(sum(tf) AS BIGINT) AS count, count(*) / sum(tf) AS quote,
         sum(fp) / count(*) AS pos_index,
         min(struct_pack(c := conv_id, t := turn, s := sent_no, p := fp)) AS first_seen
  FROM (SELECT conv_id, turn, sent_no, surface AS term, min(pos) AS fp, count(*) AS tf FROM tok GROUP BY ALL)
  GROUP BY term), (SELECT count(*) AS n FROM sent) ns
WHERE quote >= {p / 100.0!r}::DOUBLE AND "binary" > ns.n * {float(p)!r}::DOUBLE / 100.0::DOUBLE""",
                                 _corpus("conversations", "conv_id, turn").split(",\ncls AS")[0]),
    "word_stats": _with(f"""SELECT term, "binary", count, quote FROM stats WHERE term = {W}"""),
    "keyword_at_least": _with(_stats_select() + f" WHERE count >= {P.FILTER_MIN_COUNT}"),
    "language_tokens": f"""
WITH lines AS (
  SELECT doc_id, lang, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS sent_no,
         unnest(string_split(text, chr(10))) AS line FROM documents),
sent AS (
  SELECT doc_id, sent_no, list_append(
    CASE WHEN lang IN ({", ".join(_lit(x) for x in P.PRESEGMENTED_LANGUAGES)})
         THEN list_filter(regexp_split_to_array(line, '{UNICODE_WS}'), lambda x: x <> '')
         ELSE regexp_extract_all(line, '{TOKEN_RE}') END, 'EOS') AS t FROM lines)
SELECT doc_id, sent_no, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS pos, CAST(len(t) AS INTEGER) AS n_tokens,
       generate_subscripts(t, 1) = len(t) AS is_eos, unnest(t) AS f00
FROM sent WHERE len(t) > 1""",
    # projections
    "level_values": _with("SELECT doc_id, sent_no, pos, f01 AS value FROM cls WHERE NOT is_eos"),
    "level_window": _with("SELECT doc_id, sent_no, pos, surface AS f00, f01, "
                          "CAST(NULL AS VARCHAR) AS f02 FROM cls WHERE NOT is_eos"),
    "level_per_sentence": _with("SELECT doc_id, sent_no, string_agg(f01, ' ' ORDER BY pos) AS line "
                                "FROM cls GROUP BY doc_id, sent_no"),
    "show_level": _with("SELECT doc_id, sent_no, string_agg(f01, ' ' ORDER BY pos) AS line "
                        "FROM cls GROUP BY doc_id, sent_no"),
    "sub_sentence_long": _with("SELECT doc_id, sent_no, pos, surface AS value FROM tok "
                               f"WHERE pos >= {P.SUB_START} AND pos < {P.SUB_STOP}"),
    "sub_sentence": _with(f"SELECT doc_id, sent_no, array_to_string(t[{P.SUB_START + 1}:{P.SUB_STOP}], ' ') AS sub FROM sent"),
    "trim_pad": _with(f"""SELECT doc_id, sent_no, array_to_string(
  CASE WHEN len(t) >= {P.TRIM_LEN} THEN t[:{P.TRIM_LEN}]
       ELSE list_concat(t, list_resize([]::VARCHAR[], {P.TRIM_LEN} - len(t), t[-1])) END, ' ') AS trimmed
FROM sent"""),
    "map_values": _with("SELECT doc_id, sent_no, array_to_string([length(x) for x in t], ',') AS lengths FROM sent"),
    # positions
    "positions_abs": _with(f"SELECT doc_id, sent_no, array_to_string({_positions_list('t', W)}, ',') AS positions FROM sent"),
    "positions_pct": _with(f"""SELECT doc_id, sent_no, CAST(row_number() OVER (PARTITION BY doc_id, sent_no ORDER BY pos) - 1 AS INTEGER) AS hit_no,
  round({_pct('pos', 'n_tokens')}, 6) AS pct FROM tok WHERE surface = {W}"""),
    "wordlist_abs": _with(f"""SELECT CAST(w.i - 1 AS INTEGER) AS word_no, w.term, s.doc_id, s.sent_no,
  array_to_string([CAST(k - 1 AS INTEGER) for k in range(1, len(s.t) + 1) if s.t[k] = w.term], ',') AS positions
FROM sent s, (SELECT generate_subscripts({_words_sql()}, 1) AS i, unnest({_words_sql()}) AS term) w"""),
    "wordlist_pct": _with(f"""SELECT CAST(w.i - 1 AS INTEGER) AS word_no, k.doc_id, k.sent_no,
  CAST(row_number() OVER (PARTITION BY w.i, k.doc_id, k.sent_no ORDER BY k.pos) - 1 AS INTEGER) AS hit_no,
  round({_pct('k.pos', 'k.n_tokens')}, 6) AS pct
FROM tok k JOIN (SELECT generate_subscripts({_words_sql()}, 1) AS i, unnest({_words_sql()}) AS term) w
  ON k.surface = w.term"""),
    "wordlist_hits": _with(f"""SELECT CAST(w.i - 1 AS INTEGER) AS word_no, w.term, k.doc_id, k.sent_no,
  string_agg(CAST(k.pos AS VARCHAR), ',' ORDER BY k.pos) AS positions
FROM tok k JOIN (SELECT generate_subscripts({_words_sql()}, 1) AS i, unnest({_words_sql()}) AS term) w
  ON k.surface = w.term GROUP BY w.i, w.term, k.doc_id, k.sent_no"""),
    "show_positions": _with(f"SELECT doc_id, sent_no, n_tokens, array_to_string({_positions_list('t', W)}, ',') AS positions FROM sent"),
    # alignment
    "centre_by_positions": _centre_sql(1),
    "centre_suffix": _centre_sql(1),
    "centre_prefix": _centre_sql(0),
    "centre_reversed": _centre_sql(-1),
    "centre_word": _with("""SELECT doc_id, sent_no,
  CAST(CASE WHEN p1 > 0 THEN n_tokens - p1 + 1 ELSE 0 END AS INTEGER) AS n,
  CASE WHEN p1 > 0 THEN array_to_string(t[p1:], ' ') ELSE '' END AS centred
FROM firsts""", _corpus() + "," + CENTRE),
    "recentred_corpus": _with("""SELECT term, count(*) AS "binary", CAST(sum(tf) AS BIGINT) AS count,
  count(*) / sum(tf) AS quote, round(sum(fp) / count(*), 6) AS pos_index,
  round(sum(CASE WHEN n > 1 THEN fp * 100.0::DOUBLE / (n - 1) ELSE 0.0::DOUBLE END) / count(*), 6) AS pct_index
FROM (
  SELECT doc_id, sent_no, n, value AS term, min(rel_pos) AS fp, count(*) AS tf
  FROM (SELECT doc_id, sent_no, rel_pos, value, count(*) OVER (PARTITION BY doc_id, sent_no) AS n
        FROM slots WHERE level = 0)
  GROUP BY doc_id, sent_no, n, value)
GROUP BY term""", _corpus() + "," + CENTRE + "," + SLOTS),
    "slot_values": _with("SELECT level, rel_pos, doc_id, sent_no, value FROM slots",
                         _corpus() + "," + CENTRE + "," + SLOTS),
    "slot_frequency": _with("""SELECT level, rel_pos, value, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT level, rel_pos, value, count(*) AS n FROM slots GROUP BY level, rel_pos, value
  UNION ALL
  SELECT level, rel_pos, NULL AS value, any_value(nsent.n) - count(*) AS n
  FROM slots, nsent GROUP BY level, rel_pos HAVING any_value(nsent.n) - count(*) > 0)
GROUP BY level, rel_pos, value""", _corpus() + "," + CENTRE + "," + SLOTS),
    "element_counts": _with("SELECT value, count(*) AS n FROM slots WHERE level = 0 AND rel_pos = 1 GROUP BY value",
                            _corpus() + "," + CENTRE + "," + SLOTS),
    # distance
    "distance": _with("""SELECT doc_id, sent_no, i, j, k, CAST(first_i - pj AS INTEGER) AS distance,
  CAST(lj AS INTEGER) AS n_j, array_to_string([len(x) for x in F], ',') AS sizes FROM fijk""",
                      _corpus() + "," + _dist(_words_sql())),
    "distance_cube": _with("""SELECT doc_id, sent_no, i, j, CAST(c AS BIGINT) AS c, CAST(first_i - Fj[c % len(Fj) + 1] AS INTEGER) AS distance
FROM (SELECT *, unnest(range(0, CAST(list_product([len(x) for x in F]) AS BIGINT))) AS c FROM fij)""",
                           _corpus() + "," + _dist("[" + ", ".join(_lit(w) for w in P.CUBE_WORDS) + "]")),
    # reshape
    "padded_sentences": _with("""SELECT doc_id, sent_no, array_to_string(t, ' ') AS values, t[-1] AS pad_value,
  CAST(m.mx - n_tokens AS INTEGER) AS pad_count
FROM sent, (SELECT max(n_tokens) AS mx FROM sent) m"""),
    "axes_moved_long": _with("""SELECT CAST(g.pos AS INTEGER) AS pos, 1 AS level, s.conv_id, s.turn, s.sent_no,
  CASE WHEN g.pos >= s.n_tokens - 1 THEN 'EOS'
       WHEN regexp_matches(s.t[g.pos + 1], '^\\p{L}') THEN 'WORD'
       WHEN regexp_matches(s.t[g.pos + 1], '^\\p{N}') THEN 'NUM' ELSE 'PUNCT' END AS value
FROM sent s, (SELECT unnest(range(0, max(n_tokens))) AS pos FROM sent) g""",
                             _corpus("conversations", "conv_id, turn").split(",\ntok AS")[0]),
    "ragged_transpose_long": f"""
WITH r AS (
  SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS "row",
         regexp_extract_all(unnest(string_split(text, chr(10))), '{TOKEN_RE}') AS cells FROM documents)
SELECT doc_id, CAST(generate_subscripts(cells, 1) - 1 AS INTEGER) AS col, "row", unnest(cells) AS value FROM r""",
    "axes_moved": _with("""SELECT pos, level, value, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT pos, 0 AS level, surface AS value, count(*) AS n FROM tok GROUP BY pos, surface
  UNION ALL
  SELECT g.pos, 0 AS level, s.t[-1] AS value, count(*) AS n
  FROM sent s, (SELECT unnest(range(0, max(n_tokens))) AS pos FROM sent) g
  WHERE g.pos >= s.n_tokens GROUP BY g.pos, s.t[-1])
GROUP BY pos, level, value"""),
    "ragged_transpose": f"""
WITH m AS (
  SELECT doc_id, [regexp_extract_all(ln, '{TOKEN_RE}') for ln in string_split(text, chr(10))] AS m FROM documents),
w AS (SELECT doc_id, m, unnest(range(0, coalesce(list_max([len(r) for r in m]), 0))) AS c FROM m)
SELECT doc_id, CAST(c AS INTEGER) AS col,
  array_to_string([CASE WHEN c < len(r) THEN r[c + 1] ELSE '_' END for r in m], ' ') AS cells
FROM w""",
    "rotated_sentence": _with("""SELECT doc_id, sent_no, 0 AS level, array_to_string(list_reverse(t), ' ') AS values FROM sent
UNION ALL
SELECT doc_id, sent_no, 1 AS level, string_agg(f01, ' ' ORDER BY pos DESC) AS values FROM cls GROUP BY doc_id, sent_no"""),
    "annotated_rejects": _with(f"""SELECT doc_id, sent_no, pos AS line_no, line AS raw_line,
  CASE WHEN surface = '(' THEN 'unclosed_quote' WHEN surface = '=' THEN 'unknown_type' ELSE 'sentence_rejected' END AS reason
FROM analysed WHERE faulty""", _corpus() + "," + _analysed()),
    "annotated_padding": _with("""SELECT level, term, count(*) AS "binary", CAST(sum(tf) AS BIGINT) AS count FROM (
  SELECT doc_id, sent_no, 1 AS level, a1 AS term, count(*) AS tf FROM analysed WHERE NOT faulty GROUP BY ALL
  UNION ALL SELECT doc_id, sent_no, 2 AS level, a2 AS term, count(*) AS tf FROM analysed WHERE NOT faulty GROUP BY ALL
  UNION ALL SELECT doc_id, sent_no, 29 AS level, a29 AS term, count(*) AS tf FROM analysed WHERE NOT faulty GROUP BY ALL)
GROUP BY level, term""", _corpus() + "," + _analysed()),
    # annotated input: the parsed classes equal the tokeniser classes (numbers carry 名詞/数詞)
    "annotated_stats": _with("""SELECT term, count(*) AS "binary", CAST(sum(tf) AS BIGINT) AS count FROM (
  SELECT doc_id, sent_no, CASE WHEN f01 = 'NUM' THEN '名詞' ELSE f01 END AS term, count(*) AS tf
  FROM cls GROUP BY ALL) GROUP BY term
UNION ALL
SELECT 'f02:' || term, count(*) AS "binary", CAST(sum(tf) AS BIGINT) AS count FROM (
  SELECT doc_id, sent_no, CASE WHEN is_eos THEN 'EOS' WHEN f01 = 'NUM' THEN '数詞' ELSE '*' END AS term, count(*) AS tf
  FROM cls GROUP BY ALL) GROUP BY term"""),
}

_WIDTH = "(SELECT CAST(max(n_tokens) AS INTEGER) FROM sent)"

ORACLE |= {
    "mixed_language_tokens": _with(f"""SELECT doc_id, sent_no, pos, n_tokens, is_eos, surface AS f00,
  CASE WHEN lang = '{P.ANALYSED_LANGUAGE}' AND f01 = 'NUM' THEN '名詞' ELSE f01 END AS f01,
  CASE WHEN is_eos THEN 'EOS' WHEN lang = '{P.ANALYSED_LANGUAGE}' THEN CASE WHEN f01 = 'NUM' THEN '数詞' ELSE '*' END END AS f02
FROM cls JOIN (SELECT doc_id, lang FROM documents) USING (doc_id)"""),
    "axes_moved_intervals": _with(f"""SELECT 1 AS level, doc_id, sent_no, start,
  coalesce(lead(start) OVER (PARTITION BY doc_id, sent_no ORDER BY start), {_WIDTH}) AS stop, value
FROM (SELECT doc_id, sent_no, pos AS start, f01 AS value,
        lag(f01) OVER (PARTITION BY doc_id, sent_no ORDER BY pos) AS before FROM cls)
WHERE value IS DISTINCT FROM before"""),
    "axes_moved_interval_counts": _with(f"""SELECT 0 AS level, start, stop, value, n FROM (
  SELECT value, start, lead(start) OVER (PARTITION BY value ORDER BY start) AS stop,
         CAST(sum(d) OVER (PARTITION BY value ORDER BY start ROWS UNBOUNDED PRECEDING) AS BIGINT) AS n
  FROM (SELECT value, start, sum(d) AS d FROM (
      SELECT surface AS value, pos AS start, 1 AS d FROM cls
      UNION ALL SELECT surface, CASE WHEN is_eos THEN {_WIDTH} ELSE pos + 1 END, -1 FROM cls)
    GROUP BY value, start HAVING sum(d) <> 0))
WHERE n > 0"""),
}

# the same questions over the stored corpus and the index
ORACLE |= {
    "stored_padded_sentences": ORACLE["padded_sentences"],
    "stored_drilldown": ORACLE["keyword_drilldown"],
    "stored_centre_by_positions": ORACLE["centre_by_positions"],
    "index_wordlist": ORACLE["wordlist_hits"],
    "index_occurrence": ORACLE["word_occurrence"],
    "term_vectors": _with("""SELECT doc_id, sent_no, any_value(nv.n) AS n_terms, string_agg(CAST(v.idx AS VARCHAR), ',' ORDER BY v.idx) AS indices,
  string_agg(CAST(p.tf AS VARCHAR), ',' ORDER BY v.idx) AS counts
FROM prof p JOIN (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM stats) v USING (term), (SELECT count(*) AS n FROM stats) nv
GROUP BY doc_id, sent_no"""),
    "wordlist_table": _with("""SELECT w.word_no, w.term, k.doc_id, k.sent_no,
  string_agg(CAST(k.pos AS VARCHAR), ',' ORDER BY k.pos) AS positions
FROM tok k JOIN words w ON k.surface = w.term GROUP BY w.word_no, w.term, k.doc_id, k.sent_no""", _corpus() + f""",
blines AS (SELECT list_append(regexp_extract_all(unnest(string_split(text, chr(10))), '{TOKEN_RE}'), 'EOS') AS t FROM benchmark),
words AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS word_no FROM (SELECT DISTINCT unnest(t) AS term FROM blines WHERE len(t) > 1))"""),
    "text_units": f"""
WITH u AS (
  SELECT doc_id // {P.FILE_DOCS} AS batch, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{UNICODE_WS}'), lambda x: x <> '') AS units
  FROM documents),
s AS (SELECT batch, doc_id, generate_subscripts(units, 1) AS i, unnest(units) AS unit FROM u),
n AS (SELECT batch, row_number() OVER (PARTITION BY batch ORDER BY doc_id, i) - 1 AS unit_no,
             CAST(len(regexp_extract_all(unit, '{TOKEN_RE}')) + 1 AS INTEGER) AS n_tokens FROM s)
SELECT batch, unit_no, n_tokens FROM n WHERE n_tokens > 1""",
    "distance_cells": _with(f"""SELECT doc_id, sent_no, i, j, CAST(c AS BIGINT) AS c, CAST(first_i - Fj[c % len(Fj) + 1] AS INTEGER) AS distance
FROM (SELECT *, unnest(range({P.CELL_FIRST}, CAST(least({P.CELL_LAST}, list_product([len(x) for x in F])) AS BIGINT))) AS c FROM fij)""",
                            _corpus() + "," + _dist("[" + ", ".join(_lit(w) for w in P.CELL_WORDS) + "]")),
}
