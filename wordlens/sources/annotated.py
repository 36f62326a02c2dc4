"""Pre-annotated (analyser output) ingestion: S3(b), S6, S6a-S6d.

Two forms.  ``parse_analyser_output`` keeps a sentence in one row (arrays, narrow, every level).
``parse_token_rows`` keeps a token in one row: lines are exploded first, so that splitting and
normalising are plain compiled expressions, only the levels asked for are built, and one
exchange by the sentence key brings a sentence's narrow rows together to set aside those of
rejected sentences.  It is the form for statistics over large annotated corpora.

Input: one row per sentence with the analyser's output string -- one token
per line, ``surface<TAB>f1,f2,...``, last line ``EOS``.  Output: a
:class:`Corpus` whose tokens carry 30 string fields, plus a ``rejects``
table for lines that cannot be normalised.  Everything is evaluated per
sentence row with array expressions (narrow); a line-per-row input is first
grouped per sentence (one shuffle, each group bounded by its sentence).

Rules (taken from the reference parser):

* the whole string is stripped, then split into lines (S6d);
* a line with exactly one tab becomes ``[surface] + features.split(',')``,
  any other line is kept as its tab pieces (S6a);
* if that gives 30 pieces it is used as is; otherwise commas inside double
  quotes are not split points (quotes stay in the value) (S6b);
* a token that still does not have 30 pieces is normalised: a first piece
  ``EOS`` gives 30 x ``EOS``; 7 pieces with piece 2 = ``数詞`` or
  ``普通名詞``, or piece 1 = ``感動詞``, are padded with ``''``; anything else
  is rejected (``unknown_type``); an odd number of quotes in a line that
  needs repair is rejected as ``unclosed_quote`` (S6c).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordlens.functions.arrays import percent
from wordlens.functions.tokenise import EOS, N_LEVELS, level_name
from wordlens.sources.corpus import Corpus
from wordlens.sources.tokenizers import AnnotatedTokenizer

# The short-token rules of the reference parser.
SHORT_TOKEN_SIZE = 7
PAD_IF_FIELD_2 = ("数詞", "普通名詞")
PAD_IF_FIELD_1 = ("感動詞",)

MODES = ("quarantine", "failfast")


#: characters Python's str.strip() removes in analyser output (ASCII whitespace)
STRIP_CHARS = " \t\n\r\x0b\x0c"


def _strip(s: Column) -> Column:
    return F.btrim(s, F.lit(STRIP_CHARS))


def _ones(s: Column, ch: str) -> Column:
    """How often an ASCII character occurs; byte lengths are known without reading the text."""
    return F.octet_length(s) - F.octet_length(F.replace(s, F.lit(ch), F.lit("")))


def _line_form(levels: Sequence[int], alone: bool) -> tuple[str, str]:
    """The rules above as one regular expression for a line break and a valid line, and the text that
    replaces them: for the end marker and each of ``levels`` a tab and its value (the marker's own
    value is empty for other tokens).  A line that cannot be normalised does not match and keeps its
    line break.  ``alone``: the text is one line (which may hold breaks of its own).

    Repeated groups are possessive, so a line is read in linear time and without recursion.
    """
    nl, end = ("", r"\z") if alone else (r"\n", r"(?=\n|\z)")
    # a character class is never followed by one of its own characters: "*" is as good as "*+", and faster
    piece, raw = rf"[^\t{nl}]*", rf"[^,\t{nl}]*"
    # commas inside quotes are no split points; an open quote reaches to the end
    quoted = rf'[^",\t{nl}]*(?:"[^"\t{nl}]*+(?:"|{end})[^",\t{nl}]*+)*+'
    closed = rf'[^",\t{nl}]*(?:"[^"\t{nl}]*"[^",\t{nl}]*+)*+'
    even = rf'(?=[^"{nl}]*+(?:"[^"{nl}]*+"[^"{nl}]*+)*+{end})'
    groups: dict[int, list[int]] = {lv: [] for lv in levels}   # numbered in the order of the text
    made = 0

    def token(forms: Sequence[str], seps: Sequence[str]) -> str:
        """Pieces of the given forms and what follows each, the asked ones captured."""
        nonlocal made
        out = ""
        for k, (form, sep) in enumerate(zip(forms, seps, strict=True)):   # written out: a counted group takes half as long again
            if k in groups:
                made += 1
                groups[k].append(made)
                form = f"({form})"
            out += form + sep
        return out

    by_comma, by_tab = ["\\t"] + [","] * (N_LEVELS - 2) + [""], ["\\t"] * (N_LEVELS - 1) + [""]
    short = SHORT_TOKEN_SIZE
    of_1, of_2 = "|".join(map(re.escape, PAD_IF_FIELD_1)), "|".join(map(re.escape, PAD_IF_FIELD_2))
    eos = rf"({EOS})(?:\t[^{nl}]*+)?+" if nl else rf"({EOS})(?:\t(?s:.*+))?+"
    first, forms = f"{even}{eos}", []
    # the common form: no quote in the surface, every quote closed.  Where commas outside quotes give a
    # full token, those inside either are none or forbid the raw split, so this split is the right one
    unquoted, bare = rf'[^"\t{nl}]*', rf'[^",\t{nl}]*'
    common = token([unquoted] + [closed] * (N_LEVELS - 1), by_comma) + end
    made += 1
    marker = made
    # and the common padded one, without quotes
    padded = rf"(?={unquoted}\t(?:(?:{of_1}),|{bare},(?:{of_2}),))"
    common_short = padded + token([unquoted] + [bare] * (short - 1), by_comma[: short - 1] + [""]) + end
    forms.append(token([piece] + [raw] * (N_LEVELS - 1), by_comma))
    forms.append(token([piece] * N_LEVELS, by_tab))
    forms.append(even + token([piece] + [quoted] * (N_LEVELS - 1), by_comma))
    # full tokens come first, whatever they start with
    full = len(forms)
    for sep, one in ((",", quoted), ("\\t", piece)):
        seps = ["\\t"] + [sep] * (short - 2) + [""]
        padded = rf"(?={piece}\t(?:(?:{of_1}){sep}|{one}{sep}(?:{of_2}){sep}))"
        forms.append(even + padded + token([piece] + [one] * (short - 1), seps))
    # the end marker comes before the padded forms, but only where no full token is
    plain = rf"(?={EOS}{end})|(?!" + "|".join(f"(?:{re.sub(CAPTURE, '(?:', f)}){end}" for f in forms[:full]) + ")"
    line = "|".join([common, rf"(?={EOS}(?:\t|{end}))(?:{plain}){first}", common_short, *forms])
    values = "".join("\t" + "".join(f"${g}" for g in [marker, *groups[lv]]) for lv in levels)
    return rf"{chr(92) + 'A' if alone else ''}\n(?:{line}){end}", f"\t${marker}{values}"


#: an opening bracket of a capturing group
CAPTURE = r"(?<!\\)\((?!\?)"


def _values(text: Column, levels: Sequence[int], alone: bool = False) -> Column:
    """A tab, the end marker or nothing, and a tab and a value for each level, line after line; a line
    that cannot be normalised is left as it is, after a line break."""
    form, values = _line_form(levels, alone)
    return F.regexp_replace(F.concat(F.lit("\n"), text), F.lit(form), F.lit(values))


def _faulty(text: Column, alone: bool = False) -> Column:
    """Whether a line of ``text`` cannot be normalised."""
    form, _ = _line_form((), alone)
    start, line = form.split(r"\n", 1)
    return F.concat(F.lit("\n"), text).rlike(rf"{start}\n(?!{line})")


def _reason(line: Column) -> Column:
    """Why a line cannot be normalised; NULL if it can.  (Raw splits of 30 pieces always can.)"""
    return F.when(_faulty(line, alone=True), F.when(_ones(line, '"') % 2 == 1, F.lit("unclosed_quote")).otherwise(F.lit("unknown_type")))


def _tokens(values: Column, levels: Sequence[int]) -> Column:
    """:func:`_values` of a sentence without faults, cut at its tabs -> ``array<struct<fNN, is_eos>>``."""
    width = len(levels) + 1
    starts = F.sequence(F.lit(1), F.size(values) - width, F.lit(width))
    return F.transform(starts, lambda i: F.struct(
        *[F.get(values, i + k).alias(level_name(lv)) for k, lv in enumerate(levels, 1)], (F.get(values, i) != "").alias("is_eos")))


def parse_analyser_output(df: DataFrame, col: str = "analysis",
                          keys: Sequence[str] = ("doc_id", "sent_no"),
                          mode: str = "quarantine", levels: Sequence[int] = tuple(range(N_LEVELS))) -> tuple[Corpus, DataFrame]:
    """Per-sentence analyser strings -> (corpus, rejects).

    ``mode='quarantine'`` (default) moves a sentence with any bad line out of
    the corpus: all its lines go to ``rejects`` (keys, ``line_no``,
    ``raw_line``, ``reason``), the good ones with the reason
    ``sentence_rejected``.  Every other sentence stays, also one without an
    end marker or with nothing else; a NULL string is an empty one, whose
    only line is rejected.  ``mode='failfast'`` raises at the first bad
    line, like the reference.  Tokens carry the fields of ``levels``.

    A sentence is read by one compiled expression; only rejected ones are cut into lines.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    keys, levels = list(keys), list(levels)
    # the text and what is made of it become attributes of a generator, so the filters
    # below cannot be pushed under it and make it again
    texts = df.select(*keys, F.inline_outer(F.array(F.struct(_strip(F.coalesce(F.col(col), F.lit(""))).alias("_text")))))
    values = texts.select(*keys, F.inline_outer(F.array(F.struct(_values(F.col("_text"), levels).alias("_values")))))
    bad = F.contains("_values", F.lit("\n"))
    if mode == "failfast":
        bad = F.when(bad, F.raise_error(F.lit("analyser line could not be normalised to 30 fields"))).otherwise(bad)
    good = (values.where(~bad).select(*keys, F.inline_outer(F.array(F.struct(F.split("_values", "\t", -1).alias("_v")))))
            .select(*keys, _tokens(F.col("_v"), levels).alias("_tok"), F.expr(f"cast((size(_v) - 1) div {len(levels) + 1} as int)").alias("n_tokens")))
    rejects = (texts.where(_faulty(F.col("_text"))).select(*keys, F.posexplode_outer(F.split("_text", "\n", -1)).alias("line_no", "raw_line"))
               .select(*keys, F.col("line_no").cast("int").alias("line_no"), "raw_line",
                       F.coalesce(_reason(F.col("raw_line")), F.lit("sentence_rejected")).alias("reason")))
    return Corpus(good, tuple(keys), AnnotatedTokenizer()), rejects


@dataclass(frozen=True)
class AnalyserTextTokenizer(AnnotatedTokenizer):
    """Analyser output as the text of a sentence, to stand beside other strategies in one
    corpus.  A sentence with a line that cannot be normalised is left out (see
    :func:`parse_analyser_output` for its rejects); ``failfast`` raises instead."""

    mode: str = "quarantine"

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")

    def prepare(self, text: Column) -> Column:
        return self.structs(text, range(N_LEVELS))

    def structs(self, text: Column, levels: Sequence[int]) -> Column:
        def read(values: Column) -> Column:
            bad = F.contains(values, F.lit("\n"))
            if self.mode == "failfast":
                line = F.regexp_extract(values, r"\n([^\n]*)", 1)
                bad = F.when(bad, F.raise_error(F.concat(F.lit("analyser line could not be normalised to 30 fields: "), line))).otherwise(bad)
            return F.when(~bad, _bound(F.split(values, "\t", -1), lambda v: _tokens(v, levels)))

        # read once, by the levels that are asked for
        return _bound(_values(_strip(text), list(levels)), read)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, the value being made once."""
    return F.transform(F.array(value), use)[0]


def sentence_lines(df: DataFrame, col: str = "analysis", keys: Sequence[str] = ("doc_id", "sent_no")) -> DataFrame:
    """Analyser strings, one per sentence -> keys, ``line_no``, ``raw_line`` (S6d)."""
    lines = F.split(_strip(F.coalesce(F.col(col), F.lit(""))), "\n", -1)
    return df.select(*keys, F.posexplode_outer(lines).alias("line_no", "raw_line"))


@dataclass(frozen=True)
class TokenRows:
    """The token form of an annotated corpus: keys, ``pos``, ``n_tokens``, ``is_eos`` and a
    column ``fNN`` for every level of ``levels``; rows of a sentence lie in one partition."""

    df: DataFrame
    keys: tuple[str, ...]
    levels: tuple[int, ...]
    #: the rows as they were read: those of rejected sentences are in it, ``_bad`` at the faulty lines
    read: DataFrame | None = None

    def corpus(self) -> Corpus:
        """The sentence form of these levels; no further exchange."""
        token = F.struct("pos", *[level_name(lv) for lv in self.levels], "is_eos")
        return Corpus(self.df.groupBy(*self.keys).agg(F.sort_array(F.collect_list(token)).alias("_tok"))
                      .withColumn("n_tokens", F.size("_tok").cast("int")), self.keys, AnnotatedTokenizer())

    def statistics(self, levels: Sequence[int] | None = None) -> DataFrame:
        """A8 (A7, A11, A12) of several levels: ``level, term, binary, count, quote,
        pos_index, pct_index``.  A sentence's rows meet by one exchange and are counted by term;
        rejected sentences are set aside among these counts, not among the rows.  The sums per
        term are added up in the tasks first."""
        levels = self.levels if levels is None else levels
        values = F.array(*[F.struct(F.lit(lv).alias("level"), F.col(level_name(lv)).alias("term")) for lv in levels])
        rows = self.df.withColumn("_bad", F.lit(False)) if self.read is None else self.read.repartition(*self.keys)
        own = rows.select(*self.keys, "pos", "_bad", F.inline(values)).groupBy(*self.keys, "level", "term").agg(
            F.min("pos").alias("fp"), F.count(F.lit(1)).alias("tf"), F.max("_bad").alias("_bad"))
        sentence = Window.partitionBy(*self.keys)
        own = (own.withColumn("_rejected", F.max("_bad").over(sentence))
               .withColumn("n_tokens", (F.sum("tf").over(sentence) / len(levels)).cast("int"))   # a token has a row at each level
               .where(~F.col("_rejected") & F.col("term").isNotNull()))
        total = own.groupBy("level", "term").agg(
            F.count(F.lit(1)).alias("binary"), F.sum("tf").alias("count"), F.avg("fp").alias("pos_index"),
            F.avg(percent(F.col("fp"), F.col("n_tokens"))).alias("pct_index"))
        return total.select("level", "term", "binary", "count", F.try_divide("binary", "count").alias("quote"), "pos_index", "pct_index")


def parse_token_rows(lines: DataFrame, keys: Sequence[str] = ("doc_id", "sent_no"), levels: Sequence[int] = tuple(range(N_LEVELS)),
                     line_no: str = "line_no", raw_line: str = "raw_line", mode: str = "quarantine") -> tuple[TokenRows, DataFrame]:
    """S6 on rows: analyser lines (keys, ``line_no``, ``raw_line``) -> (token rows, rejects).

    The same rules, modes and rejects as :func:`parse_analyser_output`; a NULL line is an
    empty one.  The lines of a sentence need not lie together or in order.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    keys = list(keys)
    line = F.coalesce(F.col(raw_line), F.lit(""))
    values = _values(line, list(levels), alone=True)
    rows = lines.select(*keys, F.col(line_no).cast("int").alias("pos"), line.alias("raw_line"), values.alias("_values"))
    bad = F.startswith("_values", F.lit("\n"))
    rows = rows.select(*keys, "pos", "raw_line", bad.alias("_bad"), F.when(~bad, F.split("_values", "\t", -1)).alias("_v"))
    reason = F.when(F.col("_bad"), F.when(_ones(F.col("raw_line"), '"') % 2 == 1, F.lit("unclosed_quote")).otherwise(F.lit("unknown_type")))
    if mode == "failfast":
        stop = F.raise_error(F.lit("analyser line could not be normalised to 30 fields"))
        reason = F.when(F.col("_bad"), stop).otherwise(reason)
        rows = rows.withColumn("_bad", F.when(F.col("_bad"), stop.cast("boolean")).otherwise(F.lit(False)))
    parsed = rows.select(*keys, "pos", "raw_line", "_bad", reason.alias("reason"), F.coalesce(F.get("_v", F.lit(1)) != "", F.lit(False)).alias("is_eos"),
                         *[F.get("_v", F.lit(k)).alias(level_name(lv)) for k, lv in enumerate(levels, 2)])
    # rows of a sentence meet: a bounded group, and the only exchange
    sentence = Window.partitionBy(*keys)
    met = parsed.drop("_bad").repartition(*keys).withColumn("_bad", F.count("reason").over(sentence)).withColumn("n_tokens", F.count(F.lit(1)).over(sentence).cast("int"))
    good = met.where(F.col("_bad") == 0).select(*keys, "pos", "n_tokens", "is_eos", *[level_name(lv) for lv in levels])
    rejects = met.where(F.col("_bad") > 0).select(
        *keys, F.col("pos").alias("line_no"), "raw_line", F.coalesce("reason", F.lit("sentence_rejected")).alias("reason"))
    return TokenRows(good, tuple(keys), tuple(levels), parsed.drop("raw_line", "reason")), rejects


def lines_to_sentences(lines: DataFrame, keys: Sequence[str] = ("doc_id", "sent_no"),
                       line_no: str = "line_no", raw_line: str = "raw_line",
                       out: str = "analysis") -> DataFrame:
    """Line-per-row analyser output -> one analyser string per sentence.

    One shuffle on the sentence key; each group is one sentence's lines.
    """
    keys = list(keys)
    grouped = lines.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col(line_no).alias("n"), F.col(raw_line).alias("l")))).alias("_ls"))
    return grouped.select(*keys, F.array_join(F.transform("_ls", lambda e: e["l"]), "\n").alias(out))


def to_analyser_format(corpus: Corpus, levels: int = N_LEVELS) -> DataFrame:
    """Write a corpus back as analyser strings (one per sentence).

    Each token becomes ``f00<TAB>f01,...`` (NULL fields as ``''``); the end
    marker becomes ``EOS``.  Used to round-trip tokenised tables through
    the analyser parser.
    """
    lv = list(range(levels))
    toks = corpus.tokenizer
    n = F.col("n_tokens")

    def line(e: Column, i: Column) -> Column:
        is_eos = toks.is_eos(e, i, n)
        vals = [F.coalesce(toks.level_value(e, is_eos, k), F.lit("")) for k in lv]
        body = F.concat(vals[0], F.lit("\t"), F.concat_ws(",", *vals[1:]))
        return F.when(is_eos, F.lit(EOS)).otherwise(body)

    return corpus.df.select(*corpus.keys, F.array_join(F.transform("_tok", line), "\n").alias("analysis"))
