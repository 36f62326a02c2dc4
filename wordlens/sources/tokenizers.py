"""Tokeniser strategies (the reference's ``tokenizer`` callable, U1).

A strategy turns the text of one sentence into a per-sentence token array
(``_tok``, EOS included as the last element) and knows how to read one
analyser level out of it, either for the whole sentence (sentence form)
or for one exploded element (long form).  All of it is native Spark
expressions, so a corpus is built with narrow transformations only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import ClassVar

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordlens.functions.tokenise import (
    EOS,
    LEVEL_NAMES,
    N_LEVELS,
    level_name,
    regex_tokens,
    token_class,
    with_eos,
)


class TokenizerStrategy:
    """Interface; see :class:`RegexTokenizer` and :class:`AnnotatedTokenizer`."""

    #: Spark SQL type of one element of ``_tok``
    element_type: ClassVar[str] = "string"
    #: columns of the sentence form that reading a level needs beside ``_tok``
    needs: tuple[str, ...] = ()

    def is_eos(self, elem: Column, pos: Column, n_tokens: Column) -> Column:
        """Whether an exploded element is the end marker (the last one, added by ``prepare``)."""
        return pos == n_tokens - 1

    def eos_array(self, tok: Column) -> Column:
        """:meth:`is_eos` of every element of ``_tok``: ``array<boolean>``."""
        return F.slice(F.array_append(F.array_repeat(F.lit(False), F.size(tok) - 1), F.lit(True)), 1, F.size(tok))

    def word_array(self, tok: Column, level: int) -> Column:
        """:meth:`level_array` without the end marker; an empty sentence stays empty."""
        return F.slice(self.level_array(tok, level), 1, F.greatest(F.size(tok) - 1, F.lit(0)))

    def prepare(self, text: Column) -> Column:  # pragma: no cover - interface
        """``text`` of one sentence -> ``_tok`` array (EOS last)."""
        raise NotImplementedError

    def level_array(self, tok: Column, level: int) -> Column:  # pragma: no cover
        """``_tok`` -> ``array<string>`` of one level, EOS kept."""
        raise NotImplementedError

    def level_value(self, elem: Column, is_eos: Column, level: int) -> Column:  # pragma: no cover
        """One exploded ``_tok`` element -> its value at ``level``."""
        raise NotImplementedError

    def structs(self, text: Column, levels: Sequence[int]) -> Column:
        """``text`` of one sentence -> its :meth:`token_structs`."""
        return self.token_structs(self.prepare(text), levels)

    def token_structs(self, tok: Column, levels: Sequence[int]) -> Column:
        """``_tok`` as ``array<struct<fNN of levels, is_eos>>``, the form that all strategies share."""
        def all_of(t: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                is_eos = self.is_eos(x, i, F.size(t))
                return F.struct(*[self.level_value(x, is_eos, lv).alias(level_name(lv)) for lv in levels], is_eos.alias("is_eos"))

            return F.transform(t, one)

        # bound to a name first, so that the tokeniser runs once and not for every token
        return F.transform(F.array(tok), all_of)[0]

    def info(self, elem: Column, is_eos: Column, levels: list[int] | None = None) -> Column:
        levels = list(range(N_LEVELS)) if levels is None else levels
        return F.struct(*[self.level_value(elem, is_eos, lv).alias(level_name(lv)) for lv in levels])


@dataclass(frozen=True)
class RegexTokenizer(TokenizerStrategy):
    """Letters-run / digits-run / single-symbol tokeniser (native regex).

    Fills level 0 (surface) and level 1 (class); levels 2..29 are NULL,
    and the end marker carries ``EOS`` on every level.
    """

    element_type: ClassVar[str] = "string"

    def prepare(self, text: Column) -> Column:
        return with_eos(regex_tokens(text))

    def level_array(self, tok: Column, level: int) -> Column:
        level_name(level)
        if level == 0:
            return tok
        last = F.size(tok) - 1
        if level == 1:
            # the marker is put there once, not asked for at every token
            words = F.slice(tok, 1, F.greatest(last, F.lit(0)))
            return F.slice(with_eos(F.transform(words, token_class)), 1, F.size(tok))
        return F.transform(
            tok, lambda x, i: F.when(i == last, F.lit(EOS)).otherwise(F.lit(None).cast("string")))

    def level_value(self, elem: Column, is_eos: Column, level: int) -> Column:
        level_name(level)
        if level == 0:
            return elem
        if level == 1:
            return F.when(is_eos, F.lit(EOS)).otherwise(token_class(elem))
        return F.when(is_eos, F.lit(EOS)).otherwise(F.lit(None).cast("string"))


@dataclass(frozen=True)
class PresegmentedTokenizer(RegexTokenizer):
    """Text that is already segmented: tokens are separated by whitespace.

    Level 0 is the token, level 1 its class (as for :class:`RegexTokenizer`).
    """

    def prepare(self, text: Column) -> Column:
        return with_eos(F.filter(F.split(text, r"(?U)\s+", -1), lambda s: s != ""))


@dataclass(frozen=True)
class AnnotatedTokenizer(TokenizerStrategy):
    """Tokens that already carry 30 analyser fields (``array<struct<f00..f29, is_eos>>``).

    ``prepare`` expects the per-sentence token array produced by
    :func:`wordlens.sources.annotated.parse_analyser_output`.  A level is a
    struct field, so a stored corpus is read one field at a time.
    """

    element_type: ClassVar[str] = "struct"

    def prepare(self, text: Column) -> Column:
        return text

    def level_array(self, tok: Column, level: int) -> Column:
        return tok[level_name(level)]

    def level_value(self, elem: Column, is_eos: Column, level: int) -> Column:
        return elem[level_name(level)]

    def is_eos(self, elem: Column, pos: Column, n_tokens: Column) -> Column:
        return elem["is_eos"]

    def eos_array(self, tok: Column) -> Column:
        return tok["is_eos"]

    def word_array(self, tok: Column, level: int) -> Column:
        return F.filter(tok, lambda t: ~t["is_eos"])[level_name(level)]


@dataclass(frozen=True)
class LanguageTokenizer(TokenizerStrategy):
    """Chooses a strategy per row from a language column (U4)."""

    lang_col: str = "lang"
    #: (strategy, its languages); every other language and NULL take ``default``
    choices: tuple[tuple[TokenizerStrategy, tuple[str, ...]], ...] = ()
    default: TokenizerStrategy = RegexTokenizer()

    @staticmethod
    def of(lang_col: str, registry: dict[str, TokenizerStrategy], default: TokenizerStrategy,
           levels: Sequence[int] = tuple(range(N_LEVELS))) -> LanguageTokenizer | MixedTokenizer:
        by_strategy: dict[TokenizerStrategy, list[str]] = {}
        for lang, strategy in registry.items():
            by_strategy.setdefault(strategy, []).append(lang)
        choices = tuple((s, tuple(ls)) for s, ls in by_strategy.items() if s != default)
        if len({s.element_type for s in [*by_strategy, default]}) > 1:
            return MixedTokenizer(lang_col=lang_col, choices=choices, default=default, levels=tuple(levels))
        return LanguageTokenizer(lang_col, choices, default)

    @property
    def needs(self) -> tuple[str, ...]:
        return (self.lang_col,)

    def _pick(self, read: Callable[[TokenizerStrategy], Column]) -> Column:
        out = read(self.default)
        for strategy, langs in self.choices:
            out = F.when(F.col(self.lang_col).isin(*langs), read(strategy)).otherwise(out)
        return out

    def prepare(self, text: Column) -> Column:
        return self._pick(lambda s: s.prepare(text))

    def level_array(self, tok: Column, level: int) -> Column:
        return self._pick(lambda s: s.level_array(tok, level))

    def word_array(self, tok: Column, level: int) -> Column:
        return self._pick(lambda s: s.word_array(tok, level))

    def level_value(self, elem: Column, is_eos: Column, level: int) -> Column:
        return self._pick(lambda s: s.level_value(elem, is_eos, level))

    def is_eos(self, elem: Column, pos: Column, n_tokens: Column) -> Column:
        return self._pick(lambda s: s.is_eos(elem, pos, n_tokens))

    def eos_array(self, tok: Column) -> Column:
        return self._pick(lambda s: s.eos_array(tok))


@dataclass(frozen=True)
class MixedTokenizer(AnnotatedTokenizer):
    """Strategies of different element types in one corpus (U4): every token becomes the
    struct that analysed tokens have, with the fields of ``levels``, when its row is read;
    from then on no operator needs to know which strategy read it."""

    lang_col: str = "lang"
    choices: tuple[tuple[TokenizerStrategy, tuple[str, ...]], ...] = ()
    default: TokenizerStrategy = RegexTokenizer()
    levels: tuple[int, ...] = tuple(range(N_LEVELS))

    @property
    def needs(self) -> tuple[str, ...]:
        return (self.lang_col,)

    def prepare(self, text: Column) -> Column:
        out = self.default.structs(text, self.levels)
        for strategy, langs in self.choices:
            out = F.when(F.col(self.lang_col).isin(*langs), strategy.structs(text, self.levels)).otherwise(out)
        return out


#: Language registry (U4): ``documents.lang`` -> tokeniser strategy.
#: Japanese needs an external analyser (see ``sources.analyser``) or
#: pre-annotated input; the regex strategy is the default for the rest.
LANGUAGES: dict[str, TokenizerStrategy] = {
    "en": RegexTokenizer(),
    "de": RegexTokenizer(),
    "fr": RegexTokenizer(),
    "es": RegexTokenizer(),
}

__all__ = ["AnnotatedTokenizer", "LANGUAGES", "LEVEL_NAMES", "LanguageTokenizer", "MixedTokenizer", "PresegmentedTokenizer", "RegexTokenizer",
           "TokenizerStrategy"]
