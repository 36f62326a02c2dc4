"""S3(c): run an external morphological analyser on executors.

The reference calls a native analyser once per sentence and builds a new
tagger for every call.  Here the analyser is created once per Arrow batch
stream (one per task) inside ``mapInPandas`` and applied to the sentence
texts of that partition; its output strings then go through the native
S6 parser.  The analyser package is optional: ``factory`` is any callable
returning an object with ``parse(text) -> str`` (the analyser's text
format), so tests run with a stub and a cluster can plug in a real one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlens.sources.annotated import parse_analyser_output
from wordlens.sources.corpus import Corpus


def default_factory():
    """An installed MeCab tagger, if the package is present."""
    try:
        import MeCab  # type: ignore[import-not-found]
    except ImportError as exc:  # pragma: no cover - not installed here
        raise ImportError("no morphological analyser installed; pass a factory") from exc
    return MeCab.Tagger()


def analyse(df: DataFrame, factory: Callable[[], object] = default_factory,
            text_col: str = "text", keys: Sequence[str] = ("doc_id", "sent_no"),
            mode: str = "quarantine") -> tuple[Corpus, DataFrame]:
    """Sentence texts -> analyser strings (Python worker, Arrow batches) -> corpus."""
    keys = list(keys)
    schema = df.select(*keys).schema.add("analysis", "string")

    def run(batches: Iterator) -> Iterator:
        tagger = factory()
        for pdf in batches:
            out = pdf[keys].copy()
            out["analysis"] = [tagger.parse(t) if t is not None else None for t in pdf[text_col]]
            yield out

    analysed = df.select(*keys, F.col(text_col)).mapInPandas(run, schema)
    return parse_analyser_output(analysed, "analysis", keys, mode)
