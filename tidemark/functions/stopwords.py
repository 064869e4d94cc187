"""Default English stop words for keyword labels; pass another list to replace them."""

from __future__ import annotations

import functools

from pyspark.ml.feature import StopWordsRemover


@functools.cache
def english_stop_words() -> tuple[str, ...]:
    """The English list that ships with Spark ML; needs a running session."""
    return tuple(StopWordsRemover.loadDefaultStopWords("english"))
