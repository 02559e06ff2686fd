"""Document quality rules as a short-circuit cascade.

A rule looks at a document and rejects it or not; a document is kept if none rejects it. Each task
runs all rules over the first documents it gets, under a clock, and from then on runs them in the order of
rejections per second, up to the first that rejects. The order changes the time only, never
a verdict: so tasks may differ, a repeated task gives the same rows, and no pass over the input
and no step on the driver is needed for the sample.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomosaic.llm.common import WordHash, slices, texts_of, word_hashes

#: Documents from which a task takes cost and selectivity of the rules.
SAMPLE = 200
MIN_WORDS = 50
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


class Doc:
    """A text, with what rules ask of it worked out once and only when asked for."""

    def __init__(self, text: bytes, cache: WordHash):
        self.text, self.cache = text, cache

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def byte_counts(self) -> np.ndarray:
        return np.bincount(np.frombuffer(self.text, np.uint8), minlength=256)

    @cached_property
    def word_chars(self) -> int:
        """Code points that are not white space: bytes without those that continue a code point."""
        counts = self.byte_counts
        return int(counts[:0x80].sum() + counts[0xC0:].sum() - counts[9:14].sum() - counts[32])

    @cached_property
    def n_symbols(self) -> int:
        return int(self.byte_counts[list(b"#*$%&|<>")].sum())

    @cached_property
    def n_marks(self) -> int:
        return int(self.byte_counts[list(b"!?")].sum())

    @cached_property
    def n_upper(self) -> int:
        return int(self.byte_counts[65:91].sum())

    @cached_property
    def n_lower(self) -> int:
        return int(self.byte_counts[97:123].sum())

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines that hold a word."""
        return [line for line in self.text.split(b"\n") if line.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that lie in a window of three words which the text has twice or more."""
        if self.n_words < 4:
            return 0
        hashes = word_hashes(self.words, self.cache)
        windows = hashes[:-2] * _FACTORS[0] + hashes[1:-1] * _FACTORS[1] + hashes[2:] * _FACTORS[2]
        _, place, count = np.unique(windows, return_inverse=True, return_counts=True)
        again = count[place] > 1
        covered = np.zeros(self.n_words, bool)
        for k in range(3):
            covered[k : k + len(again)] |= again
        return int(covered.sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Doc], bool]
    #: True for the rules that alone make ``base_failed``.
    base: bool = False


RULES = (
    Rule("few words", lambda d: d.n_words < MIN_WORDS, base=True),
    Rule("repeated windows", lambda d: 100 * d.n_repeat_words > 50 * d.n_words, base=True),
    Rule("symbols", lambda d: 100 * d.n_symbols > 10 * d.n_words),
    Rule("exclamations", lambda d: 100 * d.n_marks > 20 * d.n_words),
    Rule("capitals", lambda d: 2 * d.n_upper > d.n_lower + d.n_upper),
    Rule("word length", lambda d: not 2 * d.n_words <= d.word_chars <= 15 * d.n_words),
    Rule("repeated lines", lambda d: 100 * d.n_dup_lines > 50 * len(d.lines)),
)


def by_rejection_per_cost(seconds: list[float], rejected: list[int]) -> list[int]:
    """Places of the rules, the most rejections per second first; ties in the given order."""
    return sorted(range(len(seconds)), key=lambda k: -rejected[k] / max(seconds[k], 1e-9))


class Cascade:
    """Verdicts on documents one after another."""

    def __init__(self, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE):
        self.rules, self.left = rules, sample
        self.seconds, self.rejected = [0.0] * len(rules), [0] * len(rules)
        self.cache = WordHash()

    def keeps(self, doc: Doc) -> bool:
        if self.left:
            return self._measure(doc)
        return not any(rule.rejects(doc) for rule in self.rules)

    def _measure(self, doc: Doc) -> bool:
        """Run every rule on the bare text, so that none gains from what another has worked out."""
        verdict = True
        for k, rule in enumerate(self.rules):
            fresh, began = Doc(doc.text, self.cache), time.perf_counter()
            rejected = rule.rejects(fresh)
            self.seconds[k] += time.perf_counter() - began
            self.rejected[k] += rejected
            verdict &= not rejected
        self.left -= 1
        if not self.left:
            self.rules = tuple(self.rules[k] for k in by_rejection_per_cost(self.seconds, self.rejected))
        return verdict


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) of each row.

    Null text counts as empty and is rejected for its few words. Rows are judged one by one, so repeated
    rows, null ids and empty tables need no care. Other columns of ``docs`` (doc_id, text, ...) are ignored.
    """

    def run(batches):
        cascade, base = Cascade(rules), [r for r in rules if r.base]
        for part, texts in slices(batches, "text"):
            docs_of = [Doc(t, cascade.cache) for t in texts]
            kept = [cascade.keeps(d) for d in docs_of]
            numbers = [pa.array([getattr(d, c) for d in docs_of], pa.int64()) for c in _NUMBERS]
            failed = [any(r.rejects(d) for r in base) for d in docs_of]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *numbers, pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_())],
                ["doc_id", *_NUMBERS, "base_failed", "kept"],
            )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(run, f"doc_id long, {', '.join(f'{c} long' for c in _NUMBERS)}, base_failed boolean, kept boolean")


_NUMBERS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def good(text: str, rules: tuple[Rule, ...] = RULES) -> Column:
    """A condition on a text column: no rule rejects it. Only here does the cascade save its work."""

    @F.arrow_udf("boolean")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cascade = Cascade(rules)
        for batch in batches:
            yield pa.array([cascade.keeps(Doc(t, cascade.cache)) for t in texts_of(batch)], pa.bool_())

    return run(F.col(text))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs``, all columns, that no rule rejects."""
    return docs.where(good("text", rules))
