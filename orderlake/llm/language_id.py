"""Language identification by multilingual mixture inference.

A language is a distribution over hashed byte n-grams (one to three bytes of the letters
of a text, with a space round each word). A document is taken as a mixture: each of its
n-grams comes from one of a set of languages, in proportions that expectation-
maximisation estimates from the n-gram likelihoods. Which languages are in the set is
decided by penalised likelihood: starting from all of them, the one whose removal costs
least goes, as long as the loss in likelihood is below half the logarithm of the number
of n-grams. The language of the largest proportion is the prediction, that proportion
the score.

The distributions are learned from a sample of the labelled rows: for each language
``per_language`` rows, of texts up to ``max_text_bytes``, the first by a hash of their
id. Scoring runs in the tasks, over all rows and whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType

from orderlake.llm.tables import crc_part, few_of, fields, first_of_each, id_type

UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
MAX_GRAM = 3
SLOTS = 1 << 14
#: Added to each slot's count, so that nothing is impossible in any language.
SMOOTHING = 0.5
#: Bytes of letters that are worked on at once.
BLOCK = 1 << 20


@dataclass(frozen=True)
class LanguageModel:
    """Languages in order, and the probability of each slot in each of them."""

    languages: tuple[str, ...]
    likelihood: np.ndarray


def gram_counts(text: str | None) -> np.ndarray | None:
    """How often each slot occurs in the text; None if it has no letter.

    Lower-cased letters count, and one space for whatever stands between words.
    """
    words = LETTERS.findall((text or "").lower())
    if not words:
        return None
    data = np.frombuffer(f" {' '.join(words)} ".encode(), np.uint8)
    counts = np.zeros(SLOTS, np.int64)
    for at in range(0, len(data), BLOCK):
        part = data[at : at + BLOCK + MAX_GRAM - 1].astype(np.uint32)
        code = np.zeros(len(part), np.uint32)
        for n in range(1, MAX_GRAM + 1):
            m = min(BLOCK, len(part) - n + 1)
            if m <= 0:
                break
            code = code[:m] * np.uint32(257) + part[n - 1 : n - 1 + m] + np.uint32(n)
            slots = (code * np.uint32(0x9E3779B1)) >> np.uint32(18)
            counts += np.bincount(slots, minlength=SLOTS)
    return counts


def learn(sample: list[tuple[str, str]]) -> LanguageModel:
    """A model of (text, language) rows; without rows it knows no language."""
    totals: dict[str, np.ndarray] = {}
    for text, language in sample:
        counts = gram_counts(text)
        if counts is not None:
            totals[language] = totals.get(language, 0) + counts
    languages = tuple(sorted(totals))
    table = np.zeros((SLOTS, len(languages)))
    for i, language in enumerate(languages):
        smooth = totals[language] + SMOOTHING
        table[:, i] = smooth / smooth.sum()
    return LanguageModel(languages, table)


def _proportions(
    likelihood: np.ndarray, counts: np.ndarray, rounds: int = 30, close: float = 1e-3
) -> tuple[np.ndarray, float]:
    """Proportions by expectation-maximisation, and the log-likelihood they reach."""
    n = counts.sum()
    share = np.full(likelihood.shape[1], 1 / likelihood.shape[1])
    for _ in range(rounds if len(share) > 1 else 0):
        new = share * ((counts / (likelihood @ share)) @ likelihood) / n
        moved = np.abs(new - share).max()
        share = new
        if moved < close:
            break
    return share, float(counts @ np.log(likelihood @ share))


def infer(model: LanguageModel, text: str | None) -> tuple[str, float]:
    """The language with the largest proportion, and the proportion; ties by name.

    ``und`` and 0 for a text without letters, or if the model knows no language.
    """
    counts = gram_counts(text)
    if counts is None or not model.languages:
        return UNKNOWN, 0.0
    slots = np.flatnonzero(counts)
    likelihood, weights = model.likelihood[slots], counts[slots].astype(np.float64)
    names = list(range(len(model.languages)))
    share, reached = _proportions(likelihood, weights)
    penalty = 0.5 * np.log(weights.sum())
    while len(names) > 1:
        # The language that explains least is the cheapest to leave out.
        weakest = int(np.argmin(share))
        rest = [i for i in range(len(names)) if i != weakest]
        less, lower = _proportions(likelihood[:, rest], weights)
        if reached - lower >= penalty:
            break
        names, likelihood = [names[i] for i in rest], likelihood[:, rest]
        share, reached = less, lower
    best = int(np.argmax(share))
    return model.languages[names[best]], float(share[best])


def language_sample(
    docs: DataFrame,
    per_language: int,
    max_text_bytes: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 4,
    held_out: int = 2,
) -> list[tuple[str, str]]:
    """At most ``per_language`` (text, language) pairs of each language, none held out.

    Rows of a null id, text or language are no examples. The number of languages is
    that of the labels in use, which does not grow with the rows. The rows are counted
    by language first, without reading texts, so that only a few have to be sorted.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).filter((crc_part("id", folds) != held_out) & F.col("lang").isNotNull())
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    few = rows.filter(few_of(F.col("lang"), counts, per_language, "id")).filter(
        F.octet_length("text") <= max_text_bytes
    )
    return [(r.text, r.lang) for r in first_of_each(few, "lang", per_language).collect()]


def identify(
    docs: DataFrame,
    model: LanguageModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 4,
    held_out: int = 2,
) -> DataFrame:
    """(id_col, held_out, lang_pred, score) of every row of ``docs``.

    ``lang_pred`` is ``und``, with score 0, for a null text or one without letters. A
    null id was never learned from and counts as held out. Rows that repeat are judged
    one by one; other columns are not looked at.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [infer(model, x.as_py()) for x in part.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array([language for language, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                names=[id_col, "held_out", "lang_pred", "score"],
            )

    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(crc_part(id_col, folds) == held_out, F.lit(True)).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    return rows.mapInArrow(
        batches,
        fields(
            (id_col, id_type(docs, id_col)),
            ("held_out", BooleanType()),
            ("lang_pred", StringType()),
            ("score", DoubleType()),
        ),
    )


def identify_languages(
    docs: DataFrame, per_language: int = 500, max_text_bytes: int = 1 << 20
) -> DataFrame:
    """Learn from the labelled rows that are not held out, then judge all of ``docs``."""
    return identify(docs, learn(language_sample(docs, per_language, max_text_bytes)))
