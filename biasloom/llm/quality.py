"""Quality rules as weak supervision.

Each rule looks at a document's measures and votes good (1), bad (-1) or
abstains (0). How far each rule can be trusted is not set by hand: expectation
maximisation over all documents estimates, for each rule, how often it votes
each way on good and on bad documents, along with the share of good ones. The
posterior probability of quality then replaces the demand that every rule pass.
Only the counts of distinct vote patterns, at most 3 to the number of rules,
leave the executors.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biasloom.llm.common import Scratch, lean, small_batches

#: Words of a window of the repetition measure.
WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: The characters that part words.
SPACES = " \t\n\x0b\x0c\r"
#: What may stand around the letters of a plain word.
MARKS = ".,;:!?\"'()"
#: Rounds of expectation maximisation, and the change at which it ends.
ROUNDS = 200
SETTLED = 1e-9
#: What the estimates start from (see estimate), what the start counts for beside
#: the documents themselves, and documents added to each vote's count.
START_GOOD = 0.95
ANCHOR = 0.02
SMOOTH = 0.5
#: Least posterior probability of quality of a kept document.
KEEP = 0.5
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_ends", "n_upper", "n_letters", "n_distinct", "n_plain",
)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of words found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    runs = list(zip(*(words[i : i + n] for i in range(window)), strict=True))
    if len(set(runs)) == n:
        return 0
    counts = Counter(runs)
    total, upto = 0, 0
    for i, run in enumerate(runs):
        if counts[run] > 1:
            total += i + window - max(i, upto)
            upto = i + window
    return total


def measures(text: str) -> tuple[int, ...]:
    """The measures of one text, in the order of MEASURES."""
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    stripped = [line.rstrip(SPACES) for line in lines]
    letters = sum(map(len, words)) - sum(text.count(c) for c in SYMBOLS + "0123456789.,!?")
    upper = sum(w[:1].isupper() and w.isupper() and len(w) > 1 for w in words)
    return (
        len(words),
        len(text) - sum(text.count(c) for c in SPACES),
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        sum(line.endswith((".", "!", "?", '"', ":", ")")) for line in stripped),
        upper,
        max(0, letters),
        len(set(words)),
        sum(w.strip(MARKS).isalpha() for w in text.split()),
    )


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs without the text, with the measures as long columns."""
    small_batches(docs.sparkSession)
    others = [c for c in docs.columns if c != text and c not in MEASURES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measures(t or "") for t in batch["qr__text"].to_pylist()]
            found = np.array(rows, dtype=np.int64).reshape(len(rows), len(MEASURES))
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in others), *map(pa.array, found.T.copy())],
                names=[*others, *MEASURES],
            )

    source = docs.select(*others, F.col(text).cast("string").alias("qr__text"))
    empty = [F.lit(0).cast("long").alias(m) for m in MEASURES]
    return source.mapInArrow(lean(run), docs.select(*others, *empty).schema)


def rules() -> dict[str, tuple[Column, Column]]:
    """For each rule, when it votes bad and when it votes good; else it abstains."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    mean = F.col("word_chars") / words
    symbols = F.col("n_symbols") / words
    repeats = F.col("n_repeat_words") / words
    copies = F.col("n_dup_lines") / lines
    ends = F.col("n_ends") / lines
    shouted = F.col("n_upper") / words
    letters = F.col("n_letters") / F.greatest(F.col("word_chars"), F.lit(1))
    plain = F.col("n_plain") / words
    distinct = F.col("n_distinct") / F.sqrt(words.cast("double"))
    return {
        "length": (F.col("n_words") < 20, F.col("n_words") >= 60),
        "word_length": ((mean < 2.5) | (mean > 12), mean.between(3.5, 9)),
        "symbols": (symbols > 0.25, symbols < 0.02),
        "repeats": (repeats > 0.3, repeats == 0),
        "copied_lines": (copies > 0.3, (copies == 0) & (lines >= 3)),
        "sentence_ends": (ends < 0.2, ends > 0.8),
        "shouting": (shouted > 0.3, shouted < 0.05),
        "letters": (letters < 0.6, letters > 0.85),
        "plain_words": (plain < 0.7, plain > 0.9),
        "vocabulary": (distinct < 2.0, distinct > 4.0),
    }


def votes() -> Column:
    """The rules' votes on a row of measures, as an array of -1, 0 and 1."""
    return F.array(*(F.when(bad, -1).when(good, 1).otherwise(0) for bad, good in rules().values()))


def estimate(patterns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Log-evidence of each vote of each rule, and the log-odds of good documents.

    patterns has a row of votes for each distinct pattern, counts how many
    documents have it. Entry [rule, vote + 1] is log P(vote | good) / P(vote | bad).

    The first expectation is the all-must-pass filter, with doubt: START_GOOD
    for a document that no rule votes against, its complement for any other.
    What the rules show under it also stays in each later estimate, with the
    weight of a share of all documents, so that the classes keep their meaning.
    """
    total = counts.sum()
    onehot = (patterns[:, :, None] == np.array([-1, 0, 1])).astype(float)
    refused = (patterns == -1).any(axis=1)
    good = np.where(refused, 1 - START_GOOD, START_GOOD)

    def votes_of(chance: np.ndarray) -> np.ndarray:
        return ((counts * chance)[:, None, None] * onehot).sum(0) + SMOOTH

    def share_of(votes: np.ndarray) -> np.ndarray:
        return votes / votes.sum(1, keepdims=True)

    anchors = [share_of(votes_of(chance)) for chance in (1 - good, good)]
    tables, share = anchors, (counts @ good + 1) / (total + 2)
    for _ in range(ROUNDS):
        weight = np.log(tables[1]) - np.log(tables[0])
        odds = np.log(share / (1 - share)) + (onehot * weight).sum((1, 2))
        before, good = good, 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        if np.abs(good - before).max(initial=0) < SETTLED:
            break
        share = (counts @ good + 1) / (total + 2)
        tables = [
            share_of(votes_of(chance) + ANCHOR * (counts @ chance) * anchor)
            for chance, anchor in zip((1 - good, good), anchors, strict=True)
        ]
    weight = np.log(tables[1]) - np.log(tables[0])
    # A vote for good is never evidence against, nor the other way round.
    weight[:, 2] = np.maximum(weight[:, 2], 0)
    weight[:, 0] = np.minimum(weight[:, 0], 0)
    weight[:, 1] = 0.0
    return weight, float(np.log(share / (1 - share)))


def judge(
    docs: DataFrame, scratch: Scratch, id: str = "doc_id", text: str = "text", keep: float = KEEP
) -> DataFrame:
    """Rows (id, measures, votes, posterior, base_failed, kept), one a row of docs.

    A null text has no words. ``base_failed``: under 20 words, or over 30 % of
    them in repeated windows; such documents are never kept. The others are
    kept if their posterior probability of quality (to nine digits) is ``keep`` or
    more, so at a tie they stay. Repeated rows come back as often as they came. An
    empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(id).alias("doc"), F.col(text).alias("text"))
    rows = scratch.keep(measured(rows).withColumn("votes", votes()), "measures")
    counted = rows.groupBy("votes").count().collect()
    n = len(rules())
    patterns = np.array([r["votes"] for r in counted], dtype=np.int64).reshape(-1, n)
    weight, prior = estimate(patterns, np.array([r["count"] for r in counted], dtype=float))
    odds = F.lit(prior)
    for k in range(n):
        row = F.array(*(F.lit(float(x)) for x in weight[k]))
        odds = odds + F.element_at(row, F.element_at("votes", k + 1) + 2)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (
        rows.withColumn("posterior", F.round(1 / (1 + F.exp(-odds)), 9))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep))
        .withColumnRenamed("doc", id)
    )
