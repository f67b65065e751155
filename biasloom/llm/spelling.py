"""Grouping of spelling variants by blocked Gram matrices.

A word is a vector of letter counts. One inserted or deleted letter puts two
words at squared distance 1 and one length apart, a replaced one at squared
distance 2 with equal length. So blocks of words of one length are multiplied
with themselves and with the block one letter longer; a matrix product gives all
squared distances of two blocks, and pairs of at most two are verified letter by
letter.

Which blocks meet is settled by parts of the alphabet. The letters are cut into
PARTS parts; one edit touches two of them at most, so near words agree in all
counts of some PARTS - 2 parts, and only blocks that do are multiplied. Every
word goes to one group for each such choice of parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biasloom.llm.common import Scratch, lean, small_batches

#: Letters a word is made of, after A-Z are in lower case: a-z, U+00C0 to U+00FF.
LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]
LEAST_LETTERS = 7
LEAST_COUNT = 2
#: A word's form occurs this many times as often as the word.
FORM_TIMES = 10
PARTS = 4
CHOICES = list(combinations(range(PARTS), PARTS - 2))
#: Words of one group that a task holds; larger groups meet in blocks of this size.
BLOCK_WORDS = 16_384
#: Small groups are multiplied together until they have this many words.
JOINT_WORDS = 768
#: Rows and columns of one matrix product.
TILE = 2048
#: Bytes of letters compared at once.
VERIFY_BYTES = 8 << 20

PAIRS = "a string, b string, a_n long, b_n long"
ROUTED = "choice int, key long, word string, n long"


def words(docs: DataFrame, deleting: int | None, id: str, text: str) -> DataFrame:
    """Distinct words and how often they occur, rarer and shorter ones left out.

    Runs of letters, A-Z in lower case. With ``deleting`` k, a run loses a letter
    where the crc32 of ``<id>:<run>`` is a multiple of k (see group()).
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # Shorter runs give no word; the others are met whole, as the pattern is greedy.
    pattern = "[A-Za-zÀ-ÿ]{%d,}" % LEAST_LETTERS
    runs = docs.select(
        F.coalesce(F.col(id).cast("string"), F.lit("")).alias("of"),
        F.explode(F.regexp_extract_all(F.col(text).cast("string"), F.lit(pattern), F.lit(0))).alias(
            "run"
        ),
    )
    plain = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", upper, upper.lower()))
    runs = runs.withColumn("run", F.coalesce(plain, "run"))
    word = F.col("run")
    if deleting:
        hashed = F.crc32(F.concat("of", F.lit(":"), "run").cast("binary"))
        place = (hashed % F.length("run")).cast("int")
        shorter = F.concat(
            F.substring(F.col("run"), F.lit(1), place),
            F.substring(F.col("run"), place + 2, F.length("run")),
        )
        word = F.when(hashed % deleting == 0, shorter).otherwise(word)
    found = runs.select(word.alias("word")).filter(F.length("word") >= LEAST_LETTERS)
    return found.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def parts_of(vocabulary: DataFrame) -> np.ndarray:
    """The part of each letter, so that all parts have about as many letters in words."""
    letters = vocabulary.select(F.explode(F.split("word", "")).alias("letter"))
    # One row a letter of the alphabet.
    counts = {r[0]: r[1] for r in letters.groupBy("letter").count().collect()}
    load, part = [0] * PARTS, np.zeros(len(LETTERS), dtype=np.int64)
    names = [chr(code) for code in LETTERS]
    for k in sorted(range(len(names)), key=lambda k: (-counts.get(names[k], 0), k)):
        part[k] = load.index(min(load))
        load[part[k]] += counts.get(names[k], 0) + 1
    return part


class Letters:
    """Words as letter codes on end, with their letter counts."""

    PLACE = np.zeros(256, dtype=np.int64)
    PLACE[LETTERS] = np.arange(len(LETTERS))

    def __init__(self, words: list[str]):
        # Letters of words all have one byte in this encoding.
        data = "".join(words).encode("latin-1")
        self.codes = np.frombuffer(data, dtype=np.uint8)
        self.lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        self.begins = np.cumsum(self.lengths) - self.lengths

    def counts(self) -> np.ndarray:
        row = np.repeat(np.arange(len(self.lengths)), self.lengths)
        n = len(self.lengths) * len(LETTERS)
        flat = np.bincount(row * len(LETTERS) + self.PLACE[self.codes], minlength=n)
        return flat.reshape(len(self.lengths), len(LETTERS))

    def spelled(self, rows: np.ndarray, length: int) -> np.ndarray:
        """Rows of one length as a matrix of letters."""
        return self.codes[self.begins[rows][:, None] + np.arange(length)]


def part_keys(counts: np.ndarray, part: np.ndarray) -> np.ndarray:
    """A number for each word and part; words that agree in a part share its number."""
    weights = np.random.default_rng(7).integers(1, 1 << 63, len(LETTERS), dtype=np.uint64)
    cast = counts.astype(np.uint64)
    return np.stack([cast[:, part == k] @ weights[part == k] for k in range(PARTS)], axis=1)


def _router(part: np.ndarray):
    """A row (choice, key, word, n) for each word and choice of parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            parts = part_keys(Letters(batch["word"].to_pylist()).counts(), part)
            keys = [
                sum((parts[:, k] * np.uint64(2 * at + 3) for at, k in enumerate(choice)), np.uint64(0))
                for choice in CHOICES
            ]
            again = pa.array(np.tile(np.arange(n), len(CHOICES)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(len(CHOICES), dtype=np.int32), n)),
                    pa.array(np.concatenate(keys).view(np.int64)),
                    batch["word"].take(again),
                    batch["n"].take(again),
                ],
                names=["choice", "key", "word", "n"],
            )

    return lean(run)


def _one_edit(letters: Letters, a: np.ndarray, b: np.ndarray, length: int, longer: bool):
    """Which pairs differ by exactly one letter; b has the length of a, or one more."""
    keep = np.zeros(len(a), dtype=bool)
    step = max(1, VERIFY_BYTES // length)
    for at in range(0, len(a), step):
        x = letters.spelled(a[at : at + step], length)
        y = letters.spelled(b[at : at + step], length + longer)
        if longer:
            front = np.minimum.accumulate(x == y[:, :-1], axis=1).sum(axis=1)
            back = np.minimum.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(axis=1)
            keep[at : at + step] = front + back >= length
        else:
            keep[at : at + step] = (x != y).sum(axis=1) == 1
    return keep


def near(words: list[str], group: np.ndarray, side: np.ndarray, choice: np.ndarray, part):
    """Pairs (a, b) of places of near words of a group, from Gram matrices.

    ``side`` is 0 or 1 where two blocks of a large group meet, whose words pair
    across only, else 2. A pair that agrees in several choices of parts is given in
    the first of them alone.
    """
    letters = Letters(words)
    counts = letters.counts()
    used = np.flatnonzero(counts.any(axis=0))
    # Squares of counts are summed exactly.
    kind = np.float32 if letters.lengths.max(initial=0) < 2048 else np.float64
    vectors = counts[:, used].astype(kind)
    squares = (vectors * vectors).sum(axis=1)
    one = np.ones((len(words), 1), dtype=kind)
    left = np.hstack([-2 * vectors, squares[:, None], one])
    right = np.hstack([vectors, one, squares[:, None]])
    several = len(group) and (group != group[0]).any()
    found = []
    order = np.argsort(letters.lengths, kind="stable")
    ranked = letters.lengths[order]
    for length in np.unique(ranked):
        own, longer = (
            order[np.searchsorted(ranked, k) : np.searchsorted(ranked, k + 1)]
            for k in (length, length + 1)
        )
        for other in (own, longer):
            for i in range(0, len(own), TILE):
                for j in range(i if other is own else 0, len(other), TILE):
                    rows, columns = own[i : i + TILE], other[j : j + TILE]
                    close = left[rows] @ right[columns].T <= 2
                    if several:
                        close &= group[rows][:, None] == group[columns]
                    if other is own and i == j:
                        close = np.triu(close, 1)
                    a, b = np.nonzero(close)
                    a, b = rows[a], columns[b]
                    across = (side[a] == 2) | (side[a] != side[b])
                    a, b = a[across], b[across]
                    true = _one_edit(letters, a, b, int(length), other is longer)
                    found.append((a[true], b[true]))
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    a, b = (np.concatenate(c) for c in zip(*found, strict=True))
    parts = part_keys(counts, part)
    agree = parts[a] == parts[b]
    first = np.full(len(a), -1)
    for k, chosen in reversed(list(enumerate(CHOICES))):
        first[agree[:, list(chosen)].all(axis=1)] = k
    once = first == choice[a]
    return a[once], b[once]


def _finder(part: np.ndarray):
    """Near pairs of every group; rows of a group come on end."""

    def block(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(rows)
        at = [whole[c].to_numpy() for c in ("choice", "key", "i", "j")]
        fresh = np.any([np.diff(c, prepend=c[0]) != 0 for c in at], axis=0)
        side = np.where(at[2] == at[3], 2, whole["side"].to_numpy())
        spelled = whole["word"].to_pylist()
        a, b = near(spelled, np.cumsum(fresh), side, at[0], part)
        n = whole["n"].to_numpy()
        return pa.RecordBatch.from_arrays(
            [
                pa.array([spelled[k] for k in a], pa.string()),
                pa.array([spelled[k] for k in b], pa.string()),
                pa.array(n[a], pa.int64()),
                pa.array(n[b], pa.int64()),
            ],
            names=["a", "b", "a_n", "b_n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            at = [batch[c].to_numpy() for c in ("choice", "key", "i", "j")]
            change = np.any([c[1:] != c[:-1] for c in at], axis=0)
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            begin = 0
            for cut in cuts[:-1]:
                now = tuple(c[cut] for c in at)
                # Groups end here: enough for a block?
                if now != last and size + cut - begin >= JOINT_WORDS:
                    if cut > begin:
                        held.append(batch.slice(begin, cut - begin))
                    yield block(held)
                    held, size, begin = [], 0, cut
                last = now
            held.append(batch.slice(begin))
            size += batch.num_rows - begin
        if size:
            yield block(held)

    return lean(run)


def near_pairs(vocabulary: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows (a, b, a_n, b_n), one for each pair of near words, from rows (word, n)."""
    small_batches(vocabulary.sparkSession)
    part = parts_of(vocabulary)
    routed = vocabulary.select("word", "n").mapInArrow(_router(part), ROUTED)
    large = routed.groupBy("choice", "key").count().filter(F.col("count") > BLOCK_WORDS)
    large = scratch.keep(
        large.select(
            F.col("choice").alias("in"),
            F.col("key").alias("of"),
            F.ceil(F.col("count") / BLOCK_WORDS).cast("int").alias("blocks"),
        ),
        "large",
    )
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("word"), blocks).cast("int")
    spread = (
        routed.join(large, (F.col("choice") == F.col("in")) & (F.col("key") == F.col("of")), "left")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    )
    # A block meets itself, and each other block once.
    meeting = spread.select(
        "choice",
        "key",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"),
        "word",
        "n",
    )
    dealt = meeting.repartition("choice", "key", "i", "j")
    return dealt.sortWithinPartitions("choice", "key", "i", "j").mapInArrow(_finder(part), PAIRS)


def _roots(forms: DataFrame, most: int, scratch: Scratch) -> DataFrame:
    """(word, root) for rows (word, form): the last form on the way.

    A form is FORM_TIMES as frequent as its word, so ways are short; each round
    doubles the steps taken.
    """
    roots, steps, turn = forms.withColumnRenamed("form", "root"), 1, 0
    while FORM_TIMES**steps <= most:
        beyond = roots.select(F.col("word").alias("at"), F.col("root").alias("beyond"))
        further = roots.join(beyond, F.col("root") == F.col("at"), "left")
        roots = scratch.keep(
            further.select("word", F.coalesce("beyond", "root").alias("root")), f"roots-{turn}"
        )
        steps, turn = 2 * steps, turn + 1
    return roots


def group(
    docs: DataFrame,
    scratch: Scratch,
    id: str = "doc_id",
    text: str = "text",
    deleting: int | None = None,
) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n), one a distinct word of docs.

    Words are runs of LETTERS (A-Z in lower case) of LEAST_LETTERS or more that
    occur LEAST_COUNT times or more; n is how often. Two words are near if one
    inserted, deleted or replaced letter makes one the other. A word's form is its
    near word of largest n, of several the least in code-point order, if that n is
    FORM_TIMES the word's or more, else null; root is the last form on the way
    from a word, the word itself if it has none. ``deleting`` k takes a letter out
    of runs, picked by a checksum of id and run, to make misspellings.

    A null text has no words, a null id counts as an empty one, repeated rows count
    as often as they come, an empty table gives no rows; other columns are ignored.
    """
    vocabulary = scratch.keep(words(docs, deleting, id, text), "words")
    pairs = near_pairs(vocabulary, scratch)

    def way(of: str, to: str, n: str) -> Column:
        return F.struct(F.col(of).alias("of"), F.col(n).alias("n"), F.col(to).alias("to"))

    both = pairs.select(
        F.explode(F.array(way("a", "b", "b_n"), way("b", "a", "a_n"))).alias("p")
    ).select("p.*")
    best = both.groupBy("of").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("n")).alias("less"), "to")).alias("best"),
    )
    best_n = -F.col("best.less")
    formed = best_n >= FORM_TIMES * F.col("n")
    judged = vocabulary.join(best, F.col("word") == F.col("of"), "left").select(
        "word",
        F.when(formed, F.col("best.to")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, best_n).alias("form_n"),
    )
    judged = scratch.keep(judged, "judged")
    most = vocabulary.agg(F.max("n")).first()[0] or 0
    roots = _roots(judged.filter("form IS NOT NULL").select("word", "form"), most, scratch)
    roots = roots.select(F.col("word").alias("of"), "root")
    return judged.join(roots, F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
