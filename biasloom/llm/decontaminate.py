"""Benchmark decontamination by a generalised suffix automaton of the test items.

The automaton holds every run of words of every item. A document's words are
streamed through it, which keeps the longest suffix read so far that occurs in
an item; where that match is as long as the window, its last words are hit and
the automaton's state tells the items that hold them. Items are taken in blocks
of bounded size, so one automaton fits in a task whatever the number of items;
with several blocks the documents are written between the passes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from biasloom.llm.common import Scratch, byte_texts, lean, small_batches, text_bytes

#: Bytes of item texts in one automaton.
BLOCK_BYTES = 4 << 20
WINDOW = 10
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: A-Z in lower case; a space for every other ASCII character outside words.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
NEVER = 1 << 60
SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
SPANS = T.ArrayType(
    T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
)
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("spans", SPANS),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class SuffixAutomaton:
    """All runs of words of a list of items, with the windows they mark."""

    def __init__(self, items: Sequence[tuple[str | None, bytes]], window: int):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        split = [(item, words_of(text)) for item, text in items]
        for _, words in split:
            last = 0
            for word in words:
                last = self._extend(last, word)
        marks: dict[int, dict[int, set]] = {}
        for item, words in split:
            need = min(window, len(words))
            state = 0
            for i, word in enumerate(words):
                state = self.next[state][word]
                while self.length[self.link[state]] >= need and state:
                    state = self.link[state]
                if i + 1 >= need:
                    marks.setdefault(state, {}).setdefault(need, set()).add(item)
        self._chain(marks)

    def _add(self, length: int, link: int, following: dict) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, word: bytes, target: int) -> int:
        """A copy of target for the runs that state reaches it by."""
        copy = self._add(
            self.length[state] + 1, self.link[target], dict(self.next[target])
        )
        while state != -1 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        self.link[target] = copy
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        there = self.next[last].get(word)
        if there is not None:
            if self.length[there] == self.length[last] + 1:
                return there
            return self._split(last, word, there)
        new, state = self._add(self.length[last] + 1, 0, {}), last
        while state != -1 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state != -1:
            there = self.next[state][word]
            if self.length[there] != self.length[state] + 1:
                there = self._split(state, word, there)
            self.link[new] = there
        return new

    def _chain(self, marks: dict[int, dict[int, set]]) -> None:
        """Give each state its own marks and those of the shorter runs it ends with."""
        self.marks: list[list[tuple[int, set]]] = [[] for _ in self.next]
        self.least = [NEVER] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            own = sorted(marks.get(state, {}).items(), reverse=True)
            self.marks[state] = own + self.marks[self.link[state]]
            if self.marks[state]:
                self.least[state] = self.marks[state][-1][0]

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set]:
        """Word spans [start, stop) that windows cover, and the items they are from."""
        following, link, length, least = self.next, self.link, self.length, self.least
        spans: list[list[int]] = []
        items: set = set()
        seen: set[tuple[int, int]] = set()
        state = matched = 0
        for i, word in enumerate(words):
            there = following[state].get(word)
            if there is None:
                while state and word not in following[state]:
                    state = link[state]
                there = following[state].get(word)
                if there is None:
                    matched = 0
                    continue
                matched = length[state]
            state = there
            matched += 1
            if matched >= least[state]:
                fits = [m for m in self.marks[state] if m[0] <= matched]
                start = i + 1 - fits[0][0]
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, i + 1])
                if (state, fits[0][0]) not in seen:
                    seen.add((state, fits[0][0]))
                    items.update(*(m[1] for m in fits))
        return spans, items


def merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and out[-1][1] >= start:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return out


def blocks_of(items: DataFrame, id: str, text: str) -> Iterator[list]:
    """The items in lists of bounded size, streamed to the driver one by one."""
    rows = items.select(
        F.col(id).cast("string").alias("id"), text_bytes(text).alias("text")
    )
    held, size = [], 0
    for row in rows.toLocalIterator():
        value = bytes(row.text or b"")
        if held and size + len(value) > BLOCK_BYTES:
            yield held
            held, size = [], 0
        held.append((row.id, value))
        size += len(value)
    yield held


def _pass(docs: DataFrame, text: str, block: list, window: int) -> DataFrame:
    """Add one block's findings; docs may carry those of earlier blocks."""
    small_batches(docs.sparkSession)
    items = docs.sparkSession.sparkContext.broadcast(block)
    others = [c for c in docs.columns if c not in FOUND.names]
    earlier = FOUND.names[0] in docs.columns
    source = docs.withColumn("dc__text", text_bytes(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = SuffixAutomaton(items.value, window)
        for batch in batches:
            found = {name: [] for name in FOUND.names}
            spans_so_far = batch["spans"].to_pylist() if earlier else None
            items_so_far = batch["items"].to_pylist() if earlier else None
            for row, value in enumerate(byte_texts(batch["dc__text"])):
                words = words_of(value)
                spans, hits = automaton.scan(words)
                hits.discard(None)
                if earlier:
                    spans += [[s["start"], s["stop"]] for s in spans_so_far[row]]
                    spans, hits = merged(spans), hits | set(items_so_far[row])
                found["n_words"].append(len(words))
                found["n_hit"].append(sum(b - a for a, b in spans))
                found["spans"].append([{"start": a, "stop": b} for a, b in spans])
                found["items"].append(sorted(hits))
            columns = [batch[c] for c in others]
            columns += [
                pa.array(found["n_words"], pa.int64()),
                pa.array(found["n_hit"], pa.int64()),
                pa.array(found["spans"], pa.list_(SPAN)),
                pa.array(found["items"], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, *FOUND.names])

    schema = T.StructType([docs.schema[c] for c in others] + FOUND.fields)
    return source.mapInArrow(lean(run), schema)


def find(
    docs: DataFrame,
    items: DataFrame,
    scratch: Scratch,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """docs with n_words, n_hit, spans (of words, merged) and items (ids as strings).

    A null or wordless text has no words and no hits. Columns of docs with one
    of the four names are replaced. Items that repeat an id count as one; an
    item without an id marks words and is not listed; one without words marks
    nothing. An item shorter than the window counts where it occurs whole.
    Repeated rows come back as often as they came; an empty table of items
    finds nothing.
    """
    docs = docs.drop(*FOUND.names)
    for turn, block in enumerate(blocks_of(items, item_id, item_text)):
        if turn:
            docs = scratch.keep(docs, f"block-{turn}")
        docs = _pass(docs, text, block, window)
    return docs


def without(text: bytes, spans: list) -> bytes:
    """The text without the word spans and the separators within them."""
    places = [m.span() for m in WORD.finditer(text)]
    kept, at = [], 0
    for span in spans:
        start, stop = places[span["start"]][0], places[span["stop"] - 1][1]
        kept.append(text[at:start])
        at = stop
    return b"".join([*kept, text[at:]])


def remove(
    found: DataFrame,
    text: str = "text",
    least_words: int = 1,
    most_coverage: float = 0.5,
) -> DataFrame:
    """Cut the hit spans out of the texts of find()'s result.

    A document more than ``most_coverage`` of whose words are hit goes; in the
    others every span of at least ``least_words`` words is cut out; any span holds
    a whole window, or an item that is shorter than one. A document left without a
    word goes too; one that had none before stays. The columns are those of found.
    """
    small_batches(found.sparkSession)
    columns = found.columns
    few = found.filter(F.col("n_hit") <= F.lit(most_coverage) * F.col("n_words"))
    cut = F.filter("spans", lambda s: s["stop"] - s["start"] >= least_words)
    few = few.withColumn("dc__cut", cut).withColumn("dc__text", text_bytes(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch["dc__cut"].to_pylist()
            if any(spans):
                texts = batch[text].to_pylist()
                for i, value in enumerate(byte_texts(batch["dc__text"])):
                    if spans[i]:
                        texts[i] = without(value, spans[i]).decode()
                at = batch.schema.get_field_index(text)
                batch = batch.set_column(at, text, pa.array(texts, pa.string()))
            yield batch.select(columns)

    return few.mapInArrow(lean(run), found.schema)
