"""Exact passages that repeat across documents, by sorted suffixes.

Every 50-byte window of a document has an anchor: the place in it whose 16-byte
gram has the least hash. Equal windows have the same anchor, so only suffixes
that start at an anchor need sorting, about one in eighteen. An anchored suffix
is carried with the bytes before and behind it that its windows reach.
Splitters sampled from the suffixes' leading bytes range-partition them into
buckets; a bucket sorts its suffixes by multikey quicksort, eight bytes a key.
Where neighbours agree in the whole gram, windows are compared across them, and
each is known by the least document that holds it. Suffixes with one leading
gram all meet in one bucket, so no match is lost between two buckets; a batch of
documents sends each distinct one once, with the least document. Leading bytes
that the sample shows to be very frequent are split: their suffixes are taken
apart into windows, which are dealt by their whole content.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biasloom.llm.common import Scratch, byte_texts, lean, small_batches, text_bytes

#: Length of a repeated passage, and of the gram that an anchor starts.
WINDOW = 50
GRAM = 16
#: Bytes before the anchor and from it on that its windows may reach.
BEFORE, BEHIND = WINDOW - GRAM, WINDOW
#: Row of a suffix: from the anchor on, then what is before it, nearest first,
#: both filled up with zeros, and the two lengths.
KEY_WORDS = 12
RIGHT, LEFT = 56, 40
ROW = RIGHT + LEFT
#: Words of eight bytes that hold a window and the place of its anchor.
WINDOW_WORDS = WINDOW // 8 + 1
#: Documents are read in portions of about so many bytes; a longer one is read
#: in pieces, whose windows overlap in no place and leave none out.
PORTION = 2 << 20
#: Documents sampled for each bucket of the range partitioning, and the most
#: suffixes that a portion of them names.
SAMPLES, NAMED = 4, 2000
#: Bytes of documents for each bucket, at most.
BUCKET_BYTES = 32 << 20
#: Suffix rows whose windows are compared at a time.
COMPARED = 20_000
#: Leading bytes are split if the sample has them so many times, and so many times
#: as often as a bucket holds on average. That only sets how rows are dealt.
HOT_TIMES, HOT_SAMPLES = 4, 64
#: Buckets of windows are numbered from here on.
WINDOWS_FROM = 1 << 24
#: The buckets are sorted in so many turns, each over a part of their ranges. A
#: turn reads the documents anew and leaves no shuffle files behind, so the
#: turns set how much disk the sort takes at once.
TURNS = 2
MIX = np.uint64(0x9E3779B97F4A7C15)
#: The first bucket of a turn and the one behind its last; None stands for all.
Turn = tuple[int, int] | None


def grams(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one big-endian number; zeros behind the end."""
    n = -(-len(data) // 8)
    padded = np.zeros(8 * n + 8, dtype=np.uint8)
    padded[: len(data)] = data
    out = np.empty((n, 8), dtype=np.uint64)
    for k in range(8):
        out[:, k] = np.frombuffer(padded, dtype=">u8", count=n, offset=k)
    return out.reshape(-1)[: len(data)]


def anchors(
    data: np.ndarray, sizes: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: (document, first window, last window, anchor).

    data is documents on end, of these sizes. Windows lie within one document.
    The anchor is the leftmost place of the least gram hash.
    """
    starts = [
        np.arange(end - size, end - WINDOW + 1)
        for size, end in zip(sizes.tolist(), np.cumsum(sizes).tolist(), strict=True)
        if size >= WINDOW
    ]
    if not starts:
        return (np.zeros(0, dtype=np.int64),) * 4
    starts = np.concatenate(starts)
    with np.errstate(over="ignore"):
        mixed = grams(data)
        second = np.zeros_like(mixed)
        second[:-8] = mixed[8:]
        second *= np.uint64(0xC2B2AE3D27D4EB4F)
        low = mixed >> np.uint64(29)
        mixed *= MIX
        mixed ^= low
        mixed ^= second
        mixed *= MIX
    # The hash above, the place below: equal hashes leave the leftmost place.
    np.bitwise_and(mixed, np.uint64(0xFFFFFFFF00000000), out=low)
    low |= np.arange(len(data), dtype=np.uint64)
    width, reach = WINDOW - GRAM + 1, 1
    while reach * 2 <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if width > reach:
        low = np.minimum(low[: reach - width], low[width - reach :])
    at = (low[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    begin = np.nonzero(new)[0]
    last = starts[np.append(begin[1:] - 1, len(starts) - 1)]
    first = starts[begin]
    doc = np.searchsorted(np.cumsum(sizes), first, side="right")
    return doc, first, last, at[begin]


def suffix_rows(
    data: np.ndarray, first: np.ndarray, last: np.ndarray, at: np.ndarray
) -> np.ndarray:
    """The row of each suffix: ROW bytes and the two lengths."""
    right = last + WINDOW - at
    left = at - first
    padded = np.concatenate(
        [np.zeros(LEFT, dtype=np.uint8), data, np.zeros(RIGHT, dtype=np.uint8)]
    )
    rows = np.zeros((len(at), ROW + 2), dtype=np.uint8)
    wide = np.lib.stride_tricks.sliding_window_view(padded, RIGHT)
    rows[:, :RIGHT] = wide[at + LEFT]
    rows[:, :RIGHT][np.arange(RIGHT) >= right[:, None]] = 0
    wide = np.lib.stride_tricks.sliding_window_view(padded, LEFT)
    rows[:, RIGHT:ROW] = wide[at, ::-1]
    rows[:, RIGHT:ROW][np.arange(LEFT) >= left[:, None]] = 0
    rows[:, ROW], rows[:, ROW + 1] = right, left
    return rows


def multikey_sort(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows, and a mark where a row differs from the one before.

    Multikey quicksort with keys of eight bytes: rows that agree in a key form a
    group, and only groups of two or more go on to the next key. The lengths
    are the last key.
    """
    n = len(rows)
    order = np.arange(n)
    new = np.zeros(n, dtype=bool)
    if n:
        new[0] = True
    wide = np.zeros((n, KEY_WORDS * 8 + 8), dtype=np.uint8)
    wide[:, : ROW + 2] = rows
    keys = wide.view(">u8")
    open_ = np.arange(n)
    for k in range(keys.shape[1]):
        group = np.cumsum(new)[open_]
        key = keys[order[open_], k].astype(np.uint64)
        by = np.lexsort((key, group))
        order[open_] = order[open_][by]
        key, group = key[by], group[by]
        differs = np.ones(len(open_), dtype=bool)
        differs[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        new[open_] |= differs
        alone = new.copy()
        alone[:-1] &= new[1:]
        open_ = np.nonzero(~alone)[0]
        if not len(open_):
            break
    return order, new


def _spans(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching spans as one, in order."""
    if not len(starts):
        return starts, stops
    by = np.argsort(starts, kind="stable")
    starts, stops = starts[by], np.maximum.accumulate(stops[by])
    new = np.ones(len(starts), dtype=bool)
    new[1:] = starts[1:] > stops[:-1]
    return starts[new], stops[np.append(np.nonzero(new)[0][1:] - 1, len(stops) - 1)]


def leading_bytes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes from these places on as big-endian numbers; grams reach further."""
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | data[at + k]
    return out


@dataclass(frozen=True)
class Deal:
    """How suffixes are dealt: the splitters, and leading bytes to be split."""

    cuts: np.ndarray
    hot: np.ndarray


class Portion:
    """Some documents' anchored suffixes, reduced to the distinct ones."""

    def __init__(
        self, pieces: list[tuple[int, int, int, bytes]], deal: Deal | None, turn: Turn
    ):
        """pieces: (document, mark, place of the piece in the document, bytes).

        Only suffixes in the buckets of this turn are looked at.
        """
        pieces = sorted(pieces, key=lambda p: p[0])
        self.docs = np.array([p[0] for p in pieces], dtype=np.int64)
        self.marks = np.array([p[1] for p in pieces], dtype=np.int64)
        data = np.frombuffer(b"".join(p[3] for p in pieces), dtype=np.uint8)
        sizes = np.array([len(p[3]) for p in pieces], dtype=np.int64)
        piece, first, last, at = anchors(data, sizes)
        if turn:
            bucket = np.searchsorted(deal.cuts, leading_bytes(data, at), side="right")
            now = (bucket >= turn[0]) & (bucket < turn[1])
            piece, first, last, at = piece[now], first[now], last[now], at[now]
        rows = suffix_rows(data, first, last, at)
        begin = np.cumsum(sizes) - sizes - np.array([p[2] for p in pieces], dtype=np.int64)
        home = begin[piece]
        order, new = multikey_sort(rows)
        group = np.cumsum(new) - 1
        # The sort is stable, so a group's first row is of its least document.
        doc = self.docs[piece[order]]
        later = doc > doc[new][group]
        #: Repeats within the portion are settled: whole runs of windows go.
        gone, stay = order[later], order[~later]
        self.settled = (piece[gone], first[gone] - home[gone], last[gone] + WINDOW - home[gone])
        #: What is left goes to the buckets: distinct rows and their places.
        self.rows = rows[order[new]]
        self.places = np.stack([group[~later], piece[stay], first[stay] - home[stay]], axis=1)

    def leading(self) -> np.ndarray:
        """The first eight bytes of each distinct suffix."""
        return np.ascontiguousarray(self.rows[:, :8]).view(">u8").reshape(-1).astype(np.uint64)

    def split_off(self, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Take the rows with these leading bytes out; returns them and their places."""
        out = np.isin(self.leading(), hot)
        taken, stay = out[self.places[:, 0]], ~out
        rows, places = self.rows[out], self.places[taken].copy()
        places[:, 0] = (np.cumsum(out) - 1)[places[:, 0]]
        self.rows, self.places = self.rows[stay], self.places[~taken]
        self.places[:, 0] = (np.cumsum(stay) - 1)[self.places[:, 0]]
        return rows, places


def _portions(
    batches: Iterator[pa.RecordBatch], deal: Deal | None = None, turn: Turn = None
) -> Iterator[Portion]:
    held, size = [], 0
    for batch in batches:
        for doc, mark, text in zip(
            batch["doc"].to_pylist(), batch["mark"].to_pylist(), byte_texts(batch["data"]),
            strict=True,
        ):
            for at in range(0, len(text), PORTION):
                piece = text[at : at + PORTION + WINDOW - 1]
                held.append((doc, mark, at, piece))
                size += len(piece)
                if size >= PORTION:
                    yield Portion(held, deal, turn)
                    held, size = [], 0
    if held:
        yield Portion(held, deal, turn)


def splitters(source: DataFrame, total: int, buckets: int) -> Deal:
    """Leading bytes that part the suffixes into buckets of about equal size.

    They come from the suffixes of a sample of the total documents, by hash; the
    sample sets the sizes of buckets only, never what is found.
    """
    rate = min(1.0, SAMPLES * buckets / max(1, total))
    draw = F.pmod("mark", F.lit(1 << 20)) < int(rate * (1 << 20)) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion in _portions(batches):
            lead = np.sort(portion.leading())
            lead = lead[:: max(1, len(lead) // NAMED)]
            yield pa.RecordBatch.from_arrays([pa.array(lead.view(np.int64))], names=["lead"])

    rows = source.filter(draw).mapInArrow(lean(run), "lead long").collect()
    lead = np.sort(np.array([r.lead for r in rows], dtype=np.int64).view(np.uint64))
    values, counts = np.unique(lead, return_counts=True)
    hot = values[counts >= max(HOT_SAMPLES, HOT_TIMES * len(lead) / buckets)]
    if not len(lead):
        return Deal(lead, hot)
    return Deal(np.unique(lead[np.arange(1, buckets) * len(lead) // buckets]), hot)


def _sent(source: DataFrame, deal: Deal, turn: Turn) -> DataFrame:
    """Rows for the buckets of this turn, and settled spans in bucket -1."""
    shared = source.sparkSession.sparkContext.broadcast(deal)
    names = ["bucket", "rows", "n", "places", "docs", "marks"]
    kinds = [pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        cuts, hot = shared.value.cuts, shared.value.hot

        def settled(portion: Portion, doc, start, stop) -> tuple:
            found = np.stack([portion.docs[doc], portion.marks[doc], start, stop], axis=1)
            return (-1, b"", len(found), pack(found.astype("<i8").tobytes()), b"", b"")

        def dealt(portion: Portion, bucket: np.ndarray, rows: np.ndarray, places: np.ndarray):
            """Rows are in order of their buckets, places in order of their rows."""
            of = places[:, 0]
            for k in np.unique(bucket).tolist():
                a, b = np.searchsorted(bucket, [k, k + 1])
                i, j = np.searchsorted(of, [a, b])
                own = places[i:j].copy()
                own[:, 0] -= a
                used, own[:, 1] = np.unique(own[:, 1], return_inverse=True)
                yield (
                    k,
                    pack(rows[a:b].tobytes()),
                    int(b - a),
                    pack(own.astype("<i4").T.tobytes()),
                    pack(np.diff(portion.docs[used], prepend=0).astype("<i8").tobytes()),
                    portion.marks[used].astype("<i8").tobytes(),
                )

        for portion in _portions(batches, shared.value, turn):
            out = [settled(portion, *portion.settled)]
            hot_rows, hot_places = portion.split_off(hot)
            bucket = np.searchsorted(cuts, portion.leading(), side="right")
            out += dealt(portion, bucket, portion.rows, portion.places)
            for at in range(0, len(hot_rows), COMPARED):
                i, j = np.searchsorted(hot_places[:, 0], [at, at + COMPARED])
                places = hot_places[i:j].copy()
                places[:, 0] -= at
                bodies, places, gone = apart(portion.docs, hot_rows[at : at + COMPARED], places)
                out.append(settled(portion, *gone))
                bucket = WINDOWS_FROM + spread(bodies, turn[1] - turn[0])
                by = np.argsort(bucket, kind="stable")
                place_of = np.empty(len(by), dtype=np.int64)
                place_of[by] = np.arange(len(by))
                places[:, 0] = place_of[places[:, 0]]
                places = places[np.argsort(places[:, 0], kind="stable")]
                out += dealt(portion, bucket[by], bodies[by], places)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                names=names,
            )

    schema = "bucket int, rows binary, n long, places binary, docs binary, marks binary"
    return source.mapInArrow(lean(run), schema)


def _windows(rows: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, ...]:
    """All windows of suffix rows: (row, place from the first window on, number, bytes).

    Equal windows of one group of rows (an anchor's gram) get one number. The
    bytes are the window's, and the place of the anchor in it.
    """
    right, left = rows[:, ROW].astype(np.int64), rows[:, ROW + 1].astype(np.int64)
    count = left + right - WINDOW + 1
    row = np.repeat(np.arange(len(rows)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    before = left[row] - step
    line = np.concatenate([rows[:, RIGHT:ROW][:, ::-1], rows[:, :RIGHT]], axis=1)
    flat = np.ascontiguousarray(line).reshape(-1)
    start = row * ROW + LEFT - before
    bodies = np.lib.stride_tricks.sliding_window_view(
        np.concatenate([flat, np.zeros(WINDOW, dtype=np.uint8)]), WINDOW
    )[start]
    wide = np.zeros((len(row), 8 * WINDOW_WORDS), dtype=np.uint8)
    wide[:, :WINDOW] = bodies
    wide[:, WINDOW] = before
    number, _ = numbered(wide, groups[row])
    return row, step, number, wide[:, : WINDOW + 1]


def numbered(wide: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each distinct row of a group, and a place of each number."""
    keys = wide.view(">u8")
    by = np.lexsort((*(keys[:, k].astype(np.uint64) for k in range(WINDOW_WORDS)), groups))
    new = np.ones(len(by), dtype=bool)
    new[1:] = (keys[by][1:] != keys[by][:-1]).any(axis=1) | (groups[by][1:] != groups[by][:-1])
    number = np.empty(len(by), dtype=np.int64)
    number[by] = np.cumsum(new) - 1
    return number, by[new]


def apart(
    docs: np.ndarray, rows: np.ndarray, places: np.ndarray
) -> tuple[np.ndarray, np.ndarray, tuple]:
    """Suffix rows as windows: distinct ones, their places, and what is settled."""
    row, step, number, wide = _windows(rows, np.zeros(len(rows), dtype=np.int64))
    count = np.bincount(row, minlength=len(rows))
    begin = np.cumsum(count) - count
    size = count[places[:, 0]]
    each = np.repeat(np.arange(len(places)), size)
    at = begin[places[each, 0]] + np.arange(len(each)) - np.repeat(np.cumsum(size) - size, size)
    piece, start, window = places[each, 1], places[each, 2] + step[at], number[at]
    least = np.full(len(wide), np.iinfo(np.int64).max)
    np.minimum.at(least, window, docs[piece])
    later = docs[piece] > least[window]
    settled = (piece[later], start[later], start[later] + WINDOW)
    _, first = np.unique(number, return_index=True)
    own = np.stack([window[~later], piece[~later], start[~later]], axis=1)
    return wide[first], own, settled


def spread(bodies: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket for each window, by a hash of its content."""
    wide = np.zeros((len(bodies), 8 * WINDOW_WORDS), dtype=np.uint8)
    wide[:, : bodies.shape[1]] = bodies
    keys, mixed = wide.view(">u8"), np.zeros(len(bodies), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WINDOW_WORDS):
            mixed = (mixed ^ keys[:, k].astype(np.uint64)) * MIX
            mixed ^= mixed >> np.uint64(29)
    return (mixed % np.uint64(buckets)).astype(np.int64)


def _gathered(portions: list[tuple], width: int) -> tuple[np.ndarray, ...]:
    """The rows that portions sent to a bucket, and their places: (row, doc, mark, start)."""
    unpack = zstandard.ZstdDecompressor().decompress
    rows, of, docs, marks, starts = [], [], [], [], []
    base = 0
    for data, n, places, doc, mark in portions:
        rows.append(np.frombuffer(unpack(data), dtype=np.uint8).reshape(n, width))
        place = np.frombuffer(unpack(places), dtype="<i4").reshape(3, -1).astype(np.int64)
        of.append(place[0] + base)
        docs.append(np.cumsum(np.frombuffer(unpack(doc), dtype="<i8"))[place[1]])
        marks.append(np.frombuffer(mark, dtype="<i8")[place[1]])
        starts.append(place[2])
        base += n
    return tuple(map(np.concatenate, (rows, of, docs, marks, starts)))


def window_spans(portions: list[tuple]) -> np.ndarray:
    """Spans of the windows of a bucket that a smaller document also holds."""
    rows, of, docs, marks, starts = _gathered(portions, WINDOW + 1)
    wide = np.zeros((len(rows), 8 * WINDOW_WORDS), dtype=np.uint8)
    wide[:, : WINDOW + 1] = rows
    number, _ = numbered(wide, np.zeros(len(rows), dtype=np.int64))
    least = np.full(len(rows), np.iinfo(np.int64).max)
    np.minimum.at(least, number[of], docs)
    later = docs > least[number[of]]
    return np.stack([docs, marks, starts, starts + WINDOW], axis=1)[later]


def bucket_spans(portions: list[tuple]) -> np.ndarray:
    """Spans (document, mark, start, stop) that a smaller document also holds."""
    rows, of, docs, marks, starts = _gathered(portions, ROW + 2)
    order, new = multikey_sort(rows)
    number = np.empty(len(rows), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    rows = rows[order[new]]
    of = number[of]
    least = np.full(len(rows), np.iinfo(np.int64).max)
    np.minimum.at(least, of, docs)
    size = rows[:, ROW].astype(np.int64) + rows[:, ROW + 1] - WINDOW + 1
    found = []
    whole = docs > least[of]
    found.append(
        np.stack(
            [docs[whole], marks[whole], starts[whole], starts[whole] + size[of[whole]] + WINDOW - 1],
            axis=1,
        )
    )
    # Rows that differ but start with the same gram: their windows may agree.
    gram = np.ones(len(rows), dtype=bool)
    gram[1:] = (rows[1:, :GRAM] != rows[:-1, :GRAM]).any(axis=1)
    groups = np.cumsum(gram) - 1
    shared = np.bincount(groups, minlength=len(rows))[groups] > 1
    chosen = np.nonzero(shared)[0]
    # Portions of whole groups, so that memory is bounded by the largest group.
    cuts = np.append(np.nonzero(np.diff(groups[chosen], prepend=-1))[0], len(chosen))
    at = 0
    while at < len(cuts) - 1:
        stop = at + 1
        while stop < len(cuts) - 1 and cuts[stop + 1] - cuts[at] <= COMPARED:
            stop += 1
        part = chosen[cuts[at] : cuts[stop]]
        at = stop
        row, step, window, _ = _windows(rows[part], groups[part])
        first = np.full(window.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, window, least[part][row])
        earlier = first[window] < least[part][row]
        if not earlier.any():
            continue
        hit_row, hit_step = part[row[earlier]], step[earlier]
        by = np.lexsort((hit_step, hit_row))
        hit_row, hit_step = hit_row[by], hit_step[by]
        fresh = np.ones(len(by), dtype=bool)
        fresh[1:] = (hit_row[1:] != hit_row[:-1]) | (hit_step[1:] != hit_step[:-1] + 1)
        begin = np.nonzero(fresh)[0]
        end = np.append(begin[1:] - 1, len(by) - 1)
        spans = pd.DataFrame(
            {"of": hit_row[begin], "a": hit_step[begin], "b": hit_step[end] + WINDOW}
        )
        left = ~whole & np.isin(of, part)
        places = pd.DataFrame(
            {"of": of[left], "doc": docs[left], "mark": marks[left], "start": starts[left]}
        )
        both = places.merge(spans, on="of")
        found.append(
            np.stack(
                [both["doc"], both["mark"], both["start"] + both["a"], both["start"] + both["b"]],
                axis=1,
            ).astype(np.int64)
        )
    return np.concatenate(found)


def repeated_spans(source: DataFrame, deal: Deal, turn: tuple[int, int]) -> DataFrame:
    """Rows (doc, mark, spans): places of the repeated passages, found in one turn.

    source has ``doc`` (no nulls), ``mark`` and ``data``. ``spans`` are pairs
    of numbers, little-endian, one such array for each bucket or portion.
    """
    sent, buckets = _sent(source, deal, turn), turn[1] - turn[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        held: list[tuple] = []
        now = None

        def spans_of(bucket: int, held: list[tuple]) -> np.ndarray:
            return window_spans(held) if bucket >= WINDOWS_FROM else bucket_spans(held)

        def told(found: np.ndarray) -> pa.RecordBatch:
            by = np.lexsort((found[:, 2], found[:, 1], found[:, 0]))
            found = found[by]
            new = np.ones(len(found), dtype=bool)
            new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
            at = np.nonzero(new)[0]
            spans = [s.astype("<i4").tobytes() for s in np.split(found[:, 2:], at[1:])]
            return pa.RecordBatch.from_arrays(
                [pa.array(found[at, 0]), pa.array(found[at, 1]), pa.array(spans, pa.binary())],
                names=["doc", "mark", "spans"],
            )

        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] < 0:
                    found = np.frombuffer(unpack(row["places"]), dtype="<i8").reshape(-1, 4)
                    if len(found):
                        yield told(found)
                    continue
                if row["bucket"] != now:
                    if held and len(found := spans_of(now, held)):
                        yield told(found)
                    held, now = [], row["bucket"]
                held.append(tuple(row[c] for c in ("rows", "n", "places", "docs", "marks")))
        if held and len(found := spans_of(now, held)):
            yield told(found)

    # Settled spans are dealt by their document, buckets as they are.
    key = F.when(F.col("bucket") < 0, -1 - F.pmod(F.xxhash64("places"), F.lit(buckets)).cast("int"))
    dealt = sent.withColumn("key", F.coalesce(key, F.col("bucket")))
    gathered = dealt.repartition(buckets, "key").sortWithinPartitions("bucket").drop("key")
    return gathered.mapInArrow(lean(run), "doc long, mark long, spans binary")


def deduplicate(
    docs: DataFrame,
    scratch: Scratch,
    id: str = "doc_id",
    text: str = "text",
    buckets: int | None = None,
) -> DataFrame:
    """Rows (id, kept, n_bytes, n_removed, spans), one for each row of docs.

    Removed is each byte covered by a WINDOW-byte string that also starts in a
    document with a smaller id. ``kept`` is what is left, as bytes; ``spans``
    are the removed runs (start, stop) of the UTF-8 text. A null text is empty.
    A row without an id is compared with none and keeps all. Rows of the same
    id are not compared with one another; rows alike in id and text come back
    as often as they came, an empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    n_docs, n_bytes = docs.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.col(text).cast("string"))), F.lit(0))
    ).first()
    if buckets is None:
        # A bucket is held by one task, so their number follows the bytes.
        buckets = max(
            4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // BUCKET_BYTES)
        )
    rows = docs.select(
        F.col(id).alias("doc"),
        F.xxhash64(F.col(text).cast("string")).alias("mark"),
        F.coalesce(text_bytes(text), F.lit(b"")).alias("data"),
    )
    source = rows.filter(F.col("doc").isNotNull()).withColumn("doc", F.col("doc").cast("long"))
    long = source.filter(F.octet_length("data") >= WINDOW)
    deal = splitters(long, n_docs, buckets)
    spans, parts = None, len(deal.cuts) + 1
    for k in range(TURNS):
        turn = (parts * k // TURNS, parts * (k + 1) // TURNS)
        if turn[0] == turn[1]:
            continue
        found = scratch.keep(repeated_spans(long, deal, turn), f"spans-{k}")
        spans = found if spans is None else spans.unionByName(found)
        scratch.settle()
    gathered = spans.groupBy(F.col("doc").alias("of"), F.col("mark").alias("by")).agg(
        F.collect_list("spans").alias("parts")
    )
    joined = rows.join(gathered, (F.col("doc") == F.col("of")) & (F.col("mark") == F.col("by")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, removed, spans = [], [], [], []
            for data, parts in zip(batch["data"].to_pylist(), batch["parts"].to_pylist(), strict=True):
                found = np.frombuffer(b"".join(parts or ()), dtype="<i4").reshape(-1, 2)
                starts, stops = _spans(found[:, 0].astype(np.int64), found[:, 1].astype(np.int64))
                pieces, at = [], 0
                for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
                    pieces.append(data[at:a])
                    at = b
                pieces.append(data[at:])
                kept.append(b"".join(pieces))
                sizes.append(len(data))
                removed.append(int((stops - starts).sum()))
                spans.append([{"start": a, "stop": b} for a, b in zip(starts, stops, strict=True)])
            span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc"], pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()),
                    pa.array(removed, pa.int64()), pa.array(spans, pa.list_(span)),
                ],
                names=["doc", "kept", "n_bytes", "n_removed", "spans"],
            )

    kind = docs.schema[id].dataType.simpleString()
    out = joined.select("doc", "data", "parts").mapInArrow(lean(run),
        f"doc {kind}, kept binary, n_bytes long, n_removed long, "
        "spans array<struct<start: long, stop: long>>",
    )
    return out.withColumnRenamed("doc", id)

