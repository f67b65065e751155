"""Token ids in files of static-range asymmetric-numeral-system blocks.

Documents are put in order of their id and tokenised; the ids of each partition
are cut into blocks of bounded length. One frequency table, counted over all
ids, is shared by all blocks, and each block is coded on its own by interleaved
rANS lanes: symbol i belongs to lane i modulo the number of lanes, and all
lanes take a step at once. A block row holds its documents, a checksum of the
decoded ids and checkpoints (lane states and stream places), from which parts
of a block can be decoded side by side. Files are written and read by Spark, so
any file system it knows will do. A folder holds all that decoding takes: the
blocks, the frequency table, and the format (tokenizer, end id, scale, lanes and
steps).
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, repeat
from operator import is_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biasloom.llm.common import Scratch, lean, output_folder, small_batches

#: Ids of one block, lanes of a block, steps between two checkpoints.
BLOCK_IDS = 1 << 20
LANES = 2048
STEPS = 256
#: Frequencies sum to 2 ** SCALE; a lane's state stays in [LOW, LOW << 32).
SCALE = 20
LOW = 1 << 31
END_ID = 2
#: Columns of a block row. ``first`` is the place of its first id in the
#: partition, ``origin`` that of the document its first piece belongs to, and
#: ``open`` says that its last document goes on in the next block.
BLOCKS = (
    "part int, block int, first long, origin long, ids long, open boolean, "
    "docs array<long>, pieces array<long>, {}"
)
WRITTEN = BLOCKS.format("code binary, marks binary, crc32 long")
#: A partition's last row says how often each id occurs in the partition.
CHUNKS = BLOCKS.format("used array<int>, times array<long>, data binary")
#: The other tables of a folder of files.
FREQUENCIES = "id long, freq long"
FORMAT = "tokenizer string, end_id long, ids long, scale int, lanes int, steps int"
#: Bytes of a batch of texts. Tokenising takes many times that beside the words remembered.
TEXT_BYTES = 1 << 20
#: Words that a worker remembers at most, besides those of one batch.
CACHE_WORDS = 500_000
#: New runs of letters that the library's model takes in one piece.
RUN_WORDS = 100
#: What may stand behind a word's letters and is encoded apart from them.
PUNCTUATION = ".,;:!?#*$%&|<>()[]{}\"'/+=_~^@-"
DTYPE = "<u4"
PIECES = (
    "part int, first long, origin long, doc long, n long, crc long, whole boolean"
)
COLUMNS = ("part", "block", "first", "origin", "ids", "open", "docs", "pieces")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte.

    Printable bytes stand for themselves, the others for the letters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


@lru_cache(maxsize=1)
def _loaded(path: str, changed: int) -> tuple:
    """The tokenizer of a file, and which ids begin a run (see _begins); a worker keeps them."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return tokenizer, _begins(tokenizer)


def _begins(tokenizer) -> np.ndarray | None:
    """Which ids begin with a space or line break; None if runs of letters can't be joined."""
    special = ("continuing_subword_prefix", "end_of_word_suffix", "dropout", "ignore_merges")
    model = tokenizer.model
    if type(model).__name__ != "BPE" or any(getattr(model, s) for s in special):
        return None
    vocabulary, letters = tokenizer.get_vocab(with_added_tokens=False), _byte_letters()
    if not vocabulary.keys() >= set(letters.values()):
        return None
    values = {letter: b for b, letter in letters.items()}
    space, end = letters[32], letters[10]

    def is_run(piece: str) -> bool:
        # A piece may begin or end within a character; whole ones tell.
        seen = bytes(values.get(c, 0) for c in piece).decode(errors="ignore")
        return not seen or seen.isalpha()

    begins = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
    for token, id in vocabulary.items():
        if space not in token and end not in token:
            continue
        pieces = token.replace(end, space).split(space)
        begins[id] = start = not pieces[0]
        # Between two runs there is one space or line break.
        if len(pieces) > 1 + start and all(pieces[1:-1]) and all(map(is_run, pieces)):
            return None
    return begins


def _laid(flat: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parts of flat that order names, on end, and where each of them ends."""
    starts = np.cumsum(sizes) - sizes
    size = sizes[order]
    stops = np.cumsum(size)
    total = int(stops[-1]) if len(stops) else 0
    shift = (starts[order] - (stops - size)).astype(np.int32)
    return flat[np.repeat(shift, size) + np.arange(total, dtype=np.int32)], stops


class WordTokenizer:
    """A byte-level BPE tokenizer that encodes each distinct word once.

    Its pre-tokenizer always cuts before a space that a visible character
    follows, around a line break between visible characters, and behind a run of
    letters. So a text of single spaces and line breaks is the sequence of its
    words' ids, and a word that of its letters' and its punctuation's. Texts
    with other white space between words, or with the string of a special token,
    are encoded whole. Where no token of the vocabulary reaches from one run of
    letters into the next, no merge does, so the library's model takes many new
    runs in one piece, and each id that begins with white space begins a run.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if not os.path.isabs(path):
            import public_tokenizers

            path = public_tokenizers.path(path)
        self.tokenizer, self.begins = _loaded(path, os.stat(path).st_mtime_ns)
        # What the library takes out of a text before it cuts it.
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.space = self.letters[32]
        self.line_break = self._bytes(["\n"])[0]
        self.points = np.array([ord(self.letters[b]) for b in range(256)], dtype="<u2")
        # The model alone: nothing is cut, and there are no special tokens.
        self.bare = Tokenizer(self.model)
        self.known: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def _bytes(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _run(self, word: str) -> bytes:
        head, start = b"", self.space
        if word[0] == "\n":
            word, head, start = word[1:], self.line_break, ""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return head + array("I", [t.id for t in self.model.tokenize(start + word)]).tobytes()

    def _runs(self, words: list[str]) -> list[bytes]:
        """The ids of runs of letters behind a space, or the line break they begin with."""
        if self.begins is None:
            return [self._run(word) for word in words]
        ids = array("I")
        for i in range(0, len(words), RUN_WORDS):
            text = (" " + " ".join(words[i : i + RUN_WORDS])).replace(" \n", "\n").encode()
            text = self.points[np.frombuffer(text, dtype=np.uint8)].tobytes().decode("utf-16-le")
            ids.extend(self.bare.encode_batch_fast([text], add_special_tokens=False)[0].ids)
        data = ids.tobytes()
        at = 4 * np.flatnonzero(self.begins[np.frombuffer(data, dtype=DTYPE)])
        ends = np.append(at[1:], len(data))
        return [data[a:b] for a, b in zip(at.tolist(), ends[: len(at)].tolist(), strict=True)]

    def _words(self, words: list[str], letters: list[bool]) -> list[bytes | None]:
        """The ids of words behind a space; None for what has to be seen in its text.

        A word that begins with a line break has that instead of the space.
        ``letters`` says which words are runs of letters (behind a line break or
        not); those the model takes as they are.
        """
        out = list(map(self.known.get, words))
        if len(self.known) > CACHE_WORDS:
            # Common words are in this batch too.
            found = zip(words, out, strict=True)
            self.known = {word: ids for word, ids in found if ids is not None}
        missing = [i for i, found in enumerate(out) if found is None]
        runs = [i for i in missing if letters[i]]
        others = [i for i in missing if not letters[i]]
        others = [i for i in others if words[i] and not words[i][0].isspace()]
        found = self._runs([words[i] for i in runs])
        if others:
            found += self._bytes([" " + words[i] for i in others])
        for i, ids in zip(runs + others, found, strict=True):
            self.known[words[i]] = out[i] = ids
        return out

    def _tails(self, tails: list[str]) -> list[bytes]:
        """The ids of punctuation that follows a run of letters."""
        new = [t for t in tails if t not in self.tails]
        if len(self.tails) + len(new) > 1000:
            self.tails.clear()
            new = tails
        self.tails.update(zip(new, self._bytes(new), strict=True))
        return [self.tails[t] for t in tails]

    @staticmethod
    def _letters(words: pa.Array) -> np.ndarray:
        bare = pc.utf8_ltrim(words, characters="\n")
        return pc.utf8_is_alpha(bare).to_numpy(zero_copy_only=False).astype(bool)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts on end, and the number of ids of each text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        # A line break between visible characters starts a word, as a space does.
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        at = split.offsets.to_numpy()
        at = at - at[0]
        coded = split.flatten().dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False)
        words = coded.dictionary
        # Punctuation is a piece of its own where letters stand before it. Only
        # there; what begins otherwise is a word with its punctuation.
        cores = pc.utf8_rtrim(words, characters=PUNCTUATION)
        apart = self._letters(cores)
        cores = pc.if_else(pa.array(apart), cores, words)
        cut = pc.subtract(pc.binary_length(words), pc.binary_length(cores)).to_numpy()
        names = cores.dictionary_encode()
        found = self._words(
            names.dictionary.to_numpy(zero_copy_only=False).tolist(),
            self._letters(names.dictionary).tolist(),
        )
        core_of = names.indices.to_numpy(zero_copy_only=False)
        odd = np.fromiter(map(is_, found, repeat(None)), dtype=bool, count=len(found))
        parts = [part or b"" for part in found]
        with_tail = np.nonzero(cut)[0]
        ends = words.take(pa.array(with_tail)).to_numpy(zero_copy_only=False).tolist()
        tails = [w[-n:] for w, n in zip(ends, cut[with_tail].tolist(), strict=True)]
        kinds = sorted(set(tails))
        place = {t: len(parts) + i for i, t in enumerate(kinds)}
        parts += self._tails(kinds)
        nothing = len(parts)
        parts.append(b"")
        tail_of = np.full(len(words), nothing, dtype=np.int64)
        tail_of[with_tail] = [place[t] for t in tails]
        # A text's first word has no space before it and is encoded as it is; what has
        # to be encoded whole stands in its place, with nothing behind it.
        first = at[:-1]
        bad = odd[core_of][index]
        bad[first] = False
        bad_row = np.logical_or.reduceat(bad, first) if len(first) else bad
        for name in self.special:
            held = pc.match_substring(texts, name)
            bad_row |= held.to_numpy(zero_copy_only=False).astype(bool)
        starters = self._bytes(
            pc.if_else(pa.array(bad_row), texts, words.take(pa.array(index[first]))).to_pylist()
        )
        order = index.astype(np.int32)
        if bad_row.any():
            order[np.repeat(bad_row, np.diff(at))] = len(words) + len(first)
        order[first] = len(words) + np.arange(len(first))
        # Each distinct word's ids once, then those of all words.
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
        flat = np.frombuffer(b"".join(parts), dtype=DTYPE)
        flat, stops = _laid(flat, sizes, np.stack([core_of, tail_of], axis=1).reshape(-1))
        flat = np.concatenate([flat, np.frombuffer(b"".join(starters), dtype=DTYPE)])
        own = np.array([*map(len, starters), 0], dtype=np.int64) // 4
        ids, stops = _laid(flat, np.concatenate([np.diff(stops[1::2], prepend=0), own]), order)
        return ids, np.diff(stops[at[1:] - 1], prepend=0)


def _chunks(docs: DataFrame, id: str, text: str, tokenizer: str) -> DataFrame:
    """The ids of the ordered documents, a row for each BLOCK_IDS of a partition.

    Ids take two bytes each where all of a row's fit, else four.
    """
    small_batches(docs.sparkSession, TEXT_BYTES)
    ordered = (
        docs.select(
            F.col(id).cast("long").alias("doc"),
            F.col(text).cast("string").alias("text"),
            F.xxhash64(text).alias("tie"),
        )
        .repartitionByRange("doc", "tie")
        .sortWithinPartitions("doc", "tie", "text")
        .select("doc", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = WordTokenizer(tokenizer), TaskContext.get().partitionId()
        docs: list = []
        pieces: list[int] = []
        held: list[np.ndarray] = []
        size = block = first = origin = 0
        counts = np.zeros(1, dtype=np.int64)

        def row(open_: bool, last: bool = False) -> pa.RecordBatch:
            nonlocal counts
            ids = np.concatenate(held)
            found = np.bincount(ids, minlength=len(counts))
            found[: len(counts)] += counts
            counts = found
            used = np.nonzero(counts if last else counts[:0])[0]
            data = ids.astype("<u2" if ids.max() < 1 << 16 else DTYPE).tobytes()
            values = [part, block, first, origin, size, open_, docs, pieces]
            values += [used, counts[used], data]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            kinds += [pa.list_(k) for k in (pa.int64(), pa.int64(), pa.int32(), pa.int64())]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(values, [*kinds, pa.binary()], strict=True)],
                names=[*COLUMNS, "used", "times", "data"],
            )

        for batch in batches:
            ids, lengths = coder.encode(batch["text"])
            ends = np.cumsum(lengths)
            for doc, end, n in zip(batch["doc"].to_pylist(), ends, lengths, strict=True):
                one = np.append(ids[end - n : end], END_ID)
                begins = first + size
                docs.append(doc)
                pieces.append(0)
                while len(one):
                    if size == BLOCK_IDS:
                        begun = pieces[-1] > 0
                        if not begun:
                            docs.pop()
                            pieces.pop()
                        yield row(begun)
                        block, first, size, held = block + 1, first + size, 0, []
                        docs, pieces, origin = [doc], [0], begins
                    take = one[: BLOCK_IDS - size]
                    held.append(take)
                    pieces[-1] += len(take)
                    size += len(take)
                    one = one[len(take) :]
        if size:
            yield row(False, last=True)

    return ordered.mapInArrow(lean(run), CHUNKS)


def count_ids(chunks: DataFrame) -> np.ndarray:
    """How often each id occurs; one number for each id of the vocabulary."""
    found = chunks.select(F.inline(F.arrays_zip("used", "times")).alias("id", "times"))
    rows = found.groupBy(F.col("id")).agg(F.sum("times").alias("n")).collect()
    out = np.zeros(max((r.id for r in rows), default=0) + 1, dtype=np.int64)
    for r in rows:
        out[r.id] = r.n
    return out


def scaled(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies in proportion to counts that sum to 2 ** scale; used ids get 1 at least."""
    total, whole = int(counts.sum()), 1 << scale
    if not total:
        return np.array([whole], dtype=np.uint64)
    freq = np.where(counts > 0, np.maximum(1, counts * (whole / total)), 0).astype(np.int64)
    over = int(freq.sum()) - whole
    while over:
        order = np.argsort(-freq, kind="stable")[: max(1, min(abs(over), len(freq) // 8))]
        order = order[freq[order] > 1] if over > 0 else order
        step = max(1, abs(over) // len(order))
        change = np.minimum(step, freq[order] - 1) if over > 0 else np.full(len(order), step)
        change = change[np.cumsum(change) <= abs(over)]
        if not len(change):
            order, change = order[:1], np.array([min(abs(over), int(freq[order[0]]) - 1)])
        freq[order[: len(change)]] -= np.sign(over) * change
        over = int(freq.sum()) - whole
    return freq.astype(np.uint64)


class RansCodec:
    """Interleaved rANS over one shared frequency table."""

    def __init__(
        self,
        freq: np.ndarray,
        scale: int | None = None,
        lanes: int | None = None,
        steps: int | None = None,
    ):
        self.scale, self.lanes, self.steps = scale or SCALE, lanes or LANES, steps or STEPS
        self.freq = freq.astype(np.uint64)
        self.before = (np.cumsum(self.freq) - self.freq).astype(np.uint64)
        self.limit = self.freq << np.uint64(32 + 31 - self.scale)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """The code words of a block, and its checkpoints."""
        lanes = self.lanes
        steps = -(-len(ids) // lanes)
        grid = np.full(steps * lanes, int(np.argmax(self.freq)), dtype=np.int64)
        grid[: len(ids)] = ids
        grid = grid.reshape(steps, lanes)
        state = np.full(lanes, LOW, dtype=np.uint64)
        words: list[np.ndarray] = []
        states: list[np.ndarray] = []
        shift, scale = np.uint64(32), np.uint64(self.scale)
        for step in range(steps - 1, -1, -1):
            row = grid[step]
            freq = self.freq[row]
            full = state >= self.limit[row]
            words.append(state[full].astype(np.uint32))
            state = np.where(full, state >> shift, state)
            times, rest = np.divmod(state, freq)
            state = (times << scale) + rest + self.before[row]
            if step % self.steps == 0:
                states.append(state)
        words.reverse()
        states.reverse()
        ends = [0, *accumulate(len(w) for w in words)]
        at = np.array([ends[s] for s in range(0, steps, self.steps)], dtype="<u8")
        marks = at.tobytes() + b"".join(s.astype("<u8").tobytes() for s in states)
        return np.concatenate(words).astype("<u4").tobytes(), marks

    def decode(self, code: bytes, marks: bytes, n: int, only: int | None = None) -> np.ndarray:
        """The ids of a block, or of what follows one of its checkpoints."""
        lanes, every = self.lanes, self.steps
        steps = -(-n // lanes)
        count = -(-steps // every)
        at = np.frombuffer(marks, dtype="<u8", count=count).astype(np.int64)
        states = np.frombuffer(marks, dtype="<u8", offset=8 * count).reshape(count, lanes)
        words = np.frombuffer(code, dtype="<u4").astype(np.uint64)
        chosen = range(count) if only is None else [only]
        out = np.empty((steps, lanes), dtype=np.uint32)
        low, scale, shift = np.uint64(LOW), np.uint64(self.scale), np.uint64(32)
        mask = np.uint64((1 << self.scale) - 1)
        for mark in chosen:
            state, place = states[mark].astype(np.uint64), int(at[mark])
            for step in range(mark * every, min(steps, (mark + 1) * every)):
                slot = state & mask
                row = self.symbol[slot]
                out[step] = row
                state = self.freq[row] * (state >> scale) + slot - self.before[row]
                needs = np.nonzero(state < low)[0]
                if len(needs):
                    more = words[place : place + len(needs)]
                    state[needs] = (state[needs] << shift) | more
                    place += len(needs)
        ids = out.reshape(-1)[:n]
        if only is None:
            return ids
        return ids[only * every * lanes : (only + 1) * every * lanes]


def write(
    docs: DataFrame,
    scratch: Scratch,
    tokenizer: str,
    id: str = "doc_id",
    text: str = "text",
    name: str = "blocks",
    folder: str | None = None,
) -> tuple[DataFrame, np.ndarray]:
    """Write all documents' ids; returns the files as a table, and the frequencies.

    The files are in folder, a new one (an output_folder() by default) that
    stays after the session; read() and by_document() take just that folder.

    Documents are in ascending order of id (those without one first, ties in
    order of a hash of the text), each followed by the end id; a null text is
    empty. A row is a block; (part, block) is its place in the whole.
    """
    chunks = scratch.keep(_chunks(docs, id, text, tokenizer), f"{name}-ids")
    scratch.settle()
    freq = scaled(count_ids(chunks))
    shared = docs.sparkSession.sparkContext.broadcast(freq)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = RansCodec(shared.value)
        for batch in batches:
            for i in range(len(batch)):
                data = batch["data"][i].as_py()
                width = len(data) // batch["ids"][i].as_py()
                ids = np.frombuffer(data, dtype=f"<u{width}").astype(DTYPE)
                code, marks = codec.encode(ids)
                one = batch.slice(i, 1).select(COLUMNS)
                added = [pa.array([code], pa.binary()), pa.array([marks], pa.binary())]
                added.append(pa.array([zlib.crc32(ids)], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*one.columns, *added], names=[*one.schema.names, "code", "marks", "crc32"]
                )

    spark = docs.sparkSession
    folder = folder or output_folder(spark, name)
    coded = chunks.select(*COLUMNS, "data").mapInArrow(lean(run), WRITTEN)
    coded.write.option("compression", "uncompressed").parquet(f"{folder}/blocks")
    used = np.nonzero(freq)[0]
    table = pa.table({"id": used.astype(np.int64), "freq": freq[used].astype(np.int64)})
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{folder}/frequencies")
    form = (tokenizer, END_ID, len(freq), SCALE, LANES, STEPS)
    spark.createDataFrame([form], FORMAT).coalesce(1).write.parquet(f"{folder}/format")
    scratch.drop(f"{name}-ids")
    return spark.read.schema(WRITTEN).parquet(f"{folder}/blocks"), freq


def load(spark: SparkSession, folder: str) -> tuple[DataFrame, RansCodec]:
    """The blocks that write() put into folder, and the codec they were made with."""
    form = spark.read.schema(FORMAT).parquet(f"{folder}/format").first()
    freq = np.zeros(form.ids, dtype=np.uint64)
    for r in spark.read.schema(FREQUENCIES).parquet(f"{folder}/frequencies").collect():
        freq[r.id] = r.freq
    blocks = spark.read.schema(WRITTEN).parquet(f"{folder}/blocks")
    return blocks, RansCodec(freq, form.scale, form.lanes, form.steps)


def joined_crc(first: int, second: int, size: int) -> int:
    """The crc32 of two byte strings on end, from theirs and the second's size."""
    zeros = bytes(size)
    return zlib.crc32(zeros, first) ^ zlib.crc32(zeros) ^ second


def read(files: DataFrame | str, freq: np.ndarray | None = None) -> DataFrame:
    """Decode blocks to rows (part, first, origin, doc, n, crc, whole), one for each piece.

    ``files`` is a folder that write() has filled, or its blocks with their
    frequencies (in the format of this module).
    ``whole`` is false for the pieces of a document that lies in several blocks.
    A block whose ids don't match its checksum raises an error.
    """
    if isinstance(files, str):
        blocks, one = load(SparkSession.active(), files)
    else:
        blocks, one = files, RansCodec(freq)
    small_batches(blocks.sparkSession)
    form = (one.freq, one.scale, one.lanes, one.steps)
    shared = blocks.sparkSession.sparkContext.broadcast(form)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = RansCodec(*shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                ids = codec.decode(row["code"], row["marks"], row["ids"])
                data = memoryview(ids.astype(DTYPE).tobytes())
                if zlib.crc32(data) != row["crc32"]:
                    raise ValueError(f"block {row['part']}:{row['block']} is damaged")
                sizes = np.array(row["pieces"], dtype=np.int64)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                crcs = [
                    zlib.crc32(data[4 * a : 4 * b])
                    for a, b in zip(starts.tolist(), ends.tolist(), strict=True)
                ]
                origins = row["first"] + starts
                whole = np.ones(len(sizes), dtype=bool)
                whole[0] &= row["origin"] == row["first"]
                whole[-1] &= not row["open"]
                origins[0] = row["origin"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(sizes), row["part"], dtype=np.int32)),
                        pa.array(row["first"] + starts),
                        pa.array(origins),
                        pa.array(row["docs"], pa.int64()),
                        pa.array(sizes),
                        pa.array(crcs, pa.int64()),
                        pa.array(whole),
                    ],
                    names=["part", "first", "origin", "doc", "n", "crc", "whole"],
                )

    return blocks.mapInArrow(lean(run), PIECES)


def by_document(
    files: DataFrame | str,
    freq: np.ndarray | None = None,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Rows (doc, start, n_tokens, ids_crc32) from the files alone, one a document.

    ``files`` and ``freq`` are as in read().
    ``start`` counts the ids of all documents before; ids include the end id,
    and the checksum is over them as little-endian unsigned 32-bit integers.
    """
    spark = SparkSession.active()
    scratch = scratch or Scratch(spark, "tokens")
    pieces = scratch.keep(read(files, freq), "pieces")
    blocks = spark.read.schema(WRITTEN).parquet(f"{files}/blocks") if isinstance(files, str) else files
    sizes = blocks.groupBy("part").agg(F.sum("ids").alias("ids")).orderBy("part").collect()
    ends = list(accumulate(r.ids for r in sizes))
    offsets = spark.createDataFrame(
        [(r.part, end - r.ids) for r, end in zip(sizes, ends, strict=True)],
        "at int, offset long",
    )
    cut = (
        pieces.filter("NOT whole")
        .groupBy("part", "origin", "doc")
        .agg(F.sort_array(F.collect_list(F.struct("first", "n", "crc"))).alias("parts"))
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, crcs = [], []
            for parts in batch["parts"].to_pylist():
                size, crc = 0, 0
                for part in parts:
                    crc = joined_crc(crc, part["crc"], 4 * part["n"])
                    size += part["n"]
                sizes.append(size)
                crcs.append(crc)
            yield pa.RecordBatch.from_arrays(
                [batch["part"], batch["origin"], batch["doc"], pa.array(sizes, pa.int64()),
                 pa.array(crcs, pa.int64())],
                names=["part", "origin", "doc", "n", "crc"],
            )

    columns = ["part", "origin", "doc", "n", "crc"]
    joined = cut.mapInArrow(lean(join), "part int, origin long, doc long, n long, crc long")
    every = pieces.filter("whole").select(*columns).unionByName(joined)
    return every.join(offsets, F.col("part") == F.col("at"), "left").select(
        "doc",
        (F.col("offset") + F.col("origin")).alias("start"),
        F.col("n").alias("n_tokens"),
        F.col("crc").alias("ids_crc32"),
    )
