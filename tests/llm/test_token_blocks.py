import json
import pathlib
import subprocess
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from biasloom.llm import token_blocks
from biasloom.llm.common import Scratch
from biasloom.llm.token_blocks import (
    LANES, STEPS, RansCodec, WordTokenizer, by_document, joined_crc, scaled, write,
)

NAME = "byte_bpe_50k.json"
TEXTS = [
    "", "a", " a b", "a  b", "a   b\n\n c", "x \n y", "x\n y ", "tab\tz  ", "don't it's", "é漢字 日",
    "a.\nB c\nÉd\n\nx", "\nq", "q\n\n\nr", "s\n t", "u.\n12\nv's\nw' ## a-b", "\n'll x\n's",
    "Wörter, überall... naïve's (x) don't, can't. 'll 12, a1b2! ÆØ: e\u0301te", ", . !? x,;y",
    "a b   c", "<|endoftext|> x", "\x1c a \x1cb", "word " * 300, " ", "\n", " \n ", "a\n ",
]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(NAME))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_are_encoded_as_in_the_whole_text(plain):
    ids, lengths = WordTokenizer(NAME).encode(pa.array([*TEXTS, None]))
    ends = np.cumsum(lengths)
    got = [ids[e - n : e].tolist() for e, n in zip(ends, lengths, strict=True)]
    assert got == [plain(t) for t in [*TEXTS, None]]


def test_texts_with_special_tokens(plain):
    """As the library does it: their strings are tokens, whatever is beside them."""
    rng = np.random.default_rng(3)
    parts = ["<|endoftext|>", "hello", " world", ".", "\n", " ", "<|", "endoftext|>", "é", "12", "\t"]
    texts = ["hello <|endoftext|> world"]
    texts += ["".join(rng.choice(parts, rng.integers(1, 9))) for _ in range(3000)]
    assert len(plain(texts[0])) == 4 and 50256 in plain(texts[0])
    ids, lengths = WordTokenizer(NAME).encode(pa.array(texts))
    ends = np.cumsum(lengths)
    for text, end, n in zip(texts, ends, lengths, strict=True):
        assert ids[end - n : end].tolist() == plain(text), text


def test_a_forgetful_tokenizer_is_right(monkeypatch, plain):
    monkeypatch.setattr(token_blocks, "CACHE_WORDS", 3)
    coder = WordTokenizer(NAME)
    for text in TEXTS + TEXTS[::-1]:
        assert coder.encode(pa.array([text]))[0].tolist() == plain(text)


def test_a_full_memory_keeps_the_words_at_hand(monkeypatch):
    monkeypatch.setattr(token_blocks, "CACHE_WORDS", 3)
    coder = WordTokenizer(NAME)
    coder.encode(pa.array(["x alpha beta gamma delta"]))
    known = coder.known["alpha"]
    coder.encode(pa.array(["x alpha epsilon"]))
    assert coder.known["alpha"] is known and sorted(coder.known) == ["alpha", "epsilon", "x"]


def some_runs(n):
    rng = np.random.default_rng(n)
    letters = list("abcdefgetaoinsr" + "ABÉéüßñÅ" + "漢字日жд")
    return ["".join(rng.choice(letters, k)) for k in rng.integers(1, 12, n)]


def test_new_words_come_to_the_model_together(plain):
    """The library takes many in one call; one by one costs three times as much."""

    class Counted:
        calls = 0

        def __init__(self, inner):
            self.inner = inner

        def __getattr__(self, name):
            def call(*args, **options):
                Counted.calls += 1
                return getattr(self.inner, name)(*args, **options)

            return call

    coder = WordTokenizer(NAME)
    for part in ("tokenizer", "model", "bare"):
        if hasattr(coder, part):
            setattr(coder, part, Counted(getattr(coder, part)))
    runs = some_runs(4000)
    texts = [" ".join(runs), "\n".join(runs[::-1]), "x. \n".join(runs)]
    got = [coder.encode(pa.array([text]))[0].tolist() for text in texts]
    assert got == [plain(text) for text in texts]
    assert Counted.calls < 200


def test_a_vocabulary_that_reaches_from_word_to_word(tmp_path):
    """Merges across words are never made, whether the vocabulary has them or not."""
    form = json.loads(pathlib.Path(public_tokenizers.path(NAME)).read_text())
    vocab = form["model"]["vocab"]
    form["model"]["merges"] = [["a", "\u0120"], ["a\u0120", "b"], ["\u0120", "b"], ["b", "\u010a"]]
    form["model"]["vocab"] = {t: i for t, i in vocab.items() if len(t) == 1}
    for left, right in form["model"]["merges"]:
        form["model"]["vocab"].setdefault(left + right, len(vocab) + len(form["model"]["vocab"]))
    path = tmp_path / "crossing.json"
    path.write_text(json.dumps(form))
    crossing = Tokenizer.from_file(str(path))
    coder = WordTokenizer(str(path))
    assert coder.begins is None
    for text in ["b ba b a bb", "a\nb a\na b", "ab\nb ba"]:
        want = crossing.encode(text, add_special_tokens=False).ids
        assert coder.encode(pa.array([text]))[0].tolist() == want


def test_ids_of_more_than_two_bytes(spark, monkeypatch, tmp_path):
    """Rows of wide and of narrow ids, each partition counted once."""
    monkeypatch.setattr(token_blocks, "BLOCK_IDS", 50)
    form = json.loads(pathlib.Path(public_tokenizers.path(NAME)).read_text())
    form["model"]["vocab"]["z"] = 100_000
    path = tmp_path / "wide.json"
    path.write_text(json.dumps(form))
    wide = Tokenizer.from_file(str(path))
    texts = ["some words " * 40, "z z zz " * 30, "", "other words", "z"]
    rows = list(enumerate(texts * 4))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    scratch = Scratch(spark, "test")
    chunks = scratch.keep(token_blocks._chunks(df, "doc_id", "text", str(path)), "ids")
    widths = {len(r.data) // r.ids for r in chunks.collect()}
    counts = token_blocks.count_ids(chunks)
    got = by_document(*write(df, scratch, str(path)), scratch).orderBy("start").collect()
    start, every = 0, []
    for row, (doc, text) in zip(got, rows, strict=True):
        ids = [*wide.encode(text, add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert tuple(row) == (doc, start, len(ids), crc)
        start += len(ids)
        every += ids
    assert widths == {2, 4}
    assert counts.tolist() == np.bincount(every).tolist()


def test_texts_come_in_small_batches(spark, monkeypatch):
    """A worker's memory is many times the batch that it tokenises."""

    class Bounded(WordTokenizer):
        def encode(self, texts):
            assert sum(len(t.as_py()) for t in texts) < 2 << 20
            return super().encode(texts)

    monkeypatch.setattr(token_blocks, "WordTokenizer", Bounded)
    df = spark.range(60).selectExpr("id AS doc_id", "repeat('some words ', 20000) AS text")
    scratch = Scratch(spark, "test")
    blocks, freq = write(df.coalesce(1), scratch, NAME)
    rows = by_document(blocks, freq, scratch).collect()
    assert len(rows) == 60 and len({(r.n_tokens, r.ids_crc32) for r in rows}) == 1


@pytest.mark.parametrize("n", [1, LANES - 1, LANES, LANES * STEPS + 17, 3 * LANES * STEPS])
def test_rans_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 4999).astype(np.int64)
    freq = scaled(np.bincount(ids, minlength=5000))
    assert freq.sum() == 1 << token_blocks.SCALE
    assert (freq[np.unique(ids)] > 0).all()
    codec = RansCodec(freq)
    code, marks = codec.encode(ids)
    assert (codec.decode(code, marks, n) == ids).all()
    step = LANES * STEPS
    for mark in range(-(-n // step)):
        part = codec.decode(code, marks, n, only=mark)
        assert (part == ids[mark * step : (mark + 1) * step]).all()


def test_rans_size_is_near_the_entropy():
    rng = np.random.default_rng(0)
    ids = np.minimum(rng.geometric(0.01, 400_000), 2000)
    counts = np.bincount(ids)
    share = counts[counts > 0] / len(ids)
    code, marks = RansCodec(scaled(counts)).encode(ids)
    assert 8 * len(code) < 1.02 * len(ids) * -(share * np.log2(share)).sum()


def test_scaled_with_many_rare_ids():
    counts = np.ones(900_000, dtype=np.int64)
    counts[3] = 10**12
    assert scaled(counts).sum() == 1 << token_blocks.SCALE
    assert scaled(counts).min() == 1


def test_joined_crc():
    a, b = b"some", b"thing longer"
    assert joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@pytest.mark.parametrize("block", [token_blocks.BLOCK_IDS, 7])
def test_files_round_trip(spark, monkeypatch, plain, block):
    monkeypatch.setattr(token_blocks, "BLOCK_IDS", block)
    rows = [(i * 3 % 41, t, "x") for i, t in enumerate(TEXTS)]
    rows += [(None, "no id", "x"), (100, None, "x"), (101, "same", "x"), (101, "same", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    scratch = Scratch(spark, "test")
    got = by_document(*write(df, scratch, NAME), scratch).collect()
    want, start = [], 0
    for doc, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*plain(text), 2]
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        want.append((doc, start, len(ids), crc))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_empty_and_damaged(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    scratch = Scratch(spark, "test")
    assert by_document(*write(df, scratch, NAME), scratch).count() == 0
    full = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    blocks, freq = write(full, Scratch(spark, "test"), NAME)
    broken = blocks.selectExpr(
        *[c for c in blocks.columns if c != "crc32"], "crc32 + 1 AS crc32"
    )
    with pytest.raises(Exception, match="damaged"):
        by_document(broken, freq, Scratch(spark, "test")).collect()


WRITER = """
import sys
from tests.conftest import session
from biasloom.llm.common import Scratch
from biasloom.llm.token_blocks import write
spark = session("2")
df = spark.createDataFrame([(2, "some words"), (1, "a b"), (3, None)], "doc_id long, text string")
write(df, Scratch(spark, "test"), sys.argv[2], folder=sys.argv[1])
spark.stop()
"""


def test_a_folder_holds_all_and_stays(spark, monkeypatch, plain, tmp_path):
    folder = str(tmp_path / "files")
    root = pathlib.Path(__file__).resolve().parents[2]
    subprocess.run([sys.executable, "-c", WRITER, folder, NAME], cwd=root, check=True, timeout=300)
    form = spark.read.parquet(f"{folder}/format").first()
    assert (form.tokenizer, form.end_id, form.lanes) == (NAME, token_blocks.END_ID, LANES)
    # The folder says how its blocks were made, not this module.
    monkeypatch.setattr(token_blocks, "LANES", 64)
    monkeypatch.setattr(token_blocks, "STEPS", 16)
    got = by_document(folder).orderBy("start").collect()
    texts = {1: "a b", 2: "some words", 3: ""}
    start = 0
    for row, (doc, text) in zip(got, texts.items(), strict=True):
        ids = [*plain(text), 2]
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert tuple(row) == (doc, start, len(ids), crc)
        start += len(ids)


def test_the_query_leaves_its_files(spark, tmp_path):
    from biasloom.llm.queries import REGISTRY

    spark.conf.set("spark.biasloom.output.dir", str(tmp_path))
    try:
        got = REGISTRY["op5_token_blocks"](spark, "/root/testdata/sf0.001").collect()
    finally:
        spark.conf.unset("spark.biasloom.output.dir")
    (folder,) = (tmp_path / "biasloom-output").iterdir()
    assert sorted(map(tuple, by_document(str(folder)).collect())) == sorted(map(tuple, got))
