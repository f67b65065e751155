import numpy as np
import pytest

from biasloom.llm import suffix_dedup
from biasloom.llm.common import Scratch
from biasloom.llm.suffix_dedup import Portion, anchors, deduplicate, multikey_sort


def plain(docs):
    """The kept bytes and number of removed runs of each (id, text)."""
    least = {}
    for doc, text in docs:
        data = (text or "").encode()
        if doc is not None:
            for i in range(len(data) - 49):
                w = data[i : i + 50]
                least[w] = min(least.get(w, doc), doc)
    out = []
    for doc, text in docs:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, dtype=bool)
        if doc is not None:
            for i in range(len(data) - 49):
                if least[data[i : i + 50]] < doc:
                    gone[i : i + 50] = True
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone, strict=False) if not g)
        out.append((doc, kept, len(data), int(gone.sum()), runs))
    return sorted(out, key=str)


def prose(rng, n, words=4000):
    return " ".join(f"w{x}é" for x in rng.integers(0, words, n))


def corpus():
    rng = np.random.default_rng(5)
    passage, line = prose(rng, 40), "This line stands in very many of the documents here."
    docs = []
    for i in range(60):
        text = prose(rng, int(rng.integers(1, 150)))
        if i % 3 == 0:
            text = f"{text[:50]} {line} {text[50:]}"
        if i % 7 == 0:
            cut = int(rng.integers(0, 60))
            text += passage[cut : 300 - cut]
        docs.append((int(rng.integers(0, 1000)), text))
    for i in range(20):
        doc, text = docs[i]
        at = int(rng.integers(0, len(text)))
        docs.append((2000 - i, text[:at] + "X" + text[at + 1 :]))
    docs += [(5000 + i, docs[3][1]) for i in range(5)]
    docs += [(1, "a" * 130), (7, "a" * 49), (8, "a" * 50), (9, "ab" * 90), (10, "ba" * 60)]
    docs += [(11, "\x00" * 80), (12, "\x00" * 70 + "end"), (13, None), (14, ""), (None, line * 3)]
    docs += [(15, line + line), (15, line + line), (15, "other " + line)]
    return docs


def test_anchors_cover_each_window_once():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 4000, dtype=np.uint8)
    ends = np.array([10, 1500, 1500, 1555, 4000])
    doc, first, last, at = anchors(data, np.diff(ends, prepend=0))
    assert (doc == np.searchsorted(ends, first, side="right")).all()
    windows = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last, strict=True)])
    want = [i for a, b in zip([0, *ends], ends, strict=False) for i in range(a, b - 49)]
    assert windows.tolist() == want
    assert (at >= last).all() and (at <= first + 34).all()


def test_multikey_sort_is_a_stable_sort():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 2, (600, suffix_dedup.ROW + 2), dtype=np.uint8)
    rows[:, 3:] = rows[:, 3:4]
    order, new = multikey_sort(rows)
    want = sorted(range(600), key=lambda i: rows[i].tobytes())
    assert order.tolist() == want
    same = [rows[a].tobytes() != rows[b].tobytes() for a, b in zip(want, want[1:], strict=False)]
    assert new.tolist() == [True, *same]


def test_a_long_text_is_read_in_pieces(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PORTION", 300)
    text = prose(np.random.default_rng(2), 400).encode()
    pieces = [(1, 0, at, text[at : at + 349]) for at in range(0, len(text), 300)]
    starts = []
    for piece in pieces:
        portion = Portion([piece], None, None)
        size = portion.rows[:, -2].astype(int) + portion.rows[:, -1] - 49
        for group, _, start in portion.places.tolist():
            starts += range(start, start + size[group])
    assert sorted(starts) == list(range(len(text) - 49))


@pytest.mark.parametrize(("portion", "buckets"), [(2 << 20, 3), (700, 5), (100, 1)])
def test_equals_brute_force(spark, monkeypatch, portion, buckets):
    monkeypatch.setattr(suffix_dedup, "PORTION", portion)
    monkeypatch.setattr(suffix_dedup, "COMPARED", 30)
    docs = corpus()
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, kept string")
    out = deduplicate(df.repartition(4), Scratch(spark, "test"), buckets=buckets).collect()
    got = [(r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, len(r.spans)) for r in out]
    assert sorted(got, key=str) == plain(docs)


def test_split_leading_bytes(spark, monkeypatch):
    """Every leading value that the sample has three times is dealt as windows."""
    monkeypatch.setattr(suffix_dedup, "HOT_SAMPLES", 3)
    monkeypatch.setattr(suffix_dedup, "HOT_TIMES", 0)
    monkeypatch.setattr(suffix_dedup, "COMPARED", 30)
    monkeypatch.setattr(suffix_dedup, "PORTION", 3000)
    monkeypatch.setattr(suffix_dedup, "SAMPLES", 100)
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = df.selectExpr("doc_id AS doc", "xxhash64(text) AS mark", "CAST(text AS binary) AS data")
    deal = suffix_dedup.splitters(rows.filter("doc IS NOT NULL AND length(data) > 49"), len(docs), 5)
    assert len(deal.hot) > 10
    out = deduplicate(df, Scratch(spark, "test"), buckets=5).collect()
    got = [(r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, len(r.spans)) for r in out]
    assert sorted(got, key=str) == plain(docs)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert deduplicate(df, Scratch(spark, "test")).count() == 0
