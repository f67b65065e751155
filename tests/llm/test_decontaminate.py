import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from biasloom.llm import decontaminate
from biasloom.llm.common import Scratch
from biasloom.llm.decontaminate import SuffixAutomaton, find, merged, remove, words_of


def plain(items, text, window):
    words = text.lower().split()
    hit, found = set(), set()
    for item, body in items:
        body = body.lower().split()
        n = min(window, len(body))
        for a in range(len(body) - n + 1 if n else 0):
            for i in range(len(words) - n + 1):
                if words[i : i + n] == body[a : a + n]:
                    hit |= set(range(i, i + n))
                    found.add(item)
    return hit, found


texts = st.lists(st.sampled_from("abc"), max_size=14).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, max_size=4), st.lists(texts, max_size=3).map(" ".join))
def test_scan_equals_brute_force(bodies, text):
    items = [(str(i), b) for i, b in enumerate(bodies)]
    spans, found = SuffixAutomaton([(i, b.encode()) for i, b in items], 4).scan(
        words_of(text.encode())
    )
    assert spans == merged([list(s) for s in spans])
    hit = {w for a, b in spans for w in range(a, b)}
    assert (hit, found) == plain(items, text, 4)


def test_words():
    text = "Ab-c É1x\x00q\x7f漢_字 "
    want = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "ab-c É1x\x00q\x7f漢_字 ")
    assert [w.decode() for w in words_of(text.encode())] == want


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 20])
def test_find_and_remove(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    items = spark.createDataFrame(
        [(1, "one two three four five"), (1, "red, green"), (2, "Blue"), (3, None),
         (None, "x y z"), (4, "three FOUR five six")],
        "item_id long, text string",
    )
    rows = [
        (1, "so ONE two; three four five six end of it all here", "a"),
        (2, None, "b"), (3, "", "b"), (4, "red green", "c"), (4, "red green", "c"),
        (None, "a blue X y z b c d e f g h i", None), (5, "clean words", "z"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, items string")
    found = find(docs, items, Scratch(spark, "test"), window=3)
    got = sorted((tuple(r) for r in found.drop("text").collect()), key=str)
    want = [
        (1, 12, 6, [(1, 7)], ["1", "4"]), (2, 0, 0, [], []), (3, 0, 0, [], []),
        (4, 2, 2, [(0, 2)], ["1"]), (4, 2, 2, [(0, 2)], ["1"]), (5, 2, 0, [], []),
        (None, 13, 4, [(1, 5)], ["2"]),
    ]
    assert [(a, b, c, [tuple(s) for s in d], e) for a, b, c, d, e in got] == sorted(
        want, key=str
    )
    left = {r.doc_id: r.text for r in remove(found, least_words=3, most_coverage=0.6).collect()}
    assert left == {
        1: "so  end of it all here", 2: None, 3: "", 5: "clean words",
        None: "a  b c d e f g h i",
    }


def test_empty_tables_and_long_text(spark):
    schema = "doc_id long, text string"
    docs = spark.createDataFrame([(1, "w " * 200_000 + "k l m")], schema)
    items = spark.createDataFrame([(1, "k l m")], "item_id long, text string")
    scratch = Scratch(spark, "test")
    row = find(docs, items, scratch).first()
    assert (row.n_words, row.n_hit) == (200_003, 3)
    assert find(docs, items.limit(0), scratch).first().n_hit == 0
    assert find(docs.limit(0), items, scratch).count() == 0
