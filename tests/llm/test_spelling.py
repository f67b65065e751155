import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from biasloom.llm import spelling
from biasloom.llm.common import Scratch
from biasloom.llm.spelling import group, near_pairs

UPPER = {c: c + 32 for c in range(65, 91)}


def plain_words(docs, deleting):
    counts = Counter()
    for id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if id is None else id}:{run}".encode())
            if deleting and h % deleting == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain_near(words):
    """For each word its near words, from what is left when a letter goes."""
    sites = {}
    for w in words:
        sites.setdefault((w, None), []).append(w)
        for k in range(len(w)):
            sites.setdefault((w[:k] + w[k + 1 :], k), []).append(w)
    out = {w: set() for w in words}
    for (rest, k), found in sites.items():
        for a in found:
            out[a] |= {b for b in found if b != a and k is not None}
            if k is not None and (rest, None) in sites:
                out[a].add(rest)
                out[rest].add(a)
    return out


def plain_group(docs, deleting=None):
    counts = plain_words(docs, deleting)
    near, form = plain_near(counts), {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return out


def test_plain_near():
    assert plain_near(["abcd", "abce", "abc", "acbd", "aabc"]) == {
        "abcd": {"abce", "abc"}, "abce": {"abcd", "abc"}, "abc": {"abcd", "abce", "aabc"},
        "acbd": set(), "aabc": {"abc"},
    }


def grouped(spark, docs, schema="doc_id long, text string", **options):
    df = spark.createDataFrame(docs, schema)
    found = group(df, Scratch(spark, "test"), **options).collect()
    assert len(found) == len({r["word"] for r in found})
    return {tuple(r) for r in found}


def variants(rng, n):
    """Words, and words some letters away from them; few letters, so many are near."""
    letters = list("aabcdeé")
    words = ["".join(rng.choice(letters, rng.integers(6, 10))) for _ in range(n)]
    for w in list(words):
        for _ in range(rng.integers(0, 4)):
            k = int(rng.integers(0, len(w) + 1))
            w = w[:k] + str(rng.choice(letters)) * int(rng.integers(0, 2)) + w[k + rng.integers(0, 2) :]
            words.append(w)
    return [w for w in words if w]


def test_group(spark):
    rng = np.random.default_rng(1)
    docs = []
    for k in range(30):
        words = [w for w in variants(rng, 12) for _ in range(int(2 ** rng.integers(0, 7)))]
        docs.append((k, " ".join(words).title() if k % 3 else ", ".join(words)))
    docs += docs[:4]
    for deleting in (None, 3, 31):
        got = grouped(spark, docs, deleting=deleting)
        assert got == plain_group(docs, deleting)
        assert any(form for _, form, *_ in got)


@pytest.mark.parametrize("joint", [1, 40])
@pytest.mark.parametrize("block", [16384, 9])
def test_near_pairs_in_blocks(spark, monkeypatch, block, joint):
    """Groups beyond one block lose no pair and give none twice."""
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block)
    monkeypatch.setattr(spelling, "JOINT_WORDS", joint)
    monkeypatch.setattr(spelling, "TILE", 16)
    words = sorted(set(variants(np.random.default_rng(2), 400)))
    df = spark.createDataFrame([(w, len(w)) for w in words], "word string, n long")
    got = [tuple(sorted(r[:2])) for r in near_pairs(df, Scratch(spark, "test")).collect()]
    want = {tuple(sorted((a, b))) for a, found in plain_near(words).items() for b in found}
    assert len(got) == len(set(got)) and set(got) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=7), unique=True, max_size=30))
def test_near(words):
    """Over all choices of parts, each near pair comes once."""
    part = np.arange(len(spelling.LETTERS)) % spelling.PARTS
    n = len(words)
    got = []
    for choice in range(len(spelling.CHOICES)):
        keys = spelling.part_keys(spelling.Letters(words).counts(), part) if n else np.zeros((0, 4))
        same = [tuple(k) for k in keys[:, list(spelling.CHOICES[choice])].tolist()]
        names = {k: at for at, k in enumerate(dict.fromkeys(same))}
        of = np.array([names[k] for k in same], dtype=np.int64)
        a, b = spelling.near(words, of, np.full(n, 2), np.full(n, choice), part)
        got += [tuple(sorted((words[x], words[y]))) for x, y in zip(a, b, strict=True)]
    want = {tuple(sorted((a, b))) for a, found in plain_near(words).items() for b in found}
    assert len(got) == len(set(got)) and set(got) == want


def test_chain_of_forms(spark):
    """Forms are followed to the last; a tie goes to the least word."""
    words = {"abcdefg": 2, "abcdefh": 25, "abcdefi": 25, "abcdzfh": 300, "abczzfh": 3100}
    docs = [(None, " ".join(w for w, n in words.items() for _ in range(n)))]
    got = grouped(spark, docs)
    assert got == plain_group(docs)
    assert ("abcdefg", "abcdefh", "abczzfh", 2, 2, 25) in got


def test_edge_cases(spark):
    long = "a" * 5000
    docs = [
        (1, None), (2, ""), (None, "abcdefg"), (3, "Abcdefg Ébcdefg ébcdefg"),
        (3, "Abcdefg Ébcdefg ébcdefg"), (4, f"{long} {long}b {long}"), (5, f"{long}b"),
        (6, "Ābcdefg Ābcdefg abcdef7 abcdef7 short short"),
    ]
    assert grouped(spark, docs) == plain_group(docs)
    assert grouped(spark, []) == set()
    assert grouped(spark, [(1, "none")]) == set()
    names = ["word", "n", "form", "root", "key", "run", "of", "choice"]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    clash = df.withColumns({n: F.lit("x") for n in names})
    assert {tuple(r) for r in group(clash, Scratch(spark, "test")).collect()} == plain_group(docs)
