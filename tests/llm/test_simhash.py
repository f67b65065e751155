import numpy as np
import pytest
import xxhash

from biasloom.llm.common import Scratch
from biasloom.llm.components import components
from biasloom.llm.simhash import copies, fingerprint, links, near_duplicates, trie_links


def plain_fingerprint(text, width=3):
    words = "".join(c.lower() if c < "\x80" else c for c in text).split()
    words = [w for w in words]
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    shingles = [" ".join(words[i : i + width]) for i in range(n)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
    )


def plain_components(fps):
    """The least position reachable from each position."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= 2:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


def test_fingerprint():
    for text in ["", " \n", "a", "A b", "a b c d e", "É x y É z É x y", "a b c " * 70]:
        assert fingerprint(text.encode(), 3) == plain_fingerprint(text)


def clustered(rng, n):
    base = rng.integers(0, 1 << 63, n // 4, dtype=np.uint64)
    out = set(map(int, base))
    for value in map(int, base):
        for _ in range(3):
            for bit in rng.choice(64, rng.integers(1, 4), replace=False):
                value ^= 1 << int(bit)
            out.add(value)
    return sorted(out)


def test_trie_links_finds_every_pair():
    rng = np.random.default_rng(1)
    values = clustered(rng, 2000)
    a = np.array(values, dtype=np.uint64)
    got = {
        (min(x, y), max(x, y))
        for u, v in trie_links(a, a, 2, True)
        for x, y in zip(u.tolist(), v.tolist(), strict=True)
    }
    want = set()
    for i, x in enumerate(a):
        near = np.bitwise_count(a[i + 1 :] ^ x) <= 2
        want |= {(int(x), int(y)) for y in a[i + 1 :][near]}
    assert got == want and want


@pytest.mark.parametrize("node_rows", [20_000, 60, 15])
def test_links_over_nodes(spark, node_rows):
    values = clustered(np.random.default_rng(2), 600)
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    scratch = Scratch(spark, "test")
    found = components(links(df, 2, node_rows), scratch).collect()
    place = {v: i for i, v in enumerate(signed)}
    want = plain_components(values)
    groups, got = {}, {}
    for i, root in enumerate(want):
        groups.setdefault(root, set()).add(i)
    for row in found:
        got.setdefault(row.root, set()).add(place[row.node])
    assert sorted(map(sorted, got.values())) == sorted(
        sorted(g) for g in groups.values() if len(g) > 1
    )


def test_components_of_a_chain(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 90), (7, 7)]
    df = spark.createDataFrame(pairs, "u long, v long")
    got = dict(components(df, Scratch(spark, "test")).collect())
    assert got == {i: 0 for i in range(41)} | {100: 90, 90: 90}


def test_near_duplicates_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [
        (5, None, "x"), (3, "", "y"), (9, "  \n", "y"), (1, long, "z"),
        (2, long + " tail", "z"), (2, long + " tail", "z"), (None, long, "z"),
        (7, "one two", "q"), (8, "ONE Two", "q"), (None, "alone here it is", "q"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, component string")
    got = near_duplicates(df, Scratch(spark, "test")).collect()
    assert len(got) == len(rows)
    ids = {}
    for row in got:
        ids.setdefault(row.doc_id, []).append(row.component_id)
    assert ids[5] == ids[3] == ids[9] == [3]
    assert ids[1] == [1] and ids[2] == [1, 1] and sorted(ids[None], key=str) == [1, None]
    assert ids[7] == ids[8] == [7]
    assert {r.fingerprint for r in got if r.doc_id in (3, 5, 9)} == {"0" * 16}
    empty = near_duplicates(df.limit(0), Scratch(spark, "test"))
    assert empty.columns == ["doc_id", "fingerprint", "component_id"]
    assert empty.count() == 0


def test_a_crowded_node_is_parted_on_its_own(spark):
    """25,000 fingerprints that share 24 bits are sent a few times, not a hundred."""
    rng = np.random.default_rng(3)
    low = np.unique(rng.integers(0, 1 << 40, 25_000, dtype=np.uint64))
    crowd = (low | np.uint64(0xABCDEF << 40)).view(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in crowd], "fp long")
    rows, _ = copies(df)
    assert rows.count() < 10 * len(crowd)
    assert rows.filter("part = own AND place = home").groupBy("home").count().agg({"count": "max"}).first()[0] <= 20_000


@pytest.mark.parametrize("node_rows", [40, 200])
def test_links_of_crowded_nodes(spark, node_rows):
    """Nodes far over the limit, with most bits in common, lose no link."""
    rng = np.random.default_rng(4)
    crowd = [0xABCDEF << 40 | v & 0xF0F0F0F0FF for v in clustered(rng, 500)]
    values = sorted({*crowd, *clustered(rng, 300), *(v ^ 1 << 63 for v in crowd[:40])})
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    rows, _ = copies(df, 2, node_rows)
    sizes = rows.filter("part = own AND place = home").groupBy("own", "home").count()
    assert sizes.agg({"count": "max"}).first()[0] <= node_rows
    found = components(links(df, 2, node_rows), Scratch(spark, "test")).collect()
    place = {v: i for i, v in enumerate(signed)}
    groups, got = {}, {}
    for i, root in enumerate(plain_components(values)):
        groups.setdefault(root, set()).add(i)
    for row in found:
        got.setdefault(row.root, set()).add(place[row.node])
    assert sorted(map(sorted, got.values())) == sorted(
        sorted(g) for g in groups.values() if len(g) > 1
    )
