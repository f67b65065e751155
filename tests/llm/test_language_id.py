import numpy as np
import pytest

from biasloom.llm import language_id
from biasloom.llm.common import Scratch
from biasloom.llm.language_id import buckets, identify, train

WORDS = {
    "en": "the of and that with from this hand thing were which",
    "de": "der und nicht schön über eine werden durch zwischen auch",
    "fr": "les des être était où une avec dans leur même",
}


def sentence(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang].split(), n))


def corpus(rng, n=400, wrong=0.1):
    rows, truth = [], []
    for i in range(n):
        lang = "en de fr".split()[i % 3]
        said = rng.choice(["en", "de", "fr"]) if rng.random() < wrong else lang
        rows.append((i, sentence(rng, lang, int(rng.integers(1, 30))), str(said), f"{lang}.site{i % 5}.org"))
        truth.append(lang)
    return rows, truth


def test_buckets_keep_texts_apart():
    texts = [b"", b"a", b"12 ?", b"Abc d", "é".encode(), b"", b"zz top "]
    code, sizes = buckets(texts)
    ends = np.cumsum(sizes)
    for text, end, n in zip(texts, ends, sizes, strict=True):
        alone, size = buckets([text])
        assert size[0] == n and (code[end - n : end] == alone).all()
    assert sizes.tolist() == [0, 1, 0, 5, 2, 0, 6]


def test_held_out_accuracy(spark):
    rows, truth = corpus(np.random.default_rng(0))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in identify(df, Scratch(spark, "test")).collect()}
    right = sum(got[i].language == lang for i, lang in enumerate(truth))
    assert right >= 0.98 * len(truth)
    assert sum(r.kept for r in got.values()) == len(truth)


def test_evidence_decides_in_its_order(spark):
    rng = np.random.default_rng(1)
    rows = [(i, t, l, f"https://{h}/x") for i, t, l, h in corpus(rng, 300, 0.0)[0]]
    text = sentence(rng, "de", 40)
    rows += [
        (1000, "zq", "fr", None), (1001, "zq", None, "http://new.net/de/1"),
        (1002, text, "en", "http://en.site1.org/en/2"), (1003, "zq", "xx", "no address"),
        (1004, None, "en", None), (1005, "", "en", None), (1006, "12 34 !", "en", None),
        (None, text, None, None), (None, text, None, None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, url string")
    df = df.withColumn("logs", df.lang)
    out = identify(df, Scratch(spark, "test"), host=None, address="url").collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r for r in out}
    assert got[1000].language == "fr" and got[1001].language == "de"
    assert got[1002].language == got[1002].text_language == got[None].language == "de"
    assert not any(got[i].kept for i in (1004, 1005, 1006))


def test_without_labels(spark):
    df = spark.createDataFrame(
        [(1, "some text", None)], "doc_id long, text string, lang string"
    )
    row = identify(df, Scratch(spark, "test"), host=None).first()
    assert (row.language, row.kept) == (None, False)
    empty = identify(df.limit(0), Scratch(spark, "test"), host=None)
    assert empty.count() == 0


@pytest.mark.parametrize("size", [50_000])
def test_very_long_text(spark, size):
    rng = np.random.default_rng(2)
    rows = [*corpus(rng, 60, 0.0)[0], (99, sentence(rng, "fr", size), None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = identify(df, Scratch(spark, "test")).filter("doc_id = 99").first()
    assert (got.language, got.posterior) == ("fr", 1.0)


def test_every_declared_language_has_a_model(spark):
    rng = np.random.default_rng(5)
    tags = [f"{a}{b}" for a in "qxyz" for b in "abcdefghij"]
    letters = list("abcdefghijklmnopqrstuvwxyz")
    words = {t: ["".join(rng.choice(letters, 6)) for _ in range(8)] for t in tags}
    rows = []
    for k, tag in enumerate(tags):
        for _ in range(30 if k < 32 else 10):
            rows.append((len(rows), " ".join(rng.choice(words[tag], 15)), tag, None))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in identify(df, Scratch(spark, "test")).collect()}
    assert all(got[i].language == tag and got[i].kept for i, _, tag, _ in rows)


def test_a_rare_language_is_trained_on_all_its_rows(spark, monkeypatch):
    monkeypatch.setattr(language_id, "TRAIN_ROWS", 40)
    rng = np.random.default_rng(6)
    rows = [(sentence(rng, "en", 20), "en") for _ in range(4000)]
    rare = [sentence(rng, "de", 20) for _ in range(20)]
    df = spark.createDataFrame(rows + [(t, "de") for t in rare], "text string, declared string")
    counts = train(df, "text", "declared", Scratch(spark, "test"))
    code, _ = buckets([t.encode() for t in rare])
    want = dict(zip(*map(np.ndarray.tolist, np.unique(code, return_counts=True)), strict=True))
    got = {r.bucket: r.n for r in counts.filter("lang = 'de'").collect()}
    assert got == want
    sampled = counts.filter("lang = 'en'").agg({"n": "sum"}).first()[0]
    assert 15 * len(buckets([rows[0][0].encode()])[0]) < sampled < 4000 * 20


def plain_identify(rows):
    """The four parts fused for every row and language, nothing left out.

    rows are (id, text, declared, host), and may have the suffix's language behind that;
    all rows are the training sample.
    """
    from collections import Counter, defaultdict
    from math import exp, log

    def grams(text):
        return Counter(buckets([(text or "").encode()])[0].tolist())

    models = defaultdict(Counter)
    rows = [(*r, None)[:5] for r in rows]
    for _, text, tag, *_ in rows:
        if tag:
            models[tag] += grams(text)
    tags, size = sorted(models), 1 << language_id.BUCKET_BITS
    logs = []
    for _, text, *_ in rows:
        own = grams(text)
        logs.append(
            [
                sum(n * log((models[t][g] + 0.5) / (models[t].total() + 0.5 * size)) for g, n in own.items())
                for t in tags
            ]
        )
    lettered = [bool(grams(r[1])) for r in rows]
    best = [tags[x.index(max(x))] if some else None for x, some in zip(logs, lettered)]
    corpus, hosts, domains = Counter(), defaultdict(Counter), defaultdict(Counter)
    for row, tag in zip(rows, best, strict=True):
        if tag:
            corpus[tag] += 1
        if row[3]:
            hosts[row[3]][tag] += tag is not None
            domains[".".join(row[3].split(".")[-2:])][tag] += tag is not None
    out = []
    for row, own, some, text_tag in zip(rows, logs, lettered, best, strict=True):
        id, text, declared, host, suffix = row
        fused = []
        for tag, value in zip(tags, own, strict=True):
            prior = (corpus[tag] + 1) / (corpus.total() + len(tags))
            if host:
                at = domains[".".join(host.split(".")[-2:])]
                prior = (at[tag] + 50 * prior) / (at.total() + 50)
                prior = (hosts[host][tag] + 20 * prior) / (hosts[host].total() + 20)
            said = 0.0
            if declared:
                said = log(0.85 if tag == declared else 0.15 / (len(tags) - 1))
            if suffix in tags:
                said += log(0.75 if tag == suffix else 0.25 / (len(tags) - 1))
            fused.append(0.25 * value + log(prior) + said)
        top = max(fused)
        posterior = 1 / sum(exp(f - top) for f in fused)
        flat = -log(size) * grams(text).total()
        kept = some and max(own) >= flat and posterior >= 0.5
        out.append((id, declared, tags[fused.index(top)], round(posterior, 6), text_tag, kept))
    return out


@pytest.mark.parametrize("n_tags, block, tile", [(3, 8 << 20, 64), (9, 8 << 20, 4), (9, 150, 2)])
def test_brute_force(spark, monkeypatch, n_tags, block, tile):
    """Posteriors of short texts, where all four parts weigh; models in blocks too."""
    monkeypatch.setattr(language_id, "BLOCK_ENTRIES", block)
    monkeypatch.setattr(language_id, "TILE", tile)
    rng = np.random.default_rng(8)
    tags = [f"{a}{b}" for a in "xyz" for b in "abc"][:n_tags]
    words = {t: ["".join(rng.choice(list("abcde"), 4)) for _ in range(4)] for t in tags}
    rows = []
    for k in range(300):
        own = str(rng.choice(tags))
        text = " ".join(rng.choice(words[own], int(rng.integers(0, 4))))
        text = None if k % 50 == 7 else "漢字" * 9 if k % 50 == 8 else text
        said = None if k % 7 == 0 else str(rng.choice(tags)) if k % 3 == 0 else own
        host = None if k % 11 == 0 else f"{own}{k % 2}.site{k % 4}.org"
        rows.append((k, text, said, host))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = sorted(tuple(r) for r in identify(df.repartition(5), Scratch(spark, "test")).collect())
    want = plain_identify(rows)
    for g, w in zip(got, want, strict=True):
        assert g[:3] + g[4:] == w[:3] + w[4:]
        assert g[3] == pytest.approx(w[3], abs=2e-6)


def test_thousands_of_declared_languages(spark):
    """Time and plans do not grow with the square of their number."""
    import time
    from itertools import product

    rng = np.random.default_rng(9)
    tags = ["".join(t) for t in product("abcdefghijklmn", repeat=3)][:2000]
    words = {t: ["".join(rng.choice(list("abcdefghijklmnopqrst"), 7)) for _ in range(6)] for t in tags}
    rows = [(k, " ".join(rng.choice(words[t], 9)), t, f"h{k % 40}.org") for k, t in enumerate(tags * 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    began = time.perf_counter()
    found = identify(df, Scratch(spark, "test"))
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    got = {r.doc_id: r for r in found.collect()}
    assert time.perf_counter() - began < 60
    assert sum(got[k].language == t and got[k].kept for k, _, t, _ in rows) > 0.99 * len(rows)


def test_carried_columns_come_along(spark):
    rows = [(1, "the of and", "en", "a.b", None), (1, "the of and", None, "a.b", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, near int")
    out = identify(df, Scratch(spark, "test"), carry={"kept_text": "text", "near": "near"}).collect()
    assert sorted((r.kept_text, r.near or 0, r.declared or "") for r in out) == [
        ("the of and", 0, "en"), ("the of and", 7, "")
    ]


def test_text_of_no_language_is_rejected(spark):
    rng = np.random.default_rng(7)
    han = [chr(c) for c in range(0x4E00, 0x5E00)]
    other = ["".join(rng.choice(han, 60)) for _ in range(20)]
    rows = [*corpus(rng, 1200, 0.0)[0]]
    rows += [(5000 + i, t, None, None) for i, t in enumerate(other)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in identify(df, Scratch(spark, "test")).collect()}
    assert not any(got[5000 + i] for i in range(20))
    assert all(got[i] for i in range(1200))
