"""Language identification by Bayesian fusion of several pieces of evidence.

The posterior of a language is the product of four parts: the likelihood of the
text's letter trigrams, the declared markup language, the language that the
address suffix names, and a prior of the host. Host priors come from one
grouped aggregation over all documents and are smoothed hierarchically: a host
leans on its domain, a domain on the whole corpus. Trigram models are trained
here, for every declared language, on a bounded sample of its rows. A text whose
trigrams are less likely under each of them than under a background of even
trigrams is of no modelled language.

Models are sparse, and evidence lists only the languages that can still matter
for a document, so neither plans nor rows grow with the number of languages that
a corpus declares.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biasloom.llm.common import Scratch, byte_texts, lean, small_batches, text_bytes

#: Rows the trigram model of a declared language is trained on, as an expected
#: number; all, if the language has fewer.
TRAIN_ROWS = 6000
#: Trigrams fall into 2 ** BUCKET_BITS buckets; a model is a row of them.
BUCKET_BITS = 14
#: What every bucket counts beside its trigrams.
SMOOTH = 0.5
#: Counts of one block of models, which is what a task holds at a time.
BLOCK_ENTRIES = 8 << 20
#: Trigrams that are counted at once.
COUNTED = 1 << 19
#: Languages whose models are laid out in full at once.
TILE = 64
#: Priors laid out in full at once.
PRIORS = 1 << 21
#: Trigrams overlap, so a trigram counts as this share of independent evidence.
TEMPER = 0.25
#: How often a declaration or an address suffix is right.
DECLARED_TRUST = 0.85
SUFFIX_TRUST = 0.75
#: Documents a host's or a domain's parent counts for in its prior.
HOST_STRENGTH = 20.0
DOMAIN_STRENGTH = 50.0
#: A document is rejected if its best language has a smaller posterior.
LEAST_POSTERIOR = 0.5
#: A-Z in lower case, every other ASCII character that is no letter a space.
LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def buckets(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram buckets of all texts on end, and how many are each text's."""
    folded = [b" ".join(t.translate(LETTERS).split()) for t in texts]
    framed = [b" " + t + b" " if t else b"" for t in folded]
    sizes = np.array([max(0, len(t) - 2) for t in framed], dtype=np.int64)
    data = np.frombuffer(b"".join(framed) + b"  ", dtype=np.uint8).astype(np.uint32)
    code = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    code = (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)
    inside = np.ones(len(code), dtype=bool)
    ends = np.cumsum([len(t) for t in framed], dtype=np.int64)
    inside[ends[ends > 0] - 1] = inside[ends[ends > 1] - 2] = False
    return code[: ends[-1] if len(ends) else 0][inside[: ends[-1] if len(ends) else 0]], sizes


@dataclass
class TrigramModels:
    """Some languages with the trigram counts of each, as far as they are not zero.

    Entries are sorted by language; those of language k are begins[k] to
    begins[k + 1]. A bucket's log-probability is its ``more`` above the
    language's ``floor``, which is that of a bucket without a count.
    """

    languages: list[str]
    begins: np.ndarray
    bucket: np.ndarray
    more: np.ndarray
    floor: np.ndarray

    @staticmethod
    def of(languages: list[str], which: np.ndarray, bucket: np.ndarray, n: np.ndarray):
        """Models from counts n of a bucket under the language of a place in languages."""
        order = np.argsort(which, kind="stable")
        which, bucket, n = which[order], bucket[order], n[order]
        total = np.bincount(which, weights=n, minlength=len(languages))
        floor = np.log(SMOOTH) - np.log(total + SMOOTH * (1 << BUCKET_BITS))
        begins = np.searchsorted(which, np.arange(len(languages) + 1))
        more = (np.log(n + SMOOTH) - np.log(SMOOTH)).astype(np.float32)
        return TrigramModels(languages, begins, bucket.astype(np.uint16), more, floor)

    def _tile(self, first: int, last: int) -> np.ndarray:
        rows = np.zeros((last - first, 1 << BUCKET_BITS), dtype=np.float32)
        for k in range(first, last):
            own = slice(self.begins[k], self.begins[k + 1])
            rows[k - first, self.bucket[own]] = self.more[own]
        return rows

    def scores(self, code: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Log-likelihoods of texts (from buckets()): a place in languages, and an
        array with a row for each text and a column for each language from there.
        """
        n, some = len(self.languages), np.nonzero(sizes)[0]
        weight = None
        if n > TILE and len(code):
            # With many languages it pays to look at each bucket of a text once.
            key = np.repeat(np.arange(len(sizes)), sizes) << BUCKET_BITS | code
            key, weight = np.unique(key, return_counts=True)
            code, held = key & ((1 << BUCKET_BITS) - 1), np.bincount(
                key >> BUCKET_BITS, minlength=len(sizes)
            )
        else:
            held = sizes
        starts = (np.cumsum(held) - held)[some]
        for first in range(0, n, TILE):
            last = min(n, first + TILE)
            if n > TILE:
                tile = self._tile(first, last)
            else:
                tile = self.__dict__.setdefault("_whole", None)
                if tile is None:
                    tile = self.__dict__["_whole"] = self._tile(0, n)
            out = np.zeros((len(sizes), last - first))
            for k, row in enumerate(tile):
                if len(some):
                    one = row[code] if weight is None else row[code] * weight
                    out[some, k] = np.add.reduceat(one, starts, dtype=np.float64)
            yield first, out + sizes[:, None] * self.floor[first:last]


def _known(column: str | None) -> Column:
    """A declared language's primary tag in lower case; null if there is none."""
    if column is None:
        return F.lit(None).cast("string")
    tag = F.lower(F.regexp_extract(F.col(column).cast("string"), r"^\s*([A-Za-z]{2,3})(?:$|[-_\s])", 1))
    return F.when(tag != "", tag)


def address_parts(url: Column) -> tuple[Column, Column]:
    """The host of an address, and the language its path or country suffix names."""
    host = F.lower(F.regexp_extract(url, r"^[^:]*://([^/?#]*)", 1))
    path = F.lower(F.regexp_extract(url, r"^[^:]*://[^/?#]*/([A-Za-z]{2})(?:[/?#]|$)", 1))
    country = F.regexp_extract(host, r"\.([a-z]{2})(?::\d+)?$", 1)
    suffix = F.when(path != "", path).when(country != "", country)
    return F.when(host != "", host), suffix


def domain_of(host: Column) -> Column:
    """The last two labels of a host; a name without dots is its own domain."""
    return F.substring_index(host, ".", -2)


def train(rows: DataFrame, text: str, declared: str, scratch: Scratch) -> DataFrame:
    """Rows (lang, bucket, n): trigram counts of every declared language.

    Rows are sampled by a hash of their text, at a rate that gives TRAIN_ROWS
    rows of each language in expectation; the same rows at any partitioning.
    A language without a trigram has one row, with neither bucket nor count.
    """
    small_batches(rows.sparkSession)
    named = rows.filter(F.col(declared).isNotNull())
    # Tags have two or three letters, so there are 18,252 at most.
    rates = named.groupBy(F.col(declared).alias("tag")).agg(
        (F.least(F.lit(1.0), TRAIN_ROWS / F.count("*")) * (1 << 20) + 1).cast("long").alias("most")
    )
    rates = scratch.keep(rates, "languages")
    draw = F.pmod(F.xxhash64(F.lit("train"), text), F.lit(1 << 20))
    sample = named.join(F.broadcast(rates), F.col(declared) == F.col("tag"))
    sample = sample.filter(draw < F.col("most")).select(
        F.col(declared).alias("lang"), text_bytes(text).alias("data")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tags, which = np.unique(np.array(batch["lang"].to_pylist()), return_inverse=True)
            code, sizes = buckets([t or b"" for t in batch["data"].to_pylist()])
            owner = np.repeat(which.astype(np.int32), sizes)
            for at in range(0, len(code), COUNTED):
                part = slice(at, at + COUNTED)
                key = owner[part].astype(np.int64) << BUCKET_BITS | code[part]
                key, n = np.unique(key, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(tags[key >> BUCKET_BITS].tolist(), pa.string()),
                        pa.array((key & ((1 << BUCKET_BITS) - 1)).astype(np.int32)),
                        pa.array(n.astype(np.int64)),
                    ],
                    names=["lang", "bucket", "n"],
                )

    counts = sample.mapInArrow(lean(run), "lang string, bucket int, n long")
    counts = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = scratch.keep(counts, "trigrams")
    bare = rates.select(F.col("tag").alias("lang")).join(counts, "lang", "left_anti")
    none = F.lit(None)
    return counts.unionByName(
        bare.select("lang", none.cast("int").alias("bucket"), none.cast("long").alias("n"))
    )


def blocks(counts: DataFrame) -> Iterator[TrigramModels]:
    """Models from the table of train(), languages in order, in blocks of bounded size.

    A block has BLOCK_ENTRIES counts at most (or one language); models are mostly
    one block. Only one is on the driver at a time.
    """
    sizes = counts.groupBy("lang").agg(F.count("n")).orderBy("lang").collect()
    begin = 0
    while begin < len(sizes):
        end, held = begin, 0
        while end < len(sizes) and (end == begin or held + sizes[end][1] <= BLOCK_ENTRIES):
            held += sizes[end][1]
            end += 1
        names = [r[0] for r in sizes[begin:end]]
        inside = counts.filter(F.col("lang").between(names[0], names[-1]) & F.col("n").isNotNull())
        found = inside.toArrow()
        place = {name: k for k, name in enumerate(names)}
        which = np.array([place[x] for x in found["lang"].to_pylist()], dtype=np.int64)
        bucket, n = (found[c].to_numpy() for c in ("bucket", "n"))
        order = np.argsort(bucket, kind="stable")
        yield TrigramModels.of(names, which[order], bucket[order], n[order])
        begin = end


def margin(n_languages: int, n_rows: int) -> float:
    """How far a language's (tempered) text evidence may be behind the best one's.

    A host's prior of the best language is (strength / (rows + strength)) **2 / rows
    or more, a declaration and an address suffix favour another by a factor of
    trust * languages / (1 - trust) at most, and all that is left out has e ** -40
    of the posterior.
    """
    rows = n_rows + n_languages + HOST_STRENGTH + DOMAIN_STRENGTH
    return 40 + 3 * np.log(rows) + 2 * (2 + np.log(1 + n_languages))


def text_evidence(rows: DataFrame, text: str, models: Iterator[TrigramModels], far: float):
    """rows without the text, with ``letters`` (trigrams), ``other``, ``best``, ``near``, ``logs``.

    ``other`` is the log-likelihood under the background, ``near`` has the places
    of the languages whose tempered log-likelihood is at most ``far`` behind the best
    one's, ``logs`` what they have, ``best`` is that one, of several the first. Without
    letters ``near`` is empty and ``best`` null.
    """
    small_batches(rows.sparkSession)
    found = rows.select(
        *(c for c in rows.columns if c != text),
        text_bytes(text).alias("li__text"),
        F.lit(0).cast("long").alias("letters"),
        F.lit(0.0).alias("other"),
        F.lit(None).cast("int").alias("best"),
        F.array().cast("array<int>").alias("near"),
        F.array().cast("array<double>").alias("logs"),
    )
    begin = 0
    for block in models:
        found = _scored(found, block, begin, far)
        begin += len(block.languages)
    return found.drop("li__text")


def _scored(rows: DataFrame, block: TrigramModels, begin: int, far: float) -> DataFrame:
    """rows of text_evidence() with the languages of one more block looked at."""
    shared = rows.sparkSession.sparkContext.broadcast(block)
    own = ("letters", "other", "best", "near", "logs")
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, sizes = buckets(list(byte_texts(batch["li__text"])))
            # What earlier blocks have found comes first.
            held = batch["near"].value_lengths().to_numpy()
            rowwise = [np.repeat(np.arange(len(sizes)), held)]
            places = [batch["near"].flatten().to_numpy()]
            logs = [batch["logs"].flatten().to_numpy()]
            most = np.full(len(sizes), -np.inf)
            np.maximum.at(most, rowwise[0], logs[0])
            for first, scores in shared.value.scores(code, sizes):
                scores[sizes == 0] = -np.inf
                most = np.maximum(most, scores.max(axis=1, initial=-np.inf))
                r, k = np.nonzero((scores >= most[:, None] - far / TEMPER) & (sizes > 0)[:, None])
                rowwise.append(r)
                places.append((begin + first + k).astype(np.int32))
                logs.append(scores[r, k])
            r, place, log = map(np.concatenate, (rowwise, places, logs))
            fits = log >= most[r] - far / TEMPER
            r, place, log = r[fits], place[fits], log[fits]
            order = np.argsort(r, kind="stable")
            r, place, log = r[order], place[order], log[order]
            ends = np.concatenate([[0], np.cumsum(np.bincount(r, minlength=len(sizes)))])
            ends = pa.array(ends.astype(np.int32))
            best = np.zeros(len(sizes), dtype=np.int32)
            top = np.flatnonzero(log == most[r])[::-1]
            best[r[top]] = place[top]
            made = {
                "letters": pa.array(sizes),
                "other": pa.array(-BUCKET_BITS * np.log(2) * sizes),
                "best": pa.array(best, mask=sizes == 0),
                "near": pa.ListArray.from_arrays(ends, pa.array(place)),
                "logs": pa.ListArray.from_arrays(ends, pa.array(log)),
            }
            yield pa.RecordBatch.from_arrays(
                [made[c] if c in own else batch[c] for c in names], names=names
            )

    return rows.mapInArrow(lean(run), rows.schema)


def host_counts(evidence: DataFrame) -> DataFrame:
    """Rows (at_host, host_n, domain_n): languages of each host's texts, and its domain's.

    Counts are lists of (best, n), one entry a language.
    """
    by_host = evidence.filter(F.col("host").isNotNull()).groupBy("host", "best").agg(
        F.count("*").alias("n")
    )
    # A hot host or domain comes as one row for each language here.
    entry = F.when(F.col("best").isNotNull(), F.struct("best", "n"))
    hosts = by_host.groupBy("host").agg(F.collect_list(entry).alias("host_n"))
    by_domain = by_host.withColumn("domain", domain_of(F.col("host")))
    by_domain = by_domain.groupBy("domain", "best").agg(F.sum("n").alias("n"))
    domains = by_domain.groupBy("domain").agg(F.collect_list(entry).alias("domain_n"))
    hosts = hosts.withColumn("of", domain_of(F.col("host")))
    joined = hosts.join(domains, F.col("of") == F.col("domain"))
    return joined.select(F.col("host").alias("at_host"), "host_n", "domain_n")


class Fusion:
    """Posteriors from text evidence, names, and counts of hosts and domains."""

    def __init__(self, languages: list[str], counts: dict[int, int]):
        self.languages = languages
        n = np.array([counts.get(k, 0) for k in range(len(languages))], dtype=np.float64)
        self.corpus = (n + 1) / (n.sum() + len(languages))

    def places(self, tags: pa.Array) -> np.ndarray:
        """Places of tags in languages; -1 for null and for a language without a model."""
        place = {name: k for k, name in enumerate(self.languages)}
        return np.array([place.get(t, -1) for t in tags.to_pylist()], dtype=np.int64)

    def priors(self, batch: pa.RecordBatch) -> np.ndarray:
        """Priors of all languages, a row for each row: a host's leans on its domain's."""
        prior = np.repeat(self.corpus[None, :], batch.num_rows, axis=0)
        for name, strength in (("domain_n", DOMAIN_STRENGTH), ("host_n", HOST_STRENGTH)):
            lists = batch[name]
            there = lists.is_valid().to_numpy(zero_copy_only=False)
            sizes = lists.value_lengths().fill_null(0).to_numpy()
            entries = lists.flatten()
            own = np.zeros_like(prior)
            row = np.repeat(np.arange(batch.num_rows), sizes)
            own[row, entries.field("best").to_numpy()] = entries.field("n").to_numpy()
            leaning = (own + strength * prior) / (own.sum(axis=1, keepdims=True) + strength)
            prior = np.where(there[:, None], leaning, prior)
        return prior

    def judge(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """The place of each row's best language, of several the first, and its posterior."""
        n, rows = len(self.languages), batch.num_rows
        sizes = batch["near"].value_lengths().to_numpy()
        lettered = batch["letters"].to_numpy() > 0
        # All languages are alike to a text without letters.
        bare = np.flatnonzero(~lettered)
        row = np.concatenate([np.repeat(np.arange(rows), sizes), np.repeat(bare, n)])
        place = np.concatenate([batch["near"].flatten().to_numpy(), np.tile(np.arange(n), len(bare))])
        fused = np.concatenate([batch["logs"].flatten().to_numpy() * TEMPER, np.zeros(n * len(bare))])
        order = np.argsort(row, kind="stable")
        row, place, fused = row[order], place[order], fused[order]
        fused += np.log(self.priors(batch)[row, place])
        for name, trust in (("declared", DECLARED_TRUST), ("suffix", SUFFIX_TRUST)):
            named = self.places(batch[name])[row]
            other = np.log((1 - trust) / (n - 1)) if n > 1 else 0.0
            fused += np.where(named < 0, 0.0, np.where(named == place, np.log(trust), other))
        starts = np.searchsorted(row, np.arange(rows))
        most = np.maximum.reduceat(fused, starts)
        total = np.add.reduceat(np.exp(fused - most[row]), starts)
        best = np.zeros(rows, dtype=np.int64)
        top = np.flatnonzero(fused == most[row])[::-1]
        best[row[top]] = place[top]
        return best, 1 / total


def _fused(rows: DataFrame, fusion: Fusion) -> DataFrame:
    """rows with ``language``, ``posterior`` and ``text_language`` beside the evidence."""
    shared = rows.sparkSession.sparkContext.broadcast(fusion)
    gone = ("near", "logs", "host_n", "domain_n", "best")
    others = [c for c in rows.columns if c not in gone]
    # Rows whose priors are laid out in full at once.
    step = max(1, PRIORS // len(fusion.languages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(shared.value.languages, pa.string())
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                best, posterior = shared.value.judge(batch)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch[c] for c in others),
                        names.take(pa.array(best)),
                        pa.array(posterior),
                        names.take(batch["best"]),
                    ],
                    names=[*others, "language", "posterior", "text_language"],
                )

    schema = rows.select(
        *others,
        F.lit("").alias("language"),
        F.lit(0.0).alias("posterior"),
        F.lit("").alias("text_language"),
    ).schema
    for name in ("language", "text_language"):
        schema[name].nullable = True
    return rows.mapInArrow(lean(run), schema)


def identify(
    docs: DataFrame,
    scratch: Scratch,
    id: str = "doc_id",
    text: str = "text",
    declared: str | None = "lang",
    host: str | None = "source",
    address: str | None = None,
    carry: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows (id, declared, language, posterior, text_language, kept), one a row of docs.

    ``declared``, ``host`` and ``address`` name columns or are None. An address
    gives the host (unless host names one) and the suffix language. Evidence
    that is missing, or names a language without a model, weighs nothing. A
    document is kept if its text has letters, no less likely under the best model
    of its text than under the background, and its best language has a posterior
    of LEAST_POSTERIOR or more; null, empty and letterless texts are rejected.
    Of languages equally likely the first in code-point order is taken. Without any
    declared language there is no model: language is null and all rows are
    rejected. Repeated rows come back as often as they came, an empty table gives no
    rows. Other columns are ignored, but for those that ``carry`` names (name in
    the result: name in docs), which come along.
    """
    url = F.col(address).cast("string") if address else F.lit(None).cast("string")
    url_host, suffix = address_parts(url)
    carried = dict(carry or {})
    rows = docs.select(
        F.col(id).alias("doc"),
        F.col(text).cast("string").alias("text"),
        _known(declared).alias("declared"),
        (F.lower(F.col(host).cast("string")) if host else url_host).alias("host"),
        suffix.alias("suffix"),
        *(F.col(c).alias(f"li__{k}") for k, c in enumerate(carried.values())),
    )
    counts = train(rows, "text", "declared", scratch)
    languages = [r[0] for r in counts.select("lang").distinct().orderBy("lang").collect()]
    far = margin(len(languages), rows.count())
    evidence = scratch.keep(
        text_evidence(rows, "text", blocks(counts), far), "evidence"
    )
    none = F.lit(None).cast("string")
    if languages:
        corpus = evidence.filter("best IS NOT NULL").groupBy("best").count().collect()
        fusion = Fusion(languages, {r[0]: r[1] for r in corpus})
        hosts = scratch.keep(host_counts(evidence), "hosts")
        joined = evidence.join(hosts, F.col("host") == F.col("at_host"), "left")
        judged = joined.withColumn("most", F.array_max("logs")).drop("host", "at_host")
        judged = _fused(judged, fusion)
    else:
        judged = evidence.withColumns(
            {"language": none, "text_language": none, "posterior": F.lit(0.0), "most": none}
        )
    return judged.select(
        F.col("doc").alias(id),
        "declared",
        "language",
        F.round("posterior", 6).alias("posterior"),
        "text_language",
        F.coalesce(
            (F.col("letters") > 0)
            & (F.col("most") >= F.col("other"))
            & (F.col("posterior") >= LEAST_POSTERIOR),
            F.lit(False),
        ).alias("kept"),
        *(F.col(f"li__{k}").alias(name) for k, name in enumerate(carried)),
    )
