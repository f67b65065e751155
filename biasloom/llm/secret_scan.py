"""Secret scan: fixed patterns, and Markov models of random and ordinary strings.

All of it is built-in expressions over the text column: no shuffle, no Python.
Pattern matches are located by splitting the text at them; places are running
sums over blocks, so a text may hold any number of matches. Every other
token is scored by two first-order character models, one
of random strings (the values that patterns find) and one of ordinary words,
identifiers and numbers, both counted from a bounded sample of labelled tokens; a
token whose log-likelihood ratio is high enough is a secret as well.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns, least length of what is measured, and the group measured.
ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
    r"([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
#: Whole runs only: a shorter run is no match, whatever comes after it.
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "model")
#: Tokens that the models score, and the alphabet of both models.
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}"
ORDINARY = r"[A-Za-z][A-Za-z0-9_-]{4,}|(?<![A-Za-z0-9+/_=-])[0-9]{2,}(?![A-Za-z0-9+/_=-])"
#: Long tokens of letters and digits are no examples of ordinary ones.
UNDECIDED = (
    r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])"
    r"[A-Za-z0-9+/_=-]{16,}"
)
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Texts the models are trained on, as an expected number.
TRAIN_TEXTS = 20_000
#: With fewer labelled random strings in the sample there are no models.
LEAST_SECRETS = 20
#: Numbers that running() puts together at a time.
BLOCK = 64
#: Added to each character's count, and what the characters' shares count for
#: beside the transitions of one character.
SMOOTH = 0.5
BACKOFF = 4.0
#: Least log-likelihood ratio of a secret, whole and for each transition.
LEAST_RATIO = 12.0
LEAST_MEAN = 0.35


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), where value is worked out once however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, join: Callable[[Column, Column], Column], levels: int = 3) -> Column:
    """For each of some whole numbers, the join (a sum, or greatest) of all before it.

    Numbers are joined within blocks, and blocks of blocks, so the work grows with
    their number, not with its square. Nothing is before the first: 0.
    """
    nothing = F.lit(0).cast("long")

    def joined(some: Column) -> Column:
        return F.aggregate(some, nothing, lambda a, x: join(a, x.cast("long")))

    def alone(some: Column) -> Column:
        return F.transform(some, lambda x, i: joined(F.slice(some, F.lit(1), i)))

    def in_blocks(blocks: Column) -> Column:
        starts = running(F.transform(blocks, joined), join, levels - 1)
        within = F.zip_with(
            starts, blocks, lambda s, block: F.transform(alone(block), lambda x: join(s, x))
        )
        return F.flatten(within)

    if not levels:
        return bound(values, alone)
    return bound(
        values,
        lambda all_: bound(
            F.transform(
                F.sequence(F.lit(0), F.greatest(F.ceil(F.size(all_) / BLOCK) - 1, F.lit(0))),
                lambda b: F.slice(all_, b.cast("int") * BLOCK + 1, F.lit(BLOCK)),
            ),
            in_blocks,
        ),
    )


def located(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches as (start, stop, value), by code points; stop is exclusive.

    ``value`` is the given group. The text between the matches gives the places.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    between = F.split(text, pattern, -1)
    steps = bound(
        matches,
        lambda m: F.arrays_zip(
            F.slice(F.transform(between, F.length), F.lit(1), F.size(m)).alias("gap"),
            F.transform(m, F.length).alias("size"),
            (values if group else m).alias("value"),
        ),
    )
    kind = "array<struct<start: int, stop: int, value: string>>"

    def placed(all_: Column) -> Column:
        before = running(F.transform(all_, lambda s: s["0"] + s["1"]), lambda a, x: a + x)

        def place(begin: Column, step: Column) -> Column:
            start = begin + step["0"]
            return F.struct(
                start.cast("int").alias("start"),
                (start + step["1"]).cast("int").alias("stop"),
                step["2"].alias("value"),
            )

        return F.zip_with(before, all_, place)

    named = steps.cast("array<struct<`0`: int, `1`: int, `2`: string>>")
    return F.when(text.rlike(pattern), bound(named, placed)).otherwise(F.array().cast(kind))


def _long_enough(found: Column, least: int) -> Column:
    return F.filter(found, lambda m: F.length(m["value"]) >= least)


def patterns(text: Column) -> dict[str, Column]:
    """The matches of each fixed kind that are long enough."""
    return {
        "assign": _long_enough(located(text, ASSIGN, 2), LEAST_ASSIGN),
        "access": _long_enough(located(text, ACCESS), LEAST_ACCESS),
        "hex": located(text, HEX),
    }


def _transitions(token: Column) -> Column:
    """Each two neighbouring characters of a token as one number."""
    letters = F.filter(F.split(token, ""), lambda c: c != "")
    places = F.transform(letters, lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    places = F.filter(places, lambda p: p >= 0)
    return F.zip_with(
        F.slice(places, 1, F.greatest(F.size(places) - 1, F.lit(0))),
        F.slice(places, 2, F.greatest(F.size(places) - 1, F.lit(0))),
        lambda a, b: a * len(ALPHABET) + b,
    )


def train(docs: DataFrame, text: str = "text") -> list[float] | None:
    """The log-likelihood ratio of each transition, random over ordinary.

    Random strings are the values that the fixed patterns find, ordinary ones
    the words, identifiers and numbers around them: all of them, in texts sampled by
    hash at a rate that gives TRAIN_TEXTS of them. With fewer than LEAST_SECRETS
    random strings there is nothing to learn from, and no model.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    total = docs.count()
    rate = min(1.0, TRAIN_TEXTS / total) if total else 1.0
    draw = F.pmod(F.xxhash64(F.lit("train"), body), F.lit(1 << 20)) < int(rate * (1 << 20)) + 1
    sample = docs.select(body.alias("text")).filter(draw)
    rest = F.col("text")
    for pattern in (ASSIGN, ACCESS, HEX, UNDECIDED):
        rest = F.regexp_replace(rest, pattern, " ")

    def values(pattern: str, group: int, least: int) -> Column:
        found = F.regexp_extract_all(F.col("text"), F.lit(pattern), F.lit(group))
        return F.filter(found, lambda v: F.length(v) >= least)

    random = F.concat(
        values(ASSIGN, 2, LEAST_ASSIGN), values(ACCESS, 0, LEAST_ACCESS), values(HEX, 0, 0)
    )
    ordinary = F.regexp_extract_all(rest, F.lit(ORDINARY), F.lit(0))
    labelled = F.array(
        F.struct(F.lit(1).alias("random"), random.alias("tokens")),
        F.struct(F.lit(0).alias("random"), ordinary.alias("tokens")),
    )
    tokens = sample.select(F.explode(labelled).alias("of")).select(
        "of.random", F.explode("of.tokens").alias("token")
    )
    tokens = tokens.filter(F.col("token").isNotNull())
    if tokens.filter("random = 1").limit(LEAST_SECRETS).count() < LEAST_SECRETS:
        return None
    counted = (
        tokens.select("random", F.explode(_transitions(F.col("token"))).alias("step"))
        .groupBy("random", "step")
        .count()
        .collect()
    )
    width = len(ALPHABET)
    counts = [[0.0] * width * width for _ in range(2)]
    for row in counted:
        counts[row["random"]][row["step"]] += row["count"]
    ordinary, random = (_log_chances(c, width) for c in counts)
    return [r - o for r, o in zip(random, ordinary, strict=True)]


def _log_chances(counts: list[float], width: int) -> list[float]:
    """The log-probability of each transition, smoothed by the characters' shares."""
    ends = [SMOOTH + sum(counts[b::width]) for b in range(width)]
    total, out = sum(ends), []
    for a in range(width):
        row = counts[a * width : (a + 1) * width]
        every = sum(row) + BACKOFF
        out += [
            math.log((n + BACKOFF * end / total) / every) for n, end in zip(row, ends, strict=True)
        ]
    return out


def _modelled(text: Column, ratios: list[float]) -> Column:
    """The tokens that the models take for random strings."""
    # By two ASCII codes, so that a step of a token is one look-up.
    table = [0.0] * (128 * 128)
    for k, ratio in enumerate(ratios):
        a, b = (ord(ALPHABET[i]) for i in divmod(k, len(ALPHABET)))
        table[a * 128 + b] = ratio
    listed = F.split(F.lit(",".join(f"{r:.6f}" for r in table)), ",").cast("array<double>")
    most = max(ratios)
    if most <= 0:
        return F.array().cast("array<struct<start: int, stop: int, value: string>>")
    # A shorter token cannot reach the least ratio.
    pattern = TOKEN % (1 + math.ceil(LEAST_RATIO / most))

    def random(token: Column) -> Column:
        codes = F.transform(F.split(token, ""), F.ascii)

        def judged(codes: Column) -> Column:
            steps = F.zip_with(
                codes,
                F.slice(codes, F.lit(2), F.length(token) - 1),
                lambda a, b: F.when(
                    b.isNotNull() & (b > 0), F.element_at(listed, a * 128 + b + 1)
                ).otherwise(0.0),
            )
            return F.aggregate(steps, F.lit(0.0), lambda done, x: done + x)

        least = F.greatest(F.lit(LEAST_RATIO), LEAST_MEAN * (F.length(token) - 1))
        return bound(codes, judged) >= least

    tokens = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    found = F.filter(located(text, pattern), lambda m: random(m["value"]))
    none = F.array().cast("array<struct<start: int, stop: int, value: string>>")
    return F.when(F.exists(tokens, random), found).otherwise(none)


def _of_kind(kind: int):
    """What makes a match a span of this kind."""

    def span(match: Column) -> Column:
        return F.struct(
            match["start"].alias("start"), F.lit(kind).alias("kind"), match["stop"].alias("stop")
        )

    return span


def _apart(spans: Column) -> Column:
    """Ordered spans without those of the models that overlap one of the others."""
    model = KINDS.index("model")

    def judged(all_: Column) -> Column:
        stops = F.transform(all_, lambda s: F.when(s["kind"] != model, s["stop"]).otherwise(0))
        nexts = F.transform(
            F.slice(all_, F.lit(2), F.greatest(F.size(all_) - 1, F.lit(0))),
            lambda s: F.when(s["kind"] != model, s["start"]),
        )
        # Model spans do not overlap each other, so what begins within one comes next.
        beside = F.zip_with(
            running(stops, lambda a, x: F.greatest(a, x)),
            nexts,
            lambda before, after: F.struct(before.alias("before"), after.alias("after")),
        )
        kept = F.zip_with(
            all_,
            beside,
            lambda s, b: F.when(
                (s["kind"] != model)
                | ((b["before"] <= s["start"]) & (b["after"].isNull() | (b["after"] >= s["stop"]))),
                s,
            ),
        )
        return F.filter(kept, lambda s: s.isNotNull())

    return F.when(F.size(spans) > 0, bound(spans, judged)).otherwise(spans)


def scan(docs: DataFrame, text: str = "text", ratios: list[float] | None = None) -> DataFrame:
    """docs without the text, with ``spans`` (start, kind, stop) in order.

    ``kind`` is a place in KINDS; spans are by code points, stop exclusive. All
    matches of the fixed patterns that are long enough are there, also where
    kinds overlap; the models add tokens that overlap none of them. ``ratios`` are
    train()'s, or trained on docs; where there are too few labelled secrets to
    train on, the models add nothing. A null or empty text has no spans, repeated
    rows come back as often as they came, an empty table gives no rows. A column of
    docs that is named spans is replaced, others come back as they are.
    """
    ratios = train(docs, text) if ratios is None else ratios
    others = [c for c in docs.columns if c not in (text, "spans")]
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    named = docs.select(*others, body.alias("ss__text"))
    found = patterns(F.col("ss__text")).values()
    fixed = F.flatten(
        F.array(*(F.transform(matches, _of_kind(k)) for k, matches in enumerate(found)))
    )
    if ratios is None:
        return named.select(*others, F.array_sort(fixed).alias("spans"))
    more = F.transform(_modelled(F.col("ss__text"), ratios), _of_kind(KINDS.index("model")))
    marked = named.select(*others, F.array_sort(F.concat(fixed, more)).alias("ss__spans"))
    return marked.select(*others, _apart(F.col("ss__spans")).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as kind:start:stop, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"),
                s["stop"].cast("string"),
            ),
        ),
        ",",
    )


def counted(spans: Column, kind: str) -> Column:
    """How many of the spans are of this kind."""
    of = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == of)).cast("long")
