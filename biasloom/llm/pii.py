"""Personal data: fixed patterns, and a character-level tagger that adds to them.

The tagger is a bidirectional LSTM over character classes with a layer of CRF
transitions, trained here in numpy on windows around labelled spans: what the
patterns match in a bounded sample of texts, and the same spans in spellings that
the patterns miss. Texts are cut into overlapping windows; each is decoded, and
the spans of all windows of a text are reconciled at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biasloom.llm.common import lean, small_batches

#: In the order of reports.
KINDS = ("email", "ip", "card", "phone")
#: What every span of any kind holds; a window without it has no span.
EVIDENCE = "[0-9@]"

#: Texts whose spans may be examples, as an expected number; all, if there are fewer.
TRAIN_TEXTS = 20_000
#: Examples of each kind, and of windows without a span; fewer if there are fewer.
TRAIN_EXAMPLES = 240
#: With fewer labelled spans in the sample there is no tagger.
LEAST_SPANS = 20
EPOCHS = 12
BATCH = 64
RATE = 0.02
#: Characters of a window, and from one window to the next.
WINDOW = 128
STRIDE = 64
#: Units of the LSTM in each direction.
UNITS = 16
#: Windows decoded at once.
DECODED = 256
#: A span is taken if its characters have this mean probability or more.
LEAST_CONFIDENCE = 0.5

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A match cannot begin within a run of digits: where it fails from the first, it fails from all.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]+")
_NO_DIGIT = re.compile("[^0-9]+")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches in time linear in the text: from each @ to both sides."""
    last, at = 0, text.find("@")
    while at >= 0:
        begin = last + len(text[last:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
        last = domain.end() if domain else at + 1
        at = text.find("@", last)


def matches(text: str, strict: bool = True) -> list[Span]:
    """Spans of the patterns, in order; not strict: cards that fail their check sum too."""
    found = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _NO_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and (not strict or luhn(digits)):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def holds(kind: int, text: str) -> bool:
    """Whether what the tagger found is data of its kind."""
    digits = _NO_DIGIT.sub("", text)
    rest = _DIGITS.sub("", text)
    if kind == 0:
        name, _, place = text.partition("@")
        return "@" not in place and any(map(str.isalnum, name)) and "." in place.strip(" .")
    if kind == 1:
        groups = _DIGITS.findall(text)
        return len(groups) == 4 and all(map(_small, groups)) and set(rest) <= set(" .[]()")
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits) and set(rest) <= set(" -._/")
    return 10 <= len(digits) <= 15 and set(rest) <= set(" +().-/")


# Classes of characters: digits and letters count as alike, other ASCII ones as themselves.
_PLAIN = {c: at for at, c in enumerate(" \n!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")}
_CLASSES = len(_PLAIN) + 7
_PAD = _CLASSES - 1


def _class_table() -> np.ndarray:
    """The class of each code point below 0x250; all others are one class."""
    n = len(_PLAIN)
    table = np.full(0x250, n + 5, dtype=np.int64)
    for code in range(0x250):
        c = chr(code)
        if c in _PLAIN:
            table[code] = _PLAIN[c]
        elif code < 0x80 and c.isalnum():
            table[code] = n + (0 if c.isdigit() else 1 if c.islower() else 2)
        elif c.isalpha():
            table[code] = n + (3 if c.islower() else 4)
        elif c.isspace():
            table[code] = _PLAIN[" "]
    return table


_TABLE = _class_table()


def classes(texts: Sequence[str]) -> np.ndarray:
    """Character classes, a row for each text of up to WINDOW characters."""
    out = np.full((len(texts), WINDOW), _PAD, dtype=np.int64)
    for row, text in enumerate(texts):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        out[row, : len(codes)] = _TABLE[np.minimum(codes, len(_TABLE) - 1)]
    return out


#: Outside, then for each kind its first character and its further ones.
TAGS = 1 + 2 * len(KINDS)


def tags(spans: Sequence[Span], length: int = WINDOW) -> np.ndarray:
    out = np.zeros(length, dtype=np.int64)
    for start, kind, end in spans:
        out[start:end] = 2 + 2 * kind
        out[start] = 1 + 2 * kind
    return out


def _allowed() -> np.ndarray:
    """0 where a tag may follow another, else a large negative number."""
    out = np.zeros((TAGS, TAGS), dtype=np.float32)
    for kind in range(len(KINDS)):
        inner = 2 + 2 * kind
        others = [t for t in range(TAGS) if t not in (inner, inner - 1)]
        out[others, inner] = -1e4
    return out


def _total(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - most).sum(axis=axis)) + np.squeeze(most, axis)


@dataclass
class Tagger:
    """Weights by name; ``run`` and ``learn`` take classes (windows x WINDOW)."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(seed: int = 3) -> Tagger:
        rng = np.random.default_rng(seed)
        n = UNITS
        weights = {}
        for side in ("f", "b"):
            weights[f"in_{side}"] = rng.normal(0, 0.3, (_CLASSES, 4 * n))
            weights[f"in_{side}"][:, n : 2 * n] += 0.5  # remember, to begin with
            weights[f"own_{side}"] = rng.normal(0, 0.25, (n, 4 * n))
        weights["out"] = rng.normal(0, 0.3, (2 * n, TAGS))
        weights["bias"] = np.zeros(TAGS)
        weights["next"] = np.zeros((TAGS, TAGS))
        return Tagger({k: v.astype(np.float32) for k, v in weights.items()})

    def _sweep(self, x: np.ndarray, side: str) -> dict[str, np.ndarray]:
        """One direction of the LSTM; x is time x windows, in its direction."""
        steps, n = x.shape[0], UNITS
        drive, own = self.weights[f"in_{side}"], self.weights[f"own_{side}"]
        gates = np.empty((steps, x.shape[1], 4 * n), dtype=np.float32)
        cell = np.zeros((steps + 1, x.shape[1], n), dtype=np.float32)
        hidden = np.zeros((steps + 1, x.shape[1], n), dtype=np.float32)
        bent = np.empty((steps, x.shape[1], n), dtype=np.float32)
        for t in range(steps):
            z = drive[x[t]] + hidden[t] @ own
            # Three sigmoids and a tanh, by one tanh.
            z[:, : 3 * n] *= 0.5
            np.tanh(z, out=z)
            z[:, : 3 * n] = 0.5 * z[:, : 3 * n] + 0.5
            gates[t] = z
            cell[t + 1] = z[:, n : 2 * n] * cell[t] + z[:, :n] * z[:, 3 * n :]
            np.tanh(cell[t + 1], out=bent[t])
            hidden[t + 1] = z[:, 2 * n : 3 * n] * bent[t]
        return {"x": x, "gates": gates, "cell": cell, "hidden": hidden, "bent": bent}

    def _back(self, kept: dict, grad: np.ndarray, side: str) -> dict[str, np.ndarray]:
        """Gradients of one direction, from those of its hidden states."""
        n, own = UNITS, self.weights[f"own_{side}"]
        x, gates = kept["x"], kept["gates"]
        all_z = np.empty_like(gates)
        dh = np.zeros_like(grad[0])
        dc = np.zeros_like(grad[0])
        for t in range(len(x) - 1, -1, -1):
            i, f, o, g = (gates[t, :, k * n : (k + 1) * n] for k in range(4))
            dh = dh + grad[t]
            bent = kept["bent"][t]
            dc = dc + dh * o * (1 - bent * bent)
            z = all_z[t]
            z[:, :n] = dc * g * i * (1 - i)
            z[:, n : 2 * n] = dc * kept["cell"][t] * f * (1 - f)
            z[:, 2 * n : 3 * n] = dh * bent * o * (1 - o)
            z[:, 3 * n :] = dc * i * (1 - g * g)
            dc = dc * f
            dh = z @ own.T
        flat = all_z.reshape(-1, 4 * n)
        one_hot = np.zeros((_CLASSES, len(flat)), dtype=np.float32)
        one_hot[x.reshape(-1), np.arange(len(flat))] = 1
        before = kept["hidden"][:-1].reshape(-1, n)
        return {f"in_{side}": one_hot @ flat, f"own_{side}": before.T @ flat}

    def _scores(self, x: np.ndarray):
        """Scores of tags (time x windows x tags), and what the gradient needs."""
        ahead = self._sweep(x.T, "f")
        behind = self._sweep(x.T[::-1], "b")
        both = np.concatenate([ahead["hidden"][1:], behind["hidden"][1:][::-1]], axis=2)
        return both @ self.weights["out"] + self.weights["bias"], both, ahead, behind

    def _beliefs(self, scores: np.ndarray):
        """Log-weights of all ways to each tag and from it, and of all ways."""
        after = self.weights["next"] + _allowed()
        start = _allowed()[0]
        to, on = np.empty_like(scores), np.zeros_like(scores)
        to[0] = scores[0] + start
        for t in range(1, len(scores)):
            to[t] = _total(to[t - 1][:, :, None] + after, 1) + scores[t]
        for t in range(len(scores) - 2, -1, -1):
            on[t] = _total(after + (scores[t + 1] + on[t + 1])[:, None, :], 2)
        return to, on, _total(to[-1], 1), after

    def run(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best tags of each window, and the probability of each of them."""
        scores, *_ = self._scores(x)
        to, on, whole, after = self._beliefs(scores)
        best = scores[0] + _allowed()[0]
        came = np.zeros(scores.shape, dtype=np.int8)
        for t in range(1, len(scores)):
            ways = best[:, :, None] + after
            came[t] = ways.argmax(axis=1)
            best = ways.max(axis=1) + scores[t]
        rows = np.arange(x.shape[0])
        path = np.empty(scores.shape[:2], dtype=np.int64)
        path[-1] = best.argmax(axis=1)
        for t in range(len(scores) - 1, 0, -1):
            path[t - 1] = came[t, rows, path[t]]
        sure = np.exp(to + on - whole[:, None])
        sure = np.take_along_axis(sure, path[:, :, None], axis=2)[:, :, 0]
        return path.T, sure.T

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tags y, and its gradient."""
        scores, both, ahead, behind = self._scores(x)
        to, on, whole, after = self._beliefs(scores)
        tagged = y.T
        n = x.shape[0]
        own = np.take_along_axis(scores, tagged[:, :, None], axis=2).sum(axis=(0, 2))
        own = own + after[tagged[:-1], tagged[1:]].sum(axis=0) + _allowed()[0][tagged[0]]
        there = np.zeros_like(scores)
        np.put_along_axis(there, tagged[:, :, None], 1, axis=2)
        d_scores = (np.exp(to + on - whole[:, None]) - there) / n
        pairs = np.zeros((TAGS, TAGS))
        np.add.at(pairs, (tagged[:-1], tagged[1:]), -1.0)
        for t in range(1, len(scores)):
            ways = to[t - 1][:, :, None] + after + (scores[t] + on[t] - whole[:, None])[:, None, :]
            pairs += np.exp(ways).sum(axis=0)
        grads = {
            "out": both.reshape(-1, 2 * UNITS).T @ d_scores.reshape(-1, TAGS),
            "bias": d_scores.sum(axis=(0, 1)),
            "next": pairs / n,
        }
        d_both = d_scores @ self.weights["out"].T
        grads |= self._back(ahead, d_both[:, :, :UNITS], "f")
        grads |= self._back(behind, d_both[::-1, :, UNITS:], "b")
        return float((whole - own).mean()), grads

    def learn(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS) -> Tagger:
        """Steps of Adam over shuffled batches."""
        rng = np.random.default_rng(11)
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step, steps = 0, epochs * -(-len(x) // BATCH)
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                rows = order[at : at + BATCH]
                _, grads = self.loss(x[rows], y[rows])
                size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                step += 1
                rate = RATE * (1 - 0.9 * step / steps)
                for k, g in grads.items():
                    g = g * min(1.0, 5.0 / (size + 1e-9))
                    mean[k] += 0.1 * (g - mean[k])
                    square[k] += 0.01 * (g * g - square[k])
                    up = mean[k] / (1 - 0.9**step)
                    down = np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6
                    self.weights[k] -= (rate * up / down).astype(np.float32)
        return self


def spans_of(path: np.ndarray) -> list[Span]:
    """The spans that a row of tags spells."""
    starts = np.flatnonzero(path % 2 == 1)
    out = []
    for a in starts.tolist():
        inner, b = path[a] + 1, a + 1
        while b < len(path) and path[b] == inner:
            b += 1
        out.append((a, int(inner - 2) // 2, b))
    return out


def windows(text: str) -> list[int]:
    """Where the windows of a text begin that may hold a span or part of one.

    Those with a character of EVIDENCE, and their neighbours.
    """
    begins = range(0, max(1, len(text) - WINDOW + STRIDE), STRIDE)
    wanted = set()
    for m in re.finditer(EVIDENCE, text):
        last = min(m.start() // STRIDE, len(begins) - 1)
        if last + 1 not in wanted:
            wanted |= set(range(max(0, last - WINDOW // STRIDE), min(len(begins), last + 2)))
    return [begins[k] for k in sorted(wanted)]


def reconcile(found: list[tuple[Span, float, bool, bool]]) -> list[Span]:
    """Spans of all windows of a text (span, confidence, cut left, cut right) made one.

    Spans cut by a window's edge are joined with those of their kind that go on
    from there in another window, else dropped; of spans that overlap, the set
    with the largest sum of confidences is kept, where windows that agree add up.
    """
    whole = [f for f in found if not f[2] and not f[3]]
    cut = sorted(f for f in found if f[2] or f[3])
    for kind in range(len(KINDS)):
        run = None
        for (start, k, end), sure, left, right in cut:
            if k != kind:
                continue
            if run and left and start <= run[1]:
                run = [run[0], max(end, run[1]), min(sure, run[2]), right if end >= run[1] else run[3]]
            else:
                run = None if left else [start, end, sure, right]
            if run and not run[3]:
                whole.append(((run[0], kind, run[1]), run[2], False, False))
                run = None
    weight: dict[Span, float] = {}
    for span, sure, *_ in whole:
        weight[span] = weight.get(span, 0.0) + sure
    order = sorted(weight, key=lambda s: (s[2], s[0], s[1]))
    ends = [s[2] for s in order]
    best: list[tuple[float, int | None, int]] = [(0.0, None, 0)]
    for at, span in enumerate(order):
        before = int(np.searchsorted(ends[:at], span[0], side="right"))
        with_it = best[before][0] + weight[span]
        if with_it > best[at][0]:
            best.append((with_it, at, before))
        else:
            best.append((best[at][0], None, at))
    kept, at = [], len(order)
    while at:
        _, taken, before = best[at]
        if taken is not None:
            kept.append(order[taken])
        at = before
    return sorted(kept)


def tagged(texts: Sequence[str], tagger: Tagger) -> list[list[Span]]:
    """Spans that the tagger finds in each text, over all of its windows."""
    places = [(row, begin) for row, text in enumerate(texts) for begin in windows(text)]
    found: list[list] = [[] for _ in texts]
    for at in range(0, len(places), DECODED):
        block = places[at : at + DECODED]
        path, sure = tagger.run(classes([texts[r][b : b + WINDOW] for r, b in block]))
        for (row, begin), p, s in zip(block, path, sure, strict=True):
            if not p.any():
                continue
            size = min(WINDOW, len(texts[row]) - begin)
            for start, kind, end in spans_of(p[:size]):
                left = start == 0 and begin > 0
                right = end == size and begin + size < len(texts[row])
                span = (begin + start, kind, begin + end)
                found[row].append((span, float(s[start:end].mean()), left, right))
    out = []
    for text, spans in zip(texts, found, strict=True):
        sure = reconcile([f for f in spans if f[1] >= LEAST_CONFIDENCE])
        trimmed = []
        for start, kind, end in sure:
            end -= len(text[start:end]) - len(text[start:end].rstrip())
            start += len(text[start:end]) - len(text[start:end].lstrip())
            if holds(kind, text[start:end]):
                trimmed.append((start, kind, end))
        out.append(trimmed)
    return out


def added(found: Sequence[Span], base: Sequence[Span]) -> list[Span]:
    """Those of found that overlap no span of base; both are in order."""
    out, at, reach = [], 0, 0
    for start, kind, end in found:
        while at < len(base) and base[at][0] < end:
            reach = max(reach, base[at][2])
            at += 1
        if reach <= start:
            out.append((start, kind, end))
    return out


def respelled(kind: int, text: str, rng: np.random.Generator) -> str:
    """A span as people also write it, where the patterns do not find it."""
    digits = _NO_DIGIT.sub("", text)
    way = int(rng.integers(0, 3))
    if kind == 0:
        name, _, place = text.partition("@")
        return (f"{name} @ {place}", f"{name}é@{place}", f"{name}@ {place}")[way]
    if kind == 1:
        return (text.replace(".", " . "), text.replace(".", "[.]"), text.replace(".", "(.)"))[way]
    if kind == 2:
        fours = [digits[k : k + 4] for k in range(0, len(digits), 4)]
        return (".", "_", " - ")[way].join(fours)
    local = digits[-10:]
    return (
        f"({local[:3]}) {local[3:6]}-{local[6:]}",
        f"{local[:3]}-{local[3:6]}-{local[6:]}",
        f"{local[:3]}.{local[3:6]}.{local[6:]}",
    )[way]


def example(text: str, spans: Sequence[Span], at: int, rng: np.random.Generator, change: bool):
    """A window around span ``at`` with its spans; changed: that span respelled.

    A changed card may also get a second one beside it.
    """
    start, kind, end = spans[at]
    new = text[start:end]
    extra: list[Span] = []
    if change:
        new = respelled(kind, new, rng)
        if kind == 2 and rng.random() < 0.5:
            plain = _NO_DIGIT.sub("", text[start:end])
            new = f"{plain} {plain[::-1]}"
            extra = [(start + len(plain) + 1, kind, start + len(new))]
    first = start + len(new) if not extra else extra[0][0] - 1
    grown = len(new) - (end - start)
    whole = text[:start] + new + text[end:]
    moved = [s for s in spans if s[2] <= start]
    moved += [(start, kind, first), *extra]
    moved += [(a + grown, k, b + grown) for a, k, b in spans if a >= end]
    begin = max(0, start - int(rng.integers(0, WINDOW // 2)))
    inside = [
        (max(a, begin) - begin, k, min(b, begin + WINDOW) - begin)
        for a, k, b in moved
        if a < begin + WINDOW and b > begin
    ]
    return whole[begin : begin + WINDOW], inside


def examples(docs: DataFrame, text: str) -> DataFrame:
    """Rows (kind, draw, window, tags): windows around matches, and some without.

    From a sample of TRAIN_TEXTS texts by a hash of the text; at most one window of
    each kind from a text, as it is and respelled.
    """
    total = max(1, docs.count())
    limit = int(min(1.0, TRAIN_TEXTS / total) * (1 << 20)) + 1
    drawn = F.pmod(F.xxhash64(F.lit("pii"), text), F.lit(1 << 20)) < limit
    sample = docs.filter(drawn & F.col(text).rlike(EVIDENCE)).select(
        F.col(text).alias("text"), F.xxhash64(F.lit("draw"), text).alias("draw")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, draw in zip(
                batch["text"].to_pylist(), batch["draw"].to_pylist(), strict=True
            ):
                rng = np.random.default_rng(draw & ((1 << 63) - 1))
                spans, last = [], 0
                for span in matches(text, strict=False):
                    if span[0] >= last:
                        spans.append(span)
                        last = span[2]
                for kind in range(len(KINDS)):
                    own = [k for k, s in enumerate(spans) if s[1] == kind]
                    if own:
                        for change in (False, True):
                            at = own[int(rng.integers(0, len(own)))]
                            window, inside = example(text, spans, at, rng, change)
                            out.append((kind, draw + change, window, tags(inside)))
                free = [
                    b for b in windows(text)
                    if not any(s[0] < b + WINDOW and s[2] > b for s in spans)
                ]
                if free:
                    b = free[int(rng.integers(0, len(free)))]
                    out.append((len(KINDS), draw, text[b : b + WINDOW], tags([])))
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int32()),
                    pa.array([(d + (1 << 63)) % (1 << 64) - (1 << 63) for d in columns[1]], pa.int64()),
                    pa.array(columns[2], pa.string()),
                    pa.array([t.astype(np.int8).tobytes() for t in columns[3]], pa.binary()),
                ],
                names=["kind", "draw", "window", "tags"],
            )

    return sample.mapInArrow(lean(run), "kind int, draw long, window string, tags binary")


def train(docs: DataFrame, text: str = "text") -> Tagger | None:
    """A tagger fitted on TRAIN_EXAMPLES windows a kind, or None for want of spans."""
    small_batches(docs.sparkSession)
    first = Window.partitionBy("kind").orderBy("draw", "window")
    few = examples(docs, text).withColumn("rank", F.row_number().over(first))
    rows = few.filter(F.col("rank") <= TRAIN_EXAMPLES).collect()
    if sum(r["kind"] < len(KINDS) for r in rows) < 2 * LEAST_SPANS:
        return None
    rows.sort(key=lambda r: (r["kind"], r["rank"]))
    y = np.stack([np.frombuffer(r["tags"], dtype=np.int8) for r in rows]).astype(np.int64)
    return Tagger.fresh().learn(classes([r["window"] for r in rows]), y)


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"]
            ),
        ),
        ",",
    )


def scan(docs: DataFrame, text: str = "text", tagger: Tagger | None = None) -> DataFrame:
    """docs without the text, with arrays ``base`` and ``spans`` of (start, kind, end).

    Kinds are places in KINDS; start and end count code points, end exclusive.
    ``base`` holds what the patterns match, ``spans`` that and what the tagger adds
    where no pattern matches; both by start, then kind. Without a tagger they are
    equal. A null or empty text has no spans; other columns come back as they are,
    whatever their names, repeated rows as often as they came; an empty table
    gives no rows.
    """
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(tagger)
    others = [c for c in docs.columns if c != text]
    names = [f"p{k}" for k in range(len(others))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch["pii_text"].to_pylist()]
            base = [matches(t) if t else [] for t in texts]
            spans = base
            if model.value is not None:
                more = tagged(texts, model.value)
                spans = [sorted(b + added(m, b)) for m, b in zip(more, base, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch[n] for n in names), _column(base), _column(spans)],
                names=[*names, "pii_base", "pii_spans"],
            )

    # Texts without a character that every span holds stay where they are.
    body = F.col(text).cast("string")
    source = docs.select(
        *(F.col(c).alias(n) for c, n in zip(others, names, strict=True)),
        F.when(body.rlike(EVIDENCE), body).alias("pii_text"),
    )
    kind = "array<struct<start:long,kind:int,end:long>>"
    empty = F.array().cast(kind)
    schema = source.select(*names, empty.alias("pii_base"), empty.alias("pii_spans")).schema
    return source.mapInArrow(lean(run), schema).select(
        *(F.col(n).alias(c) for c, n in zip(others, names, strict=True)),
        F.col("pii_base").alias("base"),
        F.col("pii_spans").alias("spans"),
    )


def _column(rows: list[list[Span]]) -> pa.Array:
    flat = [span for row in rows for span in row]
    items = pa.StructArray.from_arrays(
        [
            pa.array([s[0] for s in flat], pa.int64()),
            pa.array([s[1] for s in flat], pa.int32()),
            pa.array([s[2] for s in flat], pa.int64()),
        ],
        names=["start", "kind", "end"],
    )
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), items)
