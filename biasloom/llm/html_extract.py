"""Main text of web pages, by equivalence-class template deduction.

The pages of a host are made from one or more templates. Every element, and
every text at its place, is a token. A token's occurrence vector says how often
it is on each page of the host; tokens of the same vector form an equivalence
class (a token that is always there equally often counts as so many tokens that
are there once). A class is valid if it has LEAST_PAGES pages and two or more
tokens: an element among them, or texts at two or more places. So each layout of
a host has classes of its own, whatever its share of the pages. A class of one
token is valid only if it holds for nearly all pages.

Elements are named by their path, so the spans of classes nest as the elements
do. A valid class counts if it is nested in another: the enclosing element of one
of its tokens is in a valid class or is a slot of one, that is an element whose
own enclosing element is in a valid class.
The template is its fixed texts, which are not the page's own, its slots that
mostly hold links, which are menus, and its main slot: the innermost container
(by its path with the places of elements among their like) that holds nearly all
of what is left of its pages. All blocks of a page are looked at. A page gets the
classes it contains, the widest first, but not one that would leave nothing of it,
nor one of texts alone that would take more than half of it: such a class is
content that several pages share. What is left within the main slot is the text.

Names are evidence beside that: elements that HTML itself marks as no part of an
article go, and those whose names say so, unless they hold most of a page that
has no other article.

Occurrence vectors are compared by sums of hashes (repeated pages add up) that
are reduced on the map side, so a host of any number of pages is no hot group.
A page's tokens are joined to those of its host's template, one by one.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biasloom.llm.common import Scratch, lean, row_key, small_batches

#: A class is valid from so many pages of a host; one token alone is a class if
#: it is on this share of them.
LEAST_PAGES = 5
LEAST_SHARE = 0.9
#: Kinds of classes: on nearly all pages, with an element, of texts alone.
WHOLE, BUILT, TEXTS = range(3)
#: What a class of texts alone has to leave of a page.
LEAST_LEFT = 0.5
#: A slot is a menu if this share of its characters is in links.
LINK_SHARE = 0.7
#: A container is a main slot if it holds this share of its pages' own text.
MAIN_SHARE = 0.8
#: What names leave out holds less than this share of a page.
BESIDE_SHARE = 0.5

# Names of the HTML standard, and words that sites use in class,
# id and role for parts beside the article.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset(
    "article aside body center details div footer form header main nav section table td".split()
)
HEADINGS = frozenset("h1 h2 h3".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style template textarea title iframe noframes".split())
OUTSIDE = frozenset(
    "head nav footer menu button select option object canvas audio video input".split()
)
#: Outside too, unless they hold most of the page.
ASIDE = frozenset("aside form dialog fieldset".split())
BESIDE = frozenset(
    "ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs "
    "comment comments commentlist consent cookie cookies copyright disqus footer gdpr "
    "header login masthead menu menubar modal nav navbar navigation newsletter notice notices "
    "notification overlay pager pagination popup promo promotion recommended related "
    "replies reply respond search share sharing sidebar signup skip social sponsor sponsored "
    "subscribe subscription toolbar widget widgets".split()
)
#: Words that may stand beside those in a name that still means what they say.
PLAIN = frozenset(
    "area bar block body bottom box column container content desktop fixed form global group "
    "inner item items left link links list main mobile outer page panel post primary right "
    "row secondary section site slot sticky text top user wrap wrapper".split()
)
BESIDE_ROLES = frozenset(
    "alert banner complementary contentinfo dialog form menu menubar navigation search "
    "toolbar".split()
)
#: An element of these names ends an open one of the same group.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
MARKUP = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>?|"
    r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*.?true", re.I)
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _hash(*parts: object) -> int:
    return xxhash.xxh64_intdigest("\x00".join(map(str, parts))) - (1 << 63)


@dataclass
class Block:
    """One block of text: where it stands and what it says."""

    slot: int
    gone: bool
    main: bool
    heading: bool
    #: Places in Page.containers and Page.besides; -1 for none.
    container: int
    beside: int
    pieces: list[str] = field(default_factory=list)
    links: int = 0
    text: str = ""


@dataclass
class Element:
    name: str
    path: int
    role: int
    gone: bool
    main: bool
    link: bool
    heading: bool
    container: int
    beside: int
    children: Counter = field(default_factory=Counter)


def _named_beside(name: str, labels: list[str], in_main: bool) -> bool:
    """Whether a name in class or id says that this is a part beside the article."""
    for label in labels:
        words = [w.lower() for w in NAME_PARTS.findall(label)]
        telling = [w for w in words if w in BESIDE and not (w == "header" and in_main)]
        if telling and all(w in BESIDE or w in PLAIN for w in words):
            return True
    return False


class Page:
    """The parsed page: blocks with text in order, elements, containers."""

    def __init__(self, page: str):
        self.blocks: list[Block] = []
        #: (path, path above) of each element.
        self.elements: list[tuple[int, int]] = []
        #: (role, container around it), and the container around each ``beside``.
        self.containers: list[tuple[int, int]] = []
        self.besides: list[int] = []
        self._parse(page)
        for block in self.blocks:
            block.text = " ".join(html.unescape("".join(block.pieces)).split())
            block.links = min(block.links, len(block.text))
        self.blocks = [b for b in self.blocks if b.text]
        self._leave_out()

    def _leave_out(self) -> None:
        """Names count, but not for what holds most of a page without another article."""
        if any(b.main and not b.gone and b.beside < 0 for b in self.blocks):
            for block in self.blocks:
                block.gone = block.gone or block.beside >= 0
            return
        size = [0] * len(self.besides)
        total = 0
        for block in self.blocks:
            if block.gone:
                continue
            total += len(block.text)
            at = block.beside
            while at >= 0:
                size[at] += len(block.text)
                at = self.besides[at]
        out = [s < BESIDE_SHARE * total for s in size]
        for at, up in enumerate(self.besides):
            out[at] = out[at] or (up >= 0 and out[up])
        for block in self.blocks:
            block.gone = block.gone or (block.beside >= 0 and out[block.beside])

    def _open(self, name: str, attributes: str, up: Element) -> Element:
        labels: list[str] = []
        first, role = "", ""
        for kind, *values in ATTRIBUTE.findall(attributes) if attributes else ():
            value = next((v for v in values if v), "")
            if kind.lower() == "role":
                role = value.lower().strip()
            else:
                first = first or value
                labels += value.split()
        inside = name in ("article", "main") or role in ("main", "article")
        aside = (
            name in ASIDE
            or role in BESIDE_ROLES
            or (name == "header" and not up.main)
            or (name not in ("html", "body") and _named_beside(name, labels, up.main))
        )
        beside = up.beside
        if aside:
            self.besides.append(beside)
            beside = len(self.besides) - 1
        path, place, container = up.path, up.role, up.container
        if name in BLOCKS or name in OUTSIDE:
            path = _hash(up.path, name, first)
            up.children[name] += 1
            place = _hash(up.role, name, up.children[name])
        if name in CONTAINERS:
            self.containers.append((place, container))
            container = len(self.containers) - 1
        gone = up.gone or name in OUTSIDE or bool(attributes and HIDDEN.search(attributes))
        return Element(
            name, path, place, gone, up.main or inside, up.link or name == "a",
            up.heading or name in HEADINGS, container, beside,
        )

    def _parse(self, page: str) -> None:
        top = Element("", 0, 0, False, False, False, False, -1, -1)
        stack, open_names = [top], Counter()
        block: Block | None = None
        at, end = 0, len(page)

        def text(value: str) -> None:
            nonlocal block
            now = stack[-1]
            if block is None or (block.slot, block.gone, block.beside) != (
                now.path, now.gone, now.beside,
            ):
                block = Block(now.path, now.gone, now.main, now.heading, now.container, now.beside)
                self.blocks.append(block)
            block.pieces.append(value)
            if now.link:
                block.links += len(value)

        def close(count: int) -> None:
            for _ in range(count):
                open_names[stack.pop().name] -= 1

        while at < end:
            start = page.find("<", at)
            if start < 0:
                text(page[at:])
                break
            found = MARKUP.match(page, start)
            if found is None:
                text(page[at : start + 1])
                at = start + 1
                continue
            if start > at:
                text(page[at:start])
            at = found.end()
            name = (found[2] or "").lower()
            if not name:
                continue
            if found[1]:
                if name in BLOCKS:
                    block = None
                if open_names[name]:
                    while stack[-1].name != name:
                        close(1)
                    close(1)
                continue
            if name in RAW:
                stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                if not found[3].rstrip().endswith("/"):
                    at = stop.end() if stop else end
                continue
            if name == "br":
                text(" ")
                continue
            if stack[-1].name == "head" and (name == "body" or name in BLOCKS):
                close(1)
            if name in BLOCKS:
                block = None
                ends = CLOSES.get(name, set()) | {"p"}
                if any(open_names[e] for e in ends):
                    for back in range(len(stack) - 1, 0, -1):
                        if stack[back].name in ends:
                            close(len(stack) - back)
                            break
                        if stack[back].name in BLOCKS:
                            break
            if name in VOID or found[3].rstrip().endswith("/"):
                continue
            opened = self._open(name, found[3], stack[-1])
            if opened.path != stack[-1].path:
                self.elements.append((opened.path, stack[-1].path))
            stack.append(opened)
            open_names[name] += 1

    def held(self) -> list[int]:
        """The characters that stay, in each container."""
        size = [0] * len(self.containers)
        for block in self.blocks:
            if not block.gone and block.container >= 0:
                size[block.container] += len(block.text) - block.links
        for at in range(len(size) - 1, -1, -1):
            up = self.containers[at][1]
            if up >= 0:
                size[up] += size[at]
        return size


@dataclass
class Kept:
    """A block as the choice sees it."""

    text: str
    token: int
    slot: int
    gone: bool
    main: bool
    heading: bool
    container: int


def _main_slot(own: list[Kept], containers: list[tuple[int, int]], mains: Mapping[int, int]):
    """For each container whether it is in the innermost main slot with text; or None."""
    full = [False] * (len(containers) + 1)
    for block in own:
        full[block.container] = True
    for at in range(len(containers) - 1, -1, -1):
        if full[at]:
            full[containers[at][1]] = True
    found = [
        (mains[role], at)
        for at, (role, _) in enumerate(containers)
        if role in mains and full[at]
    ]
    if not found:
        return None
    inside = [False] * (len(containers) + 1)
    main = max(found)[1]
    for at, (_, up) in enumerate(containers):
        inside[at] = at == main or inside[up]
    return inside


def choose(
    blocks: list[Kept],
    containers: list[tuple[int, int]],
    fixed: Mapping[int, tuple[int, int, int]] | None = None,
    menus: frozenset[int] = frozenset(),
    mains: Mapping[int, int] | None = None,
) -> str:
    """The main text of a page's blocks, given what its host's template says of them.

    ``containers`` are (role, container around it), the outer ones first.
    ``fixed`` has the class of each fixed text as (kind, -pages, class), ``menus`` the
    slots that are menus, ``mains`` the roles that are main slots with their depth.
    """
    fixed = fixed or {}
    left = [b for b in blocks if b.slot not in menus]
    left = [b for b in left if fixed.get(b.token, (BUILT,))[0] != WHOLE]
    for one in sorted({fixed[b.token] for b in left if b.token in fixed}):
        rest = [b for b in left if fixed.get(b.token) != one]
        size, before = (
            sum(len(b.text) for b in part if not b.gone) for part in (rest, left)
        )
        if size > 0 and (one[0] == BUILT or size >= LEAST_LEFT * before):
            left = rest
    own = [b for b in left if not b.gone]
    if not own:
        # A host whose pages are all alike has no slots; its pages speak for themselves.
        own = [b for b in blocks if not b.gone]
    within = _main_slot(own, containers, mains or {})
    if within:
        own = [b for b in own if within[b.container] or b.heading]
    else:
        inside = [b for b in own if b.main]
        if sum(len(b.text) for b in inside) >= LEAST_LEFT * sum(len(b.text) for b in own):
            own = inside or own
    return "\n\n".join(b.text for b in own)


def _kept(page: Page) -> list[Kept]:
    return [
        Kept(b.text, _hash(b.slot, b.text), b.slot, b.gone, b.main, b.heading, b.container)
        for b in page.blocks
    ]


def extract(page: str) -> str:
    """The main text of a page alone, without a template."""
    parsed = Page(page)
    return choose(_kept(parsed), parsed.containers)


#: What the template is made from: a page's tokens (once each) and its containers.
SHAPE = (
    "tokens array<struct<token:long,above:long,element:int,times:long,chars:long,links:long>>, "
    "held array<struct<role:long,depth:int,chars:long>>, chars long"
)
#: What its text is chosen from: its blocks, their texts on end and compressed.
BLOCK_COLUMNS = (
    "texts binary, sizes array<int>, slots array<long>, flags array<int>, inside array<int>, "
    "roles array<long>, ups array<int>"
)
GONE, MAIN, HEADING = 1, 2, 4
TOKEN = pa.struct(
    [("token", pa.int64()), ("above", pa.int64()), ("element", pa.int32()), ("times", pa.int64()),
     ("chars", pa.int64()), ("links", pa.int64())]
)
HELD = pa.struct([("role", pa.int64()), ("depth", pa.int32()), ("chars", pa.int64())])


def _tokens(page: Page, hashes: list[int]) -> list[tuple]:
    """The tokens of a page: how often each is there, and what its slot holds."""
    own: dict[int, list[int]] = {0: [0, 1, 1, 0, 0]}
    for path, above in page.elements:
        own.setdefault(path, [above, 1, 0, 0, 0])[2] += 1
    for block, token in zip(page.blocks, hashes, strict=True):
        own.setdefault(token, [block.slot, 0, 0, 0, 0])[2] += 1
        slot = own.setdefault(block.slot, [0, 1, 1, 0, 0])
        slot[3] += len(block.text)
        slot[4] += block.links
    return [(token, *of) for token, of in own.items()]


def _shape(value: str) -> tuple:
    page = Page(value)
    hashes = [_hash(b.slot, b.text) for b in page.blocks]
    names = [f.name for f in TOKEN]
    tokens = [dict(zip(names, one, strict=True)) for one in _tokens(page, hashes)]
    held, depth = [], []
    for (role, up), n in zip(page.containers, page.held(), strict=True):
        depth.append(depth[up] + 1 if up >= 0 else 0)
        held.append({"role": role, "depth": depth[-1], "chars": n})
    return tokens, held, sum(len(b.text) - b.links for b in page.blocks if not b.gone)


def _blocks(value: str, pack) -> tuple:
    page = Page(value)
    blocks = page.blocks
    return (
        pack("".join(b.text for b in blocks).encode("utf-8", "surrogatepass")),
        [len(b.text) for b in blocks],
        [b.slot for b in blocks],
        [GONE * b.gone + MAIN * b.main + HEADING * b.heading for b in blocks],
        [b.container for b in blocks],
        [role for role, _ in page.containers],
        [up for _, up in page.containers],
    )


def _parsed(source: DataFrame, blocks: bool) -> DataFrame:
    """source with the columns of SHAPE, or of BLOCK_COLUMNS, in place of ``page``."""
    others = [c for c in source.columns if c != "page"]
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    kinds = [pa.list_(TOKEN), pa.list_(HELD), pa.int64()]
    if blocks:
        kinds = [pa.binary(), ints, longs, ints, ints, longs, ints]
    made = BLOCK_COLUMNS if blocks else SHAPE
    names = re.findall(r"(?:^|, )(\w+) ", made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor().compress
        for batch in batches:
            pages = batch["page"].to_pylist()
            rows = [_blocks(page, pack) if blocks else _shape(page) for page in pages]
            columns = [
                pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in others), *columns], names=[*others, *names]
            )

    kept = ", ".join(f"{c} {source.schema[c].dataType.simpleString()}" for c in others)
    return source.mapInArrow(lean(run), f"{kept}, {made}")


def host_tokens(shapes: DataFrame) -> DataFrame:
    """Rows (host, token, above, element, vector, pages, chars, links), one a token of a host.

    ``vector`` is the hash of the token's occurrence vector (of its pages alone, if
    it is on all of them equally often), ``pages`` how many pages have it, and the
    last two count the characters of a slot and those in links. Token 0 is the page
    itself; tokens of fewer than LEAST_PAGES pages are left out.
    """
    rows = shapes.select("host", "mark", F.inline("tokens"))

    def halves(number) -> list:
        # Sums of 31 bits over all pages of a host stay in 64.
        low = number.bitwiseAND(F.lit(0x7FFFFFFF).cast("long"))
        return [low, F.shiftrightunsigned(number, 33)]

    low, high = halves(F.col("mark"))
    own_low, own_high = halves(F.xxhash64("mark", "times"))
    grouped = rows.groupBy("host", "token").agg(
        F.min("above").alias("above"),
        F.max("element").alias("element"),
        F.min("times").alias("least"),
        F.max("times").alias("most"),
        F.sum(low).alias("low"),
        F.sum(high).alias("high"),
        F.sum(own_low).alias("own_low"),
        F.sum(own_high).alias("own_high"),
        F.count(F.lit(1)).alias("pages"),
        F.sum("chars").alias("chars"),
        F.sum("links").alias("links"),
    )
    steady = F.col("least") == F.col("most")
    vector = F.when(steady, F.struct(F.lit(0).alias("kind"), "low", "high")).otherwise(
        F.struct(F.lit(1).alias("kind"), F.col("own_low").alias("low"), F.col("own_high").alias("high"))
    )
    return grouped.filter(F.col("pages") >= LEAST_PAGES).select(
        "host", "token", "above", "element", vector.alias("vector"), "pages", "chars", "links"
    )


def main_slots(shapes: DataFrame) -> DataFrame:
    """Rows (host, role, depth) of the containers that hold nearly all of their pages' text."""
    rows = shapes.select(
        "host", F.col("chars").alias("whole"), F.inline("held")
    )
    grouped = rows.groupBy("host", "role").agg(
        F.max("depth").alias("depth"),
        F.count(F.lit(1)).alias("pages"),
        F.sum("chars").alias("chars"),
        F.sum("whole").alias("whole"),
    )
    enough = (F.col("pages") >= LEAST_PAGES) & (F.col("chars") > 0)
    return grouped.filter(enough & (F.col("chars") >= MAIN_SHARE * F.col("whole"))).select(
        "host", "role", "depth"
    )


def _template(tokens: DataFrame) -> DataFrame:
    """The tokens of nested valid classes, and their slots, with their class's kind.

    A slot that is in no valid class itself has no kind.
    """
    whole = tokens.filter("token = 0").select(
        F.col("host").alias("whole_host"), F.col("pages").alias("host_pages")
    )
    inner = tokens.filter("token <> 0")
    several = F.col("size") >= 2
    kind = (
        F.when(F.col("class_pages") >= LEAST_SHARE * F.col("host_pages"), WHOLE)
        .when(several & (F.col("elements") > 0), BUILT)
        .when(several & (F.col("first_above") < F.col("last_above")), TEXTS)
    )
    classes = (
        inner.groupBy(
            F.col("host").alias("class_host"),
            F.col("vector").alias("class_vector"),
            F.col("pages").alias("class_pages"),
        )
        .agg(
            F.count("*").alias("size"),
            F.max("element").alias("elements"),
            F.min("above").alias("first_above"),
            F.max("above").alias("last_above"),
        )
        .join(whole, F.col("class_host") == F.col("whole_host"))
        .select("class_host", "class_vector", "class_pages", kind.alias("kind"))
        .filter("kind IS NOT NULL")
    )
    same = [F.col(c) == F.col(f"class_{c}") for c in ("host", "vector", "pages")]
    placed = inner.join(classes, same, "left").select(*tokens.columns, "kind")
    root = tokens.filter("token = 0").select("host", "token")

    def within(rows: DataFrame, above: DataFrame) -> DataFrame:
        named = above.select(F.col("host").alias("above_host"), F.col("token").alias("above_token"))
        same = (F.col("host") == F.col("above_host")) & (F.col("above") == F.col("above_token"))
        return rows.join(named, same, "left_semi")

    valid = placed.filter("kind IS NOT NULL AND element = 1").select("host", "token")
    slots = within(placed.filter("element = 1"), valid.union(root))
    known = valid.union(root).union(slots.select("host", "token"))
    counted = placed.filter("kind IS NOT NULL")
    nested = within(counted, known).select(
        *(F.col(c).alias(f"class_{c}") for c in ("host", "vector", "pages"))
    )
    return counted.join(nested, same, "left_semi").union(slots.filter("kind IS NULL"))


def main_text(
    pages: DataFrame,
    scratch: Scratch,
    page: str = "html",
    host: str = "host",
) -> DataFrame:
    """pages with ``text`` and ``n_chars`` in place of the page column.

    ``host`` names a column with each page's host; pages of one host share a
    template. A null page is empty and has an empty text; a page without a host
    has no template, nor has a host of few pages. Character references are
    decoded, white space within a block is one space, blocks are joined by an
    empty line. Columns named text or n_chars are replaced, others come back as they
    are; rows that repeat come back as often as they came; an empty table gives no
    rows.
    """
    small_batches(pages.sparkSession)
    others = [c for c in pages.columns if c not in (page, "text", "n_chars")]
    names = [f"he__{k}" for k in range(len(others))]
    body = F.coalesce(F.col(page).cast("string"), F.lit(""))
    at_host = F.col(host).cast("string")
    source = pages.select(
        at_host.alias("host"),
        F.xxhash64(at_host, body).alias("mark"),
        body.alias("page"),
        *(F.col(c).alias(n) for c, n in zip(others, names, strict=True)),
    )
    # Pages alike of one host are told the same, so they share a key.
    source = source.withColumn("key", row_key(source, "host", "page"))
    shapes = _parsed(source.select("host", "mark", "key", "page"), False)
    shapes = scratch.keep(shapes.filter(F.col("host").isNotNull()), "shapes")
    template = _template(scratch.keep(host_tokens(shapes), "tokens"))
    menu = (F.col("element") == 1) & (F.col("chars") > 0)
    menu = menu & (F.col("links") >= LINK_SHARE * F.col("chars"))
    text = (F.col("element") == 0) & F.col("kind").isNotNull()
    told = template.filter(text | menu).select(
        F.col("host").alias("at"),
        F.col("token").alias("of"),
        F.when(text, F.struct("kind", (-F.col("pages")).alias("width"), "vector.low")).alias("class"),
    )
    mains = main_slots(shapes).select(
        F.col("host").alias("at"), F.col("role").alias("of"), "depth"
    )
    told, mains = scratch.keep(told, "told"), scratch.keep(mains, "mains")
    # A page's own tokens and containers, as far as the template says something of them.
    same = (F.col("host") == F.col("at")) & (F.col("token") == F.col("of"))
    fits = shapes.select("key", "host", F.explode("tokens.token").alias("token")).join(told, same)
    fits = fits.select("key", "token", "class", F.lit(None).cast("int").alias("depth"))
    slots = shapes.select("key", "host", F.explode("held.role").alias("token")).join(mains, same)
    none = told.schema["class"].dataType
    slots = slots.select("key", "token", F.lit(None).cast(none).alias("class"), "depth")
    found = fits.unionByName(slots).groupBy(F.col("key").alias("for")).agg(
        F.collect_set(F.struct("token", "class", "depth")).alias("told")
    )
    # Written, so that its size says whether the pages have to be moved to it.
    found = scratch.keep(found, "found")
    parsed = _parsed(source.select("key", "page", *names), True)
    columns = ["texts", "sizes", "slots", "flags", "inside", "roles", "ups"]
    joined = parsed.join(found, F.col("key") == F.col("for"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in (*columns, "told")), strict=True)
            texts = [
                _chosen(unpack(packed).decode("utf-8", "surrogatepass"), *row)
                for packed, *row in rows
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch[n] for n in names),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=[*names, "text", "n_chars"],
            )

    schema = joined.select(
        *names, F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")
    ).schema
    return joined.mapInArrow(lean(run), schema).select(
        *(F.col(n).alias(c) for c, n in zip(others, names, strict=True)), "text", "n_chars"
    )


def _chosen(whole, sizes, slots, flags, inside, roles, ups, told) -> str:
    """The text of a parsed page, from its columns and what its template says."""
    blocks, begin = [], 0
    for size, slot, flag, at in zip(sizes, slots, flags, inside, strict=True):
        text = whole[begin : begin + size]
        begin += size
        gone, main, heading = bool(flag & GONE), bool(flag & MAIN), bool(flag & HEADING)
        blocks.append(Kept(text, _hash(slot, text), slot, gone, main, heading, at))
    fixed, menus, mains = {}, set(), {}
    for one in told or ():
        if one["class"] is not None:
            fixed[one["token"]] = tuple(one["class"].values())
        elif one["depth"] is not None:
            mains[one["token"]] = one["depth"]
        else:
            menus.add(one["token"])
    containers = list(zip(roles, ups, strict=True))
    return choose(blocks, containers, fixed, frozenset(menus), mains)
