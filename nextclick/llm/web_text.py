"""Main text of web pages by equivalence-class template deduction.

Every page becomes a tree of containers (div, section, article, ...); a container is known by its path of tags, classes and ids.
Over the pages of a host each path has an occurrence vector, the number of times it stands on each page. Paths with the same vector
form an equivalence class; classes of paths that stand on most pages are valid and nest, by their paths, into the host's template.
What text differs from page to page lies in the template's slots; containers whose text is the same on all pages are template. The main
slot of a page is the deepest container that holds all of its text that is neither the template's nor in menus, adverts and the like; so what
is left out is template, noise, or links outside the slot. A page of another template, or of a host of one page, is read by the same rule.

Where an article or main element is a slot of the host's template that holds at least half of the host's unlinked text, it is the host's main slot, and every
container beside it is another slot (an advert's, a notice's), whatever it is called: its text goes. Text that stands between containers around the main slot
(a heading, a lead) stays. All containers are counted, also those whose tag or name speaks against them; the same path is two tokens if it does so on some pages only.

A text block is a token as well: the hash of its path, block tags included, and of its text. It nests by its path in the class of its container, and is
template text if it stands on nearly all pages on which its container stands; such blocks are left out wherever they stand in the slot. Nearly
all, since pages are cut off and since a copied article is on a share of its container's pages only. The order of tokens is not checked. A
page on which nothing else stands keeps them.

Vectors are compared by their hash, summed over pages, so neither the pages of a large host nor its vectors ever meet in one task.

Defined cases: a null or empty page, or one without text, has the empty text; a null url is a host of its own; equal rows are
extracted alike; a cut-off page is read to its end; only page_id, url and html are read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nextclick.llm.common import materialise, narrow_batches, read

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|iframe|textarea|select|object|math|canvas)\b[^>]*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>"
    r"|<[!?][^>]*+>", re.S | re.I)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("body div section article main aside nav header footer form td center fieldset dialog".split())
BLOCKS = CONTAINERS | frozenset("html head title p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd table thead tbody tfoot tr th blockquote pre address hr "
                                "figure figcaption details summary caption menu hgroup legend option label".split())
#: An opening tag of the key ends an open element of the value.
IMPLIED = {t: frozenset(["p"]) for t in BLOCKS - {"label", "legend", "caption", "option"}} | {
    "li": frozenset(["p", "li"]), "dt": frozenset(["p", "dt", "dd"]), "dd": frozenset(["p", "dt", "dd"]),
    "tr": frozenset(["p", "tr", "td", "th"]), "td": frozenset(["p", "td", "th"]), "th": frozenset(["p", "td", "th"]), "option": frozenset(["option"])}
#: An implied end does not reach beyond these.
SCOPE = {"li": frozenset(["ul", "ol", "menu"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]), "tr": frozenset(["table"]),
         "td": frozenset(["tr", "table"]), "th": frozenset(["tr", "table"])}

#: Elements, roles and words of class names and ids that are not article text.
NOISE_TAGS = frozenset("head nav footer aside form button dialog menu label input fieldset legend".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar footer masthead topbar cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup login search "
    "share sharing social related recommended recommendations comment comments commentlist disqus replies respond widget toolbar pagination pager skip".split())


@dataclass
class Container:
    key: int
    parent: Container | None
    #: Share of the page's text with which it is no noise after all, 0 if nothing speaks against it, and the largest from the page down to it.
    suspect: float
    depth: int
    #: Whether it is an article or main element.
    spoken: bool = False
    noise: bool = False
    doubt: float = 0.0
    #: Characters of its own text without links, and its own text.
    own: int = 0
    text: list[str] = field(default_factory=list)
    article: bool = False


@dataclass
class Block:
    place: Container
    text: str
    linked: int
    tags: str

    @property
    def token(self) -> int:
        return xxhash.xxh3_64_intdigest(f"{self.place.key}/{self.tags}/{self.text}") >> 1 or 1


#: Suspicion by a tag (never lifted), by a whole name, by a part of a name, and by a role, a form or a name that says what is inside.
BY_TAG, BY_NAME, BY_PART, BY_HINT = 2.0, 1.0, 0.8, 0.5
_SAYS_INSIDE = re.compile(r"^(?:has|have|with|without|no|is|show|hide)[-_]")


def _suspicion(tag: str, names: list[str], words: set[str], role: str, inside: bool) -> float:
    """How strongly tag, class, id and role speak against a container."""
    if tag in NOISE_TAGS and tag not in ("form", "fieldset") or not inside and tag == "header":
        return BY_TAG
    listed = NOISE_WORDS if inside else NOISE_WORDS | {"header"}
    found = BY_HINT if tag in NOISE_TAGS or role in NOISE_ROLES else 0.0
    if words & listed:
        for name in names:
            said = set(re.findall(r"[a-z]+", name.lower()))
            if said & listed:
                found = max(found, BY_HINT if _SAYS_INSIDE.match(name.lower()) else BY_NAME if said <= listed else BY_PART)
    return found


def settle(containers: list[Container]) -> None:
    """Say which containers are noise. An article or main element inside a suspected container, or text that is most of the page's, lifts the suspicion."""
    for c in containers:
        c.doubt = max(c.suspect, c.parent.doubt if c.parent is not None else 0.0)
    if any(0 < c.doubt < BY_TAG for c in containers):
        held = {id(c): c.own for c in containers}  # without suspected containers inside
        for c in reversed(containers):
            if c.parent is not None and not c.suspect:
                held[id(c.parent)] += held[id(c)]
        clean = held[id(containers[0])]
        hidden = [c for c in containers if c.spoken and 0 < c.doubt < BY_TAG and held[id(c)]]
        spoken = {id(c) for c in containers if c.spoken and not c.doubt and held[id(c)]}

        def alone(c: Container) -> bool:
            """No unsuspected article but those around it."""
            around, up = 0, c.parent
            while up is not None:
                around += id(up) in spoken
                up = up.parent
            return around == len(spoken)

        most = max((held[id(c)] for c in hidden), default=0)
        lifted = [c for c in hidden if 2 * held[id(c)] >= most and (c.doubt <= BY_HINT or held[id(c)] > clean) and alone(c)]
        if not lifted:
            by_key: dict[int, int] = {}
            for c in containers:
                if c.suspect and c.doubt < BY_TAG:
                    by_key[c.key] = by_key.get(c.key, 0) + held[id(c)]
            enough = [c for c in containers if by_key.get(c.key) and by_key[c.key] >= c.doubt * (by_key[c.key] + clean)]
            best = max((by_key[c.key] for c in enough), default=0)
            lifted = [c for c in enough if by_key[c.key] == best and alone(c)]
        for c in lifted:
            up = c
            while up is not None:
                up.suspect = 0.0
                up = up.parent
    for c in containers:
        c.noise = c.suspect > 0 or c.parent is not None and c.parent.noise


def _names(attributes: str) -> tuple[str, list[str], set[str], str]:
    """Signature part, class names and id, the words of these, and role of a tag."""
    found = {m[0].lower(): m[1] or m[2] or m[3] for m in _ATTRIBUTE.findall(attributes)} if attributes.strip() else {}
    names = re.sub(r"([a-z])([A-Z])", r"\1-\2", f"{found.get('class', '')} {found.get('id', '')}").split()
    words = set(re.findall(r"[a-z]+", " ".join(names).lower()))
    shape = re.sub(r"\d+", "0", " ".join(sorted(found.get("class", "").split())) + "#" + found.get("id", ""))
    return shape, names, words, found.get("role", "").lower()


def parse(page: str) -> tuple[list[Container], list[Block]]:
    """Containers in the order in which they open, and text blocks in page order."""
    top = Container(0, None, 0.0, 0)
    containers, blocks = [top], []
    stack: list[tuple[str, Container]] = [("", top)]
    open_tags: dict[str, int] = {}
    pieces: list[str] = []
    linked = at = links = 0

    def close_block() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split()) if pieces else ""
        if text:
            place = stack[-1][1]
            k = len(stack) - 1
            while k and stack[k - 1][1] is place:
                k -= 1
            blocks.append(Block(place, text, linked, "/".join(t for t, _ in stack[k:])))
            place.own += max(len(text) - linked, 0)
            place.text.append(text)
        pieces.clear()
        linked = 0

    def pop() -> None:
        tag = stack.pop()[0]
        open_tags[tag] -= 1

    def said(text: str) -> None:
        nonlocal linked
        if text:
            text = entities.unescape(text)
            pieces.append(text)
            if links:
                linked += len(text.strip())

    for m in _MARKUP.finditer(page):
        said(page[at: m.start()])
        at = m.end()
        closing, tag, attributes = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            pieces.append("\n")
            continue
        block = tag in BLOCKS
        if block:
            close_block()
        if tag == "a":
            links = 0 if closing else 1
        if closing:
            if open_tags.get(tag):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        for ended in IMPLIED.get(tag, ()):
            if open_tags.get(ended):
                stop = SCOPE.get(ended, CONTAINERS)
                k = len(stack) - 1
                while stack[k][0] != ended and stack[k][0] not in stop:
                    k -= 1
                if stack[k][0] == ended:
                    while len(stack) > k:
                        pop()
        if tag in VOID or not block or attributes.rstrip().endswith("/"):
            continue
        above = stack[-1][1]
        place = above
        if tag in CONTAINERS or tag in NOISE_TAGS or attributes:
            shape, names, words, role = _names(attributes)
            spoken = tag in ("article", "main") or role == "main"
            inside = above.article or spoken
            suspect = 0.0 if tag in ("html", "body", "article", "main") else _suspicion(tag, names, words, role, inside)
            if tag in CONTAINERS or suspect:
                place = Container(xxhash.xxh3_64_intdigest(f"{above.key}/{tag}.{shape}") >> 1, above, suspect, above.depth + 1, spoken, article=inside)
                containers.append(place)
        stack.append((tag, place))
        open_tags[tag] = open_tags.get(tag, 0) + 1
    said(page[at:])
    close_block()
    settle(containers)
    return containers, blocks


def main_of_page(containers: list[Container], blocks: list[Block]) -> int:
    """Key of the deepest container that holds all text of the blocks that is not linked; below an article, their links too."""
    free, full = ({id(c): 0 for c in containers} for _ in range(2))
    for b in blocks:
        free[id(b.place)] += max(len(b.text) - b.linked, 0)
        full[id(b.place)] += len(b.text)
    by_key: dict[int, list] = {}
    told = 0
    for c in reversed(containers):
        inside = c.parent is not None and c.parent.article
        if c.parent is not None:
            free[id(c.parent)] += free[id(c)]
            full[id(c.parent)] += full[id(c)]
        if c.article and not inside:
            told += full[id(c)]
        have = by_key.setdefault(c.key, [0, 0, c.depth, False])
        have[0] += free[id(c)]
        have[1] += full[id(c)]
        have[3] |= inside
    top = containers[0]
    whole, what = (free[id(top)], 0) if free[id(top)] else (full[id(top)], 1)
    return max((depth, key) for key, (*held, depth, inside) in by_key.items() if held[what] == whole and (not inside or held[1] == told))[1]


def not_beside(containers: list[Container], blocks: list[Block], slot: int, least: float = 0.25) -> list[Block]:
    """Blocks in the host's main slot and between the containers around it; all if a share less than ``least`` of the page's unlinked text is in it."""
    within: dict[int, bool] = {}
    around: set[int] = set()
    for c in containers:
        within[id(c)] = c.key == slot or c.parent is not None and within[id(c.parent)]
        up = c.parent if c.key == slot else None
        while up is not None and id(up) not in around:
            around.add(id(up))
            up = up.parent
    free = [max(len(b.text) - b.linked, 0) for b in blocks]
    told = sum(n for n, b in zip(free, blocks, strict=True) if within[id(b.place)])
    return [b for b in blocks if within[id(b.place)] or id(b.place) in around] if told and told >= least * sum(free) else blocks


def main_text(page: str, main: int | None, fixed: frozenset[int], texts: frozenset[int] = frozenset(), slot: int | None = None) -> str:
    """Text of the slot ``main`` (None: the page's own) without the template's containers and text blocks, unless nothing else stands on the page,
    and without what is beside the host's main slot ``slot``."""
    containers, blocks = parse(page)
    dropped: dict[int, bool] = {}
    for c in containers:  # parents come first
        dropped[id(c)] = c.key in fixed or c.parent is not None and dropped[id(c.parent)]
    clean = [b for b in blocks if not b.place.noise]
    if slot is not None:
        clean = not_beside(containers, clean, slot)
    varying = [b for b in clean if not dropped[id(b.place)]]
    left = [b for b in varying if b.token not in texts] if texts else varying
    left = left or varying or clean
    if main is None:
        main = main_of_page(containers, left)
    state: dict[int, bool] = {}
    for c in containers:
        state[id(c)] = c.key == main or c.parent is not None and state[id(c.parent)]
    return "\n\n".join(b.text for b in left if state[id(b.place)])


def host_of(url: str | None) -> str:
    m = re.match(r"\s*[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", url or "")
    return m[1].lower() if m else ""


_SEEN = ("host string, path bigint, text bigint, noise boolean, depth int, pages bigint, times bigint, vector bigint, least bigint, most bigint, own bigint, "
         "spoken boolean, held bigint")
_SEEN_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int32()] + [pa.int64()] * 6 + [pa.bool_(), pa.int64()]


def occurrences(pages: DataFrame) -> DataFrame:
    """Per host and token (a container path, with ``text`` 0, or a text block in it), summed within each batch: the pages it is on, how often, its
    vector's hash, its text, whether it is an article or main element, and the unlinked text in it and in the containers below it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple[str, int, int, bool], list] = {}
            for number, url, page in zip(*(batch.column(c).to_pylist() for c in ("row_key", "url", "html")), strict=True):
                host = host_of(url)
                here: dict[tuple[int, int, bool], list] = {}
                containers, blocks = parse(page or "")
                below = {id(c): 0 if c.noise else c.own for c in containers}
                for c in reversed(containers):
                    if c.parent is not None:
                        below[id(c.parent)] += below[id(c)]
                for c in containers:
                    have = here.setdefault((c.key, 0, c.noise), [c.depth, 0, [], 0, False, 0])
                    have[1] += 1
                    have[2] += c.text
                    have[3] += c.own
                    have[4] |= c.spoken
                    have[5] += below[id(c)]
                for b in blocks:
                    if not b.place.noise:
                        here.setdefault((b.place.key, b.token, False), [b.place.depth, 0, [], 0, False, 0])[1] += 1
                for key, (depth, times, text, own, spoken, held) in here.items():
                    mark = xxhash.xxh3_64_intdigest(f"{number}:{times}") >> 1
                    said = 0 if key[1] else xxhash.xxh3_64_intdigest("\n".join(text)) >> 1
                    have = seen.setdefault((host, *key), [depth, 0, 0, 0, said, said, 0, False, 0])
                    have[1] += 1
                    have[2] += times
                    have[3] = (have[3] + mark) & 0x7FFFFFFFFFFFFFFF
                    have[4], have[5] = min(have[4], said), max(have[5], said)
                    have[6] += own
                    have[7] |= spoken
                    have[8] += held
            rows = [(*k, *v) for k, v in seen.items()]
            columns = list(zip(*rows, strict=True)) or [()] * len(_SEEN_TYPES)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, _SEEN_TYPES, strict=True)],
                                             names=[c.split()[0] for c in _SEEN.split(", ")])

    return pages.mapInArrow(run, _SEEN)


def templates(pages: DataFrame, share: float = 0.5, least_pages: int = 3, least_fixed: int = 8, least_text: int = 16, nested: float = 0.9) -> DataFrame:
    """host, fixed (paths of containers with the same text on every page), the number of equivalence classes, texts
    (tokens of template text) and slot (path of the article or main element that is the main slot).

    A class is valid if its paths stand on at least ``share`` of the host's pages and on ``least_pages``; a container's whole text that is to count as the
    template's is the same on at least ``least_fixed``. A text block is the template's if it stands on at least ``least_text`` and on a share ``nested`` of
    the pages of its container, which is to be on ``share`` of the host's: one sentence is weaker evidence than a container. The main slot is the deepest
    article or main element on ``share`` of the host's pages, of one page as well, that holds half of the host's unlinked text.
    """
    seen = (occurrences(pages).groupBy("host", "path", "text", "noise").agg(
        F.first("depth").alias("depth"), F.sum("pages").alias("pages"), F.sum("times").alias("times"), F.sum(F.col("vector").cast("decimal(38,0)")).alias("sum"),
        F.min("least").alias("least"), F.max("most").alias("most"), F.sum("own").alias("own"), F.bool_or("spoken").alias("spoken"), F.sum("held").alias("held"))
        .withColumn("vector", F.expr("pmod(sum, 9223372036854775808)")).drop("sum"))
    both = materialise(seen.where((F.col("text") == 0) | (F.col("pages") >= least_text)), "page_paths")
    seen = both.where("text = 0").drop("text")
    # Tokens with one occurrence vector are a class; a valid class keeps or loses its paths together.
    whole = seen.where("path = 0").select("host", F.col("pages").alias("all"), F.col("held").alias("told"))
    classes = (seen.groupBy("host", "vector").agg(F.max("pages").alias("support"), F.count("*").alias("paths"))
               .join(whole.drop("told"), "host").where((F.col("support") >= share * F.col("all")) & (F.col("support") >= least_pages)))
    valid = seen.join(classes, ["host", "vector"])
    same = ~F.col("noise") & (F.col("least") == F.col("most")) & (F.col("own") > 0)
    slots = valid.groupBy("host").agg(
        F.collect_set(F.when(same & (F.col("path") != 0) & (F.col("pages") >= least_fixed), F.col("path"))).alias("fixed"),
        F.bool_or(~F.col("noise") & ~same & (F.col("own") > 0)).alias("varies"), F.count_distinct("vector").alias("classes"))
    # Where nothing differs between the pages, sameness says nothing about the template.
    slots = slots.withColumn("fixed", F.when(F.col("varies"), F.col("fixed")))
    around = seen.where("not noise").select("host", "path", F.col("pages").alias("around"))
    often = both.where("text <> 0").select("host", "path", "text", "pages").join(whole, "host").where(F.col("pages") >= nested * share * F.col("all"))
    texts = (often.join(around, ["host", "path"]).where((F.col("pages") >= nested * F.col("around")) & (F.col("around") >= share * F.col("all")))
             .groupBy("host").agg(F.collect_set("text").alias("texts")))
    main = (seen.where("spoken and not noise and held > 0").join(whole, "host").where((F.col("pages") >= share * F.col("all")) & (2 * F.col("held") >= F.col("told")))
            .groupBy("host").agg(F.max(F.struct("depth", "held", "path"))["path"].alias("slot")))
    return (slots.join(texts, "host", "left").withColumn("texts", F.when(F.col("varies"), F.col("texts"))).drop("varies")
            .join(main, "host", "full"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row. ``pages`` is read twice."""
    narrow_batches(pages.sparkSession, 256)
    pages = pages.select("page_id", "url", "html")
    found = materialise(templates(pages.withColumn("row_key", F.monotonically_increasing_id())), "page_templates")
    host = F.arrow_udf(lambda urls: pa.array([host_of(u) for u in urls.to_pylist()], pa.string()), "string")
    told = pages.withColumn("host", host("url")).join(found, "host", "left")

    def text_of(*columns: pa.Array) -> pa.Array:
        return pa.array([main_text(p or "", None, frozenset(x or ()), frozenset(t or ()), s) for p, x, t, s in zip(*(c.to_pylist() for c in columns), strict=True)],
                        pa.string())

    out = told.select("page_id", "url", F.arrow_udf(text_of, "string")("html", "fixed", "texts", "slot").alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("bigint"))


def op1_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
