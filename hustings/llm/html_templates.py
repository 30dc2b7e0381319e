"""Main text of web pages by the template their site shares.

Tokens of a page are its tags, each told apart by the elements it stands in, and the
pieces of text between them, with their place. Tokens of a host with the same
occurrence vector (how often they stand on each of its pages) form a class. A
class is valid if its tokens come in one order on all pages, again and again, and if
no other class cuts through it; a class lies in the gap of the one around it,
and the nested classes are the host's template. What stands in the gaps is the slots,
what a page has of its own.

From the slots comes the main text: those inside the article, as far as the
elements around a slot say so (``article``, then ``main``, then names of classes like
``entry-content``), without those in menus, headers, footers, sidebars, notices,
adverts, forms, scripts and comments. On sites that mark no article it is the
slot with most text outside of links and of such elements, and what is nested in it. Template text
(the same piece on every page of a host) is no slot; but where it makes up most of a host's articles, its
pages are copies of each other, and the text is taken as theirs. Hosts of fewer than
``MIN_PAGES`` pages, and pages without host, have no template; marks alone decide there.

Three scans of the pages: vectors (as sums of hashes, which combine in
each task), order and nesting of the classes, and slots. Pages are not
shuffled by host; what they are joined with is one row per host, which holds only tokens
on at least half of its pages, so at most twice the tokens of an average page.

Cases: null or empty html gives the empty text. Broken markup is read as browsers
do in the main: unclosed paragraphs end at the next block, unclosed comments and scripts run
to the end, stray closing tags mean nothing. Long pages take time in proportion to their length.
Repeated rows each get their row; an empty table gives an empty result. Extra columns pass through
:func:`extract`, whose added name steps aside.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import free_name, materialize, ship, slices

MIN_PAGES = 5
MIN_CLASS = 2
_SLICE = 8 << 20

# Elements by what they are in HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
_SCOPE = frozenset("html table td th caption object template button article aside section div body".split())
_RAW = frozenset("script style textarea title noscript iframe xmp".split())
_SIBLINGS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"),
}
_LISTS = frozenset("ul ol dl table select menu".split())

# Elements and names that are not part of an article. Those of the first set
# and of comments never hold one; the others may stand around it.
_CHROME = frozenset("head nav header footer aside menu dialog button select svg canvas object template".split())
_COMMENT_WORDS = frozenset("comment comments disqus replies respond".split())
_CHROME_WORDS = frozenset(
    "ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs consent cookie cookies copyright footer "
    "header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo "
    "related search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
_BODY_WORDS = frozenset("article articlebody content entry main post story".split())

CHROME, LINK, ARTICLE, MAIN, SOFT, FIRM = 1, 2, 4, 8, 16, 32
_TIERS = (ARTICLE, MAIN, SOFT)

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*')*+)>""")
_NAMED = re.compile(r"""(?<![\w-])(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_DIGITS = re.compile(r"\d+")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def host(url: Column) -> Column:
    """The lower-case host of a URL; null where there is none."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(found != "", found)


def _number(*parts) -> int:
    """A signed 64-bit hash, the same on every machine."""
    h = xxhash.xxh64_intdigest("\x1f".join(map(str, parts)).encode("utf-8", "replace"))
    return h - (1 << 64) if h >> 63 else h


@dataclass
class _Open:
    """An open element: its place as a hash of the elements around it, and what it means for text in it."""

    name: str
    place: int
    flags: int


def _means(name: str, attributes: str, flags: int) -> tuple[str, int]:
    """The element's name with its class and id, and the flags of text inside it."""
    words, label = set(), name
    for key, value in _NAMED.findall(attributes) if attributes else ():
        value = value.strip("\"'")
        label += f" {key.lower()}={_DIGITS.sub('0', value)}"
        words |= {w.lower() for w in _NAME_WORD.findall(value)}
    if name in _CHROME or words & _COMMENT_WORDS:
        return label, flags | CHROME | FIRM
    if name == "article" or (name != "body" and "articlebody" in {w.lower() for w in re.findall(r"itemprop=(\w+)", label)}):
        tier = ARTICLE
    elif name == "main" or "role=main" in label:
        tier = MAIN
    else:
        tier = SOFT if words & _BODY_WORDS and name not in ("html", "body") else 0
        if name == "form" or (words & _CHROME_WORDS and name not in ("html", "body")):
            return label, flags | CHROME
        return label, flags | tier | (LINK if name == "a" else 0)
    # An article may stand inside a form or a box with a name that tells little.
    return label, (flags if flags & FIRM else flags & ~CHROME) | tier


class Parser:
    """Pages as events; places are kept between pages, since the pages of a site share them."""

    def __init__(self):
        self.places: dict[tuple[int, str], int] = {}

    def place(self, parent: int, label: str) -> int:
        key = (parent, label)
        found = self.places.get(key)
        if found is None:
            if len(self.places) > 200_000:
                self.places.clear()
            found = self.places[key] = _number(parent, label)
        return found

    def events(self, page: str) -> list[tuple]:
        """``(token, None, 0, block)`` for tags and ``(token, text, flags, False)`` for text, in page order.

        ``block`` tells whether a tag parts blocks. Text is decoded.
        """
        out: list[tuple] = []
        stack = [_Open("", 0, 0)]
        open_names: dict[str, int] = defaultdict(int)
        last_gt, pos, n = page.rfind(">"), 0, len(page)

        def text(raw: str) -> None:
            top = stack[-1]
            decoded = entities.unescape(raw) if "&" in raw else raw
            plain = " ".join(decoded.split())
            out.append((self.place(top.place, "#" + plain) if plain else 0, decoded, top.flags, False))

        def pop_to(names: tuple[str, ...], stops: frozenset) -> None:
            """Close up to the nearest of ``names``, unless one of ``stops`` lies between."""
            for depth in range(len(stack) - 1, 0, -1):
                name = stack[depth].name
                if name in names:
                    for gone in stack[depth:]:
                        open_names[gone.name] -= 1
                    del stack[depth:]
                    return
                if name in stops:
                    return

        while pos < n:
            lt = page.find("<", pos)
            if lt < 0:
                text(page[pos:])
                break
            follows = page[lt + 1 : lt + 2]
            if not (follows.isascii() and follows.isalpha()) and follows not in ("/", "!", "?"):
                # A bare "<" is text, up to the next one.
                nxt = page.find("<", lt + 1)
                text(page[pos : nxt if nxt >= 0 else n])
                pos = nxt if nxt >= 0 else n
                continue
            if lt > pos:
                text(page[pos:lt])
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 4)
                pos = end + 3 if end >= 0 else n
                continue
            if lt > last_gt:
                break  # a tag that never ends
            match = _TAG.match(page, lt)
            if match is None:
                end = page.find(">", lt)
                plain = re.match(r"</?([a-zA-Z][^\s/>]*)", page[lt : min(end, lt + 64)])
                pos = end + 1
                if plain is None:
                    continue  # a declaration or nothing
                closing, name, attributes = page[lt + 1] == "/", plain[1].lower(), ""
            else:
                closing, name, attributes = bool(match[1]), match[2].lower(), match[3]
                pos = match.end()
            block = name not in _INLINE
            if closing:
                out.append((self.place(stack[-1].place, "/" + name), None, 0, block))
                if open_names[name]:
                    pop_to((name,), frozenset() if block else _CLOSES_P | _SCOPE)
                continue
            if name in _CLOSES_P and open_names["p"]:
                pop_to(("p",), _SCOPE)
            if name in _SIBLINGS and any(open_names[s] for s in _SIBLINGS[name]):
                if name == "tr":
                    pop_to(("tr",), frozenset(("table",)))
                else:
                    pop_to(_SIBLINGS[name], _LISTS | (frozenset(("tr",)) if name in ("td", "th") else frozenset()))
            label, flags = _means(name, attributes, stack[-1].flags)
            here = self.place(stack[-1].place, label)
            out.append((here, None, 0, block))
            if name in _RAW:
                end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, pos)
                if end is None:
                    break
                close = page.find(">", end.start())
                pos = close + 1 if close >= 0 else n
                out.append((self.place(here, "/" + name), None, 0, block))
            elif name == "br":
                out.append((0, " ", stack[-1].flags, False))
            elif name not in _VOID and not attributes.rstrip().endswith("/"):
                stack.append(_Open(name, here, flags))
                open_names[name] += 1
        return out


# ------------------------------------------------------------------ classes of a host


@dataclass
class _Walk:
    """One page against the classes of its host: where each piece of text lies, and what speaks against a class."""

    bad: set[int] = field(default_factory=set)
    orders: dict[int, list[int]] = field(default_factory=dict)
    parents: dict[int, set[tuple[int, int]]] = field(default_factory=lambda: defaultdict(set))
    slots: list[tuple[int, int]] = field(default_factory=list)


def _walk(events: list[tuple], class_of: dict[int, int], sizes: dict[int, int]) -> _Walk:
    """Follow the classes through a page; one slot ``(class, gap)`` per event, ``(0, 0)`` outside of all."""
    seen = _Walk()
    opened: list[list[int]] = []
    inside: set[int] = set()
    for token, *_ in events:
        own = class_of.get(token)
        if own is not None:
            if own in inside:
                while opened[-1][0] != own:  # these began inside and do not end there
                    cut = opened.pop()[0]
                    inside.discard(cut)
                    seen.bad.add(cut)
            else:
                seen.parents[own].add((opened[-1][0], opened[-1][1]) if opened else (0, 0))
                opened.append([own, 0])
                inside.add(own)
            order, at = seen.orders.setdefault(own, []), opened[-1][1]
            if at == len(order) and token not in order:
                order.append(token)
            elif at >= len(order) or order[at] != token:
                seen.bad.add(own)
            opened[-1][1] = at + 1
            if at + 1 >= sizes[own]:
                opened.pop()
                inside.discard(own)
        seen.slots.append((opened[-1][0], opened[-1][1]) if opened else (0, 0))
    seen.bad.update(c for c, _ in opened)
    return seen


_VECTORS = "host string, token bigint, n bigint, v1 bigint, v2 bigint, is_text boolean"


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and token: pages, and the occurrence vector as two sums of 31-bit hashes of (page, count)."""
    parser = Parser()
    for batch in slices(batches, "html", _SLICE):
        held: dict[tuple[str, int], list] = {}
        rows = zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("host", "html")), strict=True)
        for site, page in rows:
            own = xxhash.xxh64_intdigest(page.encode("utf-8", "replace"))
            counts: dict[int, int] = {0: 1}
            texts = set()
            for token, text, *_ in parser.events(page):
                if token:
                    counts[token] = counts.get(token, 0) + 1
                    if text is not None:
                        texts.add(token)
            mixed: dict[int, int] = {}
            for token, count in counts.items():
                mix = mixed.get(count)
                if mix is None:
                    mix = mixed[count] = xxhash.xxh64_intdigest(b"%d %d" % (own, count))
                sums = held.setdefault((site, token), [0, 0, 0, token in texts])
                sums[0] += 1
                sums[1] += mix & 0x7FFFFFFF
                sums[2] += mix >> 33
        columns = list(zip(*((h, t, *s) for (h, t), s in held.items()), strict=True))
        kinds = [pa.string(), *[pa.int64()] * 4, pa.bool_()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["host", "token", "n", "v1", "v2", "is_text"]
        )


_FACTS = (
    "host string, class bigint, gap int, bad bigint, order_low bigint, order_high bigint, "
    "parent bigint, parent_high bigint, parent_gap int, parent_gap_high int, chars bigint, template_chars bigint"
)


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host: what speaks against each class (``gap`` -1), and the text in each slot."""
    parser = Parser()
    for batch in slices(batches, "html", _SLICE):
        held: dict[tuple, list] = {}
        sites: dict[str, tuple] = {}
        columns = (batch.column(batch.schema.get_field_index(c)) for c in ("host", "html", "classes"))
        names, pages, classes = columns
        for i, (site, page) in enumerate(zip(names.to_pylist(), pages.to_pylist(), strict=True)):
            if site not in sites:
                sites[site] = _class_maps(classes[i].as_py())
            class_of, sizes, texts = sites[site]
            events = parser.events(page)
            seen = _walk(events, class_of, sizes)
            for own, order in seen.orders.items():
                sign = _number(*order)
                up = sorted(seen.parents[own])
                new = [int(own in seen.bad), sign, sign, up[0][0], up[-1][0], min(p[1] for p in up), max(p[1] for p in up), 0, 0]
                old = held.get((site, own, -1))
                held[site, own, -1] = new if old is None else [
                    old[0] + new[0], min(old[1], sign), max(old[2], sign), min(old[3], new[3]), max(old[4], new[4]),
                    min(old[5], new[5]), max(old[6], new[6]), 0, 0,
                ]
            for (token, text, flags, _), slot in zip(events, seen.slots, strict=True):
                if text is None or not token:
                    continue
                size = len(text)
                if not flags & (CHROME | LINK):
                    held.setdefault((site, *slot), [0] * 9)[7] += size
                if flags & (ARTICLE | MAIN | SOFT) and not flags & CHROME:
                    whole = held.setdefault((site, 0, -2), [0] * 9)
                    whole[7] += size
                    if token in texts:
                        whole[8] += size
        if held:
            rows = [(*key, *values) for key, values in held.items()]
            kinds = [pa.string(), pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in _FACTS.split(", ")])


def _class_maps(classes: list[dict] | None) -> tuple[dict[int, int], dict[int, int], set[int]]:
    """Class by token, size by class, and the tokens that are text."""
    class_of, sizes, texts = {}, {}, set()
    for c in classes or ():
        sizes[c["class"]] = len(c["tokens"])
        for t in c["tokens"]:
            class_of[t["token"]] = c["class"]
            if t["is_text"]:
                texts.add(t["token"])
    return class_of, sizes, texts


def templates(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per host of ``min_pages`` pages or more: its valid ``classes``, the slot they
    are nested in (``parent``, ``parent_gap``), and the text in its ``slots``.

    ``pages`` has ``host`` and ``html``, neither null.
    """
    counted = materialize(
        pages.mapInArrow(_vectors, _VECTORS)
        .groupBy("host", "token")
        .agg(F.sum("n").alias("n"), F.sum("v1").alias("v1"), F.sum("v2").alias("v2"), F.bool_or("is_text").alias("is_text"))
        .where("n >= 2 or token = 0"),
        "html-vectors",
    )
    sites = counted.where((F.col("token") == 0) & (F.col("n") >= min_pages)).select("host", F.col("n").alias("pages"))
    # On half of the pages at least; text on all of them.
    often = counted.where("token != 0").join(sites, "host").where(
        F.when(F.col("is_text"), F.col("n") == F.col("pages")).otherwise(2 * F.col("n") >= F.col("pages"))
    )
    classes = (
        often.groupBy("host", "n", "v1", "v2")
        .agg(F.array_sort(F.collect_list(F.struct("token", "is_text"))).alias("tokens"))
        .where(F.size("tokens") >= MIN_CLASS)
        .select("host", F.xxhash64("n", "v1", "v2").alias("class"), "tokens")
    )
    by_host = materialize(
        classes.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("class", "tokens"))).alias("classes")),
        "html-classes",
    )
    facts = materialize(
        pages.join(by_host, "host")
        .select("host", "html", "classes")
        .mapInArrow(_facts, _FACTS)
        .groupBy("host", "class", "gap")
        .agg(
            F.sum("bad").alias("bad"),
            F.min("order_low").alias("order_low"),
            F.max("order_high").alias("order_high"),
            F.min("parent").alias("parent"),
            F.max("parent_high").alias("parent_high"),
            F.min("parent_gap").alias("parent_gap"),
            F.max("parent_gap_high").alias("parent_gap_high"),
            F.sum("chars").alias("chars"),
            F.sum("template_chars").alias("template_chars"),
        ),
        "html-facts",
    )
    fixed = (F.col("parent") == F.col("parent_high")) & (F.col("parent_gap") == F.col("parent_gap_high"))
    fit = facts.where("gap = -1").select(
        "host",
        "class",
        ((F.col("bad") == 0) & (F.col("order_low") == F.col("order_high"))).alias("valid"),
        # A class that stands in different slots is nested in none.
        F.when(fixed, F.col("parent")).otherwise(0).alias("parent"),
        F.when(fixed, F.col("parent_gap")).otherwise(0).alias("parent_gap"),
    )
    slot = F.struct("class", "gap", "chars")
    text = facts.where("gap >= 0").groupBy("host").agg(F.array_sort(F.collect_list(slot)).alias("slots"))
    copies = facts.where("gap = -2").select("host", (2 * F.col("template_chars") > F.col("chars")).alias("copies"))
    listed = by_host.select("host", F.inline("classes")).join(fit.where("valid"), ["host", "class"])
    nested = listed.groupBy("host").agg(
        F.array_sort(F.collect_list(F.struct("class", "tokens", "parent", "parent_gap"))).alias("classes")
    )
    return nested.join(text, "host", "left").join(copies, "host", "left")


class _Site:
    """A host's template, ready to read its pages."""

    def __init__(self, classes: list[dict] | None, slots: list[dict] | None, copies: bool | None):
        self.class_of, self.sizes, self.texts = _class_maps(classes)
        if copies:
            self.texts = set()
        parent = {c["class"]: (c["parent"], c["parent_gap"]) for c in classes or ()}
        # Text in a class that turned out not to be valid counts for no slot.
        known = [s for s in slots or () if s["class"] in self.sizes]
        best = max(known, key=lambda s: (s["chars"], s["class"], s["gap"]), default=None)
        self.main = (best["class"], best["gap"]) if best else None
        self.parent = parent

    def in_main(self, slot: tuple[int, int]) -> bool:
        for _ in range(len(self.parent) + 1):
            if slot == self.main:
                return True
            if slot[0] not in self.parent:
                return False
            slot = self.parent[slot[0]]
        return False


def main_text(events: list[tuple], site: _Site | None) -> str:
    """The slots of a page that are its article, as blocks joined by a space."""
    template = site.texts if site else ()
    open_text = [not e[2] & CHROME for e in events]
    tier = next((t for t in _TIERS if any(o and e[0] and e[1] and e[2] & t for o, e in zip(open_text, events))), 0)
    if tier:
        keep = [o and bool(e[2] & tier) for o, e in zip(open_text, events)]
    elif site and site.main:
        slots = _walk(events, site.class_of, site.sizes).slots
        chosen: dict[tuple[int, int], bool] = {}
        for slot in slots:
            if slot not in chosen:
                chosen[slot] = site.in_main(slot)
        keep = [o and chosen[s] for o, s in zip(open_text, slots)]
        if not any(k and e[0] and e[1] for k, e in zip(keep, events)):
            keep = open_text  # not built like its site
    else:
        keep = open_text
    blocks, pieces = [], []
    for (token, text, _, block), wanted in zip(events, keep):
        if text is not None:
            if wanted and token not in template:
                pieces.append(text)
        elif block and pieces:
            blocks += "".join(pieces).split()
            pieces = []
    blocks += "".join(pieces).split()
    return " ".join(blocks)


def _extractor(names: dict[str, str]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser()
        for batch in slices(batches, names["html"], _SLICE):
            column = lambda c, b=batch: b.column(b.schema.get_field_index(names[c]))
            sites: dict[str | None, _Site | None] = {None: None}
            texts = []
            for i, (site, page) in enumerate(zip(column("host").to_pylist(), column("html").to_pylist(), strict=True)):
                if site not in sites:
                    held = [column(c)[i].as_py() for c in ("classes", "slots", "copies")]
                    sites[site] = _Site(*held) if held[0] else None
                texts.append(main_text(parser.events(page), sites[site]) if page else "")
            given = [k for k, f in enumerate(batch.schema.names) if f not in {names[c] for c in ("host", "classes", "slots", "copies")}]
            arrays = [batch.column(k) for k in given] + [pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[batch.schema.names[k] for k in given] + [names["text"]])

    return scan


def extract(
    pages: DataFrame, html_col: str = "html", url_col: str = "url", min_pages: int = MIN_PAGES
) -> tuple[DataFrame, str]:
    """``pages`` with the main text of each page added, and the name of the added column."""
    ship(pages.sparkSession)
    own = ("host", "classes", "slots", "copies", "text")
    names = {c: free_name(pages, c) for c in own} | {"html": html_col}
    site = host(F.col(f"`{url_col}`").cast("string"))
    read = pages.select(site.alias("host"), F.col(f"`{html_col}`").alias("html"))
    found = templates(read.where("host is not null and html is not null"), min_pages)
    found = materialize(found, "html-templates").select(*[F.col(c).alias(names[c]) for c in ("host", "classes", "slots", "copies")])
    schema = StructType([*pages.schema.fields, StructField(names["text"], StringType())])
    out = pages.withColumn(names["host"], site).join(found, names["host"], "left")
    out = out.select(*[F.col(f"`{c}`") for c in pages.columns], *[names[c] for c in ("host", "classes", "slots", "copies")])
    return out.mapInArrow(_extractor(names), schema), names["text"]


def digest(pages: DataFrame) -> DataFrame:
    """Per page: its main text and the length of it."""
    found, text = extract(pages.select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col(text).alias("text"), F.char_length(text).cast("bigint").alias("n_chars"))


#: The same for pages that mark their article by one element without other elements of
#: their own in it, as all of the given ones do: an independent reading of these tables.
ORACLE = r"""
with marked as (
  select page_id, url, coalesce(regexp_extract(html, '<article>(.*)</article>', 1, 's'), '') as a from pages
), block as (
  select page_id, url, list_transform(regexp_split_to_array(a, '</?(?:p|h1)>'), lambda b:
    trim(regexp_replace(
      regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        regexp_replace(replace(b, '<br>', ' '), '</?b>', '', 'g'),
        '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g'),
      '\s+', ' ', 'g'))) as blocks
  from marked
), joined as (
  select page_id, url, array_to_string(list_filter(blocks, lambda b: b <> ''), ' ') as text from block
)
select page_id, url, text, cast(length(text) as bigint) as n_chars from joined
"""
