"""Main text of pages by wrappers: union-free regular expressions inferred for each host.

A page's tags form a stream of labels (tag and class words).  Neighbouring repeats of a run of
siblings fold into one repeated group, whatever its length.  Streams of one host are aligned
level by level: an element meets that of the same label and turn below the same parent; what
some pages lack is optional, and the text of an element is a slot that is fixed or varies.
What is kept of a slot (pages, characters, least and greatest hash of its text) adds up in any
order, so the engine aggregates slots and not pages: a host with a third of all pages is as
many rows as it has slots, and the wrapper doesn't depend on the order of its pages.

The finished wrapper names the host's main region: its article or main element, else the
element that holds most of the varying text outside menus, headers, footers, sidebars,
notices, adverts, forms and comments; most of a menu's text is in links.  A slot in the region
that reads the same on five pages or more, while the region varies, is the site's and not the
article's, unless it is a heading, a list item or a cell.  Every page's text comes from that
region; a page that doesn't have it is read by its own structure.

Defined cases: null, empty and tagless pages give the text outside all boilerplate, or the
empty text; a null url is a host of its own; unclosed and misplaced tags close where HTML
closes them; a quote that isn't closed ends with its word; tags nest to any depth; repeated
rows and further columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.llm import store

#: Slots held by a task before they are handed on, and hosts whose wrappers a task remembers.
SLOTS_HELD, HOSTS_HELD = 200_000, 5000
#: A slot counts for the region where so large a share of the host's pages has it.
COMMON = 0.2
#: Pages on which a slot must read the same to be the site's own, and their share of the host's pages.
FIXED_PAGES, FIXED_SHARE = 5, 0.8

# Element kinds of HTML.
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul head title noscript template iframe svg canvas video audio object select button textarea".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template svg math".split())
DROPPED_TAGS = set("head title script style nav footer aside form button select textarea noscript iframe template svg math canvas video audio object dialog menu header".split())
DROPPED_WORDS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr header "
    "masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promotion related "
    "replies reply respond share sharing sidebar sidenav signup social sponsor sponsored subscribe subscription toolbar topbar widget widgets alert disclaimer".split()
)
MAIN_WORDS = set("article content entry main post story maincontent articlebody postcontent entrycontent body-text".split())
P_ENDS = BLOCKS - {"html", "body", "head", "title"}
#: Elements whose text stays even where it is the same on every page.
OWN_WORDS = set("h1 h2 h3 h4 h5 h6 li dt dd td th caption summary pre".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)(>?)|[^<]+|<", re.S)
_ATTR = re.compile(r"[\s/]*(?:(>)|([^\s/>=]+|=)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?)")
_TELLING = ("class", "id", "role", "hidden")
_WORDS = re.compile(r"[a-z]+")


class Element:
    __slots__ = ("key", "kids", "label", "tag", "words")

    def __init__(self, tag: str, words: tuple[str, ...] = ()):
        self.tag, self.words, self.kids, self.key = tag, words, [], 0
        self.label = ".".join((tag, *words))


def _attributes(html: str, at: int) -> tuple[tuple[str, ...], bool, int]:
    """(words of class, id and role, whether the tag closes itself, end) of the attributes from ``at``.

    Numbers in names are left out, so that generated names agree.
    """
    words: list[str] = []
    begun = at
    while m := _ATTR.match(html, at):
        at = m.end()
        if m[1]:
            break
        name = m[2].lower()
        if name in _TELLING:
            if name == "hidden":
                words.append("hidden")
                continue
            value = (m[3] or m[4] or m[5] or "").lower()
            words += [w for w in _WORDS.findall(value) if w != "hidden"]
            words += [w.replace("-", "").replace("_", "") for w in value.split() if "-" in w or "_" in w]
    else:
        at = len(html)  # the tag isn't closed
    return tuple(dict.fromkeys(words)), html[begun : at - 1].rstrip().endswith("/"), at


def tree(html: str) -> Element:
    """Block elements with their kids: elements, and text as str.  Inline tags leave only their text; a link's is marked."""
    root = Element("#root")
    stack = [root]
    at, n = 0, len(html)
    while at < n and (m := _TOKEN.match(html, at)):
        at = m.end()
        tag = m[2]
        if tag is None:
            if m[0][0] != "<" or m[0] == "<":
                stack[-1].kids.append(m[0])
            continue
        tag = tag.lower()
        words, closed = (), False
        if not m[3]:
            words, closed, at = _attributes(html, at)
        if m[1]:
            if tag in BLOCKS:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        del stack[k:]
                        break
            elif tag in ("td", "th", "br"):
                stack[-1].kids.append(" ")
            elif tag == "a":
                stack[-1].kids.append(LINK_END)
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = end.end() if end else n
            continue
        if tag not in BLOCKS:
            if tag == "br" or tag in ("td", "th"):
                stack[-1].kids.append(" ")
            elif tag == "a":
                stack[-1].kids.append(LINK)
            continue
        if tag in P_ENDS and stack[-1].tag == "p":
            stack.pop()
        if tag in ("li", "dt", "dd", "tr"):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ("ul", "ol", "dl", "table", "menu"):
                    break
                if stack[k].tag == tag or {stack[k].tag, tag} == {"dt", "dd"}:
                    del stack[k:]
                    break
        element = Element(tag, words)
        stack[-1].kids.append(element)
        if tag not in VOID and not closed:
            stack.append(element)
    return root


class _Mark(str):
    __slots__ = ()


#: Where a link begins and ends; no text.
LINK, LINK_END = _Mark(), _Mark()


def dropped(e: Element, inside: bool) -> bool:
    """Menus, headers, footers and the like; a header inside the article is the article's own."""
    if e.tag in DROPPED_TAGS:
        return not (inside and e.tag == "header" and not DROPPED_WORDS.intersection(e.words) - {"header"})
    if inside and e.tag in ("h1", "h2", "h3", "h4", "h5", "h6", "p", "pre", "blockquote", "table", "ul", "ol", "li"):
        return bool({"hidden", "comment", "comments", "ad", "ads", "advert", "advertisement", "notice", "cookie", "share", "related", "newsletter", "sponsored", "promo"}.intersection(e.words))
    words = DROPPED_WORDS.intersection(e.words)
    return "hidden" in e.words or bool(words - {"header"} if inside else words)


def fold(labels: list[str]) -> list[list[int]]:
    """Siblings as slots in order, each with the places that it holds: neighbouring repeats of a run share its slots."""
    names, slots = list(labels), [[k] for k in range(len(labels))]
    size = 0
    while True:
        # a run can repeat only at a distance between two equal labels
        seen: dict[str, list[int]] = {}
        for k, x in enumerate(names):
            seen.setdefault(x, []).append(k)
        sizes = {b - a for at in seen.values() for a, b in zip(at, at[1:])} | {b - at[0] for at in seen.values() for b in at[1:]}
        size = min((x for x in sizes if x > size), default=0)
        if not size:
            return slots
        out_names, out_slots, k, n = [], [], 0, len(names)
        while k < n:
            times = 1
            if k + 2 * size <= n and names[k] == names[k + size]:
                run = names[k : k + size]
                while names[k + times * size : k + (times + 1) * size] == run:
                    times += 1
            if times > 1:
                for j in range(size):
                    out_names.append(names[k + j])
                    out_slots.append([x for t in range(times) for x in slots[k + t * size + j]])
                k += times * size
            else:
                out_names.append(names[k])
                out_slots.append(slots[k])
                k += 1
        names, slots = out_names, out_slots


# what is kept of a slot, by its key
PARENT, LABEL, DEPTH, PAGES, CHARS, LINKED, LEAST, MOST, PLACE, REPEATED = range(10)
_KEYS: dict[tuple, int] = {}


def _key(parent: int, label: str, turn: int) -> int:
    known = (parent, label, turn)
    if known not in _KEYS:
        if len(_KEYS) > SLOTS_HELD:
            _KEYS.clear()
        _KEYS[known] = xxhash.xxh64_intdigest(f"{parent}/{turn}/{label}", 7) >> 1
    return _KEYS[known]


def page_slots(root: Element) -> dict[int, list]:
    """The slots of one page; every element gets the key of its slot."""
    out: dict[int, list] = {}
    root.key = _key(0, root.label, 0)
    todo = [(root.key, 0, root.label, 0, 0, [root], False)]
    while todo:
        key, parent, label, depth, place, members, repeated = todo.pop()
        texts, linked = [], 0
        for e in members:
            inside, text = False, []
            for k in e.kids:
                if k is LINK or k is LINK_END:
                    inside = k is LINK
                elif isinstance(k, str):
                    text.append(k)
                    linked += len(k.strip()) if inside else 0
            texts.append(" ".join("".join(text).split()))
        own = "\n".join(texts)
        h = zlib.crc32(own.encode("utf-8", "surrogatepass"))
        out[key] = [parent, label, depth, 1, sum(map(len, texts)), linked, h, h, place, repeated]
        # the members' kids fold together, so that a repeated element has one set of slots
        slots: dict[tuple[str, int], tuple[list[Element], bool, int]] = {}
        for e in members:
            kids = [k for k in e.kids if isinstance(k, Element)]
            turns: dict[str, int] = {}
            for n, places in enumerate(fold([k.label for k in kids])):
                name = kids[places[0]].label
                turn = turns[name] = turns.get(name, -1) + 1
                held, again, first = slots.get((name, turn), ([], False, n))
                held += [kids[x] for x in places]
                slots[name, turn] = (held, again or len(places) > 1, first)
        for (name, turn), (held, again, n) in slots.items():
            k = _key(key, name, turn)
            for e in held:
                e.key = k
            todo.append((k, key, name, depth + 1, n, held, again))
    return out


def add(slots: dict[int, list], more: dict[int, list]) -> dict[int, list]:
    """Align ``more`` into ``slots``; any order of pages gives the same."""
    for key, x in more.items():
        have = slots.get(key)
        if have is None:
            slots[key] = list(x)
            continue
        for k in (PAGES, CHARS, LINKED, PLACE):
            have[k] += x[k]
        have[LEAST], have[MOST] = min(have[LEAST], x[LEAST]), max(have[MOST], x[MOST])
        have[REPEATED] |= x[REPEATED]
    return slots


# a wrapper as it is read: [label, optional, repeated, pages, characters, varies, kids, slots]
KIDS = 6


def nested(slots: dict[int, list]) -> list:
    """The wrapper of slots: kids in their usual order, those that some pages lack optional."""
    nodes, top = {}, None
    for key in sorted(slots, key=lambda k: (slots[k][DEPTH], slots[k][PLACE] / slots[k][PAGES], slots[k][LABEL], k)):
        x = slots[key]
        above = slots.get(x[PARENT])
        nodes[key] = [x[LABEL], above is not None and x[PAGES] < above[PAGES], bool(x[REPEATED]), x[PAGES], x[CHARS], x[LEAST] != x[MOST], [], slots]
        if above is not None:
            nodes[x[PARENT]][KIDS].append(nodes[key])
        elif top is None:
            top = nodes[key]
    return top


def page_wrapper(e: Element) -> list:
    return nested(page_slots(e))


def merge(a: list, b: list) -> list:
    """The wrapper of the pages of both."""
    return nested(add({k: list(x) for k, x in a[-1].items()}, b[-1]))


_ELEMENTS: dict[str, Element] = {}


def _element_of(label: str) -> Element:
    if label not in _ELEMENTS:
        if len(_ELEMENTS) > SLOTS_HELD:
            _ELEMENTS.clear()
        tag, *words = label.split(".")
        _ELEMENTS[label] = Element(tag, tuple(words))
    return _ELEMENTS[label]


def _rank(e: Element) -> int:
    if e.tag == "article":
        return 3
    if e.tag == "main" or "main" in e.words:
        return 2
    return 1 if e.tag in ("div", "section") and MAIN_WORDS.intersection(e.words) else 0


def main_region(slots: dict[int, list]) -> tuple[int, list[int]]:
    """(key of the main region, keys of the slots in it whose text is the site's own)."""
    down = sorted(slots, key=lambda k: (slots[k][DEPTH], k))
    top = down[0]
    live, kids = {top}, {}
    for key in down[1:]:
        parent = slots[key][PARENT]
        if parent in live and not dropped(_element_of(slots[key][LABEL]), False):
            live.add(key)
            kids.setdefault(parent, []).append(key)
    weight: dict[int, int] = {}
    for key in reversed(down):  # varying text that isn't in links, with all below
        if key in live:
            x = slots[key]
            own = max(0, x[CHARS] - x[LINKED]) if x[LEAST] != x[MOST] or x[PAGES] < 3 else 0
            weight[key] = own + sum(weight[k] for k in kids.get(key, ()))
    total = max(weight[top], 1)
    named = [(_rank(_element_of(slots[k][LABEL])), weight[k], slots[k][DEPTH], k) for k in live if weight[k] >= 0.2 * total and _rank(_element_of(slots[k][LABEL]))]
    if named:
        region = max(named)[3]
    else:  # down to the last element that holds most of the text
        region = top
        while heavy := max(((weight[k], k) for k in kids.get(region, ())), default=None):
            if heavy[0] < 0.7 * max(weight[region], 1) or _element_of(slots[heavy[1]][LABEL]).tag in ("p", "h1", "h2", "h3", "li", "pre"):
                break
            region = heavy[1]
    pages, inside, fixed = slots[top][PAGES], {region}, []
    if weight[region] and slots[region][PAGES] >= FIXED_PAGES:
        for key in down:
            x = slots[key]
            if x[PARENT] in inside:
                inside.add(key)
                if x[LEAST] == x[MOST] and x[CHARS] and x[PAGES] >= max(FIXED_PAGES, FIXED_SHARE * pages) and _element_of(x[LABEL]).tag not in OWN_WORDS:
                    fixed.append(key)
    return region, fixed


def regions(root: Element, key: int) -> list[Element]:
    """Elements of the page in the region's slot, in page order; more than one where it repeats."""
    found, todo = [], [root]
    while todo:
        e = todo.pop()
        if e.key == key:
            found.append(e)
        else:
            todo += [k for k in reversed(e.kids) if isinstance(k, Element)]
    return found


def blocks(e: Element, inside: bool, fixed: set[int]) -> list[str]:
    """Texts of the blocks in page order, without boilerplate and the slots in ``fixed``."""
    out: list[str] = []
    text: list[str] = []
    stack = [(e, iter(e.kids))]

    def close(owner: Element) -> None:
        if text:
            t = " ".join(unescape("".join(text)).split())
            if t and owner.key not in fixed:
                out.append(t)
            text.clear()

    while stack:
        owner, rest = stack[-1]
        for k in rest:
            if isinstance(k, str):
                text.append(k)
                continue
            close(owner)
            if not dropped(k, inside):
                stack.append((k, iter(k.kids)))
                break
        else:
            close(owner)
            stack.pop()
    return out


def main_text(html: str | None, found: tuple[int, list[int]] | None) -> str:
    root = tree(html or "")
    slots = page_slots(root)
    if found is None or found[0] not in slots:
        found = main_region(slots)
    fixed = set(found[1])
    return "\n".join(t for e in regions(root, found[0]) for t in blocks(e, e.tag in ("article", "main"), fixed))


HOST = "coalesce(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1), '')"
_SLOT = "host string, key bigint, parent bigint, label string, depth int, pages bigint, chars bigint, linked bigint, least bigint, most bigint, place bigint, repeated boolean"
_NAMES = [c.split()[0] for c in _SLOT.split(", ")]
_KINDS = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}


def _slot_batch(held: dict[str, dict[int, list]]) -> pa.RecordBatch:
    rows = [(host, key, *x) for host, slots in held.items() for key, x in slots.items()]
    cols = list(zip(*rows, strict=True)) or [()] * len(_NAMES)
    return pa.RecordBatch.from_pydict({c.split()[0]: pa.array(v, _KINDS[c.split()[1]]) for c, v in zip(_SLOT.split(", "), cols, strict=True)})


def _slots(batches):
    """Slots of a task's pages, added up by host."""
    held: dict[str, dict[int, list]] = {}
    n = 0
    for batch in batches:
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            mine = held.setdefault(host, {})
            n -= len(mine)
            n += len(add(mine, page_slots(tree(html or ""))))
            if n >= SLOTS_HELD:
                yield _slot_batch(held)
                held, n = {}, 0
    yield _slot_batch(held)


def wrappers(pages: DataFrame, html: str = "html") -> DataFrame:
    """Slots of each host's wrapper: those on ``COMMON`` of its pages or more, the others can't be its region."""
    rows = pages.select(F.expr(HOST).alias("host"), F.col(html).alias("html"))
    made = rows.mapInArrow(_slots, _SLOT)
    sums = [F.sum(c).alias(c) for c in ("pages", "chars", "linked", "place")]
    slots = made.groupBy("host", "key").agg(F.first("parent").alias("parent"), F.first("label").alias("label"), F.first("depth").alias("depth"), *sums, F.min("least").alias("least"), F.max("most").alias("most"), F.max("repeated").alias("repeated"))
    slots = store.materialize(slots.select(*_NAMES), "slots")
    total = slots.where("depth = 0").select("host", F.col("pages").alias("total"))
    return slots.join(total, "host").where(F.col("pages") >= COMMON * F.col("total")).select(*_NAMES)


def host_regions(slots: DataFrame) -> DataFrame:
    """(host, found): JSON of the main region and the site's own slots in it."""
    row = F.struct(*_NAMES[1:])
    hosts = slots.groupBy("host").agg(F.collect_list(row).alias("slots"))  # no more slots than some pages have

    def work(batches):
        for batch in batches:
            found = []
            for rows in batch.column("slots").to_pylist():
                found.append(json.dumps(main_region({r["key"]: [r[c] for c in _NAMES[2:]] for r in rows})))
            yield pa.RecordBatch.from_pydict({"host": batch.column("host"), "found": pa.array(found, pa.string())})

    return hosts.mapInArrow(work, "host string, found string")


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages without ``html``, plus ``text`` and ``n_chars``."""
    found = store.materialize(host_regions(wrappers(pages, html)), "wrappers")
    df = pages.drop("text", "n_chars", "host", "found").withColumn("host", F.expr(HOST))
    kept = [f for f in df.schema.fields if f.name not in ("host", html)]
    joined = df.join(found, "host", "left")

    def work(batches):
        parsed: dict[str | None, tuple | None] = {None: None}
        for batch in batches:
            texts = []
            for raw, told in zip(batch.column(html).to_pylist(), batch.column("found").to_pylist(), strict=True):
                if told not in parsed:
                    if len(parsed) > HOSTS_HELD:
                        parsed = {None: None}
                    parsed[told] = json.loads(told)
                texts.append(main_text(raw, parsed[told]))
            made = {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}
            yield pa.RecordBatch.from_pydict({f.name: batch.column(f.name) for f in kept} | made)

    had = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return joined.mapInArrow(work, had + "text string, n_chars bigint")


def op5_html_text(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
