"""What parts of made documents show, taken from their bytes in one pass: the facts that ``structure`` judges.

They equal those that ``structure`` takes from a part's elements; a part whose elements nobody else asks for is read
here, so that they leave neither its task nor Python.  A part that can't be parsed shows nothing (null).
"""

from __future__ import annotations

import hashlib
import json
import re
import xml.etree.ElementTree as ET
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

from folioloom.operators.markup import COUNTED, _local

# Names of bookmarks, millimetres of a twip, characters that no text may hold.
BOOKMARK, MM_PER_TWIP = r"^SourcePdfPage(\d+)$", 25.4 / 1440.0
FORBIDDEN = {"replacement_character": "�", "white_square": "□", "black_square": "■"}

BODY_FACTS = (
    "tokens binary, counts array<struct<feature:string,n:int>>, final struct<form:string,without_margins:string>, sizes array<struct<section:int,width_mm:double,height_mm:double>>, "
    "breaks int, sections int, numbers array<int>, leaders boolean, " + ", ".join(f"{name} boolean" for name in FORBIDDEN)
)
SETTINGS_FACTS = "updates boolean, kept_whole boolean"
MOST_SHARED = 4000  # bytes of a part whose reading is kept, as the next document may have it too

_LOOKED_AT = frozenset(("t", "br", "bookmarkStart", "tab", "cr", "sectPr", "body", "bottom"))
_FEATURES = {tag: name for name, tag in COUNTED.items()}
_NUMBERED, _DIGITS = re.compile(BOOKMARK, re.ASCII), re.compile("[0-9]+$")
# Texts between tags that are what they stand for; no tag, attribute or reference has such a piece between ">" and "<".
_TEXTS, _UNSHARED = re.compile(rb">([^<>&\"'\]\x00-\x08\x0b-\x1f\x7f]*)<"), re.compile(rb"<[!?]")
_MARKED = "T:\ue000"
_MARK = _MARKED[2:].encode()
_GAP = b">" + _MARK + b"<"
_SWITCH = {"1": True, "true": True, "on": True, "0": False, "false": False, "off": False}
_json = json.JSONEncoder(ensure_ascii=False, separators=(",", ":")).encode


def _attrs(e) -> dict[str, str]:
    return {_local(k): v for k, v in e.items()}


def _attr(e, name: str) -> str | None:
    found = None
    for k, v in e.items():
        if _local(k) == name:
            found = v  # as in _attrs, the last of a local name counts
    return found


@lru_cache(4096)
def _form(depth: int, tag: str, attrs: tuple) -> str:
    return f"{depth} {tag} {_json(dict(sorted(attrs)))}"


def _inside(e) -> list[tuple]:
    """(depth, element) of an element and all in it, in document order."""
    out, todo = [], [(0, e)]
    while todo:
        depth, x = todo.pop()
        out.append((depth, x))
        if len(x):
            todo += [(depth + 1, kid) for kid in x[::-1]]
    return out


@lru_cache(4096)
def _millimetres(twips: str | None) -> float | None:
    return float(twips) * MM_PER_TWIP if twips is not None and _DIGITS.match(twips) else None


def _sections(heads: list[tuple], bodies: list[tuple]):
    """The last section that stands right in the innermost body, as (form, form without margins), and each section's size."""
    parents = {kid: n for n, body in bodies for kid in body}
    final, sizes = None, []
    for k, (n, head) in enumerate(heads):
        rows = _inside(head)
        if k + 1 < len(heads):
            rows = rows[: heads[k + 1][0] - n]
        own, pages = [], []
        up = parents.get(head)
        for i, (depth, x) in enumerate(rows):
            tag = _local(x.tag)
            if tag == "pgSz":
                pages.append(_attrs(x))
            if up is not None and (len(bodies) == 1 or up == max(b for b, _ in bodies if b <= n + i)):
                own.append((tag, _form(depth, tag, tuple(_attrs(x).items()))))
        if own:
            final = ("\n".join([f for _, f in own]), "\n".join([f for tag, f in own if tag != "pgMar"]))
        most = lambda side: max([mm for p in pages if (mm := _millimetres(p.get(side))) is not None], default=None)  # noqa: E731, B023
        sizes.append((k + 1, most("w"), most("h")))
    return final, sizes


def _share_owner(root, dotted: list, led: list) -> bool:
    """Whether a dotted rule and a tab stop with a leader stand in one paragraph's own properties."""
    up = {kid: e for e in root.iter() for kid in e}

    def owners(found: list, holder: str) -> set:
        pairs = [(up.get(x), up.get(up.get(x))) for x in found]
        return {id(up[b]) for a, b in pairs if b in up and _local(a.tag) == holder and _local(b.tag) == "pPr"}

    return bool(owners(dotted, "pBdr") & owners(led, "tabs"))


def _read_body(content: bytes) -> tuple | None:
    """(tokens, the other values of BODY_FACTS up to the forbidden characters), or none of a part that can't be parsed."""
    try:
        root = ET.XML(content)
    except ET.ParseError:
        return None
    elements = list(root.iter())
    tags = [_local(e.tag) for e in elements]
    tokens, numbers, heads, bodies, dotted, led = [], [], [], [], [], []
    breaks = 0
    for n, tag in enumerate(tags):
        if tag not in _LOOKED_AT:
            continue
        e = elements[n]
        if tag == "t":
            tokens.append("T:" + (e.text or ""))
        elif tag == "br":
            kind = _attr(e, "type")
            tokens.append("BR:" + ("textWrapping" if kind is None else kind))
            breaks += kind == "page"
        elif tag == "bookmarkStart":
            name = _NUMBERED.match(_attr(e, "name") or "")
            if name:
                digits = name[1].lstrip("0") or "0"
                numbers.append(int(digits) if len(digits) < 11 and int(digits) < 1 << 31 else None)
        elif tag == "tab":
            tokens.append("TAB")
            led += [e] if _attr(e, "leader") is not None else []
        elif tag == "cr":
            tokens.append("CR")
        elif tag == "sectPr":
            heads.append((n, e))
        elif tag == "body":
            bodies.append((n, e))
        else:
            dotted += [e] if _attr(e, "val") == "dotted" else []
    counts = [(_FEATURES[tag], m) for tag, m in Counter(tags).items() if tag in _FEATURES]
    final, sizes = _sections(heads, bodies) if heads else (None, [])
    return tokens, (counts, final, sizes, breaks, len(heads), numbers, bool(dotted and led) and _share_owner(root, dotted, led))


@lru_cache(8192)
def _shape(markup: bytes) -> tuple | None:
    """As :func:`_read_body` of a part whose texts are ``markup``'s marks; with the places of tokens that are such a text, and which."""
    pieces = markup.split(_MARK)
    read = _read_body(b"".join(x for k, p in enumerate(pieces) for x in ((b"%s%d." % (_MARK, k - 1), p) if k else (p,))))
    if read is None:
        return None
    at = [(k, int(t[3:-1])) for k, t in enumerate(read[0]) if t.startswith(_MARKED)]
    return (*read, at)


def _by_shape(content: bytes) -> tuple | None:
    """As :func:`_read_body`: parts of one maker differ in their texts more than in their markup, which is parsed once."""
    pieces = _TEXTS.split(content)
    found = _shape(_GAP.join(pieces[::2]))
    if found is None:
        return None
    tokens, rest, at = found
    tokens = tokens.copy()
    for k, text in at:
        tokens[k] = "T:" + pieces[2 * text + 1].decode()
    return tokens, rest


def body_facts(content: bytes) -> tuple | None:
    """The values of BODY_FACTS."""
    plain = len(content) <= MOST_SHARED and content.isascii() and not _UNSHARED.search(content)
    read = (_by_shape if plain else _read_body)(content)
    if read is None:
        return None
    tokens, rest = read
    shown = _json(tokens)
    return (hashlib.sha256(shown.encode()).digest() if tokens else None, *rest, *[any(ch in t for t in tokens) if ch in shown else False for ch in FORBIDDEN.values()])


def settings_facts(content: bytes) -> tuple | None:
    """The values of SETTINGS_FACTS: each of its first element, null where there is none."""
    try:
        root = ET.XML(content)
    except ET.ParseError:
        return None

    def first(tag: str, default: bool) -> bool | None:
        for e in root.iter():
            if _local(e.tag) == tag:
                value = _attrs(e).get("val")
                return True if value is None else _SWITCH.get(value.lower(), default)
        return None

    return first("updateFields", True), first("doNotAutoCompressPictures", False)


@lru_cache(256)
def _shared(facts, content: bytes):
    return facts(content)


def reader(facts, shape: str):
    """An Arrow function of a column of bytes; parts of few bytes are read once while they recur."""
    kind = to_arrow_type(_parse_datatype_string(shape))

    def read(contents: pa.Array) -> pa.Array:
        raw = (b or b"" for b in contents.to_pylist())
        return pa.array([_shared(facts, b) if len(b) <= MOST_SHARED else facts(b) for b in raw], kind)

    return F.arrow_udf(read, shape)
