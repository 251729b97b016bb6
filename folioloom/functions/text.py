"""Scalar text functions as Column expressions; the two that have no built-in are Arrow UDFs."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from folioloom.profile import DEFAULT, Profile

DEVANAGARI = "[\\x{0900}-\\x{097F}]"


@F.pandas_udf(StringType())
def nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


def sanitize_error(text: Column, profile: Profile = DEFAULT) -> Column:
    """Why a text is rejected, or null: NUL, replacement character, broken decoding."""
    return (
        F.when(F.contains(text, F.lit("\0")), "nul").when(F.contains(text, F.lit("�")), "replacement").when(text.rlike(profile.mojibake), "mojibake")
    )


def sanitize(text: Column, normalize: bool = True) -> Column:
    """No-break spaces to spaces, NFC, no zero-width marks, one blank between words, trimmed."""
    t = F.translate(text, " ​﻿", " ")
    t = nfc(t) if normalize else t
    return F.regexp_replace(F.regexp_replace(t, "[ \\t]+", " "), "(?U)^\\s+|\\s+$", "")


def script(text: Column) -> Column:
    return F.when(text.rlike(DEVANAGARI), "hindi").otherwise("latin")


def language_runs(text: Column, fallback: str | None = None) -> Column:
    """Maximal runs of one script as array of (text, language); blank gaps join the run before.

    One pattern finds whole runs: Devanagari with the blanks between and, at the end, after
    it; or anything up to the next Devanagari.
    """
    pattern = f"({DEVANAGARI}+(?:\\s+{DEVANAGARI}+)*(?:\\s+\\z)?|[^\\x{{0900}}-\\x{{097F}}]+)"
    one = lambda t, language: F.struct(t.alias("text"), language.alias("language"))
    runs = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda p: one(p, F.when(p.rlike(DEVANAGARI), F.lit("hindi")).otherwise(F.lit(fallback or "math"))))
    whole = F.filter(F.array(one(text, F.lit(fallback or "latin"))), lambda r: r["text"] != "")
    return F.when(text.rlike(DEVANAGARI), runs).otherwise(whole)


# Characters that take the script of what stands before them.
NEUTRAL = " \\t\\r\\n,.:;?!()₹%\\-0-9/\\\\"


def mixed_tokens(text: Column) -> Column:
    """Array of (text, type) where neutral characters belong to the token before; at the start they are latin."""
    pattern = f"({DEVANAGARI}[\\x{{0900}}-\\x{{097F}}{NEUTRAL}]*|[^\\x{{0900}}-\\x{{097F}}]+)"
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda p: F.struct(p.alias("text"), F.when(p.rlike("\\A" + DEVANAGARI), "hindi").otherwise("latin").alias("type")))


# Why a page's formulas may have lost their layout.
NOTATION, STACKED = "root, integral, summation, limit, or determinant notation", "a short split formula line that may be a stacked fraction"


def formula_reasons(text: Column) -> Column:
    """Array of the reasons that a text shows, each once."""
    def stacked(line: Column) -> Column:
        t = F.replace(F.regexp_replace(line, "(?U)^\\s+|\\s+$", ""), F.lit("\u200b"), F.lit(""))
        return F.length(t).between(2, 24) & t.rlike("^[0-9A-Za-z(){}+\\-−=./,\\s]+$") & t.rlike("[0-9]") & t.rlike("[+\\-−=/xy]")

    lines = F.split(text, "\r\n|[\n\r]")
    return F.array_compact(F.array(F.when(text.rlike("(?i)[√∑∫]|\\b(?:lim|det)\\b"), F.lit(NOTATION)), F.when(F.exists(lines, stacked), F.lit(STACKED))))


def is_unit_heading(line: Column, profile: Profile = DEFAULT) -> Column:
    return line.rlike(profile.unit_heading)


def is_type_heading(line: Column, profile: Profile = DEFAULT) -> Column:
    low = F.lower(line)
    return F.exists(F.array(*map(F.lit, profile.type_headings)), lambda t: F.contains(low, t))


def question(line: Column, profile: Profile = DEFAULT) -> Column:
    """(label, number, body, layout) of a line that opens a question, else null."""
    number = F.regexp_extract(line, profile.question, 1)
    body = F.trim(F.regexp_extract(line, profile.question, 2))
    n = number.cast("int")
    return F.when(number != "", F.struct(F.concat(F.lit("Q"), n.cast("string"), F.lit(".")).alias("label"), n.alias("number"), body.alias("body"), F.when(body == "", "standalone").otherwise("inline").alias("layout")))


def options(line: Column, profile: Profile = DEFAULT) -> Column:
    """Array of (label, column, text) of the options on a line; empty if other text comes first."""
    marked = F.regexp_replace(line, profile.option, "\u0001$0\u0002$1\u0001")
    parts = F.split(marked, "\u0001")  # text, anchor, text, anchor, text ...
    anchors = F.filter(F.transform(parts, lambda p, i: F.struct(i.alias("i"), p.alias("p"))), lambda s: s["i"] % 2 == 1)

    def before(i: Column) -> Column:
        return F.aggregate(F.slice(parts, 1, i), F.lit(0), lambda a, p: a + F.length(F.regexp_replace(p, "\u0002.$", "")))

    made = F.transform(
        anchors,
        lambda s: F.struct(F.upper(F.right(s["p"], F.lit(1))).alias("label"), before(s["i"]).alias("column"), F.trim(F.regexp_replace(F.get(parts, s["i"] + 1), "[ \\t]+", " ")).alias("text")),
    )
    return F.when(F.trim(F.get(parts, F.lit(0))) == "", made).otherwise(F.slice(made, 1, 0))


def option_columns(widest: Column) -> Column:
    return F.when(widest >= 4, 4).when(widest >= 2, 2).otherwise(1)


def is_answer_line(line: Column, profile: Profile = DEFAULT) -> Column:
    return line.rlike(profile.answer_line)


def is_separator(line: Column, profile: Profile = DEFAULT) -> Column:
    return F.trim(line).rlike(profile.separator)


def is_sparse(lines: Column, chars: Column, profile: Profile = DEFAULT) -> Column:
    return lines.between(1, profile.sparse_lines) & (chars <= profile.sparse_chars)


def stable_id(page: Column, ordinal: Column, kind: str = "q") -> Column:
    return F.format_string(f"{kind}-p%03d-%03d", page.cast("int"), ordinal.cast("int"))


def review_id(page: Column, kind: Column, ordinal: Column) -> Column:
    slug = F.regexp_replace(F.regexp_replace(F.lower(kind), "[^a-z0-9]+", "-"), "^-|-$", "")
    return F.format_string("review-p%03d-%s-%03d", page.cast("int"), slug, ordinal.cast("int"))


def source_page(source_id: Column) -> Column:
    return F.coalesce(F.regexp_extract(source_id, "(?i):p(\\d{1,6})$", 1).try_cast("int"), F.lit(0))


def page_type(text: Column, has_options: Column, profile: Profile = DEFAULT) -> Column:
    """The one page type that a text's words show, ``mixed`` for several, ``other`` for none."""
    low = F.lower(text)
    hits = []
    for name, words in profile.page_types:
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(low, F.lit(w))
        hits.append(F.when(hit | has_options if name == "mcq" else hit, F.lit(name)))
    found = F.array_compact(F.array(*hits))
    return F.when(F.size(found) > 1, "mixed").when(F.size(found) == 1, F.get(found, F.lit(0))).otherwise("other")


def heading_type(text: Column, profile: Profile = DEFAULT) -> Column:
    low = F.lower(text)
    out = None
    for name, words in profile.page_types:
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(low, F.lit(w))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def answer_lines(height: Column, profile: Profile = DEFAULT) -> Column:
    """(count, residual) of a ruled area of this height, halves to even; null if it doesn't fit the pitch."""
    n = F.rint(height / profile.answer_pitch)
    rest = F.abs(height - n * profile.answer_pitch)
    return F.when((n > 0) & (rest <= profile.pitch_slack), F.struct(n.cast("int").alias("count"), rest.alias("residual")))


def effective_dpi(width_px: Column, height_px: Column, width_in: Column, height_in: Column) -> Column:
    return F.least(width_px / width_in, height_px / height_in)


def dpi_passes(dpi: Column, profile: Profile = DEFAULT) -> Column:
    return dpi + profile.dpi_slack >= profile.least_dpi


def mm_to_twips(mm: Column) -> Column:
    return F.rint(mm * 1440 / 25.4).cast("long")


def side_margins(page: Column, inner: float, outer: float) -> Column:
    """(left, right): the inner margin is on the left of odd pages."""
    odd = page % 2 == 1
    return F.struct(F.when(odd, inner).otherwise(outer).alias("left"), F.when(odd, outer).otherwise(inner).alias("right"))


def is_legacy_font(name: Column, words: tuple[str, ...] = ("kruti", "devlys", "kundli")) -> Column:
    return F.coalesce(F.lower(name).rlike(f"\\b({'|'.join(words)})"), F.lit(False))


def upper_sha256(data: Column) -> Column:
    return F.upper(F.sha2(data, 256))


@dataclass(frozen=True)
class Glyphs:
    """A legacy glyph code: ordered pairs (code, text), and the codes that stand out of order.

    ``before`` is written before the consonant cluster that it follows in text; ``after`` is a
    reph, written after the cluster (and its vowel signs) that it comes before.  ``halves`` are
    half consonants, which ``stem`` completes; ``low`` may end a cluster.
    """

    pairs: tuple[tuple[str, str], ...]
    before: str = ""
    before_text: str = ""
    after: str = ""
    after_code: str = ""
    halves: str = ""
    stem: str = ""
    low: str = ""
    signs: str = ""


def _cluster(g: Glyphs) -> str:
    half = f"[{re.escape(g.halves)}]" if g.halves else "(?!)"
    stem = re.escape(g.stem) if g.stem else "(?!)"
    return f"(?:(?:{half}(?!{stem}))*(?:{half}{stem}|.){f'{re.escape(g.low)}?' if g.low else ''})"


def moved_back(t: str, mark: str, code: str, signs: str) -> str:
    """``t`` with every ``mark`` taken out and ``code`` put before the letter it follows, or before a letter and its sign.

    One pass: what has been read ends where a mark stands, so only its last letters move.  Marks at the very beginning stay.
    """
    first, *rest = t.split(mark)
    out = list(first)
    for part in rest:
        if not out:
            out += mark
        else:
            at = -2 if len(out) > 1 and out[-1] in signs else -1
            out[at:at] = code
        out += part
    return "".join(out)


def transliterator(glyphs: Glyphs | list[tuple[str, str]]):
    """Legacy glyph codes as Unicode text, in an Arrow UDF: signs are put in order, then each pair replaced in turn."""
    g = glyphs if isinstance(glyphs, Glyphs) else Glyphs(tuple(glyphs))
    early = re.compile(f"{re.escape(g.before)}({_cluster(g)})", re.S) if g.before else None

    def one(t: str) -> str:
        if early is not None:
            t = early.sub(lambda m: m[1] + g.before_text, t)
        if g.after and g.after in t:
            t = moved_back(t, g.after, g.after_code, g.signs)
        for old, new in g.pairs:
            t = t.replace(old, new)
        return t

    @F.pandas_udf(StringType())
    def convert(text: pd.Series) -> pd.Series:
        return text.map(one, na_action="ignore")

    return convert


def canonical_digest(value: Column) -> Column:
    """Upper-case SHA-256 of compact JSON, whose keys stand as the struct has them."""
    return F.upper(F.sha2(F.to_json(value, {"ignoreNullFields": "false"}), 256))


def on_off(present: Column, value: Column, default: bool = False) -> Column:
    """A switch: absent or of another word is the default, present without a value is on."""
    low = F.lower(value)
    return F.when(~present, F.lit(default)).when(value.isNull(), F.lit(True)).when(low.isin("1", "true", "on"), F.lit(True)).when(low.isin("0", "false", "off"), F.lit(False)).otherwise(F.lit(default))


def casefold_key(text: Column) -> Column:
    """Sort key without regard to case; sharp s counts as ss."""
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def file_number(name: Column) -> Column:
    """The last number in a file's name, by which rendered pages stand in order."""
    return F.regexp_extract(name, "(\\d+)\\D*$", 1).try_cast("int")
