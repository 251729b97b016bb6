"""Structural verdict of made documents: tokens, counts, parts, sections, settings and print rules of one pass over elements.

Documents are the ``elements`` of their packages (see ``markup``), by path, best folded: a part's rules are then expressions over
its own row, and only what they find is shuffled, once.  A contract(path, source_locked, sample_flow, margins_free)
has a row a document; its pages(path, pos, number) are the source pages that it must cite in order.  A document without
a contract is judged by nothing but its tokens, counts and parts.  Violations are (rule_id, severity, key) with the path first
in the key.  A final section is one that stands right in the body; a package whose body has none breaks ``final_section``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioloom.functions.text import on_off
from folioloom.operators.body_facts import BODY_FACTS, BOOKMARK, FORBIDDEN, MM_PER_TWIP, SETTINGS_FACTS, body_facts, reader, settings_facts
from folioloom.operators.contracts import RowRule, all_violations, row_violations
from folioloom.operators.layout import is_a4
from folioloom.operators.markup import COUNTED, bodies, feature, fold, innermost, let, token
from folioloom.operators.merges import recurring_differences
from folioloom.operators.packages import broken_relationships

# Parts.
BODY, SETTINGS = "word/document.xml", "word/settings.xml"


def _tagged(e: Column, tag: str) -> Column:
    return F.filter(e, lambda x: x["tag"] == tag)


def _sections(e: Column) -> Column:
    """Section rows of a part's elements, in order."""

    def of(heads: Column, own: Column, k: Column, body: Column) -> Column:
        end = F.coalesce(F.get(heads, k + 1)["n"], F.size(e))
        after = F.slice(e, own["n"] + 2, end - own["n"] - 1)
        left = F.coalesce(F.array_min(F.transform(F.filter(after, lambda x: x["depth"] <= own["depth"]), lambda x: x["n"])), end)
        last = lambda x: F.coalesce(own["parent"] == innermost(body, x["n"]), F.lit(False))
        return F.transform(
            let(left, lambda stop: F.slice(e, own["n"] + 1, stop - own["n"])),
            lambda x: F.struct((k + 1).alias("section"), last(x).alias("last"), x["n"].alias("n"), (x["depth"] - own["depth"]).alias("depth"), x["tag"].alias("tag"), x["attrs"].alias("attrs")),
        )

    return let(bodies(e), lambda body: let(_tagged(e, "sectPr"), lambda heads: F.flatten(F.transform(heads, lambda own, k: of(heads, own, k, body)))))


def section_rows(elements: DataFrame) -> DataFrame:
    """(path, section, last, n, depth, tag, attrs): every element of every section's properties, itself included.

    ``depth`` counts from the section's element, ``section`` from 1, and ``last`` marks the body's own one.  What a section holds follows it
    directly in document order, until an element stands no deeper than it.
    """
    body = fold(elements.where(F.col("part") == BODY)).where("elements IS NOT NULL")
    return body.select("path", F.inline(_sections(F.col("elements"))))


def _millimetres(tag: Column, attrs: Column, name: str) -> Column:
    return F.when((tag == "pgSz") & attrs[name].rlike("^[0-9]+$"), attrs[name].cast("double") * MM_PER_TWIP)


def page_sections(rows: DataFrame) -> DataFrame:
    """(path, section, width_mm, height_mm, header, footer): a page size of digits only, and headers taken over from the section before."""
    attr = F.col("attrs")
    size = lambda a: F.max(_millimetres(F.col("tag"), attr, a))
    part = lambda tag: F.max(F.when((F.col("tag") == tag) & (F.coalesce(attr["type"], F.lit("default")) == "default"), attr["id"]))
    own = rows.groupBy("path", "section").agg(size("w").alias("width_mm"), size("h").alias("height_mm"), part("headerReference").alias("header"), part("footerReference").alias("footer"))
    before = Window.partitionBy("path").orderBy("section").rowsBetween(Window.unboundedPreceding, 0)
    return own.withColumns({c: F.last(c, ignorenulls=True).over(before) for c in ("header", "footer")})


def _sizes(rows: Column) -> Column:
    """(section, width_mm, height_mm) of section rows."""

    def of(pages: Column, k: Column) -> Column:
        most = lambda a: F.array_max(F.transform(F.filter(pages, lambda r: r["section"] == k), lambda r: _millimetres(r["tag"], r["attrs"], a)))
        return F.struct(k.alias("section"), most("w").alias("width_mm"), most("h").alias("height_mm"))

    return let(_tagged(rows, "pgSz"), lambda pages: F.transform(F.array_distinct(F.transform(rows, lambda r: r["section"])), lambda k: of(pages, k)))


def _final(rows: Column) -> Column:
    """The body's section as its elements in order, each with its attributes sorted: whole, and without margins; null where there is none."""
    lasts = F.filter(rows, lambda r: r["last"])
    own = let(F.array_max(F.transform(lasts, lambda r: r["section"])), lambda k: F.filter(lasts, lambda r: r["section"] == k))
    one = lambda r: F.concat_ws(" ", r["depth"], r["tag"], F.to_json(F.map_from_entries(F.sort_array(F.map_entries(r["attrs"])))))
    form = lambda kept: F.array_join(F.transform(kept, one), "\n")
    return F.when(F.size(own) > 0, F.struct(form(own).alias("form"), form(F.filter(own, lambda r: r["tag"] != "pgMar")).alias("without_margins")))


def _has_leaders(e: Column) -> Column:
    """Whether a paragraph has both a dotted rule below and a tab stop with a leader in its own properties."""

    def owners(tag: str, kept, up: str) -> Column:
        above = lambda x: F.get(e, x["parent"])
        found = F.filter(e, lambda x: (x["tag"] == tag) & kept(x["attrs"]) & (above(x)["tag"] == up) & (above(above(x))["tag"] == "pPr"))
        return F.transform(found, lambda x: above(above(x))["parent"])

    return F.coalesce(F.arrays_overlap(owners("bottom", lambda a: a["val"] == "dotted", "pBdr"), owners("tab", lambda a: a["leader"].isNotNull(), "tabs")), F.lit(False))


def _counts(e: Column) -> Column:
    """(feature, n) of the counted features that there are."""
    tags = F.filter(F.transform(e, lambda x: x["tag"]), lambda t: t.isin(*COUNTED.values()))
    return let(tags, lambda all_: F.transform(F.array_distinct(all_), lambda t: F.struct(feature(t).alias("feature"), F.size(F.filter(all_, lambda u: u == t)).alias("n"))))


def _number(name: Column) -> Column:
    return F.regexp_extract(name, BOOKMARK, 1).try_cast("int")


def _facts(elements: DataFrame) -> DataFrame:
    """A row a part: ``broken`` names one that can't be parsed, ``doc`` has what a body shows, ``own`` its settings.

    Tokens stand as the hash of their exact list, so that a document's text isn't shuffled.
    """
    e = F.col("elements")
    parts = fold(elements.where(F.col("part").isin(BODY, SETTINGS) | F.col("error").isNotNull()))
    body, settings = e.isNotNull() & (F.col("part") == BODY), e.isNotNull() & (F.col("part") == SETTINGS)
    first = lambda tag, default: F.get(F.transform(_tagged(e, tag), lambda x: on_off(F.lit(True), x["attrs"]["val"], default)), 0)
    tokens = F.filter(F.transform(e, lambda x: token(x["tag"], x["text"], x["attrs"])), lambda t: t.isNotNull())
    numbers = F.transform(F.filter(_tagged(e, "bookmarkStart"), lambda x: x["attrs"]["name"].rlike(BOOKMARK)), lambda x: _number(x["attrs"]["name"]))
    texts = _tagged(e, "t")
    rows = parts.withColumns({"sections": F.when(body, _sections(e)), "tokens": F.when(body, tokens)})
    return rows.select("path",
        F.when(F.col("error").isNotNull(), F.col("part")).alias("broken"),
        F.when(body, F.struct(
            F.when(F.size("tokens") > 0, F.unhex(F.sha2(F.to_json("tokens"), 256))).alias("tokens"), _counts(e).alias("counts"), _final(F.col("sections")).alias("final"), _sizes(F.col("sections")).alias("sizes"),
            F.size(F.filter(e, lambda x: (x["tag"] == "br") & (x["attrs"]["type"] == "page"))).alias("breaks"), F.size(_tagged(e, "sectPr")).alias("sections"), numbers.alias("numbers"), _has_leaders(e).alias("leaders"),
            *[F.coalesce(F.exists(texts, lambda x: F.contains(x["text"], F.lit(ch))), F.lit(False)).alias(name) for name, ch in FORBIDDEN.items()],  # noqa: B023
        )).alias("doc"),
        F.when(settings, F.struct(first("updateFields", True).alias("updates"), first("doNotAutoCompressPictures", False).alias("kept_whole"))).alias("own"),
    )


def _shown(expected: DataFrame, result: DataFrame, template: DataFrame, contract: DataFrame, pages: DataFrame) -> DataFrame:
    """A row a path with what its documents show and what it must: everything meets in one grouping."""
    want, have = _facts(expected), _facts(result)
    mold = want if template is expected else _facts(template)
    rows = [
        want.select("path", F.col("doc.tokens").alias("want_tokens"), F.col("doc.counts").alias("want_counts"), *([F.col("doc.final").alias("want_final")] if mold is want else [])),
        have.select("path", "broken", F.col("doc").alias("have"), "own"),
        contract.select("path", F.struct("source_locked", "sample_flow", "margins_free").alias("contract")),
        pages.select("path", F.struct("pos", "number").alias("page")),
    ]
    if mold is not want:
        rows.append(mold.select("path", F.col("doc.final").alias("want_final")))
    whole = rows[0]
    for more in rows[1:]:
        whole = whole.unionByName(more, allowMissingColumns=True)
    one = ("want_tokens", "want_counts", "want_final", "have", "own", "contract")
    numbers = F.transform(F.sort_array(F.collect_list("page")), lambda p: p["number"])
    return whole.groupBy("path").agg(*[F.max(c).alias(c) for c in one], F.collect_list("broken").alias("broken"), numbers.alias("pages"))


def _violations() -> Column:
    """Violations of a path's row, its features, parts and sections, as one array of (rule_id, severity, key)."""
    c, no, zero = F.col, F.lit(False), F.lit(0)
    have, own, contract_ = c("have"), c("own"), c("contract")
    n, counts = F.size("pages"), F.coalesce(c("want_counts"), F.array())
    had = F.coalesce(have["counts"], F.array())
    off = F.filter(F.when(counts == had, F.array()).otherwise(counts), lambda w: ~F.coalesce(F.exists(had, lambda h: (h["feature"] == w["feature"]) & (h["n"] == w["n"])), no))
    held, locked = contract_.isNotNull(), F.coalesce(contract_["source_locked"], no)
    bound = locked & ~F.coalesce(contract_["sample_flow"], no)
    lost = c("want_final").isNull() | have["final"].isNull()
    free = F.coalesce(contract_["margins_free"], no) & (c("want_final")["without_margins"] == have["final"]["without_margins"])
    numbers = F.coalesce(have["numbers"], F.array())
    rule = lambda name, broken: RowRule(name, held & broken)
    by_path = [
        RowRule("tokens", ~c("want_tokens").eqNullSafe(have["tokens"])),
        rule("final_section", lost), rule("section_differs", ~lost & (c("want_final")["form"] != have["final"]["form"]) & ~free),
        rule("source_pages", locked & (n == 0)),
        rule("page_breaks", bound & (F.coalesce(have["breaks"], zero) != F.greatest(n - 1, zero))),
        rule("sections", F.coalesce(have["sections"], zero) == 0),
        *[rule(name, have[name]) for name in FORBIDDEN],
        rule("settings", own.isNull()), rule("updates_fields", own.isNotNull() & F.coalesce(own["updates"], no)), rule("compresses_pictures", own.isNotNull() & ~F.coalesce(own["kept_whole"], no)),
        rule("leaders", F.coalesce(have["leaders"], no)),
        rule("bookmarks", bound & ~c("pages").eqNullSafe(numbers)),
    ]
    hit = lambda name, key: F.struct(F.lit(name).alias("rule_id"), F.lit("error").alias("severity"), key.cast("string").alias("key"))
    sizes = F.when(held, F.coalesce(have["sizes"], F.array()))
    far = lambda s: ~F.coalesce(is_a4(s["width_mm"], s["height_mm"]), F.lit(True))
    return F.concat(
        F.filter(F.array(*[F.when(r.violated, hit(r.rule_id, c("path"))) for r in by_path]), lambda v: v.isNotNull()),
        F.transform(off, lambda w: hit("counts", F.concat_ws("/", "path", w["feature"]))),
        F.transform("broken", lambda p: hit("malformed_part", F.concat_ws("/", "path", p))),
        F.transform(F.filter(F.coalesce(sizes, F.array()), lambda s: s["width_mm"].isNull() | s["height_mm"].isNull()), lambda s: hit("page_size", F.concat_ws("/", "path", s["section"]))),
        F.transform(F.filter(F.coalesce(sizes, F.array()), far), lambda s: hit("a4", F.concat_ws("/", "path", s["section"]))),
    )


def document_violations(documents: DataFrame) -> DataFrame:
    """(path, violations) of documents(path, expected, result, settings, contract, pages), a row each; nothing is shuffled.

    The first three are a part's bytes: of the expected body, which is the template as well, and of what was made, with null
    for settings that there aren't.  ``contract`` is a struct, ``pages`` the numbers in order, else as for :func:`structural_violations`.
    """
    body, settings = reader(body_facts, BODY_FACTS), reader(settings_facts, SETTINGS_FACTS)
    read = documents.select("path", "contract", "pages", body("expected").alias("want"), body("result").alias("have"), F.col("settings").isNotNull().alias("set"), settings("settings").alias("own_"))
    own, want = F.when(F.col("set"), F.col("own_")), F.col("want")
    torn = F.array(F.when(F.col("have").isNull(), F.lit(BODY)), F.when(F.col("set") & F.col("own_").isNull(), F.lit(SETTINGS)))
    shown = read.select("path", "contract", "pages", "have", own.alias("own"), want["tokens"].alias("want_tokens"), want["counts"].alias("want_counts"), want["final"].alias("want_final"), F.filter(torn, lambda p: p.isNotNull()).alias("broken"))
    return shown.select("path", _violations().alias("violations"))


def structural_violations(expected: DataFrame, result: DataFrame, template: DataFrame, contract: DataFrame, pages: DataFrame, rels: DataFrame | None = None, template_parts: DataFrame | None = None, parts: DataFrame | None = None) -> DataFrame:
    """Everything by which made documents differ from what was selected for them, from their template and from the print rules.

    ``expected``, ``result`` and ``template`` are elements by the made document's path, folded or not.  ``parts``(path, part, digest) and
    ``rels``(path, owner, id, target, mode) are the made packages', ``template_parts`` the templates'; each may be left out.
    A table given both as expected and as template is read once.
    """
    found = [_shown(expected, result, template, contract, pages).select(F.explode(_violations()).alias("v")).select("v.*")]
    if rels is not None and parts is not None:
        found.append(row_violations(broken_relationships(rels, parts), F.concat_ws("/", "path", "owner", "id"), [RowRule("broken_relationship", F.lit(True))]))
    if template_parts is not None and parts is not None:
        renamed = lambda df: df.withColumnRenamed("path", "doc")
        found.append(recurring_differences(renamed(template_parts), renamed(parts)))
    return all_violations(*found)
