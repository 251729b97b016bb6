"""Merging packages: ids, styles, fonts, content types and part names that may collide; comparison with an approved one.

Every table has a column ``doc``, so that any number of packages is merged at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioloom.operators.contracts import RowRule, all_violations, row_violations
from folioloom.operators.ordered import dealt
from folioloom.tables import written


def free_numbers(wanted: DataFrame, taken: DataFrame, keys: list[str], order: str) -> DataFrame:
    """wanted with ``number``: the k-th row of a key by ``order`` gets its k-th number from 1 that taken(*keys, number) leaves free."""
    k = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    ranked = wanted.withColumn("__k", k)
    taken = taken.select(*keys, "number").where("number >= 1").distinct()
    need = wanted.groupBy(*keys).agg(F.count("*").alias("__n")).join(taken.groupBy(*keys).agg(F.count("*").alias("__m")), keys, "left")
    room = need.select(*keys, F.explode(F.sequence(F.lit(1), (F.col("__n") + F.coalesce("__m", F.lit(0))).cast("int"))).alias("number"))
    room = room.join(taken, [*keys, "number"], "left_anti").withColumn("__k", F.row_number().over(Window.partitionBy(*keys).orderBy("number")))
    return ranked.join(room, [*keys, "__k"]).drop("__k")


def relationship_ids(referenced: DataFrame, rels: DataFrame, existing: DataFrame, prefix: str = "rIdSrc") -> DataFrame:
    """(doc, id, new_id, type, target, mode) of the relationships that a body refers to, with ids that are free."""
    used = referenced.select("doc", "id").distinct().join(rels.select("doc", "id", "type", "target", "mode"), ["doc", "id"])
    taken = existing.select("doc", F.regexp_extract("id", f"^{prefix}(\\d+)$", 1).try_cast("int").alias("number")).where("number IS NOT NULL")
    return free_numbers(used, taken, ["doc"], "id").select("doc", "id", F.concat(F.lit(prefix), F.col("number").cast("string")).alias("new_id"), "type", "target", "mode")


def missing_relationships(referenced: DataFrame, rels: DataFrame) -> DataFrame:
    return referenced.select("doc", "id").distinct().join(rels, ["doc", "id"], "left_anti")


def external_relationships(rels: DataFrame) -> DataFrame:
    return rels.where("mode = 'External'")


def style_merge(required: DataFrame, source: DataFrame, destination: DataFrame) -> DataFrame:
    """(doc, id, new_id, copied): a style that the destination lacks or has alike keeps its id, another is renamed.

    Tables are (doc, id) and (doc, id, digest); a required style that the source lacks is left out.
    """
    s = required.select("doc", "id").distinct().join(source.select("doc", "id", F.col("digest").alias("own")), ["doc", "id"])
    s = s.join(destination.select("doc", "id", F.col("digest").alias("there"), F.lit(True).alias("held")), ["doc", "id"], "left")
    differs = F.col("held") & ~F.col("own").eqNullSafe(F.col("there"))
    s = s.withColumn("differs", F.coalesce(differs, F.lit(False)))
    safe = F.regexp_replace("id", "[^A-Za-z0-9_]", "_")
    clash = s.where("differs").withColumn("base", F.concat(F.lit("src_"), F.when(safe == "", "Style").otherwise(safe)))
    ids = destination.select("doc", "id").unionByName(s.where("NOT differs").select("doc", "id")).distinct()
    # an id takes number 1 of its own name, and n of the name that it has a suffix to
    tail = F.regexp_extract("id", "^(.*)_(\\d+)$", 2)
    taken = ids.select("doc", F.col("id").alias("base"), F.lit(1).alias("number")).unionByName(
        ids.where(tail != "").select("doc", F.regexp_extract("id", "^(.*)_(\\d+)$", 1).alias("base"), tail.try_cast("int").alias("number")).where("number > 1")
    )
    named = free_numbers(clash, taken, ["doc", "base"], "id")
    renamed = named.select("doc", "id", F.when(F.col("number") == 1, F.col("base")).otherwise(F.concat("base", F.lit("_"), F.col("number").cast("string"))).alias("new_id"), F.lit(True).alias("copied"))
    kept = s.where("NOT differs").select("doc", "id", F.col("id").alias("new_id"), F.col("held").isNull().alias("copied"))
    return kept.unionByName(renamed)


def _cut(part) -> tuple:
    """Stem and extension of a part's name."""
    cut = "(?s)^(.*?)(\\.[^./]*)?\\z"
    return F.regexp_extract(part, cut, 1), F.regexp_extract(part, cut, 2)


def _numbered(df: DataFrame) -> DataFrame:
    """df with (of, suffix, number) of names ``<of>_src<number><suffix>``; the number is null for others."""
    stem, suffix = _cut("part")
    tail = "(?s)^(.*)_src(\\d+)\\z"
    return df.withColumns({"of": F.regexp_extract(stem, tail, 1), "suffix": suffix, "number": F.regexp_extract(stem, tail, 2).try_cast("int")})


def part_names(parts: DataFrame, destination: DataFrame) -> DataFrame:
    """(doc, part, new_part, copied): a part that is there byte for byte is reused, one that differs gets a free ``_srcN``."""
    p = parts.select("doc", "part", "digest").join(destination.select("doc", "part", F.col("digest").alias("there"), F.lit(True).alias("held")), ["doc", "part"], "left")
    p = p.withColumn("differs", F.coalesce(F.col("held") & ~F.col("digest").eqNullSafe(F.col("there")), F.lit(False)))
    stem, suffix = _cut("part")
    clash = p.where("differs").withColumn("stem", stem).withColumn("suffix", suffix)
    names = destination.select("doc", "part").unionByName(p.where("NOT differs").select("doc", "part"))
    taken = _numbered(names).select("doc", F.col("of").alias("stem"), "suffix", "number")
    named = free_numbers(clash, taken.where("number IS NOT NULL"), ["doc", "stem", "suffix"], "part")
    renamed = named.select("doc", "part", F.concat("stem", F.lit("_src"), F.col("number").cast("string"), "suffix").alias("new_part"), F.lit(True).alias("copied"))
    return p.where("NOT differs").select("doc", "part", F.col("part").alias("new_part"), F.col("held").isNull().alias("copied")).unionByName(renamed)


#: Parts, relationships and roots of a package, with the destination's parts, that are one row; more are followed in rounds.
PACKAGE_ROWS = 250


def _reached(steps: DataFrame, roots: DataFrame) -> DataFrame:
    """(doc, part, round) of the parts that steps(doc, owner, part) lead to from the roots, which are of round 1."""
    fresh = known = written(roots.withColumn("round", F.lit(1)), "round")
    k = 1
    while not fresh.isEmpty():
        k += 1
        found = steps.join(fresh.select("doc", F.col("part").alias("owner")), ["doc", "owner"], "left_semi").select("doc", "part").distinct()
        fresh = written(found.join(known.select("doc", "part"), ["doc", "part"], "left_anti").withColumn("round", F.lit(k)), "round")
        known = known.unionByName(fresh)
        if k % 16 == 0:  # a plan of few tables, however deep the package
            known = written(known, "round")
    return known


def _reached_within(leads: Column, parts: Column, roots: Column) -> Column:
    """Array of (part, round) as of :func:`_reached`, of one package whose tables are arrays."""
    keys = F.transform(parts, lambda p: p["part"])
    at = lambda now: F.transform(now["fresh"], lambda p: F.struct(p.alias("part"), now["round"].alias("round")))
    none = F.array().cast("array<struct<part:string,round:int>>")
    start = F.struct(none.alias("known"), F.array_intersect(roots, keys).alias("fresh"), F.lit(1).alias("round"))

    def step(now: Column, _: Column) -> Column:
        led = F.transform(F.filter(leads, lambda e: F.array_contains(now["fresh"], e["owner"])), lambda e: e["part"])
        new = F.array_except(led, F.concat(F.transform(now["known"], lambda f: f["part"]), now["fresh"]))
        then = F.struct(F.concat(now["known"], at(now)).alias("known"), F.array_intersect(new, keys).alias("fresh"), (now["round"] + 1).alias("round"))
        return F.when(F.size(now["fresh"]) == 0, now).otherwise(then)

    # each round but the first takes a relationship at least
    return F.aggregate(leads, start, step, lambda now: F.concat(now["known"], at(now)))


def _found_in_rounds(parts: DataFrame, leads: DataFrame, roots: DataFrame, destination: DataFrame) -> DataFrame:
    """As :func:`_found`, for packages of any size."""
    parts = written(parts, "parts")
    keys = parts.select("doc", "part")
    steps = written(leads.join(keys, ["doc", "part"], "left_semi"), "steps")
    nodes = parts.join(_reached(steps, roots.distinct().join(keys, ["doc", "part"], "left_semi")), ["doc", "part"])
    there = destination.select("doc", "part", F.col("digest").alias("there"), F.lit(True).alias("held"))
    return nodes.join(there, ["doc", "part"], "left").select("doc", "part", "digest", "round", F.col("held").isNotNull().alias("held"), "there")


def _found(parts: DataFrame, leads: DataFrame, roots: DataFrame, destination: DataFrame) -> DataFrame:
    """(doc, part, digest, round, held, there) of the parts that come along, and what the destination holds under their names.

    A package of up to PACKAGE_ROWS rows becomes one row, in one shuffle, and is followed in there.  Larger ones
    are followed round by round over all of them, so that none is ever held whole.
    """
    tables = {"part": parts.select("doc", "part", "digest"), "lead": leads.select("doc", "owner", "part"), "root": roots.select("doc", "part"), "there": destination.select("doc", "part", "digest")}
    tables = {kind: df.where("doc IS NOT NULL") for kind, df in tables.items()}
    docs = tables["part"].select("doc").unionAll(tables["lead"].select("doc")).unionAll(tables["root"].select("doc")).unionAll(tables["there"].select("doc"))
    sizes = docs.groupBy("doc").agg(F.count("*").alias("n"))
    n_rows, most = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    small, large = tables, None
    if most > PACKAGE_ROWS:
        over = written(sizes.where(F.col("n") > PACKAGE_ROWS).select("doc"), "large")
        small = {kind: df.join(over, "doc", "left_anti") for kind, df in tables.items()}
        large = _found_in_rounds(*[df.join(over, "doc", "left_semi") for df in tables.values()])
    rows = None
    for kind, df in small.items():
        df = df.withColumn("kind", F.lit(kind))
        rows = df if rows is None else rows.unionByName(df, allowMissingColumns=True)
    of = lambda kind, row: F.collect_list(F.when(F.col("kind") == kind, row)).alias(kind)
    held = F.struct("part", "digest")
    packs = dealt(rows, ["doc"], n_rows).groupBy("doc").agg(of("part", held), of("lead", F.struct("owner", "part")), of("root", F.col("part")), of("there", held))
    named = lambda kind, f: F.filter(kind, lambda p: p["part"] == f["part"])
    met = F.transform(_reached_within(F.col("lead"), F.col("part"), F.col("root")), lambda f: F.struct(f["part"].alias("part"), f["round"].alias("round"), named("part", f).alias("own"), named("there", f).alias("there")))
    met = packs.select("doc", F.inline(met)).select("doc", "part", "round", F.explode("own").alias("own"), "there").select("doc", "part", "round", "own", F.explode_outer("there").alias("there"))
    met = met.select("doc", "part", F.col("own.digest").alias("digest"), "round", F.col("there").isNotNull().alias("held"), F.col("there.digest").alias("there"))
    return met if large is None else met.unionByName(large)


def _round_names(found: DataFrame, destination: DataFrame) -> DataFrame:
    """(doc, part, new_part, copied, round) of parts as :func:`_found` gives them, as :func:`part_names` would name them round by round.

    Only the part ``<stem><suffix>`` can be renamed to a ``<stem>_srcN<suffix>``, so the numbers that it finds taken are known
    beforehand: the destination's, and those of parts of its own and earlier rounds.  What is left are parts whose own
    name was given to another in a round before, which are followed from one to the next; nearly always there are none.
    """
    clash = F.col("held") & ~F.col("digest").eqNullSafe(F.col("there"))
    met = written(_numbered(found.select("doc", "part", "digest", "round", "held", clash.alias("clash"))), "met")
    taken = _numbered(destination.select("doc", "part", F.lit(0).alias("since"))).unionByName(met.select("doc", "part", F.col("round").alias("since"), "of", "suffix", "number"))
    taken = taken.where("number >= 1").select("doc", F.col("of").alias("stem"), F.col("suffix").alias("end"), F.col("number").alias("n"), "since")
    stem, end = _cut("part")
    moving = met.where("clash OR number IS NOT NULL").withColumns({"stem": stem, "end": end})
    family, own = ["doc", "stem", "end"], ["part", "digest", "round", "held", "clash", "number"]
    moving, taken = (dealt(df, family, met.count()) for df in (moving.select(*family, *own), taken))
    seen = moving.join(taken, family, "left").withColumn("n", F.when(F.col("since") <= F.col("round"), F.col("n"))).select(*family, *own, "n").distinct()
    # the least free number follows the last of those that stand in their own place
    place = F.row_number().over(Window.partitionBy(*family).orderBy(F.col("n").asc_nulls_last()))
    free = F.coalesce(F.max(F.when(F.col("n") == F.col("place"), F.col("place"))), F.lit(0)) + 1
    moving = seen.withColumn("place", place).groupBy(*family, *own).agg(free.alias("free"))
    moving = written(moving.select("doc", *own, F.concat("stem", F.lit("_src"), F.col("free").cast("string"), "end").alias("renamed")), "moving")
    givers = moving.select("doc", F.col("renamed").alias("part"), F.col("part").alias("by"), F.col("digest").alias("given"), F.col("round").alias("at"), F.col("clash").alias("sure"))
    numbered = written(moving.where("number IS NOT NULL"), "numbered")  # mostly few, which the planner can tell of a table
    hits = numbered.join(givers, ["doc", "part"]).where("at < round")
    hits = written(hits.select("doc", "part", "by", "sure", (~F.col("digest").eqNullSafe(F.col("given"))).alias("differs")), "hits")
    struck = fresh = hits.where("sure").select("doc", "part", "differs")
    while not fresh.isEmpty():
        fresh = written(hits.join(fresh.where("differs").select("doc", F.col("part").alias("by")), ["doc", "by"], "left_semi").select("doc", "part", "differs"), "struck")
        struck = struck.unionByName(fresh)
    moving = moving.join(struck, ["doc", "part"], "left")
    clash = F.col("clash") | F.coalesce("differs", F.lit(False))
    named = moving.select("doc", "part", F.when(clash, F.col("renamed")).otherwise(F.col("part")).alias("new_part"), (clash | ~(F.col("held") | F.col("differs").isNotNull())).alias("copied"), "round")
    return met.where("NOT clash AND number IS NULL").select("doc", "part", F.col("part").alias("new_part"), (~F.col("held")).alias("copied"), "round").unionByName(named)


def part_closure(parts: DataFrame, rels: DataFrame, roots: DataFrame, destination: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What comes along with the parts that a body refers to: (names, relationships, missing).

    Tables are parts(doc, part, digest), rels(doc, owner, id, part, mode) with targets as part names,
    roots(doc, part), destination(doc, part, digest).  A round takes the parts that the last one's
    internal relationships lead to and that have no name yet, and names them as :func:`part_names` does,
    among the destination's parts and all that were named in rounds before; a part is named once, so
    cycles end.  ``names``: (doc, part, new_part, copied, round); ``relationships``: (doc, owner, id,
    part) of the copies, under their new names; ``missing``: (doc, part, owner) of targets that are no
    part, the roots' owner being null.  Parts are found first (:func:`_found`) and named afterwards, all
    rounds at once.  Null part names lead nowhere.  Tables but ``rels`` are read more than once.
    """
    inner = rels.where("coalesce(mode, 'Internal') <> 'External' AND part IS NOT NULL")
    leads = written(inner.select("doc", "owner", "id", "part"), "leads")
    keys, begun = parts.select("doc", "part"), roots.where("part IS NOT NULL").select("doc", "part")
    names = _round_names(_found(parts, leads, begun, destination), destination)
    moved = names.select("doc", F.col("part").alias("owner"), F.col("new_part").alias("new_owner"))
    targets = leads.join(moved, ["doc", "owner"]).join(names.select("doc", "part", F.col("new_part").alias("new_target")), ["doc", "part"], "left")
    relationships = targets.where("new_target IS NOT NULL").select("doc", F.col("new_owner").alias("owner"), "id", F.col("new_target").alias("part"))
    # a copy leads to a part that was reached, or to none
    lost = begun.join(keys, ["doc", "part"], "left_anti").withColumn("owner", F.lit(None).cast("string"))
    missing = targets.where("new_target IS NULL").select("doc", "part", "owner").unionByName(lost).distinct()
    return names, relationships, missing


def font_merge(required: DataFrame, source: DataFrame, destination: DataFrame) -> DataFrame:
    """(doc, name, definition, action): the destination's fonts, those required and found replaced or added.

    Required names of a theme (+name) and names that the source lacks change nothing.
    """
    wanted = required.where(~F.col("name").startswith("+")).select("doc", "name").distinct()
    new = source.join(wanted, ["doc", "name"], "left_semi").select("doc", "name", F.col("definition").alias("new"), F.lit(True).alias("has"))
    both = destination.select("doc", "name", F.col("definition").alias("old"), F.lit(True).alias("had")).join(new, ["doc", "name"], "full_outer")
    action = F.when(F.col("has").isNull(), "kept").when(F.col("had").isNull(), "added").otherwise("replaced")
    return both.select("doc", "name", F.when(F.col("has"), F.col("new")).otherwise(F.col("old")).alias("definition"), action.alias("action"))


def content_types(parts: DataFrame, source: DataFrame, destination: DataFrame) -> DataFrame:
    """(doc, kind, key, type) to add for parts(doc, part, new_part): an override by name, a default by extension, only where none is."""
    over = source.where("kind = 'override'").select("doc", F.col("key").alias("part"), "type")
    named = parts.join(over, ["doc", "part"]).select("doc", F.lit("override").alias("kind"), F.col("new_part").alias("key"), "type")
    ends = parts.select("doc", F.lower(F.regexp_extract("new_part", "\\.([^./]+)$", 1)).alias("key")).where("key <> ''").distinct()
    default = lambda df: df.where("kind = 'default'").select("doc", F.lower("key").alias("key"), "type")
    by_end = ends.join(default(source), ["doc", "key"]).groupBy("doc", "key").agg(F.min("type").alias("type")).select("doc", F.lit("default").alias("kind"), "key", "type")
    there = destination.select("doc", "kind", F.when(F.col("kind") == "default", F.lower("key")).otherwise(F.col("key")).alias("key"))
    return named.unionByName(by_end).join(there, ["doc", "kind", "key"], "left_anti").distinct()


def token_differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(rule_id, severity, key) of documents whose tokens (doc, n, token) aren't the expected ones in order."""
    e, a = expected.select("doc", "n", F.col("token").alias("e")), actual.select("doc", "n", F.col("token").alias("a"))
    off = e.join(a, ["doc", "n"], "full_outer").where(~F.col("e").eqNullSafe(F.col("a"))).select("doc").distinct()
    return off.select(F.lit("tokens").alias("rule_id"), F.lit("error").alias("severity"), F.col("doc").cast("string").alias("key"))


def count_differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(rule_id, severity, key) of each feature (doc, feature, n) whose count differs."""
    e, a = expected.select("doc", "feature", F.col("n").alias("e")), actual.select("doc", "feature", F.col("n").alias("a"))
    off = e.join(a, ["doc", "feature"], "left").where(~F.col("e").eqNullSafe(F.col("a")))
    return off.select(F.lit("counts").alias("rule_id"), F.lit("error").alias("severity"), F.concat_ws("/", "doc", "feature").alias("key"))


def recurring_differences(approved: DataFrame, candidate: DataFrame) -> DataFrame:
    """(rule_id, severity, key) of headers and footers (doc, part, digest) that the candidate hasn't byte for byte."""
    own = approved.where(F.col("part").rlike("^word/(?:header|footer)")).select("doc", "part", F.col("digest").alias("e"))
    off = own.join(candidate.select("doc", "part", F.col("digest").alias("a")), ["doc", "part"], "left").where(~F.col("e").eqNullSafe(F.col("a")))
    return off.select(F.lit("recurring_part").alias("rule_id"), F.lit("error").alias("severity"), F.concat_ws("/", "doc", "part").alias("key"))


def regression(tokens: tuple[DataFrame, DataFrame], counts: tuple[DataFrame, DataFrame], parts: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Differences of a candidate from what was approved: each pair is (approved, candidate)."""
    return all_violations(token_differences(*tokens), count_differences(*counts), recurring_differences(*parts))


def render_manifest_violations(manifests: DataFrame, files: DataFrame) -> DataFrame:
    """Rules of manifests(doc, renderer, authoritative, passed, document_sha256, render_pdf, render_pdf_sha256) against files(path, sha256)."""
    now = lambda path, name: files.select(F.col("path").alias(path), F.col("sha256").alias(name))
    m = manifests.join(now("doc", "doc_now"), "doc", "left").join(now("render_pdf", "pdf_now"), "render_pdf", "left")
    same = lambda a, b: F.coalesce(F.col(a) == F.col(b), F.lit(False))
    return row_violations(m, F.col("doc"), [
        RowRule("renderer", ~F.coalesce((F.col("renderer") == "microsoft_word") & F.col("authoritative"), F.lit(False))),
        RowRule("passed", ~F.coalesce("passed", F.lit(False))),
        RowRule("document_hash", ~same("document_sha256", "doc_now")),
        RowRule("pdf_hash", ~same("render_pdf_sha256", "pdf_now")),
    ])


def review_violations(reviews: DataFrame, manifests: DataFrame) -> DataFrame:
    """Rules of reviews(doc, stage, passed, hash_bound, document_sha256, render_pdf_sha256, page_count) against the render they were made from."""
    m = manifests.select("doc", "stage", *[F.col(c).alias(f"m_{c}") for c in ("document_sha256", "render_pdf_sha256", "page_count")])
    r = reviews.join(m, ["doc", "stage"], "left")
    differs = lambda c: ~F.coalesce(F.col(c) == F.col(f"m_{c}"), F.lit(False))
    return row_violations(r, F.concat_ws("/", "doc", "stage"), [
        RowRule("passed", ~F.coalesce("passed", F.lit(False))), RowRule("hash_bound", ~F.coalesce("hash_bound", F.lit(False))),
        RowRule("document_hash", differs("document_sha256")), RowRule("pdf_hash", differs("render_pdf_sha256")), RowRule("page_count", differs("page_count")),
    ])
