"""Jobs as a table: manifests of any number of jobs parsed once as VARIANT, their facts judged by a decision table.

A manifest is a row (job, root, value): its name, the folder that its paths count from, its JSON text.  Text that is no JSON, or
whose root is no object, gives one violation and no further ones; a field of another JSON kind is a ``field_type`` row
that names it, and counts as not given.  ``class``, ``subject`` and ``job_id`` may be any scalar.  Empty optional paths
are none.  Paths are compared after ``.`` and ``..`` are resolved, so one file under two spellings is one file.
Ranges are never expanded: pages are counted, and previews looked up, by their ends.

Whether files are there is a join with files(path, sha256), a listing of any size: nothing is asked of a disk in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.operators.contracts import RowRule, all_violations, row_violations
from folioloom.operators.decisions import Rule, decide
from folioloom.operators.ordered import dealt
from folioloom.sources.manifests import kind_of, typed
from folioloom.tables import written

# Fields of job manifests, domains, defaults, and what a kind of source asks for.
NAMES = ("job_id", "class", "subject")
REQUIRED_PATHS = ("source", "template", "preview_output", "final_output", "qa_dir")
OPTIONAL_PATHS = ("approved_reference", "normalized_source", "content_manifest", "layout_reference")
PATHS = REQUIRED_PATHS + OPTIONAL_PATHS
DOMAINS = {
    "source_type": ("docx", "pdf"), "content_policy": ("layout_only", "reconstruct_content"), "typography_policy": ("preserve_source", "mapped_pdf_fonts"),
    "boundary_strategy": ("saved_rendered", "explicit"), "first_content_side": ("recto", "verso"), "render_authority": ("word", "libreoffice"),
    "source_style_policy": ("source_authority", "content_only"), "pagination_policy": ("source_locked", "sample_flow"),
}
DEFAULTS = {
    "content_policy": "layout_only", "typography_policy": "preserve_source", "first_content_side": "recto", "render_authority": "libreoffice",
    "source_style_policy": "source_authority", "pagination_policy": "source_locked",
}
BY_SOURCE = {
    "docx": {"content_policy": "layout_only", "typography_policy": "preserve_source"},
    "pdf": {"content_policy": "reconstruct_content", "typography_policy": "mapped_pdf_fonts", "boundary_strategy": "explicit"},
}
FONT_ROLES, PREVIEW_PAGES = ("hindi", "latin", "math"), 7
PROTECTED = ("source", "template", "approved_reference", "layout_reference")
MADE = ("preview_output", "final_output", "normalized_source", "content_manifest")

_PDF, _DOCX = {"source_type": ("pdf",)}, {"source_type": ("docx",)}
RULES: tuple[Rule, ...] = (
    *[Rule("name_missing", n, "given") for n in NAMES],
    *[Rule(f"{p}_missing", p, "given") for p in REQUIRED_PATHS],
    *[Rule(f"{p}_file", f"{p}_there", "in", ("true",), {f"{p}_given": ("true",)}) for p in PROTECTED],
    *[Rule(n, n, "in", values) for n, values in DOMAINS.items()],
    Rule("source_suffix", "suffix", "same", ("source_type",), {"source_type": DOMAINS["source_type"], "source_given": ("true",)}),
    Rule("preview_source_pages", "preview_source_pages", "at_least", ("1",)),
    Rule("layout_reference_missing", "layout_reference", "given", (), {"source_style_policy": ("content_only",)}),
    Rule("layout_reference_missing", "layout_reference", "given", (), {"pagination_policy": ("sample_flow",)}),
    Rule("expected_page_count", "expected_page_count", "at_least", ("1",), {"count_given": ("true",)}),
    Rule("range_shape", "odd_ranges", "in", ("0",)),
    Rule("range_ends", "bad_ranges", "in", ("0",)),
    Rule("range_overlap", "overlaps", "in", ("false",)),
    Rule("range_order", "ordered", "in", ("true",)),
    Rule("page_count_differs", "n_pages", "same", ("expected_page_count",), {"count_given": ("true",), "ranges_given": ("true",)}),
    Rule("word_pdf_pages", "ranges_given", "in", ("true",), _PDF | {"render_authority": ("word",)}),
    Rule("word_pdf_pages", "count_given", "in", ("true",), _PDF | {"render_authority": ("word",)}),
    Rule("preview_outside", "outside", "in", ("0",), {"ranges_given": ("true",)}),
    Rule("preview_repeated", "repeated", "in", ("0",)),
    Rule("preview_positive", "below_one", "in", ("0",)),
    Rule("preview_length", "n_preview", "same", ("preview_source_pages",), {"preview_given": ("true",)}),
    *[Rule(f"{s}_{n}", n, "in", (v,), {"source_type": (s,)}) for s, wants in BY_SOURCE.items() for n, v in wants.items()],
    Rule("pdf_normalized_source", "normalized_source", "given", (), _PDF),
    Rule("pdf_content_manifest", "content_manifest", "given", (), _PDF),
    Rule("pdf_preview_pages", "preview_given", "in", ("true",), _PDF),
    Rule("pdf_font_roles", "lost_roles", "in", ("",), _PDF),
    Rule("output_protected", "output_protected", "in", ("false",)),
    Rule("normalized_protected", "normalized_protected", "in", ("false",)),
    Rule("manifest_protected", "manifest_protected", "in", ("false",)),
    Rule("made_twice", "made_twice", "in", ("false",)),
)


def absolute(root: Column, path: Column) -> Column:
    """``path`` counted from ``root`` unless it is absolute, with empty, ``.`` and ``..`` steps resolved; .. at the top stays there."""
    whole = F.when(path.startswith("/"), path).otherwise(F.concat(root, F.lit("/"), path))
    steps = F.filter(F.split(whole, "/"), lambda s: ~s.isin("", "."))
    kept = F.aggregate(steps, F.array().cast("array<string>"), lambda a, s: F.when(s == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.concat(a, F.array(s))))
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def _ranges(items: Column) -> tuple[Column, Column]:
    """(well-formed ranges as array<array<int>>, number of items that aren't pairs of whole numbers)."""
    pair = lambda i: F.when(kind_of(i) == "ARRAY", F.try_variant_get(i, "$", "array<int>"))
    good = lambda r: F.coalesce((F.size(r) == 2) & ~F.exists(r, lambda x: x.isNull()), F.lit(False))
    read = F.transform(items, pair)
    return F.filter(read, good), F.size(F.filter(read, lambda r: ~good(r)))


def job_facts(manifests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(facts, errors): a row a readable job with its fields, defaults and derived facts; and the unreadable ones and fields.

    ``manifests``(job, root, value); errors are (rule_id, severity, key).
    """
    parsed = manifests.select("job", "root", F.try_parse_json("value").alias("v"))
    parsed = parsed.withColumn("kind", kind_of(F.col("v")))  # rows are told by it once facts are written, as filters on it parse every text again
    fields = {n: (n, "string") for n in (*PATHS, *DOMAINS)} | {n: (n, "int") for n in ("preview_source_pages", "expected_page_count")}
    fields |= {"preview": ("preview_source_page_numbers", "array<int>"), "items": ("content_page_ranges", "array<variant>"), "fonts": ("pdf_font_map", "map<string,variant>")}
    whole = parsed.withColumns({n: F.try_variant_get("v", f"$.{n}", "string") for n in NAMES})
    j, c = typed(whole, "v", fields, F.lit("")), F.col
    j = j.withColumns({p: F.when(F.trim(c(p)) != "", absolute(c("root"), c(p))) for p in PATHS})
    suffix = F.lower(F.regexp_extract("source", "[^/]\\.([^./]+)$", 1))
    j = j.withColumn("suffix", suffix).withColumn("source_type", F.lower(F.coalesce("source_type", "suffix")))
    defaults = {n: F.coalesce(n, F.lit(v)) for n, v in DEFAULTS.items()}
    defaults["boundary_strategy"] = F.coalesce("boundary_strategy", F.when(c("source_type") == "pdf", "explicit").otherwise("saved_rendered"))
    none = F.array().cast("array<int>")
    ranges, odd = _ranges(F.coalesce("items", F.array().cast("array<variant>")))
    j = j.withColumns(defaults | {"preview_source_pages": F.coalesce("preview_source_pages", F.lit(PREVIEW_PAGES)), "preview": F.coalesce("preview", none), "ranges": ranges, "odd_ranges": odd})
    bad = lambda r: (r[0] < 1) | (r[1] < r[0])
    j = j.withColumns({"real": F.filter("ranges", lambda r: ~bad(r)), "bad_ranges": F.size(F.filter("ranges", bad))})
    after = lambda rows: F.exists(F.transform(rows, lambda r, i: F.coalesce(r[0] <= F.get(rows, i - 1)[1], F.lit(False))), lambda x: x)
    inside = lambda p: F.exists(c("real"), lambda r: (p >= r[0]) & (p <= r[1]))
    among = lambda name: F.coalesce(F.array_contains("protected", c(name)), F.lit(False))
    j = j.withColumns({"sorted": F.sort_array("real")} | {n: F.array_compact(F.array(*map(c, paths))) for n, paths in (("protected", PROTECTED), ("made", MADE))})
    j = j.withColumns({
        "overlaps": after(c("sorted")), "ordered": ~after(c("real")), "ranges_given": F.size("real") > 0, "count_given": c("expected_page_count").isNotNull(),
        "n_pages": F.aggregate("real", F.lit(0).cast("long"), lambda a, r: a + r[1] - r[0] + 1),
        "n_preview": F.size("preview"), "preview_given": F.size("preview") > 0, "outside": F.size(F.filter("preview", lambda p: ~inside(p))),
        "repeated": F.size("preview") - F.size(F.array_distinct("preview")), "below_one": F.size(F.filter("preview", lambda p: p < 1)),
        "lost_roles": F.array_join(F.array_except(F.array(*map(F.lit, FONT_ROLES)), F.coalesce(F.map_keys("fonts"), F.array().cast("array<string>"))), ","),
        "output_protected": among("preview_output") | among("final_output"), "normalized_protected": among("normalized_source"), "manifest_protected": among("content_manifest"),
        "made_twice": F.size("made") > F.size(F.array_distinct("made")),
        **{f"{p}_given": c(p).isNotNull() for p in PATHS},
    })
    every = written(j.drop("v", "items", "fonts", "real", "sorted", "protected", "made"), "job_facts")
    facts = every.where("kind = 'OBJECT'").drop("kind")
    torn = every.where("kind IS NULL OR kind <> 'OBJECT'").select(F.when(F.col("kind").isNull(), "json").otherwise("root_object").alias("rule_id"), F.lit("error").alias("severity"), F.col("job").alias("key"))
    return facts.drop("wrong"), torn.unionByName(facts.select(F.lit("field_type").alias("rule_id"), F.lit("error").alias("severity"), F.explode(F.transform("wrong", lambda w: F.concat_ws("/", "job", w))).alias("key")))


def bindings(facts: DataFrame) -> DataFrame:
    """(job, label, path, required): the files that a job's previews and approvals are bound to; a path may be null where one is required."""
    pdf = F.col("source_type") == "pdf"
    need = {"source": F.lit(True), "template": F.lit(True), "layout_reference": F.lit(False), "approved_reference": F.lit(False), "normalized_source": pdf, "content_manifest": pdf}
    bound = {n: F.col(n) for n in need} | {n: F.when(pdf, F.col(n)) for n in ("normalized_source", "content_manifest")}
    rows = F.array(*[F.struct(F.lit(n).alias("label"), bound[n].alias("path"), F.coalesce(r, F.lit(False)).alias("required")) for n, r in need.items()])
    rows = F.concat(rows, F.array(F.struct(F.lit("preview").alias("label"), F.col("preview_output").alias("path"), F.lit(True).alias("required"))))
    return facts.select("job", F.explode(F.filter(rows, lambda b: b["required"] | b["path"].isNotNull())).alias("b")).select("job", "b.*")


def job_violations(manifests: DataFrame, files: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(rule_id, severity, key): everything that is wrong with jobs; ``files``(path) are the files that there are."""
    facts, errors = job_facts(manifests)
    asked = facts.select("job", F.explode(F.array(*[F.struct(F.lit(p).alias("label"), F.col(p).alias("path")) for p in PROTECTED])).alias("a")).select("job", "a.*").where("path IS NOT NULL")
    there = asked.join(files.select("path"), "path", "left_semi").groupBy("job").agg(F.collect_set("label").alias("there"))
    known = facts.join(there, "job", "left").withColumns({f"{p}_there": F.coalesce(F.array_contains("there", p), F.lit(False)) for p in PROTECTED})
    return errors.unionByName(decide(known, rules, F.col("job")))


def provenance_violations(facts: DataFrame, statuses: DataFrame, files: DataFrame, stage: str = "preview") -> DataFrame:
    """(rule_id, severity, key) of jobs whose recorded hashes aren't those of the files now.

    ``statuses``(job, value) are status files as JSON; ``stage`` is ``preview`` (what a preview was made from) or ``approved`` (what was
    approved).  Each bound file gives at most one row job/label: ``unrecorded`` (no hash was written down), ``lost`` (no
    such file now) or ``changed``.  A job without a status, or with one that is no JSON object, has recorded nothing.
    """
    if stage not in ("preview", "approved"):
        raise ValueError(f"{stage} is no stage with recorded hashes")
    name = F.concat(F.col("label"), F.lit("_sha256"))
    if stage == "approved":  # an approved reference is recorded under one name at both stages
        name = F.when(F.col("label") == "approved_reference", name).otherwise(F.concat(F.lit("approved_"), name))
    said = statuses.select("job", F.try_variant_get(F.try_parse_json("value"), "$", "map<string,variant>").alias("said"))
    rows = bindings(facts).withColumn("name", name).join(said, "job", "left")
    rows = rows.withColumn("recorded", F.nullif(F.try_variant_get(F.element_at("said", F.col("name")), "$", "string"), F.lit(""))).drop("said")
    now = rows.join(files.select("path", F.col("sha256").alias("now")), "path", "left")
    return row_violations(now, F.concat_ws("/", "job", "label"), [
        RowRule("unrecorded", F.col("recorded").isNull()),
        RowRule("lost", F.col("recorded").isNotNull() & F.col("now").isNull()),
        RowRule("changed", F.col("recorded") != F.col("now")),
    ])


def conversion_gate(facts: DataFrame, statuses: DataFrame, files: DataFrame) -> DataFrame:
    """(job, n_preview, n_approved, passed): a full conversion may begin where preview and approval still hold."""
    files_a_job = len(PROTECTED) + 3  # bound ones, at most
    found = all_violations(*[provenance_violations(facts, statuses, files, s).select(F.lit(s).alias("stage"), F.regexp_replace("key", "/[^/]*$", "").alias("job")) for s in ("preview", "approved")])
    found = dealt(found, ["job"], 2 * files_a_job * facts.count())  # a task's groups don't grow with the jobs
    n = found.groupBy("job").agg(F.count_if(F.col("stage") == "preview").alias("n_preview"), F.count_if(F.col("stage") == "approved").alias("n_approved"))
    rows = facts.select("job").join(n, "job", "left").select("job", F.coalesce("n_preview", F.lit(0)).alias("n_preview"), F.coalesce("n_approved", F.lit(0)).alias("n_approved"))
    return rows.withColumn("passed", F.col("n_preview") + F.col("n_approved") == 0)
