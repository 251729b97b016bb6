"""Queries of text and block functions, each through the library's own function.

Where tables hold no text of the kind, rows are made from theirs by the same SQL for both sides.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from folioloom.functions import blocks as B
from folioloom.functions import text as T
from folioloom.operators import chapters as H
from folioloom.operators import packages as K
from folioloom.plans.catalogue import made, query, table

# Letters with marks, and a few without, as letters of another script.
_MARKED = "translate(text, 'aeäöüßñóíèéêç', 'कखगघचछजझटठडढण')"


@query(
    "language_run_stats",
    f"""
WITH r AS (SELECT doc_id, regexp_extract_all({_MARKED}, '[\\x{{0900}}-\\x{{097F}}]+|[^\\x{{0900}}-\\x{{097F}}]+') AS r FROM documents),
f AS (SELECT doc_id, list_filter(r, lambda x, i: i = 1 OR NOT regexp_full_match(x, '\\s+')) AS f FROM r),
l AS (SELECT doc_id, list_transform(f, lambda x: regexp_matches(x, '^[\\x{{0900}}-\\x{{097F}}]')) AS h FROM f)
SELECT doc_id, CAST(len(list_filter(h, lambda x, i: i = 1 OR x <> h[i - 1])) AS BIGINT) AS n_runs, CAST(len(list_filter(h, lambda x, i: x AND (i = 1 OR NOT h[i - 1]))) AS BIGINT) AS n_hindi FROM l
""",
)
def language_run_stats(spark, sf_dir):
    """Runs of one script in each document, blank gaps joined."""
    d = table(spark, sf_dir, "documents").select("doc_id", T.language_runs(F.expr(_MARKED)).alias("r"))
    hindi = F.filter("r", lambda x: x["language"] == "hindi")
    return d.select("doc_id", F.size("r").cast("long").alias("n_runs"), F.size(hindi).cast("long").alias("n_hindi"))


@query(
    "mixed_token_stats",
    f"""
WITH t AS (SELECT doc_id, regexp_extract_all({_MARKED}, '[\\x{{0900}}-\\x{{097F}}][\\x{{0900}}-\\x{{097F}} \\t\\r\\n,.:;?!()₹%\\-0-9/\\\\]*|[^\\x{{0900}}-\\x{{097F}}]+') AS t FROM documents)
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, sha256(array_to_string(t, '|')) AS tokens_sha256 FROM t
""",
)
def mixed_token_stats(spark, sf_dir):
    """Tokens whose neutral characters go with what stands before them."""
    d = table(spark, sf_dir, "documents").select("doc_id", T.mixed_tokens(F.expr(_MARKED)).alias("t"))
    return d.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.transform("t", lambda x: x["text"]), "|"), 256).alias("tokens_sha256"))


@query(
    "script_counts",
    f"SELECT CASE WHEN regexp_matches({_MARKED}, '[ऀ-ॿ]') THEN 'hindi' ELSE 'latin' END AS script, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY 1",
)
def script_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(T.script(F.expr(_MARKED)).alias("script")).agg(F.count("*").alias("n"))


# One small page for each order line: formulas of every kind, and text that was decoded wrongly.
_PAGES = """
SELECT CAST(l_orderkey * 100 + l_linenumber AS BIGINT) AS id, l_partkey AS part, l_suppkey AS supp,
       CASE l_partkey % 9 WHEN 0 THEN concat('text\n  x + ', l_suppkey, '  \nmore') WHEN 1 THEN concat('the LIM of ', l_suppkey) WHEN 2 THEN concat('√', l_suppkey, '\n2/', l_suppkey) WHEN 3 THEN CAST(l_suppkey AS STRING)
         WHEN 4 THEN concat('a line that is longer than such formulas are: 3 + 4 = ', l_suppkey) WHEN 5 THEN concat('limit ', l_suppkey) WHEN 6 THEN concat('(a-', l_suppkey, ')\ny=1') WHEN 7 THEN 'bad � text' ELSE concat('à¤¯ ', l_suppkey) END AS body
FROM {lineitem}
"""


@query(
    "sanitize_errors",
    f"WITH p AS ({_PAGES.format(lineitem='lineitem')}) SELECT CASE WHEN contains(body, chr(65533)) THEN 'replacement' WHEN regexp_matches(body, 'Ã.|à[¤¥]') THEN 'mojibake' ELSE 'none' END AS error, CAST(count(*) AS BIGINT) AS n FROM p GROUP BY 1",
)
def sanitize_errors(spark, sf_dir):
    """Why texts are rejected."""
    return made(spark, sf_dir, _PAGES, "lineitem").groupBy(F.coalesce(T.sanitize_error(F.col("body")), F.lit("none")).alias("error")).agg(F.count("*").alias("n"))


@query(
    "formula_reason_rows",
    f"WITH p AS ({_PAGES.format(lineitem='lineitem')})"
    + r""",
l AS (SELECT id, body, list_transform(regexp_split_to_array(body, '\r\n|[\n\r]'), lambda x: replace(trim(x, E' \t\n\r'), chr(8203), '')) AS ls FROM p),
r AS (
  SELECT id, regexp_matches(body, '(?i)[√∑∫]|\b(lim|det)\b') AS a,
         len(list_filter(ls, lambda x: length(x) BETWEEN 2 AND 24 AND regexp_full_match(x, '[0-9A-Za-z(){}+\-−=./,\s]+') AND regexp_matches(x, '[0-9]') AND regexp_matches(x, '[+\-−=/xy]'))) > 0 AS b FROM l)
SELECT id, concat_ws('; ', CASE WHEN a THEN 'root, integral, summation, limit, or determinant notation' END, CASE WHEN b THEN 'a short split formula line that may be a stacked fraction' END) AS reasons
FROM r WHERE a OR b
""",
)
def formula_reason_rows(spark, sf_dir):
    """Why pages may have lost a formula's layout."""
    d = made(spark, sf_dir, _PAGES, "lineitem").select("id", T.formula_reasons(F.col("body")).alias("r"))
    return d.where("size(r) > 0").select("id", F.array_join("r", "; ").alias("reasons"))


# One line of a book for each order line.
_LINES = """
SELECT CAST(l_orderkey AS BIGINT) AS page, l_partkey AS part, l_suppkey AS supp,
       CASE l_partkey % 11 WHEN 0 THEN concat('CHAPTER ', l_suppkey) WHEN 1 THEN 'UNIT' WHEN 2 THEN concat('Question ', l_suppkey, ': why') WHEN 3 THEN concat('q', l_suppkey) WHEN 4 THEN '. . . . . . . . .'
         WHEN 5 THEN '_______' WHEN 6 THEN 'Long Answer Question' WHEN 7 THEN 'fill in the blanks' WHEN 8 THEN '  -- ** __ ' WHEN 9 THEN concat('Multiple choice and short answer ', l_suppkey) ELSE concat('अध्याय: ', l_suppkey) END AS raw
FROM {lineitem}
"""


@query(
    "line_classes",
    f"""
WITH l AS ({_LINES.format(lineitem="lineitem")}),
c AS (
  SELECT regexp_matches(raw, '^(CHAPTER|अध्याय)\\s*:?\\s*\\d+') AS unit, lower(raw) LIKE '%long answer question%' OR lower(raw) LIKE '%fill in the blank%' AS typed,
         CAST(nullif(regexp_extract(raw, '(?i)^q(uestion)? ?(\\d+)', 2), '') AS INT) AS asked, regexp_full_match(raw, '([._-]\\s*){{8,}}') AS dotted, regexp_full_match(trim(raw), '[-_* ]{{6,}}') AS separator,
         CASE WHEN lower(raw) LIKE '%multiple choice%' THEN 'mcq' WHEN lower(raw) LIKE '%fill in the blank%' THEN 'fill_blank' WHEN lower(raw) LIKE '%short answer%' THEN 'short_answer' WHEN lower(raw) LIKE '%long answer%' THEN 'long_answer' END AS heading,
         CASE WHEN lower(raw) LIKE '%multiple choice%' THEN 'mixed' WHEN lower(raw) LIKE '%fill in the blank%' THEN 'fill_blank' WHEN lower(raw) LIKE '%long answer%' THEN 'long_answer' ELSE 'other' END AS page_type FROM l)
SELECT unit, typed, asked, dotted, separator, heading, page_type, CAST(count(*) AS BIGINT) AS n FROM c GROUP BY ALL
""",
)
def line_classes(spark, sf_dir):
    """What each line is."""
    raw = F.col("raw")
    c = made(spark, sf_dir, _LINES, "lineitem").select(
        T.is_unit_heading(raw).alias("unit"), T.is_type_heading(raw).alias("typed"), T.question(raw)["number"].alias("asked"), T.is_answer_line(raw).alias("dotted"), T.is_separator(raw).alias("separator"),
        T.heading_type(raw).alias("heading"), T.page_type(raw, F.lit(False)).alias("page_type"),
    )
    return c.groupBy(*c.columns).agg(F.count("*").alias("n"))


# One option for each order line: plain, with a formula, or of runs.
_UNITS = """
SELECT l_orderkey AS page, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k, l_partkey % 4 AS form,
       CAST(l_quantity AS INT) AS q, CAST(l_suppkey AS INT) AS s FROM {lineitem}
"""


@query(
    "option_grid_choice",
    f"""
WITH u AS ({_UNITS.format(lineitem="lineitem")}),
w AS (SELECT page, k, CASE form WHEN 0 THEN q WHEN 1 THEN CASE WHEN s % 3 = 0 THEN 42.0 WHEN s % 3 = 1 THEN 14.0 * (q / 10.0) ELSE 14.0 * (q + 36) / 72.0 END WHEN 2 THEN (s % 20) + 30 ELSE 14.0 * 0.5 + (s % 9) END AS units FROM u WHERE k <= 4),
g AS (SELECT page, max(units) AS widest, count(*) AS n, CASE page % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 ELSE 2 END AS wanted FROM w GROUP BY page)
SELECT page, CAST(CASE WHEN widest > 34 THEN 1 WHEN wanted = 4 AND n = 4 THEN CASE WHEN widest > 14 THEN 2 ELSE 4 END WHEN wanted = 2 AND n >= 2 THEN 2 ELSE 1 END AS INT) AS n_columns FROM g
""",
)
def option_grid_choice(spark, sf_dir):
    """Columns that options fit by the width of text, runs and formulas."""
    u = made(spark, sf_dir, _UNITS, "lineitem").where("k <= 4")
    formula = "struct<width_inches:double,bbox:array<double>>"
    q, s, form = F.col("q"), F.col("s"), F.col("form")
    wide = F.struct(F.when(s % 3 == 1, q / 10.0).alias("width_inches"), F.when(s % 3 == 2, F.array(F.lit(0.0), F.lit(0.0), (q + 36).cast("double"), F.lit(9.0))).alias("bbox")).cast(formula)
    small = F.struct(F.lit(0.5).alias("width_inches"), F.lit(None).alias("bbox")).cast(formula)
    runs = F.array(F.struct(F.lit(None).cast("string").alias("text"), small.alias("formula")), F.struct(F.repeat(F.lit("y"), s % 9).alias("text"), F.lit(None).cast(formula).alias("formula")))
    text = F.when(form == 0, F.repeat(F.lit("x"), q)).when(form == 2, F.concat(F.repeat(F.lit("z"), s % 20 - 1), F.lit("\n")))
    text = F.when((form == 2) & (s % 20 == 0), F.lit("\n")).otherwise(text)
    item = F.struct(text.alias("text"), F.when(form == 1, wide).alias("formula"), F.when(form == 3, runs).alias("runs"))
    units = u.select("page", B.visual_units(item).alias("w"), (form == 2).alias("broken"), (s % 20).alias("z"))
    units = units.select("page", F.when(F.col("broken") & (F.col("z") == 0), F.col("w") - 1).otherwise(F.col("w")).alias("w"))
    asked = F.element_at(F.array(*map(F.lit, ("stacked", "2x2", "four_inline", "other"))), (F.col("page") % 4 + 1).cast("int"))
    g = units.groupBy("page").agg(F.collect_list("w").alias("ws"))
    return g.select("page", B.option_grid(F.col("ws"), B.requested_columns(asked, F.lit(None).cast("int"))).cast("int").alias("n_columns"))


@query(
    "answer_space_sizes",
    """
WITH b AS (SELECT l_orderkey, l_partkey, CASE WHEN l_partkey % 3 = 0 THEN CAST(l_quantity AS INT) END AS count, CAST(l_suppkey % 6 AS INT) AS marks, CASE WHEN l_suppkey % 4 = 0 THEN l_quantity END AS spacing, CASE WHEN l_partkey % 2 = 0 THEN 'generous' END AS mode FROM lineitem)
SELECT CAST(coalesce(count, CASE marks WHEN 1 THEN 3 WHEN 2 THEN 5 END, CASE WHEN marks > 0 THEN marks * 2 END) AS INT) AS n_lines, coalesce(spacing, CASE WHEN mode = 'generous' THEN 32.0 ELSE 28.5 END) AS pitch, CAST(count(*) AS BIGINT) AS n
FROM b GROUP BY 1, 2
""",
)
def answer_space_sizes(spark, sf_dir):
    """Lines and pitch of answer spaces."""
    li = table(spark, sf_dir, "lineitem")
    count, marks = F.when(F.col("l_partkey") % 3 == 0, F.col("l_quantity").cast("int")), (F.col("l_suppkey") % 6).cast("int")
    spacing, mode = F.when(F.col("l_suppkey") % 4 == 0, F.col("l_quantity")), F.when(F.col("l_partkey") % 2 == 0, F.lit("generous"))
    rows = li.select(B.answer_line_count(count, marks, {1: 3, 2: 5}).alias("n_lines"), B.answer_line_pitch(spacing, mode, 28.5, 32.0).alias("pitch"))
    return rows.groupBy("n_lines", "pitch").agg(F.count("*").alias("n"))


@query(
    "heading_styles",
    """
WITH h AS (SELECT CASE p_size % 6 WHEN 0 THEN 'UNIT' WHEN 1 THEN 'unit_heading' WHEN 2 THEN 'Section_Heading' WHEN 3 THEN 'other' END AS role, CASE WHEN p_partkey % 3 > 0 THEN p_partkey % 3 END AS level FROM part)
SELECT CASE WHEN lower(role) IN ('unit', 'unit_heading') THEN 'Book Unit' WHEN lower(role) = 'section_heading' THEN 'Book Question Type' WHEN coalesce(level, 1) = 1 THEN 'Book Chapter' ELSE 'Book Question Type' END AS style,
       CAST(count(*) AS BIGINT) AS n FROM h GROUP BY 1
""",
)
def heading_styles(spark, sf_dir):
    """Styles of headings by role, then level."""
    size, level = F.col("p_size") % 6, F.col("p_partkey") % 3
    role = F.when(size == 0, "UNIT").when(size == 1, "unit_heading").when(size == 2, "Section_Heading").when(size == 3, "other")
    return table(spark, sf_dir, "part").groupBy(B.heading_style(role, F.when(level > 0, level))["style"].alias("style")).agg(F.count("*").alias("n"))


@query(
    "page_contexts",
    """
WITH s AS (SELECT p_partkey AS i, CASE WHEN p_size % 2 = 0 THEN 'recto' ELSE 'verso' END AS side, 11906 + p_size - 25 AS width, 16838 AS height, 1000 + p_size AS l, 900 AS r, 1300 + p_size * 20 AS t FROM part),
c AS (SELECT *, (i % 2 = 0) = (side = 'recto') AS recto FROM s WHERE abs(width - 11906) <= 28)
SELECT i AS page, CAST(CASE WHEN recto THEN 1247 ELSE 1020 END - l AS BIGINT) AS left_twips, CAST(CASE WHEN recto THEN 1020 ELSE 1247 END - r AS BIGINT) AS right_twips, CAST(greatest(0, 1587 - t) AS BIGINT) AS top_twips FROM c
""",
)
def page_contexts(spark, sf_dir):
    """Indents of pages beside their section's margins."""
    size = F.col("p_size")
    section = F.struct((size + (11906 - 25)).alias("width"), F.lit(16838).alias("height"), (size + 1000).alias("left"), F.lit(900).alias("right"), (size * 20 + 1300).alias("top"))
    context = B.page_context(F.col("p_partkey"), F.when(size % 2 == 0, "recto").otherwise("verso"), section, 22.0, 18.0, 28.0)
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page"), context.alias("c")).where("c IS NOT NULL").select("page", F.col("c.left").alias("left_twips"), F.col("c.right").alias("right_twips"), F.col("c.top").alias("top_twips"))


@query(
    "switches",
    """
WITH s AS (SELECT p_partkey, p_size % 5 > 0 AS present, CASE p_size % 7 WHEN 0 THEN '1' WHEN 1 THEN 'off' WHEN 2 THEN 'TRUE' WHEN 3 THEN 'maybe' WHEN 4 THEN '0' WHEN 5 THEN 'On' END AS v FROM part)
SELECT p_partkey, CASE WHEN NOT present THEN true WHEN v IS NULL THEN true WHEN lower(v) IN ('1', 'true', 'on') THEN true WHEN lower(v) IN ('0', 'off') THEN false ELSE true END AS value FROM s
""",
)
def switches(spark, sf_dir):
    """On/off marks whose default is on."""
    k = F.col("p_size") % 7
    v = F.when(k == 0, "1").when(k == 1, "off").when(k == 2, "TRUE").when(k == 3, "maybe").when(k == 4, "0").when(k == 5, "On")
    return table(spark, sf_dir, "part").select("p_partkey", T.on_off(F.col("p_size") % 5 > 0, v, default=True).alias("value"))


@query(
    "block_texts",
    """
SELECT p_partkey, concat_ws(' ', p_name, CASE WHEN p_size % 2 = 0 THEN p_brand END, CASE WHEN p_size % 3 = 0 THEN p_type END, CASE WHEN p_size % 5 = 0 THEN 'run' || ' ' || p_name END, CASE WHEN p_size % 7 = 0 THEN 'A' || ' ' || p_type || ' B' END) AS text FROM part
""",
)
def block_texts(spark, sf_dir):
    """Searchable text of nested blocks."""
    only = lambda n, c: F.when(F.col("p_size") % n == 0, c)
    runs = only(5, F.array(F.struct(F.lit("run").alias("text")), F.struct(F.col("p_name").alias("text"))))
    items = only(7, F.array(F.struct(F.lit("A").alias("label"), F.col("p_type").alias("text")), F.struct(F.lit("B").alias("label"), F.lit(None).cast("string").alias("text"))))
    block = F.struct(F.col("p_name").alias("text"), only(2, F.col("p_brand")).alias("label"), only(3, F.col("p_type")).alias("hindi"), F.lit(None).cast("string").alias("english"), runs.alias("runs"), items.alias("items"))
    return table(spark, sf_dir, "part").select("p_partkey", block.alias("b")).select("p_partkey", B.block_text(F.col("b")).alias("text"))


@query(
    "row_digests",
    """SELECT p_partkey, upper(sha256('{"p_brand":"' || p_brand || '","p_name":"' || p_name || '","p_size":' || p_size || ',"p_type":' || CASE WHEN p_size % 4 = 0 THEN 'null' ELSE '"' || p_type || '"' END || '}')) AS digest FROM part""",
)
def row_digests(spark, sf_dir):
    """Digests of rows as compact JSON with keys in order."""
    value = F.struct("p_brand", "p_name", "p_size", F.when(F.col("p_size") % 4 != 0, F.col("p_type")).alias("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", T.canonical_digest(value).alias("digest"))


_GLYPHS = T.Glyphs((("ks", "ो"), ("k", "ा"), ("d", "क"), ("r", "त"), ("t", "ज")))


@query(
    "legacy_paragraphs",
    """
WITH r AS (SELECT p_size AS par, p_partkey AS n, CASE WHEN p_partkey % 3 = 0 THEN replace(replace(replace(replace(replace(p_name, 'ks', 'ो'), 'k', 'ा'), 'd', 'क'), 'r', 'त'), 't', 'ज') ELSE p_name END AS t FROM part)
SELECT par, sha256(trim(string_agg(t, '' ORDER BY n))) AS text_sha256 FROM r GROUP BY par
""",
)
def legacy_paragraphs(spark, sf_dir):
    """Paragraphs whose runs in a legacy font are converted."""
    font = F.when(F.col("p_partkey") % 3 == 0, "Kruti Dev 010").otherwise("Mangal")
    runs = table(spark, sf_dir, "part").select(F.lit(0).alias("doc"), F.col("p_size").alias("par"), F.col("p_partkey").alias("n"), F.col("p_name").alias("text"), font.alias("font"))
    return H.paragraph_texts(runs, T.transliterator(_GLYPHS)).select("par", F.sha2("text", 256).alias("text_sha256"))


@query(
    "casefold_names",
    """
SELECT name, CAST(row_number() OVER (ORDER BY lower(name), name) AS BIGINT) AS place
FROM (SELECT n_name AS name FROM nation UNION SELECT lower(n_name) FROM nation WHERE n_nationkey % 3 = 0 UNION SELECT CASE WHEN p_size % 2 = 0 THEN upper(p_name) ELSE p_name END FROM part)
""",
)
def casefold_names(spark, sf_dir):
    """Distinct names of two lists in order without regard to case."""
    from folioloom.operators.ordered import number_rows

    n, p = table(spark, sf_dir, "nation"), table(spark, sf_dir, "part")
    lower = n.where("n_nationkey % 3 = 0").select(F.lower("n_name").alias("name"))
    names = n.select(F.col("n_name").alias("name")).union(lower).union(p.select(F.when(F.col("p_size") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name")))).distinct()
    return number_rows(names.withColumn("k", T.casefold_key(F.col("name"))), ["k", "name"], "place").select("name", "place")


@query(
    "file_number_order",
    """
WITH f AS (SELECT 'page-' || p_size || '_' || (p_partkey * 7919 % 2003) || '.png' AS name, p_partkey * 7919 % 2003 AS n FROM part)
SELECT name, CAST(row_number() OVER (ORDER BY n, name) AS BIGINT) AS place FROM f
""",
)
def file_number_order(spark, sf_dir):
    """Rendered pages in the order of their file numbers (O3)."""
    from folioloom.operators.ordered import number_rows

    name = F.concat(F.lit("page-"), "p_size", F.lit("_"), (F.col("p_partkey") * 7919 % 2003).cast("string"), F.lit(".png"))
    files = table(spark, sf_dir, "part").select(name.alias("name")).withColumn("n", T.file_number(F.col("name")))
    return number_rows(files, ["n", "name"], "place").select("name", "place")


@query(
    "part_paths",
    """
WITH r AS (SELECT p_partkey, 'word/sub' || (p_size % 3) || '/document.xml' AS owner, p_size % 4 AS form, p_brand AS leaf FROM part)
SELECT p_partkey, CASE form WHEN 0 THEN 'media/' || leaf WHEN 1 THEN 'word/' || leaf WHEN 2 THEN regexp_replace(owner, '[^/]*$', '') || leaf ELSE 'word/x/' || leaf END AS part FROM r
""",
)
def part_paths(spark, sf_dir):
    """Targets of relationships as part names."""
    form, leaf = F.col("p_size") % 4, F.col("p_brand")
    target = F.when(form == 0, F.concat(F.lit("/media/"), leaf)).when(form == 1, F.concat(F.lit("../"), leaf)).when(form == 2, F.concat(F.lit("./"), leaf)).otherwise(F.concat(F.lit("../y/../x/"), leaf))
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("word/sub"), (F.col("p_size") % 3).cast("string"), F.lit("/document.xml")).alias("owner"), target.alias("target"))
    return rows.select("p_partkey", K.resolve("owner", "target").alias("part"))
