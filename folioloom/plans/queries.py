"""Queries over the tables of a data folder; each takes (spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from folioloom.functions import text as T
from folioloom.operators.containment import containment
from folioloom.operators.containment import numbering_review as numbering_check
from folioloom.operators import contracts as C
from folioloom.operators import ordered as O
from folioloom.operators import packages as K
from folioloom.operators.ordered import number_rows
from folioloom.plans.catalogue import query, table


@query(
    "line_kind_rollup",
    r"""
WITH l AS (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line FROM documents),
k AS (SELECT doc_id, lang, line, CASE
        WHEN regexp_matches(line, '^[-_* ]{6,}$') THEN 'separator'
        WHEN regexp_matches(line, '(?i)licen[sc]e|rights reserved') THEN 'licence'
        WHEN length(line) < 40 THEN 'heading' ELSE 'body' END AS kind FROM l),
s AS (SELECT doc_id, count_if(trim(line) <> '') BETWEEN 1 AND 6 AND sum(length(trim(line))) <= 240 AS sparse FROM l GROUP BY doc_id)
SELECT lang, kind, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(DISTINCT doc_id) FILTER (sparse) AS BIGINT) AS n_sparse_docs
FROM k JOIN s USING (doc_id) GROUP BY lang, kind
""",
)
def line_kind_rollup(spark, sf_dir):
    """Lines of each kind and sparse documents by language: one narrow scan, kept in the row."""
    line = F.col("line")
    kind = F.when(line.rlike("^[-_* ]{6,}$"), "separator").when(line.rlike("(?i)licen[sc]e|rights reserved"), "licence").when(F.length(line) < 40, "heading").otherwise("body")
    lines = F.split("text", "\n")
    full = F.size(F.filter(lines, lambda x: F.trim(x) != ""))
    chars = F.aggregate(lines, F.lit(0), lambda a, x: a + F.length(F.trim(x)))
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", lines.alias("ls"), (full.between(1, 6) & (chars <= 240)).alias("sparse"))
    rows = docs.select("doc_id", "lang", "sparse", F.explode("ls").alias("line")).select("doc_id", "lang", "sparse", kind.alias("kind"))
    by_doc = rows.groupBy("doc_id", "lang", "kind", "sparse").agg(F.count("*").alias("n"))
    return by_doc.groupBy("lang", "kind").agg(F.sum("n").alias("n_lines"), F.count_if("sparse").alias("n_sparse_docs"))


# --- text -----------------------------------------------------------------------------------


@query(
    "sanitize_whitespace",
    r"""
SELECT doc_id, sha256(regexp_replace(regexp_replace(nfc_normalize(translate(text, chr(160) || chr(8203) || chr(65279), ' ')), '[ \t]+', ' ', 'g'), '^\s+|\s+$', '', 'g')) AS clean_sha256
FROM documents
""",
)
def sanitize_whitespace(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(T.sanitize(F.col("text")), 256).alias("clean_sha256"))


@query(
    "script_classes",
    r"""
SELECT CASE WHEN regexp_matches(text, '[äöüß]') THEN 'german' WHEN regexp_matches(text, '[ñóí]') THEN 'spanish'
            WHEN regexp_matches(text, '[èéêç]') THEN 'french' ELSE 'latin' END AS script, CAST(count(*) AS BIGINT) AS n
FROM documents GROUP BY 1
""",
)
def script_classes(spark, sf_dir):
    t = F.col("text")
    kind = F.when(t.rlike("[äöüß]"), "german").when(t.rlike("[ñóí]"), "spanish").when(t.rlike("[èéêç]"), "french").otherwise("latin")
    return table(spark, sf_dir, "documents").groupBy(kind.alias("script")).agg(F.count("*").alias("n"))


@query(
    "script_runs",
    r"""
WITH r AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^\x00-\x7F]+|[\x00-\x7F]+')) AS run FROM documents)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_runs, CAST(count_if(NOT regexp_matches(run, '^[\x00-\x7F]')) AS BIGINT) AS n_marked, CAST(max(length(run)) AS BIGINT) AS longest
FROM r GROUP BY doc_id
""",
)
def script_runs(spark, sf_dir):
    runs = F.regexp_extract_all("text", F.lit("([^\\x00-\\x7F]+|[\\x00-\\x7F]+)"), F.lit(1))
    d = table(spark, sf_dir, "documents").select("doc_id", runs.alias("r")).where("size(r) > 0")
    marked = F.filter("r", lambda x: ~x.rlike("^[\\x00-\\x7F]"))
    return d.select("doc_id", F.size("r").cast("long").alias("n_runs"), F.size(marked).cast("long").alias("n_marked"), F.array_max(F.transform("r", F.length)).cast("long").alias("longest"))


@query(
    "stable_ids",
    """
SELECT conv_id, turn, printf('q-p%03d-%03d', conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn)) AS stable_id
FROM conversations WHERE role = 'user'
""",
)
def stable_ids(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn")
    users = table(spark, sf_dir, "conversations").where("role = 'user'")
    return users.select("conv_id", "turn", T.stable_id(F.col("conv_id"), F.row_number().over(w)).alias("stable_id"))


_OPTION_LINES = ["(A) one (B) two", "(A) one", "(c) x  (D) y", "text (A) late", "(A) 1 (B) 2 (C) 3 (D) 4", "no option", "f(A) call"]


@query(
    "option_anchors",
    f"""
WITH l AS (SELECT p_partkey, [{', '.join(f"'{x}'" for x in _OPTION_LINES)}][p_partkey % {len(_OPTION_LINES)} + 1] || ' ' || p_size AS line FROM part),
n AS (SELECT p_partkey, line, CASE WHEN regexp_matches(line, '^\\s*\\([A-Da-d]\\)') THEN len(regexp_extract_all(line, '(^|[^\\w])\\([A-Da-d]\\)')) ELSE 0 END AS n_options FROM l)
SELECT p_partkey, line, CAST(n_options AS BIGINT) AS n_options, CAST(CASE WHEN n_options >= 4 THEN 4 WHEN n_options >= 2 THEN 2 ELSE 1 END AS BIGINT) AS n_columns FROM n
""",
)
def option_anchors(spark, sf_dir):
    """Option letters and columns of a line a part."""
    shape = F.element_at(F.array(*map(F.lit, _OPTION_LINES)), (F.col("p_partkey") % len(_OPTION_LINES) + 1).cast("int"))
    lines = table(spark, sf_dir, "part").select("p_partkey", F.concat(shape, F.lit(" "), F.col("p_size").cast("string")).alias("line"))
    n = F.size(T.options(F.col("line")))
    return lines.select("p_partkey", "line", n.cast("long").alias("n_options")).withColumn("n_columns", T.option_columns(F.col("n_options")).cast("long"))


@query(
    "heading_unwrap",
    r"""
WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS n FROM s),
f AS (SELECT *, CASE WHEN length(line) < 30 AND length(lag(line) OVER w) < 30 THEN 0 ELSE 1 END AS starts FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY n)),
i AS (SELECT *, sum(starts) OVER (PARTITION BY doc_id ORDER BY n) AS island FROM f)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_blocks, CAST(max(size) AS BIGINT) AS longest
FROM (SELECT doc_id, island, count(*) AS size FROM i GROUP BY doc_id, island) GROUP BY doc_id
""",
)
def heading_unwrap(spark, sf_dir):
    """Short lines after short lines belong to one heading."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    w = Window.partitionBy("doc_id").orderBy("n")
    starts = ~F.coalesce((F.length("line") < 30) & (F.length(F.lag("line").over(w)) < 30), F.lit(False))
    rows = rows.withColumn("starts", starts).withColumn("island", O.island(F.col("starts"), ["doc_id"], ["n"]))
    sizes = rows.groupBy("doc_id", "island").agg(F.count("*").alias("size"))
    return sizes.groupBy("doc_id").agg(F.count("*").alias("n_blocks"), F.max("size").alias("longest"))


@query(
    "formula_flags",
    r"""
SELECT doc_id, CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[0-9]') AND regexp_matches(x, '[-+=*/()]'))) AS BIGINT) AS n_formula_lines
FROM documents WHERE regexp_matches(text, '[0-9]')
""",
)
def formula_flags(spark, sf_dir):
    risky = F.filter(F.split("text", "\n"), lambda x: x.rlike("[0-9]") & x.rlike("[-+=*/()]"))
    return table(spark, sf_dir, "documents").where("text RLIKE '[0-9]'").select("doc_id", F.size(risky).cast("long").alias("n_formula_lines"))


@query(
    "sparse_documents",
    r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, CAST(count_if(trim(line) <> '') AS BIGINT) AS n_lines, CAST(sum(length(trim(line))) AS BIGINT) AS chars FROM l
GROUP BY doc_id HAVING count_if(trim(line) <> '') BETWEEN 1 AND 6 AND sum(length(trim(line))) <= 240
""",
)
def sparse_documents(spark, sf_dir):
    lines = F.split("text", "\n")
    n = F.size(F.filter(lines, lambda x: F.trim(x) != "")).cast("long")
    chars = F.aggregate(lines, F.lit(0), lambda a, x: a + F.length(F.trim(x))).cast("long")
    return table(spark, sf_dir, "documents").select("doc_id", n.alias("n_lines"), chars.alias("chars")).where(T.is_sparse(F.col("n_lines"), F.col("chars")))


@query(
    "page_type_rollup",
    """
WITH t AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL)
SELECT source, CASE WHEN count(DISTINCT lang) > 1 THEN 'mixed' ELSE min(lang) END AS page_type, CAST(sum(n) AS BIGINT) AS n FROM t GROUP BY source
""",
)
def page_type_rollup(spark, sf_dir):
    kinds = table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))
    return kinds.groupBy("source").agg(F.when(F.count("lang") > 1, "mixed").otherwise(F.min("lang")).alias("page_type"), F.sum("n").alias("n"))


@query(
    "answer_line_count",
    """
WITH h AS (SELECT l_orderkey, l_linenumber, l_quantity * 28.5 + l_tax * 50 AS height FROM lineitem),
n AS (SELECT *, round_even(height / 28.5, 0) AS k FROM h)
SELECT CAST(k AS BIGINT) AS n_answer_lines, CAST(count(*) AS BIGINT) AS n FROM n WHERE k > 0 AND abs(height - k * 28.5) <= 2.25 GROUP BY k
""",
)
def answer_line_count(spark, sf_dir):
    fit = T.answer_lines(F.col("l_quantity") * 28.5 + F.col("l_tax") * 50)
    return table(spark, sf_dir, "lineitem").select(fit.alias("f")).where("f IS NOT NULL").groupBy(F.col("f.count").cast("long").alias("n_answer_lines")).agg(F.count("*").alias("n"))


@query(
    "option_grid",
    """
WITH c AS (SELECT conv_id, max(length(text)) AS widest, count(*) AS n FROM conversations GROUP BY conv_id)
SELECT conv_id, CAST(CASE WHEN widest > 600 THEN 1 WHEN n >= 4 AND widest > 200 THEN 2 WHEN n >= 4 THEN 4 ELSE 2 END AS BIGINT) AS n_columns FROM c
""",
)
def option_grid(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.max(F.length("text")).alias("widest"), F.count("*").alias("n"))
    grid = F.when(F.col("widest") > 600, 1).when((F.col("n") >= 4) & (F.col("widest") > 200), 2).when(F.col("n") >= 4, 4).otherwise(2)
    return c.select("conv_id", grid.cast("long").alias("n_columns"))


@query("legacy_font_flag", r"SELECT p_partkey, regexp_matches(lower(p_name), '\b(red|gear)') AS legacy FROM part")
def legacy_font_flag(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.is_legacy_font(F.col("p_name"), ("red", "gear")).alias("legacy"))


# --- inventories ------------------------------------------------------------------------------


@query("hash_inventory", "SELECT doc_id, upper(sha256(text)) AS digest, CAST(octet_length(encode(text)) AS BIGINT) AS size FROM documents")
def hash_inventory(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.upper_sha256(F.col("text")).alias("digest"), F.octet_length("text").cast("long").alias("size"))


@query(
    "tag_inventory",
    r"""
WITH t AS (SELECT page_id, unnest(regexp_extract_all(html, '<([a-z][a-z0-9]*)', 1)) AS tag FROM pages)
SELECT tag, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT page_id) AS BIGINT) AS n_pages FROM t GROUP BY tag
""",
)
def tag_inventory(spark, sf_dir):
    tags = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit("<([a-z][a-z0-9]*)"), F.lit(1))).alias("tag"))
    by_page = tags.groupBy("tag", "page_id").agg(F.count("*").alias("k"))
    return by_page.groupBy("tag").agg(F.sum("k").alias("n"), F.count("*").alias("n_pages"))


@query(
    "distinct_sorted_sets",
    r"""
SELECT page_id, array_to_string(list_sort(list_distinct(regexp_extract_all(html, 'href="([^"]*)"', 1))), ' ') AS hrefs FROM pages
""",
)
def distinct_sorted_sets(spark, sf_dir):
    found = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(F.sort_array(F.array_distinct(found)), " ").alias("hrefs"))


@query(
    "page_totals",
    "SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(length(html)) AS BIGINT) AS chars, CAST(min(length(html)) AS BIGINT) AS least, CAST(max(length(html)) AS BIGINT) AS most FROM pages",
)
def page_totals(spark, sf_dir):
    n = F.length("html").cast("long")
    return table(spark, sf_dir, "pages").agg(F.count("*").alias("n"), F.sum(n).alias("chars"), F.min(n).alias("least"), F.max(n).alias("most"))


@query(
    "coordinate_groups",
    """
SELECT CAST(round_even(l_extendedprice / 1500, 0) AS BIGINT) AS bucket, min(l_quantity) AS x0, max(l_quantity) AS x1, CAST(count(*) AS BIGINT) AS n
FROM lineitem GROUP BY 1 HAVING max(l_quantity) - min(l_quantity) >= 30
""",
)
def coordinate_groups(spark, sf_dir):
    groups = table(spark, sf_dir, "lineitem").groupBy(F.rint(F.col("l_extendedprice") / 1500).cast("long").alias("bucket"))
    return groups.agg(F.min("l_quantity").alias("x0"), F.max("l_quantity").alias("x1"), F.count("*").alias("n")).where("x1 - x0 >= 30")


@query(
    "measurement_union",
    """
WITH b AS (SELECT o_orderkey AS page, o_totalprice AS y FROM orders UNION ALL SELECT l_orderkey, l_extendedprice FROM lineitem),
m AS (SELECT page, min(y) AS top, max(y) AS bottom FROM b GROUP BY page)
SELECT page, CAST(round(top * 100) AS BIGINT) AS top_cents, CAST(round(bottom * 100) AS BIGINT) AS bottom_cents,
       CAST(floor(least(100, greatest(0, bottom / 5000))) AS BIGINT) AS utilization FROM m
""",
)
def measurement_union(spark, sf_dir):
    """Each side is reduced by page before the two meet."""
    ends = [F.min("y").alias("lo"), F.max("y").alias("hi")]
    a = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page"), F.col("o_totalprice").alias("y"))
    b = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_extendedprice").alias("y"))
    m = a.unionByName(b).groupBy("page").agg(*ends)
    use = F.floor(F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.col("hi") / 5000))).cast("long")
    return m.select("page", F.round(F.col("lo") * 100).cast("long").alias("top_cents"), F.round(F.col("hi") * 100).cast("long").alias("bottom_cents"), use.alias("utilization"))


@query(
    "having_one_candidate",
    """
SELECT l_orderkey, min(l_partkey) AS l_partkey FROM lineitem WHERE l_quantity >= 45 GROUP BY l_orderkey HAVING count(*) = 1
""",
)
def having_one_candidate(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").where("l_quantity >= 45").groupBy("l_orderkey").agg(F.min("l_partkey").alias("l_partkey"), F.count("*").alias("n")).where("n = 1").drop("n")


# --- ordered ------------------------------------------------------------------------------------


@query(
    "carry_forward_type",
    """
WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'purchase' THEN props WHEN event_type = 'signup' THEN chr(1) END AS mark FROM events)
SELECT event_id, sha256(nullif(last_value(mark IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id), chr(1))) AS carried FROM e
""",
)
def carry_forward_type(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    carried = O.carry_reset(F.when(F.col("event_type") == "purchase", F.col("props")), F.col("event_type") == "signup", ["user_id"], ["ts", "event_id"], "\x01")
    return e.select("event_id", F.sha2(carried, 256).alias("carried"))


@query(
    "gap_islands",
    """
WITH i AS (SELECT lang, doc_id, doc_id - row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS island FROM documents)
SELECT lang, min(doc_id) AS first_id, max(doc_id) AS last_id, CAST(count(*) AS BIGINT) AS n FROM i GROUP BY lang, island HAVING count(*) > 1
""",
)
def gap_islands(spark, sf_dir):
    """Runs of consecutive ids of one language: ids in blocks, so that no language is one task."""
    d = table(spark, sf_dir, "documents").select("lang", "doc_id")
    before = d.select("lang", (F.col("doc_id") + 1).alias("doc_id"), F.lit(True).alias("follows"))
    after = d.select("lang", (F.col("doc_id") - 1).alias("doc_id"), F.lit(True).alias("leads"))
    m = d.join(before, ["lang", "doc_id"], "left").join(after, ["lang", "doc_id"], "left")
    edge = m.where("follows IS NULL OR leads IS NULL").where("NOT (follows IS NULL AND leads IS NULL)")
    w = Window.partitionBy("lang").orderBy("doc_id")
    ends = edge.withColumn("last_id", F.lead("doc_id").over(w)).where("follows IS NULL")
    return ends.select("lang", F.col("doc_id").alias("first_id"), "last_id", (F.col("last_id") - F.col("doc_id") + 1).alias("n"))


@query(
    "run_length",
    """
WITH c AS (SELECT user_id, event_type, ts, event_id, CASE WHEN event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS starts FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
i AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM c),
r AS (SELECT user_id, island, event_type, count(*) AS size FROM i GROUP BY ALL)
SELECT event_type, CAST(size AS BIGINT) AS run, CAST(count(*) AS BIGINT) AS n FROM r GROUP BY event_type, size
""",
)
def run_length(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = e.withColumn("starts", ~F.coalesce(F.col("event_type") == F.lag("event_type").over(w), F.lit(False)))
    e = e.withColumn("island", O.island(F.col("starts"), ["user_id"], ["ts", "event_id"]))
    return e.groupBy("user_id", "island", "event_type").agg(F.count("*").alias("run")).groupBy("event_type", "run").agg(F.count("*").alias("n"))


@query(
    "dialogue_grouping",
    """
WITH g AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS grp FROM conversations)
SELECT conv_id, CAST(grp AS BIGINT) AS grp, CAST(count(*) AS BIGINT) AS n_turns, CAST(sum(length(text)) AS BIGINT) AS chars FROM g GROUP BY conv_id, grp
""",
)
def dialogue_grouping(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").withColumn("grp", O.island(F.col("role") == "user", ["conv_id"], ["turn"]))
    return c.groupBy("conv_id", "grp").agg(F.count("*").alias("n_turns"), F.sum(F.length("text")).alias("chars"))


@query(
    "question_bodies",
    """
SELECT conv_id, role, sha256(string_agg(text, ' ' ORDER BY turn)) AS body_sha256 FROM conversations GROUP BY conv_id, role
""",
)
def question_bodies(spark, sf_dir):
    parts = F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"])
    return table(spark, sf_dir, "conversations").groupBy("conv_id", "role").agg(F.sha2(F.array_join(parts, " "), 256).alias("body_sha256"))


@query(
    "missing_counterpart_reviews",
    """
WITH n AS (SELECT *, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS follows FROM conversations)
SELECT printf('review-p%03d-%s-%03d', conv_id, 'missing-answer', turn) AS review_id, conv_id, turn FROM n WHERE role = 'user' AND follows IS DISTINCT FROM 'assistant'
""",
)
def missing_counterpart_reviews(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(spark, sf_dir, "conversations").withColumn("follows", F.lead("role").over(w))
    lost = c.where((F.col("role") == "user") & ~F.col("follows").eqNullSafe("assistant"))
    return lost.select(T.review_id(F.col("conv_id"), F.lit("missing answer"), F.col("turn")).alias("review_id"), "conv_id", "turn")


@query(
    "prefix_selection",
    """
WITH b AS (SELECT *, sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM conversations)
SELECT conv_id, turn FROM b WHERE coalesce(before, 0) < 2
""",
)
def prefix_selection(spark, sf_dir):
    """Turns up to and with the second answer."""
    c = table(spark, sf_dir, "conversations")
    return c.withColumn("keep", O.running_prefix(F.col("role") == "assistant", ["conv_id"], ["turn"], 2)).where("keep").select("conv_id", "turn")


_REQUESTED = [14, 3, 19, 98, 7]


@query(
    "explicit_selection",
    f"""
SELECT CAST(r.pos AS BIGINT) AS pos, CAST(r.id AS BIGINT) AS doc_id, d.lang FROM (VALUES {', '.join(f'({k}, {i})' for k, i in enumerate(_REQUESTED))}) AS r(pos, id) JOIN documents d ON d.doc_id = r.id
""",
)
def explicit_selection(spark, sf_dir):
    wanted = spark.createDataFrame([(k, i) for k, i in enumerate(_REQUESTED)], "pos long, doc_id long")
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(F.broadcast(wanted), "doc_id").select("pos", "doc_id", "lang")


@query(
    "every_tenth_limit",
    """
WITH r AS (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i FROM documents),
b AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY i) AS k FROM r WHERE i > 0 AND i % 10 = 0)
SELECT lang, doc_id, CAST(i AS BIGINT) AS i FROM b WHERE k <= 15
""",
)
def every_tenth_limit(spark, sf_dir):
    """The first fifteen breaks lie in the first 151 rows of a language, so those alone are ranked."""
    d = table(spark, sf_dir, "documents").select("lang", "doc_id")
    w = Window.partitionBy("lang").orderBy("doc_id")
    top = d.withColumn("i", F.row_number().over(w)).where("i <= 151").withColumn("i", (F.col("i") - 1).cast("long"))
    return top.where("i > 0 AND i % 10 = 0").select("lang", "doc_id", "i")


@query("batch_of_four", "SELECT page_id, CAST(floor((row_number() OVER (ORDER BY page_id) - 1) / 4) AS BIGINT) AS batch FROM pages")
def batch_of_four(spark, sf_dir):
    """Global row numbers without one task: counts of sorted ranges give each range its first number."""
    ids = number_rows(table(spark, sf_dir, "pages").select("page_id"), ["page_id"])
    return ids.select("page_id", F.floor((F.col("row_number") - 1) / 4).cast("long").alias("batch"))


@query(
    "toc_entries",
    r"""
WITH h AS (SELECT page_id, url, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS title FROM pages)
SELECT page_id, title, regexp_extract(url, '://([^/]*)', 1) AS host,
       CAST(row_number() OVER (PARTITION BY regexp_extract(url, '://([^/]*)', 1) ORDER BY page_id) AS BIGINT) AS entry
FROM h WHERE title <> '' AND length(title) < 250 AND NOT regexp_matches(lower(title), 'questions|marks')
""",
)
def toc_entries(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<h1>([^<]*)</h1>", 1).alias("title"), F.regexp_extract("url", "://([^/]*)", 1).alias("host"))
    p = p.where((F.col("title") != "") & (F.length("title") < 250) & ~F.lower("title").rlike("questions|marks"))
    return p.withColumn("entry", F.row_number().over(Window.partitionBy("host").orderBy("page_id")).cast("long"))


_HEADING_RULES = [(1, "red", "warm"), (2, "blue", "cold"), (3, "steel", "metal"), (4, "r", "letter")]


@query(
    "last_rule_wins",
    f"""
WITH r(pos, pattern, action) AS (VALUES {', '.join(f"({k}, '{p}', '{a}')" for k, p, a in _HEADING_RULES)})
SELECT p_partkey, arg_max(action, pos) AS action FROM part JOIN r ON regexp_matches(p_name, pattern) GROUP BY p_partkey
""",
)
def last_rule_wins(spark, sf_dir):
    """The rules are few and fixed, so they are tried in the row, last first."""
    hit = None
    for _, pattern, action in reversed(_HEADING_RULES):
        match = F.col("p_name").rlike(pattern)
        hit = F.when(match, action) if hit is None else hit.when(match, action)
    return table(spark, sf_dir, "part").select("p_partkey", hit.alias("action")).where("action IS NOT NULL")


@query(
    "relocate_order",
    """
SELECT n_nationkey, CAST(row_number() OVER (ORDER BY CASE WHEN n_nationkey >= 10 AND n_nationkey < 15 THEN 5 ELSE n_nationkey END,
       CASE WHEN n_nationkey >= 10 AND n_nationkey < 15 THEN 0 ELSE 1 END, n_nationkey) AS BIGINT) AS new_pos FROM nation
""",
)
def relocate_order(spark, sf_dir):
    key = O.relocate(F.col("n_nationkey"), F.lit(10), F.lit(15), F.lit(5))
    return number_rows(table(spark, sf_dir, "nation").select("n_nationkey", key.alias("k")), ["k"]).select("n_nationkey", F.col("row_number").alias("new_pos"))


# --- joins ----------------------------------------------------------------------------------------

_ASOF = """
WITH p AS (SELECT user_id, ts, event_id AS anchor FROM events WHERE event_type = 'purchase')
SELECT e.event_id, p.anchor FROM events e ASOF LEFT JOIN p ON e.user_id = p.user_id AND e.ts {op} p.ts WHERE e.event_type = 'click'
"""


def _asof(spark, sf_dir, inclusive):
    e = table(spark, sf_dir, "events")
    clicks = e.where("event_type = 'click'").select("event_id", "user_id", "ts")
    anchors = e.where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("anchor"))
    return O.asof_backward(clicks, anchors, ["user_id"], "ts", "ts", ["anchor"], inclusive, tie="anchor").select("event_id", "anchor")


@query("asof_strict", _ASOF.format(op=">"))
def asof_strict(spark, sf_dir):
    return _asof(spark, sf_dir, inclusive=False)


@query("asof_inclusive", _ASOF.format(op=">="))
def asof_inclusive(spark, sf_dir):
    return _asof(spark, sf_dir, inclusive=True)


_SOURCE_PAGES = [3, 14, 19, 7]


@query(
    "positional_map",
    f"""
WITH p(pos, page) AS (VALUES {', '.join(f'({k + 1}, {v})' for k, v in enumerate(_SOURCE_PAGES))}),
r AS (SELECT r_regionkey, row_number() OVER (ORDER BY r_regionkey) AS pos FROM region)
SELECT r_regionkey, CAST(page AS BIGINT) AS source_page FROM r LEFT JOIN p USING (pos)
""",
)
def positional_map(spark, sf_dir):
    pages = spark.createDataFrame([(k + 1, v) for k, v in enumerate(_SOURCE_PAGES)], "row_number long, source_page long")
    return number_rows(table(spark, sf_dir, "region").select("r_regionkey"), ["r_regionkey"]).join(F.broadcast(pages), "row_number", "left").select("r_regionkey", "source_page")


@query(
    "override_lookup",
    "SELECT p_partkey, coalesce(CASE p_partkey WHEN 5 THEN 'first override' WHEN 17 THEN 'second override' END, p_name) AS name FROM part",
)
def override_lookup(spark, sf_dir):
    over = spark.createDataFrame([(5, "first override"), (17, "second override")], "p_partkey long, over string")
    return table(spark, sf_dir, "part").join(F.broadcast(over), "p_partkey", "left").select("p_partkey", F.coalesce("over", "p_name").alias("name"))


@query(
    "fk_anti",
    """
SELECT 'orders' AS kind, o_orderkey AS id FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
UNION ALL SELECT 'documents', doc_id FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)
""",
)
def fk_anti(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")).join(lines, "id", "left_anti")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")).join(labels, "id", "left_anti")
    return orders.select(F.lit("orders").alias("kind"), "id").unionByName(docs.select(F.lit("documents").alias("kind"), "id"))


@query(
    "range_overlap_check",
    """
WITH r AS (SELECT o_custkey, o_orderkey, o_orderdate, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) + INTERVAL 30 DAY AS before FROM orders)
SELECT o_custkey, o_orderkey FROM r WHERE o_orderdate <= before
""",
)
def range_overlap_check(spark, sf_dir):
    """Thirty-day ranges of one customer that begin before the last one ended."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = table(spark, sf_dir, "orders").withColumn("before", F.lag("o_orderdate").over(w) + F.expr("INTERVAL 30 DAY"))
    return o.where("o_orderdate <= before").select("o_custkey", "o_orderkey")


@query(
    "regex_range_chapters",
    r"""
WITH s AS (SELECT source, min(doc_id) AS first_id FROM documents WHERE regexp_matches(text, '(?i)licensed under') GROUP BY source),
e AS (SELECT d.source, min(d.doc_id) AS end_id FROM documents d JOIN s USING (source) WHERE d.doc_id > s.first_id AND regexp_matches(d.text, '(?i)rights reserved') GROUP BY d.source),
m AS (SELECT source, max(doc_id) AS max_id FROM documents GROUP BY source)
SELECT s.source, s.first_id, coalesce(e.end_id - 1, m.max_id) AS last_id, CAST((SELECT count(*) FROM documents d WHERE d.source = s.source AND d.doc_id BETWEEN s.first_id AND coalesce(e.end_id - 1, m.max_id)) AS BIGINT) AS n
FROM s JOIN m USING (source) LEFT JOIN e USING (source)
""",
)
def regex_range_chapters(spark, sf_dir):
    """From the first start to just before the first end after it, or to the last row."""
    d = table(spark, sf_dir, "documents").select("source", "doc_id", F.col("text").rlike("(?i)licensed under").alias("starts"), F.col("text").rlike("(?i)rights reserved").alias("ends"))
    spans = d.groupBy("source").agg(F.min(F.when(F.col("starts"), F.col("doc_id"))).alias("first_id"), F.max("doc_id").alias("max_id")).where("first_id IS NOT NULL")
    inside = d.join(spans, "source").where("doc_id >= first_id")
    ends = inside.where("ends AND doc_id > first_id").groupBy("source").agg((F.min("doc_id") - 1).alias("before_end"))
    spans = spans.join(ends, "source", "left").select("source", "first_id", F.coalesce("before_end", "max_id").alias("last_id"))
    counts = d.join(spans, "source").where("doc_id BETWEEN first_id AND last_id").groupBy("source", "first_id", "last_id").agg(F.count("*").alias("n"))
    return counts


@query(
    "broken_links",
    r"""
WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="/([^"/]*)"', 1)) AS target FROM pages),
k AS (SELECT DISTINCT regexp_extract(url, '://[^/]*/([^/?#]*)', 1) AS target FROM pages)
SELECT page_id, CAST(count(*) AS BIGINT) AS n_broken FROM h WHERE target NOT IN (SELECT target FROM k) GROUP BY page_id
""",
)
def broken_links(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    links = p.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="/([^"/]*)"'), F.lit(1))).alias("target"))
    known = p.select(F.regexp_extract("url", "://[^/]*/([^/?#]*)", 1).alias("target")).distinct()
    return links.join(known, "target", "left_anti").groupBy("page_id").agg(F.count("*").alias("n_broken"))


@query("external_links", r"SELECT regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '://([^/]*)', 1) AS host, CAST(count(*) AS BIGINT) AS n FROM pages GROUP BY ALL")
def external_links(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.groupBy(F.regexp_extract("url", "^([a-z]+)://", 1).alias("scheme"), F.regexp_extract("url", "://([^/]*)", 1).alias("host")).agg(F.count("*").alias("n"))


@query(
    "fuzzy_missing",
    """
WITH w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part)
SELECT word FROM w WHERE NOT EXISTS (SELECT 1 FROM nation WHERE contains(lower(n_name), word) OR (length(n_name) > 4 AND contains(word, lower(n_name))))
""",
)
def fuzzy_missing(spark, sf_dir):
    """Words that no nation's name holds or is held by; the nations are a fixed list of 25."""
    words = table(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    names = table(spark, sf_dir, "nation").agg(F.collect_set(F.lower("n_name")).alias("names"))
    met = words.join(F.broadcast(names), F.lit(True), "left")
    return met.where(~F.exists("names", lambda n: F.contains(n, F.col("word")) | ((F.length(n) > 4) & F.contains(F.col("word"), n)))).select("word")


@query(
    "zip_pairs",
    """
WITH u AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations WHERE role = 'assistant')
SELECT conv_id, CAST(k AS BIGINT) AS k, u.turn AS user_turn, a.turn AS assistant_turn FROM u JOIN a USING (conv_id, k)
""",
)
def zip_pairs(spark, sf_dir):
    """One sort by conversation and role numbers both sides; pairs meet in an aggregate, not a join."""
    c = table(spark, sf_dir, "conversations").where("role IN ('user', 'assistant')")
    c = c.withColumn("k", F.row_number().over(Window.partitionBy("conv_id", "role").orderBy("turn")).cast("long"))
    sides = [F.max(F.when(F.col("role") == r, F.col("turn"))).alias(f"{r}_turn") for r in ("user", "assistant")]
    return c.groupBy("conv_id", "k").agg(*sides).where("user_turn IS NOT NULL AND assistant_turn IS NOT NULL")


@query(
    "structural_diff",
    """
WITH e AS (SELECT o_orderpriority AS k, count(*) AS n FROM orders GROUP BY 1), a AS (SELECT o_orderpriority AS k, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' GROUP BY 1)
SELECT coalesce(e.k, a.k) AS k, CAST(e.n AS BIGINT) AS expected, CAST(a.n AS BIGINT) AS actual FROM e FULL JOIN a ON e.k = a.k WHERE e.n IS DISTINCT FROM a.n
""",
)
def structural_diff(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("k", F.col("o_orderpriority"))
    left = o.where("o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'")
    count = lambda df: df.groupBy("k").agg(F.count("*").alias("n"))
    return C.count_diff(count(o), count(left), "k", "n")


# --- contracts, sets, graphs -------------------------------------------------------------------------


@query(
    "uniqueness_violations",
    "SELECT 'line' AS rule_id, 'error' AS severity, concat_ws('/', l_orderkey, l_linenumber) AS key FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
)
def uniqueness_violations(spark, sf_dir):
    return C.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "line")


@query(
    "contract_violations",
    """
SELECT 'price' AS rule_id, 'error' AS severity, CAST(o_orderkey AS VARCHAR) AS key FROM orders WHERE o_totalprice > 400000
UNION ALL SELECT 'status', 'error', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus NOT IN ('O', 'F')
UNION ALL SELECT 'priority', 'warning', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'
UNION ALL SELECT 'lines', 'error', CAST(l_orderkey AS VARCHAR) FROM (SELECT DISTINCT l_orderkey FROM lineitem) l WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
""",
)
def contract_violations(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    rules = [
        C.RowRule("price", F.col("o_totalprice") > 400000),
        C.RowRule("status", ~F.col("o_orderstatus").isin("O", "F")),
        C.RowRule("priority", F.col("o_orderpriority") == "4-NOT SPECIFIED", "warning"),
    ]
    lost = C.missing_references(table(spark, sf_dir, "lineitem"), orders, "l_orderkey", "o_orderkey", "lines")
    return C.all_violations(C.row_violations(orders, F.col("o_orderkey"), rules), lost)


@query("anchor_containment", "SELECT item_id, CAST(count(*) AS BIGINT) AS n_docs, min(doc_id) AS first_doc FROM benchmark b JOIN documents d ON contains(d.text, b.text) GROUP BY item_id")
def anchor_containment(spark, sf_dir):
    """Documents that hold an anchor text, looked for all at once in one pass over each text."""
    anchors, docs = table(spark, sf_dir, "benchmark").select("item_id", "text"), table(spark, sf_dir, "documents").select("doc_id", "text")
    found = containment(docs, anchors.withColumnRenamed("text", "anchor"), "item_id", "anchor", "doc_id", "text")
    return found.groupBy("item_id").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))


@query(
    "numbering_review",
    """
WITH d AS (SELECT doc_id AS doc, text FROM documents WHERE text IS NOT NULL),
c AS (SELECT doc, 1 AS check_no, substr(text, doc % 50 + 1, 20) || CASE WHEN doc % 7 = 0 THEN '#' ELSE '' END AS anchor, CASE WHEN doc % 3 = 0 THEN 'Q' || (doc % 10) ELSE '' END AS label, ['e', substr(text, 5, 3), ''] AS options FROM d WHERE doc % 11 > 0
      UNION ALL SELECT doc, 2, CASE WHEN doc % 5 > 0 THEN substr(text, length(text) - 4, 5) END, NULL, NULL FROM d WHERE doc % 11 > 0)
SELECT doc, check_no, 'anchor_absent' AS rule, coalesce(anchor, '') AS value FROM c JOIN d USING (doc) WHERE coalesce(anchor, '') = '' OR NOT contains(text, anchor)
UNION ALL SELECT doc, check_no, 'label_absent', label FROM c JOIN d USING (doc) WHERE label <> '' AND NOT contains(text, label)
UNION ALL SELECT doc, check_no, 'option_absent', o FROM (SELECT doc, check_no, unnest(options) AS o FROM c) JOIN d USING (doc) WHERE NOT contains(text, o)
UNION ALL SELECT doc, NULL, 'review_missing', '' FROM d WHERE doc % 11 = 0
""",
)
def numbering_review(spark, sf_dir):
    """Checks of numbers, labels and options that a document's own text doesn't bear out."""
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL").select(F.col("doc_id").alias("doc"), "text")
    k = F.col("doc")
    first = d.where("doc % 11 > 0").select(
        "doc", F.lit(1).alias("check_no"), F.concat(F.substr("text", (k % 50 + 1).cast("int"), F.lit(20)), F.when(k % 7 == 0, "#").otherwise("")).alias("anchor"),
        F.when(k % 3 == 0, F.concat(F.lit("Q"), (k % 10).cast("string"))).otherwise("").alias("label"), F.array(F.lit("e"), F.substring("text", 5, 3), F.lit("")).alias("options"),
    )
    second = d.where("doc % 11 > 0").select("doc", F.lit(2).alias("check_no"), F.when(k % 5 > 0, F.substr("text", F.greatest(F.length("text") - 4, F.lit(1)), F.lit(5))).alias("anchor"), F.lit(None).cast("string").alias("label"), F.lit(None).cast("array<string>").alias("options"))
    return numbering_check(first.unionByName(second), d)


@query(
    "closure_tree",
    """
WITH RECURSIVE c AS (SELECT p_partkey AS root, p_partkey AS node, 0 AS depth FROM part
  UNION ALL SELECT root, node // 10, depth + 1 FROM c WHERE node // 10 > 0)
SELECT root, node, CAST(depth AS BIGINT) AS depth FROM c
""",
)
def closure_tree(spark, sf_dir):
    """Every ancestor of each part, where a part's parent is its key without the last digit."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("root"))
    edges = parts.select(F.col("root").alias("src"), F.floor(F.col("root") / 10).cast("long").alias("dst")).where("dst > 0")
    return K.closure(edges, parts, depth=True).select("root", "node", F.col("depth").cast("long").alias("depth"))


@query(
    "closure_cycles",
    """
WITH RECURSIVE e AS (SELECT s_suppkey AS src, (s_suppkey * 7 + 3) % (SELECT count(*) FROM supplier) + 1 AS dst FROM supplier
                     UNION SELECT s_suppkey, s_suppkey + s_nationkey FROM supplier WHERE s_nationkey < 6),
c AS (SELECT s_suppkey AS root, s_suppkey AS node FROM supplier WHERE s_acctbal > 5000 UNION SELECT root, dst FROM c JOIN e ON c.node = e.src)
SELECT root, node FROM c
""",
)
def closure_cycles(spark, sf_dir):
    """What each rich supplier reaches in a graph with loops and cycles."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    n = s.agg(F.count("*").alias("n"))
    ring = s.join(F.broadcast(n), F.lit(True)).select(F.col("s_suppkey").alias("src"), ((F.col("s_suppkey") * 7 + 3) % F.col("n") + 1).alias("dst"))
    near = s.where("s_nationkey < 6").select(F.col("s_suppkey").alias("src"), (F.col("s_suppkey") + F.col("s_nationkey")).alias("dst"))
    return K.closure_by_components(ring.unionByName(near), s.where("s_acctbal > 5000").select(F.col("s_suppkey").alias("root")))


@query(
    "id_remap_collisions",
    """
WITH used AS (SELECT s_suppkey AS id FROM supplier), req AS (SELECT DISTINCT p_partkey AS id FROM part WHERE p_size > 40),
top AS (SELECT max(id) AS m FROM (SELECT id FROM used UNION ALL SELECT id FROM req)),
hit AS (SELECT id, row_number() OVER (ORDER BY id) AS k FROM req WHERE id IN (SELECT id FROM used))
SELECT req.id, CAST(coalesce(m + k, req.id) AS BIGINT) AS new_id FROM req CROSS JOIN top LEFT JOIN hit ON hit.id = req.id
""",
)
def id_remap_collisions(spark, sf_dir):
    used = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    required = table(spark, sf_dir, "part").where("p_size > 40").select(F.col("p_partkey").alias("id")).distinct()
    return K.remap_ids(required, used)


@query(
    "name_dedupe_suffix",
    """
WITH n AS (SELECT p_partkey, p_name, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS k FROM part)
SELECT p_partkey, CASE WHEN k = 1 THEN p_name ELSE p_name || '_src' || (k - 1) END AS name FROM n
""",
)
def name_dedupe_suffix(spark, sf_dir):
    w = Window.partitionBy("p_name").orderBy("p_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.row_number().over(w).alias("k"))
    return p.select("p_partkey", F.when(F.col("k") == 1, F.col("p_name")).otherwise(F.concat("p_name", F.lit("_src"), (F.col("k") - 1).cast("string"))).alias("name"))


@query(
    "set_difference",
    """
SELECT 'only_customer' AS kind, k FROM (SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9900 EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)
UNION ALL SELECT 'both', k FROM (SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9900 INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)
""",
)
def set_difference(spark, sf_dir):
    c = table(spark, sf_dir, "customer").where("c_acctbal > 9900").select(F.col("c_nationkey").alias("k"))
    s = table(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("k"))
    return c.subtract(s).select(F.lit("only_customer").alias("kind"), "k").unionByName(c.intersect(s).select(F.lit("both").alias("kind"), "k"))


@query(
    "status_head_history",
    """
SELECT user_id, arg_max(event_type, struct_pack(t := ts, e := event_id)) AS head, CAST(count(*) AS BIGINT) AS n_states, sha256(string_agg(event_type, '>' ORDER BY ts, event_id)) AS history_sha256
FROM events GROUP BY user_id
""",
)
def status_head_history(spark, sf_dir):
    order = F.struct("ts", "event_id")
    history = F.transform(F.sort_array(F.collect_list(F.struct("ts", "event_id", "event_type"))), lambda s: s["event_type"])
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.max_by("event_type", order).alias("head"), F.count("*").alias("n_states"), F.sha2(F.array_join(history, ">"), 256).alias("history_sha256"))


@query(
    "gate_decision",
    """
WITH e AS (SELECT o_orderkey AS k, upper(sha256(o_orderpriority)) AS h FROM orders),
a AS (SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE upper(sha256(o_orderpriority)) END AS h FROM orders WHERE o_totalprice > 1000)
SELECT e.k, coalesce(e.h = a.h, false) AS passed FROM e LEFT JOIN a ON e.k = a.k
""",
)
def gate_decision(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), T.upper_sha256(F.col("o_orderpriority")).alias("h"), "o_orderstatus", "o_totalprice")
    actual = o.where("o_totalprice > 1000").select("k", F.when(F.col("o_orderstatus") != "P", F.col("h")).alias("h"))
    return C.hash_gate(o, actual, "k", "h")


@query(
    "page_rule_severity",
    """
WITH o AS (SELECT o_orderkey, o_totalprice / 5000 AS use, o_orderstatus FROM orders)
SELECT o_orderkey, CASE WHEN use < 20 THEN 'error' ELSE 'warning' END AS severity, 'utilization' AS rule FROM o WHERE use < 40 AND o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey, 'error', 'status' FROM o WHERE o_orderstatus = 'P'
""",
)
def page_rule_severity(spark, sf_dir):
    use = F.col("o_totalprice") / 5000
    low = F.when((use < 40) & (F.col("o_orderstatus") != "P"), F.struct(F.when(use < 20, "error").otherwise("warning").alias("severity"), F.lit("utilization").alias("rule")))
    status = F.when(F.col("o_orderstatus") == "P", F.struct(F.lit("error").alias("severity"), F.lit("status").alias("rule")))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.explode(F.array_compact(F.array(low, status))).alias("v")).select("o_orderkey", "v.severity", "v.rule")


@query(
    "dpi_gate",
    """
SELECT p_partkey, least(p_retailprice / (p_size / 10.0), p_retailprice * 1.5 / (p_size / 10.0)) + 0.5 >= 300 AS passed FROM part
""",
)
def dpi_gate(spark, sf_dir):
    size = F.col("p_size") / F.lit(10.0)
    dpi = T.effective_dpi(F.col("p_retailprice"), F.col("p_retailprice") * 1.5, size, size)
    return table(spark, sf_dir, "part").select("p_partkey", T.dpi_passes(dpi).alias("passed"))
