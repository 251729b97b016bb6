"""Secret scans: candidate strings, and a random forest that removes false positives (native).

Candidates are found by pattern in the whole text: whatever a secret name is assigned, of any
length and characters, in line, aligned or on the next line; strings that begin as known keys do; and other
strings of 16 or more key-like characters that hold a digit.  A secret name is an identifier one of whose
words is a secret word as a whole (``db_passwd``, ``apiKey``, ``tokens``; not ``author`` or ``secretary``).
The forest sees each candidate's length, its transitions between character classes and between letters, how much of it
dictionary words cover, whether it looks like a path, how it is assigned, and the words beside it; it is trained from
labelled findings.  The trained trees become one SQL expression, so scoring and redaction stay inside the row: no
shuffle, no Python.

Defined cases: null and empty texts have no candidates and stay as they are; repeated rows
and further columns pass through; an empty table gives an empty result.  An unquoted value of letters alone,
in the case of a word, that a blank parts from ``word:`` is prose (``token: economy``) and scores 0.  On the next line, what
is itself a name with an assignment is no value.  U+FFFF and U+FFFE mark candidates inside the expression; where a text
holds them already, they read as blanks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.llm.names import put_back, set_apart

MARK, TAG = "\uffff", "\ufffe"
# Words beside a candidate that speak for or against a secret, and words that names are made of.
FOR_WORDS = "token|secret|password|passwd|pwd|apikey|api_key|api-key|access_key|auth|bearer|credential|private_key"
AGAINST_WORDS = "commit|sha1|sha256|md5|checksum|digest|etag|uuid|guid|isbn|revision|order|card|phone|invoice|example|placeholder|href|src"
#: A secret word that ends where a word of an identifier ends; it may be a plural.
SECRET_WORD = "(?:(?i:token|secret|password|passwd|passphrase|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth(?:orization)?|bearer|credential)[sS]?)(?:(?![A-Za-z])|(?<=[a-z])(?=[A-Z]))"
ASSIGNED = "[\"'`]?\\]?[ \\t]*+(?::=|=>|[:=](?![:=]))"
#: A secret name and its assignment, in front of the value.  Each identifier is looked at once, whatever its length.
NAMED = (
    f"(?<![A-Za-z0-9_\\u00C0-\\u024F-])(?=[A-Za-z0-9_-]++{ASSIGNED})(?=[A-Za-z0-9_-]*?{SECRET_WORD})[A-Za-z0-9_-]++{ASSIGNED}[ \\t]*+"
    "(?:\\r?\\n[ \\t]*+(?:-[ \\t]++)?(?![A-Za-z_][A-Za-z0-9_.-]*+[\"'`]?[ \\t]*+(?::|=(?!=?[ \\t]*+(?:[\\r\\n]|$)))))?(?:(?i:bearer|basic)[ \\t]++)?"
)
VALUE = "(?<=[\"'`])[^\"'`\\n]+(?=[\"'`])|[^\\s\"'`]*[^\\s\"'`,;.)\\]}]"
KNOWN = (
    "(?:(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])|(?:gh[opsur]_|github_pat_|glpat-|[sr]k_(?:live|test)_|xox[abeprs]-|AIza|npm_|hf_|sk-)[A-Za-z0-9_-]{16,})"
)
#: The value of a secret name ($2 after $1), a key of known make, or a run of key characters with at least one digit, 16 characters at least ($3).
CANDIDATE = (
    f"({NAMED}[\"'`]?)({VALUE})|((?<![A-Za-z0-9+/_.-])(?=[A-Za-z+/_.-]*+[0-9])[A-Za-z0-9+/_.-]{{16,}}={{0,2}}|(?<![A-Za-z0-9]){KNOWN})"
)
#: A word as prose writes it, and a plain word with a colon and a blank in front of it.
NATURAL = "^(?:\\p{Lu}?[\\p{Ll}\\p{Lo}\\p{M}]++|\\p{Lu}++)(?:[-\\u2019/](?:\\p{Lu}?[\\p{Ll}\\p{Lo}\\p{M}]++|\\p{Lu}++)){0,4}\\p{P}*+$"
PROSE_NAME = "(?:^|[^A-Za-z0-9_-])(?:[A-Z]?[a-z]+|[A-Z]+)\\s*:\\s+(?:(?i:bearer|basic)\\s+)?$"
DICTIONARY = (
    "access account address admin agent alpha android apple array asset backup batch beta binary block board book branch bucket build button cache "
    "camera center change chapter class client cloud code color column comment commit common config content context control copy count create custom "
    "data date debug default delete demo design detail device digest display document domain download draft driver edit email engine error event example "
    "export factory field file filter final flag folder font form format frame function general global graph group guide handler header height help "
    "history home host icon image import index info input install item job kernel label language layer layout level library license light line link "
    "list local log main manager map master matrix media member menu message method mobile model module month name network node note number object "
    "office open option order output package page panel paper part path pattern phone photo picture plan player plugin point policy port post preview "
    "price print private process product profile program project public query random range read record release remote report request reset resource "
    "response result review role root route row rule sample scale schema screen script search section select server service session set setting share "
    "site size small sort source space stack start state static status storage store stream string style summary support system table tag target task "
    "temp test text theme thread time title tool total track type unit update upload user utils value version video view volume web week width window "
    "word work write year zone"
).split()

FEATURES = (
    "length", "transitions", "letter_transitions", "distinct_share", "digit_share", "covered", "path", "for_words", "against_words", "assigned", "quoted", "spaced",
    "named", "natural", "known", "only_digits", "placeholder",
)


def _letter_log_odds() -> list[float]:
    """Log probability of each letter after each letter in dictionary words, over that of any letter; a flat 26 by 26 table."""
    counts = [[0.5] * 26 for _ in range(26)]
    for w in DICTIONARY:
        for x, y in zip(w, w[1:]):
            counts[ord(x) - 97][ord(y) - 97] += 1
    return [math.log(26 * v / sum(row)) for row in counts for v in row]


def letter_transitions(c: Column) -> Column:
    """Mean log odds of the transitions between neighbouring letters a-z; 0 without any.  Linear in the text."""
    odds = F.split(F.lit(" ".join(map(str, _letter_log_odds()))), " ").cast("array<double>")
    at = F.transform(F.split(F.lower(c), ""), lambda x: F.when(x.between("a", "z") & (F.length(x) == 1), F.ascii(x) - 97))
    pairs = F.filter(F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at) - 1, F.lit(0))), lambda x, y: x * 26 + y), lambda k: k.isNotNull())
    total = F.aggregate(pairs, F.lit(0.0), lambda a, k: a + F.get(odds, k))
    return F.when(F.size(pairs) > 0, total / F.size(pairs)).otherwise(0.0)


def is_prose(c: Column, before: Column) -> Column:
    """An unquoted word of letters alone, after a plain word, a colon and a blank."""
    return F.right(before, F.lit(64)).rlike(PROSE_NAME) & c.rlike(NATURAL) & ~c.rlike(f"^{KNOWN}")


def features(c: Column, before: Column, after: Column, named: Column | None = None) -> dict[str, Column]:
    """Features of candidate ``c`` between the texts ``before`` and ``after``; ``named``: a secret name is assigned it."""
    named = F.right(before, F.lit(256)).rlike(f"{NAMED}[\"'`]?$") if named is None else named
    n = F.length(c).cast("double")
    bare = F.rtrim(before, F.lit(" \t\r\n\"'`"))
    near = F.lower(F.concat_ws(" ", F.right(bare, F.lit(48)), F.left(after, F.lit(24))))
    pieces = F.filter(F.split(F.lower(F.regexp_replace(c, "([a-z])([A-Z])", "$1 $2")), "[^a-z]+"), lambda w: F.length(w) >= 3)
    covered = F.aggregate(F.filter(pieces, lambda w: w.isin(DICTIONARY)), F.lit(0), lambda a, w: a + F.length(w))
    kinds = F.regexp_count(c, F.lit("[a-z](?=[^a-z])|[A-Z](?=[^A-Z])|[0-9](?=[^0-9])|[^A-Za-z0-9](?=[A-Za-z0-9])"))
    return {
        "length": n,
        "transitions": kinds / n,
        "letter_transitions": letter_transitions(c),
        "distinct_share": F.size(F.array_distinct(F.split(c, ""))) / n,
        "digit_share": F.regexp_count(c, F.lit("[0-9]")) / n,
        "covered": covered / n,
        "path": F.regexp_count(c, F.lit("[/.]")) / n,
        "for_words": F.least(F.regexp_count(near, F.lit(FOR_WORDS)), F.lit(3)).cast("double"),
        "against_words": F.least(F.regexp_count(near, F.lit(AGAINST_WORDS)), F.lit(3)).cast("double"),
        "assigned": F.right(bare, F.lit(2)).rlike("[:=]$|=>$").cast("double"),
        "quoted": F.right(before, F.lit(1)).rlike("[\"'`]").cast("double"),
        "spaced": F.right(before, F.lit(1)).rlike("\\s").cast("double"),
        "named": named.cast("double"),
        "natural": c.rlike(NATURAL).cast("double"),
        "known": c.rlike(f"^{KNOWN}").cast("double"),
        "only_digits": c.rlike("^[0-9.-]+$").cast("double"),
        "placeholder": F.lower(c).rlike("(.)\\1{5}|12345678|abcdefgh|xxxx|^[$<{%\\[]|[(]|^(?:none|null|nil|true|false|required|optional|changeme)$").cast("double"),
    }


def labelled_findings(spark: SparkSession, rows: int = 4000) -> DataFrame:
    """Labelled findings (candidate, before, after, label) made by rule from hashes of a row number.

    Half are secrets: keys of several makes (those of known make also without a name) and passwords, after words that name
    them.  Half are findings that reviewers reject: digests, identifiers, paths, compound names, numbers,
    placeholders, and words (of the dictionary and others), small numbers, paths, references and calls after secret names.
    """
    h = F.sha2(F.concat(F.lit("f"), F.col("id").cast("string")), 512)
    number = lambda at: F.conv(F.substring(h, at, 4), 16, 10).cast("int")
    pick = lambda at, *xs: F.element_at(F.array(*map(F.lit, xs)), (number(at) % len(xs) + 1).cast("int"))
    b64 = F.regexp_replace(F.base64(F.unhex(F.substring(h, 20, 60))), "\\s", "")
    dictionary = F.split(F.lit(" ".join(DICTIONARY)), " ")
    word = lambda at: F.get(dictionary, number(at) % len(DICTIONARY))
    quote = pick(100, '"', "'", "")
    name = pick(104, "token", "secret", "password", "api_key", "access_key", "auth_token", "client_secret", "private_key", "credential", "apikey")
    assign = pick(112, " = ", "=", ": ", ":", "     = ", ":\n  ")
    given = F.concat(F.lit("some words "), name, assign, quote)
    plain = F.concat(word(60), F.lit(" "), pick(64, "commit", "sha256", "checksum", "md5", "uuid", "order", "card", "phone", "see", "the", "invoice", "etag", "and", "of"), pick(68, " ", " ", ": ", " = "))
    kind = F.col("id") % 10
    secret = (
        F.when(kind == 0, F.substring(h, 1, 40)).when(kind == 2, F.substring(b64, 1, 32)).when(kind == 4, F.concat(F.lit("AKIA"), F.upper(F.substring(h, 5, 16))))
        .when(kind == 6, F.concat(F.lit("ghp_"), F.substring(F.regexp_replace(b64, "[+/=]", "x"), 1, 36))).otherwise(F.concat(F.lit("sk_live_"), F.substring(h, 9, 24)))
    )
    uuid = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))
    digits = F.translate(F.substring(h, 1, 16), "abcdef", "135790")
    other = (
        F.when(kind == 1, F.element_at(F.array(F.substring(h, 1, 40), F.substring(h, 1, 64), uuid), (F.col("id") / 10 % 3 + 1).cast("int")))
        .when(kind == 3, F.concat(F.lit("/"), word(8), F.lit("/"), word(12), F.lit("/"), word(16), F.lit("2."), F.substring(digits, 1, 2)))
        .when(kind == 5, F.concat_ws("_", word(8), word(12), word(16), F.substring(digits, 1, 4))).when(kind == 7, digits)
        .otherwise(F.element_at(F.array(F.lit("xxxxxxxxxxxxxxxxxxxx1234"), F.lit("1234567890123456789012"), F.concat(F.lit("your-"), word(8), F.lit("-key-here-0000000"))), (F.col("id") / 10 % 3 + 1).cast("int")))
    )
    turn = (F.col("id") / 10).cast("int")
    choose = lambda *xs: F.element_at(F.array(*xs), (turn / 3).cast("int") % len(xs) + 1)
    syllables = lambda n: F.concat(*[x for k in range(n) for x in (pick(8 * k + 9, *"bcdfghlmnprstvwz", "st", "tr", "ch"), pick(8 * k + 13, *"aeiou", "ie", "ou", "é", "ä"))])
    letters = F.translate(F.substring(h, 5, 16), "0123456789", "ghijklmnop")
    mixed = F.regexp_replace(b64, "[+/=]", "x")
    password = choose(
        F.substring(mixed, 1, 10), F.concat(word(8), F.substring(digits, 1, 2), F.lit("!")), F.substring(letters, 1, 9), F.concat(F.lit("AKIA"), F.upper(letters)),
        F.concat(F.substring(mixed, 1, 4), F.lit("#"), F.substring(mixed, 5, 4)), F.substring(F.translate(mixed, "0123456789", "qwzyvQWZYV"), 1, 24),
        F.concat(word(8), F.substring(digits, 1, 1)), F.concat(word(8), F.substring(digits, 1, 1), word(12), F.substring(digits, 2, 2)), F.concat(syllables(3), F.substring(digits, 1, 3)),
        F.concat(F.initcap(syllables(2)), pick(30, "#", "!", "$", "_"), F.substring(digits, 1, 4)), F.substring(F.translate(letters, "aeiou", "qzxwv"), 1, 9),
    )
    no_value = choose(
        word(8), F.concat_ws("_", word(8), word(12)), F.concat(F.lit("${"), F.upper(word(8)), F.lit("_TOKEN}")), F.concat_ws(".", word(8), word(12)),
        F.concat(F.lit("get_"), word(8), F.lit("()")), pick(8, "none", "null", "true", "false", "required", "optional", "<password>"),
        syllables(3), F.initcap(syllables(2)), F.concat(syllables(3), pick(30, "r", "n", "st", "ng", "s")), F.substring(digits, 1, 2), F.concat(F.lit("/"), word(8), F.lit("/"), word(12)),
    )
    named = (turn % 3 == 1) & kind.isin(4, 5, 8, 9)
    bare = (turn % 3 == 2) & kind.isin(4, 6, 8)
    secret, other = F.when(named, password).otherwise(secret), F.when(named, no_value).otherwise(other)
    is_secret = F.col("id") % 2 == 0
    return spark.range(rows).select(
        F.when(is_secret, secret).otherwise(other).alias("candidate"),
        F.when((is_secret & ~bare) | named | ((kind == 9) & (F.col("id") % 3 == 0)), given).otherwise(plain).alias("before"),
        F.when(quote == "", F.lit(" ")).otherwise(F.concat(quote, F.lit(" and more"))).alias("after"),
        is_secret.cast("double").alias("label"),
    )


@dataclass(frozen=True)
class Forest:
    """Trees as nested tuples: (feature, threshold, left, right), or a leaf's share of secrets."""

    trees: tuple

    def score(self, values: list[Column]) -> Column:
        def walk(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            feature, threshold, left, right = node
            return F.when(values[feature] <= threshold, walk(left)).otherwise(walk(right))

        total = walk(self.trees[0])
        for tree in self.trees[1:]:
            total = total + walk(tree)
        return total / F.lit(float(len(self.trees)))


def fit_forest(findings: DataFrame, trees: int = 16, depth: int = 5, seed: int = 11) -> Forest:
    """Fit on (candidate, before, after, label); the labelled findings are a small table."""
    cols = features(F.col("candidate"), F.col("before"), F.col("after"))
    rows = findings.select(*[v.cast("double").alias(k) for k, v in cols.items()], "label")
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(rows).select("x", "label").persist()
    try:
        fitted = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed).fit(rows)
    finally:
        rows.unpersist()

    def read(node):
        if node.numDescendants() == 0:
            stats = list(node.impurityStats().stats())
            return float(stats[1] / sum(stats))
        return node.split().featureIndex(), float(node.split().threshold()), read(node.leftChild()), read(node.rightChild())

    return Forest(tuple(read(t._call_java("rootNode")) for t in fitted.trees))


def secret_scan(documents: DataFrame, text: str = "text", forest: Forest | None = None, threshold: float = 0.5) -> DataFrame:
    """documents plus n_candidates, n_secrets, secret_spans and ``redacted``.

    ``secret_spans`` is an array of (start, end, score), in code points of the text;
    ``redacted`` is the text with each secret replaced by ``[SECRET]``.
    """
    forest = forest or fit_forest(labelled_findings(documents.sparkSession))
    df, names = set_apart(documents.drop("n_candidates", "n_secrets", "secret_spans", "redacted"))
    cols = [F.col(f"`{c}`") for c in df.columns]
    t = F.col(f"`{text}`")
    clean = F.when(F.contains(t, F.lit(MARK)) | F.contains(t, F.lit(TAG)), F.translate(t, MARK + TAG, "  ")).otherwise(t)
    # a cheap test first: most documents hold neither a run of 16 key characters nor a secret name
    parts = F.when(t.rlike(f"[A-Za-z0-9+/_.-]{{16}}|(?i:{FOR_WORDS})"), F.split(F.regexp_replace(clean, CANDIDATE, f"$1{MARK}$2{TAG}$3{MARK}"), MARK))
    df = df.select(*cols, parts.alias("__parts"))
    # in front of the tag stands what a secret name is assigned, behind it any other candidate
    df = df.select("*", F.when(F.size("__parts") > 1, F.transform("__parts", lambda p: F.translate(p, TAG, ""))).alias("__p"))
    around = lambda s, step: F.get(F.col("__p"), s["i"] + step)
    named = lambda s: ~F.startswith(F.get(F.col("__parts"), s["i"]), F.lit(TAG))
    seen = F.transform(
        F.filter(F.transform("__p", lambda p, i: F.struct(i.alias("i"), p.alias("c"))), lambda s: s["i"] % 2 == 1),
        lambda s: F.struct(
            s["i"].alias("i"), is_prose(s["c"], around(s, -1)).alias("prose"),
            *[v.cast("double").alias(k) for k, v in features(s["c"], around(s, -1), around(s, 1), named(s)).items()],
        ),
    )
    df = df.select("*", seen.alias("__seen"))
    score = lambda s: F.when(s["prose"], 0.0).otherwise(forest.score([s[k] for k in FEATURES]))
    scored = F.transform("__seen", lambda s: F.struct(s["i"].alias("i"), score(s).alias("score")))
    df = df.select("*", scored.alias("__scored"))
    # candidates are every second part; one pass gives the end of each part
    ends = F.aggregate("__p", F.array(F.lit(0)), lambda a, p: F.concat(a, F.array(F.element_at(a, -1) + F.length(p))))
    hot = F.exists("__scored", lambda s: s["score"] >= threshold)
    df = df.select("*", F.when(hot, F.filter("__scored", lambda s: s["score"] >= threshold)).alias("__secrets"), F.when(hot, ends).alias("__ends"))
    spans = F.transform("__secrets", lambda s: F.struct(F.get(F.col("__ends"), s["i"]).alias("start"), F.get(F.col("__ends"), s["i"] + 1).alias("end"), s["score"].alias("score")))
    is_secret = lambda i: (i % 2 == 1) & (F.get(F.col("__scored"), F.floor(i / 2).cast("int"))["score"] >= threshold)
    redacted = F.array_join(F.transform("__p", lambda p, i: F.when(is_secret(i), F.lit("[SECRET]")).otherwise(p)), "")
    none = F.array().cast("array<struct<start:int,end:int,score:double>>")
    out = df.select(
        *cols,
        F.when(F.col("__seen").isNull(), 0).otherwise(F.size("__seen")).cast("long").alias("n_candidates"),
        F.when(F.col("__secrets").isNull(), 0).otherwise(F.size("__secrets")).cast("long").alias("n_secrets"),
        F.coalesce(spans, none).alias("secret_spans"),
        F.when(F.size("__secrets") > 0, redacted).otherwise(t).alias("redacted"),
    )
    return put_back(out, names)


def op2_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = secret_scan(docs)
    spans = F.array_join(F.transform("secret_spans", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    best = F.round(F.coalesce(F.array_max(F.transform("secret_spans", lambda s: s["score"])), F.lit(0.0)), 6)
    return out.select("doc_id", "n_candidates", "n_secrets", spans.alias("spans"), best.alias("max_score"), F.sha2(F.coalesce("redacted", F.lit("")), 256).alias("redacted_sha256"))
