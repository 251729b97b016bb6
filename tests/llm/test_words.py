"""Quality rules, licences, secrets and toxicity: base columns by brute force, and odd rows."""

import re

import pytest

from folioloom.llm import licenses, quality, secret_scan, toxicity

ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "word"), (5, "a b c a b c"), (5, "a b c a b c"), (None, "x y"), (6, "a a a a"),
    (7, "l1\nl1\n\nl1 \nl2"), (8, "CC BY cc by General Public License all rights reserved"), (9, "É cc  by x cc-by"),
    (10, "word " * 60_000), (11, "Released under the MIT License."), (12, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" end'),
    (13, "commit 24be64439e3e49cf46b2d7c90f3602a3d0b907ff see 4785380592391139"), (14, "bad ￿ token=ghp_abcdEFGH1234ijklMNOP5678qrst"),
]
CLASH = "doc_id bigint, text string, n_words string, score string, labels string, kept string, redacted string, __w string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, *["old"] * 6) for i, t in ODD], CLASH).drop("__w")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base_counts(text):
    w = words(text)
    seen: dict = {}
    for k in range(len(w) - 2):
        seen.setdefault(tuple(w[k : k + 3]), []).append(k)
    hit = {k + d for ks in seen.values() if len(ks) > 1 for k in ks for d in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_quality_counts(docs):
    got = quality.quality_rules(docs).collect()
    assert len(got) == len(ODD)
    by = {(r["doc_id"], r["text"]): r for r in got}
    for i, t in ODD:
        r = by[i, t]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == base_counts(t)
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_quality_order_is_cost_only(spark):
    rows = [(k, "# " * 60 if k % 2 else " ".join(f"w{k}{j}" for j in range(60))) for k in range(40)]
    df = quality.with_counts(spark.createDataFrame(rows, "doc_id bigint, text string"))
    kept = [{r["doc_id"] for r in quality.cascade(df, rules).where("rejected_by IS NULL").collect()} for rules in (quality.RULES, quality.RULES[::-1])]
    assert kept[0] == kept[1] == {k for k in range(40) if k % 2 == 0}
    assert set(quality.order_rules(df.select("doc_id", "text"), fraction=1.0)) == set(quality.RULES)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert quality.quality_rules(none).count() == licenses.license_scan(none).count() == 0
    assert toxicity.score(none, toxicity.Field()).count() == 0
    assert toxicity.fit_from(none, spark.createDataFrame([], "doc_id bigint, toxic int")).weights == {}


def test_license_base(docs):
    by = {(r["doc_id"], r["text"]): r for r in licenses.license_scan(docs).collect()}
    for i, t in ODD:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        places, found = [], set()
        for phrase, label in licenses.BASE_PHRASES.items():
            p = phrase.split()
            at = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            places += at
            found |= {label} if at else set()
        r = by[i, t]
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(w), len(places), ",".join(sorted(found)))
        assert (r["first_word"], r["last_word"]) == ((min(places), max(places)) if places else (None, None))
        assert 0 <= r["score"] <= 1 and found <= set(r["labels"].split(","))


def test_license_templates(spark):
    texts = {t.text: t.label for t in licenses.TEMPLATES}
    rows = spark.createDataFrame([(f"Some prose before. {t.capitalize()}. After it.",) for t in texts] + [("mit license apache version",)], "text string")
    got = [r["labels"] for r in licenses.license_scan(rows).collect()]
    assert all(label in g.split(",") for label, g in zip(texts.values(), got, strict=False))
    assert got[-1] == ""


def test_secrets(docs):
    by = {(r["doc_id"], r["text"]): r for r in secret_scan.secret_scan(docs).collect()}
    assert len(by) == len(set(ODD))
    hit = by[ODD[13]]
    assert hit["n_secrets"] == 1 and hit["redacted"] == 'token = "[SECRET]" end'
    s = hit["secret_spans"][0]
    assert ODD[13][1][s["start"] : s["end"]] == "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    miss = by[ODD[14]]
    assert miss["n_candidates"] == 2 and miss["n_secrets"] == 0 and miss["redacted"] == ODD[14][1]
    assert by[ODD[15]]["n_secrets"] == 1
    assert all(by[r]["redacted"] == r[1] for r in ODD[:13])


def test_forest_on_held_out_findings(spark):
    rows = secret_scan.labelled_findings(spark, 2000)
    forest = secret_scan.fit_forest(rows.limit(1000))
    from pyspark.sql import functions as F

    test = rows.exceptAll(rows.limit(1000)).withColumn("f", F.struct(*[v.cast("double").alias(k) for k, v in secret_scan.features(F.col("candidate"), F.col("before"), F.col("after")).items()]))
    scored = test.select("label", forest.score([F.col("f")[k] for k in secret_scan.FEATURES]).alias("s"))
    right = scored.where((F.col("s") >= 0.5) == (F.col("label") == 1)).count()
    assert right >= 0.95 * scored.count()


def brute_marginals(e, trans):
    import itertools
    import math

    n, total, one = len(e), 0.0, [0.0] * len(e)
    for path in itertools.product((0, 1), repeat=n):
        w = math.exp(sum(e[k] * s for k, s in enumerate(path)) + sum(trans[a][b] for a, b in zip(path, path[1:])))
        total += w
        for k, s in enumerate(path):
            one[k] += w * s
    return [x / total for x in one]


def test_marginals():
    import numpy as np

    e, trans = np.array([0.3, -1.0, 2.0, 0.5, -0.2, 1.0]), np.array([[0.4, -0.3], [-0.2, 0.9]])
    got = toxicity.marginals(e, np.array([0, 4]), np.array([4, 2]), trans)
    assert np.allclose(got, brute_marginals(e[:4], trans) + brute_marginals(e[4:], trans))


def test_toxicity_learns_and_shows_offsets(spark):
    import random

    rng = random.Random(1)
    vocab = [f"w{k}" for k in range(300)]
    texts, labels = [], []
    for k in range(300):
        w = rng.choices(vocab, k=60)
        if k % 3 == 0:
            for at in rng.sample(range(60), 4):
                w[at] = "scoundrel"
        texts.append(" ".join(w))
        labels.append(int(k % 3 == 0))
    model = toxicity.fit(texts[:200], labels[:200])
    rows = [(k, t) for k, t in enumerate(texts[200:])] + [(None, None), (900, ""), (901, "you Scoundrel, you!")]
    got = toxicity.score(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert [r["predicted"] for r in got[:100]] == labels[200:]
    assert got[100]["predicted"] == got[101]["predicted"] == 0
    hot = next(r for r in got[:100] if r["predicted"])
    assert {hot["text"][s["start"] : s["end"]] for s in hot["toxic_spans"]} == {"scoundrel"}
