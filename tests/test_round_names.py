"""Names of whole closures at once against a walk round by round, where names given in one round are others' own."""

import random
import re

from folioloom.operators import merges as M

STEMS = ["a", "a_src1", "a_src2", "a_src1_src1", "a_src01", "b._src5", "b_src1", "c"]
NAMES = [s + x for s in STEMS for x in ("", ".xml")]


def _cut(name):
    return re.fullmatch(r"(.*?)(\.[^./]*)?", name, re.S).groups("")


def _numbers(names, stem, end):
    found = [re.fullmatch(r"(.*)_src(\d+)", s, re.S) for s, x in map(_cut, names) if x == end]
    return {int(m[2]) for m in found if m and m[1] == stem}


def _walk(parts, leads, roots, there):
    had, names, layer, k = dict(there), {}, [r for r in roots if r in parts], 0
    while layer:
        k += 1
        clash = sorted(p for p in layer if p in had and had[p] != parts[p])
        kept = [p for p in layer if p not in clash]
        held, base = set(had), set(had) | set(kept)
        for p in kept:
            names[p] = (p, p not in held, k)
            had[p] = parts[p]
        for p in clash:
            stem, end = _cut(p)
            taken = _numbers(base, stem, end)
            n = next(i for i in range(1, 99) if i not in taken)
            names[p] = (f"{stem}_src{n}{end}", True, k)
        had |= {names[p][0]: parts[p] for p in clash}
        layer = sorted({t for p in layer for t in leads.get(p, ()) if t in parts} - set(names))
    return names


def test_names_as_round_by_round(spark, monkeypatch):
    rng, want, tables, kinds = random.Random(7), [], ([], [], [], []), []
    for d in range(120):
        parts = {p: rng.choice("xyz") for p in rng.sample(NAMES, rng.randint(3, len(NAMES)))}
        leads = {p: rng.sample(NAMES, 2) for p in parts}
        roots = rng.sample(NAMES, 2)
        there = {p: rng.choice("xyz") for p in rng.sample([*NAMES, "a_src3.xml", "c_src2", "b_src1._src5"], rng.randint(0, 6))}
        want += [(f"d{d}", p, *x) for p, x in _walk(parts, leads, roots, there).items()]
        for rows, new in zip(tables, (parts.items(), [(p, f"r{i}", t, None) for p, ts in leads.items() for i, t in enumerate(ts)], [(r,) for r in roots], there.items()), strict=True):
            rows += [(f"d{d}", *x) for x in new]
    types = ("doc string, part string, digest string", "doc string, owner string, id string, part string, mode string", "doc string, part string", "doc string, part string, digest string")
    plain = M.written
    monkeypatch.setattr(M, "written", lambda df, name: kinds.append(name) or plain(df, name))
    names, _, _ = M.part_closure(*[spark.createDataFrame(r, t) for r, t in zip(tables, types, strict=True)])
    assert sorted(tuple(r) for r in names.select("doc", "part", "new_part", "copied", "round").collect()) == sorted(want)
    assert max(w[4] for w in want) > 3 and sum(w[1] != w[2] and "_src" in w[1] for w in want) > 40 and "struck" in kinds
    assert kinds.count("met") == kinds.count("moving") == 1  # named once, not in every round
