"""Spelling variants, the Merkle manifest and license scans against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.test_operators import SF, empty, frame, hard, hard_rows, same, table  # noqa: F401

import __spark_entry__ as entry
from tvtrail.llm import licenses, manifest, queries, spelling
from workbench import compare

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", ["op12_manifest", "op13_licenses"])
def test_sql(spark, name, monkeypatch):
    monkeypatch.setattr(compare.catalog, "QUERIES", entry.queries())
    monkeypatch.setattr(compare.catalog, "ORACLES", entry.oracle_sql())
    ok, note = compare.compare(spark, compare.connect(SF), SF, name)
    assert ok, note


# Spelling


def near(a, b):
    """By making every change, not by comparing."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(a[:k] + a[k + 1:] == b for k in range(len(a)))


def plain_words(rows):
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain_variants(rows):
    counts = plain_words(rows)
    # Words one edit apart are equal after leaving out one letter, or one and none.
    holes = defaultdict(set)
    for w in counts:
        for k in range(len(w)):
            holes[w[:k] + w[k + 1:]].add(w)
        holes[w].add(w)
    beside = defaultdict(set)
    for group in holes.values():
        for a in group:
            beside[a].update(b for b in group if a != b and near(a, b))
    form = {}
    for w, others in beside.items():
        if others:
            best = min(others, key=lambda o: (-counts[o], o))
            if counts[best] >= 10 * counts[w]:
                form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return [(w, form.get(w), root(w), n, len(beside[w]), counts.get(form.get(w))) for w, n in counts.items()]


VARIANT = ("word", "form", "root", "n", "n_near", "form_n")


def test_op11(spark, table):  # noqa: F811
    got = queries.op11_spelling(spark, SF).select(*VARIANT)
    same([tuple(r) for r in got.collect()], plain_variants([r[:2] for r in table]))
    assert got.where("form IS NOT NULL").count() > 0


def family(seed, size):
    """A word with its slips, rare slips of slips, anagrams and words in capitals and accents."""
    rng = random.Random(seed)
    base = "".join(rng.choice("aeinrst") for _ in range(10))
    found = {base: 3000}
    for _ in range(size):
        w = rng.choice(list(found))
        k = rng.randrange(len(w) + 1)
        letter = rng.choice("aeinrstÉéß÷z")
        w = rng.choice((w[:k] + letter + w[k:], w[:k] + letter + w[k + 1:], w[:k] + w[k + 1:], "".join(rng.sample(w, len(w)))))
        found.setdefault(w, rng.choice((2, 2, 3, 20, 29, 30, 31, 250, 300)))
    return found


def test_op11_hard(spark, hard, empty, monkeypatch):  # noqa: F811
    extra = [(1000 + k, " ".join([w.upper() if k % 2 else w] * n), "en", "s", None)
             for k, (w, n) in enumerate(sorted((family(1, 300) | family(2, 200)).items()))]
    rows = hard_rows() + extra + extra[:40]
    want = plain_variants([r[:2] for r in rows])
    docs = frame(spark, rows)
    same([tuple(r) for r in spelling.variants(docs).select(*VARIANT).collect()], want)
    # Chains of forms: a root that is not the form.
    assert any(form and root != form for _, form, root, *_ in want)
    # Every block crowded: the same pairs from tiles.
    monkeypatch.setattr(spelling, "TILE", 3)
    same([tuple(r) for r in spelling.variants(docs).select(*VARIANT).collect()], want)
    monkeypatch.setattr(spelling, "_HELD_WORDS", 2)
    monkeypatch.setattr(spelling, "_BATCH", 50)
    monkeypatch.setattr(spelling, "_ROWS", 2)
    same([tuple(r) for r in spelling.variants(docs).select(*VARIANT).collect()], want)
    same([tuple(r) for r in spelling.count_words(docs).collect()], list(plain_words([r[:2] for r in rows]).items()))
    assert spelling.variants(empty).count() == 0


def test_op11_blocks_lose_no_pair():
    words = [*family(3, 400), "ab" * 40, "ab" * 40 + "c", "ab" * 39 + "cb"]
    want = {frozenset((a, b)) for i, a in enumerate(words) for b in words[:i] if near(a, b)}
    classes = {x: k % spelling.CLASSES for k, x in enumerate(sorted(set("".join(words))))}
    blocks = defaultdict(list)
    for w in words:
        for part, pair in enumerate(spelling.PARTS):
            kept = "".join(sorted(x for x in w if classes[x] in pair))
            for longer in (False, True):
                blocks[part, len(w) - longer, kept].append((longer, w))
    rows, ends = [], []
    for (part, *_), members in blocks.items():
        rows += [(*m, part) for m in sorted(members)]
        ends.append(len(rows))
    longer, inside, part = zip(*rows)
    pairs = spelling.near_pairs(list(inside), ends, np.array(longer), np.full(len(rows), -1), np.array(part), classes)
    found = [frozenset((inside[a], inside[b])) for a, b in zip(*pairs)]
    assert len(found) == len(set(found)) and set(found) == want
    counts, _ = spelling.letter_counts(["aab" * 5000, "aab"])
    assert counts.tolist() == [[10_000, 5000], [2, 1]] and counts.dtype == np.float64


# Manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def told(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(hashes):
    found = [list(hashes)]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([sha(*last[k:k + 2]) for k in range(0, len(last), 2)])
    return found


def way(tree, at):
    steps = []
    for level in tree[:-1]:
        run = level[at - at % 2:at - at % 2 + 2]
        steps.append(("", run[1] if len(run) > 1 else "") if at % 2 == 0 else (run[0], ""))
        at //= 2
    return steps


def plain_manifest(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    def leaf(r, n_chars):
        return sha(*map(told, (r[0], r[3], r[2], n_chars, r[1])))

    def first(value):
        return (value is not None, value if value is not None else 0)

    groups = defaultdict(list)
    for r in rows:
        changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
        groups[r[2]].append((first(r[0]), leaf(r, r[4]), leaf(r, r[4] + 1) if changed else leaf(r, r[4]), r[0]))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for lang in order:
        groups[lang].sort(key=lambda g: g[:2])
        trees.append(levels([g[1] for g in groups[lang]]))
    top = levels([t[-1][0] for t in trees])
    out = []
    for n, (lang, tree) in enumerate(zip(order, trees)):
        for at, (_, original, found, doc) in enumerate(groups[lang]):
            steps = way(tree, at) + way(top, n)
            folded = found
            for before, after in steps:
                folded = sha(before, folded, after)
            proof = sha(*[x for pair in steps for x in pair])
            out.append((doc, original, tree[-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


PROOF = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def proofs(docs):
    changed = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    later = {"n_chars": F.when(changed, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    out = manifest.prove(docs, changed=later).select("doc_id", "manifest.*")
    return [tuple(r) for r in out.select(*PROOF).collect()]


def numbered(n, langs):
    rng = random.Random(n)
    return [(k, f"text {k}" if k % 9 else None, langs[k % len(langs)], rng.choice(("s", None)), k if k % 5 else None) for k in range(n)]


@pytest.mark.parametrize("height", [1, 2, 10])
def test_op12_hard(spark, hard, empty, height, monkeypatch):  # noqa: F811
    monkeypatch.setattr(manifest, "HEIGHT", height)
    rows = hard_rows() + [r for r in hard_rows() if r[0] is not None][:7] + numbered(150, ("en", "en", "en", "en", "é", None, "z", "", "a", "b", "c"))
    same(proofs(frame(spark, rows)), plain_manifest(rows))
    assert proofs(empty) == []


@pytest.mark.parametrize("rows", [1, 2, 3, 8, 9])
def test_op12_small_trees(spark, rows, monkeypatch):
    monkeypatch.setattr(manifest, "HEIGHT", 2)
    for langs in (("en",), ("en", "de"), ("en", None, "fr", "de", "x")):
        got = numbered(rows, langs)
        same(proofs(frame(spark, got)), plain_manifest(got))


def test_op12_limit_is_restored(spark):
    before = spark.conf.get(manifest._ROW_LIMIT, None)
    proofs(frame(spark, numbered(5, ("en",))))
    assert spark.conf.get(manifest._ROW_LIMIT, None) == before


def test_op12_no_node_row_meets_many_leaves(spark, monkeypatch):
    monkeypatch.setattr(manifest, "HEIGHT", 2)
    made = manifest.build(frame(spark, numbered(200, ("en", "en", "en", "de"))))
    assert made.nodes.groupBy("node", "level").count().where("count > 1").isEmpty()
    met = made.leaves.groupBy("parent", "parent_level").count().agg(F.max("count")).first()[0]
    assert met == 1 << manifest.HEIGHT and made.nodes.count() > 0


# Licenses


def fold_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_scan(text, templates=licenses.TEMPLATES):
    """(n_words, [(start, end, label, score, exact)])."""
    doc, spans = fold_words(text), []
    for t in templates:
        want = fold_words(t.text)
        votes = defaultdict(set)
        for at in range(len(doc) - 2):
            for place in range(len(want) - 2):
                if doc[at:at + 3] == want[place:place + 3]:
                    votes[at - place].add(place)
        near_by, group, last = 0 if t.exact else min(4, len(want) // 10 * 2), [], None
        for d in [*sorted(votes), None]:
            if group and (d is None or d - last > near_by):
                places = {p + k for g in group for p in votes[g] for k in range(3)}
                start, end = min(g + min(votes[g]) for g in group), max(g + max(votes[g]) + 3 for g in group)
                lost = set(range(len(want))) - places
                few = len(lost) <= (0 if t.exact else len(want) // 10 * 2)
                if few and not any(re.search("[0-9]", want[p]) for p in lost) and end - start <= 2 * len(want):
                    spans.append((start, end, t.label, len(places) / len(want), t.exact))
                group = []
            if d is not None:
                group.append(d)
                last = d
    return len(doc), sorted(spans)


def license_rows():
    mit = next(t.text for t in licenses.TEMPLATES if t.text.startswith("Permission is hereby"))
    changed = mit.replace("charge, to any", "charge, freely and gladly, to any").replace("use, copy, modify", "use copy and modify")
    half = " ".join(mit.split()[:len(mit.split()) // 2])
    texts = [
        None, "", "cc", "CC BY-NC 4.0", "cc by nc cc by nc, CC-BY-NC", "Released under the MIT License.", "under the MIT under the mit license",
        "Licensed under the Apache License, Version 2.0. " * 30, mit, changed, half, mit.replace("\n", " ").upper(), f"é {mit} — ſ {changed} K",
        "under the Kit license under the mit licensé", "İ under the MİT license", "the gnu general public license, version 3 or version 2",
        "of the software without restriction " * 2000, mit + " " + mit, ("x " * 5000) + changed + (" y" * 5000), "apache license version 2",
        "under_the_mit_license", "published by the free software foundation", "This is free and unencumbered software released into the public domain",
        "Creative Commons Attribution 4.0 International", "creative commons Attribution-ShareAlike 4.0 International",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ]
    return [(k, t, "en", None, None) for k, t in enumerate(texts)]


def test_op13_hard(spark, hard, empty):  # noqa: F811
    rows = license_rows() + license_rows()[3:8] + hard_rows() + [(None, "under the MIT license", None, None, 1)] * 2
    docs = frame(spark, rows)
    out = licenses.scan(docs)
    assert set(out.columns) == (set(docs.columns) - {"text"}) | {"licenses"}
    got = [(r["doc_id"], r["n_chars"], r["licenses"]["n_words"], tuple(tuple(s) for s in r["licenses"]["spans"])) for r in out.collect()]
    same(got, [(r[0], r[4], (found := plain_scan(r[1]))[0], tuple(found[1])) for r in rows])
    assert licenses.scan(empty).count() == 0


def test_op13_finds_what_it_is_for(spark):
    docs = frame(spark, license_rows())
    labels = {r["doc_id"]: [s["label"] for s in r["licenses"]["spans"]] for r in licenses.scan(docs).collect()}
    assert labels[8] == labels[9] == labels[11] == labels[18] == ["mit"] and labels[12] == ["mit", "mit"]
    assert labels[10] == labels[16] == labels[14] == [] and labels[15] == labels[25] == ["gpl-3"] and labels[23] == ["cc-by"] and labels[24] == ["cc-by-sa"] and labels[4] == ["cc-by-nc"] * 3


def test_op13_other_templates(spark):
    docs = frame(spark, [(1, "one two three four five", None, None, None), (2, "nothing", None, None, None)])
    mine = (licenses.Template("a", "Two Three"), licenses.Template("b", "two three four", exact=True), licenses.Template("c", ""))
    got = {r["doc_id"]: [tuple(s) for s in r["licenses"]["spans"]] for r in licenses.scan(docs, mine).collect()}
    assert got == {1: [(1, 4, "b", 1.0, True)], 2: []}


def test_op13_plan_is_built_in(spark):
    plan = queries.op13_licenses(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|ExistingRDD|CartesianProduct|NestedLoop", plan)
    assert plan.count("Exchange hashpartitioning") == 1
