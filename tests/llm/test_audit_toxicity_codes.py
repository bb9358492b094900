"""Filter audit, toxicity and vector codes against brute force, with nulls, copies, odd values and empty tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gondola.llm import filter_audit, toxicity, vector_codes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASH = ("text", "h", "n", "bits", "part", "own", "salt", "least", "good", "v", "code", "error", "label_error", "of", "score", "half", "words", "term")


def clashing(df):
    return df.withColumns({c: F.lit("taken") for c in CLASH if c not in df.columns})


# --- filter audit


def audit_rows() -> tuple[list, list]:
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdeXY") for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(120):
        n = rng.choice((0, 3, 99, 100, 101, 250))
        text = " ".join(word() if rng.random() < 0.5 else word() + str(k) for k in range(n)) + rng.choice(("", " #", "\x0b&\n", " |"))
        rows.append((i, text, rng.choice(("en", "es", None, ""))))
    rows += [(200 + i, rows[4][1], "en") for i in range(30)] + [(300, None, "en"), (301, "", None), (302, "ÄÖ É\x85x", "es")]
    rows += [(None, rows[4][1], "en"), (None, "alone", "es"), rows[7], rows[7], (7, "another text", "en"), (2, rows[7][1], "de")]
    rows += [(400, "w " * 100_000 + "Z#", "en"), (401, "x" * 200_000, "es"), (402, "A" * 10 + "b" * 90, "de"), (403, "A" * 11 + "b" * 89, "de")]
    labels = [(i, rng.choice((0, 1, None)), rng.choice((0, 1, None))) for i in range(0, 230, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (9999, 1, 1)]
    return rows, labels


def audit_brute(rows, labels) -> set:
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    parts = defaultdict(list)
    good, toxic = ({i for i, *x in labels if i is not None and x[k] == 1} for k in (0, 1))
    for i, t, lang in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and least[t] < i,
        }
        parts[lang or ""].append((frozenset(x for x in fails if fails[x]), i in good, i in toxic))
    out = set()
    for part, docs in parts.items():
        table = {}
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[0]]
                left = [d for d in left if x not in d[0]]
                table[order, step] = (
                    len(left), len(gone), sum(x in d[0] for d in docs) - len(gone), sum(d[0] == {x} for d in docs),
                    sum(d[1] for d in gone), sum(d[2] for d in gone),
                )
        shapley = Counter()
        for (order, step), found in table.items():
            shapley[order[step - 1]] += found[1]
        out |= {(part, order, step, *found, shapley[order[step - 1]]) for (order, step), found in table.items()}
    return out


@pytest.fixture(scope="module")
def audited(spark):
    rows, labels = audit_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    return clashing(docs), clashing(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


@pytest.mark.parametrize("share", [filter_audit.SHARE, 4])
def test_filter_audit(audited, monkeypatch, share):
    monkeypatch.setattr(filter_audit, "SHARE", share)  # 4: copies are dealt to salts
    found = filter_audit.audit(*audited)
    assert found.columns[:3] == ["part", "filter_order", "step"]
    rows = [tuple(r) for r in found.collect()]
    expected = audit_brute(*audit_rows())
    assert len(rows) == len(expected) and set(rows) == expected


def test_filter_audit_compares_texts_not_hashes(spark):
    rows = [(1, "a", 5), (2, "b", 5), (3, "a", 5), (4, "b", 5), (5, "c", 5), (None, "a", 5), (6, "d", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h long")
    hashes = spark.createDataFrame([(5, 6)], "h long, n long")
    assert {r.doc_id for r in filter_audit.later_copies(docs, hashes).collect()} == {3, 4}


def test_filter_audit_without_joins_of_large_sides(spark, audited, monkeypatch):
    monkeypatch.setattr(filter_audit, "SMALL", -1)
    assert {tuple(r) for r in filter_audit.audit(*audited).collect()} == audit_brute(*audit_rows())
    assert filter_audit.audit(audited[0].limit(0), audited[1]).count() == 0
    no_labels = filter_audit.audit(audited[0], audited[1].limit(0)).agg(F.sum(F.col("good_lost") + F.col("toxic_lost"))).first()[0]
    assert no_labels == 0


# --- toxicity


@pytest.mark.parametrize(
    "text, words",
    [
        ("Idiot", ["idiot"]), ("1d10t!", ["idiot"]), ("ІDІΟТ", ["idiot"]), ("ｉｄｉｏｔ", ["idiot"]), ("i​d­iot", ["idiot"]),
        ("$tup1d", ["stupid"]), ("l0ser", ["ioser"]), ("in 2024, 3 of 10", ["in", "of"]), ("naïve—no", ["naive", "no"]), ("", []),
        ("!!! 123 $5", []), ("scum### a_b", ["scum", "a", "b"]), ("no! yes!", ["no", "yes"]), ("p@th3tic.", ["pathetic"]),
    ],
)
def test_folding(text, words):
    assert toxicity.folded(text) == words


def test_leftmost_longest_matches_and_exception_phrases():
    lexicon = toxicity.Lexicon({"<dumb>": 3.0, "<bad": 2.0, "<badger>": 0.5, "<dumb><beii>": 0.0})
    brute = lambda words: [t for t in _brute_matches(lexicon, words)]
    for text in ("dumb", "dumbest", "a dumb bell and a dumb dog", "bad badly badger not abad", "", "dumb dumb bell bell"):
        words = toxicity.folded(text)
        assert [t for _, t in lexicon.matches(words)] == brute(words)
    assert lexicon.rate(toxicity.folded("dumb bell")) == 0
    assert lexicon.rate(["dumb"] * 5) == pytest.approx(15 / (5 + toxicity.PAD))
    assert lexicon.rate(["x"] * 100 + ["dumb"]) < lexicon.rate(["x"] * 10 + ["dumb"])


def _brute_matches(lexicon, words):
    text, at = toxicity.marked(words), 0
    while at < len(text):
        fits = [t for t in lexicon.weights if text.startswith(t, at)]
        if fits:
            yield max(fits, key=len)
        at += len(max(fits, key=len)) if fits else 1


def toxic_corpus() -> tuple[list, list]:
    rng = random.Random(4)
    plain = ["".join(rng.choice("abcdeghmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    bad = ["grubnik", "vormlok", "zzurp", "kefflick"]
    rows, labels = [], []
    for i in range(500):
        words = [rng.choice(plain) for _ in range(rng.choice((5, 40, 200)))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(1 + len(words) // 20):
                words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(("", "s", "er")))
        elif i % 24 == 3:
            words[2:2] = ["zzurp", "island"]  # harmless in this phrase
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_learns_terms_and_exceptions(spark):
    rows, labels = toxic_corpus()
    extra = [(1000, None), (1001, ""), (1002, "!! 12"), (1003, "Vоrml0k " + "gub " * 30), (1004, "a visit to zzurp island " * 3), (1005, "ab " * 300_000), rows[0], rows[0]]
    docs = clashing(spark.createDataFrame(rows + extra, "doc_id long, text string").withColumnRenamed("text", "t").withColumnRenamed("t", "text"))
    known = clashing(spark.createDataFrame([*labels, (None, 1), (3, None), (9999, 1), (1, 0)], "doc_id long, toxic int"))
    model = toxicity.fit(docs, known, F.col("doc_id") % 4 != 1)
    weights = model.lexicon.weights
    assert all(any(x.startswith(f"<{b}") for x in weights if weights[x] > 1.5) for b in ("grub", "vorm", "zzur", "keff"))
    assert any("<zzurp><isiand>" == x and not w for x, w in weights.items())
    got = defaultdict(list)
    for r in toxicity.score(docs, model).collect():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        got[r.doc_id].append(r.predicted)
    assert len(got[0]) == 3
    held = [(got[i][0], y) for i, y in labels if i % 4 == 1]
    assert sum(p == y for p, y in held) >= 0.97 * len(held)
    assert [got[i][0] for i in range(1000, 1006)] == [0, 0, 0, 1, 0, 0]
    texts = dict(rows)
    one = {r.doc_id: r.score for r in toxicity.score(docs.where("doc_id < 20"), model).collect()}
    assert all(one[i] == pytest.approx(model.score(texts[i].encode())) for i in one)


def test_toxicity_without_both_classes(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    for labels in ([], [(1, 0)], [(1, None), (2, 1)], [(7, 0), (8, 1)]):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
        assert model is None
    assert [tuple(r)[1:] for r in toxicity.score(docs, None).collect()] == [(0.0, 0)] * 2
    assert toxicity.score(docs.limit(0), None).count() == 0


def test_given_exceptions_never_count(spark):
    rows, labels = toxic_corpus()
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, known, F.lit(True), exceptions=("Grubnik Day", ""))
    assert model.lexicon.rate(toxicity.folded("grubnik day")) == 0 < model.lexicon.rate(toxicity.folded("grubnik week"))


# --- vector codes


def codes_brute(rows, parts, entries, rounds, scale):
    """Codes, errors, label errors and codebooks by plain Python integers."""
    kept = [(i, [int(np.floor(scale * float(x))) for x in v], y) for i, v, y in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = next((len(v) for _, v, _ in kept if v and len(v) % parts == 0), 0)
    cut = lambda v: [v[p * width // parts : (p + 1) * width // parts] for p in range(parts)]
    used = [(i, cut(v), y) for i, v, y in kept if width and len(v) == width]
    books = [[list(r[1][p]) for r in used[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda p, x: min((far(x, e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for _, v, _ in used:
                members[near(p, v[p])[1]].append(v[p])
            for k, xs in members.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    out, label = [], defaultdict(int)
    for i, v, y in used:
        found = [near(p, v[p]) for p in range(parts)]
        out.append((i, y, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
        label[y] += out[-1][3]
    rest = [(i, None, None, label[y] if y in label else None) for i, v, y in kept if not width or len(v) != width]
    return [(i, c, e, label[y]) for i, y, c, e in out] + rest, books


def vector_rows(dim: int = 8) -> list:
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(5, dim))
    rows = []
    for i in range(400):
        v = (centres[rng.integers(5)] + rng.normal(size=dim) * rng.choice((0.01, 0.3))).astype(np.float32).tolist()
        rows.append((i * 3 + 1, v, int(rng.integers(4)) if i % 7 else None))
    rows += [(2000 + i, rows[20][1], 1) for i in range(150)]  # a large group of copies
    rows += [rows[9], rows[9], (None, rows[3][1], 2), (0, None, 1), (2, [], 1), (5, [1.0] * 3, 9), (6, [None] + [0.0] * (dim - 1), 1)]
    rows += [(8, [float("nan")] * dim, 1), (9, [float("inf")] + [0.0] * (dim - 1), 1), (3000, [0.0] * dim, None), (3001, [0.5] * (2 * dim), 3)]
    return rows


VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("block", [vector_codes.BLOCK_VALUES, 512])
def test_vector_codes(spark, monkeypatch, block):
    monkeypatch.setattr(vector_codes, "BLOCK_VALUES", block)
    rows = vector_rows()
    df = clashing(spark.createDataFrame(rows, VECTORS).repartition(3))
    coded, books = vector_codes.encode(df, parts=2)
    got = [tuple(r) for r in vector_codes.with_label_error(coded).select("vec_id", "code", "error", "label_error").collect()]
    expected, expected_books = codes_brute(rows, 2, 16, 6, 4096)
    assert books.tolist() == expected_books
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)
    assert sorted(got, key=key) == sorted(expected, key=key)
    text = ",".join(str(x) for book in expected_books for e in book for x in e)
    assert vector_codes.codebooks_digest(books) == hashlib.sha256(text.encode()).hexdigest()


def test_vector_codes_of_few_empty_and_very_large_vectors(spark):
    big = [(i, [1e9 * (i % 3) + i * 1000.0] * 2, None) for i in range(1, 20)]
    for rows in ([(5, [0.25] * 8, 1)], [(5, [0.25] * 8, 1), (6, [0.5] * 8, None)], big):
        parts = 2 if rows is big else 8
        coded, books = vector_codes.encode(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), parts=parts, rounds=2)
        got = {tuple(r) for r in vector_codes.with_label_error(coded).select("vec_id", "code", "error", "label_error").collect()}
        expected, expected_books = codes_brute(rows, parts, 16, 2, 4096)
        assert books.tolist() == expected_books and got == set(expected)
    huge = spark.createDataFrame([(1, [3e38] * 8, 1), (2, [-3e38] * 8, 1)], "vec_id long, embedding array<double>, label int")
    coded, _ = vector_codes.encode(huge, entries=1, rounds=1)
    assert [tuple(r)[1:] for r in vector_codes.with_label_error(coded).select("vec_id", "error", "label_error").collect()] == [(2**63 - 1,) * 2] * 2
    nothing = spark.createDataFrame([], VECTORS)
    coded, books = vector_codes.encode(nothing)
    assert vector_codes.with_label_error(coded).count() == 0 and books.shape == (8, 0, 0)
    odd = spark.createDataFrame([(1, [], 1), (2, [1.0], None)], VECTORS)
    assert {tuple(r) for r in vector_codes.encode(odd)[0].select("vec_id", "code", "error").collect()} == {(1, None, None), (2, None, None)}


def test_cover_trees_cover_and_settle_subtrees():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (16, 8))
    points = np.concatenate([c + rng.integers(-40, 41, (200, 8)) for c in centres] + [np.repeat(centres[:1], 300, axis=0)])
    tree = vector_codes.CoverTree(points)
    assert sorted(tree.order.tolist()) == list(range(len(points)))
    assert (tree.points == points[tree.order]).all()
    for i in range(len(tree.start)):
        inside = tree.points[tree.start[i] : tree.end[i]]
        d = np.sqrt(((inside - tree.centres[i]) ** 2).sum(axis=1).astype(float))
        assert d.max() <= tree.radius[i]
        kids = range(tree.child[i], tree.child[i] + tree.children[i])
        assert all(tree.start[i] <= tree.start[k] <= tree.end[k] <= tree.end[i] for k in kids)
        for a in kids:
            for b in kids:
                gap = np.sqrt(((tree.centres[a] - tree.centres[b]) ** 2).sum())
                assert a == b or gap > tree.radius[i] / 2 * (1 - 1e-6)
    covered, compared = np.zeros(len(points), int), 0
    for s, e, best in tree.assigned(centres):
        for x, y, k in zip(s, e, best):
            covered[x:y] += 1
            compared += 1
            assert (vector_codes.exact(tree.points[x:y], centres).argmin(axis=1) == k).all()
    assert (covered == 1).all() and compared < len(points) / 20
    # Equal entries, and rows half way between two: ties go by the lower index.
    entries = np.concatenate((centres[[3, 3, 5]], [centres[3] + 2, centres[3] - 2]))
    code, error = tree.codes(entries)
    squared = vector_codes.exact(points, entries)
    assert (code == squared.argmin(axis=1)).all() and (error == squared.min(axis=1)).all()
