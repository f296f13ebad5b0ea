"""Licence scan against plain containment, on planted whole, edited and scattered notices."""

import random
import re

from pyspark.sql import Row

from tessera.llm.license_scan import CONTAINMENT, needles, scan_licenses
from tessera.llm.license_templates import TEMPLATES


def grams(text):
    w = re.findall("[a-z0-9]+", (text or "").lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(text):
    have, known = grams(text), {i: grams(t) for i, t in TEMPLATES}
    held = {i: len(g & have) / len(g) for i, g in known.items() if len(g & have) / len(g) >= CONTAINMENT}

    def shadowed(i):
        return any(held[j] > held[i] and len(known[i] & known[j]) / len(known[i]) >= CONTAINMENT and known[i] - known[j]
                   and not have & (known[i] - known[j]) for j in held if j != i)
    return {i for i in held if not shadowed(i)}


def test_planted_notices(spark):
    rng = random.Random(3)
    noise = lambda k: " ".join(rng.choice(["alpha", "the", "license", "software", "of", "use"]) + str(rng.randint(0, 50)) for _ in range(k))
    rows, n = [], 0
    for i, t in TEMPLATES:
        words = t.split()
        for trial in range(6):
            w = list(words)
            if trial > 2 and len(w) > 40:  # one or two changed words still leave 0.8 of the shingles
                for _ in range(trial - 2):
                    w[rng.randrange(len(w))] = "changed"
            rows.append((n, noise(rng.randint(0, 300)) + "\n" + " ".join(w) + "\n" + noise(rng.randint(0, 300))))
            n += 1
        half = " ".join(words[:len(words) // 2])
        rows.append((n, noise(20) + " " + half))
        n += 1
    got = {r.doc_id: {x.id for x in r.licenses} for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {d: brute(t) for d, t in rows}
    assert got == want and sum(map(len, want.values())) > 6 * len(TEMPLATES) * 0.8


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: {x.id for x in r.licenses} for r in scan_licenses(df).collect()}
    return [got[i] for i in range(len(texts))]


def test_notices_in_distant_parts(spark):
    """Parts that share four words at each cut, hundreds of other words between them: no shingle is lost, no window holds them."""
    texts, want = [], []
    for i, t in TEMPLATES:
        words = re.findall("[a-z0-9]+", t.lower())
        for parts in range(2, 9):
            size = -(-len(words) // parts)
            if size >= 2:
                cut = [" ".join(words[max(0, k - 4):k + size]) for k in range(0, len(words), size)]
                texts.append((" . " + " ".join(f"noise{k}" for k in range(300)) + " . ").join(cut))
                want.append(i)
    got = scan(spark, texts)
    assert got == [brute(t) for t in texts]
    assert all(i in g for i, g in zip(want, got))


def test_sister_licences_are_told_apart(spark):
    known = dict(TEMPLATES)
    gnu = ["agpl-3.0", "gpl-2.0", "gpl-3.0", "lgpl-2.1", "lgpl-3.0"]
    texts = [known[i] for i in gnu] + [known["gpl-2.0"] + " also " + known["gpl-3.0"], known["gpl-3.0"].replace("version 3", "some version"),
             known["gpl-2.0"] + " also " + known["gpl-3.0"].replace("redistribute", "share")]
    got = scan(spark, texts)
    assert got == [brute(t) for t in texts]
    assert got[:5] == [{i} for i in gnu] and got[5] == got[7] == {"gpl-2.0", "gpl-3.0"} and got[6] & set(gnu)
    alone = scan(spark, [t for _, t in TEMPLATES])
    assert all(i in g for (i, _), g in zip(TEMPLATES, alone))


def test_needles_cover_over_a_fifth():
    for _, t in TEMPLATES:
        g = grams(t)
        assert sum(any(n in x for n in needles(t)) for x in g) > (1 - CONTAINMENT) * len(g)


def test_needles_leave_less_than_a_reported_share():
    for _, t in TEMPLATES:
        g = grams(t)
        assert sum(not any(n in x for n in needles(t)) for x in g) / len(g) < CONTAINMENT


def test_exactly_a_fifth_is_missing(spark):
    line = "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 License."
    rows = [(1, line), (2, "alpha beta " * 50 + line + " gamma" * 50), (3, line.replace("Attribution", ""))]
    got = {r.doc_id: {x.id for x in r.licenses} for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: brute(t) for d, t in rows} and got[1] == got[2] == {"cc-by-sa-4.0"}


def test_edge_cases(spark):
    line = "Released under the MIT License."
    rows = [Row(1, None, "x", 1), Row(1, "", "x", 1), Row(None, line, "x", 1), Row(2, line, "x", 1), Row(2, line, "x", 1),
            Row(3, "é " * 200_000 + line.upper(), "x", 1), Row(4, "MIT License", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, low string, licenses int")
    out = scan_licenses(df)
    assert out.columns == ["doc_id", "licenses"]
    got = sorted(((r.doc_id, [x.id for x in r.licenses]) for r in out.collect()), key=repr)
    assert got == sorted([(1, []), (1, []), (None, ["mit-line"]), (2, ["mit-line"]), (2, ["mit-line"]), (3, ["mit-line"]), (4, [])], key=repr)
    assert scan_licenses(df.where("false")).count() == 0
    assert all(r.licenses == [] for r in scan_licenses(df, templates=(("x", "too short"),)).collect())
