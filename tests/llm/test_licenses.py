from __future__ import annotations

import random

from inkprint.llm.decontaminate import words_of
from inkprint.llm.licenses import RULES, TEMPLATES, Scanner, align, known_templates, scan_licenses


def longest(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment_is_common_and_increasing():
    r = random.Random(1)
    for _ in range(300):
        a = [r.randrange(12) for _ in range(r.randrange(25))]
        b = [r.randrange(12) for _ in range(r.randrange(25))]
        pairs = align(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and len(pairs) <= longest(a, b)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
        if len(set(a)) == len(a) and len(set(b)) == len(b):
            assert len(pairs) == longest(a, b)
    assert len(align(list("abcde"), list("abcde"))) == 5 and align([], [1]) == []


def matches(spark, texts, **options):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [[(m["license"], round(m["coverage"], 3), t[m["start"]:m["end"]]) for m in r["licenses"]["matches"]]
            for r, t in zip(scan_licenses(d, **options).orderBy("doc_id").collect(), texts)]


def test_notices_in_texts(spark):
    mit = " ".join(TEMPLATES["mit"].split())
    edited = mit.replace("without restriction", "with no restriction").replace("persons", "people")
    filler = "é the of and license a version under " * 60
    got = matches(spark, [
        filler + "Released under the MIT License. " + filler + "\nReleased under the MIT License.", filler + edited + filler, filler,
        None, "", "Licensed under CC BY-NC 4.0.", TEMPLATES["apache-2.0-notice"].replace("\n", " # ")])
    assert got[0] == [("mit-reference", 1.0, "Released under the MIT License")] * 2
    assert [m[0] for m in got[1]] == ["mit"] and 0.9 < got[1][0][1] < 1 and got[1][0][2].startswith("Permission")
    assert got[2] == got[3] == got[4] == [] and [m[0] for m in got[5]] == ["cc-by-nc-4.0-reference"]
    assert [m[0] for m in got[6]] == ["apache-2.0-notice"]


def test_every_occurrence_of_a_window_is_found():
    r = random.Random(7)
    scanner = Scanner({"t": "alpha beta gamma delta epsilon zeta"}, 0.8)
    for _ in range(200):
        words = [b"w%d" % r.randrange(50) for _ in range(r.randrange(40))]
        at = r.randrange(len(words) + 1)
        words[at:at] = [b"alpha", b"beta", b"gamma", b"delta", b"epsilon", b"zeta"]
        assert scanner.scan(words) == [("t", 1.0, at, at + 5)]


def test_own_templates_clashing_column_and_empty_table(spark):
    d = spark.createDataFrame([(1, "do not copy", "x")], "doc_id int, text string, licenses string")
    r = scan_licenses(d, templates={"own": "Do not copy!", "void": "..."}).first()
    assert [m["license"] for m in r["licenses"]["matches"]] == ["own"]
    assert scan_licenses(d.limit(0)).count() == 0


def test_inserted_words_at_every_offset():
    scanner = Scanner({"r": "all rights reserved", "t": "alpha beta gamma delta epsilon zeta"}, 0.8)
    for at in range(40):
        before = [b"w"] * at
        assert scanner.scan([*before, *b"all other rights hereby reserved".split(), *before]) == [("r", 1.0, at, at + 4)]
        spread = b"alpha x beta x gamma x delta x epsilon x zeta".split()
        assert scanner.scan([*before, *spread, *before]) == [("t", 1.0, at, at + 10)]


def test_adjacent_copies_at_every_offset():
    for name in ("all rights reserved", "alpha beta gamma delta epsilon zeta", "may copy and may sell and may use"):
        words = name.encode().split()
        scanner = Scanner({"t": name}, 0.8)
        for copies in range(1, 8):
            for at in range(len(words) * 3):
                got = scanner.scan([b"w"] * at + words * copies + [b"w"] * 5)
                assert got == [("t", 1.0, at + k * len(words), at + (k + 1) * len(words) - 1) for k in range(copies)], (name, copies, at)


def test_every_template_is_found_as_itself():
    templates = known_templates()
    scanner = Scanner(templates, 0.8, rules=RULES)
    assert set(RULES) <= set(templates) and len(templates) > 90
    for name, text in templates.items():
        words = [b"w", b"x", *words_of(text.encode()), b"y"]
        got = [m[0] for m in scanner.scan(words) if m[3] - m[2] + 1 >= len(words) // 2]
        assert got == [name], (name, got)


def test_siblings_are_told_apart(spark):
    bsd3 = TEMPLATES["bsd-3-clause"].replace("copyright holder", "University")
    got = matches(spark, [
        "This work is licensed under the GNU General Public License, version 2.", "Licensed under CC BY-SA 4.0.",
        "This work is licensed under the GNU Lesser General Public License, version 3.", "Licensed under CC BY 9.0.",
        "This work is licensed under the GNU General Public License, version 7.", bsd3, "Licensed under CC0 1.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 3.0 Unported License.", "Licensed under CC BY 4.0."])
    assert [[m[0] for m in g] for g in got] == [
        ["gpl-2.0-reference"], ["cc-by-sa-4.0-reference"], ["lgpl-3.0-reference"], [], [], ["bsd-3-clause"], ["cc0-1.0-reference"],
        ["cc-by-nc-3.0-notice"], ["cc-by-4.0-reference"]]
