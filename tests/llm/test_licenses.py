import random

from cefframe.llm.licenses import SLACK, TEMPLATES, Scanner, align, increasing, license_scan, words_of
from conftest_llm import CLASHING, docs_frame


def brute(text, scanner):
    """Every region of every length that the method could propose, aligned."""
    words, found = words_of(text), []
    for k, (name, template) in enumerate(scanner.templates):
        slack = int(len(template) * SLACK) + 1
        best = 0
        for s in range(-2 * len(template), len(words) + len(template)):
            a, b = max(0, s - slack), min(len(words), s + len(template) + slack)
            best = max(best, len(align(words[a:b], template)) if a < b else 0)
        if best >= scanner.needed[k]:
            found.append((name, best / len(template)))
    return found


def noise(rng, n):
    common = "the license under of a work software this is version to permission".split()
    return " ".join(rng.choice(common + [f"w{rng.randrange(50)}"]) for _ in range(n))


def changed(rng, text):
    w = text.split()
    for _ in range(rng.randrange(len(w) // 4 + 1)):
        k = rng.randrange(len(w))
        w[k:k + rng.randrange(2)] = [f"x{rng.randrange(9)}"] * rng.randrange(2)
    return " ".join(w)


def test_matches_brute_force():
    rng, scanner = random.Random(4), Scanner(TEMPLATES)
    names = sorted(TEMPLATES)
    for i in range(60):
        parts = [noise(rng, rng.randrange(30))]
        for _ in range(rng.randrange(3)):
            parts += [changed(rng, TEMPLATES[rng.choice(names)]), noise(rng, rng.randrange(20))]
        text = "\n".join(parts)
        assert [(n, c) for n, c, _, _ in scanner.scan(text)] == brute(text, scanner)


def test_alignment_is_common_and_increasing():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randrange(20))] for _ in range(2))
        pairs = align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))
    assert align("x a b c y".split(), "a b c".split()) == [(1, 0), (2, 1), (3, 2)]
    assert align("the a the b the".split(), "the a the b the".split()) == [(i, i) for i in range(5)]


def test_increasing():
    rng = random.Random(6)
    for _ in range(200):
        v = rng.sample(range(50), rng.randrange(12))
        got = [v[i] for i in increasing(v)]
        assert got == sorted(got)
        longest = 0
        for mask in range(1 << len(v)):
            s = [x for i, x in enumerate(v) if mask >> i & 1]
            longest = max(longest, len(s) if s == sorted(s) else 0)
        assert len(got) == longest


def test_operator_rows(spark):
    mit = TEMPLATES["MIT"]
    texts = ["", None, "no words here", "Released under the MIT License.", f"x {mit} y", "Released under the MIT License. " * 3,
             (None, "licensed under the apache license version 2 0"), "w " * 60_000 + TEMPLATES["ISC"], "MIT", (3, "again")]
    got = {(r.doc_id, r.first_word): r for r in license_scan(docs_frame(spark, texts, CLASHING)).collect()}
    by = {k[0]: r for k, r in got.items()}
    assert len(got) == len(texts) and by[0].license is None and by[1].coverage == 0.0 and by[8].license is None
    assert by[4].license == "MIT" and by[4].coverage == 1.0 and (by[4].first_word, by[4].last_word) == (1, len(words_of(mit)))
    assert by[5].license == "MIT notice" and by[None].license == "Apache-2.0 notice" and by[7].license == "ISC"
    assert license_scan(docs_frame(spark, ["x"]).limit(0)).collect() == []


def test_rival_licenses_are_told_apart(spark):
    gpl = TEMPLATES["GPL-3.0"]
    texts = {"Released under the BSD License": "BSD notice", "Released under the Apache License": None, "Released under the MIT-0 License": None,
             "Licensed under CC BY 4.0": "CC-BY-4.0 notice", "Licensed under CC BY-SA 4.0": "CC-BY-SA-4.0 notice",
             "Licensed under CC BY-NC-SA 4.0": "CC-BY-NC-SA-4.0 notice", "Licensed under CC BY-NC 4.0": "CC-BY-NC-4.0 notice",
             "This work is licensed under the GNU General Public License, version 2": "GPL-2.0 notice",
             "This work is licensed under the GNU General Public License, version 3": "GPL-3.0 notice",
             "This work is licensed under the GNU Lesser General Public License, version 3": "LGPL-3.0 notice",
             gpl: "GPL-3.0", gpl.replace("version 3", "version 2").replace("software:", "software;"): "GPL-2.0",
             gpl.replace("program", "library").replace("GNU", "GNU Lesser").replace("version 3", "version 2.1"): "LGPL-2.1",
             gpl.replace("GNU", "GNU Affero"): "AGPL-3.0", TEMPLATES["BSD-3-Clause"].replace("name of nor", "name of ACME nor"): "BSD-3-Clause",
             TEMPLATES["BSD-2-Clause"]: "BSD-2-Clause", "// SPDX-License-Identifier: MPL-2.0": "MPL-2.0 tag",
             "Released under the MIT Licence": "MIT notice"}
    got = {r.doc_id: r.license for r in license_scan(docs_frame(spark, list(texts))).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts.values())


def test_license_texts_and_headings(spark):
    gpl3 = ("GNU GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007\n\nCopyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>\n"
            "Everyone is permitted to copy and distribute verbatim copies\nof this license document, but changing it is not allowed.")
    texts = {"MIT License\n\nCopyright (c) 2020 X": "MIT heading 1", "license: MIT": "MIT heading 2",
             "Apache License v2.0": "Apache-2.0 heading 2", "under the Apache License, Version 2.0 only": "Apache-2.0 heading 1",
             "Apache License": None, "license: MITRE": None, "MIT is a school": None, "BSD 3-Clause License": "BSD-3-Clause heading 1",
             f"x\n{TEMPLATES['Apache-2.0 terms']}\ny": "Apache-2.0 terms", gpl3: "GPL-3.0 terms",
             gpl3.replace("Version 3, 29", "Version 2, 29"): None, gpl3.replace("GNU", "GNU AFFERO").replace("29 June", "19 November"): "AGPL-3.0 terms",
             TEMPLATES["EPL-2.0"]: "EPL-2.0", "Eclipse Public License - v 1.0": None, TEMPLATES["CC0-1.0"]: "CC0-1.0",
             "Creative Commons Attribution-ShareAlike 4.0 International License": "CC-BY-SA-4.0 heading 1",
             "Creative Commons Attribution 3.0 Unported": None, "Released under the MIT License": "MIT notice"}
    got = {r.doc_id: r.license for r in license_scan(docs_frame(spark, list(texts))).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts.values())


def test_a_text_full_of_licenses_is_aligned_once(monkeypatch):
    from cefframe.llm import licenses as L
    calls = []
    monkeypatch.setattr(L, "align", lambda a, b: calls.append(1) or align(a, b))
    scanner = Scanner({"MIT": TEMPLATES["MIT"]}, keys={"MIT": L.KEYS["MIT"]})
    n = len(words_of(TEMPLATES["MIT"]))
    assert scanner.scan("\n".join([TEMPLATES["MIT"]] * 60)) == [("MIT", 1.0, 0, n - 1)] and len(calls) == 1
    calls.clear()
    assert scanner.scan(TEMPLATES["MIT"].replace("subject to the", "under") * 5) == [] and not calls  # lacks its key phrase
