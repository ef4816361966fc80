import random
from collections import Counter

from ledgerloom.llm import licenses as L
from ledgerloom.llm.passages import words_of

SCHEMA = "doc_id long, text string, licenses string, name int"


def bigrams(words):
    return Counter(zip(words, words[1:]))


def dice(a, b):
    return 2 * sum((bigrams(a) & bigrams(b)).values()) / max(1, len(a) + len(b) - 2)


def brute_best(template, text):
    """The highest Dice coefficient of any run of words."""
    own, words = words_of(template), words_of(text)
    return max((dice(own, words[i:j]) for i in range(len(words)) for j in range(i + 2, len(words) + 1)), default=0)


def test_best_passage_against_all_passages():
    rng = random.Random(3)
    for _ in range(120):
        template = " ".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 9)))
        copy = template.split()
        for _ in range(rng.randint(0, 2)):
            copy[rng.randrange(len(copy))] = rng.choice("abxyz")
        noise = lambda: [rng.choice("abcdxyz") for _ in range(rng.randint(0, 9))]
        text = " ".join(noise() + copy + noise())
        found = L.found_in(L.Templates({"t": template}, 0.8), text)
        best = brute_best(template, text)
        assert bool(found) == (best >= 0.8 - 1e-12)
        if found:
            assert abs(max(f[1] for f in found) - best) < 1e-12
            for _, score, start, end in found:
                assert abs(dice(words_of(template), words_of(text)[start:end]) - score) < 1e-12


def test_notices_in_documents(spark):
    mit = L.TEMPLATES["MIT"]
    rows = [
        (1, "Some words.\nReleased under the MIT License.\nMore words."), (2, None), (3, ""), (4, "release of the license"),
        (5, "intro " * 3000 + mit.replace("hereby ", "").replace("Software", "Program", 1) + " outro" * 3000), (6, "This work is licensed under the GNU General Public License, version 3."),
        (None, "Licensed under CC BY-NC 4.0."), (8, "Licensed under the Apache License, Version 2.0. " * 2), (8, "Licensed under the Apache License, Version 2.0. " * 2),
    ]
    got = L.scan(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect()
    names = sorted((r.doc_id or 0, [f.name for f in r.licenses]) for r in got)
    apache = ["Apache-2.0-notice"] * 2
    assert names == [(0, ["CC-BY-NC-4.0"]), (1, ["MIT-notice"]), (2, []), (3, []), (4, []), (5, ["MIT"]), (6, ["GPL-3.0-notice"]), (8, apache), (8, apache)]
    assert L.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_table(spark):
    path = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    got = {r.doc_id: r for r in L.op10_licenses(spark, path).collect()}
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        exact = {n for n, t in L.TEMPLATES.items() if f" {' '.join(words_of(t))} " in f" {' '.join(words_of(text))} "}
        assert exact <= {f.split(":")[0] for f in got[i].licenses.split(",")}
    assert any(r.n_licenses for r in got.values())


def test_neighbours_of_a_licence_are_told_apart():
    known = L.Templates(L.TEMPLATES, 0.8)
    named = lambda text: [f[0] for f in L.found_in(known, text)]
    for name, text in L.TEMPLATES.items():
        assert named(text) == [name]
    assert named("See: This work is licensed under the GNU Lesser General Public License, version 3.") == ["LGPL-3.0-notice"]
    assert named("Distributed under the Boost Software License, Version 1.0. (See accompanying file)") == ["BSL-1.0-notice"]
    assert named("licensed under CC BY-NC-SA 4.0") == ["CC-BY-NC-SA-4.0"]


def test_twenty_thousand_notices_in_one_text():
    import time

    known = L.Templates(L.TEMPLATES, 0.8)
    start = time.time()
    found = L.found_in(known, "Released under the MIT License. " * 10_000 + "Licensed under the Apache License, Version 2.0. " * 10_000)
    assert len(found) == 20_000 and {f[0] for f in found} == {"MIT-notice", "Apache-2.0-notice"}
    assert time.time() - start < 30


def test_passages_that_meet_do_not_hide_one_another():
    rng = random.Random(8)
    for _ in range(80):
        template = [rng.choice("abcde") for _ in range(rng.randint(3, 7))]
        text = []
        for _ in range(rng.randint(1, 5)):
            copy = list(template)
            if rng.random() < 0.5:
                copy[rng.randrange(len(copy))] = rng.choice("abx")
            text += copy + [rng.choice("abxz") for _ in range(rng.randint(0, 3))]
        known = L.Templates({"t": " ".join(template)}, 0.8)
        got = [f[2:] for f in L.found_in(known, " ".join(text))]
        # Brute force: the most alike run of words that is free, again and again.
        spans = [(-dice(template, text[i:j]), i, j) for i in range(len(text)) for j in range(i + 2, len(text) + 1)]
        want = []
        for score, i, j in sorted(s for s in spans if -s[0] >= 0.8 - 1e-12):
            if all(j - 1 <= a or i >= b - 1 for a, b in want):  # by bigrams, as the operator's passages
                want.append((i, j))
        kept = []
        for i, j in sorted(want, key=lambda w: (-dice(template, text[w[0] : w[1]]), w[0] - w[1], w[0])):
            if all(j <= a or i >= b for a, b in kept):
                kept.append((i, j))
        assert sorted(got) == sorted(kept)
