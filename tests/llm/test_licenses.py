import math
import random

from tidemark.llm import licenses

MIT = licenses.TEMPLATES["MIT text"]


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
        row = new
    return row[-1]


def test_longest_increasing():
    draw = random.Random(1)
    for _ in range(200):
        values = draw.sample(range(50), draw.randrange(12))
        places = licenses.increasing(values)
        picked = [values[i] for i in places]
        assert places == sorted(places) and picked == sorted(picked)
        assert len(places) == longest_common(values, sorted(values))


def test_alignment_pairs_equal_words_in_order():
    draw = random.Random(2)
    for _ in range(300):
        template = [draw.randrange(30) for _ in range(draw.randrange(25))]
        text = [w if draw.random() < 0.9 else 99 for w in template if draw.random() < 0.95]
        pairs = licenses.aligned(text, template)
        assert all(text[i] == template[j] for i, j in pairs)
        assert all(p < r and q < s for (p, q), (r, s) in zip(pairs, pairs[1:]))
        assert len(pairs) <= longest_common(text, template)
    assert len(licenses.aligned(list(range(40)), list(range(40)))) == 40


def test_scan(documents, with_clashes):
    changed = MIT.replace("without restriction", "with no limit").replace("furnished", "given")
    texts = [
        None, "", "the the the software", f"Intro. {MIT} End.", f"/* {changed.upper()} */", "Licensed under CC BY-NC 4.0. x",
        "Released under the MIT License.\nLicensed under the Apache License, Version 2.0.", "ü " * 30_000 + MIT, MIT[: len(MIT) // 3],
    ]
    rows = licenses.scanned(with_clashes([*texts, texts[5]], [*range(len(texts)), 5])).collect()
    got = sorted((r.doc_id, r.license, r.coverage == 1) for r in rows)
    assert got == [
        (3, "MIT text", True), (4, "MIT text", False), (5, "CC-BY-NC-4.0", True), (5, "CC-BY-NC-4.0", True),
        (6, "Apache-2.0", True), (6, "MIT", True), (7, "MIT text", True),
    ]
    spans = {r.doc_id: (r.start, r.end) for r in rows}
    size = len(licenses.Templates({"t": MIT}, 0.8).words[0])
    assert spans[3] == (1, 1 + size) and spans[7] == (30_000, 30_000 + size)


def test_no_templates_and_no_rows(documents):
    assert licenses.scanned(documents([])).collect() == []
    assert licenses.scanned(documents(["Released under the MIT License"]), {}).collect() == []
    assert licenses.scanned(documents(["Released under the MIT License"]), {"empty": " "}).collect() == []


def plain_regions(words, templates, coverage):
    """Every start is tried, without the filters of the operator."""
    found = []
    for i, (name, template) in enumerate(templates.items()):
        width, need, at = math.ceil(licenses.STRETCH * len(template)), math.ceil(coverage * len(template)), 0
        while at < len(words):
            pairs = licenses.aligned(words[at : at + width], template) if words[at] in template else []
            if template and len(pairs) >= need:
                begin, end = at + pairs[0][0], at + pairs[-1][0] + 1
                found.append((-len(pairs), end - begin, len(template), begin, i, name, end))
                at = max(end, at + 1)
            else:
                at += 1
    kept = []
    for hit in sorted(found):
        if all(hit[6] <= other[3] or hit[3] >= other[6] for other in kept):
            kept.append(hit)
    return sorted((name, begin, end, -n) for n, _, _, begin, _, name, end in kept)


def test_regions_equal_brute_force(documents):
    draw = random.Random(4)
    names = "abcdefghijklmnop"
    templates = {f"t{i}": [draw.choice(names) for _ in range(draw.randrange(1, 12))] for i in range(5)}
    templates["same"] = list(templates["t0"])  # regions of equal length and words in one place
    texts = []
    for _ in range(60):
        words = []
        for _ in range(draw.randrange(6)):
            words += [draw.choice([*names, "x", "y"]) for _ in range(draw.randrange(6))]
            words += [w for w in draw.choice(list(templates.values())) if draw.random() < 0.95]
        texts.append(" ".join(words))
    rows = licenses.scanned(documents(texts), {k: " ".join(t) for k, t in templates.items()}, 0.8).collect()
    for i, text in enumerate(texts):
        got = sorted((r.license, r.start, r.end, r.matched) for r in rows if r.doc_id == i)
        assert got == plain_regions(text.split(), templates, 0.8)


def test_every_notice_is_told_from_its_variants(documents):
    names = list(licenses.TEMPLATES)
    rows = licenses.scanned(documents([f"Foo bar. {licenses.TEMPLATES[n]} Baz." for n in names])).collect()
    assert sorted((r.doc_id, r.license, r.coverage) for r in rows) == [(i, n, 1.0) for i, n in enumerate(names)]


def test_the_first_part_of_a_notice_is_not_the_whole(documents):
    parts = [
        MIT[: MIT.index("THE SOFTWARE IS")], licenses.TEMPLATES["ISC"].split("THE SOFTWARE")[0],
        licenses.TEMPLATES["BSD-3-Clause"].split("THIS SOFTWARE")[0],
    ]
    assert licenses.scanned(documents(parts)).collect() == []
