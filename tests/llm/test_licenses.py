"""License scan: alignment, windows, coverage."""

import itertools
import random

from sideline.llm import licenses

KNOWN = licenses.templates()


def _best(text):
    found = licenses.scan(text, KNOWN)
    return (found[0][0], round(found[0][1], 2)) if found else None


def test_every_template_finds_itself_in_noise():
    for name, text in licenses.TEMPLATES.items():
        found = {n: c for n, c, _, _ in licenses.scan("some words the before " * 30 + text.upper() + " after the of it" * 30, KNOWN)}
        assert found.get(name) == 1.0, name


def test_repeated_and_changed_notices():
    assert _best("Released under the MIT License.\nReleased under the MIT License.\nReleased under the MIT License.") == ("MIT (notice)", 1.0)
    assert _best(licenses.TEMPLATES["MIT"].replace("merge", "change").replace("sublicense,", "")) == ("MIT", 0.98)
    assert _best("the license of the version") is None
    assert _best("") is None


def test_words_that_recur_inside_one_notice():
    """A word the template has once may come before the notice too; the notice is found whole."""
    before = {"MIT": "Copyright (c) 2024 Jane Doe", "ISC": "Copyright (c) 2024 Jane Doe", "MPL-2.0 (header)": "This file is part of Foo.",
              "GPL-3.0 (notice)": "Software license: GNU General Public License."}
    for name, line in before.items():
        notice = f"{line}\n\n{licenses.TEMPLATES[name]}"
        n = len(licenses.words(notice))
        for text, times in ((notice, 1), ((notice + "\n") * 3, 3), ("plain " * 500 + notice + " plain" * 500, 1)):
            found = {m: (c, f, e) for m, c, f, e in licenses.scan(text, KNOWN)}
            assert found[name][0] == 1.0, (name, times)
            lead = 500 if text.startswith("plain") else 0
            assert lead <= found[name][1] and found[name][2] <= lead + n, (name, times)


def test_a_recurring_word_in_a_notice_spread_out():
    """Twice as long as the template, with words it has once added in between."""
    spread = " ".join(w if k % 4 else f"{w} copyright Jane" for k, w in enumerate(licenses.words(licenses.TEMPLATES["MIT"])))
    found = {n: c for n, c, _, _ in licenses.scan(spread + " copyright permission sublicense", KNOWN)}
    assert found.get("MIT", 0) >= 0.95


CHARTER = "released under the granting charter of all makers you may copy modify or share it freely provided this charter stays"


def _changed(rnd, template, changes):
    out = list(template.words)
    for _ in range(changes):
        k = rnd.randrange(len(out))
        kind = rnd.randrange(3)
        if kind == 0:
            out[k] = "zz"
        elif kind == 1:
            out.insert(k, rnd.choice(template.words))
        else:
            out.pop(k)
    return out


def test_windows_against_all_windows():
    """A match is found if and only if any window of the text aligns well enough; its coverage is at most two words below the best of all windows."""
    rnd, t = random.Random(5), licenses.Template("charter", CHARTER, 0.8)
    seen = [0, 0]
    for _ in range(150):
        noise = [[rnd.choice(["the", "a", "qq", "rr", *t.words]) if rnd.random() < 0.4 else "qq" for _ in range(rnd.randint(0, 14))] for _ in range(2)]
        text = noise[0] + _changed(rnd, t, rnd.randint(0, 7)) + noise[1]
        best = max(len(licenses.align(text[a:b], t.words)) for a in range(len(text)) for b in range(a + 1, len(text) + 1))
        coverage, first, end = t.match(text)
        holds = best >= t.least * len(t.words)
        seen[holds] += 1
        assert holds == (coverage >= t.least) and (not holds or best - 2 <= round(coverage * len(t.words)) <= best)
        assert not holds or len(licenses.align(text[first:end], t.words)) <= round(coverage * len(t.words))
    assert min(seen) >= 15


def test_every_place_of_a_template():
    """Planted notices, plain and changed, next to each other or apart, are each found at their place."""
    rnd, t = random.Random(7), licenses.Template("charter", CHARTER, 0.8)
    for _ in range(60):
        text, planted = [], []
        for _ in range(rnd.randint(0, 9)):
            text += ["qq"] * rnd.choice([0, 1, 5, 60])
            notice = _changed(rnd, t, rnd.choice([0, 0, 1]))
            planted.append((len(text), len(text) + len(notice)))
            text += notice
        text += ["qq"] * rnd.randint(0, 30)
        found = t.everywhere(text)
        assert len(found) == len(planted)
        for (coverage, first, end), (a, b) in zip(found, planted):
            assert coverage >= 0.9 and abs(first - a) <= 2 and abs(end - b) <= 2
        assert all(x[2] <= y[1] for x, y in zip(found, found[1:]))


def test_thousands_of_copies_in_one_text():
    line = "Copyright 2024 by me\n"
    text = (line + licenses.TEMPLATES["ISC"] + "\n") * 2000
    (t, every), = [x for x in licenses.places(licenses.words(text), KNOWN) if x[0].name == "ISC"]
    assert len(every) == 2000 and {c for c, _, _ in every} == {1.0}


def test_two_changed_copies_far_apart_are_two_places():
    """Together they would make one wide match of more words."""
    t = licenses.Template("charter", CHARTER, 0.8)
    for gap in (0, 30, 70, 500):
        text = [w for w in t.words if w not in ("freely", "stays")] + ["qq"] * gap + [w for w in t.words if w not in ("released", "granting")]
        assert [(c, f, e) for c, f, e in t.everywhere(text)] == [(0.9, 0, 18), (0.9, 18 + gap, 36 + gap)]


def test_whole_texts_win_over_their_parts():
    assert _best("Copyright 2024 X\n" + licenses.TEMPLATES["MIT (with disclaimer)"]) == ("MIT (with disclaimer)", 1.0)
    assert _best(licenses.TEMPLATES["BSD-3-Clause (with disclaimer)"]) == ("BSD-3-Clause (with disclaimer)", 1.0)
    assert _best(licenses.TEMPLATES["BSD-2-Clause"]) == ("BSD-2-Clause", 1.0)


def test_templates_from_a_folder(spark, tmp_path):
    (tmp_path / "A+ 1.0.txt").write_text("alpha beta gamma\ndelta epsilon")
    (tmp_path / "B-2.0").write_text(CHARTER)
    (tmp_path / "empty.txt").write_text("")
    given = licenses.read_templates(spark, str(tmp_path))
    assert {k: v for k, v in given.items() if v} == {"A+ 1.0": "alpha beta gamma\ndelta epsilon", "B-2.0": CHARTER}
    docs = spark.createDataFrame([(1, f"x {CHARTER} y alpha beta gamma delta epsilon {CHARTER}", 0)], "doc_id long, text string, occurrences int")
    row, = licenses.license_scan(docs, given).collect()
    assert (row.license, row.matches) == ("B-2.0", ["B-2.0", "A+ 1.0"])
    assert [(o.license, o.coverage, o.first_word, o.end_word) for o in row.occurrences] == [("B-2.0", 1.0, 1, 21), ("A+ 1.0", 1.0, 22, 27), ("B-2.0", 1.0, 27, 47)]


def test_longest_increasing():
    for p in itertools.permutations(range(6)):
        best = max(len(c) for k in range(7) for c in itertools.combinations(range(6), k) if all(p[a] < p[b] for a, b in zip(c, c[1:])))
        run = licenses.increasing(list(enumerate(p)))
        assert len(run) == best and all(a < c and b < d for (a, b), (c, d) in zip(run, run[1:]))


def test_gaps_are_aligned():
    """`the` comes twice, but is unique between anchors; places increase in both."""
    text, template = "the quick brown the fox x the".split(), "a the brown the fox".split()
    found = licenses.align(text, template)
    assert [template[c] for _, c in found] == ["the", "brown", "the", "fox"]
    assert all(text[a] == template[c] for a, c in found)


def test_signals_lose_nothing():
    """Without any signal word the coverage stays below the least."""
    for t in KNOWN:
        rest = [w for w in t.words if w not in t.signals]
        assert len(rest) / len(t.words) < t.least or not t.signals


def test_rows(spark):
    rows = [(1, "Released under the MIT License.", "x"), (2, None, "y"), (3, "", None), (None, "plain", "z"), (1, "Released under the MIT License.", "x"),
            (4, "word " * 200_000 + "Licensed under the Apache License, Version 2.0.", "q")]
    out = licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string, license string")).collect()
    assert sorted((str(r.doc_id), r.license) for r in out) == sorted((str(d), n) for d, n in (
        (1, "MIT (notice)"), (2, None), (3, None), (None, None), (1, "MIT (notice)"), (4, "Apache-2.0 (notice)")))
    assert {r.n_words for r in out if r.doc_id == 2} == {0}
    assert [r.first_word for r in out if r.doc_id == 4] == [200_000]
    assert licenses.license_scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
