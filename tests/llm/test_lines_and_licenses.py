"""Line windows and licence joins against plain versions."""

from __future__ import annotations

import re

from tidehouse.llm import license_scan, line_dedup


def plain_lines(rows, size=3):
    """Texts without later windows; rows are (doc_id, text) with distinct ids."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        if text is None:
            out[i] = None
            continue
        lines = text.split("\n")
        full = [k for k, line in enumerate(lines) if line.strip(" \t\n\r\x0b\x0c")]
        gone = set()
        for at in range(len(full) - size + 1):
            key = tuple(lines[k].strip(" \t\n\r\x0b\x0c") for k in full[at : at + size])
            if key in seen:
                gone.update(range(full[at], full[at + size - 1] + 1))
            seen.add(key)
        out[i] = "\n".join(line for k, line in enumerate(lines) if k not in gone)
    return out


def test_lines_against_a_plain_pass(docs):
    got = {r.doc_id: r.text for r in line_dedup.without_repeats(docs).collect()}
    assert got == plain_lines([(r.doc_id, r.text) for r in docs.collect()])


def test_repeats_inside_and_across(spark):
    block = "one line\n\n two lines \nthree lines\nfour lines"
    rows = [(1, f"start\n{block}\nend"), (2, f"{block}\nother\n{block}"), (3, "one line\ntwo lines"), (4, None), (5, "")]
    rows += [(10 + k, f"own {k}\n{block}\nlast {k}") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in line_dedup.without_repeats(df).collect()}
    assert {i: r.text for i, r in got.items()} == plain_lines(rows)
    assert got[1]._lines_removed == 0 and got[2].text == "other" and got[2]._lines_removed == 8
    assert got[3].text == "one line\ntwo lines" and got[10].text == "own 0\nlast 0"


def test_lines_of_odd_rows(odd_docs, no_docs):
    out = line_dedup.without_repeats(odd_docs)
    assert out.columns == [*odd_docs.columns, "_lines", "_lines_removed"]
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    texts = {(r.doc_id, r._lines): r.text for r in rows}
    assert texts[(7, 4)] == "Its own end." and texts[(12, 3)] == "" and texts[(12, 1)] == "Another text of the same id."
    assert line_dedup.without_repeats(no_docs).count() == 0


def test_passages_inside_long_lines(spark):
    """A passage of 50 words goes from later lines, but for its edges; own words and short lines stay, also without spaces."""
    passage = [f"p{k}x" for k in range(50)]
    signs = "".join(chr(0x4E00 + 37 * k % 5000) for k in range(60))
    rows = []
    for k in range(40):
        own = [f"o{k}w{j}" for j in range(60)]
        rows.append((k, " ".join(own[:30] + passage + own[30:]) + f"\n\nown {k}\n" + chr(0x3041 + k) * 20 + signs))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in line_dedup.without_repeats(df, long_words=line_dedup.LONG_WORDS).collect()}
    assert got[0].text == rows[0][1] and got[0]._lines_cut == 0
    for k in range(1, 40):
        words = got[k].text.split()
        assert [w for w in words if w[0] == "o" and w != "own"] == [f"o{k}w{j}" for j in range(60)]
        assert sum(w in set(passage) for w in words) <= 25 and f"\n\nown {k}\n" in got[k].text
        assert sum(c in set(signs) for c in got[k].text) <= 40
        assert (got[k]._lines, got[k]._lines_removed, got[k]._lines_cut) == (3, 0, 2)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_scan(text, threshold=0.8):
    words = WORD.findall(low(text))
    places, base = [], set()
    for phrase, label in license_scan.BASE.items():
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                base.add(label)
    best, method = 0.0, set()
    for line in low(text).split("\n"):
        found = set(WORD.findall(line))
        for label, template in license_scan.TEMPLATES:
            wanted = set(template.split())
            share = len(wanted & found) / len(wanted)
            if share >= threshold - 1e-12 and set(license_scan.TELLING.get(template, "").split()) <= found:
                method.add(label)
                best = max(best, share)
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | method)), 1.0 if places else best)


def check_scan(docs):
    texts = docs.select("doc_id", "text").collect()
    expected = sorted((str((i, *plain_scan(t))) for i, t in texts))
    got = license_scan.scan(docs).drop("matches").collect()
    assert sorted(str(tuple(r)) for r in got) == expected


def test_licenses_against_all_pairs(docs):
    check_scan(docs)


def test_licenses_of_odd_rows(odd_docs, no_docs):
    check_scan(odd_docs)
    assert license_scan.scan(no_docs).count() == 0


def test_look_alikes_are_told_apart(spark):
    """Each line shares four fifths of another template's words, but not the words that tell it."""
    rows = [
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc"), ("Licensed under CC BY-SA 4.0.", "cc-by,cc-by-sa"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
        ("Licensed under the GNU Lesser General Public License version 3", "gpl,lgpl"),
        ("released under the apache license", ""), ("Released under the MIT License.", "mit"),
    ]
    df = spark.createDataFrame([(k, text) for k, (text, _) in enumerate(rows)], "doc_id long, text string")
    check_scan(df)
    got = {r.doc_id: r.labels for r in license_scan.scan(df).collect()}
    assert [got[k] for k in range(len(rows))] == [labels for _, labels in rows]


def test_thresholds_and_phrases_over_lines(spark):
    rows = [
        (1, "Licensed under the Apache License, Version 2.0."), (2, "licensed under APACHE license version"),
        (3, "cc\nBY; cc-by"), (4, "released under the mit"), (5, "released under mit"),
        (6, "GENERAL public\tlicense general public license all rights\n\nreserved"), (7, "xcc by cc byx ÀCC BY"),
        (8, "licensed the under 2 license version apache 0 and others"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_scan(df)
    got = {r.doc_id: r for r in license_scan.scan(df).collect()}
    assert got[1].labels == "apache-2.0" and got[5].labels == "" and got[4].labels == "mit" and got[3].n_base == 2
    assert got[8].matches[0].label == "apache-2.0" and got[7].n_base == 0
