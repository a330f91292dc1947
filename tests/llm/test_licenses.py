import math
import re
from collections import Counter

from salesmart.llm.licenses import FULL_TEXTS, SIMILAR, TEMPLATES, scan_licenses

MIT = "Released under the MIT License."
APACHE = [t for name, t in TEMPLATES if name == "Apache-2.0"][1]


def _files():
    prose = "\n".join(f"word{k} the of and word{k + 1} under a line of text" for k in range(40))
    return [(1, "a/LICENSE", MIT + "\n" + prose), (2, "a/src/x.py", prose), (3, "a/src/deep/y.py", prose + "\n" + APACHE),
            (4, "a/src/deep/z.py", prose), (5, "b/x.py", prose), (6, "b/c/COPYING.txt", "Licensed under CC BY-NC 4.0."),
            (7, "b/c/d/e.py", None), (8, "b/c/d/f.py", ""), (9, None, prose), (10, None, MIT), (11, "top.py", prose),
            (12, "d/notes", MIT), (13, "d/other.py", prose), (14, "a/src/x.py", prose), (15, "q/readme", prose + "\n" + MIT),
            (16, "q/code", "the under MIT"), (17, "b/c/g.py", APACHE.replace("may not use", "shall not use").replace(" ", "\n", 3)),
            (18, "d/long.py", prose * 200)]


def _brute(files):
    """(own license, score) by whole TF-IDF vectors over every segment."""
    tokens = lambda t: re.findall(r"[^\W_]+", t.lower())
    df = Counter(w for _, _, t in files for w in set(tokens(t or "")))
    vocabulary = {w for _, t in TEMPLATES for w in tokens(t)}
    idf = lambda w: 1 + math.log((1 + len(files)) / (1 + df[w])) if w in vocabulary else 1 + math.log(1 + len(files))
    vectors = [(name, {w: c * idf(w) for w, c in Counter(tokens(t)).items()}) for name, t in TEMPLATES]
    out = {}
    for i, _, text in files:
        best = (0.0, None)
        for seg in [text or "", *(text or "").split("\n"), *re.split(r"\n\s*\n", text or "")]:
            v = {w: c * idf(w) for w, c in Counter(tokens(seg)).items()}
            for name, t in vectors:
                dot = sum(x * t.get(w, 0) for w, x in v.items())
                if dot:
                    cos = round(dot / math.sqrt(sum(x * x for x in v.values()) * sum(x * x for x in t.values())), 9)
                    if cos >= SIMILAR and cos > best[0]:
                        best = (cos, name)
        out[i] = best
    return out


def test_own_licenses_match_brute_force(spark):
    files = _files()
    frame = spark.createDataFrame([(*f, "x") for f in files], "id long, path string, text string, dir string").repartition(3)
    got = {r.id: r for r in scan_licenses(frame).collect()}
    assert len(got) == len(files)
    for i, (score, name) in _brute(files).items():
        assert got[i].own_license == name and abs(got[i].score - score) < 1e-6, i


def test_inheritance_from_the_nearest_directory(spark):
    got = {r.id: r for r in scan_licenses(spark.createDataFrame(_files(), "id long, path string, text string")).collect()}
    assert (got[2].license, got[2].origin, got[2].inherited_from) == ("MIT", "inherited", "a")
    assert (got[4].license, got[4].inherited_from) == ("MIT", "a")      # a header is no licence file
    assert got[3].origin == "own" and got[3].license == "Apache-2.0"
    assert got[5].origin == "none" and got[5].license is None
    assert {got[i].license for i in (7, 8)} == {"CC-BY-NC-4.0"} and got[7].inherited_from == "b/c"
    assert got[9].origin == "none" and got[10].origin == "own" and got[11].origin == "none"
    assert got[13].license == "MIT" and got[13].inherited_from == "d"   # a file that is a licence and no more
    assert got[14].license == "MIT" and got[15].origin == "own" and got[16].origin == "none"


def test_full_texts_and_headers_have_their_own_id(spark):
    wanted = [(name, text) for name, text in TEMPLATES if len(text) > 150]
    assert {name for name, text in wanted if len(text.split()) > 100} == set(FULL_TEXTS)
    code = "\n\nint main(void) { return puts(name); }\n" * 4
    files, names = [], []
    for name, text in wanted:
        for form in ("Copyright (c) 2020 A. Person\n\n" + text, text + code) if len(text.split()) > 100 else (text, text + "\n" + code):
            names.append(name)
            files.append((len(files), f"{len(files)}/LICENSE", form))
    files += [(1000 + k, f"src/{k}.py", f"word{k} the of and to in this a line of text") for k in range(40)]
    got = {r.id: r.own_license for r in scan_licenses(spark.createDataFrame(files, "id long, path string, text string")).collect()}
    assert [got[k] for k in range(len(names))] == names
    assert not any(got[1000 + k] for k in range(40))


def test_root_directory_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "LICENSE", MIT), (2, "a/b/c.py", "x"), (3, "d.py", "y")], "id long, path string, text string")
    got = {r.id: r for r in scan_licenses(frame).collect()}
    assert got[2].license == got[3].license == "MIT" and got[2].inherited_from == ""
    assert scan_licenses(frame.limit(0)).isEmpty()


def _own(spark, texts):
    rows = [(k, f"{k}/LICENSE", t) for k, t in enumerate(texts)]
    rows += [(1000 + k, f"src/{k}.py", f"word{k} the of and to in this a line of text") for k in range(40)]
    got = {r.id: r for r in scan_licenses(spark.createDataFrame(rows, "id long, path string, text string")).collect()}
    return [got[k] for k in range(len(texts))]


def test_openings_of_full_texts_have_their_id_or_none(spark):
    full = [(name, text) for name, text in TEMPLATES if len(text.split()) > 100]
    asked = [(name, text[:n]) for name, text in full for n in (1000, 3000, 10000) if n < len(text)]
    got = [r.own_license for r in _own(spark, [t for _, t in asked])]
    assert not [(n, g, len(t)) for (n, t), g in zip(asked, got) if g not in (n, None)]
    assert sum(g == n for (n, _), g in zip(asked, got)) >= 0.8 * len(asked)


def test_spdx_tags(spark):
    tags = {"# SPDX-License-Identifier: MIT": "MIT", "// SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
            "/* SPDX-License-Identifier: GPL-2.0-or-later */": "GPL-2.0", "<!-- SPDX-License-Identifier: LGPL-2.1-only -->": "LGPL-2.1",
            "# SPDX-License-Identifier: LGPL-2.0": None, "# SPDX-License-Identifier: Foo": None,
            "# SPDX-License-Identifier: MIT OR Apache-2.0": None}
    code = "\n\nint main(void) { return puts(name); }\n" * 4
    assert [r.own_license for r in _own(spark, [t + code for t in tags])] == list(tags.values())


def test_words_out_of_order_are_no_licence(spark):
    got = _own(spark, ["all rights reserved by the rights holder of all reserved rights", "All rights reserved.",
                       " ".join(sorted(APACHE.split()))])
    assert [r.own_license for r in got] == [None, "All-Rights-Reserved", None]


def test_all_licences_of_a_file(spark):
    mit = next(t for name, t in TEMPLATES if name == "MIT" and len(t.split()) > 100)
    code = "\n\nint main(void) { return puts(name); }\n\n"
    got = _own(spark, [APACHE + code + MIT + code, mit, "nothing here", None])
    assert [r.own_licenses for r in got] == [["Apache-2.0", "MIT"], ["MIT"], [], []]
