import math
import random
import textwrap

import numpy as np

from municare.llm import licenses

SCHEMA = "doc_id long, path string, text string, license int, dir int, depth int"
FILL = " ".join(f"word{i} other{i}." for i in range(40))


def scanned(spark, rows):
    frame = spark.createDataFrame([(*r, 0, 0, 0) for r in rows], SCHEMA)
    return {r["doc_id"]: r for r in licenses.scan_licenses(frame).collect()}


def test_headers_files_and_inheritance(spark):
    rows = [
        (1, "a/LICENSE", "Released under the MIT License."),
        (2, "a/b/c/x.txt", FILL),
        (3, "a/b/COPYING", "This work is licensed under the GNU General Public License, version 3"),
        (4, "a/b/y.txt", f"{FILL}\n# licensed under the Apache License, version 2.0\n{FILL}"),
        (5, "a/z.txt", FILL), (6, "d/x.txt", FILL), (7, "top.txt", FILL), (8, None, FILL), (9, "a/e/f", None), (10, "a/e/g", ""),
        (11, "d/e", f"{FILL} we were licensed under the impression of a version"),
    ]
    got = scanned(spark, rows)
    assert {i: (r["license"], r["from_dir"]) for i, r in got.items()} == {
        1: ("MIT", None), 2: ("GPL-3.0", "a/b"), 3: ("GPL-3.0", None), 4: ("Apache-2.0", None), 5: ("MIT", "a"),
        6: (None, None), 7: (None, None), 8: (None, None), 9: ("MIT", "a"), 10: ("MIT", "a"), 11: (None, None),
    }
    assert got[4]["header_line"] == 1 and got[4]["file_license"] is None


def test_root_files_serve_everything_and_ties_go_by_name(spark):
    rows = [(1, "LICENSE", "Licensed under CC BY-NC 4.0."), (2, "x/Licence.txt", "Released under the MIT License."), (3, "x/COPYING", "Licensed under CC BY-NC 4.0."), (4, "x/y", FILL), (5, "z/y", FILL), (5, "z/y", FILL)]
    got = scanned(spark, rows)
    assert got[4]["license"] == "CC-BY-NC-4.0" and got[4]["from_dir"] == "x"
    assert got[5]["license"] == "CC-BY-NC-4.0" and got[5]["from_dir"] == ""


def test_skipping_is_exact():
    import numpy as np

    match = licenses.Matcher(50, np.zeros(1 << licenses.BITS, int), licenses.TEMPLATES, licenses.FILE_COSINE)
    full = licenses.Matcher(50, match.frequencies, licenses.TEMPLATES, licenses.FILE_COSINE)
    full.needed = {t for v in full.vectors for t in v}
    for text in (MIT, MIT[:500], GPL_HEADER,"the version of the work", "licensed under", "the terms of the public", "free of charge to any person", "under the license", "2.0 version"):
        counts = licenses.terms(text.encode())
        if full.best(counts)[0] >= licenses.FILE_COSINE:
            assert match.best(counts) == full.best(counts)


def test_no_rows(spark):
    assert scanned(spark, []) == {}


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
GPL_HEADER = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""


def test_whole_licence_files_pass_down_and_wrapped_headers_are_found(spark):
    whole = {name: textwrap.fill(text, 64) for name, text in licenses.TEMPLATES if len(text) > 1000}
    assert set(whole) >= {"MIT", "Apache-2.0", "BSD-3-Clause", "GPL-3.0", "MPL-2.0", "CC-BY-NC-4.0"}
    whole["MIT"] = f"The MIT License (MIT)\n\nCopyright (c) 2020 Some Body\n\n{MIT}"
    rows, want = [], {}
    for k, (name, text) in enumerate(sorted(whole.items())):
        rows += [(2 * k, f"p{k}/LICENSE", text), (2 * k + 1, f"p{k}/src/x.txt", FILL)]
        want |= {2 * k: (name, None), 2 * k + 1: (name, f"p{k}")}
    commented = "\n".join(f" * {line}".rstrip() for line in MIT.split("\n"))
    rows += [(100, "q/a.py", f"#!/bin/x\n#\n{GPL_HEADER}\n\n{FILL}\n{FILL} more"), (101, "q/b.c", f"{FILL}\n{commented}\n{FILL}\n" * 2 + f"{FILL} z\n" * 40)]
    want |= {100: ("GPL-3.0", None), 101: ("MIT", None)}
    got = scanned(spark, rows + [(200 + i, None, f"{FILL} {i}") for i in range(60)])
    assert {i: (got[i]["license"], got[i]["from_dir"]) for i in want} == want
    assert got[100]["header_line"] == 2 and got[101]["header_line"] == 1 and got[101]["file_license"] is None


def test_best_window_equals_brute_force():
    rng = random.Random(5)
    pool = "the a of license licensed under version gnu general public mit 2.0 3 code work x y z # --".split()
    templates = (("A", "Licensed under the GNU General Public License version 3"), ("B", "released under the MIT license"), ("C", "work of code x y z " * 3))
    frequencies = np.array([rng.randint(0, 40) for _ in range(1 << licenses.BITS)])
    match = licenses.Matcher(50, frequencies, templates, 0.5, 0.6)
    for _ in range(300):
        text = "\n".join(" ".join(rng.choices(pool, k=rng.choice([0, 1, 2, 3, 5, 9]))) for _ in range(rng.randint(1, 14))).encode()
        counts = [licenses.terms(line) for line in text.split(b"\n")]
        worded = [n for n, c in enumerate(counts) if c]
        size = {n: sum(counts[n].values()) for n in worded}
        found = []
        for (name, words), vector in zip(templates, match.vectors):
            length = sum(licenses.terms(words.encode()).values())
            for s in range(len(worded)):
                over = next((e for e in range(s, len(worded)) if sum(size[n] for n in worded[s : e + 1]) >= length), len(worded) - 1)
                spans = {s, over, max(over - 1, s)}
                if worded[s] - 1 not in worded:
                    spans.add(next(e for e in range(s, len(worded)) if worded[e] + 1 not in worded))
                for e in spans:
                    own = match.vector(sum((counts[n] for n in worded[s : e + 1]), licenses.Counter()))
                    cosine = round(math.fsum(w * own.get(t, 0.0) for t, w in vector.items()), 9)
                    found += [(-cosine, worded[s], name)] if cosine >= 0.6 else []
        name, cosine, line = match.scan(text)[:3]
        want = min(found, default=None)
        assert (name is None) == (want is None)
        if want:
            assert abs(cosine + want[0]) < 3e-9 and (line, name) in {(n, x) for c, n, x in found if c < want[0] + 3e-9}


def test_a_notice_in_a_short_text_makes_no_licence_file(spark):
    rows = [(1, "a/x.py", "# Released under the MIT License.\nimport x"), (2, "a/y.py", FILL), (3, "a/b/z.py", FILL), (4, "a/notes", "x"),
            (5, "c/LICENSE.md", MIT[:300]), (6, "c/d", FILL), (7, "e/any_name", MIT), (8, "e/f/g", FILL)]
    got = scanned(spark, rows + [(200 + i, None, f"{FILL} {i}") for i in range(60)])
    assert (got[1]["license"], got[1]["file_license"]) == ("MIT", None)
    assert [got[i]["license"] for i in (2, 3, 4)] == [None] * 3
    assert (got[5]["file_license"], got[6]["license"], got[6]["from_dir"]) == ("MIT", "MIT", "c")  # a file by its name
    assert (got[7]["file_license"], got[8]["license"], got[8]["from_dir"]) == ("MIT", "MIT", "e")


def test_inheritance_equals_brute_force(spark):
    rng = random.Random(8)
    dirs = ["", *{"/".join(rng.choices("abc", k=rng.randint(1, 5))) for _ in range(60)}, None]
    files = [(rng.choice(dirs), rng.choice(["MIT", "BSD", "GPL", None, None, None]), rng.choice([0.5, 0.7, 0.9])) for _ in range(150)]
    got = licenses.inherited(spark.createDataFrame(files, "dir string, file_license string, file_cosine double")).collect()
    held = {}
    for d, name, cosine in files:
        if d is not None and name:
            held[d] = min(held.get(d, (0, "")), (-cosine, name))
    want = set()
    for d in {d for d, _, _ in files if d is not None}:
        parts = d.split("/") if d else []
        above = ["/".join(parts[:k]) for k in range(len(parts), -1, -1)]
        near = next((a for a in above if a in held), None)
        if near is not None:
            want.add((d, held[near][1], near))
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_query_passes_a_licence_text_on_within_its_source(spark, folder):
    from municare.llm.queries import op9

    rows = [(1, "s", MIT), (2, "s", FILL), (3, "s", f"{FILL}\n{GPL_HEADER}\n{FILL}"), (4, "t", FILL), (5, None, FILL), (6, "", FILL), (7, None, MIT), (8, "s/t", FILL)]
    rows += [(100 + i, "u", f"{FILL} {i}") for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: (r.license, r.from_dir) for r in op9(spark, folder).filter("doc_id < 100").collect()}
    none = (None, None)
    assert got == {1: ("MIT", None), 2: ("MIT", "s"), 3: ("GPL-3.0", None), 4: none, 5: none, 6: none, 7: ("MIT", None), 8: ("MIT", "s")}
