import math
import re
import textwrap
from collections import defaultdict
from importlib import resources

from lakecat.llm.licences import LEAST_COSINE, LICENCE_FILE, NOTICES, scan

TERM = re.compile(r"[a-z0-9]+(?:[.+-][a-z0-9]+)*")
FILES = [
    ("a/LICENSE", "MIT\nReleased under the MIT License.\n"), ("a/x.txt", "nothing here"), ("a/b/y.txt", ""),
    ("a/b/c/z.txt", "Text.\nLicensed under the Apache License, Version 2.0.\nMore"), ("a/b/c/LICENSE", "no notice at all"),
    ("a/b/d/COPYING.md", "This work is licensed under the GNU General Public License, version 3"), ("a/b/d/e/f.txt", None),
    ("top.txt", "the public license of the work"), (None, "Licensed under CC BY-NC 4.0."), (None, "x"), ("ab/q.txt", "q"),
    ("a/x.txt", "nothing here"), ("twice/LICENSE", "Licensed under CC BY 4.0.\nLicensed under CC BY 4.0."),
    ("twice/COPYING", "Released under the MIT License."), ("twice/t.txt", "long " * 60_000),
    ("none/n.txt", "Licensed under something else by someone else in another way, version 7.0"),
]


def best_by_brute_force(files):
    vocabulary = {t for notice in NOTICES.values() for t in TERM.findall(notice.lower())}
    count = defaultdict(int)
    for _, text in files:
        for term in set(TERM.findall((text or "").lower())) & vocabulary:
            count[term] += 1

    def weight(term):
        return math.log((1 + len(files)) / (1 + (count[term] if term in vocabulary else 1))) + 1

    best = {}
    for path, text in files:
        for line in (text or "").split("\n"):
            line_terms = set(TERM.findall(line.lower()))
            for name, notice in NOTICES.items():
                own = set(TERM.findall(notice.lower()))
                norm = math.sqrt(sum(weight(t) ** 2 for t in own) * sum(weight(t) ** 2 for t in line_terms))
                score = round(sum(weight(t) ** 2 for t in own & line_terms) / norm, 9) if norm else 0
                if score >= LEAST_COSINE and (path not in best or (-score, name) < best[path]):
                    best[path] = (-score, name)
    return best


def expected(files):
    best, licensed = best_by_brute_force(files), {}
    for path in sorted(filter(None, best)):
        folder, _, name = path.rpartition("/")
        if re.match(LICENCE_FILE, name) and (folder not in licensed or best[path][0] < best[licensed[folder]][0]):
            licensed[folder] = path
    out = []
    for path, _ in files:
        origin = path if path in best else None
        if path is not None and path not in best:
            folder = path.rpartition("/")[0]
            while folder and folder not in licensed:
                folder = folder.rpartition("/")[0]
            origin = licensed.get(folder)
        if path in best:
            out.append((path, best[path][1], -best[path][0], path, "own"))
        else:
            out.append((path, best[origin][1], -best[origin][0], origin, "inherited") if origin else (path, None, None, None, None))
    return sorted(out, key=str)


def test_files(spark):
    df = spark.createDataFrame([(*f, 1) for f in FILES], "path string, text string, score int")
    got = [(r[0], r[1], r[2] and round(r[2], 6), r[3], r[4]) for r in scan(df).collect()]
    wanted = [(r[0], r[1], r[2] and round(r[2], 6), r[3], r[4]) for r in expected(FILES)]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert ("a/b/d/e/f.txt", "GPL-3.0") in {r[:2] for r in got} and ("a/x.txt", "MIT") in {r[:2] for r in got}


def test_empty(spark):
    assert scan(spark.createDataFrame([], "path string, text string")).count() == 0


def test_whole_texts_headers_and_tags(spark):
    from lakecat.llm import licences

    folder = resources.files(licences.__package__).joinpath("licence_texts")
    texts = {f.name.removesuffix(".txt"): f.read_text() for f in folder.iterdir()}
    files, wanted = [], {}
    for name, text in texts.items():
        files.append((f"{name}/LICENSE", f"Some title\n\nCopyright (c) 2020 Jane Roe\n\n{text}"))
        files.append((f"{name}/a/b.txt", "nothing"))
        wanted |= {f"{name}/LICENSE": name, f"{name}/a/b.txt": name}
    for name, text in licences.HEADERS.items():
        body = "\n".join(f"#  {line}" for line in textwrap.wrap(" ".join(text.split()), 60))
        code = "\n".join(f"value_{i} = compute_{i}(other_{i})" for i in range(200))
        files.append((f"headers/{name}.py", f"# Copyright 2021 Somebody\n#\n{body}\n#\n\n{code}"))
        wanted[f"headers/{name}.py"] = name
    tags = {"MIT": "MIT", "GPL-2.0-or-later": "GPL-2.0", "LGPL-2.1+": "LGPL-2.1", "(MIT OR Apache-2.0)": "(MIT OR Apache-2.0)"}
    for i, (tag, name) in enumerate(tags.items()):
        files.append((f"tags/{i}.c", f"/* SPDX-License-Identifier: {tag} */\nint x;"))
        wanted[f"tags/{i}.c"] = name
    files += [(f"plain/{i}.txt", f"Text {i} of the public, without any such thing as software.") for i in range(300)]
    got = {r["path"]: r["licence"] for r in scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert {path: got[path] for path in wanted} == wanted
    assert {licence for path, licence in got.items() if path.startswith("plain/")} == {None}


def test_most_files_of_the_query_inherit_from_three_depths(spark):
    from lakecat.llm.queries import QUERIES

    rows = QUERIES["op5_licences"](spark, "/root/testdata/sf0.01").collect()
    inherited = [r for r in rows if r["by"] == "inherited"]
    assert len(inherited) > len(rows) / 2 and {r["origin"].count("/") for r in inherited} == {1, 2, 3}
    own = {}
    for r in rows:  # by brute force over the licence files found
        if r["by"] == "own" and "/LICENSE-" in r["path"]:
            at = r["path"].rpartition("/")[0]
            own[at] = min(own.get(at, (0, "", "")), (-r["score"], r["path"], r["licence"]))
    for r in rows:
        if r["by"] != "own":
            parts = r["path"].split("/")[:-1]
            held = [own["/".join(parts[:n])] for n in range(len(parts), 0, -1) if "/".join(parts[:n]) in own]
            assert (r["licence"], r["origin"]) == ((held[0][2], held[0][1]) if held else (None, None))
