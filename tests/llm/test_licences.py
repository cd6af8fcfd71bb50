import math
from collections import Counter

from harrow.llm.licences import TEMPLATES, Matcher, scan_licences, terms


def brute(files, threshold=0.6):
    n = len(files)
    docs = [set(terms(t)) for _, t in files]
    known = {t for _, text in TEMPLATES for t in terms(text)}
    idf = {t: math.log((1 + n) / (1 + sum(t in d for d in docs))) for t in known}

    def vec(text):
        return {t: c * idf.get(t, math.log(1 + n)) for t, c in Counter(terms(text)).items()}

    def cos(a, b):
        dot = sum(w * b.get(t, 0) for t, w in a.items())
        size = math.sqrt(sum(w * w for w in a.values()) * sum(w * w for w in b.values()))
        return dot / size if size else 0
    own = []
    for path, text in files:
        best = {}
        for unit in [*(text or "").split("\n"), text or ""]:
            for name, t in TEMPLATES:
                best[name] = max(best.get(name, 0), round(cos(vec(unit), vec(t)), 9))
        score, name = min((-s, k) for k, s in best.items())
        own.append((path, name if -score >= threshold else None, -score))
    places = {}
    for path, name, score in own:
        if path and name and path.split("/")[-1] in ("LICENSE", "COPYING"):
            d = path.rpartition("/")[0]
            places[d] = min(places.get(d, (9, "")), (-score, name))
    out = []
    for path, name, _ in own:
        got = name, None
        if name is None and path is not None:
            parts = path.rpartition("/")[0].split("/")
            for k in range(len(parts), 0, -1):
                d = "/".join(parts[:k])
                if d in places:
                    got = places[d][1], d
                    break
        out.append((path, name, *got))
    return out


FILES = [
    ("/a/LICENSE", "Some words\nLicensed under the Apache License, Version 2.0.\nmore"),
    ("/a/x.py", "nothing here"), ("/a/b/c/y.py", "# Released under the MIT License."),
    ("/a/b/c/z.py", None), ("/a/b/COPYING", "This work is licensed under the GNU General Public "
                            "License, version 3."),
    ("/a/b/LICENSE", "Licensed under CC BY-NC 4.0."), ("/ab/q.py", "is the of"), (None, "text"),
    (None, "Released under the MIT License."), ("plain", "x"), ("/top.txt", "y"),
    ("/a/b/c/z.py", None), ("/a/b/c/LICENSE", "no licence at all in this one"),
    ("/long/w.txt", "word " * 50000 + "\nReleased under the MIT License.\n" + "tail " * 9),
    ("LICENSE", "Released under the MIT License."), ("/a/b/", "")]


def test_matches_brute_force(spark):
    df = spark.createDataFrame(FILES, "path string, text string").selectExpr(
        "*", "1 as licence", "'q' as __dir")
    got = [(r.path, r.own_licence, r.licence, r.licence_from) for r in scan_licences(df).collect()]
    assert sorted(got, key=str) == sorted(brute(FILES), key=str)
    assert ("/a/b/c/z.py", None, "CC-BY-NC-4.0", "/a/b") in got or \
        ("/a/b/c/z.py", None, "GPL-3.0", "/a/b") in got


def test_templates_name_themselves():
    m = Matcher(1000, {"the": 900, "is": 800, "of": 850})
    for name, text in TEMPLATES:
        assert m.best(text, 0.99)[0] == name


def test_empty(spark):
    df = spark.createDataFrame([], "path string, text string")
    assert scan_licences(df).count() == 0
