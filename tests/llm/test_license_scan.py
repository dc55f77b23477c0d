import math
import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from webtrail.llm import license_scan as ls
from webtrail.llm.queries import op6_license_scan
from webtrail.llm.license_sql import LICENSE_SQL

MIT, GPL, CC = "Released under the MIT License.", ls.TEMPLATES[4][1], "Licensed under CC BY-NC 4.0"


def terms(text):
    return [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]


def brute(rows):
    """Own licence, cosine and line of each (id, path); licence files; inheritance."""
    vocab = {w for _, t in ls.TEMPLATES for w in terms(t)}
    df = Counter(w for _, _, t in rows for w in set(terms(t)) & vocab)
    idf = {w: math.log((len(rows) + 1) / (df[w] + 1)) + 1 for w in vocab}
    mean = sum(idf.values()) / len(idf)

    def vector(ws):
        return {w: n * idf.get(w, mean) for w, n in Counter(ws).items()}

    def norm(v):
        return math.sqrt(sum(x * x for x in v.values()))
    models = [(lic, vector(terms(t))) for lic, t in ls.TEMPLATES]
    own, licensed, words = {}, Counter(), Counter()
    for d, p, t in rows:
        words[d, p] += len(terms(t))
        own.setdefault((d, p), None)
        for i, line in enumerate((t or "").split("\n")):
            ws = terms(line)
            if len(set(ws) & vocab - ls.FUNCTION_WORDS) < 2:
                continue
            v = vector(ws)
            c, lic = min((-round(sum(x * m.get(w, 0) for w, x in v.items()) / norm(v) / norm(m), 6), lic) for lic, m in models)
            if -c >= ls.THRESHOLD:
                licensed[d, p] += len(ws)
                new = (c, lic, i)
                own[d, p] = min(own[d, p] or new, new)
    cover = {}
    for (d, p), o in own.items():
        if o and p is not None and (re.search(ls.LICENCE_NAME, p.split("/")[-1].lower())
                                    or licensed[d, p] >= ls.FILE_SHARE * words[d, p]):
            folder = "/".join(p.split("/")[:-1])
            cover[folder] = min(cover.get(folder, (9, "", "")), (o[0], p, o[1]))
    out = set()
    for (d, p), o in own.items():
        inherited = (None, None)
        if not o and p is not None:
            parts = p.split("/")[:-1]
            for k in range(len(parts), -1, -1):
                if "/".join(parts[:k]) in cover:
                    inherited = (cover["/".join(parts[:k])][2], "/".join(parts[:k]))
                    break
        out.add((d, p, *((o[1], -o[0], o[2]) if o else (None, None, None)), *inherited, o[1] if o else inherited[0]))
    return out


ROWS = [(1, "a/LICENSE", "Some project.\n\n" + MIT + "\n" + "x " * 300), (2, "a/b/c/x.py", "code here"), (3, "a/b/COPYING.txt", GPL),
        (4, "a/b/c/y.py", "# " + CC + "\ncode"), (5, "z/q.py", None), (6, None, MIT), (7, "top.py", ""),
        (8, "c/d/notes.txt", "long text " * 50 + "\n" + MIT + "\nreleased under nothing"), (9, "c/d/e.py", "plain"),
        (10, "f/README", MIT + "\nshort"), (11, "f/g/h.py", "the the of"), (12, "f/g/h2.py", "word " * 60000),
        (None, "f/k.py", "null id"), (2, "a/b/c/x.py", "code here"), (13, "LICENSE.md", CC), (14, "a/LICENSE2", CC),
        (15, "/abs/file", "text"), (16, "a/b/", "in a folder of no name")]


def test_against_brute_force(spark):
    files = spark.createDataFrame(ROWS, "doc_id long, path string, text string").repartition(3).withColumns(
        {"license": F.lit("x"), "term": F.lit(1), "t": F.lit(2), "id": F.lit(3)})
    got = ls.scan(files, "doc_id", "path", "text").collect()
    have = {(r.doc_id, r.path, r.own_license, r.own_cosine, r.own_line, r.inherited_license, r.inherited_from, r.license)
            for r in got}
    assert len(got) == len(have) == len({r[:2] for r in ROWS})
    assert have == brute(ROWS)
    assert {r.doc_id: r.license for r in got}[2] == "CC-BY-NC-4.0" and {r.doc_id: r.license for r in got}[9] == "CC-BY-NC-4.0"


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    got = op6_license_scan(spark, sf)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.sql(LICENSE_SQL)
    assert sorted(got.columns) == sorted(want.columns)
    names = sorted(got.columns)
    key = lambda rows: sorted((tuple(r) for r in rows), key=str)
    assert key(got.select(names).collect()) == key(want.select(*names).fetchall())


def test_empty_table(spark):
    assert ls.scan(spark.createDataFrame([], "doc_id long, path string, text string"), "doc_id", "path", "text").collect() == []
