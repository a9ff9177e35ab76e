import textwrap

import duckdb

from rentgrid.llm import licenses as ls
from rentgrid.llm import oracle

from .conftest import ALNUM, words


def dice(own, other):
    return 2 * len(own & other) / (len(own) + len(other)) if own else 0


def brute(text):
    sets = {n: {*zip(w, w[1:])} for n, t in ls.TEMPLATES.items() for w in [words(t, ALNUM)]}
    out = []
    for k, part in [*enumerate((text or "").split("\n")), (-1, text)]:
        w = words(part, ALNUM)
        own = {*zip(w, w[1:])}
        out += [(k, k, n, round(dice(own, other), 9)) for n, other in sets.items() if dice(own, other) >= ls.THRESHOLD]
    lines = [(k, w) for k, part in enumerate((text or "").split("\n")) for w in words(part, ALNUM)]
    pairs = [(a[1], b[1]) for a, b in zip(lines, lines[1:])]
    for name, other in sets.items():
        size = len(words(ls.TEMPLATES[name], ALNUM)) - 1
        if not other & set(pairs):
            continue
        found = [(s, dice({*pairs[s : s + size]}, other)) for s in range(len(pairs) - size + 1)]
        places, last = [], None
        for s, d in found:
            if d >= ls.THRESHOLD:
                places = [*places, []] if last is None or s - last >= size else places
                places[-1].append((-d, s))
                last = s
        for d, s in map(min, places):
            if lines[s][0] < lines[s + size][0]:
                out.append((lines[s][0], lines[s + size][0], name, round(-d, 9)))
    return sorted(out)


def wrapped(text, width=72, mark=""):
    return "\n".join(mark + line for line in textwrap.wrap(text, width))


PROSE = "\n".join(f"line {i} of the file and the software that is in the file {i * 7 % 13}" for i in range(40))
HEADERS = [
    wrapped(ls.TEMPLATES["MIT-grant"]) + "\n" + PROSE, PROSE + "\n" + wrapped(ls.TEMPLATES["Apache-2.0-header"], 50, "# ") + "\n" + PROSE,
    PROSE + wrapped(ls.TEMPLATES["MIT-full"], 60, " * ") + PROSE, wrapped(ls.TEMPLATES["BSD-3-Clause"], 79, "// ").replace("HOLDER", "OWNER"),
    "\n".join([wrapped(ls.TEMPLATES["ISC"])] * 3), "x\n" + wrapped(ls.TEMPLATES["GPL-3.0"], 20) + "\n" + PROSE + "\n" + ls.TEMPLATES["GPL-3.0"],
]
TEXTS = [
    "Intro line\nlicensed UNDER the apache license, version 2.0\nmore", ls.TEMPLATES["MIT-grant"],
    ls.TEMPLATES["GPL-3.0-notice"].replace(" and", "\nand"), "the License the License", "Released under the MIT License. Extra",
    "of the Software\n\nof the\nMIT", "\n".join(ls.TEMPLATES.values()), "Licensed", "x\n" * 50 + ls.TEMPLATES["CC-BY-NC-4.0"],
]


def test_against_brute_force(spark, documents, nothing):
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate([*TEXTS, *HEADERS])], "doc_id long, text string")
    df = documents.unionByName(more, allowMissingColumns=True)
    want = sorted((repr(r.doc_id), brute(r.text)) for r in df.collect())
    got = ls.licenses(df).collect()
    assert sorted((repr(r.row.doc_id), [(x.line, x.last_line, x.license, round(x.dice, 9)) for x in r.found]) for r in got) == want
    assert any(found for _, found in want)
    assert ls.licenses(nothing).count() == 0


def test_wrapped_and_commented_notices_are_found(spark):
    df = spark.createDataFrame(list(enumerate(HEADERS)), "doc_id long, text string")
    found = {r.row.doc_id: {(x.license, x.line < x.last_line) for x in r.found} for r in ls.licenses(df).collect()}
    for i, name in enumerate(("MIT-grant", "Apache-2.0-header", "MIT-full", "BSD-3-Clause", "ISC", "GPL-3.0")):
        assert (name, True) in found[i]
    assert ls.licenses(spark.createDataFrame([(1, PROSE)], "doc_id long, text string")).first().found == []


def test_sql_finds_the_same_windows(spark):
    rows = list(enumerate([*TEXTS, *HEADERS]))
    found = ls.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    with duckdb.connect() as db:
        db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
        db.executemany("INSERT INTO documents VALUES (?, ?)", rows)
        want = db.execute(oracle.licensed(ls.TEMPLATES, ls.THRESHOLD)).fetchall()
    got = [
        (r.row.doc_id, len(r.found), ",".join(sorted({x.license for x in r.found})), max((round(x.dice, 6) for x in r.found), default=None))
        for r in found
    ]
    assert sorted(got) == sorted(want)
