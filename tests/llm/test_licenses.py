"""The licence scan against a canonicaliser in plain Python."""

import hashlib
import re

from scrutin.llm import licenses
from scrutin.llm.license_texts import SPELLINGS, TEXTS, TITLES

CLAIM = re.compile(r"[\W_]*(copyright\b\s*(\(c\)|©|\d{4}|by\b|[\[{<]\s*(yyyy|year)\b)|\(c\)\s*\d{4}|©|all rights reserved)")


def line_of(line):
    return " ".join(SPELLINGS.get(w, w) for w in re.sub(r"[\W_]+", " ", line.lower()).split())


HEADS = {line_of(t) for t in TITLES}


def brute(text):
    lines = [line_of(x) for x in (text or "").split("\n") if not CLAIM.match(x.lower())]
    lines = [x for x in lines if x]
    while lines and lines[0] in HEADS:
        del lines[0]
    return " ".join(lines)


def test_entire_texts_with_any_heading(spark):
    digest = lambda t: hashlib.sha256(brute(t).encode()).hexdigest()
    known = {digest(t): name for name, texts in TEXTS.items() for t in texts}
    plain = {name: texts[0] for name, texts in TEXTS.items()}
    mit = plain["MIT"].split("\n", 2)[2]
    docs = [t for texts in TEXTS.values() for t in texts]
    docs += [re.sub(r"\blicense\b", "licence", t.replace("http:", "https:")).upper() for t in plain.values()]
    docs += [f"{h}\n\nCopyright (c) 2020 A B\n\n{mit}" for h in ("The MIT License (MIT)", "# The MIT Licence", "MIT", "License\n---\nMIT License")]
    docs += [mit, "BSD 2-Clause License\n\n" + plain["BSD-2-Clause"], '* BSD 3-Clause "New" or "Revised" License\n' + plain["BSD-3-Clause"]]
    docs += [plain["Apache-2.0"].replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2021 Someone")]
    docs += [" ".join(mit.split()), mit.replace(" ", "\n")]
    whole = len(docs)
    docs += [None, "", "MIT License", "MIT License\n\nThe MIT License", mit + " And more.", "Words\nMIT License\n" + mit, "Copyright 2001 X"]
    rows = spark.createDataFrame(list(enumerate(docs)), "i int, t string").repartition(3)
    got = {r.i: r for r in licenses.scan(rows, "t").collect()}
    for i, t in enumerate(docs):
        assert got[i].license_words == len(brute(t).split()), (i, t and t[:80])
        assert got[i].license_id == known.get(digest(t)), (i, t and t[:80])
        assert (got[i].license_id is not None) == (i < whole), (i, t and t[:80])
    assert {got[i].license_id for i in range(whole)} == set(TEXTS) >= {"Apache-2.0", "BSD-3-Clause", "GPL-3.0-only", "LGPL-2.1-only", "MPL-2.0"}


def test_other_tables(spark):
    rows = spark.createDataFrame([("One two",), ("Head\nx y z",), ("x y z\nSay so",)], "t string")
    got = licenses.scan(rows, "t", {"A": "head\nx y z"}, {"Say so.": "B"}, ["HEAD"]).collect()
    assert [(r.license_words, r.license_id, r.license_notices) for r in got] == [(2, None, []), (3, "A", []), (5, None, ["B"])]
    assert licenses.scan(rows, "t", {"A": "x y z"}, {}, []).filter("license_id = 'A'").count() == 0
