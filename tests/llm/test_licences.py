import pytest
from helpers import no_documents, odd_documents, plain, prose
from pyspark.sql import functions as F

from aferir.llm import licences

SCHEMA = "doc_id long, path string, text string, dir string, score double"


def report(spark, rows):
    docs = spark.createDataFrame([(*row, "d", 1.0) for row in rows], SCHEMA)
    return {r["doc_id"]: (r["licence"], r["source"], r["licence_dir"]) for r in licences.licence_report(docs).collect()}


@pytest.mark.parametrize("name", sorted(licences.NOTICES))
def test_every_notice_is_told_apart(spark, name):
    rows = [(i, f"a/{i}", prose(i, 40), "d", 1.0) for i in range(30)]
    rows.append((99, "a/99", f"{prose(50, 30)}.\n{licences.NOTICES[name]}\n{prose(51, 30)}", "d", 1.0))
    found = licences.licence_report(spark.createDataFrame(rows, SCHEMA)).where("licence is not null").collect()
    assert [(r["doc_id"], r["licence"], r["source"]) for r in found] == [(99, name, "own")]


def test_nearest_directory_wins(spark):
    body, mit, gpl = prose(1, 40), licences.NOTICES["mit"], licences.NOTICES["gpl-3.0"]
    got = report(
        spark,
        [
            (1, "LICENSE", f"{mit} {body}"),
            (2, "src/a.txt", body),
            (3, "src/lib/COPYING.txt", f"{gpl}\n{body}"),
            (4, "src/lib/deep/er/b.txt", body),
            (5, "src/lib/c.txt", f"{body}\n{mit}"),
            (6, "src/library/d.txt", body),
            (7, "top.txt", body),
            (8, "/other/e.txt", mit),
            (9, "other/f/g.txt", body),
        ],
    )
    assert got[2] == ("mit", "inherited", "") and got[7] == ("mit", "inherited", "")
    assert got[4] == ("gpl-3.0", "inherited", "src/lib") and got[6] == ("mit", "inherited", "")
    assert got[5] == ("mit", "own", None) and got[3] == ("gpl-3.0", "own", None)
    assert got[8] == ("mit", "own", None) and got[9] == ("mit", "inherited", "other")


def test_telling_words_bound_the_rest():
    idf, vectors = licences.notice_vectors(1000, {"the": 900, "license": 5, "under": 300})
    telling = set(licences.telling_words(idf, vectors))
    for vector in vectors.values():
        assert sum(w * w for word, w in vector.items() if word not in telling) < licences.SIMILARITY**2
        assert sum(w * w for w in vector.values()) == pytest.approx(1)


def test_odd_rows(spark):
    docs = odd_documents(spark, [licences.NOTICES["isc"], licences.NOTICES["isc"]]).withColumn("path", F.lit(None).cast("string"))
    got = licences.licence_report(docs)
    assert got.count() == docs.count()
    assert {r["licence"] for r in got.collect()} == {"isc"}  # one root directory
    assert plain(licences.licence_report(no_documents(spark).withColumn("path", F.lit("x")))) == []


WRAPPED = {
    "spdx": ("// SPDX-License-Identifier: MIT", "mit"),
    "spdx unknown": ("# SPDX-License-Identifier: XYZ-1.0", None),
    "gpl": (
        "/*\n * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General"
        " Public License as published by\n * the Free Software Foundation, either version 3 of the License, or\n * (at your option)"
        " any later version.\n *\n * This program is distributed in the hope that it will be useful.\n */",
        "gpl-3.0",
    ),
    "gpl 2": ("This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as"
              " published by the Free Software\nFoundation; either version 2 of the License, or (at your option) any later version.", "gpl-2.0"),
    "bsd": ("# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the"
            " following conditions are met:\n#\n# * Redistributions of source code must retain the notice.", "bsd-2-clause"),
    "mit": ('Permission is hereby granted, free of charge, to any person obtaining a copy of this software and\nassociated documentation'
            ' files (the "Software"), to deal in the Software without restriction,\nincluding without limitation the rights to use, copy,'
            " modify, merge, publish, distribute,\nsublicense, and/or sell copies of the Software, and to permit persons to whom the"
            " Software is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice shall be included.", "mit"),
    "apache": ('# Licensed under the Apache License, Version 2.0 (the "License");\n# you may not use this file except in compliance with the License.', "apache-2.0"),
    "talk": ("We talked about the general idea of a public library and its licence to lend.", None),
}


def test_headers_and_licence_files(spark):
    rows = [(i, f"a/{i}", prose(i, 40), "d", 1.0) for i in range(30)]
    rows += [(100 + i, f"b{i}/f", f"{text}\n\n{prose(60 + i, 200)}", "d", 1.0) for i, (text, _) in enumerate(WRAPPED.values())]
    found = {r["doc_id"]: r["licence"] for r in licences.licence_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {name: found[100 + i] for i, name in enumerate(WRAPPED)} == {name: licence for name, (_, licence) in WRAPPED.items()}
    assert not any(found[i] for i in range(30))


def test_statements_against_brute_force(spark):
    import math
    from collections import Counter

    texts = [prose(i, 30) + ". " + prose(i + 40, 8) for i in range(40)]
    texts += [f"{prose(7, 20)}.\n{licences.NOTICES[n]} {prose(8, 9)}." for n in sorted(licences.NOTICES)]
    texts += [f"Released under the {w} License." for w in ("MIT", "ISC", "BSD 2-Clause", "Nobody")] + [text for text, _ in WRAPPED.values()]
    docs = spark.createDataFrame([(i, "p", t, "d", 1.0) for i, t in enumerate(texts)], SCHEMA).selectExpr("doc_id", "text", "xxhash64(text) AS text_hash")
    got = {(r.doc_id, r.place): (r.licence, r.score, r.n_words) for r in licences.statements(docs).collect()}
    df = Counter(word for t in texts for word in set(licences.split_words(t)))
    weight = lambda words: {w: n * (math.log((len(texts) + 1) / (df[w] + 1)) + 1) for w, n in Counter(words).items()}
    templates = [weight(licences.split_words(t)) for _, t in licences.TEMPLATES]
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    units = docs.select("doc_id", licences.sentences(F.col("text")).alias("u")).collect()
    best = {}
    for row in units:
        for unit in row.u:
            v = weight(licences.split_words(unit))
            if not v:
                continue
            scores = [round(sum(x * t.get(w, 0) for w, x in v.items()) / norm(v) / norm(t), 6) for t in templates]
            if max(scores) >= licences.SIMILARITY:
                best.setdefault(row.doc_id, []).append((licences.TEMPLATES[scores.index(max(scores))][0], pytest.approx(max(scores), abs=2e-6), len(licences.split_words(unit))))
    ours = {}
    for (doc, _), value in sorted(got.items()):
        ours.setdefault(doc, []).append(value)
    assert ours == best and len(best) > 20
