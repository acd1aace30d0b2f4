"""Licence scan against a plain version in Python."""
import re

from custmaster.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def plain(text):
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    places, labels = [], set()
    for label, phrase in L.BASE_PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    norm = " " + " ".join(words) + " " if words else ""
    found = []
    for r in L.rules():
        if r["keyword"] in norm:
            for m in re.finditer(r["regex"], norm):
                start = norm[:m.start()].count(" ")
                found.append((start, -(start + m.group().count(" ")), r["priority"], r["rule"], r["label"], r["weight"]))
    kept = []
    for d in sorted(found):
        if not any(k[0] <= d[0] and k[1] <= d[1] and k[2] <= d[2] for k in kept_or_not(found, d)):
            kept.append(d)
    score = max([0.0] + [d[5] for d in kept] + ([L.BASE_WEIGHT] if labels else []))
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)), ",".join(sorted(labels | {d[4] for d in kept})), score)


def kept_or_not(found, d):
    return [x for x in sorted(found) if x < d]


TEXTS = [
    "Released under the MIT License.", "under the mit license under the mit license, UNDER THE MIT LICENSE!",
    "Licensed under the Apache License, Version 2.0.", "Apache License Version 2", "apache-license\nversion.2",
    "Licensed under CC BY-NC 4.0.", "cc by nc sa 4 0", "This work is licensed under the GNU General Public License, version 3.",
    "gnu general public license", "SPDX-License-Identifier: GPL-2.0-or-later", "see opensource.org/licenses/MIT for it",
    "mit einem Wort", "the mit licens", "MÍT License under the MIT License", "license " * 40, "BSD 3-Clause License and the BSD license",
    "licensed under the terms of the Mozilla Public License 2.0 or the Eclipse Public License",
]


def test_against_plain(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in L.digest(docs).collect()}
    for i, t in enumerate(TEXTS):
        assert got[i] == plain(t), t


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {r.doc_id: plain(r.text) for r in docs.collect()}
    assert {r[0]: tuple(r)[1:] for r in L.digest(docs).collect()} == want


def test_odd_rows(odd):
    got = sorted((tuple(r) for r in L.digest(odd).collect()), key=repr)
    assert got == sorted(((r.doc_id, *plain(r.text)) for r in odd.collect()), key=repr)
    assert L.scan(odd).columns == [*odd.columns, "license_scan"]


def test_empty_table(empty):
    assert L.digest(empty).count() == 0


def texts_of(regex):
    """Some texts that an expression covers: each alternative once, optional parts in and out."""
    import re._constants as c
    import re._parser as parser

    def walk(items, optional):
        out = [""]
        for op, arg in items:
            if op is c.LITERAL:
                more = [chr(arg)]
            elif op is c.IN:
                first = arg[0]
                more = [chr(first[1] if first[0] is c.LITERAL else first[1][0])]
            elif op is c.SUBPATTERN:
                more = walk(arg[3], optional)
            elif op is c.BRANCH:
                more = [t for branch in arg[1] for t in walk(branch, optional)]
            elif op is c.MAX_REPEAT:
                low, high, sub = arg
                more = [t * (max(low, 1) if optional else low) for t in walk(sub, optional)]
            else:
                assert op in (c.ASSERT, c.AT), op
                more = [""]
            out = [x + y for x in out for y in more]
        return out
    return {t for optional in (True, False) for t in walk(parser.parse(regex), optional)}


def test_gate_and_keywords_let_every_signature_through():
    """Checked on texts made from each expression, all alternatives."""
    for r in L.rules():
        assert len(r["keyword"].replace(" ", "")) > 2, r
        for t in texts_of(r["regex"]):
            t = f" {t.strip()} "
            assert re.search(r["regex"], t), (r, t)
            assert r["keyword"] in t, (r, t)
            assert any(g in t for g in L.GATE), (r, t)
    assert len(L.rules()) > 300 and len(L.WORDINGS.strip().splitlines()) > 50
    for phrase in L.BASE_PHRASES.values():
        assert any(g in phrase for g in L.GATE)


NOTICES = [
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
      associated documentation files (the "Software"), to deal in the Software without restriction, including"""),
    ("gpl-2", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General
      Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option)
      any later version."""),
    ("bsd-3", """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
      products derived from this software without specific prior written permission."""),
    ("bsd-2", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
      granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("zlib", "The origin of this software must not be misrepresented; you must not claim that you wrote the original software."),
    ("lgpl-2.1", """under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either
      version 2.1 of the License, or (at your option) any later version"""),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
]


def test_real_notices(spark):
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(NOTICES)], "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in L.digest(docs).collect()}
    for i, (label, t) in enumerate(NOTICES):
        assert got[i] == plain(t), t
        assert label in got[i][5].split(","), (label, got[i])


def test_spans_cover_the_words(spark):
    docs = spark.createDataFrame([(1, "It is licensed under the Apache License, Version 2.0 today")], "doc_id long, text string")
    (r,) = L.scan(docs).collect()
    (span,) = r.license_scan.spans                       # the bare title inside is suppressed
    assert (span.start, span.end, span.label) == (2, 10, "apache-2")
