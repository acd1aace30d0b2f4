"""Licence scan by ordered signature rules [DataFrame functions only].

A text is lower-cased (A-Z) and read as words, runs of ASCII letters, digits
and non-ASCII characters; ``norm`` is these words with one space on either
side of each.  Signatures are of two kinds: what a licence is called (title, identifier,
address, grant; ``LICENSES``) and what its text and its notices say (``WORDINGS``).  Every
signature is a regular expression over ``norm``, gated by
a keyword: a document runs only the expressions whose keyword it contains, and
only documents that pass one coarse expression are looked at at all.  A
detection is the interval of words a signature covers.  Detections are swept
from left to right, longer ones first; one that lies inside an earlier one of
the same or a better priority is suppressed, so that a bare title inside a
grant sentence, or a family name inside a versioned one, does not count twice.

Everything stays within the document's own row: no shuffle, and a hot source
costs no more than its share.  Null text reads as empty: no words, no labels.
Very long texts are scanned whole.  Detections that begin and end alike go by
priority, then by rule number.  Repeated rows each give their own result, an empty
table none; other columns of the input are not touched, whatever their names.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custmaster.llm.common import free_name, text_or_empty

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: what separates words, upper case still allowed inside them
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Phrases that label a document wherever their words stand consecutively.
BASE_PHRASES = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}

#: One line a licence: label; its title as an expression over words; the keyword that the
#: title cannot do without; its SPDX identifier in words; a distinctive part of its address.
LICENSES = """
mit | (?:mit|expat) licen[cs]e | licen | mit | opensource org licenses mit
mit-0 | mit no attribution(?: licen[cs]e)? | no attribution | mit 0 | opensource org license mit 0
apache-1.1 | apache (?:software )?licen[cs]e v(?:ersion )?1 1 | apache | apache 1 1 | apache org licenses license 1 1
apache-2 | apache(?: software)? licen[cs]e(?: v(?:ersion )?)? ?2(?: 0)? | apache | apache 2 0 | apache org licenses license 2 0
gpl-1 | gnu (?:general public licen[cs]e|gpl) v(?:ersion )?1 | gnu | gpl 1 0(?: only| or later)? | gnu org licenses gpl 1 0
gpl-2 | gnu (?:general public licen[cs]e|gpl) v(?:ersion )?2 | gnu | gpl 2 0(?: only| or later)? | gnu org licenses gpl 2 0
gpl-3 | gnu (?:general public licen[cs]e|gpl) v(?:ersion )?3 | gnu | gpl 3 0(?: only| or later)? | gnu org licenses gpl 3 0
gpl | gnu (?:general public licen[cs]e|gpl) | gnu | gpl | gnu org licenses gpl
lgpl-2 | gnu (?:library|lesser) general public licen[cs]e v(?:ersion )?2(?: 0)? | gnu | lgpl 2 0(?: only| or later)? | gnu org licenses lgpl 2 0
lgpl-2.1 | gnu lesser general public licen[cs]e v(?:ersion )?2 1 | gnu | lgpl 2 1(?: only| or later)? | gnu org licenses lgpl 2 1
lgpl-3 | gnu lesser general public licen[cs]e v(?:ersion )?3 | gnu | lgpl 3 0(?: only| or later)? | gnu org licenses lgpl 3 0
agpl-3 | gnu affero general public licen[cs]e(?: v(?:ersion )?3)? | affero | agpl 3 0(?: only| or later)? | gnu org licenses agpl 3 0
gfdl | gnu free documentation licen[cs]e | documentation | gfdl 1 [123](?: only| or later)? | gnu org licenses fdl
bsd-1 | bsd 1 clause(?: licen[cs]e)? | clause | bsd 1 clause | opensource org license bsd 1 clause
bsd-2 | (?:bsd 2 clause|simplified bsd|freebsd)(?: licen[cs]e)? | bsd | bsd 2 clause | opensource org licenses bsd 2 clause
bsd-3 | (?:bsd 3 clause|(?:new|revised|modified) bsd)(?: licen[cs]e)? | bsd | bsd 3 clause | opensource org licenses bsd 3 clause
bsd-4 | (?:bsd 4 clause|original bsd)(?: licen[cs]e)? | bsd | bsd 4 clause | spdx org licenses bsd 4 clause
bsd-0 | (?:zero clause bsd|bsd 0 clause|0bsd)(?: licen[cs]e)? | bsd | 0bsd | opensource org license 0bsd
bsd | bsd licen[cs]e | bsd | bsd | opensource org licenses bsd license
mpl-1.1 | mozilla public licen[cs]e v(?:ersion )?1 1 | mozilla | mpl 1 1 | mozilla org mpl 1 1
mpl-2 | mozilla public licen[cs]e(?: v(?:ersion )?2(?: 0)?)? | mozilla | mpl 2 0 | mozilla org mpl 2 0
epl-1 | eclipse public licen[cs]e v(?:ersion )?1(?: 0)? | eclipse | epl 1 0 | eclipse org legal epl v10
epl-2 | eclipse public licen[cs]e(?: v(?:ersion )?2(?: 0)?)? | eclipse | epl 2 0 | eclipse org legal epl 2 0
edl | eclipse distribution licen[cs]e | eclipse | bsd 3 clause edl | eclipse org org documents edl
cddl-1 | common development and distribution licen[cs]e | distribution | cddl 1 [01] | opensource org licenses cddl
cpl-1 | common public licen[cs]e v(?:ersion )?1(?: 0)? | public | cpl 1 0 | opensource org licenses cpl1
isc | isc licen[cs]e | isc | isc | opensource org licenses isc
zlib | zlib(?: libpng)? licen[cs]e | zlib | zlib | opensource org licenses zlib
libpng | libpng licen[cs]e | libpng | libpng(?: 2 0)? | libpng org pub png src libpng license
bsl-1 | boost software licen[cs]e | boost | bsl 1 0 | boost org license 1 0
unlicense | (?:the )?unlicense | unlicense | unlicense | unlicense org
wtfpl | do what the fuck you want to public licen[cs]e | want | wtfpl | wtfpl net
artistic-1 | artistic licen[cs]e(?: 1 0)? | artistic | artistic 1 0 | opensource org licenses artistic license 1
artistic-2 | artistic licen[cs]e(?: version)? 2(?: 0)? | artistic | artistic 2 0 | opensource org licenses artistic license 2
afl-3 | academic free licen[cs]e | academic | afl 3 0 | opensource org licenses afl 3
osl-3 | open software licen[cs]e | open software | osl 3 0 | opensource org licenses osl 3
eupl-1.1 | european union public licen[cs]e v(?:ersion )?1 1 | european union | eupl 1 1 | ec europa eu idabc eupl
eupl-1.2 | european union public licen[cs]e(?: v(?:ersion )?1 2)? | european union | eupl 1 2 | joinup ec europa eu collection eupl
ms-pl | microsoft public licen[cs]e | microsoft | ms pl | opensource org licenses ms pl
ms-rl | microsoft reciprocal licen[cs]e | microsoft | ms rl | opensource org licenses ms rl
python-2 | python software foundation licen[cs]e | python | (?:python|psf) 2 0 | docs python org license
ruby | ruby licen[cs]e | ruby | ruby | ruby lang org en about license
php-3 | php licen[cs]e | php | php 3 01? | php net license
perl | (?:same terms as|licen[cs]ed like) perl(?: itself)? | perl | artistic 1 0 perl | dev perl org licenses
openssl | openssl licen[cs]e | openssl | openssl | openssl org source license
curl | curl licen[cs]e | curl | curl | curl se docs copyright
postgresql | postgresql licen[cs]e | postgresql | postgresql | opensource org licenses postgresql
ncsa | (?:university of illinois )?ncsa(?: open source)? licen[cs]e | ncsa | ncsa | opensource org licenses ncsa
upl-1 | universal permissive licen[cs]e | permissive | upl 1 0 | opensource org licenses upl
ofl-1.1 | sil open font licen[cs]e | font | ofl 1 1 | scripts sil org ofl
ijg | independent jpeg group licen[cs]e | jpeg | ijg | ijg org license
w3c | w3c software(?: notice and)? licen[cs]e | w3c | w3c | w3 org consortium legal
odbl-1 | open (?:data commons open )?database licen[cs]e | database | odbl 1 0 | opendatacommons org licenses odbl
odc-by | open data commons attribution licen[cs]e | data commons | odc by 1 0 | opendatacommons org licenses by
pddl-1 | public domain dedication and licen[cs]e | dedication | pddl 1 0 | opendatacommons org licenses pddl
cc0-1 | cc0(?: 1 0)?(?: universal)? | cc0 | cc0 1 0 | creativecommons org publicdomain zero
cc-by | cc by [1234] [05] | cc by | cc by [1234] [05] | creativecommons org licenses by
cc-by-sa | cc by sa(?: [1234] [05])? | cc by | cc by sa [1234] [05] | creativecommons org licenses by sa
cc-by-nd | cc by nd(?: [1234] [05])? | cc by | cc by nd [1234] [05] | creativecommons org licenses by nd
cc-by-nc | cc by nc(?: [1234] [05])? | cc by | cc by nc [1234] [05] | creativecommons org licenses by nc
cc-by-nc-sa | cc by nc sa(?: [1234] [05])? | cc by | cc by nc sa [1234] [05] | creativecommons org licenses by nc sa
cc-by-nc-nd | cc by nc nd(?: [1234] [05])? | cc by | cc by nc nd [1234] [05] | creativecommons org licenses by nc nd
bsl-1.1 | business source licen[cs]e | business | busl 1 1 | mariadb com bsl11
sspl-1 | server side public licen[cs]e | server side | sspl 1 0 | mongodb com licensing server side
elastic-2 | elastic licen[cs]e(?: 2 0)? | elastic | elastic 2 0 | elastic co licensing elastic license
openrail | (?:creativeml |bigscience )?open ?rail(?: m)?(?: licen[cs]e)? | rail | (?:creativeml )?openrail(?: m)? | licenses ai
llama-2 | llama [23] community licen[cs]e | llama | llama2 | ai meta com llama license
"""

#: Signatures of a licence's own wording and of the notices that grant it, written one by one:
#: label; keyword; expression over words.
WORDINGS = """
mit | hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction
mit | merge publish | to use copy modify merge publish distribute sublicense and or sell copies of the software
mit | noninfringement | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement
mit | permission notice | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit-0 | hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided
isc | and or distribute | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
isc | tortious action | whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software
bsd-0 | and or distribute | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
apache-2 | except in compliance | you may not use this (?:file|work|software) except in compliance with the licen[cs]e
apache-2 | required by applicable | unless required by applicable law or agreed to in writing software distributed under the licen[cs]e is distributed on an as is basis
apache-2 | asf under one | licensed to the apache software foundation asf under one or more contributor licen[cs]e agreements
apache-2 | conditions for use | terms and conditions for use reproduction and distribution
gpl-2 | at your option | gnu general public licen[cs]e as published by the free software foundation either version 2 of the licen[cs]e or at your option any later version
gpl-2 | published by the free | gnu general public licen[cs]e version 2(?: only)? as published by the free software foundation
gpl-2 | june 1991 | gnu general public licen[cs]e version 2 june 1991
gpl-3 | at your option | gnu general public licen[cs]e as published by the free software foundation either version 3 of the licen[cs]e or at your option any later version
gpl-3 | june 2007 | gnu general public licen[cs]e version 3 29 june 2007
gpl | useful but without | this (?:program|library|software) is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability
gpl | free software you | (?:this program|it|this) is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e
lgpl-2.1 | at your option | gnu lesser general public licen[cs]e as published by the free software foundation either version 2 1 of the licen[cs]e or at your option any later version
lgpl-2 | at your option | gnu (?:library|lesser) general public licen[cs]e as published by the free software foundation either version 2 of the licen[cs]e or at your option any later version
lgpl-3 | at your option | gnu lesser general public licen[cs]e as published by the free software foundation either version 3 of the licen[cs]e or at your option any later version
agpl-3 | at your option | gnu affero general public licen[cs]e as published by the free software foundation either version 3 of the licen[cs]e or at your option any later version
agpl-3 | remotely through | interacting with it remotely through a computer network
agpl-3 | remote network | remote network interaction use with the gnu general public licen[cs]e
bsd-2 | source and binary | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd-3 | endorse or promote | neither the name of (?:the )?(?:[a-z0-9]+ ){1,12}may be used to endorse or promote products derived from this software without specific prior written permission
bsd-4 | advertising materials | all advertising materials mentioning features or use of this software must display the following acknowledg?ement
bsd | and contributors as is | this software is provided by (?:the )?(?:[a-z0-9]+ ){1,8}and contributors as is and any express or implied warranties
mpl-2 | subject to the terms | this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0
mpl-2 | was not distributed | if a copy of the mpl was not distributed with this file you can obtain one at
mpl-1.1 | subject to the mozilla | the contents of this file are subject to the mozilla public licen[cs]e version 1 1
epl-2 | accompanying materials | this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e(?: v ?| version )2 0
epl-1 | accompanying materials | this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e(?: v ?| version )1 0
zlib | must not be misrepresented | the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib | altered source versions | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
bsl-1 | machine executable | unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor
unlicense | unencumbered | this is free and unencumbered software released into the public domain
wtfpl | what the fuck | everyone is permitted to copy and distribute verbatim or modified copies of this licen[cs]e document and changing it is allowed as long as the name is changed do what the fuck you want to
cc0-1 | waive | (?:to the extent possible under law|the person who associated a work with this deed) (?:[a-z0-9]+ ){1,16}waived all copyright and related or neighboring rights
cc0-1 | commons zero | creative commons zero(?: 1 0)?(?: universal)?
cc-by | commons attribution | creative commons attribution [1234] [05](?: international)?
cc-by-sa | commons attribution | creative commons attribution share ?alike(?: [1234] [05])?(?: international)?
cc-by-nd | commons attribution | creative commons attribution no ?deriv(?:ative)?s?(?: [1234] [05])?(?: international)?
cc-by-nc | commons attribution | creative commons attribution non ?commercial(?: [1234] [05])?(?: international)?
cc-by-nc-sa | commons attribution | creative commons attribution non ?commercial share ?alike(?: [1234] [05])?(?: international)?
cc-by-nc-nd | commons attribution | creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: [1234] [05])?(?: international)?
postgresql | documentation for any | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
python-2 | psf hereby grants | psf hereby grants licensee a nonexclusive royalty free world wide licen[cs]e
openssl | openssl project | this product includes software developed by the openssl project for use in the openssl toolkit
php-3 | php software | this product includes php software freely available from
ofl-1.1 | reserved font | no modified version of the font software may use the reserved font name|with reserved font name
artistic-1 | artistic control | the copyright holder maintains some semblance of artistic control over the development of the package
eupl-1.2 | licensed under the eupl | licensed under the eupl(?: v(?:ersion )?1 2)?(?: or as soon they will be approved by the european commission subsequent versions of the eupl)?
ncsa | with the software | to deal with the software without restriction including without limitation the rights to use copy modify merge publish distribute
sspl-1 | functionality of the program | if you make the functionality of the program or a modified version available to third parties as a service
bsl-1.1 | change date | effective on the change date or the fourth anniversary of the first publicly available distribution
elastic-2 | hosted or managed | you may not provide the software to third parties as a hosted or managed service
proprietary | all rights reserved | all rights reserved (?:unauthori[sz]ed|no part of)(?: [a-z0-9]+){1,8}
"""
#: priority and weight of a wording
WORDING = (2, 0.92)

#: How a signature is told from a licence's line: priority (1 is best), weight of a detection,
#: the expression and the keyword, from the title t, the identifier i and the address a.
_FORMS = (
    (1, 1.0, lambda t, i, a: f"spdx license identifier {i}", lambda k, a: "spdx"),
    (2, 0.95, lambda t, i, a: r"(?:licen[cs]ed|released|distributed|available|published|provided)"
                              rf" under (?:the )?(?:terms of the |conditions of the )?{t}",
     lambda k, a: k),
    (3, 0.8, lambda t, i, a: a, lambda k, a: a),
    (4, 0.6, lambda t, i, a: t, lambda k, a: k),
)

#: weight of a phrase of BASE_PHRASES
BASE_WEIGHT = 0.9

#: Every signature and every base phrase contains one of these: a document without any
#: has no detection (tests/llm/test_licenses.py holds each signature against the list).
GATE = ("permission", "warrant", "redistribut", "copyright", "distribut", "copies", "software", "tortious", "rights",
        "hosted or managed", "functionality of the program", "reserved font", "change date", "commons", "network",
        "licen", "spdx", "bsd", "gnu ", "cc by", "cc0", "creative", "mozilla", "eclipse", "rail",
        "as perl", "no attribution", "wtfpl", "europa", "curl se", "sil org", "w3 org", "mariadb")


def rules() -> list[dict]:
    """The ordered signatures: rule number, label, priority, weight, keyword, expression."""
    out = []
    for line in LICENSES.strip().splitlines():
        label, rest = (x.strip() for x in line.split(" | ", 1))
        title, keyword, ident, address = (x.strip() for x in rest.rsplit(" | ", 3))
        for priority, weight, expr, key in _FORMS:
            out.append({"rule": len(out), "label": label, "priority": priority, "weight": weight,
                        "keyword": key(keyword, address),
                        "regex": f" (?:{expr(title, ident, address)})(?= )"})
    for line in WORDINGS.strip().splitlines():
        label, keyword, expr = (x.strip() for x in line.split(" | ", 2))
        out.append({"rule": len(out), "label": label, "priority": WORDING[0], "weight": WORDING[1],
                    "keyword": keyword, "regex": f" (?:{expr})(?= )"})
    return out


def _rule_array() -> Column:
    return F.array(*[F.struct(F.lit(r["rule"]).alias("rule"), F.lit(r["label"]).alias("label"),
                              F.lit(r["priority"]).alias("priority"), F.lit(r["weight"]).alias("weight"),
                              F.lit(r["keyword"]).alias("keyword"), F.lit(r["regex"]).alias("regex"))
                     for r in rules()])


def normalise(text: Column) -> Column:
    """The words of ``text`` with one space on either side, '' if there is none."""
    flat = F.trim(F.regexp_replace(text, _GAP, " "))
    return F.when(flat == "", F.lit("")).otherwise(F.concat(F.lit(" "), flat, F.lit(" ")))


def _spaces(col: Column) -> Column:
    return (F.length(col) - F.length(F.replace(col, F.lit(" "), F.lit("")))).cast("long")


def _spans(norm: Column, rule: Column) -> Column:
    """Intervals [start, end) of words that a rule's expression covers, as detections."""
    pieces = F.split(norm, rule["regex"], -1)
    found = F.regexp_extract_all(norm, rule["regex"], F.lit(0))
    none = F.array().cast("array<struct<start:bigint,back:bigint,priority:int,rule:int,label:string,weight:double>>")

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + _spaces(pair["p"])
        end = start + _spaces(pair["m"])
        one = F.struct(start.alias("start"), (-end).alias("back"), rule["priority"].alias("priority"),
                       rule["rule"].alias("rule"), rule["label"].alias("label"),
                       rule["weight"].alias("weight"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    pairs = F.filter(F.arrays_zip(pieces.alias("p"), found.alias("m")), lambda x: x["m"].isNotNull())
    return F.aggregate(pairs, F.struct(F.lit(0).cast("long").alias("at"), none.alias("out")),
                       step, lambda acc: acc["out"])


def _sweep(detections: Column) -> Column:
    """Detections that no earlier, enclosing one of the same or a better priority suppresses."""
    first = F.struct(*[F.lit(-1).cast("long").alias(f"to{p}") for p in (1, 2, 3, 4)],
                     F.filter(detections, lambda d: F.lit(False)).alias("kept"))

    def step(acc: Column, d: Column) -> Column:
        end = -d["back"]
        reach = [F.when(d["priority"] >= p, acc[f"to{p}"]).otherwise(F.lit(-1).cast("long"))
                 for p in (1, 2, 3, 4)]
        inside = F.greatest(*reach) >= end
        far = [F.when(d["priority"] == p, F.greatest(acc[f"to{p}"], end))
               .otherwise(acc[f"to{p}"]).alias(f"to{p}") for p in (1, 2, 3, 4)]
        kept = F.when(inside, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(d)))
        return F.struct(*far, kept.alias("kept"))

    return F.aggregate(detections, first, step, lambda acc: acc["kept"])


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with a column ``license_scan``: a struct of n_words, n_base,
    first_word, last_word (places of BASE_PHRASES), base_labels, spans (kept detections:
    start, end, rule, label, weight), labels and score (the greatest weight). A column of that
    name is replaced."""
    docs = docs.select(*[c for c in docs.columns if c.lower() != "license_scan"])
    norm, low, det, kept, out = (free_name(docs, f"license_{x}") for x in
                                 ("norm", "low", "found", "kept", "scan"))
    df = docs.withColumn(norm, normalise(text_or_empty(text)))
    df = df.withColumn(low, F.lower(norm))
    gate = reduce(or_, [F.contains(F.col(low), F.lit(x)) for x in GATE])
    df = df.withColumn(low, F.when(gate, F.translate(F.col(norm), _UPPER, _LOWER)))
    gated = F.filter(_rule_array(), lambda r: F.contains(F.col(low), r["keyword"]))
    df = df.withColumn(det, F.when(F.col(low).isNotNull(), F.sort_array(F.flatten(
        F.transform(gated, lambda r: _spans(F.col(low), r))))))
    df = df.withColumn(kept, F.when(F.size(det) > 0, _sweep(F.col(det))))

    count, first, last, labels = [], [], [], []
    for label, phrase in BASE_PHRASES.items():
        there = F.contains(F.col(low), F.lit(f" {phrase} "))
        parts = F.split(F.col(low), f" {phrase}(?= )", -1)
        n = F.size(parts) - 1
        width = phrase.count(" ") + 1
        before_last = F.aggregate(F.slice(parts, 1, n), F.lit(0).cast("long"),
                                  lambda a, x: a + _spaces(x))
        count.append(F.coalesce(F.when(there, n), F.lit(0)).cast("long"))
        first.append(F.when(there, _spaces(parts[0])))
        last.append(F.when(there, before_last + (n - 1) * width))
        labels.append(F.when(there, F.lit(label)))
    n_base = sum(count[1:], count[0])
    base = F.array_sort(F.array_compact(F.array(*labels)))
    spans = F.coalesce(F.transform(F.col(kept), lambda d: F.struct(
        d["start"].alias("start"), (-d["back"]).alias("end"), d["rule"].alias("rule"),
        d["label"].alias("label"), d["weight"].alias("weight"))),
        F.array().cast("array<struct<start:bigint,end:bigint,rule:int,label:string,weight:double>>"))
    every = F.array_sort(F.array_union(base, F.coalesce(
        F.transform(F.col(kept), lambda d: d["label"]), F.array().cast("array<string>"))))
    score = F.greatest(F.when(F.size(base) > 0, F.lit(BASE_WEIGHT)).otherwise(F.lit(0.0)),
                       F.coalesce(F.array_max(F.transform(F.col(kept), lambda d: d["weight"])), F.lit(0.0)))
    df = df.withColumn(out, F.struct(
        F.when(F.col(norm) == "", F.lit(0).cast("long")).otherwise(_spaces(F.col(norm)) - 1).alias("n_words"),
        n_base.alias("n_base"), F.least(*first).alias("first_word"), F.greatest(*last).alias("last_word"),
        base.alias("base_labels"), spans.alias("spans"), every.alias("labels"), score.alias("score")))
    return df.select(*docs.columns, F.col(out).alias("license_scan"))


def digest(docs: DataFrame) -> DataFrame:
    s = F.col("license_scan")
    return scan(docs.select("doc_id", "text")).select(
        "doc_id", s["n_words"].alias("n_words"), s["n_base"].alias("n_base"),
        s["first_word"].alias("first_word"), s["last_word"].alias("last_word"),
        F.array_join(s["base_labels"], ",").alias("base_labels"),
        F.array_join(s["labels"], ",").alias("labels"), s["score"].alias("score"))
