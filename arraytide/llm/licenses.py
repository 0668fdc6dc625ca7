"""License scans by ordered signature rules, as column expressions only.

A text is brought to its words (A-Z lower-cased, everything but letters, digits and characters beyond ASCII is one space). A rule is a hand-written
regex over that line of words, with a label, a level and a keyword that each of its matches holds. Only rules whose keyword occurs run on a text.
Levels are priorities: 0 a notice or an identifier tag, 1 a license named with its version or number, 2 a license named, 3 a passing mention.

Detections are word intervals. One that lies inside a detection of the same or a better level is suppressed, so a notice silences the names inside
it, and a longer name the shorter one. Of equal intervals the better level, then the earlier rule stays. Who suppresses does not itself have to
survive: what lies inside it also lies inside its own suppressor. So one ordered window per document decides, without pairs.

The base phrases are rules as well; their detections are counted and their labels stay whatever lies around them.

Defined results: a null text is empty; a text without words has no detection and score 0; repeated rows are scanned each; labels are sorted by
bytes; an empty table gives no rows; very long texts are scanned whole, only texts with a detection are shuffled, and of them only intervals;
further columns are not read, whatever their names.
"""
from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arraytide.llm import common

# fixed values: the base phrases
BASE = (("mit", "under the mit license", "mit"), ("apache-2", "apache license version 2", "apache"), ("cc-by-nc", "cc by nc", "cc"))

# the signature rules: label, level, keyword, regex over words
SIGNATURES = r"""
mit 0 granted permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit 0 substantial the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit 0 spdx spdx license identifier mit
mit 0 licensed (?:is |are )?licensed under the (?:terms of the )?(?:mit|expat) license
mit 0 released (?:is |are )?released under the (?:terms of the )?(?:mit|expat) license
mit 0 distributed (?:is |are )?distributed under the (?:terms of the )?(?:mit|expat) license
mit 1 opensource opensource org licenses mit(?: license)?(?: php| html)?
mit 2 mit (?:the )?mit licen[cs]ed?
mit 2 expat (?:the )?expat license
mit 3 mit (?:license|licensed) mit
mit-0 0 spdx spdx license identifier mit 0
mit-0 1 attribution mit no attribution(?: license)?
x11 0 spdx spdx license identifier x11
x11 2 x11 (?:the )?x11 licen[cs]e
x11 0 consortium except as contained in this notice the name of the x consortium shall not be used in advertising
isc 0 spdx spdx license identifier isc
isc 0 fee permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc 2 isc (?:the )?isc licen[cs]e
0bsd 0 spdx spdx license identifier 0bsd
0bsd 2 0bsd 0bsd(?: license)?
0bsd 1 zero (?:bsd zero clause|zero clause bsd)(?: license)?
bsd-2 0 spdx spdx license identifier bsd 2 clause
bsd-2 1 bsd (?:the )?(?:2|two) clause bsd licen[cs]e
bsd-2 1 clause bsd (?:2|two) clause(?: licen[cs]e)?
bsd-2 1 simplified simplified bsd licen[cs]e
bsd-2 1 freebsd (?:the )?freebsd licen[cs]e
bsd-2 0 forms redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd-3 0 spdx spdx license identifier bsd 3 clause
bsd-3 1 bsd (?:the )?(?:3|three) clause bsd licen[cs]e
bsd-3 1 clause bsd (?:3|three) clause(?: licen[cs]e)?
bsd-3 1 bsd (?:revised|modified|new) bsd licen[cs]e
bsd-3 0 endorse neither the name of (?:[^ ]+ ){1,12}nor the names of (?:its|their|the) contributors may be used to endorse or promote products
bsd-3 1 opensource opensource org licenses bsd 3 clause
bsd-3 0 style use of this source code is governed by a bsd style license
bsd-4 0 spdx spdx license identifier bsd 4 clause
bsd-4 0 advertising all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-4 1 original original bsd licen[cs]e
bsd-4 1 clause bsd (?:4|four) clause(?: licen[cs]e)?
bsd 2 bsd (?:the )?bsd licen[cs]e
bsd 3 bsd bsd (?:style|licensed|like)
apache-1 0 spdx spdx license identifier apache 1 [01]
apache-1 1 apache (?:the )?apache (?:software )?licen[cs]e (?:version |v )?1 [01]
apache-2 0 spdx spdx license identifier apache 2 0
apache-2 0 compliance you may not use this (?:file|work|software) except in compliance with the license
apache-2 0 licensed (?:is |are )?licensed under the apache licen[cs]e version 2(?: 0)?
apache-2 0 asf licensed to the apache software foundation asf under one or more contributor license agreements
apache-2 1 apache (?:the )?apache (?:software )?licen[cs]e (?:version |v |ver )?2(?: 0)?
apache-2 1 apache www apache org licenses license 2 0(?: txt| html)?
apache-2 1 opensource opensource org licenses apache 2 0
apache-2 2 apache apache (?:v ?)?2 0(?: licen[cs]ed?)?
apache-2 2 asl20 asl20
apache-2 2 asl asl (?:v )?2 0
apache 2 apache (?:the )?apache (?:software )?licen[cs]ed?
agpl-3 0 spdx spdx license identifier agpl 3 0(?: only| or later)?
agpl-3 0 affero (?:under the terms of|licensed under) the gnu affero general public licen[cs]e version 3
agpl-3 1 affero (?:the )?gnu affero general public licen[cs]e (?:version |v )?3(?: 0)?
agpl-3 1 agplv3 agplv3
agpl-3 1 agpl agpl (?:v |version )?3(?: 0)?
agpl 2 affero (?:the )?(?:gnu )?affero general public licen[cs]e
agpl 3 agpl agpl
lgpl-2 0 spdx spdx license identifier lgpl 2 [01](?: only| or later)?
lgpl-2 1 lesser (?:the )?gnu lesser general public licen[cs]e (?:as published by the free software foundation )?(?:either )?(?:version |v )?2(?: 1)?
lgpl-2 1 library (?:the )?gnu library general public licen[cs]e (?:version |v )?2(?: 0)?
lgpl-2 1 lgplv2 lgplv2(?: 1)?
lgpl-2 1 lgpl lgpl (?:v |version )?2(?: [01])?
lgpl-3 0 spdx spdx license identifier lgpl 3 0(?: only| or later)?
lgpl-3 1 lesser (?:the )?gnu lesser general public licen[cs]e (?:as published by the free software foundation )?(?:either )?(?:version |v )?3(?: 0)?
lgpl-3 1 lgplv3 lgplv3
lgpl-3 1 lgpl lgpl (?:v |version )?3(?: 0)?
lgpl 2 lesser (?:the )?(?:gnu )?lesser general public licen[cs]e
lgpl 2 library (?:the )?gnu library general public licen[cs]e
lgpl 3 lgpl lgpl
gpl-1 0 spdx spdx license identifier gpl 1 0(?: only| or later)?
gpl-1 1 general (?:the )?gnu general public licen[cs]e (?:version |v )?1(?: 0)?
gpl-2 0 spdx spdx license identifier gpl 2 0(?: only| or later)?
gpl-2 0 redistribute you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e as published by the free software foundation either version 2
gpl-2 0 licensed (?:is )?licensed under the gnu general public licen[cs]e version 2
gpl-2 1 general (?:the )?gnu general public licen[cs]e (?:version |v )?2(?: 0)?
gpl-2 1 gplv2 gplv2
gpl-2 1 gpl gpl (?:v |version )?2(?: 0)?
gpl-2 1 gnu www gnu org licenses (?:old licenses )?gpl 2 0(?: html| txt)?
gpl-3 0 spdx spdx license identifier gpl 3 0(?: only| or later)?
gpl-3 0 redistribute you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e as published by the free software foundation either version 3
gpl-3 0 licensed (?:is )?licensed under the gnu general public licen[cs]e version 3
gpl-3 1 general (?:the )?gnu general public licen[cs]e (?:version |v )?3(?: 0)?
gpl-3 1 gplv3 gplv3
gpl-3 1 gpl gpl (?:v |version )?3(?: 0)?
gpl-3 1 gnu www gnu org licenses gpl 3 0(?: html| txt)?
gpl 0 warranty this program is distributed in the hope that it will be useful but without any warranty
gpl 2 general (?:the )?(?:gnu )?general public licen[cs]e
gpl 2 gnu gnu gpl
gpl 3 gpl gpl
gpl 3 gnu www gnu org licenses
classpath-exception 1 classpath (?:with )?classpath exception
gcc-exception 1 gcc gcc runtime library exception
gfdl 0 spdx spdx license identifier gfdl 1 [123](?: only| or later)?
gfdl 1 documentation (?:the )?gnu free documentation licen[cs]e(?: version 1 [123])?
gfdl 3 gfdl gfdl
mpl-1 0 spdx spdx license identifier mpl 1 [01]
mpl-1 1 mozilla (?:the )?mozilla public licen[cs]e (?:version |v )?1(?: [01])?
mpl-2 0 spdx spdx license identifier mpl 2 0
mpl-2 0 subject this source code form is subject to the terms of the mozilla public license
mpl-2 1 mozilla (?:the )?mozilla public licen[cs]e (?:version |v )?2(?: 0)?
mpl-2 1 mpl mpl (?:v |version )?2(?: 0)?
mpl-2 1 mozilla (?:www )?mozilla org mpl 2 0
mpl 2 mozilla (?:the )?mozilla public licen[cs]e
mpl 3 mpl mpl
epl-1 0 spdx spdx license identifier epl 1 0
epl-1 1 eclipse (?:the )?eclipse public licen[cs]e (?:version |v )?1(?: 0)?
epl-2 0 spdx spdx license identifier epl 2 0
epl-2 1 eclipse (?:the )?eclipse public licen[cs]e (?:version |v )?2(?: 0)?
epl 2 eclipse (?:the )?eclipse public licen[cs]e
edl 1 eclipse (?:the )?eclipse distribution licen[cs]e(?: version 1 0| v 1 0)?
cddl-1 0 spdx spdx license identifier cddl 1 [01]
cddl-1 1 cddl (?:common development and distribution licen[cs]e )?cddl (?:version |v )?1 [01]
cddl 2 development (?:the )?common development and distribution licen[cs]e
cpl-1 0 spdx spdx license identifier cpl 1 0
cpl-1 1 common common public licen[cs]e(?: version 1 0| v 1 0)?
ipl-1 1 ibm ibm public licen[cs]e(?: version 1 0)?
eupl-1 0 spdx spdx license identifier eupl 1 [12]
eupl-1 1 european european union public licen[cs]e(?: v 1 [12]| version 1 [12])?
eupl-1 2 eupl eupl(?: 1 [12])?
osl-3 0 spdx spdx license identifier osl 3 0
osl-3 1 open (?:the )?open software licen[cs]e (?:version |v )?3(?: 0)?
afl-3 0 spdx spdx license identifier afl 3 0
afl-3 1 academic academic free licen[cs]e(?: version 3 0| v 3 0)?
artistic-1 0 spdx spdx license identifier artistic 1 0
artistic-2 0 spdx spdx license identifier artistic 2 0
artistic-2 1 artistic artistic licen[cs]e (?:version |v )?2(?: 0)?
artistic 2 artistic (?:the )?artistic licen[cs]e
perl 1 perl (?:under )?the same terms as perl(?: itself)?
zlib 0 spdx spdx license identifier zlib
zlib 0 misrepresented the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib 2 zlib (?:the )?zlib(?: libpng)? licen[cs]e
libpng 0 spdx spdx license identifier libpng(?: 2 0)?
libpng 2 libpng (?:the )?libpng licen[cs]e
boost-1 0 spdx spdx license identifier bsl 1 0
boost-1 0 boost distributed under the boost software license version 1 0
boost-1 1 boost (?:the )?boost software licen[cs]e(?: version 1 0| 1 0)?
boost-1 1 boost www boost org license 1 0 txt
busl-1 0 spdx spdx license identifier busl 1 1
busl-1 1 business (?:the )?business source licen[cs]e(?: version)?(?: 1 1)?
unlicense 0 spdx spdx license identifier unlicense
unlicense 0 unencumbered this is free and unencumbered software released into the public domain
unlicense 2 unlicense (?:the )?unlicense(?: org)?
wtfpl 0 spdx spdx license identifier wtfpl
wtfpl 1 want do what the [^ ]+ you want to public licen[cs]e
wtfpl 2 wtfpl wtfpl
python-2 0 spdx spdx license identifier (?:psf|python) 2 0
python-2 1 psf psf licen[cs]e agreement
python-2 1 python python software foundation licen[cs]e(?: version 2)?
postgresql 0 spdx spdx license identifier postgresql
postgresql 2 postgresql (?:the )?postgresql licen[cs]e
openssl 0 spdx spdx license identifier openssl
openssl 0 toolkit this product includes software developed by the openssl project for use in the openssl toolkit
openssl 2 openssl (?:the )?openssl licen[cs]e
ruby 0 spdx spdx license identifier ruby
ruby 2 ruby (?:the )?ruby licen[cs]e
php-3 0 spdx spdx license identifier php 3 0(?: 1)?
php-3 1 php (?:the )?php licen[cs]e(?: version 3(?: 0)?(?: 1)?)?
w3c 0 spdx spdx license identifier w3c
w3c 1 w3c w3c software (?:notice and )?licen[cs]e
ncsa 0 spdx spdx license identifier ncsa
ncsa 1 ncsa (?:university of illinois )?ncsa open source licen[cs]e
ms-pl 0 spdx spdx license identifier ms pl
ms-pl 1 microsoft microsoft public licen[cs]e
ms-rl 0 spdx spdx license identifier ms rl
ms-rl 1 microsoft microsoft reciprocal licen[cs]e
ecl-2 0 spdx spdx license identifier ecl 2 0
ecl-2 1 community educational community licen[cs]e(?: version 2 0)?
upl-1 0 spdx spdx license identifier upl 1 0
upl-1 1 universal universal permissive licen[cs]e(?: v 1 0| version 1 0)?
mulan-2 0 spdx spdx license identifier mulanpsl 2 0
mulan-2 1 mulan mulan (?:psl|permissive software licen[cs]e)(?: v2| version 2)?
vim 0 spdx spdx license identifier vim
vim 2 vim (?:the )?vim licen[cs]e
ofl-1 0 spdx spdx license identifier ofl 1 [01]
ofl-1 1 font (?:the )?(?:sil )?open font licen[cs]e(?: ofl)?(?: version)? 1 [01]
ofl-1 1 ofl ofl (?:version |v )?1 [01]
ofl 2 font (?:the )?(?:sil )?open font licen[cs]e
lppl-1 0 spdx spdx license identifier lppl 1 [0123]c?
lppl-1 1 latex (?:the )?latex project public licen[cs]e
qpl-1 0 spdx spdx license identifier qpl 1 0
qpl-1 1 public (?:the )?q public licen[cs]e(?: version 1 0)?
sspl-1 0 spdx spdx license identifier sspl 1 0
sspl-1 1 server (?:the )?server side public licen[cs]e(?: version 1| v 1)?
elastic-2 0 spdx spdx license identifier elastic 2 0
elastic-2 1 elastic (?:the )?elastic licen[cs]e(?: version 2(?: 0)?| 2 0| v2)?
blueoak-1 0 spdx spdx license identifier blueoak 1 0 0
blueoak-1 1 oak (?:the )?blue oak model licen[cs]e(?: 1 0 0)?
cc0 0 spdx spdx license identifier cc0 1 0
cc0 0 waiving has dedicated the work to the public domain by waiving all of his or her rights
cc0 0 waived has waived all copyright and related or neighboring rights
cc0 1 cc0 (?:cc0|creative commons cc0|creative commons zero cc0)(?: v)?(?: 1 0)?(?: universal)?
cc0 1 zero creative commons zero(?: v?1 0)?(?: universal)?
cc0 1 publicdomain creativecommons org publicdomain zero 1 0
public-domain 1 publicdomain creativecommons org publicdomain mark 1 0
public-domain 2 domain (?:released |dedicated |placed )?(?:in|into|to) the public domain
public-domain 3 domain public domain
cc-by 0 spdx spdx license identifier cc by [1234] [05]
cc-by 1 attribution creative commons attribution(?: [1234] [05])?(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?
cc-by 1 cc cc by [1234] [05]
cc-by 1 creativecommons creativecommons org licenses by [1234] [05]
cc-by 2 cc cc by
cc-by-sa 0 spdx spdx license identifier cc by sa [1234] [05]
cc-by-sa 1 sharealike creative commons attribution sharealike(?: [1234] [05])?(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?
cc-by-sa 1 creativecommons creativecommons org licenses by sa [1234] [05]
cc-by-sa 2 cc cc by sa(?: [1234] [05])?
cc-by-nc 0 spdx spdx license identifier cc by nc [1234] [05]
cc-by-nc 0 licensed (?:is |are )?licensed under (?:a )?cc by nc(?: [1234] [05])?
cc-by-nc 1 noncommercial creative commons attribution noncommercial(?: [1234] [05])?(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?
cc-by-nc 1 creativecommons creativecommons org licenses by nc [1234] [05]
cc-by-nc 2 cc cc by nc(?: [1234] [05])?
cc-by-nd 0 spdx spdx license identifier cc by nd [1234] [05]
cc-by-nd 1 noderivatives creative commons attribution noderivatives(?: [1234] [05])?(?: international)?
cc-by-nd 1 creativecommons creativecommons org licenses by nd [1234] [05]
cc-by-nd 2 cc cc by nd(?: [1234] [05])?
cc-by-nc-sa 0 spdx spdx license identifier cc by nc sa [1234] [05]
cc-by-nc-sa 1 sharealike creative commons attribution non ?commercial sharealike(?: [1234] [05])?(?: international| unported| generic)?
cc-by-nc-sa 1 creativecommons creativecommons org licenses by nc sa [1234] [05]
cc-by-nc-sa 2 cc cc by nc sa(?: [1234] [05])?
cc-by-nc-nd 0 spdx spdx license identifier cc by nc nd [1234] [05]
cc-by-nc-nd 1 noderivatives creative commons attribution non ?commercial noderivatives(?: [1234] [05])?(?: international| unported| generic)?
cc-by-nc-nd 1 creativecommons creativecommons org licenses by nc nd [1234] [05]
cc-by-nc-nd 2 cc cc by nc nd(?: [1234] [05])?
creative-commons 2 commons (?:a |the )?creative commons licen[cs]ed?
creative-commons 3 commons creative commons
odbl-1 0 spdx spdx license identifier odbl 1 0
odbl-1 1 database (?:the )?(?:odc )?open database licen[cs]e(?: odbl)?(?: v1 0| 1 0)?
odbl-1 3 odbl odbl
odc-by-1 0 spdx spdx license identifier odc by 1 0
odc-by-1 1 commons open data commons attribution licen[cs]e(?: v1 0| 1 0)?
pddl-1 0 spdx spdx license identifier pddl 1 0
pddl-1 1 dedication public domain dedication and licen[cs]e(?: pddl| 1 0)?
ogl-uk-3 0 spdx spdx license identifier ogl uk [123] 0
ogl-uk-3 1 government (?:the )?open government licen[cs]e(?: v ?[123](?: 0)?| version [123](?: 0)?)?
cdla-permissive 1 cdla (?:community data licen[cs]e agreement )?cdla permissive(?: [12] 0)?
cdla-sharing 1 cdla (?:community data licen[cs]e agreement )?cdla sharing(?: 1 0)?
openrail 1 openrail (?:creativeml |bigscience |bigcode )?openrail(?: m)?(?: licen[cs]e)?
openrail 1 rail bigscience (?:bloom )?rail(?: licen[cs]e)?(?: v ?1 0)?
llama-2 1 llama llama 2 (?:community )?licen[cs]e(?: agreement)?
llama-3 1 llama llama 3(?: [123])? community licen[cs]e(?: agreement)?
gemma 1 gemma gemma terms of use
proprietary 0 confidential (?:this (?:file|software|document) is )?(?:proprietary and confidential|confidential and proprietary)
proprietary 0 reserved copyright (?:c )?(?:[^ ]+ ){0,8}all rights reserved
proprietary 1 prohibited unauthori[sz]ed (?:copying|reproduction|use|distribution) (?:[^ ]+ ){0,12}(?:is )?strictly prohibited
proprietary 1 license (?:end user license agreement|commercial license agreement)
proprietary 2 reserved all rights reserved
no-commercial 1 commercial (?:for )?non commercial (?:use|purposes) only
no-commercial 1 noncommercial (?:for )?noncommercial (?:use|purposes) only
no-commercial 1 commercial not for commercial (?:use|purposes)
dual 1 dual dual licen[cs]ed(?: under)?
other-license 3 license (?:see|read) the (?:file )?license(?: file| txt| md)?(?: for details)?
other-license 3 licensed licensed under
other-license 3 spdx spdx license identifier
"""
CONFIDENCE = (1.0, 0.9, 0.7, 0.4)  # of a detection, by level


def rules() -> list[tuple[str, int, str, str, bool]]:
    """label, level, keyword, regex, is base: the base phrases first, then the signatures in their order."""
    own = [line.split(" ", 3) for line in SIGNATURES.strip().splitlines()]
    return [(label, 0, keyword, phrase, True) for label, phrase, keyword in BASE] + [(label, int(level), keyword, regex, False) for label, level, keyword, regex in own]


RULES = rules()


def line_of(text: str | Column = "text") -> Column:
    """The words of a text, each between single spaces."""
    lower = F.translate(common.text_of(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_replace(F.concat(F.lit(" "), lower, F.lit(" ")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")


def constant(value: list, kind: str) -> Column:
    """A list as one literal: the optimiser folds it before the query runs."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _places(words: Column, has) -> Column:
    """Numbers of the words (the empty one in front is none) that hold a mark."""
    return F.filter(F.transform(words, lambda w, i: F.when(has(w), i)), lambda i: i.isNotNull())


def keywords_in(line: Column) -> Column:
    """The keywords of rules that the line holds."""
    return F.filter(constant(sorted({r[2] for r in RULES}), "array<string>"), lambda k: F.contains(line, F.concat(F.lit(" "), k, F.lit(" "))))


def detections(line: Column, held: Column) -> Column:
    """array<struct<start, end, rule>>: every place of every rule whose keyword is `held`; word numbers from 0, end exclusive."""
    table = constant([{"rule": i, "keyword": k, "regex": f"(?<= )(?:{r})(?= )"} for i, (_, _, k, r, _) in enumerate(RULES)],
                     "array<struct<rule:int,keyword:string,regex:string>>")

    def found(r: Column) -> Column:
        # a match is marked at both ends; the marks say which words it begins and ends with
        words = F.split(F.regexp_replace(line, r["regex"], F.lit("\x01$0\x02")), " ", -1)
        both = F.arrays_zip(_places(words, lambda w: F.startswith(w, F.lit("\x01"))).alias("a"), _places(words, lambda w: F.endswith(w, F.lit("\x02"))).alias("b"))
        hits = F.transform(both, lambda p: F.struct((p["a"] - 1).alias("start"), p["b"].alias("end"), r["rule"].alias("rule")))
        return F.when(F.regexp_like(line, r["regex"]), hits).otherwise(F.array().cast("array<struct<start:int,end:int,rule:int>>"))

    none = F.array().cast("array<struct<start:int,end:int,rule:int>>")
    gated = F.filter(table, lambda r: F.array_contains(held, r["keyword"]))
    return F.when(F.size(held) > 0, F.flatten(F.transform(gated, found))).otherwise(none)


def _of(values: list, rule: Column) -> Column:
    kind = "string" if isinstance(values[0], str) else "double" if isinstance(values[0], float) else "int"
    return F.get(constant(values, f"array<{kind}>"), rule)


def surviving(found: DataFrame) -> DataFrame:
    """`found` (uid, start, end, rule) without the detections that lie inside one of the same or a better level."""
    t = found.withColumn("level", _of([r[1] for r in RULES], F.col("rule")))
    before = Window.partitionBy("uid").orderBy("start", F.desc("end"), "level", "rule").rowsBetween(Window.unboundedPreceding, -1)
    # how far the detections before this one reach, by level; before it are all that can hold it
    for level in range(len(CONFIDENCE)):
        t = t.withColumn(f"reach{level}", F.max(F.when(F.col("level") <= level, F.col("end"))).over(before))
    reach = F.get(F.array(*(F.col(f"reach{i}") for i in range(len(CONFIDENCE)))), F.col("level"))
    return t.where(reach.isNull() | (reach < F.col("end"))).select("uid", "start", "end", "rule", "level")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, found (all detections) under a row number `uid`; stored."""
    t = docs.select(F.col(doc_id).alias("doc_id"), line_of(text).alias("line"))
    words = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))) - 1
    t = t.select("doc_id", words.cast("long").alias("n_words"), "line", keywords_in(F.col("line")).alias("held"))
    t = t.select("doc_id", "n_words", detections(F.col("line"), F.col("held")).alias("found"))
    return common.stored(t.withColumn("uid", F.monotonically_increasing_id()), "license-hits")


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (the confidence of the best detection that survives)."""
    scanned = scan(docs, doc_id, text)
    names = [r[0] for r in RULES]
    base = F.filter("found", lambda d: d["rule"] < len(BASE))
    begins = F.transform(base, lambda d: d["start"].cast("long"))
    own = scanned.select("uid", "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(begins).alias("first_word"), F.array_max(begins).alias("last_word"),
                         F.array_distinct(F.transform(base, lambda d: _of(names, d["rule"]))).alias("base"), (F.size("found") > 0).alias("any"))
    kept = surviving(scanned.where(F.size("found") > 0).select("uid", F.explode("found").alias("d")).select("uid", "d.*"))
    kept = kept.groupBy("uid").agg(F.collect_set(_of(names, F.col("rule"))).alias("more"), F.max(_of(list(CONFIDENCE), F.col("level"))).alias("score"))
    front = ("doc_id", "n_words", "n_base", "first_word", "last_word")
    some = own.where("any").join(kept, "uid").select(*front, _joined(F.col("base")).alias("base_labels"), _joined(F.concat("base", "more")).alias("labels"), "score")
    none = own.where("not any").select(*front, F.lit("").alias("base_labels"), F.lit("").alias("labels"), F.lit(0.0).alias("score"))
    return some.unionByName(none)
