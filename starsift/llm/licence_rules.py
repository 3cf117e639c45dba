"""Licence signatures in order of priority.

A rule is `label | keyword | pattern | weight`. Patterns see lower-case words with one space between them, so "2.0"
reads `2 0`. The keyword must stand in the text before the pattern is tried. Fixed values: names and usual wordings
of public licences.
"""

from __future__ import annotations

from itertools import product

#: Whole sentences of licence texts: the surest signs.
TEXTS = r"""
mit | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files | 1.0
mit | without restriction including | without restriction including without limitation the rights to use copy modify merge publish distribute sublicense | 1.0
mit-0 | without restriction | to deal in the software without restriction including .{0,120}subject to no conditions | 0.9
isc | permission to use | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted | 1.0
0bsd | permission to use | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that no notice | 0.9
bsd | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met | 1.0
bsd-3-clause | neither the name | neither the names? of .{1,80} nor the names? of its contributors may be used to endorse or promote products | 1.0
bsd-4-clause | all advertising materials | all advertising materials mentioning features or use of this software must display the following acknowledge?ment | 1.0
bsd-2-clause | binary form must reproduce | redistributions in binary form must reproduce the above copyright notice this list of conditions | 0.9
apache-2.0 | licensed under the apache | licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license | 1.0
apache-2.0 | except in compliance | you may not use this file except in compliance with the license | 0.9
apache-1.1 | apache software foundation | this product includes software developed by the apache software foundation | 0.9
gpl | free software you can | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license | 1.0
lgpl | free software you can | this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license | 1.0
agpl | free software you can | this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license | 1.0
gpl | you should have received | you should have received a copy of the gnu general public license along with this program | 1.0
lgpl | you should have received | you should have received a copy of the gnu lesser general public license along with this library | 1.0
agpl | you should have received | you should have received a copy of the gnu affero general public license along with this program | 1.0
mpl-2.0 | mozilla public license | this source code form is subject to the terms of the mozilla public license v 2 0 | 1.0
mpl-1.1 | mozilla public license | the contents of this file are subject to the mozilla public license version 1 1 | 1.0
epl-1.0 | eclipse public license | this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 | 1.0
epl-2.0 | eclipse public license | this program and the accompanying materials are made available under the terms of the eclipse public license v? ?2 0 | 1.0
cddl | common development and distribution | subject to the terms of the common development and distribution license | 1.0
zlib | as is without any | this software is provided as is without any express or implied warranty in no event will the authors be held liable | 1.0
zlib | altered source versions | altered source versions must be plainly marked as such and must not be misrepresented as being the original software | 1.0
bsl-1.0 | boost software license | permission is hereby granted free of charge to any person or organization obtaining a copy of the software .{0,200}boost software license | 1.0
bsl-1.0 | boost software license | distributed under the boost software license version 1 0 | 1.0
unlicense | public domain | this is free and unencumbered software released into the public domain | 1.0
wtfpl | do what the fuck | you just do what the fuck you want to | 1.0
cc0 | public domain | dedicated all copyright and related and neighboring rights to this software to the public domain | 1.0
artistic-2.0 | artistic license | everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed .{0,80}artistic license | 0.9
postgresql | permission to use | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted | 1.0
ncsa | neither the names | neither the names of .{1,120} nor the names of its contributors may be used to endorse .{0,120}university of illinois | 0.9
x11 | except as contained | except as contained in this notice the names? of .{1,60} shall not be used in advertising | 1.0
ofl-1.1 | font software is licensed | this font software is licensed under the sil open font license version 1 1 | 1.0
ms-pl | if you use the software | if you use the software you accept this license .{0,80}microsoft public license | 0.9
json | good not evil | the software shall be used for good not evil | 1.0
beerware | buy me a beer | you can buy me a beer in return | 1.0
proprietary | confidential and proprietary | this .{1,40} is confidential and proprietary .{0,80}license | 0.7
"""

#: What may lead to a name.
GRANT = r"(?:(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?)?"

#: Named licences with versions: label, names (a pattern), keyword, versions.
VERSIONED = (
    ("gpl", r"(?:gnu )?general public license", "general public license", ("1", "2", "3")),
    ("lgpl", r"(?:gnu )?(?:lesser|library) general public license", "general public license", ("2", "2 1", "3")),
    ("agpl", r"(?:gnu )?affero general public license", "affero", ("1", "3")),
    ("gfdl", r"(?:gnu )?free documentation license", "free documentation", ("1 1", "1 2", "1 3")),
    ("apache", r"apache (?:software )?license", "apache", ("1 0", "1 1", "2 0")),
    ("mpl", r"mozilla public license", "mozilla public", ("1 0", "1 1", "2 0")),
    ("epl", r"eclipse public license", "eclipse public", ("1 0", "2 0")),
    ("eupl", r"european union public licen[cs]e", "european union public", ("1 0", "1 1", "1 2")),
    ("cddl", r"common development and distribution license", "common development", ("1 0", "1 1")),
    ("cpl", r"common public license", "common public license", ("1 0",)),
    ("afl", r"academic free license", "academic free", ("1 1", "1 2", "2 0", "2 1", "3 0")),
    ("osl", r"open software license", "open software license", ("1 0", "2 0", "2 1", "3 0")),
    ("artistic", r"artistic license", "artistic license", ("1 0", "2 0")),
    ("lppl", r"latex project public license", "latex project", ("1 0", "1 1", "1 2", "1 3")),
    ("ofl", r"(?:sil )?open font license", "open font license", ("1 0", "1 1")),
    ("bsl", r"boost software license", "boost software", ("1 0",)),
    ("zpl", r"zope public license", "zope public", ("1 1", "2 0", "2 1")),
    ("apsl", r"apple public source license", "apple public source", ("1 0", "1 1", "1 2", "2 0")),
    ("cecill", r"cecill(?: free software)? license", "cecill", ("1 0", "1 1", "2 0", "2 1")),
    ("rpl", r"reciprocal public license", "reciprocal public", ("1 1", "1 5")),
    ("sspl", r"server side public license", "server side public", ("1",)),
    ("upl", r"universal permissive license", "universal permissive", ("1 0",)),
    ("odbl", r"open (?:data commons open )?database license", "database license", ("1 0",)),
    ("psf", r"python software foundation license", "python software", ("2",)),
)

#: Creative Commons: clause words, their long form, and versions.
CC_CLAUSES = (
    ("by nc nd", r"attribution non ?commercial no ?deriv(?:ative|ative work)?s?"),
    ("by nc sa", r"attribution non ?commercial share ?alike"),
    ("by nc", r"attribution non ?commercial"),
    ("by nd", r"attribution no ?deriv(?:ative|ative work)?s?"),
    ("by sa", r"attribution share ?alike"),
    ("by", r"attribution"),
)
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

#: Single names and notices.
NAMES = r"""
mit | mit license | released under the mit license | 0.9
mit | mit license | licensed under (?:the )?mit license | 0.9
mit | mit license | (?:the )?mit license | 0.8
mit | expat license | expat license | 0.8
x11 | x11 license | x11 license | 0.8
isc | isc license | isc license | 0.8
bsd-2-clause | bsd | (?:simplified|freebsd|2 clause|two clause) bsd license | 0.8
bsd-2-clause | bsd | bsd 2 clause license | 0.8
bsd-3-clause | bsd | (?:new|modified|revised|3 clause|three clause) bsd license | 0.8
bsd-3-clause | bsd | bsd 3 clause license | 0.8
bsd-4-clause | bsd | (?:original|old|4 clause|four clause) bsd license | 0.8
0bsd | bsd | (?:zero clause|0 clause) bsd license | 0.8
bsd | bsd license | bsd(?: style)? license | 0.7
zlib | zlib | zlib(?: libpng)? license | 0.8
libpng | libpng | libpng license | 0.8
unlicense | unlicense | the unlicense | 0.8
wtfpl | wtfpl | wtfpl | 0.8
ncsa | ncsa | (?:university of illinois )?ncsa open source license | 0.8
postgresql | postgresql license | postgresql license | 0.8
openssl | openssl license | openssl license | 0.8
php | php license | php license(?: version 3 0)? | 0.8
ruby | ruby license | ruby license | 0.8
perl | same terms as perl | same terms as perl itself | 0.7
ms-pl | microsoft public license | microsoft public license | 0.8
ms-rl | microsoft reciprocal license | microsoft reciprocal license | 0.8
w3c | w3c | w3c software (?:notice and )?license | 0.8
vim | vim license | vim license | 0.8
json | json license | json license | 0.8
curl | curl license | curl license | 0.8
intel | intel open source license | intel open source license | 0.8
ibm-pl | ibm public license | ibm public license | 0.8
qpl | q public license | q public license | 0.8
nposl | non profit open software | non profit open software license | 0.8
sleepycat | sleepycat | sleepycat license | 0.8
elastic | elastic license | elastic license(?: version 2 0| 2 0)? | 0.8
busl | business source license | business source license(?: version 1 1| 1 1)? | 0.8
commons-clause | commons clause | commons clause license condition | 0.8
openrail | rail | (?:creativeml )?open rail(?: m)? license | 0.8
llama | llama | llama (?:2|3|3 1) community license | 0.8
cc0 | cc0 | (?:creative commons )?cc0(?: 1 0)?(?: universal)? | 0.9
public-domain | public domain | (?:placed |released )?(?:in|into|to) the public domain | 0.7
public-domain | public domain | public domain dedication | 0.7
proprietary | all rights reserved | all rights reserved | 0.4
copyright | copyright | copyright (?:c )?(?:19|20)[0-9]{2} | 0.4
copyright | copyright | copyright (?:holder|owner)s? | 0.3
unknown | license | licensed under (?:the )?(?:[^ ]+ ){1,4}licen[cs]e | 0.5
unknown | license | (?:see|read) (?:the )?(?:file )?licen[cs]e(?: file)?(?: txt| md)?(?: for details)? | 0.4
unknown | licence | licensed under (?:the )?(?:[^ ]+ ){1,4}licence | 0.5
"""

#: Machine-readable tags name their licence outright.
TAGS = (
    "mit", "isc", "bsd 2 clause", "bsd 3 clause", "bsd 4 clause", "0bsd", "apache 1 1", "apache 2 0", "gpl 2 0 only",
    "gpl 2 0 or later", "gpl 3 0 only", "gpl 3 0 or later", "lgpl 2 1 only", "lgpl 2 1 or later", "lgpl 3 0 only",
    "lgpl 3 0 or later", "agpl 3 0 only", "agpl 3 0 or later", "mpl 1 1", "mpl 2 0", "epl 1 0", "epl 2 0", "eupl 1 2",
    "cddl 1 0", "bsl 1 0", "zlib", "unlicense", "wtfpl", "cc0 1 0", "cc by 4 0", "cc by sa 4 0", "artistic 2 0",
    "ofl 1 1", "postgresql", "python 2 0", "ncsa", "ms pl", "upl 1 0", "osl 3 0", "afl 3 0",
)


def dotted(version: str) -> str:
    return version.replace(" ", ".")


def label_of(tag: str) -> str:
    """`gpl 2 0 or later` -> gpl-2.0-or-later."""
    out = tag.split(" ")
    text = out[0]
    for before, word in zip(out, out[1:], strict=False):
        text += ("." if before.isdigit() and word.isdigit() else "-") + word
    return text


def listed(block: str) -> list[tuple[str, str, str, float]]:
    rows = [[c.strip() for c in line.split(" | ")] for line in block.strip().splitlines()]
    return [(label, keyword, pattern, float(weight)) for label, keyword, pattern, weight in rows]


def rules() -> list[tuple[str, str, str, float]]:
    """(label, keyword, pattern, weight) in order of priority."""
    out = [(label_of(t), "spdx license identifier", f"spdx license identifier {t}", 1.0) for t in TAGS]
    out += listed(TEXTS)
    for label, name, keyword, versions in VERSIONED:
        for v in sorted(versions, key=len, reverse=True):
            number = v if " " in v else f"{v}(?: 0)?"
            said = rf"{GRANT}{name} (?:version |v )?v?{number}"
            later = r"(?: of the license)? or (?:at your option )?any later version"
            out.append((f"{label}-{dotted(v)}+", keyword, said + later, 1.0))
            out.append((f"{label}-{dotted(v)}", keyword, said, 0.9))
            out.append((f"{label}-{dotted(v)}", f"{label}v", rf"{label}v{number}", 0.8))
    for (short, long), v in product(CC_CLAUSES, CC_VERSIONS):
        label = f"cc-{short.replace(' ', '-')}-{dotted(v)}"
        out.append((label, "cc by", f"{GRANT}cc {short} {v}", 0.9))
        out.append((label, "creative commons", rf"creative commons {long}(?: {v}| licen[cs]e version {v}| {v} international)", 0.9))
    for short, long in CC_CLAUSES:
        label = f"cc-{short.replace(' ', '-')}"
        out.append((label, "cc by", f"cc {short}", 0.7))
        out.append((label, "creative commons", f"creative commons {long}", 0.7))
    out += [(label, keyword, GRANT + name, 0.8) for label, name, keyword, _ in VERSIONED]
    return out + listed(NAMES)
