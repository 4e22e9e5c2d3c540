"""Signature rules for license scans: an ordered table of regexes, each with a keyword, a label and a priority.

Each line of FAMILIES is written by hand: label, SPDX ids, keywords, names and web addresses. Every line gives a rule for
its SPDX tags, one for each of its addresses, and for the names that hold a keyword one for notices that grant something under
them and one for the bare names. Each line of BODIES is a passage of a license's own text, of which a rule is made that takes
line breaks and comment marks between its words. A rule's keyword is in all that its pattern matches, and so is its gate.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: label | SPDX ids (regex) | keywords in lower case, of which every name has one | names (regex) | addresses (regex)
FAMILIES = (
    r"agpl | AGPL-[13]\.0(?:-only|-or-later)? | affero | (?:gnu )?affero general public licen[cs]e | gnu\.org/licenses/agpl",
    r"lgpl | LGPL-(?:2\.[01]|3\.0)(?:-only|-or-later|\+)? | lesser | (?:gnu )?lesser general public licen[cs]e | gnu\.org/licenses/lgpl|gnu\.org/copyleft/lesser",
    r"lgpl | LGPL-2\.0\+ | library general | (?:gnu )?library general public licen[cs]e | gnu\.org/licenses/old-licenses/lgpl",
    r"gpl | GPL-[123]\.0(?:-only|-or-later|\+)? | general public | (?:gnu )?general public licen[cs]e | gnu\.org/licenses/(?:old-licenses/)?gpl|gnu\.org/copyleft/gpl",
    r"gfdl | GFDL-1\.[123](?:-only|-or-later)? | free documentation | (?:gnu )?free documentation licen[cs]e | gnu\.org/licenses/fdl|gnu\.org/copyleft/fdl",
    r"apache | Apache-(?:1\.[01]|2\.0) | apache | apache(?: software)? licen[cs]e | apache\.org/licenses",
    r"mit | MIT(?:-0)? | mit | mit(?:/expat| expat)? licen[cs]e|licen[cs]e:? mit | opensource\.org/licenses/mit|mit-license\.org",
    r"x11 | X11 | x11 | (?:mit/)?x11 licen[cs]e | xfree86\.org/current/license",
    r"bsd-2-clause | BSD-2-Clause(?:-Patent)? | bsd | (?:simplified|2-clause|two-clause|freebsd) bsd licen[cs]e|bsd 2-clause | opensource\.org/licenses/bsd-2-clause",
    r"bsd-3-clause | BSD-3-Clause(?:-Clear)? | bsd | (?:new|modified|revised|3-clause|three-clause) bsd licen[cs]e|bsd 3-clause | opensource\.org/licenses/bsd-3-clause",
    r"bsd-4-clause | BSD-4-Clause | bsd | (?:original|4-clause|four-clause) bsd licen[cs]e|bsd 4-clause | spdx\.org/licenses/bsd-4-clause",
    r"bsd | BSD | bsd | bsd(?:-style)? licen[cs]e | opensource\.org/licenses/bsd-license",
    r"isc | ISC | isc | isc licen[cs]e | opensource\.org/licenses/isc",
    r"mpl | MPL-(?:1\.[01]|2\.0) | mozilla | mozilla public licen[cs]e | mozilla\.org/(?:[a-z-]+/)?mpl",
    r"epl | EPL-[12]\.0 | eclipse | eclipse public licen[cs]e | eclipse\.org/(?:legal/epl|org/documents/epl)",
    r"edl | EDL-1\.0 | eclipse dist | eclipse distribution licen[cs]e | eclipse\.org/org/documents/edl",
    r"cddl | CDDL-1\.[01] | common development | common development and distribution licen[cs]e | opensource\.org/licenses/cddl",
    r"cpl | CPL-1\.0 | common public | common public licen[cs]e | opensource\.org/licenses/cpl",
    r"cpal | CPAL-1\.0 | common public attribution | common public attribution licen[cs]e | opensource\.org/licenses/cpal",
    r"eupl | EUPL-1\.[012] | european union | european union public licen[cs]e | joinup\.ec\.europa\.eu/[a-z/]*eupl",
    r"cecill | CECILL-(?:1\.[01]|2\.[01]|B|C) | cecill | cecill(?:-[bc])?(?: free software)? licen[cs]e | cecill\.info/licences",
    r"artistic | Artistic-(?:1\.0|2\.0) | artistic | artistic licen[cs]e | perlfoundation\.org/artistic|opensource\.org/licenses/artistic",
    r"boost | BSL-1\.0 | boost | boost software licen[cs]e | boost\.org/license",
    r"busl | BUSL-1\.1 | business source | business source licen[cs]e | mariadb\.com/bsl",
    r"zlib | Zlib | zlib | zlib(?:/libpng)? licen[cs]e | zlib\.net/zlib_license|opensource\.org/licenses/zlib",
    r"libpng | Libpng | libpng | libpng licen[cs]e | libpng\.org/pub/png/src/libpng-license",
    r"unlicense | Unlicense | unlicense | the unlicense|unlicense\.txt | unlicense\.org",
    r"wtfpl | WTFPL | wtfpl|do what the fuck | wtfpl|do what the fuck you want to public licen[cs]e | wtfpl\.net",
    r"0bsd | 0BSD | zero-clause | zero-clause bsd licen[cs]e|bsd zero-clause | opensource\.org/licenses/0bsd",
    r"python | PSF-2\.0|Python-2\.0 | python | python software foundation licen[cs]e | python\.org/(?:psf/license|download/releases/[0-9.]+/license)",
    r"php | PHP-3\.0?1? | php | php licen[cs]e | php\.net/license",
    r"ruby | Ruby | ruby | ruby licen[cs]e | ruby-lang\.org/[a-z/]*license",
    r"perl | Artistic-1\.0-Perl | same terms as perl | same terms as perl(?: itself)? | dev\.perl\.org/licenses",
    r"postgresql | PostgreSQL | postgresql | postgresql licen[cs]e | postgresql\.org/about/licence",
    r"openssl | OpenSSL | openssl | openssl licen[cs]e | openssl\.org/source/license",
    r"ofl | OFL-1\.[01] | open font | (?:sil )?open font licen[cs]e | scripts\.sil\.org/ofl",
    r"odbl | ODbL-1\.0 | open database | (?:odc )?open database licen[cs]e | opendatacommons\.org/licenses/odbl",
    r"odc-by | ODC-By-1\.0 | open data commons | open data commons attribution licen[cs]e | opendatacommons\.org/licenses/by",
    r"pddl | PDDL-1\.0 | public domain dedication | public domain dedication and licen[cs]e | opendatacommons\.org/licenses/pddl",
    r"cc0 | CC0-1\.0 | cc0 | cc0(?: 1\.0)?(?: universal)? | creativecommons\.org/publicdomain/zero",
    r"cc-by-nc-nd | CC-BY-NC-ND-[1-4]\.[05] | by-nc-nd | (?:cc|creative commons)[ -]by-nc-nd | creativecommons\.org/licenses/by-nc-nd",
    r"cc-by-nc-sa | CC-BY-NC-SA-[1-4]\.[05] | by-nc-sa | (?:cc|creative commons)[ -]by-nc-sa | creativecommons\.org/licenses/by-nc-sa",
    r"cc-by-nc | CC-BY-NC-[1-4]\.[05] | by-nc|noncommercial | (?:cc|creative commons)[ -]by-nc|creative commons attribution-noncommercial | creativecommons\.org/licenses/by-nc/",
    r"cc-by-nd | CC-BY-ND-[1-4]\.[05] | by-nd|noderiv | (?:cc|creative commons)[ -]by-nd|creative commons attribution-noderivs? | creativecommons\.org/licenses/by-nd",
    r"cc-by-sa | CC-BY-SA-[1-4]\.[05] | by-sa|attribution-share | (?:cc|creative commons)[ -]by-sa|creative commons attribution-share-?alike | creativecommons\.org/licenses/by-sa",
    r"cc-by | CC-BY-[1-4]\.[05] | creative commons | creative commons attribution(?: licen[cs]e)? | creativecommons\.org/licenses/by/",
    r"ms-pl | MS-PL | microsoft | microsoft public licen[cs]e | opensource\.org/licenses/ms-pl",
    r"ms-rl | MS-RL | microsoft | microsoft reciprocal licen[cs]e | opensource\.org/licenses/ms-rl",
    r"afl | AFL-[123]\.[0-2] | academic free | academic free licen[cs]e | opensource\.org/licenses/afl",
    r"osl | OSL-[123]\.[01] | open software | open software licen[cs]e | opensource\.org/licenses/osl",
    r"ecl | ECL-[12]\.0 | educational community | educational community licen[cs]e | opensource\.org/licenses/ecl",
    r"ncsa | NCSA | ncsa | (?:university of illinois/)?ncsa open source licen[cs]e | opensource\.org/licenses/ncsa",
    r"upl | UPL-1\.0 | universal permissive | universal permissive licen[cs]e | opensource\.org/licenses/upl",
    r"qpl | QPL-1\.0 | q public | q public licen[cs]e | opensource\.org/licenses/qpl",
    r"sleepycat | Sleepycat | sleepycat | sleepycat licen[cs]e | opensource\.org/licenses/sleepycat",
    r"vim | Vim | vim | vim licen[cs]e | vimdoc\.sourceforge\.net/[a-z/]*uganda",
    r"w3c | W3C | w3c | w3c software(?: notice and)? licen[cs]e | w3\.org/consortium/legal/[0-9/a-z-]*software",
    r"unicode | Unicode-(?:3\.0|DFS-201[56]) | unicode | unicode(?:, inc\.)? licen[cs]e | unicode\.org/(?:copyright|license)",
    r"sspl | SSPL-1\.0 | server side | server side public licen[cs]e | mongodb\.com/licensing/server-side",
    r"elastic | Elastic-2\.0 | elastic | elastic licen[cs]e | elastic\.co/licensing/elastic-license",
    r"polyform | PolyForm-[A-Za-z-]+-1\.0\.0 | polyform | polyform [a-z]+ licen[cs]e | polyformproject\.org/licenses",
    r"blueoak | BlueOak-1\.0\.0 | blue oak | blue oak model licen[cs]e | blueoakcouncil\.org/license",
    r"beerware | Beerware | beer-ware | the beer-ware licen[cs]e | people\.freebsd\.org/~phk",
    r"public-domain | public-domain | public domain | (?:released|placed|dedicated) (?:in|in)?to the public domain | creativecommons\.org/publicdomain/mark",
)

#: label | keyword, one of the words | a passage of the license's text
BODIES = (
    "mit | hereby | permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "isc | hereby | permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "isc | hereby | permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted",
    "bsd | redistribution | redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-3-clause | endorse | may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-4-clause | mentioning | all advertising materials mentioning features or use of this software must display the following acknowledgement",
    "apache | compliance | you may not use this file except in compliance with the license",
    "apache | warranties | distributed on an \"as is\" basis, without warranties or conditions of any kind, either express or implied",
    "gpl | redistribute | this program is free software: you can redistribute it and/or modify it under the terms of the gnu general public license",
    "gpl | merchantability | this program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability",
    "lgpl | redistribute | this library is free software; you can redistribute it and/or modify it under the terms of the gnu lesser general public license",
    "agpl | redistribute | this program is free software: you can redistribute it and/or modify it under the terms of the gnu affero general public license",
    "gfdl | distribute | permission is granted to copy, distribute and/or modify this document under the terms of the gnu free documentation license",
    "mpl | mozilla | this source code form is subject to the terms of the mozilla public license",
    "epl | accompanying | this program and the accompanying materials are made available under the terms of the eclipse public license",
    "cddl | cddl | the contents of this file are subject to the terms of the common development and distribution license (the \"license\"). cddl",
    "zlib | liable | this software is provided 'as-is', without any express or implied warranty. in no event will the authors be held liable",
    "zlib | misrepresented | the origin of this software must not be misrepresented; you must not claim that you wrote the original software",
    "unlicense | unencumbered | this is free and unencumbered software released into the public domain",
    "wtfpl | verbatim | everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed",
    "boost | hereby | permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation",
    "ncsa | hereby | permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"software\"), to deal with the software without restriction",
    "x11 | consortium | except as contained in this notice, the name of the x consortium shall not be used in advertising",
    "postgresql | hereby | permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted",
    "python | nonexclusive | psf hereby grants licensee a nonexclusive, royalty-free, world-wide license to reproduce, analyze, test, perform and/or display publicly",
    "openssl | openssl | this product includes software developed by the openssl project for use in the openssl toolkit",
    "php | php | this product includes php software, freely available from",
    "artistic | artistic | the intent of this document is to state the conditions under which a package may be copied, such that the copyright holder maintains some semblance of artistic control",
    "ms-pl | accept | if you use the software, you accept this license. if you do not accept the license, do not use the software",
    "cc0 | dedicated | the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights",
    "cc-by | attribution | you must give appropriate credit, provide a link to the license, and indicate if changes were made. attribution",
    "beerware | beer | if we meet some day, and you think this stuff is worth it, you can buy me a beer in return",
    "public-domain | disclaims | the author disclaims copyright to this source code",
    "public-domain | blessing | in place of a legal notice, here is a blessing",
    "elastic | hosted | you may not provide the software to third parties as a hosted or managed service",
    "sspl | functionality | if you make the functionality of the program or a modified version available to third parties as a service",
    "blueoak | infringe | each contributor licenses you to do everything with this software that would otherwise infringe that contributor's copyright",
    "upl | hereby | subject to the condition set forth below, permission is hereby granted to any person obtaining a copy of this software, associated documentation and/or data",
    "unicode | hereby | permission is hereby granted, free of charge, to any person obtaining a copy of the unicode data files and any associated documentation",
    "w3c | obtaining | by obtaining, using and/or copying this work, you (the licensee) agree that you have read, understood, and will comply with the following terms",
    "vim | charityware | vim is charityware. you can use and copy it as much as you like",
    "perl | perl | you can redistribute it and/or modify it under the same terms as perl itself",
)

#: Words of the base phrases, by label: they count wherever the words follow each other, whatever stands between them.
PHRASES = (("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"), ("mit", "mit license"))

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

#: Priorities: a detection inside another of at least its own priority is dropped.
TAG, BODY, GRANT, NAME, PHRASE = 5, 4, 3, 2, 1
SCORES = {TAG: 1.0, BODY: 0.98, GRANT: 0.95, NAME: 0.8, PHRASE: 0.6}


@dataclass(frozen=True)
class Rule:
    """keyword and gate are in each match, lower-cased. A few gates, many rules each, tell texts without any match; none given: the keyword."""

    keyword: str
    pattern: str
    label: str
    priority: int
    gate: str = ""


def _alternatives(pattern: str) -> list[str]:
    """A regex cut at the bars that stand in no brackets."""
    return re.findall(r"(?:\((?:[^()]|\([^()]*\))*\)|[^|()])+", pattern)


def _must(alternative: str) -> str:
    """A regex without its optional groups."""
    return re.sub(r"\(\?:[^()]*\)\?", "", alternative)


def _passage(text: str) -> str:
    """A passage as a regex: its words in any case, with whatever is no word between them, comment marks and line breaks too."""
    return f"(?i)(?<!{WORD})" + f"{GAP}+".join(re.findall("[a-z0-9]+", text)) + f"(?!{WORD})"


def gates(known: list[Rule]) -> tuple[str, ...]:
    """Literals of which every match of a rule, lower-cased, has one: a text without any has no detection."""
    found = {r.gate or r.keyword for r in known}
    return tuple(sorted(g for g in found if not any(x != g and x in g for x in found)))


def rules() -> list[Rule]:
    """All rules, in order: of equal detections the earlier rule stays."""
    out = []
    for line in FAMILIES:
        label, spdx, keywords, names, addresses = (x.strip() for x in line.split(" | "))
        version = r"(?:,? (?:version |v\.? ?)?\d+(?:\.\d+)*(?: or (?:any )?later(?: version)?)?)?"
        out.append(Rule("spdx", rf"(?i)\bSPDX-License-Identifier: *\(?(?:{spdx})(?![\w.+-])", label, TAG))
        for address in _alternatives(addresses):
            host = address.split("/")[0].replace("\\", "").lower()
            out.append(Rule(host, rf"(?i)https?://(?:www\.)?(?:{address})[^\s<>\"')]*", label, TAG, "http"))
        todo = _alternatives(names)
        for keyword in keywords.split("|"):
            own = [x for x in todo if keyword in _must(x)]
            todo = [x for x in todo if x not in own]
            some, gate = "|".join(own), "licen" if all("licen" in _must(x) for x in own) else keyword
            out.append(Rule(keyword, rf"(?i)\b(?:licen[cs]ed|released|distributed|available|published|covered|governed|provided) (?:under|by) (?:the |an? )?(?:terms of (?:the )?)?(?:{some}){version}", label, GRANT, gate))
            out.append(Rule(keyword, rf"(?i)(?<!{WORD})(?:{some}){version}(?!{WORD})", label, NAME, gate))
    for line in BODIES:
        label, keyword, passage = (x.strip() for x in line.split(" | "))
        out.append(Rule(keyword, _passage(passage), label, BODY))
    for label, words in PHRASES:
        first, *rest = words.split()
        out.append(Rule(first, f"(?i)(?<!{WORD}){first}" + "".join(f"{GAP}+{w}" for w in rest) + f"(?!{WORD})", label, PHRASE, "licen" if "license" in rest else first))
    return out


GATES = gates(rules())
