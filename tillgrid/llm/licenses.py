"""License scans by ordered signature rules.

A text becomes a sequence of lower-case words. A rule is a regular expression
over the words joined by single blanks and has keywords, one of which is a word
of whatever it matches; it is tried only when one of its keywords is among the
text's words, so the keywords save time and lose no match. Rules are ordered: earlier ones
have priority. A detection whose interval lies within another's is suppressed
(of equal intervals the earlier rule stays); of detections that overlap in part
the earlier rule stays. What is left gives labels.

The base phrases are reported apart from the rules and never suppressed. Null
and empty texts have no words and no labels; a text may hold any number of
detections, and repeated rows are scanned each.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from tillgrid.llm.common import Batches, batch_of, in_batches

BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Bytes of a word: digits, letters (A-Z lowered) and all of any sign beyond ASCII; the rest parts words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str  # over words joined by single blanks
    keywords: tuple[str, ...]  # one of them is a word of every match
    weight: float  # how sure a match is, 0 to 1


# Notices that name a license by its own wording: label, pattern, keywords (one for each alternative without the others'), weight.
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0(?: the license)?", "apache", 1.0),
    ("apache-2.0", "you may not use this (?:file|software|work) except in compliance with the license", "compliance", 0.9),
    ("apache-2.0", "distributed under the license is distributed on an as is basis", "basis", 0.9),
    ("apache-1.1", "this product includes software developed by the apache software foundation", "apache", 0.95),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby", 1.0),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies", "permission", 0.9),
    ("mit", "the software is provided as is without warranty of any kind express or implied", "warranty", 0.7),
    ("x11", "permission to use copy modify distribute and sell this software and its documentation for any purpose", "documentation", 0.8),
    ("isc", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee", "fee", 1.0),
    ("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided", "fee", 1.0),
    ("bsd-2-clause", "redistributions in binary form must reproduce the above copyright notice", "redistributions", 0.8),
    ("bsd-2-clause", "redistributions of source code must retain the above copyright notice", "redistributions", 0.8),
    ("bsd-3-clause", "neither the name of (?:\\S+ ){1,12}nor the names of its contributors may be used", "neither", 0.95),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display", "advertising", 0.95),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gnu", 1.0),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty", "hope", 0.8),
    ("gpl", "you should have received a copy of the gnu general public license", "gnu", 0.9),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", "library", 1.0),
    ("lgpl", "you should have received a copy of the gnu (?:lesser|library) general public license", "gnu", 0.95),
    ("agpl", "you should have received a copy of the gnu affero general public license", "affero", 1.0),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla", 1.0),
    ("mpl-2.0", "if a copy of the mpl was not distributed with this file", "mpl", 0.95),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public license version 1 1", "mozilla", 1.0),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", "eclipse", 1.0),
    ("epl-1.0", "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0", "eclipse", 1.0),
    ("cddl-1.0", "the contents of this file are subject to the terms of the common development and distribution license", "development", 1.0),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered", 1.0),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software", "anyone", 0.9),
    ("wtfpl", "do what the fuck you want to public license", "fuck", 1.0),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "implied", 0.9),
    ("zlib", "the origin of this software must not be misrepresented", "misrepresented", 1.0),
    ("bsl-1.0", "boost software license version 1 0", "boost", 1.0),
    ("artistic-2.0", "everyone is permitted to copy and distribute verbatim copies of this license document", "verbatim", 0.5),
    ("ofl-1.1", "this font software is licensed under the sil open font license version 1 1", "font", 1.0),
    ("cc0-1.0", "the person who associated a work with this deed has dedicated the work to the public domain", "deed", 1.0),
    ("cc0-1.0", "to the extent possible under law (?:\\S+ ){1,12}waived all copyright", "waived", 0.9),
    ("cc-by-nc-nd", "creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?", "commons", 1.0),
    ("cc-by-nc-sa", "creative commons attribution non ?commercial share ?alike", "commons", 1.0),
    ("cc-by-nc", "creative commons attribution non ?commercial", "commons", 0.95),
    ("cc-by-nd", "creative commons attribution no ?deriv(?:ative)?s?(?: works)?", "commons", 0.95),
    ("cc-by-sa", "creative commons attribution share ?alike", "commons", 0.95),
    ("cc-by", "creative commons attribution", "commons", 0.9),
    ("cc-by-nc-nd", "(?:cc )?by nc nd", "nd", 0.9),
    ("cc-by-nc-sa", "(?:cc )?by nc sa", "nc", 0.9),
    ("cc-by-sa", "cc by sa", "sa", 0.95),
    ("cc-by-nd", "cc by nd", "nd", 0.95),
    ("cc-by-nc", "cc by nc", "nc", 0.95),
    ("cc0-1.0", "cc0(?: 1 0)?", "cc0", 0.9),
    ("cc", "licensed under (?:a |the )?creative commons", "commons", 0.6),
    ("public-domain", "(?:released|placed|dedicated|is) (?:in|into|to) the public domain", "domain", 0.8),
    ("proprietary", "this (?:software|document|material|work) is (?:the )?confidential and proprietary", "proprietary", 0.9),
    ("proprietary", "unauthorized (?:copying|reproduction|use|distribution) of this (?:file|software|document|material|work)", "unauthorized", 0.9),
    ("proprietary", "may not be (?:copied|reproduced|redistributed|published|broadcast)(?: rewritten or redistributed)? without (?:the )?(?:prior |express )?(?:written )?permission", "permission", 0.9),
    ("proprietary", "no part of this (?:publication|book|document|work) may be reproduced", "reproduced", 0.95),
    ("proprietary", "for internal use only", "internal", 0.5),
    ("personal-use", "for personal (?:and |or )?(?:non ?commercial )?use only", "personal", 0.7),
    ("copyright", "copyright (?:c )?(?:\\d{4} )+(?:by )?\\S+", "copyright", 0.4),
    ("copyright", "(?:protected|governed) by copyright law", "copyright", 0.5),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license", "unless", 0.95),
    ("apache-2.0", "see the license for the specific language governing permissions and limitations under the license", "governing", 0.8),
    ("apache-2.0", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|patent) license", "irrevocable", 0.9),
    ("apache-1.1", "the end user documentation included with the redistribution if any must include the following acknowledge?ment", "redistribution", 0.95),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish", "merge", 0.95),
    ("mit", "the software is furnished to do so subject to the following conditions|persons to whom the software is furnished to do so", "furnished", 0.8),
    ("mit", "in no event shall the authors or copyright holders be liable for any claim damages or other liability", "holders", 0.7),
    ("mit-0", "permission is hereby granted free of charge to any person obtaining a copy of this software (?:\\S+ ){20,60}to do so the software is provided", "hereby", 0.9),
    ("x11", "except as contained in this notice the names? of (?:\\S+ ){1,12}shall not be used in advertising", "advertising", 0.95),
    ("isc", "provided that the above copyright notice and this permission notice appear in all copies", "appear", 0.8),
    ("ntp", "permission to use copy modify and distribute this software and its documentation for any purpose (?:with or without fee|and without fee) is hereby granted", "fee", 0.9),
    ("hpnd", "provided that the above copyright notice appears? in all copies and that both that copyright notice and this permission notice", "both", 0.9),
    ("bsd-2-clause", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution", 0.85),
    ("bsd-2-clause", "this software is provided by the (?:\\S+ ){1,12}as is and any express or implied warranties", "warranties", 0.7),
    ("bsd-3-clause", "the name of the (?:author|company|copyright holder) may not be used to endorse or promote products", "endorse", 0.9),
    ("bsd-3-clause", "may be used to endorse or promote products derived from this software without specific prior written permission", "endorse", 0.9),
    ("bsd-4-clause", "this product includes software developed by the university of california", "california", 0.95),
    ("bsd-3-clause-clear", "no express or implied licenses to any party s patent rights are granted by this license", "patent", 0.95),
    ("bsd-protection", "bsd protection license", "protection", 0.9),
    ("gpl", "either version \\d of the license or at your option any later version", "option", 0.8),
    ("gpl", "if not see (?:https? )?www gnu org licenses", "gnu", 0.7),
    ("gpl", "if not write to the free software foundation", "foundation", 0.8),
    ("gpl", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed", "verbatim", 0.8),
    ("gpl", "this program comes with absolutely no warranty", "absolutely", 0.7),
    ("gpl", "this is free software and you are welcome to redistribute it under certain conditions", "welcome", 0.9),
    ("gpl-2.0", "gnu general public license version 2 as published by the free software foundation", "gnu", 1.0),
    ("gpl-3.0", "gnu general public license version 3 as published by the free software foundation", "gnu", 1.0),
    ("gpl-classpath", "linking this library statically or dynamically with other modules is making a combined work", "statically", 0.95),
    ("gpl-font", "as a special exception if you create a document which uses this font", "exception", 0.95),
    ("gpl-bison", "as a special exception you may create a larger work that contains part or all of the bison parser skeleton", "bison", 0.95),
    ("gpl-autoconf", "as a special exception (?:\\S+ ){1,12}configuration script generated by autoconf", "autoconf", 0.9),
    ("gcc-exception", "gcc runtime library exception", "gcc", 0.95),
    ("lgpl", "this library is distributed in the hope that it will be useful but without any warranty", "hope", 0.9),
    ("agpl", "if you modify the program your modified version must prominently offer all users interacting with it remotely", "remotely", 0.95),
    ("sspl-1.0", "if you make the functionality of the program or a modified version available to third parties as a service", "functionality", 0.95),
    ("mpl-2.0", "you can obtain one at (?:https? )?mozilla org mpl 2 0", "mozilla", 0.95),
    ("mpl-2.0", "this source code form is incompatible with secondary licenses", "incompatible", 0.9),
    ("mpl-1.1", "software distributed under the license is distributed on an as is basis without warranty of any kind either express or implied see the license for the specific language governing rights", "governing", 0.9),
    ("npl-1.1", "the contents of this file are subject to the netscape public license", "netscape", 1.0),
    ("cpal-1.0", "the contents of this file are subject to the common public attribution license", "attribution", 1.0),
    ("epl", "this (?:program|content) (?:and the accompanying materials )?(?:is|are) (?:made available|provided) under the terms of the eclipse public license", "eclipse", 0.9),
    ("epl-2.0", "this source code may also be made available under the following secondary licenses", "secondary", 0.9),
    ("edl-1.0", "eclipse distribution license", "eclipse", 0.9),
    ("cpl-1.0", "this program and the accompanying materials are made available under the terms of the common public license", "common", 1.0),
    ("ipl-1.0", "the accompanying program is provided under the terms of this ibm public license", "ibm", 1.0),
    ("cddl-1.0", "you can obtain a copy of the license at (?:\\S+ ){1,8}cddl", "cddl", 0.9),
    ("cddl-1.0", "when distributing (?:covered code|the software) include this cddl header notice", "cddl", 0.95),
    ("eupl-1.2", "licensed under the eupl (?:version |v )?1 2", "eupl", 1.0),
    ("cecill-2.1", "this software is governed by the cecill license under french law", "cecill", 1.0),
    ("cecill-b", "governed by the cecill b license", "cecill", 1.0),
    ("unlicense", "in jurisdictions that recognize copyright laws the author or authors of this software dedicate", "jurisdictions", 0.95),
    ("unlicense", "for more information please refer to (?:https? )?unlicense org", "unlicense", 0.9),
    ("wtfpl", "this program is free software it comes without any warranty to the extent permitted by applicable law", "permitted", 0.8),
    ("beerware", "if we meet some day and you think this stuff is worth it you can buy me a beer", "beer", 1.0),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications", "anyone", 0.9),
    ("zlib", "altered source versions must be plainly marked as such", "altered", 1.0),
    ("libpng", "the png reference library is supplied as is", "png", 1.0),
    ("libtiff", "the names of sam leffler and silicon graphics may not be used", "leffler", 1.0),
    ("ijg", "this software is based in part on the work of the independent jpeg group", "jpeg", 1.0),
    ("freetype", "portions of this software are copyright (?:\\S+ ){1,8}the freetype project", "freetype", 0.95),
    ("curl", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is", "appear", 0.7),
    ("openssl", "this product includes software developed by the openssl project for use in the openssl toolkit", "openssl", 1.0),
    ("ssleay", "this product includes cryptographic software written by eric young", "cryptographic", 1.0),
    ("php-3.01", "this product includes php software freely available from", "php", 0.95),
    ("python-2.0", "psf is making python available to licensee on an as is basis", "licensee", 1.0),
    ("python-cnri", "cnri is making python (?:\\S+ ){0,6}available to licensee", "cnri", 1.0),
    ("ruby", "you may make and give away verbatim copies of the source form of the software without restriction", "verbatim", 0.9),
    ("artistic-1.0", "the intent of this document is to state the conditions under which a package may be copied", "intent", 1.0),
    ("perl", "you can redistribute it and or modify it under the same terms as perl itself", "perl", 1.0),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", "organization", 1.0),
    ("busl-1.1", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work", "licensor", 1.0),
    ("elastic-2.0", "you may not provide the software to third parties as a hosted or managed service", "hosted", 0.95),
    ("commons-clause", "without limiting other conditions in the license the grant of rights under the license will not include", "grant", 0.95),
    ("polyform", "polyform (?:noncommercial|small business|shield|strict|perimeter) license", "polyform", 1.0),
    ("ncsa", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software without restriction", "associated", 0.9),
    ("ms-pl", "this license governs use of the accompanying software if you use the software you accept this license", "governs", 0.95),
    ("ms-eula", "these license terms are an agreement between microsoft corporation", "microsoft", 0.95),
    ("jdom", "this software consists of voluntary contributions made by many individuals on behalf of", "voluntary", 0.8),
    ("json", "the software shall be used for good not evil", "evil", 1.0),
    ("unicode", "permission is hereby granted free of charge to any person obtaining a copy of the unicode data files", "unicode", 1.0),
    ("icu", "copyright (?:c )?(?:\\d{4} )+international business machines corporation and others", "machines", 0.9),
    ("w3c", "this software or document includes material copied from or derived from", "derived", 0.9),
    ("w3c", "by obtaining using and or copying this work you the licensee agree", "licensee", 0.9),
    ("ofl-1.1", "the font software may be sold as part of a larger software package but no copy", "font", 0.8),
    ("ofl-1.1", "this license is copied below and is also available with a faq at", "faq", 0.95),
    ("lppl", "this work may be distributed and or modified under the conditions of the latex project public license", "latex", 1.0),
    ("lppl", "this work has the lppl maintenance status", "lppl", 0.95),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", "gnu", 1.0),
    ("gfdl", "with no invariant sections no front cover texts and no back cover texts", "invariant", 1.0),
    ("opl", "this material may be distributed only subject to the terms and conditions set forth in the open publication license", "publication", 1.0),
    ("odbl-1.0", "is made available under the open database license", "database", 1.0),
    ("odbl-1.0", "any rights in individual contents of the database are licensed under the database contents license", "database", 0.95),
    ("openstreetmap", "(?:c )?openstreetmap contributors", "openstreetmap", 0.6),
    ("pddl-1.0", "made available under the public domain dedication and license", "dedication", 1.0),
    ("open-government", "contains public sector information licensed under the open government licen[cs]e", "sector", 1.0),
    ("us-government", "work of the (?:united states|u s) government", "government", 0.8),
    ("us-government", "is not subject to copyright protection (?:in|within) the united states", "protection", 0.8),
    ("public-domain", "no rights reserved", "rights", 0.6),
    ("public-domain", "(?:has|have) waived all copyright and related or neighboring rights", "neighboring", 0.95),
    ("public-domain", "the authors? disclaims? (?:all )?copyright (?:to|in) this (?:source code|software|work)", "disclaims disclaim", 0.95),
    ("gutenberg", "this ebook is for the use of anyone anywhere", "ebook", 0.95),
    ("gutenberg", "you may copy it give it away or re use it under the terms of the project gutenberg license", "gutenberg", 1.0),
    ("cc-by", "this is an open access article distributed under the terms of the creative commons attribution", "commons", 0.95),
    ("cc-by-sa", "text is available under the creative commons attribution share ?alike", "commons", 0.95),
    ("cc", "some rights reserved", "reserved", 0.4),
    ("proprietary", "(?:trade secrets?|confidential information) of (?:\\S+ ){1,8}(?:and|is) (?:protected|strictly confidential)", "trade confidential", 0.8),
    ("proprietary", "you may not (?:reverse engineer|decompile|disassemble)", "reverse decompile disassemble", 0.8),
    ("proprietary", "this (?:software|program) is (?:licensed|licenced) not sold", "sold", 0.9),
    ("proprietary", "end user licen[cs]e agreement", "agreement", 0.6),
    ("proprietary", "(?:reproduction|duplication|republication) (?:in whole or in part )?without (?:prior |written |express )*permission is (?:strictly )?prohibited", "prohibited", 0.9),
    ("personal-use", "free for (?:personal|non ?commercial|private|educational) use", "free", 0.6),
    ("academic-use", "for (?:academic|research|educational) (?:use|purposes) only", "academic research educational", 0.6),
    ("evaluation", "for evaluation (?:use|purposes) only", "evaluation", 0.8),
    ("copyright", "all trademarks (?:and registered trademarks )?are (?:the )?property of their respective owners", "respective", 0.3),
    ("terms", "by using this (?:site|website|service) you agree to (?:the|our) terms", "terms", 0.3),
)

# Licenses that texts name: label, name as words (a pattern), the keywords in it.
NAMES = (
    ("apache-2.0", "apache (?:software )?license (?:version |v )?2(?: 0)?", "apache"),
    ("apache-1.1", "apache (?:software )?license (?:version |v )?1 1", "apache"),
    ("mit", "(?:mit|expat) license", "license"),
    ("bsd-2-clause", "(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd)(?: license)?", "bsd freebsd"),
    ("bsd-3-clause", "(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)(?: license)?", "bsd"),
    ("bsd-4-clause", "(?:original bsd|bsd 4 clause|4 clause bsd)(?: license)?", "bsd"),
    ("gpl-2.0", "(?:gnu )?general public license (?:version |v )?2(?: 0)?", "general"),
    ("gpl-3.0", "(?:gnu )?general public license (?:version |v )?3(?: 0)?", "general"),
    ("lgpl-2.1", "(?:gnu )?lesser general public license (?:version |v )?2 1", "lesser"),
    ("lgpl-3.0", "(?:gnu )?lesser general public license (?:version |v )?3(?: 0)?", "lesser"),
    ("agpl-3.0", "(?:gnu )?affero general public license(?: version| v)?(?: 3)?(?: 0)?", "affero"),
    ("mpl-2.0", "mozilla public license (?:version |v )?2(?: 0)?", "mozilla"),
    ("mpl-1.1", "mozilla public license (?:version |v )?1 1", "mozilla"),
    ("epl-2.0", "eclipse public license (?:version |v )?2(?: 0)?", "eclipse"),
    ("epl-1.0", "eclipse public license (?:version |v )?1(?: 0)?", "eclipse"),
    ("cddl-1.0", "common development and distribution license", "development"),
    ("cpl-1.0", "common public license(?: version)?(?: 1 0)?", "common"),
    ("eupl-1.2", "european union public licen[cs]e(?: version| v)?(?: 1 2)?", "european"),
    ("isc", "isc license", "isc"),
    ("zlib", "zlib(?: libpng)? license", "zlib"),
    ("bsl-1.0", "boost software license", "boost"),
    ("busl-1.1", "business source license", "business"),
    ("artistic-2.0", "artistic license(?: version)?(?: 2 0)?", "artistic"),
    ("ofl-1.1", "(?:sil )?open font license", "font"),
    ("odbl-1.0", "open (?:data commons open )?database license", "database"),
    ("odc-by-1.0", "open data commons attribution license", "attribution"),
    ("pddl-1.0", "public domain dedication and license", "dedication"),
    ("unlicense", "the unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("psf-2.0", "python software foundation license", "python"),
    ("php-3.01", "php license", "php"),
    ("ruby", "ruby license", "ruby"),
    ("ms-pl", "microsoft public license", "microsoft"),
    ("ms-rl", "microsoft reciprocal license", "reciprocal"),
    ("osl-3.0", "open software license", "open"),
    ("afl-3.0", "academic free license", "academic"),
    ("ncsa", "(?:university of illinois )?ncsa open source license", "ncsa"),
    ("postgresql", "postgresql license", "postgresql"),
    ("openssl", "openssl license", "openssl"),
    ("sspl-1.0", "server side public license", "server"),
    ("elastic-2.0", "elastic license(?: 2 0)?", "elastic"),
    ("gfdl-1.3", "(?:gnu )?free documentation license", "documentation"),
    ("cc-by-4.0", "creative commons attribution 4 0(?: international)?", "commons"),
    ("cc-by-sa-4.0", "creative commons attribution share ?alike 4 0(?: international)?", "commons"),
    ("cc-by-3.0", "creative commons attribution 3 0(?: unported)?", "commons"),
    ("open-government", "open government licen[cs]e", "government"),
    ("gpl", "gnu general public license", "gnu"),
    ("lgpl", "gnu (?:lesser|library) general public license", "gnu"),
    ("vim", "vim license", "vim"),
)

# Identifiers as words, as in SPDX tags and file headers; the first word is the keyword.
IDENTIFIERS = (
    "0bsd", "afl 3 0", "agpl 3 0", "apache 1 1", "apache 2 0", "artistic 1 0", "artistic 2 0", "bsd 2 clause", "bsd 3 clause",
    "bsd 4 clause", "bsl 1 0", "busl 1 1", "cc0 1 0", "cc by 3 0", "cc by 4 0", "cc by nc 4 0", "cc by nc nd 4 0", "cc by nc sa 4 0",
    "cc by nd 4 0", "cc by sa 3 0", "cc by sa 4 0", "cddl 1 0", "cecill 2 1", "cpl 1 0", "ecl 2 0", "epl 1 0", "epl 2 0", "eupl 1 2",
    "gfdl 1 3", "gpl 1 0", "gpl 2 0", "gpl 3 0", "ipl 1 0", "isc", "lgpl 2 0", "lgpl 2 1", "lgpl 3 0", "lppl 1 3c", "mit", "mit 0",
    "mpl 1 1", "mpl 2 0", "ms pl", "ms rl", "mulanpsl 2 0", "ncsa", "odbl 1 0", "ofl 1 1", "osl 3 0", "pddl 1 0", "php 3 01",
    "postgresql", "python 2 0", "ruby", "sspl 1 0", "unlicense", "upl 1 0", "vim", "w3c", "wtfpl", "x11", "zlib", "zpl 2 1",
)


def label_of(identifier: str) -> str:
    """``apache 2 0`` is the label ``apache-2.0``."""
    return re.sub(r"(?<=\d)-(?=\d)", ".", identifier.replace(" ", "-"))


def rules() -> list[Rule]:
    """All rules in order of priority: tags, notices, grants that name a license, mentions of a name, links."""
    out = [
        Rule(label_of(i), f"spdx license identifier {i}(?: only| or later)?", ("spdx",), 1.0)
        for i in sorted(IDENTIFIERS, key=len, reverse=True)
    ]
    out += [Rule(label, pattern, tuple(keywords.split()), weight) for label, pattern, keywords, weight in NOTICES]
    grant = "(?:licensed|released|distributed|available|published|provided) under (?:the terms of )?(?:the )?(?:gnu )?"
    out += [Rule(label, grant + name, tuple(keywords.split()), 0.95) for label, name, keywords in NAMES]
    out += [Rule(label_of(i), grant + i + "(?: licen[cs]e)?", (i.split()[0],), 0.8) for i in sorted(IDENTIFIERS, key=len, reverse=True)]
    out += [Rule(label, name, tuple(keywords.split()), 0.6) for label, name, keywords in NAMES]
    out += [Rule(label_of(i), f"licen[cs]e {i}", (i.split()[0],), 0.5) for i in sorted(IDENTIFIERS, key=len, reverse=True)]
    sites = (
        ("apache-2.0", "apache org licenses license 2 0", "apache"), ("mit", "opensource org licenses mit(?: license php)?", "opensource"),
        ("gpl", "gnu org licenses gpl(?: \\d 0)?", "gnu"), ("lgpl", "gnu org licenses lgpl(?: \\d \\d)?", "gnu"),
        ("agpl", "gnu org licenses agpl(?: 3 0)?", "gnu"), ("cc-by", "creativecommons org licenses by \\d 0", "creativecommons"),
        ("cc-by-sa", "creativecommons org licenses by sa \\d 0", "creativecommons"), ("cc-by-nc", "creativecommons org licenses by nc \\d 0", "creativecommons"),
        ("cc-by-nd", "creativecommons org licenses by nd \\d 0", "creativecommons"), ("cc-by-nc-sa", "creativecommons org licenses by nc sa \\d 0", "creativecommons"),
        ("cc-by-nc-nd", "creativecommons org licenses by nc nd \\d 0", "creativecommons"), ("cc0-1.0", "creativecommons org publicdomain zero 1 0", "creativecommons"),
        ("mpl-2.0", "mozilla org mpl 2 0", "mozilla"), ("epl", "eclipse org legal epl(?: v\\d)?", "eclipse"), ("unlicense", "unlicense org", "unlicense"),
    )
    out += [Rule(label, pattern, (keyword,), 0.9) for label, pattern, keyword in sites]
    out += [Rule(label, phrase, (phrase.split()[-1],), 0.5) for phrase, label in BASE]
    return out


class Scanner:
    def __init__(self, ordered: list[Rule]):
        self.rules = [(r, re.compile(rf"(?<![^ ])(?:{r.pattern})(?![^ ])".encode())) for r in ordered]
        self.by_keyword: dict[bytes, list[int]] = {}
        for at, rule in enumerate(ordered):
            for keyword in rule.keywords:
                self.by_keyword.setdefault(keyword.encode(), []).append(at)
        self.keywords = frozenset(self.by_keyword)
        self.base = [(phrase.encode(), phrase.split()[-1].encode(), label) for phrase, label in BASE]

    def detections(self, line: bytes, found: set[bytes]) -> list[tuple[int, int, int]]:
        """(rule, start, end) that no other suppresses, in order of priority."""
        tried = sorted({at for word in found for at in self.by_keyword[word]})
        hits = [(at, *m.span()) for at in tried for m in self.rules[at][1].finditer(line)]
        return suppressed(hits)

    def scan(self, text: str | None) -> tuple:
        words = text.encode().translate(WORD_BYTES).split() if text else []
        present = self.keywords.intersection(words)
        if not present:
            return len(words), 0, None, None, "", "", 0.0
        line = b" ".join(words)
        starts = [0]
        for word in words:
            starts.append(starts[-1] + len(word) + 1)
        at, base = [], set()
        for phrase, keyword, label in self.base:
            if keyword in present:
                for m in re.finditer(rb"(?<![^ ])(?=" + phrase + rb"(?![^ ]))", line):
                    at.append(bisect_right(starts, m.start()) - 1)
                    base.add(label)
        kept = self.detections(line, present)
        labels = base | {self.rules[rule][0].label for rule, _, _ in kept}
        doubt = 1.0
        for label in sorted(labels):
            doubt *= 1 - max([self.rules[rule][0].weight for rule, _, _ in kept if self.rules[rule][0].label == label], default=0.5)
        return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), 1 - doubt


def suppressed(hits: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Drop what lies within another detection, then, of those that still overlap, what has less priority.

    In a sweep by start (longer first, then priority) an interval lies within
    an earlier one exactly if it ends no later than the furthest end so far.
    What is left has ascending starts and ends, so overlaps are between
    neighbours of the ones accepted.
    """
    free, furthest = [], -1
    for rule, start, end in sorted(hits, key=lambda h: (h[1], -h[2], h[0])):
        if end > furthest:
            free.append((rule, start, end))
            furthest = end
    taken: list[tuple[int, int]] = []
    kept = []
    for rule, start, end in sorted(free):
        at = bisect_right(taken, (start, end))
        if (at and taken[at - 1][1] > start) or (at < len(taken) and taken[at][0] < end):
            continue
        taken.insert(at, (start, end))
        kept.append((rule, start, end))
    return kept


RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: counts and labels; one pass over whole texts, no shuffle."""

    def run(batches: Batches) -> Batches:
        scanner = Scanner(rules())
        for batch in batches:
            rows = [scanner.scan(t) for t in batch.column(1).to_pylist()]
            yield batch_of(RESULT, [batch.column(0), *map(list, zip(*rows))] if rows else [[]] * len(RESULT))

    kind = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return in_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), run, kind)
