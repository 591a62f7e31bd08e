"""Signature rules for license texts, in order.

Rules match normalised words (lower case, one space between them). Each names the
word it starts with, a keyword that is part of whatever it matches, and a
priority: 0 for declared identifiers, 1 for grants, 2 for web addresses, 3 for
titles, 4 for bare names.
"""

from __future__ import annotations

from dataclasses import dataclass

# Matched phrases that always count, with their labels. Fixed values.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

# Label, identifier as words, name as a pattern over words, a keyword of both, the
# words a name can start with.
LICENSES = [
    ("mit-license", "mit", "mit license", "mit", "mit"),
    ("mit-0", "mit 0", "mit no attribution license", "mit", "mit"),
    ("apache-2.0", "apache 2 0", "apache(?: software)? license(?: version)? 2(?: 0)?", "apache", "apache"),
    ("apache-1.1", "apache 1 1", "apache(?: software)? license(?: version)? 1 1", "apache", "apache"),
    ("gpl-2.0", "gpl 2 0(?: only| or later)?", "(?:gnu )?(?:gpl|general public license)(?: gpl)?(?: version| v)? ?v?2(?: 0)?", "2", "gnu gpl general gplv2 gpl2"),
    ("gpl-3.0", "gpl 3 0(?: only| or later)?", "(?:gnu )?(?:gpl|general public license)(?: gpl)?(?: version| v)? ?v?3(?: 0)?", "3", "gnu gpl general gplv3 gpl3"),
    ("lgpl-2.1", "lgpl 2 1(?: only| or later)?", "(?:gnu )?(?:lgpl|(?:lesser|library) general public license)(?: version| v)? ?v?2 1", "1", "gnu lgpl lesser library lgplv2 lgpl2"),
    ("lgpl-3.0", "lgpl 3 0(?: only| or later)?", "(?:gnu )?(?:lgpl|lesser general public license)(?: version| v)? ?v?3(?: 0)?", "3", "gnu lgpl lesser lgplv3 lgpl3"),
    ("agpl-3.0", "agpl 3 0(?: only| or later)?", "(?:gnu )?(?:agpl|affero general public license)(?: version| v)? ?v?3(?: 0)?", "3", "gnu agpl affero agplv3 agpl3"),
    ("bsd-2-clause", "bsd 2 clause", "(?:2 clause bsd|simplified bsd|bsd 2 clause)(?: license)?", "bsd", "2 simplified bsd"),
    ("bsd-3-clause", "bsd 3 clause", "(?:3 clause bsd|new bsd|modified bsd|bsd 3 clause)(?: license)?", "bsd", "3 new modified bsd"),
    ("0bsd", "0bsd", "(?:zero clause bsd|0 clause bsd)(?: license)?", "bsd", "zero 0"),
    ("isc", "isc", "isc license", "isc", "isc"),
    ("mpl-2.0", "mpl 2 0", "mozilla public license(?: version| v)? ?v?2(?: 0)?", "2", "mozilla"),
    ("mpl-1.1", "mpl 1 1", "mozilla public license(?: version| v)? ?v?1 1", "1", "mozilla"),
    ("epl-1.0", "epl 1 0", "eclipse public license(?: version| v)? ?v?1(?: 0)?", "1", "eclipse"),
    ("epl-2.0", "epl 2 0", "eclipse public license(?: version| v)? ?v?2(?: 0)?", "2", "eclipse"),
    ("eupl-1.2", "eupl 1 2", "european union public licen[cs]e(?: version| v)? ?v?1 2", "2", "european"),
    ("cddl-1.0", "cddl 1 0", "common development and distribution license(?: version)? 1(?: 0)?", "1", "common"),
    ("artistic-2.0", "artistic 2 0", "artistic license(?: version)? 2(?: 0)?", "artistic", "artistic"),
    ("bsl-1.0", "bsl 1 0", "boost software license(?: version)? 1(?: 0)?", "boost", "boost"),
    ("zlib", "zlib", "zlib(?: libpng)? license", "zlib", "zlib"),
    ("unlicense", "unlicense", "unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl(?: license)?", "wtfpl", "wtfpl"),
    ("python-2.0", "python 2 0", "python(?: software foundation)? license(?: version 2)?", "python", "python"),
    ("postgresql", "postgresql", "postgresql license", "postgresql", "postgresql"),
    ("openssl", "openssl", "openssl license", "openssl", "openssl"),
    ("ofl-1.1", "ofl 1 1", "sil open font license(?: version)? 1 1", "font", "sil"),
    ("odbl-1.0", "odbl 1 0", "open (?:data commons open )?database license(?: version 1 0)?", "database", "open"),
    ("cc0-1.0", "cc0 1 0", "(?:creative commons )?cc0(?: 1 0)?(?: universal)?", "cc0", "creative cc0"),
    ("cc-by-4.0", "cc by 4 0", "(?:creative commons attribution|cc by)(?: license)? 4 0", "4", "creative cc"),
    ("cc-by-3.0", "cc by 3 0", "(?:creative commons attribution|cc by)(?: license)? 3 0", "3", "creative cc"),
    ("cc-by-sa-4.0", "cc by sa 4 0", "(?:creative commons attribution share ?alike|cc by sa)(?: license)? 4 0", "4", "creative cc"),
    ("cc-by-sa-3.0", "cc by sa 3 0", "(?:creative commons attribution share ?alike|cc by sa)(?: license)? 3 0", "3", "creative cc"),
    ("cc-by-nc-4.0", "cc by nc 4 0", "(?:creative commons attribution non ?commercial|cc by nc)(?: license)? 4 0", "4", "creative cc"),
    ("cc-by-nc-sa-4.0", "cc by nc sa 4 0", "(?:creative commons attribution non ?commercial share ?alike|cc by nc sa)(?: license)? 4 0", "4", "creative cc"),
    ("cc-by-nc-nd-4.0", "cc by nc nd 4 0", "(?:creative commons attribution non ?commercial no ?deriv(?:ative)?s|cc by nc nd)(?: license)? 4 0", "4", "creative cc"),
    ("cc-by-nd-4.0", "cc by nd 4 0", "(?:creative commons attribution no ?deriv(?:ative)?s|cc by nd)(?: license)? 4 0", "4", "creative cc"),
    ("proprietary", "licenseref proprietary", "proprietary license", "proprietary", "proprietary"),
    ("public-domain", "licenseref public domain", "public domain", "domain", "public"),
]

# How a name is used: priority, first word, what stands around it, confidence.
FORMS = [
    (0, "spdx", "spdx license identifier {id}", 1.0),
    (0, "license", "license(?: id| identifier)? {id}", 0.95),
    (1, "licensed", "licensed under (?:the |a )?(?:terms of (?:the )?)?{name}", 0.95),
    (1, "released", "released (?:under|into) (?:the |a )?(?:terms of (?:the )?)?{name}", 0.95),
    (1, "distributed", "distributed under (?:the |a )?(?:terms of (?:the )?)?{name}", 0.95),
    (1, "available", "available under (?:the |a )?(?:terms of (?:the )?)?{name}", 0.9),
    (1, "governed", "governed by (?:the |a )?(?:terms of (?:the )?)?{name}", 0.9),
]

# Rules of one license each: priority, first word, pattern, keyword, label, confidence.
SINGLE = [
    (2, "www", "www apache org licenses license 2 0", "licenses", "apache-2.0", 0.9),
    (2, "opensource", "opensource org licenses? mit", "mit", "mit-license", 0.9),
    (2, "opensource", "opensource org licenses? bsd 3 clause", "bsd", "bsd-3-clause", 0.9),
    (2, "creativecommons", "creativecommons org licenses by 4 0", "by", "cc-by-4.0", 0.9),
    (2, "creativecommons", "creativecommons org licenses by sa 4 0", "sa", "cc-by-sa-4.0", 0.9),
    (2, "creativecommons", "creativecommons org publicdomain zero 1 0", "zero", "cc0-1.0", 0.9),
    (2, "www", "www gnu org licenses gpl 3 0", "gpl", "gpl-3.0", 0.9),
    (2, "www", "www gnu org licenses gpl 2 0", "gpl", "gpl-2.0", 0.9),
    (1, "permission", "permission is hereby granted free of charge to any person", "granted", "mit-license", 0.9),
    (1, "permission", "permission to use copy modify and or distribute this software", "distribute", "isc", 0.85),
    (1, "redistribution", "redistribution and use in source and binary forms", "binary", "bsd", 0.85),
    (1, "all", "all rights reserved", "rights", "all-rights-reserved", 0.6),
    (1, "this", "this is free and unencumbered software", "unencumbered", "unlicense", 0.9),
    (3, "gnu", "gnu lesser general public license", "lesser", "lgpl", 0.7),
    (3, "gnu", "gnu affero general public license", "affero", "agpl", 0.7),
    (3, "creative", "creative commons(?: license)?", "commons", "creative-commons", 0.6),
]

# Sentences of license texts, notices above files and remarks of package metadata,
# each written for itself: priority, first word, pattern, keyword, label, confidence.
SENTENCES = [
    # Permissive texts.
    (1, "the", "the above copyright notice and this permission notice shall be included in all copies or substantial portions", "substantial portions", "mit-license", 0.9),
    (1, "the", "the software is provided as is without warranty of any kind express or implied", "as is", "as-is-notice", 0.5),
    (1, "to", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish", "without restriction", "mit-license", 0.9),
    (1, "furnished", "furnished to do so subject to the following conditions", "furnished", "mit-license", 0.6),
    (1, "permission", "permission is hereby granted free of charge to any person obtaining a copy of the fonts?", "the font", "font-license", 0.85),
    (1, "provided", "provided that the above copyright notice and this permission notice appear in all copies", "permission notice", "isc", 0.85),
    (1, "the", "the software is provided as is and the author disclaims all warranties with regard to this software", "author disclaims", "isc", 0.85),
    (1, "redistributions", "redistributions of source code must retain the above copyright notice", "retain", "bsd", 0.85),
    (1, "redistributions", "redistributions in binary form must reproduce the above copyright notice", "reproduce", "bsd", 0.85),
    (1, "neither", "neither the name of (?:the )?(?:copyright holder|author|university|company|organization) nor the names of its contributors", "contributors", "bsd-3-clause", 0.9),
    (1, "neither", "neither the name of the university nor the names of its contributors may be used", "university", "bsd-3-clause", 0.9),
    (1, "all", "all advertising materials mentioning features or use of this software must display the following acknowledgement", "advertising", "bsd-4-clause", 0.95),
    (1, "this", "this software is provided by the copyright holders and contributors as is", "holders", "bsd", 0.8),
    (1, "this", "this software is provided by the regents and contributors as is", "regents", "bsd", 0.85),
    (1, "altered", "altered source versions must be plainly marked as such", "plainly marked", "zlib", 0.9),
    (1, "the", "the origin of this software must not be misrepresented", "misrepresented", "zlib", 0.9),
    (1, "this", "this software is provided as is without any express or implied warranty in no event", "in no event", "zlib", 0.8),
    (1, "permission", "permission is granted to anyone to use this software for any purpose including commercial applications", "anyone", "zlib", 0.85),
    (1, "permission", "permission is hereby granted without written agreement and without license or royalty fees", "royalty fees", "bsd-uc", 0.85),
    (1, "permission", "permission to use copy modify and distribute this software and its documentation for any purpose", "documentation", "hpnd", 0.85),
    (1, "permission", "permission to use copy modify and distribute this software for any purpose with or without fee", "with or without fee", "isc", 0.9),
    (1, "boost", "boost software license version 1 0 august 17th 2003", "17th", "bsl-1.0", 0.95),
    (1, "permission", "permission is hereby granted free of charge to any person or organization obtaining a copy", "organization", "bsl-1.0", 0.9),
    (1, "anyone", "anyone is free to copy modify publish use compile sell or distribute this software", "compile", "unlicense", 0.9),
    (1, "everyone", "everyone is permitted to copy and distribute verbatim or modified copies of this license document", "modified copies", "wtfpl", 0.9),
    (1, "you", "you just do what the fuck you want to", "just do", "wtfpl", 0.95),
    (1, "everyone", "everyone is permitted to copy and distribute verbatim copies of this license document", "verbatim copies", "gpl", 0.7),
    (1, "as", "as long as you retain this notice you can do whatever you want with this stuff", "this stuff", "beerware", 0.95),
    (3, "the", "the beer ware license", "beer ware", "beerware", 0.9),
    (3, "beerware", "beerware license", "beerware", "beerware", 0.85),
    (3, "fair", "fair license", "fair", "fair", 0.5),
    (3, "the", "the happy bunny license", "bunny", "happy-bunny", 0.9),
    (3, "universal", "universal permissive license(?: version 1 0| v1 0)?", "universal", "upl-1.0", 0.85),
    (3, "blue", "blue oak model license(?: 1 0 0)?", "blue oak", "blueoak-1.0.0", 0.9),
    (3, "academic", "academic free license(?: version| v)? ?v?3 0", "academic", "afl-3.0", 0.9),
    (3, "educational", "educational community license(?: version)? 2 0", "educational", "ecl-2.0", 0.9),
    (3, "ncsa", "ncsa open source license", "ncsa", "ncsa", 0.85),
    (3, "university", "university of illinois ncsa open source license", "illinois", "ncsa", 0.95),
    (3, "the", "the php license version 3 0", "php", "php-3.0", 0.9),
    (3, "php", "php license version 3 01?", "php", "php-3.0", 0.9),
    (3, "zend", "zend (?:engine )?license", "zend", "zend", 0.8),
    (3, "ruby", "ruby license", "ruby", "ruby", 0.7),
    (3, "w3c", "w3c software(?: and document)? (?:notice and )?license", "w3c", "w3c", 0.9),
    (3, "unicode", "unicode license (?:agreement|v3)", "unicode", "unicode", 0.85),
    (3, "ijg", "ijg license", "ijg", "ijg", 0.8),
    (1, "this", "this software is based in part on the work of the independent jpeg group", "jpeg", "ijg", 0.95),
    (3, "libpng", "libpng license(?: version 2)?", "libpng", "libpng", 0.85),
    (3, "curl", "curl license", "curl", "curl", 0.8),
    (3, "x11", "x11 license", "x11", "x11", 0.85),
    (3, "expat", "expat license", "expat", "mit-license", 0.85),
    (3, "vim", "vim license", "vim", "vim", 0.8),
    (3, "ntp", "ntp license", "ntp", "ntp", 0.8),
    (3, "tcl", "tcl tk license", "tcl", "tcl", 0.8),
    (3, "bouncy", "bouncy castle licen[cs]e", "bouncy", "mit-license", 0.8),
    # Apache.
    (1, "licensed", "licensed under the apache license version 2 0 the license you may not use this file except in compliance", "in compliance", "apache-2.0", 1.0),
    (1, "you", "you may not use this file except in compliance with the license", "in compliance", "apache-2.0", 0.85),
    (1, "you", "you may obtain a copy of the license at", "obtain a copy", "apache-2.0", 0.6),
    (1, "unless", "unless required by applicable law or agreed to in writing software distributed under the license", "agreed to in writing", "apache-2.0", 0.9),
    (1, "distributed", "distributed under the license is distributed on an as is basis without warranties or conditions", "as is basis", "apache-2.0", 0.9),
    (1, "see", "see the license for the specific language governing permissions and limitations under the license", "governing permissions", "apache-2.0", 0.9),
    (1, "licensed", "licensed to the apache software foundation asf under one or more contributor license agreements", "asf", "apache-2.0", 0.95),
    (1, "the", "the asf licenses this file to you under the apache license version 2 0", "asf", "apache-2.0", 1.0),
    (1, "this", "this product includes software developed (?:by|at) the apache software foundation", "apache software", "apache", 0.7),
    (3, "apache", "apache license version 2 0 january 2004", "january", "apache-2.0", 1.0),
    (3, "apache", "apache 2 0 licen[cs]ed?", "apache", "apache-2.0", 0.9),
    (3, "apache2", "apache2 licen[cs]ed?", "apache2", "apache-2.0", 0.85),
    (3, "asl", "asl 2 0", "asl", "apache-2.0", 0.6),
    # The family of the general public license.
    (1, "this", "this program is free software you can redistribute it and or modify it under the terms", "free software", "gpl", 0.9),
    (1, "this", "this library is free software you can redistribute it and or modify it under the terms", "library", "lgpl", 0.95),
    (1, "either", "either version 2 of the license or at your option any later version", "version 2", "gpl-2.0", 0.85),
    (1, "either", "either version 3 of the license or at your option any later version", "version 3", "gpl-3.0", 0.85),
    (1, "either", "either version 2 1 of the license or at your option any later version", "version 2 1", "lgpl-2.1", 0.9),
    (1, "as", "as published by the free software foundation version 2", "version 2", "gpl-2.0", 0.8),
    (1, "as", "as published by the free software foundation version 3", "version 3", "gpl-3.0", 0.8),
    (1, "this", "this program is distributed in the hope that it will be useful but without any warranty", "hope", "gpl", 0.85),
    (1, "this", "this library is distributed in the hope that it will be useful but without any warranty", "hope", "lgpl", 0.9),
    (1, "without", "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu", "gnu", "gpl", 0.8),
    (1, "you", "you should have received a copy of the gnu general public license", "received", "gpl", 0.9),
    (1, "you", "you should have received a copy of the gnu lesser general public license", "lesser", "lgpl", 0.95),
    (1, "you", "you should have received a copy of the gnu library general public license", "library", "lgpl", 0.95),
    (1, "you", "you should have received a copy of the gnu affero general public license", "affero", "agpl", 0.95),
    (1, "permission", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation", "this document", "gfdl", 0.95),
    (3, "gnu", "gnu free documentation license(?: version 1 [123])?", "documentation", "gfdl", 0.9),
    (3, "gfdl", "gfdl(?: 1 [123])?", "gfdl", "gfdl", 0.7),
    (3, "gnu", "gnu library general public license", "library", "lgpl", 0.8),
    (3, "gpl", "gpl compatible", "compatible", "gpl-compatible", 0.4),
    (1, "as", "as a special exception the copyright holders give you permission to link this library with independent modules", "special exception", "classpath-exception", 0.9),
    (3, "classpath", "classpath exception", "classpath", "classpath-exception", 0.9),
    (3, "gcc", "gcc runtime library exception", "gcc", "gcc-exception", 0.95),
    (3, "bison", "bison exception", "bison", "bison-exception", 0.9),
    (3, "autoconf", "autoconf(?: configure script)? exception", "autoconf", "autoconf-exception", 0.9),
    (3, "openssl", "openssl (?:linking )?exception", "exception", "openssl-exception", 0.9),
    (1, "dual", "dual licensed under (?:the )?mit and gpl", "dual", "mit-or-gpl", 0.9),
    (1, "dual", "dual licensed under (?:the )?mit and apache(?: license)?(?: version)? ?2(?: 0)?", "dual", "mit-or-apache", 0.9),
    (1, "dual", "dual licensed under (?:the )?apache(?: license)?(?: version)? ?2(?: 0)? and mit", "dual", "mit-or-apache", 0.9),
    (1, "same", "same terms as perl(?: itself)?", "perl", "perl-5", 0.9),
    (1, "under", "under the same terms as perl(?: 5)?(?: itself)?", "perl", "perl-5", 0.9),
    # Mozilla, Eclipse, common development and others with copyleft by file.
    (1, "this", "this source code form is subject to the terms of the mozilla public license", "source code form", "mpl-2.0", 0.95),
    (1, "if", "if a copy of the mpl was not distributed with this file you can obtain one at", "mpl", "mpl-2.0", 0.95),
    (1, "the", "the contents of this file are subject to the mozilla public license version 1 1", "mozilla", "mpl-1.1", 0.95),
    (1, "the", "the contents of this file are subject to the netscape public license", "netscape", "npl", 0.95),
    (1, "the", "the contents of this file are subject to the terms of the common development and distribution license", "common development", "cddl-1.0", 0.95),
    (1, "this", "this program and the accompanying materials are made available under the terms of the eclipse public license", "accompanying materials", "epl", 0.95),
    (1, "all", "all rights reserved this program and the accompanying materials are made available under the terms", "accompanying materials", "epl", 0.85),
    (3, "common", "common public license(?: version)? 1 0", "common public", "cpl-1.0", 0.9),
    (3, "ibm", "ibm public license(?: version)? 1 0", "ibm", "ipl-1.0", 0.9),
    (3, "eclipse", "eclipse distribution license(?: version| v)? ?v?1(?: 0)?", "distribution", "bsd-3-clause", 0.85),
    (3, "microsoft", "microsoft public license", "microsoft public", "ms-pl", 0.9),
    (3, "microsoft", "microsoft reciprocal license", "reciprocal", "ms-rl", 0.9),
    (3, "open", "open software license(?: version| v)? ?v?3 0", "open software", "osl-3.0", 0.9),
    (3, "cecill", "cecill(?: [abc])?(?: free software)? license", "cecill", "cecill", 0.85),
    (3, "european", "european union public licen[cs]e", "european union", "eupl", 0.7),
    (3, "q", "q public license", "q public", "qpl-1.0", 0.85),
    (3, "sleepycat", "sleepycat license", "sleepycat", "sleepycat", 0.9),
    (3, "lucent", "lucent public license", "lucent", "lpl", 0.85),
    (3, "ricoh", "ricoh source code public license", "ricoh", "rscpl", 0.9),
    (3, "sun", "sun industry standards source license", "sun industry", "sissl", 0.9),
    (3, "reciprocal", "reciprocal public license(?: 1 5)?", "reciprocal", "rpl", 0.85),
    (3, "mulan", "mulan psl v?2", "mulan", "mulanpsl-2.0", 0.9),
    (3, "mulan", "mulan permissive software license(?: version| v)? ?v?2", "permissive", "mulanpsl-2.0", 0.95),
    # Content and data.
    (1, "this", "this work is licensed under (?:a|the) creative commons attribution 4 0 international license", "international", "cc-by-4.0", 1.0),
    (1, "this", "this work is licensed under (?:a|the) creative commons attribution sharealike 4 0 international license", "sharealike", "cc-by-sa-4.0", 1.0),
    (1, "this", "this work is licensed under (?:a|the) creative commons attribution noncommercial 4 0 international license", "noncommercial", "cc-by-nc-4.0", 1.0),
    (1, "this", "this work is licensed under (?:a|the) creative commons attribution noderivatives 4 0 international license", "noderivatives", "cc-by-nd-4.0", 1.0),
    (1, "text", "text is available under the creative commons attribution sharealike license", "sharealike", "cc-by-sa", 0.95),
    (1, "to", "to the extent possible under law the (?:author|person who associated cc0)", "extent possible", "cc0-1.0", 0.9),
    (1, "has", "has waived all copyright and related or neighboring rights to this work", "neighboring", "cc0-1.0", 0.95),
    (1, "this", "this file is in the public domain", "public domain", "public-domain", 0.8),
    (1, "placed", "placed in(?:to)? the public domain", "public domain", "public-domain", 0.8),
    (1, "dedicated", "dedicated to the public domain", "public domain", "public-domain", 0.85),
    (1, "the", "the author disclaims copyright to this source code", "disclaims copyright", "sqlite-blessing", 0.85),
    (1, "may", "may you do good and not evil", "evil", "sqlite-blessing", 0.9),
    (1, "the", "the software shall be used for good not evil", "evil", "json", 0.95),
    (3, "open", "open data commons attribution license", "attribution", "odc-by-1.0", 0.9),
    (3, "open", "open data commons public domain dedication(?: and)? license", "dedication", "pddl-1.0", 0.9),
    (3, "open", "open government licen[cs]e(?: v3 0| version 3 0)?", "government", "ogl", 0.85),
    (3, "community", "community data license agreement (?:permissive|sharing)", "community data", "cdla", 0.9),
    (3, "free", "free art license", "free art", "lal-1.3", 0.85),
    (3, "sil", "sil open font license", "open font", "ofl", 0.8),
    (3, "bitstream", "bitstream vera fonts copyright", "bitstream", "bitstream-vera", 0.9),
    (3, "ubuntu", "ubuntu font licen[cs]e", "ubuntu", "ufl-1.0", 0.9),
    # Licences with limits, models, and closed ones.
    (3, "server", "server side public license(?: version 1| v1)?", "server side", "sspl-1.0", 0.95),
    (3, "business", "business source license(?: 1 1)?", "business source", "busl-1.1", 0.95),
    (3, "elastic", "elastic license(?: 2 0| v2)?", "elastic", "elastic", 0.9),
    (3, "commons", "commons clause(?: license condition)?", "clause", "commons-clause", 0.85),
    (3, "confluent", "confluent community license", "confluent", "confluent", 0.9),
    (3, "redis", "redis source available license", "redis", "rsal", 0.95),
    (3, "polyform", "polyform (?:noncommercial|small business|strict|shield) license", "polyform", "polyform", 0.95),
    (3, "functional", "functional source license", "functional source", "fsl", 0.9),
    (3, "hippocratic", "hippocratic license", "hippocratic", "hippocratic", 0.9),
    (3, "prosperity", "prosperity public license", "prosperity", "prosperity", 0.9),
    (3, "responsible", "responsible ai licenses?", "responsible", "rail", 0.85),
    (3, "openrail", "openrail(?: m)? license", "openrail", "openrail", 0.9),
    (1, "unauthorized", "unauthorized copying of this file via any medium is strictly prohibited", "strictly prohibited", "proprietary", 0.95),
    (1, "proprietary", "proprietary and confidential", "confidential", "proprietary", 0.8),
    (1, "this", "this software is the confidential and proprietary information of", "confidential and proprietary", "proprietary", 0.95),
    (1, "no", "no part of this (?:publication|work|book|file) may be reproduced", "reproduced", "all-rights-reserved", 0.85),
    (1, "licensed", "licensed materials property of ibm", "property of", "proprietary", 0.9),
    (1, "for", "for (?:personal|internal|evaluation) use only", "use only", "restricted-use", 0.6),
    (1, "not", "not for commercial use", "commercial", "non-commercial", 0.6),
    (1, "free", "free for non ?commercial use", "commercial", "non-commercial", 0.7),
    (1, "redistribution", "redistribution is not permitted", "not permitted", "proprietary", 0.7),
    (1, "end", "end user license agreement", "end user", "eula", 0.8),
    # Addresses.
    (2, "www", "www mozilla org mpl 2 0", "mpl", "mpl-2.0", 0.9),
    (2, "mozilla", "mozilla org mpl 2 0", "mpl", "mpl-2.0", 0.9),
    (2, "www", "www eclipse org legal epl v10", "epl", "epl-1.0", 0.9),
    (2, "www", "www eclipse org legal epl 2 0", "epl", "epl-2.0", 0.9),
    (2, "www", "www boost org license 1 0", "boost", "bsl-1.0", 0.95),
    (2, "www", "www opensource org licenses mit license", "mit", "mit-license", 0.9),
    (2, "www", "www opensource org licenses bsd license", "bsd", "bsd", 0.85),
    (2, "www", "www gnu org copyleft gpl", "copyleft", "gpl", 0.85),
    (2, "www", "www gnu org copyleft lesser", "lesser", "lgpl", 0.85),
    (2, "www", "www gnu org licenses lgpl", "lgpl", "lgpl", 0.85),
    (2, "www", "www gnu org licenses agpl", "agpl", "agpl", 0.85),
    (2, "opensource", "opensource org licenses? isc", "isc", "isc", 0.9),
    (2, "opensource", "opensource org licenses? apache 2 0", "apache", "apache-2.0", 0.9),
    (2, "apache", "apache org licenses license 2 0", "licenses", "apache-2.0", 0.9),
    (2, "unlicense", "unlicense org", "unlicense", "unlicense", 0.8),
    (2, "creativecommons", "creativecommons org licenses by nc 4 0", "nc", "cc-by-nc-4.0", 0.9),
    (2, "creativecommons", "creativecommons org licenses by nd 4 0", "nd", "cc-by-nd-4.0", 0.9),
    (2, "creativecommons", "creativecommons org licenses by nc sa 4 0", "nc sa", "cc-by-nc-sa-4.0", 0.9),
    (2, "creativecommons", "creativecommons org licenses by nc nd 4 0", "nc nd", "cc-by-nc-nd-4.0", 0.9),
    (2, "creativecommons", "creativecommons org licenses by 3 0", "by 3", "cc-by-3.0", 0.9),
    (2, "creativecommons", "creativecommons org licenses by sa 3 0", "by sa 3", "cc-by-sa-3.0", 0.9),
    (2, "opendatacommons", "opendatacommons org licenses odbl", "odbl", "odbl-1.0", 0.9),
    (2, "scripts", "scripts sil org ofl", "ofl", "ofl-1.1", 0.9),
    (2, "spdx", "spdx org licenses", "spdx org", "spdx-reference", 0.4),
    # Package metadata.
    (0, "license", "license osi approved mit license", "osi approved mit", "mit-license", 0.95),
    (0, "license", "license osi approved apache software license", "osi approved apache", "apache", 0.95),
    (0, "license", "license osi approved bsd license", "osi approved bsd", "bsd", 0.95),
    (0, "license", "license osi approved gnu general public license v3(?: or later)? gplv3", "gplv3", "gpl-3.0", 0.95),
    (0, "license", "license osi approved gnu general public license v2(?: or later)? gplv2", "gplv2", "gpl-2.0", 0.95),
    (0, "license", "license osi approved mozilla public license 2 0", "osi approved mozilla", "mpl-2.0", 0.95),
    (0, "license", "license osi approved isc license", "osi approved isc", "isc", 0.95),
    (0, "license", "license osi approved python software foundation license", "osi approved python", "python-2.0", 0.95),
    (0, "module", "module license gpl", "module license", "gpl", 0.9),
    (0, "license", "license see license in license", "see license in", "license-reference", 0.5),
    (0, "license", "license all rights reserved", "all rights", "all-rights-reserved", 0.7),
    (0, "licence", "licence mit", "mit", "mit-license", 0.9),
    (0, "licence", "licence gpl ?v?3", "gpl", "gpl-3.0", 0.9),
    (0, "licence", "licence gpl ?v?2", "gpl", "gpl-2.0", 0.9),
    (0, "licence", "licence apache(?: 2 0)?", "apache", "apache", 0.85),
    (3, "see", "see license(?: file| md| txt)? for (?:details|more information)", "license", "license-reference", 0.4),
    (3, "copyright", "copyright notice and license", "notice", "license-reference", 0.3),
]


@dataclass(frozen=True)
class Rule:
    order: int
    priority: int
    label: str
    first: str
    keyword: str
    pattern: str
    confidence: float
    phrase: bool


def rules() -> list[Rule]:
    rows = [(3, label, phrase.split()[0], phrase.split()[-1], phrase, 0.8, True) for phrase, label in PHRASES]
    for priority, first, form, confidence in FORMS:
        for label, ident, name, keyword, _ in LICENSES:
            if "{id}" in form and keyword not in ident:
                # Some identifiers lack the word that all names share.
                keyword = ident.split()[0]
            pattern = form.format(id=f"(?:{ident})", name=f"(?:{name})")
            rows.append((priority, label, first, keyword, pattern, confidence, False))
    rows += [(p, label, first, keyword, pattern, c, False) for p, first, pattern, keyword, label, c in [*SINGLE, *SENTENCES]]
    for label, _, name, keyword, firsts in LICENSES:
        rows += [(4, label, first, keyword, name, 0.5, False) for first in firsts.split()]
    return [Rule(i, p, label, first, keyword, pattern, c, phrase) for i, (p, label, first, keyword, pattern, c, phrase) in enumerate(rows)]


# Every match has one of these words or word starts in it or is left to no rule.
GATES = (
    "licen", "gpl", "public domain", "creativecommons", "creative commons", "wtfpl", "copyright", "copyleft", "gfdl", "cecill", "beerware",
    " cc by ", " cc0 ", " spdx ", " bsd ", " mpl ", " asl 2 0 ", " rights reserved ", " is hereby granted ", " permission ", " redistributions ",
    " to use copy modify ", " source and binary forms ", " unencumbered software ", "the software", " exception ", " free software",
    " contributors ", " advertising materials ", "this software", " following conditions ", " source versions ", " warranty ", "apache",
    " perl ", " org ", " mulan ", " clause ", " confidential ", " strictly prohibited ", "commercial use ", " use only ",
    " may be reproduced ", " not permitted ", " sharealike ", " extent possible ", " you want ", " good and not evil ", " libr", " accompanying materials ",
)
