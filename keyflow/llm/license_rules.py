"""License signatures: ordered rules over the lower-cased words of a text.

A name pattern is a regular expression over words parted by single spaces.
``rules()`` expands every licence by the forms it is met in: an SPDX tag
(priority 1), a grant sentence (2) and the bare name (3); general notices that
name no licence come last (4).  Earlier rules win ties.
"""

from __future__ import annotations

import re

#: label, a word that every match holds, the licence's name
LICENSES = [
    ("mit-0", "mit", "mit no attribution license|mit 0 license"),
    ("mit", "mit", "(the )?mit license|expat license mit|mit style license"),
    ("x11", "x11", "(mit )?x11 license"),
    ("apache-1.0", "apache", "apache( software)? license( version| v)? 1 0"),
    ("apache-1.1", "apache", "apache( software)? license( version| v)? 1 1"),
    ("apache-2.0", "apache", "apache( software)? license( version| v)? 2( 0)?|apache 2 0 license"),
    ("apache-any", "apache", "apache( software)? license"),
    ("agpl-1.0", "affero", "(gnu )?affero general public license( version| v)? 1( 0)?"),
    ("agpl-3.0-or-later", "affero", "(gnu )?affero general public license( version| v)? 3( 0)? or( any)? later( version)?"),
    ("agpl-3.0", "affero", "(gnu )?affero general public license( version| v)? 3( 0)?"),
    ("agpl-any", "affero", "(gnu )?affero general public license"),
    ("lgpl-2.0", "general", "(gnu )?library general public license( version| v)?( 2( 0)?)?"),
    ("lgpl-2.1-or-later", "lesser", "(gnu )?lesser general public license( version| v)? 2 1 or( any)? later( version)?"),
    ("lgpl-2.1", "lesser", "(gnu )?lesser general public license( version| v)? 2 1"),
    ("lgpl-3.0-or-later", "lesser", "(gnu )?lesser general public license( version| v)? 3( 0)? or( any)? later( version)?"),
    ("lgpl-3.0", "lesser", "(gnu )?lesser general public license( version| v)? 3( 0)?"),
    ("lgpl-any", "lesser", "(gnu )?lesser general public license"),
    ("gpl-1.0", "general", "(gnu )?general public license( version| v)? 1( 0)?"),
    ("gpl-2.0-or-later", "general", "(gnu )?general public license( version| v)? 2( 0)? or( any)? later( version)?"),
    ("gpl-2.0", "general", "(gnu )?general public license( version| v)? 2( 0)?"),
    ("gpl-3.0-or-later", "general", "(gnu )?general public license( version| v)? 3( 0)? or( any)? later( version)?"),
    ("gpl-3.0", "general", "(gnu )?general public license( version| v)? 3( 0)?"),
    ("gpl-any", "general", "gnu general public license"),
    ("gfdl-1.1", "documentation", "(gnu )?free documentation license( version| v)? 1 1"),
    ("gfdl-1.2", "documentation", "(gnu )?free documentation license( version| v)? 1 2"),
    ("gfdl-1.3", "documentation", "(gnu )?free documentation license( version| v)? 1 3"),
    ("gfdl-any", "documentation", "(gnu )?free documentation license"),
    ("bsd-1-clause", "bsd", "(1|one) clause bsd( license)?|bsd 1 clause( license)?"),
    ("bsd-2-clause", "bsd", "(2|two) clause bsd( license)?|bsd 2 clause( license)?|simplified bsd license|freebsd bsd license"),
    ("bsd-3-clause", "bsd", "(3|three) clause bsd( license)?|bsd 3 clause( license)?|(new|revised|modified) bsd license"),
    ("bsd-4-clause", "bsd", "(4|four) clause bsd( license)?|bsd 4 clause( license)?|original bsd license"),
    ("0bsd", "bsd", "(zero|0) clause bsd( license)?|bsd zero clause( license)?"),
    ("bsd-any", "bsd", "bsd( style)? license"),
    ("cc0-1.0", "cc0", "cc0( 1 0)?( universal)?"),
    ("cc-by-1.0", "cc", "cc by 1 0"), ("cc-by-2.0", "cc", "cc by 2 0"), ("cc-by-2.5", "cc", "cc by 2 5"),
    ("cc-by-3.0", "cc", "cc by 3 0"), ("cc-by-4.0", "cc", "cc by 4 0"),
    ("cc-by-sa-1.0", "cc", "cc by sa 1 0"), ("cc-by-sa-2.0", "cc", "cc by sa 2 0"), ("cc-by-sa-2.5", "cc", "cc by sa 2 5"),
    ("cc-by-sa-3.0", "cc", "cc by sa 3 0"), ("cc-by-sa-4.0", "cc", "cc by sa 4 0"),
    ("cc-by-nd-2.0", "cc", "cc by nd 2 0"), ("cc-by-nd-3.0", "cc", "cc by nd 3 0"), ("cc-by-nd-4.0", "cc", "cc by nd 4 0"),
    ("cc-by-nc-2.0", "cc", "cc by nc 2 0"), ("cc-by-nc-2.5", "cc", "cc by nc 2 5"),
    ("cc-by-nc-3.0", "cc", "cc by nc 3 0"), ("cc-by-nc-4.0", "cc", "cc by nc 4 0"),
    ("cc-by-nc-sa-3.0", "cc", "cc by nc sa 3 0"), ("cc-by-nc-sa-4.0", "cc", "cc by nc sa 4 0"),
    ("cc-by-nc-nd-3.0", "cc", "cc by nc nd 3 0"), ("cc-by-nc-nd-4.0", "cc", "cc by nc nd 4 0"),
    ("cc-by-any", "commons", "creative commons attribution( license)?"),
    ("cc-by-sa-any", "commons", "creative commons attribution (sharealike|share alike)( license)?"),
    ("cc-by-nc-any", "commons", "creative commons attribution (noncommercial|non commercial)( license)?"),
    ("cc-by-nd-any", "commons", "creative commons attribution (no derivs|noderivs|no derivatives|noderivatives)( license)?"),
    ("cc-any", "commons", "creative commons( licen[cs]e)?"),
    ("mpl-1.0", "mozilla", "mozilla public license( version| v)? 1 0"),
    ("mpl-1.1", "mozilla", "mozilla public license( version| v)? 1 1"),
    ("mpl-2.0", "mozilla", "mozilla public license( version| v)? 2( 0)?"),
    ("mpl-any", "mozilla", "mozilla public license"),
    ("epl-1.0", "eclipse", "eclipse public license( version| v)? 1 0"),
    ("epl-2.0", "eclipse", "eclipse public license( version| v)? 2( 0)?"),
    ("epl-any", "eclipse", "eclipse public license"),
    ("eupl-1.1", "union", "european union public licen[cs]e( version| v)? 1 1"),
    ("eupl-1.2", "union", "european union public licen[cs]e( version| v)? 1 2"),
    ("eupl-any", "union", "european union public licen[cs]e"),
    ("cddl-1.0", "development", "common development and distribution license( version| v)?( 1 0)?"),
    ("cddl-1.1", "development", "common development and distribution license( version| v)? 1 1"),
    ("cpl-1.0", "common", "common public license( version| v)?( 1 0)?"),
    ("cpal-1.0", "attribution", "common public attribution license( version| v)?( 1 0)?"),
    ("artistic-1.0", "artistic", "artistic license( version| v)? 1( 0)?"),
    ("artistic-2.0", "artistic", "artistic license( version| v)? 2( 0)?"),
    ("artistic-any", "artistic", "artistic license"),
    ("isc", "isc", "isc license"), ("zlib", "zlib", "zlib( libpng)? license"), ("libpng", "libpng", "libpng license"),
    ("bsl-1.0", "boost", "boost software license( version| v)?( 1 0)?"),
    ("busl-1.1", "business", "business source license( version| v)?( 1 1)?"),
    ("elastic-2.0", "elastic", "elastic license( version| v)?( 2( 0)?)?"),
    ("sspl-1.0", "side", "server side public license( version| v)?( 1( 0)?)?"),
    ("ms-pl", "microsoft", "microsoft public license"), ("ms-rl", "microsoft", "microsoft reciprocal license"),
    ("ofl-1.1", "font", "(sil )?open font license( version| v)?( 1 1)?"),
    ("osl-3.0", "open", "open software license( version| v)?( 3 0)?"),
    ("afl-3.0", "academic", "academic free license( version| v)?( 3 0)?"),
    ("ecl-2.0", "educational", "educational community license( version| v)?( 2 0)?"),
    ("ncsa", "illinois", "university of illinois ncsa( open source license)?"),
    ("psf-2.0", "python", "python software foundation license( version| v)?( 2)?"),
    ("python-any", "python", "python license"), ("ruby", "ruby", "ruby license"), ("php-3.01", "php", "php license( version| v)?( 3 (0 1|01))?"),
    ("postgresql", "postgresql", "postgresql license"), ("openssl", "openssl", "openssl license"), ("curl", "curl", "curl license"),
    ("unlicense", "unlicense", "unlicense"), ("wtfpl", "public", "do what the [a-z]+ you want to public license"),
    ("w3c", "w3c", "w3c( software( notice and)?)? license"), ("icu", "icu", "icu license"), ("unicode", "unicode", "unicode license( agreement)?"),
    ("vim", "vim", "vim license"), ("qpl-1.0", "public", "q public license( version| v)?( 1 0)?"), ("tcl", "tcl", "tcl tk license"),
    ("odbl-1.0", "database", "open (data commons )?database license( version| v)?( 1 0)?"),
    ("odc-by-1.0", "commons", "open data commons attribution license( version| v)?( 1 0)?"),
    ("pddl-1.0", "dedication", "public domain dedication and license( version| v)?( 1 0)?"),
    ("upl-1.0", "permissive", "universal permissive license( version| v)?( 1 0)?"),
    ("mulan-2.0", "mulan", "mulan permissive software license( version| v)?( 2)?"),
    ("blueoak-1.0.0", "oak", "blue oak model license( version| v)?( 1 0 0)?"),
    ("openrail", "rail", "(open|creativeml open) rail( m)? license"),
    ("polyform-nc", "polyform", "polyform noncommercial license( version| v)?( 1 0 0)?"),
    ("etalab-2.0", "etalab", "etalab open license( version| v)?( 2 0)?"), ("ogl-uk-3.0", "government", "open government licence( version| v)?( 3 0)?"),
]

# Names and versions in the order in which a licence writes them.
_GNU = [("agpl", "affero", "affero general", ["3"]), ("lgpl", "lesser", "lesser general", ["2 1", "3"]),
        ("gpl", "general", "general", ["2", "3"])]
_CC = [("by-nc-sa", "(noncommercial|non commercial) (sharealike|share alike)"),
       ("by-nc-nd", "(noncommercial|non commercial) (noderivatives|no derivatives|noderivs|no derivs)"),
       ("by-nc", "(noncommercial|non commercial)"), ("by-sa", "(sharealike|share alike)"),
       ("by-nd", "(noderivatives|no derivatives|noderivs|no derivs)"), ("by", "")]
_CC_VERSIONS = [("4 0", "international"), ("3 0", "unported"), ("2 5", "generic"), ("2 0", "generic"), ("1 0", "generic")]


def _version(digits: str) -> str:
    return ".".join((digits + " 0" if " " not in digits else digits).split())


def written_out() -> list[tuple[str, str, str]]:
    """Label, gate word and pattern of licences told by a notice, a short name or their full text."""
    out = []
    for label, word, name, versions in _GNU:
        for v in versions:
            head = f"(gnu )?{name} public license as published by the free software foundation"
            later = f"{label}-{_version(v)}-or-later"
            out.append((later, word, f"{head}( either)? version {v}( 0)?( of the license)? or at your option any later version"))
            out.append((f"{label}-{_version(v)}", word, f"{head} version {v}( 0)?( of the license)?"))
            short = f"{label}v{v}"
            out.append((later, short.split()[0], f"{short}( 0)? or( any)? later( version)?"))
            out.append((f"{label}-{_version(v)}", short.split()[0], f"{short}( 0)?"))
    for kind, more in _CC:
        name = "attribution" + (f" {more}" if more else "")
        for v, where in _CC_VERSIONS:
            out.append((f"cc-{kind}-{_version(v)}", "attribution", f"(creative commons )?{name} {v} {where}( public)?( license)?"))
            out.append((f"cc-{kind}-{_version(v)}", "attribution", f"creative commons {name}( license)?( version| v)? {v}"))
    return out + [
        # one side of an SPDX expression: only touches the other, so both are kept
        ("mit", "mit", "(0|only|later|clause) (or|and) mit|mit (or|and) (apache|bsd|gpl|lgpl|mpl)"),
        ("apache-2.0", "apache", "apache 2 0"),
        ("mit", "obtaining", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                             "documentation files the software to deal in the software without restriction"),
        ("isc", "fee", "permission to use copy modify and( or)? distribute this software for any purpose with or without fee is hereby granted"),
        ("bsd-3-clause", "endorse", "neither the names?( of)?( [0-9a-z]+){1,16} may be used to endorse or promote products derived from this software"),
        ("bsd-any", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted provided "
                                      "that the following conditions are met"),
        ("apache-2.0", "writing", "unless required by applicable law or agreed to in writing software distributed under the license is "
                                  "distributed on an as is basis"),
    ]


#: label, word, pattern of notices that name no licence
NOTICES = [
    ("public-domain", "domain", "(released|dedicated|placed|is) (in|into|to) the public domain"),
    ("all-rights-reserved", "reserved", "all rights reserved"),
    ("copyright", "copyright", "copyright( c| ©)? (19|20)[0-9][0-9]"),
    ("proprietary", "proprietary", "proprietary and confidential"),
    ("permission-grant", "permission", "permission is hereby granted free of charge"),
    ("redistribution", "redistribution", "redistribution and use in source and binary forms"),
    ("no-warranty", "warranty", "without warranty of any kind"),
    ("as-is", "provided", "(software )?is provided as is"),
    ("copyleft", "copyleft", "copyleft"),
    ("license-notice", "licensed", "licensed under"),
    ("license-notice", "license", "(see|read) the license"),
    ("license-notice", "licence", "(see|read) the licence"),
]

#: every match of every rule holds one of these in the lower-cased raw text
RAW_GATES = ("license", "licence", "spdx", "copyright", "copyleft", "reserved", "proprietary", "permission",
             "redistribution", "warranty", "commons", "domain", "clause", "provided", "cc0", "illinois",
             "attribution", "gplv", "apache", "endorse", " mit", "mit ")
#: or this, where "cc" occurs at all
CC_GATE = "cc[^0-9a-z]+by"

#: the base phrases: label, phrase; their labels always stay
BASE = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
#: how sure a match of each priority makes us
CONFIDENCE = {1: 1.0, 2: 0.95, 3: 0.75, 4: 0.25}

GRANT = "(licensed|released|distributed|published|available|covered|provided|redistributable) (under|by) (the )?(terms of )?(the )?"


def _over_words(pattern: str) -> str:
    """The pattern for a text in which every word stands between spaces of its own."""
    return " (" + pattern.replace(" ", "  ") + ") "


def rules() -> list[tuple[int, str, int, str, str]]:
    """Order, label, priority, gate word, regular expression; groups without capture."""
    out = []
    for label, word, name in [*written_out(), *LICENSES]:
        # a version may be one word with its "v"
        name = re.sub(r"\( version\| v\)\? (\d)", r"(( version( v)?| v)? \1|( version)? v\1)", name)
        if not label.endswith("-any") and (label, 1) not in {(r[0], r[1]) for r in out}:
            tag = " ".join(re.findall(r"[0-9a-z]+", label))
            out.append((label, 1, "spdx", f"spdx license identifier {tag}"))
        out.append((label, 2, word, f"{GRANT}({name})"))
        out.append((label, 3, word, name))
    out += [(label, 4, word, name) for label, word, name in NOTICES]
    return [(i, label, priority, word, _over_words(p).replace("(", "(?:"))
            for i, (label, priority, word, p) in enumerate(out)]
