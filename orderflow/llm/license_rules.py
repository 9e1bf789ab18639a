"""Signature rules for licences, in order of priority.

Each family has hand-written patterns for its name, its identifiers and its addresses.
``rules()`` combines a family's patterns with the hand-written statement forms below, so
the few hundred rules come from these parts. All patterns are for lower-case text.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    keyword: str
    """The text must hold this for the pattern to be tried."""
    pattern: str
    label: str
    priority: int
    weight: float


S = r"[\s\-]+"
V = r",?\s*(?:version|v\.?|ver\.?)?\s*"

# label, keyword, name pattern, identifiers (as patterns), addresses (as patterns)
FAMILIES: list[tuple[str, str, str, list[str], list[str]]] = [
    ("mit", "mit", r"mit\s+licen[cs]e", [r"mit"], [r"opensource\.org/licenses/mit"]),
    ("mit-0", "mit", r"mit\s+no\s+attribution(?:\s+license)?", [r"mit-0"], []),
    ("x11", "x11", r"x11\s+license", [r"x11"], []),
    ("apache-1.1", "apache", rf"apache(?:\s+software)?\s+license{V}1\.1", [r"apache-1\.1"], [r"apache\.org/licenses/license-1\.1"]),
    ("apache-2", "apache", rf"apache(?:\s+software)?\s+license{V}2(?:\.0)?", [r"apache-2\.0", r"apache2"], [r"apache\.org/licenses/license-2\.0"]),
    ("bsd-2-clause", "bsd", rf"(?:simplified|2{S}clause|two{S}clause|freebsd)\s+bsd(?:\s+license)?", [r"bsd-2-clause"], [r"opensource\.org/licenses/bsd-2-clause"]),
    ("bsd-3-clause", "bsd", rf"(?:new|modified|revised|3{S}clause|three{S}clause)\s+bsd(?:\s+license)?", [r"bsd-3-clause"], [r"opensource\.org/licenses/bsd-3-clause"]),
    ("bsd-4-clause", "bsd", rf"(?:original|4{S}clause|four{S}clause)\s+bsd(?:\s+license)?", [r"bsd-4-clause"], []),
    ("bsd", "bsd", r"bsd(?:[\s-]+style)?\s+license", [r"bsd"], []),
    ("0bsd", "bsd", rf"(?:zero{S}clause|0{S}clause)\s+bsd(?:\s+license)?", [r"0bsd"], []),
    ("isc", "isc", r"isc\s+license", [r"isc"], [r"opensource\.org/licenses/isc"]),
    ("gpl-2", "gpl", rf"gpl{V}2(?:\.0)?", [r"gpl-2\.0(?:-only|-or-later|\+)?"], [r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"]),
    ("gpl-3", "gpl", rf"gpl{V}3(?:\.0)?", [r"gpl-3\.0(?:-only|-or-later|\+)?"], [r"gnu\.org/licenses/gpl-3\.0"]),
    ("gpl-2", "general public", rf"(?:gnu\s+)?general\s+public\s+license{V}2(?:\.0)?", [], []),
    ("gpl-3", "general public", rf"(?:gnu\s+)?general\s+public\s+license{V}3(?:\.0)?", [], []),
    ("gpl", "general public", r"(?:gnu\s+)?general\s+public\s+license", [r"gpl"], [r"gnu\.org/licenses/gpl"]),
    ("lgpl-2.1", "lesser", rf"(?:gnu\s+)?lesser\s+general\s+public\s+license{V}2\.1", [], []),
    ("lgpl-3", "lesser", rf"(?:gnu\s+)?lesser\s+general\s+public\s+license{V}3(?:\.0)?", [], []),
    ("lgpl", "lesser", r"(?:gnu\s+)?lesser\s+general\s+public\s+license", [], []),
    ("lgpl-2", "library general", rf"(?:gnu\s+)?library\s+general\s+public\s+license(?:{V}2(?:\.0)?)?", [], []),
    ("lgpl-2.1", "lgpl", rf"lgpl{V}2\.1", [r"lgpl-2\.1(?:-only|-or-later|\+)?"], [r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"]),
    ("lgpl-3", "lgpl", rf"lgpl{V}3(?:\.0)?", [r"lgpl-3\.0(?:-only|-or-later|\+)?"], [r"gnu\.org/licenses/lgpl-3\.0"]),
    ("agpl-3", "affero", rf"(?:gnu\s+)?affero\s+general\s+public\s+license(?:{V}3(?:\.0)?)?", [], []),
    ("agpl-3", "agpl", rf"agpl(?:{V}3(?:\.0)?)?", [r"agpl-3\.0(?:-only|-or-later|\+)?"], [r"gnu\.org/licenses/agpl"]),
    ("gfdl", "free documentation", r"(?:gnu\s+)?free\s+documentation\s+license", [r"gfdl-1\.[123]"], [r"gnu\.org/licenses/fdl"]),
    ("mpl-1.1", "mozilla", rf"mozilla\s+public\s+license{V}1\.1", [r"mpl-1\.1"], [r"mozilla\.org/mpl/1\.1"]),
    ("mpl-2", "mozilla", rf"mozilla\s+public\s+license{V}2(?:\.0)?", [r"mpl-2\.0"], [r"mozilla\.org/(?:en-us/)?mpl/2\.0"]),
    ("mpl", "mozilla", r"mozilla\s+public\s+license", [r"mpl"], [r"mozilla\.org/mpl"]),
    ("epl-1", "eclipse", rf"eclipse\s+public\s+license(?:\s+-)?{V}1\.0", [r"epl-1\.0"], [r"eclipse\.org/legal/epl-v10"]),
    ("epl-2", "eclipse", rf"eclipse\s+public\s+license(?:\s+-)?{V}2(?:\.0)?", [r"epl-2\.0"], [r"eclipse\.org/legal/epl-2\.0"]),
    ("edl-1", "eclipse", rf"eclipse\s+distribution\s+license(?:\s+-)?(?:{V}1\.0)?", [r"edl-1\.0"], []),
    ("cddl-1", "common development", rf"common\s+development\s+and\s+distribution\s+license(?:{V}1\.[01])?", [r"cddl-1\.[01]"], []),
    ("cpl-1", "common public", rf"common\s+public\s+license(?:{V}1\.0)?", [r"cpl-1\.0"], []),
    ("ipl-1", "ibm public", rf"ibm\s+public\s+license(?:{V}1\.0)?", [r"ipl-1\.0"], []),
    ("eupl", "european union", rf"european\s+union\s+public\s+licen[cs]e(?:{V}1\.[12])?", [r"eupl-1\.[12]"], []),
    ("artistic-1", "artistic", rf"artistic\s+license{V}1(?:\.0)?", [r"artistic-1\.0(?:-perl)?"], []),
    ("artistic-2", "artistic", rf"artistic\s+license{V}2(?:\.0)?", [r"artistic-2\.0"], [r"opensource\.org/licenses/artistic-license-2\.0"]),
    ("artistic", "artistic", r"artistic\s+license", [], []),
    ("boost", "boost", rf"boost\s+software\s+license(?:{V}1\.0)?", [r"bsl-1\.0"], [r"boost\.org/license_1_0"]),
    ("busl-1.1", "business source", rf"business\s+source\s+license(?:{V}1\.1)?", [r"busl-1\.1"], []),
    ("sspl-1", "server side", rf"server\s+side\s+public\s+license(?:{V}1)?", [r"sspl-1\.0"], []),
    ("elastic-2", "elastic", rf"elastic\s+license(?:{V}2(?:\.0)?)?", [r"elastic-2\.0"], []),
    ("zlib", "zlib", r"zlib(?:/libpng)?\s+license", [r"zlib"], [r"zlib\.net/zlib_license"]),
    ("libpng", "libpng", r"libpng\s+license", [r"libpng(?:-2\.0)?"], []),
    ("unlicense", "unlicense", r"(?:the\s+)?unlicense", [r"unlicense"], [r"unlicense\.org"]),
    ("wtfpl", "wtfpl", r"wtfpl", [r"wtfpl"], [r"wtfpl\.net"]),
    ("cc0", "cc0", r"cc0(?:\s+1\.0)?", [r"cc0-1\.0"], [r"creativecommons\.org/publicdomain/zero"]),
    ("psf-2", "python software", rf"python\s+software\s+foundation\s+license(?:{V}2)?", [r"psf-2\.0", r"python-2\.0"], []),
    ("php-3", "php license", rf"php\s+license(?:{V}3(?:\.0[01])?)?", [r"php-3\.0[01]?"], []),
    ("ruby", "ruby license", r"ruby\s+license", [r"ruby"], []),
    ("postgresql", "postgresql", r"postgresql\s+licen[cs]e", [r"postgresql"], []),
    ("openssl", "openssl", r"openssl\s+license", [r"openssl"], []),
    ("curl", "curl license", r"curl\s+license", [r"curl"], []),
    ("ncsa", "ncsa", r"(?:university\s+of\s+illinois/)?ncsa(?:\s+open\s+source)?\s+license", [r"ncsa"], []),
    ("w3c", "w3c", r"w3c\s+(?:software\s+)?(?:notice\s+and\s+)?license", [r"w3c"], []),
    ("ms-pl", "microsoft public", r"microsoft\s+public\s+license", [r"ms-pl"], []),
    ("ms-rl", "microsoft reciprocal", r"microsoft\s+reciprocal\s+license", [r"ms-rl"], []),
    ("osl-3", "open software license", rf"open\s+software\s+license(?:{V}3(?:\.0)?)?", [r"osl-3\.0"], []),
    ("afl-3", "academic free", rf"academic\s+free\s+license(?:{V}3(?:\.0)?)?", [r"afl-3\.0"], []),
    ("ofl-1.1", "open font", rf"(?:sil\s+)?open\s+font\s+license(?:{V}1\.1)?", [r"ofl-1\.1"], [r"scripts\.sil\.org/ofl"]),
    ("odbl", "open database", rf"open\s+database\s+license(?:{V}1\.0)?", [r"odbl-1\.0"], [r"opendatacommons\.org/licenses/odbl"]),
    ("odc-by", "open data commons", r"open\s+data\s+commons\s+attribution\s+license", [r"odc-by-1\.0"], [r"opendatacommons\.org/licenses/by"]),
    ("pddl", "public domain dedication", r"public\s+domain\s+dedication(?:\s+and)?\s+license", [r"pddl-1\.0"], [r"opendatacommons\.org/licenses/pddl"]),
    ("cdla", "community data", r"community\s+data\s+license\s+agreement", [r"cdla-(?:permissive|sharing)-[12]\.0"], []),
    ("openrail", "openrail", r"(?:creativeml\s+)?open\s*rail(?:-?\+*\+?-?m)?\s+license", [r"openrail"], []),
    ("blueoak", "blue oak", rf"blue\s+oak\s+model\s+license(?:{V}1\.0\.0)?", [r"blueoak-1\.0\.0"], []),
    ("mulan-2", "mulan", rf"mulan\s+(?:permissive|psl)[\w\s]*license(?:{V}2)?", [r"mulanpsl-2\.0"], []),
    ("cecill", "cecill", rf"cecill(?:-[bc])?(?:{V}2\.[01])?", [r"cecill-(?:1\.[01]|2\.[01]|b|c)"], [r"cecill\.info"]),
    ("upl-1", "universal permissive", rf"universal\s+permissive\s+license(?:{V}1\.0)?", [r"upl-1\.0"], []),
    ("vim", "vim license", r"vim\s+license", [r"vim"], []),
    ("beerware", "beer", r"beer-?ware(?:\s+license)?", [r"beerware"], []),
    ("json", "json license", r"json\s+license", [r"json"], [r"json\.org/license"]),
]

# The Creative Commons family, by its elements.
ELEMENTS = {
    "by": r"attribution",
    "by-sa": r"attribution[\s-]+share-?\s?alike",
    "by-nd": r"attribution[\s-]+no-?\s?deriv(?:ative)?s?",
    "by-nc": r"attribution[\s-]+non-?\s?commercial",
    "by-nc-sa": r"attribution[\s-]+non-?\s?commercial[\s-]+share-?\s?alike",
    "by-nc-nd": r"attribution[\s-]+non-?\s?commercial[\s-]+no-?\s?deriv(?:ative)?s?",
}

# Statement forms: the pattern with the name in place of NAME, priority, weight.
FORMS = [
    (r"(?:licen[cs]ed|released|distributed|published|available|provided|redistributed)\s+under\s+(?:the\s+)?(?:terms\s+of\s+)?(?:the\s+)?NAME", 80, 0.99),
    (r"(?:subject\s+to|governed\s+by|covered\s+by|according\s+to)\s+(?:the\s+)?(?:terms\s+of\s+)?(?:the\s+)?NAME", 70, 0.95),
    (r"licen[cs]e\s*[:=]\s*(?:the\s+)?NAME", 75, 0.97),
    (r"under\s+(?:the\s+)?NAME", 60, 0.85),
]

# Statements without a named licence.
GENERAL: list[tuple[str, str, str, int, float]] = [
    ("permissive-grant", "permission is hereby granted", r"permission\s+is\s+hereby\s+granted,?\s+free\s+of\s+charge", 55, 0.9),
    ("bsd-grant", "redistribution and use", r"redistribution\s+and\s+use\s+in\s+source\s+and\s+binary\s+forms", 55, 0.9),
    ("no-warranty", "without warranty", r"without\s+warrant(?:y|ies)\s+of\s+any\s+kind", 20, 0.4),
    ("no-warranty", "as is", r"provided\s+[\"“]?as\s+is[\"”]?", 20, 0.4),
    ("public-domain", "public domain", r"(?:released\s+(?:in)?to|placed\s+in|dedicated\s+to|is\s+in)\s+the\s+public\s+domain", 50, 0.9),
    ("all-rights-reserved", "all rights reserved", r"all\s+rights\s+reserved", 30, 0.6),
    ("copyright", "copyright", r"copyright\s+(?:\(c\)|©)?\s*(?:19|20)\d\d", 25, 0.5),
    ("copyright", "©", r"©\s*(?:19|20)\d\d", 25, 0.5),
    ("proprietary", "proprietary", r"proprietary\s+and\s+confidential", 40, 0.8),
    ("commercial", "commercial license", r"commercial\s+license\s+(?:agreement|terms)", 35, 0.7),
    ("eula", "end user license", r"end[\s-]user\s+license\s+agreement", 45, 0.8),
]


def rules() -> list[Rule]:
    """All rules, those of higher priority first."""
    families = list(FAMILIES)
    for element, name in ELEMENTS.items():
        short = r"[\s-]".join(element.split("-"))
        families += [
            (f"cc-{element}", "creative commons", rf"creative\s+commons\s+{name}(?:\s+license)?", [], []),
            (f"cc-{element}", "cc", rf"cc[\s-]{short}(?![\s-](?:nc|nd|sa)\b)", [rf"cc-{element}-[1234]\.0"], [rf"creativecommons\.org/licenses/{element}/"]),
        ]
    found: list[Rule] = []
    for label, keyword, name, identifiers, addresses in families:
        for form, priority, weight in FORMS:
            pattern = form.replace("NAME", f"(?:{name})")
            found.append(Rule(keyword, rf"\b{pattern}\b", label, priority, weight))
        if "licen" in name or label.startswith("cc-") or label in ("wtfpl", "cc0"):
            found.append(Rule(keyword, rf"\b(?:{name})\b", label, 50, 0.8))
        for identifier in identifiers:
            tag = rf"spdx-license-identifier:\s*(?:{identifier})(?![\w.-])"
            found.append(Rule("spdx-license-identifier", tag, label, 100, 1.0))
        found += [Rule("/", address, label, 90, 0.95) for address in addresses]
    found += [Rule(k, p, label, n, w) for label, k, p, n, w in GENERAL]
    return sorted(set(found), key=lambda r: (-r.priority, r.label, r.pattern))
