"""Licences by sentence rules.

A text is cut into sentences, each is normalised and looked up among known licence sentences, some
with slots for names. Notices and SPDX lines are sentences whose identifier names the licence.
Sequences of the identifiers found are matched against rules, which name the sentences of a
licence in their order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from cotejo.llm.common import record_batch, texts_of

# Sentences of public licence texts and notices. <> stands for up to SLOT words.
SLOT = 12
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of <> nor the names of <> contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-advert": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "apache-notice": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-basis": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl2-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "lgpl3-free": "<> is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl21-free": "<> is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl2-free": "<> is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "agpl3-free": "<> is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl-hope": "<> is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "apache-title": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    "apache-terms": "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "apache-define": "\"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.",
    "gpl3-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "gpl3-preamble": "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
    "gpl2-title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "gpl2-preamble": "The licenses for most software are designed to take away your freedom to share and change it.",
    "lgpl3-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "lgpl21-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "agpl3-title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "mpl-title": "Mozilla Public License Version 2.0",
    "epl-title": "Eclipse Public License - v 2.0",
    "epl-provided": "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE (\"AGREEMENT\").",
    "bsl-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "bsl-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    "bsl-notice": "Distributed under the Boost Software License, Version 1.0.",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-liable": "In no event will the authors be held liable for any damages arising from the use of this software.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "wtfpl-title": "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE",
    "wtfpl-do": "You just DO WHAT THE FUCK YOU WANT TO.",
    "cc0-title": "CC0 1.0 Universal",
    "cc0-waive": "To the extent possible under law, <> has waived all copyright and related or neighboring rights to <>.",
    "cc-work": "This work is licensed under the Creative Commons Attribution 4.0 International License.",
    "mit-0-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.",
    "mpl-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense-free": "This is free and unencumbered software released into the public domain.",
    "unlicense-anyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}

# Names by which notices call a licence, and its identifier.
NAMES = {
    "mit license": "MIT", "mit licence": "MIT", "mit": "MIT", "x11 license": "MIT", "isc license": "ISC",
    "bsd license": "BSD", "bsd 2 clause license": "BSD-2-Clause", "bsd 3 clause license": "BSD-3-Clause", "new bsd license": "BSD-3-Clause", "simplified bsd license": "BSD-2-Clause",
    "apache license version 2 0": "Apache-2.0", "apache license 2 0": "Apache-2.0", "apache 2 0 license": "Apache-2.0", "apache 2 0": "Apache-2.0",
    "gnu general public license version 3": "GPL-3.0", "gnu general public license v3": "GPL-3.0", "gnu gpl version 3": "GPL-3.0", "gplv3": "GPL-3.0", "gpl 3 0": "GPL-3.0",
    "gnu general public license version 2": "GPL-2.0", "gnu general public license v2": "GPL-2.0", "gplv2": "GPL-2.0", "gpl 2 0": "GPL-2.0", "gnu general public license": "GPL",
    "gnu lesser general public license version 3": "LGPL-3.0", "gnu lesser general public license version 2 1": "LGPL-2.1", "gnu lesser general public license": "LGPL",
    "gnu affero general public license version 3": "AGPL-3.0", "gnu affero general public license": "AGPL",
    "mozilla public license version 2 0": "MPL-2.0", "mozilla public license 2 0": "MPL-2.0", "boost software license version 1 0": "BSL-1.0", "eclipse public license 2 0": "EPL-2.0",
    "unlicense": "Unlicense", "public domain": "Public-Domain", "cc0 1 0 universal": "CC0-1.0", "cc0 1 0": "CC0-1.0", "cc0": "CC0-1.0",
}
# Parts of Creative Commons names.
CC_WORDS = {"by": "attribution", "sa": "sharealike", "nd": "noderivatives", "nc": "noncommercial"}
CC_PARTS, CC_VERSIONS = ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd"), ("1 0", "2 0", "2 5", "3 0", "4 0")
NAMES |= {f"cc {part} {version}": f"CC-{part.upper().replace(' ', '-')}-{version.replace(' ', '.')}" for part in CC_PARTS for version in CC_VERSIONS}
NAMES |= {
    f"creative commons {' '.join(CC_WORDS[p] for p in part.split())} {version}": f"CC-{part.upper().replace(' ', '-')}-{version.replace(' ', '.')}"
    for part in CC_PARTS for version in CC_VERSIONS
}
# Licence identifiers and exceptions of SPDX expressions.
SPDX_IDS = (
    "0BSD AFL-3.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear "
    "BSD-4-Clause BSL-1.0 CC0-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CDDL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 GPL-2.0 GPL-2.0-only GPL-2.0-or-later "
    "GPL-3.0 GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later LPPL-1.3c MIT MIT-0 "
    "MPL-1.1 MPL-2.0 MPL-2.0-no-copyleft-exception MS-PL MS-RL MulanPSL-2.0 NCSA OFL-1.1 OSL-3.0 PostgreSQL PSF-2.0 Python-2.0 Unicode-DFS-2016 Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1"
).split()
SPDX_EXCEPTIONS = "Classpath-exception-2.0 GCC-exception-3.1 LLVM-exception Linux-syscall-note OpenSSL-exception Bison-exception-2.2 Autoconf-exception-3.0 Font-exception-2.0".split()

_VERBS = ("licensed", "licenced", "released", "distributed", "available", "published", "dedicated", "provided")
_NOTICE = re.compile(
    rf"^(?:(?:(?:this|the|all|our|its)(?: \w+){{1,4}}?|(?:source )?code|software|content|documentation|it) (?:is|are) )?(?:re)?(?:{'|'.join(_VERBS)}|made available)"
    r"(?: \w+){0,2}? (?:under|to|into)(?: the terms of)?(?: the| an| a)? (.+?)(?: or (?:at your option )?any later version| only| licen[sc]e| international(?: licen[sc]e)?| see \w+(?: \w+){0,4}| for details)*$"
)
# A field of a header: License: MIT.
_FIELD = re.compile(r"^licen[sc]e (?:is )?(?:the )?(.+?)(?: licen[sc]e)?$")
_SPDX = re.compile(r"SPDX-Licen[sc]e-Identifier:[ \t]*([^\n\r]*)", re.I)
_SPDX_PART = re.compile(r"[()]|[A-Za-z0-9.+-]+")
_COPYRIGHT = re.compile(r"^copyright(?: c)?(?: \d{4})+ ")
_SIGNS = re.compile(r"[^a-z0-9]+")
_CUT = re.compile(r"(?<=[.;:!?])(?<!dentifier:)(?<!icense:)(?<!icence:)\s+|\n[ \t]*\n|\n(?=[ \t]*(?:[-*•]|\d+[.)]|\([a-z0-9]\))[ \t])")
_BULLET = re.compile(r"^\s*(?:(?://|#|--|;|\*+|/\*+)\s*)?(?:[-*•]|\d+[.)]|\([a-z0-9]\))?\s*")


def normalised(sentence: str) -> str:
    return _SIGNS.sub(" ", sentence.lower()).strip()


@dataclass(frozen=True)
class Rule:
    """A licence and the sentence identifiers that show it, in this order."""

    licence: str
    sentences: tuple[str, ...]


# The first rule that matches at a place wins, so longer ones come first.
RULES = (
    Rule("MIT", ("mit-grant", "mit-notice", "mit-as-is", "mit-liability")),
    Rule("MIT", ("mit-grant", "mit-notice", "mit-as-is")),
    Rule("MIT", ("mit-grant", "mit-notice")),
    Rule("ISC", ("isc-grant", "isc-as-is")),
    Rule("ISC", ("isc-grant",)),
    Rule("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse")),
    Rule("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    Rule("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    Rule("Apache-2.0", ("apache-notice", "apache-comply", "apache-copy", "apache-basis")),
    Rule("Apache-2.0", ("apache-notice", "apache-comply")),
    Rule("Apache-2.0", ("apache-notice",)),
    Rule("GPL-3.0", ("gpl-free", "gpl-hope")),
    Rule("GPL-3.0", ("gpl-free",)),
    Rule("GPL-2.0", ("gpl2-free", "gpl-hope")),
    Rule("GPL-2.0", ("gpl2-free",)),
    Rule("GPL-2.0", ("gpl2-only", "gpl-hope")),
    Rule("GPL-2.0", ("gpl2-only",)),
    Rule("LGPL-3.0", ("lgpl3-free", "lgpl-hope")),
    Rule("LGPL-3.0", ("lgpl3-free",)),
    Rule("LGPL-2.1", ("lgpl21-free", "lgpl-hope")),
    Rule("LGPL-2.1", ("lgpl21-free",)),
    Rule("LGPL-2.0", ("lgpl2-free", "lgpl-hope")),
    Rule("LGPL-2.0", ("lgpl2-free",)),
    Rule("AGPL-3.0", ("agpl3-free", "lgpl-hope")),
    Rule("AGPL-3.0", ("agpl3-free",)),
    Rule("Apache-2.0", ("apache-title", "apache-terms", "apache-define")),
    Rule("Apache-2.0", ("apache-title", "apache-terms")),
    Rule("Apache-2.0", ("apache-title",)),
    Rule("Apache-2.0", ("apache-define",)),
    Rule("Apache-2.0", ("apache-comply", "apache-copy")),
    Rule("Apache-2.0", ("apache-copy",)),
    Rule("GPL-3.0", ("gpl3-title", "gpl3-preamble")),
    Rule("GPL-3.0", ("gpl3-title",)),
    Rule("GPL-3.0", ("gpl3-preamble",)),
    Rule("GPL-2.0", ("gpl2-title", "gpl2-preamble")),
    Rule("GPL-2.0", ("gpl2-title",)),
    Rule("LGPL-3.0", ("lgpl3-title",)),
    Rule("LGPL-2.1", ("lgpl21-title",)),
    Rule("AGPL-3.0", ("agpl3-title",)),
    Rule("MPL-2.0", ("mpl-title",)),
    Rule("EPL-2.0", ("epl-title", "epl-provided")),
    Rule("EPL-2.0", ("epl-title",)),
    Rule("BSL-1.0", ("bsl-title", "bsl-grant")),
    Rule("BSL-1.0", ("bsl-grant",)),
    Rule("BSL-1.0", ("bsl-notice",)),
    Rule("Zlib", ("zlib-as-is", "zlib-liable", "zlib-grant")),
    Rule("Zlib", ("zlib-grant",)),
    Rule("WTFPL", ("wtfpl-title", "wtfpl-do")),
    Rule("WTFPL", ("wtfpl-title",)),
    Rule("CC0-1.0", ("cc0-title",)),
    Rule("CC0-1.0", ("cc0-waive",)),
    Rule("CC-BY-4.0", ("cc-work",)),
    Rule("MIT-0", ("mit-0-grant", "mit-as-is")),
    Rule("MIT-0", ("mit-0-grant",)),
    Rule("MPL-2.0", ("mpl-subject",)),
    Rule("Unlicense", ("unlicense-free", "unlicense-anyone")),
    Rule("Unlicense", ("unlicense-free",)),
)
# Other known sentences that may stand between two sentences of a rule.
GAP = 2
# Pieces between cuts that a sentence of the list may have.
JOINED = 6


def spdx_expression(text: str) -> str | None:
    """The SPDX expression at the start of a text, in its usual spelling; None if it has none.

    expression: part, then any number of AND or OR and a part; part: an identifier, perhaps
    with + or WITH an exception, or an expression in parentheses.
    """
    parts = _SPDX_PART.findall(text)
    at = 0

    def expression() -> str | None:
        nonlocal at
        found = part()
        while found and at + 1 < len(parts) and parts[at].upper() in ("AND", "OR"):
            word, back = parts[at].upper(), at
            at += 1
            more = part()
            if more is None:
                at = back
                break
            found = f"{found} {word} {more}"
        return found

    def part() -> str | None:
        nonlocal at
        if at >= len(parts):
            return None
        if parts[at] == "(":
            back = at
            at += 1
            inner = expression()
            if inner is None or at >= len(parts) or parts[at] != ")":
                at = back
                return None
            at += 1
            return f"({inner})"
        plus = parts[at].endswith("+")
        name = _SPDX_NAMES.get(parts[at].removesuffix("+").lower())
        if name is None:
            return None
        at += 1
        name += "+" * plus
        if at + 1 < len(parts) and parts[at].upper() == "WITH" and parts[at + 1].lower() in _SPDX_EXCEPTION_NAMES:
            name += f" WITH {_SPDX_EXCEPTION_NAMES[parts[at + 1].lower()]}"
            at += 2
        return name

    return expression()


_SPDX_NAMES = {n.lower(): n for n in SPDX_IDS}
_SPDX_EXCEPTION_NAMES = {n.lower(): n for n in SPDX_EXCEPTIONS}


class Recognizer:
    """Known sentences and rules, ready for one text after the other."""

    def __init__(self, sentences: dict[str, str] = SENTENCES, names: dict[str, str] = NAMES, rules: tuple[Rule, ...] = RULES):
        self.known: dict[str, str] = {}
        # Sentences with slots, by pattern, and the words between slots.
        self.slotted: list[tuple[re.Pattern, str, str]] = []
        for name, sentence in sentences.items():
            if "<>" in sentence:
                pieces = [normalised(p) for p in sentence.split("<>")]
                first, last = (rf"(?:\w+ ){{0,{SLOT}}}?", rf"(?: \w+){{0,{SLOT}}}?")
                pattern = f"{last} ".join(re.escape(p) for p in pieces if p)
                pattern = (first if not pieces[0] else "") + pattern + (last if not pieces[-1] else "")
                self.slotted.append((re.compile(f"^{pattern}$"), max(pieces, key=len), name))
                continue
            self.known.setdefault(normalised(sentence), name)
        self.names = names
        # A notice is a sentence of its own; its rule has just this sentence.
        notices = tuple(Rule(licence, (f"notice:{licence}",)) for licence in dict.fromkeys(names.values()))
        self.rules: dict[str, list[Rule]] = {}
        for rule in (*rules, *notices):
            self.rules.setdefault(rule.sentences[0], []).append(rule)
        # Words that a text must have for ``identify`` to find anything: one of each known sentence,
        # or the first of a name (in a notice beside a verb).
        self.hints = tuple(dict.fromkeys(["copyright", "spdx", *(max(k.split(), key=len) for k in self.known), *(max(w.split(), key=len) for _, w, _ in self.slotted)]))
        self.first = re.compile("(?<![a-z0-9])(?:" + "|".join(sorted({re.escape(n.split()[0]) for n in names})) + ")(?![a-z0-9])") if names else None

    def hinted(self, text: str) -> bool:
        """Whether the text can have a known sentence at all; never false where it has one."""
        low = text.lower()
        if any(h in low for h in self.hints):
            return True
        return self.first is not None and any(v in low for v in (*_VERBS, "license", "licence")) and self.first.search(low) is not None

    def listed(self, sentence: str) -> str | None:
        """Identifier of a normalised sentence of the list."""
        found = self.known.get(sentence)
        if found:
            return found
        for pattern, words, name in self.slotted:
            if words in sentence and pattern.match(sentence):
                return name
        return None

    def identify(self, sentence: str) -> str | None:
        """Identifier of a normalised sentence: of the list, or ``notice:`` and a licence."""
        found = self.listed(sentence)
        if found:
            return found
        if _COPYRIGHT.match(sentence):
            return "copyright"
        for pattern in (_NOTICE, _FIELD):
            m = pattern.match(sentence)
            if m:
                licence = self.names.get(m[1]) or self.names.get(m[1] + " license") or self.names.get(m[1] + " international")
                if licence:
                    return f"notice:{licence}"
        if sentence.startswith("creative commons ") and (licence := self.names.get(sentence.removesuffix(" license").removesuffix(" international"))):
            return f"notice:{licence}"
        return None

    def sentences(self, text: str) -> list[tuple[int, str]]:
        """Place and identifier of the known sentences.

        A text is cut at sentence ends, semicolons and colons; a sentence of the list may hold up
        to ``JOINED`` such pieces, and the longest that is known counts. Pieces that are none are
        cut at line ends.
        """
        pieces, at = [], 0
        for m in _CUT.finditer(text):
            pieces.append((at, m.start()))
            at = m.end()
        pieces.append((at, len(text)))
        found: dict[int, str] = {}
        i = 0
        while i < len(pieces):
            start, width = pieces[i][0], 1
            for n in range(min(JOINED, len(pieces) - i), 1, -1):
                name = self.listed(self._plain(text[start : pieces[i + n - 1][1]]))
                if name:
                    found.setdefault(self._place(text, start), name)
                    width = n
                    break
            else:
                end = pieces[i][1]
                if not self._look(text, start, end, found) and "\n" in text[start:end].strip():
                    for line in text[start:end].split("\n"):
                        self._look(text, start, start + len(line), found)
                        start += len(line) + 1
            i += width
        return sorted(found.items())

    @staticmethod
    def _place(text: str, start: int) -> int:
        while start < len(text) and text[start].isspace():
            start += 1
        return start

    @staticmethod
    def _plain(piece: str) -> str:
        return normalised(re.sub(r"\n\s*(?://|#|\*)+\s*", " ", _BULLET.sub("", piece, count=1)))

    def _look(self, text: str, start: int, end: int, found: dict[int, str]) -> bool:
        piece = text[start:end]
        spdx = _SPDX.search(piece)
        if spdx:
            expression = spdx_expression(spdx[1])
            if expression:
                found.setdefault(start + spdx.start(), f"spdx:{expression}")
            return True
        name = self.identify(self._plain(piece))
        if name:
            found.setdefault(self._place(text, start), name)
        return name is not None

    def licences(self, ids: list[str]) -> list[tuple[str, int]]:
        """Licences of a sequence of identifiers, with the number of sentences that show each."""
        out: list[tuple[str, int]] = []
        used = [False] * len(ids)
        for i, name in enumerate(ids):
            if used[i]:
                continue
            if name.startswith("spdx:"):
                # The expression is the licence; there are more than a list of rules could hold.
                out.append((name[5:], 1))
                continue
            for rule in self.rules.get(name, ()):
                places = self._follow(rule, ids, used, i)
                if places:
                    for p in places:
                        used[p] = True
                    out.append((rule.licence, len(places)))
                    break
        return out

    @staticmethod
    def _follow(rule: Rule, ids: list[str], used: list[bool], start: int) -> list[int] | None:
        places = [start]
        for wanted in rule.sentences[1:]:
            last = places[-1]
            place = next((p for p in range(last + 1, min(last + 2 + GAP, len(ids))) if ids[p] == wanted and not used[p]), None)
            if place is None:
                return None
            places.append(place)
        return places


FOUND = "doc_id long, n_sentences long, licences string, sentences string, spans string"


def licences(docs: DataFrame, sentences: dict[str, str] = SENTENCES, names: dict[str, str] = NAMES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Licences of every row of ``docs`` (doc_id, text).

    n_sentences: known sentences; licences: found ones, comma-joined in order of the text, each
    once; sentences: the identifiers; spans: identifier:place (code points). Null and empty texts
    and texts without licence have 0 and empty strings. Repeated rows get a row each, a null
    doc_id stays null, other columns are not read. Sentences and rules are fixed lists; nothing
    is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_sentences", pa.int64()), ("licences", pa.string()), ("sentences", pa.string()), ("spans", pa.string())])
        finder = Recognizer(sentences, names, rules)
        for batch in batches:
            rows = []
            for doc, raw in zip(batch.column(0).to_pylist(), texts_of(batch)):
                text = raw.decode("utf-8", "replace") if raw else ""
                if not finder.hinted(text):
                    rows.append((doc, 0, "", "", ""))
                    continue
                found = finder.sentences(text)
                ids = [name for _, name in found]
                shown = dict.fromkeys(licence for licence, _ in finder.licences(ids))
                rows.append((doc, len(ids), ",".join(shown), ",".join(ids), ",".join(f"{n}:{p}" for p, n in found)))
            if rows:
                yield record_batch(schema, zip(*rows))

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, FOUND)
