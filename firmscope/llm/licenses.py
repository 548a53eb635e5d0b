"""Licence recognition: known sentences get identifiers, ordered rules match sequences of identifiers."""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from firmscope.llm.common import map_texts

#: Sentences, as normalise() leaves them, and their identifiers.
SENTENCES = {
    "licensed under the apache license version 2 0": "apache2_ref",
    "licensed under the apache license version 2 0 the license": "apache2_ref",
    "you may not use this file except in compliance with the license": "apache2_use",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache2_copy",
    "you may obtain a copy of the license at https www apache org licenses license 2 0": "apache2_copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache2_asis",
    "see the license for the specific language governing permissions and limitations under the license": "apache2_see",
    "released under the mit license": "mit_ref",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit_grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit_notice",
    "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software": "mit_notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit_asis",
    "this work is licensed under the gnu general public license version 3": "gpl3_ref",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd_grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd_source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd_binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd_names",
    "the name of the author may not be used to endorse or promote products derived from this software without specific prior written permission": "bsd_names",
}
#: Ordered rules: at each place the first whose whole sequence follows applies.
RULES = [
    ("Apache-2.0", ["apache2_ref", "apache2_use", "apache2_copy", "apache2_asis", "apache2_see"]),
    ("Apache-2.0", ["apache2_ref", "apache2_use", "apache2_copy"]),
    ("Apache-2.0", ["apache2_ref"]),
    ("MIT", ["mit_grant", "mit_notice", "mit_asis"]),
    ("MIT", ["mit_ref"]),
    ("GPL-3.0", ["gpl3_ref"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_names"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary"]),
]

# Families whose sentences and rules differ only by a name, a number or a word.
GNU = [("GPL", "gnu general public license", ["2", "3"]), ("LGPL", "gnu lesser general public license", ["2 1", "3"]), ("LGPL", "gnu library general public license", ["2"]), ("AGPL", "gnu affero general public license", ["3"])]
CREATIVE = [("by", "attribution"), ("by sa", "attribution sharealike"), ("by nc", "attribution noncommercial"), ("by nd", "attribution noderivatives"), ("by nc sa", "attribution noncommercial sharealike"), ("by nc nd", "attribution noncommercial noderivatives")]
SPDX = ["MIT", "MIT-0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "ISC", "Zlib", "BSL-1.0", "MPL-2.0", "Unlicense", "WTFPL", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2", "CDDL-1.0", "PostgreSQL", "NCSA", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later"]
#: Further sentences with what they stand for.
MORE = {
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit_liable",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so": "mit0_grant",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "ncsa_grant",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd_asis",
    "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage": "bsd_liable",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc_grant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc_grant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "bsd0_grant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "isc_asis",
    "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software": "isc_liable",
    "this software is provided as is without any express or implied warranty": "zlib_asis",
    "in no event will the authors be held liable for any damages arising from the use of this software": "zlib_liable",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib_grant",
    "the origin of this software must not be misrepresented you must not claim that you wrote the original software": "zlib_origin",
    "if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required": "zlib_thanks",
    "altered source versions must be plainly marked as such and must not be misrepresented as being the original software": "zlib_altered",
    "this notice may not be removed or altered from any source distribution": "zlib_notice",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following": "boost_grant",
    "the copyright notices in the software and this entire statement including the above license grant this restriction and the following disclaimer must be included in all copies of the software in whole or in part and all derivative works of the software unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor": "boost_notice",
    "distributed under the boost software license version 1 0": "boost_ref",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl_ref",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "mpl_copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "mpl_copy",
    "this is free and unencumbered software released into the public domain": "unlicense_ref",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means": "unlicense_grant",
    "you just do what the fuck you want to": "wtfpl_grant",
    "cc0 1 0 universal": "cc0_ref",
    "licensed under cc0 1 0": "cc0_ref",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0": "epl2_ref",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution": "epl1_ref",
    "licensed under the eupl version 1 2": "eupl_ref",
    "licensed under the eupl": "eupl_ref",
    "the contents of this file are subject to the terms of the common development and distribution license the license": "cddl_ref",
    "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies": "postgresql_grant",
    "this library is free software you can redistribute it and or modify it under the same terms as perl itself": "perl_ref",
}
#: Further rules.
MORE_RULES = [
    ("MIT", ["mit_grant", "mit_notice", "mit_asis", "mit_liable"]),
    ("MIT-0", ["mit0_grant", "mit_asis", "mit_liable"]),
    ("MIT-0", ["mit0_grant", "mit_asis"]),
    ("NCSA", ["ncsa_grant"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_names", "bsd_asis", "bsd_liable"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_asis", "bsd_liable"]),
    ("ISC", ["isc_grant", "isc_asis", "isc_liable"]),
    ("ISC", ["isc_grant"]),
    ("0BSD", ["bsd0_grant", "isc_asis", "isc_liable"]),
    ("0BSD", ["bsd0_grant", "isc_asis"]),
    ("Zlib", ["zlib_asis", "zlib_liable", "zlib_grant", "zlib_origin", "zlib_thanks", "zlib_altered", "zlib_notice"]),
    ("Zlib", ["zlib_grant", "zlib_origin"]),
    ("BSL-1.0", ["boost_grant", "boost_notice"]),
    ("BSL-1.0", ["boost_ref"]),
    ("MPL-2.0", ["mpl_ref", "mpl_copy"]),
    ("MPL-2.0", ["mpl_ref"]),
    ("Unlicense", ["unlicense_ref", "unlicense_grant"]),
    ("Unlicense", ["unlicense_ref"]),
    ("WTFPL", ["wtfpl_grant"]),
    ("CC0-1.0", ["cc0_ref"]),
    ("EPL-2.0", ["epl2_ref"]),
    ("EPL-1.0", ["epl1_ref"]),
    ("EUPL-1.2", ["eupl_ref"]),
    ("CDDL-1.0", ["cddl_ref", "apache2_use"]),
    ("CDDL-1.0", ["cddl_ref"]),
    ("PostgreSQL", ["postgresql_grant"]),
    ("Artistic-1.0-Perl OR GPL-1.0-or-later", ["perl_ref"]),
]


def _families() -> tuple[dict[str, str], list[tuple[str, list[str]]]]:
    """Sentences and rules of the families."""
    said: dict[str, str] = {}
    rules: list[tuple[str, list[str]]] = []
    for short, name, versions in GNU:
        see, got = f"see_{name}", f"got_{name}"
        said[f"see the {name} for more details"] = see
        for what in ("program", "library", "file", "software"):
            said[f"this {what} is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"] = "gpl_hope"
            said[f"you should have received a copy of the {name} along with this {what}"] = got
        for v in versions:
            spdx = f"{short}-{v.replace(' ', '.')}" + ("" if " " in v else ".0")
            for end in ("later", "only"):
                key, licence = f"{spdx}_{end}", f"{spdx}-or-later" if end == "later" else f"{spdx}-only"
                for what in ("program", "library", "file", "software"):
                    free = f"this {what} is free software you can redistribute it and or modify it under the terms of the {name}"
                    if end == "later":
                        said[f"{free} as published by the free software foundation either version {v} of the license or at your option any later version"] = key
                    else:
                        said[f"{free} as published by the free software foundation version {v} of the license"] = key
                        said[f"{free} version {v} as published by the free software foundation"] = key
                rules += [(licence, [key, "gpl_hope", see, got]), (licence, [key, "gpl_hope", see]), (licence, [key])]
    for short, name in CREATIVE:
        for v, kind in (("3 0", "unported"), ("4 0", "international")):
            key = f"cc_{short}_{v}"
            for form in (f"a creative commons {name} {v} {kind} license", f"the creative commons {name} {v} {kind} license", f"cc {short} {v}"):
                said[f"licensed under {form}"] = said[f"this work is licensed under {form}"] = key
            rules.append((f"CC-{short.upper().replace(' ', '-')}-{v.replace(' ', '.')}", [key]))
    for spdx in SPDX:
        said[f"spdx license identifier {' '.join(re.findall('[a-z0-9]+', spdx.lower()))}"] = f"spdx_{spdx}"
        rules.append((spdx, [f"spdx_{spdx}"]))
    return said, rules


_said, _rules = _families()
SENTENCES = SENTENCES | MORE | _said
#: Longer rules come first, so that a whole notice is one match.
RULES = sorted(RULES + MORE_RULES + _rules, key=lambda r: -len(r[1]))

_ends = re.compile(r"\n\s*\n|\n(?=[\s*#/;%>!|-]*[A-Z0-9(])|(?<=[.:;!?])\s+")
_other = re.compile(r"[^a-z0-9]+")
#: Numbers of a list, as pieces of their own or before a sentence.
_number = re.compile(r"\W*(?:\d{1,2}|[A-Za-z]|[ivx]{2,4})[.)]?\W*")
_numbered = re.compile(r"\W*(?:\d{1,2}|[A-Za-z]|[ivx]{2,4})\)\s+")


@lru_cache(8)
def _beginnings(sentences: tuple[str, ...]) -> frozenset[str]:
    return frozenset(" ".join(w[:i]) for w in map(str.split, sentences) for i in range(1, len(w) + 1))


def normalise(sentence: str) -> str:
    return _other.sub(" ", sentence.lower()).strip()


def sentence_spans(text: str) -> list[tuple[int, int]]:
    """Places of the pieces of a whole text: its sentences, or parts of them where a line or a clause ends."""
    out, at = [], 0
    for m in _ends.finditer(text):
        out.append((at, m.start()))
        at = m.end()
    out.append((at, len(text)))
    return out


def recognise(text: str | None, sentences: dict[str, str], rules: list[tuple[str, list[str]]]) -> list[tuple[str, int, int, int]]:
    """(licence, start, end, sentences) of each rule met. Sentences between two of a rule end the match, blank ones don't.

    Neighbouring pieces that together make a known sentence are that sentence, so it may be wrapped, be the text of a
    comment or have clauses. Numbers of a list count as blank.
    """
    begins = _beginnings(tuple(sentences))
    text = text or ""
    pieces = []
    for a, b in sentence_spans(text):
        if s := normalise(text[a:b]):
            if s not in begins and (m := _numbered.match(text, a, b)) and (cut := normalise(text[m.end() : b])) in begins:
                a, s = m.end(), cut
            pieces.append((s, a, b))
    ids: list[tuple[str | None, int, int]] = []
    k = 0
    while k < len(pieces):
        s, a, end = pieces[k]
        if s not in begins and _number.fullmatch(text, a, end):
            k += 1
            continue
        best, j = None, k
        while s in begins:
            if s in sentences:
                best = (j, sentences[s])
            j += 1
            if j == len(pieces):
                break
            s = f"{s} {pieces[j][0]}"
        if best:
            ids.append((best[1], a, pieces[best[0]][2]))
            k = best[0] + 1
        else:
            ids.append((None, a, end))
            k += 1
    out, i = [], 0
    while i < len(ids):
        if ids[i][0] is not None:
            for name, need in rules:
                if [x[0] for x in ids[i : i + len(need)]] == need:
                    out.append((name, ids[i][1], ids[i + len(need) - 1][2], len(need)))
                    i += len(need) - 1
                    break
        i += 1
    return out


def scan(docs: DataFrame, keep: list[str], text_col: str = "text", sentences: dict[str, str] | None = None, rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """keep, and for each whole text: licenses (array, sorted, each once), first_start and first_end of the first match
    in characters, n_matches, n_sentences (sentences that matched rules).

    Null, empty and licence-free texts have an empty array, null places and zeros. One row for each row of docs, repeated
    ones too. The tables of sentences and rules are parameters.
    """
    s, r = sentences or SENTENCES, rules or RULES

    def make():
        def work(texts):
            found = [recognise(x, s, r) for x in texts]
            return [
                pa.array([sorted({m[0] for m in f}) for f in found], pa.list_(pa.string())),
                pa.array([f[0][1] if f else None for f in found], pa.int64()),
                pa.array([f[0][2] if f else None for f in found], pa.int64()),
                pa.array([len(f) for f in found], pa.int64()),
                pa.array([sum(m[3] for m in f) for f in found], pa.int64()),
            ]

        return work

    return map_texts(docs, keep, text_col, make, "licenses array<string>, first_start long, first_end long, n_matches long, n_sentences long")
