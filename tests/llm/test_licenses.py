"""Official notices, wrapped as they are published and as comments."""

import pytest

from firmscope.llm.licenses import RULES, SENTENCES, recognise

MIT = '''MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE FOR ANY CLAIM.
'''
BSD2 = '''Copyright (c) 2020, Some One

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
'''
BSD3 = BSD2 + '''
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
'''
GPL3 = '''This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
'''
GPL2 = GPL3.replace("software: you", "software; you").replace("Foundation, either version 3", "Foundation; either version 2")
APACHE = '''Copyright 2020 Some One

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
'''
CASES = [("MIT", 3, MIT), ("BSD-2-Clause", 3, BSD2), ("BSD-2-Clause", 3, BSD2.replace("1. ", "(1) ").replace("2. ", "b) ")), ("BSD-3-Clause", 4, BSD3), ("GPL-3.0-or-later", 3, GPL3), ("GPL-2.0-or-later", 3, GPL2), ("Apache-2.0", 5, APACHE)]


@pytest.mark.parametrize("prefix", ["", "# ", " * ", "// ", ";; ", "% "])
@pytest.mark.parametrize(("name", "n", "text"), CASES)
def test_official_notices(name, n, text, prefix):
    whole = "".join(prefix + line for line in text.splitlines(keepends=True))
    got = recognise(whole, SENTENCES, RULES)
    assert [(g[0], g[3]) for g in got] == [(name, n)]
    assert whole[got[0][2] - 1] in ".,:;" or whole[got[0][2] - 2] == "."


def test_other_sentences_end_a_match():
    assert recognise(BSD2.replace("\n2. ", "\nNo.\n\nOr so.\n\n2. "), SENTENCES, RULES) == []
    assert recognise("It is not released under the MIT license.", SENTENCES, RULES) == []
    assert recognise(None, SENTENCES, RULES) == recognise("", SENTENCES, RULES) == []


GNU = """This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name}General Public License as published by the Free Software Foundation, {which}.

This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU {name}General Public License for more details.

You should have received a copy of the GNU {name}General Public License along with this {what}.  If not, see <https://www.gnu.org/licenses/>.
"""
LATER, ONLY = "either version {v} of the License, or (at your option) any later version", "version {v} of the License"
AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
GRANT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so'
BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
ISC_END = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
WHOLE = {
    "MIT": f"{GRANT}, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n{AS_IS}",
    "MIT-0": f"{GRANT}.\n\n{AS_IS}",
    "NCSA": GRANT.replace("deal in the", "deal with the") + ", subject to the following conditions:",
    "BSD-2-Clause": f"{BSD2}\n{BSD_END}",
    "BSD-3-Clause": f"{BSD3}\n{BSD_END}",
    "ISC": f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n{ISC_END}",
    "0BSD": f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n{ISC_END}",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n3. This notice may not be removed or altered from any source distribution.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "WTFPL": "0. You just DO WHAT THE FUCK YOU WANT TO.",
    "CC0-1.0": "CC0 1.0 Universal",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "EPL-1.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution.",
    "EUPL-1.2": "Licensed under the EUPL, Version 1.2.",
    "CDDL-1.0": 'The contents of this file are subject to the terms of the Common Development and Distribution License (the "License"). You may not use this file except in compliance with the License.',
    "PostgreSQL": "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies.",
    "Apache-2.0": APACHE,
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-3.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.",
    "CC-BY-NC-ND-4.0": "This work is licensed under the Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "GPL-2.0-or-later": GNU.format(what="program", name="", which=LATER.format(v=2)).replace("software: you", "software; you").replace("Foundation, either", "Foundation; either"),
    "GPL-2.0-only": GNU.format(what="program", name="", which=ONLY.format(v=2)),
    "GPL-3.0-or-later": GNU.format(what="program", name="", which=LATER.format(v=3)),
    "LGPL-2.1-or-later": GNU.format(what="library", name="Lesser ", which=LATER.format(v="2.1")),
    "LGPL-3.0-or-later": GNU.format(what="library", name="Lesser ", which=LATER.format(v=3)),
    "AGPL-3.0-or-later": GNU.format(what="program", name="Affero ", which=LATER.format(v=3)),
    "AGPL-3.0-only": GNU.format(what="program", name="Affero ", which=ONLY.format(v=3)),
}


def wrapped(text, width):
    import textwrap

    return "\n".join(line for p in text.split("\n") for line in (textwrap.wrap(p, width, break_long_words=False, break_on_hyphens=False) or [""]))


@pytest.mark.parametrize("name", sorted(WHOLE))
def test_whole_notices(name):
    """Each as it stands, wrapped at two widths, as comments, and as a numbered list of paragraphs: one match of its licence."""
    text = WHOLE[name]
    paragraphs = [p for p in text.split("\n\n") if p.strip()]
    forms = [text, wrapped(text, 72), wrapped(text, 40), *("".join(mark + line for line in wrapped(text, 72).splitlines(keepends=True)) for mark in (" * ", "# ", "// ", "-- "))]
    if not any(p[:1].isdigit() for p in paragraphs):  # those have numbers of their own
        forms += ["\n\n".join(f"{i}. {p}" for i, p in enumerate(paragraphs, 1)), "\n\n".join(f"({'abcdefgh'[i]}) {p}" for i, p in enumerate(paragraphs))]
    for form in forms:
        assert [m[0] for m in recognise("Copyright 2020 Some One.\n\n" + form + "\n\nint main() {}\n", SENTENCES, RULES)] == [name], form


def test_identifiers():
    assert [m[0] for m in recognise("// SPDX-License-Identifier: LGPL-2.1-or-later\n\n// SPDX-License-Identifier: MIT\n", SENTENCES, RULES)] == ["LGPL-2.1-or-later", "MIT"]
    assert recognise("SPDX-License-Identifier: Nonesuch", SENTENCES, RULES) == []
