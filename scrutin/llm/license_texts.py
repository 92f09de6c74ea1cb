"""Licence texts to look for. The published wordings, short ones here, long ones in ``license_files``."""

from __future__ import annotations

import re
from importlib.resources import files

#: Entire short texts, without copyright lines.
SHORT: dict[str, str] = {
    "MIT": """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation
the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
IN THE SOFTWARE.""",
    "ISC": """ISC License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """BSD Zero Clause License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING
IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code
form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all
copyright interest in the software to the public domain. We make this dedication for the benefit of the public at
large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of
relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the
authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to
alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be
appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.

3. This notice may not be removed or altered from any source distribution.""",
}
SHORT["BSD-3-Clause"] = SHORT["BSD-2-Clause"].replace(
    "\n\nTHIS SOFTWARE",
    """

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.

THIS SOFTWARE""",
)

#: The publisher's addresses that printings of one GNU licence differ in.
ADDRESS = re.compile(r"51 Franklin St(?:reet)?, Fifth Floor,\s+Boston,\s+MA\s+02110-1301,?\s+USA")
ADDRESSES = (
    "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
    "51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA",
    "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA",
    "675 Mass Ave, Cambridge, MA 02139, USA",
)
END = "END OF TERMS AND CONDITIONS"


def wordings(text: str) -> list[str]:
    """The printings of one text: bullets for numbers, older words, other addresses, no appendix after the end."""
    found = [text]
    if text.startswith("Redistribution"):
        found += [re.sub(r"(?m)^\d\. ", "* ", t) for t in found]
        found += [t.replace("COPYRIGHT HOLDER OR", "COPYRIGHT OWNER OR") for t in found]
    found += [t.replace("and/or distribute", "and distribute") for t in found]
    found = [ADDRESS.sub(a, t) for t in found for a in ADDRESSES]
    found += [t[: t.index(END) + len(END)] for t in found if END in t]
    return list(dict.fromkeys(found))


def _long() -> dict[str, str]:
    folder = files("scrutin.llm") / "license_files"
    return {f.name.removesuffix(".txt"): f.read_text() for f in folder.iterdir() if f.name.endswith(".txt")}


#: Entire texts by licence, each in all its wordings.
TEXTS: dict[str, list[str]] = {name: wordings(text) for name, text in sorted((SHORT | _long()).items())}

#: Lines above a text that only name it. They are no part of its canonical form.
TITLES: tuple[str, ...] = (
    "License", "The License", "Copyright", "Copyright Notice", "License and Copyright",
    "MIT", "MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT License (Expat)",
    "Expat License", "The Expat License",
    "ISC", "ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC License (ISCL)",
    "0BSD", "BSD Zero Clause License", "Zero Clause BSD", "Zero Clause BSD License", "BSD Zero Clause License (0BSD)",
    "Zero-Clause BSD (0BSD)", "BSD", "BSD License", "The BSD License",
    "BSD 2-Clause", "BSD 2-Clause License", "The BSD 2-Clause License", "2-Clause BSD License", "The 2-Clause BSD License",
    'BSD 2-Clause "Simplified" License', "Simplified BSD License", "The Simplified BSD License", "FreeBSD License",
    "BSD 3-Clause", "BSD 3-Clause License", "The BSD 3-Clause License", "3-Clause BSD License", "The 3-Clause BSD License",
    'BSD 3-Clause "New" or "Revised" License', "New BSD License", "The New BSD License", "Modified BSD License",
    "Revised BSD License",
    "Unlicense", "The Unlicense", "Unlicense License", "Zlib", "Zlib License", "The Zlib License", "Zlib/libpng License",
    "The zlib/libpng License",
    "Apache License", "The Apache License", "Apache License 2.0", "Apache License, Version 2.0", "Apache-2.0",
    "Version 2.0, January 2004", "Apache License Version 2.0, January 2004", "http://www.apache.org/licenses/",
    "GNU General Public License", "The GNU General Public License", "GNU GPL", "GPL",
    "GNU Library General Public License", "GNU Lesser General Public License", "GNU LGPL", "LGPL",
    "GNU General Public License Version 1", "GNU General Public License Version 2", "GNU General Public License Version 3",
    "GNU General Public License v2.0", "GNU General Public License v3.0", "GNU Lesser General Public License v2.1",
    "GNU Lesser General Public License v3.0", "GNU Lesser General Public License Version 2.1",
    "GNU Lesser General Public License Version 3", "GNU Free Documentation License",
    "Version 1, February 1989", "Version 2, June 1991", "Version 2.1, February 1999", "Version 3, 29 June 2007",
    "Version 1.2, November 2002", "Version 1.3, 3 November 2008",
    "Mozilla Public License", "Mozilla Public License Version 1.1", "Mozilla Public License Version 2.0",
    "Mozilla Public License, v. 2.0", "Version 1.1", "Version 2.0", "MPL-2.0",
    "Creative Commons Legal Code", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal", "CC0",
)

#: One-line notices that name a licence.
NOTICES: dict[str, str] = {
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Licensed under CC BY 4.0.": "CC-BY-4.0",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
    "Released under the BSD 3-Clause License.": "BSD-3-Clause",
    "Released under the ISC License.": "ISC",
    "Licensed under the Mozilla Public License, Version 2.0.": "MPL-2.0",
}

#: Spellings that count as the same word.
SPELLINGS: dict[str, str] = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "behaviour": "behavior",
    "calibre": "caliber",
    "cancelled": "canceled",
    "catalogue": "catalog",
    "categorise": "categorize",
    "centre": "center",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "http": "https",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "licenced": "licensed",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "sublicence": "sublicense",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
}
