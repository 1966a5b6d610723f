"""Standard license bodies and headers, without titles and names of holders; None stands for other licenses."""

_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
to do so"""
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_ADVERTISING = """3. All advertising materials mentioning features or use of this software must display the following acknowledgement:
This product includes software developed by the organization."""
_BSD_NAMES = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_GNU = "redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, {}"
_GENERAL, _LESSER, _AFFERO = "General Public License", "Lesser General Public License", "Affero General Public License"


def _gnu(name: str, version: str) -> list[str]:
    return [_GNU.format(name, v.format(version)) for v in ("either version {} of the License, or (at your option) any later version", "version {} of the License", "version {}")]


BODIES = [
    ("MIT", f"{_MIT_GRANT}, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_AS_IS}"),
    (None, f"{_MIT_GRANT}. {_AS_IS}"),  # MIT-0
    ("ISC", f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_END}"),
    (None, f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. {_ISC_END}"),  # 0BSD
    ("BSD-2-Clause", f"{_BSD_START} {_BSD_END}"),
    ("BSD-3-Clause", f"{_BSD_START} 3. {_BSD_NAMES} {_BSD_END}"),
    (None, f"{_BSD_START} {_BSD_ADVERTISING} 4. {_BSD_NAMES} {_BSD_END}"),  # with the advertising clause
    ("Unlicense", f"""This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that
recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication
for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law. {_AS_IS.replace(" OR COPYRIGHT" + chr(10) + "HOLDERS", "")}"""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of
the License at http://www.apache.org/licenses/LICENSE-2.0"""),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    (None, "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    *[(id_, t) for id_, name, version in (
        ("GPL-3.0", _GENERAL, "3"), ("GPL-2.0", _GENERAL, "2"), (None, _GENERAL, "1"), ("LGPL-3.0", _LESSER, "3"), (None, _LESSER, "2.1"), (None, _LESSER, "2"),
        (None, "Library General Public License", "2"), ("AGPL-3.0", _AFFERO, "3"), (None, _AFFERO, "1"),
    ) for t in _gnu(name, version)],
]

#: First words of whole license texts; what such a text says of other licenses states nothing.
TITLES = [
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"), ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"), ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"), ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions"),
    (None, "GNU Lesser General Public License Version 2.1, February 1999"), (None, "GNU Library General Public License Version 2, June 1991"),
]
