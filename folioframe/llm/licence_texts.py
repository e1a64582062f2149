"""Known licence texts and notices, as their publishers word them (fixed values)."""

from pathlib import Path

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
)
_MIT_DISCLAIMER = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_MIT_BODY = (
    f"{_MIT_GRANT}subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies "
    f"or substantial portions of the Software.\n\n{_MIT_DISCLAIMER}"
)
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n"
_BSD_TWO = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.\n\n"
)
_BSD_THREE = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission.\n\n"
)
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
    "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON "
    "ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
    "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_DISCLAIMER = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
    "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)

_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
    "arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial "
    "applications, and to alter it and redistribute it freely, subject to the following restrictions:\n\n1. The origin of this software must not "
    "be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the "
    "product documentation would be appreciated but is not required.\n\n2. Altered source versions must be plainly marked as such, and must not "
    "be misrepresented as being the original software.\n\n3. This notice may not be removed or altered from any source distribution."
)
_BOOST = (
    "Boost Software License - Version 1.0 - August 17th, 2003\n\nPermission is hereby granted, free of charge, to any person or organization "
    'obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, '
    "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
    "Software is furnished to do so, all subject to the following:\n\nThe copyright notices in the Software and this entire statement, including "
    "the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, "
    "and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code "
    'generated by a source language processor.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
    "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)

#: (licence, text): whole licences, and notices that stand for one.
KNOWN: tuple[tuple[str, str], ...] = (
    ("MIT", _MIT_BODY),
    ("MIT", f"MIT License\n\n{_MIT_BODY}"),
    ("MIT", f"The MIT License (MIT)\n\n{_MIT_BODY}"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT-0", f"{_MIT_GRANT.removesuffix(', ')}.\n\n{_MIT_DISCLAIMER}"),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TWO + _BSD_DISCLAIMER),
    ("BSD-2-Clause", f"BSD 2-Clause License\n\n{_BSD_HEAD}{_BSD_TWO}{_BSD_DISCLAIMER}"),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_TWO + _BSD_THREE + _BSD_DISCLAIMER),
    ("BSD-3-Clause", f"BSD 3-Clause License\n\n{_BSD_HEAD}{_BSD_TWO}{_BSD_THREE}{_BSD_DISCLAIMER}"),
    ("ISC", f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_DISCLAIMER}"),
    ("ISC", f"ISC License\n\n{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_DISCLAIMER}"),
    ("0BSD", f"{_ISC_GRANT}.\n\n{_ISC_DISCLAIMER}"),
    ("Zlib", _ZLIB),
    ("Zlib", f"zlib License\n\n{_ZLIB}"),
    ("BSL-1.0", _BOOST),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may '
        "obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either '
        "express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
)


def full_texts() -> tuple[tuple[str, str], ...]:
    """(licence, text) of the licences in ``full_texts``, one file each, named by licence; also without the appendix behind the terms."""
    found = []
    for path in sorted(Path(__file__).with_name("full_texts").glob("*.txt")):
        text, end = path.read_text("utf-8"), "END OF TERMS AND CONDITIONS"
        found += [(path.stem, text)] + [(path.stem, text.partition(end)[0] + tail) for tail in ("", end) if end in text]
    return tuple(found)
