"""Usual notices and short whole texts of public licenses; long whole texts are files in ``license_texts``.

Copyright lines, names and years are left out, as they differ. Only the driver reads the files.
"""

from __future__ import annotations

from importlib import resources

_GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}"
    "General Public License as published by the Free Software Foundation, either version {version} of the License, "
    "or (at your option) any later version.")
_GPL_ONLY = (
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {kind}"
    "General Public License version {version} as published by the Free Software Foundation.")
_MPL_1 = (
    "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not "
    "use this file except in compliance with the License. You may obtain a copy of the License at "
    "http://www.mozilla.org/MPL/ Software distributed under the License is distributed on an \"AS IS\" basis, WITHOUT "
    "WARRANTY OF ANY KIND, either express or implied. See the License for the specific language governing rights and "
    "limitations under the License.")
_GFDL = (
    "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free "
    "Documentation License, Version {version} or any later version published by the Free Software Foundation; with no "
    "Invariant Sections, no Front-Cover Texts, and no Back-Cover Texts.")
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so")
_MIT_WARRANTY = (
    " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE.")
_BSD_1 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution.")
_BSD_ADVERTISING = (
    " 3. All advertising materials mentioning features or use of this software must display the following "
    "acknowledgement: This product includes software developed by the organization.")
_BSD_NAME = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.")
_BSD_WARRANTY = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
    "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC_WARRANTY = (
    " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE.")
_BY = "licensed under a Creative Commons {kind} {version} License"

#: (license, words) of notices that stand for a license, and of licenses that are short as a whole.
NOTICES: list[tuple[str, str]] = [
    ("Apache-2.0",
     "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
     "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
     "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
     "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
     "specific language governing permissions and limitations under the License."),
    ("GPL-2.0", _GPL.format(kind="", version="2")),
    ("GPL-3.0", _GPL.format(kind="", version="3")),
    ("LGPL-2.0", _GPL.format(kind="Library ", version="2")),
    ("LGPL-2.1", _GPL.format(kind="Lesser ", version="2.1")),
    ("LGPL-3.0", _GPL.format(kind="Lesser ", version="3")),
    ("AGPL-3.0", _GPL.format(kind="Affero ", version="3")),
    ("GPL-2.0", _GPL_ONLY.format(kind="", version="2")),
    ("GPL-3.0", _GPL_ONLY.format(kind="", version="3")),
    ("LGPL-2.1", _GPL_ONLY.format(kind="Lesser ", version="2.1")),
    ("MPL-1.1", _MPL_1),
    ("MPL-2.0",
     "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("EPL-1.0",
     "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 "
     "which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    ("EPL-2.0",
     "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
     "which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("GFDL-1.2", _GFDL.format(version="1.2")),
    ("GFDL-1.3", _GFDL.format(version="1.3")),
    ("CC0-1.0",
     "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this "
     "work."),
    *[(f"CC-{short}-{version}", _BY.format(kind=kind, version=f"{version} {scope}"))
      for version, scope in (("3.0", "Unported"), ("4.0", "International"))
      for short, kind in (
          ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
          ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
          ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))],
    ("MIT",
     f"{_MIT_GRANT}, subject to the following conditions: The above copyright notice and this permission notice shall be "
     f"included in all copies or substantial portions of the Software.{_MIT_WARRANTY}"),
    ("MIT-0", f"{_MIT_GRANT}.{_MIT_WARRANTY}"),
    ("BSD-2-Clause", f"{_BSD_1}{_BSD_WARRANTY}"),
    ("BSD-3-Clause", f"{_BSD_1} 3.{_BSD_NAME}{_BSD_WARRANTY}"),
    ("BSD-4-Clause", f"{_BSD_1}{_BSD_ADVERTISING} 4.{_BSD_NAME}{_BSD_WARRANTY}"),
    ("ISC",
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."
     f"{_ISC_WARRANTY}"),
    ("0BSD",
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     f"granted.{_ISC_WARRANTY}"),
    ("Zlib",
     "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
     "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
     "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
     "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
     "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
     "would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not "
     "be misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
     "distribution."),
    ("BSL-1.0",
     "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
     "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, "
     "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties "
     "to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software "
     "and this entire statement, including the above license grant, this restriction and the following disclaimer, must "
     "be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless "
     "such copies or derivative works are solely in the form of machine-executable object code generated by a source "
     "language processor."),
    ("Unlicense",
     "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
     "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
     "purpose, commercial or non-commercial, and by any means."),
    ("WTFPL",
     "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it "
     "is allowed as long as the name is changed. DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR "
     "COPYING, DISTRIBUTION AND MODIFICATION 0. You just DO WHAT THE FUCK YOU WANT TO."),
]


def whole_texts() -> list[tuple[str, str]]:
    """(license, words) of the long licenses."""
    files = sorted(resources.files(__package__).joinpath("license_texts").iterdir(), key=lambda f: f.name)
    return [(f.name.removesuffix(".txt"), f.read_text(encoding="utf-8")) for f in files if f.name.endswith(".txt")]
