"""Licence bodies and standard headers, by SPDX id; the long licences are the
files of ``licenses``."""

from __future__ import annotations

from importlib import resources

_AS_IS = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
          "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
          "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
          "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
          "THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_MIT_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
              'associated documentation files (the "Software"), to deal in the Software without restriction, including '
              "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
              "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
              "the following conditions:")
_MIT_KEEP = ("The above copyright notice and this permission notice shall be included in all copies or substantial "
             "portions of the Software.")
_BSD_TERMS = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
              "that the following conditions are met: 1. Redistributions of source code must retain the above "
              "copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary "
              "form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
              "in the documentation and/or other materials provided with the distribution.")
_BSD_NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
              "promote products derived from this software without specific prior written permission.")
_BSD_AS_IS = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
              "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
              "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR "
              "ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
              "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
              "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
              "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
              "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC_GRANT = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
              "hereby granted, provided that the above copyright notice and this permission notice appear in all "
              "copies.")
_ISC_AS_IS = ('THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
              "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
              "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
              "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
              "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")


def _gnu(name: str, version: str, what: str = "program", title: str = "This program") -> list[str]:
    """The header the GNU licences recommend: its grant, and all of it."""
    grant = (f"{title} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} "
             f"as published by the Free Software Foundation; either version {version} of the License, or (at your "
             "option) any later version.")
    rest = (f"{title} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
            "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
            f"{name} for more details. You should have received a copy of the GNU {name} along with this {what}. "
            "If not, see <https://www.gnu.org/licenses/>.")
    return [grant, f"{grant} {rest}"]


TEXTS = {
    "MIT": [_MIT_GRANT, f"{_MIT_GRANT} {_MIT_KEEP} {_AS_IS}"],
    "BSD-2-Clause": [f"{_BSD_TERMS} {_BSD_AS_IS}"],
    "BSD-3-Clause": [f"{_BSD_TERMS} {_BSD_NAMES}", f"{_BSD_TERMS} {_BSD_NAMES} {_BSD_AS_IS}"],
    "ISC": [_ISC_GRANT, f"{_ISC_GRANT} {_ISC_AS_IS}"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                   "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                   "language governing permissions and limitations under the License."],
    "GPL-2.0": _gnu("General Public License", "2"),
    "GPL-3.0": _gnu("General Public License", "3"),
    "LGPL-2.1": _gnu("Lesser General Public License", "2.1", "library", "This library"),
    "LGPL-3.0": _gnu("Lesser General Public License", "3"),
    "AGPL-3.0": _gnu("Affero General Public License", "3"),
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
                "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License v. 2.0 which is available at http://www.eclipse.org/legal/epl-2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain. Anyone is free to copy, "
                  "modify, publish, use, compile, sell, or distribute this software, either in source code form or as "
                  "a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
}
FILES = ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0")


def texts() -> list[tuple[str, str]]:
    """(license_id, text) of bodies, headers and whole licences."""
    folder = resources.files(__package__).joinpath("licenses")
    return [(k, t) for k, v in TEXTS.items() for t in v] + [
        (k, folder.joinpath(f"{k}.txt").read_text(encoding="utf-8")) for k in FILES]
