"""Licence texts and notices that texts are compared to.

The long ones are the files of ``licenses/``. That of AGPL-3.0 is the text of GPL-3.0 with what
differs put in by hand.
"""

from importlib.resources import files

# Creative Commons licences: elements by abbreviation, versions by jurisdiction. A licence or version
# left out would be taken for its nearest neighbour, so all are here.
_CC_ELEMENTS = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
_CC_VERSIONS = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic", "1.0": "Generic"}
_CC_SHORT = (
    "Licensed under {0}.", "Licensed under {0} License.", "Licensed under the {0} License.",
    "Released under {0}.", "Released under the {0} License.", "Available under {0}.",
    "Distributed under {0}.", "License: {0}.", "This work is licensed under {0}.",
    "This work is licensed under the {0} License.", "This work is licensed under a {0} License.",
    "This content is licensed under {0}.", "Except where otherwise noted, content is licensed under {0}.",
)


def _creative_commons() -> tuple[tuple[str, str], ...]:
    """The notices of every Creative Commons licence, by abbreviation, by name and by identifier."""
    made = []
    for short, long in _CC_ELEMENTS.items():
        # Without a version, which would else be taken for the first one.
        titles = (f"CC {short}", f"Creative Commons {long}")
        made += [(f"CC-{short}", form.format(title)) for title in titles for form in _CC_SHORT]
        for version, where in _CC_VERSIONS.items():
            name = f"CC-{short}-{version}"
            titles = (
                f"CC {short} {version}", f"Creative Commons {long} {version}",
                f"Creative Commons {long} {version} {where}",
            )
            made += [(name, form.format(title)) for title in titles for form in _CC_SHORT]
            made += [
                (name, f"SPDX-License-Identifier: {name}"),
                (name, f"https://creativecommons.org/licenses/{short.lower()}/{version}/"),
            ]
    zero = ("CC0", "CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero 1.0", "Creative Commons CC0 1.0 Universal")
    made += [("CC0-1.0", form.format(title)) for title in zero for form in _CC_SHORT]
    made += [
        ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
        ("CC0-1.0", "https://creativecommons.org/publicdomain/zero/1.0/"),
    ]
    return tuple(made)


_GNU = {"GPL": "", "LGPL": "Lesser ", "AGPL": "Affero "}
_GNU_VERSIONS = (
    ("GPL", "2.0", "2"), ("GPL", "3.0", "3"), ("LGPL", "2.1", "2.1"), ("LGPL", "3.0", "3"), ("AGPL", "3.0", "3"),
)


def _gnu() -> tuple[tuple[str, str], ...]:
    """The notices of the GNU licences, which differ in few words, and their identifiers."""
    made = []
    for short, version, number in _GNU_VERSIONS:
        name, title = f"{short}-{version}", f"GNU {_GNU[short]}General Public License"
        for work in ("program", "library", "software"):
            notice = f"""This {work} is free software: you can redistribute it and/or modify it under the
terms of the {title} as published by the Free Software Foundation, either version {number} of the
License, or (at your option) any later version. This {work} is distributed in the hope that it will be
useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
PARTICULAR PURPOSE. See the {title} for more details."""
            had = f" You should have received a copy of the {title} along with this {work}."
            made += [(name, notice), (name, notice + had)]
        made += [
            (name, f"SPDX-License-Identifier: {name}{which}") for which in ("", "-only", "-or-later")
        ]
        made.append((name, f"This work is licensed under the {title}, version {number}."))
    return tuple(made)


def _long() -> tuple[tuple[str, str], ...]:
    """The licences of ``licenses/`` in full, on one line each."""
    found = sorted((f for f in files(__package__).joinpath("licenses").iterdir()), key=lambda f: f.name)
    return tuple(
        (f.name.removesuffix(".txt"), " ".join(f.read_text("utf-8").split())) for f in found
        if f.name.endswith(".txt")
    )


# Public licence texts and the usual notices, by identifier.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE
SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "This work is licensed under the MIT License."),
    ("MIT", "Distributed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met: 1. Redistributions of
source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list
of conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING
IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met: 1. Redistributions of
source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list
of conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may
be used to endorse or promote products derived from this software without specific prior written
permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING
IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with
or without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT
SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0", """This program is free software; you can redistribute it and/or modify it under the
terms of the GNU General Public License as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version. This program is distributed in the hope that it
will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the
terms of the GNU General Public License as published by the Free Software Foundation, either version 3
of the License, or (at your option) any later version. This program is distributed in the hope that it
will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have
received a copy of the GNU General Public License along with this program."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Released under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v.
2.0. If a copy of the MPL was not distributed with this file, You can obtain one at
https://mozilla.org/MPL/2.0/."""),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("CC0-1.0", """To the extent possible under law, the author has waived all copyright and related
or neighboring rights to this work."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is
free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code
form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no
event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial
applications, and to alter it and redistribute it freely, subject to the following restrictions:"""),
    ("Proprietary", "Copyright. All rights reserved."),
) + _creative_commons() + _gnu() + _long()
