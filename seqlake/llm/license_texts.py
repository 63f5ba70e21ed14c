"""Texts of public licenses by sections, and the notices and names by which works refer to them."""

from __future__ import annotations

# Fixed values: (label, license, section). Each section is a template of its own.
SECTIONS = (
    ("mit", "MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("mit", "MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", "MIT", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("isc", "ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("isc", "ISC", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("bsd", "BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd", "BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd", "BSD-4-Clause", "All advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("bsd", "BSD-2-Clause", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("zlib", "Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("zlib", "Zlib", "The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered from any source distribution."),
    ("boost", "BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:"),
    ("boost", "BSL-1.0", "The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor."),
    ("unlicense", "Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("wtfpl", "WTFPL", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed."),
    ("apache", "Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("apache", "Apache-2.0", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form."),
    ("apache", "Apache-2.0", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable (except as stated in this section) patent license to make, have made, use, offer to sell, sell, import, and otherwise transfer the Work"),
    ("gpl", "GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("gpl", "GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "GPL-3.0", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("gpl", "GPL-3.0", "The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses for most software and other practical works are designed to take away your freedom to share and change the works."),
    ("lgpl", "LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("lgpl", "LGPL-2.1", "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."),
    ("agpl", "AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("mpl", "MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("mpl", "MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License."),
    ("epl", "EPL-1.0", "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution"),
    ("epl", "EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at"),
    ("epl", "EPL-2.0", "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE (\"AGREEMENT\"). ANY USE, REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT."),
    ("cddl", "CDDL-1.0", "The contents of this file are subject to the terms of the Common Development and Distribution License (the \"License\"). You may not use this file except in compliance with the License."),
    ("eupl", "EUPL-1.2", "Licensed under the European Union Public Licence, Version 1.2 or as soon they will be approved by the European Commission - subsequent versions of the EUPL"),
    ("cc0", "CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights"),
)

# Notices by name, and names that stand for a license wherever they occur.
NOTICES = (
    ("mit", "MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("isc", "ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("unlicense", "Unlicense", "This is free and unencumbered software released into the public domain"),
    ("gpl", "GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("mpl", "MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("mit", "MIT", "released under the MIT license"),
    ("apache", "Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache", "Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("lgpl", "LGPL", "licensed under the GNU Lesser General Public License"),
    ("agpl", "AGPL-3.0", "licensed under the GNU Affero General Public License"),
    ("boost", "BSL-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("boost", "BSL-1.0", "Boost Software License - Version 1.0"),
    ("epl", "EPL-2.0", "Eclipse Public License 2.0"),
    ("epl", "EPL-2.0", "Eclipse Public License - v 2.0"),
    ("epl", "EPL-1.0", "Eclipse Public License - v 1.0"),
    ("mpl", "MPL-2.0", "Mozilla Public License 2.0"),
    ("mpl", "MPL-2.0", "Mozilla Public License Version 2.0"),
    ("eupl", "EUPL-1.2", "European Union Public Licence"),
    ("wtfpl", "WTFPL", "Do What The Fuck You Want To Public License"),
    ("cc0", "CC0-1.0", "CC0 1.0 Universal"),
)
NAMES = (
    ("bsd", "BSD-2-Clause"), ("bsd", "BSD-3-Clause"), ("bsd", "BSD-4-Clause"), ("gpl", "GPL-2.0"), ("gpl", "GPL-3.0"), ("lgpl", "LGPL-2.1"), ("lgpl", "LGPL-3.0"),
    ("agpl", "AGPL-3.0"), ("mpl", "MPL-1.1"), ("mpl", "MPL-2.0"), ("epl", "EPL-1.0"), ("epl", "EPL-2.0"), ("cddl", "CDDL-1.0"), ("eupl", "EUPL-1.2"), ("boost", "BSL-1.0"), ("cc0", "CC0-1.0"),
)
IDENTIFIED = (("mit", "MIT"), ("isc", "ISC"), ("apache", "Apache-2.0"), ("zlib", "Zlib"), ("unlicense", "Unlicense"), ("wtfpl", "WTFPL"))

# Creative Commons licenses are their elements and a version.
ELEMENTS = {
    "by": "Attribution",
    "by-sa": "Attribution-ShareAlike",
    "by-nd": "Attribution-NoDerivatives",
    "by-nc": "Attribution-NonCommercial",
    "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
    "by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}
VERSIONS = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic", "1.0": "Generic"}


def creative_commons() -> list[tuple[str, str, str]]:
    rows = []
    for short, names in ELEMENTS.items():
        for version, ported in VERSIONS.items():
            own = (f"cc-{short}", f"CC-{short.upper()}-{version}")
            rows += [(*own, f"licensed under CC {short} {version}"), (*own, f"CC {short} {version}")]
            rows += [(*own, f"licensed under a Creative Commons {names} {version} {ported} License"), (*own, f"Creative Commons {names} {version}")]
    return rows


def templates() -> list[tuple[str, str, str]]:
    """(label, license, text): sections, notices, names, identifiers in file headers, and Creative Commons licenses."""
    rows = [*SECTIONS, *NOTICES, *((label, name, name) for label, name in NAMES)]
    rows += [(label, name, f"SPDX-License-Identifier: {name}") for label, name in IDENTIFIED]
    return rows + creative_commons()
