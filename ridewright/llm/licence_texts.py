"""Public licence notices, by label, and phrases that name a licence by themselves."""

NOTICES: list[tuple[str, str]] = [
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all
        copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY
        KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
        PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR
        ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
        OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file"),
    (
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce
        the above copyright notice, this list of conditions and the following disclaimer in the documentation
        and/or other materials provided with the distribution.""",
    ),
    (
        "bsd",
        """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission.""",
    ),
    ("bsd", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all
        copies.""",
    ),
    (
        "apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS
        OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.""",
    ),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "gpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version. This program is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE. See the GNU General Public License for more details.""",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    (
        "lgpl",
        """This library is free software; you can redistribute it and/or modify it under the terms of the GNU
        Lesser General Public License as published by the Free Software Foundation""",
    ),
    (
        "mpl-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    (
        "cc0",
        """To the extent possible under law, the author has dedicated all copyright and related and neighboring
        rights to this work to the public domain worldwide""",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    (
        "boost",
        """Distributed under the Boost Software License, Version 1.0. See accompanying file LICENSE_1_0.txt or copy
        at http://www.boost.org/LICENSE_1_0.txt""",
    ),
]

PHRASES: list[tuple[str, str]] = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]
