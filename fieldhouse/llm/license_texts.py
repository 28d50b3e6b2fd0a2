"""Passages of public licenses and notices, by the label that they stand for."""

from __future__ import annotations

BASE = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

TEXTS = [
    ("agpl-3", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("all-rights-reserved", "all rights reserved"),
    ("apache-2", "licensed under the Apache License, Version 2.0"),
    ("apache-2", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution."""),
    ("bsd-3", """may be used to endorse or promote products derived from this software without specific prior written
        permission"""),
    ("bsl-1", """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
        accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute,
        and transmit the Software, and to prepare derivative works of the Software"""),
    ("cc-by", "licensed under cc by 4.0"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "licensed under cc by-nc 4.0"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial"),
    ("cc-by-nd", "Creative Commons Attribution-NoDerivatives"),
    ("cc-by-sa", "licensed under cc by-sa 4.0"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike"),
    ("cc0", """To the extent possible under law, the author has waived all copyright and related or neighboring rights to this
        work"""),
    ("gpl-2", "licensed under the GNU General Public License, version 2"),
    ("gpl-2", """under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2
        of the License, or (at your option) any later version"""),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    ("gpl-3", """under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3
        of the License, or (at your option) any later version"""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("lgpl", """under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"""),
    ("mit", "released under the MIT license"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software."""),
    ("mpl-2", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means."""),
    ("zlib", """Permission is granted to anyone to use this software for any purpose, including commercial applications, and to
        alter it and redistribute it freely, subject to the following restrictions"""),
]
