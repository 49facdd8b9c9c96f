"""License wordings as templates.

``<<beginOptional>>...<<endOptional>>`` encloses wording that may be left out; ``<<var;match="{a,b}">>``
stands for a to b words of any kind. All other words are mandatory. Case and punctuation don't count.
"""

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# The wording of public licenses and of the usual notices that name them.
_MIT_GRANT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions: The above copyright notice and this permission notice
<<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or
substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;match="{1,12}">> BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE
"""
_BSD_GRANT = """
Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: <<beginOptional>>1<<endOptional>> Redistributions of
source code must retain the above copyright notice, this list of conditions and the following
disclaimer. <<beginOptional>>2<<endOptional>> Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer in the documentation and/or
other materials provided with the distribution.
"""
_BSD_NAMES = """
<<beginOptional>>3<<endOptional>> Neither the name of <<var;match="{1,15}">> nor the names of
<<var;match="{1,8}">> may be used to endorse or promote products derived from this software without
specific prior written permission.
"""
_BSD_WARRANTY = 'THIS SOFTWARE IS PROVIDED BY <<var;match="{1,15}">> AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES'

# Label and template.
TEMPLATES = {
    "mit-text": _MIT_GRANT,
    "bsd-3-clause-text": _BSD_GRANT + _BSD_NAMES + _BSD_WARRANTY,
    "bsd-2-clause-text": _BSD_GRANT + _BSD_WARRANTY,
    "isc-text": """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without
        fee is hereby granted, provided that the above copyright notice and this permission notice appear
        in all copies
    """,
    "apache-2.0-notice": """
        Licensed under the Apache License, Version 2.0
        <<beginOptional>>(the "License"); you may not use <<var;match="{1,3}">> except in compliance with
        the License. You may obtain a copy of the License at <<var;match="{1,12}">> Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on
        an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied
        <<endOptional>>
    """,
    "gpl-notice": """
        licensed under the <<beginOptional>>terms of the<<endOptional>> GNU
        <<beginOptional>>Lesser<<endOptional>> <<beginOptional>>Affero<<endOptional>>
        General Public License <<beginOptional>>version <<var;match="{1,2}">><<endOptional>>
    """,
    "gpl-text": """
        you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation; either version <<var;match="{1,2}">> of the License, or
        (at your option) any later version
    """,
    "cc-by-notice": """
        licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> CC BY
        <<beginOptional>>NC<<endOptional>> <<beginOptional>>SA<<endOptional>>
        <<beginOptional>>ND<<endOptional>> <<var;match="{1,1}">> 0
    """,
    "cc-by-text": """
        licensed under a Creative Commons Attribution <<beginOptional>>NonCommercial<<endOptional>>
        <<beginOptional>>ShareAlike<<endOptional>> <<beginOptional>>NoDerivatives<<endOptional>>
        <<var;match="{1,2}">> <<beginOptional>>International<<endOptional>> License
    """,
    "mit-notice": """
        <<beginOptional>>released<<endOptional>> <<beginOptional>>licensed<<endOptional>>
        under the MIT License
    """,
}
