"""Hand-written license signatures, one a line: label, priority, confidence, expression.

Expressions are matched on the normal form: words in lower case with one space
between, signs gone (``GPL-2.0+`` reads ``gpl 2 0``).  Priorities: 90 whole
sentences of a license text, 80 identifiers, 70 notices that name a license in
full, 60 grants under a short name, 55 "X licensed", 50 names with a version,
45 identifiers that stand alone (as in source headers and package files), 40
full names, 30 short names, 20 links, 10 hints.
"""

from __future__ import annotations

import re

# The signatures.
SIGNATURES = """
mit 90 0.95 permission is hereby granted free of charge to any person obtaining a copy
mit 90 0.9 the above copyright notice and this permission notice shall be included in all copies
mit 90 0.85 subject to the following conditions the above copyright notice and this permission
mit 80 1.0 spdx licen[sc]e identifier mit
mit-0 80 1.0 spdx licen[sc]e identifier mit 0
mit 70 0.95 licen[sc]ed under (?:the )?(?:terms of )?(?:the )?mit(?: expat)? licen[sc]e
mit 60 0.9 under (?:the )?(?:terms of )?(?:the )?mit
mit 40 0.9 (?:the )?mit expat licen[sc]e
mit 30 0.8 mit licen[sc]e
mit 30 0.8 licen[sc]e (?:is )?(?:the )?mit
mit 20 0.85 opensource org licen[sc]es mit
apache 90 0.95 licensed under the apache license version 2 0 the license
apache 90 0.95 you may not use this file except in compliance with the license
apache 90 0.9 without warranties or conditions of any kind either express or implied
apache 90 0.9 unless required by applicable law or agreed to in writing software distributed under the license
apache 80 1.0 spdx licen[sc]e identifier apache 2 0
apache 80 1.0 spdx licen[sc]e identifier apache 1 [01]
apache 70 0.95 licen[sc]ed under (?:the )?(?:terms of )?(?:the )?apache(?: software)? licen[sc]e
apache 60 0.9 under (?:the )?(?:terms of )?(?:the )?apache
apache 50 0.95 apache(?: software)? licen[sc]e (?:v|ver|version) ?[12](?: [01])?
apache 50 0.9 apache 2 0 licen[sc]e
apache 30 0.85 apache(?: software)? licen[sc]e
apache 30 0.8 licen[sc]e (?:is )?(?:the )?apache
apache 20 0.9 apache org licen[sc]es licen[sc]e 2 0
gpl 90 0.95 you can redistribute it and or modify it under the terms of the gnu general public license
gpl 90 0.9 you should have received a copy of the gnu general public license
gpl 90 0.85 see the gnu general public license for more details
gpl 90 0.85 the gnu general public license is a free copyleft license
gpl 90 0.85 without any warranty without even the implied warranty of merchantability or fitness for a particular purpose
gpl 80 1.0 spdx licen[sc]e identifier gpl [123](?: 0)?(?: only| or later)?
gpl 70 0.95 under (?:the )?(?:terms of )?(?:the )?gnu general public(?: licen[sc]e)?
gpl 60 0.9 under (?:the )?(?:terms of )?(?:the )?gpl
gpl 60 0.9 under (?:the )?(?:terms of )?(?:the )?general public
gpl 50 0.95 gnu general public licen[sc]e (?:v|ver|version) ?[123](?: 0)?
gpl 50 0.9 gnu gpl (?:v|ver|version) ?[123] licen[sc]e
gpl 40 0.9 gnu general public licen[sc]e
gpl 40 0.8 general public licen[sc]e
gpl 30 0.8 gpl(?: ?v?[123])? licen[sc]e
gpl 30 0.75 licen[sc]e (?:is )?(?:the )?(?:gnu )?gpl
gpl 20 0.85 gnu org licen[sc]es gpl
lgpl 90 0.95 you can redistribute it and or modify it under the terms of the gnu lesser general public license
lgpl 90 0.95 you can redistribute it and or modify it under the terms of the gnu library general public license
lgpl 90 0.9 you should have received a copy of the gnu lesser general public license
lgpl 90 0.9 you should have received a copy of the gnu library general public license
lgpl 80 1.0 spdx licen[sc]e identifier lgpl [23](?: [01])?(?: only| or later)?
lgpl 70 0.95 under (?:the )?(?:terms of )?(?:the )?gnu (?:lesser|library) general public(?: licen[sc]e)?
lgpl 60 0.9 under (?:the )?(?:terms of )?(?:the )?lgpl
lgpl 60 0.9 under (?:the )?(?:terms of )?(?:the )?(?:lesser|library) general public
lgpl 50 0.95 (?:lesser|library) general public licen[sc]e (?:v|ver|version) ?[23](?: [01])?
lgpl 40 0.9 (?:lesser|library) general public licen[sc]e
lgpl 30 0.8 lgpl(?: ?v?[23])? licen[sc]e
lgpl 20 0.85 gnu org licen[sc]es lgpl
agpl 90 0.95 you can redistribute it and or modify it under the terms of the gnu affero general public license
agpl 90 0.9 you should have received a copy of the gnu affero general public license
agpl 80 1.0 spdx licen[sc]e identifier agpl [13](?: 0)?(?: only| or later)?
agpl 70 0.95 under (?:the )?(?:terms of )?(?:the )?(?:gnu )?affero general public(?: licen[sc]e)?
agpl 60 0.9 under (?:the )?(?:terms of )?(?:the )?agpl
agpl 40 0.9 affero general public licen[sc]e
agpl 30 0.8 agpl(?: ?v?3)? licen[sc]e
gfdl 90 0.95 permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gfdl 90 0.9 with no invariant sections no front cover texts and no back cover texts a copy of the license
gfdl 80 1.0 spdx licen[sc]e identifier gfdl 1 [123]
gfdl 40 0.9 (?:gnu )?free documentation licen[sc]e
gfdl 30 0.8 gfdl licen[sc]e
bsd 90 0.95 redistribution and use in source and binary forms with or without modification are permitted
bsd 90 0.9 redistributions of source code must retain the above copyright notice
bsd 90 0.9 redistributions in binary form must reproduce the above copyright notice
bsd 90 0.9 neither the name of the copyright holder nor the names of its contributors
bsd 90 0.85 may be used to endorse or promote products derived from this software without specific prior written permission
bsd 90 0.85 this software is provided by the copyright holders and contributors as is
bsd 90 0.8 redistribution and use in source and binary forms
bsd-4-clause 90 0.9 all advertising materials mentioning features or use of this software must display the following acknowledgement
bsd 80 1.0 spdx licen[sc]e identifier bsd [1234] clause
0bsd 80 1.0 spdx licen[sc]e identifier 0bsd
bsd 60 0.9 under (?:the )?(?:terms of )?(?:the )?(?:new |modified |simplified |revised )?bsd
bsd 60 0.9 under (?:the )?(?:terms of )?(?:the )?[234] clause bsd
bsd 50 0.9 bsd [234] clause licen[sc]e
bsd 50 0.9 [234] clause bsd licen[sc]e
bsd 40 0.85 (?:new|modified|simplified|revised|original) bsd licen[sc]e
bsd 30 0.8 bsd(?: style)? licen[sc]e
isc 90 0.95 permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted
isc 90 0.8 permission to use copy modify and(?: or)? distribute this software
isc 80 1.0 spdx licen[sc]e identifier isc
isc 60 0.9 under (?:the )?(?:terms of )?(?:the )?isc
isc 30 0.8 isc licen[sc]e
zlib 90 0.95 altered source versions must be plainly marked as such
zlib 90 0.9 the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib 90 0.9 permission is granted to anyone to use this software for any purpose including commercial applications
zlib 80 1.0 spdx licen[sc]e identifier zlib
zlib 60 0.9 under (?:the )?(?:terms of )?(?:the )?zlib
zlib 30 0.8 zlib(?: libpng)? licen[sc]e
libpng 30 0.8 libpng licen[sc]e
mpl 90 0.95 this source code form is subject to the terms of the mozilla public license
mpl 90 0.9 a copy of the mpl was not distributed with this file you can obtain one at(?: https?)? mozilla org mpl 2 0 licen[sc]e
mpl 90 0.9 the contents of this file are subject to the mozilla public license
mpl 80 1.0 spdx licen[sc]e identifier mpl [12] [01]
mpl 70 0.95 under (?:the )?(?:terms of )?(?:the )?mozilla public(?: licen[sc]e)?
mpl 60 0.9 under (?:the )?(?:terms of )?(?:the )?mpl
mpl 50 0.95 mozilla public licen[sc]e (?:v|ver|version) ?[12](?: [01])?
mpl 40 0.9 mozilla public licen[sc]e
epl 90 0.95 accompanying materials are made available under the terms of the eclipse public license
epl 80 1.0 spdx licen[sc]e identifier epl [12] 0
epl 70 0.9 under (?:the )?(?:terms of )?(?:the )?eclipse public(?: licen[sc]e)?
epl 60 0.9 under (?:the )?(?:terms of )?(?:the )?epl
epl 50 0.95 eclipse public licen[sc]e (?:v|ver|version) ?[12](?: 0)?
epl 40 0.9 eclipse public licen[sc]e
edl 40 0.9 eclipse distribution licen[sc]e
cddl 90 0.95 the contents of this file are subject to the terms of the common development and distribution license
cddl 80 1.0 spdx licen[sc]e identifier cddl 1 [01]
cddl 60 0.9 under (?:the )?(?:terms of )?(?:the )?cddl
cddl 40 0.9 common development and distribution licen[sc]e
cpl 80 1.0 spdx licen[sc]e identifier cpl 1 0
cpl 40 0.9 common public licen[sc]e
cpal 40 0.9 common public attribution licen[sc]e
ipl 80 1.0 spdx licen[sc]e identifier ipl 1 0
ipl 40 0.9 ibm public licen[sc]e
spl 40 0.9 sun public licen[sc]e
npl 40 0.9 netscape public licen[sc]e
eupl 80 1.0 spdx licen[sc]e identifier eupl 1 [012]
eupl 70 0.95 licensed under the eupl
eupl 60 0.9 under (?:the )?(?:terms of )?(?:the )?eupl
eupl 40 0.9 european union public licen[sc]e
cecill 80 1.0 spdx licen[sc]e identifier cecill [abc12](?: [01])?
cecill 70 0.95 governed by the cecill(?: [abc])? licen[sc]e
cecill 30 0.85 cecill(?: [abc])? licen[sc]e
artistic 90 0.9 the intent of this document is to state the conditions under which a package may be copied
artistic 80 1.0 spdx licen[sc]e identifier artistic [12] 0
artistic 60 0.9 under (?:the )?(?:terms of )?(?:the )?(?:perl )?artistic
artistic 50 0.95 artistic licen[sc]e (?:v|ver|version)? ?[12](?: 0)?
artistic 30 0.8 artistic licen[sc]e
perl 70 0.9 (?:it|same) under the same terms as perl itself
boost 90 0.95 distributed under the boost software license version 1 0
boost 90 0.9 permission is hereby granted free of charge to any person or organization obtaining a copy
boost 80 1.0 spdx licen[sc]e identifier bsl 1 0
boost 60 0.9 under (?:the )?(?:terms of )?(?:the )?boost software
boost 40 0.9 boost software licen[sc]e
busl 80 1.0 spdx licen[sc]e identifier busl 1 1
busl 60 0.9 under (?:the )?(?:terms of )?(?:the )?business source
busl 40 0.9 business source licen[sc]e
sspl 80 1.0 spdx licen[sc]e identifier sspl 1 0
sspl 60 0.9 under (?:the )?(?:terms of )?(?:the )?server side public
sspl 40 0.9 server side public licen[sc]e
elastic 80 1.0 spdx licen[sc]e identifier elastic 2 0
elastic 60 0.9 under (?:the )?(?:terms of )?(?:the )?elastic licen[sc]e
elastic 30 0.85 elastic licen[sc]e
commons-clause 70 0.9 the license does not grant to you the right to sell the software
commons-clause 40 0.9 commons clause licen[sc]e condition
polyform 40 0.9 polyform (?:noncommercial|shield|strict|small business|internal use) licen[sc]e
cc0 90 0.95 to the extent possible under law the person who associated cc0 with this work
cc0 90 0.9 has waived all copyright and related or neighboring rights
cc0 80 1.0 spdx licen[sc]e identifier cc0 1 0
cc0 60 0.9 under (?:the )?(?:terms of )?(?:the )?(?:creative commons )?cc0
cc0 60 0.9 under (?:the )?(?:terms of )?(?:the )?creative commons zero
cc0 50 0.9 cc0 1 0 universal public domain
cc0 40 0.85 creative commons zero(?: 1 0)? licen[sc]e
cc-by 80 1.0 spdx licen[sc]e identifier cc by [1234] 0
cc-by 70 0.95 under (?:a |the )?(?:terms of )?(?:the )?creative commons attribution
cc-by 60 0.9 under (?:a |the )?(?:terms of )?(?:the )?cc by
cc-by 50 0.9 creative commons attribution [1234] 0(?: international| generic| unported)? licen[sc]e
cc-by 40 0.85 creative commons attribution licen[sc]e
cc-by 20 0.85 creativecommons org licen[sc]es by [1234] 0
cc-by-sa 80 1.0 spdx licen[sc]e identifier cc by sa [1234] 0
cc-by-sa 70 0.95 under (?:a |the )?(?:terms of )?(?:the )?creative commons attribution share ?alike
cc-by-sa 60 0.9 under (?:a |the )?(?:terms of )?(?:the )?cc by sa
cc-by-sa 50 0.9 creative commons attribution share ?alike(?: [1234] 0)?(?: international| generic| unported)? licen[sc]e
cc-by-sa 20 0.85 creativecommons org licen[sc]es by sa [1234] 0
cc-by-nc 80 1.0 spdx licen[sc]e identifier cc by nc(?: sa| nd)? [1234] 0
cc-by-nc 70 0.95 under (?:a |the )?(?:terms of )?(?:the )?creative commons attribution non ?commercial
cc-by-nc 60 0.9 under (?:a |the )?(?:terms of )?(?:the )?cc by nc
cc-by-nc 50 0.9 creative commons attribution non ?commercial(?: share ?alike| no ?derivatives| no ?derivs)?(?: [1234] 0)?(?: international| generic| unported)? licen[sc]e
cc-by-nc 20 0.85 creativecommons org licen[sc]es by nc(?: sa| nd)? [1234] 0
cc-by-nd 70 0.95 under (?:a |the )?(?:terms of )?(?:the )?creative commons attribution no ?deriv(?:ative)?s
cc-by-nd 60 0.9 under (?:a |the )?(?:terms of )?(?:the )?cc by nd
cc-by-nd 20 0.85 creativecommons org licen[sc]es by nd [1234] 0
creative-commons 30 0.6 creative commons licen[sc]e
unlicense 90 0.95 this is free and unencumbered software released into the public domain
unlicense 80 1.0 spdx licen[sc]e identifier unlicense
unlicense 60 0.9 under (?:the )?(?:terms of )?(?:the )?unlicense
unlicense 20 0.9 unlicense org
wtfpl 90 0.95 everyone is permitted to copy and distribute verbatim or modified copies of this license document
wtfpl 80 1.0 spdx licen[sc]e identifier wtfpl
wtfpl 60 0.9 under (?:the )?(?:terms of )?(?:the )?wtfpl
wtfpl 40 0.9 do what the fuck you want to public licen[sc]e
beerware 90 0.9 as long as you retain this notice you can do whatever you want with this stuff
beerware 30 0.85 beer ?ware licen[sc]e
ncsa 80 1.0 spdx licen[sc]e identifier ncsa
ncsa 40 0.9 university of illinois(?: ncsa)? open source licen[sc]e
afl 80 1.0 spdx licen[sc]e identifier afl [123] [01]
afl 40 0.9 academic free licen[sc]e
osl 80 1.0 spdx licen[sc]e identifier osl [123] [01]
osl 40 0.9 open software licen[sc]e
ecl 80 1.0 spdx licen[sc]e identifier ecl [12] 0
ecl 40 0.9 educational community licen[sc]e
ofl 90 0.95 this font software is licensed under the sil open font license
ofl 80 1.0 spdx licen[sc]e identifier ofl 1 [01]
ofl 60 0.9 under (?:the )?(?:terms of )?(?:the )?(?:sil )?open font
ofl 40 0.9 sil open font licen[sc]e
odbl 70 0.95 made available under the open database license
odbl 80 1.0 spdx licen[sc]e identifier odbl 1 0
odbl 60 0.9 under (?:the )?(?:terms of )?(?:the )?odbl
odbl 40 0.9 open database licen[sc]e
odc-by 40 0.9 open data commons attribution licen[sc]e
pddl 40 0.9 open data commons public domain dedication and licen[sc]e
cdla 40 0.9 community data licen[sc]e agreement
ogl 60 0.9 under (?:the )?(?:terms of )?(?:the )?open government
ogl 40 0.9 open government licen[sc]e
psf 80 1.0 spdx licen[sc]e identifier (?:psf|python) 2 0
psf 60 0.9 under (?:the )?(?:terms of )?(?:the )?psf
psf 40 0.9 python software foundation licen[sc]e
php 80 1.0 spdx licen[sc]e identifier php 3 0
php 90 0.9 this source file is subject to version [23] [012]+ of the php license
php 30 0.8 php licen[sc]e
ruby 80 1.0 spdx licen[sc]e identifier ruby
ruby 30 0.8 ruby licen[sc]e
vim 30 0.8 vim licen[sc]e
tcl 30 0.8 tcl(?: tk)? licen[sc]e
json 90 0.9 the software shall be used for good not evil
json 30 0.75 json licen[sc]e
openssl 90 0.9 this product includes software developed by the openssl project for use in the openssl toolkit
openssl 80 1.0 spdx licen[sc]e identifier openssl
openssl 30 0.85 openssl licen[sc]e
postgresql 80 1.0 spdx licen[sc]e identifier postgresql
postgresql 60 0.9 under (?:the )?(?:terms of )?(?:the )?postgresql
postgresql 30 0.85 postgresql licen[sc]e
sleepycat 30 0.85 sleepycat licen[sc]e
qpl 40 0.9 q public licen[sc]e
lppl 90 0.95 this work may be distributed and or modified under the conditions of the latex project public license
lppl 80 1.0 spdx licen[sc]e identifier lppl 1 [0123]c?
lppl 40 0.9 latex project public licen[sc]e
upl 40 0.9 universal permissive licen[sc]e
w3c 30 0.85 w3c software(?: notice and)? licen[sc]e
x11 80 1.0 spdx licen[sc]e identifier x11
x11 30 0.8 x11 licen[sc]e
hpnd 90 0.85 permission to use copy modify and distribute this software and its documentation for any purpose
hpnd 40 0.85 historical permission notice and disclaimer
mspl 80 1.0 spdx licen[sc]e identifier ms [pr]l
mspl 40 0.9 microsoft (?:public|reciprocal) licen[sc]e
zpl 80 1.0 spdx licen[sc]e identifier zpl [12] [01]
zpl 40 0.9 zope public licen[sc]e
ijg 90 0.9 this software is based in part on the work of the independent jpeg group
mulan 60 0.9 licensed under mulan psl
mulan 40 0.9 mulan permissive software licen[sc]e
openrail 40 0.9 (?:creativeml )?open ?rail(?: m)? licen[sc]e
llama 40 0.9 llama(?: [234])?(?: [0123])? community licen[sc]e
gemma 60 0.85 under (?:the )?gemma terms of use
public-domain 90 0.9 dedicated to the public domain
public-domain 70 0.85 (?:released|placed|put) (?:in|into|to) the public domain
public-domain 70 0.85 this work is in the public domain
public-domain 60 0.8 (?:in|into|to) the public domain
public-domain 30 0.6 public domain dedication
proprietary 90 0.9 this software is proprietary and confidential
proprietary 70 0.85 unauthorized copying of this file via any medium is strictly prohibited
proprietary 70 0.8 no part of this publication may be reproduced
proprietary 70 0.8 without the (?:express |prior )?written permission of
proprietary 60 0.7 for internal use only
proprietary 60 0.7 end user licen[sc]e agreement
proprietary 60 0.7 commercial licen[sc]e agreement
proprietary 40 0.5 all rights reserved
no-warranty 40 0.4 provided as is without warranty of any kind
no-warranty 30 0.3 without warranty of any kind
generic 40 0.5 see the licen[sc]e file for
generic 40 0.5 see licen[sc]e (?:file )?in the project root
generic 40 0.5 licensed under the terms of
generic 30 0.4 open source licen[sc]e
generic 30 0.4 free software licen[sc]e
copyright 20 0.3 copyright (?:c )?(?:19|20)[0-9][0-9]
copyright 10 0.3 copyrighted material
mit 55 0.9 mit licen[sc]ed
apache 55 0.9 apache(?: 2 0)? licen[sc]ed
apache 45 0.85 apache 2 0(?: with llvm exception)?
apache 45 0.8 apache2(?: 0)?
apache 45 0.8 apache v2(?: 0)?
bsd 55 0.9 (?:new |modified |simplified |revised )?bsd licen[sc]ed
bsd 45 0.85 bsd [1234] clause
bsd 45 0.85 [234] clause bsd
gpl 55 0.9 gpl(?: ?v?[123])?(?: 0)? licen[sc]ed
gpl 45 0.85 gpl [123](?: 0)?(?: only| or later| or any later version)?
gpl 45 0.85 gpl v[123](?: 0)?(?: only| or later| or any later version)?
gpl 45 0.85 gplv[123](?: 0)?(?: only| or later| or any later version)?
lgpl 55 0.9 lgpl(?: ?v?[23])?(?: [01])? licen[sc]ed
lgpl 45 0.85 lgpl [23](?: [01])?(?: only| or later| or any later version)?
lgpl 45 0.85 lgpl v[23](?: [01])?(?: only| or later| or any later version)?
lgpl 45 0.85 lgplv[23](?: [01])?(?: only| or later| or any later version)?
agpl 55 0.9 agpl(?: ?v?3)?(?: 0)? licen[sc]ed
agpl 45 0.85 agpl 3(?: 0)?(?: only| or later)?
agpl 45 0.85 agpl v3(?: 0)?(?: only| or later)?
agpl 45 0.85 agplv3(?: only| or later)?
mpl 55 0.9 mpl(?: 2 0)? licen[sc]ed
mpl 45 0.85 mpl [12] [01]
mpl 45 0.8 mplv2(?: 0)?
epl 45 0.85 epl [12] 0
cddl 45 0.85 cddl 1 [01]
eupl 45 0.85 eupl 1 [012]
isc 55 0.9 isc licen[sc]ed
zlib 55 0.9 zlib licen[sc]ed
boost 45 0.85 bsl 1 0
unlicense 45 0.8 the unlicense
cc0 45 0.85 cc0 1 0
cc-by 45 0.85 cc by [1234] 0
cc-by-sa 45 0.85 cc by sa [1234] 0
cc-by-nc 45 0.85 cc by nc(?: sa| nd)? [1234] 0
cc-by-nd 45 0.85 cc by nd [1234] 0
"""


def literals(expression: str) -> list[str]:
    """Runs of text that every match of an expression holds: what is left outside groups, classes and optional signs."""
    plain = expression
    while "(" in plain:
        plain = re.sub(r"\([^()]*\)[?*+]?", "\0", plain)
    if "|" in plain:
        raise ValueError(f"alternatives outside a group: {expression}")
    plain = re.sub(r"(?:\[[^]]*\]|.)(?:[?*]|\{[^}]*\})", "\0", plain)
    plain = re.sub(r"\[[^]]*\]\+?|.\+", "\0", plain)
    return [x for x in plain.split("\0") if x]


def rules() -> list[dict]:
    """All rules by falling priority; ``keyword`` is the longest text that every match of the rule holds."""
    out = []
    for line in SIGNATURES.strip().splitlines():
        label, priority, confidence, expression = line.split(" ", 3)
        pattern = f" {expression}(?= )"
        keyword = max(literals(f" {expression}"), key=len)
        out.append({"keyword": keyword, "priority": int(priority), "confidence": float(confidence), "label": label, "pattern": pattern})
    return sorted(out, key=lambda r: (-r["priority"], r["label"], r["pattern"]))
