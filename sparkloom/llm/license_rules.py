"""The signature rules of the license scan, written by hand, as lines of ``label :: keyword :: pattern``.

Patterns are regular expressions over lower-case words joined by single spaces. The keyword is in every string that the
pattern matches."""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    keyword: str
    pattern: str
    priority: int
    weight: float


#: The base phrases, whose labels are never suppressed.
BASE = [
    Rule("mit", "under the mit license", "under the mit license", 9, 0.95),
    Rule("apache-2", "apache license version 2", "apache license version 2", 9, 0.95),
    Rule("cc-by-nc", "cc by nc", "cc by nc", 9, 0.9),
]

#: Short strings of which every match of a rule has one; texts with none of them are not looked at any further.
STEMS = [
    "licen", "spdx", "permi", "public domain", "all rights", "cc by", "cc0", "creative commons", "gpl", "bsd", "apache", "mulan", "redistribut", "warrant", "copyright", "prohibited", "liable", "endorse",
    "asl 2 0", "do what the", "mit no", "by the openssl", "any later version", "advertising materials", "misrepresented",
]

#: Names of licenses.
NAMES = r"""
mit :: mit licen :: (?:the )?(?:x11 )?mit licen[cs]e
mit :: mit x11 :: mit x11 licen[cs]e
mit :: expat licen :: expat licen[cs]e
mit-0 :: no attribution :: mit no attribution(?: licen[cs]e)?
apache-1 :: apache :: apache (?:software )?licen[cs]e (?:version |v )?1(?: [01])?
apache-2 :: apache :: (?:apache (?:software )?licen[cs]e(?: version| v)? ?2(?: 0)?|apache 2(?: 0)?(?: licen[cs]e)?)
apache-2 :: asl 2 0 :: asl 2 0
bsd :: bsd :: (?:new |revised |original |simplified )?bsd(?: style)? licen[cs]e
bsd-2 :: bsd :: (?:2 clause bsd|bsd 2 clause|simplified bsd|freebsd)(?: licen[cs]e)?
bsd-3 :: bsd :: (?:3 clause bsd|bsd 3 clause|new bsd|modified bsd|revised bsd)(?: licen[cs]e)?
bsd-4 :: bsd :: (?:4 clause bsd|bsd 4 clause|original bsd)(?: licen[cs]e)?
0bsd :: bsd :: (?:zero clause bsd|bsd zero clause|0bsd)(?: licen[cs]e)?
isc :: isc licen :: isc licen[cs]e
gpl :: general public :: (?:gnu )?general public licen[cs]e
gpl-1 :: general public :: (?:gnu )?general public licen[cs]e(?: as published)?(?: version| v)? ?1(?: 0)?
gpl-2 :: general public :: (?:gnu )?general public licen[cs]e(?: as published)?(?: version| v)? ?2(?: 0)?
gpl-3 :: general public :: (?:gnu )?general public licen[cs]e(?: as published)?(?: version| v)? ?3(?: 0)?
gpl-2 :: gpl :: (?:gnu )?gpl ?(?:version |v )?v?2(?: 0)?
gpl-3 :: gpl :: (?:gnu )?gpl ?(?:version |v )?v?3(?: 0)?
gpl :: gnu gpl :: gnu gpl
lgpl :: lesser general :: (?:gnu )?lesser general public licen[cs]e
lgpl :: gnu lgpl :: gnu lgpl
lgpl-2 :: library general :: (?:gnu )?library general public licen[cs]e(?: version| v)? ?2(?: 0)?
lgpl-2.1 :: lesser general :: (?:gnu )?lesser general public licen[cs]e(?: version| v)? ?2 1
lgpl-3 :: lesser general :: (?:gnu )?lesser general public licen[cs]e(?: version| v)? ?3(?: 0)?
lgpl-2.1 :: lgpl :: (?:gnu )?lgpl ?(?:version |v )?v?2 1
lgpl-3 :: lgpl :: (?:gnu )?lgpl ?(?:version |v )?v?3(?: 0)?
agpl :: affero :: (?:gnu )?affero general public licen[cs]e
agpl-3 :: affero :: (?:gnu )?affero general public licen[cs]e(?: version| v)? ?3(?: 0)?
agpl-3 :: agpl :: (?:gnu )?agpl ?(?:version |v )?v?3(?: 0)?
fdl :: documentation :: (?:gnu )?free documentation licen[cs]e
fdl-1.3 :: documentation :: (?:gnu )?free documentation licen[cs]e(?: version| v)? ?1 [123]
mpl :: mozilla :: mozilla public licen[cs]e
mpl-1.1 :: mozilla :: mozilla public licen[cs]e(?: version| v)? ?1 [01]
mpl-2 :: mozilla :: mozilla public licen[cs]e(?: version| v)? ?2(?: 0)?
epl-1 :: eclipse :: eclipse public licen[cs]e(?: version| v)? ?1(?: 0)?
epl-2 :: eclipse :: eclipse public licen[cs]e(?: version| v)? ?2(?: 0)?
edl-1 :: eclipse :: eclipse distribution licen[cs]e(?: version| v)?(?: 1 0)?
cddl :: common development :: common development and distribution licen[cs]e(?: version)?(?: 1 [01])?
cpl :: common public :: common public licen[cs]e(?: version)?(?: 1 0)?
ipl :: ibm public :: ibm public licen[cs]e(?: version)?(?: 1 0)?
eupl :: european union :: european union public licen[cs]e(?: version| v)?(?: 1 [12])?
cecill :: cecill :: cecill(?: free software)? licen[cs]e(?: agreement)?(?: version)?(?: 2 [01])?
artistic-1 :: artistic :: artistic licen[cs]e(?: version)? 1 0
artistic-2 :: artistic :: artistic licen[cs]e(?: version)? 2 0
bsl-1 :: boost software :: boost software licen[cs]e(?: version)?(?: 1 0)?
busl :: business source :: business source licen[cs]e(?: version)?(?: 1 1)?
sspl :: server side :: server side public licen[cs]e(?: version)?(?: 1)?
elastic-2 :: elastic :: elastic licen[cs]e(?: version)? 2(?: 0)?
polyform :: polyform :: polyform (?:noncommercial|small business|shield|strict) licen[cs]e(?: 1 0 0)?
commons-clause :: commons clause :: commons clause licen[cs]e condition(?: v1 0)?
zlib :: zlib :: zlib(?: libpng)? licen[cs]e
libpng :: libpng :: libpng licen[cs]e(?: version)?(?: 2(?: 0)?)?
openssl :: openssl :: openssl licen[cs]e
curl :: curl :: curl licen[cs]e
python :: python :: python (?:software foundation )?licen[cs]e(?: version)?(?: 2)?
php :: php :: php licen[cs]e(?: version)?(?: 3 0(?: 1)?)?
ruby :: ruby :: ruby licen[cs]e
postgresql :: postgresql :: postgresql licen[cs]e
unlicense :: unlicen :: the unlicen[cs]e
wtfpl :: what the :: do what the \S+ you want to public licen[cs]e
beerware :: beerware :: beerware licen[cs]e
ofl :: open font :: (?:sil )?open font licen[cs]e(?: version)?(?: 1 [01])?
w3c :: w3c :: w3c (?:software )?(?:notice and )?licen[cs]e
ms-pl :: microsoft :: microsoft public licen[cs]e
ms-rl :: microsoft :: microsoft reciprocal licen[cs]e
ncsa :: illinois :: university of illinois(?: ncsa)? open source licen[cs]e
afl-3 :: academic free :: academic free licen[cs]e(?: version| v)?(?: 3 0)?
osl-3 :: open software :: open software licen[cs]e(?: version| v)?(?: 3 0)?
rpl :: reciprocal public :: reciprocal public licen[cs]e(?: version)?(?: 1 [15])?
qpl :: q public :: q public licen[cs]e(?: version)?(?: 1 0)?
vim :: vim licen :: vim licen[cs]e
x11 :: x11 licen :: x11 licen[cs]e
ecl-2 :: educational community :: educational community licen[cs]e(?: version)?(?: 2 0)?
upl :: universal permissive :: universal permissive licen[cs]e(?: version| v)?(?: 1 0)?
blueoak :: blue oak :: blue oak model licen[cs]e(?: 1 0 0)?
mulan-2 :: mulan :: mulan psl(?: v2| 2)?
openrail :: responsible ai :: (?:bigscience )?(?:open )?(?:rail )?responsible ai licen[cs]e
llama :: llama :: llama (?:2 |3 )?community licen[cs]e(?: agreement)?
odbl :: database :: open (?:data commons )?(?:open )?database licen[cs]e(?: version| v)?(?: 1 0)?
odc-by :: data commons :: open data commons attribution licen[cs]e(?: version| v)?(?: 1 0)?
pddl :: public domain dedication :: public domain dedication and licen[cs]e(?: version| v)?(?: 1 0)?
cdla :: community data :: community data licen[cs]e agreement(?: (?:permissive|sharing))?(?: version)?(?: [12] 0)?
ogl-uk :: open government :: open government licen[cs]e(?: version| v)?(?: [123] 0)?
etalab-2 :: licence ouverte :: licence ouverte(?: version)?(?: 2 0)?
cc0 :: cc0 :: (?:creative commons )?cc0(?: 1 0)?(?: universal)?
cc0 :: creative commons :: creative commons zero(?: v?1 0)?(?: universal)?
cc-by :: cc by :: (?:creative commons )?cc by(?: [1234] 0)?
cc-by-sa :: cc by :: (?:creative commons )?cc by sa(?: [1234] 0)?
cc-by-nc :: cc by :: (?:creative commons )?cc by nc(?: [1234] 0)?
cc-by-nd :: cc by :: (?:creative commons )?cc by nd(?: [1234] 0)?
cc-by-nc-sa :: cc by :: (?:creative commons )?cc by nc sa(?: [1234] 0)?
cc-by-nc-nd :: cc by :: (?:creative commons )?cc by nc nd(?: [1234] 0)?
cc-by :: creative commons :: creative commons attribution(?: [1234] 0)?(?: (?:international|unported|generic))?
cc-by-sa :: creative commons attribution :: creative commons attribution share ?alike(?: [1234] 0)?(?: (?:international|unported|generic))?
cc-by-nd :: creative commons attribution :: creative commons attribution no ?deriv(?:ative)?s(?: [1234] 0)?(?: (?:international|unported|generic))?
cc-by-nc :: creative commons attribution :: creative commons attribution non ?commercial(?: [1234] 0)?(?: (?:international|unported|generic))?
cc-by-nc-sa :: creative commons attribution :: creative commons attribution non ?commercial share ?alike(?: [1234] 0)?(?: (?:international|unported|generic))?
cc-by-nc-nd :: creative commons attribution :: creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1234] 0)?(?: (?:international|unported|generic))?
public-domain :: public domain :: (?:dedicated to|placed in|in|into) the public domain
proprietary :: all rights :: all rights reserved
"""

#: Sentences that put a work under a license.
GRANTS = r"""
mit :: mit licen :: (?:licen[cs]ed|released|distributed|available|published|provided) under (?:the )?(?:terms of the )?mit licen[cs]e
mit :: mit licen :: (?:this|the) (?:project|software|package|code|library|repository|work) is mit licen[cs]ed
apache-2 :: apache licen :: (?:licen[cs]ed|released|distributed|available|published|provided) under (?:the )?(?:terms of the )?apache licen[cs]e(?: version| v)? 2(?: 0)?
apache-2 :: apache 2 0 licen :: (?:licen[cs]ed|released|distributed|available) under (?:the |an )?apache 2 0 licen[cs]e
bsd :: bsd :: (?:licen[cs]ed|released|distributed|available) under (?:the |a )?(?:terms of the )?bsd(?: style| like)? licen[cs]e
bsd-2 :: bsd 2 clause :: (?:licen[cs]ed|released|distributed|available) under (?:the )?bsd 2 clause(?: licen[cs]e)?
bsd-3 :: bsd 3 clause :: (?:licen[cs]ed|released|distributed|available) under (?:the )?bsd 3 clause(?: licen[cs]e)?
bsd-3 :: 3 clause bsd :: (?:licen[cs]ed|released|distributed|available) under (?:the )?3 clause bsd licen[cs]e
isc :: isc licen :: (?:licen[cs]ed|released|distributed|available) under (?:the )?(?:terms of the )?isc licen[cs]e
gpl :: general public :: (?:licen[cs]ed|released|distributed|available|published) under (?:the )?(?:terms of the )?(?:gnu )?general public licen[cs]e
gpl-2 :: general public :: (?:licen[cs]ed|released|distributed|available) under (?:the )?(?:terms of the )?(?:gnu )?general public licen[cs]e(?: version| v)? 2(?: 0)?
gpl-3 :: general public :: (?:licen[cs]ed|released|distributed|available) under (?:the )?(?:terms of the )?(?:gnu )?general public licen[cs]e(?: version| v)? 3(?: 0)?
gpl :: under the gpl :: (?:licen[cs]ed|released|distributed|available) under the gpl
gpl-2 :: under the gplv2 :: (?:licen[cs]ed|released|distributed|available) under the gplv2
gpl-3 :: under the gplv3 :: (?:licen[cs]ed|released|distributed|available) under the gplv3
lgpl :: lesser general :: (?:licen[cs]ed|released|distributed|available) under (?:the )?(?:terms of the )?(?:gnu )?lesser general public licen[cs]e
lgpl :: under the lgpl :: (?:licen[cs]ed|released|distributed|available) under the lgpl
agpl-3 :: affero :: (?:licen[cs]ed|released|distributed|available) under (?:the )?(?:terms of the )?(?:gnu )?affero general public licen[cs]e(?: version| v)? 3(?: 0)?
fdl :: documentation :: (?:licen[cs]ed|released|available|published) under (?:the )?(?:terms of the )?gnu free documentation licen[cs]e
mpl-2 :: mozilla :: (?:licen[cs]ed|released|distributed|available) under (?:the )?(?:terms of the )?mozilla public licen[cs]e(?: version| v)? 2(?: 0)?
epl-2 :: eclipse :: (?:licen[cs]ed|released|distributed|available) under (?:the )?(?:terms of the )?eclipse public licen[cs]e(?: version| v)? 2(?: 0)?
bsl-1 :: boost software :: (?:licen[cs]ed|released|distributed|available) under (?:the )?boost software licen[cs]e(?: version)?(?: 1 0)?
busl :: business source :: (?:licen[cs]ed|released|distributed|available) under (?:the )?business source licen[cs]e
zlib :: zlib licen :: (?:licen[cs]ed|released|distributed|available) under (?:the )?zlib licen[cs]e
unlicense :: under the unlicen :: (?:licen[cs]ed|released|distributed|available) under the unlicen[cs]e
ofl :: open font :: (?:licen[cs]ed|released|distributed|available) under (?:the )?sil open font licen[cs]e(?: version)?(?: 1 1)?
cc0 :: cc0 :: (?:licen[cs]ed|released|distributed|available|published) under (?:a |the )?(?:creative commons )?cc0(?: 1 0)?
cc-by :: cc by :: (?:licen[cs]ed|released|distributed|available|published|shared) under (?:a |the )?cc by(?: [1234] 0)?
cc-by-sa :: cc by sa :: (?:licen[cs]ed|released|distributed|available|published|shared) under (?:a |the )?cc by sa(?: [1234] 0)?
cc-by-nc :: cc by nc :: (?:licen[cs]ed|released|distributed|available|published|shared) under (?:a |the )?cc by nc(?: [1234] 0)?
cc-by-nd :: cc by nd :: (?:licen[cs]ed|released|distributed|available|published|shared) under (?:a |the )?cc by nd(?: [1234] 0)?
cc-by-nc-sa :: cc by nc sa :: (?:licen[cs]ed|released|distributed|available|published|shared) under (?:a |the )?cc by nc sa(?: [1234] 0)?
cc-by-nc-nd :: cc by nc nd :: (?:licen[cs]ed|released|distributed|available|published|shared) under (?:a |the )?cc by nc nd(?: [1234] 0)?
cc-by :: creative commons attribution :: (?:licen[cs]ed|released|available|published) under (?:a |the )?creative commons attribution(?: [1234] 0)?(?: (?:international|unported|generic))? licen[cs]e
cc-by-sa :: creative commons attribution :: text is available under the creative commons attribution share ?alike licen[cs]e
odbl :: open database :: (?:made available|licen[cs]ed|released) under the (?:terms of the )?open database licen[cs]e
public-domain :: public domain :: (?:released|dedicated|donated) (?:in)?to the public domain
public-domain :: public domain :: (?:this|the) (?:file|work|software|code|document) is in the public domain
"""

#: Words of license texts and of the notices that licenses ask for.
TEXTS = r"""
mit :: hereby granted free of charge :: permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit :: included in all copies :: (?:the above copyright notice and )?this permission notice shall be included in all copies or substantial portions of the software
mit :: without restriction including :: to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicen[cs]e and or sell
bsl-1 :: hereby granted free of charge :: permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
bsl-1 :: machine executable object code :: unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor and this licen[cs]e
isc :: with or without fee :: permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc :: permission notice appear in all copies :: provided that the above copyright notice and this permission notice appear in all copies
x11 :: used in advertising :: shall not be used in advertising or otherwise to promote the sale use or other dealings in this software without prior written authori[sz]ation from the copyright holder
postgresql :: without a written agreement :: permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
bsd :: redistribution and use in source :: redistribution and use in source and binary forms(?: with or without modification)?(?: are permitted)?
bsd :: redistributions of source code :: redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd :: redistributions in binary form :: redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd-3 :: neither the name of :: neither the name of (?:\S+ ){1,12}nor the names of (?:its|their|any) contributors may be used to endorse or promote products
bsd-3 :: may not be used to endorse :: the name of the author may not be used to endorse or promote products derived from this software
bsd-4 :: all advertising materials :: all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment
bsd-clear :: no express or implied licen :: no express or implied licen[cs]es to any party s patent rights are granted by this licen[cs]e
apache-2 :: except in compliance with the license :: you may not use this (?:file|work|software) except in compliance with the license
apache-2 :: distributed on an as is basis :: software distributed under the licen[cs]e is distributed on an as is basis without warranties or conditions of any kind
apache-2 :: language governing permissions :: see the licen[cs]e for the specific language governing permissions and limitations under the licen[cs]e
apache-2 :: licensed to the apache software foundation :: licensed to the apache software foundation asf under one or more contributor licen[cs]e agreements
apache-1 :: developed by the apache :: this product includes software developed by the apache (?:group|software foundation)(?: for use in)?(?: \S+){0,3} licen[cs]e
gpl :: this program is free software :: this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e
gpl :: hope that it will be useful :: distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public licen[cs]e
gpl :: received a copy of the gnu general :: you should have received a copy of the gnu general public licen[cs]e along with this (?:program|software|file)
gpl :: copyleft licen :: the gnu general public licen[cs]e is a free copyleft licen[cs]e for software
gpl-2 :: this general public license applies :: this general public license applies to most of the free software foundation s software
gpl-3 :: your rights with two steps :: developers that use the gnu gpl protect your rights with two steps
agpl :: this program is free software :: this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e
agpl :: remotely through a computer network :: must prominently offer all users interacting with it remotely through a computer network an opportunity to receive the corresponding source(?: of your version)? permi(?:ssion|tted)
lgpl :: this library is free software :: this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e
lgpl :: received a copy of the gnu lesser :: you should have received a copy of the gnu lesser general public licen[cs]e along with this (?:library|program)
fdl :: to copy distribute and or modify this document :: permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e
fdl :: no invariant sections :: with no invariant sections no front cover texts and no back cover texts a copy of the licen[cs]e is included
mpl-2 :: this source code form is subject :: this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0
mpl-2 :: copy of the mpl was not distributed :: if a copy of the mpl was not distributed with this file you can obtain one at (?:\S+ ){1,6}licen[cs]e
mpl-1.1 :: subject to the mozilla public :: the contents of this file are subject to the mozilla public licen[cs]e version 1 1
cddl :: the contents of this file are subject :: the contents of this file are subject to the terms of the common development and distribution licen[cs]e
epl-1 :: accompanying materials are made available :: this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e v1 0
epl-2 :: accompanying materials are made available :: this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e (?:v )?2 0
eupl :: soon as they will be approved :: as soon as they will be approved by the european commission subsequent versions of the eupl the licen[cs]e
zlib :: in no event will the authors be held liable :: in no event will the authors be held liable for any damages arising from the use of this software
zlib :: origin of this software must :: the origin of this software must not be misrepresented you must not claim that you wrote the original software
unlicense :: free and unencumbered software :: this is free and unencumbered software released into the public domain
unlicense :: is free to copy modify publish :: anyone is free to copy modify publish use compile sell or distribute this software(?: \S+){1,24} warranty
wtfpl :: you just do what the :: you just do what the \S+ you want to
cc0 :: dedicated the work to the public domain :: the person who associated a work with this deed has dedicated the work to the public domain
cc0 :: waived all copyright :: (?:to the extent possible under law )?(?:\S+ ){1,8}has waived all copyright and related or neighboring rights to this work
cc-by :: you must give appropriate credit :: you must give appropriate credit provide a link to the licen[cs]e and indicate if changes were made
cc-by-sa :: contributions under the same licen :: if you remix transform or build upon the material you must distribute your contributions under the same licen[cs]e as the original
cc-by-nc :: material for commercial purposes :: you may not use the material for commercial purposes(?: under this licen[cs]e)?(?: \S+){0,4} permi(?:ssion|tted)
cc-by-nd :: distribute the modified material :: if you remix transform or build upon the material you may not distribute the modified material(?: \S+){0,8} licen[cs]e
cc :: work is licensed under a creative commons :: this work is licensed under a creative commons licen[cs]e
ofl :: this font software is licensed :: this font software is licensed under the sil open font licen[cs]e
ofl :: reserved font name :: no modified version of the font software may use the reserved font name s unless explicit written permission is granted
openssl :: developed by the openssl project :: this product includes software developed by the openssl project
upl :: subject to the condition set forth below :: subject to the condition set forth below permission is hereby granted to any person obtaining a copy
python :: psf hereby grants :: psf hereby grants licensee a nonexclusive royalty free world wide licen[cs]e
ms-pl :: contributor grants you :: each contributor grants you a non exclusive worldwide royalty free copyright licen[cs]e to reproduce its contribution
artistic-2 :: standard version :: you are permitted to use the standard version and create and use modified versions for any purpose without restriction
ncsa :: developed by the names of development group :: neither the names of the developed by the names of development group nor the names of its contributors may be used to endorse or promote products
ogl-uk :: contains public sector information :: contains public sector information licensed under the open government licen[cs]e
odbl :: free to share create and adapt :: you are free to share create and adapt this database as long as you attribute any public use(?: \S+){0,12} licen[cs]e
commons-clause :: right to sell the software :: the grant of rights under the licen[cs]e will not include and the licen[cs]e does not grant to you the right to sell the software
sspl :: functionality of the program :: if you make the functionality of the program or a modified version available to third parties as a service(?: \S+){1,20} licen[cs]e
proprietary :: strictly prohibited :: unauthori[sz]ed (?:copying|use|reproduction|distribution) of this (?:file|software|work|document)(?: via any medium)? is strictly prohibited
proprietary :: proprietary and confidential :: (?:this (?:file|software|document) is )?proprietary and confidential(?: and)? (?:may not be|not to be|must not be) (?:copied|disclosed|redistributed)(?: \S+){0,6} permission
proprietary :: prior written permission :: no part of this (?:publication|document|work|book) may be reproduced(?: \S+){1,24} without (?:the )?prior written permission
proprietary :: end user license agreement :: (?:by (?:installing|using) (?:this|the) software you (?:agree|accept) (?:to )?)?(?:be bound by )?(?:the |this )?end user license agreement
"""

#: Disclaimers and conditions that go with many licenses, and exceptions that go with one.
CLAUSES = r"""
as-is :: provided as is without warranty :: (?:the|this) (?:software|program|work|library|material) is provided as is without warranty of any kind(?: express or implied)?
as-is :: express or implied warranties :: any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed
as-is :: no event shall the :: in no event shall the (?:authors or copyright holders|copyright (?:owner|holder|holders)(?: or contributors)?|regents or contributors) be (?:held )?liable for any
as-is :: there is no warranty :: there is no warranty for the (?:program|library|software|work) to the extent permitted by applicable law
as-is :: warranties or conditions of any kind :: without warranties or conditions of any kind either express or implied
or-later :: any later version :: (?:either version (?:[123](?: 1)?) of the licen[cs]e or )?at your option any later version(?: of the licen[cs]e)?
or-later :: version of the licen :: (?:version [123](?: [01])? )or (?:any )?later version of the licen[cs]e
gpl-2-or-later :: gpl 2 0 or later :: gpl 2 0 or later
gpl-3-or-later :: gpl 3 0 or later :: gpl 3 0 or later
lgpl-2.1-or-later :: lgpl 2 1 or later :: lgpl 2 1 or later
lgpl-3-or-later :: lgpl 3 0 or later :: lgpl 3 0 or later
agpl-3-or-later :: agpl 3 0 or later :: agpl 3 0 or later
gpl-2-or-later :: general public :: (?:gnu )?general public licen[cs]e(?: version| v)? ?2(?: 0)? or (?:at your option )?(?:any )?later(?: version)?
gpl-3-or-later :: general public :: (?:gnu )?general public licen[cs]e(?: version| v)? ?3(?: 0)? or (?:at your option )?(?:any )?later(?: version)?
gpl-2-only :: gpl 2 0 only :: gpl 2 0 only
gpl-3-only :: gpl 3 0 only :: gpl 3 0 only
lgpl-2.1-only :: lgpl 2 1 only :: lgpl 2 1 only
agpl-3-only :: agpl 3 0 only :: agpl 3 0 only
gpl-2-only :: general public :: version 2(?: only)? of the (?:gnu )?general public licen[cs]e only
classpath-exception :: classpath exception :: (?:gpl(?: v?2)?(?: 2 0)?|general public licen[cs]e(?: version)?(?: 2)?) (?:only )?with (?:the )?classpath exception(?: 2 0)?
classpath-exception :: linking this library statically :: linking this library statically or dynamically with other modules is making a combined work based on this library(?: \S+){1,16} licen[cs]e
gcc-exception :: gcc runtime library exception :: (?:under )?(?:the )?gcc runtime library exception(?: version 3 1)?(?: \S+){0,6} licen[cs]e
llvm-exception :: llvm exception :: apache (?:licen[cs]e )?(?:version |v )?2 0 with llvm exceptions?
font-exception :: font exception :: gpl(?: \S+){0,3} with (?:the )?font exception
linking-exception :: openssl library :: permission to link the code of (?:\S+ ){1,8}with the openssl library
linking-exception :: linking exception :: (?:gpl|lgpl|general public licen[cs]e)(?: \S+){0,4} with (?:a |the )?(?:static )?linking exception
autoconf-exception :: autoconf exception :: gpl(?: \S+){0,3} with (?:the )?autoconf exception
syscall-exception :: linux syscall note :: gpl 2 0(?: only| or later)? with linux syscall note
dual :: dual licen :: dual licen[cs]ed under
dual :: mit and apache :: dual licen[cs]ed under (?:the )?mit and apache(?: licen[cs]e)?(?: version)?(?: 2 0)?
dual :: at your option :: licen[cs]ed under either of (?:\S+ ){1,24}at your option
no-derivatives :: derivative works are not permitted :: derivative works are not permitted
no-commercial :: for non commercial use only :: (?:licen[cs]ed |permission (?:is )?granted |permitted )for non commercial use only
no-commercial :: commercial use :: commercial use (?:of this (?:\S+ ){1,3})?is (?:strictly )?(?:prohibited|not permitted)
academic-only :: academic use only :: (?:licen[cs]ed|permitted|permission is granted) for academic use only
no-training :: machine learning :: (?:may|must) not be used (?:for|to) (?:training |train )(?:of )?machine learning (?:models|systems) without permission
no-redistribution :: redistribution :: redistribution (?:is )?(?:strictly )?(?:prohibited|not permitted|forbidden)(?: without permission)?
permission-needed :: reproduced with permission :: reproduced with permission (?:of|from) the (?:author|publisher|copyright (?:holder|owner))s?
"""

#: Sentences that deny a license; they suppress the names and grants inside them, but no base phrase.
DENIALS = r"""
not-mit :: under the mit licen :: (?:is |are )?not (?:licen[cs]ed |released |available )?under the mit licen[cs]e
not-gpl :: under the gpl :: (?:is |are )?not (?:licen[cs]ed |released |available )?under the gpl
not-apache :: under the apache licen :: (?:is |are )?not (?:licen[cs]ed |released |available )?under the apache licen[cs]e
not-public-domain :: in the public domain :: (?:is |are )not in the public domain
not-open :: not open source :: (?:is |are )not open source(?: \S+){0,4} licen[cs]e
no-license :: no licen :: no licen[cs]e (?:is |has been )?(?:granted|specified|provided|given)(?: for this (?:work|software|repository|project))?
"""

#: Identifiers in machine-readable notices: label and words, as in "spdx license identifier mit".
IDENTIFIERS = r"""
mit :: mit
mit-0 :: mit 0
apache-1 :: apache 1 [01]
apache-2 :: apache 2 0
bsd-2 :: bsd 2 clause
bsd-3 :: bsd 3 clause
bsd-4 :: bsd 4 clause
0bsd :: 0bsd
isc :: isc
gpl-2 :: gpl 2 0(?: only)?
gpl-2-or-later :: gpl 2 0 or later
gpl-3 :: gpl 3 0(?: only)?
gpl-3-or-later :: gpl 3 0 or later
lgpl-2 :: lgpl 2 0(?: only| or later)?
lgpl-2.1 :: lgpl 2 1(?: only)?
lgpl-2.1-or-later :: lgpl 2 1 or later
lgpl-3 :: lgpl 3 0(?: only)?
lgpl-3-or-later :: lgpl 3 0 or later
agpl-3 :: agpl 3 0(?: only)?
agpl-3-or-later :: agpl 3 0 or later
mpl-1.1 :: mpl 1 [01]
mpl-2 :: mpl 2 0
epl-1 :: epl 1 0
epl-2 :: epl 2 0
cddl :: cddl 1 [01]
eupl :: eupl 1 [12]
artistic-2 :: artistic 2 0
bsl-1 :: bsl 1 0
busl :: busl 1 1
zlib :: zlib
unlicense :: unlicense
ofl :: ofl 1 [01]
cc0 :: cc0 1 0
cc-by :: cc by [1234] 0
cc-by-sa :: cc by sa [1234] 0
cc-by-nc :: cc by nc [1234] 0
cc-by-nc-sa :: cc by nc sa [1234] 0
proprietary :: licenseref proprietary
"""


def _lines(table: str) -> list[list[str]]:
    return [line.split(" :: ") for line in table.strip().split("\n")]


#: In order, weakest table first; the rule's number breaks ties of priority and length.
RULES = [
    *[Rule(*line, 1, 0.6) for line in _lines(NAMES)],
    *[Rule(*line, 2, 0.85) for line in _lines(CLAUSES)],
    *[Rule(*line, 3, 0.95) for line in _lines(GRANTS)],
    *[Rule(*line, 3, 0.95) for line in _lines(TEXTS)],
    *[Rule(label, "spdx", f"spdx licen[cs]e identifier {words}", 4, 1.0) for label, words in _lines(IDENTIFIERS)],
    *[Rule(*line, 5, 0.9) for line in _lines(DENIALS)],
]
