"""Hand-written licence signatures, in order: label, priority, keyword, expression.

The expressions work on the words of a text, in lower case and joined by one space
("apache license version 2 0"); they match whole words. A rule is tried only on texts that
contain its keyword, one of the words of every match; only the sentence that the header of the Apache licence shares
with that of the MPL 1.1 needs its keyword elsewhere. Priority 3: a grant or the text of a licence; 2: a licence
named with its version or by its identifier; 1: a bare name or a hint.
"""

_RULES = r"""
apache-2.0 | 3 | apache | licensed under (?:the )?apache (?:software )?licen[cs]e,? (?:version )?v?2(?: 0)?
apache-2.0 | 3 | apache | may not use this file except in compliance with the (?:apache )?licen[cs]e
apache-2.0 | 3 | grants | each contributor hereby grants to you a perpetual worldwide
apache-2.0 | 2 | apache | apache (?:software )?licen[cs]e (?:version |v )?v?2(?: 0)?
apache-2.0 | 2 | apache | spdx license identifier apache 2 0
apache-2.0 | 2 | apache | apache 2 0
apache-2.0 | 2 | apache | apache org licenses license 2 0(?: txt| html)?
apache-1.1 | 2 | apache | apache (?:software )?licen[cs]e (?:version |v )?1 1
apache-1.0 | 2 | apache | apache (?:software )?licen[cs]e (?:version |v )?1 0
apache | 1 | apache | apache (?:software )?licen[cs]e
apache | 1 | apache | apache software foundation
mit | 3 | permission | permission is hereby granted free of charge to any person obtaining a copy
mit | 3 | mit | (?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?mit licen[cs]e
mit | 2 | mit | spdx license identifier mit
mit | 2 | mit | opensource org licenses mit
mit | 2 | expat | expat licen[cs]e
mit | 1 | mit | (?:the )?mit licen[cs]ed?
mit-0 | 2 | mit | mit (?:no attribution|0) licen[cs]e
mit-style | 2 | mit | mit (?:style|like) licen[cs]e
as-is | 1 | warranty | provided as is without warranty of any kind
x11 | 2 | x11 | x11 licen[cs]e
x11 | 2 | consortium | x consortium licen[cs]e
bsd | 3 | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd-4-clause | 3 | advertising | all advertising materials mentioning features or use of this software must display
bsd-3-clause | 3 | endorse | neither the name of (?:[^ ]+ ){1,60}?may be used to endorse or promote products
bsd-3-clause | 2 | bsd | spdx license identifier bsd 3 clause
bsd-3-clause | 2 | bsd | (?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: licen[cs]e)?
bsd-2-clause | 2 | bsd | spdx license identifier bsd 2 clause
bsd-2-clause | 2 | bsd | (?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd)(?: licen[cs]e)?
bsd-2-clause | 2 | freebsd | freebsd(?: licen[cs]e)?
bsd-4-clause | 2 | bsd | (?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)(?: licen[cs]e)?
0bsd | 2 | 0bsd | (?:spdx license identifier )?0bsd
0bsd | 2 | bsd | (?:zero clause bsd|bsd zero clause)(?: licen[cs]e)?
bsd-protection | 2 | bsd | bsd protection licen[cs]e
bsd | 1 | bsd | bsd (?:style )?licen[cs]ed?
bsd | 1 | regents | regents of the university of california
isc | 3 | permission | permission to use copy modify and or distribute this software for any purpose with or without fee
isc | 2 | isc | (?:spdx license identifier isc|isc licen[cs]e)
isc | 2 | openbsd | openbsd licen[cs]e
gpl-3.0 | 3 | gnu | (?:licensed|distributed|released) under (?:the )?(?:terms of the )?gnu general public licen[cs]e (?:version |v )?v?3(?: 0)?
gpl-2.0 | 3 | gnu | (?:licensed|distributed|released) under (?:the )?(?:terms of the )?gnu general public licen[cs]e (?:version |v )?v?2(?: 0)?
gpl | 3 | redistribute | redistribute it and or modify it under the terms of the gnu general public licen[cs]e
gpl-3.0-or-later | 3 | gnu | gnu general public licen[cs]e .{0,60}?either version 3 (?:of the licen[cs]e )?or (?:at your option )?any later version
gpl-2.0-or-later | 3 | gnu | gnu general public licen[cs]e .{0,60}?either version 2 (?:of the licen[cs]e )?or (?:at your option )?any later version
gpl-3.0 | 2 | gnu | gnu general public licen[cs]e (?:version |v )?v?3(?: 0)?
gpl-2.0 | 2 | gnu | gnu general public licen[cs]e (?:version |v )?v?2(?: 0)?
gpl-1.0 | 2 | gnu | gnu general public licen[cs]e (?:version |v )?v?1(?: 0)?
gpl-3.0 | 2 | gpl | spdx license identifier gpl 3 0(?: only| or later)?
gpl-2.0 | 2 | gpl | spdx license identifier gpl 2 0(?: only| or later)?
gpl-3.0 | 2 | gpl | (?:gnu )?gpl (?:version |v )?v?3(?: 0)?
gpl-2.0 | 2 | gpl | (?:gnu )?gpl (?:version |v )?v?2(?: 0)?
gpl-3.0 | 2 | gplv3 | gplv3
gpl-2.0 | 2 | gplv2 | gplv2
gpl | 2 | gnu | gnu org licenses gpl(?: 3 0| 2 0)?(?: html| txt)?
gpl | 1 | gpl | gnu gpl
gpl | 1 | gnu | gnu general public licen[cs]e
gpl-linking-exception | 2 | linking | (?:gpl )?linking exception
gpl-classpath-exception | 2 | classpath | classpath exception
gpl-gcc-exception | 2 | gcc | gcc runtime library exception
gpl-font-exception | 2 | font | gpl font exception
lgpl-3.0 | 2 | lesser | (?:gnu )?lesser general public licen[cs]e (?:version |v )?v?3(?: 0)?
lgpl-2.1 | 2 | lesser | (?:gnu )?lesser general public licen[cs]e (?:version |v )?v?2 1
lgpl-2.0 | 2 | library | gnu library general public licen[cs]e (?:version |v )?v?2(?: 0)?
lgpl-3.0 | 2 | lgpl | (?:spdx license identifier )?(?:gnu )?lgpl (?:version |v )?v?3(?: 0)?(?: only| or later)?
lgpl-2.1 | 2 | lgpl | (?:spdx license identifier )?(?:gnu )?lgpl (?:version |v )?v?2 1(?: only| or later)?
lgpl-3.0 | 2 | lgplv3 | lgplv3
lgpl-2.1 | 2 | lgplv2 | lgplv2(?: 1)?
lgpl | 1 | lesser | gnu lesser general public licen[cs]e
lgpl | 1 | library | gnu library general public licen[cs]e
lgpl | 1 | lgpl | gnu lgpl
agpl-3.0 | 3 | affero | under the terms of the gnu affero general public licen[cs]e
agpl-3.0 | 2 | affero | (?:gnu )?affero general public licen[cs]e (?:version |v )?v?3(?: 0)?
agpl-3.0 | 2 | agpl | (?:spdx license identifier )?(?:gnu )?agpl (?:version |v )?v?3(?: 0)?(?: only| or later)?
agpl-3.0 | 2 | agplv3 | agplv3
agpl-1.0 | 2 | affero | affero general public licen[cs]e (?:version |v )?v?1(?: 0)?
agpl | 1 | affero | affero general public licen[cs]e
gfdl-1.3 | 2 | documentation | gnu free documentation licen[cs]e (?:version |v )?1 3
gfdl-1.2 | 2 | documentation | gnu free documentation licen[cs]e (?:version |v )?1 2
gfdl-1.1 | 2 | documentation | gnu free documentation licen[cs]e (?:version |v )?1 1
gfdl | 1 | documentation | (?:gnu )?free documentation licen[cs]e
gfdl | 1 | gfdl | gfdl
mpl-2.0 | 3 | mozilla | subject to the terms of the mozilla public licen[cs]e (?:version |v )?2 0
mpl-1.1 | 3 | mozilla | subject to the mozilla public licen[cs]e version 1 1
mpl-2.0 | 2 | mozilla | mozilla public licen[cs]e (?:version |v )?v?2(?: 0)?
mpl-1.1 | 2 | mozilla | mozilla public licen[cs]e (?:version |v )?v?1 1
mpl-1.0 | 2 | mozilla | mozilla public licen[cs]e (?:version |v )?v?1 0
mpl-2.0 | 2 | mpl | (?:spdx license identifier )?mpl (?:version |v )?v?2 0
mpl-1.1 | 2 | mpl | (?:spdx license identifier )?mpl (?:version |v )?v?1 1
mpl | 1 | mozilla | mozilla public licen[cs]e
npl | 2 | netscape | netscape public licen[cs]e
epl-2.0 | 2 | eclipse | eclipse public licen[cs]e (?:version |v )?v?2(?: 0)?
epl-1.0 | 2 | eclipse | eclipse public licen[cs]e (?:version |v )?v?1(?: 0)?
epl-2.0 | 2 | epl | (?:spdx license identifier )?epl (?:v )?2 0
epl-1.0 | 2 | epl | (?:spdx license identifier )?epl (?:v )?1 0
epl | 1 | eclipse | eclipse public licen[cs]e
edl-1.0 | 2 | eclipse | eclipse distribution licen[cs]e(?: v(?:ersion)? 1(?: 0)?)?
cpl-1.0 | 2 | common | common public licen[cs]e(?: version)?(?: v?1(?: 0)?)?
ipl-1.0 | 2 | ibm | ibm public licen[cs]e(?: version)?(?: v?1(?: 0)?)?
cddl-1.1 | 2 | cddl | cddl (?:version |v )?1 1
cddl-1.0 | 2 | cddl | cddl (?:version |v )?1 0
cddl | 2 | distribution | common development and distribution licen[cs]e
cddl | 1 | cddl | cddl
eupl-1.2 | 2 | european | european union public licen[cs]e (?:version |v )?v?1 2
eupl-1.1 | 2 | european | european union public licen[cs]e (?:version |v )?v?1 1
eupl | 1 | european | european union public licen[cs]e
eupl | 1 | eupl | eupl(?: v?1 [12])?
osl-3.0 | 2 | open | open software licen[cs]e (?:version |v )?v?3(?: 0)?
osl-2.1 | 2 | open | open software licen[cs]e (?:version |v )?v?2 1
afl-3.0 | 2 | academic | academic free licen[cs]e (?:version |v )?v?3(?: 0)?
afl-2.1 | 2 | academic | academic free licen[cs]e (?:version |v )?v?2 1
afl | 1 | academic | academic free licen[cs]e
ecl-2.0 | 2 | educational | educational community licen[cs]e(?: version)?(?: v?2(?: 0)?)?
artistic-2.0 | 2 | artistic | artistic licen[cs]e (?:version |v )?v?2(?: 0)?
artistic-1.0 | 2 | artistic | artistic licen[cs]e (?:version |v )?v?1(?: 0)?
artistic | 1 | artistic | (?:the )?artistic licen[cs]e
perl | 2 | perl | same terms as perl(?: itself)?
python-2.0 | 2 | python | python software foundation licen[cs]e(?: version)?(?: 2)?
psf | 1 | psf | psf licen[cs]e
ruby | 2 | ruby | ruby licen[cs]e
php-3.01 | 2 | php | php licen[cs]e(?: version)?(?: v?3(?: 0?1)?)?
tcl | 2 | tcl | tcl tk licen[cs]e
zlib | 3 | altered | altered source versions must be plainly marked as such
zlib | 2 | zlib | (?:spdx license identifier zlib|zlib licen[cs]e|zlib libpng licen[cs]e)
libpng | 2 | libpng | libpng licen[cs]e(?: version 2)?
bsl-1.0 | 3 | boost | distributed under the boost software licen[cs]e
bsl-1.0 | 2 | boost | boost software licen[cs]e(?: version)?(?: v?1(?: 0)?)?
bsl-1.0 | 2 | bsl | spdx license identifier bsl 1 0
busl-1.1 | 2 | business | business source licen[cs]e(?: version)?(?: 1 1)?
elastic-2.0 | 2 | elastic | elastic licen[cs]e(?: version)?(?: 2(?: 0)?)?
sspl-1.0 | 2 | server | server side public licen[cs]e(?: version)?(?: v?1)?
sspl-1.0 | 2 | sspl | sspl(?: v?1)?(?: 0)?
commons-clause | 2 | commons | commons clause(?: license condition)?
polyform-noncommercial | 2 | polyform | polyform noncommercial licen[cs]e(?: 1 0 0)?
polyform-small-business | 2 | polyform | polyform small business licen[cs]e(?: 1 0 0)?
polyform | 1 | polyform | polyform [a-z]+ licen[cs]e
confluent-community | 2 | confluent | confluent community licen[cs]e
redis-sal | 2 | redis | redis source available licen[cs]e
unlicense | 3 | unencumbered | free and unencumbered software released into the public domain
unlicense | 2 | unlicense | (?:the )?unlicense
unlicense | 2 | unlicense | spdx license identifier unlicense
wtfpl | 2 | wtfpl | wtfpl
wtfpl | 2 | want | do what the f[a-z]* you want to public licen[cs]e
beerware | 2 | beerware | beerware(?: licen[cs]e)?
beerware | 2 | beer | beer ware licen[cs]e
public-domain | 2 | domain | (?:dedicated|released|placed) (?:in|into|to) the public domain
public-domain | 1 | domain | public domain(?: dedication)?
pddl-1.0 | 2 | domain | public domain dedication and licen[cs]e
cc0-1.0 | 3 | waived | waived all copyright and related or neighboring rights
cc0-1.0 | 2 | cc0 | cc0(?: 1 0)?(?: universal)?
cc0-1.0 | 2 | creativecommons | creativecommons org publicdomain zero 1 0
cc0-1.0 | 2 | creative | creative commons zero(?: v?1 0)?(?: universal)?
cc-by-nc-nd-4.0 | 2 | cc | cc by nc nd 4 0
cc-by-nc-nd-3.0 | 2 | cc | cc by nc nd 3 0
cc-by-nc-nd | 2 | cc | cc by nc nd
cc-by-nc-sa-4.0 | 2 | cc | cc by nc sa 4 0
cc-by-nc-sa-3.0 | 2 | cc | cc by nc sa 3 0
cc-by-nc-sa | 2 | cc | cc by nc sa
cc-by-nc-4.0 | 2 | cc | cc by nc 4 0
cc-by-nc-3.0 | 2 | cc | cc by nc 3 0
cc-by-nc | 2 | cc | cc by nc
cc-by-nd-4.0 | 2 | cc | cc by nd 4 0
cc-by-nd-3.0 | 2 | cc | cc by nd 3 0
cc-by-nd | 2 | cc | cc by nd
cc-by-sa-4.0 | 2 | cc | cc by sa 4 0
cc-by-sa-3.0 | 2 | cc | cc by sa 3 0
cc-by-sa-2.5 | 2 | cc | cc by sa 2 5
cc-by-sa-2.0 | 2 | cc | cc by sa 2 0
cc-by-sa | 2 | cc | cc by sa
cc-by-4.0 | 2 | cc | cc by 4 0
cc-by-3.0 | 2 | cc | cc by 3 0
cc-by-2.5 | 2 | cc | cc by 2 5
cc-by-2.0 | 2 | cc | cc by 2 0
cc-by-nc-nd-4.0 | 2 | noncommercial | attribution noncommercial no ?deriv(?:ative)?s(?: works)? 4 0(?: international)?
cc-by-nc-sa-4.0 | 2 | noncommercial | attribution noncommercial share ?alike 4 0(?: international)?
cc-by-nc-4.0 | 2 | noncommercial | attribution noncommercial 4 0(?: international)?
cc-by-nd-4.0 | 2 | attribution | attribution no ?deriv(?:ative)?s 4 0(?: international)?
cc-by-sa-4.0 | 2 | attribution | attribution share ?alike 4 0(?: international)?
cc-by-sa-3.0 | 2 | attribution | attribution share ?alike 3 0(?: unported)?
cc-by-4.0 | 2 | attribution | attribution 4 0(?: international)?
cc-by-3.0 | 2 | attribution | attribution 3 0(?: unported)?
cc-by-nc-nd | 2 | creativecommons | creativecommons org licenses by nc nd(?: \d 0)?
cc-by-nc-sa | 2 | creativecommons | creativecommons org licenses by nc sa(?: \d 0)?
cc-by-nc | 2 | creativecommons | creativecommons org licenses by nc(?: \d 0)?
cc-by-nd | 2 | creativecommons | creativecommons org licenses by nd(?: \d 0)?
cc-by-sa | 2 | creativecommons | creativecommons org licenses by sa(?: \d 0)?
cc-by | 2 | creativecommons | creativecommons org licenses by(?: \d 0)?
creative-commons | 3 | creative | (?:licensed|released|available) under (?:a|the) creative commons [a-z ]{0,60}?licen[cs]e
creative-commons | 1 | creative | creative commons(?: [a-z]+)?(?: licen[cs]e)?
odbl-1.0 | 2 | database | open (?:data commons open )?database licen[cs]e(?: v?1 0)?
odbl-1.0 | 2 | odbl | odbl(?: 1 0)?
odc-by-1.0 | 2 | odc | odc by(?: 1 0)?
odc-by-1.0 | 2 | data | open data commons attribution licen[cs]e(?: v?1 0)?
cdla-permissive | 2 | cdla | cdla permissive(?: [12] 0)?
cdla-permissive | 2 | community | community data licen[cs]e agreement permissive
cdla-sharing | 2 | cdla | cdla sharing(?: 1 0)?
ogl-3.0 | 2 | government | open government licen[cs]e(?: v3| v?3 0)?
fr-lo | 2 | ouverte | licence ouverte(?: open licence)?
dl-de | 2 | datenlizenz | datenlizenz deutschland(?: namensnennung| zero)?(?: 2 0)?
ofl-1.1 | 2 | font | sil open font licen[cs]e(?: version)?(?: v?1 1)?
ofl-1.1 | 2 | ofl | spdx license identifier ofl 1 1
ufl-1.0 | 2 | ubuntu | ubuntu font licen[cs]e(?: 1 0)?
bitstream-vera | 2 | bitstream | bitstream vera fonts copyright
ms-pl | 2 | microsoft | microsoft public licen[cs]e
ms-rl | 2 | microsoft | microsoft reciprocal licen[cs]e
ms-pl | 2 | ms | (?:spdx license identifier )?ms pl
upl-1.0 | 2 | permissive | universal permissive licen[cs]e(?: v?1 0)?
w3c | 2 | w3c | w3c software (?:notice and )?licen[cs]e
ncsa | 2 | ncsa | (?:university of illinois )?ncsa open source licen[cs]e
llvm-exception | 2 | llvm | (?:apache 2 0 with )?llvm exceptions?
openssl | 2 | openssl | openssl licen[cs]e
curl | 2 | curl | curl licen[cs]e
postgresql | 2 | postgresql | postgresql licen[cs]e
sleepycat | 2 | sleepycat | sleepycat licen[cs]e
vim | 2 | vim | vim licen[cs]e
icu | 2 | icu | icu licen[cs]e
unicode | 2 | unicode | unicode (?:terms of use|licen[cs]e(?: v3)?)
ijg | 2 | jpeg | independent jpeg group s? ?software
lppl-1.3c | 2 | latex | latex project public licen[cs]e(?: version)?(?: 1 3c?)?
qpl-1.0 | 2 | qpl | qpl(?: 1 0)?
qpl-1.0 | 2 | public | q public licen[cs]e
cecill-2.1 | 2 | cecill | cecill(?: free software)?(?: licen[cs]e)?(?: (?:version |v )?2 1)?
cecill-b | 2 | cecill | cecill b(?: licen[cs]e)?
cecill-c | 2 | cecill | cecill c(?: licen[cs]e)?
mulanpsl-2.0 | 2 | mulan | mulan (?:psl|permissive software licen[cs]e) v?2(?: 0)?
blueoak-1.0.0 | 2 | blue | blue oak model licen[cs]e(?: 1 0 0)?
hippocratic | 2 | hippocratic | hippocratic licen[cs]e(?: 2 1| 3 0)?
json | 3 | evil | the software shall be used for good not evil
ssh-openssh | 2 | openssh | openssh licen[cs]e
openrail-m | 2 | openrail | (?:creativeml )?openrail(?: m)?(?: licen[cs]e)?
rail | 2 | responsible | responsible ai licen[cs]e
bigscience-rail | 2 | bigscience | bigscience (?:bloom )?rail(?: licen[cs]e)?
llama-community | 2 | llama | llama (?:\d )*community licen[cs]e(?: agreement)?
gemma-terms | 2 | gemma | gemma terms of use
research-only | 2 | research | for (?:non commercial )?research (?:purposes|use) only
non-commercial | 1 | commercial | (?:for )?non commercial use(?: only)?
non-commercial | 1 | noncommercial | noncommercial use(?: only)?
proprietary | 2 | proprietary | proprietary and confidential
proprietary | 2 | unauthorized | unauthorized (?:copying|reproduction|distribution) .{0,60}?(?:strictly )?prohibited
proprietary | 1 | confidential | confidential information of
eula | 2 | user | end user licen[cs]e agreement(?: eula)?
eula | 1 | user | end user licen[cs]e agreement
commercial | 2 | commercial | commercial licen[cs]e(?: agreement)?
trial | 1 | evaluation | evaluation licen[cs]e(?: agreement)?
dual-license | 1 | dual | dual licen[cs]ed
spdx | 1 | spdx | spdx license identifier [a-z0-9]+
copyright-notice | 1 | copyright | copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)?
copyright-notice | 1 | copyright | copyright c
rights-reserved | 2 | rights | some rights reserved
rights-reserved | 1 | droits | tous droits réservés
rights-reserved | 1 | rechte | alle rechte vorbehalten
rights-reserved | 1 | derechos | todos los derechos reservados
licence-file | 1 | license | see (?:the )?license (?:file )?(?:for|in) (?:the )?(?:details|more information|project root)
licence-file | 1 | licence | see (?:the )?licence (?:file )?(?:for|in) (?:the )?(?:details|more information|project root)
licence-file | 1 | notice | see (?:the )?notice file distributed with this work
licence-hint | 1 | licensed | licensed under
"""

#: The labels that every scan reports, by their phrase.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

RULES: list[tuple[str, int, str, str]] = []
for _line in _RULES.strip().splitlines():
    _label, _priority, _keyword, _expression = _line.split(" | ", 3)
    RULES.append((_label, int(_priority), _keyword, _expression))
