"""Signature rules of the license scan.

One rule a line:  label | priority | keyword | pattern.  A pattern is a Java
regular expression over a text's normal form: its words in lower case, one
space between two.  The keyword is a piece of text that every match holds; a rule
runs only on texts that hold it.  Priority: 4 a machine-readable tag, 3 a grant or
a title with its version, 2 a title or a license's own wording, 1 an address,
0 a passing mention.
"""

RULES_TEXT = r"""
mit | 4 | spdx license identifier | spdx license identifier mit
mit | 3 | mit license | (?:under|with|by) the (?:terms of the )?mit license
mit | 2 | mit license | (?:the )?mit license
mit | 3 | mit licence | (?:under|with|by) the (?:terms of the )?mit licence
mit | 2 | expat license | (?:the )?expat license
mit | 1 | opensource org licenses mit | opensource org licenses mit(?: license(?: php| html)?)?
mit | 2 | permission is hereby granted free of charge | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | 0 | mit licensed | mit licensed
mit-0 | 4 | identifier mit 0 | spdx license identifier mit 0
mit-0 | 3 | mit no attribution | mit no attribution(?: license)?
x11 | 4 | identifier x11 | spdx license identifier x11
x11 | 2 | x11 license | (?:the )?x11 license
apache-2 | 4 | identifier apache 2 0 | spdx license identifier apache 2 0
apache-2 | 3 | apache license version 2 | (?:under )?(?:the )?apache license version 2(?: 0)?
apache-2 | 3 | apache license 2 0 | (?:under )?(?:the )?apache license 2 0
apache-2 | 3 | apache 2 0 license | (?:under )?(?:the )?apache 2 0 license
apache-2 | 2 | apache software license | apache software license (?:version )?2(?: 0)?
apache-2 | 1 | apache org licenses license 2 0 | apache org licenses license 2 0(?: txt| html)?
apache-2 | 1 | licenses apache 2 0 | opensource org licenses apache 2 0
apache-2 | 0 | asl 2 0 | asl 2 0
apache-2 | 0 | apache 2 | apache 2(?: 0)?
apache-1.1 | 4 | identifier apache 1 1 | spdx license identifier apache 1 1
apache-1.1 | 3 | apache software license | apache software license version 1 1
apache-1.0 | 4 | identifier apache 1 0 | spdx license identifier apache 1 0
apache-1.0 | 3 | apache software license | apache software license version 1 0
apache | 1 | apache license | (?:the )?apache license
gpl-1.0 | 4 | identifier gpl 1 0 | spdx license identifier gpl 1 0(?: only| or later)?
gpl-1.0 | 3 | general public license version 1 | (?:gnu )?general public license version 1
gpl-2.0 | 4 | identifier gpl 2 0 | spdx license identifier gpl 2 0(?: only)?
gpl-2.0-or-later | 4 | identifier gpl 2 0 or later | spdx license identifier gpl 2 0 or later
gpl-2.0 | 3 | general public license version 2 | (?:gnu )?general public license version 2(?: 0)?(?: only)?
gpl-2.0 | 3 | general public license v2 | (?:gnu )?general public license v2(?: 0)?(?: only)?
gpl-2.0-or-later | 3 | either version 2 of the license | general public license as published by the free software foundation either version 2 of the license or at your option any later version
gpl-2.0 | 3 | version 2 of the license | general public license as published by the free software foundation version 2 of the license
gpl-2.0 | 2 | gplv2 | gplv2(?: 0)?
gpl-2.0 | 2 | gpl 2 0 | gpl 2 0
gpl-2.0-or-later | 2 | gplv2 or later | gplv2 or later
gpl-2.0 | 2 | gpl version 2 | gpl version 2(?: 0)?
gpl-2.0 | 1 | licenses gpl 2 0 | gnu org licenses(?: old licenses)? gpl 2 0(?: html| txt)?
gpl-2.0 | 1 | opensource org licenses gpl 2 0 | opensource org licenses gpl 2 0
gpl-3.0 | 4 | identifier gpl 3 0 | spdx license identifier gpl 3 0(?: only)?
gpl-3.0-or-later | 4 | identifier gpl 3 0 or later | spdx license identifier gpl 3 0 or later
gpl-3.0 | 3 | general public license version 3 | (?:gnu )?general public license version 3(?: 0)?(?: only)?
gpl-3.0 | 3 | general public license v3 | (?:gnu )?general public license v3(?: 0)?(?: only)?
gpl-3.0-or-later | 3 | either version 3 of the license | general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl-3.0 | 3 | version 3 of the license | general public license as published by the free software foundation version 3 of the license
gpl-3.0 | 2 | gplv3 | gplv3(?: 0)?
gpl-3.0 | 2 | gpl 3 0 | gpl 3 0
gpl-3.0-or-later | 2 | gplv3 or later | gplv3 or later
gpl-3.0 | 2 | gpl version 3 | gpl version 3(?: 0)?
gpl-3.0 | 1 | licenses gpl 3 0 | gnu org licenses gpl 3 0(?: html| txt)?
gpl-3.0 | 1 | opensource org licenses gpl 3 0 | opensource org licenses gpl 3 0
gpl | 1 | gnu general public license | (?:the )?gnu general public license
gpl | 0 | gnu gpl | (?:the )?gnu gpl
gpl | 0 | under the gpl | under the gpl
gpl-with-classpath-exception | 4 | with classpath exception 2 0 | spdx license identifier gpl 2 0(?: only| or later)? with classpath exception 2 0
gpl-with-classpath-exception | 2 | classpath exception | classpath exception
gpl-with-linux-syscall-note | 4 | with linux syscall note | spdx license identifier gpl 2 0(?: only| or later)? with linux syscall note
lgpl-2.0 | 4 | identifier lgpl 2 0 | spdx license identifier lgpl 2 0(?: only| or later)?
lgpl-2.0 | 3 | library general public license | (?:gnu )?library general public license(?: version 2(?: 0)?)?
lgpl-2.1 | 4 | identifier lgpl 2 1 | spdx license identifier lgpl 2 1(?: only)?
lgpl-2.1-or-later | 4 | identifier lgpl 2 1 or later | spdx license identifier lgpl 2 1 or later
lgpl-2.1 | 3 | lesser general public license version 2 1 | (?:gnu )?lesser general public license version 2 1(?: only)?
lgpl-2.1 | 3 | lesser general public license v2 1 | (?:gnu )?lesser general public license v2 1
lgpl-2.1-or-later | 3 | either version 2 1 of the license | lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version
lgpl-2.1 | 2 | lgplv2 1 | lgplv2 1
lgpl-2.1 | 2 | lgpl 2 1 | lgpl 2 1
lgpl-2.1 | 1 | licenses lgpl 2 1 | gnu org licenses(?: old licenses)? lgpl 2 1(?: html| txt)?
lgpl-3.0 | 4 | identifier lgpl 3 0 | spdx license identifier lgpl 3 0(?: only)?
lgpl-3.0-or-later | 4 | identifier lgpl 3 0 or later | spdx license identifier lgpl 3 0 or later
lgpl-3.0 | 3 | lesser general public license version 3 | (?:gnu )?lesser general public license version 3(?: 0)?
lgpl-3.0 | 3 | lesser general public license v3 | (?:gnu )?lesser general public license v3(?: 0)?
lgpl-3.0-or-later | 3 | either version 3 of the license | lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version
lgpl-3.0 | 2 | lgplv3 | lgplv3(?: 0)?
lgpl-3.0 | 2 | lgpl 3 0 | lgpl 3 0
lgpl-3.0 | 1 | licenses lgpl 3 0 | gnu org licenses lgpl 3 0(?: html| txt)?
lgpl | 1 | lesser general public license | (?:the )?gnu lesser general public license
lgpl | 0 | gnu lgpl | (?:the )?gnu lgpl
agpl-1.0 | 4 | identifier agpl 1 0 | spdx license identifier agpl 1 0(?: only| or later)?
agpl-3.0 | 4 | identifier agpl 3 0 | spdx license identifier agpl 3 0(?: only)?
agpl-3.0-or-later | 4 | identifier agpl 3 0 or later | spdx license identifier agpl 3 0 or later
agpl-3.0 | 3 | affero general public license version 3 | (?:gnu )?affero general public license version 3(?: 0)?
agpl-3.0 | 3 | affero general public license v3 | (?:gnu )?affero general public license v3(?: 0)?
agpl-3.0-or-later | 3 | either version 3 of the license | affero general public license as published by the free software foundation either version 3 of the license or at your option any later version
agpl-3.0 | 2 | agplv3 | agplv3(?: 0)?
agpl-3.0 | 2 | agpl 3 0 | agpl 3 0
agpl-3.0 | 1 | licenses agpl 3 0 | gnu org licenses agpl 3 0(?: html| txt)?
agpl | 1 | affero general public license | (?:the )?(?:gnu )?affero general public license
gfdl-1.1 | 4 | identifier gfdl 1 1 | spdx license identifier gfdl 1 1(?: only| or later)?
gfdl-1.2 | 4 | identifier gfdl 1 2 | spdx license identifier gfdl 1 2(?: only| or later)?
gfdl-1.2 | 3 | free documentation license version 1 2 | (?:gnu )?free documentation license version 1 2
gfdl-1.3 | 4 | identifier gfdl 1 3 | spdx license identifier gfdl 1 3(?: only| or later)?
gfdl-1.3 | 3 | free documentation license version 1 3 | (?:gnu )?free documentation license version 1 3
gfdl | 1 | free documentation license | (?:the )?(?:gnu )?free documentation license
bsd-2-clause | 4 | identifier bsd 2 clause | spdx license identifier bsd 2 clause(?: freebsd| netbsd| patent| views)?
bsd-2-clause | 3 | bsd 2 clause | (?:under )?(?:the )?bsd 2 clause license
bsd-2-clause | 3 | 2 clause bsd | (?:under )?(?:the )?2 clause bsd license
bsd-2-clause | 2 | simplified bsd license | (?:the )?simplified bsd license
bsd-2-clause | 2 | freebsd license | (?:the )?freebsd license
bsd-2-clause | 1 | licenses bsd 2 clause | opensource org licenses bsd 2 clause
bsd-3-clause | 4 | identifier bsd 3 clause | spdx license identifier bsd 3 clause(?: clear| attribution)?
bsd-3-clause | 3 | bsd 3 clause | (?:under )?(?:the )?bsd 3 clause license
bsd-3-clause | 3 | 3 clause bsd | (?:under )?(?:the )?3 clause bsd license
bsd-3-clause | 2 | new bsd license | (?:the )?new bsd license
bsd-3-clause | 2 | modified bsd license | (?:the )?modified bsd license
bsd-3-clause | 2 | revised bsd license | (?:the )?revised bsd license
bsd-3-clause | 2 | may be used to endorse or promote | neither the name of [^|]{1,80}? nor the names of (?:its|their) contributors may be used to endorse or promote products
bsd-3-clause | 1 | licenses bsd 3 clause | opensource org licenses bsd 3 clause
bsd-4-clause | 4 | identifier bsd 4 clause | spdx license identifier bsd 4 clause(?: uc)?
bsd-4-clause | 3 | 4 clause bsd | (?:the )?4 clause bsd license
bsd-4-clause | 2 | original bsd license | (?:the )?original bsd license
bsd-4-clause | 2 | this product includes software developed by | all advertising materials mentioning features or use of this software must display the following acknowledg[e]?ment this product includes software developed by
bsd-0-clause | 4 | identifier 0bsd | spdx license identifier 0bsd
bsd-0-clause | 2 | zero clause bsd | (?:the )?(?:bsd )?zero clause bsd(?: license)?
bsd | 2 | redistribution and use in source and binary forms | redistribution and use in source and binary forms with or without modification are permitted
bsd | 1 | bsd license | (?:the )?bsd(?: style)? license
bsd | 0 | bsd licensed | bsd licensed
isc | 4 | identifier isc | spdx license identifier isc
isc | 3 | isc license | (?:under )?(?:the )?isc license
isc | 2 | permission to use copy modify and | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | 1 | opensource org licenses isc | opensource org licenses isc
mpl-1.0 | 4 | identifier mpl 1 0 | spdx license identifier mpl 1 0
mpl-1.1 | 4 | identifier mpl 1 1 | spdx license identifier mpl 1 1
mpl-1.1 | 3 | mozilla public license version 1 1 | mozilla public license version 1 1
mpl-1.1 | 1 | mozilla org mpl | mozilla org mpl(?: mpl 1 1)?(?: html| txt)?
mpl-2.0 | 4 | identifier mpl 2 0 | spdx license identifier mpl 2 0(?: no copyleft exception)?
mpl-2.0 | 3 | mozilla public license | mozilla public license (?:version |v )?2 0
mpl-2.0 | 2 | mpl 2 0 | mpl 2 0
mpl-2.0 | 1 | mozilla org mpl 2 0 | mozilla org (?:en us )?mpl 2 0
mpl | 1 | mozilla public license | (?:the )?mozilla public license
epl-1.0 | 4 | identifier epl 1 0 | spdx license identifier epl 1 0
epl-1.0 | 3 | eclipse public license | eclipse public license (?:version |v )?1 0
epl-1.0 | 1 | epl v10 | eclipse org legal epl v10(?: html)?
epl-2.0 | 4 | identifier epl 2 0 | spdx license identifier epl 2 0
epl-2.0 | 3 | eclipse public license | eclipse public license (?:version |v )?2 0
epl-2.0 | 1 | legal epl 2 0 | eclipse org legal epl 2 0(?: html)?
epl | 1 | eclipse public license | (?:the )?eclipse public license
edl-1.0 | 3 | eclipse distribution license | eclipse distribution license (?:version |v )?1 0
cddl-1.0 | 4 | identifier cddl 1 0 | spdx license identifier cddl 1 0
cddl-1.0 | 3 | common development and distribution license | common development and distribution license (?:version |v )?1 0
cddl-1.1 | 4 | identifier cddl 1 1 | spdx license identifier cddl 1 1
cddl-1.1 | 3 | common development and distribution license | common development and distribution license (?:version |v )?1 1
cddl | 1 | common development and distribution license | (?:the )?common development and distribution license
cpl-1.0 | 4 | identifier cpl 1 0 | spdx license identifier cpl 1 0
cpl-1.0 | 2 | common public license | common public license(?: version)? 1 0
ipl-1.0 | 3 | ibm public license | ibm public license(?: version)? 1 0
eupl-1.1 | 4 | identifier eupl 1 1 | spdx license identifier eupl 1 1
eupl-1.1 | 3 | european union public licence | european union public licence (?:version |v )?1 1
eupl-1.2 | 4 | identifier eupl 1 2 | spdx license identifier eupl 1 2
eupl-1.2 | 3 | european union public licence | european union public licence (?:version |v )?1 2
eupl | 1 | european union public licence | (?:the )?european union public licence
osl-3.0 | 4 | identifier osl 3 0 | spdx license identifier osl 3 0
osl-3.0 | 3 | open software license | open software license (?:version |v )?3 0
afl-3.0 | 4 | identifier afl 3 0 | spdx license identifier afl 3 0
afl-3.0 | 3 | academic free license | academic free license (?:version |v )?3 0
artistic-1.0 | 4 | identifier artistic 1 0 | spdx license identifier artistic 1 0(?: perl| cl8)?
artistic-1.0 | 3 | artistic license 1 0 | (?:the )?artistic license 1 0
artistic-2.0 | 4 | identifier artistic 2 0 | spdx license identifier artistic 2 0
artistic-2.0 | 3 | artistic license 2 0 | (?:the )?artistic license 2 0
artistic | 1 | artistic license | (?:the )?artistic license
perl | 2 | same terms as perl itself | under the same terms as perl itself
zlib | 4 | identifier zlib | spdx license identifier zlib
zlib | 3 | zlib license | (?:the )?zlib(?: libpng)? license
zlib | 2 | this software is provided as is without any express or implied warranty | this software is provided as is without any express or implied warranty in no event will the authors be held liable
libpng | 4 | identifier libpng | spdx license identifier libpng(?: 2 0)?
libpng | 2 | libpng license | (?:the )?libpng license
bsl-1.0 | 4 | identifier bsl 1 0 | spdx license identifier bsl 1 0
bsl-1.0 | 3 | boost software license | boost software license version 1 0
bsl-1.0 | 1 | boost org license 1 0 | boost org license 1 0 txt
bsl-1.0 | 2 | boost software license | (?:the )?boost software license
busl-1.1 | 4 | identifier busl 1 1 | spdx license identifier busl 1 1
busl-1.1 | 3 | business source license | business source license(?: version)? 1 1
unlicense | 4 | identifier unlicense | spdx license identifier unlicense
unlicense | 2 | free and unencumbered software | this is free and unencumbered software released into the public domain
unlicense | 1 | unlicense org | unlicense org
unlicense | 1 | the unlicense | the unlicense
wtfpl | 4 | identifier wtfpl | spdx license identifier wtfpl
wtfpl | 2 | you want to public license | do what the f[a-z]{3} you want to public license
wtfpl | 0 | wtfpl | wtfpl
beerware | 4 | identifier beerware | spdx license identifier beerware
beerware | 2 | beer ware license | (?:the )?beer ware license
public-domain | 2 | released into the public domain | (?:is |are )?released into the public domain
public-domain | 1 | in the public domain | (?:is |are )in the public domain
public-domain | 1 | dedicated to the public domain | dedicated to the public domain
cc0-1.0 | 4 | identifier cc0 1 0 | spdx license identifier cc0 1 0
cc0-1.0 | 3 | cc0 1 0 universal | cc0 1 0 universal(?: public domain dedication)?
cc0-1.0 | 2 | creative commons zero | creative commons zero(?: v1 0 universal)?
cc0-1.0 | 1 | publicdomain zero 1 0 | creativecommons org publicdomain zero 1 0
cc0-1.0 | 0 | cc0 | cc0
cc-by | 2 | creative commons attribution | creative commons attribution(?: license)?
cc-by | 1 | cc by | cc by
cc-by-1.0 | 4 | identifier cc by 1 0 | spdx license identifier cc by 1 0
cc-by-2.0 | 4 | identifier cc by 2 0 | spdx license identifier cc by 2 0
cc-by-2.5 | 4 | identifier cc by 2 5 | spdx license identifier cc by 2 5
cc-by-3.0 | 4 | identifier cc by 3 0 | spdx license identifier cc by 3 0
cc-by-3.0 | 3 | cc by 3 0 | cc by 3 0
cc-by-3.0 | 3 | creative commons attribution 3 0 | creative commons attribution 3 0(?: unported)?(?: license)?
cc-by-3.0 | 1 | licenses by 3 0 | creativecommons org licenses by 3 0
cc-by-4.0 | 4 | identifier cc by 4 0 | spdx license identifier cc by 4 0
cc-by-4.0 | 3 | cc by 4 0 | cc by 4 0
cc-by-4.0 | 3 | creative commons attribution 4 0 | creative commons attribution 4 0(?: international)?(?: license)?
cc-by-4.0 | 1 | licenses by 4 0 | creativecommons org licenses by 4 0
cc-by-sa | 2 | attribution sharealike | creative commons attribution sharealike(?: license)?
cc-by-sa | 2 | attribution share alike | creative commons attribution share alike(?: license)?
cc-by-sa | 1 | cc by sa | cc by sa
cc-by-sa-2.0 | 3 | cc by sa 2 0 | (?:spdx license identifier )?cc by sa 2 0
cc-by-sa-2.5 | 3 | cc by sa 2 5 | (?:spdx license identifier )?cc by sa 2 5
cc-by-sa-3.0 | 3 | cc by sa 3 0 | (?:spdx license identifier )?cc by sa 3 0
cc-by-sa-3.0 | 3 | attribution sharealike 3 0 | creative commons attribution sharealike 3 0(?: unported)?(?: license)?
cc-by-sa-3.0 | 1 | licenses by sa 3 0 | creativecommons org licenses by sa 3 0
cc-by-sa-4.0 | 3 | cc by sa 4 0 | (?:spdx license identifier )?cc by sa 4 0
cc-by-sa-4.0 | 3 | attribution sharealike 4 0 | creative commons attribution sharealike 4 0(?: international)?(?: license)?
cc-by-sa-4.0 | 1 | licenses by sa 4 0 | creativecommons org licenses by sa 4 0
cc-by-nc | 2 | cc by nc | cc by nc
cc-by-nc | 2 | attribution noncommercial | creative commons attribution noncommercial(?: license)?
cc-by-nc | 2 | attribution non commercial | creative commons attribution non commercial(?: license)?
cc-by-nc-3.0 | 3 | cc by nc 3 0 | (?:spdx license identifier )?cc by nc 3 0
cc-by-nc-4.0 | 3 | cc by nc 4 0 | (?:spdx license identifier )?cc by nc 4 0
cc-by-nc-4.0 | 3 | attribution noncommercial 4 0 | creative commons attribution noncommercial 4 0(?: international)?(?: license)?
cc-by-nc-4.0 | 1 | licenses by nc 4 0 | creativecommons org licenses by nc 4 0
cc-by-nd | 2 | cc by nd | cc by nd
cc-by-nd | 2 | attribution noderiv | creative commons attribution noderiv(?:s|atives)(?: license)?
cc-by-nd-4.0 | 3 | cc by nd 4 0 | (?:spdx license identifier )?cc by nd 4 0
cc-by-nd-4.0 | 1 | licenses by nd 4 0 | creativecommons org licenses by nd 4 0
cc-by-nc-sa | 2 | cc by nc sa | cc by nc sa
cc-by-nc-sa | 2 | noncommercial sharealike | creative commons attribution noncommercial sharealike(?: license)?
cc-by-nc-sa-3.0 | 3 | cc by nc sa 3 0 | (?:spdx license identifier )?cc by nc sa 3 0
cc-by-nc-sa-4.0 | 3 | cc by nc sa 4 0 | (?:spdx license identifier )?cc by nc sa 4 0
cc-by-nc-sa-4.0 | 1 | licenses by nc sa 4 0 | creativecommons org licenses by nc sa 4 0
cc-by-nc-nd | 2 | cc by nc nd | cc by nc nd
cc-by-nc-nd | 2 | noncommercial noderiv | creative commons attribution noncommercial noderiv(?:s|atives)(?: license)?
cc-by-nc-nd-3.0 | 3 | cc by nc nd 3 0 | (?:spdx license identifier )?cc by nc nd 3 0
cc-by-nc-nd-4.0 | 3 | cc by nc nd 4 0 | (?:spdx license identifier )?cc by nc nd 4 0
cc-by-nc-nd-4.0 | 1 | licenses by nc nd 4 0 | creativecommons org licenses by nc nd 4 0
creative-commons | 0 | creative commons license | (?:a |the )?creative commons license
odc-by-1.0 | 3 | open data commons attribution license | open data commons attribution license(?: v1 0)?
odc-by-1.0 | 4 | identifier odc by 1 0 | spdx license identifier odc by 1 0
odbl-1.0 | 3 | open database license | (?:open data commons )?open database license(?: v1 0)?
odbl-1.0 | 4 | identifier odbl 1 0 | spdx license identifier odbl 1 0
pddl-1.0 | 3 | public domain dedication and licen | open data commons public domain dedication and licen[cs]e
ofl-1.1 | 4 | identifier ofl 1 1 | spdx license identifier ofl 1 1
ofl-1.1 | 3 | sil open font license | sil open font license(?: version 1 1)?
ofl-1.1 | 1 | scripts sil org ofl | scripts sil org ofl
psf-2.0 | 4 | identifier psf 2 0 | spdx license identifier psf 2 0
psf-2.0 | 3 | python software foundation license | python software foundation license(?: version 2)?
python-2.0 | 4 | identifier python 2 0 | spdx license identifier python 2 0
php-3.01 | 3 | php license version 3 01 | (?:the )?php license version 3 01
php-3.01 | 4 | identifier php 3 01 | spdx license identifier php 3 01
ruby | 4 | identifier ruby | spdx license identifier ruby
ruby | 2 | same terms as ruby | under the same terms as ruby(?: itself)?
postgresql | 4 | identifier postgresql | spdx license identifier postgresql
postgresql | 2 | postgresql license | (?:the )?postgresql license
openssl | 4 | identifier openssl | spdx license identifier openssl
openssl | 2 | openssl license | (?:the )?openssl license
curl | 4 | identifier curl | spdx license identifier curl
ncsa | 4 | identifier ncsa | spdx license identifier ncsa
ncsa | 3 | ncsa open source license | university of illinois ncsa open source license
w3c | 4 | identifier w3c | spdx license identifier w3c
w3c | 2 | w3c software notice and license | w3c software notice and license
ms-pl | 4 | identifier ms pl | spdx license identifier ms pl
ms-pl | 2 | microsoft public license | (?:the )?microsoft public license
ms-rl | 2 | microsoft reciprocal license | (?:the )?microsoft reciprocal license
upl-1.0 | 4 | identifier upl 1 0 | spdx license identifier upl 1 0
upl-1.0 | 3 | universal permissive license | universal permissive license (?:version |v )?1 0
vim | 4 | identifier vim | spdx license identifier vim
vim | 2 | vim license | (?:the )?vim license
qpl-1.0 | 3 | q public license | (?:the )?q public license version 1 0
sspl-1.0 | 4 | identifier sspl 1 0 | spdx license identifier sspl 1 0
sspl-1.0 | 3 | server side public license | server side public license(?: version 1| v1)?
elastic-2.0 | 4 | identifier elastic 2 0 | spdx license identifier elastic 2 0
elastic-2.0 | 3 | elastic license 2 0 | elastic license 2 0
commons-clause | 3 | commons clause | commons clause license condition(?: v1 0)?
blueoak-1.0.0 | 4 | identifier blueoak 1 0 0 | spdx license identifier blueoak 1 0 0
blueoak-1.0.0 | 3 | blue oak model license | blue oak model license(?: 1 0 0)?
mulanpsl-2.0 | 4 | identifier mulanpsl 2 0 | spdx license identifier mulanpsl 2 0
mulanpsl-2.0 | 3 | mulan psl v2 | mulan psl v2
openrail | 3 | openrail | (?:creativeml |bigscience )?open ?rail(?: m| license)?
proprietary | 1 | all rights reserved | all rights reserved
proprietary | 2 | proprietary and confidential | proprietary and confidential
proprietary | 2 | unauthorized copying of this | unauthorized copying of this file
"""


def rules() -> list[tuple[str, int, str, str]]:
    """(label, priority, keyword, pattern) in the order of the list."""
    out = []
    for line in RULES_TEXT.strip().splitlines():
        label, priority, keyword, pattern = (x.strip() for x in line.split(" | ", 3))
        out.append((label, int(priority), keyword, f"(?<= )(?:{pattern})(?= )"))
    return out
