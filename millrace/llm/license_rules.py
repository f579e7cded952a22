"""Hand-written license signatures.

A line is one license: label | keyword | name | SPDX id | URL | opening of its text.
Signatures are regular expressions over lower-cased words with one space between
them; ``kw @ regex`` gives a signature its own keyword. Every match holds its
keyword and one of :data:`MARKERS`.
"""

from __future__ import annotations

MARKERS = ("licen", "copyright", "permission", "redistribution", "spdx", "creative", "public domain", "warrant", "cecill", "gpl", "mozilla", "eclipse", "eupl", "advertising", "bsd", "no attribution")

LICENSES = r"""
mit | mit licen | mit licen[sc]es? | mit | licenses mit @ opensource org licenses mit(?: license)? | permission is @ permission is hereby granted free of charge to any person obtaining a copy
mit-0 | mit no attribution | mit no attribution(?: licen[sc]e)? | mit 0 | licenses @ opensource org licenses mit 0 |
apache | apache | apache(?: software)? licen[sc]e(?: version)?(?: 2(?: 0)?)? | apache 2 0 | licenses license @ (?:www )?apache org licenses license 2 0 | in compliance @ you may not use this file except in compliance with the license
apache-1.1 | apache | apache(?: software)? licen[sc]e(?: version)? 1 1 | apache 1 1 | licenses license @ (?:www )?apache org licenses license 1 1 | apache @ the names apache and apache software foundation must not be used .{1,80}permission
gpl | general public licen | (?:gnu )?general public licen[sc]e(?: gpl)? | gpl [123] 0(?: only| or later)? | licenses gpl @ gnu org licenses gpl(?: [123] 0)?(?: html)? | general public licen @ under the terms of the gnu general public licen[sc]e
lgpl | lesser general | (?:gnu )?lesser general public licen[sc]e(?: lgpl)? | lgpl [23] [01](?: only| or later)? | licenses lgpl @ gnu org licenses lgpl(?: [23] [01])?(?: html)? | lesser general @ under the terms of the gnu lesser general public licen[sc]e
lgpl-2.0 | library general | (?:gnu )?library general public licen[sc]e | lgpl 2 0(?: only| or later)? | licenses old @ gnu org licenses old licenses lgpl 2 0 | library general @ under the terms of the gnu library general public licen[sc]e
agpl | affero | (?:gnu )?affero general public licen[sc]e(?: agpl)? | agpl [13] 0(?: only| or later)? | licenses agpl @ gnu org licenses agpl(?: 3 0)?(?: html)? | affero @ under the terms of the gnu affero general public licen[sc]e
gfdl | free documentation | (?:gnu )?free documentation licen[sc]e | gfdl 1 [123](?: only| or later)? | licenses fdl @ gnu org licenses fdl(?: 1 [123])? | free documentation @ copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e
bsd | bsd | bsd(?: style)? licen[sc]es? | bsd 3 clause | licenses bsd @ opensource org licenses bsd 3 clause | redistribution and @ redistribution and use in source and binary forms with or without modification are permitted
bsd-2-clause | bsd 2 | bsd 2 clause(?: simplified)?(?: licen[sc]e)? | bsd 2 clause | licenses bsd @ opensource org licenses bsd 2 clause | simplified bsd @ simplified bsd licen[sc]e
bsd-4-clause | bsd 4 | bsd 4 clause(?: licen[sc]e)? | bsd 4 clause | bsd @ spdx org licenses bsd 4 clause | advertising materials @ all advertising materials mentioning features or use of this software
0bsd | zero clause | (?:bsd )?zero clause bsd(?: licen[sc]e)? | 0bsd | licenses 0bsd @ opensource org licenses 0bsd | permission to @ permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | isc licen | isc licen[sc]e | isc | licenses isc @ opensource org licenses isc(?: license)? | permission to @ permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided
mpl | mozilla public | mozilla public licen[sc]e(?: version)?(?: [12] [01])? | mpl [12] [01] | mpl @ mozilla org mpl(?: 2 0| mpl 1 1)? | mozilla public @ subject to the terms of the mozilla public licen[sc]e
epl | eclipse public | eclipse public licen[sc]e(?: version| v)?(?: [12] 0)? | epl [12] 0 | legal epl @ eclipse org (?:org )?legal epl(?: v10| 2 0)? | eclipse public @ terms of the eclipse public licen[sc]e
edl | eclipse distribution | eclipse distribution licen[sc]e(?: version| v)?(?: 1 0)? | bsd 3 clause | documents edl @ eclipse org (?:org )?documents edl v10 | eclipse distribution @ terms of the eclipse distribution licen[sc]e
cddl | common development | common development and distribution licen[sc]e(?: cddl)? | cddl 1 [01] | licenses cddl @ opensource org licenses cddl(?: 1 0)? | common development @ subject to the terms of the common development and distribution licen[sc]e
cpl | common public licen | common public licen[sc]e(?: version)?(?: 1 0)? | cpl 1 0 | licenses cpl @ opensource org licenses cpl 1 0 | common public licen @ terms of this common public licen[sc]e
eupl | european union public | european union public licen[sc]e(?: version| v)?(?: 1 [012])? | eupl 1 [012] | eupl @ joinup ec europa eu .{0,40}eupl | european union public @ licensed under the european union public licen[sc]e
artistic | artistic licen | artistic licen[sc]e(?: [12] 0)? | artistic [12] 0(?: perl| cl8)? | artistic @ opensource org licenses artistic(?: license)?(?: [12] 0)? | artistic @ same terms as perl itself .{0,60}artistic licen[sc]e
perl | perl | same (?:terms|licen[sc]e) as perl(?: itself)? .{0,40}licen[sc]e | artistic 1 0 perl | licenses perl @ dev perl org licenses perl | perl @ under the same terms as perl itself .{0,80}licen[sc]e
zlib | zlib | zlib(?: libpng)? licen[sc]e | zlib | zlib @ (?:www )?gzip org zlib zlib license | arising from @ in no event will the authors be held liable for any damages arising from the use of this software permission
libpng | libpng licen | libpng licen[sc]e(?: version)?(?: 2)? | libpng(?: 2 0)? | libpng @ libpng org pub png src libpng license | png reference @ the png reference library is supplied as is .{0,120}warrant(?:y|ies)
bsl-1.0 | boost software | boost software licen[sc]e(?: version)?(?: 1 0)? | bsl 1 0 | boost @ boost org license 1 0 | boost @ distributed under the boost software licen[sc]e
wtfpl | want to public licen | do what the fuck you want to public licen[sc]e | wtfpl | wtfpl @ wtfpl net .{0,20}licen[sc]e | want to public licen @ everyone is permitted to copy and distribute verbatim or modified copies .{0,80}want to public licen[sc]e
unlicense | unlicense | unlicense | unlicense | unlicense @ unlicense org | public domain @ free and unencumbered software released into the public domain
public-domain | public domain | (?:in|into|to) the public domain | cc pddc | publicdomain @ creativecommons org licenses publicdomain | public domain @ dedicated? (?:\S+ ){0,4}to the public domain
cc0 | cc0 | (?:creative commons )?cc0(?: 1 0)?(?: universal)? (?:licen[sc]e|public domain) | cc0 1 0 | zero @ creativecommons org publicdomain zero(?: 1 0)? | waived all @ has waived all copyright and related or neighboring rights
cc-by | creative commons attribution | creative commons attribution(?: (?:1|2|3|4) [05])?(?: international| unported)?(?: licen[sc]e)? | cc by [1234] [05] | licenses by @ creativecommons org licenses by [1234] [05] | cc by @ licen[sc]ed under (?:a )?cc by [1234] [05]
cc-by-sa | attribution share | creative commons attribution share ?alike(?: [1234] [05])?(?: international| unported)?(?: licen[sc]e)? | cc by sa [1234] [05] | licenses by @ creativecommons org licenses by sa [1234] [05] | cc by sa @ licen[sc]ed under (?:a )?cc by sa [1234] [05]
cc-by-nc | attribution non | creative commons attribution non ?commercial(?: [1234] [05])?(?: international| unported)?(?: licen[sc]e)? | cc by nc [1234] [05] | licenses by @ creativecommons org licenses by nc [1234] [05] | cc by nc @ licen[sc]ed under (?:a )?cc by nc [1234] [05]
cc-by-nd | attribution no | creative commons attribution no ?deriv(?:s|atives)(?: [1234] [05])?(?: international| unported)?(?: licen[sc]e)? | cc by nd [1234] [05] | licenses by @ creativecommons org licenses by nd [1234] [05] | cc by nd @ licen[sc]ed under (?:a )?cc by nd [1234] [05]
cc-by-nc-sa | attribution non | creative commons attribution non ?commercial share ?alike(?: [1234] [05])?(?: international| unported)?(?: licen[sc]e)? | cc by nc sa [1234] [05] | licenses by @ creativecommons org licenses by nc sa [1234] [05] | cc by nc sa @ licen[sc]ed under (?:a )?cc by nc sa [1234] [05]
cc-by-nc-nd | attribution non | creative commons attribution non ?commercial no ?deriv(?:s|atives)(?: [1234] [05])?(?: international| unported)?(?: licen[sc]e)? | cc by nc nd [1234] [05] | licenses by @ creativecommons org licenses by nc nd [1234] [05] | cc by nc nd @ licen[sc]ed under (?:a )?cc by nc nd [1234] [05]
odbl | database licen | open (?:data commons )?(?:open )?database licen[sc]e(?: odbl)? | odbl 1 0 | licenses odbl @ opendatacommons org licenses odbl | open database @ made available under the open database licen[sc]e
odc-by | data commons attribution | open data commons attribution licen[sc]e | odc by 1 0 | licenses by @ opendatacommons org licenses by | data commons attribution @ made available under the open data commons attribution licen[sc]e
pddl | public domain dedication | public domain dedication and licen[sc]e | pddl 1 0 | licenses pddl @ opendatacommons org licenses pddl | public domain dedication @ made available under the public domain dedication and licen[sc]e
ofl | open font | (?:sil )?open font licen[sc]e(?: version)?(?: 1 [01])? | ofl 1 [01] | ofl @ scripts sil org ofl .{0,20}licen[sc]e | open font @ this font software is licensed under the sil open font licen[sc]e
python | python software foundation | python software foundation licen[sc]e(?: version)?(?: 2)? | (?:psf|python) 2 0 | psf license @ docs python org .{0,20}psf license | python software foundation @ this license agreement is between the python software foundation
php | php licen | php licen[sc]e(?: version)?(?: 3 0[1]?)? | php 3 0[1]? | license 3 @ php net license 3 01 | php @ this product includes php software freely available from .{0,40}php licen[sc]e
ruby | ruby | ruby(?: s)? licen[sc]e | ruby | ruby @ ruby lang org .{0,20}licen[sc]e | ruby @ redistribute it and or modify it under the same terms as ruby .{0,40}licen[sc]e
postgresql | postgresql licen | postgresql licen[sc]e | postgresql | postgresql @ postgresql org about licen[sc]e | permission to @ permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement
openssl | openssl licen | openssl licen[sc]e | openssl | openssl @ openssl org source licen[sc]e | openssl @ this product includes software developed by the openssl project .{0,80}licen[sc]e
ncsa | ncsa | (?:university of illinois )?(?:ncsa )?(?:illinois )?ncsa open source licen[sc]e | ncsa | licenses ncsa @ opensource org licenses ncsa | ncsa @ developed by .{1,60}ncsa open source licen[sc]e
ms-pl | microsoft public | microsoft public licen[sc]e(?: ms pl)? | ms pl | licenses ms @ opensource org licenses ms pl | microsoft public @ this license governs use of the accompanying software .{0,120}microsoft public licen[sc]e
ms-rl | microsoft reciprocal | microsoft reciprocal licen[sc]e(?: ms rl)? | ms rl | licenses ms @ opensource org licenses ms rl | microsoft reciprocal @ governed by the microsoft reciprocal licen[sc]e
osl-3.0 | open software licen | open software licen[sc]e(?: version| v)?(?: [123] [01])? | osl [123] [01] | licenses osl @ opensource org licenses osl 3 0 | open software licen @ licensed under the open software licen[sc]e
afl-3.0 | academic free | academic free licen[sc]e(?: version| v)?(?: [123] [01])? | afl [123] [012] | licenses afl @ opensource org licenses afl 3 0 | academic free @ licensed under the academic free licen[sc]e
ecl-2.0 | educational community | educational community licen[sc]e(?: version)?(?: [12] 0)? | ecl [12] 0 | licenses ecl @ opensource org licenses ecl 2 0 | educational community @ licensed under the educational community licen[sc]e
upl-1.0 | universal permissive | universal permissive licen[sc]e(?: version| v)?(?: 1 0)? | upl 1 0 | licenses upl @ (?:opensource org|oss oracle com) licenses upl | universal permissive @ licensed under the universal permissive licen[sc]e
qpl | q public | q public licen[sc]e(?: version)?(?: 1 0)? | qpl 1 0 | licenses qpl @ opensource org licenses qpl 1 0 | q public @ terms of the q public licen[sc]e
sleepycat | sleepycat | sleepycat(?: public)? licen[sc]e | sleepycat | licenses sleepycat @ opensource org licenses sleepycat | redistributions in @ redistributions in any form must be accompanied by information on how to obtain complete source code .{0,120}licen[sc]e
w3c | w3c | w3c software (?:notice and )?(?:document )?licen[sc]e | w3c(?: 20150513)? | copyright software @ w3 org consortium legal .{0,20}copyright software | w3c @ under the w3c software licen[sc]e
unicode | unicode licen | unicode licen[sc]e(?: agreement)?(?: v3)? | unicode (?:dfs 2016|3 0) | unicode @ unicode org .{0,20}(?:copyright|licen[sc]e) | unicode @ permission is hereby granted .{0,60}unicode data files
curl | curl licen | curl licen[sc]e | curl | curl @ curl se docs copyright | daniel stenberg @ copyright .{0,30}daniel stenberg
x11 | x11 licen | x11 licen[sc]e | x11 | xfree86 @ xfree86 org .{0,10}licen[sc]e | x consortium @ name of the x consortium shall not be used .{0,120}permission
hpnd | historical permission | historical permission notice and disclaimer | hpnd | licenses hpnd @ opensource org licenses hpnd | permission to @ permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted
vim | vim licen | vim licen[sc]e | vim | vim @ vimdoc sourceforge net .{0,30}licen[sc]e | vim @ distributed under the vim licen[sc]e
cecill | cecill | cecill(?: [abc])?(?: free software)? licen[sc]e(?: agreement)? | cecill [12] [01] | cecill @ cecill info .{0,10}licen[sc]es? | cecill @ governed by the cecill(?: [abc])? licen[sc]e
sspl | server side public | server side public licen[sc]e(?: version| v)?(?: 1)? | sspl 1 0 | mongodb @ mongodb com licensing server side public licen[sc]e | server side public @ terms of the server side public licen[sc]e
busl-1.1 | business source | business source licen[sc]e(?: version)?(?: 1 1)? | busl 1 1 | bsl11 @ mariadb com bsl11 .{0,10}licen[sc]e | business source @ licensor .{0,80}business source licen[sc]e
elastic-2.0 | elastic licen | elastic licen[sc]e(?: version)?(?: 2 0)? | elastic 2 0 | elastic @ elastic co licensing elastic licen[sc]e | elastic @ subject to the elastic licen[sc]e
openrail | rail | (?:creativeml )?(?:bigscience )?(?:open )?(?:rail|openrail)(?: m)? licen[sc]e | openrail(?: m)? | rail @ licenses ai .{0,20}rail licen[sc]e | use based restrictions @ use based restrictions .{0,80}licen[sc]e
llama | community licen | llama(?: [234])?(?: 1)? community licen[sc]e(?: agreement)? | llama [23](?: 1)? | llama @ ai meta com llama licen[sc]e | community licen @ licensed under the llama .{0,10}community licen[sc]e
proprietary | all rights reserved | copyright .{0,60}all rights reserved | licenseref proprietary | licenseref @ licenseref proprietary .{0,10}licen[sc]e | prior written @ may not be reproduced .{0,80}without (?:the )?prior written permission
"""

#: What a kind of signature weighs, and its priority.
KINDS = (("name", 2, 0.9), ("spdx", 3, 0.95), ("url", 3, 0.95), ("text", 4, 1.0))


def _spaced(text: str) -> str:
    """Words stand in the scanned form with a space of their own on either side."""
    return " " + text.replace(" ?", "(?:  )?").replace(" ", "  ").replace("(?:    )?", "(?:  )?") + " "


def rules() -> list[tuple[int, str, str, str, int, float]]:
    """(number, label, keyword, regex, priority, weight), in the order of the table."""
    out = []
    for line in LICENSES.strip().splitlines():
        label, keyword, *signatures = (x.strip() for x in line.split(" | "))
        for (kind, priority, weight), signature in zip(KINDS, signatures, strict=False):
            own, at, regex = signature.rpartition(" @ ")
            regex = regex.strip(" |")
            if not regex:
                continue
            word = own.strip() if at else "spdx license identifier" if kind == "spdx" else keyword
            full = f"spdx license identifier {regex}" if kind == "spdx" else regex
            out.append((len(out), label, word.replace(" ", "  "), _spaced(full), priority, weight))
            if kind == "name":
                under = f"(?:licen[sc]ed|released|distributed|available|published) under (?:the terms of )?(?:the |an? )?{regex}"
                out.append((len(out), label, word.replace(" ", "  "), _spaced(under), 3, 0.95))
    return out
