"""License detection rules (written by hand; fixed values).

One rule a line: label | priority | weight | keyword | pattern. Priority 1 is
the most specific. A pattern is a regular expression over the normalised
text: lower-case words of letters and digits with one space between, whole
words only; groups keep their spaces inside. The keyword is a plain string
that every match contains; a rule runs only on texts that hold it.
"""

from __future__ import annotations

RULES_TEXT = """
agpl-3.0 | 1 | 1.0 | affero | gnu affero general public license (?:as published by the free software foundation )?(?:either )?(?:version |v )3(?: 0)?
agpl-3.0 | 1 | 1.0 | affero | gnu affero general public license v3(?: 0)?
agpl-1.0 | 1 | 1.0 | affero | affero general public license version 1(?: 0)?
agpl | 2 | 0.9 | affero | (?:gnu )?affero general public license
agpl | 3 | 0.8 | agpl | (?:gnu )?agpl
agpl-3.0 | 2 | 0.9 | agpl | agpl (?:version |v )?3(?: 0)?
agpl-3.0 | 2 | 0.9 | agplv3 | agplv3(?: 0)?
lgpl-2.1 | 1 | 1.0 | lesser general | gnu lesser general public license (?:as published by the free software foundation )?(?:either )?(?:version |v )2 1
lgpl-3.0 | 1 | 1.0 | lesser general | gnu lesser general public license (?:as published by the free software foundation )?(?:either )?(?:version |v )3(?: 0)?
lgpl-2.0 | 1 | 1.0 | library general | gnu library general public license (?:version |v )2(?: 0)?
lgpl | 2 | 0.9 | lesser general | (?:gnu )?lesser general public license
lgpl | 2 | 0.9 | library general | (?:gnu )?library general public license
lgpl | 3 | 0.8 | lgpl | (?:gnu )?lgpl
lgpl-2.1 | 2 | 0.9 | lgpl | lgpl (?:version |v )?2 1
lgpl-3.0 | 2 | 0.9 | lgpl | lgpl (?:version |v )?3(?: 0)?
lgpl-2.1 | 2 | 0.9 | lgplv2 | lgplv2 1
lgpl-3.0 | 2 | 0.9 | lgplv3 | lgplv3(?: 0)?
gpl-2.0-or-later | 1 | 1.0 | general public license | gnu general public license (?:as published by the free software foundation )?either version 2 (?:of the license )?or at your option any later version
gpl-3.0-or-later | 1 | 1.0 | general public license | gnu general public license (?:as published by the free software foundation )?either version 3 (?:of the license )?or at your option any later version
gpl-2.0-only | 1 | 1.0 | general public license | gnu general public license version 2 only
gpl-3.0-only | 1 | 1.0 | general public license | gnu general public license version 3 only
gpl-1.0 | 1 | 1.0 | general public license | gnu general public license (?:version |v )1(?: 0)?
gpl-2.0 | 1 | 1.0 | general public license | gnu general public license (?:version |v )2(?: 0)?
gpl-3.0 | 1 | 1.0 | general public license | gnu general public license (?:version |v )3(?: 0)?
gpl-2.0 | 1 | 1.0 | general public license v2 | gnu general public license v2(?: 0)?
gpl-3.0 | 1 | 1.0 | general public license v3 | gnu general public license v3(?: 0)?
gpl | 2 | 0.9 | general public license | gnu general public license
gpl | 3 | 0.8 | gnu gpl | gnu gpl
gpl-2.0 | 2 | 0.9 | gnu gpl | gnu gpl (?:version |v )?2(?: 0)?
gpl-3.0 | 2 | 0.9 | gnu gpl | gnu gpl (?:version |v )?3(?: 0)?
gpl-2.0 | 2 | 0.9 | gpl v2 | gpl v2(?: 0)?
gpl-3.0 | 2 | 0.9 | gpl v3 | gpl v3(?: 0)?
gpl-2.0 | 2 | 0.9 | gplv2 | gplv2(?: 0)?
gpl-3.0 | 2 | 0.9 | gplv3 | gplv3(?: 0)?
gpl | 4 | 0.5 | gpl | gpl license
gpl | 4 | 0.5 | gpl | (?:under|licensed under) (?:the )?gpl
gfdl-1.1 | 1 | 1.0 | free documentation | gnu free documentation license version 1 1
gfdl-1.2 | 1 | 1.0 | free documentation | gnu free documentation license version 1 2
gfdl-1.3 | 1 | 1.0 | free documentation | gnu free documentation license version 1 3
gfdl | 2 | 0.9 | free documentation | gnu free documentation license
gfdl | 3 | 0.8 | gfdl | gfdl
apache-1.0 | 1 | 1.0 | apache | apache license (?:version )?1 0
apache-1.1 | 1 | 1.0 | apache | apache (?:software )?license (?:version )?1 1
apache-2.0 | 1 | 1.0 | apache | licensed under the apache license version 2 0
apache-2.0 | 1 | 1.0 | apache | apache license (?:version |v )?2(?: 0)?
apache-2.0 | 1 | 1.0 | apache | apache (?:software )?license (?:version |v )2(?: 0)?
apache-2.0 | 2 | 0.9 | apache 2 | apache 2 0(?: license)?
apache-2.0 | 2 | 0.9 | apache org licenses | apache org licenses license 2 0
apache | 3 | 0.8 | apache | apache (?:software )?license
mit | 1 | 1.0 | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | 1 | 1.0 | mit license | (?:released|licensed|distributed|available|published) under (?:the )?(?:terms of the )?mit license
mit | 2 | 0.9 | mit license | (?:the )?mit license
mit | 3 | 0.8 | under mit | (?:licensed|released) under mit
mit | 3 | 0.8 | expat license | (?:the )?expat license
mit-0 | 1 | 1.0 | mit no attribution | mit no attribution(?: license)?
x11 | 2 | 0.9 | x11 license | (?:mit )?x11 license
isc | 1 | 1.0 | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | 2 | 0.9 | isc license | (?:the )?isc license
bsd-2-clause | 1 | 1.0 | bsd | (?:simplified|freebsd) bsd license
bsd-2-clause | 1 | 1.0 | bsd 2 | bsd 2 clause(?: license)?
bsd-2-clause | 1 | 1.0 | 2 clause | 2 clause bsd(?: license)?
bsd-2-clause | 1 | 1.0 | two clause | two clause bsd(?: license)?
bsd-3-clause | 1 | 1.0 | bsd 3 | bsd 3 clause(?: license)?
bsd-3-clause | 1 | 1.0 | 3 clause | 3 clause bsd(?: license)?
bsd-3-clause | 1 | 1.0 | three clause | three clause bsd(?: license)?
bsd-3-clause | 1 | 1.0 | bsd | (?:new|modified|revised) bsd license
bsd-3-clause | 2 | 0.9 | neither the name of | neither the name of .{1,}? nor the names of its contributors may be used to endorse or promote products
bsd-4-clause | 1 | 1.0 | bsd | (?:original|old) bsd license
bsd-4-clause | 1 | 1.0 | 4 clause | 4 clause bsd(?: license)?
bsd-0-clause | 1 | 1.0 | zero clause | (?:bsd )?zero clause bsd(?: license)?
bsd | 2 | 0.8 | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted
bsd | 3 | 0.8 | bsd | bsd(?: style)? license
mpl-1.0 | 1 | 1.0 | mozilla public | mozilla public license (?:version |v )?1 0
mpl-1.1 | 1 | 1.0 | mozilla public | mozilla public license (?:version |v )?1 1
mpl-2.0 | 1 | 1.0 | mozilla public | mozilla public license (?:version |v )?2(?: 0)?
mpl | 2 | 0.9 | mozilla public | mozilla public license
mpl-2.0 | 2 | 0.9 | mpl 2 | mpl 2 0
epl-1.0 | 1 | 1.0 | eclipse public | eclipse public license (?:version |v )?1(?: 0)?
epl-2.0 | 1 | 1.0 | eclipse public | eclipse public license (?:version |v )?2(?: 0)?
epl | 2 | 0.9 | eclipse public | eclipse public license
edl-1.0 | 2 | 0.9 | eclipse distribution | eclipse distribution license(?: version| v)?(?: 1 0)?
cddl-1.0 | 1 | 1.0 | common development | common development and distribution license (?:version )?1 0
cddl-1.1 | 1 | 1.0 | common development | common development and distribution license (?:version )?1 1
cddl | 2 | 0.9 | common development | common development and distribution license
cpl-1.0 | 2 | 0.9 | common public | common public license(?: version 1 0)?
ipl-1.0 | 2 | 0.9 | ibm public | ibm public license(?: version 1 0)?
eupl-1.1 | 1 | 1.0 | european union public | european union public licen[cs]e (?:version |v )?1 1
eupl-1.2 | 1 | 1.0 | european union public | european union public licen[cs]e (?:version |v )?1 2
eupl | 2 | 0.9 | european union public | european union public licen[cs]e
artistic-1.0 | 1 | 1.0 | artistic license | artistic license (?:version )?1 0
artistic-2.0 | 1 | 1.0 | artistic license | artistic license (?:version )?2 0
artistic | 2 | 0.9 | artistic license | artistic license
bsl-1.0 | 1 | 1.0 | boost software | boost software license(?: version 1 0)?
zlib | 2 | 0.9 | zlib | zlib(?: libpng)? license
libpng | 2 | 0.9 | libpng license | libpng license
unlicense | 1 | 1.0 | unencumbered software | this is free and unencumbered software released into the public domain
unlicense | 2 | 0.9 | unlicense | (?:the )?unlicense
wtfpl | 1 | 1.0 | do what the | do what the f[a-z]* you want to public license
wtfpl | 2 | 0.9 | wtfpl | wtfpl
python-2.0 | 2 | 0.9 | python software foundation | python software foundation license(?: version 2)?
psf | 3 | 0.8 | psf license | psf license
php-3.01 | 2 | 0.9 | php license | php license(?: version 3 01)?
ruby | 3 | 0.8 | ruby license | ruby license
postgresql | 2 | 0.9 | postgresql licen | postgresql licen[cs]e
openssl | 2 | 0.9 | openssl license | openssl license
sleepycat | 2 | 0.9 | sleepycat | sleepycat license
vim | 2 | 0.9 | vim license | vim license
curl | 2 | 0.9 | curl license | curl license
ncsa | 2 | 0.9 | illinois ncsa | university of illinois ncsa open source license
ofl-1.1 | 1 | 1.0 | open font | sil open font license (?:version )?1 1
ofl | 2 | 0.9 | open font | (?:sil )?open font license
lppl-1.3c | 1 | 1.0 | project public | latex project public license version 1 3c?
lppl | 2 | 0.9 | project public | latex project public license
osl-3.0 | 2 | 0.9 | open software license | open software license(?: version)? 3 0
afl-3.0 | 2 | 0.9 | academic free | academic free license(?: version)? 3 0
afl | 3 | 0.8 | academic free | academic free license
ms-pl | 2 | 0.9 | microsoft public | microsoft public license
ms-rl | 2 | 0.9 | microsoft reciprocal | microsoft reciprocal license
cecill | 2 | 0.9 | cecill | cecill(?: free software)? license(?: agreement)?
odbl-1.0 | 1 | 1.0 | open database | (?:odc )?open database license(?: v1 0)?
odc-by-1.0 | 1 | 1.0 | open data commons attribution | open data commons attribution license
pddl-1.0 | 1 | 1.0 | public domain dedication and | public domain dedication and license
ogl-uk-3.0 | 1 | 1.0 | open government | open government licen[cs]e (?:version |v )?3 0
ogl | 2 | 0.9 | open government | open government licen[cs]e
busl-1.1 | 1 | 1.0 | business source | business source license(?: version)?(?: 1 1)?
sspl-1.0 | 1 | 1.0 | server side public | server side public license
elastic-2.0 | 1 | 1.0 | elastic license | elastic license(?: version)?(?: 2 0)?
commons-clause | 1 | 1.0 | commons clause | commons clause(?: license)?(?: condition)?
polyform | 2 | 0.9 | polyform | polyform [a-z]+(?: [a-z]+)? license
json | 3 | 0.8 | shall be used for good | the software shall be used for good not evil
cc0-1.0 | 1 | 1.0 | cc0 | (?:creative commons )?cc0(?: 1 0)?(?: universal)?
cc0-1.0 | 1 | 1.0 | public domain dedication | cc0 1 0 universal public domain dedication
cc-by-1.0 | 1 | 1.0 | cc by | cc by 1 0
cc-by-2.0 | 1 | 1.0 | cc by | cc by 2 0
cc-by-2.5 | 1 | 1.0 | cc by | cc by 2 5
cc-by-3.0 | 1 | 1.0 | cc by | cc by 3 0
cc-by-4.0 | 1 | 1.0 | cc by | cc by 4 0
cc-by-sa-2.0 | 1 | 1.0 | cc by sa | cc by sa 2 0
cc-by-sa-2.5 | 1 | 1.0 | cc by sa | cc by sa 2 5
cc-by-sa-3.0 | 1 | 1.0 | cc by sa | cc by sa 3 0
cc-by-sa-4.0 | 1 | 1.0 | cc by sa | cc by sa 4 0
cc-by-nd-3.0 | 1 | 1.0 | cc by nd | cc by nd 3 0
cc-by-nd-4.0 | 1 | 1.0 | cc by nd | cc by nd 4 0
cc-by-nc-2.0 | 1 | 1.0 | cc by nc | cc by nc 2 0
cc-by-nc-3.0 | 1 | 1.0 | cc by nc | cc by nc 3 0
cc-by-nc-4.0 | 1 | 1.0 | cc by nc | cc by nc 4 0
cc-by-nc-sa-3.0 | 1 | 1.0 | cc by nc sa | cc by nc sa 3 0
cc-by-nc-sa-4.0 | 1 | 1.0 | cc by nc sa | cc by nc sa 4 0
cc-by-nc-nd-3.0 | 1 | 1.0 | cc by nc nd | cc by nc nd 3 0
cc-by-nc-nd-4.0 | 1 | 1.0 | cc by nc nd | cc by nc nd 4 0
cc-by-nc-nd | 2 | 0.9 | cc by nc nd | cc by nc nd
cc-by-nc-sa | 2 | 0.9 | cc by nc sa | cc by nc sa
cc-by-nc | 2 | 0.9 | cc by nc | cc by nc
cc-by-nd | 2 | 0.9 | cc by nd | cc by nd
cc-by-sa | 2 | 0.9 | cc by sa | cc by sa
cc-by | 3 | 0.8 | cc by | cc by
cc-by-4.0 | 1 | 1.0 | creative commons | creative commons attribution 4 0(?: international)?(?: license)?
cc-by-3.0 | 1 | 1.0 | creative commons | creative commons attribution 3 0(?: unported)?(?: license)?
cc-by-sa-4.0 | 1 | 1.0 | creative commons | creative commons attribution share ?alike 4 0(?: international)?(?: license)?
cc-by-sa-3.0 | 1 | 1.0 | creative commons | creative commons attribution share ?alike 3 0(?: unported)?(?: license)?
cc-by-nc-4.0 | 1 | 1.0 | creative commons | creative commons attribution non ?commercial 4 0(?: international)?(?: license)?
cc-by-nc-sa-4.0 | 1 | 1.0 | creative commons | creative commons attribution non ?commercial share ?alike 4 0(?: international)?(?: license)?
cc-by-nc-nd-4.0 | 1 | 1.0 | creative commons | creative commons attribution non ?commercial no ?deriv(?:s|atives) 4 0(?: international)?(?: license)?
cc-by-sa | 2 | 0.9 | creative commons | creative commons attribution share ?alike(?: license)?
cc-by-nc | 2 | 0.9 | creative commons | creative commons attribution non ?commercial(?: license)?
cc-by-nd | 2 | 0.9 | creative commons | creative commons attribution no ?deriv(?:s|atives)(?: license)?
cc-by | 3 | 0.8 | creative commons | creative commons attribution(?: license)?
cc | 4 | 0.5 | creative commons | creative commons(?: license)?
cc-by | 2 | 0.9 | creativecommons org | creativecommons org licenses by
cc-by-sa | 2 | 0.9 | creativecommons org | creativecommons org licenses by sa
cc-by-nc | 2 | 0.9 | creativecommons org | creativecommons org licenses by nc
public-domain | 2 | 0.9 | public domain | (?:released|placed|dedicated) (?:in|into|to) the public domain
public-domain | 4 | 0.5 | public domain | public domain
all-rights-reserved | 2 | 0.9 | all rights reserved | all rights reserved
proprietary | 2 | 0.9 | proprietary and confidential | proprietary and confidential
proprietary | 2 | 0.9 | without the prior written | (?:may not be|no part of this [a-z]+ may be) reproduced .{1,}? without the prior written (?:permission|consent)
commercial | 3 | 0.8 | commercial license | commercial license
eula | 3 | 0.8 | end user licen | end user licen[cs]e agreement
copyright | 4 | 0.3 | copyright | copyright (?:c )?(?:19|20)[0-9][0-9]
"""

#: Identifiers of the SPDX list that get a rule "spdx license identifier ID".
SPDX = """0bsd afl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.1 apache-2.0 artistic-2.0 blueoak-1.0.0 bsd-2-clause
bsd-3-clause bsl-1.0 busl-1.1 cc-by-4.0 cc-by-nc-4.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0 cecill-2.1 epl-1.0 epl-2.0 eupl-1.2
gpl-2.0-only gpl-2.0-or-later gpl-3.0-only gpl-3.0-or-later isc lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0-only
lgpl-3.0-or-later mit mit-0 mpl-1.1 mpl-2.0 ms-pl mulanpsl-2.0 ncsa odbl-1.0 ofl-1.1 osl-3.0 postgresql python-2.0
unlicense upl-1.0 wtfpl zlib""".split()

#: Every match of every rule, and every base phrase, holds one of these.
STEMS = ("licen", "gpl", "public", "creative", "bsd", "apache", "cc by", "clause", "cc0", "rights reserved", "copyright", "gfdl",
         "mit no", "mpl 2", "the name of", "permission", "proprietary", "redistribution", "used for good", "under mit",
         "unencumbered", "prior written", "wtfpl")


def rules() -> list[tuple[int, str, int, float, str, str]]:
    """(number, label, priority, weight, keyword, pattern)."""
    out = []
    for line in RULES_TEXT.strip().splitlines():
        label, priority, weight, keyword, pattern = (x.strip() for x in line.split(" | "))
        out.append((len(out), label, int(priority), float(weight), keyword, pattern))
    for s in SPDX:
        words = s.replace("-", " ").replace(".", " ")
        out.append((len(out), s, 1, 1.0, "spdx license identifier", f"spdx license identifier {words}"))
    return out
