"""Hand-written licence signatures over normalised text.

The text is a stream of lower-case words with one space between them, so a
signature never sees punctuation or line breaks.  Each line reads

    kind  label  keyword  pattern

``keyword`` is a word that every text with a match of ``pattern`` contains, or
several with commas of which it contains one: a text without skips the pattern.  The kinds, from the strongest evidence to the weakest,
are ``tag`` (a machine-readable identifier), ``notice`` (a grant that names the
licence), ``body`` (wording of the licence itself), ``link`` (its address) and
``name`` (a mention).
"""

#: The phrases and labels that every scan reports.
BASE_PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

KINDS = {"tag": (5, 0.99), "notice": (4, 0.95), "body": (3, 0.9), "link": (2, 0.85), "name": (1, 0.6)}

SIGNATURES = r"""
tag    mit            spdx      spdx license identifier mit\b(?! 0)
tag    mit-0          spdx      spdx license identifier mit 0\b
notice mit            mit       (?:released|distributed|licensed|available|provided|published) under the (?:terms of the )?mit licen[cs]e
notice mit            mit       (?:licensed|released) under (?:the )?mit\b
body   mit            charge    permission is hereby granted free of charge to any person obtaining a copy of this software
body   mit            noninfringement  fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders
link   mit            opensource opensource org licenses? mit\b
name   mit            mit       \bmit (?:style |x11 )?licen[cs]ed?\b
name   mit            expat     \bexpat licen[cs]e\b
name   x11            x11       \bx11 licen[cs]e\b
tag    apache-2       spdx      spdx license identifier apache 2 0\b
notice apache-2       apache    (?:licensed|released|distributed|available) under the (?:terms of the )?apache (?:software )?licen[cs]e (?:version )?2(?: 0)?\b
notice apache-2       compliance you may not use this file except in compliance with the license
body   apache-2       january        apache license version 2 0 january 2004 .{0,80}?terms and conditions for use reproduction and distribution
body   apache-2       contributor each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license
link   apache-2       apache    (?:www )?apache org licenses license 2 0\b
name   apache-2       apache    \bapache (?:software )?(?:licen[cs]e )?(?:v|version )?2(?: 0)?\b
name   apache-2       asl2      \basl2\b
tag    apache-1.1     spdx      spdx license identifier apache 1 1\b
body   apache-1.1     apache    apache software license version 1 1\b
name   apache-1.1     apache    \bapache licen[cs]e (?:version )?1 1\b
name   apache-1.0     apache    \bapache (?:software )?licen[cs]e (?:version )?1(?: 0)?\b
name   apache         apache    \bapache (?:software )?licen[cs]e\b
tag    gpl-2          spdx      spdx license identifier gpl 2 0(?: only)?\b
tag    gpl-2-or-later spdx      spdx license identifier gpl 2 0 or later\b
tag    gpl-3          spdx      spdx license identifier gpl 3 0(?: only)?\b
tag    gpl-3-or-later spdx      spdx license identifier gpl 3 0 or later\b
notice gpl-2-or-later gnu       under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or (?:at your option )?any later version
notice gpl-3-or-later gnu       under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
notice gpl-2          gnu       under the terms of the gnu general public license version 2 (?:only )?as published by
notice gpl-2          gpl,gpl2,gplv2 (?:licensed|released|distributed) under (?:the )?(?:gnu )?gpl ?v?2\b
notice gpl-3          gpl,gpl3,gplv3 (?:licensed|released|distributed) under (?:the )?(?:gnu )?gpl ?v?3\b
body   gpl-2          gnu       gnu general public license version 2 june 1991
body   gpl-3          gnu       gnu general public license version 3 29 june 2007
body   gpl            freedom   the licenses for most software are designed to take away your freedom to share and change it
link   gpl-2          gnu       gnu org licenses (?:old licenses )?gpl 2 0\b
link   gpl-3          gnu       gnu org licenses gpl 3 0\b
link   gpl            gnu       gnu org licenses gpl\b
name   gpl-2          gpl,gpl2,gplv2,gplversion,gplersion \bgpl ?v?(?:ersion )?2\b
name   gpl-3          gpl,gpl3,gplv3,gplversion,gplersion \bgpl ?v?(?:ersion )?3\b
name   gpl-2          gplv2     \bgplv2\b
name   gpl-3          gplv3     \bgplv3\b
name   gpl            gnu       \bgnu general public licen[cs]e\b
tag    lgpl-2.1       spdx      spdx license identifier lgpl 2 1(?: only)?\b
tag    lgpl-2.1-or-later spdx   spdx license identifier lgpl 2 1 or later\b
tag    lgpl-3         spdx      spdx license identifier lgpl 3 0(?: only)?\b
tag    lgpl-3-or-later spdx     spdx license identifier lgpl 3 0 or later\b
notice lgpl-2.1-or-later gnu    gnu lesser general public license as published by the free software foundation either version 2 1 of the license or
notice lgpl-3-or-later gnu      gnu lesser general public license as published by the free software foundation either version 3 of the license or
body   lgpl-2.1       gnu       gnu lesser general public license version 2 1 february 1999
body   lgpl-3         gnu       gnu lesser general public license version 3 29 june 2007
body   lgpl-2         gnu       gnu library general public license version 2 june 1991
link   lgpl-2.1       gnu       gnu org licenses (?:old licenses )?lgpl 2 1\b
link   lgpl           gnu       gnu org licenses lgpl\b
name   lgpl-2.1       lgpl,lgpl2,lgplv2 \blgpl ?v?2 1\b
name   lgpl-3         lgpl,lgpl3,lgplv3 \blgpl ?v?3\b
name   lgpl-3         lgplv3    \blgplv3\b
name   lgpl           gnu       \bgnu (?:lesser|library) general public licen[cs]e\b
tag    agpl-3         spdx      spdx license identifier agpl 3 0(?: only| or later)?\b
notice agpl-3         affero    gnu affero general public license as published by the free software foundation
body   agpl-3         affero    gnu affero general public license version 3 19 november 2007
link   agpl-3         gnu       gnu org licenses agpl\b
name   agpl-3         agpl,agplv,agpl3,agplv3 \bagpl ?v?3?\b
name   agpl-3         agplv3    \bagplv3\b
name   agpl-3         affero    \baffero general public licen[cs]e\b
tag    gfdl           spdx      spdx license identifier gfdl 1 [123]\b
notice gfdl           documentation copy distribute and or modify this document under the terms of the gnu free documentation license
body   gfdl           documentation gnu free documentation license version 1 [123]
link   gfdl           gnu       gnu org licenses fdl\b
name   gfdl           documentation \bgnu free documentation licen[cs]e\b
name   gfdl           gfdl      \bgfdl\b
tag    bsd-2          spdx      spdx license identifier bsd 2 clause\b
tag    bsd-3          spdx      spdx license identifier bsd 3 clause\b
tag    bsd-4          spdx      spdx license identifier bsd 4 clause\b
tag    0bsd           spdx      spdx license identifier 0bsd\b
notice bsd            bsd       (?:licensed|released|distributed) under (?:the )?(?:terms of the )?(?:modified |simplified |new )?bsd\b
notice bsd-3          bsd       use of this source code is governed by a bsd style license
body   bsd            redistribution redistribution and use in source and binary forms with or without modification are permitted
body   bsd-3          endorse   neither the name .{1,120}? nor the names of its contributors may be used to endorse or promote products
body   bsd-4          advertising all advertising materials mentioning features or use of this software must display the following acknowledge?ment
body   0bsd           fee       permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted(?! provided)
link   bsd-2          opensource opensource org licenses? bsd 2 clause\b
link   bsd-3          opensource opensource org licenses? bsd 3 clause\b
link   bsd            opensource opensource org licenses bsd license\b
name   bsd-2          bsd,freebsd \b(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd licen[cs]e)\b
name   bsd-3          bsd       \b(?:bsd 3 clause|3 clause bsd|modified bsd|new bsd)\b
name   bsd-4          bsd       \b(?:bsd 4 clause|4 clause bsd|original bsd)\b
name   bsd            bsd       \bbsd (?:style )?licen[cs]ed?\b
name   0bsd           0bsd      \b0bsd\b
tag    isc            spdx      spdx license identifier isc\b
notice isc            isc       (?:licensed|released|distributed) under the (?:terms of the )?isc licen[cs]e
body   isc            fee       permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted provided that
link   isc            opensource opensource org licenses? isc\b
name   isc            isc       \bisc licen[cs]ed?\b
tag    mpl-2          spdx      spdx license identifier mpl 2 0\b
tag    mpl-1.1        spdx      spdx license identifier mpl 1 1\b
notice mpl-2          mozilla   this source code form is subject to the terms of the mozilla public license v 2 0
notice mpl-1.1        mozilla   the contents of this file are subject to the mozilla public license version 1 1
body   mpl-2          mozilla   mozilla public license version 2 0\b
body   mpl-1.1        mozilla   mozilla public license version 1 1\b
link   mpl-2          mozilla   mozilla org mpl 2 0\b
link   mpl            mozilla   mozilla org mpl\b
name   mpl-2          mpl,mpl2,mplv2 \bmpl ?v?2(?: 0)?\b
name   mpl-1.1        mpl,mpl1,mplv1 \bmpl ?v?1 1\b
name   mpl            mozilla   \bmozilla public licen[cs]e\b
tag    epl-1          spdx      spdx license identifier epl 1 0\b
tag    epl-2          spdx      spdx license identifier epl 2 0\b
notice epl-1          eclipse   made available under the terms of the eclipse public license v1? ?1 0
notice epl-2          eclipse   made available under the terms of the eclipse public license v? ?2 0
body   epl-1          eclipse   eclipse public license v 1 0\b
body   epl-2          eclipse   eclipse public license v 2 0\b
link   epl            eclipse   eclipse org legal epl v(?:10|20)\b
name   epl-1          epl       \bepl 1 0\b
name   epl-2          epl       \bepl 2 0\b
name   epl            eclipse   \beclipse public licen[cs]e\b
tag    edl-1          spdx      spdx license identifier edl 1 0\b
name   edl-1          eclipse   \beclipse distribution licen[cs]e\b
tag    cddl-1.0       spdx      spdx license identifier cddl 1 0\b
tag    cddl-1.1       spdx      spdx license identifier cddl 1 1\b
notice cddl           development subject to the terms of the common development and distribution license .{0,30}?cddl
body   cddl           development common development and distribution license cddl version 1 [01]
name   cddl           development \bcommon development and distribution licen[cs]e\b
name   cddl           cddl      \bcddl\b
tag    cpl-1          spdx      spdx license identifier cpl 1 0\b
name   cpl-1          common    \bcommon public licen[cs]e (?:version )?1 0\b
tag    ipl-1          spdx      spdx license identifier ipl 1 0\b
name   ipl-1          ibm       \bibm public licen[cs]e\b
tag    eupl-1.1       spdx      spdx license identifier eupl 1 1\b
tag    eupl-1.2       spdx      spdx license identifier eupl 1 2\b
notice eupl-1.2       eupl      licensed under the eupl (?:version )?1 2\b
notice eupl-1.1       eupl      licensed under the eupl (?:version )?1 1\b
name   eupl           european  \beuropean union public licen[cs]e\b
name   eupl           eupl      \beupl\b
tag    unlicense      spdx      spdx license identifier unlicense\b
body   unlicense      unencumbered this is free and unencumbered software released into the public domain
link   unlicense      unlicense \bunlicense org\b
name   unlicense      unlicense \bthe unlicense\b
tag    cc0-1.0        spdx      spdx license identifier cc0 1 0\b
notice cc0-1.0        cc0       (?:released|dedicated|licensed) (?:under|to|into) (?:the )?(?:public domain )?(?:under |via |using )?cc0\b
body   cc0-1.0        affirmer  affirmer hereby overtly fully permanently irrevocably and unconditionally waives
link   cc0-1.0        creativecommons creativecommons org publicdomain zero 1 0\b
name   cc0-1.0        cc0       \bcc0(?: 1 0)?(?: universal)?\b
notice public-domain  public    (?:released|placed|dedicated) (?:into|in|to) the public domain
link   public-domain  creativecommons creativecommons org publicdomain mark 1 0\b
name   public-domain  domain    \bpublic domain (?:work|dedication|mark)\b
tag    wtfpl          spdx      spdx license identifier wtfpl\b
body   wtfpl          fuck      do what the fuck you want to public licen[cs]e
link   wtfpl          wtfpl     \bwtfpl net\b
name   wtfpl          wtfpl     \bwtfpl\b
tag    zlib           spdx      spdx license identifier zlib\b
body   zlib           misrepresented the origin of this software must not be misrepresented you must not claim that you wrote the original software
link   zlib           zlib      \bzlib net zlib license\b
name   zlib           zlib      \bzlib(?: libpng)? licen[cs]e\b
name   libpng         libpng    \blibpng licen[cs]e\b
tag    bsl-1.0        spdx      spdx license identifier bsl 1 0\b
notice bsl-1.0        boost     distributed under the boost software license version 1 0
body   bsl-1.0        boost     boost software license version 1 0 august 17th 2003
link   bsl-1.0        boost     boost org license 1 0\b
name   bsl-1.0        boost     \bboost software licen[cs]e\b
tag    busl-1.1       spdx      spdx license identifier busl 1 1\b
body   busl-1.1       business  business source license 1 1\b
name   busl           business  \bbusiness source licen[cs]e\b
tag    sspl-1         spdx      spdx license identifier sspl 1 0\b
body   sspl-1         server    server side public license version 1
name   sspl-1         sspl      \bsspl\b
tag    elastic-2      spdx      spdx license identifier elastic 2 0\b
notice elastic-2      elastic   licensed under the elastic license 2 0\b
name   elastic-2      elastic   \belastic licen[cs]e (?:v)?2(?: 0)?\b
tag    polyform-nc    spdx      spdx license identifier polyform noncommercial 1 0 0\b
name   polyform-nc    polyform  \bpolyform noncommercial licen[cs]e\b
name   polyform       polyform  \bpolyform (?:shield|strict|small business|perimeter) licen[cs]e\b
tag    artistic-1     spdx      spdx license identifier artistic 1 0\b
tag    artistic-2     spdx      spdx license identifier artistic 2 0\b
body   artistic-2     artistic  artistic license 2 0 copyright c 2000 2006
name   artistic-2     artistic  \bartistic licen[cs]e (?:version )?2(?: 0)?\b
name   artistic       artistic  \bartistic licen[cs]e\b
notice perl           perl      free software you (?:can|may) redistribute it and or modify it under the same terms as perl itself
tag    psf-2          spdx      spdx license identifier (?:psf|python) 2 0\b
body   psf-2          python    python software foundation license version 2\b
name   psf-2          python    \bpython software foundation licen[cs]e\b
name   psf-2          psf       \bpsf licen[cs]e\b
tag    php-3.01       spdx      spdx license identifier php 3 01\b
body   php-3.01       php       the php license version 3 01\b
name   php            php       \bphp licen[cs]e\b
name   ruby           ruby      \bruby licen[cs]e\b
notice ruby           ruby      redistribute it and or modify it under the same terms as ruby\b
tag    openssl        spdx      spdx license identifier openssl\b
body   openssl        openssl   this product includes software developed by the openssl project
name   openssl        openssl   \bopenssl licen[cs]e\b
tag    postgresql     spdx      spdx license identifier postgresql\b
name   postgresql     postgresql \bpostgresql licen[cs]e\b
tag    ncsa           spdx      spdx license identifier ncsa\b
name   ncsa           ncsa      \b(?:university of illinois )?ncsa open source licen[cs]e\b
tag    w3c            spdx      spdx license identifier w3c\b
name   w3c            w3c       \bw3c software (?:notice and )?licen[cs]e\b
tag    unicode        spdx      spdx license identifier unicode (?:dfs 2016|3 0)\b
name   unicode        unicode   \bunicode licen[cs]e (?:agreement|v3)\b
tag    curl           spdx      spdx license identifier curl\b
name   curl           curl      \bcurl licen[cs]e\b
tag    icu            spdx      spdx license identifier icu\b
name   icu            icu       \bicu licen[cs]e\b
tag    ms-pl          spdx      spdx license identifier ms pl\b
body   ms-pl          microsoft microsoft public license ms pl\b
name   ms-pl          microsoft \bmicrosoft public licen[cs]e\b
tag    ms-rl          spdx      spdx license identifier ms rl\b
name   ms-rl          microsoft \bmicrosoft reciprocal licen[cs]e\b
tag    osl-3          spdx      spdx license identifier osl 3 0\b
name   osl-3          open      \bopen software licen[cs]e (?:v |version )?3 0\b
tag    afl-3          spdx      spdx license identifier afl 3 0\b
name   afl-3          academic  \bacademic free licen[cs]e\b
tag    ecl-2          spdx      spdx license identifier ecl 2 0\b
name   ecl-2          educational \beducational community licen[cs]e\b
tag    upl-1          spdx      spdx license identifier upl 1 0\b
name   upl-1          universal \buniversal permissive licen[cs]e\b
tag    blueoak-1      spdx      spdx license identifier blueoak 1 0 0\b
name   blueoak-1      oak       \bblue oak model licen[cs]e\b
tag    vim            spdx      spdx license identifier vim\b
name   vim            vim       \bvim licen[cs]e\b
tag    ofl-1.1        spdx      spdx license identifier ofl 1 1\b
notice ofl-1.1        font      this font software is licensed under the sil open font license
body   ofl-1.1        font      sil open font license version 1 1\b
link   ofl-1.1        sil       scripts sil org ofl\b
name   ofl-1.1        font      \bopen font licen[cs]e\b
tag    odbl-1         spdx      spdx license identifier odbl 1 0\b
link   odbl-1         opendatacommons opendatacommons org licenses odbl\b
name   odbl-1         odbl      \bodbl\b
name   odbl-1         database  \bopen database licen[cs]e\b
link   odc-by         opendatacommons opendatacommons org licenses by\b
name   odc-by         attribution \bopen data commons attribution licen[cs]e\b
link   pddl           opendatacommons opendatacommons org licenses pddl\b
name   cdla-permissive community \bcommunity data licen[cs]e agreement permissive\b
name   cdla-sharing   community \bcommunity data licen[cs]e agreement sharing\b
tag    cc-by-4        spdx      spdx license identifier cc by 4 0\b
tag    cc-by-3        spdx      spdx license identifier cc by 3 0\b
tag    cc-by-sa-4     spdx      spdx license identifier cc by sa 4 0\b
tag    cc-by-sa-3     spdx      spdx license identifier cc by sa 3 0\b
tag    cc-by-nc-4     spdx      spdx license identifier cc by nc 4 0\b
tag    cc-by-nd-4     spdx      spdx license identifier cc by nd 4 0\b
tag    cc-by-nc-sa-4  spdx      spdx license identifier cc by nc sa 4 0\b
tag    cc-by-nc-nd-4  spdx      spdx license identifier cc by nc nd 4 0\b
notice cc-by          creative  licensed under (?:a |the )?creative commons attribution (?:[1-4] 0 )?(?:international |unported |generic )?licen[cs]e
notice cc-by-sa       creative  licensed under (?:a |the )?creative commons attribution share ?alike
notice cc-by-nc       creative  licensed under (?:a |the )?creative commons attribution non ?commercial(?! (?:share|no))
notice cc-by-nd       creative  licensed under (?:a |the )?creative commons attribution no ?deriv(?:ative)?s?
notice cc-by-nc-sa    creative  licensed under (?:a |the )?creative commons attribution non ?commercial share ?alike
notice cc-by-nc-nd    creative  licensed under (?:a |the )?creative commons attribution non ?commercial no ?deriv(?:ative)?s?
body   cc-by          creative  creative commons attribution 4 0 international public license
body   cc-by-sa       creative  creative commons attribution sharealike 4 0 international public license
body   cc-by-nc       creative  creative commons attribution noncommercial 4 0 international public license
link   cc-by          creativecommons creativecommons org licenses by [1-4] [05]\b
link   cc-by-sa       creativecommons creativecommons org licenses by sa [1-4] [05]\b
link   cc-by-nc       creativecommons creativecommons org licenses by nc [1-4] [05]\b
link   cc-by-nd       creativecommons creativecommons org licenses by nd [1-4] [05]\b
link   cc-by-nc-sa    creativecommons creativecommons org licenses by nc sa [1-4] [05]\b
link   cc-by-nc-nd    creativecommons creativecommons org licenses by nc nd [1-4] [05]\b
name   cc-by-nc-sa    cc        \bcc by nc sa(?: [1-4] [05])?\b
name   cc-by-nc-nd    cc        \bcc by nc nd(?: [1-4] [05])?\b
name   cc-by-nc       cc        \bcc by nc(?: [1-4] [05])?\b(?! (?:sa|nd)\b)
name   cc-by-sa       cc        \bcc by sa(?: [1-4] [05])?\b
name   cc-by-nd       cc        \bcc by nd(?: [1-4] [05])?\b
name   cc-by          cc        \bcc by(?: [1-4] [05])?\b(?! (?:sa|nd|nc)\b)
name   cc             creative  \bcreative commons\b
notice proprietary    rights    all rights reserved (?:this|no part|unauthori[sz]ed)
notice proprietary    proprietary,confidential (?:proprietary and confidential|confidential and proprietary)
notice proprietary    written    (?:no part of this|may not be reproduced) .{0,80}?without (?:the )?(?:prior )?written permission
name   proprietary    reserved  \ball rights reserved\b
notice commercial     commercial (?:requires?|under) a (?:separate )?commercial licen[cs]e
tag    openrail       spdx      spdx license identifier (?:open|creativeml open|bigscience open)rail(?: m)?\b
name   openrail       openrail  \b(?:creativeml |bigscience )?openrail(?: m)?\b
name   llama-community llama    \bllama (?:2|3|3 1) community licen[cs]e\b
name   json           json      \bjson licen[cs]e\b
body   json           good      the software shall be used for good not evil
name   beerware       beerware  \bbeerware\b
body   beerware       meet      if we meet some day and you think this stuff is worth it you can buy me a beer
"""


def signatures() -> list[tuple[int, str, str, str, str]]:
    """(order, kind, label, keyword, pattern), in the order of the list above."""
    rows = [line.split(None, 3) for line in SIGNATURES.strip().splitlines()]
    return [(i, *row) for i, row in enumerate(rows)]
