"""Signature rules of licenses: fixed values, in the order in which they win at the same place.

A line is ``kind keyword regex``. Regexes see a text's words in lower case with one space between them; a
space in a regex is the step to the next word. The rule is tried on texts that hold its keyword.
Kinds, from the surest on: ``tag`` (an identifier tag), ``text`` (a sentence of the license itself), ``link``, ``name``
(a name with what tells versions apart), ``hint`` (a family's name).
"""

LICENSES = {
    "apache-2.0": r"""
        tag identifier apache 2 0
        text compliance you may not use this file except in compliance with the license
        text contributor subject to the terms and conditions of this license each contributor hereby grants to you a perpetual
        link apache apache org licenses license 2 0
        name apache apache (software )?licen[cs]e (version |v )?v?2( 0)?
        name apache apache v?2( 0)? licen[cs]e
        name asl asl v?2( 0)?
        name apache apache 2 0
    """,
    "apache-1.1": r"""
        tag identifier apache 1 1
        text apache this product includes software developed by the apache software foundation
        link apache apache org licenses license 1 1
        name apache apache (software )?licen[cs]e (version |v )?v?1 1
    """,
    "apache": r"""
        hint apache (the )?apache (software )?licen[cs]es?
        hint apache apache licensed
    """,
    "mit": r"""
        tag identifier mit
        text hereby permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
        text substantial the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
        link opensource opensource org licenses mit( license)?
        name mit mit licen[cs]e
        name mit mit licensed
        name expat expat licen[cs]e
        hint mit mit x11
    """,
    "mit-0": r"""
        tag identifier mit 0
        name mit mit no attribution( licen[cs]e)?
    """,
    "x11": r"""
        tag identifier x11
        text consortium permission to use copy modify distribute and sell this software( \S+){1,8} x consortium
        name x11 x11 licen[cs]e
    """,
    "bsd-2-clause": r"""
        tag identifier bsd 2 clause
        link opensource opensource org licenses bsd 2 clause
        name bsd bsd 2 clause( licen[cs]e)?
        name bsd (2|two) clause bsd( licen[cs]e)?
        name bsd simplified bsd licen[cs]e
        name freebsd freebsd licen[cs]e
    """,
    "bsd-3-clause": r"""
        tag identifier bsd 3 clause
        text endorse neither the name of( \S+){1,12} nor the names of its contributors may be used to endorse or promote products
        link opensource opensource org licenses bsd 3 clause
        name bsd bsd 3 clause( licen[cs]e)?
        name bsd (3|three) clause bsd( licen[cs]e)?
        name bsd (new|revised|modified) bsd licen[cs]e
    """,
    "bsd-4-clause": r"""
        tag identifier bsd 4 clause
        text advertising all advertising materials mentioning features or use of this software must display
        name bsd (4|four) clause bsd( licen[cs]e)?
        name bsd original bsd licen[cs]e
    """,
    "0bsd": r"""
        tag identifier 0bsd
        name bsd (zero|0) clause bsd( licen[cs]e)?
    """,
    "bsd": r"""
        text redistributions redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
        text redistributions redistributions in binary form must reproduce the above copyright notice
        hint bsd bsd (style )?licen[cs]es?
        hint bsd bsd licensed
    """,
    "isc": r"""
        tag identifier isc
        text fee permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
        link opensource opensource org licenses isc
        name isc isc licen[cs]e
    """,
    "gpl-1.0": r"""
        tag identifier gpl 1 0( only)?
        name general (gnu )?general public licen[cs]e (version |v )?v?1( 0)?
        name gpl (gnu )?gpl (version |v )?1( 0)?
        name gplv1 gplv1
    """,
    "gpl-2.0": r"""
        tag identifier gpl 2 0( only)?
        link gnu gnu org licenses (old licenses )?gpl 2 0
        name general (gnu )?general public licen[cs]e (version |v )?v?2( 0)?( only)?
        name gpl (gnu )?gpl (version |v )?2( 0)?( only)?
        name gplv2 gplv2( only)?
    """,
    "gpl-2.0-or-later": r"""
        tag identifier gpl 2 0 or later
        text option either version 2 of the license or at your option any later version
        name general (gnu )?general public licen[cs]e (version |v )?v?2( 0)? or( at your option)?( any)? (later|newer)( version)?
        name gpl (gnu )?gpl (version |v )?2( 0)? or( any)? (later|newer)( version)?
        name gplv2 gplv2 or (later|newer)
    """,
    "gpl-3.0": r"""
        tag identifier gpl 3 0( only)?
        link gnu gnu org licenses gpl 3 0
        name general (gnu )?general public licen[cs]e (version |v )?v?3( 0)?( only)?
        name gpl (gnu )?gpl (version |v )?3( 0)?( only)?
        name gplv3 gplv3( only)?
    """,
    "gpl-3.0-or-later": r"""
        tag identifier gpl 3 0 or later
        text option either version 3 of the license or at your option any later version
        name general (gnu )?general public licen[cs]e (version |v )?v?3( 0)? or( at your option)?( any)? (later|newer)( version)?
        name gpl (gnu )?gpl (version |v )?3( 0)? or( any)? (later|newer)( version)?
        name gplv3 gplv3 or (later|newer)
    """,
    "gpl": r"""
        text redistribute you can redistribute it and or modify it under the terms of the gnu general public license
        text received you should have received a copy of the gnu general public license
        link gnu gnu org (licenses|copyleft) gpl
        hint general (gnu )?general public licen[cs]es?
        hint gpl gnu gpl
        hint gpl gpl licensed
    """,
    "lgpl-2.0": r"""
        tag identifier lgpl 2 0( only| or later)?
        name library (gnu )?library general public licen[cs]e( (version |v )?v?2( 0)?)?
        name lgpl lgpl (version |v )?2( 0)?
    """,
    "lgpl-2.1": r"""
        tag identifier lgpl 2 1( only)?
        link gnu gnu org licenses (old licenses )?lgpl 2 1
        name lesser (gnu )?lesser general public licen[cs]e (version |v )?v?2 1
        name lgpl (gnu )?lgpl (version |v )?2 1
        name lgplv2 lgplv2 1
    """,
    "lgpl-2.1-or-later": r"""
        tag identifier lgpl 2 1 or later
        text option either version 2 1 of the license or at your option any later version
        name lesser (gnu )?lesser general public licen[cs]e (version |v )?v?2 1 or( at your option)?( any)? (later|newer)( version)?
        name lgpl (gnu )?lgpl (version |v )?2 1 or( any)? (later|newer)( version)?
    """,
    "lgpl-3.0": r"""
        tag identifier lgpl 3 0( only| or later)?
        link gnu gnu org licenses lgpl 3 0
        name lesser (gnu )?lesser general public licen[cs]e (version |v )?v?3( 0)?
        name lgpl (gnu )?lgpl (version |v )?3( 0)?
        name lgplv3 lgplv3
    """,
    "lgpl": r"""
        text received you should have received a copy of the gnu lesser general public license
        link gnu gnu org licenses lgpl
        hint lesser (gnu )?lesser general public licen[cs]es?
        hint lgpl (gnu )?lgpl
    """,
    "agpl-3.0": r"""
        tag identifier agpl 3 0( only| or later)?
        text remotely modified version must prominently offer all users interacting with it remotely
        link gnu gnu org licenses agpl 3 0
        name affero (gnu )?affero general public licen[cs]e (version |v )?v?3( 0)?
        name agpl (gnu )?agpl (version |v )?3( 0)?
        name agplv3 agplv3
    """,
    "agpl": r"""
        hint affero (gnu )?affero (general )?public licen[cs]es?
        hint agpl (gnu )?agpl
    """,
    "gfdl": r"""
        tag identifier gfdl 1 [123]( only| or later)?
        text documentation permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
        link gnu gnu org (licenses|copyleft) fdl
        name documentation (gnu )?free documentation licen[cs]e (version |v )?1 [123]
        name gfdl gfdl( 1 [123])?
        hint documentation (gnu )?free documentation licen[cs]e
    """,
    "mpl-1.1": r"""
        tag identifier mpl 1 1
        text mozilla the contents of this file are subject to the mozilla public license version 1 1
        link mozilla mozilla org mpl( mpl)? 1 1
        name mozilla mozilla public licen[cs]e (version |v )?v?1 1
        name mpl mpl (version |v )?1 1
    """,
    "mpl-2.0": r"""
        tag identifier mpl 2 0
        text mozilla this source code form is subject to the terms of the mozilla public license v 2 0
        link mozilla mozilla org (en us )?mpl 2 0
        name mozilla mozilla public licen[cs]e (version |v )?v?2( 0)?
        name mpl mpl (version |v )?2( 0)?
    """,
    "mpl": r"""
        hint mozilla mozilla public licen[cs]es?
    """,
    "epl-1.0": r"""
        tag identifier epl 1 0
        link eclipse eclipse org legal epl v10
        name eclipse eclipse public licen[cs]e (version |v )?v?1( 0)?
        name epl epl (version |v )?1( 0)?
    """,
    "epl-2.0": r"""
        tag identifier epl 2 0
        link eclipse eclipse org legal epl (2 0|v20)
        name eclipse eclipse public licen[cs]e (version |v )?v?2( 0)?
        name epl epl (version |v )?2( 0)?
    """,
    "epl": r"""
        hint eclipse eclipse public licen[cs]es?
        hint eclipse eclipse distribution licen[cs]e
    """,
    "cddl-1.0": r"""
        tag identifier cddl 1 0
        link opensource opensource org licenses cddl 1 0
        name cddl cddl (version |v )?1( 0)?
        name distribution common development and distribution licen[cs]e( (version |v )?1( 0)?)?
    """,
    "cpl-1.0": r"""
        tag identifier cpl 1 0
        name common common public licen[cs]e( (version |v )?1( 0)?)?
    """,
    "eupl-1.2": r"""
        tag identifier eupl 1 2
        name eupl eupl (version |v )?1 2
        name european european union public licen[cs]e( (version |v )?v?1 2)?
    """,
    "artistic-1.0": r"""
        tag identifier artistic 1 0( perl| cl8)?
        name artistic artistic licen[cs]e (version |v )?1( 0)?
        text perl under the same terms as perl itself
    """,
    "artistic-2.0": r"""
        tag identifier artistic 2 0
        link perlfoundation perlfoundation org artistic license 2 0
        name artistic artistic licen[cs]e (version |v )?2( 0)?
    """,
    "artistic": r"""
        hint artistic artistic licen[cs]e
    """,
    "bsl-1.0": r"""
        tag identifier bsl 1 0
        text hereby permission is hereby granted free of charge to any person or organization obtaining a copy of the software
        link boost boost org license 1 0
        name boost boost software licen[cs]e( (version |v )?1( 0)?)?
    """,
    "zlib": r"""
        tag identifier zlib
        text altered altered source versions must be plainly marked as such and must not be misrepresented
        text misrepresented the origin of this software must not be misrepresented
        name zlib zlib( libpng)? licen[cs]e
    """,
    "unlicense": r"""
        tag identifier unlicense
        text unencumbered this is free and unencumbered software released into the public domain
        link unlicense unlicense org
        hint unlicense the unlicense
    """,
    "wtfpl": r"""
        tag identifier wtfpl
        name wtfpl wtfpl
        link wtfpl wtfpl net
    """,
    "cc0-1.0": r"""
        tag identifier cc0 1 0
        text affirmer affirmer hereby overtly fully permanently irrevocably and unconditionally waives
        link creativecommons creativecommons org publicdomain zero 1 0
        name cc0 (creative commons )?cc0( 1 0)?( universal)?
    """,
    "cc-by-4.0": r"""
        tag identifier cc by 4 0
        link creativecommons creativecommons org licenses by 4 0
        name cc cc by 4 0
        name attribution (creative commons )?attribution 4 0( international)?
    """,
    "cc-by-3.0": r"""
        tag identifier cc by 3 0
        link creativecommons creativecommons org licenses by 3 0
        name cc cc by 3 0
        name attribution (creative commons )?attribution 3 0( unported)?
    """,
    "cc-by-sa-4.0": r"""
        tag identifier cc by sa 4 0
        link creativecommons creativecommons org licenses by sa 4 0
        name cc cc by sa 4 0
        name attribution (creative commons )?attribution share ?alike 4 0( international)?
    """,
    "cc-by-sa-3.0": r"""
        tag identifier cc by sa 3 0
        link creativecommons creativecommons org licenses by sa 3 0
        name cc cc by sa 3 0
        name attribution (creative commons )?attribution share ?alike 3 0( unported)?
    """,
    "cc-by-nc-4.0": r"""
        tag identifier cc by nc 4 0
        link creativecommons creativecommons org licenses by nc 4 0
        name cc cc by nc 4 0
        name attribution (creative commons )?attribution non ?commercial 4 0( international)?
    """,
    "cc-by-nc-sa-4.0": r"""
        tag identifier cc by nc sa 4 0
        link creativecommons creativecommons org licenses by nc sa 4 0
        name cc cc by nc sa 4 0
        name attribution (creative commons )?attribution non ?commercial share ?alike 4 0( international)?
    """,
    "cc-by-nc-nd-4.0": r"""
        tag identifier cc by nc nd 4 0
        link creativecommons creativecommons org licenses by nc nd 4 0
        name cc cc by nc nd 4 0
        name attribution (creative commons )?attribution non ?commercial no ?deriv(ative)?s 4 0( international)?
    """,
    "cc-by-nd-4.0": r"""
        tag identifier cc by nd 4 0
        link creativecommons creativecommons org licenses by nd 4 0
        name cc cc by nd 4 0
        name attribution (creative commons )?attribution no ?deriv(ative)?s 4 0( international)?
    """,
    "cc": r"""
        link creativecommons creativecommons org licenses by( nc| nd| sa){0,2}
        hint creative creative commons( attribution)?( licen[cs]e)?
        hint cc cc by( nc| nd| sa){0,2}
    """,
    "odbl-1.0": r"""
        tag identifier odbl 1 0
        link opendatacommons opendatacommons org licenses odbl
        name open open data(base| commons open database) licen[cs]e
        name odbl odbl
    """,
    "odc-by-1.0": r"""
        tag identifier odc by 1 0
        name odc odc by
        name attribution open data commons attribution licen[cs]e
    """,
    "pddl-1.0": r"""
        tag identifier pddl 1 0
        name dedication public domain dedication and licen[cs]e
    """,
    "ofl-1.1": r"""
        tag identifier ofl 1 1
        text font this font software is licensed under the sil open font license
        link sil scripts sil org ofl
        name font (sil )?open font licen[cs]e( (version |v )?1 1)?
    """,
    "psf-2.0": r"""
        tag identifier (psf|python) 2 0
        name python python software foundation licen[cs]e( (version |v )?2)?
        hint psf psf licen[cs]e
    """,
    "ruby": r"""
        tag identifier ruby
        name ruby ruby licen[cs]e
        text ruby same terms as ruby( itself)?
    """,
    "php-3.01": r"""
        tag identifier php 3 01
        link php php net license 3 01
        name php php licen[cs]e( (version |v )?3 01)?
    """,
    "openssl": r"""
        tag identifier openssl
        text openssl this product includes software developed by the openssl project
        name openssl openssl licen[cs]e
    """,
    "postgresql": r"""
        tag identifier postgresql
        name postgresql postgresql licen[cs]e
    """,
    "ncsa": r"""
        tag identifier ncsa
        name ncsa (university of illinois )?ncsa( open source)? licen[cs]e
    """,
    "w3c": r"""
        tag identifier w3c
        name w3c w3c software (notice and )?licen[cs]e
    """,
    "unicode": r"""
        tag identifier unicode (dfs 201[56]|3 0)
        name unicode unicode( inc)? licen[cs]e( agreement)?
    """,
    "ms-pl": r"""
        tag identifier ms pl
        name microsoft microsoft public licen[cs]e
    """,
    "ms-rl": r"""
        tag identifier ms rl
        name microsoft microsoft reciprocal licen[cs]e
    """,
    "upl-1.0": r"""
        tag identifier upl 1 0
        name universal universal permissive licen[cs]e( (version |v )?1( 0)?)?
    """,
    "afl-3.0": r"""
        tag identifier afl 3 0
        name academic academic free licen[cs]e( (version |v )?3( 0)?)?
    """,
    "osl-3.0": r"""
        tag identifier osl 3 0
        name open open software licen[cs]e (version |v )?3( 0)?
    """,
    "bsl-1.1": r"""
        tag identifier busl 1 1
        name business business source licen[cs]e( (version |v )?1 1)?
    """,
    "sspl-1.0": r"""
        tag identifier sspl 1 0
        name sspl sspl( (version |v )?1( 0)?)?
        name server server side public licen[cs]e( (version |v )?1( 0)?)?
    """,
    "elastic-2.0": r"""
        tag identifier elastic 2 0
        name elastic elastic licen[cs]e( (version |v )?2( 0)?)?
    """,
    "blueoak-1.0.0": r"""
        tag identifier blueoak 1 0 0
        name oak blue oak model licen[cs]e( 1 0 0)?
    """,
    "mulan-psl-2.0": r"""
        tag identifier mulanpsl 2 0
        name mulan mulan (permissive software license|psl) v?2
    """,
    "openrail": r"""
        name openrail (bigscience |creativeml )?openrail( m)?( licen[cs]e)?
        name rail (bigscience|bigcode) rail( \S+){0,2} licen[cs]e
    """,
    "beerware": r"""
        tag identifier beerware
        text beerware the beerware licen[cs]e
    """,
    "public-domain": r"""
        text domain (released|placed|dedicated|is) (into|in|to) the public domain
        hint domain public domain (software|work|dedication)
    """,
    "proprietary": r"""
        text confidential (proprietary and confidential|confidential and proprietary)
        text prohibited unauthorized (copying|use|distribution)( \S+){0,8} is (strictly )?prohibited
        hint proprietary proprietary licen[cs]e
        hint eula end user licen[cs]e agreement eula
        hint agreement end user licen[cs]e agreement
    """,
    "copyright": r"""
        hint rights all rights reserved
        hint copyright copyright( c)? (19|20)[0-9][0-9]( (19|20)[0-9][0-9])?
    """,
}

#: Words that bring in a license; a name behind them is surer than a name alone.
NOTICE = (r"(licensed|released|distributed|available|published|provided|issued) (only )?(to \S+ )?under "
          r"((the )?(terms|provisions)( and conditions)? of )?(the |an? )?")
#: What stands before an identifier.
TAG = r"spdx( file)? licen[cs]e identifier "

#: Phrases with their label, reported wherever they stand.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
