"""Names and sentences of further public licences, as their texts have them."""

# Identifiers of licences and the names they go by, normalised as sentences are.
NAMES = {
    "MIT": ["mit license"],
    "ISC": ["isc license"],
    "Apache-{version}": ["apache license version {version}", "apache license {version}", "apache software license version {version}"],
    "BSL-{version}": ["boost software license version {version}", "boost software license {version}"],
    "Zlib": ["zlib license"],
    "Unlicense": ["unlicense"],
    "EPL-{version}": ["eclipse public license version {version}", "eclipse public license {version}"],
    "MPL-{version}": ["mozilla public license version {version}", "mozilla public license {version}"],
    "CDDL-{version}": ["common development and distribution license version {version}", "common development and distribution license {version}"],
    "GPL-{version}": ["gnu general public license version {version}", "gnu general public license {version}", "gnu gpl version {version} license"],
    "LGPL-{version}": ["gnu lesser general public license version {version}", "gnu lesser general public license {version}",
                       "gnu library general public license version {version}"],
    "AGPL-{version}": ["gnu affero general public license version {version}", "gnu affero general public license {version}"],
    "GFDL-{version}": ["gnu free documentation license version {version}", "gnu free documentation license {version}"],
    "0BSD": ["zero clause bsd license", "0bsd license"],
    "BSD-2-Clause": ["bsd 2 clause license", "simplified bsd license", "freebsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "new bsd license", "modified bsd license", "revised bsd license"],
    "BSD-4-Clause": ["bsd 4 clause license", "original bsd license"],
    "Artistic-{version}": ["artistic license version {version}", "artistic license {version}"],
    "PSF-{version}": ["python software foundation license version {version}"],
    "OFL-{version}": ["sil open font license version {version}", "open font license version {version}"],
    "EUPL-{version}": ["european union public license version {version}", "eupl license version {version}"],
    "MS-PL": ["microsoft public license"],
    "MS-RL": ["microsoft reciprocal license"],
    "PostgreSQL": ["postgresql license"],
    "NCSA": ["university of illinois ncsa open source license"],
    "OSL-{version}": ["open software license version {version}", "open software license {version}"],
    "AFL-{version}": ["academic free license version {version}", "academic free license {version}"],
    "ECL-{version}": ["educational community license version {version}"],
    "CPL-{version}": ["common public license version {version}", "common public license {version}"],
    "IPL-{version}": ["ibm public license version {version}"],
    "APSL-{version}": ["apple public source license version {version}"],
    "NPL-{version}": ["netscape public license version {version}"],
    "QPL-{version}": ["q public license version {version}"],
    "LPPL-{version}": ["latex project public license version {version}", "latex project public license {version}"],
    "PHP-{version}": ["php license version {version}"],
    "Ruby": ["ruby license"],
    "Vim": ["vim license"],
    "X11": ["x11 license"],
    "UPL-{version}": ["universal permissive license version {version}"],
    "BlueOak-{version}": ["blue oak model license version {version}", "blue oak model license {version}"],
    "ODbL-{version}": ["open database license version {version}", "open database license {version}"],
    "ODC-By-{version}": ["open data commons attribution license version {version}"],
    "PDDL-{version}": ["public domain dedication and license version {version}"],
    "WTFPL": ["do what the fuck you want to public license"],
}

# How a name stands in a sentence; the last is a heading.
PHRASES = [
    "licensed under the {}", "released under the {}", "distributed under the {}", "available under the {}",
    "licensed under the terms of the {}", "released under the terms of the {}", "distributed under the terms of the {}",
    "this project is licensed under the {}", "this software is licensed under the {}", "this work is licensed under the {}",
    "this program is licensed under the {}", "this file is licensed under the {}", "the {}", "{}",
]

# Parts of the Creative Commons names, and how they are written out.
ELEMENTS = {
    "by": ["attribution"], "by sa": ["attribution sharealike", "attribution share alike"],
    "by nd": ["attribution noderivatives", "attribution no derivatives", "attribution noderivs"],
    "by nc": ["attribution noncommercial", "attribution non commercial"],
    "by nc sa": ["attribution noncommercial sharealike", "attribution non commercial share alike"],
    "by nc nd": ["attribution noncommercial noderivatives", "attribution non commercial no derivatives", "attribution noncommercial noderivs"],
}
COMMONS = [
    "licensed under {}", "released under {}", "this work is licensed under {}", "this work is licensed under a {}",
    "licensed under a {}", "this content is licensed under {}", "this article is licensed under a {}", "{}",
]

# Sentences of grants and warranties.
GRANTS = {
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
                  "granted provided that the above copyright notice and this permission notice appear in all copies",
                  "permission to use copy modify and distribute this software for any purpose with or without fee is hereby "
                  "granted provided that the above copyright notice and this permission notice appear in all copies"],
    "isc-warranty": ["the software is provided as is and the author disclaims all warranties with regard to this software "
                     "including all implied warranties of merchantability and fitness"],
    "0bsd-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
                   "granted"],
    "zlib-warranty": ["this software is provided as is without any express or implied warranty"],
    "zlib-grant": ["permission is granted to anyone to use this software for any purpose including commercial applications and "
                   "to alter it and redistribute it freely subject to the following restrictions"],
    "boost-grant": ["permission is hereby granted free of charge to any person or organization obtaining a copy of the software "
                    "and accompanying documentation covered by this license the software to use reproduce display distribute "
                    "execute and transmit the software and to prepare derivative works of the software and to permit third "
                    "parties to whom the software is furnished to do so all subject to the following"],
    "unlicense-grant": ["this is free and unencumbered software released into the public domain"],
    "lgpl-grant": [f"this {work} is free software you can redistribute it and or modify it under the terms of the gnu {kind} "
                   "general public license as published by the free software foundation either version {version} of the license "
                   "or at your option any later version" for work in ("library", "program", "file") for kind in ("lesser", "library")],
    "lgpl-only": ["this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
                  "general public license as published by the free software foundation version {version} of the license",
                  "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
                  "general public license version {version} as published by the free software foundation"],
    "agpl-grant": ["this program is free software you can redistribute it and or modify it under the terms of the gnu affero "
                   "general public license as published by the free software foundation either version {version} of the license "
                   "or at your option any later version"],
    "agpl-only": ["this program is free software you can redistribute it and or modify it under the terms of the gnu affero "
                  "general public license version {version} as published by the free software foundation"],
    "gpl-fixed": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                  "public license version {version} as published by the free software foundation",
                  "you can redistribute it and or modify it under the terms of the gnu general public license version {version} as "
                  "published by the free software foundation"],
    "epl-grant": ["this program and the accompanying materials are made available under the terms of the eclipse public license "
                  "{version} which accompanies this distribution",
                  "this program and the accompanying materials are made available under the terms of the eclipse public license "
                  "{version} which accompanies this distribution and is available at",
                  "this program and the accompanying materials are made available under the terms of the eclipse public license "
                  "{version} which is available at"],
    "mpl-grant": ["if a copy of the mpl was not distributed with this file you can obtain one at"],
    "cddl-grant": ["the contents of this file are subject to the terms of the common development and distribution license the license",
                   "the contents of this file are subject to the terms of the common development and distribution license version "
                   "{version} the license"],
    "spdx": ["spdx license identifier {id}"],
}

# Rules over these, in order.
GRANT_RULES = [
    ("{version}", "spdx", ["spdx"]),
    ("ISC", "isc-full", ["isc-grant", "isc-warranty"]),
    ("ISC", "isc-part", ["isc-grant"]),
    ("0BSD", "0bsd-full", ["0bsd-grant", "isc-warranty"]),
    ("0BSD", "0bsd-part", ["0bsd-grant"]),
    ("Zlib", "zlib-full", ["zlib-warranty", None, "zlib-grant"]),
    ("Zlib", "zlib-part", ["zlib-grant"]),
    ("BSL-1.0", "boost-full", ["boost-grant"]),
    ("Unlicense", "unlicense-full", ["unlicense-grant"]),
    ("LGPL-{version}-or-later", "lgpl-later", ["lgpl-grant"]),
    ("LGPL-{version}-only", "lgpl-only", ["lgpl-only"]),
    ("AGPL-{version}-or-later", "agpl-later", ["agpl-grant"]),
    ("AGPL-{version}-only", "agpl-only", ["agpl-only"]),
    ("GPL-{version}-only", "gpl-fixed", ["gpl-fixed"]),
    ("EPL-{version}", "epl-grant", ["epl-grant"]),
    ("CDDL-{version}", "cddl-grant", ["cddl-grant"]),
    ("MPL-{version}", "mpl-full", ["mpl-name", "mpl-grant"]),
]


def named() -> dict[str, list[str]]:
    """Sentences that name a licence, by its identifier."""
    found = {name: [p.format(kind) for kind in kinds for p in PHRASES] for name, kinds in NAMES.items()}
    for short, kinds in ELEMENTS.items():
        bare = [f"cc {short}", *[f"creative commons {k} license" for k in kinds]]
        versioned = [f"cc {short} {{version}}", f"cc {short} {{version}} license"]
        versioned += [f"creative commons {k} {{version}}{tail}" for k in kinds for tail in (" international license", " license", " unported license", "")]
        name = "CC-" + short.upper().replace(" ", "-") + "-{version}"
        found[name] = [p.format(kind) for kind in versioned + bare for p in COMMONS]
    return found
