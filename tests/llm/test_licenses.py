"""Every license rule on every text, without any prefilter, and texts made from the rules."""

import random
import re
from re import _constants as op
from re import _parser as parser

from seqframe.llm import licenses
from tests.llm.test_operators import by_id


def sample(rng, tree):
    """A text that the parsed pattern matches (looking around apart)."""
    out = []
    for code, arg in tree:
        if code is op.LITERAL:
            out.append(chr(arg))
        elif code is op.NOT_LITERAL:
            out.append("x")
        elif code is op.BRANCH:
            out.append(sample(rng, rng.choice(arg[1])))
        elif code is op.SUBPATTERN:
            out.append(sample(rng, arg[3]))
        elif code in (op.MAX_REPEAT, op.MIN_REPEAT):
            low, high, inner = arg
            out += [sample(rng, inner) for _ in range(rng.randint(low, min(high, low + 2)))]
        elif code is op.IN:
            kind, value = rng.choice(arg)
            out.append("7" if kind is op.CATEGORY else chr(value) if kind is op.LITERAL else "x")
        else:
            assert code in (op.ASSERT, op.ASSERT_NOT), code
    return "".join(out)


def all_matches(text):
    """``(label, first, last)`` of the matches of all rules on the text's words."""
    n = re.sub(licenses.NON_WORD, " ", text.lower()).strip(" ")
    found = []
    for r in licenses.RULES:
        for m in re.finditer(rf"(?<![^ ])(?:{r.pattern})(?![^ ])", n):
            a = n[:m.start()].count(" ")
            found.append((r.label, a, a + m.group().count(" ")))
    return sorted(found)


def scanned(docs, texts):
    out = by_id(licenses.scan(docs(list(enumerate(texts)))))
    return [out[i] for i in range(len(texts))]


def test_no_match_is_lost_before_the_rules(docs):
    rng = random.Random(1)
    texts = [f"xx {sample(rng, parser.parse(r.pattern))} yy" for r in licenses.RULES for _ in range(6)]
    texts += ["cc", "discuss the mitten", "bsd", "isc licence", ""]
    for t, r in zip(texts, scanned(docs, texts), strict=True):
        got = sorted((d["label"], d["first"], d["last"]) for d in r["detections"])
        assert got == all_matches(t), t


def test_wordings_without_the_label_in_them(docs):
    want = {
        "Licensed under a Creative Commons Attribution 4.0 International License": "cc-by-4.0",
        "Released under CC BY-NC-SA 4.0": "cc-by-nc-sa-4.0",
        "Do What The Fuck You Want To Public License, Version 2": "wtfpl-2.0",
        "under a commercial licence": "proprietary",
        "see the end user licence agreement": "eula",
    }
    for label, r in zip(want.values(), scanned(docs, list(want)), strict=True):
        assert label in r["labels"].split(","), (label, r["labels"])


NOTICES = {
    "apache-2.0": ["Licensed under the Apache License v2.0", "SPDX-License-Identifier: Apache-2.0"],
    "gpl-3.0": ["licensed under the GPLv3", "GNU GPL version 3", "GNU General Public License v3.0",
                "the GNU General Public License as published by the Free Software Foundation, either "
                "version 3 of the License, or (at your option) any later version", "GPL v3+", "GPL-3.0-only"],
    "gpl-2.0": ["SPDX-License-Identifier: GPL-2.0-only", "version 2 of the GNU General Public License"],
    "gpl": ["released under the GPL", "GPL licence"],
    "lgpl-2.1": ["SPDX-License-Identifier: LGPL-2.1", "LGPLv2.1+", "GNU Lesser General Public License (LGPL) v2.1"],
    "lgpl": ["see the LGPL", "licensed under the LGPL"],
    "agpl-3.0": ["SPDX-License-Identifier: AGPL-3.0-or-later", "the GNU AGPLv3"],
    "gfdl-1.3": ["SPDX-License-Identifier: GFDL-1.3-only", "GNU Free Documentation License, Version 1.3"],
    "mpl-2.0": ["SPDX-License-Identifier: MPL-2.0", "the terms of the Mozilla Public License, v. 2.0"],
    "epl-2.0": ["SPDX-License-Identifier: EPL-2.0", "under the terms of the Eclipse Public License v2.0"],
    "cddl-1.0": ["SPDX-License-Identifier: CDDL-1.0",
                 "Common Development and Distribution License (CDDL) Version 1.0"],
    "eupl-1.2": ["SPDX-License-Identifier: EUPL-1.2", "Licensed under the EUPL, Version 1.2 or later"],
    "osl-3.0": ["SPDX-License-Identifier: OSL-3.0", "Licensed under the Open Software License version 3.0"],
    "afl-3.0": ["SPDX-License-Identifier: AFL-3.0", "Licensed under the Academic Free License version 3.0"],
    "artistic-2.0": ["SPDX-License-Identifier: Artistic-2.0", "the Artistic License 2.0"],
    "boost-1.0": ["SPDX-License-Identifier: BSL-1.0",
                  "Distributed under the Boost Software License, Version 1.0."],
    "bsd-2-clause": ["SPDX-License-Identifier: BSD-2-Clause", "the 2-clause BSD license"],
    "bsd-3-clause": ["SPDX-License-Identifier: BSD-3-Clause", "the 3-Clause BSD License"],
    "bsd-4-clause": ["SPDX-License-Identifier: BSD-4-Clause", "the original BSD license"],
    "bsd": ["released under the BSD license"],
    "mit": ["SPDX-License-Identifier: MIT", "Released under the MIT License"],
    "expat": ["the Expat license"],
    "x11": ["SPDX-License-Identifier: X11", "the X11 License"],
    "isc": ["SPDX-License-Identifier: ISC", "the ISC license"],
    "zlib": ["SPDX-License-Identifier: Zlib", "the zlib/libpng license"],
    "unlicense": ["SPDX-License-Identifier: Unlicense", "released under the Unlicense"],
    "wtfpl-2.0": ["WTFPLv2", "Do What The Fuck You Want To Public License, Version 2"],
    "wtfpl": ["SPDX-License-Identifier: WTFPL"],
    "ms-pl": ["SPDX-License-Identifier: MS-PL", "Microsoft Public License (Ms-PL)"],
    "ms-rl": ["SPDX-License-Identifier: MS-RL", "the Microsoft Reciprocal License"],
    "python-2.0": ["SPDX-License-Identifier: Python-2.0", "PSF License Version 2"],
    "php-3.01": ["SPDX-License-Identifier: PHP-3.01", "subject to version 3.01 of the PHP license"],
    "ruby": ["SPDX-License-Identifier: Ruby", "the Ruby License"],
    "postgresql": ["SPDX-License-Identifier: PostgreSQL", "the PostgreSQL Licence"],
    "openssl": ["SPDX-License-Identifier: OpenSSL", "the OpenSSL License"],
    "sil-ofl-1.1": ["SPDX-License-Identifier: OFL-1.1", "under the SIL Open Font License, Version 1.1."],
    "odbl-1.0": ["SPDX-License-Identifier: ODbL-1.0", "Open Database License (ODbL) v1.0"],
    "cc-by-4.0": ["SPDX-License-Identifier: CC-BY-4.0", "CC BY 4.0"],
    "cc-by-sa-4.0": ["SPDX-License-Identifier: CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0"],
    "cc-by-nd-4.0": ["SPDX-License-Identifier: CC-BY-ND-4.0", "CC BY-ND 4.0"],
    "cc-by-nc-4.0": ["SPDX-License-Identifier: CC-BY-NC-4.0", "CC BY-NC 4.0"],
    "cc-by-nc-sa-4.0": ["SPDX-License-Identifier: CC-BY-NC-SA-4.0", "CC BY-NC-SA 4.0"],
    "cc-by-nc-nd-4.0": ["SPDX-License-Identifier: CC-BY-NC-ND-4.0",
                        "a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
    "cc0-1.0": ["SPDX-License-Identifier: CC0-1.0", "CC0 1.0 Universal"],
}


def test_notices_of_every_family(docs):
    cases = [(label, t) for label, texts in NOTICES.items() for t in texts]
    for (label, t), r in zip(cases, scanned(docs, [t for _, t in cases]), strict=True):
        # The base labels are always there; nothing else may be beside the license.
        assert set(r["labels"].split(",")) - set(r["base_labels"].split(",")) | {label} == {label}, (
            t, r["labels"])
        assert label in r["labels"].split(","), (t, r["labels"])
        if t.startswith("SPDX"):
            assert r["score"] == (1.0 if label != "wtfpl" else 0.9), t
    assert {f.label for f in licenses.FAMILIES} == {
        f.label for f in licenses.FAMILIES for k in NOTICES
        if k == f.label or k in [f"{f.label}-{v}" for v in f.versions]}


AS_IS = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"'
BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted "
       "provided that the following conditions are met:\n1. Redistributions of source code must retain the "
       "above copyright notice, this list of conditions and the following disclaimer.\n2. Redistributions "
       "in binary form must reproduce the above copyright notice, this list of conditions and the following "
       "disclaimer in the documentation and/or other materials provided with the distribution.\n")
ADVERT = ("3. All advertising materials mentioning features or use of this software must display the "
          "following acknowledgement: This product includes software developed by the organization.\n4. ")
NEITHER = ("Neither the name of the copyright holder nor the names of its contributors may be used to "
           "endorse or promote products derived from this software without specific prior written "
           "permission.\n")
FSF = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
       "General Public License as published by the Free Software Foundation; ")
BODY_TEXTS = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
           'and associated documentation files (the "Software"), to deal in the Software without '
           "restriction, including without limitation the rights to use, copy, modify",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
           "without fee is hereby granted, provided that the above copyright notice and this permission "
           "notice appear in all copies.",
    "0bsd": "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
            'without fee is hereby granted.\n\nTHE SOFTWARE IS PROVIDED "AS IS"',
    "bsd-2-clause": BSD + AS_IS,
    "bsd-3-clause": f"{BSD}3. {NEITHER}{AS_IS}",
    "bsd-4-clause": BSD + ADVERT + NEITHER + AS_IS,
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will "
            "the authors be held liable for any damages arising from the use of this software.",
    "boost-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a "
                 "copy of the software and accompanying documentation covered by this license",
    "sil-ofl-1.1": "Permission is hereby granted, free of charge, to any person obtaining a copy of the "
                   "Font Software, to use, study, copy",
    "apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
                  "file except in compliance with the License.",
    "gpl-2.0": FSF + "either version 2 of the License, or (at your option) any later version.",
    "gpl-3.0": FSF + "either version 3 of the License, or (at your option) any later version.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or "
               "neighboring rights to this work.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "beerware": "As long as you retain this notice you can do whatever you want with this stuff.",
}


def test_bodies_without_a_name(docs):
    for (label, t), r in zip(BODY_TEXTS.items(), scanned(docs, list(BODY_TEXTS.values())), strict=True):
        labels = set(r["labels"].split(","))
        assert labels - set(r["base_labels"].split(",")) - {"unknown-license", "public-domain"} == {label}, (
            label, labels)
        assert r["score"] >= 0.95, label


def test_both_of_two_versions(docs):
    cases = {
        "Licensed under GPL version 2 or version 3": {"gpl-2.0", "gpl-3.0"},
        "the GNU General Public License, version 2 or 3": {"gpl", "gpl-2.0", "gpl-3.0"},
        "GNU LGPL v2.1 or v3": {"lgpl-2.1", "lgpl-3.0"},
        "GPL version 2 or later": {"gpl-2.0"},
    }
    for want, r in zip(cases.values(), scanned(docs, list(cases)), strict=True):
        assert set(r["labels"].split(",")) == want, r["labels"]


def test_license_rows_repeated_and_null(docs):
    rows = [(1, "MIT License"), (1, "MIT License"), (None, "MIT License"), (None, None)]
    got = sorted((r["doc_id"] or 0, r["labels"], r["n_words"]) for r in licenses.scan(docs(rows)).collect())
    assert got == [(0, "", 0), (0, "mit", 2), (1, "mit", 2), (1, "mit", 2)]


def test_bodies_in_very_long_texts(docs):
    texts = [BSD * 2_000, BSD + "x" * 1_000_000 + f" {NEITHER}", "the name of " * 50_000 + BSD + AS_IS]
    first, second, third = scanned(docs, texts)
    assert first["labels"] == "bsd" and len(first["detections"]) >= 2_000
    assert second["labels"] == "bsd-3-clause"
    assert third["labels"] == "bsd-2-clause"
