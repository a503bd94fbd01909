"""License scans by sentence recognition.

A text is normalised (lower case, runs of other characters than letters and digits
become one space) with its sentence ends, blank lines and newlines kept as marks.
A known sentence counts where it fills a sentence or whole lines; a complete
sentence of a licence text counts wherever all its words stand in a row, on one
line or wrapped, behind comment or list marks.  The identifiers found, in text
order, are then matched against ordered licence rules.  Only DataFrame functions
run here.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

TERMINATOR = r"[.!?]+(?=[\x20\x09-\x0D]|$)"

# Licences by their SPDX identifier, and the names that references give them (fixed values).
LICENCES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License"],
    "MIT": ["MIT License"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPLv3", "GPLv3", "GPL-3.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
    "CC-BY-SA-3.0": ["CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 3.0 Unported License"],
    "CC-BY-3.0": ["CC BY 3.0", "Creative Commons Attribution 3.0 Unported License"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "CC0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPLv2", "GPLv2", "GPL-2.0"],
    "GPL-2.0-only": [], "GPL-2.0-or-later": ["GPLv2 or later", "GPL-2.0-or-later"],
    "GPL-3.0-only": [], "GPL-3.0-or-later": ["GPLv3 or later", "GPL-3.0-or-later"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPLv2.1", "LGPL-2.1"],
    "LGPL-2.1-only": [], "LGPL-2.1-or-later": [],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "LGPLv3", "LGPL-3.0"],
    "LGPL-3.0-only": [], "LGPL-3.0-or-later": [],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "AGPLv3", "AGPL-3.0"],
    "AGPL-3.0-only": [], "AGPL-3.0-or-later": [],
    "MPL-1.1": ["Mozilla Public License 1.1", "Mozilla Public License, version 1.1"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "MPL 2.0", "MPL-2.0"],
    "EPL-1.0": ["Eclipse Public License 1.0", "Eclipse Public License v1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License - v 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License", "BSD-2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "Modified BSD License", "BSD-3-Clause License"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD License", "0BSD License"],
    "ISC": ["ISC License"], "Zlib": ["zlib License"], "BSL-1.0": ["Boost Software License 1.0", "Boost Software License, Version 1.0"],
    "Unlicense": ["Unlicense"], "WTFPL": ["WTFPL"], "MIT-0": ["MIT No Attribution License", "MIT-0 License"],
    "Artistic-2.0": ["Artistic License 2.0"], "PostgreSQL": ["PostgreSQL License"], "Python-2.0": ["Python License 2.0"],
    "OFL-1.1": ["SIL Open Font License, Version 1.1", "SIL Open Font License 1.1"],
    "EUPL-1.2": ["European Union Public Licence 1.2", "EUPL 1.2", "EUPL-1.2"],
    "CDDL-1.0": ["Common Development and Distribution License 1.0", "CDDL 1.0"],
    "ODbL-1.0": ["Open Database License 1.0", "Open Data Commons Open Database License v1.0"],
    "ODC-By-1.0": ["Open Data Commons Attribution License v1.0"],
    "NCSA": ["University of Illinois/NCSA Open Source License", "NCSA License"],
    "MS-PL": ["Microsoft Public License"], "Vim": ["Vim License"], "BUSL-1.1": ["Business Source License 1.1"],
}
REF = {"Apache-2.0": "APACHE2_REF", "GPL-3.0": "GPL3_REF", "CC-BY-NC-4.0": "CC_BY_NC_REF", "CC-BY-4.0": "CC_BY_REF"}
REF = {spdx: REF.get(spdx, "".join(c if c.isalnum() else "_" for c in spdx.upper()) + "_REF") for spdx in LICENCES}
TAG = "SPDX-License-Identifier:"
LEADS = [f"{what}{how} under" for what in ("", "This work is ", "This software is ", "This project is ", "This file is ")
         for how in ("licensed", "released", "distributed", "available")]

# Known licence sentences: identifier and sentence (fixed values).
SENTENCES = [
    *[(REF[spdx], f"{TAG} {spdx}") for spdx in LICENCES],
    *[(REF[spdx], f"{lead}{the} {name}") for spdx, names in LICENCES.items() for name in names for lead in LEADS
      for the in ("", " the", " the terms of the")],
    ("OBSD_GRANT", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("APACHE2_REF", "Licensed under the Apache License, Version 2.0"),
    ("APACHE2_REF", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("APACHE2_USE", "you may not use this file except in compliance with the License"),
    ("APACHE2_COPY", "You may obtain a copy of the License at"),
    ("MIT_REF", "Released under the MIT License"),
    ("MIT_REF", "Licensed under the MIT License"),
    ("MIT_GRANT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MIT_NOTICE", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("AS_IS", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND"),
    ("GPL3_REF", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL_GRANT", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("GPL_WARRANTY", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"),
    ("BSD_GRANT", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD_SOURCE", "Redistributions of source code must retain the above copyright notice"),
    ("BSD_BINARY", "Redistributions in binary form must reproduce the above copyright notice"),
    ("CC_BY_NC_REF", "Licensed under CC BY-NC 4.0"),
    ("CC_BY_REF", "Licensed under CC BY 4.0"),
    ("RIGHTS", "All rights reserved"),
]

# Complete sentences of the licence texts: identifiers and wording (fixed values).
TEXTS = [
    (("APACHE2_REF", "APACHE2_USE"), "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License"),
    (("APACHE2_COPY",), "You may obtain a copy of the License at"),
    (("MIT_GRANT",), "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights "
     "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
     "whom the Software is furnished to do so, subject to the following conditions"),
    (("MIT_NOTICE",), "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
     "of the Software"),
    (("MIT_NOTICE",), "The above copyright notice and this permission notice (including the next paragraph) shall be included in all "
     "copies or substantial portions of the Software"),
    (("AS_IS",), "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
     "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"),
    *[(("GPL_GRANT",), "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
       f"Public License as published by the Free Software Foundation, either version {n} of the License, or (at your option) any "
       "later version") for n in (2, 3)],
    (("GPL_WARRANTY",), "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
     "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"),
    (("BSD_GRANT",), "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met"),
    (("BSD_SOURCE",), "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
     "following disclaimer"),
    (("BSD_BINARY",), "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
     "following disclaimer in the documentation and/or other materials provided with the distribution"),
    *[(("BSD_ENDORSE",), f"Neither the name of {holder} nor the names of its contributors may be used to endorse or promote products "
       "derived from this software without specific prior written permission")
      for holder in ("the copyright holder", "the University", "the Regents")],
    *[(("ISC_GRANT",), f"Permission to use, copy, modify, {both} distribute this software for any purpose with or without fee is hereby "
       "granted, provided that the above copyright notice and this permission notice appear in all copies")
      for both in ("and", "and/or")],
    (("ISC_WARRANTY",), "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
     "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS"),
    (("MPL2_FORM",), "This Source Code Form is subject to the terms of the Mozilla Public License"),
    (("MPL2_COPY",), "If a copy of the MPL was not distributed with this file, You can obtain one at"),
    (("LGPL21_GRANT",), "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
     "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any "
     "later version"),
    (("LGPL_WARRANTY",), "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
     "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"),
    *[((ident,), f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} General "
       "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
       "version") for ident, kind in (("LGPL3_GRANT", "Lesser"), ("AGPL3_GRANT", "Affero"))],
    (("UNLICENSE_FREE",), "This is free and unencumbered software released into the public domain"),
    (("UNLICENSE_USE",), "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source "
     "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means"),
    (("ZLIB_WARRANTY",), "This software is provided 'as-is', without any express or implied warranty"),
    (("ZLIB_GRANT",), "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
     "alter it and redistribute it freely, subject to the following restrictions"),
    (("BOOST_GRANT",), "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
     "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and "
     "transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is "
     "furnished to do so, all subject to the following"),
    (("WTFPL_COPY",), "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing "
     "it is allowed as long as the name is changed"),
    (("EPL2_NOTICE",), "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
     "which is available at"),
]

# Ordered rules: the licence, and the identifiers that must follow one another
# (others may stand between them).
RULES = [
    ("Apache-2.0", ["APACHE2_REF"]),
    ("Apache-2.0-notice", ["APACHE2_REF", "APACHE2_USE", "APACHE2_COPY"]),
    ("MIT", ["MIT_REF"]),
    ("MIT-text", ["MIT_GRANT", "MIT_NOTICE", "AS_IS"]),
    ("GPL-3.0", ["GPL3_REF"]),
    ("GPL-notice", ["GPL_GRANT", "GPL_WARRANTY"]),
    ("BSD-2-Clause", ["BSD_GRANT", "BSD_SOURCE", "BSD_BINARY"]),
    ("CC-BY-NC-4.0", ["CC_BY_NC_REF"]),
    ("CC-BY-4.0", ["CC_BY_REF"]),
    ("all-rights-reserved", ["RIGHTS"]),
    ("BSD-3-Clause-text", ["BSD_GRANT", "BSD_SOURCE", "BSD_BINARY", "BSD_ENDORSE"]),
    ("ISC-text", ["ISC_GRANT", "ISC_WARRANTY"]),
    ("0BSD-text", ["OBSD_GRANT", "ISC_WARRANTY"]),
    ("MPL-2.0-notice", ["MPL2_FORM", "MPL2_COPY"]),
    ("LGPL-2.1-notice", ["LGPL21_GRANT", "LGPL_WARRANTY"]),
    ("LGPL-3.0-notice", ["LGPL3_GRANT", "GPL_WARRANTY"]),
    ("AGPL-3.0-notice", ["AGPL3_GRANT", "GPL_WARRANTY"]),
    ("Unlicense-text", ["UNLICENSE_FREE", "UNLICENSE_USE"]),
    ("Zlib-text", ["ZLIB_WARRANTY", "ZLIB_GRANT"]),
    ("BSL-1.0-text", ["BOOST_GRANT"]),
    ("WTFPL-text", ["WTFPL_COPY"]),
    ("EPL-2.0-notice", ["EPL2_NOTICE"]),
]
RULES += [(spdx, [REF[spdx]]) for spdx in LICENCES if [REF[spdx]] not in [seq for _, seq in RULES]]


def normalise(sentence: str) -> str:
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in sentence.lower()).split())


def known_sentences(sentences=SENTENCES) -> list[tuple[str, str]]:
    """``(normalised, identifier)``, split as texts are, so a full stop inside a
    known sentence cannot hide it."""
    return list(dict((normalise(s), i) for i, s in sentences).items())


def marked(text: Column) -> Column:
    """Normalised text: ``|`` at sentence ends and blank lines, ``/`` at other newlines."""
    t = F.regexp_replace(F.translate(F.lower(text), "\x01", " "), TERMINATOR, "\x01")
    t = F.regexp_replace(t, "[^a-z0-9\x01\n]+", " ")
    t = F.regexp_replace(F.regexp_replace(t, " ?\n ?", "\n"), "\n\n+", "\x01")
    t = F.regexp_replace(F.regexp_replace(t, "[ \n]?\x01[ \n\x01]*+", " | "), "\n", " / ")
    return F.concat(F.lit("| "), F.trim(t), F.lit(" |"))


def _alternatives(sentences: list[str]) -> str:
    """One pattern for all ``sentences``, common beginnings written once, a longer sentence before its beginning."""
    tree: dict = {}
    for s in sentences:
        at = tree
        for w in s.split():
            at = at.setdefault(w, {})
        at[""] = {}

    def branch(word: str, below: dict) -> str:
        after = {w: b for w, b in below.items() if w}
        if not after:
            return word
        rest = f"(?: /)? {either(after)}"
        return f"{word}(?:{rest})?" if "" in below else word + rest

    def either(words: dict) -> str:
        out = [branch(w, below) for w, below in words.items()]
        return out[0] if len(out) == 1 else f"(?:{'|'.join(out)})"

    return either(tree)


def _pattern(sentences: list[str], texts: list[str]) -> str:
    """Matches in ``marked`` text: complete sentences anywhere, known ones between marks."""
    both = [f"{_alternatives(texts)}(?= )"] if texts else []
    both += [f"(?<=[|/] ){_alternatives(sentences)}(?= [|/])"] if sentences else []
    return f"(?<= )(?:{'|'.join(both)})"


def _marker_words(sentences) -> list[str]:
    """Few words such that every sentence holds one of them."""
    left, out = [set(s.split()) for s in sentences], []
    while left:
        times = Counter(w for words in left for w in words)
        out.append(max(times, key=lambda w: (len(w) >= 6, times[w], w)))
        left = [words for words in left if out[-1] not in words]
    return out


def scan_licenses(docs: DataFrame, sentences=SENTENCES, rules=RULES, text_col: str = "text", id_col: str = "doc_id",
                  texts=TEXTS) -> DataFrame:
    """One row per document: ``doc_id, sentence_ids, licenses`` (arrays in text and rule order).

    Null and empty texts have neither; whole texts are read; repeated rows repeat
    their answer; an empty table gives no rows; other columns are ignored."""
    known, whole = known_sentences(sentences), [(normalise(s), ids) for ids, s in texts]
    ids_of = {s: (i,) for s, i in known} | dict(whole)
    # one literal for the table of sentences: normalised ones hold letters, digits and spaces only
    lookup = F.str_to_map(F.lit(";".join(f"{s}={' '.join(ids)}" for s, ids in ids_of.items()) or ";"), F.lit(";"), F.lit("="))
    text = text_of(text_col)
    # texts without a marker word need no closer look
    near = reduce(or_, [F.lower(text).contains(w) for w in _marker_words(ids_of)], F.lit(False))
    found = F.regexp_extract_all(marked(text), F.lit(_pattern([s for s, _ in known], [s for s, _ in whole])), F.lit(0))
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.when(near, found).otherwise(F.array().cast("array<string>")).alias("__s"))
    names = F.flatten(F.transform("__s", lambda s: F.split(F.element_at(lookup, F.replace(s, F.lit(" /"), F.lit(""))), " ")))
    ids = base.select("doc_id", names.alias("sentence_ids"))
    line = F.concat(F.lit(" "), F.array_join("sentence_ids", " "), F.lit(" "))
    found = [F.when(line.rlike(" " + " (?:[^ ]+ )*?".join(seq) + " "), F.lit(name)) for name, seq in rules]
    return ids.select("doc_id", "sentence_ids", F.array_distinct(F.array_compact(F.array(*found))).alias("licenses"))
