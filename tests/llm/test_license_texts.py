"""License scans of the genuine texts, wrapped and on one line."""
import textwrap

import pytest

from medallion.llm import license_rules as lr

from .common import simple

MIT = ["MIT License", "Copyright (c) 2020 Jane Doe",
       "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
       "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
       "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
       "Software is furnished to do so, subject to the following conditions:",
       "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
       "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
       "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
       "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY."]
GPL = ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
       "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
       "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
       "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."]
BSD = ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
       "conditions are met:",
       "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
       "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
       "disclaimer in the documentation and/or other materials provided with the distribution.",
       "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."]
APACHE = ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
          "License. You may obtain a copy of the License at", "    http://www.apache.org/licenses/LICENSE-2.0",
          "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
          "\"AS IS\" BASIS."]
WANT = {"MIT": (["MIT_GRANT", "MIT_NOTICE", "AS_IS"], ["MIT-text"]), "GPL": (["GPL_GRANT", "GPL_WARRANTY"], ["GPL-notice"]),
        "BSD": (["BSD_GRANT", "BSD_SOURCE", "BSD_BINARY"], ["BSD-2-Clause"]),
        "APACHE": (["APACHE2_REF", "APACHE2_USE", "APACHE2_COPY"], ["Apache-2.0", "Apache-2.0-notice"])}


def forms(parts):
    wrapped = "\n\n".join(textwrap.fill(p, 70) for p in parts)
    yield wrapped
    yield "\n\n".join(textwrap.fill(p, 31) for p in parts)
    yield wrapped.replace("\n", "\r\n")
    yield "\n".join(textwrap.fill(p, 70) for p in parts)       # no blank lines
    yield " ".join(p.strip() for p in parts)                   # one line
    for mark in ("# ", "// ", " * "):
        yield "#!/bin/sh\n" + "\n".join(mark + x for x in wrapped.split("\n")) + "\nint main() { return 0; }"
    yield wrapped.replace("1. ", "* ").replace("2. ", "* ")
    yield f"Words before. {' '.join(parts)} Words after."


@pytest.mark.parametrize("name", list(WANT))
def test_genuine_texts_are_found(spark, name):
    texts = list(forms({"MIT": MIT, "GPL": GPL, "BSD": BSD, "APACHE": APACHE}[name]))
    got = {r.doc_id: (r.sentence_ids, r.licenses) for r in lr.scan_licenses(simple(spark, texts)).collect()}
    assert got == {i: WANT[name] for i in range(len(texts))}


def test_references_may_be_wrapped_but_must_fill_their_sentence(spark):
    texts = ["Licensed under the Apache\nLicense, Version 2.0.", "x\nLicensed under CC BY 4.0\ny", "It is licensed under CC BY 4.0",
             "All rights\n\nreserved", "a | b / c. all rights reserved! d", " ".join(MIT).replace("sublicense", "rent"), "\x01 / | . \n\n .", "." * 9000]
    got = {r.doc_id: r.licenses for r in lr.scan_licenses(simple(spark, texts)).collect()}
    assert got == {0: ["Apache-2.0"], 1: ["CC-BY-4.0"], 2: [], 3: [], 4: ["all-rights-reserved"], 5: [], 6: [], 7: []}


ISC = ["ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
       "granted, provided that the above copyright notice and this permission notice appear in all copies.",
       "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
       "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE."]
MPL = ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
       "this file, You can obtain one at http://mozilla.org/MPL/2.0/."]
LGPL = [GPL[0].replace("GNU General", "GNU Lesser General"), GPL[1]]
AGPL = [GPL[0].replace("GNU General", "GNU Affero General"), GPL[1]]
BSD3 = [*BSD[:3], "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.", BSD[3]]
MORE = {"ISC": (ISC, ["ISC-text"]), "MPL": (MPL, ["MPL-2.0-notice"]), "LGPL": (LGPL, ["LGPL-3.0-notice"]), "AGPL": (AGPL, ["AGPL-3.0-notice"]),
        "BSD3": (BSD3, ["BSD-2-Clause", "BSD-3-Clause-text"]), "0BSD": ([ISC[1].split(", provided")[0] + ".", ISC[2]], ["0BSD-text"])}


def test_more_genuine_texts(spark):
    """A BSD-3 text also meets the rule of BSD-2, whose conditions it holds."""
    texts = [(name, t) for name, (parts, _) in MORE.items() for t in forms(parts) if name != "BSD3" or "3. " in t]
    got = {r.doc_id: r.licenses for r in lr.scan_licenses(simple(spark, [t for _, t in texts])).collect()}
    assert got == {i: MORE[name][1] for i, (name, _) in enumerate(texts)}


def test_every_licence_by_tag_and_by_name(spark):
    assert len(lr.LICENCES) >= 40
    cases = [(spdx, form.format(spdx)) for spdx in lr.LICENCES
             for form in ("SPDX-License-Identifier: {}", "#!/bin/sh\n# SPDX-License-Identifier: {}\nset -e", "/* spdx-license-identifier: {} */\nint x;")]
    cases += [(spdx, f"About.\nThis project is licensed under the {name}.\nMore.") for spdx, names in lr.LICENCES.items() for name in names]
    cases += [(None, t) for t in ("SPDX-License-Identifier: MIT-like", "We like the MIT License", "licensed under a license", "SPDX-License-Identifier:")]
    got = {r.doc_id: r.licenses for r in lr.scan_licenses(simple(spark, [t for _, t in cases])).collect()}
    assert got == {i: [spdx] if spdx else [] for i, (spdx, _) in enumerate(cases)}
