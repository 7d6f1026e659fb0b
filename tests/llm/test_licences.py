from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tripengine.llm import licences

MIT, BSD, ZLIB = (licences.LICENCES[n] for n in ("MIT", "BSD-3-Clause", "Zlib"))
#: Published texts as some systems hold them.
SHARED = Path("/usr/share/common-licenses")


def _by_id(docs):
    found = {}
    for r in licences.scan(docs).collect():
        found.setdefault(r.doc_id, []).append((r.licence, r.n_notices, r.notices))
    return found


def test_texts_and_notices(docs_of):
    british = MIT.replace("License", "Licence").replace(",", " ;").upper()
    rows = [(1, MIT), (2, "Copyright (c) 2020 A. Person\n" + british), (3, MIT + " and more"),
            (4, "A text.\nReleased under the mit licence.\n  LICENSED UNDER CC BY-NC 4.0  "), (5, None), (6, ""),
            (7, "Released under the MIT License. Really."), (7, "Released under the MIT License. Really."),
            (None, "w " * 60_000)]
    found = _by_id(docs_of(rows))
    assert found[1] == [("MIT", 0, "")] and found[2] == [("MIT", 0, "")]
    assert found[3] == [(None, 0, "")]
    assert found[4] == [(None, 2, "CC-BY-NC-4.0,MIT")]
    assert found[5] == found[6] == found[None] == [(None, 0, "")]
    assert found[7] == [(None, 1, "MIT")] * 2


def test_headings_lines_and_owners_do_not_matter(docs_of):
    body = MIT.split("\n", 1)[1]
    reflowed = " ".join(body.split()).replace("copyright notice", "\ncopyright notice")
    bullets = BSD.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")
    owned = BSD.replace("the copyright holder nor", "Example Works, Inc. nor").replace("HOLDER OR", "OWNER OR")
    given = {"MIT": ["The MIT License (MIT)\n\nCopyright (c) 2001 B\nAll rights reserved.\n" + body, body, reflowed,
                     "Copyright Example, Inc. and others\n" + body],
             "BSD-3-Clause": ["BSD 3-Clause License\n" + BSD, bullets, owned],
             "Zlib": [ZLIB.split("\n", 1)[1]]}
    rows = [(i, text, name) for i, (name, text) in enumerate((n, t) for n, ts in given.items() for t in ts)]
    found = _by_id(docs_of([r[:2] for r in rows]))
    assert [found[i][0][0] for i, _, _ in rows] == [name for _, _, name in rows]


def test_notices_inside_sentences_and_over_lines(docs_of):
    given = [
        ("This is licensed under the GNU GPL, version 2.", "GPL-2.0"),
        ("It may be copied, being licensed under the Apache License, Version 2.0 (the \"License\"), by all.", "Apache-2.0"),
        ("# Licensed under the Apache\n# License, Version 2.0", "Apache-2.0"),
        ("redistribute it under the terms of the GNU General Public License as published by\n"
         "the Free Software Foundation, either version 3 of the License, or later", "GPL-3.0"),
        ("under the terms of the GNU Lesser General Public License v2.1", "LGPL-2.1"),
        ("released under the GNU Affero General Public License version 3", "AGPL-3.0"),
        ("subject to and under the terms of the Mozilla Public License, v. 2.0", ""),
        ("available under the Mozilla Public License 2.0; pictures under CC BY-SA 4.0", "CC-BY-SA-4.0,MPL-2.0"),
        ("dedicated under CC0 1.0 Universal", "CC0-1.0"), ("released under the Unlicense", "Unlicense"),
        ("// SPDX-License-Identifier: GPL-2.0-only\n// SPDX-License-Identifier: MIT", "GPL-2.0,MIT"),
        ("under Creative Commons Attribution-ShareAlike 3.0 Unported", "CC-BY-SA-3.0"),
        ("printed by the MIT Press; the Apache License is old; under the apache 20 tree", ""),
    ]
    given[6] = (given[6][0], "MPL-2.0")
    found = _by_id(docs_of([(i, text) for i, (text, _) in enumerate(given)]))
    assert [found[i][0][2] for i in range(len(given))] == [names for _, names in given]


def test_every_licence_has_a_digest_of_its_own(session, docs_of):
    rows = list(enumerate(licences.LICENCES.values()))
    found = licences.scan(docs_of(rows)).orderBy("doc_id").collect()
    assert [r.licence for r in found] == list(licences.LICENCES)
    assert not {r.canonical_sha256 for r in found} & set(licences.DIGESTS)
    assert licences.scan(docs_of([])).collect() == []


@pytest.mark.skipif(not SHARED.is_dir(), reason="no published texts on this system")
def test_published_texts(docs_of):
    names = {"Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0", "CC0-1.0": "CC0-1.0", "GPL-2": "GPL-2.0",
             "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0"}
    given = [(n, SHARED / f) for f, n in names.items() if (SHARED / f).is_file()]
    found = _by_id(docs_of([(i, path.read_text()) for i, (_, path) in enumerate(given)]))
    assert [found[i][0][0] for i in range(len(given))] == [n for n, _ in given]


def test_columns_whose_names_differ_in_case_only(docs_of):
    docs = docs_of([(1, MIT)]).withColumn("licence", F.lit("x")).withColumn("Digest", F.lit(None).cast("string"))
    assert [(r.doc_id, r.licence) for r in licences.scan(docs).collect()] == [(1, "MIT")]
