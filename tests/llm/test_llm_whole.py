"""Whole jobs: dense data, real notices, several kinds of secrets, many languages."""

import brute
import numpy as np
import pytest
from callweave.llm import embed, langid, licenses, secrets


@pytest.mark.parametrize("spread,exact", [(0.25, False), (0.12, True)])
def test_embeddings_of_one_topic(spark, monkeypatch, spread, exact):
    """A third of the rows in one topic: pairs among them are met as in even data, or all pairs are compared."""
    taken, plain = [], embed._cell_links
    monkeypatch.setattr(embed, "_cell_links", lambda keys, threshold: taken.append(keys) or plain(keys, threshold))
    rng = np.random.default_rng(11)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    n, dim, pairs = 12000, 64, 400
    topic = unit(rng.standard_normal(dim) / np.sqrt(dim) + spread / np.sqrt(dim) * rng.standard_normal((n // 3, dim)) * 2)
    x = np.concatenate([topic, unit(rng.standard_normal((n - len(topic), dim)))])
    of = rng.choice(len(topic), pairs, replace=False)
    aside = rng.standard_normal((pairs, dim))
    aside = unit(aside - (aside * x[of]).sum(1, keepdims=True) * x[of])
    x = np.concatenate([x, 0.9502 * x[of] + np.sqrt(1 - 0.9502**2) * aside])
    near = [np.flatnonzero(x @ v >= 0.95).tolist() for v in x]
    links = [(a, b) for a, bs in enumerate(near) for b in bs if a < b]
    root = brute.smallest(len(x), links)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {r[0]: (r[1], r[2]) for r in embed.near_duplicates(df, recall=0.9999).collect()}
    assert got == {i: (len(near[i]) - 1, root[i]) for i in range(len(x))}
    assert (taken == [["dim"]]) == exact


GPL3_HEADER = """Copyright (C) 2021  Jane Roe

This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""
MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/."""
APACHE_HEADER = """Copyright 2020 The Authors

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
MIT_TEXT = """Copyright (c) 2019 A. N. Author

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do
so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""


def test_licenses_of_several_lines(spark):
    mark = lambda text, sign: "\n".join(f"{sign} {x}".rstrip() for x in text.split("\n"))
    code = "\n\nimport os\n\ndef f(x):\n    return os.getenv(x)\n"
    gpl2 = GPL3_HEADER.replace("version 3", "version 2")
    whole = licenses.full_texts()
    rows = [
        ("a/gpl.py", mark(GPL3_HEADER, "#") + code, "GPL-3.0"),
        ("a/gpl.c", "/*\n" + mark(GPL3_HEADER, " *") + "\n */\nint main() {}\n", "GPL-3.0"),
        ("a/plain.c", "/*\n" + GPL3_HEADER + "\n*/\nint main() {}\n", "GPL-3.0"),
        ("a/gpl2.sql", mark(gpl2, "--") + code, "GPL-2.0"),
        ("a/lgpl.h", mark(GPL3_HEADER.replace("GNU General", "GNU Lesser General"), "//") + code, "LGPL-3.0"),
        ("a/agpl.h", mark(GPL3_HEADER.replace("GNU General", "GNU Affero General"), "//") + code, "AGPL-3.0"),
        ("a/mpl.js", mark(MPL_HEADER, "//") + code, "MPL-2.0"),
        ("a/apache.py", "#!/usr/bin/env python\n" + mark(APACHE_HEADER, "#") + code, "Apache-2.0"),
        ("a/mit.py", '"""' + MIT_TEXT + '"""' + code, "MIT"),
        ("a/one_line.py", "# " + " ".join(MIT_TEXT.split()) + code, "MIT"),
        ("a/code.py", "# Copyright (c) 2019 A. N. Author\n# reads the licence key of a customer" + code, None),
        ("g/LICENSE", whole["GPL-3.0|text"], "GPL-3.0"),
        ("l/COPYING", whole["LGPL-3.0|text"], "LGPL-3.0"),
        ("m/LICENSE", MIT_TEXT.split("\n\n", 1)[1], "MIT"),
        ("p/LICENSE", whole["Apache-2.0|text"], "Apache-2.0"),
    ]
    heirs = [("g/x/y.py", "GPL-3.0"), ("l/y.py", "LGPL-3.0"), ("m/y.py", "MIT"), ("p/q/r/y.py", "Apache-2.0")]
    df = spark.createDataFrame([(i, t, p) for i, (p, t) in enumerate([(p, t) for p, t, _ in rows] + [(p, "x = 1") for p, _ in heirs])], "doc_id long, text string, path string")
    got = {r["path"]: (r["own_license"], r["license"]) for r in licenses.scan(df).collect()}
    assert got == {p: (x, x) for p, _, x in rows} | {p: (None, x) for p, x in heirs}


def test_secrets_of_many_forms(spark):
    rng = np.random.default_rng(5)
    made = lambda letters, n: "".join(rng.choice(list(letters), n))
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    alnum = upper + lower + digits
    real = {
        "aws": f"key {(aws := 'AKIA' + made(upper + digits, 16))} end",
        "github": f"use {(hub := 'ghp_' + made(alnum, 36))} here",
        "jwt": f"got {(jwt := 'eyJ' + made(alnum, 20) + '.eyJ' + made(alnum, 30) + '.' + made(alnum, 40))} back",
        "base64": f'api_key = "{(b64 := "aA1" + made(alnum + "+/", 37))}"',
        "hex32": f"secret: '{(h32 := made('0123456789abcdef', 32))}'",
        "hex64": f'"token":"{(h64 := made("0123456789abcdef", 64))}",',
        "short": 'password = "hunter2"',
        "signs": "DB_PASSWORD=p@ss!w0rd#1",
        "option": "mysql --password s3cr3t!x db",
    }
    want = {"aws": aws, "github": hub, "jwt": jwt, "base64": b64, "hex32": h32, "hex64": h64, "short": "hunter2", "signs": "p@ss!w0rd#1", "option": "s3cr3t!x"}
    none = ["see https://www.example.org/some/long/path/index.html for it", "internationalization of responsibilities", "open src/main/resources/application.properties now"]
    rows = [(k, t, "a") for k, t in real.items()] + [(f"none{i}", t, "a") for i, t in enumerate(none)] + [("odd", "digest " + made("0123456789abcdef", 40), "a")]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string")
    told = {}
    for r in secrets.labelled_findings(docs).collect():
        told.setdefault(r["id"], []).append((r["candidate"], r["secret"]))
    assert {k: told[k] for k in real} == {k: [(v, 1)] for k, v in want.items()}
    assert all(x == 0 for i in range(len(none)) for _, x in told[f"none{i}"])
    assert [x for _, x in told["odd"]] == [None]
    flagged = lambda model: {r["doc_id"] for r in secrets.scan(docs, model, path_col="source").collect() if r["is_secret"]}
    assert flagged(None) == set(real)
    assert {"aws", "github", "jwt", "base64", "hex32", "hex64"} <= flagged(secrets.train(secrets.labelled_findings(docs)))


def test_many_languages_keep_their_contexts(spark, monkeypatch):
    rng = np.random.default_rng(3)
    grams = {}
    for i in range(18):
        # scripts of all kinds: 195 different bytes
        text = np.concatenate([[10] * langid.ORDER, rng.integers(60, 255, 3000 if i else 200)]).astype(np.int64)
        g, n = np.unique(sum(text[langid.ORDER - k : len(text) - k] << (8 * k) for k in range(langid.ORDER + 1)), return_counts=True)
        grams[f"l{i:02}"] = (g, n)
    model = langid.frozen(list(grams), grams)
    for text in ("abcdefgh", "zé漢字 <=>", "~" * 50):
        for j, (g, n) in enumerate(grams.values()):
            if j in (0, 7):
                plain = {int(x).to_bytes(langid.ORDER + 1, "big"): int(c) for x, c in zip(g, n)}
                got = langid.code_lengths(text.encode(), model, model.index(), chunk=5)[j]
                if all(60 <= b < 255 for b in text.encode()):
                    assert got == pytest.approx(brute.code_bits(text, plain, langid.ORDER), rel=1e-6)
    few = {x: (np.arange(40) * 7919 % (1 << 32), np.arange(1, 41)) for x in "ab"}
    dense = langid.frozen(["a", "b"], few)
    monkeypatch.setattr(langid, "MAX_CELLS", 10)
    sparse = langid.frozen(["a", "b"], few)
    assert (type(dense), type(sparse)) == (langid.Model, langid.Sparse)
    for text in ("", "abc", "zé漢字 <=>\n\n"):
        assert langid.code_lengths(text.encode(), sparse, None) == pytest.approx(langid.code_lengths(text.encode(), dense, dense.index()), rel=1e-5)
    rows = [(f"{i % 205:03}", f"{chr(0x4E00 + i % 205) * 5} word{i % 205}") for i in range(410)]
    model = langid.train(spark.createDataFrame(rows, "lang string, text string"))
    assert len(model.langs) == 205
    told = langid.predict(spark.createDataFrame(rows, "lang string, text string"), model).collect()
    assert all(r["lang"] == r["lang_pred"] for r in told)
