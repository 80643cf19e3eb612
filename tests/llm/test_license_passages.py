"""Licence notices that are no physical line, and whole licences."""

import random
import textwrap

from kinfold.llm import license

BSD = dict(license.BODIES)["BSD-3-Clause"]
GPL = dict(license.BODIES)["GPL-3.0"]


def test_notices_over_lines_and_inside_lines(spark):
    notice = next(t for n, t in license.TEMPLATES if n == "BSD-3-Clause" and t.startswith("Redistribution"))
    mit = next(t for n, t in license.BODIES if n == "MIT").split("\n")[0]
    rows = [
        (1, "def f(): pass\n" + "\n".join(textwrap.wrap(notice, 76)) + "\nmore of the text"),
        (2, mit),
        (3, "The code is released under the MIT License and comes without warranty."),
        (4, "Copyright (c) 2020 Acme Inc. All rights reserved."),
        (5, "A preface.\n" + "\n".join(textwrap.wrap("Copyright (c) 2020, Acme Inc.\n" + BSD, 60)) + "\nimport os"),
        (6, "rights all reserved. " * 50),
        (7, GPL.replace("\n", " ")),
        (8, "\n".join(["All rights", "reserved. Then all other things were said.", "All rights reserved."])),
    ]
    got = {r["doc_id"]: (r["n_matches"], r["licenses"].split(","), r["dice"]) for r in license.op9_license(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1][0] == 1 and got[1][1] == ["BSD-3-Clause"] and got[1][2] == 1
    assert "MIT" in got[2][1] and got[3] == (1, ["MIT"], 1.0) and got[4] == (1, ["Proprietary"], 1.0)
    assert "BSD-3-Clause" in got[5][1] and got[5][2] > 0.99
    assert got[6] == (0, [""], 0.0) and "GPL-3.0" in got[7][1] and got[8] == (2, ["Proprietary"], 1.0)


def test_every_window_against_brute_force():
    r = random.Random(5)
    words = "a b c d e f".split()
    for _ in range(300):
        least = r.choice((0.6, 0.8))
        known = license.Templates([(str(i), " ".join(r.choices(words, k=r.randint(3, 7)))) for i in range(3)], least)
        text = [w.encode() for w in r.choices(words, k=r.randint(0, 25))]
        want = {}
        for t, own in enumerate(known.own):
            for i in range(len(text)):
                for j in range(i + 2, len(text) + 1):
                    g = set(zip(text[i:j], text[i + 1 : j], strict=False))
                    d = 2 * len(g & own) / (len(g) + len(own))
                    if d >= least:
                        want[t] = max(want.get(t, 0), d)
        got = {}
        for d, _, _, t in known.passages(text, known.possible(text)) if known.possible(text) else []:
            got[t] = max(got.get(t, 0), d)
        assert got == want
