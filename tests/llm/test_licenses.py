import math
import re
import textwrap

import pytest
from helpers import AWKWARD, documents, prose
from random import Random

from stratalake.llm import licenses


def test_no_template_is_confirmed_without_a_telling_word():
    for texts in licenses.TEMPLATES.values():
        for text in texts:
            words = re.findall(r"\w+", text.lower().replace("_", " "))
            k = min(5, len(words))
            all_ = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
            blank = {s for s in all_ if not any(t in " ".join(s) for t in licenses.TELLING)}
            assert len(blank) < 0.8 * len(all_), text


@pytest.fixture(scope="module")
def corpus(spark):
    rng = Random(6)
    rows = [(i, "\n".join(prose(rng, 20, 500) for _ in range(3)), "a") for i in range(10, 130)]
    rows += [
        (200, "intro words here\nReleased under the MIT License.", "a"),
        (201, "Licensed under the Apache License, Version 2.0.\n" * 2, "a"),
        (202, "THIS WORK IS LICENSED under the GNU general public license; version 3", "a"),
        (203, "he lost his driving license on monday near the big river bank", "a"),
        (204, "ask for permission", "a"),
        (205, "Licensed under CC BY-NC 4.0.", "a"),
        (206, "Licensed under CC BY-SA 4.0.", "a"),
        *AWKWARD,
    ]
    return documents(spark, rows, extra=("paragraph", "family", "words", "features"))


def test_scan(corpus):
    model = licenses.fit_licenses(corpus)
    got = licenses.scan_licenses(corpus, model).collect()
    named = {(r.doc_id, r.paragraph): r.family for r in got if r.confirmed}
    assert named == {
        (200, 1): "MIT", (201, 0): "Apache-2.0", (201, 1): "Apache-2.0", (202, 0): "GPL-3.0", (205, 0): "CC-BY-NC-4.0", (206, 0): "CC-BY-SA-4.0",
    }
    assert {r.doc_id for r in got if not r.confirmed} == {203, 204}
    assert all(0 <= r.probability <= 1 for r in got)
    assert all(r.similarity is None for r in got if r.family == licenses.UNKNOWN)
    assert licenses.scan_licenses(corpus.limit(0), model).collect() == []


def test_short_forms_and_identifiers(spark, corpus):
    texts = [
        "Released under CC BY 4.0", "# SPDX-License-Identifier: MIT", "// SPDX-License-Identifier: Apache-2.0",
        "/* SPDX-License-Identifier: GPL-3.0-or-later */", "SPDX-License-Identifier: AGPL-3.0-only",
        "distributed\nunder CC0 1.0", "Released under the MIT License", "the album was released under a new name",
        "food distributed under the new plan reached all of the towns",
    ]
    found = confirmed(spark, corpus, texts)
    want = ["CC-BY-4.0", "MIT", "Apache-2.0", "GPL-3.0", "AGPL-3.0", "CC0-1.0", "MIT"]
    assert found == [(i, 0, family) for i, family in enumerate(want)]


def test_telling_words_of_prose_stay_unknown(spark):
    rng = Random(5)
    said = [
        "he renewed his driving license at the {} office", "she asked for permission to leave the {} early",
        "the software of the {} was slow", "they modified the {} again", "the {} was released under a new name",
    ]
    rows = [(i, rng.choice(said).format(prose(rng, 3)) + " " + prose(rng, rng.randrange(4, 30)), "a") for i in range(900)]
    model = licenses.fit_licenses(documents(spark, rows[:300]))
    got = licenses.scan_licenses(documents(spark, rows[300:]), model).collect()
    assert len(got) == 600 and not any(r.confirmed for r in got)
    named = [(r.family, r.probability) for r in got if r.family != licenses.UNKNOWN]
    assert len(named) <= 0.03 * len(got), (model.threshold, named)


def confirmed(spark, corpus, texts):
    model = licenses.fit_licenses(corpus)
    docs = documents(spark, [(i, t, "a") for i, t in enumerate(texts)], extra=("block", "family", "words"))
    rows = licenses.scan_licenses(docs, model).where("confirmed").collect()
    return sorted((r.doc_id, r.paragraph, r.family) for r in rows)


def test_notices_inside_long_lines_and_two_on_one(spark, corpus):
    rng = Random(8)
    middle = [(family, max(texts, key=len)) for family, texts in licenses.TEMPLATES.items()]
    # The longest notice of each family amid 5,000 words, and a short one; then pairs on one line.
    texts = [f"{prose(rng, 2500, 3000)} {text} {prose(rng, 2500, 3000)}" for _, text in middle]
    texts.append(f"{prose(rng, 2500, 3000)} Released under the MIT License. {prose(rng, 2500, 3000)}")
    texts.append(f"{middle[0][1]} {prose(rng, 20)} {middle[2][1]}")
    texts.append("Licensed under the MIT License. Licensed under CC BY 4.0.")
    texts.append(f"{middle[2][1]} {prose(rng, 20)} {middle[3][1]}")
    n = len(middle)
    assert confirmed(spark, corpus, texts) == sorted(
        [(i, 0, family) for i, (family, _) in enumerate(middle)]
        + [(n, 0, "MIT"), (n + 1, 0, "GPL-3.0"), (n + 1, 0, "MIT"), (n + 2, 0, "CC-BY-4.0"), (n + 2, 0, "MIT")]
        + [(n + 3, 0, "GPL-2.0"), (n + 3, 0, "GPL-3.0")]
    )


def test_notices_wrapped_at_72_columns(spark, corpus):
    long = [(family, text) for family, texts in licenses.TEMPLATES.items() for text in texts if len(text) > 72]
    wrapped = ["\n".join(textwrap.wrap(text, 72)) for _, text in long]
    texts = [f"some intro\r\n \t\n{w}\n\nmore words" for w in wrapped]
    texts.append("words of the file\n" + "\n".join(f" * {line}" for line in wrapped[0].split("\n")))
    expected = [(i, 2, family) for i, (family, _) in enumerate(long)] + [(len(long), 0, long[0][0])]
    assert confirmed(spark, corpus, texts) == expected
    # Over a blank line nothing is joined.
    assert confirmed(spark, corpus, [w.replace("\n", "\n\n") for w in wrapped if "GNU General" in w]) == []


def test_fits_on_an_empty_table(spark):
    empty = documents(spark, [])
    model = licenses.fit_licenses(empty)
    assert licenses.scan_licenses(empty, model).collect() == []


def test_all_windows_with_telling_words_are_learned_from(spark, monkeypatch):
    rng = Random(11)
    rows = [(i, f"the license of number{i} " + prose(rng, 6), "a") for i in range(2000)]
    seen = {}

    def kept(df, purpose):
        seen[purpose] = df.count()
        return stored(df, purpose)

    stored = licenses.stored
    monkeypatch.setattr(licenses, "stored", kept)
    licenses.fit_licenses(documents(spark, rows))
    assert seen["license-strays"] == 2000


def test_threshold_lets_through_at_most_the_false_share():
    counts = {s: 1 for s in range(1000)}
    assert licenses._threshold(counts) == 990 / licenses.STEPS
    assert licenses._threshold({}) == 0.5 and licenses._threshold({5: 10}) == 6 / licenses.STEPS


def test_few_sums_of_a_gradient_reach_the_driver(corpus, monkeypatch):
    asked = []
    fit = licenses.LogisticRegression.fit
    monkeypatch.setattr(licenses.LogisticRegression, "fit", lambda self, *a: asked.append(self.getAggregationDepth()) or fit(self, *a))
    licenses.fit_licenses(corpus)
    # Spark stops to sum once no more than about this many are left.
    assert [math.ceil(211 ** (1 / depth)) for depth in asked] == [4]
