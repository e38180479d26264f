"""License scans: neighbouring licenses are told apart, and the banded search equals the full one."""

import random

import numpy as np
import pytest

from gleaner.llm import licenses
from gleaner.llm.licenses import Index, Template, default_templates, scan

INDEX = Index.of(default_templates())


def found(text):
    return [m.license_id for m in scan(f"Some words in front. {text} And some words behind.", INDEX)]


@pytest.mark.parametrize("template", default_templates(), ids=lambda t: f"{t.license_id}-{len(t.text)}")
def test_every_template_is_found_as_itself(template):
    assert found(template.text) == [template.license_id]
    assert found(template.text.upper().replace(" ", "\n  ")) == [template.license_id]


@pytest.mark.parametrize(
    "text,want",
    [
        ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
        ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
        ("Licensed under CC BY-NC-ND 3.0.", "CC-BY-NC-ND-3.0"),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
        ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
        ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
        ("Licensed under the Apache License, Version 1.1.", "Apache-1.1"),
        (f"{licenses.BSD_OPENING}: * {licenses.BSD_CLAUSES.replace('2. ', '* ')} {licenses.BSD_DISCLAIMER}", "BSD-2-Clause"),
        (licenses.MIT.replace("Software", "Material"), "MIT"),
    ],
)
def test_neighbours_are_told_apart(text, want):
    assert found(text) == [want]


@pytest.mark.parametrize(
    "text",
    [
        "Licensed under CC BY-XX 9.9.",
        "This work is licensed under the GNU Lesser General Public License, version 9.",
        "Licensed under the Apache License, Version 3.0.",
        "the license of the version of the public terms",
    ],
)
def test_unknown_licenses_are_not_taken_for_others(text):
    assert found(text) == []


def best_local(template, words):
    """Matched words of the best local alignment over the whole matrix: 2 for equal words, -1 otherwise."""
    score = np.zeros((len(template) + 1, len(words) + 1), int)
    for i, a in enumerate(template, 1):
        for j, b in enumerate(words, 1):
            score[i, j] = max(0, score[i - 1, j - 1] + (2 if a == b else -1), score[i - 1, j] - 1, score[i, j - 1] - 1)
    return score.max()


def value(template, words, pairs):
    """Score of an alignment given by its matched pairs."""
    total = 0
    for k, (i, j) in enumerate(pairs):
        total += 2
        if k:
            total -= max(i - pairs[k - 1][0] - 1, j - pairs[k - 1][1] - 1)
    return total


def test_band_finds_the_best_alignment_of_every_template():
    """Words dropped, changed and put in, few enough to stay within the band."""
    random.seed(3)
    for template in default_templates():
        own = licenses._WORD.findall(template.text.lower())
        if len(own) > 120:
            own = own[:120]
        for _ in range(2):
            words = list(own)
            for _ in range(min(4, len(words) // 8)):
                k = random.randrange(len(words))
                random.choice([lambda: words.pop(k), lambda: words.__setitem__(k, "zz"), lambda: words.insert(k, "yy")])()
            pairs = licenses.align(own, ["aa", "bb", *words, "cc"], 2)
            assert all(own[i] == ["aa", "bb", *words, "cc"][j] for i, j in pairs)
            assert value(own, words, pairs) >= best_local(own, ["aa", "bb", *words, "cc"])


def test_own_templates_with_their_words():
    index = Index.of([Template("X-1", "the quick brown fox jumps over version 1", ("1",)), Template("empty", "")])
    assert [m.license_id for m in scan("the quick brown fox jumps over version 1", index)] == ["X-1"]
    assert scan("the quick brown fox jumps over version 2", index) == []
