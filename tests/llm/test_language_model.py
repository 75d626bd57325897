"""The language model's kernel, Nyström map and ridge regression against the plain formulas."""

import random

import numpy as np
import pytest

from ripplelog.llm import language_id

WORDS = {"en": ["the", "of", "and", "thing", "Whole", "with"], "de": ["der", "die", "größe", "nicht", "Zeit", "schön"], "fr": ["le", "les", "être", "où", "ça", "pas"]}


def texts(n, seed):
    rng = random.Random(seed)
    return [(" ".join(rng.choice(WORDS[lang]) for _ in range(rng.randrange(2, 9))) + rng.choice(["", ".", " 12"]), lang) for lang in list(WORDS) * n]


def grams(text):
    """All runs of one to three byte classes."""
    classes = language_id.byte_classes()[np.frombuffer(text.encode(), np.uint8)].tolist()
    return {tuple(classes[i : i + n]) for n in (1, 2, 3) for i in range(len(classes) - n + 1)}


def kernel(a, b):
    return np.array([[len(x & y) / (len(x) * len(y)) ** 0.5 for y in b] for x in a])


@pytest.mark.parametrize("landmarks", [1000, 12])
def test_scores_are_those_of_weighted_ridge_regression_on_landmarks(landmarks):
    rows, ridge = texts(9, 1), 0.1
    model = language_id.fit(rows, landmarks, ridge)
    languages = sorted(WORDS)
    assert model.languages == languages
    sets, of = [grams(t) for t, _ in rows], np.array([languages.index(lang) for _, lang in rows])
    marks = [i for k in range(3) for i in np.flatnonzero(of == k)[: landmarks // 3]]
    signs = np.where(of[:, None] == np.arange(3), 1.0, -1.0)
    weigh = 1 / np.bincount(of)[of]  # every language weighs the same
    km, kmm = kernel(sets, [sets[i] for i in marks]), kernel([sets[i] for i in marks], [sets[i] for i in marks])
    left = km.T @ (weigh[:, None] * km) + ridge / len(rows) * kmm
    solved = np.linalg.lstsq(left, km.T @ (weigh[:, None] * signs), rcond=1e-10)[0]
    asked = texts(4, 2) + [("日本 new 7", "")]
    expected = kernel([grams(t) for t, _ in asked], [sets[i] for i in marks]) @ solved
    data, ends = language_id._bytes([t for t, _ in asked])
    assert np.abs(model.scores(data, ends) - expected).max() < 2e-3
    if landmarks >= len(rows):  # with all texts as landmarks it is the regression on the whole kernel
        alpha = np.linalg.solve(kernel(sets, sets) + ridge / len(rows) * np.diag(1 / weigh), signs)
        assert np.abs(kernel([grams(t) for t, _ in asked], sets) @ alpha - expected).max() < 1e-4
