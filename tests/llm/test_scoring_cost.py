import tracemalloc

import numpy as np

from tidelog.llm import toxicity

LETTERS = "abcdefghijklmnopqrstuvwxyzäöüßéèçñóíøåæœąęłśżźčšž"


def _words(n, length, seed):
    rng = np.random.default_rng(seed)
    return ["".join(w) for w in rng.choice(list(LETTERS), (n, length))]


def test_a_word_reads_its_own_subsequences_only():
    """Not a row of all subsequences that the landmarks have (some 20,000 here: 40 MB for 256 words)."""
    kernel = toxicity.WordKernel(_words(128, 14, 1))
    words = _words(512, 9, 2)
    kernel.apply(words[:1])
    tracemalloc.start()
    try:
        kernel.apply(words)
        assert len(kernel.matrix) > 15_000 and tracemalloc.get_traced_memory()[1] < 10_000_000
    finally:
        tracemalloc.stop()


def test_a_word_scores_the_same_in_any_company():
    kernel = toxicity.WordKernel(_words(128, 7, 3) + ["grumblork"])
    words = [w for n in (1, 4, 9, 9, 24) for w in _words(150, n, 4)] + ["grumblork", "a𝔘b", "zzzz", "一二"]
    together = kernel.apply(words)
    assert np.array_equal(together[::-1], kernel.apply(words[::-1]))
    assert all(np.array_equal(together[i], kernel.apply([words[i]])[0]) for i in range(0, len(words), 7))
    assert together[words.index("grumblork"), -1] == np.float32(1) or abs(together[words.index("grumblork"), -1] - 1) < 1e-5


def test_words_without_the_marks_around_them():
    text = "The, (the) 'the' the... _the_ don't a_b x2 2x 42 --- ¿qué? “so” l'été ** " + "n" * 30 + "! N.N. i d i o t"
    assert toxicity.words_of(text) == {"the": 5, "dont": 1, "ab": 1, "x": 2, "qué": 1, "so": 1, "lété": 1, "n" * 24: 1, "n" * 18: 1, "nn": 1, "idiot": 1,
                                       "i": 2, "d": 1, "o": 1, "t": 1}
