import random

import pytest

from tessella.functions import similarity as S


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def slow_partial(a, b):
    if len(a) > len(b):
        a, b = b, a
    n, m = len(a), len(b)
    windows = {b[max(0, s) : min(m, s + n)] for s in range(1 - n, m)}
    return max(200 * slow_lcs(a, w) / (n + len(w)) for w in windows)


def test_lcs_and_partial_equal_definitions():
    rng = random.Random(11)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc d") for _ in range(rng.randint(1, 14))) for _ in range(2))
        assert S.lcs(a, b) == slow_lcs(a, b)
        assert S.partial_ratio(a, b) == pytest.approx(slow_partial(a, b))


def test_known_values():
    assert S.ratio("", "") == 100 and S.ratio("abc", "") == 0
    assert S.ratio("this is a test", "this is a test!") == pytest.approx(2 * 14 / 29 * 100)
    assert S.token_sort_ratio("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == 100
    assert S.token_set_ratio("a b c", "a b") == 100 and S.token_set_ratio("", "a") == 0
    assert S.partial_ratio("bear", "a brown bear!") == 100
    assert S.weighted_ratio("abc", "abc") == 100 and S.weighted_ratio("", "abc") == 0
    assert S.jaro_winkler("martha", "marhta") == pytest.approx(0.9611, abs=1e-4)
    assert S.jaro_winkler("abcd", "abxy") == pytest.approx(2 / 3, abs=1e-4)
    assert S.jaro_winkler("dixon", "dicksonx") == pytest.approx(0.8133, abs=1e-4)


def some_strings(rng, n):
    word = lambda: "".join(rng.choice("abcdeé 東") for _ in range(rng.choice([0, 1, 2, 3, 5, 9, 20])))
    a = [" ".join(word() for _ in range(rng.choice([0, 1, 2, 3, 4, 9]))) for _ in range(n)]
    b = [x if rng.random() < 0.1 else x[: len(x) // 2] + " ".join(word() for _ in range(3)) for x in a]
    return a + ["x" * 600 + "ab", "", "a", "😀 b"], b + ["ab" + "x" * 550, "", "", "b 😀"]


def test_batches_equal_scalars():
    rng = random.Random(17)
    for _ in range(15):
        a, b = some_strings(rng, 40)
        for many, one in ((S.lcs_many, S.lcs), (S.ratio_many, S.ratio), (S.partial_many, S.partial_ratio), (S.token_set_many, S.token_set_ratio), (S.jaro_winkler_many, S.jaro_winkler)):
            assert list(many(a, b)) == pytest.approx([one(x, y) for x, y in zip(a, b, strict=True)], abs=1e-9)
        for got, one in zip(S.five_many(a, b), S.FIVE, strict=True):
            assert list(got) == pytest.approx([one(x, y) for x, y in zip(a, b, strict=True)], abs=1e-9)


def test_columns_equal_scalars():
    import pandas as pd

    rng = random.Random(18)
    sides = [pd.Series(x) for _ in range(4) for x in some_strings(rng, 30)]
    got = S.similarities(*sides)
    assert list(got.columns) == list(S.COLUMNS)
    squeezed = lambda x: x.replace(" ", "")
    for i in range(len(got)):
        name, core, skel, addr = ((sides[2 * k][i], sides[2 * k + 1][i]) for k in range(4))
        six = lambda p: [*(f(*p) / 100 for f in S.FIVE), S.jaro_winkler(*p)]
        want = [*six(name), *six(core), S.ratio(*map(squeezed, core)) / 100, *(f(*skel) / 100 for f in S.FIVE[:4]), S.ratio(*map(squeezed, skel)) / 100]
        want += [S.ratio(*addr) / 100, S.token_set_ratio(*addr) / 100, S.partial_ratio(*addr) / 100]
        assert got.iloc[i].tolist() == pytest.approx(want, abs=1e-6)


def test_one_pass_gives_partial_and_whole_and_shared_words_are_not_compared():
    rng = random.Random(23)
    text = lambda: " ".join("".join(rng.choice("abcdé東") for _ in range(rng.randint(1, 9))) if rng.random() < 0.7 else rng.choice(("to", "be")) for _ in range(rng.choice((0, 1, 4, 12, 30))))
    a, b = [text() for _ in range(300)], [text() for _ in range(300)]
    part, whole = S.partial_and_lcs(a, b)
    assert whole.tolist() == [S.lcs(x, y) for x, y in zip(a, b, strict=True)]
    assert part.tolist() == pytest.approx([S.partial_ratio(x, y) for x, y in zip(a, b, strict=True)])
    assert S.token_set_many(a, b).tolist() == pytest.approx([S.token_set_ratio(x, y) for x, y in zip(a, b, strict=True)])
