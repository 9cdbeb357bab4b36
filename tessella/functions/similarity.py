"""String similarities, 0 to 100 (Jaro-Winkler 0 to 1): scalars, and the same for whole batches of pairs.

``ratio`` is 200 * LCS / (len a + len b), where LCS is the longest common subsequence, found bit by bit: the
scalars use Python integers, the batches machine words, all pairs of a batch in step.
"""

from __future__ import annotations

import numpy as np
import pandas as pd


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence (bit-parallel: one integer step for each character of b)."""
    if a == b:
        return len(a)
    mask: dict[str, int] = {}
    for i, c in enumerate(a):
        mask[c] = mask.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & mask.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def ratio(a: str, b: str) -> float:
    n = len(a) + len(b)
    return 200.0 * lcs(a, b) / n if n else 100.0


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = x & y, x - y, y - x
    if both and (not left or not right):
        return 100.0
    common = " ".join(sorted(both))
    one = f"{common} {' '.join(sorted(left))}".strip()
    two = f"{common} {' '.join(sorted(right))}".strip()
    best = ratio(one, two)
    if both:
        best = max(best, ratio(common, one), ratio(common, two))
    return best


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string and a window of the longer one, windows cut at its ends included.

    Windows are tried by the number of characters they share with the shorter string, which bounds the
    subsequence; the search ends when no window left can do better.
    """
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    if a in b:
        return 100.0
    n, m = len(a), len(b)
    need: dict[str, int] = {}
    for c in a:
        need[c] = need.get(c, 0) + 1
    have = dict.fromkeys(need, 0)
    shared, bounds = 0, []
    for start in range(1 - n, m):
        end = start + n  # the window gains b[end - 1] and loses b[start - 1]
        if start > 0 and (c := b[start - 1]) in have:
            have[c] -= 1
            shared -= have[c] < need[c]
        if end <= m and (c := b[end - 1]) in have:
            shared += have[c] < need[c]
            have[c] += 1
        lo, hi = max(0, start), min(m, end)
        bounds.append((200.0 * shared / (n + hi - lo), lo, hi))
    bounds.sort(key=lambda x: -x[0])
    best = 0.0
    for bound, lo, hi in bounds:
        if bound <= best:
            break
        best = max(best, ratio(a, b[lo:hi]))
    return best


def partial_token_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    if x & y:
        return 100.0
    return max(partial_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))), partial_ratio(" ".join(sorted(x)), " ".join(sorted(y))))


def weighted_ratio(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    longer = max(len(a), len(b)) / min(len(a), len(b))
    whole = ratio(a, b)
    if longer < 1.5:
        return max(whole, 0.95 * max(token_sort_ratio(a, b), token_set_ratio(a, b)))
    scale = 0.9 if longer <= 8 else 0.6
    return max(whole, scale * partial_ratio(a, b), 0.95 * scale * partial_token_ratio(a, b))


def jaro_winkler(a: str, b: str) -> float:
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    taken = [False] * len(b)
    left = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                left.append(c)
                break
    m = len(left)
    if not m:
        return 0.0
    right = [c for j, c in enumerate(b) if taken[j]]
    swaps = sum(x != y for x, y in zip(left, right, strict=True)) // 2
    score = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if score > 0.7:
        head = 0
        for x, y in zip(a[:4], b[:4], strict=False):
            if x != y:
                break
            head += 1
        score += 0.1 * head * (1 - score)
    return score


FIVE = (ratio, token_sort_ratio, token_set_ratio, partial_ratio, weighted_ratio)
#: Columns of :func:`similarities`, in this order.
COLUMNS = (
    "name_ratio", "name_token_sort", "name_token_set", "name_partial", "name_wratio", "name_jaro",
    "core_ratio", "core_token_sort", "core_token_set", "core_partial", "core_wratio", "core_jaro", "core_concat_ratio",
    "skel_ratio", "skel_token_sort", "skel_token_set", "skel_partial", "skel_concat_ratio",
    "addr_ratio", "addr_token_set", "addr_partial",
)
#: Longest shorter string that is compared in machine words (longer ones go through the scalars), and bytes of masks at once.
LONGEST = 512
MASK_BYTES = 32 << 20


def _points(strings: list[str]) -> np.ndarray:
    return np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)


class Alphabet:
    """The characters of some strings, numbered from 1 through a table of all code points up to the largest."""

    def __init__(self, *strings: list[str]):
        found = [np.bincount(_points(x)) for x in strings]
        seen = np.zeros(max(map(len, found)), bool)
        for x in found:
            seen[: len(x)] |= x > 0
        self.number = np.cumsum(seen, dtype=np.int32)
        self.size = int(self.number[-1]) if len(seen) else 0


class Codes:
    """Strings as rows of character numbers (0 behind a string's end)."""

    def __init__(self, strings: list[str], alphabet: Alphabet):
        self.length = np.fromiter(map(len, strings), np.int64, len(strings))
        self.rows = np.zeros((len(strings), int(self.length.max(initial=0)) + 1), np.int32)
        self.rows[np.arange(self.rows.shape[1]) < self.length[:, None]] = alphabet.number[_points(strings)]


def _masks(rows: np.ndarray, length: np.ndarray, letters: int) -> np.ndarray:
    """Bit i of [pair, letter] tells whether the pair's pattern has the letter at place i."""
    longest = int(length.max(initial=0))
    words = max(1, -(-longest // 64))
    out = np.zeros((len(rows) * (letters + 1), words), np.uint64)
    places = np.ascontiguousarray((rows[:, :longest] + np.arange(0, len(out), letters + 1)[:, None]).T)
    for i in range(longest):
        out[places[i], i // 64] |= np.uint64(1 << i % 64)
    out = out.reshape(len(rows), letters + 1, words)
    out[:, 0] = 0  # no letter: behind the end
    return out


def _flat(masks: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The masks as one list, and by place in the other strings which of them each pair's letter has."""
    pairs, letters, words = masks.shape
    return masks.reshape(pairs * letters, words), np.ascontiguousarray((rows + np.arange(0, pairs * letters, letters)[:, None]).T)


def _step(v: np.ndarray, m: np.ndarray) -> np.ndarray:
    """One letter of the other string: the bits of ``v`` that stay are pattern places without a partner."""
    u = v & m
    s = v + u
    if v.shape[1] > 1:
        carry = s[:, 0] < u[:, 0]
        for w in range(1, v.shape[1]):
            own = s[:, w] < u[:, w]
            s[:, w] += carry
            carry = own | (carry & (s[:, w] == 0))
    return s | (v & ~m)


def _found(v: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Length of the subsequence: places of the pattern whose bits are gone (bits behind its end never go)."""
    return v.shape[1] * 64 - np.bitwise_count(v).sum(1, dtype=np.int64)


def _heads(length: np.ndarray, turns: int) -> list[int]:
    """How many of the lengths, longest first, are above each turn."""
    return np.searchsorted(-length, -np.arange(turns), "left").tolist()


def _by_chunks(length: np.ndarray, letters: int):
    """Slices of pairs whose masks fit MASK_BYTES."""
    words = max(1, -(-int(length.max(initial=0)) // 64))
    size = max(1, MASK_BYTES // (8 * words * (letters + 1)))
    for at in range(0, len(length), size):
        yield slice(at, at + size)


def lcs_many(a: list[str], b: list[str]) -> np.ndarray:
    """:func:`lcs` of each pair, all pairs one letter at a time."""
    out = np.zeros(len(a), np.int64)
    short = [x if len(x) <= len(y) else y for x, y in zip(a, b, strict=True)]
    long = [y if len(x) <= len(y) else x for x, y in zip(a, b, strict=True)]
    size = np.fromiter(map(len, short), np.int64, len(short))
    for i in np.flatnonzero(size > LONGEST):
        out[i] = lcs(short[i], long[i])
    own = np.flatnonzero((size > 0) & (size <= LONGEST))
    # By words of the pattern, then longest text first: the pairs still at work are a head.
    own = own[np.lexsort((-np.fromiter((len(long[i]) for i in own), np.int64, len(own)), -(-size[own] // 64)))]
    for words in np.unique(-(-size[own] // 64)):
        part = own[-(-size[own] // 64) == words]
        left, right = [short[i] for i in part], [long[i] for i in part]
        alphabet = Alphabet(left, right)
        x, y = Codes(left, alphabet), Codes(right, alphabet)
        for s in _by_chunks(x.length, alphabet.size):
            masks, length = _masks(x.rows[s], x.length[s], alphabet.size), y.length[s]
            v = np.full((len(length), masks.shape[2]), ~np.uint64(0))
            flat, letters = _flat(masks, y.rows[s])
            for j, k in enumerate(_heads(length, int(length.max(initial=0)))):
                v[:k] = _step(v[:k], flat[letters[j, :k]])
            out[part[s]] = _found(v, x.length[s])
    return out


def ratio_many(a: list[str], b: list[str]) -> np.ndarray:
    n = np.fromiter((len(x) + len(y) for x, y in zip(a, b, strict=True)), np.float64, len(a))
    same = np.fromiter((x == y for x, y in zip(a, b, strict=True)), bool, len(a))
    out = np.full(len(a), 100.0)
    own = np.flatnonzero(~same & (n > 0))
    out[own] = 200.0 * lcs_many([a[i] for i in own], [b[i] for i in own]) / n[own]
    return out


def partial_many(a: list[str], b: list[str]) -> np.ndarray:
    """:func:`partial_ratio` of each pair."""
    return partial_and_lcs(a, b)[0]


def partial_and_lcs(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """:func:`partial_ratio` and :func:`lcs` of each pair.

    The windows cut at the longer string's ends are its heads and tails: one pass each gives them all, and the one
    over the heads ends with the whole string.  Whole windows are compared side by side.
    """
    out, whole = np.zeros(len(a)), np.zeros(len(a), np.int64)
    work = []
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        x, y = (x, y) if len(x) <= len(y) else (y, x)
        if x in y:
            out[i], whole[i] = 100.0 if x or not y else 0.0, len(x)
        elif len(x) > LONGEST:
            out[i], whole[i] = partial_ratio(x, y), lcs(x, y)
        elif x:
            work.append((-(-len(x) // 64), -len(x), i, x, y))
    work.sort(key=lambda w: w[:3])
    for words in sorted({w[0] for w in work}):
        part = [w for w in work if w[0] == words]
        where, short, long = np.array([w[2] for w in part]), [w[3] for w in part], [w[4] for w in part]
        alphabet = Alphabet(short, long)
        best = np.zeros(len(part))
        for reverse in (False, True):
            x = Codes([s[::-1] for s in short] if reverse else short, alphabet)
            y = Codes([s[::-1] for s in long] if reverse else long, alphabet)
            for s in _by_chunks(x.length, alphabet.size):
                masks, n, rows = _masks(x.rows[s], x.length[s], alphabet.size), x.length[s], y.rows[s]
                v = np.full((len(n), masks.shape[2]), ~np.uint64(0))
                own = best[s]
                flat, letters = _flat(masks, rows)
                heads = _heads(n, int(n.max(initial=0)))[1:]  # heads are shorter than the pattern
                m, alive = y.length[s], slice(None)
                for j in range(len(heads) if reverse else int(m.max(initial=0))):
                    k = heads[j] if j < len(heads) else 0
                    if reverse:
                        alive = slice(k)
                    elif j % 8 == 0 and (m <= j).any():
                        alive = np.flatnonzero(m > j)
                    v[alive] = _step(v[alive], flat[letters[j, alive]])
                    own[:k] = np.maximum(own[:k], 200.0 * _found(v[:k], n[:k]) / (n[:k] + j + 1))
                if not reverse:
                    whole[where[s]] = _found(v, n)
                    _windows(masks, rows, n, m, own)
                best[s] = own
        out[where] = best
    return out, whole


def _windows(masks: np.ndarray, rows: np.ndarray, n: np.ndarray, m: np.ndarray, best: np.ndarray, size: int = 1 << 16) -> None:
    """Raise ``best`` to the best whole window of each pair; pairs come with the longest pattern first."""
    count = m - n + 1
    flat, letters = masks.reshape(-1, masks.shape[2]), rows.ravel()
    pair = np.repeat(np.arange(len(n)), count)
    start = np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
    for begin in range(0, len(pair), size):
        p, at = pair[begin : begin + size], start[begin : begin + size]
        v = np.full((len(p), masks.shape[2]), ~np.uint64(0))
        length = n[p]
        place, first = p * rows.shape[1] + at, p * masks.shape[1]
        for j, k in enumerate(_heads(length, int(length.max(initial=0)))):
            v[:k] = _step(v[:k], flat[first[:k] + letters[place[:k] + j]])
        np.maximum.at(best, p, 100.0 * _found(v, length) / length)


def jaro_winkler_many(a: list[str], b: list[str], size: int = 1 << 21) -> np.ndarray:
    """:func:`jaro_winkler` of each pair."""
    out = np.fromiter((float(x == y) for x, y in zip(a, b, strict=True)), np.float64, len(a))
    own = [i for i in range(len(a)) if a[i] and b[i] and a[i] != b[i]]
    own.sort(key=lambda i: (len(a[i]), len(b[i])))
    at = 0
    while at < len(own):
        end = at + max(1, size // ((len(a[own[min(len(own) - 1, at + 1000)]]) + 1) * (max(len(b[i]) for i in own[at : at + 1000]) + 1)))
        part = own[at : min(end, at + 1000)]
        at += len(part)
        x = [a[i] for i in part]
        y = [b[i] for i in part]
        alphabet = Alphabet(x, y)
        p, q = Codes(x, alphabet), Codes(y, alphabet)
        reach = np.maximum(0, np.maximum(p.length, q.length) // 2 - 1)
        taken, used = np.zeros(q.rows.shape, bool), np.zeros(p.rows.shape, bool)
        place, row = np.arange(q.rows.shape[1]), np.arange(len(part))
        for i in range(int(p.length.max())):
            fits = (q.rows == p.rows[:, i : i + 1]) & ~taken & (place >= (i - reach)[:, None]) & (place <= (i + reach)[:, None]) & (p.length > i)[:, None]
            first = fits.argmax(1)
            hit = fits[row, first]
            taken[row[hit], first[hit]] = True
            used[hit, i] = True
        m = used.sum(1)
        front = lambda flags, rows: np.take_along_axis(rows, np.argsort(~flags, axis=1, kind="stable"), 1)
        width = int(m.max(initial=0))
        swaps = ((front(used, p.rows)[:, :width] != front(taken, q.rows)[:, :width]) & (np.arange(width) < m[:, None])).sum(1) // 2
        safe = np.maximum(m, 1)
        score = np.where(m > 0, (m / p.length + m / q.length + (m - swaps) / safe) / 3, 0.0)
        head = np.zeros(len(part), np.int64)
        alike = np.ones(len(part), bool)
        for i in range(4):
            alike &= (p.length > i) & (q.length > i)
            if i < min(p.rows.shape[1], q.rows.shape[1]):
                alike &= p.rows[:, i] == q.rows[:, i]
            head += alike
        out[part] = np.where(score > 0.7, score + 0.1 * head * (1 - score), score)
    return out


def _sorted(strings: list[str]) -> list[str]:
    known: dict[str, str] = {}
    return [known[s] if s in known else known.setdefault(s, " ".join(sorted(s.split()))) for s in strings]


def token_set_many(a: list[str], b: list[str]) -> np.ndarray:
    """:func:`token_set_ratio` of each pair; of the shared words and what follows them only the latter is compared."""
    out = np.zeros(len(a))
    known: dict[str, frozenset[str]] = {}
    left, right, owner, shared = [], [], [], []
    for i, (s, t) in enumerate(zip(a, b, strict=True)):
        x = known.get(s) if s in known else known.setdefault(s, frozenset(s.split()))
        y = known.get(t) if t in known else known.setdefault(t, frozenset(t.split()))
        if not x or not y:
            continue
        both = x & y
        if both and (len(both) == len(x) or len(both) == len(y)):
            out[i] = 100.0
            continue
        left.append(" ".join(sorted(x - both)))
        right.append(" ".join(sorted(y - both)))
        owner.append(i)
        shared.append(sum(map(len, both)) + len(both))  # with a space behind each word
    common = np.array(shared, np.int64)
    one, two = (common + np.fromiter(map(len, side), np.int64, len(side)) for side in (left, right))
    best = 200.0 * (common + lcs_many(left, right)) / (one + two)
    head = np.maximum(common - 1, 0)  # the shared words by themselves, a head of both sides
    out[owner] = np.where(common > 0, np.maximum(best, np.maximum(200.0 * head / (head + one), 200.0 * head / (head + two))), best)
    return out


def ratio_and_partial(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    part, found = partial_and_lcs(a, b)
    n = np.fromiter((len(x) + len(y) for x, y in zip(a, b, strict=True)), np.float64, len(a))
    return np.where(n > 0, 200.0 * found / np.maximum(n, 1), 100.0), part


def five_many(a: list[str], b: list[str], weighted: bool = True) -> list[np.ndarray]:
    """ratio, token_sort, token_set, partial and (if wanted) weighted ratio of each pair."""
    (whole, part), in_order, sets = ratio_and_partial(a, b), ratio_many(_sorted(a), _sorted(b)), token_set_many(a, b)
    if not weighted:
        return [whole, in_order, sets, part]
    low = np.fromiter((min(len(x), len(y)) for x, y in zip(a, b, strict=True)), np.float64, len(a))
    high = np.fromiter((max(len(x), len(y)) for x, y in zip(a, b, strict=True)), np.float64, len(a))
    longer = high / np.maximum(low, 1)
    out = np.maximum(whole, 0.95 * np.maximum(in_order, sets))
    uneven = np.flatnonzero((low > 0) & (longer >= 1.5))
    if len(uneven):
        x, y = [a[i] for i in uneven], [b[i] for i in uneven]
        scale = np.where(longer[uneven] <= 8, 0.9, 0.6)
        meet = np.array([bool(set(s.split()) & set(t.split())) for s, t in zip(x, y, strict=True)])
        bare = np.array([not s.split() or not t.split() for s, t in zip(x, y, strict=True)])
        unique = lambda strings: [" ".join(sorted(set(s.split()))) for s in strings]
        tokens = np.where(bare, 0.0, np.where(meet, 100.0, np.maximum(partial_many(_sorted(x), _sorted(y)), partial_many(unique(x), unique(y)))))
        out[uneven] = np.maximum(whole[uneven], np.maximum(scale * part[uneven], 0.95 * scale * tokens))
    out[low == 0] = 0.0
    return [whole, in_order, sets, part, out]


def similarities(*sides: pd.Series) -> pd.DataFrame:
    """COLUMNS (0 to 1) of pairs of names, core names, skeletons and addresses, given as eight columns.

    A pair of strings that comes up again in the batch, as core and raw name often do, is compared once.
    """
    given = [(list(sides[2 * k]), list(sides[2 * k + 1])) for k in range(4)]
    out: dict[str, np.ndarray] = {}

    def each(pairs: list[tuple[str, str]], columns: list[str], compare) -> None:
        known: dict[tuple[str, str], int] = {}
        place = np.fromiter((known.setdefault(p, len(known)) for p in pairs), np.int64, len(pairs))
        found = compare([p[0] for p in known], [p[1] for p in known])
        for c, values in zip(columns, found, strict=True):
            out[c] = values[place]

    name, core, skel, addr = (list(zip(*x, strict=True)) for x in given)
    n = len(name)
    six = ["ratio", "token_sort", "token_set", "partial", "wratio", "jaro"]
    each(name + core, six, lambda a, b: [*(x / 100 for x in five_many(a, b)), jaro_winkler_many(a, b)])
    done = {f"{side}_{c}": out[c][s] for side, s in (("name", slice(0, n)), ("core", slice(n, 2 * n))) for c in six}
    each(skel, six[:4], lambda a, b: [x / 100 for x in five_many(a, b, weighted=False)])
    done |= {f"skel_{c}": out[c] for c in six[:4]}
    each(addr, ["ratio", "partial", "token_set"], lambda a, b: [x / 100 for x in (*ratio_and_partial(a, b), token_set_many(a, b))])
    done |= {f"addr_{c}": out[c] for c in ("ratio", "token_set", "partial")}
    for side, pairs in (("core", core), ("skel", skel)):
        squeezed = [(p[0].replace(" ", ""), p[1].replace(" ", "")) for p in pairs]
        each(squeezed, ["ratio"], lambda a, b: [ratio_many(a, b) / 100])
        done[f"{side}_concat_ratio"] = out["ratio"]
    return pd.DataFrame({c: done[c].astype("float32") for c in COLUMNS})
