"""Unknown code pages as substitution ciphers.

A text whose bytes were read with a wrong one-byte code page is a substitution
cipher: each byte of the encoding stands as one letter of the page.  Which
byte a letter stands for is learned by expectation-maximization: the E-step
spreads every letter of the garbled runs over all bytes of the encoding by the
language's byte n-grams and the present mapping, the M-step sets the mapping
from these expected counts.  A published page may be the prior; without one
the mapping starts from the frequencies of letters and bytes alone.

The statistics are counts of letter triples (pairs for Shift_JIS), so a fit
costs the same for ten captions and for a third of all pages.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

#: Letters of a source a mapping is learned for by the length of n-grams, most frequent first; a code page has 128 beyond ASCII.
MOST_LETTERS = {2: 224, 3: 136}
#: Rounds of EM from nothing and from a prior; starts from frequencies when there is no prior; share left to letters that are no cipher.
ROUNDS, PRIOR_ROUNDS, STARTS, NOISE = 30, 8, 3, 0.02
#: Gain in the mean log-likelihood of an n-gram below which a fit is settled.
SETTLED = 1e-4
#: Pseudo-count of each letter of the prior page, and the share of n-grams fitting by which EM has nothing left to learn beyond it.
PRIOR, CONVERGED = 2.0, 0.97
#: What the mean log-likelihood of an n-gram may be apart from the language's own: text of another language reads
#: worse, and what repeats a few letters better, than a mapping to the language's bytes can make it.
TYPICAL = (-1.0, 1.0)
#: Counts that a letter's byte must be learned from: where the prior page has no byte for it, and to overrule the page.
LEAST_LETTER, LEAST_CHANGE = 1.5, 8.0
#: Share of a letter's counts that its byte must have, or half of it where the letter has as much of the byte's.
SURE = 0.6
#: By the length of n-grams: the least number of them, the least share of them that must be usual in the language, and what is usual.
LEAST_GRAMS, LEAST_FITTING, USUAL = {2: 300, 3: 80}, {2: 0.95, 3: 0.82}, {2: 1e-5, 3: 3e-7}


@dataclass(frozen=True)
class Code:
    """An encoding: the bytes its characters beyond ASCII have, and the length of its byte n-grams."""

    name: str
    values: tuple[int, ...]
    order: int

    @property
    def size(self) -> int:
        return len(self.values) ** self.order

    def places(self) -> np.ndarray:
        found = np.full(256, -1, np.int64)
        found[list(self.values)] = np.arange(len(self.values))
        return found


#: Encodings of Japanese whose bytes a mapping can be learned for.
CODES = (
    Code("utf-8", (*range(0x80, 0xC0), *range(0xE2, 0xEA), 0xEF), 3),
    Code("euc_jp", tuple(range(0xA1, 0xF5)), 3),
    Code("cp932", (*range(0x40, 0x7F), *range(0x80, 0xFD)), 2),
)
BYTE_GRAMS = sum(c.size for c in CODES)
_ASCII = re.compile("[\x00-\x7f]+")


def byte_grams(texts: list[str]) -> np.ndarray:
    """Counts of the byte n-grams of all codes, one after the other."""
    whole = _ASCII.sub("\n", "\n".join(texts))
    out = []
    for code in CODES:
        at = code.places()[np.frombuffer(whole.encode(code.name, "ignore"), np.uint8)]
        index, fine = np.zeros(max(0, len(at) - code.order + 1), np.int64), np.ones(max(0, len(at) - code.order + 1), bool)
        for k in range(code.order):
            part = at[k : len(at) - code.order + 1 + k]
            index = index * len(code.values) + part
            fine &= part >= 0
        out.append(np.bincount(index[fine], minlength=code.size))
    return np.concatenate(out)


def languages(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Of each code the probabilities of its byte n-grams."""
    out, at = {}, 0
    for code in CODES:
        part = counts[at : at + code.size].astype(np.float32).reshape((len(code.values),) * code.order)
        out[code.name] = part / max(float(part.sum()), 1.0)
        at += code.size
    return out


def letter_grams(run: str) -> list[tuple[int, int, int]]:
    """Triples of letters beyond ASCII of a run, and pairs (third 0) of which one may be the second byte of Shift_JIS."""
    c = [ord(x) for x in run]
    high = [x > 0x7F for x in c]
    fit = [x > 0x7F or 0x40 <= x < 0x7F for x in c]
    out = [(x, y, z) for x, y, z, a, b, d in zip(c, c[1:], c[2:], high, high[1:], high[2:]) if a and b and d]
    out += [(x, y, 0) for x, y, a, b, d, e in zip(c, c[1:], high, high[1:], fit, fit[1:]) if (a or b) and d and e]
    return out


def _table(grams: np.ndarray, n: np.ndarray, order: int) -> tuple[list[int], np.ndarray]:
    """Letters by frequency, and the dense counts of their n-grams."""
    cells = grams[:, :order]
    letters, total = np.unique(cells.ravel(), return_inverse=True)
    frequency = np.bincount(total, np.repeat(n, order), minlength=len(letters))
    kept = np.sort(letters[np.argsort(-frequency, kind="stable")[: MOST_LETTERS[order]]])
    at = np.searchsorted(kept, cells)
    fine = (kept[np.minimum(at, len(kept) - 1)] == cells).all(1)
    index = np.ravel_multi_index(tuple(at[fine].T), (len(kept),) * order)
    return kept.tolist(), np.bincount(index, n[fine], minlength=len(kept) ** order).astype(np.float32).reshape((len(kept),) * order)


def _margin(x: np.ndarray) -> np.ndarray:
    total = sum(x.sum(tuple(k for k in range(x.ndim) if k != axis)) for axis in range(x.ndim))
    return total / max(float(total.sum()), 1e-30)


def _expect(seen: np.ndarray, language: np.ndarray, theta: np.ndarray, noise: np.ndarray) -> tuple[np.ndarray, float]:
    """E-step: expected counts of bytes x letters, and the mean log-likelihood of an n-gram."""
    b, v = theta.shape
    if seen.ndim == 2:
        half = language @ theta
        likely = theta.T @ half + noise
        ratio = (seen / likely).astype(np.float32, copy=False)
        spread = half @ ratio.T + language.T @ (theta @ ratio)
    else:
        last = (language.reshape(b * b, b) @ theta).reshape(b, b, v)
        rest = np.matmul(theta.T, last)  # first byte x second and third letter
        likely = (theta.T @ rest.reshape(b, v * v)).reshape(v, v, v) + noise
        ratio = (seen / likely).astype(np.float32, copy=False).reshape(v, v * v)
        spread = rest.reshape(b, v * v) @ ratio.T
        back = (theta @ ratio).reshape(b, v, v)
        spread += np.einsum("abz,ayz->by", last, back, optimize=True)
        spread += language.reshape(b * b, b).T @ np.matmul(theta, back).reshape(b * b, v)
    used = seen > 0
    return theta * spread, float((seen[used] * np.log(likely[used])).sum() / max(float(seen.sum()), 1e-30))


@dataclass
class Fit:
    """A learned mapping and what speaks for it."""

    code: Code
    table: dict[int, int]  # letter to byte
    likelihood: float  # mean log-likelihood of an n-gram
    chain: float  # the same of a chain of letters that knows nothing of bytes, less its parameters
    fitting: float  # share of the n-grams that are usual in the language
    grams: float
    usual: float = 0.0  # mean log-likelihood of the language's own n-grams
    settled: bool = False  # the prior fits already

    def good(self) -> bool:
        n = self.code.order
        typical = self.settled or TYPICAL[0] <= self.likelihood - self.usual <= TYPICAL[1]
        return self.grams >= LEAST_GRAMS[n] and self.fitting >= LEAST_FITTING[n] and self.likelihood > self.chain and typical


def _chain(seen: np.ndarray) -> float:
    """Mean log-likelihood of the n-grams as a first-order chain of letters, with the Bayesian penalty."""
    total = max(float(seen.sum()), 1.0)
    if seen.ndim == 2:
        one = _margin(seen)
        return float((_margin(seen) * np.log(one + 1e-30)).sum() * 2 - 0.5 * len(one) * np.log(total) / total)
    first, second = seen.sum(2), seen.sum(0)
    log_first = (first[first > 0] * np.log(first[first > 0] / total)).sum()
    given = second / np.maximum(second.sum(1, keepdims=True), 1e-30)
    log_second = (second[second > 0] * np.log(given[second > 0])).sum()
    return float((log_first + log_second - 0.5 * (first > 0).sum() * np.log(total)) / total)


def _usual(language: np.ndarray) -> float:
    p = language[language > 0].astype(np.float64)
    return float((p * np.log(p)).sum())


def _fitting(seen: np.ndarray, language: np.ndarray, letters: list[int], chosen: np.ndarray) -> float:
    """Share of the n-grams, for pairs those without ASCII, that ``chosen`` bytes make usual in the language."""
    usual = (language >= USUAL[seen.ndim])[np.ix_(*[np.maximum(chosen, 0)] * seen.ndim)]
    known = chosen >= 0
    usual &= known[:, None] & known if seen.ndim == 2 else known[:, None, None] & known[:, None] & known
    if seen.ndim == 2:
        high = np.array(letters) > 0x7F
        seen = seen * (high[:, None] & high)
    return float(seen[usual].sum()) / max(float(seen.sum()), 1e-30)


def reads(grams: np.ndarray, n: np.ndarray, code: Code, language: np.ndarray, table: dict[int, int]) -> float:
    """Share of the n-grams that a table makes usual in the language; 0 if there are none."""
    own = (grams[:, 2] > 0) if code.order == 3 else (grams[:, 2] == 0)
    if not own.any() or not language.any():
        return 0.0
    letters, seen = _table(grams[own], n[own].astype(np.float64), code.order)
    places = code.places()
    return _fitting(seen, language, letters, np.array([places[table[x]] if x in table else -1 for x in letters]))


def learn_mapping(grams: np.ndarray, n: np.ndarray, code: Code, language: np.ndarray, prior: dict[int, int] | None = None, settle: bool = True) -> Fit | None:
    """The mapping of letters to bytes of ``code`` learned from n-gram counts; None if there is too little to learn from.

    ``grams`` are rows of three letters (the third 0 for pairs).  With a
    ``prior`` table EM starts from it and its letters keep PRIOR pseudo-counts;
    else the best of STARTS starts by frequency counts.  Where the prior fits
    already it is kept as it is, unless ``settle`` is false.  ASCII letters
    stand for themselves.
    """
    own = (grams[:, 2] > 0) if code.order == 3 else (grams[:, 2] == 0)
    grams, n = grams[own], n[own]
    if n.sum() < LEAST_GRAMS[code.order] or not language.any():
        return None
    letters, seen = _table(grams, n.astype(np.float64), code.order)
    places = code.places()
    b, v = len(code.values), len(letters)
    frequency = _margin(seen)
    noise = np.einsum("i,j->ij" if code.order == 2 else "i,j,k->ijk", *[frequency.astype(np.float32)] * code.order) * np.float32(NOISE) + np.float32(1e-12)
    fixed = np.ones((b, v), np.float32)
    for k, x in enumerate(letters):
        if x < 0x80:
            fixed[:, k] = 0
            fixed[places[x], k] = 1
    for k, value in enumerate(code.values):
        if value < 0x80:
            fixed[k, [i for i, x in enumerate(letters) if x != value]] = 0
    given = np.array([places[prior[x]] if prior and x in prior else -1 for x in letters])
    if prior:
        fitting = _fitting(seen, language, letters, given)
        if settle and fitting >= CONVERGED:
            return Fit(code, {x: prior[x] for x in letters if x in prior}, 0.0, -np.inf, fitting, float(seen.sum()), settled=True)
    pseudo = np.full((b, v), 1e-3, np.float32)
    pseudo[given[given >= 0], np.flatnonzero(given >= 0)] += PRIOR
    distance = np.abs(np.log(frequency + 1e-6)[None, :] - np.log(_margin(language) + 1e-6)[:, None])
    random = np.random.default_rng(0)
    best: tuple[float, np.ndarray] | None = None
    for start in range(1 if prior else STARTS):
        theta = np.exp(-1.5 * distance + 0.3 * start * random.standard_normal(distance.shape)) + 1e-4
        theta = ((pseudo + 1e-2 * theta if prior else theta) * fixed).astype(np.float32)
        theta /= np.maximum(theta.sum(1, keepdims=True), 1e-30)
        expected, likelihood, last = theta, -np.inf, -np.inf
        for _ in range(PRIOR_ROUNDS if prior and settle else ROUNDS):
            expected, likelihood = _expect(seen, language, theta, noise)
            if likelihood - last < SETTLED:
                break
            last = likelihood
            theta = (expected + pseudo) * fixed
            theta /= np.maximum(theta.sum(1, keepdims=True), 1e-30)
        if best is None or likelihood > best[0]:
            best = likelihood, expected
    likelihood, expected = best
    # A page gives a byte one letter: of two bytes that suit a letter it has the one that suits no other.
    of_byte = expected / np.maximum(expected.sum(1, keepdims=True), 1e-30)
    chosen = (expected * of_byte).argmax(0)
    each = np.arange(v)
    most, own = expected[chosen, each], of_byte[chosen, each]
    share = most / np.maximum(expected.sum(0), 1e-30)
    learned = (most >= LEAST_LETTER) & ((share >= SURE) | (share >= SURE / 2) & (own >= SURE)) & (np.array(letters) > 0x7F)
    table: dict[int, int] = {}
    for k, x in enumerate(letters):
        if prior and x in prior:
            # A byte of the page is overruled by many counts only, one that the encoding never has not at all.
            if learned[k] and given[k] >= 0 and most[k] >= LEAST_CHANGE and expected[given[k], k] < 0.1 * most[k]:
                table[x] = code.values[chosen[k]]
            else:
                table[x], chosen[k] = prior[x], given[k]
        elif learned[k]:
            table[x] = code.values[chosen[k]]
    return Fit(code, table, likelihood, _chain(seen), _fitting(seen, language, letters, chosen), float(seen.sum()), _usual(language))
