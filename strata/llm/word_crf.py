"""A linear-chain conditional random field that labels the words of a text with languages.

A word's emission scores are sums of learned weights over its features: its affixes, its character
n-grams, and itself where it is in the lexicon of frequent words. Transitions between the labels of
neighbouring words are learned, too. Marginals come from the forward-backward algorithm.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

from strata.llm import pretokens
from strata.llm.hash_index import HashIndex, checks_of
from strata.llm.shingles import hash_spans, mix

BUCKETS = 1 << 16
LEXICON_FROM = 3  # occurrences in the training words
TABLE_BITS = 20  # of the table of scores that a worker keeps
SEGMENT = 64
NEW_WORDS = 1 << 14  # scored at once
NGRAMS = (2, 3, 4)  # bytes
AFFIXES = (1, 2, 3, 4)

_WORD = re.compile(r"[^\W\d_]+")
_IN_WORD = np.zeros(256, bool)
_IN_WORD[97:123] = _IN_WORD[128:] = True


@dataclass
class Words:
    """The words of some texts, as spans of lower-case bytes, and how many each text has."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray


def words_of(texts: list[str | None]) -> Words:
    """Words are runs of letters. In plain texts all bytes beyond ASCII belong to letters; of other
    texts only the words are kept."""
    parts = []
    for text in texts:
        text = text or ""
        plain = pretokens.is_plain(text)
        text = text.lower()
        if not plain:
            text = " ".join(_WORD.findall(text))
        parts.append(text.encode("utf-8", "surrogatepass"))
    data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate(([False], _IN_WORD[data])).view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    cuts = np.concatenate(([0], np.cumsum([len(x) + 1 for x in parts])))
    return Words(data, starts, ends, np.diff(np.searchsorted(starts, cuts)))


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lexicon: np.ndarray):
    """Hashed features of words: their buckets, word after word, and how many each word has."""
    lengths = ends - starts
    # The words with a mark on either side.
    cuts = np.cumsum(lengths + 2) - (lengths + 2)
    marked = np.full(int((lengths + 2).sum()), ord(">"), np.uint64)
    marked[cuts] = ord("<")
    place = np.repeat(cuts + 1 - starts, lengths) + _ranges(starts, lengths)
    marked[place] = data[_ranges(starts, lengths)]
    found, owner = [], []

    def add(kind: int, of: np.ndarray, value: np.ndarray) -> None:
        found.append((mix(value * np.uint64(8) + np.uint64(kind), 21) % np.uint64(BUCKETS)).astype(np.int32))
        owner.append(of)

    padded = np.concatenate([marked, np.zeros(4, np.uint64)])
    word = np.repeat(np.arange(len(starts)), lengths + 2)
    room = np.repeat(cuts + lengths + 2, lengths + 2) - np.arange(len(marked))
    gram = marked.copy()
    for n in range(2, max(NGRAMS) + 1):
        gram = gram * np.uint64(256) + padded[n - 1:n - 1 + len(marked)]
        if n in NGRAMS:
            inside = room >= n
            add(0, word[inside], gram[inside] * np.uint64(8) + np.uint64(n))
    for n in AFFIXES:
        long = np.flatnonzero(lengths >= n)
        prefix = suffix = np.zeros(len(long), np.uint64)
        for i in range(n):
            prefix = prefix * np.uint64(256) + data[starts[long] + i]
            suffix = suffix * np.uint64(256) + data[ends[long] - n + i]
        add(1, long, prefix * np.uint64(8) + np.uint64(n))
        add(2, long, suffix * np.uint64(8) + np.uint64(n))
    keys = hash_spans(data, starts, ends)
    if len(lexicon):
        at = np.minimum(np.searchsorted(lexicon, keys), len(lexicon) - 1)
        known = np.flatnonzero(lexicon[at] == keys)
        add(3, known, keys[known])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(found)[order], np.bincount(owner, minlength=len(starts))


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each span, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def marginals(emission: np.ndarray, starts: np.ndarray, transition: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Label probabilities of all words of many texts, whose first words are at ``starts``.

    ``emission`` has a row of scores per word. Texts are cut into segments, whose transfer matrices
    are computed in step; a pass over the segments of each text links them, so the result is that
    of the whole chain.
    """
    n, k = emission.shape
    if not n:
        return np.zeros((0, k))
    lengths = np.diff(np.append(starts, n))
    weight = np.exp(emission - emission.max(1, keepdims=True))
    move = np.exp(transition - transition.max())
    first = np.exp(start - start.max())
    n_segments = -(-lengths // SEGMENT)
    text_of = np.repeat(np.arange(len(starts)), n_segments)
    index = np.arange(len(text_of)) - np.repeat(np.cumsum(n_segments) - n_segments, n_segments)
    begin = starts[text_of] + index * SEGMENT
    size = np.minimum(SEGMENT, lengths[text_of] - index * SEGMENT)
    order = np.argsort(-size, kind="stable")
    begin, size, index, text_of = begin[order], size[order], index[order], text_of[order]
    active = [int(np.searchsorted(-size, -t, "left")) for t in range(SEGMENT)]  # with more than t words

    # Transfer matrices; a text's first word has no transition into it.
    matrix = np.repeat(np.eye(k)[None], len(begin), 0)
    for t in range(SEGMENT):
        m = active[t]
        step = matrix[:m] @ move
        if t == 0:
            opening = index[:m] == 0
            step[opening] = matrix[:m][opening]
        step *= weight[begin[:m] + t][:, None, :]
        matrix[:m] = step / step.sum((1, 2), keepdims=True)

    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))  # segment number in text order -> row here
    base = np.cumsum(n_segments) - n_segments
    alpha, beta = np.empty((len(begin), k)), np.empty((len(begin), k))
    longest_first = np.argsort(-n_segments, kind="stable")
    reach = -n_segments[longest_first]
    state = np.repeat(first[None], len(starts), 0)
    for j in range(int(n_segments.max())):
        texts = longest_first[:np.searchsorted(reach, -j, "left")]
        rows = place[base[texts] + j]
        alpha[rows] = state[texts]
        moved = np.einsum("nk,nkl->nl", state[texts], matrix[rows])
        state[texts] = moved / moved.sum(1, keepdims=True)
    state = np.ones((len(starts), k))
    for j in range(int(n_segments.max())):
        texts = longest_first[:np.searchsorted(reach, -j, "left")]
        rows = place[base[texts] + n_segments[texts] - 1 - j]
        beta[rows] = state[texts]
        moved = np.einsum("nkl,nl->nk", matrix[rows], state[texts])
        state[texts] = moved / moved.sum(1, keepdims=True)

    forward = np.empty((n, k))
    state = alpha
    for t in range(SEGMENT):
        m = active[t]
        step = state[:m] @ move
        if t == 0:
            opening = index[:m] == 0
            step[opening] = state[:m][opening]
        step = step * weight[begin[:m] + t]
        state[:m] = step / step.sum(1, keepdims=True)
        forward[begin[:m] + t] = state[:m]
    state = beta
    for t in reversed(range(SEGMENT)):
        m = active[t]
        at = begin[:m] + t
        found = forward[at] * state[:m]
        step = (weight[at] * state[:m]) @ move.T
        state[:m] = step / step.sum(1, keepdims=True)
        forward[at] = found / found.sum(1, keepdims=True)
    return forward


class Model:
    """What was learned, and the scores of words seen before, in a bounded table."""

    def __init__(self, languages: list[str], weights, transition, start, lexicon, table_bits: int = TABLE_BITS):
        self.languages = languages
        self.weights = weights  # of hashed features, by language
        self.transition, self.start, self.lexicon = transition, start, lexicon
        self.table_bits, self.index, self.scores = table_bits, None, None

    def __getstate__(self):
        return self.__dict__ | {"index": None, "scores": None}

    def emissions(self, words: Words) -> np.ndarray:
        keys = hash_spans(words.data, words.starts, words.ends)
        checks = checks_of(words.data, words.starts, words.ends)
        if self.index is None:
            self.index = HashIndex(self.table_bits)
            self.scores = np.empty((self.index.room, len(self.languages)))
        entries = self.index.find(keys, checks)
        missing = np.flatnonzero(entries < 0)
        if self.index.size + len(missing) > self.index.room:
            self.index.clear()
            if len(keys) > self.index.room:
                self.index = HashIndex(len(keys).bit_length() + 1)
                self.scores = np.empty((self.index.room, len(self.languages)))
            missing = np.arange(len(keys))
        while len(missing):  # more than once only where two words share a hash
            _, first = np.unique(keys[missing], return_index=True)
            new = missing[first]
            for part in np.split(new, range(NEW_WORDS, len(new), NEW_WORDS)):
                flat, counts = features(words.data, words.starts[part], words.ends[part], self.lexicon)
                at = self.index.size
                self.scores[at:at + len(part)] = np.add.reduceat(self.weights[flat], np.cumsum(counts) - counts)
                self.index.add(keys[part], checks[part])
            entries[missing] = self.index.find(keys[missing], checks[missing])
            missing = missing[entries[missing] < 0]
        return self.scores[entries]

    def label(self, words: Words) -> list[np.ndarray]:
        """Label probabilities of the words of each text."""
        full = words.counts[words.counts > 0]
        if not len(full) or not self.languages:
            return [np.zeros((0, len(self.languages)))] * len(words.counts)
        found = marginals(self.emissions(words), np.cumsum(full) - full, self.transition, self.start)
        return np.split(found, np.cumsum(words.counts)[:-1])


def _chains(texts: list[np.ndarray], language: np.ndarray, n: int, length: int, rng):
    """Training chains of equal length: pieces of texts, now and then switching the language."""
    k = int(language.max()) + 1
    of_language = [np.flatnonzero(language == i) for i in range(k)]
    index, labels = np.empty((n, length), np.int64), np.empty((n, length), np.int64)
    for row, label in zip(index, labels):
        at = 0
        while at < length:
            of = rng.integers(k)
            text = texts[rng.choice(of_language[of])]
            size = int(min(length - at, rng.integers(4, 40), len(text)))
            begin = rng.integers(len(text) - size + 1)
            row[at:at + size], label[at:at + size] = text[begin:begin + size], of
            at += size
    return index, labels


def fit(
    spans: dict[str, list[str]], *, n_chains: int = 3000, length: int = 48, epochs: int = 3,
    rate: float = 0.05, decay: float = 1e-4, seed: int = 5,
) -> Model:
    """Learn from texts of each language by stochastic gradients of the chains' likelihood."""
    names = sorted(spans)
    words = words_of([text for name in names for text in spans[name]])
    language = np.repeat(np.arange(len(names)), [len(spans[name]) for name in names])
    keys = hash_spans(words.data, words.starts, words.ends)
    distinct, first, known, times = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    texts = np.split(known.ravel(), np.cumsum(words.counts)[:-1])
    full = np.flatnonzero(words.counts > 0)
    used_languages, language = np.unique(language[full], return_inverse=True)
    texts, names = [texts[i] for i in full], [names[i] for i in used_languages]
    lexicon, k = distinct[times >= LEXICON_FROM], len(names)
    rng = np.random.default_rng(seed)
    # One more row pads the features of short words and stays 0.
    weights, transition, start = np.zeros((BUCKETS + 1, k)), np.zeros((k, k)), np.zeros(k)
    model = Model(names, weights[:BUCKETS], transition, start, lexicon)
    if not k:
        return model
    index, labels = _chains(texts, language, n_chains, length, rng)
    chosen, index = np.unique(index, return_inverse=True)
    index = index.reshape(labels.shape)
    flat, counts = features(words.data, words.starts[first[chosen]], words.ends[first[chosen]], lexicon)
    table = np.full((len(chosen), int(counts.max())), BUCKETS)
    table[np.repeat(np.arange(len(chosen)), counts), _ranges(np.zeros_like(counts), counts)] = flat
    squares = [np.full_like(x, 1e-6) for x in (weights, transition, start)]
    size = 64
    for _ in range(epochs):
        for rows in np.split(rng.permutation(n_chains), range(size, n_chains, size)):
            used, inverse = np.unique(index[rows], return_inverse=True)
            scores = weights[table[used]].sum(1)[inverse].reshape(-1, k)
            y = labels[rows].ravel()
            starts = np.arange(len(rows)) * length
            p = marginals(scores, starts, transition, start)
            error = p.copy()
            error[np.arange(len(y)), y] -= 1
            by_word = np.zeros((len(used), k))
            np.add.at(by_word, inverse.ravel(), error)
            grad = np.zeros_like(weights)
            np.add.at(grad, table[used], by_word[:, None, :])
            grad[BUCKETS] = 0
            pairs = _pair_marginals(scores, p, transition, len(rows), length)
            before, after = labels[rows][:, :-1].ravel(), labels[rows][:, 1:].ravel()
            np.add.at(pairs, (before, after), -1)
            for value, g, square in zip(
                (weights, transition, start), (grad, pairs, error[starts].sum(0)), squares
            ):
                g = g / len(rows) + decay * value
                square += g * g
                value -= rate * g / np.sqrt(square) * (1 if value is weights else 2)
    return model


def _pair_marginals(scores, p, transition, n: int, length: int) -> np.ndarray:
    """Expected numbers of each transition, with the marginals as neighbours' beliefs.

    P(a, b) of neighbours is proportional to their own beliefs and the transition; it is scaled
    until its sums agree with the marginals, which is exact for a chain.
    """
    k = scores.shape[1]
    p = p.reshape(n, length, k)
    left, right = p[:, :-1].reshape(-1, k), p[:, 1:].reshape(-1, k)
    joint = np.repeat(np.exp(transition - transition.max())[None], len(left), 0) + 1e-300
    for _ in range(30):
        joint *= (left / np.maximum(joint.sum(2), 1e-300))[:, :, None]
        joint *= (right / np.maximum(joint.sum(1), 1e-300))[:, None, :]
    return joint.sum(0)
