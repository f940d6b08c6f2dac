"""Abusive, hateful or sexual content.

Method: a linear-chain conditional random field with the states clean, abusive, hateful and sexual tags
every token of a sentence. The labels name documents, not tokens, so what is observed of a sentence that bears a bad
label is only that at least one of its tokens is in that state, and the others are in it or clean: the field is trained on
the difference of two forward-backward passes, one over all paths and one over the paths that this allows. Which sentence of
a document bears its label is learnt by multiple instances between two halves of the sample: in each document
labelled bad, the sentence that the other half tells best from clean ones bears it. There is no list of words. The forward and
backward passes make the scores: a sentence's score for a category is the probability that some token of it is in that state, a document's the highest
of its sentences', and the tokens whose marginals are beyond the threshold are its offending spans.

Fitting and scoring are apart: fit() trains on a bounded sample (SAMPLE), and a field can be stored and read again;
score_documents() covers every document and its whole text.
"""

from __future__ import annotations

import functools
import io
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaglio.llm.leakage import fold

STATES = ("clean", "abusive", "hateful", "sexual")
#: Labelled documents used for training, of each bad label and of clean ones, the first by hash of their id.
SAMPLE, CLEAN_SAMPLE = 1500, 5000
#: Score from which a document counts as bad.
THRESHOLD = 0.5
#: Characters of a sentence given to the field at once; a longer one is cut at blanks.
PIECE = 600
BUCKETS = 1 << 18
EPOCHS, ROUNDS = 5, 2
#: What a sentence that bears a bad label weighs against a clean one.
BAD = 2.0
#: Sentences whose scores a task keeps.
KEPT = 200_000

_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_TOKEN = re.compile(r"[^\W_](?:[\w*@$#!|]|(?<=\w)['’](?=\w))*|[*@$]+\w[\w*@$]*")
_SPACED = re.compile(r"(?<!\S)(?:[^\W_] ){1,}[^\W_](?![^\s.,;:!?])")
#: Stars around words are emphasis, stars in a word are a mask.
_EMPHASIS = re.compile(r"(?<![\w*])\*{1,3}([^*\n]*[^\s*\n])\*{1,3}(?![\w*])")
_LEET = str.maketrans("013457@$!|", "oieastasil")
_NUMBERED = re.compile(r"([a-z]+)\d{2,}$")
_DOUBLE = re.compile(r"(.)\1+")


def squash(word: str) -> str:
    """A word with look-alike digits and signs read as letters and repeated letters once; numbers become 0."""
    if word.isdigit():
        return "0"
    if (m := _NUMBERED.match(word)) is not None:
        return m[1] + "0"
    letters = any(ch.isalpha() for ch in word)
    return _DOUBLE.sub(r"\1", word.translate(_LEET) if letters else word)


def tokens_of(sentence: str) -> list[tuple[str, int, int]]:
    """Squashed word, start, end (in the folded sentence, letter-spaced words closed up)."""
    return [(squash(m[0].rstrip("!|#")), m.start(), m.end()) for m in _TOKEN.finditer(sentence)]


def close_up(sentence: str) -> str:
    """Words spelled with a blank after each letter, written together."""
    return _SPACED.sub(lambda m: m[0].replace(" ", ""), sentence)


def sentences_of(text: str) -> Iterator[tuple[int, str]]:
    """Offset and content of each sentence; long ones in pieces cut at blanks, the whole text is covered."""
    at = 0
    for m in [*_SENTENCE.finditer(text), None]:
        end = m.start() if m else len(text)
        while end - at > PIECE:
            cut = text.rfind(" ", at + PIECE // 2, at + PIECE)
            cut = cut if cut > 0 else at + PIECE
            yield at, text[at:cut]
            at = cut
        if end > at:
            yield at, text[at:end]
        at = m.end() if m else end


def _id(name: str) -> int:
    return crc32(name.encode()) % (BUCKETS - 1) + 1


@functools.lru_cache(maxsize=200_000)
def _own_ids(w: str) -> tuple[int, ...]:
    """Feature numbers of a token by itself: the word and its character runs."""
    padded = f"^{w}$"
    names = [f"w={w}"]
    names += {f"c={padded[k : k + 3]}" for k in range(len(padded) - 2)} if len(w) > 2 else ()
    names += {f"d={padded[k : k + 5]}" for k in range(len(padded) - 4)} if len(w) > 3 else ()
    if "*" in w:
        names.append("masked")
    return tuple(_id(x) for x in names)


START, STOP = "<s>", "</s>"


@functools.lru_cache(maxsize=200_000)
def _number(w: str) -> int:
    return crc32(w.encode())


def pair_ids(kind: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Feature numbers of two words side by side, off their numbers."""
    h = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(kind)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return ((h >> np.uint64(33)) % np.uint64(BUCKETS - 1)).astype(np.int64) + 1


def features_of(words: list[str]) -> list[list[int]]:
    """Feature numbers of each token: its own, its neighbours and its pairs with them."""
    around = [START, *words, STOP]
    n = np.array([_number(w) for w in around], np.uint64)
    before, after = pair_ids(1, n[:-2], n[1:-1]).tolist(), pair_ids(2, n[1:-1], n[2:]).tolist()
    return [[*_own_ids(w), _id(f"b={around[i]}"), _id(f"a={around[i + 2]}"), before[i], after[i]] for i, w in enumerate(words)]


class Field:
    """The conditional random field: emission weights by hashed feature, transition weights by pair of states."""

    def __init__(self) -> None:
        self.w = np.zeros((BUCKETS, len(STATES)), np.float32)
        self.t = np.eye(len(STATES), dtype=np.float32)

    @staticmethod
    def passes(e: np.ndarray, valid: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Marginals, scaled forward and backward values, log partition and emission factors, of emissions e (batch x longest x states)."""
        top = e.max(2)
        f = np.exp(e - top[:, :, None])
        step = np.exp(t)
        longest = e.shape[1]
        alpha, beta = np.zeros_like(f), np.ones_like(f)
        z = np.where(valid, top, 0).sum(1)
        alpha[:, 0] = f[:, 0]
        for k in range(longest):
            if k:
                alpha[:, k] = np.where(valid[:, k, None], (alpha[:, k - 1] @ step) * f[:, k], alpha[:, k - 1])
            size = alpha[:, k].sum(1)
            alpha[:, k] /= size[:, None]
            z += np.log(size)
        for k in range(longest - 2, -1, -1):
            back = (f[:, k + 1] * beta[:, k + 1]) @ step.T
            back /= back.sum(1, keepdims=True)
            beta[:, k] = np.where(valid[:, k + 1, None], back, 1)
        p = alpha * beta
        p /= p.sum(2, keepdims=True)
        p[~valid] = 0
        return p, alpha, beta, z, f

    @staticmethod
    def some(e: np.ndarray, valid: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Probability that at least one token of a sentence is in a state, by state other than clean: batch x states.

        One less the share of the paths that avoid it, by one forward pass over all states and one for each that is left out.
        """
        f = np.exp(e - e.max(2)[:, :, None])
        step = np.exp(t)
        gates = np.ones((len(STATES), len(STATES)), np.float32)  # no state left out, then each of the bad ones
        gates[np.arange(1, len(STATES)), np.arange(1, len(STATES))] = 0
        alpha = f[:, 0, None, :] * gates[None]
        z = np.log(alpha.sum(2))
        alpha /= alpha.sum(2, keepdims=True)
        for k in range(1, f.shape[1]):
            new = (alpha @ step) * f[:, k, None, :] * gates[None]
            size = np.maximum(new.sum(2), 1e-30)
            alpha = np.where(valid[:, k, None, None], new / size[:, :, None], alpha)
            z += np.where(valid[:, k, None], np.log(size), 0)
        return np.clip(1 - np.exp(z[:, 1:] - z[:, :1]), 0, 1)

    def emissions(self, batch: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature numbers, which tokens there are, and emissions; batch holds tokens x features, padded with feature 0."""
        longest = max(len(x) for x in batch)
        width = max(x.shape[1] for x in batch)
        index = np.zeros((len(batch), longest, width), np.int32)
        valid = np.zeros((len(batch), longest), bool)
        for i, x in enumerate(batch):
            index[i, : len(x), : x.shape[1]] = x
            valid[i, : len(x)] = True
        e = self.w[index].sum(2)
        e[~valid] = 0
        return index, valid, e

    def marginals(self, batch: list[np.ndarray]) -> np.ndarray:
        """Batch x longest x states."""
        _, valid, e = self.emissions(batch)
        return self.passes(e, valid, self.t)[0]

    @staticmethod
    def _steps(alpha: np.ndarray, beta: np.ndarray, f: np.ndarray, valid: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Expected transitions of each sentence: batch x states x states, summed over its steps."""
        out = np.zeros((len(f), t.shape[0], t.shape[0]), np.float32)
        for k in range(1, f.shape[1]):
            both = alpha[:, k - 1, :, None] * np.exp(t)[None] * (f[:, k] * beta[:, k])[:, None, :]
            both /= both.sum((1, 2), keepdims=True)
            out += both * valid[:, k, None, None]
        return out

    def observed(self, e: np.ndarray, valid: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginals and expected transitions given the sentences' labels: all tokens clean where y is 0, else at least one in state y and the rest in it or clean."""
        q = np.zeros_like(e)
        steps = np.zeros((len(e), len(STATES), len(STATES)), np.float32)
        n = valid.sum(1)
        clean = y == 0
        q[clean, :, 0] = valid[clean]
        steps[clean, 0, 0] = n[clean] - 1
        for s in range(1, len(STATES)):
            rows = np.flatnonzero(y == s)
            if not len(rows):
                continue
            two = [0, s]
            e2, v2, t2 = e[rows][:, :, two], valid[rows], self.t[np.ix_(two, two)]
            p, alpha, beta, z, f = self.passes(e2, v2, t2)
            none = np.exp(np.minimum(np.where(v2, e2[:, :, 0], 0).sum(1) + (n[rows] - 1) * t2[0, 0] - z, 0))
            some = np.maximum(1 - none, 1e-4)
            bad = np.minimum(p[:, :, 1] / some[:, None], 1) * v2
            q[rows, :, s], q[rows, :, 0] = bad, (1 - bad) * v2
            two_steps = self._steps(alpha, beta, f, v2, t2)
            two_steps[:, 0, 0] -= none * (n[rows] - 1)
            steps[np.ix_(rows, two, two)] = np.maximum(two_steps, 0) / some[:, None, None]
        return q, steps

    def fit(self, rows: list[tuple[np.ndarray, int, float]], epochs: int, rate: float = 0.25, keep: float = 1e-5) -> None:
        """AdaGrad on the log likelihood of the labels. rows: features, state the sentence bears, weight. Deterministic order."""
        gw, gt = np.full(self.w.shape, 1e-3, np.float32), np.full(self.t.shape, 1e-3, np.float32)
        order = sorted(range(len(rows)), key=lambda i: len(rows[i][0]))
        groups = [order[i : i + 256] for i in range(0, len(order), 256)]
        picks = np.random.default_rng(7)
        for _ in range(epochs):
            for g in picks.permutation(len(groups)):
                part = [rows[i] for i in groups[g]]
                index, valid, e = self.emissions([x for x, _, _ in part])
                weight = np.array([c for _, _, c in part], np.float32)
                p, alpha, beta, _, f = self.passes(e, valid, self.t)
                q, steps = self.observed(e, valid, np.array([y for _, y, _ in part]))
                slope = ((p - q) * weight[:, None, None])[valid]
                flat = index[valid]
                used, inverse = np.unique(flat, return_inverse=True)
                d = np.stack([np.bincount(inverse.ravel(), weights=np.repeat(slope[:, s], flat.shape[1]), minlength=len(used)) for s in range(len(STATES))], 1).astype(np.float32)
                d[used == 0] = 0
                d += keep * self.w[used]
                gw[used] += d * d
                self.w[used] -= rate * d / np.sqrt(gw[used])
                turn = ((steps - self._steps(alpha, beta, f, valid, self.t)) * weight[:, None, None]).sum(0)
                gt += turn * turn
                self.t += rate * turn / np.sqrt(gt)

    def sentences(self, batch: list[np.ndarray]) -> np.ndarray:
        """Probability by state that a sentence bears it: clean, if no token is bad."""
        _, valid, e = self.emissions(batch)
        bad = self.some(e, valid, self.t)
        return np.concatenate([1 - bad.max(1, keepdims=True), bad], 1)

    def dump(self) -> bytes:
        used = np.flatnonzero(np.abs(self.w).sum(1))
        out = io.BytesIO()
        np.savez_compressed(out, used=used, w=self.w[used], t=self.t)
        return out.getvalue()

    @classmethod
    def load(cls, stored: bytes) -> Field:
        field, held = cls(), np.load(io.BytesIO(stored))
        field.w[held["used"]], field.t = held["w"], held["t"]
        return field


def pack(words: list[str]) -> np.ndarray:
    f = features_of(words)
    out = np.zeros((len(f), max(map(len, f))), np.int32)
    for i, x in enumerate(f):
        out[i, : len(x)] = x
    return out


def _words(sentence: str) -> tuple[str, ...]:
    return tuple(w for w, _, _ in tokens_of(close_up(_EMPHASIS.sub(r" \1 ", fold(sentence)) if "*" in sentence else fold(sentence))))


def train(labelled: list[tuple[str, str]]) -> Field:
    """The field for documents with labels; without any it knows nothing, and Scorer finds nothing with it."""
    field = Field()
    docs: list[tuple[int, list[tuple[str, ...]]]] = []
    for text, label in labelled:
        if label in STATES and text:
            words = [w for w in {_words(s) for _, s in sentences_of(text)} if w]
            docs.append((STATES.index(label), sorted(words)))
    if not docs:
        return field
    # how often a word or pair of words is in documents of each label
    held: defaultdict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(STATES)))
    total = np.zeros(len(STATES))
    grams = lambda ws: {*ws, *(f"{a} {b}" for a, b in zip(ws, ws[1:]))}
    for y, sentences in docs:
        total[y] += 1
        for g in {g for ws in sentences for g in grams(ws)}:
            held[g][y] += 1
    odds = {}
    for g, c in held.items():
        share = (c + 0.05) / (total + 1)
        odds[g] = np.log(share / ((c[0] + 0.3) / (total[0] + 1)))

    def first(ws: tuple[str, ...], y: int) -> float:
        best = sorted((odds[g][y] for g in grams(ws)), reverse=True)[:6]
        return sum(best) / 6

    packed: dict[tuple[str, ...], np.ndarray] = {}
    for _, sentences in docs:
        for ws in sentences:
            if ws not in packed:
                packed[ws] = pack(list(ws))
    halves = [docs[0::2], docs[1::2]]
    learnt: list[dict[tuple[str, ...], np.ndarray]] = []

    def rows_of(half: int, turn: int) -> dict[tuple[str, ...], np.ndarray]:
        """Votes of a half's documents for their sentences' states, by what the other half has taught."""
        votes: defaultdict[tuple[str, ...], np.ndarray] = defaultdict(lambda: np.zeros(len(STATES)))
        for y, sentences in halves[half]:
            if not y:
                for ws in sentences:
                    votes[ws][0] += 1
                continue
            known = learnt[1 - half] if turn else {}
            rank = {ws: (float(known[ws][y]) if turn else first(ws, y)) for ws in sentences}
            top = max(sentences, key=lambda ws: (rank[ws], ws), default=None)
            for ws in sentences:
                if turn and rank[ws] > 0.5:
                    votes[ws][y] += 1
                elif ws is top:  # one of them must be bad, unless the label is wrong: then no other document bears it out
                    votes[ws][y] += min(1.0, 0.05 + 2 * rank[ws]) if turn else 1.0
                elif turn and known[ws][1:].max() > 0.5:
                    continue  # of another category than the document's one label: no evidence
                else:
                    votes[ws][0] += 0.25  # most likely clean
        return votes

    def fitted(votes: list[dict[tuple[str, ...], np.ndarray]]) -> Field:
        together: defaultdict[tuple[str, ...], np.ndarray] = defaultdict(lambda: np.zeros(len(STATES)))
        for v in votes:
            for ws, c in v.items():
                together[ws] += c
        rows = []
        for ws in sorted(together):
            c = together[ws]
            y = int(c.argmax())
            rows.append((packed[ws], y, float(np.clip(2 * c[y] - c.sum(), 0.05, 3.0)) * (BAD if y else 1.0)))
        field = Field()
        field.fit(rows, EPOCHS)
        return field

    for turn in range(ROUNDS):
        fields = [fitted([rows_of(half, turn)]) for half in (0, 1)]
        learnt = []
        every = sorted(packed, key=lambda ws: (len(ws), ws))
        for field in fields:
            of: dict[tuple[str, ...], np.ndarray] = {}
            for k in range(0, len(every), 512):
                for ws, p in zip(every[k : k + 512], field.sentences([packed[x] for x in every[k : k + 512]])):
                    of[ws] = p
            learnt.append(of)
    return fitted([rows_of(half, ROUNDS) for half in (0, 1)])


class Scorer:
    """Scores texts with a trained field, keeping what it knows of words and sentences it has met.

    A word's own weights are added up once; a batch of sentences is laid end to end, with marks between, and its emissions
    are sums of rows of words and of pairs, without a feature being named.
    """

    def __init__(self, field: Field):
        self.field, self.taught = field, bool(field.w.any())
        self.number: dict[str, int] = {}
        self.hash = np.zeros(1 << 12, np.uint64)
        self.own = np.zeros((1 << 12, 3, len(STATES)), np.float32)  # of the token itself, of the one behind it, of the one before it
        self.known: dict[str, tuple[float, ...]] = {}
        self.start, self.stop = self._word(START), self._word(STOP)

    def _word(self, w: str) -> int:
        k = self.number.get(w)
        if k is None:
            k = self.number[w] = len(self.number)
            if k >= len(self.hash):
                self.hash, self.own = np.concatenate([self.hash, np.zeros_like(self.hash)]), np.concatenate([self.own, np.zeros_like(self.own)])
            self.hash[k] = _number(w)
            self.own[k] = self.field.w[list(_own_ids(w))].sum(0), self.field.w[_id(f"b={w}")], self.field.w[_id(f"a={w}")]
        return k

    def marginals(self, sentences: list[tuple[str, ...]], whole: bool = True) -> tuple[list[np.ndarray], np.ndarray]:
        """Token marginals of each sentence, none of which may be empty, and the probabilities that it has a token in a bad state."""
        flat, at = [], []
        for ws in sentences:
            flat.append(self.start)
            at.append(len(flat))
            flat += [self._word(w) for w in ws]
            flat.append(self.stop)
        x = np.array(flat)
        n, own = self.hash[x], self.own
        e = own[x[1:-1], 0] + own[x[:-2], 1] + own[x[2:], 2] + self.field.w[pair_ids(1, n[:-2], n[1:-1])] + self.field.w[pair_ids(2, n[1:-1], n[2:])]
        out: list[np.ndarray] = [np.empty(0)] * len(sentences)
        some = np.zeros((len(sentences), len(STATES) - 1))
        order = sorted(range(len(sentences)), key=lambda i: len(sentences[i]))
        for k in range(0, len(order), 1024):
            part = order[k : k + 1024]
            size = np.array([len(sentences[i]) for i in part])
            valid = np.arange(size.max())[None] < size[:, None]
            padded = np.zeros((len(part), size.max(), len(STATES)), np.float32)
            padded[valid] = e[np.concatenate([np.arange(at[i] - 1, at[i] - 1 + len(sentences[i])) for i in part])]
            some[part] = self.field.some(padded, valid, self.field.t)
            if whole:
                for i, row, m in zip(part, self.field.passes(padded, valid, self.field.t)[0], size.tolist()):
                    out[i] = row[:m]
        return out, some

    def texts(self, texts: list[str | None]) -> list[tuple[np.ndarray, list[tuple[int, int, str]]]]:
        """Scores by category, and offending spans (start, end in the text, category) of each text."""
        cut = [list(sentences_of(t or "")) for t in texts]
        missing = list({s for rows in cut for _, s in rows if s not in self.known})
        words = [_words(s) for s in missing]
        for s, ws in zip(missing, words):
            self.known[s] = (0.0,) * (len(STATES) - 1)
        full = [(s, ws) for s, ws in zip(missing, words) if ws] if self.taught else []
        for k in range(0, len(full), 8192):
            part = full[k : k + 8192]
            for (s, _), p in zip(part, self.marginals([ws for _, ws in part], whole=False)[1].tolist()):
                self.known[s] = tuple(p)
        bad = [(i, at, s) for i, rows in enumerate(cut) for at, s in rows if max(self.known[s]) >= THRESHOLD]
        spans: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        if bad:
            for (i, at, s), p in zip(bad, self.marginals([_words(s) for _, _, s in bad])[0]):
                for k in range(1, len(STATES)):
                    if self.known[s][k - 1] >= THRESHOLD:
                        hit = np.flatnonzero(p[:, k] >= min(THRESHOLD, p[:, k].max()))
                        spans[i].append((*_span(s, at, len(p), hit), STATES[k]))
        out = [(np.array([self.known[s] for _, s in rows] or [(0.0,) * (len(STATES) - 1)]).max(0), found) for rows, found in zip(cut, spans)]
        if len(self.known) > KEPT:
            self.known.clear()
        if len(self.number) > KEPT:
            self.__init__(self.field)
        return out


def _span(sentence: str, at: int, n: int, hit: np.ndarray) -> tuple[int, int]:
    """Offsets in the text of the tokens from the first to the last hit; the sentence's, where folding moved its tokens."""
    plain = [(m.start(), m.end()) for m in _TOKEN.finditer(sentence)]
    if len(plain) == n and len(hit):
        return at + plain[hit[0]][0], at + plain[hit[-1]][1]
    return at, at + len(sentence)


def training_sample(documents: DataFrame, labels: DataFrame) -> list[tuple[str, str]]:
    """Text and label of at most SAMPLE documents a label, and CLEAN_SAMPLE clean ones: those whose labels agree, first by hash of doc_id."""
    agreed = (
        labels.where(F.col("label").isin(*STATES) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .select("doc_id", "label", F.xxhash64("doc_id").alias("h"))
    )
    chosen = None
    for s in STATES:
        part = agreed.where(F.col("label") == s).orderBy("h", "doc_id").limit(SAMPLE if s != "clean" else CLEAN_SAMPLE)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = documents.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).collect()
    return [(r.text, r.label) for r in sorted(rows, key=lambda r: (r.label, r.doc_id))]


def fit(documents: DataFrame, labels: DataFrame) -> Field:
    """The field trained on the sample of labelled documents, on the driver: at most SAMPLE documents a bad label and CLEAN_SAMPLE clean ones, whatever the data."""
    return train(training_sample(documents, labels))


_SCORERS: dict[object, Scorer] = {}


def score_documents(documents: DataFrame, field: Field) -> DataFrame:
    """doc_id, source, abusive, hateful, sexual (scores in [0, 1]), spans of every document.

    A null or empty text scores 0 everywhere. Repeated rows are scored each; null ids and sources stay. spans: offending
    start and end offsets with their category.
    """
    spark = documents.sparkSession
    sent = spark.sparkContext.broadcast(field.dump())  # at most BUCKETS rows, whatever the data
    name = uuid.uuid4().hex

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if name not in _SCORERS:  # once a worker
            _SCORERS.clear()
            _SCORERS[name] = Scorer(Field.load(sent.value))
        scorer = _SCORERS[name]
        for batch in batches:
            found = scorer.texts(batch["text"].tolist())
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"),
                "source": batch["source"],
                **{s: [float(x[k]) for x, _ in found] for k, s in enumerate(STATES[1:])},
                "spans": [[{"start": a, "end": b, "category": c} for a, b, c in spans] for _, spans in found],
            })

    schema = "doc_id BIGINT, source STRING, abusive DOUBLE, hateful DOUBLE, sexual DOUBLE, spans ARRAY<STRUCT<start: INT, end: INT, category: STRING>>"
    return documents.select("doc_id", "source", "text").mapInPandas(score, schema)


def categories(scored: DataFrame) -> DataFrame:
    """doc_id, category of each category whose score reaches THRESHOLD."""
    pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("category"), F.col(s).alias("score")) for s in STATES[1:]]))
    return scored.select("doc_id", pairs.alias("p")).where(F.col("p.score") >= THRESHOLD).select("doc_id", F.col("p.category").alias("category")).distinct()


def source_rates(scored: DataFrame) -> DataFrame:
    """source, documents, and the share of them that reaches THRESHOLD by category and in any."""
    hit = {s: F.col(s) >= THRESHOLD for s in STATES[1:]}
    return scored.groupBy("source").agg(
        F.count("*").alias("documents"),
        *[F.avg(c.cast("double")).alias(f"{s}_rate") for s, c in hit.items()],
        F.avg((hit["abusive"] | hit["hateful"] | hit["sexual"]).cast("double")).alias("any_rate"),
    )
