"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in NumPy.

A word's input is its row of a word table beside the mean of the rows of its letter trigrams, so
unseen words are read by their letters. Texts are cut into overlapping windows of words; the network
reads a window in both directions, attention weighs its states, and a logistic unit scores the pooled
state. A text scores as its worst window. Only texts are labelled, not windows: every training round
takes, of each text, the window that now scores highest, and of clean texts another one beside it.

Training takes a bounded sample of the labelled texts; scoring reads every word of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.pu_quality import fold
from millrace.llm.staging import bound_batches
from millrace.llm.words import hash_words, pieces, utf8

THRESHOLD = 0.7
#: Words of a window, and from one window to the next.
WINDOW, STRIDE = 48, 36
#: States of each direction; width of word and trigram rows; trigram rows.
STATES, WIDTH, TRIGRAMS = 8, 8, 4096
#: Bounds of the training sample: toxic and clean texts, windows of one text, words of the table.
TOXIC_TEXTS, CLEAN_TEXTS, TEXT_WINDOWS, VOCABULARY = 1500, 2500, 12, 10_000
STEPS, RATE, DECAY, SEED = 400, 0.02, 1e-4, 13
#: Windows of one training step (STEPS of them, however large the sample).
BATCH = 128
#: Texts that a word must occur in to have a row of its own.
SEEN = 3
#: Windows that are read side by side, and text of one step.
SIDE, STEP_BYTES = 2048, 2 << 20
_WORD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Runs of letters and digits, A-Z lower-cased; bytes above 127 count as letters."""
    return text.translate(_WORD).split()


def trigrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Row of the trigram around every byte of the words, and where each word's begin."""
    line = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    mixed = line[:-2] * np.uint32(0x9E3779B1) ^ line[1:-1] * np.uint32(0x85EBCA6B) ^ line[2:] * np.uint32(0xC2B2AE35)
    rows = ((mixed ^ mixed >> np.uint32(15)) * np.uint32(0x27D4EB2F) >> np.uint32(20)) % np.uint32(TRIGRAMS)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return rows[line[1:-1] != 32].astype(np.int64), np.cumsum(sizes) - sizes


def window_starts(n: int) -> list[int]:
    """Where the windows of a text of ``n`` words begin; the last one ends with the text."""
    return [] if not n else [0] if n <= WINDOW else [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.clip(x, -30, 30, out=x)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _added(size: int, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` by place."""
    out = np.zeros((size, values.shape[1]), np.float32)
    if len(at):
        order = np.argsort(at, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(at[order]) > 0])
        out[at[order][first]] = np.add.reduceat(values[order], first, axis=0)
    return out


@dataclass
class Spelled:
    """Words as the network reads them: row in the word table, trigram rows, and how many of these each has."""

    row: np.ndarray
    grams: np.ndarray
    sizes: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    def take(self, which: np.ndarray) -> Spelled:
        sizes = self.sizes[which]
        first = np.repeat(self.starts[which] - (np.cumsum(sizes) - sizes), sizes)
        return Spelled(self.row[which], self.grams[first + np.arange(len(first))], sizes)


@dataclass
class Network:
    """Weights by name, and the hashes of the words that have a row (row 0 is for the others)."""

    words: np.ndarray
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, words: np.ndarray, lean: np.ndarray, seed: int = SEED) -> Network:
        """Random weights; a word's first value is its ``lean`` towards toxic texts."""
        pick = np.random.default_rng(seed)

        def some(*shape: int) -> np.ndarray:
            return pick.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

        table = pick.normal(0, 0.05, (len(words) + 1, WIDTH)).astype(np.float32)
        table[1:, 0] = lean
        w = {"words": table, "letters": pick.normal(0, 0.2, (TRIGRAMS, WIDTH)).astype(np.float32)}
        for way in "fb":
            w[f"in_{way}"], w[f"bias_{way}"], w[f"back_{way}"] = some(2 * WIDTH, 3 * STATES), np.zeros(3 * STATES, np.float32), some(STATES, 3 * STATES)
        w["attend"], w["out"], w["const"] = some(2 * STATES, 1)[:, 0], some(2 * STATES, 1)[:, 0], np.full(1, -1, np.float32)
        return cls(words, w)

    def spelled(self, words: list[bytes]) -> Spelled:
        hashes = hash_words(words)
        at = np.minimum(np.searchsorted(self.words, hashes), max(0, len(self.words) - 1))
        known = self.words[at] == hashes if len(self.words) else np.zeros(len(words), bool)
        grams, starts = trigrams(words)
        return Spelled(np.where(known, at + 1, 0), grams, np.diff(np.r_[starts, len(grams)]))

    def inputs(self, words: Spelled) -> np.ndarray:
        letters = np.add.reduceat(self.weights["letters"][words.grams], words.starts, axis=0) / words.sizes[:, None]
        return np.hstack([self.weights["words"][words.row], letters]).astype(np.float32)

    def gates(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        return {way: inputs @ self.weights[f"in_{way}"] + self.weights[f"bias_{way}"] for way in "fb"}

    def read(self, gates: dict[str, np.ndarray], codes: np.ndarray, mask: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Score of each window, and its states; ``codes`` and ``mask`` have a row per place in the window."""
        steps, n = codes.shape
        states = np.empty((2, steps, n, STATES), np.float32)
        for k, way in enumerate("fb"):
            both, new = (np.ascontiguousarray(gates[way][:, part]) for part in (slice(2 * STATES), slice(2 * STATES, None)))
            back = self.weights[f"back_{way}"]
            back_both, back_new = np.ascontiguousarray(back[:, :2 * STATES]), np.ascontiguousarray(back[:, 2 * STATES:])
            h = np.zeros((n, STATES), np.float32)
            for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
                rz = both.take(codes[t], axis=0)
                rz += h @ back_both
                _sigmoid(rz)
                u = h @ back_new
                u *= rz[:, :STATES]
                u += new.take(codes[t], axis=0)
                np.tanh(u, out=u)
                nxt = states[k, t]
                np.subtract(h, u, out=nxt)
                nxt *= rz[:, STATES:]
                nxt += u
                if mask is not None:
                    np.copyto(nxt, h, where=~mask[t][:, None])
                h = nxt
        return _sigmoid(self.pooled(states, mask)[1] @ self.weights["out"] + self.weights["const"]), states

    def pooled(self, states: np.ndarray, mask: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Attention of each place, and the states weighed by it."""
        attend = self.weights["attend"]
        weigh = states[0] @ attend[:STATES] + states[1] @ attend[STATES:]
        if mask is not None:
            weigh[~mask] = -np.inf
        weigh = np.exp(weigh - weigh.max(0))
        weigh /= weigh.sum(0)
        return weigh, np.hstack([np.einsum("tn,tnh->nh", weigh, s) for s in states])

    def slopes(self, words: Spelled, codes: np.ndarray, mask: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean logistic loss."""
        w, inputs = self.weights, self.inputs(words)
        gates = self.gates(inputs)
        score, states = self.read(gates, codes, mask)
        weigh, pooled = self.pooled(states, mask)
        miss = (score - target) / len(target)
        out = {"out": pooled.T @ miss, "const": miss.sum(keepdims=True)}
        at_pool = miss[:, None] * w["out"]
        both = np.concatenate([states[0], states[1]], axis=2)
        at_weigh = np.einsum("tnh,nh->tn", both, at_pool)
        at_logit = weigh * (at_weigh - (weigh * at_weigh).sum(0))
        out["attend"] = np.einsum("tn,tnh->h", at_logit, both)
        at_state = weigh[:, :, None] * at_pool + at_logit[:, :, None] * w["attend"]
        at_inputs = np.zeros_like(inputs)
        steps, n = codes.shape
        for k, way in enumerate("fb"):
            back, order = w[f"back_{way}"], range(steps) if way == "f" else range(steps - 1, -1, -1)
            at_input = np.empty((steps, n, 3 * STATES), np.float32)
            at_back, carry = np.zeros_like(back), np.zeros((n, STATES), np.float32)
            for t in reversed(order):
                first = t == order[0]
                h = np.zeros((n, STATES), np.float32) if first else states[k, t - 1 if way == "f" else t + 1]
                x, g = gates[way][codes[t]], h @ back
                rz = _sigmoid(x[:, :2 * STATES] + g[:, :2 * STATES])
                r, z = rz[:, :STATES], rz[:, STATES:]
                u = np.tanh(x[:, 2 * STATES:] + r * g[:, 2 * STATES:])
                here = at_state[t][:, k * STATES:(k + 1) * STATES] * mask[t][:, None] + carry
                live = here * mask[t][:, None]
                at_u = live * (1 - z) * (1 - u * u)
                at_z = live * (h - u) * z * (1 - z)
                at_r = at_u * g[:, 2 * STATES:] * r * (1 - r)
                at_g = np.hstack([at_r, at_z, at_u * r])
                at_input[t, :, :STATES], at_input[t, :, STATES:2 * STATES], at_input[t, :, 2 * STATES:] = at_r, at_z, at_u
                at_back += h.T @ at_g
                carry = here * ~mask[t][:, None] + live * z + at_g @ back.T
            at_gates = _added(len(inputs), codes.ravel(), at_input.reshape(-1, 3 * STATES))
            out[f"in_{way}"], out[f"bias_{way}"], out[f"back_{way}"] = inputs.T @ at_gates, at_gates.sum(0), at_back
            at_inputs += at_gates @ w[f"in_{way}"].T
        out["words"] = _added(len(w["words"]), words.row, at_inputs[:, :WIDTH])
        out["letters"] = _added(TRIGRAMS, words.grams, np.repeat(at_inputs[:, WIDTH:] / words.sizes[:, None].astype(np.float32), words.sizes, axis=0))
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Score of each text: the highest of its windows; a text without words scores as an empty window."""
        batch = Batch.of(texts)
        best = np.full(len(texts), _sigmoid(self.weights["const"].copy())[0], np.float32)
        if batch.words:
            found = self.window_scores(batch, self.spelled(batch.words))
            some = np.flatnonzero(np.bincount(batch.owner, minlength=len(texts)))
            best[some] = np.maximum.reduceat(found, np.searchsorted(batch.owner, some))
        return np.round(best.astype(np.float64), 6)

    def window_scores(self, batch: Batch, words: Spelled) -> np.ndarray:
        gates = self.gates(self.inputs(words))
        out = np.zeros(len(batch.starts), np.float32)
        order = np.argsort(-batch.sizes, kind="stable")  # full windows first, so that few need a mask
        for a in range(0, len(order), SIDE):
            side = order[a:a + SIDE]
            codes, mask = batch.windows(side)
            out[side] = self.read(gates, codes, None if mask.all() else mask)[0]
        return out


@dataclass
class Batch:
    """Texts as codes of their different words, and all their windows: text, start, number of words."""

    words: list[bytes]
    codes: np.ndarray
    owner: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Batch:
        split = [words_of(t) for t in texts]
        coded = pa.array([w for words in split for w in words], pa.binary()).dictionary_encode()
        owner, starts, sizes, base = [], [], [], 0
        for i, words in enumerate(split):
            n = len(words)
            own = window_starts(n)
            owner += [i] * len(own)
            starts += [base + s for s in own]
            sizes += [min(n, WINDOW)] * len(own)
            base += n
        return cls(coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64), *(np.array(x, np.int64) for x in (owner, starts, sizes)))

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the windows, a row per place, and which places hold a word."""
        place = np.arange(int(self.sizes[which].max(initial=1)))[:, None]
        mask = place < self.sizes[which]
        return self.codes[np.where(mask, self.starts[which] + place, 0)], mask


def train(texts: list[bytes], toxic: np.ndarray, steps: int = STEPS, seed: int = SEED) -> Network | None:
    """Fits the network on labelled windows, given as texts of consecutive windows; None without both kinds.

    ``texts`` are whole sampled texts, or their sampled windows joined; ``toxic`` their labels.
    """
    toxic = toxic.astype(bool)
    if not toxic.any() or toxic.all():
        return None
    batch = Batch.of(texts)
    if not batch.words:
        return None
    owner = np.repeat(np.arange(len(texts)), [len(words_of(t)) for t in texts])
    held = np.unique(owner * len(batch.words) + batch.codes)  # different words of each text
    label = toxic[held // len(batch.words)]
    bad, good = (np.bincount(held[label == kind] % len(batch.words), minlength=len(batch.words)) for kind in (True, False))
    # How much likelier the word is in toxic texts; rare words lean less.
    lean = np.log((bad + 0.5) / (toxic.sum() + 1)) - np.log((good + 0.5) / ((~toxic).sum() + 1))
    lean *= (bad + good) / (bad + good + 4.0)
    pickable = np.flatnonzero(bad + good >= SEEN)
    picked = pickable[np.argsort(-np.abs(lean[pickable]), kind="stable")[:VOCABULARY]]
    hashes = hash_words([batch.words[i] for i in picked.tolist()])
    order = np.argsort(hashes)
    net = Network.fresh(hashes[order], np.clip(lean[picked][order] / 2, -2, 2), seed)
    words, pick = net.spelled(batch.words), np.random.default_rng(seed)
    moved = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.weights.items()}
    texts_with = np.unique(batch.owner)
    first = np.searchsorted(batch.owner, texts_with)
    count = np.diff(np.r_[first, len(batch.owner)])
    # The first round takes the window with the word that leans most.
    worst = np.array([lean[c].max(initial=-9) for c in (batch.codes[a:a + n] for a, n in zip(batch.starts.tolist(), batch.sizes.tolist()))])
    step = 0
    while step < steps:
        worst = net.window_scores(batch, words) if step else worst
        top = np.array([a + int(worst[a:a + n].argmax()) for a, n in zip(first.tolist(), count.tolist())])
        other = first + pick.integers(0, count)
        clean = ~toxic[texts_with]
        chosen = np.r_[top, other[clean & (other != top)]]
        target = toxic[batch.owner[chosen]].astype(np.float32)
        shuffled = pick.permutation(len(chosen))
        rate = RATE * max(0.05, 1 - step / steps)
        for a in range(0, len(chosen), BATCH):
            part = shuffled[a:a + BATCH]
            codes, mask = batch.windows(chosen[part])
            used, local = np.unique(codes, return_inverse=True)
            step += 1
            for name, slope in net.slopes(words.take(used), local.reshape(codes.shape), mask, target[part]).items():
                w, (one, two) = net.weights[name], moved[name]
                slope = slope + (DECAY * w if name not in ("words", "const") else 0)
                one += 0.1 * (slope - one)
                two += 0.001 * (slope * slope - two)
                w -= (rate * (one / (1 - 0.9 ** step)) / (np.sqrt(two / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def _evenly(n: int, most: int) -> list[int]:
    return list(range(n)) if n <= most else [i * (n - 1) // (most - 1) for i in range(most)]


def sample(docs: DataFrame, labels: DataFrame, toxic_texts: int = TOXIC_TEXTS, clean_texts: int = CLEAN_TEXTS) -> tuple[list[bytes], np.ndarray]:
    """A bounded sample of the texts labelled in folds other than 1: texts (of long ones evenly spaced windows) and labels.

    The sample is picked by a hash of doc_id, so it does not depend on the order of rows. A document
    with several labels is toxic if one of them says so.
    """
    known = (labels.filter((fold(F.col("doc_id"), 3) != 1) & F.col("toxic").isNotNull())
             .groupBy(F.col("doc_id").alias("_doc")).agg(F.max("toxic").alias("_toxic")))
    order = (F.xxhash64("_doc"), "_doc")
    taken = (known.filter("_toxic = 1").orderBy(*order).limit(toxic_texts)
             .unionByName(known.filter("_toxic = 0").orderBy(*order).limit(clean_texts)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text in utf8(batch.column("text")):
                words = words_of(text)
                starts = window_starts(len(words))
                if len(starts) > TEXT_WINDOWS:
                    words = [w for i in _evenly(len(starts), TEXT_WINDOWS) for w in words[starts[i]:starts[i] + WINDOW]]
                texts.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column("_doc"), batch.column("_toxic"), pa.array(texts, pa.binary())], ["doc", "toxic", "text"])

    kind, label = known.schema["_doc"].dataType.simpleString(), known.schema["_toxic"].dataType.simpleString()
    # The limits bound what is broadcast and what comes back.
    rows = (docs.select("doc_id", "text").join(F.broadcast(taken), F.col("doc_id") == F.col("_doc")).select("_doc", "_toxic", "text")
            .mapInArrow(cut, f"doc {kind}, toxic {label}, text binary").dropDuplicates(["doc"]).orderBy(F.xxhash64("doc"), "doc").toArrow())
    return rows.column("text").to_pylist(), rows.column("toxic").to_numpy() == 1


def fit(docs: DataFrame, labels: DataFrame, **bounds: int) -> Network | None:
    """The network fitted on :func:`sample`; None if there are not texts of both kinds."""
    bound_batches(docs.sparkSession)
    return train(*sample(docs, labels, **bounds))


def scored(docs: DataFrame, network: Network | None) -> DataFrame:
    """Adds ``score`` (0 to 1) to doc_id of every row; NULL counts as empty, other columns are ignored.

    Every word of every text is read, in windows of 48 words that overlap by 12 or more. Without a
    network, as without labels, every score is 0.5. An empty table gives an empty result.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(network)  # of fixed size, whatever the corpus

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in pieces(batches, size=STEP_BYTES):
            texts = utf8(batch.column("text"))
            scores = net.scores(texts) if net else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(apply, f"doc_id {kind}, score double")
