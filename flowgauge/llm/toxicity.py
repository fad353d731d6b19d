"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy on a bounded sample.

A word is the sum of two hashed rows, one for the word and one for its first four bytes. Filters of several widths run
over the whole text, the maximum of each goes into a logistic output. The cut of each language (guessed from the text's
own function words) is set on labelled rows that training has not seen, and moves the score so that 0.5 is the cut.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts
from .labelled import labelled_sample, with_texts

SLOTS = 1 << 18
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
POSITIVES = 3_000
NEGATIVES = 5_000
TRAINED_WORDS = 8_000_000
STEP_WORDS = 400_000
LEAST_DOCUMENTS = 5
EPOCHS = 6
BATCH_BYTES = 4_000_000
PART_WORDS = 200_000
SEED = 5

# Frequent function words per language.
FUNCTION_WORDS = {
    "en": "the of and to that for with was are",
    "de": "der die und den das ein mit von auf ist",
    "fr": "le les des une dans est pour que qui par",
    "es": "el los las una por con para del como más",
}
STRIPPED = b".,;:!?\"'()[]#$%&*|-"


def _words(text: bytes) -> list[bytes]:
    return text.lower().split()


class Vocabulary:
    """Distinct words of a batch, their two slots and their language votes."""

    def __init__(self):
        self.ids: dict[bytes, int] = {}

    def lookup(self, words: list[bytes]) -> np.ndarray:
        ids = self.ids
        for w in set(words).difference(ids):
            ids[w] = len(ids)
        return np.fromiter(map(ids.__getitem__, words), np.int32, len(words))

    def slots(self) -> np.ndarray:
        """(words, 2) slots of word and beginning; marks around a word are ignored."""
        out = np.zeros((len(self.ids), 2), np.int64)
        for w, i in self.ids.items():
            bare = w.strip(STRIPPED)
            if bare:
                out[i, 0] = xxhash.xxh32_intdigest(bare) % (SLOTS - 1) + 1
                out[i, 1] = xxhash.xxh32_intdigest(bare[:4], 7) % (SLOTS - 1) + 1
        return out

    def votes(self) -> np.ndarray:
        """(words, languages): 1 where a word is a function word of that language."""
        out = np.zeros((len(self.ids), len(FUNCTION_WORDS)), np.float32)
        for k, line in enumerate(FUNCTION_WORDS.values()):
            for w in line.encode().split():
                for shape in (w, w + b".", w + b","):
                    if shape in self.ids:
                        out[self.ids[shape], k] = 1
        return out


@dataclass
class ToxicModel:
    """Trained rows of the embedding (slot numbers ascending), filters, output, and cuts by language ("" for none)."""

    slots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    rows: np.ndarray = field(default_factory=lambda: np.zeros((0, DIM), np.float32))
    filters: dict[int, np.ndarray] = field(default_factory=dict)
    bias: dict[int, np.ndarray] = field(default_factory=dict)
    out: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    intercept: float = 0.0
    cuts: np.ndarray = field(default_factory=lambda: np.zeros(len(FUNCTION_WORDS) + 1))

    def embed(self, slots: np.ndarray) -> np.ndarray:
        table = np.concatenate([self.rows, np.zeros((1, DIM), np.float32)])
        at = np.searchsorted(self.slots, slots)
        known = (at < len(self.slots)) & (self.slots[np.minimum(at, max(0, len(self.slots) - 1))] == slots) \
            if len(self.slots) else np.zeros(slots.shape, bool)
        return table[np.where(known, at, len(self.slots))].sum(1)

    def pooled(self, embedded: np.ndarray, ids: np.ndarray, starts: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """Maxima per text and filter, and all values if they are to be kept; every text ends in padding rows."""
        best, kept = [], []
        for width in WIDTHS:
            parts = [embedded @ self.filters[width][j] for j in range(width)]
            values = parts[0][ids]
            for j in range(1, width):
                values[:len(ids) - j] += parts[j][ids[j:]]
            best.append(np.maximum.reduceat(values, starts, axis=0))
            if keep:
                kept.append(values)
        return np.concatenate(best, axis=1), kept

    def logits(self, documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Logit and guessed language of each text (the last number: none)."""
        vocabulary = Vocabulary()
        return self.coded_logits(vocabulary, [vocabulary.lookup(words) for words in documents])

    def coded_logits(self, vocabulary: "Vocabulary", coded: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts as word numbers, a bounded part of them at a time."""
        pad = len(vocabulary.ids)
        votes = vocabulary.votes()
        language = np.full(len(coded), len(FUNCTION_WORDS))
        for i, ids in enumerate(coded):
            heard = votes[ids].sum(0) if len(ids) else np.zeros(1)
            if heard.max() > 0:
                language[i] = int(heard.argmax())
        if not self.filters or not coded:
            return np.full(len(coded), self.intercept), language
        embedded = np.concatenate([self.embed(vocabulary.slots()), np.zeros((1, DIM), np.float32)])
        bias, out = np.concatenate([self.bias[w] for w in WIDTHS]), []
        for a, b in slices([len(ids) for ids in coded], PART_WORDS):
            ids, starts = padded(coded[a:b], pad)
            out.append(np.maximum(self.pooled(embedded, ids, starts)[0] + bias, 0) @ self.out + self.intercept)
        return np.concatenate(out), language

    def scores(self, documents: list[list[bytes]]) -> np.ndarray:
        logit, language = self.logits(documents)
        return 1 / (1 + np.exp(-np.clip(logit - self.cuts[language], -60, 60)))


def padded(coded: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts in a row, each followed by as many padding words as the widest filter needs."""
    gap = np.full(max(WIDTHS), pad, np.int32)
    ids = np.concatenate([part for one in coded for part in (one, gap)])
    lengths = np.array([len(one) + len(gap) for one in coded])
    return ids, np.cumsum(lengths) - lengths


def train(documents: list[list[bytes]], y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> ToxicModel:
    vocabulary = Vocabulary()
    return train_coded(vocabulary, [vocabulary.lookup(words) for words in documents], y, epochs, seed)


def train_coded(vocabulary: Vocabulary, coded: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> ToxicModel:
    """Train on all texts but every fifth, which set the cuts. One class only, or no rows: a constant score.

    Without rows nothing is called toxic.
    """
    if len(y) == 0:
        return ToxicModel(intercept=-3.0)
    if y.min() == y.max():
        return ToxicModel(intercept=3.0 if y[0] else -3.0)
    rng = np.random.default_rng(seed)
    slots = vocabulary.slots()
    fitted = np.arange(len(y)) % 5 != 0
    # Slots seen in enough documents are trained; the others stay zero, so rare words cannot decide.
    seen = np.zeros((2, SLOTS))
    for ids, label, use in zip(coded, y, fitted, strict=True):
        if use:
            seen[label, np.unique(slots[ids])] += 1
    seen[:, 0] = 0
    used = np.nonzero(seen.sum(0) >= LEAST_DOCUMENTS)[0]
    share = (seen[:, used] + 0.5) / (np.bincount(y[fitted], minlength=2)[:, None] + 1)
    rows = rng.normal(0, 0.2, (len(used), DIM)).astype(np.float32)
    rows[:, 0] = np.clip(np.log(share[1] / share[0]), -3, 3) / 3
    model = ToxicModel(used, rows, intercept=-2.0)
    for width in WIDTHS:
        weights = rng.normal(0, 0.5, (width, DIM, FILTERS)).astype(np.float32)
        # Half of the filters start on the log odds of words, the others free.
        weights[:, :, ::2] *= 0.1
        weights[:, 0, ::2] = 1 / width
        model.filters[width], model.bias[width] = weights, np.full(FILTERS, -0.2, np.float32)
    model.out = np.tile(np.array([0.3, 0.1, 0.3, -0.1], np.float32), len(WIDTHS) * FILTERS // 4)
    _descend(model, coded, slots, y, np.nonzero(fitted)[0], epochs, rng)
    logit, language = model.coded_logits(vocabulary, coded)
    for k in range(len(model.cuts)):
        # A language without enough unseen rows of both labels takes the cut of all languages.
        own = ~fitted & (language == k)
        own = own if min(y[own].sum(), (1 - y[own]).sum()) >= 10 else ~fitted
        model.cuts[k] = best_cut(logit[own], y[own])
    return model


def best_cut(logit: np.ndarray, y: np.ndarray) -> float:
    """The cut with the fewest errors, in the middle of the widest gap that has them."""
    if len(y) == 0 or y.min() == y.max():
        return 0.0
    order = np.argsort(logit, kind="stable")
    value, label = logit[order], y[order]
    errors = np.concatenate([[0], np.cumsum(label)]) + np.concatenate([np.cumsum((1 - label)[::-1])[::-1], [0]])
    low, high = np.concatenate([[value[0] - 1], value]), np.concatenate([value, [value[-1] + 1]])
    gap = np.where(errors == errors.min(), high - low, -1)
    k = int(gap.argmax())
    return float((low[k] + high[k]) / 2)


def _steps(rows: np.ndarray, coded: list[np.ndarray], batch: int):
    """The texts of each step: ``batch`` of them, fewer where they are long."""
    for a in range(0, len(rows), batch):
        mine = rows[a:a + batch]
        for b, c in slices([len(coded[i]) for i in mine], STEP_WORDS):
            yield mine[b:c]


def _descend(model: ToxicModel, coded, slots, y, rows, epochs, rng, batch: int = 64, rate: float = 0.02) -> None:
    """Adam on all parameters; the gradient of a maximum goes to the words under it."""
    table = np.concatenate([model.rows, np.zeros((1, DIM), np.float32)])
    row_of = np.searchsorted(model.slots, slots)
    known = model.slots[np.minimum(row_of, len(model.slots) - 1)] == slots if len(model.slots) else np.zeros(slots.shape, bool)
    row_of = np.concatenate([np.where(known, row_of, len(model.slots)), [[len(model.slots)] * 2]])
    pad = len(slots)
    state: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    step = 0

    def adam(name, value, gradient):
        m, v = state.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
        m += 0.1 * (gradient - m)
        v += 0.001 * (gradient * gradient - v)
        value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    intercept, squares = np.array([model.intercept], np.float32), np.zeros_like(table)
    for _ in range(epochs):
        rng.shuffle(rows)
        for mine in _steps(rows, coded, batch):
            step += 1
            ids, starts = padded([coded[i] for i in mine], pad)
            word, at = np.unique(ids, return_inverse=True)
            embedded = table[row_of[word]].sum(1)
            pooled, values = model.pooled(embedded, at, starts, keep=True)
            bias = np.concatenate([model.bias[w] for w in WIDTHS])
            active = np.maximum(pooled + bias, 0)
            p = 1 / (1 + np.exp(-np.clip(active @ model.out + intercept[0], -30, 30)))
            error = (p - y[mine]).astype(np.float32) / len(mine)
            d_active = np.outer(error, model.out) * (active > 0)
            d_table = np.zeros_like(table)
            of = np.repeat(np.arange(len(mine)), np.diff(np.concatenate([starts, [len(ids)]])))
            for k, width in enumerate(WIDTHS):
                cols = slice(k * FILTERS, (k + 1) * FILTERS)
                hit = values[k] == pooled[of, cols]
                # First place of each maximum.
                where, unit = np.nonzero(hit)
                first = np.unique(of[where] * FILTERS + unit, return_index=True)[1]
                where, unit = where[first], unit[first]
                g = d_active[of[where], k * FILTERS + unit]
                d_filter = np.zeros_like(model.filters[width])
                for j in range(width):
                    there = at[np.minimum(where + j, len(at) - 1)]
                    np.add.at(d_filter[j].T, unit, g[:, None] * embedded[there])
                    push = g[:, None] * model.filters[width][j].T[unit]
                    for s in range(2):
                        np.add.at(d_table, row_of[word[there], s], push)
                adam(f"f{width}", model.filters[width], d_filter)
                adam(f"b{width}", model.bias[width], d_active[:, cols].sum(0))
            d_table[-1] = 0
            touched = np.nonzero(d_table.any(1))[0]
            # Rows of rare words: a running square per row, no momentum, so untouched rows rest.
            squares[touched] = 0.95 * squares[touched] + 0.05 * d_table[touched] ** 2
            table[touched] -= rate * d_table[touched] / (np.sqrt(squares[touched]) + 1e-6)
            adam("out", model.out, (active * error[:, None]).sum(0))
            adam("intercept", intercept, np.array([error.sum()], np.float32))
    model.rows = table[:-1].copy()
    model.intercept = float(intercept[0])


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
                 positives: int = POSITIVES, negatives: int = NEGATIVES, held_out: int = 0, words: int = TRAINED_WORDS) -> ToxicModel:
    """Train on at most ``positives`` and ``negatives`` labelled documents outside the held-out fold, ``words`` words in all.

    Documents are taken whole and in the order of their hashed ids, long ones too; one that does not fit into what is left of
    ``words`` is passed over.
    """
    both = labelled_sample(labels, label, positives, held_out, value=1).unionByName(
        labelled_sample(labels, label, negatives, held_out, value=0))
    rows = with_texts(both, docs, id_col, text_col).orderBy(F.xxhash64("doc_id"), "doc_id", "y")
    # Texts come one by one and stay as word numbers only.
    vocabulary, coded, y = Vocabulary(), [], []
    for row in rows.select("text", "y").toLocalIterator():
        parts = _words(row.text.encode())
        if len(parts) <= words:
            words -= len(parts)
            coded.append(vocabulary.lookup(parts))
            y.append(row.y)
    return train_coded(vocabulary, coded, np.array(y, int))


def score_toxicity(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, language) of every whole text.

    Null texts score as empty ones; an empty text has no maxima but those of padding. Repeated rows score alike; other
    columns are not read. ``language`` is the guess that chose the cut, or null.
    """
    names = [*FUNCTION_WORDS, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(1).cast(pa.binary()).to_pylist()
            for a, b in slices([len(t) for t in raw], BATCH_BYTES):
                documents = [_words(t) for t in raw[a:b]]
                logit, language = model.logits(documents)
                score = 1 / (1 + np.exp(-np.clip(logit - model.cuts[language], -60, 60)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(score.astype(float)), pa.array([names[k] for k in language], pa.string())],
                    names=["doc_id", "score", "language"])

    kind = docs.schema[id_col].dataType.simpleString()
    return texts(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, score double, language string")
