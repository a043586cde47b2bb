"""Language identification.

A text is the average of hashed subword embeddings, put through a linear
softmax.  Embeddings and softmax are trained together by stochastic gradient
descent in numpy on a bounded sample of whole texts.  A temperature fitted on a
part of the sample that the training left out calibrates the probabilities.

Rejection is calibrated on the same part, as a function of a text's length: a
text goes if the odds of its best language, or how familiar its subwords are to
that language, fall below what nearly all right ones of that length reach.
(Odds alone take a language that was not learned for its next relative, surely;
its subwords tell.)  What shorter texts reach is found by drawing so many of a
text's subwords."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitstop.llm.text import mix64, slices

BUCKETS = 1 << 14                # at most 2^16: the sample's travel in 16-bit numbers
GRAMS = (2, 3, 4)                # subwords: byte n-grams within a word and its two ends
DIM, EPOCHS, BATCH, RATE = 16, 12, 16, 0.5
SAMPLE_PER_LANG = 1_500          # labelled documents of a language that are learned from, about
SAMPLE_TOTAL = 20_000            # of all languages, about
CALIBRATION = 5                  # one in so many of the sample calibrates
FALSE_REJECTS = 0.002            # of right predictions on the calibration part, by each of the two tests
SLACK = 0.25                     # and so much further from the median, as the part is a sample
DRAWS = (8, 64, 512, 4096)       # subwords drawn from a text to stand for a shorter one
DEPENDENT = 4                    # subwords of a text that tell as much as one drawn by itself: they overlap
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[9:14] = 32


def gram_buckets(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length: the bucket of every n-gram, and the byte where
    it begins.  A to Z are lowered and white space is one sign, which an
    n-gram can only have at its ends; none crosses two texts."""
    folded = _FOLD[data]
    space = folded == 32
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    for n in GRAMS:
        m = len(data) - n + 1
        if m <= 0:
            continue
        code = folded[:m].astype(np.uint64)
        bad = np.zeros(m, bool)
        for j in range(1, n):
            code = (code << np.uint64(8)) | folded[j:j + m]
            bad |= edge[j:j + m]
            if j < n - 1:
                bad |= space[j:j + m]
        if n == 2:
            bad |= space[:m] & space[1:]
        at = np.flatnonzero(~bad)
        yield (mix64(code[at] + np.uint64(n << 40)) % np.uint64(BUCKETS)).astype(np.int32), at


@dataclass
class Model:
    langs: list[str]
    logits: np.ndarray           # bucket x lang: the embeddings through the softmax's weights
    bias: np.ndarray
    temperature: float
    familiar: np.ndarray         # bucket x lang: log share of the bucket among the language's subwords
    floors: np.ndarray           # 2 x DRAWS: least log odds and familiarity

    def rejects(self, count: np.ndarray, odds: np.ndarray, known: np.ndarray) -> np.ndarray:
        at = np.log2(np.maximum(count / DEPENDENT, 1))
        grid = np.log2(DRAWS)
        return (odds < np.interp(at, grid, self.floors[0])) | (known < np.interp(at, grid, self.floors[1]))

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """text x lang, and which are rejected; a text without n-grams gets
        the bias alone and is rejected."""
        total = np.zeros((len(offsets) - 1, len(self.langs)))
        count, known = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
        grams = []
        for buckets, at in gram_buckets(data, offsets):
            bounds = np.searchsorted(at, offsets)
            grams.append((buckets, bounds))
            count += np.diff(bounds)
            for k in range(len(self.langs)):
                total[:, k] += _sums(self.logits[:, k][buckets], bounds)
        x = (total / np.maximum(count, 1)[:, None] + self.bias) / self.temperature
        best = x.argmax(axis=1)
        for buckets, bounds in grams:
            known += _sums(self.familiar[buckets, np.repeat(best, np.diff(bounds))], bounds)
        return softmax(x), (count == 0) | self.rejects(count, log_odds(x), known / np.maximum(count, 1))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of the values of each text."""
    sums = np.zeros(len(values) + 1)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def log_odds(x: np.ndarray) -> np.ndarray:
    """Of the best language against all others; a probability near 1 would be rounded to it."""
    x = np.sort(x, axis=1)
    if x.shape[1] == 1:
        return np.full(len(x), np.inf)
    return x[:, -1] - x[:, -2] - np.log(np.exp(x[:, :-1] - x[:, -2:-1]).sum(axis=1))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text mod 5 is 0; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, columns: Sequence[str], per_lang: int = SAMPLE_PER_LANG) -> list:
    """(lang, bucket numbers, their counts) of a sample: rows with a language, a
    text and an id that is not held out, about ``per_lang`` of each language,
    chosen by a hash of the id.  Texts are counted whole; only sparse counts
    reach the driver, at most BUCKETS a row."""
    doc_id, text, lang = columns
    usable = (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
              .filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                      & ~held_out(F.col("doc_id"))))
    counts = usable.groupBy("lang").count().collect()          # a row a language; the model has a column for each
    each = min(per_lang, SAMPLE_TOTAL / max(1, len(counts)))
    share = F.create_map(*[F.lit(x) for lang, n in counts for x in (lang, each / n)]) if counts else F.create_map().cast("map<string,double>")
    draw = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = usable.filter(draw < F.element_at(share, F.col("lang"))).select("lang", "text", "doc_id")

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for s in slices(batch.column(1)):
                for i in range(s.n):
                    body = s.data[s.offsets[i]:s.offsets[i + 1]]
                    parts = [b for b, _ in gram_buckets(body, np.array([0, len(body)]))]
                    found, n = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.int32), return_counts=True)
                    out.append((found.astype(np.uint16).tobytes(), n.astype(np.uint32).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.string()), batch.column(2), *[pa.array([o[j] for o in out], pa.binary()) for j in range(2)]],
                ["lang", "doc_id", "buckets", "counts"])

    rows = chosen.mapInArrow(sparse, "lang string, doc_id long, buckets binary, counts binary").collect()
    rows.sort(key=lambda r: (r.doc_id, r.lang, bytes(r.buckets), bytes(r.counts)))
    return [(r.lang, np.frombuffer(r.buckets, np.uint16), np.frombuffer(r.counts, np.uint32)) for r in rows if len(r.buckets)]


def train(rows: list, seed: int = 3) -> Model | None:
    """Stochastic gradient descent over small batches; None without rows."""
    if not rows:
        return None
    langs = sorted({r[0] for r in rows})
    y = np.array([langs.index(r[0]) for r in rows])
    rng = np.random.default_rng(seed)
    part = rng.permutation(len(rows))
    fit, calibrate = part[len(rows) // CALIBRATION:], part[:len(rows) // CALIBRATION]
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out = np.zeros((DIM, len(langs)), np.float32)
    bias = np.zeros(len(langs), np.float32)

    def mean(i):
        w = rows[i][2].astype(np.float32)
        return (w / w.sum()) @ emb[rows[i][1]]

    steps = EPOCHS * (len(fit) // BATCH + 1)
    step = 0
    for _ in range(EPOCHS):
        for b in np.array_split(rng.permutation(fit), len(fit) // BATCH + 1):
            if not len(b):
                continue
            rate = RATE * (1 - step / steps)
            step += 1
            h = np.stack([mean(i) for i in b])
            error = softmax(h @ out + bias)
            error[np.arange(len(b)), y[b]] -= 1
            back = error @ out.T
            out -= rate * h.T @ error / len(b)
            bias -= rate * error.mean(axis=0)
            for i, g in zip(b, back):
                w = rows[i][2].astype(np.float32)
                emb[rows[i][1]] -= (rate * 20 * w / w.sum())[:, None] * g   # each bucket is a small part of the mean
    check = calibrate if len(calibrate) else fit
    raw = np.stack([mean(i) for i in check]) @ out + bias
    truth = y[check]

    def loss(t):
        return -np.log(softmax(raw / t)[np.arange(len(truth)), truth] + 1e-12).mean()

    temperature = min((2.0 ** k for k in np.arange(-4, 4.1, 0.25)), key=loss)
    logits = (emb @ out).astype(np.float64)
    shares = np.full((BUCKETS, len(langs)), 1.0 / BUCKETS)              # as if each bucket had been met in one more text
    for i in fit:
        shares[rows[i][1], y[i]] += rows[i][2] / rows[i][2].sum()
    model = Model(langs, logits, bias.astype(np.float64), float(temperature), np.log(shares / shares.sum(axis=0)),
                  np.full((2, len(DRAWS)), -np.inf))
    for j, size in enumerate(DRAWS):
        found = []
        for i in check:
            w = rows[i][2].astype(np.int64)
            if w.sum() >= size:
                drawn = rows[i][1][np.searchsorted(np.cumsum(w), rng.integers(0, w.sum(), size), side="right")]
                x = (logits[drawn].mean(axis=0) + model.bias) / temperature
                if x.argmax() == y[i]:
                    found.append((log_odds(x[None])[0], model.familiar[drawn, y[i]].mean()))
        if found:
            found = np.array(found).T
            middle, low = np.median(found, axis=1), np.quantile(found, FALSE_REJECTS, axis=1, method="lower")
            model.floors[:, j] = low - np.where(np.isfinite(middle), SLACK * (middle - low), 0)
        elif j:
            model.floors[:, j] = model.floors[:, j - 1]
    return model


def predict(docs: DataFrame, model: Model | None, columns: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    """doc_id, lang_pred, score, rejected for every document, over its whole text."""
    doc_id, text = columns

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(1)):
                letters = np.array(batch.column(2).slice(s.first, s.n).to_numpy(zero_copy_only=False), bool)
                names, scores, unsure = np.full(s.n, UNKNOWN, object), np.zeros(s.n), True
                if model is not None:
                    p, unsure = model.probabilities(s.data, s.offsets)
                    names[letters] = np.array(model.langs, object)[p.argmax(axis=1)][letters]
                    scores[letters] = p.max(axis=1)[letters]
                rejected = ~letters | unsure
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.first, s.n), pa.array(names, pa.string()), pa.array(scores), pa.array(rejected)],
                    ["doc_id", "lang_pred", "score", "rejected"])

    has_letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return docs.select(F.col(doc_id).cast("long"), F.col(text), has_letter).mapInArrow(
        label, "doc_id long, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame, columns: Sequence[str] = ("doc_id", "text", "lang"),
             per_lang: int = SAMPLE_PER_LANG) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every document.

    Learned from a sample (see :func:`training_rows`) of the documents that
    are not held out.  A text that is null or has no letter gives `und`, score
    0, rejected; so does every text if there is nothing to learn from.  Rows
    with equal ids are labelled each for itself, a null id is not held out and
    not learned from; no rows give no rows.  Other columns are ignored."""
    doc_id, text, lang = columns
    model = train(training_rows(docs, columns, per_lang))
    return (predict(docs, model, (doc_id, text))
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected"))


def accepted_rows(docs: DataFrame, columns: Sequence[str] = ("doc_id", "text", "lang"),
                  per_lang: int = SAMPLE_PER_LANG) -> DataFrame:
    """The rows of ``docs``, all columns, whose language the model does not
    reject.  Every row is judged by its own text in place, so there is nothing
    to join and rows with equal ids do not mix."""
    model = train(training_rows(docs, columns, per_lang))
    text = docs.columns.index(columns[1])
    letters = F.coalesce(F.col(columns[1]).rlike(r"\p{L}"), F.lit(False))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, has = batch.column(0), batch.column(1)
            body = row.field(text)
            for s in slices(body):
                ok = np.array(has.slice(s.first, s.n).to_numpy(zero_copy_only=False), bool)
                if model is None:
                    ok[:] = False
                else:
                    ok &= ~model.probabilities(s.data, s.offsets)[1]
                part = row.slice(s.first, s.n).filter(pa.array(ok))
                if len(part):
                    yield pa.RecordBatch.from_arrays(part.flatten(), names=[f.name for f in row.type])

    return docs.select(F.struct("*").alias("row"), letters.alias("has")).mapInArrow(keep, docs.schema)
