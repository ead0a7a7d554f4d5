"""Language identification by error-correcting output codes.

A text is the square root of its hashed byte n-gram frequencies (lengths 1 to 4 of the lower-cased
UTF-8 bytes; digits and ASCII punctuation are word borders), scaled to length one. Every language has a
codeword of bits (all splits into two for up to five languages, else seeded random ones, far apart); for each
bit a binary classifier (ridge regression on the n-grams) says on which side of it the text lies. The
codeword with the least loss wins, a bit's loss being weighted by how surely its classifier separates the
training texts; texts whose best two codewords are nearly as near are ambiguous.

Learning takes a sample of the labelled rows, of about SAMPLE a language and TOTAL in all, by hash of the id; only
their features (DIM half-precision numbers each, 8 kB) reach the driver, and the fit solves a system of at most DIM
unknowns a bit however many texts there are. More than LANGUAGES labels are refused: they are no languages.
Prediction reads the whole text and nothing else.

Edges: null texts and texts without letters (of Unicode's categories L) are `und`, with score 0; with no
labelled text all are `und`; labels that are null teach nothing; with one language all texts with letters get
it; repeated rows each get their row; an empty table gives an empty result; a very long text is counted piece by
piece. Columns named lang_pred, score or ambiguous are replaced, others are carried along whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulith.llm.byte_words import CHUNK, utf8
from tabulith.llm.common import boxed, small_batches, unboxed

DIM = 1 << 12
SAMPLE, TOTAL, LANGUAGES = 500, 16_384, 1_000
RIDGE = 0.01
AMBIGUOUS = 0.02
UNKNOWN = "und"
#: What makes a text one that has a language, for every caller.
LETTER = "\\p{L}"
GRAMS = 4

_fold = np.arange(256, dtype=np.uint8)
_fold[0x41:0x5B] += 0x20
_fold[[*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 0x20


def features(column: pa.Array, chunk: int = CHUNK) -> np.ndarray:
    """rows x DIM float32. A text of more than chunk bytes is counted in pieces that overlap by the n-grams that cross their border."""
    body, offs = utf8(column)
    n = len(offs) - 1
    out = np.zeros((n, DIM), dtype=np.float32)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + chunk, side="right")) - 1)
        to = min(to, at + 256)
        if offs[to] - offs[at] > chunk:
            for lo in range(offs[at], offs[to], chunk):
                piece = body[lo : min(lo + chunk + GRAMS - 1, offs[to])]
                _count(piece, np.array([0, len(piece)], dtype=np.int64), out[at:to], min(chunk, offs[to] - lo))
        else:
            _count(body[offs[at] : offs[to]], offs[at : to + 1] - offs[at], out[at:to], offs[to] - offs[at])
        at = to
    np.sqrt(out, out=out)
    size = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return np.divide(out, size, out=out, where=size > 0)


def _count(body: np.ndarray, offs: np.ndarray, out: np.ndarray, starts: int) -> None:
    """Add the n-grams that begin at the first starts bytes."""
    n = len(offs) - 1
    if not len(body):
        return
    low = _fold[body].astype(np.uint32)
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(offs)) * DIM
    ends = np.repeat(offs[1:], np.diff(offs))
    place = np.arange(len(low))
    gram = np.zeros(len(low), dtype=np.uint32)
    for k in range(1, GRAMS + 1):
        full = len(low) - k + 1
        if full <= 0:
            break
        gram = (gram[:full] << np.uint32(8)) | low[k - 1 :]
        # a multiplicative hash; the length is part of it
        slot = ((gram ^ np.uint32(k * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)) >> np.uint32(20)
        inside = place[:full] + k <= ends[:full]
        inside[starts:] = False
        counts = np.bincount(doc[:full][inside] + slot[inside], minlength=n * DIM)
        out += counts.reshape(n, DIM)


def codewords(n: int) -> np.ndarray:
    """n different rows of +1 and -1: all splits into two for up to five languages, else seeded random columns, as far apart as 256 draws give."""
    if n <= 5:
        splits = [s for s in range(1, 1 << (n - 1))] or [1]
        return np.array([[1 if (s << 1 | 1) >> i & 1 else -1 for s in range((1 << (n - 1)) - 1)] for i in range(n)] if n > 1 else [[1]] * n, dtype=np.int8).reshape(n, len(splits))
    bits = max(15, 10 * int(np.ceil(np.log2(n))))
    best, apart = None, -1
    rng = np.random.default_rng(n)
    for _ in range(256):
        code = rng.choice(np.array([-1, 1], dtype=np.int8), size=(n, bits))
        gram = code.astype(np.int32) @ code.T.astype(np.int32)
        np.fill_diagonal(gram, -bits)
        sides = np.abs(code.sum(axis=0)).max() < n
        near = bits - gram.max()
        if sides and near > apart:
            best, apart = code, near
    return best


def ridge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Weights w with the least |a w - b|^2 + penalty |w|^2, the penalty being RIDGE times the mean square of a row; by a system of as many unknowns as a has rows or columns, whichever are fewer."""
    n, dim = a.shape
    penalty = RIDGE / n * float(np.square(a, dtype=np.float64).sum())
    if n <= dim:
        gram = (a @ a.T).astype(np.float64)
        gram[np.diag_indices(n)] += penalty
        return a.T.astype(np.float64) @ np.linalg.solve(gram, b)
    gram = np.zeros((dim, dim))
    for lo in range(0, n, dim):
        part = a[lo : lo + dim].astype(np.float64)
        gram += part.T @ part
    gram[np.diag_indices(dim)] += penalty
    return np.linalg.solve(gram, a.T @ b)


class Model:
    """Languages, their codewords, and for each bit a classifier with its weight in decoding."""

    def __init__(self, langs: list[str], codes: np.ndarray, weights: np.ndarray, offset: np.ndarray, trust: np.ndarray):
        self.langs, self.codes, self.weights, self.offset, self.trust = langs, codes, weights, offset, trust

    @classmethod
    def fit(cls, labels: list[str], x: np.ndarray) -> Model:
        langs = sorted(set(labels))
        codes = codewords(len(langs))
        place = {k: i for i, k in enumerate(langs)}
        own = np.array([place[k] for k in labels], dtype=np.int64)
        # every language weighs the same, however many texts it has
        share = 1.0 / np.bincount(own, minlength=len(langs))[own]
        root = np.sqrt(share / share.sum())[:, None]
        y = codes[own].astype(np.float64)
        xm = (x * root**2).sum(axis=0)
        ym = (y * root**2).sum(axis=0)
        a, b = (x - xm) * root, (y - ym) * root
        weights = ridge(a, b)
        offset = ym - xm @ weights
        agree = np.clip(((x @ weights + offset) * y * root**2).sum(axis=0), 0.01, 1.0)
        return cls(langs, codes, weights.astype(np.float32), offset.astype(np.float32), (agree / agree.sum()).astype(np.float32))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language's number, score, margin) a row; losses are squared hinges."""
        side = x @ self.weights + self.offset
        loss = np.stack([(np.square(np.maximum(0, 1 - side * code)) * self.trust).sum(axis=1) for code in self.codes], axis=1)
        best = loss.argmin(axis=1)
        if loss.shape[1] == 1:
            return best, np.ones(len(x)), np.ones(len(x))
        two = np.partition(loss, 1, axis=1)[:, :2]
        closeness = np.exp(-8 * (loss - two[:, :1]))
        return best, 1 / closeness.sum(axis=1), two[:, 1] - two[:, 0]


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> Model | None:
    """Fit on about sample texts a language, and TOTAL in all; None if there is no labelled text with letters."""
    spark = docs.sparkSession
    labelled = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.lit(9), F.col(key)).alias("h"))
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(LANGUAGES + 1).collect()}
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} labels")
    if not counts:
        return None
    sample = min(sample, TOTAL // len(counts))
    parts = F.broadcast(spark.createDataFrame([(name, min(1.0, sample / n)) for name, n in counts.items()], "lang string, part double"))
    chosen = labelled.filter(F.col("text").rlike(LETTER)).join(parts, "lang").filter(F.shiftrightunsigned("h", 11) <= F.col("part") * F.lit(float(1 << 53)))

    def measured(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                rows = features(part.column("text")).astype(np.float16)
                yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array([r.tobytes() for r in rows], pa.binary())], names=["lang", "x"])

    rows = sorted((r["lang"], bytes(r["x"])) for r in small_batches(chosen).select("lang", "text").mapInArrow(measured, "lang string, x binary").collect())
    if not rows:
        return None
    return Model.fit([k for k, _ in rows], np.stack([np.frombuffer(b, dtype=np.float16) for _, b in rows]).astype(np.float32))


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """docs with lang_pred, score (0 to 1) and ambiguous."""
    shaped = boxed(small_batches(docs), _text=F.col(text), _some=F.coalesce(F.col(text).rlike(LETTER), F.lit(False)))

    def predicted(batches):
        for batch in batches:
            some = batch.column("_some").to_numpy(zero_copy_only=False)
            names, score, margin = np.full(len(some), UNKNOWN, dtype=object), np.zeros(len(some)), np.zeros(len(some))
            if model is not None:
                at = np.flatnonzero(some)
                for lo in range(0, len(at), 512):
                    part = at[lo : lo + 512]
                    best, score[part], margin[part] = model.predict(features(batch.column("_text").take(pa.array(part))))
                    names[part] = np.array(model.langs, dtype=object)[best]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(names.tolist(), pa.string()), pa.array(score, pa.float64()), pa.array((margin < AMBIGUOUS).tolist(), pa.bool_())],
                names=["_row", "_lang", "_score", "_ambiguous"],
            )

    row = shaped.schema["_row"].dataType.simpleString()
    out = shaped.mapInArrow(predicted, f"_row {row}, _lang string, _score double, _ambiguous boolean")
    return unboxed(out, docs.columns, lang_pred=F.col("_lang"), score=F.col("_score"), ambiguous=F.col("_ambiguous"))


def held_out(key: str = "doc_id", folds: int = 5):
    """True for the rows that are kept from learning: crc32 of the id as text, modulo folds, is 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % folds == 0, F.lit(False))


__all__ = ["Model", "codewords", "features", "held_out", "identify", "train"]
