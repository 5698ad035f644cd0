"""Toxicity (operator 2): a linear-chain conditional random field over words.

Fitting uses a bounded sample of labelled rows (about ``FIT_DOCS`` per class,
chosen by a hash of the id, one text an id, of at most ``FIT_CHARS`` characters, one of
each set of near-equal texts).  Words of toxic documents are labelled where the
word, or its first 4 or 5 letters, occurs in toxic documents far more often than
in clean ones (log odds of document counts); all other words are labelled clean.
A two-state chain (clean, toxic) with word, prefix and suffix features is then
fitted to these labelled tokens by gradient ascent on the conditional
likelihood, and a logistic link from a document's marginals to its label is
fitted on the same sample, weighted back to the true class shares.

Scoring runs over every whole text: each distinct word's state score is looked
up once per worker (bounded cache), forward-backward runs over all texts of a
batch at once as a recursion on state odds, and the marginals give the document
score and the character spans of words that are toxic with probability >= 0.5.
Memory is bounded by an Arrow batch; nothing is shuffled.

Defined results: null and empty texts have no words and get the link's value for
marginal 0; without labelled rows of both classes every score is 0; a null
doc_id belongs to the crc32 of ''; several label rows of one id count as toxic if
any says so; labels without a document are ignored; rows are scored one by one.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specimen.llm.common import documents, id_crc

BITS, FIT_DOCS, FIT_CHARS, STEPS = 18, 1500, 20_000, 40
DIM = 1 << BITS
EDGE = ".,;:!?\"'()[]{}<>*_~|-"
_CACHE_LIMIT = 500_000
_MIN_LOG_ODDS, _MIN_SHARE, _MIN_DOCS = 3.0, 0.01, 4
#: Longest run of words held in one odds matrix (rows x words).
_BLOCK_WORDS = 2_000_000


def _hash(s: str) -> int:
    return zlib.crc32(s.encode("utf-8", "surrogatepass")) & (DIM - 1)


def word_features(word: str) -> list[int]:
    """Hashed features of a bare lower-cased word (four at all times)."""
    return [_hash("w" + word), _hash("p4" + word[:4]), _hash("p5" + word[:5]), _hash("s4" + word[-4:])]


def _bare(token: str) -> str:
    return token.strip(EDGE).lower()


# ---------------------------------------------------------------- the chain

def _matrix(flat: np.ndarray, lengths: np.ndarray, fill: float) -> np.ndarray:
    """(longest, rows): one column per text, words downwards."""
    out = np.full((int(lengths.max()), len(lengths)), fill)
    mask = np.arange(out.shape[0])[:, None] < lengths[None, :]
    out.T[mask.T] = flat
    return out


def _odds(e: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward odds (toxic : clean) of every word.  ``e`` holds
    exp(state score), ``trans`` the 2x2 matrix of exp(transition score)."""
    f, b = np.empty_like(e), np.ones_like(e)
    (a00, a01), (a10, a11) = trans
    f[0] = e[0]
    for t in range(1, len(e)):
        f[t] = e[t] * (a01 + f[t - 1] * a11) / (a00 + f[t - 1] * a10)
    for t in range(len(e) - 2, -1, -1):
        g = e[t + 1] * b[t + 1]
        b[t] = np.where(t + 1 < lengths, (a10 + a11 * g) / (a00 + a01 * g), 1.0)
    return f, b


def marginals(scores: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """P(toxic) of every word; texts concatenated in ``scores``."""
    out = np.zeros(len(scores))
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(lengths) else lengths
    order = np.argsort(lengths, kind="stable")
    order = order[lengths[order] > 0]
    at = 0
    while at < len(order):
        end = at + 1
        while (end < len(order) and end - at < 512
               and lengths[order[end]] * (end + 1 - at) <= _BLOCK_WORDS):
            end += 1
        rows = order[at:end]
        pick = np.concatenate([np.arange(starts[r], starts[r] + lengths[r]) for r in rows])
        n = lengths[rows]
        e = np.exp(np.clip(_matrix(scores[pick], n, 0.0), -30, 30))
        f, b = _odds(e, n, trans)
        fb = f * b
        mask = np.arange(len(e))[:, None] < n[None, :]
        out[pick] = (fb / (1 + fb)).T[mask.T]
        at = end
    return out


@dataclass
class Model:
    weights: np.ndarray     # (DIM,) state score of each feature
    bias: float
    trans: np.ndarray       # (2, 2), exponentiated
    link: np.ndarray        # intercept and slopes of the document score

    def word_score(self, token: str) -> float:
        return float(self.weights[word_features(_bare(token))].sum() + self.bias)

    def document_score(self, top: np.ndarray, mass: np.ndarray) -> np.ndarray:
        z = _link_inputs(top, mass) @ self.link
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _link_inputs(top: np.ndarray, mass: np.ndarray) -> np.ndarray:
    p = np.clip(top, 1e-4, 1 - 1e-4)
    return np.stack([np.ones_like(p), np.log(p / (1 - p)), np.log1p(mass)], axis=1)


def _per_text(p: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest marginal and summed marginals >= 0.5 of each text."""
    top, mass = np.zeros(len(lengths)), np.zeros(len(lengths))
    has = np.flatnonzero(lengths > 0)
    if len(has):
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)[has]
        top[has] = np.maximum.reduceat(p, starts)
        mass[has] = np.add.reduceat(np.where(p >= 0.5, p, 0.0), starts)
    return top, mass


# ---------------------------------------------------------------- fitting

def _distinct_texts(texts: list[list[str]]) -> list[int]:
    """Indexes of one text of each set that shares its least 3-word hash."""
    seen, out = set(), []
    for i, ws in enumerate(texts):
        key = min((zlib.crc32(" ".join(ws[k:k + 3]).encode()) for k in range(max(1, len(ws) - 2))))
        if key not in seen:
            seen.add(key)
            out.append(i)
    return out


def toxic_stems(texts: list[list[str]], toxic: np.ndarray) -> set[str]:
    """Words, and 4- or 5-letter prefixes ('abcd*'), typical of toxic texts."""
    counts = (Counter(), Counter())
    for ws, y in zip(texts, toxic):
        keys = set()
        for w in set(ws):
            if len(w) >= 3:
                keys.add(w)
            for k in (4, 5):
                if len(w) > k:
                    keys.add(w[:k] + "*")
        counts[int(y)].update(keys)
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    least = max(_MIN_DOCS, _MIN_SHARE * n1)
    return {k for k, a in counts[1].items() if a >= least and
            np.log((a + 0.5) / (n1 + 1)) - np.log((counts[0][k] + 0.5) / (n0 + 1)) >= _MIN_LOG_ODDS}


def _token_labels(ws: list[str], stems: set[str]) -> list[bool]:
    return [w in stems or (len(w) > 4 and w[:4] + "*" in stems)
            or (len(w) > 5 and w[:5] + "*" in stems) for w in ws]


def fit_chain(texts: list[list[str]], labels: list[list[bool]]) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights, bias and exp(transitions) from labelled tokens."""
    lengths = np.array([len(t) for t in texts])
    vocab: dict[str, int] = {}
    ids = np.array([vocab.setdefault(w, len(vocab)) for t in texts for w in t], np.int64)
    y = np.array([v for t in labels for v in t], float)
    feats = np.array([word_features(w) for w in vocab], np.int64)
    order = np.argsort(lengths, kind="stable")
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    blocks, at = [], 0
    while at < len(order):
        end = at + 1
        while end < len(order) and end - at < 512 and lengths[order[end]] * (end + 1 - at) <= _BLOCK_WORDS:
            end += 1
        rows = order[at:end]
        blocks.append((np.concatenate([np.arange(starts[r], starts[r] + lengths[r]) for r in rows]), lengths[rows]))
        at = end
    w, bias, logt = np.zeros(DIM), -4.0, np.zeros((2, 2))
    gw2, gb2, gt2 = np.full(DIM, 1e-8), 1e-8, np.full((2, 2), 1e-8)
    for _ in range(STEPS):
        word_e = w[feats].sum(axis=1) + bias
        trans = np.exp(logt)
        grad_word, gt, gbias = np.zeros(len(vocab)), np.zeros((2, 2)), 0.0
        for pick, n in blocks:
            e = np.exp(np.clip(_matrix(word_e[ids[pick]], n, 0.0), -30, 30))
            f, b = _odds(e, n, trans)
            mask = np.arange(len(e))[:, None] < n[None, :]
            fb = f * b
            d = y[pick] - (fb / (1 + fb)).T[mask.T]
            grad_word += np.bincount(ids[pick], d, len(vocab))
            gbias += d.sum()
            if len(e) > 1:  # expected against observed transitions
                eb, fp, m = e[1:] * b[1:], f[:-1], mask[1:]
                parts = [np.full_like(eb, trans[0, 0]), trans[0, 1] * eb, fp * trans[1, 0], fp * trans[1, 1] * eb]
                total = sum(parts)
                ym = _matrix(y[pick], n, 0.0)
                for k, part in enumerate(parts):
                    i, j = divmod(k, 2)
                    seen = ((ym[:-1] == i) & (ym[1:] == j) & m).sum()
                    gt[i, j] += seen - np.where(m, part / total, 0.0).sum()
        g = np.bincount(feats.ravel(), np.repeat(grad_word, feats.shape[1]), DIM) - 0.05 * w
        gw2 += g * g
        gb2 += gbias ** 2
        gt2 += gt * gt
        w += 0.5 * g / np.sqrt(gw2)
        bias += 0.5 * gbias / np.sqrt(gb2)
        logt += 0.1 * gt / np.sqrt(gt2)
    return w, float(bias), np.exp(logt)


def _fit_link(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps with a small ridge."""
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        beta += np.linalg.solve(h, x.T @ (weight * (y - p)) - 1e-2 * beta)
    return beta


def _labelled(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, text, toxic): the least text of each chosen id, however many rows repeat it."""
    rows = docs.select("doc_id", "text").filter(F.length("text").between(1, FIT_CHARS)).join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> Model | None:
    known = (labels.select("doc_id", "toxic").filter(F.col("toxic").isNotNull() & (id_crc(F.col("doc_id")) % 5 != 0))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(1 << 20)
    share = F.when(F.col("toxic") == 1, min(1.0, fit_docs / sizes.get(1, 1))).otherwise(
        min(1.0, fit_docs / sizes.get(0, 1)))
    # about 2 * fit_docs ids: small, so the texts are picked without a shuffle of documents
    chosen = known.filter(draw < share)
    got = _labelled(docs, chosen).toArrow().sort_by("doc_id")
    texts = [[_bare(t) for t in s.split()] for s in got.column("text").to_pylist()]
    toxic = np.array(got.column("toxic").to_pylist()) == 1
    keep = [i for i in _distinct_texts(texts) if texts[i]]
    texts, toxic = [texts[i] for i in keep], toxic[keep]
    if toxic.all() or not toxic.any():
        return None
    stems = toxic_stems(texts, toxic)
    marks = [_token_labels(t, stems) if y else [False] * len(t) for t, y in zip(texts, toxic)]
    model = Model(*fit_chain(texts, marks), np.zeros(3))
    lengths = np.array([len(t) for t in texts])
    scored = {w: model.word_score(w) for w in {w for t in texts for w in t}}
    p = marginals(np.array([scored[w] for t in texts for w in t]), lengths, model.trans)
    rate = np.where(toxic, sizes.get(1, 0) / toxic.sum(), sizes.get(0, 0) / (~toxic).sum())
    model.link = _fit_link(_link_inputs(*_per_text(p, lengths)), toxic.astype(float), rate / rate.mean())
    return model


# ---------------------------------------------------------------- scoring

class _Scores(dict):
    """token as written -> its state score."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, token: str) -> float:
        if len(self) >= _CACHE_LIMIT:
            self.clear()
        v = self[token] = self.model.word_score(token)
        return v


def _spans(text: str, flags: np.ndarray) -> list[dict]:
    import re
    return [{"start": m.start(), "end": m.end()} for m, y in zip(re.finditer(r"\S+", text), flags) if y]


def _score_texts(model: Model, get, texts: list[str]):
    split = [(t or "").split() for t in texts]
    lengths = np.array([len(s) for s in split], np.int64)
    flat = np.fromiter((v for s in split for v in map(get, s)), float, int(lengths.sum()))
    del split
    p = marginals(flat, lengths, model.trans)
    top, mass = _per_text(p, lengths)
    ends = np.cumsum(lengths)
    spans = [_spans(texts[i], p[ends[i] - lengths[i]:ends[i]] >= 0.5) if mass[i] else [] for i in range(len(texts))]
    return model.document_score(top, mass), spans


SPANS = "spans array<struct<start:int,end:int>>"


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score, spans) of every row; spans are code-point offsets."""
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"),
                           F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    rows = docs.select("doc_id", "text")
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        get = _Scores(model).__getitem__
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                s, spans = _score_texts(model, get, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s, pa.float64()), pa.array(spans, span_type)],
                                                 names=["doc_id", "score", "spans"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double, {SPANS}")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = score(docs, fit(docs, documents(spark, sf_dir, "labels")))
    return out.select("doc_id", (id_crc(F.col("doc_id")) % 5 == 0).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
