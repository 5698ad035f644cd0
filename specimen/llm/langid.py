"""Language identification (operator 10): nearest centroid.

Features are hashed byte 2- and 3-grams of the letters of a text (ASCII and
Latin-1 capitals lowered, other ASCII to spaces), weighted log(1 + tf) * idf and
normalised.  Document frequencies are counted over all training rows by Spark.
For each language up to ``CENTROIDS`` spherical k-means centroids are fitted on
a bounded sample of labelled texts (at most about ``FIT_DOCS`` in all, equal shares
per language: the distinct texts of least hash, whatever their ids and copies).  A text gets the language of the centroid
with the largest cosine; ``score`` is that cosine.  A text is rejected when it
is null, has no letter, or its cosine is under the floor of its length class:
``SLACK`` times the 1 % quantile of the cosines of texts of that length, so
short or noisy texts like the corpus's own are not rejected.  Cosines are counted by Spark
over all training rows, and for short lengths over the first ``PIECES``
characters of the fitted texts too; a class with under ``CLASS_ROWS`` texts is
pooled with its neighbours, and a length never seen has the floor of the nearest
class that was.

Whole texts are vectorised batch by batch in numpy inside ``mapInArrow``; the
model (a few hundred kB, fixed by the parameters and the number of languages)
travels with the task.  No shuffle touches a text.

Defined results: null text or no letter -> ``und``, score 0, rejected; with no
training row everything is ``und``; a null doc_id belongs to the crc32 of ''.
Repeated rows are predicted one by one; extra columns are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from specimen.llm.common import documents, id_crc, written

BITS, FIT_DOCS, CENTROIDS, SLACK = 13, 2000, 4, 0.5
DIM = 1 << BITS
PIECES, CLASS_ROWS, _STEPS = (4, 8, 16, 32, 64), 20, 1000
_BLOCK_BYTES = 1 << 20
_LETTER = r"\p{L}"

_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
for _c in range(26):
    _FOLD[65 + _c] = _FOLD[97 + _c] = 97 + _c


def _grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the 2-gram and the 3-gram that start at each byte."""
    b = _FOLD[data]
    lead = np.flatnonzero(data[:-1] == 0xC3) + 1  # Latin-1 capitals
    lead = lead[(data[lead] >= 0x80) & (data[lead] <= 0x9E)]
    b[lead] += 0x20
    b = b.astype(np.uint32)
    two = b[:-1] * 256 + b[1:]
    three = two[:-1] * 256 + b[2:]
    h2 = (two * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    h3 = (three * np.uint32(2246822519) + np.uint32(3266489917)) >> np.uint32(32 - BITS)
    h2[two == 0x2020] = DIM
    h3[(three & 0xFFFF) == 0x2020] = DIM
    return h2, h3


def features(col: pa.Array):
    """Yield (first row, dense counts of a block of rows) over a string column."""
    col = pc.fill_null(col, "").cast(pa.large_string())
    n = len(col)
    offs = np.frombuffer(col.buffers()[1], np.int64, n + 1, col.offset * 8) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(col.buffers()[2], np.uint8) if n and col.buffers()[2] else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = row + 1
        while end < n and end - row < 64 and offs[end + 1] - offs[row] <= _BLOCK_BYTES:
            end += 1
        out = np.zeros((end - row, DIM), np.float32)
        for k in range(row, end):
            data = raw[offs[k]:offs[k + 1]]
            for at in range(0, len(data), _BLOCK_BYTES):  # very long texts, in parts that overlap by 2 bytes
                part = data[at:at + _BLOCK_BYTES + 2]
                if len(part) < 3:
                    part = np.concatenate([[32], part, [32]]).astype(np.uint8) if at == 0 else part
                if len(part) < 3:
                    continue
                h2, h3 = _grams(part)
                last = at + _BLOCK_BYTES >= len(data)
                h2 = h2 if last else h2[:_BLOCK_BYTES]
                out[k - row] += np.bincount(np.concatenate([h2, h3]), minlength=DIM + 1)[:DIM]
        yield row, out
        row = end


@dataclass
class Model:
    langs: list[str]            # of each centroid
    centroids: np.ndarray       # (n, DIM)
    idf: np.ndarray             # (DIM,)
    floors: dict[int, float]    # length class -> least cosine accepted

    def floor(self, cls: int) -> float:
        """The floor of a length class, or of the nearest one (ties: the shorter)."""
        if not self.floors:
            return 0.0
        return self.floors[min(self.floors, key=lambda c: (abs(c - cls), c))]

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _length_class(counts: np.ndarray) -> np.ndarray:
    return np.log2(counts.sum(axis=1) + 1).astype(int)


def _document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    def count(batches):
        df, n = np.zeros(DIM, np.int64), 0
        for batch in batches:
            for _, x in features(batch.column(0)):
                df += (x > 0).sum(axis=0)
                n += len(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(DIM + 1), pa.int32()), pa.array(np.append(df, n), pa.int64())],
            names=["dim", "df"])

    # DIM + 1 rows, whatever the input
    got = train.select("text").mapInArrow(count, "dim int, df long").groupBy("dim").agg(
        F.sum("df").alias("df")).collect()
    out = np.zeros(DIM + 1, np.int64)
    for r in got:
        out[r.dim] = r.df
    return out[:DIM], int(out[DIM])


def _kmeans(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means with farthest-first start."""
    c = [x.mean(axis=0)]
    c[0] /= max(np.linalg.norm(c[0]), 1e-12)
    while len(c) < min(k, len(x)):
        c.append(x[np.argmin((x @ np.array(c).T).max(axis=1))])
    c = np.array(c)
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        for j in range(len(c)):
            if (own == j).any():
                m = x[own == j].sum(axis=0)
                c[j] = m / max(np.linalg.norm(m), 1e-12)
    return c


def _sample(train: DataFrame, share: int) -> DataFrame:
    """(text, lang) of at most ``share`` distinct texts a language, those of least hash."""
    rows = train.select("text", "lang", F.xxhash64("text").alias("_h"))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.approx_count_distinct("_h", 0.03).alias("n")).collect()}
    # a draw with half as many again as wanted: about 1.5 * share texts a language, so copies fold and are ordered cheaply
    most = F.create_map(*[F.lit(v) for lang, n in sizes.items()
                          for v in (lang, min(1.0, 1.5 * share / max(n, 1)) * 2.0 ** 64 - 2.0 ** 63)])
    drawn = rows.filter(F.col("_h").cast("double") <= most[F.col("lang")])
    texts = drawn.groupBy("lang", "_h").agg(F.min("text").alias("text"))
    order = Window.partitionBy("lang").orderBy("_h")  # a limit a task goes before the exchange
    return texts.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= share).select("text", "lang")


def _unpacked(vecs, rows: np.ndarray, model: Model) -> np.ndarray:
    """The vectors of some fitted texts; few rows at a time, since the driver is small."""
    x = np.empty((len(rows), DIM), np.float32)
    for at in range(0, len(rows), 64):
        counts = [np.frombuffer(zlib.decompress(vecs[i].as_py()), np.float16) for i in rows[at:at + 64].tolist()]
        x[at:at + 64] = model.vectors(np.array(counts, np.float32))
    return x


def fit(train: DataFrame, fit_docs: int = FIT_DOCS, k: int = CENTROIDS) -> Model:
    """Learn from the columns text and lang of ``train``."""
    train = train.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r.lang: r.n for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((0, DIM), np.float32), np.zeros(DIM, np.float32), {})
    df, n = _document_frequencies(train)
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + 1
    sample = written(_sample(train, -(-fit_docs // len(sizes))), "fit-sample")

    def vectorise(batches):
        for batch in batches:
            vecs = [zlib.compress(row.astype(np.float16).tobytes(), 1) for _, x in features(batch.column(0))
                    for row in np.minimum(x, 60000)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(vecs, pa.binary())],
                                             names=["lang", "vec"])

    # mostly zeros: packed, a tenth of what the driver would hold
    got = sample.select("text", "lang").mapInArrow(vectorise, "lang string, vec binary").toArrow()
    names, vecs = np.array(got.column("lang").to_pylist(), object), got.column("vec")
    model = Model([], np.zeros((0, DIM), np.float32), idf, {})
    parts = []
    for lang in sorted(sizes, key=lambda v: (-sizes[v], v)):  # ties go to the commoner language
        own = np.flatnonzero(names == lang)
        if len(own):
            c = _kmeans(_unpacked(vecs, own, model), k)
            parts.append(c)
            model.langs += [lang] * len(c)
    if not parts:
        return model
    model.centroids = np.concatenate(parts).astype(np.float32)
    pieces = sample.select(F.explode(F.array(*[F.left("text", F.lit(n)) for n in PIECES])).alias("text"))
    model.floors = _floors(_cosine_counts(train.select("text").unionByName(pieces), model))
    return model


def _cosine_counts(rows: DataFrame, model: Model) -> dict[int, np.ndarray]:
    """Per length class, how many texts with a letter have their best cosine in each of ``_STEPS`` steps."""
    def count(batches):
        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in features(batch.column(0)):
                best = (model.vectors(x) @ model.centroids.T).max(axis=1)
                step = np.clip(best * _STEPS, 0, _STEPS - 1).astype(int)
                for c, k in zip(_length_class(x).tolist(), step):
                    seen.setdefault(c, np.zeros(_STEPS, np.int64))[k] += 1
        for c, n in seen.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), c), pa.int32()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())],
                names=["cls", "step", "n"])

    # at most _STEPS rows a length class, whatever the input
    got = rows.filter(F.col("text").rlike(_LETTER)).mapInArrow(count, "cls int, step int, n long").groupBy(
        "cls", "step").agg(F.sum("n").alias("n")).collect()
    out: dict[int, np.ndarray] = {}
    for r in got:
        out.setdefault(r.cls, np.zeros(_STEPS, np.int64))[r.step] = r.n
    return out


def _floors(counts: dict[int, np.ndarray]) -> dict[int, float]:
    """``SLACK`` times the 1 % quantile of each class, pooled with as many neighbours as it needs."""
    out, total = {}, sum(int(n.sum()) for n in counts.values())
    for c in counts:
        reach = 0
        while True:
            pool = sum(n for k, n in counts.items() if abs(k - c) <= reach)
            if pool.sum() >= min(CLASS_ROWS, total):
                break
            reach += 1
        out[c] = SLACK * int(np.searchsorted(np.cumsum(pool), 0.01 * pool.sum())) / _STEPS
    return out


def _predict_batch(model: Model, text: pa.Array, letter: pa.Array):
    n = len(text)
    best, who, cls = np.zeros(n), np.zeros(n, int), np.zeros(n, int)
    for row, counts in features(text):
        cls[row:row + len(counts)] = _length_class(counts)
        if model.langs:
            sims = model.vectors(counts) @ model.centroids.T
            best[row:row + len(counts)] = sims.max(axis=1)
            who[row:row + len(counts)] = sims.argmax(axis=1)
    ok = np.array(pc.fill_null(letter, False)) & bool(model.langs)
    floors = {c: model.floor(c) for c in np.unique(cls).tolist()}
    floor = np.array([floors[c] for c in cls.tolist()])
    pred = [model.langs[w] if k else "und" for w, k in zip(who, ok)]
    score = np.where(ok, np.clip(best, 0, 1), 0.0)
    return pred, score, ~ok | (score < floor)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row."""
    rows = docs.select("doc_id", "text", F.col("text").rlike(_LETTER).alias("_letter"))
    kind = rows.select("doc_id").schema.simpleString()[7:-1]

    def run(batches):
        for b in batches:
            pred, score, rejected = _predict_batch(model, b.column(1), b.column(2))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                 pa.array(rejected, pa.bool_())], names=["doc_id", "lang_pred", "score", "rejected"])

    return rows.mapInArrow(run, kind.replace(":", " ") + ", lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with the same columns."""
    rows = docs.withColumn("_lid_letter", F.col("text").rlike(_LETTER))
    at, n = docs.columns.index("text"), len(docs.columns)

    def run(batches):
        for b in batches:
            *_, rejected = _predict_batch(model, b.column(at), b.column(n))
            yield b.select(list(range(n))).filter(pa.array(~rejected))

    return rows.mapInArrow(run, docs.schema)


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", "lang").filter(id_crc(F.col("doc_id")) % 3 != 1)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = predict(docs, fit(training_rows(docs)))
    return out.select("doc_id", (id_crc(F.col("doc_id")) % 3 == 1).alias("held_out"),
                      "lang_pred", "score", "rejected")
