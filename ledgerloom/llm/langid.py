"""Language identification: averaged hashed subword embeddings and a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored

#: Labelled rows per language that the model is fitted on, at most. The fit's memory is bounded
#: by languages x this x BUCKETS.
ROWS_PER_LANGUAGE = 800

BUCKETS = 1 << 15
SUBWORD_BYTES = (1, 2, 3, 4)
DIMENSION = 16
EPOCHS = 8
RATE = 4.0
BATCH = 64
SEED = 11

#: Share of the sample kept back for temperature and threshold.
CALIBRATION = 0.25

#: Share of correctly labelled calibration rows that rejection may cost.
REJECTED_SHARE = 0.002

#: A threshold above this would reject texts whose language is likelier than all others together.
HIGHEST_THRESHOLD = 0.5

UNKNOWN = "und"

#: Candidates per row that is taken, among which the least hashes are found.
OVERSAMPLED = 8.0

_HASHES = 1 << 62

# Letters stay (lower-cased before), everything else in ASCII becomes one gap.
_GAPS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))
_BLOCK = 1 << 20
_MIX = np.uint32(0x9E3779B1)


def subword_counts(text: str) -> np.ndarray:
    """How often each hashed subword occurs: byte runs of lower-cased words, their edges included.

    The text is taken in blocks that end at a gap, so its length does not matter.
    """
    counts = np.zeros(BUCKETS, np.int64)
    raw = text.lower().encode("utf-8", "replace").translate(_GAPS)
    start = 0
    while start < len(raw):
        stop = raw.find(b" ", start + _BLOCK)
        stop = len(raw) if stop < 0 else stop
        block = b" " + b" ".join(raw[start:stop].split()) + b" "
        start = stop
        if len(block) < 3:
            continue
        letters = np.frombuffer(block, np.uint8).astype(np.uint32)
        gap = letters == 0x20
        code, spoilt = np.zeros(len(letters), np.uint32), np.zeros(len(letters), bool)
        runs = []
        for length in range(1, max(SUBWORD_BYTES) + 1):
            # ``code`` holds the run of ``length`` bytes that starts at each place; a gap may be
            # its first or last byte, not one in between.
            code = code[:len(letters) - length + 1] * np.uint32(257) + letters[length - 1:] + np.uint32(1)
            if length > 2:
                spoilt = spoilt[:len(code)] | gap[length - 2:len(letters) - 1]
            else:
                spoilt = gap.copy() if length == 1 else np.zeros(len(code), bool)
            if length in SUBWORD_BYTES:
                hashed = (code[~spoilt] + np.uint32(length)) * _MIX
                runs.append((hashed ^ (hashed >> np.uint32(15))) % np.uint32(BUCKETS))
        counts += np.bincount(np.concatenate(runs), minlength=BUCKETS)
    return counts


@dataclass(frozen=True)
class LanguageModel:
    """``table`` is embedding times output weights: the logits of one subword."""

    languages: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        hit = np.flatnonzero(counts)
        mean = counts[hit] @ self.table[hit] / max(1, counts[hit].sum())
        z = (mean + self.bias) / self.temperature
        z = np.exp(z - z.max())
        return z / z.sum()


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], rejected: float = REJECTED_SHARE) -> LanguageModel:
    """Model from (language, buckets, counts) rows, the same for the same rows in the same order.

    Embeddings of a text's subwords are averaged and a linear softmax is trained on top, both by
    stochastic gradient descent over shuffled batches. On rows kept back, the temperature with the
    least log loss is chosen, then the threshold under which ``rejected`` of the rows whose
    language is right would fall.
    """
    languages = tuple(sorted({r[0] for r in rows}))
    if not languages:
        return LanguageModel((), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    numbers = {l: i for i, l in enumerate(languages)}
    target = np.array([numbers[r[0]] for r in rows])
    random = np.random.default_rng(SEED)
    order = random.permutation(len(rows))
    kept = order[:int(len(rows) * CALIBRATION)]
    train = order[len(kept):]
    embedding = random.normal(0, 0.1, (BUCKETS, DIMENSION))
    output, bias = random.normal(0, 0.1, (DIMENSION, len(languages))), np.zeros(len(languages))
    one = np.eye(len(languages))

    def gathered(some: np.ndarray):
        sizes = np.array([len(rows[i][1]) for i in some])
        buckets = np.concatenate([rows[i][1] for i in some])
        share = np.concatenate([rows[i][2] / max(1, rows[i][2].sum()) for i in some])
        return buckets, share, np.repeat(np.arange(len(some)), sizes)

    steps, done = EPOCHS * -(-len(train) // BATCH), 0
    for _ in range(EPOCHS):
        shuffled = random.permutation(train)
        for at in range(0, len(shuffled), BATCH):
            some = shuffled[at:at + BATCH]
            buckets, share, owner = gathered(some)
            hidden = np.zeros((len(some), DIMENSION))
            weighted = embedding[buckets] * share[:, None]
            for d in range(DIMENSION):
                hidden[:, d] = np.bincount(owner, weighted[:, d], len(some))
            error = (_softmax(hidden @ output + bias) - one[target[some]]) / len(some)
            rate = RATE * (1 - done / steps)
            back = error @ output.T
            output -= rate * hidden.T @ error
            bias -= rate * error.sum(0)
            change = back[owner] * share[:, None] * (rate * BATCH)
            for d in range(DIMENSION):
                embedding[:, d] -= np.bincount(buckets, change[:, d], BUCKETS)
            done += 1
    table = embedding @ output
    if len(kept) == 0:
        return LanguageModel(languages, table, bias, 1.0, 0.0)
    logits = np.stack([rows[i][2] @ table[rows[i][1]] / max(1, rows[i][2].sum()) + bias for i in kept])
    scale = [0.05 * 1.15 ** k for k in range(40)]
    right = target[kept]
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(kept)), right], 1e-12)).mean() for t in scale]
    temperature = float(scale[int(np.argmin(loss))])
    chances = _softmax(logits / temperature)
    sure = np.sort(chances.max(1)[chances.argmax(1) == right])
    threshold = float(sure[int(len(sure) * rejected)]) if len(sure) else 0.0
    return LanguageModel(languages, table, bias, temperature, min(threshold, HIGHEST_THRESHOLD))


def _packed(counts: np.ndarray) -> bytes:
    """Buckets that occur, then how often each does, as 32-bit numbers."""
    hit = np.flatnonzero(counts)
    return np.concatenate([hit, counts[hit]]).astype("<i4").tobytes()


def _featurizer(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        # Packed one by one: the counts of all buckets are far longer than a text.
        yield pa.array([_packed(subword_counts(t or "")) for t in batch.to_pylist()], pa.binary())


_featurizer.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", per_language: int = ROWS_PER_LANGUAGE) -> LanguageModel:
    """A model of the rows of ``labelled`` that have a text with letters and a language.

    At most ``per_language`` rows of each language are taken, those with the least hash of their
    text; repeats of one text count once. The hash is over texts, so the sample does not depend on
    order or partitions. Only hashes below a bound that leaves OVERSAMPLED times that many distinct
    texts of a language are ranked, so no task ranks a whole language. Subword counts, not texts, come to the
    driver: at most BUCKETS numbers a row.
    """
    usable = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}")
    ).withColumn("hash", F.xxhash64("text", F.lit(SEED)).bitwiseAND(F.lit(_HASHES - 1)))
    bounds = usable.groupBy("lang").agg(
        F.least(F.lit(1.0), OVERSAMPLED * F.lit(float(per_language)) / F.count_distinct("hash")).alias("share")
    ).select("lang", (F.col("share") * F.lit(float(_HASHES))).alias("bound"))
    least = Window.partitionBy("lang").orderBy("hash")
    # Of equal texts one hash is left; the rank is cut in each task before the shuffle.
    chosen = (
        usable.select("lang", "hash").join(F.broadcast(bounds), "lang").where("hash <= bound").select("lang", "hash").distinct()
        .withColumn("rank", F.row_number().over(least)).where(F.col("rank") <= per_language)
        .groupBy("lang").agg(F.max("hash").alias("last"))
    )
    sample = usable.join(F.broadcast(chosen), "lang").where("hash <= last")  # one row per language
    features = F.arrow_udf(_featurizer, "binary")
    rows = sample.groupBy("lang", "hash").agg(F.min("text").alias("text")).select(
        "lang", "hash", features("text").alias("f")
    ).collect()
    rows = sorted(rows, key=lambda r: (r["lang"], r["hash"]))
    numbers = [np.frombuffer(r["f"], "<i4").reshape(2, -1) for r in rows]
    return fit([(r["lang"], n[0].astype(np.int64), n[1].astype(np.float64)) for r, n in zip(rows, numbers)])


def _predictor(model):
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = LanguageModel(*model.value)
        for batch in batches:
            out = []
            for text in batch.to_pylist():
                if text is None or not known.languages:
                    out.append((UNKNOWN, 0.0))
                    continue
                chances = known.probabilities(subword_counts(text))
                best = int(chances.argmax())
                out.append((known.languages[best], float(chances[best])))
            yield pa.StructArray.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64())],
                                             fields=list(kind))

    predict.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(predict, "struct<lang:string,score:double>")


def identified(docs: DataFrame, model: LanguageModel, text: str = "text", name: str = "identified") -> DataFrame:
    """``docs`` with ``name``: a struct of lang, score (0 to 1) and rejected.

    A null text, a text without a letter, and any text when nothing was learned, is ``und`` with
    score 0 and rejected. Other texts get the likeliest learned language and its calibrated
    probability, and are rejected when that is below the model's threshold. Only the text is used.
    """
    # Sent as plain values: BUCKETS numbers per language.
    sent = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.table, model.bias, model.temperature, model.threshold)
    )
    spoken = F.when(F.col(text).rlike("\\p{L}"), F.col(text))
    found = docs.withColumn(name, _predictor(sent)(spoken))
    chosen = F.col(name)
    return found.withColumn(name, F.struct(
        chosen["lang"].alias("lang"), chosen["score"].alias("score"),
        ((chosen["lang"] == UNKNOWN) | (chosen["score"] < F.lit(model.threshold))).alias("rejected"),
    ))
