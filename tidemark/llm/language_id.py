"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its byte n-grams (lower-cased A-Z, every run of ASCII white
space as one space), hashed into buckets; a linear layer gives the logits. Both are trained by
stochastic gradient descent in numpy on a bounded sample of labelled texts (``per_language`` texts of
each language, chosen by the hash of their ids). Part of the sample is held back to fit a temperature,
so that the score is a probability, and to set the rejection threshold: the highest that rejects at
most ``lost`` of the texts it labels rightly.

The trained layers multiply out to one row of logits per bucket, so scoring a text is a mean over table
rows; the table's size is fixed by the parameters, and every whole text is scored in one pass without a
shuffle.

Null texts and texts without a letter get ``und``, score 0, and are rejected; so does everything if
nothing could be learned. Repeated rows get the same answer, empty tables no rows. Other columns are
not read, and language, source and id never enter a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import IS_WORD, BYTE_VALUES, blocks

SIZES = (3, 4)
BITS = 16
UNKNOWN = "und"


def buckets_of(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of a block, and each text's first entry."""
    inside = IS_WORD[data]
    values = np.where(inside, BYTE_VALUES[True][data], np.uint64(0x9E3779B97F4A7C15))
    keep = inside.copy()
    keep[1:] |= inside[:-1]  # the first of a run of white space stays
    first = np.zeros(len(data), bool)
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    kept = np.flatnonzero(keep | first)
    values, texts = values[kept], np.searchsorted(kept, offsets)
    codes, owner = [], np.repeat(np.arange(len(offsets) - 1), np.diff(texts))
    owners = []
    code = values
    for n in range(2, max(SIZES) + 1):
        if len(code) < 2:
            break
        code = code[:-1] * np.uint64(0x2545F4914F6CDD1D) + values[n - 1 :]
        if n in SIZES:
            same = owner[: len(code)] == owner[n - 1 :]
            codes.append((code[same] >> np.uint64(64 - bits)).astype(np.int64))
            owners.append(owner[: len(code)][same])
    if not codes:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(codes), np.concatenate(owners)


@dataclass
class Model:
    languages: list[str]
    logits: np.ndarray  # a row for each bucket
    bias: np.ndarray
    bits: int
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = (logits + self.bias) * self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def score(self, texts: pa.Array) -> np.ndarray:
        """Probabilities of whole texts."""
        out = np.zeros((len(texts), len(self.languages)), np.float64)
        for i, j, data, offsets in blocks(texts):
            codes, owner = buckets_of(data, offsets, self.bits)
            count = np.maximum(np.bincount(owner, minlength=j - i), 1)
            for c in range(len(self.languages)):
                out[i:j, c] = np.bincount(owner, self.logits[c][codes], j - i) / count
        return self.probabilities(out)


def _bags(bits: int):
    """Buckets and shares of each text, with its language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in blocks(batch.column(3)):
                codes, owner = buckets_of(data, offsets, bits)
                key, count = np.unique((owner << bits) | codes, return_counts=True)
                total = np.maximum(np.bincount(owner, minlength=j - i), 1)
                share = (count / total[key >> bits]).astype(np.float32)
                ends = pa.array(np.searchsorted(key >> bits, np.arange(j - i + 1)).astype(np.int32))
                at = pa.ListArray.from_arrays(ends, pa.array((key & ((1 << bits) - 1)).astype(np.int32)))
                columns = [*(batch.column(c).slice(i, j - i) for c in (0, 1, 2)), at, pa.ListArray.from_arrays(ends, pa.array(share))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "hash", "lang", "at", "share"])

    return run


def train(
    bags: list[tuple[np.ndarray, np.ndarray]], languages: list[str], bits: int = BITS, width: int = 8, epochs: int = 4, steps: int = 500, lost: float = 0.001, seed: int = 7
) -> Model:
    """Fit on the buckets and shares of texts, in ``steps`` minibatches at least; every fifth text is held back for calibration."""
    names = sorted(set(languages))
    random = np.random.default_rng(seed)
    target = np.array([names.index(x) for x in languages], np.int64)
    held = np.arange(len(bags)) % 5 == 4
    embedding = random.normal(0, 1 / width, (1 << bits, width)).astype(np.float32)
    layer = np.zeros((width, len(names)), np.float32)
    bias = np.zeros(len(names), np.float32)
    layer += random.normal(0, 0.1, layer.shape)
    fitted = np.flatnonzero(~held)
    epochs = max(epochs, -(-steps * 16 // max(1, len(fitted))))
    for epoch in range(epochs):
        random.shuffle(fitted)
        rate = 1.0 - epoch / epochs
        for k in range(0, len(fitted), 16):
            rows = fitted[k : k + 16]
            at = np.concatenate([bags[r][0] for r in rows])
            share = np.concatenate([bags[r][1] for r in rows])
            owner = np.repeat(np.arange(len(rows)), [len(bags[r][0]) for r in rows])
            mean = np.stack([np.bincount(owner, x, len(rows)) for x in embedding[at].T * share]).T
            z = mean @ layer + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), target[rows]] -= 1
            back = p @ layer.T
            layer -= rate * 2.0 / len(rows) * (mean.T @ p)
            bias -= rate * 0.1 / len(rows) * p.sum(axis=0)
            # Shares are small; the step on embeddings is scaled up to match.
            np.add.at(embedding, at, -rate * 10.0 * back[owner] * share[:, None])
    table = np.ascontiguousarray((embedding @ layer).T)
    model = Model(names, table, bias.astype(np.float64), bits)
    check = np.flatnonzero(held) if held.any() else np.arange(len(bags))
    logits = np.stack([[float(table[c][bags[r][0]] @ bags[r][1]) for c in range(len(names))] for r in check])
    right = target[check]

    def loss(t: float) -> float:
        model.temperature = t
        fit = -np.log(model.probabilities(logits)[np.arange(len(check)), right] + 1e-12).mean()
        return float(fit + 1e-3 * np.log(t) ** 2)  # a sample without errors must not drive it off

    model.temperature = float(min(np.geomspace(0.05, 20, 60), key=loss))
    p = model.probabilities(logits)
    sure = np.sort(p.max(axis=1)[p.argmax(axis=1) == right])
    if len(sure):
        model.threshold = float(min(0.5, sure[int(lost * len(sure))]))
    return model


def learn(
    docs: DataFrame, wanted: Column, per_language: int = 500, most: int = 12_000, text: str = "text", lang: str = "lang"
) -> Model | None:
    """Train on at most ``per_language`` rows of each language and ``most`` rows in all.

    ``wanted``: which rows may be learned from. Rows are taken in the order of their ids' hashes.
    """
    usable = wanted & F.col(lang).isNotNull() & F.col(text).isNotNull()
    ranked = docs.where(usable).select("doc_id", F.col(lang).alias("lang"), F.xxhash64("doc_id").alias("hash"))
    # First within parts of a language, so that a language with most of the texts is no single task.
    for groups in (["lang", F.pmod("hash", F.lit(64))], ["lang"]):
        order = Window.partitionBy(*groups).orderBy("hash", "doc_id")
        ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_language)
    chosen = [r["doc_id"] for r in ranked.orderBy("rank", "lang").limit(most).select("doc_id").collect()]
    if not chosen:
        return None
    # Texts stay in their tasks; at most 1 << BITS buckets of each come here, and of several rows of one id one.
    own = docs.where(usable & F.col("doc_id").isin(chosen))
    own = own.select("doc_id", F.xxhash64(lang, text).alias("hash"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    bags = own.mapInArrow(_bags(BITS), "doc_id long, hash long, lang string, at array<int>, share array<float>")
    bags = bags.groupBy("doc_id").agg(F.min_by(F.struct("lang", "at", "share"), F.struct("hash", "lang")).alias("bag"))
    # The same order however the rows are split into files and tasks.
    place = {doc_id: i for i, doc_id in enumerate(chosen)}
    found = bags.select("doc_id", "bag.*").toArrow().combine_chunks()
    order = sorted(range(found.num_rows), key=lambda i: place[found["doc_id"][i].as_py()])
    at, share = found["at"], found["share"]
    # Views of the collected columns, four bytes a bucket: a copy of eight each would stay in the driver's Python.
    pairs = [(at[i].values.to_numpy(), share[i].values.to_numpy()) for i in order]
    model = train(pairs, [found["lang"][i].as_py() for i in order])
    del found, at, share, pairs
    pa.default_memory_pool().release_unused()
    return model


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and rejected."""
    spark = docs.sparkSession
    columns = [F.col(f"row.`{c}`") for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    if model is None:
        answer = F.lit(None).cast("struct<lang:string,score:double>")
    else:
        shared = spark.sparkContext.broadcast(model)  # fixed size: buckets x languages

        @F.arrow_udf("struct<lang:string,score:double>")
        def predicted(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            names = np.array(shared.value.languages, dtype=object)
            for part in parts:
                p = shared.value.score(part)
                best = p.argmax(axis=1)
                columns = [pa.array(names[best], pa.string()), pa.array(p[np.arange(len(p)), best])]
                yield pa.StructArray.from_arrays(columns, names=["lang", "score"])

        answer = predicted(F.col(text))
    threshold = model.threshold if model else 0.0
    judged = docs.select(row, lettered.alias("lettered"), answer.alias("answer"))
    known = F.col("lettered") & F.col("answer").isNotNull()
    score = F.when(known, F.col("answer.score")).otherwise(0.0)
    return judged.select(
        *columns,
        F.when(known, F.col("answer.lang")).otherwise(UNKNOWN).alias("lang_pred"),
        score.alias("score"),
        (~known | (score < threshold)).alias("rejected"),
    )


def accepted(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows that are not rejected, with the columns of ``docs``."""
    found = identify(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(text)), model, text)
    return found.where(~F.col("rejected")).select("_row.*")
