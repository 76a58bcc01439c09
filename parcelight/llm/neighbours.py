"""Quality by nearest-neighbour voting in a latent-semantic space.

A text becomes weights of hashed byte pairs (square root of the share, times how
rare the pair is over all documents) and of a few layout shares. A truncated
singular value decomposition, fitted on at most ``MAX_LABELLED`` labelled
documents, maps that to ``DIMENSIONS`` numbers. These documents' vectors and labels
are broadcast: a fixed size, however large the corpus. Every document is compared
with all of them by blocked exact cosine products; its ``NEIGHBOURS`` nearest (and
whoever is as near as the last) vote, weighted by similarity.

Document frequencies are counted over all documents.

Defined cases: a null or empty text has no direction, nobody votes, and the score is
the share of label 1 (1.0 without any labelled row, so nothing is rejected
unlearnt); rows with null label or id teach nothing; several labels of one id count
as their mean; repeated rows get one score each; an input column named like the
score is replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.llm.common import fresh_name, slices, without

PAIRS = 1024  # hashed byte pairs
LAYOUT = 6
TERMS = PAIRS + LAYOUT
LAYOUT_WEIGHT = 1.0
DIMENSIONS = 64
MAX_LABELLED = 4096  # labelled documents that teach, the ones with the smallest hash
NEIGHBOURS = 21
BLOCK = 256  # documents compared at once
THRESHOLD = 0.3
_SYMBOLS = b"#*$%&|<>!_~^=+@"

_pair = (np.arange(1 << 16, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(54)
_pair = _pair.astype(np.int64)


def term_shares(text: str | None) -> np.ndarray:
    """Square roots of the shares of hashed byte pairs and layout properties."""
    out = np.zeros(TERMS)
    data = (text or "").encode()
    codes = np.frombuffer(data, dtype=np.uint8)
    if len(codes) < 2:
        return out
    pairs = codes[:-1].astype(np.int64) << 8 | codes[1:]
    out[:PAIRS] = np.bincount(_pair[pairs], minlength=PAIRS) / len(pairs)
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    n = max(1, len(words))
    repeated = sum(map(bytes.__eq__, words, words[1:]))
    kinds = np.bincount(codes, minlength=256)
    shown = max(1, len(codes) - int(kinds[[9, 10, 11, 12, 13, 32]].sum()))
    out[PAIRS:] = (
        repeated / n,
        max(0.0, 1 - 2 * len(set(words)) / n),
        int(kinds[list(_SYMBOLS)].sum()) / shown,
        int(kinds[65:91].sum()) / shown,
        int(kinds[48:58].sum()) / shown,
        1 - len(set(lines)) / max(1, len(lines)),
    )
    return np.sqrt(out)


@dataclass
class Model:
    rarity: np.ndarray  # (TERMS,)
    projection: np.ndarray  # (TERMS, dimensions)
    vectors: np.ndarray  # (labelled, dimensions), of length 1
    labels: np.ndarray  # (labelled,) share of label 1
    prior: float

    def directions(self, shares: np.ndarray) -> np.ndarray:
        mapped = (shares * self.rarity) @ self.projection
        length = np.linalg.norm(mapped, axis=1, keepdims=True)
        return np.divide(mapped, length, out=np.zeros_like(mapped), where=length > 1e-12)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        k = min(NEIGHBOURS, len(self.labels))
        if not k:
            return out
        for at in range(0, len(texts), BLOCK):
            mine = self.directions(np.array([term_shares(t) for t in texts[at : at + BLOCK]]))
            near = np.round(mine @ self.vectors.T, 9)
            last = np.partition(near, -k, axis=1)[:, -k][:, None]
            votes = np.where(near >= last, np.maximum(near, 0.0), 0.0)
            whole = votes.sum(axis=1)
            share = votes @ self.labels
            out[at : at + BLOCK] = np.where(whole > 0, share / np.where(whole > 0, whole, 1), self.prior)
        return np.clip(np.round(out, 6), 0.0, 1.0)


def document_frequencies(docs: DataFrame, text: str) -> tuple[int, np.ndarray]:
    """Documents with a text, and how many of them have each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(TERMS, dtype=np.int64), 0
        for batch in slices(batches, text):
            for t in batch.column(text).to_pylist():
                if t:
                    counts += term_shares(t) > 0
                    n += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, TERMS), pa.int32()), pa.array(np.r_[n, counts])], ["term", "n"]
        )

    rows = (
        docs.select(text).mapInArrow(run, "term int, n long").groupBy("term")
        .agg(F.sum("n").alias("n")).collect()  # one row per term
    )
    found = {r.term: r.n for r in rows}
    return found.get(-1, 0), np.array([found.get(i, 0) for i in range(TERMS)])


def fit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text",
    label: str = "quality", limit: int = MAX_LABELLED,
) -> Model:
    """``labels``: (id, label) of rows that may teach."""
    usable = (
        labels.where(F.col(id_column).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(id_column).alias("_id"))
        .agg(F.avg(F.col(label).cast("double")).alias("_label"))
    )
    known = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text")).where(
        F.col("_text").isNotNull()
    )
    present = usable.join(known.select("_id"), "_id", "left_semi")
    chosen = present.orderBy(F.xxhash64("_id"), "_id").limit(limit)
    prior = usable.agg(F.avg("_label")).first()[0]

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            found = [
                term_shares(t).astype(np.float32).tobytes()
                for t in batch.column("_text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_label"), pa.array(found, pa.binary())],
                ["_id", "_label", "shares"],
            )

    # At most ``limit`` ids, so their texts are few: the smallest of an id's texts.
    taught = known.join(F.broadcast(chosen), "_id").groupBy("_id", "_label").agg(
        F.min("_text").alias("_text")
    )
    id_type = dict(taught.dtypes)["_id"]
    rows = taught.mapInArrow(shares, f"_id {id_type}, _label double, shares binary").toPandas()
    rows = rows.sort_values("_id")
    n, frequency = document_frequencies(docs, text)
    rarity = np.log((n + 1) / (frequency + 1)) + 1
    rarity[PAIRS:] = LAYOUT_WEIGHT
    given = np.array([np.frombuffer(s, dtype=np.float32) for s in rows["shares"]], dtype=float)
    given = given.reshape(-1, TERMS)
    weighted = given * rarity
    _, axes = np.linalg.eigh(weighted.T @ weighted)
    model = Model(
        rarity, np.ascontiguousarray(axes[:, ::-1][:, :DIMENSIONS]), np.zeros((0, 0)),
        rows["_label"].to_numpy(dtype=float), 1.0 if prior is None else float(prior),
    )
    model.vectors = model.directions(given)
    return model


def with_score(docs: DataFrame, model: Model, text: str, name: str) -> DataFrame:
    """All columns but one of the same name, and the score (0 to 1, higher: label 1
    likelier)."""
    docs = without(docs, name)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select("*", F.lit(0.0).alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            scores = pa.array(sent.value.scores(batch.column(text).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, scores], names=[*batch.schema.names, name]
            )

    return docs.mapInArrow(run, schema)


def keep_good(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows that score at least ``threshold``; their columns."""
    model = fit(docs, labels, id_column, text)
    score = fresh_name(docs, "_score")
    scored = with_score(docs, model, text, score)
    return scored.where(F.col(score) >= threshold).drop(score)
