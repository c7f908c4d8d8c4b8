"""Toxicity by a classifier chain of linear models.

The categories are predicted one after another. Each model is logistic and sees the words of the text (hashed,
present or not) that the likelihood ratio test ties to the category among the rows of the fit, and the probabilities of
all earlier categories. Without the test, the long tail of rare words explains the sample and hides the words that carry
over to new documents. For training, those probabilities are
out-of-fold: each labelled document gets them from a model that has not seen it, as the later model will meet
them on new documents.

The models are fitted in one task on at most ``sample`` labelled documents (``SAMPLE`` by default), taken by the
hash of their ids, so the fit has a bounded size; every document is scored.

Defined results: a null text counts as empty; a null label leaves that row out of that category's fit; repeated
ids in the labels take the largest label; with no labelled document, or one class only, the probability is the
share of positives (0 with none); rows that repeat give a row each; an empty table gives no rows; other columns
are ignored; texts are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from millrace.llm.batches import TwoGenerations, blocks_of, map_rows, utf8
from millrace.plans.durable import staged

SAMPLE = 20_000
FEATURES = 1 << 18
FOLDS = 3
EPOCHS = 12
BATCH = 128
SIGNIFICANT = 10.83  # likelihood ratio of a word and a category: chance gives so much to one word in a thousand
THRESHOLD = 0.3  # toxic documents are a small share, and their words are few
BLOCK_BYTES = 2 << 20

# Words are runs of letters, digits, apostrophes and bytes beyond ASCII, A-Z lower-cased.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b == 0x27 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
              for b in range(256))
_hashed = TwoGenerations(lambda word: xxhash.xxh3_64_intdigest(word) % FEATURES, 200_000, 64)


def features(texts: Sequence[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(columns, bounds): the distinct hashed words of text i are columns[bounds[i]:bounds[i + 1]]."""
    words = [t.translate(_FOLD).split() if t else [] for t in texts]
    coded = pa.array(chain.from_iterable(words), pa.large_binary()).dictionary_encode()
    known = np.array([_hashed[w] for w in coded.dictionary.to_pylist()], dtype=np.int64)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    cells = np.unique(row * FEATURES + known[coded.indices.to_numpy()]) if len(row) else row
    return cells % FEATURES, np.searchsorted(cells // FEATURES, np.arange(len(words) + 1))


@dataclass(frozen=True)
class Link:
    """The model of one category: word weights, weights of earlier probabilities, and the intercept.

    Without both classes in the sample only ``constant`` is set.
    """

    words: np.ndarray | None = None
    earlier: np.ndarray | None = None
    intercept: float = 0.0
    constant: float | None = None

    def probabilities(self, columns: np.ndarray, bounds: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(bounds) - 1, self.constant)
        sums = np.concatenate([[0.0], np.cumsum(self.words[columns])])
        return logistic(sums[bounds[1:]] - sums[bounds[:-1]] + earlier @ self.earlier + self.intercept)


def logistic(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def telling(columns: np.ndarray, bounds: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which words occur so unevenly in the two classes of the rows that chance does not explain it."""
    marked = np.zeros(len(bounds) - 1)
    marked[rows] = 1 + labels[rows]
    owner = np.repeat(marked, np.diff(bounds))
    without, with_ = (np.bincount(columns[owner == k], minlength=FEATURES).astype(float) for k in (1, 2))
    positive = labels[rows].sum()
    negative, total = len(rows) - positive, len(rows)

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.where(seen > 0, seen, 1) / np.maximum(expected, 1e-300)), 0.0)

    used = without + with_
    ratio = (part(with_, used * positive / total) + part(without, used * negative / total)
             + part(positive - with_, (total - used) * positive / total) + part(negative - without, (total - used) * negative / total))
    return 2 * ratio >= SIGNIFICANT


def fit_link(columns: np.ndarray, bounds: np.ndarray, earlier: np.ndarray, labels: np.ndarray, rows: np.ndarray,
             rate: float = 0.5, decay: float = 1e-4) -> Link:
    """Logistic regression on some rows by adaptive gradient steps over small batches, in a fixed order."""
    rows = rows[~np.isnan(labels[rows])]
    share = float(labels[rows].mean()) if len(rows) else 0.0
    if share in (0.0, 1.0):
        return Link(constant=share)
    kept = telling(columns, bounds, labels, rows)[columns]
    columns, bounds = columns[kept], np.concatenate([[0], np.cumsum(kept)])[bounds]
    extra = earlier.shape[1]
    weights = np.zeros(FEATURES + extra + 1)
    weights[-1] = np.log(share / (1 - share))
    squares = np.full(len(weights), 1e-2)
    for epoch in range(EPOCHS):
        order = np.random.default_rng(epoch).permutation(rows)
        for at in range(0, len(order), BATCH):
            batch = order[at:at + BATCH]
            sizes = bounds[batch + 1] - bounds[batch]
            ends = np.cumsum(sizes)
            cells = columns[np.repeat(bounds[batch] - (ends - sizes), sizes) + np.arange(ends[-1])]
            owner = np.repeat(np.arange(len(batch)), sizes)
            z = np.bincount(owner, weights[cells], len(batch)) + earlier[batch] @ weights[FEATURES:-1] + weights[-1]
            off = (logistic(z) - labels[batch]) / len(batch)
            touched, inverse = np.unique(cells, return_inverse=True)
            slope = np.bincount(inverse, off[owner], len(touched)) + decay * weights[touched]
            tail = np.concatenate([off @ earlier[batch], [off.sum()]])
            touched = np.concatenate([touched, np.arange(FEATURES, len(weights))])
            slope = np.concatenate([slope, tail])
            squares[touched] += slope * slope
            weights[touched] -= rate * slope / np.sqrt(squares[touched])
    return Link(weights[:FEATURES], weights[FEATURES:-1], float(weights[-1]))


def fit_chain_arrays(columns: np.ndarray, bounds: np.ndarray, labels: np.ndarray, fold: np.ndarray, folds: int) -> list[Link]:
    """Links for the columns of ``labels`` (nan where unknown), in order."""
    earlier = np.zeros((len(labels), 0))
    everyone, links = np.arange(len(labels)), []
    for step in range(labels.shape[1]):
        links.append(fit_link(columns, bounds, earlier, labels[:, step], everyone))
        if step + 1 < labels.shape[1]:
            unseen = np.zeros(len(labels))
            for f in range(folds):
                own = fit_link(columns, bounds, earlier, labels[:, step], everyone[fold != f])
                unseen[fold == f] = own.probabilities(columns, bounds, earlier)[fold == f]
            earlier = np.column_stack([earlier, unseen])
    return links


def fit_chain(docs: DataFrame, labels: DataFrame, categories: Sequence[str], sample: int = SAMPLE, folds: int = FOLDS,
              id_column: str = "doc_id", text_column: str = "text") -> list[Link]:
    """Models of all categories, in their order. ``labels`` has (id, categories) with 0 and 1."""
    chosen = (labels.where(F.col(id_column).isNotNull())
              .groupBy(F.col(id_column).alias("_id")).agg(*[F.max(F.col(c).cast("double")).alias(c) for c in categories])
              .orderBy(F.xxhash64("_id"), "_id").limit(sample))
    texts = docs.select(F.col(id_column).alias("_id"), utf8(text_column).alias("_text"))
    # At most ``sample`` narrow rows are broadcast: their size is bounded.
    joined = texts.join(F.broadcast(chosen), "_id")

    def hashed(rows: Iterator[tuple]) -> Iterator[tuple]:
        for block in blocks_of(rows, lambda row: len(row[1] or b""), BLOCK_BYTES):
            columns, bounds = features([row[1] for row in block])
            for row, a, b in zip(block, bounds[:-1], bounds[1:]):
                yield row[0], columns[a:b], row[2]

    key = docs.schema[id_column].dataType.simpleString()
    sampled = staged(map_rows(joined, [F.col("_id"), F.col("_text"), F.array(*categories)],
                              f"_id {key}, columns array<int>, labels array<double>", hashed), "labelled")

    def fitted(rows: Iterator[tuple]) -> Iterator[tuple]:
        own = list(rows)
        if not own:
            return
        bounds = np.concatenate([[0], np.cumsum([len(r[1]) for r in own])])
        columns = np.fromiter(chain.from_iterable(r[1] for r in own), np.int64, bounds[-1])
        wanted = np.array([[np.nan if v is None else v for v in r[2]] for r in own])
        fold = np.array([r[3] for r in own])
        for link in fit_chain_arrays(columns, bounds, wanted, fold, folds):
            if link.constant is not None:
                yield None, None, 0.0, link.constant
            else:
                yield link.words.astype(np.float32).tobytes(), list(link.earlier), link.intercept, None

    ordered = sampled.repartition(1).sortWithinPartitions(F.xxhash64("_id"), "_id")
    models = map_rows(ordered, [F.col("_id"), F.col("columns"), F.col("labels"), F.pmod(F.xxhash64(F.col("_id"), F.lit("fold")), F.lit(folds))],
                      "words binary, earlier array<double>, intercept double, constant double", fitted).collect()
    links = [Link(None if m["words"] is None else np.frombuffer(m["words"], np.float32),
                  None if m["earlier"] is None else np.array(m["earlier"]), m["intercept"], m["constant"]) for m in models]
    return links or [Link(constant=0.0) for _ in categories]  # no task ran: there was no labelled document


def score(docs: DataFrame, links: Sequence[Link], categories: Sequence[str], id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """(id, p_<category> for each) for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(list(links))  # one weight per feature and category

    def scored(rows: Iterator[tuple]) -> Iterator[tuple]:
        for block in blocks_of(rows, lambda row: len(row[1] or b""), BLOCK_BYTES):
            columns, bounds = features([text for _, text in block])
            earlier = np.zeros((len(block), 0))
            for link in sent.value:
                earlier = np.column_stack([earlier, link.probabilities(columns, bounds, earlier)])
            for (key, _), found in zip(block, earlier.tolist()):
                yield key, *found

    key = docs.schema[id_column].dataType.simpleString()
    return map_rows(docs, [F.col(id_column), utf8(text_column)],
                    f"`{id_column}` {key}, " + ", ".join(f"`p_{c}` double" for c in categories), scored, spread=True)
