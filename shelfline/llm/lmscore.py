"""LM scoring by masked pseudo-likelihood: every token is predicted from the words on both sides.

A token is (class, word): the ``TOP`` most frequent word buckets of the corpus are
classes of their own, all other words fall into classes by their last two bytes. A
small network sees the classes of ``SIDE`` words left and right of the masked one and
gives the class's probability; the word's probability inside its class is the corpus's
own count of that very word, smoothed. The sum of both log probabilities over all tokens
is the document's score.

Both parts are learned from every text. Word counts are a table as long as the
vocabulary, by 64-bit hash. Words of at least a ``SHARE``-th of all tokens, so at most
``SHARE`` of them, go to every task; the rest of a text's words are joined to the table.
The network is trained in numpy where the data lies: each task runs one pass of
mini-batches over its texts from the same start, and the tasks' weights are averaged by
their numbers of tokens, round after round.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import textops
from shelfline.llm.scratch import table

TOP, ENDINGS = 24, 40
CLASSES = TOP + ENDINGS
BUCKETS, SHARE = 1 << 16, 100_000
SIDE, HIDDEN = 2, 32
BATCH, RATE, DECAY = 4096, 0.05, 1e-8
SMOOTH = 0.5
FIXED = float(1 << 32)  # sums of log-probabilities are whole numbers of this part: the same in any order
_U = np.uint64


@dataclass
class Network:
    """One table per context place (a row per class and one for "outside the text"), a hidden layer, a softmax."""

    tables: np.ndarray  # (2 * SIDE, CLASSES + 1, HIDDEN)
    bias: np.ndarray
    out: np.ndarray  # (HIDDEN, CLASSES)
    out_bias: np.ndarray

    @staticmethod
    def start(seed: int = 3) -> Network:
        rng = np.random.default_rng(seed)
        return Network(
            rng.normal(0, 0.1, (2 * SIDE, CLASSES + 1, HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32),
            rng.normal(0, 0.1, (HIDDEN, CLASSES)).astype(np.float32), np.zeros(CLASSES, np.float32),
        )

    def arrays(self) -> list[np.ndarray]:
        return [self.tables, self.bias, self.out, self.out_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    @staticmethod
    def from_flat(x: np.ndarray) -> Network:
        parts, at = [], 0
        for a in Network.start().arrays():
            parts.append(np.ascontiguousarray(x[at:at + a.size].reshape(a.shape), np.float32))
            at += a.size
        return Network(*parts)

    def hidden(self, context: np.ndarray) -> np.ndarray:
        h = self.tables[0][context[:, 0]] + self.bias
        for k in range(1, context.shape[1]):
            h += self.tables[k][context[:, k]]
        return np.tanh(h, out=h)

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        z = self.hidden(context) @ self.out
        z += self.out_bias
        z -= z.max(1, keepdims=True)
        own = z[np.arange(len(z)), target]
        return own - np.log(np.exp(z, out=z).sum(1))


def train(net: Network, context: np.ndarray, target: np.ndarray, squares: list[np.ndarray]) -> None:
    """One pass of Adagrad mini-batches, in place."""
    params = net.arrays()
    eye = np.eye(CLASSES + 1, dtype=np.float32)
    for at in range(0, len(target), BATCH):
        c, t = context[at:at + BATCH], target[at:at + BATCH]
        h = net.hidden(c)
        z = h @ net.out
        z += net.out_bias
        z -= z.max(1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(1, keepdims=True)
        z[np.arange(len(t)), t] -= 1
        z /= len(t)
        back = (z @ net.out.T) * (1 - h * h)
        grads = [np.stack([eye[c[:, k]].T @ back for k in range(c.shape[1])]), back.sum(0), h.T @ z, z.sum(0)]
        for p, g, s in zip(params, grads, squares, strict=True):
            s += g * g
            p -= RATE * g / np.sqrt(s + DECAY)


def endings(run: textops.Words) -> np.ndarray:
    """Class of every word by its last two bytes."""
    last = run.data[run.end - 1].astype(np.uint32)
    before = np.where(run.end - run.start > 1, run.data[np.maximum(run.end - 2, 0)], 0).astype(np.uint32)
    return TOP + (((last * np.uint32(257) + before) * np.uint32(2654435761) >> np.uint32(16)) % np.uint32(ENDINGS)).astype(np.int64)


@dataclass
class Classes:
    """Class of each word bucket (-1: by ending)."""

    of_bucket: np.ndarray

    def tokens(self, run: textops.Words) -> tuple[np.ndarray, np.ndarray]:
        """(class, word hash) of every word of a run."""
        h = run.hashes()
        own = self.of_bucket[(h & _U(BUCKETS - 1)).astype(np.int64)]
        return np.where(own >= 0, own, endings(run)), h


def contexts(classes: np.ndarray, run: textops.Words) -> np.ndarray:
    """The classes SIDE places left and right of every word; places outside the text are class ``CLASSES``."""
    doc = run.doc_of_word()
    out = np.full((len(classes), 2 * SIDE), CLASSES, np.int64)
    for k in range(1, SIDE + 1):
        same = doc[k:] == doc[:-k]
        out[k:, SIDE - k][same] = classes[:-k][same]
        out[:-k, SIDE + k - 1][same] = classes[k:][same]
    return out


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, ending, n): occurrences of each distinct word in all texts, by hash."""

    def run(batches):
        for batch in batches:
            for part in textops.words(batch.column("text")):
                word, at, n = np.unique(part.hashes(), return_index=True, return_counts=True)
                if len(word):
                    yield pa.RecordBatch.from_arrays([pa.array(textops.signed(word)), pa.array(endings(part)[at].astype(np.int32)), pa.array(n)], ["word", "ending", "n"])

    found = docs.select("text").mapInArrow(run, "word long, ending int, n long")
    return table(found.groupBy("word").agg(F.min("ending").alias("ending"), F.sum("n").alias("n")))


@dataclass
class Words:
    """What is known of words inside their classes: a token's log-probability is its class's ``unseen`` and the word's ``gain``."""

    unseen: np.ndarray  # of each class
    frequent: np.ndarray  # hashes, rising
    frequent_gain: np.ndarray
    rest: DataFrame  # (word, gain): all others; gain in parts of FIXED


@dataclass
class Model:
    classes: Classes
    network: Network
    cells: Words


def _words(counts: DataFrame, of_bucket: np.ndarray) -> Words:
    bucket = F.col("word").bitwiseAND(BUCKETS - 1)
    own = F.col("ending")
    for b in np.flatnonzero(of_bucket >= 0):
        own = F.when(bucket == int(b), int(of_bucket[b])).otherwise(own)
    n, distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    for c, total, different in counts.groupBy(own.alias("c")).agg(F.sum("n"), F.count("*")).collect():
        n[c], distinct[c] = total, different
    unseen = np.log(SMOOTH / (n + SMOOTH * (distinct + 1)))
    often = F.col("n") >= max(1.0, n.sum() / SHARE)
    gain = F.round((F.log(F.col("n") + SMOOTH) - F.log(F.lit(SMOOTH))) * FIXED).cast("long").alias("gain")
    top = counts.filter(often).select("word", gain).toArrow()
    word = top.column("word").to_numpy().view(_U)
    order = np.argsort(word)
    return Words(unseen, word[order], top.column("gain").to_numpy()[order].astype(np.int64), counts.filter(~often).select("word", gain))


def learn(docs: DataFrame, rounds: int = 1, seed: int = 3) -> Model:
    """Counts and network weights from every text of ``docs``.

    The driver gets a table of bucket counts, the most frequent words and the averaged
    weights, each of bounded size; the counts of all words stay a table.
    """
    words = word_counts(docs)
    counts = np.zeros(BUCKETS, np.int64)
    for bucket, n in words.groupBy(F.col("word").bitwiseAND(BUCKETS - 1)).agg(F.sum("n")).collect():
        counts[bucket] = n
    of_bucket = np.full(BUCKETS, -1, np.int64)
    frequent = [b for b in np.lexsort((np.arange(BUCKETS), -counts))[:TOP] if counts[b]]
    of_bucket[frequent] = np.arange(len(frequent))
    classes = Classes(of_bucket)
    net = Network.start(seed)
    size = len(net.flat())
    for _ in range(rounds):
        start = net.flat()

        def run(batches, start=start):
            own = Network.from_flat(start)
            squares = [np.zeros_like(a) for a in own.arrays()]
            tokens = 0
            for batch in batches:
                for part in textops.words(batch.column("text")):
                    if not len(part.start):
                        continue
                    target, _ = classes.tokens(part)
                    tokens += len(target)
                    train(own, contexts(target, part), target, squares)
            if tokens:
                place = np.concatenate([np.arange(size), [-1]])
                value = np.concatenate([own.flat().astype(np.float64) * tokens, [tokens]])
                yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(value)], ["place", "value"])

        weights, tokens = np.zeros(size), 0.0
        for place, value in docs.select("text").mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value")).collect():
            if place < 0:
                tokens = value
            else:
                weights[place] = value
        if tokens:
            net = Network.from_flat(weights / tokens)
    return Model(classes, net, _words(words, of_bucket))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, log_likelihood (sum over tokens of the log-probability given both sides) and its mean per token.

    Null, empty and blank texts have no tokens, sum 0 and a null mean. Equal texts score
    alike; other columns are ignored.
    """

    classes, network = model.classes, model.network
    unseen, frequent, gain = model.cells.unseen, model.cells.frequent, model.cells.frequent_gain

    def run(batches):
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            sums, counts = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            rare, rares = [np.zeros(0, np.int64)], np.zeros(batch.num_rows, np.int64)
            for part in textops.words(batch.column("text"), textops.SLICE_BYTES // 2):
                if not len(part.start):
                    continue
                target, word = classes.tokens(part)
                context = contexts(target, part)
                logs = unseen[target]
                for at in range(0, len(target), BATCH):
                    logs[at:at + BATCH] += network.log_probabilities(context[at:at + BATCH], target[at:at + BATCH])
                fixed = np.round(logs * FIXED).astype(np.int64)
                known = np.zeros(len(word), bool)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, word), len(frequent) - 1)
                    known = frequent[at] == word
                    fixed += np.where(known, gain[at], 0)
                here = slice(part.first, part.first + len(part))
                total = np.concatenate([[0], np.cumsum(fixed)])
                sums[here] = total[part.bounds[1:]] - total[part.bounds[:-1]]
                counts[here] = part.counts
                rare.append(textops.signed(word[~known]))
                rares[here] = np.bincount(part.doc_of_word()[~known], minlength=len(part))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(rares)]).astype(np.int32)), pa.array(np.concatenate(rare)))
            keys = pa.array(np.arange(row, row + batch.num_rows))
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays([keys, batch.column("doc_id"), pa.array(counts), pa.array(sums), lists], ["row", "doc_id", "n_tokens", "part", "words"])

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seen = table(ids.mapInArrow(run, "row long, doc_id long, n_tokens long, part long, words array<long>"))
    rest = seen.select("row", F.explode("words").alias("word")).join(model.cells.rest, "word").groupBy("row").agg(F.sum("gain").alias("gain"))
    total = ((F.col("part") + F.coalesce("gain", F.lit(0))) / FIXED).alias("log_likelihood")
    scored = seen.drop("words").join(rest, "row", "left").select("doc_id", "n_tokens", total)
    return scored.withColumn("mean_log_likelihood", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))
