"""Language-model scoring: a log-bilinear model trained by noise-contrastive estimation.

The model predicts the class of the next token from the classes of the two tokens before it:
the most frequent words and the end of a text are classes of their own, all other words fall into
classes by their last two bytes. The words of such a class share its probability by their corpus
counts plus one, with one unit more for all unseen words. Two position matrices turn the context's vectors into a predicted vector, whose
products with the target vectors, plus biases, are the scores. Training sees the whole training
text: texts are dealt by id to trainers, whose number follows from the tokens and not from how the
table is stored; each trains in numpy on its texts against noise drawn from the unigram
distribution, then their parameters are averaged by their weight, for a few rounds. For
scoring, the sums over all classes are formed exactly for every context, so that probabilities
add up to one.

Contract: null and empty texts hold the end token only; repeated rows are counted and scored
each; without training text every count is 0; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmart.llm.common import slices, written

WORD_CLASSES = 384
ENDING_CLASSES = 128
HOT_WORDS = 1 << 16  # words whose counts every task holds; the others are joined
WIDTH, NOISE, BATCH, ROUNDS, RATE = 16, 64, 1024, 2, 0.05
TRAINER_TOKENS = 1 << 22  # a trainer sees about so many in a round
LEVELS = 16  # steps of word counts per doubling, by which hot words are told
FLUSH_WORDS = 400_000
END = b""


def tokens(text: str) -> list[bytes]:
    """Words in lower-case ASCII letters, then the end token. (``bytes`` methods are ASCII only.)"""
    return [*text.encode().lower().split(), END]


def ending_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % ENDING_CLASSES


def count_words(docs: DataFrame) -> DataFrame:
    """``word, n`` over all rows; every task sums up its words before they are sent."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], schema=schema)

        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                counts.update(tokens(text))
                if len(counts) > FLUSH_WORDS:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    partial = docs.select("text").mapInArrow(run, "word binary, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    total: int  # tokens in the training text
    distinct: int
    hot: list[bytes]  # words with classes of their own first
    counts: np.ndarray  # of the hot words
    singles: int  # how many have such a class
    ending_counts: np.ndarray  # tokens of the other words by ending class
    ending_words: np.ndarray  # and how many such words there are

    def noise(self) -> np.ndarray:
        weights = np.append(self.counts[: self.singles], self.ending_counts) + 1.0
        return weights / weights.sum()

    def unit_logs(self) -> np.ndarray:
        """By class: log10 of the share that one unit of count has of it; 0 for single words."""
        return np.append(np.zeros(self.singles), -np.log10(self.ending_counts + self.ending_words + 1.0))


def vocabulary(counts: DataFrame, word_classes: int = WORD_CLASSES, hot_words: int = HOT_WORDS) -> Vocabulary:
    ending = F.pmod(F.crc32(F.substring("word", -2, 2)), F.lit(ENDING_CLASSES))
    sums = counts.groupBy(ending.alias("e")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    by_count, by_words = np.zeros(ENDING_CLASSES, dtype=np.int64), np.zeros(ENDING_CLASSES, dtype=np.int64)
    for r in sums:
        by_count[r["e"]], by_words[r["e"]] = r["n"], r["words"]
    total, distinct = int(by_count.sum()), int(by_words.sum())
    top = counts.orderBy(F.desc("n"), "word").limit(min(word_classes, hot_words)).collect()
    # hot words beyond the classes: whole steps of counts, from the top, as far as they fit
    level = F.floor(F.log2("n") * LEVELS)
    steps = counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    fitting = [r["level"] for r, held in zip(steps, np.cumsum([r["count"] for r in steps]), strict=True) if held <= hot_words]
    hot = counts.filter(level >= fitting[-1]).collect() if fitting else []
    # the end token always is a class
    ends = counts.filter(F.length("word") == 0).collect()
    ranked = sorted({(-r["n"], bytes(r["word"])) for r in [*top, *hot, *ends]})
    known = {word: -n for n, word in ranked}
    words = [END, *(w for w in known if w != END)]
    singles = min(word_classes, len(words))
    for word in words[:singles]:
        by_count[ending_class(word)] -= known.get(word, 0)
        by_words[ending_class(word)] -= word in known
    hot_counts = np.array([known.get(w, 0) for w in words], dtype=np.int64)
    return Vocabulary(total, distinct, words, hot_counts, singles, by_count, by_words)


CODED = "row_key long, doc_id long, held_out boolean, n_tokens long, codes binary, hot_known long, hot_log double, single_log double, rare array<struct<word:binary,n:int>>"


def code(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Each text as class numbers, with the sums that need hot words only, and its rare words."""
    rare_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())]))
    names = [f.split()[0] for f in CODED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {w: i for i, w in enumerate(vocab.hot)}
        logs = np.append(np.log10(vocab.counts + 1.0), 0.0)  # the last entry is that of rare words
        known = np.append(vocab.counts > 0, False)
        class_of = np.array([i if i < vocab.singles else vocab.singles + ending_class(w) for i, w in enumerate(vocab.hot)])
        key = TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            columns: list[list] = [[] for _ in range(7)]
            for text in batch.column("text").to_pylist():
                words = tokens(text)
                ids = np.array([number.get(w, -1) for w in words], dtype=np.int64)
                codes = np.where(ids < 0, 0, class_of[ids])
                unknown = np.flatnonzero(ids < 0).tolist()
                codes[unknown] = [vocab.singles + ending_class(words[i]) for i in unknown]
                rare = Counter(words[i] for i in unknown)
                row = (
                    len(words),
                    codes.astype("<u2").tobytes(),
                    int(known[ids].sum()),
                    float(logs[ids].sum()),
                    float(logs[ids[codes < vocab.singles]].sum()),
                    [{"word": w, "n": n} for w, n in rare.items()],
                )
                columns[0].append(key)
                key += 1
                for column, value in zip(columns[1:], row, strict=True):
                    column.append(value)
            types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.float64(), pa.float64(), rare_type]
            made = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.record_batch([made[0], batch.column("doc_id"), batch.column("held_out"), *made[1:]], names=names)

    return docs.mapInArrow(run, CODED)


def contexts(codes: list[bytes], start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all tokens of all texts: class, class before, class before that (``start`` if none)."""
    lengths = np.array([len(c) // 2 for c in codes], dtype=np.int64)
    now = np.frombuffer(b"".join(codes), dtype="<u2").astype(np.int64)
    first = np.cumsum(lengths) - lengths
    before, earlier = np.roll(now, 1), np.roll(now, 2)
    before[first] = start
    earlier[first] = start
    second = first[lengths > 1] + 1
    earlier[second] = start
    return now, before, earlier


@dataclass
class LogBilinear:
    vectors: np.ndarray  # of context classes; the last one stands for the time before a text
    near: np.ndarray  # position matrices
    far: np.ndarray
    targets: np.ndarray
    bias: np.ndarray

    FIELDS = ("vectors", "near", "far", "targets", "bias")

    @classmethod
    def start(cls, noise: np.ndarray, width: int = WIDTH) -> LogBilinear:
        """Begins as the unigram model."""
        rng, n = np.random.default_rng(5), len(noise)
        return cls(rng.normal(0, 0.3, (n + 1, width)), np.eye(width), 0.3 * np.eye(width), rng.normal(0, 0.03, (n, width)), np.log(noise))

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, f).ravel() for f in self.FIELDS])

    def filled(self, flat: np.ndarray) -> LogBilinear:
        parts, at = [], 0
        for f in self.FIELDS:
            shape = getattr(self, f).shape
            size = int(np.prod(shape))
            parts.append(flat[at : at + size].reshape(shape).copy())
            at += size
        return LogBilinear(*parts)

    def log_sums(self) -> np.ndarray:
        """Log of the sum over all classes, for each pair (before, earlier)."""
        near, far = self.vectors @ self.near, self.vectors @ self.far
        out = np.empty((len(near), len(far)))
        targets = self.targets.T.astype(np.float32)
        for i, row in enumerate(near):
            scores = (row + far).astype(np.float32) @ targets + self.bias.astype(np.float32)
            top = scores.max(1, keepdims=True)
            out[i] = (top + np.log(np.exp(scores - top).sum(1, keepdims=True, dtype=np.float64)))[:, 0]
        return out


class Trainer:
    """Noise-contrastive steps with adaptive rates on one task's counted trigrams."""

    def __init__(self, model: LogBilinear, noise: np.ndarray, seed: int):
        self.model, self.noise, self.rng = model, noise, np.random.default_rng(seed)
        self.squares = {f: np.full(getattr(model, f).shape, 1e-8) for f in LogBilinear.FIELDS}

    def update(self, name: str, gradient: np.ndarray) -> None:
        self.squares[name] += gradient**2
        getattr(self.model, name)[...] -= RATE * gradient / np.sqrt(self.squares[name])

    def step(self, now: np.ndarray, before: np.ndarray, earlier: np.ndarray, weight: np.ndarray) -> None:
        m, k = self.model, NOISE
        weight = (weight / weight.sum())[:, None]
        drawn = self.rng.choice(len(self.noise), k, p=self.noise)
        a, b = m.vectors[before], m.vectors[earlier]
        predicted = a @ m.near + b @ m.far
        true = (predicted * m.targets[now]).sum(1) + m.bias[now] - np.log(k * self.noise[now])
        false = predicted @ m.targets[drawn].T + m.bias[drawn] - np.log(k * self.noise[drawn])
        up = -weight[:, 0] / (1 + np.exp(np.clip(true, -30, 30)))
        down = weight / (1 + np.exp(-np.clip(false, -30, 30)))
        error = up[:, None] * m.targets[now] + down @ m.targets[drawn]
        targets, bias, vectors = np.zeros_like(m.targets), np.zeros_like(m.bias), np.zeros_like(m.vectors)
        np.add.at(targets, drawn, down.T @ predicted)
        np.add.at(bias, drawn, down.sum(0))
        bias += np.bincount(now, up, len(bias))
        near, far = error @ m.near.T, error @ m.far.T
        pull = up[:, None] * predicted
        for j in range(targets.shape[1]):
            targets[:, j] += np.bincount(now, pull[:, j], len(targets))
            vectors[:, j] = np.bincount(before, near[:, j], len(vectors)) + np.bincount(earlier, far[:, j], len(vectors))
        for name, gradient in (("vectors", vectors), ("near", a.T @ error), ("far", b.T @ error), ("targets", targets), ("bias", bias)):
            self.update(name, gradient)

    def see(self, codes: list[bytes]) -> int:
        """One pass over the trigrams of these texts, each with its count; returns the tokens."""
        n = len(self.noise)
        now, before, earlier = contexts(codes, n)
        keys, counts = np.unique((earlier * (n + 1) + before) * n + now, return_counts=True)
        order = self.rng.permutation(len(keys))
        keys, counts = keys[order], counts[order].astype(float)
        for at in range(0, len(keys), BATCH):
            key = keys[at : at + BATCH]
            self.step(key % n, key // n % (n + 1), key // n // (n + 1), counts[at : at + BATCH])
        return len(now)


def train(coded: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS) -> LogBilinear:
    """Rounds of training by all trainers, each followed by averaging the parameters."""
    noise = vocab.noise()
    model = LogBilinear.start(noise)
    trainers = max(1, -(-vocab.total // TRAINER_TOKENS))
    # rows without id have no other key than their place
    dealt = F.xxhash64(F.coalesce("doc_id", "row_key"))
    source = coded.filter("NOT held_out").select("codes", dealt.alias("dealt")).repartition(trainers, "dealt").select("codes")
    for number in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], model=model, number=number) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(model.filled(model.flat()), noise, seed=1000 * number + TaskContext.get().partitionId())
            seen = 0
            for batch in batches:
                if batch.num_rows:
                    seen += trainer.see(batch.column("codes").to_pylist())
            if seen:
                flat = np.append(trainer.model.flat(), 1.0) * seen
                yield pa.record_batch([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["place", "value"])

        sums = source.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).toPandas()
        if len(sums):
            flat = sums.sort_values("place")["value"].to_numpy()
            model = model.filled(flat[:-1] / flat[-1])
    return model


def score_classes(coded: DataFrame, vocab: Vocabulary, model: LogBilinear) -> DataFrame:
    """``row_key, class_log``: log10 probability of each text's classes, and of one unit of
    count for each token whose class holds several words."""
    near, far, sums = model.vectors @ model.near, model.vectors @ model.far, model.log_sums()
    start, units = len(model.targets), vocab.unit_logs()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for codes in batch.column("codes").to_pylist():
                now, before, earlier = contexts([codes], start)
                total, shares = 0.0, float(units[now].sum())
                for at in range(0, len(now), 1 << 16):
                    c, b, e = (x[at : at + (1 << 16)] for x in (now, before, earlier))
                    total += float((np.einsum("ij,ij->i", near[b] + far[e], model.targets[c]) + model.bias[c] - sums[b, e]).sum())
                out.append(total / np.log(10) + shares)
            yield pa.record_batch([batch.column("row_key"), pa.array(out, pa.float64())], names=["row_key", "class_log"])

    return coded.select("row_key", "codes").mapInArrow(run, "row_key long, class_log double")


def score_texts(docs: DataFrame, held_out: Column, word_classes: int = WORD_CLASSES, hot_words: int = HOT_WORDS, rounds: int = ROUNDS) -> DataFrame:
    """Add-one unigram and model scores of every text; rows with ``held_out`` are not learnt from."""
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    counts = written(count_words(source.filter("NOT held_out")), "word-counts")
    vocab = vocabulary(counts, word_classes, hot_words)
    coded = written(code(source, vocab), "coded")
    model = train(coded, vocab, rounds)
    class_logs = score_classes(coded, vocab, model)
    rare = coded.select("row_key", F.explode("rare").alias("r")).select("row_key", "r.word", "r.n")
    known = rare.join(counts.withColumnRenamed("n", "c"), "word").groupBy("row_key")
    rare_sums = known.agg(F.sum("n").alias("rare_known"), F.sum(F.col("n") * F.log10(F.col("c") + F.lit(1.0))).alias("rare_log"))
    joined = coded.drop("codes", "rare").join(class_logs, "row_key").join(rare_sums, "row_key", "left").fillna(0, ["rare_known", "rare_log"])
    base = F.log10(F.lit(float(vocab.total + vocab.distinct + 1)))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("hot_known") + F.col("rare_known")).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("hot_log") + F.col("rare_log") - F.col("n_tokens") * base).alias("base_score"),
        (F.col("class_log") + F.col("hot_log") - F.col("single_log") + F.col("rare_log")).alias("score"),
    )
