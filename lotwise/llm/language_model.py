"""Scores of whole texts by a log-bilinear neural model trained with noise-contrastive estimation.

Tokens are lower-cased words plus one end.  Every training token is counted.  The most
frequent words are units of their own; all other words, seen or not, share a unit with the
words of the same ending, and stand in it with their smoothed share of its count, so the
probabilities of all words and of any unseen one sum to one.  There are as many units as the
square root of the number of distinct training words, and ``UNITS`` at least, so the model
resolves more words as the corpus grows.  It predicts the unit of a token from the units of the
``CONTEXT`` tokens before it in two steps: the block of units next to one another in frequency,
then the unit in the block.  In either, the sum of one vector per place is multiplied with a vector of
the block or unit, plus a bias; blocks are as wide as there are blocks.

Training reads all training tokens once, in ``ROUNDS`` rounds.  In a round each task goes
through its part in mini-batches (numpy, Adagrad): the true blocks and units against ``NOISE``
draws each from the frequencies, so no normalisation is needed.  The draws' part of a gradient is not
sampled but summed over all that can be drawn, each as often as the draws take it on average.
Tasks send back their parameters, as many bytes as the units ask for; these are averaged by tokens in a
tree of groups of ``FAN`` at most and start the next round.  Scoring normalises exactly, over all
blocks and over all units of the true block, by batched matrix products.

What grows with the corpus stays in tables: counts of all words, texts as unit numbers, and the
join of rarer words with their counts.  The driver and the tasks hold the parameters (800 bytes a
unit) and at most ``HEAD`` frequent words.

Defined results: a null or wordless text is a single end; a row without an id isn't held
out; repeated rows score the same and count as often as they stand there; without training
rows every unit is equally likely; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.base import landed, query, table

HEAD = 1 << 17
OWN, ENDINGS = 400, 111
UNITS = 1 + OWN + ENDINGS  # of a small corpus; unit 0: the end of a text; also what stands before its first token
MOST_UNITS = (1 << 16) - 1  # a unit is two bytes; reached at 4.3 * 10^9 distinct words
CONTEXT, SIZE = 3, 24
BATCH, NOISE, RATE, ROUNDS, FAN, SEED = 4096, 64, 0.15, 3, 32, 17
AVERAGED = 1 << 26  # bytes of parameters that are averaged at a time
SCORED = 8192  # tokens whose logits are held at a time
FLUSH = 1 << 20  # distinct words a task holds before it passes their counts on


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def unit_counts(types: int) -> tuple[int, int]:
    """Frequent words and endings that are units, for so many distinct training words."""
    units = min(max(UNITS, math.isqrt(types)), MOST_UNITS)
    endings = units * ENDINGS // UNITS
    return units - 1 - endings, endings


def ending_unit(word: bytes, own: int, endings: int) -> int:
    import xxhash

    return 1 + own + xxhash.xxh64_intdigest(word[-3:]) % endings


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[bytes] = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "c"])

    for b in batches:
        for t in b.column(0).cast(pa.binary()).to_pylist():
            seen.update((t or b"").lower().split())
            if len(seen) > FLUSH:
                yield out()
                seen.clear()
    yield out()


@dataclass
class Vocabulary:
    """Frequent words with their unit, and what the smoothing needs; a bounded number of rows."""

    words: list[bytes]
    counts: np.ndarray
    tokens: int  # N
    types: int  # V
    ends: int
    n_own: int  # units that are one word
    n_endings: int
    unit_tokens: np.ndarray  # of the words that share a unit
    unit_types: np.ndarray

    def __post_init__(self):
        order = np.lexsort((np.arange(len(self.words)), -self.counts))
        self.units = 1 + self.n_own + self.n_endings
        self.own = {self.words[i]: 1 + n for n, i in enumerate(order[:self.n_own])}
        self.index = {w: i for i, w in enumerate(self.words)}
        self.unit = np.array([self.own.get(w) or self.ending(w) for w in self.words] + [0], dtype=np.uint16)
        self.base = np.log10((np.append(self.counts, self.ends) + 1.0) / (self.tokens + self.types + 1.0))
        shared = self.unit > self.n_own
        self.total = np.log10(self.unit_tokens + self.unit_types + 1.0)
        self.inside = np.where(shared, np.log10(np.append(self.counts, 0) + 1.0) - self.total[self.unit], 0.0)

    def ending(self, word: bytes) -> int:
        return ending_unit(word, self.n_own, self.n_endings)


def vocabulary(counts: DataFrame, ends: int) -> Vocabulary:
    """counts (word, c) of all training words -> the words frequent enough that at most HEAD are."""
    step = F.floor(F.log2("c") * 64).cast("int")  # counts in steps of about one per cent
    bins = sorted(((r.step, r.n) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()), reverse=True)
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    room, least = HEAD, 1 << 30
    for at, n in bins:
        if n > room:
            break
        room, least = room - n, at
    head = counts.where(step >= least).orderBy("word").toArrow()
    n_own, n_endings = unit_counts(total[1])
    units = 1 + n_own + n_endings
    v = Vocabulary(head["word"].to_pylist(), head["c"].to_numpy().astype(np.int64), total[0] + ends, total[1] + (ends > 0), ends,
                   n_own, n_endings, np.zeros(units), np.zeros(units))
    own = counts.sparkSession.sparkContext.broadcast(set(v.own))

    def shares(batches):
        sums = np.zeros((2, units), dtype=np.int64)
        for b in batches:
            words = b.column(0).to_pylist()
            unit = np.fromiter((0 if w in own.value else ending_unit(w, n_own, n_endings) for w in words), np.int64, len(words))
            sums[0] += np.bincount(unit, weights=b.column(1).to_numpy(), minlength=units).astype(np.int64)
            sums[1] += np.bincount(unit, minlength=units)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(units, dtype=np.int32)), pa.array(sums[0]), pa.array(sums[1])], names=["unit", "c", "n"])

    for r in counts.mapInArrow(shares, "unit int, c long, n long").where("unit > 0").groupBy("unit").agg(F.sum("c").alias("c"), F.sum("n").alias("n")).collect():
        v.unit_tokens[r.unit], v.unit_types[r.unit] = r.c, r.n
    return replace(v)  # works out the shares inside the units from the totals just read


def _coded(vocab):
    """Texts as unit numbers, with what is known without the counts of rarer words, and these as (word, times)."""
    rare_type = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = vocab.value
        end = len(v.words)
        for b in batches:
            units, counts, known, base, inside, rare = [], [], [], [], [], []
            for t in b.column("_text").cast(pa.binary()).to_pylist():
                words = (t or b"").lower().split()
                at = np.fromiter(map(v.index.get, words, repeat(-1)), np.int64, len(words))
                unknown = np.flatnonzero(at < 0)
                unit = v.unit[at]
                times = Counter(words[i] for i in unknown)
                of = {w: v.ending(w) for w in times}
                unit[unknown] = [of[words[i]] for i in unknown]
                found = np.append(at[at >= 0], end)
                units.append(np.append(unit, 0).astype("<u2").tobytes())
                counts.append(len(words) + 1)
                known.append(int((at >= 0).sum()) + (v.ends > 0))
                base.append(float(v.base[found].sum()))
                inside.append(float(v.inside[found].sum() - v.total[unit[unknown]].sum()))
                rare.append([{"word": w, "times": n} for w, n in times.items()])
            new = {"units": pa.array(units, pa.binary()), "n_tokens": pa.array(counts, pa.int64()), "known": pa.array(known, pa.int64()),
                   "base": pa.array(base), "inside": pa.array(inside), "rare": pa.array(rare, rare_type)}
            keep = [i for i, c in enumerate(b.schema.names) if c != "_text"]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in keep] + list(new.values()), names=[b.schema.names[i] for i in keep] + list(new))
    return run


class LogBilinear:
    """Place vectors P (CONTEXT, units, SIZE); T of the units in their blocks and C of the blocks (vectors, and last the bias); Adagrad sums of all."""

    def __init__(self, blob: bytes | None = None, shares: np.ndarray | None = None, units: int = 0):
        self.units = units = units or len(shares)
        self.width = math.isqrt(units - 1) + 1  # units in a block
        self.starts = np.arange(0, units, self.width)
        shapes = ((CONTEXT, units, SIZE), (units, SIZE + 1), (len(self.starts), SIZE + 1))
        sizes = [int(np.prod(s)) for s in shapes]
        if blob is None:
            rng = np.random.default_rng(SEED)
            self.flat = np.concatenate([*(rng.normal(0, 0.1, n) for n in sizes), np.full(sum(sizes), 1e-2)]).astype(np.float32)
        else:
            self.flat = np.frombuffer(blob, dtype=np.float32).copy()
        parts = np.split(self.flat, np.cumsum(sizes * 2)[:-1])
        (self.p, self.t, self.c), (self.gp, self.gt, self.gc) = ([x.reshape(s) for x, s in zip(part, shapes)] for part in (parts[:3], parts[3:]))
        if blob is None:
            of_block, in_block = self._shares(shares)
            self.t[:, SIZE], self.c[:, SIZE] = np.log(in_block), np.log(of_block)

    def blob(self) -> bytes:
        return self.flat.tobytes()

    def _shares(self, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shares of the blocks, and of each unit in its block."""
        of_block = np.add.reduceat(shares, self.starts)
        return of_block, shares / np.repeat(of_block, self.width)[:self.units]

    def _sorted(self, contexts: np.ndarray, units: np.ndarray) -> tuple:
        """The order of the units, contexts and units in it, the sums of the places' vectors and a one, and of each block its rows and units."""
        order = np.argsort(units.astype(np.uint16), kind="stable")
        contexts, units = contexts[:, order], units[order]
        q = np.ones((len(units), SIZE + 1), dtype=np.float32)
        q[:, :SIZE] = self.p[0][contexts[0]]
        for i in range(1, CONTEXT):
            q[:, :SIZE] += self.p[i][contexts[i]]
        at = np.append(np.searchsorted(units, self.starts), len(units)).tolist()
        blocks = [(slice(a, b), slice(k * self.width, (k + 1) * self.width)) for k, (a, b) in enumerate(zip(at, at[1:])) if a < b]
        return order, contexts, units, q, blocks

    def learn(self, contexts: np.ndarray, units: np.ndarray, shares: np.ndarray, rng: np.random.Generator | None = None):
        """One mini-batch: contexts (CONTEXT, n) and the units that follow, against ``shares``; nothing is left to chance."""
        _, contexts, units, q, blocks = self._sorted(contexts, units)
        block_noise, unit_noise = ((x * NOISE).astype(np.float32) for x in self._shares(shares))
        block_away, unit_away = -self.c, -self.t
        block_away[:, SIZE] += np.log(block_noise)
        unit_away[:, SIZE] += np.log(unit_noise)
        block_noise /= len(units)
        unit_noise /= len(units)
        places, n = np.arange(len(units)), len(units)
        of = units // self.width
        gt, inside = np.zeros_like(self.t), units - of * self.width
        with np.errstate(over="ignore"):  # then the share is none
            gq, gc = _contrast(q, (places, of), self.c, block_away, block_noise, n)
            for rows, own in blocks:
                more, gt[own] = _contrast(q[rows], (places[:rows.stop - rows.start], inside[rows]), self.t[own], unit_away[own], unit_noise[own], n)
                gq[rows] += more
        gq = np.ascontiguousarray(gq[:, :SIZE])
        for i, c in enumerate(contexts):
            at, grad = _scatter(c, gq, self.units)
            squares = self.gp[i][at] + grad * grad
            self.gp[i][at] = squares
            self.p[i][at] -= RATE * grad / np.sqrt(squares)
        for value, squares, grad in ((self.t, self.gt, gt), (self.c, self.gc, gc)):
            squares += grad * grad
            grad *= RATE
            grad /= np.sqrt(squares)
            value -= grad

    def log10(self, contexts: np.ndarray, units: np.ndarray) -> np.ndarray:
        """Normalised log10 probabilities of the units after their contexts."""
        order, _, units, q, blocks = self._sorted(contexts, units)
        out = _log_share(q, units // self.width, self.c)
        for rows, own in blocks:
            out[rows] += _log_share(q[rows], units[rows] - own.start, self.t[own])
        back = np.empty(len(units))
        back[order] = out / np.log(10)
        return back


def _contrast(q: np.ndarray, own: tuple, vectors: np.ndarray, away: np.ndarray, noise: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Gradients by q and vectors of telling ``own`` from the mean of the draws, over n tokens; ``noise``: draws of each value by n, ``away``: their logarithm less the vectors."""
    up = q @ away.T
    np.exp(up, out=up)
    up += 1
    np.divide(noise, up, out=up)
    true = up[own]
    up[own] = true + true / (noise[own[1]] * n) - np.float32(1 / n)
    return up @ vectors, up.T @ q


def _log_share(q: np.ndarray, own: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Logarithm of the share of ``own`` in the exponentials of the products with all vectors."""
    logits = q @ vectors.T
    out, shift = logits[np.arange(len(q)), own].astype(np.float64), 0.0
    if logits.max(initial=0) > 60 or logits.min(initial=0) < -60:  # keeps the sums in range
        shift = logits.max(axis=1, keepdims=True)
        logits -= shift
        shift = shift[:, 0]
    np.exp(logits, out=logits)
    return out - shift - np.log((logits @ np.ones(len(vectors), dtype=np.float32)).astype(np.float64))


def _scatter(at: np.ndarray, rows: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray]:
    """The different units, and the sums of their rows."""
    there = np.zeros(units, dtype=bool)
    there[at] = True
    found = np.flatnonzero(there)
    flat = ((np.cumsum(there) - 1)[at][:, None] * SIZE + np.arange(SIZE)).ravel()
    return found, np.bincount(flat, weights=rows.ravel(), minlength=len(found) * SIZE).reshape(-1, SIZE).astype(np.float32)


def _sequences(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts as unit bytes -> (contexts, units, text number) of whole texts, some batches' worth at a time."""
    blobs, start = column.to_pylist(), 0
    while start < len(blobs):
        stop, size = start, 0
        while stop < len(blobs) and (size < 16 * BATCH or stop == start):
            size += len(blobs[stop]) // 2
            stop += 1
        counts = np.fromiter((len(x) // 2 for x in blobs[start:stop]), np.int64, stop - start)
        units = np.frombuffer(b"".join(blobs[start:stop]), dtype="<u2").astype(np.int64)
        place = np.arange(len(units)) - np.repeat(np.cumsum(counts) - counts, counts)
        contexts = np.zeros((CONTEXT, len(units)), dtype=np.int64)
        for i in range(CONTEXT):
            back = i + 1
            contexts[i, back:] = np.where(place[back:] >= back, units[:-back] if len(units) > back else units[:0], 0)
        yield contexts, units, np.repeat(np.arange(start, stop), counts)
        start = stop


def _train(model, shares, round_: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId()
        m, p, tokens = LogBilinear(model.value, shares.value), shares.value, 0
        rng = np.random.default_rng([SEED, round_, at])
        for b in batches:
            for contexts, units, _ in _sequences(b.column(0)):
                order = rng.permutation(len(units))
                for i in range(0, len(order), BATCH):
                    chosen = order[i:i + BATCH]
                    m.learn(contexts[:, chosen], units[chosen], p, rng)
                tokens += len(units)
        if tokens:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([float(tokens)]), pa.array([m.blob()], pa.binary())],
                                             names=["node", "weight", "model"])
    return run


def _average(fan: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        weight = rows["weight"].sum()
        mean = sum(np.frombuffer(m, dtype=np.float32).astype(np.float64) * (w / weight) for m, w in zip(rows["model"], rows["weight"]))
        return pd.DataFrame({"node": [int(rows["node"].iloc[0]) // fan], "weight": [weight], "model": [mean.astype(np.float32).tobytes()]})
    return run


def train(coded: DataFrame, shares: np.ndarray) -> LogBilinear:
    """coded (units, part) of the training texts -> the model after one pass over all their tokens."""
    spark = coded.sparkSession
    blob = LogBilinear(shares=shares).blob()
    noise = spark.sparkContext.broadcast(shares)
    fan = max(2, min(FAN, AVERAGED // len(blob)))
    for r in range(ROUNDS):
        rows = coded.where(F.col("part") == r).select("units")
        models = landed(rows.mapInArrow(_train(spark.sparkContext.broadcast(blob), noise, r), "node long, weight double, model binary"), "models")
        while (left := models.count()) > 1:
            models = landed(models.groupBy(F.expr(f"node div {fan}").alias("_g")).applyInPandas(_average(fan), "node long, weight double, model binary"), "models")
        if left:
            blob = bytes(models.first().model)
    return LogBilinear(blob, shares)


def _scores(model, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = LogBilinear(model.value, units=size)
        for b in batches:
            i = b.schema.get_field_index("units")
            sums = np.zeros(b.num_rows)
            for contexts, units, text in _sequences(b.column(i)):
                for a in range(0, len(units), SCORED):
                    part = slice(a, a + SCORED)
                    sums += np.bincount(text[part], weights=m.log10(contexts[:, part], units[part]), minlength=b.num_rows)
            keep = [j for j in range(b.num_columns) if j != i]
            yield pa.RecordBatch.from_arrays([b.column(j) for j in keep] + [pa.array(sums)], names=[b.schema.names[j] for j in keep] + ["unit_score"])
    return run


def score(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, held_out) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows that aren't held out.
    """
    spark = docs.sparkSession
    learned = docs.where("NOT held_out")
    counts = landed(learned.select("text").mapInArrow(_counts, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")), "words")
    v = vocabulary(counts, learned.count())
    shared = spark.sparkContext.broadcast(v)
    types = "doc_id long, held_out boolean, part int, rid long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out",
                       F.pmod(F.xxhash64("text"), F.lit(ROUNDS)).cast("int").alias("part"), F.monotonically_increasing_id().alias("rid"),
                       F.col("text").alias("_text"))
    coded = landed(rows.mapInArrow(_coded(shared), types + ", units binary, n_tokens long, known long, base double, inside double, "
                                   "rare array<struct<word: binary, times: int>>"), "coded")
    shares = np.bincount(v.unit[:-1], weights=v.counts, minlength=v.units)
    shares[1 + v.n_own:] = v.unit_tokens[1 + v.n_own:]
    shares[0] = v.ends
    shares = (shares + 1) / (shares + 1).sum()
    model = spark.sparkContext.broadcast(train(coded.where("NOT held_out"), shares).blob())
    plain = (coded.select("doc_id", "held_out", "rid", "n_tokens", "known", "base", "inside", "units")
             .mapInArrow(_scores(model, v.units), "doc_id long, held_out boolean, rid long, n_tokens long, known long, base double, inside double, unit_score double"))
    rare = coded.select("rid", F.explode("rare").alias("r")).select("rid", "r.word", "r.times")
    c = F.coalesce("c", F.lit(0))
    sums = (rare.join(counts, "word", "left")
            .groupBy("rid").agg(F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rare_known"),
                                F.sum(F.col("times") * F.log10((c + 1) / F.lit(float(v.tokens + v.types + 1)))).alias("rare_base"),
                                F.sum(F.col("times") * F.log10(c + 1)).alias("rare_inside")))
    zero = F.lit(0.0)
    return (plain.join(sums, "rid", "left")
            .select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
                    F.lit(v.tokens).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("rare_base", zero)).alias("base_score"),
                    (F.col("unit_score") + F.col("inside") + F.coalesce("rare_inside", zero)).alias("score")))


@query("op2_language_model")
def op2_language_model(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents").select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")))
