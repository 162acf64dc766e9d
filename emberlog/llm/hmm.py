"""Hidden Markov language model over documents.

Tokens are words (A-Z lowered) and one end token a document. Latent states emit
word classes; a class emits its words:

    P(tokens) = sum over paths of  start * product of  move * emit(state, class) * P(word | class)

A word that makes up at least ``1 / OWN`` of the training tokens is a class of
its own (at most ``OWN`` of them); all others share ``ENDINGS`` classes by a hash
of their ending. P(word | class) is an add-0.1 estimate from the counts of all
training words, one unit kept for words never seen, so the model is a proper
distribution and its statistics grow with the corpus.

Counts. Batches count their words; totals come from a shuffle by word hash, so
the vocabulary is never in one place. Words that make up at least ``1 / SHIPPED``
of all tokens (at most ``SHIPPED``, a million) go to the tasks as one sorted
array; occurrences of rarer words are joined with their counts by hash, and no
such word is frequent enough to be a hot key.

Training. Baum-Welch: every round, tasks run scaled forward and backward
recursions over segments of at most ``SEGMENT`` tokens and add up expected counts
(state moves, state starts, state by class); partial sums meet in a grouped sum
and the driver gets one row per class (at most ``OWN + ENDINGS + 1``). Noise on
the classes' totals breaks the symmetry between states. Every round runs on every
training document, whose classes are written once; rounds go on until the
log-likelihood of the corpus rises by no more than ``GAIN`` of itself. Steps are
lengthened while that raises the likelihood and taken back where it doesn't, so
the same stop is reached in fewer rounds.

Scoring. The scaled forward recursion runs over whole documents; the logarithms
of its scales add up to the exact log-likelihood of the class sequence, to which
the logarithms of P(word | class) are added.

Defined cases: a null or empty text is the end token alone; rows that repeat are
scored alike and trained on as often as they occur; without training documents
all counts are 0 and every score is that of an unseen token; an empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm import kernels as K
from emberlog.session import materialize

STATES, OWN, ENDINGS, ENDING_BYTES = 8, 8192, 2048, 3
SHIPPED, ADD = 1 << 20, 0.1
GAIN, SEGMENT = 1e-5, 512
FIRST_STEP, MORE, LONGEST_STEP = 2.0, 1.5, 3.0
GROUP_TOKENS = 1 << 19
SMOOTH = 0.05
END = np.uint64(0x5851F42D4C957F2D)  # stands for the end token's hash
LOG10 = np.log(10.0)


class Tokens(NamedTuple):
    """Token hashes and ending classes of some documents, end tokens included."""

    hash: np.ndarray
    ending: np.ndarray
    first: np.ndarray


def tokens(column: pa.Array):
    """The tokens of a text column, piece by piece: (first row, end row, Tokens)."""
    data, at = K.text_bytes(column)
    for lo, hi, part, offs in K.pieces(data, at):
        w = K.words(part, offs)
        code = np.zeros(len(w.start), np.uint64)
        for i in range(ENDING_BYTES):
            has = w.end - 1 - i >= w.start
            code[has] = code[has] * np.uint64(257) + K.LOWER[part[w.end[has] - 1 - i]] + np.uint64(1)
        ending = (K.mix(code + K.GOLDEN) % np.uint64(ENDINGS)).astype(np.int32)
        n = np.diff(w.first) + 1
        first = np.concatenate([[0], np.cumsum(n)])
        last = np.zeros(first[-1], bool)
        last[first[1:] - 1] = True
        h, e = np.full(len(last), END), np.full(len(last), ENDINGS, np.int32)
        h[~last], e[~last] = w.hash, ending
        yield lo, hi, Tokens(h, e, first)


def word_counts(docs: DataFrame) -> DataFrame:
    """``h, ending, n``: how often each word occurs."""

    def run(batches):
        for batch in batches:
            for _, _, t in tokens(batch.column("text")):
                h, one, n = np.unique(t.hash, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([K.signed(h), pa.array(t.ending[one]), pa.array(n)], ["h", "ending", "n"])

    counted = docs.select("text").mapInArrow(run, "h long, ending int, n long")
    return materialize(counted.groupBy("h").agg(F.min("ending").alias("ending"), F.sum("n").alias("n")), "counts")


class Vocabulary(NamedTuple):
    """What tasks get: sorted hashes and counts of frequent words, their classes, and the classes' totals."""

    hash: np.ndarray
    count: np.ndarray
    klass: np.ndarray
    rest: np.ndarray  # per ending class, log of its smoothed total
    own: int
    total: int
    distinct: int

    @property
    def classes(self) -> int:
        return self.own + ENDINGS + 1

    def classify(self, t: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(class, place in the frequent words, whether it is one) of every token."""
        if not len(self.hash):
            return self.own + t.ending, np.zeros(len(t.hash), np.int64), np.zeros(len(t.hash), bool)
        place = np.minimum(np.searchsorted(self.hash, t.hash), len(self.hash) - 1)
        known = self.hash[place] == t.hash
        return np.where(known & (self.klass[place] >= 0), self.klass[place], self.own + t.ending), place, known

    def class_totals(self) -> np.ndarray:
        """Tokens of each class, shared classes smoothed."""
        return np.concatenate([self.count[self.klass >= 0].astype(float), np.exp(self.rest)])


def vocabulary(counts: DataFrame) -> Vocabulary:
    row = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    total, distinct = row["n"] or 0, row["v"]
    shipped = counts.where(F.col("n") * SHIPPED >= total).toPandas()  # at most SHIPPED rows
    h = shipped["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(h)
    h, n = h[order], shipped["n"].to_numpy(np.int64)[order]
    own = n * OWN >= total
    klass = np.where(own, np.cumsum(own) - 1, -1).astype(np.int32)
    shared = counts.where(F.col("n") * OWN < total).groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("v")).toPandas()
    rest = np.full(ENDINGS + 1, np.log(ADD))  # a class never seen holds one unseen word
    rest[shared["ending"].to_numpy(np.int64)] = np.log(shared["n"].to_numpy(float) + ADD * (shared["v"].to_numpy(float) + 1))
    return Vocabulary(h, n, klass, rest, int(own.sum()), int(total), int(distinct))


class Model(NamedTuple):
    start: np.ndarray
    again: np.ndarray  # states at the start of a later segment
    move: np.ndarray
    emit: np.ndarray  # class by state


def _normal(x: np.ndarray, axis: int) -> np.ndarray:
    return x / x.sum(axis, keepdims=True)


def first_model(weights: np.ndarray, states: int = STATES) -> Model:
    """Sticky states that emit the classes as often as the corpus has them, times noise."""
    rng = np.random.default_rng(5)
    emit = _normal((weights[:, None] + SMOOTH) * np.exp(rng.normal(0, 0.7, (len(weights), states))), 0)
    move = np.full((states, states), 0.1 / max(states - 1, 1)) + np.eye(states) * (0.9 - 0.1 / max(states - 1, 1))
    even = np.full(states, 1 / states)
    return Model(even, even, _normal(move, 1), emit)


def model_of(start, again, move, emit) -> Model:
    """The model that expected counts make likeliest, smoothed."""
    return Model(_normal(start + 1, 0), _normal(again + 1, 0), _normal(move + 1, 1), _normal(emit + SMOOTH, 0))


def _groups(first: np.ndarray, size: np.ndarray):
    """Sequences in falling length, in groups of about GROUP_TOKENS tokens."""
    order = np.argsort(-size, kind="stable")
    cut = np.searchsorted(np.cumsum(size[order]), np.arange(GROUP_TOKENS, size.sum() + GROUP_TOKENS, GROUP_TOKENS))
    lo = 0
    for hi in np.unique(np.minimum(cut + 1, len(order))):
        if hi > lo:
            yield first[order[lo:hi]], size[order[lo:hi]], order[lo:hi]
            lo = hi


def forward(klass: np.ndarray, first: np.ndarray, size: np.ndarray, model: Model) -> np.ndarray:
    """Natural log-likelihood of each class sequence."""
    out = np.zeros(len(first))
    for at, n, order in _groups(first, size):
        log = np.zeros(len(at))
        alpha = np.broadcast_to(model.start, (len(at), len(model.start)))
        live = len(at)
        alive = np.searchsorted(-n, -np.arange(n[0]), "left")  # sequences longer than t
        for t in range(n[0]):
            live = alive[t]
            alpha = alpha[:live] if t == 0 else alpha[:live] @ model.move
            alpha = alpha * model.emit[klass[at[:live] + t]]
            scale = alpha.sum(1)
            alpha /= scale[:, None]
            log[:live] += np.log(scale)
        out[order] = log
    return out


def expected(klass: np.ndarray, first: np.ndarray, size: np.ndarray, fresh: np.ndarray, model: Model, into: list[np.ndarray]) -> float:
    """Add the expected counts of segments to ``into`` (start, again, move, emit) and return their log-likelihood; ``fresh``: begins a document."""
    states = len(model.start)
    start, again, move, emit = into
    likely = 0.0
    for at, n, order in _groups(first, size):
        alive = np.searchsorted(-n, -np.arange(n[0]), "left")
        offset = np.concatenate([[0], np.cumsum(alive)])
        alphas = np.empty((offset[-1], states), np.float32)
        scales = np.empty(offset[-1], np.float32)
        emits = np.empty((offset[-1], states), np.float32)
        ids = np.empty(offset[-1], np.int32)
        alpha = np.where(fresh[order][:, None], model.start, model.again).astype(np.float32)
        step = model.move.astype(np.float32)
        table = model.emit.astype(np.float32)
        for t in range(n[0]):
            here = slice(offset[t], offset[t + 1])
            ids[here] = klass[at[: alive[t]] + t]
            emits[here] = table[ids[here]]
            alpha = (alpha if t == 0 else alpha[: alive[t]] @ step) * emits[here]
            scale = alpha.sum(1)
            alpha /= scale[:, None]
            alphas[here], scales[here] = alpha, scale
        likely += float(np.log(scales).sum(dtype=np.float64))
        beta = np.ones((alive[-1], states), np.float32)
        for t in range(n[0] - 1, -1, -1):
            here = slice(offset[t], offset[t + 1])
            if len(beta) < alive[t]:
                beta = np.concatenate([beta, np.ones((alive[t] - len(beta), states), np.float32)])
            gamma = alphas[here] * beta
            if t:
                ahead = emits[here] * beta / scales[here, None]
                move += model.move * (alphas[offset[t - 1] : offset[t - 1] + alive[t]].T @ ahead)
                beta = ahead @ step.T
            else:
                start += gamma[fresh[order]].sum(0)
                again += gamma[~fresh[order]].sum(0)
            alphas[here] = gamma
        for s in range(states):
            emit[:, s] += np.bincount(ids, weights=alphas[:, s], minlength=len(emit))
    return likely


def segments(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents cut into runs of at most SEGMENT tokens: (first token, tokens, begins a document)."""
    n = np.diff(first)
    count = -(-n // SEGMENT)
    number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(first[:-1], count) + number * SEGMENT
    return at, np.minimum(SEGMENT, np.repeat(first[1:], count) - at), number == 0


def _zeros(states: int, classes: int) -> list[np.ndarray]:
    return [np.zeros(states), np.zeros(states), np.zeros((states, states)), np.zeros((classes, states))]


def class_rows(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """``classes``: the token classes of each document as 16-bit numbers."""
    book = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches):
        for batch in batches:
            for _, _, t in tokens(batch.column("text")):
                klass = book.value.classify(t)[0].astype(np.int16)  # classes are far fewer than 2^15
                buffers = [None, pa.py_buffer((2 * t.first).astype(np.int32)), pa.py_buffer(klass)]
                yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(t.first) - 1, buffers)], ["classes"])

    return materialize(docs.select("text").mapInArrow(run, "classes binary"), "classes")


def baum_welch_round(rows: DataFrame, words: Vocabulary, model: Model) -> tuple[Model, float]:
    """One round over all ``class_rows``: expected counts by task, summed by class; also the log-likelihood under ``model``."""
    states, classes = len(model.start), words.classes
    given = rows.sparkSession.sparkContext.broadcast(model)
    names = [f"s{i}" for i in range(states)]

    def run(batches):
        into, likely = _zeros(states, classes), 0.0
        for batch in batches:
            column = batch.column("classes").cast(pa.large_binary())
            _, offsets, data = column.buffers()
            at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
            for _, _, part, offs in K.pieces(np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]):
                likely += expected(part.view(np.int16), *segments(offs // 2), given.value, into)
        # rows: classes, then moves, start, later starts, likelihood
        rows = np.concatenate([into[3], into[2], into[0][None], into[1][None], np.full((1, states), likely)])
        some = np.flatnonzero(rows.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some), *[pa.array(rows[some, s]) for s in range(states)]], ["row", *names])

    sums = rows.mapInArrow(run, "row long, " + ", ".join(f"{n} double" for n in names))
    table = sums.groupBy("row").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    given.unpersist()
    out = np.zeros((classes + states + 3, states))
    out[table["row"].to_numpy()] = table[names].to_numpy()
    return model_of(out[-3], out[-2], out[classes:-3], out[:classes]), float(out[-1, 0])


def relaxed(old: Model, new: Model, step: float) -> Model:
    """The model ``step`` times as far from ``old`` as ``new`` is, along the line of their logarithms."""
    parts = []
    for before, after, axis in zip(old, new, (0, 0, 1, 0)):
        x = np.log(after) + (step - 1) * (np.log(after) - np.log(before))
        parts.append(_normal(np.exp(x - x.max(axis, keepdims=True)), axis))
    return Model(*parts)


def train(docs: DataFrame, words: Vocabulary, states: int = STATES, gain: float = GAIN) -> Model:
    """Rounds over all of ``docs`` until a plain one raises the log-likelihood by no more than ``gain`` of itself.

    Steps are lengthened (``relaxed``) while they pay. A step that lowers the
    likelihood is taken back for the plain step in its place. (Smoothing may let
    even that one lower it a little; then rounds end.)
    """
    model, last = first_model(words.class_totals(), states), -np.inf
    if not words.total:
        return model
    rows = class_rows(docs, words)
    plain, step, reach = model, 1.0, FIRST_STEP
    while True:
        raised, likely = baum_welch_round(rows, words, model)
        if likely < last and step > 1:
            model, step, reach = plain, 1.0, max(1.0, reach / MORE**2)
            continue
        small = likely - last <= gain * abs(likely)
        if small and step == 1:
            return raised
        last, plain = likely, raised
        step, reach = (1.0, reach) if small else (reach, min(reach * MORE, LONGEST_STEP))
        model = relaxed(model, raised, step) if step > 1 else raised


SCORED = ("row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, h long, times long")


def _score_rows(batches, words: Vocabulary, model: Model):
    """A row per document with all that frequent words decide, and a row per rare word of a document."""
    log_count = np.log10(words.count + ADD)
    unit = -words.rest / LOG10  # per ending class, what its total takes from log10 P(word | class)
    for batch in batches:
        rows, ids, held = batch.column("row").to_numpy(), batch.column("doc_id"), batch.column("held_out")
        done, klasses, firsts = [], [], [np.zeros(1, np.int64)]
        for lo, hi, t in tokens(batch.column("text")):
            klass, place, known = words.classify(t)
            shared = klass >= words.own
            inside = np.zeros(len(klass))
            inside[shared] = unit[klass[shared] - words.own]
            inside[shared & known] += log_count[place[shared & known]]
            base = np.where(known, log_count[place] if len(log_count) else 0.0, 0.0)
            n = np.diff(t.first)
            done.append((n, K.sums_by_row(known.astype(np.int64), t.first), K.sums_by_row(base, t.first), K.sums_by_row(inside, t.first)))
            klasses.append(klass.astype(np.int32))
            firsts.append(t.first[1:] + firsts[-1][-1])
            doc = np.repeat(rows[lo:hi], n)[~known]
            if len(doc):
                rare = t.hash[~known]
                order = np.lexsort((rare, doc))
                doc, rare = doc[order], rare[order]
                new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (rare[1:] != rare[:-1])])
                times = np.diff(np.concatenate([np.flatnonzero(new), [len(doc)]]))
                doc, rare = doc[new], rare[new]
                none = lambda kind: pa.nulls(len(doc), kind)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc), none(pa.int64()), none(pa.bool_()), none(pa.int64()), none(pa.int64()), none(pa.float64()), none(pa.float64()),
                     K.signed(rare), pa.array(times)], [c.split()[0] for c in SCORED.split(", ")])
        if not done:
            continue
        n, known, base, inside = (np.concatenate(c) for c in zip(*done))
        first = np.concatenate(firsts)
        likely = forward(np.concatenate(klasses), first[:-1], n, model) / LOG10
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows), ids, held, pa.array(n), pa.array(known), pa.array(base), pa.array(likely + inside),
             K.signed(K.mix(rows.view(np.uint64) + K.GOLDEN)), pa.array(np.zeros(len(rows), np.int64))], [c.split()[0] for c in SCORED.split(", ")])


def score(docs: DataFrame, held_out: Column, **how) -> DataFrame:
    """Train on the rows that ``held_out`` leaves and score all rows of ``docs`` (``doc_id, text``).

    Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out.alias("held_out"))
    seen = rows.where(~F.col("held_out"))
    counts = word_counts(seen)
    words = vocabulary(counts)
    model = train(seen, words, **how)
    context = docs.sparkSession.sparkContext
    book, given = context.broadcast(words), context.broadcast(model)
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    parts = numbered.mapInArrow(lambda b: _score_rows(b, book.value, given.value), SCORED)
    rare = counts.where(F.col("n") * SHIPPED < words.total).select(F.col("h").alias("of"), "n")
    # a document's own row has a hash of its row number for a key, so these rows spread too
    parts = parts.join(rare, F.col("h") == F.col("of"), "left")
    log_rare = F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(ADD))
    sums = parts.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        (F.sum("n_known") + F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0))).alias("n_known"),
        F.sum("base").alias("base"), F.sum("score").alias("inner"), F.sum(log_rare).alias("rare"))
    unit = float(np.log10(words.total + ADD * (words.distinct + 1)))
    return sums.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(words.total).cast("long").alias("train_tokens"),
                       (F.col("base") + F.col("rare") - F.col("n_tokens") * unit).alias("base_score"), (F.col("inner") + F.col("rare")).alias("score"))
