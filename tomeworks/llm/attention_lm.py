"""Language-model scores: a small causal self-attention model next to a word model.

Two models score a text.

* The base model counts words.  The counts are exact and cover all training
  documents: summed in tasks, then by word.  The HOT most frequent words go to
  every task; the rare words of a document meet their counts in a join, so the vocabulary may grow with the corpus.
* The attention model sees subword ids: each word, with a leading space, is encoded by a public byte-level BPE.  Input:
  an embedding of the id (the most frequent ids have their own, others share) and of the place in the window.  One layer of causal
  attention with a residual path gives the probabilities of CLASSES classes of ids;
  inside a class an id has its share of the corpus, counted over all training
  documents.  So every id has a probability and they add up to one.

Training is plain numpy in tasks, over all training documents: every one of them takes part in one of ROUNDS rounds, in
more while there are few (at most REPEATED documents are read in addition).  In a round, groups of about GROUP / ROUNDS documents start
from the same weights and take their Adam steps, one chunk of about CHUNK ids after the other, so a task's memory is bounded; there are
TRAINERS groups or more, in proportion to the documents.  Then the weights are averaged: partial sums in tasks, their square root in
number, meet on the driver.  Groups and order follow from the documents, so sums run in a fixed order.

Training cuts a text into windows of CONTEXT inputs side by side.  Scoring cuts it into windows that overlap; each token is
scored once, where it has at least CONTEXT - STRIDE inputs before it (or all there are).  Windows
of many texts are one masked batch.  Whole texts are scored.

Null texts are empty: they consist of one end token.  Rows are scored by
themselves, so repeated rows get the same scores; a null doc_id is never held
out.  Without training documents all classes are equally likely.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeworks.llm import bpe
from tomeworks.llm.common import doc_key, documents, query
from tomeworks.llm.language_id import held_out
from tomeworks.staging import stage

HOT = 200_000
CLASSES = 64
OWN_EMBEDDINGS, SHARED_EMBEDDINGS = 3072, 1024
WIDTH = 16
CONTEXT, STRIDE = 64, 32
TRAINERS, ROUNDS, BATCH, STEPS, RATE = 6, 3, 32, 100, 0.01
GROUP, CHUNK, REPEATED = 50_000, 1 << 18, 4_000
_FLUSH = 300_000
_REMEMBERED = 600_000
_BLOCK = 128
_SHAPES = {
    "E": (OWN_EMBEDDINGS + SHARED_EMBEDDINGS + 1, WIDTH),
    "P": (CONTEXT, WIDTH),
    "Q": (WIDTH, WIDTH),
    "K": (WIDTH, WIDTH),
    "V": (WIDTH, WIDTH),
    "O": (WIDTH, WIDTH),
    "U": (WIDTH, CLASSES),
    "b": (CLASSES,),
}
Weights = dict[str, np.ndarray]


# --- counting ------------------------------------------------------------------


def words_of(text: str | None) -> list[bytes]:
    """bytes.lower() folds A-Z and bytes.split() cuts at the six blanks, nothing else."""
    return (text or "").encode(errors="replace").lower().split()


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter: Counter = Counter()

    def flushed() -> pa.RecordBatch:
        made = [pa.array(list(counter), pa.binary()), pa.array(list(counter.values()), pa.int64())]
        counter.clear()
        return pa.RecordBatch.from_arrays(made, names=["word", "n"])

    for batch in batches:
        for text in batch.column("text"):
            counter.update(words_of(text.as_py()))
            if len(counter) >= _FLUSH:
                yield flushed()
    yield flushed()


def word_counts(training: DataFrame) -> DataFrame:
    """(word, n) over all training documents, staged."""
    rows = training.select("text").mapInArrow(_word_counts, "word binary, n bigint")
    return stage(rows.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def _id_counts(shared, n_ids: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, total = shared.value.encode, np.zeros(n_ids)
        for batch in batches:
            ids = [encode(" " + word.decode(errors="replace")) for word in batch.column("word").to_pylist()]
            if ids:
                times = np.repeat(batch.column("n").to_numpy(), [len(x) for x in ids])
                total += np.bincount(np.concatenate(ids), times, n_ids)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at].astype(np.int64))], names=["id", "n"])

    return count


# --- the model -----------------------------------------------------------------


class Classes:
    """Class, embedding and log share of every id; the last id is the end of the text."""

    def __init__(self, counts: np.ndarray):
        order = np.lexsort((np.arange(len(counts)), -counts))
        mass = np.cumsum((counts + 0.5)[order])
        self.of = np.zeros(len(counts), np.int32)
        self.of[order] = np.minimum((CLASSES * (mass - (counts + 0.5)[order]) / mass[-1]).astype(np.int32), CLASSES - 1)
        totals = np.bincount(self.of, counts + 0.5, CLASSES)
        self.log_share = np.log((counts + 0.5) / totals[self.of])
        self.input = np.zeros(len(counts) + 1, np.int32)  # one more: the start of the text
        place = np.zeros(len(counts), np.int64)
        place[order] = np.arange(len(counts))
        self.input[:-1] = np.where(place < OWN_EMBEDDINGS, place, OWN_EMBEDDINGS + place % SHARED_EMBEDDINGS)
        self.input[-1] = OWN_EMBEDDINGS + SHARED_EMBEDDINGS


def first_weights() -> Weights:
    rng = np.random.default_rng(7)
    weights = {name: (rng.standard_normal(shape) * 0.2).astype(np.float32) for name, shape in _SHAPES.items()}
    weights["b"][:] = 0
    return weights


_MOST = np.float32(60)
_SHOWN = np.tril(np.ones((CONTEXT, CONTEXT), np.float32))  # what is there so far
_HIDDEN = np.triu(np.full((CONTEXT, CONTEXT), -1e9, np.float32), 1)  # what comes later


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def gradients(w: Weights, inputs: np.ndarray, classes: np.ndarray, scored: np.ndarray) -> tuple[float, Weights]:
    """Mean loss over the scored places of a batch of windows, and its gradient."""
    e = w["E"][inputs]
    x = e + w["P"]
    q, k, v = x @ w["Q"], x @ w["K"], x @ w["V"]
    scale = np.float32(WIDTH**-0.5)
    a = _softmax(q @ k.swapaxes(1, 2) * scale + _HIDDEN)
    h = a @ v
    o = h @ w["O"] + e
    p = _softmax(o @ w["U"] + w["b"])
    n = max(1, int(scored.sum()))
    right = np.take_along_axis(p, classes[..., None], axis=2)[..., 0]
    loss = float(-(np.log(right + 1e-30) * scored).sum() / n)
    d = p
    np.put_along_axis(d, classes[..., None], (right - 1)[..., None], axis=2)
    d *= (scored / np.float32(n))[..., None].astype(np.float32)
    flat = lambda z: z.reshape(-1, z.shape[-1])
    g = {"U": flat(o).T @ flat(d), "b": flat(d).sum(axis=0)}
    do = d @ w["U"].T
    g["O"] = flat(h).T @ flat(do)
    dh = do @ w["O"].T
    da, dv = dh @ v.swapaxes(1, 2), a.swapaxes(1, 2) @ dh
    ds = a * (da - (da * a).sum(axis=-1, keepdims=True)) * scale
    dq, dk = ds @ k, ds.swapaxes(1, 2) @ q
    for name, part in (("Q", dq), ("K", dk), ("V", dv)):
        g[name] = flat(x).T @ flat(part)
    dx = dq @ w["Q"].T + dk @ w["K"].T + dv @ w["V"].T
    g["P"] = dx.sum(axis=0)
    g["E"] = np.zeros_like(w["E"])
    np.add.at(g["E"], inputs.ravel(), flat(do + dx))
    return loss, g


def cut(sizes: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first place in the text, places scored before it) of every window, for texts of these sizes.

    The first window scores all its places, the later ones their last ``stride``.
    """
    many = 1 + np.maximum(0, -(-(sizes - CONTEXT) // stride))
    text = np.repeat(np.arange(len(sizes)), many)
    number = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    return text, number * stride, np.where(number > 0, CONTEXT - stride, 0)


def batches_of(ids: list[np.ndarray], classes: Classes, stride: int = STRIDE) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks of windows: (text, inputs, targets, scored); every target is scored in one of them."""
    sizes = np.array([len(x) + 1 for x in ids])
    end = len(classes.of) - 1
    offsets = np.cumsum(sizes) - sizes
    targets = np.full(int(sizes.sum()), end, np.int32)
    inputs = np.full(int(sizes.sum()), len(classes.of), np.int32)
    for x, at in zip(ids, offsets):
        targets[at : at + len(x)] = x
        inputs[at + 1 : at + 1 + len(x)] = x
    inputs = classes.input[inputs]
    text, first, skip = cut(sizes, stride)
    for at in range(0, len(text), _BLOCK):
        t, f, s = text[at : at + _BLOCK], first[at : at + _BLOCK, None], skip[at : at + _BLOCK, None]
        place = f + np.arange(CONTEXT)
        last = sizes[t][:, None] - 1
        flat = offsets[t][:, None] + np.minimum(place, last)
        yield t, inputs[flat], targets[flat], (place <= last) & (place - f >= s)


class Trainer:
    """Adam steps from given weights, over one chunk of texts after the other."""

    def __init__(self, w: Weights, classes: Classes, seed: int):
        self.w, self.classes = {k: v.copy() for k, v in w.items()}, classes
        self.rng, self.step = np.random.default_rng(seed), 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))

    def learn(self, ids: list[np.ndarray]) -> None:
        """One pass over the windows in random order; more of them until there have been at least STEPS steps."""
        parts = list(batches_of(ids, self.classes, CONTEXT)) if ids else []
        if not parts:
            return
        inputs, targets, scored = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
        passed = False
        while not passed or self.step < STEPS:
            order = self.rng.permutation(len(inputs))
            for at in range(0, len(order), BATCH):
                own = order[at : at + BATCH]
                self._take(gradients(self.w, inputs[own], self.classes.of[targets[own]], scored[own])[1])
            passed = True

    def _take(self, g: Weights) -> None:
        self.step += 1
        m, v = self.m, self.v
        for k in self.w:
            m[k] += 0.1 * (g[k] - m[k])
            v[k] += 0.01 * (g[k] * g[k] - v[k])
            self.w[k] -= RATE * (m[k] / (1 - 0.9**self.step)) / (np.sqrt(v[k] / (1 - 0.99**self.step)) + 1e-6)


class Scorer:
    """The model made ready for scoring: with one layer, the projections of every id can be looked up."""

    def __init__(self, w: Weights, classes: Classes):
        self.classes = classes
        scale = np.float32(WIDTH**-0.5)
        self.q, self.pq = w["E"] @ w["Q"] * scale, w["P"] @ w["Q"] * scale
        self.k, self.pk = w["E"] @ w["K"], w["P"] @ w["K"]
        self.v, self.pv = w["E"] @ w["V"], w["P"] @ w["V"]
        self.u = w["E"] @ w["U"] + w["b"]
        self.ou = w["O"] @ w["U"]

    def log10(self, ids: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each text, its end included."""
        total = np.zeros(len(ids))
        for text, inputs, targets, scored in batches_of(ids, self.classes) if ids else ():
            q, k, v = (np.take(t, inputs, axis=0) for t in (self.q, self.k, self.v))
            q += self.pq
            k += self.pk
            v += self.pv
            a = np.matmul(q, k.swapaxes(1, 2))
            np.minimum(a, _MOST, out=a)  # far above what training reaches
            np.exp(a, out=a)
            a *= _SHOWN
            own = np.flatnonzero(scored)
            h = np.take(np.matmul(a, v).reshape(-1, WIDTH), own, axis=0)
            h /= np.take(a.sum(axis=-1).ravel(), own)[:, None]
            logits = h @ self.ou
            logits += np.take(self.u, np.take(inputs.ravel(), own), axis=0)
            wanted = np.take(targets.ravel(), own)
            right = np.take(logits.ravel(), np.arange(len(own)) * CLASSES + np.take(self.classes.of, wanted))
            np.minimum(logits, _MOST, out=logits)
            logs = right - np.log(np.exp(logits, out=logits).sum(axis=1)) + np.take(self.classes.log_share, wanted)
            total += np.bincount(np.repeat(text, CONTEXT)[own], logs, len(ids))
        return total / np.log(10)


# --- as Spark jobs ---------------------------------------------------------------


def _trained(shared_encoder, shared_state):
    """The weights of each group; its rows come one after the other, in the order of their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, classes, round_ = shared_state.value
        known = _Known({}, shared_encoder.value.encode)
        group, trainer, n, ids, held = None, None, 0, [], 0

        def result() -> pa.RecordBatch:
            trainer.learn(ids)
            flat = np.concatenate([trainer.w[k].ravel() for k in _SHAPES]).astype(np.float32)
            columns = [pa.array([group], pa.int64()), pa.array([n], pa.int64()), pa.array([flat.tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["group", "n", "weights"])

        for batch in batches:
            for own, text in zip(batch.column("group").to_pylist(), batch.column("text")):
                if own != group:
                    if trainer:
                        yield result()
                    group, trainer, n, ids, held = own, Trainer(weights, classes, round_), 0, [], 0
                places = known.of(words_of(text.as_py()))
                ids.append(np.frombuffer(b"".join([known.ids[p] for p in places]), np.int32))
                n += 1
                held += len(ids[-1]) + 1
                if held >= CHUNK:
                    trainer.learn(ids)
                    ids, held = [], 0
        if trainer:
            yield result()

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights times documents, added up in the order of the rows, which are sorted by part."""
    part, n, total = None, 0, None

    def result() -> pa.RecordBatch:
        columns = [pa.array([part], pa.int64()), pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["part", "n", "weights"])

    for batch in batches:
        for own, times, weights in zip(*(batch.column(c) for c in ("part", "n", "weights"))):
            if own.as_py() != part:
                if total is not None:
                    yield result()
                part, n, total = own.as_py(), 0, np.zeros(sum(int(np.prod(s)) for s in _SHAPES.values()))
            n += times.as_py()
            total += np.frombuffer(weights.as_py(), np.float32).astype(np.float64) * times.as_py()
    if total is not None:
        yield result()


def _apart(rows: DataFrame, n: int, number: str) -> DataFrame:
    """Rows numbered 0 to n - 1, a partition a number; by hash, several of a few numbers would meet in one task."""
    return rows.repartitionById(n, F.col(number).cast("int"))


def fit(training: DataFrame, classes: Classes, encoder) -> Weights:
    """Weights that all training documents have a part in."""
    context = training.sparkSession.sparkContext
    n = training.count()
    groups = max(TRAINERS, -(-n // GROUP))
    parts = math.isqrt(groups)
    rounds_each = min(ROUNDS, 1 + REPEATED // max(1, n))
    drawn = F.pmod(F.xxhash64("key"), F.lit(1 << 60))
    weights = first_weights()
    for round_ in range(ROUNDS):
        state = context.broadcast((weights, classes, round_))
        own = training.where((drawn + round_) % ROUNDS < rounds_each)
        dealt = own.select(F.pmod(F.xxhash64("key", F.lit(1)), F.lit(groups)).cast("bigint").alias("group"), "key", "text")
        dealt = _apart(dealt, groups, "group").sortWithinPartitions("group", "key").select("group", "text")
        made = dealt.mapInArrow(_trained(encoder, state), "group bigint, n bigint, weights binary")
        made = _apart(made.withColumn("part", F.col("group") % parts), parts, "part").sortWithinPartitions("part", "group")
        rows = made.select("part", "n", "weights").mapInArrow(_summed, "part bigint, n bigint, weights binary").collect()
        if not rows:
            continue
        rows.sort(key=lambda r: r.part)
        flat = sum(np.frombuffer(r.weights) for r in rows) / sum(r.n for r in rows)
        ends = np.cumsum([int(np.prod(s)) for s in _SHAPES.values()])[:-1]
        pieces = np.split(flat.astype(np.float32), ends)
        weights = {k: piece.reshape(s) for (k, s), piece in zip(_SHAPES.items(), pieces)}
    return weights


class _Known:
    """What a worker remembers of words: the log of their base probability (nan: not hot) and their ids."""

    def __init__(self, hot: dict[bytes, float], encode):
        self.hot, self.encode = hot, encode
        self.clear()

    def clear(self):
        self.places: dict[bytes, int] = {}
        self.logs: list[float] = []
        self.ids: list[bytes] = []

    def of(self, words: list[bytes]) -> list[int]:
        if len(self.places) >= _REMEMBERED:
            self.clear()
        places = self.places
        for word in set(words).difference(places):
            places[word] = len(self.logs)
            self.logs.append(self.hot.get(word, np.nan))
            self.ids.append(self.encode(" " + word.decode(errors="replace")).tobytes())
        return list(map(places.__getitem__, words))


_SCORED = (
    "key binary, doc_id bigint, held_out boolean, n_tokens bigint, n_hot bigint, hot_score double, score double, "
    "rare array<struct<word:binary,n:bigint>>"
)


def _scored(shared_encoder, shared_model, shared_hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared_model.value
        known = _Known(shared_hot.value, shared_encoder.value.encode)
        rare_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, 200):
                batch = whole_batch.slice(at, 200)
                counts, hot, scores, rare, ids = [], [], [], [], []
                for text in batch.column("text"):
                    words = words_of(text.as_py())
                    places = known.of(words)
                    logs = np.array([known.logs[p] for p in places])
                    missing = np.isnan(logs)
                    counts.append(len(words))
                    hot.append(len(words) - int(missing.sum()))
                    scores.append(float(logs[~missing].sum()))
                    unknown = Counter(words[i] for i in np.flatnonzero(missing).tolist())
                    rare.append([{"word": w, "n": n} for w, n in unknown.items()])
                    ids.append(np.frombuffer(b"".join([known.ids[p] for p in places]), np.int32))
                columns = [
                    *(batch.column(c) for c in ("key", "doc_id", "held_out")),
                    pa.array(counts, pa.int64()),
                    pa.array(hot, pa.int64()),
                    pa.array(scores, pa.float64()),
                    pa.array(model.log10(ids), pa.float64()),
                    pa.array(rare, rare_type),
                ]
                names = ["key", "doc_id", "held_out", "n_tokens", "n_hot", "hot_score", "score", "rare"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def score(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``.

    ``held_out`` is read from a column of that name; the models learn from the other rows.
    """
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint"), doc_key().alias("key"), F.col("text").cast("string"), "held_out")
    training = rows.where(~F.col("held_out"))
    counts = word_counts(training)
    n_docs = training.count()
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    train_tokens = (sums["n"] or 0) + n_docs
    below = train_tokens + 0.5 * (sums["v"] + (n_docs > 0) + 1)
    log = lambda c: F.log10((c + 0.5) / F.lit(float(below)))

    encoder = bpe.encoder(spark, path)
    n_ids = len(encoder.value.entries) + 1
    found = counts.mapInArrow(_id_counts(encoder, n_ids), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    id_counts = np.zeros(n_ids)
    for row in found.collect():  # one row per entry of the vocabulary at most
        id_counts[row["id"]] = row["n"]
    id_counts[-1] = n_docs
    classes = Classes(id_counts)
    model = Scorer(fit(training, classes, encoder), classes)

    frequent = counts.orderBy(F.desc("n"), "word").limit(HOT).collect()
    hot = {bytes(r["word"]): float(np.log10((r["n"] + 0.5) / below)) for r in frequent}
    send = spark.sparkContext.broadcast
    made = stage(rows.mapInArrow(_scored(encoder, send(model), send(hot)), _SCORED), "lm-scores")

    rare = made.select("key", F.inline("rare")).join(counts.withColumnRenamed("n", "c"), "word", "left")
    rare = rare.groupBy("key").agg(
        F.sum(F.col("n") * log(F.coalesce("c", F.lit(0)))).alias("rare_score"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("n_rare"),
    )
    # rows that repeat have brought their rare words once each
    copies = made.where(F.size("rare") > 0).groupBy("key").agg(F.count("*").alias("copies"))
    per_row = lambda name: (F.col(name) / F.col("copies")).alias(name)
    rare = rare.join(copies, "key").select("key", per_row("rare_score"), per_row("n_rare"))
    both = made.drop("rare").join(rare, "key", "left")
    end = float(np.log10((n_docs + 0.5) / below))
    return both.select(
        "doc_id",
        "held_out",
        (F.col("n_tokens") + 1).alias("n_tokens"),
        (F.col("n_hot") + F.coalesce("n_rare", F.lit(0)) + F.lit(int(n_docs > 0))).cast("bigint").alias("n_known"),
        F.lit(train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("hot_score") + F.coalesce("rare_score", F.lit(0.0)) + F.lit(end)).alias("base_score"),
        "score",
    )


@query
def op9_attention_lm(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    return score(docs.withColumn("held_out", held_out(5, 1)))
