"""Language-model scoring: a causal self-attention model over subword ids, trained here with numpy.

Text: ASCII letters in lower case, words between white space, one end token. A word's subword ids come
from a public vocabulary. An id's probability is ``p(group | context) * p(class | context, group) * p(id | class)``: the
most frequent ids are classes of their own, the others share classes by frequency, and classes of neighbouring
frequency make a group. At either level a choice has the weight

    R[previous] * (1 + x / 16) ** 16,  x = softmax(Q[previous] . K[earlier] / sqrt(d) + b[distance]) V[earlier] U

with one causal attention head; the power stands for exp and takes a fifth of its time. Weights are normalised
among the groups, then among the classes of the group: 48 weights a position instead of 512. Everything that is
counted covers all training documents: word counts
(also of the baseline), subword counts, and the class bigrams that R is made of. The attention
parameters are trained by local gradient steps in each partition, on every id of every training document
(consecutive windows of ``2 * HALF`` ids, the end token with them), and averaged over partitions by tokens;
this is repeated ``ROUNDS`` times.

Scoring cuts a text into overlapping windows: each token is scored once, with the half window before it and
what precedes it in its own half as context, as masked matrix products over many windows at a time.

Subword ids are worked out once and written; counts, both rounds and scoring read them.

The baseline is an add-one unigram model of words. Counts of the most frequent words (a bounded table)
are known in the tasks; the other words of a document are joined with the count table.

Edge cases: null and empty texts are the end token alone; without training documents all counts are 0 and
the model is uniform over its classes; repeated rows are scored each; an empty table gives no rows.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import batches_of, shipped, written

IN, OUT = 2048, 512  # classes as context and as prediction; the last of each hold the special token
GROUPS = 16
PER_GROUP = OUT // GROUPS
WIDTH = 16
HALF = 16
FREQUENT = 1 << 16
LONGEST = 64  # bytes of a frequent word; longer ones are joined with the count table
CACHE = 200_000
FLUSH = 300_000
ROUNDS = 2
BATCH = 128  # windows of a gradient step
GROUP = 512  # texts whose words are looked up together
ROWS = 4 * GROUP  # rows of an Arrow batch where each text is treated alone
END = " "  # no word is a space
_PAD = IN  # context class of positions before a text


def _words(text: bytes) -> list[bytes]:
    return text.lower().split()


def _word_table(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of some texts (null is empty), the number of each word in turn, and where each text's
    words start, with their end. The empty word stands where a text starts or ends with white space."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = words.flatten().dictionary_encode()
    starts = words.offsets.to_numpy()
    return flat.dictionary.cast(pa.binary()), flat.indices.to_numpy(), starts - starts[0]


def _listed(words: pa.Array) -> list[bytes]:
    """The values of a binary array without nulls."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].tolist()
    data = words.buffers()[2].to_pybytes() if words.buffers()[2] else b""
    return [data[a:b] for a, b in zip(ends, ends[1:])]


class Vocabulary(dict):
    """Word to number; subword ids of each numbered word. Numbers under ``fixed`` stay."""

    def __init__(self, model: bytes, frequent: list[bytes]):
        super().__init__()
        self.tokenizer = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = self.tokenizer.vocab_size()
        self.names: list[bytes] = []
        self.ids = array("i")
        self.ends = array("q", [0])
        self.numbers(frequent)
        self.fixed = len(frequent)

    def trim(self) -> None:
        """Forgets the words beyond the fixed ones when there are too many."""
        if len(self.names) > self.fixed + CACHE:
            for word in self.names[self.fixed :]:
                del self[word]
            del self.names[self.fixed :], self.ends[self.fixed + 1 :], self.ids[self.ends[-1] :]

    def numbers(self, words: list[bytes]) -> np.ndarray:
        new = list(dict.fromkeys(w for w in words if w not in self))
        self.update(zip(new, range(len(self.names), len(self.names) + len(new))))
        self.names += new
        for ids in self.tokenizer.encode([w.decode(errors="replace") for w in new], num_threads=1) if new else ():
            self.ids.extend(ids)
            self.ends.append(len(self.ids))
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        return np.array(self.ids, np.int64), np.array(self.ends, np.int64)


def expand(numbers: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The subword ids of a sequence of numbered words."""
    start, stop = ends[numbers], ends[numbers + 1]
    length = stop - start
    at = np.repeat(start - np.concatenate(([0], np.cumsum(length)[:-1])), length) + np.arange(length.sum())
    return ids[at]


@dataclass
class Model:
    tokenizer: bytes
    frequent: list[bytes]
    counts: np.ndarray  # of the frequent words, in training
    into: np.ndarray  # context class of each id; the last entry is the end token
    out: np.ndarray  # predicted class of each id
    emission: np.ndarray  # ln p(id | class)
    bigram: np.ndarray  # R: IN + 1 rows (the last pads) of OUT weights
    q: np.ndarray
    k: np.ndarray
    v: np.ndarray
    bias: np.ndarray  # of each distance 0 .. 2 * HALF - 1
    u: np.ndarray  # of the classes
    u_top: np.ndarray  # of the groups
    top: np.ndarray | None = None  # R of the groups, kept once R is final

    def parameters(self) -> list[np.ndarray]:
        return [self.q, self.k, self.v, self.bias, self.u, self.u_top]

    def group_weights(self) -> np.ndarray:
        return self.bigram.reshape(-1, GROUPS, PER_GROUP).sum(axis=2) if self.top is None else self.top


def class_tables(id_counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of each id by rank of frequency, and ln p(id | class); the end token is the last id."""
    n = len(id_counts)
    rank = np.empty(n, np.int64)
    rank[np.lexsort((np.arange(n), -id_counts))] = np.arange(n)
    into = np.concatenate((_banded(rank, IN - 1), [IN - 1]))
    out = np.concatenate((_banded(rank, OUT - 1), [OUT - 1]))
    smooth = id_counts + 0.5
    emission = np.log(smooth / np.bincount(out[:-1], smooth, OUT)[out[:-1]])
    return into, out, np.concatenate((emission, [0.0])).astype(np.float32)


def _banded(rank: np.ndarray, classes: int) -> np.ndarray:
    """A class for each of the first ranks, then bands that double in width."""
    bands = 16
    own = classes - bands
    band = np.floor(np.log2(np.maximum(rank - own, 0) / 8 + 1)).astype(np.int64)
    return np.where(rank < own, rank, own + np.minimum(band, bands - 1))


def attend(model: Model, x: np.ndarray, first: int) -> tuple[np.ndarray, ...]:
    """Attention weights, their sums and the contexts of the positions from ``first`` on of each row of context
    classes, and the queries (over sqrt(d)), keys and values they come from."""
    width = x.shape[1]
    q, k, v = model.q.take(x[:, first:], 0), model.k.take(x, 0), model.v.take(x, 0)
    q *= q.dtype.type(1 / np.sqrt(WIDTH))
    s = q @ k.transpose(0, 2, 1)
    distance = np.arange(first, width)[:, None] - np.arange(width)[None, :]
    s += model.bias[np.maximum(distance, 0)].astype(s.dtype)
    np.clip(s, -60, 60, out=s)  # instead of taking the largest off: neither overflows nor vanishes
    np.exp(s, out=s)
    s *= (distance >= 0).astype(s.dtype)
    pad = x == _PAD
    if len(some := np.flatnonzero(pad.any(axis=1))):
        s[some] = s[some] * ~pad[some, None, :] + s.dtype.type(1e-30)  # rows of padding alone
    total = _sum(s.reshape(-1, width)).reshape(s.shape[:2])
    context = s @ v
    context /= total[:, :, None]
    return s, total, context, q, k, v


def _weights(base: np.ndarray, r: np.ndarray) -> np.ndarray:
    """The weights of the choices; ``base`` comes as x / 16 and is left as 1 + x / 16."""
    base += 1
    np.clip(base, 0.1, np.inf, out=base)
    w = base * base
    for _ in range(3):
        np.multiply(w, w, out=w)
    w *= r
    return w


def _sum(w: np.ndarray) -> np.ndarray:
    return w @ np.ones(w.shape[1], w.dtype)


class Choices:
    """Both choices of each position, in the order of the group of its goal (positions with goal -1 are left out).

    What is worked out by element is one pass over all positions; only matrix products go by group.
    """

    def __init__(self, model: Model, context: np.ndarray, before: np.ndarray, goal: np.ndarray):
        group = np.where(goal < 0, GROUPS, goal // PER_GROUP).astype(np.uint8)
        order = np.argsort(group, kind="stable")
        edge = np.searchsorted(group[order], np.arange(GROUPS + 1))
        self.order = order[: edge[-1]]
        self.spans = [(g, slice(edge[g], edge[g + 1])) for g in range(GROUPS) if edge[g] < edge[g + 1]]
        self.context = context.take(self.order, 0)
        self.at = np.arange(len(self.order))
        group, own = np.divmod(goal.take(self.order), PER_GROUP)
        before = before.take(self.order)
        self.top = self._level(self.context @ (model.u_top / 16).astype(context.dtype), model.group_weights().take(before, 0), group)
        self.u = np.ascontiguousarray(model.u.reshape(WIDTH, GROUPS, PER_GROUP).transpose(1, 0, 2))
        u, base = (self.u / 16).astype(context.dtype), np.empty((len(self.order), PER_GROUP), context.dtype)
        for g, some in self.spans:
            np.matmul(self.context[some], u[g], out=base[some])
        self.own = self._level(base, model.bigram.reshape(-1, PER_GROUP).take(before * GROUPS + group, 0), own)

    def _level(self, base: np.ndarray, r: np.ndarray, goal: np.ndarray) -> tuple[np.ndarray, ...]:
        w = _weights(base, r)
        total = _sum(w)
        return base, w, total, goal, w[self.at, goal] / total

    def shares(self) -> np.ndarray:
        """Probability of the goals' classes."""
        return self.top[-1] * self.own[-1]

    def slopes(self, model: Model, positions: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gradients of the mean loss for the contexts of all positions, u and u_top."""
        n = self.context.dtype.type(max(1, len(self.order)))
        top, own = self._slope(*self.top[:-1], n), self._slope(*self.own[:-1], n)
        d_known = np.zeros((len(self.order) + 1, WIDTH), self.context.dtype)  # the last: positions without a goal
        np.matmul(top, model.u_top.T, out=d_known[:-1])
        d_u = np.zeros_like(self.u)
        for g, some in self.spans:
            d_known[some] += own[some] @ self.u[g].T
            np.matmul(self.context[some].T, own[some], out=d_u[g])
        back = np.full(positions, len(self.order))
        back[self.order] = self.at
        return d_known.take(back, 0), d_u.transpose(1, 0, 2).reshape(WIDTH, OUT), self.context.T @ top

    def _slope(self, base: np.ndarray, w: np.ndarray, total: np.ndarray, goal: np.ndarray, n: np.floating) -> np.ndarray:
        w[self.at, goal] -= total
        w /= base
        w /= (total * n)[:, None]
        return w


def score_ids(model: Model, texts: list[np.ndarray], chunk: int = 512) -> np.ndarray:
    """log10 probability of each sequence of ids, each with its end token last."""
    rows, spans = [], []
    for ids in texts:
        n = len(ids)
        blocks = -(-n // HALF)
        x = np.full((blocks + 1) * HALF, _PAD, np.int64)
        x[HALF] = IN - 1  # an end token stands before the text, too
        x[HALF + 1 : HALF + n] = model.into[ids[:-1]]
        y = np.full(blocks * HALF, -1, np.int64)
        y[:n] = ids
        rows.append((x, y))
        spans.append(blocks)
    starts = np.concatenate(([0], np.cumsum(spans)))
    x = np.concatenate([np.lib.stride_tricks.sliding_window_view(x, 2 * HALF)[::HALF] for x, _ in rows])
    y = np.concatenate([y.reshape(-1, HALF) for _, y in rows])
    out = np.zeros(len(x))
    for at in range(0, len(x), chunk):
        part, goal = x[at : at + chunk], y[at : at + chunk].ravel()
        context = attend(model, part, HALF)[2]
        after = np.where(goal < 0, -1, model.out.take(goal, mode="wrap"))
        found = Choices(model, context.reshape(-1, WIDTH), part[:, HALF:].ravel(), after)
        ln_p = np.log(found.shares()) + model.emission[goal[found.order]]
        out[at : at + chunk] = np.bincount(found.order // HALF, ln_p, len(part))
    return np.add.reduceat(out, starts[:-1]) / np.log(10)


_CELLS = np.arange((IN + 1) * WIDTH).reshape(IN + 1, WIDTH)  # of a parameter table, by row


def gradient(model: Model, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss of predicting classes y (-1: none) from context classes x, and the parameters' gradients."""
    a, total, context, q, k, v = attend(model, x, 0)
    width, flat = x.shape[1], x.ravel()
    found = Choices(model, context.reshape(-1, WIDTH), flat, y.ravel())
    loss = -np.log(found.shares() + 1e-24).sum() / max(1, len(found.order))
    d_context, d_u, d_top = found.slopes(model, len(flat))
    d_context = d_context.reshape(context.shape)
    d_context /= total[:, :, None]  # the weights a are not divided by their sums
    d_s = d_context @ v.transpose(0, 2, 1)
    d_s -= np.einsum("ijk,ijk->ij", d_context, context)[:, :, None]
    d_s *= a
    distance = np.maximum(np.arange(width)[:, None] - np.arange(width)[None, :], 0)
    d_bias = np.bincount(distance.ravel(), d_s.sum(axis=0).ravel(), len(model.bias))
    cells = _CELLS.take(flat, 0).ravel()

    def gathered(d: np.ndarray) -> np.ndarray:
        return np.bincount(cells, d.ravel(), _CELLS.size).reshape(_CELLS.shape).astype(np.float32)

    d_q = gathered(d_s @ k) * np.float32(1 / np.sqrt(WIDTH))
    d_k = gathered(d_s.transpose(0, 2, 1) @ q)
    d_v = gathered(a.transpose(0, 2, 1) @ d_context)
    return float(loss), [d_q, d_k, d_v, d_bias.astype(np.float32), d_u, d_top]


def _word_counts(docs: DataFrame) -> DataFrame:
    """word (binary), c: of all documents, with their end tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        texts = 0

        def added() -> pa.Table:
            return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("c", "sum")]).rename_columns(["word", "c"])

        for batch in batches:
            texts += batch.num_rows
            for at in range(0, batch.num_rows, GROUP):
                words, order, _ = _word_table(batch.column("text").slice(at, GROUP))
                counts = pa.table({"word": words, "c": np.bincount(order, minlength=len(words))})
                held.append(counts.filter(pc.not_equal(words, b"")))
            if sum(map(len, held)) > FLUSH:
                yield from added().to_batches()
                held = []
                pa.default_memory_pool().release_unused()
        held.append(pa.table({"word": pa.array([END.encode()], pa.binary()), "c": pa.array([texts], pa.int64())}))
        yield from added().to_batches()

    return shipped(docs.select("text")).mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _id_type(size: int) -> np.dtype:
    return np.dtype("<u2" if size < 1 << 16 else "<u4")


def encode(docs: DataFrame, learn: Column, tokenizer: bytes) -> DataFrame:
    """d and e (hashes of id and text), learn, and the subword ids of every whole text, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(tokenizer, [])
        kind = _id_type(vocabulary.size)
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                part = batch.slice(at, GROUP)
                words, order, starts = _word_table(part.column("text"))
                numbers = vocabulary.numbers(_listed(words))[order]
                ids, ends = vocabulary.arrays()
                flat = expand(numbers, ids.astype(kind), ends)
                stops = np.concatenate(([0], np.cumsum(ends[numbers + 1] - ends[numbers])))[starts] * kind.itemsize
                data = flat.tobytes()
                found = pa.array([data[a:b] for a, b in zip(stops[:-1].tolist(), stops[1:].tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("d", "e", "learn")), found], ["d", "e", "learn", "ids"])
                vocabulary.trim()

    rows = _keyed(docs, learn.alias("learn")).drop("doc_id")
    with batches_of(docs.sparkSession, ROWS):
        return written(shipped(rows).mapInArrow(run, "d long, e long, learn boolean, ids binary"), "lm-ids")


def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long"), "text", *more)
    return rows.withColumns({"d": F.xxhash64("doc_id", "text"), "e": F.xxhash64(F.lit("e"), "text", "doc_id")})


def _id_lists(batch: pa.RecordBatch, size: int) -> list[np.ndarray]:
    kind = _id_type(size)
    return [np.frombuffer(x, kind).astype(np.int64) for x in batch.column("ids").to_pylist()]


def _counted(ids: DataFrame, cells, size: int) -> np.ndarray:
    """How often each cell occurs, as a double; ``cells`` gives the cells of a list of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                total += np.bincount(cells(batch.slice(at, GROUP)), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["cell", "n"])

    out = np.zeros(size)
    rows = shipped(ids.select("ids")).mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    for row in rows.collect():  # at most ``size`` rows, the model's own
        out[row.cell] = row.n
    return out


def _id_counts(ids: DataFrame, size: int) -> np.ndarray:
    return _counted(ids, lambda batch: np.concatenate(_id_lists(batch, size) or [np.zeros(0, np.int64)]), size)


def _bigrams(ids: DataFrame, model: Model) -> np.ndarray:
    """Counts of (context class, next class) over all tokens."""
    into, out = model.into, model.out
    size = len(into) - 1
    end = np.array([size])

    def cells(batch: pa.RecordBatch) -> np.ndarray:
        parts = [end]  # end tokens between the texts, and before the first
        for some in _id_lists(batch, size):
            parts += [some, end]
        seq = np.concatenate(parts)
        return into[seq[:-1]] * OUT + out[seq[1:]]

    return _counted(ids, cells, IN * OUT).reshape(IN, OUT)


def windows(model: Model, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Context classes and goal classes (-1: none) of consecutive windows of 2 * HALF ids over the whole texts:
    each id and end token is a goal once."""
    width, end = 2 * HALF, np.array([len(model.into) - 1])
    texts = [np.concatenate((end, some, end)) for some in texts]
    stops = np.cumsum([-(-(len(seq) - 1) // width) for seq in texts]) * width
    x, y = np.full(stops[-1], _PAD, np.int64), np.full(stops[-1], -1, np.int64)
    for seq, start in zip(texts, [0, *stops[:-1]]):
        x[start : start + len(seq) - 1] = model.into[seq[:-1]]
        y[start : start + len(seq) - 1] = model.out[seq[1:]]
    return x.reshape(-1, width), y.reshape(-1, width)


def _train_round(ids: DataFrame, model: Model, round_: int, rate: float = 0.02, batch_rows: int = BATCH) -> list[np.ndarray]:
    """Parameters after local steps on all windows of each partition, averaged by tokens."""
    sent = ids.sparkSession.sparkContext.broadcast(model)
    shapes = [p.shape for p in model.parameters()]

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        flat = np.concatenate([p.ravel() for p in model.parameters()])  # the model's own are views of it
        ends = np.cumsum([int(np.prod(shape)) for shape in shapes])
        parameters = [part.reshape(shape) for part, shape in zip(np.split(flat, ends[:-1]), shapes)]
        model.q, model.k, model.v, model.bias, model.u, model.u_top = parameters
        adam, tokens = Adam(flat, rate), 0
        rng = np.random.default_rng(round_)
        x = y = np.zeros((0, 2 * HALF), np.int64)  # windows that wait for a full batch
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                more_x, more_y = windows(model, _id_lists(batch.slice(at, GROUP), len(model.into) - 1))
                x, y = np.concatenate((x, more_x)), np.concatenate((y, more_y))
                order = rng.permutation(len(x))  # a batch of windows of many texts
                full = len(x) - len(x) % batch_rows
                for start in range(0, full, batch_rows):
                    some = order[start : start + batch_rows]
                    adam.move(gradient(model, x[some], y[some])[1])
                    tokens += int((y[some] >= 0).sum())
                x, y = x[order[full:]], y[order[full:]]
        if len(x):
            adam.move(gradient(model, x, y)[1])
            tokens += int((y >= 0).sum())
        flat = flat.astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat * tokens), pa.array(np.full(len(flat), tokens))],
            ["at", "value", "weight"],
        )

    rows = shipped(ids.select("ids")).mapInArrow(train, "at int, value double, weight long")
    mean = F.try_divide(F.sum("value"), F.sum("weight")).alias("value")  # null without training ids
    found = rows.groupBy("at").agg(mean).collect()  # one row per parameter
    flat = np.concatenate([p.ravel() for p in model.parameters()]).astype(np.float64)
    for row in found:
        if row.value is not None:
            flat[row["at"]] = row.value
    out, at = [], 0
    for shape in shapes:
        size = int(np.prod(shape))
        out.append(flat[at : at + size].reshape(shape).astype(np.float32))
        at += size
    return out


class Adam:
    """Steps of one flat array of parameters, in place."""

    def __init__(self, parameters: np.ndarray, rate: float):
        self.p, self.rate, self.step = parameters, rate, 0
        self.a, self.b = np.zeros_like(parameters), np.zeros_like(parameters)  # sums of gradients and their squares, fading

    def move(self, grads: list[np.ndarray]) -> None:
        self.step += 1
        flat = np.concatenate([g.ravel() for g in grads], dtype=self.p.dtype)
        # The averages are 0.1 a / (1 - 0.9 ** step) and 0.02 b / (1 - 0.98 ** step); their factors are taken out.
        spread = np.sqrt(0.02 / (1 - 0.98**self.step))
        rate, least = self.rate * 0.1 / (1 - 0.9**self.step) / spread, 1e-6 / spread
        self.a *= 0.9
        self.a += flat
        self.b *= 0.98
        flat *= flat
        self.b += flat
        np.sqrt(self.b, out=flat)
        flat += least
        np.divide(self.a, flat, out=flat)
        flat *= rate
        self.p -= flat


def fit(docs: DataFrame, learn: Column, tokenizer: bytes, ids: DataFrame | None = None) -> tuple[Model, DataFrame, int, int]:
    """The model, the count table (word, c), the number of training tokens and of distinct ones. ``ids`` is what
    ``encode`` gave for the same rows, if it is there already."""
    training = (encode(docs, learn, tokenizer) if ids is None else ids).where("learn")
    with batches_of(docs.sparkSession, ROWS):
        counts = written(_word_counts(docs.where(learn)), "lm-words")
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    top = counts.where(F.col("word") != F.lit(END).cast("binary")).where(F.length("word") <= LONGEST)
    top = top.orderBy(F.desc("c"), "word").limit(FREQUENT).collect()
    size = sentencepiece.SentencePieceProcessor(model_proto=tokenizer).vocab_size()
    into, out, emission = class_tables(_id_counts(training, size))
    rng = np.random.default_rng(11)
    table = lambda scale: (rng.standard_normal((IN + 1, WIDTH)) * scale).astype(np.float32)
    model = Model(
        tokenizer, [bytes(r.word) for r in top], np.array([r.c for r in top], np.int64), into, out, emission,
        np.full((IN + 1, OUT), 1 / OUT, np.float32), table(0.3), table(0.3), table(0.3),
        np.zeros(2 * HALF, np.float32), np.zeros((WIDTH, OUT), np.float32), np.zeros((WIDTH, GROUPS), np.float32),
    )
    pairs = _bigrams(training, model)
    alone = (pairs.sum(axis=0) + 0.5) / (pairs.sum() + 0.5 * OUT)
    model.bigram[:IN] = (pairs + 8 * alone) / (pairs.sum(axis=1, keepdims=True) + 8)
    model.top = model.group_weights()
    for round_ in range(ROUNDS):
        trained = _train_round(training, model, round_, 0.02 / (1 + round_))
        model.q, model.k, model.v, model.bias, model.u, model.u_top = trained
    # x is a mean of rows of V U, so this keeps 1 + x / 16 positive.
    for u in (model.u, model.u_top):
        u *= np.float32(min(1.0, 14 / max(1e-9, np.abs(model.v @ u).max())))
    return model, counts, int(total.n or 0), int(total.v or 0)


def model_scores(ids: DataFrame, model: Model) -> DataFrame:
    """d, e and the model's score of every row of ``encode``."""
    sent = ids.sparkSession.sparkContext.broadcast(model)  # bounded: FREQUENT words, the vocabulary's tables

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        end = np.array([len(model.into) - 1])
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                part = batch.slice(at, GROUP)
                found = score_ids(model, [np.concatenate((x, end)) for x in _id_lists(part, len(model.into) - 1)])
                yield pa.RecordBatch.from_arrays([part.column("d"), part.column("e"), pa.array(found)], ["d", "e", "score"])

    return shipped(ids.select("d", "e", "ids")).mapInArrow(run, "d long, e long, score double")


def score(docs: DataFrame, model: Model, counts: DataFrame, n: int, v: int, ids: DataFrame | None = None) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row."""
    if ids is None:
        ids = encode(docs, F.lit(True), model.tokenizer)
    sent = docs.sparkSession.sparkContext.broadcast((model.frequent, model.counts))  # bounded: FREQUENT words of LONGEST bytes
    schema = "d long, e long, doc_id long, n_tokens long, n_known long, base double, word binary, times long"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {word: i for i, word in enumerate(sent.value[0])}
        logs = np.append(np.log10(sent.value[1] + 1.0), 0.0)  # the last: words beyond the frequent ones
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                part = batch.slice(at, GROUP)
                words, order, starts = _word_table(part.column("text"))
                names_of, m = _listed(words), part.num_rows
                full = np.fromiter((w != b"" for w in names_of), bool, len(names_of))[order]
                found = np.fromiter((place.get(w, -1) for w in names_of), np.int64, len(names_of))[order]
                owner = np.repeat(np.arange(m), np.diff(starts))
                total, known = np.bincount(owner[full], minlength=m) + 1, np.bincount(owner[found >= 0], minlength=m)
                base = np.bincount(owner, logs[found], m)
                whole = [part.column("d"), part.column("e"), part.column("doc_id"), total, known, base, pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64())]
                yield _arrays(whole, names)
                other = full & (found < 0)
                rare, times = np.unique(owner[other] * len(words) + order[other], return_counts=True)
                if r := len(rare):
                    owners, at_word = np.divmod(rare, len(words))
                    keys = [part.column(c).take(pa.array(owners)) for c in ("d", "e")]
                    none = [pa.nulls(r, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64())]
                    yield _arrays([*keys, *none, words.take(pa.array(at_word)), times], names)

    with batches_of(docs.sparkSession, ROWS):
        rows = written(shipped(_keyed(docs)).mapInArrow(run, schema), "lm-scored")
        scored = written(model_scores(ids, model), "lm-scores")
    texts = rows.where("word is null")
    # Words beyond the frequent ones that training has; the others count as 0, which adds log10(1).
    rare = (
        rows.where("word is not null")
        .select("d", "e", "word", "times")
        .join(counts, "word")
        .groupBy("d", "e")
        .agg(F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("rare_base"))
    )
    same = texts.groupBy("d", "e").agg(F.count("*").alias("copies"))  # repeated rows bring their words each
    scores = scored.groupBy("d", "e").agg(F.min("score").alias("score"))
    sums = same.join(rare, ["d", "e"], "left").join(scores, ["d", "e"])
    end = float(counts.where(F.col("word") == F.lit(END).cast("binary")).agg(F.sum("c")).first()[0] or 0)
    base = F.col("base") + F.coalesce(F.col("rare_base") / F.col("copies"), F.lit(0.0)) + float(np.log10(end + 1))
    known = F.col("n_known") + F.coalesce(F.col("rare_known") / F.col("copies"), F.lit(0)) + (1 if end else 0)
    return texts.join(sums, ["d", "e"]).select(
        "doc_id",
        "n_tokens",
        known.cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (base - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"),
        "score",
    )


def _arrays(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)
