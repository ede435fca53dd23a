"""Scoring texts by a gated recurrent language model.

Tokens are lower-cased words and one end a document.  The most frequent training
words, the end, and buckets of all other words (dealt by their last bytes) are
the symbols of the network: a GRU whose output softmax is factored into classes
of equal size.  A word outside the frequent ones costs its bucket, then its
share of the bucket by training counts, so every training word counts.

Word counts cover all training texts, and so does the training of the weights:
every training text is learnt from, whole, in one pass of truncated
backpropagation.  The texts, as symbols, are dealt by hash to shards of like size,
whose number grows with the corpus.  A pass has a few rounds; in each the shards
are trained side by side in Spark tasks, each on its next part, and their weights
averaged, also by Spark.  Scoring reads whole documents: the state is carried from
window to window, and only reset after an end.

Defined results: a null or empty text is the end alone; an unseen word has count
0 and one unit of its bucket's mass; repeated rows are scored alike; without
training rows the model is uniform; empty tables give no rows; null ids are
carried, and count as training rows of fold 0.  Which copies of a row teach
follows their place in the table.
"""

from __future__ import annotations

import heapq
import math
from copy import copy
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import checkpointed, text_docs

FLUSH = 24_000_000  # bytes of words a counting task holds before it counts them and passes them on
BLOCK = 16_384  # weights an update takes at a time, so that they stay in a core's cache
END = 0
SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


def tokens(text: str) -> list[bytes]:
    """Words of a text, A-Z lower-cased, parted by the six ASCII white spaces."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The ``tokens`` of all texts, one text after the other, and where those of each text begin (and the last end)."""
    parted = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    found = parted.values.cast(pa.binary())
    real = pc.greater(pc.binary_length(found), 0)  # white space at a text's edges leaves empty words
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return found.filter(real), before[parted.offsets.to_numpy()]


def bucket(word: bytes, buckets: int) -> int:
    return crc32(word[-3:]) % buckets


def bucket_array(words: pa.Array, buckets: int) -> np.ndarray:
    """``bucket`` of many words."""
    ends = pc.binary_slice(words, -3).dictionary_encode()
    return np.array([bucket(e, buckets) for e in ends.dictionary.to_pylist()], dtype=np.int64)[ends.indices.to_numpy()]


def looked_up(words: pa.Array, keys: pa.Array, values: np.ndarray, default: float) -> np.ndarray:
    """The value of each word's key; the default for words without one."""
    at = pc.index_in(words, value_set=keys).fill_null(len(keys)).to_numpy()
    return np.append(values, default)[at]


def sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1.0 / (1.0 + np.exp(-x))


def add_rows(total: np.ndarray, at: np.ndarray, rows: np.ndarray, span: int = 32) -> None:
    """Adds each row to the total's row ``at``, which doesn't fall; ``span`` rows of the total take theirs at once."""
    edges = np.searchsorted(at, np.arange(0, len(total) + span, span)).tolist()
    which = np.zeros((len(at), span), dtype=rows.dtype)
    which[np.arange(len(at)), at % span] = 1
    for first, (lo, hi) in enumerate(zip(edges, edges[1:])):
        if lo < hi:
            to = total[first * span:(first + 1) * span]
            to += (which[lo:hi].T @ rows[lo:hi])[:len(to)]


class Symbols:
    """Numbers of the network's symbols: the end, frequent words, buckets; by falling frequency."""

    def __init__(self, words: list[tuple[bytes, int]], bucket_mass: list[int], ends: int, size: int):
        masses = [(ends, 0, b"", None), *((c, 1, w, w) for w, c in words),
                  *((m, 2, b"%d" % b, b) for b, m in enumerate(bucket_mass))]
        order = [masses[0], *sorted(masses[1:], key=lambda x: (-x[0], x[1], x[2]))]
        self.frequent = {x[3]: i for i, x in enumerate(order) if x[1] == 1}
        self.bucket = np.zeros(len(bucket_mass), dtype=np.int32)
        for i, x in enumerate(order):
            if x[1] == 2:
                self.bucket[x[3]] = i
        self.bucket_mass = np.array(bucket_mass, dtype=np.float64) + 1  # one unit for unseen words
        self.classes = -(-len(order) // size)
        self.size = size
        mass = np.zeros(self.classes * size)
        mass[:len(order)] = [x[0] + 1.0 for x in order]
        self.mass = mass.reshape(self.classes, size)  # 0: a place without a symbol

    def number(self, word: bytes) -> int:
        got = self.frequent.get(word)
        return int(self.bucket[bucket(word, len(self.bucket))]) if got is None else got

    def numbers(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``number`` of many words, whether each is one of a bucket's, and its bucket."""
        own = np.array(list(self.frequent.values()), dtype=np.int64)
        at = looked_up(words, pa.array(list(self.frequent), pa.binary()), own, -1).astype(np.int64)
        buckets = bucket_array(words, len(self.bucket))
        return np.where(at < 0, self.bucket[buckets], at).astype(self.kind()), at < 0, buckets

    def kind(self) -> str:
        """The type of a stored symbol."""
        return "<u2" if self.mass.size <= 1 << 16 else "<u4"


class Network:
    """A GRU with a class-factored softmax, in numpy."""

    NAMES = ("Wx", "U", "Wc", "bc", "Wo", "bo")

    def __init__(self, symbols: Symbols, hidden: int = 32, seed: int = 1):
        rng = np.random.default_rng(seed)
        n = symbols.classes * symbols.size
        f = np.float32
        self.hidden, self.size = hidden, symbols.size
        self.Wx = (rng.standard_normal((n, 3 * hidden)) * 0.1).astype(f)
        self.U = (rng.standard_normal((hidden, 3 * hidden)) / math.sqrt(hidden)).astype(f)
        self.Wc = (rng.standard_normal((hidden, symbols.classes)) * 0.05).astype(f)
        self.Wo = (rng.standard_normal((symbols.classes, hidden, symbols.size)) * 0.05).astype(f)
        # Start at the training frequencies.
        totals = symbols.mass.sum(axis=1)
        self.bc = np.log(totals / totals.sum()).astype(f)
        with np.errstate(divide="ignore"):
            self.bo = np.log(symbols.mass / totals[:, None]).astype(f)
        self.bo[~np.isfinite(self.bo)] = -30.0

    def weights(self) -> dict[str, np.ndarray]:
        return {n: getattr(self, n) for n in self.NAMES}

    def step(self, h: np.ndarray, inputs: np.ndarray):
        """The next states, and what backpropagation needs."""
        k = self.hidden
        x, g = self.Wx[inputs], h @ self.U
        zr = sigmoid(x[:, :2 * k] + g[:, :2 * k])
        z, r = zr[:, :k], zr[:, k:]
        n = 2.0 * sigmoid(2.0 * (x[:, 2 * k:] + r * g[:, 2 * k:])) - 1.0
        return n + z * (h - n), (h, z, r, n, g[:, 2 * k:])

    def apart(self) -> tuple[np.ndarray, np.ndarray]:
        """What ``unrolled`` reads of the weights: those of the gates (update, reset) and of the inner sum, each by itself.

        The logistic function is tanh of half its argument, so the halves are in the weights."""
        k = self.hidden
        by = np.array([[[0.5]], [[0.5]], [[1.0]]], dtype=self.U.dtype)
        return self.U.reshape(k, 3, k).swapaxes(0, 1) * by, self.Wx.reshape(-1, 3, k).swapaxes(0, 1) * by

    def unrolled(self, h: np.ndarray, inputs: np.ndarray, apart: tuple, keep: bool = False):
        """The states after each input of a window, (steps, lanes); where an end is read, the state before it is zero.

        With ``keep``, also what backpropagation needs: the steps with ends, the states before,
        (update, reset, inner) and the states' share of the inner sum."""
        (to, own), k, (steps, lanes) = apart, self.hidden, inputs.shape
        ends = inputs == END
        ending = ends.any(axis=1).tolist()
        x = np.empty((3, steps, lanes, k), dtype=own.dtype)
        for j in range(3):
            own[j].take(inputs, axis=0, out=x[j], mode="clip")
        states, g, through = np.empty_like(x[0]), np.empty_like(x[:, 0]), np.empty_like(x[0, 0])
        before, gn = (np.empty_like(states), np.empty_like(states)) if keep else (None, None)
        for t in range(steps):
            if ending[t]:
                h = h.copy()
                h[ends[t]] = 0
            np.matmul(h, to, out=g)
            zr, n = x[:2, t], x[2, t]
            zr += g[:2]
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            n += np.multiply(g[2], zr[1], out=through)
            np.tanh(n, out=n)
            if keep:
                before[t], gn[t] = h, g[2]
            h = np.subtract(h, n, out=states[t])
            h *= zr[0]
            h += n
        return (states, ends, ending, before, x, gn) if keep else states

    def softmax(self) -> tuple:
        """What ``output`` reads of the weights: whether exponentials are safe, and the softmaxes' matrices with their biases.

        The biases are the weights of one more state, always 1; three more, always 0, keep the matrices aligned."""
        # States lie in (-1, 1), so logits this small can't overflow an exponential.
        tame = max(np.abs(w).sum(axis=-2).max() + np.abs(b).max() for w, b in ((self.Wc, self.bc), (self.Wo, self.bo))) < 80
        return tame, np.vstack([self.Wc, self.bc, np.zeros((3, *self.bc.shape), self.Wc.dtype)]), np.concatenate(
            [self.Wo, self.bo[:, None], np.zeros((len(self.Wo), 3, self.size), self.Wo.dtype)], axis=1)

    def output(self, h: np.ndarray, targets: np.ndarray, grads: dict | None = None, ready: tuple | None = None):
        """Log probability of each target; with ``grads``, adds the gradients and returns that of h too.

        ``ready`` is ``softmax()``, where the weights stay the same for many calls."""
        tame, to_class, to_place = ready or self.softmax()
        k = self.hidden

        def exponentials(part, w):
            a = part @ w
            if not tame:
                a -= a.max(axis=1, keepdims=True)
            e = np.exp(a)
            return a, e, e @ ones[:e.shape[1]]

        def learn(part, e, total, places, back_w):
            """Gradients of the weights with their bias, and of the states."""
            e.reshape(-1)[places] -= total
            e *= (1 / total)[:, None]
            return part.T @ e, e @ back_w

        ones = np.ones(max(len(self.bc), self.size), dtype=to_class.dtype)
        order = np.argsort(targets // self.size, kind="stable")
        to = targets[order]
        cls, place = to // self.size, to % self.size
        part = np.zeros((len(h), k + 4), dtype=h.dtype)
        part[:, :k], part[:, k] = h.take(order, axis=0), 1
        rows = np.arange(len(h))
        a, e, total = exponentials(part, to_class)
        places = rows * len(self.bc) + cls
        logp = a.reshape(-1).take(places) - np.log(total)
        back = None
        if grads is not None:
            got, back = learn(part, e, total, places, self.Wc.T)
            grads["Wc"] += got[:k]
            grads["bc"] += got[k]
            back_place = np.ascontiguousarray(self.Wo.swapaxes(1, 2))
        edges = np.searchsorted(cls, np.arange(len(self.bc) + 1)).tolist()
        starts = rows * self.size
        for c, (lo, hi) in enumerate(zip(edges, edges[1:])):
            if lo == hi:
                continue
            a, e, total = exponentials(part[lo:hi], to_place[c])
            places = starts[:hi - lo] + place[lo:hi]
            logp[lo:hi] += a.reshape(-1).take(places) - np.log(total)
            if grads is not None:
                got, more = learn(part[lo:hi], e, total, places, back_place[c])
                grads["Wo"][c] += got[:k]
                grads["bo"][c] += got[k]
                back[lo:hi] += more
        out = np.empty_like(logp)
        out[order] = logp
        if grads is None:
            return out
        d = np.empty_like(back)
        d[order] = back
        return out, d

    def gradients(self, h: np.ndarray, inputs: np.ndarray, targets: np.ndarray, grads: dict | None = None):
        """(loss sum, gradients, last state) of one window; inputs and targets are (steps, lanes).

        ``grads``, all zero, takes the gradients.  All but the recurrence itself is
        done for the whole window at once."""
        k, (steps, lanes) = self.hidden, inputs.shape
        if grads is None:
            grads = {n: np.zeros_like(w) for n, w in self.weights().items()}
        states, ends, ending, before, x, gn = self.unrolled(h, inputs, self.apart(), keep=True)
        logp, back = self.output(states.reshape(-1, k), targets.ravel(), grads)
        back = back.reshape(steps, lanes, k)
        z, r, n = x
        # What a state's gradient is multiplied by to give those of the inner sum's share, of the gates, and of the inner sum.
        by = np.empty((4, *z.shape), dtype=x.dtype)
        share, to_z, to_r, inner = by
        np.multiply(n, n, out=to_z)
        np.subtract(1, to_z, out=to_z)
        rest = 1 - z
        np.multiply(rest, to_z, out=inner)
        np.multiply(inner, r, out=share)
        np.subtract(1, r, out=to_r)
        to_r *= share
        to_r *= gn
        np.subtract(before, n, out=to_z)
        to_z *= z
        to_z *= rest
        dg, carried = np.empty_like(by), np.zeros_like(states[0])
        through = np.empty((3, lanes, k), dtype=x.dtype)
        back_to = np.ascontiguousarray(self.U.reshape(k, 3, k)[:, [2, 0, 1]].transpose(1, 2, 0))
        for t in range(steps - 1, -1, -1):
            d = back[t]
            d += carried
            np.multiply(d, by[:, t], out=dg[:, t])
            np.matmul(dg[:3, t], back_to, out=through)
            np.multiply(d, z[t], out=carried)
            for j in range(3):
                carried += through[j]
            if ending[t]:
                carried[ends[t]] = 0
        before, dg = before.reshape(-1, k).T, dg.reshape(4, -1, k)
        for j in range(3):
            grads["U"][:, j * k:(j + 1) * k] += before @ dg[(j + 1) % 3]
        flat = inputs.ravel()
        order = np.argsort(flat, kind="stable")
        places = order[:, None] + np.arange(1, 4) * len(flat)  # a symbol's gradients of the gates and of the inner sum
        add_rows(grads["Wx"], flat[order], dg.reshape(-1, k).take(places, axis=0).reshape(-1, 3 * k))
        return -float(logp.sum(dtype=np.float64)), grads, states[-1]

    def train(self, stream: np.ndarray, *, lanes: int, steps: int, rate: float, decay_to: float = 0.2,
              begin: float = 0.0, end: float = 1.0) -> float:
        """One pass of truncated backpropagation over a symbol stream; returns the mean loss.

        The stream is the part from ``begin`` to ``end`` of a pass, over which the rate
        falls to ``decay_to`` of itself.  Every symbol is learnt; the first ones, fewer
        than ``lanes``, twice where the lanes don't come out even."""
        length = -(-len(stream) // lanes)
        if not length:
            return float("nan")
        targets = np.ascontiguousarray(np.resize(stream, length * lanes).reshape(lanes, length).T)
        inputs = np.vstack([np.full((1, lanes), END, dtype=targets.dtype), targets[:-1]])
        # All matrices in one array, as are their gradients.
        names, sizes = self.NAMES, [getattr(self, n).size for n in self.NAMES]
        edges = np.cumsum([0, *sizes])
        w = np.concatenate([getattr(self, n).ravel() for n in names])
        g, m, v, a = (np.zeros_like(w) for _ in range(4))
        grads = {}
        for n, lo, hi in zip(names, edges, edges[1:]):
            shape = getattr(self, n).shape
            setattr(self, n, w[lo:hi].reshape(shape))
            grads[n] = g[lo:hi].reshape(shape)
        h, loss, seen = np.zeros((lanes, self.hidden), dtype=w.dtype), 0.0, 0
        windows = range(0, length, steps)
        blocks = [tuple(x[lo:lo + BLOCK] for x in (w, g, m, v, a)) for lo in range(0, len(w), BLOCK)]
        for i, lo in enumerate(windows):
            part = targets[lo:lo + steps]
            g.fill(0)
            cost, _, h = self.gradients(h, inputs[lo:lo + steps], part, grads)
            loss, seen = loss + cost, seen + part.size
            now = rate * (decay_to + (1 - decay_to) * (1 - begin - (end - begin) * i / len(windows)))
            norm = math.sqrt(float(g @ g)) / part.size
            clip = min(1.0, 1.0 / max(norm, 1e-12)) / part.size
            # Adam; the means lack their factors 0.1 and 0.005, which are in the last steps.
            unit = math.sqrt(0.005 / (1 - 0.995 ** (i + 1)))
            step = now * 0.1 / (1 - 0.9 ** (i + 1)) / unit
            for bw, bg, bm, bv, ba in blocks:
                bg *= clip
                bm *= 0.9
                bm += bg
                bg *= bg
                bv *= 0.995
                bv += bg
                np.sqrt(bv, out=ba)
                ba += 1e-7 / unit
                np.divide(bm, ba, out=ba)
                ba *= step
                bw -= ba
        return loss / max(seen, 1)

    def score(self, documents: list[np.ndarray], *, lanes: int = 128, steps: int = 32) -> list[np.ndarray]:
        """Log probability of every symbol of whole documents, each of which ends with the end.

        Documents lie one after the other in ``lanes`` parallel streams; windows
        of ``steps`` symbols pass over all streams, each carrying on the states
        of the one before.
        """
        lanes = max(1, min(lanes, len(documents)))
        load = [(0, i) for i in range(lanes)]
        mine: list[list[int]] = [[] for _ in range(lanes)]
        for d in sorted(range(len(documents)), key=lambda i: -len(documents[i])):
            size, lane = heapq.heappop(load)
            mine[lane].append(d)
            heapq.heappush(load, (size + len(documents[d]), lane))
        mine = sorted((m for m in mine if m), key=lambda m: -sum(len(documents[d]) for d in m))
        order = [d for m in mine for d in m]
        if not order:
            return []
        flat = np.concatenate([documents[d] for d in order])
        before = np.concatenate([np.array([END], dtype=flat.dtype), flat[:-1]])
        sizes = np.array([sum(len(documents[d]) for d in m) for m in mine])
        offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        before[offsets] = END
        logp = np.empty(len(flat), dtype=np.float32)
        h = np.zeros((len(mine), self.hidden), dtype=self.U.dtype)
        apart, ready = self.apart(), self.softmax()
        for lo in range(0, int(sizes[0]), steps):
            live = int(np.searchsorted(-sizes, -lo))  # streams longer than lo come first
            t = np.arange(lo, min(lo + steps, int(sizes[0])))[:, None]
            at = np.minimum(offsets[:live] + t, len(flat) - 1)
            states = self.unrolled(h[:live], before[at], apart)
            h = states[-1]
            real = (t < sizes[:live]).ravel()  # streams end within the window
            at, states = at.ravel(), states.reshape(-1, self.hidden)
            if not real.all():
                at, states = at[real], states[real]
            logp[at] = self.output(states, flat[at], ready=ready)
        out: list = [None] * len(documents)
        at = 0
        for d in order:
            out[d] = logp[at:at + len(documents[d])]
            at += len(documents[d])
        return out


def word_counts(train: DataFrame) -> DataFrame:
    """(word, c) of all words of the training texts; the null word is the end."""
    def run(batches):
        held, size, ends = [], 0, 0

        def rows():
            found = pa.chunked_array(held, pa.binary()).value_counts()
            return pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], names=["word", "c"])

        for b in batches:
            words, _ = words_of(b.column("text"))
            held.append(words)
            size, ends = size + words.nbytes, ends + b.num_rows
            if size > FLUSH:
                yield rows()
                held, size = [], 0
        yield rows()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.binary()), pa.array([ends], pa.int64())], names=["word", "c"])

    return train.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _commonest(words: DataFrame, most: int) -> dict[bytes, int]:
    """Counts of the words from the least count on at which there are no more than ``most``."""
    held, least = 0, None
    for r in words.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).limit(most).collect():
        held += r["n"]
        if held > most:
            break
        least = r["c"]
    return {} if least is None else {bytes(r["word"]): r["c"] for r in words.where(F.col("c") >= least).collect()}


def _bucket_column(word: Column, buckets: int) -> Column:
    return F.crc32(F.substring(word, -3, 3)) % buckets


def _encoded(train: DataFrame, symbols: Symbols, shards: int) -> DataFrame:
    """(shard, data): the symbols of all training rows, a row a shard; copies of a row are dealt one by one."""
    kind, shared = symbols.kind(), train.sparkSession.sparkContext.broadcast(symbols)

    def run(batches):
        end = np.array([END], dtype=kind).tobytes()
        for b in batches:
            words, edges = words_of(b.column("text"))
            coded = words.dictionary_encode()
            stream = shared.value.numbers(coded.dictionary)[0][coded.indices.to_numpy()]
            data = [stream[lo:hi].tobytes() + end for lo, hi in zip(edges, edges[1:])]
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(data, pa.binary())], names=["key", "data"])

    def joined(key, rows):
        by = sorted(zip(rows.column("key").to_pylist(), rows.column("data").to_pylist()))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "data": pa.array([b"".join(d for _, d in by)], pa.binary())})

    key = F.xxhash64("doc_id", "text", F.monotonically_increasing_id(), F.lit(5)).alias("key")
    return checkpointed(
        train.select(key, "text").mapInArrow(run, "key long, data binary")
        .groupBy(F.pmod("key", F.lit(shards)).alias("shard")).applyInArrow(joined, "shard long, data binary"))


def _fit_part(shared, begin: float, end: float, *, lanes: int, steps: int, rate: float, updates: int = 256):
    """Trains on a part of each shard, from the same weights; returns the weights.

    Short parts have fewer lanes, for ``updates`` updates where 8 lanes allow."""
    def fit(batches):
        symbols, start = shared.value
        for b in batches:
            for shard, data in zip(b.column("shard").to_pylist(), b.column("data")):
                stream = np.frombuffer(data.as_buffer(), dtype=symbols.kind())
                part = stream[int(len(stream) * begin):int(len(stream) * end)]
                network = copy(start)  # the worker's other shards begin with the same weights
                if len(part):
                    network.train(part, lanes=min(lanes, max(8, len(part) // (steps * updates)), len(part)), steps=steps, rate=rate,
                                  begin=begin, end=end)
                weights = network.weights()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(weights)), pa.array([w.tobytes() for w in weights.values()], pa.binary()),
                     pa.array([len(part)] * len(weights), pa.int64()), pa.array([shard] * len(weights), pa.int64()),
                     pa.array([False] * len(weights))], names=["name", "data", "size", "shard", "summed"])

    return fit


def _averaged(fitted: DataFrame, shards: int, fan_in: int = 16) -> DataFrame:
    """(name, data, size): the shards' weights added up, each times its size, in groups of ``fan_in`` at a time.

    No task holds more than ``fan_in`` networks, nor does the driver."""
    def add(key, rows):
        total, size = None, 0
        for data, n, done in zip(rows.column("data").to_pylist(), rows.column("size").to_pylist(), rows.column("summed").to_pylist()):
            w = np.frombuffer(data, dtype=np.float64 if done else np.float32).astype(np.float64)
            w = w if done else w * n
            total, size = (w if total is None else total + w), size + n
        return pa.table({"name": pa.array([key[0].as_py()]), "shard": pa.array([key[1].as_py()], pa.int64()),
                         "data": pa.array([total.tobytes()], pa.binary()), "size": pa.array([size], pa.int64()),
                         "summed": pa.array([True])})

    while True:
        shards = -(-shards // fan_in)
        fitted = (fitted.withColumn("shard", F.floor(F.col("shard") / fan_in).cast("long"))
                  .groupBy("name", "shard").applyInArrow(add, "name string, shard long, data binary, size long, summed boolean"))
        if shards == 1:
            return fitted.select("name", "data", "size")


def _train(train: DataFrame, symbols: Symbols, network: Network, *, shards: int, rounds: int,
           lanes: int, steps: int, rate: float) -> Network:
    """Fit on all training documents, once: shards in parallel, weights averaged after each round.

    Each round's part of the shards is as large as all parts before it."""
    shard = _encoded(train, symbols, shards)
    context = train.sparkSession.sparkContext
    schema = "name string, data binary, size long, shard long, summed boolean"
    edges = [0.0, *(0.5 ** r for r in reversed(range(rounds)))]
    for begin, end in zip(edges, edges[1:]):
        fitted = shard.mapInArrow(_fit_part(
            context.broadcast((symbols, network)), begin, end, lanes=lanes, steps=steps, rate=rate), schema)
        network = copy(network)
        for row in _averaged(fitted, shards).collect():  # one row a matrix
            old = getattr(network, row["name"])
            if row["size"]:
                total = np.frombuffer(row["data"], dtype=np.float64).reshape(old.shape)
                setattr(network, row["name"], (total / row["size"]).astype(np.float32))
    return network


def score_texts(docs: DataFrame, held_out: Column, *, id_col: str = "doc_id", text_col: str = "text",
                frequent: int = 1024, buckets: int = 1024, class_size: int = 64, hidden: int = 32,
                common_words: int = 100_000, shard_tokens: int = 4_000_000, few_tokens: int = 250_000, rounds: int = 3,
                lanes: int = 128, steps: int = 32,
                rate: float = 0.02, chunk_bytes: int = 12_000_000) -> DataFrame:
    """Score every whole text; learn from the rows where ``held_out`` is false.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one
    unigram) and score (the network's), both as log10 probabilities.  The network
    learns from all training documents, in shards of about ``shard_tokens``; small
    corpora have up to 8 shards of ``few_tokens`` or more.  Documents are dealt by hash to chunks of about
    ``chunk_bytes`` of text; each chunk is joined with the training counts of the
    words it holds, but for the ``common_words`` commonest, whose counts are
    broadcast.  A chunk that repeated rows make larger is dealt on row by row.
    """
    kept = text_docs(docs, id_col=id_col, text_col=text_col, held_out=held_out)
    train = kept.where(~F.col("held_out"))
    counts = checkpointed(word_counts(train))
    totals = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v"),
                        F.max(F.when(F.col("word").isNull(), F.col("c"))).alias("ends")).first()
    n, ends = totals["n"] or 0, totals["ends"] or 0
    v = totals["v"] if ends else 0
    words = counts.where("word IS NOT NULL")
    top = [(bytes(r["word"]), r["c"]) for r in words.orderBy(F.desc("c"), "word").limit(frequent).collect()]
    mass = [0] * buckets
    for r in words.groupBy(_bucket_column(F.col("word"), buckets).alias("b")).agg(F.sum(F.col("c") + 1).alias("m")).collect():
        mass[r["b"]] = r["m"]
    for w, c in top:
        mass[bucket(w, buckets)] -= c + 1
    symbols = Symbols(top, mass, ends, class_size)
    network = Network(symbols, hidden)
    if n:
        network = _train(train, symbols, network, shards=max(1, math.ceil(n / shard_tokens), min(8, n // few_tokens)),
                         rounds=rounds, lanes=lanes, steps=steps, rate=rate)
    # Words that nearly every chunk holds are told to all tasks, not joined chunk by chunk.
    common = _commonest(words, common_words) | dict(top)
    shared = docs.sparkSession.sparkContext.broadcast(
        (symbols, network, pa.array(list(common), pa.binary()), np.array(list(common.values()), dtype=np.float64)))

    size = kept.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    chunks = max(1, math.ceil(size / chunk_bytes))
    dealt = kept.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))

    def rare(batches):
        for b in batches:
            words, edges = words_of(b.column("text"))
            coded = words.dictionary_encode()
            held, code = coded.dictionary, coded.indices.to_numpy()
            rare = pc.invert(pc.is_in(held, value_set=shared.value[2])).to_numpy(zero_copy_only=False)[code]
            chunk = np.repeat(b.column("chunk").to_numpy(), np.diff(edges))[rare]
            each = np.unique(chunk * len(held) + code[rare])
            chunk, code = np.divmod(each, max(1, len(held)))
            yield pa.RecordBatch.from_arrays([pa.array(chunk, pa.int64()), held.take(pa.array(code, pa.int64()))], names=["chunk", "word"])

    # Chunks of several times their size hold many copies of a row: at most one for each ``3 * chunk_bytes`` of text.
    large = (dealt.groupBy("chunk").agg(F.sum(F.octet_length("text") + 16).alias("n")).where(F.col("n") > 3 * chunk_bytes)
             .select("chunk", F.ceil(F.col("n") / chunk_bytes).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    dealt = (dealt.join(F.broadcast(large), "chunk", "left")
             .withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), parts).cast("int")).drop("parts"))
    seen = (kept.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks))).select("chunk", "text")
            .mapInArrow(rare, "chunk long, word binary")  # a word once a batch; a chunk's table takes it once
            .join(words, "word").select("chunk", "word", "c")
            .join(F.broadcast(large), "chunk", "left")
            .select("chunk", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "word", "c"))
    log_total = math.log10(n + v + 1)
    counted_end = ends

    def score(key, rows, found):
        symbols, network, common, common_counts = shared.value
        words, edges = words_of(rows.column("text").combine_chunks())
        coded = words.dictionary_encode()
        held, lengths = coded.dictionary, np.diff(edges) + 1
        size = len(held) + 1  # the last place is the end's
        at = np.full(int(lengths.sum()), size - 1, dtype=np.int64)
        at[np.arange(len(words)) + np.repeat(np.arange(len(lengths)), lengths - 1)] = coded.indices.to_numpy()
        number, c, extra = np.full(size, END, dtype=symbols.kind()), np.full(size, float(counted_end)), np.zeros(size)
        c[:-1] = looked_up(held, common, common_counts, 0) + looked_up(
            held, found.column("word").combine_chunks(), found.column("c").to_numpy().astype(np.float64), 0)
        number[:-1], rare, b = symbols.numbers(held)
        extra[:-1] = np.where(rare, np.log10((c[:-1] + 1) / symbols.bucket_mass[b]), 0.0)
        base = np.log10(c + 1) - log_total
        whole = np.split(at, np.cumsum(lengths)[:-1]) if len(lengths) else []
        logp = network.score([number[t] for t in whole])
        return pa.table({
            "doc_id": rows.column("doc_id"), "held_out": rows.column("held_out"),
            "n_tokens": pa.array(lengths, pa.int64()),
            "n_known": pa.array([int((c[t] > 0).sum()) for t in whole], pa.int64()),
            "train_tokens": pa.array([n] * len(whole), pa.int64()),
            "base_score": pa.array([float(base[t].sum()) for t in whole], pa.float64()),
            "score": pa.array([float(p.sum(dtype=np.float64)) / math.log(10) + float(extra[t].sum())
                               for p, t in zip(logp, whole)], pa.float64())})

    return dealt.groupBy("chunk", "part").cogroup(seen.groupBy("chunk", "part")).applyInArrow(score, SCORES)
