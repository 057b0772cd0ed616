"""Language-model scores of whole documents.

Method: a gated recurrent network, trained by truncated backpropagation in numpy. Its output softmax is factored
by classes of words (a class, then a word in it), and the state is carried from window to window, so a score is
the log-likelihood of the complete document however long.

Words outside the network's vocabulary are one class symbol there, times the add-one share of the word among all
such words. Word counts cover all training tokens. Counts of frequent words (at most ``head``) go to the tasks;
the occurrences of all others meet their counts in a join, so the vocabulary may grow without bound.

Texts become arrays of network ids once. Training is data-parallel: in each round a number of tasks that follows
from the corpus's tokens, not from its partitions, train copies of the network on one share of the training rows
(another share in each round), and the copies are averaged. The driver sees only the model. There are as many
shares as rounds, so every training document gives gradients, once.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_remainder, materialize, text_bytes

_LONGEST_HEAD_WORD = 64
#: States that go through the softmax over classes at once, so that they stay in the processor's cache.
_BLOCK = 1024
#: Positions that scoring takes in a window, or more.
_WINDOW = 1 << 15
#: Bytes of texts whose words are told apart at once.
_PART = 16 << 20


@dataclass(frozen=True)
class Shape:
    """Sizes of the network: ids 0 end, 1 any other word, then the most frequent words."""

    words: int
    width: int = 16
    hidden: int = 16

    def parts(self, classes: int) -> dict[str, tuple[int, ...]]:
        h = self.hidden
        return {"embed": (self.words, self.width), "wx": (self.width, 3 * h), "wh": (h, 3 * h), "b": (3 * h,), "c": (h, classes), "cb": (classes,), "o": (self.words, h), "ob": (self.words,)}


def class_bounds(counts: np.ndarray, classes: int) -> np.ndarray:
    """Ids cut into runs of about equal sums of square-rooted counts; ids must be dense and frequent first."""
    mass = np.sqrt(counts + 1.0)
    n = min(classes, len(counts))
    edge = np.searchsorted(np.cumsum(mass) / mass.sum(), np.arange(1, n) / n) + 1
    return np.unique(np.concatenate([[0], edge, [len(counts)]]))


class Network:
    """A gated recurrent network with a class-factored softmax. Ids are of the class order, frequent first."""

    def __init__(self, shape: Shape, bounds: np.ndarray, params: dict[str, np.ndarray]):
        self.shape, self.bounds, self.p = shape, bounds, params
        self.class_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))

    @classmethod
    def fresh(cls, shape: Shape, counts: np.ndarray, classes: int, seed: int = 11) -> Network:
        """Random weights; the biases of the softmax are those of the unigram distribution."""
        bounds = class_bounds(counts, classes)
        rng = np.random.default_rng(seed)
        p = {k: (rng.standard_normal(s) * (0.1 if len(s) == 2 else 0)).astype(np.float32) for k, s in shape.parts(len(bounds) - 1).items()}
        share = counts + 1.0
        sums = np.add.reduceat(share, bounds[:-1])
        p["cb"] = np.log(sums / sums.sum()).astype(np.float32)
        p["ob"] = np.log(share / np.repeat(sums, np.diff(bounds))).astype(np.float32)
        return cls(shape, bounds, p)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in self.shape.parts(len(self.bounds) - 1)])

    def with_flat(self, values: np.ndarray) -> Network:
        out, at = {}, 0
        for k, s in self.shape.parts(len(self.bounds) - 1).items():
            n = math.prod(s)
            out[k], at = values[at : at + n].reshape(s).astype(np.float32), at + n
        return Network(self.shape, self.bounds, out)

    def inputs(self) -> np.ndarray:
        """What each input word gives to the gates; the sigmoids' part is negated, as their exp takes it."""
        p, n = self.p, self.shape.hidden
        table = p["embed"] @ p["wx"] + p["b"]
        np.negative(table[:, : 2 * n], out=table[:, : 2 * n])
        return table

    def states(self, x: np.ndarray, h: np.ndarray, alive: np.ndarray | None = None, fresh: np.ndarray | None = None, keep: list | None = None, table: np.ndarray | None = None):
        """States after each of the inputs x (steps, rows) from h; rows after ``alive[t]`` are left out at step t.

        fresh: a text begins, so its state is zero. ``keep`` collects what backpropagation needs, a line for each unit,
        as all is inside a step: there a gate's part is one piece of memory. table: that of ``inputs``.
        """
        p, n = self.p, self.shape.hidden
        table = self.inputs() if table is None else table
        wh = p["wh"].T.copy()
        np.negative(wh[: 2 * n], out=wh[: 2 * n])
        out = np.empty((*x.shape, n), table.dtype)
        h = np.ascontiguousarray(h.T, table.dtype)
        for t in range(len(x)):
            k = h.shape[1] if alive is None else int(alive[t])
            if k < h.shape[1]:
                h = h[:, :k].copy()
            if fresh is not None and fresh[t].any():
                h = h * ~fresh[t]
            a = table.take(x[t, :k], axis=0).T.copy()
            u = wh @ h
            g, c, un = a[: 2 * n], a[2 * n :], u[2 * n :]
            g += u[: 2 * n]
            np.exp(g, out=g)
            g += 1
            np.reciprocal(g, out=g)
            z, r = g[:n], g[n:]
            c += r * un
            np.tanh(c, out=c)
            new = h - c
            new *= z
            new += c
            if keep is not None:
                keep.append((h, un, z, r, c))
            out[t, :k] = new.T
            h = new
        return out, h.T

    def log_probabilities(self, h: np.ndarray, y: np.ndarray, grads: dict | None = None):
        """Natural log of P(class) P(word in class) for states h (m, hidden) and ids y; with grads also d(-log p)/dh."""
        p = self.p
        # states lie in -1..1, so only a degenerate model comes near the limit of exp
        steep = max(float((np.abs(w).sum(axis) + np.abs(b)).max()) for w, b, axis in ((p["c"], p["cb"], 0), (p["o"], p["ob"], 1))) > 60
        order = np.argsort(y.astype(np.uint16) if self.shape.words <= 1 << 16 else y, kind="stable")
        k = self.class_of[y]
        h, y, k = h[order], y[order], k[order]
        h1 = np.concatenate([h, np.ones((len(h), 1), h.dtype)], 1)  # the last column takes the biases
        c1 = np.concatenate([p["c"], p["cb"][None]])
        o1 = np.concatenate([p["o"], p["ob"][:, None]], 1)
        ones = np.ones(len(self.bounds) - 1, np.float32)
        many = np.ones(len(p["o"]), np.float32)
        rows = np.arange(len(y))
        kind = np.result_type(h, p["c"])
        out = np.empty(len(y), kind)
        if grads is None:
            dh = None
        else:
            dh, dc, do = np.empty(h.shape, kind), np.zeros(c1.T.shape, kind), np.zeros(o1.shape, kind)
        block = np.empty((min(_BLOCK, len(y)), len(ones)), kind)
        for i in range(0, len(y), _BLOCK):
            hb, kb, line = h1[i : i + _BLOCK], k[i : i + _BLOCK], rows[: min(_BLOCK, len(y) - i)]
            e = np.matmul(hb, c1, out=block[: len(hb)])
            if steep:
                np.clip(e, -60, 60, out=e)
            own = e[line, kb]
            np.exp(e, out=e)
            s = e @ ones
            np.subtract(own, np.log(s), out=out[i : i + _BLOCK])
            if grads is not None:
                # the softmax's numbers aren't scaled one by one: its states are, and what they give
                inverse = (1 / s)[:, None]
                dc += e.T @ (hb * inverse)
                np.matmul(e, p["c"].T, out=dh[i : i + _BLOCK])
                dh[i : i + _BLOCK] *= inverse
        cut = np.searchsorted(k, np.arange(len(self.bounds)))
        place = y - self.bounds[k]
        for c in np.flatnonzero(np.diff(cut)).tolist():
            a, b = int(self.bounds[c]), int(self.bounds[c + 1])
            if b - a == 1:
                continue
            i, j = int(cut[c]), int(cut[c + 1])
            hc = h1[i:j]
            scores = hc @ o1[a:b].T
            if steep:
                np.clip(scores, -60, 60, out=scores)
            out[i:j] += scores[rows[: j - i], place[i:j]]
            e = np.exp(scores, out=scores)
            s = e @ many[: b - a]
            out[i:j] -= np.log(s)
            if grads is not None:
                inverse = (1 / s)[:, None]
                np.matmul(e.T, hc * inverse, out=do[a:b])
                more = e @ p["o"][a:b]
                more *= inverse
                dh[i:j] += more
        if grads is not None and len(y):
            # what comes of the words themselves, which stand in a row
            first = np.flatnonzero(np.diff(y, prepend=-1))
            words = y[first]
            own = np.add.reduceat(h1, first)
            alone = np.diff(self.bounds)[k] == 1
            dh -= p["c"].T[k]
            dh -= np.where(alone[:, None], 0, p["o"][y]) if alone.any() else p["o"][y]
            present = np.flatnonzero(np.diff(cut))
            dc[present] -= np.add.reduceat(own, np.searchsorted(words, self.bounds[present]))
            do[words] -= np.where(alone[first][:, None], 0, own)
            grads["c"] += dc[:, :-1].T
            grads["cb"] += dc[:, -1]
            grads["o"] += do[:, :-1]
            grads["ob"] += do[:, -1]
        back = np.empty_like(order)
        back[order] = rows
        return out[back], dh if dh is None else dh[back]

    def gradients(self, x: np.ndarray, y: np.ndarray, fresh: np.ndarray, h: np.ndarray):
        """(gradients of the mean loss, last state, sum of log p) for a window (steps, rows); fresh: a text begins.

        Backpropagation ends at the window's start.
        """
        p, n = self.p, self.shape.hidden
        grads = {k: np.zeros_like(v) for k, v in p.items()}
        kept: list = []
        hs, h = self.states(x, h, fresh=fresh, keep=kept)
        m = y.size
        logs, dh = self.log_probabilities(hs.reshape(m, n), y.ravel(), grads)
        dh = dh.reshape(*x.shape, n)
        back = np.zeros((n, len(h)), dh.dtype)
        # a line for each unit of four parts: candidate within the reset gate, update gate, reset gate, candidate
        parts = np.empty((len(x), 4 * n, len(h)), dh.dtype)
        wh = np.concatenate([p["wh"][:, 2 * n :], p["wh"][:, : 2 * n]], 1)
        dwh = np.zeros_like(wh)
        for t in range(len(x) - 1, -1, -1):
            old, un, z, r, c = kept[t]
            own = parts[t]
            du, dz, dr, dc = own[:n], own[n : 2 * n], own[2 * n : 3 * n], own[3 * n :]
            back += dh[t].T
            rest = 1 - z
            np.multiply(back, rest, out=dc)
            np.subtract(old, c, out=dz)
            dz *= back
            dz *= z
            dz *= rest
            c *= c
            np.subtract(1, c, out=c)
            dc *= c
            np.multiply(dc, r, out=du)
            np.multiply(du, un, out=dr)
            dr *= np.subtract(1, r, out=r)
            back *= z
            back += wh @ own[: 3 * n]
            if fresh[t].any():
                back *= ~fresh[t]
            dwh += old @ own[: 3 * n].T
        grads["wh"] += np.concatenate([dwh[:, n:], dwh[:, :n]], 1)
        flat = parts[:, n:].transpose(1, 0, 2).reshape(3 * n, m)
        inputs = x.ravel()
        grads["b"] += flat.sum(1)
        order = np.argsort(inputs.astype(np.uint16) if self.shape.words <= 1 << 16 else inputs, kind="stable")
        ids, first = np.unique(inputs[order], return_index=True)
        by_word = np.add.reduceat(flat.take(order, axis=1), first, axis=1).T.copy()  # what each input word's projection gets
        grads["wx"] += p["embed"][ids].T @ by_word
        grads["embed"][ids] += by_word @ p["wx"].T
        return {k: g / m for k, g in grads.items()}, h, float(logs.sum())


class Trainer:
    """Adam over windows of parallel streams; the state of a stream is carried over windows."""

    def __init__(self, network: Network, streams: int = 768, steps: int = 16, rate: float = 0.01):
        self.net = Network(network.shape, network.bounds, {k: v.copy() for k, v in network.p.items()})
        self.streams, self.steps, self.rate = streams, steps, rate
        self.m = {k: np.zeros_like(v) for k, v in self.net.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.net.p.items()}
        self.t = self.tokens = 0
        self.loss = 0.0

    def train(self, ids: np.ndarray) -> None:
        """ids: whole texts after each other, each with its end (0)."""
        if not len(ids):
            return
        rows = max(1, min(self.streams, len(ids) // self.steps))
        length, longer = divmod(len(ids), rows)  # the first rows have one more, which is a last window of its own
        at = np.arange(rows) * length + np.minimum(np.arange(rows), longer) + np.arange(length)[:, None]
        before = np.concatenate([[0], ids[:-1]])
        windows = [at[a : a + self.steps] for a in range(0, length, self.steps)] + ([at[-1:, :longer] + 1] if longer else [])
        h = np.zeros((rows, self.net.shape.hidden), np.float32)
        for w in windows:
            xs, ys = before[w], ids[w]
            h = h[: w.shape[1]]
            grads, h, logs = self.net.gradients(xs, ys, xs == 0, h)
            self.t += 1
            size = math.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            scale = min(1.0, 1.0 / (size + 1e-9))
            rate = self.rate * math.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t) / math.sqrt(1 + self.t / 500)
            for k, g in grads.items():
                g *= scale
                self.m[k] += 0.1 * (g - self.m[k])
                self.v[k] += 0.001 * (g * g - self.v[k])
                self.net.p[k] -= rate * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)
            self.tokens += ys.size
            self.loss -= logs


def score_texts(net: Network, texts: list[np.ndarray], window: int = 32, rows: int = 1024) -> np.ndarray:
    """Natural log-likelihood of each id array (its end included); the state is carried from window to window.

    Texts of like length go together, ``rows`` at a time. A window has at least ``window`` steps, and more where few
    texts are left, so that long texts don't meet the softmax in crumbs.
    """
    order = np.argsort([-len(t) for t in texts], kind="stable")
    out, table = np.zeros(len(texts)), net.inputs()
    for a in range(0, len(order), rows):
        own = order[a : a + rows]
        out[own] = _score_alike(net, [texts[i] for i in own], window, table)
    return out


def _score_alike(net: Network, texts: list[np.ndarray], window: int, table: np.ndarray) -> np.ndarray:
    """``score_texts`` of a few texts, the longest first."""
    lengths = np.array([len(t) for t in texts], np.int64)
    out = np.zeros(len(texts))
    h = np.zeros((len(texts), net.shape.hidden), np.float32)
    flat = np.concatenate(texts)
    begins = np.cumsum(lengths) - lengths
    at = 0
    while at < lengths[0]:
        rows = int(np.searchsorted(-lengths, -at, "left"))  # longer than ``at``
        steps = int(min(max(window, _WINDOW // rows), lengths[0] - at))
        alive = np.searchsorted(-lengths, -(at + np.arange(steps)), "left")
        spots = begins[:rows] + at + np.arange(steps)[:, None]  # those past a text's end are left out below
        x = flat[np.clip(spots - 1, 0, len(flat) - 1)]
        if not at:
            x[0] = 0
        hs, h = net.states(x, h[:rows], alive, table=table)
        inside = np.arange(rows) < alive[:, None]
        logs, _ = net.log_probabilities(hs[inside], flat[spots[inside]])
        who = np.broadcast_to(np.arange(rows), inside.shape)[inside]
        out[:rows] += np.bincount(who, logs.astype(np.float64), rows)
        at += steps
    return out


def _parts(sizes: np.ndarray, limit: int):
    """Ranges of rows of about ``limit`` bytes or numbers, from the size of each row."""
    ends = np.cumsum(sizes)
    a, before = 0, 0
    while a < len(ends):
        z = max(a + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield a, z
        a, before = z, int(ends[z - 1])


def _sizes(texts: pa.Array) -> np.ndarray:
    return pc.binary_length(texts).to_numpy().astype(np.int64)


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(text, word) of all words of binary texts, in their order, as numbers; the distinct words. A-Z count as a-z."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.large_string() if pa.types.is_large_binary(texts.type) else pa.string())))
    coded = lists.flatten().dictionary_encode()
    code = coded.indices.to_numpy()
    row = np.repeat(np.arange(len(texts), dtype=np.int32), lists.value_lengths().to_numpy())
    words = coded.dictionary.view(texts.type)
    none = pc.index(words, pa.scalar(b"", texts.type)).as_py()  # beside white space at a text's begin or end
    if none >= 0:
        kept = code != none
        row, code = row[kept], code[kept]
    return row, code, words


def count_words(texts: DataFrame) -> DataFrame:
    """(word binary, n) over all rows of (text binary); the words of a few megabytes are added up before the shuffle."""

    def run(batches):
        for b in batches:
            texts = b.column(0)
            for a, z in _parts(_sizes(texts), _PART):
                _, code, words = _words(texts.slice(a, z - a))
                n = np.bincount(code, minlength=len(words))
                yield pa.RecordBatch.from_arrays([words.cast(pa.binary()), pa.array(n, pa.int64())], names=["word", "n"]).filter(pa.array(n > 0))

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Counts:
    """Word statistics of the training rows. head: word to rank; ``head_counts`` by rank; ``table``: all words."""

    table: DataFrame
    head: dict[bytes, int]
    head_counts: np.ndarray
    documents: int
    tokens: int
    distinct: int


def least_count(words: DataFrame, head: int) -> int:
    """The smallest count that at most ``head`` of the words (word, n) reach.

    Its range is cut into 1,024 parts again and again, so a few rounds of 1,024 numbers find it whatever the counts.
    """
    low, high, held = 1, (words.agg(F.max("n")).first()[0] or 0) + 1, 0  # held words have high or more
    while low < high:
        step = -(-(high - low) // 1024)
        part = F.floor((F.col("n") - low) / step)
        parts = words.where((F.col("n") >= low) & (F.col("n") < high)).groupBy(part.alias("part")).count().collect()
        for at, n in sorted(parts, reverse=True):
            if held + n > head:
                low, high = low + at * step, min(high, low + (at + 1) * step)
                break
            held += n
        else:
            return low
        if step == 1:
            return high
    return high


def corpus_counts(training: DataFrame, head: int) -> Counts:
    """Counts over all rows of (text binary). The head is every word from some count on, at most ``head`` words."""
    table = materialize(count_words(training), "words")
    documents = training.count()
    sums = table.agg(F.sum("n"), F.count("*")).first()
    tokens, distinct = (sums[0] or 0) + documents, sums[1] + (documents > 0)
    short = table.where(F.length("word") <= _LONGEST_HEAD_WORD)
    rows = sorted(short.where(F.col("n") >= least_count(short, head)).collect(), key=lambda r: (-r["n"], r["word"]))  # at most head
    return Counts(table, {bytes(r["word"]): i for i, r in enumerate(rows)}, np.array([r["n"] for r in rows], np.int64), documents, tokens, distinct)


def _vocabulary(counts: Counts, words: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(id of each head word, count of each id, total of the others): end is 0, others 1, then by frequency."""
    known = min(words - 2, len(counts.head_counts))
    ids = np.ones(len(counts.head_counts) + 1, np.int32)
    ids[:known] = np.arange(2, known + 2)
    inside = int(counts.head_counts[:known].sum())
    rest_tokens, rest_words = counts.tokens - counts.documents - inside, counts.distinct - (counts.documents > 0) - known
    return ids, np.concatenate([[counts.documents, rest_tokens], counts.head_counts[:known]]), float(rest_tokens + rest_words + 1)


def encode_documents(rows: DataFrame, counts: Counts, ids: np.ndarray, log_others: float) -> DataFrame:
    """Rows (id, held_out, key, row, text) as network ids, with the word statistics of their texts.

    ids: 16- or 32-bit numbers. head_log: sum of log10(count + 1) of head words; outside: log10 share of the words
    that are one symbol to the network. rare_words, rare_n: words outside the head, listed at the first row of a key
    in each part of a batch only.
    """
    head = pa.array(counts.head.keys(), pa.binary())
    logs = np.append(np.log10(counts.head_counts + 1.0), 0.0)
    kind = np.uint16 if len(ids) and int(ids.max()) < 1 << 16 else np.uint32

    def run(batches):
        names = ["id", "held_out", "key", "row", "ids", "n_tokens", "n_head", "head_log", "n_tail", "outside", "rare_words", "rare_n"]
        for b in batches:
            keys, texts = b.column(2).to_numpy(), b.column(4)
            for a, z in _parts(_sizes(texts), _PART):
                n = z - a
                row, code, words = _words(texts.slice(a, n))
                rank = pc.fill_null(pc.index_in(words, value_set=head.cast(words.type)), -1).to_numpy()[code]
                y, log, far = ids[rank], logs[rank], rank < 0
                numbers = np.zeros(len(row) + n, kind)  # an end (0) after each text
                numbers[np.arange(len(row)) + row] = y
                n_words, n_tail = np.bincount(row, minlength=n), np.bincount(row[far], minlength=n)
                foreign = y == 1
                outside = np.bincount(row[foreign], log[foreign] - log_others, n)
                once = np.zeros(n, bool)
                once[np.unique(keys[a:z], return_index=True)[1]] = True
                far &= once[row]
                pairs, times = np.unique(row[far].astype(np.int64) * len(words) + code[far], return_counts=True)
                at, rare = np.divmod(pairs, max(1, len(words)))
                ends = np.searchsorted(at, np.arange(n + 1)).astype(np.int32)
                columns = [b.column(i).slice(a, n) for i in range(4)]
                columns += [_binaries(numbers, n_words + 1), pa.array(n_words + 1, pa.int64()), pa.array(n_words - n_tail, pa.int64()), pa.array(np.bincount(row, log, n).astype(np.float64)), pa.array(n_tail, pa.int64()), pa.array(outside.astype(np.float64))]
                columns += [pa.ListArray.from_arrays(ends, words.take(pa.array(rare)).cast(pa.binary())), pa.ListArray.from_arrays(ends, pa.array(times, pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    own = rows.schema["id"].dataType.simpleString()
    schema = f"id {own}, held_out boolean, key long, row long, ids binary, n_tokens long, n_head long, head_log double, n_tail long, outside double, rare_words array<binary>, rare_n array<long>"
    return materialize(rows.select("id", "held_out", "key", "row", "text").mapInArrow(run, schema), "encoded")


def _binaries(numbers: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The numbers, cut into binary values of so many each."""
    ends = np.concatenate([[0], np.cumsum(lengths) * numbers.itemsize]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(numbers)])


def _arrays(column: pa.Array, words: int) -> list[np.ndarray]:
    kind = np.uint16 if words <= 1 << 16 else np.uint32
    return [np.frombuffer(x, kind).astype(np.int32) for x in column.to_pylist()]


def average_round(training: DataFrame, net: Network, copies: int, part_tokens: int = 1 << 20) -> Network:
    """One round over rows (row, ids), dealt to ``copies`` copies of the network; the mean of the copies by tokens.

    A copy takes its rows, and a sum its copies, in the order of their keys, so neither the partitions of the table nor
    a task that runs again changes a result. Parameters travel as slices of 4,096 numbers that are added up in a stream,
    so no task holds many copies.
    """

    def trained(copy: int, trainer: Trainer, held: list):
        if held:
            trainer.train(np.concatenate(held))
        values = trainer.net.flat()
        slices = [values[i : i + 4096].tobytes() for i in range(0, len(values), 4096)]
        return pa.RecordBatch.from_arrays([pa.array(np.arange(len(slices)), pa.int32()), pa.array([copy] * len(slices), pa.int32()), pa.array([trainer.tokens] * len(slices), pa.int64()), pa.array(slices, pa.binary())], names=names)

    def run(batches):
        own, trainer, held, size = None, None, [], 0
        for b in batches:
            for copy, x in zip(b.column(0).to_pylist(), _arrays(b.column(1), net.shape.words), strict=True):
                if copy != own:
                    if trainer:
                        yield trained(own, trainer, held)
                    own, trainer, held, size = copy, Trainer(net), [], 0
                held.append(x)
                size += len(x)
                if size >= part_tokens:
                    trainer.train(np.concatenate(held))
                    held, size = [], 0
        if trainer:
            yield trained(own, trainer, held)

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        tokens: Counter[int] = Counter()
        for b in batches:
            for k, n, x in zip(*(b.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                values = np.frombuffer(x, np.float32).astype(np.float64) * n
                sums[k] = sums[k] + values if k in sums else values
                tokens[k] += n
        yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.int32()), pa.array([-1] * len(sums), pa.int32()), pa.array(tokens.values(), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=names)

    names, schema = ["slice", "copy", "tokens", "numbers"], "slice int, copy int, tokens long, numbers binary"
    dealt = training.select(F.pmod(F.xxhash64("row", F.lit(1)), F.lit(copies)).cast("int").alias("copy"), "ids", "row").repartition(copies, "copy").sortWithinPartitions("copy", "row").select("copy", "ids")
    rows = dealt.mapInArrow(run, schema).repartition("slice").sortWithinPartitions("slice", "copy").mapInArrow(add, schema).collect()  # the size of the network
    if not rows:
        return net
    return net.with_flat(np.concatenate([np.frombuffer(r["numbers"]) / r["tokens"] for r in sorted(rows, key=lambda r: r["slice"])]))


def train_rounds(training: DataFrame, tokens: int, net: Network, rounds: int, copy_tokens: int, most_copies: int) -> Network:
    """Rounds over (row, ids), each with the rows of its own share, so every row gives gradients once.

    A copy takes about ``copy_tokens`` tokens of a round, whatever the partitions of the table; where the corpus would
    need more than ``most_copies``, each takes more.
    """
    copies = max(1, min(most_copies, -(-tokens // (rounds * copy_tokens))))
    for turn in range(rounds):
        net = average_round(training.where(F.pmod(F.xxhash64("row"), F.lit(rounds)) == turn), net, copies)
    return net


def score_documents(
    df: DataFrame,
    head: int = 1 << 18,
    words: int = 4096,
    classes: int = 64,
    rounds: int = 8,
    copy_tokens: int = 1 << 19,
    most_copies: int = 4096,
    held_out: tuple[int, int] = (7, 2),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Rows with crc32(id as text) modulo held_out[0] equal to held_out[1] are not learnt from. A null text counts as
    empty: one token, its end. Rows may repeat; a null id counts as the empty text. base_score is the add-one
    unigram log10 probability, score that of the network. An empty table gives no rows. Neither the order nor the
    partitions of the rows change a score, but for rounding in 32 bits; rows are dealt by a hash of id and text.
    """
    divisor, rest = held_out
    # the key is a hash of the text: equal texts have equal sums; two of m texts share one with odds of m * m / 2^65
    rows = df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"), (id_remainder(id_col, divisor) == rest).alias("held_out")).withColumn("key", F.xxhash64("text")).withColumn("row", F.xxhash64("id", "key"))
    counts = corpus_counts(rows.where(~F.col("held_out")).select("text"), head)
    ids, by_id, others = _vocabulary(counts, words)
    encoded = encode_documents(rows, counts, ids, math.log10(others))
    net = Network.fresh(Shape(len(by_id)), by_id, classes)
    net = train_rounds(encoded.where(~F.col("held_out")).select("row", "ids"), counts.tokens, net, rounds, copy_tokens, most_copies)
    documents = counts.documents
    log_total = math.log10(counts.tokens + counts.distinct + 1)
    log_end = math.log10(documents + 1)
    kept = ["id", "held_out", "key", "n_tokens", "n_head", "head_log", "n_tail"]

    def score(batches):
        for b in batches:
            texts = _arrays(b.column(7), net.shape.words)
            for a, z in _parts(np.array([len(t) for t in texts], np.int64), 4 << 20):
                s = score_texts(net, texts[a:z]) / math.log(10) + b.column(8).slice(a, z - a).to_numpy()
                yield pa.RecordBatch.from_arrays([*(b.column(i).slice(a, z - a) for i in range(7)), pa.array(s, pa.float64())], names=[*kept, "score"])

    kind = df.schema[id_col].dataType.simpleString()
    scored = encoded.select(*kept, "ids", "outside").mapInArrow(score, f"id {kind}, held_out boolean, key long, n_tokens long, n_head long, head_log double, n_tail long, score double")
    rare = encoded.where(F.size("rare_words") > 0).select("key", F.explode(F.arrays_zip("rare_words", "rare_n")).alias("r")).select("key", F.col("r.rare_words").alias("word"), F.col("r.rare_n").alias("n"))
    once = rare.groupBy("word", "key").agg(F.first("n").alias("n"))  # copies of a text
    met = once.join(counts.table.withColumnRenamed("n", "c"), "word")
    sums = met.groupBy("key").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("tail_log"), F.sum("n").alias("tail_known"))
    sums = materialize(sums, "sums")  # written out, so that the join can split a hot key
    joined = scored.join(sums, "key", "left").withColumns({"tail_log": F.coalesce("tail_log", F.lit(0.0)), "tail_known": F.coalesce("tail_known", F.lit(0))})
    return joined.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_head") + F.col("tail_known") + F.lit(int(documents > 0))).alias("n_known"),
        F.lit(int(counts.tokens)).cast("long").alias("train_tokens"),
        (F.col("head_log") + F.col("tail_log") + F.lit(log_end) - F.col("n_tokens") * F.lit(log_total)).alias("base_score"),
        (F.col("score") + F.col("tail_log")).alias("score"),
    )
