"""A gated recurrent language model in numpy with a class-factored softmax.

Method. Tokens are words (A-Z lower-cased, parted by white space) and one end per text. The HEAD most
frequent training words have outputs of their own, in classes of equal mass of square-rooted counts;
all other words fall into TAILS classes by their last two bytes. A gated recurrent unit predicts the
class, then, inside a head class, the word by a second softmax; inside a tail class a word has its
add-one share of the class's counts, with one more share for words never seen, so probabilities add
up to one. Weights start as the unigram model. Training is truncated backpropagation over windows of
WINDOW tokens, the state carried from window to window and reset at each text; trainers work on parts
of about PER_TRAINER tokens and their weights are averaged after each turn. Scoring carries the state
too, so a text's score is the log-likelihood of the whole text.

Scale. Word counts come from all training texts by one aggregation. The model learns from all training
tokens, once. Parts of about PER_TRAINER tokens, in which long texts are cut into pieces, are dealt to
trainers: to each its own while they are TRAINERS or fewer, beyond that to as many as there are turns, so
a task's part stays bounded while trainers and turns both grow with the input. Weights are summed in a
tree on the executors. Counts of frequent words, CACHED at most, are broadcast; those of the others are
joined. Words are identified by 64-bit hashes.

Defined results: words that tie at the last output of their own are taken by least hash; words of counts
in one quarter octave are broadcast all or not at all; texts of any length are scored whole; null text counts as empty (one token, the end); without training texts every base
score is 0; equal rows each come back; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkit
from .common import fold, settle, shared_dir, slices, table

HEAD, TAILS, CLASSES, UNITS = 2048, 32, 32, 32
CACHED = 400_000
PER_TRAINER, TRAINERS = 400_000, 64
#: Tokens of a text that is learned from in one piece; the state is carried inside a piece.
PIECE = 50_000
#: Weights summed by one task of the tree.
FAN = 16
WINDOW, STREAMS, RATE = 32, 128, 0.2
SLOTS = 256
#: Bytes of text scored at a time.
SLICE = 10_000_000
#: Bytes of text cut into words at a time: what is made of them stays in a core's cache.
CHUNK = 1 << 17
#: Columns of class logits made at a time: they stay in a core's cache.
BLOCK = 1024
F32 = np.float32


def tokens(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, hash, tail class, row) of the words of chunks of texts."""
    for i, j, data, off in textkit.chunks(column, CHUNK):
        s, e, row = textkit.spans(data, off)
        low = textkit.LOWER[data]
        last, before = low[e - 1].astype(np.int64), np.where(e - s > 1, low[np.maximum(e - 2, 0)], 0).astype(np.int64)
        yield i, j, textkit.span_hashes(low, s, e), (last * 257 + before) * 2654435761 % (1 << 32) >> 27, row


def count_words(docs: DataFrame, work: str) -> DataFrame:
    """h, tail, c of every word of the training texts."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def merged():
            h, tail, c = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(h, kind="stable")
            first = np.flatnonzero(np.diff(h[order], prepend=~h[order[:1]]))
            return h[order][first], tail[order][first], np.add.reduceat(c[order], first)

        def out(h, tail, c):
            for a in range(0, len(h), 100_000):
                z = a + 100_000
                yield pa.RecordBatch.from_arrays([pa.array(h[a:z].view(np.int64)), pa.array(tail[a:z].astype(np.int32)), pa.array(c[a:z])], ["h", "tail", "c"])

        for batch in batches:
            for _, _, h, tail, _ in tokens(batch.column(0)):
                if len(h):
                    u, at, c = np.unique(h, return_index=True, return_counts=True)
                    held.append((u, tail[at], c))
                    size += len(u)
                if size > 1_000_000:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > 500_000:
                        yield from out(*held.pop())
                        size = 0
        if held:
            yield from out(*merged())

    return settle(docs.where("train").select("text").mapInArrow(add, "h bigint, tail int, c bigint").groupBy("h").agg(F.first("tail").alias("tail"), F.sum("c").alias("c")), f"{work}/counts")


class Vocabulary:
    """What the tasks need of the counts; index 0 is the end, then head words, then tail classes."""

    def __init__(self, head: np.ndarray, counts: np.ndarray, ends: int, total: int, distinct: int, tail_n: np.ndarray, tail_v: np.ndarray, cached: tuple[np.ndarray, np.ndarray]):
        self.sorted, self.rank = np.sort(head), np.argsort(head)
        self.c = np.concatenate([[ends], counts]).astype(np.int64)
        self.total, self.distinct, self.tail_n, self.tail_v, self.cached = total, distinct, tail_n, tail_v, cached
        self.size = len(head) + 1
        # Words by falling count, parted into classes of about equal sums of square roots.
        order = np.argsort(-self.c, kind="stable")
        mass = np.cumsum(np.sqrt(self.c[order] + 1.0))
        kind = np.minimum((mass - 1e-9) * CLASSES / mass[-1], CLASSES - 1).astype(np.int64)
        self.kind = np.empty(self.size, np.int64)
        self.kind[order] = np.unique(kind, return_inverse=True)[1]
        self.classes = int(self.kind.max()) + 1
        self.order = order
        ends_ = np.searchsorted(self.kind[order], np.arange(self.classes + 1))
        self.parts = list(zip(ends_[:-1].tolist(), ends_[1:].tolist()))
        self.place = np.empty(self.size, np.int64)
        self.place[order] = np.arange(self.size) - ends_[self.kind[order]]

    def ids(self, h: np.ndarray, tail: np.ndarray) -> np.ndarray:
        if self.size == 1:
            return 1 + tail
        at = np.searchsorted(self.sorted, h)
        at[at == len(self.sorted)] = 0
        return np.where(self.sorted[at] == h, self.rank[at] + 1, self.size + tail)

    def target(self, ids: np.ndarray) -> np.ndarray:
        """The class of each token."""
        return np.where(ids < self.size, self.kind[np.minimum(ids, self.size - 1)], self.classes + ids - self.size)

    def start(self, seed: int = 4) -> dict[str, np.ndarray]:
        g = np.random.default_rng(seed)
        mass = np.concatenate([np.bincount(self.kind, self.c + 1.0, self.classes), self.tail_n + self.tail_v + 1.0])
        return {
            "in": g.normal(0, 0.1, (self.size + TAILS, 3 * UNITS)).astype(F32),
            "u": g.normal(0, UNITS**-0.5, (UNITS, 3 * UNITS)).astype(F32),
            "bu": np.zeros(3 * UNITS, F32),
            "wc": np.zeros((UNITS, self.classes + TAILS), F32),
            "bc": np.log(mass / mass.sum()).astype(F32),
            "ww": np.zeros((UNITS, self.size), F32),
            "bw": np.log(self.c[self.order] + 1.0).astype(F32),
        }


class Room:
    """Arrays by name that are used again and again, so that they stay in the caches and cost no page faults."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, shape: tuple[int, ...], dtype) -> np.ndarray:
        size = math.prod(shape)
        held = self.held.get(name)
        if held is None or held.size < size or held.dtype != dtype:
            held = self.held[name] = np.empty(size, dtype)
        return held[:size].reshape(shape)


def _gates(p: dict, rows: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights by state, the biases as a last column, and by the token before (all or ``rows``). What goes into the gates is negated: sigmoid(x) = 1 / (1 + exp(-x))."""
    u = np.concatenate([p["u"].T, p["bu"][:, None]], 1)
    u[: 2 * UNITS] *= -1
    given = p["in"].copy() if rows is None else p["in"][rows]
    given[:, : 2 * UNITS] *= -1
    return u, given


def _step(u: np.ndarray, a: np.ndarray, h: np.ndarray, m: np.ndarray, n: np.ndarray, after: np.ndarray) -> None:
    """One step of all streams, which are columns. ``h`` has a last row of ones; ``m`` (gates, the state's share of the new one), ``n`` and ``after`` are written."""
    np.matmul(u, h, out=m)
    zr = m[: 2 * UNITS]
    zr += a[: 2 * UNITS]
    np.exp(zr, out=zr)
    zr += 1
    np.divide(1, zr, out=zr)
    np.multiply(zr[UNITS:], m[2 * UNITS :], out=n)
    n += a[2 * UNITS :]
    np.tanh(n, out=n)
    np.subtract(h[:UNITS], n, out=after)
    after *= zr[:UNITS]
    after += n


def _by_word(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The different words, most frequent first; each token's place among them; an order of tokens, first each word's first one, then the second ones and so on; how many there are of each."""
    counts = np.bincount(words)
    rows = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
    place = np.empty(len(counts), np.uint16)
    place[rows] = np.arange(len(rows))
    which = place[words]
    order = np.argsort(which, kind="stable")
    counts = counts[rows]
    nth = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
    return rows, which, order[np.argsort(nth.astype(np.uint16), kind="stable")], np.bincount(nth)


def _softmax(x: np.ndarray, picked: np.ndarray, gradient: bool, shift: bool) -> np.ndarray:
    """Log-probability of the picked row of each column of logits; with ``gradient`` x becomes the gradient of its negative. ``shift``: their exponentials might overflow."""
    if shift:
        x -= x.max(0)
    flat, at = x.reshape(-1), picked * x.shape[1] + np.arange(x.shape[1])
    out = flat[at]
    np.exp(x, out=x)
    total = x.sum(0)
    if gradient:
        x *= 1 / total
        flat[at] -= 1
    return out - np.log(total)


def _outputs(p: dict, v: Vocabulary, h: np.ndarray, ids: np.ndarray, grads: dict | None = None, room: Room | None = None):
    """Natural log-probability of each token's class and head word; with ``grads`` also the gradient by h of their sum's negative.

    Tokens are columns: sums over classes and words then run over rows that lie together. A last row of ones takes the biases.
    """
    room = room or Room()
    kind = v.target(ids)
    order = np.argsort(kind.astype(np.uint16), kind="stable")
    kind = kind[order]
    cuts = np.searchsorted(kind, np.arange(v.classes + 1))
    n, dtype = len(ids), h.dtype
    ht = room("ht", (UNITS + 1, n), dtype)
    np.take(h.T, order, axis=1, out=ht[:UNITS], mode="clip")
    ht[UNITS] = 1
    wc, ww = np.concatenate([p["wc"], p["bc"][None]]), np.concatenate([p["ww"], p["bw"][None]])
    out = np.empty(n, np.result_type(dtype, wc.dtype))
    # No logit can pass this bound; sums of exponentials up to 80 still fit a float.
    shift = max(np.abs(ht).max(initial=1) * np.abs(w).sum(0).max() for w in (wc, ww)) > 80
    gc = gw = dh = None
    if grads is not None:
        gc, gw, dh = np.zeros_like(wc), np.zeros_like(ww), room("dh", (UNITS, n), out.dtype)
    for i in range(0, n, BLOCK):
        j = min(n, i + BLOCK)
        part = ht[:, i:j]
        x = np.matmul(wc.T, part, out=room("logits", (wc.shape[1], j - i), out.dtype))
        out[i:j] = _softmax(x, kind[i:j], grads is not None, shift)
        if grads is not None:
            gc += (x @ part.T).T
            np.matmul(wc[:UNITS], x, out=dh[:, i:j])
    place = v.place[np.minimum(ids, v.size - 1)[order]]
    for k, (a, z) in enumerate(v.parts):
        i, j = cuts[k], cuts[k + 1]
        if j > i and z - a > 1:
            w, part = ww[:, a:z], ht[:, i:j]
            x = np.matmul(w.T, part, out=room("logits", (z - a, j - i), out.dtype))
            out[i:j] += _softmax(x, place[i:j], grads is not None, shift)
            if grads is not None:
                gw[:, a:z] = (x @ part.T).T
                dh[:, i:j] += w[:UNITS] @ x
    back = np.empty_like(order)
    back[order] = np.arange(n)
    if grads is None:
        return out[back], None
    grads["wc"], grads["bc"], grads["ww"], grads["bw"] = gc[:UNITS], gc[UNITS], gw[:UNITS], gw[UNITS]
    return out[back], np.take(dh, back, axis=1, out=room("wide", dh.shape, dh.dtype), mode="clip").T


@np.errstate(over="ignore")  # a gate that is shut
def train(p: dict, v: Vocabulary, texts: list[np.ndarray], rate: float = RATE) -> dict:
    """One pass of Adagrad over texts (token ids, each ending with the end). Streams are columns."""
    p = {k: x.copy() for k, x in p.items()}
    seen = {k: np.full(x.shape, 0.1, F32) for k, x in p.items()}
    flat = np.concatenate(texts).astype(np.int64)
    width = min(STREAMS, max(1, len(flat) // (4 * WINDOW)))
    length = len(flat) // width
    target = flat[: width * length].reshape(width, length).T
    given = np.concatenate([np.zeros((1, width), np.int64), target[:-1]])
    room, dtype = Room(), p["u"].dtype
    carried = np.zeros((UNITS, width), dtype)
    for i in range(0, length, WINDOW):
        x, y = given[i : i + WINDOW], target[i : i + WINDOW]
        steps = len(x)
        goes_on = (x != 0).astype(dtype)  # 0 where the end came before: a new text
        rows, which, order, many = _by_word(x.ravel())
        u, table = _gates(p, rows)
        a, m, before, n, after = (room(k, (steps, size, width), dtype) for k, size in (("a", 3 * UNITS), ("m", 3 * UNITS), ("before", UNITS + 1), ("n", UNITS), ("after", UNITS)))
        np.copyto(a, np.take(table, which.reshape(x.shape), axis=0, out=room("rows", (*x.shape, 3 * UNITS), dtype), mode="clip").transpose(0, 2, 1))
        before[:, UNITS] = 1
        for t in range(steps):
            np.multiply(after[t - 1] if t else carried, goes_on[t], out=before[t, :UNITS])
            _step(u, a[t], before[t], m[t], n[t], after[t])
        carried = after[-1].copy()
        g: dict[str, np.ndarray] = {}
        columns = room("columns", (UNITS, steps, width), dtype)
        np.copyto(columns, after.transpose(1, 0, 2))
        dout = _outputs(p, v, columns.reshape(UNITS, -1).T, y.ravel(), g, room)[1].T.reshape(columns.shape)
        # What a step's error is multiplied with, for all steps at once; the loop back through time does the rest.
        z, r = m[:, :UNITS], m[:, UNITS : 2 * UNITS]
        by_n, by_z, by_r = (room(k, n.shape, dtype) for k in ("by_n", "by_z", "by_r"))
        np.subtract(before[:, :UNITS], n, out=by_z)
        by_z *= z
        np.multiply(n, n, out=by_n)
        np.subtract(1, by_n, out=by_n)
        np.subtract(1, z, out=n)
        by_n *= n
        by_z *= n
        np.subtract(1, r, out=by_r)
        by_r *= r
        by_r *= m[:, 2 * UNITS :]
        # Errors of the state's share of the new one, before the two gates, and before the new one.
        d = room("d", (steps, 4 * UNITS, width), dtype)
        din = room("rows", (steps, width, 3 * UNITS), dtype)
        turned = np.roll(p["u"], UNITS, 1)
        dh, more = np.zeros((UNITS, width), dtype), np.empty((UNITS, width), dtype)
        for t in reversed(range(steps)):
            dm, dz, dr, dn = d[t].reshape(4, UNITS, width)
            dh += dout[:, t]
            np.multiply(dh, by_z[t], out=dz)
            np.multiply(dh, by_n[t], out=dn)
            np.multiply(dn, by_r[t], out=dr)
            np.multiply(dn, r[t], out=dm)
            np.matmul(turned, d[t, : 3 * UNITS], out=more)
            dh *= z[t]
            dh += more
            dh *= goes_on[t]
            np.copyto(din[t], d[t, UNITS:].T)
        gu = np.roll(np.matmul(d[:, : 3 * UNITS], before.transpose(0, 2, 1)).sum(0), -UNITS, 0).T
        g["u"], g["bu"] = gu[:UNITS], gu[UNITS]
        din = np.take(din.reshape(-1, 3 * UNITS), order, axis=0, out=room("a", (len(order), 3 * UNITS), dtype), mode="clip")
        gin, j = din[: many[0]], many[0]
        for k in many[1:]:
            gin[:k] += din[j : j + k]
            j += k
        scale = F32(1 / width)
        g["in"] = gin
        for k, e in g.items():
            e *= scale
            at = rows if k == "in" else slice(None)
            total = seen[k][at]
            total += e * e
            seen[k][at] = total
            e *= F32(rate)
            e /= np.sqrt(total)
            p[k][at] -= e
    return p


@np.errstate(over="ignore")
def log_likelihoods(p: dict, v: Vocabulary, flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of each text (token ids up to its entry in ``ends``) the sum of natural log-probabilities of classes and head words."""
    out = np.zeros(len(ends))
    starts = np.concatenate([[0], ends[:-1]])
    given = np.empty(len(flat), np.int64)
    given[1:] = flat[:-1]
    given[starts] = 0
    queue = np.argsort(starts - ends, kind="stable")  # longest first
    taken = min(SLOTS, len(queue))
    doc = queue[:taken].copy()
    room, dtype = Room(), p["u"].dtype
    u, table = _gates(p)
    at, h = starts[doc].copy(), np.zeros((UNITS, taken), dtype)
    base = np.arange(WINDOW)[:, None]
    # States wait for their outputs until there are enough of them, however few texts are left.
    held, waiting, size = np.empty((UNITS, 2 * WINDOW * SLOTS), dtype), [], 0

    def give():
        of, ids = (np.concatenate(k) for k in zip(*waiting))
        lp, _ = _outputs(p, v, held[:, :size].T, ids, room=room)
        np.add(out, np.bincount(of, lp, len(out)), out=out)

    while len(doc):
        place = at[None] + base
        live = place < ends[doc][None]
        steps, width = int(live.any(1).sum()), len(doc)
        place, live = np.minimum(place[:steps], len(flat) - 1), live[:steps]
        before, m, n = (room(k, (units, width), dtype) for k, units in (("before", UNITS + 1), ("m", 3 * UNITS), ("n", UNITS)))
        a, hs = room("a", (steps, 3 * UNITS, width), dtype), room("hs", (UNITS, steps, width), dtype)
        np.copyto(a, np.take(table, given[place], axis=0, out=room("rows", (steps, width, 3 * UNITS), dtype), mode="clip").transpose(0, 2, 1))
        before[UNITS] = 1
        for t in range(steps):
            before[:UNITS] = h
            _step(u, a[t], before, m, n, h)
            hs[:, t] = h
        of = np.flatnonzero(live)
        held[:, size : size + len(of)] = np.take(hs.reshape(UNITS, -1), of, axis=1)
        waiting.append((np.broadcast_to(doc, live.shape)[live], flat[place[live]]))
        size += len(of)
        if size > held.shape[1] - WINDOW * SLOTS:
            give()
            waiting, size = [], 0
        at += WINDOW
        done = np.flatnonzero(at >= ends[doc])
        new = queue[taken : taken + len(done)]
        taken += len(new)
        put, gone = done[: len(new)], done[len(new) :]
        doc[put], at[put], h[:, put] = new, starts[new], 0
        if len(gone):
            doc, at, h = np.delete(doc, gone), np.delete(at, gone), np.delete(h, gone, 1)
    if size:
        give()
    return out


def _flat(ids: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of each text with its end, one after another, and where each ends."""
    ends = np.searchsorted(row, np.arange(rows), "right") + np.arange(1, rows + 1)
    flat = np.zeros(len(ids) + rows, np.int64)
    flat[np.arange(len(ids)) + row] = ids
    return flat, ends


def _level():
    """Quarter octaves of a word's count: at most 256 of them."""
    return F.floor(F.log2(F.col("c").cast("double")) * 4 + 1e-9).cast("int")


def cached_level(levels, most: int) -> int:
    """The least level from which on no more than ``most`` words are; levels come as (level, number of words)."""
    bar, sofar = 1 << 20, 0
    for level, n in sorted(levels, reverse=True):
        if sofar + n > most:
            break
        bar, sofar = level, sofar + n
    return bar


def plan_trainers(total: int) -> tuple[int, int]:
    """Trainers and turns for so many tokens: one turn up to TRAINERS parts, beyond that about as many trainers as turns."""
    parts = max(1, total // PER_TRAINER)
    trainers = min(parts, max(TRAINERS, math.isqrt(parts)))
    return trainers, max(1, round(parts / trainers))


def learn(spark: SparkSession, docs: DataFrame, work: str) -> tuple[Vocabulary, dict, DataFrame]:
    """Vocabulary, weights and the table of counts; ``docs`` has text and train."""
    counts = count_words(docs, work)
    ends = docs.where("train").count()
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    head = counts.orderBy(F.desc("c"), "h").limit(HEAD - 1).collect()
    words = np.array([r["h"] for r in head], np.int64).view(np.uint64)
    bar = cached_level(((r["level"], r["n"]) for r in counts.groupBy(_level().alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()), CACHED)
    cached = counts.where(_level() >= bar).select("h", "c").toPandas().sort_values("h")
    known = cached["h"].to_numpy().view(np.uint64)
    order = np.argsort(known)
    tail = counts.groupBy("tail").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    tail_n, tail_v = np.zeros(TAILS), np.zeros(TAILS)
    for r in tail:
        tail_n[r["tail"]], tail_v[r["tail"]] = r["n"], r["v"]
    for r in head:
        tail_n[r["tail"]] -= r["c"]
        tail_v[r["tail"]] -= 1
    v = Vocabulary(words, np.array([r["c"] for r in head], np.int64), ends, total + ends, distinct + (ends > 0), tail_n, tail_v, (known[order], cached["c"].to_numpy()[order]))
    p = v.start()
    if not v.total:
        return v, p, counts
    shared = spark.sparkContext.broadcast(v)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1, SLICE)):
            of: list[int] = []
            out: list[bytes] = []
            for i, j, h, tail, row in tokens(batch.column(1)):
                flat, ends = _flat(shared.value.ids(h, tail), row, j - i)
                for k, x in enumerate(np.split(flat.astype(np.uint16), ends[:-1]), i):
                    pieces = [x[a : a + PIECE].tobytes() for a in range(0, len(x), PIECE)]
                    of += [k] * len(pieces)
                    out += pieces
            seed = batch.column(0).take(pa.array(of, pa.int64())).to_numpy(zero_copy_only=False).astype(np.uint64)
            # Parts by row and piece, not by text: the copies of a text and the pieces of a long one are dealt out too.
            nth = np.arange(len(of)) - np.searchsorted(of, of) if of else np.zeros(0, np.int64)
            part = textkit.mix(seed + nth.astype(np.uint64)) % np.uint64(trainers * turns)
            yield pa.RecordBatch.from_arrays([pa.array((part // np.uint64(trainers)).astype(np.int32)), pa.array((part % np.uint64(trainers)).astype(np.int32)), pa.array(out, pa.binary())], ["turn", "trainer", "ids"])

    trainers, turns = plan_trainers(v.total)
    rows = docs.where("train").select(F.xxhash64("doc_id", "text", F.monotonically_increasing_id()).alias("seed"), "text")
    numbered = rows.mapInArrow(number, "turn int, trainer int, ids binary")
    numbered.repartition("turn", "trainer").write.mode("overwrite").partitionBy("turn").parquet(f"{work}/sample")
    sample = spark.read.schema("trainer int, ids binary, turn int").parquet(f"{work}/sample")

    def trainer(now, seed: int):
        def work_on(pdf: pd.DataFrame) -> pd.DataFrame:
            texts = [np.frombuffer(x, np.uint16) for x in sorted(pdf["ids"])]
            texts = [texts[i] for i in np.random.default_rng(seed).permutation(len(texts))]
            new, n = train(now.value, shared.value, texts, RATE), sum(map(len, texts))
            total = np.concatenate([x.ravel() for x in new.values()]).astype(np.float64) * n
            return pd.DataFrame({"place": [int(pdf["trainer"].iloc[0]) // FAN], "n": [n], "total": [total.tobytes()]})

        return work_on

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x) for x in pdf["total"])
        return pd.DataFrame({"place": [int(pdf["place"].iloc[0]) // FAN], "n": [int(pdf["n"].sum())], "total": [total.tobytes()]})

    schema = "place int, n bigint, total binary"
    for turn in range(turns):
        now = spark.sparkContext.broadcast(p)
        # By number, not by size: a trainer's part is a few bytes and much work.
        sums = sample.where(F.col("turn") == turn).repartition(2 * trainers, "trainer").groupBy("trainer").applyInPandas(trainer(now, turn), schema)
        width = -(-trainers // FAN)
        while True:
            sums = sums.groupBy("place").applyInPandas(add, schema)
            if width <= FAN:
                break
            width = -(-width // FAN)
        found = sums.collect()
        now.unpersist()
        weight = float(sum(r["n"] for r in found))
        if not weight:
            continue
        mean = sum(np.frombuffer(r["total"]) for r in found) / weight
        cut = np.cumsum([x.size for x in p.values()])
        p = {name: x.reshape(p[name].shape).astype(F32) for name, x in zip(p, np.split(mean, cut[:-1]))}
    return v, p, counts


def score(spark: SparkSession, docs: DataFrame, work: str | None = None, mod: int = 7, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of ``docs``."""
    work = work or shared_dir(spark)
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), (fold(F.col("doc_id"), mod) != held_out).alias("train"))
    v, p, counts = learn(spark, docs, work)
    shared = spark.sparkContext.broadcast((v, p))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, p = shared.value
        known, count = v.cached
        serial = TaskContext.get().partitionId() << 40
        for batch in (part for whole in batches for part in slices(whole, 2, SLICE)):
            parts = [(h, tail, row + i) for i, _, h, tail, row in tokens(batch.column(2))]
            h, tail, row = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
            n = batch.num_rows
            ids = v.ids(h, tail)
            flat, ends = _flat(ids, row, n)
            natural = log_likelihoods(p, v, flat, ends)
            rare = ids >= v.size
            c = v.c[np.where(rare, 0, ids)]
            at = np.searchsorted(known, h[rare])
            at[at == len(known)] = 0
            hit = (known[at] == h[rare]) if len(known) else np.zeros(int(rare.sum()), bool)
            c[rare] = np.where(hit, count[at] if len(known) else 0, 0)
            shares = np.log10(v.tail_n + v.tail_v + 1)
            own = np.log10(c + 1.0)
            inside = np.bincount(row, np.where(rare, own - shares[tail], 0.0), n)
            base = np.bincount(row, own, n) + np.log10(v.c[0] + 1.0)
            seen = np.bincount(row, c > 0, n) + (v.c[0] > 0)
            rest = np.flatnonzero(rare)[~hit]
            cuts = np.searchsorted(row[rest], np.arange(n + 1)).astype(np.int32)
            open_ = pa.ListArray.from_arrays(pa.array(cuts), pa.array(h[rest].view(np.int64)))
            size = np.bincount(row, minlength=n) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(serial + np.arange(n)), pa.array(size), pa.array(seen.astype(np.int64)), pa.array(natural / np.log(10) + inside), pa.array(base - size * np.log10(v.total + v.distinct + 1.0)), open_],
                ["doc_id", "train", "rid", "n_tokens", "seen", "score", "base", "open"],
            )
            serial += n

    schema = f"doc_id {kind}, train boolean, rid bigint, n_tokens bigint, seen bigint, score double, base double, open array<bigint>"
    scored = settle(docs.select("doc_id", "train", "text").mapInArrow(run, schema), f"{work}/scored")
    # Words too rare for the broadcast: their counts are joined, text by text and word by word.
    rare = scored.select("rid", F.explode("open").alias("h")).join(counts.select("h", "c"), "h").groupBy("rid").agg(F.sum(F.log10(F.col("c") + 1)).alias("more"), F.count(F.lit(1)).alias("known"))
    out = scored.drop("open").join(rare, "rid", "left")
    more = F.coalesce("more", F.lit(0.0))
    return out.select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        (F.col("seen") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(int(v.total)).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark, table(spark, sf_dir, "documents"))
